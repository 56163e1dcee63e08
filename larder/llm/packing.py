"""Best-fit packing of tokenised documents into sequences, by the sum-of-squares rule.

Texts become token ids in the tasks that read them; from there on only lengths travel. Pieces are
dealt by a hash of their place into groups of bounded size, and each group is packed on its own.
Within a group the rule keeps, for each gap g, the number N(g) of open sequences with g tokens left,
and puts a piece where the sum of N(g) squared becomes smallest. Longer pieces go first, and of
equal sums the smallest gap wins. One group leaves at most a few sequences open, so groups cost
about one sequence in ``GROUP_PIECES`` pieces.

Defined cases: null or empty texts are the end token alone; repeated rows are packed each for itself;
null ids stay null; empty tables give empty results; further columns are not read.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from larder.llm.common import Memo
from larder.workspace import keep, scratch_scope, stage

CAPACITY = 4096
END_ID = 1
# Pieces packed by one task: bounds its memory (about 4 MB of numbers) and its time (about 1 s).
GROUP_PIECES = 50_000
# Distinct words whose ids a task remembers (about 200 MB); past it the memory starts anew.
WORDS_KEPT = 1_000_000

PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("ids", pa.binary()),
    ]
)


# Runs that the tokenizer splits at: letters, single digits, signs other than the apostrophe (which
# may begin an ending of a word). Where a chunk is made of such runs alone they are encoded apart.
RUNS = re.compile(r"[^\W\d_]+|[0-9]|[!-&(-/:-@\[-`{-~]+")
SPECIAL = b"<|"
# Byte-level vocabularies spell a byte as the sign of that number; the 68 bytes without a visible one
# take the numbers from 256 on, in order.
VISIBLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
BYTE_SIGNS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in VISIBLE)}


class WordIds:
    """Little-endian 32-bit ids of white-space separated chunks, each worked out once.

    The tokenizer drops white space, joins nothing across it or across a run's end, and ignores case:
    so the ids of a text are those of its chunks, and of their runs, one after the other (tests
    compare with whole texts).
    """

    def __init__(self, tokenizer_file: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.model = self.tokenizer.model
        self.chunks = Memo(self._encode, WORDS_KEPT)

    def _encode(self, chunk: bytes) -> bytes:
        if chunk.isalpha() and chunk.islower():
            # Bytes that are letters are ASCII: spelt as they stand, and nothing to normalise.
            return self._pairs(chunk.decode())
        if chunk[-1:] in (b".", b",") and chunk[:-1].isalpha():
            return self.chunks.one(chunk[:-1]) + self.chunks.one(chunk[-1:])
        text = chunk.decode()
        if text.isalpha() and text == text.lower() and is_normalized("NFC", text):
            # A plain word is one run as it stands: only the byte-pair step is left to do.
            return self._pairs(chunk.decode("latin-1").translate(BYTE_SIGNS))
        runs = RUNS.findall(text)
        apart = len(runs) > 1 and SPECIAL not in chunk and "".join(runs) == text
        if apart and all(run.isascii() or run.isalpha() for run in runs):
            return b"".join([self.chunks.one(run.encode()) for run in runs])
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _pairs(self, spelt: str) -> bytes:
        return array("I", [token.id for token in self.model.tokenize(spelt)]).tobytes()

    def of(self, text: str) -> bytes:
        return self.of_bytes(text.encode())

    def of_bytes(self, raw: bytes) -> bytes:
        # Special tokens alone are matched by case.
        chunks = (raw if SPECIAL in raw else raw.lower()).split()
        return b"".join(self.chunks.all(chunks))


def tokenize_pieces(
    docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, with_ids: bool = True
) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, ids``.

    A document is its ids and ``END_ID``; only longer ones are cut, into pieces of ``capacity``.
    ``ids`` are little-endian unsigned 32-bit numbers, or null without ``with_ids``.
    """
    end = np.array([END_ID], "<u4").tobytes()
    width = 4 * capacity

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordIds(tokenizer_file)
        for rows in batches:
            of, piece, start, length, crc, ids = [], [], [], [], [], []
            for i, text in enumerate(rows.column("text")):
                raw = text.as_buffer().to_pybytes() if text.is_valid else b""
                all_ids = words.of_bytes(raw) + end
                for n, at in enumerate(range(0, len(all_ids), width)):
                    part = all_ids[at : at + width]
                    of.append(i)
                    piece.append(n)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    ids.append(part if with_ids else None)
            places = pa.array(of, pa.int64())
            columns = [rows.column("doc_id").take(places), piece, start, length, crc, ids]
            yield pa.RecordBatch.from_arrays(
                [
                    c if isinstance(c, pa.Array) else pa.array(c, f.type)
                    for c, f in zip(columns, PIECES, strict=True)
                ],
                schema=PIECES,
            )

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(
        cut, "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"
    )


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length, longest first, by the sum-of-squares rule.

    Moving a sequence from gap g to g - s changes the sum by 2 (N(g - s) - N(g) + 1). Full and
    untouched sequences are not open: closing one changes it by 1 - 2 N(s), opening one by
    2 N(capacity - s) + 1.
    """
    order = np.argsort(-lengths, kind="stable")
    bins = np.empty(len(lengths), np.int64)
    offsets = np.empty(len(lengths), np.int64)
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    n = np.zeros(capacity + 1, np.int64)
    opened = 0
    for i in order:
        s = int(lengths[i])
        change = 2 * (n[: capacity - s] - n[s:capacity] + 1)
        if s < capacity:
            change[0] = 1 - 2 * n[s]
            change[n[s:capacity] == 0] = np.iinfo(np.int64).max
            best = int(change.argmin())
            new = 2 * n[capacity - s] + 1
        if s < capacity and change[best] <= new and n[s + best]:
            gap = s + best
            bins[i] = open_at[gap].pop()
            n[gap] -= 1
        else:
            gap = capacity
            bins[i] = opened
            opened += 1
        offsets[i] = capacity - gap
        left = gap - s
        if left:
            open_at[left].append(int(bins[i]))
            n[left] += 1
    return bins, offsets


def pack(
    docs: DataFrame,
    tokenizer_file: str,
    capacity: int = CAPACITY,
    group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """Place every piece of every document: ``doc_id, piece, start, length, ids_crc32,
    sequence_id, offset``.

    ``sequence_id`` is the group's number times 2^32 plus the sequence's within it.
    """
    spark = docs.sparkSession
    with scratch_scope(spark):
        pieces = stage(
            tokenize_pieces(docs, tokenizer_file, capacity, with_ids=False)
            .drop("ids")
            .withColumn("place", F.monotonically_increasing_id()),
            "pieces",
        )
        groups = max(1, -(-pieces.count() // group_pieces))
        dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("place"), F.lit(groups)))

        def place(rows: pa.Table) -> pa.Table:
            # The same on a retry, in whatever order the rows arrive.
            rows = rows.sort_by("place")
            bins, offsets = sum_of_squares(rows.column("length").to_numpy(), capacity)
            first = rows.column("bucket")[0].as_py() << 32
            return (
                rows.drop_columns(["bucket", "place"])
                .append_column("sequence_id", pa.array(first + bins))
                .append_column("offset", pa.array(offsets))
            )

        kept = [f for f in dealt.schema.fields if f.name not in ("bucket", "place")]
        placed = [T.StructField(name, T.LongType()) for name in ("sequence_id", "offset")]
        packed = dealt.groupBy("bucket").applyInArrow(place, T.StructType([*kept, *placed]))
        return keep(packed, "packed")
