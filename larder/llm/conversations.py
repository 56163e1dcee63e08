"""Conversation repair: the cheapest edits that make roles alternate, by a grammar-compressed DP.

A conversation's rows become a sequence of symbols, one for each role initial and fault. An automaton of
four states accepts the role initials ``(s?(ua)+)?``; a symbol is a min-plus matrix between its states,
whose entries hold the cost of the cheapest edits and their audit. Re-Pair finds the pairs of symbols
that recur in a task's conversations; each rule gets one matrix, made of the two below it and shared by
every conversation in which it stands. Products take the smallest of equally cheap audits: among the
cheapest audits between two states none begins another, as what follows could only be paid inserts, so
the smallest of a whole is made of the smallest of its parts.

Faults come from grouping and joining narrow rows, so a conversation of any length is spread: it is cut
into segments by range partitions, and at most ``SEGMENT`` symbols make one matrix. Only the last step
reads a conversation in order, as its hash must: rows are streamed through, never gathered.

Defined cases: null roles and texts count as one space, in ids and turns so for the damage's remainder
only; rows without a conversation are a conversation of their own; null turns come first; rows of one
turn are ordered by role and then by the SHA-256 of their text; an initial other than s, u or a fits
nowhere; empty tables give empty results; further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from typing import Any

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructField, StructType

from larder.llm.grammar import Entry, Matrix, Rope, best, matrices, times
from larder.workspace import keep, scratch_scope, stage

RE_ROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
# Symbols that make a segment, and distinct symbols that share a grammar: both bound a task's memory.
SEGMENT = 4_096
GRAMMAR = 100_000

INITIALS = "sua"
NONE, BLANK, DUPLICATE, CUT = range(4)
# States: nothing yet, after s, after u, after a. Where a role's initial leads, if anywhere.
STATES = 4
LEADS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ACCEPTED = (0, 3)
WANTED = {0: "user", 1: "user", 2: "assistant", 3: "user"}
FOLLOWS = {("s", "u"), ("u", "a"), ("a", "u")}


def _inserts() -> Matrix:
    """The cheapest inserts from each state to each."""
    out: Matrix = [[None] * STATES for _ in range(STATES)]
    for start in range(STATES):
        at, audit = start, b""
        while out[start][at] is None:
            out[start][at] = (INSERT * len(audit), Rope(audit))
            at, audit = LEADS[at, WANTED[at][0]], audit + b"I"
    return out


def _edits(role: str, fault: int) -> Matrix:
    """What a row may become."""
    out: Matrix = [[None] * STATES for _ in range(STATES)]
    for state in range(STATES):
        out[state][state] = (DELETE, Rope(b"D"))
        if fault in (BLANK, DUPLICATE):
            continue
        extra = TRUNCATED if fault == CUT else 0
        ways = [(LEADS[state, WANTED[state][0]], RE_ROLE + extra, b"R")]
        if (state, role) in LEADS:
            ways.append((LEADS[state, role], extra, b"K"))
        for to, cost, letter in ways:
            out[state][to] = best(out[state][to], (cost, Rope(letter)))
    return out


@cache
def _terminals() -> list[Matrix]:
    """A matrix per symbol, ``4 * role + fault``: inserts, then the row's own edit."""
    return [
        times(_inserts(), _edits(role, fault)) for role in (*INITIALS, "") for fault in range(4)
    ]


def damaged(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` of rows damaged by the remainder of ``crc32(conv_id:turn)``."""

    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat_ws(":", shown("conv_id"), shown("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(shown("text"), ".!?", ""))
    return rows.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, "user").otherwise(shown("role")).alias("role"),
        text.otherwise(shown("text")).alias("text"),
        F.explode(
            F.when(kind == 0, F.array().cast("array<int>"))
            .when(kind == 3, F.array(F.lit(0), F.lit(1)))
            .otherwise(F.array(F.lit(0)))
        ).alias("copy"),
    ).drop("copy")


def _ordered(rows: DataFrame) -> DataFrame:
    """Rows with all that their order needs, nulls as one space."""
    return rows.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
    ).withColumn("sha", F.unhex(F.sha2("text", 256)))


def symbols(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, sha, copies, symbol`` of each distinct row; further copies are duplicates.

    Equal rows collapse in each task before they are shuffled, and a row that is repeated all through
    a long conversation is one row per turn when it is joined to its first turn.
    """
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*$", 1)
    narrow = (
        _ordered(rows)
        .select(
            "conv_id",
            "turn",
            "role",
            "sha",
            F.when(last == "", BLANK).when(~last.isin(".", "!", "?"), CUT).otherwise(NONE).alias("fault"),
        )
        .groupBy("conv_id", "turn", "role", "sha")
        .agg(F.count(F.lit(1)).alias("copies"), F.first("fault").alias("fault"))
    )
    narrow = stage(narrow, "rows")
    first = (
        narrow.groupBy("conv_id", "role", "sha")
        .agg(F.min(F.struct("turn")).alias("first"))
        .toDF("of_conv", "of_role", "of_sha", "first")
    )
    same = (
        F.col("conv_id").eqNullSafe(F.col("of_conv"))
        & (F.col("role") == F.col("of_role"))
        & (F.col("sha") == F.col("of_sha"))
    )
    fault = F.when(
        (F.col("fault") != BLANK) & ~F.col("turn").eqNullSafe(F.col("first.turn")), DUPLICATE
    ).otherwise(F.col("fault"))
    initial = F.substring("role", 1, 1)
    role = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    return narrow.join(first, same).select(
        "conv_id", "turn", "role", "sha", "copies", (4 * role + fault).alias("symbol")
    )


_SEGMENTS = "part int, place long, costs array<long>, audits array<binary>, counts array<long>"


def _segments(found: DataFrame) -> DataFrame:
    """A matrix and counts for every stretch of a conversation, in order of ``part`` and ``place``."""
    order = ["conv_id", "turn", "role", "sha"]
    spread = found.repartitionByRange(*order).sortWithinPartitions(*order)

    def flush(open_: list[tuple[Any, list[int]]], part: int, place: int) -> pa.RecordBatch:
        distinct = {bytes(s): s for _, s in open_}
        made = dict(zip(distinct, matrices(list(distinct.values()), _terminals()), strict=True))
        flat = [[e for line in made[bytes(s)] for e in line] for _, s in open_]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([c for c, _ in open_], conv_type),
                pa.array([part] * len(open_), pa.int32()),
                pa.array(range(place, place + len(open_)), pa.int64()),
                pa.array([[e[0] if e else -1 for e in m] for m in flat], pa.list_(pa.int64())),
                pa.array([[bytes(e[1]) if e else b"" for e in m] for m in flat], pa.list_(pa.binary())),
                pa.array([_counts(s) for _, s in open_], pa.list_(pa.int64())),
            ],
            names=["conv_id", "part", "place", "costs", "audits", "counts"],
        )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place, held = TaskContext.get().partitionId(), 0, 0
        open_: list[tuple[Any, list[int]]] = []
        for rows in batches:
            for conv, copies, symbol in zip(
                *(rows.column(c).to_pylist() for c in ("conv_id", "copies", "symbol")), strict=True
            ):
                run = [symbol]
                if copies > 1:
                    again = symbol if symbol % 4 == BLANK else symbol - symbol % 4 + DUPLICATE
                    run += [again] * (copies - 1)
                for at in range(0, len(run), SEGMENT):
                    piece = run[at : at + SEGMENT]
                    if not open_ or open_[-1][0] != conv or len(open_[-1][1]) + len(piece) > SEGMENT:
                        if held > GRAMMAR:
                            yield flush(open_, part, place)
                            place, held, open_ = place + len(open_), 0, []
                        open_.append((conv, []))
                    open_[-1][1].extend(piece)
                    held += len(piece)
        if open_:
            yield flush(open_, part, place)

    conv = found.schema["conv_id"]
    conv_type = _arrow(conv)
    return spread.select("conv_id", "copies", "symbol").mapInArrow(cut, _with(conv, _SEGMENTS))


def _arrow(field: StructField) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(field.dataType)


def _with(conv: StructField, rest: str) -> StructType:
    return StructType([StructField("conv_id", conv.dataType)] + StructType.fromDDL(rest).fields)


def _counts(found: list[int]) -> list[int]:
    """Blank, duplicate, truncated and illegal rows of a segment, and its first and last role."""
    faults = [s % 4 for s in found]
    roles = [(*INITIALS, "")[s // 4] for s in found]
    illegal = sum(pair not in FOLLOWS for pair in zip(roles, roles[1:]))
    return [*(faults.count(f) for f in (BLANK, DUPLICATE, CUT)), illegal, found[0] // 4, found[-1] // 4]


class _Conversation:
    """What is known of a conversation while its segments and then its rows stream by."""

    def __init__(self, conv: Any) -> None:
        self.conv = conv
        # Only ways that begin in the first state count.
        self.ways: list[Entry] = [(0, Rope()), None, None, None]
        self.counts = [0, 0, 0, 0]
        self.last: str | None = None
        self.audit: bytes | None = None
        self.at = self.state = self.turns = 0
        self.least: int | None = None
        self.turn: int | None = None
        self.sha = hashlib.sha256()
        self.lines = 0

    def segment(self, costs: list[int], audits: list[bytes], counts: list[int]) -> None:
        flat = [None if c < 0 else (c, Rope(a)) for c, a in zip(costs, audits, strict=True)]
        self.ways = times([self.ways], [flat[i : i + STATES] for i in range(0, len(flat), STATES)])[0]
        for i in range(4):
            self.counts[i] += counts[i]
        first, last = ((*INITIALS, "")[c] for c in counts[4:])
        if self.last is not None and (self.last, first) not in FOLLOWS:
            self.counts[3] += 1
        self.last = last

    def decide(self) -> None:
        if self.audit is None:
            ends = times([self.ways], _inserts())[0]
            found = None
            for state in ACCEPTED:
                found = best(found, ends[state])
            self.cost, audit = found
            self.audit = bytes(audit)

    def line(self, role: str, text: str) -> tuple[str, str]:
        if self.lines:
            self.sha.update(b"\n")
        self.sha.update(f"{role}:{text}".encode("utf-8", "surrogatepass"))
        self.lines += 1
        self.state = LEADS[self.state, role[0]]
        return role, text

    def inserts(self) -> Iterator[tuple[str, str, str]]:
        while self.audit[self.at : self.at + 1] == b"I":
            self.at += 1
            yield (*self.line(WANTED[self.state], ""), "I")

    def row(self, turn: int | None, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """The lines that a row becomes, with what stands before it."""
        self.decide()
        if turn is not None:
            if turn != self.turn:
                self.turns += 1
            self.least = turn if self.least is None else self.least
            self.turn = turn
        yield from self.inserts()
        edit = chr(self.audit[self.at])
        self.at += 1
        if edit != "D":
            yield (*self.line(role if edit == "K" else WANTED[self.state], text), edit)

    def end(self) -> Iterator[tuple[str, str, str]]:
        self.decide()
        yield from self.inserts()

    def summary(self) -> tuple:
        gaps = 0 if self.least is None else self.turn - self.least + 1 - self.turns
        return (self.conv, gaps, *self.counts, self.cost, self.audit.decode(), self.sha.hexdigest())


_SUMMARY = (
    "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired_sha256 string"
)
_TURNS = "place long, role string, text string, edit string"


def _streamed(rows: DataFrame, every: DataFrame, summaries: bool) -> DataFrame:
    """Segments and then rows of each conversation, in order, through one task, nothing gathered."""
    conv = rows.schema["conv_id"]
    segments = stage(_segments(symbols(rows)), "segments")
    nothing = {f.name: F.lit(None).cast(f.dataType) for f in segments.schema.fields if f.name != "conv_id"}
    texts = _ordered(rows).select("conv_id", F.lit(2).alias("kind"), *(c.alias(n) for n, c in nothing.items()), "turn", "role", "text", "sha")
    empty = {f.name: F.lit(None).cast(f.dataType) for f in texts.schema.fields if f.name in ("turn", "role", "text", "sha")}
    parts = segments.select("conv_id", F.lit(1).alias("kind"), *nothing, *(c.alias(n) for n, c in empty.items()))
    named = every.select("conv_id").distinct().select(
        "conv_id", F.lit(0).alias("kind"), *(c.alias(n) for n, c in (nothing | empty).items())
    )
    together = named.union(parts).union(texts).repartition("conv_id")
    together = together.sortWithinPartitions("conv_id", "kind", "part", "place", "turn", "role", "sha")
    schema = _with(conv, _SUMMARY if summaries else _TURNS)
    arrow = pa.schema([(f.name, _arrow(f)) for f in schema.fields])

    def batch(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out)) or [()] * len(arrow)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow
        )

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Conversation | None = None

        def lines(found: Iterator[tuple[str, str, str]]) -> list[tuple]:
            made = [(now.conv, now.lines - 1, *line) for line in found]
            return [] if summaries else made

        for rows in batches:
            out: list[tuple] = []
            names = ("conv_id", "kind", "costs", "audits", "counts", "turn", "role", "text")
            for c, kind, costs, audits, counts, turn, role, text in zip(
                *(rows.column(n).to_pylist() for n in names), strict=True
            ):
                if now is None or now.conv != c:
                    if now is not None:
                        out += lines(now.end())
                        out += [now.summary()] if summaries else []
                    now = _Conversation(c)
                if kind == 1:
                    now.segment(costs, audits, counts)
                elif kind == 2:
                    out += lines(now.row(turn, role, text))
            yield batch(out)
        if now is not None:
            out = lines(now.end())
            yield batch(out + [now.summary()] if summaries else out)

    return together.mapInArrow(walk, schema)


def summaries(rows: DataFrame, every: DataFrame | None = None) -> DataFrame:
    """One row per conversation of ``rows`` (``conv_id, turn, role, text``) and of ``every``.

    ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``.
    """
    with scratch_scope(rows.sparkSession):
        return keep(_streamed(rows, rows if every is None else every, True), "repairs")


def repaired(rows: DataFrame) -> DataFrame:
    """The repaired conversations: ``conv_id, place, role, text, edit`` (K, R or I), places from 0."""
    with scratch_scope(rows.sparkSession):
        return keep(_streamed(rows, rows, False), "repaired")
