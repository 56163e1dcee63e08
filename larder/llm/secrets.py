"""Secret scanning: all rules in one pass of one automaton over the bytes of every text.

The rules are compiled into one minimal deterministic automaton. A task scans many texts side by side,
one byte of each per step, through its transition array; texts are cut into lanes behind any two bytes
after which the automaton provably has forgotten all it has seen. The pass yields the places where
rules end, and for each the place since when the automaton has not been at its start. A match that
ends there begins between the two, so only those few bytes are tried for the exact span: leftmost
first, longest, without overlaps within a kind. No text is scanned a second time.

Defined cases: null and empty texts have no spans; repeated rows get equal rows; empty tables give
empty results; spans count code points, ends exclusive; further columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from larder.llm.automaton import Automaton, compile_rules

# Least bytes of a lane; a lane goes on to the next line end.
LANE = 2_048


@dataclass(frozen=True)
class Rule:
    """``scan`` is what the automaton looks for: how every match that counts begins, and for rules
    whose full length would multiply states no more than that.

    ``exact`` gives the matches in a text; of them those count whose group ``part`` has ``least``
    characters. What begins a match of ``exact`` must begin one of ``scan``, so that matches that do
    not count are met where they hide others.
    """

    kind: str
    scan: str
    exact: str
    part: int = 0
    least: int = 0


# The three base rules and well-known forms of other credentials.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
RULES = (
    Rule("assign", ASSIGN + r"[A-Za-z0-9+/_.=-]{6,}", ASSIGN + r"([A-Za-z0-9+/_.=-]+)", 1, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", r"[0-9a-f]+", 0, 24),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{4}", r"gh[pousr]_[A-Za-z0-9]{20,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{2}", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{2}", r"AIza[A-Za-z0-9_-]{30,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{5,}\.", r"eyJ[A-Za-z0-9_-]{5,}\.[A-Za-z0-9_-]{5,}\.[A-Za-z0-9_-]{5,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
BASE = ("assign", "access", "hex")


def lanes_of(data: list[bytes], cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and length of each lane in the joined texts, and the text it belongs to.

    A lane ends at the first of ``cuts`` after ``LANE`` bytes, or with its text.
    """
    starts, lengths, owners = [], [], []
    at = 0
    for owner, text in enumerate(data):
        close = at + len(text)
        while at < close:
            end = close
            if close - at > LANE:
                near = np.searchsorted(cuts, at + LANE)
                end = min(close, int(cuts[near])) if near < len(cuts) else close
            starts.append(at)
            lengths.append(end - at)
            owners.append(owner)
            at = end
    return np.array(starts, np.int64), np.array(lengths, np.int64), np.array(owners, np.int64)


@dataclass(frozen=True)
class Hits:
    """Where rules end, in order of texts and places: the text, the end, the place since when the
    automaton has not been at its start, and a number whose bit k tells whether rule k ends there."""

    owner: np.ndarray
    end: np.ndarray
    since: np.ndarray
    rules: np.ndarray


def hits_in(data: list[bytes], machine: Automaton) -> Hits:
    """All places in ``data`` where rules end, from one pass over its bytes."""
    signs = machine.byte_class[np.frombuffer(b"".join(data), np.uint8)]
    cuts = np.flatnonzero(machine.forgets.ravel()[signs[:-1] * machine.classes + signs[1:]]) + 2
    start, length, owner = lanes_of(data, cuts)
    # Longest lanes first, so that those still running are always a prefix.
    order = np.argsort(-length, kind="stable")
    start, length, owner = start[order], length[order], owner[order]
    longest = length[0] if len(length) else 0
    running = np.searchsorted(-length, -np.arange(longest), "left")
    state = np.zeros(len(start), np.int32)
    left_start = np.zeros(len(start), np.int64)
    lane, end, since, rules = ([np.zeros(0, np.int64)] for _ in range(4))
    for step, k in enumerate(running):
        state = machine.moves[state[:k] * machine.classes + signs[start[:k] + step]]
        left_start[:k][state == 0] = step + 1
        ended = machine.ends[state]
        at = np.flatnonzero(ended)
        if len(at):
            lane.append(at)
            end.append(start[at] + step + 1)
            since.append(start[at] + left_start[at])
            rules.append(ended[at])
    ends, owners = np.concatenate(end), owner[np.concatenate(lane)]
    begins = np.cumsum([0] + [len(text) for text in data])[owners]
    order = np.argsort(ends, kind="stable")
    return Hits(
        owners[order],
        (ends - begins)[order],
        (np.concatenate(since) - begins)[order],
        np.concatenate(rules)[order],
    )


def spans_at(
    text: bytes, pattern: re.Pattern[bytes], ends: np.ndarray, since: np.ndarray
) -> Iterator[re.Match[bytes]]:
    """The matches of ``pattern``, leftmost first and without overlaps, that begin between a place of
    ``since`` and the place of ``ends`` that belongs to it."""
    done = k = 0
    while k < len(ends):
        end = int(ends[k])
        if end <= done:
            k = int(np.searchsorted(ends, done, "right"))
            continue
        starts = range(max(done, int(since[k])), end)
        match = next((m for at in starts if (m := pattern.match(text, at))), None)
        if match:
            yield match
        done = match.end() if match else end


def exact_spans(
    text: bytes, hits: Hits, rules: list[tuple[Rule, re.Pattern[bytes]]]
) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` in code points from the places ``hits`` in one text, by start and rule."""
    found = []
    for k, (rule, pattern) in enumerate(rules):
        mine = (hits.rules >> k & 1).astype(bool)
        if mine.any():
            for match in spans_at(text, pattern, hits.end[mine], hits.since[mine]):
                if len(match[rule.part]) >= rule.least:
                    found.append((match.start(), k, match.end()))
    found.sort()
    if found and not text.isascii():
        first_bytes = (np.frombuffer(text, np.uint8) & 0xC0) != 0x80
        before = np.concatenate([[0], np.cumsum(first_bytes)])
        found = [(int(before[a]), k, int(before[b])) for a, k, b in found]
    return [(rules[k][0].kind, a, b) for a, k, b in found]


def spans_of(
    data: list[bytes], machine: Automaton, rules: list[tuple[Rule, re.Pattern[bytes]]]
) -> list[list[tuple[str, int, int]]]:
    """The spans of each of many texts."""
    hits = hits_in(data, machine)
    bounds = np.searchsorted(hits.owner, np.arange(len(data) + 1))
    spans: list[list[tuple[str, int, int]]] = []
    for text, a, b in zip(data, bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        mine = Hits(hits.owner[a:b], hits.end[a:b], hits.since[a:b], hits.rules[a:b])
        spans.append(exact_spans(text, mine, rules) if b > a else [])
    return spans


def compiled(rules: tuple[Rule, ...]) -> list[tuple[Rule, re.Pattern[bytes]]]:
    return [(rule, re.compile(rule.exact.encode())) for rule in rules]


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``doc_id`` and ``spans``, an array of ``(kind, start, end)``, for every row of ``docs``
    (``doc_id, text``)."""
    machine = compile_rules([rule.scan for rule in rules])
    kind_of = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        exact = compiled(rules)
        for rows in batches:
            spans = [
                [{"kind": kind, "start": start, "end": end} for kind, start, end in found]
                for found in spans_of(rows.column("text").to_pylist(), machine, exact)
            ]
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(spans, pa.list_(kind_of))],
                names=["doc_id", "spans"],
            )

    text = F.coalesce("text", F.lit("")).cast("binary").alias("text")
    return docs.select(F.col("doc_id").cast("long"), text).mapInArrow(
        scan, "doc_id long, spans array<struct<kind: string, start: long, end: long>>"
    )


def digest(found: DataFrame, base: tuple[str, ...] = BASE) -> DataFrame:
    """``doc_id, n_<kind> for each base kind, base_sha256, spans`` with spans as text."""

    def listed(spans):  # type: ignore[no-untyped-def]
        parts = F.transform(
            spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        )
        return F.array_join(parts, ",")

    def of(*kinds: str):  # type: ignore[no-untyped-def]
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    return found.select(
        "doc_id",
        *[F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in base],
        F.sha2(listed(of(*base)), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )
