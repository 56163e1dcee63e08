"""Re-Pair grammars over many sequences, and one min-plus transfer matrix with audits per rule."""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator


def re_pair(sequences: list[list[int]], terminals: int) -> tuple[list[tuple[int, int]], list[list[int]]]:
    """Rules and the sequences that are left: rule ``k`` makes symbol ``terminals + k`` of two others.

    The pair found most often, overlaps left out, becomes a symbol until no pair occurs twice; of
    pairs equally frequent the smallest goes first. Sequences stay apart. Time is near linear in the
    symbols: each replacement touches its own places alone.
    """
    symbol: list[int] = []
    for s in sequences:
        symbol += [-1, *s]
    symbol.append(-1)
    after = list(range(1, len(symbol) + 1))
    before = list(range(-1, len(symbol) - 1))
    places: dict[tuple[int, int], set[int]] = defaultdict(set)

    def add(at: int) -> tuple[int, int] | None:
        """Note the pair that starts at a place, unless it overlaps one of two equal symbols."""
        if symbol[at] == -1 or symbol[after[at]] == -1:
            return None
        pair = symbol[at], symbol[after[at]]
        if pair[0] == pair[1] and (before[at] in places[pair] or after[at] in places[pair]):
            return None
        places[pair].add(at)
        return pair

    for at in range(len(symbol) - 1):
        add(at)
    heap = [(-len(found), pair) for pair, found in places.items() if len(found) > 1]
    heapq.heapify(heap)
    rules: list[tuple[int, int]] = []
    while heap:
        count, pair = heapq.heappop(heap)
        found = places.get(pair, set())
        if len(found) < 2:
            continue
        if len(found) != -count:
            heapq.heappush(heap, (-len(found), pair))
            continue
        rules.append(pair)
        new = terminals + len(rules) - 1
        touched = set()
        for at in sorted(found):
            if at not in places[pair]:
                continue
            right = after[at]
            for other in (before[at], right):
                places[symbol[other], symbol[after[other]]].discard(other)
            places[pair].discard(at)
            symbol[at], after[at] = new, after[right]
            before[after[right]] = at
            # Places one further were left out if they overlapped one that is gone.
            touched |= {add(at), add(before[at]), add(after[at])}
            if before[at] > 0:
                touched.add(add(before[before[at]]))
        places.pop(pair, None)
        for pair in touched - {None}:
            if len(places[pair]) > 1:
                heapq.heappush(heap, (-len(places[pair]), pair))

    left: list[list[int]] = []
    at = 0
    while at < len(symbol):
        if symbol[at] == -1:
            left.append([])
        else:
            left[-1].append(symbol[at])
        at = after[at]
    return rules, left[:-1]


class Rope:
    """Text put together from shared parts, none of which is copied until it is asked for."""

    __slots__ = ("left", "right", "size", "text")

    def __init__(self, text: bytes | None = b"", left: Rope | None = None, right: Rope | None = None) -> None:
        self.text, self.left, self.right = text, left, right
        self.size = len(text) if text is not None else left.size + right.size

    def __add__(self, other: Rope) -> Rope:
        if not self.size:
            return other
        if not other.size:
            return self
        if self.size + other.size <= 64:
            return Rope(bytes(self) + bytes(other))
        return Rope(None, self, other)

    def parts(self) -> Iterator[bytes]:
        open_ = [self]
        while open_:
            rope = open_.pop()
            if rope.text is not None:
                yield rope.text
            else:
                open_ += [rope.right, rope.left]

    def __bytes__(self) -> bytes:
        return self.text if self.text is not None else b"".join(self.parts())

    def __lt__(self, other: Rope) -> bool:
        if self is other:
            return False
        if self.text is not None and other.text is not None:
            return self.text < other.text
        # A shared beginning is skipped; then parts are compared only up to the first difference.
        if self.left is not None and self.left is other.left:
            return self.right < other.right
        mine, theirs = self.parts(), other.parts()
        a = b = b""
        while True:
            a = a or next(mine, b"")
            b = b or next(theirs, b"")
            if not a or not b:
                return not a and bool(b)
            n = min(len(a), len(b))
            if a[:n] != b[:n]:
                return a[:n] < b[:n]
            a, b = a[n:], b[n:]


# Row by row, the cheapest way from a state to another: its cost and its audit, or None.
Entry = tuple[int, Rope] | None
Matrix = list[list[Entry]]


def best(one: Entry, other: Entry) -> Entry:
    """The cheaper way; of equal ones the smaller audit."""
    if one is None or other is None:
        return one or other
    if one[0] != other[0]:
        return one if one[0] < other[0] else other
    return other if other[1] < one[1] else one


def times(a: Matrix, b: Matrix) -> Matrix:
    """Min-plus product; audits are joined end to end."""
    size = len(b[0])
    out: Matrix = []
    for row in a:
        ways = [(m, e) for m, e in enumerate(row) if e is not None]
        line: list[Entry] = []
        for j in range(size):
            # Costs first: audits are joined for the ties at the least cost only.
            least, ties = None, []
            for m, e in ways:
                f = b[m][j]
                if f is not None:
                    cost = e[0] + f[0]
                    if least is None or cost < least:
                        least, ties = cost, [(e, f)]
                    elif cost == least:
                        ties.append((e, f))
            found: Entry = None
            for e, f in ties:
                found = best(found, (least, e[1] + f[1]))
            line.append(found)
        out.append(line)
    return out


def matrices(sequences: list[list[int]], terminals: list[Matrix]) -> list[Matrix]:
    """The product of its symbols' matrices for every sequence, none of which may be empty.

    A rule's matrix is made once, from the two below it, for all places and sequences it stands in.
    """
    rules, left = re_pair(sequences, len(terminals))
    known = list(terminals)
    for a, b in rules:
        known.append(times(known[a], known[b]))
    out = []
    for symbols in left:
        whole = known[symbols[0]]
        for s in symbols[1:]:
            whole = times(whole, known[s])
        out.append(whole)
    return out
