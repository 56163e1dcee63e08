"""One deterministic automaton for many patterns: parse, subset construction, minimisation.

Patterns are over bytes: literals, escapes (``\\x20``, ``\\.``), classes, groups, ``(?i:...)`` for
letters in either case, alternatives, and ``? * + {m,} {m,n}``. The automaton looks for all of them
everywhere in one pass; after each byte its state tells which patterns end there.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np

# Most states a set of rules may need: bounds the table that is sent to the tasks.
MOST_STATES = 60_000


class _Pattern:
    """Recursive-descent parser that adds a pattern to a nondeterministic automaton."""

    def __init__(self, text: str, machine: _Machine) -> None:
        self.text, self.at, self.machine, self.any_case = text, 0, machine, False

    def peek(self, n: int = 1) -> str:
        return self.text[self.at : self.at + n]

    def take(self, n: int = 1) -> str:
        found = self.peek(n)
        self.at += n
        return found

    def alternatives(self, start: int) -> int:
        end = self.machine.state()
        while True:
            self.machine.free[self.sequence(start)].append(end)
            if self.peek() != "|":
                return end
            self.take()

    def sequence(self, start: int) -> int:
        while self.at < len(self.text) and self.peek() not in "|)":
            begin = self.at
            self.skip_atom()
            least, most = self.times()
            after = self.at
            passed = []
            for k in range(least if most is None else most):
                self.at = begin
                end = self.atom(start)
                if k >= least:
                    self.machine.free[start].append(end)
                passed.append(end)
                start = end
            if most is None:
                loop = self.machine.state()
                self.machine.free[start].append(loop)
                self.at = begin
                self.machine.free[self.atom(loop)].append(loop)
                self.machine.runs.append([*passed[:-1], loop])
                start = loop
            self.at = after
        return start

    def skip_atom(self) -> None:
        """Move past an atom without building it."""
        kept = self.machine
        self.machine = _Machine()
        self.atom(self.machine.state())
        self.machine = kept

    def times(self) -> tuple[int, int | None]:
        sign = self.peek()
        if sign and sign in "?*+":
            self.take()
            return {"?": (0, 1), "*": (0, None), "+": (1, None)}[sign]
        if sign != "{":
            return 1, 1
        close = self.text.index("}", self.at)
        least, _, most = self.text[self.at + 1 : close].partition(",")
        exact = "," not in self.text[self.at : close]
        self.at = close + 1
        return int(least), int(least) if exact else int(most) if most else None

    def atom(self, start: int) -> int:
        sign = self.take()
        if sign == "(":
            before = self.any_case
            if self.peek(3) == "?i:":
                self.take(3)
                self.any_case = True
            elif self.peek(2) == "?:":
                self.take(2)
            end = self.alternatives(start)
            if self.take() != ")":
                raise ValueError(f"unclosed group in {self.text!r}")
            self.any_case = before
            return end
        if sign == "[":
            return self.step(start, self.bracket())
        return self.step(start, {self.escape() if sign == "\\" else ord(sign)})

    def escape(self) -> int:
        sign = self.take()
        return int(self.take(2), 16) if sign == "x" else ord(sign)

    def bracket(self) -> set[int]:
        negated = self.peek() == "^"
        if negated:
            self.take()
        found: set[int] = set()
        while (sign := self.take()) != "]":
            if not sign:
                raise ValueError(f"unclosed class in {self.text!r}")
            low = high = self.escape() if sign == "\\" else ord(sign)
            if self.peek() == "-" and self.peek(2)[1:] != "]":
                self.take()
                sign = self.take()
                high = self.escape() if sign == "\\" else ord(sign)
            found.update(range(low, high + 1))
        return set(range(256)) - found if negated else found

    def step(self, start: int, signs: set[int]) -> int:
        if self.any_case:
            letters = {b for b in signs if chr(b).isascii() and chr(b).isalpha()}
            signs = signs | {b ^ 0x20 for b in letters}
        end = self.machine.state()
        self.machine.steps[start].append((frozenset(signs), end))
        return end


class _Machine:
    """A nondeterministic automaton: free moves, and moves on sets of bytes."""

    def __init__(self) -> None:
        self.free: list[list[int]] = []
        self.steps: list[list[tuple[frozenset[int], int]]] = []
        # For each ``x{m,}`` the states after 1, 2, ... times x, the last for m and more.
        self.runs: list[list[int]] = []
        self.finals: dict[int, int] = {}

    def state(self) -> int:
        self.free.append([])
        self.steps.append([])
        return len(self.free) - 1

    def closed(self, states: set[int]) -> set[int]:
        found, todo = set(states), list(states)
        while todo:
            for onward in self.free[todo.pop()]:
                if onward not in found:
                    found.add(onward)
                    todo.append(onward)
        return found

    def settled(self, states: set[int]) -> frozenset[int]:
        """``states`` without those behind another in a run: what they will match, the one ahead
        matches too, so they only multiply the subsets."""
        for run in self.runs:
            ahead = False
            for state in reversed(run):
                if ahead:
                    states.discard(state)
                ahead = ahead or state in states
        return frozenset(s for s in states if self.steps[s] or s in self.finals)


@dataclass
class Automaton:
    """``moves[state * classes + byte_class[b]]`` is the next state; ``ends[state]`` has bit k set
    where pattern k ends. State 0 is the start."""

    byte_class: np.ndarray
    moves: np.ndarray
    ends: np.ndarray
    classes: int

    @property
    def states(self) -> int:
        return len(self.ends)

    @cached_property
    def forgets(self) -> np.ndarray:
        """By classes of two bytes: whether they lead to the start from everywhere, so that texts may
        be cut after them."""
        table = self.moves.reshape(-1, self.classes)
        after = [np.unique(table[:, first]) for first in range(self.classes)]
        return np.array([(table[states] == 0).all(axis=0) for states in after])


def compile_rules(patterns: list[str]) -> Automaton:
    """The smallest automaton that finds all ``patterns`` anywhere."""
    machine = _Machine()
    starts, finals = [], machine.finals
    for k, text in enumerate(patterns):
        start = machine.state()
        parser = _Pattern(text, machine)
        finals[parser.alternatives(start)] = k
        if parser.at != len(text):
            raise ValueError(f"unread rest of {text!r} at {parser.at}")
        starts.append(start)
    byte_class, samples = _byte_classes(machine)
    begin = machine.closed(set(starts))
    begin_set = machine.settled(set(begin))
    number = {begin_set: 0}
    todo, moves, ends = [begin_set], [], []
    for current in todo:
        ends.append(sum(1 << finals[s] for s in current if s in finals))
        row = []
        for byte in samples:
            reached = {t for s in current for signs, t in machine.steps[s] if byte in signs}
            # A match may begin at every byte.
            onward = machine.settled(machine.closed(reached) | begin)
            if onward not in number:
                if len(number) >= MOST_STATES:
                    raise ValueError(f"the rules need more than {MOST_STATES} states")
                number[onward] = len(number)
                todo.append(onward)
            row.append(number[onward])
        moves.append(row)
    table, last = _smallest(np.array(moves), np.array(ends, np.int64))
    return Automaton(byte_class, table.ravel().astype(np.int32), last, len(samples))


def _byte_classes(machine: _Machine) -> tuple[np.ndarray, list[int]]:
    """Bytes that no pattern tells apart share a class: class by byte, and a byte of each class."""
    sets = sorted({signs for steps in machine.steps for signs, _ in steps}, key=sorted)
    seen: dict[tuple[bool, ...], int] = {}
    byte_class, samples = np.zeros(256, np.int32), []
    for byte in range(256):
        kind = tuple(byte in signs for signs in sets)
        if kind not in seen:
            seen[kind] = len(seen)
            samples.append(byte)
        byte_class[byte] = seen[kind]
    return byte_class, samples


def _smallest(moves: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge states that no input tells apart: split groups by where they lead until none splits."""
    group = np.unique(ends, return_inverse=True)[1]
    while True:
        kinds = np.column_stack([group, group[moves]])
        finer = np.unique(kinds, axis=0, return_inverse=True)[1].ravel()
        if finer.max() == group.max():
            break
        group = finer
    # Number groups by their first state, so that the start stays 0.
    _, first, group = np.unique(group, return_index=True, return_inverse=True)
    order = np.argsort(first)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    group = rank[group]
    first = first[order]
    return group[moves[first]], ends[first]
