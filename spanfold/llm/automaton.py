"""Rules compiled into one deterministic automaton over bytes.

A rule is a regular expression of literals, ``[...]`` classes, groups, ``|`` and the
repetitions ``? * + {n} {n,} {n,m}``. All rules become one automaton by subset
construction over classes of bytes that no rule tells apart, and are then minimised by
partition refinement. The result is plain arrays: a transition per state and byte, and a
set of rules (as bits) per state.

The combined automaton reads a text once, backwards, and reports at each byte the rules
of which some match starts there. A rule's own small automaton then reads on from the
first such byte to the longest match. Together that is leftmost-longest search without
ever going back over the text.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np

ALL_BYTES = (1 << 256) - 1


@dataclass(frozen=True)
class Arrays:
    """``step[state, byte]`` is the next state, ``rules[state]`` the rules as bits. State 0 starts."""

    step: np.ndarray
    rules: np.ndarray

    def rows(self) -> list[list]:
        """Rows that hold the next row per byte, and at 256 the rules of the state."""
        rows: list[list] = [[] for _ in self.step]
        for row, steps, found in zip(rows, self.step.tolist(), self.rules.tolist(), strict=True):
            row.extend(rows[s] for s in steps)
            row.append(found)
        return rows


# -- expressions: ("set", bytes) | ("seq", parts) | ("or", parts) | ("rep", part, least, most)


def parse(pattern: str):
    tree, end = _either(pattern, 0)
    if end != len(pattern):
        raise ValueError(f"unbalanced ) at {end} of {pattern}")
    return tree


def _either(text: str, at: int):
    options, parts = [], []
    while at < len(text) and text[at] != ")":
        if text[at] == "|":
            options.append(("seq", parts))
            parts, at = [], at + 1
            continue
        part, at = _one(text, at)
        part, at = _repeated(part, text, at)
        parts.append(part)
    options.append(("seq", parts))
    return (options[0] if len(options) == 1 else ("or", options)), at


def _one(text: str, at: int):
    if text[at] == "(":
        inner, end = _either(text, at + 1)
        if end >= len(text):
            raise ValueError(f"unclosed ( in {text}")
        return inner, end + 1
    if text[at] == "[":
        return _bytes_of_class(text, at + 1)
    code, at = _char(text, at)
    return ("set", 1 << code), at


def _char(text: str, at: int) -> tuple[int, int]:
    if text[at] == "\\":
        if text[at + 1] == "x":
            return int(text[at + 2 : at + 4], 16), at + 4
        at += 1
    if ord(text[at]) > 127:
        raise ValueError(f"rules are written in ASCII: {text}")
    return ord(text[at]), at + 1


def _bytes_of_class(text: str, at: int):
    negated = text[at] == "^"
    at += negated
    found = 0
    while text[at] != "]":
        low, at = _char(text, at)
        high = low
        if text[at] == "-" and text[at + 1] != "]":
            high, at = _char(text, at + 1)
        for code in range(low, high + 1):
            found |= 1 << code
    return ("set", ALL_BYTES & ~found if negated else found), at + 1


def _repeated(part, text: str, at: int):
    simple = {"?": (0, 1), "*": (0, None), "+": (1, None)}
    while at < len(text) and (text[at] in simple or text[at] == "{"):
        if text[at] == "{":
            end = text.index("}", at)
            least, comma, most = text[at + 1 : end].partition(",")
            bounds = int(least), (int(most) if most else None) if comma else int(least)
            at = end + 1
        else:
            bounds, at = simple[text[at]], at + 1
        part = ("rep", part, *bounds)
    return part, at


def reverse(tree):
    kind = tree[0]
    if kind == "seq":
        return ("seq", [reverse(p) for p in reversed(tree[1])])
    if kind == "or":
        return ("or", [reverse(p) for p in tree[1]])
    return ("rep", reverse(tree[1]), *tree[2:]) if kind == "rep" else tree


def beginning(tree):
    """``tree`` without what may be missing at its end: it matches from the same starts."""
    if tree[0] != "seq":
        return tree
    parts = list(tree[1])
    while parts and parts[-1][0] == "rep" and parts[-1][2] == 0:
        parts.pop()
    return ("seq", parts)


class _Nondeterministic:
    def __init__(self) -> None:
        self.free: list[list[int]] = []  # steps that read nothing
        self.reads: list[tuple[int, int] | None] = []  # (bytes, next)

    def state(self) -> int:
        self.free.append([])
        self.reads.append(None)
        return len(self.free) - 1

    def add(self, tree, begin: int) -> int:
        """Append what reads ``tree`` from ``begin``; its last state."""
        kind = tree[0]
        if kind == "set":
            end = self.state()
            self.reads[begin] = (tree[1], end)
            return self._after(end)
        if kind == "seq":
            for part in tree[1]:
                begin = self.add(part, begin)
            return begin
        if kind == "or":
            end = self.state()
            for part in tree[1]:
                first = self.state()
                self.free[begin].append(first)
                self.free[self.add(part, first)].append(end)
            return self._after(end)
        _, part, least, most = tree
        for _ in range(least):
            begin = self.add(part, begin)
        if most is None:
            loop = self.state()
            self.free[begin].append(loop)
            first = self.state()
            end = self.state()
            self.free[loop] += [first, end]
            self.free[self.add(part, first)].append(loop)
            return self._after(end)
        end = self.state()
        for _ in range(most - least):
            self.free[begin].append(end)
            first = self.state()
            self.free[begin].append(first)
            begin = self.add(part, first)
        self.free[begin].append(end)
        return self._after(end)

    def _after(self, end: int) -> int:
        following = self.state()
        self.free[end].append(following)
        return following

    def closure(self, states) -> frozenset[int]:
        found, stack = set(states), list(states)
        while stack:
            for following in self.free[stack.pop()]:
                if following not in found:
                    found.add(following)
                    stack.append(following)
        return frozenset(s for s in found if self.reads[s] is not None or not self.free[s])


def determine(trees: Sequence, anywhere: bool) -> Arrays:
    """Subset construction over all rules; ``anywhere`` lets a match begin at every byte."""
    machine = _Nondeterministic()
    begins, accepts = [], {}
    for rule, tree in enumerate(trees):
        begins.append(machine.state())
        accepts[machine.add(tree, begins[-1])] = 1 << rule
    sets = sorted({r[0] for r in machine.reads if r is not None})
    kinds: dict[tuple, int] = {}
    byte_class = np.empty(256, np.int64)
    for byte in range(256):
        same = tuple(s >> byte & 1 for s in sets)
        byte_class[byte] = kinds.setdefault(same, len(kinds))
    sample = [int(np.argmax(byte_class == k)) for k in range(len(kinds))]
    start = machine.closure(begins)
    numbers, todo, steps, rules = {start: 0}, [start], [], []
    for states in todo:  # grows while it is read
        rules.append(sum(accepts.get(s, 0) for s in states))
        row = []
        for byte in sample:
            reached = [r[1] for s in states if (r := machine.reads[s]) is not None and r[0] >> byte & 1]
            following = machine.closure([*reached, *begins] if anywhere else reached)
            if following not in numbers:
                numbers[following] = len(numbers)
                todo.append(following)
            row.append(numbers[following])
        steps.append(row)
    step, found = _minimised(np.array(steps), np.array(rules, np.int64))
    return Arrays(step[:, byte_class].astype(np.int32), found)


def _minimised(step: np.ndarray, rules: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge states that no text tells apart: refine by where each byte class leads."""
    part = np.unique(rules, return_inverse=True)[1].ravel()
    while True:
        looks = np.column_stack([part, part[step]])
        finer = np.unique(looks, axis=0, return_inverse=True)[1].ravel()
        if finer.max() == part.max():
            break
        part = finer
    order = np.full(part.max() + 1, -1)
    first = np.unique(part, return_index=True)[1]
    order[part[np.sort(first)]] = np.arange(len(first))  # state 0 stays first
    part = order[part]
    kept = np.empty(len(first), np.int64)
    kept[part[first]] = first
    return part[step[kept]], rules[kept]


@dataclass(frozen=True)
class Compiled:
    """``starts``: all rules, read backwards. ``ends``: per rule, read forwards from a start."""

    starts: Arrays
    ends: tuple[Arrays, ...]


@cache
def compile_rules(patterns: tuple[str, ...]) -> Compiled:
    trees = [parse(p) for p in patterns]
    return Compiled(
        determine([reverse(beginning(t)) for t in trees], anywhere=True),
        tuple(determine([t], anywhere=False) for t in trees),
    )


class Scanner:
    """Compiled rules made ready for reading texts."""

    def __init__(self, compiled: Compiled) -> None:
        self._root = compiled.starts.rows()[0]
        self._ends = []
        for arrays in compiled.ends:
            rows = arrays.rows()
            dead = [row for row in rows if not row[256] and all(x is row for x in row[:256])]
            self._ends.append((rows[0], dead[0] if dead else None))

    def spans(self, text: bytes) -> list[tuple[int, int, int]]:
        """(rule, start, end) in bytes: per rule leftmost, longest, not overlapping."""
        hits = []
        row, at = self._root, len(text)
        for byte in reversed(text):
            at -= 1
            row = row[byte]
            if row[256]:
                hits.append((at, row[256]))
        found: list[tuple[int, int, int]] = []
        free_from = [0] * len(self._ends)
        for start, rules in reversed(hits):
            for rule, (root, dead) in enumerate(self._ends):
                if rules >> rule & 1 and start >= free_from[rule]:
                    free_from[rule] = end = self._longest(text, start, root, dead)
                    found.append((rule, start, end))
        return found

    @staticmethod
    def _longest(text: bytes, start: int, row: list, dead: list | None) -> int:
        end = start
        for at in range(start, len(text)):
            row = row[text[at]]
            if row is dead:
                break
            if row[256]:
                end = at + 1
        return end
