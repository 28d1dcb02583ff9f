"""Regular expressions compiled to one deterministic automaton over bytes.

Patterns are read by the standard library's regex parser (literals, classes, groups,
alternatives and greedy repeats are allowed), joined into one nondeterministic automaton,
made deterministic by subset construction and reduced by Moore's minimisation.
"""

from __future__ import annotations

import re
from collections import defaultdict

_parser = re._parser

MAX = _parser.MAXREPEAT


def _byte_set(op, arg, fold: bool) -> frozenset[int]:
    def one(c):
        if c > 127:
            raise ValueError("patterns are ASCII")
        return {c, *({ord(chr(c).lower()), ord(chr(c).upper())} if fold else ())}

    name = str(op)
    if name == "LITERAL":
        return frozenset(one(arg))
    if name == "NOT_LITERAL":
        return frozenset(range(256)) - one(arg)
    if name == "ANY":
        return frozenset(range(256)) - {10}
    got, negate = set(), False
    for o, a in arg:
        if str(o) == "NEGATE":
            negate = True
        elif str(o) == "RANGE":
            for c in range(a[0], a[1] + 1):
                got |= one(c)
        elif str(o) == "LITERAL":
            got |= one(a)
        else:
            raise ValueError(f"unsupported class item {o}")
    return frozenset(range(256)) - got if negate else frozenset(got)


class Nfa:
    """States are numbers; ``step[s]`` is (bytes, next) or None, ``free[s]`` the states reached for nothing."""

    def __init__(self):
        self.step: list = []
        self.free: list[list[int]] = []
        self.accepts: dict[int, int] = {}  # state -> rule

    def state(self) -> int:
        self.step.append(None)
        self.free.append([])
        return len(self.step) - 1

    def add(self, pattern: str, rule: int, start: int, fold: bool, backward: bool = False) -> None:
        end = self._items(list(_parser.parse(pattern)), start, fold, backward)
        self.accepts[end] = rule

    def _items(self, items, at: int, fold: bool, backward: bool) -> int:
        for op, arg in reversed(items) if backward else items:
            at = self._item(op, arg, at, fold, backward)
        return at

    def _item(self, op, arg, at: int, fold: bool, backward: bool) -> int:
        name = str(op)
        if name in ("LITERAL", "NOT_LITERAL", "IN", "ANY"):
            s, end = self.state(), self.state()
            self.free[at].append(s)
            self.step[s] = (_byte_set(op, arg, fold), end)
            return end
        if name == "SUBPATTERN":
            return self._items(list(arg[-1]), at, fold, backward)
        if name == "BRANCH":
            end = self.state()
            for branch in arg[1]:
                s = self.state()
                self.free[at].append(s)
                self.free[self._items(list(branch), s, fold, backward)].append(end)
            return end
        if name == "MAX_REPEAT":
            low, high, body = arg
            for _ in range(low):
                at = self._items(list(body), at, fold, backward)
            if high == MAX:
                loop, end = self.state(), self.state()
                self.free[at].append(loop)
                self.free[loop].append(end)
                self.free[self._items(list(body), loop, fold, backward)].append(loop)
                return end
            end = self.state()
            self.free[at].append(end)
            for _ in range(high - low):
                at = self._items(list(body), at, fold, backward)
                self.free[at].append(end)
            return end
        raise ValueError(f"unsupported pattern part {op}")

    def closure(self, states) -> frozenset[int]:
        seen, stack = set(states), list(states)
        while stack:
            for t in self.free[stack.pop()]:
                if t not in seen:
                    seen.add(t)
                    stack.append(t)
        return frozenset(seen)


class Dfa:
    """Transition array ``next[state * 256 + byte]`` holding ``state * 256`` of the next state.

    State 0 is the start; accepting states come last, from ``first_accept * 256`` on;
    ``rules[state]`` are the rules accepted there. ``dead * 256`` never leads to acceptance.
    """

    def __init__(self, next_: list[int], first_accept: int, rules: list[frozenset], dead: int):
        self.next, self.first_accept, self.rules, self.dead = next_, first_accept * 256, rules, dead * 256


def compile_rules(patterns: list[tuple[str, bool]], search: bool, backward: bool = False) -> Dfa:
    """One automaton of all patterns (pattern, ignore ASCII case). With ``search`` a match may begin
    at every byte; otherwise only at the first one scanned. ``backward`` reads matches from their end."""
    nfa = Nfa()
    start = nfa.state()
    for rule, (pattern, fold) in enumerate(patterns):
        s = nfa.state()
        nfa.free[start].append(s)
        nfa.add(pattern, rule, s, fold, backward)
    first = nfa.closure([start])
    ids = {first: 0}
    rows: list[list[int]] = []
    queue = [first]
    for now in queue:  # subset construction
        by_byte: dict[int, set[int]] = defaultdict(set)
        for s in now:
            if nfa.step[s]:
                for c in nfa.step[s][0]:
                    by_byte[c].add(nfa.step[s][1])
        row, done = [0] * 256, {}
        for c in range(256):
            key = frozenset(by_byte.get(c, ()))
            if key not in done:
                to = nfa.closure(key) | (first if search else frozenset())
                if to not in ids:
                    ids[to] = len(ids)
                    queue.append(to)
                done[key] = ids[to]
            row[c] = done[key]
        rows.append(row)
    rules = [frozenset(nfa.accepts[s] for s in now if s in nfa.accepts) for now in queue]
    block = {}
    part = [block.setdefault(r, len(block)) for r in rules]
    while True:  # Moore: split blocks until all members move alike
        block = {}
        split = [block.setdefault((part[i], *[part[t] for t in rows[i]]), len(block)) for i in range(len(rows))]
        if len(block) == len(set(part)):
            break
        part = split
    n = len(set(part))
    member = {}
    for i, p in enumerate(part):
        member.setdefault(p, i)
    order = sorted(member, key=lambda p: (p != part[0], bool(rules[member[p]]), p))
    new = {p: i for i, p in enumerate(order)}
    offset = [i * 256 for i in range(n)]  # one number object a state
    table = [offset[new[part[t]]] for p in order for t in rows[member[p]]]
    kept = [rules[member[p]] for p in order]
    dead = next((i for i in range(n) if not kept[i] and all(t == i * 256 for t in table[i * 256 : i * 256 + 256])), -1)
    return Dfa(table, next((i for i in range(n) if kept[i]), n), kept, dead)
