"""Operator 3: secret scans in one byte pass over a combined deterministic automaton.

All rules are compiled once into one minimal automaton (``automaton.compile_rules``), whose
transition array the workers step through byte by byte. Where it accepts a rule, that rule's
backward automaton finds the match's start and its forward automaton the end. Rules match
leftmost and without overlap per kind; a match of a rule must not begin inside another of
the same rule before that one first accepts, which holds for the rules below.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.automaton import Dfa, compile_rules


@dataclass(frozen=True)
class Rule:
    """``tail``: class of the value at the match's end, ``tail_min`` its least length; ``least``: of the match."""

    kind: str
    pattern: str
    fold: bool = False
    least: int = 1
    tail: str = ""
    tail_min: int = 0


# The three base kinds, in the order in which they are listed.
BASE = (
    Rule("assign", r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""", fold=True,
         tail=r"[A-Za-z0-9+/_.=-]+\Z", tail_min=6),
    Rule("access", r"AKIA[A-Z0-9]+", least=20),
    Rule("hex", r"[0-9a-f]{24,}", least=24),
)
# Kinds that this operator adds.
ADDED = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", least=40),
    Rule("forge", r"gh[opsur]_[A-Za-z0-9]+", least=40),
)
RULES = BASE + ADDED


class Scanner:
    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = rules
        patterns = [(r.pattern, r.fold) for r in rules]
        self.all = compile_rules(patterns, search=True)
        self.forward = [compile_rules([p], search=False) for p in patterns]
        self.backward = [compile_rules([p], search=False, backward=True) for p in patterns]

    @staticmethod
    def _longest(dfa: Dfa, data) -> int:
        """Length of the longest prefix of ``data`` (an iterable of bytes) that the automaton accepts."""
        s, best = 0, 0
        nxt, first, dead = dfa.next, dfa.first_accept, dfa.dead
        for n, c in enumerate(data, 1):
            s = nxt[s + c]
            if s >= first:
                best = n
            elif s == dead:
                break
        return best

    def spans(self, text: str | None) -> list[tuple[int, int, int]]:
        """(rule, start, end) in code points, by start and then rule; null has none."""
        if not text:
            return []
        data = text.encode("utf-8")
        nxt, first, accepted = self.all.next, self.all.first_accept, self.all.rules
        ends = [0] * len(self.rules)
        found: list[tuple[int, int, int]] = []
        s = 0
        for i, c in enumerate(data):
            s = nxt[s + c]
            if s >= first:
                for r in accepted[s >> 8]:
                    if i >= ends[r]:
                        back = self._longest(self.backward[r], reversed(memoryview(data)[ends[r] : i + 1]))
                        if back:
                            start = i + 1 - back
                            ends[r] = start + self._longest(self.forward[r], memoryview(data)[start:])
                            if self._keeps(self.rules[r], data[start : ends[r]]):
                                found.append((r, start, ends[r]))
        return self._code_points(text, data, sorted((a, r, b) for r, a, b in found))

    @staticmethod
    def _keeps(rule: Rule, match: bytes) -> bool:
        if len(match) < rule.least:
            return False
        return not rule.tail or len(_value(match)) >= rule.tail_min

    @staticmethod
    def _code_points(text: str, data: bytes, found) -> list[tuple[int, int, int]]:
        if len(text) == len(data) or not found:
            return [(r, a, b) for a, r, b in found]
        at = byte = 0
        points = {}
        for x in sorted({p for a, _, b in found for p in (a, b)}):
            at += len(data[byte:x].decode("utf-8"))
            byte, points[x] = x, at
        return [(r, points[a], points[b]) for a, r, b in found]


def _value(match: bytes) -> bytes:
    """The assigned value: what follows the separator, its spaces and the quote."""
    m = re.match(rb"""[A-Za-z_]+["']?\x20*[:=]\x20*["']?""", match)
    return match[m.end():]


_SCANNERS: dict[tuple, Scanner] = {}


def scanner(rules: tuple[Rule, ...] = RULES) -> Scanner:
    if rules not in _SCANNERS:
        _SCANNERS[rules] = Scanner(rules)
    return _SCANNERS[rules]


def secret_spans(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """array<struct<kind, start, end>> of a text column: code points, end exclusive, by start and then
    in the rules' order. Null and empty texts have none."""

    @F.pandas_udf("array<struct<kind: string, start: long, end: long>>")
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        sc = scanner(rules)
        for texts in batches:
            yield texts.map(lambda t: [{"kind": rules[r].kind, "start": a, "end": b} for r, a, b in sc.spans(t)])

    return scan(F.coalesce(text, F.lit("")))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_assign, n_access, n_hex, base_sha256, spans.

    Null and empty texts have no span; repeated rows stay repeated; other columns are ignored;
    an empty table gives an empty result. One pass, no shuffle.
    """

    @F.pandas_udf("n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        sc, kinds, base = scanner(), [r.kind for r in RULES], len(BASE)
        for texts in batches:
            rows = []
            for t in texts:
                got = sc.spans(t)
                own = [x for x in got if x[0] < base]
                join = lambda xs: ",".join(f"{kinds[r]}:{a}:{b}" for r, a, b in xs)
                rows.append([sum(x[0] == k for x in own) for k in range(base)]
                            + [hashlib.sha256(join(own).encode()).hexdigest(), join(got)])
            yield pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans"], dtype=object)

    return docs.select(F.col(id_col).alias("doc_id"), scan(F.coalesce(F.col(text_col), F.lit(""))).alias("s")).select("doc_id", "s.*")


def redact(docs: DataFrame, text_col: str = "text", chars_col: str = "n_chars", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every found span replaced by ``mark`` and the length column, if there is one, brought
    up to date. Overlapping spans are replaced once. Texts without a span, null and empty ones stay."""

    @F.pandas_udf("string")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        sc = scanner()

        def one(t):
            out, at = [], 0
            for _, a, b in sc.spans(t):
                if a >= at:
                    out += [t[at:a], mark]
                at = max(at, b)
            return "".join(out) + t[at:] if out else t

        for texts in batches:
            yield pd.Series([None if t is None or t != t else one(t) for t in texts], dtype=object)

    out = docs.withColumn(text_col, clean(F.col(text_col)))
    return out.withColumn(chars_col, F.length(text_col).cast(dict(docs.dtypes)[chars_col])) if chars_col in docs.columns else out
