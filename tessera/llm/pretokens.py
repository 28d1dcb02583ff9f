"""Byte-level BPE through lookups of pre-token results.

A byte-level BPE tokenizer cuts a text into pre-tokens and merges inside each, so a text's
result is the concatenation of its pre-tokens' results, and those can be looked up. What
the lookup doesn't hold is encoded by the tokenizers library.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from codecs import charmap_decode
from collections.abc import Callable
from operator import attrgetter
from pathlib import Path

import numpy as np
import regex

# Fixed value: the split pattern of the byte-level pre-tokenizer in the public vocabulary files.
SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

# Code points on whose class the regex module and the tokenizers library may disagree (Unicode
# versions differ); a text with one is encoded whole. tests/llm checks all other code points.
DISPUTED = re.compile(
    "[՘֋֌࢏౜೜₏₝-₟꟎꟏꟒꟔꟝꟢꟱꭬꭭"
    "\U00010000-\U0001f2ff\U0001fb00-\U0010ffff]")

# The same split for texts within U+0000-U+024F, in plain classes: several times faster.
_LETTER, _DIGIT, _SPACE = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾", " \t-\r\x85\xa0"
LATIN_SPLIT = re.compile(f"'(?:[stmd]|re|ve|ll)| ?[{_LETTER}]+| ?[{_DIGIT}]+| ?[^{_SPACE}{_LETTER}{_DIGIT}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
_BEYOND_LATIN = re.compile("[^\x00-\u024f]")

def split_pretokens(text: str) -> list[str]:
    if text.isascii() or not _BEYOND_LATIN.search(text):
        return LATIN_SPLIT.findall(text)
    return SPLIT.findall(text)


def _disputed(text: str) -> bool:
    return not text.isascii() and DISPUTED.search(text) is not None


MAX_CACHED_LENGTH = 64


def _byte_chars() -> dict[int, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others follow from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: 256 + k for k, b in enumerate(rest)}


_BYTE_TABLE = "".join(chr(_byte_chars().get(b, b)) for b in range(256))
_token_id = attrgetter("id")


class Pieces(dict):
    """Pre-token to its ids (bytes), encoded where it is missing; at most ``entries`` are held.

    When the young half is full, it becomes the old half and the former old half goes. What is asked for
    again comes back from the old half, so frequent pre-tokens stay. Long ones are held beside them (``long``),
    to be cleared after each text.
    """

    def __init__(self, encode: Callable[[str], bytes], entries: int):
        super().__init__()
        self.encode, self.half, self.old, self.long = encode, entries // 2, {}, {}

    def __missing__(self, pretoken: str) -> bytes:
        short = len(pretoken) <= MAX_CACHED_LENGTH
        ids = (self.old if short else self.long).get(pretoken)
        if ids is None:
            ids = self.encode(pretoken)
        if not short:
            self.long[pretoken] = ids
        elif self.half:
            if len(self) >= self.half:
                self.old = dict(self)
                self.clear()
            self[pretoken] = ids
        return ids


class ByteBpe:
    """One tokenizer in one Python worker. ``frequent`` is the first tier of the lookup (pre-token
    to token count), the second tier a cache of bounded size in this worker."""

    def __init__(self, spec: str, frequent: dict[str, int] | None = None, cache_entries: int = 1_000_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_str(spec)
        d = json.loads(spec)
        pre, added = d.get("pre_tokenizer") or {}, d.get("added_tokens") or []
        # the lookup holds for plain byte-level BPE only; other tokenizers encode whole texts
        self.plain = (d.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
                      and not pre.get("add_prefix_space") and d["model"]["type"] == "BPE" and not d["model"].get("dropout")
                      and not any(a["lstrip"] or a["rstrip"] or a["single_word"] or a["normalized"] for a in added))
        self.special = {a["content"]: a["id"] for a in added}
        self.cut = regex.compile("(" + "|".join(regex.escape(x) for x in sorted(self.special, key=len, reverse=True)) + ")") if added else None
        self.frequent = frequent or {}
        self.cache_entries = cache_entries
        self.counts: dict[str, int] = {}
        self.model = self.tok.model
        self.pieces = Pieces(self._encode, cache_entries)

    def _whole(self, text: str) -> list[int]:
        return self.tok.encode(text, add_special_tokens=False).ids

    def _parts(self, text: str):
        """(is_special, part): special strings are cut out first, as the library does."""
        if self.cut is None or not any(s in text for s in self.special):
            return [(False, text)]
        return [(i % 2 == 1, x) for i, x in enumerate(self.cut.split(text)) if x]

    def count(self, text: str) -> int:
        if not self.plain or _disputed(text):
            return len(self._whole(text))
        total = 0
        for special, part in self._parts(text):
            if special:
                total += 1
                continue
            pre = split_pretokens(part)
            found = list(map(self.frequent.get, pre))
            if None in found:
                miss = [p for p, n in zip(pre, found) if n is None]
                total += sum(n for n in found if n is not None) + self._count_misses(miss)
            else:
                total += sum(found)
        return total

    def _count_misses(self, miss: list[str]) -> int:
        if len(self.counts) > self.cache_entries:
            self.counts.clear()
        counts = self.counts
        new = [p for p in set(miss) if p not in counts]
        long = {}
        for p in new:
            (counts if len(p) <= MAX_CACHED_LENGTH else long)[p] = len(self._tokens(p))
        return sum(counts[p] if p in counts else long[p] for p in miss)

    def ids(self, text: str) -> bytes:
        """The text's ids as little-endian unsigned 32-bit numbers."""
        if not self.plain or _disputed(text):
            return np.asarray(self._whole(text), "<u4").tobytes()
        out = []
        piece = self.pieces.__getitem__
        for special, part in self._parts(text):
            if special:
                out.append(self.special[part].to_bytes(4, "little"))
            else:
                out.extend(map(piece, split_pretokens(part)))
        self.pieces.long.clear()
        return b"".join(out)

    def _tokens(self, pretoken: str) -> list:
        """One pre-token's tokens from the library's merge model, which takes bytes written as characters."""
        return self.model.tokenize(charmap_decode(pretoken.encode("utf-8"), "strict", _BYTE_TABLE)[0])

    def _encode(self, pretoken: str) -> bytes:
        return array("I", map(_token_id, self._tokens(pretoken))).tobytes()


_ENCODERS: dict[str, ByteBpe] = {}


def encoder(key: str, spec: str, frequent=None, cache_entries: int = 1_000_000) -> ByteBpe:
    """The worker's encoder for ``key``; the caches outlive a task. Older ones are dropped."""
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = ByteBpe(spec, frequent() if frequent else None, cache_entries)
    return _ENCODERS[key]


def tokenizer_spec(path: str) -> str:
    """The tokenizer file's text: read by the driver, sent to the workers (a few MB, fixed)."""
    return Path(path).read_text(encoding="utf-8")
