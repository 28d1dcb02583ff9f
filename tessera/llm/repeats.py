"""Operator 5: removal of repeated passages by fixed-block anchors.

Every document's non-overlapping blocks of ``block`` words (at word 0, block, 2 block, ...) are
the index; every rolling run of ``block`` words of every document probes it. With
window = 2 block - 1, a window holds exactly one whole block, so a window that occurs twice
has a block that some other position's probe hits. Windows around hit blocks are extended:
their whole word sequence is hashed and counted over the corpus; those that start at two
positions or more are repeated, and maximal runs of them are the maximal exact repeats.

Data flow: documents are dealt once into batches of bounded size; the three passes over them
(probe, extend, remove) read the same exchange. What travels between batches is packed: per
batch and bin a sorted array of distinct hashes (4 bytes a probe, 8 bytes a window, with a
bit for those that occur twice in the batch), and bits in reply. Bits stand for a batch's
distinct hashes in sorted order, never for rows: the passes may see a batch's rows in
different orders, as a shuffle's blocks arrive. A passage that a third of
the corpus shares is one entry a batch. Bins and batches grow in number with the input, so
no task's share does. Hashes have 32 (probes: only a filter) or 64 bits besides the bin's.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import U64, bins_for, kgrams, mix, split_words, total_bytes, word_hashes

_SECOND_BASE = 0xC2B2AE3D27D4EB4F


class _Batch:
    """The words of a batch's texts, as one array of hashes, and its runs."""

    def __init__(self, texts, block: int, window: int):
        self.words = [split_words(t) for t in texts]
        self.sizes = np.array([len(w) for w in self.words], "int64")
        total = int(self.sizes.sum())
        self.hashes = word_hashes((x for w in self.words for x in w), total)
        starts = np.concatenate([[0], np.cumsum(self.sizes)[:-1]]) if len(self.sizes) else np.zeros(0, "int64")
        self.starts = starts
        self.local = np.arange(total) - np.repeat(starts, self.sizes)
        self.left = np.repeat(self.sizes, self.sizes) - self.local  # words from here to the document's end
        self.block, self.window = block, window

    def probes(self, bins: int) -> tuple[np.ndarray, np.ndarray]:
        """(bin and 32-bit hash in one number, at a block) of every run of ``block`` words."""
        ok = np.flatnonzero(self.left >= self.block)
        h = mix(kgrams(self.hashes, self.block))[ok]
        return _placed(h, bins), self.local[ok] % self.block == 0

    def blocks(self, bins: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the whole blocks, and their numbers as in ``probes``."""
        at = np.flatnonzero((self.left >= self.block) & (self.local % self.block == 0))
        return at, _placed(mix(kgrams(self.hashes, self.block))[at], bins)

    def candidates(self, hot: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Starts of the windows whose whole block (positions ``at``) is hot."""
        is_hot = np.zeros(len(self.local) + self.block, bool)
        is_hot[at[hot]] = True
        pos = np.flatnonzero(self.left >= self.window)
        return pos[is_hot[pos + (-self.local[pos]) % self.block]]

    def windows(self, pos: np.ndarray, bins: int) -> tuple[np.ndarray, np.ndarray]:
        """(bin, 64-bit hash) of the windows at ``pos``."""
        one = mix(kgrams(self.hashes, self.window))[pos]
        two = mix(kgrams(self.hashes, self.window, _SECOND_BASE))[pos]
        return (two >> U64(20)) % U64(bins), one


def _placed(h: np.ndarray, bins: int) -> np.ndarray:
    return ((h >> U64(32)) % U64(bins)) << U64(32) | (h & U64(0xFFFFFFFF))


def _bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def _flags(bits: bytes, n: int) -> np.ndarray:
    if len(bits) != -(-n // 8):
        raise ValueError(f"{len(bits)} bytes of flags for {n} hashes: a batch changed between two passes")
    return np.unpackbits(np.frombuffer(bits, np.uint8), count=n).astype(bool)


def _cuts(bin_of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a sorted array: its values, and where each one's run begins and ends."""
    values, first = np.unique(bin_of, return_index=True)
    return values, first, np.append(first[1:], len(bin_of))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = 18,
                   batch_bytes: int = 4 << 20, bin_bytes: int = 6 << 20, with_text: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_sha256, and ``with_text`` the kept words.

    A word goes if a window of 2 ``block`` - 1 words that covers it starts anywhere else too, the
    same document included; windows are judged on the input. Null and empty texts have no
    words; repeated rows repeat each other; other columns are ignored; an empty table gives an
    empty result. One batch (``batch_bytes`` of text, or one longer document) and one bin
    (the hashes of ``bin_bytes`` of text) are in a task's memory at a time.
    """
    spark, window = docs.sparkSession, 2 * block - 1
    id_type = dict(docs.dtypes)[id_col]
    n = total_bytes(docs, text_col)
    batches, bins = bins_for(spark, n, batch_bytes), bins_for(spark, n, bin_bytes)
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    d = d.withColumn("batch", F.pmod(F.xxhash64("doc_id", "text"), F.lit(batches)))

    def probe(key, pdf: pd.DataFrame) -> pd.DataFrame:
        b = _Batch(pdf["text"], block, window)
        v, aligned = b.probes(bins)
        order = np.argsort(v, kind="stable")
        v, aligned = v[order], aligned[order]
        u, first, count = np.unique(v, return_index=True, return_counts=True)
        is_block = np.logical_or.reduceat(aligned, first) if len(u) else aligned
        names, lo, hi = _cuts(u >> U64(32))
        small = (u & U64(0xFFFFFFFF)).astype("<u4")
        return _frame({"bin": names.astype("int64"), "batch": np.full(len(names), key[0]),
                       "hashes": [small[a:z].tobytes() for a, z in zip(lo, hi)],
                       "twice": [_bits(count[a:z] > 1) for a, z in zip(lo, hi)],
                       "blocks": [_bits(is_block[a:z]) for a, z in zip(lo, hi)]})

    def answer_probes(key, pdf: pd.DataFrame) -> pd.DataFrame:
        own = [np.frombuffer(x, "<u4") for x in pdf["hashes"]]
        blocks = [_flags(x, len(h)) for x, h in zip(pdf["blocks"], own)]
        often = _repeated(own, pdf["twice"])
        return _frame({"batch": pdf["batch"].to_numpy(), "bin": pdf["bin"].to_numpy(),
                       "bits": [_bits(_in_sorted(h[f], often)) for h, f in zip(own, blocks)]})

    def extend(key, pdf: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        b = _Batch(pdf["text"], block, window)
        at, v = b.blocks(bins)
        u, back = np.unique(v, return_inverse=True)
        hot = _answers(u >> U64(32), replies)
        bin_of, h = b.windows(b.candidates(hot[back], at), bins)
        order = np.lexsort((h, bin_of))
        bin_of, h = bin_of[order], h[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (bin_of[1:] != bin_of[:-1])
        first = np.flatnonzero(new)
        twice = np.diff(np.append(first, len(h))) > 1
        u, bin_u = h[first], bin_of[first]
        names, lo, hi = _cuts(bin_u)
        # which blocks are hot is kept for the last pass: a row that only passes through a bin
        return _frame({"bin": np.append(names, U64(key[0] % bins)).astype("int64"), "batch": np.full(len(names) + 1, key[0]),
                       "kind": np.append(np.zeros(len(names), "int32"), 1),
                       "hashes": [*(u[a:z].astype("<u8").tobytes() for a, z in zip(lo, hi)), b""],
                       "twice": [*(_bits(twice[a:z]) for a, z in zip(lo, hi)), len(hot).to_bytes(8, "little") + _bits(hot)]})

    def answer_windows(key, pdf: pd.DataFrame) -> pd.DataFrame:
        ask = pdf["kind"] == 0
        own = [np.frombuffer(x, "<u8") for x in pdf["hashes"][ask]]
        often = _repeated(own, pdf["twice"][ask])
        through = pdf[~ask]
        return _frame({"batch": np.append(pdf["batch"][ask], through["batch"]), "bin": np.append(pdf["bin"][ask], through["bin"]),
                       "kind": np.append(np.zeros(len(own), "int32"), np.ones(len(through), "int32")),
                       "bits": [*(_bits(_in_sorted(h, often)) for h in own), *through["twice"]]})

    names = ["doc_id", "n_words", "n_removed", "kept_sha256"] + (["text"] if with_text else [])

    def remove(key, pdf: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        b = _Batch(pdf["text"], block, window)
        at, v = b.blocks(bins)
        u, back = np.unique(v, return_inverse=True)
        through = replies[replies["kind"] == 1]["bits"].iloc[0]
        if int.from_bytes(through[:8], "little") != len(u):
            raise ValueError(f"{int.from_bytes(through[:8], 'little')} blocks before, {len(u)} now: a batch changed between two passes")
        pos = b.candidates(_flags(through[8:], len(u))[back], at)
        bin_of, h = b.windows(pos, bins)
        order = np.lexsort((h, bin_of))
        hs, bs = h[order], bin_of[order]
        new = np.ones(len(hs), bool)
        new[1:] = (hs[1:] != hs[:-1]) | (bs[1:] != bs[:-1])
        hit = np.zeros(len(hs), bool)
        if len(hs):
            hit[order] = _answers(bs[new], replies[replies["kind"] == 0])[np.cumsum(new) - 1]
        edge = np.zeros(len(b.local) + 1, "int32")  # windows don't cross documents
        np.add.at(edge, pos[hit], 1)
        np.add.at(edge, pos[hit] + window, -1)
        gone = np.cumsum(edge[:-1]) > 0
        rows = []
        for doc, words, s, k in zip(pdf["doc_id"], b.words, b.starts, b.sizes):
            mine = gone[s : s + k]
            kept = b" ".join([w for w, g in zip(words, mine.tolist()) if not g] if mine.any() else words)
            rows.append([doc, k, mine.sum(), hashlib.sha256(kept).hexdigest()] + ([kept.decode("utf-8")] if with_text else []))
        return pd.DataFrame(rows, columns=names, dtype=object)

    by_batch = d.groupBy("batch")
    probes = by_batch.applyInPandas(probe, "bin long, batch long, hashes binary, twice binary, blocks binary")
    hot = probes.groupBy("bin").applyInPandas(answer_probes, "batch long, bin long, bits binary")
    asked = by_batch.cogroup(hot.groupBy("batch")).applyInPandas(extend, "bin long, batch long, kind int, hashes binary, twice binary")
    known = asked.groupBy("bin").applyInPandas(answer_windows, "batch long, bin long, kind int, bits binary")
    schema = f"doc_id {id_type}, n_words long, n_removed long, kept_sha256 string" + (", text string" if with_text else "")
    return by_batch.cogroup(known.groupBy("batch")).applyInPandas(remove, schema)


def _frame(columns: dict) -> pd.DataFrame:
    return pd.DataFrame({k: pd.Series(v, dtype=object) if isinstance(v, list) else v for k, v in columns.items()})


def _repeated(own: list[np.ndarray], twice) -> np.ndarray:
    """Sorted hashes that occur in two of the arrays, or twice in the batch of one."""
    if not own:
        return np.zeros(0, "<u8")
    u, count = np.unique(np.concatenate(own), return_counts=True)
    more = np.concatenate([h[_flags(t, len(h))] for h, t in zip(own, twice)])
    return np.union1d(u[count > 1], more)


def _in_sorted(h: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(values):
        return np.zeros(len(h), bool)
    i = np.minimum(np.searchsorted(values, h), len(values) - 1)
    return values[i] == h


def _answers(bin_of: np.ndarray, replies: pd.DataFrame) -> np.ndarray:
    """The replies' bits laid out for entries sorted by bin."""
    out = np.zeros(len(bin_of), bool)
    names, lo, hi = _cuts(bin_of)
    where = {int(b): (a, z) for b, a, z in zip(names, lo, hi)}
    for b, bits in zip(replies["bin"], replies["bits"]):
        if int(b) in where:
            a, z = where[int(b)]
            out[a:z] = _flags(bits, z - a)
    return out
