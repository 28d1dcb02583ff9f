"""Operator 7: quality score by a byte-level convolutional network in numpy.

Bytes are embedded, learned filters of 8 bytes run over the whole document (every 4 bytes),
their outputs are max-pooled over overlapping chunks of 1,024 bytes, and the chunks' mean
and maximum are combined into one probability. The network is trained by stochastic gradient
descent (Adam) on at most ``sample_rows`` labelled documents, all their bytes; scoring is one
pass over every whole text, without a shuffle, in memory bounded by a segment and a document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDTH, STRIDE, DIM, FILTERS = 8, 4, 8, 32
BLOCK = 256  # bytes; a chunk is four blocks and shares one with the next
CHUNK_BLOCKS, STEP_BLOCKS = 4, 3
SEGMENT_BLOCKS = 256


class ByteConvNet:
    def __init__(self, seed: int = 11):
        r = np.random.default_rng(seed)
        f = lambda *s, scale: (r.standard_normal(s) * scale).astype(np.float32)
        self.embed = f(256, DIM, scale=0.5)
        self.filters = f(WIDTH * DIM, FILTERS, scale=(WIDTH * DIM) ** -0.5)
        self.bias = np.zeros(FILTERS, np.float32)
        self.out = f(2 * FILTERS, scale=0.1)
        self.off = np.zeros(1, np.float32)

    def params(self) -> list[np.ndarray]:
        return [self.embed, self.filters, self.bias, self.out, self.off]

    @staticmethod
    def _bytes(text: str | None) -> np.ndarray:
        """The text's bytes, filled with zeros to whole blocks (at least one) and one filter more."""
        data = (text or "").encode("utf-8")
        blocks = max(1, -(-len(data) // BLOCK))
        return np.frombuffer(data + bytes(blocks * BLOCK + WIDTH - len(data)), np.uint8)

    def _acts(self, b: np.ndarray) -> np.ndarray:
        """Filter outputs at every STRIDE-th byte of whole blocks ``b`` (WIDTH bytes more follow)."""
        e = self.embed[b]
        n = (len(b) - WIDTH) // WIDTH * WIDTH
        acts = np.empty((n // STRIDE, FILTERS), np.float32)
        acts[0::2] = e[:n].reshape(-1, WIDTH * DIM) @ self.filters
        acts[1::2] = e[STRIDE : n + STRIDE].reshape(-1, WIDTH * DIM) @ self.filters
        return acts

    @staticmethod
    def _chunks(blocks: int) -> list[tuple[int, int]]:
        last = max(0, blocks - CHUNK_BLOCKS)
        starts = [*range(0, last, STEP_BLOCKS), last]
        return [(s, min(blocks, s + CHUNK_BLOCKS)) for s in starts]

    def logit(self, text: str | None) -> float:
        b = self._bytes(text)
        blocks = len(b) // BLOCK
        tops = np.empty((blocks, FILTERS), np.float32)
        for s in range(0, blocks, SEGMENT_BLOCKS):
            e = min(blocks, s + SEGMENT_BLOCKS)
            tops[s:e] = self._acts(b[s * BLOCK : e * BLOCK + WIDTH]).reshape(e - s, BLOCK // STRIDE, FILTERS).max(1)
        pooled = np.maximum(np.stack([tops[s:e].max(0) for s, e in self._chunks(blocks)]) + self.bias, 0)
        return float(np.concatenate([pooled.mean(0), pooled.max(0)]) @ self.out + self.off[0])

    def gradient(self, text: str, y: float) -> list[np.ndarray]:
        """Of the log loss on one document; only the bytes that won a pooling take part."""
        b = self._bytes(text)
        blocks = len(b) // BLOCK
        acts, per = self._acts(b), BLOCK // STRIDE
        chunks = self._chunks(blocks)
        where = np.stack([acts[s * per : e * per].argmax(0) + s * per for s, e in chunks])
        raw = np.take_along_axis(acts, where, 0) + self.bias
        pooled = np.maximum(raw, 0)
        top = pooled.argmax(0)
        x = np.concatenate([pooled.mean(0), pooled.max(0)])
        d = 1 / (1 + np.exp(-np.clip(x @ self.out + self.off[0], -50, 50))) - y
        dp = np.tile(d * self.out[:FILTERS] / len(chunks), (len(chunks), 1))
        dp[top, np.arange(FILTERS)] += d * self.out[FILTERS:]
        dp = np.where(raw > 0, dp, 0).astype(np.float32)
        own = b[where[:, :, None] * STRIDE + np.arange(WIDTH)]  # chunk, filter, byte
        seen = self.embed[own].reshape(len(chunks), FILTERS, WIDTH * DIM)
        gf = np.einsum("cf,cfk->kf", dp, seen)
        ge = np.zeros_like(self.embed)
        np.add.at(ge, own.reshape(-1), (dp[:, :, None] * self.filters.T[None]).reshape(-1, DIM))
        return [ge, gf, dp.sum(0), (d * x).astype(np.float32), np.array([d], np.float32)]

    def train(self, texts: list[str], labels: np.ndarray, epochs: int = 4, batch: int = 16, rate: float = 0.004, seed: int = 5) -> None:
        r = np.random.default_rng(seed)
        ms, vs = [np.zeros_like(p) for p in self.params()], [np.zeros_like(p) for p in self.params()]
        steps, t = max(1, epochs * -(-len(texts) // batch)), 0
        for _ in range(epochs):
            order = r.permutation(len(texts))
            for k in range(0, len(order), batch):
                own = order[k : k + batch]
                total = [np.zeros_like(p) for p in self.params()]
                for i in own:
                    for g, x in zip(total, self.gradient(texts[i], labels[i])):
                        g += x
                t += 1
                now = rate * (1 - 0.95 * t / steps)
                for p, g, m, v in zip(self.params(), total, ms, vs):
                    g /= len(own)
                    m *= 0.9
                    m += 0.1 * g
                    v *= 0.99
                    v += 0.01 * g * g
                    p -= now * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-7)


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 2 when divided by 4; a null id isn't held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        sample_rows: int = 3_000, sample_bytes: int = 16_000_000) -> ByteConvNet | None:
    """A network trained on labelled documents that aren't held out: at most ``sample_rows``, taken by a
    hash of the id, and as many of them as come to ``sample_bytes`` (whole texts). None if a label is missing."""
    chosen = (labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("y"))
              .where("doc_id is not null and y is not null").where(~held_out(F.col("doc_id")))
              .orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(sample_rows))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where("text is not null")
    joined = texts.join(F.broadcast(chosen), "doc_id")
    # the bound on bytes holds for what reaches the driver too: very long texts aren't sampled
    rows = joined.where(F.octet_length("text") <= sample_bytes // 100).orderBy(F.xxhash64("doc_id"), "doc_id", "text").toLocalIterator()
    x, y, n = [], [], 0
    for r in rows:
        n += len(r["text"])
        if n > sample_bytes:
            break
        x.append(r["text"])
        y.append(float(r["y"] == 1))
    if len(set(y)) < 2:
        return None
    net = ByteConvNet()
    net.train(x, np.array(y, np.float32))
    return net


def score(docs: DataFrame, net: ByteConvNet | None, id_col: str = "doc_id", text_col: str = "text", at: float = 0.7) -> DataFrame:
    """One row per input row: doc_id, held_out, score (0 to 1), predicted (1 if score >= ``at``).

    Null and empty texts score as one chunk of zeros; without a network every score is 0.5.
    Repeated rows stay; other columns are ignored; an empty table gives an empty result.
    """

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            z = np.array([net.logit(t) if net else 0.0 for t in texts], float)
            yield pd.Series(1 / (1 + np.exp(-np.clip(z, -500, 500))))

    return (docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"),
                        run(F.coalesce(F.col(text_col), F.lit(""))).alias("score"))
            .withColumn("predicted", F.when(F.col("score") >= at, 1).otherwise(0)))
