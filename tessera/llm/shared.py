"""Helpers of the training-data operators: word hashes, k-grams, written tables, components.

Words are byte strings split on the six ASCII white-space bytes; hashes are 64-bit. All
intermediate tables go to the session's shared checkpoint folder (``spark.checkpoint.dir``),
so a lost executor costs a recomputed stage and never a wrong row.
"""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterable
from pathlib import Path

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import shared_dir
from tessera.sources.tables import table

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1  # odd multiplier of the polynomial k-gram hash


_SHIPPED: set[str] = set()
ARROW_ROWS = 1_000


def ship_package(spark: SparkSession) -> None:
    """Gives the executors' Python this package (as ``--py-files`` would), once per application, and bounds
    the rows of an Arrow batch, as whole texts are exchanged."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":  # the default
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp()) / f"{root.name}.zip"  # read by the driver's file server only
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(path))
    _SHIPPED.add(sc.applicationId)


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a table in the shared folder: cuts lineage, gives later plans its true size."""
    path = shared_dir(df.sparkSession, f"llm-{purpose}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return table(spark, sf_dir, "documents")


def total_bytes(docs: DataFrame, text_col: str = "text") -> int:
    """UTF-8 bytes of a text column: one narrow scan, one number."""
    return docs.agg(F.coalesce(F.sum(F.octet_length(text_col).cast("long")), F.lit(0)).alias("n")).first()["n"]


def bins_for(spark: SparkSession, n_bytes: int, bytes_per_bin: int) -> int:
    """Bins that keep each bin near ``bytes_per_bin`` whatever the input size, and one at least for each
    shuffle partition. No more than that: what goes from bins to other bins has a row a pair."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_bytes // bytes_per_bin))


def split_words(text: str | None, lower: bool = False) -> list[bytes]:
    """Maximal runs of bytes other than space and 0x09-0x0D; ``lower`` maps A-Z only."""
    if not text:
        return []
    data = text.encode("utf-8")
    return (data.lower() if lower else data).split()


def word_hashes(words: Iterable[bytes], n: int) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), U64, n)


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer: spreads every input bit over the whole 64-bit word."""
    h = h ^ (h >> U64(33))
    h = h * U64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> U64(33))
    h = h * U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U64(33))


def kgrams(h: np.ndarray, k: int, base: int = _BASE) -> np.ndarray:
    """Unmixed polynomial hash of every run of ``k`` values, by doubling; length n - k + 1."""
    if len(h) < k:
        return h[:0]
    m = 1 << 64
    out, have, power, width = None, 0, h, 1
    rest = k
    while rest:
        if rest & 1:
            if out is None:
                out, have = power, width
            else:  # out covers the first `have` values, power the next `width`
                n = len(power) - have
                out = out[:n] * U64(pow(base, width, m)) + power[have : have + n]
                have += width
        rest >>= 1
        if rest:
            power = power[: len(power) - width] * U64(pow(base, width, m)) + power[width:]
            width *= 2
    return out[: len(h) - k + 1]


def component_labels(edges: DataFrame, purpose: str = "components") -> DataFrame:
    """Connected components of undirected ``edges`` (a, b): rows (node, component), the
    component being its smallest node. Nodes without an edge to another node are absent.

    Contraction in rounds: every node merges with the node of smallest random rank within two
    steps, edges are renamed to what their ends merged into, loops fall away. A star is done
    in one round, a path shrinks by a constant factor. All tables stay distributed; each
    round's tables are written to the shared folder. Group sums are map-side combined, and
    the joins of a hot centre are splittable (one side has one row a key).
    """
    rank = lambda c: F.struct(F.xxhash64(c).alias("r"), F.col(c).alias("n"))
    edges = written(edges.select("a", "b").where("a <> b").distinct(), purpose)
    labels = None
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy("a").agg(F.min(rank("b")).alias("low")).select(F.col("a").alias("b"), F.least(F.col("low"), rank("a")).alias("low"))
        # the least of the neighbours' least: it is never above a node's own
        parent = both.join(near, "b").groupBy(F.col("a").alias("node")).agg(F.min("low").alias("low"))
        parent = written(parent.select("node", F.col("low.n").alias("parent")), purpose)
        if labels is None:
            labels = parent.select("node", F.col("parent").alias("root"))
        else:
            up = parent.select(F.col("node").alias("root"), F.col("parent").alias("up"))
            labels = written(labels.join(up, "root", "left").select("node", F.coalesce("up", "root").alias("root")), purpose)
        pa = parent.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
        pb = parent.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
        moved = edges.join(pa, "a").join(pb, "b").select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
        edges = written(moved.where("a <> b").distinct(), purpose)
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    low = labels.groupBy("root").agg(F.min("node").alias("component"))
    return written(labels.join(low, "root").select("node", "component"), purpose)


def hex_sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)
