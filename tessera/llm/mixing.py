"""Operator 12: mixing sources to target weights by a low-discrepancy schedule (DataFrame functions only).

Targets. Sources in code point order (null last) carry repeating weights and share a multiple of
all words; a target stops at ``most`` times its source's size and the excess is shared again by weight until
no target is above.

Blocks. A source's documents are shuffled by a hash of the row and laid end to end; cuts every
``block_words`` words give equal blocks (the last of a source may be short), so a block may begin and end inside documents.

Schedule. The mix has as many slots as the targets need blocks, M. Slot i has the golden-ratio point
x = i * g mod M, where g is a number next to M / 1.618..., coprime to M, with a continued fraction g / M as near to the
golden ratio's (all quotients 1) as there is; cumulative targets cut 0 .. M - 1 into one interval a source, and the slot goes to the source whose interval holds its point. As i -> x is
one to one, each source gets just its number of slots, spread evenly over any stretch of the mix. A source's slots are
ranked, and its r-th slot takes its r-th block, from the first block again after the last.

Nothing is gathered: intervals are unrolled in two steps, so a source with a third of all words is spread over tasks; running sums
go by buckets of a source, never over a whole source in one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.shared import written
from tessera.operators.bounded import dense_ids

WORD = r"[^\x20\x09-\x0D]+"
BUCKET_ROWS = 1 << 14  # rows of a source that one window task sorts, about
CHUNK = 1 << 12  # slots that one row of a source's interval unrolls to
MOST_SLOTS = 1 << 40  # products of two halves stay in 64 bits
GOLDEN = (1 + 5**0.5) / 2


def _running(df: DataFrame, within: list[str], bucket: str, order: list[str], value: Column | str, out: str) -> DataFrame:
    """``out`` = sum of ``value`` over the rows before, by (bucket, order) within ``within``. Two levels: a bucket's
    rows meet in one task, and so do the buckets' sums, one row a bucket."""
    keys = [*within, bucket]
    sums = df.groupBy(*keys).agg(F.sum(value).alias("_sum"))
    over = Window.partitionBy(*within) if within else Window
    sums = sums.select(*keys, F.coalesce(F.sum("_sum").over(over.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    own = F.coalesce(F.sum(value).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return df.join(sums, keys).withColumn(out, F.col("_before") + own).drop("_before")


def golden_step(n: int, near: int = 300) -> int:
    """A number coprime to ``n`` next to n / golden ratio; of those, the one whose continued fraction has the smallest
    quotients, as the points' unevenness grows with their sum."""

    def quotients(g: int) -> tuple[int, int]:
        a, b, total = n, g, 0
        while b:
            a, b, total = b, a % b, total + a // b
        return (total, g) if a == 1 else (n + 1, g)

    mid, near = round(n / GOLDEN), min(near, math.isqrt(n))
    return min(quotients(g) for g in range(max(1, mid - near), min(n, mid + near) + 1))[1] if n > 1 else 1


def row_keys(docs: DataFrame, seed: str, id_col: str = "doc_id", text_col: str = "text") -> Column:
    """A hash of id and text (null like empty): the shuffled place of a row. Rows that share it are alike."""
    return F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(docs[id_col].cast("string"), F.lit("")),
                             F.md5(F.coalesce(docs[text_col], F.lit("")).cast("binary"))).cast("binary"))


def targets(sized: DataFrame, weights: Sequence[int], share: float, most: int) -> DataFrame:
    """A row per source: source, s (place from 0), rows, source_size, target. ``sized`` has source and size.

    Every round is one aggregate over the sources' table and hands two numbers to the driver."""
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows")).withColumn("none", F.col("source").isNull())
    per = dense_ids(per, ["none", "source"], "s", offset=-1).drop("none")
    per = written(per.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("s") % len(weights) + 1).cast("int")).cast("double")), "sources")
    size = F.col("source_size").cast("double")
    total = per.agg(F.sum(size), F.sum("weight")).first()
    rest, weight = share * (total[0] or 0.0), total[1] or 1.0
    everything = rest
    while True:
        above = F.lit(rest) * F.col("weight") / F.lit(weight) > most * size
        r = per.agg(F.sum(F.when(above, most * size)), F.sum(F.when(~above, F.col("weight")))).first()
        now = everything - (r[0] or 0.0), r[1] or 0.0
        if now == (rest, weight) or not now[1]:
            break
        rest, weight = now
    return per.select("source", "s", "rows", "source_size", F.when(above, most * size).otherwise(F.lit(rest) * F.col("weight") / F.lit(weight)).alias("target"))


def place(sized: DataFrame, per: DataFrame) -> DataFrame:
    """Each row's first word in its source's shuffled stream (``at``)."""
    rows = sized.join(per.select("source", "s", "rows"), sized["source"].eqNullSafe(per["source"])).drop(per["source"])
    buckets = F.ceil(F.col("rows") / BUCKET_ROWS)
    high = F.conv(F.substring("key", 1, 7), 16, 10).cast("long")  # 28 bits, in the order of the key
    rows = rows.withColumn("bucket", F.floor(high * buckets / float(1 << 28)))
    return _running(rows, ["s"], "bucket", ["key"], "size", "at").drop("bucket", "rows")


def schedule(per: DataFrame, block_words: int) -> DataFrame:
    """A row per slot: slot (place in the mix), s, epoch, block, words (the most that it takes of the block)."""
    words, size = F.floor("target"), F.col("source_size")
    per = per.select("s", "source_size", words.alias("words"), F.ceil(size / block_words).alias("blocks"),
                     F.when(size > 0, F.floor(words / size)).otherwise(0).cast("long").alias("epochs"))
    per = per.withColumn("over", F.col("words") - F.col("epochs") * size)
    per = per.withColumn("slots", (F.col("epochs") * F.col("blocks") + F.ceil(F.col("over") / block_words)).cast("long")).where("slots > 0")
    per = _running(per.withColumn("bucket", F.floor(F.col("s") / BUCKET_ROWS)), [], "bucket", ["s"], "slots", "first")
    per = written(per, "quotas")
    n = per.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0]
    if n >= MOST_SLOTS:
        raise ValueError(f"{n} slots; take larger blocks than {block_words} words")
    back = pow(golden_step(n), -1, n) if n > 1 else 0
    m = F.lit(max(n, 1))
    # the interval of a source, unrolled to its points in two steps; the first deals them out
    chunks = per.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("slots") - 1) / CHUNK))))
    chunks = chunks.repartition("s", "chunk").withColumn("from", F.col("first") + F.col("chunk") * CHUNK)
    points = chunks.withColumn("x", F.explode(F.sequence("from", F.least(F.col("from") + CHUNK, F.col("first") + F.col("slots")) - 1)))
    half = 1 << 20
    high = F.pmod(F.floor(F.col("x") / half) * F.lit(back), m) * half
    points = points.withColumn("slot", F.pmod(high + F.pmod(F.col("x"), F.lit(half)) * F.lit(back), m))
    width = F.ceil(m / F.ceil(F.col("slots") / BUCKET_ROWS))
    points = points.select("s", "blocks", "epochs", "over", "slot", F.floor(F.col("slot") / width).alias("bucket"))
    points = written(points, "points")  # later joins see its true size, which an unrolled column hides
    ranked = _running(points, ["s"], "bucket", ["slot"], F.lit(1), "rank")
    out = ranked.select("s", "slot", F.floor(F.col("rank") / F.col("blocks")).alias("epoch"), F.pmod("rank", F.col("blocks")).alias("block"), "epochs", "over")
    last = F.least(F.lit(block_words), F.col("over") - F.col("block") * block_words)
    return out.select("s", "slot", "epoch", "block", F.when(F.col("epoch") < F.col("epochs"), block_words).otherwise(last).cast("long").alias("words"))


def sizes(docs: DataFrame, seed: str = "mix", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """source, doc_id, key and size (words; 0 for null) of every row: the only scan of the texts."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(source_col).alias("source"), F.col(id_col).alias("doc_id"), row_keys(docs, seed, id_col, text_col).alias("key"),
                       F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"))


def mix(sized: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: int = 2, block_words: int = 256) -> tuple[DataFrame, DataFrame]:
    """The mix, and its sources. ``sized`` comes from ``sizes`` (best written: it is read twice).

    The mix has a row per document and slot that takes words of it (slot, s, epoch, block, doc_id, key, size, at, start, n_words: the words from
    ``start`` on), and one with null slot and no words for a document's part that no slot takes, so every
    document is there. Null texts and texts without words have size 0 and no slot; null sources are one source, the last; repeated
    ids and equal rows are documents of their own; further columns are ignored; an empty table gives no rows.
    ``weights`` are positive and finite in number.
    """
    per = written(targets(sized, weights, share, most), "targets")
    placed = place(sized, per)
    end = F.col("at") + F.col("size")
    block = F.explode_outer(F.when(F.col("size") > 0, F.sequence(F.floor(F.col("at") / block_words), F.floor((end - 1) / block_words))))
    pieces = placed.select("s", "doc_id", "key", "size", "at", block.alias("block"))
    slots = schedule(per, block_words).withColumnRenamed("words", "limit")
    joined = pieces.join(slots, ["s", "block"], "left")
    begin = F.col("block") * block_words
    start = F.greatest(begin - F.col("at"), F.lit(0).cast("long"))
    stop = F.least(F.col("size"), begin + F.col("limit") - F.col("at"))
    return joined.select("slot", "s", "epoch", "block", "doc_id", "key", "size", "at", start.alias("start"),
                         F.when(F.col("slot").isNotNull(), F.greatest(stop - start, F.lit(0))).otherwise(0).cast("long").alias("n_words")), per


def taken(sized: DataFrame, **how) -> DataFrame:
    """A row per document: doc_id, size, source, source_size, target, taken (words the mix takes, repeats counted)."""
    pieces, per = mix(sized, **how)
    # a document with words has its own place; those without words may share one
    some = pieces.where("size > 0").groupBy("s", "at").agg(F.first("doc_id").alias("doc_id"), F.first("size").alias("size"), F.sum("n_words").alias("taken"))
    none = sized.where("size = 0").select("source", "doc_id", "size", F.lit(0).cast("long").alias("taken"))
    some = some.join(per, "s").select("doc_id", "size", "source", "source_size", "target", "taken")
    none = none.join(per, none["source"].eqNullSafe(per["source"])).select("doc_id", "size", per["source"], "source_size", "target", "taken")
    return some.unionByName(none)


def texts(docs: DataFrame, pieces: DataFrame, seed: str = "mix", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pieces that a slot takes, with their words joined by a space (``piece``): sort by slot, at to read the mix."""
    words = docs.select(row_keys(docs, seed, id_col, text_col).alias("key"), F.regexp_extract_all(F.col(text_col), F.lit(WORD), F.lit(0)).alias("_words"))
    cut = pieces.where("slot is not null and n_words > 0").join(words.dropDuplicates(["key"]), "key")
    return cut.withColumn("piece", F.array_join(F.slice("_words", (F.col("start") + 1).cast("int"), F.col("n_words").cast("int")), " ")).drop("_words")
