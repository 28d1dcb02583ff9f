"""Operator 8: benchmark decontamination by winnowing, in DataFrame functions only.

Both sides keep the smallest k-gram hash of every run of ``window - k + 1`` consecutive
k-grams, that is of every span of ``window`` words, so any span of that length which both
share has a common fingerprint. Fingerprints are joined; each hit is extended: the windows
of the document whose fingerprint was hit are compared with the items' windows as text.
Items shorter than a window are one window of their own length, with a hash of all their
words as its fingerprint; documents are probed for the lengths that the benchmark holds.

Arrays are read by position inside the lambdas (``slice`` would copy the whole array each time).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import hex_sha256, written

# Fixed value: what separates words after A-Z are lower-cased (all ASCII but digits and letters).
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

MAX_BROADCAST_ROWS = 200_000  # fingerprints, windows or hits: some ten MB


def item_words(text: Column) -> Column:
    """Words of a text; null and empty texts have none. Only A-Z are lower-cased."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), SEPARATORS), "")


def _runs(array: Column, n: int, combine) -> Column:
    """``combine`` of the n elements from each position on; empty if there are fewer than n."""
    at = F.transform(F.sequence(F.lit(0), F.greatest(F.size(array) - n, F.lit(0))), lambda i: combine([F.get(array, i + j) for j in range(n)]))
    return F.when(F.size(array) >= n, at).otherwise(F.array().cast("array<bigint>"))


def _with_fingerprints(words: DataFrame, window: int, k: int) -> DataFrame:
    """Adds ``prints``: of the span of ``window`` words at each position, the smallest k-gram hash."""
    grams = words.withColumn("grams", _runs(F.col("words"), k, lambda x: F.xxhash64(*x)))
    return grams.withColumn("prints", _runs(F.col("grams"), window - k + 1, lambda x: F.least(*x))).drop("grams")


def _short_hash(n: int):
    return lambda x: F.xxhash64(F.lit(n), *x)


def _spans(length: int, kept: Column) -> Column:
    """(print, start, length, text) of the windows of one length at every position that passes ``kept``."""
    return F.transform(kept, lambda x: F.struct(
        x["start"].alias("start"), F.lit(length).alias("length"),
        F.concat_ws(" ", *[F.get(F.col("words"), x["start"] + j) for j in range(length)]).alias("span")))


def _positions(prints: Column) -> Column:
    return F.transform(prints, lambda f, i: F.struct(f.alias("print"), i.alias("start")))


def _small(df: DataFrame, counted: DataFrame, bound: int) -> DataFrame:
    """``df`` marked for broadcast if ``counted``, a table with at least as many rows, holds at most ``bound``."""
    return F.broadcast(df) if counted.limit(bound + 1).count() <= bound else df


def row_key(id_col: str | Column, text_col: str | Column) -> Column:
    """A hash of a row's id and text."""
    return F.xxhash64(id_col, text_col)


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", window: int = 10, k: int = 5, max_broadcast: int = MAX_BROADCAST_ROWS,
                  with_row: bool = False) -> DataFrame:
    """One row per document row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, and
    ``with_row`` the row's ``row_key``, as ids may repeat or be null.

    Null and empty texts have no words and aren't contaminated; items without words or
    without an id match nothing; repeated rows and ids stay, each judged by its own text;
    other columns are ignored; empty tables give no hits. Small sides are counted before
    they are broadcast; above ``max_broadcast`` rows the same joins are shuffled.
    """
    keys = ["doc_id", "row"]
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).withColumn("row", row_key("doc_id", "text"))
    words = d.select(*keys, item_words(F.col("text")).alias("words"))
    items = benchmark.select(F.col(item_col).cast("string").alias("item_id"), item_words(F.col(item_text_col)).alias("words"))
    items = written(items.where("size(words) > 0 and item_id is not null"), "items")
    short = sorted(r["n"] for r in items.select(F.size("words").alias("n")).where(F.col("n") < window).distinct().collect())  # below window

    # the items' windows: long items at every position, short ones whole
    long = _with_fingerprints(items.where(F.size("words") >= window), window, k).select(
        "item_id", "words", F.explode(_positions(F.col("prints"))).alias("x"))
    parts = [long.select("item_id", F.col("x.print").alias("print"), F.lit(window).alias("length"),
                         F.array_join(F.slice("words", F.col("x.start") + 1, window), " ").alias("span"))]
    for n in short:
        own = items.where(F.size("words") == n)
        parts.append(own.select("item_id", _short_hash(n)([F.get("words", F.lit(j)) for j in range(n)]).alias("print"), F.lit(n).alias("length"),
                                F.array_join("words", " ").alias("span")))
    spans = parts[0]
    for p in parts[1:]:
        spans = spans.union(p)
    spans = written(spans.distinct(), "item-windows")
    prints = spans.select("print").distinct()

    # one pass over the documents: word counts, and the fingerprints shared with any item
    probes = F.concat(F.array_distinct("prints"), *[F.array_distinct(_runs(F.col("words"), n, _short_hash(n))) for n in short])
    probed = _with_fingerprints(words, window, k).select(
        *keys, F.size("words").alias("n_words"), F.explode(F.concat(F.array(F.lit(None).cast("bigint")), probes)).alias("print"))
    found = probed.join(_small(prints.withColumn("hit", F.lit(True)), spans, max_broadcast), "print", "left").where("hit or print is null")
    seen = found.groupBy(*keys, "n_words").agg(
        F.sum(F.when(F.col("print").isNull(), 1).otherwise(0)).alias("copies"), F.collect_set("print").alias("hit_prints"))
    seen = written(seen, "probed")

    # extension: the hit windows of those documents, as text
    hit_rows = seen.where("size(hit_prints) > 0").select(*keys, "hit_prints")
    same = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & (a["row"] == b["row"])
    few = _small(hit_rows, hit_rows, max_broadcast)
    texts = d.join(few, same(d, few)).select(d["doc_id"], d["row"], "text", "hit_prints")
    texts = _with_fingerprints(texts.select(*keys, "hit_prints", item_words(F.col("text")).alias("words")), window, k)
    hit = lambda xs: F.filter(xs, lambda x: F.array_contains(F.col("hit_prints"), x["print"]))
    cut = [_spans(window, hit(_positions(F.col("prints"))))]
    cut += [_spans(n, hit(_positions(_runs(F.col("words"), n, _short_hash(n))))) for n in short]
    windows = texts.select(*keys, F.inline(F.concat(*cut)))
    matched = windows.join(_small(spans.drop("print"), spans, max_broadcast), ["length", "span"]).select(
        *keys, "start", "length", "item_id")

    covered = F.flatten(F.transform(F.collect_set(F.struct("start", "length")), lambda x: F.sequence(x["start"], x["start"] + x["length"] - 1)))
    by_row = matched.groupBy(*keys).agg(
        F.size(F.array_distinct(covered)).cast("long").alias("n_hit"), F.array_sort(F.collect_set("item_id")).alias("items"))
    out = seen.join(by_row, same(seen, by_row), "left").select(
        seen["doc_id"], *([seen["row"]] if with_row else []), F.col("n_words").cast("long").alias("n_words"), F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        hex_sha256(F.array_join(F.coalesce("items", F.array().cast("array<string>")), ",")).alias("items_sha256"),
        F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("_copy"))
    return out.withColumn("n_items", F.greatest("n_items", F.lit(0).cast("long"))).withColumn("contaminated", F.col("n_hit") > 0).drop("_copy")
