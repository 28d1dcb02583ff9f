"""Apply each question's filters to the receipts and aggregate per question.

Per question the figures are over *all* receipts with ``date >= since AND store contains s AND
amount op v``. Pairing every question with every receipt is quadratic, so the plan works per
distinct filter signature and is built from equi-joins and running sums:

1. A store filter resolves to store names through the n-gram index (``stores.contains_match``);
   signatures without one use the family of all receipts (a flag of its own, so that no store
   name can be mistaken for it).
2. Dates become ranks among the distinct ``since`` values by an as-of join, and ranks lie in a
   binary tree of intervals. "From rank j on" is at most one interval a level, and a receipt is in
   one interval a level, so it is copied log2(distinct dates) times, however many questions ask.
   A family is (all or one store, direction of comparison, interval).
3. Members and the family's thresholds are sorted together by amount over a range partitioning;
   what stands before a threshold is what it matches, so its figures are running sums: inside
   its partition plus the totals of the family's earlier partitions (one row a partition).
   A signature's figures are the sums over its intervals.
4. Stores with a match don't add up over intervals. Per store, the region of (date, threshold) that
   it matches is a staircase, so it is the sum of quadrants at the staircase's steps less those
   at its inner corners: points of weight +1 and -1, which add up like receipts.
5. Every phrase that asks for items also turns the filters off, so the items of a question
   that needs them are those of all receipts: the top lists are found once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators import questions as N
from tessera.operators.asof import asof_join
from tessera.operators.bounded import dense_ids
from tessera.operators.spending import top_categories_by_rows, top_items
from tessera.operators.stores import contains_match
from tessera.session import ensure_checkpoint_dir

_FAMILY = ["every", "grp", "fam", "lev", "cell"]


def _selections(questions: DataFrame, as_of: str) -> DataFrame:
    q = F.col("question")
    amt = N.amount_filter(q)
    all_data = N.needs_all_data(q)
    return questions.select(
        "question_id", N.intent(q).alias("intent"),
        F.when(~all_data, N.time_filter(q, as_of)).alias("since"),
        F.when(~all_data, N.store_filter(q)).alias("store_filter"),
        F.when(~all_data, amt["operator"]).alias("op"),
        F.when(~all_data, amt["value"]).alias("value"),
    )


def _before(rows: DataFrame, thresholds: DataFrame, sums: list[str]) -> DataFrame:
    """Per threshold (family, y, strict): the sums over its family's rows with smaller ``y``, or, if it
    isn't strict, with any ``y``. Rows and thresholds are range-partitioned together and checkpointed,
    so that the offsets and the running sums see the same partitions."""
    spark = rows.sparkSession
    ensure_checkpoint_dir(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    none = [F.lit(0).cast(t).alias(c) for c, t in rows.dtypes if c in sums]
    u = rows.select(*_FAMILY, "y", F.lit(1).alias("kind"), *sums).unionByName(
        thresholds.select(*_FAMILY, "y", F.when(F.col("strict"), 0).otherwise(2).alias("kind"), *none))
    order = [*_FAMILY, "y", "kind"]
    ranged = (u.repartitionByRange(parts, *order).sortWithinPartitions(*order)
              .withColumn("_mid", F.monotonically_increasing_id()).checkpoint(eager=True)
              .withColumn("_pid", F.shiftright("_mid", 33)))
    per_part = ranged.groupBy(*_FAMILY, "_pid").agg(*[F.sum(c).alias(c) for c in sums])
    earlier = Window.partitionBy(*_FAMILY).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select(*_FAMILY, "_pid", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_off_{c}") for c in sums])
    running = Window.partitionBy("_pid", *_FAMILY).orderBy("_mid").rowsBetween(Window.unboundedPreceding, -1)
    run = ranged.select("*", *[F.coalesce(F.sum(c).over(running), F.lit(0)).alias(f"_run_{c}") for c in sums]).where("kind <> 1")
    same = run["_pid"] == offsets["_pid"]
    for c in _FAMILY:
        same &= run[c] == offsets[c]
    return run.join(offsets, same).select(
        *[run[c] for c in _FAMILY], run["y"], (F.col("kind") == 0).alias("strict"),
        *[(F.col(f"_run_{c}") + F.col(f"_off_{c}")).alias(c) for c in sums])


def _since_cells(rank: Column, levels: int) -> Column:
    """The intervals (lev, cell) of the binary tree over ranks 0 .. 2^levels - 1 that make up "from ``rank`` on"."""
    before = rank - 1
    inner = [F.when((rank > 0) & (F.pmod(F.shiftright(before, n), F.lit(2)) == 0),
                    F.struct(F.lit(n).alias("lev"), (F.shiftright(before, n) + 1).alias("cell"))) for n in range(levels)]
    whole = F.when(rank == 0, F.struct(F.lit(levels).alias("lev"), F.lit(0).cast("long").alias("cell")))
    return F.filter(F.array(*inner, whole), lambda x: x.isNotNull())


def _own_cells(rank: Column, levels: int) -> Column:
    """The intervals that a rank is in and that some start can use: those at odd places, and the whole."""
    inner = [F.when(F.pmod(F.shiftright(rank, n), F.lit(2)) == 1, F.struct(F.lit(n).alias("lev"), F.shiftright(rank, n).alias("cell"))) for n in range(levels)]
    return F.filter(F.array(*inner, F.struct(F.lit(levels).alias("lev"), F.lit(0).cast("long").alias("cell"))), lambda x: x.isNotNull())


def _both_groups(rows: DataFrame, levels: int, used: DataFrame) -> DataFrame:
    """Rows (store_name, rank, ...) in the families of all receipts and of their store, as far as those are used."""
    cells = rows.withColumn("_c", F.explode(_own_cells(F.col("rank"), levels))).select("*", "_c.lev", "_c.cell").drop("_c", "rank")
    groups = cells.select(F.lit(True).alias("every"), F.lit("").alias("grp"), "*").unionByName(
        cells.where(F.col("store_name").isNotNull()).select(F.lit(False).alias("every"), F.col("store_name").alias("grp"), "*"))
    return groups.join(used, _FAMILY, "left_semi")


def _staircase(points: DataFrame) -> DataFrame:
    """Points (store_name, fam, rank, y) as weighted ones: for a start j and a threshold, the weights of a store's points with
    rank >= j and y before the threshold add up to 1 if it has such a point, else to 0.

    One row per store, direction and rank is left before anything is sorted."""
    low = points.groupBy("store_name", "fam", "rank").agg(F.min("y").alias("y"))
    later = Window.partitionBy("store_name", "fam").orderBy(F.desc("rank")).rowsBetween(Window.unboundedPreceding, -1)
    steps = low.withColumn("before", F.min("y").over(later)).where(F.col("before").isNull() | (F.col("y") < F.col("before")))
    weighted = F.filter(F.array(F.struct("y", F.lit(1).cast("long").alias("stores")),
                                F.when(F.col("before").isNotNull(), F.struct(F.col("before").alias("y"), F.lit(-1).cast("long").alias("stores")))),
                        lambda x: x.isNotNull())
    return steps.select("store_name", "fam", "rank", F.inline(weighted))


def answer(receipts: DataFrame, questions: DataFrame, as_of: str) -> DataFrame:
    """Per question: intent, matching receipts (``receipt_id`` is their key), spent, stores, average per
    receipt; ``NO_DATA`` when nothing matched. Null amounts match where no amount is asked for."""
    spark = receipts.sparkSession
    ensure_checkpoint_dir(spark)
    sel = _selections(questions, as_of)
    sig_cols = ["store_filter", "op", "value", "since"]
    sel = sel.withColumn("sig", F.to_json(F.struct(*sig_cols)))
    sigs = sel.select("sig", *sig_cols).distinct().checkpoint(eager=True)
    r = receipts.select("receipt_id", "store_name", "receipt_date", "total_amount").where(F.col("receipt_id").isNotNull())

    # 1. store groups of each signature
    filters = sigs.where(F.col("store_filter").isNotNull()).select(F.lower("store_filter").alias("norm")).distinct()
    names = r.select(F.col("store_name").alias("name")).where(F.col("name").isNotNull()).distinct()
    store_hits = contains_match(names.select(F.col("name").alias("id"), "name"), filters)
    keep = ["sig", "op", "value", "since"]
    sig_groups = (sigs.where(F.col("store_filter").isNotNull())
                  .join(store_hits.withColumnRenamed("id", "grp"), F.lower("store_filter") == F.col("norm"))
                  .select(*keep, F.lit(False).alias("every"), "grp")
                  .unionByName(sigs.where(F.col("store_filter").isNull())
                               .select(*keep, F.lit(True).alias("every"), F.lit("").alias("grp"))))
    # 2. dates as ranks among the starts; what comes before all of them, or has no date, has rank 0
    starts = dense_ids(sigs.select("since").where("since is not null").distinct(), ["since"], "rank")
    levels = int(starts.agg(F.coalesce(F.max("rank"), F.lit(0))).first()[0]).bit_length()
    r = asof_join(r, starts.select("since", "rank"), [], "receipt_date", "since", allow_equal=True).drop("since")
    r = r.withColumn("rank", F.coalesce("rank", F.lit(0).cast("long"))).checkpoint(eager=True)

    less = F.col("op") == "less"
    ranked = sig_groups.join(starts.select(F.col("since").alias("_s"), "rank"), F.col("since") == F.col("_s"), "left")
    sig_groups = ranked.select(
        "sig", "every", "grp", F.when(less, "lt").otherwise("gt").alias("fam"),
        F.explode(_since_cells(F.coalesce("rank", F.lit(0).cast("long")), levels)).alias("_c"),
        F.when(less, F.col("value")).when(F.col("op") == "greater", -F.col("value")).otherwise(F.lit(float("inf"))).alias("y"),
        F.col("op").isNotNull().alias("strict")).select("*", "_c.lev", "_c.cell").drop("_c").checkpoint(eager=True)
    thresholds = sig_groups.select(*_FAMILY, "y", "strict").distinct()
    used = thresholds.select(*_FAMILY).distinct()

    # 3. members of families, in the order of either direction
    amount = F.col("total_amount")
    paid = amount.isNotNull() & (amount != 0)
    both = F.array(F.struct(F.lit("lt").alias("fam"), amount.alias("y")), F.struct(F.lit("gt").alias("fam"), (-amount).alias("y")))
    members = r.select("store_name", "rank", paid.alias("paid"), F.lit(1).cast("long").alias("n"),
                       F.when(paid, amount).otherwise(F.lit(0.0)).alias("spent"), F.explode(both).alias("_f"))
    members = members.select("store_name", "rank", "paid", "n", "spent", "_f.fam", F.coalesce("_f.y", F.lit(float("inf"))).alias("y"))
    figures = _before(_both_groups(members.drop("paid"), levels, used), thresholds, ["n", "spent"])
    # 4. stores with a match
    points = _staircase(members.where(F.col("paid") & F.col("store_name").isNotNull()).select("store_name", "fam", "rank", "y"))
    shops = _before(_both_groups(points, levels, used), thresholds, ["stores"])

    def of_signature(found: DataFrame, sums: list[str]) -> DataFrame:
        return sig_groups.join(found, [*_FAMILY, "y", "strict"]).groupBy("sig").agg(*[F.sum(c).alias(c) for c in sums])

    out = (sel.select("question_id", "intent", "sig").join(of_signature(figures, ["n", "spent"]), "sig", "left")
           .join(of_signature(shops, ["stores"]), "sig", "left"))
    n = F.coalesce(F.col("n"), F.lit(0))
    spent = F.when(n > 0, F.coalesce(F.col("spent"), F.lit(0.0))).otherwise(F.lit(0.0))
    return out.select(
        "question_id", F.when(n == 0, F.lit("NO_DATA")).otherwise(F.col("intent")).alias("answer_kind"),
        n.cast("long").alias("total_receipts"), spent.alias("total_spent"),
        F.coalesce(F.col("stores"), F.lit(0)).cast("long").alias("unique_stores"),
        F.when(n > 0, spent / n).otherwise(F.lit(0.0)).alias("average_per_receipt"),
    )


def item_answers(receipts: DataFrame, items: DataFrame, questions: DataFrame, n_items: int = 10, n_categories: int = 5) -> DataFrame:
    """The items of the questions that need them, a row each: question_id, kind (item or category), rank, name, figure (spent on
    the item, or rows of the category). They are over all receipts: every phrase that asks for items turns the filters off.
    Items of receipts that aren't there don't count, nor do items without a name or price, or rows without a category."""
    assert set(N.ITEM_PHRASES) <= set(N.ALL_DATA_PHRASES)
    of_receipts = items.join(receipts.where(F.col("receipt_id").isNotNull()).select("receipt_id"), "receipt_id", "left_semi")
    lists = [("item", top_items(of_receipts, n_items).select(F.col("item_name").alias("name"), F.col("spent").alias("figure"))),
             ("category", top_categories_by_rows(of_receipts, n_categories).select(F.col("category").alias("name"), F.col("items").cast("double").alias("figure")))]
    asked = questions.where(N.needs_items(F.col("question"))).select("question_id")
    out = None
    for kind, top in lists:
        rank = F.row_number().over(Window.orderBy(F.desc("figure"), "name"))  # over the few rows of the list
        rows = top.select(F.struct(rank.alias("rank"), "name", "figure").alias("x")).agg(F.array_sort(F.collect_list("x")).alias("l")).select("l").scalar()
        part = asked.select("question_id", F.lit(kind).alias("kind"), F.inline(rows))
        out = part if out is None else out.unionByName(part)
    return out
