"""Receipt records from text (R3, R14) and the two linked output tables.

Parsing is a per-row projection (no shuffle); items leave the row only when the
``receipt_items`` table is produced, by ``explode``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import receipt_text as RT
from tessera.operators.clean import strip_ws
from tessera.operators.stores import create_missing


def best_candidate(candidates: DataFrame, group_col: str, text_col: str = "text",
                   order_col: str = "candidate_no") -> DataFrame:
    """Per group the longest text after stripping, the first candidate on a tie.

    Only length and number are aggregated (partially in the tasks, so a group with a third of all
    candidates stays small); the winner's text is joined back by group, number and length. A null number comes after all others;
    of texts of the same length and number the smallest is taken."""
    length = F.length(strip_ws(text_col))
    key = F.struct(length.alias("n"), (-F.col(order_col)).alias("neg"))
    best = candidates.groupBy(F.col(group_col).alias("_group")).agg(F.max(key).alias("_key"))
    best = best.select("_group", F.col("_key.n").alias("_n"), (-F.col("_key.neg")).alias("_no"))
    won = candidates.join(best, candidates[group_col].eqNullSafe(best["_group"]) & candidates[order_col].eqNullSafe(best["_no"])
                          & F.length(strip_ws(candidates[text_col])).eqNullSafe(best["_n"]))
    return won.groupBy(group_col, order_col).agg(F.min(text_col).alias(text_col))


def parse(texts: DataFrame, as_of: str, id_col: str = "doc_id", text_col: str = "raw_text",
          partitions: int | None = None) -> DataFrame:
    """One receipt record per text: store, address, date, total, tax, discount, items.

    The text rules are CPU-bound per row; ``partitions`` deals the texts out first, for inputs
    that arrive in fewer splits than there are cores."""
    if partitions:
        texts = texts.repartition(partitions)
    # staged projections: each shared intermediate is one column, computed once per row
    # (the optimizer keeps a projection apart rather than inline an expensive expression twice)
    clean = texts.select(id_col, text_col, RT.ocr_fix(RT.collapsed_text(F.col(text_col))).alias("_clean"))
    lined = clean.withColumn("_lines", RT.lines_of(F.col("_clean")))
    lined = lined.withColumns({"_store": RT.store_flags(F.col("_lines")), "_priced": RT.priced_lines(F.col("_lines"))})
    return lined.select(
        F.col(id_col).alias("receipt_id"),
        RT.store_name_of(F.col("_store")).alias("store_name"),
        RT.store_address_of(F.col("_store")).alias("store_address"),
        RT.receipt_date_of(F.col("_clean"), as_of).alias("receipt_date"),
        RT.total_amount_of(F.col("_priced")).alias("total_amount"),
        RT.tax_amount_of(F.col("_priced")).alias("tax_amount"),
        F.lit(0.0).alias("discount_amount"),
        RT.items_of(F.col("_priced")).alias("items"),
        F.col(text_col).alias("raw_text"),
    )


def link_stores(parsed: DataFrame, stores: DataFrame) -> tuple[DataFrame, DataFrame]:
    """S9 with D2/D3: (parsed receipts with ``store_id``, new stores). Only id, name and address go
    through the resolution; the rest is joined back by id."""
    linked, new = create_missing(parsed.select("receipt_id", "store_name", "store_address"), stores)
    return parsed.join(linked.select("receipt_id", "store_id"), "receipt_id"), new


def receipts_table(parsed: DataFrame) -> DataFrame:
    """The receipts table (no items), with ``store_id`` once the receipts are linked."""
    link = ["store_id"] if "store_id" in parsed.columns else []
    return parsed.select("receipt_id", *link, "store_name", "store_address", "receipt_date", "total_amount",
                         "tax_amount", "discount_amount", "raw_text", F.lit(True).alias("is_processed"))


def items_table(parsed: DataFrame) -> DataFrame:
    """One row per accepted item, linked by ``receipt_id``.

    The outer form of ``explode``: for the other one the optimizer adds a filter on the array's size and moves it below
    the deal of the texts, where it runs the item rules twice more, in the few tasks that read them."""
    return parsed.select("receipt_id", F.explode_outer("items").alias("it")).where(F.col("it").isNotNull()).select("receipt_id", "it.*")


def write_tables(parsed: DataFrame, path: str, stores: DataFrame | None = None) -> tuple[str, str]:
    """Write both tables as Parquet (overwrite is idempotent on a task or job retry). The texts are
    parsed once: the parsed rows are written first and both tables derived from them."""
    r, i = f"{path}/receipts", f"{path}/receipt_items"
    parsed.write.mode("overwrite").parquet(f"{path}/parsed")
    parsed = parsed.sparkSession.read.parquet(f"{path}/parsed")
    receipts_table(link_stores(parsed, stores)[0] if stores is not None else parsed).write.mode("overwrite").parquet(r)
    items_table(parsed).write.mode("overwrite").parquet(i)
    return r, i
