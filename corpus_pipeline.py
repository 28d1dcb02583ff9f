"""A corpus pipeline of five stages over ``documents``.

Each stage works on everything that its predecessor kept, as Parquet written to the shared
folder and read again; all but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tessera.llm import near_dedup, packing, secret_scan, toxicity
from tessera.llm.decontaminate import contamination, row_key
from tessera.llm.shared import documents, ship_package, written
from tessera.sources.tables import table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents marked toxic go; the model is fitted on the labelled ones."""
    ship_package(spark)
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: one document of each group stays."""
    ship_package(spark)
    return near_dedup.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents that hold a window of a benchmark item go; each row by its own text, without an id too."""
    hit = contamination(docs, table(spark, sf_dir, "benchmark"), with_row=True).where("contaminated").select("doc_id", "row").distinct()
    hit = written(hit, "contaminated")
    same = docs["doc_id"].eqNullSafe(hit["doc_id"]) & (row_key(docs["doc_id"], docs["text"]) == hit["row"])
    return docs.join(hit, same, "left_anti")


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: found spans are replaced by a mark; no document goes."""
    ship_package(spark)
    return secret_scan.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: pieces of sequences of at most 1024 tokens."""
    ship_package(spark)
    # workers that earlier stages have used keep a smaller cache
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), cache_entries=200_000)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("packing", pack_sequences),
]

# A fitted model and a tokenizer aren't expressible in SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
