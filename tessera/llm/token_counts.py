"""Operator 1: token counts by a map-side two-tier lookup.

Tier one is a compact table of frequent pre-token lengths, broadcast to the workers: at most
``table_entries`` pre-tokens of at most 32 characters, so never more than a few MB. Tier two
is each worker's own bounded cache over what the library encodes. No pre-token is shuffled:
the job is a scan with one Arrow exchange. The table only decides which tier answers; counts
are the library's in any case, so choosing its entries from a bounded sample of documents
(``sample_rows``) changes no result.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.pretokens import ByteBpe, encoder, split_pretokens, tokenizer_spec

MAX_ENTRY_CHARS = 32


def frequent_lengths(docs: DataFrame, spec: str, text_col: str = "text", table_entries: int = 65_536,
                     sample_rows: int = 4_000) -> tuple[bytes, bytes]:
    """The frequent pre-tokens of about ``sample_rows`` documents and their token counts, packed:
    UTF-8 joined by NUL, and one byte a count. Counted per task, then summed by pre-token."""
    n = docs.count()
    sample = docs.select(F.col(text_col).alias("text")).sample(min(1.0, sample_rows / max(n, 1)), seed=7)

    def per_task(batches):
        seen: Counter = Counter()
        for b in batches:
            for t in b["text"].dropna():
                seen.update(p for p in split_pretokens(t) if len(p) <= MAX_ENTRY_CHARS and "\0" not in p)
        top = seen.most_common(table_entries)
        yield pd.DataFrame({"p": pd.Series([x for x, _ in top], dtype=object), "n": np.array([c for _, c in top], "int64")})

    rows = (sample.mapInPandas(per_task, "p string, n long").groupBy("p").agg(F.sum("n").alias("n"))
            .orderBy(F.desc("n"), "p").limit(table_entries).collect())  # at most table_entries rows
    bpe = ByteBpe(spec)
    names = [r["p"] for r in rows]
    sizes = [len(e.ids) for e in bpe.tok.encode_batch(names, add_special_tokens=False)] if names else []
    return "\0".join(names).encode("utf-8"), bytes(min(s, 255) for s in sizes)


def count_tokens(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 1024, table_entries: int = 65_536, sample_rows: int = 4_000) -> DataFrame:
    """One row per input row: id, ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit``.

    ``tokenizer`` is a path: ``.json`` files by tokenizers, ``.model`` files by sentencepiece,
    without added special tokens; strings of special tokens inside a text count as the library
    counts them. Null and empty texts count 0; repeated rows stay repeated; other columns are
    ignored; an empty table gives an empty result. A very long pre-token isn't cached.
    """
    out = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    sc = docs.sparkSession.sparkContext
    if str(tokenizer).endswith(".model"):
        model = sc.broadcast(Path(tokenizer).read_bytes())

        @F.pandas_udf("long")
        def n_tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            import sentencepiece

            sp = sentencepiece.SentencePieceProcessor(model_proto=model.value)
            for texts in batches:
                yield texts.map(lambda t: len(sp.encode(t)) if t else 0).astype("int64")
    else:
        spec = tokenizer_spec(tokenizer)
        shared = sc.broadcast((uuid.uuid4().hex, spec, *frequent_lengths(docs, spec, text_col, table_entries, sample_rows)))

        def table() -> dict[str, int]:
            _, _, names, sizes = shared.value
            return dict(zip(names.decode("utf-8").split("\0"), sizes)) if sizes else {}

        @F.pandas_udf("long")
        def n_tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            bpe = encoder(shared.value[0], shared.value[1], table)
            for texts in batches:
                yield texts.map(bpe.count).astype("int64")

    return out.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), n_tokens("text").alias("n_tokens")).select(
        "*", (F.col("n_tokens") > limit).alias("over_limit"))
