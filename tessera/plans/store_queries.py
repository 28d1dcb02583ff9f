"""Registered store-dimension queries (D1–D7) and their DuckDB oracles."""

from __future__ import annotations


from tessera.operators import stores as D
from tessera.sources import views


def _resolved(spark, d):
    return D.create_missing(views.store_receipts_v(spark, d), views.stores_v(spark, d))


def _final_stores(spark, d):
    matched, new = _resolved(spark, d)
    existing = D.backfill_address(views.stores_v(spark, d), matched)
    return existing.select("id", "name", "address", "category").unionByName(
        new.select("id", "name", "address", "category"))


def d01_normalize(spark, d):
    r = views.store_receipts_v(spark, d)
    return r.select("receipt_id", D.normalize_name("store_name").alias("norm"))


def d02_match_existing(spark, d):
    m = D.match_existing(views.store_receipts_v(spark, d), views.stores_v(spark, d))
    return m.select("receipt_id", "norm", "store_id")


def d03_new_stores(spark, d):
    return _resolved(spark, d)[1].select("id", "name", "address", "category")


def d03_receipt_store(spark, d):
    return _resolved(spark, d)[0].select("receipt_id", "store_id")


def d04_backfill_address(spark, d):
    matched, _ = _resolved(spark, d)
    return D.backfill_address(views.stores_v(spark, d), matched).select("id", "address")


def d05_store_category(spark, d):
    return _final_stores(spark, d).select("id", D.store_category("name").alias("category"))


def d06_category_counts(spark, d):
    return D.category_counts(_final_stores(spark, d))


def d07_store_list(spark, d):
    return D.store_list(_final_stores(spark, d))


# --- oracles ---------------------------------------------------------------------------

def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def _norm_sql(col: str) -> str:
    s = _strip(f"lower({col})")
    parts = " ".join(f"WHEN ends_with({s}, '{suf}') THEN {_strip(f'left({s}, length({s}) - {len(suf)})')}"
                     for suf in D.STORE_SUFFIXES)
    collapsed = f"regexp_replace(CASE {parts} ELSE {s} END, '\\s+', ' ', 'g')"
    return f"coalesce({_strip(collapsed)}, '')"


def _cat_sql(col: str) -> str:
    parts = []
    for cat, words in D.STORE_CATEGORIES:
        cond = " OR ".join(f"contains(lower({col}), '{w}')" for w in words)
        parts.append(f"WHEN {cond} THEN '{cat}'")
    return f"CASE WHEN {col} IS NULL OR {col} = '' THEN 'Other' {' '.join(parts)} ELSE 'Other' END"


_R = f"(SELECT receipt_id, store_name, store_address, {_norm_sql('store_name')} AS norm FROM store_receipts_v)"
_MATCHED = f"""(SELECT r.receipt_id, r.store_name, r.store_address, r.norm,
    (SELECT min(s.id) FROM stores_v s WHERE r.norm <> '' AND contains(lower(s.name), r.norm)) AS store_id FROM {_R} r)"""
# the loop itself, one receipt a step: a receipt that no existing store covers looks at the stores made so far
# (creating receipt and name) and makes its own if none contains its normalized name. Later receipts of a name that
# contains its own normalized form can't create, so the loop leaves them out; their link is looked up afterwards.
_LOOP = f"""cand AS (SELECT receipt_id, store_name, store_address, norm, row_number() OVER (ORDER BY receipt_id) AS k
      FROM (SELECT *, row_number() OVER (PARTITION BY store_name ORDER BY receipt_id) AS rn FROM {_MATCHED}
            WHERE store_id IS NULL AND norm <> '') WHERE rn = 1 OR NOT contains(lower(store_name), norm)),
    loop AS (SELECT CAST(0 AS BIGINT) AS k, CAST([] AS STRUCT(r BIGINT, n VARCHAR)[]) AS made
      UNION ALL
      SELECT cand.k, CASE WHEN len(list_filter(made, lambda m: contains(m.n, cand.norm))) > 0 THEN made
        ELSE list_append(made, {{'r': cand.receipt_id, 'n': lower(cand.store_name)}}) END
      FROM loop JOIN cand ON cand.k = loop.k + 1),
    made AS (SELECT m.r AS first_receipt FROM (SELECT unnest(made) AS m FROM loop WHERE k = (SELECT max(k) FROM loop))),
    new_stores AS (SELECT (SELECT coalesce(max(id), 0) FROM stores_v) + row_number() OVER (ORDER BY receipt_id) AS id, store_name AS name,
      store_address AS address, {_cat_sql('store_name')} AS category, receipt_id AS first_receipt
      FROM cand WHERE receipt_id IN (SELECT first_receipt FROM made))"""
_NEW = "new_stores"
_FINAL_RECEIPTS = f"""(SELECT m.receipt_id, m.store_address, coalesce(m.store_id,
    (SELECT min(n.id) FROM new_stores n WHERE m.store_id IS NULL AND m.norm <> '' AND (n.first_receipt = m.receipt_id
       OR (n.first_receipt < m.receipt_id AND contains(lower(n.name), m.norm))))) AS store_id FROM {_MATCHED} m)"""
_BACKFILLED = f"""(SELECT s.id, s.name, s.category, CASE WHEN s.address IS NULL OR s.address = '' THEN f.a
    ELSE s.address END AS address FROM stores_v s LEFT JOIN (SELECT store_id, arg_min(store_address, receipt_id) AS a
    FROM {_FINAL_RECEIPTS} WHERE store_id IS NOT NULL AND store_address IS NOT NULL AND store_address <> ''
    GROUP BY store_id) f ON s.id = f.store_id)"""
_FINAL = f"(SELECT id, name, address, category FROM {_BACKFILLED} UNION ALL SELECT id, name, address, category FROM {_NEW})"

_WITH = f"WITH RECURSIVE {_LOOP}\n"
STORE_LOOP, STORE_LINKS = _WITH, _FINAL_RECEIPTS  # for the receipts of other sources

ORACLES = {
    "d01_normalize": f"SELECT receipt_id, norm FROM {_R}",
    "d02_match_existing": f"SELECT receipt_id, norm, store_id FROM {_MATCHED}",
    "d03_new_stores": _WITH + f"SELECT id, name, address, category FROM {_NEW}",
    "d03_receipt_store": _WITH + f"SELECT receipt_id, store_id FROM {_FINAL_RECEIPTS}",
    "d04_backfill_address": _WITH + f"SELECT id, address FROM {_BACKFILLED}",
    "d05_store_category": _WITH + f"SELECT id, {_cat_sql('name')} AS category FROM {_FINAL}",
    "d06_category_counts": _WITH + f"""SELECT coalesce(category, 'Other') AS category, count(*) AS n_stores FROM {_FINAL}
        GROUP BY 1 UNION ALL SELECT 'ALL', count(*) FROM {_FINAL}""",
    "d07_store_list": _WITH + f"""SELECT id, name, category, (address IS NOT NULL AND address <> '') AS has_address
        FROM {_FINAL}""",
}

QUERIES = {
    "d01_normalize": d01_normalize,
    "d02_match_existing": d02_match_existing,
    "d03_new_stores": d03_new_stores,
    "d03_receipt_store": d03_receipt_store,
    "d04_backfill_address": d04_backfill_address,
    "d05_store_category": d05_store_category,
    "d06_category_counts": d06_category_counts,
    "d07_store_list": d07_store_list,
}
