"""Store dimension: normalize, match, create, backfill, categorize, summarize.

Matching is "store name contains the receipt's normalized name" (case-insensitive). A
substring test cannot be an equi-join; it is a search in the sorted suffixes of the store names
(``contains_match``), so what is looked at is what matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.asof import asof_join
from tessera.operators.bounded import dense_ids, saved
from tessera.operators.clean import strip_ws
from tessera.session import ensure_checkpoint_dir

# --- fixed values: suffixes and store categories, in the reference's order ------------
STORE_SUFFIXES = ["sdn bhd", "sdn.bhd", "ltd", "limited", "inc", "incorporated", "corp", "corporation",
                  "company", "co.", "pte ltd"]
STORE_CATEGORIES = [
    ("Stationery", ["stationery", "book", "office", "supplies"]),
    ("Grocery", ["supermarket", "market", "grocery", "mart", "hypermarket"]),
    ("Restaurant", ["restaurant", "cafe", "coffee", "food", "kitchen", "dining"]),
    ("Pharmacy", ["pharmacy", "medical", "health", "clinic"]),
    ("Department Store", ["department", "shopping", "mall", "center"]),
    ("Convenience Store", ["convenience", "7-eleven", "mini mart", "express"]),
    ("Electronics", ["electronic", "tech", "computer", "mobile"]),
    ("Clothing", ["fashion", "apparel", "clothing", "boutique"]),
]


def normalize_name(name) -> Column:
    """Lower, strip, drop the first suffix (list order) the name ends with, collapse spaces.

    The stripped name is bound once (a one-element ``transform``) so the eleven suffix tests
    do not each re-run the strip regex."""
    name = F.col(name) if isinstance(name, str) else name

    def cut(x: Column) -> Column:
        expr = None
        for suf in STORE_SUFFIXES:
            rest = strip_ws(F.substring(x, F.lit(1), F.length(x) - len(suf)))
            expr = F.when(x.endswith(suf), rest) if expr is None else expr.when(x.endswith(suf), rest)
        return expr.otherwise(x)

    out = F.element_at(F.transform(F.array(strip_ws(F.lower(name))), cut), 1)
    return F.coalesce(strip_ws(F.regexp_replace(out, r"(?U)\s+", " ")), F.lit(""))


def store_category(name) -> Column:
    """First category whose keyword occurs in the lower-cased name; else ``Other``."""
    name = F.col(name) if isinstance(name, str) else name
    low = F.lower(name)
    expr = None
    for cat, words in STORE_CATEGORIES:
        cond = None
        for w in words:
            c = low.contains(w)
            cond = c if cond is None else cond | c
        expr = F.when(cond, cat) if expr is None else expr.when(cond, cat)
    return F.when(name.isNull() | (name == ""), "Other").otherwise(expr.otherwise("Other"))


def contains_match(stores: DataFrame, names: DataFrame, store_id="id", store_name="name",
                   norm_col="norm", lowest: bool = False) -> DataFrame:
    """(norm, id) for every store whose lower-cased name contains ``norm`` (non-blank), or with ``lowest``
    for the lowest id alone.

    A name contains ``norm`` where one of its suffixes begins with it. Suffixes and norms are sorted together once, and each suffix takes
    the last norm before it (an as-of join on the text). A norm that the suffix begins with is that one or
    one that that one begins with itself, so each norm carries the norms it begins with, and only those are tested.
    """
    low = stores.select(F.col(store_id).alias("_sid"), F.lower(F.col(store_name)).alias("_low")).where(F.length("_low") > 0)
    wanted = saved(names.select(F.col(norm_col).alias("_norm")).where(F.col(norm_col) != "").distinct(), "norms")
    longest = wanted.agg(F.coalesce(F.max(F.length("_norm")), F.lit(0))).first()[0]
    starts = lambda text: F.sequence(F.lit(1), F.length(text))
    begins = wanted.select("_norm", F.explode(F.transform(starts("_norm"), lambda i: F.substring("_norm", F.lit(1), i))).alias("_part"))
    chains = begins.join(wanted.select(F.col("_norm").alias("_part")), "_part").groupBy("_norm").agg(F.collect_list("_part").alias("_chain"))
    suffixes = low.select("_sid", F.explode(F.transform(starts("_low"), lambda i: F.substring("_low", i, F.lit(longest)))).alias("_suffix"))
    if lowest:
        suffixes = suffixes.groupBy("_suffix").agg(F.min("_sid").alias("_sid"))
    met = asof_join(suffixes, chains, [], "_suffix", "_norm", allow_equal=True)
    hits = met.select("_sid", F.explode(F.filter("_chain", lambda n: F.startswith(F.col("_suffix"), n))).alias(norm_col))
    hits = hits.groupBy(norm_col).agg(F.min("_sid").alias(store_id)) if lowest else hits.select(norm_col, F.col("_sid").alias(store_id)).distinct()
    return hits


def match_existing(receipts: DataFrame, stores: DataFrame) -> DataFrame:
    """Each receipt's store id = lowest id whose name contains its normalized name, or NULL.

    Normalization and matching run once per distinct store name (a dimension), and the
    name → (norm, store id) map is joined back to the receipts (null-safe on the name).
    """
    names = saved(receipts.select("store_name").distinct().withColumn("norm", normalize_name("store_name")), "stores")
    hits = contains_match(stores, names, lowest=True).withColumnRenamed("id", "store_id")
    name_map = names.join(hits, "norm", "left").withColumnRenamed("store_name", "_name")
    joined = receipts.join(name_map, receipts["store_name"].eqNullSafe(name_map["_name"]), "left")
    return joined.drop("_name")


def _creating_names(first: DataFrame, covers: DataFrame) -> DataFrame:
    """The names whose first receipt creates a store: those that no earlier creating name covers.

    ``first``: (store_name, norm, receipt_id) of each name's first receipt; ``covers``: (norm,
    name), the store name containing that norm. Names without an earlier covering one create;
    what a creating name covers doesn't; the rest is decided in the next round, so the number
    of rounds is the longest chain of names inside names.
    """
    later = first.select(F.col("store_name").alias("later"), "norm", F.col("receipt_id").alias("_at"))
    earlier = first.select(F.col("store_name").alias("earlier"), F.col("receipt_id").alias("_before"))
    by_norm = covers.select("norm", F.col("name").alias("earlier"))
    pairs = saved(later.join(by_norm, "norm").join(earlier, "earlier").where(F.col("_before") < F.col("_at")).select("later", "earlier"), "stores")
    open_names = first.select("store_name")
    creating = None
    while True:
        made = saved(open_names.join(pairs.select(F.col("later").alias("store_name")), "store_name", "left_anti"), "stores")
        creating = made if creating is None else creating.unionByName(made)
        covered = saved(pairs.join(made.withColumnRenamed("store_name", "earlier"), "earlier").select(F.col("later").alias("store_name")).distinct(), "stores")
        decided = made.unionByName(covered)
        open_names = saved(open_names.join(decided, "store_name", "left_anti"), "stores")
        if open_names.isEmpty():
            return creating
        # pairs of undecided names only: a covered name creates nothing and so covers nothing
        left = open_names.select("store_name")
        pairs = saved(pairs.join(left.withColumnRenamed("store_name", "later"), "later").join(
            left.withColumnRenamed("store_name", "earlier"), "earlier").select("later", "earlier"), "stores")


def create_missing(receipts: DataFrame, stores: DataFrame) -> tuple[DataFrame, DataFrame]:
    """D2+D3: (receipts with ``store_id``, new stores).

    Equals the reference's loop over receipts in id order: a receipt takes the lowest store, old or
    created by an earlier receipt, whose name contains its normalized name; without one it
    creates a store under its own name and address (category by D5) and takes that. Ids follow
    ``max(id)`` in order of the creating receipts. Receipts with a blank name get no store.

    Decided per distinct name: only a name's first receipt can create, or, where a name doesn't
    contain its own normalized form (inner double spaces), any of its receipts that no earlier
    creating name covers.
    """
    # used several times below: written once to the shared checkpoint folder (cuts lineage too)
    ensure_checkpoint_dir(receipts.sparkSession)
    receipts, stores = saved(receipts, "stores"), saved(stores.select("id", "name"), "stores")
    matched = saved(match_existing(receipts, stores), "stores")
    rest = matched.where(F.col("store_id").isNull() & (F.col("norm") != ""))
    first = saved(rest.groupBy("store_name", "norm").agg(F.min("receipt_id").alias("receipt_id")), "stores")
    covers = saved(contains_match(first.select(F.col("store_name").alias("id"), F.col("store_name").alias("name")).distinct(),
                                  first.select("norm").distinct()).withColumnRenamed("id", "name"), "stores")
    creating = _creating_names(first, covers)
    earliest = (covers.join(first.join(creating, "store_name").select(F.col("store_name").alias("name"), "receipt_id"), "name")
                .groupBy("norm").agg(F.min("receipt_id").alias("_from")))
    # a receipt links to the earliest creating receipt that covers it, or creates
    linked = saved(matched.join(earliest, "norm", "left").withColumn("_from", F.when(
        F.col("store_id").isNull() & (F.col("norm") != ""), F.least(F.coalesce("_from", "receipt_id"), F.col("receipt_id")))), "stores")
    start = stores.select(F.coalesce(F.max("id"), F.lit(0)).cast("long")).scalar()
    makers = linked.where(F.col("_from") == F.col("receipt_id")).select("receipt_id", "store_name", "store_address").distinct()
    new = dense_ids(makers, ["receipt_id"], "id", offset=start).select(
        "id", F.col("store_name").alias("name"), F.col("store_address").alias("address"),
        store_category(F.col("store_name")).alias("category"), F.col("receipt_id").alias("first_receipt"))
    new = saved(new, "stores")
    ids = new.select(F.col("id").alias("new_id"), F.col("first_receipt").alias("_from"))
    out = linked.join(ids, "_from", "left").withColumn("store_id", F.coalesce("store_id", "new_id"))
    return out.select(*matched.columns), new.drop("first_receipt")


def backfill_address(stores: DataFrame, matched: DataFrame) -> DataFrame:
    """A store without an address takes the first non-empty one among its receipts."""
    first = matched.where(F.col("store_id").isNotNull() & F.col("store_address").isNotNull()
                          & (F.col("store_address") != "")).groupBy("store_id").agg(
        F.min_by("store_address", "receipt_id").alias("_new_addr"))
    s = stores.join(first, stores["id"] == first["store_id"], "left")
    addr = F.when(F.col("address").isNull() | (F.col("address") == ""), F.col("_new_addr")).otherwise(
        F.col("address"))
    return s.select(*[c for c in stores.columns if c != "address"], addr.alias("address"))


def category_counts(stores: DataFrame) -> DataFrame:
    """Stores per category (NULL → Other) plus the total as a rollup row ``ALL``."""
    cat = F.coalesce(F.col("category"), F.lit("Other")).alias("category")
    return stores.rollup(cat).agg(F.count(F.lit(1)).alias("n_stores")).select(
        F.coalesce("category", F.lit("ALL")).alias("category"), "n_stores")


def store_list(stores: DataFrame) -> DataFrame:
    """D7."""
    return stores.select("id", "name", "category",
                         (F.col("address").isNotNull() & (F.col("address") != "")).alias("has_address"))
