"""Question-text classification as columns over a table of questions.

Every rule is an ordered ``when`` chain of substring tests or regex extractions; the
clock is an explicit ``as_of`` argument.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.numbers import to_double, to_long

# --- fixed values: phrase lists and patterns, in the reference's order ---------------
TIME_PHRASES = [
    (["last week", "past week", "this week"], 7),
    (["last month", "past month", "this month"], 30),
    (["last 3 months", "past 3 months"], 90),
    (["last year", "past year", "this year"], 365),
    (["yesterday"], 1),
]
TODAY_PHRASE = "today"
NOTHING_AFTER = "9999-12-31 00:00:00"
DAYS_PATTERN = r"(?:last|past)\s+(\d+)\s+days?"
STORE_PATTERNS = [r"at\s+([a-zA-Z\s&]+)", r"from\s+([a-zA-Z\s&]+)", r"in\s+([a-zA-Z\s&]+)"]
AMOUNT_PATTERNS = [
    (r"over\s+\$?(\d+(?:\.\d{2})?)", "greater"),
    (r"more than\s+\$?(\d+(?:\.\d{2})?)", "greater"),
    (r"above\s+\$?(\d+(?:\.\d{2})?)", "greater"),
    (r"less than\s+\$?(\d+(?:\.\d{2})?)", "less"),
    (r"under\s+\$?(\d+(?:\.\d{2})?)", "less"),
    (r"below\s+\$?(\d+(?:\.\d{2})?)", "less"),
]
INTENTS = [
    ("ITEM", ["what", "item", "product", "buy", "bought", "purchase", "frequently", "frequent"]),
    ("SPENDING", ["how much", "total spent", "spent", "cost", "money"]),
    ("STORE", ["where", "store", "shop", "place", "location"]),
    ("TIME", ["when", "date", "time", "recent", "last", "this week", "month"]),
    ("COMPARISON", ["compare", "vs", "versus", "difference", "more", "less"]),
    ("SUMMARY", ["summary", "overview", "tell me", "show me", "analyze"]),
]
ALL_DATA_PHRASES = ["compare", "comparison", "different stores", "vs", "versus",
                    "what", "item", "items", "buy", "bought", "frequently", "frequent", "purchase"]
ITEM_PHRASES = ["item", "items", "buy", "bought", "frequently", "frequent", "purchase", "what"]


def _any(text: Column, phrases: list[str]) -> Column:
    cond = None
    for p in phrases:
        c = text.contains(p)
        cond = c if cond is None else cond | c
    return cond


def time_filter(question: Column, as_of: str) -> Column:
    """Lower bound on receipt time, or NULL. First matching rule wins."""
    q = F.lower(question)
    now = F.lit(as_of).cast("timestamp_ntz")
    expr = None
    for phrases, days in TIME_PHRASES:
        val = now - F.make_interval(days=F.lit(days))
        expr = F.when(_any(q, phrases), val) if expr is None else expr.when(_any(q, phrases), val)
    expr = expr.when(q.contains(TODAY_PHRASE), F.date_trunc("day", now).cast("timestamp_ntz"))
    n_days = F.regexp_extract(q, "(?U)" + DAYS_PATTERN, 1)
    # a day count that reaches before the first date matches nothing, as it does in the reference's overflow
    n = to_long(n_days)
    known = n <= F.datediff(now, F.lit("0001-01-01").cast("date"))
    back = F.when(known, now - F.make_interval(days=F.when(known, n).cast("int"))).otherwise(F.lit(NOTHING_AFTER).cast("timestamp_ntz"))
    expr = expr.when(n_days != "", back)
    return expr


def store_filter(question: Column) -> Column:
    """Text after ``at``, then ``from``, then ``in`` (first match of each), kept when
    its trimmed length exceeds 2."""
    expr = None
    for p in STORE_PATTERNS:
        name = F.regexp_replace(F.regexp_extract(question, "(?iU)" + p, 1), r"(?U)^\s+|\s+$", "")
        cond = F.length(name) > 2
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    return expr


def amount_filter(question: Column) -> Column:
    """``struct(operator, value)`` from the first matching pattern, or NULL."""
    q = F.lower(question)
    expr = None
    for p, op in AMOUNT_PATTERNS:
        v = F.regexp_extract(q, "(?U)" + p, 1)
        val = F.struct(F.lit(op).alias("operator"), to_double(v).alias("value"))
        expr = F.when(v != "", val) if expr is None else expr.when(v != "", val)
    return expr


def intent(question: Column) -> Column:
    """First intent whose phrase list hits, else FALLBACK."""
    q = F.lower(question)
    expr = None
    for name, phrases in INTENTS:
        expr = F.when(_any(q, phrases), name) if expr is None else expr.when(_any(q, phrases), name)
    return expr.otherwise("FALLBACK")


def needs_all_data(question: Column) -> Column:
    """Broad questions ignore every filter."""
    return _any(F.lower(question), ALL_DATA_PHRASES)


def needs_items(question: Column) -> Column:
    """Item questions also fetch the receipts' items."""
    return _any(F.lower(question), ITEM_PHRASES)


def classify(questions, as_of: str, text_col: str = "question"):
    """N1–N5 for a DataFrame of questions."""
    q = F.col(text_col)
    return questions.select(
        "*", time_filter(q, as_of).alias("since"), store_filter(q).alias("store_filter"),
        amount_filter(q).alias("amount_filter"), intent(q).alias("intent"),
        needs_all_data(q).alias("needs_all_data"), needs_items(q).alias("needs_items"),
    )
