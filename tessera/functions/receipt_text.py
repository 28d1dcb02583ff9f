"""Receipt-text extraction as column expressions over an ``ARRAY<STRING>`` of lines.

Each receipt is one row; every rule is a built-in array/regex expression evaluated in
that row, so the whole extraction is a narrow (shuffle-free) projection. Python's
``\\d \\s \\w`` are Unicode, so every Java pattern here carries ``(?U)``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.numbers import to_double

# --- fixed values: keyword lists and patterns, in the reference's order ---------------
PRICE = r"(\d+\.\d{2})"
DATE_PATTERNS = [
    r"(\d{1,2}[-/.]\d{1,2}[-/.]\d{2,4})",
    r"(\d{4}[-/.]\d{1,2}[-/.]\d{1,2})",
    r"(\d{1,2}\s+\d{1,2}\s+\d{2,4})",
]
DATE_FORMATS = [
    "%d-%m-%Y", "%m-%d-%Y", "%Y-%m-%d",
    "%d/%m/%Y", "%m/%d/%Y", "%Y/%m/%d",
    "%d.%m.%Y", "%m.%d.%Y", "%Y.%m.%d",
    "%d-%m-%y", "%m-%d-%y", "%y-%m-%d",
    "%d/%m/%y", "%m/%d/%y", "%y/%m/%d",
]
TOTAL_KEYWORDS = ["total amt", "total amount", "total", "grand total", "amount due", "balance due",
                  "total amt payable"]
TAX_KEYWORDS = ["tax", "hst", "gst", "pst", "sales tax", "sr @", "sr@"]
STORE_KEYWORDS = ["sdn bhd", "sdn.bhd", "ltd", "inc", "corp", "company", "store", "mart"]
STORE_SKIP_WORDS = ["receipt", "invoice", "gst id", "tax invoice"]
ADDRESS_WORDS = ["jalan", "street", "st", "ave", "road", "rd", "taman", "seksyen"]
IGNORE_PATTERNS = [
    r"gst\s*id", r"tax\s*invoice", r"receipt", r"thank\s*you", r"total\s*amt", r"rounding\s*adjustment",
    r"paid\s*amount", r"change", r"total\s*qty", r"cashier", r"transaction", r"\d+\s*seri\s*kembangan",
    r"selangor", r"darul\s*ehsan", r"jalan\s*sr", r"seksyen", r"taman\s*serdang", r"no\.\s*\d+",
]
IGNORE_KEYWORDS = ["total", "subtotal", "tax", "change", "cash", "credit", "debit", "receipt", "thank you",
                   "cashier", "transaction", "invoice", "gst", "amount", "paid", "rounding", "balance"]
# a line that one of the other patterns fits holds one of the keywords, which are looked for first
IGNORE_RARE = [p for p in IGNORE_PATTERNS if not any(w in p for w in IGNORE_KEYWORDS)]
QTY_PATTERNS = [r"(\d+)\s*x\s*", r"(\d+)\s*@\s*", r"(\d+)\s+qty", r"qty\s*(\d+)"]
ITEM_CATEGORIES = [
    ("Stationery", ["pencil", "pen", "paper", "notebook", "eraser", "ruler", "stapler", "faber", "castell",
                    "pilot", "stabilo"]),
    ("Food & Beverages", ["coffee", "tea", "soda", "water", "juice", "beer", "wine", "drink", "snack", "chip",
                          "candy"]),
    ("Dairy", ["milk", "cheese", "butter", "yogurt", "cream"]),
    ("Meat & Seafood", ["chicken", "beef", "pork", "fish", "turkey", "ham", "bacon", "seafood"]),
    ("Produce", ["apple", "banana", "orange", "lettuce", "tomato", "potato", "onion", "fruit", "vegetable"]),
    ("Bakery", ["bread", "bagel", "muffin", "cake", "cookies", "pastry"]),
    ("Personal Care", ["shampoo", "soap", "toothpaste", "deodorant", "lotion"]),
    ("Household", ["detergent", "tissue", "paper towel", "cleaner", "toilet paper"]),
    ("Electronics", ["battery", "charger", "cable", "phone", "computer"]),
]
OCR_PRICE = r"\$?[\dOolIS]+\.[\dOolIS]+"
OCR_DECIMAL = r"\b[\dOolIS]+\.[\dOolIS]+\b"
OCR_FROM, OCR_TO = "OolIS", "00115"
MAX_ITEM_PRICE = 10000.0


def _u(p: str) -> str:
    return "(?U)" + p


def _any(text: Column, words: list[str]) -> Column:
    cond = None
    for w in words:
        c = text.contains(w)
        cond = c if cond is None else cond | c
    return cond


def strip(c: Column) -> Column:
    return F.regexp_replace(c, _u(r"^\s+|\s+$"), "")


def collapse(c: Column) -> Column:
    """``' '.join(line.split())``; single spaces aren't touched, and only spaces are left to trim."""
    return F.trim(F.regexp_replace(c, _u(r" \s+|[\s&&[^ ]]\s*"), " "))


def _fix_pass(line: Column, pattern: str) -> Column:
    """Replace OCR look-alike letters inside every match of ``pattern`` (one left-to-right pass)."""
    pieces = F.split(line, _u(pattern), -1)
    fixed = F.transform(F.regexp_extract_all(line, F.lit(_u(pattern)), 0), lambda m: F.translate(m, OCR_FROM, OCR_TO))
    return F.array_join(F.zip_with(pieces, fixed, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")


# A text can change only if some number-like token holds one of the look-alike letters;
# testing that first (one cached pattern) skips the split/extract work on almost every text.
_OCR_SUSPECT = r"[OolIS][\dOolIS]*\.[\dOolIS]+|[\dOolIS]+\.[\dOolIS]*[OolIS]"


def ocr_fix(text: Column) -> Column:
    """R2: digits repaired inside price-like tokens, then inside bounded decimals. No token reaches over a line's
    end, so a text of many lines is repaired as its lines are."""
    return F.when(text.rlike(_u(_OCR_SUSPECT)), _fix_pass(_fix_pass(text, OCR_PRICE), OCR_DECIMAL)).otherwise(text)


def collapsed_text(text: Column) -> Column:
    """R1 over the whole text: lines stripped, spaces in them collapsed, empty lines dropped."""
    spaced = F.regexp_replace(F.coalesce(text, F.lit("")), _u(r" [\s&&[^\n]]+|[\s&&[^ \n]][\s&&[^\n]]*"), " ")
    return F.btrim(F.regexp_replace(spaced, r" \n[ \n]*|\n[ \n]+", "\n"), F.lit(" \n"))


def lines_of(clean_text: Column) -> Column:
    return F.filter(F.split(clean_text, "\n", -1), lambda x: x != "")


def clean_lines(text: Column, fix_ocr: bool = True) -> Column:
    """R1 (+R2): split on newlines, strip, collapse spaces, drop empty lines."""
    clean = collapsed_text(text)
    return lines_of(ocr_fix(clean) if fix_ocr else clean)


def store_flags(lines: Column) -> Column:
    """First 8 lines with their flags, each computed once per line (R4/R5 share it)."""
    def lowered(x, i):
        return F.struct(i.alias("pos"), x.alias("line"), F.lower(x).alias("low"))
    def flags(s):
        x = s["line"]
        return F.struct(s["pos"].alias("pos"), x.alias("line"), s["low"].alias("low"),
                        ((F.length(x) >= 3) & ~x.rlike(_u(r"^\d+$"))).alias("eligible"),
                        _any(s["low"], STORE_KEYWORDS).alias("kw"))
    def business(s):
        x = s["line"]
        return F.struct(s["pos"].alias("pos"), x.alias("line"), s["low"].alias("low"), s["eligible"].alias("eligible"),
                        s["kw"].alias("kw"),
                        # lines are collapsed: one space between words, none at the ends
                        (~s["kw"] & (F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit(""))) >= 1)
                         & ~x.rlike(_u(r"^[\d\s\-\.]+$"))
                         & ~_any(s["low"], STORE_SKIP_WORDS)).alias("biz"))
    return F.transform(F.transform(F.transform(F.slice(lines, 1, 8), lowered), flags), business)


def store_name(lines: Column) -> Column:
    """Last keyword line among the first 8, else the first business-like line before it."""
    return store_name_of(store_flags(lines))


def store_name_of(flagged: Column) -> Column:
    kw = F.filter(flagged, lambda s: s["eligible"] & s["kw"])
    biz = F.filter(flagged, lambda s: s["eligible"] & s["biz"])
    return F.coalesce(F.try_element_at(kw, F.lit(-1))["line"], F.try_element_at(biz, F.lit(1))["line"],
                      F.lit("Unknown Store"))


def store_address(lines: Column) -> Column:
    """After the first store line and before line 8 (index < 7), non-keyword lines with a
    digit then a word char, an address word, or five digits; joined by ``, ``."""
    return store_address_of(store_flags(lines))


def store_address_of(flagged: Column) -> Column:
    """One ordered pass (``aggregate``) over the flagged lines: the first keyword or
    business line opens the address section; later eligible non-keyword lines with an
    address shape before index 7 are collected."""
    def is_addr(s):
        x = s["line"]
        return _any(s["low"], ADDRESS_WORDS) | x.rlike(_u(r"\d.*\w"))  # five digits are a digit and a word character, too

    start = F.struct(F.lit(False).alias("found"), F.array().cast("array<string>").alias("acc"))

    def step(st, s):
        take = st["found"] & s["eligible"] & ~s["kw"] & (s["pos"] < 7) & is_addr(s)
        return F.struct((st["found"] | (s["eligible"] & (s["kw"] | s["biz"]))).alias("found"),
                        F.when(take, F.array_append(st["acc"], s["line"])).otherwise(st["acc"]).alias("acc"))
    picked = F.aggregate(flagged, start, step)["acc"]
    return F.when(F.size(picked) > 0, F.array_join(picked, ", "))


_DATE_SHAPE = r"^\d{1,4}([-/.])\d{1,2}\1\d{1,4}$"


def _date_parts(s: Column) -> Column:
    """Separator and the three parts of a text of date shape."""
    return F.struct(F.regexp_extract(s, "[-/.]", 0).alias("sep"), F.split(s, "[-/.]").alias("parts"))


def _date_fields(x: Column) -> Column:
    """Lengths and numbers of the parts, read once."""
    fields = [F.struct(F.length(x["parts"][i]).alias("len"), x["parts"][i].cast("int").alias("n")).alias(f"p{i + 1}") for i in range(3)]
    return F.struct(x["sep"].alias("sep"), *fields)


def _parse_formats(x: Column) -> Column:
    """First of the 15 formats that fits the parts (two-digit years pivot at 69, as strptime). At most three fit any
    shape, and only those are made into dates (which rejects impossible ones, and the year 0)."""
    out = []
    for fmt in DATE_FORMATS:
        roles = fmt.split(fmt[2])
        ok, value = x["sep"] == fmt[2], {}
        for i, role in enumerate(roles):
            p = x[f"p{i + 1}"]
            ok = ok & (p["len"] == {"%Y": 4, "%y": 2}[role] if role in ("%Y", "%y") else p["len"] <= 2)
            value[role] = p["n"]
        year = value["%Y"] if "%Y" in value else value["%y"] + F.when(value["%y"] >= 69, 1900).otherwise(2000)
        zero = F.lit(0)
        made = F.try_make_timestamp_ntz(F.when(year > 0, year), value["%m"], value["%d"], zero, zero, zero)
        out.append(F.when(ok, made))
    return F.coalesce(*out)


def receipt_date(lines: Column, as_of: str) -> Column:
    """Patterns in order, their matches in order, formats in order; else ``as_of``."""
    return receipt_date_of(F.array_join(lines, "\n"), as_of)


def receipt_date_of(text: Column, as_of: str) -> Column:
    per_pattern = []
    for p in DATE_PATTERNS:
        matches = F.regexp_extract_all(text, F.lit(_u(p)), 1)
        def norm(m):
            return F.regexp_replace(strip(F.regexp_replace(m, _u(r"[^\d\-/.]"), " ")), _u(r"\s+"), "-")
        normed = F.transform(matches, norm)
        shaped = F.transform(F.transform(F.filter(normed, lambda x: x.rlike(_DATE_SHAPE)), _date_parts), _date_fields)
        parsed = F.filter(F.transform(shaped, _parse_formats), lambda d: d.isNotNull())
        per_pattern.append(F.try_element_at(parsed, F.lit(1)))
    return F.coalesce(*per_pattern, F.lit(as_of).cast("timestamp_ntz"))


def priced_lines(lines: Column) -> Column:
    """The lines with a price: position, text, lower-case text, all prices and the last one's value. What amounts and items are read from."""
    def prices_of(x, i):
        return F.struct(i.alias("pos"), x.alias("line"), F.when(x.contains("."), F.regexp_extract_all(x, F.lit(_u(PRICE)), 1)).alias("prices"))
    def lowered(s):
        return F.struct(s["pos"].alias("pos"), s["line"].alias("line"), F.lower(s["line"]).alias("low"), s["prices"].alias("prices"),
                        to_double(F.element_at(s["prices"], -1)).alias("last"))
    return F.transform(F.filter(F.transform(lines, prices_of), lambda s: F.coalesce(F.size(s["prices"]) >= 1, F.lit(False))), lowered)


def _last_price(priced: Column, wanted) -> Column:
    """The rightmost price of the last line that is ``wanted`` by its lower-case text; else 0."""
    return F.coalesce(F.try_element_at(F.filter(priced, lambda s: wanted(s["low"])), F.lit(-1))["last"], F.lit(0.0))


def total_amount(lines: Column) -> Column:
    """Last line with a total keyword and a price → its rightmost price; else 0."""
    return total_amount_of(priced_lines(lines))


def total_amount_of(priced: Column) -> Column:
    return _last_price(priced, lambda low: _any(low, TOTAL_KEYWORDS))


def tax_amount(lines: Column) -> Column:
    """Last line with a tax keyword, no ``total``, and a price; else 0."""
    return tax_amount_of(priced_lines(lines))


def tax_amount_of(priced: Column) -> Column:
    return _last_price(priced, lambda low: _any(low, TAX_KEYWORDS) & ~low.contains("total"))


def is_ignored(low: Column) -> Column:
    """R9, of a line in lower case: ignore keywords (substring), mostly numbers, or ignore patterns (search)."""
    return (_any(low, IGNORE_KEYWORDS) | low.rlike(_u(r"^[\d\s\-\.]+$"))
            | low.rlike(_u("|".join(f"(?:{p})" for p in IGNORE_RARE))))


def item_category(name: Column) -> Column:
    """First category whose keyword occurs in the name; else ``Other``."""
    return F.when(name.isNull() | (name == ""), "Other").otherwise(_category_of(F.lower(name)))


def _category_of(low: Column) -> Column:
    expr = None
    for cat, words in ITEM_CATEGORIES:
        expr = F.when(_any(low, words), cat) if expr is None else expr.when(_any(low, words), cat)
    return expr.otherwise("Other")


def _remove_prices(line: Column, prices: Column) -> Column:
    def drop(acc, p):
        quoted = F.concat(F.lit(r"\Q"), p, F.lit(r"\E"))
        acc = F.regexp_replace(acc, F.concat(F.lit(r"(?U)\b"), quoted, F.lit(r"\b")), F.lit(""))
        return F.replace(acc, F.concat(F.lit("$"), p), F.lit(""))
    return F.aggregate(prices, line, drop)


def items(lines: Column) -> Column:
    """Accepted items in line order."""
    return items_of(priced_lines(lines))


def items_of(priced: Column) -> Column:
    """R9–R13 from the lines with a price.

    Staged ``transform``s: every intermediate (cleaned name, its lower case, quantity match) is a
    struct field computed once per line, since lambdas get no common-subexpression reuse. Names hold
    no white space but spaces once they are collapsed, so a trim of spaces strips them.
    """
    cands = F.filter(priced, lambda s: (F.length(s["line"]) >= 3) & (F.size(s["prices"]) <= 3) & ~is_ignored(s["low"]))

    def named(s):
        name0 = F.trim(F.regexp_replace(collapse(_remove_prices(s["line"], s["prices"])), _u(r"[^\w\s\-]"), " "))
        return F.struct(s["pos"].alias("pos"), s["prices"].alias("prices"), name0.alias("name0"))
    stage = F.filter(F.transform(cands, named), lambda s: F.length(s["name0"]) >= 2)

    def lowered(s):
        return F.struct(s["pos"].alias("pos"), s["prices"].alias("prices"), s["name0"].alias("name0"), F.lower(s["name0"]).alias("low"))
    stage = F.transform(stage, lowered)

    def qty_groups(s):
        return F.struct(s["pos"].alias("pos"), s["prices"].alias("prices"), s["name0"].alias("name0"),
                        *[F.regexp_extract(s["low"], _u(p), 1).alias(f"g{i}") for i, p in enumerate(QTY_PATTERNS)])
    stage = F.transform(stage, qty_groups)

    def resolved(s):
        qty_text, name = None, None
        for i, p in enumerate(QTY_PATTERNS):
            hit = s[f"g{i}"] != ""
            removed = F.trim(F.regexp_replace(s["name0"], "(?iU)" + p, ""))
            qty_text = F.when(hit, s[f"g{i}"]) if qty_text is None else qty_text.when(hit, s[f"g{i}"])
            name = F.when(hit, removed) if name is None else name.when(hit, removed)
        return F.struct(s["pos"].alias("pos"),
                        to_double(F.try_element_at(s["prices"], F.lit(-1))).alias("total"),
                        F.coalesce(to_double(qty_text), F.lit(1.0)).alias("qty"),
                        name.otherwise(s["name0"]).alias("name"))
    stage = F.filter(F.transform(stage, resolved), lambda s: s["qty"] > 0)

    def cut(s):
        return F.struct(s["pos"].alias("pos"), s["total"].alias("total"), s["qty"].alias("qty"),
                        F.substring(s["name"], 1, 255).alias("item_name"), F.lower(s["name"]).alias("low"))
    stage = F.filter(F.transform(stage, cut), lambda s: (s["total"] <= MAX_ITEM_PRICE)                   # R12
                     & (F.length(F.trim(s["item_name"])) >= 3)                                           # and the record constraint
                     & ~s["item_name"].rlike(_u(r"^[\d\s\-\.\$]+$")))

    def finished(s):
        return F.struct(
            (s["pos"] + 1).alias("line_no"), s["item_name"].alias("item_name"), s["qty"].alias("quantity"),
            (s["total"] / s["qty"]).alias("unit_price"), s["total"].alias("total_price"), _category_of(s["low"]).alias("category"))
    return F.transform(stage, finished)
