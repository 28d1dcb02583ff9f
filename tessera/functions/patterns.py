"""Fixed values that results depend on: patterns, keyword lists, token lists.

They must equal the reference's values for identical results; they are stated here
once, as plain text, in the reference's order. Java regexes: ``(?i)`` case-insensitive,
``(?U)`` Unicode ``\\d \\s \\w`` like Python's ``re``.
"""

# --- fixed values: customer profile -------------------------------------------------
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
PHONE_PATTERN = r"^[\+]?[\d\s\-\(\)\.x]+$"
PHONE_INTERNATIONAL = r"^\+"
PHONE_STANDARD = r"^[\d\-\s\(\)\.]+$"

INDUSTRY_SEGMENTS = [
    ("Technology", r"(tech|software|digital|cyber|IT|systems)"),
    ("Financial", r"(bank|financial|invest|capital|fund)"),
    ("Healthcare", r"(health|medical|pharma|bio|care)"),
    ("Manufacturing", r"(manufacturing|industrial|factory|production)"),
    ("Consulting", r"(consulting|advisory|solutions)"),
    ("LLC/Corporation", r"(LLC|Ltd|PLC|Corp|Inc)"),
    ("Partnership", r"(and|&|\-)"),
]

PERSONAL_EMAIL_DOMAINS = ["gmail.com", "yahoo.com", "hotmail.com", "outlook.com"]

SEASONS = [
    ("Spring", [3, 4, 5]),
    ("Summer", [6, 7, 8]),
    ("Fall", [9, 10, 11]),
    ("Winter", [12, 1, 2]),
]

# Tokens a default CSV reader of the reference's toolkit treats as missing.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

CHUNK_SIZE = 8192
MAX_ERRORS = 50
MAX_ERRORS_PER_CHUNK = 5
TOP_CATEGORIES = 15
