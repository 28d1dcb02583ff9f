"""Operator 9: chat formatting in budgeted, turn-aligned windows, in DataFrame functions only.

Prefix sums of turn tokens cut each conversation into spans of whole turns. A window is the
conversation's system turn, the turns before the span as far as the history budget goes,
and the span itself. Only the span's assistant texts are under the loss: turns repeated as
history (and the repeated system turn) are masked, so each assistant text is a target once.

Template: ``### <role>:\\n<text>\\n</turn>\\n`` for each turn, the role URL-encoded. Control
strings inside a text (``###`` and ``</turn>``, with any backslashes before them) get one more
backslash, which reading removes again, so texts come back exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.shared import hex_sha256

END = "\n</turn>\n"
_ESCAPE, _UNESCAPE = r"(?<!\\)(\\*+(?:###|</turn>))", r"(?<!\\)\\(\\*+(?:###|</turn>))"
# A turn's tokens: words and single signs, and this many for the template's marks.
TOKEN = r"[0-9A-Za-z_]+|[^0-9A-Za-z_\x20\x09-\x0D]"
OVERHEAD = 8


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPE, r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _UNESCAPE, "$1")


def _rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit("### "), F.url_encode(role), F.lit(":\n"), escape(text), F.lit(END))


def format_chat(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                budget: int = 512, history: int = 128, history_turns: int = 4) -> DataFrame:
    """One row per window: conv_id, window, n_repeated, n_new, formatted, loss (array of start and
    length in code points of ``formatted``), n_tokens.

    The first ``n_repeated`` turns of a window repeat earlier ones. A span holds new turns of
    at most ``budget`` tokens, or a single longer turn; at most ``history_turns`` turns of at
    most ``history`` tokens are repeated. Null texts and roles are empty; ties of a turn number
    go by role and text; repeated rows are turns of their own; a null conversation id is one
    conversation; other columns are ignored; an empty table gives no window.

    One shuffle by conversation: sums and bounded frames stream over a long conversation, and
    what is gathered is one window's turns, which the budget bounds.
    """
    t = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
                     F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    t = t.withColumn("cost", F.regexp_count("text", F.lit(TOKEN)) + OVERHEAD)
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    turn = F.struct("role", "text", "cost", F.col("start").alias("at"))
    t = (t.withColumn("n", F.row_number().over(order))
         .withColumn("end", F.sum("cost").over(order.rowsBetween(Window.unboundedPreceding, 0)))
         .withColumn("start", F.col("end") - F.col("cost"))
         .withColumn("first", F.first(F.struct("role", "text", "cost")).over(order))
         .withColumn("before", F.collect_list(turn).over(order.rowsBetween(-history_turns, -1))))
    # a span is a cell of the prefix sums; a turn that reaches over the cell's end is a span of its own
    # unless the cell's turns fit the budget with it
    t = t.withColumn("cell", F.floor(F.col("start") / budget)).withColumn(
        "over", F.col("end") > (F.col("cell") + 1) * budget)
    cell = Window.partitionBy("conv_id", "cell").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    t = t.withColumn("alone", F.col("over") & (F.sum("cost").over(cell) > budget))
    span = t.groupBy("conv_id", "cell", "alone").agg(
        F.array_sort(F.collect_list(F.struct("n", "role", "text", "cost"))).alias("new"),
        F.min(F.struct("n", "start", "before", "first")).alias("lead"))
    span = span.withColumn("from", F.col("lead.n"))
    has_system = (F.col("lead.first.role") == "system") & (F.col("from") > 1)
    near = F.filter(F.col("lead.before"), lambda x: (F.col("lead.start") - x["at"] <= history) & ~((x["at"] == 0) & (F.col("lead.first.role") == "system")))
    item = lambda x, target: F.struct(x["role"].alias("role"), x["text"].alias("text"), x["cost"].alias("cost"), target.alias("target"))
    none = F.array().cast("array<struct<role: string, text: string, cost: int, target: boolean>>")
    head = F.when(has_system, F.array(item(F.col("lead.first"), F.lit(False)))).otherwise(none)
    span = span.withColumn("repeated", F.concat(head, F.transform(near, lambda x: item(x, F.lit(False)))))
    span = span.withColumn("turns", F.concat("repeated", F.transform("new", lambda x: item(x, x["role"] == "assistant"))))
    span = span.withColumn("pieces", F.transform("turns", lambda x: F.struct(
        _rendered(x["role"], x["text"]).alias("whole"), F.length(escape(x["text"])).alias("chars"), x["target"].alias("target"))))
    # where each turn begins in the window, then its text: the end mark is of fixed length
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start: int, length: int>>").alias("loss"))
    walk = F.aggregate("pieces", begin, lambda acc, x: F.struct(
        (acc["at"] + F.length(x["whole"])).alias("at"),
        F.when(x["target"], F.array_append(acc["loss"], F.struct(
            (acc["at"] + F.length(x["whole"]) - len(END) - x["chars"]).alias("start"), x["chars"].alias("length")))).otherwise(acc["loss"]).alias("loss")))
    return span.select(
        "conv_id", F.col("from").cast("long").alias("window"), F.size("repeated").alias("n_repeated"), F.size("new").alias("n_new"),
        F.array_join(F.transform("pieces", lambda x: x["whole"]), "").alias("formatted"), walk["loss"].alias("loss"),
        F.aggregate("turns", F.lit(0).cast("long"), lambda a, x: a + x["cost"]).alias("n_tokens"))


def read_back(windows: DataFrame) -> DataFrame:
    """One row per window: conv_id, window, turns (role, text) without the repeated ones, loss_texts
    (unescaped), formatted_chars; from the formatted text and its loss spans alone."""
    parts = F.split("formatted", END)
    turns = F.slice(parts, F.col("n_repeated") + 1, F.size(parts) - 1 - F.col("n_repeated"))
    one = lambda x: F.struct(
        F.url_decode(F.substring_index(F.substring(x, 5, 1 << 30), ":\n", 1)).alias("role"),
        unescape(F.substring(x, F.locate(":\n", x) + 2, F.length(x))).alias("text"))
    return windows.select(
        "conv_id", "window", F.transform(turns, one).alias("turns"),
        F.transform("loss", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["length"]))).alias("loss_texts"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def chat_digest(windows: DataFrame) -> DataFrame:
    """Per conversation, read back from its windows: conv_id, n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars."""
    back = read_back(windows)
    text = F.transform(F.col("turns"), lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n")))
    back = back.select("conv_id", "window", F.size("turns").alias("n"), F.array_join(text, "").alias("text"),
                       F.array_join("loss_texts", "").alias("loss"), "formatted_chars")
    joined = lambda c: F.array_join(F.transform(F.col("w"), lambda x: x[c]), "")
    by = back.groupBy("conv_id").agg(F.sum("n").cast("long").alias("n_turns"), F.sum("formatted_chars").alias("formatted_chars"),
                                     F.array_sort(F.collect_list(F.struct("window", "text", "loss"))).alias("w"))
    return by.select("conv_id", "n_turns", hex_sha256(joined("text")).alias("turns_sha256"),
                     F.length(joined("loss")).cast("long").alias("loss_chars"), hex_sha256(joined("loss")).alias("loss_sha256"), "formatted_chars")
