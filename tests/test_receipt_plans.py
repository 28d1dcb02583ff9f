"""The text rules run once per receipt, and clean whole texts as Python does line by line; names of a bucket share one state."""

import pandas as pd
from pyspark.sql import functions as F

from tessera.functions import receipt_text as RT
from tessera.operators import receipts as RC
from tessera.streaming.store_state import _seen_names

TEXTS = [None, "", " \n\t\n ", "a", "  a  b \n\n c\t d\n", "x\r\n y  z \n  \n", "\n TOTAL  $l2.SO \n1O.S\n l.5", "a \t b\x0bc\n\n\n d "]


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_prices_are_looked_for_once(spark):
    texts = spark.createDataFrame([(1, "Shop Ltd\nMilk 2.50")], "doc_id long, raw_text string")
    parsed = RC.parse(texts, "2001-08-02 00:00:00", partitions=2)
    assert plan(parsed).count(RT.PRICE) == 1
    items = RC.items_table(parsed)
    assert plan(items).count(RT.PRICE) == 1  # none in a filter below the deal of the texts
    assert [tuple(r) for r in items.select("receipt_id", "line_no", "item_name", "total_price").collect()] == [(1, 2, "Milk", 2.5)]


def test_receipts_without_items_give_no_item_rows(spark):
    texts = spark.createDataFrame([(1, "Shop Ltd"), (2, None), (None, "Tea 1.20"), (2, "Tea 1.30\nTea 1.40")], "doc_id long, raw_text string")
    items = RC.items_table(RC.parse(texts, "2001-08-02 00:00:00"))
    assert sorted(map(tuple, items.select("receipt_id", "line_no", "total_price").collect()), key=str) == [(2, 1, 1.3), (2, 2, 1.4), (None, 1, 1.2)]


def test_whole_texts_are_cleaned_as_their_lines(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    got = {r.i: r.x for r in df.select("i", RT.clean_lines(F.col("t"), fix_ocr=False).alias("x")).collect()}
    assert got == {i: [x for x in (" ".join(y.split()) for y in (t or "").split("\n")) if x] for i, t in enumerate(TEXTS)}
    fixed = df.where("i = 6").select(RT.clean_lines(F.col("t"))).first()[0]
    assert fixed == ["TOTAL $12.50", "10.5", "1.5"]


class State:
    def __init__(self, watermark=0):
        self.value, self.timer, self.watermark = None, None, watermark

    exists = property(lambda self: self.value is not None)
    get = property(lambda self: self.value)

    def update(self, value):
        self.value = value

    def remove(self):
        self.value = None

    def setTimeoutTimestamp(self, at):
        assert at > self.watermark
        self.timer = at

    def getCurrentWatermarkMs(self):
        return self.watermark


def test_a_bucket_keeps_and_forgets_its_names():
    def batch(at, *rows):
        pdf = pd.DataFrame(rows, columns=["receipt_id", "norm", "covers"]).assign(store_name="s", store_address=None, at=at)
        return [x for out in follow(None, iter([pdf]), state) for x in out["ask"]]

    follow, state = _seen_names(100), State()
    assert batch(10, (5, "a", True), (4, "a", True), (6, "b", False), (7, "", False)) == [True, True, True, False]
    assert state.value == (["a"], [4], [10]) and state.timer == 110
    assert batch(60, (8, "a", True), (9, "b", True)) == [False, True]
    assert state.value == (["a", "b"], [4, 9], [60, 60])
    state.watermark = 70
    assert batch(120, (10, "b", True)) == [False] and state.timer == 160
    state.watermark = 160
    assert batch(161) == [] and state.value == (["b"], [9], [120]) and state.timer == 220
    state.watermark = 220
    assert batch(221) == [] and state.value is None
