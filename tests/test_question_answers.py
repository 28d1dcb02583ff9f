"""N6 against a direct Python pairing on a small literal fixture with many thresholds."""

import datetime as dt
import random

from tessera.operators import question_answers as QA

AS_OF = "2001-08-02 00:00:00"


def _brute(receipts, questions, spark):
    sel = {r["question_id"]: r for r in QA._selections(
        spark.createDataFrame(questions, "question_id long, question string"), AS_OF).collect()}
    out = {}
    for qid, s in sel.items():
        rows = []
        for rid, store, date, amount in receipts:
            if s["store_filter"] is not None and s["store_filter"].lower() not in store.lower():
                continue
            if s["op"] == "greater" and not (amount is not None and amount > s["value"]):
                continue
            if s["op"] == "less" and not (amount is not None and amount < s["value"]):
                continue
            rows.append((date, rid, store, amount))
        rows.sort(key=lambda t: (t[0], t[1]), reverse=True)
        top = [t for t in rows if s["since"] is None or t[0] >= s["since"]]
        paid = [t for t in top if t[3]]
        n = len({t[1] for t in top})
        spent = sum(t[3] for t in paid)
        out[qid] = ("NO_DATA" if n == 0 else s["intent"], n, round(spent, 4), len({t[2] for t in paid}))
    return out


def test_answers_match_direct_pairing(spark):
    rnd = random.Random(7)
    stores = ["Alpha Mart", "Beta Mart", "Gamma Books", "Delta Cafe"]
    stores.append("*")  # a store name that looks like a mark
    receipts = []
    for rid in range(600):
        date = dt.datetime(2001, 1, 1) + dt.timedelta(days=rnd.randint(0, 210))
        amount = rnd.choice([None, 0.0, 5.0, 10.0, 10.0, 20.0, 50.0, 99.5, 100.0, 250.0, 1000.0])
        receipts.append((rid, rnd.choice(stores), date, amount))
    texts = ["How much have I spent?", "money spent at mart", "spent at beta mart yesterday",
             "total cost for the past 45 days", "receipts over $1000.50 in the past year", "hello"]
    texts += [f"spent less than ${v}" for v in (5, 10, 10, 20, 100, 101, 250)]
    texts += [f"receipts over ${v} at gamma" for v in (0, 5, 10, 99, 100, 250, 999)]
    texts += [f"total spent above ${v}" for v in range(0, 300, 7)]
    questions = [(i, t) for i, t in enumerate(texts)]
    rdf = spark.createDataFrame(receipts, "receipt_id long, store_name string, receipt_date timestamp_ntz, "
                                          "total_amount double")
    qdf = spark.createDataFrame(questions, "question_id long, question string")
    got = {r["question_id"]: (r["answer_kind"], r["total_receipts"], round(r["total_spent"], 4), r["unique_stores"])
           for r in QA.answer(rdf, qdf, AS_OF).collect()}
    assert got == _brute(receipts, questions, spark)


def test_numbers_that_are_no_ascii_or_too_large_end_no_job(spark):
    questions = ["last 99999999999 days", "last ٣٠ days", "last 2000000000 days", "spent over ٥٠", "last 30 days"]
    q = spark.createDataFrame(list(enumerate(questions)), "question_id long, question string")
    r = spark.createDataFrame([(1, "A", dt.datetime(2001, 7, 30), 60.0), (2, "B", dt.datetime(2000, 1, 1), 40.0)],
                              "receipt_id long, store_name string, receipt_date timestamp_ntz, total_amount double")
    got = {x["question_id"]: (x["total_receipts"], x["total_spent"]) for x in QA.answer(r, q, AS_OF).collect()}
    assert got == {0: (0, 0.0), 1: (1, 60.0), 2: (0, 0.0), 3: (1, 60.0), 4: (1, 60.0)}


def test_a_thousand_start_dates(spark, monkeypatch):
    """Equal to direct pairing, also with dates on the starts and none at all; the rows shuffled rise with the log of the starts."""
    rnd = random.Random(11)
    midnight = dt.datetime(2001, 8, 2)
    receipts = [(rid, "Hot Mart" if rid % 3 else rnd.choice(["Beta Mart", "Gamma Books", "Delta Cafe"]),
                 midnight - dt.timedelta(days=rnd.randint(0, 1100), seconds=rnd.choice([0, 0, 1])), rnd.choice([None, 0.0, 5.0, 10.0, 20.0, 99.5, 250.0]))
                for rid in range(500)]
    tails = ["", " over $10", " under $99", " at mart", " over $5 at gamma"]
    texts = [f"total cost past {n} days{tails[n % 5]}" for n in range(1, 1001)] + ["total cost", "cost over $20"]
    rdf = spark.createDataFrame(receipts, "receipt_id long, store_name string, receipt_date timestamp_ntz, total_amount double")
    counted, plain = [], QA._before

    def counting(rows, thresholds, sums):
        counted.append(rows.count())
        return plain(rows, thresholds, sums)

    monkeypatch.setattr(QA, "_before", counting)

    def answers(texts):
        counted.clear()
        df = spark.createDataFrame(list(enumerate(texts)), "question_id long, question string")
        got = {r["question_id"]: (r["answer_kind"], r["total_receipts"], round(r["total_spent"], 4), r["unique_stores"]) for r in QA.answer(rdf, df, AS_OF).collect()}
        return got, list(counted)

    got, many = answers(texts)
    assert got == _brute(receipts, list(enumerate(texts)), spark)
    _, few = answers(texts[::25])
    assert many[0] <= 2 * 2 * 11 * len(receipts) and many[0] < 4 * few[0]  # 25 times the starts


def test_items_of_questions(spark):
    items = [(1, "pen", 2.0, "a"), (1, "pen", 3.0, "a"), (2, "ink", 5.0, None), (2, "cup", None, "b"), (9, "gone", 99.0, "z"), (2, "", 4.0, ""), (1, "tie", 5.0, "c"),
             (2, "zero", 0.0, "b")]
    idf = spark.createDataFrame(items, "receipt_id long, item_name string, total_price double, category string")
    rdf = spark.createDataFrame([(1, "A"), (2, None), (None, "x")], "receipt_id long, store_name string")
    qdf = spark.createDataFrame([(1, "What do I buy?"), (2, "total cost"), (3, None), (4, "items over $5")], "question_id long, question string")
    got = sorted((r.question_id, r.kind, r["rank"], r.name, r.figure) for r in QA.item_answers(rdf, idf, qdf, 2, 2).collect())
    one = [("category", 1, "a", 2.0), ("category", 2, "b", 2.0), ("item", 1, "ink", 5.0), ("item", 2, "pen", 5.0)]
    assert got == [(q, *x) for q in (1, 4) for x in one]
    assert QA.item_answers(rdf, idf.where("false"), qdf).count() == 0
