"""Joins over counts and slots against all pairs."""

import random
from statistics import median

from pyspark.sql import functions as F

from tallyvane.operators import joins as J


def test_brand_statistics_equal_all_pairs(spark):
    rng = random.Random(5)
    name = lambda: " ".join(rng.sample(["glen", "oak", "moor", "12yo", "18yo", "red"], rng.randint(0, 4)))
    items = [(name(),) for _ in range(60)] + [(None,), ("glen",), ("glen",)]
    offers = [(name(), rng.choice([None, *range(10, 60)]), rng.choice([None, 350, 500, 700, 1000])) for _ in range(400)] + [("glen 12yo", 7, 700)] * 90
    brands = ["glen", "oak", "moor"]
    got = {r["item"]: (r["offers"], r["low"], r["median"], r["high"]) for r in J.match_brand_age(spark.createDataFrame(items, "n string"), spark.createDataFrame(offers, "n string, p int, v int"), "n", "n", "p", "v", spark.createDataFrame([(b,) for b in [*brands, "glen"]], "token string")).collect()}
    years = lambda t: max((int(w[:-2]) for w in t.split() if w.endswith("yo")), default=-1)
    want = {}
    for (item,) in set(items):
        if item is None:
            continue
        met = [(p * 100.0 / v if p is not None else None) for b in brands if b in item.split() for o, p, v in offers if v and v >= 500 and b in o.split() and years(o) == years(item)]
        if met:
            units = [u for u in met if u is not None]
            want[item] = (len(met), *(round(x, 4) if units else None for x in (min(units, default=0), median(units or [0]), max(units, default=0))))
    assert got.keys() == want.keys() and len(want) > 10
    for item, (n, *three) in want.items():
        assert got[item][0] == n and all(abs(a - b) < 1e-3 for a, b in zip(got[item][1:], three, strict=True))


def test_brand_statistics_of_nothing(spark):
    none = spark.createDataFrame([], "n string, p int, v int")
    brands = spark.createDataFrame([("glen",)], "token string")
    assert J.match_brand_age(none.select("n"), none, "n", "n", "p", "v", brands).count() == 0


def test_window_minimum_in_slots_equals_all_pairs(spark):
    rng = random.Random(9)
    day = lambda: rng.choice([None, *range(-200, 200)])
    left = [(rng.choice(["hot", "hot", "a", None]), day(), i) for i in range(300)]
    right = [(rng.choice(["hot", "hot", "a", None]), day(), rng.choice([None, *range(50)])) for _ in range(300)]
    dated = lambda rows, c: spark.createDataFrame(rows, f"k string, n int, {c} int").withColumn("d", F.date_from_unix_date("n")).drop("n")
    for k in (1, 7, 90):
        got = {r["i"]: r["window_min"] for r in J.window_min_join(dated(left, "i"), dated(right, "v"), "k", "d", "v", k).collect()}
        want = {i: min((v for m, e, v in right if m == key and None not in (d, e, v) and 0 < e - d <= k), default=None) for key, d, i in left}
        assert got == want


def test_token_matches_equal_all_pairs(spark):
    rng = random.Random(3)
    name = lambda n: " ".join(rng.choice(["the", "the", "the", *"abcdefg"]) for _ in range(rng.randint(0, n)))
    queries, listings = [(name(3),) for _ in range(60)] + [("the unheard",), (None,)], [(name(7), rng.randint(1, 9)) for _ in range(200)]
    got = {r["query"]: (r["extra"], r["price"], r["pool"]) for r in J.match_tokens(spark.createDataFrame(queries, "q string"), spark.createDataFrame(listings, "l string, p int"), "q", "l", "p").collect()}
    want = {}
    for (q,) in set(queries):
        met = [(len(set(x.split())) - len(set(q.split())), p) for x, p in listings if set(q.split()) <= set(x.split())] if q else []
        if met:
            want[q] = (*min(met), len(met))
    assert got == want


def test_token_matches_broadcast_queries_only(spark, monkeypatch):
    copies = spark.range(3000).select(F.concat(F.lit("red bolt "), F.col("id") % 3).alias("l"), (F.col("id") % 7).alias("p"), (F.col("id") % 5).alias("g"))
    queries = spark.createDataFrame([("red",), ("bolt 2",), ("red bolt 1",), ("blue",)], "q string")
    want = {"red": ("red bolt 0", 0, 2, 3000, 3000, 0), "bolt 2": ("red bolt 2", 0, 1, 1000, 1000, 0), "red bolt 1": ("red bolt 1", 0, 0, 1000, 1000, 0)}
    for rows in (J.BROADCAST_ROWS, 0):
        monkeypatch.setattr(J, "BROADCAST_ROWS", rows)
        out = J.match_tokens(queries, copies, "q", "l", "p", product="g")
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "BuildRight" not in plan and ("BuildLeft" in plan) == bool(rows)
        assert {r["query"]: (r["listing"], r["price"], r["extra"], r["tier"], r["pool"], r["product"]) for r in out.collect()} == want
        assert {(r["siblings"], r["sibling_high"]) for r in out.collect()} == {(600, 6)}
