"""Joins against all pairs: many needles, places anywhere on the globe, and cases in which they once were wrong."""

import math
import random

from pyspark.sql import functions as F

from tallyvane.operators import gates as G
from tallyvane.operators import joins as J
from tallyvane.operators import series as S
from tallyvane.plans import catalog
from tallyvane.sources import readers as R


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def test_containing_by_automaton_and_by_grams_equal_all_pairs(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abÄß+ 잔") for _ in range(rng.randint(0, 6)))
    texts = [(word() + word() + word(), rng.choice(["x", "y", None])) for _ in range(150)] + [(None, "x")]
    needles = [(word(), rng.choice(["x", "y", None])) for _ in range(100)]
    t, n = spark.createDataFrame(texts, "text string, b string"), spark.createDataFrame(needles, "needle string, b string")
    want = {(b, x, m.lower()) for x, b in texts for m, c in needles if x is not None and m and b == c and b is not None and m.lower() in x.lower()}
    for most in (0, 1000):
        got = [tuple(r) for r in J.containing(t, "text", n, "needle", ["b"], most).collect()]
        assert len(got) == len(set(got)) and set(got) == want
        plain = {tuple(r) for r in J.containing(t, "text", n, "needle", (), most).collect()}
        assert plain == {(x, m.lower()) for x, _ in texts for m, _ in needles if x is not None and m and m.lower() in x.lower()}
    assert J.containing(t, "text", n.limit(0), "needle").count() == J.containing(t.limit(0), "text", n, "needle").count() == 0


def test_fifty_thousand_tokens_and_rows_as_many_as_hits(spark):
    rules = spark.range(50_000).select(F.col("id").cast("int").alias("rule_no"), F.concat(F.lit("R"), "id").alias("id"), F.lit("n").alias("name"), F.array(F.concat(F.lit("t"), "id", F.lit("."))).alias("match"), F.array().cast("array<string>").alias("not"), F.array().cast("array<string>").alias("alias"))
    names = spark.range(300).select(F.concat(F.lit("Some T"), F.col("id") * 100, F.lit(". and t"), F.col("id"), F.lit(".")).alias("n"))
    got = {r["text"]: (r["rule_no"], r["hits"]) for r in J.resolve_rules(names, "n", rules).collect()}
    assert got == {f"Some T{i * 100}. and t{i}.": (i, 1 if i == 0 else 2) for i in range(300)}


def test_excluded_names_stay_excluded(spark):
    rules = spark.createDataFrame([(1, "A", "a", ["glen"], [], []), (2, "B", "b", ["glen", "old"], [], [])], "rule_no int, id string, name string, match array<string>, not array<string>, alias array<string>")
    names = spark.createDataFrame([("Glen",), ("Glen old",), ("Glen glass",), ("x",)], "n string")
    got = {r["text"]: (r["status"], r["id"]) for r in J.resolve_unique(names, "n", rules, excludes=["glass"]).collect()}
    assert got == {"Glen": ("matched", "A"), "Glen old": ("ambiguous", None), "Glen glass": ("excluded", None), "x": ("unmatched", None)}


def metres(a, b, c, d):
    a, b, c, d = map(math.radians, (a, b, c, d))
    h = math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2
    return 2 * J.EARTH_M * math.asin(min(1, math.sqrt(h)))


def places():
    rng = random.Random(7)
    out = [(math.degrees(math.asin(rng.uniform(-1, 1))), rng.uniform(-180, 180)) for _ in range(150)]
    for lat, lng in ((89.9999, 10.0), (-90.0, 0.0), (0.0, 180.0), (80.0, 20.0), (37.5, 127.0)):
        out += [(max(-90.0, min(90.0, lat + rng.uniform(-0.002, 0.002))), (lng + rng.uniform(-0.002, 0.002) + 180) % 360 - 180) for _ in range(25)]
    return [(i, *p) for i, p in enumerate(out)] + [(1000, None, 1.0), (1001, 1.0, None)]


def test_radius_equals_all_pairs_anywhere(spark):
    rows = places()
    p = spark.createDataFrame(rows, "k int, lat double, lng double")
    c = p.where("k % 5 = 0").withColumnRenamed("k", "centre")
    for radius in (160.0, 5_000_000.0):
        got = {(r["k"], r["centre"]) for r in J.within_radius(p, c, radius).collect()}
        want = {(k, m) for k, a, b in rows for m, x, y in rows if m % 5 == 0 and None not in (a, b, x, y) and metres(a, b, x, y) <= radius}
        assert got == want


def test_nearest_places_equal_all_pairs(spark):
    rows = [r for r in places() if r[0] % 2 == 0]
    p = spark.createDataFrame(rows, "k int, lat double, lng double")
    c = p.where("k % 10 = 0").withColumnRenamed("k", "centre")
    for k in (3, 500):
        got = sorted((r["centre"], r["rank"], round(r["metres"], 2)) for r in J.nearest_places(p, c, k, "k").collect())
        want = []
        for m, x, y in rows:
            if m % 10 == 0 and None not in (x, y):
                near = sorted(metres(a, b, x, y) for _, a, b in rows if None not in (a, b))[:k]
                want += [(m, n + 1, round(far, 2)) for n, far in enumerate(near)]
        assert got == sorted(want)


def test_registry_rows_that_repeat_stay(spark):
    p = spark.createDataFrame([("Glen Bar", "north", 1.0, 1.0)] * 2 + [("Other", None, None, None), (None, None, None, None)], "n string, loc string, lat double, lng double")
    r = spark.createDataFrame([("glen-bar 2", "north", None, None)], p.schema)
    got = sorted((str(x["n"]), x["registered"]) for x in J.match_registry(p.repartition(3), r, "n", "loc", "lat", "lng").collect())
    assert got == [("Glen Bar", True), ("Glen Bar", True), ("None", False), ("Other", False)]


def test_two_rates_a_day_make_one(spark):
    fx = spark.createDataFrame([("d", "K", 2.0), ("d", "K", 1.0), ("d", "A", 4.0), ("d", "A", 8.0)], "date string, currency string, rate double")
    assert sorted(map(tuple, J.cross_rates(fx, "K").collect())) == [("d", "A", 0.25), ("d", "K", 1.0)]


def test_a_last_period_without_value_says_nothing(spark):
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate([10, 20, 30, None])], "k string, p int, v int")
    assert [(r["last"], r["value"], r["periods"], r["tag"]) for r in S.trajectory(df, "k", "p", "v").collect()] == [(2, 30, 3, "rising")]


def test_deep_and_broken_json_give_no_rows(spark):
    deep = "[" * 100_000 + "]" * 100_000
    half = '{"id": 1, "v": ' + "[" * 50_000 + "]" * 50_000 + "}"
    df = spark.createDataFrame([(deep,), (half,), ("{",), (None,), ("",), ('[{"a": {"id": 2, "v": 5}}]',)], "t string")
    assert [tuple(r) for r in R.extract_json_objects(df, "t", {"id": "int", "v": "int"}, "id").collect()] == [(2, 5)]


def test_bundles(spark):
    yes = ["글렌 전용잔 세트", "글렌 메가 잔", "글렌 두 개입", "글렌 증정", "글렌 미니어쳐 세트", "글렌 기프트  세트"]
    no = ["Glen 12+", "a + b", "box 2", "gifted oak", "글렌 세트", "글렌 잔", None]
    assert all(one(spark, G.is_bundle(F.lit(x))) for x in yes) and not any(one(spark, G.is_bundle(F.lit(x).cast("string"))) for x in no)


def test_trajectory_holds_few_rows_a_task(spark):
    rows = spark.range(3000).select((F.col("id") % 40).alias("k"), F.expr("pmod(hash(id, 1), 12)").alias("p"), F.expr("if(id % 9 = 0, null, pmod(hash(id, 2), 50))").alias("v"))
    cut, whole = S.trajectory(rows, "k", "p", "v", task=100), S.trajectory(rows, "k", "p", "v", task=None)
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert plan.count(", 27)") == plan.count("Exchange hashpartitioning") == 2
    assert sorted(cut.collect()) == sorted(whole.collect()) and whole.count() == 40
    plan = catalog.QUERIES["w5_trajectory"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate(") == 2


def test_trajectory_counts_on_cores_not_on_partitions_that_are_merged(spark):
    rows = spark.range(3000).select((F.col("id") % 40).alias("k"), F.expr("pmod(hash(id, 1), 12)").alias("p"), F.expr("if(id % 9 = 0, null, pmod(hash(id, 2), 50))").alias("v"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        cut, whole, few = (S.trajectory(rows, "k", "p", "v", task=n) for n in (100, None, 1000))
        plan = cut._jdf.queryExecution().executedPlan().toString()
        assert plan.count(", 27)") == plan.count("Exchange hashpartitioning") == 2
        assert few._jdf.queryExecution().executedPlan().toString().count(", 200)") == 2
        assert sorted(cut.collect()) == sorted(whole.collect()) == sorted(few.collect()) and whole.count() == 40
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_trend_classes_aggregate_months_once(spark):
    plan = catalog.QUERIES["q16_trend_classes"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_min(price") == 1 and plan.count("Exchange hashpartitioning(item") == 2


def test_outliers_gather_no_key_in_a_task(spark):
    rows = spark.createDataFrame([("a", 10, True)] * 8 + [("a", 29, False), ("a", 30, False), ("a", 31, False), ("a", 3, False), ("a", None, False), ("b", 5, False), (None, 7, True)], "k string, v int, h boolean")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = G.flag_outliers(rows, "k", "v", F.col("h"))
        plan = out.groupBy("k").agg(F.count_if("outlier"))._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
        assert sorted(r["v"] for r in out.where("outlier").collect()) == [3, 31] and out.count() == 15
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
