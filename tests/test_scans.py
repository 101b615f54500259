"""Scans in parts against whole windows, with one key that holds a third of all rows, null keys and repeated times."""

import random

import pytest
from pyspark.sql import functions as F

from tallyvane.operators import joins as J
from tallyvane.operators import scans
from tallyvane.operators import series as S


def rows_of(df):
    return sorted(map(repr, df.collect()))


@pytest.fixture(scope="module")
def events(spark):
    rng = random.Random(11)
    rows = [(rng.choice(["hot", "hot", "hot", "hot", *"abcde", None]), rng.randint(0, 400), i, rng.choice([None, 1, 2, 3, 50])) for i in range(900)]
    return spark.createDataFrame(rows, "k string, t int, i int, v int").cache()


def test_keys_are_cut_by_time(spark, events):
    cut = scans.in_parts(events, ["k"], "t", 40)
    sizes = cut.groupBy("k", "_part").agg(F.count("*").alias("n"), F.min("t").alias("a"), F.max("t").alias("b")).orderBy("k", "_part").collect()
    hot = [r for r in sizes if r["k"] == "hot"]
    assert len(hot) > 5 and max(r["n"] for r in hot) < 100 and all(x["b"] < y["a"] for x, y in zip(hot, hot[1:], strict=False))
    assert scans.in_parts(events, ["k"], "t", 1000) is None and cut.count() == 900


def test_no_key_is_gathered_to_be_cut(spark, events):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cut = scans.in_parts(events, ["k"], "t", 40)
        plan = cut._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan and cut.where("k = 'hot'").agg(F.count_distinct("_part")).first()[0] > 5
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_last_values_sums_and_numbers_carry_over_parts(events):
    for f in (
        lambda most: scans.last_so_far(events, ["k"], "t", ["i"], "v", "x", most),
        lambda most: scans.sum_so_far(events, ["k"], "t", ["i"], F.col("v"), "x", most).withColumn("x", F.coalesce("x", F.lit(0))),
        lambda most: scans.numbered(events, ["k"], "t", ["i"], "x", "n", most),
        lambda most: S.stable_runs(events, "k", "t", "v", 40, 1, "i", most),
        lambda most: S.drop_events(events, ["k"], "t", "v", most),
        lambda most: scans.row_before(S.last_per_day(events, ["k"], "t", "v"), ["k"], "t", "v", "x", most),
        lambda most: S.carry_over_dates(events.groupBy("k", "t").agg(F.min("v").alias("v")), "k", "t", "v", most),
    ):
        assert rows_of(f(7)) == rows_of(f(None)) == rows_of(f(10_000))


def test_asof_join_in_parts(events):
    left, right = events.where("i % 3 = 0").drop("v"), events.where("i % 3 > 0")
    assert rows_of(J.asof_join(left, right, "k", "t", "v", most=9)) == rows_of(J.asof_join(left, right, "k", "t", "v", most=None))


def test_previous_values_with_null_keys(events):
    want = {}
    for r in S.last_per_day(events, ["k"], "t", "v").orderBy("t").collect():
        want[r["k"]] = (r["t"], r["v"], want.get(r["k"], (None, None))[1])
    assert {r["k"]: (r["t"], r["v"], r["prev"]) for r in S.prev_value(events, ["k"], "t", "v").collect()} == want


def slow_segments(rows):
    """Segments of (key, time, name, value) rows by one loop over each key."""
    out, last = [], None
    late = lambda x: (x is None, x if x is not None else 0)
    for k, t, n, v in sorted(rows, key=lambda r: (str(r[0]), late(r[1]), (r[2] is None, r[2] or ""))):
        x = n or ""
        if not out or out[-1]["k"] != k:
            out.append({"k": k, "s": 0, "first": x, "rows": []})
        elif not (x == out[-1]["first"] or (x and out[-1]["first"] and (x in out[-1]["first"] or out[-1]["first"] in x))):
            out.append({"k": k, "s": out[-1]["s"] + 1, "first": x, "rows": []})
        out[-1]["rows"].append((t, n, v))
    mode = lambda xs: min(((-xs.count(x), x) for x in xs if x is not None), default=(0, None))[1]
    times = lambda g: [t for t, _, _ in g["rows"] if t is not None]
    return sorted(repr((g["k"], g["s"], min(times(g), default=None), max(times(g), default=None), len(g["rows"]), mode([n for _, n, _ in g["rows"]]), mode([v for _, _, v in g["rows"]]))) for g in out)


@pytest.mark.parametrize("names", [["a", "ab", "abc", "b", "", None], ["glen", "glen 12", "glen 12 oak"], ["x"], ["x", "xy", "xz", "xyq", "yq"]])
def test_segments_over_many_partitions_equal_one_loop(spark, names):
    rng = random.Random(len(names))
    rows = [(rng.choice(["hot", "hot", "hot", *"abc", None]), rng.choice([None, *range(300)]), rng.choice(names), rng.choice([None, 1, 2, 3])) for _ in range(600)]
    rows += rows[:50]
    df = spark.createDataFrame(rows, "k string, t int, n string, v int")
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = sorted(repr(tuple(r)) for r in S.merge_segments(df, "k", "t", "n", "v").collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == slow_segments(rows)


def test_segments_of_nothing(spark):
    assert S.merge_segments(spark.createDataFrame([], "k string, t int, n string, v double"), "k", "t", "n", "v").count() == 0
