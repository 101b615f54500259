"""The index of similar names, what is mined with it, and compared catalogues, against all pairs and plain loops."""

import difflib
import random
import re

import pytest
from oracle import DATA
from pyspark.sql import functions as F

from tallyvane.operators import similar
from tallyvane.plans import catalog


def ratio(a, b):
    return difflib.SequenceMatcher(None, a, b, autojunk=False).ratio()


@pytest.mark.parametrize("letters,longest", [("ab", 7), ("abcd e", 14), ("abcdefghijklmnop ", 30), ("가나다라마바 a", 12)])
def test_index_equals_all_pairs(spark, letters, longest):
    rng = random.Random(longest)
    names = ["".join(rng.choice(letters) for _ in range(rng.randint(0, longest))) for _ in range(150)]
    changed = []
    for n in names:
        m = list(n)
        for _ in range(rng.randint(0, 1 + len(n) // 4)):
            at = rng.randint(0, len(m))
            m[at : at + rng.randint(0, 1)] = rng.choice(["", rng.choice(letters)])
        changed.append("".join(m))
    left, right = spark.createDataFrame([(n,) for n in names] + [(None,)], "a string"), spark.createDataFrame([(n,) for n in changed] + [(None,)], "b string")
    for least in (0.7, 0.85):
        got = {(r["a"], r["b"]): r["ratio"] for r in similar.similar_pairs(left, right, "a", "b", least).collect()}
        assert got == {(x, y): ratio(x, y) for x in set(names) for y in set(changed) if x and y and ratio(x, y) >= least}
        best = {}
        for (x, y), r in got.items():
            best[x] = min(best.get(x, (0, "")), (-r, y))
        assert {r["a"]: (-r["ratio"], r["b"]) for r in similar.most_similar(left, right, "a", "b", least).collect()} == best


def test_index_refuses_what_it_cannot_prove(spark):
    df = spark.createDataFrame([("x",)], "a string")
    with pytest.raises(ValueError):
        similar.similar_pairs(df, df.withColumnRenamed("a", "b"), "a", "b", 0.62)


def years(name):
    return max((int(y) for y in re.findall(r"(\d+)yo", name)), default=None)


def test_mined_candidates_equal_plain_loops(spark):
    rows = [("glen moor 12yo", "Glen Moor 12yo", 900, "s1"), ("glen moor 12yo", "GLEN MOOR 12yo", 0, "s2"), ("glen moor 12yo", "GLEN MOOR 12yo", 800, None), ("glen moor 18yo", "glen moor 18yo", None, "s1"), ("gift box", "gift box", 5, "s1"), ("unheard of", None, 7, "s1"), ("unheard of", None, 9, "s1"), ("glen moar 12yo x", "b", 1, "s3"), (None, "z", 1, "s1"), ("", "", 1, "s1")]
    goods = [("C1", "glen moor 12yo"), ("C0", "glen moor 12yo"), ("C2", "other thing"), ("C3", None)]
    df, dim = spark.createDataFrame(rows, "k string, raw string, p int, s string"), spark.createDataFrame(goods, "id string, c string")
    got = {r["key"]: r for r in similar.mine_candidates(df, dim, "k", "raw", "p", "s", "c", "id", noise=F.contains("key", F.lit("gift"))).collect()}
    short = {k: (r["spelling"], r["seen"], r["variants"], r["low"], r["high"], r["sources"], r["nearest_id"], r["kind"], r["confidence"]) for k, r in got.items()}
    assert short == {
        "glen moor 12yo": ("GLEN MOOR 12yo", 3, 2, 800, 900, "s1;s2", "C0", "synonym", "high"),
        "glen moor 18yo": ("glen moor 18yo", 1, 1, None, None, "s1", "C0", "new", "medium"),
        "gift box": ("gift box", 1, 1, 5, 5, "s1", None, "noise", "low"),
        "unheard of": (None, 2, 0, 7, 9, "s1", None, "new", "high"),
        "glen moar 12yo x": ("b", 1, 1, 1, 1, "s3", "C0", "synonym", "high"),
        "": ("", 1, 1, 1, 1, "s1", None, "new", "medium"),
    }
    assert similar.mine_candidates(df.limit(0), dim, "k", "raw", "p", "s", "c", "id").count() == 0
    assert {r["kind"] for r in similar.mine_candidates(df, dim.limit(0), "k", "raw", "p", "s", "c", "id").collect()} == {"new"}


def test_mining_query_equals_all_pairs(spark):
    got = {r["key"]: r for r in catalog.QUERIES["q17_mined"](spark, f"{DATA}/sf0.001").collect()}
    p = spark.read.parquet(f"{DATA}/sf0.001/part.parquet").toPandas()
    name = [f"{n} {z % 3 * 6 + 6}yo {t.lower()}" for n, z, t in zip(p.p_name, p.p_size, p.p_type, strict=True)]
    keys = {n for n, z in zip(name, p.p_size, strict=True) if z < 10}
    goods = {n for n, z in zip(name, p.p_size, strict=True) if z >= 10}
    assert set(got) == keys
    for k in keys:
        near = min(((-ratio(k, g), g) for g in goods), default=(0, None))
        if -near[0] < 0.72:
            want = (None, None, "new")
        else:
            same = years(k) == years(near[1])
            want = (near[1], round(-near[0], 6), ("synonym" if same else "new") if -near[0] >= 0.85 else "review")
        assert (got[k]["nearest"], got[k]["ratio"], got[k]["kind"]) == want


def test_catalogue_comparison_equals_plain_loops(spark):
    rows = [(1, "a", 10.0, 100), (1, "b", 20.0, 200), (1, "c", 33.0, 300), (2, "a", 5.0, 50), (2, "c", None, 50), (3, "b", 9.0, 0), (3, "c", 9.0, 10), (4, "a", 8.0, 100), (4, "c", 4.0, 100), (None, "a", 1.0, 1)]
    df = spark.createDataFrame(rows, "m int, s string, p double, v int")
    got = [(r["m"], r["n"], r["cheapest"], r["spread"], r["spread_pct"], r["a_b"], r["a_c"], r["b_c"]) for r in similar.compare_matched(df, "m", "s", "p", "v", ["a", "b", "c"]).orderBy("m").collect()]
    assert got == [(1, 3, "a/b", 1.0, 9.09, "tie", "a", "b"), (4, 2, "c", 4.0, 50.0, None, "c", None)]


def test_catalogue_query_compares_what_was_matched(spark):
    rows = catalog.QUERIES["q7_catalogues"](spark, f"{DATA}/sf0.001").collect()
    assert len(rows) > 20 and len({r["match_id"] for r in rows}) == len(rows)
    for r in rows:
        units = {s: r[f"unit_{s}"] for s in "012" if r[f"unit_{s}"] is not None}
        assert r["n"] == len(units) >= 2 and r["cheapest"] == "/".join(s for s in sorted(units) if units[s] == min(units.values()))
        assert abs(r["spread"] - (max(units.values()) - min(units.values()))) < 2e-4
