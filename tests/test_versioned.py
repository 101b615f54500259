"""Versioned tables: null keys, a death at every step, and two writers at once."""

import pytest
from pyspark.sql import functions as F

from tallyvane.operators import aggregates
from tallyvane.operators import quarantine as quarantines
from tallyvane.sources import versioned
from tallyvane.sources.versioned import Overtaken, Table

SCHEMA = "a string, b int, v int, t int"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def own(spark, tmp_path):
    return Table(spark, str(tmp_path / "own"), parts=4)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def test_upsert_and_append_take_nulls_as_equal(spark, own):
    own.upsert(frame(spark, (None, 1, 10, 0), ("x", None, 20, 0), (None, None, 30, 0), ("y", 1, 40, 0)), ["a", "b"])
    own.upsert(frame(spark, (None, 1, 11, 1), (None, 1, 12, 2), (None, 1, 13, None), (None, None, 31, 1), ("z", 1, 50, 1)), ["a", "b"], order="t")
    want = [(None, 1, 12, 2), ("x", None, 20, 0), (None, None, 31, 1), ("y", 1, 40, 0), ("z", 1, 50, 1)]
    assert rows_of(own.read()) == sorted(want, key=repr)
    own.append(frame(spark, (None, None, 99, 9), ("w", None, 60, 3), ("w", None, 60, 3)), ["a", "b"])
    assert rows_of(own.read()) == sorted([*want, ("w", None, 60, 3)], key=repr)
    before = own.read()
    own.upsert(frame(spark, ("x", None, 21, 5)).select("t", "v", "b", "a"), ["a", "b"])
    assert ("x", None, 20, 0) in rows_of(before) and ("x", None, 21, 5) in rows_of(own.read()) and ("x", None, 20, 0) in rows_of(own.read(1))


def test_only_touched_parts_are_written_again(spark, own):
    own.parts = 16
    own.upsert(frame(spark, *((str(i), i, i, 0) for i in range(200))), ["a"])
    first = own.manifest().folders
    own.upsert(frame(spark, ("7", 0, -1, 0)), ["a"])
    second = own.manifest().folders
    assert len(first) == 16 and sum(first[p] != second[p] for p in first) == 1 and own.read().count() == 200
    own.vacuum(1)
    assert own.read().count() == 200 and own.versions() == [2]


def test_empty_batches_and_odd_calls(spark, own):
    with pytest.raises(ValueError):
        own.read()
    assert own.latest() is None and own.manifest() is None
    own.upsert(frame(spark), ["a"])
    assert own.read().count() == 0 and own.read().columns == ["a", "b", "v", "t"]
    own.upsert(frame(spark, ("x", 1, 1, 1)), ["a"])
    assert own.upsert(frame(spark), ["a"]) == 2 and own.versions() == [1, 2]
    with pytest.raises(ValueError):
        own.upsert(frame(spark), ["b"])
    with pytest.raises(ValueError):
        own.snapshot(frame(spark), "yesterday")


@pytest.mark.parametrize("step", ["write", "manifest", "rename"])
def test_a_writer_that_dies_leaves_the_table_as_it_was(spark, own, monkeypatch, step, tmp_path):
    own.upsert(frame(spark, ("x", 1, 1, 1)), ["a"])
    with monkeypatch.context() as m:

        def dies(*_, **__):
            if step == "manifest":  # half a manifest, under the name of a file that says nothing
                (tmp_path / "own" / "versions" / ".half").write_text('{"version": 2, "ke')
            if step == "rename":
                (tmp_path / "own" / "versions" / "000000000002" / "_temporary").mkdir(parents=True)
            raise OSError("lost")

        m.setattr(versioned.Table, "_written" if step == "write" else "_publish", dies)
        with pytest.raises(OSError, match="lost"):
            own.upsert(frame(spark, ("x", 1, 2, 2)), ["a"])
    assert rows_of(own.read()) == [("x", 1, 1, 1)] and own.versions() == [1]
    assert own.upsert(frame(spark, ("x", 1, 3, 3)), ["a"]) == 2
    own.vacuum()
    assert rows_of(own.read()) == [("x", 1, 3, 3)] and not list((tmp_path / "own").glob("staged/*"))


def test_of_two_writers_one_publishes(spark, own, monkeypatch):
    own.upsert(frame(spark, ("x", 1, 1, 1)), ["a"])
    publish = Table._publish

    def late(self, manifest):
        monkeypatch.setattr(Table, "_publish", publish)
        own.upsert(frame(spark, ("y", 1, 2, 2)), ["a"])
        publish(self, manifest)

    monkeypatch.setattr(Table, "_publish", late)
    with pytest.raises(Overtaken):
        own.upsert(frame(spark, ("x", 1, 9, 9)), ["a"])
    assert rows_of(own.read()) == [("x", 1, 1, 1), ("y", 1, 2, 2)]
    own.upsert(frame(spark, ("x", 1, 9, 9)), ["a"])
    assert rows_of(own.read()) == [("x", 1, 9, 9), ("y", 1, 2, 2)]


def test_snapshots_and_their_latest(spark, own):
    for day, v in (("2026-06-02", 1), ("2026-06-01", 2), ("2026-06-02", 3)):
        own.snapshot(frame(spark, ("x", 1, v, 0)), day)
    assert own.latest() == "2026-06-02" and [r["v"] for r in own.read_latest().collect()] == [3]
    assert sorted(r["v"] for r in own.read().collect()) == [2, 3]
    own.snapshot(frame(spark), "2026-06-03")
    assert own.latest() == "2026-06-03" and own.read_latest().count() == 0


def test_remove_and_replace(spark, own):
    own.upsert(frame(spark, ("x", 1, 1, 1), (None, 1, 2, 2), ("y", None, 3, 3)), ["a", "b"])
    own.remove(frame(spark, (None, 1, 0, 0), ("z", 1, 0, 0), ("x", None, 0, 0)), ["a", "b"])
    assert rows_of(own.read()) == [("x", 1, 1, 1), ("y", None, 3, 3)]
    version = own.manifest().version
    assert own.remove(frame(spark, ("nobody", 1, 0, 0)).limit(0), ["a", "b"]) == version
    own.replace(own.read().selectExpr("a", "v + 1 as v"), ["a"])
    assert rows_of(own.read()) == [("x", 2), ("y", 4)] and own.manifest().keys == ("a",)
    own.remove(own.read(), ["a"])
    assert own.read().count() == 0


RAW = "raw string, price long, v int, at int, place string, branch string, day string"


def quarantine(spark, tmp_path, known):
    bands = spark.createDataFrame([("A", 100, 200), ("B", 100, 200)], "id string, lo long, hi long")
    names = spark.createDataFrame(known, "raw string, id string")
    return quarantines.Rules([(F.col("price") < 10, "low price")], names, bands)


def test_quarantine_is_recovered_once(spark, tmp_path, monkeypatch):
    """Gates, names and bands; a source without accepted rows stays; a run that dies between the two tables is done again."""
    accepted, held = Table(spark, str(tmp_path / "ok"), 2), Table(spark, str(tmp_path / "bad"), 2)
    rows = spark.createDataFrame(
        [("a", 150, 1, 1, "P", "B", "d1"), ("b", 150, 1, 2, "P", "B", "d1"), ("b", 150, 2, 3, "Q", "C", "d2"), ("b", 5, 1, 4, "P", "B", "d1"), ("a", 5000, 1, 5, "P", "B", "d1"), ("c", 150, 1, 6, "P", "B", "d1"), ("b", 151, None, 7, "P", "B", "d1")], RAW
    )
    keys, row_keys = ["id", "price", "place", "branch", "day"], ["raw", "price", "v", "at"]
    how = ("raw", "price", "v", ["place", "branch", "day"], keys, row_keys)
    for _ in range(2):
        quarantines.ingest(rows, quarantine(spark, tmp_path, [("a", "A"), ("b", None)]), accepted, held, "raw", "price", keys, row_keys)
    assert accepted.read().count() == 1 and {r["at"]: r["reason"] for r in held.read().collect()} == {2: "unmatched", 3: "unmatched", 4: "low price", 5: "above reference", 6: "unmatched", 7: "unmatched"}
    later = quarantine(spark, tmp_path, [("a", "A"), ("b", "B")])
    with monkeypatch.context() as m:
        m.setattr(Table, "remove", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            quarantines.reprocess(accepted, held, later, *how)
    assert accepted.read().count() == 2 and held.read().count() == 6
    assert quarantines.reprocess(accepted, held, later, *how) == {"recovered": 1, "remaining": 5, "without_source": 2}
    assert quarantines.reprocess(accepted, held, later, *how) == {"recovered": 0, "remaining": 5, "without_source": 2}
    assert sorted((r["id"], r["price"], r["place"], r["day"]) for r in accepted.read().collect()) == [("A", 150, "P", "d1"), ("B", 150, "P", "d1")]


def test_backfill_makes_equal_rows_one(spark, tmp_path):
    accepted = Table(spark, str(tmp_path / "ok"), 2)
    keys = ["id", "branch"]
    accepted.append(spark.createDataFrame([("A", None, 1), ("A", "B1", 1), ("C", None, 2)], "id string, branch string, v int"), keys)
    titles = spark.createDataFrame([(1, "B1"), (3, "B3")], "v int, branch string")
    assert quarantines.backfill(accepted, titles, "v", "branch", keys) == 1
    assert rows_of(accepted.read()) == [("A", "B1", 1), ("C", None, 2)]


def test_changes_read_only_the_parts_that_were_written(spark, own):
    own.parts = 16
    first = own.upsert(frame(spark, *((str(i), i, i, 0) for i in range(300)), (None, 1, 1, 0)), ["a"])
    second = own.upsert(frame(spark, ("7", 7, 700, 1), ("8", 8, 8, 0)), ["a"])
    assert 1 <= len(own.changed_parts(first)) <= 2
    got = own.changes(first, second)
    assert [(r["a"], r["change"], r["old"]["v"], r["new"]["v"]) for r in got.collect()] == [("7", "updated", 7, 700)]
    read = {f.split("_part=")[1].split("/")[0] for f in got.inputFiles()}
    assert read == set(own.changed_parts(first, second))
    third = own.upsert(frame(spark, (None, 1, 2, 0), ("new", 1, 1, 0)), ["a"])
    own.remove(frame(spark, ("9", 0, 0, 0)), ["a"])
    got = {(r["a"], r["change"], r["old"] and r["old"]["v"], r["new"] and r["new"]["v"]) for r in own.changes(second).collect()}
    assert got == {(None, "updated", 1, 2), ("new", "added", None, 1), ("9", "removed", 9, None)}
    assert own.changes(third, third).count() == 0
    own.replace(spark.createDataFrame([("x", 1)], "a string, z int"), ["a"])
    with pytest.raises(ValueError):
        own.changes(first)
    with pytest.raises(ValueError):
        own.changes(99)


def test_a_changed_row_is_found_in_one_range(spark):
    columns = ["v", "t"]
    prev = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") * 3).alias("v"), F.when(F.col("id") % 7 > 0, F.col("id")).alias("t"))
    cur = prev.withColumn("v", F.when(F.col("k") == 1234, 0).otherwise(F.col("v")))
    prints = aggregates.fingerprints(prev, ["k"], ["k", *columns], 256)
    assert aggregates.changed_ranges(prints, aggregates.fingerprints(cur, ["k"], ["k", *columns], 256)).count() == 1
    for known in (None, prints):
        assert [tuple(r) for r in aggregates.local_diff(prev, cur, "k", columns, 256, known).collect()] == [(1234, "v", "3702", "0")]
    more = cur.where("k <> 77").unionByName(spark.createDataFrame([(-5, 1, None)], "k long, v long, t long"))
    got = aggregates.local_diff(prev, more, "k", columns, 256)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, aggregates.field_diff(prev, more, "k", columns).collect()))
    assert aggregates.local_diff(prev, prev, "k", columns).count() == aggregates.local_diff(prev.limit(0), prev.limit(0), "k", columns).count() == 0
