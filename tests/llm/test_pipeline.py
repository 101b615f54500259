"""The pipeline's stages by hand, and the registered SQL of the subpackage."""

import pytest
from oracle import database, same
from pyspark.sql import functions as F

import corpus_pipeline
from tallyvane.llm import queries

DATA = "/root/testdata"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
STAGE = dict(corpus_pipeline.STAGES)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    same(queries.QUERIES[name](spark, f"{DATA}/sf0.001").toPandas(), database("sf0.001").sql(queries.ORACLE_SQL[name]).df())


def test_stages_are_registered():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "simhash_near_dedup", "benchmark_decontamination", "pii", "packing"]
    assert len(queries.QUERIES) == 13


def test_every_stage_decides(spark):
    sf = f"{DATA}/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    item = spark.read.parquet(f"{sf}/benchmark.parquet").first()["text"]
    text = docs.where("lang = 'en' and n_chars > 800").first()["text"]
    planted = [(9001, "12345 !!!"), (9002, None), (9003, text), (9004, text.upper()), (9005, f"{text[:200]} {item} {text[200:400]}"), (9006, "the reader of this and that wrote to bob@example.com once more")]
    all_docs = docs.unionByName(spark.createDataFrame([(i, t, None, "s", 1) for i, t in planted], SCHEMA))
    ids = lambda df: {r["doc_id"] for r in df.select("doc_id").collect()}
    a = STAGE["language_id"](spark, all_docs, sf)
    assert ids(all_docs) - ids(a) == {9001, 9002} | ids(docs.where("text is null or not text rlike '\\\\p{L}'")) and a.columns == docs.columns
    assert a.where("lang is null").count() == 0
    b = STAGE["simhash_near_dedup"](spark, a, sf)
    assert not {9003, 9004} & ids(b) and {9005, 9006} <= ids(b) and b.columns == docs.columns
    c = STAGE["benchmark_decontamination"](spark, b, sf)
    assert 9005 not in ids(c) and 9006 in ids(c) and c.columns == docs.columns
    d = STAGE["pii"](spark, c, sf)
    assert "<EMAIL>" in d.where("doc_id = 9006").first()["text"] and d.where(F.length("text") != F.col("n_chars")).count() == 0 and d.columns == docs.columns
    e = STAGE["packing"](spark, d, sf)
    assert ids(e) == ids(d)


def test_stages_decide_about_rows(spark, tmp_path):
    """Repeated rows, ids that are null or stand on two texts, and columns of clashing names; from files and from memory."""
    sf = f"{DATA}/sf0.001"
    item = spark.read.parquet(f"{sf}/benchmark.parquet").first()["text"]
    one, two, three = (f"{w} wrote this long and quiet story about the old house by the sea and its garden" for w in ("anna", "bruno wholly otherwise", "carla"))
    rows = [(1, one), (1, one), (1, "Something else stands under the same number here, and nobody minds it at all."), (2, one.upper()), (None, one), (None, two), (None, two), (3, f"before it {item} after it"), (None, f"before that {item} after that"), (3, three + " with more words than the others have, of which none are known")]
    plain = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA).withColumns({"score": F.lit("mine"), "file": F.lit(1), "_said": F.lit(2), "lang_pred": F.lit(3)})
    plain.repartition(3).write.parquet(str(tmp_path / "docs"))
    for docs in (plain, spark.read.parquet(str(tmp_path / "docs"))):
        assert sorted(map(repr, STAGE["language_id"](spark, docs, sf).collect())) == sorted(map(repr, docs.collect()))
        left = STAGE["simhash_near_dedup"](spark, docs, sf)
        texts = sorted(r["text"] for r in left.collect())
        assert texts == sorted({t for i, t in rows if t.lower() != one} | {one}) and left.columns == docs.columns and left.where(F.col("text") == one).first()["doc_id"] == 1
        clean = STAGE["benchmark_decontamination"](spark, docs, sf)
        assert clean.count() == len(rows) - 2 and clean.where(F.contains("text", F.lit(item))).count() == 0
        assert STAGE["pii"](spark, docs.drop("n_chars"), sf).columns == [c for c in docs.columns if c != "n_chars"]


def test_stages_of_an_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, f"{DATA}/sf0.001").count() == 0
    unknown = spark.createDataFrame([(1, "some words", None, None, 1), (2, "12 34", None, None, 1), (3, None, None, None, None)], SCHEMA)
    assert [r["doc_id"] for r in STAGE["language_id"](spark, unknown, "").collect()] == [1]


def test_stages_take_very_long_texts(spark):
    """A text of two million characters in every stage, beside null and empty ones."""
    sf = f"{DATA}/sf0.001"
    item = spark.read.parquet(f"{sf}/benchmark.parquet").first()["text"]
    long = "the long story of a house by the sea goes on and on " * 40_000
    rows = [(1, long, None, "s", 1), (2, f"{long} {item} {long}", "en", "s", 1), (3, f"mail bob@corp.com {long} card", "en", "s", 1), (4, "", None, None, None), (5, None, None, None, None), (6, "der kurze Text von heute", "de", "s", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    ids = lambda df: sorted(r["doc_id"] for r in df.select("doc_id").collect())
    assert ids(STAGE["language_id"](spark, docs, sf)) == [1, 2, 3, 6]
    assert {4, 6} <= set(ids(STAGE["simhash_near_dedup"](spark, docs, sf)))
    assert ids(STAGE["benchmark_decontamination"](spark, docs, sf)) == [1, 3, 4, 5, 6]
    masked = {r["doc_id"]: r["text"] for r in STAGE["pii"](spark, docs, sf).collect()}
    assert masked[3] == f"mail <EMAIL> {long} card" and masked[1] == long and masked[4] == "" and masked[5] is None
    packed = STAGE["packing"](spark, docs, sf).groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("t")).collect()
    assert len(packed) == 6 and all(r["n"] == r["t"] for r in packed)
