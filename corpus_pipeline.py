"""The corpus pipeline: what the operators decide about documents, applied one after the other.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each one's and hands it to the next. All
but the last return the columns of documents. Stages decide about rows, which common.keyed() names, so ids that are
null or repeat change nothing, and columns of docs beside its own pass through, whatever their names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyvane.llm import decontam, langid, packing, pii, simhash
from tallyvane.llm.common import bounded, cut, keyed, stored, table


def _own(name: str) -> str:
    """A column name that no table has."""
    return f"_{name}_{uuid.uuid4().hex}"


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language: null texts and those without a letter. A missing lang is filled in; a given one stays.

    Where no document says its lang there is nothing to learn and to fill in, and the same documents go.
    """
    model, name, score = langid.fit(docs), _own("lang"), _own("score")
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    said = langid.predict(docs, model, lang_out=name, score_out=score)
    return said.where(F.col(name) != langid.UNDETERMINED).withColumn("lang", F.coalesce("lang", name)).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates: that of the least id, of rows that repeat one, of null ids the last resort."""
    key = _own("key")
    own = keyed(docs, key)
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", f"{key}.file", f"{key}.row")
    found = simhash.near_duplicates(own.select(order.alias("doc_id"), "text"))
    extra = cut(found.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.struct("doc_id.file", "doc_id.row").alias(key)))
    return own.join(bounded(extra), key, "left_anti").select(docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage of the benchmark, those without an id too.

    Null and empty texts hold none and stay, and so do all documents where the benchmark is empty; texts are read whole, whatever their length.
    """
    key = _own("key")
    own = keyed(docs, key)
    found = cut(decontam.contaminated(own.select(key, "text"), table(spark, sf_dir, "benchmark"), id_col=key).select(F.col("doc_id").alias(key)).distinct())
    return own.join(bounded(found), key, "left_anti").select(docs.columns)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks personal data in the texts; n_chars, where there is one, follows.

    Null and empty texts stay as they are, repeated rows are each masked, and texts are read whole, whatever their length.
    """
    masked = pii.redact(docs)
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return masked.select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents, placed in sequences.

    A null or empty text is a piece of its end id; a text longer than a sequence has several pieces; repeated rows each have their own.
    """
    return packing.pack(docs)


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", decontaminate),
    ("pii", mask_personal_data),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return stored(STAGES[-1][1](spark, docs, sf_dir))


#: SQL can't say these models, fingerprints and token ids; tests hold the stages against brute force.
ORACLE_SQL = None
