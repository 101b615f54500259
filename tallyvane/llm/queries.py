"""The registered queries of this subpackage: each applies one operator to its whole tables, with production parameters."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyvane.llm import bpe, brown_lm, decontam, langid, negatives, packing, pii, rollups, simhash, topk, toxicity, url_lists, whitening
from tallyvane.llm.common import cut, held_out, shared_dir, table


def op1_toxicity_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", held_out("doc_id", 5).alias("held_out"), "text")
    model = toxicity.fit(docs.where(~F.col("held_out")), table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", "held_out", "score", "predicted")


def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cut(table(spark, sf_dir, "embeddings").select("vec_id", topk.sign_code("embedding").alias("code")))
    return topk.search(rows.where(F.col("vec_id") % 50 == 0), rows)


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op5_brown_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", held_out("doc_id", 10).alias("held_out"), "text")
    return brown_lm.fit_and_score(docs, "held_out")


def url_entries(pages: DataFrame) -> DataFrame:
    """A dated list over the hosts of pages and their parents. The tables have no list, so its dates follow from the least page id of each."""
    hosts = pages.select("page_id", F.explode(url_lists.suffixes("host")).alias("pattern"))
    seeds = hosts.groupBy("pattern").agg(F.min("page_id").alias("seed"))
    dated = seeds.select(
        "pattern",
        F.explode(
            F.array(
                F.struct(F.lit("block").alias("action"), (F.col("seed") % 200).alias("day"), (F.col("seed") % 2 == 0).alias("given")),
                F.struct(F.lit("remove").alias("action"), (F.col("seed") % 200 + 40 + F.col("seed") % 50).alias("day"), (F.col("seed") % 3 == 0).alias("given")),
                F.struct(F.lit("allow").alias("action"), (300 + F.col("seed") % 30).alias("day"), (F.col("seed") % 5 == 0).alias("given")),
            )
        ).alias("e"),
    ).select("pattern", "e.*")
    return dated.where("given").select("pattern", "action", F.expr("date_add(date'2024-01-01', cast(day as int))").cast("timestamp").alias("listed_at"))


def op6_url_temporal_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url").withColumn("host", url_lists.host_of(F.col("url")))
    captures = pages.withColumn("fetched_at", F.timestamp_seconds(F.lit(1704067200) + 60 * (F.col("page_id") * 7919 % 525600)))
    return url_lists.judge(captures, url_entries(pages), "page_id")


OP6_SQL = """
with h as (
  select page_id, timestamp '2024-01-01' + to_minutes((page_id * 7919 % 525600)::bigint) fetched_at,
    nullif(rtrim(lower(regexp_extract(url, '^\\s*[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(\\[[^\\]/?#]*\\]|[^/?#:\\[]+)', 1)), '.'), '') host from pages),
p as (select page_id, host, fetched_at, string_split(host, '.') parts from h),
x as (
  select page_id, host, fetched_at, unnest(range(case when regexp_matches(host, '^([0-9.]+|\\[.*)$') then 1 else greatest(len(parts) - 1, 1) end)) depth, parts from p where host is not null),
s as (select page_id, host, fetched_at, depth, array_to_string(parts[depth + 1:], '.') pattern from x),
seeds as (select pattern, min(page_id) seed from s group by 1),
e as (
  select pattern, 'block' act, timestamp '2024-01-01' + to_days((seed % 200)::int) t from seeds where seed % 2 = 0
  union all select pattern, 'remove', timestamp '2024-01-01' + to_days((seed % 200 + 40 + seed % 50)::int) from seeds where seed % 3 = 0
  union all select pattern, 'allow', timestamp '2024-01-01' + to_days((300 + seed % 30)::int) from seeds where seed % 5 = 0),
one as (select pattern, t, max(act) act from e group by all),
iv as (select pattern, act, t f, lead(t) over (partition by pattern order by t) u from one),
hit as (
  select s.page_id, iv.act, iv.pattern, row_number() over (partition by s.page_id order by depth) r
  from s join iv on s.pattern = iv.pattern and act <> 'remove' and fetched_at >= f and (u is null or fetched_at < u))
select h.page_id, h.host, coalesce(hit.act, 'unlisted') verdict, hit.pattern from h left join hit on h.page_id = hit.page_id and r = 1
"""


VERSIONS = ("byte_bpe_50k", "byte_bpe_multi_50k")


def op8_token_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents inserted under one tokenizer version, some deleted, some counted anew by the next; the deletes are committed twice.

    Byte-pair counts have no SQL form: a test holds the totals against counts of its own.
    """
    gone = F.coalesce(F.col("doc_id") % 11 == 0, F.lit(False))
    anew = ~gone & F.coalesce(F.col("doc_id") % 3 == 0, F.lit(False))
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text", gone.alias("gone"), anew.alias("anew"))
    counts = cut(rollups.token_counts(docs, {f"{VERSIONS[0]}.tiktoken": F.lit(True), f"{VERSIONS[1]}.tiktoken": F.col("anew")}))

    def side(prefix: str, version: str | None) -> list:
        columns = {"source": F.col("source"), "lang": F.col("lang"), "tokenizer": F.lit(version), "tokens": F.col(version) if version else None}
        return [(c if version else F.lit(None)).cast("long" if k == "tokens" else "string").alias(f"{prefix}_{k}") for k, c in columns.items()]

    old, new = VERSIONS
    inserts = counts.select(F.lit("insert").alias("op"), *side("old", None), *side("new", old))
    deletes = counts.where("gone").select(F.lit("delete").alias("op"), *side("old", old), *side("new", None))
    revisions = counts.where("anew").select(F.lit("revise").alias("op"), *side("old", old), *side("new", new))
    ledger = f"{shared_dir(spark)}/ledger-{uuid.uuid4().hex}"
    for batch, changes in (("0001", inserts), ("0002", deletes), ("0003", revisions), ("0002", deletes)):
        rollups.commit(changes, ledger, batch)
    return rollups.totals(spark, ledger)


def op7_pii_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return pii.digest(found)


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", held_out("doc_id", 5).alias("held_out"))
    model = langid.fit(docs.where(~F.col("held_out")))
    return langid.predict(docs.select("doc_id", "held_out", "text"), model).select("doc_id", "held_out", "lang_pred", "score")


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.digest(table(spark, sf_dir, "embeddings"))


def op12_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(bpe.encoded(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec_id = F.col("vec_id")
    label = F.when(vec_id % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(negatives.whole(table(spark, sf_dir, "embeddings"), label, vec_id % 100 == 0))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_toxicity_segments,
        op2_exact_topk,
        op3_benchmark_decontamination,
        op4_packing,
        op5_brown_lm_scoring,
        op6_url_temporal_lists,
        op7_pii_weak_supervision,
        op8_token_rollups,
        op9_simhash_near_dedup,
        op10_language_id,
        op11_embedding_whitening,
        op12_bpe_encoding,
        op13_hard_negatives,
    )
}

#: DuckDB SQL for the queries that SQL can express.
ORACLE_SQL: dict[str, str] = {
    "op2_exact_topk": topk.SQL,
    "op3_benchmark_decontamination": decontam.SQL,
    "op6_url_temporal_lists": OP6_SQL,
    "op13_hard_negatives": negatives.SQL,
}
