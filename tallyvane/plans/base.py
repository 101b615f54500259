"""The registry of queries, and the tables they share: observations and monthly snapshots out of lineitem."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Sequence
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None, dates: Sequence[str] = ()):
    """Register a query under its function's name, with the SQL that gives the same rows.

    dates: columns that both sides return as text, since clients show dates differently.
    """

    def add(f):
        @wraps(f)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(spark, sf_dir).withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in dates})

        QUERIES[f.__name__] = run
        if sql:
            shown = ", ".join(f"strftime(\"{c}\", '%Y-%m-%d') as \"{c}\"" for c in dates)
            ORACLE_SQL[f.__name__] = f"select * replace ({shown}) from ({sql})" if dates else sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(item, source, d, price): a line is a price seen for a part at one of five sources."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("item"),
        F.concat(F.lit("S"), (F.col("l_suppkey") % 5).cast("string")).alias("source"),
        F.col("l_shipdate").cast("date").alias("d"),
        F.round("l_extendedprice").cast("bigint").alias("price"),
    )


OBS = "obs as (select l_partkey item, 'S' || (l_suppkey % 5) source, l_shipdate::date d, round(l_extendedprice)::bigint price from lineitem)"


def monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(month, item, price, qty): the lowest price and the rows of each part in each month."""
    o = obs(spark, sf_dir)
    return o.groupBy(F.date_format("d", "yyyy-MM").alias("month"), "item").agg(F.min("price").alias("price"), F.count("*").alias("qty"))


MONTHLY = f"{OBS}, monthly as (select strftime(d, '%Y-%m') \"month\", item, min(price) price, count(*)::bigint qty from obs group by 1, 2)"

PREV, CUR = "1998-05", "1998-06"


def pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    m = monthly(spark, sf_dir)
    return m.where(F.col("month") == PREV).drop("month"), m.where(F.col("month") == CUR).drop("month")


PAIR = f"{MONTHLY}, prev as (select item, price, qty from monthly where \"month\" = '{PREV}'), cur as (select item, price, qty from monthly where \"month\" = '{CUR}')"


def shared_folder(spark: SparkSession, kind: str) -> str:
    """A new folder beside the checkpoints that all executors share, gone when the driver ends; a temporary one serves a session in one process only."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{named or tempfile.mkdtemp(prefix='spark-')}/{kind}-{uuid.uuid4().hex}")
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return f"{path.toString()}/rows"
