"""Sorts, limits, ranks and set operations with explicit orders."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def order_of(key: str, direction: str = "asc", nulls: str = "last") -> Column:
    c = F.col(key)
    return {("asc", "last"): c.asc_nulls_last, ("asc", "first"): c.asc_nulls_first, ("desc", "last"): c.desc_nulls_last, ("desc", "first"): c.desc_nulls_first}[direction, nulls]()


def class_order(key: str, classes: Sequence[str]) -> Column:
    """Position of a value in a list of classes; others come last."""
    table: Mapping[str, int] = {c: i for i, c in enumerate(classes)}
    out = F.lit(len(classes))
    for c, i in table.items():
        out = F.when(F.col(key) == c, i).otherwise(out)
    return out


def sort_by(df: DataFrame, keys: Sequence[tuple[str, str, str]]) -> DataFrame:
    """df ordered by (column, asc|desc, nulls first|last)."""
    return df.orderBy(*(order_of(*k) for k in keys))


def top_k(df: DataFrame, order: Sequence[Column], k: int, per: Sequence[str] = ()) -> DataFrame:
    """The first k rows in all, or of each group; Spark keeps k rows a task before it shuffles."""
    if not per:
        return df.orderBy(*order).limit(k)
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*per).orderBy(*order))).where(F.col("_n") <= k).drop("_n")


def with_rank(df: DataFrame, order: Sequence[Column], k: int, name: str = "rank") -> DataFrame:
    """The first k rows with their place from 1; the window sees only these k."""
    return df.orderBy(*order).limit(k).withColumn(name, F.row_number().over(Window.orderBy(*order)))


def union_fill(primary: DataFrame, wider: DataFrame, key: str) -> DataFrame:
    """primary, and the rows of wider whose key it lacks; columns that only one has are null in the other's rows."""
    return primary.unionByName(wider.join(primary.select(key).distinct(), key, "left_anti"), allowMissingColumns=True)


def key_sets(prev: DataFrame, cur: DataFrame, key: str) -> DataFrame:
    """Every key of either table with its side: new, removed or common."""
    a, b = prev.select(key).distinct().withColumn("_p", F.lit(1)), cur.select(key).distinct().withColumn("_c", F.lit(1))
    side = F.when(F.col("_p").isNull(), "new").when(F.col("_c").isNull(), "removed").otherwise("common")
    return a.join(b, key, "full").select(key, side.alias("side"))


def distinct_keep(df: DataFrame, keys: Sequence[str], order: Sequence[Column], keep: str = "first") -> DataFrame:
    """One row per key, the first or the last in an explicit order."""
    if keep not in ("first", "last"):
        raise ValueError("keep is first or last")
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    if keep == "first":
        return df.withColumn("_n", place).where("_n = 1").drop("_n")
    return df.withColumn("_n", place).withColumn("_m", F.count("*").over(Window.partitionBy(*keys))).where("_n = _m").drop("_n", "_m")


def timeline(*kinds: tuple[DataFrame, str, str, Column], key: str) -> DataFrame:
    """One table of several kinds of events: (table, label, time column, signed amount)."""
    out = None
    for df, label, ts, amount in kinds:
        part = df.select(key, F.lit(label).alias("label"), F.col(ts).alias("at"), amount.alias("amount"))
        out = part if out is None else out.unionByName(part)
    return out


def publish_projection(df: DataFrame, tags: Sequence[str]) -> DataFrame:
    """df without the columns in whose names a restricted tag stands, the rest in order."""
    return df.drop(*(c for c in df.columns if any(t.lower() in c.lower() for t in tags)))
