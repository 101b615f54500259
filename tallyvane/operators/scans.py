"""Ordered scans of keys that may hold a third of all rows: a key's time is cut in parts, and parts hand on what they end with.

A window over a key is one task's. Here a key of more than `most` rows gets time limits from approximate percentiles; windows
run inside its parts, and a small table with a row a part (its last value, its last row, its sum) carries over from each part to the
next. Keys of fewer rows are one part, and where no key has more nothing is cut. Rows of one key and time lie in one part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Names = Sequence[str]
#: Rows of a key that one task scans.
MOST = 1_000_000
#: Parts of a key, at most: as many as the percentiles are told apart by.
PARTS = 4096
PART = "_part"


def same(a: Names, prefix: str = "_k_") -> list[Column]:
    return [F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in a]


def renamed(df: DataFrame, keys: Names, *more: str) -> DataFrame:
    """Keys under other names, for joins in which nulls are equal, and more columns."""
    return df.select(*(F.col(k).alias(f"_k_{k}") for k in keys), *more)


def in_parts(df: DataFrame, keys: Names, ts: str, most: int = MOST) -> DataFrame | None:
    """df with _part, rising with ts inside each of the keys; None where no key has more than so many rows. Counting is an action when the plan is made.

    ts is a number, date or timestamp; its nulls are in the first part, where an ascending order puts them.
    """
    counts = df.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > most)
    worst = counts.agg(F.max("_n").alias("n")).first()["n"]
    if worst is None:
        return None
    cuts = min(PARTS, -(-worst // most))
    # There is at most a key for every `most` rows, each with at most PARTS limits, so both are broadcast: no key of df is gathered in a task.
    large = F.broadcast(renamed(counts, keys))
    limits = df.join(large, same(keys), "left_semi").groupBy(*keys).agg(F.array_distinct(F.percentile_approx(ts, [i / cuts for i in range(1, cuts)], 10_000)).alias("_limits"))
    met = df.join(F.broadcast(renamed(limits, keys, "_limits")), same(keys), "left").drop(*(f"_k_{k}" for k in keys))
    part = F.coalesce(F.size(F.filter("_limits", lambda x: x <= F.col(ts))), F.lit(0))
    return met.withColumn(PART, F.when(F.col("_limits").isNull() | F.col(ts).isNull(), 0).otherwise(part)).drop("_limits")


def carried(parts: DataFrame, keys: Names, summary: dict[str, Column], over: dict[str, Column]) -> DataFrame:
    """Of rows with _part: per key and part what comes before it. summary: aggregates of a part; over: what is made of those of earlier parts.

    The columns of over are window functions' arguments (F.sum, F.last, ...) on the summary's names, taken over all earlier parts.
    """
    small = parts.groupBy(*keys, PART).agg(*(c.alias(n) for n, c in summary.items()))
    before = Window.partitionBy(*keys).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    return small.select(*keys, PART, *(c.over(before).alias(n) for n, c in over.items()))


def with_carried(parts: DataFrame, before: DataFrame, keys: Names) -> DataFrame:
    """parts with the columns of carried(), whose table has a row for each of them."""
    own = [*keys, PART]
    more = [c for c in before.columns if c not in own]
    return parts.join(renamed(before, own, *more), same(own)).drop(*(f"_k_{k}" for k in own))


def last_so_far(df: DataFrame, keys: Names, ts: str, order: Sequence[str], value: str, out: str, most: int | None = MOST) -> DataFrame:
    """df with the last value that isn't null up to each row, in the order of ts and then the others. most None: no key is looked at."""
    cut = in_parts(df, keys, ts, most) if most else None
    upto = Window.partitionBy(*keys, *([PART] if cut is not None else [])).orderBy(ts, *order).rowsBetween(Window.unboundedPreceding, 0)
    within = F.last(value, ignorenulls=True).over(upto)
    if cut is None:
        return df.withColumn(out, within)
    place = F.when(F.col(value).isNotNull(), F.struct(ts, *order))
    before = carried(cut, keys, {"_end": F.max_by(value, place)}, {"_before": F.last("_end", ignorenulls=True)})
    return with_carried(cut, before, keys).withColumn(out, F.coalesce(within, "_before")).drop(PART, "_before")


def sum_so_far(df: DataFrame, keys: Names, ts: str, order: Sequence[str], value: Column, out: str, most: int | None = MOST) -> DataFrame:
    """df with the sum of value up to each row, itself included, in the order of ts and then the others."""
    df = df.withColumn("_value", value)
    cut = in_parts(df, keys, ts, most) if most else None
    upto = Window.partitionBy(*keys, *([PART] if cut is not None else [])).orderBy(ts, *order).rowsBetween(Window.unboundedPreceding, 0)
    within = F.sum("_value").over(upto)
    if cut is None:
        return df.withColumn(out, within).drop("_value")
    before = carried(cut, keys, {"_sum": F.sum("_value")}, {"_before": F.sum("_sum")})
    return with_carried(cut, before, keys).withColumn(out, F.coalesce(within, F.lit(0)) + F.coalesce("_before", F.lit(0))).drop("_value", PART, "_before")


def row_before(df: DataFrame, keys: Names, ts: str, value: str, out: str, most: int | None = MOST) -> DataFrame:
    """df with the value of the row before, by ts, of which a key has each time once; null for its first row, and where that value is null."""
    cut = in_parts(df, keys, ts, most) if most else None
    if cut is None:
        return df.withColumn(out, F.lag(value).over(Window.partitionBy(*keys).orderBy(ts)))
    inside = Window.partitionBy(*keys, PART).orderBy(ts)
    before = carried(cut, keys, {"_end": F.max_by(F.struct(value), F.struct(ts))}, {"_before": F.last("_end", ignorenulls=True)})
    first = F.row_number().over(inside) == 1
    return with_carried(cut, before, keys).withColumn(out, F.when(first, F.col(f"_before.{value}")).otherwise(F.lag(value).over(inside))).drop(PART, "_before")


def numbered(df: DataFrame, keys: Names, ts: str, order: Sequence[str], place: str, total: str, most: int | None = MOST) -> DataFrame:
    """df with each row's number from 1 inside its keys, in the order of ts and then the others, and the number of rows there are."""
    cut = in_parts(df, keys, ts, most) if most else None
    if cut is None:
        return df.withColumn(place, F.row_number().over(Window.partitionBy(*keys).orderBy(ts, *order))).withColumn(total, F.count("*").over(Window.partitionBy(*keys)))
    own = F.row_number().over(Window.partitionBy(*keys, PART).orderBy(ts, *order))
    small = cut.groupBy(*keys, PART).agg(F.count("*").alias("_rows"))
    before = Window.partitionBy(*keys).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    known = small.select(*keys, PART, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"), F.sum("_rows").over(Window.partitionBy(*keys)).alias(total))
    return with_carried(cut, known, keys).withColumn(place, own + F.col("_before")).select(*df.columns, place, total)
