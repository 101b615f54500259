"""Ranks, running counts and exact percentiles of values that no task could hold or sort whole.

Values are counted first, so a value with a third of all rows is one row. The counts are cut at bounds that an approximate
percentile gives; windows run inside (key, part), and a small table of parts carries the sums across them.
Finding the bounds is an action: one aggregate that returns `parts` numbers.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PARTS = 64


def _part(df: DataFrame, value: str, parts: int) -> Column:
    """Number of a value's part; an order-preserving function of it, so whenever it is evaluated it says the same."""
    shares = [i / parts for i in range(1, parts)]
    bounds = df.agg(F.percentile_approx(value, shares, 1000).alias("b")).first()["b"] or []
    return F.size(F.filter(F.array(*(F.lit(b) for b in sorted(set(bounds)))).cast(f"array<{df.schema[value].dataType.simpleString()}>"), lambda b: b < F.col(value)))


def running_counts(df: DataFrame, keys: Sequence[str], value: str, parts: int = PARTS) -> DataFrame:
    """Of each key and distinct value that isn't null: rows (n), rows of the key with a lesser value (before), and all of the key's (total)."""
    return running_over(df.groupBy(*keys, value).agg(F.count("*").alias("n")), keys, value, parts)


def running_over(counts: DataFrame, keys: Sequence[str], value: str, parts: int = PARTS) -> DataFrame:
    """running_counts() of rows that are counted already: n of each key and value, which are there once each. Keys aren't null."""
    counts = counts.where(F.col(value).isNotNull())
    counts = counts.withColumn("_part", _part(counts, value, parts))
    sums = counts.groupBy(*keys, "_part").agg(F.sum("n").alias("_n"))
    whole, upto = Window.partitionBy(*keys, F.lit(0)), Window.partitionBy(*keys, F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*keys, "_part", F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_before"), F.sum("_n").over(whole).alias("total"))
    inside = Window.partitionBy(*keys, "_part").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    both = counts.withColumn("_own", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(sums, [*keys, "_part"])
    return both.select(*keys, value, "n", (F.col("_before") + F.col("_own")).alias("before"), "total")


def at_places(counts: DataFrame, keys: Sequence[str], value: str, places: Mapping[str, Column]) -> DataFrame:
    """Per key of running counts, the value at each place in the order, from 0; a place between two is interpolated."""
    aggs = []
    for name, place in places.items():
        for end, at in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            aggs.append(F.max(F.when((F.col("before") <= at) & (at < F.col("before") + F.col("n")), F.col(value))).alias(f"_{name}_{end}"))
        aggs.append(F.first(place - F.floor(place)).alias(f"_{name}_at"))
    out = counts.groupBy(*keys).agg(*aggs, F.first("total").alias("total"))
    between = lambda n: F.col(f"_{n}_lo") + (F.col(f"_{n}_hi") - F.col(f"_{n}_lo")) * F.col(f"_{n}_at")
    return out.select(*keys, *(between(n).alias(n) for n in places), "total")


def percentiles(df: DataFrame, keys: Sequence[str], value: str, shares: Mapping[str, float]) -> DataFrame:
    """Linear-interpolated percentiles of each key, exact whatever the size of a key."""
    return at_places(running_counts(df, keys, value), keys, value, {n: (F.col("total") - 1) * F.lit(p) for n, p in shares.items()}).drop("total")


def with_rank(df: DataFrame, value: str, name: str) -> DataFrame:
    """df with the rank of each row by value, the greatest first, equal ones alike; rows without a value go."""
    ranks = running_counts(df, [], value).select(value, (F.col("total") - F.col("before") - F.col("n") + 1).cast("long").alias(name))
    return df.join(ranks, value)


def numbered(df: DataFrame, text: str, name: str, parts: int = PARTS) -> DataFrame:
    """df, whose texts are distinct, with their numbers from 1 in the order of the texts."""
    head = F.conv(F.rpad(F.hex(F.encode(F.substring(text, 1, 4), "UTF-8")), 32, "0").substr(1, 12), 16, 10).cast("long")
    own = df.withColumn("_head", head)
    own = own.withColumn("_part", _part(own, "_head", parts))
    sums = own.groupBy("_part").agg(F.count("*").alias("_n"))
    sums = sums.select("_part", F.coalesce(F.sum("_n").over(Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(text))
    return own.withColumn(name, place).join(F.broadcast(sums), "_part").withColumn(name, (F.col(name) + F.col("_before")).cast("long")).drop("_head", "_part", "_before")
