"""Sinks: ordered files, idempotent appends and upserts, dated snapshots, manifests and resumption."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyvane.sources.versioned import one_each, without

Names = Sequence[str]


def write_table(df: DataFrame, path: str, fmt: str = "csv", columns: Names | None = None, sort: Names = ()) -> None:
    """Write fixed columns in order, sorted over all files, nulls as empty cells."""
    out = df.select(*columns) if columns else df
    out = out.orderBy(*sort) if sort else out
    writer = out.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", True).option("emptyValue", "").option("nullValue", "")
    writer.format(fmt).save(path)


def append_dedup(existing: DataFrame, batch: DataFrame, keys: Names) -> DataFrame:
    """The rows of a batch that are to be appended: one of each key, none that is there already. A null key equals a null key."""
    return without(one_each(batch, keys, None), existing, keys)


def upsert(existing: DataFrame, batch: DataFrame, keys: Names, order: str | None = None) -> DataFrame:
    """existing with the batch's rows in place of its own of the same keys, nulls equal; of a batch's repeats the last in the order counts.

    Of rows in hand; versioned.Table keeps such a table on disk.
    """
    new = one_each(batch, keys, order)
    return without(existing, new, keys).unionByName(new.select(*existing.columns))


def write_snapshot(df: DataFrame, root: str, run_date: str) -> None:
    """The run's partition of a snapshot table, replacing one of the same day and no other."""
    df.withColumn("run_date", F.lit(run_date)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_date").parquet(root)


def run_manifest(expected: DataFrame, actual: DataFrame, asset: str, output: str) -> DataFrame:
    """Per asset how many outputs are expected, there and missing, and the first missing one."""
    both = expected.select(asset, output).distinct().join(actual.select(output, F.lit(True).alias("_there")).distinct(), output, "left")
    gone = F.col("_there").isNull()
    return both.groupBy(asset).agg(F.count("*").alias("expected"), F.count("_there").alias("present"), F.count_if(gone).alias("missing"), F.min(F.when(gone, F.col(output))).alias("first_missing"))


def missing_outputs(expected: DataFrame, actual: DataFrame, asset: str, output: str) -> DataFrame:
    """Rows (asset, output) that are expected and aren't there."""
    return expected.select(asset, output).distinct().join(actual.select(output).distinct(), output, "left_anti").select(asset, output)


def unprocessed(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key isn't among the processed ones."""
    return df.join(done.select(key).distinct(), key, "left_anti")
