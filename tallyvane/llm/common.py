"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: what the cluster names in spark.checkpoint.dir.

    Where it is unset, a temporary folder serves a session in one process (local[n]); on a cluster that is an error, as
    the executors wouldn't see each other's files.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="spark-"))
    # Spark makes a folder of its own in the one that is named; it goes when the driver ends.
    files, folder = on_disk(spark, context.getCheckpointDir())
    files.deleteOnExit(folder)
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """df, computed once and written to the shared checkpoint folder: a lost executor loses nothing of it."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def held_out(doc_id: Column | str, folds: int) -> Column:
    """True for the rows that no model may learn from: crc32 of the id as text leaves 0 modulo the folds."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % folds == 0, F.lit(False))


def small_batches(spark: SparkSession, rows: int = 500) -> None:
    """Bound what one Arrow batch of whole texts can hold in a Python worker.

    Spark reads this setting when a plan runs, and the operators return plans, so it stays lowered for the session.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows:
        spark.conf.set(key, str(rows))


def sampled(df: DataFrame, key: str, expected: int, total: int) -> DataFrame:
    """The rows whose hashed key falls under expected/total: a fixed sample, of the expected size in the mean, the same on every run."""
    if total <= expected:
        return df
    return df.where(F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit("sample")), F.lit(1_000_000)) < int(1_000_000 * expected / total))


def on_disk(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as it takes it."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def stored(df: DataFrame) -> DataFrame:
    """Like cut(), for a large table: Parquet in the shared folder, deleted when the driver ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    files, folder = on_disk(spark, path)
    files.deleteOnExit(folder)
    return spark.read.parquet(path)


def removed(spark: SparkSession, path: str) -> None:
    """Delete a folder of any file system Spark knows; one that isn't there is no error."""
    files, folder = on_disk(spark, path)
    files.delete(folder, True)


#: Ids of at most so many rows (16 bytes each) are broadcast, after they were counted.
BROADCAST_IDS = 1_000_000


def bounded(df: DataFrame, rows: int = BROADCAST_IDS) -> DataFrame:
    """df with a broadcast hint if it has at most so many rows; a larger one is left to a shuffled join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def keyed(docs: DataFrame, key: str) -> DataFrame:
    """docs with a struct column `key` that names each row, repeated ones apart, the same whenever it is read.

    Parquet files give their own (file, row); the key of anything else is given once and kept in a stored copy.
    """
    try:
        return docs.select("*", F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")).alias(key))
    except AnalysisException:
        return stored(docs.select("*", F.struct(F.lit(0).cast("long").alias("file"), F.monotonically_increasing_id().alias("row")).alias(key)))
