"""Structured Streaming jobs over a folder of arriving observations.

Event times must be timestamps with a zone; each job states what its checkpoint makes it safe against.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from tallyvane.operators.gates import apply_gates
from tallyvane.sources.versioned import Table
from tallyvane.sources.writers import upsert


def read_stream(spark: SparkSession, path: str, schema: StructType, ts: str, watermark: str, per_trigger: int | None = None) -> DataFrame:
    """A stream of Parquet files with ts as a zoned timestamp and a watermark on it."""
    reader = spark.readStream.schema(schema)
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.parquet(path).withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark)


def stream_ingest(src: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The first row of each key within the watermark; with a checkpointed file sink each is written once."""
    return src.dropDuplicatesWithinWatermark(list(keys))


def stream_gate(src: DataFrame, gates: Sequence[tuple[Column, str]], ok_path: str, bad_path: str, checkpoint: str):
    """Start routing rows: those that pass every gate to one table, the others with their reason to another.

    Each batch writes its own partition of either table, so a batch that is run again after a failure replaces itself.
    """

    def route(batch: DataFrame, batch_id: int) -> None:
        tagged = apply_gates(batch, gates).persist()
        try:
            tagged.where("status = 'ok'").drop("status", "reason").write.mode("overwrite").parquet(f"{ok_path}/batch={batch_id}")
            tagged.where("status <> 'ok'").drop("status").write.mode("overwrite").parquet(f"{bad_path}/batch={batch_id}")
        finally:
            tagged.unpersist()

    return src.writeStream.foreachBatch(route).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_prices(src: DataFrame, item: str, source: str, date: str, price: str) -> DataFrame:
    """The lowest price of the newest day of each (item, source), of a table or a stream: a late row never replaces a newer day's price."""
    best = F.max(F.struct(F.col(date), (-F.col(price)).alias("_p"))).alias("b")
    return src.where(F.col(price).isNotNull()).groupBy(item, source).agg(best).select(item, source, F.col(f"b.{date}").alias(date), (-F.col("b._p")).alias(price))


def stream_floor(src: DataFrame, item: str, source: str, date: str, price: str, root: str, checkpoint: str, fold: int = 16):
    """Start keeping the latest price of each (item, source): the state is Spark's, and a batch writes the rows it changed. floor_table() reads them.

    They go to a folder of the batch's own under root, so a batch that is run again replaces itself. Every `fold` batches all that
    lies there is folded into a versioned table, and folders that were folded in an earlier round are removed: at most twice so
    many stay, and what a reader has listed is there for as many batches more. A death between the two leaves rows in both, of
    which latest_prices() makes one: an older state of a key never wins.
    """
    spark = src.sparkSession

    def step(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/new/batch={batch_id}")
        if (batch_id + 1) % fold == 0:
            folded = Table(spark, f"{root}/folded")
            there = spark.read.schema(batch.schema).parquet(f"{root}/new").select(*batch.columns)
            changed = there.select(F.col(item).alias("_item"), F.col(source).alias("_source")).distinct()
            known = there.unionByName(folded.read().select(*batch.columns)) if folded.versions() else there
            # Only keys that a batch changed are written; what the table knows of them takes part in the choice.
            folded.upsert(latest_prices(known.join(changed, F.col(item).eqNullSafe(F.col("_item")) & F.col(source).eqNullSafe(F.col("_source")), "left_semi"), item, source, date, price), [item, source])
            folded.vacuum()
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/new")
            files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
            for made in files.listStatus(path):
                name = made.getPath().getName()
                if name.startswith("batch=") and int(name.removeprefix("batch=")) <= batch_id - fold:
                    files.delete(made.getPath(), True)

    return latest_prices(src, item, source, date, price).writeStream.outputMode("update").foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def floor_table(spark: SparkSession, root: str, item: str, source: str, date: str, price: str) -> DataFrame:
    """The latest prices that stream_floor() has written under root: the folded table and the batches after it."""
    new = spark.read.parquet(f"{root}/new").drop("batch")
    folded = Table(spark, f"{root}/folded")
    return latest_prices(new.unionByName(folded.read()) if folded.versions() else new, item, source, date, price)


def floor_of(latest: DataFrame, item: str, source: str, price: str) -> DataFrame:
    return latest.groupBy(item).agg(F.min(F.struct(price, source)).alias("b")).select(item, F.col(f"b.{price}").alias("floor"), F.col(f"b.{source}").alias("floor_source"))


def stream_changes(src: DataFrame, key: str, ts: str, value: str, keep_hours: float | None = None) -> DataFrame:
    """A row (key, ts, old, new, kind) whenever a key's value differs from the last one seen; kind is new or changed. Rows older than what was seen are ignored.

    The state is a time and a value a key. With keep_hours, which needs a watermark, a key that wasn't seen for so long is
    forgotten, and new when it comes back; without, keys are kept for good.
    """
    kinds = {f.name: f.dataType for f in src.schema.fields}
    out = StructType().add(key, kinds[key]).add(ts, kinds[ts]).add("old", kinds[value]).add("new", kinds[value]).add("kind", "string")
    kept = StructType().add("at", "long").add("value", kinds[value])

    def run(group: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        at, last, known = (*state.get, True) if state.exists else (None, None, False)
        rows = pd.concat(list(parts)).sort_values(ts, kind="stable")
        found = []
        for t, v in zip(rows[ts], rows[value], strict=True):
            micros = int(pd.Timestamp(t).value // 1000)
            if known and micros < at:
                continue
            if not known or v != last:
                found.append((group[0], t, last, v, "changed" if known else "new"))
            at, last, known = micros, v, True
        state.update((at, last))
        if keep_hours is not None:
            state.setTimeoutTimestamp(max(int(at / 1000 + keep_hours * 3_600_000), state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(found, columns=[f.name for f in out.fields])

    return src.select(key, ts, value).groupBy(key).applyInPandasWithState(run, out, kept, "append", GroupStateTimeout.NoTimeout if keep_hours is None else GroupStateTimeout.EventTimeTimeout)


def tumbling(src: DataFrame, ts: str, size: str, value: str, keys: Sequence[str] = (), start: str | None = None) -> DataFrame:
    """Count and sum by windows of a size; start `4 days` makes weeks begin on Monday."""
    return src.groupBy(F.window(ts, size, startTime=start).alias("w"), *keys).agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(F.col("w.start").alias("start"), *keys, "n", "total")


def sliding(src: DataFrame, ts: str, size: str, step: str, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Count, mean and least of every window of a size, one each step."""
    return src.groupBy(F.window(ts, size, step).alias("w"), *keys).agg(F.count("*").alias("n"), F.avg(value).alias("mean"), F.min(value).alias("low")).select(F.col("w.start").alias("start"), *keys, "n", "mean", "low")


def sessions(src: DataFrame, ts: str, gap: str, keys: Sequence[str]) -> DataFrame:
    """Runs of activity of a key that no pause longer than the gap interrupts."""
    return src.groupBy(*keys, F.session_window(ts, gap).alias("w")).agg(F.count("*").alias("n")).select(*keys, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


__all__ = ["floor_of", "floor_table", "latest_prices", "read_stream", "sessions", "sliding", "stream_changes", "stream_floor", "stream_gate", "stream_ingest", "tumbling", "upsert"]
