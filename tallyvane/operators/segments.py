"""Merging of consecutive rows of a key, however long: sorted partitions are read as streams and handed on from one to the next.

What a partition needs of those before it is one thing, the first name of the segment that is open where it begins. All partitions
are read at once as if none were open; where that was wrong a partition is read again with what the one before ended with, until nothing
changes. Each round sets at least one more partition right, and mostly all: two readings agree from the first row on at which both
begin a segment. The driver sees one row a partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tallyvane.operators.lineage import settled

_ENDS = "_at int, head string, key string, first string, number long, one boolean"


class _Open:
    """The segment that a stream of rows is in: its key, its first name, and its number inside the key, of which -1 is none."""

    def __init__(self, key: str | None = None, first: str = "", number: int = -1):
        self.key, self.first, self.number = key, first, number

    def take(self, key: str | None, name: str) -> int:
        """The number of the segment that the next row belongs to."""
        if self.number < 0 or key != self.key:
            self.key, self.first, self.number = key, name, 0
        elif name != self.first and not (name and self.first and (name in self.first or self.first in name)):
            self.first, self.number = name, self.number + 1
        return self.number


def _names(batch: pa.RecordBatch) -> Iterator[tuple[int, str | None, str]]:
    columns = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("_at", "_key", "_name"))
    return zip(*columns, strict=True)


def _ends(rows: DataFrame, before: dict[int, tuple]) -> dict[int, dict]:
    """Of each partition: its first key, the segment that it ends in, and whether it has but one key. before: what is open where it begins."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, start, one = _Open(), None, True
        for batch in batches:
            for at, key, name in _names(batch):
                if start is None:
                    start = (at, key)
                    if before.get(at):
                        now = _Open(*before[at], 0)
                now.take(key, name)
                one = one and key == start[1]
        if start is not None:
            yield pa.RecordBatch.from_pydict({"_at": pa.array([start[0]], pa.int32()), "head": pa.array([start[1]], pa.string()), "key": pa.array([now.key], pa.string()), "first": [now.first], "number": pa.array([now.number], pa.int64()), "one": [one]})

    return {r["_at"]: r.asDict() for r in rows.select("_at", "_key", "_name").mapInArrow(read, _ENDS).collect()}


def _opened(rows: DataFrame) -> dict[int, tuple]:
    """Of each partition that goes on with a segment: key, first name and number of it."""
    before: dict[int, tuple] = {}
    ends = _ends(rows, before)
    while True:
        stale, numbers, last, count = [], {}, None, 0
        for at in sorted(ends):
            own = ends[at]
            goes_on = last is not None and last["key"] == own["head"]
            want = (last["key"], last["first"]) if goes_on else None
            if want != before.get(at):
                stale.append(at)
                before[at] = want
            if goes_on:
                numbers[at] = (*want, count)
            count = own["number"] + (count if goes_on and own["one"] else 0)
            last = own
        if not stale:
            return numbers
        ends |= _ends(rows.where(F.col("_at").isin(stale)), {at: before[at] for at in stale})


def merge_segments(df: DataFrame, key: str, ts: str, name: str, value: str) -> DataFrame:
    """Consecutive rows whose name equals, holds or is held by the first one's of the segment, merged: segment (from 0 in each key), start, end, rows, modal name and value.

    Rows of a key go by ts and then name, nulls last; a null name is as an empty one, which only equals itself. The mode is the least of the
    commonest values that aren't null or NaN. Equal rows are counted first, and a key may lie in any number of partitions. Sorted rows
    are written once to spark.checkpoint.dir and read at least once when the plan is made.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    order = [F.col(key).asc_nulls_first(), F.col(ts).asc_nulls_last(), F.col(name).asc_nulls_last()]
    counted = df.groupBy(key, ts, name, value).agg(F.count("*").alias("_c"))
    sorted_ = counted.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = settled(sorted_.withColumns({"_at": F.spark_partition_id(), "_key": F.col(key).cast("string"), "_name": F.coalesce(F.col(name).cast("string"), F.lit(""))}))
    opened = _opened(rows)
    out = StructType([*rows.schema.fields, StructField("segment", LongType())])

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for batch in batches:
            numbers = []
            for at, k, n in _names(batch):
                now = now or _Open(*opened.get(at, ()))
                numbers.append(now.take(k, n))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(numbers, pa.int64())], names=[*batch.schema.names, "segment"])

    tagged = rows.mapInArrow(label, out)

    def commonest(column: str):
        there = F.col(column).isNotNull()
        if kinds[column].typeName() in ("double", "float"):
            there &= ~F.isnan(column)
        return F.min(F.when(there, F.struct((-F.col("_n")).alias("n"), F.col(column).alias("v"))))["v"]

    by_name = tagged.groupBy(key, "segment", name).agg(F.sum("_c").alias("_n"), F.min(ts).alias("_from"), F.max(ts).alias("_to"))
    one = by_name.groupBy(key, "segment").agg(F.min("_from").alias("start"), F.max("_to").alias("end"), F.sum("_n").alias("rows"), commonest(name).alias("_name"))
    by_value = tagged.groupBy(key, "segment", value).agg(F.sum("_c").alias("_n"))
    two = by_value.groupBy(F.col(key).alias("_k"), F.col("segment").alias("_s")).agg(commonest(value).alias("_value"))
    both = one.join(two, F.col(key).eqNullSafe(F.col("_k")) & (F.col("segment") == F.col("_s")))
    return both.select(key, "segment", "start", "end", "rows", F.col("_name").alias(name), F.col("_value").alias(value))
