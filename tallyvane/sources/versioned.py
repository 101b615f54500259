"""Tables of keyed rows under a versioned manifest: appends, upserts and dated snapshots that survive any death.

A table is a folder. Its rows lie in `data`, in parts by a hash of their keys; `versions` holds one small manifest for each
version, which names for every part the folder that has its rows. A write makes new folders of the parts that it touches
and then publishes the next manifest, written whole under a name that says nothing and renamed to its number without
replacing one: that rename is the commit. A writer that dies before it leaves the table as it was and the next write
works; of two writers one publishes, and the other raises Overtaken and may do it again. Readers keep the version they
began with until `vacuum` removes what newer ones no longer name.

Null keys are equal to each other, in every operation.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

Names = Sequence[str]
#: Parts of a new table. A write reads and rewrites the parts that its keys fall in, so a table of many rows wants more.
PARTS = 64
_PART = "_part"


class Overtaken(RuntimeError):
    """Another writer published the version that this one was about to; nothing has changed, and it may be done again."""


@dataclass(frozen=True)
class Manifest:
    """A version: its columns and keys, and by part the folder of its rows."""

    version: int
    keys: tuple[str, ...]
    parts: int
    schema: str
    folders: dict[str, str] = field(default_factory=dict)
    latest: str | None = None

    @property
    def struct(self) -> StructType:
        return StructType.fromJson(json.loads(self.schema))


class Table:
    """A versioned table in a folder of any file system that Spark knows. Nothing is there before the first write, which makes so many parts."""

    def __init__(self, spark: SparkSession, path: str, parts: int = PARTS):
        self.spark, self.path, self.parts = spark, path.rstrip("/"), parts

    # --- files

    def _disk(self, name: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def versions(self) -> list[int]:
        """Numbers of the versions there are. Other names are of writers that died or are still at it."""
        files, folder = self._disk("versions")
        names = [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []
        return sorted(int(n[:12]) for n in names if re.fullmatch(r"[0-9]{12}\.json", n))

    def manifest(self, version: int | None = None) -> Manifest | None:
        """The newest manifest, or that of a version; None where there is none."""
        known = self.versions()
        if version is None:
            version = known[-1] if known else None
        if version not in known:
            return None
        files, path = self._disk(f"versions/{version:012d}.json")
        source = files.open(path)
        try:
            said = json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8"))
        finally:
            source.close()
        return Manifest(**said | {"keys": tuple(said["keys"])})

    def _publish(self, manifest: Manifest) -> None:
        jvm = self.spark.sparkContext._jvm
        files, whole = self._disk(f"versions/.{uuid.uuid4().hex}")
        _, final = self._disk(f"versions/{manifest.version:012d}.json")
        out = files.create(whole, False)
        out.write(bytearray(json.dumps(vars(manifest)).encode()))
        out.close()
        plainly = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        plainly[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration()).rename(whole, final, plainly)
        except Exception as e:
            files.delete(whole, False)
            if "FileAlreadyExists" in str(e):
                raise Overtaken(f"version {manifest.version} of {self.path} was published by another writer") from e
            raise

    # --- reading

    def read(self, version: int | None = None) -> DataFrame:
        """Rows of the newest version, or of an older one that vacuum has left."""
        own = self.manifest(version)
        if own is None:
            raise ValueError(f"{self.path} has no version {version}" if version is not None else f"{self.path} has no rows yet")
        return self._rows(own, own.folders)

    def _rows(self, own: Manifest, parts: Names | dict[str, str]) -> DataFrame:
        folders = [f"{self.path}/{own.folders[p]}" for p in parts if p in own.folders]
        return self.spark.read.schema(own.struct).parquet(*folders) if folders else self.spark.createDataFrame([], own.struct)

    def latest(self) -> str | None:
        """Of a table of snapshots the newest day there is, whatever day was written last."""
        own = self.manifest()
        return own.latest if own else None

    # --- changes

    def changed_parts(self, since: int, until: int | None = None) -> list[str]:
        """Parts whose rows one version has in another folder than the other; of all others the rows are the same files."""
        old, new = self._both(since, until)
        return sorted(p for p in old.folders.keys() | new.folders.keys() if old.folders.get(p) != new.folders.get(p))

    def changes(self, since: int, until: int | None = None) -> DataFrame:
        """Rows (the keys, change, old, new) of the keys that differ between two versions: added, removed or updated; old and new are whole rows.

        Only parts that were written in between are read: a version with one changed row costs one part. For tables in which a key
        is there once, as upsert and append leave it; null keys are equal.
        """
        old, new = self._both(since, until)
        if old.schema != new.schema or old.keys != new.keys:
            raise ValueError(f"versions {since} and {new.version} of {self.path} have other columns or keys")
        parts = self.changed_parts(since, until)
        names = [f.name for f in new.struct]
        sides = [self._rows(m, parts).select(*(F.col(f"`{k}`").alias(f"_{side}_{k}") for k in new.keys), F.struct(*(F.col(f"`{c}`") for c in names)).alias(side)) for m, side in ((old, "old"), (new, "new"))]
        both = sides[0].join(sides[1], [F.col(f"`_old_{k}`").eqNullSafe(F.col(f"`_new_{k}`")) for k in new.keys], "full")
        change = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").otherwise("updated")
        return both.where(~F.col("old").eqNullSafe(F.col("new"))).select(*(F.coalesce(f"new.{k}", f"old.{k}").alias(k) for k in new.keys), change.alias("change"), "old", "new")

    def _both(self, since: int, until: int | None) -> tuple[Manifest, Manifest]:
        found = self.manifest(since), self.manifest(until)
        if None in found:
            raise ValueError(f"{self.path} has no version {since if found[0] is None else until}")
        if found[0].parts != found[1].parts:
            raise ValueError(f"versions of {self.path} have other numbers of parts")
        return found

    # --- writing

    def _written(self, rows: DataFrame, own: Manifest | None, keys: Names, parts: int, replaced: Names, latest: str | None = None) -> int:
        """Publish the next version: rows, which have _part, in place of those parts, and the others as they are."""
        number = (own.version if own else 0) + 1
        folder = f"data/{number:012d}-{uuid.uuid4().hex}"
        schema = StructType([f for f in rows.schema if f.name != _PART])
        # Large parts are split and small ones joined as the plan runs, so no part is one task's.
        rows.hint("rebalance", _PART).write.partitionBy(_PART).parquet(f"{self.path}/{folder}")
        there = self._parts_in(folder)
        kept = {p: f for p, f in (own.folders if own else {}).items() if p not in set(replaced)}
        self._publish(Manifest(number, tuple(keys), parts, schema.json(), kept | {p: f"{folder}/{_PART}={p}" for p in there}, latest or (own.latest if own else None)))
        return number

    def _parts_in(self, folder: str) -> list[str]:
        files, made = self._disk(folder)
        return [m.group(1) for s in files.listStatus(made) if (m := re.fullmatch(rf"{_PART}=(.+)", s.getPath().getName()))]

    def _merge(self, batch: DataFrame, keys: Names, replacing: bool) -> int:
        own, parts = self.manifest(), self.parts
        if own and tuple(keys) != own.keys:
            raise ValueError(f"{self.path} has the keys {own.keys}")
        if own:
            parts = own.parts
            batch = batch.select(*(F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in own.struct))
        # The batch is computed once and kept until the version is there; the parts that it touches are the folders it makes.
        staged = f"staged/{uuid.uuid4().hex}"
        batch.withColumn(_PART, part_of(keys, parts)).hint("rebalance", _PART).write.partitionBy(_PART).parquet(f"{self.path}/{staged}")
        touched = self._parts_in(staged)
        version = own.version if own else 0
        if touched or not own:
            new = self.spark.read.schema(StructType([*batch.schema, StructField(_PART, IntegerType())])).parquet(f"{self.path}/{staged}")
            here = self._rows(own, touched).withColumn(_PART, part_of(keys, parts)) if own else new.limit(0)
            kept, added = (without(here, new, keys), new) if replacing else (here, without(new, here, keys))
            version = self._written(kept.unionByName(added), own, keys, parts, touched)
        files, path = self._disk(staged)
        files.delete(path, True)
        return version

    def upsert(self, batch: DataFrame, keys: Names, order: str | None = None) -> int:
        """Put the batch's rows in place of those with their keys and add the rest; the new version's number.

        Of rows of the batch with equal keys the last in the order counts (without one, any). The table's columns stay: the
        batch is brought to their order and types, and a column that it lacks is an error. An empty batch makes no version of a table that has one.
        """
        return self._merge(one_each(batch, keys, order), keys, True)

    def append(self, batch: DataFrame, keys: Names, order: str | None = None) -> int:
        """Add the rows whose keys aren't there yet; what is there stays. Done again, it changes nothing."""
        return self._merge(one_each(batch, keys, order), keys, False)

    def remove(self, batch: DataFrame, keys: Names) -> int:
        """Remove the rows whose keys the batch has; keys that aren't there change nothing."""
        own = self.manifest()
        if own is None or tuple(keys) != own.keys:
            raise ValueError(f"{self.path} has the keys {own.keys if own else ()}")
        types = {f.name: f.dataType for f in own.struct}
        named = batch.select(*(F.col(f"`{k}`").cast(types[k]).alias(k) for k in keys)).distinct()
        staged = f"staged/{uuid.uuid4().hex}"
        named.withColumn(_PART, part_of(keys, own.parts)).write.partitionBy(_PART).parquet(f"{self.path}/{staged}")
        touched = [p for p in self._parts_in(staged) if p in own.folders]
        version = own.version
        if touched:
            gone = self.spark.read.schema(named.schema).parquet(f"{self.path}/{staged}")
            left = without(self._rows(own, touched).withColumn(_PART, part_of(keys, own.parts)), gone, keys)
            version = self._written(left, own, keys, own.parts, touched)
        files, path = self._disk(staged)
        files.delete(path, True)
        return version

    def replace(self, rows: DataFrame, keys: Names) -> int:
        """Put rows in place of all there are: other columns, types and keys than before may be had this way. Of rows with equal keys all stay."""
        own = self.manifest()
        parts = own.parts if own and own.parts else self.parts
        return self._written(rows.withColumn(_PART, part_of(keys, parts)), own, keys, parts, list(own.folders) if own else [])

    def snapshot(self, rows: DataFrame, day: str, column: str = "run_date") -> int:
        """The rows as one day's snapshot, in place of an earlier one of that day; the pointer to the latest never goes back.

        A snapshot without rows counts as that day's too: the pointer moves, and the day has no rows.
        """
        own = self.manifest()
        if not re.fullmatch(r"[0-9]{4}-[0-9]{2}-[0-9]{2}", day):
            raise ValueError("a day is written as year-month-day")
        dated = rows.withColumn(column, F.lit(day)).withColumn(_PART, F.lit(day))
        return self._written(dated, own, (column,), 0, [day], max(day, (own.latest if own else None) or day))

    def read_latest(self, column: str = "run_date") -> DataFrame:
        """Rows of the latest snapshot."""
        own = self.manifest()
        if own is None or own.latest is None:
            raise ValueError(f"{self.path} has no snapshot yet")
        return self._rows(own, [own.latest])

    def vacuum(self, keep: int = 2) -> None:
        """Remove all versions but the newest few, and the rows that no version left names. Not while a write is under way."""
        known = self.versions()
        for v in known[: -max(keep, 1)]:
            files, path = self._disk(f"versions/{v:012d}.json")
            files.delete(path, False)
        named = {f for v in known[-max(keep, 1) :] for f in self.manifest(v).folders.values()}
        files, staged = self._disk("staged")
        files.delete(staged, True)
        files, data = self._disk("data")
        for write in files.listStatus(data) if files.exists(data) else []:
            under = f"data/{write.getPath().getName()}"
            for part in files.listStatus(write.getPath()):
                if f"{under}/{part.getPath().getName()}" not in named:
                    files.delete(part.getPath(), True)
            if not any(f.startswith(f"{under}/") for f in named):
                files.delete(write.getPath(), True)


def part_of(keys: Names, parts: int) -> Column:
    """The part of a row's keys; a hash over keys and which of them are null."""
    return F.pmod(F.xxhash64(*keys, *(F.col(k).isNull() for k in keys)), F.lit(parts)).cast("int")


def one_each(batch: DataFrame, keys: Names, order: str | None) -> DataFrame:
    """One row for each set of keys: the last in the order, or any."""
    if order is None:
        return batch.dropDuplicates(list(keys))
    rest = [c for c in batch.columns if c not in keys]
    last = F.max(F.struct(F.col(order).isNotNull().alias("_known"), F.col(order).alias("_order"), F.struct(*rest).alias("_row"))).alias("_l")
    return batch.groupBy(*keys).agg(last).select(*keys, "_l._row.*").select(*batch.columns)


def without(rows: DataFrame, others: DataFrame, keys: Names) -> DataFrame:
    """Rows whose keys none of the others has; nulls are equal."""
    named = others.select(*(F.col(f"`{k}`").alias(f"_{k}") for k in keys)).distinct()
    return rows.join(named, [F.col(f"`{k}`").eqNullSafe(F.col(f"_{k}")) for k in keys], "left_anti")
