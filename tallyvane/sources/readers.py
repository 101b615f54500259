"""Readers and extractors: loose CSV, adapters, snapshot discovery, and rows out of JSON, HTML, captions and Markdown."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence

import pandas as pd

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

BOM = "﻿"


def read_csv_loose(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None, comment: str | None = None, header: Sequence[str] | None = None) -> DataFrame:
    """All-string CSV with a header that may start with a byte-order mark, or with the names given; a path that isn't there gives an empty table of the columns."""
    reader = spark.read.option("header", header is None).option("inferSchema", False).option("encoding", "UTF-8").option("multiLine", False)
    if comment:
        reader = reader.option("comment", comment)
    try:
        df = reader.csv(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        df = spark.createDataFrame([], StructType([]).add("_", StringType())).drop("_")
    df = df.toDF(*(header if header and df.columns else (c.lstrip(BOM).strip() for c in df.columns)))
    if columns is None:
        return df
    return df.select(*((F.col(f"`{c}`") if c in df.columns else F.lit(None).cast("string")).alias(c) for c in columns))


def union_sources(sources: Sequence[tuple[str, DataFrame, Callable[[DataFrame], DataFrame], str]]) -> DataFrame:
    """Tables of several families through their adapters, as one with columns family and month besides."""
    out = None
    for family, df, adapter, month in sources:
        part = adapter(df).withColumn("family", F.lit(family)).withColumn("month", F.lit(month))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def map_columns(df: DataFrame, aliases: Mapping[str, Sequence[str]]) -> DataFrame:
    """Standard columns from the first header that holds one of their aliases; null where none does."""
    def find(names: Sequence[str]) -> str | None:
        return next((c for a in names for c in df.columns if a.lower() in c.lower()), None)

    found = {std: find(names) for std, names in aliases.items()}
    return df.select(*((F.col(f"`{c}`") if c else F.lit(None).cast("string")).alias(std) for std, c in found.items()))


def migrate_positional(lines: DataFrame, old: Sequence[str], new: Sequence[str], c: str = "value") -> DataFrame:
    """CSV lines without a header, of the old or the new number of columns, as the new schema; quoted commas part nothing."""

    def parsed(names: Sequence[str]) -> Column:
        fields = ", ".join(f"c{i} string" for i in range(len(names)))
        return F.from_csv(F.col(c), F.lit(f"{fields}, bad string"), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "bad"})

    rows = lines.select(parsed(old).alias("_old"), parsed(new).alias("_new"))
    at = {name: i for i, name in enumerate(old)}
    before = lambda name: F.col(f"_old.c{at[name]}") if name in at else F.lit(None).cast("string")
    return rows.select(*(F.when(F.col("_old.bad").isNull(), before(name)).otherwise(F.col(f"_new.c{i}")).alias(name) for i, name in enumerate(new)))


def snapshots(df: DataFrame, date: str = "snapshot_date") -> DataFrame:
    """The dates there are snapshots of, in order, with their rows."""
    return df.groupBy(date).agg(F.count("*").alias("rows")).orderBy(date)


def latest_snapshot(df: DataFrame, date: str = "snapshot_date", as_of: str | None = None, strict: bool = False) -> DataFrame:
    """Rows of the newest snapshot, or of the newest at (strict: before) as_of. The date is found first, so partitions are pruned."""
    days = df.select(date)
    if as_of is not None:
        limit = F.lit(as_of).cast(df.schema[date].dataType)
        days = days.where(F.col(date) < limit if strict else F.col(date) <= limit)
    newest = days.agg(F.max(date).alias("d")).first()["d"]
    return df.where(F.col(date) == F.lit(newest)) if newest is not None else df.limit(0)


def slot_snapshots(df: DataFrame, date: str, slot: str) -> DataFrame:
    """(date, slot) of snapshots: a day with am or pm ones doesn't count its whole-day copy (null slot)."""
    days = df.select(date, slot).distinct()
    halves = days.where(F.col(slot).isNotNull())
    return days.where(F.col(slot).isNull()).join(halves.select(date).distinct(), date, "left_anti").unionByName(halves).orderBy(date, F.col(slot).asc_nulls_first())


def pick_baseline(df: DataFrame, date: str, min_ratio: float = 0.9, min_rows: int = 0) -> DataFrame:
    """One row (latest, baseline): the newest earlier snapshot with at least the ratio of the latest's rows, else the one just before."""
    n = df.groupBy(date).agg(F.count("*").alias("n"))
    last = n.agg(F.max(F.struct(date, "n")).alias("l")).select(F.col(f"l.{date}").alias("latest"), F.col("l.n").alias("_n"))
    before = n.crossJoin(F.broadcast(last)).where(F.col(date) < F.col("latest"))
    whole = F.max(F.when((F.col("n") >= F.col("_n") * min_ratio) & (F.col("n") >= min_rows), F.col(date)))
    picked = before.groupBy("latest").agg(F.coalesce(whole, F.max(date)).alias("baseline"))
    return last.select("latest").join(F.broadcast(picked), "latest", "left")


def pick_month(df: DataFrame, month: str, current: str) -> DataFrame:
    """Rows of the current month, or of the newest there is."""
    chosen = df.agg(F.max_by(month, F.when(F.col(month) == current, "9999").otherwise(F.col(month))).alias("m")).first()["m"]
    return df.where(F.col(month) == chosen) if chosen is not None else df.limit(0)


def _walk(text: str | None, keys: frozenset[str]) -> list[str]:
    """The objects anywhere in a JSON text that have all the keys, in document order, as JSON; none of a text that isn't JSON or is nested too deep to be read."""
    try:
        stack, found = [json.loads(text)] if text else [], []
        while stack:
            node = stack.pop()
            if isinstance(node, dict):
                if keys <= node.keys():
                    found.append(json.dumps({k: node[k] for k in keys}))
                stack += reversed(node.values())
            elif isinstance(node, list):
                stack += reversed(node)
    except (ValueError, RecursionError):
        return []
    return found


def extract_json_objects(df: DataFrame, c: str, fields: Mapping[str, str], ident: str, keep: Sequence[str] = ()) -> DataFrame:
    """Objects at any depth of a JSON text that have all the fields, typed; the last of an id in a row wins.

    Nesting is irregular, so an Arrow-batched function walks each document and hands on the wanted fields; the types are Spark's.
    """
    keys = frozenset(fields)
    walked = F.pandas_udf(lambda texts: pd.Series([_walk(t, keys) for t in texts], dtype=object), ArrayType(StringType()))
    rows = df.withColumn("_row", F.monotonically_increasing_id()).select("_row", *keep, F.posexplode(walked(F.col(c))).alias("_at", "_json"))
    schema = ", ".join(f"`{k}` {t}" for k, t in fields.items())
    rows = rows.withColumn("_o", F.from_json("_json", schema)).where(F.col(f"_o.`{ident}`").isNotNull()).select("_row", *keep, "_at", "_o.*")
    last = Window.partitionBy("_row", ident).orderBy(F.col("_at").desc())
    return rows.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n", "_at", "_row")


def pick_variant(df: DataFrame, key: str, variants: str, lo: int = 650, hi: int = 800) -> DataFrame:
    """Per product the variant (grams, price, …) with grams in the window, cheapest first; without one, the cheapest of all."""
    v = F.filter(F.col(variants), lambda x: x["price"].isNotNull())
    ranked = F.transform(v, lambda x: F.struct(F.when(x["grams"].between(lo, hi), 0).otherwise(1).alias("o"), x["price"].alias("price"), x["grams"].alias("grams")))
    return df.select(key, F.array_min(ranked).alias("v")).where("v is not null").select(key, F.col("v.price").alias("price"), F.col("v.grams").alias("grams"))


def extract_html_cards(df: DataFrame, c: str, separator: str, fields: Mapping[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """One row per card of an HTML text: what lies after each separator, and each field's first match in it (null without)."""
    cards = df.select(*keep, F.posexplode(F.split(F.col(c), separator)).alias("card", "_html")).where("card > 0")
    return cards.select(*keep, "card", *(F.nullif(F.regexp_extract("_html", p, 1), F.lit("")).alias(name) for name, p in fields.items()))


def with_discount(df: DataFrame, sale: str, listed: str) -> DataFrame:
    """df with both prices as numbers, a missing list price as the sale price, and discount_pct, rounded to whole percent."""
    from tallyvane.functions.text import to_num

    out = df.withColumn(sale, to_num(sale)).withColumn(listed, F.coalesce(to_num(listed), F.col(sale)))
    return out.withColumn("discount_pct", F.round((1 - F.col(sale) / F.col(listed)) * 100).cast("int"))


def strip_tags(c: Column | str) -> Column:
    """Text of an HTML string without scripts, styles and tags."""
    col = F.col(c) if isinstance(c, str) else c
    plain = F.regexp_replace(F.regexp_replace(col, r"(?is)<(script|style)[^>]*>.*?</\1>", " "), r"<[^>]*>", " ")
    return F.trim(F.regexp_replace(plain, r"\s+", " "))


def extract_first(c: Column | str, patterns: Sequence[str], lo: float | None = None, hi: float | None = None) -> Column:
    """The first group of the first pattern that matches, tried in order, as a number within lo..hi; null when it isn't."""
    col = F.col(c) if isinstance(c, str) else c
    first = F.coalesce(*(F.nullif(F.regexp_extract(col, p, 1), F.lit("")) for p in patterns))
    n = F.regexp_replace(first, ",", "").try_cast("double")
    ok = F.lit(True)
    if lo is not None:
        ok = ok & (n >= lo)
    if hi is not None:
        ok = ok & (n <= hi)
    return F.when(ok, n)


def extract_pairs(df: DataFrame, c: str, pattern: str, keep: Sequence[str] = ()) -> DataFrame:
    """Rows (name, price) of all matches of a two-group pattern."""
    found = df.select(*keep, F.regexp_extract_all(F.col(c), F.lit(pattern), 1).alias("name"), F.regexp_extract_all(F.col(c), F.lit(pattern), 2).alias("price"))
    return found.select(*keep, F.posexplode(F.arrays_zip("name", "price")).alias("at", "p")).select(*keep, "at", "p.name", "p.price")


def parse_md_tables(df: DataFrame, c: str, keep: Sequence[str] = ()) -> DataFrame:
    """Rows (heading, line, cells) of the Markdown tables in a text; rules under headers aren't rows."""
    lines = df.withColumn("_row", F.monotonically_increasing_id()).select("_row", *keep, F.posexplode(F.split(F.col(c), r"\r?\n")).alias("line", "_t"))
    order = Window.partitionBy("_row").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    heading = F.last(F.when(F.col("_t").rlike(r"^#+\s"), F.trim(F.regexp_replace("_t", r"^#+\s*", ""))), ignorenulls=True).over(order)
    rows = lines.withColumn("heading", heading).where(F.col("_t").rlike(r"^\s*\|.*\|\s*$") & ~F.col("_t").rlike(r"^\s*\|[\s:|-]+\|\s*$"))
    cells = F.transform(F.split(F.regexp_replace("_t", r"^\s*\||\|\s*$", ""), r"\|"), lambda x: F.trim(x))
    return rows.select(*keep, "heading", "line", cells.alias("cells"))


def summary_numbers(c: Column | str, patterns: Mapping[str, str]) -> list[Column]:
    """Whole numbers of a report's summary lines: of each name the first group of its pattern's first match, null without one."""
    col = F.col(c) if isinstance(c, str) else c
    return [F.regexp_replace(F.regexp_extract(col, p, 1), "[^0-9-]", "").try_cast("bigint").alias(n) for n, p in patterns.items()]


def read_captions(df: DataFrame, c: str, keep: Sequence[str] = ()) -> DataFrame:
    """Rows (ms, text) of caption JSON; events without text aren't rows."""
    schema = "events array<struct<tStartMs:bigint,segs:array<struct<utf8:string>>>>"
    events = df.select(*keep, F.explode(F.from_json(F.col(c), schema)["events"]).alias("e"))
    text = F.trim(F.regexp_replace(F.array_join(F.transform(F.coalesce("e.segs", F.array().cast("array<struct<utf8:string>>")), lambda s: F.coalesce(s["utf8"], F.lit(""))), ""), r"\s+", " "))
    return events.select(*keep, F.col("e.tStartMs").alias("ms"), text.alias("text")).where("text <> ''")
