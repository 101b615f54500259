"""Ingest under gates with a quarantine that is looked at again: rows, what is accepted and what isn't live in versioned tables.

A row is gated, its name matched, its price held against the product's band. What fails is quarantined with the reason.
Under better names, bands or gates `reprocess` looks at the quarantine again: what passes now takes its place and date
from accepted rows of the same source (never from elsewhere), is appended once, and leaves the quarantine.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyvane.operators.gates import apply_gates, plausible
from tallyvane.operators.lineage import settled
from tallyvane.sources.versioned import Table, one_each

Names = Sequence[str]


@dataclass(frozen=True)
class Rules:
    """What decides about a row: gates on its columns, names (raw, id) and the products' bands (id, lo, hi)."""

    gates: Sequence[tuple[Column, str]]
    names: DataFrame
    bands: DataFrame


def judged(rows: DataFrame, rules: Rules, raw: str, price: str) -> DataFrame:
    """rows with id and reason: the first gate that rejects, `unmatched`, or where the price lies outside the band; null for what passes."""
    known = rules.names.where(F.col("id").isNotNull() & F.col(raw).isNotNull()).groupBy(raw).agg(F.min("id").alias("id"))
    met = apply_gates(rows, rules.gates).drop("status").withColumnRenamed("reason", "_gate").join(known, raw, "left")
    banded = plausible(met, rules.bands, "id", price, "lo", "hi")
    reason = F.coalesce("_gate", F.when(F.col("id").isNull(), "unmatched"), "price_reason")
    return banded.withColumn("reason", reason).drop("_gate", "price_reason")


def ingest(rows: DataFrame, rules: Rules, accepted: Table, quarantined: Table, raw: str, price: str, keys: Names, row_keys: Names) -> None:
    """Append what passes to accepted, by its keys, and the rest with its reason to the quarantine, by the raw rows' keys. Done again, it changes nothing."""
    seen = settled(judged(rows, rules, raw, price))
    accepted.append(seen.where("reason is null").drop("reason"), keys)
    quarantined.append(seen.where("reason is not null").drop("id"), row_keys)


def backfill(accepted: Table, values: DataFrame, source: str, column: str, keys: Names) -> int:
    """Fill a column that is null from values (source, column), then let rows that have become equal in their keys be one; how many went."""
    told = values.groupBy(source).agg(F.min(column).alias("_told"))
    rows = accepted.read()
    filled = rows.join(told, source, "left").withColumn(column, F.coalesce(column, "_told")).select(rows.columns)
    before = rows.count()
    accepted.replace(one_each(filled, keys, None), keys)
    return before - accepted.read().count()


def reprocess(accepted: Table, quarantined: Table, rules: Rules, raw: str, price: str, source: str, inherited: Names, keys: Names, row_keys: Names) -> dict[str, int]:
    """Judge the quarantine again; rows recovered, rows that stay, and those of them that only lack an accepted row of their source.

    The recovered are appended before they leave the quarantine: a run that dies between the two is done again without harm.
    """
    own = accepted.read()
    meta = own.where(F.col(source).isNotNull()).groupBy(source).agg(F.min(F.struct(*inherited)).alias("_meta"))
    again = judged(quarantined.read().drop("reason"), rules, raw, price).drop(*inherited).join(meta, source, "left")
    again = settled(again)
    found = again.where(F.col("reason").isNull() & F.col("_meta").isNotNull())
    full = found.select("*", "_meta.*")
    counts = again.agg(F.count("*").alias("n"), F.count_if(F.col("reason").isNull() & F.col("_meta").isNotNull()).alias("ok"), F.count_if(F.col("reason").isNull() & F.col("_meta").isNull()).alias("alone")).first()
    if counts["ok"]:
        missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in own.schema if f.name not in full.columns]
        accepted.append(full.select("*", *missing), keys)
        quarantined.remove(found, row_keys)
    return {"recovered": counts["ok"], "remaining": counts["n"] - counts["ok"], "without_source": counts["alone"]}
