"""Filters and quality gates: predicates as columns, and operators that tag, split or flag rows.

Rows are tagged before they are dropped, so that what was rejected can be audited.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyvane.functions.text import _quoted, col, garbage, matches_any, volumes_ml
from tallyvane.functions.values import month_number
from tallyvane.operators.joins import bounded
from tallyvane.operators.lineage import settled

is_garbage_text = garbage

# Phrases that mark a bundle or a collectible in a product name; white space may part their words.
BUNDLE_PHRASES = ("전용 잔", "잔 패키지", "잔 세트", "메가 잔", "미니어처 세트", "미니어쳐 세트", "두 개입", "전용 패키지", "기프트 세트", "선물 세트", "증정")
COLLECTIBLE_PHRASES = ("vintage", "빈티지", "limited", "리미티드", "한정", "collector", "anniversary", "기념판", "컬렉터", "single cask", "싱글 캐스크", "cask no")
#: Bottles of so many millilitres are no ordinary retail size.
LARGE_ML = 2000


def _has_phrase(text: Column, phrases: Sequence[str]) -> Column:
    return matches_any(text, *(r"\s*".join(_quoted(w) for w in phrase.split(" ")) for phrase in phrases))


def _of_a_decade(text: Column) -> Column:
    """Whether a decade of the last or this century is named: a year that ends in 0, and an s after it."""
    years = F.transform(F.regexp_extract_all(text, F.lit(r"([0-9]+)\s*'?s"), 1), lambda d: F.right(d, F.lit(4)))
    return F.exists(years, lambda y: (F.length(y) == 4) & F.endswith(y, F.lit("0")) & y.between("1900", "2099"))


def apply_gates(df: DataFrame, gates: Sequence[tuple[Column, str]], ok: str = "ok", status: str = "status", reason: str = "reason") -> DataFrame:
    """df with status and reason of the first gate whose predicate is true; a null predicate passes. Every row stays."""
    why = F.lit(None).cast("string")
    for predicate, name in reversed(gates):
        why = F.when(predicate, F.lit(name)).otherwise(why)
    return df.withColumn(reason, why).withColumn(status, F.when(F.col(reason).isNull(), F.lit(ok)).otherwise("rejected"))


def split_quarantine(df: DataFrame, status: str = "status", ok: str = "ok") -> tuple[DataFrame, DataFrame]:
    """(accepted, quarantined) of a tagged table; a null status is quarantined."""
    good = F.coalesce(F.col(status) == ok, F.lit(False))
    return df.where(good), df.where(~good)


def is_sane(c: Column | str, lo: float = 15000, hi: float | None = None) -> Column:
    """Whether a price is at least lo (and at most hi); null isn't."""
    return F.coalesce((col(c) >= lo) & (F.lit(True) if hi is None else col(c) <= hi), F.lit(False))


def is_bundle(c: Column | str, phrases: Sequence[str] = BUNDLE_PHRASES) -> Column:
    """Whether the name is of a bottle sold with glasses, miniatures or gifts; null isn't."""
    return _has_phrase(F.lower(col(c)), phrases)


def is_collectible(c: Column | str, phrases: Sequence[str] = COLLECTIBLE_PHRASES, large: int = LARGE_ML) -> Column:
    """Whether the name is of no standard product: a phrase, a decade, a number after #, or a volume of `large` or more; null isn't."""
    text = F.lower(col(c))
    big = F.exists(volumes_ml(text), lambda v: v >= large)
    return F.coalesce(_has_phrase(text, phrases) | _of_a_decade(text) | text.rlike(r"#\s*[0-9]") | big, F.lit(False))


def is_undersized(volume: Column | str, text: Column | str | None = None, lt: int = 500) -> Column:
    """Whether the volume, or any volume in the text, is under lt; what is unknown passes."""
    small = F.coalesce(col(volume) < lt, F.lit(False))
    return small if text is None else small | F.coalesce(F.exists(volumes_ml(text), lambda v: v < lt), F.lit(False))


def in_volume_window(volume: Column | str, lo: int, hi: int, null_passes: bool = True) -> Column:
    return F.coalesce(col(volume).between(lo, hi), F.lit(null_passes))


def is_future(date: Column | str, as_of: str) -> Column:
    """Whether a date, given as text or date, lies after as_of; what isn't a whole date doesn't."""
    return F.coalesce(F.try_to_date(col(date).cast("string"), "yyyy-MM-dd") > F.lit(as_of).cast("date"), F.lit(False))


def resolve_collected_date(source: Column | str, run_date: str, months: int = 2) -> Column:
    """Struct (date, reason): the run's date where the source has none, the source's where it is fresh, else reason `stale`."""
    d, run = F.try_to_date(col(source).cast("string"), "yyyy-MM-dd"), F.lit(run_date).cast("date")
    stale = month_number(run) - month_number(d) >= months
    return F.struct(F.when(d.isNull(), run).otherwise(d).alias("date"), F.when(stale, F.lit("stale")).alias("reason"))


def freshness(df: DataFrame, date: str, as_of: str, days: int, flag: str = "fresh") -> DataFrame:
    """df with age_days and fresh: at most `days` old; an unknown date is not."""
    age = F.datediff(F.lit(as_of).cast("date"), F.try_to_date(F.col(date).cast("string"), "yyyy-MM-dd"))
    return df.withColumn("age_days", age).withColumn(flag, F.coalesce(F.col("age_days") <= days, F.lit(False)))


def plausible(df: DataFrame, dim: DataFrame, key: str, value: str, lo: str, hi: str, lo_frac: float = 0.35, hi_mult: float = 3.0) -> DataFrame:
    """df with price_reason: `below reference` or `above reference` of the key's reference band; without one a row passes."""
    ref = dim.select(key, F.col(lo).alias("_lo"), F.col(hi).alias("_hi"))
    out = df.join(ref, key, "left")
    why = F.when(F.col(value) < F.col("_lo") * lo_frac, "below reference").when(F.col(value) > F.col("_hi") * hi_mult, "above reference")
    return out.withColumn("price_reason", why).drop("_lo", "_hi")


def flag_outliers(df: DataFrame, key: str, value: str, history: Column, lo: float = 1 / 3, hi: float = 3.0) -> DataFrame:
    """df with outlier: the value lies outside [lo, hi] times the mean of the key's historical rows; bounds are inside. No history: not one.

    The means are computed when the plan is made and broadcast where they are few, so keys with many rows are gathered in no task.
    """
    mean = bounded(settled(df.where(history).groupBy(key).agg(F.avg(value).alias("_mean"))))
    out = df.join(mean, key, "left")
    odd = (F.col(value) < F.col("_mean") * lo) | (F.col(value) > F.col("_mean") * hi)
    return out.withColumn("outlier", F.coalesce(odd, F.lit(False))).drop("_mean")


def range_ratio_ok(lo: Column | str, hi: Column | str, current: Column | str, mean: Column | str, ratio: float = 3.0) -> Column:
    """Whether hi/lo is at most the ratio and current lies within mean/ratio..mean*ratio."""
    return (col(hi) <= col(lo) * ratio) & col(current).between(col(mean) / ratio, col(mean) * ratio)


def divergence_ok(a: Column | str, b: Column | str, ratio: float = 2.5) -> Column:
    """Whether two prices are less than `ratio` apart; a missing one passes."""
    wide = F.greatest(col(a), col(b)) >= F.greatest(F.least(col(a), col(b)), F.lit(1)) * ratio
    return F.coalesce(~(wide & col(a).isNotNull() & col(b).isNotNull()), F.lit(True))


def flag_contaminated(old: DataFrame, refs: Sequence[DataFrame], key: str, value: str, threshold: float = 0.9) -> DataFrame:
    """old with dirty and reference: dirty where the value is under threshold times the key's first reference that isn't null."""
    out = old
    for i, ref in enumerate(refs):
        out = out.join(ref.groupBy(key).agg(F.min(value).alias(f"_ref{i}")), key, "left")
    reference = F.coalesce(*(F.col(f"_ref{i}") for i in range(len(refs))))
    out = out.withColumn("reference", reference).withColumn("dirty", F.coalesce(F.col(value) < F.col("reference") * threshold, F.lit(False)))
    return out.drop(*(f"_ref{i}" for i in range(len(refs))))


def dirty_manifest(flagged: DataFrame, key: str, date: str, value: str) -> DataFrame:
    """Of every key with dirty rows: their dates in order, and date -> value."""
    cells = F.array_sort(F.collect_set(F.struct(F.col(date).cast("string").alias("d"), F.col(value).alias("v"))))
    one = flagged.where("dirty").groupBy(key, date).agg(F.min(value).alias(value))
    return one.groupBy(key).agg(cells.alias("_c")).select(key, F.transform("_c", lambda c: c["d"]).alias("dates"), F.map_from_entries("_c").alias("prices"))


def exclude_dirty(df: DataFrame, cells: DataFrame, keys: Sequence[str], files: DataFrame | None = None, file_col: str = "source_file") -> DataFrame:
    """df without the rows that a manifest of dirty cells, or of dirty files, names."""
    out = df.join(cells.select(*keys).distinct(), list(keys), "left_anti")
    return out if files is None else out.join(files.select(file_col).distinct(), file_col, "left_anti")


def exclude_listing(df: DataFrame, foreign_price: str, seller_type: str, foreign_types: Sequence[int] = (5,)) -> DataFrame:
    """df without listings from abroad: with a foreign price over 0, or a seller of those types."""
    bad = F.coalesce(F.col(foreign_price) > 0, F.lit(False)) | F.coalesce(F.col(seller_type).isin(*foreign_types), F.lit(False))
    return df.where(~bad)


def leaks(df: DataFrame, predicate: Column) -> DataFrame:
    """One row: how many rows the predicate holds for, and whether there are none."""
    return df.agg(F.count_if(predicate).alias("leaks"), F.count("*").alias("rows")).withColumn("clean", F.col("leaks") == 0)


def keep_by_prefix(df: DataFrame, c: str, allow: Sequence[str], deny: Sequence[str] = (), accessory: str | None = None, fallback: Column | None = None) -> DataFrame:
    """Rows whose text starts with an allowed prefix and no denied one, or, with neither, for which the fallback holds; never an accessory."""
    text = F.lower(F.col(c))
    starts = lambda words: matches_any(text, *(f"^{_quoted(w)}" for w in words)) if words else F.lit(False)
    keep = F.when(starts(deny), False).when(starts(allow), True).otherwise(F.lit(False) if fallback is None else fallback)
    return df.where(keep & (~matches_any(text, accessory) if accessory else F.lit(True)))


def drop_stores(df: DataFrame, c: str, stores: Sequence[str]) -> DataFrame:
    """df without the rows of some stores, white space aside."""
    plain = lambda s: "".join(s.split())
    return df.where(~F.coalesce(F.regexp_replace(F.col(c), r"\s+", "").isin(*(plain(s) for s in stores)), F.lit(False)))


def free_tag_evidence(df: DataFrame, tags: str, positive: str, text: str, paid: str, negation: str, window: int = 12) -> DataFrame:
    """df with tag (the first positive tag, marked ones before others) and paid: a paid phrase without a negation near it.

    tags is an array of (term, mark).
    """
    hits = F.filter(F.col(tags), lambda t: t["term"].rlike(positive))
    ordered = F.array_sort(F.transform(hits, lambda t, i: F.struct((-t["mark"]).alias("m"), i.alias("i"), t["term"].alias("term"))))
    cancelled = F.col(text).rlike(f"(?:{paid}).{{0,{window}}}(?:{negation})|(?:{negation}).{{0,{window}}}(?:{paid})")
    return df.withColumn("tag", F.try_element_at(ordered, F.lit(1))["term"]).withColumn("paid", F.coalesce(F.col(text).rlike(paid) & ~cancelled, F.lit(False)))


def pick_reliable(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the order."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("_n = 1").drop("_n")
