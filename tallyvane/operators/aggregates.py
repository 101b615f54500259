"""Aggregations over observations (item, source, date, price) and snapshots (key, value)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyvane.operators import ranking

Names = Sequence[str]


def _w(*keys: str) -> Window:
    return Window.partitionBy(*keys)


def latest_per_source(obs: DataFrame, item: str, source: str, date: str, price: str) -> DataFrame:
    """Per item and source: the lowest price of its latest day, that day, and the lowest of the day before it (prev).

    Rows without a price are left out; an empty date is the oldest.
    """
    day = obs.where(F.col(price).isNotNull()).groupBy(item, source, date).agg(F.min(price).alias(price))
    order = _w(item, source).orderBy(F.col(date).asc_nulls_first())
    last = _w(item, source).orderBy(F.col(date).desc_nulls_last())
    return day.withColumn("prev", F.lag(price).over(order)).withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n")


def source_latest_floor(obs: DataFrame, item: str = "item", source: str = "source", date: str = "d", price: str = "price") -> DataFrame:
    """The floor of each item: the least of its sources' latest prices, with that source, its day and its price before.

    An old low of a source is superseded by its own later price, so this is not the minimum over time. Of equal prices
    the lesser source name counts.
    """
    best = F.min_by(F.struct(price, source, date, "prev"), F.struct(price, source)).alias("b")
    return latest_per_source(obs, item, source, date, price).groupBy(item).agg(best).select(item, F.col(f"b.{price}").alias("floor"), F.col(f"b.{source}").alias("floor_source"), F.col(f"b.{date}").alias("floor_date"), F.col("b.prev").alias("prev"))


def item_latest(obs: DataFrame, gate: Column, item: str = "item", date: str = "d") -> DataFrame:
    """All rows of an item at its latest date among the gated ones."""
    own = obs.where(gate)
    return own.withColumn("_last", F.max(date).over(_w(item))).where(F.col(date) == F.col("_last")).drop("_last")


def item_report(obs: DataFrame, item: str = "item", date: str = "d", price: str = "price", seller: str = "source", ratio: float = 3.0) -> DataFrame:
    """Per item: current low and its seller, mean, low and high of the rows before the latest day, position score and flags.

    Where nothing precedes the latest day, that day is the history too and the item is flat. ok says that the history's
    range and the current price stay within the ratio.
    """
    last = obs.where(F.col(price).isNotNull()).withColumn("_last", F.max(date).over(_w(item)))
    now = F.col(date) == F.col("_last")
    agg = last.groupBy(item).agg(
        F.max("_last").alias("as_of"),
        F.min(F.when(now, F.col(price))).alias("current"),
        F.min(F.when(now, F.struct(price, seller)))[seller].alias("seller"),
        F.count_if(~now).alias("past"),
        F.avg(F.when(~now, F.col(price))).alias("_mean"),
        F.min(F.when(~now, F.col(price))).alias("_lo"),
        F.max(F.when(~now, F.col(price))).alias("_hi"),
    )
    mean, lo, hi = (F.coalesce(c, "current") for c in ("_mean", "_lo", "_hi"))
    low, high = F.least(lo, "current"), F.greatest(hi, "current")
    flat = high == low
    return agg.select(
        item,
        "as_of",
        "current",
        "seller",
        "past",
        F.round(mean, 2).alias("mean"),
        lo.alias("lo"),
        hi.alias("hi"),
        F.when(flat, 0).otherwise(F.round((high - F.col("current")) / (high - low) * 100)).cast("int").alias("score"),
        flat.alias("flat"),
        F.round(F.col("current") - mean, 2).alias("diff"),
        ((hi <= lo * ratio) & (F.col("current") * ratio >= mean) & (F.col("current") <= mean * ratio)).alias("ok"),
    )


def min_floor(obs: DataFrame, item: str = "item", date: str = "d", price: str = "price", carry: Names = ("source",)) -> DataFrame:
    """The lowest price of each item ever, with its latest day and, of that day's, the least carried columns."""
    own = obs.where(F.col(price).isNotNull())
    best = F.min(F.struct(F.col(price), (-F.unix_date(F.col(date).cast("date"))).alias("_back"), *carry)).alias("b")
    return own.groupBy(item).agg(best).select(item, F.col(f"b.{price}").alias("floor"), F.date_from_unix_date(-F.col("b._back")).alias("floor_date"), *(F.col(f"b.{c}").alias(c) for c in carry))


def with_fallback(floor: DataFrame, dim: DataFrame, item: str, reference: str, value: str = "floor") -> DataFrame:
    """floor, and for items of dim that have none their reference price, marked estimated."""
    rest = dim.join(floor.select(item), item, "left_anti").where(F.col(reference).isNotNull())
    return floor.select(item, value, F.lit(False).alias("estimated")).unionByName(rest.select(item, F.col(reference).alias(value), F.lit(True).alias("estimated")))


def partitioned_floor(obs: DataFrame, online: Column, item: str = "item", source: str = "source", date: str = "d", price: str = "price") -> DataFrame:
    """Floors of physical and of online sources side by side, and which of the two is cheaper."""
    last = latest_per_source(obs, item, source, date, price).withColumn("_online", online)
    side = lambda flag: F.min(F.when(F.col("_online") == flag, F.struct(price, source)))
    both = last.groupBy(item).agg(side(False).alias("p"), side(True).alias("o"))
    return both.select(
        item,
        F.col(f"p.{price}").alias("physical"),
        F.col(f"p.{source}").alias("physical_source"),
        F.col(f"o.{price}").alias("online"),
        F.col(f"o.{source}").alias("online_source"),
        F.least(f"p.{price}", f"o.{price}").alias("floor"),
        F.coalesce(F.col(f"o.{price}") < F.col(f"p.{price}"), F.col(f"p.{price}").isNull()).alias("online_cheaper"),
    )


def cheapest_listing(listings: DataFrame, item: str, date: str, price: str, carry: Names, least: float = 0) -> DataFrame:
    """Per item the cheapest listing of the newest date of all, with the carried columns (seller, region); prices under `least` don't count."""
    newest = listings.agg(F.max(date).alias("_last"))
    now = listings.join(F.broadcast(newest), F.col(date) == F.col("_last")).where(F.col(price) >= least)
    return now.groupBy(item).agg(F.min(F.struct(price, *carry)).alias("b")).select(item, "b.*")


def cheaper_view(a: str, b: str) -> Column:
    """Struct (price, view) of the cheaper of two views of a price, named by its column; a missing one loses, of equals the first counts."""
    return F.when(F.col(a).isNull() & F.col(b).isNull(), None).when(F.col(b).isNull() | (F.col(a) <= F.col(b)), F.struct(F.col(a).alias("price"), F.lit(a).alias("view"))).otherwise(F.struct(F.col(b).alias("price"), F.lit(b).alias("view")))


def snapshot_diff(prev: DataFrame, cur: DataFrame, key: str, value: str, min_abs: float = 1000, min_pct: float = 1.0) -> DataFrame:
    """Rows that differ between two snapshots: new, removed, rise or drop, with both values, the difference and percent.

    A move under min_abs and under min_pct at once is ignored, and so is one with a value missing on either side.
    """
    a, b = prev.select(key, F.col(value).alias("old")), cur.select(key, F.col(value).alias("new"))
    both = a.withColumn("_p", F.lit(True)).join(b.withColumn("_c", F.lit(True)), key, "full")
    delta = F.col("new") - F.col("old")
    pct = F.round(delta * 100.0 / F.when(F.col("old") != 0, F.col("old")), 4)
    tiny = (F.abs(delta) < min_abs) & (F.abs(pct) < min_pct)
    kind = F.when(F.col("_p").isNull(), "new").when(F.col("_c").isNull(), "removed").when(tiny | (delta == 0) | delta.isNull(), None).when(delta < 0, "drop").otherwise("rise")
    return both.withColumn("kind", kind).where("kind is not null").select(key, "kind", "old", "new", delta.alias("delta"), pct.alias("pct"))


def two_measure_diff(prev: DataFrame, cur: DataFrame, key: str, value: str, second: str, eps: float = 0.01) -> DataFrame:
    """Common keys whose value (kind `value`) or, failing that, whose second measure (kind `second`) moved by eps or more."""
    a = prev.select(key, F.col(value).alias("old"), F.col(second).alias("old_second"))
    b = cur.select(key, F.col(value).alias("new"), F.col(second).alias("new_second"))
    both = a.join(b, key)
    kind = F.when(F.abs(F.col("new") - F.col("old")) >= eps, "value").when(F.abs(F.col("new_second") - F.col("old_second")) >= eps, "second")
    return both.withColumn("kind", kind).where("kind is not null")


def membership_moves(prev: DataFrame, cur: DataFrame, key: str, value: str, pct: float = 15.0) -> DataFrame:
    """new and lost keys, and common ones whose value moved by more than pct percent."""
    return snapshot_diff(prev, cur, key, value, 0, 0).where(F.col("kind").isin("new", "removed") | (F.abs("pct") > pct))


def diff_guard(prev: DataFrame, required: Names) -> DataFrame:
    """One row: which required columns a snapshot has no value in, and whether it can be compared."""
    have = [c for c in required if c in prev.columns]
    counts = prev.agg(*(F.count(c).alias(c) for c in have)) if have else prev.limit(1).select(F.lit(0).alias("_"))
    empty = F.array_compact(F.array(*(F.lit(c) if c not in have else F.when(F.col(c) == 0, F.lit(c)) for c in required)))
    return counts.select(F.array_join(empty, ",").alias("missing")).withColumn("comparable", F.col("missing") == "")


def gate_stats(df: DataFrame, family: str, outcome: str, outcomes: Names) -> DataFrame:
    """Counts of each outcome by family, with a total row (family `total`) and column."""
    agg = df.rollup(family).agg(*(F.count_if(F.col(outcome) == o).alias(o) for o in outcomes), F.count("*").alias("total"), F.grouping(family).alias("_g"))
    return agg.withColumn(family, F.when(F.col("_g") == 1, "total").otherwise(F.coalesce(family, F.lit("unknown")))).drop("_g")


def master_summary(df: DataFrame, item: str, name: str, market: str, price: str, first: int = 4) -> DataFrame:
    """Per item: distinct names, rows, its markets joined, price range and its first names in order. Markets are few; names may be any number."""
    agg = df.groupBy(item).agg(
        F.count("*").alias("rows"),
        F.array_join(F.array_sort(F.collect_set(market)), "/").alias("markets"),
        F.min(price).alias("min_price"),
        F.max(price).alias("max_price"),
    )
    one = df.where(F.col(name).isNotNull()).select(item, name).distinct().withColumn("_k", F.row_number().over(_w(item).orderBy(name)))
    names = one.groupBy(item).agg(F.count("*").alias("aliases"), F.array_join(F.array_sort(F.collect_list(F.when(F.col("_k") <= first, F.col(name)))), "; ").alias("names"))
    return agg.join(names, item, "left").select(item, F.coalesce("aliases", F.lit(0)).alias("aliases"), "rows", "markets", "min_price", "max_price", F.coalesce("names", F.lit("")).alias("names"))


def alias_audit(df: DataFrame, item: str, name: str, least: int = 3, most: int = 20) -> DataFrame:
    """Items with at least so many spellings: how many, and the first `most` of them in order."""
    one = df.where(F.col(name).isNotNull()).select(item, name).distinct()
    n = one.groupBy(item).agg(F.count("*").alias("spellings")).where(F.col("spellings") >= least)
    first = one.withColumn("_k", F.row_number().over(_w(item).orderBy(name))).where(F.col("_k") <= most)
    return n.join(first.groupBy(item).agg(F.array_join(F.array_sort(F.collect_list(name)), "; ").alias("names")), item)


def unmatched_names(df: DataFrame, name: str, ident: str) -> DataFrame:
    """Names without an id and the rows each has."""
    return df.where(F.col(ident).isNull()).groupBy(name).agg(F.count("*").alias("rows"))


def match_rate(df: DataFrame, name: str, ident: str, curated: DataFrame | None = None) -> DataFrame:
    """One row: distinct names, matched ones and their share; and the share there would be with the curated names (column name) matched too."""
    one = df.groupBy(name).agg(F.max(F.col(ident).isNotNull()).alias("_m"))
    more = one.join(curated.select(name, F.lit(True).alias("_c")).distinct(), name, "left") if curated is not None else one.withColumn("_c", F.lit(None).cast("boolean"))
    out = more.agg(F.count("*").alias("names"), F.count_if("_m").alias("matched"), F.count_if(F.col("_m") | F.coalesce("_c", F.lit(False))).alias("_then"))
    share = lambda c: F.round(F.col(c) / F.when(F.col("names") != 0, F.col("names")), 4)
    return out.select("names", "matched", share("matched").alias("rate"), share("_then").alias("projected"))


def mode_by(df: DataFrame, key: str | Names, value: str, tie: Column | None = None) -> DataFrame:
    """The most frequent value of each key; of equals the one with the greatest tie (its length), then the least."""
    keys = [key] if isinstance(key, str) else list(key)
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n"))
    order = F.struct((-F.col("n")).alias("a"), (-(F.length(F.col(value).cast("string")) if tie is None else tie)).alias("b"), F.col(value).alias("v"))
    return counts.groupBy(*keys).agg(F.min(order).alias("o")).select(*keys, F.col("o.v").alias(value), (-F.col("o.a")).alias("n"))


def quartiles(df: DataFrame, key: str, value: str, large: bool = False) -> DataFrame:
    """Linear-interpolated 25, 50 and 75 percent points. large: of few keys with any number of values each, by counts of values."""
    if large:
        return ranking.percentiles(df, [key], value, {"p25": 0.25, "median": 0.5, "p75": 0.75})
    return df.groupBy(key).agg(*(F.percentile(value, p).alias(n) for n, p in (("p25", 0.25), ("median", 0.5), ("p75", 0.75))))


def index_percentile(df: DataFrame, key: str, value: str, share: float) -> DataFrame:
    """sorted[int(n * share)] of each key, by running counts of its values: no task holds or sorts a key's rows."""
    place = F.least(F.floor(F.col("total") * share), F.col("total") - 1)
    at = ranking.running_counts(df, [key], value).where((F.col("before") <= place) & (place < F.col("before") + F.col("n")))
    return at.select(key, F.col(value).alias("value"), F.col("total").alias("n"))


def estimate_per_person(
    menu: DataFrame, place: str, price: str, appetite: Mapping[str, float] | None = None, min_items: int = 4, fallback: float | None = None, main: Column | None = None, party: str | None = None
) -> DataFrame:
    """Low, standard and high cost a person of each place from its dishes' prices a person.

    Only main dishes count, unless a place has none of them. Where dishes name a number of people (party over 1), those
    alone count, each price divided by it, with their least, mean and greatest. Else from min_items dishes on the quartiles,
    with fewer the least, mean and greatest, without any the fallback; confidence says which.
    """
    if main is not None:
        menu = menu.withColumn("_main", F.coalesce(main, F.lit(False)))
        some = menu.groupBy(place).agg(F.max("_main").alias("_some"))
        menu = menu.join(some, place).withColumn(price, F.when(F.col("_main") | ~F.col("_some"), F.col(price)))
    if party is not None:
        own = F.when(F.col(party) > 1, F.col(price) / F.col(party))
        parties = menu.withColumn("_own", own).groupBy(place).agg(F.count("_own").alias("n"), F.min("_own").alias("_lo"), F.avg("_own").alias("_mid"), F.max("_own").alias("_hi")).where("n > 0")
        rest = estimate_per_person(menu.join(parties.select(place), place, "left_anti"), place, price, appetite, min_items, fallback)
        confidence = F.when(F.col("n") >= 3, "party").otherwise("few parties")
        return rest.unionByName(parties.select(place, "n", *(F.round(c, 4).alias(a) for c, a in (("_lo", "low"), ("_mid", "std"), ("_hi", "high"))), confidence.alias("confidence")))
    factor = {"low": 1.0, "std": 1.0, "high": 1.0} | dict(appetite or {})
    agg = menu.groupBy(place).agg(
        F.count(price).alias("n"),
        *(F.percentile(price, p).alias(f"_q{i}") for i, p in enumerate((0.25, 0.5, 0.75))),
        F.min(price).alias("_m0"),
        F.avg(price).alias("_m1"),
        F.max(price).alias("_m2"),
    )
    pick = lambda i, k: F.round(F.coalesce(F.when(F.col("n") >= min_items, F.col(f"_q{i}")).otherwise(F.col(f"_m{i}")), F.lit(fallback).cast("double")) * factor[k], 4)
    confidence = F.when(F.col("n") >= min_items, "high").when(F.col("n") > 0, "low").otherwise("none")
    return agg.select(place, "n", pick(0, "low").alias("low"), pick(1, "std").alias("std"), pick(2, "high").alias("high"), confidence.alias("confidence"))


def weighted_score(counts: DataFrame, key: str, category: str, n: str, weights: Mapping[str, float]) -> DataFrame:
    """Weighted sum of category counts by key, as a share of 100 of the greatest, and the rank."""
    weight = F.coalesce(*(F.when(F.col(category) == k, F.lit(float(w))) for k, w in weights.items()), F.lit(0.0))
    score = counts.groupBy(key).agg(F.sum(F.col(n) * weight).alias("score"))
    top = score.agg(F.max("score").alias("_top"))
    out = score.crossJoin(F.broadcast(top)).withColumn("score_norm", F.round(F.col("score") * 100 / F.coalesce(F.nullif("_top", F.lit(0.0)), F.lit(1.0)), 2)).drop("_top")
    return ranking.with_rank(out, "score", "rank")


def weekly_rollup(diffs: DataFrame, key: str, date: str, prev_date: str, delta: str, value: str, floor: str | None = None, least: float = 1.0) -> DataFrame:
    """Per ISO week and key: the sum of the deltas of one-day steps, their number and the last value.

    With floor, a column, also whether the value came under it in the week (breakthrough), and the list the key is on:
    `deepen` from a sum of -least down, `raise` from least up.
    """
    own = diffs.where(F.datediff(date, prev_date) == 1).withColumn("week", F.date_trunc("week", date).cast("date"))
    through = [F.max(F.coalesce(F.col(value) < F.col(floor), F.lit(False))).alias("breakthrough")] if floor else []
    out = own.groupBy("week", key).agg(F.sum(delta).alias("delta"), F.count("*").alias("steps"), F.max_by(value, date).alias("last"), *through)
    return out.withColumn("list", F.when(F.col("delta") <= -least, "deepen").when(F.col("delta") >= least, "raise")) if floor else out


def hot_deals(deals: DataFrame, key: str, date: str, save: str, floor: str, n: int = 20) -> DataFrame:
    """The n best of a week's deals, one a key: its newest day's; by share of the floor saved, then amount saved, then key."""
    newest = deals.groupBy(key).agg(F.max(F.struct(F.col(date), F.col(save), F.col(floor))).alias("_d")).select(key, "_d.*")
    share = F.when((F.col(save) != 0) & (F.col(floor) != 0), F.round(F.col(save) / F.col(floor), 6)).otherwise(0.0)
    order = [F.desc("share"), F.desc_nulls_last(save), F.col(key)]
    top = newest.withColumn("share", F.coalesce(share, F.lit(0.0))).orderBy(*order).limit(n)  # the window sees these n
    return top.withColumn("place", F.row_number().over(Window.orderBy(*order)))


def funnel(df: DataFrame, stages: Sequence[tuple[str, Column]]) -> DataFrame:
    """One row per stage: rows for which its predicate and all before it hold."""
    held, exprs = F.lit(True), []
    for name, predicate in stages:
        held = held & F.coalesce(predicate, F.lit(False))
        exprs.append(F.count_if(held).alias(name))
    one = df.agg(*exprs)
    return one.select(F.posexplode(F.array(*(F.struct(F.lit(n).alias("stage"), F.col(n).alias("n")) for n, _ in stages))).alias("step", "s")).select("step", "s.stage", "s.n")


def scoreboard(wins: DataFrame, day: str, shop: str) -> DataFrame:
    """Wins by day and shop, the day's champion (most wins, then name) and whether it differs from the day before."""
    n = wins.groupBy(day, shop).agg(F.count("*").alias("wins"))
    champ = n.groupBy(day).agg(F.min(F.struct((-F.col("wins")).alias("w"), F.col(shop).alias("s"))).alias("c")).select(day, F.col("c.s").alias("champion"), (-F.col("c.w")).alias("wins"))
    before = F.lag("champion").over(Window.orderBy(day))
    return champ.withColumn("changed", F.coalesce(before != F.col("champion"), F.lit(False)))


def distribution(df: DataFrame, c: str, buckets: DataFrame) -> DataFrame:
    """Rows and percent of each bucket (column bucket), empty ones with 0."""
    n = df.groupBy(F.col(c).alias("bucket")).agg(F.count("*").alias("n"))
    out = buckets.join(n, "bucket", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    total = out.agg(F.sum("n").alias("_t"))
    return out.crossJoin(F.broadcast(total)).withColumn("pct", F.round(F.col("n") * 100.0 / F.coalesce(F.nullif("_t", F.lit(0)), F.lit(1)), 2)).drop("_t")


def balances(account: str, *movements: tuple[DataFrame, Column]) -> DataFrame:
    """Balance and number of movements by account: the sum of signed rows from several tables, each with its signed amount."""
    rows = None
    for df, amount in movements:
        part = df.select(account, amount.alias("amount"))
        rows = part if rows is None else rows.unionByName(part)
    return rows.groupBy(account).agg(F.coalesce(F.sum("amount"), F.lit(0)).alias("balance"), F.count("*").alias("movements"))


def ledger_windows(rows: DataFrame, account: str, member: str, at: str, amount: str, as_of: str) -> DataFrame:
    """Per account and member: the sum of all amounts, and of those since the ISO week's and the month's first day, up to as_of."""
    day, now = F.col(at).cast("date"), F.lit(as_of).cast("date")
    since = lambda unit: F.coalesce(F.sum(F.when(day >= F.date_trunc(unit, now).cast("date"), F.col(amount))), F.lit(0))
    return rows.where(day <= now).groupBy(account, member).agg(F.sum(amount).alias("total"), since("week").alias("week"), since("month").alias("month"))


def item_freshness(obs: DataFrame, item: str, date: str) -> DataFrame:
    """Per item its latest date, and whether that is the latest of all (is_new)."""
    own = obs.groupBy(item).agg(F.max(date).alias("latest"))
    return own.crossJoin(F.broadcast(own.agg(F.max("latest").alias("_last")))).withColumn("is_new", F.col("latest") == F.col("_last")).drop("_last")


def freshness_summary(obs: DataFrame, source: str, item: str, date: str, min_obs: int = 1) -> DataFrame:
    """Per source: its latest date, items, and whether that is the latest date of all; of dates with min_obs rows where there are any."""
    latest = obs.groupBy(source).agg(F.max(date).alias("latest"), F.count_distinct(item).alias("items"))
    dates = obs.groupBy(date).agg(F.count("*").alias("n")).agg(F.coalesce(F.max(F.when(F.col("n") >= min_obs, F.col(date))), F.max(date)).alias("_last"))
    return latest.crossJoin(F.broadcast(dates)).withColumn("is_new", F.col("latest") >= F.col("_last")).withColumnRenamed("_last", "global_latest")


def row_hash(columns: Names) -> Column:
    """SHA-256 of the columns as text, a unit separator between them and a character of its own for null."""
    return F.sha2(F.concat_ws("\x1f", *(F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in columns)), 256)


def _summed(rows, keys: Names) -> DataFrame:
    """Rows and the SHA-256 of the added words of their hashes (_h), by keys."""
    words = [F.conv(F.substring("_h", 8 * i + 1, 8), 16, 10).cast("decimal(20,0)") for i in range(8)]
    sums = rows.groupBy(*keys).agg(F.count("*").alias("rows"), *(F.coalesce(F.sum(w), F.lit(0)).alias(f"_{i}") for i, w in enumerate(words)))
    return sums.select(*keys, "rows", F.sha2(F.concat_ws(",", "rows", *(F.col(f"_{i}").cast("string") for i in range(8))), 256).alias("sha256"))


def fingerprint(df: DataFrame, columns: Names) -> DataFrame:
    """One row that tells a table's content, whatever its order: rows, and a SHA-256.

    Rows' hashes are added up by their eight 32-bit words, map-side and exactly, and the sums are hashed: no row meets
    another, where a sorted list of all hashes would be one task's.
    """
    return _summed(df.select(row_hash(columns).alias("_h")), [])


def key_range(keys: Names, ranges: int) -> Column:
    """The range of a row's keys: of equal size each, by a hash over the keys and which of them are null."""
    return F.pmod(F.xxhash64(*keys, *(F.col(k).isNull() for k in keys)), F.lit(ranges)).cast("int")


def fingerprints(df: DataFrame, keys: Names, columns: Names, ranges: int = 4096) -> DataFrame:
    """fingerprint() of each range of keys that has rows: range, rows and a SHA-256. Kept, it stands for the table in a later comparison."""
    return _summed(df.select(key_range(keys, ranges).alias("range"), row_hash(columns).alias("_h")), ["range"])


def changed_ranges(prev_prints: DataFrame, cur_prints: DataFrame) -> DataFrame:
    """Ranges in which two tables' fingerprints differ, or that only one of them has."""
    a, b = (p.select("range", F.struct("rows", "sha256").alias(n)) for p, n in ((prev_prints, "_a"), (cur_prints, "_b")))
    return a.join(b, "range", "full").where(~F.col("_a").eqNullSafe(F.col("_b"))).select("range")


def local_diff(prev: DataFrame, cur: DataFrame, key: str, columns: Names, ranges: int = 4096, prev_prints: DataFrame | None = None) -> DataFrame:
    """field_diff() of the ranges of keys whose fingerprints differ: rows of all others are hashed and added up, never shuffled or joined.

    prev_prints: fingerprints() of prev by the same key, columns and number of ranges, kept from its own run, so that prev is read
    once. A null key meets none, as in field_diff(). The ranges that differ, at most so many numbers, are broadcast.
    """
    own = [key, *(c for c in columns if c != key)]
    before = prev_prints if prev_prints is not None else fingerprints(prev, [key], own, ranges)
    differ = F.broadcast(changed_ranges(before, fingerprints(cur, [key], own, ranges)).withColumnRenamed("range", "_range"))
    at = [side.withColumn("_range", key_range([key], ranges)).join(differ, "_range", "left_semi") for side in (prev.select(*own), cur.select(*own))]
    return field_diff(*at, key, columns)


def changed(prev: DataFrame, cur: DataFrame, columns: Names) -> bool:
    """Whether two tables' fingerprints differ: an action, for the gate before a rebuild."""
    return fingerprint(prev, columns).first() != fingerprint(cur, columns).first()


def field_diff(prev: DataFrame, cur: DataFrame, key: str, columns: Names) -> DataFrame:
    """Rows (key, field, old, new) of the fields, as text, in which two tables with one row a key differ; a key of one side only differs in all it has."""
    text = lambda side, c: F.col(f"{side}.{c}").cast("string")
    both = prev.select(key, *columns).alias("p").join(cur.select(key, *columns).alias("c"), key, "full")
    cells = F.array(*(F.struct(F.lit(c).alias("field"), text("p", c).alias("old"), text("c", c).alias("new")) for c in columns))
    return both.select(key, F.explode(F.filter(cells, lambda x: ~x["old"].eqNullSafe(x["new"]))).alias("x")).select(key, "x.*")


def should_run(prev_print, cur_print, output_exists: bool, force: bool = False) -> bool:
    """The gate before a rebuild: forced, changed, or the output is missing."""
    return force or not output_exists or prev_print != cur_print


def check_contract(df: DataFrame, required: Names, patterns: Mapping[str, str] | None = None) -> DataFrame:
    """One row per rule broken (rule, column, n): a missing column, or values that a column's pattern doesn't match."""
    missing = [c for c in required if c not in df.columns]
    exprs = [F.struct(F.lit("pattern").alias("rule"), F.lit(c).alias("column"), F.count_if(~F.coalesce(F.col(c).cast("string").rlike(p), F.lit(False))).alias("n")) for c, p in (patterns or {}).items() if c in df.columns]
    fixed = [F.struct(F.lit("missing").alias("rule"), F.lit(c).alias("column"), F.lit(1).cast("long").alias("n")) for c in missing]
    one = df.agg(F.array(*exprs).alias("v")) if exprs else df.agg(F.count("*").alias("_")).select(F.array().cast("array<struct<rule:string,column:string,n:bigint>>").alias("v"))
    rows = F.concat("v", F.array(*fixed)) if fixed else F.col("v")
    return one.select(F.explode(rows).alias("r")).select("r.*").where("n > 0")


def year_over_year(df: DataFrame, year: str, value: str, keys: Names = ()) -> DataFrame:
    """df with the change from the year before in percent; a missing year gives null."""
    w = Window.partitionBy(*keys).orderBy(year)
    before = F.when(F.lag(year).over(w) == F.col(year) - 1, F.lag(value).over(w))
    return df.withColumn("yoy_pct", F.round((F.col(value) - before) * 100.0 / F.when(before != 0, before), 2))


def share_of_total(df: DataFrame, value: str, keys: Names = ()) -> DataFrame:
    """df with the share of the group's sum in percent."""
    total = df.groupBy(*keys).agg(F.sum(value).alias("_t"))
    joined = df.join(total, list(keys)) if keys else df.crossJoin(F.broadcast(total))
    return joined.withColumn("share_pct", F.round(F.col(value) * 100.0 / F.when(F.col("_t") != 0, F.col("_t")), 2)).drop("_t")


def unit_value(df: DataFrame, value: str, quantity: str, digits: int = 4) -> DataFrame:
    """df with unit_value, value over quantity; null without a quantity."""
    return df.withColumn("unit_value", F.round(F.col(value) / F.when(F.col(quantity) != 0, F.col(quantity)), digits))


def from_peak(df: DataFrame, key: str, year: str, value: str) -> DataFrame:
    """Per key: peak year (the first of equals), peak, last year and the change from the peak in percent."""
    agg = df.groupBy(key).agg(F.min(F.struct((-F.col(value)).alias("v"), F.col(year).alias("y"))).alias("p"), F.max(F.struct(F.col(year).alias("y"), F.col(value).alias("v"))).alias("l"))
    peak = -F.col("p.v")
    return agg.select(key, F.col("p.y").alias("peak_year"), peak.alias("peak"), F.col("l.y").alias("last_year"), F.round((F.col("l.v") - peak) * 100.0 / F.when(peak != 0, peak), 2).alias("from_peak_pct"))
