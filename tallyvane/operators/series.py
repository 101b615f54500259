"""Windows and time series: previous values, events, trajectories, runs, top-N logs and recommendations."""

from __future__ import annotations

from collections.abc import Sequence

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyvane.operators import ranking, scans
from tallyvane.operators.segments import merge_segments  # noqa: F401

Names = Sequence[str]
#: Rows of a table that a task should hold.
TASK_ROWS = 1_000_000


def last_per_day(obs: DataFrame, keys: Names, date: str, value: str) -> DataFrame:
    """One row per key and day: the day's lowest value."""
    return obs.where(F.col(value).isNotNull()).groupBy(*keys, date).agg(F.min(value).alias(value))


def prev_value(obs: DataFrame, keys: Names, date: str, value: str) -> DataFrame:
    """The last day of each key with the value of the day before it and a badge: up, down, same or new.

    Two aggregates and no window, so a key may have any number of days: the greatest day, then the greatest before that.
    """
    day = last_per_day(obs, keys, date, value)
    newest = day.groupBy(*keys).agg(F.max(date).alias("_d"))
    near = day.join(scans.renamed(newest, keys, "_d"), scans.same(keys)).drop(*(f"_k_{k}" for k in keys))
    last = F.max(F.when(F.col(date) == F.col("_d"), F.col(value)))
    before = F.max(F.when(F.col(date) < F.col("_d"), F.struct(date, value)))
    out = near.groupBy(*keys).agg(F.first("_d").alias(date), last.alias(value), before[value].alias("prev"))
    badge = F.when(F.col("prev").isNull(), "new").when(F.col(value) < F.col("prev"), "down").when(F.col(value) > F.col("prev"), "up").otherwise("same")
    return out.withColumn("badge", badge)


def drop_events(obs: DataFrame, keys: Names, date: str, value: str, most: int | None = scans.MOST) -> DataFrame:
    """Days on which a series' value is under that of its day before; a key of more than `most` days is scanned in parts."""
    return scans.row_before(last_per_day(obs, keys, date, value), keys, date, value, "prev", most).where(F.col(value) < F.col("prev"))


def event_study(events: DataFrame, series: DataFrame, key: str, date: str, value: str, days: Sequence[int]) -> DataFrame:
    """What the outcome series does in the days after each event: hit (it falls), reverse (rises), flat, or why that can't be seen.

    The value at the event is the series' last at or before its day; the outcome is the least within (day, day + k].
    """
    s = last_per_day(series, [key], date, value).select(key, F.col(date).alias("_d"), F.col(value).alias("_v"))
    e = events.select(key, F.col(date).alias("_d"), F.lit(True).alias("_e")).distinct()
    # Events and series in one timeline per key: one shuffle, and no pairs of events and days are made.
    line = s.unionByName(e, allowMissingColumns=True).withColumn("_day", F.unix_date(F.col("_d").cast("date")))
    time = Window.partitionBy(key).orderBy("_day")
    line = line.withColumn("before", F.last("_v", ignorenulls=True).over(time.rangeBetween(Window.unboundedPreceding, 0))).withColumn("_n", F.count("_v").over(Window.partitionBy(key)))
    ends = F.array(*(F.struct(F.lit(k).alias("k"), F.min("_v").over(time.rangeBetween(1, k)).alias("after")) for k in days))
    out = line.withColumn("_k", ends).where("_e").select(key, F.col("_d").alias("event_date"), "before", "_n", F.explode("_k").alias("_k")).select(key, "event_date", "_k.k", "before", "_k.after", "_n")
    verdict = (
        F.when(F.col("_n") == 0, "no series")
        .when(F.col("before").isNull(), "unobservable before")
        .when(F.col("after").isNull(), "unobservable in window")
        .when(F.col("after") < F.col("before"), "hit")
        .when(F.col("after") > F.col("before"), "reverse")
        .otherwise("flat")
    )
    return out.withColumn("verdict", verdict).drop("_n")


def baseline_rate(series: DataFrame, exclude: DataFrame, key: str, date: str, value: str, k: int) -> DataFrame:
    """One row: of all points of keys without events that have a value within k days, how many are followed by a lower one, and the upper median of the change."""
    s = last_per_day(series, [key], date, value).join(exclude.select(key).distinct(), key, "left_anti")
    w = Window.partitionBy(key).orderBy(F.unix_date(F.col(date).cast("date"))).rangeBetween(1, k)
    seen = s.withColumn("after", F.min(value).over(w)).where("after is not null").withColumn("change", F.col("after") - F.col(value))
    n = seen.agg(F.count("*").alias("n"), F.count_if(F.col("change") < 0).alias("drops"))
    half = F.floor(F.col("total") / 2)
    middle = ranking.running_counts(seen, [], "change").where((F.col("before") <= half) & (half < F.col("before") + F.col("n")))
    return n.crossJoin(F.broadcast(middle.agg(F.max("change").alias("upper_median")))).withColumn("rate", F.round(F.col("drops") / F.when(F.col("n") != 0, F.col("n")), 4))


def trajectory(series: DataFrame, key: str, period: str, value: str, step: float = 0.015, least: int = 3, task: int | None = TASK_ROWS) -> DataFrame:
    """Per key with at least so many periods that have a value: where the last value lies in the range, and a tag from its last two changes.

    Tags, first that holds: rebound (down, then up), pullback (up, then down), rising, falling, then steady. One sort: the
    aggregate by key goes on with the window's partitions. Where the session's partitions, or its cores, to whose number they are merged, would
    hold more than `task` rows each there are more of them, so a task's memory doesn't grow with the table; a reading task then only
    deals its rows out and aggregates nothing. The rows are counted when the plan is made (None: they aren't).
    """
    w = Window.partitionBy(key).orderBy(period)
    change = lambda a, b: (a - b) / F.when(b != 0, b)
    rows = series.where(F.col(value).isNotNull()).select(key, period, value)
    tasks = -(-rows.count() // task) if task else 0
    held = min(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows.sparkSession.sparkContext.defaultParallelism)
    spread = lambda d, *c: d.repartition(tasks, *c) if tasks > held else d
    s = spread(spread(rows, key, period).groupBy(key, period).agg(F.min(value).alias("_v")), key)
    s = s.withColumn("_1", F.lag("_v", 1).over(w)).withColumn("_2", F.lag("_v", 2).over(w))
    last = F.max(F.struct(F.col(period).alias("p"), F.col("_v").alias("v"), F.col("_1").alias("a"), F.col("_2").alias("b"))).alias("_l")
    s = s.groupBy(key).agg(last, F.count("*").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")).where(F.col("_n") >= least)
    v = F.col("_l.v")
    now, past = change(v, F.col("_l.a")), F.coalesce(change(F.col("_l.a"), F.col("_l.b")), F.lit(0.0))
    at = (v - F.col("_lo")) / F.when(F.col("_hi") > F.col("_lo"), F.col("_hi") - F.col("_lo"))
    tier = F.when(at.isNull(), "flat").when(at <= 0.25, "cheap").when(at >= 0.75, "dear").otherwise("middle")
    tag = F.when((now > step) & (past < -step), "rebound").when((now < -step) & (past > step), "pullback").when(now > step, "rising").when(now < -step, "falling").otherwise("steady")
    return s.select(key, F.col("_l.p").alias("last"), v.alias("value"), F.col("_n").alias("periods"), tier.alias("tier"), tag.alias("tag"))


def rare_drops(
    history: DataFrame, key: str, date: str, price: str, week_start: str, week_end: str, drop: float = 0.20, band: float = 0.02, persist: int = 6, flat: float = 0.04, discount: str | None = None, base_discount: float = 20.0
) -> DataFrame:
    """Keys whose price falls in a week by `drop` from a plateau: the highest price met, within band, on at least `persist` dates.

    The current price is that of the week's last date. It must be the first so low (within band), on a date of the week;
    at least `persist` dates lie before that, their prices flat (their range within `flat` of the plateau), and the last of
    them was at most base_discount percent off, where a column of discounts is given.
    """
    day = history.where(F.col(price) > 0).groupBy(key, date).agg(F.min(F.struct(F.col(price).alias("p"), (F.col(discount) if discount else F.lit(None).cast("double")).alias("off"))).alias("_s")).select(key, date, F.col("_s.p").alias("_p"), F.col("_s.off").alias("_off"), F.log("_s.p").alias("_lp"))
    # Prices within the band are a stretch of the key's prices in order of their logarithm, so no two dates are paired.
    reach = f"range between {-math.log(1 - band) + 1e-12!r}D preceding and {math.log(1 + band) + 1e-12!r}D following"
    met = day.withColumn("_met", F.expr(f"count(*) over (partition by `{key}` order by _lp {reach})"))
    start, end = (F.lit(x).cast("date") for x in (week_start, week_end))
    own = Window.partitionBy(key)
    now = F.max(F.when(F.col(date).between(start, end), F.struct(F.col(date).alias("d"), F.col("_p").alias("p"))))
    met = met.withColumn("_now", now.over(own)["p"]).where("_now is not null")
    met = met.withColumn("_first", F.min(F.when(F.col("_p") <= F.col("_now") * (1 + band), F.col(date))).over(own))
    before = F.col(date) < F.col("_first")
    agg = met.groupBy(key).agg(
        F.max(F.when((F.col("_met") >= persist) & (F.col("_p") > F.col("_now") * (1 + drop * 0.5)), F.col("_p"))).alias("plateau"),
        F.first("_now").alias("current"),
        F.first("_first").alias("drop_date"),
        F.count_if(before).alias("flat_days"),
        F.min(F.when(before, F.col("_p"))).alias("_lo"),
        F.max(F.when(before, F.col("_p"))).alias("_hi"),
        F.max(F.when(before, F.struct(F.col(date).alias("d"), F.col("_off").alias("off")))).alias("_last"),
    )
    ok = (F.col("plateau") - F.col("current") >= F.col("plateau") * drop) & F.col("drop_date").between(start, end) & (F.col("flat_days") >= persist) & (F.col("_hi") - F.col("_lo") <= F.col("plateau") * flat)
    if discount:
        ok = ok & F.coalesce(F.col("_last.off") <= base_discount, F.lit(True))
    return agg.where(ok).select(key, "plateau", "current", F.round((1 - F.col("current") / F.col("plateau")) * 100, 2).alias("drop_pct"), "drop_date", "flat_days")


def value_lenses(a: DataFrame, b: DataFrame, group: str, key: str, rank: str, price: str) -> DataFrame:
    """Of each item of a: the highest lesser-ranked item of b in its group that costs as much or more, and the gap to b's same rank in percent."""
    x = a.select(group, key, F.col(rank).alias("rank"), F.col(price).alias("price"))
    best = b.groupBy(group, rank).agg(F.min(price).alias("other")).withColumnRenamed(rank, "other_rank")
    joined = x.join(best, group, "left")
    under = F.max(F.when((F.col("other_rank") < F.col("rank")) & (F.col("price") <= F.col("other")), F.col("other_rank")))
    same = F.min(F.when(F.col("other_rank") == F.col("rank"), F.col("other")))
    out = joined.groupBy(group, key, "rank", "price").agg(under.alias("beats_rank"), same.alias("same_rank_price"))
    return out.withColumn("same_rank_gap_pct", F.round((F.col("price") - F.col("same_rank_price")) * 100.0 / F.when(F.col("same_rank_price") != 0, F.col("same_rank_price")), 2))


def lens_score(df: DataFrame, rank: str = "rank", beats: str = "beats_rank", gap_pct: str = "same_rank_gap_pct", low: str | None = None, below: str | None = None) -> DataFrame:
    """df with score: 100 and 15 a rank for beating a lesser rank's price, the percent under the same rank's, 25 for a recent low, else 8 under the mean."""
    score = F.when(F.col(beats).isNotNull(), 100 + 15 * (F.col(rank) - F.col(beats))).otherwise(0) + F.when(F.col(gap_pct) < 0, F.round(-F.col(gap_pct))).otherwise(0)
    if low:
        score = score + F.when(F.coalesce(low, F.lit(False)), 25).when(F.coalesce(below, F.lit(False)) if below else F.lit(False), 8).otherwise(0)
    return df.withColumn("score", score.cast("long"))


def recent_lens(ts: DataFrame, key: str, date: str, value: str, last: int = 14, least: int = 3) -> DataFrame:
    """Over each key's last points: whether its latest is their low, and whether it is under their mean."""
    w = Window.partitionBy(key).orderBy(F.col(date).desc())
    own = last_per_day(ts, [key], date, value).withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= last)
    agg = own.groupBy(key).agg(F.count("*").alias("n"), F.min(value).alias("_lo"), F.avg(value).alias("_mean"), F.max_by(value, date).alias("latest")).where(F.col("n") >= least)
    return agg.select(key, "n", "latest", (F.col("latest") <= F.col("_lo")).alias("recent_low"), (F.col("latest") < F.col("_mean")).alias("below_mean"))


def attractiveness(df: DataFrame, gap: str, demand: str, stock: str, weights: tuple[float, float, float] = (0.5, 0.3, 0.2), stock_cap: Column | None = None) -> DataFrame:
    """df with score 0..100: clamped gap, log demand over the greatest, and stock under a cap, weighted.

    The two maxima are one small aggregate beside the table, not a window over all of it.
    """
    cap = df.agg(F.max(F.log1p(F.greatest(F.col(demand), F.lit(0)))).alias("_d"), F.max(F.col(stock) if stock_cap is None else stock_cap).alias("_s"))
    safe = lambda c: F.coalesce(F.nullif(F.col(c).cast("double"), F.lit(0.0)), F.lit(1.0))
    clamp = lambda c: F.greatest(F.lit(0.0), F.least(F.lit(1.0), c))
    parts = [clamp(F.coalesce(F.col(gap) / 100, F.lit(0.0))), clamp(F.coalesce(F.log1p(F.greatest(F.col(demand), F.lit(0))) / safe("_d"), F.lit(0.0))), clamp(F.coalesce(F.col(stock) / safe("_s"), F.lit(0.0)))]
    score = sum((w * p for w, p in zip(weights, parts, strict=True)), F.lit(0.0))
    return df.crossJoin(F.broadcast(cap)).withColumn("score", F.round(score * 100, 4)).drop("_d", "_s")


def banded_top_n(df: DataFrame, band: str, value: str, n: int, tie: Names) -> DataFrame:
    """Best n of each band by a score from 0 (the band's least) to 1; all 0.5 where they don't differ."""
    span = df.groupBy(band).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    score = F.when(F.col("_hi") > F.col("_lo"), (F.col(value) - F.col("_lo")) / (F.col("_hi") - F.col("_lo"))).otherwise(0.5)
    out = df.join(span, band).withColumn("score", F.round(score, 6)).drop("_lo", "_hi")
    w = Window.partitionBy(band).orderBy(F.col(value).desc(), *tie)
    return out.withColumn("place", F.row_number().over(w)).where(F.col("place") <= n)


def gap_table(cmp: DataFrame, a: str, b: str, units: str) -> DataFrame:
    """cmp with gap of b over a: per unit, for `units` of them, and percent of b."""
    gap = F.col(b) - F.col(a)
    return cmp.withColumn("gap", gap).withColumn("gap_total", gap * F.col(units)).withColumn("gap_pct", F.round(gap * 100.0 / F.when(F.col(b) != 0, F.col(b)), 2))


def rank_movers(prev: DataFrame, cur: DataFrame, key: str, a: str, b: str) -> DataFrame:
    """Common keys with their rank by gap (b - a) in both snapshots, the move, and which of the two prices moved more."""

    def ranked(df: DataFrame, tag: str) -> DataFrame:
        own = df.select(key, F.col(a).alias(f"a_{tag}"), F.col(b).alias(f"b_{tag}"), (F.col(b) - F.col(a)).alias("_gap"))
        return ranking.with_rank(own, "_gap", f"rank_{tag}").drop("_gap")

    both = ranked(prev, "prev").join(ranked(cur, "cur"), key)
    da, db = F.abs(F.col("a_cur") - F.col("a_prev")), F.abs(F.col("b_cur") - F.col("b_prev"))
    cause = F.when((da == 0) & (db == 0), "none").when(da >= db, a).otherwise(b)
    return both.select(key, "rank_prev", "rank_cur", (F.col("rank_prev") - F.col("rank_cur")).alias("climb"), cause.alias("cause"))


def topn_entry_exit(daily: DataFrame, day: str, key: str, value: str, n: int, group: Names = ()) -> DataFrame:
    """Entries to and exits from the top n of each group against the day before that the group has."""
    order = Window.partitionBy(*group, day).orderBy(F.col(value).desc(), key)
    top = daily.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= n).select(*group, day, key)
    days = daily.select(*group, day).distinct().withColumn("_next", F.lead(day).over(Window.partitionBy(*group).orderBy(day)))
    follow = top.join(days, [*group, day]).where("_next is not null").select(*group, F.col("_next").alias(day), key)
    first = days.withColumn("_first", F.min(day).over(Window.partitionBy(*group))).select(*group, day, "_first")
    later = top.join(first, [*group, day])
    entered = later.where(F.col(day) > F.col("_first")).drop("_first").join(follow, [*group, day, key], "left_anti").withColumn("event", F.lit("entry"))
    left = follow.join(top, [*group, day, key], "left_anti").withColumn("event", F.lit("exit"))
    return entered.select(*group, day, key, "event").unionByName(left.select(*group, day, key, "event"))


def best_per_key(df: DataFrame, keys: Names, order: Sequence[Column]) -> DataFrame:
    """The first row of each key in an order that should leave no ties."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def best_n(df: DataFrame, keys: Names, order: Sequence[Column], n: int, name: str = "place") -> DataFrame:
    """The first n rows of each key with their place, in an order that should leave no ties; Spark keeps n rows a key and task before it shuffles."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(name) <= n)


def opportunity_diff(prev: DataFrame, cur: DataFrame, key: str, live: DataFrame | None = None) -> DataFrame:
    """Keys of two reports as new, still or expired; expired only where live, if given, can tell, else unknown."""
    both = prev.select(key, F.lit(True).alias("_p")).distinct().join(cur.select(key, F.lit(True).alias("_c")).distinct(), key, "full")
    status = F.when(F.col("_p").isNull(), "new").when(F.col("_c").isNotNull(), "still").otherwise("expired")
    out = both.select(key, status.alias("status"))
    if live is None:
        return out
    seen = out.join(live.select(key, F.lit(True).alias("_l")).distinct(), key, "left")
    return seen.select(key, F.when((F.col("status") == "expired") & F.col("_l").isNull(), "unknown").otherwise(F.col("status")).alias("status"))


def recommend(candidates: DataFrame, key: str, prev_gap: str, gap: str, state: DataFrame, date: str, n: int = 5, widened: float = 5.0) -> DataFrame:
    """Up to n keys for a date: first what is new or whose gap widened by over `widened` percent, then others that weren't recommended last time.

    state holds the recommendations so far (date, key); the newest date before this one is the last time. What comes out
    has the columns of state, so it can be appended, and place, gap and fresh.
    """
    last = state.where(F.col("date") < F.lit(date).cast(state.schema["date"].dataType))
    last = last.join(F.broadcast(last.agg(F.max("date").alias("date"))), "date").select(key, F.lit(True).alias("_last")).distinct()
    fresh = F.col(prev_gap).isNull() | ((F.col(gap) - F.col(prev_gap)) * 100.0 > F.col(prev_gap) * widened)
    seen = candidates.where(F.col(gap) > 0).withColumn("fresh", fresh).join(last, key, "left").where(F.col("fresh") | F.col("_last").isNull())
    order = [F.when(F.col("fresh"), 0).otherwise(1), F.col(gap).desc(), F.col(key)]
    top = seen.orderBy(*order).limit(n)  # the window sees these n
    place = F.row_number().over(Window.orderBy(*order)).alias("place")
    return top.select(F.lit(date).cast(state.schema["date"].dataType).alias("date"), key, place, gap, "fresh", F.coalesce("_last", F.lit(False)).alias("repeated"))


def stable_runs(df: DataFrame, key: str, ts: str, diff: str, threshold: float, least: int = 1, tie: str | None = None, most: int | None = scans.MOST) -> DataFrame:
    """Runs of rows whose diff stays under the threshold: start, end, rows and the middle row's time. A null diff counts as under.

    Keys, and runs, of more than `most` rows are scanned in parts of their time, which hand on the run's number and their rows.
    """
    order = [tie] if tie else []
    ends = F.when(F.col(diff) >= threshold, 1).otherwise(0)
    runs = scans.sum_so_far(df, [key], ts, order, ends, "_run", most)
    runs = scans.numbered(runs, [key, "_run"], ts, order, "_i", "_n", most)
    agg = runs.groupBy(key, "_run").agg(F.min(ts).alias("start"), F.max(ts).alias("end"), F.count("*").alias("n"), F.min(F.when(F.col("_i") == F.floor(F.col("_n") / 2) + 1, F.col(ts))).alias("middle"))
    return agg.where(F.col("n") >= least).select(key, F.col("_run").alias("run"), "start", "end", "n", "middle")


def dedup_adjacent(df: DataFrame, key: str, ts: str, value: str, gap_seconds: float) -> DataFrame:
    """Rows that repeat the value of the row before them go, unless more than gap_seconds lie between."""
    w = Window.partitionBy(key).orderBy(ts)
    same = (F.lag(value).over(w) == F.col(value)) & ((F.unix_micros(F.col(ts)) - F.unix_micros(F.lag(ts).over(w))) <= int(gap_seconds * 1_000_000))
    return df.withColumn("_same", F.coalesce(same, F.lit(False))).where(~F.col("_same")).drop("_same")


def fill_gaps(df: DataFrame, key: str, date: str) -> DataFrame:
    """The days between a key's first and last that it has no row on."""
    w = Window.partitionBy(key).orderBy(date)
    own = df.select(key, date).distinct().withColumn("_next", F.lead(date).over(w)).where(F.datediff("_next", date) > 1)
    return own.select(key, F.explode(F.sequence(F.date_add(date, 1), F.date_sub("_next", 1))).alias(date))


def coverage(df: DataFrame, key: str, date: str) -> DataFrame:
    """Share of the days between a key's first and last that it has rows on."""
    agg = df.groupBy(key).agg(F.count_distinct(date).alias("days"), (F.datediff(F.max(date), F.min(date)) + 1).alias("span"))
    return agg.withColumn("coverage", F.round(F.col("days") / F.col("span"), 4))


def carry_forward(cur: DataFrame, prior: DataFrame, key: str, value: str, note: str = "note", tag: str = "carried") -> DataFrame:
    """cur with missing values taken from the prior snapshot and tagged; tags of earlier runs are stripped first."""
    old = prior.groupBy(key).agg(F.max(value).alias("_old"))
    clean = F.trim(F.regexp_replace(F.coalesce(note, F.lit("")), rf"\s*\[{tag}\]", ""))
    out = cur.join(old, key, "left")
    took = F.col(value).isNull() & F.col("_old").isNotNull()
    return out.withColumn(note, F.when(took, F.trim(F.concat(clean, F.lit(f" [{tag}]")))).otherwise(clean)).withColumn("carried", took).withColumn(value, F.coalesce(value, "_old")).drop("_old")


def carry_over_dates(df: DataFrame, key: str, date: str, value: str, most: int | None = scans.MOST) -> DataFrame:
    """df with the last value that isn't null up to each date; a key of more than `most` rows is scanned in parts."""
    return scans.last_so_far(df, [key], date, [], value, "filled", most)


def window_change(series: DataFrame, key: str, date: str, value: str, start: str, end: str) -> DataFrame:
    """First and last value of each key in a window of dates, the change and percent; with under two points, the last two ever."""
    s = series.where(F.col(value).isNotNull()).groupBy(key, date).agg(F.max(value).alias(value))
    inside = F.col(date).between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    back = Window.partitionBy(key).orderBy(F.col(date).desc())
    s = s.withColumn("_r", F.row_number().over(back))
    agg = s.groupBy(key).agg(
        F.count_if(inside).alias("points"),
        F.min(F.when(inside, F.struct(date, value)))[value].alias("_a"),
        F.max(F.when(inside, F.struct(date, value)))[value].alias("_b"),
        F.max(F.when(F.col("_r") == 2, F.col(value))).alias("_c"),
        F.max(F.when(F.col("_r") == 1, F.col(value))).alias("_d"),
    )
    enough = F.col("points") >= 2
    first, last = F.when(enough, F.col("_a")).otherwise(F.col("_c")), F.when(enough, F.col("_b")).otherwise(F.col("_d"))
    return agg.select(key, "points", first.alias("first"), last.alias("last"), (last - first).alias("change"), F.round((last - first) * 100.0 / F.when(first != 0, first), 4).alias("pct"))


def classify_highlights(diff: DataFrame, floor: DataFrame, key: str, new: str, pct: str, floor_col: str, meaningful: float = 3.0, major: float = 10.0) -> DataFrame:
    """diff with highlight (breakthrough under the floor, drop or rise of `meaningful` percent, other) and weight (major or minor)."""
    joined = diff.join(floor.select(key, F.col(floor_col).alias("_floor")), key, "left")
    kind = F.when(F.col(new) < F.col("_floor"), "breakthrough").when(F.col(pct) <= -meaningful, "drop").when(F.col(pct) >= meaningful, "rise").otherwise("other")
    return joined.withColumn("highlight", kind).withColumn("weight", F.when(F.abs(pct) >= major, "major").otherwise("minor")).drop("_floor")


def cadence(highlights: DataFrame) -> DataFrame:
    """One row: `instant` when a breakthrough or major change is there, `digest` when anything else is, else `none`."""
    agg = highlights.agg(F.count_if((F.col("highlight") == "breakthrough") | (F.col("weight") == "major")).alias("urgent"), F.count_if(F.col("highlight") != "other").alias("notable"))
    return agg.withColumn("cadence", F.when(F.col("urgent") > 0, "instant").when(F.col("notable") > 0, "digest").otherwise("none"))
