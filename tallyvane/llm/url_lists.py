"""URL filters over time: list entries become intervals of validity, and every capture meets the entries active when it was fetched.

A list is a log of dated entries: pattern (a host or a parent domain), action (`block`, `allow` or `remove`) and the time
from which it holds. An entry holds until the next one of its pattern. A capture is judged by the most specific
listed suffix of its host, by the last entry at or before its time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyvane.llm.common import cut

#: Intervals that are broadcast; a longer list is joined by shuffling, where Spark splits the skewed hosts.
BROADCAST = 100_000
#: Intervals of one pattern that lie in one array.
ERA = 256


def host_of(url: Column) -> Column:
    """Lower-cased host of a URL without port, user and final dot, an IPv6 address with its brackets; null where there is none."""
    host = F.lower(F.regexp_extract(url, r"^\s*[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:\[]+)", 1))
    host = F.regexp_replace(host, r"\.+$", "")
    return F.when(host != "", host)


def suffixes(host: str) -> Column:
    """The host and its parents of two labels or more, the most specific first; of an address in numbers or brackets only itself."""
    parts = f"split({host}, '[.]')"
    return F.expr(f"case when {host} is null then null when size({parts}) < 2 or {host} rlike '^[0-9.]+$' or left({host}, 1) = '[' then array({host}) else transform(sequence(0, size({parts}) - 2), i -> array_join(slice({parts}, i + 1, size({parts})), '.')) end")


def intervals(entries: DataFrame) -> DataFrame:
    """Rows (pattern, action, valid_from, valid_to) of entries (pattern, action, listed_at); valid_to is null for what still holds.

    Of entries of one pattern and time, the last in the order allow, block, remove counts. Entries with nulls are ignored,
    `remove` gives no interval, repeated entries change nothing, and no entries give no intervals. Other columns aren't read.
    """
    own = entries.select(F.lower("pattern").alias("pattern"), "action", "listed_at").where("pattern is not null and action is not null and listed_at is not null")
    one = own.groupBy("pattern", "listed_at").agg(F.max("action").alias("action"))
    after = Window.partitionBy("pattern").orderBy("listed_at")
    return one.withColumn("valid_to", F.lead("listed_at").over(after)).where("action <> 'remove'").select("pattern", "action", F.col("listed_at").alias("valid_from"), "valid_to")


def _histories(held: DataFrame) -> DataFrame:
    """One row (pattern, era, history) for each pattern and stretch of ERA intervals; era is when the stretch begins, eras of a pattern all of these.

    A capture picks its stretch first and an interval in it then, so that neither step grows with a long history.
    """
    order = Window.partitionBy("pattern").orderBy("valid_from")
    numbered = held.withColumn("stretch", F.floor((F.row_number().over(order) - 1) / ERA))
    each = numbered.groupBy("pattern", "stretch").agg(F.min("valid_from").alias("era"), F.array_sort(F.collect_list(F.struct("valid_from", "valid_to", "action"))).alias("history"))
    return each.select("pattern", "era", "history")


def judge(captures: DataFrame, entries: DataFrame, id_col: str, url_col: str = "url", time_col: str = "fetched_at", broadcast_rows: int = BROADCAST) -> DataFrame:
    """One row per capture: its id, host, verdict (`block`, `allow` or `unlisted`) and the pattern that decided.

    Captures without a host or time are unlisted, all of them where there are no entries; no captures give no rows. Repeated
    captures are each judged. A URL may be of any length: only its host is kept, and its parents are as many as its dots. Other columns
    aren't read, whatever their names.

    The as-of join is a look-up: a pattern's intervals lie sorted in arrays, and a capture takes the last that began at or
    before it, so a row meets each of its patterns once, however many intervals these have.
    """
    held = cut(intervals(entries))
    small = held.count() <= broadcast_rows
    histories = _histories(held)
    eras = histories.groupBy("pattern").agg(F.array_sort(F.collect_list("era")).alias("eras"))
    bounded = F.broadcast if small else lambda df: df
    seen = captures.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"), F.col(time_col).alias("at"))
    tried = seen.select("*", F.posexplode_outer(suffixes("host")).alias("depth", "pattern"))
    at = F.col("at")
    dated = tried.join(bounded(eras), "pattern", "left").withColumn("era", F.array_max(F.filter("eras", lambda e: e <= at))).drop("eras")
    last = F.array_max(F.filter("history", lambda e: e["valid_from"] <= at))
    met = dated.join(bounded(histories), ["pattern", "era"], "left").withColumn("last", last)
    holds = F.col("last").isNotNull() & (F.col("last.valid_to").isNull() | (at < F.col("last.valid_to")))
    first = met.groupBy("_row").agg(F.first("id").alias("id"), F.first("host").alias("host"), F.min(F.when(holds, F.struct("depth", F.col("last.action").alias("action"), F.col("pattern").alias("listed")))).alias("best"))
    return first.select(F.col("id").alias(id_col), "host", F.coalesce("best.action", F.lit("unlisted")).alias("verdict"), F.col("best.listed").alias("pattern"))
