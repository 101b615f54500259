"""Joins and entity resolution.

Names are resolved once per distinct name and joined back. Rule tables and dimensions are broadcast only where their
counted size allows it; beyond that the same join is left to Spark, blocked by an equal key wherever one exists.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort
from collections.abc import Mapping, Sequence
from itertools import product

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tallyvane.functions.automaton import needles_in
from tallyvane.functions.similarity import seq_ratio
from tallyvane.functions.text import AGE_PATTERN, VOLUME_PATTERN, age, descriptor_set, model_numbers, normalize_name, rewrite, tokens
from tallyvane.functions.values import EARTH_M, haversine_m
from tallyvane.operators import ranking, scans
from tallyvane.operators.lineage import settled

Names = Sequence[str]
#: Rows of a side that is broadcast after it was counted.
BROADCAST_ROWS = 200_000


def bounded(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if it has at most so many rows. Counting is an action when the plan is made; it stops one row beyond."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def by_alias(df: DataFrame, aliases: Mapping[str, Names]) -> DataFrame:
    """Columns by the first header that is one of their aliases, case and outer white space aside; null (a string) where none is."""
    there: dict[str, str] = {}
    for c in df.columns:
        there.setdefault(c.strip().lower(), c)
    found = {name: next((there[a] for a in [name, *own] if a in there), None) for name, own in aliases.items()}
    return df.select(*((F.col(f"`{c}`") if c else F.lit(None).cast("string")).alias(name) for name, c in found.items()))


def lookup(df: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """df with the dimension's columns; keys that the dimension lacks keep nulls."""
    return df.join(bounded(dim), key, "left")


def semi(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return df.join(keys.select(key).distinct(), key, "left_semi")


def anti(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return df.join(keys.select(key).distinct(), key, "left_anti")


def containing(texts: DataFrame, text: str, needles: DataFrame, needle: str, on: Names = (), most: int = BROADCAST_ROWS) -> DataFrame:
    """Distinct pairs (on, text, needle) of which the text holds the needle, in lower case, as it stands: letters, signs and spaces alike.

    Up to `most` needles make one automaton, and a distinct text is read once, whatever their number; rows are as many as
    hits. Beyond that both sides meet on the first one to three characters of a needle, by their own number, so
    nothing is compared with everything.
    """
    n = needles.select(*on, F.lower(needle).alias("_needle")).where("_needle <> ''").distinct()
    own = texts.select(*on, F.col(text).alias("_text")).where("_text is not null").distinct()
    block = F.to_json(F.struct(*(F.col(c).cast("string") for c in on))) if on else F.lit("{}")
    known = n.where(F.lit(True) if not on else F.expr(" and ".join(f"`{c}` is not null" for c in on))).select(block, "_needle").limit(most + 1).collect()
    if len(known) <= most:
        hits = needles_in(texts.sparkSession, [tuple(r) for r in known], F.lower("_text"), block)
        return own.select(*on, F.col("_text").alias("text"), F.explode(hits).alias("needle"))
    n = n.withColumn("_gram", F.substring("_needle", 1, 3))
    low = F.lower("_text")
    grams = lambda k: F.when(F.length(low) >= k, F.transform(F.sequence(F.lit(1), F.length(low) - k + 1), lambda i: low.substr(i, F.lit(k)))).otherwise(F.array().cast("array<string>"))
    keyed = own.select(*on, "_text", F.explode(F.array_distinct(F.concat(grams(1), grams(2), grams(3)))).alias("_gram"))
    met = keyed.join(n, [*on, "_gram"]).where(F.contains(F.lower("_text"), F.col("_needle")))
    return met.select(*on, F.col("_text").alias("text"), F.col("_needle").alias("needle"))


def _hits(names: DataFrame, rules: DataFrame) -> DataFrame:
    """(low, rule_no) of the rules that a name can meet: it holds the longest token that the rule asks for, or one of its aliases."""
    longest = F.array_min(F.transform("match", lambda t: F.struct((-F.length(t)).alias("n"), t.alias("t"))))["t"]
    probes = rules.select("rule_no", F.explode(F.array_distinct(F.array_compact(F.concat(F.array(longest), F.col("alias"))))).alias("head"))
    met = containing(names, "low", probes, "head")
    return met.join(bounded(probes.withColumnRenamed("head", "needle")), "needle").select(F.col("text").alias("low"), "rule_no").distinct()


def resolve_rules(df: DataFrame, text: str, rules: DataFrame, excludes: Names = (), age_col: str | None = None, synonyms: Mapping[str, Names] | None = None, noise: Names = ()) -> DataFrame:
    """Distinct texts with status (matched, excluded, unmatched), rule id, name and rule_no, and how many rules hit.

    rules: rule_no, id, name, match (all must stand in the text), not (none may) and alias (one in it is enough); a token
    is met as it stands, also inside words. Texts are normalised first: lower-cased, synonyms replaced, noise taken out.
    The lowest rule_no wins; excluded words come first. With age_col, a rule's age must equal the text's where both have one.
    """
    names = df.select(F.col(text).alias("text")).where("text is not null").distinct().withColumn("low", normalize_name("text", synonyms, noise))
    lowered = rules.select("rule_no", "id", "name", *(F.transform(F.coalesce(c, F.array().cast("array<string>")), lambda x: F.lower(x)).alias(c) for c in ("match", "not", "alias")), *([F.col(age_col).alias("_rule_age")] if age_col else []))
    pairs = _hits(names, lowered).join(bounded(lowered), "rule_no")
    every = (F.size("match") > 0) & F.forall("match", lambda t: F.contains(F.col("low"), t))
    some = F.exists("alias", lambda t: F.contains(F.col("low"), t))
    none = ~F.exists("not", lambda t: F.contains(F.col("low"), t))
    hit = pairs.where((every | some) & none)
    if age_col:
        own = age("low", "first")
        hit = hit.where(F.coalesce(own == F.col("_rule_age"), F.lit(True)))
    best = hit.groupBy("low").agg(F.min(F.struct("rule_no", "id", "name")).alias("b"), F.count("*").alias("hits"))
    bad = F.exists(F.array(*(F.lit(x.lower()) for x in excludes)).cast("array<string>"), lambda t: F.contains(F.col("low"), t)) if excludes else F.lit(False)
    out = names.join(best, "low", "left").withColumn("_bad", bad)
    status = F.when(F.col("_bad"), "excluded").when(F.col("b").isNotNull(), "matched").otherwise("unmatched")
    keep = F.col("status") == "matched"
    return out.withColumn("status", status).select("text", "status", F.when(keep, F.col("b.id")).alias("id"), F.when(keep, F.col("b.name")).alias("name"), F.when(keep, F.col("b.rule_no")).alias("rule_no"), F.coalesce("hits", F.lit(0)).alias("hits"))


def resolve_unique(df: DataFrame, text: str, rules: DataFrame, **how) -> DataFrame:
    """Like resolve_rules, but matched only where exactly one rule hits; with more, `ambiguous`. Excluded texts stay excluded.

    A bridge from other spellings of brands is given as synonyms, an exact age by age_col.
    """
    out = resolve_rules(df, text, rules, **how)
    one = F.col("hits") == 1
    status = F.when(F.col("status") == "excluded", "excluded").when(one, "matched").when(F.col("hits") > 1, "ambiguous").otherwise("unmatched")
    return out.select("text", status.alias("status"), F.when(one, F.col("id")).alias("id"), "hits")


def resolve_cascade(names: DataFrame, text: str, stages: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Each distinct text with the id of the first stage that has one, and the stage; stages are (name, table of text and id)."""
    found = None
    for i, (stage, table) in enumerate(stages):
        part = table.where("id is not null").select(F.col(text).alias("text"), F.struct(F.lit(i).alias("i"), F.lit(stage).alias("stage"), F.col("id").cast("string").alias("id")).alias("s"))
        found = part if found is None else found.unionByName(part)
    best = found.groupBy("text").agg(F.min("s").alias("s"))
    return names.select(F.col(text).alias("text")).distinct().join(best, "text", "left").select("text", F.col("s.id").alias("id"), F.coalesce("s.stage", F.lit("unmatched")).alias("stage"))


def guards_ok(a: Column, b: Column, flags: dict[str, Sequence[str]] | None = None, age_mode: str = "both", contain: bool = False) -> Column:
    """Whether two names may be one product: ages (equal if both have one, or strictly equal), model numbers and descriptor sets agree.

    contain: every token of either name must stand in the other too.
    """
    x, y = age(a, "max"), age(b, "max")
    same = (x.eqNullSafe(y) if age_mode == "strict" else F.coalesce(x == y, F.lit(True))) & (model_numbers(a) == model_numbers(b))
    if flags:
        same = same & (descriptor_set(a, flags) == descriptor_set(b, flags))
    if contain:
        same = same & F.forall(tokens(a), lambda t: F.contains(F.lower(b), t)) & F.forall(tokens(b), lambda t: F.contains(F.lower(a), t))
    return same


def match_contains(items: DataFrame, dim: DataFrame, item: str, name: str, block: str, tolerance: int = 20, price: str | None = None, editions: Names = ()) -> DataFrame:
    """Each distinct item with the dimension name that it contains: fewest extra characters, then lowest (unit) price, then name.

    Both sides have the block column; only equal blocks are compared, and of them what holds the name's first characters.
    A word of `editions` in the item alone makes it another product.
    """
    right = dim.where(F.col(name).isNotNull()).groupBy(F.col(name).alias("name"), block).agg(F.min(price if price else F.lit(0)).alias("price"))
    met = containing(items.select(F.col(item).alias("item"), block), "item", right, "name", [block])
    joined = met.join(right.withColumn("needle", F.lower("name")), [block, "needle"]).withColumn("extra", F.length("text") - F.length("name"))
    plain = lambda word: ~(F.contains(F.lower("text"), F.lit(word.lower())) & ~F.contains(F.col("needle"), F.lit(word.lower())))
    near = joined.where(F.col("extra") <= tolerance)
    for word in editions:
        near = near.where(plain(word))
    return near.groupBy(F.col("text").alias("item"), block).agg(F.min(F.struct("extra", "price", "name")).alias("b")).select("item", block, F.col("b.name").alias("name"), F.col("b.extra").alias("extra"))


def cross_rates(fx: DataFrame, quote: str, date: str = "date", currency: str = "currency", rate: str = "rate") -> DataFrame:
    """(date, currency, rate) in units of the quote for one unit of a currency, from rates for one unit of a third one.

    One row for each date and currency: of several rates the greatest counts, for the quote as for the others.
    """
    one = fx.groupBy(date, currency).agg(F.max(rate).alias(rate))
    to = one.where(F.col(currency) == quote).select(date, F.col(rate).alias("_to"))
    return one.join(to, date).select(date, currency, (F.col("_to") / F.when(F.col(rate) != 0, F.col(rate))).alias(rate))


def convert_asof(df: DataFrame, rates: DataFrame, amount: str, currency: str, date: str, base: str, max_age: int = 1) -> DataFrame:
    """df with converted, rate_date and warning: the amount by its currency's last rate at or before its date.

    warning says where that rate is more than max_age days old (`stale`), where the first one there is had to serve
    (`no rate yet`) and where there is none at all (`no rate`); the base itself converts to itself.
    """
    r = rates.select(F.col("currency").alias(currency), F.col("date").alias(date), F.struct(F.col("date").alias("d"), F.col("rate").alias("r")).alias("_rate"))
    first = r.groupBy(currency).agg(F.min("_rate").alias("_first"))
    out = asof_join(df, r, currency, date, "_rate", "_asof").join(bounded(first), currency, "left")
    own = F.col(currency) == base
    used = F.coalesce("_asof", "_first")
    late = F.datediff(F.col(date), F.col("_asof.d")) > max_age
    warning = F.when(own, None).when(used.isNull(), "no rate").when(F.col("_asof").isNull(), "no rate yet").when(late, "stale")
    return out.select(*df.columns, F.when(own, F.col(amount).cast("double")).otherwise(F.col(amount) * used["r"]).alias("converted"), F.when(~own, used["d"]).alias("rate_date"), warning.alias("warning"))


def asof_join(left: DataFrame, right: DataFrame, key: str, ts: str, value: str, out: str = "asof", most: int | None = scans.MOST) -> DataFrame:
    """left with right's last value at or before its own time: one shuffle on the key for both sides, no pairs are made.

    A key of more than `most` rows is scanned in parts of its time (None: keys aren't counted).
    """
    a = left.withColumn("_side", F.lit(1)).withColumn("_v", F.lit(None).cast(right.schema[value].dataType))
    b = right.groupBy(key, ts).agg(F.max(value).alias("_v")).withColumn("_side", F.lit(0))
    both = scans.last_so_far(a.unionByName(b, allowMissingColumns=True), [key], ts, ["_side"], "_v", out, most)
    return both.where("_side = 1").drop("_side", "_v")


def window_min_join(left: DataFrame, right: DataFrame, key: str, date: str, value: str, k: int, out: str = "window_min") -> DataFrame:
    """left with the least of right's values within (date, date + k] days: one shuffle, no pairs are made; null where the date is.

    A key's time is cut in slots of k days. A window reaches into the next slot at most, so right's days, one row each, lie in
    their own slot and in the one before, and no task needs more of a key than a slot.
    """
    day = F.unix_date(F.col(date).cast("date"))
    own = F.floor(day / k)
    r = right.where(F.col(date).isNotNull()).groupBy(key, date).agg(F.min(value).alias("_v")).withColumn("_slot", F.explode(F.array(own, own - 1)))
    both = left.withColumns({"_left": F.lit(True), "_slot": own}).unionByName(r, allowMissingColumns=True)
    ahead = Window.partitionBy(key, "_slot").orderBy(day).rangeBetween(1, k)
    return both.withColumn(out, F.when(F.col(date).isNotNull(), F.min("_v").over(ahead))).where("_left").drop("_left", "_slot", "_v")


class _Free:
    """Rows of one source that no anchor took, in order of volume: the nearest one to a volume, the first of equals."""

    def __init__(self):
        self.known: list[tuple[float, int, int]] = []
        self.unknown: list[tuple[int, int]] = []

    def add(self, volume: float, order: int, row: int) -> None:
        if volume != volume:
            insort(self.unknown, (order, row))
        else:
            insort(self.known, (volume, order, row))

    def remove(self, volume: float, order: int, row: int) -> None:
        own, entry = (self.unknown, (order, row)) if volume != volume else (self.known, (volume, order, row))
        own.pop(bisect_left(own, entry))

    def nearest(self, volume: float, tolerance: float) -> int | None:
        """Any is compatible with an unknown volume; an unknown one is further than all known ones in reach."""
        if volume != volume:
            return min([*((o, r) for _, o, r in self.known), *self.unknown[:1]], default=(0, None))[1]
        i, best = bisect_left(self.known, (volume,)), None
        if i < len(self.known):
            best = (self.known[i][0] - volume, *self.known[i][1:])
        if i:
            v = self.known[i - 1][0]
            _, order, row = self.known[bisect_left(self.known, (v,))]
            best = min(best or (float("inf"), 0, 0), (volume - v, order, row))
        if best and best[0] <= tolerance:
            return best[2]
        return self.unknown[0][1] if self.unknown else None


def _matched(k1: Sequence, volume: Sequence, source: Sequence, order: Sequence, anchor: str, tolerance: float) -> list[int | None]:
    """Of rows in order, the anchor's order that each is matched to."""
    free: dict[str, _Free] = {}
    exact: dict[tuple, _Free] = {}
    for i, s in enumerate(source):
        free.setdefault(s, _Free()).add(volume[i], order[i], i)
        exact.setdefault((s, k1[i]), _Free()).add(volume[i], order[i], i)

    def take(i: int) -> None:
        free[source[i]].remove(volume[i], order[i], i)
        exact[source[i], k1[i]].remove(volume[i], order[i], i)

    ids: list[int | None] = [None] * len(source)
    used, sources = set(), sorted(free)
    for head in [anchor, *(s for s in sources if s != anchor)]:
        for i in (i for i, s in enumerate(source) if s == head):
            if i in used:
                continue
            near = []
            for other in (s for s in sources if s != head):
                same = exact.get((other, k1[i]))
                j = same.nearest(volume[i], tolerance) if same else None
                j = free[other].nearest(volume[i], tolerance) if j is None else j
                if j is not None:
                    near.append(j)
            for j in (i, *near) if near else ():
                used.add(j)
                take(j)
                ids[j] = int(order[i])
    return ids


def match_catalogues(rows: DataFrame, source: str, anchor: str, k1: str, k2: str, volume: str, order: str, volume_tolerance: int = 0) -> DataFrame:
    """Rows of several catalogues matched to the anchor's, one of each source at most: columns of rows, and match_id.

    Anchors go in order; each takes from every other source the nearest volume among rows of its exact key k1, else of
    its rewritten key k2, which no anchor took before. Anchors left alone and the other sources' leftovers are matched among
    themselves by k2. An unknown volume goes with any, after the known ones in reach. Greedy and sequential, so it runs
    inside each block: of k2, which k1 determines, and of volumes that steps within the tolerance join, as nothing
    matches across a wider gap; unknown volumes keep their key in one block.
    """
    schema = StructType([*rows.schema.fields, StructField("match_id", LongType())])
    names = rows.columns
    sizes = rows.groupBy(k2, volume).agg(F.count("*").alias("_c"))
    gap = F.col(volume) - F.lag(volume).over(Window.partitionBy(k2).orderBy(F.col(volume).asc_nulls_first())) > volume_tolerance
    whole = F.max(F.col(volume).isNull()).over(Window.partitionBy(k2))
    steps = F.sum(F.when(gap, 1).otherwise(0)).over(Window.partitionBy(k2).orderBy(F.col(volume).asc_nulls_first()))
    blocks = sizes.withColumn("_gap", gap).withColumn("_block", F.when(whole, 0).otherwise(steps)).select(F.col(k2).alias("_k2"), F.col(volume).alias("_v"), "_block")
    keyed = rows.join(blocks, F.col(k2).eqNullSafe(F.col("_k2")) & F.col(volume).eqNullSafe(F.col("_v"))).drop("_k2", "_v")

    def run(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values([order, source], kind="stable").reset_index(drop=True)
        ids = _matched(block[k1].tolist(), block[volume].astype("float64").tolist(), block[source].tolist(), block[order].tolist(), anchor, volume_tolerance)
        return block.assign(match_id=pd.array(ids, dtype="Int64"))[[*names, "match_id"]]

    return keyed.groupBy(k2, "_block").applyInPandas(run, schema)


def match_tokens(queries: DataFrame, listings: DataFrame, query: str, listing: str, price: str, stop: Names = (), product: str | None = None) -> DataFrame:
    """Each distinct query with the cheapest listing of those that hold all its tokens with the fewest extra ones.

    Candidates share the query's rarest token, counted over all listings, so nothing is compared with everything; a query with a token
    that no listing has meets none. Listings are counted by text first, so copies meet a query once. label is exact without extra
    tokens, else near; tier and pool count the listings as good as the best, and all that match. With product, siblings
    counts the listings of the chosen one's product, and sibling_high is the dearest of them. Only queries are ever broadcast, after they
    were counted: a table of many alike listings is small as a file, which is all that Spark's own choice goes by.
    """
    none = F.array(*(F.lit(s) for s in stop)).cast("array<string>")
    q = queries.select(F.col(query).alias("query")).where("query is not null").distinct().withColumn("_q", F.array_except(tokens("query"), none)).where(F.size("_q") > 0)
    own = [F.col(product).alias("product")] if product else []
    one = listings.select(F.col(listing).alias("listing"), F.col(price).alias("price"), *own).where("listing is not null")
    one = one.groupBy("listing").agg(F.min(F.struct("price", *(["product"] if product else []))).alias("_b"), F.count("*").alias("_n")).withColumn("_l", F.array_distinct(F.array_except(tokens("listing"), none)))
    held = one.select(F.explode("_l").alias("_t")).groupBy("_t").agg(F.count("*").alias("_n"))
    each = q.withColumn("_t", F.explode("_q")).join(held.hint("merge"), "_t", "left").groupBy("query").agg(F.first("_q").alias("_q"), F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), "_t")).alias("_r"))
    asked = each.where("_r.n > 0").select("query", "_q", F.col("_r._t").alias("_t"))
    asked = F.broadcast(asked) if q.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else asked
    pairs = asked.join(one.withColumn("_t", F.explode("_l")).hint("merge"), "_t").where(F.size(F.array_except("_q", "_l")) == 0)
    pairs = pairs.withColumn("extra", F.size("_l") - F.size(F.array_distinct("_q")))
    tiers = pairs.groupBy("query", "extra").agg(F.min(F.struct("_b.price", "listing", *(["_b.product"] if product else []))).alias("b"), F.sum("_n").alias("tier"))
    best = tiers.groupBy("query").agg(F.min(F.struct("extra", "b", "tier")).alias("x"), F.sum("tier").alias("pool"))
    out = best.select("query", F.col("x.b.listing").alias("listing"), F.col("x.b.price").alias("price"), F.col("x.extra").alias("extra"), F.when(F.col("x.extra") == 0, "exact").otherwise("near").alias("label"), F.col("x.tier").alias("tier"), "pool", *([F.col("x.b.product").alias("product")] if product else []))
    if not product:
        return out
    same = listings.groupBy(F.col(product).alias("product")).agg(F.count("*").alias("siblings"), F.max(price).alias("sibling_high"))
    return out.join(same.hint("merge"), "product", "left")


def could_reach(a: str, b: str, least: float) -> Column:
    """False only where two texts can't be so similar: 2 M / T is at most twice the characters they share over all of theirs."""
    both = F.length(a) + F.length(b)
    count = lambda s, c: F.length(s) - F.length(F.replace(F.col(s), c, F.lit("")))
    shared = F.aggregate(F.array_distinct(F.split(a, "")), F.lit(0), lambda n, c: n + F.when(c == "", 0).otherwise(F.least(count(a, c), count(b, c))))
    return F.when(2 * F.least(F.length(a), F.length(b)) < least * both, False).otherwise(2 * shared >= least * both)


def match_fuzzy(
    names: DataFrame,
    dim: DataFrame,
    name: str,
    canonical: str,
    ident: str,
    brand: str,
    edition: str,
    block: str,
    fixes: Sequence[tuple[str, str]] = (),
    aliases: DataFrame | None = None,
    least: float = 0.62,
    short: float = 0.6,
    sub_least: float = 0.34,
    margin: float = 0.10,
    alias_least: float = 0.85,
    alias_margin: float = 0.08,
) -> DataFrame:
    """Each distinct misread name with the id that it most likely means: (name, block, id, info, ratio); where none does, info says why.

    Curated fixes are applied first. What stands before the age is held against the block's brands: the most similar one must
    reach `least`, and the name's part must not be a fragment of it. Then only products of that brand and of the very same
    age count. One is taken; of several, without further words in the name the plainest edition, else the one
    whose edition is most like those words, if it reaches sub_least and leads by the margin. What fails is looked up among
    the aliases (block, alias, id), exactly or by a similarity of alias_least with alias_margin, at the same age.
    info: brand, base, edition, alias exact, alias fuzzy; or low brand, fragment, age, ambiguous.
    """
    squash = lambda c: F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]", "")
    bare = lambda c: F.regexp_replace(c, VOLUME_PATTERN, " ")
    left = names.select(F.col(name).alias("name"), block).where("name is not null").distinct().withColumn("fixed", rewrite("name", fixes))
    left = left.withColumn("_age", age("fixed", "max")).withColumn("part", squash(bare(F.regexp_extract("fixed", rf"^(.*?)(?:{AGE_PATTERN.removeprefix('(?i)')}.*)?$", 1))))
    left = left.withColumn("rest", F.replace(squash(bare(F.regexp_replace("fixed", AGE_PATTERN, " "))), F.col("part"), F.lit("")))
    goods = dim.select(F.col(canonical).alias("canonical"), F.col(ident).alias("id"), squash(F.col(brand)).alias("brand"), squash(F.coalesce(F.col(edition), F.lit(""))).alias("extra"), block).distinct().withColumn("_of", age("canonical", "max"))

    pairs = left.join(goods.select("brand", block).distinct(), block).where(could_reach("part", "brand", least)).withColumn("ratio", seq_ratio("part", "brand"))
    top = pairs.where(F.col("ratio") >= least).groupBy("name", block).agg(F.max(F.struct("ratio", "brand")).alias("b"))
    own = left.join(top, ["name", block], "left").withColumn("brand", F.col("b.brand")).withColumn("whole", F.length("part") >= short * F.length("brand"))
    cands = own.where("whole").join(goods, [block, "brand"]).where(F.col("_age").eqNullSafe(F.col("_of"))).select("name", block, "rest", "id", "extra", F.col("b.ratio").alias("brand_ratio"))
    counted = cands.withColumn("_n", F.count("*").over(Window.partitionBy("name", block))).withColumn("sub", F.when((F.col("_n") > 1) & (F.col("rest") != ""), seq_ratio("rest", "extra")))
    order = Window.partitionBy("name", block).orderBy(F.col("sub").desc_nulls_last(), F.when(F.col("rest") == "", F.length("extra")), F.col("id").desc())
    ranked = counted.withColumn("_k", F.row_number().over(order)).withColumn("_second", F.lead("sub").over(order)).where("_k = 1")
    clear = (F.col("sub") >= sub_least) & (F.col("sub") - F.coalesce("_second", F.lit(0.0)) >= margin)
    how = F.when(F.col("_n") == 1, "brand").when(F.col("rest") == "", "base").when(clear, "edition").otherwise("ambiguous")
    found = ranked.select("name", block, how.alias("_how"), "id", F.when(how == "edition", F.col("sub")).otherwise(F.col("brand_ratio")).alias("_r"))
    why = F.when(F.col("b").isNull(), "low brand").when(~F.col("whole"), "fragment").when(F.col("_how").isNull(), "age").otherwise(F.col("_how"))
    out = own.join(found, ["name", block], "left").withColumn("info", why)
    out = out.select("name", block, "fixed", "_age", F.when(F.col("info") != "ambiguous", F.col("id")).alias("id"), "info", F.when(F.col("info") != "ambiguous", F.col("_r")).alias("ratio"))
    if aliases is not None:
        known = aliases.select(block, squash(bare(F.col("alias"))).alias("alias"), F.col("id").alias("alias_id"), age("alias", "max").alias("_a")).where(F.length("alias") >= 4).distinct()
        lost = out.where("id is null").select("name", block, squash(bare(F.col("fixed"))).alias("key"), "_age").where(F.length("key") >= 4)
        single = known.groupBy(block, F.col("alias").alias("key")).agg(F.count_distinct("alias_id").alias("_c"), F.min("alias_id").alias("_exact")).where("_c = 1")
        exact = lost.join(single, [block, "key"]).select("name", block, "_exact")
        tried = lost.join(known, block).where(F.col("_age").eqNullSafe(F.col("_a"))).where(could_reach("key", "alias", alias_least - alias_margin)).withColumn("r", seq_ratio("key", "alias"))
        best = Window.partitionBy("name", block).orderBy(F.col("r").desc(), "alias", "alias_id")
        fuzzy = tried.withColumn("_k", F.row_number().over(best)).withColumn("_next", F.lead("r").over(best)).where("_k = 1")
        fuzzy = fuzzy.where((F.col("r") >= alias_least) & (F.col("r") - F.coalesce("_next", F.lit(0.0)) >= alias_margin)).select("name", block, F.col("alias_id").alias("_fuzzy"), F.col("r").alias("_fr"))
        out = out.join(exact, ["name", block], "left").join(fuzzy, ["name", block], "left")
        out = out.withColumn("info", F.when(F.col("_exact").isNotNull(), "alias exact").when(F.col("_fuzzy").isNotNull(), "alias fuzzy").otherwise(F.col("info")))
        out = out.withColumn("ratio", F.coalesce("ratio", F.when(F.col("_exact").isNotNull(), 1.0).otherwise(F.col("_fr")))).withColumn("id", F.coalesce("id", "_exact", "_fuzzy"))
    return out.select("name", block, "id", "info", F.round("ratio", 6).alias("ratio"))


def match_brand_age(items: DataFrame, offers: DataFrame, item: str, offer: str, price: str, volume: str, brands: DataFrame, exclude: str | None = None, least_volume: int = 500) -> DataFrame:
    """Per item: offers of the same brand token and age of at least that volume, and their unit prices' low, median and high.

    brands: one column token. Offers are counted once by (token, age, unit price); an item asks for a union of such groups, and
    items that ask for the same one share its statistics, taken over the counts: no item meets a single offer, and no group is one
    task's. An offer counts once for each token that it shares with the item. The counts of the unions are written to
    spark.checkpoint.dir when the plan is made.
    """
    def tagged(df: DataFrame, c: str) -> DataFrame:
        return df.withColumn("token", F.explode(F.array_distinct(tokens(c)))).join(bounded(brands.select("token").distinct()), "token").withColumn("_age", F.coalesce(age(c, "max"), F.lit(-1)))

    asked = tagged(items.select(F.col(item).alias("item")).distinct(), "item").groupBy("item", "_age").agg(F.array_sort(F.collect_set("token")).alias("_set"))
    right = offers.select(F.col(offer).alias("offer"), F.col(price).alias("_p"), F.col(volume).alias("_v")).where(F.col("_v") >= least_volume)
    if exclude:
        right = right.where(~F.lower("offer").rlike(exclude))
    groups = tagged(right, "offer").withColumn("unit", F.col("_p") * 100.0 / F.col("_v")).groupBy("token", "_age", "unit").agg(F.count("*").alias("_c"))
    unions = asked.select("_age", "_set").distinct().withColumn("token", F.explode("_set")).join(groups, ["token", "_age"])
    counts = settled(unions.groupBy("_age", "_set", "unit").agg(F.sum("_c").alias("n")))
    ends = {"low": F.lit(0), "median": (F.col("total") - 1) * 0.5, "high": F.col("total") - 1}
    stats = ranking.at_places(ranking.running_over(counts, ["_age", "_set"], "unit"), ["_age", "_set"], "unit", ends)
    known = counts.groupBy("_age", "_set").agg(F.sum("n").alias("offers")).join(stats, ["_age", "_set"], "left")
    return asked.join(known, ["_age", "_set"]).select("item", "offers", *(F.round(c, 4).alias(c) for c in ends))


def match_registry(places: DataFrame, registry: DataFrame, name: str, locality: str, lat: str, lng: str, radius: float = 150.0, prefix: int = 2) -> DataFrame:
    """places with registered: a registry row has an equal name, or one starts with the other, in the same or no locality, or within the radius."""
    key = lambda c: F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]", "")
    p = places.withColumn("_n", key(F.col(name))).withColumn("_b", F.substring("_n", 1, prefix))
    r = registry.select(key(F.col(name)).alias("_m"), F.col(locality).alias("_loc"), F.col(lat).alias("_lat"), F.col(lng).alias("_lng")).where(F.length("_m") >= prefix).withColumn("_of", F.substring("_m", 1, prefix))
    named = F.startswith("_n", "_m") | F.startswith("_m", "_n")
    near = F.coalesce(F.col(locality) == F.col("_loc"), F.lit(True)) | F.coalesce(haversine_m(lat, lng, "_lat", "_lng") <= radius, F.lit(False))
    met = (F.col("_b") == F.col("_of")) & named & near
    # Every place falls on one side of the same condition, so no row needs a number.
    sides = [p.join(r, met, how).drop("_n", "_b").withColumn("registered", F.lit(how == "left_semi")) for how in ("left_semi", "left_anti")]
    return sides[0].unionByName(sides[1])


def _globe(lat: Column, lng: Column, metres: float) -> list[Column]:
    """The cell of a place in a grid of so many metres through the globe: three coordinates on the sphere, so there are no poles and no date line."""
    la, lo = F.radians(lat), F.radians(lng)
    axes = (F.cos(la) * F.cos(lo), F.cos(la) * F.sin(lo), F.sin(la))
    return [F.floor(a * (EARTH_M / metres)).cast("long") for a in axes]


_CELL = ["_cx", "_cy", "_cz"]


def within_radius(points: DataFrame, centres: DataFrame, radius: float, lat: str = "lat", lng: str = "lng", centre: str = "centre") -> DataFrame:
    """Pairs of points and centres within so many metres, anywhere on the globe, joined by grid cell.

    centres: centre, lat, lng. The straight line between two places is no longer than the way over the surface, so with cells
    a little wider than the radius every near pair lies in neighbouring cells. Places without coordinates are near nothing.
    """
    wide = radius * 1.001 + 0.01
    p = points.withColumns(dict(zip(_CELL, _globe(F.col(lat), F.col(lng), wide), strict=True)))
    c = centres.select(F.col(centre), F.col(lat).alias("_lat"), F.col(lng).alias("_lng"))
    around = F.array(*(F.struct(*(F.lit(d).alias(n) for d, n in zip(step, _CELL, strict=True))) for step in product((-1, 0, 1), repeat=3)))
    own = dict(zip(_CELL, _globe(F.col("_lat"), F.col("_lng"), wide), strict=True))
    c = c.withColumn("_step", F.explode(around)).select(centre, "_lat", "_lng", *((own[n] + F.col(f"_step.{n}")).alias(n) for n in _CELL))
    near = p.join(c, _CELL).withColumn("metres", haversine_m(lat, lng, "_lat", "_lng")).where(F.col("metres") <= radius)
    return near.drop(*_CELL, "_lat", "_lng").withColumn("walk_min", F.round(F.col("metres") / 67).cast("int"))


def nearest_places(points: DataFrame, centres: DataFrame, k: int, ident: str, start: float = 500.0, lat: str = "lat", lng: str = "lng", centre: str = "centre") -> DataFrame:
    """The k nearest points of each centre, equals by ident: columns of within_radius and rank; all points where there are no more.

    Rings grow fourfold from `start` metres for centres that don't have k points within reach yet, so dense regions
    never meet wide rings. Each ring is a join of cells and one action.
    """
    order = Window.partitionBy(centre).orderBy("metres", ident)
    there = points.where(F.col(lat).isNotNull() & F.col(lng).isNotNull())
    asked, radius, found = centres.where(F.col(lat).isNotNull() & F.col(lng).isNotNull()), start, None
    while True:
        near = within_radius(there, asked, radius, lat, lng, centre).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        last = radius > math.pi * EARTH_M
        full = None if last else settled(near.where(F.col("rank") == k).select(centre))
        done = near if last else near.join(full, centre, "left_semi")
        found = done if found is None else found.unionByName(done)
        if last:
            return found
        asked = settled(asked.join(full, centre, "left_anti"))
        if asked.isEmpty():
            return found
        radius *= 4


def compare_curated(a: DataFrame, b: DataFrame, spec: DataFrame, name_a: str, name_b: str, price: str) -> DataFrame:
    """Per line of spec (label, part, pattern): the least price in a of names that hold the part, in b of names the pattern matches; both must exist."""
    s = bounded(spec)
    x = a.join(s, F.contains(F.col(name_a), F.col("part"))).groupBy("label").agg(F.min(price).alias("price_a"))
    y = b.join(s, F.expr(f"{name_b} rlike pattern")).groupBy("label").agg(F.min(price).alias("price_b"))
    return x.join(y, "label").withColumn("diff", F.col("price_b") - F.col("price_a"))


def key_sets_by(df: DataFrame, ident: str, key: str) -> DataFrame:
    """Per id its distinct keys in order."""
    return df.groupBy(ident).agg(F.array_join(F.array_sort(F.collect_set(key)), "|").alias("keys"))


def lookup_unambiguous(df: DataFrame, dim: DataFrame, k1: str, k2: str, value: str) -> DataFrame:
    """df with dim's value by the exact key k1, else by k2 where all of dim's rows of it agree on one value; and by which."""
    exact = dim.groupBy(k1).agg(F.min(value).alias("_a"))
    loose = dim.groupBy(k2).agg(F.count_distinct(value).alias("_n"), F.min(value).alias("_b")).where("_n = 1").drop("_n")
    out = df.join(exact, k1, "left").join(loose, k2, "left")
    return out.withColumn(value, F.coalesce("_a", "_b")).withColumn("via", F.when(F.col("_a").isNotNull(), "exact").when(F.col("_b").isNotNull(), "loose")).drop("_a", "_b")


def nearest_join(left: DataFrame, right: DataFrame, key: str, ts: str, value: str, limit: float) -> DataFrame:
    """left (with columns key and ts, seconds) with right's value nearest in time within the limit; of equals the earlier."""
    r = right.select(key, F.col(ts).alias("_t"), F.col(value).alias("_v"))
    ids = left.select(key, ts).distinct()
    slot = lambda c: F.floor(F.col(c) / limit).cast("long")
    probe = ids.withColumn("_s", F.explode(F.array(slot(ts) - 1, slot(ts), slot(ts) + 1)))
    near = probe.join(r.withColumn("_s", slot("_t")), [key, "_s"]).withColumn("distance", F.abs(F.col("_t") - F.col(ts))).where(F.col("distance") <= limit)
    best = near.groupBy(key, ts).agg(F.min(F.struct("distance", "_t", "_v")).alias("b"))
    return left.join(best, [key, ts], "left").withColumn(value, F.col("b._v")).withColumn("distance", F.col("b.distance")).drop("b")


def pair_boxes(names: DataFrame, prices: DataFrame, frame: str, max_gap: float, max_dx: float) -> DataFrame:
    """Each price box (frame, box, text, x, y) with the nearest name box above it in its frame, within the gap and sideways tolerance."""
    n = names.select(frame, F.col("text").alias("name"), F.col("x").alias("_x"), F.col("y").alias("_y"))
    p = prices.select(frame, "box", F.col("text").alias("price"), "x", "y")
    near = p.join(n, frame).where((F.col("_y") < F.col("y")) & (F.col("y") - F.col("_y") <= max_gap) & (F.abs(F.col("x") - F.col("_x")) <= max_dx))
    best = near.groupBy(frame, "box", "price").agg(F.min(F.struct((F.col("y") - F.col("_y")).alias("gap"), "name")).alias("b"))
    return p.select(frame, "box", "price").join(best, [frame, "box", "price"], "left").select(frame, "box", "price", F.col("b.name").alias("name"), F.col("b.gap").alias("gap"))


def suggest_canonical(unmatched: DataFrame, dim: DataFrame, name: str, canonical: str, block: str, sure: float = 0.85, maybe: float = 0.62) -> DataFrame:
    """Each distinct unmatched name with its most similar canonical one of the block and a class: alias, candidate (same age) or new.

    Names that can't reach `maybe` by their letters aren't compared further; without any that does, a name is new and has no canonical one.
    """
    left = unmatched.select(F.col(name).alias("name"), block).where("name is not null").distinct()
    pairs = left.join(dim.select(F.col(canonical).alias("canonical"), block).distinct(), block).where(could_reach("name", "canonical", maybe))
    scored = pairs.withColumn("ratio", seq_ratio("name", "canonical")).where(F.col("ratio") >= maybe)
    best = scored.groupBy("name", block).agg(F.max(F.struct("ratio", "canonical")).alias("b"))
    same = age("name", "max").eqNullSafe(age("canonical", "max"))
    out = left.join(best, ["name", block], "left").select("name", block, F.col("b.canonical").alias("canonical"), F.round("b.ratio", 6).alias("ratio"))
    kind = F.when((F.col("ratio") >= sure) & same, "alias").when((F.col("ratio") >= maybe) & same, "candidate").otherwise("new")
    return out.withColumn("kind", kind)
