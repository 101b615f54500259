"""Similar names without a block key: an index on pairs of letters whose bound is proved for the ratio, and what is mined with it."""

from __future__ import annotations

from collections.abc import Sequence
from math import floor

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyvane.functions.similarity import seq_ratio
from tallyvane.functions.text import age
from tallyvane.operators.lineage import settled

#: Below this similarity long names needn't share a pair of letters (from two thirds down none is guaranteed at any length).
LEAST = 0.7


def _pairs(names: DataFrame, c: str) -> DataFrame:
    """Rows (c, gram, n): the pairs of neighbouring letters of each name, and how often it has them."""
    grams = F.transform(F.sequence(F.lit(1), F.length(c) - 1), lambda i: F.substring(F.col(c), i, F.lit(2)))
    return names.where(F.length(c) > 1).select(c, F.explode(grams).alias("gram")).groupBy(c, "gram").agg(F.count("*").alias("n"))


def _rarest(pairs: DataFrame, c: str, seen: DataFrame, least: float) -> DataFrame:
    """Of each name the rarest pairs, as many as one must be among that it shares with any name so similar."""
    gain = 1.5 * least - 1
    sure = F.greatest(F.lit(1), F.ceil(gain * 2 * F.length(c) / (2 - least) - 1 - 1e-6))
    before = Window.partitionBy(c).orderBy("_seen", "gram").rowsBetween(Window.unboundedPreceding, -1)
    ranked = pairs.join(seen, "gram").withColumn("_before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    return ranked.where(F.col("_before") < F.length(c) - 1 - sure + 1).select(c, "gram")


def _marks(c: str, width: int) -> Column:
    """Runs of so many neighbouring letters of a name, each with how often it came before: equal marks of two names are what their bags share."""
    runs = F.array_sort(F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - width + 1, F.lit(1))), lambda i: F.substring(F.col(c), i, F.lit(width))))
    return F.transform(runs, lambda x, i: F.concat(x, (i - F.array_position(runs, x)).cast("string")))


def _candidates(left: DataFrame, right: DataFrame, a: str, b: str, least: float) -> DataFrame:
    """Rows (a, b, bound): all pairs that may be so similar, and what their letters allow at most."""
    if least < LEAST:
        raise ValueError(f"an index on pairs of letters needs a similarity of {LEAST} or more")
    if a == b:
        raise ValueError("the two sides' names need different columns")
    x, y = (df.select(c).where(F.length(c) > 0).distinct() for df, c in ((left, a), (right, b)))
    grams = [_pairs(x, a), _pairs(y, b)]
    seen = grams[0].select("gram", "n").unionByName(grams[1].select("gram", "n")).groupBy("gram").agg(F.sum("n").alias("_seen"))
    near = _rarest(grams[0], a, seen, least).join(_rarest(grams[1], b, seen, least), "gram").select(a, b)
    short = floor(1 / (1.5 * least - 1) + 1e-6)
    letters = lambda df, c: df.where(F.length(c) < short).select(c, F.explode(F.array_distinct(F.split(c, ""))).alias("letter")).where("letter <> ''")
    few = letters(x, a).join(letters(y, b), "letter").where(F.length(a) + F.length(b) <= short).select(a, b)
    both = F.length(a) + F.length(b)
    fit = 2 * F.least(F.length(a), F.length(b)) >= least * both - 1e-6
    met = near.where(fit).unionByName(few.where(fit)).distinct()
    for df, c, side in ((x, a, "x"), (y, b, "y")):
        met = met.join(df.select(c, _marks(c, 1).alias(f"_{side}1"), _marks(c, 2).alias(f"_{side}2")), c)
    shared = lambda width: F.size(F.array_intersect(f"_x{width}", f"_y{width}"))
    met = met.where(shared(2) >= 3 * F.ceil(least * both / 2 - 1e-6) - both - 1)
    return met.select(a, b, (2.0 * shared(1) / both).alias("bound")).where(F.col("bound") >= least)


def similar_pairs(left: DataFrame, right: DataFrame, a: str, b: str, least: float) -> DataFrame:
    """Rows (a, b, ratio) of all distinct names of both sides whose ratio is `least`, from 0.7, or more. An empty or null name is similar to none.

    A ratio r of two names with T letters means M >= r T / 2 letters in matching blocks. Two blocks that follow each other have an
    unmatched letter between them in one name at least, so there are at most T - 2 M + 1 blocks, and at least 3 M - T - 1 pairs of
    neighbouring letters lie inside blocks: both names have these. That is at least one where T is over 1 / (1.5 r - 1). Names meet in
    the rarest pairs that this leaves possible; shorter ones, which bound their number, meet in single letters. Of those that meet, the shared
    pairs are counted, then the shared letters, and only what passes both gets its ratio.
    """
    return _candidates(left, right, a, b, least).select(a, b, seq_ratio(a, b).alias("ratio")).where(F.col("ratio") >= least)


def most_similar(left: DataFrame, right: DataFrame, a: str, b: str, least: float) -> DataFrame:
    """Of similar_pairs() the first of each name a: the greatest ratio, of equals the least b.

    The ratio of the candidate that letters speak most for comes first; only those whose letters allow as much get theirs after it. The
    candidates are written to spark.checkpoint.dir when the plan is made.
    """
    met = settled(_candidates(left, right, a, b, least))
    tried = met.groupBy(a).agg(F.max_by(b, F.struct("bound", b)).alias(b)).select(a, seq_ratio(a, b).alias("_most"))
    ratios = met.join(tried, a).where(F.col("bound") >= F.col("_most")).select(a, b, seq_ratio(a, b).alias("ratio")).where(F.col("ratio") >= least)
    first = ratios.groupBy(a).agg(F.min(F.struct((-F.col("ratio")).alias("r"), b)).alias("_b"))
    return first.select(a, F.col(f"_b.{b}").alias(b), (-F.col("_b.r")).alias("ratio"))


def mine_candidates(
    unmatched: DataFrame,
    dim: DataFrame,
    key: str,
    raw: str,
    price: str,
    source: str,
    canonical: str,
    ident: str,
    noise: Column | None = None,
    sure: float = 0.85,
    near: float = 0.72,
    often: int = 2,
) -> DataFrame:
    """Unmatched rows by normalised name (key): what each is most likely, for someone to decide.

    spelling is the commonest raw name, of equals the longest, then the least; seen, variants, low and high (of prices over zero) and
    sources are counts and lists of the group. nearest and nearest_id are the canonical name most like the key, from a similarity of `near`
    up (below it none is named; of equals the least), with its ratio. kind: noise (a condition on the columns key and spelling); synonym from
    `sure` up at the same age; new from `sure` up at another age, and below `near`; else review. confidence: high for a synonym,
    and for a new one that was seen `often`; medium for other new ones; else low. Rows with a null key count nowhere.
    """
    rows = unmatched.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.col(raw).alias("raw"), F.col(price).alias("p"), F.col(source).alias("s"))
    spelled = rows.groupBy("key", "raw").agg(F.count("*").alias("n"), F.min(F.when(F.col("p") > 0, F.col("p"))).alias("lo"), F.max(F.when(F.col("p") > 0, F.col("p"))).alias("hi"))
    best = F.min(F.when(F.col("raw").isNotNull(), F.struct((-F.col("n")).alias("n"), (-F.length("raw")).alias("l"), "raw")))["raw"]
    groups = spelled.groupBy("key").agg(best.alias("spelling"), F.sum("n").alias("seen"), F.count("raw").alias("variants"), F.min("lo").alias("low"), F.max("hi").alias("high"))
    whence = rows.select("key", "s").distinct().groupBy("key").agg(F.array_join(F.array_sort(F.collect_list("s")), ";").alias("sources"))
    goods = dim.where(F.col(canonical).isNotNull()).groupBy(F.col(canonical).alias("nearest")).agg(F.min(ident).alias("nearest_id"))
    first = most_similar(groups, goods, "key", "nearest", near).join(goods, "nearest")
    out = groups.join(whence, "key").join(first, "key", "left")
    same = age("key", "max").eqNullSafe(age("nearest", "max"))
    like = F.coalesce("ratio", F.lit(0.0))
    kind = F.when(F.coalesce(noise, F.lit(False)) if noise is not None else F.lit(False), "noise").when((like >= sure) & same, "synonym").when(like >= sure, "new").when(like >= near, "review").otherwise("new")
    sureness = F.when(F.col("kind") == "synonym", "high").when(F.col("kind") == "new", F.when(F.col("seen") >= often, "high").otherwise("medium")).otherwise("low")
    out = out.withColumn("kind", kind).withColumn("confidence", sureness)
    return out.select("key", "spelling", "seen", "variants", "low", "high", "sources", age("key", "max").alias("age"), "nearest_id", "nearest", F.round("ratio", 6).alias("ratio"), "kind", "confidence")


def compare_matched(rows: DataFrame, match: str, source: str, price: str, volume: str, sources: Sequence[str]) -> DataFrame:
    """Per match of catalogues that two sources or more have: each one's price of 100 units of volume, the cheapest (ties listed), spread and its percent, and who wins of each two.

    rows: as match_catalogues() gives them. A row without price or volume doesn't count; without a match it is in no group.
    """
    unit = F.col(price) * 100.0 / F.when(F.col(volume) > 0, F.col(volume))
    units = rows.where(F.col(match).isNotNull()).groupBy(match).agg(*(F.min(F.when(F.col(source) == s, unit)).alias(f"unit_{s}") for s in sources))
    at = [F.col(f"unit_{s}") for s in sources]
    n = sum((c.isNotNull().cast("int") for c in at), F.lit(0))
    low, high = F.least(*at), F.greatest(*at)
    wins = {f"{s}_{t}": F.when(x < y, s).when(y < x, t).when(x == y, "tie") for i, (s, x) in enumerate(zip(sources, at, strict=True)) for t, y in list(zip(sources, at, strict=True))[i + 1 :]}
    out = units.withColumn("n", n).where("n >= 2").withColumn("cheapest", F.concat_ws("/", *(F.when(c == low, s) for s, c in zip(sources, at, strict=True))))
    return out.select(match, "n", *(F.round(c, 4).alias(f"unit_{s}") for s, c in zip(sources, at, strict=True)), "cheapest", F.round(high - low, 4).alias("spread"), F.round((high - low) * 100.0 / F.when(high > 0, high), 2).alias("spread_pct"), *(c.alias(k) for k, c in wins.items()))
