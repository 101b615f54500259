"""Keyword classification as expressions: first match, precedence, tiers and ladders."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyvane.functions.text import _quoted, col, matches_any

Rules = Sequence[tuple[str, Sequence[str]]]


def _hit(text: Column, words: Sequence[str]) -> Column:
    return matches_any(text, *(_quoted(w) for w in words))


def classify_first(c: Column | str, rules: Rules, fallback: str, primary_sep: str | None = None) -> Column:
    """Name of the first rule of which a word stands in the text: first in the part before primary_sep, then in all of it."""
    text = F.lower(col(c))

    def chain(part: Column) -> Column:
        out = F.lit(None).cast("string")
        for name, words in reversed(rules):
            out = F.when(_hit(part, words), F.lit(name)).otherwise(out)
        return out

    whole = chain(text)
    if primary_sep:
        whole = F.coalesce(chain(F.substring_index(text, primary_sep, 1)), whole)
    return F.coalesce(whole, F.lit(fallback))


def classify_precedence(tokens: Column | str, rules: Rules, overrides: Mapping[tuple[str, str], str] | None = None, fallback: str = "other") -> Column:
    """Struct (label, hits, unmatched) of an array of tokens: the first rule with a hit, unless two hit rules override to a third."""
    words = col(tokens)

    def among(keys: Sequence[str]) -> Column:
        return F.filter(words, lambda w: _hit(w, keys))

    hits = {name: among(keys) for name, keys in rules}
    label = F.lit(fallback)
    for name, _ in reversed(rules):
        label = F.when(F.size(hits[name]) > 0, F.lit(name)).otherwise(label)
    for (a, b), to in (overrides or {}).items():
        label = F.when((F.size(hits[a]) > 0) & (F.size(hits[b]) > 0), F.lit(to)).otherwise(label)
    matched = F.flatten(F.array(*hits.values()))
    return F.struct(label.alias("label"), F.array_distinct(matched).alias("hits"), F.array_except(words, matched).alias("unmatched"))


def classify_tiers(c: Column | str, tiers: Rules, masks: Sequence[str] = ()) -> Column:
    """Struct (tier, reason): masked phrases are taken out first; the first tier that hits, with all its words that do."""
    text = F.lower(col(c))
    for phrase in masks:
        text = F.replace(text, F.lit(phrase.lower()), F.lit(" "))
    tier, reason = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, words in reversed(tiers):
        found = F.concat_ws("; ", *(F.when(F.contains(text, F.lit(w.lower())), F.lit(w)) for w in words))
        tier = F.when(found != "", F.lit(name)).otherwise(tier)
        reason = F.when(found != "", found).otherwise(reason)
    return F.struct(tier.alias("tier"), reason.alias("reason"))


def classify_signal(c: Column | str, explicit: Sequence[str], strong: Sequence[str], weak: Sequence[str], noise: Sequence[str], exclude: Sequence[str]) -> Column:
    """`excluded`, `explicit`, `strong`, `weak` (unless a noise word stands there too) or `none`."""
    text = F.lower(col(c))
    out = F.when(_hit(text, exclude), "excluded").when(_hit(text, explicit), "explicit").when(_hit(text, strong), "strong")
    return out.when(_hit(text, weak) & ~_hit(text, noise), "weak").otherwise("none")


def evidence_text(c: Column | str, pattern: str) -> Column:
    """What a pattern matches in the text, for audit; null where nothing does."""
    found = F.regexp_extract(col(c), f"({pattern})", 1)
    return F.when(found != "", found)


def ladder_rank(c: Column | str, ladder: Mapping[str, tuple[int, str]]) -> Column:
    """Struct (rank, label) of the longest ladder word in the text; null when none stands there."""
    text = F.lower(col(c))
    out = F.lit(None).cast("struct<rank:int,label:string>")
    for word in sorted(ladder, key=len):
        rank, label = ladder[word]
        out = F.when(F.contains(text, F.lit(word.lower())), F.struct(F.lit(rank).cast("int").alias("rank"), F.lit(label).alias("label"))).otherwise(out)
    return out


def near_evidence(c: Column | str, positive: str, negation: str, window: int = 12) -> Column:
    """Whether the positive pattern stands in the text without a negation within so many characters after or before it."""
    text = F.lower(col(c))
    cancelled = text.rlike(f"(?:{positive}).{{0,{window}}}(?:{negation})|(?:{negation}).{{0,{window}}}(?:{positive})")
    return F.coalesce(text.rlike(positive) & ~cancelled, F.lit(False))
