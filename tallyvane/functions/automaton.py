"""Many words looked for in one pass over a text: an Aho-Corasick automaton, built once and broadcast."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import ahocorasick
import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType


def automaton(needles: Sequence[tuple[str, str]]) -> ahocorasick.Automaton:
    """Of (block, needle) rows: each needle with the blocks in which it is looked for. Empty needles aren't."""
    blocks: dict[str, set[str]] = {}
    for block, needle in needles:
        if needle:
            blocks.setdefault(needle, set()).add(block)
    out = ahocorasick.Automaton()
    for needle, own in blocks.items():
        out.add_word(needle, (needle, frozenset(own)))
    if blocks:
        out.make_automaton()
    return out


def needles_in(spark: SparkSession, needles: Sequence[tuple[str, str]], text: Column, block: Column) -> Column:
    """The distinct needles of the text's block that stand in it, as it is written, in order; time linear in the text and the hits."""
    shared = spark.sparkContext.broadcast(automaton(needles))

    @F.pandas_udf(ArrayType(StringType()))
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        own = shared.value
        for texts, blocks in batches:
            if not len(own):
                yield pd.Series([[]] * len(texts), dtype=object)
                continue
            yield pd.Series([sorted({needle for _, (needle, of) in own.iter(t) if b in of}) if t else [] for t, b in zip(texts, blocks, strict=True)], dtype=object)

    return run(text, block)
