"""Ratcliff-Obershelp similarity: Spark has none, so an Arrow-batched function; keep it behind a block key."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


@F.pandas_udf(DoubleType())
def seq_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """2 M / T of two texts, M the characters in matching blocks and T those of both; null where one is null."""
    return pd.Series([None if x is None or y is None else SequenceMatcher(None, x, y, autojunk=False).ratio() for x, y in zip(a, b, strict=True)], dtype="float64")
