"""Language identification in two steps: the family first, then linear support vector machines between its languages.

A text is the vector of square roots of the shares of its hashed letter bigrams and trigrams (runs of other characters
count as one space), so its length is one whatever the text's. One SVM against the rest separates each family (one in
all where there are two); within a family one SVM stands for each pair of languages and their margins vote.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import cache
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.ml.classification import LinearSVC
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from tallyvane.llm.common import cut, small_batches

DIM = 4096
#: Rows that each language gives to the training sample, in the mean; a rarer one gives them all.
SAMPLE = 800
UNDETERMINED = "und"

# ISO 639-1 codes of families with several common written languages. Any other code is its own family.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk bg sr hr sl mk bs",
    "indic": "hi ur bn mr ne pa gu",
    "turkic": "tr az kk ky uz tk tt",
    "uralic": "fi et hu",
}


def family_of(lang: str) -> str:
    return next((f for f, codes in FAMILIES.items() if lang.lower() in codes.split()), lang)


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)


def grams(text: str | None) -> np.ndarray | None:
    """Counts of a text's hashed letter bigrams and trigrams; None for a text without letters."""
    if not text:
        return None
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype="<u4")
    letter = _letters()[points]
    if not letter.any():
        return None
    s = np.where(letter, points, 32).astype(np.uint32)
    s = np.concatenate(([np.uint32(32)], s[np.concatenate(([letter[0]], letter[1:] | letter[:-1]))], [np.uint32(32)]))
    two = s[:-1] * np.uint32(0x9E3779B1) + s[1:] * np.uint32(0x85EBCA77)
    three = two[:-1] * np.uint32(0xC2B2AE3D) + s[2:] * np.uint32(0x27D4EB2F)
    return np.bincount(two >> np.uint32(20), minlength=DIM) + np.bincount(three >> np.uint32(20), minlength=DIM)


def vector(text: str | None) -> np.ndarray | None:
    counts = grams(text)
    return None if counts is None else np.sqrt(counts / counts.sum())


@F.pandas_udf(ArrayType(DoubleType()))
def _shares(texts: pd.Series) -> pd.Series:
    return pd.Series([None if (x := vector(t)) is None else x for t in texts], dtype=object)


@dataclass(frozen=True)
class Model:
    """Weights of all SVMs, side by side; sides says what each separates: (kind, positive, negative)."""

    languages: tuple[str, ...]
    sides: tuple[tuple[str, str, str | None], ...]
    weights: np.ndarray
    bias: np.ndarray
    sharpness: float = 3.0

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language, and the product of its family's and its own share of the votes."""
        x = vector(text)
        if x is None or not self.languages:
            return UNDETERMINED, 0.0
        margins = x @ self.weights + self.bias
        votes: dict[tuple[str, str], float] = {}
        for (kind, a, b), m in zip(self.sides, margins, strict=True):
            votes[kind, a] = votes.get((kind, a), 0.0) + m
            if b is not None:
                votes[kind, b] = votes.get((kind, b), 0.0) - m

        def best(kind: str, names: list[str]) -> tuple[str, float]:
            if len(names) == 1:
                return names[0], 1.0
            v = np.array([votes.get((kind, n), 0.0) for n in names]) * self.sharpness
            share = np.exp(v - v.max())
            return names[int(v.argmax())], float(share.max() / share.sum())

        family, p = best("family", sorted({family_of(x) for x in self.languages}))
        language, q = best(family, sorted(x for x in self.languages if family_of(x) == family))
        return language, p * q


def fit(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", id_col: str = "doc_id", sample: int = SAMPLE, max_iter: int = 25) -> Model:
    """The model of the languages that docs name.

    Each language gives `sample` rows in the mean, drawn by the hash of the id: the model is fitted on these, whatever the
    table's size. Rows without language or without letters teach nothing; rows that repeat, with one id or without, are
    drawn together. A text of any length is one vector. No languages, or an empty table: a model that says `und`. Only
    the named columns are read.
    """
    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return Model((), (), np.zeros((DIM, 0)), np.zeros(0))
    share = F.coalesce(*(F.when(F.col("lang") == k, F.lit(min(1.0, sample / n))) for k, n in counts.items()))
    chosen = known.where(F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit("sample")), F.lit(1_000_000)) < share * 1_000_000)
    small_batches(docs.sparkSession)
    spread = chosen.select("lang", "text").repartition(max(6, docs.sparkSession.sparkContext.defaultParallelism))
    rows = cut(spread.select("lang", _shares("text").alias("shares"))).where("shares is not null").select("lang", array_to_vector("shares").alias("features"))
    languages = tuple(sorted(r["lang"] for r in rows.select("lang").distinct().collect()))
    families = sorted({family_of(x) for x in languages})
    of = {f: [x for x in languages if family_of(x) == f] for f in families}
    wanted: list[tuple[str, str, str | None, list[str], list[str]]] = []
    if len(families) == 2:
        wanted.append(("family", families[0], families[1], of[families[0]], of[families[1]]))
    elif len(families) > 2:
        wanted += [("family", f, None, of[f], [x for x in languages if x not in of[f]]) for f in families]
    for f in families:
        wanted += [(f, a, b, [a], [b]) for a, b in combinations(of[f], 2)]
    weights, bias = [], []
    for _, _, _, yes, no in wanted:
        own = rows.where(F.col("lang").isin(yes + no)).select("features", F.col("lang").isin(yes).cast("double").alias("label"))
        svm = LinearSVC(maxIter=max_iter, regParam=1e-4, standardization=False, aggregationDepth=2).fit(own)
        weights.append(svm.coefficients.toArray())
        bias.append(svm.intercept)
    return Model(languages, tuple(w[:3] for w in wanted), np.array(weights).reshape(-1, DIM).T, np.array(bias))


def predict(docs: DataFrame, model: Model, text_col: str = "text", lang_out: str = "lang_pred", score_out: str = "score") -> DataFrame:
    """docs with lang_pred and score: `und` and 0 where the text is null or has no letter. Whole texts, one pass, no shuffle.

    Rows that repeat are each predicted; columns of docs of the names given for the results give way.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def said(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([shared.value.predict(t) for t in texts], columns=["lang", "score"])

    own = f"_said_{uuid.uuid4().hex}"  # no column of the caller's
    # Called nondeterministic, so that a filter on its result doesn't have Spark run it twice.
    out = docs.withColumn(own, said.asNondeterministic()(F.col(text_col)))
    return out.withColumn(lang_out, F.col(f"{own}.lang")).withColumn(score_out, F.col(f"{own}.score")).drop(own)
