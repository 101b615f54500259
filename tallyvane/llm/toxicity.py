"""Toxicity by maximum-scoring segments over token log-odds.

A word's score is the log-odds of its best known feature (the word or one of its prefixes) between toxic and other
documents, with a Dirichlet prior that follows the features' shares, less a constant drift. Features whose
log-likelihood ratio between the classes isn't significant aren't known. Ruzzo and Tompa's linear scan finds every maximal
segment of a document; the score S of a segment in n words has about K n exp(-lambda S) equals by chance in clean
text (Karlin and Altschul), where lambda solves sum p(s) exp(lambda s) = 1 and K is fitted on the clean part of the sample.
A document's evidence is the sum of -log of these expectations over its significant segments; two numbers of it are
turned into a probability by logistic regression.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyvane.llm.common import cut, sampled, small_batches

#: Labelled documents that the model is fitted on, in the mean.
SAMPLE = 20_000
PREFIXES = range(4, 9)
PRIOR = 500.0
#: What every feature has in the prior besides its share.
FLOOR = 0.5
#: Signed root of a feature's log-likelihood ratio.
MIN_Z = 4.5
MIN_COUNT = 4
#: A document adds a feature at most so often, so that one of a single repeated word teaches little.
PER_DOCUMENT = 4
CAP = 6.0
DRIFT = 0.1
_STRIP = ".,;:!?|&%$*#\"'()[]{}<>«»“”…"
_MEMO = 300_000
_FLUSH = 300_000


def words(text: str | None) -> list[str]:
    return text.lower().split() if text else []


def features(word: str) -> list[str]:
    """The stripped word, marked by a final space, and its prefixes."""
    w = word.strip(_STRIP)
    return [w + " ", *(w[:k] for k in PREFIXES if len(w) >= k)] if w else []


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def out(seen: list[Counter]) -> pd.DataFrame:
        keys = list(seen[0].keys() | seen[1].keys())
        return pd.DataFrame({"token": pd.Series(keys, dtype=object), "toxic": pd.Series([seen[1][k] for k in keys], dtype="int64"), "clean": pd.Series([seen[0][k] for k in keys], dtype="int64")})

    seen = [Counter(), Counter()]
    for batch in batches:
        for text, label in zip(batch["text"], batch["toxic"], strict=True):
            own: Counter = Counter()
            for w, n in Counter(words(text)).items():
                for f in features(w):
                    own[f] += n
            side = seen[int(label)]
            for f, n in own.items():
                side[f] += min(n, PER_DOCUMENT)
            if len(seen[0]) + len(seen[1]) > _FLUSH:
                yield out(seen)
                seen = [Counter(), Counter()]
    yield out(seen)


class Scores(dict):
    """Scores of words as they stand in texts; kept for words met before, up to a bound."""

    def __init__(self, lexicon: dict[str, tuple[float, float]], drift: float):
        self.lexicon, self.drift = lexicon, drift

    def __missing__(self, word: str) -> float:
        known = [self.lexicon[f] for f in features(word) if f in self.lexicon]
        score = (max(known, key=lambda x: abs(x[1]))[0] if known else 0.0) - self.drift
        if len(self) >= _MEMO:
            self.clear()
        self[word] = score
        return score


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score) in one pass over the words with a positive score."""
    total = np.cumsum(scores)
    found: list[tuple[float, float, int, int, int]] = []  # sum before, sum after, start, end, last one with a lesser sum before
    for i in np.flatnonzero(scores > 0):
        low, high, start, end = float(total[i] - scores[i]), float(total[i]), int(i), int(i) + 1
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][0] >= low:
                j = found[j][4]
            if j < 0 or found[j][1] >= high:
                found.append((low, high, start, end, j))
                break
            low, start = found[j][0], found[j][2]
            del found[j:]
    return [(s, e, high - low) for low, high, s, e, _ in found]


@dataclass
class Model:
    lexicon: dict[str, tuple[float, float]]
    drift: float = DRIFT
    decay: float = 1.0  # lambda
    scale: float = 1.0  # K
    weights: tuple[float, float, float] = (0.0, 0.0, 0.0)

    def significant(self, text: str | None, memo: Scores | None = None) -> list[tuple[int, int, float]]:
        """Segments (first word, end word, expected number of equals by chance) of under one such equal."""
        scores = np.array([(memo or Scores(self.lexicon, self.drift))[w] for w in words(text)])
        return [(a, b, e) for a, b, s in segments(scores) if (e := self.scale * len(scores) * np.exp(-self.decay * s)) < 1]

    def evidence(self, n: int, found: list[tuple[int, int, float]]) -> tuple[float, float]:
        logs = [self.decay * s - np.log(max(self.scale * n, 1e-9)) for _, _, s in found]
        best = max([-np.log(max(self.scale * n, 1e-9)), *logs]) if n else -20.0
        return float(np.clip(best, -20, 40)), float(np.clip(sum(x for x in logs if x > 0), 0, 80))

    def score(self, text: str | None, memo: Scores) -> float:
        scores = np.array([memo[w] for w in words(text)])
        x, y = self.evidence(len(scores), segments(scores))
        a, b, c = self.weights
        return float(1 / (1 + np.exp(-np.clip(a + b * x + c * y, -50, 50))))


def _measured(model):
    """Of each document: its label, words, best segment, and how many words have each score (to two places: at most 1,300 scores)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo = Scores(model.value.lexicon, model.value.drift)
        for batch in batches:
            rows = []
            for text, label in zip(batch["text"], batch["toxic"], strict=True):
                scores = np.array([memo[w] for w in words(text)])
                values, n = np.unique(np.round(scores, 2), return_counts=True)
                rows.append((int(label), len(scores), max((s for _, _, s in segments(scores)), default=0.0), values.tolist(), n.tolist()))
            yield pd.DataFrame(rows, columns=["toxic", "n", "best", "scores", "counts"])

    return run


def _weighed(model):
    """Of each document: its label and the two numbers of its evidence."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo = Scores(model.value.lexicon, model.value.drift)
        for batch in batches:
            rows = []
            for text, label in zip(batch["text"], batch["toxic"], strict=True):
                scores = np.array([memo[w] for w in words(text)])
                rows.append((int(label), *model.value.evidence(len(scores), segments(scores))))
            yield pd.DataFrame(rows, columns=["toxic", "x", "y"])

    return run


def _decay(scores: np.ndarray, share: np.ndarray) -> float:
    """The positive root of sum share * exp(decay * score) = 1; 5 where the scores never make one."""
    low, high = 0.0, 5.0
    if (share * np.exp(high * scores)).sum() <= 1:
        return high
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if (share * np.exp(middle * scores)).sum() <= 1 else (low, middle)
    return max(low, 0.05)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[float, ...]:
    """Newton's method on a few columns."""
    x = np.column_stack([np.ones(len(x)), x])
    weight = np.ones(len(y))
    w = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge * len(y) * np.eye(len(w)), x.T @ (weight * (y - p)) - ridge * len(y) * w)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE) -> Model:
    """The model of the labelled documents, fitted on `sample` of them in the mean, drawn by the hash of the id.

    Its size is bounded by the sample: every significant feature of it is known, and one row a sampled document comes to
    the driver. Several labels of one id count as toxic if one is; null labels don't count, null texts are empty. Rows
    that repeat are each learned from, and very long texts add a feature PER_DOCUMENT times at most. Without both classes,
    as with empty tables, there is nothing to learn: every document then scores 1 if all labels are toxic, else 0. Only
    the named columns are read.
    """
    small_batches(docs.sparkSession)
    given = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("toxic"))
    chosen = sampled(given, "id", sample, given.count())
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id").select("text", "toxic")
    own = cut(own.repartition(max(6, docs.sparkSession.sparkContext.defaultParallelism)))
    sizes = {r["toxic"]: r["n"] for r in own.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        share = float(max(sizes, default=0))
        return Model({}, weights=(50.0 if share else -50.0, 0.0, 0.0))

    counts = cut(own.mapInPandas(_count, "token string, toxic long, clean long").groupBy("token").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c")).where(F.col("t") + F.col("c") >= MIN_COUNT))
    sums = counts.agg(F.coalesce(F.sum("t"), F.lit(0)).alias("t"), F.coalesce(F.sum("c"), F.lit(0)).alias("c")).first()
    all_t, all_c = float(sums["t"]), float(sums["c"])
    t, c, prior = F.col("t"), F.col("c"), F.col("prior")
    share_t = all_t / max(1.0, all_t + all_c)
    odds = counts.withColumn("prior", F.lit(FLOOR) + F.lit(PRIOR) * (t + c) / max(1.0, all_t + all_c))
    odds = odds.withColumn("odds", F.log((t + prior) / (all_t + PRIOR - t)) - F.log((c + prior) / (all_c + PRIOR - c)))
    part = lambda n, expected: F.when(n > 0, n * F.log(n / expected)).otherwise(0.0)
    ratio = 2 * (part(t, (t + c) * share_t) + part(c, (t + c) * (1 - share_t)))
    odds = odds.withColumn("z", F.signum("odds") * F.sqrt(F.greatest(ratio, F.lit(0.0))))
    best = odds.where(F.abs("z") >= MIN_Z).select("token", "odds", "z").collect()
    model = Model({r["token"]: (max(-0.5, min(CAP, r["odds"])), r["z"]) for r in best})

    context = docs.sparkSession.sparkContext
    seen = own.mapInPandas(_measured(context.broadcast(model)), "toxic int, n long, best double, scores array<double>, counts array<long>").where("toxic = 0 and n > 0").toPandas()
    tally: Counter = Counter()
    for s, n in zip(seen["scores"], seen["counts"], strict=True):
        for a, b in zip(s, n, strict=True):
            tally[a] += b
    values, n = np.array(list(tally), dtype=float), np.array(list(tally.values()), dtype=float)
    model.decay = _decay(values, n / max(1.0, n.sum()))
    chance = (seen["n"].to_numpy() * np.exp(-model.decay * seen["best"].to_numpy())).sum()
    model.scale = len(seen) / chance if chance > 0 else 1.0
    both = own.mapInPandas(_weighed(context.broadcast(model)), "toxic int, x double, y double").toPandas()
    model.weights = _logistic(both[["x", "y"]].to_numpy(), both["toxic"].to_numpy().astype(float))
    return model


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """docs with score (0 to 1) and predicted (1 from 0.5 on). Whole texts, one pass, no shuffle.

    A null text scores like an empty one; rows that repeat are each scored, and columns of docs of these two names give way.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        memo = Scores(shared.value.lexicon, shared.value.drift)
        for texts in batches:
            yield pd.Series([shared.value.score(t, memo) for t in texts], dtype="float64")

    out = docs.withColumn("score", run(F.col(text_col)))
    return out.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))
