"""Personal data by weak supervision: labelers vote on candidate spans, expectation-maximisation weighs them, a classifier decides.

Base spans are the matches of the four base patterns and always stay. Wider patterns propose more: worded and spaced
addresses, IPv6, card numbers in groups or without a valid check digit, national phone forms, bank accounts (IBAN), keys
and tokens. Five labelers say yes, no or nothing about every candidate, none of them by the pattern that proposed it: its
form (check digits, lengths), a gazetteer (top-level domains, country and calling codes, reserved addresses, key
prefixes), the words before it, what touches it, and its layout.

Votes are counted by kind and pattern over the whole table (at most kinds * 3^labelers rows). Of these
expectation-maximisation estimates, for each kind apart, how often each labeler says yes, no or nothing of personal data
and of other text; a prior that labelers are mostly right, its weight a share of the candidates, tells the two
classes apart. Its beliefs are what the classifier, a logistic regression on features of the span, its
surroundings and the votes, is fitted on, with a sample of SAMPLE candidates. What it gives under a half is dropped
unless the base patterns have it.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort
from collections import Counter
from dataclasses import dataclass, field
from ipaddress import IPv6Address
from math import log2

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StringType, StructField, StructType

from tallyvane.llm.common import cut, sampled, small_batches, stored

#: The kinds of the base patterns, then those that only the wider patterns propose.
KINDS = ("email", "ip", "card", "phone")
MORE = ("iban", "secret")
LABELERS = ("form", "gazetteer", "context", "border", "layout")
#: Candidates that the classifier is fitted on, in the mean, drawn by the hash of their votes and features.
SAMPLE = 10_000
DIM = 256
#: Of the prior: how often a labeler says yes, nothing and no of its own class, and its weight as a share of the candidates.
#: Check digits and lengths are certain but for misprints, so the form's prior is firmer and weighs as much as the data.
TRUST, PRIOR_SHARE = (0.75, 0.15, 0.10), 0.25
FORM_TRUST, FORM_SHARE = (0.98, 0.01, 0.01), 1.0
PRIOR_LEAST = 20.0

# The base patterns.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGIT = re.compile(r"[0-9]")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Wider patterns that only propose.
_DOTTED = re.compile(r"[0-9.]+")
_WORDED_EMAIL = re.compile(r"\b[A-Za-z0-9][A-Za-z0-9._%+-]{0,63} ?(?:\[at\]|\(at\)|\{at\}|@) ?[A-Za-z0-9-]{1,63}(?: ?(?:\[dot\]|\(dot\)|\{dot\}| dot |\.) ?[A-Za-z0-9-]{2,24}){1,3}\b", re.IGNORECASE)
# After a plain " at " a sentence may end ("was at home. Then"), so a plain dot has no spaces about it there.
_AT_EMAIL = re.compile(r"\b[A-Za-z0-9][A-Za-z0-9._%+-]{0,63} ? at [A-Za-z0-9-]{1,63}(?:(?: ?(?:\[dot\]|\(dot\)|\{dot\}) ?| dot |\.)[A-Za-z0-9-]{2,24}){1,3}\b", re.IGNORECASE)
_AT = re.compile(r"\[at\]|\(at\)|\{at\}| at |@", re.IGNORECASE)
_LOCAL_MOST = 64
_WIDE_PHONE = re.compile(r"(?<![\w+.-])(?:\([0-9]{2,4}\) ?[0-9]{3,4}[ .-][0-9]{3,4}|[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}|0[0-9]{1,4}[ /-][0-9]{3,4}[ -]?[0-9]{3,4})(?![\w-])")
_WIDE_CARD = re.compile(r"(?<![\w-])(?:[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}|[0-9]{14,19})(?![\w-])")
_IP6 = re.compile(r"(?<![\w:.])(?:[0-9A-Fa-f]{1,4}:){2,7}(?::?[0-9A-Fa-f]{1,4}|:)(?![\w:.])|(?<![\w:.])(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6}(?![\w:])")
_IBAN = re.compile(r"(?<![\w-])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\w-])")
_NAMED_SECRET = re.compile(r"\b(?:token|secret|passw(?:or)?d|pwd|api[_ -]?key|access[_ -]?key|private[_ -]?key)\b[\"']?\s{0,3}[=:]\s{0,3}[\"']?([^\s\"'<>]{6,})", re.IGNORECASE)
_BARE_SECRET = re.compile(r"(?<![\w-])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,}+|sk-[A-Za-z0-9]{20,}+|[0-9a-f]{32,}+)(?![\w-])", re.IGNORECASE)

# What the gazetteer and the context labeler know.
TLDS = frozenset("com org net edu gov int info biz io co us uk de fr es it nl be ch at eu ca au jp cn in br mx ru pl se no dk fi pt".split())
CALLING_CODES = ("1", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "51", "52", "53", "54", "55", "56", "57", "58", "60", "61", "62", "63", "64", "65", "66", "7", "81", "82", "84", "86", "90", "91", "92", "93", "94", "95", "98")
CARD_PREFIXES = re.compile(r"4|5[1-5]|2[2-7]|3[47]|6011|65|35|30|36|38")
IBAN_LENGTHS = {"AT": 20, "BE": 16, "CH": 21, "DE": 22, "DK": 18, "ES": 24, "FI": 18, "FR": 27, "GB": 22, "IE": 22, "IT": 27, "LU": 20, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "SE": 24}
SECRET_PREFIXES = re.compile(r"AKIA|gh[pousr]_|xox[abprs]-|sk-")
CONTEXT = {
    "email": re.compile(r"e-?mail|mail|contact|kontakt|correo|courriel|write to|reach", re.IGNORECASE),
    "ip": re.compile(r"\bip\b|host|server|serveur|servidor|addr|ping|login from", re.IGNORECASE),
    "card": re.compile(r"card|karte|carte|tarjeta|visa|credit|payment", re.IGNORECASE),
    "phone": re.compile(r"phone|tel\b|tel[.:]|call|fon\b|móvil|mobil|fax|anruf|dial|text me", re.IGNORECASE),
    "iban": re.compile(r"iban|bank|account|konto|compte|cuenta", re.IGNORECASE),
    "secret": re.compile(r"token|secret|passw|pwd|key|credential", re.IGNORECASE),
}
NEGATIVE_CONTEXT = re.compile(r"(?:\bv|version|release|section|§|isbn|issn|order|invoice|serial|part|no|nr|commit|sha\d*|md5|checksum|id)[\s.:#]*$", re.IGNORECASE)
_CONTEXT_CHARS = 40


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of the base pattern, in time linear in the text: a match has one @ and starts where the run before it does."""
    found, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            found.append((start, m.end()))
        last = m.end() if m else at + 1
        at = text.find("@", last)
    return found


def _quads(text: str) -> list[tuple[int, int]]:
    """Leftmost runs of four numbers between dots, each at most 255, linear in the text: a match is of whole runs of digits."""
    found = []
    for m in _DOTTED.finditer(text):
        if m.group().count(".") < 3:
            continue
        at, runs = m.start(), []
        for part in m.group().split("."):
            runs = [*runs, (at, part)] if part else []
            at += len(part) + 1
            if len(runs) == 4:
                if all(_number(p) <= 255 for _, p in runs):
                    found.append((runs[0][0], at - 1))
                runs = []
    return found


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """Base matches as (kind, start, end), code points, end exclusive, by start and then kind."""
    if not text:
        return []
    found = [("email", a, b) for a, b in _emails(text)]
    if not _DIGIT.search(text):
        return found
    found += [("ip", a, b) for a, b in _quads(text)]
    for m in _CARD.finditer(text):
        digits = _digits(m.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_digits(m.group())) <= 15:
                found.append(("phone", *m.span()))
    return sorted(found, key=_order)


def _order(span: tuple) -> tuple[int, int]:
    return span[1], (KINDS + MORE).index(span[0])


def _worded(text: str) -> list[tuple[int, int]]:
    """Worded and spaced addresses, leftmost, in linear time: looked for around what may stand for the @."""
    found, last = [], 0
    for at in _AT.finditer(text):
        end = at.start() - (text[at.start() - 1 : at.start()] == " ")
        start = end
        while start > max(last, end - _LOCAL_MOST) and text[start - 1] in _LOCAL:
            start -= 1
        for s in range(start, end):
            if s and (text[s - 1].isalnum() or text[s - 1] == "_"):
                continue
            m = (_AT_EMAIL if at.group().lower() == " at " else _WORDED_EMAIL).match(text, s)
            if m and m.end() > at.end():
                found.append(m.span())
                last = m.end()
                break
    return found


def _number(digits: str) -> int:
    """Of digits whose leading zeros may be many; of what is over 255 only that it is."""
    digits = digits.lstrip("0")
    return int(digits or 0) if len(digits) <= 3 else 256


def _proposed(text: str) -> list[tuple[str, int, int]]:
    """What the wider patterns match, in the order in which they may claim text."""
    found = [("email", a, b) for a, b in _worded(text)]
    low = text.casefold()
    if any(x in low for x in ("token", "secret", "passw", "pwd", "key")):
        found += [("secret", *m.span(1)) for m in _NAMED_SECRET.finditer(text)]
    found += [("secret", *m.span()) for m in _BARE_SECRET.finditer(text)]
    if ":" in text:
        found += [("ip", *m.span()) for m in _IP6.finditer(text) if "::" in m.group() or m.group().count(":") == 7]
    if not _DIGIT.search(text):
        return found
    found += [("iban", *m.span()) for m in _IBAN.finditer(text)]
    found += [("card", *m.span()) for m in _WIDE_CARD.finditer(text)]
    return found + [("phone", *m.span()) for m in _WIDE_PHONE.finditer(text)]


def _entropy(s: str) -> float:
    n = len(s)
    return -sum(c / n * log2(c / n) for c in Counter(s).values())


def _votes(text: str, kind: str, start: int, end: int) -> str:
    """One letter for each labeler: y, n or - for no opinion."""
    span, before = text[start:end], text[max(0, start - _CONTEXT_CHARS) : start]
    digits = _digits(span)
    say = lambda yes, no=True: "y" if yes else "n" if no else "-"
    if kind == "email":
        plain = re.sub(r" ?[\[({]?(?:\bat\b|@)[\])}]? ?", "@", re.sub(r" ?(?:[\[({]dot[\])}]| dot |\.) ?", ".", span, flags=re.IGNORECASE), count=1, flags=re.IGNORECASE)
        tail = plain.rsplit(".", 1)[-1].lower()
        form, known, layout = say(re.fullmatch(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", plain) and 2 <= len(tail) <= 10 and tail.isalpha()), say(tail in TLDS), say(" " not in span or re.search(r"\bdot\b|\[|\(", span, re.IGNORECASE))
    elif kind == "ip" and ":" in span:
        try:
            form = "y" if IPv6Address(span) else "n"
        except ValueError:
            form = "n"
        known, layout = say(span[0] in "23" or span[:2].lower() in ("fc", "fd", "fe")), say(len(span) >= 9)
    elif kind == "ip":
        parts = span.split(".")
        form = say(not any(len(p) > 1 and p[0] == "0" for p in parts))
        known, layout = say(0 < _number(parts[0]) < 224 and _number(parts[0]) != 127), say(any(_number(p) > 31 for p in parts), False)
    elif kind == "card":
        form, known, layout = say(14 <= len(digits) <= 19 and luhn(digits)), say(CARD_PREFIXES.match(digits)), say(len(digits) == len(span) or re.fullmatch(r"[0-9]{4}(?:[ -][0-9]{4,6}){2,4}", span))
    elif kind == "phone":
        form = say(10 <= len(digits) <= 15) if span[0] == "+" else say(9 <= len(digits) <= 11)
        known = say(digits.startswith(CALLING_CODES)) if span[0] == "+" else say(span[0] in "(0" or digits[0] not in "01", False)
        layout = say(re.search(r"[\x20().-]", span.lstrip("+")), False)
    elif kind == "iban":
        plain = span.replace(" ", "")
        form, known = say(int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1), say(IBAN_LENGTHS.get(plain[:2]) == len(plain))
        layout = say(" " not in span or all(len(p) == 4 for p in span.split(" ")[:-1]))
    else:
        form = say(len(span) >= 12 and _entropy(span) >= 2.8 or re.search(r"[^A-Za-z0-9]", span) and len(digits) and len(span) >= 8)
        known, layout = say(SECRET_PREFIXES.match(span) or len(span) in (32, 40, 64, 96, 128) and re.fullmatch(r"[0-9a-fA-F]+", span), False), say(digits and re.search(r"[A-Za-z]", span))
    context = "n" if NEGATIVE_CONTEXT.search(before) else say(CONTEXT[kind].search(before), False)
    border = say(not ((start and text[start - 1].isalnum()) or text[end : end + 1].isalnum()))
    return form + known + context + border + layout


def _shape(s: str) -> str:
    return re.sub(r"(.)\1+", r"\1+", re.sub(r"[a-z]", "a", re.sub(r"[A-Z]", "A", re.sub(r"[0-9]", "9", s))))[:16]


def _features(text: str, kind: str, start: int, end: int, votes: str) -> list[int]:
    """Hashed features of the span and what stands around it, and of the votes."""
    before, after = text[max(0, start - _CONTEXT_CHARS) : start], text[end : end + 8]
    word = re.findall(r"[^\W\d_]+", before.lower())[-1:] or [""]
    near = lambda s: "" if not s else "9" if s.isdigit() else "a" if s.isalpha() else s if s.isprintable() else " "
    named = [f"shape={_shape(text[start:end])}", f"len={(end - start) // 4}", f"word={word[0]}", f"left={near(before[-1:])}", f"right={near(after[:1])}", *(f"{name}={v}" for name, v in zip(LABELERS, votes, strict=True)), "kind"]
    return [zlib.crc32(f"{kind} {f}".encode("utf-8", "replace")) % DIM for f in named]


def candidates(text: str | None) -> list[tuple[str, int, int, bool, str, list[int]]]:
    """(kind, start, end, base, votes, features) of base spans and of wider ones that touch no span already there, by start, then kind."""
    if not text:
        return []
    spans = [(*s, True) for s in base_spans(text)]
    taken: list[tuple[int, int]] = []
    for _, a, b, _ in spans:  # base spans may overlap each other
        if not taken or a >= taken[-1][1]:
            taken.append((a, b))
        else:
            taken[-1] = (taken[-1][0], max(b, taken[-1][1]))
    for kind, a, b in _proposed(text):
        i = bisect_left(taken, (a, b))
        if (i == 0 or taken[i - 1][1] <= a) and (i == len(taken) or taken[i][0] >= b):
            spans.append((kind, a, b, False))
            insort(taken, (a, b))
    out = []
    for kind, a, b, base in sorted(spans, key=_order):
        votes = _votes(text, kind, a, b)
        out.append((kind, a, b, base, votes, _features(text, kind, a, b, votes)))
    return out


@dataclass
class Model:
    """By kind, the share of personal data among candidates and what each labeler says of it and of the rest; the classifier's weights."""

    prior: dict[str, float] = field(default_factory=dict)
    reliability: dict[str, dict[str, dict[str, float]]] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(DIM + 1))

    def probability(self, features: np.ndarray) -> np.ndarray:
        """Of rows of feature numbers."""
        return 1 / (1 + np.exp(-np.clip(self.weights[features].sum(axis=1) + self.weights[DIM], -40, 40)))


def _expect(patterns: pd.DataFrame, rounds: int) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
    """Of one kind's rows (votes, n): the share of personal data, what labelers say of it and of other text, and the belief in each row."""
    n = patterns["n"].to_numpy(dtype=float)
    cast = np.array([["y-n".index(v) for v in votes] for votes in patterns["votes"]])
    trust = np.array([FORM_TRUST if name == "form" else TRUST for name in LABELERS])
    weight = np.array([[max(PRIOR_LEAST, (FORM_SHARE if name == "form" else PRIOR_SHARE) * n.sum())] for name in LABELERS])
    yes, no, prior = trust, trust[:, ::-1], 0.5
    picked = np.arange(len(LABELERS))
    for _ in range(rounds):
        logit = np.log(prior / (1 - prior)) + (np.log(yes[picked, cast]) - np.log(no[picked, cast])).sum(axis=1)
        belief = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        prior = float(np.clip(((n * belief).sum() + 0.5 * PRIOR_LEAST) / (n.sum() + PRIOR_LEAST), 0.02, 0.98))
        count = lambda w: np.array([[(n * w * (cast[:, j] == v)).sum() for v in range(3)] for j in picked])
        yes, no = count(belief) + weight * trust, count(1 - belief) + weight * trust[:, ::-1]
        yes, no = yes / yes.sum(axis=1, keepdims=True), no / no.sum(axis=1, keepdims=True)
    return prior, yes, no, belief


def fit(patterns: pd.DataFrame, sample: pd.DataFrame, rounds: int = 50) -> Model:
    """From counts (kind, votes, n) of all candidates and a sample of them (kind, votes, features)."""
    model, beliefs = Model(), {}
    for kind, own in patterns.sort_values(["kind", "votes"]).groupby("kind"):
        prior, yes, no, belief = _expect(own, rounds)
        model.prior[kind] = prior
        model.reliability[kind] = {name: {"yes if personal": float(yes[j, 0]), "yes if not": float(no[j, 0])} for j, name in enumerate(LABELERS)}
        beliefs |= {(kind, v): float(b) for v, b in zip(own["votes"], belief, strict=True)}
    if sample.empty:
        return model
    features = np.array(sample["features"].tolist(), dtype=np.int64)
    x = np.zeros((len(features), DIM + 1), dtype=np.float32)
    for column in features.T:
        x[np.arange(len(x)), column] += 1
    x[:, DIM] = 1
    y = np.array([beliefs[k, v] for k, v in zip(sample["kind"], sample["votes"], strict=True)])
    w, ridge = np.zeros(DIM + 1), 0.3 * np.eye(DIM + 1)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None].astype(np.float32)).T @ x + ridge, x.T @ (y - p) - 0.3 * w)
        w = w + np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-7:
            break
    model.weights = w
    return model


_SPAN = StructType([StructField("kind", StringType()), StructField("start", IntegerType()), StructField("end", IntegerType()), StructField("base", BooleanType()), StructField("votes", StringType()), StructField("features", ArrayType(IntegerType()))])


@F.pandas_udf(ArrayType(_SPAN))
def _found(texts: pd.Series) -> pd.Series:
    names = _SPAN.names
    return pd.Series([[dict(zip(names, c, strict=True)) for c in candidates(t)] for t in texts], dtype=object)


def _model(seen: DataFrame, spans: str) -> Model:
    """Of a table that holds the candidates of its texts."""
    each = seen.select(F.explode(spans).alias("s")).select("s.*")
    counts = each.groupBy("kind", "votes").agg(F.count("*").alias("n")).toPandas()
    drawn = sampled(each.withColumn("_draw", F.xxhash64("votes", "features", "start", "end")), "_draw", SAMPLE, int(counts["n"].sum()))
    return fit(counts, drawn.select("kind", "votes", "features").toPandas())


def _kept(seen: DataFrame, spans: str, model: Model) -> Column:
    """Of the candidates, the base ones and those that the classifier takes: array of (kind, start, end, base)."""
    shared = seen.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("array<boolean>")
    def taken(features: pd.Series) -> pd.Series:
        return pd.Series([shared.value.probability(np.array([f.tolist() for f in rows], dtype=np.int64)) >= 0.5 if len(rows) else [] for rows in features], dtype=object)

    wider = F.exists(spans, lambda s: ~s["base"])
    own = F.when(wider, taken(F.when(wider, F.transform(spans, lambda s: s["features"])).otherwise(F.array().cast("array<array<int>>"))))
    marked = F.zip_with(F.col(spans), F.coalesce(own, F.array().cast("array<boolean>")), lambda s, keep: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["base"].alias("base"), (s["base"] | F.coalesce(keep, F.lit(False))).alias("keep")))
    return F.transform(F.filter(marked, lambda s: s["keep"]), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["base"].alias("base")))


def find(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, Model]:
    """docs with `spans` instead of its text: array of (kind, start, end, base) by start, then kind, and the model fitted on all candidates.

    Whole texts are read once, in time linear in their length; what is kept are the candidates. A null text is empty and
    has none. Repeated rows are each kept, and each counted. A table without candidates, or without rows, gives empty
    arrays and a model that takes nothing for granted. A column of docs named spans gives way.
    """
    small_batches(docs.sparkSession)
    keep = [c for c in docs.columns if c != text_col and c.lower() != "spans"]
    seen = cut(docs.select(*keep, _found(F.col(text_col)).alias("spans")))
    model = _model(seen, "spans")
    return seen.select(*keep, _kept(seen, "spans", model).alias("spans")), model


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined, as find() orders them: by start, then kind."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per row: the id, counts of base spans by kind, SHA-256 of the base spans as text, all spans as text, and how many of them were added."""
    base = F.filter("spans", lambda s: s["base"])

    def of(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long")

    counts = [of(k).alias(f"n_{k}") for k in KINDS]
    added = F.size(F.filter("spans", lambda s: ~s["base"])).cast("long")
    return found.select(F.col(id_col).alias("doc_id"), *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), added.alias("n_added"))


def mask(text: str | None, spans: list[tuple[str, int, int]]) -> str | None:
    """The text with each span replaced by its kind in angle brackets; of spans that overlap, the first stands for all."""
    if not text or not spans:
        return text
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: s[1:]):
        if a >= at:
            out += [text[at:a], f"<{kind.upper()}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with every span that find() keeps masked in its text.

    Texts are searched once: they are stored beside their candidates until the model is there. Only texts with spans go
    to Python again. Null texts stay null, repeated rows are each masked, other columns pass through.
    """
    small_batches(docs.sparkSession)
    own = "_candidates"
    while own in docs.columns:
        own += "_"
    seen = stored(docs.withColumn(own, _found(F.col(text_col))))
    shared = docs.sparkSession.sparkContext.broadcast(_model(seen, own))

    @F.pandas_udf(StringType())
    def masked(texts: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for text, rows in zip(texts, spans, strict=True):
            keep = [s["base"] for s in rows]
            if not all(keep):
                sure = shared.value.probability(np.array([list(s["features"]) for s in rows], dtype=np.int64)) >= 0.5
                keep = [a or b for a, b in zip(keep, sure, strict=True)]
            out.append(mask(text, [(s["kind"], s["start"], s["end"]) for s, k in zip(rows, keep, strict=True) if k]))
        return pd.Series(out, dtype=object)

    # One function decides and masks: each one more in a row is another Python worker for every task.
    some = F.size(own) > 0
    clean = F.when(some, masked(F.when(some, F.col(text_col)), F.when(some, F.col(own)).otherwise(F.array().cast(seen.schema[own].dataType))))
    return seen.withColumn(text_col, F.coalesce(clean, F.col(text_col))).select(docs.columns)
