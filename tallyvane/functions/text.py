"""Column functions over free text: numbers, sizes, ages, keys, rewrites, labels and tokens.

All are expressions, so they stay inside Spark's generated code. Text that doesn't parse gives null; nothing raises.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Units of volume and of age as they stand in product names.
LITRE_UNITS = ("l", "리터", "liter", "litre")
VOLUME_PATTERN = r"(?i)([0-9]+(?:\.[0-9]+)?)\s*(ml|cl|l|리터|liter|litre)(?![a-z])"
TAIL_VOLUME_PATTERN = r"(?i)([0-9]+)\s*m\s*$"
AGE_PATTERN = r"(?i)([0-9]{1,2})\s*(?:년|年|yo\b|y\.o|years?|yrs?)"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_num(c: Column | str, positive: bool = True) -> Column:
    """The digits of a text as a whole number; null when there are none, too many, or (if positive) the number is 0."""
    n = F.regexp_replace(col(c).cast("string"), "[^0-9]", "").try_cast("bigint")
    return F.when(n > 0, n) if positive else n


def volume_ml(c: Column | str, default: int | None = None, last: bool = False, tail: bool = False) -> Column:
    """Millilitres of the first (or last) volume in a text; litres and centilitres are converted. tail: a text cut off after `700m` counts too."""
    numbers = F.regexp_extract_all(col(c), F.lit(VOLUME_PATTERN), 1)
    units = F.regexp_extract_all(col(c), F.lit(VOLUME_PATTERN), 2)
    n = F.try_element_at(numbers, F.lit(-1 if last else 1)).try_cast("double")
    unit = F.lower(F.try_element_at(units, F.lit(-1 if last else 1)))
    ml = F.when(unit.isin(*LITRE_UNITS), n * 1000).when(unit == "cl", n * 10).otherwise(n)
    out = F.round(ml).cast("int")
    if tail:
        out = F.coalesce(out, F.regexp_extract(col(c), TAIL_VOLUME_PATTERN, 1).try_cast("int"))
    return out if default is None else F.coalesce(out, F.lit(default))


def volumes_ml(c: Column | str) -> Column:
    """All volumes of a text in millilitres, in order."""
    found = F.regexp_extract_all(col(c), F.lit(VOLUME_PATTERN), 0)
    return F.transform(found, lambda x: volume_ml(x))


def age(c: Column | str, mode: str = "first", lo: int = 3, hi: int = 80) -> Column:
    """Ages in a text: the first, the greatest within lo..hi, or the set of all as a sorted array."""
    found = F.transform(F.regexp_extract_all(col(c), F.lit(AGE_PATTERN), 1), lambda x: x.try_cast("int"))
    if mode == "first":
        return F.try_element_at(found, F.lit(1))
    if mode == "max":
        return F.array_max(F.filter(found, lambda x: x.between(lo, hi)))
    if mode == "set":
        return F.array_sort(F.array_distinct(found))
    raise ValueError(f"no such mode: {mode}")


def norm_key(c: Column | str, keep: str = r"\p{L}\p{N}") -> Column:
    """Lower-cased text without anything but the kept character classes."""
    return F.regexp_replace(F.lower(col(c)), f"[^{keep}]", "")


def rewrite(c: Column | str, pairs: Sequence[tuple[str, str]]) -> Column:
    """Literal replacements one after the other: a later pair sees what an earlier one made."""
    out = col(c)
    for old, new in pairs:
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def rewrite_rx(c: Column | str, rules: Sequence[tuple[str, str]]) -> Column:
    """Regex replacements one after the other."""
    out = col(c)
    for pattern, new in rules:
        out = F.regexp_replace(out, pattern, new)
    return out


def alias(c: Column | str, names: Mapping[str, str]) -> Column:
    """names[value] where there is one, else the value; one way only, so both spellings can meet."""
    if not names:
        return col(c)
    table = F.create_map(*(F.lit(x) for pair in names.items() for x in pair))
    return F.coalesce(F.try_element_at(table, col(c)), col(c))


def canonical_label(c: Column | str, bases: Sequence[str], sep: str = "/") -> Column:
    """Each part of a `/`-separated label as the first base that it contains, else trimmed; repeats go, order stays."""

    def one(part: Column) -> Column:
        out = F.trim(part)
        for base in reversed(bases):
            out = F.when(F.contains(part, F.lit(base)), F.lit(base)).otherwise(out)
        return out

    parts = F.filter(F.transform(F.split(col(c), sep), one), lambda x: x != "")
    return F.array_join(F.array_distinct(parts), " / ")


def tokens(c: Column | str, pattern: str = r"[\p{L}\p{N}]+") -> Column:
    return F.regexp_extract_all(F.lower(col(c)), F.lit(pattern), 0)


def signature_token(c: Column | str, stop: Sequence[str] = (), strip: str | None = None, min_len: int = 2) -> Column:
    """The longest token that no stop word is, the first of equals; null when none is left."""
    text = F.regexp_replace(F.lower(col(c)), strip, " ") if strip else col(c)
    left = F.filter(F.array_except(tokens(text), F.array(*(F.lit(s) for s in stop)).cast("array<string>")), lambda x: F.length(x) >= min_len)
    ranked = F.transform(left, lambda x, i: F.struct((-F.length(x)).alias("n"), i.alias("i"), x.alias("x")))
    return F.array_min(ranked)["x"]


def model_numbers(c: Column | str, lo: int = 40, hi: int = 129) -> Column:
    """Sorted set of the numbers lo..hi in a text that no unit or digit follows."""
    found = F.transform(F.regexp_extract_all(col(c), F.lit(r"(?i)(?<![0-9.])([0-9]{2,3})(?![0-9]|\s*(?:ml|cl|l\b|년|年|yo|year|%|도))"), 1), lambda x: x.try_cast("int"))
    return F.array_sort(F.array_distinct(F.filter(found, lambda x: x.between(lo, hi))))


def descriptor_set(c: Column | str, groups: Mapping[str, Sequence[str]]) -> Column:
    """Sorted names of the groups of which a word stands in the text."""
    text = F.lower(col(c))
    flags = [F.when(matches_any(text, *(_quoted(w) for w in words)), F.lit(name)) for name, words in groups.items()]
    return F.array_sort(F.array_compact(F.array(*flags)))


def _quoted(word: str) -> str:
    return "".join(f"\\{x}" if x in r"\.[]{}()*+?^$|/-" else x for x in word.lower())


def matches_any(c: Column | str, *patterns: str) -> Column:
    """Whether one of the patterns stands in the text; false for null, and without patterns."""
    return F.lit(False) if not patterns else F.coalesce(col(c).rlike("|".join(f"(?:{p})" for p in patterns)), F.lit(False))


def branch_from_text(title: Column | str, body: Column | str, stop: Sequence[str] = ()) -> Column:
    """A branch name: in parentheses in the title, else a word ending in `점` or `branch`/`store` there, else the same in the body."""
    word = r"([\p{L}\p{N}]+(?:점| branch| store))"

    def first(found: Column) -> Column:
        return F.try_element_at(F.filter(found, lambda x: ~F.trim(x).isin(*stop) if stop else x != ""), F.lit(1))

    inside = F.regexp_extract_all(col(title), F.lit(r"\(([^()]+)\)"), 1)
    return F.coalesce(first(inside), first(F.regexp_extract_all(col(title), F.lit(word), 1)), first(F.regexp_extract_all(col(body), F.lit(word), 1)))


def clean_display(c: Column | str, generic: Sequence[str] = ()) -> Column:
    """A name without its trailing volume and generic words, spaces collapsed."""
    out = F.regexp_replace(col(c), r"(?i)[\s,(]*[0-9]+(?:\.[0-9]+)?\s*(?:ml|cl|l|리터)\)?\s*$", "")
    for word in generic:
        out = F.regexp_replace(out, rf"(?i)\b{_quoted(word)}\b", " ")
    return F.trim(F.regexp_replace(out, r"\s+", " "))


def format_manwon(c: Column | str) -> Column:
    """A whole number of won in units of ten thousand with one decimal that isn't 0, as `12.3만`; under ten thousand with separators."""
    n = col(c)
    short = F.regexp_replace(F.format_number(n / 10000.0, 1), r"\.0$", "")
    return F.when(F.abs(n) >= 10000, F.concat(short, F.lit("만"))).otherwise(F.format_number(n, 0))


def format_signed(c: Column | str) -> Column:
    """A whole number with thousands separators and its sign; 0 has none."""
    n = col(c)
    return F.concat(F.when(n > 0, "+").when(n < 0, "-").otherwise(""), F.format_number(F.abs(n), 0))


# What is said in speech and isn't in names, and how sentences end.
GARBAGE_WORDS = (
    "할인", "적립", "정립", "포인트", "마찬가지", "참고", "구독", "부탁", "시작", "그럼", "좋아요", "바랍", "입니다",
    "습니다", "하고 있", "이네요", "다음은", "보시", "준비", "소개", "말씀", "드리", "있으니", "같은 가격", "되겠",
)
SENTENCE_ENDINGS = ("니다", "네요", "어요", "아요", "세요", "으니", "니까", "군요", "구요")


def garbage(c: Column | str, max_len: int = 35, words: Sequence[str] = GARBAGE_WORDS, endings: Sequence[str] = SENTENCE_ENDINGS) -> Column:
    """Whether a text can't be a name: empty or null, too long, of several sentences, ending like one, or holding one of the words."""
    text = F.trim(F.regexp_replace(col(c), r"^\s+|\s+$", ""))
    bad = (text == "") | (F.length(text) > max_len) | F.contains(text, F.lit(". ")) | F.endswith(text, F.lit("."))
    if endings:
        bad = bad | text.rlike(f"(?:{'|'.join(map(_quoted, endings))})$")
    return F.coalesce(bad | (matches_any(text, *(_quoted(w) for w in words)) if words else F.lit(False)), F.lit(True))


def normalize_name(c: Column | str, synonyms: Mapping[str, Sequence[str]] | None = None, noise: Sequence[str] = ()) -> Column:
    """A name as rules see it: lower-cased, every spelling replaced by its word (longest first), noise patterns and runs of spaces made one space."""
    pairs = sorted(((v.lower(), word.lower()) for word, variants in (synonyms or {}).items() for v in variants), key=lambda p: -len(p[0]))
    out = rewrite(F.lower(col(c)), pairs)
    for pattern in noise:
        out = F.regexp_replace(out, f"(?i){pattern}", " ")
    return F.trim(F.regexp_replace(out, r"\s+", " "))


def per_person_price(name: Column | str, price: Column | str, grams: Column | str, least_party: Sequence[str] = ("이상", "부터", "minimum", "at least")) -> Column:
    """Price per person from a menu line: a set for n is divided by n, a price for so many grams goes to `grams`, a range is averaged.

    A line that only says from how many people on it is served (a word of least_party after the number) is a price a
    person as it stands. price is a number, or a text that may hold a range such as 10,000~12,000.
    """
    party = r"([0-9]+)\s*(?:인|명|persons?|people|pax)"
    people = F.regexp_extract(col(name), party, 1).try_cast("double")
    exempt = col(name).rlike(f"(?i){party}\\s*(?:{'|'.join(map(_quoted, least_party))})|(?:{'|'.join(map(_quoted, least_party))})\\s*{party}")
    portion = F.regexp_extract(col(name), r"(?i)([0-9]+)\s*g(?![a-z])", 1).try_cast("double")
    numbers = F.transform(F.regexp_extract_all(col(price).cast("string"), F.lit(r"[0-9][0-9,]*(?:\.[0-9]+)?"), 0), lambda x: F.replace(x, F.lit(","), F.lit("")).try_cast("double"))
    p = F.when(F.size(numbers) >= 2, (numbers[0] + numbers[1]) / 2).otherwise(F.try_element_at(numbers, F.lit(1)))
    return F.when((people > 1) & ~exempt, p / people).when(portion > 0, p * col(grams) / portion).otherwise(p)
