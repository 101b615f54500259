"""Byte-level BPE, encoded by batched merge rounds in numpy, and decoded.

A text is cut at the vocabulary's added tokens and then by its pattern into words. Words not met before wait until
enough of them are there; then the symbols of all stand in one flat array. A round looks up every pair of neighbours by
binary search over the sorted pair keys, and every word merges its lowest-ranked pair wherever it occurs. A word of more
than LONG symbols (a run without break may be a whole document) is merged by rank over linked positions instead, where a
round touches only what it changes.

Merging all places of a word's lowest pair at once gives what one merge after the other gives as long as no token is the
product of two merges: whatever holds the product then ranks after it. A vocabulary of which that isn't true is refused.
"""

from __future__ import annotations

import heapq
import json
import re
import sys
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType
from tokenizers import Tokenizer

from tallyvane.llm.common import small_batches

VOCABULARY = "byte_bpe_50k.json"
#: Words of more symbols are merged over linked positions.
LONG = 256
#: Words kept with their ids in a worker (in each of two generations), and the characters up to which one is kept.
KEPT, KEPT_CHARS = 250_000, 64
#: Texts wait for their new words to be merged together until so many characters of them have come.
TOGETHER = 2_000_000
_NONE = np.iinfo(np.int32).max

# The contractions of the pattern, and what it takes for white space.
_CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
_SPACE = "\t\n\x0b\x0c\r \x85\xa0  -     　"


def _pattern(letter: str, number: str, other: str) -> re.Pattern:
    return re.compile(f"{_CONTRACTIONS}| ?{letter}+| ?{number}+| ?{other}+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")


@cache
def _patterns() -> tuple[re.Pattern, re.Pattern, re.Pattern]:
    """For ASCII, for the basic plane and for any text; the classes of re have no letters or numbers, only both together."""
    odd = [c for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c)) in ("Nl", "No")]

    def of(numbers: list[int]) -> re.Pattern:
        listed = "".join(map(chr, numbers))
        return _pattern(rf"[^\W\d_{listed}]", rf"[\d{listed}]", rf"(?:[^\w{_SPACE}]|_)")

    return _pattern("[A-Za-z]", "[0-9]", rf"[^A-Za-z0-9{_SPACE}]"), of([c for c in odd if c < 0x10000]), of(odd)


@cache
def _unassigned(char: str) -> bool:
    return unicodedata.category(char) == "Cn"


class Vocabulary:
    """Ids, merges, added tokens and bytes of a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        ids = said["model"]["vocab"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in said["model"]["merges"]]
        products = np.array([ids[a + b] for a, b in merges], dtype=np.int64)
        if len(set(products.tolist())) < len(products):
            raise ValueError("a token is made by two merges")
        keys = np.array([ids[a] << 32 | ids[b] for a, b in merges], dtype=np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks, self.products = keys[order], order.astype(np.int32), products[order]
        shown = _shown()
        self.first = np.array([ids[chr(shown[b])] for b in range(256)], dtype=np.int64)
        back = {chr(c): b for b, c in shown.items()}
        self.added = {t["content"]: t["id"] for t in said["added_tokens"]}
        self.bytes = defaultdict(bytes, {i: bytes(back[c] for c in token) for token, i in ids.items()} | {i: t.encode() for t, i in self.added.items()})
        self.cut = re.compile("|".join(re.escape(t) for t in sorted(self.added, key=len, reverse=True))) if self.added else None
        self.split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.known, self.older = {}, {}

    def ranked(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of pairs: their rank, _NONE where there is no merge, and their place among the keys."""
        pairs = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, pairs), len(self.keys) - 1)
        return np.where(self.keys[at] == pairs, self.ranks[at], _NONE), at

    def words(self, text: str) -> list[str]:
        """The pattern's words. Where Python doesn't know a character yet, the library says what it is."""
        plain, basic, every = _patterns()
        if text.isascii():
            return plain.findall(text)
        seen = set(text)
        if any(map(_unassigned, seen)):
            return [text[a:b] for _, (a, b) in self.split(text)]
        return (basic if max(seen) < "\U00010000" else every).findall(text)

    def merged(self, words: list[str]) -> list[bytes]:
        """The ids of each word, four bytes each in the machine's order."""
        raw = [w.encode() for w in words]
        short = iter(self._rounds([r for r in raw if len(r) <= LONG]))
        return [next(short) if len(r) <= LONG else self._linked(r) for r in raw]

    def _rounds(self, raw: list[bytes]) -> list[bytes]:
        """Many words at once; a round looks up only the pairs that the one before changed."""
        sizes = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
        symbols = self.first[np.frombuffer(b"".join(raw), dtype=np.uint8)]
        word = np.repeat(np.arange(len(raw)), sizes)
        rank, at = np.full(len(symbols), _NONE, dtype=np.int32), np.zeros(len(symbols), dtype=np.int64)
        changed, ready = np.arange(len(symbols)), [(word[:0], symbols[:0])]
        while len(symbols):
            rank[changed] = _NONE
            paired = changed[changed < len(symbols) - 1]
            paired = paired[word[paired] == word[paired + 1]]
            rank[paired], at[paired] = self.ranked(symbols[paired], symbols[paired + 1])
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            lowest = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.r_[starts, len(symbols)]))
            live = lowest < _NONE
            ready.append((word[~live], symbols[~live]))
            chosen = _apart(np.flatnonzero((rank == lowest) & live), 1)
            symbols[chosen] = self.products[at[chosen]]
            live[chosen + 1] = False
            touched = np.zeros(len(symbols), dtype=bool)
            touched[chosen] = True
            touched = touched[live]
            touched[:-1] |= touched[1:]
            changed = np.flatnonzero(touched)
            symbols, word, rank, at = symbols[live], word[live], rank[live], at[live]
        word, symbols = (np.concatenate(x) for x in zip(*ready, strict=True))
        order = np.argsort(word, kind="stable")
        ends = np.searchsorted(word[order], np.arange(len(raw) + 1)) * 4
        flat = symbols[order].astype(np.int32).tobytes()
        return [flat[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]

    def _linked(self, raw: bytes) -> bytes:
        """One long word, merged rank by rank; a round costs what it changes."""
        n = len(raw)
        symbols = self.first[np.frombuffer(raw, dtype=np.uint8)]
        after, before, there = np.arange(1, n + 1), np.arange(-1, n - 1), np.ones(n, dtype=bool)
        rank, at = np.full(n, _NONE, dtype=np.int32), np.zeros(n, dtype=np.int64)
        waiting: dict[int, list[np.ndarray]] = {}
        queue: list[int] = []

        def look(places: np.ndarray) -> None:
            rank[places] = _NONE
            paired = places[after[places] < n]
            rank[paired], at[paired] = self.ranked(symbols[paired], symbols[after[paired]])
            known = paired[rank[paired] < _NONE]
            known = known[np.argsort(rank[known], kind="stable")]
            edges = np.flatnonzero(np.diff(rank[known], prepend=-1))
            for group in np.split(known, edges[1:]) if len(known) else []:
                r = int(rank[group[0]])
                if r not in waiting:
                    waiting[r] = []
                    heapq.heappush(queue, r)
                waiting[r].append(group)

        look(np.arange(n))
        while queue:
            r = heapq.heappop(queue)
            places = np.unique(np.concatenate(waiting.pop(r)))
            places = places[there[places] & (rank[places] == r)]
            chosen = _apart(places, after[places])
            if not len(chosen):
                continue
            gone = after[chosen]
            symbols[chosen] = self.products[at[chosen]]
            there[gone] = False
            after[chosen] = after[gone]
            inside = chosen[after[chosen] < n]
            before[after[inside]] = inside
            left = before[chosen]
            look(np.unique(np.concatenate([chosen, left[left >= 0]])))
        return symbols[there].astype(np.int32).tobytes()

    def encode(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """Ids of the texts, in order. Texts wait for each other's new words up to TOGETHER characters."""
        group, size = [], 0
        for text in texts:
            group.append(text or "")
            size += len(group[-1])
            if size >= TOGETHER:
                yield from self._encoded(group)
                group, size = [], 0
        yield from self._encoded(group)

    def _encoded(self, texts: list[str]) -> Iterator[np.ndarray]:
        parts = [self._parts(t) for t in texts]
        if len(self.known) > KEPT:
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        missing = set().union(*(p for own in parts for p in own)) - known.keys()
        known.update((t, np.int32(i).tobytes()) for t, i in self.added.items())
        known.update((w, older[w]) for w in missing if w in older)
        fresh = [w for w in missing if w not in known]
        known.update(zip(fresh, self.merged(fresh), strict=True))
        for own in parts:
            yield np.frombuffer(b"".join(b"".join(map(known.__getitem__, p)) for p in own), dtype=np.int32)
        for w in missing:
            if len(w) > KEPT_CHARS:
                del known[w]

    def _parts(self, text: str) -> list[list[str]]:
        """Words, and the added tokens between them."""
        if self.cut is None or not any(t in text for t in self.added):
            return [self.words(text)]
        out, at = [], 0
        for m in self.cut.finditer(text):
            out += [self.words(text[at : m.start()]), [m.group()]]
            at = m.end()
        return [*out, self.words(text[at:])]

    def decode(self, ids: list[int]) -> str:
        """The text of ids; bytes that aren't UTF-8 become replacement characters, and ids that the vocabulary doesn't have are left out."""
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")


def _shown() -> dict[int, int]:
    """How byte-level vocabularies write bytes: printable ones as they are, the others from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    return {b: b if b in plain else 256 + i for i, b in enumerate(sorted(range(256), key=lambda b: (b in plain, b)))}


def _apart(places: np.ndarray, after: np.ndarray | int) -> np.ndarray:
    """Of ascending places of one pair, those that a pass from the left takes: where they overlap (a pair of equal symbols), every other one."""
    if len(places) < 2:
        return places
    joined = places[1:] == (places + after)[:-1] if isinstance(after, int) else places[1:] == after[:-1]
    if not joined.any():
        return places
    index = np.arange(len(places))
    start = np.maximum.accumulate(np.where(np.r_[True, ~joined], index, 0))
    return places[(index - start) % 2 == 0]


@cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _listed(ids: pa.ListScalar) -> list[int] | None:
    return ids.values.to_numpy(zero_copy_only=False).tolist() if ids.is_valid else None


def _place(path: str | None) -> str:
    return path or public_tokenizers.path(VOCABULARY)


def encode(text: Column, path: str | None = None) -> Column:
    """The ids of a text, array<int>; an empty array for a null or empty text. path names a vocabulary file that every executor has."""

    @F.arrow_udf(ArrayType(IntegerType()))
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = vocabulary(_place(path))
        for texts in batches:
            ids = list(own.encode(texts.to_pylist()))
            ends = np.cumsum([0, *map(len, ids)], dtype=np.int64).astype(np.int32)
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, dtype=np.int32), *ids])))

    return run(text)


def decode(ids: Column, path: str | None = None) -> Column:
    """The text of an array of ids; null for null. Null ids in it, and ids that the vocabulary doesn't have, are left out."""

    @F.arrow_udf(StringType())
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = vocabulary(_place(path))
        for arrays in batches:
            yield pa.array([None if x is None else own.decode(x) for x in map(_listed, arrays)], pa.string())

    return run(ids)


def encoded(docs: DataFrame, text_col: str = "text", ids_out: str = "ids", path: str | None = None) -> DataFrame:
    """docs with the ids of its whole texts.

    Null texts count as empty ones and have no ids; rows that repeat are each encoded; an empty table gives none. A column of
    docs named as ids_out gives way, the others pass through.
    """
    small_batches(docs.sparkSession)
    return docs.select(*(c for c in docs.columns if c.lower() != ids_out.lower() or c == text_col), encode(F.col(text_col), path).alias(ids_out))


def digest(rows: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """Per row of encoded(): the id, its number of tokens, and SHA-256 of the ids as text and of the text decoded from them."""
    # One step for the ids, one for the text of these: the ids are made once and only then read twice.
    told = rows.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids")).withColumn("decoded", decode(F.col("ids"), path))
    return told.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
