"""Packing by cutting-stock column generation.

Every document becomes token ids with an end id; what is over the sequence length is cut off in full pieces, the rest
of it is an item. Items are counted by length class, and the linear program over packing patterns (how many items of
each class fill one sequence) is solved by column generation: an unbounded knapsack over the length prices new
patterns. Whole multiples of the patterns are used, what rounding leaves is packed first-fit decreasing, and every
class's items are dealt to the pattern places by their rank.

The program has one row for each length class, whatever the number of documents. Ranks come from counts of (class,
slice) and a window inside each slice, so a class that holds a third of all items is not one task's.
"""

from __future__ import annotations

import sys
import zlib
from array import array
from collections.abc import Iterator
from functools import cache
from math import gcd
from unicodedata import normalize

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType
from tokenizers import Tokenizer

from tallyvane.llm.common import cut, small_batches

LENGTH = 2048
END_ID = 1
SLICES = 256
WIDTH = 16
VOCABULARY = "word_bpe_49k.json"
_CACHE = 450_000


def _shown() -> dict[int, int]:
    """How byte-level vocabularies write bytes: printable ones as they are, the others from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    return {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in plain)}


_SHOWN = _shown()


class ChunkIds(dict):
    """Token ids, as little-endian bytes, of text between white space: in this vocabulary nothing reaches over white space.

    Kept for chunks met before, in two generations of bounded size: a full one becomes the older. Words of letters go to
    the library's model itself, lower-cased and in its alphabet; the rest through all its steps.
    """

    def __init__(self, tokenizer: Tokenizer):
        self.encode, self.model, self.older = tokenizer.encode, tokenizer.model, {}

    def __missing__(self, chunk: str) -> bytes:
        ids = self.older.get(chunk) or self._made(chunk)
        if len(self) >= _CACHE:
            self.older = dict(self)
            self.clear()
        self[chunk] = ids
        return ids

    def _made(self, chunk: str) -> bytes:
        if chunk.isalpha():
            low = normalize("NFC", chunk).lower()
            if low != chunk:
                if low.isalpha() and "Σ" not in chunk:  # Python lowers a final sigma by its place
                    return self[low]
            else:
                shown = low if low.isascii() else low.encode().decode("latin-1").translate(_SHOWN)
                return self.pack([t.id for t in self.model.tokenize(shown)])
        elif chunk[-1] in ".," and normalize("NFC", chunk[:-1]).lower().isalpha():
            return self[chunk[:-1]] + self[chunk[-1]]
        return self.pack(self.encode(chunk, add_special_tokens=False).ids)

    @staticmethod
    def pack(ids: list[int]) -> bytes:
        out = array("I", ids)
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()


@cache
def chunk_ids(path: str) -> ChunkIds:
    return ChunkIds(Tokenizer.from_file(path))


# What Python takes for white space and the vocabulary's pattern doesn't.
_NOT_SPACE = ("\x1c", "\x1d", "\x1e", "\x1f")


def token_bytes(text: str | None, chunks: ChunkIds) -> bytes:
    """A document's ids, its end id last, four bytes each."""
    end = END_ID.to_bytes(4, "little")
    if not text:
        return end
    if any(c in text for c in _NOT_SPACE):
        return ChunkIds.pack(chunks.encode(text, add_special_tokens=False).ids) + end
    return b"".join(map(chunks.__getitem__, text.split())) + end


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, path: str | None = None) -> DataFrame:
    """Rows (doc_id, start, length, ids_crc32, doc_tokens): full pieces from a document's start, then the rest of it."""
    small_batches(docs.sparkSession)
    vocabulary, name = path or VOCABULARY, path is None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        chunks = chunk_ids(public_tokenizers.path(vocabulary) if name else vocabulary)
        for batch in batches:
            rows = []
            for doc, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = token_bytes(text, chunks)
                n = len(ids) // 4
                rows += [(doc, a, min(length, n - a), zlib.crc32(ids[4 * a : 4 * min(a + length, n)]), n) for a in range(0, n, length)]
            yield pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    kind = docs.schema[id_col].dataType
    schema = StructType([StructField("doc_id", kind), *(StructField(c, LongType()) for c in ("start", "length", "ids_crc32", "doc_tokens"))])
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInPandas(run, schema)


def width(length: int = LENGTH) -> int:
    """Items are counted by their length rounded up to this; a piece wastes half of it in the mean."""
    return gcd(length, WIDTH)


def _price(values: np.ndarray, sizes: np.ndarray, length: int) -> np.ndarray:
    """The most valuable pattern by dynamic programming over the filled length: copies of each class."""
    best, took = np.zeros(length + 1), np.full(length + 1, -1)
    order = np.argsort(sizes)
    sizes_up, values_up = sizes[order], values[order]
    fit = np.searchsorted(sizes_up, np.arange(length + 1), side="right")
    for w in range(1, length + 1):
        best[w] = best[w - 1]
        if k := fit[w]:
            gain = best[w - sizes_up[:k]] + values_up[:k]
            i = int(gain.argmax())
            if gain[i] > best[w] + 1e-12:
                best[w], took[w] = gain[i], order[i]
    pattern, w = np.zeros(len(sizes), dtype=np.int64), length
    while w > 0:
        if took[w] < 0:
            w -= 1
        else:
            pattern[took[w]] += 1
            w -= sizes[took[w]]
    return pattern


def _first_fit(counts: np.ndarray, sizes: np.ndarray, length: int) -> list[tuple[np.ndarray, int]]:
    """Patterns by greedy filling, largest class first, each repeated while the counts allow it."""
    left, out = counts.copy(), []
    while left.any():
        pattern, room = np.zeros(len(sizes), dtype=np.int64), length
        for i in np.argsort(-sizes):
            k = min(left[i], room // sizes[i])
            pattern[i] = k
            room -= k * sizes[i]
        times = int(min(left[i] // pattern[i] for i in np.flatnonzero(pattern)))
        left = left - times * pattern
        out.append((pattern, times))
    return out


def patterns(counts: np.ndarray, sizes: np.ndarray, length: int, rounds: int = 4000) -> list[tuple[np.ndarray, int]]:
    """Patterns with how often each is used; together they hold counts exactly.

    The revised simplex method over the patterns found so far, one entering column a round, priced by the knapsack. It
    ends when no pattern prices below one sequence, or after `rounds` with the solution it has.
    """
    used = np.flatnonzero(counts)
    if not len(used):
        return []
    size, need = sizes[used], counts[used].astype(float)
    m = len(used)
    basis = np.diag((length // size).astype(float))  # its columns are patterns of one class alone
    inverse = np.diag(1 / np.diag(basis))
    x = inverse @ need
    for _ in range(rounds):
        duals = inverse.sum(axis=0)
        column = _price(np.maximum(duals, 0), size, length).astype(float)
        if duals @ column <= 1 + 1e-7:
            break
        step = inverse @ column
        rising = step > 1e-9
        if not rising.any():
            break
        ratio = np.full(m, np.inf)
        ratio[rising] = x[rising] / step[rising]
        out = int(ratio.argmin())
        x = x - ratio[out] * step
        x[out] = ratio[out]
        x = np.maximum(x, 0)
        basis[:, out] = column
        row = inverse[out] / step[out]
        inverse -= np.outer(step, row)
        inverse[out] = row
    left, found = counts[used].astype(np.int64), []
    for j in np.argsort(-x):
        pattern = np.round(basis[:, j]).astype(np.int64)
        fits = pattern > 0
        times = int(min(np.floor(x[j] + 1e-9), (left[fits] // pattern[fits]).min())) if fits.any() else 0
        if times > 0:
            found.append((pattern, times))
            left = left - times * pattern
    found += _first_fit(left, size, length)
    out = []
    for pattern, times in found:
        whole = np.zeros(len(sizes), dtype=np.int64)
        whole[used] = pattern
        out.append((whole, times))
    return out


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, path: str | None = None, slices: int = SLICES) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id and the piece's offset in the sequence.

    A null text is an empty one: its only id is the end. Rows with the same id, or none, are each packed. An empty table
    gives no rows. Very long texts are full pieces and a rest. Other columns aren't read, whatever their names. path: the vocabulary; the public word vocabulary where it is None. slices: so many tasks rank
    the pieces of one length class side by side; the driver holds a count for each.
    """
    all_pieces = pieces(docs, id_col, text_col, length, path)
    step = width(length)
    units = length // step
    salted = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(slices)).cast("int")
    sized = (F.ceil(F.col("length") / step) - 1).cast("int")
    made = cut(all_pieces.withColumn("cls", sized).withColumn("slice", salted))

    tally = made.groupBy("cls", "slice").agg(F.count("*").alias("n")).toPandas().sort_values(["cls", "slice"])
    tally["before"] = tally.groupby("cls")["n"].cumsum() - tally["n"]
    counts = np.zeros(units, dtype=np.int64)
    np.add.at(counts, tally["cls"].to_numpy(dtype=int), tally["n"].to_numpy(dtype=np.int64))

    plan, first = [], 0
    rank_from = np.zeros(units, dtype=np.int64)
    for pattern, times in patterns(counts, np.arange(1, units + 1), units):
        slot = 0
        for c in np.flatnonzero(pattern)[::-1]:
            plan.append((int(c), int(rank_from[c]), int(rank_from[c] + times * pattern[c]), int(pattern[c]), first, slot))
            rank_from[c] += times * pattern[c]
            slot += int(pattern[c])
        first += times
    table = np.array(plan, dtype=np.int64).reshape(-1, 6)
    starts = {int(c): tuple(int(n) for n in tally[tally["cls"] == c].set_index("slice").reindex(range(slices), fill_value=0)["before"]) for c in tally["cls"].unique()}
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((table, starts))

    @F.pandas_udf(StructType([StructField("sequence_id", LongType()), StructField("slot", LongType())]))
    def placed(cls: pd.Series, part: pd.Series, rank: pd.Series) -> pd.DataFrame:
        rows, before = shared.value
        out = np.zeros((len(cls), 2), dtype=np.int64)
        cls, part, rank = (x.to_numpy(dtype=np.int64) for x in (cls, part, rank))
        for c in np.unique(cls):
            own = cls == c
            r = rank[own] - 1 + np.array(before[int(c)], dtype=np.int64)[part[own]]
            mine = rows[rows[:, 0] == c]
            at = mine[np.searchsorted(mine[:, 1], r, side="right") - 1]
            out[own, 0] = at[:, 4] + (r - at[:, 1]) // at[:, 3]
            out[own, 1] = at[:, 5] + (r - at[:, 1]) % at[:, 3]
        return pd.DataFrame(out, columns=["sequence_id", "slot"])

    ranked = made.withColumn("rank", F.row_number().over(Window.partitionBy("cls", "slice").orderBy("doc_id", "start", "ids_crc32")))
    there = ranked.withColumn("at", placed("cls", "slice", "rank")).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "at.sequence_id", "at.slot")
    before = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    return there.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long")).drop("slot")
