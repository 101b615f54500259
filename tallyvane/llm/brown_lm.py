"""Class-based bigram language model: exchange clustering puts words in classes; class transitions times word emissions score a text.

P(word | class) P(class | previous class). Counts are over all training rows. What is kept for every word is its count
and its class, in a table; only the words above a share of all tokens (at most 1/share of them, however large the corpus)
are sent to the workers. The rare words' part of a score, and their classes, come from a join on the word.

Exchange clustering works on units: the most frequent words (again at most 1/share), and for the others a hash of their
last two bytes. Units are moved between classes while that raises the likelihood of the class bigrams. Then every other
word leaves its hash: the classes before and after it are counted over all training rows, and it goes to the class that
gains most by the same likelihood, once, all words against the units' classes. Transitions are counted after that. Words
that training doesn't have take their hash's class.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, LongType, StructField, StructType

from tallyvane.llm.common import small_batches, stored

CLASSES = 64
#: Words of at least this share of the training tokens are looked up in the workers: 500,000 words at most.
HEAVY = 2e-6
UNIT_SHARE = 1e-4
UNIT_WORDS = 1024
SUFFIXES = 256
DELTA = 0.1
ALPHA = 5.0
END = b"\x00end"
#: Bytes of text that a worker takes at once: words are numbered, and counts combined, within these.
CHUNK = 12_000_000
#: Rows of word contexts that a task merges at once.
HELD = 16_384


def tokens(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased. The end isn't among them; a null text has none."""
    return text.encode("utf-8", "replace").lower().split() if text else []


def _suffix(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % SUFFIXES


def _chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches put together until their texts have CHUNK bytes."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.column("text").nbytes
        if size >= CHUNK:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def _coded(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The distinct words of texts, the number of each word as it comes, and how many words each text has; words as tokens() has them."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat, sizes = lists.flatten(), np.diff(lists.offsets.to_numpy()).astype(np.int64)
    full = pc.greater(pc.binary_length(flat), 0)
    if not pc.all(full).as_py():  # white space at an end leaves an empty word
        sizes = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[full.to_numpy(zero_copy_only=False)], minlength=len(sizes))
        flat = flat.filter(full)
    coded = flat.dictionary_encode()
    return coded.dictionary.cast(pa.binary()).to_pylist(), coded.indices.to_numpy().astype(np.int64), sizes


def _with_ends(codes: np.ndarray, sizes: np.ndarray, end: int) -> np.ndarray:
    """All texts' codes in one line: an end before the first, and after each."""
    line = np.full(len(codes) + len(sizes) + 1, end, dtype=np.int64)
    line[np.arange(len(codes)) + np.repeat(np.arange(len(sizes)), sizes) + 1] = codes
    return line


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunk in _chunks(batches):
        names, codes, sizes = _coded(chunk.column("text"))
        n = np.append(np.bincount(codes, minlength=len(names)), len(sizes)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([*names, END], type=pa.binary()), pa.array(n)], names=["word", "n"])


def word_counts(texts: DataFrame) -> DataFrame:
    """Rows (word, n) over all of column text, with the ends under END."""
    return texts.select("text").mapInArrow(_count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Units:
    """Numbers of the clustered units: own ones for frequent words, then suffix hashes, then the end."""

    words: dict[bytes, int]

    @property
    def end(self) -> int:
        return len(self.words) + SUFFIXES

    def of(self, word: bytes) -> int:
        i = self.words.get(word)
        return (self.end if word == END else len(self.words) + _suffix(word)) if i is None else i


def unit_bigrams(texts: DataFrame, units: Units) -> DataFrame:
    """Rows (pair, n) of neighbouring units, pair = left * units + right; each text starts after an end."""
    shared = texts.sparkSession.sparkContext.broadcast(units)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = shared.value
        size = units.end + 1
        cells = np.zeros(size * size, dtype=np.int64)
        for chunk in _chunks(batches):
            names, codes, sizes = _coded(chunk.column("text"))
            ids = _with_ends(np.array([units.of(w) for w in names], dtype=np.int64)[codes], sizes, units.end)
            pairs, n = np.unique(ids[:-1] * size + ids[1:], return_counts=True)
            cells[pairs] += n
        found = np.flatnonzero(cells)
        for k in range(0, len(found), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(found[k : k + 100_000]), pa.array(cells[found[k : k + 100_000]])], names=["pair", "n"])

    return texts.select("text").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchange(bigrams: np.ndarray, classes: int, sweeps: int = 12) -> np.ndarray:
    """Class of each unit from a matrix of unit bigram counts; the last unit, the end, keeps a class of its own.

    Starts with the units dealt out by frequency, then moves one unit at a time to the class that raises
    sum N(c,d) log N(c,d) - sum N(c) log N(c) - sum N(d) log N(d) most, until a sweep moves nothing.
    """
    size = len(bigrams)
    weight = bigrams.sum(axis=0) + bigrams.sum(axis=1)
    order = [int(i) for i in np.argsort(-weight[:-1], kind="stable") if weight[i] > 0]
    of = np.zeros(size, dtype=np.int64)
    of[order] = np.arange(len(order)) % max(1, classes - 1)
    of[-1] = classes - 1
    member = np.zeros((size, classes))
    member[np.arange(size), of] = 1
    right, left = bigrams @ member, bigrams.T @ member  # of each unit: counts of the classes after and before it
    table = member.T @ right
    for _ in range(sweeps):
        moved = 0
        for u in order:
            a, own = of[u], bigrams[u, u]
            after, before = right[u].copy(), left[u].copy()
            after[a] -= own
            before[a] -= own
            table[a] -= after
            table[:, a] -= before
            table[a, a] -= own
            rows, cols = table.sum(axis=1), table.sum(axis=0)
            gain = (_xlogx(table + after) - _xlogx(table)).sum(axis=1) + (_xlogx(table + before[:, None]) - _xlogx(table)).sum(axis=0)
            diag = np.diag(table)
            gain += _xlogx(diag + after + before + own) - _xlogx(diag + after) - _xlogx(diag + before) + _xlogx(diag)
            gain -= _xlogx(rows + after.sum() + own) - _xlogx(rows) + _xlogx(cols + before.sum() + own) - _xlogx(cols)
            gain[-1] = -np.inf
            b = int(gain.argmax())
            table[b] += after
            table[:, b] += before
            table[b, b] += own
            if b != a:
                moved += 1
                of[u] = b
                right[:, a] -= bigrams[:, u]
                right[:, b] += bigrams[:, u]
                left[:, a] -= bigrams[u]
                left[:, b] += bigrams[u]
        if not moved:
            break
    return of


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, and how often each is there."""
    keys = np.sort(keys)
    edges = np.flatnonzero(np.diff(keys, prepend=keys[:1] - 1))
    return keys[edges], np.diff(edges, append=len(keys))


def _merged(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    edges = np.flatnonzero(np.diff(keys, prepend=keys[:1] - 1))
    return keys[edges], np.add.reduceat(n, edges) if len(edges) else n[:0]


def _pieces(data: np.ndarray, edges: np.ndarray) -> pa.Array:
    """A binary array of the data's pieces from each edge to the next, without copying any."""
    offsets = (np.append(edges, len(data)) * data.itemsize).astype("<i4")
    return pa.Array.from_buffers(pa.binary(), len(edges), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def word_contexts(texts: DataFrame, units: Units, class_of: np.ndarray, classes: int) -> DataFrame:
    """Rows (word, seen) of the words without a unit of their own, several of one word: seen is an array of 64-bit n << 16 | code.

    Codes under `classes` are the class of the unit before the word, those above, less `classes`, of the unit after it.
    """
    shared = texts.sparkSession.sparkContext.broadcast((units, class_of))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, of_unit = shared.value
        for chunk in _chunks(batches):
            names, codes, sizes = _coded(chunk.column("text"))
            kinds = np.array([of_unit[known.of(w)] for w in names] + [of_unit[known.end]], dtype=np.int64)
            free = np.array([w not in known.words for w in names] + [False])
            path = _with_ends(codes, sizes, len(names))
            at = np.flatnonzero(free[path])
            base, kind = path[at] * (2 * classes), kinds[path]
            keys, n = _counted(np.concatenate([base + kind[at - 1], base + classes + kind[at + 1]]))
            owner, seen = keys // (2 * classes), (n << 16 | keys % (2 * classes)).astype("<i8")
            edges = np.append(np.flatnonzero(np.diff(owner, prepend=-1)), len(owner))
            words = pa.array(names, type=pa.binary())
            for k in range(0, len(edges) - 1, 50_000):
                some = edges[k : k + 50_001]
                yield pa.RecordBatch.from_arrays([words.take(pa.array(owner[some[:-1]])), _pieces(seen[some[0] : some[-1]], some[:-1] - some[0])], names=["word", "seen"])

    return texts.select("text").mapInArrow(run, "word binary, seen binary")


def best_classes(owner: np.ndarray, code: np.ndarray, n: np.ndarray, first: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Class of each word by the gain in likelihood that exchange() takes, each against the units' classes as they stand.

    owner, code, n: sorted counts of word_contexts(), owners numbered from 0, none left out. first: the class of the
    word's unit, from which its own counts are taken before. The end's class, the last, takes none.
    """
    classes = len(table)
    cells = np.concatenate([table, table.T])  # by code, then by the class that the word may go to
    gained = lambda sums, x: _xlogx(sums + x) - _xlogx(sums)
    small = np.stack([gained(cells, x) for x in range(33)]).astype(np.float32)
    edges = np.searchsorted(owner, np.arange(len(first)))
    gain = np.zeros((len(first), classes))
    for lo in range(0, len(first), 4096):
        hi = min(lo + 4096, len(first))
        a, b = edges[lo], edges[hi] if hi < len(first) else len(owner)
        c, x, own = code[a:b], n[a:b], first[owner[a:b]]
        each = small[np.minimum(x, 32), c]
        big = x > 32
        each[big] = _xlogx(cells[c[big]] + x[big, None]) - _xlogx(cells[c[big]])
        each[np.arange(b - a), own] = _xlogx(cells[c, own]) - _xlogx(np.maximum(cells[c, own] - x, 0))
        gain[lo:hi] = np.add.reduceat(each, edges[lo:hi] - a, axis=0)
    total = np.bincount(owner[code < classes], weights=n[code < classes], minlength=len(first))
    for sums in (table.sum(axis=1), table.sum(axis=0)):
        lost = np.stack([gained(sums, x) for x in range(33)])[np.minimum(total, 32).astype(np.int64)]
        lost[total > 32] = gained(sums, total[total > 32, None])
        lost[np.arange(len(first)), first] = _xlogx(sums[first]) - _xlogx(np.maximum(sums[first] - total, 0))
        gain -= lost
    gain[:, -1] = -np.inf
    return gain.argmax(axis=1)


def classified(contexts: DataFrame, units: Units, class_of: np.ndarray, table: np.ndarray) -> DataFrame:
    """Rows (word, n, class), one for each word of word_contexts()."""
    shared = contexts.sparkSession.sparkContext.broadcast((units, class_of, table))

    def merged(held: list[pa.RecordBatch]) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
        """Of rows in order of their words: the words, and by number of the word and code the counts."""
        classes = len(shared.value[2])
        batch = pa.concat_batches(held)
        words, lists = batch.column("word").dictionary_encode(), batch.column("seen")
        edges = np.frombuffer(lists.buffers()[1], dtype="<i4", count=len(lists) + 1, offset=4 * lists.offset).astype(np.int64)
        seen = np.frombuffer(lists.buffers()[2], dtype="<i8", count=(edges[-1] - edges[0]) // 8, offset=edges[0])
        parts = np.repeat(words.indices.to_numpy(), np.diff(edges) // 8).astype(np.int64)
        keys, n = _merged(parts * (2 * classes) + (seen & 0xFFFF), seen >> 16)
        return words.dictionary, keys // (2 * classes), keys % (2 * classes), n

    def placed(words: pa.Array, owner: np.ndarray, code: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        known, of_unit, cells = shared.value
        first = np.array([of_unit[known.of(w)] for w in words.to_pylist()], dtype=np.int64)
        before = code < len(cells)
        total = np.bincount(owner[before], weights=n[before], minlength=len(words)).astype(np.int64)
        own = best_classes(owner, code, n, first, cells).astype(np.int32)
        return pa.RecordBatch.from_arrays([words, pa.array(total), pa.array(own)], names=["word", "n", "class"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last word of what is held may go on: it stays behind, its rows made one.
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += len(batch)
            if rows >= HELD:
                words, owner, code, n = merged(held)
                at = np.searchsorted(owner, len(words) - 1)
                if len(words) > 1:
                    yield placed(words[:-1], owner[:at], code[:at], n[:at])
                held, rows = [pa.RecordBatch.from_arrays([words[-1:], _pieces((n[at:] << 16 | code[at:]).astype("<i8"), np.zeros(1, dtype=np.int64))], schema=batch.schema)], 1
        if rows:
            yield placed(*merged(held))

    # Sorted, so that a word's rows are read one after the other and none of them grows with the corpus.
    return contexts.repartition("word").sortWithinPartitions("word").mapInArrow(run, "word binary, n long, class int")


@dataclass
class Model:
    units: Units
    class_of: np.ndarray  # of units; that of a suffix is taken for words that training hasn't
    transition: np.ndarray  # log10 P(class | class before)
    emission_norm: np.ndarray  # log10 of a class's tokens with smoothing
    heavy: dict[bytes, int]
    heavy_class: dict[bytes, int]
    total: int
    distinct: int

    @property
    def base_norm(self) -> float:
        return float(np.log10(self.total + DELTA * (self.distinct + 1)))


def _clusters(texts: DataFrame, classes: int, heavy_share: float) -> tuple[Model, DataFrame]:
    """The model but for its transitions, and the table (word, n, class) of all words."""
    spark = texts.sparkSession
    counts = stored(word_counts(texts))
    sums = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.count("*").alias("distinct")).first()
    total, distinct = int(sums["total"]), int(sums["distinct"])
    if total == 0:
        units = Units({})
        return Model(units, np.zeros(units.end + 1, dtype=np.int64), np.zeros((1, 1)), np.array([np.log10(DELTA)]), {}, {}, 0, 0), counts.withColumn("class", F.lit(0))
    top = counts.where((F.col("n") >= max(1.0, UNIT_SHARE * total)) | (F.col("word") == F.lit(END))).toPandas().sort_values(["n", "word"], ascending=[False, True])
    frequent = dict(zip(map(bytes, top["word"]), map(int, top["n"]), strict=True))
    chosen = [w for w in frequent if w != END][:UNIT_WORDS]
    units = Units({w: i for i, w in enumerate(chosen)})
    size = units.end + 1

    cells = unit_bigrams(texts, units).toPandas()
    bigrams = np.zeros(size * size)
    bigrams[cells["pair"].to_numpy()] = cells["n"].to_numpy()
    bigrams = bigrams.reshape(size, size)
    class_of = exchange(bigrams, classes)
    member = np.zeros((size, classes))
    member[np.arange(size), class_of] = 1

    rest = classified(word_contexts(texts, units, class_of, classes), units, class_of, member.T @ bigrams @ member)
    own = spark.createDataFrame([(w, frequent[w], int(class_of[units.of(w)])) for w in [*chosen, END]], rest.schema)
    words = stored(rest.unionByName(own))
    per_class = words.groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("kinds")).toPandas()
    tokens_in, kinds_in = np.zeros(classes), np.zeros(classes)
    tokens_in[per_class["class"]], kinds_in[per_class["class"]] = per_class["n"], per_class["kinds"]
    # The end is always looked up: texts may be so long that it is rare.
    found = words.where((F.col("n") >= max(1.0, heavy_share * total)) | (F.col("word") == F.lit(END))).toPandas().sort_values(["n", "word"], ascending=[False, True])
    names = [bytes(w) for w in found["word"]]
    heavy, heavy_class = dict(zip(names, map(int, found["n"]), strict=True)), dict(zip(names, map(int, found["class"]), strict=True))
    share = (tokens_in + DELTA) / (total + DELTA * classes)
    return Model(units, class_of, np.tile(np.log10(share), (classes, 1)), np.log10(tokens_in + DELTA * (kinds_in + 1)), heavy, heavy_class, total, distinct), words


def _with_transitions(model: Model, paths: DataFrame) -> Model:
    """The model with transitions counted over paths; until then each row of them is the share of the classes."""
    classes = len(model.transition)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cells = np.zeros(classes * classes, dtype=np.int64)
        for batch in batches:
            for path in batch["path"]:
                p = np.frombuffer(path, dtype="<u2").astype(np.int64)
                cells += np.bincount(p[:-1] * classes + p[1:], minlength=len(cells))
        found = np.flatnonzero(cells)
        yield pd.DataFrame({"pair": found, "n": cells[found]})

    pairs = paths.select("path").mapInPandas(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toPandas()
    table = np.zeros(classes * classes)
    table[pairs["pair"]] = pairs["n"]
    table = table.reshape(classes, classes)
    return replace(model, transition=np.log10((table + ALPHA * 10**model.transition) / (table.sum(axis=1, keepdims=True) + ALPHA)))


def fit(train: DataFrame, text_col: str = "text", classes: int = CLASSES, heavy_share: float = HEAVY) -> tuple[Model, DataFrame]:
    """The model, and the table (word, n, class) that belongs to it. An empty table gives a model by which every word is unseen."""
    small_batches(train.sparkSession)
    texts = train.select(F.col(text_col).alias("text"))
    model, words = _clusters(texts, classes, heavy_share)
    return (_with_transitions(model, _paths(texts, model, words, "text")) if model.total else model), words


def _looked_up(model, keep: int):
    """Rows of two kinds: one for each text, with its kept columns, its sums over frequent words and its path of classes; one for each of its rare words."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = model.value
        units, class_of, classes = m.units, m.class_of, m.heavy_class
        logs = dict(zip(m.heavy, np.log10(np.array(list(m.heavy.values()), dtype=np.float64) + DELTA).tolist(), strict=True))
        suffix_class = [int(class_of[len(units.words) + s]) for s in range(SUFFIXES)]
        start, end_log = int(class_of[units.end]), float(np.log10(m.heavy.get(END, 0) + DELTA))
        names, inner = ["row", "word", "at", "doc"], ["n", "known", "words_log", "path", *(f"k{i}" for i in range(keep))]
        for batch in _chunks(batches):
            words, path, sizes = _coded(batch.column("text"))
            texts = len(sizes)
            kind = np.array([classes[w] if w in classes else suffix_class[_suffix(w)] for w in words], dtype="<u2")
            each = np.array([logs.get(w, np.nan) for w in words])[path]
            owner = np.repeat(np.arange(texts), sizes)
            rare = np.isnan(each)
            known = sizes - np.bincount(owner[rare], minlength=texts) + (END in m.heavy)
            total = np.bincount(owner, weights=np.where(rare, 0.0, each), minlength=texts) + end_log
            line = np.full(len(path) + 2 * texts, start, dtype="<u2")
            line[np.arange(len(path)) + 2 * owner + 1] = kind[path]
            rows = batch.column("row").to_numpy()
            # No word holds a space: this key joins nothing, and deals out the texts.
            key = pa.array([b" %d" % r for r in rows.tolist()], type=pa.binary())
            kept = [batch.column(f"k{i}") for i in range(keep)]
            # What only texts have is one column, so that the many rows of rare words are narrow.
            doc = pa.StructArray.from_arrays([pa.array(sizes + 1), pa.array(known.astype(np.int64)), pa.array(total), _pieces(line, np.cumsum(sizes + 2) - sizes - 2), *kept], names=inner)
            yield pa.RecordBatch.from_arrays([pa.array(rows), key, pa.nulls(texts, pa.binary()), doc], names=names)
            at = np.flatnonzero(rare)
            if not len(at):
                continue
            whose = owner[at] * len(words) + path[at]
            order = np.argsort(whose, kind="stable")
            at, whose = at[order], whose[order]
            edges = np.append(np.flatnonzero(np.diff(whose, prepend=-1)), len(at))
            place = (at - (np.cumsum(sizes) - sizes)[owner[at]] + 1).astype("<i4")
            every = pa.array(words, type=pa.binary())
            for k in range(0, len(edges) - 1, 50_000):
                some = edges[k : k + 50_001]
                first = at[some[:-1]]
                found = [pa.array(rows[owner[first]]), every.take(pa.array(path[first])), _pieces(place[some[0] : some[-1]], some[:-1] - some[0]), pa.nulls(len(first), doc.type)]
                yield pa.RecordBatch.from_arrays(found, names=names)

    return run


def _filled(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Puts the classes of rare words in the paths."""
    for batch in batches:
        paths = []
        for path, found, at in zip(batch["path"], batch["found"], batch["at"], strict=True):
            if len(at):
                own = np.frombuffer(path, dtype="<u2").copy()
                each = np.repeat(np.asarray(found, dtype=np.int64), [len(x) // 4 for x in at])
                where = np.frombuffer(b"".join(at), dtype="<i4")
                own[where[each >= 0]] = each[each >= 0]
                path = own.tobytes()
            paths.append(path)
        yield batch.drop(columns=["found", "at"]).assign(path=paths)


def _kept(docs: DataFrame, text_col: str) -> list[StructField]:
    made = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    return [f for f in docs.schema.fields if f.name != text_col and f.name.lower() not in made]


def _paths(docs: DataFrame, model: Model, words: DataFrame, text_col: str) -> DataFrame:
    """Of each row: n_tokens, n_known, words_log, the classes of its words between two ends (path), and the kept columns as k0, k1, and so on."""
    keep = _kept(docs, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [StructField(f"k{i}", f.dataType) for i, f in enumerate(keep)]
    doc = StructType([StructField("n", LongType()), StructField("known", LongType()), StructField("words_log", DoubleType()), StructField("path", BinaryType()), *kept])
    schema = StructType([StructField("row", LongType()), StructField("word", BinaryType()), StructField("at", BinaryType()), StructField("doc", doc)])
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(text_col).alias("text"), *(F.col(f.name).alias(f"k{i}") for i, f in enumerate(keep)))
    parts = rows.mapInArrow(_looked_up(shared, len(keep)), schema)
    counted = parts.join(words.select("word", F.col("n").alias("c"), F.col("class").alias("found")), "word", "left")
    count, times = F.coalesce("c", F.lit(0)), F.octet_length("at") / 4
    # All lists skip the texts' own rows, so they go in one order.
    sums = counted.groupBy("row").agg(
        F.first("doc", ignorenulls=True).alias("doc"),
        F.sum(F.when(count > 0, times).otherwise(0.0)).alias("known"),
        F.sum(times * F.log10(count + DELTA)).alias("log"),
        F.collect_list(F.when(F.col("at").isNotNull(), F.coalesce("found", F.lit(-1)))).alias("found"),
        F.collect_list("at").alias("at"),
    )
    sums = sums.select(
        F.col("doc.n").alias("n_tokens"),
        (F.col("doc.known") + F.coalesce("known", F.lit(0.0)).cast("long")).alias("n_known"),
        (F.col("doc.words_log") + F.coalesce("log", F.lit(0.0))).alias("words_log"),
        F.col("doc.path").alias("path"),
        "found",
        "at",
        *(F.col(f"doc.k{i}").alias(f"k{i}") for i in range(len(keep))),
    )
    out = StructType([StructField("n_tokens", LongType()), StructField("n_known", LongType()), StructField("words_log", DoubleType()), StructField("path", BinaryType()), *kept])
    return sums.mapInPandas(_filled, out)


def _scores(paths: DataFrame, model: Model, keep: list[StructField]) -> DataFrame:
    shared = paths.sparkSession.sparkContext.broadcast((model.transition, model.emission_norm))

    @F.pandas_udf(DoubleType())
    def flow(column: pd.Series) -> pd.Series:
        transition, norm = shared.value
        each = (np.frombuffer(x, dtype="<u2") for x in column)
        return pd.Series([float(transition[p[:-1], p[1:]].sum() - norm[p[1:]].sum()) for p in each], dtype="float64")

    return paths.select(
        *(F.col(f"k{i}").alias(f.name) for i, f in enumerate(keep)),
        F.col("n_tokens"),
        F.col("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"),
        (F.col("words_log") - F.col("n_tokens") * F.lit(model.base_norm)).alias("base_score"),
        (F.col("words_log") + flow("path")).alias("score"),
    )


def score(docs: DataFrame, model: Model, words: DataFrame, text_col: str = "text") -> DataFrame:
    """docs' rows, one out for each in, with n_tokens, n_known, train_tokens, base_score and score.

    Texts stay where they are; what is shuffled are the rare words of each row, and the classes of its words. A null text
    is empty: its only token is the end. Repeated rows are scored each for itself. A column of docs that is named like a
    result gives way to it.
    """
    small_batches(docs.sparkSession)
    return _scores(_paths(docs, model, words, text_col), model, _kept(docs, text_col))


def fit_and_score(docs: DataFrame, held_out: str, text_col: str = "text", classes: int = CLASSES, heavy_share: float = HEAVY) -> DataFrame:
    """score() of docs by fit() of the rows that aren't held out; the words' classes are looked up once for both."""
    small_batches(docs.sparkSession)
    model, words = _clusters(docs.where(~F.col(held_out)).select(F.col(text_col).alias("text")), classes, heavy_share)
    if not model.total:
        return score(docs, model, words, text_col)
    keep = _kept(docs, text_col)
    paths = stored(_paths(docs, model, words, text_col))
    mark = f"k{[f.name for f in keep].index(held_out)}"
    return _scores(paths, _with_transitions(model, paths.where(~F.col(mark))), keep)
