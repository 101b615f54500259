"""Whitening, byte-pair encoding and hard negatives against brute force, the library and round trips, and at the edges."""

import hashlib
import itertools
import os
import random
import sys

import numpy as np
import public_tokenizers
import pytest
import tokenizers
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from oracle import database, same  # noqa: E402

from tallyvane.llm import bpe, negatives, queries, whitening  # noqa: E402

DATA = "/root/testdata/sf0.001"
NAN, INF = float("nan"), float("inf")


# --- byte-pair encoding


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(public_tokenizers.path(bpe.VOCABULARY))


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(public_tokenizers.path(bpe.VOCABULARY))


def odd_texts():
    rng = random.Random(5)
    return [
        None, "", " ", "\n\n \n", "a" * 1001, "a" * 257, "ab" * 3000, "x" * 50000, "word " * 20000, "".join(rng.choice("abcdefgh") for _ in range(20000)),
        "<|endoftext|> hi<|endoftext|><|endoftext|>x", "<|endoftext", "it's I'LL we'd  don''t", " \x1c\x1d a\x85b　c  d᠎",
        "½²Ⅷ一二三 \U0001d7d8\U00010107 \U0001f600\U0001f468‍\U0001f469", "՘ᲊ\U000323b0x 1Ƛb", "é́ ŠΣ ß", "\x00\x01�￿",
        "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and rng.random() < 0.02),
    ]


def test_ids_equal_the_library(library, vocabulary, spark):
    texts = odd_texts() + [r["text"] for r in spark.read.parquet(f"{DATA}/documents.parquet").select("text").collect()]
    got = [x.tolist() for x in vocabulary.encode(texts)]
    assert got == [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [vocabulary.decode(g) for g in got] == [library.decode(g, skip_special_tokens=False) for g in got] == [t or "" for t in texts]


def test_both_ways_of_merging_agree(vocabulary):
    rng = random.Random(2)
    words = ["".join(rng.choice("aabtheeéñ ") for _ in range(rng.randint(1, 300))) for _ in range(400)]
    raw = [w.encode() for w in words]
    assert vocabulary._rounds(raw) == [vocabulary._linked(r) for r in raw]


def test_few_kept_words_change_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT", 20)
    monkeypatch.setattr(bpe, "KEPT_CHARS", 3)
    monkeypatch.setattr(bpe, "TOGETHER", 50)
    own, rng = bpe.Vocabulary(public_tokenizers.path(bpe.VOCABULARY)), random.Random(3)
    texts = [" ".join(rng.choice(["one", "two", "longer", "<|endoftext|>", str(rng.random())]) for _ in range(30)) for _ in range(40)]
    assert [x.tolist() for x in own.encode(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(own.known) < 200


def test_overlapping_pairs_merge_from_the_left():
    assert bpe._apart(np.array([0, 1, 2, 3, 7, 8, 20]), 1).tolist() == [0, 2, 7, 20]


def test_a_token_of_two_merges_is_refused(tmp_path):
    tokenizer = tokenizers.Tokenizer(tokenizers.models.BPE(vocab={c: i for i, c in enumerate([*(chr(x) for x in bpe._shown().values()), "ab", "bc", "abc"])}, merges=[("a", "b"), ("b", "c"), ("ab", "c"), ("a", "bc")]))
    tokenizer.save(str(tmp_path / "own.json"))
    with pytest.raises(ValueError):
        bpe.Vocabulary(str(tmp_path / "own.json"))


def test_bpe_query(spark, library):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").toPandas()
    want = {}
    for i, t in zip(docs["doc_id"], docs["text"], strict=True):
        ids = library.encode(t or "", add_special_tokens=False).ids
        want[i] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest())
    assert {r["doc_id"]: tuple(r)[1:] for r in queries.op12_bpe_encoding(spark, DATA).collect()} == want


def test_bpe_at_the_edges(spark, library):
    texts = odd_texts()
    rows = spark.createDataFrame([(i, t, "mine") for i, t in enumerate(texts)] + [(None, "twice", "a"), (None, "twice", "a")], "doc_id long, text string, Ids string")
    out = bpe.encoded(rows)
    assert out.columns == ["doc_id", "text", "ids"]
    got = out.collect()
    assert [r["ids"] for r in got if r["doc_id"] is None] == [library.encode("twice").ids] * 2
    by = {r["doc_id"]: r["ids"] for r in got}
    assert by[0] == by[1] == [] and all(by[i] == library.encode(t or "", add_special_tokens=False).ids for i, t in enumerate(texts))
    assert bpe.encoded(rows.where("false")).count() == 0
    told = bpe.digest(out).where("doc_id = 0").first()
    assert told["n_tokens"] == 0 and told["ids_sha256"] == told["decoded_sha256"] == hashlib.sha256(b"").hexdigest()
    ids = spark.createDataFrame([([64, None, 10**6, 65],), ([],), (None,), ([94],)], "ids array<int>")
    assert [r["t"] for r in ids.select(bpe.decode(F.col("ids")).alias("t")).collect()] == ["ab", "", None, "�"]


# --- whitening


def spectrum(values, seed=1):
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))[0]
    return q @ np.diag(np.array(values, dtype=float)) @ q.T


@pytest.mark.parametrize("d", [1, 2, 5, 9, 16, 17, 40, 200])
def test_eigenpairs_equal_a_full_decomposition(d):
    a = np.random.default_rng(d).standard_normal((d, 3 * d))
    v = a @ a.T
    found = whitening.eigenpairs(lambda w: v @ w, d, 8)
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:8], u[:, ::-1][:, :8]
    assert len(found.values) == min(d, 8) and np.allclose(found.values, e, rtol=1e-12)
    assert np.abs(np.abs((found.vectors * u).sum(axis=0)) - 1).max() < 1e-12
    assert found.residuals.max() <= 64 * whitening.RESIDUAL * e[0]


@pytest.mark.parametrize("values", [[1.0] * 30, [5, 5, 5, 5, *[1.0] * 20], [9, 4, 1, *[0.0] * 30], [1e8, 3, 2, 1, *[0.5] * 20], [1 + 1e-9 * i for i in range(30)], [0.0] * 12])
def test_eigenpairs_of_repeated_and_missing_values(values):
    v = spectrum(values)
    found = whitening.eigenpairs(lambda w: v @ w, len(values), 8)
    q = found.vectors
    assert np.allclose(found.values, sorted(values, reverse=True)[:8], atol=1e-12 * max(max(values), 1))
    assert np.allclose(q.T @ q, np.eye(8), atol=1e-12) and np.allclose(v @ q, q * found.values, atol=1e-11 * max(max(values), 1))


def test_minres_solves_side_by_side():
    a = spectrum([5, 4, -3, 2, 1, -1, 0.5, 3])
    b = np.random.default_rng(4).standard_normal((8, 3))
    b[:, 1] = 0
    assert np.allclose(whitening.minres(lambda x: a @ x, b, 20, 1e-12), np.linalg.solve(a, b), atol=1e-9)


def brute_whitening(vectors):
    x = [[int(np.floor(1024 * np.float64(c))) + 100_000 for c in v] for v in vectors]
    n = len(x)
    sums = [sum(c) for c in zip(*x, strict=True)]
    centred = np.array([[(n * c - s) / n for c, s in zip(r, sums, strict=True)] for r in x])
    e, u = np.linalg.eigh(centred.T @ centred / n)
    return [sum((n * c - s) ** 2 for c, s in zip(r, sums, strict=True)) for r in x], centred @ u[:, ::-1][:, :8] / np.sqrt(e[::-1][:8]), e[::-1][:8] / e.sum()


def test_whitening_query(spark):
    rows = [r for r in spark.read.parquet(f"{DATA}/embeddings.parquet").collect() if r["embedding"] is not None]
    got = queries.op11_embedding_whitening(spark, DATA).toPandas()
    deviation, whitened, explained = brute_whitening([r["embedding"] for r in rows])
    assert len(got) == 8 * len(rows) and set(got["n"]) == {len(rows)} and got["identity_error"].max() < 1e-12
    wide = got.pivot(index="vec_id", columns="component", values="whitened").loc[[r["vec_id"] for r in rows]].to_numpy()
    sign = np.sign((wide * whitened).sum(axis=0))
    assert np.allclose(wide, whitened * sign, atol=1e-9)
    assert got.drop_duplicates("vec_id").set_index("vec_id")["deviation"].loc[[r["vec_id"] for r in rows]].tolist() == deviation
    assert np.allclose(got.drop_duplicates("component").sort_values("component")["explained"], explained, rtol=1e-10)


SCHEMA = "vec_id long, embedding array<float>, x string"


def test_whitening_at_the_edges(spark):
    good = [(i, [float(i % 3), float(i * i % 7), 1.0], "mine") for i in range(20)] + [(3, [0.0, 2.0, 1.0], "mine"), (None, [1.0, 1.0, 1.0], None)]
    bad = [(90, None, ""), (91, [1.0, None, 2.0], ""), (92, [1.0, NAN, 2.0], ""), (93, [INF, 1.0, 2.0], ""), (94, [], ""), (95, [1.0, 2.0], ""), (96, [1e30, 0.0, 0.0], "")]
    got = whitening.digest(spark.createDataFrame(good + bad, SCHEMA)).toPandas()
    assert len(got) == 2 * len(good) and set(got["n"]) == {len(good)} and got["component"].max() == 2  # the third entry doesn't vary
    assert sorted(set(got["deviation"])) == sorted(set(brute_whitening([v for _, v, _ in good])[0])) and got["identity_error"].max() < 1e-12
    for rows in ([], bad[:5], [(1, [1.0, 2.0], "")], [(i, [1.0, 2.0], "") for i in range(5)]):
        out = whitening.digest(spark.createDataFrame(rows, SCHEMA))
        assert out.count() == 0 and out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_deviations_that_a_long_cannot_hold():
    m = whitening.Moments(1 << 31, [0, 1 << 31], [-(1 << 20), 0], [1 << 20, 2])
    x = np.array([[0, 1], [1, 1], [1 << 20, 0]])
    assert m.deviations(x) == [0, 1 << 62, None]
    small = whitening.Moments(3, [10, -10], [0, -9], [9, 0])
    assert small.deviations(np.array([[4, -4]])) == [8] and np.allclose(small.centred(np.array([[4, -4]])), [[2 / 3, -2 / 3]])


# --- hard negatives


def brute_negatives(rows, k=5):
    out, rows = [], sorted(set((i, label, tuple(int(np.floor(256 * c)) for c in v)) for i, label, v in rows))
    for i, label, x in rows:
        if i % 100:
            continue
        scored = sorted((-sum(a * b for a, b in zip(x, y, strict=True)), j, other == label) for j, other, y in rows if j != i)
        for p, j, _ in [s for s in scored if s[2]][:k]:
            fits = [(s, m) for s, m, alike in scored if not alike and 80 * -p <= 100 * -s <= 100 * -p][:k]
            out += [(i, j, r + 1, m, -p, -s) for r, (s, m) in enumerate(fits)]
    return sorted(out)


def mined(spark, rows):
    frame = spark.createDataFrame([(i, label, list(map(float, v))) for i, label, v in rows], "vec_id long, label int, embedding array<double>")
    found = negatives.mine(negatives.whole(frame, F.col("label"), F.col("vec_id") % 100 == 0))
    return sorted(map(tuple, found.collect()))


@pytest.mark.parametrize("d,bits", [(2, 2), (3, 2), (2, 4), (4, 2)])
def test_the_curve_goes_through_every_cell_in_single_steps(d, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=d)), dtype=np.uint8)
    places = negatives.hilbert(cells, bits)
    walked = cells[sorted(range(len(cells)), key=places.__getitem__)].astype(int)
    assert len(set(places)) == len(cells) and (np.abs(np.diff(walked, axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold_every_product():
    rng = np.random.default_rng(6)
    a, x = rng.integers(-50, 50, (20, 7)), rng.integers(-50, 50, (100, 7))
    least, most = negatives.bounds(a, x.min(axis=0)[None], x.max(axis=0)[None])
    assert (least <= a @ x.T).all() and (a @ x.T <= most).all()
    large = np.full((1, 4), 1 << 24)
    assert negatives._dot(large, large).tolist() == [[1 << 50]] and negatives._dot(large, large - 1).tolist() == [[4 * (1 << 24) * ((1 << 24) - 1)]]


@pytest.mark.parametrize("sizes", [(512, 256, 32), (7, 3, 2)])
def test_negatives_equal_brute_force(spark, monkeypatch, sizes):
    """Clusters, ties, a vector that a third of all rows have, repeated rows and ids; with small blocks many levels of zone maps."""
    for name, v in zip(("BLOCK", "GROUP", "FAN"), sizes, strict=True):
        monkeypatch.setattr(negatives, name, v)
    rng = np.random.default_rng(8)
    centres = rng.standard_normal((4, 6))
    rows = [(int(i) * 10, int(i) % 3, (centres[i % 4] + 0.3 * rng.standard_normal(6)).round(2).tolist()) for i in range(150)]
    rows += [(2000 + 10 * i, i % 2, [0.5] * 6) for i in range(75)] + rows[:20] + [(r[0], r[1], rows[9][2]) for r in rows[10:12]]
    want = brute_negatives(rows)
    assert mined(spark, rows) == want and len(want) > 100


def test_the_walk_leaves_blocks_out(spark, monkeypatch):
    for name, v in (("BLOCK", 8), ("GROUP", 8), ("FAN", 4)):
        monkeypatch.setattr(negatives, name, v)
    rng = np.random.default_rng(9)
    rows = [(i, int(i % 2), (np.eye(8)[i % 8] * 10 + 0.1 * rng.standard_normal(8)).tolist()) for i in range(800)]
    read = []
    kept = negatives._read
    monkeypatch.setattr(negatives, "_read", lambda pairs, *rest: read.append(pairs.count()) or kept(pairs, *rest))
    assert mined(spark, rows) == brute_negatives(rows)
    made_groups, made_blocks = 8, 100
    assert max(read) < made_groups * made_blocks / 2


def test_negatives_query(spark):
    same(queries.op13_hard_negatives(spark, DATA).toPandas(), database("sf0.001").sql(queries.ORACLE_SQL["op13_hard_negatives"]).df())


def test_negatives_at_the_edges(spark):
    schema = "vec_id long, embedding array<double>, label int, anchor string, x string"
    bad = [(0, None, 1, "", ""), (100, [1.0, None], 1, "", ""), (200, [1.0, NAN], 1, "", ""), (300, [1.0, -INF], 1, "", ""), (None, [1.0, 1.0], 1, "", ""), (400, [1.0, 1.0], None, "", ""), (500, [1.0], 1, "", ""), (600, [1e9, 1.0], 1, "", ""), (700, [], 1, "", "")]

    def run(rows):
        frame = spark.createDataFrame(rows, schema)
        return sorted(map(tuple, negatives.mine(negatives.whole(frame, F.col("label"), F.col("vec_id") % 100 == 0)).collect()))

    assert run([]) == run(bad) == []
    good = [(1000, [1.0, 0.0], 1, "", ""), (1001, [1.0, 0.0], 1, "", ""), (1002, [1.0, 0.0], 2, "", ""), (1003, [0.5, 0.0], 2, "", "")]
    assert run(good + bad) == [(1000, 1001, 1, 1002, 65536, 65536)]
    assert run(good[:2]) == [] and run(good[1:]) == [] and run([(100, [-1.0, 0.0], 1, "", ""), (1, [1.0, 0.0], 1, "", ""), (2, [1.0, 0.0], 2, "", "")]) == []
