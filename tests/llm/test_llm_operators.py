"""The operators of the llm subpackage against brute force, round trips and held-out accuracy, and at the edges."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tokenizers
import xxhash
from pyspark.sql import functions as F

from tallyvane.llm import brown_lm, decontam, langid, packing, pii, queries, rollups, simhash, topk, toxicity, url_lists
from tallyvane.llm.components import components

DATA = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, texts, extra=()):
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)] + list(extra)
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet").toPandas()


EDGES = [None, "", " ", "\x1c", "!!!", "a", "A a", "word " * 30000, "x" * 50000, "é́ ŠΣ", "a b c d e f", "a b c d e f"]


# --- SimHash


def slow_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def slow_groups(prints, radius=3):
    label = list(range(len(prints)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= radius:
                a, b = root(i), root(j)
                label[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(prints))]


def test_near_duplicates_equal_brute_force(spark, documents):
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in queries.op9_simhash_near_dedup(spark, DATA).collect()}
    ids, prints = list(documents["doc_id"]), [slow_print(t) for t in documents["text"]]
    want = {i: (f"{p:016x}", ids[r]) for i, p, r in zip(ids, prints, slow_groups(prints), strict=True)}
    assert got == want


@pytest.mark.parametrize("bucket", [32, 1024])
def test_links_lose_no_pair_in_full_buckets(spark, bucket):
    rng = random.Random(bucket)
    centres = [rng.getrandbits(64) for _ in range(3)]
    prints = sorted({c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for c in centres for _ in range(60)})
    signed = [simhash._signed(p) for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fp long")
    found = components(simhash.links(frame, 3, bucket))
    root = {p: p for p in signed} | {r["node"]: r["root"] for r in found.collect()}
    groups = slow_groups(prints)
    assert len({(root[s], g) for s, g in zip(signed, groups, strict=True)}) == len(set(groups)) == len(set(root.values()))


def test_covering_masks_cover_every_difference():
    masks, rng = simhash._masks(3), random.Random(1)
    assert len(masks) == 15
    for _ in range(3000):
        diff = sum(1 << b for b in rng.sample(range(64), 3))
        assert any(diff & m == 0 for m in masks)


def test_near_duplicates_at_the_edges(spark):
    rows = [(r["doc_id"], r["component_id"], r["fingerprint"]) for r in simhash.near_duplicates(docs_of(spark, EDGES, [(None, "zz", None, None, 0), (3, "\x1c", None, None, 1)])).collect()]
    assert len(rows) == len(EDGES) + 2
    by = {r[0]: r for r in rows}
    assert by[0][1] == by[1][1] == by[2][1] == 0 and by[0][2] == "0" * 16 and by[11][1] == 10
    assert simhash.near_duplicates(docs_of(spark, [])).count() == 0


def test_components(spark):
    e = [(1, 2), (2, 3), (5, 4), (4, 4), (7, 3), (3, 7)] + [(i, i + 1) for i in range(100, 160)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(e, "u long, v long")).collect()}
    assert got == {2: 1, 3: 1, 7: 1, 5: 4} | {i: 100 for i in range(101, 161)}


# --- language ID


def test_language_held_out(spark, documents):
    got = queries.op10_language_id(spark, DATA).toPandas().merge(documents, on="doc_id")
    held = got[got["held_out"]]
    assert len(got) == len(documents) and (held["lang_pred"] == held["lang"]).mean() > 0.97
    assert got["score"].between(0, 1).all()
    assert [bool(h) for h in got["held_out"]] == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got["doc_id"]]


def test_language_at_the_edges(spark):
    train = docs_of(spark, ["the and of", "der und die"] * 20).withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "en").otherwise("de"))
    model = langid.fit(train)
    out = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predict(docs_of(spark, EDGES), model).collect()}
    assert all(out[i] == ("und", 0.0) for i in range(5)) and out[5][0] in ("en", "de")
    assert langid.fit(docs_of(spark, [])).predict("text") == ("und", 0.0)
    alone = langid.fit(docs_of(spark, ["one two three"]))
    assert alone.predict("anything") == ("en", 1.0)
    clash = docs_of(spark, ["the and of", "the and of"]).withColumns({"lang_pred": F.lit(1), "score": F.lit("mine")})
    assert [(type(r["lang_pred"]), type(r["score"])) for r in langid.predict(clash, model).collect()] == [(str, float)] * 2
    assert langid.predict(docs_of(spark, []), model).count() == 0
    assert langid.family_of("de") == langid.family_of("en") != langid.family_of("fr") and langid.family_of("xx") == "xx"


def test_language_votes_equal_plain_loops(spark, documents):
    """The family's and the pairs' margins added up one by one, and letters counted without arrays."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet").withColumn("held", F.expr("coalesce(crc32(cast(doc_id as string)) % 5 = 0, false)"))
    model = langid.fit(docs.where("not held"))
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in queries.op10_language_id(spark, DATA).collect()}
    for i, text in list(zip(documents["doc_id"], documents["text"], strict=True))[:40]:
        points = [ord(c) if c.isalpha() else 32 for c in (text or "").lower()]
        line = [32]
        for p in points:
            if p != 32 or line[-1] != 32:
                line.append(p)
        line += [] if line[-1] == 32 else [32]
        if all(p == 32 for p in line):
            assert got[i] == ("und", 0.0)
            continue
        counts: collections.Counter = collections.Counter()
        for k in range(len(line) - 1):
            two = (line[k] * 0x9E3779B1 + line[k + 1] * 0x85EBCA77) % 2**32
            counts[two >> 20] += 1
            if k + 2 < len(line):
                counts[((two * 0xC2B2AE3D + line[k + 2] * 0x27D4EB2F) % 2**32) >> 20] += 1
        n = sum(counts.values())
        margin = [sum(math.sqrt(c / n) * model.weights[f, j] for f, c in counts.items()) + model.bias[j] for j in range(len(model.sides))]

        def best(kind, names):
            votes = [sum(m * (1 if a == x else -1 if b == x else 0) for (k, a, b), m in zip(model.sides, margin, strict=True) if k == kind) for x in names]
            odds = [math.exp(model.sharpness * (v - max(votes))) for v in votes]
            return (names[votes.index(max(votes))], max(odds) / sum(odds)) if len(names) > 1 else (names[0], 1.0)

        family, p = best("family", sorted({langid.family_of(x) for x in model.languages}))
        lang, q = best(family, sorted(x for x in model.languages if langid.family_of(x) == family))
        assert got[i][0] == lang and got[i][1] == pytest.approx(p * q, abs=2e-3)  # sums of a distributed fit go in any order


# --- toxicity


def test_segments_equal_brute_force():
    rng = random.Random(3)
    for _ in range(300):
        s = [rng.choice([-2.0, -1.0, 1.0, 2.0, 3.0]) for _ in range(rng.randint(0, 14))]

        def slow(lo, hi, s=s):
            """Ruzzo and Tompa's definition: the best segment, then the same left and right of it."""
            best = max(((sum(s[i:j]), -(j - i), -i, i, j) for i in range(lo, hi) for j in range(i + 1, hi + 1)), default=(0,))
            if best[0] <= 0:
                return []
            _, _, _, i, j = best
            return slow(lo, i) + [(i, j, best[0])] + slow(j, hi)

        # Numbers that no two sums share, so that every maximal segment is the only one of its score.
        s[:] = [x + i * 2.0**-40 for i, x in enumerate(s)]
        assert [(a, b) for a, b, _ in toxicity.segments(np.array(s))] == [(a, b) for a, b, _ in slow(0, len(s))]
        assert [x for _, _, x in toxicity.segments(np.array(s))] == pytest.approx([x for _, _, x in slow(0, len(s))])


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op1_toxicity_segments(spark, sf).toPandas().merge(spark.read.parquet(f"{sf}/labels.parquet").toPandas(), on="doc_id")
    held = got[got["held_out"]]
    assert (held["predicted"] == held["toxic"]).mean() > 0.93 and held["predicted"][held["toxic"] == 0].mean() < 0.03
    assert ((got["score"] >= 0.5) == (got["predicted"] == 1)).all()


def test_toxicity_at_the_edges(spark):
    docs = docs_of(spark, EDGES)
    none = toxicity.fit(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r["predicted"] for r in toxicity.score(docs, none).collect()} == {0}
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)] + [(3, None), (None, 1), (5, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    rows = toxicity.score(docs, model).collect()
    assert len(rows) == len(EDGES) and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.score(docs.limit(0), toxicity.fit(docs.limit(0), labels)).count() == 0
    clash = docs.unionByName(docs).withColumns({"score": F.lit("mine"), "predicted": F.lit("mine"), "toxic": F.lit(7)})
    twice = toxicity.score(clash, model).collect()
    assert len(twice) == 2 * len(EDGES) and {r["predicted"] for r in twice} <= {0, 1} and {r["toxic"] for r in twice} == {7}


def test_toxicity_scores_equal_plain_python(spark, documents):
    """The registered query's scores by plain loops over the fitted lexicon and numbers."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", F.expr("coalesce(crc32(cast(doc_id as string)) % 5 = 0, false)").alias("held_out"))
    model = toxicity.fit(docs.where("not held_out"), spark.read.parquet(f"{DATA}/labels.parquet"))
    got = {r["doc_id"]: r["score"] for r in queries.op1_toxicity_segments(spark, DATA).collect()}
    for i, text in list(zip(documents["doc_id"], documents["text"], strict=True))[:60]:
        values = []
        for w in (text or "").lower().split():
            known = [model.lexicon[f] for f in toxicity.features(w) if f in model.lexicon]
            values.append((max(known, key=lambda x: abs(x[1]))[0] if known else 0.0) - model.drift)
        best, run, logs = 0.0, 0.0, 0.0
        for v in values:  # the best segment is the greatest rise
            run = max(0.0, run + v)
            best = max(best, run)
        n = len(values)
        for _, _, s in toxicity.segments(np.array(values)):
            logs += max(0.0, model.decay * s - math.log(max(model.scale * n, 1e-9)))
        x = min(40.0, max(-20.0, model.decay * best - math.log(max(model.scale * n, 1e-9)))) if n else -20.0
        a, b, c = model.weights
        assert got[i] == pytest.approx(1 / (1 + math.exp(-(a + b * x + c * min(80.0, logs)))), abs=1e-9)


# --- decontamination


def test_decontamination_at_the_edges(spark):
    item = "one two three four five six seven eight nine ten eleven twelve"
    bench = spark.createDataFrame([(1, item), (2, "too short"), (3, None), (4, item), (None, item)], "item_id long, text string")
    texts = [*EDGES, item, f"Start {item.upper()}, end", "zero " + item.replace("six", "SIX!"), item.replace("six", "sax"), f"{item} {item}"]
    got = {(r["doc_id"], r["item_id"]): r for r in decontam.contaminated(docs_of(spark, texts), bench).collect()}
    n = len(EDGES)
    assert {k[0] for k in got} == {n, n + 1, n + 2, n + 4} and {k[1] for k in got} == {1, 4}
    assert got[n + 1, 1]["start_word"] == 1 and got[n + 1, 1]["n_words"] == 12 and got[n + 4, 1]["start_word"] == 0
    assert all(r["similarity"] == 1.0 for r in got.values())
    assert decontam.contaminated(docs_of(spark, []), bench).count() == 0
    assert decontam.contaminated(docs_of(spark, texts), bench.limit(0)).count() == 0


def test_decontamination_by_a_shuffled_join(spark):
    docs, bench = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "benchmark"))
    rows = lambda **k: sorted(map(tuple, decontam.contaminated(docs, bench, **k).collect()))
    assert rows() == rows(broadcast_rows=0)


def test_decontamination_finds_an_item_with_its_halves_swapped(spark):
    words = [f"w{i}" for i in range(160)]
    swapped = [*words[80:], *words[:80]]
    text, bench = ["x y z", *swapped, "t u v"], spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    (got,) = decontam.contaminated(docs_of(spark, [" ".join(text)]).withColumns({"m": F.lit(1), "hashes": F.lit("mine")}), bench.withColumn("item", F.lit(0))).collect()
    assert got["similarity"] == round(152 / 160, 6) and got["n_words"] == 160


def test_fingerprints_equal_bit_counts(spark):
    rng = random.Random(4)
    rows = [(i, [rng.getrandbits(64) - 2**63 for _ in range(n)]) for i, n in enumerate([1, 2, 3, 50, 127, 128, 300, 32_767, 32_768])]
    rows += [(20 + n, [-1] * n) for n in (1, 127, 128)]
    got = {r["i"]: r["f"] for r in spark.createDataFrame(rows, "i int, h array<long>").select("i", decontam.simhash("h").alias("f")).collect()}
    for i, hashes in rows:
        bits = np.unpackbits(np.array(hashes, dtype="<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        assert got[i] == int(np.packbits(bits * 2 > len(hashes), bitorder="little").view("<i8")[0])
    frame = spark.createDataFrame([([1, 2, 3], [4, 5, 6])], "a array<long>, b array<long>")
    assert frame.select(decontam.distance("a", "b")).first()[0] == sum(bin(x ^ y).count("1") for x, y in ((1, 4), (2, 5), (3, 6)))


def test_bags_count_repeats(spark):
    rng = random.Random(8)
    for _ in range(30):
        a, b = ([rng.randint(0, 4) for _ in range(rng.randint(1, 9))] for _ in "ab")
        row = spark.createDataFrame([(a, b)], "a array<long>, b array<long>")
        assert row.select(F.expr(f"size(array_intersect({decontam._bag('a')}, {decontam._bag('b')}))")).first()[0] in (sum((collections.Counter(a) & collections.Counter(b)).values()),)


def test_decontamination_finds_windows_that_no_shingle_lines_up(spark):
    """First and last word changed, two put in the middle: the best window starts between those that line up."""
    words = [f"w{i}" for i in range(59)]
    inside = ["p", "q", "r", "x", *words[1:30], "in", "out", *words[30:58], "y", "s", "t", "u"]
    shared = lambda a, b: sum((collections.Counter(a) & collections.Counter(b)).values())
    cuts = lambda ws: [tuple(ws[i : i + 5]) for i in range(len(ws) - 4)]
    item, text = cuts(words), cuts(inside)
    slow = [(o := shared(text[i : i + 55], item)) / (110 - o) for i in range(len(text) - 54)]
    assert max(slow) > 0.8
    (got,) = decontam.contaminated(docs_of(spark, [" ".join(inside)]), spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")).collect()
    assert got["similarity"] == round(max(slow), 6) == round(slow[got["start_word"]], 6) and got["n_words"] == 59


# --- packing


def slow_ids(text, tk):
    return [*tk.encode(text or "", add_special_tokens=False).ids, 1]


def check_packed(rows, texts, length=2048):
    tk = tokenizers.Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    ids = {k: np.array(slow_ids(t, tk), dtype="<u4") for k, t in texts.items()}
    seqs, of = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        own = ids[r["doc_id"]]
        assert r["doc_tokens"] == len(own) and r["ids_crc32"] == zlib.crc32(own[r["start"] : r["start"] + r["length"]].tobytes())
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
        of[r["doc_id"]].append((r["start"], r["length"]))
    for parts, end in [*((p, None) for p in seqs.values()), *((p, len(ids[k])) for k, p in of.items())]:
        at = 0
        for a, n in sorted(parts):
            assert a == at and n > 0
            at += n
        assert at <= length if end is None else at == end
    assert set(of) == set(texts)
    return sum(len(x) for x in ids.values()), len(seqs)


def test_packing_round_trip(spark, documents):
    total, n = check_packed(queries.op4_packing(spark, DATA).collect(), dict(zip(documents["doc_id"], documents["text"], strict=True)))
    assert n <= 1.12 * total / 2048 + 1


def test_packing_at_the_edges(spark):
    check_packed(packing.pack(docs_of(spark, EDGES)).collect(), dict(enumerate(EDGES)))
    assert packing.pack(docs_of(spark, [])).count() == 0
    clash = docs_of(spark, ["a b", "c"]).withColumns({"length": F.lit("mine"), "sequence_id": F.lit("mine"), "slice": F.lit("mine")})
    check_packed(packing.pack(clash).collect(), {0: "a b", 1: "c"})
    same = packing.pack(docs_of(spark, ["a b", "a b"], [(None, "a b", None, None, 3), (None, "a b", None, None, 3)])).collect()
    assert len(same) == 4 and len({(r["sequence_id"], r["offset"]) for r in same}) == 4


def test_chunked_ids_equal_the_tokenizer():
    path = public_tokenizers.path(packing.VOCABULARY)
    chunks, tk, rng = packing.chunk_ids(path), tokenizers.Tokenizer.from_file(path), random.Random(5)
    pool = list("abcdefgXYZ.,'!-0123 \t\n\xa0\x85 \x1c​ ") + list("éÉßüÄñçœŒİıΣσςΑαДджЖ中文字ุก́̀ë가각ﬁﬀǅ") + ["<|endoftext|>", "'s", "n't"]
    for _ in range(3000):
        text = "".join(rng.choice(pool) for _ in range(rng.randint(0, 14)))
        assert np.frombuffer(packing.token_bytes(text, chunks), dtype="<u4").tolist() == slow_ids(text, tk)


def test_patterns_hold_all_items():
    rng = np.random.default_rng(2)
    for _ in range(20):
        units = int(rng.integers(1, 40))
        counts = rng.integers(0, 30, units)
        found = packing.patterns(counts, np.arange(1, units + 1), units)
        assert (sum((p * t for p, t in found), np.zeros(units, dtype=int)) == counts).all()
        assert all((p * np.arange(1, units + 1)).sum() <= units for p, _ in found)


# --- language model


def test_language_model(spark, documents):
    got = queries.op5_brown_lm_scoring(spark, DATA).toPandas().set_index("doc_id")
    count, words = collections.Counter(), {}
    for i, t in zip(documents["doc_id"], documents["text"], strict=True):
        words[i] = [*re.findall(rb"[^\x20\x09-\x0d]+", (t or "").encode().lower()), b"\x00end"]
        if zlib.crc32(str(i).encode()) % 10:
            count.update(words[i])
    n, v = sum(count.values()), len(count)
    for i, w in words.items():
        r = got.loc[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(w), sum(x in count for x in w), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((count[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w))
    held = got[got["held_out"]]
    assert held["score"].sum() > held["base_score"].sum() and (got["score"] < 0).all()


def test_language_model_is_a_distribution(spark):
    """Over the known words and the unseen one of each class, probabilities after any class sum to one."""
    docs = docs_of(spark, ["a b a c a b d", "b a c", "e f e g e f", "f e g"] * 3)
    model, words = brown_lm.fit(docs, classes=3)
    counts = {bytes(r["word"]): r["n"] for r in words.collect()}
    total = 0.0
    for k in range(model.transition.shape[1]):
        own = [n for w, n in counts.items() if model.class_of[model.units.of(w)] == k]
        total += 10 ** model.transition[0, k] * (sum(n + 0.1 for n in own) + 0.1) / 10 ** model.emission_norm[k]
    assert total == pytest.approx(1.0)


def test_exchange_finds_classes():
    a, b = [0, 1, 2], [3, 4, 5]
    m = np.zeros((7, 7))
    for x in a:
        for y in b:
            m[x, y] = m[y, x] = 10 + 3 * x + y
    of = brown_lm.exchange(m, 3)
    assert len({of[x] for x in a}) == 1 and len({of[x] for x in b}) == 1 and of[0] != of[3] and of[6] == 2


def test_language_model_at_the_edges(spark):
    docs = docs_of(spark, EDGES, [(None, "a", None, None, 1), (5, "a", None, None, 1)])
    for train in (docs, docs.limit(0)):
        model, words = brown_lm.fit(train)
        rows = brown_lm.score(docs.select("doc_id", "text"), model, words).collect()
        assert len(rows) == len(EDGES) + 2 and all(math.isfinite(r["score"]) for r in rows)
        assert {r["n_tokens"] for r in rows if r["doc_id"] == 0} == {1}


def test_end_counts_in_texts_so_long_that_it_is_rare(spark):
    docs = docs_of(spark, [" ".join(f"w{i % 50}" for i in range(600_000))]).withColumns({"score": F.lit("mine"), "n_known": F.lit("mine")})
    model, words = brown_lm.fit(docs)
    r = brown_lm.score(docs.select("doc_id", "text", "score", "n_known"), model, words).first()
    assert r["n_known"] == r["n_tokens"] == r["train_tokens"] == 600_001
    assert r["base_score"] == pytest.approx(600_000 * math.log10(12_000.1 / 600_006.2) + math.log10(1.1 / 600_006.2))


def test_scores_equal_plain_loops(spark):
    """score() by plain Python from the classes of words: counts of classes that follow each other, and words by class."""
    rng = random.Random(12)
    texts = [" ".join(rng.choice("a b c d e f g h i".split()) for _ in range(rng.randint(1, 12))) for _ in range(40)]
    docs = docs_of(spark, texts)
    model, words = brown_lm.fit(docs, classes=4)
    of = {bytes(r["word"]): r["class"] for r in words.collect()}
    lines = [[b"\x00end", *t.encode().split(), b"\x00end"] for t in texts]
    count = collections.Counter(w for line in lines for w in line[1:])
    pairs = collections.Counter((of[a], of[b]) for line in lines for a, b in zip(line, line[1:], strict=False))
    total, inside = sum(count.values()), collections.Counter()
    for w, n in count.items():
        inside[of[w]] += n
    kinds = collections.Counter(of[w] for w in count)
    share = {k: (inside[k] + 0.1) / (total + 0.1 * 4) for k in range(4)}

    def p(a, b):
        follow = (pairs[of[a], of[b]] + 5.0 * share[of[b]]) / (sum(n for (x, _), n in pairs.items() if x == of[a]) + 5.0)
        return follow * (count[b] + 0.1) / (inside[of[b]] + 0.1 * (kinds[of[b]] + 1))

    for r in brown_lm.score(docs.select("doc_id", "text"), model, words).collect():
        line = lines[r["doc_id"]]
        assert r["score"] == pytest.approx(sum(math.log10(p(a, b)) for a, b in zip(line, line[1:], strict=False)))


def test_language_model_gives_rare_words_classes(spark):
    """Words without a unit of their own go where their neighbours say, not where their last two bytes do."""
    rng = random.Random(4)
    nouns, verbs = [f"n{i}" for i in range(600)], [f"v{i}" for i in range(600)]
    rare = {f"{k}{i}qq": k for k in "nv" for i in range(40)}
    pick = lambda kind: rng.choice(nouns if kind == "n" else verbs)
    texts = [" ".join(pick(k) for k in "nv" * 10) for _ in range(3000)]
    texts += [" ".join([pick("nv"[i % 2]) for i in range(6)] + [w] + [pick("nv"[i % 2]) for i in (1, 2)]) if k == "n" else " ".join([pick("nv"[i % 2]) for i in range(7)] + [w] + [pick("n")]) for w, k in rare.items() for _ in range(4)]
    model, words = brown_lm.fit(docs_of(spark, texts), classes=3)
    of = {bytes(r["word"]).decode(): r["class"] for r in words.collect()}
    assert not set(rare) & {w.decode() for w in model.units.words} and len(of) == words.count() == 1281
    side = {k: collections.Counter(of[w] for w in group).most_common(1)[0][0] for k, group in (("n", nouns), ("v", verbs))}
    assert side["n"] != side["v"] and all(of[w] == side[k] for w, k in rare.items())


def test_contexts_merged_a_few_rows_at_a_time_change_nothing(spark, monkeypatch):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").where("doc_id < 60").select("doc_id", "text", F.lit(False).alias("held_out")).repartition(7)
    scores = lambda: {r["doc_id"]: r["score"] for r in brown_lm.fit_and_score(docs, "held_out").collect()}
    want = scores()
    monkeypatch.setattr(brown_lm, "HELD", 3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        got = scores()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    assert len(want) == 60 and all(math.isclose(got[i], want[i], rel_tol=1e-12) for i in want)


def test_rare_words_count_in_paths(spark):
    """Looked up in the workers or joined, words have one class and texts one score."""
    docs = docs_of(spark, ["a b a c a b d", "b a c", "e f e g e f", "f e g zz", "new words", None] * 2)
    results = []
    for share in (1e-9, 0.2):
        model, words = brown_lm.fit(docs.where("doc_id not in (4, 10)"), classes=3, heavy_share=share)
        assert len(model.heavy) == (words.count() if share < 0.2 else 1)  # the end
        results.append([x for r in brown_lm.score(docs.select("doc_id", "text"), model, words).orderBy("doc_id").collect() for x in (r["n_known"], r["base_score"], r["score"])])
    assert results[0] == pytest.approx(results[1])
    marked = docs.select("doc_id", "text", F.col("doc_id").isin(4, 10).alias("held_out"))
    assert [r["score"] for r in brown_lm.fit_and_score(marked, "held_out").orderBy("doc_id").collect()] == pytest.approx([r["score"] for r in brown_lm.score(docs, *brown_lm.fit(docs.where("doc_id not in (4, 10)"))).orderBy("doc_id").collect()])


# --- personal data

E = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
I = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
N = re.compile(r"[0-9]([\x20-]?[0-9])+")
P = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def slow_spans(t):
    digits = lambda s: re.sub("[^0-9]", "", s)
    found = [(m.start(), 0, m.end()) for m in E.finditer(t)]
    found += [(m.start(), 1, m.end()) for m in I.finditer(t) if all(int(x) <= 255 for x in m.group().split("."))]
    found += [(m.start(), 2, m.end()) for m in N.finditer(t) if 14 <= len(digits(m.group())) <= 19 and pii.luhn(digits(m.group()))]
    found += [(m.start(), 3, m.end()) for m in P.finditer(t) if 10 <= len(digits(m.group())) <= 15]
    return [(pii.KINDS[k], a, b) for a, k, b in sorted(found)]


def test_base_spans_equal_plain_patterns():
    rng = random.Random(9)
    pool = ["a", "b.c", "@", ".", "-", " ", "+", "1", "23", "4111111111111111", "(", ")", "255", "256", "é", "%", "1.2.3.4", "_"]
    for _ in range(20000):
        t = "".join(rng.choice(pool) for _ in range(rng.randint(0, 12)))
        assert pii.base_spans(t) == slow_spans(t)


def test_personal_data_query(spark, documents):
    rows = {r["doc_id"]: r for r in queries.op7_pii_weak_supervision(spark, DATA).collect()}
    for i, t in zip(documents["doc_id"], documents["text"], strict=True):
        want = slow_spans(t or "")
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert rows[i]["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert [rows[i][f"n_{k}"] for k in pii.KINDS] == [sum(x[0] == k for x in want) for k in pii.KINDS]
        assert set(text.split(",")) <= set(rows[i]["spans"].split(",")) | {""}


def planted_texts(rng, n):
    """Texts with the spans to be found, and texts with what only looks like them: [(text, [(kind, start, end)])]."""
    digits = lambda k: "".join(str(rng.randint(0, 9)) for _ in range(k))
    hexes = lambda k: "".join(rng.choice("0123456789abcdef") for _ in range(k))

    def card(good):
        while True:
            x = "4" + digits(15)
            if pii.luhn(x) == good:
                return f"{x[:4]} {x[4:8]} {x[8:12]} {x[12:]}"

    def iban():
        body = digits(18)
        return f"DE{98 - int(body + '131400') % 97:02d}{body}"

    makers = [
        lambda: ("write to", f"jo{rng.randint(1, 99)} [at] corp{rng.randint(1, 9)} [dot] com", "email"),
        lambda: ("reach me:", f"ann.{rng.randint(1, 99)} at example{rng.randint(1, 9)} dot org", "email"),
        lambda: ("phone", f"({rng.randint(201, 989)}) {digits(3)}-{digits(4)}", "phone"),
        lambda: ("tel.", f"{rng.randint(201, 989)}-{digits(3)}-{digits(4)}", "phone"),
        lambda: ("host", ":".join("2" + hexes(3) for _ in range(8)), "ip"),
        lambda: ("account", iban(), "iban"),
        lambda: ("token =", hexes(40), "secret"),
        lambda: ("api key:", "sk-" + hexes(24), "secret"),
        lambda: ("mail", f"x{rng.randint(1, 99)}@corp.com", "email"),
        lambda: ("card", card(True), "card"),
        lambda: ("order no.", card(False), None),
        lambda: ("invoice no", digits(16), None),
        lambda: ("word", "at home dot matrix", None),
        lambda: ("the", f"AB{digits(2)} WORD TEXT", None),
    ]
    out = []
    for _ in range(n):
        text, spans = "some words", []
        for lead, span, kind in (rng.choice(makers)() for _ in range(2)):
            text += f" {lead} "
            if kind:
                spans.append((kind, len(text), len(text) + len(span)))
            text += span + " and then more"
        out.append((text, spans))
    return out


def test_weak_supervision_finds_more_than_the_base_patterns(spark):
    """Precision and recall on planted spans, no label of which is seen, against those of the base patterns alone."""
    planted = planted_texts(random.Random(3), 600)
    found, model = pii.find(docs_of(spark, [t for t, _ in planted]).select("doc_id", "text"))
    rows = {r["doc_id"]: {(s["kind"], s["start"], s["end"]) for s in r["spans"]} for r in found.collect()}
    want = {i: set(spans) for i, (_, spans) in enumerate(planted)}

    def f1(got):
        hit = sum(len(want[i] & got[i]) for i in want)
        return 2 * hit / (sum(map(len, want.values())) + sum(map(len, got.values())))

    base = f1({i: set(pii.base_spans(t)) for i, (t, _) in enumerate(planted)})
    assert f1(rows) > 0.93 > base + 0.3
    assert set(model.reliability) >= set(pii.KINDS) and all(set(x) == set(pii.LABELERS) for x in model.reliability.values())
    assert all(r["yes if personal"] > r["yes if not"] for x in model.reliability.values() for r in x.values())


def test_personal_data_at_the_edges(spark):
    clash = docs_of(spark, [None, "", "12-34 56", "mail bob@corp.com", "mail bob@corp.com", "1" * 100_000, "+1 415 555 0100, " * 5000, *EDGES]).withColumns({"spans": F.lit("mine"), "features": F.lit(1), "_candidates": F.lit(2)})
    found, _ = pii.find(clash)
    rows = {r["doc_id"]: r for r in found.collect()}
    assert len(rows) == 7 + len(EDGES) and rows[0]["spans"] == rows[1]["spans"] == rows[2]["spans"] == [] and rows[3]["spans"] == rows[4]["spans"] != [] and len(rows[6]["spans"]) == 5000 and rows[3]["_candidates"] == 2
    masked = {r["doc_id"]: r for r in pii.redact(clash).collect()}
    assert masked[0]["text"] is None and masked[2]["text"] == "12-34 56" and masked[3]["text"] == "mail <EMAIL>" and masked[3]["spans"] == "mine"
    assert masked[6]["text"].count("<PHONE>") == 5000 and pii.redact(clash).columns == clash.columns
    none, model = pii.find(clash.limit(0))
    assert none.count() == 0 and model.reliability == {} and pii.redact(clash.limit(0)).count() == 0


def test_hostile_spans(spark):
    """Runs of zeros, secrets and keys of any length, and addresses that other words of the text don't change."""
    zeros = "ip " + "0" * 5000 + "1.2.3.4 and 1." + "0" * 5000 + "2.3.4 and " + "9" * 5000 + ".1.1.1"
    assert [s[:3] for s in pii.candidates(zeros) if s[0] == "ip"] == [("ip", 3, 5010), ("ip", 5015, 5015 + 2 + 5000 + 5)]
    secret = "token=" + "aB3-" * 250
    assert [s[:3] for s in pii.candidates(secret)] == [("secret", 6, 1006)] and pii.mask(secret, [("secret", 6, 1006)]) == "token=<SECRET>"
    for key in ("0123456789abcdef" * 8, "abcdefabcdef" * 11, "sk-" + "Ab" * 200, "xoxb-" + "a1-" * 100 + "z"):
        assert [s[:3] for s in pii.candidates("is " + key)] == [("secret", 3, 3 + len(key))]
    for text, kind in (("contact john at example.com", "email"), ("mail jo [at] corp [dot] com", "email"), ("host fe80::ab:cd", "ip")):
        alone = [s[:3] for s in pii.candidates(text)]
        assert len(alone) == 1 and alone[0][0] == kind
        for more in (" dotted", " 7", " key", " ::", " a@b.cd"):
            assert [s[:3] for s in pii.candidates(text + more)][:1] == alone
    assert pii.candidates("he was at home. Then at 12:30:45 we met") == [] and pii.candidates("at at at @ at " * 2000) == []
    docs = docs_of(spark, [zeros, secret, None])
    assert pii.digest(pii.find(docs)[0]).count() == 3 and pii.redact(docs).count() == 3


def test_beliefs_and_classifier_equal_plain_python(spark):
    """Expectation-maximisation by loops over all candidates; the classifier is where its penalised likelihood has no slope."""
    rows = [c for t, _ in planted_texts(random.Random(12), 300) for c in pii.candidates(t)]
    counts = collections.Counter((c[0], c[4]) for c in rows)
    import pandas as pd

    patterns = pd.DataFrame([(k, v, n) for (k, v), n in counts.items()], columns=["kind", "votes", "n"])
    model = pii.fit(patterns, pd.DataFrame([(c[0], c[4], c[5]) for c in rows], columns=["kind", "votes", "features"]))
    belief = {}
    for kind in {k for k, _ in counts}:
        own = {v: n for (k, v), n in counts.items() if k == kind}
        total = sum(own.values())
        first = {name: pii.FORM_TRUST if name == "form" else pii.TRUST for name in pii.LABELERS}
        weight = {name: max(pii.PRIOR_LEAST, (pii.FORM_SHARE if name == "form" else pii.PRIOR_SHARE) * total) for name in pii.LABELERS}
        yes = {n: dict(zip("y-n", t, strict=True)) for n, t in first.items()}
        no = {n: dict(zip("n-y", t, strict=True)) for n, t in first.items()}
        prior = 0.5
        for _ in range(50):
            for votes in own:
                odds = math.log(prior / (1 - prior)) + sum(math.log(yes[n][v] / no[n][v]) for n, v in zip(pii.LABELERS, votes, strict=True))
                belief[kind, votes] = 1 / (1 + math.exp(-max(-30, min(30, odds))))
            prior = min(0.98, max(0.02, (sum(n * belief[kind, v] for v, n in own.items()) + 0.5 * pii.PRIOR_LEAST) / (total + pii.PRIOR_LEAST)))
            for j, name in enumerate(pii.LABELERS):
                for of, side, order in ((yes, lambda b: b, "y-n"), (no, lambda b: 1 - b, "n-y")):
                    c = {v: weight[name] * t + sum(n * side(belief[kind, x]) for x, n in own.items() if x[j] == v) for v, t in zip(order, first[name], strict=True)}
                    of[name] = {v: x / sum(c.values()) for v, x in c.items()}
        assert math.isclose(model.prior[kind], prior, rel_tol=1e-9)
        for name in pii.LABELERS:
            assert math.isclose(model.reliability[kind][name]["yes if personal"], yes[name]["y"], rel_tol=1e-9)
    slope = [-0.3 * w for w in model.weights]
    for kind, _, _, _, votes, features in rows:
        p = 1 / (1 + math.exp(-(sum(model.weights[f] for f in features) + model.weights[pii.DIM])))
        for f in [*features, pii.DIM]:
            slope[f] += belief[kind, votes] - p
    assert max(map(abs, slope)) < 1e-2


def test_mask_of_overlapping_spans():
    assert pii.mask("ab 123 cd", [("card", 3, 6), ("phone", 4, 7)]) == "ab <CARD>cd"


# --- top-k, URLs, rollups


@pytest.mark.parametrize("n", [0, 1, 5, 400])
def test_topk_equals_brute_force(spark, n):
    rng = random.Random(n)
    codes = [rng.getrandbits(64) if i % 3 else 77 for i in range(n)]
    rows = spark.createDataFrame([(i, simhash._signed(c)) for i, c in enumerate(codes)] + [(None, 5), (9999, None)], "vec_id long, code long")
    got = sorted((r["query_id"], r["rank"], r["neighbor_id"], r["distance"]) for r in topk.search(rows.where("vec_id % 20 = 0"), rows).collect())
    want = []
    for q in range(0, n, 20):
        near = sorted((bin(codes[q] ^ codes[i]).count("1"), i) for i in range(n) if i != q)[:10]
        want += [(q, k + 1, i, d) for k, (d, i) in enumerate(near)]
    assert got == sorted(want)


def test_codes_of_odd_vectors(spark):
    rows = spark.createDataFrame([(1, None), (2, []), (3, [1.0, -1.0, 2.0]), (4, [float("nan"), None, 1.0]), (5, [1.0] * 80)], "vec_id long, embedding array<float>")
    got = {r["vec_id"]: r["code"] for r in rows.select("vec_id", topk.sign_code("embedding").alias("code")).collect()}
    assert got == {1: None, 2: 0, 3: 5, 4: 4, 5: -1}
    clash = spark.createDataFrame([(1, 5, 0), (2, 7, 0)], "vec_id long, code long, rank long")
    assert [tuple(r) for r in topk.search(clash, clash).orderBy("query_id").collect()] == [(1, 1, 2, 1), (2, 1, 1, 1)]


def test_probes_flip_so_many_bits(spark):
    codes = spark.createDataFrame([(0b1011,)], "query_code long")
    cuts = [(0, 5), (5, 4)]
    for d in range(6):
        got = sorted((r["segment"], r["value"]) for r in topk._probes(codes, cuts, d).collect())
        assert got == sorted([(0, x) for x in range(32) if bin(x ^ 0b1011).count("1") == d] + [(1, x) for x in range(16) if bin(x).count("1") == d])


def test_url_lists_over_time(spark):
    entries = spark.createDataFrame([("Bad.com", "block", 10), ("bad.com", "remove", 20), ("bad.com", "block", 30), ("ok.bad.com", "allow", 5), ("bad.com", "block", 10), (None, "block", 1), ("x.org", None, 1)], "pattern string, action string, t int")
    entries = entries.withColumn("listed_at", F.timestamp_seconds("t"))
    caps = [(1, "http://a.bad.com/x", 9), (2, "http://u@A.BAD.com:80/", 10), (3, "https://bad.com", 20), (4, "http://bad.com.", 31), (5, "http://z.ok.bad.com", 31), (6, None, 5), (7, "nonsense", 5), (8, "http://bad.com", None), (2, "http://bad.com", 15)]
    frame = spark.createDataFrame(caps, "page_id long, url string, t int").withColumn("fetched_at", F.timestamp_seconds("t"))
    want = [(1, "unlisted"), (2, "block"), (2, "block"), (3, "unlisted"), (4, "block"), (5, "allow"), (6, "unlisted"), (7, "unlisted"), (8, "unlisted")]
    for rows in (100, 0):
        assert sorted((r["page_id"], r["verdict"]) for r in url_lists.judge(frame, entries, "page_id", broadcast_rows=rows).collect()) == want
    assert url_lists.judge(frame.limit(0), entries, "page_id").count() == 0 and {r["verdict"] for r in url_lists.judge(frame, entries.limit(0), "page_id").collect()} == {"unlisted"}


def test_deep_hosts_meet_all_their_parents(spark):
    entries = spark.sql("select 'example.com' pattern, 'block' action, timestamp_seconds(10) listed_at")
    frame = spark.sql("select 1L page_id, 'http://a.b.c.d.e.f.g.h.example.com/' url, timestamp_seconds(20) fetched_at")
    got = url_lists.judge(frame.withColumns({"host": F.lit("mine"), "action": F.lit(1)}), entries, "page_id").first()
    assert (got["verdict"], got["pattern"]) == ("block", "example.com")
    numbers = spark.sql("select '0.1' pattern, 'block' action, timestamp_seconds(10) listed_at")
    assert url_lists.judge(frame.withColumn("url", F.lit("http://10.0.0.1/")), numbers, "page_id").first()["verdict"] == "unlisted"


def test_long_histories_and_addresses(spark, monkeypatch):
    """Many intervals of one host, in several stretches, against the rule; addresses in brackets; empty tables; long URLs."""
    monkeypatch.setattr(url_lists, "ERA", 4)
    acts = ["block", "remove", "allow"]
    log = [("a.com", acts[i % 3], 10 * i) for i in range(40)] + [("[2001:db8::1]", "block", 5)]
    entries = spark.createDataFrame(log, "pattern string, action string, t long").select("pattern", "action", F.timestamp_seconds("t").alias("listed_at"))
    urls = [(i, "http://x.a.com:80/", i) for i in range(0, 420, 3)] + [(1000, "http://[2001:DB8::1]:8080/x", 7), (1001, "http://[2001:db8::1/", 7), (1002, "http://a.com/" + "b." * 50_000, 3), (1003, "http://" + "b." * 3000 + "a.com", 3), (1004, None, 3), (1005, "http://a.com", None)]
    captures = spark.createDataFrame(urls, "id long, url string, t long").select("id", "url", F.timestamp_seconds("t").alias("fetched_at"), F.lit("mine").alias("_row"), F.lit("mine").alias("host"), F.lit(1).alias("pattern"), F.lit(1).alias("eras"))
    for rows in (0, 100_000):
        got = {r["id"]: r["verdict"] for r in url_lists.judge(captures, entries, "id", broadcast_rows=rows).collect()}
        want = {i: {"remove": "unlisted"}.get(acts[t // 10 % 3], acts[t // 10 % 3]) if t < 400 else "block" for i, _, t in urls[:140]}
        assert got == want | {1000: "block", 1001: "unlisted", 1002: "block", 1003: "block", 1004: "unlisted", 1005: "unlisted"}
    assert {r["verdict"] for r in url_lists.judge(captures, entries.limit(0), "id").collect()} == {"unlisted"} and url_lists.judge(captures.limit(0), entries, "id").count() == 0


CHANGES = "op string, old_source string, old_lang string, old_tokenizer string, old_tokens long, new_source string, new_lang string, new_tokenizer string, new_tokens long"


def test_rollups_are_idempotent(spark, tmp_path):
    add = spark.createDataFrame([("insert", *[None] * 4, "s", "en", "v1", n) for n in (3, 4)] + [("insert", *[None] * 4, None, None, "v1", None), (None, *[None] * 8)], CHANGES).withColumns({"docs": F.lit("mine"), "source": F.lit("mine")})
    turn = spark.createDataFrame([("revise", "s", "en", "v1", 3, "s", "en", "v2", 5), ("delete", "s", "en", "v1", 4, *[None] * 4)], CHANGES)
    for order in ([("1", add), ("2", turn), ("2", turn), ("1", add)], [("2", turn), ("1", add)], [("1", add), ("2", turn), ("3", add.limit(0))]):
        ledger = str(tmp_path / str(len(order)))
        assert rollups.totals(spark, ledger).count() == 0
        done = [rollups.commit(changes, ledger, batch) for batch, changes in order]
        assert done == [batch not in [b for b, _ in order[:i]] for i, (batch, _) in enumerate(order)]
        got = sorted(map(tuple, rollups.totals(spark, ledger).collect()))
        assert got == [("s", "en", "v2", 1, 5), ("unknown", "unknown", "v1", 1, 0)]
        assert len(list((tmp_path / str(len(order)) / "totals").iterdir())) <= 2


def test_a_commit_that_dies_changes_nothing(spark, tmp_path, monkeypatch):
    add = spark.createDataFrame([("insert", *[None] * 4, "s", "en", "v1", 3)], CHANGES)
    ledger = str(tmp_path / "ledger")
    rollups.commit(add, ledger, "1")

    def dies(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(rollups, "_record", dies)
        with pytest.raises(OSError, match="lost"):
            rollups.commit(add, ledger, "2")
    assert [tuple(r) for r in rollups.totals(spark, ledger).collect()] == [("s", "en", "v1", 1, 3)]
    assert rollups.commit(add, ledger, "2") and not rollups.commit(add, ledger, "2")
    assert [tuple(r) for r in rollups.totals(spark, ledger).collect()] == [("s", "en", "v1", 2, 6)]


def test_a_commit_that_dies_inside_the_log_changes_nothing(spark, tmp_path):
    add = spark.createDataFrame([("insert", *[None] * 4, "s", "en", "v1", 3)], CHANGES)
    ledger = tmp_path / "ledger"
    rollups.commit(add, str(ledger), "1")
    (ledger / "log" / "000000000002" / "_temporary").mkdir(parents=True)
    (ledger / "log" / ".half").write_text('{"number": 2, "ba')
    (ledger / "log" / "000000000002.json.tmp").write_text("")
    assert rollups.commit(add, str(ledger), "2") and not rollups.commit(add, str(ledger), "2")
    assert [tuple(r) for r in rollups.totals(spark, str(ledger)).collect()] == [("s", "en", "v1", 2, 6)]


def test_of_two_writers_one_commits(spark, tmp_path, monkeypatch):
    add, ledger = spark.createDataFrame([("insert", *[None] * 4, "s", "en", "v1", 3)], CHANGES), str(tmp_path / "ledger")
    rollups.commit(add, ledger, "1")
    record = rollups._record

    def late(*args):
        monkeypatch.setattr(rollups, "_record", record)
        assert rollups.commit(add, ledger, "other")
        record(*args)

    monkeypatch.setattr(rollups, "_record", late)
    with pytest.raises(rollups.Overtaken):
        rollups.commit(add, ledger, "mine")
    assert [tuple(r) for r in rollups.totals(spark, ledger).collect()] == [("s", "en", "v1", 2, 6)]
    assert rollups.commit(add, ledger, "mine") and not rollups.commit(add, ledger, "other")
    assert [tuple(r) for r in rollups.totals(spark, ledger).collect()] == [("s", "en", "v1", 3, 9)]


def test_the_log_stays_short(spark, tmp_path):
    add, ledger = spark.createDataFrame([("insert", *[None] * 4, "s", "en", "v1", 1)], CHANGES), tmp_path / "ledger"
    for i in range(8):
        assert rollups.commit(add, str(ledger), str(i), fold=3)
    assert not any(rollups.commit(add, str(ledger), str(i), fold=3) for i in range(8))
    assert len([f for f in (ledger / "log").iterdir() if f.name.endswith(".json")]) <= 4 and len(list((ledger / "ids").iterdir())) <= 2
    assert [tuple(r) for r in rollups.totals(spark, str(ledger)).collect()] == [("s", "en", "v1", 8, 8)]


def test_rollup_query_equals_plain_counts(spark, documents):
    import base64

    import tiktoken

    encode = {}
    for v in queries.VERSIONS:
        with open(public_tokenizers.path(f"{v}.tiktoken"), "rb") as lines:
            encode[v] = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}, special_tokens={}).encode_ordinary
    want: collections.Counter = collections.Counter()
    for r in documents.itertuples():
        if r.doc_id % 11:
            v = queries.VERSIONS[r.doc_id % 3 == 0]
            key = (r.source or "unknown", r.lang or "unknown", v)
            want[key, "docs"] += 1
            want[key, "tokens"] += len(encode[v](r.text)) if r.text else 0
    got = {(r["source"], r["lang"], r["tokenizer"]): (r["docs"], r["tokens"]) for r in queries.op8_token_rollups(spark, DATA).collect()}
    assert got == {k: (want[k, "docs"], want[k, "tokens"]) for k, _ in want}


def test_token_counts_at_the_edges(spark):
    clash = docs_of(spark, EDGES).withColumn("byte_bpe_50k", F.lit("mine"))
    got = {r["doc_id"]: r["byte_bpe_50k"] for r in rollups.token_counts(clash, {"byte_bpe_50k.tiktoken": F.col("doc_id") < 9}).collect()}
    assert got[0] == got[1] == 0 and got[2] == 1 and got[7] == 30_001 and got[9] is None and len(got) == len(EDGES)
    assert rollups.token_counts(clash.limit(0), {"byte_bpe_50k.tiktoken": F.lit(True)}).count() == 0
