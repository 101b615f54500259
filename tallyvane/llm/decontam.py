"""Benchmark decontamination with DataFrame functions only: SimHash windows of an item's size, found by Hamming blocks.

1. Words are runs of letters and digits, lower-cased; a text is the list of hashes of its five-word shingles.
2. Windows have an item's size. They start wherever enough shingles in reach are an item's: a window and an item of w and m
   shingles that are as similar as asked for share similarity * (w + m) / (1 + similarity) at least, so this leaves out
   only windows that the last step would drop. Fingerprints at every start for every size would cost a corpus of n words
   and a benchmark of s sizes 64 n s bit counts; this costs one lookup a word.
3. A window's and an item's SimHash of 192 bits are cut in blocks of 16. Fingerprints within the radius differ in at
   most BLOCK_RADIUS bits of some block, so the items, the small side, are filed under all values so near to theirs, and a
   window looks up its own twelve. One value of a block meets one unrelated item in a hundred.
4. The weighted similarity of the two bags of shingles, sum of the lesser over sum of the greater counts, decides.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyvane.llm.common import bounded, cut, stored

SHINGLE = 5
SIMILARITY = 0.8
#: SimHashes of 64 bits in a fingerprint, and bits in a block.
WORDS, BLOCK = 3, 16
BLOCK_RADIUS = 3
#: Bits in which some block must be within BLOCK_RADIUS: 47 of 192. A pair of similarity 0.8 differs in 29, give or take
#: five, so one in 5,000 of those that are just so similar is beyond it, and practically none of the more similar ones.
RADIUS = WORDS * 64 // BLOCK * (BLOCK_RADIUS + 1) - 1
#: So many item shingles (about 24 bytes each) are broadcast; those of a larger benchmark are joined by a shuffle.
BROADCAST = 200_000
#: Items of at most so many shingles in all are broadcast to the last step.
BROADCAST_BAGS = 1_000_000


def with_shingles(df: DataFrame, text_col: str, size: int = SHINGLE) -> DataFrame:
    """df with the array `hashes` of all its word shingles, in order, repeats included; null for fewer words than a shingle has."""
    words = F.split(F.trim(F.regexp_replace(F.lower(F.col(text_col)), r"[^\p{L}\p{N}]+", " ")), " ")
    each = df.withColumn("_each", F.transform(words, lambda w: F.xxhash64(w)))
    spans = F.transform(F.sequence(F.lit(0), F.size("_each") - size), lambda i: F.xxhash64(*(F.get(F.col("_each"), i + k) for k in range(size))))
    return each.withColumn("hashes", F.when(F.size("_each") >= size, spans)).drop("_each")


def simhash(hashes: str) -> Column:
    """64-bit SimHash of an array of hashes: a bit is 1 where over half of them have it.

    Bits are counted side by side, in lanes of a long that are as wide as the number of hashes calls for: eight sums for up
    to 127 hashes in place of 64. The uppermost lane must leave the sign alone.
    """

    def counted(lane: int) -> str:
        every = sum(1 << lane * i for i in range(64 // lane))
        sums = f"transform(sequence(0, {lane - 1}), j -> aggregate({hashes}, 0L, (a, h) -> a + (shiftrightunsigned(h, j) & {every}L)))"
        n = f"shiftrightunsigned(c[b % {lane}], cast({lane} * (b div {lane}) as int)) & {(1 << lane) - 1}L"
        return f"transform(array({sums}), c -> aggregate(sequence(0, 63), 0L, (o, b) -> if(2 * ({n}) > size({hashes}), o | shiftleft(1L, b), o)))[0]"

    return F.expr(f"case when size({hashes}) < 128 then {counted(8)} when size({hashes}) < 32768 then {counted(16)} else {counted(32)} end")


def fingerprint(hashes: str) -> Column:
    """WORDS SimHashes of the hashes, each after another rehash, as an array."""
    return F.array(*(simhash(hashes if k == 0 else f"transform({hashes}, h -> xxhash64(h, {k}))") for k in range(WORDS)))


def distance(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)


def blocks(df: DataFrame, prints: str, near: int) -> DataFrame:
    """df with a row for each block of its fingerprint and each value at most `near` bits from it: columns block and bits."""
    own = F.flatten(F.transform(F.col(prints), lambda x: F.array(*(F.shiftrightunsigned(x, BLOCK * k).bitwiseAND(F.lit((1 << BLOCK) - 1)) for k in range(64 // BLOCK)))))
    out = df.select("*", F.posexplode(own).alias("block", "_own"))
    flips = [sum(1 << i for i in c) for n in range(near + 1) for c in combinations(range(BLOCK), n)]
    return out.withColumn("bits", F.explode(F.transform(F.array(*(F.lit(x).cast("long") for x in flips)), lambda x: x.bitwiseXOR(F.col("_own")))) if near else F.col("_own")).drop("_own")


def _bag(hashes: str) -> str:
    """The hashes with each repeat but the first made another one by its number, so that sets of them meet like bags."""
    sort = f"array_sort({hashes})"
    numbered = f"transform({sort}, (x, i) -> if(i + 1 = array_position({sort}, x), x, xxhash64(x, i + 1 - array_position({sort}, x))))"
    return f"if(size(array_distinct({hashes})) = size({hashes}), {hashes}, {numbered})"


def _starts(hit: str) -> Column:
    """Starts of the windows of w shingles that hold at least `need` of the positions in `hit`, which are in order.

    A window holds `need` hits in a row: the last of them lies in it, and the first one isn't before it.
    """
    low, high = f"greatest(0, {hit}[i - 1] - w + 1)", f"least({hit}[i - need], greatest(0, n - m))"
    return F.expr(f"array_distinct(flatten(transform(sequence(need, size({hit})), i -> if({low} <= {high}, sequence({low}, {high}), cast(array() as array<int>)))))")


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    similarity: float = SIMILARITY,
    broadcast_rows: int = BROADCAST,
) -> DataFrame:
    """One row for each document and benchmark item of which it holds a passage: doc_id, item_id, start_word, n_words, similarity.

    The window reported is the most similar one, of equals the first; start_word counts from 0. Null texts, texts and
    items of under five words match nothing. Rows without an id can't be named and are left out; repeated rows count
    once, and of different texts of one id the best window is reported. Very long texts have more windows, not other
    ones. Empty tables give no rows. Other columns aren't read, whatever their names.
    """
    items = with_shingles(benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text).alias("_text")).where("item_id is not null"), "_text")
    items = cut(items.where("hashes is not null").select("item_id", F.col("hashes").alias("item"), F.size("hashes").alias("m"), fingerprint("hashes").alias("item_print")).distinct())
    sizes = items.select("m", F.explode("item").alias("h")).distinct()
    shingles = items.agg(F.coalesce(F.sum("m"), F.lit(0)).alias("n")).first()["n"]
    anchors = F.broadcast(sizes) if shingles <= broadcast_rows else sizes

    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text")).where("doc_id is not null").withColumn("t", F.xxhash64("_text"))
    texts = with_shingles(named, "_text").select("doc_id", "t", "hashes")
    # The outer form: the other one has the optimizer filter on the array's size, and make the array twice for that.
    spread = texts.select("doc_id", "t", F.size("hashes").alias("n"), F.posexplode_outer("hashes").alias("pos", "h"))
    hits = spread.join(anchors, "h").groupBy("doc_id", "t", "n", "m").agg(F.array_sort(F.collect_set("pos")).alias("hit"))
    width = F.least("n", "m")
    need = F.greatest(F.lit(1), F.ceil(similarity * (width + F.col("m")) / (1 + similarity) - 1e-9).cast("int"))
    reach = hits.withColumns({"w": width, "need": need}).where("size(hit) >= need").withColumn("starts", _starts("hit"))
    spots = cut(reach.where("size(starts) > 0").groupBy("doc_id", "t").agg(F.collect_list(F.struct("m", "starts")).alias("spots")))

    # The shingles of texts that have windows, written once: windows and pairs carry their place, not their shingles.
    found = with_shingles(named.join(bounded(spots.select("doc_id", "t"), BROADCAST), ["doc_id", "t"], "left_semi"), "_text")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    held = stored(found.select("doc_id", "t", "hashes").dropDuplicates(["doc_id", "t"]).join(spots, ["doc_id", "t"]).repartition(parts, "doc_id", "t"))
    each = held.select("doc_id", "t", "hashes", F.explode("spots").alias("s")).select("doc_id", "t", "hashes", "s.m", F.explode("s.starts").alias("start"))
    windows = each.withColumn("_win", F.expr("slice(hashes, start + 1, m)")).select("doc_id", "t", "m", "start", fingerprint("_win").alias("print"))

    index = blocks(items.select("item_id", "m", "item_print"), "item_print", BLOCK_RADIUS)
    # The index has thousands of rows an item, which Spark's estimate doesn't know of: it mustn't be taken for a small table.
    near = blocks(stored(windows), "print", 0).join(index.hint("merge"), ["m", "block", "bits"]).where(distance("print", "item_print") <= RADIUS)
    pairs = near.select("doc_id", "t", "start", "item_id").distinct().groupBy("doc_id", "t").agg(F.collect_list(F.struct("start", "item_id")).alias("pairs"))
    bags = items.select("item_id", "item")
    both = held.select("doc_id", "t", "hashes").join(pairs, ["doc_id", "t"]).select("doc_id", "hashes", F.explode("pairs").alias("p"))
    both = both.select("doc_id", "hashes", "p.start", "p.item_id").join(F.broadcast(bags) if shingles <= BROADCAST_BAGS else bags, "item_id")
    both = both.select("doc_id", "item_id", "start", "item", F.expr("slice(hashes, start + 1, size(item))").alias("win"))
    shared = both.withColumn("shared", F.expr(f"size(array_intersect({_bag('win')}, {_bag('item')}))"))
    scored = shared.withColumn("similarity", F.col("shared") / (F.size("win") + F.size("item") - F.col("shared"))).where(F.col("similarity") >= similarity)
    best = scored.groupBy("doc_id", "item_id").agg(F.max(F.struct("similarity", (-F.col("start")).alias("back"), (F.size("win") + SHINGLE - 1).alias("n_words"))).alias("b"))
    return best.select("doc_id", "item_id", (-F.col("b.back")).cast("long").alias("start_word"), F.col("b.n_words").cast("long").alias("n_words"), F.round("b.similarity", 6).alias("similarity"))


#: In DuckDB: every window of an item's size that shares a shingle with an item of that size, against all those items.
SQL = """
with words as (
  select doc_id, string_split(trim(regexp_replace(lower(text), '[^\\p{L}\\p{N}]+', ' ', 'g')), ' ') w from documents where text is not null and doc_id is not null),
items as (
  select item_id, string_split(trim(regexp_replace(lower(text), '[^\\p{L}\\p{N}]+', ' ', 'g')), ' ') w from benchmark where text is not null and item_id is not null),
d as (select doc_id, list_transform(range(len(w) - 4), lambda i: array_to_string(w[i + 1:i + 5], ' ')) s from words where len(w) >= 5),
b as (select item_id, list_transform(range(len(w) - 4), lambda i: array_to_string(w[i + 1:i + 5], ' ')) s from items where len(w) >= 5),
dx as (select doc_id, unnest(s) h, unnest(range(len(s))) pos, len(s) n from d),
bx as (select distinct unnest(s) h, len(s) m from b),
hit as (select distinct doc_id, n, m, pos from dx join bx using (h)),
win as (select distinct doc_id, m, unnest(range(greatest(0, pos - least(n, m) + 1), least(pos, greatest(0, n - m)) + 1)) start from hit),
cand as (
  select win.doc_id, win.start, win.m, b.item_id, d.s[win.start + 1:win.start + win.m] a, b.s c
  from win join d using (doc_id) join b on len(b.s) = win.m where list_has_any(d.s[win.start + 1:win.start + win.m], b.s)),
sim as (
  select doc_id, item_id, start, m, len(a) na, len(c) nc,
    list_sum(list_transform(list_distinct(c), lambda h: least(len(list_filter(a, lambda x: x = h)), len(list_filter(c, lambda x: x = h))))) o from cand),
ok as (select *, o / (na + nc - o) similarity from sim where o / (na + nc - o) >= 0.8),
best as (select *, row_number() over (partition by doc_id, item_id order by similarity desc, start) r from ok)
select doc_id, item_id, start::bigint start_word, (na + 4)::bigint n_words, round(similarity, 6) similarity from best where r = 1
"""
