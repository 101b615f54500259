"""Hard negatives from Hilbert-ordered Parquet blocks with zone maps.

Vectors of whole entries are sorted along a Hilbert curve and written as Parquet rows of BLOCK vectors each, with the least
and greatest entry by dimension: the block's zone map. Zone maps of FAN neighbours make one above them, up to a root.
The rows to ask for (anchors) are grouped in the same order, at most GROUP to a row.

An ask wants the k best rows of an anchor with its label, or with another, whose score (the inner product) lies in a
window. It is first put to the blocks that hold its group's anchors, and the k-th score found there raises the window's
lower end. Then the zone maps are walked from the root: interval arithmetic bounds every score that a box can give, and
only children whose bounds meet some window of the group go on. The blocks left are read, and nothing else can hold a
better row. Positives are one ask, each positive's window of negatives another.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import gcd

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyvane.llm import whitening
from tallyvane.llm.common import cut, stored

K = 5
SCALE = 256
BLOCK, GROUP, FAN = 512, 256, 32
#: Cells by dimension along the curve: cut at the mean and a part of the deviation on both sides.
BITS, CUTS = 2, (-0.6745, 0.0, 0.6745)
#: Greatest entry by magnitude; beyond it a long can't hold all scores.
LIMIT = 1 << 24
#: A zone map names its labels up to so many; with more it may hold any.
LABELS = 64
_LOW, _HIGH = -(1 << 62), 1 << 62


def whole(vectors: DataFrame, label: Column, anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Rows (vec_id, label, anchor, x) that take part, x with floor(256 * c) for every entry c.

    Left out are rows with a null id or label, a null or empty vector or a null or non-finite entry in it, or one of 65536
    (LIMIT / 256) or more in magnitude, as scores then needn't fit a long; and those whose length isn't the commonest (of equally
    common ones the greatest). A null anchor is false. Other columns aren't read.
    """
    own = vectors.select(F.col(id_col).cast("long").alias("vec_id"), label.cast("int").alias("label"), F.coalesce(anchor, F.lit(False)).alias("anchor"), F.col(vector_col).alias("c"))
    c = F.col("c")
    sound = F.forall(c, lambda e: e.isNotNull() & ~F.isnan(e.cast("double")) & (F.abs(e.cast("double")) < LIMIT // SCALE))
    rows = own.where("vec_id is not null and label is not null and c is not null").where((F.size(c) > 0) & F.coalesce(sound, F.lit(False)))
    sizes = rows.groupBy(F.size(c).alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    x = F.transform(c, lambda e: F.floor(SCALE * e.cast("double")).cast("long"))
    return rows.where(F.size(c) == (sizes["d"] if sizes else 0)).select("vec_id", "label", "anchor", x.alias("x"))


def hilbert(cells: np.ndarray, bits: int = BITS) -> list[bytes]:
    """Places along the Hilbert curve of rows of cell numbers, one a dimension, each of so many bits; as bytes that sort like them."""
    x = cells.astype(np.uint8).T.copy()  # a dimension a row
    d = len(x)
    # From the top bit down, turn and mirror the cube that the bits above have chosen.
    for level in range(bits - 1, 0, -1):
        bit, below = np.uint8(1 << level), np.uint8((1 << level) - 1)
        for i in range(d):
            inside = (x[i] & bit) > 0
            swap = np.where(inside, 0, (x[0] ^ x[i]) & below).astype(np.uint8)
            x[0] ^= np.where(inside, below, swap)
            x[i] ^= swap
    # Neighbours along the curve differ in one bit.
    for i in range(1, d):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] & np.uint8(1 << level), np.uint8((1 << level) - 1), 0).astype(np.uint8)
    x ^= turn
    planes = np.concatenate([(x >> level) & 1 for level in range(bits - 1, -1, -1)])
    return [r.tobytes() for r in np.packbits(planes.T, axis=1)]


def _ordered(rows: DataFrame) -> DataFrame:
    """rows with `place`, where they lie along the curve through the dimensions by falling variance."""
    own = whitening.moments(rows)
    if own is None:
        return rows.withColumn("place", F.lit(b""))
    spread = np.sqrt(whitening.summed(rows, own, lambda c: (c * c).sum(axis=0), own.d) / own.n)
    dims = np.argsort(-spread, kind="stable")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                from_mean = own.centred(whitening.matrix(b.column("x")))[:, dims]
                cells = sum((from_mean > c * spread[dims]).astype(np.uint8) for c in CUTS)
                yield b.append_column("place", pa.array(hilbert(cells), pa.binary()))

    return rows.mapInArrow(run, "vec_id long, label int, anchor boolean, x array<long>, place binary")


_BLOCKS = "kind string, part int, i int, n int, ids array<long>, labels array<int>, x binary, low array<long>, high array<long>, seen array<int>, homes array<int>"


def blocks(rows: DataFrame) -> DataFrame:
    """The rows of whole() as blocks and groups of anchors, written to the shared folder.

    Each row has kind (`block` or `group`), part and i (its place: parts follow each other along the curve), n, the
    vectors' ids and labels, their entries as little-endian bytes (x), a block its zone map (low, high, seen: its labels, null for
    many), a group the blocks of its part that hold its anchors (homes). A row that is there twice, id, label and vector, counts once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        names = [c.split(" ")[0] for c in _BLOCKS.split(", ")]
        kinds = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32())]
        made = {"block": 0, "group": 0}

        def row(kind: str, own: list[tuple], homes: list[int] | None) -> pa.RecordBatch:
            x = np.array([r[2] for r in own], dtype="<i4")
            labels = np.array([r[1] for r in own], dtype=np.int32)
            seen = np.unique(labels)
            zone = (x.min(axis=0).astype(np.int64), x.max(axis=0).astype(np.int64), seen if len(seen) <= LABELS else None) if kind == "block" else (None, None, None)
            out = (kind, part, made[kind], len(own), [r[0] for r in own], labels, x.tobytes(), *zone, homes)
            made[kind] += 1
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(out, kinds, strict=True)], names)

        block, group, homes, last = [], [], [], None
        for b in batches:
            if not b.num_rows:
                continue
            x = whitening.matrix(b.column("x"))
            for vec_id, label, anchor, own in zip(b.column("vec_id").to_pylist(), b.column("label").to_pylist(), b.column("anchor").to_pylist(), x, strict=True):
                if last is not None and last[:2] == (vec_id, label) and (last[2] == own).all():
                    continue
                last = (vec_id, label, own)
                block.append(last)
                if anchor:
                    group.append(last)
                    homes.append(made["block"])
                if len(block) == BLOCK:
                    yield row("block", block, None)
                    block = []
                if len(group) == GROUP:
                    yield row("group", group, sorted(set(homes)))
                    group, homes = [], []
        if block:
            yield row("block", block, None)
        if group:
            yield row("group", group, sorted(set(homes)))

    order = ["place", "vec_id"]
    sorted_rows = _ordered(rows).repartitionByRange(*order).sortWithinPartitions(*order, "label", "x", F.desc("anchor"))
    return stored(sorted_rows.select("vec_id", "label", "anchor", "x").mapInArrow(run, _BLOCKS))


def _node(part: Column, i: Column) -> Column:
    return F.struct(part.alias("part"), i.alias("i"))


def zones(made: DataFrame) -> list[DataFrame]:
    """By level from the root's children (FAN at most) down to the blocks: rows (up, node, low, high, seen), node and the one above it as structs (part, i).

    Inside a part FAN neighbours make a node, level by level until one is left; then FAN parts do. No blocks give no levels.
    """
    own = made.where("kind = 'block'").select("part", "i", "low", "high", "seen")
    most = own.agg(F.max("part").alias("p"), F.max("i").alias("i")).first()
    if most["p"] is None:
        return []
    shift = FAN.bit_length() - 1
    inner, outer = (-(-most[k].bit_length() // shift) for k in ("i", "p"))

    def up(level: int) -> Column:
        part, i = F.col("node.part"), F.col("node.i")
        return _node(part, F.shiftright(i, shift)) if level < inner else _node(F.shiftright(part, shift), F.lit(0))

    levels = [own.select(_node(F.col("part"), F.col("i")).alias("node"), "low", "high", "seen").withColumn("up", up(0))]
    for level in range(1, inner + outer):
        below = levels[-1]
        boxes = below.select(F.col("up").alias("node"), F.posexplode(F.arrays_zip("low", "high")).alias("at", "z")).groupBy("node", "at").agg(F.min("z.low").alias("l"), F.max("z.high").alias("h"))
        boxes = boxes.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("at", "l", "h"))).alias("b"))
        said = below.groupBy(F.col("up").alias("node")).agg(F.when(F.count_if(F.col("seen").isNull()) == 0, F.array_distinct(F.flatten(F.collect_list("seen")))).alias("seen"))
        known = F.when(F.size("seen") <= LABELS, F.col("seen")).alias("seen")
        levels.append(cut(boxes.join(said, "node").select("node", F.col("b.l").alias("low"), F.col("b.h").alias("high"), known).withColumn("up", up(level))))
    return levels[::-1]


def _dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T, exact: by doubles where they hold every partial sum, else by longs."""
    if a.size and b.size and int(np.abs(a).max()) * int(np.abs(b).max()) * a.shape[1] < 1 << 53:
        return (a.astype(float) @ b.T.astype(float)).astype(np.int64)
    return a.astype(np.int64) @ b.T.astype(np.int64)


def bounds(a: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and greatest inner product that each row of a can have with anything in each box."""
    plus, minus = np.maximum(a, 0), np.minimum(a, 0)
    return _dot(plus, low) + _dot(minus, high), _dot(plus, high) + _dot(minus, low)


def _vectors(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, labels = np.array(row["ids"], dtype=np.int64), np.array(row["labels"], dtype=np.int32)
    return ids, labels, np.frombuffer(row["x"], dtype="<i4").reshape(len(ids), -1)


def _asked(row: dict) -> np.ndarray:
    """Columns at, slot, low, high of a group's asks."""
    return np.array([(a["at"], a["slot"], a["low"], a["high"]) for a in row["asks"]], dtype=np.int64).reshape(-1, 4)


def _children(same: bool):
    """Of rows (group with asks, a list of zone maps) the nodes that some ask of the group can't do without."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = {k: [] for k in ("part", "group", "node_part", "node_i")}
            for row in b.to_pylist():
                _, labels, x = _vectors(row)
                asks = _asked(row)
                at = asks[:, 0]
                least, most = bounds(x, np.array([z["low"] for z in row["zones"]]), np.array([z["high"] for z in row["zones"]]))
                wanted = (most[at] >= asks[:, 2, None]) & (least[at] <= asks[:, 3, None])
                for k, z in enumerate(row["zones"]):
                    seen = z["seen"]
                    fits = np.ones(len(at), dtype=bool) if seen is None else np.isin(labels[at], seen) if same else np.full(len(at), len(seen) > 1) | (labels[at] != seen[0])
                    if (wanted[:, k] & fits).any():
                        for name, v in zip(out, (row["part"], row["group"], z["node"]["part"], z["node"]["i"]), strict=True):
                            out[name].append(v)
            yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.int32()) for k, v in out.items()})

    return run


def _answers(same: bool, k: int):
    """Of rows (group with asks, a list of blocks) the k best rows of those blocks for each ask."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for row in b.to_pylist():
                own, labels, x = _vectors(row)
                asks = _asked(row)
                at = asks[:, 0]
                best = [(np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64))] * len(asks)
                for block in row["zones"]:
                    ids, kinds, vectors = _vectors(block)
                    scores = _dot(x, vectors)
                    fits = ((kinds[None, :] == labels[:, None]) == same) & (ids[None, :] != own[:, None])
                    inside = fits[at] & (scores[at] >= asks[:, 2, None]) & (scores[at] <= asks[:, 3, None])
                    for j in np.flatnonzero(inside.any(axis=1)):
                        s = np.r_[best[j][0], scores[at[j]][inside[j]]]
                        i = np.r_[best[j][1], ids[inside[j]]]
                        first = np.lexsort((i, -s))[:k]
                        best[j] = s[first], i[first]
                out += [(row["part"], row["group"], a[0], a[1], s, i) for a, found in zip(asks.tolist(), best, strict=True) for s, i in zip(*(v.tolist() for v in found), strict=True)]
            columns = list(zip(*out, strict=True)) or [()] * 6
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["part", "group", "at", "slot", "score", "id"])

    return run


_GROUP = ["part", "group"]


def _read(pairs: DataFrame, made: DataFrame, groups: DataFrame, same: bool, k: int) -> DataFrame:
    """The k best rows (part, group, at, slot, score, id, rank) for each ask, from pairs of a group and a block (node_part, node_i)."""
    own = made.where("kind = 'block'").select(F.col("part").alias("node_part"), F.col("i").alias("node_i"), "ids", "labels", "x")
    lists = pairs.join(own, ["node_part", "node_i"]).groupBy(*_GROUP, "node_part", F.floor(F.col("node_i") / FAN).alias("_of")).agg(F.collect_list(F.struct("ids", "labels", "x")).alias("zones"))
    found = lists.join(groups, _GROUP).select(*_GROUP, "ids", "labels", "x", "asks", "zones").mapInArrow(_answers(same, k), "part int, group int, at int, slot int, score long, id long")
    order = Window.partitionBy(*_GROUP, "at", "slot").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(asks: DataFrame, made: DataFrame, levels: list[DataFrame], same: bool, k: int = K) -> DataFrame:
    """The k best rows for each ask (part, group, at, slot, low, high): its columns but low and high, with score, id and rank.

    part, group and at name the anchor in the table of blocks(). Those rows have the anchor's label (same) or another one, another
    id, and a score from low to high; the higher score comes first, then the lesser id. An ask may have fewer, or none.
    """
    plain = made.where("kind = 'group'").select("part", F.col("i").alias("group"), "ids", "labels", "x", "homes")

    def with_asks(own: DataFrame) -> DataFrame:
        lists = own.groupBy(*_GROUP).agg(F.collect_list(F.struct("at", "slot", "low", "high")).alias("asks"))
        return plain.join(lists, _GROUP)

    seeded = with_asks(asks)
    at_home = seeded.select(*_GROUP, F.col("part").alias("node_part"), F.explode("homes").alias("node_i"))
    full = _read(at_home, made, seeded, same, k).where(F.col("rank") == k).select(*_GROUP, "at", "slot", F.col("score").alias("kth"))
    raised = cut(asks.join(full, [*_GROUP, "at", "slot"], "left").select(*_GROUP, "at", "slot", F.greatest("low", F.coalesce("kth", "low")).alias("low"), "high"))
    groups = cut(with_asks(raised))
    one, pairs = F.struct("node", "low", "high", "seen"), None
    for zone in levels:
        if pairs is None:
            # The root's children are FAN at most: one row, broadcast.
            lists = groups.select(*_GROUP).crossJoin(F.broadcast(zone.agg(F.collect_list(one).alias("zones"))))
        else:
            met = pairs.join(zone, (F.col("node_part") == F.col("up.part")) & (F.col("node_i") == F.col("up.i")))
            lists = met.groupBy(*_GROUP, "up").agg(F.collect_list(one).alias("zones"))
        pairs = cut(lists.join(groups, _GROUP).select(*_GROUP, "ids", "labels", "x", "asks", "zones").mapInArrow(_children(same), "part int, group int, node_part int, node_i int"))
    return _read(pairs, made, groups, same, k)


def mine(rows: DataFrame, k: int = K, least: tuple[int, int] = (80, 100)) -> DataFrame:
    """Hard negatives of the anchors among the rows of whole(): anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    An anchor's positives are its k best other rows (other ids) of its label. A positive's negatives are the k best rows of other labels whose
    score is from that share (a ratio) of the positive's up to it, so a positive with a score under zero has none. Rows with one id
    but different vectors or labels are rows of their own, and anchors of their own. No rows, no anchors or one label give none.
    """
    made = blocks(rows)
    levels = zones(made)
    if not levels:
        return rows.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    anchors = made.where("kind = 'group'").select("part", F.col("i").alias("group"), F.posexplode("ids").alias("at", "anchor_id"))
    first = anchors.select(*_GROUP, "at", F.lit(0).alias("slot"), F.lit(_LOW).alias("low"), F.lit(_HIGH).alias("high"))
    found = search(first, made, levels, True, k)
    positives = cut(found.select(*_GROUP, "at", F.col("rank").alias("slot"), F.col("score").alias("positive_score"), F.col("id").alias("positive_id")))
    a, b = least[0] // gcd(*least), least[1] // gcd(*least)
    windows = positives.where("positive_score >= 0").select(*_GROUP, "at", "slot", F.expr(f"(positive_score * {a} + {b - 1}) div {b}").alias("low"), F.col("positive_score").alias("high"))
    negatives = search(windows, made, levels, False, k).select(*_GROUP, "at", "slot", F.col("rank").cast("int"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    named = negatives.join(positives, [*_GROUP, "at", "slot"]).join(anchors, [*_GROUP, "at"])
    return named.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


#: The same in DuckDB, every anchor against every row, for the labels and anchors of the registered query.
SQL = """
with e as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end label,
    list_transform(embedding, lambda c: floor(256 * c::double)::bigint) x
  from embeddings
  where vec_id is not null and label is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda c: c is not null and isfinite(c) and abs(c) < 65536)) = len(embedding)),
r as (select distinct * from e where len(x) = (select len(x) from e group by 1 order by count(*) desc, 1 desc limit 1)),
s as (
  select a.vec_id anchor_id, b.vec_id other_id, a.label = b.label same,
    list_sum(list_transform(range(1, len(a.x) + 1), lambda i: a.x[i] * b.x[i]))::bigint score
  from r a join r b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0),
p as (select * from s where same qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5)
select p.anchor_id, p.other_id positive_id, n.other_id negative_id, p.score positive_score, n.score negative_score,
  row_number() over (partition by p.anchor_id, p.other_id order by n.score desc, n.other_id)::int rank
from p join s n on p.anchor_id = n.anchor_id and not n.same and 80 * p.score <= 100 * n.score and n.score <= p.score
qualify rank <= 5
"""
