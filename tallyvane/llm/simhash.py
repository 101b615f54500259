"""SimHash near-duplicates by covering locality-sensitive hashing.

A fingerprint has 64 bits. Every bit gets a nonzero vector of {0,1}^(r+1); table v, for each nonzero v, keeps the bits
whose vector has an odd product with v. The at most r bits in which two fingerprints differ span at most r dimensions,
so some v is orthogonal to them all: that table drops every differing bit, and the two collide in it. No pair within
the radius is missed, whatever the data.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tallyvane.llm.common import cut, small_batches
from tallyvane.llm.components import components

RADIUS = 3
SHINGLE = 3
SEED = 42
#: A bucket is compared within one row up to so many fingerprints; larger ones are split without losing a pair.
BUCKET = 1024


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of a text's word shingles; 0 for a text without words."""
    words = text.encode("utf-8", "replace").lower().split() if text else []
    if not words:
        return 0
    shingles = zip(*(words[i:] for i in range(size)), strict=False) if len(words) >= size else [words]
    join, digest = b" ".join, xxhash.xxh64_intdigest
    hashes = np.array([digest(join(s), SEED) for s in shingles], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for k in range(0, len(hashes), 8192):
        ones += np.unpackbits(hashes[k : k + 8192].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<i8")[0])


@F.pandas_udf(LongType())
def _fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series([fingerprint(t) for t in texts], dtype="int64")


def _masks(radius: int, bits: int = 64) -> list[int]:
    """The bits each table keeps; table t belongs to the vector t + 1."""
    vectors = [(i * 37 % bits) % (2 ** (radius + 1) - 1) + 1 for i in range(bits)]
    return [sum(1 << i for i in range(bits) if bin(vectors[i] & v).count("1") % 2) for v in range(1, 2 ** (radius + 1))]


def _split(mask: int, radius: int, bits: int = 64) -> list[int]:
    """mask and one of radius + 1 parts of the other bits: fingerprints within the radius agree on at least one part."""
    free = [i for i in range(bits) if not mask >> i & 1]
    return [mask | sum(1 << i for i in free[k :: radius + 1]) for k in range(radius + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _keyed(prints: DataFrame, masks: list[int], only: DataFrame | None = None, parts: int = 1) -> DataFrame:
    """Rows (part, key, fp): each fingerprint under each mask, or under the parts of the masks in only (old_part, fp)."""
    if only is None:
        keys = F.array(*(F.struct(F.lit(t).alias("part"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for t, m in enumerate(masks)))
        return prints.select("fp", F.explode(keys).alias("k")).select("k.part", "k.key", "fp")
    table = F.array(*(F.lit(_signed(m)) for m in masks))
    rows = only.select("fp", F.explode(F.sequence(F.col("part") * parts, F.col("part") * parts + parts - 1)).alias("part"))
    return rows.select("part", F.col("fp").bitwiseAND(F.get(table, F.col("part"))).alias("key"), "fp")


def spanning(prints: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that join every two of the prints that links within the radius join, one fewer than each group has members."""
    left = np.sort(prints.view(np.uint64))
    out = []
    while len(left):
        root, front, left = left[0], left[:1], left[1:]
        while len(front) and len(left):
            near = np.zeros(len(left), dtype=bool)
            for k in range(0, len(front), 256):
                near |= (np.bitwise_count(front[k : k + 256, None] ^ left[None, :]) <= radius).any(axis=0)
            front, left = left[near], left[~near]
            out += [(_signed(int(root)), _signed(int(x))) for x in front]
    return out


def _spans(radius: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            links = [x for fps in batch["fps"] for x in spanning(np.asarray(fps, dtype=np.int64), radius)]
            yield pd.DataFrame({"u": np.array([a for a, _ in links], dtype="int64"), "v": np.array([b for _, b in links], dtype="int64")})

    return run


def links(prints: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Links (u, v) between distinct fingerprints (fp) that connect all that lie within the radius of each other.

    Buckets of two give their pair inside the first aggregation. Larger ones are compared in one row each; one of over
    `bucket` fingerprints is split by parts of the bits it leaves free, again and again, so that no row, task or list
    grows with a group of near copies. The links of a bucket span it: their number is linear in its members.
    """
    masks, parts = _masks(radius), radius + 1
    keyed, found = _keyed(prints, masks), None
    close = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= radius
    while True:
        sizes = keyed.groupBy("part", "key").agg(F.count("*").alias("n"), F.min("fp").alias("u"), F.max("fp").alias("v")).where("n > 1")
        sizes = cut(sizes)
        some = sizes.where("n = 2").where(close).select("u", "v")
        counts = sizes.agg(F.coalesce(F.max("n"), F.lit(0)).alias("most")).first()
        if counts["most"] > 2:
            middle = keyed.join(sizes.where(F.col("n").between(3, bucket)).select("part", "key"), ["part", "key"])
            lists = middle.groupBy("part", "key").agg(F.collect_list("fp").alias("fps")).select("fps")
            some = some.unionByName(lists.mapInPandas(_spans(radius), "u long, v long"))
        found = some if found is None else found.unionByName(some)
        if counts["most"] <= bucket:
            return found
        large = keyed.join(sizes.where(F.col("n") > bucket).select("part", "key"), ["part", "key"]).select("part", "fp")
        masks = [x for m in masks for x in _split(m, radius)]
        keyed = cut(_keyed(prints, masks, large, parts))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """One row per row of docs: its id, fingerprint (16 hex digits) and component_id, the least id it is linked to.

    A null text has no words, like an empty one: fingerprint zero, linked like any other. Rows that repeat count as
    copies. A null id keeps its row; it never names a component unless the component has no other id. Other columns of docs aren't read.
    """
    small_batches(docs.sparkSession)
    prints = cut(docs.select(F.col(id_col).alias("doc_id"), _fingerprints(F.col(text_col)).alias("fp")))
    classes = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = components(links(classes.select("fp"), radius, bucket))
    rooted = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
