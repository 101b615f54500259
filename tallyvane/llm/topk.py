"""Exact top-k in Hamming distance by incremental multi-index hashing.

A code of 64 bits is cut in segments. Two codes within distance m (a + 1) - 1, for m segments, differ in at most a bits
in some segment. Round a looks up, for every open query, the values at distance a of each of its segments; the codes
found are verified. A query closes when its k-th distance is within what the rounds so far cover, so nothing nearer,
nor as near, can be missing. The segments are chosen as wide as the table's size calls for.

Codes are searched, not rows: copies of a code are one entry with the least k + 1 ids of its rows, as no more of them can
be in a result.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyvane.llm.common import cut

BITS = 64
K = 10


def sign_code(vector: str) -> Column:
    """64 bits: bit i is 1 where the vector's value i is over 0; missing, null and NaN values give 0 (NaN is over everything in Spark, so it is left out). Null for a null vector."""
    bit = f"if(coalesce(get({vector}, i), 0) > 0 and not isnan(get({vector}, i)), shiftleft(1L, i), 0L)"
    return F.expr(f"if({vector} is null, null, aggregate(transform(sequence(0, {BITS - 1}), i -> {bit}), 0L, (a, x) -> a | x))")


def segments(rows: int) -> list[tuple[int, int]]:
    """(first bit, width) of the segments: about log2 of the rows wide, so that a value has about one code."""
    m = min(16, max(2, ceil(BITS / max(4, round(log2(max(rows, 2)))))))
    edges = [BITS * i // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def _values(code: str, cuts: list[tuple[int, int]]) -> list[Column]:
    return [F.shiftrightunsigned(F.col(code), a).bitwiseAND(F.lit((1 << w) - 1)) for a, w in cuts]


def _probes(codes: DataFrame, cuts: list[tuple[int, int]], distance: int) -> DataFrame:
    """Rows (query_code, segment, value): of each segment the values in which so many bits differ, each once.

    Bits are flipped one after the other, each above the one before, so nothing is listed on the driver or broadcast.
    """
    width = F.get(F.array(*(F.lit(w) for _, w in cuts)), F.col("segment"))
    rows = codes.select("query_code", F.posexplode(F.array(*_values("query_code", cuts))).alias("segment", "value")).select("*", width.alias("w"), F.lit(0).alias("next"))
    for _ in range(distance):
        flips = rows.select("*", F.explode(F.expr("if(next < w, sequence(next, w - 1), cast(array() as array<int>))")).alias("bit"))
        rows = flips.select("query_code", "segment", F.expr("value ^ shiftleft(1L, bit)").alias("value"), "w", (F.col("bit") + 1).alias("next"))
    return rows.select("query_code", "segment", "value")


def search(queries: DataFrame, rows: DataFrame, k: int = K, id_col: str = "vec_id", code_col: str = "code") -> DataFrame:
    """For each query the k rows of the nearest codes, itself excepted: query_id, rank, its id as neighbor_id, and distance.

    Both tables have an id and a 64-bit code. Ties go to the lesser id. Rows without id or code take no part; an id that
    repeats with one code counts once. With k rows or fewer in all, every other row is returned, and without rows or
    queries none. Other columns aren't read, whatever their names.
    """
    own = rows.select(F.col(id_col).alias("id"), F.col(code_col).alias("code")).where("id is not null and code is not null").distinct()
    least = Window.partitionBy("code").orderBy("id")
    members = cut(own.withColumn("n", F.row_number().over(least)).where(F.col("n") <= k + 1).select("code", "id"))
    codes = cut(members.select("code").distinct())
    total = codes.count()
    asked = cut(queries.select(F.col(id_col).alias("query_id"), F.col(code_col).alias("query_code")).where("query_id is not null and query_code is not null").distinct())
    cuts = segments(total)
    index = codes.select("code", F.posexplode(F.array(*_values("code", cuts))).alias("segment", "value"))

    open_codes = asked.select("query_code").distinct()
    # Of every code there is one row at least, so the k + 1 nearest codes hold the k + 1 nearest rows; ties are kept by covering them.
    want = min(k + 1, total)
    hits, done, bound = None, None, None
    widest = max(w for _, w in cuts)
    for a in range(widest + 1):
        near = _probes(open_codes, cuts, a).join(index, ["segment", "value"]).select("query_code", "code", F.bit_count(F.col("query_code").bitwiseXOR(F.col("code"))).alias("distance"))
        if hits is not None:
            # Nothing further than a query's k-th so far can be in its result, so it needn't be shuffled.
            near = near.join(bound, "query_code", "left").where(F.col("kth").isNull() | (F.col("distance") <= F.col("kth"))).drop("kth")
            near = near.unionByName(hits.join(open_codes, "query_code", "left_semi"))
        nearest = Window.partitionBy("query_code").orderBy("distance")
        # All codes as near as the k-th stay: a tie between codes is settled by the ids of their rows.
        hits = cut(near.distinct().withColumn("place", F.rank().over(nearest)).where(F.col("place") <= want).drop("place"))
        covered = len(cuts) * (a + 1) - 1
        bound = hits.groupBy("query_code").agg(F.max("distance").alias("kth"), F.count("*").alias("n")).where(F.col("n") >= want).select("query_code", "kth")
        closed = cut(bound.where(F.col("kth") <= covered).select("query_code")) if a < widest else open_codes
        ready = hits.join(closed, "query_code", "left_semi")
        done = ready if done is None else done.unionByName(ready)
        open_codes = cut(open_codes.join(closed, "query_code", "left_anti"))
        if a == widest or open_codes.isEmpty():
            break
    rows_near = done.join(members, "code").join(asked, "query_code").where(F.col("id") != F.col("query_id"))
    rank = Window.partitionBy("query_id").orderBy("distance", "id")
    return rows_near.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("long"), F.col("id").alias("neighbor_id"), F.col("distance").cast("long").alias("distance"))


#: The same in DuckDB, every query against every row.
SQL = """
with c as (
  select distinct vec_id, list_sum(list_transform(range(64), lambda i: case when coalesce(embedding[i + 1], 0) > 0 and not isnan(embedding[i + 1]) then (1::ubigint << i::ubigint)::hugeint else 0::hugeint end))::hugeint code
  from embeddings where vec_id is not null and embedding is not null),
p as (
  select q.vec_id query_id, r.vec_id neighbor_id, bit_count(xor(q.code, r.code))::bigint distance
  from c q join c r on q.vec_id <> r.vec_id where q.vec_id % 50 = 0),
k as (select *, row_number() over (partition by query_id order by distance, neighbor_id) rank from p)
select query_id, rank, neighbor_id, distance from k where rank <= 10
"""
