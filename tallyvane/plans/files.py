"""Queries of the readers and sinks that need files: each writes what it reads back to a new folder."""

from pyspark.sql import functions as F

from tallyvane.plans.base import PAIR, pair, query, shared_folder, table
from tallyvane.sources import readers as R
from tallyvane.sources import writers as X
from tallyvane.sources.versioned import Table


@query("select p_partkey::varchar p_partkey, p_name, case when p_size > 10 then p_size::varchar end size, null::varchar colour from part")
def s1_csv_round_trip(spark, sf):
    """Written as sorted CSV with empty cells for nulls, read back loosely with a column that isn't there."""
    path = shared_folder(spark, "files")
    p = table(spark, sf, "part").select("p_partkey", "p_name", F.when(F.col("p_size") > 10, F.col("p_size")).alias("size"))
    X.write_table(p, path, "csv", ["p_partkey", "p_name", "size"], ["p_partkey"])
    return R.read_csv_loose(spark, path, ["p_partkey", "p_name", "size", "colour"])


@query("select p_partkey, p_name, p_size, case when p_size > 10 then p_brand end brand from part")
def s17_json_round_trip(spark, sf):
    """Written as sorted JSON lines, nulls left out, and back."""
    path = shared_folder(spark, "files")
    p = table(spark, sf, "part").select("p_partkey", "p_name", "p_size", F.when(F.col("p_size") > 10, F.col("p_brand")).alias("brand"))
    X.write_table(p, path, "json", ["p_partkey", "p_name", "p_size", "brand"], ["p_partkey"])
    return spark.read.schema(p.schema).json(path)


@query("select p_name \"name\", p_size::varchar size from part where p_size % 4 <> 0")
def s3_csv_with_comments(spark, sf):
    """Every fourth size's line is a comment."""
    path = shared_folder(spark, "files")
    line = F.concat(F.when(F.col("p_size") % 4 == 0, "# ").otherwise(""), "p_name", F.lit(","), "p_size")
    table(spark, sf, "part").select(line.alias("value")).write.text(path)
    return R.read_csv_loose(spark, path, comment="#", header=["name", "size"])


@query("select p_name || ', ' || p_type \"name\", case when p_partkey % 2 = 1 then p_brand end branch, p_size::varchar price from part")
def s5_migrate_positional(spark, sf):
    """Lines of two columns beside lines of three, the one between inserted later; names hold commas, in quotes."""
    p = table(spark, sf, "part")
    name = F.concat(F.lit('"'), "p_name", F.lit(", "), "p_type", F.lit('"'))
    line = F.when(F.col("p_partkey") % 2 == 1, F.concat_ws(",", name, "p_brand", "p_size")).otherwise(F.concat_ws(",", name, "p_size"))
    return R.migrate_positional(p.select(line.alias("value")), ["name", "price"], ["name", "branch", "price"])


@query("select p_brand heading, p_name \"name\", count(*) n from part group by 1, 2")
def s15_markdown_tables(spark, sf):
    """A report of one table a brand, read back into rows."""
    n = table(spark, sf, "part").groupBy("p_brand", "p_name").agg(F.count("*").alias("n"))
    lines = n.groupBy("p_brand").agg(F.array_join(F.array_sort(F.collect_list(F.concat(F.lit("| "), "p_name", F.lit(" | "), "n", F.lit(" |")))), "\n").alias("body"))
    text = lines.select(F.concat(F.lit("# "), "p_brand", F.lit("\n\n|---|---|\n"), "body").alias("text"))
    rows = R.parse_md_tables(text, "text")
    return rows.select("heading", F.col("cells")[0].alias("name"), F.col("cells")[1].cast("bigint").alias("n"))


@query("select p_brand, count(*) total, sum(case when p_size > 40 then -p_size else 0 end)::bigint change from part group by 1")
def s15_summary_numbers(spark, sf):
    """Numbers of a report's summary lines, read back by pattern."""
    n = table(spark, sf, "part").groupBy("p_brand").agg(F.count("*").alias("n"), F.sum(F.when(F.col("p_size") > 40, -F.col("p_size")).otherwise(0)).alias("c"))
    text = n.select("p_brand", F.concat(F.lit("# Report\n- total: **"), F.format_number("n", 0), F.lit("** items\n- change: "), "c", F.lit(" won")).alias("text"))
    return text.select("p_brand", *R.summary_numbers("text", {"total": r"total: \*\*([0-9,]+)", "change": r"change: (-?[0-9,]+)"}))


@query("select conv_id, turn ms, trim(regexp_replace(text, '[ \\t\\n\\x0b\\f\\r]+', ' ', 'g')) \"text\" from conversations where trim(regexp_replace(text, '[ \\t\\n\\x0b\\f\\r]+', ' ', 'g')) <> ''")
def s16_captions(spark, sf):
    """Conversations as caption documents of one event a turn, cut in two segments, and back."""
    c = table(spark, sf, "conversations")
    cut = F.array(F.struct(F.substring("text", 1, 5).alias("utf8")), F.struct(F.expr("substring(text, 6)").alias("utf8")))
    events = c.groupBy("conv_id").agg(F.to_json(F.struct(F.collect_list(F.struct(F.col("turn").alias("tStartMs"), cut.alias("segs"))).alias("events"))).alias("doc"))
    return R.read_captions(events, "doc", ["conv_id"])


@query("select p_partkey, '2026-06-01' run_date from part where p_size > 20 union all select p_partkey, '2026-06-02' from part where p_size > 30")
def s20_dated_snapshots(spark, sf):
    """Two days' snapshots; the first day's second run replaces its first and leaves the other day alone."""
    path, p = shared_folder(spark, "files"), table(spark, sf, "part").select("p_partkey", "p_size")
    for size, day in ((10, "2026-06-01"), (30, "2026-06-02"), (20, "2026-06-01")):
        X.write_snapshot(p.where(F.col("p_size") > size).select("p_partkey"), path, day)
    return spark.read.parquet(path).select("p_partkey", F.col("run_date").cast("string").alias("run_date"))


def _shelved(df):
    """Rows by a shelf number that a fifth of all items lack, and their brand group, which some lack too."""
    shelf = F.when(F.col("item") % 5 > 0, F.col("item") % 200).alias("shelf")
    group = F.when(F.col("item") % 3 > 0, (F.col("item") % 3).cast("string")).alias("grp")
    return df.groupBy(shelf, group).agg(F.sum("price").alias("price"), F.count("*").alias("n"))


SHELVED = f"""{PAIR}, old as (select case when item % 5 > 0 then item % 200 end shelf, case when item % 3 > 0 then (item % 3)::varchar end grp, sum(price)::bigint price, count(*) n from prev group by all),
new as (select case when item % 5 > 0 then item % 200 end shelf, case when item % 3 > 0 then (item % 3)::varchar end grp, sum(price)::bigint price, count(*) n from cur group by all)"""


@query(f"with {SHELVED} select * from new union all select * from old where not exists (select 1 from new where new.shelf is not distinct from old.shelf and new.grp is not distinct from old.grp)")
def s19_table_upsert(spark, sf):
    """A month's rows put over the last one's in a versioned table, twice; keys may be null."""
    own, (prev, cur) = Table(spark, shared_folder(spark, "table"), parts=8), pair(spark, sf)
    own.upsert(_shelved(prev), ["shelf", "grp"])
    for _ in range(2):
        own.upsert(_shelved(cur), ["shelf", "grp"])
    own.vacuum()
    return own.read()


@query(f"""with {SHELVED} select new.shelf, new.grp, case when old.n is null then 'added' else 'updated' end change, old.price old_price, new.price new_price
from new left join old on new.shelf is not distinct from old.shelf and new.grp is not distinct from old.grp where old.n is null or old.price is distinct from new.price or old.n <> new.n""")
def s19_table_changes(spark, sf):
    """What the later month changed in a versioned table, read from the parts that its version wrote."""
    own, (prev, cur) = Table(spark, shared_folder(spark, "table"), parts=8), pair(spark, sf)
    first = own.upsert(_shelved(prev), ["shelf", "grp"])
    own.upsert(_shelved(cur), ["shelf", "grp"])
    return own.changes(first).select("shelf", "grp", "change", F.col("old.price").alias("old_price"), F.col("new.price").alias("new_price"))


@query(f"with {SHELVED} select * from old union all select * from new where not exists (select 1 from old where new.shelf is not distinct from old.shelf and new.grp is not distinct from old.grp)")
def s18_table_append(spark, sf):
    """The same months, of which the later one only adds what isn't there, twice."""
    own, (prev, cur) = Table(spark, shared_folder(spark, "table"), parts=8), pair(spark, sf)
    own.append(_shelved(prev), ["shelf", "grp"])
    for _ in range(2):
        own.append(_shelved(cur), ["shelf", "grp"])
    return own.read()


@query("select p_partkey, '2026-06-02' run_date from part where p_size > 30")
def s20_latest_snapshot(spark, sf):
    """Snapshots written out of order, one day twice: the pointer stays with the newest day."""
    own, p = Table(spark, shared_folder(spark, "table"), parts=8), table(spark, sf, "part").select("p_partkey", "p_size")
    for size, day in ((10, "2026-06-01"), (40, "2026-06-02"), (20, "2026-06-01"), (30, "2026-06-02"), (5, "2026-05-30")):
        own.snapshot(p.where(F.col("p_size") > size).select("p_partkey"), day)
    return own.read_latest()
