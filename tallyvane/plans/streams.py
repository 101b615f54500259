"""Queries of the streaming operators: each runs its job over the events as arriving files until none are left, and reads its table back."""

from pyspark.sql import functions as F

from tallyvane.plans.base import query, shared_folder
from tallyvane.streaming import streams as S


def _events(spark, sf, watermark="40 days"):
    # A pattern, as a stream's path that is none must be a folder, and the table may be one file.
    return S.read_stream(spark, f"{sf}/events.parque[t]", spark.read.parquet(f"{sf}/events.parquet").schema, "ts", watermark)


def _kept(spark, stream, root, mode="append"):
    """Run a stream to its end. Complete results replace the table of the batch before; appended ones gather."""

    def step(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{root}/out/part={'all' if mode == 'complete' else batch_id}")

    job = stream.writeStream.outputMode(mode).foreachBatch(step).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
    job.awaitTermination()
    return spark.read.parquet(f"{root}/out").drop("part")


def _naive(df, *names):
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in names})


@query("select event_id, user_id, event_type from events")
def t1_stream_ingest(spark, sf):
    """The same files arrive twice; every event is kept once."""
    both = _events(spark, sf).unionByName(_events(spark, sf))
    return _kept(spark, S.stream_ingest(both, ["event_id"]).select("event_id", "user_id", "event_type"), shared_folder(spark, "stream"))


@query("select event_id, case when value < 1 then 'low' when ts > timestamp '2024-01-25' then 'future' end reason from events")
def t2_stream_gate(spark, sf):
    root = shared_folder(spark, "stream")
    gates = [(F.col("value") < 1, "low"), (F.col("ts") > F.lit("2024-01-25").cast("timestamp"), "future")]
    S.stream_gate(_events(spark, sf), gates, f"{root}/ok", f"{root}/bad", f"{root}/checkpoint").awaitTermination()
    ok, bad = spark.read.parquet(f"{root}/ok"), spark.read.parquet(f"{root}/bad")
    return ok.select("event_id", F.lit(None).cast("string").alias("reason")).unionByName(bad.select("event_id", "reason"))


@query("""with e as (select user_id item, event_type source, ts::date d, round(value * 100)::bigint price from events), l as (select item, source, max(struct_pack(d := d, p := -price)) b from e group by 1, 2),
r as (select item, source, -b.p price, row_number() over (partition by item order by -b.p, source) k from l) select item, price floor, source floor_source from r where k = 1""")
def t3_stream_floor(spark, sf):
    root = shared_folder(spark, "stream")
    src = _events(spark, sf).select(F.col("user_id").alias("item"), F.col("event_type").alias("source"), F.col("ts").cast("date").alias("d"), F.round(F.col("value") * 100).cast("bigint").alias("price"))
    S.stream_floor(src, "item", "source", "d", "price", root + "/table", root + "/checkpoint").awaitTermination()
    return S.floor_of(S.floor_table(spark, root + "/table", "item", "source", "d", "price"), "item", "source", "price")


@query("""with e as (select user_id, ts, event_type v, lag(event_type) over (partition by user_id order by ts) o from events)
select user_id, ts, o old, v as "new", case when o is null then 'new' else 'changed' end kind from e where o is distinct from v""")
def t4_stream_changes(spark, sf):
    out = _kept(spark, S.stream_changes(_events(spark, sf), "user_id", "ts", "event_type"), shared_folder(spark, "stream"))
    return _naive(out, "ts")


@query("select time_bucket(interval 12 hours, ts) \"start\", event_type, count(*) n, round(sum(value), 4) total from events group by 1, 2")
def t5_tumbling(spark, sf):
    out = _kept(spark, S.tumbling(_events(spark, sf), "ts", "12 hours", "value", ["event_type"]), shared_folder(spark, "stream"), "complete")
    return _naive(out.withColumn("total", F.round("total", 4)), "start")


@query("select date_trunc('week', ts) \"start\", count(*) n, round(sum(value), 4) total from events group by 1")
def t5_iso_weeks(spark, sf):
    out = _kept(spark, S.tumbling(_events(spark, sf), "ts", "7 days", "value", start="4 days"), shared_folder(spark, "stream"), "complete")
    return _naive(out.withColumn("total", F.round("total", 4)), "start")


@query("""with d as (select event_type, ts, value, unnest(generate_series(date_trunc('day', ts) - interval 13 day, date_trunc('day', ts), interval 1 day)) s from events)
select s \"start\", event_type, count(*) n, round(avg(value), 4) mean, min(value) low from d group by 1, 2""")
def t6_sliding(spark, sf):
    out = _kept(spark, S.sliding(_events(spark, sf), "ts", "14 days", "1 day", "value", ["event_type"]), shared_folder(spark, "stream"), "complete")
    return _naive(out.withColumn("mean", F.round("mean", 4)), "start")


@query("""with l as (select user_id, ts, case when epoch_us(ts) - epoch_us(lag(ts) over (partition by user_id order by ts)) < 21600000000 then 0 else 1 end c from events), s as (select *, sum(c) over (partition by user_id order by ts rows unbounded preceding) k from l)
select user_id, min(ts) \"start\", max(ts) + interval 6 hour \"end\", count(*) n from s group by user_id, k""")
def t7_sessions(spark, sf):
    out = _kept(spark, S.sessions(_events(spark, sf), "ts", "6 hours", ["user_id"]), shared_folder(spark, "stream"), "complete")
    return _naive(out, "start", "end")
