"""Queries of the window and time-series operators."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyvane.operators import aggregates as A
from tallyvane.operators import series as W
from tallyvane.plans.base import MONTHLY, OBS, PAIR, obs, pair, query, table

DAY = "day as (select item, source, d, min(price) price from obs group by all)"


@query(f"""with {OBS}, {DAY}, l as (select *, lag(price) over (partition by item, source order by d) prev, row_number() over (partition by item, source order by d desc) k from day)
select item, source, d, price, prev, case when prev is null then 'new' when price < prev then 'down' when price > prev then 'up' else 'same' end badge from l where k = 1""", dates=["d"])
def w1_prev_value(spark, sf):
    return W.prev_value(obs(spark, sf), ["item", "source"], "d", "price")


@query(f"with {OBS}, {DAY}, l as (select *, lag(price) over (partition by item, source order by d) prev from day) select * from l where price < prev", dates=["d"])
def w2_drop_events(spark, sf):
    return W.drop_events(obs(spark, sf), ["item", "source"], "d", "price")


STUDY = f"""{OBS}, {DAY}, ev as (select distinct item, d from (select *, lag(price) over (partition by item order by d) prev from day where source = 'S0') where price < prev),
s as (select item, d, price from day where source = 'S1'), e as (select item, d, unnest([30, 90]) k from ev),
j as (select e.item, e.d event_date, e.k, max_by(s.price, s.d) filter (s.d <= e.d) before_, min(s.price) filter (s.d > e.d and s.d - e.d <= e.k) after_, count(s.d) n from e left join s on s.item = e.item group by all)"""


def _study(spark, sf):
    o = obs(spark, sf)
    return W.drop_events(o.where("source = 'S0'"), ["item", "source"], "d", "price"), o.where("source = 'S1'")


@query(f"""with {STUDY} select item, event_date, k, before_ as "before", after_ as "after",
case when n = 0 then 'no series' when before_ is null then 'unobservable before' when after_ is null then 'unobservable in window' when after_ < before_ then 'hit' when after_ > before_ then 'reverse' else 'flat' end verdict from j""", dates=["event_date"])
def w3_event_study(spark, sf):
    return W.event_study(*_study(spark, sf), "item", "d", "price", [30, 90])


@query(f"""with {STUDY}, v as (select k, case when n = 0 then 'no series' when before_ is null then 'unobservable before' when after_ is null then 'unobservable in window' when after_ < before_ then 'hit' when after_ > before_ then 'reverse' else 'flat' end verdict from j)
select k, verdict, count(*) n from v group by 1, 2""")
def q15_lead_lag_study(spark, sf):
    return W.event_study(*_study(spark, sf), "item", "d", "price", [30, 90]).groupBy("k", "verdict").agg(F.count("*").alias("n"))


@query(f"""with {OBS}, {DAY}, bad as (select distinct item from (select *, lag(price) over (partition by item order by d) prev from day where source = 'S0') where price < prev and prev > 4 * price),
s as (select item, d, price from day where source = 'S1' and item not in (select item from bad)),
a as (select *, min(price) over (partition by item order by d range between interval 1 day following and interval 90 day following) after_ from s),
c as (select after_ - price change from a where after_ is not null), n as (select count(*) n, count(*) filter (change < 0) drops from c)
select n, drops, (select list_sort(list(change))[floor(count(*) / 2)::bigint + 1] from c) upper_median, round(drops / nullif(n, 0), 4) rate from n""")
def w4_baseline_rate(spark, sf):
    o = obs(spark, sf)
    bad = W.drop_events(o.where("source = 'S0'"), ["item", "source"], "d", "price").where("prev > 4 * price")
    return W.baseline_rate(o.where("source = 'S1'"), bad, "item", "d", "price", 90)


TRAJ = f"""{MONTHLY}, l as (select item, "month", price, lag(price, 1) over w a, lag(price, 2) over w b, count(*) over (partition by item) n, min(price) over (partition by item) lo, max(price) over (partition by item) hi, row_number() over (partition by item order by "month" desc) r from monthly window w as (partition by item order by "month")),
x as (select *, (price - a) / nullif(a, 0) now_, coalesce((a - b) / nullif(b, 0), 0) past, (price - lo) / nullif(hi - lo, 0) at_ from l where r = 1 and n >= 3),
t as (select item, "month" "last", price "value", n periods, case when at_ is null then 'flat' when at_ <= 0.25 then 'cheap' when at_ >= 0.75 then 'dear' else 'middle' end tier,
 case when now_ > 0.015 and past < -0.015 then 'rebound' when now_ < -0.015 and past > 0.015 then 'pullback' when now_ > 0.015 then 'rising' when now_ < -0.015 then 'falling' else 'steady' end tag from x)"""


def _by_month(spark, sf):
    """Observations with their month: trajectory() finds each month's lowest price itself."""
    return obs(spark, sf).select("item", F.date_format("d", "yyyy-MM").alias("month"), "price")


@query(f"with {TRAJ} select * from t")
def w5_trajectory(spark, sf):
    return W.trajectory(_by_month(spark, sf), "item", "month", "price")


@query(f"with {TRAJ} select tier, tag, count(*) n from t group by 1, 2")
def q16_trend_classes(spark, sf):
    return W.trajectory(_by_month(spark, sf), "item", "month", "price").groupBy("tier", "tag").agg(F.count("*").alias("n"))


@query(f"""with {OBS}, day as (select item, d, min(struct_pack(p := price, o := l_off)) s from (select l_partkey item, l_shipdate::date d, round(l_extendedprice)::bigint price, round(l_discount * 100)::double l_off from lineitem) group by 1, 2), dd as (select item, d, s.p price, s.o off from day where s.p > 0),
now_ as (select item, max_by(price, d) cur from dd where d between date '1998-06-01' and date '1998-06-30' group by 1),
m as (select a.item, a.price, count(*) n from dd a join dd b on a.item = b.item and abs(b.price - a.price) <= a.price * 0.2 group by a.item, a.d, a.price),
pl as (select item, max(price) plateau from m join now_ using (item) where n >= 3 and price > cur * 1.1 group by 1),
f as (select item, min(d) first_ from dd join now_ using (item) where price <= cur * 1.2 group by 1),
b as (select item, count(*) flat_days, min(price) lo, max(price) hi, max_by(off, d) off from dd join f using (item) where d < first_ group by 1)
select item, plateau, cur "current", round((1 - cur / plateau) * 100, 2) drop_pct, first_ drop_date, flat_days from now_ join pl using (item) join f using (item) join b using (item)
where plateau - cur >= plateau * 0.2 and first_ between date '1998-06-01' and date '1998-06-30' and flat_days >= 3 and hi - lo <= plateau * 2.0 and coalesce(off <= 6, true)""", dates=["drop_date"])
def w6_rare_drops(spark, sf):
    o = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("item"), F.col("l_shipdate").cast("date").alias("d"), F.round("l_extendedprice").cast("bigint").alias("price"), F.round(F.col("l_discount") * 100).alias("off"))
    return W.rare_drops(o, "item", "d", "price", "1998-06-01", "1998-06-30", 0.2, 0.2, 3, 2.0, "off", 6.0)


@query(f"""with {OBS}, a as (select p_brand, p_partkey, p_size "rank", min(price) price from obs join part on item = p_partkey where source = 'S0' group by all),
b as (select p_brand, p_size other_rank, min(price) other from obs join part on item = p_partkey where source = 'S1' group by all),
j as (select a.p_brand, p_partkey, "rank", price, max(other_rank) filter (other_rank < "rank" and price <= other) beats_rank, min(other) filter (other_rank = "rank") same_rank_price from a left join b on a.p_brand = b.p_brand group by all),
g as (select *, round((price - same_rank_price) * 100.0 / nullif(same_rank_price, 0), 2) same_rank_gap_pct from j)
select *, (case when beats_rank is not null then 100 + 15 * ("rank" - beats_rank) else 0 end + case when same_rank_gap_pct < 0 then round(-same_rank_gap_pct) else 0 end)::bigint score from g""")
def w7_value_lenses(spark, sf):
    o = obs(spark, sf).join(table(spark, sf, "part").select("p_partkey", "p_brand", "p_size"), F.col("item") == F.col("p_partkey"))
    side = lambda s: o.where(F.col("source") == s).groupBy("p_brand", "p_partkey", "p_size").agg(F.min("price").alias("price"))
    return W.lens_score(W.value_lenses(side("S0"), side("S1"), "p_brand", "p_partkey", "p_size", "price"))


@query(f"""with {OBS}, day as (select item, d, min(price) price from obs group by all), r as (select *, row_number() over (partition by item order by d desc) k from day),
g as (select item, count(*) n, min(price) lo, avg(price) me, max_by(price, d) latest from r where k <= 14 group by 1 having count(*) >= 3)
select item, n, latest, latest <= lo recent_low, latest < me below_mean from g""")
def w7_recent_lens(spark, sf):
    return W.recent_lens(obs(spark, sf), "item", "d", "price")


@query(f"""with {OBS}, x as (select p_partkey, round(p_retailprice)::bigint ref, coalesce(f, round(p_retailprice)::bigint) f, coalesce(q, 0) q, p_size from part left join (select item, min(price) f, count(*) q from obs group by 1) on item = p_partkey),
m as (select max(ln(1 + q)) d, max(p_size) s from x)
select p_partkey, round((0.5 * greatest(0, least(1, (ref - f) * 100.0 / ref / 100)) + 0.3 * greatest(0, least(1, ln(1 + q) / coalesce(nullif(d, 0), 1))) + 0.2 * greatest(0, least(1, p_size / coalesce(nullif(s, 0), 1)))) * 100, 4) score from x, m""")
def w8_attractiveness(spark, sf):
    f = obs(spark, sf).groupBy("item").agg(F.min("price").alias("f"), F.count("*").alias("q"))
    x = table(spark, sf, "part").join(f, F.col("item") == F.col("p_partkey"), "left").withColumn("ref", F.round("p_retailprice").cast("bigint"))
    x = x.withColumn("q", F.coalesce("q", F.lit(0))).withColumn("gap", (F.col("ref") - F.coalesce("f", "ref")) * 100.0 / F.col("ref"))
    return W.attractiveness(x, "gap", "q", "p_size").select("p_partkey", "score")


@query("""with x as (select p_partkey, case when p_size < 10 then 'small' when p_size < 30 then 'mid' else 'large' end band, round(p_retailprice * 10)::bigint v from part),
s as (select *, min(v) over (partition by band) lo, max(v) over (partition by band) hi from x),
r as (select p_partkey, band, v, case when hi > lo then round((v - lo) / (hi - lo), 6) else 0.5 end score, row_number() over (partition by band order by v desc, p_partkey) place from s)
select band, p_partkey, v, score, place from r where place <= 10""")
def w9_banded_top_n(spark, sf):
    x = table(spark, sf, "part").select("p_partkey", F.when(F.col("p_size") < 10, "small").when(F.col("p_size") < 30, "mid").otherwise("large").alias("band"), F.round(F.col("p_retailprice") * 10).cast("bigint").alias("v"))
    return W.banded_top_n(x, "band", "v", 10, ["p_partkey"])


GAPS = """a as (select item, min(price) a from obs where source = 'S0' group by 1), b as (select item, min(price) b from obs where source = 'S1' group by 1), cmp as (select item, a, b, p_size from a join b using (item) join part on p_partkey = item)"""


def _cmp(spark, sf, where="true"):
    o = obs(spark, sf).where(where)
    side = lambda s, n: o.where(F.col("source") == s).groupBy("item").agg(F.min("price").alias(n))
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("item"), "p_size")
    return side("S0", "a").join(side("S1", "b"), "item").join(part, "item")


@query(f"with {OBS}, {GAPS} select item, a, b, p_size, b - a gap, (b - a) * p_size gap_total, round((b - a) * 100.0 / nullif(b, 0), 2) gap_pct from cmp")
def w10_gap_table(spark, sf):
    return W.gap_table(_cmp(spark, sf), "a", "b", "p_size")


@query(f"""with {OBS}, {GAPS.replace("from obs where", "from obs where year(d) = 1997 and").replace("a as", "a1 as", 1).replace("b as (select item, min", "b1 as (select item, min").replace("cmp as", "c1 as").replace("from a join b", "from a1 join b1")},
{GAPS.replace("from obs where", "from obs where year(d) = 1998 and").replace("a as", "a2 as", 1).replace("b as (select item, min", "b2 as (select item, min").replace("cmp as", "c2 as").replace("from a join b", "from a2 join b2")},
r1 as (select *, rank() over (order by b - a desc) k from c1), r2 as (select *, rank() over (order by b - a desc) k from c2)
select r1.item, r1.k rank_prev, r2.k rank_cur, r1.k - r2.k climb, case when r2.a = r1.a and r2.b = r1.b then 'none' when abs(r2.a - r1.a) >= abs(r2.b - r1.b) then 'a' else 'b' end cause from r1 join r2 using (item)""")
def w11_rank_movers(spark, sf):
    return W.rank_movers(_cmp(spark, sf, "year(d) = 1997"), _cmp(spark, sf, "year(d) = 1998"), "item", "a", "b")


@query("""with n as (select event_type, ts::date d, user_id, round(sum(value))::bigint v from events group by all),
t as (select event_type, d, user_id from (select *, row_number() over (partition by event_type, d order by v desc, user_id) k from n) where k <= 10),
dd as (select event_type, d, lead(d) over (partition by event_type order by d) nx from (select distinct event_type, d from n)),
f as (select t.event_type, nx d, user_id from t join dd using (event_type, d) where nx is not null), g as (select event_type, min(d) fd from dd group by 1)
select event_type, d, user_id, 'entry' "event" from t join g using (event_type) where d > fd and not exists (select 1 from f where f.event_type = t.event_type and f.d = t.d and f.user_id = t.user_id)
union all select event_type, d, user_id, 'exit' from f where not exists (select 1 from t where f.event_type = t.event_type and f.d = t.d and f.user_id = t.user_id)""", dates=["d"])
def w12_topn_entry_exit(spark, sf):
    n = table(spark, sf, "events").groupBy("event_type", F.col("ts").cast("date").alias("d"), "user_id").agg(F.round(F.sum("value")).cast("bigint").alias("v"))
    return W.topn_entry_exit(n, "d", "user_id", "v", 10, ["event_type"])


@query("""select p_name, p_partkey, p_size, p_retailprice from (select *, row_number() over (partition by p_name order by p_retailprice desc, p_partkey) k from part) where k = 1""")
def w13_best_per_key(spark, sf):
    p = table(spark, sf, "part").select("p_name", "p_partkey", "p_size", "p_retailprice")
    return W.best_per_key(p, ["p_name"], [F.col("p_retailprice").desc(), F.col("p_partkey")])


TOPS = """p14 as (select item from (select item, row_number() over (order by price, item) k from prev) where k <= 14), c16 as (select item from (select item, row_number() over (order by price, item) k from cur) where k <= 16)"""


@query(f"""with {PAIR}, {TOPS} select coalesce(p.item, c.item) item, case when p.item is null then 'new' when c.item is not null then 'still' when coalesce(p.item, c.item) not in (select item from cur) then 'unknown' else 'expired' end status
from p14 p full join c16 c on p.item = c.item""")
def w14_opportunity_diff(spark, sf):
    a, b = pair(spark, sf)
    top = lambda df, n: df.orderBy("price", "item").limit(n)
    return W.opportunity_diff(top(a, 14), top(b, 16), "item", b)


@query(f"""with {PAIR}, c as (select cur.item, prev.price prev_gap, cur.price gap from cur left join prev using (item)), l as (select item from prev order by price desc, item limit 400),
x as (select c.item, gap, prev_gap is null or (gap - prev_gap) * 100.0 > prev_gap * 5.0 fresh, c.item in (select item from l) repeated from c where gap > 0 and c.item % 3 <> 0 or prev_gap is not null and c.item in (select item from prev where qty > 1)),
o as (select *, row_number() over (order by case when fresh then 0 else 1 end, gap desc, item) place from x where fresh or not repeated) select date '1998-06-30' date, item, place, gap, fresh, repeated from o where place <= 5""", dates=["date"])
def w15_recommend(spark, sf):
    """What the state holds of May comes back in June only where it changed."""
    a, b = pair(spark, sf)
    cand = b.select("item", F.col("price").alias("gap")).join(a.select("item", F.col("price").alias("prev_gap"), "qty"), "item", "left").where("item % 3 <> 0 or prev_gap is not null and qty > 1")
    may = a.orderBy(F.col("price").desc(), "item").limit(400).select(F.to_date(F.lit("1998-05-31")).alias("date"), "item")
    state = may.unionByName(b.select(F.to_date(F.lit("1998-06-30")).alias("date"), "item")).unionByName(b.select(F.to_date(F.lit("1998-04-30")).alias("date"), "item"))
    return W.recommend(cand, "item", "prev_gap", "gap", state, "1998-06-30")


@query("""with l as (select *, value - lag(value) over (partition by user_id order by ts, event_id) df from events),
r as (select *, sum(case when abs(df) >= 10 then 1 else 0 end) over (partition by user_id order by ts, event_id) run from l),
k as (select *, row_number() over (partition by user_id, run order by ts, event_id) i, count(*) over (partition by user_id, run) n from r)
select user_id, run::bigint run, min(ts) "start", max(ts) "end", count(*) n, min(ts) filter (i = floor(n / 2) + 1) middle from k group by 1, 2 having count(*) >= 2""")
def w16_stable_runs(spark, sf):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = table(spark, sf, "events").withColumn("df", F.abs(F.col("value") - F.lag("value").over(w)))
    return W.stable_runs(e, "user_id", "ts", "df", 10.0, 2, "event_id")


@query("""with l as (select *, lag(event_type) over w pe, lag(ts) over w pt from events window w as (partition by user_id order by ts))
select event_id, user_id, ts, event_type from l where not coalesce(event_type = pe and epoch_us(ts) - epoch_us(pt) <= 86400000000, false)""")
def w16_dedup_adjacent(spark, sf):
    e = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp")).select("event_id", "user_id", "ts", "event_type")
    return W.dedup_adjacent(e, "user_id", "ts", "event_type", 86400).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("""with d as (select distinct user_id, ts::date d from events), l as (select *, lead(d) over (partition by user_id order by d) nx from d)
select user_id, unnest(generate_series(d + 1, nx - 1, interval 1 day))::date d from l where nx - d > 1""", dates=["d"])
def w16_fill_gaps(spark, sf):
    e = table(spark, sf, "events").select("user_id", F.col("ts").cast("date").alias("d"))
    return W.fill_gaps(e, "user_id", "d")


@query("""select user_id, count(distinct ts::date) "days", max(ts::date) - min(ts::date) + 1 span, round(count(distinct ts::date) / (max(ts::date) - min(ts::date) + 1), 4) coverage from events group by 1""")
def w16_coverage(spark, sf):
    e = table(spark, sf, "events").select("user_id", F.col("ts").cast("date").alias("d"))
    return W.coverage(e, "user_id", "d")


@query("""with e as (select user_id, ts, event_type, event_id from events), f as (select *, case when event_type = lag(event_type) over w then 0 else 1 end c from e window w as (partition by user_id order by ts, event_type)),
s as (select *, sum(c) over (partition by user_id order by ts, event_type rows unbounded preceding) - 1 segment from f)
select user_id, segment::bigint segment, min(ts) "start", max(ts) "end", count(*) "rows", min(event_type) event_type, min(user_id % 7) kind from s group by 1, 2""")
def w17_merge_segments(spark, sf):
    e = table(spark, sf, "events").select("user_id", "ts", "event_type", (F.col("user_id") % 7).alias("kind"))
    return W.merge_segments(e, "user_id", "ts", "event_type", "kind")


@query(f"""with {PAIR}, c as (select p_partkey item, cur.price from part left join cur on cur.item = p_partkey)
select c.item, coalesce(c.price, prev.price) price, case when c.price is null and prev.price is not null then '[carried]' else '' end note, c.price is null and prev.price is not null carried from c left join prev using (item)""")
def w18_carry_forward(spark, sf):
    a, b = pair(spark, sf)
    cur = table(spark, sf, "part").select(F.col("p_partkey").alias("item")).join(b.select("item", "price"), "item", "left").withColumn("note", F.lit("[carried]"))
    return W.carry_forward(cur, a, "item", "price")


@query("""with d as (select event_type k, ts::date d, round(sum(value))::bigint v from events group by 1, 2), r as (select *, row_number() over (partition by k order by d desc) r, d between date '2024-01-08' and date '2024-01-14' i from d),
a as (select k, count(*) filter (i) points, min_by(v, d) filter (i) a, max_by(v, d) filter (i) b, max(v) filter (r = 2) c, max(v) filter (r = 1) e from r group by 1),
f as (select k, points, case when points >= 2 then a else c end "first", case when points >= 2 then b else e end "last" from a)
select k, points, "first", "last", "last" - "first" change, round(("last" - "first") * 100.0 / nullif("first", 0), 4) pct from f""")
def w19_window_change(spark, sf):
    d = table(spark, sf, "events").groupBy(F.col("event_type").alias("k"), F.col("ts").cast("date").alias("d")).agg(F.round(F.sum("value")).cast("bigint").alias("v"))
    return W.window_change(d, "k", "d", "v", "2024-01-08", "2024-01-14")


HIGH = f"""{PAIR}, dd as (select item, p.price old, c.price new_, round((c.price - p.price) * 100.0 / nullif(p.price, 0), 4) pct from prev p join cur c using (item)), fl as (select item, min(price) f from obs where d < date '1998-05-01' group by 1),
h as (select dd.item, old, new_, pct, case when new_ < f then 'breakthrough' when pct <= -3 then 'drop' when pct >= 3 then 'rise' else 'other' end highlight, case when abs(pct) >= 10 then 'major' else 'minor' end weight from dd left join fl using (item)
 where not ((abs(new_ - old) < 1000 and abs(pct) < 1) or new_ = old))"""


def _highlights(spark, sf):
    diff = A.snapshot_diff(*pair(spark, sf), "item", "price").where("old is not null and new is not null")
    floor = obs(spark, sf).where("d < date'1998-05-01'").groupBy("item").agg(F.min("price").alias("floor"))
    return W.classify_highlights(diff, floor, "item", "new", "pct", "floor").select("item", "old", "new", "pct", "highlight", "weight")


@query(f'with {HIGH} select item, old, new_ as "new", pct, highlight, weight from h')
def w20_highlights(spark, sf):
    return _highlights(spark, sf)


@query(f"""with {HIGH}, a as (select count(*) filter (highlight = 'breakthrough' or weight = 'major') urgent, count(*) filter (highlight <> 'other') notable from h)
select *, case when urgent > 0 then 'instant' when notable > 0 then 'digest' else 'none' end cadence from a""")
def w20_cadence(spark, sf):
    return W.cadence(_highlights(spark, sf))
