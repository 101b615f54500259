"""Queries of the aggregation operators."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyvane.operators import aggregates as A
from tallyvane.operators import joins as J
from tallyvane.operators import ranking
from tallyvane.plans.base import OBS, PAIR, obs, pair, query, table
from tallyvane.plans.functions import FX_SQL, _fx

LATEST = """day as (select item, source, d, min(price) price from obs group by all),
lag_ as (select *, lag(price) over (partition by item, source order by d) prev, row_number() over (partition by item, source order by d desc) n from day),
latest as (select item, source, d, price, prev from lag_ where n = 1)"""


@query(f"""with {OBS}, {LATEST}, r as (select *, row_number() over (partition by item order by price, source) k from latest)
select item, price floor, source floor_source, d floor_date, prev from r where k = 1""", dates=["floor_date"])
def a1_source_latest_floor(spark, sf):
    return A.source_latest_floor(obs(spark, sf))


@query(f"""with {OBS}, g as (select * from obs where source in ('S0', 'S1', 'S2'))
select item, source, d, price from (select *, max(d) over (partition by item) m from g) where d = m""", dates=["d"])
def a2_item_latest(spark, sf):
    return A.item_latest(obs(spark, sf), F.col("source").isin("S0", "S1", "S2"))


@query(f"""with {OBS}, l as (select *, max(d) over (partition by item) m from obs),
a as (select item, max(m) as_of, min(price) filter (d = m) "current", count(*) filter (d <> m) past, avg(price) filter (d <> m) mean_, min(price) filter (d <> m) lo_, max(price) filter (d <> m) hi_ from l group by item),
s as (select item, source seller from (select item, source, row_number() over (partition by item order by price, source) k from l where d = m) where k = 1),
b as (select *, coalesce(mean_, "current") mean0, coalesce(lo_, "current") lo, coalesce(hi_, "current") hi from a join s using (item))
select item, as_of, "current", seller, past::bigint past, round(mean0, 2) mean, lo, hi,
 case when greatest(hi, "current") = least(lo, "current") then 0 else round((greatest(hi, "current") - "current") / (greatest(hi, "current") - least(lo, "current")) * 100)::int end score,
 greatest(hi, "current") = least(lo, "current") flat, round("current" - mean0, 2) diff,
 hi <= lo * 3.0 and "current" * 3.0 >= mean0 and "current" <= mean0 * 3.0 ok from b""", dates=["as_of"])
def a3_item_report(spark, sf):
    return A.item_report(obs(spark, sf))


@query(f"""with {OBS}, r as (select *, row_number() over (partition by item order by price, d desc, source) k from obs)
select item, price floor, d floor_date, source from r where k = 1""", dates=["floor_date"])
def a4_min_floor(spark, sf):
    return A.min_floor(obs(spark, sf))


@query(f"""with {OBS}, f as (select item, min(price) floor from obs where source = 'S0' group by 1)
select p_partkey item, coalesce(floor, round(p_retailprice)::bigint) floor, floor is null estimated from part left join f on item = p_partkey""")
def a4_floor_with_fallback(spark, sf):
    floor = A.min_floor(obs(spark, sf).where("source = 'S0'")).select("item", "floor")
    dim = table(spark, sf, "part").select(F.col("p_partkey").alias("item"), F.round("p_retailprice").cast("bigint").alias("ref"))
    return A.with_fallback(floor, dim, "item", "ref")


@query(f"""with {OBS}, {LATEST},
p as (select item, price, source from (select *, row_number() over (partition by item order by price, source) k from latest where source not in ('S1', 'S3')) where k = 1),
o as (select item, price, source from (select *, row_number() over (partition by item order by price, source) k from latest where source in ('S1', 'S3')) where k = 1)
select coalesce(p.item, o.item) item, p.price physical, p.source physical_source, o.price online, o.source online_source, least(p.price, o.price) floor,
 coalesce(o.price < p.price, p.price is null) online_cheaper from p full join o on p.item = o.item""")
def a5_partitioned_floor(spark, sf):
    return A.partitioned_floor(obs(spark, sf), F.col("source").isin("S1", "S3"))


@query("""with l as (select l_partkey item, l_shipdate::date d, round(l_extendedprice)::bigint price, 'V' || (l_suppkey % 9) seller, l_returnflag region from lineitem where l_shipdate::date <= date '1998-06-30'),
r as (select *, row_number() over (partition by item order by price, seller, region) k from l where d = (select max(d) from l) and price >= 15000),
p as (select item, min(price) page from l where l.d < date '1998-06-01' group by 1)
select part.p_partkey item, r.price listing, seller, region, page, case when least(r.price, page) is null then null when page is null or r.price <= page then 'listing' else 'page' end "view", least(r.price, page) best from part left join r on r.item = p_partkey and k = 1 left join p on p.item = p_partkey""")
def a5_cheapest_listing(spark, sf):
    """The newest date's cheapest listing with seller and region, beside another view of the price; the cheaper one counts."""
    l = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("item"), F.col("l_shipdate").cast("date").alias("d"), F.round("l_extendedprice").cast("bigint").alias("price"), F.concat(F.lit("V"), F.col("l_suppkey") % 9).alias("seller"), F.col("l_returnflag").alias("region")).where("d <= date'1998-06-30'")
    best = A.cheapest_listing(l, "item", "d", "price", ["seller", "region"], 15000).withColumnRenamed("price", "listing")
    page = l.where("d < date'1998-06-01'").groupBy("item").agg(F.min("price").alias("page"))
    out = table(spark, sf, "part").select(F.col("p_partkey").alias("item")).join(best, "item", "left").join(page, "item", "left").withColumn("v", A.cheaper_view("listing", "page"))
    return out.select("item", "listing", "seller", "region", "page", F.col("v.view").alias("view"), F.col("v.price").alias("best"))


DIFF = f"""with {PAIR}, j as (
 select coalesce(p.item, c.item) item, p.price old, c.price as new_, p.item is null isnew, c.item is null gone from prev p full join cur c on p.item = c.item),
x as (select item, old, new_, new_ - old delta, round((new_ - old) * 100.0 / nullif(old, 0), 4) pct, isnew, gone from j),
k as (select item, case when isnew then 'new' when gone then 'removed' when (abs(delta) < {{a}} and abs(pct) < {{b}}) or delta = 0 or delta is null then null when delta < 0 then 'drop' else 'rise' end kind, old, new_ as "new", delta, pct from x)
select * from k where kind is not null"""


@query(DIFF.format(a=1000, b=1))
def a6_snapshot_diff(spark, sf):
    return A.snapshot_diff(*pair(spark, sf), "item", "price")


@query(DIFF.format(a=0, b=0) + " and (kind in ('new', 'removed') or abs(pct) > 15)")
def a6_membership_moves(spark, sf):
    return A.membership_moves(*pair(spark, sf), "item", "price")


@query(f"""with {PAIR}, j as (select item, p.price old, p.qty old_second, c.price as "new", c.qty new_second from prev p join cur c using (item)),
k as (select *, case when abs("new" - old) >= 0.01 then 'value' when abs(new_second - old_second) >= 0.01 then 'second' end kind from j)
select * from k where kind is not null""")
def a6_two_measure_diff(spark, sf):
    return A.two_measure_diff(*pair(spark, sf), "item", "price", "qty")


@query("""select case when (select count(p_brand) from part) = 0 then 'p_brand,stock' else 'stock' end missing, false comparable""")
def a7_diff_guard(spark, sf):
    return A.diff_guard(table(spark, sf, "part"), ["p_brand", "p_name", "stock"])


@query("""with x as (select source, case when n_chars < 200 then 'short' when lang is null then 'nolang' else 'ok' end o from documents),
g as (select coalesce(source, 'unknown') source, o from x)
select source, count(*) filter (o = 'ok') ok, count(*) filter (o = 'short') short, count(*) filter (o = 'nolang') nolang, count(*) total from g group by 1
union all select 'total', count(*) filter (o = 'ok'), count(*) filter (o = 'short'), count(*) filter (o = 'nolang'), count(*) from g""")
def a8_gate_stats(spark, sf):
    docs = table(spark, sf, "documents")
    tagged = docs.withColumn("o", F.when(F.col("n_chars") < 200, "short").when(F.col("lang").isNull(), "nolang").otherwise("ok"))
    return A.gate_stats(tagged, "source", "o", ["ok", "short", "nolang"])


NAMES = "names as (select p_type item, p_name name, p_brand market, round(p_retailprice)::bigint price from part)"


@query(f"""with {NAMES} select item, count(distinct name) aliases, count(*) "rows", array_to_string(list_sort(list(distinct market)), '/') markets, min(price) min_price, max(price) max_price,
 array_to_string(list_sort(list(distinct name))[1:4], '; ') names from names group by 1""")
def a9_master_summary(spark, sf):
    p = table(spark, sf, "part").select(F.col("p_type").alias("item"), F.col("p_name").alias("name"), F.col("p_brand").alias("market"), F.round("p_retailprice").cast("bigint").alias("price"))
    return A.master_summary(p, "item", "name", "market", "price")


@query("""with s as (select p_brand, list_sort(list(distinct p_name)) l from part group by 1) select p_brand, len(l) spellings, array_to_string(l[1:10], '; ') names from s where len(l) >= 3""")
def a10_alias_audit(spark, sf):
    return A.alias_audit(table(spark, sf, "part"), "p_brand", "p_name", most=10)


@query("select p_name, count(*) \"rows\" from part where not (contains(p_name, 'ring') or contains(p_name, 'bolt')) group by 1")
def a10_unmatched(spark, sf):
    return A.unmatched_names(_resolved(spark, sf), "p_name", "id")


@query("""with n as (select distinct p_name, contains(p_name, 'ring') or contains(p_name, 'bolt') m from part)
select count(*) "names", count(*) filter (m) matched, round(count(*) filter (m) / count(*), 4) rate, round(count(*) filter (m or contains(p_name, 'gear')) / count(*), 4) projected from n""")
def a10_match_rate(spark, sf):
    """The share of names resolved, and what it would be with those of gears curated."""
    p = _resolved(spark, sf)
    return A.match_rate(p, "p_name", "id", p.where(F.contains("p_name", F.lit("gear"))).select("p_name"))


def _resolved(spark, sf):
    id_ = F.when(F.contains("p_name", F.lit("ring")), "ring").when(F.contains("p_name", F.lit("bolt")), "bolt")
    return table(spark, sf, "part").select("p_name", id_.alias("id"))


@query("""with c as (select p_brand, p_name, count(*) n from part group by 1, 2), r as (select *, row_number() over (partition by p_brand order by n desc, length(p_name) desc, p_name) k from c)
select p_brand, p_name, n from r where k = 1""")
def a11_mode_by(spark, sf):
    return A.mode_by(table(spark, sf, "part"), "p_brand", "p_name")


@query(f"""with {OBS} select item, quantile_cont(price, 0.25) p25, quantile_cont(price, 0.5) median, quantile_cont(price, 0.75) p75 from obs group by 1""")
def a12_quartiles(spark, sf):
    return A.quartiles(obs(spark, sf), "item", "price")


@query(f"""with {OBS}, s as (select item, list_sort(list(price)) l from obs group by 1) select item, l[least(floor(len(l) * 0.9)::bigint, len(l) - 1) + 1] "value", len(l) n from s""")
def a12_index_percentile(spark, sf):
    return A.index_percentile(obs(spark, sf), "item", "price", 0.9)


@query("""select r_name, quantile_cont(u, 0.5) median, min(u) low, max(u) high, count(*) n from (
 select r_name, n_name, quantile_cont(round(l_extendedprice)::bigint, 0.5) u from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey group by 1, 2) group by 1""")
def a12_regional_medians(spark, sf):
    line = table(spark, sf, "lineitem").select("l_suppkey", F.round("l_extendedprice").cast("bigint").alias("price"))
    dim = table(spark, sf, "supplier").join(F.broadcast(table(spark, sf, "nation")), F.col("s_nationkey") == F.col("n_nationkey")).join(F.broadcast(table(spark, sf, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    # A nation may have any number of distinct prices: its median comes from running counts, not from a task that holds them.
    per = ranking.percentiles(line.join(dim, F.col("l_suppkey") == F.col("s_suppkey")), ["r_name", "n_name"], "price", {"u": 0.5})
    return per.groupBy("r_name").agg(F.percentile("u", 0.5).alias("median"), F.min("u").alias("low"), F.max("u").alias("high"), F.count("*").alias("n"))


@query(f"""with {OBS}, m as (select item % 500 place, price / 10.0 p from obs),
a as (select place, count(p) n, quantile_cont(p, 0.25) a, quantile_cont(p, 0.5) b, quantile_cont(p, 0.75) c, min(p) x, avg(p) y, max(p) z from m group by 1)
select place, n, round(case when n >= 4 then a else x end, 4) low, round(case when n >= 4 then b else y end, 4) std, round(case when n >= 4 then c else z end * 1.1, 4) high, case when n >= 4 then 'high' else 'low' end confidence from a""")
def a13_per_person_cost(spark, sf):
    menu = obs(spark, sf).select((F.col("item") % 500).alias("place"), (F.col("price") / 10.0).alias("p"))
    return A.estimate_per_person(menu, "place", "p", {"high": 1.1})


@query(f"""with {OBS}, m as (select item % 500 place, price / 10.0 p, source = 'S1' or item % 5 = 0 main, case when item % 40 = 7 then 2 + item % 3 when item % 40 = 9 then 1 end party from obs),
s as (select *, case when main or not max(main) over (partition by place) then p end q from m),
h as (select place, count(q) n, min(q / party) lo, avg(q / party) mid, max(q / party) hi from s where party > 1 and q is not null group by 1),
a as (select place, count(q) n, quantile_cont(q, 0.25) a, quantile_cont(q, 0.5) b, quantile_cont(q, 0.75) c, min(q) x, avg(q) y, max(q) z from s where place not in (select place from h) group by 1)
select place, n, round(case when n >= 3 then a else x end * 1.5, 4) low, round(case when n >= 3 then b else y end * 1.5, 4) std, round(case when n >= 3 then c else z end * 1.5, 4) high, case when n >= 3 then 'high' when n > 0 then 'low' else 'none' end confidence from a
union all select place, n, round(lo, 4), round(mid, 4), round(hi, 4), case when n >= 3 then 'party' else 'few parties' end from h""")
def a13_main_dishes_and_parties(spark, sf):
    """Main dishes alone where there are any; dishes for several people alone, divided, where there are any; the rest by quartiles and appetite."""
    item = F.col("item")
    party = F.when(item % 40 == 7, 2 + item % 3).when(item % 40 == 9, 1)
    menu = obs(spark, sf).select((item % 500).alias("place"), (F.col("price") / 10.0).alias("p"), ((F.col("source") == "S1") | (item % 5 == 0)).alias("main"), party.alias("party"))
    return A.estimate_per_person(menu, "place", "p", {"low": 1.5, "std": 1.5, "high": 1.5}, 3, main=F.col("main"), party="party")


@query("""with s as (select user_id, sum(case event_type when 'click' then 3.0 when 'view' then 1.0 when 'purchase' then 10.0 else 0 end) score from events group by 1)
select user_id, score, round(score * 100 / coalesce(nullif((select max(score) from s), 0), 1), 2) score_norm, rank() over (order by score desc) "rank" from s""")
def a14_weighted_score(spark, sf):
    n = table(spark, sf, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    return A.weighted_score(n, "user_id", "event_type", "n", {"click": 3.0, "view": 1.0, "purchase": 10.0})


@query("""with d as (select event_type k, ts::date d, round(sum(value))::bigint v from events group by 1, 2),
l as (select k, d, v, lag(d) over (partition by k order by d) pd, v - lag(v) over (partition by k order by d) delta from d),
o as (select date_trunc('week', d)::date "week", k, d, v, delta from l where date_diff('day', pd, d) = 1)
select "week", k, sum(delta)::bigint delta, count(*) steps, max_by(v, d) "last" from o group by 1, 2""", dates=["week"])
def a15_weekly_rollup(spark, sf):
    d = table(spark, sf, "events").groupBy(F.col("event_type").alias("k"), F.col("ts").cast("date").alias("d")).agg(F.round(F.sum("value")).cast("bigint").alias("v"))
    w = Window.partitionBy("k").orderBy("d")
    steps = d.withColumn("pd", F.lag("d").over(w)).withColumn("delta", F.col("v") - F.lag("v").over(w))
    return A.weekly_rollup(steps, "k", "d", "pd", "delta", "v")


@query("""with d as (select event_type k, ts::date d, round(sum(value))::bigint v, round(sum(value) filter (user_id % 2 = 0) * 2.1)::bigint fl from events group by 1, 2),
l as (select *, lag(d) over (partition by k order by d) pd, v - lag(v) over (partition by k order by d) delta from d),
o as (select date_trunc('week', d)::date "week", k, sum(delta)::bigint delta, count(*) steps, max_by(v, d) "last", bool_or(coalesce(v < fl, false)) breakthrough from l where date_diff('day', pd, d) = 1 group by 1, 2)
select *, case when delta <= -100 then 'deepen' when delta >= 100 then 'raise' end list from o""", dates=["week"])
def a15_weekly_lists(spark, sf):
    v = F.round(F.sum("value")).cast("bigint")
    d = table(spark, sf, "events").groupBy(F.col("event_type").alias("k"), F.col("ts").cast("date").alias("d")).agg(v.alias("v"), F.round(F.sum(F.when(F.col("user_id") % 2 == 0, F.col("value"))) * 2.1).cast("bigint").alias("fl"))
    w = Window.partitionBy("k").orderBy("d")
    steps = d.withColumn("pd", F.lag("d").over(w)).withColumn("delta", F.col("v") - F.lag("v").over(w))
    return A.weekly_rollup(steps, "k", "d", "pd", "delta", "v", "fl", 100)


@query("""with x as (select count(*) a, count(*) filter (lang is not null) b, count(*) filter (lang is not null and n_chars >= 500) c, count(*) filter (lang is not null and n_chars >= 500 and lang = 'en') e from documents)
select 0 step, 'collected' stage, a n from x union all select 1, 'known', b from x union all select 2, 'long', c from x union all select 3, 'english', e from x""")
def a16_funnel(spark, sf):
    docs = table(spark, sf, "documents")
    return A.funnel(docs, [("collected", F.lit(True)), ("known", F.col("lang").isNotNull()), ("long", F.col("n_chars") >= 500), ("english", F.col("lang") == "en")])


@query(f"""with {OBS}, m as (select strftime(d, '%Y-%m') "month", item, min(struct_pack(p := price, s := source)) b from obs group by 1, 2),
w as (select "month", b.s shop, count(*) wins from m group by 1, 2), r as (select *, row_number() over (partition by "month" order by wins desc, shop) k from w)
select "month", shop champion, wins, coalesce(lag(shop) over (order by "month") <> shop, false) changed from r where k = 1""")
def a17_scoreboard(spark, sf):
    wins = obs(spark, sf).groupBy(F.date_format("d", "yyyy-MM").alias("month"), "item").agg(F.min(F.struct("price", "source")).alias("b")).select("month", F.col("b.source").alias("shop"))
    return A.scoreboard(wins, "month", "shop")


@query("""with b as (select unnest(['en', 'de', 'fr', 'es', 'it', 'ja']) bucket), n as (select bucket, count(doc_id) n from b left join documents on lang = bucket group by 1)
select bucket, n, round(n * 100.0 / coalesce(nullif((select sum(n) from n), 0), 1), 2) pct from n""")
def a18_distribution(spark, sf):
    buckets = spark.createDataFrame([(x,) for x in ("en", "de", "fr", "es", "it", "ja")], "bucket string")
    return A.distribution(table(spark, sf, "documents"), "lang", buckets)


LEDGER = """moves as (select o_custkey account, o_orderdate as "at", 'order' "label", -round(o_totalprice)::bigint amount from orders
 union all select o_custkey, l_shipdate, 'ship', round(l_extendedprice * (1 - l_discount))::bigint from lineitem join orders on l_orderkey = o_orderkey)"""


def _moves(spark, sf):
    orders = table(spark, sf, "orders")
    ships = table(spark, sf, "lineitem").join(orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    return orders.withColumnRenamed("o_custkey", "account"), ships.withColumnRenamed("o_custkey", "account")


@query(f"with {LEDGER} select account, sum(amount)::bigint balance, count(*) movements from moves group by 1")
def a19_balances(spark, sf):
    orders, ships = _moves(spark, sf)
    return A.balances("account", (orders, -F.round("o_totalprice").cast("bigint")), (ships, F.round(F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("bigint")))


@query(f"""with {LEDGER} select account, "label" member, sum(amount)::bigint total, coalesce(sum(amount) filter ("at"::date >= date '1998-06-15'), 0)::bigint "week", coalesce(sum(amount) filter ("at"::date >= date '1998-06-01'), 0)::bigint "month" from moves where "at"::date <= date '1998-06-17' group by 1, 2""")
def a19_ledger_windows(spark, sf):
    """Subtotals of each account's two sides: ever, since Monday, and since the first of the month."""
    orders, ships = _moves(spark, sf)
    rows = orders.select("account", F.lit("order").alias("member"), F.col("o_orderdate").alias("at"), (-F.round("o_totalprice").cast("bigint")).alias("amount"))
    rows = rows.unionByName(ships.select("account", F.lit("ship").alias("member"), F.col("l_shipdate").alias("at"), F.round(F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("bigint").alias("amount")))
    return A.ledger_windows(rows, "account", "member", "at", "amount", "1998-06-17")


@query(f"with {OBS}, l as (select item, max(d) latest from obs group by 1) select item, latest, latest = (select max(latest) from l) is_new from l", dates=["latest"])
def a20_item_freshness(spark, sf):
    return A.item_freshness(obs(spark, sf), "item", "d")


@query(f"""with {OBS}, n as (select d, count(*) n from obs group by 1), g as (select coalesce(max(d) filter (n >= 5), max(d)) global_latest from n)
select source, max(d) latest, count(distinct item) items, any_value(global_latest) global_latest, max(d) >= any_value(global_latest) is_new from obs, g group by 1""", dates=["latest", "global_latest"])
def a20_freshness_summary(spark, sf):
    return A.freshness_summary(obs(spark, sf), "source", "item", "d", 5)


@query("""with h as (select sha256(concat_ws(chr(31), p_partkey::varchar, coalesce(p_name, chr(0)), p_brand, p_size::varchar)) h from part), w as (select h, unnest(range(8)) i from h), s as (select i, sum(('0x' || substr(h, i * 8 + 1, 8))::ubigint)::hugeint t from w group by 1)
select (select count(*) from part) "rows", sha256((select count(*) from part) || ',' || string_agg(t::varchar, ',' order by i)) sha256 from s""")
def a21_fingerprint(spark, sf):
    p = table(spark, sf, "part")
    return A.fingerprint(p.orderBy(F.col("p_partkey").desc()), ["p_partkey", "p_name", "p_brand", "p_size"])


@query(f"""with {PAIR}, j as (select coalesce(p.item, c.item) item, p.price::varchar op, c.price::varchar np, p.qty::varchar oq, c.qty::varchar nq from prev p full join cur c on p.item = c.item)
select item, 'price' field, op old, np "new" from j where op is distinct from np union all select item, 'qty', oq, nq from j where oq is distinct from nq""")
def a21_field_diff(spark, sf):
    return A.field_diff(*pair(spark, sf), "item", ["price", "qty"])


@query(f"""with {PAIR}, x as (select item, price, case when item % 50 = 0 then qty + 1 else qty end qty from cur where item % 70 > 0 union all select -1, 5, 6), j as (select coalesce(p.item, c.item) item, p.price::varchar op, c.price::varchar np, p.qty::varchar oq, c.qty::varchar nq from cur p full join x c on p.item = c.item)
select item, 'price' field, op old, np "new" from j where op is distinct from np union all select item, 'qty', oq, nq from j where oq is distinct from nq""")
def a21_local_diff(spark, sf):
    """A month's rows against themselves with some changed, some lost and one more: only ranges of keys whose fingerprints differ are joined."""
    _, cur = pair(spark, sf)
    later = cur.where(F.col("item") % 70 > 0).select("item", "price", F.when(F.col("item") % 50 == 0, F.col("qty") + 1).otherwise(F.col("qty")).alias("qty"))
    later = later.unionByName(cur.agg(F.lit(-1).alias("item"), F.lit(5).alias("price"), F.lit(6).alias("qty")))
    return A.local_diff(cur, later, "item", ["price", "qty"])


@query("""with p as (select count(*) filter (not coalesce(regexp_matches(p_brand, '^Brand#[0-9]$'), false)) n from part)
select 'pattern' "rule", 'p_brand' "column", n from p where n > 0 union all select 'missing', 'stock', 1""")
def a22_check_contract(spark, sf):
    return A.check_contract(table(spark, sf, "part"), ["p_name", "stock"], {"p_brand": "^Brand#[0-9]$", "p_name": "^[a-z ]+$"})


YEARS = "y as (select n_name, year(o_orderdate) y, sum(round(o_totalprice)::bigint)::bigint v from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey group by 1, 2)"


def _years(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", F.year("o_orderdate").alias("y"), F.round("o_totalprice").cast("bigint").alias("v"))
    cust = table(spark, sf, "customer").join(F.broadcast(table(spark, sf, "nation")), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name")
    return orders.join(cust, F.col("o_custkey") == F.col("c_custkey")).groupBy("n_name", "y").agg(F.sum("v").alias("v"))


@query(f"""with {YEARS}, l as (select *, lag(y) over w ly, lag(v) over w lv from y window w as (partition by n_name order by y))
select n_name, y, v, case when ly = y - 1 then round((v - lv) * 100.0 / nullif(lv, 0), 2) end yoy_pct from l""")
def a23_year_over_year(spark, sf):
    return A.year_over_year(_years(spark, sf), "y", "v", ["n_name"])


@query(f"with {YEARS} select n_name, y, v, round(v * 100.0 / nullif(sum(v) over (partition by y), 0), 2) share_pct from y")
def a23_share_of_total(spark, sf):
    return A.share_of_total(_years(spark, sf), "v", ["y"])


@query(f"""with {YEARS}, p as (select n_name, y py, v pv from (select *, row_number() over (partition by n_name order by v desc, y) k from y) where k = 1),
l as (select n_name, y ly, v lv from (select *, row_number() over (partition by n_name order by y desc) k from y) where k = 1)
select n_name, py peak_year, pv peak, ly last_year, round((lv - pv) * 100.0 / nullif(pv, 0), 2) from_peak_pct from p join l using (n_name)""")
def a23_from_peak(spark, sf):
    return A.from_peak(_years(spark, sf), "n_name", "y", "v")



@query("""with y as (select n_name, year(o_orderdate) y, sum(round(o_totalprice)::bigint)::bigint v, count(*) q from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey group by 1, 2)
select n_name, y, v, q, round(v / nullif(q, 0), 4) unit_value from y""")
def a23_unit_value(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", F.year("o_orderdate").alias("y"), F.round("o_totalprice").cast("bigint").alias("v"))
    cust = table(spark, sf, "customer").join(F.broadcast(table(spark, sf, "nation")), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name")
    years = orders.join(cust, F.col("o_custkey") == F.col("c_custkey")).groupBy("n_name", "y").agg(F.sum("v").alias("v"), F.count("*").alias("q"))
    return A.unit_value(years, "v", "q")


@query(f"""with {FX_SQL}, y as (select n_name, case n_regionkey % 3 when 0 then 'A' when 1 then 'F' else 'N' end c, make_date(year(o_orderdate)::int, 12, 31) d, sum(round(o_totalprice)::bigint)::bigint v from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey group by all),
j as (select y.*, cr.r from y asof left join cr on y.c = cr.c and y.d >= cr.d) select n_name, c currency, d, v, round(case when c = 'F' then v else v * r end, 2) converted from j""", dates=["d"])
def a23_in_one_currency(spark, sf):
    """Yearly series of nations with currencies of their own, in one currency by each year's last rate."""
    y = F.make_date(F.year("o_orderdate"), F.lit(12), F.lit(31))
    orders = table(spark, sf, "orders").select("o_custkey", y.alias("d"), F.round("o_totalprice").cast("bigint").alias("v"))
    code = F.when(F.col("n_regionkey") % 3 == 0, "A").when(F.col("n_regionkey") % 3 == 1, "F").otherwise("N")
    cust = table(spark, sf, "customer").join(F.broadcast(table(spark, sf, "nation")), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name", code.alias("currency"))
    years = orders.join(cust, F.col("o_custkey") == F.col("c_custkey")).groupBy("n_name", "currency", "d").agg(F.sum("v").alias("v"))
    out = J.convert_asof(years, J.cross_rates(_fx(spark, sf), "F"), "v", "currency", "d", "F", 400)
    return out.select("n_name", "currency", "d", "v", F.round("converted", 2).alias("converted"))
