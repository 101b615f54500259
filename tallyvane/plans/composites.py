"""End-user queries put together from the operators."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyvane.functions import classify as C
from tallyvane.functions import values as V
from tallyvane.operators import aggregates as A
from tallyvane.operators import gates as G
from tallyvane.operators import joins as J
from tallyvane.operators import ordering as O
from tallyvane.operators import ranking
from tallyvane.operators import series as W
from tallyvane.plans.aggregates import LATEST
from tallyvane.plans.base import OBS, PAIR, obs, pair, query, table
from tallyvane.plans.joins import HAV, PLACES, RULE_SQL, _places, _rules
from tallyvane.sources import writers as X


def parts(spark, sf):
    return table(spark, sf, "part")


@query(f"""with {OBS}, {RULE_SQL}, res as (select nm.t, (select id from rules r where r.rule_no = b.rule_no) id from nm left join best b using (t)),
x as (select o.*, p_name, id from obs o join part on p_partkey = item join res on t = p_name), g as (select *, case when price < 3000 then 'low price' when id is null then 'unmatched' end reason from x),
m as (select id, avg(price) a from g where reason is null and d < date '1998-01-01' group by 1),
f as (select g.*, coalesce(price < a * (1.0::double / 3.0::double) or price > a * 3.0, false) outlier from g left join m on m.id = g.id)
select coalesce(id, 'none') id, case when reason is not null then reason when outlier then 'outlier' else 'ok' end status, count(*) n, min(price) low, max(price) high from f group by 1, 2""")
def q1_normalise(spark, sf):
    """Names resolved once each, rows gated with reasons, outliers against past means flagged; counts by item and status."""
    rows = obs(spark, sf).join(parts(spark, sf).select(F.col("p_partkey").alias("item"), "p_name"), "item")
    ids = J.resolve_rules(parts(spark, sf), "p_name", _rules(spark)).select(F.col("text").alias("p_name"), "id")
    gated = G.apply_gates(rows.join(ids, "p_name"), [(F.col("price") < 3000, "low price"), (F.col("id").isNull(), "unmatched")])
    flagged = G.flag_outliers(gated, "id", "price", (F.col("status") == "ok") & (F.col("d") < F.lit("1998-01-01").cast("date")))
    status = F.coalesce("reason", F.when(F.col("outlier"), "outlier").otherwise("ok"))
    return flagged.groupBy(F.coalesce("id", F.lit("none")).alias("id"), status.alias("status")).agg(F.count("*").alias("n"), F.min("price").alias("low"), F.max("price").alias("high"))


@query(f"""with {OBS}, l as (select *, max(d) over (partition by item) m from obs where price >= 15000), a as (select item, min(price) filter (d = m) cur, max(price) filter (d <> m) hi, min(price) filter (d <> m) lo, any_value(m) as_of from l group by 1)
select p_name, p_partkey item, as_of, cur "current", case when greatest(coalesce(hi, cur), cur) = least(coalesce(lo, cur), cur) then 0 else round((greatest(coalesce(hi, cur), cur) - cur) / (greatest(coalesce(hi, cur), cur) - least(coalesce(lo, cur), cur)) * 100)::int end score from a join part on p_partkey = item""", dates=["as_of"])
def q2_item_report(spark, sf):
    report = A.item_report(obs(spark, sf).where(G.is_sane("price")))
    return report.join(parts(spark, sf).select(F.col("p_partkey").alias("item"), "p_name"), "item").select("p_name", "item", "as_of", "current", "score")


@query(f"""with {OBS}, {LATEST}, a as (select item, min(price) pa from latest where source in ('S0', 'S2') group by 1), b as (select item, min(price) pb from latest where source in ('S1', 'S3') group by 1), j as (select *, case when pa < pb then 'a' when pb < pa then 'b' else 'tie' end verdict from a join b using (item))
select verdict, count(*) n, sum(abs(pa - pb))::bigint gap from j group by 1""")
def q3_two_country(spark, sf):
    last = A.latest_per_source(obs(spark, sf), "item", "source", "d", "price")
    side = lambda s, n: last.where(F.col("source").isin(*s)).groupBy("item").agg(F.min("price").alias(n))
    both = side(("S0", "S2"), "pa").join(side(("S1", "S3"), "pb"), "item")
    verdict = F.when(F.col("pa") < F.col("pb"), "a").when(F.col("pb") < F.col("pa"), "b").otherwise("tie")
    return both.groupBy(verdict.alias("verdict")).agg(F.count("*").alias("n"), F.sum(F.abs(F.col("pa") - F.col("pb"))).alias("gap"))


@query(f"""with {PAIR}, j as (select coalesce(p.item, c.item) item, p.price o, c.price n from prev p full join cur c on p.item = c.item), k as (select item, case when o is null then 'new' when n is null then 'removed' when (abs(n - o) < 1000 and abs(round((n - o) * 100.0 / o, 4)) < 1) or n = o then null when n < o then 'drop' else 'rise' end kind from j)
select kind, p_brand, count(*) n from k join part on p_partkey = item where kind is not null group by 1, 2""")
def q4_change_report(spark, sf):
    diff = A.snapshot_diff(*pair(spark, sf), "item", "price")
    return diff.join(parts(spark, sf).select(F.col("p_partkey").alias("item"), "p_brand"), "item").groupBy("kind", "p_brand").agg(F.count("*").alias("n"))


@query(f"""with {OBS}, {LATEST}, a as (select item, min(price) pa from latest where source = 'S0' group by 1), b as (select item, min(price) pb from latest where source <> 'S0' group by 1)
select item, pa, pb, round((pb - pa) * 100.0 / nullif(pb, 0), 2) gap_pct, case when (pb - pa) * 100.0 >= pb * 30 then 'strong' else 'mild' end tier from a join b using (item) where pa < pb and pb < pa * 2.5""")
def q5_cheaper_list(spark, sf):
    last = A.latest_per_source(obs(spark, sf), "item", "source", "d", "price")
    a = last.where("source = 'S0'").groupBy("item").agg(F.min("price").alias("pa"))
    b = last.where("source <> 'S0'").groupBy("item").agg(F.min("price").alias("pb"))
    both = a.join(b, "item").where((F.col("pa") < F.col("pb")) & G.divergence_ok("pa", "pb"))
    out = W.gap_table(both.withColumn("one", F.lit(1)), "pa", "pb", "one")
    return out.select("item", "pa", "pb", "gap_pct", F.when((F.col("pb") - F.col("pa")) * 100.0 >= F.col("pb") * 30, "strong").otherwise("mild").alias("tier"))


@query(f"""with {OBS}, {LATEST}, f as (select item, min(price) floor from latest group by 1) select p_partkey, p_name, floor, round(p_retailprice)::bigint * 30 ref, round((round(p_retailprice)::bigint * 30 - floor) * 100.0 / (round(p_retailprice)::bigint * 30), 2) saving_pct from part left join f on item = p_partkey""")
def q12_product_search(spark, sf):
    floor = A.source_latest_floor(obs(spark, sf)).select("item", "floor")
    p = parts(spark, sf).join(floor, F.col("item") == F.col("p_partkey"), "left").withColumn("ref", F.round("p_retailprice").cast("bigint") * 30)
    return p.select("p_partkey", "p_name", "floor", "ref", F.round((F.col("ref") - F.col("floor")) * 100.0 / F.col("ref"), 2).alias("saving_pct"))


@query(f"""with {OBS}, {LATEST}, f as (select item, min(price) filter (source = 'S0') a, min(price) filter (source = 'S1') b, min(price) filter (source = 'S2') c from latest group by 1),
x as (select item, a, b, c, least(a, b, c) low, greatest(a, b, c) high, (a is not null)::int + (b is not null)::int + (c is not null)::int n from f)
select item, a, b, c, n, low, high - low spread, concat_ws('/', case when a = low then 'a' end, case when b = low then 'b' end, case when c = low then 'c' end) cheapest from x where n >= 1""")
def q7_three_way(spark, sf):
    last = A.latest_per_source(obs(spark, sf), "item", "source", "d", "price")
    pick = lambda s: F.min(F.when(F.col("source") == s, F.col("price")))
    f = last.groupBy("item").agg(pick("S0").alias("a"), pick("S1").alias("b"), pick("S2").alias("c"))
    low, high = F.least("a", "b", "c"), F.greatest("a", "b", "c")
    n = sum((F.col(k).isNotNull().cast("int") for k in "abc"), F.lit(0))
    win = F.concat_ws("/", *(F.when(F.col(k) == low, k) for k in "abc"))
    return f.select("item", "a", "b", "c", n.alias("n"), low.alias("low"), (high - low).alias("spread"), win.alias("cheapest")).where("n >= 1")


@query(f"""with {OBS}, {LATEST}, f as (select item, min(price) floor from latest group by 1), x as (select p_name, p_partkey, round(p_retailprice)::bigint * 30 - floor saving, case when floor < 5000 then 'a' when floor <= 20000 then 'b' else 'c' end band from f join part on p_partkey = item),
o as (select * from (select *, row_number() over (partition by p_name, band order by saving desc, p_partkey) j from x) where j = 1), r as (select band, p_partkey, p_name, saving, row_number() over (partition by band order by saving desc, p_partkey) place from o) select * from r where place <= 10""")
def q8_banded_top(spark, sf):
    floor = A.source_latest_floor(obs(spark, sf)).select("item", "floor")
    x = parts(spark, sf).join(floor, F.col("item") == F.col("p_partkey")).select("p_name", "p_partkey", (F.round("p_retailprice").cast("bigint") * 30 - F.col("floor")).alias("saving"), V.band("floor", [5000, 20000], ["a", "b", "c"], "mixed").alias("band"))
    one = W.best_per_key(x, ["p_name", "band"], [F.col("saving").desc(), F.col("p_partkey")])
    return W.banded_top_n(one, "band", "saving", 10, ["p_partkey"]).select("band", "p_partkey", "p_name", "saving", "place")


@query(f"""with {OBS}, {LATEST}, a as (select item, min(price) filter (source = 'S0') pa, min(price) filter (source = 'S1') pb from latest group by 1), b as (select p_brand, count(*) n, avg(case when pa < pb then 1.0 else 0 end) r from a join part on p_partkey = item where pa is not null and pb is not null group by 1)
select p_brand, n, round(r, 4) win_rate from b where n >= 10""")
def q11_brand_value(spark, sf):
    last = A.latest_per_source(obs(spark, sf), "item", "source", "d", "price")
    f = last.groupBy("item").agg(F.min(F.when(F.col("source") == "S0", F.col("price"))).alias("pa"), F.min(F.when(F.col("source") == "S1", F.col("price"))).alias("pb")).where("pa is not null and pb is not null")
    x = f.join(parts(spark, sf).select(F.col("p_partkey").alias("item"), "p_brand"), "item")
    return x.groupBy("p_brand").agg(F.count("*").alias("n"), F.round(F.avg(F.when(F.col("pa") < F.col("pb"), 1.0).otherwise(0.0)), 4).alias("win_rate")).where("n >= 10")


@query(f"""with {PLACES}, c as (select n_name centre, 37.4 + n_nationkey / 125.0 clat, 126.9 + (n_nationkey % 7) / 50.0 clng from nation),
x as (select pl.k, loc, centre, {HAV.format(a='lat', b='lng', c='clat', d='clng')} m from pl, c where abs(lat - clat) < 0.02), y as (select centre, k, loc, m, row_number() over (partition by centre order by round(m, 3), k) place from x where m <= 1500)
select centre, k, loc, round(m, 3) metres, place from y where place <= 20""")
def q22_places_near_stations(spark, sf):
    n = table(spark, sf, "nation")
    centres = n.select(F.col("n_name").alias("centre"), (37.4 + F.col("n_nationkey") / 125.0).alias("lat"), (126.9 + (F.col("n_nationkey") % 7) / 50.0).alias("lng"))
    near = J.within_radius(_places(spark, sf), centres, 1500.0).withColumn("metres", F.round("metres", 3))
    top = O.top_k(near, [F.col("metres"), F.col("k")], 20, ["centre"])
    return W.banded_top_n(top.withColumn("back", -F.col("metres")), "centre", "back", 20, ["k"]).select("centre", "k", "loc", "metres", "place")


@query("""with m as (select o_custkey account, -round(o_totalprice)::bigint a from orders union all select o_custkey, round(l_extendedprice * (1 - l_discount))::bigint from lineitem join orders on l_orderkey = o_orderkey),
b as (select account, sum(a)::bigint balance, count(*) movements from m group by 1) select * from (select account, balance, movements, row_number() over (order by balance desc, account) "rank" from b) where "rank" <= 100""")
def q24_ledger_leaderboard(spark, sf):
    orders = table(spark, sf, "orders").withColumnRenamed("o_custkey", "account")
    ships = table(spark, sf, "lineitem").join(orders.select("o_orderkey", "account"), F.col("l_orderkey") == F.col("o_orderkey"))
    b = A.balances("account", (orders, -F.round("o_totalprice").cast("bigint")), (ships, F.round(F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("bigint")))
    return O.with_rank(b, [F.col("balance").desc(), F.col("account")], 100)


@query(f"""with {OBS}, {LATEST}, a as (select item, min(price) pa from latest where source = 'S0' group by 1), b as (select item, min(price) pb from latest where source <> 'S0' group by 1),
u as (select item, pa * 100.0 / p_size ua, pb * 100.0 / p_size ub from a join b using (item) join part on p_partkey = item)
select item, round(ua, 4) unit_a, round(ub, 4) unit_b, round((ub - ua) * 100.0 / ub, 2) advantage_pct, case when ua <= ub * 0.7 then 'buy' when ua <= ub then 'consider' else 'skip' end verdict from u""")
def q6_attractiveness_per_item(spark, sf):
    last = A.latest_per_source(obs(spark, sf), "item", "source", "d", "price")
    a = last.where("source = 'S0'").groupBy("item").agg(F.min("price").alias("pa"))
    b = last.where("source <> 'S0'").groupBy("item").agg(F.min("price").alias("pb"))
    u = a.join(b, "item").join(parts(spark, sf).select(F.col("p_partkey").alias("item"), "p_size"), "item")
    u = u.withColumn("ua", V.unit_price("pa", "p_size")).withColumn("ub", V.unit_price("pb", "p_size"))
    verdict = F.when(F.col("ua") <= F.col("ub") * 0.7, "buy").when(F.col("ua") <= F.col("ub"), "consider").otherwise("skip")
    return u.select("item", F.round("ua", 4).alias("unit_a"), F.round("ub", 4).alias("unit_b"), F.round((F.col("ub") - F.col("ua")) * 100.0 / F.col("ub"), 2).alias("advantage_pct"), verdict.alias("verdict"))


@query(f"""with {PAIR}, j as (select coalesce(p.item, c.item) item, p.price o, c.price n from prev p full join cur c on p.item = c.item),
k as (select item, o, n, case when o is null then 'new' when n is null then 'removed' when (abs(n - o) < 1000 and abs(round((n - o) * 100.0 / o, 4)) < 1) or n = o then null when n < o then 'drop' else 'rise' end kind from j),
t1 as (select item from (select item, row_number() over (order by price, item) r from prev) where r <= 10), t2 as (select item from (select item, row_number() over (order by price, item) r from cur) where r <= 10)
select kind headline, count(*) n, min(n - o) least from k where kind is not null group by 1 union all select 'entered top', count(*), null from t2 where item not in (select item from t1)""")
def q9_daily_highlights(spark, sf):
    a, b = pair(spark, sf)
    diff = A.snapshot_diff(a, b, "item", "price").groupBy(F.col("kind").alias("headline")).agg(F.count("*").alias("n"), F.min("delta").alias("least"))
    days = a.select(F.lit(1).alias("day"), "item", (-F.col("price")).alias("v")).unionByName(b.select(F.lit(2).alias("day"), "item", (-F.col("price")).alias("v")))
    entered = W.topn_entry_exit(days, "day", "item", "v", 10).where("event = 'entry'").agg(F.lit("entered top").alias("headline"), F.count("*").alias("n"), F.lit(None).cast("long").alias("least"))
    return diff.unionByName(entered)


@query(f"""with {OBS}, {LATEST}, p as (select item, min(price) physical from latest where source not in ('S1', 'S3') group by 1), o as (select item, min(price) online from latest where source in ('S1', 'S3') group by 1),
x as (select p_partkey, p_brand, physical, online from part left join p on p.item = p_partkey left join o on o.item = p_partkey)
select p_brand, count(*) "rows", count(physical) physical, count(online) online, count(*) filter (physical is null and online is null) catalogue_only, min(least(physical, online)) low from x group by 1""")
def q10_dashboard_counts(spark, sf):
    """The dashboard's row universe: floors of both channels over all catalogue items, as one nested row each, counted by brand."""
    floors = A.partitioned_floor(obs(spark, sf), F.col("source").isin("S1", "S3"))
    rows = parts(spark, sf).join(floors, F.col("item") == F.col("p_partkey"), "left").select("p_brand", "p_partkey", F.struct("physical", "physical_source").alias("retail"), F.struct("online", "online_source").alias("web"), "floor")
    none = F.col("retail.physical").isNull() & F.col("web.online").isNull()
    return rows.groupBy("p_brand").agg(F.count("*").alias("rows"), F.count("retail.physical").alias("physical"), F.count("web.online").alias("online"), F.count_if(none).alias("catalogue_only"), F.min("floor").alias("low"))


@query(f"""with {OBS}, {LATEST}, f as (select item, min(price) floor from latest group by 1), x as (select case when floor <= 5000 then 'low' when floor <= 20000 then 'mid' else 'high' end band, case when contains(p_name, 'red') then 'red' when contains(p_name, 'ring') then 'ring' else 'rest' end style, floor from f join part on p_partkey = item)
select band, style, count(*) n, quantile_cont(floor, 0.5) median, max(floor) high from x group by 1, 2""")
def q13_banded_styles(spark, sf):
    floor = A.source_latest_floor(obs(spark, sf)).select("item", "floor")
    x = floor.join(parts(spark, sf).select(F.col("p_partkey").alias("item"), "p_name"), "item")
    x = x.select(V.band("floor", [5000, 20000], ["low", "mid", "high"], "right").alias("band"), C.classify_first("p_name", [("red", ["red"]), ("ring", ["ring"])], "rest").alias("style"), "floor")
    median = ranking.percentiles(x, ["band", "style"], "floor", {"median": 0.5})  # nine groups hold all floors
    return x.groupBy("band", "style").agg(F.count("*").alias("n"), F.max("floor").alias("high")).join(median, ["band", "style"])


@query("""with d as (select event_type k, ts::date d, round(sum(value))::bigint v from events group by 1, 2), l as (select *, lag(d) over w pd, v - lag(v) over w delta from d window w as (partition by k order by d)),
w as (select date_trunc('week', d)::date wk, k, sum(delta)::bigint delta, max_by(v, d) last_ from l where d - pd = 1 group by 1, 2) select wk, k, delta, last_, row_number() over (partition by wk order by abs(delta) desc, k) place from w""", dates=["wk"])
def q14_weekly_digest(spark, sf):
    d = table(spark, sf, "events").groupBy(F.col("event_type").alias("k"), F.col("ts").cast("date").alias("d")).agg(F.round(F.sum("value")).cast("bigint").alias("v"))
    w = Window.partitionBy("k").orderBy("d")
    steps = d.withColumn("pd", F.lag("d").over(w)).withColumn("delta", F.col("v") - F.lag("v").over(w))
    week = A.weekly_rollup(steps, "k", "d", "pd", "delta", "v").select(F.col("week").alias("wk"), "k", "delta", F.col("last").alias("last_"), F.abs("delta").alias("size"))
    return W.banded_top_n(week, "wk", "size", 1000, ["k"]).select("wk", "k", "delta", "last_", "place")


@query(f"""with {PAIR}, n as (select p_name, count(*) seen, min(cur.price) low from cur join part on p_partkey = cur.item where p_partkey not in (select item from prev) group by 1), m as (select max(p_partkey) top from part)
select p_name, seen, low, case when seen >= 3 then 'promote' else 'review' end status, top + row_number() over (order by p_name) id from n, m""")
def q17_new_candidates(spark, sf):
    """Names seen only in the newest snapshot, with a status and ids after the last one there is."""
    a, b = pair(spark, sf)
    fresh = J.anti(b, a, "item").join(parts(spark, sf).select(F.col("p_partkey").alias("item"), "p_name"), "item")
    n = fresh.groupBy("p_name").agg(F.count("*").alias("seen"), F.min("price").alias("low"))
    top = parts(spark, sf).agg(F.max("p_partkey").alias("top"))
    status = F.when(F.col("seen") >= 3, "promote").otherwise("review")
    return ranking.numbered(n, "p_name", "no").crossJoin(F.broadcast(top)).select("p_name", "seen", "low", status.alias("status"), (F.col("top") + F.col("no")).alias("id"))


@query(f"""with {OBS}, {RULE_SQL}, x as (select item, source, d, price, p_name, (select r.id from best b join rules r on r.rule_no = b.rule_no where b.t = p_name) id from obs join part on p_partkey = item where d >= date '1998-01-01'),
g as (select *, case when id is null then 'unmatched' when price < 3000 then 'low price' end reason from x), old as (select distinct item, source from obs where d < date '1998-01-01')
select case when reason is not null then reason when (item, source) in (select item, source from old) then 'known' else 'accepted' end outcome, count(distinct item || '/' || source) n from g group by 1""")
def q18_ingest(spark, sf):
    """A batch is gated and matched; accepted keys that are not there yet are appended, the rest counted by why not."""
    o = obs(spark, sf)
    ids = J.resolve_rules(parts(spark, sf), "p_name", _rules(spark)).select(F.col("text").alias("p_name"), "id")
    new = o.where("d >= date'1998-01-01'").join(parts(spark, sf).select(F.col("p_partkey").alias("item"), "p_name"), "item").join(ids, "p_name")
    ok, bad = G.split_quarantine(G.apply_gates(new, [(F.col("id").isNull(), "unmatched"), (F.col("price") < 3000, "low price")]))
    fresh = X.append_dedup(o.where("d < date'1998-01-01'").select("item", "source"), ok.select("item", "source"), ["item", "source"]).withColumn("outcome", F.lit("accepted"))
    known = J.semi(ok.select("item", "source").withColumn("k", F.concat_ws("/", "item", "source")), o.where("d < date'1998-01-01'").select(F.concat_ws("/", "item", "source").alias("k")), "k").select("item", "source", F.lit("known").alias("outcome"))
    rows = fresh.unionByName(known).unionByName(bad.select("item", "source", F.col("reason").alias("outcome")))
    return rows.distinct().groupBy("outcome").agg(F.count("*").alias("n"))


@query("""with q as (select distinct p_name query from part), l as (select distinct p_name || ' ' || lower(p_type) listing, round(p_retailprice)::bigint price from part where p_size > 25),
h as (select query, min(len(list_distinct(string_split(listing, ' '))) - len(list_distinct(string_split(query, ' ')))) e from q join l on len(list_filter(string_split(query, ' '), lambda t: not list_contains(string_split(listing, ' '), t))) = 0 group by 1)
select (select count(*) from q) targets, count(*) hits, count(*) filter (e = 0) exact, round(count(*) / (select count(*) from q), 4) hit_rate from h""")
def q19_marketplace_metrics(spark, sf):
    p = parts(spark, sf)
    listings = p.where("p_size > 25").select(F.concat_ws(" ", "p_name", F.lower("p_type")).alias("listing"), F.round("p_retailprice").cast("bigint").alias("price"))
    hits = J.match_tokens(p.select(F.col("p_name").alias("query")), listings, "query", "listing", "price")
    n = p.agg(F.count_distinct("p_name").alias("targets"))
    return hits.agg(F.count("*").alias("hits"), F.count_if(F.col("label") == "exact").alias("exact")).crossJoin(F.broadcast(n)).select("targets", "hits", "exact", F.round(F.col("hits") / F.col("targets"), 4).alias("hit_rate"))


@query("""with m as (select doc_id, unnest(regexp_extract_all(text, '([0-9]{1,3}(?:,[0-9]{3})+|[0-9]{4,7})', 1)) s from documents), n as (select doc_id, replace(s, ',', '')::bigint price from m)
select doc_id, price, price between 15000 and 900000 sane from n""")
def q20_priced_captions(spark, sf):
    """Every number in a text that could be a price, and whether it is a sane one."""
    found = F.regexp_extract_all("text", F.lit(r"([0-9]{1,3}(?:,[0-9]{3})+|[0-9]{4,7})"), 1)
    n = table(spark, sf, "documents").select("doc_id", F.explode(found).alias("s")).select("doc_id", F.regexp_replace("s", ",", "").cast("bigint").alias("price"))
    return n.withColumn("sane", G.is_sane("price", 15000, 900000))


@query("""with p as (select user_id f, event_id box, value x, hour(ts) * 60.0 + minute(ts) y, round(value)::bigint price from events where event_type = 'click'), n as (select user_id f, event_type || '-' || (event_id % 5) nm, value x, hour(ts) * 60.0 + minute(ts) y from events where event_type = 'view'),
b as (select p.f, box, p.price, n.nm, row_number() over (partition by p.f, box, p.price order by p.y - n.y, n.nm) k from p join n on p.f = n.f and n.y < p.y and p.y - n.y <= 120 and abs(p.x - n.x) <= 5),
g as (select nm, price, count(*) c from b where k = 1 group by 1, 2) select nm, price, c n from (select *, row_number() over (partition by nm order by c desc, length(price::varchar) desc, price) k from g) where k = 1""")
def q21_shelf_boxes(spark, sf):
    """Price boxes paired with the nearest name box above in their frame; the modal price of each name."""
    e = table(spark, sf, "events").withColumn("y", F.hour("ts") * 60.0 + F.minute("ts"))
    prices = e.where("event_type = 'click'").select(F.col("user_id").alias("f"), F.col("event_id").alias("box"), F.round("value").cast("bigint").alias("text"), F.col("value").alias("x"), "y")
    names = e.where("event_type = 'view'").select(F.col("user_id").alias("f"), F.concat_ws("-", "event_type", F.col("event_id") % 5).alias("text"), F.col("value").alias("x"), "y")
    paired = J.pair_boxes(names, prices, "f", 120.0, 5.0).where("name is not null").select(F.col("name").alias("nm"), "price")
    return A.mode_by(paired, "nm", "price")


@query(f"""with {PAIR}, p0 as (select item, case when item % 10 in (3, 4) then 20000 else price end price from prev), c0 as (select item, case item % 10 when 3 then 23000 when 4 then 23001 else price end price from cur), x as (select p_brand, c.price n, p.price o, p.item is null isnew, c.item is null gone from p0 p full join c0 c on p.item = c.item join part on p_partkey = coalesce(p.item, c.item))
select p_brand, count(*) filter (isnew) added, count(*) filter (gone) lost, count(*) filter (not isnew and not gone and n <> o and abs(round((n - o) * 100.0 / o, 4)) > 15) moved, round(avg(n), 2) mean_now from x group by 1""")
def q23_place_diff(spark, sf):
    """Some prices rise by exactly the tolerance, which is no move, and some by a little more."""
    a, b = pair(spark, sf)
    last = F.col("item") % 10
    a = a.withColumn("price", F.when(last.isin(3, 4), 20000).otherwise(F.col("price")))
    b = b.withColumn("price", F.when(last == 3, 23000).when(last == 4, 23001).otherwise(F.col("price")))
    brand = parts(spark, sf).select(F.col("p_partkey").alias("item"), "p_brand")
    moves = A.membership_moves(a, b, "item", "price").join(brand, "item").groupBy("p_brand").agg(F.count_if(F.col("kind") == "new").alias("added"), F.count_if(F.col("kind") == "removed").alias("lost"), F.count_if(F.col("kind").isin("rise", "drop")).alias("moved"))
    seen = O.key_sets(a, b, "item").join(brand, "item").join(b.select("item", "price"), "item", "left").groupBy("p_brand").agg(F.round(F.avg("price"), 2).alias("mean_now"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return seen.join(moves, "p_brand", "left").select("p_brand", zero("added"), zero("lost"), zero("moved"), "mean_now")


@query(f"""with {PAIR}, j as (select case when p.item is null then 'new' when c.item is null then 'removed' when (abs(c.price - p.price) < 1000 and abs(round((c.price - p.price) * 100.0 / p.price, 4)) < 1) or c.price = p.price then null when c.price < p.price then 'drop' else 'rise' end kind from prev p full join cur c on p.item = c.item)
select (select max(d) from obs) entry_date, count(*) filter (kind = 'new') added, count(*) filter (kind = 'removed') removed, count(*) filter (kind = 'drop') dropped, count(*) filter (kind = 'rise') risen, (select count(distinct source) from obs) sources from j""", dates=["entry_date"])
def q25_update_entry(spark, sf):
    """One entry of the update log: the date of the newest observation and the snapshot's changes by kind."""
    kinds = A.snapshot_diff(*pair(spark, sf), "item", "price").agg(*(F.count_if(F.col("kind") == k).alias(n) for k, n in (("new", "added"), ("removed", "removed"), ("drop", "dropped"), ("rise", "risen"))))
    fresh = A.freshness_summary(obs(spark, sf), "source", "item", "d").agg(F.max("latest").alias("entry_date"), F.count("*").alias("sources"))
    return kinds.crossJoin(F.broadcast(fresh)).select("entry_date", "added", "removed", "dropped", "risen", "sources")


@query(f"""with {OBS}, {LATEST}, a as (select item, min(price) fa from latest where source in ('S0', 'S1') group by 1), b as (select item, min(price) fb from latest where source in ('S2', 'S3') group by 1),
x as (select p_partkey, round(p_retailprice)::bigint * 30 vetted, least(fa, fb) candidate from part left join a on a.item = p_partkey left join b on b.item = p_partkey)
select p_partkey, vetted, candidate, case when candidate is null then 'missing' when abs(candidate - vetted) * 100.0 >= vetted * 35 then 'rejected' else 'refreshed' end outcome, case when candidate is not null and abs(candidate - vetted) * 100.0 < vetted * 35 then candidate else vetted end price from x""")
def q26_pick_refresh(spark, sf):
    """Vetted prices are refreshed by the lower of two floors unless that deviates by 35 percent or more."""
    last = A.latest_per_source(obs(spark, sf), "item", "source", "d", "price")
    side = lambda s, n: last.where(F.col("source").isin(*s)).groupBy("item").agg(F.min("price").alias(n))
    p = parts(spark, sf).select(F.col("p_partkey").alias("item"), (F.round("p_retailprice").cast("bigint") * 30).alias("vetted"))
    x = p.join(side(("S0", "S1"), "fa"), "item", "left").join(side(("S2", "S3"), "fb"), "item", "left").withColumn("candidate", F.least("fa", "fb"))
    far = F.abs(F.col("candidate") - F.col("vetted")) * 100.0 >= F.col("vetted") * 35
    outcome = F.when(F.col("candidate").isNull(), "missing").when(far, "rejected").otherwise("refreshed")
    return x.select(F.col("item").alias("p_partkey"), "vetted", "candidate", outcome.alias("outcome"), F.when(outcome == "refreshed", F.col("candidate")).otherwise(F.col("vetted")).alias("price"))
