"""The reports' other tables: what each end-user report writes beside its main one, put together from the operators."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyvane.functions import classify as C
from tallyvane.functions import text as T
from tallyvane.functions import values as V
from tallyvane.operators import aggregates as A
from tallyvane.operators import gates as G
from tallyvane.operators import joins as J
from tallyvane.operators import ordering as O
from tallyvane.operators import ranking
from tallyvane.operators import series as W
from tallyvane.plans.aggregates import LATEST, LEDGER, _moves
from tallyvane.plans.base import OBS, PAIR, monthly, obs, pair, query, table
from tallyvane.plans.functions import FX_SQL, _fx
from tallyvane.plans.joins import RULE_SQL, _rules, parts
from tallyvane.plans.series import STUDY, _cmp, _study
from tallyvane.sources import readers as R
from tallyvane.sources import writers as X


def _names(spark, sf, *more):
    return parts(spark, sf).select(F.col("p_partkey").alias("item"), "p_name", *more)


# --- Q1: the clean table, its statistics, the master table and the spellings

CLEAN = f"""{OBS}, {RULE_SQL}, res as (select nm.t, (select id from rules r where r.rule_no = b.rule_no) id from nm left join best b using (t)),
x as (select o.*, p_name, id from obs o join part on p_partkey = item join res on t = p_name), g as (select *, case when price < 3000 then 'low price' when id is null then 'unmatched' end reason from x),
m as (select id, avg(price) a from g where reason is null and d < date '1998-01-01' group by 1),
clean as (select g.item, source, d, price, p_name, g.id, case when reason is not null then reason when coalesce(price < a * (1.0::double / 3.0::double) or price > a * 3.0, false) then 'outlier' else 'ok' end status from g left join m on m.id = g.id)"""


def _clean(spark, sf):
    ids = J.resolve_rules(parts(spark, sf), "p_name", _rules(spark)).select(F.col("text").alias("p_name"), "id")
    rows = obs(spark, sf).join(_names(spark, sf), "item").join(ids, "p_name")
    gated = G.apply_gates(rows, [(F.col("price") < 3000, "low price"), (F.col("id").isNull(), "unmatched")])
    flagged = G.flag_outliers(gated, "id", "price", (F.col("status") == "ok") & (F.col("d") < F.lit("1998-01-01").cast("date")))
    status = F.coalesce("reason", F.when(F.col("outlier"), "outlier").otherwise("ok"))
    return flagged.select("item", "source", "d", "price", "p_name", "id", status.alias("status"))


@query(f"with {CLEAN} select * from clean", dates=["d"])
def q1_clean(spark, sf):
    return _clean(spark, sf)


@query(f"""with {CLEAN}, s as (select source, status from clean) select source, count(*) filter (status = 'ok') ok, count(*) filter (status = 'low price') "low price", count(*) filter (status = 'unmatched') unmatched, count(*) filter (status = 'outlier') outlier, count(*) total from s group by 1
union all select 'total', count(*) filter (status = 'ok'), count(*) filter (status = 'low price'), count(*) filter (status = 'unmatched'), count(*) filter (status = 'outlier'), count(*) from s""")
def q1_audit(spark, sf):
    return A.gate_stats(_clean(spark, sf), "source", "status", ["ok", "low price", "unmatched", "outlier"])


@query(f"""with {CLEAN}, k as (select * from clean where status = 'ok') select id, count(distinct p_name) aliases, count(*) "rows", array_to_string(list_sort(list(distinct source)), '/') markets, min(price) min_price, max(price) max_price, array_to_string(list_sort(list(distinct p_name))[1:4], '; ') names from k group by 1""")
def q1_master(spark, sf):
    return A.master_summary(_clean(spark, sf).where("status = 'ok'"), "id", "p_name", "source", "price")


@query(f"""with {CLEAN}, s as (select id, list_sort(list(distinct p_name)) l from clean where status = 'ok' group by 1) select id, len(l) spellings, array_to_string(l[1:5], '; ') names from s where len(l) >= 2""")
def q1_spellings(spark, sf):
    return A.alias_audit(_clean(spark, sf).where("status = 'ok'"), "id", "p_name", 2, 5)


# --- Q2 to Q6


@query(f"""with {OBS}, o as (select * from obs where price >= 15000 and d <= date '1998-06-30'), day as (select item, d, min(price) price from o group by 1, 2),
l as (select *, lag(price) over (partition by item order by d) prev, row_number() over (partition by item order by d desc) k from day), s as (select item, array_to_string(list_sort(list(distinct source)), '|') sources from o group by 1)
select item, replace(p_name, 'red', 'crimson') "name", d as_of, price "current", prev, case when prev is null then 'new' when price < prev then 'down' when price > prev then 'up' else 'same' end badge, sources from l join s using (item) join part on p_partkey = item where k = 1 and length(p_name) <= 10""", dates=["as_of"])
def q2_badges(spark, sf):
    """Sane prices that aren't from the future, of names short enough to be any: the last one with its badge, and the sources that know the item."""
    good = obs(spark, sf).where(G.is_sane("price") & ~G.is_future("d", "1998-06-30"))
    names = _names(spark, sf).where(~T.garbage("p_name", 10)).withColumn("name", T.rewrite("p_name", [("red", "crimson")])).drop("p_name")
    last = W.prev_value(good, ["item"], "d", "price").withColumnsRenamed({"d": "as_of", "price": "current"})
    return last.join(J.key_sets_by(good, "item", "source").withColumnRenamed("keys", "sources"), "item").join(names, "item")


@query(f"""with {OBS}, {LATEST}, a as (select item, min(price) pa from latest where source in ('S0', 'S2') group by 1), b0 as (select item, min(price) pb from latest where source in ('S1', 'S3') group by 1),
b as (select item, pb, false estimated from b0 union all select p_partkey, round(p_retailprice)::bigint * 40, true from part where p_partkey not in (select item from b0)),
k as (select item, array_to_string(list_sort(list(distinct source)), '|') keys from obs group by 1)
select item, pa, pb, estimated, case when pa < pb then 'a' when pb < pa then 'b' else 'tie' end verdict, keys from a join b using (item) join k using (item)""")
def q3_rows(spark, sf):
    """Both countries' floors side by side, the other one's estimated where it has none, and the sources to be shown."""
    last = A.latest_per_source(obs(spark, sf), "item", "source", "d", "price")
    side = lambda s, n: last.where(F.col("source").isin(*s)).groupBy("item").agg(F.min("price").alias(n))
    dim = parts(spark, sf).select(F.col("p_partkey").alias("item"), (F.round("p_retailprice").cast("bigint") * 40).alias("ref"))
    other = A.with_fallback(side(("S1", "S3"), "floor"), dim, "item", "ref").withColumnRenamed("floor", "pb")
    verdict = F.when(F.col("pa") < F.col("pb"), "a").when(F.col("pb") < F.col("pa"), "b").otherwise("tie")
    return side(("S0", "S2"), "pa").join(other, "item").withColumn("verdict", verdict).join(J.key_sets_by(obs(spark, sf), "item", "source"), "item")


@query(f"""with {PAIR}, {FX_SQL}, j as (select coalesce(p.item, c.item) item, p.price o, c.price n from prev p full join cur c on p.item = c.item),
k as (select item, o, n, case when o is null then 'new' when n is null then 'removed' when (abs(n - o) < 1000 and abs(round((n - o) * 100.0 / o, 4)) < 1) or n = o then null when n < o then 'drop' else 'rise' end kind from j),
r as (select c, max_by(r, d) r from cr where d <= date '1998-06-30' group by 1), fl as (select item, min(price) local_floor from obs where source = 'S4' and d < date '1998-05-01' group by 1)
select k.item, kind, n as "new", round(n * r.r, 2) converted, local_floor, coalesce(n < local_floor, false) under_local from k join r on r.c = case when k.item % 2 = 0 then 'A' else 'N' end left join fl using (item) where kind is not null""")
def q4_change_rows(spark, sf):
    """Each change with its price in the other currency at the day's last rate, and whether it is under the local floor."""
    diff = A.snapshot_diff(*pair(spark, sf), "item", "price").withColumns({"d": F.to_date(F.lit("1998-06-30")), "currency": F.when(F.col("item") % 2 == 0, "A").otherwise("N")})
    fx = J.convert_asof(diff, J.cross_rates(_fx(spark, sf), "F"), "new", "currency", "d", "F", 31)
    local = A.min_floor(obs(spark, sf).where("source = 'S4' and d < date'1998-05-01'")).select("item", F.col("floor").alias("local_floor"))
    out = J.lookup(fx, local, "item")
    return out.select("item", "kind", "new", F.round("converted", 2).alias("converted"), "local_floor", F.coalesce(F.col("new") < F.col("local_floor"), F.lit(False)).alias("under_local"))


MATCHED = """lbl as (select p_partkey item, p_brand, p_size, p_name || ' ' || lower(p_type) l from part), dim as (select distinct p_brand, p_name nm from part),
mt as (select item, nm, p_size from (select item, p_size, nm, row_number() over (partition by item order by length(l) - length(nm), nm) k from lbl join dim using (p_brand) where contains(l, nm) and length(l) - length(nm) <= 7) where k = 1)"""


def _matched(spark, sf):
    """(item, p_size, name): items whose label holds a name of their brand with at most seven characters more."""
    p = parts(spark, sf).select(F.col("p_partkey").alias("item"), "p_size", "p_brand", F.concat_ws(" ", "p_name", F.lower("p_type")).alias("label"))
    found = J.match_contains(p.select("label", "p_brand"), parts(spark, sf), "label", "p_name", "p_brand", 7).select(F.col("item").alias("label"), "p_brand", "name")
    return p.join(found, ["label", "p_brand"]).select("item", "p_size", "name")


@query(f"""with {OBS}, {LATEST}, {MATCHED}, a as (select item, min(price) pa from latest where source = 'S0' group by 1), b as (select item, min(price) pb from latest where source <> 'S0' group by 1)
select item, nm as "name", round(pa * 100.0 / p_size, 4) unit_a, round(pb * 100.0 / p_size, 4) unit_b, round((pb - pa) * 100.0 / pb, 2) gap_pct, case when pb >= greatest(pa, 1) * 2.5 then 'diverges' when (pb - pa) * 100.0 >= pb * 30 then 'strong' else 'mild' end tier
from mt join a using (item) join b using (item) where pa < pb and p_size > 0""")
def q5_unit_tiers(spark, sf):
    """What is cheaper than local, per unit and without a cap: pairs too far apart to be one product are shown as such."""
    last = A.latest_per_source(obs(spark, sf), "item", "source", "d", "price")
    side = lambda where, n: last.where(where).groupBy("item").agg(F.min("price").alias(n))
    x = _matched(spark, sf).where("p_size > 0").join(side("source = 'S0'", "pa"), "item").join(side("source <> 'S0'", "pb"), "item").where("pa < pb")
    tier = F.when(~G.divergence_ok("pa", "pb"), "diverges").when((F.col("pb") - F.col("pa")) * 100.0 >= F.col("pb") * 30, "strong").otherwise("mild")
    return x.select("item", "name", *(F.round(V.unit_price(c, "p_size"), 4).alias(n) for c, n in (("pa", "unit_a"), ("pb", "unit_b"))), F.round((F.col("pb") - F.col("pa")) * 100.0 / F.col("pb"), 2).alias("gap_pct"), tier.alias("tier"))


@query(f"""with {OBS}, {LATEST}, {MATCHED}, a as (select item, min(price) pa from latest where source = 'S0' group by 1), l as (select nm, part.p_brand, min(price * 100.0 / p_size) ub from latest join part on p_partkey = item join dim on nm = p_name and dim.p_brand = part.p_brand where source <> 'S0' and p_size > 0 group by 1, 2)
select item, mt.nm as "name", round(pa * 100.0 / mt.p_size, 4) unit_a, round(ub, 4) unit_b, case when pa * 100.0 / mt.p_size <= ub * 0.7 then 'buy' when pa * 100.0 / mt.p_size <= ub then 'consider' else 'skip' end verdict
from mt join a using (item) join part on p_partkey = item join l on l.nm = mt.nm and l.p_brand = part.p_brand where mt.p_size > 0""")
def q6_matched_value(spark, sf):
    """Items against the cheapest local unit price of the product that their label is matched to."""
    last = A.latest_per_source(obs(spark, sf), "item", "source", "d", "price").join(_names(spark, sf, "p_brand", "p_size").withColumnRenamed("p_size", "size"), "item").where("size > 0")
    local = last.where("source <> 'S0'").groupBy(F.col("p_name").alias("name"), "p_brand").agg(F.min(F.col("price") * 100.0 / F.col("size")).alias("ub"))
    own = last.where("source = 'S0'").groupBy("item", "p_brand").agg(F.min("price").alias("pa"))
    x = _matched(spark, sf).join(own, "item").join(local, ["name", "p_brand"]).withColumn("ua", V.unit_price("pa", "p_size"))
    verdict = F.when(F.col("ua") <= F.col("ub") * 0.7, "buy").when(F.col("ua") <= F.col("ub"), "consider").otherwise("skip")
    return x.select("item", "name", F.round("ua", 4).alias("unit_a"), F.round("ub", 4).alias("unit_b"), verdict.alias("verdict"))


# --- Q7 to Q11

THREE = f"{OBS}, {LATEST}, f as (select item, min(price) filter (source = 'S0') a, min(price) filter (source = 'S1') b, min(price) filter (source = 'S2') c, min(price) filter (source = 'S3') local from latest group by 1)"


def _three(spark, sf):
    last = A.latest_per_source(obs(spark, sf), "item", "source", "d", "price")
    pick = lambda s: F.min(F.when(F.col("source") == s, F.col("price")))
    return last.groupBy("item").agg(*(pick(f"S{i}").alias(n) for i, n in enumerate(("a", "b", "c", "local"))))


@query(f"""with {THREE} select item, case when a < b then 'a' when b < a then 'b' when a = b then 'tie' end ab, case when a < c then 'a' when c < a then 'c' when a = c then 'tie' end ac, case when b < c then 'b' when c < b then 'c' when b = c then 'tie' end bc,
least(a, b, c) low, local, round((local - least(a, b, c)) * 100.0 / nullif(local, 0), 2) gap_pct from f where (a is not null)::int + (b is not null)::int + (c is not null)::int >= 2""")
def q7_pairwise(spark, sf):
    """Who wins of each two shops, and what the cheapest saves against the local floor."""
    won = lambda x, y: F.when(F.col(x) < F.col(y), x).when(F.col(y) < F.col(x), y).when(F.col(x) == F.col(y), "tie")
    n = sum((F.col(k).isNotNull().cast("int") for k in "abc"), F.lit(0))
    low = F.least("a", "b", "c")
    return _three(spark, sf).where(n >= 2).select("item", *(won(x, y).alias(x + y) for x, y in ("ab", "ac", "bc")), low.alias("low"), "local", F.round((F.col("local") - low) * 100.0 / F.when(F.col("local") != 0, F.col("local")), 2).alias("gap_pct"))


@query(f"""with {THREE}, s as (select item, concat_ws('+', case when a is not null then 'a' end, case when b is not null then 'b' end, case when c is not null then 'c' end) shops from f) select shops, count(*) n, min(item) first_item from s where shops <> '' group by 1""")
def q7_only_in(spark, sf):
    shops = F.concat_ws("+", *(F.when(F.col(k).isNotNull(), k) for k in "abc"))
    return _three(spark, sf).withColumn("shops", shops).where("shops <> ''").groupBy("shops").agg(F.count("*").alias("n"), F.min("item").alias("first_item"))


@query(f"with {THREE} select item, least(a, b, c) low, local, round(local / least(a, b, c), 4) ratio from f where local <= least(a, b, c) * 1.05")
def q8_as_cheap(spark, sf):
    """Where the local price is as good: at most five percent over the cheapest shop."""
    low = F.least("a", "b", "c")
    return _three(spark, sf).where(F.col("local") <= low * 1.05).select("item", low.alias("low"), "local", F.round(F.col("local") / low, 4).alias("ratio"))


MOVES = f"""{OBS}, a1 as (select item, min(price) a from obs where source = 'S0' and year(d) = 1997 group by 1), b1 as (select item, min(price) b from obs where source = 'S1' and year(d) = 1997 group by 1), a2 as (select item, min(price) a from obs where source = 'S0' and year(d) = 1998 group by 1), b2 as (select item, min(price) b from obs where source = 'S1' and year(d) = 1998 group by 1),
c1 as (select item, a, b from a1 join b1 using (item)), c2 as (select item, a, b from a2 join b2 using (item)), r1 as (select *, rank() over (order by b - a desc) k from c1), r2 as (select *, rank() over (order by b - a desc) k from c2),
mv as (select r1.item, r1.k - r2.k climb, case when r2.a = r1.a and r2.b = r1.b then 'none' when abs(r2.a - r1.a) >= abs(r2.b - r1.b) then 'a' else 'b' end cause from r1 join r2 using (item))"""


@query(f"""with {MOVES}, wins as (select month(d) m, item, min(struct_pack(p := price, s := source)) b from obs where year(d) = 1998 group by 1, 2), w as (select m, b.s shop, count(*) n from wins group by 1, 2), ch as (select m, shop, n from (select *, row_number() over (partition by m order by n desc, shop) k from w) where k = 1)
select 'top gap' section, row_number() over (order by b - a desc, item) place, item::varchar subject, b - a number from c2 where b > a qualify place <= 5
union all select 'bottom gap', row_number() over (order by b - a, item) p, item::varchar, b - a from c2 where b < a qualify p <= 3
union all select 'mover by ' || cause, row_number() over (order by abs(climb) desc, item) p, item::varchar, climb from mv qualify p <= 3
union all select 'champion', m, shop, n from ch""")
def q9_sections(spark, sf):
    """The day's other lists: the largest and least gaps, who moved most and why, and each month's champion."""
    cur = _cmp(spark, sf, "year(d) = 1998").withColumn("gap", F.col("b") - F.col("a"))

    def listed(df, section, order, number, k):
        top = O.with_rank(df, order, k, "place")
        return top.select(section.alias("section"), F.col("place").cast("long"), F.col("item").cast("string").alias("subject"), F.col(number).cast("long").alias("number"))

    moves = W.rank_movers(_cmp(spark, sf, "year(d) = 1997"), cur, "item", "a", "b")
    wins = obs(spark, sf).where("year(d) = 1998").groupBy(F.month("d").alias("m"), "item").agg(F.min(F.struct("price", "source")).alias("b")).select("m", F.col("b.source").alias("shop"))
    champions = A.scoreboard(wins, "m", "shop").select(F.lit("champion").alias("section"), F.col("m").cast("long").alias("place"), F.col("champion").alias("subject"), F.col("wins").alias("number"))
    out = listed(cur.where("gap > 0"), F.lit("top gap"), [F.col("gap").desc(), F.col("item")], "gap", 5).unionByName(listed(cur.where("gap < 0"), F.lit("bottom gap"), [F.col("gap"), F.col("item")], "gap", 3))
    return out.unionByName(listed(moves, F.concat(F.lit("mover by "), "cause"), [F.abs("climb").desc(), F.col("item")], "climb", 3)).unionByName(champions)


@query(f"""with {OBS}, {LATEST}, p as (select item, min(struct_pack(p := price, s := source)) b from latest where source not in ('S1', 'S3') group by 1), o as (select item, min(struct_pack(p := price, s := source)) b from latest where source in ('S1', 'S3') group by 1), l as (select item, max(d) d from obs group by 1)
select p_partkey, to_json(struct_pack(retail := struct_pack(price := p.b.p, source := p.b.s), web := struct_pack(price := o.b.p, source := o.b.s), floor := least(p.b.p, o.b.p)))::varchar snapshot, coalesce(l.d = (select max(d) from l), false) is_new, case when p.b.p is not null and o.b.p is not null then greatest(p.b.p, o.b.p) < greatest(least(p.b.p, o.b.p), 1) * 2.5 else true end agree
from part left join p on p.item = p_partkey left join o on o.item = p_partkey left join l on l.item = p_partkey""")
def q10_snapshot(spark, sf):
    """The dashboard's rows: every catalogue item with its nested floors as JSON, whether it is new, and whether the two channels agree."""
    floors = A.partitioned_floor(obs(spark, sf), F.col("source").isin("S1", "S3"))
    rows = parts(spark, sf).select("p_partkey").join(floors, F.col("item") == F.col("p_partkey"), "left").drop("item").join(A.item_freshness(obs(spark, sf), "item", "d"), F.col("item") == F.col("p_partkey"), "left")
    nested = F.struct(F.struct(F.col("physical").alias("price"), F.col("physical_source").alias("source")).alias("retail"), F.struct(F.col("online").alias("price"), F.col("online_source").alias("source")).alias("web"), "floor")
    return rows.select("p_partkey", F.to_json(nested, {"ignoreNullFields": "false"}).alias("snapshot"), F.coalesce("is_new", F.lit(False)).alias("is_new"), G.divergence_ok("physical", "online").alias("agree"))


LADDER = {"small": (1, "small"), "medium": (2, "medium"), "large": (3, "large"), "economy": (4, "economy")}


@query(f"""with {OBS}, l as (select p_partkey, p_brand, case lower(p_type) when 'small' then 1 when 'medium' then 2 when 'large' then 3 when 'economy' then 4 end rk from part), big as (select p_brand from l where rk is not null group by 1 having count(*) >= 10),
a as (select p_brand, p_partkey, rk, min(price) price from obs join l on item = p_partkey where source = 'S0' and rk is not null and p_brand in (select p_brand from big) group by all), b as (select p_brand, rk o, min(price) other from obs join l on item = p_partkey where source = 'S1' and rk is not null group by all),
j as (select a.p_brand, p_partkey, rk "rank", price, max(o) filter (o < rk and price <= other) beats_rank, min(other) filter (o = rk) same from a left join b on a.p_brand = b.p_brand group by all),
s as (select *, (case when beats_rank is not null then 100 + 15 * ("rank" - beats_rank) else 0 end + case when round((price - same) * 100.0 / nullif(same, 0), 2) < 0 then round(-round((price - same) * 100.0 / nullif(same, 0), 2)) else 0 end)::bigint score from j)
select p_brand, p_partkey, "rank", beats_rank, score, place from (select *, row_number() over (partition by p_brand order by score desc, p_partkey) place from s) where place <= 3""")
def q11_panels(spark, sf):
    """Brands with ten items or more on the ladder: the best three by what their prices beat."""
    p = parts(spark, sf).select("p_partkey", "p_brand", C.ladder_rank("p_type", LADDER)["rank"].alias("rank")).where("rank is not null")
    big = p.groupBy("p_brand").agg(F.count("*").alias("n")).where("n >= 10")
    o = obs(spark, sf).join(p, F.col("item") == F.col("p_partkey"))
    side = lambda s, rows: rows.where(F.col("source") == s).groupBy("p_brand", "p_partkey", "rank").agg(F.min("price").alias("price"))
    scored = W.lens_score(W.value_lenses(side("S0", J.semi(o, big, "p_brand")), side("S1", o), "p_brand", "p_partkey", "rank", "price"))
    return O.top_k(scored.select("p_brand", "p_partkey", "rank", "beats_rank", "score"), [F.col("score").desc(), F.col("p_partkey")], 3, ["p_brand"]).withColumn("place", F.row_number().over(Window.partitionBy("p_brand").orderBy(F.col("score").desc(), "p_partkey")))


# --- Q13 to Q17


@query(f"""with {OBS}, b as (select unnest(['ring', 'bolt', 'gear']) token), o as (select w token, price * 100.0 / (p_size * 100) unit from obs join part on p_partkey = item, unnest(string_split(p_name, ' ')) u(w) where w in (select token from b) and p_size * 100 >= 500),
i as (select distinct p_name, w token from part, unnest(string_split(p_name, ' ')) u(w) where w in (select token from b)), m as (select p_name, count(*) offers, round(quantile_cont(unit, 0.5), 4) median from i join o using (token) group by 1),
f as (select p_name, min(price) floor from obs join part on p_partkey = item group by 1)
select p_name, case when floor <= 2000 then 'low' when floor <= 10000 then 'mid' else 'high' end band, offers, median from m join f using (p_name)""")
def q13_brand_offers(spark, sf):
    """International offers of a brand's token, beside the band of the own floor."""
    p = parts(spark, sf)
    offers = obs(spark, sf).join(p.select("p_partkey", "p_name", (F.col("p_size") * 100).alias("vol")), F.col("item") == F.col("p_partkey"))
    brands = spark.createDataFrame([("ring",), ("bolt",), ("gear",)], "token string")
    met = J.match_brand_age(p.select("p_name"), offers.select("p_name", "price", "vol"), "p_name", "p_name", "price", "vol", brands)
    floor = offers.groupBy(F.col("p_name").alias("item")).agg(F.min("price").alias("floor"))
    return met.join(floor, "item").select(F.col("item").alias("p_name"), V.band("floor", [2000, 10000], ["low", "mid", "high"], "right").alias("band"), "offers", "median")


@query(f"""with {PAIR}, {FX_SQL}, t as (select item, row_number() over (order by price, item) k from prev), u as (select item, row_number() over (order by price, item) k from cur),
st as (select case when p.item is null then 'new' when c.item is not null then 'still' when p.item in (select item from cur) then 'expired' else 'unknown' end s from (select item from t where k <= 30) p full join (select item from u where k <= 30) c on p.item = c.item),
w as (select c, min_by(r, d) a, max_by(r, d) b from cr where d between date '1998-06-01' and date '1998-06-30' group by 1),
e as (select event_type k, ts::date d, round(sum(value))::bigint v from events group by 1, 2), el as (select *, lag(d) over (partition by k order by d) pd, v - lag(v) over (partition by k order by d) delta from e), wk as (select date_trunc('week', d) w, k, sum(delta) s from el where d - pd = 1 group by 1, 2)
select 'fx' section, c "name", round((b - a) * 100.0 / nullif(a, 0), 4) number from w
union all select 'opportunity', s, count(*) from st group by 2
union all select 'funnel', 'collected', count(*) from cur union all select 'funnel', 'known before', count(*) from cur where item in (select item from prev) union all select 'funnel', 'cheaper', count(*) from cur join prev using (item) where cur.price < prev.price
union all select 'deepen', k, s from wk where w = (select max(w) from wk) and s <= -1 union all select 'raise', k, s from wk where w = (select max(w) from wk) and s >= 1""")
def q14_sections(spark, sf):
    """The digest's other sections: the currencies' month, what became of last month's opportunities, the funnel, the week's lists."""
    a, b = pair(spark, sf)
    rates = J.cross_rates(_fx(spark, sf), "F").withColumnRenamed("currency", "name")
    fx = W.window_change(rates, "name", "date", "rate", "1998-06-01", "1998-06-30").where("points >= 1")
    one = rates.where("date between date'1998-06-01' and date'1998-06-30'").select("name").distinct()
    fx = fx.join(one, "name").select(F.lit("fx").alias("section"), "name", F.col("pct").alias("number"))
    top = lambda df: df.orderBy("price", "item").limit(30)
    status = W.opportunity_diff(top(a), top(b), "item", b).groupBy(F.col("status").alias("name")).agg(F.count("*").cast("double").alias("number")).select(F.lit("opportunity").alias("section"), "name", "number")
    both = b.select("item", "price").join(a.select("item", F.col("price").alias("old")), "item", "left")
    funnel = A.funnel(both, [("collected", F.lit(True)), ("known before", F.col("old").isNotNull()), ("cheaper", F.col("price") < F.col("old"))]).select(F.lit("funnel").alias("section"), F.col("stage").alias("name"), F.col("n").cast("double").alias("number"))
    d = table(spark, sf, "events").groupBy(F.col("event_type").alias("k"), F.col("ts").cast("date").alias("d")).agg(F.round(F.sum("value")).cast("bigint").alias("v"))
    w = Window.partitionBy("k").orderBy("d")
    week = A.weekly_rollup(d.withColumn("pd", F.lag("d").over(w)).withColumn("delta", F.col("v") - F.lag("v").over(w)), "k", "d", "pd", "delta", "v", "v", 1)
    last = week.join(F.broadcast(week.agg(F.max("week").alias("week"))), "week").where("list is not null").select(F.col("list").alias("section"), F.col("k").alias("name"), F.col("delta").cast("double").alias("number"))
    return fx.unionByName(status).unionByName(funnel).unionByName(last)


@query(f"""with {STUDY}, bad as (select distinct item from ev), t as (select item, d, price from day where source = 'S1' and item not in (select item from bad)), a as (select price, min(price) over (partition by item order by d range between interval 1 day following and interval 90 day following) after_ from t),
c as (select after_ - price change from a where after_ is not null), n as (select count(*) n, count(*) filter (change < 0) drops from c),
v as (select case when n = 0 then 'no series' when before_ is null then 'unobservable before' when after_ is null then 'unobservable in window' when after_ < before_ then 'hit' when after_ > before_ then 'reverse' else 'flat' end verdict from j where k = 90)
select count(*) filter (verdict = 'hit') hits, count(*) filter (verdict in ('hit', 'reverse', 'flat')) seen, round(count(*) filter (verdict = 'hit') / nullif(count(*) filter (verdict in ('hit', 'reverse', 'flat')), 0), 4) hit_rate, (select round(drops / nullif(n, 0), 4) from n) baseline from v""")
def q15_lift(spark, sf):
    """How often the outcome falls within 90 days of an event, and how often it does without one."""
    events, series = _study(spark, sf)
    verdicts = W.event_study(events, series, "item", "d", "price", [90])
    seen = F.count_if(F.col("verdict").isin("hit", "reverse", "flat"))
    one = verdicts.agg(F.count_if(F.col("verdict") == "hit").alias("hits"), seen.alias("seen"))
    rate = W.baseline_rate(series, events, "item", "d", "price", 90).select(F.col("rate").alias("baseline"))
    return one.select("hits", "seen", F.round(F.col("hits") / F.when(F.col("seen") != 0, F.col("seen")), 4).alias("hit_rate")).crossJoin(F.broadcast(rate))


@query(f"""with {PAIR}, n as (select p_name || '-' || p_size nm, count(*) seen, min(cur.price) low, max(p_size * 25) volume, case when min(cur.price) >= 15000 then 'store' else 'online' end channel from cur join part on p_partkey = cur.item where p_partkey not in (select item from prev) group by 1), m as (select max(p_partkey) top from part)
select nm, seen, low, volume, channel, 'promoted' status, top + row_number() over (order by nm) id from n, m where low >= 5000 union all select nm, seen, low, volume, channel, 'review', null from n where low < 5000""")
def q17_promotion(spark, sf):
    """Candidates that pass get ids after the last one, in order of name; the rest stay for review without one."""
    a, b = pair(spark, sf)
    fresh = J.anti(b, a, "item").join(parts(spark, sf).select(F.col("p_partkey").alias("item"), F.concat_ws("-", "p_name", "p_size").alias("nm"), (F.col("p_size") * 25).alias("ml")), "item")
    n = fresh.groupBy("nm").agg(F.count("*").alias("seen"), F.min("price").alias("low"), F.max("ml").alias("volume")).withColumn("channel", F.when(F.col("low") >= 15000, "store").otherwise("online"))
    top = parts(spark, sf).agg(F.max("p_partkey").alias("top"))
    good = ranking.numbered(n.where("low >= 5000"), "nm", "no").crossJoin(F.broadcast(top)).select("nm", "seen", "low", "volume", "channel", F.lit("promoted").alias("status"), (F.col("top") + F.col("no")).alias("id"))
    return good.unionByName(n.where("low < 5000").select("nm", "seen", "low", "volume", "channel", F.lit("review").alias("status"), F.lit(None).cast("long").alias("id")))


# --- Q18 to Q26


@query(f"""with {OBS}, x as (select item, source, d, price, p_name, p_brand from obs join part on p_partkey = item where d >= date '1998-01-01'), ok as (select * from x where price >= 30000), bad as (select * from x where price < 30000), meta as (select p_name, min(p_brand) brand from ok group by 1),
r as (select bad.*, meta.brand, case when bad.price < 15000 then 'low price' when meta.p_name is null then 'unknown name' end reason from bad left join meta using (p_name))
select item, source, d, price, case when reason is null then brand end brand, coalesce(reason, 'accepted') outcome from r""", dates=["d"])
def q18_review(spark, sf):
    """What was quarantined is looked at again under the newer gate; what passes takes its brand from accepted rows of the same name."""
    x = obs(spark, sf).where("d >= date'1998-01-01'").join(_names(spark, sf, "p_brand"), "item")
    ok, bad = G.split_quarantine(G.apply_gates(x, [(F.col("price") < 30000, "low price")]))
    meta = ok.groupBy("p_name").agg(F.min("p_brand").alias("brand"))
    again = G.apply_gates(bad.drop("status", "reason").join(meta, "p_name", "left"), [(F.col("price") < 15000, "low price"), (F.col("brand").isNull(), "unknown name")])
    return again.select("item", "source", "d", "price", F.when(F.col("reason").isNull(), F.col("brand")).alias("brand"), F.coalesce("reason", F.lit("accepted")).alias("outcome"))


@query(f"""with {OBS}, t as (select p_name, min(p_partkey) item from part group by 1), s as (select p_name, min(price) search from obs join part on p_partkey = item where source <> 'S0' group by 1), g as (select p_name, min(price) page from obs join part on p_partkey = item where source = 'S0' group by 1)
select t.p_name, t.item, search, page, coalesce(page, search) price, case when page < search then 'page lower' when page > search then 'page higher' when page = search then 'same' when page is null then 'search only' else 'page only' end view from t left join s using (p_name) left join g using (p_name)""")
def q19_targets(spark, sf):
    """Targets once for each canonical name, with the page's price over the search's wherever there is one."""
    p = _names(spark, sf)
    rows = obs(spark, sf).join(p, "item").groupBy("p_name").agg(F.min(F.when(F.col("source") != "S0", F.col("price"))).alias("search"), F.min(F.when(F.col("source") == "S0", F.col("price"))).alias("page"))
    view = F.when(F.col("page") < F.col("search"), "page lower").when(F.col("page") > F.col("search"), "page higher").when(F.col("page") == F.col("search"), "same").when(F.col("page").isNull(), "search only").otherwise("page only")
    return p.groupBy("p_name").agg(F.min("item").alias("item")).join(rows, "p_name", "left").select("p_name", "item", "search", "page", F.coalesce("page", "search").alias("price"), view.alias("view"))


@query("""with c as (select conv_id, turn, case when turn % 2 = 0 then role else trim(regexp_replace(text, '[ \\t\\n\\x0b\\f\\r]+', ' ', 'g')) end nm, 5000 + 1000 * (turn * 7 + conv_id % 40) p from conversations)
select conv_id, turn ms, nm as "name", case when turn % 2 = 0 then 700 else 1000 end ml, p price, case when trim(nm) = '' or length(nm) > 35 or contains(nm, '. ') or trim(nm) like '%.' then 'garbage' when p < 15000 then 'low price' else 'ok' end outcome from c where nm <> ''""")
def q20_caption_rows(spark, sf):
    """Captions, whole turns and speakers, to priced rows: name, volume and price out of one line, gated by name and price."""
    c = table(spark, sf, "conversations")
    name = F.when(F.col("turn") % 2 == 0, F.col("role")).otherwise(F.trim(F.regexp_replace("text", r"[ \t\n\x0b\f\r]+", " ")))
    line = F.concat(name, F.when(F.col("turn") % 2 == 0, " | 700ml ").otherwise(" | 1L "), F.format_number(5000 + 1000 * (F.col("turn") * 7 + F.col("conv_id") % 40), 0), F.lit("원"))
    cut = F.array(F.struct(F.substring(line, 1, 5).alias("utf8")), F.struct(F.substr(line, F.lit(6)).alias("utf8")))
    docs = c.where(name != "").groupBy("conv_id").agg(F.to_json(F.struct(F.collect_list(F.struct(F.col("turn").alias("tStartMs"), cut.alias("segs"))).alias("events"))).alias("doc"))
    said = R.read_captions(docs, "doc", ["conv_id"])
    rows = said.select("conv_id", "ms", F.regexp_extract("text", r"^(.*?) ?\| ", 1).alias("name"), T.volume_ml("text").alias("ml"), T.to_num(F.regexp_extract("text", r"([0-9,]+)원$", 1)).alias("price"))
    gated = G.apply_gates(rows, [(T.garbage("name"), "garbage"), (~G.is_sane("price"), "low price")])
    return gated.select("conv_id", "ms", "name", "ml", "price", F.coalesce("reason", F.lit("ok")).alias("outcome"))


@query("""with e as (select user_id % 20 id, event_id % 3 age, event_type, round(value / 10)::bigint price from events), g as (select id, age, event_type, price, count(*) c from e where event_type in ('click', 'view') group by all),
m as (select id, age, event_type, price, c from (select *, row_number() over (partition by id, age, event_type order by c desc, length(price::varchar) desc, price) k from g) where k = 1)
select coalesce(a.id, b.id) id, coalesce(a.age, b.age) age, a.price ocr, b.price caption, case when a.price = b.price then 'agree' when a.price is null or b.price is null then 'single' else 'differ' end vote from (select * from m where event_type = 'click') a full join (select * from m where event_type = 'view') b on a.id = b.id and a.age = b.age""")
def q21_votes(spark, sf):
    """The modal price of each (id, age) by two ways of reading, and whether they agree."""
    e = table(spark, sf, "events").select((F.col("user_id") % 20).alias("id"), (F.col("event_id") % 3).alias("age"), "event_type", F.round(F.col("value") / 10).cast("bigint").alias("price"))
    mode = lambda kind, name: A.mode_by(e.where(F.col("event_type") == kind), ["id", "age"], "price").select("id", "age", F.col("price").alias(name))
    both = mode("click", "ocr").join(mode("view", "caption"), ["id", "age"], "full")
    return both.withColumn("vote", F.when(F.col("ocr") == F.col("caption"), "agree").when(F.col("ocr").isNull() | F.col("caption").isNull(), "single").otherwise("differ"))


@query("""with p as (select c_custkey k, 37.4 + (c_custkey % 1000) / 5000.0 lat, 126.9 + (c_custkey % 700) / 5000.0 lng, c_mktsegment, case c_custkey % 4 when 0 then 'corkage free' when 1 then 'corkage fee 10' when 2 then 'no corkage fee' else 'open late' end t from customer),
c as (select n_name centre, 37.4 + n_nationkey / 125.0 clat, 126.9 + (n_nationkey % 7) / 50.0 clng from nation),
x as (select p.k, centre, 2 * 6371000.0 * asin(sqrt(least(pow(sin(radians(clat - lat) / 2), 2) + cos(radians(lat)) * cos(radians(clat)) * pow(sin(radians(clng - lng) / 2), 2), 1.0))) m from p, c where abs(lat - clat) < 0.02),
y as (select k, centre, m, row_number() over (partition by k order by round(m, 3), centre) r from x where m <= 1500)
select p.k, case when c_mktsegment in ('BUILDING', 'MACHINERY') then 'trade' when c_mktsegment = 'HOUSEHOLD' then 'home' else 'other' end kind, case when k % 4 = 0 then 'explicit' when k % 4 = 1 then 'weak' when k % 4 = 2 then 'excluded' else 'none' end signal, k % 4 = 1 paid, centre, round(m, 3) metres from p join y using (k) where r = 1""")
def q22_tagged_places(spark, sf):
    """Places with their class, what their text says of corkage, and the nearest station."""
    c = table(spark, sf, "customer")
    text = F.when(F.col("c_custkey") % 4 == 0, "corkage free").when(F.col("c_custkey") % 4 == 1, "corkage fee 10").when(F.col("c_custkey") % 4 == 2, "no corkage fee").otherwise("open late")
    places = c.select(F.col("c_custkey").alias("k"), "c_mktsegment", text.alias("t"), (37.4 + (F.col("c_custkey") % 1000) / 5000.0).alias("lat"), (126.9 + (F.col("c_custkey") % 700) / 5000.0).alias("lng"))
    n = table(spark, sf, "nation").select(F.col("n_name").alias("centre"), (37.4 + F.col("n_nationkey") / 125.0).alias("lat"), (126.9 + (F.col("n_nationkey") % 7) / 50.0).alias("lng"))
    near = J.within_radius(places, n, 1500.0).withColumn("metres", F.round("metres", 3))
    best = O.top_k(near, [F.col("metres"), F.col("centre")], 1, ["k"])
    kind = C.classify_first("c_mktsegment", [("trade", ["building", "machinery"]), ("home", ["household"])], "other")
    return best.select("k", kind.alias("kind"), C.classify_signal("t", ["corkage free"], [], ["fee"], [], ["no corkage"]).alias("signal"), C.near_evidence("t", "fee", r"\bno\b").alias("paid"), "centre", "metres")


@query(f"""with {OBS}, m as (select item % 200 place, price / 10.0 p from obs where source = 'S1'), a as (select place, count(p) n, quantile_cont(p, 0.5) b, avg(p) y from m group by 1), e as (select place, round(case when n >= 4 then b else y end, 4) std, 'K' || place % 5 category from a),
c as (select category, count(*) places, round(avg(std), 4) mean from e group by 1) select place, category, std, mean, round((std - mean) * 100.0 / nullif(mean, 0), 2) over_mean_pct, places from e join c using (category)""")
def q23_cost_table(spark, sf):
    """Cost a person of each place beside its category's mean."""
    menu = obs(spark, sf).where("source = 'S1'").select((F.col("item") % 200).alias("place"), (F.col("price") / 10.0).alias("p"))
    e = A.estimate_per_person(menu, "place", "p").select("place", "std", F.concat(F.lit("K"), F.col("place") % 5).alias("category"))
    c = e.groupBy("category").agg(F.count("*").alias("places"), F.round(F.avg("std"), 4).alias("mean"))
    return e.join(J.bounded(c), "category").select("place", "category", "std", "mean", F.round((F.col("std") - F.col("mean")) * 100.0 / F.when(F.col("mean") != 0, F.col("mean")), 2).alias("over_mean_pct"), "places")


@query(f"""with {PAIR}, s as (select p_brand, p_partkey, p_partkey in (select item from cur) live from part) select p_brand, count(*) filter (live) live, count(*) filter (not live) candidates, round(count(*) filter (live) / count(*), 4) coverage from s group by 1""")
def q23_coverage(spark, sf):
    """Of each brand how many items the newest snapshot has, and how many are still to be found."""
    cur = pair(spark, sf)[1].select(F.col("item").alias("p_partkey"))
    live = J.semi(parts(spark, sf), cur, "p_partkey").groupBy("p_brand").agg(F.count("*").alias("live"))
    rest = J.anti(parts(spark, sf), cur, "p_partkey").groupBy("p_brand").agg(F.count("*").alias("candidates"))
    both = live.join(rest, "p_brand", "full").select("p_brand", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("live", "candidates")))
    return both.withColumn("coverage", F.round(F.col("live") / (F.col("live") + F.col("candidates")), 4))


@query(f"""with {LEDGER}, g as (select account, "at", "label", sum(amount)::bigint amount from moves group by all), r as (select *, coalesce(sum(amount) over (partition by account order by "at", "label" rows between unbounded preceding and 1 preceding), 0)::bigint before from g)
select account, "at"::date "at", "label", amount, before, before + amount balance, amount >= 0 or -amount <= before covered from r""", dates=["at"])
def q24_statement(spark, sf):
    """Every account's movements in order, with the balance after each, and whether a withdrawal was covered."""
    orders, ships = _moves(spark, sf)
    lines = O.timeline((orders, "order", "o_orderdate", -F.round("o_totalprice").cast("bigint")), (ships, "ship", "l_shipdate", F.round(F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("bigint")), key="account")
    one = lines.groupBy("account", "at", "label").agg(F.sum("amount").alias("amount"))
    upto = Window.partitionBy("account").orderBy("at", "label").rowsBetween(Window.unboundedPreceding, -1)
    out = one.withColumn("before", F.coalesce(F.sum("amount").over(upto), F.lit(0)))
    return out.select("account", F.col("at").cast("date").alias("at"), "label", "amount", "before", (F.col("before") + F.col("amount")).alias("balance"), ((F.col("amount") >= 0) | (-F.col("amount") <= F.col("before"))).alias("covered"))


@query(f"""with {PAIR}, ms as (select "month", count(*) n from monthly group by 1), k as (select (select count(*) from cur where item not in (select item from prev)) added, (select count(*) from prev where item not in (select item from cur)) removed)
select "month" entry, case when "month" = '1998-06' then (select added from k) else 0 end added, case when "month" = '1998-06' then (select removed from k) else 0 end removed, n items, case when "month" = '1998-06' then 'new' else 'old' end origin from ms where "month" between '1998-01' and '1998-06'""")
def q25_log(spark, sf):
    """The update log with the newest month's entry in place of the one it held before."""
    n = monthly(spark, sf).groupBy(F.col("month").alias("entry")).agg(F.count("*").alias("items")).where("entry between '1998-01' and '1998-06'")
    log = n.select("entry", F.lit(0).cast("long").alias("added"), F.lit(0).cast("long").alias("removed"), "items", F.lit("old").alias("origin"))
    sides = O.key_sets(*pair(spark, sf), "item").agg(F.count_if(F.col("side") == "new").alias("added"), F.count_if(F.col("side") == "removed").alias("removed"))
    entry = n.where("entry = '1998-06'").crossJoin(F.broadcast(sides)).select("entry", "added", "removed", "items", F.lit("new").alias("origin"))
    return X.upsert(log, entry, ["entry"])


@query(f"""with {THREE}, x as (select p_partkey, p_name || ' (vetted)' note, p_size, round(p_retailprice)::bigint * 30 vetted, least(a, b) candidate, local from part left join f on item = p_partkey),
y as (select *, case when candidate is null then 'missing' when abs(candidate - vetted) * 100.0 >= vetted * 35 then 'rejected' else 'refreshed' end outcome from x), z as (select *, case when outcome = 'refreshed' then candidate else vetted end price from y)
select p_partkey, note, outcome, price, local, case when local is null then 'unknown' when local - price >= 20000 then 'large' when local > price then 'some' else 'none' end gain, case when local is null or p_size = 0 then 'unknown' when (local - price) * 100.0 / p_size >= 100000 then 'large' when local > price then 'some' else 'none' end unit_gain from z""")
def q26_gains(spark, sf):
    """Picks with the text they were vetted with, refreshed where the candidate is near enough, and what they gain on the local price, a piece and a unit."""
    f = _three(spark, sf)
    p = parts(spark, sf).select("p_partkey", F.concat("p_name", F.lit(" (vetted)")).alias("note"), "p_size", (F.round("p_retailprice").cast("bigint") * 30).alias("vetted"))
    x = p.join(f, F.col("item") == F.col("p_partkey"), "left").withColumn("candidate", F.least("a", "b"))
    far = F.abs(F.col("candidate") - F.col("vetted")) * 100.0 >= F.col("vetted") * 35
    x = x.withColumn("outcome", F.when(F.col("candidate").isNull(), "missing").when(far, "rejected").otherwise("refreshed")).withColumn("price", F.when(F.col("outcome") == "refreshed", F.col("candidate")).otherwise(F.col("vetted")))
    gain = F.col("local") - F.col("price")
    grade = lambda value, edge, known: F.when(~known, "unknown").when(value >= edge, "large").when(gain > 0, "some").otherwise("none")
    known = F.col("local").isNotNull()
    return x.select("p_partkey", "note", "outcome", "price", "local", grade(gain, 20000, known).alias("gain"), grade(gain * 100.0 / F.when(F.col("p_size") != 0, F.col("p_size")), 100000, known & (F.col("p_size") != 0)).alias("unit_gain"))


@query(f"""with {THREE}, x as (select p_partkey, round(p_retailprice)::bigint * 30 vetted, least(a, b) candidate from part left join f on item = p_partkey) select case when candidate is null then 'missing' else 'rejected' end list, count(*) n, min(p_partkey) first_pick, max(abs(candidate - vetted)) worst from x where candidate is null or abs(candidate - vetted) * 100.0 >= vetted * 35 group by 1""")
def q26_audit(spark, sf):
    """The picks that weren't refreshed: how many, for which reason, and how far off the worst is."""
    p = parts(spark, sf).select("p_partkey", (F.round("p_retailprice").cast("bigint") * 30).alias("vetted"))
    x = p.join(_three(spark, sf), F.col("item") == F.col("p_partkey"), "left").withColumn("candidate", F.least("a", "b"))
    x = x.where(F.col("candidate").isNull() | (F.abs(F.col("candidate") - F.col("vetted")) * 100.0 >= F.col("vetted") * 35))
    return x.groupBy(F.when(F.col("candidate").isNull(), "missing").otherwise("rejected").alias("list")).agg(F.count("*").alias("n"), F.min("p_partkey").alias("first_pick"), F.max(F.abs(F.col("candidate") - F.col("vetted"))).alias("worst"))


