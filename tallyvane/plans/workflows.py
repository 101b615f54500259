"""Work that goes on over several steps or tables: quarantine and recovery, stored rows classified anew, picks, pairings and registries."""

from pyspark.sql import functions as F

from tallyvane.functions import classify as C
from tallyvane.operators import aggregates as A
from tallyvane.operators import joins as J
from tallyvane.operators import ordering as O
from tallyvane.operators import quarantine as Q
from tallyvane.operators import ranking
from tallyvane.operators import series as W
from tallyvane.operators import similar
from tallyvane.plans.base import OBS, PAIR, obs, pair, query, shared_folder, table
from tallyvane.plans.joins import parts
from tallyvane.sources.versioned import Table

# --- Q18: ingest, backfill, reprocessing

# Products: (id, word in the name, least and greatest usual price). The last one is learnt later.
PRODUCTS = [("R1", "ring", 30000, 20000), ("R2", "bolt", 60000, 30000), ("R3", "gear", 50000, 25000)]
KEYS, ROW_KEYS = ["id", "price", "place", "branch", "day"], ["raw", "price", "v", "at"]

REVIEWED = f"""{OBS}, x as (select distinct p_name raw, price, item % 60 v, item "at" from obs join part on p_partkey = item where source = 'S2' and (item % 60 % 6 <> 0 or contains(p_name, 'gear'))),
y as (select *, 'P' || v % 3 place, date '1998-01-01' + v::int "day", case when v % 4 > 0 then 'B' || v % 7 end branch, case when price < 15000 then 'low price' end gate,
  case when contains(raw, 'ring') then 'R1' when contains(raw, 'bolt') then 'R2' end first_id, case when contains(raw, 'ring') then 'R1' when contains(raw, 'bolt') then 'R2' when contains(raw, 'gear') then 'R3' end id from x),
b as (select * from (values ('R1', 30000, 20000), ('R2', 60000, 30000), ('R3', 50000, 25000)) t(id, lo, hi)),
z as (select y.*, coalesce(gate, case when first_id is null then 'unmatched' end, case when price < lo * 0.35 then 'below reference' when price > hi * 3.0 then 'above reference' end) first_reason,
  coalesce(gate, case when y.id is null then 'unmatched' end, case when price < lo * 0.35 then 'below reference' when price > hi * 3.0 then 'above reference' end) reason from y left join b on b.id = y.id),
have as (select distinct v from z where first_reason is null), acc as (select distinct id, price, place, branch, "day" from z where first_reason is null),
rec as (select distinct id, price, place, branch, "day" from z where first_reason is not null and reason is null and v in (select v from have))"""


@query(
    f"""with {REVIEWED} select 'accepted' state, id, price, place, branch, "day", null::varchar raw, null::bigint "at", null::varchar reason from (select * from acc union select * from rec)
union all select 'quarantined', null, price, null, null, null, raw, "at", first_reason from z where first_reason is not null and not (reason is null and v in (select v from have))""",
    dates=["day"],
)
def q18_reprocess(spark, sf):
    """Readings of five dozen sources: ingested under the first products, branches filled in from titles, the quarantine judged again once a product is learnt."""
    p = parts(spark, sf).select("p_partkey", F.col("p_name").alias("raw"))
    v = F.col("item") % 60
    x = obs(spark, sf).where("source = 'S2'").join(p, F.col("item") == F.col("p_partkey")).where((v % 6 != 0) | F.contains("raw", F.lit("gear"))).select("raw", "price", v.alias("v"), F.col("item").alias("at")).distinct()
    branch = F.when(F.col("v") % 4 > 0, F.concat(F.lit("B"), (F.col("v") % 7).cast("string")))
    day = F.date_add(F.lit("1998-01-01").cast("date"), F.col("v").cast("int"))
    rows = x.select("raw", "price", "v", "at", F.concat(F.lit("P"), (F.col("v") % 3).cast("string")).alias("place"), F.when(F.col("v") % 2 == 1, branch).alias("branch"), day.alias("day"))
    bands = spark.createDataFrame([(i, lo, hi) for i, _, lo, hi in PRODUCTS], "id string, lo long, hi long")

    def rules(known):
        found = F.coalesce(*(F.when(F.contains("raw", F.lit(w)), F.lit(i)) for i, w, _, _ in known))
        return Q.Rules([(F.col("price") < 15000, "low price")], p.select("raw", found.alias("id")).distinct(), bands)

    accepted, quarantined = (Table(spark, shared_folder(spark, "table"), parts=8) for _ in range(2))
    for _ in range(2):
        Q.ingest(rows, rules(PRODUCTS[:2]), accepted, quarantined, "raw", "price", KEYS, ROW_KEYS)
    Q.backfill(accepted, rows.select("v", branch.alias("branch")), "v", "branch", KEYS)
    for _ in range(2):
        Q.reprocess(accepted, quarantined, rules(PRODUCTS), "raw", "price", "v", ["place", "branch", "day"], KEYS, ROW_KEYS)
    none = lambda t, n: F.lit(None).cast(t).alias(n)
    good = accepted.read().select(F.lit("accepted").alias("state"), *KEYS, none("string", "raw"), none("long", "at"), none("string", "reason"))
    return good.unionByName(quarantined.read().select(F.lit("quarantined").alias("state"), none("string", "id"), "price", none("string", "place"), none("string", "branch"), none("date", "day"), "raw", "at", "reason"))


# --- A15 and Q14: hot deals, recommendations, the international block


@query(
    f"""with {OBS}, f as (select item, min(price) floor from obs where source = 'S0' group by 1), s as (select item, d, min(price) price from obs where source = 'S1' and d between date '1998-06-01' and date '1998-06-07' group by 1, 2),
n as (select item, max(d) d, max_by(floor - price, d) save, any_value(floor) floor from s join f using (item) where price < floor group by 1)
select item, d, save, floor, round(save / floor, 6) share, row_number() over (order by round(save / floor, 6) desc, save desc, item) place from n qualify place <= 20""",
    dates=["d"],
)
def a15_hot_deals(spark, sf):
    """A week's prices under the local floor; an item that is there on several days counts with the newest."""
    o = obs(spark, sf)
    floor = o.where("source = 'S0'").groupBy("item").agg(F.min("price").alias("floor"))
    week = o.where("source = 'S1' and d between date'1998-06-01' and date'1998-06-07'").groupBy("item", "d").agg(F.min("price").alias("price"))
    deals = week.join(floor, "item").where("price < floor").select("item", "d", (F.col("floor") - F.col("price")).alias("save"), "floor")
    return A.hot_deals(deals, "item", "d", "save", "floor")


GAPS = f"""{PAIR}, r as (select p_partkey item, round(p_retailprice)::bigint * 30 top, p_size % 3 > 0 buyable from part),
g as (select c.item, r.top - c.price gap, r.top - p.price prev_gap from cur c join r using (item) left join prev p using (item) where buyable),
st as (select item from (select item, r.top - p.price g from prev p join r using (item) where buyable) where g > 0 order by g desc, item limit 5)"""


@query(
    f"""with {GAPS}, k as (select *, prev_gap is null or (gap - prev_gap) * 100.0 > prev_gap * 5.0 fresh, item in (select item from st) repeated from g where gap > 0),
e as (select * from k where fresh or not repeated) select date '1998-06-30' "date", item, row_number() over (order by case when fresh then 0 else 1 end, gap desc, item) place, gap, fresh, repeated from e qualify place <= 5""",
    dates=["date"],
)
def q14_recommendations(spark, sf):
    """This month's picks of what can be bought: new ones and widened gaps first, then others that last month's picks don't have."""
    a, b = pair(spark, sf)
    ref = parts(spark, sf).where("p_size % 3 > 0").select(F.col("p_partkey").alias("item"), (F.round("p_retailprice").cast("bigint") * 30).alias("top"))
    gap = lambda df, name: df.join(ref, "item").select("item", (F.col("top") - F.col("price")).alias(name))
    before = gap(a, "prev_gap")
    state = before.where("prev_gap > 0").orderBy(F.desc("prev_gap"), "item").limit(5).select(F.lit("1998-05-31").cast("date").alias("date"), "item")
    return W.recommend(gap(b, "gap").join(before, "item", "left"), "item", "prev_gap", "gap", state, "1998-06-30")


@query(f"""with {OBS}, s as (select item, source, min(price) * 700.0 / (p_size * 25) unit from obs join part on p_partkey = item where p_size * 25 >= 500 group by item, source, p_size),
m as (select item, round(quantile_cont(unit, 0.5), 4) centre, count(*) regions from s where source in ('S2', 'S3', 'S4') group by 1), o as (select item, round(unit, 4) own from s where source = 'S0')
select item, own, centre, regions, round((centre - own) * 100.0 / centre, 2) attraction, row_number() over (order by round((centre - own) * 100.0 / centre, 2) desc, item) place from o join m using (item) qualify place <= 8""")
def q14_international(spark, sf):
    """The month's international block: own prices for 700 ml against the median of the regions that have the item, the most attractive first."""
    vol = parts(spark, sf).select(F.col("p_partkey").alias("item"), (F.col("p_size") * 25).alias("ml")).where("ml >= 500")
    s = obs(spark, sf).groupBy("item", "source").agg(F.min("price").alias("p")).join(vol, "item").withColumn("unit", F.col("p") * 700.0 / F.col("ml"))
    centre = s.where(F.col("source").isin("S2", "S3", "S4")).groupBy("item").agg(F.round(F.percentile("unit", 0.5), 4).alias("centre"), F.count("*").alias("regions"))
    own = s.where("source = 'S0'").select("item", F.round("unit", 4).alias("own"))
    both = own.join(centre, "item").withColumn("attraction", F.round((F.col("centre") - F.col("own")) * 100.0 / F.col("centre"), 2))
    return O.with_rank(both, [F.desc("attraction"), F.col("item")], 8, "place")


# --- Q13: styles and attractiveness


@query(f"""with {OBS}, o as (select item, min(price) low, count(*) lines from obs group by 1), x as (select p_partkey, replace(lower(p_name), 'blue bolt', ' ') t, round((round(p_retailprice)::bigint * 20 - low) * 100.0 / (round(p_retailprice)::bigint * 20), 4) gap, lines, p_size from part join o on item = p_partkey),
y as (select *, case when contains(t, 'red') or contains(t, 'blue') then 'peated' when contains(t, 'small') then 'light' end tier, concat_ws('; ', case when contains(t, 'red') then 'red' end, case when contains(t, 'blue') then 'blue' end) why from x),
z as (select p_partkey, tier, case when tier = 'light' then 'small' else why end reason, round(round(100 * (0.5 * greatest(0, least(1, gap / 100)) + 0.3 * greatest(0, least(1, ln(1 + lines) / (select max(ln(1 + lines)) from x))) + 0.2 * greatest(0, least(1, p_size / (select max(p_size) from x)))), 4), 3) score from y where tier is not null)
select tier, p_partkey, reason, score, row_number() over (partition by tier order by score desc, p_partkey) place from z qualify place <= 10""")
def q13_attractiveness(spark, sf):
    """Items by style tier, the most attractive of each: how far under the reference, how often sold, how much in stock."""
    ref = F.round("p_retailprice").cast("bigint") * 20
    low = obs(spark, sf).groupBy("item").agg(F.min("price").alias("low"), F.count("*").alias("lines"))
    p = parts(spark, sf).join(low, F.col("p_partkey") == F.col("item")).withColumn("gap", F.round((ref - F.col("low")) * 100.0 / ref, 4))
    styled = W.attractiveness(p, "gap", "lines", "p_size").withColumn("score", F.round("score", 3))
    styled = styled.withColumn("t", C.classify_tiers("p_name", [("peated", ["red", "blue"]), ("light", ["small"])], ["blue bolt"])).where("t.tier is not null")
    rows = styled.select(F.col("t.tier").alias("tier"), "p_partkey", F.col("t.reason").alias("reason"), "score")
    return W.best_n(rows, ["tier"], [F.desc("score"), F.col("p_partkey")], 10)


# --- Q22: pairing and registry ingest; Q23: stored rows classified anew; Q10: the dashboard's changes

# Profiles: (kind of place, style to go with it, another one, reason).
PROFILES = [("trade", "STANDARD", "PROMO", "rich food"), ("home", "SMALL", "ECONOMY", "light food"), ("other", "LARGE", "MEDIUM", "mixed")]
KINDS = [("trade", ["building", "machinery"]), ("home", ["household"])]
KIND_SQL = "case when c_mktsegment in ('BUILDING', 'MACHINERY') then 'trade' when c_mktsegment = 'HOUSEHOLD' then 'home' else 'other' end"
PROFILE_SQL = "pr as (select * from (values ('trade', 'STANDARD', 'PROMO', 'rich food'), ('home', 'SMALL', 'ECONOMY', 'light food'), ('other', 'LARGE', 'MEDIUM', 'mixed')) t(kind, style, alt, why))"


def _profiles(spark):
    return spark.createDataFrame(PROFILES, "kind string, style string, alt string, why string")


@query(f"""with {PROFILE_SQL}, b as (select p_type style, min(struct_pack(p := p_retailprice, k := p_partkey)) b from part group by 1)
select c_custkey, {KIND_SQL} kind, pr.style, pr.alt, pr.why, b.b.k bottle, b.b.p price, a.b.k alt_bottle, c_custkey % 4 = 0 marked from customer join pr on pr.kind = {KIND_SQL} left join b on b.style = pr.style left join b a on a.style = pr.alt""")
def q22_pairing(spark, sf):
    """Every place with the style that goes with its kind, another one, and the cheapest bottle of each."""
    c = table(spark, sf, "customer").select("c_custkey", C.classify_first("c_mktsegment", KINDS, "other").alias("kind"), (F.col("c_custkey") % 4 == 0).alias("marked"))
    bottle = parts(spark, sf).groupBy(F.col("p_type").alias("style")).agg(F.min(F.struct("p_retailprice", "p_partkey")).alias("b"))
    first = bottle.select("style", F.col("b.p_partkey").alias("bottle"), F.col("b.p_retailprice").alias("price"))
    other = bottle.select(F.col("style").alias("alt"), F.col("b.p_partkey").alias("alt_bottle"))
    return J.lookup(J.lookup(J.lookup(c, _profiles(spark), "kind"), first, "style"), other, "alt").select("c_custkey", "kind", "style", "alt", "why", "bottle", "price", "alt_bottle", "marked")


@query("""with x as (select c_custkey, trim(c_name) nm, case c_custkey % 5 when 0 then 'official certified' when 1 then 'self certified' when 2 then 'friendly' when 3 then '' end said, case when c_custkey % 7 > 0 then (37.4 + c_custkey / 100000.0)::varchar else 'n/a' end lat from customer),
y as (select *, case when contains(said, 'official') then 'A' when contains(said, 'self') then 'B' when contains(said, 'friendly') then 'C' end code from x where nm <> '')
select row_number() over (order by case when code = 'A' then 0 else 1 end, nm) place, nm, code, try_cast(lat as double) lat from y where code is not null""")
def q22_registry_ingest(spark, sf):
    """A public registry under headers of its own: columns by alias, grades by word, rows without one left out, the certified first."""
    grade = F.element_at(F.create_map(F.lit(0), F.lit("official certified"), F.lit(1), F.lit("self certified"), F.lit(2), F.lit("friendly"), F.lit(3), F.lit("")), (F.col("c_custkey") % 5).cast("int"))
    lat = F.when(F.col("c_custkey") % 7 > 0, (37.4 + F.col("c_custkey") / 100000.0).cast("string")).otherwise("n/a")
    raw = table(spark, sf, "customer").select(F.col("c_name").alias("Business Name"), F.when(F.col("c_custkey") % 5 < 4, grade).alias("Class"), lat.alias("Y"))
    own = J.by_alias(raw, {"nm": ["name", "business name"], "said": ["grade", "class"], "lat": ["lat", "y"], "phone": ["tel"]})
    tier = C.classify_tiers("said", [("A", ["official"]), ("B", ["self"]), ("C", ["friendly"])])["tier"]
    kept = own.select(F.trim("nm").alias("nm"), tier.alias("code"), F.col("lat").try_cast("double").alias("lat")).where("nm <> '' and code is not null")
    order = F.concat(F.when(F.col("code") == "A", "0").otherwise("1"), "nm")
    return ranking.numbered(kept.withColumn("_order", order), "_order", "place").select("place", "nm", "code", "lat")


@query(f"""with {PROFILE_SQL}, x as (select c_custkey, case when c_mktsegment = 'BUILDING' then 'trade' else 'other' end before, {KIND_SQL} kind from customer where c_custkey % 3 > 0)
select c_custkey, before, x.kind, before <> x.kind changed, style from x join pr on pr.kind = x.kind""")
def q23_reclassified(spark, sf):
    """Stored places classified by older rules, then anew in place: their class and style follow, the original category stays."""
    own = Table(spark, shared_folder(spark, "table"), parts=8)
    c = table(spark, sf, "customer").where("c_custkey % 3 > 0").select("c_custkey", "c_mktsegment", C.classify_first("c_mktsegment", [("trade", ["building"])], "other").alias("kind"))
    own.upsert(c, ["c_custkey"])
    stored = own.read().withColumnRenamed("kind", "before").withColumn("kind", C.classify_first("c_mktsegment", KINDS, "other"))
    own.replace(J.lookup(stored, _profiles(spark).select("kind", "style"), "kind"), ["c_custkey"])
    return own.read().select("c_custkey", "before", "kind", (F.col("before") != F.col("kind")).alias("changed"), "style")


@query(f"""with {PAIR}, d as (select coalesce(p.item, c.item) item, case when p.item is null then 'new' when c.item is null then 'removed' when c.price = p.price or (abs(c.price - p.price) < 1000 and abs(round((c.price - p.price) * 100.0 / p.price, 4)) < 1) then null when c.price < p.price then 'drop' else 'rise' end kind, c.price - p.price delta from prev p full join cur c on p.item = c.item),
u as (select item, price, 'priced' origin from cur union all select p_partkey, null, 'catalogue' from part where p_partkey not in (select item from cur))
select u.item, u.price, origin, coalesce(kind, 'unchanged') change, delta from u left join d on d.item = u.item and kind is not null""")
def q10_changes(spark, sf):
    """All items of the dashboard, the priced ones and the catalogue's others, each with what has changed since the last snapshot."""
    a, b = pair(spark, sf)
    wide = parts(spark, sf).select(F.col("p_partkey").alias("item"), F.lit("catalogue").alias("origin"))
    rows = O.union_fill(b.select("item", "price", F.lit("priced").alias("origin")), wide, "item")
    diff = A.snapshot_diff(a, b, "item", "price").select("item", F.col("kind").alias("change"), "delta")
    return rows.join(diff, "item", "left").select("item", "price", "origin", F.coalesce("change", F.lit("unchanged")).alias("change"), "delta")


# --- Q7 and Q17 over names that share no id


@query()
def q7_catalogues(spark, sf):
    """Three catalogues that share no id, matched by name and volume and then compared by unit price; greedy, so it is tested against plain Python."""
    sold = table(spark, sf, "lineitem").groupBy("l_partkey", (F.col("l_suppkey") % 3).cast("string").alias("shop")).agg(F.round(F.min(F.col("l_extendedprice") / F.col("l_quantity")) * 100).cast("bigint").alias("price"))
    p = parts(spark, sf).select("p_partkey", "p_name", "p_size", "p_brand")
    rows = sold.join(p, F.col("l_partkey") == F.col("p_partkey"))
    rows = rows.select("shop", "price", (F.col("p_partkey") * 4 + F.col("shop").cast("int")).cast("long").alias("place"), F.concat_ws(" ", "p_name", "p_size").alias("k1"), F.concat_ws("|", "p_name", "p_brand").alias("k2"), F.col("p_size").cast("long").alias("volume"))
    met = J.match_catalogues(rows, "shop", "0", "k1", "k2", "volume", "place", 5)
    return similar.compare_matched(met, "match_id", "shop", "price", "volume", ["0", "1", "2"])


@query()
def q17_mined(spark, sf):
    """Names of small parts as shops spell them, mined against the names of all others; the ratio has no SQL form."""
    p = parts(spark, sf).select("p_partkey", "p_size", F.concat_ws(" ", "p_name", F.concat((F.col("p_size") % 3 * 6 + 6).cast("string"), F.lit("yo")), F.lower("p_type")).alias("key"))
    seen = obs(spark, sf).join(p.where("p_size < 10"), F.col("item") == F.col("p_partkey"), "right")
    seen = seen.select("key", "price", "source", F.when(F.col("source") == "S0", F.upper("key")).otherwise(F.initcap("key")).alias("raw"))
    return similar.mine_candidates(seen, p.where("p_size >= 10"), "key", "raw", "price", "source", "key", "p_partkey", noise=F.contains("key", F.lit("gift box")))
