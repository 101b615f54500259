"""Queries of the joins, resolution, ordering and sink operators."""

from pyspark.sql import functions as F

from tallyvane.functions import text as T

from tallyvane.operators import joins as J
from tallyvane.operators import ordering as O
from tallyvane.plans.base import MONTHLY, OBS, PAIR, monthly, obs, pair, query, table
from tallyvane.sources import readers as R
from tallyvane.sources import writers as X


def parts(spark, sf):
    return table(spark, sf, "part")


@query(f"with {OBS} select item, source, d, price, p_brand from obs left join part on p_partkey = item", dates=["d"])
def j1_lookup(spark, sf):
    return J.lookup(obs(spark, sf), parts(spark, sf).select(F.col("p_partkey").alias("item"), "p_brand"), "item")


@query(f"with {PAIR} select coalesce(p.item, c.item) item, case when p.item is null then 'new' when c.item is null then 'removed' else 'common' end side from prev p full join cur c on p.item = c.item")
def j2_key_sides(spark, sf):
    return O.key_sets(*pair(spark, sf), "item")


@query(f"with {PAIR} select p_partkey, p_name from part where p_partkey in (select item from cur)")
def j3_semi(spark, sf):
    return J.semi(parts(spark, sf).select(F.col("p_partkey").alias("item"), "p_name"), pair(spark, sf)[1], "item").withColumnRenamed("item", "p_partkey")


@query(f"with {PAIR} select p_partkey, p_name from part where p_partkey not in (select item from cur)")
def j3_anti(spark, sf):
    return J.anti(parts(spark, sf).select(F.col("p_partkey").alias("item"), "p_name"), pair(spark, sf)[1], "item").withColumnRenamed("item", "p_partkey")


# Literal rules over part names: (rule_no, id, name, match, not, alias).
RULES = [
    (1, "R1", "small ring", ["small", "ring"], [], []),
    (2, "R2", "red thing", ["red"], ["widget"], []),
    (3, "R3", "bolt", ["bolt"], ["blue"], ["hot gear"]),
    (4, "R4", "any gear", ["gear"], [], []),
    (5, "R5", "blue", ["blue"], [], []),
]


def _rules(spark):
    return spark.createDataFrame(RULES, "rule_no int, id string, name string, match array<string>, not array<string>, alias array<string>")


RULE_SQL = """rules as (select * from (values (1, 'R1', 'small ring', ['small', 'ring'], []::varchar[], []::varchar[]), (2, 'R2', 'red thing', ['red'], ['widget'], []::varchar[]),
 (3, 'R3', 'bolt', ['bolt'], ['blue'], ['hot gear']), (4, 'R4', 'any gear', ['gear'], []::varchar[], []::varchar[]), (5, 'R5', 'blue', ['blue'], []::varchar[], []::varchar[])) t(rule_no, id, name, m, n, a)),
nm as (select distinct p_name t from part),
hit as (select t, rule_no, id, name from nm, rules where (len(list_filter(m, lambda x: contains(lower(t), x))) = len(m) or len(list_filter(a, lambda x: contains(lower(t), x))) > 0) and len(list_filter(n, lambda x: contains(lower(t), x))) = 0),
best as (select t, min(rule_no) rule_no, count(*) hits from hit group by 1)"""


# Names as they are typed: other words for the same thing, asides in brackets, signs; and rules of one letter, of a sign, inside words.
MORE_RULES = [(0, "R0", "boxed x", ["x", "+"], [], []), *RULES, (6, "R6", "sign", ["+"], ["bolt"], []), (7, "R7", "letter", ["z"], [], ["d/"])]
SYNONYMS, NOISE = {"ring": ["circle", "rings"], "gear": ["cog"]}, [r"\([^)]*\)"]
TYPED = "case when p_size % 3 = 0 then replace(p_name, 'ring', 'CIRCLE') when p_size % 3 = 1 then replace(p_name, 'gear', 'Cog') else upper(p_name) end || case when p_size % 7 = 0 then ' a+b box' when p_size % 7 = 1 then ' box' when p_size % 7 = 2 then ' (blue bolt)' when p_size % 7 = 3 then ' d/e' else '' end"


@query(f"""with rules as (select * from (values (0, 'R0', 'boxed x', ['x', '+'], []::varchar[], []::varchar[]), (1, 'R1', 'small ring', ['small', 'ring'], [], []), (2, 'R2', 'red thing', ['red'], ['widget'], []),
 (3, 'R3', 'bolt', ['bolt'], ['blue'], ['hot gear']), (4, 'R4', 'any gear', ['gear'], [], []), (5, 'R5', 'blue', ['blue'], [], []), (6, 'R6', 'sign', ['+'], ['bolt'], []), (7, 'R7', 'letter', ['z'], [], ['d/'])) t(rule_no, id, name, m, n, a)),
nm as (select distinct {TYPED} t from part), lo as (select t, trim(regexp_replace(regexp_replace(replace(replace(replace(lower(t), 'circle', 'ring'), 'rings', 'ring'), 'cog', 'gear'), '\\([^)]*\\)', ' ', 'g'), '\\s+', ' ', 'g')) s from nm),
hit as (select t, rule_no, id, name from lo, rules where (len(list_filter(m, lambda x: contains(s, x))) = len(m) or len(list_filter(a, lambda x: contains(s, x))) > 0) and len(list_filter(n, lambda x: contains(s, x))) = 0),
best as (select t, min(rule_no) rule_no, count(*) hits from hit group by 1)
select lo.t "text", case when contains(s, 'rod') then 'excluded' when b.rule_no is not null then 'matched' else 'unmatched' end status, case when not contains(s, 'rod') then r.id end id, case when not contains(s, 'rod') then r.name end "name",
 case when not contains(s, 'rod') then b.rule_no end rule_no, coalesce(hits, 0) hits from lo left join best b on b.t = lo.t left join rules r on r.rule_no = b.rule_no""")
def j4_resolve_rules(spark, sf):
    rules = spark.createDataFrame(MORE_RULES, "rule_no int, id string, name string, match array<string>, not array<string>, alias array<string>")
    return J.resolve_rules(parts(spark, sf).select(F.expr(TYPED).alias("typed")), "typed", rules, ["rod"], synonyms=SYNONYMS, noise=NOISE)


@query(f"""with {RULE_SQL} select nm.t "text", case when hits = 1 then 'matched' when hits > 1 then 'ambiguous' else 'unmatched' end status, case when hits = 1 then r.id end id, coalesce(hits, 0) hits
from nm left join best b on b.t = nm.t left join rules r on r.rule_no = b.rule_no""")
def j5_resolve_unique(spark, sf):
    return J.resolve_unique(parts(spark, sf), "p_name", _rules(spark))


@query(f"""with {RULE_SQL}, man as (select min(p_partkey)::varchar id, p_name t from part where p_size = 50 group by 2), u as (
 select t, 0 i, 'manual' stage, id from man union all select t, 1, 'rules', (select id from rules r where r.rule_no = best.rule_no) from best
 union all select p_name, 2, 'type', min(p_type) from part where p_type <> 'SMALL' group by 1),
b as (select t, stage, id from (select *, row_number() over (partition by t order by i, stage, id) k from u) where k = 1)
select nm.t "text", b.id, coalesce(stage, 'unmatched') stage from nm left join b using (t)""")
def j6_resolve_cascade(spark, sf):
    p = parts(spark, sf)
    manual = p.where("p_size = 50").groupBy("p_name").agg(F.min("p_partkey").alias("id"))
    rules = J.resolve_rules(p, "p_name", _rules(spark)).select(F.col("text").alias("p_name"), "id")
    kind = p.where("p_type <> 'SMALL'").groupBy("p_name").agg(F.min("p_type").alias("id"))
    return J.resolve_cascade(p, "p_name", [("manual", manual), ("rules", rules), ("type", kind)])


@query("""with i as (select distinct p_name || ' ' || lower(p_type) item, p_brand from part), d as (select p_name nm, p_brand, min(round(p_retailprice * 100.0 / p_size, 4)) u from part group by 1, 2 union all select p_name || ' pro', p_brand, 1.0 from part group by p_name, p_brand),
x as (select i.item, i.p_brand, length(i.item) - length(nm) extra, u, nm from i join d using (p_brand) where contains(lower(i.item), lower(nm)) and length(i.item) - length(nm) <= 20 and not (contains(i.item, 'economy') and not contains(nm, 'economy')))
select item, p_brand, nm as "name", extra from (select *, row_number() over (partition by item, p_brand order by extra, u, nm) k from x) where k = 1""")
def j7_match_contains(spark, sf):
    """Names inside listings of their brand; the word `economy` makes a listing another product; unit prices settle ties."""
    p = parts(spark, sf).where("p_size > 0")
    items = parts(spark, sf).select(F.concat_ws(" ", "p_name", F.lower("p_type")).alias("item"), "p_brand")
    names = p.select("p_name", "p_brand", F.round(F.col("p_retailprice") * 100.0 / F.col("p_size"), 4).alias("unit"))
    more = parts(spark, sf).select(F.concat("p_name", F.lit(" pro")).alias("p_name"), "p_brand", F.lit(1.0).alias("unit"))
    return J.match_contains(items, names.unionByName(more), "item", "p_name", "p_brand", price="unit", editions=["economy"])


@query(f"""with {OBS}, l as (select distinct item, d from obs where source = 'S0'), r as (select item, d, max(price) price from obs where source = 'S1' group by 1, 2)
select l.item, l.d, r.price as "asof" from l asof left join r on l.item = r.item and l.d >= r.d""", dates=["d"])
def j8_asof_join(spark, sf):
    o = obs(spark, sf)
    return J.asof_join(o.where("source = 'S0'").select("item", "d").distinct(), o.where("source = 'S1'").select("item", "d", "price"), "item", "d", "price")


@query(f"""with {OBS}, l as (select distinct item, d from obs where source = 'S0'), r as (select item, d, price from obs where source = 'S1')
select l.item, l.d, min(r.price) window_min from l left join r on l.item = r.item and r.d > l.d and r.d - l.d <= 90 group by 1, 2""", dates=["d"])
def j8_window_min(spark, sf):
    o = obs(spark, sf)
    return J.window_min_join(o.where("source = 'S0'").select("item", "d").distinct(), o.where("source = 'S1'"), "item", "d", "price", 90)


@query()
def j9_match_catalogues(spark, sf):
    """Three catalogues: parts as sold by three groups of suppliers. Greedy, so it is tested against plain Python."""
    sold = table(spark, sf, "lineitem").select("l_partkey", (F.col("l_suppkey") % 3).alias("shop")).distinct()
    p = parts(spark, sf).select("p_partkey", "p_name", "p_size", "p_brand")
    rows = sold.join(p, F.col("l_partkey") == F.col("p_partkey"))
    rows = rows.select(F.col("shop").cast("string").alias("shop"), "p_partkey", F.concat_ws(" ", "p_name", "p_size").alias("k1"), F.concat_ws("|", "p_name", "p_brand").alias("k2"), F.col("p_size").cast("long").alias("volume"))
    return J.match_catalogues(rows, "shop", "0", "k1", "k2", "volume", "p_partkey", 5)


FLAGS = {"red": ["red"], "blue": ["blue"]}


@query("""with n as (select distinct p_brand, p_name || ' ' || p_size t, p_name from part), l as (select distinct p_brand, lower(p_type) || ' ' || p_name || ' ' || (p_size + 10) || ' red' t from part),
x as (select n.p_brand, n.t a, l.t b from n join l using (p_brand) where contains(l.t, n.p_name)), num as (select *, list_filter(regexp_extract_all(a, '[0-9]+')::int[], lambda v: v between 40 and 129) na, list_filter(regexp_extract_all(b, '[0-9]+')::int[], lambda v: v between 40 and 129) nb from x),
g as (select p_brand, na = nb and contains(a, 'red') = contains(b, 'red') and contains(a, 'blue') = contains(b, 'blue') ok, len(list_filter(string_split(a, ' '), lambda w: not contains(b, w))) + len(list_filter(string_split(b, ' '), lambda w: not contains(a, w))) = 0 inside from num)
select p_brand, count(*) pairs, count(*) filter (ok) agreeing, count(*) filter (ok and inside) contained from g group by 1""")
def j10_guards(spark, sf):
    """Of the pairs that a containment match proposes within a brand, how many the guards let pass."""
    p = parts(spark, sf)
    names = p.select("p_brand", "p_name", F.concat_ws(" ", "p_name", "p_size").alias("a")).distinct()
    other = p.select("p_brand", F.concat_ws(" ", F.lower("p_type"), "p_name", F.col("p_size") + 10, F.lit("red")).alias("b")).distinct()
    near = J.containing(other, "b", names, "p_name", ["p_brand"]).withColumnRenamed("needle", "p_name").join(names, ["p_brand", "p_name"])
    ok, inside = J.guards_ok(F.col("a"), F.col("text"), FLAGS), J.guards_ok(F.col("a"), F.col("text"), FLAGS, contain=True)
    return near.groupBy("p_brand").agg(F.count("*").alias("pairs"), F.count_if(ok).alias("agreeing"), F.count_if(inside).alias("contained"))


@query("""with q as (select distinct p_name query from part), l as (select p_name || ' ' || lower(p_type) listing, round(p_retailprice)::bigint price, p_partkey % 50 product from part),
x as (select query, listing, price, product, len(list_distinct(string_split(listing, ' '))) - len(list_distinct(string_split(query, ' '))) extra from q join l on len(list_filter(string_split(query, ' '), lambda t: not list_contains(string_split(listing, ' '), t))) = 0),
r as (select *, row_number() over (partition by query order by extra, price, listing, product) k, count(*) over (partition by query) pool, count(*) over (partition by query, extra) tier from x),
s as (select product, count(*) siblings, max(price) sibling_high from l group by 1)
select query, listing, price, extra, case when extra = 0 then 'exact' else 'near' end "label", tier, pool, product, siblings, sibling_high from r join s using (product) where k = 1""")
def j11_match_tokens(spark, sf):
    p = parts(spark, sf)
    listings = p.select(F.concat_ws(" ", "p_name", F.lower("p_type")).alias("listing"), F.round("p_retailprice").cast("bigint").alias("price"), (F.col("p_partkey") % 50).alias("pid"))
    return J.match_tokens(p.select(F.col("p_name").alias("query")), listings, "query", "listing", "price", product="pid")


def misread(spark, sf):
    """(names, goods, aliases) of the fuzzy match: labels read with a letter lost, products of a brand, an age and an edition, and other spellings."""
    p = parts(spark, sf)
    goods = p.select(F.concat_ws(" ", "p_name", F.concat((F.col("p_size") % 3 * 6 + 6).cast("string"), F.lit("yo")), F.lower("p_type")).alias("canonical"), F.concat_ws("/", "p_name", F.col("p_size") % 3, "p_type").alias("id"), F.col("p_name").alias("brand"), F.lower("p_type").alias("edition"), "p_brand").distinct()
    kind = F.col("p_partkey") % 6
    read = F.when(kind == 0, F.regexp_replace("canonical", "e", "")).when(kind == 1, F.regexp_replace("canonical", " (standard|economy|medium|promo|large|small)$", "")).when(kind == 2, F.concat(F.left("p_name", F.lit(4)), F.lit(" 12yo"))).when(kind == 3, F.replace(F.col("canonical"), F.lit("i"), F.lit("1"))).when(kind == 4, F.concat(F.lit("the grand "), F.reverse("p_name"))).otherwise(F.replace(F.col("canonical"), F.lit("ring"), F.lit("rlng")))
    labels = p.select("p_partkey", "p_name", "p_brand", F.concat_ws(" ", "p_name", F.concat((F.col("p_size") % 3 * 6 + 6).cast("string"), F.lit("yo")), F.lower("p_type")).alias("canonical")).select("p_brand", read.alias("n"))
    aliases = goods.select("p_brand", F.concat(F.lit("the grand "), F.reverse("brand")).alias("alias"), "id").groupBy("p_brand", "alias").agg(F.min("id").alias("id"))
    return labels, goods, aliases


@query()
def j12_match_fuzzy(spark, sf):
    """Misread labels against the products of their brand block; the ratio has no SQL form, so a test holds it against plain Python."""
    labels, goods, aliases = misread(spark, sf)
    return J.match_fuzzy(labels, goods, "n", "canonical", "id", "brand", "edition", "p_brand", [("rlng", "ring")], aliases)


@query(f"""with {OBS}, b as (select unnest(['ring', 'bolt', 'gear']) token), i as (select distinct p_name item, w token from part, unnest(string_split(p_name, ' ')) u(w) where w in (select token from b)),
o as (select p_name, w token, price * 100.0 / (p_size * 100) unit from obs join part on p_partkey = item, unnest(string_split(p_name, ' ')) u(w) where w in (select token from b) and p_size * 100 >= 500)
select item, count(*) offers, round(min(unit), 4) low, round(quantile_cont(unit, 0.5), 4) median, round(max(unit), 4) high from i join o using (token) group by 1""")
def j13_brand_age(spark, sf):
    p = parts(spark, sf)
    offers = obs(spark, sf).join(p.select("p_partkey", "p_name", (F.col("p_size") * 100).alias("vol")), F.col("item") == F.col("p_partkey"))
    brands = spark.createDataFrame([("ring",), ("bolt",), ("gear",)], "token string")
    return J.match_brand_age(p.select("p_name"), offers.select("p_name", "price", "vol"), "p_name", "p_name", "price", "vol", brands)


PLACES = "pl as (select c_custkey k, c_name nm, 'N' || c_nationkey loc, 37.4 + (c_custkey % 1000) / 5000.0 lat, 126.9 + (c_custkey % 700) / 5000.0 lng from customer)"
HAV = "2 * 6371000.0 * asin(sqrt(least(pow(sin(radians({c} - {a}) / 2), 2) + cos(radians({a})) * cos(radians({c})) * pow(sin(radians({d} - {b}) / 2), 2), 1.0)))"


def _places(spark, sf):
    c = table(spark, sf, "customer")
    return c.select(F.col("c_custkey").alias("k"), F.col("c_name").alias("nm"), F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("loc"), (37.4 + (F.col("c_custkey") % 1000) / 5000.0).alias("lat"), (126.9 + (F.col("c_custkey") % 700) / 5000.0).alias("lng"))


@query(f"""with {PLACES}, reg as (select left(nm, length(nm) - 1) nm, case when k % 2 = 0 then loc else 'elsewhere' end loc, lat + case when k % 4 = 1 then 0.01 else 0.0005 end lat, lng from pl where k % 30 = 0 or k % 10 = 3 or k % 50 = 7),
n as (select *, regexp_replace(lower(nm), '[^\\p{{L}}\\p{{N}}]', '', 'g') x from pl), m as (select *, regexp_replace(lower(nm), '[^\\p{{L}}\\p{{N}}]', '', 'g') y from reg),
h as (select distinct k from n join m on left(x, 15) = left(y, 15) and (starts_with(x, y) or starts_with(y, x)) and (coalesce(n.loc = m.loc, true) or {HAV.format(a='n.lat', b='n.lng', c='m.lat', d='m.lng')} <= 150))
select k, nm, loc, lat, lng, k in (select k from h) registered from pl""")
def j14_match_registry(spark, sf):
    """Registry names lack the last digit, so ten places share each: told apart by locality or the radius, or not met at all."""
    p = _places(spark, sf)
    reg = p.where("k % 30 = 0 or k % 10 = 3 or k % 50 = 7").select(F.expr("left(nm, length(nm) - 1)").alias("nm"), F.when(F.col("k") % 2 == 0, F.col("loc")).otherwise("elsewhere").alias("loc"), (F.col("lat") + F.when(F.col("k") % 4 == 1, 0.01).otherwise(0.0005)).alias("lat"), "lng")
    return J.match_registry(p, reg, "nm", "loc", "lat", "lng", prefix=15)


@query(f"""with {PLACES}, c as (select n_name centre, 37.4 + n_nationkey / 125.0 clat, 126.9 + (n_nationkey % 7) / 50.0 clng from nation),
x as (select k, centre, {HAV.format(a='lat', b='lng', c='clat', d='clng')} m from pl, c where abs(lat - clat) < 0.02)
select k, centre, round(m, 3) metres, round(m / 67)::int walk_min from x where m <= 1000""")
def j15_within_radius(spark, sf):
    n = table(spark, sf, "nation")
    centres = n.select(F.col("n_name").alias("centre"), (37.4 + F.col("n_nationkey") / 125.0).alias("lat"), (126.9 + (F.col("n_nationkey") % 7) / 50.0).alias("lng"))
    return J.within_radius(_places(spark, sf), centres, 1000.0).select("k", "centre", F.round("metres", 3).alias("metres"), "walk_min")


@query("""with s as (select * from (values ('rings', 'ring', '^small.*ring$'), ('gears', 'gear', '^hot gear$'), ('none', 'zzz', '^zzz$')) t(l, part_, pat)), p as (select p_name, round(p_retailprice)::bigint price, p_size from part),
x as (select l, min(price) a from p join s on contains(p_name, part_) where p_size < 25 group by 1), y as (select l, min(price) b from p join s on regexp_matches(p_name, pat) where p_size >= 25 group by 1)
select l "label", a price_a, b price_b, b - a diff from x join y using (l)""")
def j16_compare_curated(spark, sf):
    p = parts(spark, sf).withColumn("price", F.round("p_retailprice").cast("bigint"))
    spec = spark.createDataFrame([("rings", "ring", "^small.*ring$"), ("gears", "gear", "^hot gear$"), ("none", "zzz", "^zzz$")], "label string, part string, pattern string")
    return J.compare_curated(p.where("p_size < 25"), p.where("p_size >= 25"), spec, "p_name", "p_name", "price")


@query("select p_type, array_to_string(list_sort(list(distinct p_brand)), '|') keys from part group by 1")
def j17_key_sets(spark, sf):
    return J.key_sets_by(parts(spark, sf), "p_type", "p_brand")


@query("""with d as (select p_name || '/' || p_brand k1, p_name k2, p_type v from part where p_size < 25), e as (select k1, min(v) v from d group by 1), l as (select k2, min(v) v from d group by 1 having count(distinct v) = 1)
select p_partkey, p_name || '/' || p_brand k1, p_name k2, coalesce(e.v, l.v) v, case when e.v is not null then 'exact' when l.v is not null then 'loose' end via from part left join e on e.k1 = p_name || '/' || p_brand left join l on l.k2 = p_name""")
def j18_lookup_unambiguous(spark, sf):
    p = parts(spark, sf).select("p_partkey", F.concat_ws("/", "p_name", "p_brand").alias("k1"), F.col("p_name").alias("k2"), F.col("p_type").alias("v"), "p_size")
    return J.lookup_unambiguous(p.select("p_partkey", "k1", "k2"), p.where("p_size < 25"), "k1", "k2", "v")


@query("""with e as (select user_id, epoch_us(ts) / 1000000.0 t, event_type, value from events), l as (select distinct user_id, t from e where event_type = 'purchase'), r as (select user_id, t rt, value from e where event_type = 'click'),
x as (select l.user_id, l.t, abs(rt - l.t) distance, value, row_number() over (partition by l.user_id, l.t order by abs(rt - l.t), rt, value) k from l left join r on l.user_id = r.user_id and abs(rt - l.t) <= 86400)
select user_id, t, value, distance from x where k = 1""")
def j19_nearest_join(spark, sf):
    e = table(spark, sf, "events").select("user_id", (F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000.0).alias("t"), "event_type", "value")
    return J.nearest_join(e.where("event_type = 'purchase'").select("user_id", "t").distinct(), e.where("event_type = 'click'"), "user_id", "t", "value", 86400.0)


@query()
def j20_suggest_canonical(spark, sf):
    """Names of small parts against those of the others of their brand; the ratio has no SQL form."""
    p = parts(spark, sf)
    return J.suggest_canonical(p.where("p_size < 10"), p.where("p_size >= 10"), "p_name", "p_name", "p_brand")


@query("select p_partkey, p_name, p_size from part")
def o1_sort(spark, sf):
    return O.sort_by(parts(spark, sf).select("p_partkey", "p_name", "p_size"), [("p_size", "desc", "last"), ("p_name", "asc", "last"), ("p_partkey", "asc", "last")])


@query("select p_brand, p_partkey, p_retailprice from (select *, row_number() over (partition by p_brand order by p_retailprice desc, p_partkey) k from part) where k <= 3")
def o2_top_k(spark, sf):
    return O.top_k(parts(spark, sf).select("p_brand", "p_partkey", "p_retailprice"), [F.col("p_retailprice").desc(), F.col("p_partkey")], 3, ["p_brand"])


@query("select * from (select p_partkey, p_retailprice, row_number() over (order by p_retailprice desc, p_partkey) \"rank\" from part) where \"rank\" <= 100")
def o3_rank(spark, sf):
    return O.with_rank(parts(spark, sf).select("p_partkey", "p_retailprice"), [F.col("p_retailprice").desc(), F.col("p_partkey")], 100)


@query(f"with {PAIR} select item, price, 'cur' tag from cur union all select item, price, 'prev' from prev where item not in (select item from cur)")
def o4_union_fill(spark, sf):
    a, b = pair(spark, sf)
    return O.union_fill(b.select("item", "price", F.lit("cur").alias("tag")), a.select("item", "price", F.lit("prev").alias("tag")), "item")


@query(f"with {PAIR}, s as (select case when p.item is null then 'new' when c.item is null then 'removed' else 'common' end side from prev p full join cur c on p.item = c.item) select side, count(*) n from s group by 1")
def o5_key_sets(spark, sf):
    return O.key_sets(*pair(spark, sf), "item").groupBy("side").agg(F.count("*").alias("n"))


@query("select l_orderkey, l_linenumber, l_partkey from (select *, row_number() over (partition by l_orderkey order by l_linenumber desc, l_partkey desc, l_suppkey desc, l_extendedprice desc) k from lineitem) where k = 1")
def o6_distinct_keep(spark, sf):
    line = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return O.distinct_keep(line, ["l_orderkey"], [F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_extendedprice")], "last").select("l_orderkey", "l_linenumber", "l_partkey")


def _moves(spark, sf):
    orders = table(spark, sf, "orders").withColumnRenamed("o_custkey", "account")
    ships = table(spark, sf, "lineitem").join(orders.select("o_orderkey", "account"), F.col("l_orderkey") == F.col("o_orderkey"))
    return (orders, "order", "o_orderdate", -F.round("o_totalprice").cast("bigint")), (ships, "ship", "l_shipdate", F.round(F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("bigint"))


@query("""select o_custkey account, 'order' "label", o_orderdate "at", -round(o_totalprice)::bigint amount from orders
union all select o_custkey, 'ship', l_shipdate, round(l_extendedprice * (1 - l_discount))::bigint from lineitem join orders on l_orderkey = o_orderkey""")
def o7_timeline(spark, sf):
    return O.timeline(*_moves(spark, sf), key="account")


@query("select c_custkey, c_name, c_mktsegment from customer")
def o8_publish_projection(spark, sf):
    return O.publish_projection(table(spark, sf, "customer"), ["acctbal", "nation"])


@query(f'with {MONTHLY} select "month", count(*) "rows" from monthly group by 1')
def s6_snapshots(spark, sf):
    return R.snapshots(monthly(spark, sf), "month")


@query(f"""with {MONTHLY} select "month", item, price, qty from monthly where "month" = (select max("month") from monthly where "month" < '1998-06')""")
def s6_latest_snapshot(spark, sf):
    return R.latest_snapshot(monthly(spark, sf), "month", "1998-06", strict=True)


@query("""with s as (select distinct ts::date d, case when user_id % 3 = 0 then null when hour(ts) < 12 then 'am' else 'pm' end slot from events where day(ts) % 2 = 0 or user_id % 3 = 0)
select d, slot from s where slot is not null or d not in (select d from s where slot is not null)""", dates=["d"])
def s7_slot_snapshots(spark, sf):
    e = table(spark, sf, "events").where("day(ts) % 2 = 0 or user_id % 3 = 0")
    slot = F.when(F.col("user_id") % 3 == 0, None).when(F.hour("ts") < 12, "am").otherwise("pm")
    return R.slot_snapshots(e.select(F.col("ts").cast("date").alias("d"), slot.alias("slot")), "d", "slot")


@query(f"""with {MONTHLY}, n as (select "month", count(*) n from monthly group by 1), l as (select max("month") latest, max_by(n, "month") ln from n)
select latest, coalesce((select max("month") from n where "month" < latest and n >= ln * 0.9), (select max("month") from n where "month" < latest)) baseline from l""")
def s8_pick_baseline(spark, sf):
    return R.pick_baseline(monthly(spark, sf), "month")


@query(f"""with {MONTHLY} select "month", item, price, qty from monthly where "month" = coalesce((select max("month") from monthly where "month" = '2099-01'), (select max("month") from monthly))""")
def s9_pick_month(spark, sf):
    return R.pick_month(monthly(spark, sf), "month", "2099-01")


@query(f"with {OBS}, k as (select distinct item, source from obs where d < date '1998-01-01'), b as (select distinct item, source from obs where d >= date '1998-01-01') select item, source from b except select item, source from k")
def s18_append_dedup(spark, sf):
    o = obs(spark, sf)
    return X.append_dedup(o.where("d < date'1998-01-01'").select("item", "source"), o.where("d >= date'1998-01-01'").select("item", "source"), ["item", "source"])


@query(f"with {PAIR} select item, price, qty from cur union all select item, price, qty from prev where item not in (select item from cur)")
def s19_upsert(spark, sf):
    a, b = pair(spark, sf)
    return X.upsert(a.select("item", "price", "qty"), b.select("item", "price", "qty"), ["item"])


@query(f"""with {PAIR}, e as (select distinct p_brand asset, p_partkey::varchar o from part), a as (select distinct item::varchar o from cur)
select asset, count(*) expected, count(a.o) present, count(*) filter (a.o is null) missing, min(e.o) filter (a.o is null) first_missing from e left join a using (o) group by 1""")
def s21_run_manifest(spark, sf):
    p = parts(spark, sf).select(F.col("p_brand").alias("asset"), F.col("p_partkey").cast("string").alias("o"))
    return X.run_manifest(p, pair(spark, sf)[1].select(F.col("item").cast("string").alias("o")), "asset", "o")


@query(f"with {PAIR} select p_brand asset, p_partkey::varchar o from part where p_partkey not in (select item from cur)")
def s21_missing_outputs(spark, sf):
    p = parts(spark, sf).select(F.col("p_brand").alias("asset"), F.col("p_partkey").cast("string").alias("o"))
    return X.missing_outputs(p, pair(spark, sf)[1].select(F.col("item").cast("string").alias("o")), "asset", "o")


@query("select o_orderkey, o_custkey from orders where o_orderkey not in (select l_orderkey from lineitem where l_returnflag = 'R')")
def s22_unprocessed(spark, sf):
    done = table(spark, sf, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return X.unprocessed(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), done, "o_orderkey")


@query("""with h as (select p_partkey, p_name, p_size, round(p_retailprice * 10)::bigint v from part)
select p_partkey, trim(regexp_replace(p_name, '\\s+', ' ', 'g')) || ' ' || case p_size % 4 when 0 then 'sale: ' || v || ' won' when 1 then 'price ' || v when 2 then 'ask us' else 'sale: ' || v || ' won price ' || v + 1 end "text",
 case when p_size % 4 <> 2 and v between 9500 and 15000 then v::double end price from h""")
def s13_article_price(spark, sf):
    """A page's text without tags, and its price by the first of two patterns that is met, if it is a sane one."""
    v = F.round(F.col("p_retailprice") * 10).cast("bigint")
    said = F.when(F.col("p_size") % 4 == 0, F.concat(F.lit("sale: "), v, F.lit(" won"))).when(F.col("p_size") % 4 == 1, F.concat(F.lit("price "), v)).when(F.col("p_size") % 4 == 2, "ask us").otherwise(F.concat(F.lit("sale: "), v, F.lit(" won</b><i>price "), v + 1))
    page = F.concat(F.lit("<html><script>var price = 'price 10000';</script><style>p {}</style><h1>"), "p_name", F.lit("</h1>\n<p><b>"), said, F.lit("</b></p></html>"))
    p = parts(spark, sf).select("p_partkey", R.strip_tags(page).alias("text"))
    return p.withColumn("price", R.extract_first("text", ["sale: ([0-9,]+)", "price ([0-9,]+)"], 9500, 15000))


@query("""select url, regexp_extract(html, '<title>([^<]*)</title>', 1) title, len(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>')) links from pages""")
def s13_titles(spark, sf):
    p = table(spark, sf, "pages")
    return p.select("url", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), F.size(F.regexp_extract_all("html", F.lit('<a href="([^"]*)">([^<]*)</a>'), 1)).alias("links"))


@query("""with m as (select page_id, regexp_extract_all(html, '<a href="/([^"]*)">([^<]*)</a>', 1) a, regexp_extract_all(html, '<a href="/([^"]*)">([^<]*)</a>', 2) b from pages)
select page_id, unnest(range(len(a)))::int "at", unnest(a) "name", unnest(b) price from m""")
def s14_extract_pairs(spark, sf):
    return R.extract_pairs(table(spark, sf, "pages"), "html", '<a href="/([^"]*)">([^<]*)</a>', ["page_id"])


@query("""with c as (select page_id, string_split(html, '<li>') s from pages), u as (select page_id, unnest(range(len(s)))::int card, unnest(s) h from c)
select page_id, card, nullif(regexp_extract(h, 'href="([^"]*)"', 1), '') href, nullif(regexp_extract(h, '>([^<]+)</a>', 1), '') label from u where card > 0""")
def s12_html_cards(spark, sf):
    return R.extract_html_cards(table(spark, sf, "pages"), "html", "<li>", {"href": 'href="([^"]*)"', "label": ">([^<]+)</a>"}, ["page_id"])


@query("""with x as (select p_partkey, (row_number() over (partition by p_brand order by p_partkey))::int card, p_brand, p_name, round(p_retailprice)::bigint sale, case when p_size % 3 <> 0 then round(p_retailprice)::bigint + p_size * 10 end listed from part)
select p_brand, card, p_name "name", sale, coalesce(listed, sale) listed, round((1 - sale / coalesce(listed, sale)) * 100)::int discount_pct from x""")
def s12_card_prices(spark, sf):
    """A page of cards for each brand, some without a list price; discounts are derived."""
    price = F.round("p_retailprice").cast("bigint")
    listed = F.when(F.col("p_size") % 3 != 0, F.concat(F.lit('<s class="list">'), F.format_number(price + F.col("p_size") * 10, 0), F.lit("</s>"))).otherwise("")
    card = F.concat(F.lit('<div class="card"><b>'), "p_name", F.lit("</b>"), listed, F.lit('<em class="sale">'), F.format_number(price, 0), F.lit(" won</em></div>"))
    pages = parts(spark, sf).groupBy("p_brand").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", card.alias("c")))), lambda x: x["c"]), "\n").alias("html"))
    cards = R.extract_html_cards(pages, "html", '<div class="card">', {"name": "<b>([^<]*)</b>", "sale": 'class="sale">([^<]*)<', "listed": 'class="list">([^<]*)<'}, ["p_brand"])
    return R.with_discount(cards, "sale", "listed")


@query("""with l as (select l_orderkey, l_partkey % 5 id, round(l_extendedprice)::bigint p, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice) n from lineitem)
select l_orderkey, id, p from (select *, row_number() over (partition by l_orderkey, id order by n desc) k from l) where k = 1""")
def s10_json_objects(spark, sf):
    """Offers nested in other objects, with objects in them and braces in their texts; of an id that repeats the last counts."""
    offer = F.struct((F.col("l_partkey") % 5).alias("id"), F.round("l_extendedprice").cast("bigint").alias("p"), F.struct(F.lit("a}b{").alias("name"), F.struct(F.lit(1).alias("id")).alias("inner")).alias("seller"))
    line = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", offer.alias("o")))).alias("v"))
    doc = F.to_json(F.struct(F.lit(3).alias("id"), F.struct(F.struct(F.transform("v", lambda x: x["o"]).alias("offers")).alias("list")).alias("state")))
    return R.extract_json_objects(line.select("l_orderkey", doc.alias("doc")), "doc", {"id": "bigint", "p": "bigint"}, "id", ["l_orderkey"])


@query("""with o as (select l_orderkey, l_quantity::bigint grams, round(l_extendedprice)::bigint price from lineitem), r as (select *, row_number() over (partition by l_orderkey order by case when grams between 20 and 30 then 0 else 1 end, price, grams) k from o)
select l_orderkey, price, grams from r where k = 1""")
def s11_pick_variant(spark, sf):
    line = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct(F.col("l_quantity").cast("bigint").alias("grams"), F.round("l_extendedprice").cast("bigint").alias("price"))).alias("v"))
    return R.pick_variant(line, "l_orderkey", "v", 20, 30)


@query("""select l_orderkey k, 'line' family, '1998-06' "month", l_partkey item from lineitem union all select o_orderkey, 'order', '1998-07', null from orders""")
def s2_union_sources(spark, sf):
    line = lambda df: df.select(F.col("l_orderkey").alias("k"), F.col("l_partkey").alias("item"))
    order = lambda df: df.select(F.col("o_orderkey").alias("k"))
    return R.union_sources([("line", table(spark, sf, "lineitem"), line, "1998-06"), ("order", table(spark, sf, "orders"), order, "1998-07")])


@query("select p_name \"name\", p_retailprice price, null::varchar colour from part")
def s4_map_columns(spark, sf):
    return R.map_columns(parts(spark, sf), {"name": ["NAME"], "price": ["retailprice"], "colour": ["colour", "color"]})


@query("""with x as (select conv_id, turn, case when turn % 2 = 0 then role else text end || case conv_id % 8 when 0 then ' 있으니' when 1 then ' 토닉 소다' when 2 then '.' when 3 then '. and so' when 4 then ' 20% 할인 중' when 5 then ' 좋네요' when 6 then repeat(' long', 6) else '' end || case when turn % 3 = 0 then '  ' else '' end t from conversations),
s as (select *, trim(t) s from x)
select conv_id, turn, s = '' or length(s) > 35 or contains(s, '. ') or s like '%.' or s like '%니다' or s like '%네요' or s like '%으니' or s like '%니까' or s like '%세요' or contains(s, '할인') or contains(s, '있으니') garbage from s""")
def f3_garbage(spark, sf):
    """Turns and their speakers, some with what speech ends in or names never hold; `소다` (soda) is a name."""
    kind = F.col("conv_id") % 8
    tail = F.when(kind == 0, " 있으니").when(kind == 1, " 토닉 소다").when(kind == 2, ".").when(kind == 3, ". and so").when(kind == 4, " 20% 할인 중").when(kind == 5, " 좋네요").when(kind == 6, " long long long long long long").otherwise("")
    name = F.concat(F.when(F.col("turn") % 2 == 0, F.col("role")).otherwise(F.col("text")), tail, F.when(F.col("turn") % 3 == 0, "  ").otherwise(""))
    return table(spark, sf, "conversations").select("conv_id", "turn", T.garbage(name).alias("garbage"))
