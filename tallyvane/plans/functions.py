"""Queries of the scalar functions and the quality gates."""

from pyspark.sql import functions as F

from tallyvane.functions import classify as C
from tallyvane.functions import text as T
from tallyvane.functions import values as V
from tallyvane.operators import gates as G
from tallyvane.operators import joins as J
from tallyvane.plans.base import OBS, PAIR, obs, pair, query, table


def _label(spark, sf):
    """Part labels like `small ring 11 ml 12yo`, so that volumes and ages can be read back."""
    p = table(spark, sf, "part")
    return p.select("p_partkey", "p_name", "p_type", "p_brand", "p_size", F.concat(F.col("p_name"), F.lit(" "), F.col("p_size") * 25, F.lit("ml "), F.col("p_size"), F.lit("yo (No."), F.col("p_partkey"), F.lit(")")).alias("label"))


LABEL = "lab as (select p_partkey, p_name, p_type, p_brand, p_size, p_name || ' ' || (p_size * 25) || 'ml ' || p_size || 'yo (No.' || p_partkey || ')' lbl from part)"


@query(f"with {LABEL} select p_partkey, nullif(p_partkey, 0) number, nullif(regexp_replace(p_brand, '[^0-9]', '', 'g')::bigint, 0) brand_no from lab")
def c1_to_num(spark, sf):
    x = _label(spark, sf)
    return x.select("p_partkey", T.to_num(F.concat(F.lit("₩ "), F.format_number("p_partkey", 0), F.lit(" won"))).alias("number"), T.to_num("p_brand").alias("brand_no"))


@query(f"with {LABEL} select p_partkey, (p_size * 25)::int first_ml, (p_size * 25)::int last_ml, 700 default_ml, (p_size * 10)::int tail_ml from lab")
def c2_volume(spark, sf):
    return _label(spark, sf).select("p_partkey", T.volume_ml("label").alias("first_ml"), T.volume_ml("label", last=True).alias("last_ml"), T.volume_ml("p_name", 700).alias("default_ml"), T.volume_ml(F.concat("p_name", F.lit(" "), F.col("p_size") * 10, F.lit("m")), tail=True).alias("tail_ml"))


@query(f"with {LABEL} select p_partkey, p_size age, case when p_size between 3 and 80 then p_size end oldest from lab")
def c3_age(spark, sf):
    return _label(spark, sf).select("p_partkey", T.age("label").alias("age"), T.age("label", "max").alias("oldest"))


@query("select p_partkey, regexp_replace(lower(p_name || '-' || p_brand), '[^\\p{L}\\p{N}]', '', 'g') key from part")
def c4_norm_key(spark, sf):
    return table(spark, sf, "part").select("p_partkey", T.norm_key(F.concat_ws("-", "p_name", "p_brand")).alias("key"))


@query("select p_partkey, replace(replace(p_name, 'red', 'crimson'), 'crimson w', 'scarlet w') name from part")
def c5_rewrite(spark, sf):
    return table(spark, sf, "part").select("p_partkey", T.rewrite("p_name", [("red", "crimson"), ("crimson w", "scarlet w")]).alias("name"))


@query("select p_partkey, case regexp_replace(regexp_replace(p_name, '^(small|big) ', ''), 's?ing$', 'ing') when 'ring' then 'circle' else regexp_replace(regexp_replace(p_name, '^(small|big) ', ''), 's?ing$', 'ing') end key from part")
def c6_rewrite_rx(spark, sf):
    return table(spark, sf, "part").select("p_partkey", T.alias(T.rewrite_rx("p_name", [("^(small|big) ", ""), ("s?ing$", "ing")]), {"ring": "circle"}).alias("key"))


@query("select p_partkey, case when contains(p_name, 'ring') then 'ring' when contains(p_name, 'gear') then 'gear' else p_name end || case when p_type = case when contains(p_name, 'ring') then 'ring' when contains(p_name, 'gear') then 'gear' else p_name end then '' else ' / ' || p_type end lbl from part")
def c7_canonical_label(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey", T.canonical_label(F.concat(F.col("p_name"), F.lit(" / "), F.col("p_type"), F.lit("/"), F.col("p_name")), ["ring", "gear"]).alias("lbl"))


@query("select p_partkey, case when regexp_matches(p_name, 'red|blue') then 'colour' when regexp_matches(p_name, 'small|big') then 'size' else 'other' end kind from part")
def c8_classify_first(spark, sf):
    return table(spark, sf, "part").select("p_partkey", C.classify_first("p_name", [("colour", ["red", "blue"]), ("size", ["small", "big"])], "other").alias("kind"))


@query("""with w as (select p_partkey, p_name, string_split(p_name, ' ') l from part) select p_partkey, case when contains(p_name, 'red') and contains(p_name, 'ring') then 'red ring' when contains(p_name, 'red') then 'colour' when contains(p_name, 'ring') then 'shape' else 'other' end kind,
 array_to_string(list_filter(l, lambda x: contains(x, 'red') or contains(x, 'ring')), ',') hits, array_to_string(list_filter(l, lambda x: not (contains(x, 'red') or contains(x, 'ring'))), ',') rest from w""")
def c9_classify_precedence(spark, sf):
    c = C.classify_precedence(F.split("p_name", " "), [("colour", ["red"]), ("shape", ["ring"])], {("colour", "shape"): "red ring"})
    return table(spark, sf, "part").select("p_partkey", c["label"].alias("kind"), F.array_join(c["hits"], ",").alias("hits"), F.array_join(c["unmatched"], ",").alias("rest"))


@query("""with m as (select p_partkey, replace(p_name, 'red widget', ' ') t from part) select p_partkey, case when regexp_matches(t, 'red|ring') then 'first' when contains(t, 'gear') then 'second' end tier,
case when regexp_matches(t, 'red|ring') then concat_ws('; ', case when contains(t, 'red') then 'red' end, case when contains(t, 'ring') then 'ring' end) when contains(t, 'gear') then 'gear' end reason from m""")
def c10_classify_tiers(spark, sf):
    c = C.classify_tiers("p_name", [("first", ["red", "ring"]), ("second", ["gear"])], ["red widget"])
    return table(spark, sf, "part").select("p_partkey", c["tier"].alias("tier"), c["reason"].alias("reason"))


@query("""select p_partkey, case when contains(p_name, 'hot') then 'excluded' when contains(p_name, 'red ring') then 'explicit' when contains(p_name, 'red') then 'strong' when contains(p_name, 'ring') and not contains(p_name, 'small') then 'weak' else 'none' end signal from part""")
def c11_classify_signal(spark, sf):
    return table(spark, sf, "part").select("p_partkey", C.classify_signal("p_name", ["red ring"], ["red"], ["ring"], ["small"], ["hot"]).alias("signal"))


@query("""select p_partkey, case when contains(lower(p_type), 'economy') then 3 when contains(lower(p_type), 'small') then 1 end "rank", case when contains(lower(p_type), 'economy') then 'plain' when contains(lower(p_type), 'small') then 'little' end lbl from part""")
def c12_ladder_rank(spark, sf):
    c = C.ladder_rank("p_type", {"small": (1, "little"), "economy": (3, "plain")})
    return table(spark, sf, "part").select("p_partkey", c["rank"].alias("rank"), c["label"].alias("lbl"))


@query("select p_partkey, case when p_size between 40 and 129 then p_size::varchar else '' end numbers, concat_ws(',', case when contains(p_name, 'blue') then 'blue' end, case when contains(p_name, 'red') then 'red' end) marks from part")
def c13_sets(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey", F.array_join(T.model_numbers(F.concat_ws(" ", "p_name", "p_size")).cast("array<string>"), ",").alias("numbers"), F.array_join(T.descriptor_set("p_name", {"red": ["red"], "blue": ["blue"]}), ",").alias("marks"))


@query("""with t as (select p_partkey, list_filter(string_split(p_name, ' '), lambda x: x <> 'red') l from part), m as (select *, list_max(list_transform(l, lambda x: length(x))) n from t) select p_partkey, list_filter(l, lambda x: length(x) = n)[1] tok from m""")
def c14_signature_token(spark, sf):
    return table(spark, sf, "part").select("p_partkey", T.signature_token("p_name", ["red"]).alias("tok"))


@query("select event_id, ts::date a, ts::date b from events", dates=["a", "b"])
def c15_date_from_text(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", V.date_from_text(F.concat(F.lit("seen "), F.date_format("ts", "yyyy.M.d"), F.lit(" at noon"))).alias("a"), V.last_date_in_name(F.concat(F.lit("x__run2019-01-05_"), F.date_format("ts", "yyyy-MM-dd"))).alias("b"))


@query("select c_custkey, case c_custkey % 4 when 0 then 'N' || c_nationkey when 1 then 'N' || c_nationkey || '점' when 2 then 'N' || c_nationkey || ' branch' end branch, c_mktsegment || '점' named from customer")
def c16_branch(spark, sf):
    """A branch in brackets, as a word of the title, only in the body, or nowhere; and one that only the description names."""
    c, key = table(spark, sf, "customer"), F.concat(F.lit("N"), F.col("c_nationkey"))
    kind = F.col("c_custkey") % 4
    title = F.when(kind == 0, F.concat(F.lit("shop (sale) ("), key, F.lit(")"))).when(kind == 1, F.concat(F.lit("shop "), key, F.lit("점 open"))).otherwise("shop")
    body = F.when(kind == 2, F.concat(F.lit("come to "), key, F.lit(" branch now"))).otherwise("come and see")
    return c.select("c_custkey", T.branch_from_text(title, body, ["sale"]).alias("branch"), T.branch_from_text(F.lit("what's new"), F.concat(F.lit("in "), "c_mktsegment", F.lit("점")), []).alias("named"))


@query(f"with {OBS} select item, d, source, price, case when p_size > 0 then round(price * 100.0 / p_size, 4) end unit from obs join part on p_partkey = item", dates=["d"])
def c17_unit_price(spark, sf):
    o = obs(spark, sf).join(table(spark, sf, "part").select("p_partkey", "p_size"), F.col("item") == F.col("p_partkey"))
    return o.select("item", "d", "source", "price", F.round(V.unit_price("price", "p_size"), 4).alias("unit"))


FX = {"A": 1.0, "F": 1350.5, "R": 9.25}


@query("select l_orderkey, l_linenumber, l_returnflag, round(round(l_extendedprice)::bigint * case l_returnflag when 'A' then 1.0::double when 'F' then 1350.5::double when 'R' then 9.25::double end, 2) converted from lineitem")
def c18_convert(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", F.round(V.convert(F.round("l_extendedprice").cast("bigint"), "l_returnflag", FX), 2).alias("converted"))


FX_SQL = """fx as (select o_orderdate::date d, unnest(['A', 'F', 'N']) c, unnest([1.0 + (o_custkey % 7) / 100.0, 1350.5 + o_custkey % 50, 9.25]) r from orders where o_orderkey in (select min(o_orderkey) from orders where day(o_orderdate) in (1, 2, 11, 21) group by o_orderdate::date)),
cr as (select d, c, t.r / fx.r r from fx join (select d, r from fx where c = 'F') t using (d))"""


def _fx(spark, sf):
    """Rates for one unit of some third currency, on four days a month."""
    o = table(spark, sf, "orders").withColumn("d", F.col("o_orderdate").cast("date")).where(F.dayofmonth("d").isin(1, 2, 11, 21))
    one = o.groupBy("d").agg(F.min(F.struct("o_orderkey", "o_custkey")).alias("o"))
    both = one.select(F.col("d").alias("date"), F.explode(F.create_map(F.lit("A"), 1.0 + F.col("o.o_custkey") % 7 / 100.0, F.lit("F"), 1350.5 + F.col("o.o_custkey") % 50, F.lit("N"), F.lit(9.25))).alias("currency", "rate"))
    # Every currency is told twice a day; the greater rate counts.
    return both.unionByName(both.withColumn("rate", F.col("rate") * 0.9))


@query(f"with {FX_SQL} select d, c currency, round(r, 6) rate from cr", dates=["d"])
def c18_cross_rates(spark, sf):
    return J.cross_rates(_fx(spark, sf), "F").select(F.col("date").alias("d"), "currency", F.round("rate", 6).alias("rate"))


@query(f"""with {FX_SQL}, l as (select l_orderkey, l_linenumber, l_partkey, l_suppkey, case when l_tax > 0.07 then 'X' else l_returnflag end c, l_shipdate::date d, round(l_extendedprice)::bigint a from lineitem),
k as (select distinct c, d from l), j as (select k.c, k.d, cr.d rd, cr.r from k asof left join cr on k.c = cr.c and k.d >= cr.d), f as (select c, min(d) fd, min_by(r, d) fr from cr group by 1)
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l.c currency, l.d, round(case when l.c = 'F' then a else a * coalesce(j.r, fr) end, 2) converted, case when l.c <> 'F' then coalesce(rd, fd) end rate_date,
 case when l.c = 'F' then null when fd is null then 'no rate' when rd is null then 'no rate yet' when l.d - rd > 7 then 'stale' end warning from l join j on l.c = j.c and l.d = j.d left join f on f.c = l.c""", dates=["d", "rate_date"])
def c18_convert_asof(spark, sf):
    """Amounts by the last rate at or before their day, with a warning where that is old or had to come from later."""
    line = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.when(F.col("l_tax") > 0.07, "X").otherwise(F.col("l_returnflag")).alias("currency"), F.col("l_shipdate").cast("date").alias("d"), F.round("l_extendedprice").cast("bigint").alias("a"))
    out = J.convert_asof(line, J.cross_rates(_fx(spark, sf), "F"), "a", "currency", "d", "F", 7)
    return out.drop("a").withColumn("converted", F.round("converted", 2))


@query("""with c as (select p_partkey, round(p_retailprice)::bigint b from part), d as (select *, b * 0.2::double x from c), l as (select *, (b + x) * 0.72::double y from d), e as (select *, y * 0.3::double z from l), v as (select *, (b + x + y + z) * 0.1::double w from e)
select p_partkey, round(x, 2) customs, round(y, 2) liquor, round(b + x + y + z + w, 2) landed, round((b + x + y + z + w) / nullif(b, 0), 4) multiplier from v""")
def c19_landed_cost(spark, sf):
    c = V.landed_cost(F.round("p_retailprice").cast("bigint"))
    return table(spark, sf, "part").select("p_partkey", *(F.round(c[k], 4 if k == "multiplier" else 2).alias(k) for k in ("customs", "liquor", "landed", "multiplier")))


@query("""select p_partkey, case when p_size < 10 then 'a' when p_size < 30 then 'b' else 'c' end lft, case when p_size <= 10 then 'a' when p_size <= 30 then 'b' else 'c' end rgt, case when p_size < 10 then 'a' when p_size <= 30 then 'b' else 'c' end mixed from part""")
def c20_bands(spark, sf):
    return table(spark, sf, "part").select("p_partkey", *(V.band("p_size", [10, 30], ["a", "b", "c"], c).alias(n) for c, n in (("left", "lft"), ("right", "rgt"), ("mixed", "mixed"))))


@query("select o_orderkey, date_trunc('week', o_orderdate)::date monday, (date_trunc('week', o_orderdate) + interval 6 day)::date sunday, (weekofyear(o_orderdate) % 4)::int rota, strftime(o_orderdate, '%Y-%m') \"month\", (o_orderdate::date + interval 1 month)::date later from orders", dates=["monday", "sunday", "later"])
def c21_calendar(spark, sf):
    b = V.iso_week_bounds("o_orderdate")
    return table(spark, sf, "orders").select("o_orderkey", b["monday"].alias("monday"), b["sunday"].alias("sunday"), V.iso_week_mod("o_orderdate").alias("rota"), V.month_key("o_orderdate").alias("month"), V.add_months_clamped(F.col("o_orderdate").cast("date"), 1).alias("later"))


@query("""select c_custkey, 'Seoul ' || 'G' || c_nationkey || '구' region, 'G' || c_nationkey || '구' locality, round(2 * 6371000.0 * asin(sqrt(least(pow(sin(radians(37.5 - (37.4 + c_custkey % 1000 / 5000.0)) / 2), 2) + cos(radians(37.4 + c_custkey % 1000 / 5000.0)) * cos(radians(37.5)) * pow(sin(radians(127.0 - 126.9) / 2), 2), 1.0))), 3) metres from customer""")
def c22_geo(spark, sf):
    c = table(spark, sf, "customer").withColumn("addr", F.concat(F.lit("Seoul G"), F.col("c_nationkey"), F.lit("구 Main street 5")))
    return c.select("c_custkey", V.region_of("addr").alias("region"), V.locality("addr").alias("locality"), F.round(V.haversine_m(37.4 + F.col("c_custkey") % 1000 / 5000.0, F.lit(126.9), F.lit(37.5), F.lit(127.0)), 3).alias("metres"))


@query("""with p as (select *, round(p_retailprice)::bigint v from part) select p_partkey, case p_size % 5 when 2 then round(v / 2, 2) when 1 then round(v * 200.0 / 150, 2) when 3 then v + 500.0 when 4 then v::double else v::double end cost from p""")
def c23_per_person(spark, sf):
    p = table(spark, sf, "part")
    kind, v = F.col("p_size") % 5, F.round("p_retailprice").cast("bigint")
    name = F.when(kind == 2, F.concat("p_name", F.lit(" set 2인"))).when(kind == 1, F.concat("p_name", F.lit(" 150g"))).when(kind == 4, F.concat("p_name", F.lit(" 2인 이상 주문"))).otherwise(F.col("p_name"))
    price = F.when(kind == 3, F.concat_ws("~", F.format_number(v, 0), F.format_number(v + 1000, 0))).otherwise(v.cast("string"))
    return p.select("p_partkey", F.round(T.per_person_price(name, price, F.lit(200)), 2).alias("cost"))


@query("""select p_partkey, replace(replace(p_name, 'widget', ''), '  ', ' ') is not null ok, trim(replace(p_name, 'widget', '')) name, case when p_size > 25 then '+' when p_size < 25 then '-' else '' end || abs(p_size - 25) delta,
 case when p_size >= 10 then case when p_size % 10 = 0 then (p_size // 10)::varchar else (p_size / 10.0)::decimal(9, 1)::varchar end || '만' else format('{:,}', p_size * 1000) end won from part""")
def c24_clean_display(spark, sf):
    p = table(spark, sf, "part")
    name = T.clean_display(F.concat(F.col("p_name"), F.lit(" 700ml")), ["widget"])
    return p.select("p_partkey", name.isNotNull().alias("ok"), name.alias("name"), T.format_signed(F.col("p_size") - 25).alias("delta"), T.format_manwon(F.col("p_size") * 1000).alias("won"))


@query("""with g as (select doc_id, case when lang is null then 'no language' when n_chars < 200 then 'short' when contains(text, '@') then 'contact' end reason from documents) select doc_id, reason, case when reason is null then 'ok' else 'rejected' end status from g""")
def f1_gates(spark, sf):
    d = table(spark, sf, "documents")
    return G.apply_gates(d, [(F.col("lang").isNull(), "no language"), (F.col("n_chars") < 200, "short"), (F.contains("text", F.lit("@")), "contact")]).select("doc_id", "reason", "status")


@query("select count(*) filter (n_chars >= 200) accepted, count(*) filter (n_chars < 200) quarantined from documents")
def f2_split_quarantine(spark, sf):
    ok, bad = G.split_quarantine(G.apply_gates(table(spark, sf, "documents"), [(F.col("n_chars") < 200, "short")]))
    return ok.agg(F.count("*").alias("accepted")).crossJoin(F.broadcast(bad.agg(F.count("*").alias("quarantined"))))


@query(f"with {OBS} select item, source, d, price, coalesce(price >= 15000, false) sane, coalesce(price between 15000 and 60000, false) banded from obs", dates=["d"])
def f4_sane_price(spark, sf):
    return obs(spark, sf).withColumn("sane", G.is_sane("price")).withColumn("banded", G.is_sane("price", 15000, 60000))


# Name endings, and whether they mark a collectible: 1.75 litres are sold everywhere, two aren't.
RARE = [(" vintage", True), (" 1.75L", False), (" 2 L", True), (" collector", True), (" 10th Anniversary", True), (" 리미티드", True), (" #7", True), (" 1990s", True), (" 100 proof 12yo", False), (" 1L", False), (" Cask No. 4", True), (" 2018 release", False), (" 1985s", False), (" 2 100 s", False), (" Single  Cask", True), ("", False)]
# Name endings, and whether they mark a bundle; the last ones only look like it.
BUNDLES = [(" 전용잔", True), (" 메가 잔", True), (" 두 개입", True), (" 증정", True), (" 잔 세트", True), (" 미니어쳐세트", True), (" 선물  세트", True), (" 12+", False), (" a + b", False), (" box 2", False), (" gifted oak", False), (" 세트", False), ("", False)]


@query(f"select p_partkey, [{', '.join(str(x).lower() for _, x in BUNDLES)}][p_partkey % {len(BUNDLES)} + 1] bundle, [{', '.join(str(x).lower() for _, x in RARE)}][p_size % {len(RARE)} + 1] collectible from part")
def f5_f6_predicates(spark, sf):
    p = table(spark, sf, "part")
    label = F.concat(F.col("p_name"), F.get(F.array(*(F.lit(s) for s, _ in BUNDLES)), (F.col("p_partkey") % len(BUNDLES)).cast("int")), F.get(F.array(*(F.lit(s) for s, _ in RARE)), F.col("p_size") % len(RARE)))
    return p.select("p_partkey", G.is_bundle(label).alias("bundle"), G.is_collectible(label).alias("collectible"))


@query(f"with {LABEL} select p_partkey, p_size * 25 < 500 small, p_size * 25 between 350 and 1000 windowed from lab")
def f7_f8_volume(spark, sf):
    x = _label(spark, sf)
    return x.select("p_partkey", G.is_undersized(F.lit(None).cast("int"), "label").alias("small"), G.in_volume_window(T.volume_ml("label"), 350, 1000).alias("windowed"))


@query("""select o_orderkey, o_orderdate::date > date '2000-06-30' future, case when (2000 * 12 + 6) - (year(o_orderdate) * 12 + month(o_orderdate)) >= 2 then 'stale' end reason, date '2000-06-30' - o_orderdate::date age_days, coalesce(date '2000-06-30' - o_orderdate::date <= 60, false) fresh from orders""")
def f9_f10_dates(spark, sf):
    o = table(spark, sf, "orders").withColumn("day", F.date_format("o_orderdate", "yyyy-MM-dd"))
    return G.freshness(o.withColumn("future", G.is_future("day", "2000-06-30")).withColumn("reason", G.resolve_collected_date("day", "2000-06-30")["reason"]), "day", "2000-06-30", 60).select("o_orderkey", "future", "reason", "age_days", "fresh")


@query(f"with {OBS}, r as (select p_partkey item, round(p_retailprice)::bigint * 5 lo, round(p_retailprice)::bigint * 12 hi from part) select item, source, d, price, case when price < lo * 0.35 then 'below reference' when price > hi * 3.0 then 'above reference' end price_reason from obs left join r using (item)", dates=["d"])
def f11_plausible(spark, sf):
    ref = F.round("p_retailprice").cast("bigint")
    dim = table(spark, sf, "part").select(F.col("p_partkey").alias("item"), (ref * 5).alias("lo"), (ref * 12).alias("hi"))
    return G.plausible(obs(spark, sf), dim, "item", "price", "lo", "hi").select("item", "source", "d", "price", "price_reason")


@query(f"with {OBS}, m as (select item, avg(price) a from obs where d < date '1998-01-01' group by 1) select item, source, d, price, coalesce(price < a * (1.0::double / 3.0::double) or price > a * 3.0, false) outlier from obs left join m using (item)", dates=["d"])
def f12_outliers(spark, sf):
    return G.flag_outliers(obs(spark, sf), "item", "price", F.col("d") < F.lit("1998-01-01").cast("date"))


@query(f"""with {OBS}, h as (select item, min(price) lo, max(price) hi, avg(price) mean, max_by(price, d) cur from (select item, d, min(price) price from obs group by 1, 2) group by 1) select item, hi <= lo * 3.0 and cur between mean / 3.0 and mean * 3.0 ok, greatest(lo, cur) < greatest(least(lo, cur), 1) * 2.5 near from h""")
def f13_f14_ratios(spark, sf):
    day = obs(spark, sf).groupBy("item", "d").agg(F.min("price").alias("price"))
    h = day.groupBy("item").agg(F.min("price").alias("lo"), F.max("price").alias("hi"), F.avg("price").alias("mean"), F.max_by("price", "d").alias("cur"))
    return h.select("item", G.range_ratio_ok("lo", "hi", "cur", "mean").alias("ok"), G.divergence_ok("lo", "cur").alias("near"))


@query(f"""with {PAIR}, j as (select p.item, p.price, coalesce(c.price, r.ref) "reference" from prev p left join cur c using (item) left join (select p_partkey item, round(p_retailprice)::bigint ref from part) r using (item)) select item, price, "reference", coalesce(price < "reference" * 0.9, false) dirty from j""")
def f15_contaminated(spark, sf):
    a, b = pair(spark, sf)
    ref = table(spark, sf, "part").select(F.col("p_partkey").alias("item"), F.round("p_retailprice").cast("bigint").alias("price"))
    return G.flag_contaminated(a.select("item", "price"), [b, ref], "item", "price")


@query(f"""with {PAIR}, o as (select o.item, d, min(o.price) price from obs o join cur on cur.item = o.item where o.price < cur.price * 0.9 group by 1, 2)
select item, array_to_string(list(strftime(d, '%Y-%m-%d') order by d), ',') dates, array_to_string(list(strftime(d, '%Y-%m-%d') || '=' || price order by d), ',') prices from o group by 1""")
def f15_dirty_manifest(spark, sf):
    flagged = G.flag_contaminated(obs(spark, sf), [pair(spark, sf)[1].select("item", "price")], "item", "price")
    m = G.dirty_manifest(flagged, "item", "d", "price")
    cells = F.transform("dates", lambda d: F.concat_ws("=", d, F.col("prices")[d]))
    return m.select("item", F.array_join("dates", ",").alias("dates"), F.array_join(cells, ",").alias("prices"))


@query(f"with {OBS}, f as (select *, 'run-' || strftime(d, '%Y-%m') source_file from obs) select item, source, d, price, source_file from f where not (price > 80000 and source = 'S1') and source_file not in ('run-1998-03', 'run-1997-11')", dates=["d"])
def f16_exclude_files(spark, sf):
    """Whole runs go by their file, single cells by their key."""
    o = obs(spark, sf).withColumn("source_file", F.concat(F.lit("run-"), F.date_format("d", "yyyy-MM")))
    bad = o.where("price > 80000 and source = 'S1'")
    files = spark.createDataFrame([("run-1998-03",), ("run-1997-11",)], "source_file string")
    return G.exclude_dirty(o, bad, ["item", "source", "d", "price"], files).select("item", "source", "d", "price", "source_file")


@query(f"with {OBS}, b as (select item, d from obs where price > 80000) select item, source, d, price from obs where (item, d) not in (select item, d from b)", dates=["d"])
def f16_exclude_dirty(spark, sf):
    o = obs(spark, sf)
    return G.exclude_dirty(o, o.where("price > 80000"), ["item", "d"])


@query("select count(*) filter (l_returnflag = 'R' and l_linenumber < 5) leaks, count(*) \"rows\", count(*) filter (l_returnflag = 'R' and l_linenumber < 5) = 0 clean from lineitem where not (l_tax > 0.07 or l_linenumber = 5)")
def f17_listing_guard(spark, sf):
    kept = G.exclude_listing(table(spark, sf, "lineitem").withColumn("foreign", F.when(F.col("l_tax") > 0.07, F.col("l_tax")).otherwise(0.0)), "foreign", "l_linenumber")
    return G.leaks(kept, (F.col("l_returnflag") == "R") & (F.col("l_linenumber") < 5))


@query("select p_partkey, p_name from part where (starts_with(p_name, 'red') or starts_with(p_name, 'small') or (not starts_with(p_name, 'blue') and p_size > 40)) and not starts_with(p_name, 'blue') and not contains(p_name, 'bolt')")
def f18_keep_by_prefix(spark, sf):
    return G.keep_by_prefix(table(spark, sf, "part"), "p_name", ["red", "small"], ["blue"], "bolt", F.col("p_size") > 40).select("p_partkey", "p_name")


@query("select c_custkey, c_mktsegment from customer where c_mktsegment not in ('BUILDING')")
def f19_drop_stores(spark, sf):
    return G.drop_stores(table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), "c_mktsegment", ["BUIL DING"])


# What is said of a fee, and whether it has to be paid: a negation counts within twelve characters, as a word.
FEES = [("corkage fee applies", True), ("no corkage fee", False), ("fee as in every house, though no dogs", True), ("fee? no", False), ("notice: fee", True), ("welcome", False)]


@query(f"select event_id, case when event_type = 'click' then 'free' end tag, [{', '.join(str(x).lower() for _, x in FEES)}][event_id % 6 + 1] paid from events")
def f20_evidence(spark, sf):
    e = table(spark, sf, "events")
    tags = F.array(F.struct(F.lit("other").alias("term"), F.lit(0).alias("mark")), F.struct(F.when(F.col("event_type") == "click", "free").otherwise("none").alias("term"), F.lit(1).alias("mark")))
    text = F.get(F.array(*(F.lit(t) for t, _ in FEES)), (F.col("event_id") % 6).cast("int"))
    return G.free_tag_evidence(e.withColumn("tags", tags).withColumn("t", text), "tags", "^free$", "t", "fee", r"\bno\b").select("event_id", "tag", "paid")
