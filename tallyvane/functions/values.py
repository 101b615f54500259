"""Column functions over dates, money, bands and places."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyvane.functions.text import col

EARTH_M = 6_371_000.0
METRES_A_MINUTE = 67


def date_from_text(c: Column | str) -> Column:
    """The first date written as 2024-01-31, 2024.1.31, 2024년 1월 31일 or 20240131, tried in this order; null for none or an impossible one."""
    text = col(c)
    iso = F.regexp_extract(text, r"([0-9]{4}-[0-9]{2}-[0-9]{2})", 1)
    loose = r"([0-9]{4})[./년]\s*([0-9]{1,2})[./월]\s*([0-9]{1,2})"
    spaced = F.concat_ws("-", *(F.lpad(F.regexp_extract(text, loose, i), n, "0") for i, n in ((1, 4), (2, 2), (3, 2))))
    plain = F.regexp_extract(text, r"(?<![0-9])((?:19|20)[0-9]{6})(?![0-9])", 1)
    return F.coalesce(F.try_to_date(iso, "yyyy-MM-dd"), F.try_to_date(spaced, "yyyy-MM-dd"), F.try_to_date(plain, "yyyyMMdd"))


def last_date_in_name(c: Column | str) -> Column:
    """The latest of all ISO dates in a text."""
    found = F.regexp_extract_all(col(c), F.lit(r"([0-9]{4}-[0-9]{2}-[0-9]{2})"), 1)
    return F.array_max(F.transform(found, lambda x: F.try_to_date(x, "yyyy-MM-dd")))


def iso_week_bounds(c: Column | str) -> Column:
    """Struct (monday, sunday) of a date's ISO week."""
    monday = F.date_trunc("week", col(c)).cast("date")
    return F.struct(monday.alias("monday"), F.date_add(monday, 6).alias("sunday"))


def add_months_clamped(c: Column | str, months: int) -> Column:
    """The same day so many months on, or the last one of a shorter month."""
    return F.add_months(col(c), months)


def iso_week_mod(c: Column | str, n: int = 4) -> Column:
    return F.weekofyear(col(c)) % n


def month_key(c: Column | str) -> Column:
    return F.date_format(col(c), "yyyy-MM")


def month_number(c: Column | str) -> Column:
    """Months since year 0: a difference of two is whole whatever the days."""
    return F.year(col(c)) * 12 + F.month(col(c))


def unit_price(price: Column | str, volume: Column | str, base: float = 100.0) -> Column:
    """Price for `base` units of volume; null without a positive volume."""
    return F.when(col(volume) > 0, col(price) * base / col(volume))


def landed_cost(price: Column | str, customs: float = 0.20, liquor: float = 0.72, education: float = 0.30, vat: float = 0.10) -> Column:
    """Struct of the taxes on an import, each on what the ones before it left: customs, liquor, education (on the liquor tax), VAT."""
    base = col(price).cast("double")
    duty = base * customs
    tax = (base + duty) * liquor
    school = tax * education
    value = (base + duty + tax + school) * vat
    landed = base + duty + tax + school + value
    return F.struct(duty.alias("customs"), tax.alias("liquor"), school.alias("education"), value.alias("vat"), landed.alias("landed"), (landed / F.when(base != 0, base)).alias("multiplier"))


def band(c: Column | str, edges: Sequence[float], labels: Sequence[str], closed: str = "left") -> Column:
    """Label of the band a number falls in. closed: `left` is [lo, hi), `right` is (lo, hi], `mixed` closes all but the first at the right."""
    if len(labels) != len(edges) + 1:
        raise ValueError("one label more than edges")
    n, out = col(c), None
    for i, (edge, label) in enumerate(zip(edges, labels, strict=False)):
        below = n < edge if closed == "left" or (closed == "mixed" and i == 0) else n <= edge
        out = F.when(below, label) if out is None else out.when(below, label)
    return F.when(n.isNotNull(), F.lit(labels[-1]) if out is None else out.otherwise(labels[-1]))


def haversine_m(lat1, lng1, lat2, lng2) -> Column:
    a, b, c, d = (F.radians(col(x)) for x in (lat1, lng1, lat2, lng2))
    h = F.pow(F.sin((c - a) / 2), 2) + F.cos(a) * F.cos(c) * F.pow(F.sin((d - b) / 2), 2)
    return 2 * EARTH_M * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def walk_minutes(metres: Column | str) -> Column:
    return F.round(col(metres) / METRES_A_MINUTE).cast("int")


def region_of(address: Column | str, parts: int = 2) -> Column:
    """The first tokens of an address."""
    return F.array_join(F.slice(F.split(F.trim(col(address)), r"\s+"), 1, parts), " ")


def locality(address: Column | str, endings: str = "구군시") -> Column:
    """The first token of an address that ends like a district."""
    found = F.regexp_extract(col(address), rf"(\S+[{endings}])(?:\s|$)", 1)
    return F.when(found != "", found)


def convert(amount: Column | str, currency: Column | str, rates: Mapping[str, float]) -> Column:
    """Amount in the base currency by a small table of rates; null for a currency that isn't in it."""
    table = F.create_map(*(F.lit(x) for k, v in rates.items() for x in (k, float(v))))
    return col(amount) * F.try_element_at(table, col(currency))
