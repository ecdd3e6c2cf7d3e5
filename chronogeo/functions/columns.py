"""Scalar functions as Catalyst expressions (Column -> Column): no Python runs per row."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0
MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December")


def pick(table: dict, key: Column, default: Column | None = None) -> Column:
    """A small dictionary as a CASE expression."""
    if not table:
        return default if default is not None else F.lit(None)
    out = reduce(lambda c, kv: c.when(key == kv[0], F.lit(kv[1])), list(table.items())[1:], F.when(key == next(iter(table)), F.lit(next(iter(table.values())))))
    return out.otherwise(default) if default is not None else out


def let(x: Column, f: Callable[[Column], Column]) -> Column:
    """f(x) with x evaluated once: an array of one, whose lambda names it, else it would be spelled out wherever f uses it."""
    return F.get(F.transform(F.array(x), f), 0)


def half_up(x: Column, places: int) -> Column:
    """Rounding of doubles by floor(x * 10^p + 1/2), not by their decimal expansion."""
    scale = float(10**places)
    return F.floor(x * scale + 0.5) / F.lit(scale)


def trimmed(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def words(pattern: str, c: Column) -> Column:
    """c contains the pattern between ASCII word boundaries (Java's \\b is Unicode-aware)."""
    return c.rlike(f"(?<![0-9A-Za-z_])(?:{pattern})(?![0-9A-Za-z_])")


# --- geometry --------------------------------------------------------------------------------------------------------


def haversine_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    rad = F.lit(3.141592653589793)
    u, v = F.sin((lat2 - lat1) * rad / 180.0 / 2.0), F.sin((lng2 - lng1) * rad / 180.0 / 2.0)
    a = u * u + F.cos(lat1 * rad / 180.0) * F.cos(lat2 * rad / 180.0) * v * v
    return F.asin(F.least(F.lit(1.0), F.sqrt(a))) * (2 * EARTH_KM)


def wkt_point(c: Column) -> Column:
    """struct(lat, lng) of 'Point(lng lat)'; nulls for anything else."""
    rx = r"Point\(([-0-9.]+) ([-0-9.]+)\)"
    lng, lat = (F.regexp_extract(c, rx, k).try_cast("double") for k in (1, 2))
    return F.struct(lat.alias("lat"), lng.alias("lng"))


# --- dates -----------------------------------------------------------------------------------------------------------


def _iso(y: Column, m: Column, d: Column) -> Column:
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    return F.concat_ws("-", F.lpad(y.cast("string"), 4, "0"), two(m), two(d))


def month_length(y: Column, m: Column) -> Column:
    leap = ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)
    return F.when(m == 2, F.when(leap, 29).otherwise(28)).when(m.isin(4, 6, 9, 11), 30).otherwise(31)


def parse_date(c: Column) -> Column:
    """struct(lo, hi, precision) of a partial or human date; nulls where it cannot be read.

    Read are '1871', '1871-10', '1871-10-08' (and anything that begins so), 'October 8, 1871', 'October 1871'.  A month or
    day of 00 makes the date coarser; so does a month's name that is unknown.  Where none of these fits, days are read as
    '8 October 1871', 'Sun, 08 Oct 1871 00:00:00 GMT' (months by their first three letters) and '10/8/1871' (month first).
    """
    iso = r"^([0-9]{3,4})(?:-([0-9]{2}))?(?:-([0-9]{2}))?"
    human = r"^([A-Za-z]+)\s+(?:([0-9]{1,2}),?\s+)?([0-9]{3,4})$"
    day_first = r"^(?:[A-Za-z]{3,9},?\s+)?([0-9]{1,2})[ -]([A-Za-z]{3,9})[ ,-]+([0-9]{4})(?:\s+[0-9]{1,2}:[0-9]{2}.*)?$"
    slashes = r"^([0-9]{1,2})/([0-9]{1,2})/([0-9]{4})$"

    def ymd(y: Column, m: Column, d: Column) -> Column:
        return F.struct(y.cast("int").alias("y"), m.cast("int").alias("m"), d.cast("int").alias("d"))

    def read(s: Column) -> Column:
        """Each form is tried once, and only the parts of the one that fits are taken out."""
        num = lambda rx, k: F.regexp_extract(s, rx, k).try_cast("int")
        place = lambda names, text: F.array_position(F.array(*map(F.lit, names)), F.lower(text))
        named = place([m.lower() for m in MONTHS], F.regexp_extract(s, human, 1))
        short = F.nullif(place([m[:3].lower() for m in MONTHS], F.substring(F.regexp_extract(s, day_first, 2), 1, 3)).cast("int"), F.lit(0))
        sm, sd, day = num(slashes, 1), num(slashes, 2), num(day_first, 1)
        out = F.when(s.rlike(iso), ymd(num(iso, 1), F.coalesce(num(iso, 2), F.lit(0)), F.coalesce(num(iso, 3), F.lit(0))))
        out = out.when(s.rlike(human), ymd(num(human, 3), named, F.coalesce(num(human, 2), F.lit(0))))
        out = out.when(s.rlike(day_first), ymd(F.when(short.isNotNull() & day.between(1, 31), num(day_first, 3)), short, day))
        return out.when(s.rlike(slashes), ymd(F.when(sm.between(1, 12) & sd.between(1, 31), num(slashes, 3)), sm, sd))

    def span(v: Column) -> Column:
        y, m, d = v["y"], v["m"], v["d"]
        has_m, has_d = m > 0, (m > 0) & (d > 0)
        lo = _iso(y, F.greatest(m, F.lit(1)), F.when(has_d, d).otherwise(1))
        hi = _iso(y, F.when(has_m, m).otherwise(12), F.when(has_d, d).when(has_m, month_length(y, m)).otherwise(31))
        known = lambda c: F.when(y.isNotNull(), c)
        return F.struct(known(lo).alias("lo"), known(hi).alias("hi"), known(F.when(has_d, "day").when(has_m, "month").otherwise("year")).alias("precision"))

    # nearly all dates are whole: they are told by one pattern and taken as they are
    whole = c.rlike(r"^[0-9]{4}-(?:0[1-9]|[1-9][0-9])-(?:0[1-9]|[1-9][0-9])")
    iso_day = F.substring(c, 1, 10)
    return F.when(whole, F.struct(iso_day.alias("lo"), iso_day.alias("hi"), F.lit("day").alias("precision"))).otherwise(let(let(trimmed(c), read), span))


def format_date(iso: Column, precision: Column) -> Column:
    rx = r"^([0-9]+)-([0-9]{2})-([0-9]{2})$"
    y, m, d = (F.regexp_extract(iso, rx, k).try_cast("int") for k in (1, 2, 3))
    name = F.try_element_at(F.array(*map(F.lit, MONTHS)), F.greatest(m, F.lit(1)))
    day = F.concat(name, F.lit(" "), d.cast("string"), F.lit(", "), y.cast("string"))
    month = F.concat(name, F.lit(" "), y.cast("string"))
    return F.when(iso.rlike(rx), F.when(precision == "day", day).when(precision == "month", month).otherwise(y.cast("string"))).otherwise(iso)


def overlaps(a_lo: Column, a_hi: Column, b_lo: Column, b_hi: Column) -> Column:
    """Both ends inclusive; zero-padded ISO days compare as text."""
    return (a_lo <= b_hi) & (b_lo <= a_hi)


def decade_of(date: Column) -> Column:
    y = F.regexp_extract(F.substring(date, 1, 4), r"^\s*([+-]?[0-9]+)", 1).try_cast("int")
    return F.coalesce((F.floor(y / F.lit(10.0)) * 10).cast("int"), F.lit(0))


def wikidata_time(time: Column, precision: Column) -> Column:
    """struct(date, precision) of a claim's time ('+1871-10-08T00:00:00Z', precision 11, 10, 9, 8 or less).

    A month or day of 00 counts as 01. A year before 1 gives the date 'BCE', which ends the search among properties;
    a malformed time gives nulls.
    """
    rx = r"^([+-])([0-9]+)-([0-9]{2})-([0-9]{2})"
    y, m, d = (F.regexp_extract(time, rx, k).try_cast("int") for k in (2, 3, 4))
    one = lambda x: F.when(x == 0, 1).otherwise(x)
    past = (F.regexp_extract(time, rx, 1) == "-") | (y < 1)
    date = F.when(time.rlike(rx), F.when(past, "BCE").otherwise(_iso(y, one(m), one(d))))
    p = F.coalesce(precision, F.lit(11))
    kind = F.when(p >= 11, "day").when(p == 10, "month").when(p == 9, "year").when(p == 8, "decade").otherwise("century")
    return F.struct(date.alias("date"), F.when(date.isNotNull() & (date != "BCE"), kind).alias("precision"))


# --- identifiers and text --------------------------------------------------------------------------------------------


def hash36(c: Column) -> Column:
    """Java's string hash, absolute, in base 36, six places at least (code points of the basic plane)."""
    codes = F.transform(F.filter(F.split(c, ""), lambda x: x != ""), lambda x: F.ascii(x).cast("bigint"))
    h = F.aggregate(codes, F.lit(0).cast("bigint"), lambda a, x: F.pmod(a * 31 + x + F.lit(1 << 31), F.lit(1 << 32)) - F.lit(1 << 31))
    text = F.lower(F.conv(F.abs(h).cast("string"), 10, 36))
    return F.when(F.length(text) < 6, F.lpad(text, 6, "0")).otherwise(text)


def qid_of(uri: Column) -> Column:
    return F.element_at(F.split(uri, "/"), -1)


def notability_of(sitelinks: Column) -> Column:
    return half_up(F.least(F.lit(1.0), sitelinks / F.lit(100.0)), 3)


LINK = r"\[\[([^\]|]+)(?:\|[^\]]+)?\]\]"


def wikilinks(c: Column) -> Column:
    """Targets of the links of a wikitext, in order, without files, images and categories."""
    targets = F.transform(F.regexp_extract_all(c, F.lit(LINK), 1), trimmed)
    return F.filter(targets, lambda t: (t != "") & ~t.rlike("^(?:File|Image|Category):"))


def strip_wikilinks(c: Column, most: int = 280) -> Column:
    return F.substring(F.regexp_replace(c, LINK, "$1"), 1, most)


def source_url(title: Column, qid: Column) -> Column:
    """The page's address, or the entity's where there is no page."""
    enc = F.url_encode(F.regexp_replace(title, " ", "_"))
    for coded, plain in (("%21", "!"), ("%27", "'"), ("%28", "("), ("%29", ")"), ("%7E", "~")):
        enc = F.replace(enc, F.lit(coded), F.lit(plain))
    return F.when(title.isNotNull() & (title != ""), F.concat(F.lit("https://en.wikipedia.org/wiki/"), enc)).otherwise(F.concat(F.lit("http://www.wikidata.org/entity/"), qid))


def truncate_ip(c: Column) -> Column:
    """An address too coarse to name a client: IPv4 ends in .0, IPv6 keeps 48 bits, anything else is 'unknown'."""
    ip = F.regexp_replace(c, "^::ffff:", "")
    parts = F.split(ip, r"\.")
    v4 = F.concat(F.array_join(F.slice(parts, 1, 3), "."), F.lit(".0"))
    v6 = F.concat(F.array_join(F.slice(F.split(ip, ":"), 1, 3), ":"), F.lit("::/48"))
    known = F.when(ip.contains("."), F.when(F.size(parts) == 4, v4)).when(ip.contains(":"), v6)
    return F.coalesce(known, F.lit("unknown"))
