"""Column expressions: typed fields from text, dates of editions, flags, tiers, geometry of points and tiles."""

from __future__ import annotations

import re
import sys
import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6371008.8
AIRAC_EPOCH = "2020-01-02"
MAJOR_EPOCH = "2026-09-03"  # fixed value: a day on which a 56-day edition begins; every other 28-day edition does


def present(c: Column) -> Column:
    """Trimmed text, or null where nothing is left."""
    return F.nullif(F.trim(c), F.lit(""))


def number_value(c: Column) -> Column:
    """A finite number, or null."""
    value = present(c).try_cast("double")
    return F.when(F.isnan(value) | (F.abs(value) == float("inf")), None).otherwise(value)


def boolean_flag(c: Column) -> Column:
    return F.when(present(c) == "Y", True).when(present(c) == "N", False)


def signed_hemisphere(degrees: Column, hemisphere: Column) -> Column:
    """Degrees from 0 to 180 with the sign of E or W; only zero may go without a hemisphere."""
    usable = degrees.between(0, 180)
    return F.when(usable & (hemisphere == "E"), degrees).when(usable & (hemisphere == "W"), -degrees).when(usable & (degrees == 0), F.lit(0.0))


def composite_id(*parts: Column, default: str = "unknown") -> Column:
    return F.concat_ws(":", *[F.coalesce(present(p.cast("string")), F.lit(default)) for p in parts])


def reasons(**rules: Column) -> Column:
    """Names of the rules that a row breaks (a rule is true where it is broken), in the order given."""
    return F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in rules.items()]))


def ordinal_date(c: Column) -> Column:
    """yyyyDDD to a date; a day that the year does not have gives null."""
    return F.try_to_date(c, "yyyyDDD")


def split_list(c: Column, delimiters: str = r"[,\s]+") -> Column:
    return F.array_distinct(F.filter(F.split(c, delimiters), lambda x: x != ""))


def dms(c: Column) -> Column:
    """Hemisphere and [d]ddmmsshh to signed degrees; null where minutes, seconds or the limit are exceeded."""
    head, body = F.substring(c, 1, 1), F.substring(c, 2, 9)
    lat = head.isin("N", "S")
    width = F.when(lat, 2).otherwise(3)
    whole = body.substr(F.lit(1), width).try_cast("int")
    minute, second = body.substr(width + 1, F.lit(2)).try_cast("int"), body.substr(width + 3, F.lit(4)).try_cast("int")
    value = whole + minute / 60 + second / 360000
    limit = F.when(lat, 90).otherwise(180)
    return F.when((minute < 60) & (second < 6000) & (value <= limit), F.when(head.isin("S", "W"), -value).otherwise(value))


def scaled(c: Column, divisor: int) -> Column:
    """Digits with an implied decimal point."""
    return F.when(c.rlike("^-?[0-9]+$"), c.try_cast("long") / divisor)


def airac_start(day: Column) -> Column:
    """First day of the 28-day edition that holds a date."""
    since = F.datediff(day, F.lit(AIRAC_EPOCH).cast("date"))
    return F.date_add(F.lit(AIRAC_EPOCH).cast("date"), (F.floor(since / 28) * 28).cast("int"))


def major_start(day: Column) -> Column:
    """First day of the 56-day edition that holds a date."""
    since = F.datediff(day, F.lit(MAJOR_EPOCH).cast("date"))
    return F.date_add(F.lit(MAJOR_EPOCH).cast("date"), (F.floor(since / 56) * 56).cast("int"))


def airac_cycle(day: Column) -> Column:
    """Edition name yynn: nn counts editions that begin in the year."""
    start = airac_start(day)
    return F.concat(F.date_format(start, "yy"), F.lpad((F.floor((F.dayofyear(start) - 1) / 28) + 1).cast("string"), 2, "0"))


def effective_date(ts: Column) -> Column:
    """The day whose data holds at an instant: editions change at 09:01 UTC."""
    return F.to_date(ts - F.expr("interval '9:01' hour to minute"))


def pack_flags(*bits: Column) -> Column:
    out = F.lit(0)
    for i, b in enumerate(bits):
        out = out.bitwiseOR(F.when(b, F.lit(1 << i)).otherwise(F.lit(0)))
    return out


def half_up(x: Column) -> Column:
    """Rounded with halves toward positive infinity."""
    return F.floor(x + 0.5)


def tier(x: Column, limits: list[tuple[float, str]], above: str) -> Column:
    """Name of the first limit that a value does not exceed."""
    out = F.lit(above)
    for limit, name in reversed(limits):
        out = F.when(x <= limit, name).otherwise(out)
    return F.when(x.isNotNull(), out)


def first_rule(c: Column, rules: list[tuple[str, str]], otherwise: str | None = None) -> Column:
    """Value of the first pattern that is found in the text."""
    out = F.lit(otherwise)
    for pattern, value in reversed(rules):
        out = F.when(c.rlike(pattern), value).otherwise(out)
    return out


def haversine(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_RADIUS_M * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def tile_x(lon: Column, z: int) -> Column:
    return F.least(F.lit((1 << z) - 1), F.greatest(F.lit(0), F.floor((lon + 180) / 360 * (1 << z)))).cast("int")


def tile_y(lat: Column, z: int) -> Column:
    return F.least(F.lit((1 << z) - 1), F.greatest(F.lit(0), F.floor((1 - F.asinh(F.tan(F.radians(lat))) / F.pi()) / 2 * (1 << z)))).cast("int")


def tile_north(z: Column, y: Column) -> Column:
    """Latitude of a tile's upper edge."""
    return F.degrees(F.atan(F.sinh(F.pi() * (1 - 2 * y / F.pow(F.lit(2.0), z)))))


@cache
def plain_letters() -> tuple[dict[str, str], dict[str, str]]:
    """Code points whose compatibility decomposition holds ASCII letters or digits: those of one such character and nothing else, and the rest.

    Combining marks from U+0300 to U+036F vanish, all else in a decomposition is a break between words."""
    single, several = {}, {}
    for code in range(0x80, sys.maxunicode + 1):
        if not unicodedata.decomposition(chr(code)):
            continue
        plain = re.sub("[^a-z0-9]+", " ", re.sub("[\u0300-\u036f]", "", unicodedata.normalize("NFKD", chr(code))))
        if plain.strip():
            (single if len(plain) == 1 else several)[chr(code)] = plain
    return single, several


def normalize_text(c: Column) -> Column:
    """Lower case, letters decomposed and stripped of their accents, runs of anything but letters a-z and digits to one space.

    One ``translate`` does nearly all; only texts that then hold a character that stands for several (ligatures, units,
    fractions) are gone through a character at a time."""
    single, several = plain_letters()
    marks = "".join(map(chr, range(0x300, 0x370)))
    text = F.translate(F.lower(c), "".join(single) + marks, "".join(single.values()))
    slow = F.array_join(F.transform(F.split(text, ""), lambda x: F.coalesce(F.element_at(F.create_map(*[F.lit(v) for pair in several.items() for v in pair]), x), x)), "")
    codes, spans = sorted(map(ord, several)), []
    for code in codes:
        if spans and code == spans[-1][1] + 1:
            spans[-1][1] = code
        else:
            spans.append([code, code])
    held = text.rlike(r"[^\x00-\x7F]") & text.rlike("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in spans) + "]")
    text = F.when(held, slow).otherwise(text)
    return F.trim(F.regexp_replace(text, "[^a-z0-9]+", " "))
