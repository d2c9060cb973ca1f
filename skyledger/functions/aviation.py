"""Domain rules as column expressions: frequency services, approach identifiers, coded numbers, hazard distances."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import present, signed_hemisphere

FOOT_M = 0.3048

# The services of an airport's frequencies and the wording that gives each, the first that fits counting.
SERVICES = (
    ("D-ATIS", r"\bD-ATIS\b", None),
    ("ATIS", r"\bATIS\b", None),
    ("AWOS", r"\bAWOS\b", ("ASOS_AWOS",)),
    ("ASOS", r"\bASOS\b", ("ASOS_AWOS",)),
    ("TOWER", r"^LCL/[PS](\s|$)", None),
    ("GROUND", r"^GND/[PS](\s|$)", None),
    ("CTAF", r"^CTAF$", None),
    ("CLEARANCE", r"^CD(/[PS](\s|$)| PRE (TAXI|DEP) CLNC$)", None),
    ("APPROACH/DEPARTURE", r"^APCH/DEP/[PS](\s|$)|(^|\s)APCH/[PS](\s.*)?\sDEP/[PS](\s|$)|(^|\s)DEP/[PS](\s.*)?\sAPCH/[PS](\s|$)", None),
    ("APPROACH", r"(^|\s)APCH/[PS](\s|$)", None),
    ("DEPARTURE", r"(^|\s)DEP/[PS](\s|$)", None),
    ("CENTER", "", ("RCAG", "ARTCC")),
)
# The letter of each approach family with a runway, and the word of each with a circling letter.
RUNWAY_FAMILIES = (("ILS", "I"), ("LOC BC", "B"), ("LOC/DME BC", "B"), ("LOC", "L"), ("LOC/DME", "L"), ("LDA", "X"), ("LDA/DME", "X"), ("SDF", "U"), ("RNAV (RNP)", "H"), ("RNAV (GPS)", "R"), ("VOR/DME", "D"), ("VOR", "S"), ("NDB/DME", "Q"), ("NDB", "N"), ("GPS", "P"))
CIRCLING_FAMILIES = (("RNAV (GPS)", "RNV"), ("VOR/DME", "VDM"), ("VOR", "VOR"), ("LOC BC", "LBC"), ("LOC/DME BC", "LOC BC"), ("LOC", "LOC"), ("LOC/DME", "LOC"), ("LDA", "LDA"), ("LDA/DME", "LDA"), ("NDB", "NDB"), ("NDB/DME", "NDM"), ("GPS", "GPS"))
# What the codes of catalog records stand for, and the sheets of minimums by their sequence.
CHART_KINDS = (("APD", "airport-diagram"), ("IAP", "approach"), ("DP", "departure"), ("ODP", "departure"), ("STR", "arrival"), ("STAR", "arrival"), ("HOT", "hot-spot"), ("LAH", "lahso"))
MINIMUMS = ((10100, "takeoff-minimums"), (10110, "diverse-vector-area"), (10200, "alternate-minimums"), (10400, "radar-minimums"))
# Horizontal accuracy in feet by code 1 to 6, and in metres of code 7.
ACCURACY_FT, ACCURACY_7_M = (20, 50, 100, 250, 500, 1000), 926.0


def service_type(use: Column, facility: Column) -> Column:
    """The service that a frequency's use and facility name; null for any other."""
    use, out = F.upper(F.coalesce(present(use), F.lit(""))), F.lit(None).cast("string")
    for name, pattern, facilities in reversed(SERVICES):
        test = use.rlike(pattern) if pattern else F.lit(True)
        out = F.when(test & F.coalesce(present(facility).isin(*facilities), F.lit(False)) if facilities else test, name).otherwise(out)
    return out


def service_reason(use: Column, facility: Column, megahertz: Column) -> Column:
    """Why a frequency is not exported: another service, or no plain number from 100 up to 400 MHz; null if it is."""
    value = F.when(present(megahertz).rlike(r"^\d+(\.\d+)?$"), present(megahertz).try_cast("double"))
    usable = F.coalesce((value >= 100) & (value < 400), F.lit(False))
    return F.when(service_type(use, facility).isNull(), "service-outside-airport-projection").when(~usable, "unsupported-frequency")


def procedure_kind(code: Column, sequence: Column) -> Column:
    """Kind of a catalog record by its code, that of minimums by its sequence; ``other`` for all else."""
    minimums = looked_up(sequence.try_cast("int"), MINIMUMS)
    return F.coalesce(F.when(code == "MIN", minimums).otherwise(looked_up(code, CHART_KINDS)), F.lit("other"))


def looked_up(key: Column, values) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for pair in values for x in pair]), key)


# The systems that a title may name after a first one without another identifier of its own.
COMPANIONS = (("ILS", ("LOC", "LOC/DME", "LOC/NDB")), ("VOR", ("GPS", "TACAN")), ("VOR/DME", ("GPS", "TACAN")), ("NDB", ("GPS",)), ("NDB/DME", ("GPS",)))
THREE = ("VOR", "TACAN", "GPS")  # fixed values: the one list of three systems, of circling charts alone


def chart_title(title: Column) -> Column:
    """A chart's title in upper case with single blanks, without the number of a continued page."""
    return F.regexp_replace(F.upper(F.trim(F.regexp_replace(title, r"\s+", " "))), r", CONT\.\d+$", "")


def title_parts(title: Column) -> Column:
    """What a chart's title is made of: copter, the list of systems (name, variant), and its ending: runway number and side, circling letter or course."""
    text = F.regexp_replace(chart_title(title), r"^(ILS .*) \(SA CAT I\)$", "$1")
    ending = r"(?:-([A-Z])| (\d{3})| (?:RWY )?(\d{1,2})([LCR]?))$"
    piece = lambda k: F.nullif(F.regexp_extract(text, ending, k), F.lit(""))
    copter = F.startswith(text, F.lit("COPTER "))
    names = F.split(F.regexp_replace(F.regexp_replace(text, ending, ""), "^COPTER ", ""), " OR ")
    system = lambda s: F.struct(F.regexp_replace(s, " [A-Z]$", "").alias("name"), F.nullif(F.regexp_extract(s, " ([A-Z])$", 1), F.lit("")).alias("variant"))
    return F.struct(copter.alias("copter"), F.transform(names, system).alias("systems"), piece(1).alias("letter"), piece(2).alias("course"), piece(3).alias("runway"), F.coalesce(piece(4), F.lit("")).alias("side"))


def approach_ident(title: Column) -> Column:
    """Coded identifier of an approach chart's title: family, runway and variant; null where the title is none of the known forms.

    A list of systems goes by its first one if the others are known companions of it and all variants named agree."""
    p = title_parts(title)
    systems, letter = p["systems"], p["letter"]
    names, variants = F.transform(systems, lambda s: s["name"]), F.array_distinct(F.filter(F.transform(systems, lambda s: s["variant"]), lambda v: v.isNotNull()))
    first, variant = names[0], F.get(variants, F.lit(0))
    known = F.create_map(*[F.lit(x) if isinstance(x, str) else F.array(*map(F.lit, x)) for pair in COMPANIONS for x in pair])
    pair = F.coalesce(F.array_contains(F.element_at(known, first), F.get(names, F.lit(1))), F.lit(False))
    three = (names == F.array(*map(F.lit, THREE))) & letter.isNotNull()
    one_name = (F.size(names) == 1) | ((F.size(names) == 2) & pair) | three
    usable = one_name & (F.size(variants) <= 1)

    circling = F.when(variant.isNull(), F.concat_ws("-", looked_up(first, CIRCLING_FAMILIES), letter))
    dash = F.when(variant.isNull(), "").when(p["side"] == "", F.concat(F.lit("-"), variant)).otherwise(variant)
    runway = F.when(p["runway"].try_cast("int").between(1, 36), F.concat(looked_up(first, RUNWAY_FAMILIES), F.lpad(p["runway"], 2, "0"), p["side"], dash))
    heading = F.when((names == F.array(F.lit("RNAV (GPS)"))) & variant.isNull() & p["course"].try_cast("int").between(1, 360), F.concat(F.lit("R"), p["course"]))
    straight = F.when(letter.isNotNull(), F.when(looked_up(first, CIRCLING_FAMILIES).isNotNull(), circling)).otherwise(runway)
    return F.when(p["copter"], heading).when(usable, straight)


def rnp_miles(c: Column) -> Column:
    """Two digits of a mantissa and one of a negative power of ten, in nautical miles; null for anything else."""
    return F.when(c.rlike(r"^\d{3}$"), F.substring(c, 1, 2).try_cast("double") / F.pow(F.lit(10.0), F.substring(c, 3, 1).try_cast("int")))


def signed_hundredths(c: Column) -> Column:
    """A sign or none, then digits of hundredths: '-300' is -3.0."""
    return F.when(F.trim(c).rlike(r"^[+-]?\d+$"), F.trim(c).try_cast("long") / 100)


def hold_minutes(c: Column) -> Column:
    """T and tenths of minutes: 'T010' is one minute."""
    return F.when(c.rlike(r"^T\d{3}$"), F.substring(c, 2, 3).try_cast("int") / 10)


def station_declination(kind: Column, degrees: Column, hemisphere: Column) -> Column:
    """Declination of a station, east positive; only stations of a VOR type have one."""
    return F.when(F.upper(F.trim(kind)).rlike(r"^(VOR|VORTAC|VOR/DME|VOT)$"), signed_hemisphere(degrees, hemisphere))


def horizontal_accuracy(code: Column, metres: Column, unknown: float) -> Column:
    """Metres of position uncertainty: those given, else those of the accuracy code's digit, else ``unknown``."""
    digit = F.regexp_extract(F.coalesce(code, F.lit("")), r"^(\d)", 1).try_cast("int")
    by_code = F.when(digit == 7, ACCURACY_7_M)
    for i, feet in enumerate(ACCURACY_FT, 1):
        by_code = by_code.when(digit == i, feet * FOOT_M)
    return F.coalesce(metres.cast("double"), by_code, F.lit(unknown))


def hazard_radius(kind: Column, height_m: Column, accuracy_m: Column, ordinary: tuple[str, ...], crane: float, plain: float, guyed: float, limit: float) -> Column:
    """Metres kept free around an obstacle: the clearance of its physical class or one and a half of its height, whichever
    is more, and its position uncertainty; null (for the ledger) where that exceeds ``limit`` or a number is negative.

    Kinds are compared in upper case with ``_`` for blanks and hyphens; those that are not ``ordinary`` may have guy wires."""
    name = F.regexp_replace(F.upper(F.trim(F.coalesce(kind, F.lit("")))), r"[\s-]+", "_")
    physical = F.when(name.contains("CRANE"), crane).when(name.isin(*ordinary), plain).otherwise(guyed)
    radius = F.greatest(physical, F.coalesce(height_m, F.lit(0.0)) * 1.5) + accuracy_m
    return F.when((radius <= limit) & (F.coalesce(height_m, F.lit(0.0)) >= 0) & (accuracy_m >= 0), radius)
