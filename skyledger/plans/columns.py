"""Queries over projections, casts and rule tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions import aviation as V
from skyledger.functions import columns as C

from .bindings import BOXES, CELLS, POINTS, boxes, cells, points
from .query import Query, Tables, query

QUERIES: list[Query] = []


@query(QUERIES, r"SELECT event_id, try_cast(nullif(trim(regexp_extract(props, '\d+')), '') AS DOUBLE) AS number, try_cast(event_type AS DOUBLE) AS none FROM events")
def q_safe_number(t: Tables) -> DataFrame:
    return t.events.select("event_id", C.number_value(F.regexp_extract("props", r"(\d+)", 1)).alias("number"), C.number_value(F.col("event_type")).alias("none"))


@query(QUERIES, "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'true' WHEN 'O' THEN 'false' END AS flag FROM orders")
def q_flags(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", C.boolean_flag(F.translate("o_orderstatus", "FO", "YN")).cast("string").alias("flag"))


@query(QUERIES, "SELECT c_custkey, CASE WHEN d BETWEEN 0 AND 180 AND h = 'E' THEN d WHEN d BETWEEN 0 AND 180 AND h = 'W' THEN -d WHEN d = 0 THEN 0.0 END AS signed FROM (SELECT c_custkey, (c_custkey % 200)::DOUBLE AS d, CASE c_custkey % 3 WHEN 0 THEN 'E' WHEN 1 THEN 'W' END AS h FROM customer)")
def q_signed_hemisphere(t: Tables) -> DataFrame:
    h = F.when(F.col("c_custkey") % 3 == 0, "E").when(F.col("c_custkey") % 3 == 1, "W")
    return t.customer.select("c_custkey", C.signed_hemisphere((F.col("c_custkey") % 200).cast("double"), h).alias("signed"))


@query(QUERIES, f"SELECT id, lon, lat FROM {POINTS} WHERE lon * 1.1 BETWEEN -180 AND 180 AND lat * 1.2 BETWEEN -90 AND 90")
def q_valid_points(t: Tables) -> DataFrame:
    return points(t).where((F.col("lon") * 1.1).between(-180, 180) & (F.col("lat") * 1.2).between(-90, 90)).select("id", "lon", "lat")


@query(QUERIES, "SELECT c_custkey || ':' || coalesce(nullif(c_mktsegment, 'BUILDING'), 'unknown') || ':' || c_nationkey AS id FROM customer")
def q_composite_id(t: Tables) -> DataFrame:
    return t.customer.select(C.composite_id(F.col("c_custkey"), F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")), F.col("c_nationkey")).alias("id"))


@query(QUERIES, "SELECT p_partkey, array_to_string([x FOR x IN [CASE WHEN p_size > 40 THEN 'size' END, CASE WHEN NOT regexp_matches(p_brand, '^Brand#1') THEN 'brand' END, CASE WHEN p_retailprice < 950 THEN 'price' END] IF x IS NOT NULL], ',') AS reasons FROM part")
def q_validate_reasons(t: Tables) -> DataFrame:
    found = C.reasons(size=F.col("p_size") > 40, brand=~F.col("p_brand").rlike("^Brand#1"), price=F.col("p_retailprice") < 950)
    return t.part.select("p_partkey", F.array_join(found, ",").alias("reasons"))


@query(QUERIES, "SELECT o_orderkey, CASE WHEN d BETWEEN 1 AND 365 + (y % 4 = 0)::INT THEN (make_date(y, 1, 1) + (d - 1)::INT)::DATE::VARCHAR END AS day FROM (SELECT o_orderkey, year(o_orderdate)::INT AS y, (o_orderkey % 368)::INT AS d FROM orders)")
def q_ordinal_date(t: Tables) -> DataFrame:
    code = F.concat(F.year("o_orderdate").cast("string"), F.lpad((F.col("o_orderkey") % 368).cast("string"), 3, "0"))
    return t.orders.select("o_orderkey", C.ordinal_date(code).cast("string").alias("day"))


@query(QUERIES, r"SELECT p_partkey, array_to_string(list_distinct_kept, '|') AS parts FROM (SELECT p_partkey, [x FOR x, i IN l IF x <> '' AND list_position(l, x) = i] AS list_distinct_kept FROM (SELECT p_partkey, regexp_split_to_array(p_name || ', ' || p_type || ' ' || p_name, '[,\s]+') AS l FROM part))")
def q_split_list(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.array_join(C.split_list(F.concat("p_name", F.lit(", "), "p_type", F.lit(" "), "p_name")), "|").alias("parts"))


@query(QUERIES, f"""WITH e AS (SELECT id, lat < 0 AS s, floor(abs(lat))::BIGINT AS d, (id % 70) AS m, (id * 37) % 6100 AS c FROM {POINTS})
SELECT id, CASE WHEN m < 60 AND c < 6000 AND d + m / 60 + c / 360000 <= 90 THEN round(CASE WHEN s THEN -(d + m / 60 + c / 360000) ELSE d + m / 60 + c / 360000 END, 9) END AS degrees FROM e""")
def q_dms(t: Tables) -> DataFrame:
    part = lambda c, n: F.lpad(c.cast("string"), n, "0")
    code = F.concat(F.when(F.col("lat") < 0, "S").otherwise("N"), part(F.floor(F.abs("lat")), 2), part(F.col("id") % 70, 2), part(F.col("id") * 37 % 6100, 4))
    return points(t).select("id", F.round(C.dms(code), 9).alias("degrees"))


@query(QUERIES, r"""WITH e AS (SELECT p_partkey, (p_size * 7)::VARCHAR AS raw, CASE p_partkey % 4 WHEN 0 THEN lpad(p_size::VARCHAR, 5, '0') WHEN 1 THEN '-' || lpad(p_size::VARCHAR, 4, '0') WHEN 2 THEN 'FL' || lpad(p_size::VARCHAR, 3, '0') ELSE 'X' || p_size END AS alt FROM part)
SELECT p_partkey, raw::BIGINT / 10 AS tenths, raw::BIGINT / 100 AS hundredths, CASE WHEN regexp_matches(alt, '^([0-9]{5}|-[0-9]{4}|FL[0-9]{3})$') THEN alt END AS altitude FROM e""")
def q_scaled_fields(t: Tables) -> DataFrame:
    raw, size = (F.col("p_size") * 7).cast("string"), F.col("p_size").cast("string")
    kind = F.col("p_partkey") % 4
    alt = F.when(kind == 0, F.lpad(size, 5, "0")).when(kind == 1, F.concat(F.lit("-"), F.lpad(size, 4, "0"))).when(kind == 2, F.concat(F.lit("FL"), F.lpad(size, 3, "0"))).otherwise(F.concat(F.lit("X"), size))
    return t.part.select("p_partkey", C.scaled(raw, 10).alias("tenths"), C.scaled(raw, 100).alias("hundredths"), F.when(alt.rlike("^([0-9]{5}|-[0-9]{4}|FL[0-9]{3})$"), alt).alias("altitude"))


@query(QUERIES, "SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN (o_custkey % 400) % 360 ELSE (o_custkey % 4000) / 10.0 - CASE WHEN (o_custkey % 4000) / 10.0 >= 360 THEN 360 ELSE 0 END END::DOUBLE AS course, o_orderkey % 5 = 0 AS is_true FROM orders")
def q_course(t: Tables) -> DataFrame:
    code = F.when(F.col("o_orderkey") % 5 == 0, F.concat(F.lpad((F.col("o_custkey") % 400).cast("string"), 3, "0"), F.lit("T"))).otherwise(F.lpad((F.col("o_custkey") % 4000).cast("string"), 4, "0"))
    is_true = code.endswith("T")
    tenths = F.col("code").try_cast("int") / 10.0
    course = F.when(F.col("is_true"), F.substring("code", 1, 3).try_cast("int") % 360).otherwise(F.when(tenths >= 360, tenths - 360).otherwise(tenths))
    return t.orders.select("o_orderkey", code.alias("code"), is_true.alias("is_true")).select("o_orderkey", course.cast("double").alias("course"), "is_true")


@query(QUERIES, "SELECT o_orderkey, upper(strftime(o_orderdate, '%d%b%Y')) AS code, strftime(o_orderdate, '20%y-%m-%d') AS day, strftime(o_orderdate, '0901Z %m/%d/%y') AS stamp FROM orders")
def q_date_codes(t: Tables) -> DataFrame:
    code = F.upper(F.date_format("o_orderdate", "ddMMMyyyy"))
    stamp = F.concat(F.lit("0901Z "), F.date_format("o_orderdate", "MM/dd/yy"))
    return t.orders.select("o_orderkey", code.alias("code"), F.try_to_date(F.regexp_extract(stamp, r"^\d{4}Z (.*)$", 1), "MM/dd/yy").cast("string").alias("day"), stamp.alias("stamp"))


START = "DATE '2020-01-02' + (floor((d - DATE '2020-01-02') / {n}.0) * {n})::INT"


@query(QUERIES, f"SELECT o_orderkey, strftime(s, '%y') || lpad((floor((dayofyear(s) - 1) / 28) + 1)::INT::VARCHAR, 2, '0') AS cycle, s::DATE::VARCHAR AS effective, (s + 28)::DATE::VARCHAR AS expires FROM (SELECT o_orderkey, {START.format(n=28)} AS s FROM (SELECT o_orderkey, o_orderdate::DATE AS d FROM orders))")
def q_airac(t: Tables) -> DataFrame:
    start = C.airac_start(F.to_date("o_orderdate"))
    return t.orders.select("o_orderkey", C.airac_cycle(F.to_date("o_orderdate")).alias("cycle"), start.cast("string").alias("effective"), F.date_add(start, 28).cast("string").alias("expires"))


@query(QUERIES, f"SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN {START.format(n=56).replace('2020-01-02', '2026-09-03')} ELSE {START.format(n=28)} END::DATE::VARCHAR AS effective FROM (SELECT o_orderkey, o_orderpriority, o_orderdate::DATE AS d FROM orders)")
def q_major_cycle(t: Tables) -> DataFrame:
    day = F.to_date("o_orderdate")
    return t.orders.select("o_orderkey", F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), C.major_start(day)).otherwise(C.airac_start(day)).cast("string").alias("effective"))


@query(QUERIES, "SELECT event_id, (ts - INTERVAL 541 MINUTE)::DATE::VARCHAR AS day FROM events")
def q_effective_date(t: Tables) -> DataFrame:
    return t.events.select("event_id", C.effective_date(F.col("ts")).cast("string").alias("day"))


@query(QUERIES, "SELECT event_id, time_bucket(INTERVAL 28 DAY, ts, TIMESTAMP '2020-01-02 09:01:00') AS edition, count(*) OVER (PARTITION BY time_bucket(INTERVAL 28 DAY, ts, TIMESTAMP '2020-01-02 09:01:00'))::BIGINT AS n FROM events")
def q_edition_window(t: Tables) -> DataFrame:
    edition = F.window("ts", "28 days", startTime="7 days 9 hours 1 minute")["start"]
    counts = t.events.groupBy(edition.alias("edition")).agg(F.count("*").alias("n"))
    return t.events.select("event_id", edition.alias("edition")).join(counts, "edition").select("event_id", "edition", "n")


@query(QUERIES, "SELECT p_partkey, (p_size > 25)::INT + 2 * (p_type = 'ECONOMY')::INT + 4 * (p_retailprice > 1000)::INT AS flags, (p_type = 'ECONOMY') AS second FROM part")
def q_flags_pack(t: Tables) -> DataFrame:
    flags = C.pack_flags(F.col("p_size") > 25, F.col("p_type") == "ECONOMY", F.col("p_retailprice") > 1000)
    return t.part.select("p_partkey", flags.alias("flags"), (flags.bitwiseAND(2) != 0).alias("second"))


@query(QUERIES, f"""WITH r AS (SELECT box, [west, east, east, west, west] AS xs FROM {BOXES}), q AS (SELECT box, [floor(x * 1e6 + 0.5)::BIGINT FOR x IN xs] AS e FROM r), k AS (SELECT box, [v FOR v, i IN e IF i = 1 OR v <> e[i - 1]] AS e FROM q)
SELECT box, array_to_string([CASE WHEN i = 1 THEN v ELSE v - e[i - 1] END FOR v, i IN e], ',') AS deltas FROM k""")
def q_delta_encode(t: Tables) -> DataFrame:
    e = F.transform(F.array("west", "east", "east", "west", "west"), lambda x: C.half_up(x * 1e6).cast("long"))
    kept = boxes(t).select("box", e.alias("e")).select("box", F.expr("filter(e, (v, i) -> i = 0 or v <> e[i - 1])").alias("e"))
    return kept.select("box", F.array_join(F.expr("transform(e, (v, i) -> if(i = 0, v, v - e[i - 1]))").cast("array<string>"), ",").alias("deltas"))


@query(QUERIES, "SELECT p_partkey, CASE WHEN p_size <= 10 THEN 'short' WHEN p_size <= 30 THEN 'medium' ELSE 'long' END AS tier FROM part")
def q_tier(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", C.tier(F.col("p_size"), [(10, "short"), (30, "medium")], "long").alias("tier"))


@query(QUERIES, "SELECT p_partkey, CASE WHEN p_name LIKE 'red%' THEN 'warm' WHEN regexp_matches(p_name, 'ring$|bolt$') THEN 'metal' WHEN p_type = 'ECONOMY' THEN 'cheap' ELSE 'other' END AS service FROM part")
def q_rule_classify(t: Tables) -> DataFrame:
    text = F.concat_ws("/", "p_name", "p_type")
    return t.part.select("p_partkey", C.first_rule(text, [("^red", "warm"), ("(ring|bolt)/", "metal"), ("/ECONOMY$", "cheap")], "other").alias("service"))


@query(QUERIES, "SELECT l_orderkey, count(*) FILTER (l_returnflag = 'A')::INT AS local, count(*) FILTER (l_returnflag = 'N')::INT AS terminal, count(*) FILTER (l_returnflag = 'R')::INT AS center FROM lineitem GROUP BY 1")
def q_partition_array(t: Tables) -> DataFrame:
    held = t.lineitem.groupBy("l_orderkey").agg(F.collect_list("l_returnflag").alias("all"))
    some = lambda v: F.size(F.filter("all", lambda x: x == v))
    return held.select("l_orderkey", some("A").alias("local"), some("N").alias("terminal"), some("R").alias("center"))


@query(QUERIES, "SELECT p_partkey, CASE WHEN p_type = 'ECONOMY' THEN CASE WHEN p_size % 2 = 0 THEN 'approach' ELSE 'departure' END WHEN p_type = 'SMALL' THEN 'arrival' END AS kind FROM part")
def q_two_level_map(t: Tables) -> DataFrame:
    kinds = t.spark.createDataFrame([("ECONOMY", 0, "approach"), ("ECONOMY", 1, "departure"), ("SMALL", 0, "arrival"), ("SMALL", 1, "arrival")], "p_type string, odd int, kind string")
    return t.part.withColumn("odd", F.col("p_size") % 2).join(F.broadcast(kinds), ["p_type", "odd"], "left").select("p_partkey", "kind")


@query(QUERIES, f"SELECT x, y, CASE lines WHEN 7 THEN 'water' WHEN 6 THEN 'forest' WHEN 5 THEN 'crop' ELSE 'open' END AS cover FROM {CELLS}")
def q_lut_classify(t: Tables) -> DataFrame:
    lut = t.spark.createDataFrame([(1, "open"), (2, "open"), (3, "open"), (4, "open"), (5, "crop"), (6, "forest"), (7, "water")], "lines int, cover string")
    return cells(t).join(F.broadcast(lut), "lines").select("x", "y", "cover")


@query(QUERIES, "SELECT p_partkey, least(10000.0, (greatest(p_size * 2.0, 1.5 * p_retailprice / 10) + CASE p_size % 4 WHEN 0 THEN 6.1 WHEN 1 THEN 15.2 WHEN 2 THEN 30.5 ELSE 76.2 END) * 1.01) AS radius FROM part")
def q_hazard_radius(t: Tables) -> DataFrame:
    accuracy = F.element_at(F.array(F.lit(6.1), F.lit(15.2), F.lit(30.5), F.lit(76.2)), F.col("p_size") % 4 + 1)
    return t.part.select("p_partkey", F.least(F.lit(10000.0), (F.greatest(F.col("p_size") * 2.0, 1.5 * F.col("p_retailprice") / 10) + accuracy) * 1.01).alias("radius"))


@query(QUERIES, f"SELECT x, y, lo >= 5 AND hi >= 30 AND lines < 7 AS eligible, (lo >= 5) <> (hi >= 30) AS uncertain FROM {CELLS}")
def q_reconcile(t: Tables) -> DataFrame:
    first, second = F.col("lo") >= 5, F.col("hi") >= 30
    return cells(t).select("x", "y", (first & second & (F.col("lines") < 7)).alias("eligible"), (first != second).alias("uncertain"))


@query(QUERIES, r"""SELECT p_partkey, CASE WHEN regexp_matches(upper(p_name), '^RED ') THEN 'R-' || regexp_extract(upper(p_name), '^RED (\w)', 1) || lpad(p_size::VARCHAR, 2, '0') WHEN regexp_matches(upper(p_name), '(RING|BOLT)$') THEN left(regexp_extract(upper(p_name), '(RING|BOLT)$', 1), 1) || '-' || p_size END AS ident FROM part""")
def q_title_canonical(t: Tables) -> DataFrame:
    title = F.upper(F.trim("p_name"))
    red = F.concat(F.lit("R-"), F.regexp_extract(title, r"^RED (\w)", 1), F.lpad(F.col("p_size").cast("string"), 2, "0"))
    metal = F.concat(F.substring(F.regexp_extract(title, "(RING|BOLT)$", 1), 1, 1), F.lit("-"), F.col("p_size").cast("string"))
    return t.part.select("p_partkey", F.when(title.rlike("^RED "), red).when(title.rlike("(RING|BOLT)$"), metal).alias("ident"))


@query(QUERIES, r"SELECT event_id, regexp_extract(props, '\d+')::INT AS k FROM events WHERE event_type IN ('click', 'view') AND regexp_extract(props, '\d+')::INT < 50")
def q_family_filter(t: Tables) -> DataFrame:
    tags = F.from_json("props", "map<string,int>")
    return t.events.where(F.col("event_type").isin("click", "view")).select("event_id", tags["k"].alias("k")).where("k < 50")


@query(QUERIES, "SELECT p_partkey, (p_partkey * 37)::BIGINT AS id, ascii(p_name) % 8 * 4 + (p_size > 25)::INT * 2 + (p_retailprice > 1000)::INT AS symbol FROM part WHERE p_retailprice >= 950")
def q_compact_index(t: Tables) -> DataFrame:
    kept = t.part.where("p_retailprice >= 950")
    code = F.conv((F.col("p_partkey") * 37).cast("string"), 10, 36)
    symbol = F.ascii("p_name") % 8 * 4 + (F.col("p_size") > 25).cast("int") * 2 + (F.col("p_retailprice") > 1000).cast("int")
    return kept.select("p_partkey", F.conv(code, 36, 10).cast("long").alias("id"), symbol.alias("symbol"))


@query(QUERIES, f"SELECT id, lon, lat, CASE WHEN id % 3 > 0 THEN owner END::DOUBLE AS owner FROM {POINTS}")
def q_geojson_fields(t: Tables) -> DataFrame:
    from skyledger.sources.sinks import to_geojson

    text = to_geojson(points(t).withColumn("owner", F.when(F.col("id") % 3 > 0, F.col("owner"))), "id", "lon", "lat", ["owner"])
    get = lambda path, kind: F.get_json_object("value", path).cast(kind)
    return text.select(get("$.id", "long").alias("id"), get("$.geometry.coordinates[0]", "double").alias("lon"), get("$.geometry.coordinates[1]", "double").alias("lat"), get("$.properties.owner", "double").alias("owner"))


@query(QUERIES, "SELECT p_partkey, p_size, p_type FROM part")
def q_fixed_width(t: Tables) -> DataFrame:
    from skyledger.sources.readers import fixed_fields

    line = F.concat(F.lpad(F.col("p_partkey").cast("string"), 10, "0"), F.lpad(F.col("p_size").cast("string"), 4, " "), F.rpad("p_type", 118, " "))
    found = fixed_fields(t.part.select(line.alias("value")), {"p_partkey": (0, 10), "p_size": (10, 14), "p_type": (14, 132)})
    return found.select(F.col("p_partkey").cast("long").alias("p_partkey"), F.col("p_size").cast("int").alias("p_size"), "p_type")


# Title or use of a row by its number, and what it stands for, written out by hand for the SQL.
USES = (("D-ATIS", "TOWER", "D-ATIS"), ("ATIS", "TOWER", "ATIS"), ("AWOS-3PT", "ASOS_AWOS", "AWOS"), ("ASOS", "ASOS_AWOS", "ASOS"), ("ASOS", "TOWER", None), ("LCL/P", "TOWER", "TOWER"), ("GND/S", "TOWER", "GROUND"), ("CTAF", "FSS", "CTAF"), ("CD PRE TAXI CLNC", "TOWER", "CLEARANCE"), ("APCH/P DEP/P", "TRACON", "APPROACH/DEPARTURE"), ("APCH/DEP/S IC", "TRACON", "APPROACH/DEPARTURE"), ("APCH/P IC", "TRACON", "APPROACH"), ("DEP/S", "TRACON", "DEPARTURE"), ("LOW ALTITUDE", "RCAG", "CENTER"), ("CLASS B", "TRACON", None), ("", "FSS", None))
TITLES = (
    ("ILS OR LOC RWY 9L", "I09L"), ("ILS Z OR LOC/DME RWY 27", "I27-Z"), ("ILS Y OR LOC Z RWY 27", None), ("RNAV (GPS) Y RWY 04R", "R04RY"), ("RNAV (RNP) Z RWY 36", "H36-Z"), ("VOR/DME RWY 13", "D13"), ("VOR-A", "VOR-A"), ("RNAV (GPS)-B", "RNV-B"),
    ("LOC/DME BC RWY 31", "B31"), ("NDB RWY 37", None), ("COPTER RNAV (GPS) 123", "R123"), ("COPTER RNAV (GPS) 361", None), ("VOR OR GPS RWY 5", "S05"), ("NDB OR TACAN RWY 5", None), ("ILS RWY 16R (SA CAT I)", "I16R"), ("LDA/DME RWY 6", "X06"), ("SDF RWY 2", "U02"), ("HI-TACAN RWY 2", None), ("  gps  rwy 18, CONT.1", "P18"), ("NDB/DME-C", "NDM-C"),
)


def picked(values: list, k: str) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (F.col(k) % len(values) + 1).cast("int"))


def sql_list(values: list) -> str:
    return "[" + ", ".join("NULL" if v is None else "'" + v + "'" for v in values) + "]"


@query(QUERIES, f"SELECT p_partkey, {sql_list([u[2] for u in USES])}[p_partkey % {len(USES)} + 1] AS service, CASE WHEN {sql_list([u[2] for u in USES])}[p_partkey % {len(USES)} + 1] IS NULL THEN 'service-outside-airport-projection' WHEN p_size * 10 < 100 OR p_size * 10 >= 400 THEN 'unsupported-frequency' END AS reason FROM part")
def q_frequency_services(t: Tables) -> DataFrame:
    use, facility, megahertz = picked([u[0] for u in USES], "p_partkey"), picked([u[1] for u in USES], "p_partkey"), (F.col("p_size") * 10).cast("string")
    return t.part.select("p_partkey", V.service_type(use, facility).alias("service"), V.service_reason(use, facility, megahertz).alias("reason"))


@query(QUERIES, f"SELECT p_partkey, {sql_list([u[1] for u in TITLES])}[p_partkey % {len(TITLES)} + 1] AS ident FROM part")
def q_approach_idents(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", V.approach_ident(picked([u[0] for u in TITLES], "p_partkey")).alias("ident"))


@query(QUERIES, "SELECT p_partkey, (p_partkey % 100) / pow(10.0, p_size % 10) AS rnp, CASE WHEN p_size % 2 = 0 THEN -p_partkey ELSE p_partkey END / 100.0 AS angle, (p_partkey % 1000) / 10.0 AS hold, CASE WHEN p_size % 3 > 0 THEN CASE WHEN p_size % 2 = 0 THEN p_size ELSE -p_size END END::DOUBLE AS declination FROM part")
def q_coded_numbers(t: Tables) -> DataFrame:
    c, even = F.col, F.col("p_size") % 2 == 0
    digits = lambda x, n: F.lpad(x.cast("string"), F.greatest(F.length(x.cast("string")), F.lit(n)), F.lit("0"))
    station = F.when(c("p_size") % 3 > 0, "VORTAC").otherwise("NDB")
    return t.part.select(
        "p_partkey", V.rnp_miles(F.concat(digits(c("p_partkey") % 100, 2), (c("p_size") % 10).cast("string"))).alias("rnp"), V.signed_hundredths(F.concat(F.when(even, "-").otherwise("+"), digits(c("p_partkey"), 3))).alias("angle"),
        V.hold_minutes(F.concat(F.lit("T"), digits(c("p_partkey") % 1000, 3))).alias("hold"), V.station_declination(station, c("p_size").cast("double"), F.when(even, "E").otherwise("W")).alias("declination"),
    )


@query(QUERIES, "SELECT p_partkey, CASE WHEN r <= 300 THEN r END AS radius FROM (SELECT p_partkey, round(greatest(CASE p_size % 3 WHEN 0 THEN 150 WHEN 1 THEN 30 ELSE 90 END, p_retailprice / 10 * 1.5) + CASE p_size % 4 WHEN 0 THEN 20 * 0.3048 WHEN 1 THEN 250 * 0.3048 WHEN 2 THEN 926.0 ELSE 75.0 END, 6) AS r FROM part)")
def q_hazard_policy(t: Tables) -> DataFrame:
    kind = picked(["TOWER CRANE", "utility pole", "mast"], "p_size")
    accuracy = V.horizontal_accuracy(picked(["1A", "4B", "7D", "9I"], "p_size"), F.lit(None), 75.0)
    radius = V.hazard_radius(kind, F.col("p_retailprice") / 10, accuracy, ("UTILITY_POLE",), 150.0, 30.0, 90.0, 1e9)
    return t.part.select("p_partkey", F.round(radius, 6).alias("radius")).withColumn("radius", F.when(F.col("radius") <= 300, F.col("radius")))
