"""Queries over lines, polygons, landing ground, tile layers and generations of parts."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions import columns as C
from skyledger.functions.aviation import procedure_kind
from skyledger.functions.storage import shared_folder
from skyledger.operators import areas as A
from skyledger.operators import grid as G
from skyledger.operators import landing, tiles
from skyledger.operators.associations import associate
from skyledger.sources import generations
from skyledger.streaming import feeds

from .bindings import BOXES, CELLS, POINTS, boxes, cells, points
from .query import Query, Tables, query

QUERIES: list[Query] = []
SPAN = "greatest(0.0, least(1.0, ((lon - west) * (east - west) + (lat - south) * (north - south)) / ((east - west) ** 2 + (north - south) ** 2)))"


@query(QUERIES, f"SELECT id, box, round(d, 9) AS distance FROM (SELECT id, box, size, sqrt((lon - west - {SPAN} * (east - west)) ** 2 + (lat - south - {SPAN} * (north - south)) ** 2) AS d FROM {POINTS}, {BOXES}) WHERE d <= size / 50.0")
def q_segment_join(t: Tables) -> DataFrame:
    """Points within a row's own distance of a slanted segment, the diagonal of a box."""
    lines = boxes(t).select("box", F.col("west").alias("x1"), F.col("south").alias("y1"), F.col("east").alias("x2"), F.col("north").alias("y2"), (F.col("size") / 50.0).alias("radius"))
    return A.segment_join(points(t).select("id", "lon", "lat"), lines, 1.0).select("id", "box", F.round("distance", 9).alias("distance"))


def diamond_rings(t: Tables) -> DataFrame:
    """Boxes' diamonds, from the middle of each side, with a triangular hole: ``rings`` of closed points and ``edges``."""
    c, x, y = F.col, (F.col("west") + F.col("east")) / 2, (F.col("south") + F.col("north")) / 2
    w, h = F.col("east") - F.col("west"), F.col("north") - F.col("south")
    point = lambda a, b: F.struct(a.alias("x"), b.alias("y"))
    ring = lambda *p: F.array(*[point(*q) for q in (*p, p[0])])
    outer = ring((x, c("south")), (c("east"), y), (x, c("north")), (c("west"), y))
    hole = ring((x, y - h / 8), (x + w / 8, y + h / 8), (x - w / 8, y + h / 8))
    edge = lambda r, i: F.struct(r[i]["x"].alias("x1"), r[i]["y"].alias("y1"), r[i + 1]["x"].alias("x2"), r[i + 1]["y"].alias("y2"))
    edges = F.array(*[edge(r, i) for r, n in ((F.col("rings")[0], 4), (F.col("rings")[1], 3)) for i in range(n)])
    return boxes(t).withColumn("rings", F.array(outer, hole)).withColumn("edges", edges)


DIAMOND = f"(SELECT *, (west + east) / 2 AS cx, (south + north) / 2 AS cy, east - west AS w, north - south AS h FROM {BOXES})"
IN_DIAMOND = "abs(lon - cx) / (w / 2) + abs(lat - cy) / (h / 2) < 1 AND NOT (lat < cy + h / 8 AND abs(lon - cx) < (lat - (cy - h / 8)) / (h / 4) * w / 8)"


@query(QUERIES, f"SELECT id, box FROM {POINTS}, {DIAMOND} WHERE {IN_DIAMOND}")
def q_points_in_areas(t: Tables) -> DataFrame:
    """Points in slanted polygons with holes, by inside and edge cells."""
    return A.points_in_areas(points(t).select("id", "lon", "lat"), diamond_rings(t), "box", 0.5).select("id", "box")


@query(QUERIES, f"""WITH m AS (SELECT box, id, owner % 100 AS length, id % 8 AS flags FROM {POINTS}, {DIAMOND} WHERE {IN_DIAMOND}), r AS (SELECT box, max(flags) OVER (PARTITION BY box) AS flags, count(*) OVER (PARTITION BY box) AS patches, id, length, row_number() OVER (PARTITION BY box ORDER BY length DESC, id) AS place FROM m)
SELECT b.box, r.id AS witness, r.length::BIGINT AS length, r.flags::BIGINT AS flags, coalesce(r.patches, 0)::BIGINT AS patches FROM {BOXES} b LEFT JOIN r ON r.box = b.box AND place = 1""")
def q_area_ranks(t: Tables) -> DataFrame:
    """Polygons with their longest patch and highest flags."""
    patches = points(t).select("lon", "lat", F.col("id").alias("witness"), (F.col("owner") % 100).cast("long").alias("length"), (F.col("id") % 8).cast("long").alias("flags"))
    return A.containment_rank(diamond_rings(t), patches, "box", 0.5)


GRID = lambda v: f"floor(({v}) * 1000000 + 0.5)::BIGINT"
XY = [("cx", "south"), ("east", "cy"), ("cx", "north"), ("west", "cy")], [("cx", "cy - h / 8"), ("cx + w / 8", "cy + h / 8"), ("cx - w / 8", "cy + h / 8")]
STEPS = ["[" + ", ".join(f"{GRID(p[k])} - {GRID(ring[i - 1][k])}" if i else GRID(p[k]) for i, p in enumerate(ring) for k in (0, 1)) + "]" for ring in XY]


@query(QUERIES, f"SELECT box, array_to_string({STEPS[0]}, ' ') || ' / ' || array_to_string({STEPS[1]}, ' ') AS codes, 9::INT AS points, round(({' + '.join(GRID(p[0]) for ring in XY for p in (*ring, ring[0]))}) / 1e6, 6) AS xs, round(({' + '.join(GRID(p[1]) for ring in XY for p in (*ring, ring[0]))}) / 1e6, 6) AS ys FROM {DIAMOND}")
def q_ring_codes(t: Tables) -> DataFrame:
    """Rings with holes in steps of a millionth of a degree, and what decoding gives back."""
    coded = diamond_rings(t).select("box", A.encode_rings(F.col("rings")).alias("codes"))
    back = coded.withColumn("all", F.flatten(A.decode_rings(F.col("codes"))))
    total = lambda k: F.round(F.aggregate("all", F.lit(0.0), lambda s, p: s + p[k]), 6)
    return back.select("box", F.array_join(F.transform("codes", lambda r: F.array_join(r.cast("array<string>"), " ")), " / ").alias("codes"), F.size("all").alias("points"), total("x").alias("xs"), total("y").alias("ys"))


def runway(key: Column) -> Column:
    return F.lpad((key % 36 + 1).cast("string"), 2, "0")


ROUTES = "(SELECT 'A' || o_custkey % 200 AS airport, 'VOR/DME RWY ' || lpad((o_orderkey % 36 + 1)::VARCHAR, 2, '0') AS title, 'D' || lpad((o_orderkey % 36 + 1)::VARCHAR, 2, '0') || ['L', 'R', ''][o_custkey % 3 + 1] AS ident, 'R' || o_orderkey AS route, (o_orderkey // 36) % 2 AS content, o_orderkey % 4 > 0 AS agrees FROM orders)"


@query(QUERIES, f"""WITH r AS {ROUTES}, c AS (SELECT p_partkey AS chart, 'A' || p_partkey % 200 AS airport, lpad((p_size % 36 + 1)::VARCHAR, 2, '0') AS rwy, ['L', 'L/R', ''][p_partkey % 3 + 1] AS side FROM part),
g AS (SELECT airport, ident, list(route ORDER BY route) AS ids, any_value(content) AS content FROM r GROUP BY 1, 2),
v AS (SELECT airport, title, min(route) AS route, bool_and(agrees) AS agrees FROM (SELECT DISTINCT airport, title, route, agrees FROM r) GROUP BY 1, 2 HAVING count(*) = 1),
j AS (SELECT chart, o.ids AS own, CASE WHEN v.agrees THEN v.route END AS reviewed, a.ids AS a, b.ids AS b, len(a.ids) = 1 AND len(b.ids) = 1 AS single, a.content = b.content AS same FROM c LEFT JOIN g o ON o.airport = c.airport AND side <> 'L/R' AND o.ident = 'D' || rwy || side
  LEFT JOIN v ON v.airport = c.airport AND v.title = 'VOR/DME RWY ' || rwy || side LEFT JOIN g a ON side = 'L/R' AND a.airport = c.airport AND a.ident = 'D' || rwy || 'L' LEFT JOIN g b ON side = 'L/R' AND b.airport = c.airport AND b.ident = 'D' || rwy || 'R'),
k AS (SELECT *, CASE WHEN own IS NOT NULL THEN 'canonical' WHEN reviewed IS NOT NULL THEN 'reviewed' WHEN single AND same THEN 'parallel-equivalent' WHEN single THEN 'parallel-choice' ELSE 'unmatched' END AS rule FROM j),
m AS (SELECT *, CASE rule WHEN 'canonical' THEN own WHEN 'reviewed' THEN [reviewed] WHEN 'parallel-equivalent' THEN a WHEN 'parallel-choice' THEN a || b ELSE [] END AS ids FROM k)
SELECT chart, array_to_string(ids, ',') AS routes, CASE WHEN len(ids) = 0 THEN 'unmatched' WHEN len(ids) = 1 THEN 'matched' ELSE 'ambiguous' END AS status, rule FROM m""")
def q_associations(t: Tables) -> DataFrame:
    """Charts and coded routes by identifier, review and parallel runways."""
    c = F.col
    airport = lambda k: F.concat(F.lit("A"), (c(k) % 200).cast("string"))
    side = lambda k, *v: F.element_at(F.array(*map(F.lit, v)), (c(k) % 3 + 1).cast("int"))
    plate = lambda a: F.concat(F.lit("plates/"), a)
    charts = t.part.select(c("p_partkey").alias("chart"), airport("p_partkey").alias("airport"), F.concat(F.lit("VOR/DME RWY "), runway(c("p_size")), side("p_partkey", "L", "L/R", "")).alias("title"), plate(airport("p_partkey")).alias("plate"))
    content = F.floor(c("o_orderkey") / 36) % 2
    route = F.concat(F.lit("R"), c("o_orderkey").cast("string")).alias("route")
    routes = t.orders.select(airport("o_custkey").alias("airport"), F.concat(F.lit("D"), runway(c("o_orderkey")), side("o_custkey", "L", "R", "")).alias("ident"), route, F.array(F.struct(content.alias("fix"))).alias("final"), content.alias("variation"))
    reviewed = F.when(c("o_orderkey") % 4 > 0, F.upper(plate(airport("o_custkey")))).otherwise(F.lit("another plate"))
    reviews = t.orders.select(airport("o_custkey").alias("airport"), F.concat(F.lit("VOR/DME RWY "), runway(c("o_orderkey"))).alias("title"), route, reviewed.alias("plate"))
    return associate(charts, routes, reviews, ["final", "variation"]).select("chart", F.array_join("route_ids", ",").alias("routes"), "status", "rule")


TILE = lambda z: (f"least((1 << {z}) - 1, greatest(0, floor((lon + 180) / 360 * (1 << {z}))))::BIGINT", f"least((1 << {z}) - 1, greatest(0, floor((1 - asinh(tan(radians(lat))) / pi()) / 2 * (1 << {z}))))::BIGINT")
SHEETS = ((0, 3, 5, "north"), (1, 4, 4, "middle"), (2, 2, 6, "south"))  # place, lowest and highest level, name
ASKED = (1, 4, 7)


@query(QUERIES, f"""WITH p AS (SELECT id, owner % 3 AS place, {TILE(7)[0]} AS x, {TILE(7)[1]} AS y FROM {POINTS}), s(place, lo, hi, sheet) AS (VALUES {', '.join(map(str, SHEETS))}), w AS (SELECT DISTINCT z, x >> (7 - z)::INT AS x, y >> (7 - z)::INT AS y FROM p, (VALUES {', '.join(f'({z})' for z in ASKED)}) v(z)),
d AS (SELECT w.z, w.x, w.y, s.place, sheet, CASE WHEN w.z < lo THEN 'overview' WHEN w.z > hi THEN 'parent' ELSE 'own' END AS origin, least(w.z, hi)::INT AS u FROM w, s),
m AS (SELECT place, u, x >> (7 - u)::INT AS x, y >> (7 - u)::INT AS y, max(id) AS data FROM p, (SELECT DISTINCT u FROM d) GROUP BY ALL),
l AS (SELECT d.z, d.x, d.y, string_agg(sheet || ' ' || origin || ' ' || d.u || '/' || m.x || '/' || m.y || ' ' || data, ', ' ORDER BY d.place) AS layers FROM d JOIN m ON m.place = d.place AND m.u = d.u AND m.x = d.x >> (d.z - d.u)::INT AND m.y = d.y >> (d.z - d.u)::INT GROUP BY ALL)
SELECT z::INT AS z, x::BIGINT AS x, y::BIGINT AS y, layers FROM l""")
def q_tile_layers(t: Tables) -> DataFrame:
    """What three sheets of different levels show at tiles of three levels."""
    c = F.col
    at = points(t).select("id", (c("owner") % 3).cast("int").alias("place"), C.tile_x(c("lon"), 7).cast("long").alias("x"), C.tile_y(c("lat"), 7).cast("long").alias("y"))
    sheets = t.spark.createDataFrame([(p, lo, hi, s) for p, lo, hi, s in SHEETS], "place int, min_zoom int, max_zoom int, sheet string")
    up = lambda k: F.expr(f"shiftright({k}, 7 - z)").alias(k)
    held = at.join(F.broadcast(sheets), "place").withColumn("z", F.explode(F.sequence("min_zoom", "max_zoom")))
    stored = held.groupBy("sheet", "z", up("x"), up("y")).agg(F.max("id").alias("data"))
    wanted = at.withColumn("z", F.explode(F.array(*map(F.lit, ASKED)))).select("z", up("x"), up("y"))
    found = tiles.resolve_tiles(wanted, sheets, stored, F.max("data"))
    text = F.transform("layers", lambda v: F.concat_ws(" ", v["sheet"], v["origin"], F.concat_ws("/", v["z"].cast("string"), v["x"].cast("string"), v["y"].cast("string")), v["data"].cast("string")))
    return found.select("z", "x", "y", F.array_join(text, ", ").alias("layers"))


@query(QUERIES)
def q_landing_areas(t: Tables) -> DataFrame:
    """Areas of cells that evidence makes eligible and that hold a corridor, preferred ones first."""
    c = F.col
    evidence = {
        "cover": c("lo") >= 10, "blocked": c("lines") < 2, "excluded": c("hi") > 49, "disputed": (c("x") + c("y")) % 11 == 0, "mapping_required": c("lines") == 3, "bare": c("x") % 2 == 0, "newer_open": c("y") % 2 == 0,
        "fine": (c("x") % 3).cast("int"), "ground_open": (c("y") % 4).cast("int"), "canopy": F.lit(2), "impervious": F.lit(2), "land": (c("x") % 4).cast("int"), "trees": (c("y") % 3).cast("int"), "water": F.lit(0),
    }
    eligible, uncertain = landing.cover_evidence(evidence)
    ground = cells(t).select("x", "y", eligible.alias("eligible"), uncertain.alias("uncertain"), F.when(c("lines") == 4, 2).otherwise(0).alias("hazard"), F.when(c("hi") >= 30, 1).otherwise(2).alias("band"), (c("lines") % 8).cast("int").alias("flags"))
    return landing.landing_areas(ground, 128, (2, 4.0), (1, 5.0))


@query(QUERIES, f"SELECT (owner % 3)::VARCHAR AS kind, (id % 2)::INT AS z, id, CASE WHEN lon > 170 THEN owner + 1 ELSE owner END AS owner FROM {POINTS}")
def q_generations(t: Tables) -> DataFrame:
    """Points published in bounded parts, then again after those of the far east changed: what the second generation holds."""
    root, c = f"{shared_folder(t.spark)}/generations-{uuid.uuid4().hex}", F.col
    rows = points(t).select((c("owner") % 3).cast("string").alias("kind"), (c("id") % 2).cast("int").alias("z"), "id", "owner", "lon")
    for owner in (c("owner"), F.when(c("lon") > 170, c("owner") + 1).otherwise(c("owner"))):
        generations.publish_parts(rows.withColumn("owner", owner), root, "points", ["id"], ["lon", "id"], ["owner", "lon"], F.lit(40), 8_000, 150)
    return generations.current_rows(t.spark, root, "points").select("kind", "z", "id", "owner")


@query(QUERIES, "SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def q_stream_upsert(t: Tables) -> DataFrame:
    """Each user's newest event, kept in a table that a stream updates."""
    place = f"{shared_folder(t.spark)}/upsert-{uuid.uuid4().hex}"
    feeds.upserting(feeds.read_stream(t.spark, t.folder, "events").select("user_id", "event_id", "event_type", "ts"), place, "users", ["user_id"], ["ts", "event_id"], f"{place}/state", 8)
    return generations.upserted(t.spark, place, "users").select("user_id", "event_id", "event_type")


@query(QUERIES, "SELECT edition, n FROM (SELECT time_bucket(INTERVAL 28 DAY, ts, TIMESTAMP '2020-01-02 09:01:00') AS edition, count(*)::BIGINT AS n FROM events GROUP BY 1) WHERE edition + INTERVAL 28 DAY <= (SELECT max(ts) - INTERVAL 3 DAY FROM events)")
def q_edition_stream(t: Tables) -> DataFrame:
    """Editions that a stream has closed: those that end before the watermark, three days behind the newest record."""
    place = f"{shared_folder(t.spark)}/editions-{uuid.uuid4().hex}"
    return feeds.drained(feeds.edition_window(feeds.read_stream(t.spark, t.folder, "events")), place).select("edition", "n")


RISE = " UNION ALL ".join(f"SELECT {z} AS z, x // {1 << (7 - z)} AS x, y // {1 << (7 - z)} AS y, min(lo) AS lo, max(hi) AS hi, bit_or(lines)::INT AS lines, count(*)::BIGINT AS n FROM c GROUP BY 2, 3" for z in range(8))


@query(QUERIES, f"WITH c AS {CELLS} SELECT z, x, y, lo, hi, lines, n FROM ({RISE})")
def q_pyramid_measures(t: Tables) -> DataFrame:
    """Lowest, highest, flags and numbers of cells at all levels."""
    base = cells(t).withColumns({"n": F.lit(1).cast("long"), "lines": F.col("lines").cast("int")})
    return tiles.pyramid(base, 7, {"lo": F.min("lo"), "hi": F.max("hi"), "lines": F.bit_or("lines"), "n": F.sum("n")})


@query(QUERIES, f"SELECT box AS id, west, south FROM {BOXES} WHERE west <= -59.75 AND east >= -120.25 AND south <= 50.25 AND north >= 19.75")
def q_viewport_features(t: Tables) -> DataFrame:
    return tiles.viewport(boxes(t).withColumnRenamed("box", "id"), (-120.0, 20.0, -60.0, 50.0), 9, 8, 0.25).select("id", "west", "south")


@query(QUERIES, f"SELECT floor(west)::BIGINT AS lon, floor(south)::BIGINT AS lat, count(*)::BIGINT AS n FROM {BOXES} WHERE west <= -59.75 AND east >= -120.25 AND south <= 50.25 AND north >= 19.75 GROUP BY 1, 2")
def q_viewport_squares(t: Tables) -> DataFrame:
    return tiles.viewport(boxes(t).withColumnRenamed("box", "id"), (-120.0, 20.0, -60.0, 50.0), 7, 8, 0.25)


@query(QUERIES, f"""WITH r AS (SELECT box AS region, west, south, east, north FROM {BOXES} WHERE size > 40 UNION ALL SELECT box, west + 1, south - 1, east + 3, north + 1 FROM {BOXES} WHERE size > 40), m AS (SELECT DISTINCT region, b.box, b.size FROM r JOIN {BOXES} b ON r.west < b.east AND r.east > b.west AND r.south < b.north AND r.north > b.south)
SELECT s.box AS region, count(m.box)::BIGINT AS n_files, coalesce(sum(m.size * 1000), 0)::BIGINT AS bytes FROM {BOXES} s LEFT JOIN m ON m.region = s.box WHERE s.size > 40 GROUP BY 1""")
def q_region_files(t: Tables) -> DataFrame:
    """Files of regions of two rectangles that overlap each other, each file once."""
    c, b = F.col, boxes(t)
    regions = b.where("size > 40").select(c("box").alias("region"), F.array(F.array("west", "south", "east", "north"), F.array(c("west") + 1, c("south") - 1, c("east") + 3, c("north") + 1)).alias("bounds"))
    files = b.select(c("box").alias("file"), (c("size") * 1000).cast("long").alias("bytes"), "west", "south", "east", "north")
    return tiles.region_files(regions, files, "region", 5.0)


@query(QUERIES, f"SELECT box, lon::BIGINT AS lon, lat::BIGINT AS lat, greatest(west, lon)::DOUBLE AS west, greatest(south, lat)::DOUBLE AS south, least(east, lon + 1)::DOUBLE AS east, least(north, lat + 1)::DOUBLE AS north FROM {BOXES}, range(floor(west)::INT, greatest(ceil(east)::INT - 1, floor(west)::INT) + 1) a(lon), range(floor(south)::INT, greatest(ceil(north)::INT - 1, floor(south)::INT) + 1) b(lat)")
def q_clipped_tiles(t: Tables) -> DataFrame:
    return G.clipped_tiles(boxes(t), "box")


KINDS = (("APD", "1", "airport-diagram"), ("IAP", None, "approach"), ("DP", "", "departure"), ("ODP", "x", "departure"), ("STR", "2", "arrival"), ("STAR", "2", "arrival"), ("HOT", "2", "hot-spot"), ("LAH", "2", "lahso"), ("MIN", "10100", "takeoff-minimums"), ("MIN", "10110", "diverse-vector-area"), ("MIN", "10200", "alternate-minimums"), ("MIN", "10400", "radar-minimums"), ("MIN", "10500", "other"), ("MIN", "no number", "other"), ("XYZ", "10100", "other"), (None, "10100", "other"))


@query(QUERIES, f"SELECT p_partkey, [{', '.join(repr(k[2]) for k in KINDS)}][p_partkey % {len(KINDS)} + 1] AS kind FROM part")
def q_procedure_kinds(t: Tables) -> DataFrame:
    picked = lambda k: F.element_at(F.array(*[F.lit(x[k]) for x in KINDS]), (F.col("p_partkey") % len(KINDS) + 1).cast("int"))
    return t.part.select("p_partkey", procedure_kind(picked(0), picked(1)).alias("kind"))
