"""Queries over windows, cell tables, tiles and components."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger.functions import columns as C
from skyledger.operators import grid as G
from skyledger.operators import joins as J
from skyledger.operators.tiles import quad_blocks
from skyledger.operators import text as X
from skyledger.operators.graph import reachable

from .bindings import BOXES, CELLS, POINTS, boxes, cells, points
from .query import Query, Tables, query

QUERIES: list[Query] = []
LINES = "PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice"


def lines() -> Window:
    return Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


@query(QUERIES, "SELECT c_nationkey, c_custkey, c_acctbal FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS place FROM customer) WHERE place = 1")
def q_best_per_group(t: Tables) -> DataFrame:
    return J.best_per_group(t.customer, ["c_nationkey"], [F.desc("c_acctbal"), F.col("c_custkey")]).select("c_nationkey", "c_custkey", "c_acctbal")


@query(QUERIES, f"SELECT l_orderkey, l_linenumber, l_partkey, max((l_returnflag = 'R')::INT) OVER ({LINES} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS after_marker FROM lineitem")
def q_sticky_flag(t: Tables) -> DataFrame:
    seen = F.max((F.col("l_returnflag") == "R").cast("int")).over(lines().rowsBetween(Window.unboundedPreceding, 0))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", seen.alias("after_marker")).drop("l_suppkey", "l_extendedprice")


@query(QUERIES, "SELECT o_orderkey, o_orderpriority FROM (SELECT *, dense_rank() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate DESC) AS place FROM orders) WHERE place <= 3")
def q_retain_latest(t: Tables) -> DataFrame:
    place = F.dense_rank().over(Window.partitionBy("o_orderpriority").orderBy(F.desc("o_orderdate")))
    return t.orders.withColumn("place", place).where("place <= 3").select("o_orderkey", "o_orderpriority")


@query(QUERIES, "SELECT p_partkey, CASE WHEN k = 1 THEN p_name ELSE p_name || '-' || k END AS name FROM (SELECT *, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS k FROM part)")
def q_stable_suffix(t: Tables) -> DataFrame:
    k = F.row_number().over(Window.partitionBy("p_name").orderBy("p_partkey"))
    return t.part.withColumn("k", k).select("p_partkey", F.when(F.col("k") == 1, F.col("p_name")).otherwise(F.concat_ws("-", "p_name", F.col("k").cast("string"))).alias("name"))


@query(QUERIES, "SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS place FROM events WHERE event_type <> 'error') WHERE place = 1")
def q_latest_committed(t: Tables) -> DataFrame:
    return J.best_per_group(t.events.where("event_type <> 'error'"), ["user_id"], [F.desc("ts"), F.col("event_id")]).select("user_id", "event_id")


@query(QUERIES, "SELECT o_custkey, string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_totalprice DESC, o_orderkey) AS orders FROM orders GROUP BY 1")
def q_ordered_children(t: Tables) -> DataFrame:
    kids = F.array_sort(F.collect_list(F.struct((-F.col("o_totalprice")).alias("rank"), "o_orderkey")))
    return t.orders.groupBy("o_custkey").agg(F.array_join(F.transform(kids, lambda x: x["o_orderkey"].cast("string")), ",").alias("orders"))


ITEMS = "(SELECT l_orderkey AS page, l_linenumber % 2 * 0.5 + l_suppkey % 3 * 2 AS y, (l_linenumber * 10 + l_partkey % 7)::DOUBLE AS x, (l_suppkey % 9 + 1)::DOUBLE AS width, l_partkey AS item, l_suppkey AS s, l_extendedprice AS p FROM lineitem)"


@query(QUERIES, f"""WITH RECURSIVE i AS (SELECT *, row_number() OVER (PARTITION BY page ORDER BY y, x, item, s, p) AS k FROM {ITEMS}),
r AS (SELECT page, k, 0 AS island, y, x, x + width AS reach, item FROM i WHERE k = 1 UNION ALL SELECT page, k, CASE WHEN joined THEN island ELSE island + 1 END, CASE WHEN joined THEN y0 ELSE y END, CASE WHEN joined THEN x0 ELSE x END, CASE WHEN joined THEN greatest(reach, x + width) ELSE x + width END, item
  FROM (SELECT i.*, r.island, r.y AS y0, r.x AS x0, r.reach, abs(i.y - r.y) <= 0.75 AND i.x - r.reach BETWEEN -0.75 AND 2 AS joined FROM r JOIN i ON i.page = r.page AND i.k = r.k + 1))
SELECT page, island::INT AS island, min(y)::DOUBLE AS y, min(x) AS x, max(reach) - min(x) AS width, string_agg(item::VARCHAR, '' ORDER BY k) AS text FROM r GROUP BY 1, 2""")
def q_merge_adjacent(t: Tables) -> DataFrame:
    c = F.col
    items = t.lineitem.select(c("l_orderkey").alias("page"), (c("l_linenumber") % 2 * 0.5 + c("l_suppkey") % 3 * 2).alias("y"), (c("l_linenumber") * 10.0 + c("l_partkey") % 7).alias("x"), (c("l_suppkey") % 9 + 1).cast("double").alias("width"), c("l_partkey").cast("string").alias("text"), c("l_partkey").alias("item"), c("l_suppkey").alias("s"), c("l_extendedprice").alias("p"))
    return X.merge_adjacent(items, "page", ["item", "s", "p"]).select("page", "island", "y", "x", "width", "text")


CLEAR = f"(SELECT x, y FROM {CELLS} WHERE lo >= 10)"


def clear(t: Tables) -> DataFrame:
    return cells(t).where("lo >= 10").select("x", "y")


@query(QUERIES, f"WITH c AS {CELLS} SELECT a.x, a.y, min(b.lo) AS low, max(b.lo) AS high, max(a.lo) AS centre FROM c a JOIN c b ON abs(a.x - b.x) <= 1 AND b.y BETWEEN a.y - 1 AND a.y + 1 GROUP BY 1, 2 HAVING count(*) = 9")
def q_focal_relief(t: Tables) -> DataFrame:
    return G.focal(cells(t), "lo")


FIT = f"WITH c AS {CELLS}, s AS (SELECT a.x, a.y, sum((b.x - a.x) * b.hi) / 6 AS sx, sum((b.y - a.y) * b.hi) / 6 AS sy, avg(b.hi) AS m FROM c a JOIN c b ON b.x BETWEEN a.x - 1 AND a.x + 1 AND b.y BETWEEN a.y - 1 AND a.y + 1 GROUP BY 1, 2 HAVING count(*) = 9)"


@query(QUERIES, FIT + " SELECT s.x, s.y, round(sx, 6) AS slope_x, round(sy, 6) AS slope_y, round(m, 6) AS mean, round(max(abs(b.hi - (m + sx * (b.x - s.x) + sy * (b.y - s.y)))), 6) AS residual FROM s JOIN c b ON b.x BETWEEN s.x - 1 AND s.x + 1 AND b.y BETWEEN s.y - 1 AND s.y + 1 GROUP BY s.x, s.y, sx, sy, m")
def q_plane_fit(t: Tables) -> DataFrame:
    return G.plane_fit(cells(t), "hi").select("x", "y", *[F.round(c, 6).alias(c) for c in ("slope_x", "slope_y", "mean", "residual")])


@query(QUERIES, FIT + " SELECT x, y, CASE WHEN sqrt(sx * sx + sy * sy) <= 2 THEN 'strict' WHEN sqrt(sx * sx + sy * sy) <= 5 THEN 'rolling' ELSE 'constrained' END AS band FROM s")
def q_terrain_band(t: Tables) -> DataFrame:
    slope = F.sqrt(F.col("slope_x") * F.col("slope_x") + F.col("slope_y") * F.col("slope_y"))
    return G.plane_fit(cells(t), "hi").select("x", "y", C.tier(slope, [(2, "strict"), (5, "rolling")], "constrained").alias("band"))


WAYS = {"row": ("y", "x"), "column": ("x", "y"), "diagonal": ("x - y", "y"), "counter": ("x + y", "y")}


@query(QUERIES, " UNION ALL ".join(f"SELECT '{way}' AS way, line::INT AS line, max(n)::BIGINT AS longest FROM (SELECT {line} AS line, count(*) AS n FROM (SELECT *, {at} - row_number() OVER (PARTITION BY {line} ORDER BY {at}) AS island FROM {CLEAR}) GROUP BY {line}, island) GROUP BY line" for way, (line, at) in WAYS.items()))
def q_longest_run(t: Tables) -> DataFrame:
    return G.longest_runs(clear(t))


@query(QUERIES, f"WITH g AS (SELECT x.i AS x, y.i AS y, coalesce((lo >= 10)::INT, 0) AS v FROM range(128) x(i), range(128) y(i) LEFT JOIN {CELLS} c ON c.x = x.i AND c.y = y.i) SELECT a.x::INT AS x, a.y::INT AS y, sum(b.v)::BIGINT AS total FROM g a JOIN g b ON b.x BETWEEN a.x AND a.x + 3 AND b.y BETWEEN a.y AND a.y + 2 WHERE a.x <= 124 AND a.y <= 125 GROUP BY 1, 2 HAVING sum(b.v) = 12")
def q_integral_window(t: Tables) -> DataFrame:
    grid = t.spark.range(128 * 128).select((F.col("id") % 128).cast("int").alias("x"), F.floor(F.col("id") / 128).cast("int").alias("y"))
    full = grid.join(clear(t).withColumn("v", F.lit(1)), ["x", "y"], "left").na.fill(0, ["v"])
    return G.window_sum(G.integral(full, "v"), 4, 3).where("total = 12").select("x", "y", "total")


@query(QUERIES, f"""WITH RECURSIVE c AS (SELECT x, y FROM {CELLS} WHERE lo >= 16), r(x, y, label) USING KEY (x, y) AS (SELECT x, y, y * 128 + x FROM c UNION (SELECT c.x, c.y, min(r.label) FROM r JOIN c ON abs(r.x - c.x) + abs(r.y - c.y) = 1 JOIN recurring.r o ON o.x = c.x AND o.y = c.y GROUP BY c.x, c.y, o.label HAVING min(r.label) < o.label)) SELECT x, y, label::BIGINT AS label FROM r""")
def q_components(t: Tables) -> DataFrame:
    return G.label_components(cells(t).where("lo >= 16").select("x", "y"), 128).select("x", "y", "label")


@query(QUERIES, f"""WITH RECURSIVE c AS (SELECT x, y FROM {CELLS} WHERE lo >= 16), r(x, y, label) USING KEY (x, y) AS (SELECT x, y, y * 128 + x FROM c UNION (SELECT c.x, c.y, min(r.label) FROM r JOIN c ON abs(r.x - c.x) <= 1 AND c.y BETWEEN r.y - 1 AND r.y + 1 JOIN recurring.r o ON o.x = c.x AND o.y = c.y GROUP BY c.x, c.y, o.label HAVING min(r.label) < o.label))
SELECT label::BIGINT AS label, count(*)::BIGINT AS cells, sqrt((max(x) - min(x) + 1) ** 2 + (max(y) - min(y) + 1) ** 2) AS diagonal FROM r GROUP BY 1 HAVING sqrt((max(x) - min(x) + 1) ** 2 + (max(y) - min(y) + 1) ** 2) >= 4""")
def q_long_components(t: Tables) -> DataFrame:
    """Components with corner contact whose bounding box has a diagonal of 4 cells or more."""
    found = G.label_components(cells(t).where("lo >= 16").select("x", "y"), 128, diagonal=True)
    box = found.groupBy("label").agg(F.count("*").alias("cells"), F.sqrt(F.pow(F.max("x") - F.min("x") + 1, F.lit(2)) + F.pow(F.max("y") - F.min("y") + 1, F.lit(2))).alias("diagonal"))
    return box.where("diagonal >= 4")


@query(QUERIES)
def q_single_link(t: Tables) -> DataFrame:
    """Groups of all points that steps of half a degree connect; in SQL a quadratic self join, so tested by brute force."""
    return J.linked_within(points(t).select("id", "lon", "lat"), "id", 0.5).select(F.col("node").alias("id"), F.col("component").alias("root"))


@query(QUERIES, "WITH RECURSIVE n AS (SELECT count(*) AS n FROM pages), l AS (SELECT page_id, (page_id * 7 + 1) % n AS a, (page_id * page_id + 3) % n AS b FROM pages, n), s AS (SELECT 0::BIGINT AS page_id UNION SELECT unnest([a, b]) FROM s JOIN l USING (page_id)) SELECT page_id FROM s")
def q_crawl_closure(t: Tables) -> DataFrame:
    """Pages reached from page 0: each page expanded once, long chains at a time."""
    n = t.pages.count()
    links = t.pages.select("page_id", F.explode(F.array((F.col("page_id") * 7 + 1) % n, (F.col("page_id") * F.col("page_id") + 3) % n)).alias("to"))
    return reachable(links.select(F.col("page_id").alias("src"), F.col("to").alias("dst")), t.spark.range(1).select(F.col("id").alias("node"))).select(F.col("node").alias("page_id"))


@query(QUERIES, "SELECT p_partkey, round(degrees(atan(sinh(pi() * (1 - 2 * (p_partkey % 64) / 64.0)))), 9) AS north, (p_partkey % 64) / 64.0 * 360 - 180 AS west FROM part")
def q_tile_bounds(t: Tables) -> DataFrame:
    tile = F.col("p_partkey") % 64
    return t.part.select("p_partkey", F.round(C.tile_north(F.lit(6), tile), 9).alias("north"), (tile / 64.0 * 360 - 180).alias("west"))


TX = "least(63, greatest(0, floor(({c} + 180) / 360 * 64)))::INT"
TY = "least(63, greatest(0, floor((1 - asinh(tan(radians({c}))) / pi()) / 2 * 64)))::INT"


@query(QUERIES, f"SELECT box, x::INT AS tile_x, y::INT AS tile_y FROM {BOXES}, range({TX.format(c='west')}, {TX.format(c='east')} + 1) a(x), range({TY.format(c='least(north, 85.0)')}, {TY.format(c='greatest(south, -85.0)')} + 1) b(y)")
def q_tile_cover(t: Tables) -> DataFrame:
    return G.tile_cover(boxes(t), 6).select("box", "tile_x", "tile_y")


@query(QUERIES, "SELECT o_orderkey, 'z6/' || ((o_custkey % 512) // 8) || '/' || ((o_orderkey % 512) // 8) AS package FROM orders")
def q_package_root(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", F.concat_ws("/", F.lit("z6"), F.expr("((o_custkey % 512) div 8)").cast("string"), F.expr("((o_orderkey % 512) div 8)").cast("string")).alias("package"))


@query(QUERIES, f"SELECT DISTINCT lon::INT AS lon, lat::INT AS lat FROM {BOXES}, range(floor(west)::INT, greatest(ceil(east)::INT - 1, floor(west)::INT) + 1) a(lon), range(floor(south)::INT, greatest(ceil(north)::INT - 1, floor(south)::INT) + 1) b(lat)")
def q_degree_tiles(t: Tables) -> DataFrame:
    return G.degree_tiles(boxes(t))


@query(QUERIES, f"SELECT DISTINCT (lon * 2)::INT AS lon, (lat * 2)::INT AS lat FROM {BOXES}, range(floor(west / 2)::INT, greatest(ceil(east / 2)::INT - 1, floor(west / 2)::INT) + 1) a(lon), range(floor(south / 2)::INT, greatest(ceil(north / 2)::INT - 1, floor(south / 2)::INT) + 1) b(lat)")
def q_terrain_blocks(t: Tables) -> DataFrame:
    return G.degree_tiles(boxes(t), 2.0).select((F.col("lon") * 2).alias("lon"), (F.col("lat") * 2).alias("lat"))


@query(QUERIES, f"SELECT x // 8 AS bx, y // 8 AS by_, count(*)::BIGINT AS tiles FROM {CELLS} GROUP BY 1, 2")
def q_terrain_batches(t: Tables) -> DataFrame:
    return cells(t).groupBy(F.expr("x div 8").cast("int").alias("bx"), F.expr("y div 8").cast("int").alias("by_")).agg(F.count("*").alias("tiles"))


@query(QUERIES, f"SELECT box, (x // 8 - 20000)::INT AS shard_x, (y // 8 - 20000)::INT AS shard_y, greatest(west, (x - 160000) / 8.0) AS west, greatest(south, (y - 160000) / 8.0) AS south, least(east, (x - 159999) / 8.0) AS east, least(north, (y - 159999) / 8.0) AS north FROM {BOXES}, range(floor(west * 8)::INT + 160000, ceil(east * 8)::INT + 160000) a(x), range(floor(south * 8)::INT + 160000, ceil(north * 8)::INT + 160000) b(y)")
def q_chunk_cover(t: Tables) -> DataFrame:
    """Chunks of an eighth of a degree of every box, both ways, clipped to it, and the degree that holds each."""
    c = F.col
    span = lambda a, b: F.explode(F.sequence(F.floor(c(a) * 8).cast("int"), F.ceil(c(b) * 8).cast("int") - 1))
    chunks = boxes(t).withColumn("x", span("west", "east")).withColumn("y", span("south", "north"))
    shards = [F.floor(c(k) / 8).cast("int").alias(f"shard_{k}") for k in "xy"]
    low = [F.greatest(e, c(k) / 8.0).alias(e) for e, k in (("west", "x"), ("south", "y"))]
    return chunks.select("box", *shards, *low, *[F.least(e, (c(k) + 1) / 8.0).alias(e) for e, k in (("east", "x"), ("north", "y"))])


@query(QUERIES, f"SELECT box, round(west - d / (111320 * c), 9) AS west, round(south - d / 111320.0, 9) AS south, round(east + d / (111320 * c), 9) AS east, round(north + d / 111320.0, 9) AS north FROM (SELECT *, 1000 AS d, cos(radians((south + north) / 2)) AS c FROM {BOXES})")
def q_expand_bounds(t: Tables) -> DataFrame:
    return G.expanded(boxes(t), F.lit(1000)).select("box", *[F.round(c, 9).alias(c) for c in ("west", "south", "east", "north")])


@query(QUERIES, f"SELECT id, round(2 * 6371008.8 * asin(least(1.0, sqrt(sin(radians(40 - lat) / 2) ** 2 + cos(radians(lat)) * cos(radians(40)) * sin(radians(-75 - lon) / 2) ** 2))), 3) AS metres FROM {POINTS}")
def q_haversine(t: Tables) -> DataFrame:
    return points(t).select("id", F.round(C.haversine(F.col("lon"), F.col("lat"), F.lit(-75.0), F.lit(40.0)), 3).alias("metres"))


def holed(t: Tables) -> DataFrame:
    """Triangles, the lower right halves of the boxes, each with a rectangular hole: rings of edges."""
    c, w, h = F.col, F.col("east") - F.col("west"), F.col("north") - F.col("south")
    edge = lambda *e: F.struct(*[x.alias(n) for x, n in zip(e, ("x1", "y1", "x2", "y2"), strict=True)])
    ring = lambda *p: F.array(*[edge(*a, *b) for a, b in zip(p, [*p[1:], p[0]], strict=True)])
    a, b, e, f = c("east") - w / 4, c("east") - w / 8, c("south") + h / 8, c("south") + h / 4
    outer = ring((c("west"), c("south")), (c("east"), c("north")), (c("east"), c("south")))
    return boxes(t).withColumn("rings", F.array(outer, ring((a, e), (b, e), (b, f), (a, f))))


@query(QUERIES, f"SELECT box, round((east - west) * (north - south) * (1 / 2.0 - 1 / 64.0), 9) AS area FROM {BOXES}")
def q_ring_area(t: Tables) -> DataFrame:
    return holed(t).select("box", F.round(G.polygon_area(F.col("rings")), 9).alias("area"))


@query(QUERIES, f"SELECT x // 8 AS bx, y // 8 AS by_ FROM {CELLS} GROUP BY 1, 2 HAVING max(lo) >= 20 AND max(hi) >= 45 AND max(lines) = 7")
def q_possible_chunks(t: Tables) -> DataFrame:
    coarse = cells(t).groupBy(F.expr("x div 8").cast("int").alias("bx"), F.expr("y div 8").cast("int").alias("by_")).agg(F.max("lo").alias("a"), F.max("hi").alias("b"), F.max("lines").alias("c"))
    return coarse.where("a >= 20 and b >= 45 and c = 7").select("bx", "by_")


@query(QUERIES, f"SELECT x // 8 AS bx, y // 8 AS by_, bit_or(CASE WHEN (y % 8) * 8 + x % 8 = 63 THEN (-9223372036854775808)::BIGINT ELSE 1::BIGINT << least(62, (y % 8) * 8 + x % 8)::INT END)::BIGINT AS mask FROM {CELLS} GROUP BY 1, 2")
def q_tile_mask(t: Tables) -> DataFrame:
    """All 64 cells of a block as bits of a long."""
    bit = F.expr("shiftleft(1L, (y % 8) * 8 + x % 8)")
    return cells(t).groupBy(F.expr("x div 8").cast("int").alias("bx"), F.expr("y div 8").cast("int").alias("by_")).agg(F.bit_or(bit).alias("mask"))


@query(QUERIES, f"WITH c AS {CELLS}, p AS (SELECT x // 2 AS x, y // 2 AS y, max(hi) AS hi FROM c WHERE lines = 7 GROUP BY 1, 2) SELECT c.x, c.y, CASE WHEN lines = 7 THEN c.hi ELSE p.hi END AS hi, CASE WHEN lines = 7 THEN 'own' WHEN p.hi IS NOT NULL THEN 'parent' ELSE 'none' END AS origin FROM c LEFT JOIN p ON p.x = c.x // 2 AND p.y = c.y // 2")
def q_resolve_tile(t: Tables) -> DataFrame:
    own = cells(t)
    parent = own.where("lines = 7").groupBy(F.expr("x div 2").alias("px"), F.expr("y div 2").alias("py")).agg(F.max("hi").alias("p_hi"))
    joined = own.withColumns({"px": F.expr("x div 2"), "py": F.expr("y div 2")}).join(parent, ["px", "py"], "left")
    mine = F.col("lines") == 7
    return joined.select("x", "y", F.when(mine, F.col("hi")).otherwise(F.col("p_hi")).alias("hi"), F.when(mine, "own").when(F.col("p_hi").isNotNull(), "parent").otherwise("none").alias("origin"))


@query(QUERIES)
def q_median_split(t: Tables) -> DataFrame:
    rows = points(t).select("id", F.col("lon").alias("x"), F.col("lat").alias("y"))
    return G.median_split(rows, "id", 500).groupBy("part").agg(F.count("*").alias("n"), F.min("x").alias("west"), F.max("x").alias("east"))


T20 = [t.replace("* 64", "* 1048576").replace("least(63", "least(1048575") for t in (TX, TY)]


@query(QUERIES, f"""WITH p AS (SELECT {T20[0].format(c="lon")} AS x, {T20[1].format(c="lat")} AS y FROM {POINTS}), c AS (SELECT z::INT AS z, x >> (20 - z)::INT AS x, y >> (20 - z)::INT AS y, count(*)::BIGINT AS n FROM p, range(21) r(z) GROUP BY 1, 2, 3)
SELECT c.z, c.x, c.y, c.n AS rows FROM c LEFT JOIN c u ON u.z = c.z - 1 AND u.x = c.x >> 1 AND u.y = c.y >> 1 WHERE (c.n <= 500 OR c.z = 20) AND (c.z = 0 OR u.n > 500)""")
def q_quad_split(t: Tables) -> DataFrame:
    return quad_blocks(points(t).select(C.tile_x(F.col("lon"), 20).alias("x"), C.tile_y(F.col("lat"), 20).alias("y")), 500)


RASTER = f"""WITH s AS (SELECT *, unnest(range(floor(south * 4)::BIGINT, ceil(north * 4)::BIGINT)) AS k, east - west AS w, north - south AS h FROM {BOXES}), y AS (SELECT *, (k + 0.5) / 4 AS y FROM s),
r AS (SELECT *, west + w * (y - south) / h AS x0, y > south + h / 8 AND y <= south + h / 4 AS holed FROM y WHERE y > south AND y <= north),
p AS (SELECT box, k, x0 AS a, CASE WHEN holed THEN east - w / 4 ELSE east END AS b FROM r UNION ALL SELECT box, k, east - w / 8, east FROM r WHERE holed)
SELECT box, k, floor(a * 4 + 0.5)::BIGINT AS first, ceil(b * 4 - 0.5)::BIGINT - 1 AS last FROM p WHERE floor(a * 4 + 0.5) <= ceil(b * 4 - 0.5) - 1"""


@query(QUERIES, RASTER)
def q_rasterize(t: Tables) -> DataFrame:
    """Spans of quarter-degree samples inside triangles with holes."""
    return G.rasterized(holed(t), "box", F.flatten("rings"), 4)


COVERED = f"""WITH r AS (SELECT box AS region, west, south, east, north FROM {BOXES} WHERE size > 40), o AS (SELECT a.*, greatest(b.west, a.west) AS w, least(b.east, a.east) AS e, greatest(b.south, a.south) AS s, least(b.north, a.north) AS n FROM r a JOIN {BOXES} b ON b.size <= 40 AND b.west < a.east AND b.east > a.west AND b.south < a.north AND b.north > a.south),
x AS (SELECT region, west AS x FROM r UNION SELECT region, east FROM r UNION SELECT region, w FROM o UNION SELECT region, e FROM o), y AS (SELECT region, south AS y FROM r UNION SELECT region, north FROM r UNION SELECT region, s FROM o UNION SELECT region, n FROM o),
xs AS (SELECT region, (x + lead(x) OVER (PARTITION BY region ORDER BY x)) / 2 AS x FROM x), ys AS (SELECT region, (y + lead(y) OVER (PARTITION BY region ORDER BY y)) / 2 AS y FROM y),
g AS (SELECT xs.region, bool_and(EXISTS (SELECT 1 FROM o WHERE o.region = xs.region AND w < x AND x < e AND s < y AND y < n)) AS whole FROM xs JOIN ys ON xs.region = ys.region WHERE x IS NOT NULL AND y IS NOT NULL GROUP BY 1)
SELECT region, CASE WHEN region NOT IN (SELECT region FROM o) THEN 'unavailable' WHEN whole THEN 'available' ELSE 'partial' END AS state FROM g"""


@query(QUERIES, COVERED)
def q_coverage_state(t: Tables) -> DataFrame:
    return J.coverage_state(boxes(t).where("size > 40"), boxes(t).where("size <= 40"), "box", 5.0).withColumnRenamed("box", "region")


@query(QUERIES)
def q_qualify(t: Tables) -> DataFrame:
    """Components of clear cells that hold a straight run of four: preferred cells first, fallback ones only where uncovered."""
    both = cells(t)
    preferred, fallback = both.where("lo >= 16").select("x", "y"), both.where("lo >= 13").select("x", "y")
    out = None
    for name, mask in (("preferred", preferred), ("fallback", fallback)):
        found = G.label_components(mask, 128)
        across = G.runs(found, F.struct("label", "y"), F.col("x")).select(F.col("line.label").alias("label"), "length")
        along = G.runs(found, F.struct("label", "x"), F.col("y")).select(F.col("line.label").alias("label"), "length")
        good = across.unionByName(along).groupBy("label").agg(F.max("length").alias("longest")).where("longest >= 4")
        kept = found.join(good, "label").select("x", "y", "label", "longest", F.lit(name).alias("role"))
        out = kept if out is None else out.unionByName(kept.join(out.select("x", "y"), ["x", "y"], "left_anti"))
    return out
