"""Queries over filed history and other aggregations."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger.functions.storage import checkpointed
from skyledger.operators import aggregates as A

from .bindings import BOXES, CELLS, HISTORY, POINTS, boxes, cells, history, points
from .query import Query, Tables, query

QUERIES: list[Query] = []
FILED = f"(SELECT origin, destination, route, coalesce(engine, 'Unknown') AS engine, sum(uses)::BIGINT AS uses, min(seen) AS first_seen, max(seen) AS last_seen FROM {HISTORY} WHERE label IN ('F', 'O') AND uses > 0 GROUP BY ALL)"


@query(QUERIES, f"SELECT * FROM {FILED}")
def q_filed_history(t: Tables) -> DataFrame:
    return A.filed_history(history(t), ("F", "O"))


@query(QUERIES, f"""WITH r AS (SELECT origin, destination, route, sum(uses)::BIGINT AS uses, string_agg(engine || '=' || uses, ',' ORDER BY engine) AS engines FROM {FILED} GROUP BY ALL)
SELECT origin, destination, sum(uses) OVER (PARTITION BY origin, destination)::BIGINT AS total, row_number() OVER (PARTITION BY origin, destination ORDER BY uses DESC, route)::INT AS place, route, uses, engines FROM r""")
def q_route_pairs(t: Tables) -> DataFrame:
    pairs = A.route_pairs(A.filed_history(history(t), ("F", "O")))
    flat = pairs.select("origin", "destination", "total", F.posexplode("routes").alias("place", "r"), F.col("engines").alias("all"))
    text = F.array_join(F.transform(F.map_entries(F.element_at("all", F.col("r.route"))), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ",")
    return flat.select("origin", "destination", "total", (F.col("place") + 1).alias("place"), "r.route", "r.uses", text.alias("engines"))


@query(QUERIES, f"SELECT count(*) FILTER (uses <= 0)::BIGINT AS unused, count(*) FILTER (engine IS NULL)::BIGINT AS no_engine, count(*) FILTER (seen < TIMESTAMP '1996-01-01')::BIGINT AS early FROM {HISTORY}")
def q_invalid_facts(t: Tables) -> DataFrame:
    return A.invalid_facts(history(t), unused=F.col("uses") <= 0, no_engine=F.col("engine").isNull(), early=F.col("seen") < "1996-01-01")


@query(QUERIES, f"SELECT origin, destination, route, sum(uses)::BIGINT AS uses, round(sum(uses)::DOUBLE / sum(sum(uses)) OVER (PARTITION BY origin, destination), 9) AS share FROM {FILED} GROUP BY origin, destination, route")
def q_route_share(t: Tables) -> DataFrame:
    routes = A.filed_history(history(t), ("F", "O")).groupBy("origin", "destination", "route").agg(F.sum("uses").alias("uses"))
    pair = F.sum("uses").over(Window.partitionBy("origin", "destination"))
    return routes.withColumn("share", F.round(F.col("uses") / pair, 9))


@query(QUERIES, f"SELECT count(*)::BIGINT AS n, count(*) FILTER (lat > 0)::BIGINT AS north, count(*) FILTER (lon > 0)::BIGINT AS east, min(lon) AS west_edge, max(lon) AS east_edge, min(lat) AS south_edge, max(lat) AS north_edge FROM {POINTS}")
def q_dataset_stats(t: Tables) -> DataFrame:
    return points(t).agg(F.count("*").alias("n"), F.count_if(F.col("lat") > 0).alias("north"), F.count_if(F.col("lon") > 0).alias("east"), F.min("lon").alias("west_edge"), F.max("lon").alias("east_edge"), F.min("lat").alias("south_edge"), F.max("lat").alias("north_edge"))


@query(QUERIES, "SELECT o_orderkey, nullif(max(l_quantity - 25), 0) AS longest FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey")
def q_longest_child(t: Tables) -> DataFrame:
    longest = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max(F.col("l_quantity") - 25).alias("m"))
    return t.orders.select("o_orderkey").join(longest, "o_orderkey", "left").select("o_orderkey", F.nullif(F.col("m"), F.lit(0.0)).alias("longest"))


@query(QUERIES, "SELECT l_orderkey, l_returnflag, l_linestatus, (count(*) - 1)::BIGINT AS dropped FROM lineitem GROUP BY 1, 2, 3 HAVING count(*) > 1")
def q_duplicate_service(t: Tables) -> DataFrame:
    return A.distinct_records(t.lineitem, ["l_orderkey", "l_returnflag", "l_linestatus"])[1]


@query(QUERIES, "SELECT l_suppkey, bit_or(1 << l_linenumber)::BIGINT AS flags, (bit_or(1 << l_linenumber) & ~2)::BIGINT AS masked FROM lineitem GROUP BY 1")
def q_bit_or_flags(t: Tables) -> DataFrame:
    flags = F.bit_or(F.expr("shiftleft(1, l_linenumber)").cast("long"))
    return t.lineitem.groupBy("l_suppkey").agg(flags.alias("flags"), flags.bitwiseAND(F.lit(~2)).alias("masked"))


@query(QUERIES, f"SELECT x // 2 AS x, y // 2 AS y, max(hi) AS hi FROM {CELLS} GROUP BY 1, 2")
def q_downsample_max(t: Tables) -> DataFrame:
    return A.downsample_max(cells(t), "hi")


@query(QUERIES, f"SELECT x // 2 AS x, y // 2 AS y, CASE WHEN count(lo) = 4 THEN floor(sum(lo) / 4 + 0.5)::DOUBLE END AS lo FROM {CELLS} GROUP BY 1, 2")
def q_downsample_avg(t: Tables) -> DataFrame:
    return A.downsample_average(cells(t), "lo").withColumn("lo", F.col("lo").cast("double"))


AREA = "(tanh(pi() * (1 - ({r}) / 64.0)) - tanh(pi() * (1 - ({r} + 1) / 64.0)))"
SHARE = "round(sum(CASE WHEN {test} THEN " + AREA.format(r="y") + " ELSE 0 END) / (4 * (" + " + ".join(AREA.format(r=f"y // 4 * 4 + {i}") for i in range(4)) + ")), 9)"


@query(QUERIES, f"SELECT y // 4 AS band, x // 4 AS block, {SHARE.format(test='lo >= 16')} AS preferred, {SHARE.format(test='lo >= 13 AND lo < 16')} AS fallback, {SHARE.format(test='true')} AS known FROM {CELLS} GROUP BY 1, 2, {', '.join(AREA.format(r=f'y // 4 * 4 + {i}') for i in range(4))}")
def q_density(t: Tables) -> DataFrame:
    """Shares of each block of 4 x 4 samples that are preferred, fallback where not preferred, and known at all.

    Rows weigh by their area on the sphere, with 128 rows of samples from pole to pole of the map."""
    edge = lambda row: F.tanh(F.lit(math.pi) * (1 - row / 64.0))
    area = lambda row: edge(row) - edge(row + 1)
    bit = F.expr("shiftleft(1, (y % 4) * 4 + x % 4)")
    mask = lambda test: F.bit_or(F.when(test, bit).otherwise(0))
    masks = cells(t).groupBy(F.expr("y div 4").cast("int").alias("band"), F.expr("x div 4").cast("int").alias("block")).agg(mask(F.col("lo") >= 16).alias("preferred"), mask(F.col("lo") >= 13).alias("fallback"), F.bit_or(bit).alias("known"))
    masks = masks.withColumn("fallback", F.col("fallback").bitwiseAND(F.bitwise_not("preferred")))
    rows = [area(F.col("band") * 4 + i) for i in range(4)]
    share = lambda c: sum((F.bit_count(F.shiftright(c, 4 * i).bitwiseAND(F.lit(15))) * rows[i] for i in range(4)), F.lit(0.0)) / (4 * sum(rows[1:], rows[0]))
    return masks.select("band", "block", *[F.round(share(c), 9).alias(c) for c in ("preferred", "fallback", "known")])


def rolled_sql(level: int) -> str:
    rows, source = 128 >> level, f"r{level - 1}" if level else "c"
    area = lambda y: f"(tanh(pi() * (1 - 2 * ({y}) / {rows}.0)) - tanh(pi() * (1 - 2 * ({y} + 1) / {rows}.0)))"
    return f"r{level} AS (SELECT x, y, d / (2 * ({area('2 * y')} + {area('2 * y + 1')})) AS d FROM (SELECT x // 2 AS x, y // 2 AS y, sum(d * {area('y')}) AS d FROM {source} GROUP BY 1, 2))"


@query(QUERIES, f"WITH c AS (SELECT x, y, lo AS d FROM {CELLS}), {', '.join(map(rolled_sql, range(3)))} SELECT x, y, round(d, 6) AS d FROM r2")
def q_density_rollup(t: Tables) -> DataFrame:
    level = cells(t).select("x", "y", F.col("lo").alias("d"))
    for rows in (128, 64, 32):
        level = A.density_rollup(level, "d", rows)
    return level.withColumn("d", F.round("d", 6))


@query(QUERIES, f"""WITH RECURSIVE p AS (SELECT 7 AS z, x, y, hi FROM {CELLS} UNION ALL SELECT z - 1, x // 2, y // 2, max(hi) FROM p WHERE z > 0 GROUP BY 1, 2, 3) SELECT z, x, y, max(hi) AS hi FROM p GROUP BY 1, 2, 3""")
def q_pyramid(t: Tables) -> DataFrame:
    level = cells(t).select("x", "y", "hi")
    out = level.select(F.lit(7).alias("z"), "*")
    for z in range(6, -1, -1):
        level = checkpointed(A.downsample_max(level, "hi"))  # else each level would compute all below it again
        out = out.unionByName(level.select(F.lit(z).alias("z"), "*"))
    return out


@query(QUERIES, f"""WITH s AS (SELECT lines AS g, count(*) n, sum(x) sx, sum(y) sy, sum(lo) sz, sum(x*x) sxx, sum(y*y) syy, sum(x*y) sxy, sum(x*lo) sxz, sum(y*lo) syz FROM {CELLS} GROUP BY 1),
c AS (SELECT g, n, sxx - sx*sx/n a, syy - sy*sy/n b, sxy - sx*sy/n c, sxz - sx*sz/n p, syz - sy*sz/n q FROM s)
SELECT g, n::BIGINT AS n, round((p*b - q*c)/(a*b - c*c), 9) AS slope_x, round((q*a - p*c)/(a*b - c*c), 9) AS slope_y FROM c""")
def q_lsq_grade(t: Tables) -> DataFrame:
    rows = cells(t).select(F.col("lines").alias("g"), F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"), F.col("lo").alias("z"))
    fit = A.least_squares(rows, ["g"], "x", "y", "z")
    return fit.select("g", "n", F.round("slope_x", 9).alias("slope_x"), F.round("slope_y", 9).alias("slope_y"))


@query(QUERIES, f"""WITH s AS (SELECT lines AS g, avg(x) mx, avg(y) my, avg(x*x) xx, avg(y*y) yy, avg(x*y) xy FROM {CELLS} GROUP BY 1) SELECT g, round(0.5 * atan2(2 * (xy - mx*my), (xx - mx*mx) - (yy - my*my)), 6) AS angle FROM s""")
def q_principal_angle(t: Tables) -> DataFrame:
    m = cells(t).groupBy(F.col("lines").alias("g")).agg(F.avg("x").alias("mx"), F.avg("y").alias("my"), F.avg(F.col("x") * F.col("x")).alias("xx"), F.avg(F.col("y") * F.col("y")).alias("yy"), F.avg(F.col("x") * F.col("y")).alias("xy"))
    return m.select("g", F.round(F.expr("0.5D * atan2(2 * (xy - mx*my), (xx - mx*mx) - (yy - my*my))"), 6).alias("angle"))


@query(QUERIES, "WITH r AS (SELECT o_totalprice v, row_number() OVER (ORDER BY o_totalprice) - 1 AS k, count(*) OVER () AS n FROM orders) SELECT max(v) FILTER (k = floor(n * 0.5)) AS p50, max(v) FILTER (k = floor(n * 0.95)) AS p95, max(v) FILTER (k = floor(n * 0.99)) AS p99, max(v) AS largest FROM r")
def q_size_distribution(t: Tables) -> DataFrame:
    return A.nearest_rank(t.orders, "o_totalprice", {"p50": 0.5, "p95": 0.95, "p99": 0.99})


@query(QUERIES, r"SELECT regexp_extract(url, '^https?://([^/]+)', 1) AS host, sum(strlen(html))::BIGINT AS bytes, count(*)::BIGINT AS files FROM pages GROUP BY 1")
def q_component_bytes(t: Tables) -> DataFrame:
    return t.pages.groupBy(F.regexp_extract("url", "^https?://([^/]+)", 1).alias("host")).agg(F.sum(F.octet_length("html")).alias("bytes"), F.count("*").alias("files"))


@query(QUERIES, f"SELECT floor(lon)::INT AS lon_degree, floor(lat)::INT AS lat_degree, count(*)::BIGINT AS n FROM {POINTS} WHERE lon BETWEEN -125.5 AND -65.5 AND lat BETWEEN 23.5 AND 50.5 GROUP BY 1, 2")
def q_viewport_counts(t: Tables) -> DataFrame:
    halo = 0.5
    seen = points(t).where(F.col("lon").between(-125 - halo, -66 + halo) & F.col("lat").between(24 - halo, 50 + halo))
    return seen.groupBy(F.floor("lon").cast("int").alias("lon_degree"), F.floor("lat").cast("int").alias("lat_degree")).agg(F.count("*").alias("n"))


@query(QUERIES, f"SELECT size, min(west) AS west, min(south) AS south, max(east) AS east, max(north) AS north FROM {BOXES} GROUP BY size")
def q_union_bounds(t: Tables) -> DataFrame:
    return boxes(t).groupBy("size").agg(F.min("west").alias("west"), F.min("south").alias("south"), F.max("east").alias("east"), F.max("north").alias("north"))


@query(QUERIES, "SELECT l_linestatus AS source, count(*)::BIGINT AS cells, count(*) FILTER (l_quantity >= 10)::BIGINT AS clear, count(*) FILTER (l_quantity >= 10 AND l_discount < 0.05)::BIGINT AS sloped, count(DISTINCT l_partkey) FILTER (l_quantity < 10)::BIGINT AS lost FROM lineitem GROUP BY 1")
def q_screening_funnel(t: Tables) -> DataFrame:
    clear = F.col("l_quantity") >= 10
    return t.lineitem.groupBy(F.col("l_linestatus").alias("source")).agg(F.count("*").alias("cells"), F.count_if(clear).alias("clear"), F.count_if(clear & (F.col("l_discount") < 0.05)).alias("sloped"), F.count_distinct(F.when(~clear, F.col("l_partkey"))).alias("lost"))


@query(QUERIES, "SELECT c_custkey, sha256(concat_ws(chr(10), c_custkey::VARCHAR, c_name, c_mktsegment)) AS fingerprint FROM customer")
def q_row_fingerprint(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", F.sha2(F.concat_ws("\n", F.col("c_custkey").cast("string"), "c_name", "c_mktsegment"), 256).alias("fingerprint"))
