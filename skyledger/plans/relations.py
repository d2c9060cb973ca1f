"""Queries over data quality, joins and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger.operators import joins as J
from skyledger.operators import quality as Q
from skyledger.operators.review import scene_review
from skyledger.sources import sinks as K
from skyledger.sources.readers import listing_products, overlaps

from .bindings import BOXES, POINTS, boxes, points
from .query import Query, Tables, query

QUERIES: list[Query] = []


@query(QUERIES, "SELECT v AS value, string_agg(t, ',' ORDER BY t) AS tables FROM (SELECT DISTINCT l_returnflag AS v, 'a' AS t FROM lineitem UNION SELECT DISTINCT o_orderstatus, 'b' FROM orders) GROUP BY 1")
def q_single_edition(t: Tables) -> DataFrame:
    return Q.single_value({"a": t.lineitem.select(F.col("l_returnflag").alias("e")), "b": t.orders.select(F.col("o_orderstatus").alias("e"))}, "e")


@query(QUERIES, "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> CASE o_orderpriority WHEN '1-URGENT' THEN 'F' ELSE 'O' END")
def q_expected_edition(t: Tables) -> DataFrame:
    expected = t.orders.select("o_orderpriority").distinct().withColumn("expected", F.when(F.col("o_orderpriority") == "1-URGENT", "F").otherwise("O"))
    return Q.unexpected(t.orders, expected, "o_orderpriority", "o_orderstatus").select("o_orderkey", "o_orderstatus")


@query(QUERIES, "SELECT l_orderkey, l_linenumber, count(*)::BIGINT AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def q_duplicate_keys(t: Tables) -> DataFrame:
    return Q.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(QUERIES, "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def q_orphans(t: Tables) -> DataFrame:
    return Q.orphans(t.lineitem, t.orders.where("o_orderstatus = 'F'"), "l_orderkey", "o_orderkey").select("l_orderkey", "l_linenumber", "l_partkey")


@query(QUERIES, "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def q_childless(t: Tables) -> DataFrame:
    return Q.childless(t.orders, t.lineitem, "o_orderkey", "l_orderkey").select("o_orderkey")


RULES = [("quantity", "l_quantity < 3"), ("discount", "l_discount > 0.09"), ("line", "l_linenumber > 6")]
REASON = "CASE " + " ".join(f"WHEN {test} THEN '{name}'" for name, test in RULES) + " END"


@query(QUERIES, f"SELECT l_orderkey, l_linenumber, l_partkey, {REASON} AS reason FROM lineitem WHERE {REASON} IS NOT NULL")
def q_exclusion_ledger(t: Tables) -> DataFrame:
    return Q.with_reason(t.lineitem, [(n, F.expr(e)) for n, e in RULES]).where("reason is not null").select("l_orderkey", "l_linenumber", "l_partkey", "reason")


@query(QUERIES, f"SELECT l_returnflag AS \"table\", count(*)::BIGINT AS source, count(*) FILTER ({REASON} IS NULL)::BIGINT AS exported, count(*) FILTER ({REASON} IS NOT NULL)::BIGINT AS excluded FROM lineitem GROUP BY 1")
def q_coverage(t: Tables) -> DataFrame:
    return Q.coverage(Q.with_reason(t.lineitem, [(n, F.expr(e)) for n, e in RULES]), F.col("l_returnflag"))


@query(QUERIES, "SELECT l_suppkey, count(*)::BIGINT AS source, count(*) FILTER (l_quantity >= 3)::BIGINT AS exported, count(*) FILTER (l_quantity < 3) = 0 AS agrees FROM lineitem GROUP BY 1")
def q_reconcile_counts(t: Tables) -> DataFrame:
    nested = t.lineitem.where("l_quantity >= 3").groupBy("l_suppkey", "l_orderkey").agg(F.collect_list("l_linenumber").alias("lines"))
    return Q.reconcile(t.lineitem, nested, "l_suppkey", "lines")


ORDER = "PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice"


@query(QUERIES, f"SELECT l_orderkey, l_linenumber, l_partkey FROM (SELECT *, lead(l_linenumber) OVER ({ORDER}) AS after FROM lineitem) WHERE after IS NOT NULL AND l_linenumber + 1 <> after")
def q_discontinuity(t: Tables) -> DataFrame:
    rows = t.lineitem.withColumn("following", F.col("l_linenumber") + 1)
    return Q.discontinuities(rows, "l_orderkey", ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"], "l_linenumber", "following").select("l_orderkey", "l_linenumber", "l_partkey")


@query(QUERIES, "SELECT o_orderkey, o_orderdate <= TIMESTAMP '1998-01-01' AND TIMESTAMP '1998-01-01' < o_orderdate + INTERVAL 28 DAY AS covers FROM orders")
def q_interval_cover(t: Tables) -> DataFrame:
    day = F.lit("1998-01-01").cast("timestamp")
    return t.orders.select("o_orderkey", ((F.col("o_orderdate") <= day) & (day < F.col("o_orderdate") + F.expr("interval 28 days"))).alias("covers"))


@query(QUERIES, "SELECT 'childless' AS rule, o_orderkey AS key FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) UNION ALL SELECT 'repeated', l_orderkey FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1")
def q_diagnostics(t: Tables) -> DataFrame:
    first = Q.childless(t.orders, t.lineitem, "o_orderkey", "l_orderkey").select(F.lit("childless").alias("rule"), F.col("o_orderkey").alias("key"))
    return first.unionByName(Q.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"]).select(F.lit("repeated").alias("rule"), F.col("l_orderkey").alias("key")))


@query(QUERIES, "WITH m AS (SELECT l_orderkey, count(DISTINCT l_partkey) FILTER (l_returnflag = 'A') AS mains, min(l_partkey) FILTER (l_returnflag = 'A') AS one, count(DISTINCT l_partkey) FILTER (l_returnflag <> 'A')::BIGINT AS transitions FROM lineitem GROUP BY 1) SELECT l_orderkey, CASE WHEN mains = 1 THEN one END::DOUBLE AS main, transitions, CASE WHEN mains = 0 THEN 'missing' WHEN mains > 1 THEN 'multiple' END AS reason FROM m")
def q_main_branch(t: Tables) -> DataFrame:
    return Q.main_branch(t.lineitem, "l_orderkey", "l_partkey", F.col("l_returnflag") != "A").withColumn("main", F.col("main").cast("double"))


@query(QUERIES, f"SELECT a.box AS a, b.box AS b FROM {BOXES} a JOIN {BOXES} b ON a.box < b.box AND a.west < b.east AND a.east > b.west AND a.south < b.north AND a.north > b.south")
def q_overlapping_owners(t: Tables) -> DataFrame:
    return J.bbox_join(boxes(t), boxes(t), 5.0).where("box < b_box").select(F.col("box").alias("a"), F.col("b_box").alias("b"))


@query(QUERIES, f"SELECT box, CASE WHEN west < -160 THEN 'west' WHEN north > 70 THEN 'north' WHEN size < 3 THEN 'small' END AS reason FROM {BOXES} WHERE west < -160 OR north > 70 OR size < 3")
def q_region_reasons(t: Tables) -> DataFrame:
    return Q.with_reason(boxes(t), [("west", F.col("west") < -160), ("north", F.col("north") > 70), ("small", F.col("size") < 3)]).where("reason is not null").select("box", "reason")


@query(QUERIES, "SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_partkey IN (SELECT p_partkey FROM part WHERE p_type = 'ECONOMY') THEN 'kept' ELSE 'no parent' END AS state FROM lineitem")
def q_semi_anti(t: Tables) -> DataFrame:
    parent = t.part.where("p_type = 'ECONOMY'").select(F.col("p_partkey").alias("l_partkey"))
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey").join(parent.distinct().withColumn("held", F.lit(True)), "l_partkey", "left")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", F.when(F.col("held"), "kept").otherwise("no parent").alias("state"))


@query(QUERIES, "SELECT o_orderkey, count(l_orderkey)::INT AS n, coalesce(string_agg(l_linenumber || '/' || l_partkey, ',' ORDER BY l_linenumber, l_partkey), '') AS lines FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1")
def q_nest_children(t: Tables) -> DataFrame:
    nested = J.nest_children(t.orders.select("o_orderkey"), t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey", ["l_linenumber", "l_partkey"], [], "lines")
    return nested.select("o_orderkey", F.size("lines").alias("n"), F.array_join(F.transform("lines", lambda x: F.concat_ws("/", x["l_linenumber"].cast("string"), x["l_partkey"].cast("string"))), ",").alias("lines"))


@query(QUERIES, "SELECT n_nationkey, CASE WHEN count(s_suppkey) = 1 THEN min(s_suppkey) END::DOUBLE AS match, CASE WHEN count(s_suppkey) = 0 THEN 'missing' WHEN count(s_suppkey) > 1 THEN 'ambiguous' END AS reason FROM nation LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 8000) ON s_nationkey = n_nationkey GROUP BY 1")
def q_unique_match(t: Tables) -> DataFrame:
    right = t.supplier.where("s_acctbal > 8000").withColumnRenamed("s_nationkey", "key")
    found = J.unique_match(t.nation.withColumn("key", F.col("n_nationkey")), right, "key", "n_nationkey", "s_suppkey")
    return found.select("n_nationkey", F.col("match").cast("double").alias("match"), "reason")


@query(QUERIES, "SELECT n_nationkey, coalesce(a, b) AS name FROM nation LEFT JOIN (SELECT s_nationkey, CASE WHEN count(DISTINCT s_name) = 1 THEN min(s_name) END AS a FROM supplier WHERE s_acctbal > 8000 GROUP BY 1) ON s_nationkey = n_nationkey LEFT JOIN (SELECT s_nationkey AS k, CASE WHEN count(DISTINCT s_name) = 1 THEN min(s_name) END AS b FROM supplier WHERE s_acctbal > 6000 GROUP BY 1) ON k = n_nationkey")
def q_unique_name(t: Tables) -> DataFrame:
    key = t.supplier.withColumnRenamed("s_nationkey", "n_nationkey")
    first = J.unique_name(key.where("s_acctbal > 8000"), "n_nationkey", "s_name").withColumnRenamed("s_name", "a")
    second = J.unique_name(key.where("s_acctbal > 6000"), "n_nationkey", "s_name").withColumnRenamed("s_name", "b")
    return t.nation.join(first, "n_nationkey", "left").join(second, "n_nationkey", "left").select("n_nationkey", F.coalesce("a", "b").alias("name"))


@query(QUERIES, "SELECT l_orderkey, CASE WHEN count(DISTINCT coalesce(v, '?')) = 1 THEN min(v) END AS v, count(DISTINCT coalesce(v, '?')) > 1 AS conflict FROM (SELECT l_orderkey, nullif(l_returnflag, 'R') AS v FROM lineitem) GROUP BY 1")
def q_conflict_null(t: Tables) -> DataFrame:
    return J.conflict_null(t.lineitem.select("l_orderkey", F.nullif(F.col("l_returnflag"), F.lit("R")).alias("v")), "l_orderkey", "v")


@query(QUERIES, "WITH r AS (SELECT p_size AS name, CASE WHEN p_size % 3 > 0 THEN p_type END AS scope, max(p_partkey) AS ref FROM part GROUP BY 1, 2) SELECT s.p_partkey, coalesce(a.ref, b.ref)::DOUBLE AS ref FROM part s LEFT JOIN r a ON a.name = s.p_size AND a.scope = s.p_type LEFT JOIN r b ON b.name = s.p_size AND b.scope IS NULL")
def q_scoped_lookup(t: Tables) -> DataFrame:
    base = t.part.select("p_partkey", F.col("p_size").alias("name"), F.col("p_type").alias("scope"))
    refs = base.groupBy("name", F.when(F.col("name") % 3 > 0, F.col("scope")).alias("scope")).agg(F.max("p_partkey").alias("ref"))
    return J.scoped_lookup(base, refs, "name", "scope", "ref").select("p_partkey", F.col("ref").cast("double").alias("ref"))


@query(QUERIES, f"SELECT a.box AS a, b.box AS b FROM (SELECT * FROM {BOXES} WHERE size > 40) a JOIN (SELECT * FROM {BOXES} WHERE size <= 40) b ON a.west <= b.east AND a.east >= b.west AND a.south <= b.north AND a.north >= b.south")
def q_bbox_join(t: Tables) -> DataFrame:
    return J.bbox_join(boxes(t).where("size > 40"), boxes(t).where("size <= 40"), 5.0, strict=False).select(F.col("box").alias("a"), F.col("b_box").alias("b"))


@query(QUERIES, f"SELECT id, box FROM {POINTS} JOIN {BOXES} ON lon >= west AND lon < east AND lat >= south AND lat < north")
def q_points_in_boxes(t: Tables) -> DataFrame:
    return J.points_in_boxes(points(t), boxes(t), 5.0).select("id", "box")


@query(QUERIES, f"SELECT box, west, south FROM {BOXES} WHERE west <= -60 AND east >= -120 AND south <= 50 AND north >= 20")
def q_bbox_scan(t: Tables) -> DataFrame:
    return boxes(t).where(overlaps(*map(F.col, ("west", "south", "east", "north")), (-120, 20, -60, 50))).select("box", "west", "south")


@query(QUERIES, f"SELECT id, box FROM {POINTS} JOIN {BOXES} ON lon >= west AND lon < east AND lat >= south AND lat < north WHERE NOT lon < (west - east) * (lat - north) / (south - north) + east")
def q_point_in_polygon(t: Tables) -> DataFrame:
    return J.points_in_polygons(points(t), lower_halves(t), 5.0).select("id", "box")


REVIEW = f"""WITH f AS (SELECT lon, lat, id % 3 AS tier, owner % 2048 AS flags FROM {POINTS}), b AS {BOXES}, s AS (SELECT * FROM b WHERE size > 40),
c AS (SELECT box AS scene, 'west' AS label, west, (west + east) / 2 AS east, south, north FROM s UNION ALL SELECT box, 'east', (west + east) / 2, east, south, north FROM s),
m AS (SELECT 'features' AS measure, NULL AS tier, NULL AS bit UNION ALL SELECT unnest(['preferred', 'fallback']), unnest([2, 1]), NULL UNION ALL SELECT 'flag ' || (1 << k), NULL, 1 << k FROM range(11) x(k))
SELECT box AS scene, measure, NULL::VARCHAR AS label, count(lon)::BIGINT AS n FROM s CROSS JOIN m LEFT JOIN f ON lon BETWEEN west AND east AND lat BETWEEN south AND north AND (m.tier IS NULL OR m.tier = f.tier) AND (bit IS NULL OR flags & bit <> 0) GROUP BY 1, 2
UNION ALL SELECT scene, 'context', label, count(lon)::BIGINT FROM c LEFT JOIN f ON lon BETWEEN west AND east AND lat BETWEEN south AND north GROUP BY 1, 3
UNION ALL SELECT s.box, 'probe', 'centre', count(b.box)::BIGINT FROM s LEFT JOIN b ON (s.west + s.east) / 2 >= b.west AND (s.west + s.east) / 2 < b.east AND (s.south + s.north) / 2 >= b.south AND (s.south + s.north) / 2 < b.north
    AND NOT (s.west + s.east) / 2 < (b.west - b.east) * ((s.south + s.north) / 2 - b.north) / (b.south - b.north) + b.east GROUP BY 1"""


def lower_halves(t: Tables) -> DataFrame:
    """Triangles: the lower right halves of the boxes."""
    edge = lambda *e: F.struct(*[F.col(c).alias(n) for c, n in zip(e, ("x1", "y1", "x2", "y2"), strict=True)])
    return boxes(t).withColumn("edges", F.array(edge("west", "south", "east", "south"), edge("east", "south", "east", "north"), edge("east", "north", "west", "south")))


@query(QUERIES, REVIEW)
def q_scene_review(t: Tables) -> DataFrame:
    scenes = boxes(t).where("size > 40").withColumnRenamed("box", "scene")
    middle, level = (F.col("west") + F.col("east")) / 2, (F.col("south") + F.col("north")) / 2
    west = scenes.withColumn("label", F.lit("west")).withColumn("east", middle)
    east = scenes.withColumn("label", F.lit("east")).withColumn("west", middle)
    features = points(t).select("lon", "lat", (F.col("id") % 3).alias("tier"), (F.col("owner") % 2048).alias("flags"))
    probes = scenes.select("scene", F.lit("centre").alias("label"), middle.alias("lon"), level.alias("lat"))
    return scene_review(features, scenes, west.unionByName(east), probes, lower_halves(t), 5.0)


@query(QUERIES, f"SELECT * FROM (SELECT id, box, max(size) OVER (PARTITION BY id) AS best_size, row_number() OVER (PARTITION BY id ORDER BY size DESC, box)::INT AS place FROM {POINTS} JOIN {BOXES} ON lon >= west AND lon < east AND lat >= south AND lat < north)")
def q_containment_rank(t: Tables) -> DataFrame:
    by_point = Window.partitionBy("id")
    return J.points_in_boxes(points(t), boxes(t), 5.0).select("id", "box", F.max("size").over(by_point).alias("best_size"), F.row_number().over(by_point.orderBy(F.desc("size"), "box")).alias("place"))


@query(QUERIES, f"SELECT p.id, b.box FROM {POINTS} p JOIN {BOXES} b ON sqrt((lon - west) ** 2 + (lat - south) ** 2) <= size / 20.0")
def q_distance_join(t: Tables) -> DataFrame:
    hazards = boxes(t).select("box", F.col("west").alias("b_lon"), F.col("south").alias("b_lat"), (F.col("size") / 20.0).alias("radius"))
    return J.distance_join(points(t), hazards, 2.0).select("id", "box")


@query(QUERIES, f"SELECT box, round(min(sqrt((lon - west) ** 2 + (lat - south) ** 2)), 9) AS distance FROM {BOXES}, {POINTS} GROUP BY box")
def q_nearest(t: Tables) -> DataFrame:
    samples = boxes(t).select("box", F.col("west").alias("lon"), F.col("south").alias("lat"))
    return J.nearest(samples, points(t), "box", 4.0).select("box", F.round("distance", 9).alias("distance"))


@query(QUERIES, "WITH e AS (SELECT DISTINCT o_orderpriority AS name, l_shipdate::TIMESTAMP AS edition FROM lineitem JOIN orders ON l_orderkey = o_orderkey), n AS (SELECT DISTINCT o_orderpriority AS name, o_orderdate::TIMESTAMP AS day FROM orders) SELECT n.name, day::VARCHAR AS day, edition::VARCHAR AS edition FROM n ASOF LEFT JOIN e ON e.name = n.name AND e.edition <= n.day")
def q_asof_edition(t: Tables) -> DataFrame:
    """Editions are all ship dates of a priority."""
    need = t.orders.select(F.col("o_orderpriority").alias("name"), F.col("o_orderdate").cast("timestamp").alias("day"))
    names = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderpriority").alias("name"))
    editions = t.lineitem.join(names, "l_orderkey").select("name", F.col("l_shipdate").cast("timestamp").alias("edition"))
    found = J.as_of(need, editions, "name", "day", "edition")
    return found.select("name", F.date_format("day", "yyyy-MM-dd HH:mm:ss").alias("day"), F.date_format("edition", "yyyy-MM-dd HH:mm:ss").alias("edition"))


@query(QUERIES, """WITH a AS (SELECT s.p_partkey, count(DISTINCT r.p_partkey) AS n, min(r.p_partkey) AS c FROM part s JOIN part r ON r.p_name = s.p_name AND r.p_brand = s.p_brand AND r.p_partkey % 7 = 0 WHERE s.p_partkey % 7 > 0 GROUP BY 1),
b AS (SELECT s.p_partkey, count(DISTINCT r.p_partkey) AS n, min(r.p_partkey) AS c FROM part s JOIN part r ON r.p_name = s.p_name AND r.p_size = s.p_size AND r.p_partkey % 7 = 0 WHERE s.p_partkey % 7 > 0 AND s.p_partkey NOT IN (SELECT p_partkey FROM a) GROUP BY 1)
SELECT p_partkey, rule, CASE WHEN n = 1 THEN 'matched' WHEN n > 1 THEN 'ambiguous' ELSE 'unmatched' END AS status, CASE WHEN n = 1 THEN c END::DOUBLE AS candidate FROM (SELECT p_partkey FROM part WHERE p_partkey % 7 > 0) LEFT JOIN (SELECT *, 'exact' AS rule FROM a UNION ALL SELECT *, 'sized' FROM b) USING (p_partkey)""")
def q_rule_cascade(t: Tables) -> DataFrame:
    left = t.part.where("p_partkey % 7 > 0").select("p_partkey", "p_name", "p_brand", "p_size")
    right = t.part.where("p_partkey % 7 = 0").select(F.col("p_partkey").cast("double").alias("candidate"), "p_name", "p_brand", "p_size")
    return J.rule_cascade(left, "p_partkey", [("exact", right, ["p_name", "p_brand"]), ("sized", right, ["p_name", "p_size"])])


@query(QUERIES, f"SELECT a.box AS region, sum(b.size * 1000)::BIGINT AS bytes, count(*)::BIGINT AS files FROM (SELECT * FROM {BOXES} WHERE size > 45) a JOIN {BOXES} b ON a.west < b.east AND a.east > b.west AND a.south < b.north AND a.north > b.south GROUP BY 1")
def q_region_dependencies(t: Tables) -> DataFrame:
    return J.bbox_join(boxes(t).where("size > 45"), boxes(t), 5.0).groupBy(F.col("box").alias("region")).agg(F.sum(F.col("b_size") * 1000).cast("long").alias("bytes"), F.count("*").alias("files"))


@query(QUERIES, f"""WITH m AS (SELECT * FROM {BOXES} WHERE size > 30), f AS (SELECT * FROM m WHERE box % 5 = 0), o AS (SELECT * FROM {BOXES} WHERE size <= 30)
SELECT box, 'merged' AS kind FROM m WHERE box % 5 > 0 UNION ALL SELECT DISTINCT o.box, 'original' FROM o JOIN f ON o.size % 2 = f.size % 2 AND o.west < f.east AND o.east > f.west AND o.south < f.north AND o.north > f.south""")
def q_replace_failed(t: Tables) -> DataFrame:
    merged, originals = boxes(t).where("size > 30"), boxes(t).where("size <= 30")
    failed = merged.where("box % 5 = 0")
    back = J.bbox_join(originals, failed, 5.0).where("size % 2 = b_size % 2").select("box").distinct().withColumn("kind", F.lit("original"))
    return merged.join(failed, "box", "left_anti").select("box", F.lit("merged").alias("kind")).unionByName(back)


@query(QUERIES, "SELECT c_custkey AS key, c_nationkey AS nation, 'customer' AS kind FROM customer UNION ALL SELECT s_suppkey, s_nationkey, 'supplier' FROM supplier")
def q_union_kinds(t: Tables) -> DataFrame:
    a = t.customer.select(F.col("c_custkey").alias("key"), F.col("c_nationkey").alias("nation"), F.lit("customer").alias("kind"))
    return a.unionByName(t.supplier.select(F.col("s_suppkey").alias("key"), F.col("s_nationkey").alias("nation"), F.lit("supplier").alias("kind")), allowMissingColumns=True)


@query(QUERIES, "SELECT n_nationkey FROM nation EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000")
def q_missing_groups(t: Tables) -> DataFrame:
    return t.nation.select("n_nationkey").exceptAll(t.supplier.where("s_acctbal > 5000").select("s_nationkey").distinct())


@query(QUERIES, "SELECT day::VARCHAR AS day, row_number() OVER (ORDER BY day DESC)::INT AS place FROM (SELECT DISTINCT date_trunc('month', o_orderdate)::DATE AS day FROM orders UNION SELECT DISTINCT date_trunc('month', l_shipdate)::DATE FROM lineitem)")
def q_cycle_index(t: Tables) -> DataFrame:
    month = lambda c: F.to_date(F.date_trunc("month", c)).alias("day")
    days = t.orders.select(month("o_orderdate")).union(t.lineitem.select(month("l_shipdate"))).distinct()
    return days.select(F.col("day").cast("string").alias("day"), F.row_number().over(Window.orderBy(F.desc("day"))).alias("place"))


@query(QUERIES, "SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' INTERSECT SELECT p_partkey FROM part WHERE p_size > 25")
def q_pinned(t: Tables) -> DataFrame:
    return t.lineitem.where("l_returnflag = 'R'").select("l_partkey").intersect(t.part.where("p_size > 25").select("p_partkey"))


@query(QUERIES, "SELECT p_partkey FROM part WHERE p_size % 2 = 0 AND p_partkey NOT IN (SELECT l_partkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey WHERE c_acctbal > 9000)")
def q_expired_files(t: Tables) -> DataFrame:
    catalogs = t.customer.where("c_acctbal > 9000").select(F.col("c_custkey").alias("o_custkey"))
    books = t.orders.join(catalogs, "o_custkey", "left_semi").select(F.col("o_orderkey").alias("l_orderkey"))
    used = t.lineitem.join(books, "l_orderkey", "left_semi").select(F.col("l_partkey").alias("p_partkey"))
    return t.part.where("p_size % 2 = 0").join(used, "p_partkey", "left_anti").select("p_partkey")


@query(QUERIES, "SELECT n.p_partkey FROM part n WHERE n.p_size <> CASE WHEN n.p_partkey % 10 = 0 THEN n.p_size + 1 ELSE n.p_size END OR n.p_partkey % 17 = 0")
def q_incremental_misses(t: Tables) -> DataFrame:
    old = t.part.where("p_partkey % 17 > 0").withColumn("p_size", F.when(F.col("p_partkey") % 10 == 0, F.col("p_size") + 1).otherwise(F.col("p_size")))
    return K.misses(t.part, old, ["p_partkey"], ["p_name", "p_size"]).select("p_partkey")


@query(QUERIES, "SELECT p_partkey FROM part WHERE p_size <= 25")
def q_prune_set(t: Tables) -> DataFrame:
    return K.prunable(t.part.select("p_partkey"), t.part.where("p_size > 25").select("p_partkey"), "p_partkey")


@query(QUERIES, f"WITH r AS (SELECT o_custkey, o_orderkey, o_custkey % 900 + 100 AS bytes, (sum(o_custkey % 900 + 100) OVER (PARTITION BY o_custkey ORDER BY o_orderkey))::BIGINT AS run FROM orders) SELECT o_custkey, o_orderkey, ((run - bytes) // 2000)::BIGINT AS batch FROM r")
def q_size_batches(t: Tables) -> DataFrame:
    rows = t.orders.select("o_custkey", "o_orderkey", (F.col("o_custkey") % 900 + 100).alias("bytes"))
    return K.size_batches(rows, "o_custkey", ["o_orderkey"], "bytes", 2000).select("o_custkey", "o_orderkey", "batch")


@query(QUERIES, "SELECT 'n' || p_partkey || '_' || p_size || '.tif' AS key, 'n' || p_partkey || '_' || p_size AS stem FROM part WHERE p_size > 10")
def q_listing_products(t: Tables) -> DataFrame:
    stem = F.concat(F.lit("n"), F.col("p_partkey"), F.lit("_"), F.col("p_size"))
    keys = t.part.select(F.concat(stem, F.lit(".tif")).alias("key")).unionByName(t.part.where("p_size > 10").select(F.concat(stem, F.lit(".xml")).alias("key")))
    return listing_products(keys, r"^(n\d+_\d+)\.", ".xml")[0].select("key", "stem")


@query(QUERIES, "SELECT r_name AS state, n_name AS city, c_custkey AS airport, o_orderkey AS record FROM region JOIN nation ON n_regionkey = r_regionkey JOIN customer ON c_nationkey = n_nationkey JOIN orders ON o_custkey = c_custkey")
def q_hierarchy_flatten(t: Tables) -> DataFrame:
    airports = t.orders.groupBy("o_custkey").agg(F.collect_list("o_orderkey").alias("records")).join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    nested = airports.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return nested.select(F.col("r_name").alias("state"), F.col("n_name").alias("city"), F.col("c_custkey").alias("airport"), F.explode("records").alias("record"))
