"""Views that give the star-schema tables the shapes of the operators' inputs, as DataFrames and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .query import Tables

POINTS = "(SELECT o_orderkey AS id, o_custkey AS owner, ((o_custkey * 7919 + o_orderkey * 31) % 360000) / 1000.0 - 180 AS lon, ((o_orderkey * 104729) % 170000) / 1000.0 - 85 AS lat FROM orders)"
BOXES = "(SELECT p_partkey AS box, p_size AS size, ((p_partkey * 7919) % 34000) / 100.0 - 170 AS west, ((p_partkey * 104729) % 15000) / 100.0 - 75 AS south, ((p_partkey * 7919) % 34000) / 100.0 - 170 + p_size / 10.0 AS east, ((p_partkey * 104729) % 15000) / 100.0 - 75 + p_size / 20.0 AS north FROM part)"
CELLS = "(SELECT (l_orderkey % 128)::INT AS x, (l_partkey % 128)::INT AS y, min(l_quantity) AS lo, max(l_quantity) AS hi, max(l_linenumber) AS lines FROM lineitem GROUP BY 1, 2)"
HISTORY = "(SELECT c_nationkey AS origin, s_nationkey AS destination, o_orderpriority AS route, nullif(c_mktsegment, 'BUILDING') AS engine, o_orderstatus AS label, l_quantity::BIGINT AS uses, l_shipdate AS seen FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey)"


def points(t: Tables) -> DataFrame:
    lon = ((F.col("o_custkey") * 7919 + F.col("o_orderkey") * 31) % 360000) / 1000.0 - 180
    return t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("owner"), lon.alias("lon"), ((F.col("o_orderkey") * 104729) % 170000 / 1000.0 - 85).alias("lat"))


def boxes(t: Tables) -> DataFrame:
    west, south = (F.col("p_partkey") * 7919) % 34000 / 100.0 - 170, (F.col("p_partkey") * 104729) % 15000 / 100.0 - 75
    return t.part.select(F.col("p_partkey").alias("box"), F.col("p_size").alias("size"), west.alias("west"), south.alias("south"), (west + F.col("p_size") / 10.0).alias("east"), (south + F.col("p_size") / 20.0).alias("north"))


def cells(t: Tables) -> DataFrame:
    return t.lineitem.groupBy((F.col("l_orderkey") % 128).cast("int").alias("x"), (F.col("l_partkey") % 128).cast("int").alias("y")).agg(F.min("l_quantity").alias("lo"), F.max("l_quantity").alias("hi"), F.max("l_linenumber").alias("lines"))


def history(t: Tables) -> DataFrame:
    """Filed facts: the two small dimensions are joined by what Spark knows of their sizes."""
    rows = t.lineitem.select("l_orderkey", "l_suppkey", "l_quantity", "l_shipdate").join(t.orders.select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus"), F.col("l_orderkey") == F.col("o_orderkey"))
    rows = rows.join(t.customer.select("c_custkey", "c_nationkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey")).join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    return rows.select(
        F.col("c_nationkey").alias("origin"), F.col("s_nationkey").alias("destination"), F.col("o_orderpriority").alias("route"), F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("engine"),
        F.col("o_orderstatus").alias("label"), F.col("l_quantity").cast("long").alias("uses"), F.col("l_shipdate").alias("seen"),
    )
