"""Cell tables: neighbourhoods, runs, integral sums, components, tiles. Cells are rows (x, y, ...)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.functions import columns as C
from skyledger.functions.storage import checkpointed

from .graph import connected_components


def around(cells: DataFrame, values: list[str], radius: int = 1) -> DataFrame:
    """Each cell's neighbours (dx, dy, values): cells send copies of themselves to the places that see them, so nothing is joined."""
    step = F.sequence(F.lit(-radius), F.lit(radius))
    sent = cells.withColumn("dx", F.explode(step)).withColumn("dy", F.explode(step))
    return sent.select((F.col("x") - F.col("dx")).alias("x"), (F.col("y") - F.col("dy")).alias("y"), "dx", "dy", *values)


def focal(cells: DataFrame, value: str) -> DataFrame:
    """Lowest and highest of the 3 x 3 neighbourhood, for cells that have all nine."""
    n = around(cells, [value]).groupBy("x", "y").agg(F.count("*").alias("n"), F.min(value).alias("low"), F.max(value).alias("high"), F.max(F.when((F.col("dx") == 0) & (F.col("dy") == 0), F.col(value))).alias("centre"))
    return n.where("n = 9 and centre is not null").drop("n")


def plane_fit(cells: DataFrame, value: str) -> DataFrame:
    """Plane through each full 3 x 3 neighbourhood: slopes, mean and largest residual."""
    z = F.col(value)
    seen = around(cells, [value]).groupBy("x", "y").agg(
        F.count("*").alias("n"), (F.sum(F.col("dx") * z) / 6).alias("slope_x"), (F.sum(F.col("dy") * z) / 6).alias("slope_y"), F.avg(z).alias("mean"),
        F.collect_list(F.struct("dx", "dy", z.cast("double").alias("z"))).alias("all"),
    ).where("n = 9")
    worst = F.expr("array_max(transform(all, c -> abs(c.z - (mean + slope_x * c.dx + slope_y * c.dy))))")
    return seen.select("x", "y", "slope_x", "slope_y", "mean", worst.alias("residual"))


def runs(cells: DataFrame, line: Column, along: Column) -> DataFrame:
    """Straight runs of present cells: line, first and last place, length."""
    rows = cells.select(line.alias("line"), along.alias("at"))
    island = F.col("at") - F.row_number().over(Window.partitionBy("line").orderBy("at"))
    return rows.withColumn("island", island).groupBy("line", "island").agg(F.min("at").alias("first"), F.max("at").alias("last"), F.count("*").alias("length")).drop("island")


def longest_runs(cells: DataFrame) -> DataFrame:
    """(way, line, longest): the longest run of present cells in each row, column and both diagonals."""
    x, y, out = F.col("x"), F.col("y"), None
    for way, line, along in (("row", y, x), ("column", x, y), ("diagonal", x - y, y), ("counter", x + y, y)):
        found = runs(cells, line, along).groupBy("line").agg(F.max("length").alias("longest")).select(F.lit(way).alias("way"), "line", "longest")
        out = found if out is None else out.unionByName(found)
    return out


def integral(cells: DataFrame, value: str) -> DataFrame:
    """Sum over the rectangle from the origin to each cell of a full grid."""
    rows = cells.withColumn("row_sum", F.sum(value).over(Window.partitionBy("y").orderBy("x")))
    return rows.select("x", "y", F.sum("row_sum").over(Window.partitionBy("x").orderBy("y")).alias("total"))


def window_sum(total: DataFrame, width: int, height: int) -> DataFrame:
    """Sum of each width x height window by its upper corner, from four corners of the integral."""
    corner = lambda dx, dy, sign: total.select((F.col("x") - dx).alias("x"), (F.col("y") - dy).alias("y"), (sign * F.col("total")).alias("part"), F.lit(int(dx == width - 1 and dy == height - 1)).alias("far"))
    corners = corner(width - 1, height - 1, 1).unionByName(corner(-1, height - 1, -1)).unionByName(corner(width - 1, -1, -1)).unionByName(corner(-1, -1, 1))
    return corners.groupBy("x", "y").agg(F.sum("part").alias("total"), F.max("far").alias("far")).where("far = 1 and x >= 0 and y >= 0").drop("far")


def label_components(cells: DataFrame, width: int, diagonal: bool = False) -> DataFrame:
    """Cells with the smallest cell number (y * width + x) of their component; corner contact connects only with ``diagonal``.

    Horizontal runs are the nodes, so a component of any width costs as many links as it has touching runs."""
    spans = runs(cells, F.col("y"), F.col("x")).withColumn("node", F.col("line").cast("long") * width + F.col("first"))
    reach = 1 if diagonal else 0
    bin_of = lambda c: F.floor(c / 16)
    up = spans.select(F.col("line").alias("line"), "first", "last", "node", F.explode(F.sequence(bin_of(F.col("first")), bin_of(F.col("last")))).alias("bin"))
    down = spans.select((F.col("line") - 1).alias("line"), F.col("first").alias("f2"), F.col("last").alias("l2"), F.col("node").alias("below"), F.explode(F.sequence(bin_of(F.col("first") - reach), bin_of(F.col("last") + reach))).alias("bin"))
    touching = up.join(down, ["line", "bin"]).where((F.col("first") <= F.col("l2") + reach) & (F.col("f2") <= F.col("last") + reach)).select(F.col("node").alias("src"), F.col("below").alias("dst"))
    found = connected_components(touching.unionByName(spans.select(F.col("node").alias("src"), F.col("node").alias("dst"))).distinct())
    named = spans.join(found, "node").select("first", "last", F.col("line").alias("y"), F.col("component").alias("label"))
    return named.select(F.explode(F.sequence("first", "last")).alias("x"), "y", "label")


def tile_cover(boxes: DataFrame, z: int) -> DataFrame:
    """Web-Mercator tiles that each rectangle touches."""
    north, south = F.least(F.col("north"), F.lit(85.0)), F.greatest(F.col("south"), F.lit(-85.0))
    spread = boxes.withColumn("tile_x", F.explode(F.sequence(C.tile_x(F.col("west"), z), C.tile_x(F.col("east"), z))))
    return spread.withColumn("tile_y", F.explode(F.sequence(C.tile_y(north, z), C.tile_y(south, z))))


def degree_tiles(boxes: DataFrame, step: float = 1.0) -> DataFrame:
    """Whole steps of degrees that the rectangles touch, each once."""
    index = lambda c, f: f(F.col(c) / step).cast("int")
    east = lambda c: F.greatest(index(c, F.ceil) - 1, index("west" if c == "east" else "south", F.floor))
    wide = boxes.select(F.explode(F.sequence(index("west", F.floor), east("east"))).alias("lon"), "south", "north")
    return wide.select("lon", F.explode(F.sequence(index("south", F.floor), east("north"))).alias("lat")).distinct()


def clipped_tiles(boxes: DataFrame, key: str, step: float = 1.0) -> DataFrame:
    """(key, lon, lat, west, south, east, north): the steps of degrees that each rectangle touches, cut to it."""
    c = F.col
    span = lambda a, b: F.explode(F.sequence(F.floor(c(a) / step), F.greatest(F.ceil(c(b) / step) - 1, F.floor(c(a) / step))))
    at = boxes.withColumn("lon", span("west", "east")).withColumn("lat", span("south", "north"))
    low = [F.greatest(e, c(k) * step).alias(e) for e, k in (("west", "lon"), ("south", "lat"))]
    return at.select(key, "lon", "lat", *low, *[F.least(e, (c(k) + 1) * step).alias(e) for e, k in (("east", "lon"), ("north", "lat"))])


def median_split(rows: DataFrame, key: str, most: int, rounds: int = 40) -> DataFrame:
    """Adds ``part``: groups over ``most`` rows are halved along the wider axis, ties by key, until none is above.

    Rows are put in order by range, over many tasks whatever a group holds; a row's place is its place in its slice and
    the rows of its group in the slices before."""
    out, rest = None, rows.withColumn("part", F.lit("r"))
    for _ in range(rounds):
        size = rest.groupBy("part").agg(F.count("*").alias("n"), (F.max("x") - F.min("x") >= F.max("y") - F.min("y")).alias("wide"))
        joined = rest.join(size, "part")
        done = joined.where(F.col("n") <= most).select(*rest.columns)
        out = done if out is None else out.unionByName(done)
        over = joined.where(F.col("n") > most).withColumn("along", F.when(F.col("wide"), F.col("x")).otherwise(F.col("y")))
        sliced = checkpointed(over.repartitionByRange("part", "along", key).withColumn("slice", F.spark_partition_id()))
        if sliced.isEmpty():
            return out
        before = F.sum("count").over(Window.partitionBy("part").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1))
        slices = sliced.groupBy("part", "slice").count().select("part", "slice", F.coalesce(before, F.lit(0)).alias("before"))
        inside = F.row_number().over(Window.partitionBy("part", "slice").orderBy("along", key))
        placed = sliced.withColumn("inside", inside).join(slices, ["part", "slice"])
        half = F.when(F.col("before") + F.col("inside") <= F.floor(F.col("n") / 2), "0").otherwise("1")
        rest = checkpointed(placed.withColumn("part", F.concat("part", half)).select(*rest.columns))
    raise RuntimeError("groups did not get below the limit")


def expanded(boxes: DataFrame, metres: Column) -> DataFrame:
    """Rectangles grown by a distance on each side, in degrees at their middle latitude."""
    north = metres / 111320.0
    east = metres / (111320 * F.cos(F.radians((F.col("south") + F.col("north")) / 2)))
    return boxes.withColumns({"west": F.col("west") - east, "south": F.col("south") - north, "east": F.col("east") + east, "north": F.col("north") + north})


def polygon_area(rings: Column) -> Column:
    """Area of the first ring less the others: each a closed array of edges (x1, y1, x2, y2), summed from its first corner on."""

    def area(ring: Column) -> Column:
        x0, y0 = ring[0]["x1"], ring[0]["y1"]
        cross = lambda e: (e["x1"] - x0) * (e["y2"] - y0) - (e["x2"] - x0) * (e["y1"] - y0)
        return F.abs(F.aggregate(ring, F.lit(0.0), lambda s, e: s + cross(e))) / 2

    sizes = F.transform(rings, area)
    return 2 * sizes[0] - F.aggregate(sizes, F.lit(0.0), lambda s, a: s + a)


def rasterized(shapes: DataFrame, key: str, edges: Column, per_unit: int) -> DataFrame:
    """(key, k, first, last): runs of sample places inside each shape by the even-odd rule. Sample i of a row stands at
    (i + 0.5) / per_unit, rows likewise; slanted edges cross a row at one place, holes are further edges."""
    rows = shapes.select(key, F.explode(edges).alias("e")).select(key, F.least("e.y1", "e.y2").alias("a"), F.greatest("e.y1", "e.y2").alias("b"), "e.*").where("a < b")
    at = rows.withColumn("k", F.explode(F.sequence(F.floor(F.col("a") * per_unit), F.ceil(F.col("b") * per_unit) - 1))).withColumn("y", (F.col("k") + 0.5) / per_unit)
    crossed = at.where("y > a and y <= b").withColumn("x", F.col("x1") + (F.col("x2") - F.col("x1")) * (F.col("y") - F.col("y1")) / (F.col("y2") - F.col("y1")))
    place = F.row_number().over(Window.partitionBy(key, "k").orderBy("x"))
    pairs = crossed.withColumn("place", place).groupBy(key, "k", F.floor((F.col("place") - 1) / 2).alias("pair")).agg(F.min("x").alias("enter"), F.max("x").alias("leave"))
    return pairs.select(key, "k", F.floor(F.col("enter") * per_unit + 0.5).alias("first"), (F.ceil(F.col("leave") * per_unit - 0.5) - 1).alias("last")).where("first <= last")
