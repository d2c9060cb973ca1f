"""Tile pyramids: blocks under a budget by rolled-up counts, and tiles resolved over layers of sheets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions.storage import forget, written

STRIDE = 4


def rolled(df: DataFrame, steps: int, *measures: Column, keys: tuple[str, ...] = ()) -> DataFrame:
    """``df`` of tiles (keys, x, y) summed into tiles ``steps`` levels up."""
    return df.groupBy(*keys, F.shiftright("x", steps).alias("x"), F.shiftright("y", steps).alias("y")).agg(*measures)


def quad_blocks(tiles: DataFrame, most: int, deepest: int = 20) -> DataFrame:
    """(z, x, y, rows): blocks at the highest level at which their rows stay within ``most``, or at ``deepest``, where x and y of ``tiles`` are addresses.

    Rows are counted once, at the deepest level, and counts are summed into every fourth level above. On the way down a
    stride of levels is counted from the table below it, for blocks over the budget alone; rows are never written again."""
    counts = {deepest: written(rolled(tiles, 0, F.count("*").alias("n")), "counts")}
    while (low := min(counts)) > STRIDE:
        counts[low - STRIDE] = written(rolled(counts[low], STRIDE, F.sum("n").alias("n")), "counts")
    out, above, c = None, None, F.col
    for base in sorted(counts):
        top = -1 if above is None else above[0]
        rows = counts[base]
        if above is not None:
            over = above[1].select(c("x").alias("px"), c("y").alias("py"))
            rows = rows.join(over, (F.shiftright("x", base - top) == c("px")) & (F.shiftright("y", base - top) == c("py")), "left_semi")
        levels = rows.withColumn("z", F.explode(F.sequence(F.lit(top + 1), F.lit(base))))
        at = lambda k: F.expr(f"shiftright({k}, {base} - z)").alias(k)
        made = written(levels.groupBy("z", at("x"), at("y")).agg(F.sum("n").alias("n")), "levels")
        parent = made.where(c("z") < base).select((c("z") + 1).alias("z"), c("x").alias("px"), c("y").alias("py"), c("n").alias("pn"))
        met = made.withColumns({"px": F.shiftright("x", 1), "py": F.shiftright("y", 1)}).join(parent, ["z", "px", "py"], "left")
        fits = ((c("n") <= most) | (c("z") == deepest)) & ((c("z") == top + 1) | (c("pn") > most))
        part = met.where(fits).select("z", "x", "y", c("n").alias("rows"))
        out = part if out is None else out.unionByName(part)
        above = (base, made.where((c("z") == base) & (c("n") > most)))
    forget(*counts.values())
    return out


def overviews(tiles: DataFrame, sheets: DataFrame, combine: Column) -> DataFrame:
    """(sheet, z, x, y, data) of all levels below each sheet's lowest: a tile stands where it has a part one level down.

    ``combine`` makes a tile's data of its parts' ``data``, up to four. One pass a level, each over the level before."""
    deepest = sheets.agg(F.max("min_zoom")).first()[0] or 0
    lowest = tiles.join(sheets.select("sheet", "min_zoom"), "sheet").where("z = min_zoom").select("sheet", "z", "x", "y", "data")
    level, out = None, None
    for z in range(deepest, 0, -1):
        from_sheets = lowest.where(F.col("z") == z).select("sheet", "x", "y", "data")
        below = from_sheets if level is None else level.select("sheet", "x", "y", "data").unionByName(from_sheets)
        level = written(rolled(below, 1, combine.alias("data"), keys=("sheet",)).withColumn("z", F.lit(z - 1)), "overview")
        out = level if out is None else out.unionByName(level)
    return (lowest.where("false") if out is None else out).select("sheet", "z", "x", "y", "data")


def resolve_tiles(wanted: DataFrame, sheets: DataFrame, tiles: DataFrame, combine: Column) -> DataFrame:
    """``wanted`` tiles (z, x, y) with ``layers``: what each sheet shows there, in the order of ``place``, then sheet.

    ``sheets`` (sheet, place, min_zoom, max_zoom), ``tiles`` (sheet, z, x, y, data) within those levels. From its lowest to
    its highest level a sheet shows its own tile; below, an overview made of the level under it; above, its tile of the
    highest level that holds the place. A layer is (place, sheet, origin own, overview or parent, z, x, y, data), the
    address being that of the tile used. A place without any has no layers; a sheet without one there is left out."""
    c = F.col
    ranged = tiles.join(sheets, "sheet")
    native = ranged.where("z between min_zoom and max_zoom").select("place", "sheet", F.lit("own").alias("origin"), "z", "x", "y", "data", "max_zoom")
    derived = overviews(tiles, sheets, combine).join(sheets.select("sheet", "place"), "sheet").select("place", "sheet", F.lit("overview").alias("origin"), "z", "x", "y", "data")
    direct = native.drop("max_zoom").unionByName(derived)
    asked = wanted.select("z", "x", "y").distinct()
    layer = F.struct("place", "sheet", "origin", c("z").alias("z"), c("x").alias("x"), c("y").alias("y"), "data").alias("layer")
    shown = asked.join(direct, ["z", "x", "y"]).select("z", "x", "y", layer)
    tops = native.where(c("z") == c("max_zoom")).withColumn("origin", F.lit("parent")).select("z", "x", "y", layer)
    levels = [r[0] for r in sheets.select("max_zoom").distinct().collect()]  # levels, some 25 at most
    up = asked.withColumn("up", F.explode(F.array(*map(F.lit, levels)) if levels else F.array().cast("array<int>"))).where("up < z")
    held = up.select("z", "x", "y", c("up").alias("pz"), F.expr("shiftright(x, z - up)").alias("px"), F.expr("shiftright(y, z - up)").alias("py"))
    parents = held.join(tops.toDF("pz", "px", "py", "layer"), ["pz", "px", "py"]).select("z", "x", "y", "layer")
    layers = shown.unionByName(parents).groupBy("z", "x", "y").agg(F.array_sort(F.collect_list("layer")).alias("layers"))
    return asked.join(layers, ["z", "x", "y"], "left").withColumn("layers", F.coalesce("layers", F.array()))


def pyramid(base: DataFrame, top: int, measures: dict[str, Column]) -> DataFrame:
    """(z, x, y, measures): ``base`` (x, y and the measures' columns) as level ``top`` and all levels above it, to z 0.

    ``measures`` names each column and how it is made of the up to four below it. A level is made of the one below, which
    is written, so no level is computed twice."""
    level = base.select("x", "y", *measures)
    out = level.select(F.lit(top).alias("z"), "*")
    for z in range(top - 1, -1, -1):
        level = written(rolled(level, 1, *[m.alias(n) for n, m in measures.items()]), "level")
        out = out.unionByName(level.select(F.lit(z).alias("z"), "*"))
    return out


def viewport(features: DataFrame, bounds: tuple[float, float, float, float], zoom: int, coarse: int, halo: float) -> DataFrame:
    """What a view of (west, south, east, north), widened by ``halo`` degrees, shows of ``features`` (id, west, south, east, north).

    From zoom ``coarse`` up a row a feature that touches it: id and its bounds. Below, a row a degree square with the ``n``
    features whose south-western corners lie there."""
    w, s, e, n = bounds[0] - halo, bounds[1] - halo, bounds[2] + halo, bounds[3] + halo
    seen = features.where((F.col("west") <= e) & (F.col("east") >= w) & (F.col("south") <= n) & (F.col("north") >= s))
    if zoom >= coarse:
        return seen.select("id", "west", "south", "east", "north")
    return seen.groupBy(F.floor("west").alias("lon"), F.floor("south").alias("lat")).agg(F.count("*").alias("n"))


def region_files(regions: DataFrame, files: DataFrame, key: str, size: float) -> DataFrame:
    """(key, n_files, bytes) of the files (file, bytes, west, south, east, north) that overlap any rectangle of a region, each once.

    ``regions``: key and ``bounds``, an array of rectangles [west, south, east, north]. A region without files has zeros."""
    from .joins import bbox_join

    c = F.col
    boxes = regions.select(key, "bounds", F.posexplode("bounds").alias("nth", "b")).select(key, "bounds", "nth", *[c("b")[i].alias(e) for i, e in enumerate(("west", "south", "east", "north"))])
    hit = lambda b: (b[0] < c("b_east")) & (b[2] > c("b_west")) & (b[1] < c("b_north")) & (b[3] > c("b_south"))
    # a file counts at the first rectangle of a region that it overlaps: no pair is made distinct
    met = bbox_join(boxes, files, size).where(~F.exists(F.slice("bounds", F.lit(1), c("nth")), hit)).select(key, "b_file", "b_bytes")
    if not all(df.groupBy(k).count().where("count > 1").isEmpty() for df, k in ((regions, key), (files, "file"))):
        met = met.distinct()  # a file or a region that stands in several rows
    found = met.groupBy(key).agg(F.count("*").alias("n_files"), F.sum("b_bytes").alias("bytes"))
    return regions.select(key).join(found, key, "left").na.fill(0, ["n_files", "bytes"])


def possible_chunks(chunks: DataFrame, key: str, cells: DataFrame, roles: list[Column], halo: int = 2) -> DataFrame:
    """Keys of chunks, the ranges of cells (``x0``..``x1``, ``y0``..``y1``), that may hold something: each of ``roles``, a condition over
    ``cells`` (``x``, ``y``), is true in some cell of the chunk or ``halo`` cells around it, not always the same one.

    A rejection is final and a chunk that stays is only possible. The cells of all sources may repeat: what they say is or-ed, and
    cells without any role go, before chunks are spread over the cells of their ranges, which are as many as a chunk is large. A null
    condition is false; a chunk without cells goes.
    """
    bits = F.lit(0)
    for i, role in enumerate(roles):
        bits = bits.bitwiseOR(F.when(role, F.lit(1 << i)).otherwise(F.lit(0)))
    known = cells.select("x", "y", bits.alias("bits")).where("bits > 0").groupBy("x", "y").agg(F.bit_or("bits").alias("bits"))
    around = chunks.select(key, F.explode(F.sequence(F.col("x0") - halo, F.col("x1") + halo)).alias("x"), "y0", "y1").select(key, "x", F.explode(F.sequence(F.col("y0") - halo, F.col("y1") + halo)).alias("y"))
    from .joins import dealt

    found = dealt(around).join(known, ["x", "y"]).groupBy(key).agg(F.bit_or("bits").alias("bits"))
    return found.where(F.col("bits") == (1 << len(roles)) - 1).select(key)
