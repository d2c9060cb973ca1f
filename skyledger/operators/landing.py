"""Landing ground on a cell grid: evidence for cover, corridors of a width and a length, areas in two passes."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .grid import label_components, runs

WAYS = ("row", "column", "diagonal", "counter")


def cover_evidence(e: dict[str, Column]) -> tuple[Column, Column]:
    """(eligible, uncertain) of a cell from what its sources say.

    ``e``: boolean ``cover``, ``blocked``, ``excluded``, ``disputed``, ``mapping_required``, ``bare``, ``newer_open``;
    integer ``fine`` (2 open, 1 open if bare), ``ground_open`` (bit 1 mapped grass, bit 2 open if bare), ``canopy``,
    ``impervious`` (2: modelled as low), ``land`` (1, 2: trees), ``trees``, ``water``. Nulls count as false and 0.

    Sources raise objections, and other sources may answer them: blocked ground has no answer; excluded ground is answered
    by newer evidence of an old tree cover; a dispute by grass that all models agree on; missing required mapping by open
    ground. Covered cells without an open objection are eligible, and uncertain where a recovery was needed."""
    flag = {k: F.coalesce(e[k], F.lit(False)) for k in ("cover", "blocked", "excluded", "disputed", "mapping_required", "bare", "newer_open") if k in e}
    no, value = F.lit(False), lambda k: F.coalesce(e[k], F.lit(0)) if k in e else F.lit(0)
    is_ = lambda k: flag.get(k, no)
    grass, maybe = value("ground_open").bitwiseAND(1) != 0, value("ground_open").bitwiseAND(2) != 0
    low = (value("canopy") == 2) & (value("impervious") >= 2) & grass
    open_ground = (value("fine") == 2) | grass | (is_("bare") & ((value("fine") == 1) | maybe))
    old_trees = low & is_("newer_open") & ~is_("disputed") & value("land").isin(1, 2) & (value("trees") == 1) & (value("water") == 0)
    agreed_grass = low & is_("disputed") & (value("fine") == 2) & ~is_("excluded")
    objections = ((is_("blocked"), no), (is_("excluded"), old_trees), (is_("disputed"), agreed_grass), (is_("mapping_required"), open_ground))
    open_ones = no
    for raised, answered in objections:
        open_ones = open_ones | (raised & ~answered)
    eligible = is_("cover") & ~open_ones
    return eligible, eligible & (old_trees | agreed_grass)


def blocks(cells: DataFrame, width: int, height: int) -> DataFrame:
    """(label, x, y): lower corners of all ``width`` x ``height`` blocks of cells of one label: erosion, one axis after the other."""
    c = F.col

    def eroded(df: DataFrame, line: str, along: str, n: int) -> DataFrame:
        if n == 1:
            return df.select("label", "x", "y")
        long = runs(df, F.struct("label", line), c(along)).where(c("length") >= n)
        return long.select(c("line.label").alias("label"), c(f"line.{line}").alias(line), F.explode(F.sequence("first", c("last") - (n - 1))).alias(along)).select("label", "x", "y")

    return eroded(eroded(cells, "x", "y", height), "y", "x", width)


def corridors(cells: DataFrame, width: int) -> DataFrame:
    """(label, way, length): the longest corridor of ``width`` cells in each label (label, x, y), in cells' sides, four ways.

    Along rows and columns it is a run of blocks one cell long. On a diagonal, n square blocks of s cells cover a strip
    (s - 1) * sqrt(2) wide and n * sqrt(2) long, so s = ceil(width / sqrt(2)) + 1."""
    square, c, out = math.ceil(width / math.sqrt(2)) + 1, F.col, None
    slanted = blocks(cells, square, square)
    for way, held, line, along, unit in (
        ("row", blocks(cells, 1, width), c("y"), c("x"), 1.0), ("column", blocks(cells, width, 1), c("x"), c("y"), 1.0),
        ("diagonal", slanted, c("x") - c("y"), c("y"), math.sqrt(2)), ("counter", slanted, c("x") + c("y"), c("y"), math.sqrt(2)),
    ):
        found = runs(held, F.struct("label", line.alias("at")), along).groupBy(c("line.label").alias("label")).agg((F.max("length") * unit).alias("length"))
        part = found.select("label", F.lit(way).alias("way"), "length")
        out = part if out is None else out.unionByName(part)
    return out


def qualified(mask: DataFrame, grid_width: int, width: int, length: float) -> tuple[DataFrame, DataFrame]:
    """Components of the cells ``mask`` (x, y and others) that hold a corridor: (label, way, longest) and cells with their label.

    Corner contact connects nothing. Of ways with corridors of one length the first in ``WAYS`` counts."""
    labelled = mask.join(label_components(mask.select("x", "y"), grid_width), ["x", "y"])
    order = F.array_position(F.array(*map(F.lit, WAYS)), F.col("way"))
    best = corridors(labelled.select("label", "x", "y"), width).groupBy("label").agg(F.min(F.struct((-F.col("length")).alias("short"), order.alias("order"), "way")).alias("best"))
    good = best.where(-F.col("best.short") >= length).select("label", F.col("best.way").alias("way"), (-F.col("best.short")).alias("longest"))
    return good, labelled


def landing_areas(cells: DataFrame, grid_width: int, preferred: tuple[int, float], fallback: tuple[int, float]) -> DataFrame:
    """One row a qualified area: role, label, its cells, bounds, longest corridor and way, flags.

    ``cells``: x, y, ``eligible``, ``uncertain``, ``hazard`` (null or 0 none, 1 within the fallback distance, 2 within the
    preferred one alone), ``band`` of terrain (1 strict, 2 broader, 0 or null unusable) and integer ``flags``. The preferred
    pass takes certain, strict cells free of both hazards and asks for ``preferred`` (width, length); the fallback pass
    takes eligible cells of any usable band free of the nearer hazard and asks for ``fallback``, and keeps an area only
    if it has a cell that no preferred area has. A label is the smallest y * ``grid_width`` + x of the area's cells."""
    c = F.col
    usable = cells.where("eligible and coalesce(band, 0) > 0 and coalesce(hazard, 0) <> 1")
    strict = usable.where("not coalesce(uncertain, false) and band = 1 and coalesce(hazard, 0) = 0")
    out, covered = None, None
    for role, mask, (width, length) in (("preferred", strict, preferred), ("fallback", usable, fallback)):
        good, labelled = qualified(mask.select("x", "y", "flags"), grid_width, width, length)
        held = labelled.join(good, "label")
        if covered is not None:
            held = held.join(covered, ["x", "y"], "left")
        fresh = F.lit(True) if covered is None else c("covered").isNull()
        areas = held.groupBy("label", "way", "longest").agg(
            F.count("*").alias("cells"), F.min("x").alias("left"), F.min("y").alias("top"), (F.max("x") + 1).alias("right"), (F.max("y") + 1).alias("bottom"), F.bit_or("flags").alias("flags"), F.max(fresh).alias("fresh"),
        ).where("fresh").drop("fresh").select(F.lit(role).alias("role"), "*")
        covered = held.select("x", "y", F.lit(True).alias("covered"))
        out = areas if out is None else out.unionByName(areas)
    return out
