"""Segments, polygons, landing ground, tile layers and associations by hand-made values and brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from skyledger.functions import aviation as V
from skyledger.operators import areas as A
from skyledger.operators import associations as S
from skyledger.operators import landing as L
from skyledger.operators import tiles as T

EDGES = "array<struct<x1:double,y1:double,x2:double,y2:double>>"
RINGS = "array<array<struct<x:double,y:double>>>"


def edges(*points):
    return [(*map(float, a), *map(float, b)) for a, b in zip(points, [*points[1:], points[0]], strict=True)]


def test_segments_of_any_slope_against_all_pairs(spark):
    rng = random.Random(1)
    points = [(i, rng.uniform(-10, 10), rng.uniform(-10, 10)) for i in range(300)] + [(900, None, 1.0), (901, 1.0, 1.0)]
    lines = [(k, rng.uniform(-10, 10), rng.uniform(-10, 10), rng.uniform(-10, 10), rng.uniform(-10, 10), rng.uniform(0, 2)) for k in range(40)]
    lines += [(90, 1.0, -9.0, 1.0, 9.0, 0.5), (91, -9.0, 1.0, 9.0, 1.0, 0.0), (92, 3.0, 3.0, 3.0, 3.0, 2.0), (93, 5.0, 5.0, -5.0, -5.0, 0.25), (94, None, 0.0, 1.0, 1.0, 9.0)]

    def distance(x, y, a, b, c, d):
        n = (c - a) ** 2 + (d - b) ** 2
        t = min(1.0, max(0.0, ((x - a) * (c - a) + (y - b) * (d - b)) / n)) if n else 0.0
        return math.hypot(x - a - t * (c - a), y - b - t * (d - b))

    want = {(i, k): distance(x, y, *rest) for i, x, y in points if x is not None for k, *rest, r in lines if None not in rest and distance(x, y, *rest) <= r}
    found = A.segment_join(spark.createDataFrame(points, "id int, lon double, lat double"), spark.createDataFrame(lines, "k int, x1 double, y1 double, x2 double, y2 double, radius double"), 0.7).collect()
    assert len(found) == len(want) > 300 and {(r["id"], r["k"]): r["distance"] for r in found} == pytest.approx(want)


def test_a_long_line_takes_bins_along_its_length(spark):
    line = spark.createDataFrame([(0.0, 0.0, 1000.0, 1000.0)], "x1 double, y1 double, x2 double, y2 double")
    assert A.line_bins(line, 1.0, F.lit(0.5)).count() < 6000


SHAPES = {
    1: [[(0, 0), (10, 1), (6, 9), (1, 7)], [(3, 3), (5, 3), (4, 5)]],  # slanted, with a hole
    2: [[(-8, -8), (-2, -8), (-2, -2), (-5, -6), (-8, -2)]],  # a notch
    3: [[(20, 20), (20.3, 20.1), (20.1, 20.4)]],  # within one cell
    4: [[(-20, 0), (-12, 0), (-12, 8), (-20, 8)], [(-18, 2), (-14, 2), (-14, 6), (-18, 6)]],  # edges along cells
}


def even_odd(x, y, rings):
    crossed = False
    for ring in rings:
        for (a, b), (c, d) in zip(ring, [*ring[1:], ring[0]], strict=True):
            if (b > y) != (d > y) and x < (c - a) * (y - b) / (d - b) + a:
                crossed = not crossed
    return crossed


@pytest.mark.parametrize("size", [0.3, 1.0, 7.0])
def test_points_in_slanted_polygons_with_holes(spark, size):
    rng = random.Random(2)
    points = [(i, rng.uniform(-22, 22), rng.uniform(-10, 22)) for i in range(1500)] + [(2000 + i, 20 + i / 50, 20 + i / 60) for i in range(20)] + [(3000 + i, float(i - 20), float(i % 9)) for i in range(40)]
    areas = spark.createDataFrame([(k, [e for ring in rings for e in edges(*ring)]) for k, rings in SHAPES.items()], f"area int, edges {EDGES}")
    found = {(r["id"], r["area"]) for r in A.points_in_areas(spark.createDataFrame(points, "id int, lon double, lat double"), areas, "area", size).collect()}
    assert found == {(i, k) for i, x, y in points for k, rings in SHAPES.items() if even_odd(x, y, rings)} and len(found) > 100
    assert A.area_cells(areas, "area", 0.3).where("near is null").count() > 300


def test_best_patch_of_each_area_edges_included(spark):
    areas = spark.createDataFrame([(k, [e for ring in rings for e in edges(*ring)]) for k, rings in SHAPES.items()], f"area int, edges {EDGES}")
    patches = [(1.0, 1.0, "b", 5, 1), (8.0, 3.0, "a", 5, 4), (4.0, 3.5, "hole", 99, 8), (2.0, 6.0, "c", 3, 2), (-20.0, 4.0, "on the edge", 7, 16), (-16.0, 2.0, "on the hole's edge", 6, 3), (50.0, 50.0, "nowhere", 9, 9)]
    found = {r["area"]: tuple(r)[1:] for r in A.containment_rank(areas, spark.createDataFrame(patches, "lon double, lat double, witness string, length int, flags int"), "area", 1.0).collect()}
    assert found == {1: ("a", 5, 4, 3), 2: (None, None, None, 0), 3: (None, None, None, 0), 4: ("on the edge", 7, 16, 2)}


def test_ring_codes_there_and_back(spark):
    square = [(0.0, 0.0), (0.0, 0.0000001), (1.5, 0.0), (1.5, -2.25), (0.0, 0.0)]
    hole = [(0.1234565, 0.5), (-0.1234565, 0.5), (0.0, 0.25), (0.1234565, 0.5)]
    df = spark.createDataFrame([(1, [square, hole]), (2, [[(0.0, 0.0), (1e-9, 0.0), (0.0, 1e-9), (0.0, 0.0)]]), (3, []), (4, None)], f"id int, rings {RINGS}").withColumn("codes", A.encode_rings(F.col("rings")))
    rows = {r["id"]: r for r in df.withColumn("back", A.decode_rings(F.col("codes"))).collect()}
    assert rows[1]["codes"] == [[0, 0, 1500000, 0, 0, -2250000], [123457, 500000, -246913, 0, 123456, -250000]]
    assert [[tuple(p) for p in ring] for ring in rows[1]["back"]] == [[(0.0, 0.0), (1.5, 0.0), (1.5, -2.25), (0.0, 0.0)], [(0.123457, 0.5), (-0.123456, 0.5), (0.0, 0.25), (0.123457, 0.5)]]
    assert all(rows[k]["codes"] is None for k in (2, 3, 4))


# Landing ground


def test_evidence_answers_objections(spark):
    base = {"cover": True, "blocked": False, "excluded": False, "disputed": False, "mapping_required": False, "bare": False, "newer_open": False, "fine": 0, "ground_open": 0, "canopy": 2, "impervious": 2, "land": 0, "trees": 0, "water": 0}
    cases = [
        ({}, (True, False)), ({"cover": False}, (False, False)), ({"blocked": True, "fine": 2, "ground_open": 1}, (False, False)), ({"cover": None}, (False, False)),
        ({"disputed": True}, (False, False)), ({"disputed": True, "ground_open": 1, "fine": 2}, (True, True)), ({"disputed": True, "ground_open": 1, "fine": 2, "excluded": True}, (False, False)), ({"disputed": True, "ground_open": 1, "fine": 2, "canopy": 1}, (False, False)),
        ({"excluded": True}, (False, False)), ({"excluded": True, "newer_open": True, "land": 2, "ground_open": 1, "trees": 1}, (True, True)), ({"excluded": True, "newer_open": True, "land": 2, "ground_open": 1, "trees": 1, "water": 1}, (False, False)),
        ({"mapping_required": True}, (False, False)), ({"mapping_required": True, "fine": 2}, (True, False)), ({"mapping_required": True, "fine": 1}, (False, False)), ({"mapping_required": True, "fine": 1, "bare": True}, (True, False)),
        ({"mapping_required": True, "ground_open": 2}, (False, False)), ({"mapping_required": True, "ground_open": 2, "bare": True}, (True, False)), ({"mapping_required": True, "ground_open": 1}, (True, False)),
    ]
    kinds = ", ".join(f"{k} {'boolean' if isinstance(v, bool) else 'int'}" for k, v in base.items())
    df = spark.createDataFrame([(i, *(base | c).values()) for i, (c, _) in enumerate(cases)], f"i int, {kinds}")
    found = df.select("i", *[e.alias(n) for e, n in zip(L.cover_evidence({k: F.col(k) for k in base}), ("eligible", "uncertain"), strict=True)]).collect()
    assert {r["i"]: (r["eligible"], r["uncertain"]) for r in found} == {i: want for i, (_, want) in enumerate(cases)}


def flood(cells):
    left, out = set(cells), []
    while left:
        group, front = set(), [left.pop()]
        while front:
            x, y = front.pop()
            group.add((x, y))
            for p in ((x + 1, y), (x - 1, y), (x, y + 1), (x, y - 1)):
                if p in left:
                    left.remove(p)
                    front.append(p)
        out.append(group)
    return out


def longest(group, width):
    """Longest corridor of each way, a step at a time from every cell."""
    square, best = math.ceil(width / math.sqrt(2)) + 1, {}
    block = lambda x, y, w, h: all((x + i, y + j) in group for i in range(w) for j in range(h))
    for way, (w, h), (dx, dy), unit in (("row", (1, width), (1, 0), 1.0), ("column", (width, 1), (0, 1), 1.0), ("diagonal", (square, square), (1, 1), math.sqrt(2)), ("counter", (square, square), (-1, 1), math.sqrt(2))):
        for x, y in group:
            n = 0
            while block(x + n * dx, y + n * dy, w, h):
                n += 1
            if n:
                best[way] = max(best.get(way, 0.0), n * unit)
    return best


@pytest.mark.parametrize(("seed", "width"), [(1, 2), (2, 1), (3, 3)])
def test_landing_areas_against_a_flood_fill(spark, seed, width):
    rng, side = random.Random(seed), 40
    ground = {(x, y): (rng.random() < 0.93, rng.random() < 0.08, rng.choice([0] * 12 + [1, 2, None]), rng.choice([1] * 9 + [2, 0]), rng.randrange(4)) for x in range(side) for y in range(side)}
    df = spark.createDataFrame([(x, y, *v) for (x, y), v in ground.items()], "x int, y int, eligible boolean, uncertain boolean, hazard int, band int, flags int")
    found = {(r["role"], r["label"]): tuple(r)[2:] for r in L.landing_areas(df, side, (width, 5.0), (1, 4.0)).collect()}
    usable = {p for p, (e, _, h, b, _) in ground.items() if e and b > 0 and h != 1}
    strict = {p for p in usable if not ground[p][1] and ground[p][3] == 1 and not ground[p][2]}
    want, covered = {}, set()
    for role, mask, w, need in (("preferred", strict, width, 5.0), ("fallback", usable, 1, 4.0)):
        held = set()
        for group in flood(mask):
            best = longest(group, w)
            if best and max(best.values()) >= need and (role == "preferred" or group - covered):
                xs, ys = [p[0] for p in group], [p[1] for p in group]
                way = min(best, key=lambda k: (-best[k], L.WAYS.index(k)))
                flags = 0
                for p in group:
                    flags |= ground[p][4]
                want[(role, min(y * side + x for x, y in group))] = (way, best[way], len(group), min(xs), min(ys), max(xs) + 1, max(ys) + 1, flags)
                held |= group
        covered |= held
    assert found == want and {r for r, _ in want} >= {"fallback"}


# Tiles


def test_quad_blocks_against_recursion(spark):
    rng = random.Random(5)
    tiles = [(rng.randrange(1 << 10), rng.randrange(1 << 10)) for _ in range(500)] + [(7, 7)] * 60 + [(1023, 0)] * 3

    def split(z, x, y, members, out):
        if len(members) <= 20 or z == 10:
            out[(z, x, y)] = len(members)
            return
        for cx in (2 * x, 2 * x + 1):
            for cy in (2 * y, 2 * y + 1):
                held = [p for p in members if p[0] >> (9 - z) == cx and p[1] >> (9 - z) == cy]
                if held:
                    split(z + 1, cx, cy, held, out)

    want = {}
    split(0, 0, 0, tiles, want)
    df = spark.createDataFrame(tiles, "x int, y int")
    assert {(r["z"], r["x"], r["y"]): r["rows"] for r in T.quad_blocks(df, 20, 10).collect()} == want and want[(10, 7, 7)] >= 60
    assert T.quad_blocks(df.where("x < 0"), 20, 10).count() == 0
    assert [tuple(r) for r in T.quad_blocks(df, 10_000, 10).collect()] == [(0, 0, 0, 563)]


def test_layers_of_sheets(spark):
    sheets = spark.createDataFrame([("a", 2, 2, 3), ("b", 1, 1, 1)], "sheet string, place int, min_zoom int, max_zoom int")
    tiles = spark.createDataFrame([("a", 2, 3, 3, 5), ("a", 2, 2, 3, 7), ("a", 3, 6, 6, 1), ("b", 1, 1, 1, 9), ("a", 9, 0, 0, 99)], "sheet string, z int, x int, y int, data int")
    wanted = spark.createDataFrame([(0, 0, 0), (1, 1, 1), (1, 0, 0), (2, 3, 3), (4, 12, 13), (4, 8, 8), (2, 3, 3)], "z int, x int, y int")
    found = {(r["z"], r["x"], r["y"]): [tuple(v) for v in r["layers"]] for r in T.resolve_tiles(wanted, sheets, tiles, F.sum("data")).collect()}
    assert found == {
        (0, 0, 0): [(1, "b", "overview", 0, 0, 0, 9), (2, "a", "overview", 0, 0, 0, 12)],
        (1, 1, 1): [(1, "b", "own", 1, 1, 1, 9), (2, "a", "overview", 1, 1, 1, 12)],
        (1, 0, 0): [],
        (2, 3, 3): [(1, "b", "parent", 1, 1, 1, 9), (2, "a", "own", 2, 3, 3, 5)],
        (4, 12, 13): [(1, "b", "parent", 1, 1, 1, 9), (2, "a", "parent", 3, 6, 6, 1)],
        (4, 8, 8): [(1, "b", "parent", 1, 1, 1, 9)],
    }


# Charts and routes


def test_idents_of_titles(spark):
    titles = {
        "ILS OR LOC RWY 09L": "I09L", "ILS OR LOC/NDB Y RWY 9": "I09-Y", "ILS Z OR LOC Z RWY 9C": "I09CZ", "ILS Z OR LOC Y RWY 9": None, "ILS RWY 9 (SA CAT I)": "I09", "LOC RWY 9 (SA CAT I)": None, "ILS OR GPS RWY 9": None, "ILS OR LOC-A": None,
        "VOR OR TACAN RWY 3": "S03", "VOR OR TACAN OR GPS-A": "VOR-A", "VOR/DME OR TACAN OR GPS-A": None, "VOR OR TACAN OR GPS RWY 3": None, "VOR Z OR GPS-A": None, "NDB/DME OR GPS-B": "NDM-B", "NDB OR TACAN RWY 3": None, "VOR/DME Z OR TACAN Z RWY 03R": "D03RZ",
        "LOC BC Y RWY 31": "B31-Y", "LDA/DME-C": "LDA-C", "LOC/DME BC-A": "LOC BC-A", "RNAV (RNP) Z RWY 36": "H36-Z", "RNAV (GPS)  Z  rwy 1": "R01-Z", "COPTER RNAV (GPS) 007": "R007", "COPTER RNAV (GPS) 000": None, "COPTER ILS RWY 5": None, "GPS RWY 00": None, "GPS RWY 37": None, "SDF 2, CONT.1": "U02", "VOR 123": None, "": None, None: None,
    }
    found = spark.createDataFrame([(t,) for t in titles], "t string").select("t", V.approach_ident(F.col("t")).alias("i")).collect()
    assert {r["t"]: r["i"] for r in found} == titles


def test_charts_meet_routes(spark):
    charts = [(1, "A", "VOR RWY 9", "u1"), (2, "A", "Visual 9", "u2"), (3, "B", "VOR/DME RWY 30L/R", "u3"), (4, "C", "VOR/DME RWY 30L/R", "u4"), (5, "A", "Odd title", "U5"), (6, "A", "odd  TITLE", "other"), (7, "D", "ILS OR LOC RWY 1", "u7"), (8, None, "VOR RWY 9", "u8"), (9, "C", "VOR/DME RWY 30L/L", "u9"), (10, "E", "Twice reviewed", "u"), (11, "F", "VOR/DME RWY 30L/R", "u")]
    leg = lambda *fixes: [{"path": "TF", "fixes": list(fixes)}]
    routes = [("A:S09", "A", "S09", leg("x")), ("A:X", "A", "X", leg("y")), ("B:D30L", "B", "D30L", leg("p", None)), ("B:D30R", "B", "D30R", leg("p", None)), ("C:D30L", "C", "D30L", leg("p")), ("C:D30R", "C", "D30R", leg("q")), ("D:1", "D", "I01", leg("a")), ("D:2", "D", "I01", leg("b")), ("E:1", "E", "Z", leg("a")), ("E:2", "E", "Y", leg("a")), ("F:D30L", "F", "D30L", leg("p"))]
    reviews = [("A", "ODD TITLE", "A:X", "u5"), ("E", "TWICE REVIEWED", "E:1", "u"), ("E", "TWICE REVIEWED", "E:2", "u"), ("A", "VISUAL 9", "gone", "u2")]
    found = S.associate(
        spark.createDataFrame(charts, "chart int, airport string, title string, plate string"), spark.createDataFrame(routes, "route string, airport string, ident string, final array<struct<path:string,fixes:array<string>>>"),
        spark.createDataFrame(reviews, "airport string, title string, route string, plate string"), ["final"],
    )
    assert {r["chart"]: (r["route_ids"], r["status"], r["rule"]) for r in found.collect()} == {
        1: (["A:S09"], "matched", "canonical"), 2: ([], "unmatched", "unmatched"), 3: (["B:D30L"], "matched", "parallel-equivalent"), 4: (["C:D30L", "C:D30R"], "ambiguous", "parallel-choice"), 5: (["A:X"], "matched", "reviewed"), 6: ([], "unmatched", "unmatched"),
        7: (["D:1", "D:2"], "ambiguous", "canonical"), 8: ([], "unmatched", "unmatched"), 9: ([], "unmatched", "unmatched"), 10: ([], "unmatched", "unmatched"), 11: ([], "unmatched", "unmatched"),
    }
