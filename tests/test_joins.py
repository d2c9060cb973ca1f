import math
from datetime import datetime

from pyspark.sql import functions as F

from skyledger.operators import joins as J
from skyledger.operators import tiles
from skyledger.operators.areas import points_in_areas, segment_join
from skyledger.operators.text import fuzzy_terms


def day(text):
    return datetime.fromisoformat(text) if text else None


def test_as_of_carries_over_periods_and_never_guesses_for_nulls(spark):
    need = [("a", "2024-01-05"), ("a", "2024-01-05"), ("a", "2024-06-01"), ("a", "2023-01-01"), (None, "2024-06-01"), ("a", None), ("b", "2024-06-01")]
    given = [("a", "2024-01-05"), ("a", "2024-02-01"), ("a", "2024-07-01"), (None, "2024-01-01"), ("a", None)]
    left = spark.createDataFrame([(n, day(d)) for n, d in need], "name string, day timestamp")
    right = spark.createDataFrame([(n, day(d)) for n, d in given], "name string, edition timestamp")
    found = {(r["name"], r["day"]): r["edition"] for r in J.as_of(left, right, "name", "day", "edition").collect()}
    assert found == {
        ("a", day("2024-01-05")): day("2024-01-05"), ("a", day("2024-06-01")): day("2024-02-01"), ("a", day("2023-01-01")): None,
        (None, day("2024-06-01")): None, ("a", None): None, ("b", day("2024-06-01")): None,
    }
    assert J.as_of(left, right.limit(0), "name", "day", "edition").where("edition is not null").count() == 0


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_fuzzy_terms_against_all_pairs(spark):
    terms = ["runway", "a", "approach", "instrumentation", "navigational", "", None, "runway"]
    words = ["unway", "rumway", "xrunway", "runways", "airport", "aproach", "approch", "reproach", "instrumentatoin", "instrumental", "nstrumentatio", "navigation", "navigaxionxl", "", None, "b"]
    found = fuzzy_terms(spark.createDataFrame([(t,) for t in terms], "term string"), spark.createDataFrame([(w,) for w in words], "word string"))
    want = {(t, w) for t in terms for w in words if t and w and (w.startswith(t) or edits(t, w) <= len(t) // 5)}
    assert sorted(map(tuple, found.collect())) == sorted(want) and ("runway", "unway") in want


def test_bins_are_never_sent_out_whole(spark):
    boxes = spark.range(3).selectExpr("id as box", "id * 1.0D as west", "0.0D as south", "id + 40.0D as east", "30.0D as north", "1.5D as radius", "array(named_struct('x1', 0.0D, 'y1', 0.0D, 'x2', 5.0D, 'y2', 5.0D), named_struct('x1', 5.0D, 'y1', 5.0D, 'x2', 5.0D, 'y2', 0.0D), named_struct('x1', 5.0D, 'y1', 0.0D, 'x2', 0.0D, 'y2', 0.0D)) as edges")
    points = spark.range(4).selectExpr("id", "id * 1.0D as lon", "1.0D as lat")
    lines = boxes.selectExpr("box", "west as x1", "south as y1", "east as x2", "north as y2", "radius")
    for found in (
        J.points_in_boxes(points, boxes, 1.0), J.points_in_polygons(points, boxes, 1.0), J.bbox_join(boxes, boxes, 1.0), segment_join(points, lines, 1.0), points_in_areas(points, boxes, "box", 1.0),
        J.distance_join(points, boxes.selectExpr("box", "west as b_lon", "south as b_lat", "radius"), 1.0),
    ):
        assert "Broadcast" not in found._jdf.queryExecution().sparkPlan().toString()


def test_nearest_halves_bins_in_crowds(spark):
    places = spark.range(4000).selectExpr("id % 64 / 64.0D as lon", "id div 64 / 64.0D as lat")
    k = J.halvings(places, 4.0)
    assert k >= 4 and J.halvings(places.limit(5), 4.0) == 0
    samples = spark.createDataFrame([(1, 0.3, 0.3), (2, 0.5, 0.5), (3, -90.0, 20.0)], "id int, lon double, lat double")
    at = [(r["lon"], r["lat"]) for r in places.collect()]
    want = {i: min(math.hypot(x - u, y - v) for u, v in at) for i, x, y in ((1, 0.3, 0.3), (2, 0.5, 0.5), (3, -90.0, 20.0))}
    found = {r["id"]: r["distance"] for r in J.nearest(samples, places.union(places), "id", 4.0).collect()}
    assert found.keys() == want.keys() and all(math.isclose(found[i], want[i], abs_tol=1e-12) for i in want)


def test_linked_within_makes_no_pairs_in_a_crowd(spark, monkeypatch):
    import random

    rng, rows, sizes = random.Random(3), J.written, {}

    def written(df, name, **options):
        out = rows(df, name, **options)
        sizes[name] = out.count()
        return out

    monkeypatch.setattr(J, "written", written)
    points = [(i, rng.random() * 0.3, rng.random() * 0.3) for i in range(1, 1500)] + [(i, rng.random() * 9, rng.random() * 9) for i in range(1500, 1650)] + [(0, 20.0, 20.0), (5000, 20.3, 20.4), (5001, 20.3, 20.9), (5002, None, 1.0)]
    root = {i: i for i, x, _ in points if x is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, x, y in points:
        for b, u, v in points:
            if a < b and None not in (x, u) and math.hypot(x - u, y - v) <= 0.5:
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    found = {r["node"]: r["component"] for r in J.linked_within(spark.createDataFrame(points, "id int, lon double, lat double"), "id", 0.5).collect()}
    assert found == {i: find(i) for i in root} and sizes["pairs"] < 1500


def test_region_files_counts_a_file_once_without_distinct_pairs(spark):
    regions = spark.createDataFrame([(1, [[0.0, 0.0, 4.0, 4.0], [3.0, 3.0, 6.0, 6.0], [0.0, 0.0, 4.0, 4.0]]), (2, [[50.0, 50.0, 51.0, 51.0]]), (3, [])], "region int, bounds array<array<double>>")
    files = spark.createDataFrame([(7, 10, 3.5, 3.5, 3.8, 3.8), (8, 100, 5.0, 5.0, 5.5, 5.5), (9, 1000, 9.0, 9.0, 9.5, 9.5)], "file int, bytes long, west double, south double, east double, north double")
    found = tiles.region_files(regions, files, "region", 1.0)
    assert {tuple(r) for r in found.collect()} == {(1, 2, 110), (2, 0, 0), (3, 0, 0)}
    assert {tuple(r) for r in tiles.region_files(regions.union(regions), files.union(files), "region", 1.0).distinct().collect()} == {(1, 2, 110), (2, 0, 0), (3, 0, 0)}
    assert "Distinct" not in found._jdf.queryExecution().analyzed().toString()


def test_chunks_are_never_sent_out_whole(spark):
    chunks = spark.range(3).selectExpr("id as k", "id as x0", "id as y0", "id + 1 as x1", "id + 1 as y1")
    found = tiles.possible_chunks(chunks, "k", spark.range(4).selectExpr("id as x", "id as y"), [F.col("x") > 2], halo=1)
    assert "Broadcast" not in found._jdf.queryExecution().sparkPlan().toString() and {r["k"] for r in found.collect()} == {1, 2}
