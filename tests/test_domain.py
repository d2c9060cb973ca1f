"""Domain rules, readers and operators on small tables written here."""

import math
import random

import pytest
from pyspark.sql import functions as F

from skyledger.functions import aviation as V
from skyledger.operators import aggregates as A
from skyledger.operators import grid as G
from skyledger.operators import joins as J
from skyledger.operators import text as X
from skyledger.sources import readers as S


def test_scoped_lookup_never_multiplies_or_guesses(spark):
    rows = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (3, "c", "x"), (4, "a", "y")], "id int, name string, scope string")
    refs = spark.createDataFrame([("a", "x", 10), ("a", "x", 11), ("a", None, 12), ("b", None, 20), ("b", None, 20)], "name string, scope string, v int")
    found = sorted((r["id"], r["v"], r["reason"]) for r in J.scoped_lookup(rows, refs, "name", "scope", "v").collect())
    assert found == [(1, None, "ambiguous"), (2, 20, None), (3, None, "missing"), (4, 12, None)]


def test_rule_cascade_counts_before_it_joins(spark):
    left = spark.createDataFrame([(1, "a", 1), (2, "a", 2), (3, "b", 1), (4, "z", 1)], "id int, name string, size int")
    reviewed = spark.createDataFrame([(2, 99)], "id int, candidate int")
    right = spark.createDataFrame([("a", 1, 7), ("a", 1, 7), ("b", 5, 8), ("b", 6, 9)], "name string, size int, candidate int")
    found = sorted(map(tuple, J.rule_cascade(left, "id", [("reviewed", reviewed, ["id"]), ("exact", right, ["name", "size"]), ("name", right, ["name"])]).select("id", "rule", "status", "candidate").collect()))
    assert found == [(1, "exact", "matched", 7), (2, "reviewed", "matched", 99), (3, "name", "ambiguous", None), (4, None, "unmatched", None)]


def test_nearest_without_points_or_coordinates(spark):
    samples = spark.createDataFrame([(1, 0.0, 0.0), (2, None, 1.0)], "id int, lon double, lat double")
    none = spark.createDataFrame([], "lon double, lat double")
    assert {r["id"]: r["distance"] for r in J.nearest(samples, none, "id", 1.0).collect()} == {1: None, 2: None}
    one = spark.createDataFrame([(3.0, 4.0), (None, 0.0)], "lon double, lat double")
    assert {r["id"]: r["distance"] for r in J.nearest(samples, one, "id", 1.0).collect()} == {1: 5.0, 2: None}


def test_nearest_descends_to_far_clusters(spark):
    """All samples are far from the points, which stand in two tight groups and alone, on both sides of zero."""
    draw = random.Random(7)
    points = [(x + draw.random(), y + draw.random()) for x, y in [(60.0, 40.0), (-75.0, -20.0)] for _ in range(150)] + [(90.0, -80.0), (-0.5, 70.0)] * 2
    samples = [(i, draw.uniform(-170, 170), draw.uniform(-85, 85)) for i in range(200)] + [(900, float("nan"), 0.0)]
    at = spark.createDataFrame([*points, (float("nan"), 1.0)], "lon double, lat double")
    found = {r["id"]: r["distance"] for r in J.nearest(spark.createDataFrame(samples, "id int, lon double, lat double"), at, "id", 0.25).collect()}
    assert found.pop(900) is None
    assert found == {i: pytest.approx(min(math.hypot(x - a, y - b) for a, b in points)) for i, x, y in samples[:-1]}


def test_coverage_is_two_dimensional(spark):
    names = "box int, west double, south double, east double, north double"
    regions = spark.createDataFrame([(1, 0.0, 0.0, 4.0, 4.0), (2, 10.0, 0.0, 14.0, 4.0), (3, 20.0, 0.0, 24.0, 4.0)], names)
    parts = spark.createDataFrame([(1, -1.0, 0.0, 2.0, 5.0), (2, 2.0, 0.0, 5.0, 2.0), (3, 1.0, 2.0, 5.0, 4.0), (4, 10.0, 0.0, 14.0, 3.9)], names)
    assert {r["box"]: r["state"] for r in J.coverage_state(regions, parts, "box", 5.0).collect()} == {1: "available", 2: "partial", 3: "unavailable"}


def test_nearest_rank_is_exact_with_few_bins(spark):
    values = [((i * 7919) % 1000) / 7 for i in range(1000)] + [5.0] * 500
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    found = A.nearest_rank(df, "v", {"a": 0.0, "b": 0.5, "c": 0.95}, bins=3).first()
    ordered = sorted(values)
    assert tuple(found) == (ordered[0], ordered[750], ordered[1425], ordered[-1])
    assert tuple(A.nearest_rank(df.where("v = 5"), "v", {"a": 0.5}).first()) == (5.0, 5.0)


def test_polygons_with_slanted_edges_and_holes(spark):
    edges = lambda *p: [(a[0], a[1], b[0], b[1]) for a, b in zip(p, [*p[1:], p[0]], strict=True)]
    rings = [edges((0.0, 0.0), (10.0, 0.0), (5.0, 10.0)), edges((4.0, 2.0), (6.0, 2.0), (5.0, 4.0))]
    df = spark.createDataFrame([(1, rings)], "id int, rings array<array<struct<x1:double,y1:double,x2:double,y2:double>>>")
    assert df.select(G.polygon_area(F.col("rings"))).first()[0] == pytest.approx(48.0)
    inside = set()
    for r in G.rasterized(df, "id", F.flatten("rings"), 2).collect():
        inside |= {(x, r["k"]) for x in range(r["first"], r["last"] + 1)}

    def odd(x, y):
        return sum((a[1] < y <= a[3] or a[3] < y <= a[1]) and x > a[0] + (a[2] - a[0]) * (y - a[1]) / (a[3] - a[1]) for ring in rings for a in ring) % 2

    assert inside == {(i, k) for i in range(20) for k in range(20) if odd((i + 0.5) / 2, (k + 0.5) / 2)} and len(inside) > 150


def test_longest_runs_look_four_ways(spark):
    cells = spark.createDataFrame([(0, 0), (1, 1), (2, 2), (2, 0), (2, 1), (0, 2)], "x int, y int")
    best = {}
    for r in G.longest_runs(cells).collect():
        best[r["way"]] = max(best.get(r["way"], 0), r["longest"])
    assert best == {"row": 2, "column": 3, "diagonal": 3, "counter": 3}


def test_items_merge_on_one_line_without_blanks(spark):
    rows = [(1, 10.0, 0.0, 5.0, "RW"), (1, 10.0, 5.2, 3.0, "Y"), (1, 10.0, 11.0, 2.0, "9"), (1, 12.0, 13.0, 2.0, "L"), (1, 10.0, 12.0, 4.0, "x")]
    df = spark.createDataFrame(rows, "page int, y double, x double, width double, text string")
    assert sorted(r["text"] for r in X.merge_adjacent(df, "page", ["width"]).collect()) == ["9", "L", "RWY", "x"]
    apart = spark.createDataFrame([(1, 0.5, 0.0, 9.5, "A"), (1, 0.0, 10.0, 1.0, "B"), (2, 0.0, 0.0, 1.0, "c"), (2, 0.0, 1.0, 5.0, "d"), (2, 0.5, 6.5, 1.0, "e"), (2, 1.0, 7.5, 1.0, "f")], df.schema)
    assert sorted((r["page"], r["island"], r["text"], r["width"]) for r in X.merge_adjacent(apart, "page", []).collect()) == [(1, 0, "B", 1.0), (1, 1, "A", 9.5), (2, 0, "cde", 7.5), (2, 1, "f", 1.0)]


def test_search_bonus_for_phrases_and_citations(spark):
    found = spark.createDataFrame([(1, 10, 1.0), (1, 11, 1.0), (2, 12, 1.0), (2, 13, 1.0)], "q int, d int, score double")
    queries = spark.createDataFrame([(1, "Stall warning"), (2, "§ 91.103")], "q int, query string")
    titles = spark.createDataFrame([(10, "On stall warnings", None), (11, "Warning", "stall"), (12, "91.103 Preflight action", "x"), (13, "91.1035 Other", None)], "d int, title string, context string")
    scores = {r["d"]: r["score"] for r in X.with_title_bonus(found, queries, titles, "q", "d").collect()}
    assert scores == {10: 101.0, 11: 1.0, 12: 401.0, 13: 101.0}


def test_every_source_of_a_set_is_a_link(spark):
    html = '<img src="a.png" srcset="b.png 1x,  c.png 2x, d.png"><a href="e">x</a><style>@import "f.css"; p {background: url(g.gif)}</style>'
    assert {r["ref"] for r in X.links(spark.createDataFrame([(1, html), (2, None)], "id int, html string"), "id", "html").collect()} == {"a.png", "b.png", "c.png", "d.png", "e", "f.css", "g.gif"}


def test_fixed_width_lines_are_all_accounted_for(spark, tmp_path):
    path = tmp_path / "records.txt"
    lines = ["S" + "a" * 131, "H" + "b" * 131, "short", "", "HDR01" + " " * 30 + "2609"]
    path.write_text("\n".join(lines))
    good, rest = S.scan_fixed_width(spark, str(path), {"kind": (0, 1)}, section=F.col("value").startswith("S"))
    assert [r["kind"] for r in good.collect()] == ["S"]
    assert sorted(r["reason"] for r in rest.collect()) == ["section", "width", "width"]
    assert S.header_cycle(spark, str(path), "2609").count() == 0 and S.header_cycle(spark, str(path), "2610").count() == 1


def test_regulation_sections_in_subject_groups(spark, tmp_path):
    path = tmp_path / "title.xml"
    section = lambda n: f'<DIV8 N="{n}" TYPE="SECTION"><HEAD>Head {n}</HEAD><P>Text {n}</P></DIV8>'
    path.write_text(f'<X><DIV5 N="91" VOLUME="2">{section("91.1")}<DIV7 N="0" TYPE="SUBJGRP"><HEAD>Group</HEAD>{section("91.2")}</DIV7><DIV6 N="B">{section("91.3")}<DIV7 N="1"><HEAD>Inner</HEAD>{section("91.4")}</DIV7></DIV6></DIV5></X>')
    found = sorted((r["section"], r["subpart"], r["subject_group"]) for r in S.scan_regulation_xml(spark, str(path), volume="2").collect())
    assert found == [("91.1", None, None), ("91.2", None, "Group"), ("91.3", "B", None), ("91.4", "B", "Inner")]
    assert S.scan_regulation_xml(spark, str(path), volume="3").count() == 0


def test_readers_of_json_history_and_footprints(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"a": 1, "b": "x"}\n{"a": 2}\n')
    assert sorted((r["a"], r["b"]) for r in S.scan_json_lines(spark, str(tmp_path / "a.json"), "a int, b string").collect()) == [(1, "x"), (2, None)]
    for i in range(3):
        spark.createDataFrame([(i,)], "i int").write.parquet(str(tmp_path / f"f{i}"))
    assert S.scan_history(spark, str(tmp_path / "f1")).first()["i"] == 1
    catalog = spark.createDataFrame([(str(tmp_path / f"f{i}"), float(i), 0.0, i + 0.5, 1.0) for i in range(3)], "path string, west double, south double, east double, north double")
    assert [r["i"] for r in S.prune_partitions(spark, catalog, (0.9, 0.0, 1.2, 1.0)).collect()] == [1]
    assert S.prune_partitions(spark, catalog, (50.0, 0.0, 60.0, 1.0)).count() == 0


def test_ragged_and_empty_records_fail(spark, tmp_path):
    (tmp_path / "r.csv").write_text("A,B\n1,2\n3\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        S.scan_csv(spark, str(tmp_path / "r.csv"), ["A", "B"]).collect()
    (tmp_path / "o.csv").write_text("OAS,_country\n1,2\n,\n")
    with pytest.raises(Exception, match="without any value"):
        S.scan_obstacles(spark, str(tmp_path / "o.csv"), ["OAS", "_country"]).collect()


def test_coded_values(spark):
    one = spark.range(1)
    value = lambda c: one.select(c.alias("v")).first()["v"]
    assert value(V.rnp_miles(F.lit("302"))) == pytest.approx(0.3) and value(V.rnp_miles(F.lit("3x2"))) is None
    assert value(V.signed_hundredths(F.lit(" -300"))) == -3.0 and value(V.hold_minutes(F.lit("T010"))) == 1.0
    assert value(V.horizontal_accuracy(F.lit("9I"), F.lit(None), 75.0)) == 75.0 and value(V.horizontal_accuracy(F.lit("7D"), F.lit(None), 75.0)) == 926.0
    assert math.isclose(value(V.hazard_radius(F.lit("utility pole"), F.lit(100.0), F.lit(5.0), ("UTILITY_POLE",), 150.0, 30.0, 90.0, 1e4)), 155.0)
    assert value(V.hazard_radius(F.lit("mast"), F.lit(100.0), F.lit(5.0), (), 150.0, 30.0, 90.0, 100.0)) is None
