"""Queries over whole tables against brute force."""

import math

import pytest

from skyledger.plans import bindings, registry
from skyledger.plans.query import Tables

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def near(spark):
    t = Tables(spark, FOLDER)
    return [(r["id"], r["lon"], r["lat"]) for r in bindings.points(t).collect()], bindings.boxes(t).collect()


def test_single_link_takes_all_points(spark, near):
    points, root = near[0], {}
    for i, _, _ in points:
        root[i] = i

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, x, y in points:
        for b, u, v in points:
            if a < b and math.hypot(x - u, y - v) <= 0.5:
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    found = {r["id"]: r["root"] for r in registry.queries()["q_single_link"](spark, FOLDER).collect()}
    assert found == {i: find(i) for i in root} and len(found) > len(set(found.values()))


def test_chunks_cover_each_box(spark, near):
    found = registry.queries()["q_chunk_cover"](spark, FOLDER).collect()
    area = {}
    for r in found:
        area[r["box"]] = area.get(r["box"], 0) + (r["east"] - r["west"]) * (r["north"] - r["south"])
    assert all(math.isclose(area[b["box"]], (b["east"] - b["west"]) * (b["north"] - b["south"]), rel_tol=1e-6) for b in near[1])


def test_nearest_looks_at_all_points(spark, near):
    found = {r["box"]: r["distance"] for r in registry.queries()["q_nearest"](spark, FOLDER).collect()}
    want = {b["box"]: min(math.hypot(x - b["west"], y - b["south"]) for _, x, y in near[0]) for b in near[1]}
    assert found.keys() == want.keys() and all(math.isclose(found[k], want[k], abs_tol=1e-8) for k in want)


def test_tile_mask_has_every_cell(spark):
    cells = bindings.cells(Tables(spark, FOLDER)).collect()
    found = registry.queries()["q_tile_mask"](spark, FOLDER).collect()
    assert sum((r["mask"] & (1 << 64) - 1).bit_count() for r in found) == len(cells) and any(r["mask"] < 0 for r in found)


def test_density_counts_every_row_by_weight(spark):
    area = lambda y: math.tanh(math.pi * (1 - y / 64)) - math.tanh(math.pi * (1 - (y + 1) / 64))
    want = {}
    for r in bindings.cells(Tables(spark, FOLDER)).collect():
        at = want.setdefault((r["y"] // 4, r["x"] // 4), [0.0, 0.0, 0.0])
        w = area(r["y"]) / (4 * sum(area(r["y"] // 4 * 4 + i) for i in range(4)))
        at[0] += w * (r["lo"] >= 16)
        at[1] += w * (13 <= r["lo"] < 16)
        at[2] += w
    found = {(r["band"], r["block"]): (r["preferred"], r["fallback"], r["known"]) for r in registry.queries()["q_density"](spark, FOLDER).collect()}
    assert found.keys() == want.keys()
    assert all(math.isclose(a, b, abs_tol=1e-8) for k in want for a, b in zip(found[k], want[k], strict=True))


def test_search_looks_up_every_word_and_near_ones(spark, tmp_path):
    texts = {1: "alpha beta gamma delta runway", 2: "alpha beta gamma delta", 3: "alpha beta gamma delta rumway", 4: "alphabet beta gamma delta runways", 5: "alpha beta gamma runway"}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(9, "alpha beta gamma delta runway")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert {r["doc_id"] for r in registry.queries()["q_search_all"](spark, str(tmp_path)).collect()} == {1, 3, 4}
    found = {(r["term"], r["word"]) for r in registry.queries()["q_fuzzy_terms"](spark, str(tmp_path)).collect()}
    assert {("runway", "runway"), ("runway", "rumway"), ("runway", "runways"), ("alpha", "alphabet")} <= found
