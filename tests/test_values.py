"""Values of operators that SQL does not express, on small tables written here or by brute force."""

import random

from skyledger.operators import grid as G
from skyledger.operators import text as X
from skyledger.plans import bindings, registry
from skyledger.plans.query import Tables

FOLDER = "/root/testdata/sf0.001"


def test_outline_depths(spark):
    lines = ["intro", "(a) one", "(1) two", "(i) three", "(ii) three", "(A) four", "text", "(2) two", "(b) one", "(h) jumps", "(i) goes on", "(1) two", None]
    df = spark.createDataFrame([(7, i, t) for i, t in enumerate(lines)], "doc long, ord int, text string")
    found = [r["depth"] for r in sorted(X.outline_depth(df, "doc").collect(), key=lambda r: r["ord"])]
    assert found == [0, 1, 2, 3, 3, 4, 4, 2, 1, 1, 1, 2, 2]


def test_inline_markers(spark):
    df = spark.createDataFrame([(1, 0, "First; (1) one; (2) two: (a) see. (b) last"), (1, 1, "as in (2) of this"), (1, 2, None)], "doc long, ord int, text string")
    found = sorted((r["ord"], r["piece"], r["text"]) for r in X.split_inline(df, "doc").collect())
    assert found == [(0, 0, "First;"), (0, 1, "(1) one;"), (0, 2, "(2) two:"), (0, 3, "(a) see."), (0, 4, "(b) last"), (1, 0, "as in (2) of this")]


def test_sections_between_headings(spark):
    html = "<p>before</p><script>x<h1>no</h1></script><h1 id=a>One <b>bold</b></h1><p>text  here</p><h3></h3>tail<h2>Two</h2>"
    found = sorted((r["ord"], r["level"], r["title"], r["text"]) for r in X.html_sections(spark.createDataFrame([(1, html)], "id long, html string"), "id", "html").collect())
    assert found == [(0, None, None, "before"), (1, 1, "One bold", "text here"), (2, 3, None, "tail"), (3, 2, "Two", "")]


def test_links_resolve_and_are_rewritten(spark):
    base = "https://a.org/docs/page.html"
    refs = {"b.html": "https://a.org/docs/b.html", "/c?q=1#f": "https://a.org/c", "../d": "https://a.org/d", "https://other.org/x": None, "mailto:x@y": None, "": None}
    df = spark.createDataFrame([(base, r) for r in refs], "url string, ref string")
    assert {r["ref"]: r["target"] for r in X.resolve_links(df, "url", "url").collect()} == refs
    html = '<a href="b.html#s">x</a><a href="#top"><img srcset="i.png 1x, /j.png 2x"><form action="https://other.org/x"><p style="background:url(k.png)">'
    want = '<a href="/docs/b.html#s">x</a><a href="#top"><img srcset="/docs/i.png 1x, /j.png 2x"><form action="https://other.org/x"><p style="background:url(/docs/k.png)">'
    pages = spark.createDataFrame([(1, base, html), (2, None, None)], "id long, url string, html string")
    assert {r["id"]: r["html"] for r in X.rewrite_links(pages, "id", "url", "html").collect()} == {1: want, 2: ""}


def test_median_split_halves_by_the_wider_axis(spark):
    rng = random.Random(4)
    rows = [(i, float(rng.randrange(40)), float(rng.randrange(12))) for i in range(200)]

    def split(part, members, out):
        if len(members) <= 30:
            out |= {i: part for i, _, _ in members}
            return out
        xs, ys = [m[1] for m in members], [m[2] for m in members]
        axis = 1 if max(xs) - min(xs) >= max(ys) - min(ys) else 2
        ordered = sorted(members, key=lambda m: (m[axis], m[0]))
        half = len(members) // 2
        return split(part + "1", ordered[half:], split(part + "0", ordered[:half], out))

    table, setting = spark.createDataFrame(rows, "id int, x double, y double"), "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(setting)
    try:
        for together in ("true", "false"):  # slices of a group in one task, and in several
            spark.conf.set(setting, together)
            assert {r["id"]: r["part"] for r in G.median_split(table, "id", 30).collect()} == split("r", rows, {})
    finally:
        spark.conf.set(setting, before)


def test_qualified_components_by_flood_fill(spark):
    cells = {(r["x"], r["y"]): r["lo"] for r in bindings.cells(Tables(spark, FOLDER)).collect()}
    want = {}
    for name, least in (("preferred", 16), ("fallback", 13)):
        left, added = {c for c, lo in cells.items() if lo >= least}, {}
        while left:
            group, front = set(), [left.pop()]
            while front:
                x, y = front.pop()
                group.add((x, y))
                for near in ((x + 1, y), (x - 1, y), (x, y + 1), (x, y - 1)):
                    if near in left:
                        left.remove(near)
                        front.append(near)
            longest = 0
            for x, y in group:
                for dx, dy in ((1, 0), (0, 1)):
                    n = 0
                    while (x + n * dx, y + n * dy) in group:
                        n += 1
                    longest = max(longest, n)
            if longest >= 4:
                label = min(y * 128 + x for x, y in group)
                added |= {c: (label, longest, name) for c in group if c not in want}
        want |= added
    found = {(r["x"], r["y"]): (r["label"], r["longest"], r["role"]) for r in registry.queries()["q_qualify"](spark, FOLDER).collect()}
    assert found == want and want
