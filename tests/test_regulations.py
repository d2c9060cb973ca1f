"""Outlines, heads, contents with appendices, page labels, by values."""

import pytest
from pyspark.sql import functions as F

from skyledger.operators import outline as O
from skyledger.operators import regulation as R
from skyledger.operators import text as X
from skyledger.sources.readers import scan_regulation_xml

LISTS = {
    "compound": (["(a)(1) Combined lead.", "(i) First.", "(ii) Second.", "(b) Next.", "(h) Letter.", "(i) Next letter.", "(j) Another."], [2, 3, 3, 1, 1, 1, 1]),
    "numbers first": (["(1) one", "(a) two", "(b) two", "(i) three", "(A) four", "(ii) three", "(2) one"], [1, 2, 2, 3, 4, 3, 1]),
    "back to roman": (["(a) a", "(1) b", "(iv) c", "(A) d", "(B) d", "(v) c", "(2) b", "(b) a"], [1, 2, 3, 4, 4, 3, 2, 1]),
    "dots and doubled": (["1. one", "a. two", "aa) two", "zz. two", "2) one"], [1, 2, 2, 2, 1]),
    "no markers": (["(202) 267-1000 is a telephone", "(2020) too long", "(abc) no", "Approx. text", "(a)text without a break", "", None, "(A)—dash"], [None] * 7 + [1]),
    "upper only": (["(A) one", "(i) below", "(B) one"], [1, 1, 2]),
}


@pytest.mark.parametrize("name", sorted(LISTS))
def test_levels_of_lists(spark, name):
    lines, want = LISTS[name]
    df = spark.createDataFrame([(name, i, t) for i, t in enumerate(lines)] + [("other", i, "(a) x") for i in range(3)] + [(None, 0, "(1) y")], "section string, ord int, text string")
    found = {(r["section"], r["ord"]): r["level"] for r in O.outline_levels(df, "section").collect()}
    assert [found[(name, i)] for i in range(len(lines))] == want and found[(None, 0)] == 1 and found[("other", 2)] == 1


def test_a_long_section_is_a_stream(spark):
    n = 60_000
    df = spark.range(n).select(F.lit(1).alias("s"), F.col("id").alias("ord"), F.when(F.col("id") % 3 == 0, F.concat(F.lit("("), (F.col("id") % 9 + 1).cast("string"), F.lit(") x"))).otherwise("(a) y").alias("text"))
    levels = O.outline_levels(df.repartition(4), "s").groupBy("level").count().collect()
    assert {r["level"]: r["count"] for r in levels} == {1: n // 3, 2: 2 * n // 3}


def test_clauses():
    cases = {
        "(a) Lead clause—(1) Inline clause.": ["(a) Lead clause—", "(1) Inline clause."], "(a) One; (2) two: (i) three. and (4) four": ["(a) One;", "(2) two:", "(i) three. and", "(4) four"], "(a) As in paragraph (b) of this section.": ["(a) As in paragraph (b) of this section."],
        "(a) See. (b) of this section": ["(a) See. (b) of this section"], "(a) Call. (202) 267-1000": ["(a) Call. (202) 267-1000"], "No marker; (1) one": ["No marker; (1) one"], "(a)  Two   blanks; or (2) x": ["(a) Two blanks; or", "(2) x"], "(a) ends; (2)": ["(a) ends; (2)"], "(a) Years; (12) 5 of them": ["(a) Years; (12) 5 of them"], "": [""],
    }
    assert {t: O.clauses(t) for t in cases} == cases


def test_split_clauses_keeps_places(spark):
    df = spark.createDataFrame([("s", 0, "(a) One; (1) two"), ("s", 1, None), ("t", 0, "x")], "k string, ord int, text string")
    assert sorted(tuple(r) for r in O.split_clauses(df, "k").collect()) == [("s", 0, 0, "(a) One;"), ("s", 0, 1, "(1) two"), ("t", 0, 0, "x")]


def test_section_heads(spark):
    cases = [
        ("§§ 13.21 -13.29 [Reserved]", "13.21-13.29", ("§§ 13.21-13.29", "13.21-13.29", "[Reserved]")), ("Sec. 1-1 Applicability.", "1-1", ("§ 1-1", "1-1", "Applicability.")), ("§ 61.57 Recent  flight\nexperience.", "§ 61.57", ("§ 61.57", "61.57", "Recent flight experience.")),
        ("§ 61.571 Other", "61.57", ("§ 61.571", "61.57", "Other")), ("", "5.1", ("§ 5.1", "5.1", "")), (None, None, ("", "", "")), ("Only words", None, ("Only words", "", "")), ("Only words", "7", ("§ 7", "7", "Only words")), ("§ 3 – 5 Range", None, ("§ 3 – 5", "3 – 5", "Range")), ("§ 9.1—Dash", "9.1", ("§ 9.1", "9.1", "Dash")),
    ]
    df = spark.createDataFrame([(i, h, n) for i, (h, n, _) in enumerate(cases)], "i int, head string, number string")
    assert {r["i"]: tuple(r["h"]) for r in df.select("i", R.section_head(F.col("head"), F.col("number")).alias("h")).collect()} == {i: w for i, (_, _, w) in enumerate(cases)}
    parts = [("Pt. 61", "", "61"), ("PART 61.", None, "61"), (None, "PART 194—Special Federal Aviation Regulation", "194"), ("", "no number", None), ("91a", None, "91a")]
    df = spark.createDataFrame([(p[0], p[1]) for p in parts], "a string, b string")
    assert [r[0] for r in df.select(R.part_number(F.col("a"), F.col("b"))).collect()] == [p[2] for p in parts]


def test_appendices_and_contents(spark, tmp_path):
    section = lambda n, s: f'<DIV8 N="{n}" TYPE="SECTION"><HEAD>§ {n} {s}</HEAD><P>p of {n}</P></DIV8>'
    appendix = lambda n, *p: f'<DIV9 N="{n}" TYPE="APPENDIX"><HEAD>{n}: head</HEAD>{"".join(f"<P>{x}</P>" for x in p)}</DIV9>'
    xml = (
        f'<E><DIV5 N="91" VOLUME="2"><HEAD>PART 91</HEAD>{section("91.1", "First.")}<DIV7 N="x"><HEAD>Group one</HEAD>{section("91.3", "In group.")}{appendix("Appendix G", "g")}</DIV7>'
        f'<DIV6 N="A"><HEAD>Subpart A</HEAD>{section("91.101", "Sub.")}<DIV7><HEAD>Group two</HEAD>{section("91.103", "Deep.")}</DIV7>{appendix("Appendix S", "s1", "s <I>2</I>")}</DIV6>{appendix("Appendix A")}</DIV5><DIV5 N="92">{appendix("Appendix B", "b")}</DIV5></E>'
    )
    path = tmp_path / "r.xml"
    path.write_text(xml)
    rows = scan_regulation_xml(spark, str(path)).collect()
    assert sorted((r["kind"], r["section"], r["text"]) for r in rows if r["kind"] == "appendix") == [("appendix", "Appendix A", None), ("appendix", "Appendix B", "b"), ("appendix", "Appendix G", "g"), ("appendix", "Appendix S", "s 2"), ("appendix", "Appendix S", "s1")]
    assert len(rows) == 9 and {r["subpart_head"] for r in rows} == {None, "Subpart A"}
    found = [tuple(r) for r in R.contents(scan_regulation_xml(spark, str(path), ["91"], "2")).orderBy("place").collect()]
    assert found == [
        ("91", 1, 1, "section", "91.1", "First.", "seqnum91.1"), ("91", 2, 1, "group", None, "Group one", None), ("91", 3, 2, "section", "91.3", "In group.", "seqnum91.3"), ("91", 4, 2, "appendix", "Appendix G", "Appendix G: head", None),
        ("91", 5, 1, "subpart", "A", "Subpart A", None), ("91", 6, 2, "section", "91.101", "Sub.", "seqnum91.101"), ("91", 7, 2, "group", None, "Group two", None), ("91", 8, 3, "section", "91.103", "Deep.", "seqnum91.103"),
        ("91", 9, 2, "appendix", "Appendix S", "Appendix S: head", None), ("91", 10, 1, "appendix", "Appendix A", "Appendix A: head", None),
    ]


def test_labels_printed_on_pages(spark):
    items = [(1, 5.0, 190.0, 8.0, "A"), (1, 5.0, 198.5, 10.0, "-12"), (1, 590.0, 195.0, 10.0, "b-3"), (1, 300.0, 195.0, 10.0, "C-4"), (1, 5.0, 20.0, 10.0, "D-5"), (1, 591.0, 195.0, 10.0, "B-3"), (2, 5.0, 195.0, 10.0, "no label"), (2, 5.0, 195.0, 10.0, " "), (4, 1.0, 1.0, 1.0, "Z-1")]
    pages = spark.createDataFrame([(p, 400.0, 600.0) for p in (1, 2, 3)], "page int, page_width double, page_height double")
    found = X.page_labels(spark.createDataFrame(items, "page int, y double, x double, width double, text string"), pages, "page", ["text"], r"[A-Z]-\d+").collect()
    assert {r["page"]: r["labels"] for r in found} == {1: ["A-12", "B-3"], 2: [], 3: []}


def test_targets_below_a_root(spark):
    from urllib.parse import urljoin, urlsplit

    page, root = "https://a.org/docs/aim/page.html?x=1#y", "https://a.org/docs/"
    refs = ["b.html", "./b.html", "../c/d.html", "../../up.html", "/docs/e", "/other", "?q=2", "f/", "g/.", "g/..", "https://A.org/docs/h?i#j", "HTTPS://a.org/docs", "//a.org/docs/k", "//b.org/docs/k", "http://a.org/docs/l", "mailto:x@y", "data:text/plain,docs", "javascript:void(0)", "#top", "", " m.html ", "../../../../docs/n", "a&amp;b.html"]

    def want(ref):
        plain = ref.strip().replace("&amp;", "&")
        if not plain or plain.startswith("#"):
            return None
        u = urlsplit(urljoin(page, plain))
        full = f"{u.scheme}://{u.netloc.lower()}{u.path or '/'}"
        return full if full.startswith(root) else None

    df = spark.createDataFrame([(page, r) for r in refs] + [(page, None)], "url string, ref string")
    assert {r["ref"]: r["target"] for r in X.local_targets(df, "url", "ref", root).collect()} == {r: want(r) for r in refs} | {None: None}


def test_near_words_weigh_less(spark):
    docs = spark.createDataFrame([(1, "stall warning"), (2, "stalls warned"), (3, "stale warning"), (4, "stall"), (5, "warnings stall stall")], "d int, text string")
    index = X.inverted_index(docs, "d", ["text"])
    terms = spark.createDataFrame([(1, "stall"), (1, "warning"), (2, "nothing"), (2, "stall")], "q int, term string")
    found = {(r["q"], r["d"]): r["score"] for r in X.weighted_search(terms, index, index.select(F.col("term").alias("word")), "q", "d", {"text": 1.0}, 5).collect()}
    assert set(found) == {(1, 1), (1, 3), (1, 5)} and found[(1, 1)] > found[(1, 5)] > found[(1, 3)]
