"""Editions, effective periods, agreement of sources, printed pages and possible chunks, by values and brute force."""

import datetime
import random

from pyspark.sql import functions as F

from skyledger.functions.columns import major_start
from skyledger.operators import editions as E
from skyledger.operators import tiles

D = datetime.date.fromisoformat


def test_codes_and_stamps_of_days(spark):
    values = ["09JUL2026", "29FEB2024", "29FEB2023", "9JUL2026", "09Jul2026", "09JLY2026", "09JUL2026 ", "", None]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").select("i", E.day_of_code(F.col("v")).alias("d"))
    assert [r["d"] for r in rows.orderBy("i").collect()] == [D("2026-07-09"), D("2024-02-29")] + [None] * 7
    days = [D("2026-07-09"), D("1999-12-01"), None]
    back = spark.createDataFrame([(d,) for d in days], "d date").select("d", E.day_code(F.col("d")).alias("c")).collect()
    assert {r["d"]: r["c"] for r in back} == {days[0]: "09JUL2026", days[1]: "01DEC1999", None: None}
    stamps = {"0901Z 07/09/26": D("2026-07-09"), "0901Z 13/09/26": None, "0902Z 07/09/26": None, "0901Z 7/9/26": None, "0901Z 02/30/26": None, "": None}
    got = spark.createDataFrame([(s,) for s in stamps], "s string").select("s", E.day_of_stamp(F.col("s")).alias("d")).collect()
    assert {r["s"]: r["d"] for r in got} == stamps


def test_periods_in_texts(spark):
    texts = {
        "Volume 3 Effective: 0901Z 9 JUL 2026 to 0901Z 6 Aug 2026, of 5": (D("2026-07-09"), D("2026-08-06")),
        "EFFECTIVE 0901Z  09 jul 2026\n to: 0901Z 31 AUG 2026 Effective 0901Z 1 JAN 2020 to 0901Z 2 JAN 2020": (D("2026-07-09"), D("2026-08-31")),
        "Effective 0901Z 31 JUN 2026 to 0901Z 6 AUG 2026": None,
        "Effective 0901Z 1 XYZ 2026 to 0901Z 6 AUG 2026": None,
        "Effective 9 JUL 2026": None,
        "": None,
        None: None,
    }
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", E.period_of_text(F.col("t")).alias("p")).collect()
    assert {r["t"]: r["p"] and (r["p"]["starts"], r["p"]["ends"]) for r in got} == texts
    pairs = [("2026-07-09", "2026-08-06", None), ("2026-07-09", "2026-07-09", "empty-interval"), (None, "2026-07-09", "unreadable-start"), ("2026-07-09", None, "unreadable-end"), ("2026-08-01", "2026-07-09", "empty-interval")]
    df = spark.createDataFrame([(i, a and D(a), b and D(b)) for i, (a, b, _) in enumerate(pairs)], "i int, a date, b date")
    assert [r["r"] for r in df.select("i", E.period_reason(F.col("a"), F.col("b")).alias("r")).orderBy("i").collect()] == [r for _, _, r in pairs]


def test_groups_keep_the_major_edition(spark):
    cases = [("2026-09-03", "AWY", "2026-09-03"), ("2026-10-01", "AWY", "2026-09-03"), ("2026-10-01", "APT", "2026-10-01"), ("2026-10-01", None, "2026-10-01"), ("2026-10-29", "STAR", "2026-10-29"), ("2026-08-06", "DP", "2026-07-09"), ("2026-08-06", "PFR", "2026-07-09"), ("2026-10-02", "APT", None), ("2026-10-1", "APT", None), ("x", "AWY", None), (None, "AWY", None)]
    df = spark.createDataFrame([(i, c, g) for i, (c, g, _) in enumerate(cases)], "i int, c string, g string").select("i", E.group_effective_day(F.col("c"), F.col("g")).cast("string").alias("d"))
    assert [r["d"] for r in df.orderBy("i").collect()] == [d for _, _, d in cases]
    days = spark.sql("select explode(sequence(date '2026-07-09', date '2026-09-02')) as d").select(major_start(F.col("d")).cast("string").alias("m")).distinct().collect()
    assert [r["m"] for r in days] == ["2026-07-09"]


def test_agreement_of_two_sources(spark):
    a, b, c = D("2026-07-09"), D("2026-09-03"), D("2026-08-01")
    rows = [(1, a, b, c, "agrees"), (2, a, b, a, "agrees"), (3, a, b, b, "does-not-cover"), (4, a, b, None, "does-not-cover"), (5, b, a, c, "empty-interval"), (6, None, b, c, "unreadable-start"), (7, a, b, c, "editions-differ"), (8, a, b, c, "editions-differ"), (9, a, b, c, "no-index"), (None, a, b, c, "no-index"), (10, a, b, c, "editions-differ"), (1, a, b, b, "does-not-cover")]
    parts = spark.createDataFrame([r[:4] for r in rows], "k int, starts date, ends date, day date")
    index = spark.createDataFrame([(k, a, b) for k in range(1, 7)] + [(1, a, b), (7, a, c), (8, a, b), (8, c, b), (10, None, b), (10, a, b), (None, a, b)], "k int, starts date, ends date")
    key = lambda r: (r[0] or 0, str(r[3]))
    got = sorted([tuple(r) for r in E.edition_agreement(parts, index, "k", "day").collect()], key=key)
    assert got == sorted(rows, key=key)
    assert E.edition_agreement(parts.limit(0), index, "k", "day").count() == 0


def test_cycles_and_their_manifests(spark):
    folders = spark.createDataFrame([(c,) for c in ("2026-07-09", "2026-09-03", "2026-07-09", "2026-02-30", "tmp", "2026-10-01", "2026-7-9", None)], "cycle string")
    manifests = spark.createDataFrame([("2026-07-09",), ("2026-07-09",), ("2020-01-02",), (None,)], "cycle string")
    assert [tuple(r) for r in E.cycles_with_manifest(folders, manifests).collect()] == [("2026-10-01", False), ("2026-09-03", False), ("2026-07-09", True)]
    assert [r["cycle"] for r in E.cycles_with_manifest(folders, manifests, "2026-09-03").collect()] == ["2026-09-03", "2026-07-09"]


def test_labels_that_name_one_page(spark):
    pages = [("NE1", 0, ["A 1", "a1", "12"]), ("NE1", 1, ["12", "TO 3"]), ("NE1", 2, ["abc9", "12345", None, "see 7", ""]), ("SW2", 0, ["A1", "7"]), ("SW2", 1, None)]
    targets = [(1, "NE1", "A", "1", 0, "resolved"), (2, "NE1", None, "12", None, "ambiguous"), (3, "NE1", "to", " 3", 1, "resolved"), (4, "NE1", "ABC", "9", None, "missing"), (5, "NE1", "A", None, None, "no-page"), (6, "NE1", "A", "", None, "no-page"), (7, "SW2", "", "7", 0, "resolved"), (8, None, "A", "1", None, "missing"), (9, "NE1", "", "7", None, "missing")]
    df = spark.createDataFrame([t[:4] for t in targets], "id int, volume string, section string, printed string")
    got = E.resolve_pages(df, spark.createDataFrame(pages, "volume string, page int, labels array<string>")).orderBy("id").collect()
    assert [(r["id"], r["volume"], r["section"], r["printed"], r["page"], r["state"]) for r in got] == targets


def test_possible_chunks_against_brute_force(spark):
    rng = random.Random(11)
    cells = [(rng.randrange(30), rng.randrange(30), rng.choice([None, 0, 1]), rng.choice([None, 0, 1]), rng.choice([0, 0, 1])) for _ in range(60)]
    chunks = [(i, x, y, x + rng.randrange(4), y + rng.randrange(4)) for i, (x, y) in enumerate((rng.randrange(30), rng.randrange(30)) for _ in range(80))]
    for halo in (0, 2):
        want = {k for k, x0, y0, x1, y1 in chunks if all(any(x0 - halo <= c[0] <= x1 + halo and y0 - halo <= c[1] <= y1 + halo and c[2 + r] == 1 for c in cells) for r in range(3))}
        got = tiles.possible_chunks(spark.createDataFrame(chunks, "k int, x0 int, y0 int, x1 int, y1 int"), "k", spark.createDataFrame(cells, "x int, y int, a int, b int, c int"), [F.col(n) == 1 for n in "abc"], halo).collect()
        assert {r["k"] for r in got} == want and len(got) == len(want)
    assert 0 < len(want) < 80
