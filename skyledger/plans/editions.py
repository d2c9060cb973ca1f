"""Queries over editions, printed pages and chunks that may hold something."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.operators import editions as E
from skyledger.operators import tiles

from .bindings import CELLS, cells
from .query import Query, Tables, query

QUERIES: list[Query] = []
ENDS = "(o_orderdate::DATE + (o_custkey % 57)::INT - 3)"


@query(QUERIES, f"""SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN s::VARCHAR END AS starts, e::VARCHAR AS ends, CASE WHEN o_orderkey % 5 = 0 THEN 'unreadable-start' WHEN e <= s THEN 'empty-interval' END AS reason,
CASE WHEN o_orderkey % 5 <> 0 THEN s::VARCHAR || '/' || e::VARCHAR END AS period FROM (SELECT o_orderkey, o_orderdate::DATE AS s, {ENDS} AS e FROM orders)""")
def q_effective_periods(t: Tables) -> DataFrame:
    """Start codes and periods in sentences, every fifth with a month that doesn't exist, read back as days."""
    rows = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("s"), F.date_add(F.to_date("o_orderdate"), (F.col("o_custkey") % 57).cast("int") - 3).alias("e"))
    code = lambda day: F.when(F.col("o_orderkey") % 5 == 0, F.regexp_replace(E.day_code(day), "[A-Z]{3}", "XYZ")).otherwise(E.day_code(day))
    words = lambda day, c: F.concat(F.dayofmonth(day).cast("string"), F.lit(" "), F.substring(c, 3, 3), F.lit(" "), F.substring(c, 6, 4))
    said = rows.withColumns({"a": code(F.col("s")), "b": E.day_code(F.col("e"))})
    text = F.concat(F.lit("Effective: 0901Z "), words(F.col("s"), F.col("a")), F.lit(" to 0901Z "), words(F.col("e"), F.lower("b")))
    read = said.select("o_orderkey", E.day_of_code(F.col("a")).alias("starts"), E.day_of_code(F.col("b")).alias("ends"), E.period_of_text(text).alias("p"))
    period = F.concat_ws("/", F.col("p.starts").cast("string"), F.col("p.ends").cast("string"))
    return read.select("o_orderkey", F.col("starts").cast("string").alias("starts"), F.col("ends").cast("string").alias("ends"), E.period_reason(F.col("starts"), F.col("ends")).alias("reason"), F.when(F.col("p").isNotNull(), period).alias("period"))


@query(QUERIES, """SELECT o_orderkey, CASE WHEN n % 28 = 0 THEN (CASE WHEN o_custkey % 5 < 4 THEN DATE '2026-09-03' + (floor(n / 56.0) * 56)::INT ELSE d END)::DATE::VARCHAR END AS effective
FROM (SELECT *, d - DATE '2026-09-03' AS n FROM (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 5 = 0 THEN o_orderdate::DATE ELSE DATE '1992-01-02' + (o_custkey % 90)::INT * 28 END AS d FROM orders))""")
def q_group_editions(t: Tables) -> DataFrame:
    """Editions of four groups that change every 56 days and one that changes every 28; every fifth day stands off the grid, but by chance."""
    cycle = F.when(F.col("o_orderkey") % 5 == 0, F.to_date("o_orderdate")).otherwise(F.date_add(F.lit("1992-01-02").cast("date"), (F.col("o_custkey") % 90 * 28).cast("int")))
    group = F.element_at(F.array(*map(F.lit, ("AWY", "PFR", "DP", "STAR", "APT"))), (F.col("o_custkey") % 5 + 1).cast("int"))
    return t.orders.select("o_orderkey", E.group_effective_day(cycle, group).cast("string").alias("effective"))


@query(QUERIES, f"""WITH v AS (SELECT o_orderkey, o_orderdate::DATE AS s, {ENDS} AS e, o_orderdate::DATE + (o_custkey % 40)::INT AS r FROM orders)
SELECT v.o_orderkey, CASE WHEN e <= v.s THEN 'empty-interval' WHEN NOT (v.s <= r AND r < e) THEN 'does-not-cover' WHEN x.o_orderkey IS NULL THEN 'no-index' WHEN x.a = v.s AND x.b = v.s THEN 'agrees' ELSE 'editions-differ' END AS state
FROM v LEFT JOIN (SELECT l_orderkey AS o_orderkey, min(d) AS a, max(d) AS b FROM (SELECT l_orderkey, o_orderdate::DATE + (l_partkey % 4 = 0)::INT AS d FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_linenumber <= 2 AND l_quantity > 10) GROUP BY 1) x USING (o_orderkey)""")
def q_edition_agreement(t: Tables) -> DataFrame:
    """Orders as parts of an edition, their first lines as what the index says, which now and then starts a day later."""
    day = F.to_date("o_orderdate")
    parts = t.orders.select("o_orderkey", day.alias("starts"), F.date_add(day, (F.col("o_custkey") % 57).cast("int") - 3).alias("ends"), F.date_add(day, (F.col("o_custkey") % 40).cast("int")).alias("revision"))
    lines = t.lineitem.where("l_linenumber <= 2 and l_quantity > 10").select(F.col("l_orderkey").alias("o_orderkey"), (F.col("l_partkey") % 4 == 0).cast("int").alias("late"))
    index = lines.join(parts.select("o_orderkey", "starts", "ends"), "o_orderkey").select("o_orderkey", F.date_add("starts", F.col("late")).alias("starts"), "ends")
    return E.edition_agreement(parts, index, "o_orderkey", "revision").select("o_orderkey", "state")


@query(QUERIES, "SELECT c AS cycle, c IN (SELECT strftime(l_shipdate, '%Y-%m-%d') FROM lineitem WHERE l_returnflag = 'R' AND l_linenumber = 1 AND l_quantity > 45) AS complete FROM (SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d') AS c FROM orders WHERE o_orderstatus <> 'P' AND o_orderkey % 3 <> 0 AND o_orderdate < TIMESTAMP '1997-06-02')")
def q_complete_cycles(t: Tables) -> DataFrame:
    """Days named by folders of two roots, among other names, and those for which a manifest was shipped."""
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    roots = [t.orders.where(f"o_orderstatus = '{s}'").select(F.when(F.col("o_orderkey") % 3 != 0, day("o_orderdate")).otherwise(F.concat(F.lit("tmp-"), F.col("o_orderkey").cast("string"))).alias("cycle")) for s in ("F", "O")]
    shipped = t.lineitem.where("l_returnflag = 'R' and l_linenumber = 1 and l_quantity > 45").select(day("l_shipdate").alias("cycle"))
    return E.cycles_with_manifest(roots[0].union(roots[1]), shipped, "1997-06-01")


@query(QUERIES, """WITH l AS (SELECT o_custkey % 50 AS volume, o_orderkey AS page, unnest(['A' || o_custkey % 7, 'B' || o_orderkey % 400, 'A' || o_custkey % 7, 'AB' || o_orderkey % 10000]) AS token FROM orders),
f AS (SELECT volume, token, min(page) AS a, max(page) AS b FROM l GROUP BY 1, 2), x AS (SELECT p_partkey, p_partkey % 50 AS volume, CASE WHEN p_size % 9 <> 0 THEN (CASE WHEN p_size % 2 = 0 THEN 'B' ELSE 'AB' END) || p_partkey % 400 END AS token FROM part)
SELECT p_partkey, CASE WHEN a = b THEN a END::DOUBLE AS page, CASE WHEN x.token IS NULL THEN 'no-page' WHEN a IS NULL THEN 'missing' WHEN a = b THEN 'resolved' ELSE 'ambiguous' END AS state FROM x LEFT JOIN f USING (volume, token)""")
def q_printed_pages(t: Tables) -> DataFrame:
    """Orders as pages with four printed labels, one of them twice and one that is none; parts as targets by section and number."""
    c = F.col
    label = lambda head, n: F.concat(F.lit(head), n.cast("string"))
    labels = F.array(label("a ", c("o_custkey") % 7), label(" B", c("o_orderkey") % 400), label("A", c("o_custkey") % 7), label("ab\t", c("o_orderkey") % 10000), label("see page ", c("o_orderkey") % 400))
    pages = t.orders.select((c("o_custkey") % 50).alias("volume"), c("o_orderkey").alias("page"), labels.alias("labels"))
    targets = t.part.select("p_partkey", (c("p_partkey") % 50).alias("volume"), F.when(c("p_size") % 2 == 0, "b").otherwise("Ab").alias("section"), F.when(c("p_size") % 9 != 0, (c("p_partkey") % 400).cast("string")).otherwise("").alias("printed"))
    return E.resolve_pages(targets, pages).select("p_partkey", c("page").cast("double").alias("page"), "state")


@query(QUERIES, f"""WITH c AS {CELLS}, w AS (SELECT p_partkey, (p_partkey * 7919) % 126 AS x0, (p_partkey * 104729) % 126 AS y0, p_size % 4 AS n FROM part), e AS (SELECT x, y, lo >= 30 AS known, hi >= 50 AS low, lines = 7 AS open FROM c WHERE lo >= 30 OR hi >= 50 OR lines = 7)
SELECT p_partkey FROM w JOIN e ON x BETWEEN x0 - 2 AND x0 + n + 2 AND y BETWEEN y0 - 2 AND y0 + n + 2 GROUP BY 1 HAVING bool_or(known) AND bool_or(low) AND bool_or(open)""")
def q_chunk_roles(t: Tables) -> DataFrame:
    """Chunks of up to four cells a side that may hold something: known ground, low cover and open ground each stand somewhere in the chunk or two cells around it."""
    c = F.col
    chunks = t.part.select("p_partkey", (c("p_partkey") * 7919 % 126).alias("x0"), (c("p_partkey") * 104729 % 126).alias("y0"), (c("p_size") % 4).alias("n"))
    chunks = chunks.select("p_partkey", "x0", "y0", (c("x0") + c("n")).alias("x1"), (c("y0") + c("n")).alias("y1"))
    return tiles.possible_chunks(chunks, "p_partkey", cells(t), [c("lo") >= 30, c("hi") >= 50, c("lines") == 7], halo=2)
