"""Queries over text, pages and search."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger.functions.columns import normalize_text
from skyledger.operators import text as X
from skyledger.operators.lookup import search_texts

from .query import Query, Tables, query

QUERIES: list[Query] = []
NORMAL = "trim(regexp_replace(strip_accents(lower({c})), '[^a-z0-9]+', ' ', 'g'))"
TERMS = f"(SELECT doc_id, unnest(string_split({NORMAL.format(c='text')}, ' ')) AS term FROM documents)"


@query(QUERIES, f"SELECT doc_id, md5({NORMAL.format(c='text')}) AS digest FROM documents")
def q_normalize(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.md5(normalize_text(F.col("text")).cast("binary")).alias("digest"))


@query(QUERIES, f"SELECT term, count(DISTINCT doc_id)::BIGINT AS docs, count(*)::BIGINT AS n FROM {TERMS} WHERE term <> '' GROUP BY 1")
def q_inverted_index(t: Tables) -> DataFrame:
    """Terms with their documents and occurrences; the index has one row a term and document."""
    return X.inverted_index(t.documents, "doc_id", ["text"]).groupBy("term").agg(F.count("*").alias("docs"), F.sum("n").alias("n"))


SEARCH = f"""WITH q AS (SELECT DISTINCT item_id, unnest(string_split({NORMAL.format(c='text')}, ' ')) AS term FROM benchmark), i AS (SELECT term, doc_id, ln(1 + count(*)) AS tf FROM {TERMS} WHERE term IN (SELECT term FROM q) GROUP BY 1, 2),
f AS (SELECT term, count(*) AS df FROM i GROUP BY 1), w AS (SELECT term, doc_id, tf * ln(1 + (SELECT count(*) FROM documents) / df) AS w FROM i JOIN f USING (term)), need AS (SELECT item_id, count(*) AS need FROM q GROUP BY 1)
SELECT item_id, doc_id, round(sum(w), 6) AS score FROM q JOIN w USING (term) JOIN need USING (item_id) GROUP BY item_id, doc_id, need HAVING count(*) = need"""


def searched(t: Tables) -> DataFrame:
    terms = t.benchmark.select("item_id", F.explode(F.split(normalize_text(F.col("text")), " ")).alias("term")).distinct()
    return X.search(terms, X.inverted_index(t.documents, "doc_id", ["text"]), "item_id", "doc_id", {"text": 1.0}, t.documents.count())


@query(QUERIES, SEARCH)
def q_search(t: Tables) -> DataFrame:
    return searched(t).select("item_id", "doc_id", F.round("score", 6).alias("score"))


@query(QUERIES, f"SELECT item_id, doc_id, score FROM ({SEARCH}) ORDER BY score DESC, item_id, doc_id LIMIT 50")
def q_search_topk(t: Tables) -> DataFrame:
    return q_search(t).orderBy(F.desc("score"), "item_id", "doc_id").limit(50)


def asked_terms(t: Tables) -> DataFrame:
    return t.benchmark.select("item_id", F.explode(F.split(normalize_text(F.col("text")), " ")).alias("term")).where("term <> ''").distinct()


@query(QUERIES)
def q_search_all(t: Tables) -> DataFrame:
    """Documents that hold each word of an item, or for it a longer or near one; ``q_search`` asks for the words as they stand."""
    return search_texts(asked_terms(t), t.documents, "item_id", "doc_id", "text", "near").select("item_id", "doc_id", F.round("score", 6).alias("score"))


@query(QUERIES, f"WITH q AS (SELECT DISTINCT unnest(string_split({NORMAL.format(c='text')}, ' ')) AS term FROM benchmark), v AS (SELECT DISTINCT term AS word FROM {TERMS} WHERE term <> '') SELECT term, word FROM q JOIN v ON starts_with(word, term) OR levenshtein(term, word) <= floor(length(term) * 0.2) WHERE term <> ''")
def q_fuzzy_terms(t: Tables) -> DataFrame:
    words = t.documents.select(F.explode(F.array_distinct(F.split(normalize_text(F.col("text")), " "))).alias("word"))
    return X.fuzzy_terms(asked_terms(t), words)


@query(QUERIES, r"""WITH p AS (SELECT doc_id, text, coalesce(list_min([x FOR x IN [instr(lower(text), 'the'), instr(lower(text), 'le '), instr(lower(text), 'und')] IF x > 0]), 1) AS hit FROM documents), s AS (SELECT *, greatest(1, hit - 62) AS a, least(length(text), hit + 190) AS b FROM p)
SELECT doc_id, md5(CASE WHEN a > 1 THEN '…' ELSE '' END || trim(substr(text, a, b - a + 1)) || CASE WHEN b < length(text) THEN '…' ELSE '' END) AS digest FROM s""")
def q_snippet(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.md5(X.snippet(F.col("text"), ["the", "le ", "und"]).cast("binary")).alias("digest"))


#: Written apart from the operator's patterns: attributes are cut at their quotes, source sets at their commas.
LINK_SQL = r"""WITH a AS (SELECT page_id, unnest(regexp_extract_all(html, '(href|src|action|srcset)\s*=\s*(\"[^\"'']+\"|''[^\"'']+'')')) AS a, unnest(regexp_extract_all(html, '(href|src|action|srcset)\s*=\s*(\"[^\"'']+\"|''[^\"'']+'')', 1)) AS name FROM pages),
v AS (SELECT page_id, name, regexp_replace(regexp_replace(a, '^[a-z]+\s*=\s*.', ''), '.$', '') AS value FROM a),
u AS (SELECT page_id, unnest(regexp_extract_all(html, 'url\(\s*[\"'']?([^\"'')\s]+)', 1)) AS ref FROM pages UNION ALL SELECT page_id, unnest(regexp_extract_all(html, '@import\s+[\"'']([^\"'']+)[\"'']', 1)) FROM pages)
SELECT DISTINCT page_id, ref FROM (SELECT page_id, value AS ref FROM v WHERE name <> 'srcset' UNION ALL SELECT page_id, split_part(trim(unnest(string_split(value, ','))), ' ', 1) FROM v WHERE name = 'srcset' UNION ALL SELECT page_id, ref FROM u) WHERE ref <> ''"""


@query(QUERIES, LINK_SQL)
def q_links(t: Tables) -> DataFrame:
    return X.links(t.pages, "page_id", "html")


@query(QUERIES)
def q_resolve_links(t: Tables) -> DataFrame:
    return X.resolve_links(X.links(t.pages, "page_id", "html").join(t.pages.select("page_id", "url"), "page_id"), "page_id", "url").select("page_id", "ref", "target")


@query(QUERIES)
def q_rewrite_links(t: Tables) -> DataFrame:
    return X.rewrite_links(t.pages, "page_id", "url", "html").select("page_id", F.md5(F.col("html").cast("binary")).alias("digest"), F.length("html").alias("size"))


@query(QUERIES)
def q_html_sections(t: Tables) -> DataFrame:
    return X.html_sections(t.pages, "page_id", "html")


@query(QUERIES, "SELECT r_name AS part, n_name AS subpart, row_number() OVER (PARTITION BY r_name ORDER BY n_nationkey)::INT AS place, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey)::BIGINT AS sections FROM nation JOIN region ON n_regionkey = r_regionkey")
def q_toc(t: Tables) -> DataFrame:
    sections = t.customer.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("sections"))
    subparts = t.nation.join(sections, "n_nationkey", "left").na.fill(0, ["sections"]).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    parts = subparts.groupBy("r_name").agg(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name", "sections"))).alias("s"))
    return parts.select(F.col("r_name").alias("part"), F.posexplode("s").alias("place", "x")).select("part", F.col("x.n_name").alias("subpart"), (F.col("place") + 1).alias("place"), "x.sections")


@query(QUERIES, r"SELECT p_partkey, regexp_extract(h, '§ (\d+\.\d+)', 1) AS citation, regexp_extract(h, '§ \d+\.\d+ (.*)\.$', 1) AS subject FROM (SELECT p_partkey, '§ ' || p_size || '.' || p_partkey || ' ' || p_name || '.' AS h FROM part)")
def q_section_head(t: Tables) -> DataFrame:
    head = F.concat(F.lit("§ "), F.col("p_size").cast("string"), F.lit("."), F.col("p_partkey").cast("string"), F.lit(" "), F.col("p_name"), F.lit("."))
    return t.part.select("p_partkey", F.regexp_extract(head, r"§ (\d+\.\d+)", 1).alias("citation"), F.regexp_extract(head, r"§ \d+\.\d+ (.*)\.$", 1).alias("subject"))


@query(QUERIES, "SELECT conv_id, md5(string_agg(role || ': ' || text, chr(10) ORDER BY turn)) AS digest, count(*)::BIGINT AS turns FROM conversations GROUP BY 1")
def q_search_entries(t: Tables) -> DataFrame:
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", F.concat("role", F.lit(": "), "text").alias("line")))), lambda x: x["line"]), "\n")
    return t.conversations.groupBy("conv_id").agg(F.md5(joined.cast("binary")).alias("digest"), F.count("*").alias("turns"))


LINES = r"(SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1)::INT - 1 AS ord FROM documents)"


def document_lines(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("ord", "line"))


@query(QUERIES, f"WITH u AS (SELECT line, min(doc_id) AS page FROM (SELECT DISTINCT doc_id, line FROM {LINES}) GROUP BY 1 HAVING count(*) = 1), f AS (SELECT doc_id, line FROM {LINES} WHERE ord = 0) SELECT f.doc_id, u.page::DOUBLE AS page FROM f LEFT JOIN u USING (line)")
def q_page_lookup(t: Tables) -> DataFrame:
    """A document's first line names a page only if no other document has that line."""
    rows = document_lines(t)
    labels = rows.select("doc_id", "line").distinct().groupBy("line").agg(F.count("*").alias("n"), F.min("doc_id").cast("double").alias("page")).where("n = 1").drop("n")
    return rows.where("ord = 0").select("doc_id", "line").join(labels, "line", "left").select("doc_id", "page")


@query(QUERIES, f"WITH w AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]{{6,}}')) AS word FROM documents), b AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(lower(text), '[a-z]{{6,}}')) AS word FROM benchmark) SELECT item_id, word, min(doc_id) AS page FROM b JOIN w USING (word) GROUP BY 1, 2")
def q_first_token_page(t: Tables) -> DataFrame:
    words = lambda df, key: df.select(key, F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{6,}"), F.lit(0)))).alias("word"))
    first = words(t.documents, "doc_id").groupBy("word").agg(F.min("doc_id").alias("page"))
    return words(t.benchmark, "item_id").join(first, "word").select("item_id", "word", "page")


@query(QUERIES, f"SELECT doc_id, CASE WHEN count(DISTINCT line) = 1 THEN min(line) END AS label FROM {LINES} WHERE length(line) BETWEEN 1 AND 40 AND ord % 10 IN (0, 9) GROUP BY 1")
def q_page_labels(t: Tables) -> DataFrame:
    edge = document_lines(t).where("length(line) between 1 and 40 and ord % 10 in (0, 9)")
    return edge.groupBy("doc_id").agg(F.when(F.count_distinct("line") == 1, F.min("line")).alias("label"))


@query(QUERIES, "SELECT d.doc_id, p.url || '#sec-' || d.doc_id AS target FROM documents d JOIN pages p ON p.page_id = d.doc_id")
def q_link_targets(t: Tables) -> DataFrame:
    anchor = F.concat(F.lit("#sec-"), F.col("doc_id").cast("string"))
    return t.documents.select("doc_id").join(t.pages, F.col("doc_id") == F.col("page_id")).select("doc_id", F.concat("url", anchor).alias("target"))


def outline(t: Tables) -> DataFrame:
    marks = F.array(*[F.lit(m) for m in ("(a)", "(1)", "(i)", "(A)")])
    mark = F.element_at(marks, (F.col("ord") % 12 / 3).cast("int") + 1)
    inline = F.when(F.col("ord") % 5 == 4, F.concat("line", F.lit(". (2) "), "line")).otherwise(F.col("line"))
    return document_lines(t).select("doc_id", "ord", F.concat_ws(" ", mark, inline).alias("text"))


@query(QUERIES)
def q_outline_depth(t: Tables) -> DataFrame:
    return X.outline_depth(outline(t), "doc_id")


@query(QUERIES)
def q_split_inline(t: Tables) -> DataFrame:
    return X.split_inline(outline(t), "doc_id")
