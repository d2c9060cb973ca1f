"""The registered queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .common import table
from .ctw import ctw_scores
from .exchange import exact_duplicates
from .flac import media_round_trip
from .langid import identify
from .license import license_scan
from .mixing import by_length, mix
from .placement import SLOTS, lookup_table, place
from .quality import quality_scores
from .repair import encoded
from .simhash import near_duplicates
from .tiling import contamination
from .trie import conversation_trie
from .whitening import whiten

SHARDS = [f"shard-{i:03d}" for i in range(64)]
#: The phrases that op6's contract names; the operator's own take a bare mention of the MIT licence too.
LICENSE_BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))


def op1_ctw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw_scores(table(spark, sf_dir, "documents"))


def op2_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), preference=by_length()).select("doc_id", "size", "source_size", "target", "taken")


def op3_flac(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_round_trip(table(spark, sf_dir, "documents"))


def op4_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(table(spark, sf_dir, "documents"))


def op5_placement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return place(table(spark, sf_dir, "documents").select("doc_id", "text"), SHARDS).select("doc_id", "slot", "shard")


def op6_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"), base=LICENSE_BASE)


def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op8_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op10_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"))


def op12_exchange(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


def queries() -> dict:
    return {f.__name__: f for f in (op1_ctw, op2_pareto_mix, op3_flac, op4_repair, op5_placement, op6_license, op7_langid, op8_rules, op9_simhash, op10_tiling, op11_trie, op12_exchange, op13_whitening)}


MIX_SQL = r"""
WITH d AS (SELECT doc_id, coalesce('a' || source, 'b') AS key, CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END::BIGINT AS size FROM documents),
e AS (SELECT *, CASE WHEN size < 50 THEN 8 WHEN size < 200 THEN 16 WHEN size < 1000 THEN 24 ELSE 32 END::BIGINT AS class FROM d),
s AS (SELECT key, sum(size)::BIGINT AS source_size, [5, 2, 1][((row_number() OVER (ORDER BY key) - 1) % 3 + 1)::INT]::BIGINT AS weight FROM d GROUP BY key),
o AS (SELECT *, row_number() OVER w AS place, (sum(source_size) OVER ())::BIGINT - coalesce(sum(3 * source_size) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS left_over,
        (sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS share FROM s WINDOW w AS (ORDER BY source_size / weight, key)),
l AS (SELECT left_over, share FROM o WHERE (3 * source_size)::DOUBLE >= (weight * left_over)::DOUBLE / share ORDER BY place LIMIT 1),
t AS (SELECT key, source_size, least((3 * source_size)::DOUBLE, (weight * l.left_over)::DOUBLE / l.share) AS target FROM o, l),
k AS (SELECT key, class, source_size, target, floor(target)::BIGINT AS goal, words FROM (SELECT key, class, sum(size)::BIGINT AS words FROM e GROUP BY 1, 2) JOIN t USING (key)),
v AS (SELECT *, (goal - coalesce(sum(3 * words) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE / nullif(sum(words * class) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0)::DOUBLE AS level FROM k WINDOW w AS (PARTITION BY key ORDER BY class DESC)),
f AS (SELECT *, arg_max(level, class) FILTER (level * class <= 3) OVER (PARTITION BY key) AS first FROM v),
c AS (SELECT key, class, source_size, target, goal, CASE WHEN words = 0 THEN 0::DOUBLE WHEN first IS NULL THEN 3::DOUBLE ELSE least(3::DOUBLE, first * class) END AS copies FROM f),
r AS (SELECT e.*, source_size, target, goal, floor(copies)::BIGINT AS whole, copies - floor(copies) AS p, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT AS digits FROM e JOIN c USING (key, class)),
u AS (SELECT *, (digits::DOUBLE + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u FROM r),
q AS (SELECT *, CASE WHEN p > 0 AND size > 0 THEN u / (1::DOUBLE - u) / (p / (1::DOUBLE - p)) END AS rank, goal - (sum(whole * size) OVER (PARTITION BY key))::BIGINT AS need FROM u),
b AS (SELECT *, coalesce(sum(CASE WHEN rank IS NOT NULL THEN size END) OVER (PARTITION BY key ORDER BY rank NULLS LAST, digits, doc_id, size GROUPS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before,
        count(*) OVER (PARTITION BY key, rank, digits, doc_id, size) AS many FROM q)
SELECT doc_id, size, source_size, target, (whole * size + CASE WHEN rank IS NULL OR need <= before THEN 0 WHEN need - before >= size * many THEN size ELSE (need - before) // many END)::BIGINT AS taken FROM b
"""


TRIE_SQL = """
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, sha256(len(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest, len(coalesce(text, ''))::BIGINT AS size FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, list(digest ORDER BY turn NULLS FIRST, role, digest) AS s, list(size ORDER BY turn NULLS FIRST, role, digest) AS sizes,
        4294967295 - list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
          lambda crc, c: list_reduce([xor(crc, c), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))) AS crc FROM t GROUP BY conv_id),
r AS (SELECT o.conv_id, coalesce(b.s[1:o.crc % 6], []) || o.s[o.crc % 6 + 1:] AS s, coalesce(b.sizes[1:o.crc % 6], []) || o.sizes[o.crc % 6 + 1:] AS sizes FROM o LEFT JOIN o AS b ON b.conv_id = o.conv_id - o.conv_id % 100),
p AS (SELECT conv_id, d, s[1:d] AS s, coalesce(sizes[d], 0) AS size, d = len(s) AS whole FROM (SELECT *, unnest(range(len(s) + 1)) AS d FROM r)),
n AS (SELECT s, d, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(size) AS saved, sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (whole), '')) AS ends FROM p GROUP BY s, d),
c AS (SELECT s[1:d - 1] AS s, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1),
u AS (SELECT n.s[1:i] AS s, sum(saved)::BIGINT AS saved_tokens, count(*) FILTER (c.s IS NULL) AS n_leaves FROM (SELECT *, unnest(range(d + 1)) AS i FROM n) AS n LEFT JOIN c ON c.s = n.s GROUP BY 1)
SELECT n.conv_id, n.d::BIGINT AS depth, m.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children, u.n_leaves, u.saved_tokens, n.ends AS ends_sha256
FROM n JOIN u ON u.s = n.s LEFT JOIN c ON c.s = n.s LEFT JOIN n AS m ON n.d > 0 AND m.s = n.s[1:n.d - 1]
"""
EXACT_SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""


def oracle_sql() -> dict[str, str]:
    slots = ", ".join(map(str, lookup_table(SHARDS)))
    place_sql = f"""
WITH t AS (SELECT [{slots}] AS shard_of),
d AS (SELECT doc_id, (('0x' || substr(md5(coalesce(doc_id::VARCHAR, text, '')), 1, 15))::BIGINT % {SLOTS})::INT AS slot FROM documents)
SELECT doc_id, slot, 'shard-' || lpad(shard_of[slot + 1]::VARCHAR, 3, '0') AS shard FROM d, t
"""
    return {"op2_pareto_mix": MIX_SQL, "op5_placement": place_sql, "op11_trie": TRIE_SQL, "op12_exchange": EXACT_SQL}
