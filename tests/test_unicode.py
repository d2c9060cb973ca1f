"""Text normalisation against the Unicode database, a code point at a time."""

import re
import sys
import unicodedata

from pyspark.sql import functions as F

from skyledger.functions.columns import normalize_text


def plain(text):
    text = re.sub("[̀-ͯ]", "", unicodedata.normalize("NFKD", text))
    return re.sub("[^a-z0-9]+", " ", text).strip()


def test_every_code_point_that_decomposes(spark):
    codes = [c for c in range(0x20, sys.maxunicode + 1) if not 0xD800 <= c < 0xE000 and (c < 0x3000 or unicodedata.decomposition(chr(c)))]
    rows = [(c, f"a{chr(c)}b {chr(c)}{chr(c)}") for c in codes]
    found = spark.createDataFrame(rows, "c int, text string").select("c", F.lower("text").alias("low"), normalize_text(F.col("text")).alias("n")).collect()
    assert [r["c"] for r in found if r["n"] != plain(r["low"])] == [] and len(found) > 15_000


def test_words_of_several_languages(spark):
    texts = {"Škoda in Győr": "skoda in gyor", "ﬁnd ½ ㎏": "find 1 2 kg", "Ａ１ ℌ x²": "a1 x2", "été": "ete", "straße Łódź": "stra e odz", "": "", None: None}
    found = spark.createDataFrame([(t,) for t in texts], "t string").select("t", normalize_text(F.col("t")).alias("n")).collect()
    assert {r["t"]: r["n"] for r in found} == texts
