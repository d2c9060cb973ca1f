"""SimHash near-duplicates by meet-in-the-middle ball hashing."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.operators.graph import connected_components

from .common import LOWER_BYTES, chunks, utf8, written

CROWD = 64  # distinct fingerprints that share a half's variant, up to which their pairs are compared


def fingerprints_of(texts: list[bytes], shingle: int, seed: int) -> np.ndarray:
    """SimHash of each text: a bit is set if it is set in over half of the hashes of the word shingles, repeats included."""
    hashes, counts = [], []
    for text in texts:
        words = text.translate(LOWER_BYTES).split()
        line = b" ".join(words)
        if len(words) <= shingle:
            hashes.extend([xxhash.xxh64_intdigest(line, seed)] if words else [])
            counts.append(min(len(words), 1))
            continue
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        digest = xxhash.xxh64_intdigest
        hashes.extend([digest(line[s:e], seed) for s, e in zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist(), strict=True)])
        counts.append(len(words) - shingle + 1)
    n = np.array(counts, np.int64)
    out = np.zeros(len(texts), np.uint64)
    if not hashes:
        return out
    bits = np.unpackbits(np.array(hashes, np.uint64).astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    full = np.flatnonzero(n)
    votes = np.add.reduceat(bits, (np.cumsum(n) - n)[full], axis=0, dtype=np.int32)
    out[full] = np.packbits(2 * votes > n[full, None], axis=1).view(">u8").ravel()
    return out


def fingerprints(docs: DataFrame, shingle: int = 4, seed: int = 42) -> DataFrame:
    """(doc_id, fp): the 64-bit SimHash of each whole text as a signed long; null and wordless texts have 0."""

    def run(batches):
        for batch in batches:
            data, starts, ends = utf8(batch.column("text"))
            found = [fingerprints_of([data[s:e].tobytes() for s, e in zip(starts[i:j], ends[i:j], strict=True)], shingle, seed) for i, j in chunks(starts, ends)]
            fp = np.concatenate(found) if found else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fp.astype(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fp long")


def ball(bits: int, radius: int) -> Column:
    """All masks of up to ``radius`` of ``bits`` bits."""
    masks = [sum(1 << b for b in which) for r in range(radius + 1) for which in combinations(range(bits), r)]
    return F.array(*[F.lit(m - (1 << 64) if m >> 63 else m).cast("long") for m in masks])


def near(a: Column, b: Column, radius: int) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= radius


def once(most: int) -> str:
    """The one variant, of all that two words share, at which their pair is given: of the lower half if that differs in
    at most ``most`` bits, else of the upper one; the word of ``a`` itself if it is near enough to that of ``b``, else with its lowest differing bit turned."""

    def turned(x: str, y: str) -> str:
        return f"if(bit_count({x} ^ {y}) <= {-(-most // 2)}, {x}, {x} ^ (({x} ^ {y}) & -({x} ^ {y})))"

    low = [f"({w} & 4294967295L)" for w in "ab"]
    high = [f"shiftrightunsigned({w}, 32)" for w in "ab"]
    return f"if(bit_count({low[0]} ^ {low[1]}) <= {most}, {turned(*low)}, {turned(*high)} + 4294967296L)"


def links(prints: DataFrame, radius: int = 4, crowd: int = CROWD) -> DataFrame:
    """Edges (src, dst) between distinct fingerprints ``fp`` that connect all that differ in ``radius`` bits or fewer.

    Fingerprints within the radius differ in at most half of it in one of their halves, so some variant of that half
    lies within half of *that* from both: each fingerprint emits the ball of its two 32-bit halves (66 variants for a
    radius of 4), and the shuffle on variants brings them together. Variants met by one fingerprint end there; those
    met by a few give verified pairs, each at one of the variants that it shares. Where more than ``crowd`` meet, pairs would grow with the square, so their
    fingerprints emit the ball of half the radius over all 64 bits instead (2081 variants): whoever shares such a
    variant is within the radius, and one edge to the smallest suffices. No pair is lost either way."""
    if radius not in (0, 2, 4):
        raise ValueError("the radius must be 0, 2 or 4")
    word, half = F.col("fp"), -(-(radius // 2) // 2)
    low, high = word.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(word, 32)
    spread = prints.select("fp").repartition(int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    variants = spread.select("fp", F.explode(ball(32, half)).alias("mask")).select("fp", F.explode(F.array(low.bitwiseXOR(F.col("mask")), high.bitwiseXOR(F.col("mask")) + F.lit(1 << 32))).alias("variant"))
    met = written(variants.withColumn("n", F.count("*").over(Window.partitionBy("variant"))).where("n > 1"), "variants")
    groups = met.where(f"n <= {crowd}").groupBy("variant").agg(F.sort_array(F.collect_list("fp")).alias("fps"))
    few = groups.select(F.explode(F.expr(f"flatten(transform(fps, a -> transform(filter(fps, b -> b > a and bit_count(a ^ b) <= {radius} and variant = {once(radius // 2)}), b -> struct(a as src, b as dst))))")).alias("p")).select("p.src", "p.dst")
    crowded = met.where(f"n > {crowd}").select("fp").distinct()
    around = crowded.select("fp", F.explode(ball(64, radius // 2)).alias("mask")).select(F.col("fp").bitwiseXOR(F.col("mask")).alias("variant"), F.col("fp").alias("dst"))
    many = around.withColumn("src", F.min("dst").over(Window.partitionBy("variant"))).where("src != dst").select("src", "dst").where(near(F.col("src"), F.col("dst"), radius))
    return few.unionByName(many).distinct()


def near_duplicates(docs: DataFrame, radius: int = 4, shingle: int = 4, seed: int = 42, crowd: int = CROWD) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id and ``fp_root``, its component's smallest fingerprint.

    Equal fingerprints are one node, so copies never make pairs. component_id is the smallest doc_id that a document
    reaches over links of ``radius`` bits or fewer; null ids are members but never name a component, unless it has no
    other. Repeated rows stay. Wordless and null texts share fingerprint 0. Other columns are ignored. An empty table
    gives an empty result."""
    prints = written(fingerprints(docs, shingle, seed), "fingerprints")
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    found = connected_components(links(nodes.select("fp"), radius, crowd)).withColumnRenamed("node", "fp")
    nodes = nodes.join(found, "fp", "left").withColumn("fp_root", F.coalesce("component", "fp"))
    roots = nodes.groupBy("fp_root").agg(F.min("first").alias("component_id"))
    names = nodes.select("fp", "fp_root").join(roots, "fp_root")
    return prints.join(names, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "fp_root")
