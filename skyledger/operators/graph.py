"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.functions.storage import forget, written


def large_star(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours are linked to its smallest neighbour or itself."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, source: str = "src", target: str = "dst", rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node that each node of ``edges`` reaches, itself included.

    Two passes a round, each an aggregation with map-side combine and a join that adaptive execution can split;
    every round is written, so a lost executor costs one round at most. Stops when a round changes nothing, after a
    number of rounds that grows with the logarithm of the longest path. Edges with a null end are left out."""
    nodes = edges.select(F.col(source).alias("u"), F.col(target).alias("v")).where("u is not null and v is not null")
    alone = nodes.where("u = v").select("u")
    pairs = written(nodes.where("u != v").distinct(), "edges")
    mark = None
    for _ in range(rounds):
        before, pairs = pairs, written(small_star(large_star(pairs)), "edges")
        forget(before)
        seen = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark:
            break
        mark = seen
    else:
        raise RuntimeError("components did not settle")
    roots = pairs.select(F.col("v").alias("node")).unionByName(alone.select(F.col("u").alias("node"))).distinct()
    found = pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return found.unionByName(roots.join(found, "node", "left_anti").withColumn("component", F.col("node")))


def along_chains(links: DataFrame, seen: DataFrame, front: DataFrame) -> DataFrame:
    """``front`` and all nodes (``node``) on the chains that begin there: a chain goes on from a node with one link to nodes not in ``seen``.

    Steps are doubled, so a chain of any length takes a number of passes that grows with its logarithm."""
    left = links.where("src != dst").join(seen.select(F.col("node").alias("dst")), "dst", "left_anti")
    step = written(left.groupBy("src").agg(F.min("dst").alias("dst"), F.max("dst").alias("last")).where("dst = last").select("src", "dst"), "steps")
    cover = written(front.select("node"), "cover")
    size = cover.count()
    while True:
        met = cover.join(step, cover["node"] == step["src"]).select(F.col("dst").alias("node"))
        before, cover = cover, written(cover.unionByName(met).distinct(), "cover")
        last, size = size, cover.count()
        forget(before)
        if size == last:
            forget(step)
            return cover
        on = step.select(F.col("src").alias("dst"), F.col("dst").alias("next"))
        before, step = step, written(step.join(on, "dst").select("src", F.col("next").alias("dst")), "steps")
        forget(before)


def reachable(links: DataFrame, start: DataFrame, patience: int = 3) -> DataFrame:
    """(node) that ``links`` (src, dst) reach from the nodes ``start``, these included, whether or not they have links.

    A frontier goes a link further each round. Where it has not grown for a round, ``patience`` rounds after the last time,
    it first takes whole chains, so a long thin path needs no round a page. Links with a null end are left out."""
    links = written(links.where("src is not null and dst is not null").distinct(), "links")
    front = written(start.select("node").where("node is not null").distinct(), "front")
    seen, n, last, rounds = [front], front.count(), 0, 0
    while n:
        if rounds >= patience and n <= last:
            before = seen
            known = written(all_of(seen), "seen")
            cover = along_chains(links, known, front)
            front = written(cover.join(known, "node", "left_anti").unionByName(front), "front")
            seen = [written(all_of([known, front]).distinct(), "seen")]
            forget(*before, known, cover)
            last, rounds = front.count(), 0
        else:
            last = n
        found = links.join(front.select(F.col("node").alias("src")), "src").select(F.col("dst").alias("node")).distinct()
        front = written(found.join(all_of(seen), "node", "left_anti"), "front")
        n, rounds = front.count(), rounds + 1
        seen.append(front)
    forget(links)
    return all_of(seen)


def all_of(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for df in tables[1:]:
        out = out.unionByName(df)
    return out
