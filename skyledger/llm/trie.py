"""Conversation prefix trie: ternary search trees over ranges of turn sequences, merged along the ranges' borders."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import forget, written

DIGEST, CODE = 16, 20  # bytes of a turn's digest, and of its code: the digest and the text's length in code points
BASE_STEP, HEADS = 100, 6  # conversations that share a base, and how many first turns (0 to 5) they take from it
SHARD_BYTES = 12 << 20  # codes of one shard, about: 600,000 turns
PIECE = 1024  # ids in one piece of a list of members
NO_END = hashlib.sha256(b"").digest()

STATS = ["depth", "n_convs", "n_children", "n_leaves", "saved_tokens"]
SHARD_SCHEMA = "shard int, slot int, edge boolean, code binary, conv_id long, parent_conv_id long, depth long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends binary"
MERGED_SCHEMA = "shard int, slot int, serial long, parent_serial long, conv_id long, depth long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends binary"


# Sequences of turns


def turn_code(role: Column, text: Column) -> Column:
    """Code of a turn, in hex digits: equal for equal (role, text), null counting as empty."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    return F.concat(F.upper(F.substring(digest, 1, 2 * DIGEST)), F.lpad(F.hex(F.length(text)), 2 * (CODE - DIGEST), F.lit("0")))


def turn_sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, seq): the codes of every conversation's turns, in order of turn, nulls first; ties by role, then by code."""
    coded = turns.where("conv_id is not null").select("conv_id", F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), turn_code(F.col("role"), F.col("text")).alias("code")).alias("t"))
    return coded.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t")).select("conv_id", F.unhex(F.array_join("t.code", "")).alias("seq"))


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, seq) with the first turns of every conversation taken from the first of its hundred.

    The first h turns of conversation c - c % 100 come first, then c's own turns after its first h, where h is
    crc32(decimal c) % 6. A base that is absent gives none, a shorter one all it has."""
    own, first = turn_sequences(turns), F.col("conv_id") - F.col("conv_id") % BASE_STEP
    heads = turn_sequences(turns.where(first == F.col("conv_id"))).select(F.col("conv_id").alias("base"), F.substring("seq", 1, (HEADS - 1) * CODE).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS * CODE).cast("int")
    seq = F.concat(F.coalesce(F.substring("head", F.lit(1), h), F.lit(b"")), F.substring("seq", h + 1, F.octet_length("seq")))
    return own.withColumn("base", first).join(heads, "base", "left").select("conv_id", seq.alias("seq"))


# Digests of member lists


def member_pieces(batches):
    """mapInArrow function over rows in order of (key, conv_id): decimal ids of one key, ``PIECE`` at most, joined."""
    key, ids, done = None, [], []

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), (pa.binary(), pa.int64(), pa.string()), strict=True)], names=["key", "first", "piece"])

    for rows in batches:
        for k, i in zip(rows.column("key").to_pylist(), rows.column("conv_id").to_pylist(), strict=True):
            if ids and (k != key or len(ids) == PIECE):
                done.append((key, ids[0], ",".join(map(str, ids))))
                ids = []
            key = k
            ids.append(i)
            if len(done) == 4 * PIECE:
                yield batch()
                done = []
    if ids:
        done.append((key, ids[0], ",".join(map(str, ids))))
    if done:
        yield batch()


def piece_digests(batches):
    """mapInArrow function over pieces in order of (key, first): SHA-256 of each key's ids, one piece in memory at a time."""
    key, state = None, None
    for rows in batches:
        keys, found = [], []
        for k, piece in zip(rows.column("key").to_pylist(), rows.column("piece").to_pylist(), strict=True):
            if state is not None and k == key:
                state.update(b",")
            else:
                if state is not None:
                    keys.append(key)
                    found.append(state.digest())
                key, state = k, hashlib.sha256()
            state.update(piece.encode())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(found, pa.binary())], names=["key", "ends"])
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.digest()], pa.binary())], names=["key", "ends"])


def member_digests(members: DataFrame) -> DataFrame:
    """(key, ends) from (key, conv_id): SHA-256 of each key's decimal ids, ascending, comma-joined.

    Ids are put in order by ranges of (key, conv_id), so a key that holds a third of all rows is ordered by many tasks;
    the digest of one list is a chain and passes through one task as a stream of pieces."""
    ordered = members.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    pieces = ordered.mapInArrow(member_pieces, "key binary, first long, piece string")
    return pieces.repartition("key").sortWithinPartitions("key", "first").mapInArrow(piece_digests, "key binary, ends binary")


# One shard


class TernaryTree:
    """A ternary search tree whose nodes are the prefixes of the sequences put in; node 0 is the empty prefix."""

    def __init__(self) -> None:
        self.code, self.low, self.equal, self.high, self.parent, self.depth = [-1], [0], [0], [0], [-1], [0]
        self.members, self.least = [0], [None]

    def _new(self, code: int, parent: int) -> int:
        for column, value in ((self.code, code), (self.low, 0), (self.equal, 0), (self.high, 0), (self.parent, parent), (self.depth, self.depth[parent] + 1), (self.members, 0), (self.least, None)):
            column.append(value)
        return len(self.code) - 1

    def child(self, node: int, code: int) -> int:
        """The node of ``code`` below ``node``, made where it is missing."""
        at, code_of = self.equal[node], self.code
        if not at:
            self.equal[node] = made = self._new(code, node)
            return made
        while code != code_of[at]:
            side = self.low if code < code_of[at] else self.high
            if not side[at]:
                side[at] = made = self._new(code, node)
                return made
            at = side[at]
        return at

    def insert(self, codes: list[int], count: int, least: int) -> int:
        """Adds a sequence that ``count`` members share; the node where it ends."""
        node, members, smallest = 0, self.members, self.least
        for code in (None, *codes):
            if code is not None:
                node = self.child(node, code)
            members[node] += count
            if smallest[node] is None or least < smallest[node]:
                smallest[node] = least
        return node

    def path(self, codes: list[int]) -> list[int]:
        nodes = [0]
        for code in codes:
            nodes.append(self.child(nodes[-1], code))
        return nodes


def medians(n: int):
    """0 to n - 1, the middle first, then the middles of both sides, and so on."""
    open_ranges = [(0, n)]
    while open_ranges:
        a, b = open_ranges.pop()
        if a < b:
            middle = (a + b) // 2
            yield middle
            open_ranges += [(middle + 1, b), (a, middle)]


def shard_rows(shard: int, seqs: list[bytes], counts: list[int], leasts: list[int], ends: list[bytes]) -> pa.RecordBatch:
    """All nodes of one shard of sequences in ascending order.

    Nodes on the paths of the first and the last sequence may go on in other shards: these are ``edge`` rows, whose
    numbers leave out their children on those paths, numbered by ``slot`` along the first path and then the last one.
    All others are final; ``slot`` then names the edge row that is the parent, if it is one."""
    width = np.array([len(s) // CODE for s in seqs])
    turns = np.frombuffer(b"".join(seqs), f"V{CODE}")
    words, at = np.unique(turns, return_inverse=True)
    length = np.frombuffer(words.tobytes(), np.uint8).reshape(-1, CODE)[:, DIGEST:].copy().view(">u4").ravel().tolist()
    cuts = np.concatenate(([0], np.cumsum(width))).tolist()
    at, tree, end_of = at.tolist(), TernaryTree(), {}
    for i in medians(len(seqs)):
        end_of[tree.insert(at[cuts[i] : cuts[i + 1]], counts[i], leasts[i])] = ends[i]
    first, last = tree.path(at[: cuts[1]]), tree.path(at[cuts[-2] :])
    slot_of = {}
    for node in first + last:
        slot_of.setdefault(node, len(slot_of))

    n = len(tree.code)
    children, leaves, saved = [0] * n, [0] * n, [0] * n
    for v in range(n - 1, 0, -1):  # a node is made after its parent
        if v not in slot_of:
            p = tree.parent[v]
            leaves[v] = leaves[v] or 1
            saved[v] += (tree.members[v] - 1) * length[tree.code[v]]
            children[p] += 1
            leaves[p] += leaves[v]
            saved[p] += saved[v]
    edge = [v in slot_of for v in range(n)]
    inner = [v > 0 and not edge[v] and not edge[tree.parent[v]] for v in range(n)]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([shard] * n, pa.int32()), pa.array([slot_of[v] if edge[v] else None if inner[v] else slot_of[tree.parent[v]] for v in range(n)], pa.int32()), pa.array(edge),
            pa.array([words[tree.code[v]].tobytes() if edge[v] and v else None for v in range(n)], pa.binary()), pa.array(tree.least, pa.int64()),
            pa.array([tree.least[tree.parent[v]] if inner[v] else None for v in range(n)], pa.int64()), *(pa.array(c, pa.int64()) for c in (tree.depth, tree.members, children, leaves, saved)),
            pa.array([end_of.get(v) for v in range(n)], pa.binary()),
        ],
        names=["shard", "slot", "edge", "code", "conv_id", "parent_conv_id", *STATS, "ends"],
    )


def shard_nodes(batches):
    """mapInArrow function: the nodes of the task's range of sequences, which come in ascending order."""
    columns = [[], [], [], []]
    for batch in batches:
        for into, name in zip(columns, ("seq", "n", "least", "ends"), strict=True):
            into += batch.column(name).to_pylist()
    if columns[0]:
        rows = shard_rows(TaskContext.get().partitionId(), *columns)
        for a in range(0, rows.num_rows, 50_000):
            yield rows.slice(a, 50_000)


# Borders


class Open:
    """A node on the border path whose members are still coming in."""

    def __init__(self, serial: int, parent: int | None, row: dict) -> None:
        self.serial, self.parent, self.depth, self.code = serial, parent, row["depth"], row["code"]
        self.least, self.n, self.children, self.leaves, self.saved, self.ends = row["conv_id"], 0, 0, 0, 0, None

    def add(self, row: dict) -> None:
        self.least = min(self.least, row["conv_id"])
        self.n += row["n_convs"]
        self.children += row["n_children"]
        self.leaves += row["n_leaves"]
        self.saved += row["saved_tokens"]
        self.ends = row["ends"] or self.ends


def merge_borders(batches):
    """mapInArrow function over edge rows in order of (shard, slot): merged nodes, and which one each edge row became.

    The path of nodes that may go on is a stack; a node is closed, and added to its parent, when the path leaves it."""
    path, made, at = [], 0, {"shard": None, "depth": 0}
    names = ["shard", "slot", "serial", "parent_serial", "conv_id", *STATS, "ends"]

    def close(down_to: int, out: list[tuple]) -> None:
        while len(path) > down_to:
            v = path.pop()
            v.saved += (v.n - 1) * int.from_bytes(v.code[DIGEST:], "big") if v.code else 0
            v.leaves = v.leaves or 1
            if path:
                path[-1].children += 1
                path[-1].leaves += v.leaves
                path[-1].saved += v.saved
            out.append((None, None, v.serial, v.parent, v.least, v.depth, v.n, v.children, v.leaves, v.saved, v.ends))

    def batch(out: list[tuple]):
        kinds = (pa.int32(), pa.int32(), *[pa.int64()] * 8, pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    for rows in batches:
        out = []
        for row in rows.to_pylist():
            d = row["depth"]
            if d < len(path) and (path[d].code != row["code"] or (row["shard"] == at["shard"] and d <= at["depth"])):
                close(d, out)
            if d == len(path):
                path.append(Open(made, path[-1].serial if path else None, row))
                made += 1
            path[d].add(row)
            out.append((row["shard"], row["slot"], path[d].serial, *[None] * 8))
            at = row
        yield batch(out)
    if path:
        out = []
        close(0, out)
        yield batch(out)


def conversation_trie(turns: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row a distinct prefix of the rebuilt conversations of ``turns`` (conv_id, turn, role, text), the root included.

    conv_id (smallest member), depth, parent_conv_id (null for the root), n_convs, n_children, n_leaves, saved_tokens and
    ends_sha256. Rows of a null conv_id belong to no conversation. Turns that share conv_id and turn follow each other
    by role, then by digest; repeated rows are turns of their own. Other columns are ignored. An empty table gives an
    empty result.

    Turns are coded by 16 bytes of SHA-256 and their length, so that texts are not shuffled; equal sequences become one
    with a count before sequences are dealt out by ranges. A shard numbers its codes and builds its tree; edge rows of
    all shards, two paths each, pass through one task as a stream. A conversation's codes are one value of less than 2 GB, some 50 million turns in hex."""
    spark = turns.sparkSession
    members = written(rebuilt(turns), "rebuilt")
    key = F.substring(F.unhex(F.sha2("seq", 256)), 1, DIGEST)
    groups = members.groupBy("seq").agg(F.count("*").alias("n"), F.min("conv_id").alias("least")).withColumn("key", key)
    sequences = written(groups.join(member_digests(members.select(key.alias("key"), "conv_id")), "key").select("seq", "n", "least", "ends"), "sequences")
    size = sequences.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("seq")), F.lit(0)).alias("bytes")).first()
    shards = max(-(-size["bytes"] // shard_bytes), min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size["n"] // 2048)), 1)
    nodes = written(sequences.repartitionByRange(shards, "seq").sortWithinPartitions("seq").mapInArrow(shard_nodes, SHARD_SCHEMA), "nodes")
    merged = written(nodes.where("edge").repartition(1).sortWithinPartitions("shard", "slot").mapInArrow(merge_borders, MERGED_SCHEMA), "borders")
    forget(members, sequences)

    tops = merged.where("shard is null")
    parents = tops.select(F.col("serial").alias("parent_serial"), F.col("conv_id").alias("parent_conv_id"))
    slots = merged.where("shard is not null").select("shard", "slot", "serial").join(tops.select("serial", F.col("conv_id").alias("parent_conv_id")), "serial").drop("serial")
    final = ["conv_id", "parent_conv_id", *STATS, "ends"]
    found = nodes.where("not edge and slot is null").select(final)
    found = found.unionByName(nodes.where("not edge and slot is not null").drop("parent_conv_id").join(slots, ["shard", "slot"]).select(final))
    found = found.unionByName(tops.join(parents, "parent_serial", "left").select(final))
    ends = F.lower(F.hex(F.coalesce("ends", F.lit(NO_END)))).alias("ends_sha256")
    return found.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", ends)
