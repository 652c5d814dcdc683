"""Operator 11, conversation prefix trie: ternary search trees over dictionary-encoded turn ids, one for each range shard.

A dictionary numbers the distinct turns (role, text). Equal conversations become one sequence of turn numbers with its members
counted, and the sequences, in their order, are dealt out in ranges. Within a range, each SHARD_TURNS turns or so are put in a tree of
their own, the middle sequence first, then the middle ones of both halves, and so on; a traversal without recursion finds
the nodes from the top down, and adds up members, leaves and savings from the bottom up.

Only the prefixes of a shard's first and last sequence can be nodes of another shard, too. These come out as parts and are
merged by a hash of their path. What a merged node adds to its ancestors is summed along one of the two paths that it lies on, so
merging handles a few rows for each shard and never the nodes below.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loyalflow.llm.shared import spread_join, written

#: Turns in a tree, bytes of ids in a chunk of a digest, and most turns taken from another conversation.
SHARD_TURNS, CHUNK, HEAD = 1 << 19, 1 << 16, 5
EMPTY_SHA = hashlib.sha256(b"").hexdigest()
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
#: kind: 0 a node that is all in its shard, 1 the same below a border node, 2 a part of a border node on the path to the
#: shard's first sequence, 3 on the path to its last one (own false: on both, and counted on the first).
_MADE = f"{NODE}, kind int, shard long, own boolean, key binary, parent_key binary, tokens long"
_MADE_ARROW = pa.schema([*((c, pa.int64()) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")), ("ends_sha256", pa.string()),
                         ("kind", pa.int32()), ("shard", pa.int64()), ("own", pa.bool_()), ("key", pa.binary()), ("parent_key", pa.binary()), ("tokens", pa.int64())])


class Trie:
    """A ternary search tree in flat arrays: a node's turn, the smaller and the larger one beside it, and one that follows it."""

    def __init__(self) -> None:
        self.turn, self.tokens, self.up, self.depth = array("q"), array("q"), array("q"), array("q")
        self.low, self.same, self.high = array("q"), array("q"), array("q")
        self.members, self.least = array("q"), array("q")
        self.ends: dict[int, str] = {}
        self._new(-1, 0, -1, 0)  # the root, which has no turn

    def _new(self, turn: int, tokens: int, up: int, depth: int) -> int:
        for column, x in ((self.turn, turn), (self.tokens, tokens), (self.up, up), (self.depth, depth), (self.low, -1), (self.same, -1), (self.high, -1), (self.members, 0), (self.least, -1)):
            column.append(x)
        return len(self.turn) - 1

    def _child(self, at: int, turn: int, tokens: int) -> int:
        """The node of a turn after the one of ``at``, made where there is none."""
        here = self.same[at]
        if here < 0:
            self.same[at] = self._new(turn, tokens, at, self.depth[at] + 1)
            return self.same[at]
        while self.turn[here] != turn:
            links = self.low if turn < self.turn[here] else self.high
            if links[here] < 0:
                links[here] = self._new(turn, tokens, at, self.depth[at] + 1)
            here = links[here]
        return here

    def insert(self, turns: list[int], tokens: list[int], members: int, least: int, ends: str) -> list[int]:
        """Add a sequence; the nodes on its path."""
        path = [0]
        for turn, n in zip(turns, tokens, strict=True):
            path.append(self._child(path[-1], turn, n))
        at = path[-1]
        self.members[at], self.least[at], self.ends[at] = members, least, ends
        return path

    def traversal(self) -> Iterator[int]:
        """Every node after the one before its turn."""
        stack = [0]
        while stack:
            at = stack.pop()
            yield at
            stack.extend(x for x in (self.high[at], self.low[at], self.same[at]) if x >= 0)

    def totals(self, border: set[int]) -> tuple[array, array, array]:
        """(children, leaves, savings) below and with each node; a border node has those of its other children only."""
        zero = array("q", bytes(8 * len(self.turn)))
        children, leaves, saved = zero[:], zero[:], zero[:]
        for at in reversed(list(self.traversal())):
            up, edge = self.up[at], at in border
            if not edge:
                leaves[at] += children[at] == 0
                saved[at] += (self.members[at] - 1) * self.tokens[at]
            if up >= 0:
                self.members[up] += self.members[at]
                self.least[up] = self.least[at] if self.least[up] < 0 else min(self.least[up], self.least[at])
                if not edge:
                    children[up] += 1
                    leaves[up] += leaves[at]
                    saved[up] += saved[at]
        return children, leaves, saved


def middle_first(n: int) -> Iterator[int]:
    """0 to n - 1: the middle, then the middles of both halves, and so on."""
    stack = [(0, n)]
    while stack:
        a, b = stack.pop()
        if a < b:
            yield (a + b) // 2
            stack += [((a + b) // 2 + 1, b), (a, (a + b) // 2)]


def shard_nodes(rows: list[dict], shard: int) -> Iterator[dict]:
    """Nodes and parts of nodes of sorted, distinct sequences."""
    trie, paths = Trie(), {}
    lowest = min(r["conv_id"] for r in rows)  # least members are kept as distances, so that -1 can mean none
    for i in middle_first(len(rows)):
        r = rows[i]
        path = trie.insert(r["turns"], r["tokens"], r["members"], r["conv_id"] - lowest, r["ends"])
        if i in (0, len(rows) - 1):
            paths[i] = path
    first, last = paths[0], paths[len(rows) - 1]
    on_first = set(first)
    border = on_first | set(last)
    children, leaves, saved = trie.totals(border)
    keys: dict[int, bytes] = {}
    for path in (first, last):
        name = hashlib.blake2b(digest_size=16)
        for at in path:
            name.update(trie.turn[at].to_bytes(8, "little", signed=True))
            keys[at] = name.copy().digest()

    def row(at: int, kind: int, own: bool = True) -> dict:
        up = trie.up[at]
        edge = kind >= 2
        return {
            "conv_id": trie.least[at] + lowest, "depth": trie.depth[at], "parent_conv_id": trie.least[up] + lowest if kind == 0 else None,
            "n_convs": trie.members[at] if own else 0, "n_children": children[at] if own else 0, "n_leaves": leaves[at] if own else 0,
            "saved_tokens": saved[at] if own else 0, "ends_sha256": trie.ends.get(at, None if edge else EMPTY_SHA), "kind": kind, "shard": shard, "own": own,
            "key": keys[at] if edge else None, "parent_key": keys.get(up), "tokens": trie.tokens[at],
        }

    for at in trie.traversal():
        if at not in border:
            yield row(at, 1 if trie.up[at] in border else 0)
    yield from (row(at, 2) for at in first)
    yield from (row(at, 3, at not in on_first) for at in last)


def _shards(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """From sequences sorted within their range."""
    part = TaskContext.get().partitionId()

    def trees() -> Iterator[list[dict]]:
        held, size = [], 0
        for b in batches:
            for a in range(0, b.num_rows, 1000):
                for r in b.slice(a, 1000).to_pylist():
                    held.append(r)
                    size += len(r["turns"]) + 1
                    if size >= most:
                        yield held
                        held, size = [], 0
        if held:
            yield held

    for k, held in enumerate(trees()):
        out = []
        for r in shard_nodes(held, part << 32 | k):
            out.append(r)
            if len(out) == 20_000:
                yield pa.RecordBatch.from_pylist(out, _MADE_ARROW)
                out = []
        yield pa.RecordBatch.from_pylist(out, _MADE_ARROW)


def _chunks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """(key, first, ids): sorted ids of a sequence, joined by commas, in chunks."""
    key, ids, size = None, [], 0
    made: list[tuple[bytes, int, str]] = []

    def done() -> Iterator[pa.RecordBatch]:
        keys, first, text = zip(*made, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(first, pa.int64()), pa.array(text, pa.string())], ["key", "first", "ids"])
        made.clear()

    for b in batches:
        for k, i in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            if ids and (k != key or size > most):
                made.append((key, ids[0], ",".join(map(str, ids))))
                ids, size = [], 0
                if len(made) == 5000:
                    yield from done()
            key = k
            ids.append(i)
            size += 12
    if ids:
        made.append((key, ids[0], ",".join(map(str, ids))))
    if made:
        yield from done()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, ends) from sorted chunks, as a stream."""
    key, digest, out = None, None, []

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.binary()), pa.array([d for _, d in out], pa.string())], ["key", "ends"])

    for b in batches:
        for k, ids in zip(b.column(0).to_pylist(), b.column(2), strict=True):
            if k != key:
                if digest:
                    out.append((key, digest.hexdigest()))
                key, digest = k, hashlib.sha256()
                if len(out) >= 5000:
                    yield done()
                    out = []
            else:
                digest.update(b",")
            digest.update(ids.as_py().encode())
    if digest:
        out.append((key, digest.hexdigest()))
    if out:
        yield done()


def rebuilt(conversations: DataFrame) -> DataFrame:
    """conv_id, turns (numbers of distinct turns), tokens (their texts' code points): each conversation after its own turns are put
    behind the first ones of another, as the query's contract has it.

    Turns are in the order of turn (null first), then role, then the SHA-256 of the text. Null roles and texts are empty; rows
    without a conv_id belong to no conversation. A conversation's turn numbers, not its texts, are together in one row."""
    rows = conversations.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")))
    rows = rows.select("conv_id", "turn", "role", F.unhex(F.sha2("text", 256)).alias("sha"), F.length("text").cast("long").alias("tokens"))
    known = written(rows.groupBy("role", "sha").agg(F.first("tokens").alias("tokens")).withColumn("id", F.monotonically_increasing_id()), "dictionary")
    coded = spread_join(rows.drop("tokens"), known, ["role", "sha"], F.struct("conv_id", "turn"))
    own = coded.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "sha", "id", "tokens"))).alias("t"))
    own = written(own.select("conv_id", F.transform("t", lambda x: x["id"]).alias("turns"), F.transform("t", lambda x: x["tokens"]).alias("tokens")), "conversations")
    heads = own.where("conv_id % 100 = 0").select(F.col("conv_id").alias("base"), F.slice("turns", 1, HEAD).alias("t0"), F.slice("tokens", 1, HEAD).alias("n0"))
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6).cast("int")
    own = own.withColumns({"base": F.col("conv_id") - F.col("conv_id") % 100, "h": taken}).join(heads, "base", "left")

    def whole(head: str, tail: str):
        none = F.array().cast("array<bigint>")
        return F.concat(F.slice(F.coalesce(head, none), F.lit(1), F.col("h")), F.slice(tail, F.col("h") + 1, F.size(tail)))

    return own.select("conv_id", whole("t0", "turns").alias("turns"), whole("n0", "tokens").alias("tokens"))


def prefix_nodes(sequences: DataFrame, shard_turns: int = SHARD_TURNS, chunk: int = CHUNK) -> DataFrame:
    """The nodes of all prefixes of ``sequences`` (conv_id long, turns and tokens array<bigint>; conv_id is unique): conv_id, depth, which
    together name a node, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256. No sequences: no nodes."""
    name = F.unhex(F.md5(F.array_join(F.transform("turns", lambda x: x.cast("string")), ",").cast("binary")))
    rows = written(sequences.select("conv_id", name.alias("key"), "turns", "tokens"), "sequences")
    distinct = rows.groupBy("key").agg(F.count(F.lit(1)).alias("members"), F.min("conv_id").alias("conv_id"), F.first("turns").alias("turns"), F.first("tokens").alias("tokens"))
    ids = rows.select("key", "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    chunks = ids.mapInArrow(partial(_chunks, most=chunk), "key binary, first long, ids string")
    ends = chunks.repartition("key").sortWithinPartitions("key", "first").mapInArrow(_digests, "key binary, ends string")
    sorted_rows = distinct.join(ends, "key").select("conv_id", "turns", "tokens", "members", "ends").repartitionByRange("turns").sortWithinPartitions("turns")
    made = written(sorted_rows.mapInArrow(partial(_shards, most=shard_turns), _MADE), "nodes")
    out = [c.split()[0] for c in NODE.split(", ")]

    parts = made.where("kind >= 2")
    node = parts.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.first("parent_key").alias("parent_key"), F.first("tokens").alias("tokens"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
        F.max("ends_sha256").alias("ends_sha256"), F.min(F.struct("shard", "kind")).alias("owner"),
    )
    edges = node.where(F.col("parent_key").isNotNull()).groupBy(F.col("parent_key").alias("key")).agg(F.count(F.lit(1)).alias("edges"))
    node = node.join(edges, "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("edges", F.lit(0)))
    node = node.withColumn("n_leaves", F.col("n_leaves") + (F.col("n_children") == 0).cast("long"))
    node = written(node.withColumn("saved_tokens", F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("tokens")).drop("edges", "tokens"), "borders")
    # each node adds to those above it on one path to a shard's first or last sequence
    above = Window.partitionBy("shard", "kind").orderBy(F.desc("depth"))
    paths = parts.select("shard", "kind", "depth", "key").join(node.select("key", "owner", "n_leaves", "saved_tokens"), "key")
    mine = (F.col("owner.shard") == F.col("shard")) & (F.col("owner.kind") == F.col("kind"))
    paths = paths.select("key", *(F.sum(F.when(mine, F.col(c)).otherwise(0)).over(above).alias(c) for c in ("n_leaves", "saved_tokens")))
    sums = paths.groupBy("key").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    up = node.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    border = node.drop("n_leaves", "saved_tokens").join(sums, "key").join(up, "parent_key", "left")
    border = border.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY_SHA))).select(*out)
    # nodes right below a border node learn its conv_id within their shard
    seen = parts.where("own").select("shard", F.col("key").alias("parent_key")).join(up, "parent_key")
    below = made.where("kind = 1").drop("parent_conv_id").join(seen, ["shard", "parent_key"]).select(*out)
    return made.where("kind = 0").select(*out).unionByName(below).unionByName(border)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_nodes(rebuilt(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


QUERIES = {"op11_prefix_trie": op11_prefix_trie}
#: A CRC-32 bit by bit (-1 stands for a shift); nodes as lists of turns.
ORACLE_SQL = {
    "op11_prefix_trie": """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, list({'r': role, 't': text} ORDER BY turn NULLS FIRST, role, sha256(text)) AS turns FROM t GROUP BY conv_id
), h AS (
  SELECT conv_id, turns, conv_id - conv_id % 100 AS base, xor(list_reduce(
    list_concat([4294967295::BIGINT], flatten(list_transform(string_split(conv_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda s, x: CASE WHEN x >= 0 THEN xor(s, x) WHEN s & 1 = 1 THEN xor(s >> 1, 3988292384) ELSE s >> 1 END), 4294967295::BIGINT) % 6 AS h
  FROM own
), seq AS (
  SELECT h.conv_id, list_concat(coalesce(b.turns, [])[1:h.h], h.turns[h.h + 1:]) AS s FROM h LEFT JOIN own b ON b.conv_id = h.base
), pre AS (
  SELECT conv_id, d AS depth, s[1:d] AS node, len(s) = d AS stops FROM (SELECT *, unnest(range(len(s) + 1)) AS d FROM seq)
), nodes AS (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (stops), '')) AS ends_sha256
  FROM pre GROUP BY node, depth
), kids AS (
  SELECT c.node, c.depth, c.conv_id, c.n_convs, c.ends_sha256, p.conv_id AS parent_conv_id, count(k.depth) AS n_children
  FROM nodes c LEFT JOIN nodes p ON p.depth = c.depth - 1 AND p.node = c.node[1:c.depth - 1] AND c.depth > 0
  LEFT JOIN nodes k ON k.depth = c.depth + 1 AND k.node[1:c.depth] = c.node
  GROUP BY ALL
), sums AS (
  SELECT node[1:d] AS node, d AS depth, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves,
    sum(CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * length(node[depth]['t']) END) AS saved_tokens
  FROM (SELECT *, unnest(range(depth + 1)) AS d FROM kids) GROUP BY ALL
)
SELECT k.conv_id::BIGINT AS conv_id, k.depth::BIGINT AS depth, k.parent_conv_id::BIGINT AS parent_conv_id, k.n_convs::BIGINT AS n_convs,
  k.n_children::BIGINT AS n_children, s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, k.ends_sha256
FROM kids k JOIN sums s ON s.depth = k.depth AND s.node = k.node
"""
}
