"""Operator 2, n-gram Jaccard join: chosen paths.

A document is its set of word shingles; equal sets are one class from the start. In each run a set picks some of its own
shingles by a hash, about 1 / (LAMBDA * size) of them, and goes to the bucket of each; within a bucket it picks again,
and so on. Sets that share most shingles meet on some path. Buckets of at most SMALL sets are compared as they are;
larger ones are split further, and what is still large at the last level is compared in blocks of that size, each pair
of blocks in a group of its own. RUNS follows from the target recall.

In a bucket, sketches choose candidates; a pair belongs to the least bucket that both its sets are in, so it counts once
although it meets often, and no pairs leave a bucket: sets with a candidate are fetched whole, their Jaccard
similarity is worked out exactly, and a bucket returns each set's number of links and one edge to its least neighbour.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loyalflow.llm.shared import spread_join, tasks, written
from loyalflow.llm.words import mix, shingles, words

SHINGLE, SIMILARITY = 5, 0.8
TARGET_RECALL, LAMBDA, DEPTH, SMALL = 0.999, 0.7, 3, 1024
BINS = 64
#: Rows of a group up to which its pairs are looked at one distance after the other.
FEW = 24
#: Standard deviations that a sketch may fall short of the threshold: of 64 bins, a pair at it loses more in 2 of 10 ** 8 cases.
MARGIN = 6
#: Parts that a text without an identifier is fetched in.
SPREAD = 16
_ODD, _ODD2 = np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
SETS = "doc_id long, digest long, row long, cls binary, n int, sketch binary, paths array<struct<p1: bigint, p2s: array<struct<p2: bigint, p3s: array<bigint>>>>>"


def runs_needed(target: float = TARGET_RECALL, similarity: float = SIMILARITY) -> int:
    """Runs until a pair at the threshold meets on the last level of one of them with the target probability.

    Such a pair shares at least ``similarity`` of the larger set, so a bucket passes on similarity / LAMBDA common
    picks on average (about Poisson): a branching process that must live for DEPTH generations."""
    alive = 1.0
    for _ in range(DEPTH):
        alive = 1 - math.exp(-similarity / LAMBDA * alive)
    return math.ceil(math.log(1 - target) / math.log(1 - alive))


def _picks(paths: np.ndarray, s: np.ndarray, most: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """For each path, the shingles whose hash with it is small enough: (path, shingle) numbers."""
    step = max(1, (1 << 20) // len(s))
    found = []
    for a in range(0, len(paths), step):
        h = (s[None, :] ^ paths[a : a + step, None]) * _ODD
        h ^= h >> np.uint64(32)
        i, j = np.nonzero(h * _ODD2 < most)
        found.append((i + a, j))
    return np.concatenate([i for i, _ in found]), np.concatenate([j for _, j in found])


def _tree(s: np.ndarray, seeds: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """By level: (parent's number, path) of each node of a set's tree."""
    most = np.uint64(min((1 << 64) - 1, int((1 << 64) / (LAMBDA * len(s)))))
    paths, levels = seeds, []
    for _ in range(DEPTH):
        i, j = _picks(paths, s, most) if len(paths) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        paths = mix(paths[i] * _ODD + s[j])
        levels.append((i, paths))
    return levels


def sketch(s: np.ndarray) -> bytes:
    """One byte for each of BINS ranges of hashes: of the least one in it, 0 for none. s: sorted."""
    edges = np.arange(BINS, dtype=np.uint64) << np.uint64(64 - BINS.bit_length() + 1)
    at = np.searchsorted(s, edges)
    end = np.append(at[1:], len(s))
    low = (s[np.minimum(at, len(s) - 1)] % np.uint64(255) + np.uint64(1)).astype(np.uint8)
    return np.where(at < end, low, np.uint8(0)).tobytes()


def class_of(s: np.ndarray) -> bytes:
    """A 128-bit name of the set."""
    return np.array([np.bitwise_xor.reduce(mix(s + _ODD)), mix(s ^ _ODD2).sum(dtype=np.uint64)]).tobytes()


def _row_sets(column: pa.Array) -> Iterator[np.ndarray]:
    for w in words(column):
        h, offsets = shingles(w, SHINGLE)
        for a, b in zip(offsets, offsets[1:], strict=False):
            yield np.unique(h[a:b])


def _list(counts: list[np.ndarray], values: pa.Array) -> pa.Array:
    total = np.concatenate([[0], np.cumsum(np.concatenate(counts) if counts else np.zeros(0, int))])
    return pa.ListArray.from_arrays(pa.array(total.astype(np.int32)), values)


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seeds = mix(np.arange(1, runs_needed() + 1, dtype=np.uint64))
    flat = lambda parts: pa.array((np.concatenate(parts) if parts else np.zeros(0, np.uint64)).view(np.int64))
    for whole in batches:
        for at in range(0, whole.num_rows, 2000):
            b = whole.slice(at, 2000)
            cls, n, sketches, counts, paths = [], [], [], [[], [], []], [[], [], []]
            for s in _row_sets(b.column(3)):
                n.append(len(s))
                cls.append(class_of(s) if len(s) else None)
                sketches.append(sketch(s) if len(s) else None)
                levels = _tree(s, seeds) if len(s) else [(np.zeros(0, np.int64), np.zeros(0, np.uint64))] * DEPTH
                counts[0].append(np.array([len(levels[0][1])]))
                for k in (1, 2):
                    counts[k].append(np.bincount(levels[k][0], minlength=len(levels[k - 1][1])))
                for k in range(DEPTH):
                    paths[k].append(levels[k][1])
            p2s = pa.StructArray.from_arrays([flat(paths[1]), _list(counts[2], flat(paths[2]))], ["p2", "p3s"])
            p1s = pa.StructArray.from_arrays([flat(paths[0]), _list(counts[1], p2s)], ["p1", "p2s"])
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(cls, pa.binary()), pa.array(n, pa.int32()), pa.array(sketches, pa.binary()), _list(counts[0], p1s)], ["doc_id", "digest", "row", "cls", "n", "sketch", "paths"])


def _leaves(reps: DataFrame) -> DataFrame:
    """(cls, bucket, members) of each set's buckets that are compared: none of a single set."""

    def sized(rows: DataFrame) -> DataFrame:
        counts = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
        return rows.join(counts, "bucket")

    one = written(sized(reps.select("cls", F.explode("paths.p1").alias("bucket"))), "level1")
    large = one.where(F.col("members") > SMALL).groupBy("cls").agg(F.collect_set("bucket").alias("above"))  # a few for each run
    two = reps.select("cls", "paths").join(large, "cls")
    two = two.select("cls", F.explode(F.flatten(F.transform(F.filter("paths", lambda p: F.array_contains("above", p["p1"])), lambda p: p["p2s"]))).alias("node"))
    two = two.select("cls", F.col("node.p2").alias("bucket"), F.col("node.p3s").alias("p3s"))
    two = written(sized(two), "level2")
    three = sized(two.where(F.col("members") > SMALL).select("cls", F.explode("p3s").alias("bucket")))
    small = F.col("members") <= SMALL
    return one.where(small).select("cls", "bucket", "members").unionByName(two.where(small).select("cls", "bucket", "members")).unionByName(three.select("cls", "bucket", "members"))


GROUP = ["bucket", "low", "high"]


def _grouped(leaves: DataFrame, reps: DataFrame) -> DataFrame:
    """A row for each set and group it is compared in: large buckets have a group for each pair of their blocks."""
    own = leaves.groupBy("cls").agg(F.sort_array(F.collect_list(F.struct("bucket", "members"))).alias("own"))  # a few for each run
    rows = own.join(reps.select("cls", "n", "sketch"), "cls")
    rows = rows.select("cls", "n", "sketch", F.col("own.bucket").alias("own"), F.explode("own").alias("leaf"))
    blocks = F.ceil(F.col("leaf.members") / SMALL).cast("int")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("cls"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return rows.select(F.col("leaf.bucket").alias("bucket"), F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "cls", "n", "sketch", "own")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole groups, from rows sorted by group: a few thousand rows or one group."""
    rest: list[pa.RecordBatch] = []

    def key(b: pa.RecordBatch, i: int) -> tuple:
        return tuple(b.column(b.schema.get_field_index(k))[i].as_py() for k in GROUP)

    for b in batches:
        for a in range(0, b.num_rows, 4000):
            part = b.slice(a, 4000)
            if rest and key(part, 0) == key(part, part.num_rows - 1) == key(rest[-1], rest[-1].num_rows - 1):
                rest.append(part)
                continue
            keys = [part.column(part.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in GROUP]
            same = (keys[0] == keys[0][-1]) & (keys[1] == keys[1][-1]) & (keys[2] == keys[2][-1])
            start = part.num_rows - int(same[::-1].cumprod().sum())
            if start:
                rest.append(part.slice(0, start))
                yield pa.Table.from_batches(rest)
                rest = [part.slice(start)]
            elif rest:
                yield pa.Table.from_batches(rest)
                rest = [part]
            else:
                rest = [part]
    if rest:
        yield pa.Table.from_batches(rest)


def _gram(row: np.ndarray, item: np.ndarray, m: int, work: float = math.inf) -> np.ndarray | None:
    """How many items each two of m rows share: a 0/1 matrix times itself, in slices of items. None beyond so much work."""
    _, column, copies = np.unique(item, return_inverse=True, return_counts=True)
    shared = copies > 1  # others are in no two rows
    n, keep = int(shared.sum()), shared[column]
    if float(m) * m * n > work:
        return None
    row, column = row[keep], (np.cumsum(shared) - 1)[column[keep]]
    order = np.argsort(column, kind="stable")
    row, column, total = row[order], column[order], np.zeros((m, m), np.float32)
    for a in range(0, n, 2048):
        x, y = np.searchsorted(column, [a, a + 2048])
        part = np.zeros((m, min(2048, n - a)), np.float32)
        part[row[x:y], column[x:y] - a] = 1
        total += part @ part.T
    return total


def _alike(sk: np.ndarray, n: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether the sizes and sketches of each pair allow the similarity."""
    out = np.minimum(n[i], n[j]) >= SIMILARITY * np.maximum(n[i], n[j])
    for k in range(0, len(i), 50_000):
        at = np.flatnonzero(out[k : k + 50_000]) + k
        a, b = sk[i[at]], sk[j[at]]
        used = ((a | b) != 0).sum(axis=1)
        same = ((a == b) & (a != 0)).sum(axis=1)
        out[at] = same >= used * SIMILARITY - MARGIN * np.sqrt(used * SIMILARITY * (1 - SIMILARITY))
    return out


def _candidates(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of pairs of a group that may be similar enough and belong to its bucket: no lesser bucket holds both."""
    t = t.combine_chunks()
    bucket, low, high, block, n = (t.column(c).to_numpy() for c in ("bucket", "low", "high", "block", "n"))
    sk = np.frombuffer(b"".join(t.column("sketch").to_pylist()), np.uint8).reshape(-1, BINS)
    lists = t.column("own").combine_chunks()
    own = lists.flatten().to_numpy()
    of = np.concatenate([[0], np.cumsum(np.diff(lists.offsets.to_numpy()))])
    fresh = np.flatnonzero(np.append(True, (bucket[1:] != bucket[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])))
    sizes = np.diff(np.append(fresh, len(bucket)))
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for a, m in zip(fresh[sizes > FEW].tolist(), sizes[sizes > FEW].tolist(), strict=True):
        # a product tells which pairs meet in a lesser bucket already; only the others are looked at
        row = np.repeat(np.arange(m), np.diff(of[a : a + m + 1]))
        item = own[of[a] : of[a + m]]
        lesser = item < bucket[a]
        i, j = np.nonzero(np.triu(_gram(row[lesser], item[lesser], m) == 0, 1))
        i, j = i + a, j + a
        mine = (low[a] == high[a]) | (block[i] != block[j])
        i, j = i[mine], j[mine]
        ok = _alike(sk, n, i, j)
        found.append((i[ok], j[ok]))
    at, d = np.flatnonzero(np.repeat(sizes <= FEW, sizes)), 1
    group = np.repeat(np.arange(len(fresh)), sizes)
    while len(at):
        at = at[at + d < len(bucket)]
        at = at[group[at] == group[at + d]]
        i = at[(low[at] == high[at]) | (block[at] != block[at + d])]
        j = i + d
        ok = _alike(sk, n, i, j)
        i, j = i[ok], j[ok]
        for x, y in zip(i.tolist(), j.tolist(), strict=True):
            if np.intersect1d(own[of[x] : of[x + 1]], own[of[y] : of[y + 1]], assume_unique=True)[0] == bucket[x]:
                found.append((np.array([x]), np.array([y])))
        d += 1
    i = np.concatenate([x for x, _ in found]) if found else np.zeros(0, int)
    j = np.concatenate([y for _, y in found]) if found else np.zeros(0, int)
    cls = t.column("cls").to_pylist()
    differ = np.array([cls[a] != cls[b] for a, b in zip(i, j, strict=True)], bool)  # a repeated row may bring a set twice
    return i[differ], j[differ]


def _with_candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for t in _groups(batches):
        if t.num_rows > 1:
            i, j = _candidates(t)
            yield from t.take(pa.array(np.unique(np.concatenate([i, j])))).combine_chunks().to_batches()


def common(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many shingles the sets of each pair share. sets: sorted, without repeats.

    A few pairs are intersected one by one. Many pairs of few sets, as in a group of near copies, are one product; whichever is
    estimated to be less work."""
    used, at = np.unique(np.concatenate([i, j]), return_inverse=True)
    size = np.array([len(sets[k]) for k in used])
    one_by_one = len(i) * 1.2e-5 + 8e-9 * float(size[at].sum())  # seconds
    if one_by_one > 0.02 and size.max() < 1 << 24:  # counts are exact in single precision below that
        total = _gram(np.repeat(np.arange(len(used)), size), np.concatenate([sets[k] for k in used]), len(used), one_by_one * 1e10)
        if total is not None:
            return total[at[: len(i)], at[len(i) :]].astype(np.int64)
    return np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(i, j, strict=True)], np.int64)


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cls, links, root): each set's links in a group, and the least class of what they connect."""
    for t in _groups(batches):
        if t.num_rows < 2:
            continue
        names = t.select(["bucket", "low", "high", "cls"]).to_pylist()
        fresh = [k for k in range(len(names)) if not k or names[k] != names[k - 1]]
        t = t.take(pa.array(fresh))
        sets = [np.frombuffer(x, np.uint64) for x in t.column("set").to_pylist()]
        cls = t.column("cls").to_pylist()
        i, j = _candidates(t)
        if not len(i):
            continue
        size, both = np.array([len(x) for x in sets]), common(sets, i, j)
        near = both >= SIMILARITY * (size[i] + size[j] - both) - 1e-9
        i, j = i[near], j[near]
        links = np.bincount(np.concatenate([i, j]), minlength=t.num_rows)
        # the least class that each set is connected to: labels sink along links until none changes
        rank = np.empty(t.num_rows, np.int64)
        rank[sorted(range(t.num_rows), key=lambda k: cls[k])] = np.arange(t.num_rows)
        by_rank = np.argsort(rank)
        label, before = rank.copy(), None
        while before is None or (label != before).any():
            before = label.copy()
            least = np.minimum(label[i], label[j])
            np.minimum.at(label, i, least)
            np.minimum.at(label, j, least)
            label = np.minimum(label, label[by_rank[label]])
        root = by_rank[label]
        rows = np.flatnonzero(links)
        yield pa.RecordBatch.from_arrays([pa.array([cls[k] for k in rows], pa.binary()), pa.array(links[rows]), pa.array([cls[root[k]] for k in rows], pa.binary())], ["cls", "links", "root"])


def _sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cls, set) of texts whose set is that of the class asked for."""
    for whole in batches:
        for at in range(0, whole.num_rows, 500):
            b = whole.slice(at, 500)
            rows = [(c, s.tobytes()) for c, s in zip(b.column(0).to_pylist(), _row_sets(b.column(1)), strict=True) if len(s) and class_of(s) == c]
            yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in rows], pa.binary()), pa.array([s for _, s in rows], pa.binary())], ["cls", "set"])


def components(edges: DataFrame) -> DataFrame:
    """(node, root): each node's least connected node, for nodes that aren't it. edges: a, b. Alternates large and small
    stars until all edges are stars: no node has two lesser neighbours, and none that others lead to leads on."""
    least = lambda rows: rows.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    now = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    while True:
        ends = now.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down"))
        ends = ends.union(now.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        if ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or (up = 1 and down = 1)").isEmpty():
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(least(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        small = large.join(least(large), "u")
        small = small.select("u", F.col("m").alias("v")).union(small.select(F.col("v").alias("u"), F.col("m").alias("v")))
        now = written(small.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")


def _fetched(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(cls, set) of each class asked for, once. texts: doc_id, digest, text. wanted: cls, first, digest. Texts without an
    identifier are met by their digest, never all with all, and one that many rows repeat is dealt out over SPREAD parts."""
    none = F.col("doc_id").isNull()
    rows = texts.withColumn("part", F.when(none, F.pmod(F.monotonically_increasing_id(), F.lit(SPREAD))).otherwise(F.lit(0)).cast("int"))
    asked = wanted.withColumn("part", F.explode(F.when(F.col("first").isNull(), F.sequence(F.lit(0), F.lit(SPREAD - 1))).otherwise(F.array(F.lit(0)))))
    asked = asked.withColumnRenamed("digest", "own").withColumnRenamed("part", "own_part")
    same = F.col("doc_id").eqNullSafe(F.col("first")) & (F.col("digest") == F.col("own")) & (F.col("part") == F.col("own_part"))
    found = rows.join(asked, same).select("cls", "text").mapInArrow(_sets_of, "cls binary, set binary")
    return found.groupBy("cls").agg(F.first("set").alias("set"))  # repeated rows bring a set several times


def _near(docs: DataFrame) -> DataFrame:
    """``near_duplicates`` with, for each row, the digest of its text and whether it is the one that stands for its class
    where no document of that has an identifier (rep)."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).select("doc_id", F.xxhash64("text").alias("digest"), "text")
    sets = written(texts.select("doc_id", "digest", F.monotonically_increasing_id().alias("row"), "text").mapInArrow(_sketched, SETS), "sets")
    one = Window.partitionBy("cls").orderBy(F.col("doc_id").asc_nulls_last(), "digest")
    reps = sets.where("cls is not null").withColumn("nth", F.row_number().over(one)).where("nth = 1")
    reps = written(reps.select("cls", F.col("doc_id").alias("first"), "digest", "n", "sketch", "paths"), "classes")
    n = tasks(docs.sparkSession)
    deal = lambda rows: rows.repartition(n, *GROUP).sortWithinPartitions(*GROUP, "cls")
    rows = _grouped(_leaves(reps), reps)
    kept = written(deal(rows).mapInArrow(_with_candidates, rows.schema), "candidates")
    wanted = kept.select("cls").distinct().join(reps.select("cls", "first", "digest"), "cls")
    whole = _fetched(texts, wanted)
    found = written(deal(kept.join(whole, "cls")).mapInArrow(_linked, "cls binary, links long, root binary"), "links")
    root = components(found.select(F.col("cls").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("cls").agg(F.sum("links").alias("n_links")).join(reps.select("cls", "first"), "cls").join(root, F.col("cls") == F.col("node"), "left")
    links = written(links.select("cls", "first", "n_links", F.coalesce("root", "cls").alias("root")), "linked")
    least = links.groupBy("root").agg(F.min("first").alias("least"))  # null only where all are
    links = spread_join(links.drop("first"), least, ["root"], F.col("cls"))
    by_class = reps.select("cls", "first", F.col("digest").alias("own")).join(links, "cls", "left")
    by_class = by_class.select("cls", "first", "own", F.when(F.col("root").isNull(), F.col("first")).otherwise(F.col("least")).alias("least"), F.coalesce(F.col("root") == F.col("cls"), F.lit(True)).alias("is_root"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    out = spread_join(sets.select("doc_id", "digest", "row", "cls", "n"), by_class, ["cls"], F.col("row"))
    none = F.col("cls").isNull()
    rep = F.col("doc_id").isNull() & (none | (F.col("least").isNull() & F.col("is_root") & (F.col("digest") == F.col("own"))))
    return out.select("doc_id", F.when(none, F.col("doc_id")).otherwise(F.col("least")).alias("class_id"), F.when(none, F.col("doc_id")).otherwise(F.col("first")).alias("set_id"), F.col("n").cast("long").alias("n_shingles"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "digest", rep.alias("rep"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are ignored): doc_id, class_id, set_id, n_shingles, n_links.

    Two texts are linked if their sets of SHINGLE-word shingles have a Jaccard similarity of SIMILARITY or more. A text
    of fewer words has one shingle of all its words; one without words (or null) has no links and a class of its own.
    n_links counts other sets that the text's set is linked to, set_id is the least doc_id with the same set, class_id
    the least doc_id of all that links and equal sets connect; each is null only where none of them has a doc_id.
    doc_id names a document: repeated rows are copies. Rows without one are told apart by their texts.
    """
    return _near(docs).drop("digest", "rep")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the least of its class, once each, with their columns; of a class without any
    doc_id, one text."""
    text_of = F.when(F.col("doc_id").isNull(), F.col("digest"))
    kept = _near(docs).where("doc_id = class_id or rep").select(F.col("doc_id").alias("_kept"), text_of.alias("_kept_text")).distinct()
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("_id"), F.xxhash64(F.col("text").cast("string")).alias("_text"))
    once = Window.partitionBy("_id", "_text").orderBy("_text")
    rows = rows.withColumn("nth", F.row_number().over(once)).where("nth = 1")
    same = F.col("_id").eqNullSafe(F.col("_kept")) & F.when(F.col("_id").isNull(), F.col("_text")).eqNullSafe(F.col("_kept_text"))
    return rows.join(kept, same, "left_semi").select("row.*")


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op2_ngram_jaccard_join": op2_ngram_jaccard_join}
ORACLE_SQL: dict[str, str] = {}
