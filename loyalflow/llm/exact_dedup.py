"""Operator 10, exact dedup: a tree merge of sorted digest runs.

Each input partition makes a run of (digest, identifier, count) records, sorted by digest and already merged. Runs sit in
``fan ** levels`` slots, one for each task. In round r every slot cuts its run by the r-th base-``fan`` digit of the digest, in blocks of
BLOCK records that stay sorted, and sends each part to the slot that differs from its own only in that digit. A receiver reads the blocks of all
its senders by their first digests and merges them as a stream: what lies before the first digest of the next block is complete, so it holds
about one block of each run. Runs are sorted once, at the start; later only the heads of blocks are.
After the last round a slot has all records of its digests. A digest that a third of all rows share is one record for each run from
the start, and at most one for each of ``fan`` senders in any later merge. Records only count as equal if SHA-256, length and a second digest agree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from loyalflow.llm.shared import spread_join, tasks, written

FAN = 8
#: Records of a block, about 130 KB.
BLOCK = 2048
KEYS = ["sha", "check", "n_bytes"]
#: key: the 32 and 8 bytes of both digests and the length, big end first, so that bytes compare as the columns do.
RECORD = np.dtype([("key", "S48"), ("known", "u1"), ("best", "<i8"), ("n", "<i8")])
WORST = np.iinfo(np.int64).max


def digest(text: str | None) -> tuple[bytes, bytes, int]:
    """SHA-256, a second digest and the length of the text (null: empty) with A-Z lower-cased."""
    data = (text or "").encode().lower()  # bytes.lower() only knows A-Z
    return hashlib.sha256(data).digest(), hashlib.blake2b(data, digest_size=8).digest(), len(data)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        made = [digest(x.as_py()) for x in b.column(b.schema.get_field_index("text"))]
        rest = [(n, b.column(i)) for i, n in enumerate(b.schema.names)]
        extra = [("sha", pa.array([x[0] for x in made], pa.binary())), ("check", pa.array([x[1] for x in made], pa.binary())), ("n_bytes", pa.array([x[2] for x in made], pa.int64()))]
        yield pa.RecordBatch.from_arrays([x for _, x in rest + extra], [n for n, _ in rest + extra])


def with_digests(docs: DataFrame) -> DataFrame:
    """``docs`` with sha, check and n_bytes; other columns of these names give way."""
    docs = docs.drop(*KEYS)
    added = [StructField("sha", BinaryType()), StructField("check", BinaryType()), StructField("n_bytes", LongType())]
    return docs.mapInArrow(_digests, StructType([*docs.schema.fields, *added]))


def _records(b: pa.RecordBatch) -> np.ndarray:
    """Columns sha, check, n_bytes, best, n as records."""
    out, best = np.zeros(b.num_rows, RECORD), b.column(3)
    key = np.zeros(b.num_rows, [("sha", "S32"), ("check", "S8"), ("n_bytes", ">i8")])
    key["sha"], key["check"], key["n_bytes"] = b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_numpy()
    out["key"] = key.view("S48")
    out["known"], out["best"], out["n"] = best.is_valid().to_numpy(zero_copy_only=False), best.fill_null(WORST).to_numpy(), b.column(4).to_numpy()
    return out


def _rows(run: np.ndarray) -> pa.RecordBatch:
    """Records as columns sha, check, n_bytes, best, n."""
    key = np.ascontiguousarray(run["key"]).view([("sha", "V32"), ("check", "V8"), ("n_bytes", ">i8")])
    fixed = [pa.array(key[name].tolist(), pa.binary()) for name in KEYS[:2]]
    best = pa.array(np.ascontiguousarray(run["best"]), mask=run["known"] == 0)
    return pa.RecordBatch.from_arrays([*fixed, pa.array(key["n_bytes"].astype(np.int64)), best, pa.array(np.ascontiguousarray(run["n"]))], [*KEYS, "best", "n"])


def _pack(run: np.ndarray) -> bytes:
    return b"".join(run[name].tobytes() for name in RECORD.names)


def _unpack(data: bytes) -> np.ndarray:
    out, at = np.zeros(len(data) // RECORD.itemsize, RECORD), 0
    for name in RECORD.names:
        out[name] = np.frombuffer(data, RECORD[name], len(out), at)
        at += len(out) * RECORD[name].itemsize
    return out


def merge_runs(runs: list[np.ndarray]) -> np.ndarray:
    """Sorted runs as one, with one record a key: the best identifier and the sum. The stable sort (timsort) finds the runs and merges them."""
    every = np.concatenate(runs)
    every = every[np.argsort(every["key"], kind="stable")]
    if not len(every):
        return every
    first = np.flatnonzero(np.append(True, every["key"][1:] != every["key"][:-1]))
    out = every[first]
    out["known"], out["best"], out["n"] = np.maximum.reduceat(every["known"], first), np.minimum.reduceat(every["best"], first), np.add.reduceat(every["n"], first)
    return out


def merge_blocks(blocks: Iterator[np.ndarray]) -> Iterator[np.ndarray]:
    """Sorted blocks, which come in the order of their first keys, as one sorted stream of merged pieces: no key is in two of them."""
    held, size, most = [], 0, 4 * BLOCK
    for block in blocks:
        if size >= most:
            ready = merge_runs(held)
            cut = int(np.searchsorted(ready["key"], block["key"][0]))
            if cut:
                yield ready[:cut]
            held, size = [ready[cut:]], len(ready) - cut
            most = max(4 * BLOCK, 2 * size)  # so that what many runs leave open isn't merged again for each block
        held.append(block)
        size += len(block)
    if held:
        yield merge_runs(held)


def _deal(run: Iterator[np.ndarray], slot: int, weight: int, fan: int, slots: int) -> Iterator[pa.RecordBatch]:
    """Cut a slot's run by a digit of the digest: blocks (slot, first, block) for ``fan`` slots."""
    left: dict[int, list[np.ndarray]] = {}

    def block(to: int, records: np.ndarray) -> pa.RecordBatch:
        slot_there = slot + (to - slot // weight % fan) * weight
        return pa.RecordBatch.from_arrays([pa.array([slot_there], pa.int32()), pa.array([records["key"][:1].tobytes()], pa.binary()), pa.array([_pack(records)], pa.binary())], ["slot", "first", "block"])

    for piece in run:
        lead = np.ascontiguousarray(piece["key"]).view([("lead", ">u4"), ("rest", "V44")])["lead"].astype(np.int64)
        digit = lead % slots // weight % fan
        for to in np.unique(digit).tolist():
            have = np.concatenate([*left.pop(to, []), piece[digit == to]])
            whole = len(have) // BLOCK * BLOCK
            for at in range(0, whole, BLOCK):
                yield block(to, have[at : at + BLOCK])
            if whole < len(have):
                left[to] = [have[whole:]]
    for to, rest in sorted(left.items()):
        yield block(to, rest[0])


def tree_merge(rows: DataFrame, slots: int, fan: int = FAN) -> DataFrame:
    """rows: sha (32 bytes), check (8), n_bytes, best (smaller is better, null worst), n. Returns one row for each digest.

    There are at least ``slots`` slots, with a fan of at most ``fan``: the smallest that has them in as many rounds."""
    levels = 1
    while fan**levels < slots:
        levels += 1
    while fan > 2 and (fan - 1) ** levels >= slots:
        fan -= 1
    slots = fan**levels
    blocks = "slot int, first binary, block binary"

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        run = merge_blocks(_records(b) for b in batches if b.num_rows)
        yield from _deal(run, TaskContext.get().partitionId() % slots, 1, fan, slots)

    def by_slot(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[np.ndarray]]]:
        each = ((slot.as_py(), data.as_py()) for b in batches for slot, data in zip(b.column(0), b.column(2), strict=True))
        for slot, group in groupby(each, key=lambda x: x[0]):
            yield slot, merge_blocks(_unpack(data) for _, data in group)

    def between(weight: int):  # noqa: ANN202
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for slot, merged in by_slot(batches):
                yield from _deal(merged, slot, weight, fan, slots)

        return run

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, merged in by_slot(batches):
            for piece in merged:
                yield from (_rows(piece[at : at + 8 * BLOCK]) for at in range(0, len(piece), 8 * BLOCK))

    runs = rows.select(*KEYS, "best", "n").sortWithinPartitions(*KEYS).mapInArrow(start, blocks)
    for r in range(1, levels + 1):
        runs = runs.repartitionById(slots, F.col("slot")).sortWithinPartitions("slot", "first")
        if r < levels:
            runs = runs.mapInArrow(between(fan**r), blocks)
    return runs.mapInArrow(finish, "sha binary, check binary, n_bytes long, best long, n long")


def _merged_groups(docs: DataFrame, keep: str) -> tuple[DataFrame, DataFrame]:
    """(doc_id and digests of each row; digests, keep_id and group_size of each different text)."""
    turned = F.bitwise_not if keep == "largest" else lambda c: F.col(c)  # orders the other way, without overflow
    rows = written(with_digests(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))).drop("text"), "digests")
    best = tree_merge(rows.select(*KEYS, turned("doc_id").alias("best"), F.lit(1).cast("long").alias("n")), tasks(docs.sparkSession))
    return rows, best.select(*KEYS, turned("best").alias("keep_id"), F.col("n").alias("group_size"))


def exact_duplicates(docs: DataFrame, keep: str = "largest") -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are ignored): doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if identical after lower-casing A-Z; null counts as empty. Of equal texts the row with the largest
    (or smallest) doc_id stays; of repeated rows one stays; a null doc_id stays only where its group has no other.
    An empty table gives an empty result.
    """
    rows, best = _merged_groups(docs, keep)
    copies = rows.groupBy("doc_id", *KEYS).agg(F.count(F.lit(1)).alias("copies"))
    out = spread_join(copies, best, KEYS, F.col("doc_id")).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    return out.select("doc_id", "keep_id", "group_size", kept.alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


def drop_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that exact_duplicates keeps, with their columns."""
    keys = [F.col("_row").isNull().alias("_none"), F.coalesce("_row", F.lit(0).cast("long")).alias("_id"), F.col("_sha")]
    names = ["_none", "_id", "_sha"]  # without nulls, so that the window and the join share one exchange of the texts
    kept = _merged_groups(docs, "largest")[1].select(F.col("keep_id").alias("_row"), F.col("sha").alias("_sha")).select(*keys)
    named = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("_row"), F.col("text").cast("string").alias("text"))
    named = with_digests(named).withColumnRenamed("sha", "_sha").select("row", *keys)
    named = named.withColumn("nth", F.row_number().over(Window.partitionBy(*names).orderBy("_sha"))).where("nth = 1")
    return named.join(kept, names, "left_semi").select("row.*")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op10_exact_dedup": op10_exact_dedup}
ORACLE_SQL = {
    "op10_exact_dedup": """
        WITH texts AS (
            SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
            FROM documents),
        sized AS (
            SELECT *, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
                   row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id DESC NULLS LAST) AS nth
            FROM texts)
        SELECT doc_id, keep_id, group_size, nth = 1 AS kept, text_sha256 FROM sized
    """,
}
