"""Operator 13, conversation structure repair by a run-length DP.

Each turn becomes a symbol, its role's initial and its fault. Edits lead through four states: nothing yet, after a system
turn, after a user turn, after an assistant turn. A symbol is a min-plus matrix of the states; equal neighbouring symbols
are one run, which moves the costs back by cached binary powers of its matrix. The audit is then unrolled from the front: in each
state the least letter that still reaches the least cost.

Rows are dealt out in ranges of (conversation, turn), and a conversation within a range is repaired as the rows go by. What a range
begins and ends with, and conversations longer than a piece, come out as pieces of at most PIECE_ROWS rows and about
PIECE_CHARS characters, whose matrices are put together for each conversation. So a conversation with a third of all rows is many
tasks' work; only its pieces' few numbers, and at last its text for the digest, pass through one task, as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache, partial
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loyalflow.llm.shared import written

PIECE_ROWS, PIECE_CHARS = 4096, 1 << 20
RUN_BLOCK = 1024
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
INF = 1 << 50
SPACE = " \t\n\x0b\x0c\r"
#: States: 0 nothing yet, 1 after a system turn, 2 after a user turn, 3 after an assistant turn. The next turn's state:
NEXT = (2, 2, 3, 2)
ROLE = {2: "user", 3: "assistant"}
END = (0, INF, INF, 0)
LEGAL = {"su", "ua", "au"}
STATS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
Matrix = tuple[tuple[int, ...], ...]
Vector = tuple[int, ...]


# ---- symbols, matrices, choices

def fault(text: str, seen: bool) -> str:
    """The first fault of a turn: b(lank), d(uplicate), t(runcated) or none."""
    rest = text.rstrip(SPACE)
    return "b" if not rest else "d" if seen else "t" if rest[-1] not in ".!?" else ""


def symbol(role: str, text: str, seen: bool) -> str:
    """s, u, a, or o for another initial; as a capital where the turn is truncated; x where it must go."""
    found = fault(text, seen)
    initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
    return "x" if found in ("b", "d") else initial.upper() if found else initial


def kept(sign: str, state: int) -> int | None:
    """The state after keeping a turn, None where that isn't allowed."""
    initial = sign.lower()
    if initial == "s":
        return 1 if state == 0 else None
    return NEXT[state] if initial in ("u", "a") and ROLE[NEXT[state]][0] == initial else None


def product(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(INF, *(x + y for x, y in zip(row, column, strict=True))) for column in zip(*b, strict=True)) for row in a)


def applied(a: Matrix, v: Vector) -> Vector:
    return tuple(min(INF, *(x + y for x, y in zip(row, v, strict=True))) for row in a)


UNIT: Matrix = tuple(tuple(0 if s == t else INF for t in range(4)) for s in range(4))
_ONE = tuple(tuple(0 if s == t else INSERT if NEXT[s] == t else INF for t in range(4)) for s in range(4))
INSERTS = product(_ONE, _ONE)


@lru_cache(maxsize=None)
def power(sign: str, k: int) -> Matrix:
    """The matrix of 2 ** k turns of a symbol, with what is inserted before each of them."""
    if k:
        half = power(sign, k - 1)
        return product(half, half)
    turn = [[INF] * 4 for _ in range(4)]
    extra = TRUNCATED if sign.isupper() else 0
    for s in range(4):
        turn[s][s] = DELETE
        if sign != "x":
            turn[s][NEXT[s]] = min(turn[s][NEXT[s]], REROLE + extra)
            to = kept(sign, s)
            if to is not None:
                turn[s][to] = min(turn[s][to], KEEP + extra)
    return product(INSERTS, tuple(map(tuple, turn)))


def over_run(sign: str, n: int, v: Vector) -> Vector:
    """Costs before a run of n equal symbols, from those after it."""
    k = 0
    while n:
        if n & 1:
            v = applied(power(sign, k), v)
        n, k = n >> 1, k + 1
    return v


def run_matrix(sign: str, n: int) -> Matrix:
    columns = [over_run(sign, n, tuple(0 if s == t else INF for s in range(4))) for t in range(4)]
    return tuple(zip(*columns, strict=True))


def runs_of(signs: str) -> list[tuple[str, int]]:
    return [(c, sum(1 for _ in same)) for c, same in groupby(signs)]


def matrix(signs: str) -> Matrix:
    out = UNIT
    for c, n in runs_of(signs):
        out = product(out, run_matrix(c, n))
    return out


def _choice(sign: str, state: int, now: Vector, then: Vector) -> tuple[str, int]:
    """The least letter that reaches the cost of this state, and the state after it. now, then: costs before and after the turn."""
    cost, extra = now[state], TRUNCATED if sign.isupper() else 0
    if cost == DELETE + then[state]:
        return "D", state
    if cost == INSERT + now[NEXT[state]]:
        return "I", NEXT[state]
    to = kept(sign, state) if sign != "x" else None
    if to is not None and cost == KEEP + extra + then[to]:
        return "K", to
    return "R", NEXT[state]


@lru_cache(maxsize=4096)
def solved(signs: str, after: Vector, state: int = 0, last: bool = True) -> tuple[int, str, int]:
    """(cost, audit, state at the end) of the least edits of a piece. after: costs of the states at its end; last: whether
    the conversation ends here."""
    v = applied(INSERTS, after) if last else after
    runs, ends = runs_of(signs), []
    for c, n in reversed(runs):
        ends.append(v)
        v = over_run(c, n, v)
    cost, audit = v[state], []
    for (c, n), end in zip(runs, reversed(ends), strict=True):
        for a in range(0, n, RUN_BLOCK):
            size = min(RUN_BLOCK, n - a)
            costs = [over_run(c, n - a - size, end)]
            for _ in range(size):
                costs.append(applied(power(c, 0), costs[-1]))
            for k in range(size, 0, -1):
                letter = ""
                while letter in ("", "I"):
                    letter, state = _choice(c, state, costs[k], costs[k - 1])
                    audit.append(letter)
    if last and state in (1, 2):
        audit.append("II" if state == 1 else "I")
        state = 3
    return cost, "".join(audit), state


def lines(roles: list[str], texts: list[str], audit: str, state: int = 0) -> str:
    """The repaired turns as ``role:text`` lines."""
    out, at = [], 0
    for letter in audit:
        if letter == "I":
            state = NEXT[state]
            out.append(f"{ROLE[state]}:")
            continue
        if letter != "D":
            state = NEXT[state] if letter == "R" or roles[at][:1] != "s" else 1
            out.append(f"{roles[at] if letter == 'K' else ROLE[state]}:{texts[at]}")
        at += 1
    return "\n".join(out)


def _illegal(roles: list[str]) -> int:
    return sum(a[:1] + b[:1] not in LEGAL for a, b in zip(roles, roles[1:], strict=False))


def repaired_here(turns: list[int | None], roles: list[str], texts: list[str]) -> dict:
    """A whole conversation's counts, audit and repaired lines."""
    seen: set[tuple[str, str]] = set()
    signs, faults = [], {"b": 0, "d": 0, "t": 0, "": 0}
    for row in zip(roles, texts, strict=True):
        faults[fault(row[1], row in seen)] += 1
        signs.append(symbol(*row, row in seen))
        seen.add(row)
    cost, audit, _ = solved("".join(signs), END)
    known = [t for t in turns if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    counts = {"gaps": gaps, "blank": faults["b"], "duplicate": faults["d"], "truncated": faults["t"], "illegal": _illegal(roles), "cost": cost}
    return counts | {"audit": audit, "repaired": lines(roles, texts, audit)}


# ---- on Spark

_STATS = ", ".join(f"{c} long" for c in STATS)
_OUT = f"conv_id long, shard int, piece int, whole boolean, {_STATS}, audit string, repaired string"
_PASS = f"{_OUT}, turns array<long>, roles array<string>, texts array<string>"
_ARROW = pa.schema([("conv_id", pa.int64()), ("shard", pa.int32()), ("piece", pa.int32()), ("whole", pa.bool_()), *((c, pa.int64()) for c in STATS),
                    ("audit", pa.string()), ("repaired", pa.string()), ("turns", pa.list_(pa.int64())), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))])
_NUMBERS = "conv_id long, shard int, piece int, signs string, costs array<long>, blank long, duplicate long, truncated long, illegal long, first string, last string"
_NUMBERS_ARROW = pa.schema([("conv_id", pa.int64()), ("shard", pa.int32()), ("piece", pa.int32()), ("signs", pa.string()), ("costs", pa.list_(pa.int64())),
                            *((c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal")), ("first", pa.string()), ("last", pa.string())])


def _batches(rows: Iterator[dict], schema: pa.Schema, weight: str | None = None) -> Iterator[pa.RecordBatch]:
    """Rows as batches of a bounded number of rows and characters."""
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += 200 + (sum(map(len, r.get(weight) or ())) if weight else 0) + len(r.get("repaired") or "")
        if size > 4 * PIECE_CHARS:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for b in batches:
        for a in range(0, b.num_rows, 1000):
            yield from b.slice(a, 1000).to_pylist()


def _first_pass(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Whole conversations repaired; pieces of the others as they are. Rows come sorted by conversation and turn."""
    shard = TaskContext.get().partitionId()

    def out() -> Iterator[dict]:
        piece, first = 0, True
        for conv, rows in groupby(_rows(batches), key=lambda r: r["conv_id"]):
            turns, roles, texts, size, more = [], [], [], 0, False
            for r in rows:
                if r["lost"]:
                    continue
                if len(turns) == most or size > PIECE_CHARS:
                    yield {"conv_id": conv, "shard": shard, "piece": piece, "whole": False, "turns": turns, "roles": roles, "texts": texts}
                    turns, roles, texts, size, more, piece = [], [], [], 0, True, piece + 1
                turns.append(r["turn"])
                roles.append(r["role"])
                texts.append(r["text"])
                size += len(r["text"])
            yield {"conv_id": conv, "shard": shard, "piece": piece, "whole": not (more or first), "turns": turns, "roles": roles, "texts": texts}
            piece, first = piece + 1, False

    def solved_rows() -> Iterator[dict]:
        before = None
        for row in out():  # the last one may go on in the next range
            if before:
                yield before | repaired_here(before["turns"], before["roles"], before["texts"]) | {"turns": None, "roles": None, "texts": None} if before["whole"] else before
            before = row
        if before:
            yield before | {"whole": False}

    yield from _batches(solved_rows(), _ARROW, "texts")


def _second_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Symbols and matrix of each piece. news: its turns that no earlier one equals."""

    def out() -> Iterator[dict]:
        for r in _rows(batches):
            news = set(r["news"] or ())
            pairs = [(role, text, i not in news) for i, (role, text) in enumerate(zip(r["roles"], r["texts"], strict=True))]
            found = [fault(text, seen) for _, text, seen in pairs]
            signs = "".join(symbol(*p) for p in pairs)
            yield {
                "conv_id": r["conv_id"], "shard": r["shard"], "piece": r["piece"], "signs": signs, "costs": [x for row in matrix(signs) for x in row],
                "blank": found.count("b"), "duplicate": found.count("d"), "truncated": found.count("t"), "illegal": _illegal(r["roles"]),
                "first": r["roles"][0][:1] if signs else None, "last": r["roles"][-1][:1] if signs else None,
            }

    yield from _batches(out(), _NUMBERS_ARROW)


def _backwards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The states' costs after and before each piece. Pieces come sorted by conversation, the last one first."""

    def out() -> Iterator[dict]:
        for _, rows in groupby(_rows(batches), key=lambda r: r["conv_id"]):
            v = applied(INSERTS, END)
            for k, r in enumerate(rows):
                before = applied(tuple(tuple(r["costs"][4 * s : 4 * s + 4]) for s in range(4)), v)
                yield {"shard": r["shard"], "piece": r["piece"], "final": k == 0, "after": list(v), "before": list(before)}
                v = before

    numbers = pa.list_(pa.int64())
    yield from _batches(out(), pa.schema([("shard", pa.int32()), ("piece", pa.int32()), ("final", pa.bool_()), ("after", numbers), ("before", numbers)]))


def _each_start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Where the least edits of a piece lead from each state."""

    def out() -> Iterator[dict]:
        for r in _rows(batches):
            ends = [solved(r["signs"], END if r["final"] else tuple(r["after"]), s, r["final"])[2] if r["before"][s] < INF else -1 for s in range(4)]
            yield {k: r[k] for k in ("conv_id", "shard", "piece", "final", "after", "before")} | {"ends": ends}

    numbers = pa.list_(pa.int64())
    yield from _batches(out(), pa.schema([("conv_id", pa.int64()), ("shard", pa.int32()), ("piece", pa.int32()), ("final", pa.bool_()), ("after", numbers), ("before", numbers), ("ends", numbers)]))


def _forwards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state in which each piece begins, and its conversation's cost. Pieces come sorted."""

    def out() -> Iterator[dict]:
        for _, rows in groupby(_rows(batches), key=lambda r: r["conv_id"]):
            state, cost = 0, None
            for r in rows:
                cost = r["before"][0] if cost is None else cost
                yield {"shard": r["shard"], "piece": r["piece"], "final": r["final"], "after": r["after"], "start": state, "cost": cost}
                state = r["ends"][state]

    yield from _batches(out(), pa.schema([("shard", pa.int32()), ("piece", pa.int32()), ("final", pa.bool_()), ("after", pa.list_(pa.int64())), ("start", pa.int32()), ("cost", pa.int64())]))


def _last_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out() -> Iterator[dict]:
        for r in _rows(batches):
            _, audit, _ = solved(r["signs"], END if r["final"] else tuple(r["after"]), r["start"], r["final"])
            own = {k: r[k] for k in ("conv_id", "shard", "piece", *STATS)}
            yield own | {"whole": False, "audit": audit, "repaired": lines(r["roles"], r["texts"], audit, r["start"])}

    yield from _batches(out(), pa.schema(list(_ARROW)[:12]))


def _together(pieces: DataFrame) -> DataFrame:
    """The repaired pieces of conversations that are in more than one, or may be."""
    at = ["shard", "piece"]
    turns = pieces.select("conv_id", *at, F.posexplode(F.arrays_zip("turns", "roles", "texts")).alias("i", "t"))
    turns = turns.select("conv_id", *at, "i", F.col("t.turns").alias("turn"), F.col("t.roles").alias("role"), F.sha2(F.col("t.texts"), 256).alias("text"))
    first = turns.groupBy("conv_id", "role", "text").agg(F.min(F.struct(*at, "i")).alias("f"))
    news = first.groupBy(F.col("f.shard").alias("shard"), F.col("f.piece").alias("piece")).agg(F.collect_list("f.i").alias("news"))  # at most a piece's
    numbers = written(pieces.join(news, at, "left").select("conv_id", *at, "roles", "texts", "news").mapInArrow(_second_pass, _NUMBERS), "pieces")
    deal = lambda rows, *by: rows.repartition("conv_id").sortWithinPartitions("conv_id", *by)
    back = deal(numbers.select("conv_id", *at, "costs"), F.desc("shard"), F.desc("piece")).mapInArrow(_backwards, "shard int, piece int, final boolean, after array<long>, before array<long>")
    ends = numbers.select("conv_id", *at, "signs").join(back, at).mapInArrow(_each_start, "conv_id long, shard int, piece int, final boolean, after array<long>, before array<long>, ends array<long>")
    starts = deal(ends, *at).mapInArrow(_forwards, "shard int, piece int, final boolean, after array<long>, start int, cost long")
    # counts of whole conversations: a pair of roles may stand in two pieces, the one before being the nearest that has turns
    full = numbers.where("first is not null").withColumn("prior", F.lag("last").over(Window.partitionBy("conv_id").orderBy(*at)))
    illegal = F.col("illegal") + (F.col("prior").isNotNull() & ~F.concat("prior", "first").isin(*LEGAL)).cast("long")
    counts = full.groupBy("conv_id").agg(*(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")), F.sum(illegal).alias("illegal"))
    gaps = turns.groupBy("conv_id").agg((F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"))
    stats = counts.alias("c").join(gaps.alias("g"), F.col("c.conv_id").eqNullSafe(F.col("g.conv_id")), "left").select("c.*", "gaps")
    known = numbers.select("conv_id", *at, "signs").join(starts, at)
    known = known.alias("k").join(stats.alias("s"), F.col("k.conv_id").eqNullSafe(F.col("s.conv_id")), "left")
    known = known.select("k.*", *(F.coalesce(f"s.{c}", F.lit(0).cast("long")).alias(c) for c in STATS[:-1]))
    return pieces.select(*at, "roles", "texts").join(known, at).mapInArrow(_last_pass, _OUT)


_COLUMNS = ["conv_id", "shard", "piece", "whole", *STATS, "audit", "repaired"]


def repaired(rows: DataFrame, piece_rows: int = PIECE_ROWS) -> tuple[DataFrame, DataFrame]:
    """``repair`` in two tables: of whole conversations, and of pieces."""
    rows = rows.withColumns({"sha": F.sha2("text", 256), "nth": F.monotonically_increasing_id()})
    key = ["conv_id", "turn", "role", "sha", "nth"]  # the last one parts equal rows
    dealt = rows.repartitionByRange(*key).sortWithinPartitions(*key).select("conv_id", "turn", "role", "text", "lost")
    passed = written(dealt.mapInArrow(partial(_first_pass, most=piece_rows), _PASS), "repair")
    return passed.where("whole").select(*_COLUMNS), _together(passed.where("not whole")).select(*_COLUMNS)


def repair(rows: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Repaired conversations: conv_id, shard, piece, whole, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired.

    ``rows``: conv_id long, turn long, role string, text string, lost boolean; a row with ``lost`` only says that there is such a
    conversation. Turns are in the order of turn (null first), then role, then the SHA-256 of the text; rows with a null conv_id
    are one conversation. A role whose first character isn't s, u or a (an empty one too) can't be kept. ``whole``: the row is
    all of its conversation; other conversations have a row for each piece, by shard and piece, with the counts of the whole in
    each, and the piece's own audit and lines (empty where it has none). No rows: no result.
    """
    whole, pieces = repaired(rows, piece_rows)
    return whole.unionByName(pieces)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each conversation, from its sorted pieces."""

    def out() -> Iterator[dict]:
        for _, rows in groupby(_rows(batches), key=lambda r: r["conv_id"]):
            digest, any_line, audit, row = hashlib.sha256(), False, [], {}
            for row in rows:
                if row["repaired"]:
                    digest.update((("\n" if any_line else "") + row["repaired"]).encode())
                    any_line = True
                audit.append(row["audit"])
            yield {k: row[k] for k in ("conv_id", *STATS)} | {"audit": "".join(audit), "repaired_sha256": digest.hexdigest()}

    yield from _batches(out(), pa.schema([("conv_id", pa.int64()), *((c, pa.int64()) for c in STATS), ("audit", pa.string()), ("repaired_sha256", pa.string())]))


def damaged(conversations: DataFrame) -> DataFrame:
    """``conversations`` (conv_id, turn, role, text; other columns are ignored) with faults by a hash of conversation and turn,
    as input of ``repair``. Nulls of role and text, and within the hashed ``conv_id:turn``, count as one blank."""
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")))
    name = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    rows = rows.withColumn("kind", F.crc32(name.cast("binary")) % 20)
    text = F.when(F.col("kind") <= 1, F.lit("")).when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    rows = rows.withColumns({"role": F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")), "text": text, "lost": F.col("kind") == 0})
    return rows.withColumn("copy", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("kind", "copy")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole, pieces = repaired(damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet")))
    columns = ["conv_id", *STATS, "audit"]
    rest = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "shard", "piece").select(*columns, "repaired")
    rest = rest.mapInArrow(_digest, f"conv_id long, {_STATS}, audit string, repaired_sha256 string")
    return whole.select(*columns, F.sha2("repaired", 256).alias("repaired_sha256")).unionByName(rest)


QUERIES = {"op13_conversation_repair": op13_conversation_repair}
ORACLE_SQL: dict[str, str] = {}
