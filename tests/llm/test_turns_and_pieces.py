"""Conversation prefix trie, SentencePiece, and conversation repair."""

import hashlib
import random
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loyalflow.llm import conversation_repair, prefix_trie, sentence_pieces
from loyalflow.llm.queries import QUERIES

TURNS = "conv_id long, turn long, role string, text string"


@pytest.fixture()
def talks(spark):
    """Conversations with nulls, ties, repeated rows, equal beginnings, long texts, and columns whose names clash."""
    rng = random.Random(3)
    rows = [(None, 0, "user", "no conversation."), (100, None, None, None), (100, None, "user", "x"), (100, 1, "user", "x"), (-7, 0, "user", "below zero"), (5, 0, "", "long " * 20_000)]
    for c in [*range(0, 30), *range(200, 420, 3)]:
        for t in range(rng.randint(1, 6)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None])
            rows += [(c, t if rng.random() < 0.9 else None, role, rng.choice(["Yes.", "no", "", "  \n", "Why?", "a ", None, "é!"]))] * rng.choice([1, 1, 1, 2])
    rows += [(c, t, "user", "same.") for c in range(1000, 1060) for t in range(3)]
    rows += [(3000, t, "user" if t % 2 == 0 else "assistant", f"turn {t % 50}" + "." * (t % 3)) for t in range(400)]
    schema = f"{TURNS}, shard int, piece string, key string, id string, kind string, n_convs int, sha string, nth int, lost string, tokens string"
    return spark.createDataFrame([(*r, 1, "p", "k", "i", "kind", 1, "s", 1, "l", "t") for r in rows], schema)


@pytest.fixture()
def no_talks(spark):
    return spark.createDataFrame([], TURNS)


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---- prefix trie

def brute_nodes(rows):
    own = {}
    for c, t, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((t is not None, t or 0, (role or "").encode(), digest(text or ""), text or ""))
    for c in own:
        own[c] = [(x[2], x[4]) for x in sorted(own[c])]
    full = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100 if c >= 0 else -(abs(c) % 100))
        full[c] = own.get(base, [])[:h] + turns[h:]
    nodes = {}
    for c, turns in full.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    out = {}
    for node, members in nodes.items():
        below = [n for n in nodes if n[: len(node)] == node]
        leaves = [n for n in below if not any(len(k) == len(n) + 1 and k[: len(n)] == n for k in nodes)]
        ends = ",".join(map(str, sorted(c for c in members if len(full[c]) == len(node))))
        saved = sum((len(nodes[n]) - 1) * len(n[-1][1]) for n in below if n)
        parent = min(nodes[node[:-1]]) if node else None
        out[min(members), len(node)] = (parent, len(members), sum(len(n) == len(node) + 1 for n in below), len(leaves), saved, digest(ends))
    return out


def nodes_of(df):
    got = [tuple(r) for r in df.collect()]
    assert len({r[:2] for r in got}) == len(got)
    return {r[:2]: r[2:] for r in got}


@pytest.mark.parametrize("shard_turns, chunk", [(1, 20), (7, 40), (prefix_trie.SHARD_TURNS, prefix_trie.CHUNK)])
def test_trie_of_shards_of_any_size_is_that_of_brute_force(talks, shard_turns, chunk):
    rows = [tuple(r) for r in talks.where("conv_id <> 3000 or turn < 40 or conv_id is null").select("conv_id", "turn", "role", "text").collect()]
    some = talks.where("conv_id <> 3000 or turn < 40 or conv_id is null")
    assert nodes_of(prefix_trie.prefix_nodes(prefix_trie.rebuilt(some), shard_turns, chunk)) == brute_nodes(rows)


def test_trie_without_conversations_has_no_nodes(no_talks):
    assert prefix_trie.prefix_nodes(prefix_trie.rebuilt(no_talks)).count() == 0


def test_the_middle_goes_first():
    assert list(prefix_trie.middle_first(7)) == [3, 1, 0, 2, 5, 4, 6]
    assert sorted(prefix_trie.middle_first(100)) == list(range(100))


def test_a_turn_that_is_the_end_of_one_shard_and_goes_on_in_the_next(spark):
    rows = [(1, [5], [2]), (2, [5, 6], [2, 3]), (3, [5, 6], [2, 3]), (4, [], []), (6, [7, 8, 9], [1, 1, 1])]
    seqs = spark.createDataFrame(rows, "conv_id long, turns array<long>, tokens array<long>").coalesce(1)
    got = nodes_of(prefix_trie.prefix_nodes(seqs, 1))
    assert got[1, 0][1:5] == (5, 2, 2, 2 * 2 + 3) and got[1, 1][1:5] == (3, 1, 1, 2 * 2 + 3) and got[2, 2][:5] == (1, 2, 0, 1, 3)
    assert got[1, 0][5] == digest("4") and got[2, 2][5] == digest("2,3") and got[6, 1][5] == digest("")


# ---- conversation repair

def brute_repair(roles, texts):
    """(cost, audit, repaired lines) by trying every edit of every turn."""
    n, seen, faults = len(roles), set(), []
    for row in zip(roles, texts, strict=True):
        body = row[1].strip(" \t\n\x0b\x0c\r")
        faults.append("b" if not body else "d" if row in seen else "t" if body[-1] not in ".!?" else "")
        seen.add(row)
    goes = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    @lru_cache(None)
    def best(i, state, inserted):
        found = []

        def add(cost, letter, line, rest):
            found.append((cost + rest[0], letter + rest[1], line + rest[2]))

        if i == n and state in ("", "a"):
            found.append((0, "", ()))
        if i < n:
            add(2, "D", (), best(i + 1, state, 0))
            if faults[i] not in ("b", "d"):
                extra = 5 * (faults[i] == "t")
                for cost, letter, role in ((0, "K", roles[i]), (1, "R", "user"), (1, "R", "assistant")):
                    if (state, role[:1]) in goes:
                        add(cost + extra, letter, (f"{role}:{texts[i]}",), best(i + 1, goes[state, role[:1]], 0))
        if inserted < 3:
            for role in ("user", "assistant"):
                if (state, role[0]) in goes:
                    add(5, "I", (f"{role}:",), best(i, goes[state, role[0]], inserted + 1))
        return min(found, default=(10**9, "", ()))

    cost, audit, lines = best(0, "", 0)
    return cost, audit, "\n".join(lines), [faults.count(f) for f in "bdt"]


def test_repair_of_one_conversation_is_that_of_brute_force():
    rng = random.Random(11)
    for _ in range(1500):
        n = rng.randint(0, 9)
        roles = [rng.choice(["user", "assistant", "system", "tool", "", "ux"]) for _ in range(n)]
        texts = [rng.choice(["Yes.", "no", "", " \t", "Why?", "never", "x!\n"]) + str(i) * rng.randint(0, 1) + rng.choice(["", "."]) for i in range(n)]
        got = conversation_repair.repaired_here([None] * n, roles, texts)
        cost, audit, lines, counts = brute_repair(roles, texts)
        assert (got["cost"], got["audit"], got["repaired"]) == (cost, audit, lines), (roles, texts)
        assert [got[k] for k in ("blank", "duplicate", "truncated")] == counts


def test_runs_by_binary_powers_are_steps_one_by_one():
    for sign in "suaoSUAOx":
        v = conversation_repair.END
        for n in range(1, 70):
            v = conversation_repair.applied(conversation_repair.power(sign, 0), v)
            assert v == conversation_repair.over_run(sign, n, conversation_repair.END)
    m = conversation_repair.matrix("uUxaas")
    v = conversation_repair.END
    for sign in reversed("uUxaas"):
        v = conversation_repair.applied(conversation_repair.power(sign, 0), v)
    assert conversation_repair.applied(m, conversation_repair.END) == v
    cost, audit, state = conversation_repair.solved("u" * 5000, conversation_repair.END)
    assert (cost, state) == (2500, 3) and audit == "KR" * 2500


def whole(df):
    """(conv_id, counts, cost, audit, repaired) with pieces put together."""
    found = {}
    for r in sorted(df.collect(), key=lambda r: (r["shard"], r["piece"])):
        stats = tuple(r[c] for c in conversation_repair.STATS)
        kept = found.setdefault(r["conv_id"], [stats, "", []])
        assert kept[0] == stats
        kept[1] += r["audit"]
        kept[2] += [r["repaired"]] * bool(r["repaired"])
    return {c: (*stats, audit, "\n".join(lines)) for c, (stats, audit, lines) in found.items()}


def by_turn(rows):
    convs = {}
    for c, t, role, text, lost in rows:
        out = convs.setdefault(c, [])
        if not lost:
            out.append((t is not None, t or 0, role.encode(), digest(text), text))
    return {c: [(x[1] if x[0] else None, x[2].decode(), x[4]) for x in sorted(out)] for c, out in convs.items()}


@pytest.mark.parametrize("piece_rows", [1, 3, conversation_repair.PIECE_ROWS])
def test_repair_in_pieces_of_any_size_is_that_of_brute_force(talks, piece_rows):
    damaged = conversation_repair.damaged(talks)
    want = {}
    for c, rows in by_turn(tuple(r) for r in damaged.select("conv_id", "turn", "role", "text", "lost").collect()).items():
        turns, roles, texts = ([r[k] for r in rows] for k in range(3))
        cost, audit, lines, counts = brute_repair(roles, texts)
        known = [t for t in turns if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a[:1] + b[:1] not in ("su", "ua", "au") for a, b in zip(roles, roles[1:], strict=False))
        want[c] = (gaps, *counts, illegal, cost, audit, lines)
    assert whole(conversation_repair.repair(damaged, piece_rows)) == want


def test_damage_of_rows(talks):
    plain = [tuple(r) for r in talks.select("conv_id", "turn", "role", "text").collect()]
    want = []
    for c, t, role, text in plain:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        text = "" if kind <= 1 else "".join(x for x in text if x not in ".!?") if kind == 2 else text
        want += [(c, t, "user" if kind == 4 else role, text, kind == 0)] * (2 if kind == 3 else 1)
    got = [tuple(r) for r in conversation_repair.damaged(talks).select("conv_id", "turn", "role", "text", "lost").collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_repair_of_no_rows_and_of_lost_ones(spark, no_talks):
    assert conversation_repair.repair(conversation_repair.damaged(no_talks)).count() == 0
    lost = spark.createDataFrame([(c, 1, "user", "x", True) for c in (1, 2, 3)], f"{TURNS}, lost boolean")
    assert whole(conversation_repair.repair(lost)) == {c: (0, 0, 0, 0, 0, 0, "", "") for c in (1, 2, 3)}


def test_repair_query_has_the_digests_of_whole_conversations(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    got = {r["conv_id"]: r for r in QUERIES["op13_conversation_repair"](spark, sf_dir).collect()}
    assert len(got) == rows.select("conv_id").distinct().count()
    for c, turns in by_turn(tuple(r) for r in conversation_repair.damaged(rows).select("conv_id", "turn", "role", "text", "lost").collect()).items():
        cost, audit, lines, counts = brute_repair([r[1] for r in turns], [r[2] for r in turns])
        assert (got[c]["cost"], got[c]["audit"], got[c]["repaired_sha256"]) == (cost, audit, digest(lines))


# ---- sentence pieces

@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=sentence_pieces.model_path())


@pytest.fixture(scope="module")
def model():
    return sentence_pieces.Pieces(sentence_pieces.model_path())


def own_ids(model, texts):
    ids, ends = model.encode(pa.array([" " + t if t else "" for t in texts], pa.large_string()))
    return [ids[a:b].tolist() for a, b in zip(ends, ends[1:], strict=False)]


def test_pieces_are_those_of_the_library(model, library):
    rng = random.Random(5)
    pieces = [library.id_to_piece(i) for i in range(259, 32000)]
    texts = ["", " ", "a", "  a  b ", "a\nb\n", "▁a ▁ ▁▁", "a\x00b", "漢字 𝔘 ﻿​", "<s> </s> <unk> <0x41>", "z" * 999, " " * 1000 + "x" + " " * 77, "ab" * 500, "the the   the"]
    for _ in range(1500):
        few = rng.choice(["abc ", "the and ing ", "é▁ z", "   x", ".,!? 0123", "aaab", "ießenü", "漢字日本の "])
        texts.append("".join(rng.choice(few) for _ in range(rng.randint(0, 80))))
        texts.append("".join(rng.choice(pieces) for _ in range(6)).replace("▁", rng.choice([" ", "▁", ""])))
    got, want = own_ids(model, texts), library.encode(texts)
    assert got == want
    for ids in want:
        assert model.decode(np.array(ids, np.int64)).decode() == library.decode(ids)


def test_words_beyond_the_rounds_finish_in_the_queue(model, library, monkeypatch):
    texts = ["internationalization of thnting " * 5, " " * 5000, "aaaa" * 100, "x" + " " * 700 + "ing"]
    for rounds in (0, 1, 2, 5):
        monkeypatch.setattr(sentence_pieces, "ROUNDS", rounds)
        assert own_ids(model, texts) == library.encode(texts)


def test_long_texts_in_parts(model, library, monkeypatch):
    monkeypatch.setattr(sentence_pieces, "SLICE", 50)
    for text in ["the quick brown fox " * 40 + "\n\n x", "ab" * 400, "漢字" * 100, " " * 300, "word\n" * 99]:
        ids = library.encode(text)
        want = (len(ids), digest(",".join(map(str, ids))), digest(library.decode(ids)))
        assert sentence_pieces._long_row(model, text) == want


def test_piece_query_over_odd_rows(docs, no_docs, library):
    got = sorted((tuple(r) for r in sentence_pieces.encode(docs, sentence_pieces.model_path()).collect()), key=repr)
    want = []
    for r in docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect():
        ids = library.encode(r["text"])
        want.append((r["doc_id"], len(ids), digest(",".join(map(str, ids))), digest(library.decode(ids))))
    assert got == sorted(want, key=repr)
    assert sentence_pieces.encode(no_docs, sentence_pieces.model_path()).count() == 0


def test_other_kinds_of_models_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    with open(sentence_pieces.model_path(), "rb") as f:
        m.ParseFromString(f.read())
    m.normalizer_spec.remove_extra_whitespaces = True
    (tmp_path / "m").write_bytes(m.SerializeToString())
    with pytest.raises(ValueError):
        sentence_pieces.Pieces(str(tmp_path / "m"))
