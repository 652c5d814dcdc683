import hashlib
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loyalflow.llm import bpe, exact_dedup, jaccard_join, language_id, license_scan, lm_scoring, lm_tables, source_mixing, toxicity
from loyalflow.llm.shared import spread_join
from loyalflow.llm.words import words
from tests.llm.conftest import SCHEMA, TEXTS


def split(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def rows(df, *order):
    return sorted((tuple(r) for r in df.select(*order).collect()), key=repr)


def test_words_agree_with_the_pattern():
    texts = [t[1] for t in TEXTS] + ["Éa·b_c-D9", "a"]
    names = {}
    for w in words(pa.array(texts), (4,)):
        for i in range(w.rows):
            own = split(texts[w.first + i])
            assert len(own) == w.offsets[i + 1] - w.offsets[i]
            for word, h in zip(own, w.hash[w.offsets[i] : w.offsets[i + 1]]):
                assert names.setdefault(word, h) == h
    assert len(set(names.values())) == len(names)


# ---- license scan

def brute_base(ws, phrase):
    p = phrase.split()
    return [i for i in range(len(ws) - len(p) + 1) if ws[i : i + len(p)] == p]


@pytest.mark.parametrize("text", [
    "GNU General Public License, the gnu-general.public license; MIT  License? apache license apache license",
    "permit license mit licenses mit license", "cc by cc by-cc by", "gnu general public licensegnu general public license", "mit-license" * 50,
    "Apache Licence, version 2", "", None, "mit " + "x" * 100_000 + " mit license",
])
def test_base_places_are_all_and_only_the_exact_ones(text):
    got = license_scan.Scanner().scan(text)
    ws = split(text)
    places = {n.label: brute_base(ws, n.phrase) for n in license_scan.NOTICES if n.base}
    every = sorted(x for v in places.values() for x in v)
    assert got[:4] == (len(ws), len(every), every[0] if every else None, every[-1] if every else None)
    assert got[4] == ",".join(sorted(k for k, v in places.items() if v))
    assert set(filter(None, got[4].split(","))) <= set(got[5].split(","))
    assert 0 <= got[6] <= 1 and (got[6] == 1) == bool(got[4] or any(not s["edits"] for s in got[7]))


def test_fuzzy_places_have_edits_and_spans():
    text = "Under the Apache Licence and GNU Genral Public License."
    n, base, first, last, base_labels, labels, score, spans = license_scan.Scanner().scan(text)
    assert (base, base_labels, labels) == (0, "", "apache,gpl") and 0.8 < score < 1
    assert [(s["label"], s["edits"], text[s["start"] : s["stop"]]) for s in spans] == [("apache", 1, "Apache Licence"), ("gpl", 1, "GNU Genral Public License")]


def test_fuzzy_places_beside_exact_ones():
    text = "mit license mit licence mit license apache licence apache license"
    spans = license_scan.Scanner().scan(text)[7]
    assert [(s["label"], s["edits"], s["first_word"]) for s in spans] == [("mit", 0, 0), ("mit", 1, 2), ("mit", 0, 4), ("apache", 1, 6), ("apache", 0, 8)]


def test_license_scan_rows(docs, no_docs):
    got = license_scan.license_scan(docs).orderBy("doc_id").collect()
    assert len(got) == len(TEXTS) and license_scan.license_scan(no_docs).count() == 0
    by = {r["doc_id"]: r for r in got}
    assert by[1]["base_labels"] == "mit" and by[1]["first_word"] == 3 and by[3]["n_words"] == 0 and by[4]["score"] == 0


# ---- joins on keys that many rows share


def test_spread_join_is_a_left_join_that_deals_out_hot_keys(spark):
    key = F.when(F.col("id") % 3 > 0, F.when(F.col("id") % 3 > 1, F.lit(-1)).otherwise(F.col("id")))  # nulls, a hot key, and others
    left = spark.range(3000).select("id", key.alias("k"))
    right = spark.range(-1, 1500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    got = spread_join(left, right, ["k"], F.col("id"))
    assert sorted(map(tuple, got.select("id", "k", "v").collect()), key=repr) == sorted(map(tuple, left.join(right, "k", "left").select("id", "k", "v").collect()), key=repr)
    assert spread_join(left, right.where("false"), ["k"], F.col("id")).where("v is null").count() == 3000
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        tasks = spread_join(left, right, ["k"], F.col("id")).groupBy(F.spark_partition_id()).count()
        assert tasks.agg(F.max("count")).first()[0] < 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


# ---- exact dedup

def test_exact_dedup_rows(docs, no_docs):
    text_of = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    groups = {}
    for i, t, *_ in TEXTS:
        groups.setdefault(text_of(t), []).append(i)
    want = []
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep, kept = max(known) if known else None, False
        for i in ids:
            want.append((i, keep, len(ids), i == keep and not kept, hashlib.sha256(t.encode()).hexdigest()))
            kept |= i == keep
    assert rows(exact_dedup.exact_duplicates(docs), "doc_id", "keep_id", "group_size", "kept", "text_sha256") == sorted(want, key=repr)
    assert exact_dedup.exact_duplicates(no_docs).count() == 0
    left = exact_dedup.drop_duplicates(docs)
    assert left.columns == docs.columns and rows(left, "doc_id") == sorted(((w[0],) for w in want if w[3]), key=repr)


def test_tree_merge_of_a_hot_digest_takes_the_best(spark):
    many = spark.range(0, 5000, 1, 37).selectExpr("cast(sha2(if(id % 3 = 0, 'hot', cast(id as string)), 256) as binary) sha", "cast('c' as binary) check", "1L n_bytes", "id best", "1L n")
    got = exact_dedup.tree_merge(many, 70).collect()
    assert len(got) == 5000 - 1667 + 1 and sum(r["n"] for r in got) == 5000
    assert max(got, key=lambda r: r["n"])["best"] == 0


@pytest.mark.parametrize("runs", [1, 3, 40])
def test_blocks_of_sorted_runs_merge_as_one_sort_would(runs, monkeypatch):
    """Keys that end in zero bytes or are in every run, unknown identifiers, and more open blocks than are merged at once."""
    monkeypatch.setattr(exact_dedup, "BLOCK", 8)
    rng, blocks, want = np.random.default_rng(runs), [], {}
    for _ in range(runs):
        run = np.zeros(200, exact_dedup.RECORD)
        run["key"] = [bytes(rng.integers(0, 3, 2, np.uint8)) + b"\xff" * int(k) for k in rng.integers(0, 40, 200)]
        run["known"] = rng.integers(0, 2, 200)
        run["best"] = np.where(run["known"], rng.integers(-9, 9, 200), exact_dedup.WORST)
        run["n"] = rng.integers(1, 5, 200)
        for key, known, best, n in run.tolist():
            have = want.get(key, (0, exact_dedup.WORST, 0))
            want[key] = (max(have[0], known), min(have[1], best), have[2] + n)
        run = exact_dedup.merge_runs([np.sort(run, order="key")])
        blocks += [exact_dedup._unpack(exact_dedup._pack(run[a : a + 8])) for a in range(0, len(run), 8)]
    blocks.sort(key=lambda b: b["key"][0])
    got = [x for piece in exact_dedup.merge_blocks(iter(blocks)) for x in piece.tolist()]
    assert [(k, *want[k]) for k in sorted(want)] == got


def test_tree_merge_fills_its_slots_evenly(spark):
    """One slot a task, and no more slots than the fan needs for the asked number."""
    many = spark.range(0, 20_000, 1, 5).selectExpr("cast(unhex(sha2(cast(id as string), 256)) as binary) sha", "cast('checked_' as binary) check", "id n_bytes", "nullif(id, 7) best", "1L n")
    merged = exact_dedup.tree_merge(many, 30)
    got = merged.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.sum(F.col("best").isNull().cast("int")).alias("unknown")).collect()
    assert len(got) == 36 and sum(r["n"] for r in got) == 20_000 and sum(r["unknown"] for r in got) == 1
    assert max(r["n"] for r in got) < 1.3 * 20_000 / 36
    assert merged.where("n_bytes <> best or check <> cast('checked_' as binary)").count() == 0


def test_exact_dedup_takes_the_largest_and_least_identifiers(spark):
    ends = [(-(2**63), "a"), (2**63 - 1, "A"), (-(2**63), "b"), (None, "b")]
    docs = spark.createDataFrame(ends, "doc_id long, text string")
    assert rows(exact_dedup.drop_duplicates(docs), "doc_id", "text") == [(-(2**63), "b"), (2**63 - 1, "A")]
    assert {r["keep_id"] for r in exact_dedup.exact_duplicates(docs, "smallest").collect()} == {-(2**63)}


# ---- Jaccard join

def brute_links(texts):
    sets = [frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if (w := split(t)) else frozenset() for t in texts]
    kinds = [s for s in dict.fromkeys(sets) if s]
    return sets, {s: {o for o in kinds if o != s and len(s & o) >= 0.8 * len(s | o) - 1e-9} for s in kinds}


def near_texts(seed=3):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(25):
        base = [f"w{x}" for x in rng.integers(0, 50_000, rng.integers(5, 400))]
        for _ in range(rng.integers(1, 9)):
            copy = list(base)
            for _ in range(rng.integers(0, 4)):
                copy[rng.integers(len(copy))] = f"x{rng.integers(1000)}"
            out.append(" ".join(copy))
    passage = " ".join(f"p{k}" for k in range(30))
    return out + [f"{passage} " + " ".join(f"w{x}" for x in rng.integers(0, 50_000, 60)) for _ in range(60)]


@pytest.mark.parametrize("small", [1024, 6])
def test_jaccard_join_finds_the_links_of_brute_force(spark, monkeypatch, small):
    """With small buckets, too: then most are split to the last level and compared in blocks."""
    monkeypatch.setattr(jaccard_join, "SMALL", small)
    texts = near_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets, links = brute_links(texts)
    got = {r["doc_id"]: r for r in jaccard_join.near_duplicates(docs).collect()}
    found, every = (sum(n for s, n in zip(sets, counts) if s) for counts in ([got[i]["n_links"] for i in range(len(sets))], [len(links[s]) for s in sets]))
    assert len(got) == len(texts) and sum(map(len, links.values())) > 100
    assert found >= 0.99 * every
    assert all(got[i]["n_links"] <= len(links[s]) for i, s in enumerate(sets))
    for i, s in enumerate(sets):
        assert got[i]["set_id"] == sets.index(s)
        assert got[i]["class_id"] == i or links[s] or sets.index(s) < i


def test_pairs_of_a_large_family_are_those_of_each_by_itself():
    """More than FEW sets, so that products choose and check the pairs."""
    rng = np.random.default_rng(8)
    base = rng.integers(0, 1 << 63, 300).astype(np.uint64)
    sets = [np.unique(np.concatenate([np.delete(base, rng.integers(0, 300, rng.integers(0, 60))), rng.integers(0, 1 << 63, rng.integers(0, 30)).astype(np.uint64)])) for _ in range(150)]
    own = [sorted({500, *rng.integers(0, 1000, 3).tolist()}) for _ in sets]
    block = rng.integers(0, 2, 150).tolist()
    t = {"bucket": [500] * 150, "low": [0] * 150, "high": [1] * 150, "block": block, "n": list(map(len, sets)), "own": own}
    t = pa.table(t | {"cls": [jaccard_join.class_of(s) for s in sets], "sketch": [jaccard_join.sketch(s) for s in sets]})
    got = set(zip(*(x.tolist() for x in jaccard_join._candidates(t))))
    mine = {(a, b) for a in range(150) for b in range(a + 1, 150) if block[a] != block[b] and min(set(own[a]) & set(own[b])) == 500}
    near = {(a, b) for a, b in mine if len(np.intersect1d(sets[a], sets[b])) >= 0.8 * len(np.union1d(sets[a], sets[b]))}
    assert near <= got <= mine and len(near) > 100
    every = np.array([(a, b) for a in range(150) for b in range(a)])
    want = [len(np.intersect1d(sets[a], sets[b])) for a, b in every]
    assert jaccard_join.common(sets, *every.T).tolist() == want and jaccard_join.common(sets, *every[:3].T).tolist() == want[:3]
    assert jaccard_join._gram(np.array([0, 1]), np.array([7, 7]), 2, 1.0) is None


def test_jaccard_rows(docs, no_docs):
    got = {r["doc_id"]: r for r in jaccard_join.near_duplicates(docs).collect()}
    assert got[1]["class_id"] == got[2]["class_id"] == 1 and got[3]["class_id"] == 3 and got[4]["class_id"] == 4 and got[5]["n_shingles"] == 0
    assert got[6]["n_shingles"] == 1 and got[8]["n_links"] == 0
    assert jaccard_join.near_duplicates(no_docs).count() == 0
    left = jaccard_join.drop_near_duplicates(docs)
    assert left.columns == docs.columns and rows(left, "doc_id") == sorted([(1,), (3,), (4,), (5,), (6,), (7,), (8,), (None,)], key=repr)


@pytest.mark.parametrize("seed", [14079, 23418, 24620])
def test_sketches_keep_unlucky_pairs_at_the_threshold(seed):
    """Pairs with a similarity of 0.8 that only 38 of 64 bins show."""
    u = np.random.default_rng(seed).integers(0, 1 << 64, 1000, np.uint64, endpoint=False)
    sets = [np.sort(u[:900]), np.sort(u[100:])]
    t = {"bucket": [1, 1], "low": [0, 0], "high": [0, 0], "block": [0, 0], "n": [900, 900], "own": [[1], [1]]}
    i, j = jaccard_join._candidates(pa.table(t | {"cls": [jaccard_join.class_of(s) for s in sets], "sketch": [jaccard_join.sketch(s) for s in sets]}))
    assert list(zip(i, j)) == [(0, 1)]


def test_jaccard_near_copies_without_identifiers(spark):
    def text(topic, last):
        return " ".join(f"{topic}{k}" for k in range(60)) + f" {last}"

    docs = [(None, text("a", "x")), (None, text("a", "y")), (None, text("a", "y")), (None, text("b", "x")), (7, text("b", "y")), (9, text("b", "z")), (None, text("c", "x")), (None, "!!!"), (3, text("d", "x"))]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    got = sorted((tuple(r) for r in jaccard_join.near_duplicates(docs).select("doc_id", "class_id", "set_id", "n_links").collect()), key=repr)
    want = [(None, None, None, 1)] * 3 + [(None, 7, None, 2), (7, 7, 7, 2), (9, 7, 9, 2), (None, None, None, 0), (None, None, None, 0), (3, 3, 3, 0)]
    assert got == sorted(want, key=repr)
    left = [tuple(r) for r in jaccard_join.drop_near_duplicates(docs).collect()]
    assert sum(t.startswith("a0 ") for _, t in left) == 1
    assert sorted((r for r in left if not r[1].startswith("a0 ")), key=repr) == sorted([(7, text("b", "y")), (None, text("c", "x")), (None, "!!!"), (3, text("d", "x"))], key=repr)


def test_texts_without_identifiers_are_fetched_once_each(spark):
    texts = [f"own{k} words that are not the others" for k in range(30)]
    docs = spark.createDataFrame([(None, t) for t in texts] * 3, "doc_id long, text string").select("doc_id", F.xxhash64("text").alias("digest"), "text")
    names = [(jaccard_join.class_of(s), t) for s, t in zip(jaccard_join._row_sets(pa.array(texts)), texts)]
    wanted = spark.createDataFrame(names, "cls binary, text string").select("cls", F.lit(None).cast("long").alias("first"), F.xxhash64("text").alias("digest"))
    got = [bytes(r["cls"]) for r in jaccard_join._fetched(docs, wanted).collect()]
    assert sorted(got) == sorted(c for c, _ in names)


def test_components_join_long_chains(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100 + i, 100) for i in range(1, 30)], "a long, b long")
    got = dict(map(tuple, jaccard_join.components(edges).collect()))
    assert got == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 130)}}


# ---- LM scoring

def test_lm_scores_by_joined_tables_are_those_of_packed_requests(spark, docs, no_docs):
    """Of odd and of repeated rows, and with a third of all texts the same two words."""
    names = ("doc_id", "n_words", "log_score", "mean_log_score")
    texts = near_texts()[:120] + ["one two", "Two ONE", "one two three one two"] * 40
    for table in (docs, spark.createDataFrame([(i // 2 if i % 7 else None, t) for i, t in enumerate(texts)], "doc_id long, text string")):
        got, want = (sorted((tuple(r) for r in df.select(*names).collect()), key=lambda r: (r[0] is None, r[0], r[1], r[2])) for df in (lm_tables.lm_scores_joined(table), lm_scoring.lm_scores(table)))
        assert len(got) == len(want) and [r[:2] for r in got] == [r[:2] for r in want]
        assert all(a[2:] == pytest.approx(b[2:], abs=2e-6) for a, b in zip(got, want))
    assert lm_tables.lm_scores_joined(no_docs).count() == 0


def test_lm_scores_agree_with_plain_counting(spark, docs, no_docs):
    texts = [t for _, t, *_ in TEXTS]
    ws = [split(t) for t in texts]
    c = Counter(tuple(w[i : i + n]) for w in ws for n in (1, 2, 3) for i in range(len(w) - n + 1))
    total = sum(map(len, ws))

    def score(w, i, n):
        if n == 1:
            return c[(w[i],)] / total
        gram = tuple(w[i - n + 1 : i + 1])
        return c[gram] / c[gram[:-1]] if c[gram] >= 2 else 0.4 * score(w, i, n - 1)

    want = sorted(((i, len(w), round(sum(math.log(score(w, k, min(3, k + 1))) for k in range(len(w))), 4)) for (i, *_), w in zip(TEXTS, ws)), key=repr)
    got = [(r["doc_id"], r["n_words"], round(r["log_score"], 4)) for r in lm_scoring.lm_scores(docs).collect()]
    assert [g[:2] for g in sorted(got, key=repr)] == [w[:2] for w in want]
    assert np.allclose([g[2] for g in sorted(got, key=repr)], [w[2] for w in want], atol=1e-3)
    assert lm_scoring.lm_scores(no_docs).count() == 0


def test_lm_chunks_and_parts_change_nothing(spark):
    docs = spark.createDataFrame(list(enumerate(near_texts(5))), "doc_id long, text string")
    one = rows(lm_scoring.lm_scores(docs), "doc_id", "log_score")
    many = rows(lm_scoring.lm_scores(docs, chunk_bytes=9000, part_ngrams=5000), "doc_id", "log_score")
    assert [a[0] for a in one] == [a[0] for a in many] and np.allclose([a[1] for a in one], [a[1] for a in many], atol=2e-6)
    unnamed = docs.select(F.lit(None).cast("long").alias("doc_id"), "text")
    got = sorted(r["log_score"] for r in lm_scoring.lm_scores(unnamed, chunk_bytes=9000, part_ngrams=5000).collect())
    assert np.allclose(got, sorted(a[1] for a in one), atol=2e-6)


# ---- language ID

def test_language_id_rows_and_rules(spark, docs, no_docs):
    words_of = {"en": ["the", "house", "with", "water"], "de": ["der", "haus", "mit", "wasser"], "xx": ["мир", "дом", "вода"]}
    rng = np.random.default_rng(1)
    train = spark.createDataFrame([(k * 1000 + i, " ".join(rng.choice(w, 30)), lang) for k, (lang, w) in enumerate(words_of.items()) for i in range(60)] + [(9009, None, "en"), (9010, "q", None)], "doc_id long, text string, lang string")
    model = language_id.fit(train)
    assert model.langs == ["de", "en", "xx"]
    got = {r["doc_id"]: r for r in language_id.identify(train, model).collect()}
    assert all(got[k * 1000 + i]["lang_pred"] == lang for k, lang in enumerate(words_of) for i in range(60))
    assert got[9009]["lang_pred"] == "und" and got[9010]["lang_pred"] in model.langs and got[9010]["score"] == 0
    odd = {r["doc_id"]: r for r in language_id.identify(docs, model).collect()}
    assert [odd[k]["lang_pred"] for k in (3, 4, 5)] == ["und"] * 3 and all(0 <= r["score"] <= 1 for r in odd.values())
    nothing = language_id.fit(no_docs)
    assert nothing.langs == [] and {r["lang_pred"] for r in language_id.identify(docs, nothing).collect()} == {"und"}
    assert language_id.identify(no_docs, model).count() == 0


def test_many_languages_share_one_filter(spark):
    train = spark.createDataFrame([(i, f"{'abcdefghijkl'[i % 12] * 4}{'xyz'[i % 3] * 3} " * 5, f"l{i % 12:02}") for i in range(120)], "doc_id long, text string, lang string")
    model = language_id.fit(train)
    assert model.slots.shape[1] == 2
    assert all(r["lang_pred"] == f"l{r['doc_id'] % 12:02}" for r in language_id.identify(train, model).collect())


def test_filter_masks_are_those_of_exact_sets(spark):
    """Every language that holds an n-gram is in its mask, others are there as often as ``false`` says, and the corrected counts
    are near the exact ones."""
    rng = np.random.default_rng(2)
    own = [rng.integers(0, 1 << 63, 30_000).astype(np.uint64) for _ in range(11)]
    own[1] = np.concatenate([own[1], own[0][:500]])
    slots = np.zeros((1 << language_id.SLOT_BITS, 2), np.uint8)
    for i, grams in enumerate(own):
        for s in language_id._slots(grams):
            slots[s, i // 8] |= np.uint8(1 << i % 8)
    fill = np.array([(slots[:, i // 8] >> (i % 8) & 1).mean() for i in range(len(own))])

    def has(grams, i):
        a, *more = language_id._slots(grams)
        mask = slots[a]
        for s in more:
            mask = mask & slots[s]
        return (mask[:, i // 8] >> (i % 8)) & 1

    for i, grams in enumerate(own):
        assert has(grams, i).all()
        other = rng.integers(0, 1 << 63, 200_000).astype(np.uint64)
        expect = fill[i] ** language_id.HASHES
        assert abs(has(other, i).mean() - expect) < 5 * math.sqrt(expect / 200_000) + 1e-4
    assert has(own[0][:500], 1).all()


def test_language_of_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    got = language_id.op4_language_id(spark, sf_dir).where("held_out").join(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id")
    rows = got.where("lang is not null and lang_pred <> 'und'").select("lang", "lang_pred").collect()
    assert len(rows) > 100 and sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.98 * len(rows)


# ---- toxicity

def test_toxicity_of_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    half = F.crc32(F.concat(F.lit("half:"), F.col("doc_id").cast("string"))) % 2
    model = toxicity.fit(docs, labels.where(half == 0))
    rest = labels.where(half == 1).select("doc_id", F.col("toxic").alias("label"))
    rows = toxicity.grade(docs, model).join(rest, "doc_id").select("label", "toxic").collect()
    found, clean = [r["toxic"] for r in rows if r["label"]], [r["toxic"] for r in rows if not r["label"]]
    print("held out: toxic found", sum(found), "of", len(found), "clean rejected", sum(clean), "of", len(clean))
    assert len(found) > 150 and sum(found) >= 0.85 * len(found) and sum(clean) <= 0.01 * len(clean)


def test_toxicity_learns_and_takes_odd_rows(spark, docs, no_docs):
    rng = np.random.default_rng(2)
    clean = [" ".join(f"w{x}" for x in rng.integers(0, 300, 40)) for _ in range(200)]
    bad = [t + " " + " ".join(rng.choice(["idiot", "scum", "vermin", "vequda", "vequna"], rng.integers(1, 12))) for t in clean[:80]]
    train = spark.createDataFrame(list(enumerate(clean + bad)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, int(i >= 200)) for i in range(280)] + [(5000, 1, 1), (3, 1, None), (None, 0, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(train, labels)
    got = {r["doc_id"]: r for r in toxicity.grade(train, model).collect()}
    assert sum(got[i]["toxic"] for i in range(200)) == 0 and sum(got[i]["toxic"] for i in range(200, 280)) >= 78
    assert np.all(np.diff(model.thresholds) > 0) and all(0 <= r["severity"] <= toxicity.GRADES for r in got.values())
    low, high = (np.mean([got[200 + i]["severity"] for i in range(80) if keep(len(bad[i].split()) - 40)]) for keep in (lambda n: n <= 3, lambda n: n >= 8))
    assert high > low + 0.5
    odd = toxicity.grade(docs, model).collect()
    assert len(odd) == len(TEXTS) and not any(r["toxic"] for r in odd)
    left = toxicity.drop_toxic(docs, model)
    assert left.columns == docs.columns and left.count() == len(TEXTS)
    assert toxicity.grade(no_docs, model).count() == 0
    assert not any(r["toxic"] for r in toxicity.grade(train, toxicity.fit(train, labels.limit(0))).collect())


# ---- mixing

def test_mixing_meets_its_targets(spark):
    docs = spark.range(0, 6000).selectExpr("id doc_id", "'abcd' text", "if(id % 3 > 0, 'big', if(id % 300 = 0, 'tiny', 'mid')) source")
    weights = {"big": 1.0, "mid": 1.0, "tiny": 2.0}
    got = Counter(r["source"] for r in source_mixing.mix(docs, weights).collect())
    for source, weight in weights.items():
        want = 6000 * weight / 4
        assert abs(got[source] - want) < 5 * math.sqrt(want) + (0.2 * want if source == "tiny" else 0)


def test_mixing_counts_are_poisson_and_seeded(spark):
    docs = spark.range(0, 20_000).selectExpr("id doc_id", "'abcd' text", "'one' source")
    count = Counter(r["n_copies"] for r in source_mixing.mix(docs, epochs=1.3).where("copy_no = 1").collect())
    for k in (1, 2, 3):
        want = 20_000 * math.exp(-1.3) * 1.3**k / math.factorial(k)
        assert abs(count[k] - want) < 5 * math.sqrt(want)
    once, again, other = (rows(source_mixing.mix(docs, epochs=1.3, seed=s), "doc_id", "copy_no", "shuffle_key") for s in (17, 17, 18))
    assert once == again and {r[2] for r in once}.isdisjoint(r[2] for r in other) and {r[:2] for r in once} != {r[:2] for r in other}


@pytest.mark.parametrize("ids", ["null", "if(id % 2 = 0, null, id)"])
def test_rows_without_identifiers_meet_their_targets(spark, ids):
    docs = spark.range(0, 10_000).selectExpr(f"cast({ids} as long) doc_id", "concat('text ', 10000 + id) text", "if(id % 4 = 0, 'a', 'b') source")
    got = list(source_mixing.mix(docs, {"a": 1.0, "b": 1.0}).collect())
    for source in "ab":
        own = Counter(r["n_copies"] for r in got if r["source"] == source and r["copy_no"] == 1)
        assert abs(sum(k * n for k, n in own.items()) - 5_000) < 5 * math.sqrt(5_000) and len(own) > 3
    assert len({r["shuffle_key"] for r in got}) == len(got)


def test_rows_without_identifiers_are_many_tasks_work(spark):
    docs = spark.createDataFrame([(None, f"text {i}", "en", "a") for i in range(400)], SCHEMA)
    got = source_mixing.mix(docs, epochs=3.0).groupBy(F.spark_partition_id().alias("task"), "copy_no").count().collect()
    by_copy = Counter(r["copy_no"] for r in got)
    assert got and min(by_copy.values()) > 1


def test_salted_rates_change_nothing(spark, docs, no_docs, monkeypatch):
    one = rows(source_mixing.mix(docs, epochs=3), "doc_id", "copy_no", "n_copies", "shuffle_key")
    monkeypatch.setattr(source_mixing, "BROADCAST_SOURCES", 0)
    assert rows(source_mixing.mix(docs, epochs=3), "doc_id", "copy_no", "n_copies", "shuffle_key") == one and one
    assert source_mixing.mix(no_docs).count() == 0


# ---- BPE

@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.vocabulary())


def expected(codec, text):
    ids = codec.whole.encode(text or "", add_special_tokens=False).ids
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(codec.whole.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_both_libraries_agree_on_latin_text(codec):
    signs = [chr(c) for c in range(0x2100) if bpe._LATIN.fullmatch(chr(c))]
    for c in signs:
        for text in (f"a{c}b", f" {c} ", f"1{c}{c}2", f"'{c}", f"{c}'s  x"):
            assert codec.encode(text) == codec.whole.encode(text, add_special_tokens=False).ids, repr(text)


def test_bpe_rows(codec, docs, no_docs):
    got = rows(bpe.encode(docs, bpe.vocabulary()), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert got == sorted(((i, *expected(codec, t)) for i, t, *_ in TEXTS), key=repr)
    assert bpe.encode(no_docs, bpe.vocabulary()).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_tree_concatenation_is_exact(codec, monkeypatch, seed):
    """Of unsplit text, too, cut anywhere."""
    monkeypatch.setattr(bpe, "PIECE", 24)
    rng = np.random.default_rng(seed)
    parts = ["the", "ing", "aaaa", " ", "  ", "\n", "é", "漢", "'s", "12", "!", "-", "<|endoftext|>", "zq" * 40, " " * 60, "=" * 90, "über", "tion" * 30]
    for _ in range(150):
        text = "".join(rng.choice(parts, rng.integers(1, 40)))
        leaves = [(inner, codec.raw.encode(t, add_special_tokens=False).ids if inner else codec.encode(t)) for inner, t in codec.pieces(text)]
        assert "".join(t for _, t in codec.pieces(text)) == text
        assert codec.tree(leaves) == codec.whole.encode(text, add_special_tokens=False).ids, repr(text)
