import hashlib
import struct

import numpy as np
import pyarrow.fs as pafs
import pytest

from loyalflow.llm import hashed_neighbours, warc
from loyalflow.llm.queries import ORACLE_SQL, QUERIES
from loyalflow.llm.shared import scratch_path

SMALL = "/root/testdata/sf0.001"


# ---- neighbours

def brute(vectors):
    ok = {i: np.array(v, float) for i, v in vectors if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)}
    out = {}
    for q in (i for i in ok if i % 20 == 0):
        score = {i: float((v * ok[q]).sum()) for i, v in ok.items() if i != q}
        out[q] = sorted(score, key=lambda i: (-score[i], i))[:20]
    return out


def test_nearest_recall_and_ties(spark):
    rng = np.random.default_rng(4)
    vectors = [(i, [float(x) for x in v]) for i, v in enumerate(rng.standard_normal((1500, 24)) * rng.uniform(0.5, 2, (1500, 1)))]
    vectors += [(2000 + i, vectors[7][1]) for i in range(60)]  # many equal ones: ties to smaller identifiers
    vectors += [(3000, None), (3001, [0.0] * 24), (3002, [float("nan")] * 24), (3003, [None] * 24), (3004, [1.0]), (None, vectors[0][1]), (0, vectors[0][1])]
    df = spark.createDataFrame([(i, v, "x") for i, v in vectors], "vec_id long, embedding array<float>, rank string")
    got = {}
    for r in hashed_neighbours.nearest(df).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    single = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in dict(vectors).items() if i is not None and i != 3004]
    want = brute(single)
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    recall = np.mean([len({*got[q]} & {*want[q]}) / 20 for q in want])
    assert recall >= 0.9
    assert got[2000] == want[2000]


def test_huge_components_take_part(spark):
    rng = np.random.default_rng(6)
    vectors = [(i, [float(x) for x in v]) for i, v in enumerate(rng.standard_normal((60, 4)))] + [(100, [1e200, 1.0, 0.0, 0.0]), (101, [1e160, -1e100, 1e-300, 0.0])]
    got = {}
    for r in hashed_neighbours.nearest(spark.createDataFrame(vectors, "vec_id long, embedding array<double>")).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    with np.errstate(over="ignore"):
        want = brute(vectors)
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    assert got[100][:1] == want[100][:1] and np.mean([len({*got[q]} & {*want[q]}) / 20 for q in want]) >= 0.9


def test_few_and_no_vectors(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (20, [-1.0, 0.0])], "vec_id long, embedding array<float>")
    got = sorted(map(tuple, hashed_neighbours.nearest(few).collect()))
    assert got == [(0, 1, 1, 0.5), (0, 2, 20, -1.0), (20, 1, 1, -0.5), (20, 2, 0, -1.0)]
    assert hashed_neighbours.nearest(few.limit(0)).count() == 0
    assert hashed_neighbours.nearest(few.where("vec_id = 1")).count() == 0


def test_index_finds_all_within_the_radius():
    codes = np.random.default_rng(0).integers(0, 256, (3000, 16), dtype=np.uint8)
    index = hashed_neighbours.MultiIndex(codes)
    for radius in (20, 50, 63):
        assert np.array_equal(index.within(codes[:40], radius), hashed_neighbours.distances(codes[:40], codes) <= radius)


# ---- WARC

PAGES = [(1, "http://a", "x" * 2000), (2, "http://b", "x" * 2000), (3, None, "x" * 2000), (4, "http://c", "small"), (5, "http://c", "small"), (6, "u", None), (7, "u", ""), (8, "u\r\nWARC-Type: bad", "é" * 600), (9, "u", "é" * 600), (9, "u", "é" * 600), (None, "u", "x" * 2000), (10, "big", "ab\r\n\r\nWARC/1.1" * 60_000)]


def test_bundles_round_trip(spark):
    pages = spark.createDataFrame([(*p, "k") for p in PAGES], "page_id long, url string, html string, length string")
    folder = scratch_path(spark, "test-warc")
    index = warc.write_bundles(pages, folder).collect()
    got = sorted((tuple(r) for r in warc.read_bundles(spark, folder).collect()), key=repr)
    want = []
    for i, _, html in PAGES:
        data = (html or "").encode()
        keep = max((j for j, _, h in PAGES if j is not None and (h or "") == (html or "")), default=None)
        revisit = len(data) >= 1000 and keep is not None and keep != i
        want.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", keep if revisit else None))
    assert got == sorted(want, key=repr)
    fs, path = pafs.FileSystem.from_uri(folder)
    with fs.open_output_stream(f"{path}/bundles/part-000000-of-a-lost-attempt.warc.zst") as f:
        f.write(b"half a frame")
    assert sorted((tuple(r) for r in warc.read_bundles(spark, folder).collect()), key=repr) == got
    bodies = {}
    for r in index:
        uri = f"{folder}/bundles/{r['bundle']}"
        bundle = warc.Bundle(uri)
        heads, body = bundle.record(r["frame"], r["offset"])
        assert heads["WARC-Record-ID"] == f"<{r['record_id']}>" and heads["WARC-Type"] in ("response", "revisit")
        bodies[r["page_id"]] = body
        with fs.open_input_file(pafs.FileSystem.from_uri(uri)[1]) as f:
            data = f.read()
        at = bundle.frames[-1][0] + bundle.frames[-1][1]
        magic, size = struct.unpack_from("<II", data, at)
        assert magic == warc.SKIPPABLE and at + 8 + size == len(data)
    assert bodies[10] == PAGES[-1][2].encode() and bodies[3] == b"x" * 2000 and bodies[1] == b""


def test_no_pages(spark):
    folder = scratch_path(spark, "test-warc")
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.write_bundles(none, folder).count() == 0 and warc.read_bundles(spark, folder).count() == 0


# ---- registered queries

@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_agrees_with_its_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for table in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    got = QUERIES[name](spark, SMALL).toArrow()
    want = con.sql(ORACLE_SQL[name]).to_arrow_table()
    columns = sorted(got.schema.names)
    assert columns == sorted(want.schema.names)
    con.register("got", got.select(columns))
    con.register("want", want.select(columns))
    assert con.sql("(FROM got EXCEPT ALL FROM want) UNION ALL (FROM want EXCEPT ALL FROM got)").fetchall() == []


def test_pipeline_agrees_with_its_stages_by_hand(spark):
    import re

    import corpus_pipeline
    from loyalflow.llm import bpe, source_mixing, toxicity
    from tests.llm.test_text_operators import brute_links

    assert [name.split("_")[0] for name, _ in corpus_pipeline.STAGES] == ["op6", "op10", "op2", "op5", "op9"]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    bad = {r["doc_id"] for r in toxicity.grade(docs, model).collect() if r["toxic"]}
    left = [r.asDict() for r in docs.collect() if r["doc_id"] not in bad]
    last = {}
    for r in sorted(left, key=lambda r: r["doc_id"]):
        last[re.sub("[A-Z]", lambda m: m[0].lower(), r["text"] or "")] = r
    left = sorted(last.values(), key=lambda r: r["doc_id"])
    sets, links = brute_links([r["text"] for r in left])
    up = {}
    for s, r in zip(sets, left):
        todo, group = [s], {s}
        while todo:
            for o in links.get(todo.pop(), ()):
                if o not in group:
                    group.add(o)
                    todo.append(o)
        up[r["doc_id"]] = min(q["doc_id"] for q, t in zip(left, sets) if t in group) if s else r["doc_id"]
    left = [r for r in left if up[r["doc_id"]] == r["doc_id"]]
    mixed = source_mixing.mix(spark.createDataFrame(left, docs.schema)).collect()
    codec = bpe.Codec(bpe.vocabulary())
    want = sorted((r["doc_id"], len(codec.whole.encode(r["text"] or "", add_special_tokens=False).ids)) for r in mixed)
    got = sorted((r["doc_id"], r["n_tokens"]) for r in corpus_pipeline.run(spark, SMALL).collect())
    assert got == want and bad
