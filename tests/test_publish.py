"""A run that can be repeated and is published at one moment."""

from __future__ import annotations

import tempfile
from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from loyalflow.config import FIXTURE_PROGRAM as P
from loyalflow.config import RunContext
from loyalflow.plans import publish
from loyalflow.plans.migration import K3_COLUMNS
from loyalflow.sources import Sources
from tests.conftest import rows

FIRST, SECOND = RunContext(datetime(2024, 3, 4, 1)), RunContext(datetime(2024, 3, 5, 1))


@pytest.fixture()
def root():
    return tempfile.mkdtemp(prefix="loyalflow-publish-")


def stamp(df):
    return rows(df.select("dl_batch_date").distinct())


def failing(src: Sources, column: str) -> Sources:
    """Inputs whose store table breaks the run half-way, when rows of K3 are already being written."""
    broken = src.store.withColumn(column, F.when(F.col("store_code") > "S5", F.raise_error(F.lit("lost disk"))).otherwise(F.col(column)).cast("string"))
    return replace(src, store=broken)


def test_a_run_that_breaks_leaves_the_former_table_and_resumes(spark, small_src, root):
    with pytest.raises(ValueError, match="nothing is published"):
        publish.current(spark, root, P)
    first = publish.publish(spark, small_src, P, FIRST, root)
    assert (first.number, first.written) == (0, list(publish.STAGES)) and not any(first.broken.values())
    reader = publish.current(spark, root, P)
    before = rows(reader)
    assert reader.columns == K3_COLUMNS and len(before) == first.rows > 0

    with pytest.raises(Exception, match="lost disk"):
        publish.publish(spark, failing(small_src, "store_name"), P, SECOND, root)
    store = publish.Store(spark, root)
    name = publish.run_name(P, SECOND)
    assert store.exists(f"runs/{name}/base/_SUCCESS") and not store.exists(f"runs/{name}/performance/_SUCCESS")
    assert stamp(publish.current(spark, root, P)) == [("20240304",)] and rows(publish.current(spark, root, P)) == before

    second = publish.publish(spark, small_src, P, SECOND, root)
    assert second.written == ["performance"] and second.number == 1  # K1, K2 and the metrics are read, not made again
    assert stamp(publish.current(spark, root, P)) == [("20240305",)]
    same = [c for c in K3_COLUMNS if not c.startswith("dl_")]
    assert rows(publish.current(spark, root, P).select(same)) == rows(reader.select(same))
    assert rows(reader) == before  # who began to read before the switch still reads the old files

    again = publish.publish(spark, small_src, P, SECOND, root)
    assert again.number == 1 and len(publish.manifests(spark, root)) == 2


def test_a_run_that_breaks_an_invariant_is_not_published(spark, small_src, root):
    bad = replace(P, member_id_width=7)
    publish.publish(spark, small_src, P, FIRST, root)
    real = dict(publish.K3_RULES)
    try:
        publish.K3_RULES["no member has points"] = "point IS NOT NULL"
        with pytest.raises(publish.InvariantError, match="no member has points"):
            publish.publish(spark, small_src, bad, SECOND, root)
        assert stamp(publish.current(spark, root, P)) == [("20240304",)]
        let = publish.publish(spark, small_src, bad, SECOND, root, tolerated=frozenset(["no member has points"]))
        assert let.broken["no member has points"] > 0 and let.written == []
    finally:
        publish.K3_RULES.clear()
        publish.K3_RULES.update(real)


def test_a_phone_with_two_encrypted_forms_is_no_repeated_row(spark, small_src, root):
    two = small_src.encrypt_phone.union(small_src.encrypt_phone.limit(5).withColumn("encrypt_phone", F.lit("other")))
    assert not any(publish.publish(spark, replace(small_src, encrypt_phone=two), P, FIRST, root).broken.values())


def test_lost_and_repeated_base_rows_are_counted(spark, small_src, root):
    publish.publish(spark, small_src, P, FIRST, root)
    base, k3 = publish.current(spark, root, P, "base"), publish.current(spark, root, P)
    assert not any(publish.broken_rules(base, k3, P)[1].values())
    assert publish.broken_rules(base.union(base.limit(3)), k3, P)[1]["repeated base row"] == 3
    phone = base.select("phone").where("phone is not null").first()["phone"]
    assert publish.broken_rules(base, k3.where(F.col("phone") != phone), P)[1]["base row lost"] > 0
    commas = base.withColumn("phone", F.concat("phone", F.lit(",")))
    assert publish.broken_rules(commas, k3, P)[1]["phone with a comma"] > 0


def test_manifests_never_replace_one_another(spark, root):
    store = publish.Store(spark, root)
    assert store.create("manifests/00000000.json", '{"run": "a", "rows": 1, "broken": {}, "written": []}')
    assert not store.create("manifests/00000000.json", '{"run": "b", "rows": 1, "broken": {}, "written": []}')
    assert [m.run for m in publish.manifests(spark, root)] == ["a"]
    assert store.names("manifests") == ["00000000.json"]


def test_prune_keeps_the_latest_runs(spark, root):
    store = publish.Store(spark, root)
    for k, name in enumerate(("a", "b", "a", "c")):
        spark.range(k).write.mode("overwrite").parquet(f"{root}/runs/{name}/performance")
        assert store.create(f"manifests/{k:08d}.json", f'{{"run": "{name}", "rows": {k}, "broken": {{}}, "written": []}}')
    spark.range(1).write.parquet(f"{root}/runs/unpublished/performance")
    assert publish.prune(spark, root, keep=2) == ["b"] and publish.prune(spark, root, keep=2) == []
    assert store.names("runs") == ["a", "c", "unpublished"]
    assert publish.current(spark, root, P).count() == 3


def test_published_names_reach_the_manifested_table(spark, small_src, root):
    named = replace(P, names={"base": {"partner": "retailer"}, "performance": {"partner": "retailer"}})
    publish.publish(spark, small_src, named, FIRST, root)
    assert "retailer" in publish.current(spark, root, named).columns
    assert "retailer" in publish.current(spark, root, named, "base").columns
