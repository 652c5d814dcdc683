"""Operator 5, mixing sources to target weights: Poisson replication.

A source's rate is the mean number of copies that takes it to its target share of the corpus. Each document's count is
the Poisson distribution of that mean, inverted at a uniform number that a seeded hash of its identifier gives: the same
document always gets the same count, whatever the partitions. Documents are exploded by their counts, and the copies
are dealt out and sorted by another hash, which is a global shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loyalflow.llm.shared import tasks, written

#: Default targets: weights in proportion to a source's characters to this power. Rates beyond STEP are drawn in parts.
POWER, EPOCHS, SEED, STEP = 0.5, 1.0, 17, 100.0
#: Rates of so many sources are broadcast; beyond, they are joined on (source, salt).
BROADCAST_SOURCES, SALTS = 2000, 64


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from 48 bits of the MD5 of the parts."""
    text = F.concat_ws(":", *(F.coalesce(p.cast("string"), F.lit("null")) for p in parts))
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def poisson_table(rate: Column) -> Column:
    """The distribution function at 0, 1, ..., as far as it stays below 1 in double precision."""
    steps = F.sequence(F.lit(1), F.ceil(rate + 10 * F.sqrt(rate) + 20).cast("int"))
    first = F.exp(-rate)
    start = F.struct(F.array(first).alias("cdf"), first.alias("p"))

    def add(s: Column, k: Column) -> Column:
        p = s["p"] * rate / k
        return F.struct(F.array_append(s["cdf"], F.element_at(s["cdf"], -1) + p).alias("cdf"), p.alias("p"))

    return F.aggregate(steps, start, add, lambda s: s["cdf"])


def rates(docs: DataFrame, weights: Mapping[str, float] | None = None, epochs: float = EPOCHS) -> DataFrame:
    """source, rate, parts, cdf. Targets: ``weights`` by source (others get 0), or the default. A null source is a source
    of its own; one without any character keeps the rate ``epochs``."""
    sizes = docs.groupBy(F.col("source").cast("string").alias("source")).agg(F.sum(F.length(F.coalesce(F.col("text").cast("string"), F.lit("")))).cast("double").alias("size"))
    if weights is None:
        weighed = sizes.withColumn("weight", F.pow("size", F.lit(POWER)))
    else:
        given = docs.sparkSession.createDataFrame([(k, float(v)) for k, v in weights.items()], "source string, weight double")
        weighed = sizes.join(given, "source", "left").fillna(0.0, ["weight"])
    total = weighed.agg(F.sum("size").alias("all_size"), F.sum("weight").alias("all_weight"))
    rate = F.when((F.col("size") > 0) & (F.col("all_weight") > 0), F.lit(epochs) * F.col("all_size") * F.col("weight") / F.col("all_weight") / F.col("size")).otherwise(F.lit(epochs))
    out = weighed.join(F.broadcast(total), F.lit(True)).select("source", rate.alias("rate"))  # one row
    parts = F.greatest(F.lit(1), F.ceil(F.col("rate") / STEP)).cast("int")
    return out.withColumn("parts", parts).withColumn("cdf", poisson_table(F.col("rate") / F.col("parts")))


def mix(docs: DataFrame, weights: Mapping[str, float] | None = None, epochs: float = EPOCHS, seed: int = SEED) -> DataFrame:
    """Copies of the rows of ``docs`` (doc_id, text, source and others, which are kept) in shuffled order, with copy_no
    (from 1), n_copies and shuffle_key; columns of these names give way. Repeated rows get equal counts each. A row without an
    identifier is named by the MD5 of its text, so that each text of a source has a draw and a place of its own."""
    spark = docs.sparkSession
    table = written(rates(docs, weights, epochs), "rates")
    name = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("t"), F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")))))
    row = docs.select(F.struct(*docs.columns).alias("row"), name.alias("_id"), F.col("source").cast("string").alias("_source"))
    if table.count() <= BROADCAST_SOURCES:
        joined = row.join(F.broadcast(table), F.col("_source").eqNullSafe(F.col("source")))
    else:
        salted = table.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        row = row.withColumn("_salt", F.pmod(F.hash("_id"), F.lit(SALTS)))
        joined = row.join(salted, F.col("_source").eqNullSafe(F.col("source")) & (F.col("_salt") == F.col("salt")))
    drawn = lambda part: F.size(F.filter("cdf", lambda c: c <= uniform(F.lit(seed), F.col("_id"), part)))
    count = F.aggregate(F.sequence(F.lit(1), F.col("parts")), F.lit(0), lambda n, part: n + drawn(part))
    copies = joined.select("row", "_id", count.alias("n_copies")).where("n_copies > 0")
    copies = copies.withColumn("copy_no", F.explode(F.sequence(F.lit(1), F.col("n_copies"))))
    copies = copies.withColumn("shuffle_key", F.md5(F.concat_ws(":", F.lit(seed), F.lit("order"), F.col("_id"), F.col("copy_no"))))
    rest = [c for c in docs.columns if c not in ("copy_no", "n_copies", "shuffle_key")]
    out = copies.repartition(tasks(spark), "shuffle_key").sortWithinPartitions("shuffle_key")
    return out.select(*(F.col("row")[c].alias(c) for c in rest), "copy_no", "n_copies", "shuffle_key")


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op5_source_mixing": op5_source_mixing}
ORACLE_SQL = {
    "op5_source_mixing": """
        WITH RECURSIVE named AS (SELECT *, coalesce(doc_id::VARCHAR, 't' || md5(coalesce(text, ''))) AS name FROM documents),
        sizes AS (
            SELECT source, sum(length(coalesce(text, '')))::DOUBLE AS size FROM documents GROUP BY source),
        rated AS (
            SELECT source, CASE WHEN size > 0 THEN 1.0::DOUBLE * sum(size) OVER () * sqrt(size) / sum(sqrt(size)) OVER () / size ELSE 1.0 END AS rate
            FROM sizes),
        split AS (SELECT source, rate, greatest(1, ceil(rate / 100.0))::INT AS parts FROM rated),
        points AS (
            SELECT source, parts, rate / parts AS mean, 0 AS k, exp(-(rate / parts)) AS p, exp(-(rate / parts)) AS below FROM split
            UNION ALL
            SELECT source, parts, mean, k + 1, p * mean / (k + 1), below + p * mean / (k + 1)
            FROM points WHERE k < ceil(mean + 10 * sqrt(mean) + 20)),
        drawn AS (
            SELECT d.name, s.source, g.part,
                   ('0x' || substr(md5('17:' || d.name || ':' || g.part), 1, 12))::BIGINT::DOUBLE / 281474976710656.0 AS u
            FROM (SELECT DISTINCT name, source FROM named) d JOIN split s ON d.source IS NOT DISTINCT FROM s.source,
                 LATERAL (SELECT unnest(range(1, s.parts + 1)) AS part) g),
        counted AS (
            SELECT name, d.source, count(*)::INT AS n_copies
            FROM drawn d JOIN points p ON d.source IS NOT DISTINCT FROM p.source AND p.below <= d.u GROUP BY ALL)
        SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, c.copy_no::INT AS copy_no, n.n_copies,
               md5('17:order:' || d.name || ':' || c.copy_no) AS shuffle_key
        FROM named d JOIN counted n ON d.name = n.name AND d.source IS NOT DISTINCT FROM n.source,
             LATERAL (SELECT unnest(range(1, n.n_copies + 1)) AS copy_no) c
    """,
}
