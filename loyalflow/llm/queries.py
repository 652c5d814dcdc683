"""All queries of this subpackage and their DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loyalflow.llm import (
    bpe,
    conversation_repair,
    exact_dedup,
    hashed_neighbours,
    jaccard_join,
    language_id,
    license_scan,
    lm_scoring,
    prefix_trie,
    sentence_pieces,
    source_mixing,
    toxicity,
    warc,
)
from loyalflow.llm.shared import ship

Query = Callable[[SparkSession, str], DataFrame]


def _shipped(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


_MODULES = [
    license_scan, jaccard_join, lm_scoring, language_id, source_mixing, toxicity, hashed_neighbours, warc, bpe, exact_dedup, prefix_trie, sentence_pieces,
    conversation_repair,
]
QUERIES = {name: _shipped(f) for m in _MODULES for name, f in m.QUERIES.items()}
ORACLE_SQL = {name: sql for m in _MODULES for name, sql in m.ORACLE_SQL.items()}
