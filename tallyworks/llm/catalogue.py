"""The queries of this package by name, and the SQL for those that have one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyworks.llm import (
    bpe, collisions, lexical, licences, lines, mixing, ngrams, pii, pivots, quality, repeats, suffixes, tries,
)
from tallyworks.llm.shared import ship_package

Query = Callable[[SparkSession, str], DataFrame]


def _shipped(query: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship_package(spark)
        return query(spark, folder)

    return run


def queries() -> dict[str, Query]:
    found = {
        "op1_pii": pii.op1_pii,
        "op2_embedding_near_dedup": pivots.op2_embedding_near_dedup,
        "op3_nearest_neighbours": collisions.op3_nearest_neighbours,
        "op4_bpe": bpe.op4_bpe,
        "op5_substring_dedup": repeats.op5_substring_dedup,
        "op6_ngram_join": ngrams.op6_ngram_join,
        "op7_mixing": mixing.op7_mixing,
        "op8_licences": licences.op8_licences,
        "op9_quality": quality.op9_quality,
        "op10_suffix_dedup": suffixes.op10_suffix_dedup,
        "op11_lexical_search": lexical.op11_lexical_search,
        "op12_line_dedup": lines.op12_line_dedup,
        "op13_prefix_trie": tries.op13_prefix_trie,
    }
    return {name: _shipped(query) for name, query in found.items()}


def oracle_sql() -> dict[str, str]:
    return {
        "op7_mixing": mixing.mixing_sql(), "op8_licences": licences.licences_sql(),
        "op11_lexical_search": lexical.lexical_sql(), "op12_line_dedup": lines.lines_sql(),
        "op13_prefix_trie": tries.trie_sql(),
    }
