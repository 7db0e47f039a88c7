"""Queries of this subpackage and their SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, covertree, language, lm, media, mixing, quality, simhash, substrings, token_files
from .common import ship

_QUERIES = {"op1_mixing": mixing.query, "op2_cover_tree": covertree.query, "op3_token_files": token_files.query, "op4_language_model": lm.query, "op5_language": language.query, "op6_bpe": bpe.query, "op7_simhash": simhash.query, "op8_quality": quality.query, "op9_media": media.query, "op10_substrings": substrings.query}


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _shipped(query) for name, query in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {"op1_mixing": mixing.ORACLE}
