"""All queries by name: importing this module registers them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import mart_queries, page_queries, search_queries, similarity_queries, star_queries, store_queries  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "flagship"]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["mart_group"](spark, sf_dir)
