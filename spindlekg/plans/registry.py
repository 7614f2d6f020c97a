"""Every registered query of the graph library, by name, and the flagship."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import graph_queries, text_queries  # noqa: F401  they register their queries
from .catalog import ORACLES, QUERIES, Query


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["w1_corpus_to_graph"](spark, sf_dir)


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
