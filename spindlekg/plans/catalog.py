"""Where the registered queries and their SQL twins gather."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.scratch import materialize
from . import fixtures

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


class Source:
    """The tables and views of one scale factor."""

    def __init__(self, spark: SparkSession, sf_dir: str, written: dict[str, str] | None = None):
        self.spark, self.sf_dir, self._written = spark, sf_dir, written or {}

    def __call__(self, sql: str) -> DataFrame:
        return fixtures.frame(self.spark, self.sf_dir, sql, self._written)

    def written(self, view: str) -> Source:
        """The same source with a view as a table, for queries whose views read it more than once."""
        if view in self._written:
            return self
        (path,) = materialize(self(view)).inputFiles()[:1] or [None]
        return self if path is None else Source(self.spark, self.sf_dir, self._written | {view: f"SELECT * FROM parquet.`{path.rsplit('/', 1)[0]}`"})


def query(name: str, sql: str | None = None):
    """Register a function of a Source under a name, with the DuckDB text of the same result if there is one."""

    def add(f: Callable[[Source], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: f(Source(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = fixtures.oracle(sql)
        return f

    return add
