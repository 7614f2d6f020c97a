"""The scratch folder that driver and executors share, and tables cut into it."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_OWN_DIRS: dict[str, str] = {}
#: The list of the scope that this thread is in.
_SCOPE: ContextVar[list[str] | None] = ContextVar("scope", default=None)


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or a new local folder where that is unset and the session has one machine (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN_DIRS:
        _OWN_DIRS[app] = "file://" + tempfile.mkdtemp(prefix="spindlekg-")
    return _OWN_DIRS[app]


def _note(path: str) -> None:
    made = _SCOPE.get()
    if made is not None:
        made.append(path)


def materialize(df: DataFrame, most_rows: int = 0) -> DataFrame:
    """Write df as a table in the shared folder and read it back: cuts the lineage, and outlives any executor.

    most_rows: of a file, or 0 for any number. Tables stay until the shared folder is cleared, or the scope that they were made in is (see scope)."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/spindlekg/{uuid.uuid4().hex}"
    _note(path)
    df.write.option("compression", "zstd").option("maxRecordsPerFile", most_rows).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, *keys: str) -> DataFrame:
    """Like materialize, as an external table bucketed and sorted by the keys, so that groupings and joins by them need
    not shuffle it again. There are as many buckets as shuffle partitions; a key with a large share of all rows must have
    been taken out before."""
    spark = df.sparkSession
    name = f"spindlekg_{uuid.uuid4().hex}"
    path, n = f"{shared_dir(spark)}/spindlekg/{name}", int(spark.conf.get("spark.sql.shuffle.partitions"))
    _note(path)
    df.repartition(n, *keys).write.format("parquet").option("compression", "zstd").option("path", path).bucketBy(n, *keys).sortBy(*keys).saveAsTable(name)
    return spark.table(name)


@contextmanager
def scope() -> Iterator[list[str]]:
    """Within it, tables that this thread makes are noted in the list that it gives; remove them once what is made of them
    has been written."""
    made: list[str] = []
    before = _SCOPE.set(made)
    try:
        yield made
    finally:
        _SCOPE.reset(before)


def remove(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete folders, through the file system that Spark writes them by."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
