"""Answers of a model, kept by the digest of their prompt."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import shared_dir

SCHEMA = "digest string, response string, error string"


class ResponseStore:
    """An append-only Parquet table of answers, one store per model and template. Every batch of answers has a folder of
    its own, so writers do not meet, and a batch counts once it is complete. Of several rows of a digest an answer comes
    before an error, then the lesser one, so all readers see the same."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        """path: a folder that driver and executors share, or a new one in the scratch folder."""
        self.spark, self.path = spark, path or f"{shared_dir(spark)}/spindlekg/answers-{uuid.uuid4().hex}"
        spark.createDataFrame([], SCHEMA).write.mode("ignore").parquet(f"{self.path}/batch=0")

    def read(self) -> DataFrame:
        """digest, response, error: a row per digest, as the store is now."""
        rows = self.spark.read.schema(f"{SCHEMA}, batch string").parquet(self.path)
        first = F.min_by(F.struct("response", "error"), F.struct(F.col("error").isNotNull(), "response", "error", "batch"))
        return rows.groupBy("digest").agg(first.alias("a")).select("digest", "a.response", "a.error")

    def append(self, answers: DataFrame) -> None:
        answers.select("digest", "response", "error").write.parquet(f"{self.path}/batch={uuid.uuid4().hex}")
