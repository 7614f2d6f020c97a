"""Files in and out: document discovery, extraction tables, JSON exports, logs, summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rows import running_sum

ENTITY_SCHEMA = "text string, type string, attributes map<string, string>, source_text string"
RELATION_SCHEMA = "head_entity_text string, head_entity_type string, tail_entity_text string, tail_entity_type string, relation_type string, attributes map<string, string>, confidence_score double, source_sentence string"
#: Extraction tables are dealt into this many folders by a hash of the document.
BUCKETS = 64


def read_document_files(spark: SparkSession, path: str, glob: str = "*.pdf") -> DataFrame:
    """Every matching file below path: doc_id (the name without its extension), path, length, content."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    return files.select(F.regexp_replace(name, r"(?<=.)\.[^.]*$", "").alias("doc_id"), "path", "length", "content")


def write_extractions(df: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Write records with a doc_id, partitioned by a hash of it; only the partitions that df has are replaced. A folder
    with many rows is written by several tasks, by their size."""
    placed = df.withColumn("doc_bucket", F.pmod(F.xxhash64("doc_id"), F.lit(buckets)).cast("int"))
    placed.hint("rebalance", "doc_bucket").write.partitionBy("doc_bucket").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def read_extractions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("doc_bucket")


def read_json_records(spark: SparkSession, glob: str, schema: str, suffix: str = "") -> DataFrame:
    """JSON arrays of records, one file per document, gzipped or not; files that are no JSON are skipped. doc_id is the
    file's name without the suffix and extension."""
    wanted = f"{schema}, _corrupt_record string"
    rows = spark.read.schema(wanted).option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(glob)
    rows = rows.withColumn("doc_id", F.regexp_extract(F.input_file_name(), r"([^/]+?)" + suffix + r"\.[^./]*?(?:\.gz)?$", 1))
    return rows.where("_corrupt_record IS NULL").drop("_corrupt_record")


def read_error_logs(spark: SparkSession, glob: str) -> DataFrame:
    """file, line_no from 0, line, for every line of every log, blank ones too. A long log is read by many tasks: lines are
    numbered within each block of a file that one task reads, and the blocks' counts are added up per file."""
    lines = spark.read.option("lineSep", "\n").text(glob)
    # ids rise within a task, which reads the lines of a block one after the other
    rows = lines.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"), F.regexp_replace("value", r"\r\z", "").alias("line"))
    numbered = running_sum(rows, ["path"], "block", ["id"], F.lit(1), "n")
    return numbered.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file"), (F.col("n") - 1).cast("int").alias("line_no"), "line")


def read_kg_outputs(spark: SparkSession, path: str, entities: str = "*_entities.json", relations: str = "*_relations.json", logs: str = "error_*.log") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Entities, relations and log lines below a folder."""
    return (
        read_json_records(spark, f"{path}/{entities}", ENTITY_SCHEMA, "_entities"),
        read_json_records(spark, f"{path}/{relations}", RELATION_SCHEMA, "_relations"),
        read_error_logs(spark, f"{path}/{logs}"),
    )


def pending_documents(docs: DataFrame, done: DataFrame, force: bool = False) -> DataFrame:
    """Documents that are not among the done ones, or all of them if forced."""
    return docs if force else docs.join(done.select("doc_id").distinct(), "doc_id", "left_anti")


def write_summary(summary: DataFrame, path: str) -> None:
    """One JSON file for a summary of a row or a few."""
    summary.coalesce(1).write.mode("overwrite").json(path)
