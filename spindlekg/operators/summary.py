"""Counts and quality summaries. Every count is a hash aggregate that combines before it shuffles."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import utrim

UNKNOWN = "Unknown"


def entity_type_counts(entities: DataFrame) -> DataFrame:
    return entities.groupBy(F.coalesce("type", F.lit(UNKNOWN)).alias("type")).agg(F.count("*").alias("n"))


def relation_type_counts(relations: DataFrame) -> DataFrame:
    return relations.groupBy(F.coalesce("relation_type", F.lit(UNKNOWN)).alias("relation_type")).agg(F.count("*").alias("n"))


def error_type_counts(log: DataFrame) -> DataFrame:
    """Lines by their text before the first colon; blank lines count under ''."""
    return log.groupBy(utrim(F.split("line", ":", 2)[0]).alias("error")).agg(F.count("*").alias("n"))


def model_failures(log: DataFrame, k: int = 10, marks: tuple[str, ...] = ("LLM", "失败")) -> tuple[DataFrame, DataFrame]:
    """(one row with `n` failures of the model, the first k of them by file and line)."""
    hit = log
    for mark in marks:
        hit = hit.where(F.contains(F.col("line"), F.lit(mark)))
    return hit.agg(F.count("*").alias("n")), hit.orderBy("file", "line_no").limit(k)


def quality_warnings(entities: DataFrame, relations: DataFrame, failures: DataFrame, few_entities: int = 5, few_relations: int = 2, many: int = 10_000) -> DataFrame:
    """A row per warning: warning, n. failures: one row with n."""
    count = lambda df, name: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("what"), "n")
    counts = count(entities, "entities").union(count(relations, "relations")).union(failures.select(F.lit("failures").alias("what"), "n"))
    n = F.col("n")
    warning = (
        F.when((F.col("what") == "entities") & (n < few_entities), "too few entities")
        .when((F.col("what") == "entities") & (n > many), "too many entities")
        .when((F.col("what") == "relations") & (n < few_relations), "too few relations")
        .when((F.col("what") == "relations") & (n > many), "too many relations")
        .when((F.col("what") == "failures") & (n > 0), "model failures")
    )
    return counts.select(warning.alias("warning"), "n").where("warning IS NOT NULL")


def document_summary(docs: DataFrame, entities: DataFrame, relations: DataFrame) -> DataFrame:
    """Per document: doc_id, status, error (both as in docs, if it has them), entity_count, relation_count.

    A document without a status is Completed if it has entities, else Failed.
    """
    ents = entities.groupBy("doc_id").agg(F.count("*").alias("e"))
    rels = relations.groupBy("doc_id").agg(F.count("*").alias("r"))
    joined = docs.join(ents, "doc_id", "left").join(rels, "doc_id", "left")
    default = F.when(F.coalesce("e", F.lit(0)) > 0, "Completed").otherwise("Failed")
    status = F.coalesce("status", default) if "status" in docs.columns else default
    error = F.col("error") if "error" in docs.columns else F.lit(None).cast("string")
    return joined.select("doc_id", status.alias("status"), error.alias("error"), F.coalesce("e", F.lit(0)).alias("entity_count"), F.coalesce("r", F.lit(0)).alias("relation_count"))


def overall_summary(summary: DataFrame) -> DataFrame:
    """One row: total, completed, failed (every other status), entities, relations."""
    done = F.count_if(F.col("status") == "Completed")
    return summary.agg(F.count("*").alias("total"), done.alias("completed"), (F.count("*") - done).alias("failed"), F.coalesce(F.sum("entity_count"), F.lit(0)).alias("entities"), F.coalesce(F.sum("relation_count"), F.lit(0)).alias("relations"))


def top_kinds(counts: DataFrame, key: str, k: int) -> tuple[DataFrame, DataFrame]:
    """(the k kinds with the most rows, ties by name, as key and n; one row with `kinds` and `n` of all the others)."""
    kept = counts.orderBy(F.desc("n"), key).limit(k)
    size = lambda df, sign: df.agg((F.count("*") * sign).alias("kinds"), (F.coalesce(F.sum("n"), F.lit(0)) * sign).alias("n"))
    return kept, size(counts, 1).union(size(kept, -1)).agg(F.sum("kinds").alias("kinds"), F.sum("n").alias("n"))


#: How many kinds of a summary are joined to one text before texts are.
KINDS_AT_ONCE = 512


def _maps(counts: DataFrame, parts: Sequence[str]) -> DataFrame:
    """One row: a map of kind and n for each part."""
    held = lambda part: F.collect_list(F.when(F.col("part") == part, F.struct("kind", "n")))
    return counts.agg(*[F.map_from_entries(F.array_sort(held(p))).alias(p) for p in parts])


def _texts(counts: DataFrame, parts: Sequence[str]) -> DataFrame:
    """One row: the `kind=n` pairs of each part in the order of kinds, joined by `;`, null where there are none.

    Kinds are sorted and joined in many tasks, some hundreds at a time, so what meets in one task is the text alone. It is
    long: concat_ws sizes its result first, where array_join would grow it."""
    joined = lambda texts: F.concat_ws(";", F.transform(F.array_sort(F.collect_list(texts)), lambda x: x["text"]))
    order = counts.repartitionByRange("part", "kind").sortWithinPartitions("part", "kind").withColumn("at", F.monotonically_increasing_id())
    pairs = order.withColumn("text", F.concat("kind", F.lit("="), F.col("n").cast("string")))
    few = pairs.groupBy("part", F.floor(F.col("at") / KINDS_AT_ONCE).alias("stretch")).agg(joined(F.struct("at", "text")).alias("text"))
    of = lambda part: F.col("part") == part
    return few.agg(*[F.when(F.count_if(of(p)) > 0, joined(F.when(of(p), F.struct("stretch", "text")))).alias(p) for p in parts])


def kg_summary(entities: DataFrame, relations: DataFrame, log: DataFrame, k: int = 10, kinds: int | None = None, text: bool = False) -> DataFrame:
    """One record: maps of counts by entity type, relation type and error, the number of model failures and the first k.

    Each map holds every kind. A log may have as many errors as lines, and a map of them all is built in one task; with
    `text`, there are `kind=n;...` texts in place of maps, which take far less. The same counts are a row per kind in
    entity_type_counts, relation_type_counts and error_type_counts. With `kinds`, only so many of the most frequent are
    held, and the lines of all other errors are one number, other_errors (else 0)."""
    counts = {"entity_types": entity_type_counts(entities), "relation_types": relation_type_counts(relations), "errors": error_type_counts(log).where("error IS NOT NULL")}
    total, first = model_failures(log, k)
    samples = first.agg(F.transform(F.array_sort(F.collect_list(F.struct("file", "line_no", "line"))), lambda x: x["line"]).alias("failure_samples"))
    others = None
    if kinds is not None:
        others = top_kinds(counts["errors"], "error", kinds)[1].select(F.col("n").alias("other_errors"))
        counts = {part: top_kinds(df, df.columns[0], kinds)[0] for part, df in counts.items()}
    every = reduce(DataFrame.union, [df.select(F.lit(part).alias("part"), F.col(df.columns[0]).alias("kind"), "n") for part, df in counts.items()])
    held = (_texts if text else _maps)(every, list(counts))
    few = [total.withColumnRenamed("n", "model_failures"), samples]
    if others is None:
        held = held.withColumn("other_errors", F.lit(0).cast("long"))
    else:
        few.append(others)
    out = held.withColumn("__one", F.lit(1))
    for part in few:
        out = out.join(F.broadcast(part.withColumn("__one", F.lit(1))), "__one")  # one row each
    return out.drop("__one")
