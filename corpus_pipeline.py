"""A training corpus from raw documents, stage by stage; each stage takes what the one before it kept.

1. language_id: a document without a letter, or of which no language is likelier than not, goes; lang becomes the
   predicted language.
2. simhash_dedup: one document of each group of near duplicates stays (five-word shingles, similarity of 0.8 or more).
3. pii: personal data becomes pseudonyms; n_chars follows the text.
4. mixing: a document is repeated as often as its rate says, which may be never.
5. byte_bpe: every text is encoded; the ids are the result, with digests of them and of the bytes they decode to.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindlekg.llm import bpe, language_id, mixing, pii, queries, simhash
from spindlekg.llm.common import materialize
from spindlekg.sources.scratch import remove, scope

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
LEAST_SCORE = 0.5
#: Some of the result's columns cannot be had in SQL (posteriors, ids); see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language_id.fit(docs, queries.tokenizer_path("byte_bpe_multi_50k.tiktoken"))
    judged = language_id.predict(docs, model, F.col("text"), {c: F.col(c) for c in COLUMNS})
    kept = judged.where((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return kept.withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs.select(*COLUMNS))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = pii.pseudonymise(docs.select(*COLUMNS), queries.pseudonym_key(spark))
    return clean.withColumn("n_chars", F.length("text").cast("long"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*COLUMNS)
    model = mixing.fit(docs, queries.table(spark, sf_dir, "labels"), queries.labelled_domain())
    weighed = mixing.with_posteriors(docs, model, F.col("text"))
    moves = mixing.fit_rates(materialize(weighed.select("__tokens", "__p")), model, queries.TARGET_WEIGHTS)
    rated = weighed.withColumn("__rate", mixing.rate(moves))
    copies = mixing.copies(F.col("__rate"), F.col("doc_id"))
    return rated.select(*COLUMNS, F.explode(F.array_repeat(F.lit(0), copies.cast("int"))).alias("__copy")).select(*COLUMNS)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pattern = queries.splitting_pattern()
    keep = {c: F.col(c) for c in ("doc_id", "lang", "source")}
    return bpe.round_trip(docs, F.col("text"), queries.tokenizer_path("byte_bpe_multi_50k.tiktoken"), pattern, keep, keep_ids=True).drop("decoded")


STAGES = [("language_id", language_stage), ("simhash_dedup", dedup_stage), ("pii", pii_stage), ("mixing", mixing_stage), ("byte_bpe", bpe_stage)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written as a table and read again, as the next one's input. The tables
    that a stage made on its way go when its result is written."""
    docs, last = queries.table(spark, sf_dir, "documents"), len(STAGES) - 1
    for i, (_, stage) in enumerate(STAGES):
        with scope() as made:
            docs = stage(spark, docs, sf_dir)
        if i < last:
            docs = materialize(docs)
            remove(spark, made)
    return docs
