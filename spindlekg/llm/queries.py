"""The registered query of each operator, with production parameters, over its whole table; and its SQL twin, if any."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat_format, ctph, divergence, html_extract, language_id, media, mixing, packing, pii, repair, simhash, url_filter
from .common import materialize

#: The session setting with the key of the pseudonyms, and what is taken where it is unset, as in tests.
PSEUDONYM_SETTING, PSEUDONYM_KEY = "spark.spindlekg.pseudonymKey", "registered queries"
#: Shares of all tokens that are wanted of each domain.
TARGET_WEIGHTS = {"good": 0.92, "poor": 0.06, "toxic": 0.02}

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(rows: DataFrame) -> DataFrame:
    """rows of a table over as many tasks as there are cores, where its files would give fewer: for work that costs much
    more than sending the rows. Larger tables have more splits than cores and are left as they are."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows if rows.rdd.getNumPartitions() >= cores else rows.repartition(cores)


def tokenizer_path(name: str) -> str:
    return importlib.import_module("public_tokenizers").path(name)


def splitting_pattern() -> str:
    return importlib.import_module("public_tokenizers").PATTERN


def pseudonym_key(spark: SparkSession) -> bytes:
    return spark.conf.get(PSEUDONYM_SETTING, PSEUDONYM_KEY).encode()


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = dealt(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    model = language_id.fit(docs.where(~held_out), tokenizer_path("byte_bpe_multi_50k.tiktoken"))
    return language_id.predict(docs, model, F.col("text"), {"doc_id": F.col("doc_id"), "held_out": held_out})


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), F.col("page_id"), F.col("url"))


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.sql(f"SELECT * FROM VALUES (-7L, 0L, 'user', '{said}'), (-7L, 1L, 'assistant', '{said}') AS t(conv_id, turn, role, text)")
    messages = chat_format.reconstruct(chat_format.streamed(rows.unionByName(more))).withColumn("position", F.col("position.turn"))
    return chat_format.digests(chat_format.read_back(chat_format.render(messages)))


def op4_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(dealt(table(spark, sf_dir, "pages")), F.col("html"), {"page_id": F.col("page_id"), "url": F.col("url")})


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = dealt(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return pii.pseudonymise(docs, pseudonym_key(spark), found_col="found")


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    pattern = splitting_pattern()
    return bpe.round_trip(dealt(table(spark, sf_dir, "documents").select("doc_id", "text")), F.col("text"), tokenizer_path("byte_bpe_multi_50k.tiktoken"), pattern, {"doc_id": F.col("doc_id")})


def labelled_domain() -> Column:
    """Domains of the labels table, by toxicity and quality."""
    return F.when(F.col("toxic") > 0, F.lit("toxic")).when(F.col("quality") > 0, F.lit("good")).when(F.col("quality") == 0, F.lit("poor"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = mixing.fit(docs, table(spark, sf_dir, "labels"), labelled_domain())
    weighed = materialize(mixing.with_posteriors(docs, model, F.col("text")).drop("text"))
    rated = weighed.withColumn("__rate", mixing.rate(mixing.fit_rates(weighed, model, TARGET_WEIGHTS)))
    shares = [F.get("__p", d).alias(f"p_{name}") for d, name in enumerate(model.domains)]
    return rated.select("doc_id", F.col("__tokens").alias("n_tokens"), *shares, F.col("__rate").alias("rate"), mixing.copies(F.col("__rate"), F.col("doc_id")).alias("copies"))


def op8_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.components(dealt(table(spark, sf_dir, "documents").select("doc_id", "text")), F.col("doc_id"), F.col("text"), size=3, radius=2)
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_ctph(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ctph.edited_neighbours(table(spark, sf_dir, "documents"), F.col("doc_id"), F.col("text"))
    return found.withColumnRenamed("id", "doc_id")


def op10_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = media.read_back(*media.store(dealt(table(spark, sf_dir, "documents").select("doc_id", "text")), F.col("doc_id"), F.col("text")))
    return found.select(F.col("id").alias("doc_id"), "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = dealt(table(spark, sf_dir, "documents").select("text", "lang", "source"))
    return divergence.audit(docs, F.col("text"), F.col("lang"), F.col("source"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = dealt(table(spark, sf_dir, "documents").select("doc_id", "text"))
    pieces = packing.pack(docs, F.col("doc_id"), F.col("text"), tokenizer_path("byte_bpe_50k.json"), splitting_pattern())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "tier", "step_group")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repair.audited(rows, repair.damage(rows))


def queries() -> dict[str, Query]:
    found = (op1_language_id, op2_url_filter, op3_chat_format, op4_html_extract, op5_pii, op6_byte_bpe, op7_mixing, op8_simhash_dedup, op9_ctph, op10_media_columns, op11_source_divergence, op12_packing, op13_conversation_repair)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op2_url_filter": url_filter.oracle(), "op3_chat_format": chat_format.oracle(), "op11_source_divergence": divergence.oracle()}
