"""Relations: linking entities to chunks, rules, prompts and answers, filters against what is known, strategies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.patterns import RELATION_PRIORITY, RELATION_PROPERTIES, RELATION_TREATMENTS, PropertyRule, TreatmentRule
from ..functions.rows import first_by, fresh, heavy_keys, spread_join
from ..functions.text import is_json, utrim
from ..sources.scratch import materialize
from .entities import dedup_records, fill_template, property_hits, strip_fences, treatment_hits

CHUNK = ("doc_id", "para_no", "chunk_no")
NO_ATTRIBUTES = "map<string, string>"


def link_entities_to_chunks(chunks: DataFrame, entities: DataFrame, min_entities: int = 2) -> DataFrame:
    """Entities with the chunks of their paragraph whose text holds them, for chunks with min_entities or more.

    Returns the chunk's keys and text, and each entity's text, type, attributes and seq (as entity_seq).
    """
    held = entities.where(F.coalesce(F.col("text"), F.lit("")) != "").select("doc_id", "para_no", "text", "type", *(["attributes"] if "attributes" in entities.columns else []), F.col("seq").alias("entity_seq"))
    pairs = chunks.select(*CHUNK, "chunk_text").join(held, ["doc_id", "para_no"]).where(F.contains("chunk_text", "text"))
    (n,) = fresh(pairs, "__n")
    counted = pairs.withColumn(n, F.count("*").over(Window.partitionBy(*CHUNK)))
    return counted.where(F.col(n) >= min_entities).drop(n)


def _relation(head: Column, tail: Column, kind: str, confidence: float) -> list[Column]:
    return [head.alias("head_entity_text"), tail.alias("tail_entity_text"), F.lit(kind).alias("relation_type"), F.lit(confidence).alias("confidence_score")]


def rule_property_relations(chunks: DataFrame, links: DataFrame, rules: Sequence[PropertyRule] = RELATION_PROPERTIES) -> DataFrame:
    """EXHIBITS_PROPERTY from an entity named as a property to each value of that property in its chunk."""
    hits = chunks.select(*CHUNK, "chunk_text", F.posexplode(property_hits(F.col("chunk_text"), rules)).alias("hit_no", "h"))
    hits = hits.select(*CHUNK, "chunk_text", "hit_no", F.col("h.name").alias("__name"), F.concat("h.value", "h.unit").alias("tail"))
    names = links.select(*CHUNK, "entity_seq", F.lower(utrim("text")).alias("__name"))
    joined = hits.join(names, [*CHUNK, "__name"])
    return joined.select(*CHUNK, *_relation(F.col("__name"), F.col("tail"), "EXHIBITS_PROPERTY", 0.9), F.col("chunk_text").alias("source_sentence"), "hit_no", "entity_seq")


def rule_treatment_relations(chunks: DataFrame, links: DataFrame, rules: Sequence[TreatmentRule] = RELATION_TREATMENTS) -> DataFrame:
    """UNDERGOES_TREATMENT from an entity to each treatment phrase of its chunk that holds it."""
    hits = chunks.select(*CHUNK, "chunk_text", F.posexplode(treatment_hits(F.col("chunk_text"), rules)).alias("hit_no", "tail"))
    names = links.select(*CHUNK, "entity_seq", F.lower(utrim("text")).alias("head")).where("head <> ''")
    joined = hits.join(names, [*CHUNK]).where(F.contains(F.lower("tail"), F.col("head")))
    return joined.select(*CHUNK, *_relation(F.col("head"), F.col("tail"), "UNDERGOES_TREATMENT", 0.85), F.col("chunk_text").alias("source_sentence"), "hit_no", "entity_seq")


def route_to_model(links: DataFrame, rule_relations: DataFrame) -> DataFrame:
    """Chunks with fewer rule relations than half their entities: keys, n_entities, n_relations."""
    entities = links.groupBy(*CHUNK).agg(F.count("*").alias("n_entities"))
    found = rule_relations.groupBy(*CHUNK).agg(F.count("*").alias("n"))
    joined = entities.join(found, [*CHUNK], "left").withColumn("n_relations", F.coalesce("n", F.lit(0))).drop("n")
    return joined.where(F.col("n_relations") < F.col("n_entities") / 2)


def build_re_prompts(chunks: DataFrame, links: DataFrame, template: str) -> DataFrame:
    """Chunks with linked entities, and `prompt`: their text and a list of `- text (type)` lines in the template."""
    line = F.concat(F.lit("- "), F.col("text"), F.lit(" ("), F.coalesce("type", F.lit("")), F.lit(")"))
    lists = links.groupBy(*CHUNK).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("entity_seq", line.alias("line")))), lambda x: x["line"]), "\n").alias("entities"))
    prompt = fill_template(template, {"text_segment": F.col("chunk_text"), "entities_list": F.col("entities")}, "Entities")
    return chunks.join(lists, [*CHUNK]).withColumn("prompt", prompt).drop("entities")


RELATION = "struct<head_entity_text: string, subject: string, head_entity_type: string, tail_entity_text: string, object: string, tail_entity_type: string, relation_type: string, attributes: map<string, string>, confidence_score: double>"


def parse_re_responses(answers: DataFrame, response_col: str = "response") -> DataFrame:
    """Answers to a row per relation: an array, or an object with `relations`; anything else gives none. subject and
    object stand in for missing head and tail texts."""
    text = strip_fences(F.col(response_col))
    rows = answers.withColumn("__json", F.when(is_json(text), text))
    array = F.from_json(F.col("__json"), f"array<{RELATION}>")
    keyed = F.from_json(F.get_json_object("__json", "$.relations"), f"array<{RELATION}>")
    found = F.when(F.col("__json").startswith("["), array).otherwise(keyed)
    rest = [c for c in answers.columns if c != response_col and c not in ("head_entity_text", "tail_entity_text", "relation_type", "seq")]
    rows = rows.select(*rest, F.posexplode(found).alias("seq", "r")).where("r IS NOT NULL")
    return rows.select(
        *rest,
        "seq",
        F.coalesce("r.head_entity_text", "r.subject").alias("head_entity_text"),
        F.col("r.head_entity_type").alias("head_entity_type"),
        F.coalesce("r.tail_entity_text", "r.object").alias("tail_entity_text"),
        F.col("r.tail_entity_type").alias("tail_entity_type"),
        F.col("r.relation_type").alias("relation_type"),
        F.coalesce("r.attributes", F.create_map().cast(NO_ATTRIBUTES)).alias("attributes"),
        F.col("r.confidence_score").alias("confidence_score"),
    )


def validate_relations(relations: DataFrame, links: DataFrame) -> DataFrame:
    """Relations of which both ends are linked entities of the chunk."""
    names = links.select(*CHUNK, F.col("text").alias("__text")).distinct()
    for side in ("head_entity_text", "tail_entity_text"):
        relations = relations.join(names.withColumnRenamed("__text", side), [*CHUNK, side], "left_semi")
    return relations


def drop_known_pairs(relations: DataFrame, known: DataFrame) -> DataFrame:
    """Relations whose chunk, head and tail are not among the known ones, whatever the type."""
    pairs = known.select(*CHUNK, "head_entity_text", "tail_entity_text").distinct()
    return relations.join(pairs, [*CHUNK, "head_entity_text", "tail_entity_text"], "left_anti")


def combine_relations(rule: DataFrame, model: DataFrame, scope: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Rule relations before the model's, then exact duplicates within a scope dropped; `rank` tells them apart."""
    every = rule.withColumn("rank", F.lit(0)).unionByName(model.withColumn("rank", F.lit(1)), allowMissingColumns=True)
    return dedup_records(every, scope, [c for c in ("rank", "chunk_no", "hit_no", "seq", "entity_seq") if c in every.columns])


#: A tile of a document's product has about so many texts on each side.
TILE = 128


def fallback_cross_relations(entities: DataFrame, relations: DataFrame, from_type: str = "HeatTreatmentProcess", to_type: str = "MechanicalProperty", relation_type: str = "EXHIBITS_PROPERTY", tile: int = TILE) -> DataFrame:
    """For documents with two entities or more and no relation: every different text of one type with every one of the
    other, from texts made different first.

    The product of a document is cut into tiles, by hashes of its texts, and a tile is a key of the equi-join: each text
    is sent once to each tile of the other side, one in `tile` of what the product has, and a document's pairs are made in
    as many tasks as it has tiles.
    """
    of = lambda kind: F.count(F.when(F.col("type") == kind, 1))
    docs = entities.groupBy("doc_id").agg(F.count("*").alias("n"), of(from_type).alias("n_from"), of(to_type).alias("n_to")).where("n > 1 AND n_from > 0 AND n_to > 0")
    tiles = [F.ceil(F.col(c) / tile).cast("int").alias(name) for c, name in (("n_from", "rows"), ("n_to", "columns"))]
    docs = materialize(docs.join(relations.select("doc_id").distinct(), "doc_id", "left_anti").select("doc_id", *tiles, (F.col("n_from") + F.col("n_to")).alias("weight")))
    heavy = heavy_keys(docs, "doc_id", "weight")

    def side(kind: str, name: str, own: str, other: str) -> DataFrame:
        texts = entities.where((F.col("type") == kind) & F.col("doc_id").isNotNull()).select("doc_id", F.col("text").alias(name)).distinct()
        placed = spread_join(texts, docs.select("doc_id", "rows", "columns"), "doc_id", heavy)
        number = {own: F.pmod(F.xxhash64(name), F.col(own)).cast("int").alias(f"{own}_at"), other: F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(f"{other}_at")}
        return placed.select("doc_id", name, *number.values())

    pairs = side(from_type, "head_entity_text", "rows", "columns").join(side(to_type, "tail_entity_text", "columns", "rows"), ["doc_id", "rows_at", "columns_at"])
    return pairs.select("doc_id", "head_entity_text", "tail_entity_text", F.lit(relation_type).alias("relation_type"), F.create_map(F.lit("source"), F.lit("rule")).alias("attributes"))


def resolve_multiple_relations(relations: DataFrame, strategy: str = "keep_all", priority: dict[str, int] | None = None, scope: Sequence[str] = ("doc_id",)) -> DataFrame:
    """keep_all: as they are; priority: of each pair in a scope the relation of best rank, the first by seq on a tie."""
    if strategy == "keep_all":
        return relations
    if strategy != "priority":
        raise ValueError(f"unknown strategy: {strategy}")
    order = priority or RELATION_PRIORITY
    rank = F.lit(99)
    for name, value in order.items():
        rank = F.when(F.col("relation_type") == name, value).otherwise(rank)
    return first_by(relations, [*scope, "head_entity_text", "tail_entity_text"], (rank, "seq"))


def tag_relation_source(relations: DataFrame, source: str) -> DataFrame:
    """relations with attribute `source` set, in place of any old one."""
    old = F.coalesce("attributes", F.create_map().cast(NO_ATTRIBUTES)) if "attributes" in relations.columns else F.create_map().cast(NO_ATTRIBUTES)
    return relations.withColumn("attributes", F.map_concat(F.map_filter(old, lambda k, v: k != "source"), F.create_map(F.lit("source"), F.lit(source))))
