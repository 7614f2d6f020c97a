"""The graph: normalise and validate records, upsert nodes and edges by key, batches with history and rollback.

A graph is two tables. nodes: label, text, props, source_doc_id, batch_id, created_at, updated_at, keyed by (label,
text). edges: head_label, head_text, rel_type, tail_label, tail_text, props, source_doc_id, batch_id, created_at,
updated_at, keyed by the first five.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.patterns import ENTITY_TYPE_ALIASES, ENTITY_TYPES, RELATION_TYPE_ALIASES, RELATION_TYPES
from ..functions.rows import first_by, fresh
from ..functions.text import is_blank, lookup, one_of, overlay, without_keys
from ..sources.scratch import materialize

NODE = ("label", "text")
EDGE = ("head_label", "head_text", "rel_type", "tail_label", "tail_text")
RESERVED = ("text", "type", "label", "batch_id", "source_doc_id", "created_at", "updated_at", "relation_type", "head_entity_text", "tail_entity_text", "head_entity_type", "tail_entity_type", "attributes")
EMPTY = "map<string, string>"
#: What an import reads of entities and relations.
ENTITY_FIELDS = ("doc_id", "seq", "text", "type", "attributes")
RELATION_FIELDS = ("doc_id", "seq", "head_entity_text", "head_entity_type", "tail_entity_text", "tail_entity_type", "relation_type", "attributes", "subject", "object", "confidence_score", "source_sentence")


@dataclass(frozen=True)
class Graph:
    nodes: DataFrame
    edges: DataFrame


def standardize_entity_types(df: DataFrame, mapping: dict[str, str] | None = None) -> DataFrame:
    return df.withColumn("type", lookup(ENTITY_TYPE_ALIASES if mapping is None else mapping, F.col("type")))


def standardize_relation_types(df: DataFrame, mapping: dict[str, str] | None = None) -> DataFrame:
    return df.withColumn("relation_type", lookup(RELATION_TYPE_ALIASES if mapping is None else mapping, F.col("relation_type")))


def entity_error(types: Sequence[str] = ENTITY_TYPES) -> Column:
    """Why an entity cannot be imported, or null."""
    return F.when(is_blank(F.col("type")) | is_blank(F.col("text")), "missing type or text").when(~one_of(types, F.col("type")), "type not allowed")


def validate_entities(df: DataFrame, types: Sequence[str] = ENTITY_TYPES) -> tuple[DataFrame, DataFrame]:
    """(entities that can be imported, the others with `error`)."""
    tagged = df.withColumn("error", entity_error(types))
    return tagged.where("error IS NULL").drop("error"), tagged.where("error IS NOT NULL")


def validate_relations(df: DataFrame, types: Sequence[str] = RELATION_TYPES) -> DataFrame:
    """Relations with a type that is allowed and both ends; the others are dropped."""
    return df.where(one_of(types, F.col("relation_type")) & ~is_blank(F.col("head_entity_text")) & ~is_blank(F.col("tail_entity_text")))


def dedup_entities(df: DataFrame, scope: Sequence[str] = ("doc_id",), order: Sequence[str] = ("seq",)) -> DataFrame:
    """The first entity of each type and text in a scope."""
    return first_by(df, [*scope, "type", "text"], order)


def dedup_relations(df: DataFrame, scope: Sequence[str] = ("doc_id",), order: Sequence[str] = ("seq",)) -> DataFrame:
    """The first relation of each head, tail and type in a scope."""
    return first_by(df, [*scope, "head_entity_text", "tail_entity_text", "relation_type"], order)


def fill_endpoint_types(relations: DataFrame, entities: DataFrame, scope: Sequence[str] = ("doc_id",), default: str = "Entity") -> DataFrame:
    """Missing head and tail types from the last entity of that text in the scope, else the default."""
    (kind,) = fresh(relations, "__type")
    types = entities.groupBy(*scope, "text").agg(F.max_by("type", "seq").alias(kind))
    for side in ("head", "tail"):
        name = f"{side}_entity_type"
        if name not in relations.columns:
            relations = relations.withColumn(name, F.lit(None).cast("string"))
        found = types.select(*scope, F.col("text").alias(f"{side}_entity_text"), kind)
        relations = relations.join(found, [*scope, f"{side}_entity_text"], "left")
        relations = relations.withColumn(name, F.coalesce(F.nullif(name, F.lit("")), kind, F.lit(default))).drop(kind)
    return relations


def extract_relation_attributes(relations: DataFrame) -> DataFrame:
    """Attributes `temperature` and `time`, where absent: the first number with one unit character in the tail's and the
    head's text (a column `object` or `subject`, if present, in their place), without blanks."""
    side = lambda alias, name: F.coalesce(*[F.col(c) for c in (alias, name) if c in relations.columns], F.lit(""))
    text = F.concat(side("object", "tail_entity_text"), side("subject", "head_entity_text"))
    found = lambda pattern: F.nullif(F.replace(F.regexp_extract(text, pattern, 1), F.lit(" "), F.lit("")), F.lit(""))
    new = F.create_map(F.lit("temperature"), found(r"(?U)(\d+\s*[℃°C])"), F.lit("time"), found(r"(?U)(\d+\s*[hH小时min分])"))
    old = F.coalesce("attributes", F.create_map().cast(EMPTY)) if "attributes" in relations.columns else F.create_map().cast(EMPTY)
    added = F.map_filter(new, lambda k, v: v.isNotNull() & ~F.map_contains_key(old, k))
    return relations.withColumn("attributes", F.map_concat(old, added))


def flatten_attributes(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """df with `props`: the attributes over the fields named, without keys that records have of their own."""
    base = F.map_filter(F.create_map(*[x for f in fields for x in (F.lit(f), F.col(f).cast("string"))]), lambda k, v: v.isNotNull()) if fields else F.create_map().cast(EMPTY)
    attributes = F.coalesce("attributes", F.create_map().cast(EMPTY)) if "attributes" in df.columns else F.create_map().cast(EMPTY)
    own = without_keys(attributes, RESERVED)
    names = F.map_keys(own)
    return df.withColumn("props", F.map_concat(F.map_filter(base, lambda k, v: ~F.array_contains(names, k)), own))


def stamp_batch(df: DataFrame, batch_id: str | Column, doc_id: str | Column | None = None) -> DataFrame:
    """df with batch_id, and source_doc_id if a document is given."""
    as_column = lambda x: x if isinstance(x, Column) else F.lit(x)
    df = df.withColumn("batch_id", as_column(batch_id))
    return df if doc_id is None else df.withColumn("source_doc_id", as_column(doc_id))


def _reduce(new: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key from several: of each property the last value, as if the rows were imported one by one. The batch
    and document of a key's last row travel as one more property, without a name.

    Of a key's rows with the same names of properties only the last one counts, so only those are taken apart."""
    key, last, names, row = fresh(new, "__key", "__last", "__names", "__row")
    props = F.coalesce("props", F.create_map().cast(EMPTY))
    whole = F.struct(F.struct(*order).alias("at"), "batch_id", "source_doc_id", props.alias("props"))
    lasts = new.groupBy(*keys, F.array_sort(F.map_keys(props)).alias(names)).agg(F.max_by(whole, F.struct(*order)).alias(row))
    stamp = F.struct(F.lit(None).cast("string").alias("key"), F.lit(None).cast("string").alias("value"))
    listed = F.concat(F.map_entries(f"{row}.props"), F.array(stamp))
    entries = lasts.select(*keys, f"{row}.at", f"{row}.batch_id", f"{row}.source_doc_id", F.explode(listed).alias("e"))
    each = entries.groupBy(*keys, F.col("e.key").alias(key)).agg(F.max_by(F.struct("e.value", "batch_id", "source_doc_id"), "at").alias(last))
    named = F.when(F.col(key).isNotNull(), F.struct(F.col(key), F.col(f"{last}.value")))
    stamped = F.when(F.col(key).isNull(), F.struct(f"{last}.batch_id", f"{last}.source_doc_id"))
    found = each.groupBy(*keys).agg(F.map_from_entries(F.collect_list(named)).alias("props"), F.first(stamped, ignorenulls=True).alias(last))
    return found.select(*keys, "props", f"{last}.batch_id", f"{last}.source_doc_id")


def _upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], now: Column) -> DataFrame:
    a, b = old.alias("a"), new.withColumn("__new", F.lit(True)).alias("b")
    match = None
    for k in keys:
        same = F.col(f"a.{k}") == F.col(f"b.{k}")
        match = same if match is None else match & same
    touched = F.coalesce("b.__new", F.lit(False))
    empty = F.create_map().cast(EMPTY)
    props = F.when(touched, overlay(F.coalesce("a.props", empty), F.coalesce("b.props", empty))).otherwise(F.col("a.props"))
    return a.join(b, match, "full").select(
        *[F.coalesce(f"a.{k}", f"b.{k}").alias(k) for k in keys],
        props.alias("props"),
        F.when(touched, F.coalesce("b.source_doc_id", "a.source_doc_id")).otherwise(F.col("a.source_doc_id")).alias("source_doc_id"),
        F.when(touched, F.col("b.batch_id")).otherwise(F.col("a.batch_id")).alias("batch_id"),
        F.coalesce("a.created_at", now).alias("created_at"),
        F.when(touched, now).otherwise(F.col("a.updated_at")).alias("updated_at"),
    )


def upsert_nodes(nodes: DataFrame, new: DataFrame, now: Column, order: Sequence[str] = ("doc_id", "seq")) -> DataFrame:
    """nodes after the import of new (label, text, props, batch_id, source_doc_id and the order columns): new
    properties over old ones, null ones remove theirs, created_at stays."""
    return _upsert(nodes, _reduce(new, NODE, order), NODE, now)


def upsert_edges(edges: DataFrame, new: DataFrame, nodes: DataFrame, now: Column, order: Sequence[str] = ("doc_id", "seq")) -> DataFrame:
    """edges after the import of new; one of which an end is no node is left out."""
    return _upsert(edges, _reduce(with_endpoints(new, nodes), EDGE, order), EDGE, now)


def with_endpoints(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    keys = nodes.select(*NODE)
    for side in ("head", "tail"):
        edges = edges.join(keys.select(F.col("label").alias(f"{side}_label"), F.col("text").alias(f"{side}_text")), [f"{side}_label", f"{side}_text"], "left_semi")
    return edges


def empty_graph(spark) -> Graph:
    stamps = "props map<string, string>, source_doc_id string, batch_id string, created_at timestamp, updated_at timestamp"
    return Graph(spark.createDataFrame([], f"label string, text string, {stamps}"), spark.createDataFrame([], f"head_label string, head_text string, rel_type string, tail_label string, tail_text string, {stamps}"))


def prepare_entities(entities: DataFrame, types: Sequence[str] = ENTITY_TYPES) -> tuple[DataFrame, DataFrame]:
    """Standard types, then (valid entities, first of each document; rejected ones)."""
    good, bad = validate_entities(standardize_entity_types(entities), types)
    return dedup_entities(good), bad


def prepare_relations(relations: DataFrame, entities: DataFrame, types: Sequence[str] = RELATION_TYPES) -> DataFrame:
    good = validate_relations(standardize_relation_types(relations), types)
    return dedup_relations(extract_relation_attributes(fill_endpoint_types(good, entities)))


def as_nodes(entities: DataFrame) -> DataFrame:
    rows = flatten_attributes(entities, [])
    return rows.select(F.col("type").alias("label"), "text", "props", "doc_id", "seq")


def as_edges(relations: DataFrame) -> DataFrame:
    fields = [c for c in ("confidence_score", "source_sentence") if c in relations.columns]
    rows = flatten_attributes(relations, fields)
    return rows.select(F.col("head_entity_type").alias("head_label"), F.col("head_entity_text").alias("head_text"), F.col("relation_type").alias("rel_type"), F.col("tail_entity_type").alias("tail_label"), F.col("tail_entity_text").alias("tail_text"), "props", "doc_id", "seq")


@dataclass(frozen=True)
class Batch:
    """Records ready for import, as tables: entities and relations as given, valid and first of their kind, and rejected
    entities."""

    entities: DataFrame
    relations: DataFrame
    good: DataFrame
    bad: DataFrame
    kept: DataFrame


def prepare_batch(entities: DataFrame, relations: DataFrame) -> Batch:
    """Records that are used more than once are cut into tables, so that none is prepared twice; these have the columns that
    an import reads."""
    kept = lambda df, names: df.select(*[c for c in df.columns if c in names])
    good, bad = prepare_entities(kept(entities, ENTITY_FIELDS))
    good = materialize(good)
    return Batch(entities, relations, good, bad, materialize(prepare_relations(kept(relations, RELATION_FIELDS), good)))


def apply_batch(graph: Graph, batch: Batch, batch_id: str | Column, now: Column) -> tuple[Graph, DataFrame]:
    """The graph after the import of a batch, and the import's statistics."""
    source = F.col("doc_id").cast("string")
    nodes = materialize(upsert_nodes(graph.nodes, stamp_batch(as_nodes(batch.good), batch_id, source), now))
    new_edges = stamp_batch(as_edges(batch.kept), batch_id, source)
    edges = upsert_edges(graph.edges, new_edges, nodes, now)
    return Graph(nodes, edges), import_stats(batch.entities, batch.relations, batch.good, batch.bad, batch.kept, with_endpoints(new_edges, nodes))


def import_batch(graph: Graph, entities: DataFrame, relations: DataFrame, batch_id: str | Column, now: Column) -> tuple[Graph, DataFrame]:
    """The graph after an import, and its statistics (see import_stats)."""
    return apply_batch(graph, prepare_batch(entities, relations), batch_id, now)


def import_stats(entities: DataFrame, relations: DataFrame, good: DataFrame, bad: DataFrame, kept: DataFrame, placed: DataFrame) -> DataFrame:
    """One row: entities_processed, entities_upserted, entity_errors, relations_processed, relations_upserted,
    relations_orphaned, and status (skipped if nothing is valid, failed on entity errors, else completed)."""
    count = lambda df, name: df.agg(F.count("*").alias(name))
    parts = [(entities, "entities_processed"), (good, "entities_upserted"), (bad, "entity_errors"), (relations, "relations_processed"), (kept, "relations_kept"), (placed, "relations_upserted")]
    every = None
    for df, name in parts:
        one = count(df, "n").select(F.lit(name).alias("what"), "n")
        every = one if every is None else every.union(one)
    row = every.agg(*[F.max(F.when(F.col("what") == name, F.col("n"))).alias(name) for _, name in parts])
    status = F.when((F.col("entities_upserted") == 0) & (F.col("relations_kept") == 0), "skipped").when(F.col("entity_errors") > 0, "failed").otherwise("completed")
    return row.withColumn("relations_orphaned", F.col("relations_kept") - F.col("relations_upserted")).withColumn("status", status).drop("relations_kept")


def check_uniqueness(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that more than one row has, with `n`."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def rollback_batch(graph: Graph, batch_id: str) -> Graph:
    """The graph without the batch's nodes and edges, and without edges at a node that goes."""
    gone = F.col("batch_id").eqNullSafe(F.lit(batch_id))
    removed = graph.nodes.where(gone).select(*NODE)
    edges = graph.edges.where(~gone)
    for side in ("head", "tail"):
        edges = edges.join(removed.select(F.col("label").alias(f"{side}_label"), F.col("text").alias(f"{side}_text")), [f"{side}_label", f"{side}_text"], "left_anti")
    return Graph(graph.nodes.where(~gone), edges.select(*graph.edges.columns))


def rollback_report(before: Graph, after: Graph) -> DataFrame:
    """One row: nodes_removed, edges_removed."""
    counts = [(before.nodes, 1, 0), (after.nodes, -1, 0), (before.edges, 0, 1), (after.edges, 0, -1)]
    every = None
    for df, n, e in counts:
        one = df.agg((F.count("*") * n).alias("n"), (F.count("*") * e).alias("e"))
        every = one if every is None else every.union(one)
    return every.agg(F.sum("n").alias("nodes_removed"), F.sum("e").alias("edges_removed"))


def query_batch(graph: Graph, batch_id: str) -> Graph:
    mine = F.col("batch_id") == batch_id
    return Graph(graph.nodes.where(mine), graph.edges.where(mine))


HISTORY = ("batch_id", "operation", "status", "summary", "user_note", "doc_id", "stats", "created_at", "updated_at")


def record_batch(history: DataFrame, rows: DataFrame, now: Column) -> DataFrame:
    """history after rows (batch_id and any of its columns; at most one per batch): a null keeps what was there, created_at
    stays."""
    fields = [c for c in HISTORY if c not in ("batch_id", "created_at", "updated_at")]
    have = lambda df, side, c: F.col(f"{side}.{c}") if c in df.columns else F.lit(None).cast("string")
    a, b = history.alias("a"), rows.alias("b")
    new = F.col("b.batch_id").isNotNull()
    joined = a.join(b, F.col("a.batch_id") == F.col("b.batch_id"), "full")
    return joined.select(
        F.coalesce("a.batch_id", "b.batch_id").alias("batch_id"),
        *[F.coalesce(have(rows, "b", c), have(history, "a", c)).alias(c) for c in fields],
        F.coalesce("a.created_at", now).alias("created_at"),
        F.when(new, now).otherwise(have(history, "a", "updated_at") if "updated_at" in history.columns else F.col("a.created_at")).alias("updated_at"),
    )


def update_batch_status(history: DataFrame, batches: DataFrame, status: str, now: Column, stats: Column | None = None) -> DataFrame:
    """history with a new status for the batch ids in `batches`; operation, document, summary and statistics stay."""
    rows = batches.select("batch_id").distinct().withColumn("status", F.lit(status))
    return record_batch(history, rows if stats is None else rows.withColumn("stats", stats), now)


def batch_history(history: DataFrame, batch_id: str | None = None, doc_id: str | None = None, limit: int = 20) -> DataFrame:
    """The newest rows of a batch, else of a document, else of all; ties by batch id. A top-k, never a full sort."""
    if batch_id is not None:
        history = history.where(F.col("batch_id") == batch_id)
    elif doc_id is not None:
        history = history.where(F.col("doc_id") == doc_id)
    return history.orderBy(F.desc("created_at"), "batch_id").limit(limit)


def active_batches(history: DataFrame, doc_id: str | None = None, statuses: Sequence[str] = ("active", "completed")) -> DataFrame:
    """Active rows of a document, or the newest active row of every document."""
    active = history.where(F.col("status").isin(*statuses))
    if doc_id is not None:
        return active.where(F.col("doc_id") == doc_id).orderBy(F.desc("created_at"), "batch_id")
    newest = (F.col("created_at").isNull(), -F.unix_micros(F.col("created_at").cast("timestamp")), F.col("batch_id"))
    return first_by(active, ["doc_id"], newest)


def skip_existing_batches(new: DataFrame, history: DataFrame) -> DataFrame:
    return new.join(history.select("batch_id").distinct(), "batch_id", "left_anti")


def document_relations(nodes: DataFrame, edges: DataFrame, doc_id: str | Column) -> DataFrame:
    """Edges at a node, in either direction. nodes: id, label, text (name if present); edges: src, dst, rel_type.
    Returns doc, direction, rel_type, neighbour_id, neighbour_name, neighbour_label, from_name, to_name."""
    doc = doc_id if isinstance(doc_id, Column) else F.lit(doc_id)
    out = edges.where(F.col("src") == doc).select(F.col("src").alias("doc"), F.lit("out").alias("direction"), "rel_type", F.col("dst").alias("neighbour_id"))
    back = edges.where((F.col("dst") == doc) & (F.col("src") != F.col("dst"))).select(F.col("dst").alias("doc"), F.lit("in").alias("direction"), "rel_type", F.col("src").alias("neighbour_id"))
    named = [F.nullif(c, F.lit("")) for c in ("name", "text") if c in nodes.columns]
    ends = nodes.select(F.col("id").alias("neighbour_id"), F.coalesce(*named, F.col("id"), F.lit("未命名")).alias("neighbour_name"), F.col("label").alias("neighbour_label"))
    found = out.union(back).join(ends, "neighbour_id").dropDuplicates(["doc", "direction", "rel_type", "neighbour_id"])
    at_out = F.col("direction") == "out"
    return found.withColumn("from_name", F.when(at_out, F.col("doc")).otherwise(F.col("neighbour_name"))).withColumn("to_name", F.when(at_out, F.col("neighbour_name")).otherwise(F.col("doc")))
