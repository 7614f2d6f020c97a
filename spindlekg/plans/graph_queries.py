"""Registered queries: graph import and history, search, chains, summaries, files, streaming."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.text import map_text
from ..operators import chains, entities, graph, relations, search, summary
from ..sources import files, scratch, tables
from ..streaming.imports import stream_import
from .catalog import query
from ..functions.patterns import PROPERTIES, RELATION_PROPERTIES, RELATION_TREATMENTS
from .text_queries import PROCESS_ENTITIES, PROCESS_HITS, PROPERTY_HITS, TRIM, _property_lists, _rules, _treatment_lists

NOW, BEFORE = "TIMESTAMP '2024-01-02 00:00:00'", "TIMESTAMP '2024-01-01 00:00:00'"


def _at(text):
    return F.expr(text)


def _long(df, *names):
    return df.select(*[F.col(c).cast("long").alias(c) if c in names else c for c in df.columns])


# ---- normalise and validate

TYPE = "CASE type WHEN 'Alloy' THEN 'MaterialAlloy' WHEN '合金' THEN 'MaterialAlloy' WHEN '工艺' THEN 'HeatTreatmentProcess' WHEN '性能' THEN 'MechanicalProperty' WHEN '方法' THEN 'ResearchMethod' WHEN '试验' THEN 'ResearchMethod' WHEN '结构' THEN 'MicrostructureFeature' ELSE type END"
REL_TYPE = "CASE relation_type WHEN 'HAS_PROPERTY' THEN 'EXHIBITS_PROPERTY' WHEN 'TREATED_BY' THEN 'UNDERGOES_TREATMENT' WHEN 'INVESTIGATED' THEN 'INVESTIGATED_BY' ELSE relation_type END"
ALLOWED = "('MaterialAlloy', 'AlloyComponent', 'HeatTreatmentProcess', 'ResearchSubject', 'ResearchMethod', 'MechanicalProperty', 'MicrostructureFeature', 'Application', 'SourceDocument')"
ALLOWED_RELS = "('HAS_COMPONENT', 'EXHIBITS_PROPERTY', 'UNDERGOES_TREATMENT', 'INVESTIGATED_BY', 'HAS_MICROSTRUCTURE', 'HAS_APPLICATION', 'MENTIONED_IN')"
STANDARD = f"SELECT doc_id, seq, text, {TYPE} AS type FROM fx_entities"
ERROR = f"CASE WHEN trim(type) = '' OR trim(text) = '' THEN 'missing type or text' WHEN type NOT IN {ALLOWED} THEN 'type not allowed' END"
GOOD = f"SELECT doc_id, seq, text, type FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, type, text ORDER BY seq) AS nth FROM (SELECT * FROM ({STANDARD}) WHERE {ERROR} IS NULL)) WHERE nth = 1"
VALID_RELS = f"SELECT doc_id, seq, head_entity_text, tail_entity_text, {REL_TYPE} AS relation_type, object FROM fx_relations WHERE {REL_TYPE} IN {ALLOWED_RELS} AND head_entity_text <> '' AND tail_entity_text <> ''"
TYPES = f"SELECT doc_id, text, max_by(type, seq) AS type FROM ({GOOD}) GROUP BY doc_id, text"
TYPED = f"SELECT r.*, coalesce(h.type, 'Entity') AS head_entity_type, coalesce(t.type, 'Entity') AS tail_entity_type FROM ({VALID_RELS}) r LEFT JOIN ({TYPES}) h ON r.doc_id = h.doc_id AND r.head_entity_text = h.text LEFT JOIN ({TYPES}) t ON r.doc_id = t.doc_id AND r.tail_entity_text = t.text"
KEPT = f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, head_entity_text, tail_entity_text, relation_type ORDER BY seq) AS nth FROM ({TYPED})) WHERE nth = 1"


@query("g1_standardize_entity_types", STANDARD)
def _(t):
    return graph.standardize_entity_types(t("SELECT doc_id, seq, text, type FROM fx_entities"))


@query("g2_standardize_relation_types", f"SELECT doc_id, seq, {REL_TYPE} AS relation_type FROM fx_relations")
def _(t):
    return graph.standardize_relation_types(t("SELECT doc_id, seq, relation_type FROM fx_relations"))


@query("g3_validate_entities", f"SELECT doc_id, seq, text, type, {ERROR} AS error FROM ({STANDARD})")
def _(t):
    good, bad = graph.validate_entities(graph.standardize_entity_types(t("SELECT doc_id, seq, text, type FROM fx_entities")))
    return good.withColumn("error", F.lit(None).cast("string")).unionByName(bad)


@query("g3_validate_relations", f"SELECT doc_id, seq, head_entity_text, tail_entity_text, relation_type FROM ({VALID_RELS})")
def _(t):
    return graph.validate_relations(graph.standardize_relation_types(t("fx_relations"))).select("doc_id", "seq", "head_entity_text", "tail_entity_text", "relation_type")


@query("g4_dedup_entities", GOOD)
def _(t):
    return graph.prepare_entities(t("SELECT doc_id, seq, text, type FROM fx_entities"))[0]


@query("g5_fill_endpoint_types", f"SELECT doc_id, seq, head_entity_text, head_entity_type, tail_entity_text, tail_entity_type FROM ({TYPED})")
def _(t):
    good, _ = graph.prepare_entities(t("SELECT doc_id, seq, text, type FROM fx_entities"))
    rels = graph.validate_relations(graph.standardize_relation_types(t("fx_relations")))
    return graph.fill_endpoint_types(rels, good).select("doc_id", "seq", "head_entity_text", "head_entity_type", "tail_entity_text", "tail_entity_type")


ATTRIBUTES = r"concat('temperature=', replace(regexp_extract(object, '(\d+\s*[℃°C])', 1), ' ', ''), ';time=', replace(regexp_extract(object, '(\d+\s*[hH小时min分])', 1), ' ', ''))"


@query("g6_extract_relation_attributes", f"SELECT doc_id, seq, {ATTRIBUTES} AS attributes FROM fx_relations")
def _(t):
    return graph.extract_relation_attributes(t("fx_relations")).select("doc_id", "seq", map_text(F.col("attributes")).alias("attributes"))


@query("g7_dedup_relations", f"SELECT doc_id, seq, head_entity_text, head_entity_type, tail_entity_text, tail_entity_type, relation_type FROM ({KEPT})")
def _(t):
    good, _ = graph.prepare_entities(t("SELECT doc_id, seq, text, type FROM fx_entities"))
    return graph.prepare_relations(t("fx_relations"), good).select("doc_id", "seq", "head_entity_text", "head_entity_type", "tail_entity_text", "tail_entity_type", "relation_type")


@query("g8_flatten_attributes", "SELECT doc_id, seq, concat('qty=', CAST(qty AS VARCHAR), ';sk=9') AS props FROM fx_rows")
def _(t):
    rows = t("SELECT doc_id, seq, qty, sk FROM fx_rows").withColumn("attributes", F.create_map(F.lit("sk"), F.lit("9"), F.lit("text"), F.lit("x")))
    return graph.flatten_attributes(rows, ["qty", "sk"]).select("doc_id", "seq", map_text(F.col("props")).alias("props"))


@query("g9_stamp_batch", "SELECT doc_id, seq, 'batch_1' AS batch_id, CAST(doc_id AS VARCHAR) AS source_doc_id FROM fx_entities")
def _(t):
    return graph.stamp_batch(t("SELECT doc_id, seq FROM fx_entities"), "batch_1", F.col("doc_id").cast("string"))


# ---- upserts

ENTITY_ROWS = "SELECT doc_id, seq, text, type, map('n', CAST(seq AS STRING), CASE WHEN seq % 2 = 0 THEN 'even' ELSE 'odd' END, CAST(doc_id AS STRING)) AS attributes FROM fx_entities"


def _graphs(t, edges=True):
    """The graph of the even documents, and after the odd ones. edges: whether the edges are read, too."""
    t = t.written("fx_rows")
    ents, rels = scratch.materialize(t(ENTITY_ROWS)), scratch.materialize(t("fx_relations"))  # each is read several times
    part = lambda df, odd: df.where(F.col("doc_id") % 2 == odd)
    old, _ = graph.import_batch(graph.empty_graph(t.spark), part(ents, 0), part(rels, 0), "old", _at(BEFORE))
    if edges:
        old = graph.Graph(old.nodes, scratch.materialize(old.edges))  # as a graph is kept between imports
    new, stats = graph.import_batch(old, part(ents, 1), part(rels, 1), "new", _at(NOW))
    return old, new, stats


LAST = "SELECT type AS label, text, max_by(doc_id, (doc_id, seq)) FILTER (doc_id % 2 = 1) AS new_doc, max_by(doc_id, (doc_id, seq)) FILTER (doc_id % 2 = 0) AS old_doc, max_by(seq, (doc_id, seq)) FILTER (doc_id % 2 = 1) AS new_n, max_by(seq, (doc_id, seq)) FILTER (doc_id % 2 = 0) AS old_n, max_by(doc_id, (doc_id, seq)) FILTER (doc_id % 2 = 1 AND seq % 2 = 0) AS new_even, max_by(doc_id, (doc_id, seq)) FILTER (doc_id % 2 = 0 AND seq % 2 = 0) AS old_even, max_by(doc_id, (doc_id, seq)) FILTER (doc_id % 2 = 1 AND seq % 2 = 1) AS new_odd, max_by(doc_id, (doc_id, seq)) FILTER (doc_id % 2 = 0 AND seq % 2 = 1) AS old_odd FROM ({good}) GROUP BY type, text"
NODES = f"SELECT label, text, concat_ws(';', 'even=' || CAST(coalesce(new_even, old_even) AS VARCHAR), 'n=' || CAST(coalesce(new_n, old_n) AS VARCHAR), 'odd=' || CAST(coalesce(new_odd, old_odd) AS VARCHAR)) AS props, CAST(coalesce(new_doc, old_doc) AS VARCHAR) AS source_doc_id, CASE WHEN new_doc IS NULL THEN 'old' ELSE 'new' END AS batch_id, CASE WHEN old_doc IS NULL THEN {NOW} ELSE {BEFORE} END AS created_at, CASE WHEN new_doc IS NULL THEN {BEFORE} ELSE {NOW} END AS updated_at FROM ({LAST.format(good=GOOD)})"


@query("g10_upsert_nodes", NODES)
def _(t):
    return _graphs(t, edges=False)[1].nodes.withColumn("props", map_text(F.col("props"))).select("label", "text", "props", "source_doc_id", "batch_id", "created_at", "updated_at")


def _placed(parity: str) -> str:
    """Kept relations of which both ends are nodes once that half is imported."""
    known = "" if parity == "new" else " WHERE doc_id % 2 = 0"
    nodes = f"SELECT DISTINCT type, text FROM ({GOOD}){known}"
    half = "1" if parity == "new" else "0"
    return f"SELECT k.* FROM ({KEPT}) k JOIN ({nodes}) h ON k.head_entity_type = h.type AND k.head_entity_text = h.text JOIN ({nodes}) t ON k.tail_entity_type = t.type AND k.tail_entity_text = t.text WHERE k.doc_id % 2 = {half}"


EDGE_KEYS = "head_entity_type AS head_label, head_entity_text AS head_text, relation_type AS rel_type, tail_entity_type AS tail_label, tail_entity_text AS tail_text"
EDGES = f"SELECT head_label, head_text, rel_type, tail_label, tail_text, CASE WHEN bool_or(new) THEN 'new' ELSE 'old' END AS batch_id, CAST(CASE WHEN bool_or(new) THEN max(doc_id) FILTER (new) ELSE max(doc_id) END AS VARCHAR) AS source_doc_id, CASE WHEN bool_or(NOT new) THEN {BEFORE} ELSE {NOW} END AS created_at FROM (SELECT {EDGE_KEYS}, doc_id, true AS new FROM ({_placed('new')}) UNION ALL SELECT {EDGE_KEYS}, doc_id, false FROM ({_placed('old')})) GROUP BY head_label, head_text, rel_type, tail_label, tail_text"
EDGE_COLUMNS = ("head_label", "head_text", "rel_type", "tail_label", "tail_text", "batch_id", "source_doc_id", "created_at")


@query("g11_upsert_edges", EDGES)
def _(t):
    return _graphs(t)[1].edges.select(*EDGE_COLUMNS)


@query("g12_import_stats", f"WITH e AS (SELECT * FROM ({STANDARD}) WHERE doc_id % 2 = 1) SELECT (SELECT count(*) FROM e) AS entities_processed, (SELECT count(*) FROM ({GOOD}) WHERE doc_id % 2 = 1) AS entities_upserted, (SELECT count(*) FROM e WHERE {ERROR} IS NOT NULL) AS entity_errors, (SELECT count(*) FROM fx_relations WHERE doc_id % 2 = 1) AS relations_processed, (SELECT count(*) FROM ({_placed('new')})) AS relations_upserted, (SELECT count(*) FROM ({KEPT}) WHERE doc_id % 2 = 1) - (SELECT count(*) FROM ({_placed('new')})) AS relations_orphaned, 'failed' AS status")
def _(t):
    return _graphs(t)[2]


@query("g13_check_uniqueness", f"SELECT type, text, count(*) AS n FROM ({STANDARD}) GROUP BY type, text HAVING count(*) > 1")
def _(t):
    return graph.check_uniqueness(graph.standardize_entity_types(t("fx_entities")), ["type", "text"])


@query("g14_rollback_batch", f"WITH n AS ({NODES}), e AS ({EDGES}), gone AS (SELECT label, text FROM n WHERE batch_id = 'new') SELECT 'node' AS what, count(*) AS n FROM n WHERE batch_id = 'old' UNION ALL SELECT 'edge', count(*) FROM e WHERE batch_id = 'old' AND (head_label, head_text) NOT IN (SELECT (label, text) FROM gone) AND (tail_label, tail_text) NOT IN (SELECT (label, text) FROM gone)")
def _(t):
    left = graph.rollback_batch(_graphs(t)[1], "new")
    return left.nodes.agg(F.count("*").alias("n")).select(F.lit("node").alias("what"), "n").union(left.edges.agg(F.count("*").alias("n")).select(F.lit("edge"), "n"))


@query("g15_query_batch", f"SELECT 'node' AS what, label AS a, text AS b FROM ({NODES}) WHERE batch_id = 'old' UNION ALL SELECT 'edge', head_text, tail_text FROM ({EDGES}) WHERE batch_id = 'old'")
def _(t):
    mine = graph.query_batch(_graphs(t)[1], "old")
    return mine.nodes.select(F.lit("node").alias("what"), F.col("label").alias("a"), F.col("text").alias("b")).union(mine.edges.select(F.lit("edge"), "head_text", "tail_text"))


# ---- history


@query("g16_record_batch", f"SELECT batch_id, CASE WHEN status = 'active' THEN 'completed' ELSE status END AS status, doc_id, created_at, CASE WHEN status = 'active' THEN {NOW} ELSE created_at END AS updated_at FROM fx_history UNION ALL SELECT concat('again_', batch_id), 'completed', NULL, {NOW}, {NOW} FROM fx_history WHERE status = 'active'")
def _(t):
    history = t("fx_history")
    active = history.where("status = 'active'").select("batch_id", F.lit("completed").alias("status"))
    rows = active.union(active.select(F.concat(F.lit("again_"), "batch_id"), "status"))
    return graph.record_batch(history, rows, _at(NOW)).select("batch_id", "status", "doc_id", "created_at", "updated_at")


@query("g16_update_batch_status", "SELECT batch_id, CASE WHEN status = 'failed' THEN 'deleted' ELSE status END AS status, doc_id FROM fx_history")
def _(t):
    history = t("fx_history")
    return graph.update_batch_status(history, history.where("status = 'failed'"), "deleted", _at(NOW)).select("batch_id", "status", "doc_id")


@query("g17_batch_history", "SELECT * FROM fx_history ORDER BY created_at DESC, batch_id LIMIT 20")
def _(t):
    return graph.batch_history(t("fx_history"))


@query("g17_history_of_a_batch", "SELECT * FROM fx_history WHERE batch_id = 'batch_7'")
def _(t):
    return graph.batch_history(t("fx_history"), batch_id="batch_7")


@query("g17_history_of_a_document", "SELECT * FROM fx_history WHERE doc_id = (SELECT min(doc_id) FROM fx_history) ORDER BY created_at DESC, batch_id LIMIT 20")
def _(t):
    first = t("SELECT min(doc_id) AS doc_id FROM fx_history").first()["doc_id"]
    return graph.batch_history(t("fx_history"), doc_id=first)


@query("g18_active_batches", "SELECT batch_id, doc_id, status, created_at FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY created_at DESC, batch_id) AS nth FROM fx_history WHERE status IN ('active', 'completed')) WHERE nth = 1")
def _(t):
    return graph.active_batches(t("fx_history"))


@query("g19_skip_existing_batches", "SELECT * FROM fx_history WHERE status <> 'failed'")
def _(t):
    return graph.skip_existing_batches(t("fx_history"), t("SELECT * FROM fx_history WHERE status = 'failed'")).select("batch_id", "doc_id", "status", "created_at")


@query("g20_document_relations", "SELECT 'N3' AS doc, direction, rel_type, n.id AS neighbour_id, n.text AS neighbour_name, n.label AS neighbour_label, CASE WHEN direction = 'out' THEN 'N3' ELSE n.text END AS from_name, CASE WHEN direction = 'out' THEN n.text ELSE 'N3' END AS to_name FROM (SELECT DISTINCT 'out' AS direction, rel_type, dst AS other FROM fx_edges WHERE src = 'N3' UNION SELECT DISTINCT 'in', rel_type, src FROM fx_edges WHERE dst = 'N3') e JOIN fx_nodes n ON e.other = n.id")
def _(t):
    return graph.document_relations(t("fx_nodes"), t("fx_edges"), "N3")


# ---- search

SEEDS = "SELECT id FROM fx_nodes WHERE contains(lower(text), 'nation_1')"
STEP = "SELECT e.dst AS id FROM fx_edges e JOIN ({0}) s ON e.src = s.id UNION SELECT e.src FROM fx_edges e JOIN ({0}) s ON e.dst = s.id"
HOP1 = f"SELECT id, min(dist) AS dist FROM (SELECT id, 0 AS dist FROM ({SEEDS}) UNION ALL SELECT id, 1 FROM ({STEP.format(SEEDS)})) GROUP BY id"
HOP2 = f"SELECT id, min(dist) AS dist FROM (SELECT id, dist FROM ({HOP1}) UNION ALL SELECT id, 2 FROM ({STEP.format(f'SELECT id FROM ({HOP1}) WHERE dist = 1')})) GROUP BY id"
NEAR_EDGES = f"SELECT DISTINCT src, dst, rel_type FROM fx_edges WHERE src IN (SELECT id FROM ({HOP1})) OR dst IN (SELECT id FROM ({HOP1}))"


def _seeds(t):
    return search.search_nodes(t("fx_nodes"), "NATION_1")


@query("q1_search_nodes", "SELECT * FROM fx_nodes WHERE contains(lower(text), 'nation_1')")
def _(t):
    return _seeds(t)


NAMED = "SELECT id, label, CASE WHEN id LIKE 'N%' THEN text END AS name_zh, CASE WHEN id LIKE 'R%' THEN concat('Region of ', text) END AS name_en, CASE WHEN id LIKE 'S%' THEN concat('supplies nation_1, ', text) END AS description_zh, CASE WHEN id LIKE 'C%' THEN text END AS text FROM fx_nodes"


@query("q1_search_nodes_by_name", f"SELECT id, label FROM ({NAMED}) WHERE contains(lower(coalesce(name_zh, '')), 'nation_1') OR contains(lower(coalesce(name_en, '')), 'nation_1') OR contains(lower(coalesce(description_zh, '')), 'nation_1') OR contains(lower(coalesce(text, '')), 'nation_1')")
def _(t):
    """Nodes with names in two languages and a description, each of which a keyword may be in."""
    return search.search_nodes(t(NAMED), "NATION_1").select("id", "label")


@query("q2_kept_adjacency", f"SELECT h.id, CAST(h.dist AS BIGINT) AS dist, 'first' AS search FROM ({HOP2}) h UNION ALL SELECT id, CAST(dist AS BIGINT), 'second' FROM ({HOP1.replace('nation_1', 'nation_2')})")
def _(t):
    """Two searches on the adjacency that is written once."""
    near = search.adjacency(t("fx_edges"))
    one = search.distances(t("fx_edges"), _seeds(t), 2, near).withColumn("search", F.lit("first"))
    two = search.distances(t("fx_edges"), search.search_nodes(t("fx_nodes"), "nation_2"), 1, near).withColumn("search", F.lit("second"))
    return _long(one.union(two), "dist")


@query("q2_expand_khop", f"SELECT n.id, n.label, n.text, CAST(h.dist AS BIGINT) AS dist FROM fx_nodes n JOIN ({HOP2}) h ON n.id = h.id")
def _(t):
    return _long(search.expand_khop(t("fx_nodes"), t("fx_edges"), _seeds(t), 2)[0].select("id", "label", "text", "dist"), "dist")


@query("q2_expand_khop_edges", NEAR_EDGES)
def _(t):
    return search.expand_khop(t("fx_nodes"), t("fx_edges"), _seeds(t), 2)[1]


@query("q3_extract_subgraph", f"SELECT * FROM ({NEAR_EDGES}) WHERE src IN (SELECT id FROM ({HOP2})) AND dst IN (SELECT id FROM ({HOP2})) AND src IN (SELECT id FROM fx_nodes) AND dst IN (SELECT id FROM fx_nodes)")
def _(t):
    return search.extract_subgraph(t("fx_nodes"), t("fx_edges"), _seeds(t), 2)[1].select("src", "dst", "rel_type")


@query("q4_display_table", "SELECT id, CASE WHEN length(text) > 50 THEN left(text, 50) || '...' ELSE text END AS caption, label AS main_label, CASE label WHEN 'MaterialAlloy' THEN '#add8e6' WHEN 'ResearchMethod' THEN '#dda0dd' WHEN 'Application' THEN '#ff7f50' ELSE '#ffcc99' END AS colour FROM fx_nodes")
def _(t):
    return search.display_table(t("fx_nodes"))


# ---- chains

STAGES = (("composition", "List the composition. ", 1000), ("process", "List the processes. ", 1200), ("chain", "List the order. ", 1200), ("properties", "List the properties. ", 1200))


@query("p1_stage_prompts", "SELECT doc_id, stage, instruction || '正文：' || chr(10) || substring(text, 1, n) || chr(10) AS prompt FROM documents CROSS JOIN (VALUES " + ", ".join(f"('{a}', '{b}', {c})" for a, b, c in STAGES) + ") s(stage, instruction, n)")
def _(t):
    stages = t.spark.createDataFrame(list(STAGES), "stage string, instruction string, n_chars int")
    return chains.stage_prompts(t("SELECT doc_id, text FROM documents"), stages)


@query("p1_stage_prompts_with_tables", """WITH cells AS (SELECT doc_id, seq, (seq - 1) // 2 AS table_no, (seq - 1) % 2 AS row_no, name || chr(9) || value AS line FROM fx_chain_comp),
bodies AS (SELECT doc_id, table_no, string_agg(line || chr(10), '' ORDER BY row_no) AS body FROM cells GROUP BY doc_id, table_no),
tables AS (SELECT doc_id, string_agg(chr(10) || '表格' || CAST(table_no AS VARCHAR) || ':' || chr(10) || body, '' ORDER BY table_no) AS tables FROM bodies GROUP BY doc_id)
SELECT d.doc_id, 'composition' AS stage, 'List. 正文：' || chr(10) || substring(text, 1, 500) || chr(10) || coalesce(tables, '') AS prompt FROM documents d LEFT JOIN tables USING (doc_id)""")
def _(t):
    """The composition of a document as its tables, of two rows each."""
    stages = t.spark.createDataFrame([("composition", "List. ", 500)], "stage string, instruction string, n_chars int")
    cells = t("SELECT doc_id, CAST(floor((seq - 1) / 2) AS BIGINT) AS table_no, (seq - 1) % 2 AS row_no, array(name, value) AS cells FROM fx_chain_comp")
    return chains.stage_prompts(t("SELECT doc_id, text FROM documents"), stages, cells)


@query("p2_normalize_responses", "SELECT r.doc_id, r.seq, c.name, CASE WHEN r.pk % 5 = 4 THEN NULL ELSE c.value END AS value FROM fx_rows r JOIN fx_chain_comp c ON r.doc_id = c.doc_id AND r.seq = c.seq WHERE r.pk % 5 <> 3")
def _(t):
    items = chains.normalize_responses(t("fx_stage_responses"), ["composition", "alloy_compositions"])
    return chains.item_fields(items).select("doc_id", "seq", "name", "value")


ORDER_KEY = "coalesce(TRY_CAST(step AS INTEGER), CASE name WHEN 'solution treatment' THEN 1 WHEN 'water quench' THEN 2 WHEN '双级时效' THEN 3 WHEN 'annealing' THEN 3 WHEN '均匀化' THEN 0 WHEN '淬火' THEN 2 END, 999)"
STEPS = f"SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY order_key, seq) AS position FROM (SELECT *, {ORDER_KEY} AS order_key FROM fx_steps)"


@query("p3_infer_process_order", f"SELECT doc_id, seq, name, CAST(order_key AS BIGINT) AS order_key, position FROM ({STEPS})")
def _(t):
    return _long(chains.infer_process_order(t("fx_steps")).select("doc_id", "seq", "name", "order_key", "position"), "order_key", "position")


LABEL = "CASE WHEN value <> '' THEN name || chr(10) || value ELSE name END"
CHAIN_NODES = f"SELECT doc_id, node, arg_max(kind, (part, seq)) AS kind, arg_max(details, (part, seq)) AS details FROM (SELECT doc_id, '合金成分' AS node, 'composition' AS kind, string_agg(name || ': ' || value, chr(10) ORDER BY seq) AS details, 0 AS part, 0 AS seq FROM fx_chain_comp GROUP BY doc_id UNION ALL SELECT doc_id, name, 'process', parameters, 1, seq FROM fx_steps UNION ALL SELECT doc_id, {LABEL}, 'property', value, 2, seq FROM fx_chain_props) GROUP BY doc_id, node"


def _chain_nodes(t):
    return chains.chain_nodes(t("fx_chain_comp"), t("fx_steps"), t("fx_chain_props"))


@query("p4_chain_nodes", CHAIN_NODES)
def _(t):
    return _chain_nodes(t)


@query("p5_chain_edges", f"""WITH nodes AS ({CHAIN_NODES}), steps AS ({STEPS}), free AS (SELECT *, lead(name) OVER (PARTITION BY doc_id ORDER BY position) AS next, count(*) OVER (PARTITION BY doc_id) AS n FROM steps WHERE doc_id NOT IN (SELECT doc_id FROM fx_chain_rels)),
every AS (SELECT g.doc_id, from_name AS src, to_name AS dst, coalesce(g.type, '影响') AS relationship, 0 AS part, g.seq FROM fx_chain_rels g JOIN nodes a ON a.doc_id = g.doc_id AND a.node = g.from_name JOIN nodes b ON b.doc_id = g.doc_id AND b.node = g.to_name
UNION ALL SELECT doc_id, '合金成分', name, '原材料', 1, 0 FROM free WHERE position = 1 AND doc_id IN (SELECT doc_id FROM fx_chain_comp)
UNION ALL SELECT doc_id, name, next, '工艺流程', 2, position FROM free WHERE position < n
UNION ALL SELECT f.doc_id, f.name, CASE WHEN p.value <> '' THEN p.name || chr(10) || p.value ELSE p.name END, '影响', 3, p.seq FROM free f JOIN fx_chain_props p ON f.doc_id = p.doc_id WHERE f.position = f.n)
SELECT doc_id, src, dst, arg_max(relationship, (part, seq)) AS relationship FROM every GROUP BY doc_id, src, dst""")
def _(t):
    return chains.chain_edges(t("fx_chain_comp"), chains.infer_process_order(t("fx_steps")), t("fx_chain_props"), t("fx_chain_rels"), _chain_nodes(t))


CONDITIONS = r"SELECT doc_id, seq, TRY_CAST(nullif(regexp_extract(parameters, '(\d+)[ ]*[°℃C]+', 1), '') AS BIGINT) AS temp, TRY_CAST(nullif(regexp_extract(parameters, '(?i)(\d+)[ ]*(min|分钟|h|小时)', 1), '') AS BIGINT) AS time, nullif(regexp_extract(parameters, '(?i)(\d+)[ ]*(min|分钟|h|小时)', 2), '') AS time_unit FROM fx_steps"


@query("p6_extract_conditions", CONDITIONS)
def _(t):
    return chains.extract_conditions(t("fx_steps"), "parameters").select("doc_id", "seq", "temp", "time", "time_unit")


@query("p7_nearest_conditions", """WITH k AS (SELECT temp, time, min(id) AS right_id FROM fx_conditions WHERE half = 0 GROUP BY temp, time), a AS (SELECT DISTINCT temp, time FROM fx_conditions WHERE half = 1),
d AS (SELECT a.temp, a.time, k.right_id, CASE WHEN coalesce(a.temp, a.time) IS NULL OR coalesce(k.temp, k.time) IS NULL THEN 9999 ELSE coalesce(abs(a.temp - k.temp), 0) + coalesce(abs(a.time - k.time), 0) END AS distance FROM a CROSS JOIN k),
best AS (SELECT temp, time, min((distance, right_id)) AS m FROM d GROUP BY temp, time)
SELECT c.id AS left_id, m[2] AS right_id, m[1] AS distance, CAST(1 AS BIGINT) AS rank FROM fx_conditions c JOIN best b ON c.temp IS NOT DISTINCT FROM b.temp AND c.time IS NOT DISTINCT FROM b.time WHERE c.half = 1""")
def _(t):
    rows = t("fx_conditions")
    return _long(chains.nearest_conditions(rows.where("half = 1").drop("half"), rows.where("half = 0").drop("half")), "rank")


# ---- summaries


@query("a1_entity_type_counts", "SELECT coalesce(type, 'Unknown') AS type, count(*) AS n FROM fx_entities GROUP BY 1")
def _(t):
    return summary.entity_type_counts(t("fx_entities"))


@query("a2_relation_type_counts", "SELECT coalesce(relation_type, 'Unknown') AS relation_type, count(*) AS n FROM fx_relations GROUP BY 1")
def _(t):
    return summary.relation_type_counts(t("fx_relations"))


ERRORS = f"SELECT {TRIM.format(chr(115) + 'plit_part(line, ' + chr(39) + ':' + chr(39) + ', 1)')} AS error, count(*) AS n FROM fx_log GROUP BY 1"


@query("a3_error_type_counts", ERRORS)
def _(t):
    return summary.error_type_counts(t("fx_log"))


FAILED = "line LIKE '%LLM%' AND line LIKE '%失败%'"


@query("a4_model_failures", f"SELECT file, line_no, line FROM fx_log WHERE {FAILED} ORDER BY file, line_no LIMIT 10")
def _(t):
    return summary.model_failures(t("fx_log"))[1]


@query("a4_model_failure_count", f"SELECT count(*) AS n FROM fx_log WHERE {FAILED}")
def _(t):
    return summary.model_failures(t("fx_log"))[0]


@query("a5_quality_warnings", f"SELECT 'too many entities' AS warning, n FROM (SELECT count(*) AS n FROM fx_entities) WHERE n > 10000 UNION ALL SELECT 'too many relations', n FROM (SELECT count(*) AS n FROM fx_relations) WHERE n > 10000 UNION ALL SELECT 'model failures', n FROM (SELECT count(*) AS n FROM fx_log WHERE {FAILED}) WHERE n > 0")
def _(t):
    return summary.quality_warnings(t("fx_entities"), t("fx_relations"), summary.model_failures(t("fx_log"))[0])


DOCUMENTS = "SELECT d.doc_id, CASE WHEN e.n > 0 THEN 'Completed' ELSE 'Failed' END AS status, coalesce(e.n, 0) AS entity_count, coalesce(r.n, 0) AS relation_count FROM documents d LEFT JOIN (SELECT doc_id, count(*) AS n FROM fx_entities GROUP BY doc_id) e ON d.doc_id = e.doc_id LEFT JOIN (SELECT doc_id, count(*) AS n FROM fx_relations GROUP BY doc_id) r ON d.doc_id = r.doc_id"


def _document_summary(t):
    return summary.document_summary(t("SELECT doc_id FROM documents"), t("fx_entities"), t("fx_relations"))


@query("a6_document_summary", DOCUMENTS)
def _(t):
    return _document_summary(t).drop("error")


OVERALL = f"SELECT count(*) AS total, count(*) FILTER (status = 'Completed') AS completed, count(*) FILTER (status <> 'Completed') AS failed, CAST(sum(entity_count) AS BIGINT) AS entities, CAST(sum(relation_count) AS BIGINT) AS relations FROM ({DOCUMENTS})"


@query("a6_overall_summary", OVERALL)
def _(t):
    return summary.overall_summary(_document_summary(t))


@query("a7_kg_summary", f"SELECT (SELECT string_agg(type || '=' || n, ';' ORDER BY type) FROM (SELECT type, count(*) AS n FROM fx_entities GROUP BY type)) AS entity_types, (SELECT string_agg(relation_type || '=' || n, ';' ORDER BY relation_type) FROM (SELECT relation_type, count(*) AS n FROM fx_relations GROUP BY 1)) AS relation_types, (SELECT string_agg(error || '=' || n, ';' ORDER BY error) FROM ({ERRORS})) AS errors, (SELECT count(*) FROM fx_log WHERE {FAILED}) AS model_failures, CAST(10 AS BIGINT) AS n_samples")
def _(t):
    found = summary.kg_summary(t("fx_entities"), t("fx_relations"), t("fx_log"), text=True)
    return found.select("entity_types", "relation_types", "errors", "model_failures", F.size("failure_samples").cast("long").alias("n_samples"))


# ---- files and streams


def _place(t) -> str:
    return f"{scratch.shared_dir(t.spark)}/spindlekg/{uuid.uuid4().hex}"


@query("s1_read_document_files", "SELECT 'part ' || CAST(p_partkey // 500 AS VARCHAR) || '.v1' AS doc_id, CAST(sum(length(CAST(p_partkey AS VARCHAR)) + 1) AS BIGINT) AS length, string_agg(CAST(p_partkey AS VARCHAR) || chr(10), '' ORDER BY p_partkey) AS content FROM part GROUP BY p_partkey // 500")
def _(t):
    """Files in nested folders, of every five hundred parts one, with files of another kind beside them."""
    rows = t("SELECT CAST(floor(p_partkey / 500) AS BIGINT) AS file, CAST(p_partkey AS STRING) AS value, p_partkey FROM part")
    _named_files(t.spark, rows, ("p_partkey",), path := _place(t), lambda k: f"{k % 3}/deep {k % 2}/part {k}.v1.pdf")
    _named_files(t.spark, rows, ("p_partkey",), f"{path}/1/other", lambda k: f"part {k}.txt")
    return files.read_document_files(t.spark, path).select("doc_id", "length", F.col("content").cast("string").alias("content"))


@query("s2_extractions_round_trip", "SELECT doc_id, para_no, chunk_no, seq, text, type FROM fx_entities")
def _(t):
    files.write_extractions(t("fx_entities"), path := _place(t))
    return files.read_extractions(t.spark, path)


@query("s3_pending_documents", "SELECT doc_id, source FROM documents WHERE doc_id % 3 <> 0")
def _(t):
    return files.pending_documents(t("SELECT doc_id, source FROM documents"), t("SELECT doc_id FROM documents WHERE doc_id % 3 = 0")).select("doc_id", "source")


@query("s4_error_logs_round_trip", ERRORS)
def _(t):
    t("SELECT line FROM fx_log").write.text(path := _place(t))
    return summary.error_type_counts(files.read_error_logs(t.spark, path))


def _named_files(spark, rows, order, path, name):
    """Writes rows (file, value), a line each, as text files of which name gives the place below path, by the file's number.
    order: of a file's lines, or None if each has one; gzipped if the name ends so."""
    raw = f"{path}/raw"
    lines = rows if order is None else rows.repartition("file").sortWithinPartitions("file", *order)
    lines.select("file", "value").write.partitionBy("file").option("compression", "gzip" if name(0).endswith(".gz") else "none").text(raw)
    places = spark._jvm.org.apache.hadoop.fs.Path
    system = places(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for made in system.globStatus(places(f"{raw}/file=*/part-*")):  # only names pass through the driver
        to = places(f"{path}/{name(int(made.getPath().getParent().getName().split('=')[1]))}")
        system.mkdirs(to.getParent())
        system.rename(made.getPath(), to)
    system.delete(places(raw), True)


def _exports(t, rows, name, fields):
    """A JSON array of records for every two thousand documents, a file each, and a broken file beside them."""
    text = F.to_json(F.array_sort(F.collect_list(F.struct(*fields))))
    made = rows.groupBy(F.floor(F.col("doc_id") / 2000).alias("file")).agg(text.alias("value"))
    broken = t.spark.createDataFrame([(-1, '[{"text": ')], "file long, value string")
    _named_files(t.spark, made.union(broken), None, path := _place(t), lambda k: f"g{k}_{name}.json.gz")
    return path


@query("s4_entity_exports", "SELECT 'g' || CAST(doc_id // 2000 AS VARCHAR) AS doc_id, text, type, count(*) AS n FROM fx_entities GROUP BY ALL")
def _(t):
    path = _exports(t, t.written("fx_rows")("fx_entities"), "entities", ("seq", "chunk_no", "text", "type"))
    return files.read_json_records(t.spark, f"{path}/*_entities.json.gz", files.ENTITY_SCHEMA, "_entities").groupBy("doc_id", "text", "type").agg(F.count("*").alias("n"))


@query("s4_relation_exports", "SELECT 'g' || CAST(doc_id // 2000 AS VARCHAR) AS doc_id, head_entity_text, tail_entity_text, relation_type, count(*) AS n FROM fx_relations GROUP BY ALL")
def _(t):
    path = _exports(t, t("fx_relations"), "relations", ("seq", "head_entity_text", "tail_entity_text", "relation_type"))
    return files.read_json_records(t.spark, f"{path}/*_relations.json.gz", files.RELATION_SCHEMA, "_relations").groupBy("doc_id", "head_entity_text", "tail_entity_text", "relation_type").agg(F.count("*").alias("n"))


@query("s5_summary_round_trip", OVERALL)
def _(t):
    files.write_summary(summary.overall_summary(_document_summary(t)), path := _place(t))
    return t.spark.read.schema("total long, completed long, failed long, entities long, relations long").json(path)


@query("s6_graph_round_trip", EDGES)
def _(t):
    old, new, _ = _graphs(t)
    path = _place(t)
    tables.write_graph(old, path)
    tables.write_graph(new, path)
    return tables.read_graph(t.spark, path).edges.select(*EDGE_COLUMNS)


def _streamed(t):
    """Documents with their entities and relations in two streams one after the other, the even ones first: a graph's path."""
    t = t.written("fx_rows")
    some = lambda df, name, *c: df.groupBy("doc_id").agg(F.collect_list(F.struct(*c)).alias(name))  # noqa: E731  a document's own
    docs = some(t(ENTITY_ROWS), "entities", "seq", "text", "type", "attributes").join(some(t("fx_relations"), "relations", "seq", "head_entity_text", "tail_entity_text", "relation_type", "object"), "doc_id", "full")
    path = _place(t)
    docs.withColumn("half", F.col("doc_id") % 2).write.option("compression", "zstd").partitionBy("half").parquet(f"{path}/docs")
    places = t.spark._jvm.org.apache.hadoop.fs.Path
    system = places(path).getFileSystem(t.spark._jsc.hadoopConfiguration())
    docs.limit(0).write.parquet(f"{path}/in")  # without any document, there is still a file to import
    for part in (0, 1):
        for made in system.globStatus(places(f"{path}/docs/half={part}/part-*")) or ():  # they arrive by a new name, not by a copy
            system.rename(made.getPath(), places(f"{path}/in/{part}-{made.getPath().getName()}"))
        arriving = t.spark.readStream.schema(docs.schema).parquet(f"{path}/in")
        stream_import(arriving, f"{path}/graph", f"{path}/checkpoint").awaitTermination()
    return f"{path}/graph"


@query("t1_stream_import", f"SELECT label, text, props FROM ({NODES})")
def _(t):
    nodes = tables.read_graph(t.spark, _streamed(t)).nodes
    return nodes.select("label", "text", map_text(F.col("props")).alias("props"))


@query("t1_stream_import_edges", f"SELECT head_label, head_text, rel_type, tail_label, tail_text, source_doc_id FROM ({EDGES})")
def _(t):
    return tables.read_graph(t.spark, _streamed(t)).edges.select("head_label", "head_text", "rel_type", "tail_label", "tail_text", "source_doc_id")


# ---- the whole way from chunks to a graph

FOUND = f"""SELECT doc_id, para_no, chunk_no, text, type, rank, seq FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, para_no, chunk_no, text, type ORDER BY rank, seq) AS nth FROM (SELECT doc_id, para_no, chunk_no, text, type, 0 AS rank, seq FROM fx_entities
UNION ALL SELECT doc_id, para_no, chunk_no, h.phrase, 'MechanicalProperty', 1, seq FROM ({PROPERTY_HITS.format(lists=_property_lists(PROPERTIES))}) UNION ALL SELECT doc_id, para_no, chunk_no, text, 'HeatTreatmentProcess', 2, seq FROM ({PROCESS_ENTITIES}))) WHERE rank = 0 OR nth = 1"""
W1 = f"""WITH found AS ({FOUND}), links AS (SELECT * FROM (SELECT c.doc_id, c.para_no, c.chunk_no, e.text, count(*) OVER (PARTITION BY c.doc_id, c.para_no, c.chunk_no) AS n FROM fx_chunks c JOIN found e ON c.doc_id = e.doc_id AND c.para_no = e.para_no WHERE e.text <> '' AND contains(c.chunk_text, e.text)) WHERE n >= 2),
ruled AS (SELECT h.doc_id, h.para_no, h.chunk_no, lower(trim(l.text)) AS head_entity_text, concat(h.h.value, h.h.unit) AS tail_entity_text, 'EXHIBITS_PROPERTY' AS relation_type FROM ({PROPERTY_HITS.format(lists=_property_lists(RELATION_PROPERTIES))}) h JOIN links l ON h.doc_id = l.doc_id AND h.para_no = l.para_no AND h.chunk_no = l.chunk_no AND h.h.name = lower(trim(l.text))
UNION ALL SELECT h.doc_id, h.para_no, h.chunk_no, lower(trim(l.text)), h.text, 'UNDERGOES_TREATMENT' FROM ({PROCESS_HITS.format(lists=_treatment_lists(RELATION_TREATMENTS))}) h JOIN links l ON h.doc_id = l.doc_id AND h.para_no = l.para_no AND h.chunk_no = l.chunk_no AND contains(lower(h.text), lower(trim(l.text)))),
said AS (SELECT doc_id, para_no, chunk_no, head_entity_text, tail_entity_text, relation_type FROM fx_relations WHERE doc_id % 5 <> 0),
kept AS (SELECT DISTINCT s.doc_id, s.head_entity_text, s.tail_entity_text, s.relation_type FROM said s JOIN links a ON a.doc_id = s.doc_id AND a.para_no = s.para_no AND a.chunk_no = s.chunk_no AND a.text = s.head_entity_text JOIN links b ON b.doc_id = s.doc_id AND b.para_no = s.para_no AND b.chunk_no = s.chunk_no AND b.text = s.tail_entity_text WHERE NOT EXISTS (SELECT 1 FROM ruled r WHERE r.doc_id = s.doc_id AND r.para_no = s.para_no AND r.chunk_no = s.chunk_no AND r.head_entity_text = s.head_entity_text AND r.tail_entity_text = s.tail_entity_text)),
combined AS (SELECT DISTINCT doc_id, head_entity_text, tail_entity_text, relation_type FROM ruled UNION SELECT * FROM kept),
bare AS (SELECT doc_id FROM found GROUP BY doc_id HAVING count(*) > 1 EXCEPT SELECT doc_id FROM combined),
every AS (SELECT * FROM combined UNION ALL SELECT DISTINCT a.doc_id, a.text, b.text, 'EXHIBITS_PROPERTY' FROM found a JOIN found b ON a.doc_id = b.doc_id WHERE a.type = 'HeatTreatmentProcess' AND b.type = 'MechanicalProperty' AND a.doc_id IN (SELECT doc_id FROM bare)),
good AS (SELECT doc_id, text, type, min((chunk_no, rank, seq)) AS place FROM (SELECT doc_id, chunk_no, rank, seq, text, {TYPE} AS type FROM found) WHERE type IN {ALLOWED} AND trim(text) <> '' GROUP BY doc_id, text, type),
types AS (SELECT doc_id, text, max_by(type, place) AS type FROM good GROUP BY doc_id, text), nodes AS (SELECT DISTINCT type, text FROM good),
typed AS (SELECT e.doc_id, coalesce(h.type, 'Entity') AS head_label, e.head_entity_text AS head_text, {REL_TYPE} AS rel_type, coalesce(t.type, 'Entity') AS tail_label, e.tail_entity_text AS tail_text FROM every e LEFT JOIN types h ON e.doc_id = h.doc_id AND e.head_entity_text = h.text LEFT JOIN types t ON e.doc_id = t.doc_id AND e.tail_entity_text = t.text WHERE {REL_TYPE} IN {ALLOWED_RELS} AND e.head_entity_text <> '' AND e.tail_entity_text <> '')
SELECT head_label, head_text, rel_type, tail_label, tail_text, 'first' AS batch_id, CAST(max(doc_id) AS VARCHAR) AS source_doc_id FROM typed WHERE (head_label, head_text) IN (SELECT (type, text) FROM nodes) AND (tail_label, tail_text) IN (SELECT (type, text) FROM nodes) GROUP BY ALL"""


@query("w1_corpus_to_graph", W1)
def _(t):
    """Chunks to entities, rule relations, the model's that they lack, and the fallback; imported into an empty graph: its
    edges. fx_relations stands for the model's answers, which every fifth document lacks."""
    t = t.written("fx_rows")
    chunks, said = scratch.materialize(t("fx_chunks")), t("SELECT * FROM fx_relations WHERE doc_id % 5 <> 0").drop("object")
    ruled = (entities.extract_property_entities(chunks), entities.extract_process_entities(chunks))
    found = scratch.materialize(entities.merge_entities(t("fx_entities"), *[df.drop("source_text") for df in ruled]))  # the chunks have it
    links = scratch.materialize(relations.link_entities_to_chunks(chunks, found))
    ruled = scratch.materialize(_rules(t, links, chunks).drop("source_sentence"))
    kept = relations.drop_known_pairs(relations.validate_relations(said, links), ruled)
    combined = scratch.materialize(relations.combine_relations(ruled, kept))
    every = combined.unionByName(relations.fallback_cross_relations(found, combined), allowMissingColumns=True)
    rels = every.withColumn("seq", F.struct("rank", "chunk_no", "hit_no", "seq", "entity_seq"))
    ents = found.withColumn("seq", F.struct("chunk_no", "rank", "seq"))
    loaded, _ = graph.import_batch(graph.empty_graph(t.spark), ents, rels, "first", _at(NOW))
    return loaded.edges.select(*EDGE_COLUMNS[:-1])
