"""Derived views over the driver's tables, as common table expressions that Spark SQL and DuckDB both run.

They give the graph operators realistic inputs that grow with the tables. Every view has an explicit sequence.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings")

#: Lines of the documents, the one view that the engines write differently.
SPARK_LINES = r"""SELECT doc_id, pos AS k, text FROM (SELECT doc_id, posexplode(split(text, '\n')) AS (pos, text) FROM documents)"""
DUCKDB_LINES = r"""SELECT doc_id, unnest(range(len(string_split(text, chr(10))))) AS k, unnest(string_split(text, chr(10))) AS text FROM documents"""

VIEWS: dict[str, str] = {
    "fx_rows": r"""SELECT l_orderkey AS doc_id, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS BIGINT) AS seq, l_partkey AS pk, l_suppkey AS sk, CAST(l_quantity AS INT) AS qty FROM lineitem""",
    "fx_chunks": r"""SELECT doc_id, CAST(seq % 3 AS INT) AS para_no, seq AS chunk_no, concat('Alloy E', CAST(pk AS STRING), 'x', CAST(sk % 8 AS STRING), CASE WHEN pk % 4 = 0 THEN ' yield strength of ' WHEN pk % 4 = 2 THEN ' 屈服强度约' ELSE ' 抗拉强度为' END, CAST(qty * 10 AS STRING), ' MPa', CASE WHEN sk % 3 = 0 THEN concat(', hardness about ', CAST(100 + qty AS STRING), ' HV') ELSE '' END, CASE WHEN sk % 4 = 0 THEN ' after T6时效' WHEN sk % 4 = 1 THEN ' 固溶处理 500℃ 2h' ELSE '' END, '.') AS chunk_text FROM fx_rows""",
    "fx_entities": r"""SELECT doc_id, CAST(seq % 3 AS INT) AS para_no, seq AS chunk_no, seq * 2 AS seq, CASE WHEN sk % 17 = 0 THEN '' ELSE concat('E', CAST(pk AS STRING), 'x', CAST(sk % 8 AS STRING)) END AS text, CASE pk % 10 WHEN 0 THEN 'MaterialAlloy' WHEN 1 THEN 'Alloy' WHEN 2 THEN '合金' WHEN 3 THEN 'HeatTreatmentProcess' WHEN 4 THEN '工艺' WHEN 5 THEN 'MechanicalProperty' WHEN 6 THEN '性能' WHEN 7 THEN 'AlloyComponent' WHEN 8 THEN 'Gadget' ELSE '' END AS type FROM fx_rows UNION ALL SELECT doc_id, CAST(seq % 3 AS INT), seq, seq * 2 + 1, CASE WHEN pk % 2 = 1 THEN '抗拉强度' WHEN sk % 4 = 0 THEN 'T6' WHEN sk % 4 = 1 THEN '固溶' ELSE '屈服强度' END, CASE WHEN pk % 2 = 0 AND sk % 4 < 2 THEN 'HeatTreatmentProcess' ELSE 'MechanicalProperty' END FROM fx_rows UNION ALL SELECT doc_id, CAST(seq % 3 AS INT), seq, seq * 2 + 1000000, 'MPa', 'MicrostructureFeature' FROM fx_rows WHERE sk % 5 = 2 UNION ALL SELECT doc_id, CAST(seq % 3 AS INT), seq, seq * 2 + 1000001, 'Alloy', 'ResearchSubject' FROM fx_rows WHERE sk % 5 = 2""",
    "fx_relations": r"""SELECT doc_id, CAST(seq % 3 AS INT) AS para_no, seq AS chunk_no, seq, CASE WHEN sk % 4 = 1 AND qty % 3 = 0 THEN '固溶' ELSE concat('E', CAST(pk AS STRING), 'x', CAST(sk % 8 AS STRING)) END AS head_entity_text, CASE WHEN sk % 4 = 1 AND qty % 3 = 0 THEN '固溶处理' WHEN qty % 2 = 0 THEN CASE WHEN pk % 2 = 1 THEN '抗拉强度' WHEN sk % 4 = 0 THEN 'T6' WHEN sk % 4 = 1 THEN '固溶' ELSE '屈服强度' END ELSE concat('E', CAST(pk AS STRING), 'x', CAST((sk + 1) % 8 AS STRING)) END AS tail_entity_text, CASE qty % 6 WHEN 0 THEN 'HAS_PROPERTY' WHEN 1 THEN 'TREATED_BY' WHEN 2 THEN 'HAS_COMPONENT' WHEN 3 THEN 'AFFECTS_PROPERTY' WHEN 4 THEN 'INVESTIGATED' ELSE '' END AS relation_type, concat(CAST(400 + qty AS STRING), '°C ', CAST(qty AS STRING), 'min') AS object FROM fx_rows""",
    "fx_steps": r"""SELECT doc_id, seq, CASE sk % 8 WHEN 0 THEN 'solution treatment' WHEN 1 THEN 'water quench' WHEN 2 THEN '双级时效' WHEN 3 THEN 'annealing' WHEN 4 THEN '均匀化' WHEN 5 THEN 'rolling' WHEN 6 THEN '淬火' ELSE '' END AS name, CASE WHEN pk % 9 = 0 THEN CAST(qty AS STRING) END AS step, concat(CAST(100 + qty AS STRING), '℃/', CAST(pk % 12 + 1 AS STRING), CASE WHEN pk % 2 = 0 THEN 'h' ELSE 'min' END) AS parameters FROM fx_rows""",
    "fx_conditions": r"""SELECT doc_id * 1000 + seq AS id, CAST(CASE WHEN pk % 11 = 0 THEN NULL ELSE qty * qty * 3 + sk % 3 END AS BIGINT) AS temp, CAST(CASE WHEN sk % 7 = 0 THEN NULL ELSE pk % 23 + CASE WHEN pk % 97 = 1 THEN 20000 ELSE 0 END END AS BIGINT) AS time, doc_id % 2 AS half FROM fx_rows""",
    "fx_history": r"""SELECT concat('batch_', CAST(event_id AS STRING)) AS batch_id, concat('doc_', CAST(user_id AS STRING)) AS doc_id, CASE event_type WHEN 'error' THEN 'failed' WHEN 'view' THEN 'completed' WHEN 'click' THEN 'active' WHEN 'signup' THEN 'superseded' ELSE 'rolledback' END AS status, ts AS created_at FROM events""",
    "fx_log": r"""SELECT concat('error_', CAST(user_id % 7 AS STRING), '.log') AS file, event_id AS line_no, CASE event_type WHEN 'error' THEN concat('LLM调用失败: user ', CAST(user_id AS STRING)) WHEN 'purchase' THEN concat('ParseError : LLM 返回失败 ', props) WHEN 'click' THEN '' ELSE concat(event_type, ': ', props) END AS line FROM events""",
    "fx_nodes": r"""SELECT concat('R', CAST(r_regionkey AS STRING)) AS id, 'Application' AS label, r_name AS text FROM region UNION ALL SELECT concat('N', CAST(n_nationkey AS STRING)), 'ResearchSubject', n_name FROM nation UNION ALL SELECT concat('C', CAST(c_custkey AS STRING)), 'MaterialAlloy', c_name FROM customer UNION ALL SELECT concat('S', CAST(s_suppkey AS STRING)), 'ResearchMethod', s_name FROM supplier""",
    "fx_edges": r"""SELECT concat('N', CAST(n_nationkey AS STRING)) AS src, concat('R', CAST(n_regionkey AS STRING)) AS dst, 'HAS_APPLICATION' AS rel_type FROM nation UNION ALL SELECT concat('C', CAST(c_custkey AS STRING)), concat('N', CAST(c_nationkey AS STRING)), 'INVESTIGATED_BY' FROM customer UNION ALL SELECT concat('S', CAST(s_suppkey AS STRING)), concat('N', CAST(s_nationkey AS STRING)), 'INVESTIGATED_BY' FROM supplier""",
    "fx_blocks": r"""SELECT doc_id, CAST(floor(k / 40.0) AS INT) + 1 AS page, CAST(k AS INT) AS block_no, CASE WHEN k % 7 = 3 THEN concat(text, '-') WHEN k % 7 = 4 THEN lower(text) ELSE text END AS text, CAST(10 + (k % 40) * 20 + CASE WHEN k % 5 = 0 THEN 12 ELSE 0 END AS DOUBLE) AS y0, CAST(28 + (k % 40) * 20 AS DOUBLE) AS y1, CAST(820 AS DOUBLE) AS page_height FROM fx_lines""",
    "fx_responses": r"""SELECT doc_id, seq AS chunk_no, concat(CASE sk % 6 WHEN 0 THEN '{"entities": [' WHEN 1 THEN '[' WHEN 3 THEN '```json[' WHEN 5 THEN '{"other": [' ELSE '' END, '{"text": "E', CAST(pk AS STRING), 'x', CAST(sk % 8 AS STRING), '", "type": "MaterialAlloy"', CASE WHEN sk % 6 = 4 THEN '' ELSE concat(', "attributes": {"value": ', CAST(qty AS STRING), '}') END, '}', CASE sk % 6 WHEN 0 THEN ']}' WHEN 1 THEN ']' WHEN 3 THEN ']```' WHEN 4 THEN ', {"text": "tr' WHEN 5 THEN ']}' ELSE '' END) AS response FROM fx_rows""",
    "fx_sentences": r"""SELECT CAST(floor(vec_id / 10.0) AS BIGINT) AS doc_id, vec_id AS seq, concat('sentence ', CAST(vec_id AS STRING)) AS sentence, embedding FROM embeddings""",
    "fx_re_responses": r"""SELECT doc_id, chunk_no, CASE WHEN seq % 2 = 0 THEN concat('{"relations": [{"head_entity_text": "', head_entity_text, '", "tail_entity_text": "', tail_entity_text, '", "relation_type": "', relation_type, '"}]}') WHEN seq % 3 = 0 THEN '{"identified_entities_json": []}' ELSE concat('[{"subject": "', head_entity_text, '", "object": "', tail_entity_text, '", "relation_type": "', relation_type, '", "attributes": {}}]') END AS response FROM fx_relations""",
    "fx_chain_comp": r"""SELECT doc_id, seq, CASE pk % 4 WHEN 0 THEN 'Mg' WHEN 1 THEN 'Si' WHEN 2 THEN 'Cu' ELSE 'Fe' END AS name, concat('0.', CAST(sk % 90 + 10 AS STRING)) AS value FROM fx_rows""",
    "fx_chain_props": r"""SELECT doc_id, seq, CASE qty % 3 WHEN 0 THEN '屈服强度' WHEN 1 THEN '抗拉强度' ELSE '延伸率' END AS name, CASE WHEN qty % 5 = 0 THEN '' ELSE concat(CAST(qty * 10 AS STRING), ' MPa') END AS value FROM fx_rows""",
    "fx_chain_rels": r"""SELECT doc_id, seq, name AS from_name, CASE WHEN seq % 4 = 0 THEN 'ghost' ELSE lead(name) OVER (PARTITION BY doc_id ORDER BY seq) END AS to_name, CAST(NULL AS STRING) AS type FROM fx_steps WHERE doc_id % 3 = 0""",
    "fx_stage_responses": r"""SELECT doc_id, seq, CASE pk % 5 WHEN 0 THEN concat('{"compositions": [{"name": "', name, '", "value": "', value, '"}]}') WHEN 1 THEN concat('{"composition": {"name": "', name, '", "value": "', value, '"}}') WHEN 2 THEN concat('[{"name": "', name, '", "value": "', value, '"}]') WHEN 3 THEN '{"process_chain": []}' ELSE concat('{"alloy_compositions": "[{', chr(92), '"name', chr(92), '": ', chr(92), '"', name, chr(92), '"}]"}') END AS response FROM (SELECT r.pk, c.* FROM fx_rows r JOIN fx_chain_comp c ON r.doc_id = c.doc_id AND r.seq = c.seq) t""",
}


def _closure(sql: str, spark: bool, written: Mapping[str, str] = {}) -> dict[str, str]:
    """The views that the text needs, those that others need first. written: the text of views in place of their own."""
    found: dict[str, str] = {}
    for name in dict.fromkeys(re.findall(r"\bfx_\w+", sql)):
        text = written.get(name) or ((SPARK_LINES if spark else DUCKDB_LINES) if name == "fx_lines" else VIEWS[name])
        found |= _closure(text, spark, written) | {name: text}
    return found


def oracle(sql: str) -> str:
    """A query over views and tables as one DuckDB statement."""
    views = _closure(sql, spark=False)
    if not views:
        return sql
    head = ", ".join(f"{name} AS ({text})" for name, text in views.items())
    start = next((w for w in ("WITH RECURSIVE ", "WITH ") if sql.startswith(w)), None)
    return f"{start}{head}, {sql[len(start) :]}" if start else f"WITH {head} {sql}"


def frame(spark: SparkSession, sf_dir: str, sql: str, written: Mapping[str, str] = {}) -> DataFrame:
    """A view, a table or a SELECT over them as a DataFrame; tables are read from sf_dir. written: see _closure."""
    sql = sql if " " in sql else f"SELECT * FROM {sql}"
    views = _closure(sql, True, written)
    every = " ".join([sql, *views.values()])
    tables = {t: f"SELECT * FROM parquet.`{sf_dir}/{t}.parquet`" for t in TABLES if re.search(rf"\b{t}\b", every)}
    head = ", ".join(f"{name} AS ({text})" for name, text in (tables | views).items())
    return spark.sql(f"WITH {head} {sql}" if head else sql)
