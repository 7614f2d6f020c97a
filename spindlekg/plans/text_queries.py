"""Registered queries: layout, chunking, entities, relations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.patterns import PROPERTIES, RELATION_PROPERTIES, RELATION_TREATMENTS, TREATMENTS
from ..functions.text import is_json, let, map_text
from ..operators import chunking, entities, layout, relations
from ..sources.responses import ResponseStore
from ..sources.scratch import materialize
from .catalog import query

TRIM = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"
NER_TEMPLATE = "Extract the entities as JSON {\"text\": ...} from: {text_segment}"
RE_TEMPLATE = "Relations of\n{entities_list}\nin: {text_segment}"

# ---- layout

LINES_AS_SPANS = "SELECT doc_id, page, CAST(floor(block_no / 3.0) AS INT) AS block_no, block_no % 3 AS line_no, 0 AS span_no, text, y0, y1, page_height FROM fx_blocks"
JOIN_LINES = "list_reduce(list(text ORDER BY {order}), lambda a, b: CASE WHEN a LIKE '%-' THEN " + r"regexp_replace(left(a, length(a) - 1), '\s+$', '') || regexp_replace(b, '^\s+', '')" + " ELSE a || ' ' || b END)"


@query("l1_assemble_blocks", f"SELECT doc_id, page, block_no, y0, y1, text FROM (SELECT doc_id, page, block_no, min(y0) AS y0, max(y1) AS y1, {TRIM.format(JOIN_LINES.format(order='line_no'))} AS text FROM ({LINES_AS_SPANS}) s WHERE {TRIM.format('text')} <> '' GROUP BY ALL) WHERE text <> ''")
def _(t):
    return layout.assemble_blocks(t(LINES_AS_SPANS)).select("doc_id", "page", "block_no", "y0", "y1", "text")


ORDERED = f"SELECT doc_id, page, block_no, y0, y1, page_height, {TRIM.format('text')} AS text, row_number() OVER (PARTITION BY doc_id ORDER BY page, y0, block_no) AS reading_order FROM fx_blocks WHERE {TRIM.format('text')} <> ''"
BODY = f"SELECT * FROM ({ORDERED}) o WHERE y0 >= page_height * 0.05 AND y1 <= page_height * (1 - 0.05)"
MARKED = f"SELECT *, sum(starts) OVER (PARTITION BY doc_id ORDER BY reading_order ROWS UNBOUNDED PRECEDING) AS para_no FROM (SELECT *, CASE WHEN lag(page) OVER w IS NULL OR page <> lag(page) OVER w OR y0 - lag(y1) OVER w > page_height * 0.01 THEN 1 ELSE 0 END AS starts FROM ({BODY}) b WINDOW w AS (PARTITION BY doc_id ORDER BY reading_order)) m"
JOIN_BLOCKS = "list_reduce(list(text ORDER BY reading_order), lambda a, b: CASE WHEN a LIKE '%-' AND regexp_matches(b, '^\\p{Ll}') THEN regexp_replace(left(a, length(a) - 1), '\\s+$', '') || b ELSE a || ' ' || b END)"
MERGED = f"SELECT doc_id, CAST(para_no AS BIGINT) AS para_no, min(page) AS page, {TRIM.format('regexp_replace(' + JOIN_BLOCKS + r', ' + chr(39) + r'\s+' + chr(39) + ', ' + chr(39) + ' ' + chr(39) + ', ' + chr(39) + 'g' + chr(39) + ')')} AS text, count(*) AS n_blocks FROM ({MARKED}) k GROUP BY doc_id, para_no"


@query("l2_order_blocks", f"SELECT doc_id, page, block_no, CAST(reading_order AS BIGINT) AS reading_order, text FROM ({ORDERED}) o")
def _(t):
    return layout.order_blocks(t("fx_blocks")).select("doc_id", "page", "block_no", F.col("reading_order").cast("long").alias("reading_order"), "text")


@query("l3_drop_header_footer", f"SELECT doc_id, page, block_no, text FROM ({BODY}) b")
def _(t):
    return layout.drop_header_footer(layout.order_blocks(t("fx_blocks"))).select("doc_id", "page", "block_no", "text")


@query("l4_mark_paragraphs", f"SELECT doc_id, block_no, CAST(para_no AS BIGINT) AS para_no FROM ({MARKED}) k")
def _(t):
    return layout.mark_paragraphs(layout.drop_header_footer(layout.order_blocks(t("fx_blocks")))).select("doc_id", "block_no", "para_no")


@query("l5_merge_paragraphs", MERGED)
def _(t):
    return layout.paragraphs(t("fx_blocks")).select("doc_id", "para_no", "page", "text", F.size("block_nos").cast("long").alias("n_blocks"))


@query("l6_nest_document", f"SELECT doc_id, CAST(1 AS BIGINT) AS n_sections, count(*) AS n_paragraphs, max(text) FILTER (para_no = 1) AS first_text FROM ({MERGED}) m GROUP BY doc_id")
def _(t):
    nested = layout.nest_document(layout.paragraphs(t("fx_blocks")))
    return nested.select("doc_id", F.size("sections").cast("long").alias("n_sections"), F.size(F.col("sections")[0]["paragraphs"]).cast("long").alias("n_paragraphs"), F.col("sections")[0]["paragraphs"][0]["text"].alias("first_text"))


@query("l6_paragraph_counts", f"SELECT d.doc_id, count(m.para_no) AS n_paragraphs, count(m.para_no) = 0 AS failed FROM documents d LEFT JOIN ({MERGED}) m ON d.doc_id = m.doc_id GROUP BY d.doc_id")
def _(t):
    return layout.paragraph_counts(t("SELECT DISTINCT doc_id FROM documents"), layout.paragraphs(t("fx_blocks")))


# ---- chunking

PARAGRAPHED = r"SELECT doc_id, replace(text, '\n', '\n\n') AS text FROM documents"
FIXED = rf"""WITH RECURSIVE parts AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY k) AS i, text, length(text) AS n FROM (SELECT doc_id, k, {TRIM.format('text')} AS text FROM fx_lines) l WHERE text <> ''),
packed AS (SELECT doc_id, i, text, CASE WHEN n >= 500 THEN 0 ELSE n END AS size, 0 AS c, n >= 500 AS closed FROM parts WHERE i = 1
UNION ALL SELECT p.doc_id, p.i, p.text, CASE WHEN (CASE WHEN r.closed OR r.size + p.n > 2000 THEN p.n ELSE r.size + p.n END) >= 500 THEN 0 WHEN r.closed OR r.size + p.n > 2000 THEN p.n ELSE r.size + p.n END, CASE WHEN r.closed OR r.size + p.n > 2000 THEN r.c + 1 ELSE r.c END, (CASE WHEN r.closed OR r.size + p.n > 2000 THEN p.n ELSE r.size + p.n END) >= 500 FROM packed r JOIN parts p ON p.doc_id = r.doc_id AND p.i = r.i + 1)
SELECT doc_id, CAST(c AS BIGINT) AS chunk_no, string_agg(text, chr(10) || chr(10) ORDER BY i) AS chunk_text FROM packed GROUP BY doc_id, c"""


def _long(df, *names):
    return df.select(*[F.col(c).cast("long").alias(c) if c in names else c for c in df.columns])


@query("c1_chunk_fixed", FIXED)
def _(t):
    return _long(chunking.chunk_fixed(t(PARAGRAPHED)).select("doc_id", "chunk_no", "chunk_text"), "chunk_no")


SECTION_LINES = 12


def _sectioned(t):
    """The documents with a heading (and every other time a sub-heading) before each twelve lines, a line a paragraph."""
    lines = F.split("text", "\n")
    heading = lambda part: F.when(part % 2 == 0, F.lit("ABSTRACT\n")).otherwise(F.lit("RESULTS\n1.1 Set up\n"))
    body = lambda of, part: F.concat(heading(part), F.array_join(F.slice(of, part * SECTION_LINES + 1, SECTION_LINES), "\n\n"), F.lit("\n"))
    parts = let(lines, lambda of: F.transform(F.sequence(F.lit(0), F.floor((F.size(of) - 1) / SECTION_LINES).cast("int")), lambda part: body(of, part)))
    return t("SELECT doc_id, text FROM documents WHERE text IS NOT NULL").select("doc_id", F.concat(F.lit("Front matter\n"), F.array_join(parts, "")).alias("text"))


SECTION_PARTS = f"SELECT doc_id, k // {SECTION_LINES} AS part, row_number() OVER (PARTITION BY doc_id, k // {SECTION_LINES} ORDER BY k) AS i, text, length(text) AS n FROM (SELECT doc_id, k, {TRIM.format('text')} AS text FROM fx_lines) l WHERE text <> ''"


SECTIONS = f"""WITH RECURSIVE parts AS ({SECTION_PARTS}),
packed AS (SELECT doc_id, part, i, text, n AS size, 0 AS c FROM parts WHERE i = 1
UNION ALL SELECT p.doc_id, p.part, p.i, p.text, CASE WHEN r.size + p.n <= 2000 THEN r.size + 2 + p.n ELSE p.n END, CASE WHEN r.size + p.n <= 2000 THEN r.c ELSE r.c + 1 END FROM packed r JOIN parts p ON p.doc_id = r.doc_id AND p.part = r.part AND p.i = r.i + 1),
every AS (SELECT DISTINCT doc_id, CAST(-1 AS BIGINT) AS part, 0 AS c, '' AS section_title, 'Front matter' AS chunk_text FROM fx_lines UNION ALL SELECT doc_id, part, c, CASE WHEN part % 2 = 0 THEN 'ABSTRACT' ELSE 'RESULTS 1.1 Set up' END, string_agg(text, chr(10) || chr(10) ORDER BY i) FROM packed GROUP BY doc_id, part, c)
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY part, c) - 1 AS chunk_no, section_title, chunk_text FROM every"""


@query("c2_split_sections", SECTIONS)
def _(t):
    return _long(chunking.split_sections(_sectioned(t)).select("doc_id", "chunk_no", "section_title", "chunk_text"), "chunk_no")


@query("c3_split_sentences", f"SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY k) - 1 AS seq, sentence FROM (SELECT doc_id, k, {TRIM.format('s')} AS sentence FROM (SELECT doc_id, unnest(range(len(string_split(text, '.')))) AS k, unnest(string_split(text, '.')) AS s FROM documents)) WHERE sentence <> ''")
def _(t):
    return _long(chunking.split_sentences(t("SELECT doc_id, text FROM documents")), "seq")


@query("c4_chunk_by_similarity", """WITH near AS (SELECT doc_id, seq, sentence, list_cosine_similarity(CAST(lag(embedding) OVER w AS DOUBLE[]), CAST(embedding AS DOUBLE[])) AS sim FROM fx_sentences WINDOW w AS (PARTITION BY doc_id ORDER BY seq)),
cut AS (SELECT *, CASE WHEN sim <= avg(sim) OVER (PARTITION BY doc_id) - stddev_pop(sim) OVER (PARTITION BY doc_id) THEN 1 ELSE 0 END AS cut FROM near),
numbered AS (SELECT *, sum(cut) OVER (PARTITION BY doc_id ORDER BY seq ROWS UNBOUNDED PRECEDING) AS chunk_no FROM cut)
SELECT doc_id, CAST(chunk_no AS BIGINT) AS chunk_no, string_agg(sentence, '. ' ORDER BY seq) || '.' AS chunk_text FROM numbered GROUP BY doc_id, chunk_no""")
def _(t):
    return chunking.chunk_by_similarity(t("fx_sentences"))


SENTENCES = f"SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY k) - 1 AS seq, sentence FROM (SELECT doc_id, k, {TRIM.format('s')} AS sentence FROM (SELECT doc_id, unnest(range(len(string_split(text, '.')))) AS k, unnest(string_split(text, '.')) AS s FROM documents)) WHERE sentence <> ''"
LEXICAL = rf"""sentences AS ({SENTENCES}),
terms AS (SELECT doc_id, seq, term, count(*) AS n FROM (SELECT doc_id, seq, unnest(regexp_extract_all(lower(sentence), '[\p{{L}}\p{{N}}]+')) AS term FROM sentences) GROUP BY ALL),
sent AS (SELECT doc_id, seq + k AS seq, term, CASE WHEN k > 0 THEN n ELSE 0 END AS l, CASE WHEN k > 0 THEN 0 ELSE n END AS r FROM terms, (SELECT unnest(range(-2, 4)) AS k)),
sums AS (SELECT doc_id, seq, sum(l * r) AS lr, sum(l * l) AS ll, sum(r * r) AS rr FROM (SELECT doc_id, seq, term, sum(l) AS l, sum(r) AS r FROM sent GROUP BY ALL) GROUP BY ALL),
near AS (SELECT s.doc_id, s.seq, CAST(coalesce(CASE WHEN ll > 0 AND rr > 0 THEN floor(CAST(lr AS DOUBLE) * 1000000.0::DOUBLE / (sqrt(CAST(ll AS DOUBLE)) * sqrt(CAST(rr AS DOUBLE)))) ELSE 0 END, 0) AS BIGINT) AS cohesion FROM sentences s LEFT JOIN sums USING (doc_id, seq) WHERE s.seq > 0),
limits AS (SELECT doc_id, count(*) AS n, sum(cohesion)::HUGEINT AS s, sum(cohesion * cohesion)::HUGEINT AS q FROM near GROUP BY doc_id),
cuts AS (SELECT s.doc_id, s.seq, s.sentence, CASE WHEN l.s - l.n * k.cohesion >= 0 AND (l.s - l.n * k.cohesion) * (l.s - l.n * k.cohesion) >= l.n * l.q - l.s * l.s THEN 1 ELSE 0 END AS cut FROM sentences s LEFT JOIN near k USING (doc_id, seq) LEFT JOIN limits l USING (doc_id)),
lexical AS (SELECT doc_id, chunk_no, string_agg(sentence, '. ' ORDER BY seq) || '.' AS chunk_text FROM (SELECT *, CAST(sum(cut) OVER (PARTITION BY doc_id ORDER BY seq ROWS UNBOUNDED PRECEDING) AS BIGINT) AS chunk_no FROM cuts) GROUP BY doc_id, chunk_no)"""


@query("c4_chunk_lexical", f"WITH {LEXICAL} SELECT * FROM lexical")
def _(t):
    return _long(chunking.chunk_lexical(t("SELECT doc_id, text FROM documents")), "chunk_no")


@query("c5_chunk_documents", f"""WITH {LEXICAL}, plain AS ({FIXED}) SELECT 'similarity' AS method, doc_id, chunk_no, chunk_text FROM lexical
UNION ALL SELECT 'no such method', doc_id, chunk_no, chunk_text FROM plain UNION ALL SELECT 'pdf', doc_id, chunk_no, chunk_text FROM ({SECTIONS})""")
def _(t):
    """Each document by each method: its words, its sections, and by one that there is not."""
    docs, plain = t("SELECT doc_id, text FROM documents"), t(PARAGRAPHED)
    tables = {"similarity": docs, "pdf": _sectioned(t), "no such method": plain}
    made = [_long(chunking.chunk_documents(df, name).select(F.lit(name).alias("method"), "doc_id", "chunk_no", "chunk_text"), "chunk_no") for name, df in tables.items()]
    return made[0].unionByName(made[1]).unionByName(made[2])


# ---- entities

COLLAPSED = r"regexp_replace(regexp_replace(chunk_text, '\s+', ' ', 'g'), '^\s+|\s+$', '', 'g')"


@query("n1_build_ner_prompts", f"SELECT doc_id, chunk_no, replace('{NER_TEMPLATE}', '{{text_segment}}', {COLLAPSED}) AS prompt FROM fx_chunks")
def _(t):
    return entities.build_ner_prompts(t("fx_chunks"), NER_TEMPLATE).select("doc_id", "chunk_no", "prompt")


@query("n2_complete", "SELECT doc_id, chunk_no, CAST(length(chunk_text) AS VARCHAR) AS response FROM fx_chunks")
def _(t):
    prompts = materialize(t("SELECT doc_id, chunk_no, chunk_text AS prompt FROM fx_chunks"))  # they are read more than once
    return entities.complete(prompts, lambda batch: [str(len(p)) for p in batch]).select("doc_id", "chunk_no", "response")


@query("n2_response_store", "SELECT doc_id, chunk_no, CASE WHEN EXISTS (SELECT 1 FROM fx_chunks k WHERE k.doc_id % 2 = 0 AND k.chunk_text = c.chunk_text) THEN '' ELSE 'asked later: ' END || CAST(length(chunk_text) AS VARCHAR) AS response FROM fx_chunks c")
def _(t):
    """A second run with another model over all chunks: those that the first run asked keep their answers."""
    store = ResponseStore(t.spark)
    prompts = materialize(t("SELECT doc_id, chunk_no, chunk_text AS prompt FROM fx_chunks"))  # they are read more than once
    entities.complete(prompts.where("doc_id % 2 = 0"), lambda batch: [str(len(p)) for p in batch], store=store)
    return entities.complete(prompts, lambda batch: [f"asked later: {len(p)}" for p in batch], store=store).select("doc_id", "chunk_no", "response")


@query("n3_parse_ner_responses", "SELECT doc_id, seq AS chunk_no, CAST(0 AS BIGINT) AS seq, concat('E', CAST(pk AS VARCHAR), 'x', CAST(sk % 8 AS VARCHAR)) AS text, 'MaterialAlloy' AS type, CASE WHEN sk % 6 = 4 THEN '' ELSE concat('value=', CAST(qty AS VARCHAR)) END AS attributes FROM fx_rows WHERE sk % 6 <> 5")
def _(t):
    found = entities.parse_ner_responses(t("fx_responses")).withColumn("attributes", map_text(F.col("attributes")))
    return _long(found.select("doc_id", "chunk_no", "seq", "text", "type", "attributes"), "seq")


@query("n4_recover_json_objects", "SELECT doc_id, seq AS chunk_no, concat('E', CAST(pk AS VARCHAR), 'x', CAST(sk % 8 AS VARCHAR)) AS text, 'MaterialAlloy' AS type FROM fx_rows WHERE sk % 6 = 4")
def _(t):
    broken = t("fx_responses").where(~is_json(entities.strip_fences(F.col("response"))))
    return broken.select("doc_id", "chunk_no", F.explode(entities.recover_json_objects(F.col("response"))).alias("e")).select("doc_id", "chunk_no", "e.text", "e.type")


def _duck(pattern: str) -> str:
    """The pattern as DuckDB reads it: Unicode letters need no flag there."""
    return pattern.replace("(?iU)", "(?i)")


def _property_lists(rules) -> str:
    lists = [f"list_transform(list_zip(regexp_extract_all(chunk_text, '{_duck(r.pattern)}', 0), regexp_extract_all(chunk_text, '{_duck(r.pattern)}', 2)), lambda h: {{'name': '{r.name}', 'phrase': h[1], 'value': h[2], 'unit': '{r.unit}'}})" for r in rules]
    return "flatten([" + ", ".join(lists) + "])"


def _treatment_lists(rules) -> str:
    return "flatten([" + ", ".join(f"regexp_extract_all(chunk_text, '{_duck(r.pattern)}', 0)" for r in rules) + "])"


PROPERTY_HITS = "SELECT doc_id, para_no, chunk_no, chunk_text, unnest(range(len(h))) AS seq, unnest(h) AS h FROM (SELECT *, {lists} AS h FROM fx_chunks)"
PROPERTY_ENTITIES = f"SELECT doc_id, chunk_no, seq, h.phrase AS text, concat('name=', h.name, ';unit=', h.unit, ';value=', h.value) AS attributes FROM ({PROPERTY_HITS.format(lists=_property_lists(PROPERTIES))})"
PROCESS_HITS = "SELECT doc_id, para_no, chunk_no, chunk_text, unnest(range(len(h))) AS seq, unnest(h) AS text FROM (SELECT *, {lists} AS h FROM fx_chunks)"
PROCESS_ENTITIES = PROCESS_HITS.format(lists=_treatment_lists(TREATMENTS))


@query("n5_extract_property_entities", PROPERTY_ENTITIES)
def _(t):
    found = entities.extract_property_entities(t("fx_chunks")).withColumn("attributes", map_text(F.col("attributes")))
    return _long(found.select("doc_id", "chunk_no", "seq", "text", "attributes"), "seq")


@query("n6_extract_process_entities", f"SELECT doc_id, chunk_no, seq, text FROM ({PROCESS_ENTITIES})")
def _(t):
    return _long(entities.extract_process_entities(t("fx_chunks")).select("doc_id", "chunk_no", "seq", "text"), "seq")


@query("n7_merge_entities", f"""WITH every AS (SELECT doc_id, chunk_no, text, type, 0 AS rank, seq FROM fx_entities UNION ALL SELECT doc_id, chunk_no, text, 'MechanicalProperty', 1, seq FROM ({PROPERTY_ENTITIES}) UNION ALL SELECT doc_id, chunk_no, text, 'HeatTreatmentProcess', 2, seq FROM ({PROCESS_ENTITIES}))
SELECT doc_id, chunk_no, text, type, CAST(rank AS BIGINT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, chunk_no, text, type ORDER BY rank, seq) AS nth FROM every) WHERE rank = 0 OR nth = 1""")
def _(t):
    chunks = materialize(t("fx_chunks"))
    merged = entities.merge_entities(t("fx_entities"), entities.extract_property_entities(chunks), entities.extract_process_entities(chunks))
    return _long(merged.select("doc_id", "chunk_no", "text", "type", "rank"), "rank")


@query("n8_dedup_records", "SELECT min(doc_id) AS doc_id, text, lang FROM documents GROUP BY text, lang")
def _(t):
    return entities.dedup_records(t("SELECT doc_id, text, lang FROM documents"), scope=(), order=("doc_id",))


# ---- relations

LINKS = "SELECT * FROM (SELECT c.doc_id, c.para_no, c.chunk_no, c.chunk_text, e.text, e.type, e.seq AS entity_seq, count(*) OVER (PARTITION BY c.doc_id, c.para_no, c.chunk_no) AS n FROM fx_chunks c JOIN fx_entities e ON c.doc_id = e.doc_id AND c.para_no = e.para_no WHERE e.text <> '' AND contains(c.chunk_text, e.text)) WHERE n >= 2"
RULE_PROPERTIES = f"SELECT h.doc_id, h.para_no, h.chunk_no, lower(trim(l.text)) AS head_entity_text, concat(h.h.value, h.h.unit) AS tail_entity_text, 'EXHIBITS_PROPERTY' AS relation_type, h.seq AS hit_no, l.entity_seq FROM ({PROPERTY_HITS.format(lists=_property_lists(RELATION_PROPERTIES))}) h JOIN ({LINKS}) l ON h.doc_id = l.doc_id AND h.para_no = l.para_no AND h.chunk_no = l.chunk_no AND h.h.name = lower(trim(l.text))"
RULE_TREATMENTS = f"SELECT h.doc_id, h.para_no, h.chunk_no, lower(trim(l.text)) AS head_entity_text, h.text AS tail_entity_text, 'UNDERGOES_TREATMENT' AS relation_type, h.seq AS hit_no, l.entity_seq FROM ({PROCESS_HITS.format(lists=_treatment_lists(RELATION_TREATMENTS))}) h JOIN ({LINKS}) l ON h.doc_id = l.doc_id AND h.para_no = l.para_no AND h.chunk_no = l.chunk_no AND contains(lower(h.text), lower(trim(l.text)))"
RULES = f"SELECT * FROM ({RULE_PROPERTIES}) UNION ALL SELECT * FROM ({RULE_TREATMENTS})"


def _links(t, chunks=None):
    return relations.link_entities_to_chunks(t("fx_chunks") if chunks is None else chunks, t("fx_entities"))


def _rules(t, links=None, chunks=None):
    """Relations by the rules; chunks and links are read twice, so they are tables."""
    chunks = materialize(t("fx_chunks")) if chunks is None else chunks
    links = materialize(_links(t, chunks)) if links is None else links
    return relations.rule_property_relations(chunks, links).unionByName(relations.rule_treatment_relations(chunks, links))


@query("r1_link_entities_to_chunks", f"SELECT doc_id, para_no, chunk_no, text, type, entity_seq FROM ({LINKS})")
def _(t):
    return _links(t).select("doc_id", "para_no", "chunk_no", "text", "type", "entity_seq")


@query("r2_rule_property_relations", f"SELECT doc_id, chunk_no, head_entity_text, tail_entity_text, relation_type, entity_seq FROM ({RULE_PROPERTIES})")
def _(t):
    chunks = materialize(t("fx_chunks"))
    return relations.rule_property_relations(chunks, _links(t, chunks)).select("doc_id", "chunk_no", "head_entity_text", "tail_entity_text", "relation_type", "entity_seq")


@query("r3_rule_treatment_relations", f"SELECT doc_id, chunk_no, head_entity_text, tail_entity_text, relation_type, entity_seq FROM ({RULE_TREATMENTS})")
def _(t):
    chunks = materialize(t("fx_chunks"))
    return relations.rule_treatment_relations(chunks, _links(t, chunks)).select("doc_id", "chunk_no", "head_entity_text", "tail_entity_text", "relation_type", "entity_seq")


@query("r4_route_to_model", f"WITH e AS (SELECT doc_id, para_no, chunk_no, count(*) AS n_entities FROM ({LINKS}) GROUP BY ALL), r AS (SELECT doc_id, para_no, chunk_no, count(*) AS n FROM ({RULES}) GROUP BY ALL) SELECT e.doc_id, e.chunk_no, e.n_entities, coalesce(r.n, 0) AS n_relations FROM e LEFT JOIN r USING (doc_id, para_no, chunk_no) WHERE coalesce(r.n, 0) < e.n_entities / 2")
def _(t):
    chunks = materialize(t("fx_chunks"))
    links = materialize(_links(t, chunks))
    return relations.route_to_model(links, _rules(t, links, chunks)).select("doc_id", "chunk_no", "n_entities", "n_relations")


@query("r5_build_re_prompts", f"SELECT doc_id, chunk_no, replace(replace('{RE_TEMPLATE}', '{{text_segment}}', any_value(chunk_text)), '{{entities_list}}', string_agg('- ' || text || ' (' || type || ')', chr(10) ORDER BY entity_seq)) AS prompt FROM ({LINKS}) GROUP BY doc_id, para_no, chunk_no".replace("\n", "' || chr(10) || '") if "\n" in RE_TEMPLATE else None)
def _(t):
    return relations.build_re_prompts(t("fx_chunks"), _links(t), RE_TEMPLATE).select("doc_id", "chunk_no", "prompt")


@query("r6_parse_re_responses", "SELECT doc_id, chunk_no, head_entity_text, tail_entity_text, relation_type FROM fx_relations WHERE seq % 2 = 0 OR seq % 3 <> 0")
def _(t):
    return relations.parse_re_responses(t("fx_re_responses")).select("doc_id", "chunk_no", "head_entity_text", "tail_entity_text", "relation_type")


RELATION_COLUMNS = "doc_id, para_no, chunk_no, seq, head_entity_text, tail_entity_text, relation_type"
VALID = f"SELECT {RELATION_COLUMNS} FROM fx_relations r WHERE EXISTS (SELECT 1 FROM ({LINKS}) l WHERE l.doc_id = r.doc_id AND l.para_no = r.para_no AND l.chunk_no = r.chunk_no AND l.text = r.head_entity_text) AND EXISTS (SELECT 1 FROM ({LINKS}) l WHERE l.doc_id = r.doc_id AND l.para_no = r.para_no AND l.chunk_no = r.chunk_no AND l.text = r.tail_entity_text)"
UNKNOWN = f"SELECT {RELATION_COLUMNS} FROM fx_relations r WHERE NOT EXISTS (SELECT 1 FROM ({RULES}) k WHERE k.doc_id = r.doc_id AND k.para_no = r.para_no AND k.chunk_no = r.chunk_no AND k.head_entity_text = r.head_entity_text AND k.tail_entity_text = r.tail_entity_text)"


def _names(sql: str) -> list[str]:
    return sql.split(", ")


@query("r7_validate_relations", VALID)
def _(t):
    return relations.validate_relations(t("fx_relations"), _links(t)).select(*_names(RELATION_COLUMNS))


@query("r8_drop_known_pairs", UNKNOWN)
def _(t):
    return relations.drop_known_pairs(t("fx_relations"), _rules(t)).select(*_names(RELATION_COLUMNS))


@query("r9_combine_relations", f"SELECT doc_id, head_entity_text, tail_entity_text, relation_type, min(rank) AS rank FROM (SELECT doc_id, head_entity_text, tail_entity_text, relation_type, CAST(0 AS BIGINT) AS rank FROM ({RULES}) UNION ALL SELECT doc_id, head_entity_text, tail_entity_text, relation_type, 1 FROM fx_relations) GROUP BY ALL")
def _(t):
    t, plain = t.written("fx_rows"), ("doc_id", "chunk_no", "head_entity_text", "tail_entity_text", "relation_type")
    rule = _rules(t).select(*plain, "hit_no", "entity_seq")
    combined = relations.combine_relations(rule, t("fx_relations").select(*plain, "seq"))
    return _long(combined.select("doc_id", "head_entity_text", "tail_entity_text", "relation_type", "rank"), "rank")


@query("r10_fallback_cross_relations", """WITH free AS (SELECT doc_id FROM fx_entities GROUP BY doc_id HAVING count(*) > 1 EXCEPT SELECT doc_id FROM fx_relations WHERE doc_id % 5 <> 0)
SELECT DISTINCT a.doc_id, a.text AS head_entity_text, b.text AS tail_entity_text, 'EXHIBITS_PROPERTY' AS relation_type FROM fx_entities a JOIN fx_entities b ON a.doc_id = b.doc_id WHERE a.type = 'HeatTreatmentProcess' AND b.type = 'MechanicalProperty' AND a.doc_id IN (SELECT doc_id FROM free)""")
def _(t):
    return relations.fallback_cross_relations(t("fx_entities"), t("SELECT * FROM fx_relations WHERE doc_id % 5 <> 0")).drop("attributes")


@query("r11_resolve_multiple_relations", f"SELECT {RELATION_COLUMNS} FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, head_entity_text, tail_entity_text ORDER BY CASE relation_type WHEN 'HAS_COMPONENT' THEN 1 WHEN 'EXHIBITS_PROPERTY' THEN 2 WHEN 'UNDERGOES_TREATMENT' THEN 3 WHEN 'HAS_MICROSTRUCTURE' THEN 4 WHEN 'HAS_APPLICATION' THEN 5 WHEN 'INVESTIGATED_BY' THEN 6 ELSE 99 END, seq) AS nth FROM fx_relations) WHERE nth = 1")
def _(t):
    return relations.resolve_multiple_relations(t("fx_relations"), "priority").select(*_names(RELATION_COLUMNS))


@query("r12_tag_relation_source", f"SELECT {RELATION_COLUMNS}, 'n=' || CAST(seq AS VARCHAR) || ';source=rule' AS attributes FROM fx_relations")
def _(t):
    rows = t("fx_relations").withColumn("attributes", F.create_map(F.lit("source"), F.lit("LLM"), F.lit("n"), F.col("seq").cast("string")))
    return relations.tag_relation_source(rows, "rule").withColumn("attributes", map_text(F.col("attributes"))).select(*_names(RELATION_COLUMNS), "attributes")
