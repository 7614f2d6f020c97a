"""Golden cases for layout, chunking, entities and relations."""

import pytest
from pyspark.sql import functions as F

from spindlekg.operators import chunking, entities, layout, relations


def one(df):
    return [tuple(r) for r in df.collect()]


def test_layout_two_pages(spark):
    rows = [
        ("d", 1, 0, "Header", 10.0, 30.0),
        ("d", 1, 1, "A first para-", 100.0, 110.0),
        ("d", 1, 2, "graph goes　 on.", 112.0, 122.0),
        ("d", 1, 3, "A second one", 150.0, 160.0),
        ("d", 1, 4, "Footer", 790.0, 799.0),
        ("d", 2, 0, "after a page.", 100.0, 110.0),
        ("d", 2, 1, "Hyphen-", 112.0, 118.0),
        ("d", 2, 2, "Upper", 120.0, 130.0),
        ("d", 2, 3, None, 131.0, 140.0),
        ("e", None, 0, "no page", 100.0, 110.0),
    ]
    blocks = spark.createDataFrame([(*r, 800.0) for r in rows], "doc_id string, page int, block_no int, text string, y0 double, y1 double, page_height double")
    merged = layout.paragraphs(blocks)
    assert sorted(one(merged.select("para_no", "page", "text"))) == [(1, 1, "A first paragraph goes on."), (2, 1, "A second one"), (3, 2, "after a page. Hyphen- Upper")]
    nested = layout.nest_document(merged).first()
    assert len(nested.sections) == 1 and len(nested.sections[0].paragraphs) == 3
    docs = spark.createDataFrame([("d",), ("e",)], "doc_id string")
    assert sorted(one(layout.paragraph_counts(docs, merged))) == [("d", 3, False), ("e", 0, True)]


def test_spans_become_blocks(spark):
    spans = spark.createDataFrame(
        [("d", 1, 0, 0, 0, " al", 0), ("d", 1, 0, 0, 1, "loy- ", 0), ("d", 1, 0, 1, 0, "  ", 0), ("d", 1, 0, 2, 0, "steel-", 0), ("d", 1, 0, 3, 0, " making", 0), ("d", 1, 1, 0, 0, " ", 0), ("d", 1, 2, 0, 0, "image", 1)],
        "doc_id string, page int, block_no int, line_no int, span_no int, text string, block_type int",
    )
    assert one(layout.assemble_blocks(spans).select("block_no", "text")) == [(0, "alloy-  steelmaking")]


def test_fixed_chunks_are_greedy_and_never_cut(spark):
    text = "\n\n".join(["a" * 300, "b" * 300, "c" * 2500, " ", "d" * 10])
    found = chunking.chunk_fixed(spark.createDataFrame([("x", text), ("empty", ""), ("none", None)], "doc_id string, text string"))
    assert [(r.chunk_no, len(r.chunk_text)) for r in found.orderBy("chunk_no").collect()] == [(0, 602), (1, 2500), (2, 10)]


@pytest.mark.parametrize("size", [1, 500, 2000])
def test_chunks_keep_every_part(spark, size):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", F.replace("text", F.lit("\n"), F.lit("\n\n")).alias("text"))
    joined = chunking.chunk_fixed(docs, min_size=size).groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk_no", "chunk_text"))), lambda x: x["chunk_text"]), "\n\n").alias("again"))
    parts = docs.select("doc_id", F.array_join(F.filter(F.transform(F.split("text", "\n\n"), lambda p: F.trim(p)), lambda p: p != ""), "\n\n").alias("want"))
    assert joined.join(parts, "doc_id").where("again <> want").count() == 0


def test_sections_pair_titles_with_their_bodies(spark):
    text = "Front\nABSTRACT\nshort\nINTRODUCTION\n1.1 Why\nbecause\n1.2 How\nso\n\nand so\nMETHODS\n\nREFERENCES\nlist"
    found = chunking.split_sections(spark.createDataFrame([("x", text), ("plain", "no heading")], "doc_id string, text string"))
    assert [tuple(r) for r in found.where("doc_id = 'x'").orderBy("chunk_no").select("section_title", "chunk_text").collect()] == [("", "Front"), ("ABSTRACT", "short"), ("INTRODUCTION 1.1 Why", "because"), ("INTRODUCTION 1.2 How", "so\n\nand so"), ("REFERENCES", "list")]
    assert one(found.where("doc_id = 'plain'").select("section_title", "chunk_text")) == [("", "no heading")]


def test_two_sentences_always_split_and_one_never_does(spark):
    rows = [("two", 0, "a", [1.0, 0.0]), ("two", 1, "b", [1.0, 0.1]), ("one", 0, "c", [1.0, 0.0])]
    found = chunking.chunk_by_similarity(spark.createDataFrame(rows, "doc_id string, seq int, sentence string, embedding array<double>"))
    assert sorted(one(found.select("doc_id", "chunk_text"))) == [("one", "c."), ("two", "a."), ("two", "b.")]


ANSWERS = {
    "object": ('{"entities": [{"text": "A", "type": "T"}]}', ["A"]),
    "one item": ('{"entities": {"text": "A", "type": "T"}}', ["A"]),
    "array": ('[{"text": "A", "type": "T", "attributes": {"v": 1}}, {"text": "no type"}]', ["A"]),
    "lone": ('{"text": "A", "type": "T"}', ["A"]),
    "fenced": ('```json\n[{"text": "A", "type": "T"}]\n```', ["A"]),
    "bare list": ('{"text": "A", "type": "T"}, {"text": "B", "type": "T"},', ["A", "B"]),
    "cut": ('[{"text": "A", "type": "T"}, {"text": "B", "ty', ["A"]),
    "by line": ('x\n{"text": "A", "type": "T", "attributes": {"k": "v"}},\n{"text": 1}', ["A"]),
    "other key": ('{"identified_entities_json": [{"text": "A", "type": "T"}]}', []),
    "hopeless": ("nothing here", []),
    "empty": ("", []),
}


@pytest.mark.parametrize("name", ANSWERS)
def test_entity_answers_in_every_shape(spark, name):
    response, want = ANSWERS[name]
    df = spark.createDataFrame([("c", "the chunk", response)], "chunk_id string, chunk_text string, response string")
    found = entities.parse_ner_responses(df).collect()
    assert [r.text for r in found] == want
    assert all(r.source_text == "the chunk" for r in found)


def test_null_answer_gives_nothing(spark):
    assert entities.parse_ner_responses(spark.createDataFrame([("c", None)], "chunk_id string, response string")).count() == 0


def test_rules_find_phrases_in_both_languages(spark):
    text = "The yield strength of 310 MPa, 硬度约120 HV, UTS=400MPa and elongation 12.5 %, after T6时效 and 固溶处理 at 500℃ for 2h. YS about more than ten characters 5 MPa"
    chunks = spark.createDataFrame([("d", 0, 0, text)], "doc_id string, para_no int, chunk_no int, chunk_text string")
    found = [(r.attributes["name"], r.attributes["value"], r.attributes["unit"]) for r in entities.extract_property_entities(chunks).orderBy("seq").collect()]
    assert found == [("屈服强度", "310", "MPa"), ("抗拉强度", "400", "MPa"), ("硬度", "120", "HV"), ("伸长率", "12.5", "%")]
    assert [r.text for r in entities.extract_process_entities(chunks).orderBy("seq").collect()] == ["T6时效", "固溶处理", "500℃ for 2h"]


def test_rule_entities_yield_to_the_model(spark):
    schema = "doc_id string, para_no int, chunk_no int, seq int, text string, type string"
    model = spark.createDataFrame([("d", 0, 0, 0, "T6", "H"), ("d", 0, 0, 1, "T6", "H")], schema)
    rule = spark.createDataFrame([("d", 0, 0, 0, "T6", "H"), ("d", 0, 0, 1, "X", "H"), ("d", 0, 0, 2, "X", "H"), ("d", 0, 1, 0, "T6", "H")], schema)
    assert sorted(one(entities.merge_entities(model, rule).select("chunk_no", "text", "rank"))) == [(0, "T6", 0), (0, "T6", 0), (0, "X", 1), (1, "T6", 1)]


def test_dedup_ignores_key_order_and_is_idempotent(spark):
    df = spark.createDataFrame([("d", 1, "A"), ("d", 2, "A"), ("e", 3, "A"), ("d", 4, None)], "doc_id string, seq int, text string")
    df = df.withColumn("attributes", F.when(F.col("seq") == 1, F.create_map(F.lit("a"), F.lit("1"), F.lit("b"), F.lit("2"))).otherwise(F.create_map(F.lit("b"), F.lit("2"), F.lit("a"), F.lit("1"))))
    once = entities.dedup_records(df)
    assert sorted(r.seq for r in once.collect()) == [1, 3, 4]
    assert sorted(r.seq for r in entities.dedup_records(once).collect()) == [1, 3, 4]


def test_prompts_take_braces_literally(spark):
    df = spark.createDataFrame([("  a {x}\n b ",), (None,)], "chunk_text string")
    assert [r.prompt for r in entities.build_ner_prompts(df, 'JSON {"k": 1}: {text_segment}').collect()] == ['JSON {"k": 1}: a {x} b', 'JSON {"k": 1}: 无内容']
    assert entities.build_ner_prompts(df, "no place").first().prompt == "no place\n\n文本片段:\na {x} b"


def test_failed_completion_is_an_empty_answer(spark):
    def fail(batch):
        raise RuntimeError("no model")

    found = entities.complete(spark.createDataFrame([("p",), (None,)], "prompt string"), fail).collect()
    assert {(r.prompt, r.response, r.error) for r in found} == {("p", "[]", "RuntimeError: no model"), (None, "[]", "no prompt")}


def test_completion_of_the_wrong_length_is_asked_again_one_by_one(spark):
    def short(batch):
        if len(batch) > 1:
            return batch[:-1]
        return {"p3": [], "p4": [None]}.get(batch[0], batch)

    prompts = spark.createDataFrame([(f"p{i}", "mine", i) for i in range(6)] + [("p0", "mine", 9)], "prompt string, error string, n int").coalesce(1)
    found = {(r.n, r.response, r.error) for r in entities.complete(prompts, short).collect()}
    assert found == {(0, "p0", None), (1, "p1", None), (2, "p2", None), (3, "[]", "0 answers to one prompt"), (4, "[]", "no answer"), (5, "p5", None), (9, "p0", None)}


def test_first_rows_of_a_hot_key(spark):
    df = spark.range(20_000).select(F.lit("d").alias("doc_id"), (F.col("id") % 7).alias("k"), F.when(F.col("id") % 2 == 0, "same").otherwise("other").alias("text"), F.col("id").alias("seq"), F.lit(1).alias("__row"), F.lit(2).alias("__key"))
    assert sorted((r.seq, r["__row"], r["__key"]) for r in entities.dedup_records(df.drop("k")).collect()) == [(0, 1, 2), (1, 1, 2)]


KEYS = "doc_id string, para_no int, chunk_no int"


def test_relations_from_rules_and_model(spark):
    chunks = spark.createDataFrame([("d", 0, 0, "屈服强度约300 MPa after T6时效"), ("d", 1, 1, "alone")], f"{KEYS}, chunk_text string")
    ents = spark.createDataFrame([("d", 0, 0, "屈服强度", "P"), ("d", 0, 1, "t6", "H"), ("d", 0, 2, "T6", "H"), ("d", 1, 3, "alone", "P"), ("d", 0, 4, "", "P")], "doc_id string, para_no int, seq int, text string, type string")
    links = relations.link_entities_to_chunks(chunks, ents)
    assert sorted(r.text for r in links.collect()) == ["T6", "屈服强度"]
    rules = relations.rule_property_relations(chunks, links).unionByName(relations.rule_treatment_relations(chunks, links))
    assert sorted(one(rules.select("head_entity_text", "tail_entity_text", "confidence_score"))) == [("t6", "T6时效", 0.85), ("屈服强度", "300MPa", 0.9)]
    assert relations.route_to_model(links, rules).count() == 0
    assert "- 屈服强度 (P)\n- T6 (H)" in relations.build_re_prompts(chunks, links, "{entities_list} {text_segment}").first().prompt


@pytest.mark.parametrize("response, n", [('{"relations": [{"subject": "a", "object": "b", "relation_type": "R"}]}', 1), ('[{"head_entity_text": "a", "tail_entity_text": "b", "relation_type": "R"}]', 1), ('{"identified_entities_json": []}', 0), ('{"subject": "a", "object": "b"}', 0), ("broken [", 0)])
def test_relation_answers(spark, response, n):
    found = relations.parse_re_responses(spark.createDataFrame([(response,)], "response string")).collect()
    assert [(r.head_entity_text, r.tail_entity_text) for r in found] == [("a", "b")] * n


def test_strategies(spark):
    df = spark.createDataFrame([("d", 1, "a", "b", "ODD"), ("d", 2, "a", "b", "UNDERGOES_TREATMENT"), ("d", 3, "a", "b", "HAS_COMPONENT"), ("d", 4, "a", "c", "ODD")], "doc_id string, seq int, head_entity_text string, tail_entity_text string, relation_type string")
    assert sorted(r.seq for r in relations.resolve_multiple_relations(df, "priority").collect()) == [3, 4]
    assert relations.resolve_multiple_relations(df).count() == 4
    with pytest.raises(ValueError):
        relations.resolve_multiple_relations(df, "other")
    tagged = relations.tag_relation_source(df.withColumn("attributes", F.create_map(F.lit("source"), F.lit("x"))), "rule").first()
    assert tagged.attributes == {"source": "rule"}
