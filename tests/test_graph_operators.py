"""Golden and property cases for the graph, search, chains, summaries, files and streams."""

import json
import random

import pytest
from pyspark.sql import functions as F

from spindlekg.functions import rows
from spindlekg.operators import chains, graph, search, summary
from spindlekg.sources import files, scratch, tables
from spindlekg.streaming.imports import stream_import

ENTITY = "doc_id string, seq int, text string, type string, attributes map<string, string>"
def day(n):
    return F.expr(f"TIMESTAMP '2024-01-0{n} 00:00:00'")


RELATION = "doc_id string, seq int, head_entity_text string, tail_entity_text string, relation_type string"


def batch(spark):
    ents = spark.createDataFrame([("d1", 0, "A", "Alloy", {"k": "1", "x": "old"}), ("d1", 1, "A", "MaterialAlloy", {"k": "dup"}), ("d2", 0, "A", "合金", {"k": "2", "text": "evil"}), ("d1", 2, "T6", "工艺", None), ("d1", 3, "", "Alloy", None), ("d1", 4, "Z", "Gadget", None)], ENTITY)
    rels = spark.createDataFrame([("d1", 0, "A", "T6", "TREATED_BY"), ("d1", 1, "A", "T6", "UNDERGOES_TREATMENT"), ("d1", 2, "A", "nowhere", "HAS_PROPERTY"), ("d1", 3, "A", "T6", "AFFECTS_PROPERTY"), ("d1", 4, None, "T6", "TREATED_BY")], RELATION)
    return ents, rels


def test_import_normalises_upserts_and_counts(spark):
    ents, rels = batch(spark)
    g, stats = graph.import_batch(graph.empty_graph(spark), ents, rels, "b1", day(1))
    nodes = {(r.label, r.text): r for r in g.nodes.collect()}
    assert set(nodes) == {("MaterialAlloy", "A"), ("HeatTreatmentProcess", "T6")}
    assert nodes["MaterialAlloy", "A"].props == {"k": "2", "x": "old"} and nodes["MaterialAlloy", "A"].source_doc_id == "d2"
    assert [(r.head_text, r.rel_type, r.tail_text) for r in g.edges.collect()] == [("A", "UNDERGOES_TREATMENT", "T6")]
    assert stats.first().asDict() == {"entities_processed": 6, "entities_upserted": 3, "entity_errors": 2, "relations_processed": 5, "relations_upserted": 1, "relations_orphaned": 1, "status": "failed"}


def test_second_import_keeps_created_at_and_removes_nulls(spark):
    ents, rels = batch(spark)
    g, _ = graph.import_batch(graph.empty_graph(spark), ents, rels, "b1", day(1))
    again, _ = graph.import_batch(g, ents, rels, "b1", day(1))
    assert sorted(map(repr, again.nodes.collect())) == sorted(map(repr, g.nodes.collect()))
    new = spark.createDataFrame([("d3", 0, "A", "MaterialAlloy", {"x": None, "y": "3"})], ENTITY)
    later, _ = graph.import_batch(g, new, rels.limit(0), "b2", day(2))
    a = later.nodes.where("text = 'A'").first()
    assert a.props == {"k": "2", "y": "3"} and a.batch_id == "b2" and a.created_at < a.updated_at
    t6 = later.nodes.where("text = 'T6'").first()
    assert t6.batch_id == "b1" and t6.created_at == t6.updated_at
    back = graph.rollback_batch(later, "b2")
    assert [r.text for r in back.nodes.collect()] == ["T6"] and back.edges.count() == 0
    assert graph.rollback_report(later, back).first().asDict() == {"nodes_removed": 1, "edges_removed": 1}


def test_import_then_rollback_is_empty(spark):
    ents, rels = batch(spark)
    g, _ = graph.import_batch(graph.empty_graph(spark), ents, rels, "b", day(1))
    back = graph.rollback_batch(g, "b")
    assert back.nodes.count() == 0 and back.edges.count() == 0
    _, stats = graph.import_batch(graph.empty_graph(spark), ents.limit(0), rels.limit(0), "b", day(1))
    assert stats.first().status == "skipped"


def test_units_keep_one_character(spark):
    df = spark.createDataFrame([("d", 0, "500 °C", "30min", "R"), ("d", 1, "2小时", "x", "R"), ("d", 2, "x", "y", "R")], RELATION)
    found = {r.seq: r.attributes for r in graph.extract_relation_attributes(df).collect()}
    assert found == {0: {"temperature": "500°", "time": "30m"}, 1: {"time": "2小"}, 2: {}}


def test_status_update_keeps_the_rest(spark):
    history = spark.createDataFrame([("b", "import", "active", "s", None, "doc", "{}")], "batch_id string, operation string, status string, summary string, user_note string, doc_id string, stats string").withColumn("created_at", day(1)).withColumn("updated_at", day(1))
    row = graph.update_batch_status(history, history, "superseded", day(2)).first()
    assert (row.operation, row.status, row.summary, row.doc_id, row.stats) == ("import", "superseded", "s", "doc", "{}") and row.updated_at > row.created_at


NODES = [("p", "SourceDocument", "paper"), ("a", "MaterialAlloy", "6061"), ("t", "HeatTreatmentProcess", "T6"), ("m", "MechanicalProperty", "YS")]
EDGES = [("p", "a", "MENTIONED_IN"), ("a", "t", "UNDERGOES_TREATMENT"), ("t", "m", "EXHIBITS_PROPERTY"), ("a", "gone", "HAS_COMPONENT")]


@pytest.mark.parametrize("hops, n, e", [(0, 1, 0), (1, 2, 1), (2, 3, 2), (3, 4, 3), (9, 4, 3)])
def test_neighbourhoods_grow(spark, hops, n, e):
    nodes, edges = spark.createDataFrame(NODES, "id string, label string, text string"), spark.createDataFrame(EDGES, "src string, dst string, rel_type string")
    near, between = search.extract_subgraph(nodes, edges, search.search_nodes(nodes, "PAPER"), hops)
    assert (near.count(), between.count()) == (n, e)


def test_document_relations_have_directions(spark):
    nodes, edges = spark.createDataFrame(NODES, "id string, label string, text string"), spark.createDataFrame(EDGES, "src string, dst string, rel_type string")
    found = graph.document_relations(nodes, edges, "a").orderBy("neighbour_id").collect()
    assert [(r.direction, r.from_name, r.to_name) for r in found] == [("in", "paper", "a"), ("out", "a", "T6")]


def test_captions_are_cut(spark):
    df = spark.createDataFrame([("1", "x" * 60, ["Entity", "MaterialAlloy"], {"k": "v" * 120}), ("2", None, ["Entity"], {})], "id string, text string, labels array<string>, props map<string, string>")
    a, b = search.display_table(df).orderBy("id").collect()
    assert a.caption == "x" * 50 + "..." and a.main_label == "MaterialAlloy" and a.colour == "#add8e6" and len(a.shown_props["k"]) == 103
    assert b.caption == "2" and b.main_label == "Entity" and b.colour == "#ffcc99"


def test_stage_answers_in_every_shape(spark):
    shapes = ['[{"name": "A"}]', '{"compositions": [{"name": "A"}]}', '{"alloy_composition": {"name": "A"}}', '{"composition": "[{\\"name\\": \\"A\\"}]"}', '{"process_chain": [{"name": "A"}]}', "broken", '{"from": "a", "to": "b", "type": "t"}']
    df = spark.createDataFrame(list(enumerate(shapes)), "doc_id int, response string")
    found = chains.item_fields(chains.normalize_responses(df, ["composition", "alloy_compositions"])).orderBy("doc_id").collect()
    assert [(r.doc_id, r.name) for r in found] == [(0, "A"), (1, "A"), (2, "A"), (3, "A"), (6, None)] and found[-1]["from"] == "a"


def test_chain_of_a_document_without_links(spark):
    comp = spark.createDataFrame([("d", 0, "Mg", "0.9"), ("d", 1, "Si", None)], "doc_id string, seq int, name string, value string")
    steps = spark.createDataFrame([("d", 0, "annealing", None), ("d", 1, "water quench", "cold"), ("d", 2, "??", "x"), ("d", 3, "first", "y")], "doc_id string, seq int, name string, parameters string").withColumn("step", F.when(F.col("seq") == 3, "0"))
    props = spark.createDataFrame([("d", 0, "YS", "300"), ("d", 1, None, "")], "doc_id string, seq int, name string, value string")
    given = spark.createDataFrame([], "doc_id string, seq int, from_name string, to_name string, type string")
    ordered = chains.infer_process_order(steps)
    assert [r.name for r in ordered.orderBy("position").collect()] == ["first", "water quench", "annealing", "??"]
    nodes = chains.chain_nodes(comp, steps, props)
    assert {r.node: r.details for r in nodes.collect()}["合金成分"] == "Mg: 0.9\nSi: "
    edges = {(r.src, r.dst): r.relationship for r in chains.chain_edges(comp, ordered, props, given, nodes).collect()}
    assert edges == {("合金成分", "first"): "原材料", ("first", "water quench"): "工艺流程", ("water quench", "annealing"): "工艺流程", ("annealing", "??"): "工艺流程", ("??", "YS\n300"): "影响", ("??", "性能"): "影响"}


def test_conditions_and_their_distance(spark):
    df = spark.createDataFrame([(1, "545 ℃/45min"), (2, "190C 12 H"), (3, "30分钟"), (4, ""), (5, "0.35Cu")], "id int, p string")
    asked = chains.extract_conditions(df, "p")
    assert [(r.temp, r.time) for r in asked.orderBy("id").collect()] == [(545, 45), (190, 12), (None, 30), (None, None), (35, None)]
    right = spark.createDataFrame([(10, 540, 40), (11, 545, 100), (12, None, 31)], "id int, temp long, time long")
    found = {r.left_id: (r.right_id, r.distance) for r in chains.nearest_conditions(asked, right).collect()}
    assert found == {1: (10, 10), 2: (12, 19), 3: (12, 1), 4: (10, 9999), 5: (12, 0)}


def plain_distance(a, b):
    if a == (None, None) or b == (None, None):
        return 9999
    return sum(abs(x - y) for x, y in zip(a, b, strict=True) if x is not None and y is not None)


@pytest.mark.parametrize(("k", "width"), [(1, 16), (3, 1), (5, 4)])
@pytest.mark.parametrize("spread", [9, 2000, 10**12])
def test_nearest_conditions_equal_brute_force(spark, k, width, spread):
    rng = random.Random(spread + k)
    pick = lambda: None if rng.random() < 0.2 else rng.randrange(spread) // rng.choice((1, 1, 50))
    left, right = [(i, pick(), pick()) for i in range(60)], [(i, pick(), pick()) for i in range(40)]
    left += [(60, 500, 0), (61, 900, 10), (62, 500, None), (63, -40, 7), (63, -40, 7)]
    right += [(40, 540, 1000), (41, 650, 0), (42, None, 5), (42, None, 5)]
    schema = "id long, temp long, time long"
    got = chains.nearest_conditions(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), k, width).collect()
    want = []
    for i, *a in left:
        ranked = sorted({(plain_distance(tuple(a), tuple(b)), j) for j, *b in right})[:k]
        want += [(i, j, d, n + 1) for n, (d, j) in enumerate(ranked)]
    assert sorted(tuple(r) for r in got) == sorted(want)


def test_nearest_conditions_of_nothing(spark):
    some, none = spark.createDataFrame([(1, 5, 6)], "id long, temp long, time long"), spark.createDataFrame([], "id long, temp long, time long")
    assert chains.nearest_conditions(some, none).count() == chains.nearest_conditions(none, some).count() == chains.nearest_conditions(none, none).count() == 0


def test_rows_of_heavy_keys_are_joined_whole(spark):
    many = spark.range(5000).select("id", F.when(F.col("id") < 4000, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("a.b"), F.lit("x").alias("__part"))
    few = many.groupBy("`a.b`").agg(F.count("*").alias("n"), F.max("id").alias("top")).where("`a.b` <> 'k7'")
    plain = many.withColumnRenamed("a.b", "k")
    few = few.withColumnRenamed("a.b", "k")
    heavy = rows.heavy_keys(few, "k", "n", shares=8, least=10)
    assert [(r.k, r.parts) for r in heavy.collect()] == [("hot", 7)]
    for how in ("inner", "left"):
        got = rows.spread_join(plain, few.drop("n"), "k", heavy, how)
        want = plain.join(few.drop("n"), "k", how)
        assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert rows.heavy_keys(few, "k", "n", shares=1) is None


def test_summaries(spark):
    log = spark.createDataFrame([("b", 0, "LLM 失败: 2"), ("a", 1, "LLM失败: 1"), ("a", 0, ""), ("a", 2, "Other")], "file string, line_no int, line string")
    n, first = summary.model_failures(log, 1)
    assert n.first().n == 2 and first.first().line == "LLM失败: 1"
    ents = spark.createDataFrame([("d", "T"), ("d", None)], "doc_id string, type string")
    rels = spark.createDataFrame([], "doc_id string, relation_type string")
    assert {r.warning for r in summary.quality_warnings(ents, rels, n).collect()} == {"too few entities", "too few relations", "model failures"}
    record = summary.kg_summary(ents, rels, log).first()
    assert record.entity_types == {"T": 1, "Unknown": 1} and record.relation_types == {} and record.model_failures == 2
    docs = spark.createDataFrame([("d",), ("e",)], "doc_id string")
    assert summary.overall_summary(summary.document_summary(docs, ents, rels)).first().asDict() == {"total": 2, "completed": 1, "failed": 1, "entities": 2, "relations": 0}


def test_exports_are_read_and_broken_files_skipped(spark, tmp_path):
    (tmp_path / "p1_entities.json").write_text(json.dumps([{"text": "A", "type": "T", "attributes": {"v": 1}}]), encoding="utf-8")
    (tmp_path / "p2_entities.json").write_text("[{", encoding="utf-8")
    (tmp_path / "p1_relations.json").write_text(json.dumps([{"head_entity_text": "A", "tail_entity_text": "B", "relation_type": "R"}]), encoding="utf-8")
    (tmp_path / "error_x.log").write_text("LLM: 失败\n\nOther: x\n", encoding="utf-8")
    ents, rels, log = files.read_kg_outputs(spark, str(tmp_path))
    assert [(r.doc_id, r.text) for r in ents.collect()] == [("p1", "A")] and [r.doc_id for r in rels.collect()] == ["p1"]
    assert [(r.line_no, r.line) for r in log.orderBy("line_no").collect()] == [(0, "LLM: 失败"), (1, ""), (2, "Other: x")]


def test_document_ids_have_no_extension(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.y.pdf").write_bytes(b"1")
    (tmp_path / "b.txt").write_bytes(b"2")
    found = files.read_document_files(spark, str(tmp_path))
    assert [(r.doc_id, r.length) for r in found.collect()] == [("x.y", 1)]
    assert files.pending_documents(found, found).count() == 0 and files.pending_documents(found, found, force=True).count() == 1


def test_extractions_replace_only_their_own_buckets(spark, tmp_path):
    path = str(tmp_path / "e")
    files.write_extractions(spark.createDataFrame([("a", 1), ("b", 1)], "doc_id string, n int"), path)
    files.write_extractions(spark.createDataFrame([("a", 2)], "doc_id string, n int"), path)
    assert sorted(tuple(r) for r in files.read_extractions(spark, path).select("doc_id", "n").collect()) == [("a", 2), ("b", 1)]


def as_documents(ents, rels):
    some = lambda df, name: df.groupBy("doc_id").agg(F.collect_list(F.struct(*[c for c in df.columns if c != "doc_id"])).alias(name))
    return some(ents, "entities").join(some(rels, "relations"), "doc_id", "full")


def test_graph_versions_and_stream(spark, tmp_path):
    place = f"{tmp_path}/graph"
    docs = as_documents(*batch(spark))
    docs.where("doc_id = 'd1'").write.parquet(f"{tmp_path}/in")
    arriving = lambda: spark.readStream.schema(docs.schema).parquet(f"{tmp_path}/in")
    stream_import(arriving(), place, f"{tmp_path}/check").awaitTermination()
    first = tables.latest_version(spark, place)
    docs.where("doc_id = 'd2'").write.mode("append").parquet(f"{tmp_path}/in")
    stream_import(arriving(), place, f"{tmp_path}/check").awaitTermination()
    loaded = tables.read_graph(spark, place)
    a = loaded.nodes.where("text = 'A'").first()
    assert a.props == {"k": "2", "x": "old"} and tables.latest_version(spark, place) == first + 1
    assert [(r.head_text, r.rel_type, r.tail_text) for r in loaded.edges.collect()] == [("A", "UNDERGOES_TREATMENT", "T6")]
    history = {r.batch_id: r for r in tables.read_history(spark, place).collect()}
    assert sorted(history) == ["stream_000000000000", "stream_000000000001"] and json.loads(history["stream_000000000000"].stats)["relations_upserted"] == 1
    assert {r.status for r in history.values()} == {"failed", "completed"}
    stream_import(arriving(), place, f"{tmp_path}/other").awaitTermination()  # batch 0 again, without its checkpoint: skipped
    assert tables.latest_version(spark, place) == first + 1
    with pytest.raises(FileNotFoundError):
        tables.read_graph(spark, f"{tmp_path}/nothing")


def test_a_write_replaces_only_what_it_touches(spark, tmp_path):
    place = f"{tmp_path}/graph"
    ents, rels = batch(spark)
    old, _ = graph.import_batch(graph.empty_graph(spark), ents, rels, "b1", day(1))
    assert tables.write_graph(old, place, buckets=64) == 1
    bucket = old.nodes.where("text = 'A'").select(tables.bucket_of(64, "label", "text")).first()[0]
    only = {"nodes": {bucket}, "edges": set()}
    part = tables.read_graph(spark, place, only=only)
    assert part.edges.count() == 0 and [r.text for r in part.nodes.where("text in ('A', 'T6')").collect()] == ["A"]
    assert tables.write_graph(graph.Graph(part.nodes.withColumn("batch_id", F.lit("b2")), part.edges), place, touched=only) == 2
    new = tables.read_graph(spark, place)
    assert {(r.text, r.batch_id) for r in new.nodes.collect()} == {("A", "b2"), ("T6", "b1")} and new.edges.count() == 1
    assert {r.batch_id for r in tables.read_graph(spark, place, 1).nodes.collect()} == {"b1"}
    tables.remove_versions(spark, place, keep=1)
    assert tables.read_graph(spark, place).nodes.count() == 2 and tables.latest_version(spark, place) == 2
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        tables.read_graph(spark, place, 1)


def test_tables_of_a_scope_can_be_removed(spark):
    with scratch.scope() as outer:
        with scratch.scope() as made:
            table = scratch.materialize(spark.range(5))
        kept = scratch.materialize(table)
    assert len(made) == len(outer) == 1 and table.count() == 5
    scratch.remove(spark, made)
    assert kept.count() == 5
    with pytest.raises(Exception, match="does not exist|PATH_NOT_FOUND"):
        spark.read.parquet(made[0]).count()


def test_of_two_writers_of_a_version_one_wins(spark, tmp_path, monkeypatch):
    ents, rels = batch(spark)
    place = f"file://{tmp_path}/graph"
    g, _ = graph.import_batch(graph.empty_graph(spark), ents, rels, "b1", day(1))
    assert tables.write_graph(g, place) == 1
    told = spark.createDataFrame([("mine", "completed")], "batch_id string, status string")
    seen = tables.latest_version

    def overtaken(session, path):
        """The version before is read, and then another write is done."""
        found = seen(session, path)
        monkeypatch.setattr(tables, "latest_version", seen)
        assert tables.write_graph(graph.Graph(g.nodes.limit(1), g.edges.limit(0)), path, spark.createDataFrame([("theirs",)], "batch_id string")) == 2
        return found

    for exists in (True, False):  # whether the other's version is seen before the rename, or stands in its way
        monkeypatch.setattr(tables, "latest_version", overtaken if exists else lambda *_: 1)
        if not exists:
            files_ = tables._files

            class Blind:
                def __init__(self, system):
                    self.system = system

                def exists(self, path):
                    return False

                def __getattr__(self, name):
                    return getattr(self.system, name)

            monkeypatch.setattr(tables, "_files", lambda s, p: (lambda f, at: (Blind(f), at))(*files_(s, p)))
        with pytest.raises(tables.Conflict):
            tables.write_graph(g, place, told)
        monkeypatch.undo()
        assert tables.latest_version(spark, place) == 2 and tables.read_graph(spark, place).nodes.count() == 1
        assert [r.batch_id for r in tables.read_history(spark, place).collect()] == ["theirs"]
        assert len(list((tmp_path / "graph" / "data").iterdir())) == 2 and not [p for p in (tmp_path / "graph" / "versions").rglob("_*") if p.is_dir() and p.name != "_temporary"]


def test_data_of_a_write_that_died_is_removed(spark, tmp_path):
    ents, rels = batch(spark)
    place = f"file://{tmp_path}/graph"
    g, _ = graph.import_batch(graph.empty_graph(spark), ents, rels, "b1", day(1))
    tables.write_graph(g, place)
    g.nodes.write.parquet(f"{place}/data/dead/nodes")
    g.nodes.write.parquet(f"{place}/versions/_dead/list")
    tables.remove_versions(spark, place)
    assert (tmp_path / "graph/data/dead").exists()  # it may still be written
    tables.remove_versions(spark, place, unlisted_after=-1)
    assert not (tmp_path / "graph/data/dead").exists() and not (tmp_path / "graph/versions/_dead").exists()
    assert tables.read_graph(spark, place).nodes.count() == 2


def test_a_batch_writes_its_own_history_row_only(spark, tmp_path):
    place = f"file://{tmp_path}/graph"
    for n in range(12):
        row = spark.createDataFrame([(f"b{n % 10}", "completed" if n < 10 else None, f"note {n}")], "batch_id string, status string, user_note string").withColumn("created_at", day(1 + n // 3))
        tables.write_graph(graph.empty_graph(spark), place, row, buckets=4)
    sizes = [sum(f.stat().st_size for f in (tmp_path / "graph/versions").glob(f"version={v:08d}/history/*.parquet")) for v in (2, 12)]
    assert abs(sizes[0] - sizes[1]) < 100
    tables.remove_versions(spark, place, keep=1)
    found = {r.batch_id: r for r in tables.read_history(spark, place).collect()}
    assert len(found) == 10 and found["b1"].status == "completed" and found["b1"].user_note == "note 11" and found["b1"].created_at.day == 1
    assert tables.read_history(spark, place, 3).count() == 3
    assert tables.latest_version(spark, place) == 12


def test_buckets_follow_the_size_of_a_whole_graph(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "ROWS_PER_BUCKET", 10)
    some = lambda n: graph.Graph(graph.empty_graph(spark).nodes.unionByName(spark.range(n).select(F.lit("L").alias("label"), F.col("id").cast("string").alias("text")), allowMissingColumns=True), graph.empty_graph(spark).edges)
    place = f"file://{tmp_path}/graph"
    for n, buckets in ((0, 1), (45, 5), (300, 30)):
        version = tables.write_graph(some(n), place)
        assert tables.bucket_count(spark, place, version) == buckets and tables.read_graph(spark, place).nodes.count() == n
    only = {"nodes": {3}, "edges": set()}
    part = tables.read_graph(spark, place, only=only)
    assert 0 < part.nodes.count() < 60
    tables.write_graph(graph.Graph(part.nodes.limit(0), part.edges), place, touched=only)
    assert tables.read_graph(spark, place).nodes.count() == 300 - part.nodes.count()


def test_lines_of_a_log_in_many_blocks_are_numbered(spark, tmp_path):
    lines = [f"line {i}" + ("\r" if i % 5 == 0 else "") if i % 7 else "" for i in range(3000)]
    (tmp_path / "error_a.log").write_text("\n".join(lines) + "\n", newline="")
    (tmp_path / "error_b.log").write_text("one\n\ntwo", newline="")
    (tmp_path / "error_c.log").write_text("", newline="")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    try:
        read = files.read_error_logs(spark, f"{tmp_path}/error_*.log")
        assert spark.read.text(f"{tmp_path}/error_a.log").rdd.getNumPartitions() > 8
        found = sorted((r.file, r.line_no, r.line) for r in read.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = [("error_a.log", i, x.rstrip("\r")) for i, x in enumerate(lines)] + [("error_b.log", i, x) for i, x in enumerate(["one", "", "two"])]
    assert found == sorted(want)


def test_a_log_of_many_kinds_gives_a_short_record(spark):
    log = spark.range(20_000).select(F.lit("f").alias("file"), F.col("id").alias("line_no"), F.concat("id", F.lit(": x")).alias("line"))
    log = log.union(spark.range(500).select(F.lit("f"), F.col("id"), F.concat(F.lit("kind "), F.col("id") % 5, F.lit(": LLM 失败"))))
    none = spark.createDataFrame([], "type string, relation_type string")
    found = summary.kg_summary(none, none, log, kinds=8).first()
    assert len(found.errors) == 8 and all(found.errors[f"kind {i}"] == 100 for i in range(5))
    assert sum(found.errors.values()) + found.other_errors == 20_500 and found.other_errors == 19_997
    assert found.model_failures == 500 and found.entity_types == {}
    empty = summary.kg_summary(none, none, log.limit(0)).first()
    assert empty.errors == {} and empty.other_errors == 0


def test_a_summary_holds_every_kind(spark):
    kinds = {f"kind {i}": 1 + i % 3 for i in range(1500)}
    log = spark.createDataFrame([("f", i, f"{kind}: x") for i, kind in enumerate(k for k, n in kinds.items() for _ in range(n))], "file string, line_no int, line string")
    ents = spark.range(450).select(F.concat(F.lit("t"), F.col("id") % 150).alias("type"))
    rels = spark.range(120).select(F.concat(F.lit("r"), "id").alias("relation_type"))
    want = {"entity_types": {f"t{i}": 3 for i in range(150)}, "relation_types": {f"r{i}": 1 for i in range(120)}, "errors": kinds}
    record = summary.kg_summary(ents, rels, log).first()
    assert {part: record[part] for part in want} == want and record.other_errors == 0
    record = summary.kg_summary(ents, rels, log, text=True).first()
    assert {part: record[part] for part in want} == {part: ";".join(f"{k}={n}" for k, n in sorted(held.items())) for part, held in want.items()}
    empty = summary.kg_summary(ents.limit(0), rels.limit(0), log.limit(0), text=True).first()
    assert (empty.entity_types, empty.errors, empty.model_failures, empty.failure_samples) == (None, None, 0, [])


def test_views_of_a_written_view_read_its_table(spark, tmp_path):
    """Four branches of the entities each ordered all rows anew."""
    from spindlekg.plans.catalog import Source

    t = Source(spark, "/root/testdata/sf0.001")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan(t("fx_entities")) and "Window" not in plan(t.written("fx_rows")("fx_entities"))
    assert t.written("fx_rows")("fx_relations").exceptAll(t("fx_relations")).isEmpty()


def test_record_keys_are_digests_of_32_bytes(spark):
    from spindlekg.operators.entities import record_key

    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert [len(r[0]) for r in df.select(record_key(df, ["text"])).collect()] == [32]


def test_properties_are_taken_apart_after_the_last_rows_are_known(spark):
    """Rows of one key with the same names of properties: all but the last were taken apart, too."""
    from spindlekg.operators.graph import _reduce

    rows = [("t", "x", {"a": str(i)} | ({"b": str(i)} if i % 2 else {}) | ({"c": None} if i == 7 else {}), "new", str(i), i, 0) for i in range(9)]
    df = spark.createDataFrame(rows, "label string, text string, props map<string,string>, batch_id string, source_doc_id string, doc_id long, seq long")
    found = _reduce(df, ("label", "text"), ("doc_id", "seq"))
    assert [(r.props, r.batch_id, r.source_doc_id) for r in found.collect()] == [({"a": "8", "b": "7", "c": None}, "new", "8")]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" in plan[plan.index("Generate") :]


def test_stream_import_leaves_no_scratch_tables(spark, tmp_path, monkeypatch):
    """The tables of every batch stayed in the shared folder for as long as the stream ran."""
    import os

    from spindlekg.sources import scratch, tables
    from spindlekg.streaming.imports import stream_import

    monkeypatch.setattr(scratch, "shared_dir", lambda _: f"{tmp_path}/shared")
    kind = "doc_id long, entities array<struct<seq: long, text: string, type: string>>, relations array<struct<seq: long, head_entity_text: string, tail_entity_text: string, relation_type: string>>"
    spark.createDataFrame([(1, [(1, "A", "Alloy"), (2, "x", "MechanicalProperty")], [(1, "A", "x", "HAS_PROPERTY")])], kind).write.parquet(f"{tmp_path}/in")
    stream_import(spark.readStream.schema(kind).parquet(f"{tmp_path}/in"), f"{tmp_path}/graph", f"{tmp_path}/checkpoint").awaitTermination()
    assert tables.read_graph(spark, f"{tmp_path}/graph").edges.count() == 1
    assert os.listdir(f"{tmp_path}/shared/spindlekg") == []


def test_json_records_may_be_gzipped(spark, tmp_path):
    import gzip

    from spindlekg.sources import files

    (tmp_path / "g1_entities.json.gz").write_bytes(gzip.compress(b'[{"text": "A", "type": "Alloy"}]'))
    (tmp_path / "a.b_entities.json").write_bytes(b'[{"text": "B", "type": "Alloy"}]')
    found = files.read_json_records(spark, f"{tmp_path}/*_entities.json*", files.ENTITY_SCHEMA, "_entities")
    assert sorted((r.doc_id, r.text) for r in found.collect()) == [("a.b", "B"), ("g1", "A")]
