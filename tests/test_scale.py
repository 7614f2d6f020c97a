"""What holds where one document, prompt, node or text has most of the rows."""

import random
import re
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from spindlekg.functions.rows import running_sum
from spindlekg.functions.text import collapse_spaces, utrim
from spindlekg.operators import chunking, entities, layout, relations, search
from spindlekg.sources import scratch
from spindlekg.sources.responses import ResponseStore

# ---- answers are paid for once


def counting(path, answer=lambda p: f"<{p}>"):
    """A model that notes each prompt it is asked, in a file of its own for each call."""

    def ask(batch):
        import uuid

        for p in batch:
            with open(f"{path}/{uuid.uuid4().hex}", "w") as file:
                file.write(p)
        return [answer(p) for p in batch]

    return ask


def asked(path):
    return sorted(p.read_text() for p in path.iterdir())


def test_each_prompt_is_asked_once_over_runs_and_actions(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()
    store = ResponseStore(spark, f"file://{tmp_path}/store")
    prompts = spark.createDataFrame([(i, f"prompt {i % 7}") for i in range(40)] + [(99, None)], "n int, prompt string")
    found = entities.complete(prompts, counting(calls), store=store, per_write=2)
    assert found.count() == 41 and found.where("response = concat('<', prompt, '>')").count() == 40
    again = entities.complete(prompts.where("n < 20").union(spark.createDataFrame([(50, "new")], "n int, prompt string")), counting(calls), store=ResponseStore(spark, store.path))
    assert {r.prompt: r.response for r in again.collect()} == {p: f"<{p}>" for p in [*(f"prompt {i}" for i in range(7)), "new"]}
    assert asked(calls) == sorted([*(f"prompt {i}" for i in range(7)), "new"])


def test_two_actions_without_a_store_ask_once(spark, tmp_path):
    found = entities.complete(spark.createDataFrame([("a",), ("a",), ("b",)], "prompt string"), counting(tmp_path))
    assert found.count() == 3 and sorted(r.response for r in found.collect()) == ["<a>", "<a>", "<b>"]
    assert asked(tmp_path) == ["a", "b"]


def test_failed_prompts_are_asked_again_by_the_next_run_only(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()
    store = ResponseStore(spark, f"file://{tmp_path}/store")
    prompts = spark.createDataFrame([("good",), ("bad",)], "prompt string")
    first = entities.complete(prompts, counting(calls, lambda p: None if p == "bad" else "ok"), store=store)
    assert {(r.prompt, r.response, r.error) for r in first.collect()} == {("good", "ok", None), ("bad", "[]", "no answer")}
    assert first.count() == 2
    later = entities.complete(prompts, counting(calls, lambda p: "late"), store=store)
    assert {(r.prompt, r.response, r.error) for r in later.collect()} == {("good", "ok", None), ("bad", "late", None)}
    assert asked(calls).count("good") <= 2 and asked(calls).count("bad") <= 3


def test_a_prompt_that_most_rows_have(spark, tmp_path):
    rows = [(i, "hot" if i % 3 else f"p{i}") for i in range(6000)]
    prompts = spark.createDataFrame(rows, "n int, prompt string").withColumn("response", F.lit("clash"))
    found = entities.complete(prompts, counting(tmp_path), batch=500)
    assert found.where("response = concat('<', prompt, '>') AND error IS NULL").count() == 6000
    assert asked(tmp_path) == sorted({p for _, p in rows})


def test_whole_prompts_are_not_shuffled_to_meet_their_answers(spark):
    prompts = spark.createDataFrame([(i, f"prompt {i}") for i in range(50)], "n int, prompt string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = entities.complete(prompts.where("n >= 0"), lambda batch: batch)
        plan = found.where("error IS NULL")._jdf.queryExecution().executedPlan().toString()
        assert found.count() == 50
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    held = next(part for part in plan.split("SortMergeJoin")[1:])
    left = held[: held.index("FileScan")]
    assert "Bucketed: true" in held and "Exchange" not in left


# ---- running sums and layout over a split document


def test_running_sum_equals_one_window(spark):
    rnd = random.Random(1)
    rows = [(rnd.choice(["a", "b", None]), rnd.choice([None, 1, 2, 3]), i, rnd.randint(-3, 9)) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, page int, i int, v int")
    order = Window.partitionBy("k").orderBy("page", "i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = running_sum(df, ["k"], "page", ["i"], F.col("v"), "s").withColumn("want", F.sum("v").over(order))
    assert found.count() == 500 and found.where("s <> want").count() == 0


def test_one_long_document_is_ordered_by_pages(spark):
    n, pages = 60_000, 300
    blocks = spark.range(n).select(F.lit("d").alias("doc_id"), (F.col("id") % pages).cast("int").alias("page"), F.col("id").cast("int").alias("block_no"), F.lit("text").alias("text"), (F.lit(100.0) + F.floor(F.col("id") / pages) * 3).alias("y0"))
    blocks = blocks.withColumn("y1", F.col("y0") + F.when(F.col("block_no") % 11 == 0, 1.0).otherwise(2.9)).withColumn("page_height", F.lit(800.0))
    ordered = layout.order_blocks(blocks)
    order = Window.partitionBy("doc_id").orderBy("page", "y0", "block_no")
    assert ordered.withColumn("want", F.row_number().over(order)).where("want <> reading_order").count() == 0
    marked = layout.mark_paragraphs(ordered, gap_ratio=0.002)
    read = Window.partitionBy("doc_id").orderBy("reading_order")
    starts = F.lag("page").over(read).isNull() | (F.col("page") != F.lag("page").over(read)) | (F.col("y0") - F.lag("y1").over(read) > F.col("page_height") * 0.002)
    want = marked.withColumn("w", starts.cast("int")).withColumn("w", F.sum("w").over(read.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    assert want.where("w <> para_no").count() == 0 and marked.agg(F.max("para_no")).first()[0] > pages
    # as it is with blocks that are too many to be sent to every task
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        tasks = marked.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("count"), F.sum("para_no")).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(tasks) == 16 and max(r["count"] for r in tasks) < n / 5


def fold(parts, only_before_lower):
    text = ""
    for p in parts:
        if text == "":
            text = p
        elif text.endswith("-") and (not only_before_lower or (p[:1].isalpha() and p[:1].islower())):
            text = re.sub(r"\s*-$", "", text) + (p if only_before_lower else p.lstrip())
        else:
            text += " " + p
    return text


@pytest.mark.parametrize("only_before_lower", [True, False])
def test_joining_by_neighbours_equals_the_fold(spark, only_before_lower):
    rnd = random.Random(4)
    odd = ["abc", "Abc", "x-", "- ", "-", " -", "def -", "- ghi", "a-b", "", "", " ", "Y-  ", "  z", "e-", "--", "Ünd", "ünd", "a　-"]
    rows = [(i, [p for p in rnd.choices(odd, k=rnd.randint(1, 7)) if only_before_lower or p.strip()]) for i in range(1500)]
    df = spark.createDataFrame([r for r in rows if r[1]], "i int, parts array<string>")
    shown = collapse_spaces if only_before_lower else utrim
    got = {r.i: r.text for r in df.select("i", shown(layout._joined(F.col("parts"), only_before_lower)).alias("text")).collect()}
    tidy = lambda t: re.sub(r"\s+", " ", t).strip() if only_before_lower else t.strip()
    assert got == {i: tidy(fold(parts, only_before_lower)) for i, parts in rows if parts}


def test_a_paragraph_of_many_blocks(spark):
    n = 50_000
    blocks = spark.range(n).select(F.lit("d").alias("doc_id"), F.lit(1).alias("para_no"), F.lit(1).alias("page"), F.col("id").alias("reading_order"), F.lit("ab-").alias("text"), F.lit(1).alias("block_no"), F.lit(1.0).alias("y0"))
    assert layout.merge_paragraphs(blocks).select(F.length("text")).first()[0] == 2 * n + 1


# ---- chunks


def starts(lengths, most, least, gap):
    out, size, is_open = [], 0, False
    for i, n in enumerate(lengths):
        if is_open and size + n <= most:
            size += n + gap
        else:
            out.append(i)
            size = n
        is_open = least is None or size < least
    return out


@pytest.mark.parametrize("most, least, gap", [(2000, 500, 0), (2000, None, 2), (10, 1, 0)])
def test_chunk_starts_equal_a_plain_fold(spark, most, least, gap):
    rnd = random.Random(8)
    rows = [(i, [rnd.randint(1, 900) for _ in range(rnd.choice([0, 1, 5, 255, 256, 257, 700]))]) for i in range(40)]
    df = spark.createDataFrame(rows, "i int, n array<int>")
    got = {r.i: r.s for r in df.select("i", chunking.chunk_starts(F.col("n"), most, least, gap).alias("s")).collect()}
    assert got == {i: starts(n, most, least, gap) for i, n in rows}


def test_a_text_of_many_paragraphs(spark):
    df = spark.range(1).select(F.lit(1).alias("doc_id"), F.repeat(F.lit("some words of a paragraph\n\n"), 100_000).alias("text"))
    assert chunking.chunk_fixed(df).count() == 5000
    assert chunking.split_sections(df).agg(F.sum(F.length("chunk_text"))).first()[0] > 2_500_000


# ---- products and neighbourhoods


def test_a_heavy_product_is_made_in_tiles(spark):
    n = 1500
    side = lambda kind: spark.range(n).select(F.lit("d").alias("doc_id"), F.concat(F.lit(kind), "id").alias("text"), F.lit(kind).alias("type"))
    ents = side("A").union(side("B")).union(side("A")).union(spark.createDataFrame([("e", "x", "A"), ("e", "y", "B"), (None, "x", "A"), (None, "y", "B"), ("f", "x", "A"), ("f", "y", "B"), ("g", "y", "B")], "doc_id string, text string, type string"))
    rels = spark.createDataFrame([("f",)], "doc_id string")
    spark.conf.set("spark.sql.shuffle.partitions", "100")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pairs = relations.fallback_cross_relations(ents, rels, "A", "B", tile=64)
        parts = pairs.groupBy("doc_id", F.spark_partition_id().alias("p")).count().collect()
        assert pairs.where("doc_id = 'd'").drop("attributes").distinct().count() == n * n
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(r["count"] for r in parts if r.doc_id == "d") == n * n
    assert max(r["count"] for r in parts) < n * n / 30
    assert sorted((r.doc_id, r["count"]) for r in parts if r.doc_id != "d") == [("e", 1)]


def near_by(edges, seeds, hops):
    dist = dict.fromkeys(seeds, 0)
    for hop in range(1, hops + 1):
        for a, b in [*edges, *[(b, a) for a, b in edges]]:
            if dist.get(a) == hop - 1 and b not in dist:
                dist[b] = hop
    return dist


def test_kept_adjacency_serves_many_searches(spark, tmp_path):
    rnd = random.Random(6)
    pairs = [(rnd.randint(0, 300), rnd.randint(0, 300)) for _ in range(350)] + [(7, i) for i in range(400, 900)] + [(5, 5)]
    edges = spark.createDataFrame(pairs, "src long, dst long").withColumn("rel_type", F.lit("R"))
    near = search.adjacency(edges, f"file://{tmp_path}/near", shards=32)
    again = search.read_adjacency(edges, f"file://{tmp_path}/near")
    assert again.shards == near.shards == 32
    for seeds, hops in (([1], 3), ([2, 950], 2), ([7], 1), ([4], 0)):
        found = search.distances(edges, spark.createDataFrame([(s,) for s in seeds], "id long"), hops, again)
        assert {r.id: r.dist for r in found.collect()} == near_by(pairs, seeds, hops)


def test_a_hop_reads_only_the_shards_of_its_frontier(spark):
    edges = spark.range(500).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"), F.lit("R").alias("rel_type"))
    near = search.adjacency(edges, shards=64)
    few = near.next_to(spark.createDataFrame([(3,), (4,)], "id long"), 2)
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[shard#\d+ (IN|INSET)", plan) or "shard" in plan.split("PartitionFilters:")[1].split("]")[0]
    assert len(few.inputFiles()) > 2  # the plan's files before pruning
    assert sorted(r.id for r in few.collect()) == [2, 3, 4, 5]


def test_scopes_note_bucketed_tables(spark):
    with scratch.scope() as made:
        df = scratch.bucketed(spark.range(10).withColumn("k", F.col("id") % 3), "k")
        assert df.count() == 10
    assert len(made) == 1
    scratch.remove(spark, made)


# ---- rules


def test_texts_without_literals_give_nothing_and_others_all(spark):
    texts = ["nothing here 5 MPa", "ys 300 MPa and YS 4.5MPa", "Hardness: 90 HV 100HV", "伸长率12%", "T6 时效 then 固溶 处理", "500℃ for 2h", "KIC 30 MPa·m^0.5 fracture toughness 5MPa·m05", None, ""]
    df = spark.createDataFrame([("d", 0, i, t) for i, t in enumerate(texts)], "doc_id string, para_no int, chunk_no int, chunk_text string")
    for rules in (entities.PROPERTIES, relations.RELATION_PROPERTIES):
        got = df.select("chunk_no", F.explode(entities.property_hits(F.coalesce("chunk_text", F.lit("")), rules)).alias("h")).select("chunk_no", "h.*").collect()
        want = []
        for i, text in enumerate(texts):
            for n, rule in enumerate(rules):
                for m in re.finditer(rule.pattern.replace("(?iU)", "(?i)"), text or ""):
                    want.append((i, n, rule.name, m.group(0), m.group(2), rule.unit))
        assert sorted(map(tuple, got)) == sorted(want) and want
    found = df.select("chunk_no", F.explode(entities.treatment_hits(F.coalesce("chunk_text", F.lit("")), entities.TREATMENTS)).alias("h")).collect()
    assert sorted(map(tuple, found)) == [(4, "T6 时效"), (4, "固溶 处理"), (5, "500℃ for 2h")]


# ---- likeness of sentences


def lexical(text, window=3):
    """Chunks by whole numbers, straight from the rule."""
    import math
    from collections import Counter

    sentences = [s.strip() for s in text.split(".") if s.strip()]
    terms = [Counter(re.findall(r"[^\W_]+", s.lower())) for s in sentences]
    near = []
    for i in range(1, len(sentences)):
        left, right = sum(terms[max(0, i - window) : i], Counter()), sum(terms[i : i + window], Counter())
        size = math.sqrt(sum(n * n for n in left.values())) * math.sqrt(sum(n * n for n in right.values()))
        near.append(math.floor(sum(n * right[t] for t, n in left.items()) * 1_000_000.0 / size) if size else 0)
    n, total, squares = len(near), sum(near), sum(x * x for x in near)
    out = [sentences[:1]]
    for x, s in zip(near, sentences[1:]):
        over = total - n * x
        if over >= 0 and over * over >= n * squares - total * total:
            out.append([])
        out[-1].append(s)
    return [". ".join(c) + "." for c in out if c]


def test_lexical_chunks_equal_the_rule(spark, monkeypatch):
    from spindlekg.functions import rows

    monkeypatch.setattr(chunking, "STRETCH", 4)
    rnd = random.Random(3)
    topics = [["steel", "alloy", "yield", "a"], ["cat", "dog", "the", "a"], ["Ünd", "日本", "7", "a"]]
    texts = [". ".join(" ".join(rnd.choices(topics[(i // 6) % 3], k=rnd.randint(1, 6))) for i in range(rnd.choice([1, 2, 3, 20, 50]))) for _ in range(40)] + ["", None, "no end", "...", "-. -. -"]
    df = spark.createDataFrame(list(enumerate(texts)) + [(None, "one topic. one topic. two things. two things")], "doc_id long, text string")
    found = {}
    for r in chunking.chunk_documents(df, "similarity").orderBy("doc_id", "chunk_no").collect():
        found.setdefault(r.doc_id, []).append(r.chunk_text)
    want = {i: lexical(t) for i, t in [*enumerate(texts), (None, "one topic. one topic. two things. two things")] if t and lexical(t)}
    assert found == want
    assert rows.STRETCH == 4096


def test_similarity_over_many_stretches_equals_one(spark, monkeypatch):
    rnd = random.Random(12)
    data = [(d, i, f"s{i}", [rnd.random(), rnd.random() * (i % 9 == 0), rnd.random()]) for d in (1, 2, None) for i in range(200)]
    df = spark.createDataFrame(data, "doc_id long, seq int, sentence string, embedding array<double>")
    whole = sorted((str(r.doc_id), r.chunk_no, r.chunk_text) for r in chunking.chunk_by_similarity(df).collect())
    monkeypatch.setattr(chunking, "STRETCH", 7)
    assert sorted((str(r.doc_id), r.chunk_no, r.chunk_text) for r in chunking.chunk_by_similarity(df).collect()) == whole
    order = Window.partitionBy("doc_id").orderBy("seq")
    rows = df.withColumn("near", chunking.cosine(F.lag("embedding").over(order), F.col("embedding"))).withColumn("near", F.when(F.col("seq") > 0, F.col("near")))
    limit = F.avg("near").over(Window.partitionBy("doc_id")) - F.stddev_pop("near").over(Window.partitionBy("doc_id"))
    assert rows.withColumn("limit", limit).where("near <= limit").count() == len(whole) - 3


def test_pdf_names_the_sections(spark):
    df = spark.createDataFrame([("x", "Front\nABSTRACT\nshort\nMETHODS\nlong")], "doc_id string, text string")
    found = [(r.section_title, r.chunk_text) for r in chunking.chunk_documents(df, "pdf").orderBy("chunk_no").collect()]
    assert found == [("", "Front"), ("ABSTRACT", "short"), ("METHODS", "long")]


def test_threads_note_their_own_tables(spark):
    """Two pieces of work at once: neither has the other's tables in its scope, so neither removes them."""

    def work(n):
        with scratch.scope() as made:
            for _ in range(n):
                scratch.materialize(spark.range(3))
        return made

    with scratch.scope() as outer, ThreadPoolExecutor(2) as pool:
        scratch.materialize(spark.range(3))
        found = list(pool.map(work, (2, 3)))
    assert [len(outer), *map(len, found)] == [1, 2, 3] and len({*outer, *found[0], *found[1]}) == 6
    scratch.remove(spark, [*outer, *found[0], *found[1]])


def test_lexical_chunks_shuffle_nothing(spark):
    """A text's chunks come from its own row; its terms once went to disk six times each."""
    df = spark.createDataFrame([(1, "a b. c d. a b"), (2, None)], "doc_id long, text string")
    assert "Exchange" not in chunking.chunk_documents(df, "similarity")._jdf.queryExecution().executedPlan().toString()


def test_sections_shuffle_nothing(spark, tmp_path):
    """Headings are put between a document's lines in its own row; its lines once went to disk twice."""
    from spindlekg.plans.catalog import Source
    from spindlekg.plans.text_queries import _sectioned

    rows = [(1, "\n".join(f"line {i}" for i in range(30))), (2, ""), (3, None), (4, "a\n\nb")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    sectioned = _sectioned(Source(spark, str(tmp_path)))
    assert "Exchange" not in sectioned._jdf.queryExecution().executedPlan().toString()
    lines = lambda a, b: "\n\n".join(f"line {i}" for i in range(a, b))
    found = {r.doc_id: r.text for r in sectioned.collect()}
    assert found == {1: f"Front matter\nABSTRACT\n{lines(0, 12)}\nRESULTS\n1.1 Set up\n{lines(12, 24)}\nABSTRACT\n{lines(24, 30)}\n", 2: "Front matter\nABSTRACT\n\n", 4: "Front matter\nABSTRACT\na\n\n\n\nb\n"}


def test_writes_of_answers_are_small_however_large_a_bucket(spark):
    """All prompts fall into one bucket, whose file was one write, and one task, of any size."""
    store, kept = ResponseStore(spark), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        prompts = spark.range(100).selectExpr("id", "concat('p', id) AS prompt")
        found = entities.complete(prompts, lambda batch: [p.upper() for p in batch], store=store, per_write=10)
        assert {(r.id, r.response) for r in found.collect()} == {(i, f"P{i}") for i in range(100)}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)
    sizes = spark.read.parquet(store.path).where("digest IS NOT NULL").groupBy("batch").count().collect()
    assert sum(r["count"] for r in sizes) == 100 and max(r["count"] for r in sizes) <= 10
