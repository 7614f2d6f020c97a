"""Process chains: prompts per stage, answers in any of their shapes, step order, chain graphs, conditions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.patterns import PROCESS_KEYWORDS, STAGE_KEYS
from ..functions.rows import STRETCH, fresh, heavy_keys, running_sum, spread_join
from ..functions.text import is_json, utrim
from ..sources.scratch import materialize

COMPOSITION_NODE, NOT_GIVEN, PROPERTY = "合金成分", "未提供", "性能"
RAW_MATERIAL, FLOW, EFFECT = "原材料", "工艺流程", "影响"
ITEM = "struct<name: string, value: string, parameters: string, from: string, to: string, type: string, step: string>"


def stage_prompts(docs: DataFrame, stages: DataFrame, tables: DataFrame | None = None) -> DataFrame:
    """A prompt per document and stage: doc_id, stage, prompt.

    stages: stage, instruction, n_chars (of the text); few rows, joined to every document by exploding. tables: doc_id,
    table_no, row_no, cells (array), added as tab-separated lines under a heading per table.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    if tables is not None:
        line = F.struct("table_no", "row_no", F.array_join("cells", "\t").alias("line"))
        grouped = tables.withColumn("__r", line).groupBy("doc_id", "table_no").agg(F.array_join(F.transform(F.array_sort(F.collect_list("__r")), lambda r: F.concat(r["line"], F.lit("\n"))), "").alias("body"))
        joined = grouped.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("table_no", "body"))), lambda t: F.concat(F.lit("\n表格"), t["table_no"].cast("string"), F.lit(":\n"), t["body"])), "").alias("tables"))
        rows = rows.join(joined, "doc_id", "left")
    else:
        rows = rows.withColumn("tables", F.lit(""))
    few = stages.select("stage", "instruction", "n_chars").collect()  # the caller's list of stages, not data
    listed = F.array(*[F.struct(F.lit(s["stage"]).alias("stage"), F.lit(s["instruction"]).alias("instruction"), F.lit(int(s["n_chars"])).alias("n")) for s in few])
    made = rows.select("doc_id", "text", "tables", F.explode(listed).alias("s"))
    return made.select("doc_id", "s.stage", F.concat("s.instruction", F.lit("正文：\n"), F.substring(F.col("text"), F.lit(1), F.col("s.n")), F.lit("\n"), F.coalesce("tables", F.lit(""))).alias("prompt"))


def answer_keys(*keys: str) -> list[str]:
    """The keys, then each with its plural or singular, then the usual ones, each once: a fixed order."""
    other = [k[:-1] if k.endswith("s") else k + "s" for k in keys]
    return list(dict.fromkeys([*keys, *other, *STAGE_KEYS]))


def normalize_responses(answers: DataFrame, keys: Sequence[str], response_col: str = "response") -> DataFrame:
    """A row per item of each answer: the other columns, item_no from 0, item (JSON text).

    An answer may be an array, an object with one of the keys (of which the value is an array, an object, or JSON text
    in a string), or one relation with from, to and type; anything else gives none.
    """
    def as_array(json: Column) -> Column:
        mended = F.when(utrim(json).startswith("["), json).when(utrim(json).startswith("{"), F.concat(F.lit("["), json, F.lit("]")))
        return F.from_json(mended, "array<string>")

    text = F.col(response_col)
    valid = F.when(is_json(text), text)
    rest = [c for c in answers.columns if c != response_col]
    rows = answers.withColumn("__j", valid)
    keyed = F.coalesce(*[F.get_json_object("__j", f"$.{k}") for k in answer_keys(*keys)])
    rows = rows.withColumn("__v", keyed)
    inner = F.when(is_json(F.col("__v")), as_array(F.col("__v")))
    lone = F.get_json_object("__j", "$.from").isNotNull() & F.get_json_object("__j", "$.to").isNotNull() & F.get_json_object("__j", "$.type").isNotNull()
    items = F.when(utrim(F.col("__j")).startswith("["), as_array(F.col("__j"))).when(F.col("__v").isNotNull(), F.coalesce(inner, F.array("__v"))).when(lone, F.array("__j"))
    return rows.select(*rest, F.posexplode(items).alias("item_no", "item"))


def item_fields(items: DataFrame) -> DataFrame:
    """Items with their name, value, parameters, from, to, type and step as columns."""
    rest = [c for c in items.columns if c != "item"]
    return items.withColumn("__i", F.from_json("item", ITEM)).select(*rest, "__i.*")


def order_key(name: Column, step: Column | None, has_property: Column | None = None, keywords: Sequence[tuple[str, int]] = PROCESS_KEYWORDS) -> Column:
    """The step number, else that of the first keyword in the list that the name holds, else 99 with a property, else
    999."""
    lowered = F.lower(F.coalesce(name, F.lit("")))
    listed = F.array(*[F.struct(F.lit(k.lower()).alias("k"), F.lit(v).alias("v")) for k, v in keywords])
    by_name = F.get(F.filter(listed, lambda e: F.contains(lowered, e["k"])), 0)["v"]
    last = F.lit(999) if has_property is None else F.when(has_property, 99).otherwise(999)
    return F.coalesce(F.lit(None).cast("int") if step is None else step.try_cast("int"), by_name, last)


def infer_process_order(steps: DataFrame, keywords: Sequence[tuple[str, int]] = PROCESS_KEYWORDS) -> DataFrame:
    """steps (doc_id, seq, name, and step or property if known) with order_key and position from 1, stable by seq. Steps are
    sorted by order key and stretch of STRETCH numbers, so a long document is in several tasks."""
    step = F.col("step") if "step" in steps.columns else None
    prop = F.coalesce(F.col("property") != "", F.lit(False)) if "property" in steps.columns else None
    keyed = steps.withColumn("order_key", order_key(F.col("name"), step, prop, keywords))
    (stretch,) = fresh(keyed, "__stretch")
    keyed = keyed.withColumn(stretch, F.struct("order_key", F.floor(F.col("seq") / STRETCH).alias("part")))
    placed = running_sum(keyed, ["doc_id"], stretch, ["order_key", "seq"], F.lit(1), "position").drop(stretch)
    return placed.withColumn("position", F.col("position").cast("int"))


def property_label(name: Column, value: Column) -> Column:
    name = F.coalesce(name, F.lit(PROPERTY))
    return F.when(F.coalesce(value, F.lit("")) != "", F.concat(name, F.lit("\n"), value)).otherwise(name)


def chain_nodes(composition: DataFrame, steps: DataFrame, properties: DataFrame) -> DataFrame:
    """doc_id, node, kind, details: the composition in one node, each step, each property with its value. Of nodes with
    one name the last counts."""
    line = F.concat("name", F.lit(": "), F.coalesce("value", F.lit("")))
    comp = composition.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", line.alias("line")))), lambda x: x["line"]), "\n").alias("details"))
    made = comp.where("details <> ''").select("doc_id", F.lit(COMPOSITION_NODE).alias("node"), F.lit("composition").alias("kind"), "details", F.lit(0).alias("part"), F.lit(0).cast("long").alias("seq"))
    made = made.union(steps.select("doc_id", "name", F.lit("process"), F.coalesce("parameters", F.lit(NOT_GIVEN)), F.lit(1), F.col("seq").cast("long")))
    made = made.union(properties.select("doc_id", property_label(F.col("name"), F.col("value")), F.lit("property"), F.coalesce("value", F.lit("")), F.lit(2), F.col("seq").cast("long")))
    last = made.groupBy("doc_id", "node").agg(F.max_by(F.struct("kind", "details"), F.struct("part", "seq")).alias("l"))
    return last.select("doc_id", "node", "l.kind", "l.details")


def chain_edges(composition: DataFrame, ordered_steps: DataFrame, properties: DataFrame, given: DataFrame, nodes: DataFrame) -> DataFrame:
    """doc_id, src, dst, relationship. Given links (doc_id, seq, from_name, to_name, type) between known nodes; for
    documents without given links, composition to first step, step to step, and last step to every property. Of edges
    with the same ends the last counts."""
    known = nodes.select("doc_id", F.col("node"))
    listed = given.select("doc_id", F.col("from_name").alias("src"), F.col("to_name").alias("dst"), F.coalesce("type", F.lit(EFFECT)).alias("relationship"), F.lit(0).alias("part"), F.col("seq").cast("long").alias("seq"))
    for end in ("src", "dst"):
        listed = listed.join(known.withColumnRenamed("node", end), ["doc_id", end], "left_semi")
    listed = listed.select("doc_id", "src", "dst", "relationship", "part", "seq")
    free = materialize(ordered_steps.join(given.select("doc_id").distinct(), "doc_id", "left_anti").select("doc_id", "position", "name"))
    # positions are without gaps, so the next step is an equi-join away, and the last one is that without a next
    after = free.select("doc_id", (F.col("position") - 1).alias("position"), F.col("name").alias("next"), F.lit(True).alias("more"))
    linked = free.join(after, ["doc_id", "position"], "left")
    first = linked.where("position = 1").join(composition.select("doc_id").distinct(), "doc_id", "left_semi")
    raw = first.select("doc_id", F.lit(COMPOSITION_NODE).alias("src"), F.col("name").alias("dst"), F.lit(RAW_MATERIAL).alias("relationship"), F.lit(1).alias("part"), F.lit(0).cast("long").alias("seq"))
    flow = linked.where("more").select("doc_id", F.col("name").alias("src"), F.col("next").alias("dst"), F.lit(FLOW), F.lit(2), F.col("position").cast("long"))
    ends = linked.where("more IS NULL").select("doc_id", F.col("name").alias("src"))
    effect = properties.select("doc_id", property_label(F.col("name"), F.col("value")).alias("dst"), F.col("seq").cast("long").alias("seq")).join(ends, "doc_id").select("doc_id", "src", "dst", F.lit(EFFECT), F.lit(3), "seq")
    every = listed.union(raw).union(flow).union(effect)
    last = every.groupBy("doc_id", "src", "dst").agg(F.max_by("relationship", F.struct("part", "seq")).alias("relationship"))
    return last


def _number(text: Column, pattern: str, group: int) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit("")).try_cast("long")


def extract_conditions(df: DataFrame, col: str) -> DataFrame:
    """df with temp, time (first numbers with such a unit) and time_unit; null where there is none."""
    text = F.coalesce(F.col(col), F.lit(""))
    span = r"(?iU)(\d+)[ ]*(min|分钟|h|小时)"
    return df.withColumn("temp", _number(text, r"(?U)(\d+)[ ]*[°℃C]+", 1)).withColumn("time", _number(text, span, 1)).withColumn("time_unit", F.nullif(F.regexp_extract(text, span, 2), F.lit("")))


def condition_distance(a_temp: Column, a_time: Column, b_temp: Column, b_time: Column) -> Column:
    """Sum of differences over what both sides have; 9999 if a side has nothing, 0 if nothing is shared."""
    empty = (a_temp.isNull() & a_time.isNull()) | (b_temp.isNull() & b_time.isNull())
    return F.when(empty, F.lit(9999).cast("long")).otherwise(F.coalesce(F.abs(a_temp - b_temp), F.lit(0).cast("long")) + F.coalesce(F.abs(a_time - b_time), F.lit(0).cast("long")))


def _cell(name: str, width: int) -> Column:
    return F.expr(f"({name} - pmod({name}, {width}L)) div {width}L")


def _first_ids(rows: DataFrame, keys: Sequence[str], k: int) -> DataFrame:
    nth = Window.partitionBy(*keys).orderBy("id")
    return rows.select(*keys, "id").distinct().withColumn("nth", F.row_number().over(nth)).where(F.col("nth") <= k).drop("nth")


def nearest_conditions(left: DataFrame, right: DataFrame, k: int = 1, width: int = 16) -> DataFrame:
    """The k rows of right (id, temp, time) nearest to each row of left (id, temp, time) by condition_distance, ties by id:
    left_id, right_id, distance, rank. Every row of left has min(k, rows of right) rows.

    Equal conditions are one on either side until the end. What two conditions share decides where they are compared:
    both numbers, the temperature or the time. There, the numbers are cut into cells of a width, a condition meets the
    cells around its own, and is done once its k nearest lie within the width, since what it has not met is farther;
    the others go on with cells four times as wide. Conditions that share nothing, or of which one is empty, have
    constant distances, so the k smallest ids of each such kind are enough.
    """
    temp, time = F.col("temp"), F.col("time")
    has = {"both": temp.isNotNull() & time.isNotNull(), "temp": temp.isNotNull() & time.isNull(), "time": temp.isNull() & time.isNotNull(), "none": temp.isNull() & time.isNull()}
    place = lambda test, name, x, y: F.when(test, F.struct(F.lit(name).alias("space"), x.cast("long").alias("x"), y.cast("long").alias("y")))
    group = lambda test, name: F.when(test, F.lit(name))
    listed = lambda *items: F.explode(F.filter(F.array(*items), lambda i: i.isNotNull()))
    zero = F.lit(0)

    asked = left.groupBy("temp", "time").agg(F.count("*").alias("weight"))
    asks = materialize(asked.withColumn("ask", F.monotonically_increasing_id()))
    todo = asks.select("ask", listed(place(has["both"], "both", temp, time), place(has["both"], "temp", temp, zero), place(has["both"], "time", time, zero), place(has["temp"], "any temp", temp, zero), place(has["time"], "any time", time, zero)).alias("p")).select("ask", "p.*")
    offers = materialize(_first_ids(right, ("temp", "time"), k))
    spots = offers.select("id", listed(place(has["both"], "both", temp, time), place(has["temp"], "temp", temp, zero), place(has["time"], "time", time, zero), place(temp.isNotNull(), "any temp", temp, zero), place(time.isNotNull(), "any time", time, zero)).alias("p")).select("id", "p.*")

    # constant distances: at most k ids of each of four kinds
    fixed = offers.select("id", listed(F.lit("every"), group(has["none"], "empty"), group(has["time"], "time alone"), group(has["temp"], "temp alone")).alias("kind"))
    fixed = _first_ids(fixed, ("kind",), k)
    kinds = listed(group(has["none"], "every"), group(~has["none"], "empty"), group(has["temp"], "time alone"), group(has["time"], "temp alone"))
    found = asks.select("ask", kinds.alias("kind")).join(F.broadcast(fixed), "kind").select("ask", F.col("id").alias("right_id"), F.when(F.col("kind").endswith("alone"), 0).otherwise(9999).cast("long").alias("distance"))

    ends = todo.select("x", "y").union(spots.select("x", "y")).agg(*[f(c).alias(f"{n}_{c}") for c in ("x", "y") for n, f in (("low", F.min), ("high", F.max))]).first()
    span = max(((ends[f"high_{c}"] or 0) - (ends[f"low_{c}"] or 0) for c in ("x", "y")))
    nth = Window.partitionBy("ask", "space").orderBy("distance", "right_id")
    while True:
        step = lambda name: F.explode(F.sequence(F.lit(-1), F.lit(1))).alias(name)
        around = todo.select("ask", "space", "x", "y", step("i")).select("*", step("j")).select("ask", "space", "x", "y", (_cell("x", width) + F.col("i")).alias("cx"), (_cell("y", width) + F.col("j")).alias("cy"))
        within = spots.select("space", F.col("x").alias("rx"), F.col("y").alias("ry"), F.col("id").alias("right_id"), _cell("x", width).alias("cx"), _cell("y", width).alias("cy"))
        met = around.join(within, ["space", "cx", "cy"]).select("ask", "space", "right_id", (F.abs(F.col("x") - F.col("rx")) + F.abs(F.col("y") - F.col("ry"))).alias("distance"))
        top = materialize(met.withColumn("nth", F.row_number().over(nth)).where(F.col("nth") <= k).drop("nth"))
        if width > span:
            found = found.unionByName(top.drop("space"))
            break
        done = top.where(F.col("distance") <= width).groupBy("ask", "space").agg(F.count("*").alias("n")).where(F.col("n") >= k).drop("n")
        found = found.unionByName(top.join(done, ["ask", "space"], "left_semi").drop("space"))
        todo = materialize(todo.join(done, ["ask", "space"], "left_anti"))
        if todo.isEmpty():
            break
        width *= 4
    best = Window.partitionBy("ask").orderBy("distance", "right_id")
    top = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    at = F.to_json(F.struct("temp", "time")).alias("at")
    few = top.groupBy("ask").agg(F.collect_list(F.struct("right_id", "distance", "rank")).alias("t")).join(asks.select("ask", at, "weight"), "ask")
    few = materialize(few.select("at", "weight", "t"))
    joined = spread_join(left.select(F.col("id").alias("left_id"), at), few.drop("weight"), "at", heavy_keys(few, "at", "weight"))
    return joined.select("left_id", F.explode("t").alias("t")).select("left_id", "t.right_id", "t.distance", "t.rank")
