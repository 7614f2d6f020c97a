"""Entities from chunks: prompts and answers of a completion function, extraction rules, merging and deduplication."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from operator import or_

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.patterns import PROPERTIES, TREATMENTS, PropertyRule, TreatmentRule
from ..functions.rows import first_by, fresh, heavy_keys
from ..functions.text import canonical_map, collapse_spaces, is_json, utrim
from ..sources.responses import ResponseStore
from ..sources.scratch import bucketed, materialize

ENTITY = "struct<text: string, type: string, attributes: map<string, string>>"


def fill_template(template: str, values: dict[str, Column], fallback_heading: str) -> Column:
    """Put each value at its `{name}`, literally; what has no place in the template follows under a heading."""
    out = F.lit(template)
    for name, value in values.items():
        if f"{{{name}}}" in template:
            out = F.replace(out, F.lit(f"{{{name}}}"), value)
        else:
            out = F.concat(out, F.lit(f"\n\n{fallback_heading}:\n"), value)
    return out


def build_ner_prompts(chunks: DataFrame, template: str, empty: str = "无内容", heading: str = "文本片段") -> DataFrame:
    """chunks with `prompt`: the chunk's text, with white space collapsed, in the template."""
    text = collapse_spaces(F.coalesce("chunk_text", F.lit("")))
    return chunks.withColumn("prompt", fill_template(template, {"text_segment": F.when(text == "", empty).otherwise(text)}, heading))


def _asking(answer: Callable[[list[str]], list[str]], batch: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """The caller's function over rows (digest, prompt), in batches; see complete."""

    def one(prompt: str) -> tuple[str, str | None]:
        try:
            found = list(answer([prompt]))
        except Exception as e:  # noqa: BLE001  whatever the caller's model raises is reported with the prompt
            return "[]", f"{type(e).__name__}: {e}"
        if len(found) != 1:
            return "[]", f"{len(found)} answers to one prompt"
        return ("[]", "no answer") if found[0] is None else (str(found[0]), None)

    def several(part: list[str]) -> list[tuple[str, str | None]]:
        try:
            found = list(answer(part))
        except Exception:  # noqa: BLE001  asked again one by one, which reports what fails
            found = []
        return [(str(x), None) for x in found] if len(found) == len(part) and None not in found else [one(p) for p in part]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            asked = rows["prompt"].tolist()
            found = [x for start in range(0, len(asked), batch) for x in several(asked[start : start + batch])]
            yield pd.DataFrame({"digest": rows["digest"].tolist(), "response": [x for x, _ in found], "error": [e for _, e in found]}, dtype=object)

    return run


def complete(prompts: DataFrame, answer: Callable[[list[str]], list[str]], prompt_col: str = "prompt", batch: int = 64, store: ResponseStore | None = None, per_write: int = 100_000) -> DataFrame:
    """prompts with `response`, and `error` where there is none: the caller's batch function over the different prompts.

    A batch that raises, or that returns another number of answers than it got prompts, is asked again prompt by prompt;
    a prompt that fails alone, or whose answer is null, has the response "[]" and an error that says why.

    Answers go into the store, which is asked first: a prompt that any run had answered is not asked again, one that
    failed is, once a run. Different prompts are asked and written about `per_write` at a time, so that a run that dies
    loses one write's answers at most; what is asked is asked here, and the result only reads. Without a store, one in
    the scratch folder serves this run.

    Digests are counted first. Prompts are shuffled once, by digest, into buckets, in which they are made different and
    meet their answers; prompts that have over 1/256 of all rows are not shuffled, as their answers are few.
    """
    store = store or ResponseStore(prompts.sparkSession)
    (key,) = fresh(prompts, "__digest")
    rows = prompts.drop("response", "error").withColumn(key, F.sha2(F.col(f"`{prompt_col}`").cast("binary"), 256))
    some, none = rows.where(F.col(key).isNotNull()), rows.where(F.col(key).isNull())
    counts = materialize(some.groupBy(key).agg(F.count("*").alias("weight")))
    heavy = heavy_keys(counts, key, "weight")
    held = bucketed(some if heavy is None else some.join(F.broadcast(heavy.select(key)), key, "left_anti"), key)
    hot = None if heavy is None else materialize(some.join(F.broadcast(heavy.select(key)), key, "left_semi"))

    each = lambda df: df.groupBy(F.col(key).alias("digest")).agg(F.first(f"`{prompt_col}`").alias("prompt"))
    different = each(held) if hot is None else each(held).union(each(hot))
    known = store.read().where("error is null").select("digest")
    # files so small that a write's prompts are shared by all cores, however many prompts a bucket has
    cores = prompts.sparkSession.sparkContext.defaultParallelism
    todo = materialize(different.join(known, "digest", "left_anti"), most_rows=max(1, -(-per_write // cores)))
    n, files = todo.count(), todo.inputFiles()
    step = max(1, len(files) * per_write // max(1, n))
    for start in range(0, len(files) if n else 0, step):
        part = todo.sparkSession.read.schema(todo.schema).parquet(*files[start : start + step])
        store.append(part.mapInPandas(_asking(answer, batch), "digest string, response string, error string"))

    answers = store.read().withColumnRenamed("digest", key)
    found = held.join(answers, key, "left")
    if hot is not None:
        few = answers.join(F.broadcast(heavy.select(key)), key, "left_semi")  # under 256 rows
        found = found.unionByName(hot.join(F.broadcast(few), key, "left"))
    unasked = none.withColumn("response", F.lit("[]")).withColumn("error", F.lit("no prompt"))
    return found.unionByName(unasked).drop(key)


def strip_fences(text: Column) -> Column:
    text = utrim(F.coalesce(text, F.lit("")))
    return F.when(text.startswith("```json"), utrim(F.replace(F.replace(text, F.lit("```json"), F.lit("")), F.lit("```"), F.lit("")))).otherwise(text)


def _shape(text: Column) -> Column:
    """The first character of valid JSON: `[` or `{`."""
    return F.substring(utrim(text), 1, 1)


def _valid_objects(text: Column) -> Column:
    return F.from_json(text, f"array<{ENTITY}>")


def _standard_answer(text: Column) -> Column:
    """Entities of valid JSON: an array, an object with `entities` (a list or one item), or one entity."""
    keyed = F.get_json_object(text, "$.entities")
    return F.when(_shape(text) == "[", _valid_objects(text)).when(keyed.isNotNull(), _valid_objects(keyed)).otherwise(_valid_objects(text))


def _strict(objects: Column) -> Column:
    return F.filter(objects, lambda o: o.isNotNull() & o["text"].isNotNull() & o["type"].isNotNull())


def recover_json_objects(text: Column) -> Column:
    """Entities of text that is no valid JSON: an array once stray commas are gone and brackets are put around; else
    every innermost-ending `{...}` that parses; else every line that does."""
    bare = F.regexp_replace(text, r"(?U)^[,\s]+|[,\s]+$", "")
    mended = F.when(bare.startswith("{"), F.concat(F.lit("["), bare, F.lit("]"))).otherwise(bare)
    parsed = lambda items: _strict(F.transform(F.filter(items, is_json), lambda m: F.from_json(m, ENTITY)))
    objects = parsed(F.regexp_extract_all(mended, F.lit(r"(\{[\s\S]*?\})"), F.lit(1)))
    lines = F.transform(F.split(mended, r"\r?\n"), lambda x: F.regexp_replace(utrim(x), ",+$", ""))
    by_line = parsed(F.filter(lines, lambda x: x.startswith("{")))
    return F.when(is_json(mended), _standard_answer(mended)).when(F.size(objects) > 0, objects).otherwise(by_line)


def parse_ner_responses(answers: DataFrame, response_col: str = "response") -> DataFrame:
    """answers with a `response` each to a row per entity: the other columns, seq from 0, text, type, attributes, and
    source_text if there is a chunk_text. Entities need a text and a type; malformed answers go through
    recover_json_objects."""
    text = strip_fences(F.col(response_col))
    rows = answers.withColumn("__json", text)
    found = F.when(is_json(F.col("__json")), _standard_answer(F.col("__json"))).otherwise(recover_json_objects(F.col("__json")))
    rest = [c for c in answers.columns if c not in (response_col, "chunk_text", "seq", "text", "type", "attributes", "source_text")]
    rows = rows.select(*rest, *([F.col("chunk_text").alias("source_text")] if "chunk_text" in answers.columns else []), F.posexplode(found).alias("seq", "e"))
    rows = rows.where("e.text IS NOT NULL AND e.type IS NOT NULL")
    return rows.withColumn("text", F.col("e.text")).withColumn("type", F.col("e.type")).withColumn("attributes", F.coalesce("e.attributes", F.create_map().cast("map<string, string>"))).drop("e")


def property_hits(text: Column, rules: Sequence[PropertyRule]) -> Column:
    """An array of (rule, name, phrase, value, unit) structs, a row's hits rule by rule. Texts without any alias are not
    looked at; others are gone through once a rule, and values are read from the phrases found."""
    named = text.rlike(f"(?iU)(?:{'|'.join(alias for rule in rules for alias in rule.aliases)})")
    hits = F.concat(*[F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)), _tagged(i, rule)) for i, rule in enumerate(rules)])
    return F.when(named, hits)


def _tagged(i: int, rule: PropertyRule) -> Callable[[Column], Column]:
    value = lambda phrase: F.regexp_extract(phrase, rule.pattern, 2)
    return lambda phrase: F.struct(F.lit(i).alias("rule"), F.lit(rule.name).alias("name"), phrase.alias("phrase"), value(phrase).alias("value"), F.lit(rule.unit).alias("unit"))


def treatment_hits(text: Column, rules: Sequence[TreatmentRule]) -> Column:
    """An array of phrases, rule by rule; a rule is only looked for in texts that hold one of its literals."""

    def found(rule: TreatmentRule) -> Column:
        hits = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
        held = reduce(or_, [F.contains(text, F.lit(literal)) for literal in rule.literals]) if rule.literals else F.lit(True)
        return F.when(held, hits).otherwise(F.array().cast("array<string>"))

    return F.concat(*[found(r) for r in rules])


KEYS = ("doc_id", "para_no", "chunk_no")


def _keys(df: DataFrame) -> list[str]:
    return [k for k in KEYS if k in df.columns]


def extract_property_entities(chunks: DataFrame, rules: Sequence[PropertyRule] = PROPERTIES) -> DataFrame:
    """A MechanicalProperty for every `alias ... number unit` in a chunk: keys, seq, text, type, attributes (name, value,
    unit), source_text."""
    hits = chunks.select(*_keys(chunks), "chunk_text", F.posexplode(property_hits(F.coalesce("chunk_text", F.lit("")), rules)).alias("seq", "h"))
    attributes = F.create_map(F.lit("name"), F.col("h.name"), F.lit("value"), F.col("h.value"), F.lit("unit"), F.col("h.unit"))
    return hits.select(*_keys(chunks), "seq", F.col("h.phrase").alias("text"), F.lit("MechanicalProperty").alias("type"), attributes.alias("attributes"), F.col("chunk_text").alias("source_text"))


def extract_process_entities(chunks: DataFrame, rules: Sequence[TreatmentRule] = TREATMENTS) -> DataFrame:
    """A HeatTreatmentProcess for every treatment in a chunk, with attribute description."""
    hits = chunks.select(*_keys(chunks), "chunk_text", F.posexplode(treatment_hits(F.coalesce("chunk_text", F.lit("")), rules)).alias("seq", "text"))
    return hits.select(*_keys(chunks), "seq", "text", F.lit("HeatTreatmentProcess").alias("type"), F.create_map(F.lit("description"), F.col("text")).alias("attributes"), F.col("chunk_text").alias("source_text"))


def merge_entities(model: DataFrame, *rules: DataFrame) -> DataFrame:
    """All model entities, and of each (text, type) of a chunk that the model lacks the first that a rule found.

    rank is 0 for the model, then 1 and on in the order of the rules; (rank, seq) orders a chunk's entities.
    """
    found = None
    for i, df in enumerate(rules):
        df = df.withColumn("rank", F.lit(i + 1))
        found = df if found is None else found.unionByName(df, allowMissingColumns=True)
    own = model.withColumn("rank", F.lit(0))
    if found is None:
        return own
    key = [*_keys(model), "text", "type"]
    new = first_by(found, key, ("rank", "seq")).join(model.select(*key).distinct(), key, "left_anti")
    return own.unionByName(new, allowMissingColumns=True)


def record_key(df: DataFrame, columns: Sequence[str]) -> Column:
    """A digest of the columns' values in which the order of a map's keys does not count."""
    kinds = dict(df.dtypes)
    fields = [canonical_map(F.col(f"`{c}`")).alias(c) if kinds[c].startswith("map") else F.col(f"`{c}`") for c in columns]
    return F.unhex(F.sha2(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}), 256))


def dedup_records(df: DataFrame, scope: Sequence[str] = ("doc_id",), order: Sequence[str] = ("seq",)) -> DataFrame:
    """Of rows that are equal within a scope but for the order columns, the first. Keys shuffle as 32-byte digests."""
    (key,) = fresh(df, "__key")
    compared = [c for c in df.columns if c not in scope and c not in order]
    return first_by(df.withColumn(key, record_key(df, compared)), [*scope, key], order).drop(key)
