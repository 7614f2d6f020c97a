"""Cutting texts into chunks: row-local folds, and likeness of neighbouring sentences by vectors or by words."""

from __future__ import annotations

import math
from collections import Counter, deque
from collections.abc import Callable, Iterable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.patterns import SECTION_HEADINGS
from ..functions.rows import STRETCH, before, running_sum
from ..functions.text import let, nonblank_parts, utrim

#: Parts that are folded at a time, so that the list of starts is copied once for so many.
FOLDED = 256
STATE = "struct<starts: array<int>, size: long, open: boolean>"


def chunk_starts(lengths: Column, max_size: int, min_size: int | None = None, gap: int = 0) -> Column:
    """Where chunks start in an array of the parts' lengths: a part joins the chunk before it while both are no longer
    than max_size, and a chunk of min_size or more takes no further part. gap: what a joint adds to a chunk's size.

    A fold over numbers alone, in two levels, of which the outer one adds the starts of FOLDED parts at once.
    """
    none = F.array().cast("array<int>")

    def add(state: Column, place: Column, length: Column) -> Column:
        joins = state["open"] & (state["size"] + length <= max_size)
        size = F.when(joins, state["size"] + length + gap).otherwise(length.cast("long"))
        starts = F.when(joins, state["starts"]).otherwise(F.concat(state["starts"], F.array(place)))
        return F.struct(starts.alias("starts"), size.alias("size"), (F.lit(True) if min_size is None else size < min_size).alias("open")).cast(STATE)

    def add_block(state: Column, block: Column, all_lengths: Column) -> Column:
        base = block * FOLDED
        part = F.transform(F.slice(all_lengths, base + 1, FOLDED), lambda n, i: F.struct((base + i).alias("place"), n.alias("n")))
        start = F.struct(none.alias("starts"), state["size"].alias("size"), state["open"].alias("open")).cast(STATE)
        inner = F.aggregate(part, start, lambda s, x: add(s, x["place"], x["n"]))
        return let(inner, lambda found: F.struct(F.concat(state["starts"], found["starts"]).alias("starts"), found["size"].alias("size"), found["open"].alias("open")).cast(STATE))

    first = F.struct(none.alias("starts"), F.lit(0).cast("long").alias("size"), F.lit(False).alias("open")).cast(STATE)
    blocks = lambda n: F.sequence(F.lit(0), F.floor((F.size(n) - 1) / FOLDED).cast("int"))
    return let(lengths, lambda n: F.when(F.size(n) > 0, F.aggregate(blocks(n), first, lambda s, b: add_block(s, b, n), lambda s: s["starts"])).otherwise(none))


def _slices(parts: Column, starts: Column, separator: str) -> Column:
    return F.transform(starts, lambda at, i: F.array_join(F.slice(parts, at + 1, F.coalesce(F.get(starts, i + 1), F.size(parts)) - at), separator))


def _cut(parts: Column, starts: Callable[[Column], Column], separator: str) -> Column:
    """The chunks of an array of parts, each one slice of it; starts is given the parts' lengths."""
    return let(parts, lambda p: let(starts(F.transform(p, lambda x: F.length(x))), lambda s: _slices(p, s, separator)))


def pack_fixed(parts: Column, max_size: int, min_size: int, separator: str) -> Column:
    """Greedy packing of an array of parts: flush before a part that would pass max_size, and on reaching min_size."""
    return _cut(parts, lambda n: chunk_starts(n, max_size, min_size), separator)


def _exploded(df: DataFrame, chunks: Column, title: Column | None = None) -> DataFrame:
    out = df.select("doc_id", *(["para_no"] if "para_no" in df.columns else []), F.posexplode(chunks).alias("chunk_no", "chunk"))
    if title is None:
        return out.withColumn("section_title", F.lit("")).withColumnRenamed("chunk", "chunk_text")
    return out.withColumn("section_title", F.col("chunk.title")).withColumn("chunk_text", F.col("chunk.text")).drop("chunk")


def chunk_fixed(df: DataFrame, text_col: str = "text", max_size: int = 2000, min_size: int = 500, separator: str = "\n\n") -> DataFrame:
    """doc_id (and para_no), chunk_no from 0, chunk_text, section_title ''. Parts are never cut; row-local, no shuffle."""
    return _exploded(df, pack_fixed(nonblank_parts(F.coalesce(F.col(text_col), F.lit("")), separator), max_size, min_size, separator))


def _pack_paragraphs(parts: Column, max_size: int) -> Column:
    """Paragraphs joined while the text so far and the next stay within max_size."""
    return _cut(parts, lambda n: chunk_starts(n, max_size, gap=2), "\n\n")


def split_sections(df: DataFrame, text_col: str = "text", headings: Sequence[str] = SECTION_HEADINGS, max_size: int = 2000, min_size: int = 500) -> DataFrame:
    """Cut at heading lines, then at numbered sub-headings; bodies are packed to max_size, larger pieces than half as
    much again are cut by the fixed method, and texts without a section are cut by it as a whole.

    section_title is `heading sub-heading`; text before the first heading has the title ''.
    """
    # the line break behind a heading is only looked at, so that the next heading can begin with it
    heading = rf"\n\s*(?:{'|'.join(headings)})[^\S\n]*(?=\n)"
    text = F.concat(F.lit("\n"), F.coalesce(F.col(text_col), F.lit("")), F.lit("\n"))

    def pieces(whole: Column, pattern: str) -> Column:
        bodies = F.split(whole, pattern)
        titles = F.concat(F.array(F.lit("")), F.regexp_extract_all(whole, F.lit(f"({pattern})"), F.lit(1)))
        return F.zip_with(titles, bodies, lambda t, b: F.struct(utrim(t).alias("title"), F.coalesce(b, F.lit("")).alias("body")))

    sub_heading = r"\n\s*\d+\.\d+[^\S\n]+[^\n]+(?=\n)"
    sections = F.transform(pieces(text, heading), lambda s: F.struct(s["title"].alias("title"), pieces(F.concat(F.lit("\n"), s["body"], F.lit("\n")), sub_heading).alias("subs")))
    flat = F.flatten(F.transform(sections, lambda s: F.transform(s["subs"], lambda x: F.struct(utrim(F.concat_ws(" ", s["title"], x["title"])).alias("title"), x["body"].alias("body")))))

    def chunks(piece: Column) -> Column:
        packed = _pack_paragraphs(nonblank_parts(piece["body"], "\n\n"), max_size)
        cut = F.flatten(F.transform(packed, lambda p: F.when(F.length(p) > max_size * 1.5, pack_fixed(nonblank_parts(p, "\n\n"), max_size, min_size, "\n\n")).otherwise(F.array(p))))
        return F.transform(cut, lambda c: F.struct(piece["title"].alias("title"), c.alias("text")))

    found = F.flatten(F.transform(flat, chunks))
    whole = F.transform(pack_fixed(nonblank_parts(F.coalesce(F.col(text_col), F.lit("")), "\n\n"), max_size, min_size, "\n\n"), lambda c: F.struct(F.lit("").alias("title"), c.alias("text")))
    return _exploded(df, F.when(F.size(found) > 0, found).otherwise(whole), F.lit(True))


def split_sentences(df: DataFrame, text_col: str = "text", separator: str = ".") -> DataFrame:
    """doc_id, seq from 0, sentence."""
    return df.select("doc_id", F.posexplode(nonblank_parts(F.coalesce(F.col(text_col), F.lit("")), separator)).alias("seq", "sentence"))


def cosine(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    size = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(size > 0, dot(a, b) / size).otherwise(0.0)


def _joined_at_cuts(rows: DataFrame) -> DataFrame:
    """Sentences (doc_id, seq, sentence, __stretch, __cut: 1 where a chunk starts) to doc_id, chunk_no from 0, chunk_text."""
    numbered = running_sum(rows, ["doc_id"], "__stretch", ["seq"], F.col("__cut"), "chunk_no")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "sentence"))), lambda s: s["sentence"]), ". ")
    return numbered.groupBy("doc_id", "chunk_no").agg(F.concat(text, F.lit(".")).alias("chunk_text"))


def _with_limits(rows: DataFrame, limits: DataFrame) -> DataFrame:
    """rows (doc_id, __stretch, ...) with the columns of limits, a row per document. Limits go to each stretch of their
    document first, so the rows of a long one are not gathered."""
    key = F.struct("doc_id").alias("__doc")
    places = rows.select(F.struct("doc_id", "__stretch").alias("__place")).distinct()
    placed = places.withColumn("__doc", F.struct("__place.doc_id")).join(limits.select(key, *[c for c in limits.columns if c != "doc_id"]), "__doc").drop("__doc")
    return rows.withColumn("__place", F.struct("doc_id", "__stretch")).join(placed, "__place").drop("__place")


def chunk_by_similarity(sentences: DataFrame, vector_col: str = "embedding") -> DataFrame:
    """Sentences (doc_id, seq, sentence, vector) to chunks: a chunk starts where the likeness to the sentence before is
    at most the document's mean less its population standard deviation. Returns doc_id, chunk_no from 0, chunk_text.

    Stretches of STRETCH sentences are sorted apart, and take the last vector of the stretch before."""
    rows = sentences.withColumn("__stretch", F.floor(F.col("seq") / STRETCH))
    rows = before(rows, ["doc_id"], "__stretch", ["seq"], F.struct(F.col(vector_col).alias("vector")), "__before")
    rows = rows.withColumn("__near", F.when(F.col("__before").isNotNull(), cosine(F.col("__before.vector"), F.col(vector_col)))).drop("__before", vector_col)
    limits = rows.groupBy("doc_id").agg((F.avg("__near") - F.stddev_pop("__near")).alias("__limit"))
    rows = _with_limits(rows, limits).withColumn("__cut", F.coalesce((F.col("__near") <= F.col("__limit")).cast("int"), F.lit(0)))
    return _joined_at_cuts(rows)


#: Cohesion is kept as so many parts of one, so that sums over a document are exact.
PARTS = 1_000_000


def _cohesion(sentences: Iterable[str], window: int) -> list[int]:
    """The cohesion of each sentence but the first, given its terms with a blank between: the cosine of the term counts of
    the `window` sentences before it and of it and those after it, as a whole number of 1/1000000.

    Products of two sentences are made once; those of two windows are sums of them."""
    held: deque[Counter] = deque(maxlen=2 * window)
    with_before = []  # for each sentence, its product with itself, the one before it and so on
    for sentence in sentences:
        terms = Counter(sentence.split())
        held.appendleft(terms)
        with_before.append([sum(terms[t] * other[t] for t in terms.keys() & other.keys()) for other in held])
    n = len(with_before)
    within = [sum(sum(with_before[i][: i - at + 1]) + sum(with_before[i][1 : i - at + 1]) for i in range(at, min(n, at + window))) for at in range(n)]
    # the first windows are shorter on the left
    left = [sum(sum(with_before[i]) + sum(with_before[i][1:]) for i in range(at)) if at < window else within[at - window] for at in range(n)]
    across = [sum(sum(with_before[i][i - at + 1 : i - at + 1 + window]) for i in range(at, min(n, at + window))) for at in range(n)]
    return [math.floor(across[i] * float(PARTS) / (math.sqrt(left[i]) * math.sqrt(within[i]))) if left[i] and within[i] else 0 for i in range(1, n)]


def _lexical_starts(window: int) -> Callable[[Column], Column]:
    """Where chunks start in an array of sentences' terms: at the first, and where the cohesion is at most the mean less
    the population standard deviation, in whole numbers of any size."""

    def starts(sentences: list[str]) -> list[int]:
        near = _cohesion(sentences, window)
        n, total = len(near), sum(near)
        spread = n * sum(x * x for x in near) - total * total
        return [0, *(i for i, x in enumerate(near, 1) if total >= n * x and (total - n * x) ** 2 >= spread)][: len(sentences)]

    def run(texts: pa.Array) -> pa.Array:
        return pa.array((starts(text.as_py() or []) for text in texts), pa.list_(pa.int32()))

    return F.arrow_udf(run, "array<int>")


def chunk_lexical(df: DataFrame, text_col: str = "text", separator: str = ".", window: int = 3) -> DataFrame:
    """Texts to chunks of whole sentences, by their words alone: a chunk starts where the cohesion of the sentences before
    and after is at most the document's mean less its population standard deviation, which is decided in whole numbers.
    Returns doc_id, chunk_no from 0, chunk_text. Row-local, no shuffle.

    Terms are runs of letters and digits, lower-cased; only they go to the Python helper, and only places come back."""
    texts = df.select("doc_id", nonblank_parts(F.coalesce(F.col(text_col), F.lit("")), separator).alias("sentences"))
    terms = F.transform("sentences", lambda s: F.regexp_replace(F.lower(s), r"[^\p{L}\p{N}]+", " "))
    cut = texts.withColumn("starts", _lexical_starts(window)(terms))
    chunks = F.transform(_slices(F.col("sentences"), F.col("starts"), ". "), lambda c: F.concat(c, F.lit(".")))
    return cut.select("doc_id", F.posexplode(chunks).alias("chunk_no", "chunk_text"))


def chunk_documents(df: DataFrame, method: str = "fixed", **options) -> DataFrame:
    """Cut by the method named: fixed; sections, or pdf, which is another name for it; similarity, by vectors for rows of
    sentences (doc_id, seq, sentence, a vector) and by words for texts; any other: fixed."""
    if method in ("sections", "pdf"):
        return split_sections(df, **options)
    if method == "similarity":
        return chunk_by_similarity(df, **options) if {"seq", "sentence"} <= set(df.columns) else chunk_lexical(df, **options)
    return chunk_fixed(df, **options)
