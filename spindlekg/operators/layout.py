"""Page layout to paragraphs: spans to blocks, blocks in reading order by page, blocks to paragraphs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rows import fresh, place_of, running_sum
from ..functions.text import collapse_spaces, is_blank, let, utrim


def _joined(parts: Column, only_before_lower: bool) -> Column:
    """An array of texts as one. A hyphen at the end of a part goes, with white space before it, and the next part follows
    directly: always, or only where that starts with a lower-case letter. Between others there is a space.

    What becomes of a part depends on its neighbours alone, so no text grows step by step. A part that is only a hyphen,
    and goes, takes the space before it along. A blank part is a space; it keeps the parts around it apart.
    """
    blank = lambda p: p.rlike(r"(?U)^\s*$")
    marked = lambda ps: F.filter(F.transform(ps, lambda p, i: F.struct(p.alias("text"), (F.coalesce(blank(F.get(ps, i - 1)), F.lit(False))).alias("apart"))), lambda p: ~blank(p["text"]))

    def joins(q: Column, i: Column) -> Column:
        """Whether part i follows the one before it directly."""
        here, before = F.get(q, i), F.get(q, i - 1)
        after_hyphen = before["text"].endswith("-") & ~here["apart"]
        return F.coalesce(after_hyphen & here["text"].rlike(r"^\p{Ll}") if only_before_lower else after_hyphen, F.lit(False))

    def vanishes(q: Column, i: Column) -> Column:
        """Whether part i is a hyphen that goes, and that no hyphen before it has joined already."""
        return joins(q, i + 1) & ~joins(q, i) & F.coalesce(F.get(q, i)["text"].rlike(r"(?U)^\s*-$"), F.lit(False))

    def piece(q: Column, x: Column, i: Column) -> Column:
        text = x["text"] if only_before_lower else F.when(joins(q, i), F.regexp_replace(x["text"], r"(?U)^\s+", "")).otherwise(x["text"])
        text = F.when(joins(q, i + 1), F.regexp_replace(text, r"(?U)\s*-$", "")).otherwise(text)
        text = F.when(vanishes(q, i + 1), F.regexp_replace(text, r"(?U)\s+$", "")).otherwise(text)
        return F.concat(F.when((i == 0) | joins(q, i) | vanishes(q, i), F.lit("")).otherwise(F.lit(" ")), text)

    return F.coalesce(let(parts, lambda ps: let(marked(ps), lambda q: F.array_join(F.transform(q, lambda x, i: piece(q, x, i)), ""))), F.lit(""))


def assemble_blocks(spans: DataFrame) -> DataFrame:
    """Spans (doc_id, page, block_no, line_no, span_no, text; block_type if present) to one row per text block.

    Spans of a line are joined without a separator; blank lines and blocks without text are dropped. If present,
    bbox columns x0, y0, x1, y1 become the block's bounds and page_height its page's.
    """
    if "block_type" in spans.columns:
        spans = spans.where(F.coalesce(F.col("block_type").cast("string"), F.lit("0")).isin("0", "text"))
    bounds = {"x0": F.min, "y0": F.min, "x1": F.max, "y1": F.max, "page_height": F.max}
    held = [f(c).alias(c) for c, f in bounds.items() if c in spans.columns]
    line_text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("span_no", F.coalesce("text", F.lit("")).alias("text")))), lambda s: s["text"]), "")
    lines = spans.groupBy("doc_id", "page", "block_no", "line_no").agg(line_text.alias("text"), *held).where(~is_blank(F.col("text")))
    again = [f(c).alias(c) for c, f in bounds.items() if c in spans.columns]
    blocks = lines.groupBy("doc_id", "page", "block_no").agg(F.array_sort(F.collect_list(F.struct("line_no", "text"))).alias("lines"), *again)
    return blocks.withColumn("text", utrim(_joined(F.transform("lines", lambda x: x["text"]), False))).drop("lines").where("text <> ''")


#: Where a block is sorted: its document and page, one shuffle for all steps (see running_sum).
PLACE = "__place"


def _placed(blocks: DataFrame) -> DataFrame:
    """Blocks that are complete, with their place."""
    whole = blocks.where(F.col("page").isNotNull() & F.col("y0").isNotNull() & F.col("y1").isNotNull() & F.col("page_height").isNotNull() & ~is_blank(F.col("text")))
    return whole.withColumn("text", utrim("text")).withColumn(PLACE, place_of(["doc_id"], "page"))


def order_blocks(blocks: DataFrame) -> DataFrame:
    """Blocks that are complete, with `reading_order` from 1: page, then top, then block number. Blocks are sorted within
    pages; of a document only the pages' counts meet."""
    counted = running_sum(_placed(blocks), ["doc_id"], "page", ["y0", "block_no"], F.lit(1), "reading_order", PLACE)
    return counted.withColumn("reading_order", F.col("reading_order").cast("int")).drop(PLACE)


def drop_header_footer(blocks: DataFrame, ratio: float = 0.05) -> DataFrame:
    """Blocks that do not reach into the top or bottom share of their page."""
    return blocks.where((F.col("y0") >= F.col("page_height") * ratio) & (F.col("y1") <= F.col("page_height") * (1 - ratio)))


def _marked(placed: DataFrame, gap_ratio: float) -> DataFrame:
    (starts,) = fresh(placed, "__starts")
    bottom = F.lag("y1").over(Window.partitionBy(PLACE).orderBy("reading_order"))
    marked = placed.withColumn(starts, F.coalesce(F.col("y0") - bottom > F.col("page_height") * gap_ratio, F.lit(True)).cast("int"))
    return running_sum(marked, ["doc_id"], "page", ["reading_order"], F.col(starts), "para_no", PLACE).drop(starts, PLACE)


def mark_paragraphs(blocks: DataFrame, gap_ratio: float = 0.01) -> DataFrame:
    """Ordered blocks with `para_no` from 1: a paragraph starts on a new page or after a gap of over gap_ratio pages. As a
    page starts one, what was before matters within pages only, and of a document only the pages' counts meet."""
    return _marked(blocks.withColumn(PLACE, place_of(["doc_id"], "page")), gap_ratio)


def merge_paragraphs(blocks: DataFrame) -> DataFrame:
    """Marked blocks to one row per paragraph: doc_id, para_no, page, text, block_nos, tops.

    A hyphen at the end goes if the next block starts with a lower-case letter; white space is collapsed.
    """
    ordered = F.array_sort(F.collect_list(F.struct("reading_order", "text", "block_no", "y0")))
    merged = blocks.groupBy("doc_id", "para_no").agg(F.min("page").alias("page"), ordered.alias("b"))
    text = collapse_spaces(_joined(F.transform("b", lambda x: F.coalesce(x["text"], F.lit(""))), True))
    return merged.select("doc_id", "para_no", "page", text.alias("text"), F.transform("b", lambda x: x["block_no"]).alias("block_nos"), F.transform("b", lambda x: x["y0"]).alias("tops")).where("text <> ''")


def paragraphs(blocks: DataFrame, margin: float = 0.05, gap_ratio: float = 0.01) -> DataFrame:
    """All steps from blocks to paragraphs: a shuffle by page, and one by paragraph. A paragraph lies within a page, so the
    order within pages is enough here."""
    body = drop_header_footer(_placed(blocks), margin)
    ranked = body.withColumn("reading_order", F.row_number().over(Window.partitionBy(PLACE).orderBy("y0", "block_no")))
    return merge_paragraphs(_marked(ranked, gap_ratio))


def nest_document(paragraphs: DataFrame, title: str = "正文") -> DataFrame:
    """One row per document: doc_id, sections (one, with all paragraphs in order)."""
    held = F.array_sort(F.collect_list(F.struct("para_no", "page", "text")))
    return paragraphs.groupBy("doc_id").agg(F.array(F.struct(F.lit(title).alias("title"), held.alias("paragraphs"))).alias("sections"))


def paragraph_counts(documents: DataFrame, paragraphs: DataFrame) -> DataFrame:
    """doc_id, n_paragraphs, failed (no paragraph) for every document."""
    counts = paragraphs.groupBy("doc_id").agg(F.count("*").alias("n"))
    return documents.select("doc_id").join(counts, "doc_id", "left").select("doc_id", F.coalesce("n", F.lit(0)).alias("n_paragraphs"), F.col("n").isNull().alias("failed"))
