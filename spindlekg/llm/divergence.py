"""Source divergence audit: how far the term frequencies of each source of a language are from each other source's, and
which terms a source has more of than its language.

Terms are counted in length buckets. A term of up to eight bytes is packed into one uint64 word, of up to sixteen into
two; a word's 16-bit digits are sorted by a stable radix sort, least first and only as many as the bucket's terms fill,
then by group, and equal neighbours are counted as runs. Longer terms go into a bucket for each length, whose rows are
sorted as bytes. Texts are taken in slices of SLICE bytes, cut between terms; counts of slices are added up by Spark.

A source's share of a term is p = 1 + floor(10^9 (count + 2) / (N + 2 V)), and the divergence of two shares is
floor((p - q)^2 / (p + q)), all in exact integers. Pairs of sources are summed over all terms in tiles of `tile` sources,
each term's row once for each pair of tiles, so no matrix grows with the number of sources.

Edges, all tested: null text, lang and source are the empty string; a group without terms has the shares of no
occurrence, and a language without kept terms the value 0 for each pair; a source alone in its language has no pairs; equal
values are ranked by the item's bytes; repeated rows are documents of their own; texts and terms of any length are
counted whole; an empty table returns no rows; other columns are not read. Counts are exact up to 2.9 * 10^14 occurrences.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import heavy_keys, materialize, spread_join, trimmed

SLICE = 1 << 23
TILE = 256
LEAST_DOCS = 10
TOP_TERMS = 10
#: Characters of terms: letters of ASCII and all that is beyond it. The same class of bytes, for UTF-8.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
BYTES = np.arange(256)
IN_TERM = ((BYTES >= 0x41) & (BYTES <= 0x5A)) | ((BYTES >= 0x61) & (BYTES <= 0x7A)) | (BYTES >= 0x80)
LOWER = np.where((BYTES >= 0x41) & (BYTES <= 0x5A), BYTES + 32, BYTES).astype(np.uint8)


def radix_order(words: list[np.ndarray], digits: int) -> np.ndarray:
    """The stable order of rows of big-endian words, of which only the first `digits` 16-bit digits are not zero: a pass
    per digit, the least one first (numpy sorts 16-bit numbers by radix)."""
    order = None
    for d in reversed(range(digits)):
        digit = ((words[d // 4] >> np.uint64(48 - 16 * (d % 4))) & np.uint64(0xFFFF)).astype(np.uint16)
        if order is None:
            order = np.argsort(digit, kind="stable")
        else:
            order = order[np.argsort(digit[order], kind="stable")]
    return order


def runs(columns: list[np.ndarray]) -> np.ndarray:
    """Where runs of equal neighbours begin."""
    changed = np.zeros(len(columns[0]), bool)
    changed[:1] = True
    for c in columns:
        changed[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(changed)


def counted(columns: list[np.ndarray], docs: np.ndarray, weights: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of rows sorted by columns, then docs: starts of runs of columns, and their weights and different docs."""
    starts = runs(columns)
    first_of_doc = np.zeros(len(docs), np.int64)
    first_of_doc[runs([*columns, docs])] = 1
    n = np.diff(starts, append=len(docs)) if weights is None else np.add.reduceat(weights, starts)
    return starts, n, np.add.reduceat(first_of_doc, starts)


def group_order(groups: np.ndarray, order: np.ndarray) -> np.ndarray:
    """order, sorted by group too, the group first."""
    top = int(groups.max())
    for shift in range(0, max(1, top.bit_length()), 16):
        order = order[np.argsort(((groups[order] >> shift) & 0xFFFF).astype(np.uint16), kind="stable")]
    return order


def count_slice(data: np.ndarray, starts: np.ndarray, docs: np.ndarray, groups: np.ndarray) -> Iterator[tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray]]:
    """(group, term, occurrences, documents) columns of the terms of some texts, a bucket of lengths at a time.

    data: the texts' bytes, one after the other; starts, docs, groups: where each text begins, its document and group.
    """
    if not len(data):
        return
    inside = IN_TERM[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    real = starts[starts < len(data)]
    begins[real] = inside[real]
    at = np.flatnonzero(begins)
    if not len(at):
        return
    over = ~inside
    over[real] = True  # a text's end is the next one's beginning
    stops = np.flatnonzero(over)
    after = np.searchsorted(stops, at, side="right")
    ends = np.append(stops, len(data))[after]
    sizes = ends - at
    text_of = np.searchsorted(starts, at, side="right") - 1
    doc, group = docs[text_of], groups[text_of]
    low = np.concatenate([LOWER[data], np.zeros(16, np.uint8)])
    eight = np.ndarray((len(low) - 7,), ">u8", low, strides=(1,))
    for digits in range(1, 9):
        chosen = np.flatnonzero((sizes == 2 * digits) | (sizes == 2 * digits - 1))
        if not len(chosen):
            continue
        size, place = sizes[chosen].astype(np.uint64), at[chosen]
        words = []
        for w in range(1 + (digits > 4)):
            bits = np.minimum(np.maximum(size.astype(np.int64) * 8 - 64 * w, 0), 64).astype(np.uint64)
            drop = np.uint64(64) - bits
            words.append((eight[place + 8 * w].astype(np.uint64) >> drop) << drop)
        order = group_order(group[chosen], radix_order(words, digits))
        words = [w[order] for w in words]
        of, which = group[chosen][order], doc[chosen][order]
        first, n, d = counted([of, *words], which, None)
        raw = np.stack([w[first] for w in words], axis=1).astype(">u8").tobytes()
        width = 8 * len(words)
        yield of[first], [raw[i : i + width].rstrip(b"\0") for i in range(0, len(raw), width)], n, d
    for size in np.unique(sizes[sizes > 16]):
        chosen = np.flatnonzero(sizes == size)
        terms = np.array([low[i : i + size].tobytes() for i in at[chosen]], dtype=f"S{size}")
        order = group_order(group[chosen], np.argsort(terms, kind="stable"))
        of, which, terms = group[chosen][order], doc[chosen][order], terms[order]
        first, n, d = counted([of, terms], which, None)
        yield of[first], terms[first].tolist(), n, d


def _cuts(data: np.ndarray, size: int) -> list[int]:
    """Where a text is cut: about every `size` bytes, between terms."""
    found, at = [0], 0
    while len(data) - at > size:
        ahead = at + size
        while ahead < len(data) and IN_TERM[data[ahead]]:
            block = np.flatnonzero(~IN_TERM[data[ahead : ahead + size]])
            ahead = ahead + int(block[0]) if len(block) else min(len(data), ahead + size)
        if ahead >= len(data):
            break
        found.append(ahead)
        at = ahead
    return [*found, len(data)]


def _long(data: np.ndarray, size: int) -> dict[bytes, int]:
    """Occurrences of the terms of one long text, slice by slice."""
    found: dict[bytes, int] = {}
    cuts = _cuts(data, size)
    zero = np.zeros(1, np.int64)
    for a, b in zip(cuts, cuts[1:]):
        for _, terms, n, _ in count_slice(data[a:b], zero, zero, zero):
            for term, k in zip(terms, n.tolist()):
                found[term] = found.get(term, 0) + k
    return found


def _count(size: int):
    kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]
    names = ["lang", "source", "term", "n", "d"]

    def rows(lang: list[str], source: list[str], terms: list[bytes], n: list[int], d: list[int]) -> pa.RecordBatch:
        columns = [lang, source, [t.decode() for t in terms], n, d]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in trimmed(batches):
            texts, langs, sources = batch.column(0).cast(pa.large_binary()), batch.column(1).to_pylist(), batch.column(2).to_pylist()
            offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
            data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
            start = 0
            while start < len(texts):
                if offsets[start + 1] - offsets[start] > size:
                    found = _long(data[offsets[start] : offsets[start + 1]], size)
                    if found:
                        k = len(found)
                        yield rows([langs[start]] * k, [sources[start]] * k, list(found), list(found.values()), [1] * k)
                    start += 1
                    continue
                stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + size, side="right")) - 1)
                number: dict[tuple[str, str], int] = {}
                groups = np.array([number.setdefault((langs[i], sources[i]), len(number)) for i in range(start, stop)], np.int64)
                known = list(number)
                for of, terms, n, d in count_slice(data[offsets[start] : offsets[stop]], offsets[start:stop] - offsets[start], np.arange(stop - start), groups):
                    yield rows([known[g][0] for g in of.tolist()], [known[g][1] for g in of.tolist()], terms, n.tolist(), d.tolist())
                start = stop

    return run


def count_terms(docs: DataFrame, text: Column, lang: Column, source: Column, size: int = SLICE) -> DataFrame:
    """lang, source, term, n (occurrences), d (documents), a row per group and term."""
    blank = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    rows = docs.select(blank(text).alias("text"), blank(lang).alias("lang"), blank(source).alias("source"))
    parts = rows.mapInArrow(_count(size), "lang string, source string, term string, n long, d long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10^9 (count + 2) / (total + 2 terms)), without passing 64 bits: 10^9 is 31250 * 32000."""
    part, whole = (count + 2) * 31250, total + terms * 2
    div = lambda a, b: F.call_function("div", a, b)
    return F.lit(1).cast("long") + div(part, whole) * 32000 + div((part % whole) * 32000, whole)


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _tiles(tile: int):
    """Rows lang, a, b, p, q (two tiles of sources and their shares of a term) to sums of divergences by pair."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[tuple[str, int, int], np.ndarray] = {}

        def flushed() -> Iterator[pd.DataFrame]:
            for (lang, a, b), total in sums.items():
                i, j = np.indices(total.shape)
                yield pd.DataFrame({"lang": lang, "i": (a * tile + i).ravel(), "j": (b * tile + j).ravel(), "value": total.ravel()})
            sums.clear()

        for rows in batches:
            for key, part in rows.groupby(["lang", "a", "b"], sort=False):
                p, q = np.stack(part["p"].to_list()), np.stack(part["q"].to_list())
                total = np.zeros((p.shape[1], q.shape[1]), np.int64)
                step = max(1, (1 << 21) // total.size)
                for at in range(0, len(p), step):
                    x, y = p[at : at + step, :, None], q[at : at + step, None, :]
                    total += ((x - y) ** 2 // (x + y)).sum(axis=0)
                sums[key] = sums[key] + total if key in sums else total
            if len(sums) > 32:
                yield from flushed()
        yield from flushed()

    return run


def audit(docs: DataFrame, text: Column, lang: Column, source: Column, least_docs: int = LEAST_DOCS, top: int = TOP_TERMS, tile: int = TILE) -> DataFrame:
    """lang, source, part, item, value, rank. Part `pair`: each other source of the language, by the sum of divergences
    over all kept terms; part `term`: the `top` terms of which the source has more than its language."""
    blank = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    every = docs.select(blank(lang).alias("lang"), blank(source).alias("source")).distinct()
    by_term = count_terms(docs, text, lang, source).groupBy("lang", "term").agg(F.sum("d").alias("d"), F.sum("n").alias("n"), F.map_from_entries(F.collect_list(F.struct("source", "n"))).alias("counts"))
    kept = materialize(by_term.where(F.col("d") >= least_docs).drop("d"))
    # a row per group and one per language
    totals = kept.select("lang", F.explode("counts").alias("source", "n")).groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = every.join(totals, ["lang", "source"], "left").withColumn("total", F.coalesce("total", F.lit(0).cast("long")))
    sources = groups.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("source", "total"))).alias("sources"), F.sum("total").alias("every"))
    terms = kept.groupBy("lang").agg(F.count("*").alias("v"))
    langs = materialize(sources.join(terms, "lang", "left").withColumn("v", F.coalesce("v", F.lit(0).cast("long"))))
    heavy = heavy_keys(langs, "lang", "v")
    wide = spread_join(kept, langs, "lang", heavy)
    shares = F.transform("sources", lambda s: share(F.coalesce(F.try_element_at("counts", s["source"]), F.lit(0).cast("long")), s["total"], F.col("v")))
    wide = wide.withColumn("p", shares)

    cut = lambda name: F.slice("p", F.col(name) * tile + 1, tile)
    many = F.sequence(F.lit(0), F.call_function("div", F.size("sources").cast("long") - 1, F.lit(tile)).cast("int"))
    tiled = wide.where(F.size("sources") > 1).withColumn("a", F.explode(many)).withColumn("b", F.explode(many)).select("lang", "a", "b", cut("a").alias("p"), cut("b").alias("q"))
    sums = tiled.mapInPandas(_tiles(tile), "lang string, i long, j long, value long").groupBy("lang", "i", "j").agg(F.sum("value").alias("value"))
    number = langs.select("lang", F.posexplode("sources").alias("i", "s")).select("lang", F.col("i").cast("long").alias("i"), F.col("s.source").alias("source"))
    other = number.select("lang", F.col("i").alias("j"), F.col("source").alias("item"))
    pairs = number.join(other, "lang").where(F.col("i") != F.col("j")).join(sums, ["lang", "i", "j"], "left")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0).cast("long")).alias("value"))

    q = share(F.col("n"), F.col("every"), F.col("v"))
    found = wide.select("lang", "term", q.alias("q"), "counts", F.explode(F.arrays_zip("sources", "p")).alias("x"))
    found = found.where(F.col("x.p") > F.col("q")).where(F.try_element_at("counts", F.col("x.sources.source")).isNotNull())
    found = found.select("lang", F.col("x.sources.source").alias("source"), F.lit("term").alias("part"), F.col("term").alias("item"), divergence(F.col("x.p"), F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(ranked)


def oracle() -> str:
    """The audit of the documents table in DuckDB."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    f = "((p - q) * (p - q)) // (p + q)"
    return rf"""WITH docs AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, translate(coalesce(text, ''), '{upper}', '{lower}') AS text FROM documents),
found AS (SELECT id, lang, source, unnest(regexp_extract_all(text, '{TERM}')) AS term FROM docs),
kept AS (SELECT lang, term FROM found GROUP BY lang, term HAVING count(DISTINCT id) >= {LEAST_DOCS}),
v AS (SELECT l.lang, count(k.term) AS v FROM (SELECT DISTINCT lang FROM docs) l LEFT JOIN kept k ON k.lang = l.lang GROUP BY l.lang),
counts AS (SELECT lang, source, term, count(*) AS n FROM found JOIN kept USING (lang, term) GROUP BY lang, source, term),
grid AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n FROM (SELECT DISTINCT lang, source FROM docs) g JOIN kept k ON k.lang = g.lang LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
shares AS (SELECT lang, source, term, n, 1 + (1000000000 * (n + 2)::HUGEINT) // (sum(n) OVER (PARTITION BY lang, source) + 2 * v) AS p FROM grid JOIN v USING (lang)),
whole AS (SELECT lang, term, 1 + (1000000000 * (n + 2)::HUGEINT) // (sum(n) OVER (PARTITION BY lang) + 2 * v) AS q FROM (SELECT lang, term, sum(n) AS n FROM counts GROUP BY lang, term) JOIN v USING (lang)),
summed AS (SELECT a.lang, a.source, b.source AS item, sum({f}) AS value FROM shares a JOIN (SELECT lang, source, term, p AS q FROM shares) b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
pairs AS (SELECT a.lang, a.source, b.source AS item FROM (SELECT DISTINCT lang, source FROM docs) a JOIN (SELECT DISTINCT lang, source FROM docs) b ON a.lang = b.lang AND a.source <> b.source),
every AS (SELECT lang, source, 'pair' AS part, item, coalesce(value, 0) AS value FROM pairs LEFT JOIN summed USING (lang, source, item)
UNION ALL SELECT lang, source, 'term', term, {f} FROM shares JOIN whole USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM every)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= {TOP_TERMS}"""
