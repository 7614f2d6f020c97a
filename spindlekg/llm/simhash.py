"""Near-duplicate detection by SimHash and tiled exact comparison.

A fingerprint has 64 bits; a bit is 1 if it is set in over half of the XXH64 values (seed 42) of the text's word
shingles, repeats included. Every pair of different fingerprints within the radius is found exactly: fingerprints are
dealt into tiles by population count, a pair of tiles whose counts differ by more than the radius is never made, and
the rest are compared with numpy's exclusive-or and bit counts. Equal fingerprints are one node, so a group of copies
of any size costs as much as one text. A pair of tiles returns a spanning forest of its links, never all pairs within a
group.

The comparison is exact and so quadratic in the number of different fingerprints, divided by the skipped tiles; the
README gives the measured rate.

Edges, all tested: null text, empty text and text of white space have fingerprint zero and link like any other; fewer
words than a shingle hash as one sequence; a null id takes part in linking but is never a representative unless the
whole group has none; repeated rows each return a row; an empty table returns no rows; ties cannot change a result,
since the smallest id represents. Extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import connected_components, fresh, heavy_keys, materialize, shuffle_partitions, spread_join, trimmed

SEED = 42
#: A tile holds this many fingerprints at least (but for small inputs) and at most; there are TILES at least.
TILE_LEAST, TILE_MOST, TILES = 4_096, 65_536, 10
BLOCK_ROWS, BLOCK_COLUMNS = 128, 2_048
HELD_LINKS = 500_000
#: Each possible byte with its bits dealt to the eight bytes of a word, the highest bit first in memory order.
SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8).reshape(-1, 1), axis=1).view(np.uint64).reshape(256)


def shingles(words: list[bytes], size: int) -> Iterator[bytes]:
    """Runs of words, space-joined, repeats included; fewer words make one run, none make none."""
    if len(words) <= size:
        return iter([b" ".join(words)] if words else [])
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    return (joined[a:b] for a, b in zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist(), strict=True))


def fingerprint(text: str | None, size: int = 3) -> int:
    """Lower-cases A-Z, cuts at ASCII white space and returns the 64 bits as an unsigned number."""
    return _fingerprint((text or "").encode().lower().split(), size)


def _fingerprint(words: list[bytes], size: int) -> int:
    if not words:
        return 0
    digest = xxhash.xxh64_digest
    hashes = np.frombuffer(b"".join([digest(s, SEED) for s in shingles(words, size)]), dtype=np.uint8).reshape(-1, 8)
    totals = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 255):  # a lane of eight bits holds the sum of 255
        totals += SPREAD[hashes[start : start + 255]].sum(axis=0, dtype=np.uint64).view(np.uint8)
    return int.from_bytes(np.packbits(totals * 2 > len(hashes)).tobytes(), "big")


def _fingerprints(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in trimmed(batches):
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                found = np.array([fingerprint(t, size) for t in part.column(1).to_pylist()], dtype=np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.int64())], names=["id", "fp"])

    return run


def fingerprints(docs: DataFrame, id_col: Column, text: Column, size: int = 3) -> DataFrame:
    """Columns id and fp (the 64 bits as a signed long), a row per input row; no shuffle."""
    rows = docs.select(id_col.alias("id"), text.cast("string").alias("text"))
    return rows.mapInArrow(_fingerprints(size), T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("fp", T.LongType())]))


class _Forest:
    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def roots(self) -> np.ndarray:
        found = np.array(self.parent)
        while (above := found[found]).tobytes() != found.tobytes():
            found = above
        return found

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        self.parent[max(a, b)] = min(a, b)
        return a != b


#: Links that are tried one by one before those that they made needless are dropped.
STEPS = 8192


def tile_links(left: np.ndarray, right: np.ndarray | None, radius: int) -> list[tuple[int, int]]:
    """Links (distance of radius or less) within a tile (right: None) or between two, as pairs of fingerprints.

    Returns a spanning forest of them, made of near links before far ones. Links are held while they are at most
    HELD_LINKS, else found again, in two levels of distance.
    """
    by_count = lambda x: x[np.lexsort((x, np.bitwise_count(x)))]
    rows = by_count(left)
    columns = rows if right is None else by_count(right)
    count_r, count_c = np.bitwise_count(rows).astype(np.int16), np.bitwise_count(columns).astype(np.int16)
    differ, counted = np.empty((BLOCK_ROWS, BLOCK_COLUMNS), np.uint64), np.empty((BLOCK_ROWS, BLOCK_COLUMNS), np.uint8)
    hits: list[tuple[int, int, int]] = []

    def every_block() -> Iterator[tuple[int, int, int]]:
        for r in range(0, len(rows), BLOCK_ROWS):
            low, high = count_r[r] - radius, count_r[min(r + BLOCK_ROWS, len(rows)) - 1] + radius
            first, last = int(np.searchsorted(count_c, low, "left")), int(np.searchsorted(count_c, high, "right"))
            for c in range(max(first, r) if right is None else first, last, BLOCK_COLUMNS):
                yield r, c, min(c + BLOCK_COLUMNS, last)

    def compare(blocks: Iterator[tuple[int, int, int]], level: int) -> Iterator[tuple]:
        for r, c, stop in blocks:
            some = rows[r : r + BLOCK_ROWS]
            apart = np.bitwise_xor(some[:, None], columns[None, c:stop], out=differ[: len(some), : stop - c])
            bits = np.bitwise_count(apart, out=counted[: len(some), : stop - c])
            if bits.min() > level:
                continue
            i, j = np.nonzero(bits <= level)
            distance, i, j = bits[i, j], i + r, j + c
            if right is None:
                upper = j > i
                distance, i, j = distance[upper], i[upper], j[upper]
            if len(i):
                yield (r, c, stop), distance, i, j

    held: list[tuple] | None = []
    n = 0
    for block, distance, i, j in compare(every_block(), radius):
        hits.append(block)
        n += len(i)
        if held is not None:
            held.append((distance, i.astype(np.int32), j.astype(np.int32)))
            held = held if n <= HELD_LINKS else None
    forest, links = _Forest(len(rows) + (0 if right is None else len(columns))), []
    shift = 0 if right is None else len(rows)

    def take(i: np.ndarray, j: np.ndarray) -> None:
        """The links, in order, that join what was apart. Those within a group that is joined go without a step each."""
        while len(i):
            roots = forest.roots()
            apart = roots[i] != roots[j + shift]
            i, j = i[apart], j[apart]
            links.extend((int(rows[x]), int(columns[y])) for x, y in zip(i[:STEPS].tolist(), j[:STEPS].tolist(), strict=True) if forest.join(x, y + shift))
            i, j = i[STEPS:], j[STEPS:]

    if held is not None:
        if held:
            distance, i, j = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.lexsort((j, i, distance))
            take(i[order], j[order])
    else:
        for level in (radius // 3, radius):
            for _, distance, i, j in compare(iter(hits), level):
                order = np.lexsort((j, i, distance))
                take(i[order], j[order])
    return links


def _compare(radius: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in trimmed(batches):
            for tiles in batch["tiles"]:
                sides: dict[int, list[np.ndarray]] = {}
                for t in tiles:
                    sides.setdefault(t["tile"], []).append(np.frombuffer(t["packed"], dtype=np.uint64))
                parts = [np.concatenate(sides[k]) for k in sorted(sides)]
                links = tile_links(parts[0], parts[1] if len(parts) == 2 else None, radius)
                a = np.array([x for x, _ in links], dtype=np.uint64).view(np.int64)
                b = np.array([y for _, y in links], dtype=np.uint64).view(np.int64)
                yield pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return run


def _pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in trimmed(batches):
        for tile, some in batch.groupby("tile", sort=False):
            yield pd.DataFrame({"tile": [tile], "packed": [some["fp"].to_numpy(np.int64).tobytes()]})


def near_pairs(distinct: DataFrame, radius: int) -> DataFrame:
    """Links between different fingerprints. distinct: column fp without repeats. Returns a < b (signed longs).

    The links are forests of tile pairs; their components are those of all pairs within the radius.
    """
    spark = distinct.sparkSession
    counts = {r["c"]: r["n"] for r in distinct.groupBy(F.bit_count("fp").alias("c")).agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    size = min(TILE_MOST, max(TILE_LEAST, -(-total // TILES)))
    bands: list[tuple[int, int, int]] = []  # lowest and highest population count, parts
    for c in sorted(counts):
        if bands and bands[-1][2] == 1 and sum(counts.get(x, 0) for x in range(bands[-1][0], c + 1)) <= size:
            bands[-1] = (bands[-1][0], c, 1)
        else:
            bands.append((c, c, -(-counts[c] // size)))
    if not bands:
        return distinct.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    starts = [sum(b[2] for b in bands[:i]) for i in range(len(bands) + 1)]
    count = F.bit_count("fp")
    tile, first, last = F.lit(None).cast("long"), F.lit(None).cast("long"), F.lit(None).cast("long")
    for i, (low, high, parts) in enumerate(bands):
        here = count.between(low, high)
        within = [k for k, b in enumerate(bands) if b[0] <= high + radius and b[1] >= low - radius]
        tile = F.when(here, starts[i] + F.pmod(F.xxhash64("fp"), F.lit(parts))).otherwise(tile)
        first, last = F.when(here, F.lit(starts[within[0]])).otherwise(first), F.when(here, F.lit(starts[within[-1] + 1] - 1)).otherwise(last)
    tiled = distinct.select("fp", tile.alias("tile"), first.alias("first"), last.alias("last"))
    bounds = tiled.groupBy("tile").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    packed = tiled.select("tile", "fp").repartition(min(starts[-1], 4 * shuffle_partitions(spark)), "tile").sortWithinPartitions("tile").mapInPandas(_pack, "tile long, packed binary")
    packed = packed.join(bounds, "tile").select("tile", "packed", F.explode(F.sequence("first", "last")).alias("other"))
    pairs = packed.select(F.least("tile", "other").alias("x"), F.greatest("tile", "other").alias("y"), F.struct("tile", "packed").alias("t"))
    n_pairs = sum(b[2] for b in bands) ** 2 // 2 + 1
    pairs = pairs.repartition(min(n_pairs, 8 * shuffle_partitions(spark)), "x", "y").groupBy("x", "y").agg(F.collect_list("t").alias("tiles"))
    return pairs.select("tiles").mapInPandas(_compare(radius), "a long, b long").distinct()


def components(docs: DataFrame, id_col: Column, text: Column, size: int = 3, radius: int = 2) -> DataFrame:
    """A row per input row: id, fp, component_id (the smallest id reachable over links, itself included)."""
    prints = materialize(fingerprints(docs, id_col, text, size))
    nodes = materialize(prints.groupBy("fp").agg(F.min("id").alias("low"), F.count("*").alias("rows")))
    links = near_pairs(nodes.select("fp"), radius)
    roots = connected_components(links)
    placed = nodes.select("fp", "low").join(roots.withColumnRenamed("node", "fp"), "fp")
    lows = materialize(placed.groupBy("root").agg(F.min("low").alias("joined"), F.count("*").alias("weight")))
    joined = spread_join(roots.withColumnRenamed("node", "fp"), lows, "root", heavy_keys(lows, "root", "weight")).select("fp", "joined")
    nodes = materialize(nodes.join(joined, "fp", "left").select("fp", F.coalesce("joined", "low").alias("component_id"), "rows"))
    return spread_join(prints, nodes, "fp", heavy_keys(nodes, "fp", "rows")).select("id", "fp", "component_id")


#: Rows and bytes of a key-only table that may be sent to every executor; beyond them the same join shuffles.
BROADCAST_ROWS, BROADCAST_BYTES = 400_000, 16 << 20


def _is_small(keys: DataFrame) -> bool:
    size = F.lit(0)
    for name in keys.columns:
        size = size + F.coalesce(F.octet_length(F.col(name).cast("string")), F.lit(0))
    found = keys.agg(F.count("*").alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes")).first()
    return found["n"] <= BROADCAST_ROWS and found["bytes"] <= BROADCAST_BYTES


def shingle_set(words: list[bytes], size: int) -> np.ndarray:
    """The different runs of words, as sorted 64-bit hashes; fewer words make one run, none make none."""
    if not words:
        return np.zeros(0, np.uint64)
    own = np.frombuffer(b"".join([xxhash.xxh64_digest(w, SEED) for w in words]), dtype=">u8").astype(np.uint64)
    size = min(size, len(words))
    runs = np.full(len(words) - size + 1, size, np.uint64)
    for k in range(size):
        runs = (runs ^ own[k : len(own) - size + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
        runs ^= runs >> np.uint64(29)
    return np.unique(runs)


def parity(hashes: np.ndarray) -> np.ndarray:
    """A bit for each of 64 or more places (a power of two, no fewer than hashes): whether an odd number of hashes fall
    there. The parities of two sets differ at no more places than the sets have elements that are not in both."""
    places = max(64, 1 << max(0, len(hashes) - 1).bit_length())
    odd = np.bincount((hashes & np.uint64(places - 1)).astype(np.int64), minlength=places) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def least_apart(a: Column, b: Column) -> Column:
    """At how many places two parities differ, the longer one folded to the length of the other."""
    both = F.least(F.size(a), F.size(b))

    def folded(x: Column) -> Column:
        halves = F.zip_with(F.slice(x, F.lit(1), both), F.slice(x, both + 1, both), lambda p, q: p.bitwiseXOR(q))
        return F.when(F.size(x) > both, halves).otherwise(x)

    return F.aggregate(F.zip_with(folded(a), folded(b), lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda n, x: n + x)


#: Of every SAMPLED texts one is looked at for common shingles: those in COMMON_LEAST of these texts or more, at most
#: COMMON_MOST. They only decide the order of shingles; any order finds every pair.
SAMPLED, COMMON_LEAST, COMMON_MOST = 16, 3, 200_000


def _every_set(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in trimmed(batches):
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                sets = [shingle_set((t or "").encode().lower().split(), size).view(np.int64) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["node", "hashes"])

    return run


def common_shingles(texts: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of common shingles, sorted, and the rank of each by how common it is. texts: node, text."""
    some = texts.where(F.pmod(F.xxhash64("node"), F.lit(SAMPLED)) == 0).mapInArrow(_every_set(size), "node binary, hashes array<long>")
    times = some.select(F.explode("hashes").alias("h")).groupBy("h").agg(F.count("*").alias("times"))
    found = times.where(F.col("times") >= COMMON_LEAST).orderBy(F.desc("times"), "h").limit(COMMON_MOST).collect()
    hashes = np.array([r["h"] for r in found], dtype=np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], np.arange(len(found), 0, -1)[order]


def prefix(hashes: np.ndarray, similarity: float, common: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The shingles of which two sets of this similarity share one at least: all but similarity * n less one, in an order
    that is the same for all sets: by hash, then common ones, the commonest last."""
    if not len(hashes):
        return hashes
    rank = np.zeros(len(hashes), np.int64)
    if len(common[0]):
        at = np.minimum(np.searchsorted(common[0], hashes), len(common[0]) - 1)
        rank = np.where(common[0][at] == hashes, common[1][at], 0)
    return hashes[np.argsort(rank, kind="stable")][: len(hashes) - math.ceil(similarity * len(hashes) - 1e-9) + 1]


def _shapes(size: int, verify_size: int, similarity: float, common: tuple[np.ndarray, np.ndarray]):
    """Columns node, none, id, text to node, none, id, fp, n (the size of the set), parity and head (its prefix)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in trimmed(batches):
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                prints, sizes, parities, heads = [], [], [], []
                for text in part.column(3).to_pylist():
                    words = (text or "").encode().lower().split()
                    hashes = shingle_set(words, verify_size)
                    prints.append(_fingerprint(words, size))
                    sizes.append(len(hashes))
                    parities.append(parity(hashes))
                    heads.append(prefix(hashes, similarity, common).view(np.int64))
                made = [pa.array(np.array(prints, dtype=np.uint64).view(np.int64)), pa.array(sizes, pa.int32()), pa.array(parities, pa.list_(pa.int64())), pa.array(heads, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([*part.columns[:3], *made], names=["node", "none", "id", "fp", "n", "parity", "head"])

    return run


def _nodes(texts: DataFrame, size: int, verify_size: int, similarity: float) -> DataFrame:
    """texts (node, none, id, text; node is the text's digest) to a row per different text: key (a number), node, low (the
    smallest none and id of its rows), rows, fp, n, parity, head. Copies are combined before the shuffle."""
    kind = texts.schema["id"].dataType.simpleString()
    common = common_shingles(texts.select("node", "text"), verify_size)
    made = texts.mapInArrow(_shapes(size, verify_size, similarity, common), f"node binary, none boolean, id {kind}, fp long, n int, parity array<long>, head array<long>")
    held = [F.first(c).alias(c) for c in ("fp", "n", "parity", "head")]
    grouped = made.groupBy("node").agg(F.min(F.struct("none", "id")).alias("low"), F.count("*").alias("rows"), *held)
    return materialize(grouped.withColumn("key", F.monotonically_increasing_id()))


def _enough(na: Column, nb: Column, most: Column, similarity: float) -> Column:
    """Whether sets of these sizes that share `most` at most can be as similar as that."""
    return most >= similarity * (na + nb - most)


def _alike(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, verify_size: int, similarity: float) -> DataFrame:
    """The pairs (a, b: keys of nodes) whose sets of shingles have at least this Jaccard similarity, as a table.

    Sizes and parities go first: they rule out nearly all pairs that are not alike, never one that is. The sets of the
    texts in the pairs that are left are made from their texts, a text once, and meet pair by pair.
    """
    pairs = materialize(pairs)
    asked = materialize(pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct())
    some = nodes.join(F.broadcast(asked), "key", "left_semi") if _is_small(asked) else nodes
    side = lambda k: some.select(F.col("key").alias(k), F.col("n").alias(f"n{k}"), F.col("parity").alias(f"p{k}"), F.col("node").alias(f"t{k}"))
    na, nb = F.col("na"), F.col("nb")
    most = (1 - similarity) / (1 + similarity)
    left = pairs.join(side("a"), "a").join(side("b"), "b").where(_enough(na, nb, F.least(na, nb), similarity))
    left = materialize(left.where(least_apart(F.col("pa"), F.col("pb")) <= (na + nb) * most + 1e-9).select("a", "b", "na", "nb", "ta", "tb"))
    asked, rows = materialize(left.select(F.col("ta").alias("node")).union(left.select("tb")).distinct()), texts.select("node", "text")
    # a small list of texts is sent out and sifts them where they are; a long one meets each different text once
    if _is_small(asked):
        found = rows.join(F.broadcast(asked), "node", "left_semi").dropDuplicates(["node"])
    else:
        found = rows.dropDuplicates(["node"]).join(asked, "node", "left_semi")
    sets = materialize(found.mapInArrow(_every_set(verify_size), "node binary, hashes array<long>"))
    met = left.join(sets.select(F.col("node").alias("ta"), F.col("hashes").alias("ha")), "ta").join(sets.select(F.col("node").alias("tb"), F.col("hashes").alias("hb")), "tb")
    both = F.size(F.array_intersect("ha", "hb"))
    return materialize(met.withColumn("both", both).where(_enough(na, nb, F.col("both"), similarity)).select("a", "b"))


def _mixed(posts: DataFrame, roots: DataFrame) -> DataFrame:
    """posts (h, key, n, at) with the root of each key, of those shingles only that occur under two roots or more."""
    placed = posts.join(roots.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    placed = materialize(placed.select("h", "key", "n", "at", "root"))
    spread = placed.groupBy("h").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("h")
    return materialize(placed.join(spread, "h", "left_semi"))


#: Rounds in which sets meet only one set of each shingle, another one each time.
LEADER_ROUNDS = 3


def _apart(mixed: DataFrame, similarity: float, leaders: int | None) -> DataFrame:
    """Pairs (a < b) of keys under different roots that share a shingle of their prefixes, less those of which the sizes
    and the places of that shingle rule out the similarity; with leaders, only pairs with one set of each shingle: the
    first by root and key in round 0, else the first by a hash of the key and the round.

    The first shingle that two similar sets share stands among the first n - ceil(2t / (1 + t) n) + 1 of the smaller one.
    """
    every = mixed.select("h", F.col("key").alias("a"), F.col("n").alias("na"), F.col("at").alias("ia"), F.col("root").alias("ra"))
    if leaders is not None:
        order = F.col("root") if leaders == 0 else F.xxhash64("key", F.lit(leaders))
        first = mixed.groupBy("h").agg(F.min(F.struct(order.alias("order"), "root", "key", "n", "at")).alias("f"))
        other = first.select(F.col("h").alias("g"), F.col("f.key").alias("b"), F.col("f.n").alias("nb"), F.col("f.at").alias("ib"), F.col("f.root").alias("rb"))
        order = F.lit(True)
    else:
        share = 2 * similarity / (1 + similarity)
        early = mixed.where(F.col("at") <= F.col("n") - F.ceil(share * F.col("n") - 1e-9))
        other = early.select(F.col("h").alias("g"), F.col("key").alias("b"), F.col("n").alias("nb"), F.col("at").alias("ib"), F.col("root").alias("rb"))
        order = (F.col("nb") < F.col("na")) | ((F.col("nb") == F.col("na")) & (F.col("b") < F.col("a")))
    # of the first shingle that is shared: it and what lies behind it in both is all that they can share
    most = F.least(F.col("na") - F.col("ia"), F.col("nb") - F.col("ib"))
    found = every.join(other, (F.col("h") == F.col("g")) & (F.col("ra") != F.col("rb")) & order & _enough(F.col("na"), F.col("nb"), most, similarity))
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def join_the_rest(nodes: DataFrame, texts: DataFrame, edges: DataFrame, verify_size: int, similarity: float) -> DataFrame:
    """node (a key), root of the components of edges (a, b) and of every other pair of nodes whose sets have at least this
    Jaccard similarity. Pairs within a component are not made: for some rounds one set of each shingle is compared
    with the others and what that finds is joined, then all that are still apart are compared."""
    posts = nodes.select("key", "n", F.posexplode("head").alias("at", "h"))
    often = posts.groupBy("h").agg(F.count("*").alias("times")).where("times > 1").select("h")
    posts = materialize(posts.join(often, "h", "left_semi").select("h", "key", "n", "at"))
    roots = connected_components(edges)
    for leaders in (*range(LEADER_ROUNDS), None):
        posts = _mixed(posts.select("h", "key", "n", "at"), roots)
        found = _alike(_apart(posts, similarity, leaders), nodes, texts, verify_size, similarity)
        if not found.isEmpty():
            roots = connected_components(found.union(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))))
    return roots


def near_groups(nodes: DataFrame, texts: DataFrame, radius: int, verify_size: int, similarity: float) -> DataFrame:
    """node (a key), root of every node that has a near duplicate.

    Fingerprints within the radius, along a spanning forest, and nodes of one fingerprint with its first one are the
    first candidates; join_the_rest finds whatever these leave apart, so neither loses a link.
    """
    worded, blank = nodes.where("n > 0"), nodes.where("n = 0").select("key")
    leads = materialize(worded.groupBy("fp").agg(F.min("key").alias("lead"), F.count("*").alias("weight")))
    same = spread_join(worded.select("fp", "key"), leads, "fp", heavy_keys(leads, "fp", "weight")).where("key <> lead").select(F.col("lead").alias("a"), F.col("key").alias("b"))
    near = near_pairs(leads.select("fp"), radius)
    near = near.join(leads.select(F.col("fp").alias("a"), F.col("lead").alias("x")), "a").join(leads.select(F.col("fp").alias("b"), F.col("lead").alias("y")), "b")
    near = near.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    edges = _alike(same.union(near), nodes, texts, verify_size, similarity)
    none = blank.agg(F.min("key")).first()[0]
    if none is not None:
        edges = edges.union(blank.where(F.col("key") != none).select(F.lit(none).alias("a"), F.col("key").alias("b")))
    return join_the_rest(nodes, texts, edges, verify_size, similarity)


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, radius: int = 8, verify_size: int = 5, similarity: float = 0.8) -> DataFrame:
    """docs without all but one row of each group of near duplicates: the one with the smallest id stays (nulls last; of
    equal ids the smallest digest of the text, of rows that are repeated whole the first by their other columns).

    Links are pairs of texts whose sets of verify_size-word shingles have the Jaccard similarity asked for, all of them;
    groups are the components over links. Texts without a word are one group. A text is one node, however many rows
    hold it. radius only decides how much is found by fingerprints and how much by the exact join behind them.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    ident = F.col(f"`{id_col}`")
    node, key, rows, mine = fresh(docs, "__node", "__key", "__rows", "__mine")
    keyed = docs.withColumn(node, F.unhex(F.md5(text)))
    texts = keyed.select(F.col(node).alias("node"), ident.isNull().alias("none"), ident.alias("id"), text.alias("text"))
    nodes = _nodes(texts, size, verify_size, similarity)
    roots = near_groups(nodes, texts, radius, verify_size, similarity)
    members = materialize(nodes.select("key", "node", "low", "rows").join(roots.withColumnRenamed("node", "key"), "key"))
    keepers = materialize(members.groupBy("root").agg(F.min(F.struct("low.none", "low.id", "node")).alias("keep"), F.count("*").alias("weight")))
    grouped = spread_join(members.select("root", "node", "rows"), keepers, "root", heavy_keys(keepers, "root", "weight")).select("node", F.col("keep.id").alias("keep"), "rows", (F.col("node") == F.col("keep.node")).alias("mine"))
    alone = nodes.where("rows > 1").join(roots.select(F.col("node").alias("key")), "key", "left_anti").select("node", "low.id", "rows", F.lit(True))
    # nothing is known of a text that occurs once and is like no other: its row stays
    judged = materialize(grouped.union(alone).toDF(node, key, rows, mine))
    placed = keyed.join(F.broadcast(judged), node, "left") if _is_small(judged) else spread_join(keyed, judged, node, heavy_keys(judged, node, rows), "left")
    kept = placed.where(F.col(mine).isNull() | (F.col(mine) & ident.eqNullSafe(F.col(key))))
    every = [F.col(f"`{c}`") for c in docs.columns]
    whole = F.struct(*every)
    again = kept.where(F.col(rows) > 1).groupBy(ident.alias(key), node).agg(F.min_by(whole, F.to_json(whole)).alias(rows))
    return kept.where(F.coalesce(F.col(rows), F.lit(1)) == 1).select(*every).union(again.select(*[F.col(f"{rows}.`{c}`").alias(c) for c in docs.columns]))
