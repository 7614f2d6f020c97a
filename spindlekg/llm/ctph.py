"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash over seven bytes ends a piece wherever its remainder by the block size is the largest; each piece gives
one character of a signature. The block size is three times a power of two, chosen so that a text has 32 to 64 pieces;
a second signature is at twice that size. Two fingerprints are compared at equal, double or half block sizes by edit
distance (insertion and deletion cost 1, replacement 2), as a share of both lengths; signatures of seven characters or
more need a run of seven in common, else they are unrelated.

Edges, all tested: null and empty texts have the fingerprint `3::`, which is like itself (1.0) and like nothing else
(0.0); equal texts have equal fingerprints; repeated rows each return a row; an empty table returns no rows.
"""

from __future__ import annotations

import hashlib
import json
import math
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import shuffle_partitions

WINDOW, LEAST, PIECES, RUN = 7, 3, 64, 7
LETTERS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", dtype=np.uint8)
MIX = np.frombuffer(hashlib.shake_128(b"bytes").digest(1024), dtype=np.uint32)
STEP = [pow(0x01000193, k, 1 << 32) for k in range(WINDOW)]
POWERS = np.array([pow(0x9E3779B1, k, 1 << 32) for k in range(4096)], dtype=np.uint32)
#: Characters that a bucket of neighbouring ids holds at most, about: it is sorted by one task.
BUCKET_CHARS = 1 << 28
LOWEST = -(1 << 63)


def _signature(mixed: np.ndarray, ends: np.ndarray) -> str:
    """A character for each piece; the last of PIECES takes the rest."""
    n = len(mixed)
    if not len(ends) or ends[-1] != n:
        ends = np.append(ends, n)
    if len(ends) > PIECES:
        ends = np.append(ends[: PIECES - 1], n)
    starts = np.concatenate(([0], ends[:-1]))
    at = np.arange(n) - np.repeat(starts, ends - starts)
    sums = np.add.reduceat(mixed * POWERS[at & 4095], starts, dtype=np.uint32)
    return LETTERS[(sums ^ (sums >> np.uint32(15))) * np.uint32(0x85EBCA6B) >> np.uint32(26)].tobytes().decode()


def fingerprint(data: bytes) -> str:
    """`block size:signature:signature at twice the size`."""
    n = len(data)
    if not n:
        return f"{LEAST}::"
    mixed = MIX[np.frombuffer(data, dtype=np.uint8)]
    rolling = mixed.copy()
    for k in range(1, min(WINDOW, n)):
        rolling[k:] += mixed[:-k] * np.uint32(STEP[k])
    block = LEAST
    while block * PIECES < n:
        block *= 2
    low = max(LEAST, block // 4)
    found = np.flatnonzero(rolling % np.uint32(low) == low - 1)
    while True:
        while block < low:  # rare: a text that repeats itself ends few pieces
            low = max(LEAST, low // 4)
            found = np.flatnonzero(rolling % np.uint32(low) == low - 1)
        ends = found[rolling[found] % np.uint32(block) == block - 1] + 1
        if block == LEAST or len(ends) >= PIECES // 2:
            break
        block //= 2
    doubled = found[rolling[found] % np.uint32(2 * block) == 2 * block - 1] + 1
    return f"{block}:{_signature(mixed, ends)}:{_signature(mixed, doubled)}"


def _common(a: str, b: str) -> int:
    """Length of the longest common subsequence, bit-parallel."""
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for c in b:
        u = v & masks.get(c, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def _alike(a: str, b: str) -> float:
    if not a or not b:
        return 0.0
    if min(len(a), len(b)) >= RUN:
        runs = {a[i : i + RUN] for i in range(len(a) - RUN + 1)}
        if not any(b[i : i + RUN] in runs for i in range(len(b) - RUN + 1)):
            return 0.0
    distance = len(a) + len(b) - 2 * _common(a, b)
    return 1.0 - distance / (len(a) + len(b))


def likeness(a: str, b: str) -> float:
    """0 (unrelated, or block sizes too far apart) to 1 (equal)."""
    if a == b:
        return 1.0
    (block_a, one_a, two_a), (block_b, one_b, two_b) = a.split(":"), b.split(":")
    ratio = int(block_a) / int(block_b)
    if ratio == 1:
        return max(_alike(one_a, one_b), _alike(two_a, two_b))
    return _alike(one_a, two_b) if ratio == 2 else _alike(two_a, one_b) if ratio == 0.5 else 0.0


def fingerprints(docs: DataFrame, text: Column, keep: Mapping[str, Column]) -> DataFrame:
    """The columns in keep and `fingerprint`, a row per input row, without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint((t or "").encode()) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(found, pa.string())], names=[*batch.schema.names[1:], "fingerprint"])

    rows = docs.select(text.cast("string").alias("__text"), *[c.alias(k) for k, c in keep.items()])
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields[1:], T.StructField("fingerprint", T.StringType())]))


def bounds(quantiles: Sequence[int]) -> list[tuple[int, int]]:
    """Lower bounds (key, tie) of buckets, ascending. A key that is several quantiles is cut evenly by its ties."""
    times = Counter(quantiles)
    return [(key, LOWEST + i * (1 << 64) // times[key]) for key in sorted(times) for i in range(times[key])]


def _bucket(key: Column, tie: Column, lows: list[tuple[int, int]]) -> Column:
    """How many of the bounds are below or at the pair: among every so-manieth first, then in the stretch behind it."""
    if not lows:
        return F.lit(0)
    step = math.isqrt(len(lows)) + 1
    stretches = [[{"k": k, "t": t} for k, t in lows[i : i + step]] for i in range(0, len(lows), step)]
    listed = F.from_json(F.lit(json.dumps(stretches)), "array<array<struct<k: bigint, t: bigint>>>")
    own = F.struct(key.alias("k"), tie.alias("t"))
    coarse = F.size(F.filter(listed, lambda s: F.get(s, 0) <= own))
    fine = F.size(F.filter(F.get(listed, coarse - 1), lambda b: b <= own))
    return F.when(coarse == 0, 0).otherwise((coarse - 1) * step + fine)


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come ordered by bucket, then guests last, then key, tie and text; each needs the text of the row after it."""
    before: tuple | None = None  # id, text, fingerprint
    out: list[tuple] = []
    schema = None

    def emit(own: tuple, text: str, mark: str) -> None:
        take = len(own[1]) // 4
        edited = (own[1][: len(own[1]) - take] + text[:take]).encode()
        edited_mark = fingerprint(edited)
        out.append((own[0], len(own[1]), hashlib.sha256(edited).hexdigest(), own[2], edited_mark, likeness(own[2], edited_mark), likeness(own[2], mark)))

    def flush() -> pa.RecordBatch:
        kinds = [schema.field("id").type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        made = pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
        out.clear()
        return made

    for batch in batches:
        schema = batch.schema
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            for ident, guest, text in zip(part.column("id").to_pylist(), part.column("guest").to_pylist(), part.column("text").to_pylist(), strict=True):
                if guest and before is None:
                    continue  # a further row with the guest's id
                mark = fingerprint(text.encode())
                if before is not None:
                    emit(before, text, mark)
                before = None if guest else (ident, text, mark)
            if len(out) >= 256:
                yield flush()
    if out:
        yield flush()


def edited_neighbours(docs: DataFrame, id_col: Column, text: Column) -> DataFrame:
    """Fingerprint each text, and its text with the last quarter replaced by the start of the next text by id.

    Ids are numbers; null ids come first, repeated ids are ordered by a hash of their text, and the last row's next is
    the first row. Rows are dealt into buckets of neighbouring ids, as many as the texts need, in one shuffle of the
    texts; rows of one id are dealt to several buckets where they are many. The first row of each bucket is also sent,
    as a guest, to the end of the bucket before, so no task needs more than its own bucket, in order.
    """
    spark = docs.sparkSession
    rows = docs.select(id_col.alias("id"), F.coalesce(id_col.cast("long"), F.lit(LOWEST)).alias("key"), F.coalesce(text.cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(shuffle_partitions(spark), -(-chars // BUCKET_CHARS))
    quantiles = rows.agg(F.percentile_approx("key", [i / n for i in range(1, n)], 10 * n)).first()[0] if n > 1 else []
    rows = rows.withColumn("bucket", _bucket(F.col("key"), F.col("tie"), bounds(quantiles or [])).cast("int"))
    firsts = sorted((r["bucket"], r["low"]["key"], r["low"]["tie"]) for r in rows.groupBy("bucket").agg(F.min(F.struct("key", "tie")).alias("low")).collect())
    # a row per bucket: its first row, and the bucket before it (before the first one, the last)
    hosts = spark.createDataFrame([(*first, firsts[i - 1][0]) for i, first in enumerate(firsts)], "bucket int, k long, t long, host int")
    met = rows.join(F.broadcast(hosts), "bucket")
    host = F.when((F.col("key") == F.col("k")) & (F.col("tie") == F.col("t")), F.col("host"))
    places = F.filter(F.array(F.struct(F.col("bucket"), F.lit(0).alias("guest")), F.struct(host.alias("bucket"), F.lit(1).alias("guest"))), lambda x: x["bucket"].isNotNull())
    dealt = met.select("id", "key", "tie", "text", F.explode(places).alias("place")).select("id", "key", "tie", "text", "place.bucket", "place.guest")
    dealt = dealt.repartitionById(len(bounds(quantiles or [])) + 1, F.col("bucket")).sortWithinPartitions("bucket", "guest", "key", "tie", "text")
    kind = rows.schema["id"].dataType.simpleString()
    return dealt.select("id", "guest", "text").mapInArrow(_edits, f"id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
