"""Media columns in content-defined chunks: gear-hash cuts, deduplicated chunks, verified reconstruction.

A payload is stored as an 8-bit mono WAVE file. A rolling gear hash over its bytes cuts it into chunks; a medium is an
ordered list of chunk digests. Digests that occur more than once are found by a Spark aggregation and marked in a
bitmap of fixed size, which is all that is broadcast. Chunks outside the bitmap occur once and stay with their medium;
the others (and the bitmap's few false positives, which cost space but no correctness) go to a chunk table with one row
per digest, and come back by a join on the digest. So bytes that nothing shares are never shuffled, and equal media are
put together once. Every chunk and every medium is checked against its digest when it is read back.

Edges, all tested: null and empty payloads are 192 bytes of padding; repeated rows each return a row; equal texts have
equal values; an empty table returns no rows; payloads of any length are stored whole.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import heavy_keys, materialize, spread_join

UNIT, PAD, RATE = 192, 32, 8_000
LEAST, MOST, MEAN_BITS = 256, 8_192, 10
GEAR = np.frombuffer(hashlib.shake_128(b"gear").digest(1024), dtype=np.uint32)
#: The bitmap has 2 ** BITMAP_BITS bits: 8 MB.
BITMAP_BITS = 26
WAVE_HEADER = struct.Struct("<4sI4s4sIHHIIHH4sI")


def to_wave(payload: bytes) -> bytes:
    head = WAVE_HEADER.pack(b"RIFF", 36 + len(payload), b"WAVE", b"fmt ", 16, 1, 1, RATE, RATE, 1, 8, b"data", len(payload))
    return head + payload


def from_wave(media: bytes) -> bytes:
    riff, size, wave, _, _, kind, channels, _, _, _, bits, data, n = WAVE_HEADER.unpack_from(media)
    if (riff, wave, data, kind, channels, bits, size, n) != (b"RIFF", b"WAVE", b"data", 1, 1, 8, len(media) - 8, len(media) - WAVE_HEADER.size):
        raise ValueError("not a WAVE file of 8-bit mono samples")
    return media[WAVE_HEADER.size :]


def pad(data: bytes) -> bytes:
    return data.ljust(max(1, -(-len(data) // UNIT)) * UNIT, bytes([PAD]))


def cuts(media: bytes) -> list[int]:
    """Ends of the chunks. The gear hash of a position is the sum of GEAR[byte] << distance over the last 32 bytes,
    built here for all positions at once by doubling; a chunk ends where its top bits are zero."""
    n = len(media)
    hashes = GEAR[np.frombuffer(media, dtype=np.uint8)]
    for width in (1, 2, 4, 8, 16):
        if width < n:
            hashes[width:] = hashes[width:] + (hashes[:-width] << np.uint32(width))
    found = (np.flatnonzero(hashes >> np.uint32(32 - MEAN_BITS) == 0) + 1).tolist()
    ends, at = [], 0
    while n - at > LEAST:
        k = bisect_left(found, at + LEAST)
        at = min(found[k] if k < len(found) else n, at + MOST, n)
        ends.append(at)
    if at < n:
        ends.append(n)
    return ends


def chunks(media: bytes) -> list[tuple[bytes, bytes]]:
    ends = cuts(media)
    parts = [media[a:b] for a, b in zip([0, *ends], ends, strict=False)]
    return [(hashlib.sha256(part).digest(), part) for part in parts]


def features(payload: bytes) -> str:
    """Root mean square about the middle, crossings of the middle a thousand samples, and entropy in bits."""
    x = np.frombuffer(payload, dtype=np.uint8)
    counts = np.bincount(x, minlength=256)
    levels = np.arange(256) - 128.0
    share = counts[counts > 0] / len(x)
    crossings = int(np.count_nonzero(np.diff(x < 128)))
    return f"rms={np.sqrt((counts * levels**2).sum() / len(x)):.4f};cross={1000 * crossings / len(x):.3f};entropy={max(0.0, -(share * np.log2(share)).sum()):.4f}"


def _slot(digest: bytes, bits: int) -> int:
    """A digest's place in a bitmap of 2 ** bits."""
    return int.from_bytes(digest[:8], "big") >> (64 - bits)


def _digests(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                texts = batch.column(0).slice(start, 512).to_pylist()
                found = [d for t in texts for d, _ in chunks(to_wave(pad((t or "").encode())))]
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), pa.array([_slot(d, bits) for d in found], pa.int64())], names=["digest", "slot"])

    return run


class _Bitmap:
    def __init__(self, packed: bytes):
        self.packed, self.bits = packed, (8 * len(packed)).bit_length() - 1

    def __contains__(self, digest: bytes) -> bool:
        slot = _slot(digest, self.bits)
        return bool(self.packed[slot >> 3] >> (slot & 7) & 1)


def _shared_chunks(packed: bytes):
    bitmap = _Bitmap(packed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                found = {}
                for t in batch.column(0).slice(start, 512).to_pylist():
                    found.update((d, part) for d, part in chunks(to_wave(pad((t or "").encode()))) if d in bitmap)
                yield pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.binary()), pa.array(found.values(), pa.binary())], names=["digest", "bytes"])

    return run


def _stored(packed: bytes):
    bitmap = _Bitmap(packed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                rows = []
                for t in part.column(0).to_pylist():
                    data = (t or "").encode()
                    media = to_wave(pad(data))
                    listed, own = [], []
                    for d, piece in chunks(media):
                        shared = d in bitmap
                        listed.append({"digest": d, "size": len(piece), "shared": shared})
                        own += [] if shared else [piece]
                    rows.append((len(data), len(media), hashlib.sha256(media).digest(), listed, b"".join(own)))
                kinds = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.struct([("digest", pa.binary()), ("size", pa.int32()), ("shared", pa.bool_())])), pa.binary()]
                yield pa.RecordBatch.from_arrays([*part.columns[1:], *[pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]], names=[*part.schema.names[1:], "n_bytes", "media_bytes", "media", "chunks", "own"])

    return run


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns: those to keep, then media, chunks, own, parts (the shared chunks by position)."""
    for batch in batches:
        kept = batch.schema.names[:-3]
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            rows = []
            for digest, listed, own, shared in zip(*[part.column(n).to_pylist() for n in ("media", "chunks", "own", "parts")], strict=True):
                by_place, pieces, at = {p["pos"]: p["bytes"] for p in shared or []}, [], 0
                for pos, c in enumerate(listed):
                    piece = by_place[pos] if c["shared"] else own[at : at + c["size"]]
                    at += 0 if c["shared"] else c["size"]
                    if hashlib.sha256(piece).digest() != c["digest"]:
                        raise ValueError("a stored chunk does not have its digest")
                    pieces.append(piece)
                media = b"".join(pieces)
                if hashlib.sha256(media).digest() != digest:
                    raise ValueError("a stored medium does not have its digest")
                payload = from_wave(media)
                rows.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), features(payload)))
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([*[part.column(n) for n in kept], *[pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]], names=[*kept, "payload_bytes", "payload_sha256", "tail_crc32", "feature"])


READ_FIELDS = "payload_bytes long, payload_sha256 string, tail_crc32 long, feature string"


def store(docs: DataFrame, id_col: Column, text: Column) -> tuple[DataFrame, DataFrame]:
    """Two tables in the shared folder: media (id, n_bytes, media_bytes, media, chunks, own), a row per input row, and
    shared chunks (digest, bytes), a row per digest."""
    texts = docs.select(text.cast("string").alias("__text"), id_col.alias("id"))
    digests = texts.select("__text").mapInArrow(_digests(BITMAP_BITS), "digest binary, slot long")
    repeated = digests.groupBy("digest", "slot").agg(F.count("*").alias("n")).where("n > 1")
    words = repeated.groupBy(F.shiftright("slot", 5).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(slot % 32 AS int))")).alias("bits")).toPandas()
    bitmap = np.zeros(1 << (BITMAP_BITS - 5), dtype="<u4")
    bitmap[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.uint32)
    sent = bitmap.tobytes()
    shared = materialize(texts.select("__text").mapInArrow(_shared_chunks(sent), "digest binary, bytes binary").dropDuplicates(["digest"]))
    kind = texts.schema["id"].dataType.simpleString()
    media = materialize(texts.mapInArrow(_stored(sent), f"id {kind}, n_bytes long, media_bytes long, media binary, chunks array<struct<digest: binary, size: int, shared: boolean>>, own binary"))
    return media, shared


def read_back(media: DataFrame, shared: DataFrame) -> DataFrame:
    """Put every medium together again, verified: id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes,
    media_sha256, feature. Media with shared chunks are put together once for all rows that hold them."""
    kind = media.schema["id"].dataType.simpleString()
    lone = F.size(F.filter("chunks", lambda c: c["shared"])) == 0
    none = F.lit(None).cast("array<struct<pos: int, bytes: binary>>").alias("parts")
    whole = media.where(lone).select("id", "n_bytes", "media_bytes", "media", "chunks", "own", none)
    whole = whole.mapInArrow(_read_back, f"id {kind}, n_bytes long, media_bytes long, media binary, {READ_FIELDS}")
    rest = media.where(~lone)
    lists = rest.select("media", "chunks", "own").dropDuplicates(["media"])
    places = lists.select("media", F.posexplode("chunks").alias("pos", "c")).where("c.shared").select("media", "pos", F.col("c.digest").alias("digest"))
    uses = materialize(places.groupBy("digest").agg(F.count("*").alias("n")))
    parts = spread_join(places, shared, "digest", heavy_keys(uses, "digest", "n")).groupBy("media").agg(F.collect_list(F.struct("pos", "bytes")).alias("parts"))
    joined = lists.join(parts, "media").select("media", "chunks", "own", "parts").mapInArrow(_read_back, f"media binary, {READ_FIELDS}")
    copies = materialize(rest.groupBy("media").agg(F.count("*").alias("n")))
    joined = spread_join(rest.select("id", "n_bytes", "media_bytes", "media"), joined, "media", heavy_keys(copies, "media", "n")).select(whole.columns)
    return whole.union(joined).withColumn("media_sha256", F.lower(F.hex("media"))).drop("media")
