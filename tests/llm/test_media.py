import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from spindlekg.llm import media, queries


def padded(text):
    data = (text or "").encode()
    return data + b" " * ((-len(data)) % 192 if data else 192)


def brute_cuts(data):
    """The gear hash byte by byte."""
    ends, h, start = [], 0, 0
    for i, b in enumerate(data):
        h = ((h << 1) + int(media.GEAR[b])) % 2**32
        if i + 1 - start >= media.LEAST and h >> (32 - media.MEAN_BITS) == 0 or i + 1 - start >= media.MOST:
            ends.append(i + 1)
            start = i + 1
    return ends if ends and ends[-1] == len(data) else [*ends, len(data)]


@pytest.mark.parametrize("seed, n", [(0, 1), (1, 31), (2, 257), (3, 5_000), (4, 60_000)])
def test_cuts_equal_brute_force(seed, n):
    data = np.random.default_rng(seed).integers(97, 123, n).astype(np.uint8).tobytes()
    assert media.cuts(data) == brute_cuts(data)
    assert media.cuts(b" " * n)[-1] == n


def test_an_insertion_changes_few_chunks():
    data = np.random.default_rng(7).integers(0, 256, 200_000).astype(np.uint8).tobytes()
    a, b = ({d for d, _ in media.chunks(x)} for x in (data, data[:50_000] + b"inserted" + data[50_000:]))
    assert len(a - b) <= 2


def test_wave_is_lossless_and_checked():
    payload = bytes(range(192))
    assert media.from_wave(media.to_wave(payload)) == payload
    with pytest.raises(ValueError):
        media.from_wave(media.to_wave(payload) + b"x")


def check(rows, texts):
    assert len(rows) == len(texts)
    want = []
    for i, t in texts:
        p = padded(t)
        want.append((i, len((t or "").encode()), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-16:]), len(p) + 44, hashlib.sha256(media.to_wave(p)).hexdigest(), media.features(p)))
    assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, want))


def test_query_reads_back_every_document(spark):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    check(queries.op10_media_columns(spark, "/root/testdata/sf0.01").collect(), texts)


def test_shared_chunks_are_stored_once(spark):
    passage = "".join(hashlib.sha256(bytes([i])).hexdigest() for i in range(250))
    texts = [(i, passage if i % 2 else f"{i} {passage} {i}") for i in range(12)]
    m, shared = media.store(spark.createDataFrame(texts, "doc_id long, text string"), F.col("doc_id"), F.col("text"))
    assert shared.count() == shared.select("digest").distinct().count() > 0
    assert shared.agg(F.sum(F.length("bytes"))).first()[0] + m.agg(F.sum(F.length("own"))).first()[0] < 3 * len(passage) + 12 * 9000
    assert m.where("id % 2 = 1").agg(F.sum(F.length("own"))).first()[0] == 0
    got = media.read_back(m, shared)
    check(got.select("id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature").collect(), texts)


def test_a_full_bitmap_only_costs_space(spark, small, monkeypatch):
    monkeypatch.setattr(media, "BITMAP_BITS", 5)
    docs = small.select("doc_id", "text")
    got = media.read_back(*media.store(docs, F.col("doc_id"), F.col("text"))).select("id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")
    check(got.collect(), [tuple(r) for r in docs.collect()])


def test_edges(edges, nothing):
    got = media.read_back(*media.store(edges, F.col("doc_id"), F.col("text"))).select("id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")
    check(got.collect(), [(r.doc_id, r.text) for r in edges.collect()])
    assert media.read_back(*media.store(nothing, F.col("doc_id"), F.col("text"))).count() == 0
