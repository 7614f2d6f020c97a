import hashlib

import pytest
import xxhash
from pyspark.sql import functions as F

from spindlekg.llm import ctph, queries


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


@pytest.mark.parametrize("a, b", [("abc", "abc"), ("abcdefgh", "xbcdexfgh"), ("a" * 64, "a" * 60 + "bbbb"), ("ABCD", "xyz"), ("a", "ba")])
def test_bit_parallel_subsequence(a, b):
    assert ctph._common(a, b) == lcs(a, b)


def brute_fingerprint(data):
    """Byte by byte: where pieces end, and each piece's character."""
    n = len(data)
    mixed = [int(ctph.MIX[b]) for b in data]
    rolling = [sum(mixed[i - k] * ctph.STEP[k] for k in range(min(ctph.WINDOW, i + 1))) % 2**32 for i in range(n)]

    def signature(block):
        ends = [i + 1 for i in range(n) if rolling[i] % block == block - 1]
        count = len(ends)
        ends = ends if ends and ends[-1] == n else [*ends, n]
        ends = [*ends[: ctph.PIECES - 1], n] if len(ends) > ctph.PIECES else ends
        out, start = "", 0
        for end in ends:
            s = sum(mixed[i] * int(ctph.POWERS[(i - start) & 4095]) for i in range(start, end)) % 2**32
            out += chr(ctph.LETTERS[((s ^ s >> 15) * 0x85EBCA6B % 2**32) >> 26])
            start = end
        return out, count

    block = ctph.LEAST
    while block * ctph.PIECES < n:
        block *= 2
    while block > ctph.LEAST and signature(block)[1] < ctph.PIECES // 2:
        block //= 2
    return f"{block}:{signature(block)[0]}:{signature(2 * block)[0]}"


def test_fingerprints_equal_brute_force(small):
    texts = [r.text for r in small.limit(25).collect()] + ["a", "ab" * 700, "x" * 3000, "The same line.\n" * 200]
    for t in texts:
        assert ctph.fingerprint(t.encode()) == brute_fingerprint(t.encode())


def test_likeness():
    text = "".join(hashlib.sha256(bytes([i])).hexdigest() for i in range(100))
    other = "".join(hashlib.sha512(bytes([i])).hexdigest() for i in range(60))
    mark = lambda t: ctph.fingerprint(t.encode())
    assert ctph.likeness(mark(text), mark(text)) == 1.0
    assert ctph.likeness(mark(text), mark(text[:3000] + "INSERTED" + text[3000:])) > 0.9
    assert ctph.likeness(mark(text), mark(text[: len(text) * 3 // 4] + other[: len(text) // 4])) > 0.6
    assert ctph.likeness(mark(text), mark(other)) == 0.0
    assert ctph.likeness("3::", mark(text)) == 0.0 and ctph.likeness("3::", "3::") == 1.0


def edited(rows):
    tie = lambda text: (xxhash.xxh64_intdigest(text.encode(), 42) + 2**63) % 2**64  # noqa: E731  as a signed number
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, tie(r[1] or ""), r[1] or ""))
    out = []
    for k, (i, t) in enumerate(rows):
        t, after = t or "", rows[(k + 1) % len(rows)][1] or ""
        n = len(t) // 4
        e = (t[: len(t) - n] + after[:n]).encode()
        a, b, c = ctph.fingerprint(t.encode()), ctph.fingerprint(e), ctph.fingerprint(after.encode())
        out.append((i, len(t), hashlib.sha256(e).hexdigest(), a, b, ctph.likeness(a, b), ctph.likeness(a, c)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("partitions", ["1", "4", "13"])
def test_neighbours_equal_brute_force(spark, small, partitions):
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = ctph.edited_neighbours(small.repartition(7), F.col("doc_id"), F.col("text")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
    assert sorted(map(tuple, got), key=repr) == edited([(r.doc_id, r.text) for r in small.collect()])


def test_rows_of_one_id_are_dealt_out(spark):
    """A third of the rows has the id 5, another third none; the rest is spread, with two ids far out."""
    rows = [(5, f"five {i} " * 9) for i in range(40)] + [(None, f"none {i}") for i in range(40)] + [(i * 1000, f"t{i}") for i in range(40)] + [(2**62, "far"), (-(2**62), "far")]
    df = spark.createDataFrame(rows, "id long, text string")
    assert sorted(map(tuple, ctph.edited_neighbours(df, F.col("id"), F.col("text")).collect()), key=repr) == edited(rows)
    lows = ctph.bounds([5, 9, 5, 5, 5])
    assert lows == [(5, -(2**63)), (5, -(2**62) * 1), (5, 0), (5, 2**62), (9, -(2**63))]
    pairs = [(4, 0), (5, -(2**63)), (5, -5), (5, 0), (5, 2**63 - 1), (8, 1), (9, 0), (10**9, 0)]
    at = spark.createDataFrame(pairs, "k long, t long")
    for bounds in (lows, [], ctph.bounds(range(0, 2000, 2))):
        got = at.select(ctph._bucket(F.col("k"), F.col("t"), bounds).alias("b")).collect()
        assert [r.b for r in got] == [sum(b <= p for b in bounds) for p in pairs]


def test_query_columns(spark):
    got = queries.op9_ctph(spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def test_edges(spark, edges, nothing):
    rows = [(r.doc_id, r.text) for r in edges.collect()]
    got = ctph.edited_neighbours(edges, F.col("doc_id"), F.col("text")).collect()
    assert sorted(map(tuple, got), key=repr) == edited(rows)
    assert ctph.edited_neighbours(nothing, F.col("doc_id"), F.col("text")).count() == 0
    single = spark.createDataFrame([(1, "abcdefgh")], "doc_id long, text string")
    assert ctph.edited_neighbours(single, F.col("doc_id"), F.col("text")).first().edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest()
    assert ctph.fingerprints(edges, F.col("text"), {"doc_id": F.col("doc_id")}).count() == edges.count()
