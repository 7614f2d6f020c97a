import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from spindlekg.llm import divergence, queries

TERM = re.compile(divergence.TERM)
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, least=10, top=10):
    """docs: (text, lang, source)."""
    counts, seen, groups = Counter(), {}, set()
    for i, (text, lang, source) in enumerate(docs):
        groups.add((lang or "", source or ""))
        for term in TERM.findall((text or "").translate(LOWER)):
            counts[lang or "", source or "", term] += 1
            seen.setdefault((lang or "", term), set()).add(i)
    kept = {}
    for (lang, term), ids in seen.items():
        if len(ids) >= least:
            kept.setdefault(lang, []).append(term)
    out = []

    def shares(lang, sources):
        terms = kept.get(lang, [])
        n = {t: sum(counts[lang, s, t] for s in sources) for t in terms}
        return n, {t: 1 + 10**9 * (n[t] + 2) // (sum(n.values()) + 2 * len(terms)) for t in terms}

    f = lambda p, q: (p - q) ** 2 // (p + q)
    for lang, source in groups:
        n, p = shares(lang, [source])
        every = [s for g, s in groups if g == lang]
        _, q = shares(lang, every)
        pairs = [(sum(f(p[t], x) for t, x in shares(lang, [o])[1].items()), o) for o in every if o != source]
        terms = [(f(p[t], q[t]), t) for t in p if n[t] and p[t] > q[t]]
        for part, found, most in (("pair", pairs, None), ("term", terms, top)):
            for rank, (value, item) in enumerate(sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most], 1):
                out.append((lang, source, part, item, value, rank))
    return sorted(out)


def audit(df, **more):
    return sorted(tuple(r) for r in divergence.audit(df, F.col("text"), F.col("lang"), F.col("source"), **more).collect())


def test_every_length_of_term_is_counted():
    rnd = random.Random(5)
    letters = "abcXYZéß日本\U00010348"
    texts = [" ".join("".join(rnd.choices(letters, k=rnd.randint(1, 24))) for _ in range(rnd.randint(0, 60))) + rnd.choice(["", ".", "9"]) for _ in range(300)] + ["", "q" * 5000, "Q" * 5000, "a", "a\x00b", "ab"]
    raw = [t.encode() for t in texts]
    starts = np.cumsum([0, *map(len, raw)])[:-1]
    groups = np.array([i % 3 for i in range(len(texts))])
    got, docs = Counter(), Counter()
    for of, terms, n, d in divergence.count_slice(np.frombuffer(b"".join(raw), np.uint8), starts, np.arange(len(texts)), groups):
        for g, t, k, m in zip(of.tolist(), terms, n.tolist(), d.tolist()):
            assert (g, t) not in got
            got[g, t], docs[g, t] = k, m
    want, want_docs = Counter(), Counter()
    for i, t in enumerate(texts):
        found = Counter(x.encode() for x in TERM.findall(t.translate(LOWER)))
        for x, k in found.items():
            want[i % 3, x] += k
            want_docs[i % 3, x] += 1
    assert got == want and docs == want_docs


def test_radix_order_is_stable():
    rng = np.random.default_rng(1)
    words = [rng.integers(0, 4, 5000).astype(np.uint64) << np.uint64(40), rng.integers(0, 3, 5000).astype(np.uint64) << np.uint64(33)]
    assert divergence.radix_order(words, 8).tolist() == sorted(range(5000), key=lambda i: (words[0][i], words[1][i], i))


def test_long_texts_are_cut_between_terms(spark):
    rnd = random.Random(2)
    text = " ".join("".join(rnd.choices("abé", k=rnd.randint(1, 30))) for _ in range(4000)) + "w" * 500
    df = spark.createDataFrame([(text, "x", "s"), ("ab", "x", "s"), ("ab " * 300, "x", "t")], "text string, lang string, source string")
    found = {(r.source, r.term): (r.n, r.d) for r in divergence.count_terms(df, F.col("text"), F.col("lang"), F.col("source"), size=100).collect()}
    want = Counter(TERM.findall(text))
    assert {t: v[0] for (s, t), v in found.items() if s == "s"} == dict(want + Counter(["ab"]))
    assert found["s", "ab"][1] == 1 + ("ab" in want) and found["t", "ab"] == (300, 1)


@pytest.mark.parametrize("tile", [2, 256])
def test_audit_equals_brute_force(spark, tile):
    rnd = random.Random(11)
    words = ["the", "The", "of", "règle", "straße", "a" * 8, "b" * 9, "c" * 16, "d" * 17, "e" * 40, "日本語", "rare"]
    docs = [(" ".join(rnd.choices(words, weights=range(12, 0, -1), k=rnd.randint(0, 30))), rnd.choice(["en", "de", None, ""]), rnd.choice(["s1", "s2", "s3", None, "ü", "s5"])) for _ in range(250)]
    docs += [(None, "xx", "alone"), ("", "yy", "a"), (None, "yy", "b"), ("once", "yy", "b"), ("9 . _", "zz", "q")]
    df = spark.createDataFrame(docs, "text string, lang string, source string")
    assert audit(df, tile=tile) == brute(docs)
    assert audit(df, least_docs=1, top=3) == brute(docs, 1, 3)


def test_odd_rows(edges, nothing):
    assert audit(edges, least_docs=1) == brute([(r.text, r.lang, r.source) for r in edges.collect()], 1)
    assert audit(nothing) == []


def test_shares_are_exact_for_large_counts(spark):
    rows = [(10**13, 3 * 10**13, 10**6), (0, 2 * 10**14, 1), (2 * 10**14, 2 * 10**14, 1), (0, 0, 1)]
    df = spark.createDataFrame(rows, "c long, n long, v long")
    got = [r[0] for r in df.select(divergence.share(F.col("c"), F.col("n"), F.col("v"))).collect()]
    assert got == [1 + 10**9 * (c + 2) // (n + 2 * v) for c, n, v in rows]


def test_query_equals_sql(spark):
    data = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{data}/documents.parquet'")
    assert sorted(map(tuple, queries.op11_source_divergence(spark, data).collect())) == sorted(con.sql(divergence.oracle()).fetchall())
