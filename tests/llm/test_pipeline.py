"""The pipeline's stages and the whole against plain versions of them, on a small table with every odd case."""

import collections
import hashlib
import math
import string

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from spindlekg.llm import bpe, language_id, pii, queries
from spindlekg.sources import scratch

STAGES = dict(corpus_pipeline.STAGES)
COLUMNS = list(corpus_pipeline.COLUMNS)
DATA = "/root/testdata/sf0.001"
DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def corpus(spark, small):
    """The smallest documents, near and far copies, neighbours in one fingerprint, nulls, empty and very long texts, repeated rows."""
    rows = [tuple(r[c] for c in COLUMNS) for r in small.collect()]
    rng = np.random.default_rng(2)
    words = [str(w) for r in rows if r[1] for w in r[1].split()]
    base = " ".join(rng.choice(words, 200))
    near = base.split()
    near[100] = "changed"
    far = base.split()
    far[::9] = ["other"] * len(far[::9])
    odd = [None, "", " \n", "12 34", base, base, " ".join(near), " ".join(far), base.translate({ord(c): c.upper() for c in string.ascii_lowercase}), "mail me at some.one@example.com or 4111 1111 1111 1111 please and thank you", " ".join(rng.choice(words, 30_000))]
    odd += [" ".join(["la le li"] * 200 + [f"{w}x{i}" for w in rng.choice(words, 60)]) for i in range(6)]
    rows += [(5000 + i, t, None if i % 3 else "xx", None, None if t is None else len(t)) for i, t in enumerate(odd)]
    rows += [rows[0], rows[0], (None, "no id but some words in it all the same", "en", "s", 1), (None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCUMENT)


def plain(rows):
    return [tuple(r[c] for c in COLUMNS) for r in rows]


def same(got, want):
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def plain_language(rows, model):
    vocabulary, kept = language_id.pieces(model.vocabulary), []
    for r in rows:
        words = [w for w in language_id._words(r[1] or "") if any(c.isalpha() for c in w)]
        if words:
            total = model.priors + sum(language_id.word_scores([(" " + w).encode()], model.probabilities, vocabulary)[0] for w in words)
            best = int(total.argmax())
            if 1 / np.exp(np.minimum(0, total - total[best])).sum() >= corpus_pipeline.LEAST_SCORE:
                kept.append((r[0], r[1], model.labels[best], r[3], r[4]))
    return kept


def plain_dedup(rows):
    """One row of each component of pairs with a Jaccard similarity of 0.8, the smallest id first; a text is one node."""
    sets = {}
    for text in {r[1] or "" for r in rows}:
        w = text.encode().lower().split()
        sets[text] = frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    root = {t: t for t in sets}

    def find(t):
        while root[t] != t:
            t = root[t]
        return t

    listed = sorted(sets)
    for i, a in enumerate(listed):
        for b in listed[:i]:
            x, y = sets[a], sets[b]
            if min(len(x), len(y)) >= 0.8 * max(len(x), len(y)) and len(x & y) >= 0.8 * len(x | y):
                root[find(a)] = find(b)
    groups = collections.defaultdict(list)
    for r in rows:
        groups[find(r[1] or "")].append(r)
    digest = lambda t: hashlib.md5((t or "").encode()).digest()
    return [min(g, key=lambda r: (r[0] is None, r[0] or 0, digest(r[1]), repr(r))) for g in groups.values()]


def plain_pii(rows, key):
    own = pii.Pseudonyms(key)
    made = [(r[0], r[1] if r[1] is None else own.apply(r[1])[0], *r[2:4]) for r in rows]
    return [(*r, None if r[1] is None else len(r[1])) for r in made]


def test_language_stage(spark, corpus):
    got = STAGES["language_id"](spark, corpus, DATA)
    assert got.columns == COLUMNS
    model = language_id.fit(corpus, queries.tokenizer_path("byte_bpe_multi_50k.tiktoken"))
    want = plain_language(plain(corpus.collect()), model)
    same(plain(got.collect()), want)
    assert len(want) > 190 and not {5000, 5001, 5002, 5003} & {r[0] for r in want}


def test_dedup_stage(spark, corpus):
    got = STAGES["simhash_dedup"](spark, corpus, DATA)
    assert got.columns == COLUMNS
    want = plain_dedup(plain(corpus.collect()))
    same(plain(got.collect()), want)
    ids = {r[0] for r in want}
    assert {5004, 5007, 5009, 5010} <= ids and not {5005, 5006, 5008} & ids and len(want) == len(ids)


def test_pii_stage(spark, corpus):
    got = STAGES["pii"](spark, corpus, DATA)
    assert got.columns == COLUMNS
    want = plain_pii(plain(corpus.collect()), queries.pseudonym_key(spark))
    same(plain(got.collect()), want)
    assert not any("4111 1111 1111 1111" in (r[1] or "") for r in want)


def test_mixing_stage(spark, corpus):
    got = STAGES["mixing"](spark, corpus, DATA)
    assert got.columns == COLUMNS
    was, now = (collections.Counter(map(repr, plain(df.collect()))) for df in (corpus, got))
    assert not set(now) - set(was)
    for row, n in now.items():  # a row is repeated as a whole number next to its rate
        assert n % was[row] == 0 or was[row] > 1
    tokens = lambda df: df.select(F.sum(F.size(F.filter(F.split(F.coalesce("text", F.lit("")), r"\s+"), lambda w: w != "")))).first()[0]
    assert math.isclose(tokens(got), tokens(corpus), rel_tol=0.25)


def test_bpe_stage(spark, corpus):
    got = STAGES["byte_bpe"](spark, corpus, DATA).collect()
    coder = tiktoken.Encoding("plain", pat_str=queries.splitting_pattern(), mergeable_ranks=bpe.encoding(queries.tokenizer_path("byte_bpe_multi_50k.tiktoken"), queries.splitting_pattern())._mergeable_ranks, special_tokens={})
    want = []
    for r in plain(corpus.collect()):
        ids = coder.encode_ordinary(r[1] or "")
        want.append((r[0], r[2], r[3], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r[1] or "").encode()).hexdigest(), ids))
    same([(r.doc_id, r.lang, r.source, r.n_tokens, r.ids_sha256, r.decoded_sha256, list(r.ids)) for r in got], want)


@pytest.mark.parametrize("name", STAGES)
def test_stages_take_empty_tables_and_clashing_columns(spark, edges, nothing, name):
    assert STAGES[name](spark, nothing, DATA).count() == 0
    found = STAGES[name](spark, edges, DATA)
    assert found.columns == (COLUMNS if name != "byte_bpe" else found.columns) and found.count() > 0


def test_many_texts_of_one_fingerprint_take_no_more_rounds(spark):
    """Texts in which one repeated phrase decides the fingerprint, and which are not alike."""

    def jobs(n):
        texts = [" ".join(["a b c"] * 200 + [f"t{i}x{k}" for k in range(60)]) for i in range(n)]
        docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], DOCUMENT)
        group = f"dedup of {n}"
        spark.sparkContext.setJobGroup(group, group)
        kept = STAGES["simhash_dedup"](spark, docs, DATA).count()
        spark.sparkContext.setJobGroup("", "")
        return kept, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    (few, jobs_few), (many, jobs_many) = jobs(10), jobs(200)
    assert (few, many) == (10, 200) and jobs_many <= jobs_few + 5


def test_the_whole(spark, corpus, tmp_path, monkeypatch):
    """And the tables that the stages made on their way are removed, but for the stages' results and the last stage's."""
    removed = []
    monkeypatch.setattr(corpus_pipeline, "remove", lambda s, paths: (removed.extend(paths), scratch.remove(s, paths)))
    corpus.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{DATA}/labels.parquet").coalesce(1).write.parquet(f"{tmp_path}/labels.parquet")
    with scratch.scope() as left:
        got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert len(removed) > 20 and len(left) < 8 and not set(removed) & set(left)
    model = language_id.fit(corpus, queries.tokenizer_path("byte_bpe_multi_50k.tiktoken"))
    rows = plain_pii(plain_dedup(plain_language(plain(corpus.collect()), model)), queries.pseudonym_key(spark))
    mixed = STAGES["mixing"](spark, spark.createDataFrame(rows, DOCUMENT), str(tmp_path))
    same([(r.doc_id, r.lang, r.source, r.decoded_sha256) for r in got], [(r.doc_id, r.lang, r.source, hashlib.sha256(r.text.encode()).hexdigest()) for r in mixed.collect()])
    assert len(got) > 100
