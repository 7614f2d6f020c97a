import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from spindlekg.llm import language_id as li
from spindlekg.llm import queries
from spindlekg.llm.common import trimmed

PATH = queries.tokenizer_path("byte_bpe_multi_50k.tiktoken")


def brute(word, p, vocabulary):
    """The sum over all ways of cutting the word, each tried."""
    total = np.zeros(p.shape[1])
    for n in range(len(word)):
        for cut in itertools.combinations(range(1, len(word)), n):
            parts = [word[a:b] for a, b in zip((0, *cut), (*cut, len(word)), strict=True)]
            if all(x in vocabulary.ids for x in parts):
                total += np.prod([p[vocabulary.ids[x]] for x in parts], axis=0)
    return np.log(total)


@pytest.fixture(scope="module")
def toy():
    vocabulary = li.Vocabulary({bytes([b]) for b in b" abcd"} | {b" a", b"ab", b"bc", b"abc", b" ab"})
    p = np.random.default_rng(1).random((len(vocabulary) + 1, 2))
    p[-1] = 0
    return vocabulary, p / p.sum(axis=0)


def test_forward_sums_all_segmentations(toy):
    vocabulary, p = toy
    words = [b" abc", b" abcd", b" a", b" dabcabc"]
    assert np.allclose(li.word_scores(words, p, vocabulary), [brute(w, p, vocabulary) for w in words])


def test_long_words_score_the_same_way(toy):
    vocabulary, p = toy
    words = [b" abcdabcdab", b" abc", b" abcdab" * 3, b"d"]
    assert np.allclose([li._long_score(w, p, vocabulary) for w in words], li.word_scores(words, p, vocabulary))
    assert np.allclose(li._long_score(words[0], p, vocabulary), brute(words[0], p, vocabulary))
    long = b"abcdab" * 4000  # twice as long is about twice as unlikely, whatever the window's place
    assert np.allclose(2 * li._long_score(long, p, vocabulary), li._long_score(long * 2, p, vocabulary), rtol=1e-3)
    assert np.isfinite(li.word_scores([b" " + b"abcd" * 5000], p, vocabulary)).all()


def test_long_words_count_the_same_way(toy, monkeypatch):
    vocabulary, p = toy
    words, weights = [b" abcdabcdab", b" abc", b" abcdab" * 3, b" dddddddddd"], np.array([2.0, 1.0, 3.0, 5.0])
    want = li.expected_counts(words, weights, p[:, 1], vocabulary)
    monkeypatch.setattr(li, "SHORT_WORD", 2)
    assert np.allclose(li.expected_counts(words, weights, p[:, 1], vocabulary), want)


@pytest.mark.parametrize("block", [3, 8, 1 << 16])
def test_words_counted_in_blocks_count_the_same_way(toy, block):
    vocabulary, p = toy
    for word in (b" abc", b" abcdabcdab", b" abcdab" * 9, b" " + b"d" * 40, b"a"):
        found = np.zeros(len(vocabulary) + 1)
        for piece, n in li._whole_word_counts(word, np.log(p[:, 1], where=p[:, 1] > 0, out=np.full(len(p), -np.inf)).tolist(), vocabulary, block).items():
            found[piece] = n
        assert np.allclose(found, li.expected_counts([word], np.array([1.0]), p[:, 1], vocabulary))


def test_a_training_word_of_a_thousand_bytes_counts_as_brute_force(toy):
    """Against counts that come from the change of the whole sum with each piece's probability."""
    vocabulary, p = toy
    word, column = b" abcdab" * 150, p[:, 1]
    counts = li.expected_counts([word], np.array([1.0]), column, vocabulary)
    for piece in range(len(vocabulary)):
        moved = [column.copy(), column.copy()]
        moved[0][piece] *= 1 + 1e-5
        moved[1][piece] *= 1 - 1e-5
        scores = [li._long_score(word, m.reshape(-1, 1), vocabulary)[0] for m in moved]
        assert counts[piece] == pytest.approx((scores[0] - scores[1]) / 2e-5, rel=1e-4, abs=1e-4)


def test_no_training_word_is_left_out():
    vocabulary = li.pieces(PATH)
    p = np.append(np.full(len(vocabulary), 1 / len(vocabulary)), 0)
    size = np.array([len(x) for x in vocabulary.ids] + [0])
    for word in (" もうすぐ着きます", " Donaudampfschifffahrtsgesellschaft", " " + "ภาษาไทย" * 40, " " + "x" * 1000, " " + "ภาษาไทย" * 9000):
        counts = li.expected_counts([word.encode()], np.array([2.0]), p, vocabulary)
        assert math.isclose(counts @ size, 2 * len(word.encode()), rel_tol=1e-6)  # every byte is covered once
    assert vocabulary.longest > 30


def test_held_out_accuracy_of_scripts_without_spaces(spark):
    """Three languages of one script of three-byte letters, told apart by their words alone, which nothing separates."""
    rng = np.random.default_rng(4)
    letters = [chr(0x3042 + 2 * i) for i in range(30)]
    lists = {lang: ["".join(rng.choice(letters, 3)) for _ in range(40)] for lang in ("aa", "bb", "cc")}
    made = [(i, lang, "".join(rng.choice(words, 30))) for i, (lang, words) in enumerate(list(lists.items()) * 60)]
    docs = spark.createDataFrame(made, "doc_id long, lang string, text string")
    model = li.fit(docs.where("doc_id < 120"), PATH, rounds=4)
    found = li.predict(docs.where("doc_id >= 120"), model, F.col("text"), {"lang": F.col("lang")}).collect()
    assert len(found) == 60 and sum(r.lang == r.lang_pred for r in found) >= 57


def test_expected_counts_are_the_gradient(toy):
    vocabulary, p = toy
    words, weights = [b" abc", b" abcab"], np.array([2.0, 3.0])
    counts = li.expected_counts(words, weights, p[:, 0], vocabulary)
    score = lambda q: float(li.word_scores(words, q, vocabulary)[:, 0] @ weights)
    for piece in (b"ab", b"c", b" a"):
        up = p.copy()
        up[vocabulary.ids[piece], 0] *= 1 + 1e-6
        assert math.isclose((score(up) - score(p)) / 1e-6, counts[vocabulary.ids[piece]], rel_tol=1e-3, abs_tol=1e-6)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    found = queries.op1_language_id(spark, "/root/testdata/sf0.01").join(docs, "doc_id").where("held_out")
    right, n = found.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 100 and right / n >= 0.99


def test_edges(spark, edges, nothing, small):
    model = li.fit(small, PATH, documents_per_label=20, rounds=2)
    found = li.predict(edges, model, F.col("text"), {"doc_id": F.col("doc_id")}).collect()
    assert len(found) == edges.count()
    assert {(r.lang_pred, r.score) for r in found if r.doc_id in (1, 2, 3)} == {("und", 0.0)}
    assert len({(r.lang_pred, r.score) for r in found if r.doc_id in (5, 6)}) == 1
    assert all(0 <= r.score <= 1 for r in found)
    assert li.predict(nothing, model, F.col("text"), {"doc_id": F.col("doc_id")}).count() == 0
    untrained = li.fit(nothing, PATH)
    assert {r.lang_pred for r in li.predict(edges, untrained, F.col("text"), {}).collect()} == {"und"}


def test_what_a_worker_keeps_goes_with_the_next_operator():
    li.pieces(PATH)
    li._cache("model", 4)
    assert list(trimmed(iter([1, 2]), "language_id")) == [1, 2] and li._worker is not None
    assert list(trimmed(iter([1, 2]), "simhash")) == [1, 2] and li._worker is None and li.pieces.cache_info().currsize == 0
