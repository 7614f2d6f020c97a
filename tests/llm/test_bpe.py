import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spindlekg.llm import bpe, queries

PATH, PATTERN = queries.tokenizer_path("byte_bpe_multi_50k.tiktoken"), queries.splitting_pattern()
CODER = bpe.encoding(PATH, PATTERN)


def joined(text, at_once):
    parts = list(bpe.pieces(text, at_once))
    assert "".join(parts) == text
    return [i for p in parts for i in CODER.encode_ordinary(p)]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab1 \n\t'.s!é日  \x1f<|endoftext>", max_size=60), st.integers(1, 7))
def test_pieces_encode_as_the_whole(text, at_once):
    assert joined(text, at_once) == CODER.encode_ordinary(text)
    assert CODER.decode_bytes(bpe.encode(text, PATH, PATTERN)) == text.encode()


def test_given_documents_in_pieces(small):
    for r in small.collect():
        assert joined(r.text, 50) == CODER.encode_ordinary(r.text)


@pytest.mark.parametrize("text", ["a" * 300_000, " " * 200_000 + "x", "!" * 100_000, "<|endoftext|>", "ab " * 100_000, "日本" * 50_000, "\U0001f600" * 1000])
def test_long_and_odd_texts_come_back(text):
    assert CODER.decode_bytes(bpe.encode(text, PATH, PATTERN)) == text.encode()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["    ", "\xa0\xa0\xa0", "\n\n\n\n", " \t\u3000 ", " ", "a", "é", "!", "1", "'s", "\x1c\x1d\x1e\x1f", "\u200b"]), max_size=12))
def test_runs_of_white_space_encode_as_the_whole(parts):
    text = "".join(parts)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(bpe, "LONG_RUN", 2)
        patch.setattr(bpe, "RUNS", re.compile(f"[{bpe.WHITE}]{{2,}}"))
        assert bpe.encode(text, PATH, PATTERN) == CODER.encode_ordinary(text)


def test_white_space_is_the_engines():
    import regex

    python = {c for c in map(chr, range(0x10000)) if regex.match(r"\p{White_Space}", c)}
    assert {c for c in map(chr, range(0x10000)) if re.match(f"[{bpe.WHITE}]", c)} == python


@pytest.mark.parametrize("run", [" ", "\xa0", " \n", "\t \u3000\xa0", "\n"])
@pytest.mark.parametrize("n", [10_000, 100_000])
@pytest.mark.parametrize("after", ["", "x", "!", "\x1f"])
def test_long_runs_equal_the_library(run, n, after):
    text = "one" + run * (n // len(run)) + after
    assert bpe.encode(text, PATH, PATTERN) == CODER.encode_ordinary(text)


@pytest.mark.parametrize("n", [1_000_000, 5_000_000, 20_000_000])
@pytest.mark.parametrize("run", [" ", "\xa0", " \n\t\xa0"])
def test_very_long_runs_come_back(run, n):
    """The library cannot take these whole; a run's ids are a shorter run's with more of what it repeats."""
    text = "one two" + run * (n // len(run)) + "three" + run
    ids = bpe.encode(text, PATH, PATTERN)
    assert CODER.decode_bytes(ids) == text.encode()
    short = CODER.encode_ordinary("one two" + run * (100_000 // len(run)) + "three" + run)
    assert ids[:50] == short[:50] and ids[-6:] == short[-6:]


def test_query_equals_the_library(spark, small):
    import hashlib

    found = {r.doc_id: r for r in queries.op6_byte_bpe(spark, "/root/testdata/sf0.001").collect()}
    for r in small.collect():
        ids = CODER.encode_ordinary(r.text)
        want = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(r.text.encode()).hexdigest())
        assert (found[r.doc_id].n_tokens, found[r.doc_id].ids_sha256, found[r.doc_id].decoded_sha256) == want


def test_edges(edges, nothing):
    found = bpe.round_trip(edges, F.col("text"), PATH, PATTERN, {"doc_id": F.col("doc_id"), "ids_too": F.col("lang")}, keep_ids=True).collect()
    assert len(found) == edges.count() and {r.n_tokens for r in found if r.doc_id in (1, 2)} == {0}
    assert {r.doc_id: bytes(r.decoded).decode() for r in found}[8] == "日本語テキスト。123 <s>"
    assert bpe.round_trip(nothing, F.col("text"), PATH, PATTERN, {}).count() == 0


@pytest.mark.parametrize("text, least", [("привет мир это текст " * 30_000, 8), ("日本語の文章です。" * 60_000, 8), ("ελληνικά και άλλα\n" * 30_000, 8), ("한국어 문장입니다. " * 40_000, 8)])
def test_long_texts_of_any_script_are_cut(text, least):
    assert len(list(bpe.pieces(text))) >= least
    assert bpe.encode(text, PATH, PATTERN) == bpe.encoding(PATH, PATTERN).encode_ordinary(text)


def test_cuts_are_match_boundaries():
    import random

    rnd, coder, cuts = random.Random(5), bpe.encoding(PATH, PATTERN), 0
    alphabet = "ab Zé  \n\n\tж日本。，.!?'s_-0９٣ᾴᲀ\x1c　 ́中かガ한"
    for _ in range(2000):
        text = "".join(rnd.choices(alphabet, k=rnd.randint(1, 60)))
        parts = list(bpe.pieces(text, 3))
        cuts += len(parts) - 1
        assert "".join(parts) == text and [i for p in parts for i in coder.encode_ordinary(p)] == coder.encode_ordinary(text)
    assert cuts > 3000
