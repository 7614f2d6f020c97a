import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from spindlekg.llm import packing, queries

PATH = queries.tokenizer_path("byte_bpe_50k.json")
PATTERN = queries.splitting_pattern()


@pytest.fixture(scope="module")
def plain():
    made = Tokenizer.from_file(PATH)
    made.encode_special_tokens = True
    return lambda text: [*made.encode(text or "", add_special_tokens=False).ids, 0]


def whole(sequences, lengths):
    """Each id of each document in just one piece."""
    seen = {}
    for sequence in sequences:
        for doc, start, length in sequence:
            seen.setdefault(doc, []).append((start, length))
    for doc, n in enumerate(lengths):
        at = 0
        for start, length in sorted(seen.pop(doc, [])):
            assert start == at and length > 0
            at += length
        assert at == n
    assert not seen


@pytest.mark.parametrize("seed", range(40))
def test_groups_are_packed_whole_and_without_padding(seed):
    rnd = random.Random(seed)
    lengths = [rnd.choice([1, 2, rnd.randint(1, 30), rnd.randint(1, 1500), 256, 512, 1024, 5000]) for _ in range(rnd.choice([0, 1, 2, 7, 60, 400]))]
    found = packing.pack_group(lengths)
    whole(found, lengths)
    sizes = [sum(p[2] for p in s) for s in found]
    assert all(0 < n <= 1024 and n & (n - 1) == 0 for n in sizes)
    assert sum(n not in packing.TIERS for n in sizes) <= 10


def test_short_documents_stay_in_short_tiers():
    sizes = [sum(p[2] for p in s) for s in packing.pack_group([200, 56] * 50 + [500, 12] * 20)]
    assert sizes.count(512) == 20 and sizes.count(256) == 50 and sum(sizes) == 50 * 256 + 20 * 512


def test_long_windows_take_short_tails_before_any_cut():
    found = packing.pack_group([1000, 24, 700, 324, 600, 400, 24])
    assert sorted(len(s) for s in found) == [2, 2, 3]


def test_step_groups_are_balanced():
    sizes = [1024] * 100 + [512] * 31 + [256] * 9
    loads = {}
    for size, group in zip(sizes, packing.step_groups(sizes, 1 << 13)):
        loads[group] = loads.get(group, 0) + size
    assert len(loads) == -(-sum(sizes) // (1 << 13)) and max(loads.values()) - min(loads.values()) <= 1024


def test_ids_are_the_tokenizers_librarys(plain, small):
    texts = ["", "a b  c <|endoftext|> é日本 \n\n x", "a" * 30_000, " " * 20_000 + "x" + "\t" * 15_000, "don't we'll 123 " * 5000, "\x85  x\x1c\x1d y", "　  x", *[r.text for r in small.collect()]]
    for text in texts:
        assert packing.encode(text, PATH, PATTERN).tolist() == plain(text)


def test_every_token_of_the_vocabulary_alone(plain):
    alphabet = packing.byte_alphabet()
    for token in list(Tokenizer.from_file(PATH).get_vocab())[::7]:
        if all(c in alphabet for c in token):
            text = bytes(alphabet[c] for c in token).decode(errors="replace")
            assert packing.encode(text, PATH, PATTERN).tolist() == plain(text)


def check(found, docs, plain):
    rows = found.collect()
    want = sorted((str(d), tuple(plain(t))) for d, t in docs)
    got, at = [], {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == at.get(r.sequence_id, 0) and r.length > 0
        at[r.sequence_id] = r.offset + r.length
    assert all(n <= 1024 and n & (n - 1) == 0 for n in at.values())
    assert all(at[r.sequence_id] == r.tier for r in rows)
    # documents of one id are told apart by their sizes and ids
    by_doc = {}
    for r in rows:
        by_doc.setdefault((str(r.doc_id), r.doc_tokens), {}).setdefault(r.start, []).append(np.frombuffer(bytes(r.ids), "<u4").tolist())
    for (doc, n), starts in by_doc.items():
        got.append((doc, n, sum(len(x) for v in starts.values() for x in v)))
    wanted = {}
    for doc, ids in want:
        wanted[doc, len(ids)] = wanted.get((doc, len(ids)), 0) + len(ids)
    assert sorted(got) == sorted((d, n, total) for (d, n), total in wanted.items())
    single = {k: v for k, v in by_doc.items() if all(len(x) == 1 for x in v.values())}
    ids = {(d, len(i)): list(i) for d, i in want}
    for key, starts in single.items():
        assert [x for s in sorted(starts) for x in starts[s][0]] == ids[key]


def test_odd_rows(spark, edges, nothing, plain):
    found = packing.pack(edges, F.col("doc_id"), F.col("text"), PATH, PATTERN, group_tokens=5000)
    check(found, [(r.doc_id, r.text) for r in edges.collect()], plain)
    assert packing.pack(nothing, F.col("doc_id"), F.col("text"), PATH, PATTERN).count() == 0


def test_tiers_must_divide_each_other(edges):
    with pytest.raises(ValueError):
        packing.pack(edges, F.col("doc_id"), F.col("text"), PATH, PATTERN, tiers=(1000, 500))


def test_query(spark, small, plain):
    found = queries.op12_packing(spark, "/root/testdata/sf0.001").collect()
    ids = {r.doc_id: plain(r.text) for r in small.collect()}
    covered = dict.fromkeys(ids, 0)
    used = {}
    for r in found:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert len(part) == r.length and r.doc_tokens == len(ids[r.doc_id])
        assert zlib.crc32(np.array(part, "<u4").tobytes()) == r.ids_crc32
        covered[r.doc_id] += r.length
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert covered == {d: len(i) for d, i in ids.items()}
    for parts in used.values():
        assert [sum(n for _, n in sorted(parts)[:i]) for i in range(len(parts))] == [o for o, _ in sorted(parts)]
    steps = {}
    for r in found:
        steps[r.step_group] = steps.get(r.step_group, 0) + r.length
    assert max(steps.values()) <= packing.STEP_TOKENS + 1024
