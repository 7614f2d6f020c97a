import collections

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from spindlekg.llm import queries, simhash
from spindlekg.llm.common import connected_components


def reference(text, size):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    runs = [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


@pytest.mark.parametrize("text", [None, "", " \t\n", "One", "one two", "One two THREE four", "É É É É a\x85b", "w " * 2000, "a b c " * 300])
@pytest.mark.parametrize("size", [1, 3, 5])
def test_fingerprint_is_the_definition(text, size):
    assert simhash.fingerprint(text, size) == reference(text, size)


def near_bits(rng, n):
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    made = {int(rng.choice(base)) ^ int(sum({1 << int(b) for b in rng.integers(0, 64, rng.integers(0, 4))})) for _ in range(n)}
    return np.array(sorted(made), dtype=np.uint64)


@pytest.mark.parametrize("radius", [0, 2, 5])
@pytest.mark.parametrize("held", [10**6, 0])
def test_tiles_find_every_component(radius, held, monkeypatch):
    monkeypatch.setattr(simhash, "HELD_LINKS", held)
    rng = np.random.default_rng(radius)
    fps = near_bits(rng, 900)
    apart = np.bitwise_count(fps[:, None] ^ fps[None, :])
    every = {(i, j) for i, j in zip(*np.nonzero(apart <= radius), strict=True) if i < j}
    at = {int(f): i for i, f in enumerate(fps)}
    pick = lambda links: [(at[a], at[b]) for a, b in links]
    whole = pick(simhash.tile_links(fps, None, radius))
    assert groups(len(fps), whole) == groups(len(fps), every) and len(whole) < len(fps)
    left, right = fps[::2], fps[1::2]
    parts = pick(simhash.tile_links(left, None, radius) + simhash.tile_links(right, None, radius) + simhash.tile_links(left, right, radius))
    assert groups(len(fps), parts) == groups(len(fps), every)


def test_components_equal_brute_force(spark, small):
    docs = small.select("doc_id", "text").union(spark.createDataFrame([(900 + i, "near copies of one text " * 30 + f"{i}") for i in range(40)], "doc_id long, text string")).collect()
    fps = np.array([reference(r.text, 3) for r in docs], dtype=np.uint64)
    roots = groups(len(docs), zip(*np.nonzero(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 2), strict=True))
    low = collections.defaultdict(lambda: 10**9)
    for r, root in zip(docs, roots, strict=True):
        low[root] = min(low[root], r.doc_id)
    want = {r.doc_id: (int(f), low[root]) for r, f, root in zip(docs, fps, roots, strict=True)}
    got = simhash.components(spark.createDataFrame(docs), F.col("doc_id"), F.col("text")).collect()
    assert {r.id: (r.fp % 2**64, r.component_id) for r in got} == want and len(got) == len(docs)


def test_many_tiles(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE_LEAST", 16)
    monkeypatch.setattr(simhash, "TILE_MOST", 64)
    fps = near_bits(np.random.default_rng(9), 700)
    df = spark.createDataFrame([(int(f),) for f in fps.view(np.int64)], "fp long")
    at = {int(f): i for i, f in enumerate(fps.view(np.int64))}
    links = [(at[r.a], at[r.b]) for r in simhash.near_pairs(df, 2).collect()]
    every = zip(*np.nonzero(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 2), strict=True)
    assert groups(len(fps), links) == groups(len(fps), every)


def test_query_shape(spark):
    got = queries.op8_simhash_dedup(spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert all(len(r.fingerprint) == 16 and r.component_id <= r.doc_id for r in got.collect())


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, x) for x in range(101, 160)] + [(7, 7), (None, 3)]
    found = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {found[i] for i in range(61)} == {0} and {found[i] for i in range(100, 160)} == {100} and len(found) == 61 + 60
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_edges(edges, nothing):
    found = simhash.components(edges, F.col("doc_id"), F.col("text")).collect()
    assert len(found) == edges.count()
    by_id = collections.defaultdict(set)
    for r in found:
        by_id[r.id].add((r.fp, r.component_id))
    assert by_id[1] == by_id[2] == by_id[3] == {(0, 1)} and by_id[5] == by_id[6] and len(by_id[5]) == 1
    assert (0, 1) in by_id[None]
    assert simhash.components(nothing, F.col("doc_id"), F.col("text")).count() == 0


def test_near_duplicates_leave_one_of_each_group(spark, edges, nothing):
    kept = simhash.drop_near_duplicates(edges)
    assert kept.columns == edges.columns
    rows = kept.collect()
    assert sorted(r.doc_id for r in rows if r.doc_id is not None) == [-3, 1, 4, 5, 7, 8, 9]
    assert [r.text for r in rows if r.doc_id is None] == ["no id at all"] and all(r["__node"] == "mine" for r in rows if r.doc_id is not None)
    assert simhash.drop_near_duplicates(nothing).count() == 0


@pytest.mark.parametrize("rows", [10**6, 0])
def test_near_duplicates_by_similarity(spark, monkeypatch, rows):
    """Texts of 200 words with some changed: kept apart below a similarity of 0.8, whichever way the joins go."""
    monkeypatch.setattr(simhash, "BROADCAST_ROWS", rows)
    rng = np.random.default_rng(5)
    base = [[f"w{x}" for x in rng.integers(0, 10**6, 200)] for _ in range(6)]
    made = []
    for i, words in enumerate(base):
        for j, changes in enumerate((0, 0, 1, 2, 3, 12)):
            new = list(words)
            for at in range(changes):
                new[10 + at * 14] = f"x{i}-{j}-{at}"
            made.append((i * 10 + j, " ".join(new)))
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(196)} for i, t in made}
    links = [(a, b) for a in range(len(made)) for b in range(len(made)) if len((x := sets[made[a][0]]) & (y := sets[made[b][0]])) >= 0.8 * len(x | y)]
    roots = groups(len(made), links)
    want = sorted(made[i][0] for i in range(len(made)) if roots[i] == i)
    got = sorted(r.doc_id for r in simhash.drop_near_duplicates(spark.createDataFrame(made, "doc_id long, text string")).collect())
    assert got == want and len(want) < len(made)


def alike(made, size=5, similarity=0.8):
    sets = [{tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} for w in (t.split() for _, t in made)]
    return [(a, b) for a in range(len(made)) for b in range(a) if len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b])]


def kept_ids(spark, made, **options):
    return sorted(r.doc_id for r in simhash.drop_near_duplicates(spark.createDataFrame(made, "doc_id long, text string"), **options).collect())


def test_near_duplicates_beyond_the_radius(spark):
    """A line repeated many times leaves the set of shingles as it is, all but two or so, and moves the fingerprint far."""
    rng = np.random.default_rng(11)
    made = []
    for i in range(12):
        words = [f"w{x}" for x in rng.integers(0, 10**6, 300)]
        made += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(words + words[-20:] * 12))]
    assert max((reference(made[2 * i][1], 3) ^ reference(made[2 * i + 1][1], 3)).bit_count() for i in range(12)) > 12
    assert len(alike(made)) == 12
    assert kept_ids(spark, made) == [2 * i for i in range(12)]


def first_of_each(made):
    roots = groups(len(made), alike(made))
    return sorted(made[i][0] for i in range(len(made)) if roots[i] == i)


def test_near_duplicates_beside_failed_links(spark):
    """Families with a long passage in common: many candidates in reach, of which a forest holds some that are not links."""
    rng = np.random.default_rng(3)
    made = []
    for _ in range(2):
        passage = [f"w{x}" for x in rng.integers(0, 10**6, 150)]
        for _ in range(20):
            own = [f"v{x}" for x in rng.integers(0, 10**6, 38)]
            for _ in range(2):
                words = passage + own
                for at in rng.choice(len(words), 2, replace=False):
                    words = [*words[:at], f"x{rng.integers(10**6)}", *words[at + 1 :]]
                made.append((len(made), " ".join(words)))
    assert len(first_of_each(made)) < len(made)
    assert kept_ids(spark, made) == first_of_each(made)


def test_near_duplicates_of_one_fingerprint_in_a_chain(spark):
    """The repeated words decide the fingerprint; the middle text is alike both others, which are not alike."""
    tail = [f"t{i}" for i in range(120)]
    texts = [" ".join(["a b c"] * 200 + [f"y{i}" if i < changed else w for i, w in enumerate(tail)]) for changed in (0, 14, 7)]
    made = [(1, texts[0]), (2, texts[1]), (3, texts[2])]
    assert len({reference(t, 3) for t in texts}) == 1
    assert sorted(alike(made)) == [(2, 0), (2, 1)]
    assert kept_ids(spark, made) == [1]


def test_links_within_a_joined_group_cost_no_step_each():
    """A forest of a set in which nearly all are linked, equal to that of one link after the other."""
    rng = np.random.default_rng(1)
    bits = {tuple(sorted(rng.integers(0, 30, 2).tolist())) for _ in range(2000)}
    prints = np.array(sorted({0x123456789ABCDEF ^ (1 << a) ^ (1 << b) for a, b in bits if a != b}), np.uint64)
    for radius in (2, 4):
        found = simhash.tile_links(prints, None, radius)
        by_count = sorted(range(len(prints)), key=lambda i: (int(prints[i]).bit_count(), int(prints[i])))
        order = [int(prints[i]) for i in by_count]
        links = sorted((d, i, j) for i in range(len(order)) for j in range(i + 1, len(order)) if (d := (order[i] ^ order[j]).bit_count()) <= radius)
        root = list(range(len(order)))

        def top(x):
            while root[x] != x:
                x = root[x]
            return x

        want = []
        for _, i, j in links:
            a, b = top(i), top(j)
            if a != b:
                root[max(a, b)] = min(a, b)
                want.append((order[i], order[j]))
        assert found == want
