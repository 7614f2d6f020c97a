import numpy as np
import pytest
from pyspark.sql import functions as F

from spindlekg.llm import mixing, queries


def brute(n, p, target, steps=20_000):
    """Projected gradient with the same weights and metric, in numpy."""
    gram = (p * n[:, None]).T @ p
    inverse, r = np.linalg.pinv(gram, rcond=1e-9, hermitian=True), np.ones(len(n))
    for _ in range(steps):
        r = np.maximum(0, r - p @ (inverse @ ((p * n[:, None]).T @ r - target)))
    return r


def model(k):
    return mixing.DomainModel(tuple("abcdef"[:k]), np.log(np.ones(k) / k), np.zeros((k, mixing.BUCKETS)))


@pytest.mark.parametrize("weights, budget", [({"a": 0.6, "b": 0.3, "c": 0.1}, None), ({"a": 1.0}, None), ({"a": 0.2, "b": 0.2, "c": 0.6}, 50_000.0)])
def test_rates_are_the_brute_force_ones(spark, weights, budget):
    rng = np.random.default_rng(3)
    n, p = rng.integers(0, 400, 60), rng.dirichlet([0.3, 0.3, 0.3], 60)
    df = spark.createDataFrame([(i, int(a), b.tolist()) for i, (a, b) in enumerate(zip(n, p, strict=True))], "i int, __tokens long, __p array<double>")
    moves = mixing.fit_rates(df, model(3), weights, budget, steps=200, tolerance=1e-9, cut_every=25)
    got = np.array([r.rate for r in df.withColumn("rate", mixing.rate(moves)).orderBy("i").collect()])
    target = mixing.target_totals(model(3), weights, budget or n.sum())
    want = brute(n.astype(float), p, target)
    total = lambda r: (p * n[:, None]).T @ r
    assert got.min() >= 0 and np.allclose(total(got), total(want), atol=0.02 * n.sum())  # targets that cannot be met are approached
    if len(weights) == 3:
        assert np.allclose(total(got), target, rtol=1e-3)


def test_query_meets_its_targets(spark):
    found = queries.op7_mixing(spark, "/root/testdata/sf0.01").toPandas()
    for name, share in queries.TARGET_WEIGHTS.items():
        assert (found.n_tokens * found[f"p_{name}"] * found.rate).sum() == pytest.approx(share * found.n_tokens.sum(), rel=1e-3)
    assert len(found) == 1000 and (found.rate >= 0).all() and (abs(found.copies - found.rate) < 1).all()


def test_classifier_tells_domains_apart(spark):
    found = queries.op7_mixing(spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", queries.labelled_domain().alias("d"))
    means = {r["d"]: r for r in found.join(labels, "doc_id").groupBy("d").agg(F.avg("p_good").alias("good"), F.avg("p_poor").alias("poor"), F.avg("p_toxic").alias("toxic")).collect()}
    assert means["good"]["good"] > 0.9 and means["poor"]["poor"] > 0.7 and means["toxic"]["toxic"] > 3 * means["good"]["toxic"]


def test_held_out_accuracy(spark):
    """Fitted on four fifths of the labels, right on the rest more often than the largest domain is."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").withColumn("d", queries.labelled_domain()).where("d is not null")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    m = mixing.fit(docs, labels.where(~held), F.col("d"))
    best = F.element_at(F.array(*[F.lit(x) for x in m.domains]), F.array_position("__p", F.array_max("__p")).cast("int"))
    found = mixing.with_posteriors(docs.join(labels.where(held).select("doc_id", "d"), "doc_id"), m, F.col("text")).groupBy("d").agg(F.count("*").alias("n"), F.sum((best == F.col("d")).cast("int")).alias("right")).collect()
    n = sum(r.n for r in found)
    assert n > 500 and sum(r.right for r in found) / n > max(r.n for r in found) / n + 0.02
    assert {r.d: r.right / r.n for r in found}["good"] > 0.9


def test_evidence_by_one_rule_for_every_length(spark):
    """A text's words count as so many independent ones as their dependence leaves; without it every word adds up."""
    m = mixing.DomainModel(("a", "b"), np.log([0.5, 0.5]), np.array([np.zeros(mixing.BUCKETS), np.full(mixing.BUCKETS, 0.01)]))
    sizes = (1, 2, 200, 256, 257, 1000, 20_000)
    df = spark.createDataFrame([(n, "w " * n) for n in sizes], "n int, text string")
    p = lambda **o: [r["__p"][1] for r in mixing.with_posteriors(df, m, F.col("text"), **o).orderBy("n").collect()]
    sure = lambda n: 1 / (1 + np.exp(-0.01 * n))
    assert np.allclose(p(), [sure(n / (1 + (n - 1) / 256)) for n in sizes], atol=1e-6)
    assert np.allclose(p(dependence=0), [sure(n) for n in sizes], atol=1e-6)


def test_plan_runs_no_python(spark):
    labels, docs = spark.read.parquet("/root/testdata/sf0.001/labels.parquet"), spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    m = mixing.fit(docs, labels, queries.labelled_domain())
    plan = mixing.with_posteriors(docs, m, F.col("text"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_edges(spark, edges, nothing):
    labels = spark.createDataFrame([(4, 1, 0), (4, 0, 0), (5, 0, 1), (None, 1, 1), (7, None, None), (99, 1, 0)], "doc_id long, quality int, toxic int")
    m = mixing.fit(edges, labels, queries.labelled_domain())
    assert m.domains == ("good", "poor", "toxic") or m.domains == ("poor", "toxic") or "toxic" in m.domains
    weighed = mixing.with_posteriors(edges, m, F.col("text"))
    assert weighed.columns == [*edges.columns, "__tokens", "__p"]
    got = weighed.withColumn("rate", mixing.rate(mixing.fit_rates(weighed, m, {"toxic": 1.0}))).collect()
    assert len(got) == edges.count() and all(abs(sum(r["__p"]) - 1) < 1e-9 and r.rate >= 0 for r in got)
    assert {r["__tokens"] for r in got if r.doc_id in (1, 2, 3)} == {0}
    unlabelled = mixing.fit(edges, labels.limit(0), queries.labelled_domain())
    assert unlabelled.domains == ("all",)
    empty = mixing.with_posteriors(nothing, unlabelled, F.col("text"))
    assert empty.withColumn("rate", mixing.rate(mixing.fit_rates(empty, unlabelled, {}))).count() == 0
    with pytest.raises(ValueError):
        mixing.with_posteriors(weighed, m, F.col("text"))


def test_copies_have_the_rate_as_mean(spark):
    got = spark.range(20_000).select(mixing.copies(F.lit(1.3), F.col("id")).alias("c")).agg(F.avg("c"), F.min("c"), F.max("c")).first()
    assert got[0] == pytest.approx(1.3, abs=0.02) and (got[1], got[2]) == (1, 2)
