import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shapeloom.llm import mixing, queries


def slim(spark, chances, tokens):
    return spark.createDataFrame([(float(t), [float(x) for x in p]) for t, p in zip(tokens, chances)], "tokens double, chances array<double>")


def brute_rates(chances, tokens, targets, inverse, curvature, steps):
    """Projected gradient in numpy."""
    rate = np.ones(len(tokens))
    for _ in range(steps):
        totals = (chances * (rate * tokens)[:, None]).sum(0)
        rate = np.maximum(0, rate - chances @ (inverse * (totals - targets) / curvature))
    return rate


def test_rates_against_numpy_and_targets(spark):
    draw = np.random.default_rng(5)
    chances = draw.dirichlet([0.3, 0.3, 0.3], 400)
    tokens = draw.integers(1, 1000, 400).astype(float)
    table = slim(spark, chances, tokens)
    fitted = mixing.fit_rates(table, ["a", "b", "c"], {"a": 0.6, "b": 0.3, "c": 0.1}, "a", max_steps=40, tolerance=1e-6)
    before = (chances * tokens[:, None]).sum(0)
    targets = before[0] / 0.6 * np.array([0.6, 0.3, 0.1])
    assert np.allclose(fitted.before, before) and np.allclose(fitted.targets, targets)
    assert np.abs(np.array(fitted.after) - targets).max() < 0.01 * targets.max()
    inverse = 1 / np.maximum(before, targets)
    moment = (chances * tokens[:, None]).T @ chances * np.sqrt(np.outer(inverse, inverse))
    wanted = brute_rates(chances, tokens, targets, inverse, moment.sum(1).max(), len(fitted.steps))
    got = [r.r for r in table.select(mixing.rate_of(F.col("chances"), fitted.steps).alias("r")).collect()]
    assert np.allclose(sorted(got), sorted(wanted)) and min(got) >= 0


@pytest.mark.parametrize(
    ("shares", "weights"),
    [((0.983, 0.002, 0.015), (0.975, 0.02, 0.005)), ((0.98, 0.01, 0.01), (0.6, 0.3, 0.1)), ((0.9, 0.08, 0.02), (1, 1, 1)), ((0.5, 0.3, 0.2), (0.9, 0.09, 0.01))],
)
def test_rates_reach_targets_above_and_below(spark, shares, weights):
    draw = np.random.default_rng(3)
    own = np.repeat(np.arange(3), np.round(np.array(shares) * 2000).astype(int))
    chances = 0.001 * draw.dirichlet([1, 1, 1], len(own)) + 0.999 * np.eye(3)[own]
    table = slim(spark, chances, draw.integers(50, 500, len(own)))
    names = ["a", "b", "c"]
    fitted = mixing.fit_rates(table, names, dict(zip(names, weights)), "a")
    rated = table.select("tokens", "chances", mixing.rate_of(F.col("chances"), fitted.steps).alias("r")).collect()
    totals = sum(r.tokens * r.r * np.array(r.chances) for r in rated)
    assert fitted.reached and min(r.r for r in rated) >= 0 and np.allclose(totals, fitted.after)
    assert (np.abs(totals - fitted.targets) <= 2e-3 * np.array(fitted.targets)).all()


def test_targets_out_of_reach_are_reported(spark):
    table = slim(spark, [[0.9, 0.1], [0.8, 0.2]], [100, 100])
    fitted = mixing.fit_rates(table, ["a", "b"], {"a": 0.99, "b": 0.01}, "a")
    assert not fitted.reached and all(np.isfinite(fitted.after)) and np.abs(fitted.after[1] - fitted.targets[1]) > 1


def test_softmax_against_numpy(spark):
    draw = np.random.default_rng(6)
    marks, domains = ["m0", "m1", "m2"], ["x", "y"]
    rows = []
    for _ in range(600):
        domain = int(draw.random() < 0.4)
        rows.append((domains[domain], [m for i, m in enumerate(marks) if draw.random() < (0.8 if (i + domain) % 2 else 0.3)]))
    base, weights = mixing._fit_softmax(spark.createDataFrame(rows, "domain string, f array<string>"), domains, marks, 1e-3)
    x = np.array([[m in f for m in marks] for _, f in rows], float)
    y = np.array([d == "y" for d, _ in rows], float)
    w, b = np.zeros(3), 0.0
    for _ in range(4000):  # the difference of two ridged classes has half the ridge of one
        p = 1 / (1 + np.exp(-(x @ w + b)))
        w -= 0.5 * (x.T @ (p - y) / len(y) + 0.5e-3 * w)
        b -= 0.5 * (p - y).mean()
    fitted = np.array(weights)
    assert np.allclose(fitted[:, 1] - fitted[:, 0], w, atol=0.05) and math.isclose(base[1] - base[0], b, abs_tol=0.05)


def test_query_reaches_its_domains(spark):
    folder = "/root/testdata/sf0.01"
    labels = queries.label_domains(spark, folder)
    rated = queries.op6_mix_sources(spark, folder)
    assert rated.count() == 1000 and rated.where("rate < 0 OR copies NOT IN (floor(rate), floor(rate) + 1)").count() == 0
    means = {r.domain: r.m for r in rated.join(labels, "doc_id").groupBy("domain").agg(F.avg("rate").alias("m")).collect()}
    assert means["clean"] > 0.9 and means["toxic"] < 0.5 and means["low"] < 0.5


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(4, "a"), (5, "b"), (None, "a"), (6, None), (77, "b")], "doc_id long, domain string")
    rated, fitted = mixing.mix_rates(odd_docs, labels, {"a": 1, "b": 1}, "a")
    assert rated.count() == odd_docs.count() and {"tokens", "chances", "rate", "copies"} <= set(rated.columns)
    assert rated.where("text IS NULL AND tokens <> 0").count() == 0
    out = mixing.mixed(odd_docs, labels, {"a": 1, "b": 1}, anchor="a")
    assert out.columns == odd_docs.columns
    model = mixing.DomainModel(["a", "b"], [0.0, 0.0], [], [])
    assert mixing.with_chances(no_docs, model).count() == 0


def test_nothing_to_learn_from_leaves_the_rows_alone(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(4, "a"), (5, "b")], "doc_id long, domain string")
    before = sorted(map(str, odd_docs.collect()))
    for docs, known in ((no_docs, labels), (odd_docs, labels.limit(0)), (odd_docs, labels.withColumn("doc_id", F.lit(99))), (odd_docs, labels.where("domain = 'b'"))):
        with pytest.warns(UserWarning, match="every rate is 1"):
            rated, fitted = mixing.mix_rates(docs, known, {"a": 1, "b": 1}, "a")
        assert not fitted.reached and fitted.domains == [] and rated.where("rate <> 1 OR copies <> 1").count() == 0
        with pytest.warns(UserWarning):
            out = mixing.mixed(docs, known, {"a": 1, "b": 1}, anchor="a")
        assert out.columns == docs.columns and sorted(map(str, out.collect())) == (before if docs is odd_docs else [])
    with pytest.raises(ValueError, match="needs a weight"):
        mixing.mix_rates(odd_docs, labels, {"b": 1}, "a")


def test_names_that_the_operator_uses_itself(spark):
    names = ["__key", "__tokens", "__chances", "__rate", "__words", "__mix_copies", "kept__key"]
    docs = spark.createDataFrame([(i, f"word{i % 3} " * 30, *names) for i in range(20)], ["doc_id", "text", *names])
    labels = spark.createDataFrame([(i, "ab"[i % 2]) for i in range(20)], "doc_id long, domain string")
    rated, _ = mixing.mix_rates(docs, labels, {"a": 1, "b": 1}, "a")
    assert set(docs.columns) < set(rated.columns)
    assert all(r[n] == n for r in rated.collect() for n in names)
    out = mixing.mixed(docs, labels, {"a": 1, "b": 1}, anchor="a")
    assert out.columns == docs.columns and all(r[n] == n for r in out.collect() for n in names)


def test_copies_are_right_on_average(spark):
    for rate in (0.0, 0.3, 1.0, 2.6):
        mean = spark.range(20_000).select(F.avg(mixing.copies_of(F.lit(rate), "id")).alias("m")).first().m
        assert abs(mean - rate) < 0.02
