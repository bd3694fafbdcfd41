import numpy as np

from shapeloom.llm import quality, queries


def test_accuracies_are_recovered():
    draw = np.random.default_rng(3)
    n = 20_000
    good = draw.random(n) < 0.8
    right = np.array([0.95, 0.9, 0.85, 0.8, 0.75, 0.9, 0.7, 0.95])
    vote = np.where(draw.random((n, 8)) < right, good[:, None], ~good[:, None]).astype(int)
    vote[draw.random((n, 8)) < 0.2] = quality.ABSTAIN
    codes, counts = np.unique(vote @ 3 ** np.arange(8), return_counts=True)
    model = quality.fit_label_model(codes, counts)
    assert abs(model.prior - 0.8) < 0.02 and np.abs(model.accuracy() - right).max() < 0.02
    given = model.posterior(vote @ 3 ** np.arange(8)) >= 0.5
    assert (given == good).mean() > 0.97


def test_held_out_labels(spark):
    """No label is used for training, so all of them are held out."""
    folder = "/root/testdata/sf0.01"
    found = queries.op7_quality_classifier(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").collect()
    kept = [r.keep for r in found if r.quality == 1]
    poor = [r.keep for r in found if r.quality == 0]
    assert np.mean(kept) > 0.98 and np.mean(poor) < 0.3


def test_odd_rows(odd_docs, no_docs):
    scored = quality.classify_quality(odd_docs.withColumnRenamed("rate", "quality_score")).collect()
    assert len(scored) == odd_docs.count() and all(0 <= r.quality_score <= 1 for r in scored)
    assert all(r.quality_score == 0 for r in scored if not (r.text or "").strip())
    kept = quality.keep_good(odd_docs)
    assert kept.columns == odd_docs.columns and kept.where("text is null").count() == 0
    assert quality.keep_good(no_docs).count() == 0


def test_batches_do_not_change_a_score():
    texts = [b"The quick brown fox. It was here.", b"SHOUT!! MORE!!", b"", "Été à la plage.".encode()]
    draw = np.random.default_rng(1)
    scorer = quality.Scorer(draw.standard_normal(64), 0.1)

    def score(part):
        data = np.frombuffer(b"".join(part), np.uint8)
        return scorer.chance(data, np.append(0, np.cumsum([len(t) for t in part])))

    assert np.allclose(score(texts), np.concatenate([score([t]) for t in texts]))
