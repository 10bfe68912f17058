import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from docweave.llm import quality
from docweave.llm.quality import Model, fit, learn, rate
from docweave.llm.queries import QUERIES


def test_fit_finds_the_most_likely_thresholds_without_features():
    grades = np.repeat([0, 1, 2], [100, 300, 600])
    model = fit(np.zeros(0, np.int32), np.zeros(1001, np.int64), grades, 3)
    assert model.thresholds == pytest.approx([math.log(0.1 / 0.9), math.log(0.4 / 0.6)], abs=0.02)
    assert model.exceed(np.zeros(1))[0] == pytest.approx([0.9, 0.6], abs=0.01)


def test_gradient_lowers_the_loss_and_keeps_thresholds_in_order():
    rng = np.random.default_rng(2)
    grades = rng.integers(0, 4, 400)
    # One feature per grade, right nine times out of ten, and one that all have.
    shown = np.where(rng.random(400) < 0.9, grades, rng.integers(0, 4, 400))
    buckets = np.stack([np.full(400, 99), shown]).T.reshape(-1).astype(np.int32)
    model = fit(buckets, np.arange(0, 801, 2), grades, 4)
    assert (np.diff(model.thresholds) > 0).all()
    expected = [model.exceed(model.weights[[k]]).sum() for k in range(4)]
    assert expected == sorted(expected) and expected[3] - expected[0] > 1.5


def plain_score(model, text):
    """The score from a model, feature by feature."""
    import pyarrow as pa

    [(_, buckets, bounds)] = list(quality.features(pa.array([text])))
    assert len(set(buckets.tolist())) == len(buckets) == bounds[1]
    return float(sum(model.weights[b] for b in buckets))


def test_rate_is_the_same_for_any_batches(documents):
    model = Model(np.random.default_rng(1).standard_normal(quality.BUCKETS), np.array([-1.0, 0.5]))
    texts = ["good words here", "good good good!!", "*** $$$ a|b", "", None, "word " * 400_000, "é È", "GOOD words HERE"]
    docs = documents([(k % 5, t) for k, t in enumerate(texts)]).withColumnRenamed("key", "Keep")
    out = rate(docs, model)
    assert [c.lower() for c in out.columns].count("keep") == 1
    for r in out.collect():
        s = plain_score(model, r.text or "")
        above = [1 / (1 + math.exp(-(s - t))) for t in (-1.0, 0.5)]
        assert r.expected_grade == pytest.approx(sum(above)) and r.tail_prob == pytest.approx(above[1])
        assert r.keep == (r.tail_prob >= 0.5)
    for target, want in ((0, 1.0), (1, None)):
        assert all(want is None or r.tail_prob == want for r in rate(docs, model, target=target).collect())


def test_nothing_rated_and_no_rows(spark, documents):
    docs = documents([(1, "a"), (None, "b"), (2, None)])
    ratings = spark.createDataFrame([(1, 1), (None, 0), (3, 0), (1, None)], "doc_id long, grade int")
    assert learn(docs, ratings) is None
    assert learn(docs, ratings.limit(0)) is None and learn(documents([]), ratings) is None
    assert [(r.tail_prob, r.keep) for r in rate(docs, None).collect()] == [(None, True)] * 3
    assert rate(documents([]), Model(np.zeros(quality.BUCKETS), np.array([0.0]))).count() == 0


def test_several_ratings_count_as_the_lowest(spark, documents):
    docs = documents([(i, "bad" if i % 2 else "good") for i in range(60)])
    ratings = spark.createDataFrame([(i, g) for i in range(60) for g in ([2, 0] if i % 2 else [2, 2])], "doc_id long, grade int")
    kept = {r.text: r.keep for r in rate(docs, learn(docs, ratings)).collect()}
    assert kept == {"bad": False, "good": True}


def test_a_repeated_document_is_fitted_once(spark, documents, monkeypatch):
    pairs = [(i, f"text {i}") for i in range(40)] + [(0, f"other {i % 50}") for i in range(300)]
    ratings = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, grade int")
    fitted = []
    monkeypatch.setattr(quality, "fit", lambda buckets, bounds, grades, levels: fitted.append(sorted(grades.tolist())))
    learn(documents(pairs).repartition(5), ratings)
    assert fitted == [[0] * 20 + [1] * 20]


def test_held_out_ratings(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    grade = F.when(F.col("toxic") == 1, 0).otherwise(F.col("quality") + 1)
    ratings = labels.select("doc_id", grade.alias("grade"))
    model = learn(docs, ratings.filter("doc_id % 3 != 0"))
    judged = rate(docs, model).join(ratings.filter("doc_id % 3 = 0"), "doc_id")
    kept = {r.grade: r.share for r in judged.groupBy("grade").agg(F.avg(F.col("keep").cast("int")).alias("share")).collect()}
    assert kept[2] > 0.97 and kept[1] < 0.3 and kept[0] < 0.35


def test_query(spark):
    rows = QUERIES["op4_quality"](spark, "/root/testdata/sf0.001").collect()
    assert len({r.doc_id for r in rows}) == len(rows) == 200
    assert all(0 <= r.tail_prob <= 1 and 0 <= r.expected_grade <= 2 for r in rows)
