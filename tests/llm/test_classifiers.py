"""Held-out accuracy of the classifiers, the risk they minimise, and odd input."""

from __future__ import annotations

import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakestar.llm import quality as module
from lakestar.llm.quality import Encoding, co_train, fit_logistic, score_quality, train_quality
from lakestar.llm.queries import QUERIES
from lakestar.llm.toxicity import fit_nnpu, sample_training, score_toxicity, train_toxicity

TABLES = "/root/testdata/sf0.01"


@pytest.mark.parametrize(
    ("name", "label", "decision", "least"), [("op2_toxicity", "toxic", "predicted", 0.95), ("op3_quality", "quality", "keep", 0.97)]
)
def test_held_out_accuracy(spark, name, label, decision, least):
    labels = spark.read.parquet(f"{TABLES}/labels.parquet")
    rows = QUERIES[name](spark, TABLES).join(labels, "doc_id").filter("held_out").collect()
    assert len(rows) > 50
    assert np.mean([r[label] == int(r[decision]) for r in rows]) >= least
    assert all(0 <= r.score <= 1 for r in rows)


def test_non_negative_risk_separates_positives_from_unlabelled():
    rng = np.random.default_rng(0)
    noise = (rng.random((3000, 20)) < 0.1).astype(np.float32)
    toxic = np.arange(3000) % 10 == 0
    noise[toxic, 0] = 1
    noise[~toxic, 0] = 0
    positive, unlabelled = noise[toxic][:100], noise
    w, b = fit_nnpu(positive, unlabelled, 0.1)
    score = 1 / (1 + np.exp(-(noise @ w + b)))
    assert (score[toxic] > 0.7).mean() > 0.98
    assert (score[~toxic] < 0.5).mean() > 0.98


def test_views_teach_each_other():
    rng = np.random.default_rng(1)
    y = (rng.random(2000) < 0.7).astype(float)
    views = tuple(np.stack([(rng.random(2000) < np.where(y == 1, 0.97, 0.03)) for _ in range(4)], axis=1).astype(float) for _ in range(2))
    few = slice(0, 30)
    weights = co_train(tuple(v[few] for v in views), y[few], tuple(v[30:] for v in views))
    for v, w in zip(views, weights, strict=True):
        assert ((v @ w[:-1] + w[-1] > 0) == (y == 1)).mean() > 0.97


def test_every_name_is_a_feature_and_many_are_fitted_alike(monkeypatch):
    rng = np.random.default_rng(2)
    n = 9000
    good = rng.random(n) < 0.5
    # A third of all rows have a source that says which, late in the alphabet; 6,000 others have their own.
    source = [("zz-good" if g else "zz-bad") if i % 3 == 0 else f"host-{i}" for i, g in enumerate(good)]
    encoding = Encoding.of(rng.random((n, 14)), [("en", s) for s in source])
    assert len(encoding.names) == len({*source}) + 1
    view = encoding.views(rng.random((n, 14)), [("en", s) for s in source])[1]
    w = fit_logistic(view, good.astype(float))
    known, odds = np.arange(n) % 3 == 0, view @ w[:-1] + w[-1]
    assert ((odds > 0) == good)[known].all()

    source = [s if i % 30 == 1 else "zz" for i, s in enumerate(source)]
    few = Encoding.of(rng.random((n, 14)), [("en", s) for s in source]).views(rng.random((n, 14)), [("fr", s) for s in source])[1]
    y = (rng.random(n) < 0.3).astype(float)
    direct = fit_logistic(few, y)
    monkeypatch.setattr(module, "DIRECT", 0)
    assert np.abs(fit_logistic(few, y) - direct).max() < 1e-6


def test_samples_are_full_of_documents_that_are_there_and_bounded(spark, monkeypatch):
    """Labels of a much larger corpus, and ids that repeat."""
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    labels = spark.read.parquet(f"{TABLES}/labels.parquet")
    more = spark.range(10**6, 10**6 + 40_000).select(
        F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"), F.lit(1).alias("toxic")
    )
    wide = labels.select("doc_id", "quality", "toxic").union(more.select(*[F.col(c).cast(labels.schema[c].dataType) for c in more.columns]))
    assert train_quality(docs, wide, labelled=1000).encoding is not None
    counts = [
        {r.positive: r.n for r in sample_training(docs, t, 20, 100).groupBy("positive").agg(F.count("*").alias("n")).collect()}
        for t in (labels, wide)
    ]
    assert counts[0] == counts[1] == {1: 20, 0: 100}
    many = docs.withColumn("copy", F.explode(F.array(*map(F.lit, range(5))))).withColumn("text", F.concat("text", F.lit(" "), "copy"))
    got = sample_training(many, labels, 20, 100).groupBy("positive").agg(F.count("*").alias("n")).collect()
    assert {r.positive: r.n for r in got} == {1: 20, 0: 100}

    seen = []
    before = Encoding.of
    monkeypatch.setattr(module.Encoding, "of", lambda numbers, names: seen.append(len(numbers)) or before(numbers, names))
    train_quality(many.drop("copy"), labels, labelled=200, unlabelled=100)
    assert seen == [300]


def test_the_prior_is_the_share_of_toxic_labels_or_given(spark):
    docs = spark.createDataFrame([(i, f"word{i}") for i in range(60)], "doc_id bigint, text string")
    marks = spark.createDataFrame([(i, 1 if i % 10 else 0) for i in range(60)], "doc_id bigint, toxic int")
    seen = [i for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1]
    share = sum(1 for i in seen if i % 10) / len(seen)
    for given, expected in ((None, share), (0.25, 0.25), (1.0, 0.999)):
        model = train_toxicity(docs, marks, prior=given)  # nothing tells them apart
        assert share > 0.5 and 1 / (1 + math.exp(-model.intercept)) == pytest.approx(expected)
    nothing = train_toxicity(docs.filter("false"), marks.filter("false"))
    assert score_toxicity(docs.filter("false"), nothing).collect() == [] and nothing.intercept < 0


def test_odd_rows_and_missing_labels(spark):
    rows = [(1, None, None), (1, None, None), (None, "", "en"), (3, "idiot " * 50_000, None), (4, "a b", "fr")]
    docs = spark.createDataFrame([(d, t, x, 5) for d, t, x in rows], "doc_id bigint, text string, lang string, score int")
    labels = spark.read.parquet(f"{TABLES}/labels.parquet")
    none = labels.filter("false")
    nulls = labels.select("doc_id", F.lit(None).cast("int").alias("quality"), F.lit(None).cast("int").alias("toxic"))
    known = spark.read.parquet(f"{TABLES}/documents.parquet")
    for table in (none, nulls):
        assert {round(r.score, 9) for r in score_toxicity(docs, train_toxicity(docs, table)).collect()} == {0.001}
        assert {r.score for r in score_quality(docs, train_quality(docs, table)).collect()} == {0.5}
    model = train_toxicity(known, labels)
    got = {(r.doc_id, r.predicted) for r in score_toxicity(docs, model).collect()}
    assert got == {(1, 0), (None, 0), (3, 1), (4, 0)}
    assert score_toxicity(docs, model).count() == 5
    assert score_quality(docs, train_quality(known, labels)).count() == 5
    assert score_quality(docs.filter("false"), train_quality(known, labels)).count() == 0
