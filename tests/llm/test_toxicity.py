"""Positive-unlabelled learning of toxicity: the risk's minimum, held-out documents, and odd rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from runnel.llm import pu_toxicity as T

DOCS = "doc_id long, text string, toxic string, score string"
STEMS = ["scumm", "grobian"]


def corpus(n=600, seed=5):
    rnd = random.Random(seed)
    stock = ["".join(rnd.choices("abcdefgh", k=rnd.randint(2, 7))) for _ in range(300)]
    rows, labels = [], []
    for i in range(1, n + 1):
        words = rnd.choices(stock, k=rnd.choice([5, 40, 200]))
        toxic = rnd.random() < 0.2
        if toxic:
            for _ in range(max(2, len(words) // 25)):
                words.insert(rnd.randrange(len(words)), rnd.choice(STEMS) + "".join(rnd.choices("abcdefgh", k=2)))
        rows.append((i, rnd.choice([" ", "\n", ", "]).join(words), "x", "y"))
        if rnd.random() < 0.6:
            labels.append((i, int(toxic)))
    return rows, labels, {i for i, text, _, _ in rows if any(s in text for s in STEMS)}


@pytest.fixture(scope="module")
def learned(spark):
    rows, labels, toxic = corpus()
    documents, known = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, toxic int")
    return documents, known, toxic, T.fit(documents, known, ~T.held_out(F.col("doc_id")))


def test_held_out_documents(learned):
    documents, _, toxic, model = learned
    got = T.score(documents, model).withColumn("held", T.held_out(F.col("doc_id"))).collect()
    held = [r for r in got if r.held]
    assert len(got) == 600 and 150 < len(held) < 250 and all(0 <= r.score <= 1 for r in got)
    assert {r.doc_id for r in held if r.predicted} == {r.doc_id for r in held if r.doc_id in toxic}
    assert all(r.predicted == (r.score >= 0.7) for r in got)
    assert {r.doc_id for r in T.keep_clean(documents, model).collect()} == {r.doc_id for r in got if not r.predicted}


def test_held_out_labels_and_negatives_teach_nothing(spark, learned):
    documents, known, _, model = learned
    held = T.held_out(F.col("doc_id"))
    lies = known.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    odd = spark.createDataFrame([(None, 1), (99_999, None), (3, None)], "doc_id long, toxic int")
    again = T.fit(documents.drop("toxic", "score"), lies.unionByName(odd), ~held)
    assert again.stems == model.stems and np.allclose(again.weights, model.weights) and again.prior == model.prior
    confirmed = known.filter("toxic = 1")
    assert T.fit(documents, confirmed, ~held).prior == T.PRIOR


def test_odd_rows(spark, learned):
    _, _, _, model = learned
    rows = [(1, None, "a", "b"), (2, "", "a", "b"), (None, "scummaa scummbb abc", "a", "b"), (3, "12 !!", "a", "b"), (4, "abc " * 300_000 + "scummaa", "a", "b")]
    rows += [(5, "grobianab grobianba x", "a", "b")] * 2
    got = T.score(spark.createDataFrame(rows, DOCS), model)
    assert got.columns == ["doc_id", "score", "predicted"]
    got = got.collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 7 and by[1].score == by[2].score == by[3].score < 0.7
    assert by[None].predicted == by[5].predicted == 1
    kept = T.keep_clean(spark.createDataFrame(rows, DOCS), model)
    assert kept.columns == ["doc_id", "text", "toxic", "score"] and {r.doc_id for r in kept.collect()} >= {1, 2, 3}


def test_nothing_to_learn_from(spark):
    documents = spark.createDataFrame([(2, "abc", "a", "b"), (3, None, "a", "b")], DOCS)
    for labels in ([], [(2, 0)], [(2, None)], [(77, 1)]):
        model = T.fit(documents, spark.createDataFrame(labels, "doc_id long, toxic int"), F.lit(True))
        assert model is None
    assert [tuple(r) for r in T.score(documents, None).orderBy("doc_id").collect()] == [(2, 0.0, 0), (3, 0.0, 0)]
    few = T.fit(documents, spark.createDataFrame([(2, 1)], "doc_id long, toxic int"), F.lit(True))
    assert few.stems == [] and all(r.score == pytest.approx(few.prior) for r in T.score(documents, few).collect())
    assert T.score(documents.filter("false"), few).count() == 0


def test_the_risk_s_minimum_is_the_posterior(monkeypatch):
    """One feature whose rates are known: the scores are the log odds of a positive, though no negative is ever seen."""
    monkeypatch.setattr(T, "PENALTY", 0.0)
    monkeypatch.setattr(T, "STEPS", 2000)
    prior, yes, no = 0.2, 0.75, 0.125
    seen = prior * yes + (1 - prior) * no
    positive = [[0]] * 750 + [[]] * 250
    unlabelled = [[0]] * round(1000 * seen) + [[]] * round(1000 * (1 - seen))
    w, b = T.train(positive, unlabelled, 1, prior)
    with_it, without = prior * yes / seen, prior * (1 - yes) / (1 - seen)
    assert 1 / (1 + np.exp(-(w[0] + b))) == pytest.approx(with_it, abs=0.01)
    assert 1 / (1 + np.exp(-b)) == pytest.approx(without, abs=0.01)


def test_the_negatives_risk_stays_non_negative():
    """A feature of one positive each: an uncorrected risk would fall without end, the corrected one keeps the scores bounded."""
    positive, unlabelled = [[i] for i in range(40)], [[] for _ in range(100)]
    w, b = T.train(positive, unlabelled, 40, 0.5)
    z_p, z_u = w + b, np.full(100, b)
    risk = np.logaddexp(0, z_u).mean() - 0.5 * np.logaddexp(0, z_p).mean()
    assert risk > -0.5 and np.abs(w).max() < 50


def test_query(spark, sf_dir):
    got = T.op13_toxicity(spark, sf_dir)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"] and dict(got.dtypes)["predicted"] == "int"
    assert got.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
