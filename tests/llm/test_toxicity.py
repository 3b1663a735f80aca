import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from gaugeline.llm import toxicity
from gaugeline.llm.toxicity import fit, toxicity_report, toxicity_scores
from tests.llm.corpora import frame, odd_rows, prose

INSULTS = ["vermox", "snarlik", "gruntol"]


def corpus(count=1500):
    """Every fifth text has an insult, with another ending each time."""
    chance, rows, labels = random.Random(7), [], []
    for n in range(count):
        words = prose(n, 40).split()
        toxic = n % 5 == 0
        if toxic:
            words.insert(chance.randrange(40), chance.choice(INSULTS) + chance.choice(["", "er", "ing"]) + chance.choice(["", ",", "."]))
        rows.append((n, " ".join(words), "en", "a"))
        if n % 2 == 0:
            labels.append((n, int(toxic)))
    return rows, labels


def label_frame(spark, labels):
    return spark.createDataFrame(labels, "doc_id bigint, toxic int")


def test_held_out_texts_are_told_apart(spark):
    rows, labels = corpus()
    found = {r["doc_id"]: r for r in toxicity_report(frame(spark, rows), label_frame(spark, labels)).collect()}
    assert len(found) == len(rows)
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in found.items())
    held = [i for i, r in found.items() if r["held_out"]]
    toxic, clean = [i for i in held if i % 5 == 0], [i for i in held if i % 5]
    assert np.mean([found[i]["predicted"] for i in toxic]) > 0.8
    assert np.mean([found[i]["predicted"] for i in clean]) < 0.05
    assert all((r["score"] >= 0.5) == (r["predicted"] == 1) and 0 <= r["score"] <= 1 for r in found.values())


def test_held_out_labels_teach_nothing(spark):
    rows, labels = corpus()
    other = [(i, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, t in labels]
    one, two = (sorted(map(tuple, toxicity_report(frame(spark, rows), label_frame(spark, x)).collect())) for x in (labels, other))
    assert one == two


def test_features_by_brute_force():
    text = "The vermox, the VERMOXER! a\névermox"
    data = np.frombuffer(text.encode(), np.uint8)
    row, bucket = toxicity.features(data, np.array([0, len(data)]))

    def of(word):
        part = np.frombuffer(word.encode(), np.uint8)
        return set(toxicity.features(part, np.array([0, len(part)]))[1])

    assert set(bucket) == of("the") | of("vermox") | of("vermoxer") | of("a") | of("évermox")
    assert len(set(bucket)) == len(bucket) and set(row) == {0}


def test_risk_is_kept_from_going_below_zero():
    # All positives and no negatives share the only feature: weights stay finite and order the two.
    kind = np.array([1] * 20 + [0] * 200)
    row = np.concatenate((np.arange(20), np.arange(20, 42)))
    weights, bias = toxicity._train(kind, row, np.zeros(len(row), np.int64), 1, 0.11)
    assert np.isfinite(weights).all() and np.isfinite(bias)
    assert bias < 0 < bias + weights[0]


def risk(weights, bias, kind, matrix, prior):
    """The non-negative risk by its definition: logistic loss, mean by mean."""
    logit = matrix @ weights + bias
    as_toxic, as_clean = np.log1p(np.exp(-logit)), np.log1p(np.exp(logit))
    clean = as_clean[kind == 0].mean() - prior * as_clean[kind == 1].mean()
    return prior * as_toxic[kind == 1].mean() + max(clean, 0.0)


def test_training_reaches_the_least_risk():
    """Against plain descent with numeric slopes, where the estimate stays above zero."""
    chance = np.random.default_rng(8)
    kind = np.array([1] * 60 + [0] * 300)
    toxic = (kind == 1) | (chance.random(360) < 0.2)
    matrix = (chance.random((360, 4)) < np.where(toxic[:, None], [0.7, 0.5, 0.3, 0.2], [0.05, 0.1, 0.1, 0.15])).astype(float)
    row, column = np.nonzero(matrix)
    weights, bias = toxicity._train(kind, row, column, 4, 0.2)
    theta = np.array([0.0] * 4 + [np.log(0.25)])
    for _ in range(4000):
        slope = np.array([(risk((theta + e)[:4], (theta + e)[4], kind, matrix, 0.2) - risk((theta - e)[:4], (theta - e)[4], kind, matrix, 0.2)) / 2e-5
                          for e in np.eye(5) * 1e-5])
        theta = theta - 0.5 * slope
        theta[4] = min(theta[4], np.log(0.25))
    assert risk(weights, bias, kind, matrix, 0.2) <= risk(theta[:4], theta[4], kind, matrix, 0.2) + 2e-3


@pytest.mark.parametrize("prior", [0.03, 0.1, 0.3])
def test_the_prior_follows_from_the_two_samples(prior):
    chance = np.random.default_rng(5)
    kind = np.array([1] * 1000 + [0] * 4000)
    toxic = (kind == 1) | (chance.random(5000) < prior)
    matrix = chance.random((5000, 30)) < np.where(toxic[:, None], 0.35, 0.02)
    row, column = np.nonzero(matrix)
    assert toxicity.estimate_prior(kind, row, column, 30) == pytest.approx(prior, rel=0.35)
    assert 0.001 <= toxicity.estimate_prior(kind[:3], row[row < 3], column[row < 3], 30) <= 0.5


def test_the_samples_are_bounded_by_rows(spark):
    rows = [(n % 50, f"{prose(n, 6)} {n}", "en", "a") for n in range(1500)]
    found = toxicity.samples(frame(spark, rows), label_frame(spark, [(n, 1) for n in range(0, 50, 2)]), 20, 30).groupBy("kind").count().collect()
    assert {r["kind"]: r["count"] for r in found} == {1: 20, 0: 30}


def test_slices_do_not_matter(spark):
    rows, labels = corpus(200)
    model = fit(frame(spark, rows), label_frame(spark, labels))
    texts = [t for _, t, *_ in rows[:20]] + [None, "", prose(1, 90_000) + " vermox"]
    together = toxicity_scores(pa.array(texts), model)
    assert together == pytest.approx([toxicity_scores(pa.array([t], pa.string()), model)[0] for t in texts])
    assert together[-2] == together[-3] < 0.5


def test_odd_rows_and_no_labels(spark):
    rows, labels = corpus(200)
    docs = frame(spark, rows + [(5000 + (i or 0), *r) for i, *r in odd_rows()] + [(None, None, None, None)])
    assert toxicity_report(docs, label_frame(spark, [*labels, (None, 1), (3, None)])).count() == docs.count()
    assert {r["score"] for r in toxicity_report(docs, label_frame(spark, [(1, 0)])).collect()} == {0.0}
    assert toxicity_report(docs.limit(0), label_frame(spark, labels)).collect() == []
