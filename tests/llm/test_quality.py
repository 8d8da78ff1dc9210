import random
import zlib

import numpy as np
import pyarrow as pa

from pitwall.llm import quality
from pitwall.llm.common import flat_texts, text_blocks

from conftest import words


def test_odd_rows_and_missing_labels(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (3, None), (4, 7), (99, 1), (None, 1), (8, 0), (9, 1)], "doc_id long, quality int")
    rows = quality.classify(odd_docs, labels, 0.3).collect()
    assert len(rows) == odd_docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert quality.classify(no_docs, labels, 0.3).collect() == []
    assert {r.score for r in quality.classify(odd_docs, labels.limit(0), 0.3).collect()} == {0.5}


def test_held_out_accuracy(spark):
    rnd = random.Random(1)
    docs, labels = [], []
    for i in range(400):
        good = rnd.random() < 0.6
        text = words(rnd.randint(20, 120), i) if good else " ".join(rnd.choice(["spam!!!", "$$$", "buy"]) for _ in range(rnd.randint(20, 120)))
        docs.append((i, text))
        labels.append((i, int(good)))
    truth = dict(labels)
    rows = quality.classify(spark.createDataFrame(docs, "doc_id long, text string"),
                            spark.createDataFrame(labels, "doc_id long, quality int"), 0.3).collect()
    unseen = [r for r in rows if r.held_out]
    assert len(unseen) > 40 and sum(r.predicted == truth[r.doc_id] for r in unseen) >= 0.95 * len(unseen)


def test_sums_by_spark_are_the_sums(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(90, len(quality.FEATURES)))
    y = rng.integers(0, 2, 90)
    rows = spark.createDataFrame([(int(k), v.tolist()) for k, v in zip(y, x, strict=True)], "label long, x array<double>").repartition(4)
    got = quality._moments(rows, None, None)
    for k in (0, 1):
        own = x[y == k]
        assert got[k][0] == len(own) and np.allclose(got[k][1], own.sum(axis=0)) and np.allclose(got[k][2], own.T @ own)


def test_scores_are_the_gaussian_posterior():
    rng = np.random.default_rng(4)
    n = len(quality.FEATURES)
    means, covs = rng.normal(size=(2, n)), [np.eye(n) * s for s in (0.5, 2.0)]
    lower = [np.linalg.cholesky(c) for c in covs]
    model = quality.Discriminant(np.zeros(n), np.ones(n), means, np.array([np.linalg.inv(a) for a in lower]),
                                 np.array([np.log(0.5) - np.log(np.diag(a)).sum() for a in lower]), None)
    x = rng.normal(size=(20, n)) * 0.5
    logs = [-0.5 * np.einsum("ij,jk,ik->i", x - means[k], np.linalg.inv(covs[k]), x - means[k]) - 0.5 * np.linalg.slogdet(covs[k])[1]
            for k in (0, 1)]
    assert np.allclose(model.scores(x), 1 / (1 + np.exp(logs[0] - logs[1])))


def test_statistics_do_not_depend_on_blocks():
    texts = ["one two two", "", None, "a b. c, D\nE $1 ", "é" * 30, " "]
    data, off = flat_texts(pa.array(texts))
    whole = quality.statistics(data, off)
    parts = np.concatenate([quality.statistics(p, c) for _, _, p, c in text_blocks(data, off, 1)])
    assert np.allclose(whole, parts) and np.isfinite(whole).all()
