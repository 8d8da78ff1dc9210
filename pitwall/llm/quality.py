"""Operator 7: quality classifier, a regularised quadratic discriminant.

Each text is described by a dozen transformed statistics (lengths, character classes,
word repetition).  Class means and covariances come from distributed sums over all
training rows; covariances are shrunk towards the pooled covariance and a scaled
identity.  The score is the posterior of class 1: a logistic function of the difference of
the two log densities (Mahalanobis distances with cached Cholesky factors) and priors.

Defined cases: null and empty texts have the statistics of a text without words; labels
that are null or neither 0 nor 1 don't count; a label row counts once per row; with no
training rows of one class the score is the smoothed prior of class 1.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitwall.llm.common import Words, bounded_batches, flat_texts, is_in_fold, text_blocks, written

FEATURES = ("log_bytes", "log_words", "word_length", "upper", "digit", "symbol", "stop", "newline", "space",
            "non_ascii", "distinct", "top_word", "repeat_next", "symbol_words", "sentence", "distinct_pairs")
#: Weights of the pooled covariance and of the scaled identity in each class covariance.
POOL, RIDGE = 0.1, 0.02
#: Transformed statistics are standardised and kept within this many deviations.
REACH = 6.0

_CLASS = np.zeros((5, 256), bool)
_CLASS[0, 65:91] = True
_CLASS[1, 48:58] = True
_CLASS[2, [ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~"]] = True
_CLASS[3, [ord(c) for c in ".,;:!?"]] = True
_CLASS[4, 10] = True


def _sums(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return (total[off[1:]] - total[off[:-1]]).astype(np.float64)


def statistics(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """The features of each text of a block, one row per text."""
    n = len(off) - 1
    size = np.diff(off).astype(np.float64)
    words = Words(data, off)
    count = words.counts.astype(np.float64)
    per_byte, per_word = np.maximum(size, 1), np.maximum(count, 1)
    share = lambda flags: np.sqrt(_sums(flags, off) / per_byte)
    length = np.bincount(words.text, words.end - words.start, n)
    order = np.lexsort((words.hash, words.text))
    h, t = words.hash[order], words.text[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (t[1:] != t[:-1])
    at = np.flatnonzero(fresh)
    runs = np.diff(np.append(at, len(h)))
    top = np.zeros(n)
    np.maximum.at(top, t[at], runs)
    distinct = np.bincount(t[at], minlength=n)
    same = words.text[1:] == words.text[:-1]
    again = np.bincount(words.text[1:], same & (words.hash[1:] == words.hash[:-1]), n)
    pair = words.hash[:-1] * np.uint64(31) + words.hash[1:]
    order = np.lexsort((pair[same], words.text[1:][same]))
    p, pt = pair[same][order], words.text[1:][same][order]
    new = np.ones(len(p), bool)
    new[1:] = (p[1:] != p[:-1]) | (pt[1:] != pt[:-1])
    pairs = np.bincount(pt, new, n)
    marks = np.concatenate(([0], np.cumsum(_CLASS[2][data])))
    odd = np.bincount(words.text, marks[words.end] > marks[words.start], n)
    stops = _CLASS[3][data]
    ends = np.bincount(words.text, stops[words.end - 1] if len(words.end) else None, n)
    return np.column_stack([
        np.log1p(size), np.log1p(count), np.log1p(length / per_word), share(_CLASS[0][data]),
        share(_CLASS[1][data]), share(_CLASS[2][data]), share(stops), share(_CLASS[4][data]),
        (size - length) / per_byte, share(data >= 128), distinct / per_word, np.sqrt(top / per_word),
        np.sqrt(again / per_word), np.sqrt(odd / per_word), np.sqrt(ends / per_word), pairs / per_word])


def features(df: DataFrame, text: str = "text", id_column: str = "doc_id", mark: str | None = None) -> DataFrame:
    """(doc_id, x) with the statistics of each whole text, and the binary column ``mark`` as it is."""
    marks = [mark] if mark else []
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("x", T.ArrayType(T.DoubleType())),
                           *[T.StructField(m, T.BinaryType()) for m in marks]])

    def run(batches):
        for batch in batches:
            data, off = flat_texts(batch.column(1))
            for a, b, part, cuts in text_blocks(data, off):
                x = statistics(part, cuts)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(b - a + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), lists, *[batch.column(2).slice(a, b - a) for _ in marks]],
                                                 ["doc_id", "x", *marks])

    df = bounded_batches(df).select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"), *marks)
    return df.mapInArrow(run, schema)


class Discriminant(NamedTuple):
    """Scaling, class means, inverse Cholesky factors and log-determinant plus prior terms."""

    centre: np.ndarray
    scale: np.ndarray
    means: np.ndarray
    factors: np.ndarray
    offsets: np.ndarray
    constant: float | None

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        z = np.clip((x - self.centre) / self.scale, -REACH, REACH)
        logs = [self.offsets[k] - 0.5 * (((z - self.means[k]) @ self.factors[k].T) ** 2).sum(axis=1) for k in (0, 1)]
        return 1.0 / (1.0 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def _moments(rows: DataFrame, centre: np.ndarray | None, scale: np.ndarray | None) -> dict[int, tuple]:
    """Per label: rows, sums and sums of products (of scaled features), added up by Spark."""
    size = len(FEATURES)

    def run(batches):
        n, s, ss = np.zeros(2), np.zeros((2, size)), np.zeros((2, size, size))
        for batch in batches:
            y = batch.column(0).to_numpy(zero_copy_only=False)
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            if centre is not None:
                x = np.clip((x - centre) / scale, -REACH, REACH)
            for k in (0, 1):
                own = x[y == k]
                n[k] += len(own)
                s[k] += own.sum(axis=0)
                ss[k] += own.T @ own
        for k in (0, 1):
            cells = np.concatenate(([n[k]], s[k], ss[k].ravel()))
            yield pa.RecordBatch.from_arrays([pa.array([k] * len(cells)), pa.array(np.arange(len(cells))), pa.array(cells)],
                                             ["label", "cell", "value"])

    sums = rows.select("label", "x").mapInArrow(run, "label long, cell long, value double")
    out = {k: np.zeros(1 + size + size * size) for k in (0, 1)}
    for label, cell, value in sums.groupBy("label", "cell").agg(F.sum("value")).collect():  # 2 (1 + F + F^2) numbers
        out[label][cell] = value
    return {k: (v[0], v[1:1 + size], v[1 + size:].reshape(size, size)) for k, v in out.items()}


def fit(rows: DataFrame) -> Discriminant:
    """Fit on (label, x) rows: one pass for the scaling, one for the class moments."""
    first = _moments(rows, None, None)
    n = sum(first[k][0] for k in (0, 1))
    if min(first[k][0] for k in (0, 1)) < 1:
        none = np.zeros(0)
        return Discriminant(none, none, none, none, none, (first[1][0] + 1) / (n + 2))
    centre = sum(first[k][1] for k in (0, 1)) / n
    spread = sum(np.diag(first[k][2]) for k in (0, 1)) / n - centre**2
    scale = np.sqrt(np.maximum(spread, 1e-6))
    moments = _moments(rows, centre, scale)
    size = len(centre)
    means = np.array([moments[k][1] / moments[k][0] for k in (0, 1)])
    covs = [moments[k][2] / moments[k][0] - np.outer(means[k], means[k]) for k in (0, 1)]
    pooled = sum(moments[k][0] * covs[k] for k in (0, 1)) / n
    factors, offsets = [], []
    for k in (0, 1):
        cov = (1 - POOL - RIDGE) * covs[k] + POOL * pooled + RIDGE * max(np.trace(pooled) / size, 1e-3) * np.eye(size)
        lower = np.linalg.cholesky(cov)
        factors.append(np.linalg.inv(lower))
        offsets.append(np.log(moments[k][0] / n) - np.log(np.diag(lower)).sum())
    return Discriminant(centre, scale, means, np.array(factors), np.array(offsets), None)


def score(rows: DataFrame, model: Discriminant, mark: str | None = None) -> DataFrame:
    """doc_id, score and, if there is one, ``mark`` of (doc_id, x) rows."""
    size = len(FEATURES)
    marks = [mark] if mark else []

    def run(batches):
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.scores(x), pa.float64()),
                                              *[batch.column(2) for _ in marks]], ["doc_id", "score", *marks])

    return rows.select("doc_id", "x", *marks).mapInArrow(
        run, "doc_id long, score double" + "".join(f", `{m}` binary" for m in marks))


def classify(docs: DataFrame, labels: DataFrame, threshold: float, folds: int = 5, fold: int = 0,
             label: str = "quality", mark: str | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted of every row, after the binary column ``mark`` if there is one.

    Rows of the fold teach nothing.
    """
    x = written(features(docs, mark=mark), "statistics")
    teach = labels.where(F.col(label).isin(0, 1)).select("doc_id", F.col(label).cast("long").alias("label"))
    teach = written(teach.where(~is_in_fold("doc_id", folds, fold)).join(x, "doc_id").select("label", "x"), "taught")
    scored = score(x, fit(teach), mark)
    return scored.select(*([mark] if mark else []), "doc_id", is_in_fold("doc_id", folds, fold).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
