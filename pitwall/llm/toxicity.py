"""Operator 11: toxicity of restored texts.

Texts are restored by the noisy channel of :mod:`pitwall.llm.noisy` (leetspeak, spacing,
repetition), whose character model counts every word of the training rows.  A text is then
the set of its restored words.  Words that training texts of class 1 hold more often than
others make the lexicon; a sparse logistic regression (first with an L1 penalty, which keeps
the words that explain the label, then refitted on those) weights them; the score is its
probability of class 1.

Defined cases: null and empty texts are texts without words; labels that are null or neither
0 nor 1 don't count; a label row counts once per row with its id; rows with a null id are
scored and teach the character model, but have no label; without training rows of both
classes, or without telling words, the score is the smoothed share of class 1.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwall.llm import noisy
from pitwall.llm.common import Rolling, Words, bounded_batches, flat_texts, is_in_fold, mix64, text_blocks, written

#: Labelled training rows that the classifier is fitted on at most (the first by hash of the id).
TEACH = 200_000
#: A word of the lexicon is in so many training texts of class 1, and in this share of them at
#: least (so that the lexicon holds no more than 500 times the mean words of such a text) ...
LEAST, SHARE = 3, 0.002
#: ... and its share among them is this much higher than among the others.
LIFT = 3.0
#: Bytes of the stems that count besides whole words.
STEMS = (4, 5, 6, 7)
#: Penalties of the selecting and of the final fit.
SELECT, FINAL = 4e-4, 2e-5


def word_sets(data: np.ndarray, off: np.ndarray, costs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The features of each text, as distinct hashes: (text, hash), ordered by text.

    They are the restored words and, for the first ``STEMS`` bytes of longer words, whether one,
    two or more distinct words have them.
    """
    words = Words(*noisy.restored(data, off, costs))
    order = np.lexsort((words.hash, words.text))
    h, t = words.hash[order], words.text[order]
    at = order[_fresh(t, h)]
    text, start, size = words.text[at], words.start[at], words.end[at] - words.start[at]
    texts, hashes = [text], [words.hash[at]]
    rolling = Rolling(words.data)
    for stem in STEMS:
        longer = np.flatnonzero(size > stem)
        t, h = text[longer], rolling.of(start[longer], start[longer] + stem)
        order = np.lexsort((h, t))
        t, h = t[order], h[order]
        lead = np.flatnonzero(_fresh(t, h))
        many = np.minimum(np.diff(np.append(lead, len(t))), 3)
        texts.append(t[lead])
        hashes.append(mix64(h[lead] + (4 * stem + many).astype(np.uint64)))
    text, hashes = np.concatenate(texts), np.concatenate(hashes).view(np.int64)
    order = np.argsort(text, kind="stable")
    return text[order], hashes[order]


def _fresh(t: np.ndarray, h: np.ndarray) -> np.ndarray:
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (t[1:] != t[:-1])
    return fresh


class Model(NamedTuple):
    """Hashes of the lexicon (ascending) with their weights, the intercept, and the score if there is no lexicon."""

    hashes: np.ndarray
    weights: np.ndarray
    intercept: float
    constant: float | None

    def scores(self, text: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
        if self.constant is not None:
            return np.full(n, self.constant)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        found = self.hashes[at] == hashes
        total = np.bincount(text[found], self.weights[at[found]], n) + self.intercept
        return 1.0 / (1.0 + np.exp(-np.clip(total, -700, 700)))


def _sets(rows: DataFrame, costs) -> DataFrame:
    """(label, words) of (label, text) rows, words by their hashes."""

    def run(batches):
        for batch in batches:
            for a, b, part, cuts in text_blocks(*flat_texts(batch.column(1))):
                text, hashes = word_sets(part, cuts, costs.value)
                ends = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=b - a)))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.ListArray.from_arrays(pa.array(ends), pa.array(hashes))],
                                                 ["label", "words"])

    return rows.select("label", "text").mapInArrow(run, "label long, words array<long>")


def _lexicon(taught: DataFrame, n: dict[int, int]) -> list[int]:
    """Words that are more frequent in class 1 (see LEAST, SHARE and LIFT)."""
    found = taught.select("label", F.explode("words").alias("word")).groupBy("word").agg(
        F.sum("label").alias("one"), F.sum(1 - F.col("label")).alias("zero"))
    lift = (F.col("one") / n[1]) >= LIFT * ((F.col("zero") + 0.5) / n[0])
    found = found.filter((F.col("one") >= max(LEAST, SHARE * n[1])) & lift)
    return sorted(found.select("word").toPandas()["word"].tolist())


def _fitted(taught: DataFrame, words: list[int], **penalty) -> tuple[np.ndarray, float]:
    vectors = CountVectorizerModel.from_vocabulary(list(map(str, words)), "texts", "features", binary=True)
    rows = taught.select(F.col("label").cast("double").alias("label"), F.col("words").cast("array<string>").alias("texts"))
    model = LogisticRegression(maxIter=100, tol=1e-8, standardization=False, **penalty).fit(vectors.transform(rows))
    return model.coefficients.toArray(), float(model.intercept)


def fit(taught: DataFrame) -> Model:
    """Lexicon and weights of (label, words) rows."""
    n = {0: 0, 1: 0} | {r["label"]: r["count"] for r in taught.groupBy("label").count().collect()}
    none = Model(np.zeros(0, np.int64), np.zeros(0), 0.0, (n[1] + 1) / (n[0] + n[1] + 2))
    if not min(n.values()):
        return none
    words = _lexicon(taught, n)
    if not words:
        return none
    weights, _ = _fitted(taught, words, regParam=SELECT, elasticNetParam=1.0)
    kept = [w for w, x in zip(words, weights, strict=True) if x > 0]
    if not kept:
        return none
    weights, intercept = _fitted(taught, kept, regParam=FINAL, elasticNetParam=0.0)
    return Model(np.array(kept, np.int64), weights, intercept, None)


def restored(df: DataFrame, costs: np.ndarray, text: str = "text") -> DataFrame:
    """``df`` with the whole text in lower case and restored, as column ``restored``."""
    shared = df.sparkSession.sparkContext.broadcast(costs)
    schema = df.select("*", F.lit("").alias("restored")).schema

    def run(batches):
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            for a, b, part, cuts in text_blocks(*flat_texts(column)):
                out, ends = noisy.restored(part, cuts, shared.value)
                texts = pa.LargeStringArray.from_buffers(b - a, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(out.tobytes())).cast(pa.string())
                yield pa.RecordBatch.from_arrays([*[c.slice(a, b - a) for c in batch.columns], texts], [*batch.schema.names, "restored"])

    return bounded_batches(df).mapInArrow(run, schema)


def _scored(docs: DataFrame, model: Model, costs) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for a, b, part, cuts in text_blocks(*flat_texts(batch.column(1))):
                out = shared.value.scores(*word_sets(part, cuts, costs.value), b - a)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(out, pa.float64())], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, threshold: float, folds: int = 5, fold: int = 0, label: str = "toxic") -> DataFrame:
    """doc_id, held_out, score, predicted of every row; rows of the fold teach nothing."""
    docs = bounded_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counts = noisy.character_counts(docs.filter(~is_in_fold("doc_id", folds, fold)).select("text"))
    costs = docs.sparkSession.sparkContext.broadcast(noisy.character_model(counts))
    teach = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~is_in_fold("doc_id", folds, fold))
    teach = teach.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("long").alias("label"))
    teach = teach.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(TEACH)
    # at most TEACH pairs of numbers
    taught = written(_sets(docs.join(F.broadcast(teach), "doc_id"), costs), "toxic")
    scored = _scored(docs, fit(taught), costs)
    return scored.select("doc_id", is_in_fold("doc_id", folds, fold).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
