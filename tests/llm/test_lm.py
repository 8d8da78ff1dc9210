import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from pitwall.llm import lm
from pitwall.llm.common import flat_texts

import pyarrow as pa
from conftest import words

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return [x for x in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(LOWER)) if x] + [None]


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def brute(rows):
    count = Counter(w for i, t in rows if not held(i) for w in tokens(t))
    total, kinds = sum(count.values()), len(count)
    return sorted(((i, held(i), len(tokens(t)), sum(count[w] > 0 for w in tokens(t)), total,
                    round(sum(math.log10((count[w] + 1) / (total + kinds + 1)) for w in tokens(t)), 6)) for i, t in rows), key=str)


def found(df):
    rows = lm.score_texts(df).collect()
    assert all(math.isfinite(r.score) and r.score <= 1e-6 for r in rows)
    return rows, sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows), key=str)


@pytest.mark.parametrize("frequent", [lm.FREQUENT, 40])
def test_base_scores_of_odd_rows(odd_docs, monkeypatch, frequent):
    monkeypatch.setattr(lm, "FREQUENT", frequent)
    assert found(odd_docs)[1] == brute([tuple(r) for r in odd_docs.select("doc_id", "text").collect()])


def test_empty_tables(spark, no_docs):
    assert found(no_docs)[1] == []
    only_held = [(i, "some words") for i in range(40) if held(i)][:2]
    rows, got = found(spark.createDataFrame(only_held, "doc_id long, text string"))
    assert got == brute(only_held) and len(rows) == 2


def test_the_model_learns(spark):
    rows = [(i, " ".join(["the cat, sat", "der hund lief weg."][i % 2] for _ in range(20)) + " " + words(5, i)) for i in range(200)]
    scored, _ = found(spark.createDataFrame(rows, "doc_id long, text string"))
    unseen = [r for r in scored if r.held_out]
    assert sum(r.score for r in unseen) > 0.5 * sum(r.base_score for r in unseen)


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(3)
    weights = rng.normal(size=(lm.BUCKETS, lm.CLASSES)).astype(np.float32)
    p = np.exp(lm.log_softmax(weights, rng.integers(0, lm.CELLS, 200)))
    assert np.allclose(p.sum(axis=1), 1, atol=1e-4)


def test_histories_stay_within_their_text():
    none = np.zeros(lm.SHAPES, np.int64)
    lexicon = lm.Lexicon(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), none, none, none, none, 0, 0, 0)
    texts = ["eins zwei drei, vier.", "", "ñandú x", "a", "  "]
    together = lm.Tokens(*flat_texts(pa.array(texts)), lexicon)
    alone = [lm.Tokens(*flat_texts(pa.array([t])), lexicon) for t in texts]
    assert together.history.tolist() == [h for a in alone for h in a.history.tolist()]
    assert together.kind.tolist() == [k for a in alone for k in a.kind.tolist()]
    assert np.bincount(together.text, minlength=5).tolist() == [5, 1, 3, 2, 1]


def optimum(pairs, context):
    """The penalised softmaxes' optimum: {word: probability} and the escape after a context."""
    seen = pairs.get(context)
    if not seen:
        return {}, 1.0
    total = sum(seen.values())
    return {w: (n - lm.PENALTY) / total for w, n in seen.items()}, lm.PENALTY * len(seen) / total


def brute_scores(rows, lexicon, weights, listed):
    """{row: chances of its tokens}, from dictionaries of words; the class softmax is given."""
    gaps, rare, shape_of = [{} for _ in lm.GAPS], {}, {}

    def shape(w):
        block = lm.Words(*flat_texts(pa.array([w])))
        return int(lm.shapes(block)[0])

    def before(ts, k, gap):
        return ts[k - gap] if k >= gap else "<start>"

    for i, text in rows:
        ts = tokens(text)
        for w in ts[:-1]:
            shape_of.setdefault(w, shape(w))
        if held(i):
            continue
        for k, w in enumerate(ts):
            for g, gap in enumerate(lm.GAPS):
                gaps[g].setdefault(before(ts, k, gap), Counter())[w] += 1
            if w is not None and w not in listed:
                rare.setdefault(shape_of[w], Counter())[w] += 1
    train_counts = Counter(w for i, t in rows if not held(i) for w in tokens(t))

    def chances(text):
        ts, out = tokens(text), []
        block = lm.Tokens(*flat_texts(pa.array([text or ""])), lexicon)
        logs = lm.log_softmax(weights, block.history)
        for k, w in enumerate(ts):
            c = block.kind[k]
            p = math.exp(logs[k, c])
            if c != lm.END and c >= lm.TOP:
                s = c - lm.TOP
                whole = lexicon.shape_words[s] + lexicon.shape_tokens[s] + 1
                if w in listed:
                    p *= (train_counts[w] + 1) / whole
                else:
                    own, rest = optimum(rare, s)
                    types = len(rare.get(s, ()))
                    share = sum(rare.get(s, Counter()).values()) + types + 1
                    p *= share / whole * (own.get(w, 0) + rest / (types + 1))
            for g in reversed(range(len(lm.GAPS))):
                own, rest = optimum(gaps[g], before(ts, k, lm.GAPS[g]))
                p = own.get(w, 0) + rest * p
            out.append(p)
        return out

    return chances


@pytest.mark.parametrize("frequent, bucket, hot", [(lm.FREQUENT, lm.BUCKET_TOKENS, lm.HOT), (40, 100, 10)])
def test_scores_against_brute_force(odd_docs, monkeypatch, frequent, bucket, hot):
    monkeypatch.setattr(lm, "FREQUENT", frequent)
    monkeypatch.setattr(lm, "BUCKET_TOKENS", bucket)
    monkeypatch.setattr(lm, "HOT", hot)
    kept = {}
    real_train, real_lexicon = lm.train, lm.lexicon_of
    monkeypatch.setattr(lm, "train", lambda cells: kept.setdefault("weights", real_train(cells)))
    monkeypatch.setattr(lm, "lexicon_of", lambda *a: kept.setdefault("lexicon", real_lexicon(*a)))
    rows = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    got = [(r.doc_id, r.score) for r in lm.score_texts(odd_docs).collect()]
    lexicon = kept["lexicon"]
    vocabulary = {w for _, t in rows for w in tokens(t)[:-1]}
    listed = {w for w in vocabulary if lm.find(lexicon, lm.Words(*flat_texts(pa.array([w]))).hash)[0] >= 0}
    assert len(listed) <= frequent
    chances = brute_scores(rows, lexicon, kept["weights"], listed)
    want = {(i, t): sum(math.log10(p) for p in chances(t)) for i, t in rows}
    for i, t in rows:
        assert any(j == i and abs(s - want[i, t]) <= 0.01 + 0.01 * abs(want[i, t]) for j, s in got), (i, want[i, t])
    # The chances of all words after a text sum to one: known words, the end, an unseen word of each shape.
    learnt = {w for i, t in rows if not held(i) for w in tokens(t)[:-1]}
    unseen = ["q" * n + accent + e for n in (0, 1, 2, 5, 8, 13) for accent in ("", "\u00f1", "\u00f6", "\u00e9")
              for e in ("", ",", ".")]
    spare = {}
    for w in {*unseen} - learnt - {""}:
        block = lm.Words(*flat_texts(pa.array([w])))
        spare.setdefault(int(lm.shapes(block)[0]), w)
    assert len(spare) == lm.SHAPES
    for prefix in ("", "one two", "ab", "zzzz qq"):
        first = chances(prefix)
        total = sum(chances(f"{prefix} {w}")[len(first) - 1] for w in [*learnt, *spare.values()]) + first[-1]
        assert total == pytest.approx(1, abs=1e-3)


def test_word_softmaxes_near_their_optimum():
    rng = np.random.default_rng(5)
    counts = np.concatenate([rng.zipf(1.5, 300).clip(1, 10**6), [1], [7], [1, 1, 1]]).astype(np.int64)
    begins = np.array([0, 100, 250, 300, 301, 302])
    p, escape, total = lm.fit_words(counts, begins, lm.PENALTY)
    of = np.repeat(np.arange(6), np.diff(np.append(begins, len(counts))))
    assert np.allclose(np.add.reduceat(p, begins) + escape, 1)
    assert np.allclose(p, (counts - lm.PENALTY) / total[of], rtol=0.02)
    assert [len(x) for x in lm.fit_words(counts[:0], begins[:0], lm.PENALTY)] == [0, 0, 0]


def test_order_of_words_counts(spark):
    texts = [words(60, i % 40) for i in range(400)]
    rnd = np.random.default_rng(1)
    mixed = [" ".join(rnd.permutation(t.split())) for t in texts[:40]]
    out = [n for n in range(1000, 2000) if held(n)][:40]
    table = [(i, t) for i, t in enumerate(texts) if not held(i)] + list(zip(out, mixed))
    rows = lm.score_texts(spark.createDataFrame(table, "doc_id long, text string")).collect()
    mean = lambda held_out: np.mean([r.score / r.n_tokens for r in rows if r.held_out == held_out])
    base = lambda held_out: np.mean([r.base_score / r.n_tokens for r in rows if r.held_out == held_out])
    assert abs(base(True) - base(False)) < 0.1 and mean(False) > mean(True) + 1
