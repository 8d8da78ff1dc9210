import random

import pytest

import corpus_pipeline as cp
from pitwall.llm import near

from conftest import words
from test_near import shingles

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def brute(rows, least):
    """Ids that stay when texts of at least ``least`` percent similarity are linked."""
    sets = {i: shingles(t) for i, t in rows}
    top = {i: i for i in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a in sets:
        for b in sets:
            common = len(sets[a] & sets[b])
            if a < b and 100 * common >= least * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((find(a), find(b)))
                top[y] = x
    return [i for i in sorted(sets) if find(i) == i]


def changed(size, seed):
    """A text and a copy with its middle word exchanged: (size - 9) of (size + 1) shingles in common."""
    base = words(size, seed).split()
    other = list(base)
    other[size // 2] = "zzzzzzzzz"
    return " ".join(base), " ".join(other)


def staying(spark, rows):
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in rows], SCHEMA).repartition(4)
    return sorted(r.doc_id for r in cp.near_stage(spark, docs, None).collect())


def test_the_stage_links_from_four_fifths_on(spark):
    rows = []
    for n, size in enumerate((48, 49, 50, 57, 65, 66, 90)):
        a, b = changed(size, 40 + n)
        rows += [(10 * n, a), (10 * n + 1, b)]
    want = brute(rows, 80)
    assert [i for i in want if i % 10] == [1] and len(brute(rows, 85)) == len(want) + 4
    assert staying(spark, rows) == want


@pytest.mark.parametrize("chunk", [2, 256])
def test_the_stage_agrees_with_brute_force_at_four_fifths(spark, monkeypatch, chunk):
    monkeypatch.setattr(near, "CHUNK", chunk)
    rnd = random.Random(5)
    rows = []
    for group in range(6):
        base = words(130, 60 + group).split()
        for i in range(12):
            w = list(base)
            for k in rnd.sample(range(len(w)), rnd.choice([0, 2, 3, 4, 5])):
                w[k] = f"q{rnd.randint(0, 2)}"
            rows.append((100 * group + i, " ".join(w)))
    want = brute(rows, 80)
    assert len(want) < len(brute(rows, 85))
    assert staying(spark, rows) == want


def test_bands_of_the_stage_miss_less_than_one_in_a_hundred_thousand():
    assert cp.NEAR.least == (80, 100) and cp.NEAR.missed() <= 1e-5 and cp.NEAR.hashes % cp.NEAR.step == 0
    assert near.STRICT.least == (85, 100)


def test_the_given_documents_agree_with_brute_force_at_four_fifths(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect() if shingles(r.text)]
    ids = {i for i, _ in rows}
    got = sorted(r.doc_id for r in cp.near_stage(spark, docs, None).collect())
    assert [i for i in got if i in ids] == brute(rows, 80)
