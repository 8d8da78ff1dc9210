import random

import numpy as np
import pytest

from pitwall.llm import repeats

from conftest import words


def brute(texts, length=repeats.LENGTH):
    """Removed runs of each text."""
    raw = [(t or "").encode() for t in texts]
    count = {}
    for b in raw:
        for i in range(len(b) - length + 1):
            s = b[i:i + length]
            count[s] = count.get(s, 0) + 1
    out = []
    for b in raw:
        out.append(repeats.joined([(i, i + length) for i in range(len(b) - length + 1) if count[b[i:i + length]] > 1]))
    return out


def check(df, rows):
    found = sorted(((r.doc_id, r.n_bytes, [(s.start, s.stop) for s in r.removed], bytes(r.kept)) for r in
                    repeats.remove_repeats(df).collect()), key=str)
    want = []
    for (i, t), runs in zip(rows, brute([t for _, t in rows]), strict=True):
        b = (t or "").encode()
        gone = {x for s in runs for x in range(*s)}
        want.append((i, len(b), runs, bytes(v for n, v in enumerate(b) if n not in gone)))
    assert found == sorted(want, key=str)


def test_odd_rows(odd_docs, no_docs):
    check(odd_docs, [tuple(r) for r in odd_docs.select("doc_id", "text").collect()])
    assert repeats.remove_repeats(no_docs).collect() == []


def planted(seed, n=30):
    rnd = random.Random(seed)
    passages = [words(rnd.randint(30, 90), 1000 + k) for k in range(4)] + ["xyz " * 80, "é" * 150]
    rows = []
    for i in range(n):
        parts = [words(rnd.randint(5, 80), seed * 100 + i)]
        for _ in range(rnd.randint(0, 3)):
            p = rnd.choice(passages)
            a = rnd.randint(0, 40)
            parts += [p[a:a + rnd.randint(150, 600)], words(rnd.randint(0, 30), rnd.random())]
        rows.append((i, " ".join(parts)))
    return rows


@pytest.mark.parametrize("wide", [repeats.WIDE, 1])
def test_planted_passages(spark, monkeypatch, wide):
    monkeypatch.setattr(repeats, "WIDE", wide)
    rows = planted(3)
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), rows)


def test_index_against_brute_force():
    rng = np.random.default_rng(6)
    for trial in range(15):
        alphabet = rng.integers(1, 5)
        texts = [rng.integers(97, 97 + alphabet, rng.integers(1, 60)).astype(np.uint8) for _ in range(rng.integers(1, 9))]
        groups = np.sort(rng.integers(0, 3, len(texts)))
        off = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
        index = repeats.RunLengthIndex(np.concatenate(texts), off, groups)
        got = index.matches()
        for t, (a, g) in enumerate(zip(texts, groups, strict=True)):
            for i in range(len(a)):
                best = 0
                for u, (b, k) in enumerate(zip(texts, groups, strict=True)):
                    for j in range(len(b) if k == g else 0):
                        if (t, i) != (u, j):
                            m = 0
                            while i + m < len(a) and j + m < len(b) and a[i + m] == b[j + m]:
                                m += 1
                            best = max(best, m)
                assert got[off[t] + i] == best, (trial, t, i)
        assert len(index.heads) <= len(index.order)


def test_every_window_has_a_kept_anchor():
    for text in [b"ab " * 500, b"a" * 900, words(400, 1).encode(), b"x" * 199, b""]:
        data, off = np.frombuffer(text, np.uint8), np.array([0, len(text)])
        at, _ = repeats.anchors(data, off, repeats.Rolling(data))
        for i in range(len(text) - repeats.LENGTH + 1):
            assert ((at >= i) & (at <= i + repeats.REACH)).any()
