import random
import re
from collections import Counter

import numpy as np
import pytest

from pitwall.llm import graph, near

from conftest import words

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(LOWER)) if x]
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    """(doc_id, n_shingles, component_id, kept) of rows, by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    top = list(range(len(rows)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if 100 * common >= 85 * (len(sets[a]) + len(sets[b]) - common):
                    top[find(a)] = find(b)
    out = []
    for n, (i, _) in enumerate(rows):
        if not sets[n]:
            out.append((i, 0, i, True))
            continue
        ids = [rows[m][0] for m in range(len(rows)) if find(m) == find(n) and rows[m][0] is not None]
        least = min(ids) if ids else None
        out.append((i, len(sets[n]), least, least is None if i is None else i == least))
    return sorted(out, key=str)


def test_odd_rows(odd_docs, no_docs):
    found = near.near_components(odd_docs)
    assert sorted(map(tuple, found.collect()), key=str) == brute([tuple(r) for r in odd_docs.select("doc_id", "text").collect()])
    assert near.near_components(no_docs).collect() == []


@pytest.mark.parametrize("chunk", [2, 256])
def test_a_group_with_links_of_all_kinds(spark, monkeypatch, chunk):
    monkeypatch.setattr(near, "CHUNK", chunk)
    rnd = random.Random(11)
    base = words(120, 8).split()
    rows = []
    for i in range(60):
        w = list(base)
        for k in rnd.sample(range(len(w)), rnd.choice([0, 1, 1, 2, 3, 4, 6])):
            w[k] = f"q{rnd.randint(0, 3)}"
        rows.append((i * 7 % 61, " ".join(w)))
    rows += [(100 + i, words(80, 100 + i)) for i in range(20)]
    found = near.near_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    want = brute(rows)
    assert len({c for _, _, c, _ in want}) > 25
    assert sorted(map(tuple, found.collect()), key=str) == want


def test_least_matches_follow_the_posterior():
    least = near.least_matches()
    assert len(least) == near.HASHES // near.STEP and least == sorted(least)
    assert 0.6 < least[-1] / near.HASHES < near.LEAST[0] / near.LEAST[1]


def test_intersections_by_products():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 400, n).astype(np.uint64)) for n in (0, 1, 90, 200, 200, 300)]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    got = near._intersections(sets, columns=64)
    shared = [[got[i][j] for j in range(6)] for i in range(6)]
    assert all(shared[i][j] == want[i][j] for i in range(6) for j in range(6) if i != j)


@pytest.mark.parametrize("shape", ["chain", "star", "clique", "random"])
def test_components(spark, shape):
    rnd = random.Random(shape)
    n = 60
    pairs = {"chain": [(i, i + 1) for i in range(n)], "star": [(0, i) for i in range(1, n)] + [(200, 201)],
             "clique": [(i, j) for i in range(12) for j in range(i)], "random": [(rnd.randrange(90), rnd.randrange(90)) for _ in range(60)]}[shape]
    top = {x: x for p in pairs for x in p}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in pairs:
        top[find(a)] = find(b)
    key = lambda x: (x * 2654435761 % 2**32).to_bytes(4, "big") + x.to_bytes(4, "big")
    edges = spark.createDataFrame([(key(a), key(b)) for a, b in pairs], "a binary, b binary")
    got = {int.from_bytes(r.v[4:], "big"): r.root for r in graph.components(edges).collect()}
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    assert set(got) == linked
    assert Counter(Counter(got.values()).values()) == Counter(Counter(find(x) for x in linked).values())
    assert all(got[a] == got[b] for a, b in pairs if a != b)
    assert graph.components(edges.limit(0)).collect() == []
