import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitwall.llm import balltree


def brute(rows, is_query, k):
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
          if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    queries = {}
    for i, v in ok:
        if is_query(i):
            queries[i] = min(queries.get(i, v), v)
    out = []
    for q, v in queries.items():
        best = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in ok if i != q and len(w) == len(v))[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


def run(spark, rows, k=5, kind="double"):
    df = spark.createDataFrame([(i, v, "x", "y", 1) for i, v in rows], f"vec_id long, embedding array<{kind}>, score string, shard string, dim int")
    return sorted(map(tuple, balltree.top_k(df.repartition(3), F.col("vec_id") % 10 == 0, k).collect()))


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(balltree, "SHARD_ROWS", 60)
    monkeypatch.setattr(balltree, "BLOCK_ROWS", 7)


def test_against_brute_force(spark, small):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(6, 8))
    rows = [(i, (centres[i % 6] + 0.1 * rng.normal(size=8)).tolist()) for i in range(400)]
    assert run(spark, rows) == brute(rows, lambda i: i % 10 == 0, 5)


def test_ties_copies_and_odd_vectors(spark, small):
    rnd = random.Random(2)
    rows = [(i, [rnd.choice([-0.5, 0.0, 0.5]) for _ in range(3)]) for i in range(150)]
    rows += [(1000 + i, [0.25, 0.25, 0.25]) for i in range(120)]
    rows += [(20, [1.0, 1.0, 1.0]), (20, [1.0, 1.0, 1.0]), (1001, [0.25, 0.25, 0.25])]
    rows += [(300, None), (310, []), (320, [None, 1.0, 1.0]), (330, [float("nan"), 1.0, 1.0]), (340, [float("inf"), 0.0, 0.0]),
             (None, [1.0, 1.0, 1.0]), (350, [1.0, 2.0]), (351, [2.0, 1.0]), (360, [0.5]), (370, [30000.0, 5.0, -30000.0])]
    assert run(spark, rows) == brute(rows, lambda i: i % 10 == 0, 5)


def test_few_rows_and_none(spark):
    rows = [(0, [1.0]), (1, [-1.0])]
    assert run(spark, rows) == [(0, 1, 1, -65536)]
    assert run(spark, [(0, [1.0])]) == [] == run(spark, [])


def test_bounds_hold_for_all_nodes():
    rng = np.random.default_rng(5)
    x = np.floor(rng.normal(size=(500, 6)) * 256)
    tree = balltree.BallTree(np.arange(500), x)
    assert tree.leaf_sizes.max() <= balltree.LEAF and sorted(tree.order.tolist()) == list(range(500))
    for centres, radii in zip(tree.centres, tree.radii, strict=True):
        per = np.array_split(np.arange(len(tree.leaf_sizes)), len(centres))
        ends = np.cumsum(tree.leaf_sizes)
        for c, r, leaves in zip(centres, radii, per, strict=True):
            own = x[tree.order[ends[leaves[0]] - tree.leaf_sizes[leaves[0]]:ends[leaves[-1]]]]
            assert np.sqrt(((own - c) ** 2).sum(axis=1)).max() <= r + 1e-6


def test_components_beyond_32_bits(spark, small):
    rows = [(10, [1.0e7, 1.0]), (1, [1.0, 2.0e7]), (2, [1.0e7, 0.0]), (3, [-1.0e7, 5.0]), (20, [1.0e6, -3.0]), (5, [7.5e5, 7.5e5])]
    got = run(spark, rows)
    assert got == brute(rows, lambda i: i % 10 == 0, 5)
    assert max(r[3] for r in got) > 2**53
    huge = [(10, [3.0e16, 1.0]), (1, [1 / 256, 1.0]), (2, [0.0, 2.0]), (3, [-1 / 256, -1.0])]
    assert run(spark, huge) == brute(huge, lambda i: i % 10 == 0, 5)
    with pytest.raises(Exception, match="64 bits"):
        run(spark, [(10, [3.0e16, 1.0]), (1, [3.0e16, 1.0])])
    with pytest.raises(Exception, match="64 bits"):
        run(spark, [(10, [1.0e300, 1.0]), (1, [1.0, 1.0])])


def test_trees_and_blocks_are_not_broadcast(spark, small, monkeypatch):
    """Every block meets every shard: neither may go through the driver, whatever the optimizer takes them for."""
    monkeypatch.setattr(balltree, "PARTS", 3, raising=False)
    monkeypatch.setattr(balltree, "PART_BYTES", 60 * 8 * 8 * 2, raising=False)
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(500)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = balltree.top_k(df, F.col("vec_id") % 10 == 0, 5)
    assert "Broadcast" not in found._jdf.queryExecution().sparkPlan().toString()
    assert sorted(map(tuple, found.collect())) == brute(rows, lambda i: i % 10 == 0, 5)
