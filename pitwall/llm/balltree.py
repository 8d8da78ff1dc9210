"""Operator 5: exact top-k inner products by branch and bound over ball trees.

Vectors become whole numbers, floor(256 x).  Candidates are dealt over shards of bounded
size; each shard is one row that holds its ball tree (leaves of at most ``LEAF`` vectors,
centre and radius of every node).  Queries are dealt over blocks.  In a (shard, block) pair,
nodes whose bound  q.c + |q| r  is below a query's current k-th score are cut off, the
leaves that remain are visited by falling bound, and the k-th score rises on the way.

Shards are searched in two waves: a first shard for every block, and then all others, which
start from the k-th scores that the first wave found.  For that, shards are dealt over *parts*
of bounded size: a task holds the trees of one part while the blocks pass by, so that trees move
once, blocks once per part, and neither is broadcast.  Only each pair's best rows leave it.

Defined cases: vectors that are null, empty, or hold a null or non-finite component take no
part; vectors are compared with those of the same length; ties go to the smaller id; a
query's own rows (all with its id) are no candidates for it; rows that repeat an id are each
candidates, and a query id counts once (its smallest vector in sort order of the components);
a null id takes no part.  Whole numbers of 64 bits hold components and scores; a component beyond
that after scaling, or a score among a query's best beyond it, is an error.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitwall.llm.common import bounded_batches, written

SCALE = 256
#: Vectors of a shard and queries of a block, on average; vectors of a leaf, at most.
SHARD_ROWS, BLOCK_ROWS, LEAF = 4096, 512, 64
#: Vectors of a part, at most, in bytes; parts that a search is dealt over, if there are shards for them.
PART_BYTES, PARTS = 32 << 20, 64


def scaled(df: DataFrame, vector: str, id_column: str) -> DataFrame:
    """(vec_id, v array<long>) of the rows that take part."""
    whole = lambda x: x.cast("double") * SCALE
    v = F.transform(F.col(vector), lambda x: F.when(F.abs(whole(x)) < 2.0**63, F.floor(whole(x))).otherwise(
        F.raise_error(F.lit("a component has more than 64 bits after scaling")).cast("long")))
    fine = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (df.where(F.col(id_column).isNotNull() & (F.size(vector) > 0) & F.coalesce(fine, F.lit(False)))
            .select(F.col(id_column).cast("long").alias("vec_id"), v.alias("v")))


class BallTree:
    """Nodes in levels: node n of a level covers an equal run of the reordered vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        groups = [order]
        while max(map(len, groups)) > LEAF:
            groups = [half for g in groups for half in self._halves(g, vectors)]
        self.order = np.concatenate(groups)
        self.leaf_sizes = np.array([len(g) for g in groups], np.int64)
        self.centres, self.radii = [], []
        level = [np.sort(g) for g in groups]
        while True:
            balls = [self._ball(vectors[g]) for g in level]
            self.centres.append(np.array([c for c, _ in balls]))
            self.radii.append(np.array([r for _, r in balls]))
            if len(level) == 1:
                break
            level = [np.concatenate(level[i:i + 2]) for i in range(0, len(level), 2)]

    @staticmethod
    def _halves(g: np.ndarray, vectors: np.ndarray) -> list[np.ndarray]:
        """Split at the median along the line between two far points."""
        x = vectors[g]
        far = x[((x - x[0]) ** 2).sum(axis=1).argmax()]
        other = x[((x - far) ** 2).sum(axis=1).argmax()]
        side = np.argsort(x @ (other - far), kind="stable")
        return [g[side[:len(g) // 2]], g[side[len(g) // 2:]]]

    @staticmethod
    def _ball(x: np.ndarray) -> tuple[np.ndarray, float]:
        if not len(x):
            return np.zeros(x.shape[1]), 0.0
        centre = x.mean(axis=0)
        return centre, float(np.sqrt(((x - centre) ** 2).sum(axis=1).max()))


SHARD = "dim int, shard int, ids binary, vectors binary, leaf_sizes binary, centres binary, radii binary, level_sizes binary"


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), np.int64)


def shards(points: DataFrame, count: int) -> DataFrame:
    """One row per shard with its tree; ``points``: vec_id, v."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        ids, v = rows["vec_id"].to_numpy(np.int64), _matrix(rows["v"])
        tree = BallTree(ids, v.astype(np.float64))
        return pd.DataFrame([{
            "dim": int(rows["dim"].iloc[0]), "shard": int(rows["shard"].iloc[0]),
            "ids": ids[tree.order].tobytes(), "vectors": v[tree.order].tobytes(),
            "leaf_sizes": tree.leaf_sizes.tobytes(), "centres": np.concatenate(tree.centres).tobytes(),
            "radii": np.concatenate(tree.radii).tobytes(),
            "level_sizes": np.array([len(r) for r in tree.radii], np.int64).tobytes()}])

    dealt = points.withColumns({"dim": F.size("v"), "shard": F.pmod(F.xxhash64("vec_id", "v"), F.lit(count)).cast("int")})
    return dealt.groupBy("dim", "shard").applyInPandas(run, SHARD)


BLOCK = "dim int, block int, ids binary, queries binary, least binary"
FOUND = "dim int, block int, query_id long, vec_id long, score long"


def blocks(queries: DataFrame, count: int) -> DataFrame:
    """One row per block of queries, without k-th scores yet."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        q = _matrix(rows["v"])
        return pd.DataFrame([{"dim": int(rows["dim"].iloc[0]), "block": int(rows["block"].iloc[0]),
                              "ids": rows["vec_id"].to_numpy(np.int64).tobytes(), "queries": q.tobytes(),
                              "least": np.full(len(q), np.iinfo(np.int64).min).tobytes()}])

    dealt = queries.withColumns({"dim": F.size("v"), "block": F.pmod(F.xxhash64("vec_id"), F.lit(count)).cast("int")})
    return dealt.groupBy("dim", "block").applyInPandas(run, BLOCK)


def _whole(scores: np.ndarray) -> np.ndarray:
    """Scores as 64-bit integers; a score beyond them would be among the best or is never needed."""
    if scores.dtype == object:
        if (scores > np.iinfo(np.int64).max).any():
            raise OverflowError("a score has more than 64 bits")
        scores = np.maximum(scores, np.iinfo(np.int64).min + 1)
    return scores.astype(np.int64)


def search(queries: np.ndarray, query_ids: np.ndarray, least: np.ndarray, shard: dict, k: int) -> list[tuple]:
    """(query index, ids, scores) of the best at most k candidates of a shard that reach ``least``."""
    dim = queries.shape[1]
    vectors = np.frombuffer(shard["vectors"], np.int64).reshape(-1, dim)
    ids = np.frombuffer(shard["ids"], np.int64)
    sizes = np.frombuffer(shard["leaf_sizes"], np.int64)
    starts = np.concatenate(([0], np.cumsum(sizes)))
    levels = np.frombuffer(shard["level_sizes"], np.int64)
    ends = np.cumsum(levels)
    centres = np.frombuffer(shard["centres"], np.float64).reshape(-1, dim)
    radii = np.frombuffer(shard["radii"], np.float64)
    q = queries.astype(np.float64)
    norms = np.sqrt((q**2).sum(axis=1))
    # Whole numbers up to 2^53 are exact in floating point; larger sums take 64-bit integers, and
    # those that may pass 64 bits Python's.
    largest = float(np.abs(vectors.astype(np.float64)).max(initial=0)) * float(np.abs(q).max(initial=0)) * dim
    kind = np.float64 if largest < 2.0**53 else np.int64 if largest < 2.0**62 else object
    floats, qx = vectors.astype(kind), queries.astype(kind)
    least = least.astype(np.float64)
    # Top down: pairs of (query, node) whose bound reaches the query's k-th score so far.
    who, node = np.arange(len(q)), np.zeros(len(q), np.int64)
    for level in range(len(levels) - 1, -1, -1):
        at = node + ends[level] - levels[level]
        bound = np.einsum("ij,ij->i", q[who], centres[at]) + norms[who] * radii[at]
        bound += 1e-6 * (np.abs(bound) + norms[who] * radii[at] + 1)
        keep = bound >= least[who]
        who, node, bound = who[keep], node[keep], bound[keep]
        if level:
            who, node = np.repeat(who, 2), np.repeat(node * 2, 2) + np.tile([0, 1], len(node))
            inside = node < levels[level - 1]
            who, node = who[inside], node[inside]
    # Leaves by falling bound; round r visits every query's r-th leaf, leaf by leaf.
    order = np.lexsort((-bound, who))
    who, node, bound = who[order], node[order], bound[order]
    first = np.searchsorted(who, np.arange(len(q)))
    turn = np.arange(len(who)) - first[who]
    best_score = np.full((len(q), 0), 0, np.int64)
    best_id = np.full((len(q), 0), 0, np.int64)
    none = np.iinfo(np.int64).min
    best_score, best_id = np.full((len(q), k), none), np.full((len(q), k), np.iinfo(np.int64).max)
    by_turn = np.argsort(turn, kind="stable")
    cuts = np.searchsorted(turn[by_turn], np.arange(int(turn.max(initial=-1)) + 2))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        now = by_turn[a:b]
        now = now[bound[now] >= least[who[now]]]
        now = now[np.argsort(node[now], kind="stable")]
        leaf_cuts = np.flatnonzero(np.diff(node[now])) + 1
        for part in np.split(now, leaf_cuts):
            if not len(part):
                continue
            leaf, asking = node[part[0]], who[part]
            lo, hi = starts[leaf], starts[leaf + 1]
            if lo == hi:
                continue
            own = ids[lo:hi][None, :] == query_ids[asking][:, None]
            scores = _whole(np.where(own, 0, qx[asking] @ floats[lo:hi].T))
            scores[own] = none
            all_scores = np.concatenate((best_score[asking], scores), axis=1)
            all_ids = np.concatenate((best_id[asking], np.broadcast_to(ids[lo:hi], scores.shape)), axis=1)
            all_ids[:, k:][own] = np.iinfo(np.int64).max
            top = np.lexsort((all_ids, -(all_scores + (all_scores == none))), axis=1)[:, :k]
            best_score[asking] = np.take_along_axis(all_scores, top, 1)
            best_id[asking] = np.take_along_axis(all_ids, top, 1)
            least[asking] = np.maximum(least[asking], np.where(best_score[asking][:, -1] == none, -np.inf, best_score[asking][:, -1]))
    out = []
    for i in range(len(q)):
        real = (best_score[i] != none) & (best_score[i] >= least[i])
        if real.any():
            out.append((i, best_id[i][real], best_score[i][real]))
    return out


def wave(asked: DataFrame, trees: DataFrame, k: int, tasks: int, first: bool) -> DataFrame:
    """Search the trees of each block's part: of the block's own shard only (``first``), or of all others.

    ``asked`` has a block's columns, a shard and a part, ``trees`` a tree's columns and a part.
    """

    def answers(r: dict, held: list[dict]):
        ids = np.frombuffer(r["ids"], np.int64)
        q, least = np.frombuffer(r["queries"], np.int64).reshape(len(ids), -1), np.frombuffer(r["least"], np.int64).copy()
        for tree in held:
            if (tree["shard"] == r["shard"]) != first:
                continue
            found = search(q, ids, least, tree, k)
            for i, _, scores in found:
                if len(scores) == k:
                    least[i] = max(least[i], scores[-1])
            if found:
                yield pd.DataFrame({"dim": r["dim"], "block": r["block"],
                                    "query_id": np.repeat(ids[[i for i, _, _ in found]], [len(x) for _, x, _ in found]),
                                    "vec_id": np.concatenate([x for _, x, _ in found]),
                                    "score": np.concatenate([s for _, _, s in found])})

    def run(frames):
        held, part = [], None
        for rows in frames:
            for r in rows.to_dict("records"):
                if (r["dim"], r["part"]) != part:
                    held, part = [], (r["dim"], r["part"])
                if r["block"] < 0:
                    held.append(r)
                else:
                    yield from answers(r, held)

    # In each part the trees come first, then the blocks.
    rows = trees.withColumn("block", F.lit(-1)).unionByName(asked, allowMissingColumns=True)
    dealt = rows.repartition(tasks, "dim", "part").sortWithinPartitions("dim", "part", "block", "shard")
    return bounded_batches(dealt).mapInPandas(run, FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(df: DataFrame, is_query, k: int = 5, vector: str = "embedding", id_column: str = "vec_id") -> DataFrame:
    """query_id, rank, vec_id and score of the best k of every query."""
    points = written(scaled(df, vector, id_column), "points")
    size = points.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.size("v")), F.lit(1)).alias("dim")).first()
    n_shards = max(1, -(-size["n"] // SHARD_ROWS))
    n_parts = min(n_shards, max(PARTS, -(-n_shards * SHARD_ROWS * size["dim"] * 8 // PART_BYTES)))
    asked = points.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v"))
    asked = written(asked, "queries")
    n_blocks = max(1, -(-asked.count() // BLOCK_ROWS))
    trees = written(shards(points, n_shards), "trees")
    groups = written(blocks(asked, n_blocks), "blocks")
    groups = groups.withColumn("shard", F.pmod(F.xxhash64("block"), F.lit(n_shards)).cast("int"))
    asked = groups.withColumn("part", F.col("shard"))
    wanted = trees.join(asked.select("dim", "shard").distinct(), ["dim", "shard"], "left_semi").withColumn("part", F.col("shard"))
    found = written(wave(asked, wanted, k, n_parts, first=True), "first")
    # The k-th scores of the first wave, in the order of each block's queries.
    kth = _best(found, k).where(F.col("rank") == k).select("dim", "block", "query_id", "score")
    kth = kth.groupBy("dim", "block").agg(F.map_from_entries(F.collect_list(F.struct("query_id", "score"))).alias("kth"))

    def raise_least(frames):
        for rows in frames:
            out = []
            for ids, kth in zip(rows["ids"], rows["kth"], strict=True):
                kth = dict(kth or {})
                out.append(np.array([kth.get(i, np.iinfo(np.int64).min) for i in np.frombuffer(ids, np.int64).tolist()], np.int64).tobytes())
            rows["least"] = out
            yield rows.drop(columns=["kth"])

    # Estimates see no long binaries and no explode, so the joined sides are sorted, never broadcast.
    columns = ["dim", "block", "ids", "queries", "least", "shard"]
    groups = groups.join(kth.hint("merge"), ["dim", "block"], "left").select(*columns, "kth").mapInPandas(raise_least, BLOCK + ", shard int")
    rest = groups.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(n_parts - 1))))
    dealt = trees.withColumn("part", F.pmod("shard", F.lit(n_parts)))
    found = found.unionByName(wave(rest, dealt, k, n_parts, first=False))
    return _best(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
