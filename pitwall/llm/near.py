"""Operator 4: near-duplicate components by MinHash with sequential Bayesian verification.

1. *Classes.*  Texts with the same set of five-word shingles form a class (told by a 128-bit
   digest of the set); the smallest id represents it, so exact copies meet nowhere again.
2. *Candidates.*  Each representative's signature is cut into bands; representatives
   with an equal band share a bucket.  Buckets come from counts and an equi-join.
3. *Verification.*  Buckets are worked on in blocks of at most ``CHUNK`` members a side.
   In a block, signatures are compared batch by batch, and a pair is dropped as soon as the
   posterior probability of the least similarity falls below ``MISS``; a pair counts in
   its first common band only.  Texts of documents with surviving pairs come to the block,
   and every surviving pair is confirmed on the full shingle sets.  A block returns a
   spanning forest of its links, never all pairs.
4. *Large buckets.*  A bucket of more than ``CHUNK`` members is first split into random blocks;
   after the components of those links are known, a second round compares
   the members outside the bucket's largest component with each other and with the rest.
   So the links between different components are all looked for, without limits.

Defined cases: null, empty and blank texts have an empty set and link with nothing; with
fewer than five words the whole sequence is the one shingle; repeated rows share a class; a
row without id joins its class but represents none (it is kept only if nobody does).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache
from math import comb
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitwall.llm.common import Words, bounded_batches, flat_texts, mix64, text_blocks, written
from pitwall.llm.graph import components

#: Words per shingle and the least similarity of a link, as a ratio of whole numbers.
WORDS = 5
LEAST = (85, 100)
#: Bands and hashes per band: a pair at the least similarity misses all bands with
#: probability (1 - 0.85^6)^24 = 1.1e-5; signatures are compared band-size by band-size.
BANDS, ROWS = 24, 6
HASHES = BANDS * ROWS
#: Hashes compared before each look at the posterior, and the chosen miss probability of a look.
STEP = 24
MISS = 1e-6



class Similarity(NamedTuple):
    """The least similarity of a link, and the bands and looks that go with it."""

    least: tuple[int, int] = LEAST
    bands: int = BANDS
    rows: int = ROWS
    step: int = STEP

    @property
    def hashes(self) -> int:
        return self.bands * self.rows

    def missed(self) -> float:
        """The probability that a pair at the least similarity shares no band."""
        return (1 - (self.least[0] / self.least[1]) ** self.rows) ** self.bands


#: Operator 4's contract.
STRICT = Similarity()

#: Hash functions that any similarity can ask for.
_MOST = 256
_RNG = np.random.default_rng(41)
_MASK = _RNG.integers(0, 2**32, HASHES, dtype=np.uint64).astype(np.uint32)
_ODD = (_RNG.integers(0, 2**31, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)).astype(np.uint32)
_MASK = np.concatenate((_MASK, _RNG.integers(0, 2**32, _MOST - HASHES, dtype=np.uint64).astype(np.uint32)))
_ODD = np.concatenate((_ODD, (_RNG.integers(0, 2**31, _MOST - HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)).astype(np.uint32)))
_FACTORS = np.array([pow(0xC2B2AE3D27D4EB4F, i, 1 << 64) for i in range(WORDS)], np.uint64)


def shingle_sets(data: np.ndarray, off: np.ndarray) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text of a block.

    With fewer than five words the whole sequence is one shingle; without words there is none.
    """
    words = Words(data, off)
    h, first = words.hash, words.first
    n = len(h)
    runs = np.zeros(max(n - WORDS + 1, 0), np.uint64)
    for j in range(WORDS if n >= WORDS else 0):
        runs += h[j:n - WORDS + 1 + j] * _FACTORS[j]
    runs = mix64(runs)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= WORDS:
            out.append(np.unique(runs[a:b - WORDS + 1]))
        elif b > a:
            few = (h[a:b] * _FACTORS[:b - a]).sum(dtype=np.uint64)
            out.append(mix64(np.array([few + np.uint64(b - a)])))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signature(shingles: np.ndarray, hashes: int = HASHES) -> np.ndarray:
    """16 bits of the smallest hash of the set under each of the first ``hashes`` hash functions."""
    low = np.full(hashes, 2**32 - 1, np.uint32)
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    for a in range(0, len(x), 2048):
        np.minimum(low, ((x[None, a:a + 2048] ^ _MASK[:hashes, None]) * _ODD[:hashes, None]).min(axis=1), out=low)
    return (mix64(low.astype(np.uint64)) >> np.uint64(48)).astype(np.uint16)


def set_digest(shingles: np.ndarray) -> bytes:
    """128 bits that tell sets apart."""
    a = mix64(shingles ^ np.uint64(0x243F6A8885A308D3)).sum(dtype=np.uint64)
    b = mix64(shingles + np.uint64(0x13198A2E03707344)).sum(dtype=np.uint64)
    return mix64(np.array([a, b + np.uint64(len(shingles))], np.uint64)).tobytes()


def band_keys(signatures: np.ndarray, like: Similarity = STRICT) -> np.ndarray:
    """Keys (rows x bands, int64) of the bands of a signature matrix."""
    keys = np.broadcast_to(np.arange(1, like.bands + 1, dtype=np.uint64), (len(signatures), like.bands)).copy()
    parts = signatures.reshape(-1, like.bands, like.rows).astype(np.uint64)
    for j in range(like.rows):
        keys = mix64(keys * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, j])
    return keys.view(np.int64)


@cache
def least_matches(like: Similarity = STRICT, miss: float = MISS) -> list[int]:
    """For 1, 2, ... steps: the fewest matching hashes that keep a pair.

    With a uniform prior, after m matches of n the posterior probability of a similarity of
    at least t is P(Binomial(n + 1, t) <= m); a pair is pruned once that falls below ``miss``.
    """
    t = like.least[0] / like.least[1]
    out = []
    for n in range(like.step, like.hashes + 1, like.step):
        tail, m = 0.0, -1
        while tail < miss:
            m += 1
            tail += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out.append(m)
    return out


def survivors(signatures: np.ndarray, keys: np.ndarray, i: np.ndarray, j: np.ndarray,
              like: Similarity = STRICT) -> np.ndarray:
    """Which of the pairs (i, j) of signature rows are left after all looks at the posterior.

    ``keys``: the bucket key of each row; a pair counts only in its first common band.
    """
    left = np.arange(len(i))
    matches = np.zeros(len(i), np.int64)
    for look, least in enumerate(least_matches(like)):
        a, b = look * like.step, (look + 1) * like.step
        matches[left] += (signatures[i[left], a:b] == signatures[j[left], a:b]).sum(axis=1)
        left = left[matches[left] >= least]
    if len(left):
        equal = (signatures[i[left]] == signatures[j[left]]).reshape(-1, like.bands, like.rows).all(axis=2)
        own = band_keys(signatures[i[left]], like) == keys[i[left]][:, None]
        left = left[equal.argmax(axis=1) == own.argmax(axis=1)]
    return left


def block_pairs(sides: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of one block's members to compare: of different groups, and across sides if it has two."""
    i, j = np.triu_indices(len(sides), 1)
    ok = groups[i] != groups[j]
    if len(sides) and sides.min() != sides.max():
        ok &= sides[i] != sides[j]
    return i[ok], j[ok]


def links_of(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray, like: Similarity = STRICT) -> list[tuple[int, int]]:
    """A spanning forest of the pairs whose full sets are similar enough."""
    parent = list(range(len(sets)))

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    sizes = np.array([len(s) for s in sets])
    many = len(i) > 4 * len(sets)
    if many:
        shared = _intersections(sets)[i, j]
    out = []
    for n, (a, b) in enumerate(zip(i.tolist(), j.tolist(), strict=True)):
        if (x := top(a)) == (y := top(b)):
            continue
        common = int(shared[n]) if many else len(np.intersect1d(sets[a], sets[b], assume_unique=True))
        if like.least[1] * common >= like.least[0] * (int(sizes[a] + sizes[b]) - common):
            parent[x] = y
            out.append((a, b))
    return out


def _intersections(sets: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Sizes of all pairwise intersections, by products of slices of the incidence matrix."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, item, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    often = count[item] > 1
    owner, item = owner[often], item[often]
    _, item = np.unique(item, return_inverse=True)
    order = np.argsort(item, kind="stable")
    owner, item = owner[order], item[order]
    total = np.zeros((len(sets), len(sets)), np.int64)
    for a in range(0, int(item[-1]) + 1 if len(item) else 0, columns):
        lo, hi = np.searchsorted(item, (a, a + columns))
        part = np.zeros((len(sets), columns), np.float32)
        part[owner[lo:hi], item[lo:hi] - a] = 1
        total += (part @ part.T).astype(np.int64)
    return total


# ---------------------------------------------------------------- Spark

#: Members of a block, a side.
CHUNK = 256
BLOCK = ["key", "part"]


def sketches(df: DataFrame, text: str = "text", id_column: str = "doc_id", like: Similarity = STRICT,
             mark: str | None = None) -> DataFrame:
    """doc_id, n_shingles, set digest and signature of each whole text, and the binary column ``mark`` as it is."""
    marks = [mark] if mark else []

    def run(batches):
        for batch in batches:
            data, off = flat_texts(batch.column(1))
            for a, b, part, cuts in text_blocks(data, off):
                sets = shingle_sets(part, cuts)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, b - a), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([set_digest(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array([signature(s, like.hashes).tobytes() if len(s) else None for s in sets], pa.binary()),
                    *[batch.column(2).slice(a, b - a) for _ in marks]],
                    ["doc_id", "n_shingles", "vid", "signature", *marks])

    return (df.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"), *marks)
            .mapInArrow(run, "doc_id long, n_shingles long, vid binary, signature binary" + "".join(f", `{m}` binary" for m in marks)))


def packed_texts(df: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """doc_id and the compressed text, for joins that must move texts."""

    def run(batches):
        pack = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                data, off = flat_texts(part.column(1))
                raw = data.tobytes()
                packed = [pack.compress(raw[x:y]) for x, y in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(packed, pa.binary())], ["doc_id", "packed"])

    return (df.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))
            .where("doc_id is not null").mapInArrow(run, "doc_id long, packed binary"))


def unpacked(packed: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Compressed texts as (bytes, offsets)."""
    unpack = zstandard.ZstdDecompressor()
    texts = [unpack.decompress(p) for p in packed]
    off = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    return np.frombuffer(b"".join(texts), np.uint8), off


def _bands(reps: DataFrame, like: Similarity) -> DataFrame:
    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 4096):
                part = batch.slice(a, 4096)
                keys = band_keys(_signatures(part.column(1), like), like)
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), part.column(0).take(
                    pa.array(np.repeat(np.arange(len(keys)), like.bands)))], ["key", "vid"])

    return reps.select("vid", "signature").mapInArrow(run, "key long, vid binary")


def _signatures(column: pa.Array, like: Similarity) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, like.hashes)


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole blocks from batches that are sorted by block."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key, part = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
        change = np.flatnonzero((key[1:] != key[:-1]) | (part[1:] != part[:-1])) + 1
        last = int(change[-1]) if len(change) else 0
        if held and (held[-1].column(0)[-1], held[-1].column(1)[-1]) != (batch.column(0)[0], batch.column(1)[0]):
            yield pa.Table.from_batches(held)
            held = []
        if last:
            yield pa.Table.from_batches([*held, batch.slice(0, last)])
            held = []
        held.append(batch.slice(last))
    if held:
        yield pa.Table.from_batches(held)


def _cuts(table: pa.Table) -> list[tuple[int, int]]:
    key, part = (table.column(k).to_numpy() for k in (0, 1))
    at = np.flatnonzero((key[1:] != key[:-1]) | (part[1:] != part[:-1])) + 1
    ends = [0, *at.tolist(), len(key)]
    return list(zip(ends[:-1], ends[1:], strict=True))


def _codes(column: pa.ChunkedArray) -> np.ndarray:
    """Whole numbers that tell the values of a column apart."""
    return column.combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)


MEMBER = "key long, part string, side int, comp binary, vid binary"


def candidates(members: DataFrame, reps: DataFrame, like: Similarity = STRICT) -> DataFrame:
    """Members of blocks that have a pair left after comparing signatures."""

    def run(batches):
        for table in _blocks(batches):
            sig = _signatures(table.column("signature"), like)
            keys, sides, groups = table.column(0).to_numpy(), table.column("side").to_numpy(), _codes(table.column("comp"))
            take = np.zeros(len(sig), bool)
            found: list[tuple[np.ndarray, np.ndarray]] = []
            size = 0
            cuts = _cuts(table)
            for n, (a, b) in enumerate(cuts):
                i, j = block_pairs(sides[a:b], groups[a:b])
                found.append((i + a, j + a))
                size += len(i)
                if size > 100_000 or n + 1 == len(cuts):
                    i, j = (np.concatenate(x) for x in zip(*found, strict=True))
                    left = survivors(sig, keys, i, j, like)
                    take[i[left]] = take[j[left]] = True
                    found, size = [], 0
            if take.any():
                yield from table.drop_columns(["signature"]).filter(pa.array(take)).to_batches()

    rows = members.select(*BLOCK, "side", "comp", "vid").join(reps.select("vid", "signature"), "vid")
    rows = rows.select(*BLOCK, "side", "comp", "vid", "signature").repartition(*BLOCK).sortWithinPartitions(*BLOCK)
    return rows.mapInArrow(run, MEMBER)


def confirmed(members: DataFrame, texts: DataFrame, like: Similarity = STRICT) -> DataFrame:
    """Links (a, b) of blocks: a spanning forest of the pairs confirmed on full sets.

    ``texts``: vid and packed text of all members.
    """

    def run(batches):
        for table in _blocks(batches):
            vid, packed = table.column("vid").to_pylist(), table.column("packed").to_pylist()
            keys, sides, groups = table.column(0).to_numpy(), table.column("side").to_numpy(), _codes(table.column("comp"))
            a_side, b_side = [], []
            for a, b in _cuts(table):
                sets = [s for x, y, data, off in text_blocks(*unpacked(packed[a:b])) for s in shingle_sets(data, off)]
                # A repeated id may bring another text along; the digest tells.
                own = [n for n, s in enumerate(sets) if len(s) and set_digest(s) == vid[a + n]]
                i, j = block_pairs(sides[a:b][own], groups[a:b][own])
                sets = [sets[n] for n in own]
                if not len(i):
                    continue
                left = survivors(np.array([signature(s, like.hashes) for s in sets]), keys[a:b][own], i, j, like)
                for x, y in links_of(sets, i[left], j[left], like):
                    a_side.append(vid[a + own[x]])
                    b_side.append(vid[a + own[y]])
            if a_side:
                yield pa.RecordBatch.from_arrays([pa.array(a_side, pa.binary()), pa.array(b_side, pa.binary())], ["a", "b"])

    rows = members.join(texts, "vid").select(*BLOCK, "side", "comp", "vid", "packed").repartition(*BLOCK).sortWithinPartitions(*BLOCK)
    return rows.mapInArrow(run, "a binary, b binary")


def _chunk(size: Column) -> Column:
    """One of ceil(size / CHUNK) chunks, by the member's digest."""
    return F.pmod(F.xxhash64("vid", "key"), F.ceil(size / F.lit(CHUNK))).cast("int")


def _second_round(buckets: DataFrame, comps: DataFrame) -> DataFrame:
    """Blocks of large buckets whose members are still in several components."""
    comps = comps.select(F.col("v").alias("vid"), "root")
    rows = written(buckets.where(F.col("m") > CHUNK).join(comps, "vid", "left")
                   .select("key", "vid", F.coalesce("root", "vid").alias("comp")), "large")
    per = rows.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n"))
    per = per.groupBy("key").agg(F.max(F.struct("n", "comp")).alias("main"), F.sum("n").alias("m"), F.count(F.lit(1)).alias("comps"))
    per = per.where("comps > 1").select("key", F.col("main.comp").alias("main"), F.col("main.n").alias("inside"),
                                        (F.col("m") - F.col("main.n")).alias("outside"))
    rows = rows.join(per, "key")
    out_chunks, in_chunks = (F.ceil(F.col(c) / F.lit(CHUNK)).cast("int") for c in ("outside", "inside"))
    to = lambda n: F.sequence(F.lit(0), n - 1)
    outside = rows.where("comp <> main").withColumn("c", _chunk(F.col("outside")))
    among = outside.withColumn("o", F.explode(to(out_chunks))).select(
        "key", F.concat_ws("-", F.lit("o"), F.least("c", "o"), F.greatest("c", "o")).alias("part"),
        (F.col("c") > F.col("o")).cast("int").alias("side"), "comp", "vid")
    across = outside.withColumn("o", F.explode(to(in_chunks))).select(
        "key", F.concat_ws("-", F.lit("i"), "c", "o").alias("part"), F.lit(0).alias("side"), "comp", "vid")
    inside = rows.where("comp = main").withColumn("c", _chunk(F.col("inside")))
    inside = inside.withColumn("o", F.explode(to(out_chunks))).select(
        "key", F.concat_ws("-", F.lit("i"), "o", "c").alias("part"), F.lit(1).alias("side"), "comp", "vid")
    return among.unionByName(across).unionByName(inside)


def near_components(df: DataFrame, text: str = "text", id_column: str = "doc_id", like: Similarity = STRICT,
                    mark: str | None = None) -> DataFrame:
    """Every row's doc_id, n_shingles, component_id and kept, after the binary column ``mark`` if there is one."""
    marks = [mark] if mark else []
    df = bounded_batches(df)
    rows = written(sketches(df, text, id_column, like, mark), "sketches")
    first = rows.where("vid is not null and doc_id is not null").groupBy("vid").agg(F.min("doc_id").alias("doc_id"))
    reps = written(rows.join(first, ["vid", "doc_id"]).dropDuplicates(["vid", "doc_id"])
                   .select("vid", "doc_id", "signature"), "classes")
    bands = _bands(reps, like)
    shared = bands.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    buckets = written(bands.join(shared, "key").select("key", "vid", "m"), "buckets")
    blocks = buckets.select("key", F.concat_ws("-", F.lit("r"), _chunk(F.col("m"))).alias("part"),
                            F.lit(0).alias("side"), F.col("vid").alias("comp"), "vid")
    members = written(candidates(blocks, reps, like), "candidates")
    # The texts move once: those that either round can ask for.
    large = buckets.where(F.col("m") > CHUNK).select("vid")
    needed = members.select("vid").unionByName(large).distinct().join(reps.select("vid", "doc_id"), "vid")
    texts = written(needed.join(packed_texts(df, text, id_column), "doc_id").select("vid", "packed"), "texts")
    found = written(confirmed(members, texts, like), "links")
    comps = components(found)
    if not large.isEmpty():
        members = written(candidates(_second_round(buckets, comps), reps, like), "candidates")
        comps = components(found.unionByName(written(confirmed(members, texts, like), "links")))
    comps = comps.select(F.col("v").alias("vid"), "root")
    classes = written(reps.select("vid", "doc_id").join(comps, "vid", "left")
                      .select("vid", "doc_id", F.coalesce("root", "vid").alias("root")), "roots")
    smallest = classes.groupBy("root").agg(F.min("doc_id").alias("smallest"))
    classes = classes.join(smallest, "root").select("vid", "smallest")
    out = rows.select(*marks, "doc_id", "n_shingles", "vid").join(classes, "vid", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("smallest")).otherwise(F.col("doc_id"))
    out = out.select(*marks, "doc_id", "n_shingles", component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))
