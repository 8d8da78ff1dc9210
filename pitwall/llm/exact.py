"""Operator 6: exact deduplication against a minimal perfect hash of historical digests.

* ``text_digests`` gives each row the SHA-256 of its text with every run of white
  space replaced by one space.  Only digests travel; texts never shuffle.
* ``build_index`` spreads the distinct historical digests over buckets and builds,
  per bucket, a minimal perfect hash: a cascade of bit arrays in which a key owns
  the first position that no other key shares; its slot is the rank of that bit.
  Slots hold the full digest, the winner's locator (smallest id) and the copies.
* ``resolve`` looks up pre-aggregated incoming digests bucket by bucket.  A hit
  counts only if all 32 bytes of the slot's digest agree; nonmembers form groups
  of their own.

Defined cases: null text counts as empty; among equal texts the smallest non-null
id stays; a group of null ids alone keeps a null id; of rows that repeat the id that
stays, one stays.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwall.llm.common import mix64, written

#: Digests per bucket, on average: bounds what one task holds of the index.
BUCKET_DIGESTS = 4_000
#: Levels of the cascade; keys that still clash beyond them are searched in a sorted tail.
LEVELS = 24

INDEX = ("bucket int, levels array<int>, bits binary, digests binary, winners binary, "
         "has_winner binary, copies binary")
RESOLVED = "digest binary, winner long, copies long, member boolean"


def text_digests(df: DataFrame, text: str = "text", digest: str = "digest") -> DataFrame:
    """Add the 32-byte digest of the white-space-normalised text."""
    plain = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+", " ")
    return df.withColumn(digest, F.unhex(F.sha2(plain.cast("binary"), 256)))


# ---------------------------------------------------------------- the hash

def _positions(words: np.ndarray, level: int, size: int) -> np.ndarray:
    seed = np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1))
    return (mix64(words[:, 0] ^ seed) + mix64(words[:, 1] + seed)) % np.uint64(size)


def _rows(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), np.uint8).reshape(-1, 32)


class PerfectHash:
    """A minimal perfect hash of n distinct digests onto slots 0..n-1."""

    def __init__(self, sizes: list[int], bits: np.ndarray, tail: np.ndarray) -> None:
        self.sizes, self.bits, self.tail = sizes, bits, tail
        self.rank = np.concatenate(([0], np.cumsum(bits)))

    @classmethod
    def build(cls, digests: np.ndarray) -> PerfectHash:
        words = np.ascontiguousarray(digests).view(np.uint64)
        left, sizes, parts = np.arange(len(words)), [], []
        while len(left) and len(sizes) < LEVELS:
            size = len(left) * 3 // 2 + 1
            at = _positions(words[left], len(sizes), size).astype(np.int64)
            once = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            parts.append(once)
            left = left[~once[at]]
        return cls(sizes, np.concatenate(parts) if parts else np.zeros(0, bool), digests[left])

    def slots(self, digests: np.ndarray) -> np.ndarray:
        """The slot of each digest; of a digest that is no key, some slot or -1."""
        words = np.ascontiguousarray(digests).view(np.uint64)
        out = np.full(len(words), -1, np.int64)
        left, base = np.arange(len(words)), 0
        for level, size in enumerate(self.sizes):
            at = _positions(words[left], level, size).astype(np.int64) + base
            hit = self.bits[at]
            out[left[hit]] = self.rank[at[hit]]
            left, base = left[~hit], base + size
        if len(self.tail) and len(left):
            place = {t.tobytes(): i for i, t in enumerate(self.tail)}
            out[left] = [self.rank[-1] + place[d] if (d := digests[i].tobytes()) in place else -1 for i in left]
        return out


def build_index(history: DataFrame, buckets: int) -> DataFrame:
    """Index rows from distinct (digest, winner, copies); one row per bucket."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        digests = _rows(rows["digest"].tolist())
        ph = PerfectHash.build(digests)
        slot = ph.slots(digests)
        order = np.argsort(slot)
        winner = rows["winner"]
        return pd.DataFrame([{
            "bucket": int(rows["bucket"].iloc[0]), "levels": ph.sizes, "bits": np.packbits(ph.bits).tobytes(),
            "digests": digests[order].tobytes(),
            "winners": winner.fillna(0).to_numpy(np.int64)[order].tobytes(),
            "has_winner": winner.notna().to_numpy()[order].astype(np.uint8).tobytes(),
            "copies": rows["copies"].to_numpy(np.int64)[order].tobytes()}])

    return (_dealt(history, buckets).withColumn("winner", F.col("winner").cast("long"))
            .groupBy("bucket").applyInPandas(run, INDEX))


def _dealt(df: DataFrame, buckets: int) -> DataFrame:
    return df.withColumn("bucket", F.pmod(F.xxhash64("digest"), F.lit(buckets)).cast("int"))


def _lookup(index: pd.DataFrame, incoming: pd.DataFrame) -> pd.DataFrame:
    """All distinct digests of one bucket: slots with the incoming copies added, then nonmembers."""
    asked = _rows(incoming["digest"].tolist()) if len(incoming) else np.zeros((0, 32), np.uint8)
    count = incoming["copies"].to_numpy(np.int64)
    if not len(index):
        return incoming[["digest", "winner", "copies"]].assign(member=False)
    row = index.iloc[0]
    stored = np.frombuffer(row["digests"], np.uint8).reshape(-1, 32)
    sizes = [int(x) for x in row["levels"]]
    bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=sum(sizes)).astype(bool)
    ph = PerfectHash(sizes, bits, stored[int(bits.sum()):])
    slot = ph.slots(asked)
    member = slot >= 0
    member[member] = (stored[slot[member]] == asked[member]).all(axis=1)  # the byte check
    copies = np.frombuffer(row["copies"], np.int64).copy()
    np.add.at(copies, slot[member], count[member])
    winner = pd.array(np.frombuffer(row["winners"], np.int64), dtype="Int64")
    winner[np.frombuffer(row["has_winner"], np.uint8) == 0] = pd.NA
    known = pd.DataFrame({"digest": [d.tobytes() for d in stored], "winner": winner, "copies": copies, "member": True})
    rest = incoming.loc[~member, ["digest", "winner", "copies"]].assign(member=False)
    rest["winner"] = rest["winner"].astype("Int64")
    return pd.concat([known, rest], ignore_index=True)


def resolve(incoming: DataFrame, index: DataFrame, buckets: int) -> DataFrame:
    """For every distinct digest: the row that stays, the copies, whether history had it."""
    asked = _dealt(incoming.withColumn("winner", F.col("winner").cast("long")), buckets)
    return index.groupBy("bucket").cogroup(asked.groupBy("bucket")).applyInPandas(_lookup, RESOLVED)


def dedup(df: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """Every row of ``df`` (columns: id, digest) with keep_id, group_size and kept.

    The earlier half of the id range is the history that is indexed; the later half
    arrives and is looked up.  A history winner is thus also the smallest id of its group.
    """
    rows = written(text_digests(df.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text")))
                   .select("doc_id", "digest", F.monotonically_increasing_id().alias("row")), "digests")
    low, high, total = rows.agg(F.min("doc_id"), F.max("doc_id"), F.count(F.lit(1))).first()
    old = F.coalesce(F.col("doc_id") <= F.lit(0 if low is None else (low + high) // 2), F.lit(False))
    per = written(rows.groupBy("digest").agg(
        F.min(F.when(old, F.col("doc_id"))).alias("old_id"), F.sum(old.cast("long")).alias("old_copies"),
        F.min(F.when(~old, F.col("doc_id"))).alias("new_id"), F.sum((~old).cast("long")).alias("new_copies"),
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row"))["row"].alias("stays")), "groups")
    buckets = max(1, -(-total // BUCKET_DIGESTS))
    history = per.where("old_copies > 0").selectExpr("digest", "old_id as winner", "old_copies as copies")
    incoming = per.where("new_copies > 0").selectExpr("digest", "new_id as winner", "new_copies as copies")
    found = resolve(incoming, written(build_index(history, buckets), "index"), buckets)
    # one join for the rows, so that a large group of copies can be split
    found = written(found.join(per.select("digest", "stays"), "digest"), "found")
    return rows.join(found, "digest").select(
        "doc_id", F.col("winner").alias("keep_id"), F.col("copies").alias("group_size"),
        (F.col("row") == F.col("stays")).alias("kept"), "digest", "member")

