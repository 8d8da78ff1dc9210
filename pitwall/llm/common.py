"""Helpers shared by the operators: written intermediates and Arrow text blocks.

Text columns reach Python as Arrow batches; the helpers below view them as one
byte array plus offsets, so that word splitting and hashing are numpy passes
over whole blocks instead of Python loops over words.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall.session import ensure_checkpoint_dir

#: Bytes of text that one numpy pass works on (a longer text is a block of its own).
BLOCK_BYTES = 1 << 20

#: Bytes of an Arrow batch, about.
BATCH_BYTES = 8 << 20

#: The white space of the word contracts.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"

_SPACE = np.zeros(256, bool)
_SPACE[list(SPACES)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_RNG = np.random.default_rng(20240607)
_BYTE_VALUE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C13  # odd, so that powers have inverses modulo 2^64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, read through Spark only."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared checkpoint folder, scheme kept."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/pitwall-llm/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` as Parquet in the shared folder and read it back."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_batches(df: DataFrame) -> DataFrame:
    """Limit the bytes of the Arrow batches that tasks exchange with Python (a session setting).

    The default goes by rows, so that long texts make large batches.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df


def union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def is_in_fold(column: str, folds: int, fold: int):
    """Whether crc32 of an id's decimal text falls in ``fold``; a null id falls in none."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % folds == fold, F.lit(False))


# ---------------------------------------------------------------- Arrow texts

def flat_texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string column as (bytes, offsets); null texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)
    off = off[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def text_blocks(data: np.ndarray, off: np.ndarray,
                limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut (bytes, offsets) into runs of whole texts of about ``limit`` bytes."""
    row, n = 0, len(off) - 1
    while row < n:
        end = max(row + 1, int(np.searchsorted(off, off[row] + limit, "right")) - 1)
        end = min(end, n)
        yield row, end, data[off[row]:off[end]], off[row:end + 1] - off[row]
        row = end


# ---------------------------------------------------------------- hashing

def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift and multiply), element by element."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of the hash base and of its inverse modulo 2^64, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up, self.down


_POWERS = _Powers()


class Rolling:
    """Hashes of any substrings of a byte array, by prefix sums modulo 2^64."""

    def __init__(self, data: np.ndarray) -> None:
        up, self.down = _POWERS.to(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE_VALUE[data] * up[:len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((self.sums[end] - self.sums[start]) * self.down[start])

    def windows(self, size: int) -> np.ndarray:
        """Hashes of all substrings of ``size`` bytes, by start."""
        n = len(self.sums) - size
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix64((self.sums[size:] - self.sums[:n]) * self.down[:n])


class Words:
    """Words of a block of texts: text index, byte span and 64-bit hash of each.

    A-Z is lower-cased and a word is a run without the six white-space bytes;
    no word crosses a text boundary.
    """

    def __init__(self, data: np.ndarray, off: np.ndarray) -> None:
        self.data = _LOWER[data]
        n = len(data)
        first = np.zeros(n + 1, bool)
        first[off] = True
        space = _SPACE[data]
        word = ~space
        start = word.copy()
        start[1:] &= space[:-1] | first[1:n]
        end = word.copy()
        end[:-1] &= space[1:] | first[1:n]
        self.start = np.flatnonzero(start)
        self.end = np.flatnonzero(end) + 1
        self.text = np.searchsorted(off, self.start, "right") - 1
        self.hash = Rolling(self.data).of(self.start, self.end)
        self.counts = np.bincount(self.text, minlength=len(off) - 1)
        #: Words of text i are [first[i], first[i + 1]).
        self.first = np.concatenate(([0], np.cumsum(self.counts)))
