"""Operator 13: phrase collocations by set-oriented relational mining (SETM).

The occurrence relation R1 holds one entry (piece and position, word) per word, sorted, packed
by *chunk*: a few megabytes of one language's texts.  Each round merge-joins the sorted
relation of frequent k-word phrases with itself one position on, which gives the occurrences of
k + 1 words with the codes of their first and last k words.  The distinct keys of a chunk with
their counts are cut into slices by a hash of the key; the slices of a *bucket* come together,
are added up, and the groups below the least count are left out; codes of the frequent ones go
back to their chunks (the semi-join), where they make the next, again sorted and written,
relation.  Buckets are as many as the entries ask for.

All keys are exact: words are compared as strings, phrases as pairs of codes; hashes only deal
them to buckets.  Piece and position are folded into one *slot* number that leaves a gap
between pieces, so that adjacent words are those one slot apart.  Relations and slices are
compressed differences and byte planes, a few bytes per entry, and a task holds one chunk, or
the distinct keys and packed slices of one bucket (a key has at most one entry per chunk).

Defined cases: null texts are empty; a null language is ``und``; rows count as often as they
are there (ids don't matter, null or repeated); a language without frequent phrases has no
rows; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitwall.llm.common import Rolling, bounded_batches, flat_texts, mix64, union, written

#: What ends a piece, and what separates words within one.
PIECE_ENDS, BLANKS = b".,;:!?\x0a\x0b\x0c\x0d", b"\x20\x09"
#: Words of the longest phrase; the least count; rows of a language.
LONGEST, LEAST, TOP = 5, 100, 2000
#: Text bytes of a chunk (a longer text makes one of its own), and of all languages' chunks that a task has begun.
CHUNK_BYTES, HELD_BYTES = 4 << 20, 16 << 20
#: Entries of a bucket, about.
BUCKET = 1 << 20
#: Keys that are unpacked, sorted or looked up together, at least.
GATHERED = 1 << 17

_PIECE_END = np.zeros(256, bool)
_PIECE_END[list(PIECE_ENDS)] = True
_APART = _PIECE_END.copy()
_APART[list(BLANKS)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def occurrences(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Slots and words of some texts, in order; words of two pieces or texts are never one slot apart."""
    n = len(data)
    data = _LOWER[data]
    word = ~_APART[data]
    first = np.zeros(n + 1, bool)
    first[off] = True
    start = word.copy()
    start[1:] &= ~word[:-1] | first[1:n]
    at = np.flatnonzero(start)
    piece = np.cumsum(_PIECE_END[data] | first[:n], dtype=np.int32)
    slots = np.arange(len(at), dtype=np.int32) + piece[at]
    letters = data[word]
    ends = np.concatenate((np.cumsum(word, dtype=np.int32)[at] - 1, [len(letters)])).astype(np.int32)
    words = pa.StringArray.from_buffers(len(at), pa.py_buffer(ends.tobytes()), pa.py_buffer(letters.tobytes()))
    return slots, words


@cache
def _packer() -> zstandard.ZstdCompressor:
    """One for each process: slices are many and small."""
    return zstandard.ZstdCompressor(level=1)


@cache
def _unpacker() -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor()


def packed(x: np.ndarray, kind: str = "<i4") -> bytes:
    """Whole numbers as compressed byte planes."""
    width = np.dtype(kind).itemsize
    planes = np.ascontiguousarray(x.astype(kind)).view(np.uint8).reshape(-1, width).T
    return _packer().compress(np.ascontiguousarray(planes).tobytes())


def unpacked(data: bytes, kind: str = "<i4") -> np.ndarray:
    planes = np.frombuffer(_unpacker().decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each hash, ascending with it."""
    return (hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)


class Words:
    """Keys of the first relation: distinct words."""

    def __init__(self, words: pa.Array, lang: str) -> None:
        self.words, self.lang = words, lang

    def __len__(self) -> int:
        return len(self.words)

    def hashes(self) -> np.ndarray:
        data, off = flat_texts(self.words)
        return Rolling(data).of(off[:-1], off[1:])

    def order(self) -> np.ndarray:
        """Places by hash; a slice keeps the order that its chunk has."""
        return np.argsort(self.hashes(), kind="stable")

    def take(self, at: np.ndarray) -> Words:
        return Words(self.words.take(pa.array(at)), self.lang)

    def sliced(self, bucket: np.ndarray) -> np.ndarray:
        """Places by bucket, each bucket's keys as its slice has them."""
        return self.order()

    def payload(self) -> bytes:
        lang = self.lang.encode()
        # no word holds a line end
        words = "\n".join(self.words.to_pylist()).encode()
        return len(lang).to_bytes(4, "little") + lang + _packer().compress(words)

    @staticmethod
    def load(data: bytes) -> Words:
        cut = 4 + int.from_bytes(data[:4], "little")
        words = _unpacker().decompress(data[cut:]).decode().split("\n")
        return Words(pa.array(words, pa.string()), data[4:cut].decode())


class Pairs:
    """Keys of the other relations: codes of the first and the last words."""

    def __init__(self, first: np.ndarray, last: np.ndarray) -> None:
        self.first, self.last = first, last

    def __len__(self) -> int:
        return len(self.first)

    def hashes(self) -> np.ndarray:
        return mix64(self.first.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + self.last.view(np.uint64))

    def order(self) -> np.ndarray:
        """Places by hash, then key."""
        return np.lexsort((self.last, self.first, self.hashes()))

    def take(self, at: np.ndarray) -> Pairs:
        return Pairs(self.first[at], self.last[at])

    def sliced(self, bucket: np.ndarray) -> np.ndarray:
        """Places by bucket, then key: ascending keys are smaller."""
        return np.lexsort((self.last, self.first, bucket))

    def payload(self) -> bytes:
        first = packed(np.diff(self.first, prepend=0), "<i8")
        return len(first).to_bytes(4, "little") + first + packed(self.last, "<i8")

    @staticmethod
    def load(data: bytes) -> Pairs:
        cut = 4 + int.from_bytes(data[:4], "little")
        return Pairs(np.cumsum(unpacked(data[4:cut], "<i8")), unpacked(data[cut:], "<i8"))


RELATION = T.StructType([
    T.StructField("chunk", T.StringType()), T.StructField("place", T.IntegerType()), T.StructField("n", T.LongType()),
    T.StructField("words", T.LongType()), T.StructField("lang", T.StringType()), T.StructField("keys", T.BinaryType()),
    T.StructField("counts", T.BinaryType()), T.StructField("slots", T.BinaryType()), T.StructField("entries", T.BinaryType())])
_RELATION = pa.schema([("chunk", pa.string()), ("place", pa.int32()), ("n", pa.int64()), ("words", pa.int64()), ("lang", pa.string()),
                       ("keys", pa.binary()), ("counts", pa.binary()), ("slots", pa.binary()), ("entries", pa.binary())])


def _row(chunk: str, lang: str | None, keys: Words | Pairs, counts: np.ndarray, slots: np.ndarray, entries: np.ndarray) -> pa.RecordBatch:
    """One chunk of a relation, entries numbered by their keys' hashes; in front of what comes back from the buckets."""
    order = keys.order()
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(len(order))
    row = {"chunk": chunk, "place": -1, "n": len(keys), "words": len(slots), "lang": lang, "keys": keys.payload(),
           "counts": packed(counts), "slots": packed(np.diff(slots, prepend=0)), "entries": packed(rank[entries])}
    return pa.RecordBatch.from_pylist([row], _RELATION)


def chunks(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The whole occurrence relation: per chunk its distinct words, their counts, and slot and word of each occurrence."""

    def run(batches):
        held: dict[str, tuple[list[pa.Array], list[int]]] = {}

        def emit(name: str) -> Iterator[pa.RecordBatch]:
            slots, words = occurrences(*flat_texts(pa.concat_arrays(held.pop(name)[0])))
            if len(words):
                coded = words.dictionary_encode()
                index = coded.indices.to_numpy()
                yield _row(uuid.uuid4().hex, name, Words(coded.dictionary, name), np.bincount(index), slots, index)

        for batch in batches:
            kinds = batch.column(1).dictionary_encode()
            for k, name in enumerate(kinds.dictionary.to_pylist()):
                own = batch.column(0).filter(pa.array(kinds.indices.to_numpy() == k)).fill_null("")
                row = 0
                while row < len(own):
                    texts, sizes = held.setdefault(name, ([], []))
                    # rows up to about CHUNK_BYTES, one at least
                    reach = np.cumsum(np.diff(flat_texts(own.slice(row))[1]))
                    rows = min(max(1, int(np.searchsorted(reach, CHUNK_BYTES - sum(sizes), "right"))), len(own) - row)
                    texts.append(own.slice(row, rows))
                    sizes.append(int(reach[rows - 1]))
                    row += rows
                    if sum(sizes) >= CHUNK_BYTES or row < len(own):
                        yield from emit(name)
            while sum(sum(sizes) for _, sizes in held.values()) > HELD_BYTES:
                yield from emit(max(held, key=lambda x: sum(held[x][1])))
        for name in list(held):
            yield from emit(name)

    rows = bounded_batches(docs).select(F.col(text).cast("string").alias("text"),
                                        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"))
    return rows.mapInArrow(run, RELATION)


def _runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[list[dict]]:
    """The rows of each key, which come together."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and row[key] != held[0][key]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _slices(relation: DataFrame, kind: type, buckets: int) -> DataFrame:
    """The keys of each chunk, cut by bucket: (bucket, chunk, place of the first, keys, counts)."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                keys, counts = kind.load(row["keys"]), unpacked(row["counts"])
                bucket = bucket_of(keys.hashes(), buckets)
                order = keys.sliced(bucket)
                own, lead = np.unique(bucket[order], return_index=True)
                out = []
                for b, x, y in zip(own.tolist(), lead.tolist(), [*lead[1:].tolist(), len(keys)], strict=True):
                    at = order[x:y]
                    out.append({"bucket": b, "chunk": row["chunk"], "place": x, "keys": keys.take(at).payload(), "counts": packed(counts[at])})
                for i in range(0, len(out), 512):
                    yield pa.RecordBatch.from_pylist(out[i:i + 512], _SLICE)

    return relation.select("chunk", "keys", "counts").mapInArrow(run, "bucket int, chunk string, place int, keys binary, counts binary")


_SLICE = pa.schema([("bucket", pa.int32()), ("chunk", pa.string()), ("place", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])
FOUND = "chunk string, place int, keys binary, code long, f long, first long, last long, lang string, word string"
_FOUND = pa.schema([("chunk", pa.string()), ("place", pa.int32()), ("keys", pa.binary()), ("code", pa.int64()), ("f", pa.int64()),
                    ("first", pa.int64()), ("last", pa.int64()), ("lang", pa.string()), ("word", pa.string())])


def _added(rows: list[dict], kind: type, code: int, step: int, least: int) -> Iterator[pa.RecordBatch]:
    """Add up the slices of a bucket: the frequent groups, then per slice the codes of its keys in
    the order of its chunk (-1: not frequent)."""
    if kind is Words:
        # a blank is in no word, so that word and language stay apart
        joined_up = lambda parts: pa.concat_arrays([pa.compute.binary_join_element_wise(w.words, w.lang, " ") for w in parts])
        keys, counts = pa.array([], pa.string()), np.zeros(0, np.int64)
        for own, of in _gathered(rows, kind, lambda: len(counts)):
            coded = pa.concat_arrays([keys, joined_up(own)]).dictionary_encode()
            total = np.concatenate([counts, *[unpacked(r["counts"]) for r in of]]).astype(np.int64)
            keys, counts = coded.dictionary, np.bincount(coded.indices.to_numpy(), total).astype(np.int64)
        kept = np.flatnonzero(counts >= least)
        keys = keys.take(pa.array(kept))
        names = [k.split(" ", 1) for k in keys.to_pylist()]
        parts = {"word": [w for w, _ in names], "lang": [x for _, x in names]}

        def place(own):
            return pa.compute.index_in(joined_up(own), keys).fill_null(-1).to_numpy(zero_copy_only=False)
    else:
        pairs, counts = np.zeros((0, 2), np.int64), np.zeros(0, np.int64)
        for own, of in _gathered(rows, kind, lambda: len(counts)):
            first, last = (np.concatenate([pairs[:, i], *[getattr(p, n) for p in own]]) for i, n in ((0, "first"), (1, "last")))
            total = np.concatenate([counts, *[unpacked(r["counts"]) for r in of]])
            order = np.lexsort((last, first))
            first, last = first[order], last[order]
            lead = np.flatnonzero(_changes(first, last))
            pairs, counts = np.column_stack((first[lead], last[lead])), np.add.reduceat(total[order], lead).astype(np.int64)
        kept = np.flatnonzero(counts >= least)
        pairs = pairs[kept]
        parts = {"first": pairs[:, 0], "last": pairs[:, 1]}

        def place(own):
            mine = Pairs(*(np.concatenate([getattr(p, n) for p in own]) for n in ("first", "last")))
            # both sides are sorted together: a key's place is that of the group it falls in
            first, last = np.concatenate((pairs[:, 0], mine.first)), np.concatenate((pairs[:, 1], mine.last))
            side = np.repeat((0, 1), (len(pairs), len(mine)))
            order = np.lexsort((side, last, first))
            group = np.cumsum(_changes(first[order], last[order])) - 1
            known = np.full(int(group[-1]) + 1 if len(group) else 0, -1, np.int64)
            at = order < len(pairs)
            known[group[at]] = order[at]
            out = np.empty(len(mine), np.int64)
            out[order[~at] - len(pairs)] = known[group[~at]]
            # each slice in the order of its chunk
            return out[np.lexsort((mine.last, mine.first, mine.hashes(), np.repeat(np.arange(len(own)), list(map(len, own)))))]

    n = len(kept)
    if not n:
        return
    codes = code + step * np.arange(n, dtype=np.int64)
    empty = {name: pa.nulls(n, _FOUND.field(name).type) for name in _FOUND.names}
    cells = empty | {"code": pa.array(codes), "f": pa.array(counts[kept])} | {k: pa.array(v, _FOUND.field(k).type) for k, v in parts.items()}
    whole = pa.RecordBatch.from_arrays([cells[name] for name in _FOUND.names], schema=_FOUND)
    for i in range(0, n, 1 << 16):
        yield whole.slice(i, 1 << 16)
    for own, of in _gathered(rows, kind, lambda: n):
        at = place(own)
        found = np.where(at >= 0, codes[np.maximum(at, 0)], -1)
        back = [{"chunk": row["chunk"], "place": row["place"], "keys": packed(part, "<i8")}
                for row, part in zip(of, np.split(found, np.cumsum(list(map(len, own)))[:-1]), strict=True) if (part >= 0).any()]
        for i in range(0, len(back), 512):
            yield pa.RecordBatch.from_pylist(back[i:i + 512], _FOUND)


def _changes(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    fresh = np.ones(len(first), bool)
    fresh[1:] = (first[1:] != first[:-1]) | (last[1:] != last[:-1])
    return fresh


def _gathered(rows: list[dict], kind: type, held: Callable[[], int]) -> Iterator[tuple[list[Words | Pairs], list[dict]]]:
    """Slices unpacked some at a time, with their rows: as many keys as ``held()`` at that point (GATHERED
    at least), so that what is held is gone through again only as often as it doubles, however small
    the slices are, and no more is unpacked than that."""
    own, of, n = [], [], 0
    for row in rows:
        own.append(kind.load(row["keys"]))
        of.append(row)
        n += len(own[-1])
        if n >= max(GATHERED, held()):
            yield own, of
            own, of, n = [], [], 0
    if own:
        yield own, of


def _groups(relation: DataFrame, kind: type, least: int, name: str) -> DataFrame:
    """The frequent groups (code, f, first and last or lang and word; chunk null), and what goes
    back to the chunks (chunk, place, codes as ``keys``)."""
    total = relation.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    buckets = min(1 + total // BUCKET, (1 << 31) - 1)

    def run(batches):
        for rows in _runs(batches, "bucket"):
            yield from _added(rows, kind, rows[0]["bucket"], buckets, least)

    slices = _slices(relation, kind, buckets).repartition("bucket").sortWithinPartitions("bucket")
    return written(slices.mapInArrow(run, FOUND), name)


def joined(slots: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merge-join of a sorted relation with itself one slot on: slots, first and last codes of the longer phrases."""
    at = np.flatnonzero(slots[1:] - slots[:-1] == 1)
    return slots[at], codes[at], codes[at + 1]


def _extended(relation: DataFrame, found: DataFrame) -> DataFrame:
    """Semi-join a relation with its frequent groups and extend what is left by one word."""

    def run(batches):
        for rows in _runs(batches, "chunk"):
            own = rows[0]
            code = np.full(own["n"], -1, np.int64)
            for row in rows[1:]:
                codes = unpacked(row["back"], "<i8")
                code[row["place"]:row["place"] + len(codes)] = codes
            codes = code[unpacked(own["entries"])]
            kept = codes >= 0
            slots, first, last = joined(np.cumsum(unpacked(own["slots"]))[kept], codes[kept])
            if len(slots):
                order = np.lexsort((last, first))
                f, l = first[order], last[order]
                fresh = _changes(f, l)
                at = np.flatnonzero(fresh)
                entries = np.empty(len(f), np.int32)
                entries[order] = np.cumsum(fresh) - 1
                yield _row(own["chunk"], None, Pairs(f[at], l[at]), np.diff(np.append(at, len(f))), slots, entries)

    back = found.filter("chunk is not null").select("chunk", "place", F.col("keys").alias("back"))
    rows = relation.select("chunk", "place", "n", "slots", "entries").unionByName(back, allowMissingColumns=True)
    return rows.repartition("chunk").sortWithinPartitions("chunk", "place").mapInArrow(run, RELATION)


def mine(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, text: str = "text", lang: str = "lang") -> DataFrame:
    """Frequent phrases of 2 to ``longest`` words: lang, size, phrase, a, lefts, rights, n.

    ``lefts`` are the counts of the first 1, 2, ... words, ``rights`` those of what follows
    them; ``whole`` tells whether no phrase one word longer has the same count.
    """
    relation = written(chunks(docs, text, lang), "occurrences")
    totals = relation.groupBy("lang").agg(F.sum("words").alias("n"))
    found = _groups(relation, Words, least, "words")
    shorter = found.filter("chunk is null").select(
        "code", "lang", "f", F.col("word").alias("phrase"), F.col("word").alias("tail"),
        F.array().cast("array<long>").alias("lefts"), F.array().cast("array<long>").alias("rights"))
    sizes = []
    for size in range(2, longest + 1):
        relation = written(_extended(relation, found), f"occurrences-{size}")
        found = _groups(relation, Pairs, least, f"groups-{size}")
        one = lambda side: shorter.select(*[F.col(c).alias(f"{side}_{c}") for c in shorter.columns])
        longer = found.filter("chunk is null").select("code", "f", "first", "last")
        longer = longer.join(one("a"), F.col("first") == F.col("a_code")).join(one("b"), F.col("last") == F.col("b_code"))
        longer = written(longer.select(
            "code", "first", "last", F.col("a_lang").alias("lang"), "f",
            F.concat_ws(" ", "a_phrase", "b_tail").alias("phrase"), F.col("b_tail").alias("tail"),
            F.concat("a_lefts", F.array("a_f")).alias("lefts"), F.concat(F.array("b_f"), "b_rights").alias("rights")), f"phrases-{size}")
        if sizes:
            # a phrase inside a longer one of its count is inside one that is one word longer
            inside = union([longer.select(F.col(c).alias("code"), F.col("f").alias("longer")) for c in ("first", "last")])
            inside = inside.groupBy("code").agg(F.max("longer").alias("longer"))
            sizes[-1] = sizes[-1].join(inside, "code", "left").withColumn("whole", F.coalesce(F.col("longer") < F.col("f"), F.lit(True))).drop("longer")
        sizes.append(longer.drop("first", "last").withColumn("size", F.lit(size)))
        shorter = longer.drop("first", "last")
    sizes[-1] = sizes[-1].withColumn("whole", F.lit(True))
    return union(sizes).join(totals, "lang").select("lang", "size", "phrase", F.col("f").alias("a"), "lefts", "rights", "n", "whole")


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, top: int | None = TOP, text: str = "text",
                 lang: str = "lang") -> DataFrame:
    """Each language's phrases by score: lang, rank, phrase, a, l, r, n, score (``top`` None: all of them).

    The score of a cut is floor(1000 a n / (l r)) in exact decimal arithmetic; the lowest cut
    counts, ties to the earliest.
    """
    whole = lambda c: F.col(c).cast("decimal(19,0)") if isinstance(c, str) else c.cast("decimal(19,0)")
    found = mine(docs, longest, least, text, lang).filter("whole")
    top_part = (F.lit(1000).cast("decimal(4,0)") * whole("a") * whole("n")).cast("decimal(38,0)")
    found = found.withColumn("numerator", top_part)
    found = found.select("lang", "phrase", "a", "n", "numerator", F.posexplode(F.arrays_zip("lefts", "rights")).alias("k", "cut"))
    found = found.select("*", F.col("cut.lefts").alias("l"), F.col("cut.rights").alias("r"))
    found = found.withColumn("product", (whole("l") * whole("r")).cast("decimal(38,0)")).withColumn("score", F.expr("numerator div product"))
    best = found.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "a", "n")).alias("b")).select("lang", "phrase", "b.*")
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    ranked = best.withColumn("rank", F.row_number().over(order))
    if top is not None:
        ranked = ranked.filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
