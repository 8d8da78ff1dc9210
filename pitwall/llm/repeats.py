"""Operator 10: removal of long repeated byte strings with run-length compressed indexes.

A byte goes if it lies in a string of ``LENGTH`` bytes that also starts anywhere else, in the
same text or another.

1. *Anchors.*  In every window of ``LENGTH`` bytes the ``GRAM``-byte string with the smallest
   hash is its anchor; equal windows have equal anchors, so two equal strings meet at an
   equal anchor.  An anchor's context is all that a window with this anchor can reach.
   Copies of a whole text count once here (told by a 64-bit digest and length).
2. *Equal contexts.*  Occurrences are dealt by anchor.  A context that occurs twice is
   repeated as a whole; of each distinct context one occurrence goes on, and only
   where an anchor has several distinct contexts.
3. *Run-length index.*  The contexts of an anchor are indexed together: suffixes are sorted,
   the Burrows-Wheeler transform is cut into runs, and text positions are sampled at both ends
   of every run only.  At a sample the match with the neighbouring suffix is measured; all
   other matching statistics follow by streaming over the text, as they fall by one from
   byte to byte within a run.  Positions whose longest match reaches ``LENGTH`` are marked.
4. *Very frequent anchors* with more than ``WIDE`` distinct contexts don't fit one task: their windows
   are counted by fingerprint with a distributed aggregation instead, without any limit.

Defined cases: null text is empty; texts below ``LENGTH`` bytes keep all; repeated rows are copies of each
other, whatever their ids; null ids pass through.  Hashes have 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwall.llm.common import Rolling, bounded_batches, flat_texts, mix64, text_blocks, written

LENGTH, GRAM = 200, 64
REACH = LENGTH - GRAM
#: Distinct contexts of an anchor that one task indexes, and bytes of contexts in one index.
WIDE, INDEX_BYTES = 20_000, 1_000_000

#: What a row of the anchor exchange is: an occurrence, a span that is already known, or the
#: representative of a context that its batch holds several times.
OCCURRENCE, SPAN, SEVERAL = 0, 1, 2


def place_of(start: np.ndarray, left: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Start, offset of the anchor and size of a context in one number."""
    return (start << 20) | (left << 10) | size


def span_of(place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    start = place >> 20
    return start, start + (place & 1023)


def text_ids(data: np.ndarray, off: np.ndarray, rolling: Rolling) -> np.ndarray:
    return mix64(rolling.of(off[:-1], off[1:]) ^ mix64(np.diff(off).astype(np.uint64))).view(np.int64)


def anchors(data: np.ndarray, off: np.ndarray, rolling: Rolling) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all anchors of a block of texts and their hashes, by position.

    Of the anchors with one hash in a row, the first and the last of each stretch of half a window are
    kept: a window that holds any of them still holds a kept one.
    """
    hashes = rolling.windows(GRAM)
    span = REACH + 1
    if len(data) < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    bits = np.uint64(max(20, int(len(data)).bit_length()))
    low = ((hashes >> bits) << bits) | np.arange(len(hashes), dtype=np.uint64)
    step = 1
    while step * 2 <= span:
        low = np.minimum(low[:-step], low[step:])
        step *= 2
    if step < span:
        low = np.minimum(low[:len(low) - (span - step)], low[span - step:])
    at = (low & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    inside = np.arange(len(at)) + LENGTH <= np.repeat(off[1:], np.diff(off))[:len(at)]
    at = at[inside]
    at = at[np.concatenate(([True], at[1:] != at[:-1]))] if len(at) else at
    if not len(at):
        return at, np.zeros(0, np.uint64)
    h = hashes[at]
    text = np.searchsorted(off, at, "right")
    run = np.cumsum(np.concatenate(([True], (h[1:] != h[:-1]) | (text[1:] != text[:-1]))))
    head = at[np.searchsorted(run, run)]
    stretch = run * (len(data) + 1) + (at - head) // (span // 2)
    first = np.concatenate(([True], stretch[1:] != stretch[:-1]))
    keep = first | np.concatenate((first[1:], [True]))
    return at[keep], h[keep]


ANCHOR = "h long, ctx long, tid long, place long, kind int"


def occurrences(texts: DataFrame) -> DataFrame:
    """Anchor rows of all distinct texts of each batch (one text column)."""

    def block(data, off, seen):
        rolling = Rolling(data)
        tid = text_ids(data, off, rolling)
        at, h = anchors(data, off, rolling)
        text = np.searchsorted(off, at, "right") - 1
        fresh = np.array([t not in seen and not seen.add(t) for t in tid.tolist()], bool)
        keep = fresh[text]
        at, h, text = at[keep], h[keep], text[keep]
        start, end = np.maximum(at - REACH, off[text]), np.minimum(at + GRAM + REACH, off[text + 1])
        place = place_of(start - off[text], at - start, end - start)
        ctx = mix64(rolling.of(start, end) ^ mix64((place & ((1 << 20) - 1)).astype(np.uint64)))
        return h, ctx, tid[text], place

    def run(batches):
        for batch in batches:
            data, off = flat_texts(batch.column(0))
            seen: set[int] = set()
            parts = [block(part, cuts, seen) for _, _, part, cuts in text_blocks(data, off)]
            if not parts:
                continue
            h, ctx, tid, place = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.lexsort((ctx, h))
            h, ctx, tid, place = h[order].view(np.int64), ctx[order].view(np.int64), tid[order], place[order]
            first = np.concatenate(([True], (h[1:] != h[:-1]) | (ctx[1:] != ctx[:-1]))) if len(h) else np.zeros(0, bool)
            group = np.cumsum(first) - 1
            several = np.bincount(group)[group] > 1 if len(h) else first
            kind = np.where(several, np.where(first, SEVERAL, SPAN), OCCURRENCE).astype(np.int32)
            # Known spans go to any task; they only pass through.
            h = np.where(kind == SPAN, mix64((tid ^ place).view(np.uint64)).view(np.int64), h)
            for a in range(0, len(h), 100_000):
                b = a + 100_000
                yield pa.RecordBatch.from_arrays([pa.array(x[a:b]) for x in (h, ctx, tid, place, kind)],
                                                 [f.split()[0] for f in ANCHOR.split(", ")])

    return texts.mapInArrow(run, ANCHOR)


def whole_groups(batches: Iterable[pa.RecordBatch], column: int = 0) -> Iterator[pa.Table]:
    """Tables of whole groups from batches that are sorted by a column of whole numbers."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column(column).to_numpy()
        if held and held[-1].column(column)[-1].as_py() != key[0]:
            yield pa.Table.from_batches(held)
            held = []
        last = int(np.searchsorted(key, key[-1]))
        if last:
            yield pa.Table.from_batches([*held, batch.slice(0, last)])
            held = []
        held.append(batch.slice(last))
    if held:
        yield pa.Table.from_batches(held)


def sorted_out(rows: DataFrame) -> DataFrame:
    """(kind, h, tid, place): spans that are known to repeat, and contexts that need an index."""

    def run(batches):
        for table in whole_groups(batches):
            h, ctx, tid, place, kind = (c.to_numpy() for c in table.columns)
            span = kind == SPAN
            out_tid, out_place = [tid[span]], [place[span]]
            h, ctx, tid, place, kind = (x[~span] for x in (h, ctx, tid, place, kind))
            new_ctx = np.ones(len(h), bool)
            new_ctx[1:] = (h[1:] != h[:-1]) | (ctx[1:] != ctx[:-1])
            fresh = new_ctx.copy()  # copies of one text, met in different batches, are one occurrence
            fresh[1:] |= (tid[1:] != tid[:-1]) | (place[1:] != place[:-1])
            group = np.cumsum(new_ctx) - 1
            count = np.bincount(group, fresh)
            count += np.bincount(group, kind == SEVERAL)
            repeated = count[group] > 1 if len(h) else new_ctx
            out_tid.append(tid[repeated & fresh])
            out_place.append(place[repeated & fresh])
            h_group = np.cumsum(np.concatenate(([True], h[1:] != h[:-1]))) - 1 if len(h) else group
            several = np.bincount(h_group, new_ctx)[h_group] > 1 if len(h) else new_ctx
            ask = several & new_ctx
            t, p = np.concatenate(out_tid), np.concatenate(out_place)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate((np.full(len(t), SPAN), np.full(int(ask.sum()), OCCURRENCE))), pa.int32()),
                pa.array(np.concatenate((np.zeros(len(t), np.int64), h[ask]))),
                pa.array(np.concatenate((t, tid[ask]))), pa.array(np.concatenate((p, place[ask])))],
                ["kind", "h", "tid", "place"])

    dealt = rows.repartition("h").sortWithinPartitions("h", "ctx", "tid", "place")
    return dealt.mapInArrow(run, "kind int, h long, tid long, place long")


# ---------------------------------------------------------------- the index

class RunLengthIndex:
    """A run-length compressed Burrows-Wheeler transform of several strings with groups.

    Strings match only within their group.  ``heads`` are the positions in suffix order at which a run of
    the transform starts; ``samples`` are the text positions at both sides of each run boundary.
    """

    def __init__(self, symbols: np.ndarray, off: np.ndarray, groups: np.ndarray) -> None:
        n = len(symbols)
        size = np.diff(off)
        self.left = np.repeat(off[1:], size) - np.arange(n)  # symbols up to the string's end
        code = np.zeros(256, np.int64)
        used = np.unique(symbols)
        code[used] = np.arange(1, len(used) + 1)
        self.code = code[symbols]
        #: Ranks of the substrings of each depth, deeper and deeper until suffixes are in order.
        self.levels: list[tuple[int, np.ndarray]] = []
        width = max(1, int(len(used)).bit_length())
        group = np.repeat(groups, size)
        depth = max(1, (62 - int(groups.max(initial=0) + 1).bit_length()) // width)
        key = group.astype(np.int64)
        for j in range(depth):
            key = (key << width) | self._ahead(self.code, j)
        longest = int(size.max(initial=0))
        rank = self._ranks(key)
        self.levels.append((depth, rank))
        while depth < longest:
            bits = int(n + 1).bit_length()
            times = max(2, min(3, 62 // bits))
            times = min(times, -(-longest // depth))
            key = rank
            for j in range(1, times):
                key = (key << bits) | self._ahead(rank, j * depth)
            rank, depth = self._ranks(key), depth * times
            self.levels.append((depth, rank))
        self.order = np.argsort(rank, kind="stable")
        before = np.zeros(n, np.int64)
        before[1:] = self.code[:-1]
        before[off[:-1][size > 0]] = 0  # a string's first symbol follows its end mark
        transform = before[self.order]
        # End marks are all different, so each makes a run of its own.
        change = (transform[1:] != transform[:-1]) | (transform[1:] == 0)
        self.heads = np.flatnonzero(change) + 1
        self.group = group

    def _ahead(self, values: np.ndarray, by: int) -> np.ndarray:
        """The value ``by`` symbols ahead, 0 beyond the string's end."""
        if not by:
            return values
        out = np.zeros(len(values), np.int64)
        out[:-by] = values[by:]
        out[self.left <= by] = 0
        return out

    @staticmethod
    def _ranks(key: np.ndarray) -> np.ndarray:
        order = np.argsort(key)
        k = key[order]
        rank = np.empty(len(key), np.int64)
        rank[order] = np.cumsum(np.concatenate(([True], k[1:] != k[:-1]))) if len(k) else 0
        return rank

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Lengths of the common prefixes of the suffixes at i and j (0 across groups)."""
        most = np.where(self.group[i] == self.group[j], np.minimum(self.left[i], self.left[j]), 0)
        got = np.zeros(len(i), np.int64)
        n = len(self.code)
        steps = [(d, r, 2 if k else 1) for k, (d, r) in enumerate(reversed(self.levels))]
        for depth, rank, times in [*steps, (1, self.code, self.levels[0][0] - 1)]:
            live = np.arange(len(i))
            for _ in range(times):
                live = live[got[live] + depth <= most[live]]
                if not len(live):
                    break
                a, b = i[live] + got[live], j[live] + got[live]
                live = live[rank[np.minimum(a, n - 1)] == rank[np.minimum(b, n - 1)]]
                got[live] += depth
        return got

    def matches(self) -> np.ndarray:
        """At every position the longest match with another suffix of its group.

        Measured at the run boundaries, then streamed: behind a sample the match with the
        same neighbour falls by one a byte.
        """
        n = len(self.code)
        above, below = self.order[self.heads - 1], self.order[self.heads]
        size = self.common(above, below)
        reach = np.zeros(n, np.int64)  # position plus match length
        for at in (above, below):
            np.maximum.at(reach, at, at + size)
        return np.maximum(np.maximum.accumulate(reach) - np.arange(n), 0)


def index_matches(texts: list[np.ndarray], groups: np.ndarray) -> list[np.ndarray]:
    """Starts of the strings of LENGTH bytes of each text that another place of its group has too."""
    off = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    index = RunLengthIndex(np.concatenate(texts), off, groups)
    hit = np.flatnonzero(np.minimum(index.matches(), index.left) >= LENGTH)
    cuts = np.searchsorted(hit, off)
    return [hit[a:b] - s for a, b, s in zip(cuts[:-1], cuts[1:], off[:-1], strict=True)]


def indexed(contexts: DataFrame) -> DataFrame:
    """(tid, start, stop) of the repeated strings, from (h, tid, start, bytes) rows."""

    def solve(rows: list[tuple[int, int, int, bytes]]):
        """Rows sorted by anchor, text and start; overlapping contexts of a text become one string."""
        merged: list[list] = []
        for h, tid, start, raw in rows:
            last = merged[-1] if merged else None
            if last and last[0] == h and last[1] == tid and start <= last[2] + len(last[3]):
                last[3] += raw[max(0, last[2] + len(last[3]) - start):]
            else:
                merged.append([h, tid, start, raw])
        h = np.array([m[0] for m in merged])
        groups = np.cumsum(np.concatenate(([False], h[1:] != h[:-1])))
        found = index_matches([np.frombuffer(m[3], np.uint8) for m in merged], groups)
        tids, starts, stops = [], [], []
        for m, at in zip(merged, found, strict=True):
            if len(at):
                gap = np.flatnonzero(at[1:] - at[:-1] > LENGTH)
                starts += (m[2] + at[np.concatenate(([0], gap + 1))]).tolist()
                stops += (m[2] + at[np.concatenate((gap, [len(at) - 1]))] + LENGTH).tolist()
                tids += [m[1]] * (len(gap) + 1)
        return pa.RecordBatch.from_arrays([pa.array(tids, pa.int64()), pa.array(starts, pa.int64()), pa.array(stops, pa.int64())],
                                          ["tid", "start", "stop"])

    def run(batches):
        rows: list[tuple[int, int, int, bytes]] = []
        size = 0
        for table in whole_groups(batches):
            columns = [c.to_pylist() for c in table.columns]
            for row in zip(*columns, strict=True):
                if size >= INDEX_BYTES and row[0] != rows[-1][0]:
                    yield solve(rows)
                    rows, size = [], 0
                rows.append(row)
                size += len(row[3])
        if rows:
            yield solve(rows)

    dealt = contexts.select("h", "tid", "start", "bytes").repartition("h").sortWithinPartitions("h", "tid", "start")
    return dealt.mapInArrow(run, "tid long, start long, stop long")


def counted(contexts: DataFrame) -> DataFrame:
    """The same result for very frequent anchors, by counting the windows' fingerprints."""

    def run(batches):
        for batch in batches:
            for tid, start, raw in zip(*(batch.column(k).to_pylist() for k in (0, 1, 2)), strict=True):
                h = Rolling(np.frombuffer(raw, np.uint8)).windows(LENGTH)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array([tid] * len(h), pa.int64()),
                                                  pa.array(start + np.arange(len(h)))], ["window", "tid", "start"])

    windows = written(contexts.select("tid", "start", "bytes").mapInArrow(run, "window long, tid long, start long"), "windows")
    place = F.struct("tid", "start")
    again = windows.groupBy("window").agg(F.min(place).alias("a"), F.max(place).alias("b")).where("a <> b").select("window")
    return windows.join(again, "window").select("tid", "start", (F.col("start") + LENGTH).alias("stop")).distinct()


# ---------------------------------------------------------------- the operator

def packed(df: DataFrame, text: str, id_column: str, row: bool = True) -> DataFrame:
    """doc_id, tid and size of every row, with the compressed text if ``row``."""

    def run(batches):
        pack = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            data, off = flat_texts(batch.column(1))
            for a, b, part, cuts in text_blocks(data, off):
                arrays = [batch.column(0).slice(a, b - a), pa.array(text_ids(part, cuts, Rolling(part))), pa.array(np.diff(cuts))]
                if row:
                    raw = part.tobytes()
                    arrays.append(pa.array([pack.compress(raw[x:y]) for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)],
                                           pa.binary()))
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "tid", "n_bytes", "packed"][:len(arrays)])

    schema = "doc_id long, tid long, n_bytes long" + (", packed binary" if row else "")
    return df.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)


def _contexts(asked: DataFrame, texts: DataFrame, first: DataFrame) -> DataFrame:
    """(h, tid, start, bytes) of the asked contexts, cut from one copy of each text."""

    def run(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for a in range(0, batch.num_rows, 64):
                part = batch.slice(a, 64)
                out: tuple[list, ...] = ([], [], [], [])
                for tid, raw, asks in zip(*(part.column(k).to_pylist() for k in (0, 1, 2)), strict=True):
                    raw = unpack.decompress(raw)
                    for ask in asks:
                        start = ask["place"] >> 20
                        for x, v in zip(out, (ask["h"], tid, start, raw[start:start + (ask["place"] & 1023)]), strict=True):
                            x.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()),
                                                  pa.array(out[2], pa.int64()), pa.array(out[3], pa.binary())],
                                                 ["h", "tid", "start", "bytes"])

    per = asked.groupBy("tid").agg(F.collect_list(F.struct("h", "place")).alias("asks"))  # bounded by the text
    per = per.join(first, "tid").withColumnRenamed("first_id", "doc_id")
    both = texts.join(per, (texts["tid"] == per["tid"]) & texts["doc_id"].eqNullSafe(per["doc_id"]))
    return both.select(texts["tid"], "packed", "asks").mapInArrow(run, "h long, tid long, start long, bytes binary")


def remove_repeats(df: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """doc_id, n_bytes, the removed spans (array of start, stop) and the kept bytes of every row."""
    df = bounded_batches(df)
    texts = packed(df, text, id_column)
    rows = written(packed(df, text, id_column, row=False), "rows")
    copies = rows.where(F.col("n_bytes") >= LENGTH).groupBy("tid").agg(
        F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("first_id"))
    sorted_rows = written(sorted_out(occurrences(df.select(F.col(text).alias("text")))), "sorted")
    asked = sorted_rows.where(F.col("kind") == OCCURRENCE).select("h", "tid", "place")
    contexts = _contexts(asked, texts, copies.select("tid", "first_id"))
    wide = asked.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > WIDE).select("h")
    if wide.isEmpty():
        found = indexed(contexts)
    else:
        contexts, wide = written(contexts, "contexts"), written(wide, "wide")
        found = indexed(contexts.join(wide, "h", "left_anti")).unionByName(counted(contexts.join(wide, "h", "left_semi")))
    known = sorted_rows.where(F.col("kind") == SPAN)
    start = F.shiftright("place", 20)
    known = known.select("tid", start.alias("start"), (start + F.col("place").bitwiseAND(1023)).alias("stop"))
    spans = written(known.unionByName(found), "spans")
    per = spans.groupBy("tid").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))  # bounded by the text
    marks = copies.where("copies > 1").select("tid", F.lit(True).alias("all")).join(per, "tid", "full")

    def run(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for a in range(0, batch.num_rows, 64):
                part = batch.slice(a, 64)
                removed, kept = [], []
                for raw, everything, found in zip(*(part.column(k).to_pylist() for k in (2, 3, 4)), strict=True):
                    raw = unpack.decompress(raw)
                    runs = [(0, len(raw))] if everything else joined([(s["start"], s["stop"]) for s in found or []])
                    ends = [0, *(x for r in runs for x in r), len(raw)]
                    kept.append(b"".join(raw[x:y] for x, y in zip(ends[::2], ends[1::2], strict=True)))
                    removed.append([{"start": x, "stop": y} for x, y in runs])
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1), pa.array(removed, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
                    pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "removed", "kept"])

    return (texts.join(marks, "tid", "left").select("doc_id", "n_bytes", "packed", "all", "spans")
            .mapInArrow(run, "doc_id long, n_bytes long, removed array<struct<start: long, stop: long>>, kept binary"))


def joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of overlapping or touching spans."""
    out: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(stop, out[-1][1]))
        else:
            out.append((start, stop))
    return out
