"""Operator 1: byte-level BPE encoding and decoding by speculation and verification.

Encoding one word (a piece of the pre-tokeniser) goes in three steps.

* *Speculate*: greedy longest match proposes tokens.
* *Verify*: a proposal is the exact encoding if and only if every adjacent pair
  of tokens is compatible, that is, if encoding the two tokens' joined bytes
  gives the pair back.  All new adjacent pairs of a block are tested at once in
  numpy: the two tokens are taken apart step by step along their own merges,
  latest first, and the pair fails when some merge across the boundary would have come before
  the merge that formed either side.
* *Repair*: only words with an incompatible pair undergo exact merging.

Results are kept per word in a bounded memo, so repeated words cost one lookup.

Defined cases: null text encodes as the empty text (no ids); a special token's
string inside a text is that special token, as in the library with its default
settings; ids out of the vocabulary decode to nothing; null ids decode to ''.
Bytes that are no UTF-8 decode to U+FFFD.  Columns other than the named ones
pass through unchanged; output names replace columns of the same name.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from itertools import chain
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitwall.llm.common import bounded_batches

#: Fixed value: the public pre-tokeniser pattern of byte-level BPE vocabularies.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

#: Words in each of the two generations of a worker's memo, and the longest word that is kept.
MEMO_WORDS = 200_000
MEMO_CHARS = 40
#: Up to this many bytes a word is merged by scanning, beyond it with a heap.
SCAN_BYTES = 48
#: Characters of text that are split and encoded together.
BLOCK_CHARS = 1 << 20


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tokens, merges and special strings of a byte-level BPE file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        model = spec["model"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        size = 1 + max([*model["vocab"].values(), *self.special.values()])
        self.bytes: list[bytes] = [b""] * size
        for token, i in model["vocab"].items():
            if token not in self.special:
                self.bytes[i] = bytes(map(letters.__getitem__, token))
        for token, i in self.special.items():
            self.bytes[i] = token.encode()
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left = np.array([model["vocab"][a] for a, _ in merges], np.int64)
        right = np.array([model["vocab"][b] for _, b in merges], np.int64)
        made = np.array([model["vocab"][a + b] for a, b in merges], np.int64)
        #: Rank of the merge that makes a token (-1: a single byte), and its two sides.
        self.rank = np.full(size, -1, np.int64)
        self.left, self.right = np.arange(size), np.arange(size)
        self.rank[made] = np.arange(len(made))
        self.left[made], self.right[made] = left, right
        order = np.argsort(left * size + right)
        self.keys, self.key_rank = (left * size + right)[order], order
        self.pair = dict(zip(zip(left.tolist(), right.tolist(), strict=True),
                             zip(range(len(made)), made.tolist(), strict=True), strict=True))
        self.size = size
        self.byte_id = [0] * 256
        for i, b in enumerate(self.bytes):
            if len(b) == 1 and self.rank[i] < 0:
                self.byte_id[b[0]] = i
        reachable = self._reachable(made)
        self.match = {self.bytes[i]: i for i in [*self.byte_id, *made[reachable].tolist()]}
        #: Longest token by its first two bytes; all others are at most one byte long.
        self.reach: dict[bytes, int] = {}
        for t in self.match:
            self.reach[t[:2]] = max(len(t), self.reach.get(t[:2], 1))
        self.split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.words = regex.compile(PATTERN)

    def _reachable(self, made: np.ndarray) -> np.ndarray:
        """Whether the bytes of each merged token encode to that token."""
        ok = self.compatible(self.left[made], self.right[made], self.rank[made])
        good = np.ones(self.size, bool)
        good[made] = ok
        for i, l, r in zip(made.tolist(), self.left[made].tolist(), self.right[made].tolist(), strict=True):
            good[i] &= good[l] and good[r]  # merges come in order, parts before wholes
        return good[made]

    def compatible(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
        """Whether each pair of tokens stays apart when its joined bytes are encoded.

        ``limit``: only merges below this rank count (default: all).  At each step the later
        formed side is taken apart, as merging forwards would have seen it last.  A merge
        across the boundary spoils the pair if its rank is below that of the merge that
        used up either of its two tokens; of equal ranks the left one comes first.
        """
        a, b = a.astype(np.int64), b.astype(np.int64)
        n = len(a)
        good = np.ones(n, bool)
        top = np.iinfo(np.int64).max
        bound = np.full(n, top) if limit is None else limit.astype(np.int64)
        live = np.arange(n)
        while len(live):
            x, y = a[live], b[live]
            key = x * self.size + y
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            bad = (self.keys[at] == key) & (self.key_rank[at] < bound[live])
            good[live[bad]] = False
            rx, ry = self.rank[x], self.rank[y]
            on = ~bad & (np.maximum(rx, ry) >= 0)
            live, x, y, rx, ry = live[on], x[on], y[on], rx[on], ry[on]
            from_left = rx > ry
            # Taking apart the left token exposes its right half; the boundary merge must have
            # come before that half was used (strictly: the left pair is merged first on ties).
            # For the right token an equal rank further left would have been merged first.
            a[live] = np.where(from_left, self.right[x], x)
            b[live] = np.where(from_left, y, self.left[y])
            bound[live] = np.where(from_left, rx, ry + 1)
        return good

    # -- exact merging -------------------------------------------------------

    def merge(self, word: bytes) -> list[int]:
        """The exact encoding: always apply the leftmost merge of lowest rank."""
        ids = [self.byte_id[b] for b in word]
        n = len(ids)
        if n <= SCAN_BYTES:
            none = (1 << 60, -1)
            steps = [self.pair.get(p, none) for p in zip(ids, ids[1:])]
            while steps and (best := min(steps)) is not none:
                i = steps.index(best)
                ids[i:i + 2] = [best[1]]
                del steps[i]
                if i:
                    steps[i - 1] = self.pair.get((ids[i - 1], ids[i]), none)
                if i < len(steps):
                    steps[i] = self.pair.get((ids[i], ids[i + 1]), none)
            return ids
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(p[0], i, ids[i], ids[i + 1], p[1]) for i in range(n - 1) if (p := self.pair.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, x, y, z = heapq.heappop(heap)
            j = after[i]
            if ids[i] != x or j >= n or ids[j] != y:
                continue
            ids[i], ids[j] = z, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if p := self.pair.get((z, ids[k])):
                    heapq.heappush(heap, (p[0], i, z, ids[k], p[1]))
            if (h := before[i]) >= 0 and (p := self.pair.get((ids[h], z))):
                heapq.heappush(heap, (p[0], h, ids[h], z, p[1]))
        return [t for t in ids if t >= 0]

    # -- speculation and verification -----------------------------------------

    def propose(self, word: bytes) -> list[int]:
        """Greedy longest match."""
        out, at, n, match, reach = [], 0, len(word), self.match, self.reach
        while at < n:
            end = at + reach.get(word[at:at + 2], 1)
            if end > n:
                end = n
            while (t := match.get(word[at:end])) is None:
                end -= 1
            out.append(t)
            at = end
        return out


class Coder:
    """Encoder and decoder of one worker, with its bounded memo of words."""

    def __init__(self, path: str) -> None:
        self.vocabulary = Vocabulary(path)
        #: Ids of words as packed int32, in a young and an old generation.
        self.memo: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.pairs_known = np.zeros(0, np.int64)
        self.pairs_good = np.zeros(0, bool)
        self.repaired = 0

    def _pairs(self, keys: np.ndarray) -> np.ndarray:
        """Compatibility of unique pair keys; known pairs are looked up."""
        size = self.vocabulary.size
        if len(self.pairs_known) > 1 << 20:
            self.pairs_known, self.pairs_good = np.zeros(0, np.int64), np.zeros(0, bool)
        at = np.searchsorted(self.pairs_known, keys)
        known = np.zeros(len(keys), bool)
        inside = at < len(self.pairs_known)
        known[inside] = self.pairs_known[at[inside]] == keys[inside]
        good = np.zeros(len(keys), bool)
        good[known] = self.pairs_good[at[known]]
        new = keys[~known]
        if len(new):
            good[~known] = self.vocabulary.compatible(new // size, new % size)
            merged = np.concatenate((self.pairs_known, new))
            order = np.argsort(merged, kind="stable")
            self.pairs_known = merged[order]
            self.pairs_good = np.concatenate((self.pairs_good, good[~known]))[order]
        return good

    def learn(self, words: list[str], into: dict[str, bytes]) -> None:
        """Encode new words together: propose, verify all pairs at once, repair the failures."""
        v = self.vocabulary
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        proposed = list(map(v.propose, raw))
        sizes = np.fromiter(map(len, proposed), np.int64, len(words))
        flat = np.fromiter(chain.from_iterable(proposed), np.int64, int(sizes.sum()))
        if len(flat) > 1:
            owner = np.repeat(np.arange(len(words)), sizes)
            same = owner[1:] == owner[:-1]
            keys, back = np.unique((flat[:-1] * v.size + flat[1:])[same], return_inverse=True)
            good = self._pairs(keys)[back]
            for i in np.unique(owner[1:][same][~good]).tolist():
                proposed[i] = v.merge(raw[i])
                self.repaired += 1
        sizes = np.fromiter(map(len, proposed), np.int64, len(words))
        packed = np.fromiter(chain.from_iterable(proposed), np.int32, int(sizes.sum())).tobytes()
        ends = (np.cumsum(sizes) * 4).tolist()
        into.update(zip(words, map(packed.__getitem__, map(slice, [0, *ends[:-1]], ends)), strict=True))

    def pieces(self, text: str) -> list[str]:
        """Pre-tokenised words, and special strings as they are."""
        v = self.vocabulary
        if v.split is None or not any(s in text for s in v.special):
            return v.words.findall(text)
        out: list[str] = []
        for part in v.split.split(text):
            out += [part] if part in v.special else v.words.findall(part)
        return out

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Token ids of each text."""
        out: list[np.ndarray] = []
        block: list[list[str]] = []
        chars = 0
        for text in texts:
            block.append(self.pieces(text or ""))
            chars += len(text or "")
            if chars >= BLOCK_CHARS:
                out += self._encode_block(block)
                block, chars = [], 0
        return out + self._encode_block(block)

    def _encode_block(self, block: list[list[str]]) -> list[np.ndarray]:
        special = self.vocabulary.special
        if len(self.memo) > MEMO_WORDS:
            self.old, self.memo = self.memo, {}
        memo, old = self.memo, self.old
        new = set().union(*block).difference(memo)
        if known := new.intersection(old):
            memo.update((w, old[w]) for w in known)
            new -= known
        long: list[str] = [w for w in new if len(w) > MEMO_CHARS]
        if new:
            memo.update((w, np.int32(special[w]).tobytes()) for w in new if w in special)
            self.learn([w for w in new if w not in special], memo)
        get = memo.__getitem__
        out = [np.frombuffer(b"".join(map(get, words)), np.int32) for words in block]
        for w in long:
            if w not in special:
                del memo[w]
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text of token ids, special tokens included; ids out of range give nothing."""
        table = self.vocabulary.bytes
        if len(ids) and (ids.min() < 0 or ids.max() >= len(table)):
            ids = ids[(ids >= 0) & (ids < len(table))]
        if not len(ids):
            return ""
        parts = itemgetter(*ids.tolist())(table) if len(ids) > 1 else (table[int(ids[0])],)
        return b"".join(parts).decode("utf-8", "replace")


_CODERS: dict[str, Coder] = {}


def coder(path: str) -> Coder:
    """The coder of this Python worker (a memo: losing it costs time, not results)."""
    if path not in _CODERS:
        _CODERS[path] = Coder(path)
    return _CODERS[path]


def _with_fields(df: DataFrame, *fields: tuple[str, T.DataType]) -> T.StructType:
    names = {n for n, _ in fields}
    return T.StructType([f for f in df.schema.fields if f.name not in names]
                        + [T.StructField(n, t, True) for n, t in fields])


def _slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about BLOCK_CHARS bytes of text each (one row at least)."""
    sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    group = np.cumsum(sizes) // BLOCK_CHARS
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(sizes)]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if b > a:
            yield batch.slice(a, b - a)


def _id_lists(ids: list[np.ndarray]) -> pa.ListArray:
    off = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
    flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(flat.astype(np.int32), pa.int32()))


def _assemble(part: pa.RecordBatch, keep: list[str], new: dict[str, pa.Array]) -> pa.RecordBatch:
    at = {n: i for i, n in enumerate(part.schema.names)}
    return pa.RecordBatch.from_arrays([part.column(at[n]) for n in keep] + list(new.values()), [*keep, *new])


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add the array<int> column ``ids`` with the token ids of the column ``text``."""
    schema = _with_fields(df, (ids, T.ArrayType(T.IntegerType(), False)))
    keep, column = schema.names[:-1], df.columns.index(text)

    def run(batches):
        c = coder(path)
        for batch in batches:
            for part in _slices(batch, column):
                yield _assemble(part, keep, {ids: _id_lists(c.encode(part.column(column).to_pylist()))})

    return bounded_batches(df).mapInArrow(run, schema)


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add the string column ``text`` with the decoded token ids of the column ``ids``."""
    schema = _with_fields(df, (text, T.StringType()))
    keep, column = schema.names[:-1], df.columns.index(ids)

    def run(batches):
        c = coder(path)
        for batch in batches:
            lists = batch.column(column)
            for a in range(0, len(lists), 256):
                part = batch.slice(a, 256)
                texts = [c.decode(np.asarray(x if x is not None else [], np.int64)) for x in
                         (v.values.to_numpy(zero_copy_only=False) if v.is_valid else None for v in part.column(column))]
                yield _assemble(part, keep, {text: pa.array(texts, pa.string())})

    return bounded_batches(df).mapInArrow(run, schema)


def round_trip(df: DataFrame, path: str, text: str = "text", ids: str = "ids",
               decoded: str = "decoded") -> DataFrame:
    """Both in one pass over the rows: ``encode`` and ``decode`` of the new ids."""
    schema = _with_fields(df, (ids, T.ArrayType(T.IntegerType(), False)), (decoded, T.StringType()))
    keep, column = schema.names[:-2], df.columns.index(text)

    def run(batches):
        c = coder(path)
        for batch in batches:
            for part in _slices(batch, column):
                found = c.encode(part.column(column).to_pylist())
                yield _assemble(part, keep, {ids: _id_lists(found),
                                             decoded: pa.array(map(c.decode, found), pa.string())})

    return bounded_batches(df).mapInArrow(run, schema)


def digests(df: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """The digest columns of a round trip: token count, digest of ids, digest of decoded text."""
    return df.select(
        id_column, F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
