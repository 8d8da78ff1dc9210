"""Operator 3: language model with hashed maximum-entropy features and a class-factored softmax.

A token is predicted by a chain of softmaxes over hashed features; each leaves a
share of its probability (an escape outcome) to the next one.

* *Word n-grams.*  Given the word before it: a softmax with one hashed feature a (word before, word).
  ``GAPS`` can add word skips: the same with the word two before, after the n-grams.
* *Class softmax.*  Class given the history times word given class.  The most frequent training
  words have a class each; the text's end has one; all other words fall into classes by shape
  (length, final punctuation, accents).  Hashed features of the history: the last class, the last
  two (n-grams), the one before the last, and the latest telling class however far back, alone and
  with the last one (skips).
* *Word softmax of a class.*  Words of the broadcast lexicon have the weight log(count + 1); the
  rarer words of a shape form a softmax of their own, and all unseen ones share one more unit.

Training.  Word counts and counts of (history, class) cells come from two aggregations; the class
softmax is trained by full-batch gradient updates over the cells: each of ``PARTS`` tasks adds up
expected feature counts, the driver adds the partial sums (fixed size) and updates.  Word features
grow with the corpus and never meet on the driver: texts are packed into chunks, each chunk sends its
distinct (context, word) features with their training counts to the buckets of their contexts, and
a bucket trains the weights of all its contexts by gradient updates under an L1 penalty
(``PENALTY``), whose share of a context goes to the escape outcome.  Contexts of more than
``HOT`` tokens are cut by word over several buckets, each with a softmax of its own; their
shares are added up per context.

Scoring.  The buckets answer each chunk with the probabilities of its features, and the chunk is
scored as a sparse batch.  Counts of frequent words are broadcast (at most ``FREQUENT`` words);
for the base score rarer words are joined.

Words are told apart by 64-bit hashes, features of rare words by 28 bits in the context and
31 in the word.
Defined cases: null, empty and blank texts are one end token; without training tokens all counts
are 0 and the class softmax is uniform; repeated ids are scored row by row; a null id is never held out.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwall.llm.common import Words, bounded_batches, flat_texts, is_in_fold, mix64, text_blocks, written

#: Classes: frequent words, shapes (4 lengths x 3 endings x 4 accents), the end.
TOP, SHAPES = 15, 48
CLASSES = TOP + SHAPES + 1
END = CLASSES - 1
#: Telling classes: none, the frequent words, three kinds of accents.
TELLING = 1 + TOP + 3
CELLS = CLASSES * CLASSES * TELLING
#: Hash buckets of the features, features of a history, updates, tasks of an update.
BUCKETS, ACTIVE, UPDATES, PARTS = 8192, 6, 14, 8
#: Words whose counts are broadcast, at most.
FREQUENT = 1 << 17
#: How far before a token the words stand whose (word, token) pairs are features.
GAPS = (1,)
#: L1 penalty of a feature's weight and updates of the word softmaxes.
PENALTY, WORD_UPDATES = 0.8, 9
#: Bytes of the texts of a chunk, about (a longer text is a chunk of its own).
CHUNK_BYTES = 2 << 20
#: Tokens of a bucket of features, about, and tokens beyond which a context is cut.
BUCKET_TOKENS, HOT = 1 << 20, 1 << 17
#: Bit of a context that is cut.
CUT = 1 << 29

_LOW = np.uint64(0xFFFFFFFF)

_ENDING = np.zeros(256, np.int64)
_ENDING[[ord(c) for c in ".!?"]] = 2
_ENDING[[ord(c) for c in ",;:)"]] = 1
_ACCENT = np.zeros((2, 256), bool)
_ACCENT[0, [0xA1, 0xAD, 0xB1, 0xB3, 0xBA]] = True
_ACCENT[1, [0x9F, 0xA4, 0xB6, 0xBC]] = True


def shapes(words: Words) -> np.ndarray:
    """The shape class (0..SHAPES-1) of each word of a block."""
    data = words.data
    led = np.zeros(len(data), bool)
    led[1:] = data[:-1] == 0xC3

    def has(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(flags, dtype=np.int32)))
        return total[words.end] > total[words.start]

    accent = np.where(has(led & _ACCENT[0][data]), 1, np.where(has(led & _ACCENT[1][data]), 2, np.where(has(data >= 128), 3, 0)))
    length = np.digitize(words.end - words.start, (4, 7, 11))
    ending = _ENDING[data[words.end - 1]] if len(words.end) else np.zeros(0, np.int64)
    return (length * 3 + ending) * 4 + accent


class Lexicon(NamedTuple):
    """Frequent words by hash with their counts, the class of each, and the totals."""

    hashes: np.ndarray
    ranks: np.ndarray
    counts: np.ndarray
    classes: np.ndarray
    shape_words: np.ndarray
    shape_tokens: np.ndarray
    #: Of these, words and tokens beyond the lexicon.
    rare_words: np.ndarray
    rare_tokens: np.ndarray
    texts: int
    tokens: int
    words: int


def find(lexicon: Lexicon, hashes: np.ndarray) -> np.ndarray:
    """Positions of hashes in the lexicon, -1 if not there."""
    if not len(lexicon.hashes):
        return np.full(len(hashes), -1)
    at = np.minimum(np.searchsorted(lexicon.hashes, hashes), len(lexicon.hashes) - 1)
    return np.where(lexicon.hashes[at] == hashes, at, -1)


class Tokens:
    """All tokens of a block of texts, ends included, with classes and history codes."""

    def __init__(self, data: np.ndarray, off: np.ndarray, lexicon: Lexicon) -> None:
        words = Words(data, off)
        texts = len(off) - 1
        shape = shapes(words)
        self.found = find(lexicon, words.hash)
        known = self.found >= 0
        own = np.full(len(shape), -1)
        own[known] = lexicon.classes[self.found[known]]
        kind = np.where(own >= 0, own, TOP + shape)
        telling = np.where(own >= 0, 1 + own, np.where(shape % 4 > 0, TOP + shape % 4, 0))
        # Token k of text t stands at words.first[t] + t + k; the end comes after the words.
        at = np.arange(len(kind)) + words.text
        ends = words.first[1:] + np.arange(texts)
        n = len(kind) + texts
        self.text = np.repeat(np.arange(texts), words.counts + 1)
        self.word_at, self.words, self.end_at = at, words, ends
        self.kind = np.full(n, END)
        self.kind[at] = kind
        start = np.zeros(n, bool)
        start[ends[:-1] + 1] = True
        start[:1] = True
        back = lambda x, first: np.where(start, first, np.concatenate(([first], x[:-1])))
        one = back(self.kind, END)
        two = back(one, END)
        marks = np.zeros(n, np.int64)
        marks[at] = telling
        # The latest telling token before each token, within its text.
        place = np.where(marks > 0, np.arange(n), -1)
        last = np.concatenate(([-1], np.maximum.accumulate(place)[:-1])) if n else place
        begin = np.concatenate(([0], ends[:-1] + 1))[self.text] if n else place
        latest = np.where(last >= begin, marks[np.maximum(last, 0)], 0)
        self.history = (one * CLASSES + two) * TELLING + latest


def feature_ids(history: np.ndarray) -> np.ndarray:
    """The hashed features (rows x ACTIVE) of history codes."""
    latest = history % TELLING
    two = history // TELLING % CLASSES
    one = history // TELLING // CLASSES
    parts = [np.zeros_like(history), one, one * CLASSES + two, two, latest, latest * CLASSES + one]
    codes = np.stack([p * 8 + k for k, p in enumerate(parts)], axis=1).astype(np.uint64)
    return (mix64(codes + np.uint64(1)) % np.uint64(BUCKETS)).astype(np.int64)


def log_softmax(weights: np.ndarray, history: np.ndarray) -> np.ndarray:
    """Natural log probabilities (rows x CLASSES) of the classes after history codes."""
    ids = feature_ids(history)
    logits = weights[ids[:, 0]].copy()
    for k in range(1, ACTIVE):
        logits += weights[ids[:, k]]
    logits -= logits.max(axis=1, keepdims=True)
    return logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))


# ---------------------------------------------------------------- gathering

def word_counts(texts: DataFrame) -> DataFrame:
    """(h, shape, n) of the words of all rows of ``texts`` (one text column)."""

    def run(batches):
        for batch in batches:
            data, off = flat_texts(batch.column(0))
            for _, _, part, cuts in text_blocks(data, off, 16 << 20):
                keys, kinds = [], []
                for _, _, small, inner in text_blocks(part, cuts):
                    words = Words(small, inner)
                    keys.append(words.hash)
                    kinds.append(shapes(words).astype(np.int32))
                h, first, n = np.unique(np.concatenate(keys), return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(np.concatenate(kinds)[first]),
                                                  pa.array(n.astype(np.int64))], ["h", "shape", "n"])

    return texts.mapInArrow(run, "h long, shape int, n long").groupBy("h", "shape").agg(F.sum("n").alias("n"))


def lexicon_of(counts: DataFrame, texts: int) -> Lexicon:
    """The broadcast part of the counts: at most FREQUENT words, and sums by shape."""
    shape_words, shape_tokens = np.zeros(SHAPES, np.int64), np.zeros(SHAPES, np.int64)
    for shape, words, tokens in counts.groupBy("shape").agg(F.count(F.lit(1)), F.sum("n")).collect():
        shape_words[shape], shape_tokens[shape] = words, tokens
    size = F.floor(F.log2("n") * 16).cast("int")
    per = dict(counts.groupBy(size.alias("size")).agg(F.count(F.lit(1))).collect())
    least, total = 1 << 30, 0
    for s in sorted(per, reverse=True):
        if total + per[s] > FREQUENT:
            break
        least, total = s, total + per[s]
    rows = counts.where(size >= least).select("h", "shape", "n").toPandas()
    rows = rows.sort_values(["n", "h"], ascending=[False, True]).reset_index(drop=True)
    classes = np.where(np.arange(len(rows)) < TOP, np.arange(len(rows)), -1)
    for shape, n in rows[["shape", "n"]].head(TOP).itertuples(index=False):
        shape_words[shape] -= 1
        shape_tokens[shape] -= n
    rest = rows.iloc[TOP:]
    rare_words = shape_words - np.bincount(rest["shape"], minlength=SHAPES)
    rare_tokens = shape_tokens - np.bincount(rest["shape"], rest["n"], SHAPES).astype(np.int64)
    h = rows["h"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(h)
    return Lexicon(h[order], order, rows["n"].to_numpy(np.int64)[order], classes[order], shape_words, shape_tokens,
                   rare_words, rare_tokens, texts,
                   int(shape_tokens.sum() + rows["n"].head(TOP).sum()) + texts,
                   int(shape_words.sum() + min(len(rows), TOP)) + (texts > 0))


def cell_counts(texts: DataFrame, lexicon) -> DataFrame:
    """(cell, n): how often each class follows each history in the training texts."""

    def run(batches):
        total = np.zeros(CELLS * CLASSES, np.int64)
        for batch in batches:
            data, off = flat_texts(batch.column(0))
            for _, _, part, cuts in text_blocks(data, off):
                t = Tokens(part, cuts, lexicon.value)
                cell, n = np.unique(t.history * CLASSES + t.kind, return_counts=True)
                total[cell] += n
        at = np.flatnonzero(total)
        for a in range(0, len(at), 65536):
            yield pa.RecordBatch.from_arrays([pa.array(at[a:a + 65536]), pa.array(total[at[a:a + 65536]])], ["cell", "n"])

    return texts.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))


def train(cells: DataFrame, updates: int = UPDATES) -> np.ndarray:
    """Weights (BUCKETS x CLASSES) after distributed full-batch gradient updates.

    The gradient of a weight is its observed minus its expected count; the step divides it
    by the larger of the two and by the number of active features.
    """
    spark = cells.sparkSession
    cells = cells.coalesce(PARTS)

    def partial(weights, observed: bool):
        def run(batches):
            rows = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
            if not rows:
                return
            cell, n = (np.concatenate(x) for x in zip(*rows, strict=True))
            out = np.zeros((BUCKETS, CLASSES))
            if observed:
                ids = feature_ids(cell // CLASSES)
                for k in range(ACTIVE):
                    np.add.at(out, (ids[:, k], cell % CLASSES), n)
            else:
                history, back = np.unique(cell // CLASSES, return_inverse=True)
                mass = np.bincount(back, n)
                for a in range(0, len(history), 8192):
                    some = history[a:a + 8192]
                    p = np.exp(log_softmax(weights.value, some)) * mass[a:a + 8192, None]
                    ids = feature_ids(some)
                    for k in range(ACTIVE):
                        order = np.argsort(ids[:, k], kind="stable")
                        f = ids[order, k]
                        at = np.flatnonzero(np.concatenate(([True], f[1:] != f[:-1])))
                        out[f[at]] += np.add.reduceat(p[order], at, axis=0)
            yield pa.RecordBatch.from_arrays([pa.array([out.astype(np.float32).tobytes()], pa.binary())], ["part"])

        total = np.zeros((BUCKETS, CLASSES))
        for (part,) in cells.mapInArrow(run, "part binary").collect():  # PARTS arrays of a fixed size
            total += np.frombuffer(part, np.float32).reshape(BUCKETS, CLASSES)
        return total

    weights = np.zeros((BUCKETS, CLASSES), np.float32)
    observed = partial(None, True)
    if not observed.any():
        return weights
    bias = feature_ids(np.zeros(1, np.int64))[0, 0]
    weights[bias] = np.log(observed[bias] + 0.5)
    weights[bias] -= weights[bias].max()
    for _ in range(updates):
        shared = spark.sparkContext.broadcast(weights)
        expected = partial(shared, False)
        shared.unpersist()
        step = (observed - expected) / (np.maximum(observed, expected) + 1.0)
        weights = (weights + 2.0 * step / ACTIVE).astype(np.float32)
    return weights


# ---------------------------------------------------------------- word features

CHUNK = "chunk long, ids array<long>, held array<boolean>, cuts binary, data binary"


def chunks_of(rows: DataFrame) -> DataFrame:
    """The rows (doc_id, held_out, text) in numbered chunks of whole texts, compressed."""

    def run(batches):
        number = TaskContext.get().partitionId() << 20
        codec = pa.Codec("zstd", compression_level=7)
        for batch in batches:
            data, off = flat_texts(batch.column(2))
            for a, b, part, cuts in text_blocks(data, off, CHUNK_BYTES):
                packed = codec.compress(np.ascontiguousarray(part), asbytes=True) if len(part) else b""
                ids, held = (batch.column(i).slice(a, b - a).to_pylist() for i in (0, 1))
                types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.binary(), pa.binary()]
                one = [[number], [ids], [held], [cuts.tobytes()], [packed]]
                number += 1
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(one, types, strict=True)],
                                                 ["chunk", "ids", "held", "cuts", "data"])

    return rows.mapInArrow(run, CHUNK)


def unpacked(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of the texts of a chunk."""
    off = np.frombuffer(row["cuts"], np.int64)
    if not len(row["data"]):
        return np.zeros(0, np.uint8), off
    return np.frombuffer(pa.decompress(row["data"], int(off[-1]), "zstd"), np.uint8), off


class Features:
    """The distinct (context, word) features of a block of tokens, by bucket.

    ``keys`` holds the context in its upper half and the word in its lower one; ``of[j]`` gives the
    feature of each token in softmax j (the gaps, then the rarer words of shapes), -1 where it has none.
    """

    def __init__(self, tokens: Tokens, lexicon: Lexicon, buckets: int, hot: int, learn: np.ndarray) -> None:
        n, self.hot = len(tokens.kind), hot
        known = tokens.found >= 0
        where, rare = tokens.word_at[known], tokens.word_at[~known]
        # Codes: the rank of a listed word, FREQUENT for an end (or begin), a marked hash for the rest.
        word, count = np.full(n, FREQUENT, np.uint64), np.full(n, lexicon.texts, np.int64)
        word[where], count[where] = lexicon.ranks[tokens.found[known]], lexicon.counts[tokens.found[known]]
        word[rare], count[rare] = tokens.words.hash[~known] & _LOW | np.uint64(1 << 31), 0
        place = np.arange(n) - np.concatenate(([0], tokens.end_at[:-1] + 1))[tokens.text] if n else np.zeros(0, np.int64)
        keys, parts, at = [], [], []
        for j, gap in enumerate(GAPS):
            inside = np.flatnonzero(place >= gap)
            before, size = np.full(n, FREQUENT, np.uint64), np.full(n, lexicon.texts, np.int64)
            before[inside], size[inside] = word[inside - gap], count[inside - gap]
            at.append(np.arange(n))
            self._add(keys, parts, j, before, size, word)
        at.append(rare)
        shape = tokens.kind[rare] - TOP
        self._add(keys, parts, len(GAPS), shape.astype(np.uint64), lexicon.rare_tokens[shape], word[rare])
        key, part = np.concatenate(keys), np.concatenate(parts) % np.uint64(buckets)
        del keys, parts
        # Sort by (bucket, key): the same order on both sides of the shuffle.
        some, first, back = np.unique(key, return_index=True, return_inverse=True)
        part = part[first]
        order = np.lexsort((some, part))
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        back = rank[back]
        self.keys, self.buckets = some[order], part[order].astype(np.int64)
        self.counts = np.bincount(back[learn[np.concatenate(at)]], minlength=len(order)).astype(np.uint32)
        self.of = np.full((len(GAPS) + 1, n), -1, np.int32)
        begin = 0
        for j, where in enumerate(at):
            self.of[j, where] = back[begin:begin + len(where)]
            begin += len(where)

    def _add(self, keys: list, parts: list, kind: int, context: np.ndarray, size: np.ndarray, word: np.ndarray) -> None:
        """Keys and bucket hashes of features; ``CUT`` in the context marks one that is cut."""
        hot = size > self.hot
        x = context & np.uint64((1 << 28) - 1) | (context >> np.uint64(31)) << np.uint64(28)
        x |= hot.astype(np.uint64) * np.uint64(CUT) | np.uint64(kind << 30)
        cuts = np.left_shift(1, np.ceil(np.log2(np.maximum(size / self.hot, 1))).astype(np.int64)).astype(np.uint64)
        keys.append(x << np.uint64(32) | word)
        parts.append(mix64(x << np.uint64(32) | mix64(word + np.uint64(1)) & (cuts - np.uint64(1))))


def squeezed(*arrays: np.ndarray) -> bytes:
    """Arrays of 4-byte values, equally long, as compressed byte planes."""
    planes = b"".join(np.ascontiguousarray(a.view(np.uint8).reshape(-1, 4).T).tobytes() for a in arrays)
    return pa.compress(planes, "zstd", asbytes=True) if planes else b""


def opened(packed: bytes, n: int, *types) -> list[np.ndarray]:
    """The arrays of ``n`` values that ``squeezed`` packed."""
    planes = np.frombuffer(pa.decompress(packed, 4 * n * len(types), "zstd"), np.uint8) if n else np.zeros(0, np.uint8)
    planes = planes.reshape(len(types), 4, n)
    return [np.ascontiguousarray(planes[i].T).view(t).reshape(-1) for i, t in enumerate(types)]


def rounded(values: np.ndarray) -> np.ndarray:
    """Floats of 12 significant bits (equal ones compress well)."""
    bits = np.ascontiguousarray(values, np.float32).view(np.uint32)
    return ((bits + np.uint32(0x800)) & np.uint32(0xFFFFF000)).view(np.float32)


def contexts(keys: np.ndarray) -> np.ndarray:
    """Begins of the runs of one bucket and context in the features of a chunk or bucket."""
    x = keys >> np.uint64(32)
    return np.flatnonzero(np.concatenate((np.ones(min(len(x), 1), bool), x[1:] != x[:-1])))


def fit_words(counts: np.ndarray, begins: np.ndarray, penalty: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Softmaxes of contexts: probability of each feature, escape and tokens of each context.

    ``counts`` are positive and lie context by context.  A softmax is over the words seen in its
    context and the escape; each update moves a weight by its gradient, divided by the larger of the
    observed and the expected count.  The L1 penalty is taken from the observed count of
    each word and added to that of the escape.
    """
    if not len(counts):
        return np.zeros(0), np.zeros(0), np.zeros(0)
    size = np.diff(np.append(begins, len(counts)))
    of = np.repeat(np.arange(len(begins)), size)
    tokens = np.add.reduceat(counts, begins).astype(np.float64)
    seen, left = counts - penalty, penalty * size
    weight, escape = np.log(counts.astype(np.float64)), np.log(size.astype(np.float64))
    for step in range(WORD_UPDATES + 1):
        top = np.maximum(np.maximum.reduceat(weight, begins), escape)
        p, e = np.exp(weight - top[of]), np.exp(escape - top)
        total = np.add.reduceat(p, begins) + e
        p, e = p / total[of], e / total
        if step < WORD_UPDATES:
            expected, out = p * tokens[of], e * tokens
            weight += (seen - expected) / np.maximum(seen, expected)
            escape += (left - out) / np.maximum(left, out)
    return p, e, tokens


def features_of(chunks: DataFrame, lexicon, buckets: int, hot: int) -> DataFrame:
    """(bucket, chunk, n, packed): the features of every chunk, one row a bucket."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                data, off = unpacked(row)
                tokens = Tokens(data, off, lexicon.value)
                learn = ~np.array(row["held"], bool)[tokens.text]
                f = Features(tokens, lexicon.value, buckets, hot, learn)
                cut = np.flatnonzero(np.concatenate(([True], f.buckets[1:] != f.buckets[:-1])))
                ends = np.append(cut[1:], len(f.keys))
                pieces = zip(cut.tolist(), ends.tolist(), strict=True)
                x, w = (f.keys >> np.uint64(32)).astype(np.uint32), f.keys.astype(np.uint32)
                packed = [squeezed(np.diff(x[a:b], prepend=np.uint32(0)), w[a:b], f.counts[a:b]) for a, b in pieces]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(f.buckets[cut]), pa.array(np.full(len(cut), row["chunk"])), pa.array(ends - cut),
                     pa.array(packed, pa.binary())], ["bucket", "chunk", "n", "packed"])

    return chunks.mapInArrow(run, "bucket long, chunk long, n long, packed binary")


ANSWERS = "chunk long, bucket long, n long, mass binary, m long, shares binary, context long, tokens double, escaped double"


def answers_of(features: DataFrame, penalty: float) -> DataFrame:
    """Train every bucket's softmaxes and answer its chunks.

    ``mass`` is the probability of each feature times the tokens of its context in the bucket, ``shares`` the
    escape and the tokens of each context.  Cut contexts have a row each (chunk null) besides.
    """

    def fit(table: pa.Table) -> pa.Table:
        slices = []
        for chunk, n, packed in zip(*(table[c].to_pylist() for c in ("chunk", "n", "packed")), strict=True):
            x, w, counts = opened(packed, n, np.uint32, np.uint32, np.uint32)
            slices.append((chunk, np.cumsum(x, dtype=np.uint32).astype(np.uint64) << np.uint64(32) | w, counts))
        bucket = table["bucket"][0].as_py()
        keys, back = np.unique(np.concatenate([k for _, k, _ in slices]), return_inverse=True)
        counts = np.bincount(back, np.concatenate([n for _, _, n in slices]), len(keys)).astype(np.int64)
        learnt = np.flatnonzero(counts)
        begins = contexts(keys[learnt])
        p, escape, tokens = fit_words(counts[learnt], begins, penalty)
        names = keys[learnt][begins] >> np.uint64(32)
        mass = np.zeros(len(keys), np.float32)
        mass[learnt] = rounded(p * np.repeat(tokens, np.diff(np.append(begins, len(learnt))))) if len(learnt) else p
        out, at = [], 0
        for chunk, k, _ in slices:
            here = back[at:at + len(k)]
            at += len(k)
            x = k[contexts(k)] >> np.uint64(32)
            spot = np.minimum(np.searchsorted(names, x), max(len(names) - 1, 0))
            shares = np.ones((len(x), 2), np.float32)
            if len(names):
                same = names[spot] == x
                shares[same, 0], shares[same, 1] = escape[spot[same]], tokens[spot[same]]
            shares = rounded(shares)
            out.append((chunk, bucket, len(k), squeezed(mass[here]), len(x),
                        squeezed(*(np.ascontiguousarray(c) for c in shares.T)), None, None, None))
        cut = np.flatnonzero(names & np.uint64(CUT)) if len(names) else []
        out += [(None, bucket, None, None, None, None, int(names[i]), float(tokens[i]), float(escape[i] * tokens[i])) for i in cut]
        types = [pa.int64()] * 3 + [pa.binary(), pa.int64(), pa.binary(), pa.int64(), pa.float64(), pa.float64()]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)],
                        [f.split()[0] for f in ANSWERS.split(", ")])

    return features.groupBy("bucket").applyInArrow(fit, ANSWERS)


class Cut(NamedTuple):
    """Cut contexts (at most the lexicon's words a gap, and the shapes): tokens and escape."""

    names: np.ndarray
    tokens: np.ndarray
    escape: np.ndarray


def cut_contexts(answers: DataFrame) -> Cut:
    rows = answers.where("chunk is null").groupBy("context").agg(F.sum("tokens"), F.sum("escaped")).orderBy("context").collect()
    names, tokens, escaped = (np.array([r[i] for r in rows], np.float64) for i in range(3))
    return Cut(names.astype(np.uint64), tokens, escaped / np.maximum(tokens, 1))


def word_chances(features: Features, mass: np.ndarray, shares: np.ndarray, cut: Cut) -> tuple[np.ndarray, np.ndarray]:
    """Probability and escape of every feature of a chunk, from the buckets' answers."""
    key = features.keys
    x = key >> np.uint64(32)
    new = np.ones(len(key), bool)
    new[1:] = (x[1:] != x[:-1]) | (features.buckets[1:] != features.buckets[:-1])
    run = np.cumsum(new) - 1
    escape, tokens = shares[run, 0].astype(np.float64), shares[run, 1].astype(np.float64)
    hot = np.flatnonzero(x & np.uint64(CUT))
    if len(hot):
        escape[hot], tokens[hot] = 1.0, 1.0
        if len(cut.names):
            spot = np.minimum(np.searchsorted(cut.names, x[hot]), len(cut.names) - 1)
            same = cut.names[spot] == x[hot]
            escape[hot[same]], tokens[hot[same]] = cut.escape[spot[same]], cut.tokens[spot[same]]
    return mass / tokens, escape


# ---------------------------------------------------------------- scoring

SCORED = ("row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, model double, "
          "h long, tf long")


def token_chances(tokens: Tokens, lexicon: Lexicon, weights: np.ndarray, of: np.ndarray, p: np.ndarray,
                  escape: np.ndarray) -> np.ndarray:
    """The model's probability of every token of a block."""
    history, back = np.unique(tokens.history, return_inverse=True)
    chance = np.empty(len(tokens.kind))
    for a in range(0, len(history), 16384):
        some = np.flatnonzero((back >= a) & (back < a + 16384)) if len(history) > 16384 else slice(None)
        logs = log_softmax(weights, history[a:a + 16384])
        chance[some] = np.exp(logs[back[some] - a, tokens.kind[some]])
    kind = tokens.kind[tokens.word_at] - TOP
    known = tokens.found >= 0
    shaped = np.flatnonzero((kind >= 0) & known)
    whole = lexicon.shape_words + lexicon.shape_tokens + 1.0
    chance[tokens.word_at[shaped]] *= (lexicon.counts[tokens.found[shaped]] + 1.0) / whole[kind[shaped]]
    at, shape = tokens.word_at[~known], kind[~known]
    units = lexicon.rare_words + 1.0
    own = p[of[-1, at]] + escape[of[-1, at]] / units[shape]
    chance[at] *= (lexicon.rare_tokens + units)[shape] / whole[shape] * own
    for j in reversed(range(len(GAPS))):
        chance = p[of[j]] + escape[of[j]] * chance
    return chance


def scored(chunks: DataFrame, answers: DataFrame, lexicon, weights, cut, buckets: int, hot: int) -> DataFrame:
    """Per text, its sums over frequent words and the model's score; and a row per (text, rarer word)."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        lex = lexicon.value
        log_counts = np.log10(lex.counts + 1.0)
        out = []
        for row in left.to_pylist():
            data, off = unpacked(row)
            n = len(off) - 1
            t = Tokens(data, off, lex)
            f = Features(t, lex, buckets, hot, np.zeros(len(t.kind), bool))
            order = np.argsort(right["bucket"].to_numpy())
            right = right.take(order)
            mass, shares = [], []
            for n_of, packed, m, pairs in zip(*(right[c].to_pylist() for c in ("n", "mass", "m", "shares")), strict=True):
                mass += opened(packed, n_of, np.float32)
                shares.append(np.stack(opened(pairs, m, np.float32, np.float32), axis=1))
            p, escape = word_chances(f, np.concatenate(mass), np.concatenate(shares), cut.value)
            chance = token_chances(t, lex, weights.value, f.of, p, escape)
            model = np.bincount(t.text, np.log10(np.minimum(chance, 1.0)), n)
            owner, known = t.words.text, t.found >= 0
            base = np.bincount(owner[known], log_counts[t.found[known]], n) + np.log10(lex.texts + 1.0)
            n_known = np.bincount(owner[known], minlength=n) + (lex.texts > 0)
            ids = (row["chunk"] << 20) + np.arange(n)
            out.append(_rows(ids, pa.array(row["ids"], pa.int64()), pa.array(row["held"], pa.bool_()), t.words.counts + 1,
                             n_known, base, model, None, None))
            h, owner = t.words.hash[~known], owner[~known]
            if len(h):
                order = np.lexsort((h, owner))
                h, owner = h[order], owner[order]
                at = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (owner[1:] != owner[:-1]))))
                tf = np.diff(np.append(at, len(h)))
                out.append(_rows(ids[owner[at]], None, None, None, None, None, None, h[at].view(np.int64), tf))
        return pa.Table.from_batches(out)

    right = answers.where("chunk is not null").select("chunk", "bucket", "n", "mass", "m", "shares")
    return chunks.groupBy("chunk").cogroup(right.groupBy("chunk")).applyInArrow(run, SCORED)


def _rows(*columns) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.int64()]
    size = len(columns[0])
    arrays = [pa.nulls(size, t) if c is None else c if isinstance(c, pa.Array) else pa.array(c, t)
              for c, t in zip(columns, types, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, [f.split()[0] for f in SCORED.split(", ")])


def score_texts(df: DataFrame, folds: int = 7, fold: int = 2, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row."""
    sc = bounded_batches(df).sparkSession.sparkContext
    rows = df.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = rows.select("doc_id", is_in_fold("doc_id", folds, fold).alias("held_out"), "text")
    teach = rows.where(~F.col("held_out")).select("text")
    counts = written(word_counts(teach), "counts")
    lexicon = lexicon_of(counts, rows.where(~F.col("held_out")).count())
    shared = sc.broadcast(lexicon)
    weights = sc.broadcast(train(written(cell_counts(teach, shared), "cells")))
    buckets = 1 + lexicon.tokens // BUCKET_TOKENS
    chunks = written(chunks_of(rows), "chunks")
    answers = written(answers_of(features_of(chunks, shared, buckets, HOT), PENALTY), "answers")
    cut = sc.broadcast(cut_contexts(answers))
    out = written(scored(chunks, answers, shared, weights, cut, buckets, HOT), "scored")
    rare = out.where("h is not null").select("row", "h", "tf").join(counts.select("h", "n"), "h", "left")
    rare = rare.groupBy("row").agg(F.sum(F.col("tf") * F.log10(F.coalesce("n", F.lit(0)) + 1.0)).alias("logs"),
                                   F.sum(F.when(F.col("n") > 0, F.col("tf"))).alias("known"))
    logs, known = F.coalesce("logs", F.lit(0.0)), F.coalesce("known", F.lit(0))
    base = float(np.log10(lexicon.tokens + lexicon.words + 1.0))
    return out.where("h is null").join(rare, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + known).alias("n_known"),
        F.lit(lexicon.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + logs - F.col("n_tokens") * F.lit(base)).alias("base_score"),
        F.col("model").alias("score"))
