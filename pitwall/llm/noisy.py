"""Noisy-channel restoration of disguised words: character lattices under a character language model.

A token is a run without white space; separators at its edges don't belong to it.  A token of
letters alone has a single path through its lattice and stands for itself.  The others are
decoded: each character is a *cell* with alternatives and their channel costs (in nats):

* a letter stands for itself;
* a digit stands for itself or for a letter that looks like it, as ``$ @ ! | + (`` do, which
  otherwise part words;
* any other character parts two words, or is nothing (``i.d.i.o.t``);
* three or more tokens of one character in a row are one spaced word, whose gaps part words or
  are nothing (``i d i o t``);
* a letter three or more times in a row is one or two of it.

The best path by channel costs plus an interpolated four-gram character model is found by a
Viterbi pass over all distinct tokens of a block at once; states are the last three symbols.
A token or spaced word of more than ``WINDOW`` characters is decoded window by window.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwall.llm.common import _LOWER, _SPACE, bounded_batches, flat_texts, text_blocks

#: Symbols: 0 word boundary, 1-26 letters, 27 a byte of any other letter, 28 a digit.
SYMBOLS, OTHER, DIGIT = 29, 27, 28
STATES = SYMBOLS**3
#: Letters that a character may stand for.
LOOKS_LIKE = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
              "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c"}
#: Channel costs: a look-alike, a symbol that parts words, an inner separator that does or is
#: nothing, a gap of a spaced word that does or is nothing, a repeated letter kept or not.
LIKE, PART, APART, JOINED, GAP, CLOSED, TWICE, ONCE = 1.5, 1.0, 0.5, 2.0, 1.5, 0.5, 1.0, 0.2
WINDOW = 96
#: Tokens of one character that make a spaced word.
SPACED = 3

_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_LETTER[128:] = True
_DIGITS = np.zeros(256, bool)
_DIGITS[48:58] = True
_HEAD = _LETTER | _DIGITS
_HEAD[[ord(c) for c in "$@!"]] = True
_TAIL = _LETTER | _DIGITS
_TAIL[[ord(c) for c in "$@"]] = True
_SINGLE = _HEAD.copy()
_SINGLE[128:] = False

_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[97:123] = np.arange(1, 27)
_SYMBOL[128:] = OTHER
_SYMBOL[48:58] = DIGIT


def _alternatives() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per cell kind (byte, or 256 + byte for a repeated letter): number, symbols, costs and output bytes.

    Symbol -1 is nothing; output byte 0 is none.
    """
    table: list[list[tuple[int, float, int]]] = []
    for b in range(256):
        c = chr(b)
        if _LETTER[b]:
            ways = [(int(_SYMBOL[b]), 0.0, b)]
        elif _DIGITS[b]:
            ways = [(DIGIT, 0.0, b)] + [(ord(x) - 96, LIKE, ord(x)) for x in LOOKS_LIKE.get(c, "")]
        elif c == " ":
            ways = [(0, GAP, 32), (-1, CLOSED, 0)]
        elif c in LOOKS_LIKE:
            ways = [(0, PART, 32)] + [(ord(x) - 96, LIKE, ord(x)) for x in LOOKS_LIKE[c]]
        else:
            ways = [(0, APART, 32), (-1, JOINED, 0)]
        table.append(ways)
    table += [[(int(_SYMBOL[b]), TWICE, b), (-1, ONCE, 0)] for b in range(256)]
    most = max(map(len, table))
    number = np.array([len(w) for w in table])
    grid = np.array([[w[j] if j < len(w) else (0, 0.0, 0) for j in range(most)] for w in table])
    return number, grid[:, :, 0].astype(np.int64), grid[:, :, 1], grid[:, :, 2].astype(np.uint8)


_NUMBER, _TO, _COST, _OUT = _alternatives()


def gathered(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indexes of all positions of some ranges, range after range."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


class Tokens:
    """Tokens of a block of texts without their edge separators: text, span, and which are plain."""

    def __init__(self, data: np.ndarray, off: np.ndarray) -> None:
        self.data = data = _LOWER[data]
        n = len(data)
        first = np.zeros(n + 1, bool)
        first[off] = True
        space = _SPACE[data]
        word = ~space
        start, end = word.copy(), word.copy()
        start[1:] &= space[:-1] | first[1:n]
        end[:-1] &= space[1:] | first[1:n]
        a, b = np.flatnonzero(start), np.flatnonzero(end) + 1
        letters = np.concatenate(([0], np.cumsum(_LETTER[data], dtype=np.int32)))
        solid = np.concatenate(([0], np.cumsum(_LETTER[data] | _DIGITS[data], dtype=np.int32)))
        real = solid[b] > solid[a]
        a, b = a[real], b[real]
        heads, tails = np.flatnonzero(_HEAD[data]), np.flatnonzero(_TAIL[data])
        self.start = heads[np.searchsorted(heads, a)] if len(a) else a
        self.end = tails[np.searchsorted(tails, b) - 1] + 1 if len(b) else b
        self.text = np.searchsorted(off, self.start, "right") - 1
        thrice = np.zeros(n, bool)
        if n > 2:
            thrice[2:] = (data[2:] == data[1:-1]) & (data[1:-1] == data[:-2]) & _LETTER[data[2:]] & (data[2:] < 128)
        runs = np.concatenate(([0], np.cumsum(thrice, dtype=np.int32)))
        size = self.end - self.start
        self.letters = letters[self.end] - letters[self.start] == size
        self.plain = self.letters & ((size < 3) | (runs[self.end] - runs[np.minimum(self.start + 2, self.end)] == 0))
        self.digits = (size > 0) & (solid[self.end] - solid[self.start] == size) & (letters[self.end] == letters[self.start])
        # spaced words: runs of tokens of one character
        one = (size == 1) & _SINGLE[data[self.start]] if len(size) else np.zeros(0, bool)
        m = len(one)
        begin = one.copy()
        begin[1:] &= ~one[:-1] | (self.text[1:] != self.text[:-1])
        run = np.cumsum(begin)
        long = np.bincount(run[one], minlength=(run[-1] if m else 0) + 1) >= SPACED
        self.spaced = one & long[run] if m else one
        self.run = run


def symbols_of(tokens: Tokens) -> np.ndarray:
    """Plain words and numbers as symbols, each followed by a boundary."""
    take = np.flatnonzero((tokens.plain | tokens.digits) & ~tokens.spaced)
    starts, sizes = tokens.start[take], tokens.end[take] - tokens.start[take]
    # the byte behind a token becomes the boundary
    at = gathered(starts, sizes + 1)
    out = _SYMBOL[np.append(tokens.data, 0)[at]]
    out[np.cumsum(sizes + 1) - 1] = 0
    return out


def four_grams(symbols: np.ndarray) -> np.ndarray:
    """Counts of (three symbols before, symbol); before a word's first symbol are boundaries."""
    s = symbols
    p1, p2, p3 = (np.concatenate((np.zeros(min(k, len(s)), np.int64), s[:-k])) for k in (1, 2, 3))
    p2 = np.where(p1 == 0, 0, p2)
    p3 = np.where(p2 == 0, 0, p3)
    return np.bincount(((p3 * SYMBOLS + p2) * SYMBOLS + p1) * SYMBOLS + s, minlength=SYMBOLS**4)


def character_counts(texts: DataFrame) -> np.ndarray:
    """Four-gram counts of all words of the column ``text``, added up by Spark (29^4 cells at most)."""

    def run(batches):
        total = np.zeros(SYMBOLS**4, np.int64)
        for batch in batches:
            for _, _, part, cuts in text_blocks(*flat_texts(batch.column(0))):
                total += four_grams(symbols_of(Tokens(part, cuts)))
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total[cells])], ["cell", "n"])

    cells = bounded_batches(texts).select("text").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(SYMBOLS**4, np.int64)
    out[cells["cell"].to_numpy(np.int64)] = cells["n"].to_numpy(np.int64)
    return out


def character_model(counts: np.ndarray) -> np.ndarray:
    """Costs -log P(symbol | last three), interpolated from four-grams down to equal chances (Witten-Bell)."""
    p = np.full((1, SYMBOLS), 1.0 / SYMBOLS)
    for order in range(1, 5):
        n = counts.reshape(-1, SYMBOLS**(order - 1), SYMBOLS).sum(axis=0).astype(np.float64)
        total, kinds = n.sum(axis=1, keepdims=True), (n > 0).sum(axis=1, keepdims=True)
        lower = np.tile(p, (len(n) // len(p), 1))
        p = np.where(total > 0, (n + kinds * lower) / np.maximum(total + kinds, 1), lower)
    return -np.log(p).astype(np.float32)


def decoded(data: np.ndarray, off: np.ndarray, costs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The best reading of each (distinct) string, as (bytes, offsets); words are apart by one blank."""
    n = len(off) - 1
    unit = np.repeat(np.arange(n), np.diff(off))
    # runs of a letter: all but two of three or more go, the second may
    fresh = np.ones(len(data), bool)
    fresh[1:] = (data[1:] != data[:-1]) | (unit[1:] != unit[:-1]) | ~_LETTER[data[1:]] | (data[1:] >= 128)
    head = np.flatnonzero(fresh)
    size = np.diff(np.append(head, len(data)))
    place, long = np.arange(len(data)) - np.repeat(head, size), np.repeat(size >= 3, size)
    kept = ~long | (place < 2)
    cell = data.astype(np.int64) + 256 * (long & (place == 1))
    cell, unit = cell[kept], unit[kept]
    length = np.bincount(unit, minlength=n)
    first = np.cumsum(length) - length
    by_length = np.argsort(-length, kind="stable")
    deepest = int(length.max()) if n else 0
    out = np.zeros((n, deepest), np.uint8)
    # live states: unit, state, cost; per step where each came from and what it put out
    live_unit, live_state, live_cost = np.arange(n), np.zeros(n, np.int64), np.zeros(n)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    best, score = np.full(n, -1), np.full(n, np.inf)
    ends: list[np.ndarray] = []
    for t in range(deepest + 1):
        # strings that end here: the boundary behind them counts
        over = length[live_unit] == t
        finish = live_cost + np.where(live_state == 0, 0.0, costs[live_state, 0])
        at = np.flatnonzero(over)
        order = at[np.lexsort((finish[at], live_unit[at]))]
        if len(order):
            lead = np.ones(len(order), bool)
            lead[1:] = live_unit[order][1:] != live_unit[order][:-1]
            order = order[lead]
            best[live_unit[order]], score[live_unit[order]] = order, finish[order]
        ends.append(live_unit[order])
        if t == deepest:
            break
        on = np.flatnonzero(~over)
        kind = cell[first[live_unit[on]] + t]
        ways = _NUMBER[kind]
        source = np.repeat(on, ways)
        kind = np.repeat(kind, ways)
        way = np.arange(len(source)) - np.repeat(np.cumsum(ways) - ways, ways)
        to, state = _TO[kind, way], live_state[source]
        silent = (to < 0) | ((to == 0) & (state == 0))
        cost = live_cost[source] + _COST[kind, way] + np.where(silent, 0.0, costs[state, np.maximum(to, 0)])
        state = np.where(silent, state, np.where(to == 0, 0, (state % SYMBOLS**2) * SYMBOLS + to))
        put = np.where(silent, 0, _OUT[kind, way])
        key = live_unit[source] * STATES + state
        order = np.lexsort((cost, key))
        lead = np.ones(len(order), bool)
        lead[1:] = key[order][1:] != key[order][:-1]
        order = order[lead]
        steps.append((source[order], put[order]))
        live_unit, live_state, live_cost = live_unit[source[order]], state[order], cost[order]
    # back along the best paths
    at = np.full(n, -1)
    at[ends[deepest]] = best[ends[deepest]]
    for t in range(deepest - 1, -1, -1):
        running = np.flatnonzero(at >= 0)
        source, put = steps[t]
        out[running, t] = put[at[running]]
        at[running] = source[at[running]]
        at[ends[t]] = best[ends[t]]
    filled = out != 0
    sizes = filled.sum(axis=1)
    return out[filled], np.concatenate(([0], np.cumsum(sizes)))


def restored(data: np.ndarray, off: np.ndarray, costs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts of a block in lower case, restored, as (bytes, offsets); a blank follows each word."""
    tokens = Tokens(data, off)
    size = tokens.end - tokens.start
    n_texts = len(off) - 1
    pool = np.append(tokens.data, np.uint8(32))
    blank = len(tokens.data)
    m = len(size)
    if not m:
        return np.zeros(0, np.uint8), np.zeros(n_texts + 1, np.int64)
    # a token of a spaced word that repeats the two before it says nothing new
    letter = tokens.data[tokens.start]
    again = np.zeros(m, bool)
    again[2:] = (letter[2:] == letter[1:-1]) & (letter[1:-1] == letter[:-2]) & (tokens.run[2:] == tokens.run[:-2])
    again &= tokens.spaced
    spaced = np.flatnonzero(tokens.spaced & ~again)
    other = np.flatnonzero(~tokens.plain & ~tokens.spaced)
    # windows of the odd tokens; windows of spaced words go by their tokens
    pieces = -(-size[other] // WINDOW)
    o_token = np.repeat(other, pieces)
    o_place = np.arange(len(o_token)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    o_start = tokens.start[o_token] + o_place * WINDOW
    o_size = np.minimum(tokens.end[o_token] - o_start, WINDOW)
    run = tokens.run[spaced]
    lead = np.ones(len(run), bool)
    lead[1:] = run[1:] != run[:-1]
    place = np.arange(len(run)) - np.repeat(np.flatnonzero(lead), np.diff(np.append(np.flatnonzero(lead), len(run))))
    lead |= place % (WINDOW // 2) == 0
    s_unit = np.cumsum(lead) - 1
    closing = np.append(lead[1:], True) if len(lead) else lead
    # segments of the odd strings: odd windows first, then the letters and gaps of spaced words
    s_start = np.column_stack((tokens.start[spaced], np.full(len(spaced), blank))).ravel()
    s_size = np.column_stack((np.ones(len(spaced), np.int64), np.where(closing, 0, 1))).ravel()
    stream = pool[gathered(np.concatenate((o_start, s_start)), np.concatenate((o_size, s_size)))]
    sizes = np.concatenate((o_size, np.bincount(s_unit, minlength=int(s_unit[-1]) + 1 if len(s_unit) else 0)
                            + np.bincount(s_unit, ~closing, int(s_unit[-1]) + 1 if len(s_unit) else 0).astype(np.int64)))
    owner = np.concatenate((o_token, spaced[lead]))
    if len(owner):
        ends = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
        odd = pa.BinaryArray.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(stream.tobytes())]).dictionary_encode()
        words, cuts = decoded(*flat_texts(odd.dictionary), costs)
        index = odd.indices.to_numpy()
        d_start, d_size = cuts[index] + len(pool), np.diff(cuts)[index]
        pool = np.concatenate((pool, words))
    else:
        d_start = d_size = np.zeros(0, np.int64)
    plain = np.flatnonzero(tokens.plain & ~tokens.spaced)
    # all words in order of their tokens, a blank behind each
    token = np.concatenate((plain, owner))
    start, length = np.concatenate((tokens.start[plain], d_start)), np.concatenate((size[plain], d_size))
    order = np.argsort(token, kind="stable")
    token, start, length = token[order], start[order], length[order]
    # windows of one token and of one spaced word stay together
    same = np.zeros(len(token), bool)
    same[:-1] = (token[1:] == token[:-1]) | (tokens.spaced[token[1:]] & tokens.spaced[token[:-1]] & (tokens.run[token[1:]] == tokens.run[token[:-1]]))
    starts = np.column_stack((start, np.full(len(start), blank))).ravel()
    lengths = np.column_stack((length, np.where(same, 0, 1))).ravel()
    result = pool[gathered(starts, lengths)]
    per_text = np.bincount(tokens.text[token], length + ~same, n_texts).astype(np.int64)
    return result, np.concatenate(([0], np.cumsum(per_text)))
