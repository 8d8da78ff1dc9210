"""Operator 13 against a plain count."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from pitwall.llm import phrases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, longest, least, top=None):
    f, n = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall(r"[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f.setdefault(lang, Counter()).update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        kept = {p: a for p, a in counts.items() if a >= least and len(p) > 1}
        mine = []
        for p, a in kept.items():
            if any(len(q) > len(p) and 100 * b >= 100 * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
                   for q, b in kept.items()):
                continue
            score, k = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            mine.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(mine)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def got(df):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


@pytest.fixture(scope="module")
def texts():
    rnd = np.random.default_rng(4)
    vocabulary = ["the", "a", "of", "Été", "NOW", "x", "y", "漢字", "don't", "e-mail"]
    rows = []
    for i in range(300):
        words = [vocabulary[j] for j in rnd.integers(0, len(vocabulary), rnd.integers(0, 60))]
        for cut in rnd.integers(0, 60, 4):
            if cut < len(words):
                words[cut] += rnd.choice([".", ", ", "!?", "\n", "\r", ";\t", " \t ", ":"])
        rows.append((["en", "de", None, "two words\nof lang"][i % 4], " ".join(words)))
    rows += [("en", "in a row of five words that repeat")] * 40  # repeated rows and contained phrases
    rows += [("en", None), ("en", ""), (None, " \t. ,\n"), ("fr", "alone"), ("en", "word " * 5000)]
    return rows


@pytest.mark.parametrize("bucket,chunk", [(1 << 20, 4 << 20), (40, 2000), (3, 10)])
def test_counts_and_scores(spark, texts, monkeypatch, bucket, chunk):
    """Whole, and in many small chunks and buckets."""
    monkeypatch.setattr(phrases, "BUCKET", bucket)
    rows = texts if bucket > 3 else texts[:60]
    least = 12 if bucket > 3 else 4
    docs = spark.createDataFrame([(i, lang, t, "a", 1, "b") for i, (lang, t) in enumerate(rows)],
                                 "doc_id long, lang string, text string, code string, f int, chunk string").repartition(3)
    if chunk < 4 << 20:
        monkeypatch.setattr(phrases, "CHUNK_BYTES", chunk)
    assert got(phrases.collocations(docs, least=least, top=None)) == plain(rows, 5, least)
    assert got(phrases.collocations(docs, longest=3, least=least, top=7)) == plain(rows, 3, least, 7)


def test_products_beyond_64_bits(spark):
    """Exact whole numbers, where a double would round."""
    frame = spark.sql("select cast(10000000000019 as long) a, cast(10000000000037 as long) l, cast(90000000000053 as long) r, "
                      "cast(99999999999999 as long) n")
    d = lambda c: f"cast({c} as decimal(19,0))"
    row = frame.selectExpr(f"cast(cast(1000 as decimal(4,0)) * {d('a')} * {d('n')} as decimal(38,0)) div cast({d('l')} * {d('r')} as decimal(38,0)) s").first()
    assert row["s"] == 1000 * 10000000000019 * 99999999999999 // (10000000000037 * 90000000000053)


def test_odd_and_empty_tables(spark, odd_docs, no_docs):
    rows = [(r["lang"], r["text"]) for r in odd_docs.select("lang", "text").collect()]
    assert got(phrases.collocations(odd_docs, least=3, top=None)) == plain(rows, 5, 3)
    assert got(phrases.collocations(no_docs)) == []


def test_packed_numbers():
    for x in (np.array([], np.int64), np.array([0, -1, 2**31 - 1, -2**31]), np.arange(1000)):
        assert phrases.unpacked(phrases.packed(x)).tolist() == x.tolist()
    far = np.array([2**62, -2**62, 0])
    assert phrases.unpacked(phrases.packed(far, "<i8"), "<i8").tolist() == far.tolist()
    words = phrases.Words(pa.array(["a", "é", "漢"]), "two\nlines")
    again = phrases.Words.load(words.payload())
    assert (again.words.to_pylist(), again.lang) == (["a", "é", "漢"], "two\nlines")


def test_chunks_are_of_one_language(spark, monkeypatch):
    """Languages that take turns make no more chunks than their texts fill."""
    monkeypatch.setattr(phrases, "CHUNK_BYTES", 2000)
    rows = [(["en", "de", "fr", "es"][i % 4], "one two three four " * 5) for i in range(400)]
    docs = spark.createDataFrame(rows, "lang string, text string").coalesce(1)
    found = phrases.chunks(docs).groupBy("lang").count().collect()
    assert all(r["count"] <= -(-100 * 95 // 1900) + 1 for r in found) and len(found) == 4


def test_small_slices_are_added_together(monkeypatch):
    """A bucket's keys are sorted a few times, however many slices they come in."""
    monkeypatch.setattr(phrases, "GATHERED", 1000, raising=False)
    sorts, changes = [], phrases._changes
    monkeypatch.setattr(phrases, "_changes", lambda f, l: sorts.append(len(f)) or changes(f, l))
    rnd = np.random.default_rng(2)
    rows, total = [], {}
    for chunk in range(800):
        keys = np.unique(rnd.integers(0, 40, (8, 2)), axis=0)
        counts = rnd.integers(1, 5, len(keys))
        for k, c in zip(map(tuple, keys.tolist()), counts.tolist(), strict=True):
            total[k] = total.get(k, 0) + c
        rows.append({"bucket": 3, "chunk": str(chunk), "place": 0, "keys": phrases.Pairs(keys[:, 0].copy(), keys[:, 1].copy()).payload(),
                     "counts": phrases.packed(counts)})
    out = [r for b in phrases._added(rows, phrases.Pairs, 3, 7, 12) for r in b.to_pylist()]
    groups = {(r["first"], r["last"]): r for r in out if r["chunk"] is None}
    assert {k: r["f"] for k, r in groups.items()} == {k: f for k, f in total.items() if f >= 12}
    for r in (r for r in out if r["chunk"] is not None):
        own = phrases.Pairs.load(rows[int(r["chunk"])]["keys"])
        own = own.take(own.order())
        codes = [groups[k]["code"] if k in groups else -1 for k in zip(own.first.tolist(), own.last.tolist(), strict=True)]
        assert phrases.unpacked(r["keys"], "<i8").tolist() == codes
    assert len(sorts) < 40
