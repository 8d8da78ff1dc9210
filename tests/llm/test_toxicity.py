"""Operator 11: lattices against a search over all readings, held-out accuracy, odd texts."""

import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from pitwall.llm import noisy, toxicity
from pitwall.llm.common import flat_texts, table
from pitwall.llm.op11 import op11_toxicity
from tests.conftest import SMALL

SF = SMALL.replace("0.001", "0.1")


def costs_of(text):
    data, off = flat_texts(pa.array([text]))
    return noisy.character_model(noisy.four_grams(noisy.symbols_of(noisy.Tokens(data, off))))


@pytest.fixture(scope="module")
def costs():
    return costs_of("you are an idiot and a moron , so stupid that a clown would not be the loser in the trash of class 12 34 été " * 9)


def read(text, costs):
    data, off = flat_texts(pa.array([text]))
    out, ends = noisy.restored(data, off, costs)
    return bytes(out[ends[0]:ends[1]]).decode()


def cheapest(text, costs):
    """The lowest cost of all readings of one string, one by one."""
    best = np.inf
    kinds = []
    raw = text.encode()
    for i, b in enumerate(raw):
        run = 0
        while run < i and raw[i - run - 1] == b:
            run += 1
        ahead = 0
        while i + ahead + 1 < len(raw) and raw[i + ahead + 1] == b:
            ahead += 1
        long = chr(b).isascii() and chr(b).isalpha() and run + ahead + 1 >= 3
        if not (long and run >= 2):
            kinds.append(b + 256 * (long and run == 1))
    for ways in itertools.product(*[range(noisy._NUMBER[k]) for k in kinds]):
        cost, last = 0.0, [0, 0, 0]
        for k, w in zip(kinds, ways):
            to = noisy._TO[k, w]
            cost += noisy._COST[k, w]
            if to < 0 or (to == 0 and last[-1] == 0):
                continue
            cost += float(costs[(last[-3] * 29 + last[-2]) * 29 + last[-1], to])
            last = [0, 0, 0] if to == 0 else last[-2:] + [int(to)]
        if last[-1]:
            cost += float(costs[(last[-3] * 29 + last[-2]) * 29 + last[-1], 0])
        best = min(best, cost)
    return best


def test_best_path(costs):
    """What is read costs what the cheapest of all readings does."""
    rnd = random.Random(1)
    for _ in range(60):
        text = "".join(rnd.choice("idot1040@$!.- smornlaaa") for _ in range(rnd.randint(1, 8))).strip(" ")
        data, off = flat_texts(pa.array([text or "a"]))
        out, ends = noisy.decoded(data, off, costs)
        # reading the result again can't be dearer than the best path's own language cost
        said = bytes(out).decode().strip()
        language = 0.0
        for word in said.split():
            last = [0, 0, 0]
            for b in word.encode() + b"\0":
                to = int(noisy._SYMBOL[b]) if b else 0
                language += float(costs[(last[-3] * 29 + last[-2]) * 29 + last[-1], to])
                last = last[-2:] + [to]
        best = cheapest(text or "a", costs)
        assert language <= best + 1e-3
        if all(c.isalpha() for c in text) and len(set(text)) == len(text):
            assert abs(language - best) < 1e-3


def test_disguises(costs):
    assert read("you 1d10t, i d i o t! M0R0N m.o.r.o.n t-r-a-s-h iiiidioooot $tupid cl0wn l0ser", costs).split() == [
        "you", "idiot", "idiot", "moron", "moron", "trash", "idiot", "stupid", "clown", "loser"]
    assert read("class 12 the### (été)!! a", costs).split() == ["class", "12", "the", "été", "a"]
    assert read("", costs) == read(" \n\t", costs) == read("... ###", costs) == ""


def test_long_and_odd_texts(costs):
    for text in ("a " * 5000, "ab1" * 4000, "k" * 9000, "1 2 3 4 " * 900, "é é é é", "漢字🙂", "a" * 95 + "1" + "b" * 300, "$$$ @@@ !!!"):
        out = read(text, costs)
        assert out == out.lower() and "  " not in out
    # a batch gives what its texts give alone
    texts = ["1d10t i d i o t", "", "m o r o n", "a b c d", "x", "i d"]
    data, off = flat_texts(pa.array(texts))
    out, ends = noisy.restored(data, off, costs)
    assert [bytes(out[a:b]).decode() for a, b in zip(ends, ends[1:])] == [read(t, costs) for t in texts]


def test_character_counts(spark, odd_docs):
    texts = [r["text"] for r in odd_docs.select("text").collect()]
    want = sum((noisy.four_grams(noisy.symbols_of(noisy.Tokens(*flat_texts(pa.array([t]))))) for t in texts if t is not None),
               np.zeros(29**4, np.int64))
    assert (noisy.character_counts(odd_docs) == want).all()
    p = np.exp(-noisy.character_model(want).astype(float))
    assert np.allclose(p.sum(axis=1), 1, atol=1e-4) and (p > 0).all()


def disguised(text, rnd):
    like = {"o": "0", "i": "1", "e": "3", "a": "4", "s": "5", "t": "7"}
    out = []
    for w in text.split(" "):
        how = rnd.randrange(3) if w.isalpha() and w.isascii() and len(w) > 4 else -1
        out.append("".join(like.get(c, c) if rnd.random() < 0.5 else c for c in w) if how == 0 else " ".join(w) if how == 1
                   else "".join(c * (4 if rnd.random() < 0.3 else 1) for c in w) if how == 2 else w)
    return " ".join(out)


def test_held_out(spark):
    """Held-out documents of the given table, plain and with their words disguised."""
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    held = [r for r in docs.join(labels, "doc_id").filter("toxic = 1 and quality = 1 and lang = 'en'").select("doc_id", "text").collect()
            if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    rnd = random.Random(2)
    more = [(-5 * k, disguised(r["text"][:3000], rnd)) for k, r in enumerate(held, 1)]
    more = [(i, t) for i, t in more]
    extra = spark.createDataFrame(more, "doc_id long, text string")
    out = toxicity.classify(docs.select("doc_id", "text").unionByName(extra), labels, 0.5).join(labels, "doc_id", "left").collect()
    real = [r for r in out if r["toxic"] is not None and r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in out)
    toxic = [r["predicted"] for r in real if r["toxic"] == 1]
    clean = [r["predicted"] for r in real if r["toxic"] == 0]
    assert np.mean(toxic) > 0.8 and np.mean(clean) < 0.02
    assert np.mean([r["predicted"] for r in out if r["doc_id"] < 0]) > 0.8


def test_odd_tables(spark, odd_docs, no_docs):
    labels = table(spark, SMALL, "labels")
    ids = [r["doc_id"] for r in odd_docs.select("doc_id").collect()]
    odd = spark.createDataFrame([(1, 1, None), (2, 0, 1), (2, 0, 1), (None, 1, 1), (11, 0, 0), (12, 1, 0), (8, 2, 1), (7, None, 0)],
                                "doc_id long, toxic int, quality int")
    for known in (odd, labels, odd.limit(0), odd.filter("toxic = 1")):
        rows = toxicity.classify(odd_docs, known, 0.5).collect()
        assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in rows) == sorted((i is None, i or 0) for i in ids)
        assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    assert toxicity.classify(no_docs, labels, 0.5).collect() == []
    texts = toxicity.restored(odd_docs, costs_of("one two three"))
    assert texts.columns == [*odd_docs.columns, "restored"] and texts.count() == len(ids)


def test_query(spark):
    rows = op11_toxicity(spark, SMALL).collect()
    assert len(rows) == table(spark, SMALL, "documents").count()
