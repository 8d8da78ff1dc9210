import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pitwall.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def coder():
    return bpe.Coder(PATH)


def reference(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_any_text_as_the_library(text):
    c = bpe.coder(PATH)
    ids = c.encode([text])[0]
    assert ids.tolist() == reference(text)
    assert c.decode(ids) == LIBRARY.decode(reference(text), skip_special_tokens=False)


def test_texts_that_greedy_matching_gets_wrong(coder):
    rnd = random.Random(7)
    texts = ["".join(rnd.choice("theinaorsl eé12.'") for _ in range(rnd.randint(0, 120))) for _ in range(800)]
    before = coder.repaired
    assert [x.tolist() for x in coder.encode(texts)] == [reference(t) for t in texts]
    assert coder.repaired > before


def test_compatibility_is_the_exact_test_for_pairs(coder):
    v = coder.vocabulary
    rnd = random.Random(3)
    tokens = [i for i in v.match.values() if len(v.bytes[i]) <= 4]
    a, b = (np.array([rnd.choice(tokens) for _ in range(4000)]) for _ in range(2))
    exact = [v.merge(v.bytes[x] + v.bytes[y]) == [x, y] for x, y in zip(a.tolist(), b.tolist(), strict=True)]
    assert v.compatible(a, b).tolist() == exact


def test_heap_and_scan_merge_alike(coder, monkeypatch):
    rnd = random.Random(5)
    texts = [bytes(rnd.choice(b"aeinrst e") for _ in range(rnd.randint(1, 48))) for _ in range(300)]
    scanned = [coder.vocabulary.merge(t) for t in texts]
    monkeypatch.setattr(bpe, "SCAN_BYTES", 0)
    assert [coder.vocabulary.merge(t) for t in texts] == scanned


def test_a_full_memo_changes_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_WORDS", 5)
    c = bpe.Coder(PATH)
    texts = ["one two three four five six seven", "two seven nine", "w" * 70 + " one", "<|endoftext|>"] * 3
    for _ in range(3):
        assert [x.tolist() for x in c.encode(texts)] == [reference(t) for t in texts]


def test_round_trip_of_odd_rows(spark, odd_docs):
    rows = bpe.digests(bpe.round_trip(odd_docs, PATH)).collect()
    want = sorted((d.doc_id or 0, len(reference(d.text or "")), hashlib.sha256(",".join(map(str, reference(d.text or ""))).encode()).hexdigest(),
                   hashlib.sha256(LIBRARY.decode(reference(d.text or ""), skip_special_tokens=False).encode()).hexdigest())
                  for d in odd_docs.select("doc_id", "text").collect())
    assert sorted((r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows) == want


def test_encode_then_decode_and_extra_columns(spark, odd_docs, no_docs):
    out = bpe.decode(bpe.encode(odd_docs, PATH), PATH)
    assert out.count() == odd_docs.count() and set(odd_docs.columns) <= set(out.columns)
    assert all(r.decoded == (r.text or "") for r in out.select("text", "decoded").collect())
    assert bpe.decode(bpe.encode(no_docs, PATH), PATH).collect() == []
    ids = spark.createDataFrame([(None,), ([],), ([50256, 0],), ([-5, 10**6, 0],)], "ids array<int>")
    assert [r.decoded for r in bpe.decode(ids, PATH).collect()] == ["", "", "<|endoftext|>!", "!"]
