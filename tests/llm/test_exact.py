import re
from collections import defaultdict

import numpy as np

from pitwall.llm import exact


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    out = []
    for ids in groups.values():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        out += [(i, keep, len(ids), k == ids.index(keep)) for k, i in enumerate(ids)]
    return sorted(out, key=str)


def test_odd_rows(odd_docs, no_docs):
    rows = exact.dedup(odd_docs).select("doc_id", "keep_id", "group_size", "kept").collect()
    assert sorted(map(tuple, rows), key=str) == brute(odd_docs.select("doc_id", "text").collect())
    assert exact.dedup(no_docs).collect() == []


def test_one_row_stays_of_rows_that_repeat_an_id(spark):
    rows = [(1, "a b"), (1, "a  b"), (1, "a b"), (2, "a b"), (None, "alone"), (None, "alone"), (5, "x"), (5, "y"), (None, None), (None, "")]
    got = exact.dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).select("doc_id", "keep_id", "group_size", "kept").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)
    assert sum(r.kept for r in got) == 5


def test_several_buckets_and_nonmembers(spark, monkeypatch):
    monkeypatch.setattr(exact, "BUCKET_DIGESTS", 7)
    rows = [(i, f"text {i % 60 if i < 130 else i}") for i in range(200)]
    found = exact.dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, found.select("doc_id", "keep_id", "group_size", "kept").collect()), key=str) == brute(rows)
    assert {r.member for r in found.select("member").collect()} == {True, False}


def test_the_hash_is_minimal_and_perfect():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 1000):
        keys = rng.integers(0, 256, (n, 32), dtype=np.uint8)
        ph = exact.PerfectHash.build(keys)
        assert sorted(ph.slots(keys).tolist()) == list(range(n))
        assert (ph.slots(rng.integers(0, 256, (50, 32), dtype=np.uint8)) < max(n, 1)).all()


def test_keys_that_clash_on_every_level(monkeypatch):
    monkeypatch.setattr(exact, "LEVELS", 1)
    keys = np.random.default_rng(2).integers(0, 256, (300, 32), dtype=np.uint8)
    ph = exact.PerfectHash.build(keys)
    assert len(ph.tail) and sorted(ph.slots(keys).tolist()) == list(range(300))


def test_a_digest_that_shares_a_slot_is_no_member(spark):
    history = spark.createDataFrame([(bytes([1]) * 32, 5, 2)], "digest binary, winner long, copies long")
    incoming = spark.createDataFrame([(bytes([k]) * 32, 10 + k, 1) for k in range(4)], "digest binary, winner long, copies long")
    rows = exact.resolve(incoming, exact.build_index(history, 1), 1).collect()
    assert sorted((r.digest[0], r.winner, r.copies, r.member) for r in rows) == [
        (0, 10, 1, False), (1, 5, 3, True), (2, 12, 1, False), (3, 13, 1, False)]
