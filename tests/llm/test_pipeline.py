import re
from collections import Counter

import pytest

import corpus_pipeline as cp
from pitwall.llm import mixing
from test_near_stage import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The documents before and after every stage, each written and read again."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in cp.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "out")
        stage(spark, docs, SF).write.parquet(path)
        out.append((docs, spark.read.parquet(path)))
        docs = out[-1][1]
    return dict(zip([n for n, _ in cp.STAGES], out, strict=True))


def rows(df):
    return sorted(map(tuple, df.select("doc_id", "text").collect()))


def test_columns(stages):
    assert len(cp.STAGES) == 5
    for name, (before, after) in list(stages.items())[:-1]:
        assert after.columns == cp.COLUMNS and after.count() > 0


def test_quality_drops_junk_and_keeps_clean_documents(spark, stages):
    before, after = stages["quality"]
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in after.collect()}
    good = [i for i, q in label.items() if q == 1]
    assert set(kept) <= {r.doc_id for r in before.collect()}
    assert sum(i in kept for i in good) >= 0.97 * len(good)
    assert sum(i in kept for i, q in label.items() if q == 0) <= 0.2 * sum(q == 0 for q in label.values())


def test_exact_copies_go(stages):
    before, after = stages["exact_dedup"]
    first = {}
    for i, t in rows(before):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), (i, t))
    assert rows(after) == sorted(first.values())


def test_near_copies_go(stages):
    before, after = stages["near_dedup"]
    assert [i for i, _ in rows(after)] == brute(rows(before), 80)


def test_mixing_repeats_whole_rows(stages):
    before, after = stages["mixing"]
    text = dict(rows(before))
    count = Counter(i for i, _ in rows(after))
    assert all(text[i] == t for i, t in rows(after))
    assert count == Counter(r.doc_id for r in mixing.mix(before.select("doc_id", "source"), seed=cp.SEED).collect())


def test_tokens_round_trip(stages):
    before, after = stages["bpe"]
    got = after.collect()
    assert len(got) == before.count() and all(r.round_trip and r.n_tokens == len(r.ids) for r in got)


def test_odd_rows_pass_all_stages(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for name, stage in cp.STAGES:
            docs = stage(spark, docs, SF)
            if name == "exact_dedup":
                assert docs.where("doc_id = 2").count() <= 1
        assert docs.where("not round_trip").count() == 0


def test_of_rows_that_repeat_an_id_and_text_the_smallest_stays(spark):
    rows = [(1, "a  b", "en", "s", 4), (1, "a b", "fr", "t", 3), (1, "a b", "en", "u", 3), (2, "a b", "de", "s", 3), (None, None, "en", None, None), (None, "", "en", "z", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for parts in (1, 5):
        got = sorted(map(tuple, cp.exact_stage(spark, docs.repartition(parts), SF).collect()), key=str)
        assert got == sorted([(1, "a  b", "en", "s", 4), (None, None, "en", None, None)], key=str)
