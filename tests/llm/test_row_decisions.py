import corpus_pipeline as cp
from pitwall.llm import quality

from conftest import words

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_rejected_texts_go_without_id_and_with_a_repeated_id(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(*cp.COLUMNS)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    score = {r.doc_id: r.score for r in quality.classify(docs, labels, cp.LEAST_QUALITY).collect()}
    text = {r.doc_id: r.text for r in docs.collect()}
    taught = {r.doc_id for r in labels.collect()}
    bad = min(score, key=score.get)
    good = max((i for i in score if i not in taught), key=score.get, default=max(score, key=score.get))
    more = [(None, text[bad], "en", "a", 1), (None, text[good], "en", "a", 1), (good, text[bad], "en", "a", 1)]
    after = cp.quality_stage(spark, docs.unionByName(spark.createDataFrame(more, SCHEMA)), SF).collect()
    assert [r.text for r in after if r.doc_id is None] == [text[good]]
    assert [r.text for r in after if r.doc_id == good] == [text[good]]


def test_near_copies_without_id_go(spark):
    base = words(90, 1)
    other = base.upper()
    rows = [(1, base, "en", "a", 1), (None, other, "en", "a", 1), (None, words(50, 9), "en", "a", 1), (2, None, "en", "a", 1),
            (None, None, "en", "a", 1)]
    after = cp.near_stage(spark, spark.createDataFrame(rows, SCHEMA).repartition(3), None).collect()
    assert sorted(((r.doc_id, r.text) for r in after), key=str) == sorted(
        [(1, base), (None, words(50, 9)), (2, None), (None, None)], key=str)
