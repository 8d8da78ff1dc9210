from collections import Counter

from pitwall.llm import op9

SF = "/root/testdata/sf0.001"


def test_the_mixture_holds_whole_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    whole = {r.doc_id: tuple(r) for r in docs.collect()}
    got = op9.QUERIES["op9_mix_documents"](spark, SF)
    assert got.columns == [*docs.columns, "copy", "copies", "shuffle_key"]
    rows = got.collect()
    assert all(tuple(r)[:len(docs.columns)] == whole[r.doc_id] for r in rows)
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in op9.op9_mix_sources(spark, SF).collect())
