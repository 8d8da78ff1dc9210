from pitwall.llm import near


def test_a_three_word_text_alone_in_its_partition(spark):
    for n in range(7):
        text = " ".join("abcdefg"[:n])
        row = spark.createDataFrame([(n, text)], "doc_id long, text string").coalesce(1)
        assert [tuple(r) for r in near.near_components(row).collect()] == [(n, min(n, 1) if n < 5 else n - 4, n, True)]
