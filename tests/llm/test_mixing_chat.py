import math
from collections import Counter

from pyspark.sql import functions as F

from pitwall.llm import chat, mixing


def test_counts_follow_the_distribution(spark):
    rows = spark.range(20000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 5 == 0, "s").otherwise("big").alias("source"))
    got = mixing.mix(rows, {"s": 3.0, "big": 1.0}, total=16000).collect()
    per = Counter((r.source, r.doc_id) for r in got)
    for source, n, rate in (("s", 4000, 3.0), ("big", 16000, 0.25)):
        counts = Counter(k for (s, _), k in per.items() if s == source)
        counts[0] = n - sum(counts.values())
        for k in range(6):
            p = math.exp(-rate) * rate**k / math.factorial(k)
            assert abs(counts[k] / n - p) < 5 * math.sqrt(p * (1 - p) / n)
    assert {r.copies for r in got if r.doc_id == got[0].doc_id} == {per[got[0].source, got[0].doc_id]}


def test_large_rates_and_missing_weights(spark):
    rows = spark.createDataFrame([(i, "few" if i < 4 else "many") for i in range(104)], "doc_id long, source string")
    got = Counter(r.source for r in mixing.mix(rows, {"few": 1.0}, total=2000).collect())
    assert set(got) == {"few"} and abs(got["few"] - 2000) < 250
    assert mixing.mix(rows, {"none": 1.0}).collect() == []


def test_odd_rows(odd_docs, no_docs):
    got = mixing.mix(odd_docs, total=400)
    assert got.columns[-3:] == ["copy", "copies", "shuffle_key"] and set(odd_docs.columns) <= set(got.columns)
    rows = got.select("doc_id", "source", "text", "copy", "copies", "__rate").collect()
    sources = Counter(r.source for r in rows)
    assert set(sources) == {None, "a", "b"} and all(abs(n - 400 / 3) < 60 for n in sources.values())
    assert all(r.copy <= r.copies for r in rows)
    assert mixing.mix(no_docs).collect() == []


def test_spark_and_its_broadcast_limit_agree(odd_docs, monkeypatch):
    want = sorted(map(str, mixing.mix(odd_docs.select("doc_id", "source")).collect()))
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert sorted(map(str, mixing.mix(odd_docs.select("doc_id", "source")).collect())) == want


def test_preference_pairs(spark):
    rows = [(1, True, 0, "user", "q"), (1, True, 1, "assistant", "good"), (1, True, 2, "user", "more"),
            (1, False, 0, "user", "q"), (1, False, 1, "assistant", "bad é🙂"), (1, False, 2, "assistant", ""),
            (2, True, 0, "user", None), (2, False, 0, "user", None), (3, True, 0, None, "x"), (3, True, 0, None, "x"),
            (4, False, 5, "assistant", "b"), (4, False, 2, "user", "a"), (5, True, 0, "user", "q"), (5, False, 0, "system", "q")]
    df = spark.createDataFrame([(*r, "p", 1) for r in rows], "pair_id long, chosen boolean, turn long, role string, text string, prompt string, c int")
    got = {r.pair_id: r for r in chat.preference_pairs(df.repartition(4)).collect()}
    one = got[1]
    assert (one.prompt_turns, one.prompt) == (1, "<|user|>\nq<|end|>\n")
    assert one.chosen == "<|assistant|>\ngood<|end|>\n<|user|>\nmore<|end|>\n"
    assert [one.chosen[s.start:s.stop] for s in one.chosen_spans] == ["good<|end|>\n"]
    assert [one.rejected[s.start:s.stop] for s in one.rejected_spans] == ["bad é🙂<|end|>\n", "<|end|>\n"]
    assert (got[2].prompt_turns, got[2].chosen, got[2].rejected) == (1, "", "")
    assert (got[3].prompt, got[3].chosen_turns, got[3].rejected, got[3].rejected_spans) == ("", 2, "", [])
    assert got[4].rejected == "<|user|>\na<|end|>\n<|assistant|>\nb<|end|>\n" and got[4].chosen == ""
    assert got[5].prompt_turns == 0
    assert chat.preference_pairs(df.limit(0)).collect() == []


def test_exchanged_answers_share_a_prompt(spark):
    rows = [(2, 0, "user", "q"), (2, 1, "assistant", "one"), (2, 2, "user", "again"), (2, 3, "assistant", "two"), (3, 0, "user", "p"),
            (3, 1, "assistant", "three"), (4, 0, "user", "alone"), (4, 1, "assistant", "four"), (6, 0, "user", "no answer"),
            (None, 0, "user", None), (None, 1, "assistant", "five"), (-2, 0, "assistant", "minus two"), (-1, 0, "assistant", "minus one"),
            (8, 0, "assistant", "same"), (9, 0, "assistant", "same"), (2, 3, "assistant", "two")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, last int, other string")
    got = {r.pair_id: r for r in chat.formatted(chat.exchanged(df.repartition(3))).collect()}
    assert set(got) == {2, 3, 4, 6, None, -2, -1, 8, 9}
    two = got[2]
    assert (two.prompt_turns, two.prompt) == (3, "<|user|>\nq<|end|>\n<|assistant|>\none<|end|>\n<|user|>\nagain<|end|>\n")
    assert two.chosen == "<|assistant|>\ntwo<|end|>\n" * 2 and two.rejected == "<|assistant|>\nthree<|end|>\n" * 2
    assert [two.rejected[s.start:s.stop] for s in two.rejected_spans] == ["three<|end|>\n"] * 2
    assert got[3].rejected == "<|assistant|>\ntwo<|end|>\n" and got[3].prompt_turns == 1
    assert got[4].rejected == got[None].rejected == "<|assistant|>\n<|end|>\n" and got[None].prompt_turns == 1
    assert (got[6].prompt_turns, got[6].chosen, got[6].rejected) == (1, "", "")
    assert "minus one" in got[-2].rejected and "minus two" in got[-1].rejected
    assert (got[8].prompt_turns, got[8].chosen) == (1, "")
    assert chat.exchanged(df.limit(0)).collect() == []


def test_many_copies_of_a_row_are_made_in_several_tasks(spark, monkeypatch):
    """One row of a one-row source: the same copies, cut into ranges that are dealt over tasks."""
    rows = spark.createDataFrame([(i, "one" if i == 0 else "many", f"t{i}") for i in range(2000)], "doc_id long, source string, part string")
    got = mixing.mix(rows, total=40000)
    copies = sorted(r["copy"] for r in got.filter("doc_id = 0").select("copy").collect())
    assert len(copies) > 19000 and copies == list(range(1, len(copies) + 1))
    assert got.filter("doc_id = 0").select("part").distinct().collect()[0][0] == "t0"
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 2
    want = sorted(map(tuple, got.select("doc_id", "copy", "shuffle_key").collect()))
    monkeypatch.setattr(mixing, "RANGE", 1 << 30)
    assert sorted(map(tuple, mixing.mix(rows, total=40000).select("doc_id", "copy", "shuffle_key").collect())) == want
