"""Sliced (skew-safe) ranking equals the plain window, including a hot group and ties."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from pitwall.operators.windows import (Key, add_lags, category_codes, numeric_slice, prefix_slice,
                                       rank_by, row_number_by, top_k_per_group)


def _data(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        g = "hot" if i % 3 else f"g{i % 17}"          # one group holds 2/3 of the rows
        rows.append((g, float(rnd.randint(0, 400)), f"D{rnd.randint(1, 999)}", i))
    rows.append(("hot", None, "D5", 99999))             # a null key
    return spark.createDataFrame(rows, "g string, v double, d string, i int")


def test_row_number_sliced_matches_plain(spark):
    df = _data(spark)
    order = [Key("v", nulls_last=True), Key("d"), Key("i")]
    plain = row_number_by(df, ["g"], order, "rn")
    coarse = row_number_by(df, ["g"], order, "rn", slices=[numeric_slice(order[0], 16)])
    # a second slice needs the first to pin its (integer-valued) key exactly
    sliced = row_number_by(df, ["g"], order, "rn",
                           slices=[numeric_slice(order[0], 1.0), prefix_slice(order[1], 2)])
    a = sorted(plain.select("i", "rn").collect())
    b = sorted(sliced.select("i", "rn").collect())
    c = sorted(coarse.select("i", "rn").collect())
    assert a == b == c


def test_rank_sliced_keeps_ties(spark):
    df = _data(spark)
    order = [Key("v", desc=True)]
    plain = rank_by(df, ["g"], order, "rk")
    sliced = rank_by(df, ["g"], order, "rk", slices=[numeric_slice(order[0], 32)])
    assert sorted(plain.select("i", "rk").collect()) == sorted(sliced.select("i", "rk").collect())


def test_global_sliced_position(spark):
    df = _data(spark)
    order = [Key("g"), Key("i")]
    sliced = row_number_by(df, [], order, "pos", slices=[prefix_slice(order[0], 2)])
    w = Window.orderBy("g", "i")
    plain = df.withColumn("pos", F.row_number().over(w))
    assert sorted(plain.select("i", "pos").collect()) == sorted(sliced.select("i", "pos").collect())


def test_top_k_and_codes(spark):
    df = _data(spark)
    top = top_k_per_group(df.filter("v is not null"), ["g"], [Key("v", desc=True), Key("i")], 3)
    counts = {r["g"]: r["count"] for r in top.groupBy("g").count().collect()}
    assert max(counts.values()) == 3
    codes = category_codes(spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "c string"),
                           "c", "code")
    got = sorted((r["c"] or "", r["code"]) for r in codes.collect())
    assert got == [("", -1), ("a", 0), ("b", 1), ("b", 1)]


def test_lags_with_null_keys_and_one_driver_with_most_rows(spark):
    rows = []
    for i in range(2000):
        d = None if i % 4 else f"D{i % 9}"              # the NULL driver holds 3/4 of the rows
        rows.append((2000, 1, d, i * 3 + (i % 7), float(i % 11), i % 5 == 0))  # gaps in laps
    df = spark.createDataFrame(rows, "season int, round int, driverId string, lap int, v double, pit boolean")
    got = add_lags(df, {"v": [(1, "lag_1"), (3, "lag_3")], "pit": [(1, "exit")]}, ["season", "round", "driverId"], "lap",
                   fill={"exit": F.lit(False)})
    want, series = [], {}
    for r in sorted(rows, key=lambda r: r[3]):
        past = series.setdefault(r[2], [])
        want.append((r[2], r[3], past[-1][4] if past else None, past[-3][4] if len(past) > 2 else None,
                     past[-1][5] if past else False))
        past.append(r)
    assert sorted(map(tuple, got.select("driverId", "lap", "lag_1", "lag_3", "exit").collect()), key=str) == sorted(want, key=str)


def test_null_group_keys_and_totals(spark):
    df = _data(spark).withColumn("g", F.when(F.col("g") != "hot", F.col("g")))
    order = [Key("v", nulls_last=True), Key("d"), Key("i")]
    plain = row_number_by(df, ["g"], order, "rn", total="n").select("i", "rn", "n")
    sliced = row_number_by(df, ["g"], order, "rn", slices=[numeric_slice(order[0], 8)], total="n").select("i", "rn", "n")
    assert sorted(plain.collect()) == sorted(sliced.collect())
    assert sliced.count() == df.count()


def test_builders_run_no_job(spark):
    """Rankings, lags and splits only build plans."""
    from pitwall.operators import splits
    df = _data(spark).withColumns({"season": F.lit(2000), "round": F.lit(1), "driverId": F.col("d"), "y": F.col("g")})
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("builders", "builders")
    try:
        splits.ordered_split(df, ["season", "round", "driverId"])
        splits.kfold2(df, ["season", "round", "driverId"])
        splits.stratified_kfold2(df, "y", ["season", "round", "driverId"])
        splits.stratified_split(df, "y", ["season", "round", "driverId"])
        add_lags(df, {"v": [(1, "l")]}, ["g"], "i")
        assert not list(tracker.getJobIdsForGroup("builders"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_a_numbering_reads_its_input_once(spark, tmp_path):
    """One scan and one exchange of the rows feed the ranks and the counts of the slices."""
    spark.range(5000).selectExpr("cast(id % 7 as int) season", "cast(id % 50 as double) x", "id").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    out = row_number_by(df, ["season"], [Key("x"), Key("id")], "pos", slices=[numeric_slice(Key("x"), 5.0)], total="n")
    rows = sorted(tuple(r) for r in out.select("season", "x", "id", "pos", "n").collect())
    want = []
    for s in range(7):
        own = sorted((float(i % 50), i) for i in range(5000) if i % 7 == s)
        want += [(s, x, i, k, len(own)) for k, (x, i) in enumerate(own, 1)]
    assert rows == sorted(want)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") - plan.count("ReusedExchange") <= 1 or plan.count("ReusedExchange") == 1
    assert plan.count("ReusedExchange") >= 1
