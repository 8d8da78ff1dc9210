"""F1 / F2 edge cases on hand-written rows."""

from pyspark.sql import functions as F

from pitwall.functions.timing import qual_time_to_ms, time_to_ms

ROWS = [("1:02.026",), ("95.123",), ("Retired",), ("1:2:3.0",), ("",), (None,), ("1:05",),
        ("0:59.999",), ("x:10.0",), ("1:",)]


def _run(spark, fn):
    df = spark.createDataFrame(ROWS, "t string")
    return {r["t"]: r["ms"] for r in df.select("t", fn("t").alias("ms")).collect()}


def test_lap_time_exact(spark):
    got = _run(spark, time_to_ms)
    assert got["1:02.026"] == 62026
    assert got["95.123"] == 95123
    assert got["1:05"] == 65000
    assert got["0:59.999"] == 59999
    for bad in ("Retired", "1:2:3.0", "", None, "x:10.0", "1:"):
        assert got[bad] is None, bad


def test_lap_time_parity_truncates_binary_double(spark):
    got = _run(spark, lambda c: time_to_ms(c, parity=True))
    # (1*60 + 2.026) * 1000 = 62025.99999999999 in binary floating point
    assert got["1:02.026"] == int((1 * 60 + 2.026) * 1000) == 62025
    assert got["95.123"] == int(95.123 * 1000)
    assert got["Retired"] is None


def test_qualifying_time(spark):
    got = _run(spark, qual_time_to_ms)
    assert got["1:02.026"] == 62026
    assert got[None] == -1
    assert got["Retired"] == -1
    assert got[""] == -1
    # three parts: the first part is read as seconds
    assert got["1:2:3.0"] == 1000


def test_numbers_out_of_range_are_bad_text(spark):
    bad = ["inf", "1:inf", "-inf", "nan", "1:nan", "99999999999999999999", "1:99999999999999999999.5",
           "99999999999999999999:1", "9223372036854775807:1", "1e400", "1:1e30"]
    df = spark.createDataFrame([(x,) for x in bad], "t string")
    for parity in (False, True):
        rows = df.select("t", time_to_ms("t", parity).alias("lap"), qual_time_to_ms("t", parity).alias("qual")).collect()
        assert all(r["lap"] is None and r["qual"] == -1 for r in rows), rows
