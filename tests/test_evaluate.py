"""Metrics against brute force on small hand-made frames."""

import itertools

from pitwall.plans import evaluate as ev


def _auc_brute(rows):
    pos = [p for p, y in rows if y]
    neg = [p for p, y in rows if not y]
    s = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a, b in itertools.product(pos, neg))
    return s / (len(pos) * len(neg))


def test_roc_auc_with_ties(spark):
    rows = [(0.1, False), (0.4, True), (0.4, False), (0.35, True), (0.8, True), (0.8, False),
            (0.0, False), (1.0, True), (0.5, False)]
    df = spark.createDataFrame(rows, "p double, y boolean")
    got = ev.roc_auc(df, "y", "p").first()["roc_auc"]
    assert abs(got - _auc_brute(rows)) < 1e-12


def test_roc_auc_one_class_is_null(spark):
    df = spark.createDataFrame([(0.1, True), (0.2, True)], "p double, y boolean")
    assert ev.roc_auc(df, "y", "p").first()["roc_auc"] is None


def test_classification_report_zero_division(spark):
    df = spark.createDataFrame([(True, False), (True, False), (False, False)],
                               "y boolean, yhat boolean")
    rep = {r["class_label"]: r for r in ev.classification_report(df, "y", "yhat").collect()}
    assert rep["true"]["precision"] == 0.0 and rep["true"]["recall"] == 0.0
    assert abs(rep["false"]["precision"] - 1 / 3) < 1e-12
    assert rep["weighted avg"]["support"] == 3


def test_confusion_matrix_full_grid(spark):
    df = spark.createDataFrame([(True, True), (False, False)], "y boolean, yhat boolean")
    cm = ev.confusion_matrix(df, "y", "yhat").collect()
    assert len(cm) == 4 and sum(r["n"] for r in cm) == 2


def test_season_validation_skips_short_podiums(spark):
    rows = []
    for rnd, podium in ((1, 3), (2, 2)):
        for i in range(6):
            pos = str(i + 1)
            rows.append((2000, rnd, f"GP{rnd}", f"D{i}", pos, i < podium, 1.0 / (i + 2), i < 3))
    df = spark.createDataFrame(
        rows, "season int, round int, raceName string, driverId string, position string, "
              "on_podium boolean, p double, predicted boolean")
    val = ev.season_validation(df).collect()
    assert [r["round"] for r in val] == [1]
    assert val[0]["podium_matches"] == 3 and val[0]["winner_match"]


def test_bands_carry_the_rank_tag_of_the_top_three(spark):
    """Every entry is there; the first three of each race are tagged by rank, if they are called."""
    from pitwall.plans import reports as rp
    rows = [(1, 1, "a", 0.9, True), (1, 1, "c", 0.5, True), (1, 1, "b", 0.5, True), (1, 1, "d", 0.5, True), (1, 1, "e", None, None),
            (1, 2, "a", 0.1, False), (1, 2, "b", 0.6, True)]
    got = rp.probability_bands(spark.createDataFrame(rows, "season int, round int, driverId string, p double, predicted boolean"))
    assert {(r["round"], r["driverId"]): r["rank_icon"] for r in got.collect()} == {
        (1, "a"): "[1]", (1, "b"): "[2]", (1, "c"): "[3]", (1, "d"): "   ", (1, "e"): "   ", (2, "a"): "   ", (2, "b"): "[1]"}
    assert got.count() == len(rows)
