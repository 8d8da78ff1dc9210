"""Metrics and per-race evaluation (E1-E9) as aggregates over scored entries.

A *scored entries* frame has one row per (season, round, driverId) with the
label ``on_podium``, a score ``p`` and a boolean ``predicted``.  The score
can come from a fitted model or from a fixed stand-in score; every metric
here is a plain Spark aggregate, so it runs for all races in one job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitwall.operators.windows import Key, top_k_per_group

RACE = ["season", "round"]
#: Score slices per doubling of the odds, for the exact AUC.
AUC_SLICES = 128
#: Parts of a race in the first step of the per-race evaluation.
PARTS = 16


def stand_in_scores(features: DataFrame, threshold: float = 0.25) -> DataFrame:
    """A fixed, model-free score p = 1 / (1 + grid); predicted = p >= threshold."""
    p = F.lit(1.0) / (F.lit(1.0) + F.col("grid").cast("double"))
    return features.withColumn("p", p).withColumn("predicted", F.col("p") >= threshold)


# --- E1-E6 ---------------------------------------------------------------------

def regression_metrics(df: DataFrame, y: str, yhat: str, group: list[str] | None = None) -> DataFrame:
    """MSE and MAE (NULL on an empty set) and row count."""
    d = F.col(yhat) - F.col(y)
    aggs = [F.avg(d * d).alias("mse"), F.avg(F.abs(d)).alias("mae"),
            F.count(F.lit(1)).cast("bigint").alias("n")]
    return df.groupBy(*(group or [])).agg(*aggs)


def accuracy(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Share of rows whose prediction equals the label."""
    return df.agg(F.avg((F.col(label) == F.col(pred)).cast("double")).alias("accuracy"),
                  F.count(F.lit(1)).cast("bigint").alias("n"))


def confusion_counts(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Rows per observed (label, prediction): all that E3-E5 need, in one pass."""
    return df.groupBy(F.col(label).alias("label"), F.col(pred).alias("pred")).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Counts over the full (label x prediction) grid of observed classes.

    The observed counts are gathered into one row of class-bounded size, and the grid
    (the result's own size) is exploded from it.
    """
    cell = F.struct(F.struct("label", "pred").alias("cell"), "n")
    one = confusion_counts(df, label, pred).filter("label is not null and pred is not null").agg(
        F.map_from_entries(F.collect_list(cell)).alias("counts"),
        F.array_sort(F.array_union(F.collect_set("label"), F.collect_set("pred"))).alias("classes"))
    grid = one.select("counts", "classes", F.explode("classes").alias("l"))
    grid = grid.select("counts", "l", F.explode("classes").alias("p"))
    n = F.col("counts")[F.struct(F.col("l").alias("label"), F.col("p").alias("pred"))]
    return grid.select(F.col("l").alias(label), F.col("p").alias(pred), F.coalesce(n, F.lit(0)).cast("bigint").alias("n"))


def classification_report(df: DataFrame, label: str, pred: str, classes: DataFrame | None = None) -> DataFrame:
    """Precision / recall / F1 / support per class, then macro and weighted
    averages; a zero denominator gives 0, as the reference's metric does.

    Everything follows from the confusion counts; a rollup over the classes adds the averages.
    ``classes`` (column ``cls``) names the classes to report: those without rows are listed with
    zeros, others are left out.
    """
    counts = confusion_counts(df, label, pred)
    own = F.when(F.col("label") == F.col("pred"), F.col("n")).otherwise(F.lit(0))
    nil = F.lit(0).cast("bigint")
    sides = counts.select(F.explode(F.array(
        F.struct(F.col("label").alias("cls"), F.col("n").alias("support"), nil.alias("n_pred"), own.cast("bigint").alias("tp")),
        F.struct(F.col("pred").alias("cls"), nil.alias("support"), F.col("n").alias("n_pred"), nil.alias("tp")))).alias("s"))
    sides = sides.select("s.*")
    if classes is not None:
        sides = sides.join(classes, "cls", "left_semi").unionByName(
            classes.select("cls", *[nil.alias(c) for c in ("support", "n_pred", "tp")]))
    per = sides.groupBy("cls").agg(*[F.sum(c).alias(c) for c in ("support", "n_pred", "tp")])
    ratio = lambda of: F.coalesce(F.try_divide(F.col("tp"), F.col(of).cast("double")), F.lit(0.0))
    per = per.select(F.col("cls").cast("string").alias("cls"), ratio("n_pred").alias("precision"),
                     ratio("support").alias("recall"), F.col("support").cast("bigint").alias("support"))
    both = F.col("precision") + F.col("recall")
    per = per.withColumn("f1", F.when(both > 0, 2 * F.col("precision") * F.col("recall") / both).otherwise(F.lit(0.0)))
    metrics = ("precision", "recall", "f1")
    means = per.rollup("cls").agg(
        F.grouping("cls").alias("all"), F.sum("support").alias("support"),
        *[F.avg(m).alias(f"m_{m}") for m in metrics],
        *[F.try_divide(F.sum(F.col(m) * F.col("support")), F.sum("support")).alias(f"w_{m}") for m in metrics])
    line = lambda name, kind: F.struct(name.alias("class_label"), *[F.col(f"{kind}_{m}").alias(m) for m in metrics])
    lines = F.when(F.col("all") == 0, F.array(line(F.col("cls"), "m"))).otherwise(
        F.array(line(F.lit("macro avg"), "m"), line(F.lit("weighted avg"), "w")))
    out = means.select(F.explode(lines).alias("line"), F.col("support").cast("bigint").alias("support"))
    return out.select("line.class_label", "line.precision", "line.recall", "support", "line.f1")


def named_report(df: DataFrame, label: str, pred: str, names: DataFrame) -> DataFrame:
    """The report of coded classes by name; ``names`` (code, name) lists the classes, and
    each line finds its name by its code."""
    rep = classification_report(df, label, pred, names.select(F.col("code").alias("cls")))
    known = names.select(F.col("code").cast("string").alias("class_label"), "name")
    return rep.join(known, "class_label", "left").select(
        F.coalesce("name", "class_label").alias("name"), "precision", "recall", "support", "f1")


def weighted_f1(df: DataFrame, label: str, pred: str) -> DataFrame:
    """E5: the support-weighted F1 (the tuning score of the pole model)."""
    rep = classification_report(df, label, pred)
    return rep.filter(F.col("class_label") == "weighted avg").select(F.col("f1").alias("weighted_f1"))


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Exact ROC AUC with tied scores counted half (NULL with one class).

    AUC = sum over positives of (#negatives scored lower + half the tied
    negatives) / (P * N).  Scores are counted per distinct value.  Slices of the
    log-odds axis, which stay fine towards 0 and 1, give every slice the number of
    negatives below it (a running sum over the slices), and a
    window inside each slice adds the negatives below within the slice.
    """
    s = F.col(score).cast("double")
    per = df.groupBy(s.alias("s")).agg(
        F.count_if(F.col(label)).alias("pos"), F.count_if(~F.col(label)).alias("neg"))
    odds = F.floor(F.log2(F.col("s") / (1 - F.col("s"))) * AUC_SLICES)
    out_of_range = F.floor(F.least(F.greatest(F.col("s"), F.lit(-1e6)), F.lit(1e6))) + F.when(F.col("s") < 1, -10**6).otherwise(10**6)
    sl = F.when((F.col("s") > 0) & (F.col("s") < 1), odds).otherwise(out_of_range)
    # dealt by slice once, for the counts and for the window; the nought uses every column, so
    # that both ask the exchange for the same ones
    per = per.withColumn("slice", sl.cast("int")).repartition("slice")
    nought = F.pmod(F.xxhash64(*per.columns), F.lit(1))
    slice_neg = per.groupBy("slice").agg(F.sum(F.col("neg") + nought).alias("slice_neg"))
    before = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slice_neg.select("slice", F.coalesce(F.sum("slice_neg").over(before),
                                                   F.lit(0)).alias("neg_before"))
    inside = Window.partitionBy("slice").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("neg_below_in", F.coalesce(F.sum("neg").over(inside), F.lit(0)))
    j = per.join(offsets, per["slice"].eqNullSafe(offsets["slice"]))
    contrib = F.col("pos") * (F.col("neg_before") + F.col("neg_below_in") + 0.5 * F.col("neg"))
    tot = j.agg(F.sum(contrib).alias("num"), F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    return tot.select(
        F.when((F.col("P") > 0) & (F.col("N") > 0),
               F.col("num") / (F.col("P") * F.col("N"))).alias("roc_auc"),
        F.col("P").cast("bigint").alias("n_pos"), F.col("N").cast("bigint").alias("n_neg"))


# --- E7-E9: per-race podium evaluation -------------------------------------------

def predicted_top3(scored: DataFrame) -> DataFrame:
    """Three highest scores per race, ties to the smaller driverId."""
    return top_k_per_group(scored, RACE, [Key("p", desc=True), Key("driverId")], 3, "pred_rank")


def actual_top3(scored: DataFrame) -> DataFrame:
    """O3: podium rows ordered by numeric position, first three, plus the count."""
    pod = scored.filter(F.col("on_podium")).withColumn("pos_num", F.col("position").try_cast("int"))
    return top_k_per_group(pod, RACE, [Key("pos_num"), Key("driverId")], 3, "act_rank")


def race_podiums(scored: DataFrame) -> DataFrame:
    """Per race the predicted top three and the actual podium, in one pass.

    A race is cut into parts; each part keeps its three best scores and its podium rows, and
    the few rows left of a race are put together.  ``predicted``: driverIds by falling score;
    ``actual``: driverIds by position.  Races without actual podium rows are absent.
    """
    part = F.pmod(F.xxhash64("driverId"), F.lit(PARTS)).alias("__part")
    rows = scored.select(*RACE, "raceName", "driverId", "p", "on_podium", F.col("position").try_cast("int").alias("pos_num"), part)
    best = Window.partitionBy(*RACE, "__part").orderBy(F.desc("p"), "driverId")
    rows = rows.withColumn("__rk", F.row_number().over(best)).filter((F.col("__rk") <= 3) | F.col("on_podium"))
    score = F.struct(F.col("p").isNull().alias("no_score"), (-F.col("p")).alias("less"), "driverId", "raceName")
    per = rows.groupBy(*RACE).agg(
        F.slice(F.sort_array(F.collect_list(score)), 1, 3).alias("best"),
        F.sort_array(F.collect_list(F.when(F.col("on_podium"), F.struct("pos_num", "driverId")))).alias("podium"))
    return per.filter(F.size("podium") > 0).select(
        *RACE, F.array_min(F.col("best.raceName")).alias("raceName"),
        F.col("best.driverId").alias("predicted"), F.col("podium.driverId").alias("actual"))


def podium_sets(scored: DataFrame) -> DataFrame:
    """Predicted and actual podium sets per race (sets as sorted text)."""
    text = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    return race_podiums(scored).select(
        *RACE, "raceName", text("predicted").alias("predicted_podium"), text("actual").alias("actual_podium"),
        F.size("actual").cast("bigint").alias("n_actual"))


def podium_set_eval(scored: DataFrame) -> DataFrame:
    """Exact-set accuracy, correct drivers, ratio to 3 slots per race."""
    p, a = F.array_sort(F.array_distinct("predicted")), F.array_sort(F.array_distinct("actual"))
    per = race_podiums(scored).select((p == a).alias("exact"), F.size(F.array_intersect(p, a)).alias("correct"))
    return per.agg(
        F.avg(F.col("exact").cast("double")).alias("exact_podium_accuracy"),
        F.sum("correct").cast("bigint").alias("correct_drivers"),
        (F.count(F.lit(1)) * 3).cast("bigint").alias("podium_slots"),
        F.try_divide(F.sum("correct").cast("double"), F.count(F.lit(1)) * 3).alias("correct_ratio"),
        F.avg("correct").alias("avg_correct_per_race"),
        F.count(F.lit(1)).cast("bigint").alias("races"))


def season_validation(scored: DataFrame) -> DataFrame:
    """One row per race with predicted and actual P1-P3.

    Races with fewer than three actual podium rows are skipped.
    """
    j = race_podiums(scored).filter(F.size("actual") >= 3)
    place = lambda c, i: F.get(F.col(c), F.lit(i - 1))
    act_set = F.slice("actual", 1, 3)
    return j.select(
        "season", "round", F.col("raceName").alias("race"),
        place("predicted", 1).alias("predicted_winner"), place("actual", 1).alias("actual_winner"),
        (place("predicted", 1) == place("actual", 1)).alias("winner_match"),
        F.size(F.array_intersect("predicted", act_set)).alias("podium_matches"),
        *[place(c, i).alias(f"{c}_p{i}") for c in ("predicted", "actual") for i in (1, 2, 3)])


def season_summary(validation: DataFrame) -> DataFrame:
    """Winner accuracy, mean podium matches, perfect races, 3/3 races."""
    m = F.col("podium_matches")
    return validation.groupBy("season").agg(
        F.count(F.lit(1)).cast("bigint").alias("races"),
        (F.avg(F.col("winner_match").cast("double")) * 100).alias("winner_accuracy_pct"),
        F.count_if(F.col("winner_match")).cast("bigint").alias("winners_correct"),
        F.avg(m.cast("double")).alias("avg_podium_matches"),
        F.count_if((m == 3) & F.col("winner_match")).cast("bigint").alias("perfect_races"),
        F.count_if(m == 3).cast("bigint").alias("races_all_three"))


def match_distribution(validation: DataFrame) -> DataFrame:
    """Races per number of podium matches, with share of the season."""
    per = validation.groupBy("season", "podium_matches").agg(
        F.count(F.lit(1)).cast("bigint").alias("races"))
    # at most four rows per season: a season-wide frame over them is tiny
    tot = F.sum("races").over(Window.partitionBy("season"))
    return per.withColumn("pct", F.col("races") * 100.0 / tot)


def perfect_races(validation: DataFrame) -> DataFrame:
    """Races with all three podium drivers and the winner right."""
    return validation.filter((F.col("podium_matches") == 3) & F.col("winner_match")).select(
        "season", "round", "race")


def race_accuracy(scored: DataFrame) -> DataFrame:
    """Per race accuracy, predicted / actual / identified podiums, recall."""
    hit = F.col("predicted") == F.col("on_podium")
    tp = F.col("predicted") & F.col("on_podium")
    agg = scored.groupBy(*RACE).agg(
        F.count_if(hit).cast("bigint").alias("correct"),
        F.count(F.lit(1)).cast("bigint").alias("total"),
        F.count_if(F.col("predicted")).cast("bigint").alias("predicted_podiums"),
        F.count_if(F.col("on_podium")).cast("bigint").alias("actual_podiums"),
        F.count_if(tp).cast("bigint").alias("true_positives"))
    return agg.withColumns({
        "accuracy_pct": F.col("correct") * 100.0 / F.col("total"),
        "recall_pct": F.when(F.col("actual_podiums") > 0,
                             F.col("true_positives") * 100.0 / F.col("actual_podiums")),
    })
