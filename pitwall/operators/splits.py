"""Train/test splits and fold assignment.

Every split is a deterministic column, so the same rows land on the same
side on every run and in every engine.  Positions inside a class or in the
global order come from :func:`row_number_by` with ordered slices, so the
majority class (or the whole table) is never numbered in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitwall.operators.windows import Key, numeric_slice, prefix_slice, row_number_by


def _order_keys(cols: list[str]) -> tuple[list[Key], list]:
    keys = [Key(c) for c in cols]
    slices = []
    for k in keys:
        if k.name in ("season", "round"):
            slices.append(numeric_slice(k, 1.0))
        elif k.name == "driverId":
            slices.append(prefix_slice(k, 4))
            break
    return keys, slices


def temporal_split(df: DataFrame, train: list[int], test: list[int]) -> DataFrame:
    """Split by season membership; rows in neither list are dropped."""
    split = (F.when(F.col("season").isin(list(train)), "train")
              .when(F.col("season").isin(list(test)), "test"))
    return df.withColumn("split", split).filter(F.col("split").isNotNull())


def hash_split(df: DataFrame, keys: list[str], cut: str = "33") -> DataFrame:
    """Seeded-random-like 80/20 split from the first two hex digits of md5(keys).

    '33' puts 51 of 256 buckets (19.9 %) in test; any engine with md5 agrees.
    """
    h = F.substring(F.md5(F.concat_ws("_", *[F.col(k).cast("string") for k in keys])), 1, 2)
    return df.withColumn("split", F.when(h < cut, "test").otherwise("train"))


def global_position(df: DataFrame, order: list[str], out: str = "pos",
                    total: str | None = None) -> DataFrame:
    """1-based position of each row in the total order ``order`` (no single-task window).

    Rows are counted per slice (season, round, id prefix), a running sum over the counts
    gives the offsets, and rows are ranked within their slice.  ``total`` adds the row count.
    """
    keys, slices = _order_keys(order)
    return row_number_by(df, [], keys, out, slices=slices, total=total)


def ordered_split(df: DataFrame, order: list[str], test_size: float = 0.2) -> DataFrame:
    """Unshuffled split: the first n - ceil(test_size * n) rows in ``order`` train."""
    pos = global_position(df, order, "__pos", "__n")
    n_train = F.col("__n") - F.ceil(F.col("__n") * F.lit(test_size))
    return pos.withColumn("split", F.when(F.col("__pos") <= n_train, "train")
                          .otherwise("test")).drop("__pos", "__n")


def _class_positions(df: DataFrame, label: str, order: list[str]) -> DataFrame:
    keys, slices = _order_keys(order)
    return row_number_by(df, [label], keys, "__rn", slices=slices)


def stratified_split(df: DataFrame, label: str, keys: list[str],
                     train_size: float = 0.75) -> DataFrame:
    """Per class, rows ordered by md5(keys) then keys; the first
    floor(train_size * n_class) rows train.  A class is ranked in 65,536 even slices."""
    h = F.md5(F.concat_ws("_", *[F.col(k).cast("string") for k in keys]))
    tagged = df.withColumn("__h", h)
    order = [Key("__h"), *[Key(k) for k in keys]]
    ranked = row_number_by(tagged, [label], order, "__rn", slices=[prefix_slice(order[0], 4)], total="__n")
    cut = F.floor(F.col("__n") * F.lit(train_size))
    return ranked.withColumn("split", F.when(F.col("__rn") <= cut, "train").otherwise("test")) \
                 .drop("__h", "__rn", "__n")


def kfold2(df: DataFrame, order: list[str]) -> DataFrame:
    """M14 (regression): two contiguous folds; the first has ceil(n / 2) rows."""
    pos = global_position(df, order, "__pos", "__n")
    return pos.withColumn("fold", F.when(F.col("__pos") <= F.ceil(F.col("__n") / 2), 0).otherwise(1)) \
              .drop("__pos", "__n")


def stratified_kfold2(df: DataFrame, label: str, order: list[str]) -> DataFrame:
    """M14 (classification): unshuffled stratified two folds.

    Classes are taken in sorted order; a class occupying sorted positions
    [s, s + n) sends as many of its rows to fold 0 as there are even
    positions in that range, in row order.  Only the class-count table
    (one row per class) needs a running sum.
    """
    counts = df.groupBy(F.col(label).alias("__label")).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__label").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("__s", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    alloc0 = F.floor((F.col("__s") + F.col("__n") + 1) / 2) - F.floor((F.col("__s") + 1) / 2)
    counts = counts.withColumn("__a0", alloc0)
    ranked = _class_positions(df, label, order)
    j = ranked.join(counts, ranked[label].eqNullSafe(counts["__label"]))
    return j.withColumn("fold", F.when(F.col("__rn") <= F.col("__a0"), 0).otherwise(1)) \
            .drop("__rn", "__label", "__n", "__s", "__a0")


def season_availability(t, seasons: list[int]) -> DataFrame:
    """For each requested season, which inputs exist (distinct + left joins)."""
    spark = t.spark
    want = spark.createDataFrame([(s,) for s in seasons], "season int")
    res = t.race_results.select("season").distinct().withColumn("has_results", F.lit(True))
    qual = t.qualifying.select("season").distinct().withColumn("has_qualifying", F.lit(True))
    prev = (t.driver_standings.select((F.col("season") + 1).alias("season")).distinct()
            .withColumn("has_prev_standings", F.lit(True)))
    out = want.join(res, "season", "left").join(qual, "season", "left").join(prev, "season", "left")
    return out.select("season", *[F.coalesce(F.col(c), F.lit(False)).alias(c)
                                  for c in ("has_results", "has_qualifying", "has_prev_standings")])
