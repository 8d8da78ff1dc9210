"""Aggregations.

All of these are map-side-combinable aggregates.  The only values that come
back to the driver are fitted statistics of fixed size (one number per
feature column), as a Spark ML estimator would return them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Slices per unit of asinh(value): how finely the value axis is cut for medians.
MEDIAN_SLICES = 4096


def medians(df: DataFrame, cols: list[str]) -> DataFrame:
    """A2: exact (column_name, median) of each column, NULLs left out; all-NULL columns are absent.

    Rows become counts per (column, value).  Slices of the value axis carry running sums, and
    only the slices that hold a middle row are looked into, so no task gathers a column's values.
    """
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v")) for c in cols]))
    cells = df.select(cells.alias("c")).select("c.*").filter(F.col("v").isNotNull())
    counts = cells.groupBy("column_name", "v").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn("slice", F.floor(F.asinh("v") * MEDIAN_SLICES))
    whole = Window.partitionBy("column_name")
    before = whole.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = counts.groupBy("column_name", "slice").agg(F.sum("n").alias("in_slice")).select(
        "column_name", "slice", "in_slice", F.coalesce(F.sum("in_slice").over(before), F.lit(0)).alias("before"),
        F.sum("in_slice").over(whole).alias("total"))
    lower, upper = F.expr("(total - 1) div 2"), F.expr("total div 2")  # 0-based middle rows
    slices = slices.filter((F.col("before") <= upper) & (F.col("before") + F.col("in_slice") > lower))
    inside = Window.partitionBy("column_name", "slice").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    hit = counts.join(slices, ["column_name", "slice"]).withColumn(
        "start", F.col("before") + F.coalesce(F.sum("n").over(inside), F.lit(0)))
    at = lambda row: F.max(F.when((F.col("start") <= row) & (F.col("start") + F.col("n") > row), F.col("v")))
    return hit.groupBy("column_name").agg((at(lower) * 0.5 + at(upper) * 0.5).alias("median"))


def fit_statistics(df: DataFrame, numeric: list[str], categories: list[str]) -> DataFrame:
    """One row: ``medians`` (map of column -> median) and ``codes`` (map of column -> sorted values).

    The categories are bounded sets (circuits, teams, pole winners).
    """
    entry = F.struct("column_name", "median")
    fitted = (medians(df, numeric) if numeric else df.sparkSession.createDataFrame([], "column_name string, median double"))
    fitted = fitted.agg(F.map_from_entries(F.collect_list(entry)).alias("medians"))
    pairs = [x for c in categories for x in (F.lit(c), F.sort_array(F.collect_set(c)))]
    codes = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,array<string>>")
    return fitted.join(df.agg(codes.alias("codes")))  # one row with one row


def with_statistics(df: DataFrame, fitted: DataFrame) -> DataFrame:
    """``df`` with the columns of the one-row frame ``fitted`` (broadcast: a single row)."""
    return df.join(F.broadcast(fitted))


def impute(numeric: list[str]) -> dict[str, Column]:
    """columns with NULLs replaced by the median in ``medians``; without one they stay NULL."""
    return {c: F.coalesce(F.col(c).cast("double"), F.col("medians")[c]) for c in numeric}


def code_of(col: str) -> Column:
    """0-based position in the sorted values of ``codes``; NULL or unseen -> -1."""
    return (F.coalesce(F.array_position(F.col("codes")[col], F.col(col)), F.lit(0)) - 1).cast("int")


def race_min(df: DataFrame, value: str, out: str, group: list[str]) -> DataFrame:
    """A1: per-group minimum as a small aggregate (partial agg before the shuffle)."""
    return df.groupBy(*group).agg(F.min(value).alias(out))


def null_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows, NULL count per column, and an all-NULL flag, as one row per column."""
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for c in cols:
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"n_{c}"))
    one = df.agg(*aggs)
    stack = ", ".join(f"'{c}', n_{c}" for c in cols)
    return one.selectExpr(f"stack({len(cols)}, {stack}) as (column_name, null_count)",
                          "__rows as row_count").select(
        "column_name", F.col("null_count").cast("bigint").alias("null_count"),
        F.col("row_count").cast("bigint").alias("row_count"),
        (F.col("null_count") == F.col("row_count")).alias("all_null"))


def table_counts(named: dict[str, DataFrame]) -> DataFrame:
    """A4: row count per table, unioned into one frame."""
    parts = [df.agg(F.count(F.lit(1)).cast("bigint").alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in named.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def class_weights(df: DataFrame, label: str, out: str = "class_weight") -> DataFrame:
    """A14: 'balanced' weights n / (k * n_class), one row per class."""
    per = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_class"))
    # ``per`` has one row per class, so a frame over all of it is tiny.
    everything = Window.partitionBy()
    return per.select(label, F.col("n_class").cast("bigint").alias("n_class"),
                      (F.sum("n_class").over(everything)
                       / (F.count(F.lit(1)).over(everything) * F.col("n_class"))).alias(out))
