"""Window operators (W1-W9) and skew-safe ranking.

Ranking inside a group is a Spark window.  A plain window sends a whole
group to one task, which is fine for a (race, driver) group but not for a
race, a season, or a (race, lap) group that may hold a large share of all
rows.  For those, :func:`row_number_by` / :func:`rank_by` take ordered
*slices*: columns that are monotone in the sort order.  The rows are dealt by
(group, slice) once.  That one exchange feeds two branches: the window that
numbers the rows of each slice, and the count of each slice, whose running
sum over a small table is the slice's offset.  The offsets are joined back on
(group, slice) and on its hash, by which the rows are dealt already: a null-safe
join on the columns alone would deal them again.  So the input is read
once and its rows are shuffled once (with the conformed store's setting that a
join takes what is dealt by some of its keys); the result is identical to the plain
window, but no task holds more than one slice.

An exchange is shared only while both branches ask it for the same columns,
so the count refers to all of them; pass frames of just the columns needed.

Slice rule: the slice columns, compared left to right, must never decrease
along the sort order.  A second slice column is therefore only valid when
every earlier slice pins its key exactly (e.g. width 1 on an integer-valued
key); a coarser first slice must be the only one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Key:
    """One sort key.  Spark defaults: asc -> nulls first, desc -> nulls last."""

    name: str
    desc: bool = False
    nulls_last: bool | None = None

    def column(self) -> Column:
        c = F.col(self.name)
        last = self.nulls_last if self.nulls_last is not None else self.desc
        if self.desc:
            return c.desc_nulls_last() if last else c.desc_nulls_first()
        return c.asc_nulls_last() if last else c.asc_nulls_first()

    def nulls_are_last(self) -> bool:
        return self.nulls_last if self.nulls_last is not None else self.desc


def numeric_slice(key: Key, width: float, lo: float = -1e18, hi: float = 1e18) -> Column:
    """Order-preserving slice number of a numeric key (null -> first/last)."""
    c = F.col(key.name).cast("double")
    s = F.floor((-c if key.desc else c) / F.lit(float(width)))
    sentinel = F.lit(int(hi) if key.nulls_are_last() else int(lo)).cast("bigint")
    return F.coalesce(s, sentinel)


def prefix_slice(key: Key, length: int) -> Column:
    """Order-preserving slice of an ascending string key: its first characters."""
    if key.desc:
        raise ValueError("prefix slices are defined for ascending keys only")
    sentinel = F.lit("￿") if key.nulls_are_last() else F.lit("")
    return F.coalesce(F.substring(F.col(key.name), 1, length), sentinel)


def _sliced(df: DataFrame, group: list[str], order_cols: list[Column], out: str, fn,
            slices: list[Column], total: str | None) -> DataFrame:
    names = [f"__slice{i}" for i in range(len(slices))]
    dealt = df.withColumns(dict(zip(names, slices)))
    dealt = dealt.withColumn("__deal", F.xxhash64(*group, *names)).repartition("__deal")
    group, names = list(group), [*names, "__deal"]
    # one for each row, and a use of every column: the exchange stays the same as the window's
    one = F.pmod(F.xxhash64(*dealt.columns), F.lit(1)) + 1
    counts = dealt.groupBy(*group, *names).agg(F.sum(one).alias("__n"))
    whole = Window.partitionBy(*group)
    before = whole.orderBy(*names[:-1]).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *[F.col(c).alias(f"__o_{c}") for c in group + names],
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"),
        F.sum("__n").over(whole).alias("__total"))
    w = Window.partitionBy(*group, *names).orderBy(*order_cols)
    local = dealt.withColumn("__local", fn().over(w))
    cond = None
    for c in group + names:
        same = local[c] == offsets[f"__o_{c}"] if c == "__deal" else local[c].eqNullSafe(offsets[f"__o_{c}"])
        cond = same if cond is None else cond & same
    res = local.join(offsets, cond, "inner").withColumn(out, (F.col("__off") + F.col("__local")).cast("int"))
    if total:
        res = res.withColumn(total, F.col("__total"))
    return res.drop(*names, "__local", "__off", "__total", *[f"__o_{c}" for c in group + names])


def _ranked(df: DataFrame, group: list[str], order: list[Key], out: str, fn,
            slices: list[Column] | None, total: str | None) -> DataFrame:
    order_cols = [k.column() for k in order]
    if slices:
        return _sliced(df, group, order_cols, out, fn, slices, total)
    whole = Window.partitionBy(*group)
    res = df.withColumn(out, fn().over(whole.orderBy(*order_cols)).cast("int"))
    return res.withColumn(total, F.count(F.lit(1)).over(whole)) if total else res


def row_number_by(df: DataFrame, group: list[str], order: list[Key], out: str,
                  slices: list[Column] | None = None, total: str | None = None) -> DataFrame:
    """``row_number() over (partition by group order by order)`` as column ``out``.

    Operators on groups that can hold a large share of all rows (races, seasons,
    classes, the whole table) pass ``slices``; those on (race, driver) groups, which
    the laps of one race bound, don't.  ``total`` adds the group's number of rows.
    """
    return _ranked(df, group, order, out, F.row_number, slices, total)


def rank_by(df: DataFrame, group: list[str], order: list[Key], out: str,
            slices: list[Column] | None = None) -> DataFrame:
    """``rank() over (...)``; ties share a slice because slices derive from keys."""
    return _ranked(df, group, order, out, F.rank, slices, None)


# --- lap-series windows -------------------------------------------------------

ENTRY = ["season", "round", "driverId"]


def add_lags(df: DataFrame, lags: dict[str, list[tuple[int, str]]], partition: list[str],
             order: str, fill: dict[str, Column] | None = None) -> DataFrame:
    """Lags within ``partition`` (one driver's laps of one race) by ``order``.

    ``lags`` maps a value column to (k, output name) pairs; ``fill`` gives defaults.
    """
    w = Window.partitionBy(*partition).orderBy(order)
    out = df.withColumns({n: F.lag(v, k).over(w) for v, pairs in lags.items() for k, n in pairs})
    return out.withColumns({n: F.coalesce(F.col(n), c) for n, c in (fill or {}).items()})


def top_k_per_group(df: DataFrame, group: list[str], order: list[Key], k: int,
                    out: str = "rk") -> DataFrame:
    """First k rows per group.

    ``row_number() <= k`` lets Spark insert a partial per-group limit before
    the shuffle (WindowGroupLimit), so a large group sends only k rows per
    map task.
    """
    w = Window.partitionBy(*group).orderBy(*[x.column() for x in order])
    return df.withColumn(out, F.row_number().over(w).cast("int")).filter(F.col(out) <= k)


def category_codes(df: DataFrame, col: str, out: str, codes_from: DataFrame | None = None) -> DataFrame:
    """0-based position of the value among sorted distinct values; null -> -1.

    Only the *distinct* values are ranked, in slices, and joined back; the optimizer
    broadcasts them if they turn out small.  ``codes_from`` fits the codes on another
    frame (train rows); values it has not seen get -1.
    """
    src = (codes_from if codes_from is not None else df).select(F.col(col).alias("__v")).distinct()
    src = src.filter(F.col("__v").isNotNull())
    codes = row_number_by(src, [], [Key("__v")], "__code", slices=[prefix_slice(Key("__v"), 4)])
    j = df.join(codes, df[col] == codes["__v"], "left")
    return j.withColumn(out, F.coalesce(F.col("__code") - 1, F.lit(-1))).drop("__v", "__code")
