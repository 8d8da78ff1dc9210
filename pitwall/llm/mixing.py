"""Operator 9: mixing sources to target weights by Poisson replication.

Each source has a target weight.  Its mean repetition rate is its share of the target
total over its number of rows; each row's repetitions are a Poisson draw of that mean,
by inversion of the distribution at a uniform number that a hash of (seed, id) gives.
Rows are exploded by their counts, and the copies are shuffled globally: dealt to
partitions by the hash of a shuffle key and ordered by that key within them.

Where a source has so few rows that each is copied very often, the copies of one row are cut
into ranges of at most ``RANGE``, which are dealt over the tasks before they are made.

A rate above ``DRAW_RATE`` is the sum of several independent draws, so that exp(-rate)
keeps its precision.

Defined cases: a null source is a source of its own; a null id hashes as ''; rows that
repeat an id get the same count; a source without weight gets rate 0; an empty table
gives an empty result.  Extra columns pass through; the names ``copy``, ``copies``
and ``shuffle_key`` are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Largest mean of one draw.
DRAW_RATE = 32.0
#: Up to this many sources the table of rates is broadcast; beyond it the join shuffles.
BROADCAST_SOURCES = 10_000
#: Copies of a row that one task makes, where rates call for many.
RANGE = 256


def uniform(seed: int, *parts: Column) -> Column:
    """A number in [0, 1) with 52 bits from the md5 of the seed and the parts."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long") / F.lit(2.0**52)


def poisson_steps(rate: Column) -> Column:
    """Cumulative probabilities 0, 1, 2, ... of a Poisson distribution, until they reach 1."""
    most = F.ceil(rate + 12 * F.sqrt(rate) + 24).cast("int")
    first = F.exp(-rate)
    start = F.struct(first.alias("p"), first.alias("total"), F.array(first).alias("steps"))

    def add(acc: Column, k: Column) -> Column:
        p = acc["p"] * rate / k
        total = acc["total"] + p
        return F.struct(p.alias("p"), total.alias("total"), F.concat(acc["steps"], F.array(total)).alias("steps"))

    return F.aggregate(F.sequence(F.lit(1), most), start, add)["steps"]


def rates(df: DataFrame, weights: dict[str, float] | None = None, source: str = "source",
          total: float | None = None) -> DataFrame:
    """Per source: rows, mean rate, draws and cumulative steps of one draw.

    ``weights``: target weight by source (default: the same for every source);
    ``total``: target number of rows (default: as many as there are).
    """
    per = df.groupBy(F.col(source).alias("__source")).agg(F.count(F.lit(1)).alias("__rows"))
    if weights is None:
        per = per.withColumn("__weight", F.lit(1.0))
    else:
        chosen = F.create_map(*[x for k, v in weights.items() for x in (F.lit(k), F.lit(float(v)))])
        per = per.withColumn("__weight", F.coalesce(chosen[F.col("__source")], F.lit(0.0)))
    sums = per.agg(F.sum("__weight").alias("__weights"), F.sum("__rows").alias("__all"))
    goal = F.lit(float(total)) if total is not None else F.col("__all").cast("double")
    # The sums are a single row, so this join adds two columns to the table of sources.
    per = per.join(F.broadcast(sums)).withColumn(
        "__rate", F.when(F.col("__weights") > 0, goal * F.col("__weight") / F.col("__weights") / F.col("__rows"))
        .otherwise(F.lit(0.0)))
    return (per.withColumn("__draws", F.greatest(F.ceil(F.col("__rate") / DRAW_RATE), F.lit(1)).cast("int"))
            .withColumn("__steps", poisson_steps(F.col("__rate") / F.col("__draws")))
            .select("__source", "__rows", "__rate", "__draws", "__steps"))


def mix(df: DataFrame, weights: dict[str, float] | None = None, source: str = "source",
        id_column: str = "doc_id", total: float | None = None, seed: int = 9) -> DataFrame:
    """Replicated and globally shuffled rows, with copy, copies and shuffle_key."""
    per = rates(df, weights, source, total)
    sources, highest = per.agg(F.count(F.lit(1)), F.coalesce(F.max("__rate"), F.lit(0.0))).first()
    if sources <= BROADCAST_SOURCES:
        per = F.broadcast(per)
    names = [c for c in df.columns if c not in ("copy", "copies", "shuffle_key")]
    # The row travels as one struct, so that its columns can't clash with the names here.
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(source).alias("__from"),
                     F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("__id"))
    rows = rows.join(per, F.col("__from").eqNullSafe(F.col("__source")))
    draw = lambda i: F.size(F.filter(F.col("__steps"), lambda s: s <= uniform(seed, F.col("__id"), i)))
    several = F.aggregate(F.sequence(F.lit(1), F.col("__draws")), F.lit(0), lambda n, i: n + draw(i))
    rows = rows.withColumn("copies", F.when(F.col("__rate") > 0, several).otherwise(0)).where("copies > 0")
    if highest > RANGE / 4:
        # a row per range of copies, dealt by row and range; then the copies
        rows = rows.withColumn("part", F.explode(F.sequence(F.lit(0), F.expr(f"int((copies - 1) div {RANGE})"))))
        rows = rows.repartition("__id", "__from", "part")
        rows = rows.withColumn("copy", F.explode(F.sequence(F.col("part") * RANGE + 1, F.least("copies", (F.col("part") + 1) * RANGE))))
    else:
        rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    key = F.md5(F.concat_ws("|", F.lit(f"{seed}s"), F.col("__id"), F.col("copy").cast("string")).cast("binary"))
    out = rows.select("row.*", "copy", "copies", key.alias("shuffle_key"))
    return out.repartition("shuffle_key").sortWithinPartitions("shuffle_key")
