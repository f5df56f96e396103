"""Exact ranks and quantiles for groups of any size.

A window or ``percentile`` over a whole group sends that group to one task.
Here a group is first reduced to (value, count) pairs with map-side combine,
and the pairs are partitioned by ranges of (group, value).  The ranges follow the
data, so a large group is split however close its values lie.  A running sum over
the partitions of a group touches one row per partition; the exact position inside
a partition is settled in a window.  The partition number is written with the pairs,
so a retried task sees the same ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandloom.functions.stats import lerp
from demandloom.session import stage


def histogram(df: DataFrame, keys: list[str], value: str, *measures: Column) -> DataFrame:
    """(keys, _v, _b, measures) with one row per distinct value of a group; ``_b`` is the
    range it fell in, increasing with the value inside a group.

    Staged, because it is read twice below: the rows themselves are scanned and
    shuffled only once.  Rows with a null key or value are left out.
    """
    measures = measures or (F.count(F.lit(1)).alias("_n"),)
    counts = (
        df.dropna(subset=[*keys, value])
        .groupBy(*keys, F.col(value).cast("double").alias("_v"))
        .agg(*measures)
        .repartitionByRange(*[F.col(f"`{k}`") for k in keys], "_v")
        .withColumn("_b", F.spark_partition_id())
    )
    return stage(counts, "histogram")


def cumulate(hist: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Add ``<measure>_cum`` (inclusive running sum) and ``<measure>_all`` to a histogram."""
    by_bucket = hist.groupBy(*keys, "_b").agg(*[F.sum(m).alias(f"{m}_bucket") for m in measures])
    group = Window.partitionBy(*keys)
    earlier = group.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_bucket.select(
        *keys,
        "_b",
        *[
            F.coalesce(F.sum(f"{m}_bucket").over(earlier), F.lit(0)).alias(f"{m}_before")
            for m in measures
        ],
        *[F.sum(f"{m}_bucket").over(group).alias(f"{m}_all") for m in measures],
    )
    inside = (
        Window.partitionBy(*keys, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    )
    joined = hist.join(offsets, [*keys, "_b"])
    return joined.select(
        *hist.columns,
        *[(F.col(f"{m}_before") + F.sum(m).over(inside)).alias(f"{m}_cum") for m in measures],
        *[f"{m}_all" for m in measures],
    )


def exact_quantiles(
    df: DataFrame, keys: list[str], value: str, probs: dict[str, float]
) -> DataFrame:
    """Linear-interpolation quantiles per group: (keys, n, smallest, <one column per prob>).

    Nulls are ignored; groups without any value do not appear.
    """
    hist = histogram(df, keys, value)
    by_bucket = hist.groupBy(*keys, "_b").agg(
        F.sum("_n").alias("_bucket_n"), F.min("_v").alias("_bucket_min")
    )
    group = Window.partitionBy(*keys)
    earlier = group.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    ranked = by_bucket.select(
        *keys,
        "_b",
        "_bucket_n",
        F.coalesce(F.sum("_bucket_n").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_bucket_n").over(group).alias("_all"),
        F.min("_bucket_min").over(group).alias("_smallest"),
    )

    def position(prob: float) -> Column:
        return (F.col("_all") - 1) * F.lit(float(prob))

    ranks = [side(position(p)).cast("long") for p in probs.values() for side in (F.floor, F.ceil)]
    holds_target = None
    for rank in ranks:
        hit = (rank >= F.col("_before")) & (rank < F.col("_before") + F.col("_bucket_n"))
        holds_target = hit if holds_target is None else holds_target | hit
    wanted = ranked.where(holds_target).drop("_bucket_n")

    inside = (
        Window.partitionBy(*keys, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    )
    placed = hist.join(wanted, [*keys, "_b"]).withColumn(
        "_end", F.col("_before") + F.sum("_n").over(inside)
    )

    def value_at(rank: Column) -> Column:
        covers = (rank < F.col("_end")) & (rank >= F.col("_end") - F.col("_n"))
        return F.max(F.when(covers, F.col("_v")))

    picks = []
    for name, prob in probs.items():
        where = position(prob)
        picks.append(value_at(F.floor(where).cast("long")).alias(f"_{name}_low"))
        picks.append(value_at(F.ceil(where).cast("long")).alias(f"_{name}_high"))
    picked = placed.groupBy(*keys).agg(
        F.max("_all").alias("_all"), F.max("_smallest").alias("smallest"), *picks
    )
    return picked.select(
        *keys,
        F.col("_all").alias("n"),
        "smallest",
        *[
            lerp(
                F.col(f"_{name}_low"),
                F.col(f"_{name}_high"),
                position(prob) - F.floor(position(prob)),
            ).alias(name)
            for name, prob in probs.items()
        ],
    )


def most_frequent(hist: DataFrame, keys: list[str], value: str, count: str) -> DataFrame:
    """Mode per group from (keys, value, count) rows; the smallest value wins a tie."""
    best = F.max(F.struct(F.col(count).alias("n"), (-F.col(value)).alias("negated")))
    return hist.groupBy(*keys).agg(best.alias("_best")).select(
        *keys, (-F.col("_best.negated")).alias(value)
    )


def block_start(seq: Column, rows_per_block: int) -> Column:
    """Start of the block of sequence numbers a row falls in (whole-number arithmetic)."""
    return seq - F.pmod(seq, F.lit(rows_per_block))


def number_rows(
    df: DataFrame, keys: list[str], order: str, block: Column, out: str = "position"
) -> DataFrame:
    """1-based row number and group size without sending a group to one task.

    ``block`` must be non-decreasing in ``order`` and bound the rows per block;
    ``order`` must be unique within a group.  Adds ``out`` and ``<out>_total``.
    """
    blocked = df.withColumn("_block", block)
    sizes = blocked.groupBy(*keys, "_block").agg(F.count(F.lit(1)).alias("_rows"))
    group = Window.partitionBy(*keys)
    earlier = group.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *keys,
        "_block",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_rows").over(group).alias(f"{out}_total"),
    )
    inside = Window.partitionBy(*keys, "_block").orderBy(order)
    return (
        blocked.withColumn("_within", F.row_number().over(inside))
        .join(offsets, [*keys, "_block"])
        .withColumn(out, F.col("_before") + F.col("_within"))
        .drop("_block", "_before", "_within")
    )
