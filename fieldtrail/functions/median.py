"""Exact medians of whole numbers for groups of any size, with totals from the same pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# A bin spans 2^16 values, so one task sees at most 65,536 distinct values of
# one bin, and a group of durations up to 20 years has under 10,000 bins.
_BIN_BITS = 16


def grouped_numbers(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``keys`` -> rows, total and median of the long column ``value``.

    The median is the mean of the two middle values. Null values count as rows only; a group without any other value has a
    null total and median. ``percentile`` would hold all distinct values of a group in one aggregation buffer. Here a
    counted histogram, which carries the totals as well, finds the bin that holds the middle ranks, and only that bin is
    then ranked value by value. Null keys are groups too: the keys are compared as one struct. Neither it nor a bin is
    null, so that the join asks for no filter and both its sides read one shuffle of counts.
    """
    counts = (
        df.select(F.struct(*keys).alias("_g"), F.col(value).cast("long").alias("_value"))
        .groupBy("_g", "_value")
        .agg(F.count("*").alias("_rows"))
        .withColumn("_bin", F.coalesce(F.shiftright("_value", _BIN_BITS), F.lit(-(2**63))))
        .withColumn("_n", F.when(F.col("_value").isNull(), F.lit(0)).otherwise(F.col("_rows")))
    )
    group = Window.partitionBy("_g")
    totals = ["_rows", "_sum"]
    bins = (
        counts.groupBy("_g", "_bin")
        .agg(
            F.sum("_n").alias("_n"),
            F.sum("_rows").alias("_rows"),
            F.sum(F.col("_value") * F.col("_n")).alias("_sum"),
        )
        .withColumn("_end", F.sum("_n").over(group.orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0)))
        .withColumns({"_total": F.sum("_n").over(group), **{c: F.sum(c).over(group) for c in totals}})
        .select(
            "_g",
            "_bin",
            (F.col("_end") - F.col("_n")).alias("_before"),
            "_end",
            F.expr("(_total - 1) div 2").alias("_low"),
            F.expr("_total div 2").alias("_high"),
            "_total",
            *totals,
        )
        # The bins of the middle ranks; a group of nulls only keeps its one bin.
        .filter("(_low >= _before and _low < _end) or (_high >= _before and _high < _end) or _total = 0")
        .drop("_end", "_total")
    )
    left = counts.select(F.col("_g").alias("_l_g"), F.col("_bin").alias("_l_bin"), "_value", "_n")
    match = (F.col("_l_g") == F.col("_g")) & (F.col("_l_bin") == F.col("_bin"))
    by_value = Window.partitionBy("_g", "_bin").orderBy("_value").rowsBetween(Window.unboundedPreceding, 0)
    return (
        bins.join(left, match)
        .withColumn("_end", F.col("_before") + F.sum("_n").over(by_value))
        .groupBy("_g")
        .agg(
            F.min(F.when(F.col("_end") > F.col("_low"), F.col("_value"))).alias("_a"),
            F.min(F.when(F.col("_end") > F.col("_high"), F.col("_value"))).alias("_b"),
            *[F.max(c).alias(c) for c in totals],
        )
        .select(
            "_g.*",
            F.col("_rows").alias("rows"),
            F.col("_sum").alias("total"),
            ((F.col("_a") + F.col("_b")) / F.lit(2.0)).alias("median"),
        )
    )


def grouped_median(df: DataFrame, keys: Sequence[str], value: str, out: str = "median") -> DataFrame:
    """``keys`` -> median of the long column ``value``. A group of nulls has no row."""
    found = grouped_numbers(df.filter(F.col(value).isNotNull()), keys, value)
    return found.select(*keys, F.col("median").alias(out))
