"""Quantiles of any range of months from stored sketches.

A month's values become one KLL sketch of a few kilobytes; sketches of a range merge into one, whose quantiles are as good as if the
range had been read at once. Exact quantiles, which sort the values, stay in `ordering.exact_quantiles`; `rank_error` holds one
against the other."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size parameter of the sketches, and the rank error that a quantile keeps with a probability of 99 % at that size.
SKETCH_K, RANK_ERROR = 400, 0.0070


def month_number(year: str = "ano", month: str = "mes") -> Column:
    return F.col(year) * 12 + F.col(month) - 1


def month_sketches(values: DataFrame, column: str, k: int = SKETCH_K) -> DataFrame:
    """(ano, mes): number of values and their sketch, built in every task before the shuffle. Null and NaN values are left out."""
    sound = values.where(F.col(column).isNotNull() & ~F.isnan(F.col(column).cast("double")))
    return sound.groupBy("ano", "mes").agg(F.count(F.lit(1)).alias("valores"), F.kll_sketch_agg_double(F.col(column).cast("double"), F.lit(k)).alias("rascunho"))


def in_ranges(rows: DataFrame, ranges: DataFrame) -> DataFrame:
    """Rows with each range (inicio, fim: month numbers, closed) that holds their month; an equality join on the month."""
    months = ranges.select(*ranges.columns, F.explode(F.sequence("inicio", "fim")).alias("_mes"))
    return rows.withColumn("_mes", month_number()).join(months, "_mes").drop("_mes")


def merged_quantiles(sketches: DataFrame, ranges: DataFrame, probs: dict[str, float], k: int = SKETCH_K) -> DataFrame:
    """One row per range with values: their number and the quantiles named in `probs`.

    Ranges meet month sketches, not values; sketches of a range are merged in part before the shuffle."""
    merged = in_ranges(sketches, ranges).groupBy("inicio", "fim").agg(F.sum("valores").alias("valores"), F.kll_merge_agg_double("rascunho", F.lit(k)).alias("_r"))
    return merged.select("inicio", "fim", "valores", *[F.kll_sketch_get_quantile_double("_r", F.lit(p)).alias(name) for name, p in probs.items()])


def rank_error(values: DataFrame, column: str, estimates: DataFrame, probs: dict[str, float]) -> DataFrame:
    """How far the estimates' true ranks lie from those asked for, per range: 0 where the asked rank falls on the estimate itself."""
    found = in_ranges(values, estimates)
    n = F.count(column).cast("double")

    def off(name: str, p: float) -> Column:
        low, high = (F.count_if(F.col(column) < F.col(name)) / n, F.count_if(F.col(column) <= F.col(name)) / n)
        return F.greatest(low - p, p - high, F.lit(0.0)).alias(f"erro_{name}")

    return found.groupBy("inicio", "fim").agg(*[off(name, p) for name, p in probs.items()])
