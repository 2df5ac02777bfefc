"""Exact distinct customers over any window of days, from one bitmap per day.

Customers get dense numbers; a day's buyers are a bitmap per block of 32,768 numbers. A union of bitmaps counts no one twice, so the same
stored rows answer every window: a range of days is an OR per block, and a window that slides over the days is an OR over the
neighbouring rows of its block. Nothing is counted again from the fact."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vendaflow.functions.dates import as_date
from vendaflow.session import materialize

#: Slots that customers are dealt over while they are numbered.
SLOTS = 4096


def dense_numbers(entities: DataFrame, column: str, known: DataFrame | None = None) -> DataFrame:
    """(column, numero): numbers from 1 without gaps for the distinct values, nulls left out. Values in `known`, numbers of an
    earlier run, keep theirs and new ones follow.

    Each slot of a hash is numbered alone and begins after the slots before it; the offsets are one row per slot."""
    fresh = entities.select(column).where(F.col(column).isNotNull()).distinct()
    top = F.lit(0)
    if known is not None:
        fresh = fresh.join(known.select(column), column, "left_anti")
        top = F.coalesce(known.agg(F.max("numero").alias("n")).scalar(), F.lit(0))
    dealt = materialize(fresh.withColumn("_slot", F.pmod(F.xxhash64(column), F.lit(SLOTS))), "numerar")
    counts = dealt.groupBy("_slot").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_slot").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")
    offsets = counts.select("_slot", before.alias("_antes"))
    local = F.row_number().over(Window.partitionBy("_slot").orderBy(column))
    numbered = dealt.withColumn("_local", local).join(offsets, "_slot").select(column, (top + F.col("_antes") + F.col("_local")).cast("long").alias("numero"))
    return numbered if known is None else known.select(column, "numero").unionAll(numbered)


def bitmaps(rows: DataFrame, numbers: DataFrame, column: str, keys: Sequence[str]) -> DataFrame:
    """(keys, bloco): bitmap of the numbered values of `column` seen under the keys. Repeated rows collapse before the shuffle."""
    return (rows.select(*keys, column).distinct().join(numbers, column)
            .groupBy(*keys, F.bitmap_bucket_number("numero").alias("bloco")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("numero")).alias("mapa")))


def distinct_count(maps: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Distinct values in the union of the given bitmaps, per `by`."""
    blocks = maps.groupBy(*by, "bloco").agg(F.bitmap_count(F.bitmap_or_agg("mapa")).alias("n"))
    return blocks.groupBy(*by).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("distintos"))


def distinct_by_day(maps: DataFrame, day: str, start: str | date, end: str | date, windows: Sequence[int]) -> DataFrame:
    """For every day of the closed range and each length in `windows`: distinct values seen on that day or in so many days before.

    One pass over the bitmaps of the range and the longest window before it: blocks are dealt out once, and within a block a
    window covers neighbouring days. Days without a row are part of the result."""
    first, last, longest = as_date(start), as_date(end), max(windows)
    near = maps.where(F.col(day).between(F.date_sub(F.lit(first), longest), F.lit(last))).select(F.col(day).alias("dia"), "bloco", "mapa")
    blocks = near.select("bloco").distinct()
    days = F.explode(F.sequence(F.lit(first), F.lit(last))).alias("dia")
    asked = blocks.select(days, "bloco", F.lit(None).cast("binary").alias("mapa"))
    order = F.unix_date("dia")
    rows = near.unionAll(asked).groupBy("dia", "bloco").agg(F.first("mapa", True).alias("mapa"))

    def seen(length: int):
        over = Window.partitionBy("bloco").orderBy(order).rangeBetween(-length, 0)
        return F.bitmap_count(F.bitmap_or_agg("mapa").over(over)).alias(f"_{length}")

    counts = rows.select("dia", *[seen(n) for n in windows]).where(F.col("dia") >= F.lit(first)).groupBy("dia").agg(*[F.sum(f"_{n}").alias(f"_{n}") for n in windows])
    every = maps.sparkSession.range(1).select(days).join(counts, "dia", "left")
    return every.select("dia", F.explode(F.array(*[F.struct(F.lit(n).alias("janela"), F.coalesce(f"_{n}", F.lit(0)).alias("distintos")) for n in windows])).alias("w")).select("dia", "w.*")
