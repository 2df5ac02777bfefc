"""Running totals, row numbers and quantiles over unbounded groups.

A window ordered over a whole table, or over a month with billions of SKUs, sorts everything in one
task. Here the order axis is first cut into value buckets by a fixed monotone rule (no sampling, so
a recomputed partition lands in the same bucket). Each bucket is scanned on its own, and a small
table with one row per bucket carries the totals of the buckets before it. Tied values are folded
into one row before any ordering, so a value shared by a third of the rows costs one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vendaflow.session import materialize

# Buckets per doubling of the value. One bucket spans 0.017 % of its value; FINE parts split it further, so that a
# measure whose values lie close together (epoch numbers, scores near 1) is still spread over many tasks.
BUCKETS_PER_DOUBLING, FINE = 4096, 256
# Shifts the smallest positive double (2 ** -1074) to a positive bucket number; the largest is below twice that.
_OFFSET = 1075 * BUCKETS_PER_DOUBLING
_TOP = 2 * _OFFSET
# Hex digits of the tie hash that split the holders of one value into slots.
_SLOT_DIGITS = 3
# Rows that one window of `row_numbers` orders at most; bits by which its cells are coarser than buckets (256 a doubling).
CELL_ROWS, _CELL_BITS = 65_536, 4


def _scaled(value: Column) -> tuple[Column, Column]:
    """The value as a double, and its logarithm in buckets (NULL for zero, NaN and the infinities)."""
    v = value.cast("double")
    finite = F.when((v != 0) & (F.abs(v) < F.lit(float("inf"))), F.abs(v))
    return v, F.log2(finite) * BUCKETS_PER_DOUBLING


def order_bucket(value: Column) -> Column:
    """Monotone non-decreasing bucket number in Spark's ascending order: NULL, -Infinity, numbers, Infinity, NaN."""
    v, scaled = _scaled(value)
    size = F.floor(scaled) + _OFFSET
    return (F.when(v.isNull(), F.lit(-_TOP - 1)).when(F.isnan(v), F.lit(_TOP + 1))
            .when(v == F.lit(float("inf")), F.lit(_TOP)).when(v == F.lit(float("-inf")), F.lit(-_TOP))
            .when(v > 0, size).when(v < 0, -size).otherwise(F.lit(0))).cast("long")


def fine_bucket(value: Column) -> Column:
    """Monotone part of a bucket, 0 to FINE - 1."""
    v, scaled = _scaled(value)
    part = F.floor((scaled - F.floor(scaled)) * FINE)
    return F.coalesce(F.when(v < 0, FINE - 1 - part).otherwise(part), F.lit(0)).cast("int")


def join_whole(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on equally named keys where NULL matches NULL.

    Structs compare field by field and hold NULLs, so this stays a plain hash-partitioned equi-join;
    a null-safe operator would be planned on derived keys and shuffle both sides again.
    """
    key = F.struct(*keys)
    r = right.withColumn("_j", key).drop(*keys)
    return left.withColumn("_j", key).join(r, "_j", how).drop("_j")


def running_totals(df: DataFrame, part: list[str], value: str, amounts: dict[str, Column],
                   descending: bool = False) -> DataFrame:
    """One row per (part, value) with, for every amount `a`, columns `a` (sum of the value's rows),
    `a_ate` (running sum including ties) and `a_total` (sum of the part)."""
    names = list(amounts)
    group = F.struct(*part).alias("_g") if part else F.struct(F.lit(0)).alias("_g")
    tied = df.groupBy(group, value).agg(*[F.sum(c).alias(n) for n, c in amounts.items()])
    bucket, fine = order_bucket(F.col(value)), fine_bucket(F.col(value))
    tied = tied.withColumns({"_bucket": -bucket if descending else bucket, "_fine": -fine if descending else fine})

    # Totals of earlier buckets, and of earlier parts of the same bucket: two small ordered tables, both bounded by the
    # bucket rule, whatever the number of values.
    parts = tied.groupBy("_g", "_bucket", "_fine").agg(*[F.sum(n).alias(f"_h_{n}") for n in names])
    buckets = parts.groupBy("_g", "_bucket").agg(*[F.sum(f"_h_{n}").alias(f"_h_{n}") for n in names])

    def earlier(keys: list[str], order: str, n: str) -> Column:
        frame = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(f"_h_{n}").over(frame), F.lit(0))
    whole = Window.partitionBy("_g")
    buckets = buckets.select("_g", "_bucket", *[earlier(["_g"], "_bucket", n).alias(f"_b_{n}") for n in names],
                             *[F.sum(f"_h_{n}").over(whole).alias(f"{n}_total") for n in names])
    parts = parts.select("_g", "_bucket", "_fine", *[earlier(["_g", "_bucket"], "_fine", n).alias(f"_f_{n}") for n in names])
    heads = parts.join(buckets, ["_g", "_bucket"])

    axis = F.col(value).desc() if descending else F.col(value).asc()
    inside = (Window.partitionBy("_g", "_bucket", "_fine").orderBy(axis)
              .rowsBetween(Window.unboundedPreceding, 0))
    local = tied.select("*", *[F.sum(n).over(inside).alias(f"_l_{n}") for n in names])
    return local.join(heads, ["_g", "_bucket", "_fine"]).select(
        *[F.col(f"_g.{c}").alias(c) for c in part], value, *names,
        *[(F.col(f"_b_{n}") + F.col(f"_f_{n}") + F.col(f"_l_{n}")).alias(f"{n}_ate") for n in names],
        *[f"{n}_total" for n in names])


def row_numbers(df: DataFrame, part: list[str], value: str, key: str, out: str,
                descending: bool = True) -> DataFrame:
    """`df` plus `out` = ROW_NUMBER and `{out}_n` = rows of the part.

    Order: value, then the MD5 of the key, then the key. Rows are counted by cells of neighbouring values first; a small table
    carries the rows of the cells before each, and the rows move once, to be numbered inside their cell. A cell of more than CELL_ROWS,
    as a hot value makes it, is numbered by values and tie slots instead.
    `df` is read twice, so pass a written table when it is expensive.
    """
    cell = F.shiftright(order_bucket(F.col(value)), _CELL_BITS)
    rows = df.select("*", (F.struct(*part) if part else F.struct(F.lit(0))).alias("_parte"), (-cell if descending else cell).alias("_celula"))
    at = ["_parte", "_celula"]
    earlier = Window.partitionBy("_parte").orderBy("_celula").rowsBetween(Window.unboundedPreceding, -1)
    cells = materialize(rows.groupBy(*at).agg(F.count(F.lit(1)).alias("_linhas")).select(
        *at, "_linhas", F.coalesce(F.sum("_linhas").over(earlier), F.lit(0)).alias("_ate"),
        F.sum("_linhas").over(Window.partitionBy("_parte")).alias(f"{out}_n")), "celulas")
    hot = F.col("_linhas") > CELL_ROWS
    axis = F.col(value).desc() if descending else F.col(value).asc()
    # the hash is taken after the rows have moved
    inside = F.row_number().over(Window.partitionBy(*at).orderBy(axis, _tie(key), key))

    def placed(numbered: DataFrame, own: DataFrame) -> DataFrame:
        return numbered.join(own, at).select(*df.columns, (F.col("_ate") + F.col("_local")).alias(out), f"{out}_n")

    if cells.where(hot).isEmpty():
        return placed(rows.repartition(*at).withColumn("_local", inside), cells)
    few, many = cells.where(~hot), cells.where(hot)
    usual = rows.join(many.select(*at), at, "left_anti").repartition(*at).withColumn("_local", inside)
    crowded = _tied_numbers(rows.join(many.select(*at), at, "left_semi"), at, value, key, "_local", descending)
    return placed(usual, few).unionByName(placed(crowded, many))


def _tie(key: str) -> Column:
    return F.coalesce(F.md5(F.col(key).cast("string").cast("binary")), F.lit(""))


def _tied_numbers(df: DataFrame, part: list[str], value: str, key: str, out: str, descending: bool) -> DataFrame:
    """`df` plus `out`, numbered as by `row_numbers`. The hash only decides between equal values; it spreads the holders of one hot value
    over 4,096 slots that are numbered independently."""
    at = F.struct(*part, value).alias("_at")
    tie = _tie(key)
    rows = df.select("*", at, tie.alias("_tie"), F.substring(tie, 1, _SLOT_DIGITS).alias("_slot"))
    slots = rows.groupBy("_at", "_slot").agg(F.count("*").alias("_n"))
    values = running_totals(slots.select("_n", "_at.*"), part, value, {"_q": F.col("_n")}, descending)
    values = values.select(at, (F.col("_q_ate") - F.col("_q")).alias("_antes"))
    earlier = Window.partitionBy("_at").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    slots = slots.select("_at", "_slot", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_no_valor"))
    offsets = slots.join(values, "_at")
    local = F.row_number().over(Window.partitionBy("_at", "_slot").orderBy("_tie", key))
    return (rows.select("*", local.alias("_na_vaga")).join(offsets, ["_at", "_slot"])
            .select(*df.columns, (F.col("_antes") + F.col("_no_valor") + F.col("_na_vaga")).alias(out)))


def exact_quantiles(df: DataFrame, value: str, probs: dict[str, float], part: list[str] | None = None,
                    interpolate: bool = True) -> DataFrame:
    """Exact quantiles, one row per part. `probs` maps output column to probability.

    With `interpolate`, linear between the two neighbouring ranks; otherwise the smallest value
    whose cumulative share reaches the probability.
    """
    part = part or []
    counted = running_totals(df.filter(F.col(value).isNotNull()), part, value, {"_q": F.lit(1)})
    first = F.col("_q_ate") - F.col("_q")
    v = F.col(value).cast("double")

    def at(rank: Column) -> Column:
        return F.max(F.when((first <= rank) & (rank < F.col("_q_ate")), v))

    parts, outputs = [], []
    for name, p in probs.items():
        if interpolate:
            pos = F.lit(p) * (F.col("_q_total") - 1)
            parts += [at(F.floor(pos)).alias(f"_lo_{name}"), at(F.ceil(pos)).alias(f"_hi_{name}"),
                      F.max(pos - F.floor(pos)).alias(f"_w_{name}")]
            outputs.append((F.col(f"_lo_{name}") + (F.col(f"_hi_{name}") - F.col(f"_lo_{name}"))
                            * F.col(f"_w_{name}")).alias(name))
        else:
            parts.append(at(F.greatest(F.ceil(F.lit(p) * F.col("_q_total")) - 1, F.lit(0))).alias(name))
            outputs.append(F.col(name))
    return counted.groupBy(*part).agg(*parts).select(*part, *outputs)
