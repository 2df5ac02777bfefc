"""The twenty features at many cut-offs from one scan of the fact.

The cut-offs and the dates that their windows begin and end on split time into segments. What a customer did within a segment is a
small summary (first and last day, orders, sums, squared gaps), and summaries of neighbouring segments merge in order: sums add up, and the gap
between the last day of one and the first day of the next joins the squares. A running merge over a customer's segments thus gives the state
at every date, however long the history is; distinct counts become running counts of first purchases."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vendaflow.functions.dates import as_date, date_window, days_before
from vendaflow.operators.features import LAUNCH_DAYS, LOOKBACK_DAYS, VISIT_WITH_ORDER, ZERO_WHEN_ABSENT, rhythm_columns, rhythm_cutoff
from vendaflow.operators.gold import ratio
from vendaflow.schemas import FEATURES
from vendaflow.session import materialize

#: What the state at a date is used for: totals at the cut-off, rhythm a week earlier, the beginning of the 90 days before that.
TOTALS, RHYTHM, OLDER = "totais", "ritmo", "antes"
#: Cut-offs whose sums stand side by side as columns.
REFS_AT_ONCE = 16


@dataclass(frozen=True)
class Timeline:
    """Cut-offs, and all dates at which a state is needed."""

    refs: tuple[date, ...]

    @classmethod
    def of(cls, refs: Sequence[str | date]) -> Timeline:
        return cls(tuple(sorted({as_date(r) for r in refs})))

    def dates(self, ref: date) -> dict[str, date]:
        cut = rhythm_cutoff(ref)
        return {TOTALS: ref, RHYTHM: cut, OLDER: days_before(cut, LOOKBACK_DAYS)}

    @property
    def points(self) -> list[date]:
        return sorted({d for r in self.refs for d in self.dates(r).values()})

    def segment(self, day: str) -> Column:
        """Number of points on or before the day: the state at point k covers the segments 0 to k."""
        return reduce(Column.__add__, [(F.col(day) >= F.lit(p)).cast("int") for p in self.points])

    def uses(self, *roles: str) -> Column:
        """Literal list of (k, ref, role) for the given uses."""
        at = {p: k for k, p in enumerate(self.points)}
        return F.array(*[F.struct(F.lit(at[d]).alias("k"), F.lit(r).alias("ref"), F.lit(role).alias("role"))
                         for r in self.refs for role, d in self.dates(r).items() if role in roles])


def _states(df: DataFrame, keys: list[str], uses: Column) -> DataFrame:
    """Rows of running states, one per key and segment with changes, at every date that asks for them: a state holds until the key's
    next segment. Columns ref and role are added; `_seg` goes."""
    following = F.lead("_seg").over(Window.partitionBy(*keys).orderBy("_seg"))
    wanted = F.filter(uses, lambda u: (u["k"] >= F.col("_seg")) & (F.col("_next").isNull() | (u["k"] < F.col("_next"))))
    return (df.withColumn("_next", following).withColumn("_use", F.explode(wanted))
            .select(*[c for c in df.columns if c != "_seg"], F.col("_use.ref").alias("_referencia"), F.col("_use.role").alias("_role")))


def _running(df: DataFrame, keys: list[str], sums: list[str]) -> DataFrame:
    over = Window.partitionBy(*keys).orderBy("_seg").rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({c: F.sum(c).over(over) for c in sums})


def customer_segments(days: DataFrame, timeline: Timeline) -> DataFrame:
    """Summary of each (customer, segment) from one row per customer and day."""
    inner = Window.partitionBy("cliente_id", "_seg").orderBy("data_pedido")
    gap = F.datediff("data_pedido", F.lag("data_pedido").over(inner)).cast("long")
    return (days.withColumn("_seg", timeline.segment("data_pedido")).withColumn("_gap", gap).groupBy("cliente_id", "_seg")
            .agg(F.min("data_pedido").alias("_primeiro"), F.max("data_pedido").alias("_ultimo"), F.sum("pedidos").alias("_pedidos"),
                 F.sum("receita").alias("_receita"), F.sum("margem").alias("_margem"), F.coalesce(F.sum(F.col("_gap") * F.col("_gap")), F.lit(0)).alias("_quadrados")))


def merged(segments: DataFrame) -> DataFrame:
    """The merge of each customer's summaries up to and including every segment."""
    by = Window.partitionBy("cliente_id").orderBy("_seg")
    link = F.coalesce(F.datediff("_primeiro", F.lag("_ultimo").over(by)).cast("long"), F.lit(0))
    linked = segments.withColumn("_quadrados", F.col("_quadrados") + link * link)
    whole = _running(linked, ["cliente_id"], ["_pedidos", "_receita", "_margem", "_quadrados"])
    return whole.withColumn("_primeiro", F.min("_primeiro").over(by.rowsBetween(Window.unboundedPreceding, 0)))


def _rhythm(orders: DataFrame, timeline: Timeline) -> DataFrame:
    days = orders.groupBy("cliente_id", "data_pedido").agg(F.count(F.lit(1)).alias("pedidos"), F.sum("receita").alias("receita"), F.sum("margem").alias("margem"))
    states = _states(merged(customer_segments(days, timeline)), ["cliente_id"], timeline.uses(TOTALS, RHYTHM, OLDER))

    def at(role: str, column: str) -> Column:
        return F.max(F.when(F.col("_role") == role, F.col(column)))

    per_customer = states.groupBy("cliente_id", "_referencia").agg(
        at(TOTALS, "_pedidos").cast("double").alias("frequencia_pedidos"), at(TOTALS, "_receita").cast("double").alias("valor_total"),
        at(TOTALS, "_margem").cast("double").alias("margem_total"),
        *[at(RHYTHM, c).alias(c) for c in ("_primeiro", "_ultimo", "_pedidos", "_quadrados")],
        (F.coalesce(at(RHYTHM, "_pedidos"), F.lit(0)) - F.coalesce(at(OLDER, "_pedidos"), F.lit(0))).cast("double").alias("pedidos_ultimos_90d"))
    cut = F.date_sub("_referencia", days_before(timeline.refs[0], 0).toordinal() - rhythm_cutoff(timeline.refs[0]).toordinal())
    return per_customer.where("frequencia_pedidos IS NOT NULL").select("cliente_id", "_referencia", *rhythm_columns(cut))


def _mix(items: DataFrame, products: DataFrame, timeline: Timeline) -> list[DataFrame]:
    """Running counts of first purchases, best and whole brand revenue, and launches bought, per customer and cut-off."""
    skus = materialize(items.groupBy("cliente_id", "sku", "categoria", "marca").agg(F.min("_seg").alias("_seg")), "primeiras")

    def first(column: str, out: str) -> DataFrame:
        distinct = skus.where(F.col(column).isNotNull()).groupBy("cliente_id", *(skus.columns[1:4] if column == "sku" else [column])).agg(F.min("_seg").alias("_seg"))
        return distinct.select("cliente_id", "_seg", *[F.lit(int(c == out)).alias(c) for c in _COUNTED])

    counted = reduce(DataFrame.unionAll, [first("sku", "skus_distintos"), first("categoria", "categorias_distintas"), first("marca", "marcas_distintas")])
    counts = counted.groupBy("cliente_id", "_seg").agg(*[F.sum(c).alias(c) for c in _COUNTED])
    totals = timeline.uses(TOTALS)
    distinct = _states(_running(counts, ["cliente_id"], _COUNTED), ["cliente_id"], totals).select("cliente_id", "_referencia", *[F.col(c).cast("double").alias(c) for c in _COUNTED])

    share = _top_share(items.groupBy("cliente_id", "marca", "_seg").agg(F.sum("receita").alias("receita")), timeline)

    launched = products.where("data_lancamento IS NOT NULL").groupBy(F.col("sku").alias("_novo")).agg(F.max("data_lancamento").alias("_lancado"))
    reached = F.filter(totals, lambda u: (u["k"] >= F.col("_seg")) & (F.col("_lancado") >= F.date_sub(u["ref"], LAUNCH_DAYS)))
    launches = (skus.join(launched, F.col("sku") == F.col("_novo")).select("cliente_id", F.explode(reached).alias("_use"))
                .groupBy("cliente_id", F.col("_use.ref").alias("_referencia")).agg(F.lit(1.0).alias("comprou_lancamento")))
    return [distinct, share, launches]


def _top_share(brands: DataFrame, timeline: Timeline) -> DataFrame:
    """Best brand's part of a customer's revenue at every cut-off. A brand stays one row, with a running sum per cut-off as a column, until it
    is folded into its customer; rows per brand and cut-off would be as many as brands times cut-offs."""
    at = {p: k for k, p in enumerate(timeline.points)}

    def some(refs: Sequence[date]) -> DataFrame:
        spent = brands.groupBy("cliente_id", "marca").agg(*[F.sum(F.when(F.col("_seg") <= at[r], F.col("receita"))).alias(f"_r{i}") for i, r in enumerate(refs)])
        wide = spent.groupBy("cliente_id").agg(*[ratio(F.max(f"_r{i}").cast("double"), F.sum(f"_r{i}").cast("double")).alias(f"_r{i}") for i in range(len(refs))])
        shares = F.array(*[F.struct(F.lit(r).alias("ref"), F.col(f"_r{i}").alias("share")) for i, r in enumerate(refs)])
        return (wide.select("cliente_id", F.explode(shares).alias("_s")).where("_s.share IS NOT NULL")
                .select("cliente_id", F.col("_s.ref").alias("_referencia"), F.col("_s.share").alias("concentracao_marca_top")))

    refs = timeline.refs
    return reduce(DataFrame.unionAll, [some(refs[i:i + REFS_AT_ONCE]) for i in range(0, len(refs), REFS_AT_ONCE)])


_COUNTED = ["skus_distintos", "categorias_distintas", "marcas_distintas"]


def _opportunities(opps: DataFrame, timeline: Timeline) -> DataFrame:
    won, lost = F.col("ganancia"), F.col("perdida")
    per_segment = (opps.where(F.col("data_abertura") < F.lit(timeline.refs[-1])).groupBy("cliente_id", timeline.segment("data_abertura").alias("_seg"))
                   .agg(F.count_if(~won & ~lost).alias("_abertas"), F.count_if(won).alias("_ganhas"), F.count(F.lit(1)).alias("_todas")))
    states = _states(_running(per_segment, ["cliente_id"], ["_abertas", "_ganhas", "_todas"]), ["cliente_id"], timeline.uses(TOTALS))
    return states.select("cliente_id", "_referencia", F.col("_abertas").cast("double").alias("oportunidades_abertas"),
                         F.col("_ganhas").cast("double").alias("oportunidades_ganhas"),
                         ratio(F.col("_ganhas").cast("double"), F.col("_todas").cast("double")).alias("taxa_ganho"))


def _visits(visit_rows: DataFrame, timeline: Timeline) -> DataFrame:
    per_segment = (visit_rows.where(F.col("data_visita") < F.lit(timeline.refs[-1])).groupBy("cliente_id", timeline.segment("data_visita").alias("_seg"))
                   .agg(F.count(F.lit(1)).alias("_visitas"), F.count_if(F.col("resultado") == VISIT_WITH_ORDER).alias("_vendas")))
    states = _states(_running(per_segment, ["cliente_id"], ["_visitas", "_vendas"]), ["cliente_id"], timeline.uses(RHYTHM, OLDER))
    sign = F.when(F.col("_role") == RHYTHM, 1).otherwise(-1)
    window = states.groupBy("cliente_id", "_referencia").agg(*[F.sum(sign * F.col(c)).cast("double").alias(c) for c in ("_visitas", "_vendas")])
    return window.select("cliente_id", "_referencia", F.col("_visitas").alias("visitas_90d"), ratio(F.col("_vendas"), F.col("_visitas")).alias("conversao_visita"))


def feature_history(fact: DataFrame, opps: DataFrame, visit_rows: DataFrame, products: DataFrame, refs: Sequence[str | date]) -> DataFrame:
    """`feature_table` at every cut-off of `refs`, one row per cut-off and customer with a sale before it.

    The fact is read once, rolled up to orders and to (customer, SKU, segment) in one grouping, and written; all lines of an order
    are taken to have one date. Work after that grows with the customers' segments, not with cut-offs times history."""
    timeline = Timeline.of(refs)
    if not timeline.refs:
        raise ValueError("at least one cut-off")
    rows = fact.where(date_window("data_pedido", end=timeline.refs[-1], year="ano", month="mes")).select(
        "cliente_id", "pedido_id", "data_pedido", "sku", "categoria", "marca", timeline.segment("data_pedido").alias("_seg"), "receita", "margem")
    orders, shelves = ["cliente_id", "pedido_id", "data_pedido"], ["cliente_id", "sku", "categoria", "marca", "_seg"]
    rolled = materialize(rows.groupingSets([orders, shelves], *orders, *shelves[1:]).agg(
        F.grouping("pedido_id").alias("_item"), F.sum("receita").alias("receita"), F.sum("margem").alias("margem")), "resumos")
    parts = [*_mix(rolled.where("_item = 1").select(*shelves, "receita"), products, timeline), _opportunities(opps, timeline), _visits(visit_rows, timeline)]
    joined = reduce(lambda a, b: a.join(b, ["cliente_id", "_referencia"], "left"), parts, _rhythm(rolled.where("_item = 0").select(*orders, "receita", "margem"), timeline))
    filled = joined.withColumns({c: F.coalesce(c, F.lit(0.0)) for c in (*ZERO_WHEN_ABSENT, "comprou_lancamento")})
    return filled.select("cliente_id", *FEATURES, "sem_historico_ritmo", "_referencia")
