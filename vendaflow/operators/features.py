"""Point-in-time customer features, label and assembly.

Two cut-offs: `ref` for totals and mix, and the rhythm cut-off `ref - 7 days` for recency, gaps and
90-day windows, so that the label week never leaks into a feature.

The fact is read twice in all: once rolled up to (customer, day) and once to (customer, SKU).
A customer's group in a window is then at most one row per calendar day, however many lines or
orders that customer has.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vendaflow.functions.dates import as_date, date_window, days_before
from vendaflow.operators.gold import ratio
from vendaflow.schemas import FEATURES, LABEL
from vendaflow.session import materialize

# Rhythm offset, look-back, launch window, lateness ceiling, label length (days).
RHYTHM_DAYS, LOOKBACK_DAYS, LAUNCH_DAYS, MAX_LATENESS, LABEL_DAYS = 7, 90, 120, 10.0, 7
VISIT_WITH_ORDER = "Pedido realizado"


def rhythm_cutoff(ref: str | date) -> date:
    return days_before(ref, RHYTHM_DAYS)


def facts_before(fact: DataFrame, ref: str | date) -> DataFrame:
    return fact.filter(date_window("data_pedido", end=ref, year="ano", month="mes"))


def customer_days(fact: DataFrame, ref: str | date) -> DataFrame:
    """(cliente_id, data_pedido): orders, revenue and margin of that day, before `ref`."""
    orders = (facts_before(fact, ref).groupBy("cliente_id", "pedido_id")
              .agg(F.min("data_pedido").alias("data_pedido"), F.sum("receita").alias("receita"),
                   F.sum("margem").alias("margem")))
    return (orders.groupBy("cliente_id", "data_pedido")
            .agg(F.count("*").alias("pedidos"), F.sum("receita").alias("receita"),
                 F.sum("margem").alias("margem")))


def order_gaps(fact: DataFrame, ref: str | date) -> DataFrame:
    """Every order before the rhythm cut-off with the date of the customer's previous order.

    LAG runs over distinct days; the first order of a day takes the previous day, the others follow
    an order of the same day.
    """
    cut = rhythm_cutoff(ref)
    orders = (facts_before(fact, cut).groupBy("cliente_id", "pedido_id")
              .agg(F.min("data_pedido").alias("data_pedido")))
    days = orders.groupBy("cliente_id", "data_pedido").agg(F.min("pedido_id").alias("_primeiro"))
    by_day = Window.partitionBy("cliente_id").orderBy("data_pedido")
    days = days.withColumn("_dia_anterior", F.lag("data_pedido").over(by_day))
    previous = (F.when(F.col("pedido_id") == F.col("_primeiro"), F.col("_dia_anterior"))
                .otherwise(F.col("data_pedido")))
    return (orders.join(days, ["cliente_id", "data_pedido"])
            .select("cliente_id", "pedido_id", "data_pedido", previous.alias("data_anterior"))
            .withColumn("gap_dias", F.datediff("data_pedido", "data_anterior")))


def rfm_and_rhythm(fact: DataFrame, ref: str | date) -> DataFrame:
    """Totals, recency, gap statistics and 90-day order count from one customer-day rollup.

    Gaps between consecutive orders sum to (last day - first day), and orders sharing a day add
    gaps of zero, so mean and deviation need only the squared day gaps.
    """
    cut = as_date(rhythm_cutoff(ref))
    in_rhythm = F.col("data_pedido") < F.lit(cut)
    recent = in_rhythm & (F.col("data_pedido") >= F.lit(days_before(cut, LOOKBACK_DAYS)))
    gap = F.datediff("data_pedido", F.lag("data_pedido").over(
        Window.partitionBy("cliente_id").orderBy("data_pedido"))).cast("long")
    per_customer = (
        customer_days(fact, ref).withColumn("_gap", gap)
        .groupBy("cliente_id")
        .agg(F.sum("pedidos").cast("double").alias("frequencia_pedidos"),
             F.sum("receita").cast("double").alias("valor_total"),
             F.sum("margem").cast("double").alias("margem_total"),
             F.min(F.when(in_rhythm, F.col("data_pedido"))).alias("_primeiro"),
             F.max(F.when(in_rhythm, F.col("data_pedido"))).alias("_ultimo"),
             F.sum(F.when(in_rhythm, F.col("pedidos"))).alias("_pedidos"),
             F.sum(F.when(in_rhythm, F.col("_gap") * F.col("_gap"))).alias("_quadrados"),
             F.sum(F.when(recent, F.col("pedidos")).otherwise(0)).cast("double")
             .alias("pedidos_ultimos_90d")))
    return per_customer.select("cliente_id", *rhythm_columns(F.lit(cut)))


def rhythm_columns(cut: Column) -> list[Column]:
    """RFM and rhythm features from a customer's totals: `_primeiro`, `_ultimo`, `_pedidos` and `_quadrados` before `cut`, and
    `frequencia_pedidos`, `valor_total`, `margem_total` and `pedidos_ultimos_90d`."""
    gaps = F.col("_pedidos") - 1
    span = F.datediff("_ultimo", "_primeiro").cast("double")
    since = F.datediff(cut, F.col("_ultimo")).cast("double")
    mean = F.when(gaps >= 1, span / gaps)
    variance = (F.coalesce("_quadrados", F.lit(0)) - span * span / gaps) / (gaps - 1)
    lateness = (F.when(F.col("_ultimo").isNull(), F.lit(None).cast("double"))
                .when(mean > 0, F.least(since / mean, F.lit(MAX_LATENESS)))
                .otherwise(F.lit(MAX_LATENESS)))
    return [F.greatest(F.lit(0.0), since).alias("recencia_dias"), F.col("frequencia_pedidos"), F.col("valor_total"),
            ratio(F.col("valor_total"), F.col("frequencia_pedidos")).alias("ticket_medio"), F.col("margem_total"),
            ratio(F.col("margem_total"), F.col("valor_total")).alias("margem_percentual"), mean.alias("intervalo_medio_dias"),
            F.when(gaps >= 2, F.sqrt(F.greatest(variance, F.lit(0.0)))).alias("desvio_intervalo_dias"), lateness.alias("atraso_relativo"),
            F.col("pedidos_ultimos_90d"), F.col("_ultimo").isNull().alias("sem_historico_ritmo")]


def orders_last_90d(fact: DataFrame, ref: str | date) -> DataFrame:
    cut = rhythm_cutoff(ref)
    recent = fact.filter(date_window("data_pedido", days_before(cut, LOOKBACK_DAYS), cut, "ano", "mes"))
    return recent.groupBy("cliente_id").agg(F.countDistinct("pedido_id").alias("pedidos_ultimos_90d"))


def opportunities(opps: DataFrame, ref: str | date) -> DataFrame:
    won, lost = F.col("ganancia"), F.col("perdida")
    return (opps.filter(F.col("data_abertura") < F.lit(as_date(ref))).groupBy("cliente_id")
            .agg(F.count_if(~won & ~lost).cast("double").alias("oportunidades_abertas"),
                 F.count_if(won).cast("double").alias("oportunidades_ganhas"),
                 F.count("*").cast("double").alias("_todas"))
            .withColumn("taxa_ganho", ratio(F.col("oportunidades_ganhas"), F.col("_todas")))
            .drop("_todas"))


def visits(visit_rows: DataFrame, ref: str | date) -> DataFrame:
    cut = rhythm_cutoff(ref)
    return (visit_rows.filter(date_window("data_visita", days_before(cut, LOOKBACK_DAYS), cut))
            .groupBy("cliente_id")
            .agg(F.count("*").cast("double").alias("visitas_90d"),
                 F.count_if(F.col("resultado") == VISIT_WITH_ORDER).cast("double").alias("_com_pedido"))
            .withColumn("conversao_visita", ratio(F.col("_com_pedido"), F.col("visitas_90d")))
            .drop("_com_pedido"))


def crm(opps: DataFrame, visit_rows: DataFrame, ref: str | date) -> DataFrame:
    return opportunities(opps, ref).join(visits(visit_rows, ref), "cliente_id", "full")


def launches(products: DataFrame, ref: str | date) -> DataFrame:
    """SKUs launched within the window; no upper bound on the launch date."""
    return (products.filter(F.col("data_lancamento") >= F.lit(days_before(ref, LAUNCH_DAYS)))
            .select("sku").distinct())


def bought_launch(fact: DataFrame, products: DataFrame, ref: str | date) -> DataFrame:
    return (facts_before(fact, ref).select("cliente_id", "sku").distinct()
            .join(launches(products, ref), "sku", "left_semi")
            .select("cliente_id").distinct())


def mix(fact: DataFrame, products: DataFrame, ref: str | date) -> DataFrame:
    """Distinct SKUs, categories and brands, share of the best brand, launch flag: one fact scan, narrowed to (customer, SKU).

    Those rows move once, by customer; categories are told apart and brands and customers grouped where they are. A category is counted
    at its first row, so no row is multiplied for a second distinct count. The launched SKUs are written, so that Spark knows their
    size and moves the customers' rows by SKU only when they are many."""
    per_sku = (facts_before(fact, ref).groupBy("cliente_id", "sku", "categoria", "marca")
               .agg(F.sum("receita").alias("receita")))
    new = materialize(launches(products, ref).select(F.col("sku").alias("_novo")), "lancamentos")
    moved = (per_sku.join(new, per_sku.sku == new["_novo"], "left")
             .select("cliente_id", "marca", "categoria", "receita", F.col("sku").isNotNull().alias("_sku"),
                     F.col("_novo").isNotNull().cast("int").alias("_lancamento")).repartition("cliente_id"))
    nth = F.row_number().over(Window.partitionBy("cliente_id", "categoria").orderBy("marca"))
    per_brand = (moved.withColumn("_categoria", (nth == 1) & F.col("categoria").isNotNull())
                 .groupBy("cliente_id", "marca")
                 .agg(F.count_if("_sku").alias("_skus"), F.sum("receita").alias("receita"), F.count_if("_categoria").alias("_categorias"),
                      F.max("_lancamento").alias("_lancamento")))
    return (per_brand.groupBy("cliente_id")
            .agg(F.sum("_skus").cast("double").alias("skus_distintos"),
                 F.sum("_categorias").cast("double").alias("categorias_distintas"),
                 F.count("marca").cast("double").alias("marcas_distintas"),
                 F.max("receita").cast("double").alias("_melhor"),
                 F.sum("receita").cast("double").alias("_total"),
                 F.max("_lancamento").cast("double").alias("comprou_lancamento"))
            .withColumn("concentracao_marca_top", ratio(F.col("_melhor"), F.col("_total")))
            .drop("_melhor", "_total"))


# Features that count or sum: absent history means zero. The others stay NULL.
ZERO_WHEN_ABSENT = ["oportunidades_abertas", "oportunidades_ganhas", "visitas_90d"]


def feature_table(fact: DataFrame, opps: DataFrame, visit_rows: DataFrame, products: DataFrame,
                  ref: str | date) -> DataFrame:
    """The twenty features of every customer with a sale before `ref`."""
    joined = (rfm_and_rhythm(fact, ref)
              .join(mix(fact, products, ref), "cliente_id", "left")
              .join(opportunities(opps, ref), "cliente_id", "left")
              .join(visits(visit_rows, ref), "cliente_id", "left"))
    filled = joined.withColumns({c: F.coalesce(c, F.lit(0.0)) for c in ZERO_WHEN_ABSENT})
    return filled.select("cliente_id", *FEATURES, "sem_historico_ritmo",
                         F.lit(as_date(ref)).alias("_referencia"))


def buyers_in_window(fact: DataFrame, ref: str | date, days: int = LABEL_DAYS) -> DataFrame:
    """Customers with a sale in the closed window [ref, ref + days - 1]."""
    start = as_date(ref)
    return (fact.filter(date_window("data_pedido", start, days_before(start, -days), "ano", "mes"))
            .select("cliente_id").distinct())


def training_table(features: DataFrame, fact: DataFrame, ref: str | date) -> DataFrame:
    label = buyers_in_window(fact, ref).withColumn(LABEL, F.lit(1.0))
    return (features.join(label, "cliente_id", "left")
            .withColumn(LABEL, F.coalesce(LABEL, F.lit(0.0))))


def feature_checks(training: DataFrame, scoring: DataFrame) -> DataFrame:
    """Leak proofs per table: customers, cut-off, base rate (training only), smallest recency."""
    def facts(df: DataFrame, name: str, buyers) -> DataFrame:
        return df.agg(F.count("*").alias("clientes"), F.min("_referencia").alias("corte"),
                      buyers.alias("compraram"), F.min("recencia_dias").alias("menor_recencia")
                      ).select(F.lit(name).alias("tabela"), "*",
                               F.round(100 * F.col("compraram") / F.nullif("clientes", F.lit(0)), 2)
                               .alias("taxa_base_pct"))
    return (facts(training, "treino", F.sum(LABEL))
            .unionByName(facts(scoring, "cliente", F.lit(None).cast("double"))))
