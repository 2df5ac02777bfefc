"""Star schema and monthly marts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vendaflow.functions.dates import as_date
from vendaflow.operators.ordering import join_whole, running_totals
from vendaflow.session import materialize

# Peak months of the trade, ABC limits.
PEAK_MONTHS = (4, 6, 10)
ABC_A, ABC_B = 0.80, 0.95


def ratio(num: Column, den: Column) -> Column:
    """Division that yields NULL on a zero denominator; decimals stay decimal."""
    return num / F.nullif(den, F.lit(0))


def dim_cliente(customers: DataFrame, orders: DataFrame, lines: DataFrame, as_of: str | date) -> DataFrame:
    """Customer attributes with order metrics; customers without orders are kept.

    Lines are summed per order first, so the order join is one to one and a customer with very many
    lines is already small when the orders are grouped by customer.
    """
    per_order = lines.groupBy(F.col("pedido_id").alias("_pedido")).agg(F.sum("valor_bruto").alias("bruto"))
    live = orders.filter(~F.col("cancelado")).select("pedido_id", F.col("cliente_id").alias("_cliente"),
                                                     "data_pedido")
    bought = (live.join(per_order, live.pedido_id == per_order["_pedido"])
              .groupBy("_cliente")
              .agg(F.countDistinct("pedido_id").alias("total_pedidos"),
                   F.sum("bruto").alias("receita_acumulada"),
                   F.min("data_pedido").alias("primeiro_pedido"),
                   F.max("data_pedido").alias("ultimo_pedido")))
    return (customers.join(bought, customers.cliente_id == bought["_cliente"], "left")
            .select("cliente_id", "cnpj", "razao_social", "segmento", "cidade", "uf", "bairro",
                    "data_cadastro", "ativo",
                    F.coalesce("total_pedidos", F.lit(0)).alias("total_pedidos"),
                    F.coalesce(F.round("receita_acumulada", 2), F.lit(0)).alias("receita_acumulada"),
                    "primeiro_pedido", "ultimo_pedido",
                    F.datediff(F.lit(as_date(as_of)), "ultimo_pedido").alias("dias_sem_comprar")))


def dim_produto(products: DataFrame) -> DataFrame:
    return products.select("sku", "nome", "categoria", "marca", "nota_olfativa", "preco_tabela",
                           "custo_unitario", "unidade", "ativo", "data_lancamento",
                           (~F.col("ativo")).alias("descontinuado"))


def dim_vendedor(reps: DataFrame) -> DataFrame:
    return reps.select("vendedor_id", "nome", "regiao", "uf", "meta_mensal", "ativo")


def _calendar_columns(days: DataFrame) -> DataFrame:
    return days.select(
        "data", F.year("data").alias("ano"), F.month("data").alias("mes"),
        F.date_format("data", "MMMM").alias("nome_mes"), F.quarter("data").alias("trimestre"),
        F.dayofweek("data").alias("dia_semana"),
        F.month("data").isin(*PEAK_MONTHS).alias("mes_pico_setor"))


def dim_calendario(spark: SparkSession, start: str | date = "2024-09-01",
                   end: str | date = "2026-08-31") -> DataFrame:
    """One row per day of the closed range."""
    bounds = spark.range(1).select(F.lit(as_date(start)).alias("a"), F.lit(as_date(end)).alias("b"))
    return _calendar_columns(bounds.select(F.explode(F.sequence("a", "b")).alias("data")))


def calendar_spanning(df: DataFrame, column: str) -> DataFrame:
    """Calendar over the whole months that `column` touches."""
    bounds = df.agg(F.trunc(F.min(column), "month").alias("a"), F.last_day(F.max(column)).alias("b"))
    return _calendar_columns(bounds.select(F.explode(F.sequence("a", "b")).alias("data")))


def line_cost() -> Column:
    return F.col("quantidade_abs") * F.col("custo_unitario")


def fato_vendas(orders: DataFrame, lines: DataFrame, products: DataFrame, customers: DataFrame | None) -> DataFrame:
    """Order-line fact: cancelled orders out, returns in with their negative sign. Without `customers` their attributes are left out.

    Products are joined first: lines that come ordered by SKU stay in place, and then move once, by order. Customer attributes are
    joined to orders, which are far fewer than lines. No join is hinted: products and customers are broadcast only when their
    measured size allows it; otherwise adaptive execution splits the partitions of a hot order,
    SKU or customer.
    """
    o = (orders.filter(~F.col("cancelado"))
         .select("pedido_id", "cliente_id", "data_pedido", "ano", "mes", "canal", "vendedor_id"))
    i = (lines.filter("quantidade IS NOT NULL AND preco_praticado IS NOT NULL")
         .select("pedido_id", "item_id", "sku", "quantidade", "quantidade_abs", "preco_praticado",
                 "devolucao", "sku_descontinuado"))
    p = (products.filter("custo_unitario IS NOT NULL")
         .select("sku", "categoria", "marca", "nota_olfativa", "custo_unitario"))
    named = [] if customers is None else ["razao_social", "segmento", "cidade"]
    if customers is not None:
        o = o.join(customers.select("cliente_id", *named), "cliente_id", "left")
    receita = F.col("quantidade") * F.col("preco_praticado")
    custo = line_cost()
    return (i.join(p, "sku").join(o, "pedido_id")
            .select("pedido_id", "item_id", "cliente_id", *named, "data_pedido", "ano", "mes", "canal", "sku", "categoria", "marca",
                    "nota_olfativa", "vendedor_id", "quantidade", "quantidade_abs",
                    "preco_praticado", receita.alias("receita"), custo.alias("custo"),
                    (receita - custo).alias("margem"), "devolucao", "sku_descontinuado"))


def mart_vendas_por_vendedor(fact: DataFrame, reps: DataFrame) -> DataFrame:
    """Rep and month: revenue, target attainment, ticket per customer.

    Lines collapse to orders, orders to customers; an order has one rep, month and customer, so counting rows of either step
    replaces a distinct count, which would multiply the rows.
    """
    per_order = (fact.groupBy("vendedor_id", "ano", "mes", "pedido_id", "cliente_id")
                 .agg(F.sum("receita").alias("receita"), F.sum("margem").alias("margem")))
    per_customer = (per_order.groupBy("vendedor_id", "ano", "mes", "cliente_id")
                    .agg(F.count("pedido_id").alias("pedidos"), F.sum("receita").alias("receita"), F.sum("margem").alias("margem")))
    monthly = (per_customer.groupBy("vendedor_id", "ano", "mes")
               .agg(F.sum("pedidos").alias("pedidos_unicos"), F.count("cliente_id").alias("clientes_atendidos"),
                    F.sum("receita").alias("receita"), F.sum("margem").alias("margem")))
    r, meta = F.col("receita"), F.col("meta_mensal")
    return (monthly.join(reps.select("vendedor_id", "meta_mensal"), "vendedor_id")
            .select("vendedor_id", "ano", "mes", "pedidos_unicos", "clientes_atendidos",
                    F.round("receita", 2).alias("receita"), F.round("margem", 2).alias("margem"),
                    F.round(F.col("receita") - F.col("margem"), 2).alias("custo"), "meta_mensal",
                    F.when(meta > 0, F.round(r / meta * 100, 2)).alias("atingimento_pct"),
                    F.round(ratio(r, F.col("clientes_atendidos")), 2).alias("ticket_por_cliente")))


def sku_month(fact: DataFrame) -> DataFrame:
    return (fact.groupBy("sku", "categoria", "marca", "ano", "mes")
            .agg(F.sum("quantidade_abs").alias("quantidade"),
                 F.round(F.sum("receita"), 2).alias("receita"),
                 F.round(F.sum("margem"), 2).alias("margem"))
            .withColumn("margem_pct", F.round(ratio(F.col("margem"), F.col("receita")) * 100, 2)))


def mart_produto_performance(fact: DataFrame) -> DataFrame:
    """SKU and month with its ABC class by accumulated revenue; tied SKUs share the running total.

    The SKU-month rollup feeds both the curve and the result, so it is written once; otherwise the
    fact would be scanned for each.
    """
    base = materialize(sku_month(fact), "sku_mes")
    curve = running_totals(base, ["ano", "mes"], "receita", {"_r": F.col("receita")}, descending=True)
    share = ratio(F.col("_r_ate").cast("double"), F.col("_r_total").cast("double"))
    classed = curve.select(
        "ano", "mes", "receita", F.when(share <= ABC_A, "A").when(share <= ABC_B, "B")
        .otherwise("C").alias("curva_abc"))
    return (join_whole(base, classed, ["ano", "mes", "receita"])
            .select("sku", "categoria", "marca", "ano", "mes", "quantidade", "receita", "margem",
                    "margem_pct", "curva_abc"))


def mart_financeiro_recebimento(payments: DataFrame, as_of: str | date,
                                delay: str = "since_due") -> DataFrame:
    """Due month: receivable, received, mean delay and fee cost.

    `delay="since_due"` counts from the due date to `as_of` even when paid; `"until_paid"` stops at
    the payment date.
    """
    end = F.lit(as_date(as_of))
    if delay == "until_paid":
        end = F.coalesce("data_pagamento", end)
    fee = F.col("valor") * F.col("taxa_pct") / 100
    late = F.datediff(end, "data_vencimento")
    month = [F.year("data_vencimento").alias("ano"), F.month("data_vencimento").alias("mes")]
    sums = ["valor", "valor_liquido", "fee", "late", "n"]
    measures = [F.sum("valor").alias("valor"), F.sum("valor_liquido").alias("valor_liquido"), F.sum(fee).alias("fee"),
                F.sum(late).alias("late"), F.count(late).alias("n")]
    # a payment belongs to one order: counting rows of each step replaces the distinct counts
    per_payment = payments.groupBy(*month, "pedido_id", "pagamento_id").agg(*measures)
    per_order = per_payment.groupBy("ano", "mes", "pedido_id").agg(
        F.count("pagamento_id").alias("pagamentos"), *[F.sum(c).alias(c) for c in sums])
    return (per_order.groupBy("ano", "mes")
            .agg(F.count("pedido_id").alias("pedidos"), F.sum("pagamentos").alias("pagamentos"),
                 F.round(F.sum("valor"), 2).alias("valor_a_receber"),
                 F.round(F.sum("valor_liquido"), 2).alias("recebido"),
                 F.round(F.sum("late") / F.sum("n"), 1).alias("atraso_medio_dias"),
                 F.round(F.sum("fee"), 2).alias("custo_taxa")))
