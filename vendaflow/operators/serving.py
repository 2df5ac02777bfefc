"""Lookups, dashboard datasets and example questions as lazy DataFrames."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vendaflow.functions.dates import date_window, days_before
from vendaflow.operators.gold import ratio
from vendaflow.operators.ranking import LOOKBACK_DAYS, latest_stock

# List lengths of the reports and the dimensions of the dashboard dataset.
SUGGESTED, TOP_BRANDS, TOP_CUSTOMERS, RANKING, LATE = 20, 10, 20, 10, 10
DIMENSIONS = ["canal", "segmento", "cidade", "cliente_id", "razao_social", "marca", "categoria"]


def _margin_pct():
    return ratio(F.sum("margem").cast("double") * 100, F.sum("receita").cast("double"))


def sold(fact: DataFrame) -> DataFrame:
    """Sales without returns, as the example questions ask for."""
    return fact.filter(~F.col("devolucao"))


# ---- lookups; without an id they answer for every entity at once --------------------------------

def prioritize_portfolio(queue: DataFrame, n: int, vendedor_id: str | None = None) -> DataFrame:
    rows = queue if vendedor_id is None else queue.filter(F.col("vendedor_id") == vendedor_id)
    return rows.filter(F.col("ordem") <= n)


def customer_context(customers: DataFrame, features: DataFrame, scores: DataFrame, profile: DataFrame,
                     cliente_id: str | None = None) -> DataFrame:
    """Ticket, revenue, two best brands, last purchase and score; `profile` is that of `customer_serving`. The id filter reaches every input."""
    def only(df: DataFrame) -> DataFrame:
        return df if cliente_id is None else df.filter(F.col("cliente_id") == cliente_id)

    return (only(customers)
            .join(only(features).select("cliente_id", "ticket_medio", "valor_total"), "cliente_id", "left")
            .join(only(scores).select("cliente_id", "score", "faixa"), "cliente_id", "left")
            .join(only(profile).select("cliente_id", "marca_pref", "segunda_marca", "ultima_compra"), "cliente_id", "left")
            .select("cliente_id", "razao_social", "cidade", "uf",
                    F.coalesce(F.round("ticket_medio", 2), F.lit(0.0)).alias("ticket_medio"),
                    F.coalesce(F.round("valor_total", 2), F.lit(0.0)).alias("valor_total"),
                    "marca_pref", "segunda_marca", "ultima_compra",
                    F.col("total_pedidos").alias("pedidos_totais"),
                    F.col("score").alias("saldo_score"), F.col("faixa").alias("saldo_faixa")))


def suggest_products(fact: DataFrame, products: DataFrame, stock: DataFrame, as_of: str | date,
                     cliente_id: str | None = None, strict: bool = False, k: int = SUGGESTED) -> DataFrame:
    """The k SKUs with most revenue before the look-back. `strict` also drops SKUs bought since."""
    rows = fact if cliente_id is None else fact.filter(F.col("cliente_id") == cliente_id)
    cutoff = days_before(as_of, LOOKBACK_DAYS)
    old = (rows.filter(date_window("data_pedido", None, cutoff, "ano", "mes"))
           .groupBy("cliente_id", "sku")
           .agg(F.sum("receita").alias("receita_total"), F.max("data_pedido").alias("ult_compra")))
    if strict:
        since = rows.filter(date_window("data_pedido", cutoff, None, "ano", "mes"))
        old = old.join(since.select("cliente_id", "sku").distinct(), ["cliente_id", "sku"], "left_anti")
    order = Window.partitionBy("cliente_id").orderBy(F.desc("receita_total"), "sku")
    # Prune to k per customer before the product lookups.
    best = (old.join(products.select("sku"), "sku", "left_semi")
            .withColumn("_k", F.row_number().over(order)).filter(F.col("_k") <= k))
    now = latest_stock(stock).select("sku", "saldo", "ruptura")
    return (best.join(products.select("sku", "nome", "marca", "categoria"), "sku").join(now, "sku", "left")
            .select("cliente_id", "sku", F.col("nome").alias("sku_nome"), "marca", "categoria",
                    "receita_total", "ult_compra", F.coalesce("saldo", F.lit(0)).alias("saldo_estoque"),
                    F.coalesce("ruptura", F.lit(False)).alias("em_ruptura")))


def check_availability(products: DataFrame, stock: DataFrame, sku: str | None = None) -> DataFrame:
    rows = latest_stock(stock)
    if sku is not None:
        rows = rows.filter(F.col("sku") == sku)
    return (rows.join(products.select("sku", "nome", "marca"), "sku")
            .select("sku", F.col("nome").alias("sku_nome"), "marca", "saldo", "ruptura", "data_snapshot"))


# ---- dashboard: dataset functions, then widgets on top ------------------------------------------

def dashboard_filter(fact: DataFrame, ano: int | None = None, segmento: str | None = None,
                     cidade: str | None = None) -> DataFrame:
    for column, value in (("ano", ano), ("segmento", segmento), ("cidade", cidade)):
        if value is not None:
            fact = fact.filter(F.col(column) == value)
    return fact


def kpi_monthly(fact: DataFrame) -> DataFrame:
    orders = (fact.groupBy("ano", "mes", "pedido_id")
              .agg(F.sum("receita").alias("receita"), F.sum("margem").alias("margem")))
    monthly = orders.groupBy("ano", "mes").agg(
        F.sum("receita").alias("receita"), F.sum("margem").alias("margem"),
        F.count("pedido_id").alias("pedidos_unicos"))
    r, m = F.col("receita").cast("double"), F.col("margem").cast("double")
    return (monthly.select(F.make_date("ano", "mes", F.lit(1)).alias("data_ref"), "ano", "mes",
                           (F.col("ano") * 100 + F.col("mes")).cast("int").alias("ano_mes_order"),
                           "receita", "margem", "pedidos_unicos",
                           ratio(r, F.col("pedidos_unicos").cast("double")).alias("ticket_por_pedido"),
                           (100 * ratio(m, r)).alias("margem_pct"))
            .orderBy("ano", "mes"))


def sales_by_dimensions(fact: DataFrame) -> DataFrame:
    return fact.groupBy(*DIMENSIONS).agg(
        F.sum("quantidade_abs").alias("quantidade"), F.sum("receita").alias("receita"),
        F.sum("margem").alias("margem"), _margin_pct().alias("margem_pct"))


def kpi_totals(monthly: DataFrame) -> DataFrame:
    return (monthly.agg(F.sum("receita").alias("receita"), F.sum("margem").alias("margem"),
                        F.sum("pedidos_unicos").alias("pedidos_unicos"))
            .withColumn("ticket_medio", ratio(F.col("receita").cast("double"),
                                              F.col("pedidos_unicos").cast("double"))))


def revenue_by_month(monthly: DataFrame) -> DataFrame:
    return monthly.groupBy("data_ref").agg(F.sum("receita").alias("receita")).orderBy("data_ref")


# The widgets below add up sums: give them the fact itself, or the saved dataset of `sales_by_dimensions`.
def top_brands(dataset: DataFrame, k: int = TOP_BRANDS) -> DataFrame:
    return (dataset.groupBy("marca").agg(F.sum("receita").alias("receita"))
            .orderBy(F.desc("receita"), "marca").limit(k))


def margin_by_category(dataset: DataFrame) -> DataFrame:
    return (dataset.groupBy("categoria").agg(_margin_pct().alias("margem_pct"))
            .orderBy("margem_pct", "categoria"))


def sales_by_channel(dataset: DataFrame) -> DataFrame:
    return (dataset.groupBy("canal").agg(F.sum("receita").alias("receita"))
            .orderBy(F.desc("receita"), "canal"))


def top20_customers(dataset: DataFrame, k: int = TOP_CUSTOMERS) -> DataFrame:
    return (dataset.groupBy("razao_social", "segmento", "cidade")
            .agg(F.sum("receita").alias("receita"), _margin_pct().alias("margem_pct"))
            .orderBy(F.desc("receita"), "razao_social", "segmento", "cidade").limit(k))


def queue_listing(queue: DataFrame, vendedor: str | None = None) -> DataFrame:
    rows = queue if vendedor is None else queue.filter(F.col("vendedor") == vendedor)
    return (rows.select("ordem", "razao_social", "cidade", "score", "faixa", "motivo", "sugestao",
                        "vendedor").orderBy("ordem", "vendedor", "razao_social"))


# ---- example questions --------------------------------------------------------------------------

def revenue_since_month_start(fact: DataFrame, as_of: str | date) -> DataFrame:
    """Revenue since the first day of yesterday's month."""
    start = days_before(as_of, 1).replace(day=1)
    return (sold(fact).filter(date_window("data_pedido", start, None, "ano", "mes"))
            .agg(F.sum("receita").alias("receita_total")))


def top_customers(fact: DataFrame, customers: DataFrame, k: int = RANKING) -> DataFrame:
    """Customers by revenue; orders are counted after lines collapse to (customer, order)."""
    orders = sold(fact).groupBy("cliente_id", "pedido_id").agg(F.sum("receita").alias("receita"))
    per_customer = orders.groupBy("cliente_id").agg(F.sum("receita").alias("receita_total"),
                                                    F.count("pedido_id").alias("total_pedidos"))
    return (per_customer.join(customers.select("cliente_id", "razao_social", "cidade", "uf"), "cliente_id")
            .groupBy("razao_social", "cidade", "uf")
            .agg(F.sum("receita_total").alias("receita_total"),
                 F.sum("total_pedidos").alias("total_pedidos"))
            .orderBy(F.desc("receita_total"), "razao_social", "cidade", "uf").limit(k))


def products_by_category(fact: DataFrame, products: DataFrame) -> DataFrame:
    per_sku = sold(fact).groupBy("sku").agg(F.sum("quantidade").alias("q"), F.sum("receita").alias("r"))
    return (per_sku.join(products.select("sku", "categoria", "nome", "marca"), "sku")
            .groupBy("categoria", F.col("nome").alias("produto"), "marca")
            .agg(F.sum("q").alias("quantidade_total"), F.sum("r").alias("receita_total"))
            .orderBy("categoria", F.desc("receita_total"), "produto", "marca"))


def rep_attainment(mart: DataFrame, reps: DataFrame, k: int = TOP_CUSTOMERS) -> DataFrame:
    active = reps.filter("ativo").select("vendedor_id", F.col("nome").alias("vendedor"), "regiao")
    return (mart.join(active, "vendedor_id")
            .orderBy(F.desc("atingimento_pct"), "vendedor_id", "ano", "mes").limit(k)
            .select("vendedor", "regiao", "ano", "mes", "receita", "meta_mensal", "atingimento_pct"))


def sales_by_region_month(fact: DataFrame, reps: DataFrame) -> DataFrame:
    """Lines collapse to (rep, month, customer) before the rep lookup and the distinct count."""
    small = (sold(fact).groupBy("vendedor_id", "ano", "mes", "cliente_id")
             .agg(F.sum("receita").alias("r"), F.sum("quantidade").alias("q")))
    return (small.join(reps.select("vendedor_id", "regiao"), "vendedor_id").groupBy("regiao", "ano", "mes")
            .agg(F.sum("r").alias("receita_total"), F.sum("q").alias("quantidade_total"),
                 F.countDistinct("cliente_id").alias("clientes_unicos"))
            .orderBy(F.desc("ano"), F.desc("mes"), F.desc("receita_total"), "regiao"))


def stockouts(products: DataFrame, stock: DataFrame) -> DataFrame:
    return (latest_stock(stock).filter("ruptura")
            .join(products.select("sku", "nome", "marca", "categoria"), "sku")
            .select("sku", F.col("nome").alias("produto"), "marca", "categoria", "saldo")
            .orderBy("categoria", "marca", "sku"))


def margin_by_brand(fact: DataFrame) -> DataFrame:
    per_sku = sold(fact).groupBy("marca", "sku").agg(F.sum("receita").alias("receita"),
                                                     F.sum("margem").alias("margem"))
    return (per_sku.groupBy("marca")
            .agg(F.count("sku").alias("total_skus"), F.sum("receita").alias("receita_total"),
                 F.round(ratio(F.sum("margem") * 100, F.sum("receita")), 2).alias("margem_pct"))
            .orderBy(F.desc("receita_total"), "marca"))


def active_customers(fact: DataFrame, as_of: str | date, days: int = 30) -> DataFrame:
    return (sold(fact).filter(date_window("data_pedido", days_before(as_of, days), None, "ano", "mes"))
            .agg(F.countDistinct("cliente_id").alias("clientes_ativos_30d")))


def longest_inactive(customers: DataFrame, k: int = TOP_CUSTOMERS) -> DataFrame:
    return (customers.filter("ativo").orderBy(F.desc("dias_sem_comprar"), "cliente_id").limit(k)
            .select("razao_social", "cidade", "uf", "segmento", "dias_sem_comprar", "receita_acumulada",
                    "total_pedidos"))


def most_late_customers(features: DataFrame, customers: DataFrame, k: int = LATE) -> DataFrame:
    return (features.select("cliente_id", "recencia_dias", "intervalo_medio_dias", "atraso_relativo")
            .join(customers.select("cliente_id", "razao_social"), "cliente_id")
            .orderBy(F.desc("atraso_relativo"), "cliente_id").limit(k)
            .select("razao_social", "recencia_dias", F.round("intervalo_medio_dias", 1).alias("intervalo_medio"),
                    F.round("atraso_relativo", 1).alias("atraso")))

