"""Per-group picks: preferred brands, latest snapshot, first unbought product of a brand."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vendaflow.functions.dates import date_window, days_before
from vendaflow.operators.ordering import row_numbers, running_totals

# Fixed value: days that count as a recent purchase.
LOOKBACK_DAYS = 90


def brand_revenue(fact: DataFrame) -> DataFrame:
    return fact.groupBy("cliente_id", "marca").agg(F.sum("receita").alias("receita_marca"))


def top_brand(fact: DataFrame) -> DataFrame:
    """Best brand by revenue per customer, then by name; a `min` of structs, combined before the shuffle."""
    best = F.min(F.struct((-F.col("receita_marca")).alias("_menos"), F.col("marca"))).alias("b")
    return (brand_revenue(fact).groupBy("cliente_id").agg(best)
            .select("cliente_id", "b.marca", (-F.col("b._menos")).alias("receita_marca")))


def ranked_brands(fact: DataFrame, k: int) -> DataFrame:
    """The k best brands per customer with their position. `posicao <= k` prunes before the shuffle."""
    order = Window.partitionBy("cliente_id").orderBy(F.desc("receita_marca"), "marca")
    return (brand_revenue(fact).withColumn("posicao", F.row_number().over(order))
            .filter(F.col("posicao") <= k))


def nth_brand(fact: DataFrame, n: int) -> DataFrame:
    return ranked_brands(fact, n).filter(F.col("posicao") == n).select("cliente_id", "marca", "receita_marca")


def latest_stock(stock: DataFrame) -> DataFrame:
    """Rows of the most recent snapshot of the whole table."""
    newest = stock.agg(F.max("data_snapshot").alias("d")).scalar()
    return stock.filter(F.col("data_snapshot") == newest)


def last_purchase(fact: DataFrame) -> DataFrame:
    return fact.groupBy("cliente_id").agg(F.max("data_pedido").alias("ultima_compra"))


def recent_skus(fact: DataFrame, as_of: str | date, days: int = LOOKBACK_DAYS) -> DataFrame:
    """Distinct (customer, SKU) bought on or after `as_of - days`."""
    return (fact.filter(date_window("data_pedido", days_before(as_of, days), None, "ano", "mes"))
            .select("cliente_id", "sku").distinct())


def shelf(products: DataFrame, stock: DataFrame) -> DataFrame:
    """SKUs in stock, numbered within their brand by balance; `estante_n` is the brand's SKU count."""
    available = (latest_stock(stock).filter("saldo > 0").select("sku", "saldo")
                 .join(products.select("sku", "nome", "marca"), "sku"))
    return row_numbers(available, ["marca"], "saldo", "sku", "estante")


def suggestions(preferred: DataFrame, places: DataFrame, bought: DataFrame) -> DataFrame:
    """Per customer the fullest in-stock SKU of the preferred brand that is not in `bought`.

    `places` is `shelf(...)`, best as a written table since it is read twice. Pairing every customer
    with every SKU of the brand would grow with their product. Instead the customer's own recent
    SKUs are looked up on the shelf, and the answer is the first place missing among them: places
    1..m all taken means place m + 1.
    """
    on_shelf = places.select("sku", "marca", "estante")
    mine = (bought.join(preferred.select("cliente_id", "marca"), "cliente_id")
            .join(on_shelf, ["sku", "marca"]).select("cliente_id", "sku", "estante"))
    # Place p closes a gapless run when exactly p of the customer's SKUs sit at or before it.
    counted = running_totals(mine, ["cliente_id"], "estante", {"_q": F.lit(1)})
    taken = counted.groupBy("cliente_id").agg(
        F.max("_q_total").alias("excluidos"), F.count_if(F.col("estante") == F.col("_q_ate")).alias("_corrida"))
    wanted = (preferred.join(taken, "cliente_id", "left")
              .select("cliente_id", "marca", F.coalesce("excluidos", F.lit(0)).alias("excluidos"),
                      (F.coalesce("_corrida", F.lit(0)) + 1).alias("estante")))
    return (wanted.join(places, ["marca", "estante"])
            .select("cliente_id", "marca", "sku", "nome", "saldo",
                    (F.col("estante_n") - F.col("excluidos")).alias("candidatos")))


def preferred_brand(fact: DataFrame, customers: DataFrame, as_of: str | date,
                    lookback_days: int | None = LOOKBACK_DAYS) -> DataFrame:
    """Top brand of the given customers, over the look-back or (None) all history."""
    rows = fact
    if lookback_days is not None:
        rows = fact.filter(date_window("data_pedido", days_before(as_of, lookback_days), None,
                                       "ano", "mes"))
    return top_brand(rows.join(customers.select("cliente_id"), "cliente_id", "left_semi"))


def big_customer_threshold(features: DataFrame, q: float = 0.75, accuracy: int = 10_000) -> DataFrame:
    return features.agg(F.percentile_approx("valor_total", q, accuracy).alias("limite"))

