"""One row per customer with what queue, context and suggestion look up: brands, last purchase and the next product to offer.

The fact is rolled up once to (customer, brand) with totals over all history and over the look-back; SKUs are looked at only for the
look-back. Written bucketed and sorted by customer, the row of one customer is found by reading one bucket."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vendaflow.functions.dates import days_before
from vendaflow.operators.ranking import LOOKBACK_DAYS, recent_skus
from vendaflow.session import materialize


def customer_brands(fact: DataFrame, as_of: str | date, brand_days: int | None = LOOKBACK_DAYS) -> DataFrame:
    """(customer, brand): revenue, revenue of the `brand_days` that choose the brand (None: all history), last purchase, and
    whether that period holds one."""
    since = F.lit(True) if brand_days is None else F.col("data_pedido") >= F.lit(days_before(as_of, brand_days))
    return fact.groupBy("cliente_id", "marca").agg(
        F.sum("receita").alias("receita"), F.sum(F.when(since, F.col("receita"))).alias("recente_total"), F.max("data_pedido").alias("ultima"),
        F.max(since).alias("escolhe"))


def customer_profile(fact: DataFrame, places: DataFrame, as_of: str | date, brand_days: int | None = LOOKBACK_DAYS) -> DataFrame:
    """Every customer of the fact: two best brands and last purchase over all history, best brand of the last `brand_days`, and of that brand the
    fullest SKU in stock (`places`, as numbered by `ranking.shelf`) not bought since, with the number of such SKUs.

    A customer's SKUs of one brand are numbered by their shelf place: while number and place agree the shelf has no gap, so the first
    gap is the first place where they part. That window holds at most one brand's SKUs."""
    brands = customer_brands(fact, as_of, brand_days)
    order = Window.partitionBy("cliente_id").orderBy(F.desc("receita"), "marca")
    favourite = F.min(F.when(F.col("escolhe"), F.struct((-F.col("recente_total")).alias("menos"), "marca")))
    best = materialize(brands.withColumn("_posicao", F.row_number().over(order)).groupBy("cliente_id").agg(
        *[F.max(F.when(F.col("_posicao") == n, F.col("marca"))).alias(name) for n, name in ((1, "marca_pref"), (2, "segunda_marca"))],
        F.max("ultima").alias("ultima_compra"), favourite["marca"].alias("marca_recente")), "marcas")
    shelf = places.select("sku", F.col("marca").alias("_marca"), "estante")
    owned = (recent_skus(fact, as_of).join(shelf, "sku")
             .join(best.select("cliente_id", "marca_recente"), "cliente_id").where("_marca = marca_recente"))
    place = F.row_number().over(Window.partitionBy("cliente_id").orderBy("estante"))
    taken = owned.withColumn("_lugar", place).groupBy("cliente_id").agg(
        F.count(F.lit(1)).alias("_excluidos"), F.count_if(F.col("_lugar") == F.col("estante")).alias("_corrida"))
    offer = places.select(F.col("marca").alias("_marca"), F.col("estante").alias("_estante"), "estante_n", F.col("sku").alias("sku_sugerido"),
                          F.col("nome").alias("nome_sugerido"), F.col("saldo").alias("saldo_sugerido"))
    wanted = best.join(taken, "cliente_id", "left").withColumn("_proximo", F.coalesce("_corrida", F.lit(0)) + 1)
    meet = (F.col("marca_recente") == F.col("_marca")) & (F.col("_proximo") == F.col("_estante"))
    return wanted.join(offer, meet, "left").select(
        "cliente_id", "marca_pref", "segunda_marca", "ultima_compra", "marca_recente", "sku_sugerido", "nome_sugerido", "saldo_sugerido",
        (F.col("estante_n") - F.coalesce("_excluidos", F.lit(0))).alias("candidatos"))


def suggestion(profile: DataFrame) -> DataFrame:
    """The product to offer to each customer who has one."""
    return profile.where("sku_sugerido IS NOT NULL").select(
        "cliente_id", F.col("marca_recente").alias("marca"), F.col("sku_sugerido").alias("sku"), F.col("nome_sugerido").alias("nome"),
        F.col("saldo_sugerido").alias("saldo"), "candidatos")
