"""Weekly call queue: eligible customers, top k, number per rep, reason and suggestion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vendaflow.operators.ordering import exact_quantiles
from vendaflow.operators.customer_serving import suggestion
from vendaflow.schemas import QUEUE_SCHEMA
from vendaflow.session import materialize

# Queue length, cascade limits, quantile of a big customer.
QUEUE_SIZE, VERY_LATE, LATE, BIG_CUSTOMER_Q = 200, 3, 1.5, 0.75

# Fixed texts shown to the sales rep.
TEXT_VERY_LATE = ("Compra a cada ", " dias e está há ",
                  " sem pedido. Risco de perder para o concorrente.")
TEXT_LATE = ("Está ", "x mais atrasado que o ritmo dele.")
TEXT_LAUNCH = "Comprou lançamento recente. Alta chance de repetir."
TEXT_BIG = ("Cliente grande, R$ ", " no ano. Manter próximo.")
TEXT_STEADY = "Dentro do ritmo. Contato de manutenção."
TEXT_SUGGESTION = (" — ", " (Saldo: ", ")")
TEXT_NO_SUGGESTION = "Sem sugestão disponível no momento"


def current_assignment(portfolio: DataFrame, reps: DataFrame) -> DataFrame:
    """One active rep per customer: the latest open assignment wins, then the largest assignment id."""
    open_rows = portfolio.filter("vigente AND NOT orfao_vendedor_desligado")
    active = reps.filter("ativo").select("vendedor_id", F.col("nome").alias("vendedor"))
    latest = F.max_by(F.struct("vendedor_id", "vendedor"), F.struct("data_inicio", "carteira_id"))
    return (open_rows.join(active, "vendedor_id").groupBy("cliente_id").agg(latest.alias("a"))
            .select("cliente_id", "a.vendedor_id", "a.vendedor"))


def eligible(scores: DataFrame, portfolio: DataFrame, reps: DataFrame, customers: DataFrame,
             features: DataFrame) -> DataFrame:
    """Scored customers with an active rep, one row each."""
    return (scores.select("cliente_id", "score", "faixa")
            .join(current_assignment(portfolio, reps), "cliente_id")
            .join(customers.select("cliente_id", "razao_social", "cidade", "uf"), "cliente_id")
            .join(features.select("cliente_id", "ticket_medio", "atraso_relativo", "recencia_dias",
                                  "intervalo_medio_dias", "valor_total", "comprou_lancamento"),
                  "cliente_id"))


def top_customers(candidates: DataFrame, k: int = QUEUE_SIZE) -> DataFrame:
    return candidates.orderBy(F.desc("score"), "cliente_id").limit(k)


def reason(threshold: Column) -> Column:
    """First matching branch wins, rarest first.

    Lateness is only quoted for customers with a known interval: after a single order it is the
    ceiling value by definition, and a text built from the missing interval would be NULL.
    """
    rhythm = F.col("intervalo_medio_dias").isNotNull()
    a, b, c = TEXT_VERY_LATE
    very_late = F.concat(F.lit(a), F.format_number("intervalo_medio_dias", 0), F.lit(b),
                         F.format_number("recencia_dias", 0), F.lit(c))
    late = F.concat(F.lit(TEXT_LATE[0]), F.format_number("atraso_relativo", 1), F.lit(TEXT_LATE[1]))
    big = F.concat(F.lit(TEXT_BIG[0]), F.format_number("valor_total", 2), F.lit(TEXT_BIG[1]))
    return (F.when(rhythm & (F.col("atraso_relativo") > VERY_LATE), very_late)
            .when(rhythm & (F.col("atraso_relativo") > LATE), late)
            .when(F.col("comprou_lancamento") == 1, F.lit(TEXT_LAUNCH))
            .when(F.col("valor_total") >= threshold, big)
            .otherwise(F.lit(TEXT_STEADY)))


def revenue_threshold(features: DataFrame, q: float = BIG_CUSTOMER_Q) -> Column:
    """Exact discrete quantile of customer revenue as a scalar subquery."""
    return exact_quantiles(features, "valor_total", {"limite": q}, interpolate=False).scalar()


def with_reason(df: DataFrame, features: DataFrame) -> DataFrame:
    return df.withColumn("motivo", reason(revenue_threshold(features)))


def eligible_ids(scores: DataFrame, portfolio: DataFrame, reps: DataFrame, customers: DataFrame, features: DataFrame) -> DataFrame:
    """Ids of `eligible`: keys only, so any table with one row per customer may stand for the dimension."""
    return (scores.select("cliente_id").join(current_assignment(portfolio, reps), "cliente_id", "left_semi")
            .join(customers.select("cliente_id"), "cliente_id", "left_semi").join(features.select("cliente_id"), "cliente_id", "left_semi"))


def weekly_queue(scores: DataFrame, portfolio: DataFrame, reps: DataFrame, customers: DataFrame, features: DataFrame,
                 profile: DataFrame, k: int = QUEUE_SIZE) -> DataFrame:
    """Filter, limit, then number per rep; one row per customer, with the product that `profile` (of `customer_serving`) offers.

    The k customers feed several branches, so they are written once."""
    top = materialize(top_customers(eligible(scores, portfolio, reps, customers, features), k), "top")
    text = F.concat("sku", F.lit(TEXT_SUGGESTION[0]), "nome", F.lit(TEXT_SUGGESTION[1]), F.col("saldo").cast("string"), F.lit(TEXT_SUGGESTION[2]))
    picks = suggestion(profile).select("cliente_id", text.alias("_sug"))
    per_rep = Window.partitionBy("vendedor_id").orderBy(F.desc("score"), "cliente_id")
    numbered = with_reason(top, features).withColumn("ordem", F.row_number().over(per_rep))
    return (numbered.join(picks, "cliente_id", "left")
            .withColumns({"score": F.round("score", 4), "ticket_medio": F.round("ticket_medio", 2),
                          "sugestao": F.coalesce("_sug", F.lit(TEXT_NO_SUGGESTION))})
            .select([F.col(f.name).cast(f.dataType).alias(f.name, metadata=f.metadata)
                     for f in QUEUE_SCHEMA.fields]))
