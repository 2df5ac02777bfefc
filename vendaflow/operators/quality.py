"""Quality gates as rows: (teste, observado, esperado, passou)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vendaflow.functions.text import CNPJ_DIGITS
from vendaflow.schemas import CHECKS

# Tolerance of money totals, expected fact volume, queue length.
TOLERANCE, FACT_ROWS, QUEUE_ROWS = 0.01, (140_000, 250_000), 200


class QualityError(Exception):
    """A gate failed; the message lists the failed tests."""


def _test(name: str, observed: Column, expected: Column | str, passed: Column) -> Column:
    expected = expected if isinstance(expected, Column) else F.lit(expected)
    return F.struct(F.lit(name).alias("teste"), observed.cast("string").alias("observado"),
                    expected.cast("string").alias("esperado"),
                    F.coalesce(passed, F.lit(False)).alias("passou"))


def _rows(df: DataFrame, *tests: Column) -> DataFrame:
    """Several test rows from one one-row aggregate, so that its table is scanned once."""
    return df.select(F.inline(F.array(*tests)))


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def orphan_orders(fact: DataFrame, orders: DataFrame) -> DataFrame:
    """Fact order ids that no order carries."""
    return (fact.select("pedido_id").distinct()
            .join(orders.select("pedido_id"), "pedido_id", "left_anti"))


def quality_suite(fact: DataFrame, customers: DataFrame, orders: DataFrame, dim_customers: DataFrame,
                  mart: DataFrame, volume: tuple[int, int] = FACT_ROWS) -> DataFrame:
    """Nine tests; each table is aggregated once, and totals of other tables enter as scalars."""
    order_facts = orders.agg(
        F.struct(F.round(F.sum("valor_liquido"), 2).alias("valor"),
                 F.count_if(F.col("data_pedido").isNull()).alias("nulas")).alias("o")).scalar()
    mart_total = mart.agg(F.round(F.sum("receita"), 2).alias("v")).scalar()
    facts = fact.agg(
        F.round(F.sum("receita"), 2).alias("receita"), F.count("*").alias("linhas"),
        F.count_if((F.col("receita") < 0) & ~F.col("devolucao")).alias("negativas"),
        F.count_if((F.col("receita") >= 0) & F.col("devolucao")).alias("positivas")
    ).withColumns({"o": order_facts, "mart": mart_total})
    cust = customers.agg(F.count("*").alias("n"), F.countDistinct("cnpj").alias("d"))
    dim = dim_customers.agg(F.count("*").alias("n"), F.countDistinct("cnpj").alias("d"),
                            F.count_if(F.length("cnpj") != 14).alias("tamanho"))
    orphans = orphan_orders(fact, orders).limit(1).agg(F.count("*").alias("n"))

    total, wrong, repeated = F.col("receita"), F.col("negativas") + F.col("positivas"), F.col("n") - F.col("d")
    low, high = volume
    return _union([
        _rows(facts,
              _test("1 receita gold = silver", total, F.col("o.valor"),
                    F.abs(total - F.col("o.valor")) <= TOLERANCE),
              _test("3 data_pedido sem nulos", F.col("o.nulas"), "0", F.col("o.nulas") == 0),
              _test("4 devolucao coerente", wrong, "0", wrong == 0),
              _test("5 volume da fato", F.col("linhas"), f"{low} a {high}", F.col("linhas").between(low, high)),
              _test("8 mart = fato", F.col("mart"), total, F.abs(F.col("mart") - total) <= TOLERANCE)),
        _rows(cust, _test("2 cnpj unico", repeated, "0", repeated == 0)),
        _rows(orphans, _test("6 pedido_id valido", F.col("n"), "0", F.col("n") == 0)),
        _rows(dim,
              _test("7 dim_cliente cnpj unico", repeated, "0", (F.col("n") > 0) & (repeated == 0)),
              _test("9 cnpj 14 digitos", F.col("tamanho"), "0", F.col("tamanho") == 0)),
    ])


def queue_tests(queue: DataFrame, rows: int = QUEUE_ROWS) -> DataFrame:
    q = queue.agg(F.count("*").alias("n"),
                  F.count_if(F.col("motivo").isNull() | (F.col("motivo") == "")).alias("vazios"),
                  F.count_if((F.col("score") < 0) | (F.col("score") > 1)).alias("fora"))
    return _rows(q, _test("1 linhas na fila", F.col("n"), str(rows), F.col("n") == rows),
                 _test("2 motivo preenchido", F.col("vazios"), "0", F.col("vazios") == 0),
                 _test("3 score em [0, 1]", F.col("fora"), "0", F.col("fora") == 0))


def constraint_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows that break each declared CHECK; one pass per table."""
    def checked(name: str) -> DataFrame:
        rules = CHECKS[name]
        counts = tables[name].agg(*[F.count_if(~F.expr(p)).alias(r) for r, p in rules.items()])
        return counts.unpivot([], list(rules), "regra", "violacoes").withColumn("tabela", F.lit(name))
    return _union([checked(n) for n in CHECKS if n in tables]).select("tabela", "regra", "violacoes")


def dirt_profile(raw_customers: DataFrame) -> DataFrame:
    """How dirty the raw customer text is."""
    cnpj, name = F.col("cnpj"), F.col("razao_social")
    digits = F.regexp_replace(F.trim(cnpj), "[^0-9]", "")
    return raw_customers.agg(
        F.count("*").alias("clientes"), F.count_if(cnpj.like("%.%")).alias("cnpj_pontuado"),
        F.count_if(cnpj != F.trim(cnpj)).alias("cnpj_com_espaco"),
        F.count_if(digits.like("0%")).alias("cnpj_zero_a_esquerda"),
        F.count_if(F.length(digits) > CNPJ_DIGITS).alias("cnpj_longo"),
        F.count_if((digits == "") | digits.isNull()).alias("cnpj_sem_digito"),
        F.count_if(F.col("data_cadastro").like("%/%")).alias("data_formato_br"),
        F.count_if(name == F.upper(name)).alias("razao_caixa_alta"))


def reconcile(tables: dict[str, DataFrame], control: DataFrame) -> DataFrame:
    """Rows per table against the arrival control, joined on the file name."""
    counts = table_counts(tables)
    joined = counts.join(control.select("arquivo", F.col("linhas").alias("no_arquivo")),
                         F.concat("tabela", F.lit(".csv")) == F.col("arquivo"), "left")
    return joined.select("tabela", F.col("linhas").alias("na_tabela"), "no_arquivo",
                         F.coalesce(F.col("linhas") == F.col("no_arquivo"), F.lit(False)).alias("bate"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return _union([df.agg(F.lit(n).alias("tabela"), F.count("*").alias("linhas"))
                   for n, df in tables.items()])


def enforce(results: DataFrame, what: str) -> None:
    """Raise when any test row failed. The result has one row per test, so reading it is bounded."""
    failed = results.filter(~F.col("passou")).collect()
    if failed:
        raise QualityError(f"{what}: " + "; ".join(
            f"{r['teste']} (observado {r['observado']}, esperado {r['esperado']})" for r in failed))


def asserting(results: DataFrame) -> DataFrame:
    """The same rows, but evaluating a failed one raises inside the query."""
    message = F.concat(F.lit("FALHOU: "), "teste", F.lit(" observado "), F.coalesce("observado", F.lit("NULL")))
    return results.withColumn("passou", F.when(F.col("passou"), F.lit(True))
                              .otherwise(F.raise_error(message).cast("boolean")))
