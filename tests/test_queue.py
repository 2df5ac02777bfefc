"""Queue: reason cascade, eligibility, one row per customer, suggestions against brute force."""

import random
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from registry.domain import AS_OF
from vendaflow.operators import customer_serving, ranking, weekly_queue
from vendaflow.schemas import QUEUE_SCHEMA
from vendaflow.operators import quality, serving
from vendaflow.session import materialize


def test_reason_cascade(spark):
    rows = [("a", 3.1, 12.4, 40.0, 10.0, 1.0), ("b", 3.0, 9.0, 27.0, 10.0, 1.0), ("c", 1.6, 9.0, 9.0, 10.0, 0.0),
            ("d", 1.5, 9.0, 9.0, 10.0, 1.0), ("e", 1.0, 9.0, 9.0, 1234567.5, 0.0), ("f", 1.0, 9.0, 9.0, 99.99, 0.0),
            ("g", None, None, 0.0, 1.0, 0.0), ("h", 10.0, None, 50.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "id string, atraso_relativo double, intervalo_medio_dias double, "
                                     "recencia_dias double, valor_total double, comprou_lancamento double")
    got = {r.id: r.m for r in df.select("id", weekly_queue.reason(F.lit(100.0)).alias("m")).collect()}
    assert got["a"] == "Compra a cada 12 dias e está há 40 sem pedido. Risco de perder para o concorrente."
    assert got["b"] == "Está 3.0x mais atrasado que o ritmo dele." and got["c"].startswith("Está 1.6x")
    assert got["d"] == "Comprou lançamento recente. Alta chance de repetir."
    assert got["e"] == "Cliente grande, R$ 1,234,567.50 no ano. Manter próximo."
    assert got["h"] == got["d"]
    assert got["f"] == got["g"] == "Dentro do ritmo. Contato de manutenção."


def test_assignment_rules(spark):
    portfolio = spark.createDataFrame(
        [("1", "x", "r1", date(2020, 1, 1), True, False), ("2", "x", "r2", date(2021, 1, 1), True, False),
         ("3", "y", "left", date(2021, 1, 1), True, False), ("4", "z", "r1", date(2021, 1, 1), False, True)],
        "carteira_id string, cliente_id string, vendedor_id string, data_inicio date, vigente boolean, "
        "orfao_vendedor_desligado boolean")
    reps = spark.createDataFrame([("r1", "Ana", True), ("r2", "Ana", True), ("left", "Bia", False)],
                                 "vendedor_id string, nome string, ativo boolean")
    got = weekly_queue.current_assignment(portfolio, reps).collect()
    assert [(r.cliente_id, r.vendedor_id) for r in got] == [("x", "r2")]


def _brute(preferred, products, stock, bought):
    import hashlib
    out = {}
    for c, brand in preferred.items():
        options = [(-stock[s], hashlib.md5(s.encode()).hexdigest(), s) for s, b in products.items()
                   if b == brand and stock.get(s, 0) > 0 and (c, s) not in bought]
        if options:
            out[c] = (min(options)[2], len(options))
    return out


def test_suggestions_equal_pairwise_search(spark):
    rnd = random.Random(3)
    products = {f"s{i}": rnd.choice("ABC") for i in range(60)}
    stock = {s: rnd.randint(0, 4) for s in products if rnd.random() < 0.9}
    preferred = {f"c{i}": rnd.choice("ABCD") for i in range(80)}
    bought = {(c, s) for c in preferred for s in products if rnd.random() < rnd.choice([0.05, 0.9, 1.0])}
    pdf = spark.createDataFrame([(s, "nome " + s, b) for s, b in products.items()], "sku string, nome string, marca string")
    sdf = spark.createDataFrame([(date(2026, 1, 5), s, v) for s, v in stock.items()]
                                + [(date(2026, 1, 1), s, 99) for s in products], "data_snapshot date, sku string, saldo int")
    prefs = spark.createDataFrame(list(preferred.items()), "cliente_id string, marca string")
    bdf = spark.createDataFrame(sorted(bought), "cliente_id string, sku string")
    got = {r.cliente_id: (r.sku, r.candidatos)
           for r in ranking.suggestions(prefs, ranking.shelf(pdf, sdf), bdf).collect()}
    assert got == _brute(preferred, products, stock, bought)


def test_top_brand_and_second(spark):
    rows = [("c", "A", Decimal(5)), ("c", "B", Decimal(9)), ("c", "A", Decimal(4)), ("c", "C", Decimal(1)), ("d", "Z", Decimal(-1))]
    f = spark.createDataFrame(rows, "cliente_id string, marca string, receita decimal(18,2)")
    assert {(r.cliente_id, r.marca) for r in ranking.top_brand(f).collect()} == {("c", "A"), ("d", "Z")}
    assert [(r.cliente_id, r.marca) for r in ranking.nth_brand(f, 2).collect()] == [("c", "B")]


def test_brand_rank_prunes_before_the_shuffle(spark):
    f = spark.createDataFrame([("c", "A", Decimal(5))], "cliente_id string, marca string, receita decimal(18,2)")
    plan = ranking.nth_brand(f, 2)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_weekly_queue(domain):
    q = domain.fila.cache()
    rows = q.collect()
    assert [f.name for f in q.schema.fields] == [f.name for f in QUEUE_SCHEMA.fields]
    assert q.schema["motivo"].metadata["comment"]
    assert len({r.cliente_id for r in rows}) == len(rows) > 0
    for rep in {r.vendedor_id for r in rows}:
        mine = sorted((r for r in rows if r.vendedor_id == rep), key=lambda r: r.ordem)
        assert [r.ordem for r in mine] == list(range(1, len(mine) + 1))
        assert [r.score for r in mine] == sorted((r.score for r in mine), reverse=True)
    active = {r.vendedor_id for r in domain.vendedores.filter("ativo").collect()}
    assert {r.vendedor_id for r in rows} <= active
    results = {r.teste[0]: r.passou for r in quality.queue_tests(q, len(rows)).collect()}
    assert results == {"1": True, "2": True, "3": True}
    rep = rows[0].vendedor_id
    assert serving.prioritize_portfolio(q, 1, rep).count() == 1


@pytest.mark.parametrize("days", [90, 400, None])
def test_profile_equals_the_separate_picks(spark, domain, days):
    fact, shelf = domain.saved_fact, domain.saved_shelf
    got = customer_serving.customer_profile(fact, shelf, AS_OF, days).cache()
    everyone = fact.select("cliente_id").distinct()
    assert got.count() == everyone.count()

    def rows(df):
        return sorted(map(tuple, df.collect()))
    want = ranking.suggestions(ranking.preferred_brand(fact, everyone, AS_OF, days), shelf, ranking.recent_skus(fact, AS_OF))
    assert rows(customer_serving.suggestion(got)) == rows(want)
    for n, column in ((1, "marca_pref"), (2, "segunda_marca")):
        assert rows(got.where(f"{column} IS NOT NULL").select("cliente_id", column)) == rows(ranking.nth_brand(fact, n).select("cliente_id", "marca"))
    assert rows(got.select("cliente_id", "ultima_compra")) == rows(ranking.last_purchase(fact))
    got.unpersist()


def test_profile_writes_no_row_per_customer_and_sku(domain, monkeypatch):
    fact, shelf, written = domain.saved_fact, domain.saved_shelf, []

    def counting(df, name="parte"):
        out = materialize(df, name)
        written.append(out.count())
        return out
    monkeypatch.setattr(customer_serving, "materialize", counting)
    customers = fact.select("cliente_id").distinct().count()
    assert customer_serving.customer_profile(fact, shelf, AS_OF).count() == customers
    assert written and max(written) <= customers < fact.select("cliente_id", "sku").distinct().count()


def test_shelf_numbers_only_stocked(spark):
    p = spark.createDataFrame([("a", "n", "M"), ("b", "n", "M"), ("c", "n", "M")], "sku string, nome string, marca string")
    s = spark.createDataFrame([(date(2026, 1, 1), "a", 3), (date(2026, 1, 1), "b", 0), (date(2026, 1, 1), "c", 7)],
                              "data_snapshot date, sku string, saldo int")
    got = {r.sku: (r.estante, r.estante_n) for r in ranking.shelf(p, s).collect()}
    assert got == {"c": (1, 2), "a": (2, 2)}
