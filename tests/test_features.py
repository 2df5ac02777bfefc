"""Point-in-time features: cut-offs, NULL rules, edges, and a customer with very many lines."""

from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from vendaflow.operators import features
from vendaflow.schemas import FEATURES

REF = date(2026, 8, 1)
SCHEMA = ("cliente_id string, pedido_id string, data_pedido date, ano int, mes int, sku string, categoria string, "
          "marca string, receita decimal(18,2), margem decimal(18,2), devolucao boolean")


def sale(c, p, day, sku="s", brand="m", value="10"):
    return (c, p, day, day.year, day.month, sku, "cat", brand, Decimal(value), Decimal(value) / 2, False)


def fact(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def before(days):
    return REF - timedelta(days=days)


def one(spark, rows, c="a"):
    return features.rfm_and_rhythm(fact(spark, rows), REF).filter(F.col("cliente_id") == c).first()


def test_single_order(spark):
    r = one(spark, [sale("a", "1", before(20))])
    assert (r.recencia_dias, r.frequencia_pedidos, r.intervalo_medio_dias, r.desvio_intervalo_dias,
            r.atraso_relativo, r.pedidos_ultimos_90d) == (13.0, 1.0, None, None, 10.0, 1.0)


def test_two_and_three_orders(spark):
    r = one(spark, [sale("a", "1", before(47)), sale("a", "2", before(27))])
    assert (r.intervalo_medio_dias, r.desvio_intervalo_dias, r.atraso_relativo) == (20.0, None, 1.0)
    r = one(spark, [sale("a", "1", before(47)), sale("a", "2", before(27)), sale("a", "3", before(17))])
    assert r.intervalo_medio_dias == 15.0 and r.desvio_intervalo_dias == pytest.approx(7.0710678)


def test_same_day_orders_are_zero_gaps(spark):
    r = one(spark, [sale("a", "1", before(27)), sale("a", "2", before(27)), sale("a", "3", before(17))])
    assert r.intervalo_medio_dias == 5.0 and r.desvio_intervalo_dias == pytest.approx(7.0710678)
    r = one(spark, [sale("a", "1", before(27)), sale("a", "2", before(27))])
    assert r.intervalo_medio_dias == 0.0 and r.atraso_relativo == 10.0


def test_only_recent_orders(spark):
    r = one(spark, [sale("a", "1", before(3))])
    assert (r.recencia_dias, r.frequencia_pedidos, r.atraso_relativo, r.sem_historico_ritmo) == (0.0, 1.0, None, True)


def test_90_day_edges(spark):
    days = (97, 98, 8, 7)
    r = one(spark, [sale("a", str(d), before(d)) for d in days])
    assert r.pedidos_ultimos_90d == 2.0  # ref-97 and ref-8


def test_zero_revenue_gives_null_ratios(spark):
    r = one(spark, [sale("a", "1", before(20), value="5"), sale("a", "2", before(30), value="-5")])
    assert r.valor_total == 0 and r.margem_percentual is None and r.ticket_medio == 0


def test_order_gaps_equal_lag(spark, domain):
    got = features.order_gaps(domain.fato, "2001-07-01")
    from pyspark.sql import Window
    orders = domain.fato.filter("data_pedido < DATE '2001-06-24'").select("cliente_id", "pedido_id", "data_pedido").distinct()
    w = Window.partitionBy("cliente_id").orderBy("data_pedido", "pedido_id")
    want = orders.withColumn("data_anterior", F.lag("data_pedido").over(w))
    a = got.select("cliente_id", "pedido_id", "data_pedido", "data_anterior")
    assert a.exceptAll(want).count() == 0 and want.exceptAll(a).count() == 0


def test_label_edges(spark):
    rows = [sale(str(i), str(i), REF + timedelta(days=i)) for i in (-1, 0, 6, 7)]
    got = {r.cliente_id for r in features.buyers_in_window(fact(spark, rows), REF).collect()}
    assert got == {"0", "6"}


def test_launch_has_no_upper_bound(spark):
    products = spark.createDataFrame([("new", before(120)), ("old", before(121)), ("later", REF + timedelta(days=9))],
                                     "sku string, data_lancamento date")
    rows = [sale("n", "1", before(9), "new"), sale("o", "2", before(9), "old"), sale("l", "3", before(9), "later")]
    got = {r.cliente_id: r.comprou_lancamento for r in features.mix(fact(spark, rows), products, REF).collect()}
    assert got == {"n": 1.0, "o": 0.0, "l": 1.0}
    assert {r.cliente_id for r in features.bought_launch(fact(spark, rows), products, REF).collect()} == {"n", "l"}


def test_mix_with_gaps_moves_rows_once_by_customer(spark):
    rows = [("a", "s1", "x", "m"), ("a", "s2", "x", "n"), ("a", "s3", None, "n"), ("a", "s4", "y", None), ("a", "s4", "y", None),
            ("a", None, "x", "n"), ("b", "s1", None, None)]
    f = fact(spark, [(c, "1", before(9), before(9).year, before(9).month, sku, category, brand, Decimal(10), Decimal(5), False)
                     for c, sku, category, brand in rows])
    products = spark.createDataFrame([("s4", before(9)), ("s4", before(8)), ("s9", before(9))], "sku string, data_lancamento date")
    out = features.mix(f, products, REF)
    got = {r.cliente_id: (r.skus_distintos, r.categorias_distintas, r.marcas_distintas, r.comprou_lancamento, r.concentracao_marca_top)
           for r in out.collect()}
    assert got == {"a": (4.0, 2.0, 2.0, 1.0, pytest.approx(0.5)), "b": (1.0, 0.0, 0.0, 0.0, 1.0)}
    plan = out._jdf.queryExecution().sparkPlan().toString()
    # one aggregate multiplied rows for two distinct counts, and five steps moved them
    assert "Expand" not in plan and out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].count("Exchange hash") == 2


def test_no_feature_sees_the_cutoff_or_later(domain):
    ref = "2001-03-01"
    inputs = [domain.oportunidades, domain.visitas, domain.produtos]
    full = features.feature_table(domain.fato, *inputs, ref)
    past = features.feature_table(
        domain.fato.filter(f"data_pedido < DATE '{ref}'"), domain.oportunidades.filter(f"data_abertura < DATE '{ref}'"),
        domain.visitas.filter(f"data_visita < DATE '{ref}'"), domain.produtos, ref)
    assert full.columns == ["cliente_id", *FEATURES, "sem_historico_ritmo", "_referencia"]
    assert full.exceptAll(past).count() == 0 and full.count() == past.count() > 0


def test_customer_with_a_third_of_all_orders(spark):
    """The rhythm window sees one row per day, not one per order."""
    hot = [sale("hot", f"h{i}", before(8 + i % 30)) for i in range(900)]
    rest = [sale(f"c{i}", f"r{i}", before(20)) for i in range(100)]
    f = fact(spark, hot + rest)
    days = features.customer_days(f, REF)
    assert days.filter("cliente_id = 'hot'").count() == 30
    r = features.rfm_and_rhythm(f, REF).filter("cliente_id = 'hot'").first()
    assert r.frequencia_pedidos == 900 and r.intervalo_medio_dias == pytest.approx(29 / 899)
