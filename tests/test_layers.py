"""Layers published by one pointer, and the fact refreshed by month."""

import pytest
from pyspark.sql import functions as F

from vendaflow.operators import gold, incremental
from vendaflow.sources import tables
from vendaflow.sources.layers import BATCH, ConcurrentRun, Layer


@pytest.fixture
def database(spark):
    import uuid

    name = f"camada_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name}")
    return name


def numbers(spark, n):
    return spark.range(n).select(F.col("id").cast("int").alias("v"))


def staged(spark, database, n):
    run = Layer(spark, database)
    run.write("pedidos", tables.commented(numbers(spark, n), {"v": "valor"}), comment="com 'aspas'")
    run.write("clientes", numbers(spark, 10 * n))
    return run


def shown(spark, database):
    return spark.sql(f"SELECT (SELECT count(*) FROM {database}.pedidos), (SELECT count(*) FROM {database}.clientes)").first()


def test_a_layer_appears_as_a_whole(spark, database, monkeypatch):
    staged(spark, database, 1).publish()
    assert tuple(shown(spark, database)) == (1, 10)
    assert tables.column_comments(spark, f"{database}.pedidos") == {"v": "valor"}

    # a run that dies between two tables, before or while it makes views, leaves the old layer whole
    half = Layer(spark, database)
    half.write("pedidos", numbers(spark, 2))
    assert tuple(shown(spark, database)) == (1, 10) and half.read("pedidos").count() == 2
    assert half.read("pedidos", staged=False).count() == 1
    broken = staged(spark, database, 3)
    broken.write("nova", numbers(spark, 1))
    with monkeypatch.context() as m:
        m.setattr(Layer, "_advance", lambda self: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            broken.publish()
    assert tuple(shown(spark, database)) == (1, 10)
    assert spark.table(f"{database}.nova").count() == 0

    broken.publish()
    assert tuple(shown(spark, database)) == (3, 30) and spark.table(f"{database}.nova").count() == 1
    assert Layer(spark, database).roll_back() and tuple(shown(spark, database)) == (1, 10)
    with pytest.raises(LookupError):
        Layer(spark, database).roll_back()


def test_two_runs_do_not_interleave(spark, database):
    staged(spark, database, 1).publish()
    first, second = staged(spark, database, 2), staged(spark, database, 3)
    second.publish()
    with pytest.raises(ConcurrentRun):
        first.publish()
    assert tuple(shown(spark, database)) == (3, 30)
    # a run publishes stage by stage as one entry of the history
    second.write("pedidos", numbers(spark, 4))
    second.publish()
    assert tuple(shown(spark, database)) == (4, 30) and len(second.runs) == 2


def test_views_prune_to_the_batches_of_the_pointer(spark, database):
    for n in (1, 2):
        staged(spark, database, n).publish()
    df = spark.table(f"{database}.pedidos")
    assert len(df.inputFiles()) >= 1
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert BATCH in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "Subquery" not in plan


def test_old_batches_go_after_the_retention(spark, database):
    for n in (1, 2, 3, 4):
        staged(spark, database, n).publish()
    orphan = Layer(spark, database)
    orphan.write("pedidos", numbers(spark, 9))
    run = Layer(spark, database)
    assert run.collect_garbage() == []                       # younger than the retention
    gone = run.collect_garbage(retention_hours=0)
    assert len(gone) == 3                                    # two tables of the first run, and the orphan
    assert tuple(shown(spark, database)) == (4, 40)
    assert run.roll_back() and run.roll_back() and tuple(shown(spark, database)) == (2, 20)


def test_changed_columns_get_a_new_view(spark, database):
    staged(spark, database, 1).publish()
    spark.range(5).write.saveAsTable(f"{database}.antiga")   # a plain table of an earlier release
    run = Layer(spark, database)
    run.write("pedidos", numbers(spark, 2).withColumn("w", F.lit("x")))
    run.write("antiga", numbers(spark, 3))
    run.publish()
    assert spark.table(f"{database}.pedidos").columns == ["v", "w"] and spark.table(f"{database}.antiga").count() == 3
    run.roll_back()
    assert spark.table(f"{database}.pedidos").columns == ["v"] and spark.table(f"{database}.pedidos").count() == 1
    empty = Layer(spark, database)
    empty.write("pedidos", numbers(spark, 0))
    empty.publish()
    assert spark.table(f"{database}.pedidos").count() == 0


def files_by_month(layer):
    rows = layer.read("fato_vendas").select("ano", "mes", F.col("_metadata.file_path").alias("f")).distinct().collect()
    out = {}
    for r in rows:
        out.setdefault((r.ano, r.mes), set()).add(r.f)
    return out


def refresh(spark, database, domain, orders=None, lines=None, products=None, customers=None):
    run = Layer(spark, database)
    n = incremental.refresh_fact(run, orders or domain.pedidos, lines or domain.itens, products or domain.produtos, customers or domain.clientes_unicos)
    run.publish(0)
    states = {(r.ano, r.mes): r.estado for r in run.read("fato_vendas_meses").collect()}
    return n, states, files_by_month(run)


def plain(df):
    return sorted(tuple(str(v) for v in r) for r in df.select(*sorted(df.columns)).collect())


def test_only_changed_months_are_written(spark, database, domain):
    n, states, files = refresh(spark, database, domain)
    assert n == domain.fato.count() and set(states.values()) == {"nova"}

    same = refresh(spark, database, domain)
    assert set(same[1].values()) == {"igual"} and same[2] == files and same[0] == n

    # one order of one month gets another channel, one month disappears
    victim = domain.fato.where("ano = 1999 AND mes = 5").select("pedido_id").first()[0]
    orders = domain.pedidos.where("NOT (ano = 1998 AND mes = 3)").withColumn("canal", F.when(F.col("pedido_id") == victim, "outro").otherwise(F.col("canal")))
    n2, states, after = refresh(spark, database, domain, orders)
    assert {m for m, s in states.items() if s != "igual"} == {(1999, 5)} and states[1999, 5] == "alterada"
    assert (1998, 3) not in after and {m for m in after if after[m] != files[m]} == {(1999, 5)}
    want = gold.fato_vendas(orders, domain.itens, domain.produtos, domain.clientes_unicos)
    assert plain(spark.table(f"{database}.fato_vendas")) == plain(want) and n2 == want.count()

    # a product's cost reaches every month that sold it, a customer's city every month of that customer
    sku = domain.fato.first()["sku"]
    products = domain.produtos.withColumn("custo_unitario", F.when(F.col("sku") == sku, F.col("custo_unitario") + 1).otherwise(F.col("custo_unitario")).cast("decimal(18,2)"))
    client = domain.fato.where(f"sku <> '{sku}'").first()["cliente_id"]
    customers = domain.clientes_unicos.withColumn("cidade", F.when(F.col("cliente_id") == client, F.lit(None)).otherwise(F.col("cidade")))
    _, states, _ = refresh(spark, database, domain, orders, products=products, customers=customers)
    sold = want.where((F.col("sku") == sku) | (F.col("cliente_id") == client)).select("ano", "mes").distinct().collect()
    assert {m for m, s in states.items() if s != "igual"} == {(r.ano, r.mes) for r in sold}
    assert plain(spark.table(f"{database}.fato_vendas")) == plain(gold.fato_vendas(orders, domain.itens, products, customers))

    # back to the run before, and from there on again
    back = Layer(spark, database)
    back.roll_back()
    assert plain(spark.table(f"{database}.fato_vendas")) == plain(want)
    assert set(refresh(spark, database, domain, orders)[1].values()) == {"igual"}


def test_months_without_a_date_and_a_lost_line(spark, database, domain):
    orders = domain.pedidos.withColumns({c: F.when(F.col("pedido_id") % 50 == 0, F.lit(None)).otherwise(F.col(c)).cast(t)
                                         for c, t in (("data_pedido", "date"), ("ano", "int"), ("mes", "int"))})
    n, states, files = refresh(spark, database, domain, orders)
    assert states[None, None] == "nova" and n == domain.fato.count()
    line = domain.fato.where("pedido_id % 50 = 0").first()["item_id"]
    n2, states, after = refresh(spark, database, domain, orders, domain.itens.where(F.col("item_id") != line))
    assert n2 == n - 1 and {m for m, s in states.items() if s != "igual"} == {(None, None)}
    assert {m for m in after if after[m] != files[m]} == {(None, None)}


def test_whole_fact_is_fingerprinted_from_its_rows(spark, database, domain, monkeypatch):
    """A fact written whole is not joined a second time for its digests, and these equal the digests of the tables it was made from."""
    gone, nameless = ([r[0] for r in domain.fato.select("cliente_id").distinct().orderBy("cliente_id").limit(4).collect()][k::2] for k in (0, 1))
    customers = domain.clientes_unicos.where(~F.col("cliente_id").isin(gone)).withColumns(
        {c: F.when(~F.col("cliente_id").isin(nameless), F.col(c)) for c in ("razao_social", "segmento", "cidade")})
    orders = domain.pedidos.unionByName(domain.pedidos.where("pedido_id % 100 = 1")).withColumns(
        {c: F.when(F.col("pedido_id") % 50 != 0, F.col(c)) for c in ("data_pedido", "ano", "mes", "canal")})
    want = incremental.month_digests(orders, domain.itens, domain.produtos, customers)
    fact = gold.fato_vendas(orders, domain.itens, domain.produtos, customers)
    with monkeypatch.context() as m:
        m.setattr(incremental, "month_digests", None)
        n, states, files = refresh(spark, database, domain, orders, customers=customers)
    assert n == fact.count() and set(states.values()) == {"nova"} and (None, None) in states
    assert plain(Layer(spark, database).read("fato_vendas_meses").select(*want.columns)) == plain(want)
    assert plain(spark.table(f"{database}.fato_vendas")) == plain(fact)
    again = refresh(spark, database, domain, orders, customers=customers)
    assert set(again[1].values()) == {"igual"} and again[2] == files and again[0] == n


def test_a_fact_without_rows_fills_up_later(spark, database, domain):
    assert refresh(spark, database, domain, domain.pedidos.where("false")) == (0, {}, {})
    n, states, _ = refresh(spark, database, domain)
    assert n == domain.fato.count() and set(states.values()) == {"nova"}


def test_lines_move_once_by_sku(spark, domain):
    """Products shuffled by SKU meet lines where the price join left them."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = domain.fato._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    # lines by SKU and by order; parts for prices; products
    assert plan.count("hashpartitioning(sku#") == 3 and "hashpartitioning(l_partkey#" not in plan and "hashpartitioning(p_partkey#" not in plan
    assert plan.count("hashpartitioning(pedido_id#") == 2
