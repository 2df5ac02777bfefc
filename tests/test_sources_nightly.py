"""Sources, sinks and the whole nightly run on landed extracts."""

import json
import shutil

import pytest
from pyspark.sql import functions as F

from vendaflow import schemas
from vendaflow.functions.dates import date_window
from vendaflow.operators.quality import QualityError
from vendaflow.plans.nightly import CountMismatch, Nightly, Settings
from vendaflow.plans.table_functions import register_table_functions
from vendaflow.sources import catalog, fixtures, raw_csv, tables


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def test_arrival_states(spark, tmp_path):
    write(tmp_path / "erp" / "produtos.csv", ",".join(schemas.RAW_TABLES["produtos"][2]) + "\na,b,c,,,,,,,\nd,,,,,,,,,\n")
    write(tmp_path / "erp" / "pedidos.csv", ",".join(schemas.RAW_TABLES["pedidos"][2]) + "\n")
    control = raw_csv.arrival_control(spark, str(tmp_path), ["produtos", "pedidos", "visitas"])
    got = {r.arquivo: (r.status, r.linhas, r.bytes > 0) for r in control.collect()}
    assert got == {"produtos.csv": ("OK", 2, True), "pedidos.csv": ("VAZIO", 0, True),
                   "visitas.csv": ("FALTA", 0, False)}
    with pytest.raises(raw_csv.ArrivalError, match="pedidos.csv: VAZIO"):
        raw_csv.require_arrival(control)
    assert raw_csv.arrival_control(spark, str(tmp_path), ["visitas"]).first().status == "FALTA"


def test_raw_scan_is_text_and_empty_is_null(spark, tmp_path):
    write(tmp_path / "erp" / "estoque.csv", "data_snapshot,sku,saldo,ruptura\n2026-01-01,007,,N\n")
    row = raw_csv.with_source(raw_csv.read_raw(spark, str(tmp_path), "estoque"), "estoque").first()
    assert (row.sku, row.saldo, row._arquivo_origem) == ("007", None, "estoque.csv") and row._ingerido_em
    probe = raw_csv.schema_probe(spark, str(tmp_path), ["estoque"])
    assert [r.coluna for r in probe.orderBy("posicao").collect()] == ["data_snapshot", "sku", "saldo", "ruptura"]
    assert probe.filter("NOT esperada").count() == 0


def test_fixtures_by_suffix(spark, tmp_path):
    write(tmp_path / "a.csv", "x,y\n1,b\n")
    write(tmp_path / "a.json", json.dumps([{"x": 1}, {"x": 2}], indent=1))
    write(tmp_path / "b.json", '{"x": 1}\n{"x": 2}\n{"x": 3}\n')
    assert fixtures.load_fixture(spark, str(tmp_path / "a.csv")).first() == ("1", "b")
    assert fixtures.load_fixture(spark, str(tmp_path / "a.json")).count() == 2
    assert fixtures.load_fixture(spark, str(tmp_path / "b.json")).count() == 3
    with pytest.raises(ValueError):
        fixtures.load_fixture(spark, "a.xml")


def test_sinks(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS sinks")
    df = spark.createDataFrame([(1, 2025, 1), (2, 2025, 2), (3, 2025, 2)], "v int, ano int, mes int")
    assert tables.overwrite(tables.commented(df, {"v": "valor"}), "sinks.f", "tabela d'ouro", ["ano", "mes"]) == 3
    assert tables.column_comments(spark, "sinks.f") == {"v": "valor"}
    assert tables.overwrite_partitions(spark.createDataFrame([(9, 2025, 2)], "v int, ano int, mes int"),
                                       "sinks.f", ["ano", "mes"]) == 1
    assert {(r.v, r.mes) for r in spark.table("sinks.f").collect()} == {(1, 1), (9, 2)}
    assert tables.append(df, "sinks.h") == 3 and tables.append(df, "sinks.h") == 3
    assert spark.table("sinks.h").count() == 6
    meta = catalog.schema_catalog(spark, catalog.database_tables(spark, "sinks"))
    assert meta.filter("tabela = 'f' AND comentario = 'valor' AND tipo = 'int'").count() == 1


def test_date_window_prunes_partitions(spark, tmp_path):
    days = spark.sql("SELECT explode(sequence(DATE '2024-01-01', DATE '2025-12-31')) AS d")
    df = days.select("d", F.year("d").alias("ano"), F.month("d").alias("mes"))
    saved = tables.overwrite_path(df, str(tmp_path / "p"), ["ano", "mes"])
    hit = saved.filter(date_window("d", "2024-11-15", "2025-02-01", "ano", "mes"))
    assert hit.count() == saved.filter("d >= '2024-11-15' AND d < '2025-02-01'").count() == 78
    plan = hit._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "ano" in plan.split("PartitionFilters")[1][:200]
    assert "PushedFilters: [" in plan and "GreaterThanOrEqual(d" in plan


@pytest.fixture(scope="module")
def landed(spark, domain, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("raw"))
    for t, df in domain.raw().items():
        df.select(*schemas.RAW_TABLES[t][2]).write.csv(
            raw_csv.raw_path(root, t), header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return root


def settings(root, **kw):
    base = dict(raw_root=root, train_ref="2001-07-01", score_ref="2001-08-01", as_of="2001-08-01", prefix="n_",
                strict=("queue",), queue_size=40, iterations=2, calendar=("1995-01-01", "2001-08-31"))
    return Settings(**{**base, **kw})


def test_nightly_end_to_end(spark, domain, landed):
    run = Nightly(spark, settings(landed))
    counts = run.run()
    assert counts["bronze.itens_pedido"] == counts["silver.itens_pedido"] == domain.itens.count()
    fact = spark.table("n_gold.fato_vendas")
    assert fact.count() == domain.fato.count()
    assert fact.agg(F.sum("receita")).first()[0] == domain.fato.agg(F.sum("receita")).first()[0]
    assert counts["gold.fila_semanal"] == 40 and spark.table("n_gold.modelo_metricas").count() == 1
    assert spark.table("n_silver.pedidos").select("_linhas_origem").distinct().first()[0] == 1500

    assert tables.column_comments(spark, "n_gold.fato_vendas")["receita"] == schemas.FACT_COMMENTS["receita"]
    assert register_table_functions(spark, "n_")[0] == "priorizar_carteira"
    row = spark.table("n_gold.fila_semanal").first()
    mine = spark.sql(f"SELECT * FROM priorizar_carteira('{row.vendedor_id}', 2)").collect()
    assert mine and all(r.ordem <= 2 for r in mine)
    # a lookup reads one bucket of one table and nothing of the fact; the planner prints buckets of bucketed scans only
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    try:
        for call, table in ((f"contexto_cliente('{row.cliente_id}')", "contexto_servico"), (f"sugerir_produtos('{row.cliente_id}')", "sugestoes_servico"),
                            ("checar_disponibilidade('10')", "disponibilidade_servico")):
            plan = spark.sql(f"SELECT * FROM {call}")._jdf.queryExecution().executedPlan().toString()
            assert "SelectedBucketsCount: 1 out of 32" in plan and plan.count("FileScan") == 1 and f"{table}__dados" in plan
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    ctx = spark.sql(f"SELECT * FROM contexto_cliente('{row.cliente_id}')").first()
    assert ctx.cliente_id == row.cliente_id and ctx.marca_pref
    sug = spark.sql(f"SELECT * FROM sugerir_produtos('{row.cliente_id}')").collect()
    assert len(sug) <= 20 and [r.receita_total for r in sug] == sorted((r.receita_total for r in sug), reverse=True)
    assert spark.sql("SELECT * FROM checar_disponibilidade('10')").count() == 1


def test_nightly_stops_at_failed_gates(spark, landed):
    run = Nightly(spark, settings(landed, prefix="g_", strict=("constraints", "quality", "model")))
    run.databases(), run.arrival(), run.bronze()
    with pytest.raises(QualityError, match="data_cadastro_obrigatoria"):
        run.silver()
    assert not spark.catalog.tableExists("g_silver.clientes")
    run.s.strict = ("quality",)
    run.silver()
    shown = spark.sql("SHOW CREATE TABLE g_silver.clientes").first()[0]
    run.s.strict = ("constraints", "quality")
    with pytest.raises(QualityError, match="data_cadastro_obrigatoria"):
        run.silver()
    # the failing run leaves the tables of the run before
    assert spark.sql("SHOW CREATE TABLE g_silver.clientes").first()[0] == shown
    assert spark.table("g_silver.clientes").count() > 0
    run.s.strict = ("quality",)
    run.gold()
    with pytest.raises(QualityError, match="receita gold = silver"):
        run.gates()
    assert not spark.catalog.tableExists("g_gold.fato_vendas")


def test_bronze_reads_once_and_refuses_before_it_shows(spark, landed, tmp_path, monkeypatch):
    reads = []
    read = raw_csv.read_raw
    monkeypatch.setattr(raw_csv, "read_raw", lambda s, root, t: reads.append(t) or read(s, root, t))
    run = Nightly(spark, settings(landed, prefix="m_"))
    write_rows = run.layers["bronze"].write
    run.layers["bronze"].write = lambda t, df, **kw: write_rows(t, df, **kw) + (t == "produtos")
    run.databases(), run.arrival()
    assert not reads                                     # the listing only
    with pytest.raises(CountMismatch, match="produtos"):
        run.bronze()
    assert sorted(reads) == sorted(schemas.RAW_TABLES) and not spark.catalog.tableExists("m_bronze.produtos")
    run.layers["bronze"].write = write_rows
    run.bronze()
    control = {r.arquivo: r.linhas for r in spark.table("m_bronze._raw_arquivos").collect()}
    assert control["produtos.csv"] == spark.table("m_bronze.produtos").count() > 0

    # an extract with a header only stops the layer, a missing one the run
    broken = str(tmp_path / "raw")
    shutil.copytree(landed, broken, ignore=shutil.ignore_patterns("estoque.csv"))
    write(tmp_path / "raw" / "erp" / "estoque.csv", ",".join(schemas.RAW_TABLES["estoque"][2]) + "\n")
    later = Nightly(spark, settings(broken, prefix="m_"))
    later.arrival()
    with pytest.raises(raw_csv.ArrivalError, match="estoque.csv: VAZIO"):
        later.bronze()
    assert spark.table("m_bronze.estoque").count() > 0
    with pytest.raises(raw_csv.ArrivalError, match="FALTA"):
        Nightly(spark, settings(str(tmp_path / "nichts"), prefix="m_")).arrival()


def test_a_dominant_partition_is_split_by_size(spark, tmp_path):
    df = spark.range(200_000).selectExpr("id", "sha2(cast(id AS string), 256) AS texto", "2024 AS ano", "IF(id % 50 = 0, 2, 1) AS mes")
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "2m")
    try:
        written = tables.overwrite_path(df, str(tmp_path / "fato"), ["ano", "mes"])
    finally:
        spark.conf.set(key, before)
    assert written.count() == 200_000
    assert len(list((tmp_path / "fato" / "ano=2024" / "mes=1").glob("part-*"))) > 2


def test_no_machine_local_scratch_on_a_cluster():
    from types import SimpleNamespace

    from vendaflow.session import shared_dir

    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None, getConf=lambda: {})
    with pytest.raises(RuntimeError):
        shared_dir(SimpleNamespace(conf={}, sparkContext=context))
