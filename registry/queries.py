"""Every registered query: a Spark callable and, where SQL can state the result, its oracle."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import SparkRuntimeException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registry.domain import AS_OF, HISTORY, SCORE_REF, TRAIN_REF, Domain
from registry.oracle import REASON, half_up, quotient, sql
from vendaflow import schemas, session
from vendaflow.functions import text
from vendaflow.functions.dates import date_window, days_before
from vendaflow.operators import (active_windows, customer_serving, feature_history, features, gold, incremental, metrics, model, month_quantiles, quality,
                                 ranking, serving, silver, weekly_queue)
from vendaflow.operators.ordering import exact_quantiles, row_numbers
from vendaflow.plans import table_functions
from vendaflow.sources import catalog, fixtures, raw_csv, tables
from vendaflow.sources.layers import Layer


@dataclass
class Query:
    name: str
    build: Callable[[Domain], DataFrame]
    oracle: str | None

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return edge(self.build(Domain(spark, sf_dir)))


REGISTRY: dict[str, Query] = {}


def edge(df: DataFrame) -> DataFrame:
    """Compare-friendly types: decimals as double, doubles rounded to 6 digits, arrays as text."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DoubleType):
            c = F.round(c, 6)
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c, ",")
        out.append(c.alias(f.name))
    return df.select(*out)


def query(name: str, oracle: str | None = None, columns: str | None = None, same_as: str | None = None):
    """Register a query; `columns` names the columns of an oracle that is a VALUES list, `same_as` a query of equal answer."""
    if columns:
        oracle = f"SELECT * FROM ({oracle}) AS v({columns})"

    def register(fn: Callable[[Domain], DataFrame]):
        REGISTRY[name] = Query(name, fn, REGISTRY[same_as].oracle if same_as else sql(oracle) if oracle else None)
        return fn
    return register


def _r(*cols: str) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in cols)


def _d(*cols: str) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols)


# ---- sources and sinks --------------------------------------------------------------------------

def _land(d: Domain, names: list[str] | None = None, empty: tuple[str, ...] = ()) -> str:
    """Write raw frames as the CSV extracts the sources expect; those in `empty` get a header only."""
    root = session.scratch_path(d.spark, "raw")
    frames = d.raw()
    for t in names or list(schemas.RAW_TABLES):
        df = frames[t].select(*schemas.RAW_TABLES[t][2])
        (df.filter("false") if t in empty else df).write.csv(
            raw_csv.raw_path(root, t), header=True, ignoreLeadingWhiteSpace=False,
            ignoreTrailingWhiteSpace=False)
    return root


def _each_extract(statement: str) -> str:
    """The statement for every extract: {t} is its table, {v} its raw relation, {f} its file, {c} its columns as one text."""
    views = {"itens_pedido": "d_itens_raw"}
    return "\nUNION ALL ".join(
        statement.format(t=t, f=f, s=system, v=views.get(t, f"d_{t}_raw"),
                         c=" || '|' || ".join(f"coalesce({c}, '<nulo>')" for c in columns))
        for t, (system, f, columns) in schemas.RAW_TABLES.items())


@query("bronze_text_scan", _each_extract("""
SELECT '{t}' AS tabela, count(*) AS linhas, CAST(sum(CAST('0x' || md5({c})[1:12] AS BIGINT)) AS VARCHAR) AS resumo FROM {v}"""))
def _(d):
    """Rows and an order-free digest of all text of every extract, as read back."""
    root = _land(d)

    def digest(t: str) -> DataFrame:
        whole = F.concat_ws("|", *[F.coalesce(c, F.lit("<nulo>")) for c in schemas.RAW_TABLES[t][2]])
        number = F.conv(F.substring(F.md5(whole.cast("binary")), 1, 12), 16, 10).cast("decimal(38,0)")
        return raw_csv.read_raw(d.spark, root, t).agg(
            F.lit(t).alias("tabela"), F.count("*").alias("linhas"), F.sum(number).cast("string").alias("resumo"))
    return reduce(DataFrame.unionByName, [digest(t) for t in schemas.RAW_TABLES])


@query("raw_arrival_control", _each_extract(
    "SELECT 'completa' AS entrega, '{s}' AS sistema, '{f}' AS arquivo, count(*) AS linhas, 'OK' AS status, false AS recusada FROM {v}") + """
UNION ALL SELECT 'falha', 'erp', 'produtos.csv', count(*), 'OK', true FROM d_produtos_raw
UNION ALL SELECT 'falha', 'erp', 'estoque.csv', 0, 'VAZIO', true
UNION ALL SELECT 'falha', 'crm', 'visitas.csv', 0, 'FALTA', true""")
def _(d):
    """A whole delivery of ten extracts, and one with an empty and an absent extract, which the gate refuses."""
    def checked(label: str, root: str, names: list[str] | None = None) -> DataFrame:
        control = session.materialize(raw_csv.arrival_control(d.spark, root, names), "controle")
        try:
            raw_csv.require_arrival(control)
            refused = False
        except raw_csv.ArrivalError:
            refused = True
        return control.select(F.lit(label).alias("entrega"), "sistema", "arquivo", "linhas", "status",
                              F.lit(refused).alias("recusada"))
    broken = _land(d, ["produtos", "estoque"], empty=("estoque",))
    return checked("completa", _land(d)).unionByName(checked("falha", broken, ["produtos", "estoque", "visitas"]))


@query("schema_probe", "VALUES " + ", ".join(
    f"('{f}', {i + 1}, '{c}', true)" for _, f, columns in schemas.RAW_TABLES.values() for i, c in enumerate(columns)),
       columns="arquivo, posicao, coluna, esperada")
def _(d):
    return raw_csv.schema_probe(d.spark, _land(d))


@query("load_fixture", "\nUNION ALL ".join(
    f"SELECT '{kind}' AS formato, CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name, CAST(n_regionkey AS VARCHAR) AS n_regionkey FROM nation"
    for kind in ("csv", "json", "json em lista")))
def _(d):
    """One table as CSV, as JSON lines and as one JSON array."""
    nations, path = d.table("nation"), session.scratch_path(d.spark, "fixture")
    nations.write.csv(path + ".csv", header=True)
    nations.write.json(path + ".json")
    array = nations.agg(F.to_json(F.collect_list(F.struct(*nations.columns))).alias("value"))
    array.coalesce(1).write.text(path + "-lista.json")

    def loaded(kind: str, file: str) -> DataFrame:
        return fixtures.load_fixture(d.spark, file).select(
            F.lit(kind).alias("formato"), F.col("n_nationkey").cast("string"), "n_name", F.col("n_regionkey").cast("string"))
    return (loaded("csv", path + ".csv").unionByName(loaded("json", path + ".json"))
            .unionByName(loaded("json em lista", path + "-lista.json")))


@query("dim_calendario", """
SELECT data, CAST(year(data) AS INTEGER) AS ano, CAST(month(data) AS INTEGER) AS mes, monthname(data) AS nome_mes,
  CAST(quarter(data) AS INTEGER) AS trimestre, CAST(dayofweek(data) + 1 AS INTEGER) AS dia_semana,
  month(data) IN (4, 6, 10) AS mes_pico_setor
FROM (SELECT CAST(unnest(generate_series(date_trunc('month', min(data_pedido)), last_day(max(data_pedido)), INTERVAL 1 DAY)) AS DATE) AS data
      FROM d_pedidos)""")
def _(d):
    return gold.calendar_spanning(d.pedidos, "data_pedido")


# Expected columns of the saved tables, in order.
_CATALOG = {
    "clientes": (
        "cliente_id string, cnpj string, razao_social string, data_cadastro date, ativo boolean, "
        "segmento string, cidade string, uf string, bairro string, qtd_registros bigint"),
    "pedidos": (
        "pedido_id string, cliente_id string, vendedor_id string, data_pedido date, canal string, "
        "valor_total decimal(18,2), cancelado boolean, valor_liquido decimal(18,2), ano int, mes int"),
    "itens_pedido": (
        "item_id string, pedido_id string, sku string, quantidade int, quantidade_abs int, "
        "devolucao boolean, preco_praticado decimal(18,2), desconto_pct decimal(18,2), "
        "valor_bruto decimal(18,2), custo_unitario decimal(18,2), sku_descontinuado boolean"),
    "produtos": (
        "sku string, nome string, categoria string, marca string, nota_olfativa string, "
        "data_lancamento date, preco_tabela decimal(18,2), custo_unitario decimal(18,2), unidade string, "
        "ativo boolean"),
    "vendedores": (
        "vendedor_id string, nome string, regiao string, uf string, data_admissao date, "
        "data_desligamento date, ativo boolean, meta_mensal decimal(18,2)"),
    "carteira": (
        "carteira_id string, cliente_id string, vendedor_id string, data_inicio date, data_fim date, "
        "vigente boolean, orfao_vendedor_desligado boolean"),
    "oportunidades": (
        "oportunidade_id string, cliente_id string, vendedor_id string, origem string, etapa string, "
        "data_abertura date, data_fechamento date, probabilidade_pct decimal(5,2), "
        "valor_estimado decimal(18,2), ciclo_dias int, motivo_perda string, ganancia boolean, perdida boolean"),
    "visitas": (
        "visita_id string, cliente_id string, vendedor_id string, data_visita date, resultado string, "
        "duracao_min int"),
    "pagamentos": (
        "pagamento_id string, pedido_id string, forma_pagamento string, parcelas int, valor decimal(18,2), "
        "valor_liquido decimal(18,2), taxa_pct decimal(5,2), data_vencimento date, data_pagamento date, "
        "status_pagamento string"),
    "estoque": (
        "data_snapshot date, sku string, saldo int, ruptura boolean"),
    "fato_vendas": (
        "pedido_id string, item_id string, cliente_id string, razao_social string, segmento string, "
        "cidade string, data_pedido date, ano int, mes int, canal string, sku string, categoria string, "
        "marca string, nota_olfativa string, vendedor_id string, quantidade int, quantidade_abs int, "
        "preco_praticado decimal(18,2), receita decimal(29,2), custo decimal(29,2), margem decimal(30,2), "
        "devolucao boolean, sku_descontinuado boolean"),
    "dim_cliente": (
        "cliente_id string, cnpj string, razao_social string, segmento string, cidade string, uf string, "
        "bairro string, data_cadastro date, ativo boolean, total_pedidos bigint, "
        "receita_acumulada decimal(38,2), primeiro_pedido date, ultimo_pedido date, dias_sem_comprar int"),
    "dim_produto": (
        "sku string, nome string, categoria string, marca string, nota_olfativa string, "
        "preco_tabela decimal(18,2), custo_unitario decimal(18,2), unidade string, ativo boolean, "
        "data_lancamento date, descontinuado boolean"),
    "dim_vendedor": (
        "vendedor_id string, nome string, regiao string, uf string, meta_mensal decimal(18,2), ativo boolean"),
}
_COUNTED = {"itens_pedido": "d_itens", "fato_vendas": "d_fato", "dim_produto": "d_produtos", "dim_vendedor": "d_vendedores"}


def _catalog_oracle() -> str:
    rows = [f"('{t}', {i + 1}, '{c.split()[0]}', '{c.split()[1]}')"
            for t, ddl in _CATALOG.items() for i, c in enumerate(ddl.split(", "))]
    counts = " UNION ALL ".join(f"SELECT '{t}' AS tabela, count(*) AS linhas FROM {_COUNTED.get(t, 'd_' + t)}" for t in _CATALOG)
    return (f"SELECT tabela, posicao, coluna, tipo, CAST(NULL AS VARCHAR) AS comentario, linhas "
            f"FROM (VALUES {', '.join(rows)}) AS v(tabela, posicao, coluna, tipo) JOIN ({counts}) USING (tabela)")


@query("schema_catalog", _catalog_oracle())
def _(d):
    named = {"clientes": d.clientes, "pedidos": d.pedidos, "itens_pedido": d.itens, "produtos": d.produtos,
             "vendedores": d.vendedores, "carteira": d.carteira, "oportunidades": d.oportunidades, "visitas": d.visitas,
             "pagamentos": d.pagamentos, "estoque": d.estoque, "fato_vendas": d.fato, "dim_cliente": d.dim_cliente,
             "dim_produto": d.dim_produto, "dim_vendedor": gold.dim_vendedor(d.vendedores)}
    return catalog.schema_catalog(d.spark, named).join(quality.table_counts(named), "tabela")


@query("sink_overwrite_roundtrip", """
SELECT canal, cancelado, count(*) AS pedidos, CAST(sum(valor_liquido) AS DOUBLE) AS valor FROM d_pedidos GROUP BY 1, 2""")
def _(d):
    path = session.scratch_path(d.spark, "pedidos")
    return (tables.overwrite_path(d.pedidos, path).groupBy("canal", "cancelado")
            .agg(F.count("*").alias("pedidos"), F.sum("valor_liquido").alias("valor")))


@query("fact_partition_roundtrip", """
SELECT ano, mes, count(*) AS linhas, CAST(sum(receita) AS DOUBLE) AS receita FROM d_fato
WHERE data_pedido >= DATE '2000-03-15' AND data_pedido < DATE '2001-02-10' GROUP BY 1, 2""")
def _(d):
    fact = tables.overwrite_path(d.fato, session.scratch_path(d.spark, "fato"), ["ano", "mes"])
    return (fact.filter(date_window("data_pedido", "2000-03-15", "2001-02-10", "ano", "mes"))
            .groupBy("ano", "mes").agg(F.count("*").alias("linhas"), F.sum("receita").alias("receita")))


def _database(d: Domain, name: str) -> str:
    full = f"{name}_{uuid.uuid4().hex[:12]}"
    d.spark.sql(f"CREATE DATABASE {full}")
    return full


_OLD_ORDERS = "data_pedido < DATE '2000-01-01'"


@query("layer_publication", f"""
SELECT * FROM (WITH p AS (SELECT count(*) FILTER ({_OLD_ORDERS}) AS antigos, count(*) AS todos FROM d_pedidos),
     c AS (SELECT count(*) FILTER (ativo) AS ativos, count(*) AS todos FROM d_clientes)
SELECT etapa, CASE WHEN novo THEN p.todos ELSE antigos END AS pedidos, CASE WHEN novo THEN c.todos ELSE ativos END AS clientes
FROM (VALUES ('1 publicada', false), ('2 gravando', false), ('3 nova', true), ('4 de volta', false)) AS v(etapa, novo), p, c)""")
def _(d):
    """What readers of two tables of a layer see: first run, second run while it writes, published, and withdrawn."""
    name = _database(d, "camada")

    def stage(orders: DataFrame, customers: DataFrame) -> Layer:
        run = Layer(d.spark, name)
        run.write("pedidos", orders)
        run.write("clientes", customers)
        return run

    def seen(label: str) -> DataFrame:
        counts = d.spark.sql(f"SELECT '{label}' AS etapa, (SELECT count(*) FROM {name}.pedidos) AS pedidos, (SELECT count(*) FROM {name}.clientes) AS clientes")
        return session.materialize(counts, "visto")
    stage(d.pedidos.filter(_OLD_ORDERS), d.clientes_unicos.filter("ativo")).publish()
    out = [seen("1 publicada")]
    second = stage(d.pedidos, d.clientes_unicos)
    out.append(seen("2 gravando"))
    second.publish()
    out.append(seen("3 nova"))
    second.roll_back()
    return reduce(DataFrame.unionByName, [*out, seen("4 de volta")])


@query("fact_incremental", """
SELECT * FROM (WITH antes AS (SELECT * FROM d_fato WHERE NOT (ano = 1999 AND mes = 7)),
     mexido AS (SELECT DISTINCT ano, mes FROM antes WHERE (ano = 2000 AND mes = 3) OR sku = '7')
SELECT ano, mes, linhas, CAST(receita AS DOUBLE) AS receita,
  CASE WHEN ano = 1999 AND mes = 7 THEN 'nova' WHEN m.ano IS NOT NULL THEN 'alterada' ELSE 'igual' END AS estado,
  NOT (ano = 1999 AND mes = 7) AND m.ano IS NULL AS mesmos_arquivos
FROM (SELECT ano, mes, count(*) AS linhas, sum(receita) AS receita FROM d_fato GROUP BY ano, mes) LEFT JOIN mexido m USING (ano, mes))""")
def _(d):
    """Two runs. The first lacks one month, has another channel in a second one and another cost of one SKU; the second writes
    only the months which that concerns and shares the files of the others."""
    name = _database(d, "incremental")

    def refresh(orders: DataFrame, products: DataFrame) -> tuple[Layer, DataFrame]:
        run = Layer(d.spark, name)
        incremental.refresh_fact(run, orders, d.itens, products, d.clientes_unicos)
        run.publish()
        files = run.read(incremental.FACT).select("ano", "mes", F.col("_metadata.file_path").alias("f"))
        return run, session.materialize(files.groupBy("ano", "mes").agg(F.array_sort(F.collect_set("f")).alias("arquivos")), "arquivos")
    orders = d.pedidos.filter("NOT (ano = 1999 AND mes = 7)").withColumn(
        "canal", F.when(F.expr("ano = 2000 AND mes = 3"), F.lit("outro")).otherwise(F.col("canal")))
    cost = F.when(F.col("sku") == "7", F.col("custo_unitario") + 1).otherwise(F.col("custo_unitario")).cast("decimal(18,2)")
    _, before = refresh(orders, d.produtos.withColumn("custo_unitario", cost))
    run, after = refresh(d.pedidos, d.produtos)
    same = after.join(before.withColumnRenamed("arquivos", "antes"), ["ano", "mes"], "left").select(
        "ano", "mes", F.coalesce(F.col("arquivos") == F.col("antes"), F.lit(False)).alias("mesmos_arquivos"))
    months = d.spark.table(f"{name}.fato_vendas").groupBy("ano", "mes").agg(F.count("*").alias("linhas"), F.sum("receita").alias("receita"))
    return (months.join(run.read(incremental.MONTHS).select("ano", "mes", "estado"), ["ano", "mes"]).join(same, ["ano", "mes"])
            .select("ano", "mes", "linhas", "receita", "estado", "mesmos_arquivos"))


@query("commented_schema", "\nUNION ALL ".join(
    f"SELECT 'fato_vendas' AS tabela, {p} AS posicao, '{c}' AS coluna, '{t}' AS tipo, '{schemas.FACT_COMMENTS[c]}' AS comentario, count({c}) AS preenchidos FROM d_fato"
    for p, c, t in ((16, "quantidade", "int"), (19, "receita", "decimal(29,2)"), (20, "custo", "decimal(29,2)"), (21, "margem", "decimal(30,2)"), (22, "devolucao", "boolean"), (23, "sku_descontinuado", "boolean"))))
def _(d):
    fact = tables.overwrite_path(tables.commented(d.fato, schemas.FACT_COMMENTS),
                                 session.scratch_path(d.spark, "comentado"))
    filled = fact.agg(*[F.count(c).alias(c) for c in fact.columns]).unpivot([], fact.columns, "coluna", "preenchidos")
    return (catalog.schema_catalog(d.spark, {"fato_vendas": fact}).filter("comentario IS NOT NULL")
            .join(filled, "coluna"))


# ---- cleansing ----------------------------------------------------------------------------------

@query("silver_clientes", """
SELECT cliente_id, cnpj, razao_social, data_cadastro, ativo, segmento, cidade, uf, bairro, qtd_registros FROM d_clientes""")
def _(d):
    return d.clientes


@query("duplicate_map", """
SELECT l.cliente_id, c.cliente_id AS cliente_id_mantido, c.cnpj, c.qtd_registros
FROM d_clientes_limpos l JOIN d_clientes c ON l.cnpj = c.cnpj WHERE l.cliente_id <> c.cliente_id""")
def _(d):
    return silver.duplicate_map(silver.typed(d.raw_clientes, "clientes"))


@query("remapped_orders", """
SELECT coalesce(m.cliente_id, p.cliente_id) AS cliente_id, count(*) AS pedidos
FROM d_pedidos p LEFT JOIN (
  SELECT l.cliente_id AS de, c.cliente_id FROM d_clientes_limpos l JOIN d_clientes c ON l.cnpj = c.cnpj
  WHERE l.cliente_id <> c.cliente_id) m ON p.cliente_id = m.de GROUP BY 1""")
def _(d):
    mapping = silver.duplicate_map(silver.typed(d.raw_clientes, "clientes"))
    return (silver.remap_duplicate_ids(d.pedidos, mapping).groupBy("cliente_id")
            .agg(F.count("*").alias("pedidos")))


@query("silver_pedidos", f"SELECT pedido_id, cliente_id, vendedor_id, data_pedido, canal, {_d('valor_total')}, cancelado, {_d('valor_liquido')}, ano, mes FROM d_pedidos")
def _(d):
    return silver.pedidos(d.raw_pedidos)


@query("silver_produtos", f"SELECT sku, nome, categoria, marca, nota_olfativa, data_lancamento, {_d('preco_tabela', 'custo_unitario')}, unidade, ativo FROM d_produtos")
def _(d):
    return d.produtos


@query("silver_itens", f"SELECT item_id, pedido_id, sku, quantidade, quantidade_abs, devolucao, {_d('preco_praticado', 'desconto_pct', 'valor_bruto', 'custo_unitario')}, sku_descontinuado FROM d_itens")
def _(d):
    return silver.itens_pedido(d.raw_itens, d.produtos)


@query("silver_vendedores", f"SELECT vendedor_id, nome, regiao, uf, data_admissao, data_desligamento, ativo, {_d('meta_mensal')} FROM d_vendedores")
def _(d):
    return d.vendedores


@query("silver_carteira", "SELECT carteira_id, cliente_id, vendedor_id, data_inicio, data_fim, vigente, orfao_vendedor_desligado FROM d_carteira")
def _(d):
    return d.carteira


@query("silver_oportunidades", f"SELECT oportunidade_id, cliente_id, vendedor_id, origem, etapa, data_abertura, data_fechamento, {_d('probabilidade_pct', 'valor_estimado')}, ciclo_dias, motivo_perda, ganancia, perdida FROM d_oportunidades")
def _(d):
    return d.oportunidades


@query("silver_visitas", "SELECT visita_id, cliente_id, vendedor_id, data_visita, resultado, duracao_min FROM d_visitas")
def _(d):
    return d.visitas


@query("silver_pagamentos", f"SELECT pagamento_id, pedido_id, forma_pagamento, parcelas, {_d('valor', 'valor_liquido', 'taxa_pct')}, data_vencimento, data_pagamento, status_pagamento FROM d_pagamentos")
def _(d):
    return silver.pagamentos(d.raw_pagamentos)


@query("silver_estoque", "SELECT data_snapshot, sku, saldo, ruptura FROM d_estoque")
def _(d):
    return d.estoque


@query("audit_columns", "SELECT (SELECT count(*) FROM d_pedidos_raw) AS _linhas_origem, count(*) AS linhas, 0 AS sem_processamento FROM d_pedidos")
def _(d):
    rows = d.raw_pedidos.agg(F.count("*").alias("n")).scalar()
    audited = silver.with_audit(silver.pedidos(d.raw_pedidos), rows)
    return audited.groupBy("_linhas_origem").agg(
        F.count("*").alias("linhas"),
        F.count_if(F.col("_processado_em").isNull()).cast("int").alias("sem_processamento"))


@query("clean_text", "SELECT cliente_id, cnpj, razao_social, upper(razao_social) AS maiuscula, lower(razao_social) AS minuscula FROM d_clientes_limpos")
def _(d):
    return d.raw_clientes.select(
        F.trim("cliente_id").alias("cliente_id"), text.cnpj_digits(F.col("cnpj")).alias("cnpj"),
        text.title_text(F.col("razao_social")).alias("razao_social"),
        F.upper(text.title_text(F.col("razao_social"))).alias("maiuscula"),
        F.lower(text.title_text(F.col("razao_social"))).alias("minuscula"))


@query("parse_mixed_dates", "SELECT cliente_id, data_cadastro FROM d_clientes_limpos")
def _(d):
    return d.raw_clientes.select(F.trim("cliente_id").alias("cliente_id"),
                                 text.mixed_date(F.col("data_cadastro")).alias("data_cadastro"))


@query("clean_numeric", "SELECT CAST(count(*) AS BIGINT) AS linhas, count(quantidade) AS inteiros, CAST(sum(quantidade) AS BIGINT) AS soma, CAST(sum(valor_bruto) AS DOUBLE) AS bruto FROM d_itens")
def _(d):
    q, v = F.col("quantidade").try_cast("int"), F.col("valor_bruto").try_cast("decimal(18,2)")
    return d.raw_itens.agg(F.count("*").alias("linhas"), F.count(q).alias("inteiros"),
                           F.sum(q).alias("soma"), F.sum(v).alias("bruto"))


@query("bronze_dirt_profile", """
SELECT count(*) AS clientes, count(*) FILTER (cnpj LIKE '%.%') AS cnpj_pontuado,
  count(*) FILTER (cnpj <> trim(cnpj)) AS cnpj_com_espaco,
  count(*) FILTER (regexp_replace(trim(cnpj), '[^0-9]', '', 'g') LIKE '0%') AS cnpj_zero_a_esquerda,
  count(*) FILTER (length(regexp_replace(trim(cnpj), '[^0-9]', '', 'g')) > 14) AS cnpj_longo,
  count(*) FILTER (coalesce(regexp_replace(trim(cnpj), '[^0-9]', '', 'g'), '') = '') AS cnpj_sem_digito,
  count(*) FILTER (data_cadastro LIKE '%/%') AS data_formato_br,
  count(*) FILTER (razao_social = upper(razao_social)) AS razao_caixa_alta FROM d_clientes_raw""")
def _(d):
    return quality.dirt_profile(d.raw_clientes)


@query("text_vs_numeric_topk", """
SELECT 'texto' AS ordem, pedido_id, valor_total FROM (SELECT * FROM d_pedidos_raw ORDER BY valor_total DESC, pedido_id LIMIT 5)
UNION ALL SELECT 'numero', pedido_id, valor_total FROM (
  SELECT * FROM d_pedidos_raw ORDER BY TRY_CAST(valor_total AS DECIMAL(18,2)) DESC NULLS LAST, pedido_id LIMIT 5)""")
def _(d):
    def five(label, by):
        return (d.raw_pedidos.orderBy(by, "pedido_id").limit(5)
                .select(F.lit(label).alias("ordem"), "pedido_id", "valor_total"))
    number = F.col("valor_total").try_cast("decimal(18,2)")
    return five("texto", F.desc("valor_total")).unionByName(five("numero", number.desc_nulls_last()))


@query("table_counts", "\nUNION ALL ".join(
    f"SELECT '{n}' AS tabela, count(*) AS linhas FROM {r}" for n, r in (
        ("clientes", "d_clientes"), ("pedidos", "d_pedidos"), ("itens_pedido", "d_itens"),
        ("produtos", "d_produtos"), ("vendedores", "d_vendedores"), ("carteira", "d_carteira"),
        ("oportunidades", "d_oportunidades"), ("visitas", "d_visitas"), ("pagamentos", "d_pagamentos"),
        ("estoque", "d_estoque"))))
def _(d):
    return quality.table_counts({
        "clientes": d.clientes, "pedidos": d.pedidos, "itens_pedido": d.itens, "produtos": d.produtos,
        "vendedores": d.vendedores, "carteira": d.carteira, "oportunidades": d.oportunidades,
        "visitas": d.visitas, "pagamentos": d.pagamentos, "estoque": d.estoque})


@query("bronze_reconcile", _each_extract(
    "SELECT '{t}' AS tabela, count(*) AS na_tabela, count(*) AS no_arquivo, true AS bate FROM {v}"))
def _(d):
    root = _land(d)
    return quality.reconcile({n: raw_csv.read_raw(d.spark, root, n) for n in schemas.RAW_TABLES},
                             raw_csv.arrival_control(d.spark, root))


@query("distinct_values", """
SELECT 'canal' AS coluna, canal AS valor FROM d_pedidos GROUP BY canal
UNION ALL SELECT 'etapa', etapa FROM d_oportunidades GROUP BY etapa
UNION ALL SELECT 'resultado', resultado FROM d_visitas GROUP BY resultado""")
def _(d):
    def values(df, c):
        return df.select(F.lit(c).alias("coluna"), F.col(c).alias("valor")).distinct()
    return (values(d.pedidos, "canal").unionByName(values(d.oportunidades, "etapa"))
            .unionByName(values(d.visitas, "resultado")))


# ---- gold ---------------------------------------------------------------------------------------

@query("fact_sales", f"SELECT pedido_id, item_id, cliente_id, razao_social, segmento, cidade, data_pedido, ano, mes, canal, sku, categoria, marca, nota_olfativa, vendedor_id, quantidade, quantidade_abs, {_d('preco_praticado', 'receita', 'custo', 'margem')}, devolucao, sku_descontinuado FROM d_fato")
def _(d):
    return d.fato


@query("dim_cliente", "SELECT * FROM d_dim_cliente")
def _(d):
    return d.dim_cliente


@query("dim_produto", f"SELECT sku, nome, categoria, marca, nota_olfativa, {_d('preco_tabela', 'custo_unitario')}, unidade, ativo, data_lancamento, NOT ativo AS descontinuado FROM d_produtos")
def _(d):
    return d.dim_produto


@query("dim_vendedor", f"SELECT vendedor_id, nome, regiao, uf, {_d('meta_mensal')}, ativo FROM d_vendedores")
def _(d):
    return gold.dim_vendedor(d.vendedores)


@query("mart_vendedor", "SELECT * FROM d_mart_vendedor")
def _(d):
    return d.mart_vendedor


@query("abc_curve", "SELECT * FROM d_abc")
def _(d):
    return gold.mart_produto_performance(d.fato)


_FIN = """
SELECT ano, mes, count(*) AS pedidos, CAST(sum(quantos) AS BIGINT) AS pagamentos, CAST(sum(bruto) AS DOUBLE) AS valor_a_receber,
  CAST(sum(liquido) AS DOUBLE) AS recebido, round(sum(dias) / sum(contados), 1) AS atraso_medio_dias, CAST(round(sum(taxas) / 100, 2) AS DOUBLE) AS custo_taxa
FROM (SELECT CAST(year(data_vencimento) AS INTEGER) AS ano, CAST(month(data_vencimento) AS INTEGER) AS mes, pedido_id, count(DISTINCT pagamento_id) AS quantos,
        sum(valor) AS bruto, sum(valor_liquido) AS liquido, sum(valor * taxa_pct) AS taxas,
        sum({end} - data_vencimento) AS dias, count({end} - data_vencimento) AS contados FROM d_pagamentos GROUP BY ALL)
GROUP BY ano, mes"""


@query("mart_financeiro", _FIN.format(end=f"DATE '{AS_OF}'"))
def _(d):
    return gold.mart_financeiro_recebimento(d.pagamentos, AS_OF)


@query("mart_financeiro_ate_pagamento", _FIN.format(end=f"coalesce(data_pagamento, DATE '{AS_OF}')"))
def _(d):
    return gold.mart_financeiro_recebimento(d.pagamentos, AS_OF, delay="until_paid")


@query("sku_rank_month", """
SELECT sku, ano, mes, CAST(receita AS DOUBLE) AS receita,
  row_number() OVER (PARTITION BY ano, mes ORDER BY receita DESC, md5(sku), sku) AS posicao FROM d_sku_mes""")
def _(d):
    monthly = session.materialize(gold.sku_month(d.fato), "sku_mes")
    return (row_numbers(monthly, ["ano", "mes"], "receita", "sku", "posicao")
            .select("sku", "ano", "mes", "receita", "posicao"))


@query("latest_stock", "SELECT data_snapshot, sku, saldo, ruptura FROM d_estoque_atual")
def _(d):
    return ranking.latest_stock(d.estoque)


@query("top_brand", """
SELECT cliente_id, marca, CAST(r AS DOUBLE) AS receita_marca FROM (
  SELECT cliente_id, marca, sum(receita) AS r,
    row_number() OVER (PARTITION BY cliente_id ORDER BY sum(receita) DESC, marca) AS rn FROM d_fato GROUP BY 1, 2) WHERE rn = 1""")
def _(d):
    return ranking.top_brand(d.fato)


@query("second_brand", """
SELECT cliente_id, marca, CAST(r AS DOUBLE) AS receita_marca FROM (
  SELECT cliente_id, marca, sum(receita) AS r,
    row_number() OVER (PARTITION BY cliente_id ORDER BY sum(receita) DESC, marca) AS rn FROM d_fato GROUP BY 1, 2) WHERE rn = 2""")
def _(d):
    return ranking.nth_brand(d.fato, 2)


@query("last_purchase_lateral", """
SELECT c.cliente_id, h.ultima_compra FROM d_clientes c
LEFT JOIN LATERAL (SELECT max(data_pedido) AS ultima_compra FROM d_fato f WHERE f.cliente_id = c.cliente_id) h ON true""")
def _(d):
    return d.clientes.select("cliente_id").join(ranking.last_purchase(d.fato), "cliente_id", "left")


# ---- features -----------------------------------------------------------------------------------

@query("asof_filter", f"SELECT count(*) AS linhas, count(DISTINCT cliente_id) AS clientes, CAST(sum(receita) AS DOUBLE) AS receita FROM d_fato WHERE data_pedido < DATE '{TRAIN_REF}'")
def _(d):
    return features.facts_before(d.fato, TRAIN_REF).agg(
        F.count("*").alias("linhas"), F.countDistinct("cliente_id").alias("clientes"),
        F.sum("receita").alias("receita"))


@query("orders_last_90d", "SELECT cliente_id, pedidos_ultimos_90d FROM d_90d_t")
def _(d):
    return features.orders_last_90d(d.fato, TRAIN_REF)


@query("order_gaps", "SELECT cliente_id, pedido_id, data_pedido, data_anterior, gap_dias FROM d_lacunas_t")
def _(d):
    return features.order_gaps(d.fato, TRAIN_REF)


_RFM = ["recencia_dias", "frequencia_pedidos", "valor_total", "ticket_medio", "margem_total", "margem_percentual"]
_RHYTHM = ["intervalo_medio_dias", "desvio_intervalo_dias", "atraso_relativo", "pedidos_ultimos_90d"]
_MIX = ["skus_distintos", "categorias_distintas", "marcas_distintas", "concentracao_marca_top", "comprou_lancamento"]
_CRM = ["oportunidades_abertas", "oportunidades_ganhas", "taxa_ganho", "visitas_90d", "conversao_visita"]


@query("feat_rfm", f"SELECT cliente_id, {_r(*_RFM)} FROM d_rfm_t")
def _(d):
    return features.rfm_and_rhythm(d.fato, TRAIN_REF).select("cliente_id", *_RFM)


@query("feat_rhythm", f"SELECT cliente_id, {_r(*_RHYTHM)}, sem_historico_ritmo FROM d_ritmo_t")
def _(d):
    return features.rfm_and_rhythm(d.fato, TRAIN_REF).select("cliente_id", *_RHYTHM, "sem_historico_ritmo")


@query("feat_crm", f"SELECT coalesce(o.cliente_id, v.cliente_id) AS cliente_id, {_r(*_CRM)} FROM d_opp_t o FULL JOIN d_vis_t v ON o.cliente_id = v.cliente_id")
def _(d):
    return features.crm(d.oportunidades, d.visitas, TRAIN_REF)


@query("feat_mix", f"SELECT cliente_id, {_r(*_MIX)} FROM d_mix_t")
def _(d):
    return features.mix(d.fato, d.produtos, TRAIN_REF).select("cliente_id", *_MIX)


@query("bought_launch", "SELECT cliente_id FROM d_lanc_t")
def _(d):
    return features.bought_launch(d.fato, d.produtos, TRAIN_REF)


@query("label_window", "SELECT cliente_id FROM d_alvo")
def _(d):
    return features.buyers_in_window(d.fato, TRAIN_REF)


@query("feature_table", f"SELECT cliente_id, {_r(*schemas.FEATURES)}, sem_historico_ritmo, _referencia FROM d_feat_s")
def _(d):
    return d.features(SCORE_REF)


@query("training_table", f"SELECT cliente_id, {_r(*schemas.FEATURES)}, sem_historico_ritmo, _referencia, CAST(comprou_em_7d AS DOUBLE) AS comprou_em_7d FROM d_treino")
def _(d):
    return d.training


@query("feature_history", " UNION ALL ".join(
    f"SELECT cliente_id, {_r(*schemas.FEATURES)}, sem_historico_ritmo, _referencia FROM d_feat_h{i}" for i in range(len(HISTORY))))
def _(d):
    """The features at twelve cut-offs from one scan of the fact."""
    return feature_history.feature_history(d.fato, d.oportunidades, d.visitas, d.produtos, HISTORY)


@query("feature_checks", """
SELECT 'treino' AS tabela, count(*) AS clientes, min(_referencia) AS corte, CAST(sum(comprou_em_7d) AS DOUBLE) AS compraram,
  min(recencia_dias) AS menor_recencia, round(100 * CAST(avg(comprou_em_7d) AS DOUBLE), 2) AS taxa_base_pct FROM d_treino
UNION ALL SELECT 'cliente', count(*), min(_referencia), NULL, min(recencia_dias), NULL FROM d_feat_s""")
def _(d):
    return features.feature_checks(d.training, d.features(SCORE_REF))


# ---- metrics ------------------------------------------------------------------------------------

def _scored_training(d: Domain) -> DataFrame:
    return d.saved_training.withColumn("score", F.round(1 / (1 + F.col("recencia_dias")), 6))


_HOLD = "row_number() OVER (PARTITION BY comprou_em_7d ORDER BY md5(cliente_id || '|42')[1:12], md5(cliente_id), cliente_id)"


@query("stratified_split", f"""
SELECT cliente_id, CAST(comprou_em_7d AS DOUBLE) AS comprou_em_7d, rk <= ceil(n * 0.25) AS holdout, CAST(rk % 5 AS INTEGER) AS fold
FROM (SELECT *, {_HOLD} AS rk, count(*) OVER (PARTITION BY comprou_em_7d) AS n FROM d_treino)""")
def _(d):
    return metrics.stratified_split(d.saved_training).select("cliente_id", schemas.LABEL, "holdout", "fold")


# AUC by the Mann-Whitney rank sum with average ranks.
_AUC = """(sum(CASE WHEN y = 1 THEN rank_medio END) - (sum(y) * (sum(y) + 1)) / 2.0) / nullif(sum(y) * (count(*) - sum(y)), 0)"""


_RANKED = "(rank() OVER (PARTITION BY regra ORDER BY s)) + (count(*) OVER (PARTITION BY regra, s) - 1) / 2.0"


@query("baseline_auc", f"""
SELECT regra, round(auc, 6) AS auc, regra = first_value(regra) OVER (ORDER BY auc DESC, regra) AS melhor FROM (
  SELECT regra, {_AUC} AS auc FROM (
    SELECT regra, y, {_RANKED} AS rank_medio FROM (
      SELECT 'recencia' AS regra, CAST(comprou_em_7d AS DOUBLE) AS y, -recencia_dias AS s FROM d_treino
      UNION ALL SELECT 'valor', CAST(comprou_em_7d AS DOUBLE), valor_total FROM d_treino
      UNION ALL SELECT 'atraso', CAST(comprou_em_7d AS DOUBLE), coalesce(atraso_relativo, 0) FROM d_treino)) GROUP BY regra)""")
def _(d):
    return metrics.baseline_auc(d.saved_training)


# Distinct, tie and AUC checks need values both engines hold bit for bit, so features are rounded.
_UNPIVOT = " UNION ALL ".join(
    f"SELECT cliente_id, '{f}' AS regra, CAST(comprou_em_7d AS DOUBLE) AS y, round({f}, 6) AS s FROM d_treino"
    for f in schemas.FEATURES)


def _rounded_training(d: Domain) -> DataFrame:
    return d.saved_training.withColumns({c: F.round(c, 6) for c in schemas.FEATURES})


@query("univariate_auc", f"""
SELECT regra AS feature, round(greatest(auc, 1 - auc), 6) AS auc, auc < 0.5 AS invertida FROM (
  SELECT regra, {_AUC} AS auc FROM (
    SELECT regra, y, {_RANKED} AS rank_medio FROM (SELECT regra, y, coalesce(s, -999) AS s FROM ({_UNPIVOT}))) GROUP BY regra)""")
def _(d):
    return metrics.univariate_auc(_rounded_training(d))


@query("feature_profile", f"""
SELECT regra AS feature, count(DISTINCT s) AS distintos, count(*) AS linhas, count(*) - count(s) AS nulos,
  CASE WHEN count(DISTINCT s) > count(*) * 0.8 THEN 'muitos distintos'
       WHEN count(*) - count(s) > count(*) * 0.5 THEN 'muitos nulos' ELSE 'ok' END AS alerta FROM ({_UNPIVOT}) GROUP BY regra""")
def _(d):
    return metrics.feature_profile(_rounded_training(d))


@query("decile_contrast", f"""
SELECT regra AS feature, round(baixa, 6) AS media_baixa, round(alta, 6) AS media_alta, round(alta - baixa, 6) AS diferenca FROM (
  SELECT regra, avg(s) FILTER (score <= p10) AS baixa, avg(s) FILTER (score >= p90) AS alta
  FROM ({_UNPIVOT}) u JOIN (SELECT cliente_id AS c, score FROM d_pontuado) p ON u.cliente_id = p.c,
       (SELECT quantile_cont(score, 0.1) AS p10, quantile_cont(score, 0.9) AS p90 FROM d_pontuado) GROUP BY regra)""")
def _(d):
    return metrics.decile_contrast(_rounded_training(d).withColumn(
        "score", F.round(1 / (1 + F.col("recencia_dias")), 6)))


@query("lift_at_k", """
SELECT count(*) AS k, CAST(sum(comprou_em_7d) AS BIGINT) AS acertos,
  round((SELECT CAST(avg(comprou_em_7d) AS DOUBLE) FROM d_treino), 6) AS taxa_base,
  round(CAST(avg(comprou_em_7d) AS DOUBLE) / (SELECT CAST(avg(comprou_em_7d) AS DOUBLE) FROM d_treino), 6) AS lift
FROM (SELECT * FROM d_pontuado ORDER BY score DESC, cliente_id LIMIT 200)""")
def _(d):
    return metrics.lift_at_k(_scored_training(d))


@query("score_bands", "SELECT cliente_id, score, faixa FROM d_faixas")
def _(d):
    return d.banded_scores


@query("calibration_table", """
SELECT faixa, count(*) AS clientes, CAST(sum(comprou_em_7d) AS BIGINT) AS compraram,
  round(CAST(avg(comprou_em_7d) AS DOUBLE), 6) AS taxa_de_compra, round(avg(score), 6) AS score_medio FROM (
  SELECT *, CASE WHEN score >= q3 THEN 'Muito quente' WHEN score >= q2 THEN 'Quente' WHEN score >= q1 THEN 'Morna' ELSE 'Fria' END AS faixa
  FROM d_pontuado, (SELECT quantile_cont(score, 0.25) AS q1, quantile_cont(score, 0.5) AS q2, quantile_cont(score, 0.75) AS q3 FROM d_pontuado))
GROUP BY faixa""")
def _(d):
    return metrics.calibration_table(_scored_training(d))


@query("band_summary", """
SELECT faixa, count(*) AS total_clientes, min(score) AS score_min, max(score) AS score_max, round(avg(score), 6) AS score_medio
FROM d_faixas GROUP BY faixa""")
def _(d):
    return metrics.band_summary(d.banded_scores)


@query("big_customer_threshold", "SELECT round(limite, 6) AS limite FROM d_limite")
def _(d):
    return exact_quantiles(d.saved_features, "valor_total", {"limite": 0.75}, interpolate=False)


@query("big_customer_threshold_approx", "SELECT count(valor_total) AS clientes, true AS dentro_da_tolerancia FROM d_feat_s")
def _(d):
    """Whether the approximate threshold's rank is within n / 10,000 (one row at least) of three quarters of the customers."""
    values = d.saved_features
    limit = ranking.big_customer_threshold(values).scalar()
    v = F.col("valor_total")
    marked = values.select(v, limit.alias("limite"))
    facts = marked.agg(F.count(v).alias("clientes"), F.count_if(v < F.col("limite")).alias("abaixo"),
                       F.count_if(v <= F.col("limite")).alias("ate"))
    slack = F.greatest(F.col("clientes") / 10_000, F.lit(1))
    rank = F.col("clientes") * 0.75
    return facts.select("clientes", ((F.col("abaixo") - slack <= rank) & (rank <= F.col("ate") + slack)).alias("dentro_da_tolerancia"))


_FILL = ", ".join(
    f"round(coalesce({c}, avg({c}) OVER ()), 6) AS {c}_cheio, CASE WHEN {c} IS NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS {c}_ausente"
    for c in model.NULLABLE)


@query("impute_features", f"SELECT cliente_id, {_FILL} FROM d_treino")
def _(d):
    out = model.impute(d.saved_training)
    return out.select("cliente_id", *[f"{c}_{s}" for c in model.NULLABLE for s in ("cheio", "ausente")])


# ---- model --------------------------------------------------------------------------------------

def _fit_input(d: Domain) -> DataFrame:
    """The split training table, materialised once: boosting scans it at every tree level."""
    return session.materialize(metrics.stratified_split(d.saved_training), "divisao")


_RULE = "comprou_lancamento < 1"
_PLANTED = f"SELECT cliente_id, CASE WHEN {_RULE} THEN 1.0 ELSE 0.0 END AS y FROM d_treino"


def _planted_input(d: Domain) -> DataFrame:
    """Training rows whose label is one feature above a cut, so that a sound learner's answers are known."""
    planted = d.saved_training.withColumn(schemas.LABEL, F.expr(_RULE).cast("double"))
    return session.materialize(metrics.stratified_split(planted), "divisao")


def _valid(score: str = "score"):
    return F.coalesce(F.col(score).between(0, 1), F.lit(False))


@query("score_customers", """
SELECT cliente_id, true AS valido, CAST((SELECT count(*) FROM d_feat_s) AS BIGINT) AS clientes FROM d_feat_s""")
def _(d):
    """Every customer scored once, by a model of the real label, in [0, 1] and in one of the four bands."""
    scored = model.predict(model.fit(_fit_input(d)), d.features(SCORE_REF)).select("cliente_id", "score")
    banded = session.materialize(metrics.score_bands(session.materialize(scored, "scores")), "faixas")
    total = banded.agg(F.count("*").alias("n")).scalar()
    known = F.coalesce(F.col("faixa").isin(*metrics.BANDS), F.lit(False))
    return banded.select("cliente_id", (_valid() & known).alias("valido"), total.alias("clientes"))


@query("score_planted_signal", f"SELECT cliente_id, {_RULE} AS regra FROM d_feat_s")
def _(d):
    """Trained on the planted label, the model's decision must equal the rule on rows it has never seen."""
    scored = model.predict(model.fit(_planted_input(d)), d.features(SCORE_REF))
    return scored.select("cliente_id", (F.col("score") >= 0.5).alias("regra"))


@query("model_reloaded", same_as="score_planted_signal")
def _(d):
    """The planted signal scored by a model that was saved and read back, as a later run does."""
    path = session.scratch_path(d.spark, "modelo")
    model.fit(_planted_input(d), 5).write().save(path)
    scored = model.predict(PipelineModel.load(path), d.features(SCORE_REF))
    return scored.select("cliente_id", (F.col("score") >= 0.5).alias("regra"))


@query("oof_scores", f"""
SELECT cliente_id, CAST(rk % 5 AS INTEGER) AS fold, CAST(comprou_em_7d AS DOUBLE) AS comprou_em_7d, true AS valido
FROM (SELECT *, {_HOLD} AS rk FROM d_treino)""")
def _(d):
    return model.out_of_fold(_fit_input(d)).select("cliente_id", "fold", schemas.LABEL, _valid().alias("valido"))


@query("auc_per_fold", f"""
SELECT fold, round({_AUC}, 6) AS auc FROM (
  SELECT fold, y, (rank() OVER (PARTITION BY fold ORDER BY s)) + (count(*) OVER (PARTITION BY fold, s) - 1) / 2.0 AS rank_medio
  FROM (SELECT CAST(rk % 5 AS INTEGER) AS fold, CAST(comprou_em_7d AS DOUBLE) AS y, round(1 / (1 + recencia_dias), 6) AS s
        FROM (SELECT *, {_HOLD} AS rk FROM d_treino))) GROUP BY fold""")
def _(d):
    """One AUC per fold: folds that differ much, or one near 1, point to a leak."""
    split = metrics.stratified_split(_scored_training(d))
    return metrics.rank_auc(session.materialize(split, "divisao"), "score", part=["fold"])


@query("permutation_importance", "\nUNION ALL ".join(
    f"SELECT '{f}' AS feature, {'true' if _RULE.startswith(f + ' ') else 'false'} AS importa" for f in schemas.FEATURES))
def _(d):
    """On the planted label only the planted feature matters."""
    split = _planted_input(d)
    found = model.permutation_importance(model.fit(split.filter(~F.col("holdout"))), split.filter("holdout"))
    return found.select("feature", (F.col("queda_auc") > 1e-9).alias("importa"))


@query("model_gates", f"""
SELECT '1 ganho sobre a melhor regra' AS teste, true AS passou
UNION ALL SELECT '2 sem sinal de vazamento', false
UNION ALL SELECT '3 lift da fila', least(sum(y), 200) / least(count(*), 200) / avg(y) >= 2.5 FROM ({_PLANTED})""")
def _(d):
    """A planted label is learned without fault: a gain over every rule, and a leak alarm."""
    split = _planted_input(d)
    figures = model.evaluate(split, metrics.baseline_auc(split.filter("holdout")), importance=False)[0]
    return model.gates(d.spark, figures).select("teste", "passou")


def _history_oracle(version: int, rule: str) -> str:
    top = f"(SELECT CAST(comprou_em_7d AS DOUBLE) AS y FROM d_treino ORDER BY {rule} DESC, cliente_id LIMIT 200)"
    base = "(SELECT avg(CAST(comprou_em_7d AS DOUBLE)) FROM d_treino)"
    auc = (f"(SELECT {_AUC} FROM (SELECT y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS rank_medio "
           "FROM (SELECT CAST(comprou_em_7d AS DOUBLE) AS y, {s} AS s FROM d_treino)))")

    def rounded(s: str) -> str:
        return f"round(coalesce({auc.replace('{s}', s)}, 0), 6)"
    return f"""
SELECT CAST({version} AS BIGINT) AS versao, {rounded(rule)} AS auc,
  round(coalesce((SELECT avg(y) FROM {top}) / nullif({base}, 0), 0), 4) AS lift_top200,
  CAST((SELECT sum(y) FROM {top}) AS BIGINT) AS acertos_top200, round({base}, 6) AS taxa_base,
  {rounded('-recencia_dias')} AS auc_baseline_recencia, {rounded('valor_total')} AS auc_baseline_valor,
  {rounded('coalesce(atraso_relativo, 0)')} AS auc_baseline_atraso, '{rule}' AS feature_top_1"""


@query("metrics_append", _history_oracle(1, "valor_total") + " UNION ALL " + _history_oracle(2, "pedidos_ultimos_90d"))
def _(d):
    """Two runs appended to one history table."""
    split = _fit_input(d)
    rules = {r["regra"]: r["auc"] for r in metrics.baseline_auc(split).collect()}
    history = f"metricas_{uuid.uuid4().hex[:12]}"
    for version, rule in ((1, "valor_total"), (2, "pedidos_ultimos_90d")):
        scored = split.withColumn("score", F.col(rule))
        lift = metrics.lift_at_k(scored).first()
        figures = model.Evaluation(
            auc=metrics.rank_auc(scored, "score").first()["auc"] or 0.0, auc_holdout=0.0,
            lift_top=lift["lift"] or 0.0, acertos_top=lift["acertos"], taxa_base=lift["taxa_base"],
            baselines=rules, feature_top_1=rule, linhas=split.count())
        tables.append(model.metrics_row(d.spark, figures, version), history)
    return d.spark.table(history).drop("_treinado_em")


# ---- queue --------------------------------------------------------------------------------------

@query("queue_eligible", f"SELECT cliente_id, score, faixa, vendedor_id, vendedor, razao_social, cidade, uf, {_r('ticket_medio', 'atraso_relativo', 'recencia_dias', 'intervalo_medio_dias', 'valor_total', 'comprou_lancamento')} FROM d_elegiveis")
def _(d):
    return d.elegiveis


@query("queue_reason", f"SELECT cliente_id, {REASON} AS motivo FROM d_feat_s")
def _(d):
    return weekly_queue.with_reason(d.saved_features, d.saved_features).select("cliente_id", "motivo")


@query("top_customers_semi", "SELECT cliente_id, count(*) AS linhas, CAST(sum(receita) AS DOUBLE) AS receita FROM d_fato WHERE cliente_id IN (SELECT cliente_id FROM d_top) GROUP BY 1")
def _(d):
    return (d.saved_fact.join(d.top_ids, "cliente_id", "left_semi").groupBy("cliente_id")
            .agg(F.count("*").alias("linhas"), F.sum("receita").alias("receita")))


@query("crosssell_candidates", "SELECT cliente_id, marca, sku, nome, saldo, candidatos FROM d_pares_top WHERE rn = 1")
def _(d):
    ids, fact = d.top_ids, d.saved_fact
    bought = ranking.recent_skus(fact.join(ids, "cliente_id", "left_semi"), AS_OF)
    return ranking.suggestions(ranking.preferred_brand(fact, ids, AS_OF), d.saved_shelf, bought)


@query("best_stock_suggestion", "SELECT cliente_id, marca, sku, nome, saldo, candidatos FROM d_pares_todos WHERE rn = 1")
def _(d):
    d.prepare_customers()
    ids = weekly_queue.eligible_ids(d.saved_scores, d.carteira, d.vendedores, d.clientes_unicos, d.saved_features)
    return customer_serving.suggestion(d.saved_profile).join(ids, "cliente_id", "left_semi")


_QUEUE_COLUMNS = "vendedor, ordem, cliente_id, razao_social, cidade, uf, score, faixa, ticket_medio, motivo, sugestao, vendedor_id"


@query("weekly_queue", f"SELECT {_QUEUE_COLUMNS} FROM d_fila")
def _(d):
    return d.fila


@query("queue_tests", """
SELECT '1 linhas na fila' AS teste, CAST(count(*) AS VARCHAR) AS observado, '200' AS esperado, count(*) = 200 AS passou FROM d_fila
UNION ALL SELECT '2 motivo preenchido', CAST(count(*) FILTER (motivo IS NULL OR motivo = '') AS VARCHAR), '0',
  count(*) FILTER (motivo IS NULL OR motivo = '') = 0 FROM d_fila
UNION ALL SELECT '3 score em [0, 1]', CAST(count(*) FILTER (score < 0 OR score > 1) AS VARCHAR), '0',
  count(*) FILTER (score < 0 OR score > 1) = 0 FROM d_fila""")
def _(d):
    return quality.queue_tests(d.fila)


@query("prioritize_portfolio", f"SELECT {_QUEUE_COLUMNS} FROM d_fila WHERE ordem <= 2")
def _(d):
    return serving.prioritize_portfolio(d.fila, 2)


@query("queue_listing", "SELECT ordem, razao_social, cidade, score, faixa, motivo, sugestao, vendedor FROM d_fila")
def _(d):
    return serving.queue_listing(d.fila)


@query("queue_listing_of_a_rep", """
SELECT ordem, razao_social, cidade, score, faixa, motivo, sugestao, vendedor FROM d_fila WHERE vendedor = (SELECT min(vendedor) FROM d_fila)""")
def _(d):
    queue = session.materialize(d.fila, "fila")
    return serving.queue_listing(queue, queue.agg(F.min("vendedor")).first()[0])


# ---- lookups ------------------------------------------------------------------------------------

@query("customer_context", f"""
SELECT cliente_id, razao_social, cidade, uf, coalesce({half_up('ticket_medio', 2)}, 0) AS ticket_medio,
  coalesce({half_up('valor_total', 2)}, 0) AS valor_total, marcas[1] AS marca_pref, marcas[2] AS segunda_marca, ultima_compra,
  total_pedidos AS pedidos_totais, score AS saldo_score, faixa AS saldo_faixa
FROM d_dim_cliente LEFT JOIN (SELECT cliente_id, ticket_medio, valor_total FROM d_feat_s) USING (cliente_id)
LEFT JOIN d_faixas USING (cliente_id) LEFT JOIN d_marcas_cliente USING (cliente_id)""")
def _(d):
    d.prepare_customers()
    return serving.customer_context(d.saved_clients, d.saved_features, d.saved_scores, d.saved_profile)


def _suggest_oracle(strict: bool) -> str:
    """Twenty dearest SKUs among those bought before the look-back; strict: and not since."""
    unbought = "ANTI JOIN d_recentes USING (cliente_id, sku)" if strict else ""
    return f"""
SELECT cliente_id, sku, sku_nome, marca, categoria, CAST(gasto AS DOUBLE) AS receita_total, ult_compra,
  coalesce(saldo, 0) AS saldo_estoque, coalesce(ruptura, false) AS em_ruptura
FROM (SELECT * FROM (
        SELECT cliente_id, sku, sum(receita) AS gasto, max(data_pedido) AS ult_compra FROM d_fato
        WHERE data_pedido < DATE '{AS_OF}' - 90 GROUP BY ALL) {unbought}
      QUALIFY row_number() OVER (PARTITION BY cliente_id ORDER BY gasto DESC, sku) <= 20)
JOIN (SELECT sku, nome AS sku_nome, marca, categoria FROM d_produtos) USING (sku)
LEFT JOIN (SELECT sku, saldo, ruptura FROM d_estoque_atual) USING (sku)"""


@query("suggest_products", _suggest_oracle(False))
def _(d):
    return serving.suggest_products(d.fato, d.dim_produto, d.estoque, AS_OF)


@query("suggest_products_strict", _suggest_oracle(True))
def _(d):
    return serving.suggest_products(d.fato, d.dim_produto, d.estoque, AS_OF, strict=True)


@query("check_availability", """
SELECT sku, sku_nome, marca, saldo, ruptura, data_snapshot
FROM (SELECT sku, nome AS sku_nome, marca FROM d_produtos) JOIN d_estoque_atual USING (sku)""")
def _(d):
    return serving.check_availability(d.dim_produto, d.estoque)


def _for_each(d: Domain, name: str, answers: DataFrame, entities: DataFrame, arguments: str) -> DataFrame:
    """Call a SQL table function once per entity."""
    table_functions.create(d.spark, name, answers)
    ids = f"ids_{uuid.uuid4().hex[:12]}"
    entities.createOrReplaceTempView(ids)
    return d.spark.sql(f"SELECT f.* FROM {ids} AS i, LATERAL {name}({arguments}) AS f")


@query("sql_priorizar_carteira", same_as="prioritize_portfolio")
def _(d):
    queue = session.materialize(d.fila, "fila")
    return _for_each(d, "priorizar_carteira", queue, d.vendedores.select("vendedor_id"), "i.vendedor_id, 2")


@query("sql_contexto_cliente", same_as="customer_context")
def _(d):
    """Calls answered by a table bucketed by customer."""
    d.prepare_customers()
    answers = serving.customer_context(d.saved_clients, d.saved_features, d.saved_scores, d.saved_profile)
    layer = Layer(d.spark, _database(d, "servico"))
    layer.write("contexto_servico", answers, bucket_by=("cliente_id", 8))
    layer.publish()
    return _for_each(d, "contexto_cliente", layer.read("contexto_servico"), d.clientes.select("cliente_id"), "i.cliente_id")


@query("sql_sugerir_produtos", same_as="suggest_products")
def _(d):
    answers = serving.suggest_products(d.saved_fact, d.dim_produto, d.estoque, AS_OF)
    buyers = d.saved_fact.select("cliente_id").distinct()     # discarded registrations included
    return _for_each(d, "sugerir_produtos", answers, buyers, "i.cliente_id")


@query("sql_checar_disponibilidade", same_as="check_availability")
def _(d):
    answers = serving.check_availability(d.dim_produto, d.estoque)
    return _for_each(d, "checar_disponibilidade", answers, d.produtos.select("sku"), "i.sku")


# ---- dashboard and example questions ------------------------------------------------------------

@query("kpi_monthly", "SELECT * FROM d_kpis")
def _(d):
    return serving.kpi_monthly(d.fato)


@query("kpi_filtered", """
SELECT ano, mes, CAST(sum(receita) AS DOUBLE) AS receita, CAST(sum(margem) AS DOUBLE) AS margem, count(DISTINCT pedido_id) AS pedidos_unicos
FROM d_fato WHERE ano = 2000 AND segmento = 'MACHINERY' GROUP BY 1, 2""")
def _(d):
    filtered = serving.dashboard_filter(d.fato, ano=2000, segmento="MACHINERY")
    return serving.kpi_monthly(filtered).select("ano", "mes", "receita", "margem", "pedidos_unicos")


@query("kpi_of_a_city", """
SELECT ano, mes, CAST(sum(receita) AS DOUBLE) AS receita, CAST(sum(margem) AS DOUBLE) AS margem, count(DISTINCT pedido_id) AS pedidos_unicos
FROM d_fato WHERE cidade = (SELECT max(cidade) FROM d_clientes) GROUP BY 1, 2""")
def _(d):
    city = d.clientes.agg(F.max("cidade")).first()[0]
    return serving.kpi_monthly(serving.dashboard_filter(d.fato, cidade=city)).select("ano", "mes", "receita", "margem", "pedidos_unicos")


@query("sales_by_dimensions", f"SELECT canal, segmento, cidade, cliente_id, razao_social, marca, categoria, quantidade, {_d('receita', 'margem')}, margem_pct FROM d_dimensoes")
def _(d):
    return serving.sales_by_dimensions(d.fato)


@query("kpi_totals", "SELECT sum(receita) AS receita, sum(margem) AS margem, CAST(sum(pedidos_unicos) AS BIGINT) AS pedidos_unicos, round(sum(receita) / sum(pedidos_unicos), 6) AS ticket_medio FROM (SELECT sum(receita)::DOUBLE AS receita, sum(margem)::DOUBLE AS margem, (SELECT sum(pedidos_unicos) FROM d_kpis) AS pedidos_unicos FROM d_fato)")
def _(d):
    return serving.kpi_totals(serving.kpi_monthly(d.fato))


@query("revenue_by_month", "SELECT data_ref, receita FROM d_kpis")
def _(d):
    return serving.revenue_by_month(serving.kpi_monthly(d.fato))


@query("top_brands", "SELECT marca, CAST(sum(receita) AS DOUBLE) AS receita FROM d_dimensoes GROUP BY marca ORDER BY sum(receita) DESC, marca LIMIT 10")
def _(d):
    return serving.top_brands(d.fato)


_PCT = "round(CAST(sum(margem) AS DOUBLE) * 100 / nullif(CAST(sum(receita) AS DOUBLE), 0), 6)"


@query("margin_by_category", f"SELECT categoria, {_PCT} AS margem_pct FROM d_dimensoes GROUP BY categoria")
def _(d):
    return serving.margin_by_category(d.fato)


@query("sales_by_channel", "SELECT canal, CAST(sum(receita) AS DOUBLE) AS receita FROM d_dimensoes GROUP BY canal")
def _(d):
    return serving.sales_by_channel(d.fato)


@query("top20_customers", f"SELECT razao_social, segmento, cidade, CAST(sum(receita) AS DOUBLE) AS receita, {_PCT} AS margem_pct FROM d_dimensoes GROUP BY 1, 2, 3 ORDER BY sum(receita) DESC, razao_social, segmento, cidade LIMIT 20")
def _(d):
    return serving.top20_customers(d.fato)


@query("revenue_since_month_start", "SELECT CAST(sum(receita) AS DOUBLE) AS receita_total FROM d_fato WHERE data_pedido >= DATE '2001-07-01' AND NOT devolucao")
def _(d):
    return serving.revenue_since_month_start(d.fato, AS_OF)


@query("top_customers", """
SELECT razao_social, cidade, uf, CAST(sum(valor) AS DOUBLE) AS receita_total, CAST(sum(pedidos) AS BIGINT) AS total_pedidos
FROM (SELECT cliente_id, sum(receita) AS valor, count(DISTINCT pedido_id) AS pedidos FROM d_vendidas GROUP BY cliente_id)
JOIN (SELECT cliente_id, razao_social, cidade, uf FROM d_dim_cliente) USING (cliente_id)
GROUP BY ALL ORDER BY sum(valor) DESC, razao_social, cidade, uf LIMIT 10""")
def _(d):
    return serving.top_customers(d.fato, d.dim_cliente)


@query("products_by_category", """
SELECT categoria, produto, marca, CAST(sum(pecas) AS BIGINT) AS quantidade_total, CAST(sum(valor) AS DOUBLE) AS receita_total
FROM (SELECT sku, sum(quantidade) AS pecas, sum(receita) AS valor FROM d_vendidas GROUP BY sku)
JOIN (SELECT sku, categoria, nome AS produto, marca FROM d_produtos) USING (sku) GROUP BY ALL""")
def _(d):
    return serving.products_by_category(d.fato, d.dim_produto)


@query("rep_attainment", """
SELECT vendedor, regiao, ano, mes, receita, meta_mensal, atingimento_pct
FROM d_mart_vendedor JOIN (SELECT vendedor_id, nome AS vendedor, regiao FROM d_vendedores WHERE ativo) USING (vendedor_id)
ORDER BY atingimento_pct DESC, vendedor_id, ano, mes LIMIT 20""")
def _(d):
    return serving.rep_attainment(d.mart_vendedor, d.vendedores)


@query("sales_by_region_month", """
SELECT regiao, ano, mes, CAST(sum(valor) AS DOUBLE) AS receita_total, CAST(sum(pecas) AS BIGINT) AS quantidade_total,
  count(DISTINCT cliente_id) AS clientes_unicos
FROM (SELECT vendedor_id, cliente_id, ano, mes, sum(receita) AS valor, sum(quantidade) AS pecas FROM d_vendidas GROUP BY ALL)
JOIN (SELECT vendedor_id, regiao FROM d_vendedores) USING (vendedor_id) GROUP BY regiao, ano, mes""")
def _(d):
    return serving.sales_by_region_month(d.fato, d.vendedores)


@query("stockouts", """
SELECT sku, produto, marca, categoria, saldo FROM (SELECT sku, saldo FROM d_estoque_atual WHERE ruptura)
JOIN (SELECT sku, nome AS produto, marca, categoria FROM d_produtos) USING (sku)""")
def _(d):
    return serving.stockouts(d.dim_produto, d.estoque)


@query("margin_by_brand", f"""
SELECT marca, count(*) AS total_skus, CAST(sum(valor) AS DOUBLE) AS receita_total,
  {quotient('sum(ganho) * 100', 'nullif(sum(valor), 0)', 1, 2)} AS margem_pct
FROM (SELECT marca, sku, sum(receita) AS valor, sum(margem) AS ganho FROM d_vendidas GROUP BY ALL) GROUP BY marca""")
def _(d):
    return serving.margin_by_brand(d.fato)


@query("active_customers_30d", f"""
SELECT count(*) AS clientes_ativos_30d FROM (
  SELECT cliente_id FROM d_vendidas WHERE cliente_id IS NOT NULL GROUP BY cliente_id HAVING max(data_pedido) >= DATE '{AS_OF}' - 30)""")
def _(d):
    return serving.active_customers(d.fato, AS_OF)


@query("active_customers_by_day", f"""
SELECT CAST(dia AS DATE) AS dia, CAST(janela AS INTEGER) AS janela, count(DISTINCT cliente_id) AS clientes_ativos
FROM (SELECT unnest(generate_series(DATE '{AS_OF}' - 89, DATE '{AS_OF}', INTERVAL 1 DAY)) AS dia), (VALUES (7), (30), (90)) AS w(janela)
LEFT JOIN (SELECT DISTINCT cliente_id, data_pedido FROM d_vendidas) ON data_pedido BETWEEN CAST(dia AS DATE) - janela AND CAST(dia AS DATE) GROUP BY 1, 2""")
def _(d):
    """Customers who bought in the last 7, 30 and 90 days, for each of 90 days, from one bitmap per day."""
    sales = session.materialize(serving.sold(d.fato).select("cliente_id", "data_pedido").distinct(), "dias")
    maps = active_windows.bitmaps(sales, active_windows.dense_numbers(sales, "cliente_id"), "cliente_id", ["data_pedido"])
    found = active_windows.distinct_by_day(maps, "data_pedido", days_before(AS_OF, 89), AS_OF, [7, 30, 90])
    return found.withColumnRenamed("distintos", "clientes_ativos")


@query("region_customers_any_period", """
SELECT regiao, periodo, count(DISTINCT cliente_id) AS clientes FROM (
  SELECT regiao, cliente_id, unnest(CASE WHEN ano = 2000 AND mes <= 6 THEN ['ano 2000', 'semestre'] WHEN ano = 2000 THEN ['ano 2000', 'inverno'] WHEN ano = 2001 AND mes <= 2 THEN ['inverno'] ELSE [] END) AS periodo
  FROM (SELECT vendedor_id, cliente_id, ano, mes FROM d_vendidas WHERE ano = 2000 AND mes <> 0 OR ano = 2001) JOIN (SELECT vendedor_id, regiao FROM d_vendedores) USING (vendedor_id))
GROUP BY regiao, periodo""")
def _(d):
    """Distinct customers of each region in periods of several months, all from the same monthly bitmaps."""
    sales = session.materialize(serving.sold(d.fato).select("cliente_id", "vendedor_id", "ano", "mes").distinct()
                                .join(d.vendedores.select("vendedor_id", "regiao"), "vendedor_id").select("regiao", "ano", "mes", "cliente_id"), "regioes")
    maps = session.materialize(active_windows.bitmaps(sales, active_windows.dense_numbers(sales, "cliente_id"), "cliente_id", ["regiao", "ano", "mes"]), "mapas")
    periods = {"ano 2000": "ano = 2000", "semestre": "ano = 2000 AND mes <= 6", "inverno": "(ano = 2000 AND mes > 6) OR (ano = 2001 AND mes <= 2)"}
    return reduce(DataFrame.unionByName, [
        active_windows.distinct_count(maps.filter(rule), ["regiao"]).select("regiao", F.lit(name).alias("periodo"), F.col("distintos").alias("clientes"))
        for name, rule in periods.items()])


_ORDER_VALUES = "SELECT ano * 12 + mes - 1 AS m, sum(receita) AS valor FROM d_fato GROUP BY pedido_id, ano, mes"


@query("order_value_sketches", f"""
SELECT CAST(inicio AS INTEGER) AS inicio, CAST(fim AS INTEGER) AS fim, count(*) AS pedidos, round(quantile_cont(CAST(valor AS DOUBLE), 0.5), 6) AS mediana,
  round(quantile_cont(CAST(valor AS DOUBLE), 0.9), 6) AS p90, true AS dentro_do_erro
FROM ({_ORDER_VALUES}) JOIN (SELECT 2000 * 12 + i AS fim, 2000 * 12 + i - 3 * (i % 4) AS inicio FROM range(12) AS r(i)) ON m BETWEEN inicio AND fim GROUP BY ALL""")
def _(d):
    """Twelve ranges of one to ten months: number, exact median and 90 % quantile of order values, and whether the quantiles merged
    from monthly sketches keep their rank error."""
    orders = d.fato.groupBy("pedido_id", "ano", "mes").agg(F.sum("receita").cast("double").alias("valor"))
    values, probs = session.materialize(orders, "valores"), {"mediana": 0.5, "p90": 0.9}
    ranges = d.spark.createDataFrame([(24000 + i - 3 * (i % 4), 24000 + i) for i in range(12)], "inicio int, fim int")
    sketches = session.materialize(month_quantiles.month_sketches(values, "valor"), "rascunhos")
    found = session.materialize(month_quantiles.merged_quantiles(sketches, ranges, probs), "quantis")
    errors = month_quantiles.rank_error(values, "valor", found, probs)
    kept = F.greatest("erro_mediana", "erro_p90") <= month_quantiles.RANK_ERROR
    exact = exact_quantiles(month_quantiles.in_ranges(values, ranges), "valor", probs, ["inicio", "fim"])
    return (found.select("inicio", "fim", F.col("valores").alias("pedidos")).join(exact, ["inicio", "fim"])
            .join(errors.select("inicio", "fim", kept.alias("dentro_do_erro")), ["inicio", "fim"]))


@query("longest_inactive", """
SELECT razao_social, cidade, uf, segmento, dias_sem_comprar, receita_acumulada, total_pedidos FROM (
  SELECT * FROM d_dim_cliente WHERE ativo ORDER BY ultimo_pedido ASC NULLS LAST, cliente_id LIMIT 20)""")
def _(d):
    return serving.longest_inactive(d.dim_cliente)


@query("most_late_customers", f"""
SELECT c.razao_social, f.recencia_dias, {half_up('f.intervalo_medio_dias', 1)} AS intervalo_medio, {half_up('f.atraso_relativo', 1)} AS atraso
FROM d_feat_s f JOIN d_dim_cliente c ON f.cliente_id = c.cliente_id ORDER BY f.atraso_relativo DESC NULLS LAST, f.cliente_id LIMIT 10""")
def _(d):
    return serving.most_late_customers(d.features(), d.dim_cliente)


# ---- quality ------------------------------------------------------------------------------------

@query("quality_suite", """
SELECT '1 receita gold = silver' AS teste, CAST((SELECT sum(receita) FROM d_fato) AS VARCHAR) AS observado,
  CAST((SELECT sum(valor_liquido) FROM d_pedidos) AS VARCHAR) AS esperado,
  abs((SELECT sum(receita) FROM d_fato) - (SELECT sum(valor_liquido) FROM d_pedidos)) <= 0.01 AS passou
UNION ALL SELECT '2 cnpj unico', CAST(count(*) - count(DISTINCT cnpj) AS VARCHAR), '0', count(*) = count(DISTINCT cnpj) FROM d_clientes
UNION ALL SELECT '3 data_pedido sem nulos', CAST(count(*) - count(data_pedido) AS VARCHAR), '0', count(*) = count(data_pedido) FROM d_pedidos
UNION ALL SELECT '4 devolucao coerente', CAST(count(*) FILTER ((receita < 0) <> devolucao) AS VARCHAR), '0',
  count(*) FILTER ((receita < 0) <> devolucao) = 0 FROM d_fato
UNION ALL SELECT '5 volume da fato', CAST(count(*) AS VARCHAR), '140000 a 250000', count(*) BETWEEN 140000 AND 250000 FROM d_fato
UNION ALL SELECT '6 pedido_id valido', CAST(count(*) AS VARCHAR), '0', count(*) = 0 FROM (
  SELECT 1 FROM d_fato f WHERE NOT EXISTS (SELECT 1 FROM d_pedidos p WHERE p.pedido_id = f.pedido_id) LIMIT 1)
UNION ALL SELECT '7 dim_cliente cnpj unico', CAST(count(*) - count(DISTINCT cnpj) AS VARCHAR), '0', count(*) > 0 AND count(*) = count(DISTINCT cnpj) FROM d_dim_cliente
UNION ALL SELECT '8 mart = fato', CAST((SELECT sum(receita) FROM d_sku_mes) AS VARCHAR), CAST((SELECT sum(receita) FROM d_fato) AS VARCHAR),
  abs((SELECT sum(receita) FROM d_sku_mes) - (SELECT sum(receita) FROM d_fato)) <= 0.01
UNION ALL SELECT '9 cnpj 14 digitos', CAST(count(*) FILTER (length(cnpj) <> 14) AS VARCHAR), '0', count(*) FILTER (length(cnpj) <> 14) = 0 FROM d_dim_cliente""")
def _(d):
    fact = d.saved_fact
    return quality.quality_suite(fact, d.clientes, d.pedidos, d.dim_cliente,
                                 gold.mart_produto_performance(fact))


@query("asserting_aborts", f"SELECT teste, NOT passou AS abortou FROM ({REGISTRY['quality_suite'].oracle})")
def _(d):
    """Each test of the suite as a query that aborts when the test fails."""
    fact = d.saved_fact
    results = session.materialize(quality.quality_suite(fact, d.clientes, d.pedidos, d.dim_cliente, gold.mart_produto_performance(fact)), "testes")

    def aborts(test: str) -> bool:
        try:
            quality.asserting(results.filter(F.col("teste") == test)).collect()
        except SparkRuntimeException as e:
            if e.getCondition() != "USER_RAISED_EXCEPTION" or f"FALHOU: {test}" not in str(e):
                raise
            return True
        return False
    told = [(r["teste"], aborts(r["teste"])) for r in results.select("teste").collect()]
    return results.select("teste").join(d.spark.createDataFrame(told, "teste string, abortou boolean"), "teste")


@query("test_orphan_orders", "SELECT pedido_id FROM d_fato f WHERE NOT EXISTS (SELECT 1 FROM d_pedidos p WHERE p.pedido_id = f.pedido_id AND p.canal <> '5-LOW') GROUP BY pedido_id")
def _(d):
    """Orders of one channel are withheld, so that orphans exist."""
    return quality.orphan_orders(d.fato, d.pedidos.filter("canal <> '5-LOW'"))


@query("constraint_violations", """
SELECT 'clientes' AS tabela, 'cnpj_14_digitos' AS regra, count(*) FILTER (NOT length(cnpj) = 14) AS violacoes FROM d_clientes
UNION ALL SELECT 'clientes', 'cnpj_com_digito', count(*) FILTER (cnpj = '00000000000000') FROM d_clientes
UNION ALL SELECT 'clientes', 'data_cadastro_obrigatoria', count(*) FILTER (data_cadastro IS NULL) FROM d_clientes
UNION ALL SELECT 'pedidos', 'data_pedido_obrigatoria', count(*) FILTER (data_pedido IS NULL) FROM d_pedidos
UNION ALL SELECT 'pedidos', 'pedido_cancelado_zerado', count(*) FILTER (NOT (NOT cancelado OR valor_liquido = 0)) FROM d_pedidos
UNION ALL SELECT 'itens_pedido', 'quantidade_abs_positiva', count(*) FILTER (NOT quantidade_abs > 0) FROM d_itens""")
def _(d):
    return quality.constraint_violations({"clientes": d.clientes, "pedidos": d.pedidos, "itens_pedido": d.itens})
