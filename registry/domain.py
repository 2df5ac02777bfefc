"""The benchmark tables seen as the sales domain: raw text extracts and their typed counterparts.

Raw frames carry deliberate dirt (two date layouts, three tax-id layouts, padded ids, non-numeric
numbers) and feed the cleansing queries. The large typed frames are derived straight from the typed
columns, so that downstream queries do not format and parse every value.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vendaflow.operators import customer_serving, features, gold, ranking, silver, weekly_queue
from vendaflow.operators.metrics import score_bands
from vendaflow.session import materialize, tune

# Cut-offs inside the date range of the benchmark orders.
TRAIN_REF, SCORE_REF = "2001-07-01", "2001-08-01"
AS_OF = SCORE_REF
#: Twelve cut-offs, the first days of the months up to the scoring date.
HISTORY = tuple(f"{2000 + (8 + i) // 12}-{(8 + i) % 12 + 1:02d}-01" for i in range(12))

# Declared, so that no job is spent on reading file footers for a schema.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
}


def _mixed(day: str, br: str) -> str:
    """A date as text, in the Brazilian layout where `br` holds."""
    return f"CASE WHEN {br} THEN date_format({day}, 'dd/MM/yyyy') ELSE date_format({day}, 'yyyy-MM-dd') END"


_EVENT_DAY = "date_sub(CAST(ts AS DATE), 8249)"
_SIGNED = "IF(l_returnflag = 'R', -CAST(l_quantity AS INT), CAST(l_quantity AS INT))"
_PRICE = "CAST(p_retailprice AS DECIMAL(18,2))"
_ITEM_ID = "concat_ws('-', l_orderkey, l_linenumber, sku)"
_STAGES = ("array('Prospecção', 'Qualificação', 'Proposta enviada', 'Negociação', 'Fechado ganho', "
           "'Fechado perdido')")


class Domain:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = tune(spark), sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.dir}/{name}.parquet")

    def _with_reps(self, df: DataFrame) -> DataFrame:
        """Adds the number of reps as `_n` (a scalar subquery)."""
        n = self.table("supplier").agg(F.count("*").alias("n")).scalar()
        return df.withColumn("_n", n)

    def _places(self, name: str, nation_key: str) -> DataFrame:
        return (self.table(name).join(self.table("nation"), F.col(nation_key) == F.col("n_nationkey"))
                .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")))

    # ---- raw text -------------------------------------------------------------------------------

    @cached_property
    def raw_clientes(self) -> DataFrame:
        numbered = self._places("customer", "c_nationkey").selectExpr(
            "*", "c_custkey AS k", "IF(c_custkey % 50 = 49, c_custkey - 1, c_custkey) * 13 + 42 AS num")
        since = _mixed("date_add(DATE '1994-01-01', CAST(k % 365 AS INT))", "k % 4 = 0")
        return numbered.selectExpr("*", "lpad(num, 14, '0') AS g").selectExpr(
            "IF(k % 7 = 0, ' ', '') || k AS cliente_id",
            "CASE WHEN k % 3 = 0 THEN concat(substr(g, 1, 2), '.', substr(g, 3, 3), '.', substr(g, 6, 3), '/', "
            "substr(g, 9, 4), '-', substr(g, 13, 2)) WHEN k % 3 = 1 THEN ' ' || g || ' ' "
            "ELSE CAST(num AS STRING) END AS cnpj",
            "IF(k % 5 = 0, upper('casa  ' || lower(c_name)), 'casa  ' || lower(c_name)) AS razao_social",
            "c_mktsegment AS segmento", "n_name AS cidade", "r_name AS uf", "'Bairro ' || (k % 20) AS bairro",
            f"IF(k % 97 = 0, '1994-1-5', {since}) AS data_cadastro",
            "CASE WHEN k % 33 = 0 THEN NULL WHEN k % 10 = 0 THEN 'N' ELSE 'S' END AS ativo")

    @cached_property
    def raw_vendedores(self) -> DataFrame:
        hired = _mixed("date_add(DATE '1993-01-01', CAST(k % 300 AS INT))", "k % 3 = 0")
        return self._places("supplier", "s_nationkey").withColumnRenamed("s_suppkey", "k").selectExpr(
            "CAST(k AS STRING) AS vendedor_id", "'Rep ' || IF(k % 20 = 19, k - 1, k) AS nome",
            "r_name AS regiao", "n_name AS uf", f"{hired} AS data_admissao",
            "CASE WHEN k % 14 = 0 THEN '31/12/2000' WHEN k % 7 = 0 THEN '2000-12-31' END AS data_desligamento",
            "CAST(40000 + 15000 * (k % 5) AS STRING) AS meta_mensal")

    @cached_property
    def raw_produtos(self) -> DataFrame:
        launch = _mixed("date_add(DATE '2001-01-01', CAST(p_partkey % 200 AS INT))", "p_partkey % 12 = 0")
        return self.table("part").selectExpr(
            "CAST(p_partkey AS STRING) AS sku", "' ' || p_name AS descricao", "p_type AS categoria",
            "p_brand AS marca", "'Nota ' || (p_size % 12) AS nota_olfativa",
            f"CAST({_PRICE} AS STRING) AS preco_tabela",
            f"CAST(CAST({_PRICE} * 0.60 AS DECIMAL(18,2)) AS STRING) AS custo_unitario",
            "IF(p_partkey % 2 = 0, 'UN', 'CX') AS unidade", "IF(p_size % 10 = 0, 'N', 'S') AS ativo",
            f"CASE WHEN p_partkey % 6 = 0 THEN {launch} END AS data_lancamento")

    @cached_property
    def raw_pedidos(self) -> DataFrame:
        return self._with_reps(self.table("orders")).selectExpr(
            "o_orderkey || ' ' AS pedido_id", "CAST(o_custkey AS STRING) AS cliente_id",
            "CAST(o_orderkey % _n AS STRING) AS vendedor_id",
            f"{_mixed('CAST(o_orderdate AS DATE)', 'o_orderkey % 3 = 0')} AS data_pedido",
            "o_orderpriority AS canal", "IF(o_orderstatus = 'P', ' Cancelado', 'Faturado') AS status",
            "IF(o_orderkey % 1000 = 7, 'abc', CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING)) AS valor_total")

    def _lines(self, *part_columns: str) -> DataFrame:
        # joined by SKU as text, so that a later join by SKU finds the rows in place; prices are converted once per part
        part = self.table("part").selectExpr("CAST(p_partkey AS STRING) AS sku", f"{_PRICE} AS preco", *part_columns)
        return (self.table("lineitem").withColumn("sku", F.expr("CAST(l_partkey AS STRING)")).join(part, "sku")
                .selectExpr("*", f"{_SIGNED} AS q"))

    @cached_property
    def raw_itens(self) -> DataFrame:
        return self._lines().selectExpr(
            f"{_ITEM_ID} AS item_id", "CAST(l_orderkey AS STRING) AS pedido_id", "sku",
            "IF(l_orderkey % 997 = 5, 'abc', CAST(q AS STRING)) AS quantidade",
            "CAST(preco AS STRING) AS preco_praticado",
            "CAST(CAST(l_discount * 100 AS DECIMAL(18,2)) AS STRING) AS desconto_pct",
            "CAST(CAST(q * preco AS DECIMAL(18,2)) AS STRING) AS valor_bruto")

    @cached_property
    def raw_pagamentos(self) -> DataFrame:
        return self.pagamentos.selectExpr(
            "pagamento_id", "pedido_id", "forma_pagamento", "CAST(parcelas AS STRING) AS parcelas",
            "CAST(valor AS STRING) AS valor", "CAST(taxa_pct AS STRING) AS taxa_pct",
            "CAST(valor_liquido AS STRING) AS valor_liquido",
            f"{_mixed('data_vencimento', 'parcelas > 3')} AS data_vencimento",
            f"{_mixed('data_pagamento', 'parcelas > 3')} AS data_pagamento",
            "' ' || status_pagamento AS status_pagamento")

    @cached_property
    def raw_estoque(self) -> DataFrame:
        day = _mixed("date_add(DATE '2001-07-04', w * 7)", "w % 2 = 0")
        return (self.table("part").selectExpr("p_partkey AS k", "explode(sequence(0, 3)) AS w").selectExpr(
            f"{day} AS data_snapshot", "CAST(k AS STRING) AS sku",
            "CASE WHEN k % 211 = 0 THEN '-1' WHEN k % 307 = 0 THEN 'x' "
            "ELSE CAST((k * 7 + w * 3) % 50 AS STRING) END AS saldo", "'N' AS ruptura"))

    @cached_property
    def raw_carteira(self) -> DataFrame:
        """One assignment per customer; every tenth customer gets a later second one."""
        customers = self._with_reps(self.table("customer").selectExpr("c_custkey AS k"))
        first = customers.selectExpr(
            "'A' || k AS carteira_id", "CAST(k AS STRING) AS cliente_id", "CAST(k % _n AS STRING) AS vendedor_id",
            "'01/03/1995' AS data_inicio", "CASE WHEN k % 6 = 0 THEN '2000-01-31' END AS data_fim")
        second = customers.filter("k % 10 = 3").selectExpr(
            "'B' || k AS carteira_id", "CAST(k AS STRING) AS cliente_id",
            "CAST((k + 1) % _n AS STRING) AS vendedor_id", "'1999-05-01' AS data_inicio",
            "CAST(NULL AS STRING) AS data_fim")
        return first.unionByName(second)

    @cached_property
    def raw_oportunidades(self) -> DataFrame:
        closed = _mixed(f"date_add({_EVENT_DAY}, CAST(event_id % 60 AS INT))", "event_id % 3 = 0")
        return self._with_reps(self.table("events").filter("event_type IN ('click', 'view')")).selectExpr(
            "CAST(event_id AS STRING) AS oportunidade_id", "CAST(user_id AS STRING) AS cliente_id",
            "CAST(user_id % _n AS STRING) AS vendedor_id", "event_type AS origem",
            f"{_mixed(_EVENT_DAY, 'event_id % 2 = 0')} AS data_abertura",
            f"element_at({_STAGES}, CAST(event_id % 6 + 1 AS INT)) AS etapa",
            "CAST(event_id % 100 AS STRING) AS probabilidade_pct",
            "CAST(CAST(value AS DECIMAL(18,2)) AS STRING) AS valor_estimado",
            f"CASE WHEN event_id % 6 >= 4 THEN {closed} END AS data_fechamento",
            "CAST(event_id % 60 AS STRING) AS ciclo_dias",
            "CASE WHEN event_id % 6 = 5 THEN 'Preço ' END AS motivo_perda")

    @cached_property
    def raw_visitas(self) -> DataFrame:
        rows = self.table("events").filter("event_type IN ('purchase', 'signup', 'error')")
        return self._with_reps(rows).selectExpr(
            "CAST(event_id AS STRING) AS visita_id", "CAST(user_id AS STRING) AS cliente_id",
            "CAST(user_id % _n AS STRING) AS vendedor_id",
            f"{_mixed(_EVENT_DAY, 'event_id % 5 = 0')} AS data_visita",
            "IF(event_type = 'purchase', ' Pedido realizado', 'Sem interesse') AS resultado",
            "IF(event_id % 401 = 0, '?', CAST(event_id % 90 AS STRING)) AS duracao_min")

    def raw(self) -> dict[str, DataFrame]:
        return {"produtos": self.raw_produtos, "pedidos": self.raw_pedidos, "itens_pedido": self.raw_itens,
                "pagamentos": self.raw_pagamentos, "estoque": self.raw_estoque,
                "clientes": self.raw_clientes, "vendedores": self.raw_vendedores,
                "carteira": self.raw_carteira, "oportunidades": self.raw_oportunidades,
                "visitas": self.raw_visitas}

    # ---- typed ----------------------------------------------------------------------------------

    @cached_property
    def clientes(self) -> DataFrame:
        return silver.clientes(self.raw_clientes)

    @cached_property
    def clientes_unicos(self) -> DataFrame:
        return silver.deduplicated(self.raw_clientes)

    @cached_property
    def vendedores(self) -> DataFrame:
        return silver.vendedores(self.raw_vendedores)

    @cached_property
    def produtos(self) -> DataFrame:
        return silver.produtos(self.raw_produtos)

    @cached_property
    def pedidos(self) -> DataFrame:
        return (self._with_reps(self.table("orders")).selectExpr(
            "CAST(o_orderkey AS STRING) AS pedido_id", "CAST(o_custkey AS STRING) AS cliente_id",
            "CAST(o_orderkey % _n AS STRING) AS vendedor_id", "CAST(o_orderdate AS DATE) AS data_pedido",
            "o_orderpriority AS canal",
            "CASE WHEN o_orderkey % 1000 <> 7 THEN CAST(o_totalprice AS DECIMAL(18,2)) END AS valor_total",
            "o_orderstatus = 'P' AS cancelado").selectExpr(
            "*", "IF(cancelado, CAST(0 AS DECIMAL(18,2)), valor_total) AS valor_liquido",
            "year(data_pedido) AS ano", "month(data_pedido) AS mes"))

    @cached_property
    def itens(self) -> DataFrame:
        return (self._lines("p_size")
                .selectExpr("*", "CASE WHEN l_orderkey % 997 <> 5 THEN q END AS quantidade").selectExpr(
            f"{_ITEM_ID} AS item_id", "CAST(l_orderkey AS STRING) AS pedido_id", "sku",
            "quantidade", "abs(quantidade) AS quantidade_abs", "quantidade < 0 AS devolucao",
            "preco AS preco_praticado", "CAST(l_discount * 100 AS DECIMAL(18,2)) AS desconto_pct",
            "CAST(q * preco AS DECIMAL(18,2)) AS valor_bruto",
            "CAST(preco * 0.60 AS DECIMAL(18,2)) AS custo_unitario", "p_size % 10 = 0 AS sku_descontinuado"))

    @cached_property
    def pagamentos(self) -> DataFrame:
        return self.table("orders").selectExpr(
            "o_orderkey AS k", "CAST(o_orderdate AS DATE) AS dia", "CAST(o_totalprice AS DECIMAL(18,2)) AS valor"
        ).selectExpr(
            "'P' || k AS pagamento_id", "CAST(k AS STRING) AS pedido_id",
            "element_at(array('Boleto', 'Cartão', 'Pix'), CAST(k % 3 + 1 AS INT)) AS forma_pagamento",
            "CAST(1 + k % 6 AS INT) AS parcelas", "valor", "CAST(valor - k % 5 AS DECIMAL(18,2)) AS valor_liquido",
            "CAST(k % 5 AS DECIMAL(5,2)) AS taxa_pct", "date_add(dia, 30) AS data_vencimento",
            "CASE WHEN k % 9 <> 0 THEN date_add(dia, CAST(30 + k % 11 AS INT)) END AS data_pagamento",
            "IF(k % 9 <> 0, 'Pago', 'Aberto') AS status_pagamento")

    @cached_property
    def estoque(self) -> DataFrame:
        return silver.estoque(self.raw_estoque)

    @cached_property
    def carteira(self) -> DataFrame:
        return silver.carteira(self.raw_carteira, self.vendedores)

    @cached_property
    def oportunidades(self) -> DataFrame:
        return silver.oportunidades(self.raw_oportunidades)

    @cached_property
    def visitas(self) -> DataFrame:
        return silver.visitas(self.raw_visitas)

    # ---- gold -----------------------------------------------------------------------------------

    @cached_property
    def fato(self) -> DataFrame:
        return gold.fato_vendas(self.pedidos, self.itens, self.produtos, self.clientes_unicos)

    @cached_property
    def dim_cliente(self) -> DataFrame:
        return gold.dim_cliente(self.clientes_unicos, self.pedidos, self.itens, AS_OF)

    @cached_property
    def dim_produto(self) -> DataFrame:
        return gold.dim_produto(self.produtos)

    @cached_property
    def mart_vendedor(self) -> DataFrame:
        return gold.mart_vendas_por_vendedor(self.fato, self.vendedores)

    def features(self, ref: str = SCORE_REF) -> DataFrame:
        return features.feature_table(self.saved_fact, self.oportunidades, self.visitas, self.produtos, ref)

    @cached_property
    def training(self) -> DataFrame:
        return features.training_table(self.features(TRAIN_REF), self.saved_fact, TRAIN_REF)

    @cached_property
    def rule_scores(self) -> DataFrame:
        """A fixed score in (0, 1] that both engines can compute: recent buyers first."""
        return self.saved_features.select(
            "cliente_id", F.round(1 / (1 + F.col("recencia_dias")), 6).alias("score"))

    @cached_property
    def banded_scores(self) -> DataFrame:
        return score_bands(self.rule_scores)

    # ---- written tables, as in the nightly run: read by several branches of one query -------------

    @cached_property
    def saved_fact(self) -> DataFrame:
        """The fact's columns that features, marts by SKU, picks and tests read; orders and lines only, no customer attributes."""
        fact = gold.fato_vendas(self.pedidos, self.itens, self.produtos, None)
        return materialize(fact.select("pedido_id", "cliente_id", "data_pedido", "ano", "mes", "sku", "categoria", "marca", "quantidade_abs",
                                       "receita", "margem", "devolucao"), "fato")

    @cached_property
    def saved_profile(self) -> DataFrame:
        return materialize(customer_serving.customer_profile(self.saved_fact, self.saved_shelf, AS_OF), "perfil")

    @cached_property
    def saved_features(self) -> DataFrame:
        return materialize(self.features(SCORE_REF), "features")

    @cached_property
    def saved_clients(self) -> DataFrame:
        return materialize(self.dim_cliente, "clientes")

    def prepare_customers(self) -> None:
        """Write the inputs of queue and context side by side: the dimension and the shelf do not wait for the fact, nor scores and
        profile for one another."""
        with ThreadPoolExecutor(3) as pool:
            early = [pool.submit(getattr, self, n) for n in ("saved_clients", "saved_shelf")]
            _ = self.saved_fact
            late = pool.submit(getattr, self, "saved_scores")
            early[1].result()
            _ = self.saved_profile
            for job in (*early, late):
                job.result()

    @cached_property
    def saved_training(self) -> DataFrame:
        return materialize(self.training, "treino")

    @cached_property
    def saved_scores(self) -> DataFrame:
        return materialize(self.banded_scores, "scores")

    @cached_property
    def saved_shelf(self) -> DataFrame:
        return materialize(ranking.shelf(self.dim_produto, self.estoque), "estante")

    @cached_property
    def elegiveis(self) -> DataFrame:
        return weekly_queue.eligible(self.saved_scores, self.carteira, self.vendedores,
                                     self.dim_cliente, self.saved_features)

    @cached_property
    def top_ids(self) -> DataFrame:
        """Ids of the queue's customers, written once; Spark knows their size."""
        top = weekly_queue.top_customers(self.elegiveis).select("cliente_id")
        return materialize(top, "top")

    @cached_property
    def fila(self) -> DataFrame:
        self.prepare_customers()
        return weekly_queue.weekly_queue(
            self.saved_scores, self.carteira, self.vendedores, self.saved_clients, self.saved_features, self.saved_profile)
