"""Cleansing: raw text frames in, typed and deduplicated frames out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vendaflow.functions.text import is_true, typed_columns
from vendaflow.schemas import SILVER_COLUMNS

# Order status and opportunity stages in the raw text, and their short forms.
CANCELLED = "Cancelado"
STAGE_WON, WON = "Fechado ganho", "ganha"
STAGE_LOST, LOST = "Fechado perdido", "perdida"


def typed(raw: DataFrame, table: str) -> DataFrame:
    return raw.select(*typed_columns(SILVER_COLUMNS[table]))


def with_audit(df: DataFrame, source_rows: int | Column) -> DataFrame:
    """Processing time and source row count; pass the count the load already observed."""
    rows = source_rows if isinstance(source_rows, Column) else F.lit(source_rows)
    return df.withColumns({"_processado_em": F.current_timestamp(),
                           "_linhas_origem": rows.cast("long")})


def _survivors(customers: DataFrame) -> DataFrame:
    """Oldest registration per tax id. A `min` of structs combines before the shuffle (by sorting each task's rows, as
    the struct holds text), so a tax id shared by a large part of the table sends one row per task."""
    rest = [c for c in customers.columns if c not in ("cnpj", "data_cadastro", "cliente_id")]
    record = F.struct("data_cadastro", "cliente_id", *rest)
    kept = customers.groupBy("cnpj").agg(F.min(record).alias("r"), F.count("*").alias("qtd_registros"))
    return kept.select("cnpj", "r.*", "qtd_registros")


def duplicate_map(customers: DataFrame) -> DataFrame:
    """One row per discarded registration: (cliente_id, cliente_id_mantido, cnpj, qtd_registros)."""
    kept = _survivors(customers).filter("qtd_registros > 1").select(
        F.col("cnpj").alias("_cnpj"), F.col("cliente_id").alias("cliente_id_mantido"), "qtd_registros")
    ids = customers.select("cliente_id", "cnpj")
    return (ids.join(kept, ids.cnpj.eqNullSafe(kept["_cnpj"]))
            .filter("cliente_id <> cliente_id_mantido")
            .select("cliente_id", "cliente_id_mantido", "cnpj", "qtd_registros").distinct())


def deduplicated(raw: DataFrame) -> DataFrame:
    """Surviving registrations without the list of discarded ids."""
    return _survivors(typed(raw, "clientes"))


def clientes(raw: DataFrame) -> DataFrame:
    """Surviving registrations; `duplicate_map` lists the discarded ids, one row each."""
    return deduplicated(raw).select("cliente_id", "cnpj", "razao_social", "data_cadastro", "ativo", "segmento",
                                    "cidade", "uf", "bairro", "qtd_registros")


def remap_duplicate_ids(df: DataFrame, mapping: DataFrame) -> DataFrame:
    """Point rows of discarded customer ids at the surviving id."""
    m = mapping.select(F.col("cliente_id").alias("_de"), F.col("cliente_id_mantido").alias("_para"))
    joined = df.join(m, df.cliente_id == m["_de"], "left")
    return (joined.withColumn("cliente_id", F.coalesce("_para", "cliente_id"))
            .select(*df.columns))


def pedidos(raw: DataFrame) -> DataFrame:
    cancelled = is_true(F.trim("status") == CANCELLED)
    return (raw.select(*typed_columns(SILVER_COLUMNS["pedidos"]), cancelled.alias("cancelado"))
            .withColumn("valor_liquido", F.when(F.col("cancelado"), F.lit(0).cast("decimal(18,2)"))
                        .otherwise(F.col("valor_total")))
            .withColumns({"ano": F.year("data_pedido"), "mes": F.month("data_pedido")}))


def produtos(raw: DataFrame) -> DataFrame:
    return typed(raw, "produtos")


def itens_pedido(raw: DataFrame, products: DataFrame) -> DataFrame:
    """Order lines with return and discontinued marks; no line is dropped."""
    p = products.select(F.col("sku").alias("_sku"), "custo_unitario", F.col("ativo").alias("_ativo"))
    lines = typed(raw, "itens_pedido")
    return (lines.join(p, lines.sku == p["_sku"], "left")
            .select("item_id", "pedido_id", "sku", "quantidade",
                    F.abs("quantidade").alias("quantidade_abs"),
                    (F.col("quantidade") < 0).alias("devolucao"),
                    "preco_praticado", "desconto_pct", "valor_bruto", "custo_unitario",
                    is_true(~F.col("_ativo")).alias("sku_descontinuado")))


def vendedores(raw: DataFrame) -> DataFrame:
    return typed(raw, "vendedores")


def carteira(raw: DataFrame, reps: DataFrame) -> DataFrame:
    """Assignments: current when open with a rep still employed, orphan when open with one who left."""
    left = (reps.filter("data_desligamento IS NOT NULL")
            .select(F.col("vendedor_id").alias("_saiu")).distinct())
    rows = typed(raw, "carteira")
    gone = F.col("_saiu").isNotNull()
    return (rows.join(left, rows.vendedor_id == left["_saiu"], "left")
            .select("carteira_id", "cliente_id", "vendedor_id", "data_inicio", "data_fim",
                    (F.col("_aberta") & ~gone).alias("vigente"),
                    (F.col("_aberta") & gone).alias("orfao_vendedor_desligado")))


def oportunidades(raw: DataFrame) -> DataFrame:
    stage = F.col("etapa")
    short = (F.when(stage == STAGE_WON, WON).when(stage == STAGE_LOST, LOST).otherwise(F.lower(stage)))
    return (typed(raw, "oportunidades")
            .withColumns({"ganancia": is_true(stage == STAGE_WON),
                          "perdida": is_true(stage == STAGE_LOST)})
            .withColumn("etapa", short))


def visitas(raw: DataFrame) -> DataFrame:
    return typed(raw, "visitas")


def pagamentos(raw: DataFrame) -> DataFrame:
    return typed(raw, "pagamentos")


def estoque(raw: DataFrame) -> DataFrame:
    """Stock snapshots; a stock-out is a balance of exactly zero."""
    return typed(raw, "estoque").withColumn("ruptura", is_true(F.col("saldo") == 0))
