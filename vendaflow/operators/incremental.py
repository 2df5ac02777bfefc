"""Refresh of the order-line fact by month: the rows of each month are fingerprinted, and only months that changed are built.

The fingerprint covers every column of a month's rows: those of orders, their lines, the products of the lines and the customers of the
orders. A refresh makes it from the tables that the fact is made from, but moves a few numbers per line instead of its columns, and
writes nothing but one row per month. A fact that is written whole is fingerprinted from its written rows, with the same result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vendaflow.operators import gold
from vendaflow.schemas import COLUMN_COMMENTS
from vendaflow.session import materialize
from vendaflow.sources.layers import Layer
from vendaflow.sources.tables import commented

FACT, MONTHS, KEYS = "fato_vendas", "fato_vendas_meses", ["ano", "mes"]
NEW, CHANGED, SAME, GONE = "nova", "alterada", "igual", "removida"


def fingerprint(*names: str) -> Column:
    """64-bit hash of columns; a null differs from every value and keeps its place."""
    return F.xxhash64(*[c for n in names for c in (F.col(n), F.col(n).isNull())])


def _sum(c: Column) -> Column:
    return F.sum(c.cast("decimal(20,0)"))


_LINE = ("item_id", "sku", "quantidade", "quantidade_abs", "preco_praticado", "devolucao", "sku_descontinuado")
_PRODUCT, _CUSTOMER = ("categoria", "marca", "nota_olfativa"), ("razao_social", "segmento", "cidade")
_ORDER = ("pedido_id", "cliente_id", "data_pedido", "canal", "vendedor_id")
_ONE_ORDER = ["pedido_id", *KEYS, "_o", "_c"]


def _per_month(per_order: DataFrame) -> DataFrame:
    whole = F.xxhash64("_o", "_c", "linhas", F.col("_linhas").cast("decimal(38,0)"))
    return per_order.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("pedidos"), F.sum("linhas").alias("linhas"), _sum(whole).cast("string").alias("resumo"))


def month_digests(orders: DataFrame, lines: DataFrame, products: DataFrame, customers: DataFrame) -> DataFrame:
    """(ano, mes): orders and lines of the fact, and an order-free digest of its rows, from the tables that they are made from."""
    p = products.filter("custo_unitario IS NOT NULL").select("sku", fingerprint(*_PRODUCT).alias("_p"), "custo_unitario")
    i = (lines.filter("quantidade IS NOT NULL AND preco_praticado IS NOT NULL")
         .select("pedido_id", "sku", fingerprint(*_LINE).alias("_i"), "quantidade_abs"))
    per_order = (i.join(p, "sku").groupBy("pedido_id")
                 .agg(F.count(F.lit(1)).alias("linhas"), _sum(F.xxhash64("_i", "_p", gold.line_cost())).alias("_linhas")))
    c = customers.select("cliente_id", fingerprint(*_CUSTOMER).alias("_c"))
    unknown = F.xxhash64(*[x for _ in _CUSTOMER for x in (F.lit(None), F.lit(True))])
    o = (orders.filter(~F.col("cancelado")).select("pedido_id", "cliente_id", *KEYS, fingerprint(*_ORDER).alias("_o"))
         .join(c, "cliente_id", "left").withColumn("_c", F.coalesce("_c", unknown)))
    # an order given twice has its lines twice in the fact
    return _per_month(o.join(per_order, "pedido_id").groupBy(*_ONE_ORDER)
                      .agg(F.sum("linhas").alias("linhas"), F.sum("_linhas").alias("_linhas")))


def fact_digests(fact: DataFrame) -> DataFrame:
    """`month_digests` of the tables that `fact` was made from, out of its rows."""
    line = F.xxhash64(fingerprint(*_LINE), fingerprint(*_PRODUCT), F.col("custo"))
    rows = fact.select("pedido_id", *KEYS, fingerprint(*_ORDER).alias("_o"), fingerprint(*_CUSTOMER).alias("_c"), line.alias("_l"))
    return _per_month(rows.groupBy(*_ONE_ORDER).agg(F.count(F.lit(1)).alias("linhas"), _sum(F.col("_l")).alias("_linhas")))


def month_changes(now: DataFrame, before: DataFrame) -> DataFrame:
    """Every month of either run with its state: new, changed, same or gone."""
    a, b = now.alias("a"), before.alias("b")
    meet = F.col("a.ano").eqNullSafe(F.col("b.ano")) & F.col("a.mes").eqNullSafe(F.col("b.mes"))
    state = (F.when(F.col("b.resumo").isNull(), NEW).when(F.col("a.resumo").isNull(), GONE)
             .when(F.col("a.resumo") == F.col("b.resumo"), SAME).otherwise(CHANGED))
    return a.join(b, meet, "full").select(
        F.coalesce("a.ano", "b.ano").alias("ano"), F.coalesce("a.mes", "b.mes").alias("mes"), F.coalesce("a.pedidos", F.lit(0)).alias("pedidos"),
        F.coalesce("a.linhas", F.lit(0)).alias("linhas"), F.col("a.resumo").alias("resumo"), state.alias("estado"), F.col("b.lote").alias("lote"))


def refresh_fact(layer: Layer, orders: DataFrame, lines: DataFrame, products: DataFrame, customers: DataFrame, comment: str | None = None) -> int:
    """Stage the fact in `layer`: months that are new or changed are built and written, the others share the batches of the published
    fact. Returns the rows the fact will show. The table `fato_vendas_meses` keeps digest, state and batch of each month.

    A fact with other columns than the published one is written whole."""
    fact = commented(gold.fato_vendas(orders, lines, products, customers), COLUMN_COMMENTS)
    old = layer.current.get(FACT)
    whole = not (old and old[0] == layer.data_table(FACT, fact, KEYS) and layer.published(MONTHS))
    if whole:
        layer.write(FACT, fact, KEYS, comment)
        digests = materialize(fact_digests(layer.read(FACT)), "meses")
        before = digests.withColumn("lote", F.lit("")).limit(0)
    else:
        digests = materialize(month_digests(orders, lines, products, customers), "meses")
        before = layer.read(MONTHS, staged=False)
    # one row per month of the calendar
    months = month_changes(digests, before).where(F.col("estado") != GONE).collect()
    shared = {(r["ano"], r["mes"]): r["lote"] for r in months if r["estado"] == SAME}
    stale = [r for r in months if r["estado"] != SAME]
    if stale and not whole:
        todo = layer.spark.createDataFrame([(r["ano"], r["mes"]) for r in stale], "_ano int, _mes int")
        wanted = orders.join(todo, F.col("ano").eqNullSafe(F.col("_ano")) & F.col("mes").eqNullSafe(F.col("_mes")), "left_semi")
        part = commented(gold.fato_vendas(wanted, lines, products, customers), COLUMN_COMMENTS)
        layer.write(FACT, part, KEYS, comment, shared.values())
    elif not whole:
        layer.share(FACT, shared.values())

    def ending(ano, mes) -> str:
        return f"-{'nulo' if ano is None else ano}-{'nulo' if mes is None else mes}"

    written = {ending(*n.rsplit("-", 2)[1:]): n for n in layer.staged(FACT)}
    rows = [(r["ano"], r["mes"], r["pedidos"], r["linhas"], r["resumo"], r["estado"], written[ending(r["ano"], r["mes"])]) for r in months]
    layer.write(MONTHS, layer.spark.createDataFrame(rows, "ano int, mes int, pedidos long, linhas long, resumo string, estado string, lote string"))
    return sum(r["linhas"] for r in months)
