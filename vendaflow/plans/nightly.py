"""The nightly run: arrival, bronze, silver, gold, gates, features, model, queue.

Every table is written beside the published ones, checked there, and shown when the gates of its stage pass: each layer has one
pointer, so all tables of a stage appear at once. A failed gate raises, the next stage never starts, and readers keep the tables of
the run before. The order-line fact is refreshed by month: months whose inputs did not change are shared with the run before.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field
from datetime import date

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from vendaflow import schemas
from vendaflow.operators import (customer_serving, features, gold, incremental, metrics, model, quality, ranking, serving, silver, weekly_queue)
from vendaflow.session import materialize, shared_dir, tune
from vendaflow.sources import raw_csv, tables
from vendaflow.sources.layers import RETENTION_HOURS, Layer


class CountMismatch(Exception):
    """A table holds other than the rows that were read."""


@dataclass
class Settings:
    raw_root: str
    train_ref: str | date = "2026-08-01"
    score_ref: str | date = "2026-08-31"
    as_of: str | date = "2026-08-31"
    prefix: str = ""                      # databases are <prefix>bronze, <prefix>silver, <prefix>gold
    volume: tuple[int, int] = quality.FACT_ROWS
    queue_size: int = weekly_queue.QUEUE_SIZE
    iterations: int = model.ITERATIONS
    calendar: tuple[str, str] = ("2024-09-01", "2026-08-31")
    remap_duplicates: bool = False        # move orders of discarded customer ids to the kept id
    strict: tuple[str, ...] = ("constraints", "quality", "model", "queue")
    model_root: str | None = None         # default: below the folder that driver and executors share
    retention_hours: float = RETENTION_HOURS
    buckets: int = 32                     # of the tables that lookups read; a lookup reads one
    counts: dict[str, int] = field(default_factory=dict)


class Nightly:
    def __init__(self, spark: SparkSession, settings: Settings):
        self.spark, self.s = tune(spark), settings
        self.layers = {layer: Layer(spark, f"{settings.prefix}{layer}") for layer in ("bronze", "silver", "gold")}

    def name(self, layer: str, table: str) -> str:
        return f"{self.s.prefix}{layer}.{table}"

    def read(self, layer: str, table: str) -> DataFrame:
        """The rows that this run has staged, else those that the layer showed when the run began."""
        return self.layers[layer].read(table)

    def _comment(self, table: str) -> str | None:
        return schemas.TABLE_COMMENTS.get(table)

    def _save(self, layer: str, table: str, df: DataFrame, **kw) -> None:
        self.s.counts[f"{layer}.{table}"] = tables.overwrite(
            tables.commented(df, schemas.COLUMN_COMMENTS), self.name(layer, table), self._comment(table), **kw)

    def _stage(self, layer: str, table: str, df: DataFrame, **kw) -> None:
        self.s.counts[f"{layer}.{table}"] = self.layers[layer].write(
            table, tables.commented(df, schemas.COLUMN_COMMENTS), comment=self._comment(table), **kw)

    def _publish(self, layer: str) -> None:
        self.layers[layer].publish(self.s.retention_hours)

    def _gate(self, kind: str, results: DataFrame) -> DataFrame:
        if kind in self.s.strict:
            quality.enforce(results, kind)
        return results

    def run(self) -> dict[str, int]:
        """All stages in order; returns the rows written per table."""
        for stage in (self.databases, self.arrival, self.bronze, self.silver, self.gold, self.gates,
                      self.features, self.model, self.profile, self.queue, self.lookups):
            stage()
        return self.s.counts

    def databases(self) -> None:
        for layer in ("bronze", "silver", "gold"):
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.s.prefix}{layer}")

    def arrival(self) -> None:
        """Refuse a delivery with a missing file, from the listing alone."""
        self._listing = materialize(raw_csv.arrival_listing(self.spark, self.s.raw_root), "controle")
        raw_csv.require_arrival(self._listing)

    def bronze(self) -> None:
        """Load every extract with one scan, which also counts it; an empty file, or a table that holds other than the rows that
        were read, stops the layer before it is shown."""
        wrong, read = [], {}
        for t in schemas.RAW_TABLES:
            self._stage("bronze", t, raw_csv.with_source(raw_csv.read_raw(self.spark, self.s.raw_root, t), t))
            read[t] = self.s.counts[f"bronze.{t}"]
            stored = self.read("bronze", t).count()     # from file footers
            if stored != read[t]:
                wrong.append(f"{t}: {read[t]} lidas, {stored} gravadas")
        control = materialize(raw_csv.counted(self._listing, read), "controle")
        raw_csv.require_arrival(control)
        if wrong:
            raise CountMismatch("; ".join(wrong))
        self._stage("bronze", "_raw_arquivos", control.select("sistema", "arquivo", "bytes", "linhas", "conferido_em"))
        self._publish("bronze")

    def silver(self) -> None:
        raw = {t: self.read("bronze", t) for t in schemas.RAW_TABLES}
        ready: dict[str, DataFrame] = {}

        def save(t: str, df: DataFrame) -> None:
            self._stage("silver", t, silver.with_audit(df, self.s.counts[f"bronze.{t}"]))
            ready[t] = self.read("silver", t)

        save("produtos", silver.produtos(raw["produtos"]))
        save("vendedores", silver.vendedores(raw["vendedores"]))
        save("itens_pedido", silver.itens_pedido(raw["itens_pedido"], ready["produtos"]))
        save("carteira", silver.carteira(raw["carteira"], ready["vendedores"]))
        save("clientes", silver.clientes(raw["clientes"]))
        mapping = silver.duplicate_map(silver.typed(raw["clientes"], "clientes"))
        self._stage("silver", "clientes_descartados", mapping)
        orders = silver.pedidos(raw["pedidos"])
        if self.s.remap_duplicates:
            orders = silver.remap_duplicate_ids(orders, self.read("silver", "clientes_descartados"))
        save("pedidos", orders)
        for t, build in (("oportunidades", silver.oportunidades), ("visitas", silver.visitas),
                         ("pagamentos", silver.pagamentos), ("estoque", silver.estoque)):
            save(t, build(raw[t]))
        broken = quality.constraint_violations({t: ready[t] for t in schemas.CHECKS})
        self._gate("constraints", broken.selectExpr(
            "tabela || '.' || regra AS teste", "CAST(violacoes AS STRING) AS observado", "'0' AS esperado",
            "violacoes = 0 AS passou"))
        self._publish("silver")

    def gold(self) -> None:
        s = {t: self.read("silver", t) for t in schemas.RAW_TABLES}
        self._stage("gold", "dim_cliente",
                   gold.dim_cliente(s["clientes"], s["pedidos"], s["itens_pedido"], self.s.as_of))
        self._stage("gold", "dim_produto", gold.dim_produto(s["produtos"]))
        self._stage("gold", "dim_vendedor", gold.dim_vendedor(s["vendedores"]))
        self._stage("gold", "dim_calendario", gold.dim_calendario(self.spark, *self.s.calendar))
        self.s.counts["gold.fato_vendas"] = incremental.refresh_fact(
            self.layers["gold"], s["pedidos"], s["itens_pedido"], s["produtos"], s["clientes"], self._comment("fato_vendas"))
        fact = self.read("gold", "fato_vendas")
        self._stage("gold", "mart_vendas_por_vendedor",
                   gold.mart_vendas_por_vendedor(fact, self.read("gold", "dim_vendedor")))
        self._stage("gold", "mart_produto_performance", gold.mart_produto_performance(fact))
        self._stage("gold", "mart_financeiro_recebimento",
                   gold.mart_financeiro_recebimento(s["pagamentos"], self.s.as_of))

    def gates(self) -> DataFrame:
        results = self._gate("quality", quality.quality_suite(
            self.read("gold", "fato_vendas"), self.read("silver", "clientes"), self.read("silver", "pedidos"),
            self.read("gold", "dim_cliente"), self.read("gold", "mart_produto_performance"), self.s.volume))
        self._publish("gold")
        return results

    def features(self) -> None:
        fact = self.read("gold", "fato_vendas")
        inputs = (fact, self.read("silver", "oportunidades"), self.read("silver", "visitas"),
                  self.read("gold", "dim_produto"))
        training = features.training_table(features.feature_table(*inputs, self.s.train_ref), fact,
                                           self.s.train_ref)
        self._stage("gold", "features_treino", training)
        self._stage("gold", "features_cliente", features.feature_table(*inputs, self.s.score_ref))
        self._publish("gold")

    def model(self) -> None:
        train = materialize(metrics.stratified_split(self.read("gold", "features_treino")), "divisao")
        rules = metrics.baseline_auc(train.filter("holdout"))
        figures, _, holdout = model.evaluate(train, rules, self.s.iterations)
        self._stage("gold", "calibragem_holdout", metrics.calibration_table(holdout))
        results = model.gates(self.spark, figures)
        try:
            self._gate("model", results)
        except quality.QualityError:
            self._save("gold", "diag_falha_modelo", model.diagnostics(self.spark, figures))
            raise
        version = int(time.time())
        fitted = model.fit(train, self.s.iterations)
        path = f"{(self.s.model_root or shared_dir(self.spark) + '/modelos').rstrip('/')}/{version}"
        fitted.write().overwrite().save(path)
        self._stage("gold", "modelo_artefato", self.spark.createDataFrame(
            [(str(version), path)], "versao string, caminho string"))
        self.score(version, path)
        tables.append(model.metrics_row(self.spark, figures, version), self.name("gold", "modelo_metricas"))

    def score(self, version: int, path: str) -> None:
        """Score with the saved model, as a later run would."""
        base = self.read("gold", "features_cliente")
        scored = materialize(model.predict(PipelineModel.load(path), base)
                             .select("cliente_id", "score", "_referencia"), "scores")
        self._stage("gold", "score_propensao", metrics.score_bands(scored).selectExpr(
            "cliente_id", "score", "faixa", "_referencia", f"CAST({version} AS BIGINT) AS versao_modelo"))
        self._publish("gold")

    def profile(self) -> None:
        """One row per customer, read by the queue and the lookups."""
        places = materialize(ranking.shelf(self.read("gold", "dim_produto"), self.read("silver", "estoque")), "estante")
        rows = customer_serving.customer_profile(self.read("gold", "fato_vendas"), places, self.s.as_of)
        self._stage("gold", "perfil_cliente", rows, bucket_by=("cliente_id", self.s.buckets))

    def queue(self) -> None:
        rows = weekly_queue.weekly_queue(
            self.read("gold", "score_propensao"), self.read("silver", "carteira"), self.read("silver", "vendedores"),
            self.read("gold", "dim_cliente"), self.read("gold", "features_cliente"), self.read("gold", "perfil_cliente"), self.s.queue_size)
        self._stage("gold", "fila_semanal", rows)
        self._gate("queue", quality.queue_tests(self.read("gold", "fila_semanal"), self.s.queue_size))

    def lookups(self) -> None:
        """Answers of the table functions, laid out by the id they are asked for, and shown together with the queue they belong to."""
        products, stock = self.read("gold", "dim_produto"), self.read("silver", "estoque")
        context = serving.customer_context(self.read("gold", "dim_cliente"), self.read("gold", "features_cliente"),
                                           self.read("gold", "score_propensao"), self.read("gold", "perfil_cliente"))
        wanted = serving.suggest_products(self.read("gold", "fato_vendas"), products, stock, self.s.as_of)
        for table, rows, key in (("contexto_servico", context, "cliente_id"), ("sugestoes_servico", wanted, "cliente_id"),
                                 ("disponibilidade_servico", serving.check_availability(products, stock), "sku")):
            self._stage("gold", table, rows, bucket_by=(key, self.s.buckets))
        self._publish("gold")
