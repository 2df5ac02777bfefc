"""Purchase-propensity model on Spark ML: impute, train, out-of-fold scores, importance, gates."""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import partial, reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vendaflow.operators.metrics import FOLDS, counted_auc, lift_at_k, rank_auc, shuffle_key, stratified_split
from vendaflow.operators.ordering import row_numbers
from vendaflow.schemas import FEATURES, LABEL
from vendaflow.session import materialize

# Boosting parameters and acceptance limits.
ITERATIONS, LEARNING_RATE, DEPTH, MIN_LEAF, MAX_BINS, SEED = 150, 0.1, 5, 10, 255, 42
MIN_GAIN, MAX_AUC, MIN_LIFT, TOP_K = 0.05, 0.85, 2.5, 200
PERMUTATIONS = 5

# Features that may be NULL; each gets a 0/1 companion so that trees can still split on absence.
NULLABLE = ["ticket_medio", "margem_percentual", "intervalo_medio_dias", "desvio_intervalo_dias",
            "atraso_relativo", "taxa_ganho", "conversao_visita", "concentracao_marca_top"]


class ModelRejected(Exception):
    """The trained model missed an acceptance gate."""


def _missing(c: str) -> str:
    return f"{c}_ausente"


def _filled(c: str) -> str:
    return f"{c}_cheio"


MODEL_COLUMNS = [_filled(c) if c in NULLABLE else c for c in FEATURES] + [_missing(c) for c in NULLABLE]


def with_indicators(df: DataFrame) -> DataFrame:
    return df.withColumns({_missing(c): F.col(c).isNull().cast("double") for c in NULLABLE})


def imputer() -> Imputer:
    """Mean imputation: means combine map-side and are exact, unlike sampled medians."""
    return Imputer(strategy="mean", inputCols=NULLABLE, outputCols=[_filled(c) for c in NULLABLE])


def _imputable(df: DataFrame) -> DataFrame:
    """A column without a single value has no mean; give it zeros so that the imputer accepts it."""
    known = df.agg(*[F.count(c).alias(c) for c in NULLABLE]).first()
    return df.withColumns({c: F.lit(0.0) if known[c] == 0 else F.col(c) for c in NULLABLE})


def impute(df: DataFrame) -> DataFrame:
    marked = with_indicators(df)
    return imputer().fit(_imputable(marked)).transform(marked)


def fit(train: DataFrame, iterations: int = ITERATIONS) -> PipelineModel:
    """Boosted trees. Read `train` from a table or checkpoint: every tree level scans it again."""
    trees = GBTClassifier(featuresCol="features", labelCol=LABEL, maxIter=iterations,
                          stepSize=LEARNING_RATE, maxDepth=DEPTH, minInstancesPerNode=MIN_LEAF,
                          maxBins=MAX_BINS, seed=SEED)
    stages = [imputer(), VectorAssembler(inputCols=MODEL_COLUMNS, outputCol="features"), trees]
    return Pipeline(stages=stages).fit(_imputable(with_indicators(train)))


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Input columns plus `score`, the probability of a purchase."""
    scored = model.transform(with_indicators(df))
    return (scored.withColumn("score", vector_to_array("probability").getItem(1))
            .select(*df.columns, "score"))


def _fit_many(jobs: list, parallel: int) -> list:
    """Run independent fits from a few driver threads; Spark schedules their stages side by side."""
    with ThreadPoolExecutor(parallel) as pool:
        return list(pool.map(lambda job: job(), jobs))


def out_of_fold(train: DataFrame, iterations: int = ITERATIONS, folds: int = FOLDS) -> DataFrame:
    """Every row scored by a model that never saw its fold; `train` carries the `fold` column."""
    models = _fit_many([partial(fit, train.filter(F.col("fold") != i), iterations)
                        for i in range(folds)], folds)
    return _held_out(models, train)


def _held_out(models: list[PipelineModel], train: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, [predict(m, train.filter(F.col("fold") == i))
                                          for i, m in enumerate(models)])


def permutation_importance(model: PipelineModel, data: DataFrame, repeats: int = PERMUTATIONS,
                           seed: int = SEED, key: str = "cliente_id") -> DataFrame:
    """Drop in AUC and in accuracy when one feature is exchanged between rows.

    Per repeat the rows are put in a random order and every row takes the value of the next one, so
    a repeat is one join on the row number. Each (row, repeat) then yields one variant per feature that a tree tests;
    variants are scored by the model and grouped. A variant whose value is the row's own keeps the row's score. Exchanging any
    other feature changes no score: its drops are 0. Every row and every changed variant is scored once.
    """
    used = tested_features(model)
    rows = materialize(predict(model, data.select(key, LABEL, *FEATURES)), "pontuadas")
    pairs = []
    for r in range(repeats):
        order = materialize(row_numbers(rows.withColumn("_h", shuffle_key(key, seed + r)), [], "_h", key,
                                        "_r", descending=False), "ordem")
        donor = order.select((F.col("_r") % F.col("_r_n") + 1).alias("_r"),
                             F.struct(*FEATURES).alias("_doador"))
        pairs.append(order.join(donor, "_r").select(F.lit(r).alias("rodada"), LABEL, *FEATURES, "score", "_doador"))
    names = F.array(*[F.lit(f) for f in used]).cast("array<string>")
    new = F.array(*[F.when(~F.col(f).eqNullSafe(F.col(f"_doador.{f}")), F.lit(f)) for f in used]).cast("array<string>")
    paired = materialize(reduce(DataFrame.unionByName, pairs).withColumn("_mudam", F.array_compact(new)), "pares")

    changed = paired.withColumn("feature", F.explode("_mudam"))
    swapped = changed.select(
        "rodada", "feature", LABEL,
        *[F.when(F.col("feature") == f, F.col(f"_doador.{f}")).otherwise(F.col(f)).alias(f)
          for f in FEATURES])
    kept = paired.select("rodada", F.explode(F.array_except(names, "_mudam")).alias("feature"), LABEL, "score")
    scored = predict(model, swapped).select("rodada", "feature", LABEL, "score").unionByName(kept)
    after = _quality(scored, ["rodada", "feature"])
    before = _quality(rows, []).select(F.struct("auc", "acuracia").alias("b")).scalar()
    drops = (after.withColumn("_b", before).groupBy("feature")
             .agg(F.avg(F.col("_b.auc") - F.col("auc")).alias("queda_auc"),
                  F.avg(F.col("_b.acuracia") - F.col("acuracia")).alias("queda_acuracia")))
    every = data.sparkSession.createDataFrame([(f,) for f in FEATURES], "feature string")
    return (every.join(drops, "feature", "left").select("feature", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("queda_auc", "queda_acuracia")])
            .orderBy(F.desc("queda_auc"), "feature"))


def tested_features(model: PipelineModel) -> list[str]:
    """Features that a split of any tree tests, directly or by their 0/1 companion."""
    tested = {MODEL_COLUMNS[int(n)] for n in re.findall(r"feature (\d+) ", model.stages[-1].toDebugString)}
    return [f for f in FEATURES if tested & {f, _filled(f), _missing(f)}]


def _quality(scored: DataFrame, part: list[str]) -> DataFrame:
    """AUC and accuracy per part. Rows fold to counts per score first, written once: both figures read those."""
    y = F.col(LABEL).cast("long")
    counts = materialize(scored.groupBy(*part, "score").agg(F.sum(y).alias("_p"), F.sum(1 - y).alias("_n")), "contagens")
    right = F.sum(F.when(F.col("score") >= 0.5, F.col("_p")).otherwise(F.col("_n")))
    accuracy = counts.groupBy(*part).agg((right.cast("double") / F.nullif(F.sum(F.col("_p") + F.col("_n")), F.lit(0))).alias("acuracia"))
    auc = counted_auc(counts, "score", part)
    if part:
        return auc.join(accuracy, part)
    return auc.withColumn("acuracia", accuracy.scalar())


@dataclass
class Evaluation:
    """Figures of one training run; every field is a single number or name."""
    auc: float
    auc_holdout: float
    lift_top: float
    acertos_top: int
    taxa_base: float
    baselines: dict[str, float]
    feature_top_1: str | None
    linhas: int
    menor_recencia: float | None = None
    linhas_holdout: int = 0
    positivos_holdout: int = 0
    iteracoes: int = ITERATIONS

    @property
    def best_baseline(self) -> tuple[str, float]:
        known = {k: v for k, v in self.baselines.items() if v is not None}
        return max(sorted(known.items()), key=lambda kv: kv[1]) if known else ("moeda", 0.5)


def gates(spark: SparkSession, e: Evaluation) -> DataFrame:
    """Acceptance gates as test rows."""
    name, base = e.best_baseline
    rows = [("1 ganho sobre a melhor regra", f"{e.auc - base:.6f}", f">= {MIN_GAIN} sobre {name}",
             e.auc - base >= MIN_GAIN),
            ("2 sem sinal de vazamento", f"{e.auc:.6f}", f"< {MAX_AUC}", e.auc < MAX_AUC),
            ("3 lift da fila", f"{e.lift_top:.6f}", f">= {MIN_LIFT}", e.lift_top >= MIN_LIFT)]
    return spark.createDataFrame(rows, "teste string, observado string, esperado string, passou boolean")


def diagnostics(spark: SparkSession, e: Evaluation) -> DataFrame:
    """One row to keep when a gate fails."""
    name, base = e.best_baseline
    return spark.createDataFrame(
        [(e.auc, e.lift_top, e.taxa_base, base, name, e.auc - base, e.linhas, e.menor_recencia, e.linhas_holdout,
          e.positivos_holdout, e.iteracoes, datetime.now(timezone.utc))],
        "auc double, lift double, taxa_base double, melhor_baseline double, nome_melhor_baseline string, "
        "diferenca_auc double, linhas long, menor_recencia double, linhas_holdout long, positivos_holdout long, "
        "iteracoes int, ts timestamp")


def metrics_row(spark: SparkSession, e: Evaluation, version: int) -> DataFrame:
    """One history row per training run."""
    b = {k: e.baselines.get(k) or 0.0 for k in ("recencia", "valor", "atraso")}
    return spark.createDataFrame(
        [(version, round(e.auc, 6), round(e.lift_top, 4), e.acertos_top, round(e.taxa_base, 6),
          round(b["recencia"], 6), round(b["valor"], 6), round(b["atraso"], 6), e.feature_top_1,
          datetime.now(timezone.utc))],
        "versao long, auc double, lift_top200 double, acertos_top200 long, taxa_base double, "
        "auc_baseline_recencia double, auc_baseline_valor double, auc_baseline_atraso double, "
        "feature_top_1 string, _treinado_em timestamp")


def evaluate(train: DataFrame, baselines: DataFrame, iterations: int = ITERATIONS,
             importance: bool = True) -> tuple[Evaluation, DataFrame, DataFrame]:
    """Out-of-fold AUC and lift, true holdout AUC, importance.

    Returns the figures, the out-of-fold frame and the scored holdout. The holdout model is fitted
    on the other 75 % only.
    """
    split = train if "fold" in train.columns else stratified_split(train)
    *models, held = _fit_many(
        [partial(fit, split.filter(F.col("fold") != i), iterations) for i in range(FOLDS)]
        + [partial(fit, split.filter(~F.col("holdout")), iterations)], FOLDS + 1)
    oof = materialize(_held_out(models, split), "oof")
    holdout = materialize(predict(held, split.filter("holdout")), "holdout")
    lift = lift_at_k(oof, k=TOP_K).first()
    top = None
    if importance:
        top = permutation_importance(held, split.filter("holdout")).first()["feature"]
    seen = holdout.agg(F.count("*").alias("n"), F.sum(LABEL).alias("y")).first()
    whole = split.agg(F.count("*").alias("n"), F.min("recencia_dias").alias("r")).first()
    figures = Evaluation(
        auc=rank_auc(oof, "score").first()["auc"] or 0.0,
        auc_holdout=rank_auc(holdout, "score").first()["auc"] or 0.0,
        lift_top=lift["lift"] or 0.0, acertos_top=lift["acertos"] or 0, taxa_base=lift["taxa_base"] or 0.0,
        baselines={r["regra"]: r["auc"] for r in baselines.collect()}, feature_top_1=top,
        linhas=whole["n"], menor_recencia=whole["r"], linhas_holdout=seen["n"], positivos_holdout=int(seen["y"] or 0),
        iteracoes=iterations)
    return figures, oof, holdout
