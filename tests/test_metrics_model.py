"""Rank metrics against plain definitions, and the model on separable and random data."""

import random

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from vendaflow.operators import metrics, model, quality
from vendaflow.schemas import FEATURES, LABEL


@pytest.fixture(scope="module")
def scored(spark):
    rnd = random.Random(11)
    rows = [(f"c{i}", float(rnd.random() < 0.3), round(rnd.random(), 1)) for i in range(500)]
    return spark.createDataFrame(rows, f"cliente_id string, {LABEL} double, score double").cache()


def table(spark, rows, signal):
    """Feature rows; with `signal` the label follows one feature."""
    rnd = random.Random(5)
    data = []
    for i in range(rows):
        values = [rnd.random() if rnd.random() > 0.1 or f not in model.NULLABLE else None for f in FEATURES]
        y = float(values[FEATURES.index("valor_total")] > 0.8) if signal else float(rnd.random() < 0.2)
        data.append((f"c{i}", *values, y))
    cols = ", ".join(f"{f} double" for f in FEATURES)
    return spark.createDataFrame(data, f"cliente_id string, {cols}, {LABEL} double")


def test_auc_equals_evaluator(scored):
    got = metrics.rank_auc(scored, "score").first()["auc"]
    vectors = scored.withColumn("raw", array_to_vector(F.array(1 - F.col("score"), F.col("score"))))
    want = BinaryClassificationEvaluator(rawPredictionCol="raw", labelCol=LABEL).evaluate(vectors)
    assert got == pytest.approx(want, abs=1e-9)


def test_auc_of_one_class_is_null(spark):
    one = spark.createDataFrame([("a", 1.0, 0.5)], f"cliente_id string, {LABEL} double, score double")
    assert metrics.rank_auc(one, "score").first()["auc"] is None


def test_bands_of_ten(spark):
    df = spark.createDataFrame([(str(i), i / 10) for i in range(10)], "cliente_id string, score double")
    counts = {r.faixa: r["count"] for r in metrics.score_bands(df).groupBy("faixa").count().collect()}
    assert counts == {"Muito quente": 2, "Quente": 3, "Morna": 2, "Fria": 3}


def test_bands_cover_everyone_with_one_tied_score(spark):
    df = spark.range(103).select(F.col("id").cast("string").alias("cliente_id"), F.lit(0.5).alias("score"))
    counts = [r["count"] for r in metrics.score_bands(df).groupBy("faixa").count().collect()]
    assert sum(counts) == 103 and max(counts) - min(counts) <= 1


def test_lift(scored):
    r = metrics.lift_at_k(scored, k=50).first()
    top = sorted(scored.collect(), key=lambda x: (-x.score, x.cliente_id))[:50]
    hits = sum(x[LABEL] for x in top)
    base = scored.agg(F.avg(LABEL)).first()[0]
    assert r.acertos == hits and r.lift == pytest.approx(hits / 50 / base)


def test_calibration_orders_and_sums(scored):
    rows = metrics.calibration_table(scored).collect()
    assert [r.faixa for r in rows] == [b for b in reversed(metrics.BANDS) if b in {r.faixa for r in rows}]
    assert sum(r.clientes for r in rows) == 500


def test_split_is_exact_per_class_and_stable(scored):
    a = metrics.stratified_split(scored)
    for y in (0.0, 1.0):
        part = a.filter(F.col(LABEL) == y)
        n = part.count()
        assert part.filter("holdout").count() == -(-n // 4)
        folds = [r["count"] for r in part.groupBy("fold").count().collect()]
        assert len(folds) == 5 and max(folds) - min(folds) <= 1
    again = metrics.stratified_split(scored.repartition(3))
    assert a.exceptAll(again).count() == 0


def test_profile_flags(spark):
    df = table(spark, 60, False).withColumn("valor_total", F.monotonically_increasing_id().cast("double")) \
        .withColumn("taxa_ganho", F.lit(None).cast("double"))
    got = {r.feature: r for r in metrics.feature_profile(df).collect()}
    assert len(got) == 20 and got["valor_total"].alerta == "muitos distintos"
    assert got["taxa_ganho"].alerta == "muitos nulos" and got["taxa_ganho"].nulos == 60


def test_impute_marks_and_fills(spark):
    df = table(spark, 40, False).withColumn("taxa_ganho", F.lit(None).cast("double"))
    out = model.impute(df)
    assert out.filter("taxa_ganho_cheio <> 0 OR taxa_ganho_ausente <> 1").count() == 0
    mean = df.agg(F.avg("ticket_medio")).first()[0]
    filled = out.filter("ticket_medio IS NULL").select("ticket_medio_cheio", "ticket_medio_ausente").first()
    assert filled[0] == pytest.approx(mean) and filled[1] == 1.0


def test_model_learns_saves_and_ranks_importance(spark, tmp_path):
    train = metrics.stratified_split(table(spark, 400, True)).cache()
    fitted = model.fit(train.filter("NOT holdout"), iterations=5)
    held = model.predict(fitted, train.filter("holdout"))
    assert metrics.rank_auc(held, "score").first()["auc"] > 0.95
    assert held.filter("score < 0 OR score > 1").count() == 0
    fitted.write().overwrite().save(str(tmp_path / "m"))
    again = model.predict(PipelineModel.load(str(tmp_path / "m")), train.filter("holdout"))
    assert held.exceptAll(again).count() == 0
    imp = model.permutation_importance(fitted, train.filter("holdout"), repeats=2).collect()
    assert len(imp) == 20 and imp[0].feature == "valor_total" and imp[0].queda_auc > 0.2
    # only features that a tree tests are exchanged; the others keep every score
    used = model.tested_features(fitted)
    assert "valor_total" in used and len(used) < 20
    assert all(r.queda_auc == r.queda_acuracia == 0 for r in imp if r.feature not in used)


def test_importance_scores_each_row_and_changed_variant_once(spark, monkeypatch):
    """The same drops as by scoring every variant; a variant that keeps the row's value is not scored, none is scored twice."""
    train = metrics.stratified_split(table(spark, 200, True).withColumn("visitas_90d", F.lit(3.0))).cache()
    fitted = model.fit(train.filter("NOT holdout"), iterations=3)
    rows = train.filter("holdout").cache()
    monkeypatch.setattr(model, "tested_features", lambda m: ["valor_total", "visitas_90d"])
    scored, original = spark.sparkContext.accumulator(0), model.predict

    def counting(m, df):
        def seen(s):
            scored.add(1)
            return s
        return original(m, df).withColumn("score", F.udf(seen, "double")("score"))
    monkeypatch.setattr(model, "predict", counting)
    got = {r.feature: r for r in model.permutation_importance(fitted, rows, repeats=2).collect()}
    n = rows.count()
    assert n <= scored.value <= 3 * n       # the rows, and at most both repeats of the one feature that changes
    whole = original(fitted, rows)
    base = metrics.rank_auc(whole, "score").first()["auc"]
    keyed = [{r.cliente_id: r for r in rows.withColumn("_h", metrics.shuffle_key("cliente_id", model.SEED + i)).collect()} for i in range(2)]
    aucs = []
    for one in keyed:
        order = sorted(one.values(), key=lambda r: r._h)
        moved = [(r.cliente_id, order[(i + 1) % len(order)].valor_total) for i, r in enumerate(order)]
        swapped = rows.drop("valor_total").join(spark.createDataFrame(moved, "cliente_id string, valor_total double"), "cliente_id")
        aucs.append(metrics.rank_auc(original(fitted, swapped), "score").first()["auc"])
    assert got["valor_total"].queda_auc == pytest.approx(base - sum(aucs) / 2)
    assert got["visitas_90d"].queda_auc == got["visitas_90d"].queda_acuracia == 0


def test_gates_reject_random_and_leaky_models(spark):
    def run(auc, lift, base):
        e = model.Evaluation(auc, auc, lift, 10, 0.1, {"valor": base, "recencia": None}, None, 100)
        return [r.passou for r in model.gates(spark, e).collect()]
    assert run(0.80, 3.0, 0.66) == [True, True, True]
    assert run(0.50, 1.0, 0.50) == [False, True, False]
    assert run(0.99, 5.0, 0.66) == [True, False, True]
    e = model.Evaluation(0.5, 0.5, 1.0, 10, 0.1, {"valor": 0.5}, "x", 100)
    with pytest.raises(quality.QualityError, match="ganho"):
        quality.enforce(model.gates(spark, e), "model")
    assert model.diagnostics(spark, e).first().nome_melhor_baseline == "valor"
    assert model.metrics_row(spark, e, 7).first().versao == 7


def test_out_of_fold_covers_every_row_once(spark):
    train = metrics.stratified_split(table(spark, 120, False)).cache()
    oof = model.out_of_fold(train, iterations=2)
    assert oof.count() == 120 and oof.select("cliente_id").distinct().count() == 120
