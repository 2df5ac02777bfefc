"""Rank metrics, score bands, calibration and column profiles, all as grouped DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vendaflow.operators.ordering import exact_quantiles, row_numbers, running_totals
from vendaflow.schemas import FEATURES, LABEL

# Band names from best to worst, filler for missing features, profile limits.
BANDS = ("Muito quente", "Quente", "Morna", "Fria")
MISSING = -999.0
DISTINCT_LIMIT, NULL_LIMIT = 0.80, 0.50
SPLIT_SEED, HOLDOUT_SHARE, FOLDS = 42, 0.25, 5


def rank_auc(df: DataFrame, score: str, label: str = LABEL, part: list[str] | None = None) -> DataFrame:
    """Exact area under the ROC curve: share of (buyer, non-buyer) pairs ordered right, ties half.

    One row per part with `auc`, NULL when a class is missing.
    """
    y = F.col(label).cast("long")
    return counted_auc(df.select(*(part or []), score, y.alias("_p"), (1 - y).alias("_n")), score, part)


def counted_auc(counts: DataFrame, score: str, part: list[str] | None = None) -> DataFrame:
    """`rank_auc` of rows that each stand for `_p` buyers and `_n` non-buyers."""
    part = part or []
    curve = running_totals(counts, part, score, {"_p": F.col("_p"), "_n": F.col("_n")})
    won = F.col("_p").cast("double") * (F.col("_n_ate") - F.col("_n") / 2)
    pairs = F.max("_p_total").cast("double") * F.max("_n_total")
    return curve.groupBy(*part).agg((F.sum(won) / F.nullif(pairs, F.lit(0.0))).alias("auc"))


def baseline_auc(df: DataFrame) -> DataFrame:
    """AUC of three one-column rules; `melhor` marks the best one (then by name)."""
    rules = df.select(LABEL, (-F.col("recencia_dias")).alias("recencia"),
                      F.col("valor_total").alias("valor"),
                      F.coalesce("atraso_relativo", F.lit(0.0)).alias("atraso"))
    long = rules.unpivot([LABEL], ["recencia", "valor", "atraso"], "regra", "score")
    aucs = rank_auc(long, "score", part=["regra"])
    best = aucs.agg(F.min(F.struct(-F.col("auc"), F.col("regra"))).alias("b")).select("b.regra").scalar()
    return aucs.select("regra", "auc", (F.col("regra") == best).alias("melhor"))


def lift_at_k(df: DataFrame, score: str = "score", label: str = LABEL, k: int = 200,
              key: str = "cliente_id") -> DataFrame:
    """Hits in the k best scores and their rate over the base rate."""
    top = df.orderBy(F.desc(score), key).limit(k)
    base = df.agg(F.avg(label).alias("b")).scalar()
    return (top.agg(F.sum(label).cast("long").alias("acertos"), F.avg(label).alias("_taxa"),
                    F.count("*").alias("k"))
            .withColumn("taxa_base", base)
            .select("k", "acertos", "taxa_base",
                    (F.col("_taxa") / F.nullif("taxa_base", F.lit(0.0))).alias("lift")))


def score_bands(df: DataFrame, score: str = "score", key: str = "cliente_id") -> DataFrame:
    """Quartile by rank: ceil(rank / (n / 4)); keeps the input columns and adds `faixa`."""
    ranked = row_numbers(df, [], score, key, "_rank")
    quarter = F.ceil(F.col("_rank") / (F.col("_rank_n") / 4))
    name = F.element_at(F.array(*[F.lit(b) for b in BANDS]), F.least(quarter, F.lit(4)).cast("int"))
    return ranked.withColumn("faixa", name).drop("_rank", "_rank_n")


def value_bands(df: DataFrame, score: str = "score") -> DataFrame:
    """Quartile by value: thresholds are the interpolated quartiles of the score itself."""
    cuts = exact_quantiles(df, score, {"q1": 0.25, "q2": 0.5, "q3": 0.75})
    cut = cuts.select(F.struct("q1", "q2", "q3").alias("c")).scalar()
    s = F.col(score)
    return (df.withColumn("_c", cut)
            .withColumn("faixa", F.when(s >= F.col("_c.q3"), BANDS[0]).when(s >= F.col("_c.q2"), BANDS[1])
                        .when(s >= F.col("_c.q1"), BANDS[2]).otherwise(BANDS[3]))
            .drop("_c"))


def calibration_table(df: DataFrame, score: str = "score", label: str = LABEL) -> DataFrame:
    """Per value band: customers, buyers, purchase rate and mean score, coldest first."""
    order = F.array_position(F.array(*[F.lit(b) for b in reversed(BANDS)]), F.col("faixa"))
    return (value_bands(df, score).groupBy("faixa")
            .agg(F.count("*").alias("clientes"), F.sum(label).cast("long").alias("compraram"),
                 F.avg(label).alias("taxa_de_compra"), F.avg(score).alias("score_medio"))
            .orderBy(order))


def band_summary(scores: DataFrame) -> DataFrame:
    return (scores.groupBy("faixa")
            .agg(F.count("*").alias("total_clientes"), F.min("score").alias("score_min"),
                 F.max("score").alias("score_max"), F.avg("score").alias("score_medio"))
            .orderBy(F.desc("score_medio"), "faixa"))


def _long(df: DataFrame, keep: list[str]) -> DataFrame:
    return df.unpivot(keep, FEATURES, "feature", "valor")


def univariate_auc(df: DataFrame) -> DataFrame:
    """AUC of every feature alone, direction-free."""
    long = _long(df, [LABEL]).withColumn("valor", F.coalesce("valor", F.lit(MISSING)))
    aucs = rank_auc(long, "valor", part=["feature"])
    return aucs.select("feature", F.greatest(F.col("auc"), 1 - F.col("auc")).alias("auc"),
                       (F.col("auc") < 0.5).alias("invertida"))


def feature_profile(df: DataFrame) -> DataFrame:
    """Distinct and missing shares per feature with an alert for id-like or mostly empty columns."""
    values = _long(df, ["cliente_id"]).groupBy("feature", "valor").agg(F.count("*").alias("_n"))
    shares = values.groupBy("feature").agg(
        F.count("valor").alias("distintos"), F.sum("_n").alias("linhas"),
        F.coalesce(F.sum(F.when(F.col("valor").isNull(), F.col("_n"))), F.lit(0)).alias("nulos"))
    return shares.withColumn(
        "alerta", F.when(F.col("distintos") > F.col("linhas") * DISTINCT_LIMIT, "muitos distintos")
        .when(F.col("nulos") > F.col("linhas") * NULL_LIMIT, "muitos nulos").otherwise("ok"))


def decile_contrast(df: DataFrame, score: str = "score") -> DataFrame:
    """Mean of every feature among scores up to the 10th and from the 90th percentile."""
    cut = (exact_quantiles(df, score, {"p10": 0.1, "p90": 0.9})
           .select(F.struct("p10", "p90").alias("c")).scalar())
    s = F.col(score)
    long = _long(df.withColumn("_c", cut)
                 .withColumns({"_baixo": s <= F.col("_c.p10"), "_alto": s >= F.col("_c.p90")}),
                 ["_baixo", "_alto"])
    return (long.groupBy("feature")
            .agg(F.avg(F.when(F.col("_baixo"), F.col("valor"))).alias("media_baixa"),
                 F.avg(F.when(F.col("_alto"), F.col("valor"))).alias("media_alta"))
            .withColumn("diferenca", F.col("media_alta") - F.col("media_baixa")))


def shuffle_key(key: str, seed: int) -> Column:
    """Uniform 48-bit number from the key and a seed; the same in every run and engine."""
    digest = F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}")).cast("binary"))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("long")


def stratified_split(df: DataFrame, key: str = "cliente_id", label: str = LABEL,
                     share: float = HOLDOUT_SHARE, folds: int = FOLDS, seed: int = SPLIT_SEED) -> DataFrame:
    """Adds `holdout` (exact share per class, rounded up) and `fold` (0..folds-1, even per class)."""
    ranked = row_numbers(df.withColumn("_h", shuffle_key(key, seed)), [label], "_h", key, "_r",
                         descending=False)
    return (ranked.withColumns({"holdout": F.col("_r") <= F.ceil(F.col("_r_n") * share),
                                "fold": (F.col("_r") % folds).cast("int")})
            .drop("_h", "_r", "_r_n"))
