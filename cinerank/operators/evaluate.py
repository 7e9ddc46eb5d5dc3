"""Metrics, evaluation reports and permutation importance."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..model.score import KEY_COLS, Model, score_arrow, score_expr
from ..session import cut_lineage
from . import split as S

FEATURE_GROUPS = [("gender", "Gender", "gender_idx"), ("age", "Age", "age_idx"),
                  ("occ", "Occupation", "occ_idx"), ("zip", "Zip region", "zip_idx"),
                  ("genres", "Genres", "genre_mask")]


def regression_metrics(pred: DataFrame, label: str = "rating", prediction: str = "prediction",
                       by: list[str] | None = None) -> DataFrame:
    """MSE, RMSE, MAE and row count in one aggregate (one job, not one per metric)."""
    e = F.col(prediction).cast("double") - F.col(label).cast("double")
    aggs = [F.avg(e * e).alias("mse"), F.avg(F.abs(e)).alias("mae"),
            F.count(F.lit(1)).cast("bigint").alias("n")]
    out = pred.groupBy(*(by or [])).agg(*aggs)
    return out.select(*(by or []), "mse", F.sqrt("mse").alias("rmse"), "mae", "n")


def rounded(metrics: DataFrame, places: int = 6) -> DataFrame:
    return metrics.select(*[F.round(c, places).alias(c) if c in ("mse", "rmse", "mae") else F.col(c)
                            for c in metrics.columns])


def predict(features: DataFrame, model: Model, scorer: str = "arrow") -> DataFrame:
    fn = score_arrow if scorer == "arrow" else score_expr
    return fn(features, model, "prediction")


def evaluate(features: DataFrame, model: Model, scorer: str = "arrow") -> DataFrame:
    return regression_metrics(predict(features, model, scorer))


def _counted(features: DataFrame, *tags: str) -> DataFrame:
    """Rows as counts: (tags, feature keys, rating, n). Two rows with one key get one score, so all
    metrics follow from this table; its size is bounded by the vocabularies, not by the rows."""
    return (features.groupBy(*tags, *KEY_COLS, F.col("rating").cast("double").alias("rating"))
            .agg(F.count(F.lit(1)).alias("n")))


def _scored_keys(counted: DataFrame, *scorers) -> DataFrame:
    """Distinct feature keys with the scorers' columns, spread over all tasks: a key costs the
    expression scorer thousands of multiplications, so adaptive coalescing by bytes would be wrong."""
    spark = counted.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    out = counted.select(*KEY_COLS).distinct().repartition(tasks, *KEY_COLS)
    for scorer in scorers:
        out = scorer(out)
    return cut_lineage(out)


def _weighted(prediction: str, n: str = "n") -> dict:
    e = F.col(prediction) - F.col("rating")
    total = F.sum(n)
    return {"mse": F.sum(e * e * F.col(n)) / total, "mae": F.sum(F.abs(e) * F.col(n)) / total}


def evaluation_report(features: DataFrame, model: Model) -> DataFrame:
    """Metrics of the Arrow scorer and the expression scorer side by side: the distinct
    feature keys are scored once by each and joined to the counts of (key, rating)."""
    counted = cut_lineage(_counted(features))
    keys = _scored_keys(counted, lambda d: score_arrow(d, model, "pred_arrow"), lambda d: score_expr(d, model, "pred_expr"))
    a, e = _weighted("pred_arrow"), _weighted("pred_expr")
    m = counted.join(keys, KEY_COLS).agg(
        a["mse"].alias("mse_a"), a["mae"].alias("mae_a"), e["mse"].alias("mse_e"), e["mae"].alias("mae_e"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n"), F.max(F.abs(F.col("pred_arrow") - F.col("pred_expr"))).alias("max_diff"))
    both = F.explode(F.array(
        F.struct(F.lit("arrow").alias("scorer"), F.col("mse_a").alias("mse"), F.col("mae_a").alias("mae")),
        F.struct(F.lit("expression").alias("scorer"), F.col("mse_e").alias("mse"), F.col("mae_e").alias("mae")))).alias("_m")
    return m.select(both, "n", "max_diff").select("_m.scorer", "_m.mse", F.sqrt("_m.mse").alias("rmse"), "_m.mae", "n", "max_diff")


def permutation_importance(test: DataFrame, model: Model, key_cols=S.RATING_KEY, seed: int = 42,
                           sample_cap: int | None = None) -> DataFrame:
    """Rise in RMSE when one feature (genres as a whole) is shuffled across the test rows.

    All rows by default; ``sample_cap`` keeps at most that many (deterministic hash sample). Rows are numbered
    once, by one sort, and each value is sent to the row that its feature's bijection names, in one shuffle for all features. The baseline and five
    permuted variants are scored where they lie, and one aggregate by feature gives six rows, from which the baseline is taken.
    """
    base = test.select(*key_cols, *KEY_COLS, F.col("rating").cast("double").alias("rating"))
    if sample_cap is not None:
        base = S.sample_cap(base, sample_cap, key_cols, seed)
    rows, n = S.numbered(base, key_cols, seed)
    names = ["baseline", *(label for _, label, _ in FEATURE_GROUPS)]
    columns = [col for _, _, col in FEATURE_GROUPS]
    scored = score_arrow(S.permuted_variants(rows, n, columns, "rating", seed), model, "prediction")
    e = F.col("prediction") - F.col("rating")
    feature = F.element_at(F.array(*map(F.lit, names)), F.col("_variant") + 1).alias("feature")
    metrics = scored.groupBy("_variant").agg(F.sqrt(F.sum(e * e) / F.count(F.lit(1))).alias("rmse")).select(feature, "rmse")
    six = Window.partitionBy()        # six rows
    baseline = F.max(F.when(F.col("feature") == "baseline", F.col("rmse"))).over(six)
    return (metrics.withColumn("baseline_rmse", baseline).filter(F.col("feature") != "baseline")
            .select("feature", F.col("rmse").alias("shuffled_rmse"), "baseline_rmse",
                    (F.col("rmse") - F.col("baseline_rmse")).alias("importance"))
            .orderBy(F.desc("importance"), "feature"))
