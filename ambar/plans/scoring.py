"""Queries over the scores of fitted models: cross-fitted validation, tuned cut, bands, alerts, ranking, scoring of new rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ambar.operators import evaluate, models, profile
from ambar.operators.prep import new_path
from ambar.operators.running import with_rank
from ambar.plans import flows
from ambar.plans.learning import EDITIONS, TEST, TRAIN, editions, engineered_model, history_model, pupil_model
from ambar.plans.oracle import sql


def flow_cv(spark, sf_dir):
    """Area under the ROC curve of each fold, for the three pupil models."""
    found = [("individual", pupil_model), ("historico", history_model), ("melhorado", engineered_model)]
    areas = flows.side_by_side([lambda make=make: make(spark, sf_dir).cross_validation() for _, make in found])
    out = None
    for (name, _), area in zip(found, areas):
        part = area.select(F.lit(name).alias("model"), "fold", "roc_auc")
        out = part if out is None else out.unionByName(part)
    return out


def out_of_fold_keys(spark, sf_dir):
    """Which train rows have an out-of-fold score, and their labels."""
    found = pupil_model(spark, sf_dir).out_of_fold().where("score BETWEEN 0 AND 1")
    return found.select("id_registro", "label")


def out_of_fold_cover(spark, sf_dir):
    """Rows scored, rows scored more than once, and folds of the cross-fitted table."""
    found = pupil_model(spark, sf_dir).out_of_fold()
    return found.agg(F.count("score").alias("n_scored"), (F.count("*") - F.countDistinct("id_registro")).alias("n_repeated"), F.countDistinct("fold").alias("n_folds"))


def metrics_at_best_modelo(spark, sf_dir):
    """The engineered model on the test edition, at the cut of 0.5 and at the one tuned on its out-of-fold scores."""
    fitted = engineered_model(spark, sf_dir)
    fitted.out_of_fold()  # the fold models are fitted beside the model, not after it
    out = evaluate.compare_models([("cut_default", fitted.scored()), ("cut_tuned", fitted.at_cut())])
    return out.withColumn("threshold", F.when(F.col("model") == "cut_default", 0.5).otherwise(fitted.cut()))


def threshold_sweep_modelo(spark, sf_dir):
    """Accuracy of the out-of-fold scores at each cut, and whether it is the chosen one."""
    fitted = engineered_model(spark, sf_dir)
    return evaluate.threshold_sweep(fitted.out_of_fold()).withColumn("chosen", F.col("threshold") == F.lit(fitted.cut()))


def municipality_risk(scored: DataFrame, keys: list[str]) -> DataFrame:
    """Groups ranked by the mean probability of missing the goal, the highest first."""
    risk = scored.groupBy(*keys).agg(F.avg(1 - F.col("score")).alias("mean_risk"), F.count("*").alias("n_rows"), F.count(F.when(F.col("prediction") == 0, 1)).alias("n_predicted_missing"))
    return with_rank(risk, "mean_risk", descending=True)


def municipio_risco(spark, sf_dir):
    """Municipal networks of the test edition, ranked by predicted risk."""
    return municipality_risk(engineered_model(spark, sf_dir).scored(), ["id_municipio", "rede"])


def municipio_risco_cover(spark, sf_dir):
    """The ranked networks with their rows."""
    return municipio_risco(spark, sf_dir).select("id_municipio", "rede", "n_rows")


def risk_bands_modelo(spark, sf_dir):
    return evaluate.risk_bands(engineered_model(spark, sf_dir).scored())


def risk_bands_modelo_total(spark, sf_dir):
    """Rows in all bands together."""
    return risk_bands_modelo(spark, sf_dir).agg(F.sum("n").alias("n_rows"))


def risk_critical_modelo(spark, sf_dir):
    return evaluate.critical_count(engineered_model(spark, sf_dir).scored())


def score_histogram_modelo(spark, sf_dir):
    return profile.histogram(engineered_model(spark, sf_dir).scored(), "score", 30, 0.5)


def school_alert_modelo(spark, sf_dir):
    return evaluate.group_alert(engineered_model(spark, sf_dir).scored(), ["id_escola"])


def school_alert_modelo_cover(spark, sf_dir):
    return school_alert_modelo(spark, sf_dir).select("id_escola", "n_rows")


def _reloaded(spark, fitted: flows.Fitted, raw: DataFrame):
    """The raw test rows scored by the saved and loaded model with its context, against the flow's own scores."""
    path = new_path(spark, "model")
    models.save_model(fitted.whole(), path)
    again = models.score(models.load_model(spark, path), raw, fitted.label).select("id_registro", F.col("score").alias("again"))
    both = fitted.scored().select("id_registro", "score").join(again, "id_registro", "full")
    differs = F.col("score").isNull() | F.col("again").isNull() | (F.abs(F.col("score") - F.col("again")) > 1e-12)
    return both.agg(F.count("*").alias("n_rows"), F.count(F.when(differs, 1)).alias("n_different"))


def score_reloaded_engineered(spark, sf_dir):
    raw = flows.pupil_frame(editions(spark, sf_dir)).where(F.col("ano") == TEST)
    return _reloaded(spark, engineered_model(spark, sf_dir), raw)


def score_reloaded_historico(spark, sf_dir):
    raw = flows.pupil_frame(editions(spark, sf_dir)).where(F.col("ano") == TEST)
    return _reloaded(spark, history_model(spark, sf_dir), raw)


def score_next_edition(spark, sf_dir):
    """Pupils of the edition after the test edition, without labels, scored by the saved engineered model."""
    from ambar.sources import tpch

    path = new_path(spark, "model")
    fitted = engineered_model(spark, sf_dir)
    models.save_model(fitted.whole(), path)
    rows = tpch.alunos(spark, sf_dir, (TEST + 1, TEST + 1)).withColumn(fitted.label, F.lit(None).cast("int"))
    return models.score(models.load_model(spark, path), rows, fitted.label).select("id_registro", F.col("score").between(0, 1).alias("scored"))


QUERIES = {
    "flow_cv": flow_cv,
    "out_of_fold_keys": out_of_fold_keys,
    "out_of_fold_cover": out_of_fold_cover,
    "metrics_at_best_modelo": metrics_at_best_modelo,
    "threshold_sweep_modelo": threshold_sweep_modelo,
    "municipio_risco": municipio_risco,
    "municipio_risco_cover": municipio_risco_cover,
    "risk_bands_modelo": risk_bands_modelo,
    "risk_bands_modelo_total": risk_bands_modelo_total,
    "risk_critical_modelo": risk_critical_modelo,
    "score_histogram_modelo": score_histogram_modelo,
    "school_alert_modelo": school_alert_modelo,
    "school_alert_modelo_cover": school_alert_modelo_cover,
    "score_reloaded_engineered": score_reloaded_engineered,
    "score_reloaded_historico": score_reloaded_historico,
    "score_next_edition": score_next_edition,
}


def rows_sql(year: int) -> str:
    """Pupils of one edition who are in no other of the model's editions."""
    return f"""SELECT * FROM alunos WHERE ano = {year} AND id_aluno IN (
    SELECT id_aluno FROM alunos WHERE ano IN ({EDITIONS[0]}, {EDITIONS[1]}) GROUP BY id_aluno HAVING count(DISTINCT ano) = 1)"""


ORACLES = {
    "out_of_fold_keys": sql("alunos", rows=rows_sql(TRAIN), body="SELECT id_registro, alfabetizado AS label FROM rows"),
    "out_of_fold_cover": sql("alunos", rows=rows_sql(TRAIN), body="SELECT count(*) AS n_scored, 0::BIGINT AS n_repeated, 5::BIGINT AS n_folds FROM rows"),
    "municipio_risco_cover": sql("alunos", rows=rows_sql(TEST), body="SELECT id_municipio, rede, count(*) AS n_rows FROM rows GROUP BY id_municipio, rede"),
    "risk_bands_modelo_total": sql("alunos", rows=rows_sql(TEST), body="SELECT count(*)::BIGINT AS n_rows FROM rows"),
    "school_alert_modelo_cover": sql("alunos", rows=rows_sql(TEST), body="SELECT id_escola, count(*) AS n_rows FROM rows GROUP BY id_escola"),
    "score_reloaded_engineered": sql("alunos", rows=rows_sql(TEST), body="SELECT count(*) AS n_rows, 0::BIGINT AS n_different FROM rows"),
    "score_reloaded_historico": sql("alunos", rows=rows_sql(TEST), body="SELECT count(*) AS n_rows, 0::BIGINT AS n_different FROM rows"),
    "score_next_edition": sql("alunos", body=f"SELECT id_registro, true AS scored FROM alunos WHERE ano = {TEST + 1}"),
}
