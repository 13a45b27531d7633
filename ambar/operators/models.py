"""Boosted-tree pipelines, training, scoring, and the experiments built from them."""

from __future__ import annotations

from multiprocessing.pool import ThreadPool

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ambar.fixed import CV_FOLDS, PRESETS
from ambar.operators.columns import constant_columns, drop_columns, roles
from ambar.operators.evaluate import compare_models, roc_auc
from ambar.operators.prep import TabularModel, TabularPreprocessor
from ambar.operators.running import cumulative_share
from ambar.session import small_frame, stored

# Preset name -> GBTClassifier parameter. The L1 and L2 penalties have none.
PARAMETERS = {
    "n_estimators": "maxIter",
    "learning_rate": "stepSize",
    "max_depth": "maxDepth",
    "min_child_weight": "minInstancesPerNode",
    "subsample": "subsamplingRate",
    "colsample_bytree": "featureSubsetStrategy",
    "gamma": "minInfoGain",
    "seed": "seed",
}

# Rows that a task is worth, and that it may have at most where there are fewer cores than tasks.
ROWS_PER_TASK, MOST_ROWS_PER_TASK = 50_000, 500_000


def booster(preset: str, label: str, **overrides) -> GBTClassifier:
    """The boosted-tree classifier of a preset; overrides use the preset's parameter names."""
    wanted = {**PRESETS[preset], **overrides}
    params = {PARAMETERS[k]: v for k, v in wanted.items() if k in PARAMETERS}
    if "featureSubsetStrategy" in params:
        params["featureSubsetStrategy"] = str(params["featureSubsetStrategy"])
    return GBTClassifier(featuresCol="features", labelCol=label, lossType="logistic", **params)


def build_pipeline(
    train: DataFrame, preset: str, label: str, features: list[str], categorical: list[str] | None = None,
    fill: str = "missing", **overrides,
) -> Pipeline:
    """Preprocessor and classifier for the given features, roles by column type.

    Constant features are left out: after the split the period is one, for instance.
    """
    numeric, text = roles(train.select(*features), categorical)
    constant = set(constant_columns(train, features))
    prep = TabularPreprocessor(
        [c for c in numeric if c not in constant], [c for c in text if c not in constant], fill=fill
    )
    return Pipeline(stages=[prep, booster(preset, label, **overrides)])


def score(model: PipelineModel, df: DataFrame, label: str) -> DataFrame:
    """The evaluation frame: the input columns with ``label``, ``prediction`` (cut 0.5) and ``score``."""
    out = model.transform(df)
    kept = [c for c in df.columns if c not in ("label", "prediction", "score")]
    return out.select(
        *kept,
        F.col(label).cast("int").alias("label"),
        F.col("prediction").cast("int").alias("prediction"),
        vector_to_array("probability")[1].alias("score"),
    )


def fit(pipeline: Pipeline, train: DataFrame) -> PipelineModel:
    """Fit on the train rows. Several passes read them, so give a stored table, not a long plan."""
    return pipeline.fit(gathered(train))


def gathered(train: DataFrame) -> DataFrame:
    """``train`` in no more partitions than its rows are worth: boosting runs a job per level of every tree, and on few
    rows their number of tasks is what they cost. Nor in more than there are cores, unless parts would become too large."""
    return train.coalesce(tasks_for(train.count(), train.sparkSession.sparkContext.defaultParallelism))


def tasks_for(rows: int, cores: int) -> int:
    """Tasks for a pass of boosting over so many rows."""
    return max(1, min(-(-rows // ROWS_PER_TASK), max(cores, -(-rows // MOST_ROWS_PER_TASK))))


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores, where its files are read by fewer tasks: scoring costs many times what reading does."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def cross_fit(
    pipeline: Pipeline, folded: DataFrame, label: str, fold: str = "fold", folds: int = CV_FOLDS, parallelism: int = CV_FOLDS
) -> DataFrame:
    """Every row's score by the model of the folds that it is not in: the evaluation frame with ``fold``.

    The folded rows are stored by fold, so each fit prunes its own fold from the scan; ``parallelism`` folds are
    fitted at a time. The result is stored too, so that cuts, bands and alerts read scores and not models.
    """
    table, out = stored(folded, [fold]), None
    with ThreadPool(parallelism) as pool:
        fitted = pool.map(lambda i: fit(pipeline, table.where(F.col(fold) != i)), range(folds))
    for i, model in enumerate(fitted):
        part = score(model, table.where(F.col(fold) == i), label)
        out = part if out is None else out.unionByName(part)
    return stored(out)


def cross_validate(
    pipeline: Pipeline, folded: DataFrame, label: str, fold: str = "fold", folds: int = CV_FOLDS, parallelism: int = CV_FOLDS
) -> DataFrame:
    """Area under the ROC curve per fold, each scored by a model of the other folds: (fold, roc_auc)."""
    return roc_auc(cross_fit(pipeline, folded, label, fold, folds, parallelism).select(fold, "label", "score"), [fold])


def cv_summary(per_fold: DataFrame) -> DataFrame:
    """Mean and twice the population deviation over folds."""
    return per_fold.agg(
        F.avg("roc_auc").alias("mean_auc"), (2 * F.stddev_pop("roc_auc")).alias("two_std"), F.count("*").alias("n_folds")
    )


def train_model(
    pipeline: Pipeline, train: DataFrame, label: str, fold: str | None = None, folds: int = CV_FOLDS
) -> tuple[PipelineModel, DataFrame | None]:
    """Cross-validate when a fold column is named, then fit on all train rows."""
    per_fold = cross_validate(pipeline, train, label, fold, folds) if fold else None
    return fit(pipeline, train), per_fold


def feature_importance(model: PipelineModel, top_n: int | None = 15) -> DataFrame:
    """(feature, importance), highest first. Names come from the fitted preprocessor's dictionary by a join on position."""
    prep = next(stage for stage in model.stages if isinstance(stage, TabularModel))
    values = model.stages[-1].featureImportances
    found = {int(i): float(v) for i, v in zip(values.indices, values.values)} if hasattr(values, "indices") else dict(enumerate(map(float, values)))
    names = prep.names()
    schema = T.StructType([T.StructField("position", T.LongType()), T.StructField("importance", T.DoubleType())])
    table = small_frame(names.sparkSession, list(found.items()), schema)
    # As many values as the trees have splits at most.
    named = names.join(F.broadcast(table), "position", "left").select("feature", F.coalesce("importance", F.lit(0.0)).alias("importance"))
    ranked = named.orderBy(F.desc("importance"), "feature")
    return ranked.limit(top_n) if top_n else ranked


def importance_cumulative(model: PipelineModel, covers: list[float]) -> tuple[DataFrame, DataFrame]:
    """Running share of importance, and how many features reach each cover."""
    return cumulative_share(feature_importance(model, None), "feature", "importance", covers)


def leakage_experiment(
    train: DataFrame, test: DataFrame, label: str, features: list[str], leaky: list[str],
    preset: str = "controle_leakage", **overrides,
) -> DataFrame:
    """One preset fitted with and without the leaky columns; metrics on the test rows and their drop."""
    scored = []
    for name, wanted in [
        ("with_leakage", features),
        ("without_leakage", [c for c in features if c in drop_columns(train, leaky).columns]),
    ]:
        model = fit(build_pipeline(train, preset, label, wanted, **overrides), train)
        scored.append((name, score(model, test, label)))
    return compare_models(scored)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(spark: SparkSession, path: str) -> PipelineModel:
    return PipelineModel.load(path)
