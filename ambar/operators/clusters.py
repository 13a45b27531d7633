"""KMeans over scaled indicators and the profile of its clusters."""

from __future__ import annotations

from multiprocessing.pool import ThreadPool

from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ambar.fixed import CLUSTER_FEATURES, SEED
from ambar.operators.prep import TabularPreprocessor


def kmeans(
    df: DataFrame, columns: list[str] = CLUSTER_FEATURES, k: int = 5, seed: int = SEED, starts: int = 10, parallelism: int = 5
) -> tuple[PipelineModel, DataFrame]:
    """Best of ``starts`` runs by within-cluster cost; returns the model and ``df`` with ``cluster``."""
    prep = TabularPreprocessor(columns, [], output="features").fit(df)
    vectors = prep.transform(df).persist()
    try:
        fit = lambda i: KMeans(k=k, seed=seed + i, featuresCol="features", predictionCol="cluster").fit(vectors)
        with ThreadPool(parallelism) as pool:
            runs = pool.map(fit, range(starts))
    finally:
        vectors.unpersist()
    best = min(runs, key=lambda m: m.summary.trainingCost)
    model = PipelineModel([prep, best])
    return model, model.transform(df).select(*df.columns, "cluster")


def cluster_profile(clustered: DataFrame, rate: str = "taxa_alfabetizacao") -> DataFrame:
    """Size and mean rate per cluster, lowest rate first."""
    return (
        clustered.groupBy("cluster")
        .agg(F.count("*").alias("n_rows"), F.avg(rate).alias("mean_rate"), F.min(rate).alias("min_rate"), F.max(rate).alias("max_rate"))
        .orderBy("mean_rate")
    )
