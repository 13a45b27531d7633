"""Additive attribution of a model's score to its input columns by Shapley sampling."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ambar.fixed import SEED
from ambar.functions.scalars import hash32
from ambar.operators.joins import sized_join
from ambar.session import materialise


def _draw(key: str, *parts: Column) -> Column:
    return F.concat_ws(":", F.col(key).cast("string"), *[p.cast("string") for p in parts])


def background_rows(train: DataFrame, features: list[str], key: str, n: int, seed: int = SEED) -> DataFrame:
    """``n`` train rows drawn by key, numbered from 0: the reference the attribution compares with."""
    drawn = train.withColumn("_hash", hash32(key, seed)).orderBy("_hash", key).limit(n)
    # At most n rows remain, so one task may number them.
    number = F.row_number().over(Window.orderBy("_hash", key)) - 1
    return materialise(drawn.select(number.cast("int").alias("_background"), *[F.col(c).alias(f"_b_{c}") for c in features]))


def shapley_paths(
    rows: DataFrame, background: DataFrame, features: list[str], key: str, n_background: int,
    permutations: int = 4, seed: int = SEED, antithetic: bool = False,
) -> DataFrame:
    """The mixed rows to score: along each drawn feature order, one more feature at a time is taken
    from the row instead of its background row. Rows × permutations × (features + 1).

    ``antithetic`` draws the orders in pairs: each second one is the first one reversed, with the same background row. What
    comes early in one comes late in the other, so their mean varies less than that of two orders drawn apart."""
    # There may be fewer rows to draw from than were asked for.
    n_background = min(n_background, background.count())
    if n_background < 1:
        raise ValueError("no background rows to compare with")
    perm = F.floor(F.col("_perm") / 2) if antithetic else F.col("_perm")
    order = F.transform(
        F.array_sort(
            F.array(*[F.struct(hash32(_draw(key, perm, F.lit(f"f{i}")), seed).alias("h"), F.lit(i + 1).alias("f")) for i in range(len(features))])
        ),
        lambda x: x["f"],
    )
    drawn = rows.select(key, *features, F.explode(F.sequence(F.lit(0), F.lit(permutations - 1))).alias("_perm"))
    if antithetic:
        order = F.when(F.col("_perm") % 2 == 0, order).otherwise(F.reverse(order))
    drawn = drawn.withColumn("_order", order).withColumn(
        "_background", F.pmod(hash32(_draw(key, perm, F.lit("b")), seed), F.lit(n_background)).cast("int")
    )
    # n_background rows by construction, so the broadcast is bounded.
    paired = drawn.join(F.broadcast(background), "_background")
    steps = paired.withColumn("_step", F.explode(F.sequence(F.lit(0), F.lit(len(features)))))
    mixed = [
        F.when(F.array_position("_order", F.lit(i + 1)) <= F.col("_step"), F.col(c)).otherwise(F.col(f"_b_{c}")).alias(c)
        for i, c in enumerate(features)
    ]
    return steps.select(key, "_perm", "_order", "_step", *mixed)


def shapley_values(
    model: PipelineModel, rows: DataFrame, background: DataFrame, features: list[str], key: str, n_background: int,
    permutations: int = 4, seed: int = SEED,
) -> DataFrame:
    """(key, feature, phi). For each row the phi sum to its score minus the mean score of the background
    rows it was paired with.

    The differences along a path need no window: one aggregate per row and feature, combined before the shuffle.
    """
    parts = _path_differences(model, shapley_paths(rows, background, features, key, n_background, permutations, seed), key, [])
    return (
        parts.groupBy(key, "f")
        .agg((F.sum("v") / permutations).alias("phi"))
        .select(key, _name_of(features), "phi")
    )


def _path_differences(model: PipelineModel, paths: DataFrame, key: str, by: list[str]) -> DataFrame:
    """(key, by…, f, v): each scored mix adds to the feature taken last and subtracts from the one taken next."""
    scored = model.transform(paths).select(key, *by, "_order", "_step", vector_to_array("probability")[1].alias("_score"))
    last = F.struct(F.try_element_at("_order", F.nullif("_step", F.lit(0))).alias("f"), F.col("_score").alias("v"))
    following = F.struct(F.try_element_at("_order", F.col("_step") + 1).alias("f"), (-F.col("_score")).alias("v"))
    return scored.select(key, *by, F.inline(F.array(last, following))).where(F.col("f").isNotNull())


def _name_of(features: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(c) for c in features]), F.col("f")).alias("feature")


def shapley_with_error(
    model: PipelineModel, rows: DataFrame, background: DataFrame, features: list[str], key: str, n_background: int,
    pairs: int = 4, seed: int = SEED,
) -> DataFrame:
    """(key, feature, phi, std_error, n_pairs): attributions from ``pairs`` antithetic pairs of orders.

    The standard error is that of the mean over pairs, which are drawn independently: it says how far phi may still be
    from its limit. The phi of a row still sum to its score minus the mean score of its background rows.
    """
    paths = shapley_paths(rows, background, features, key, n_background, 2 * pairs, seed, antithetic=True)
    paths = paths.withColumn("_pair", F.floor(F.col("_perm") / 2))
    per_pair = _path_differences(model, paths, key, ["_pair"]).groupBy(key, "f", "_pair").agg((F.sum("v") / 2).alias("v"))
    found = per_pair.groupBy(key, "f").agg(F.avg("v").alias("phi"), (F.stddev_samp("v") / F.sqrt(F.count("*"))).alias("std_error"), F.count("*").alias("n_pairs"))
    return found.select(key, _name_of(features), "phi", F.coalesce("std_error", F.lit(0.0)).alias("std_error"), "n_pairs")


def shapley_until(
    model: PipelineModel, rows: DataFrame, background: DataFrame, features: list[str], key: str, n_background: int,
    tolerance: float, pairs: int = 4, most: int = 64, seed: int = SEED,
) -> DataFrame:
    """:func:`shapley_with_error`, with twice the pairs for the rows whose largest error is above ``tolerance`` until none
    is or ``most`` pairs were drawn. Rows that are exact enough are not scored again."""
    done, left = None, materialise(rows.select(key, *features))
    while True:
        found = materialise(shapley_with_error(model, left, background, features, key, n_background, pairs, seed))
        rough = materialise(found.groupBy(key).agg(F.max("std_error").alias("_worst")).where(F.col("_worst") > tolerance).select(key))
        if 2 * pairs > most or rough.isEmpty():
            return found if done is None else done.unionByName(found)
        ready = sized_join(found, rough, [key], "left_anti")
        done = ready if done is None else done.unionByName(ready)
        left, pairs = materialise(sized_join(left, rough, [key], "left_semi")), 2 * pairs


def shapley_summary(values: DataFrame) -> DataFrame:
    """Mean absolute attribution per feature, highest first."""
    return (
        values.groupBy("feature")
        .agg(F.avg(F.abs("phi")).alias("mean_abs_phi"), F.avg("phi").alias("mean_phi"), F.count("*").alias("n_rows"))
        .orderBy(F.desc("mean_abs_phi"), "feature")
    )
