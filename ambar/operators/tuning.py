"""Randomised search over the booster's parameters."""

from __future__ import annotations

import random
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ambar.fixed import PRESETS, SEARCH_DRAWS, SEARCH_FOLDS, SEARCH_SPACE, SEED
from ambar.operators.boosting import fitted_model, held_out_areas, packed
from ambar.operators.models import booster, gathered
from ambar.operators.prep import BinModel, TabularModel, TabularPreprocessor, fit_bins
from ambar.session import small_frame, stored


def draw_candidates(space: dict[str, list], draws: int, seed: int) -> list[dict]:
    """Distinct parameter combinations drawn at random."""
    rng, seen = random.Random(seed), []
    size = 1
    for options in space.values():
        size *= len(options)
    while len(seen) < min(draws, size):
        pick = {name: rng.choice(options) for name, options in space.items()}
        if pick not in seen:
            seen.append(pick)
    return seen


# Drawn by the reference space but without effect here: the booster has no such penalties.
NOT_APPLIED = ("reg_alpha", "reg_lambda")
HELD = "held_back"
ROWS = "n_rows"
# Where a search has more cells than trees are grown on in one task, Spark's own trees are fitted on them. For these, rows of one
# cell are dealt over so many parts, so that a subsample draws some of them and not all or none.
PARTS = 16
MOST_CELLS, MOST_WIDTH = 200_000, 4_096


def cells(df: DataFrame, bins: BinModel, label: str, features: list[str], held: Column, parts: int = PARTS) -> DataFrame:
    """Rows of equal label and binned features, counted: as many as there are such combinations at most, times ``parts``."""
    part = F.when(held, 0).otherwise(F.pmod(F.xxhash64(*df.columns), F.lit(parts))) if parts > 1 else F.lit(0)
    keyed = bins.transform(df.withColumns({HELD: held, "_part": part}))
    return keyed.groupBy(label, *features, HELD, "_part").agg(F.count("*").cast("double").alias(ROWS)).drop("_part")


def preprocessed(folded: DataFrame, prep: TabularPreprocessor, held: Column) -> tuple[BinModel, TabularModel]:
    """Bins and preprocessor fitted on the rows that aren't held back."""
    train = folded.where(~held)
    bins = fit_bins(train, prep.numeric)
    return bins, prep.fit(bins.transform(train))


def vectors_of(folded: DataFrame, bins: BinModel, fitted: TabularModel, label: str, held: Column) -> DataFrame:
    """The vectors of all cells with their rows."""
    table = stored(cells(folded, bins, label, [*fitted.numeric, *fitted.categorical], held))
    return gathered(stored(fitted.transform(table).select(label, "features", ROWS, HELD), [HELD]))


def prepared(folded: DataFrame, label: str, prep: TabularPreprocessor, held: Column) -> tuple[BinModel, TabularModel, DataFrame]:
    """Bins and preprocessor fitted on the rows that aren't held back, and the vectors of all cells with their rows."""
    bins, fitted = preprocessed(folded, prep, held)
    return bins, fitted, vectors_of(folded, bins, fitted, label, held)


def counted(folded: DataFrame, label: str, prep: TabularPreprocessor, held: Column) -> tuple[BinModel, TabularModel, DataFrame, int]:
    """Bins and preprocessor as above, all cells by their scaled numbers and category indices with the rows to fit and the
    rows held back of either label, and how many cells these are."""
    bins, fitted = preprocessed(folded, prep, held)
    table = fitted.transform(cells(folded, bins, label, [*fitted.numeric, *fitted.categorical], held, parts=1))
    values = [F.col(f"`{c}__num`").alias(f"v{i}") for i, c in enumerate(fitted.numeric)]
    values += [F.col(f"`{c}__idx`").alias(f"v{i}") for i, c in enumerate(fitted.categorical, len(fitted.numeric))]
    rows = [
        F.sum(F.when((F.col(HELD) == kept) & (F.col(label) == y), F.col(ROWS)).otherwise(0.0)).alias(f"n{y}_{int(kept)}")
        for kept in (False, True) for y in (0, 1)
    ]
    other = F.sum(F.when(F.col(label).isin(0, 1), 0.0).otherwise(F.col(ROWS))).alias("other")
    table = stored(table.groupBy(*values).agg(*rows, other))
    size, bad = table.agg(F.count("*"), F.sum("other")).first()
    if not size:
        raise ValueError("no rows to fit")
    if bad:
        raise ValueError(f"{int(bad)} rows have a {label} that is neither 0 nor 1")
    return bins, fitted, table.drop("other"), size


def random_search(
    folded: DataFrame,
    label: str,
    prep: TabularPreprocessor,
    preset: str = "melhorado",
    space: dict[str, list] = SEARCH_SPACE,
    draws: int = SEARCH_DRAWS,
    folds: int = SEARCH_FOLDS,
    fold: str = "fold",
    seed: int = SEED,
    parallelism: int = 8,
    early_stop: float | None = None,
    rungs: int = 1,
    most_cells: int = MOST_CELLS,
    **overrides,
) -> tuple[PipelineModel, DataFrame]:
    """Best model refitted on all rows, and the candidates ranked by mean AUC over folds, as they were fitted.

    Draws are distinct in the parameters that have an effect and that ``overrides`` leaves open. Every candidate is fitted
    with all its trees on the rows of the other folds and scored on those of each fold. The preprocessor is fitted once
    per fold and shared by all candidates.

    Numbers are binned once per fold, as finely as the booster bins them itself, and rows that agree in label and all
    features are counted. All rows count, but fits read no more than there are combinations, however many rows there are:
    each is one task, side by side with the others (:mod:`ambar.operators.boosting`). With more than ``most_cells``
    combinations in a fold, Spark's own booster fits the combinations with their rows as weights, ``parallelism`` at a time;
    there a subsample draws parts of such cells, and ``min_child_weight`` counts them.

    Two ways to spend less, both off unless asked for: with ``early_stop`` a fit adds trees until the loss of the rows
    that its fold holds back no longer falls by more than that share (0: until it rises). With more than one rung,
    candidates first get a fraction of their trees (a half per rung to go) and the better half of them goes on; those that
    dropped out rank behind, by their last area.
    """
    space = {name: options for name, options in space.items() if name not in NOT_APPLIED and name not in overrides}
    candidates, folded = draw_candidates(space, draws, seed), stored(folded, [fold])
    splits = [F.coalesce(held, F.lit(False)) for held in (*[F.col(fold) == i for i in range(folds)], F.lit(False))]
    with ThreadPool(len(splits)) as pool:
        parts = pool.map(lambda held: counted(folded, label, prep, held), splits, chunksize=1)
    fits = [(bins, fitted) for bins, fitted, _, _ in parts]
    if max(size for *_, size in parts) <= most_cells and max(fitted.width() for _, fitted in fits) <= MOST_WIDTH:
        engine = _OnCells(fits, [table for _, _, table, _ in parts], early_stop)
    else:
        with ThreadPool(len(splits)) as pool:
            vectors = pool.starmap(lambda fit, held: vectors_of(folded, *fit, label, held), zip(fits, splits), chunksize=1)
        engine = _OnVectors(label, vectors, early_stop, parallelism)

    def estimator(k: int, rung: int = rungs - 1) -> GBTClassifier:
        params = {**candidates[k], **overrides}
        trees = params.get("n_estimators", PRESETS[preset]["n_estimators"])
        return booster(preset, label, **{**params, "n_estimators": max(1, trees >> (rungs - 1 - rung))})

    alive, means, reached = list(range(len(candidates))), [0.0] * len(candidates), [0] * len(candidates)
    with engine:
        for rung in range(rungs):
            tasks = [(k, i) for k in alive for i in range(folds)]
            areas = dict(zip(tasks, engine.areas([(i, estimator(k, rung)) for k, i in tasks])))
            for k in alive:
                means[k], reached[k] = sum(areas[k, i] for i in range(folds)) / folds, rung
            alive = sorted(alive, key=lambda k: -means[k])[: max(1, -(-len(alive) // 2))]
    order = sorted(range(len(means)), key=lambda k: (-reached[k], -means[k]))
    names = [*space, *overrides]
    rows = [
        (rank + 1, means[k], *[float({**candidates[k], **overrides}[name]) for name in names]) for rank, k in enumerate(order)
    ]
    fields = [T.StructField("rank", T.IntegerType()), T.StructField("mean_auc", T.DoubleType())]
    schema = T.StructType(fields + [T.StructField(name, T.DoubleType()) for name in names])
    best = engine.model(estimator(order[0]))
    return PipelineModel([*fits[-1], best]), small_frame(folded.sparkSession, rows, schema)


class _OnCells:
    """Fits on counted cells, one a task. The last split holds nothing back."""

    def __init__(self, fits, tables, early_stop):
        self.sizes = [[fitted.sizes[c] for c in fitted.categorical] for _, fitted in fits]
        self.width, self.early_stop = fits[-1][1].width(), early_stop
        rows = [packed(i, table) for i, table in enumerate(tables)]
        self.cells = stored(reduce(DataFrame.unionByName, rows))

    def areas(self, tasks: list[tuple[int, GBTClassifier]]) -> list[float]:
        return held_out_areas(self.cells, self.sizes, tasks, self.early_stop)

    def model(self, est: GBTClassifier) -> GBTClassificationModel:
        return fitted_model(self.cells, len(self.sizes) - 1, self.sizes, self.width, est)

    def __enter__(self):
        return self

    def __exit__(self, *_) -> None:
        pass


class _OnVectors:
    """Fits by Spark's booster on weighted vectors, several at a time. The last split holds nothing back."""

    def __init__(self, label, vectors, early_stop, parallelism):
        self.label, self.vectors, self.early_stop, self.parallelism = label, vectors, early_stop, parallelism
        self.evaluator = BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC", numBins=0, weightCol=ROWS)

    def __enter__(self):
        whole = self.early_stop is not None
        self.shared = [(v.where(F.col(HELD)).persist(), (v if whole else v.where(~F.col(HELD))).persist()) for v in self.vectors[:-1]]
        return self

    def __exit__(self, *_) -> None:
        for pair in self.shared:
            for frame in pair:
                frame.unpersist()

    def areas(self, tasks: list[tuple[int, GBTClassifier]]) -> list[float]:
        def area(split: int, est: GBTClassifier) -> float:
            held_out, rows = self.shared[split]
            est = est.setWeightCol(ROWS)
            if self.early_stop is not None:
                est = est.setValidationIndicatorCol(HELD).setParams(validationTol=self.early_stop)
            return self.evaluator.evaluate(est.fit(rows).transform(held_out))

        with ThreadPool(self.parallelism) as pool:
            return pool.starmap(area, tasks, chunksize=1)

    def model(self, est: GBTClassifier) -> GBTClassificationModel:
        return est.setWeightCol(ROWS).fit(self.vectors[-1])
