"""End-to-end flows: from tables to scored frames, every step a DataFrame or a pyspark.ml stage.

Keyword arguments go on to the fit: ``fraction`` for a stratified sample of the pupils (needs the key
``id_registro``), ``fill`` for missing categories, and any preset parameter.

A fitted flow cross-fits on demand: every train row is scored by a fold model that hasn't seen it, once, into a stored
table. Validation, the tuned cut, bands and alerts all read that table.
"""

from __future__ import annotations

from multiprocessing.pool import ThreadPool
from threading import RLock

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ambar.fixed import AGGREGATE_FEATURES, CV_FOLDS, ID_COLUMNS, PUPIL_FEATURES, TARGET_RATE
from ambar.functions.scalars import threshold_label
from ambar.operators import columns, context, evaluate, lookup, models, splits
from ambar.session import stored
from ambar.sources.samples import stratified_sample


class Fitted:
    """A model with the rows it is fitted on, the rows held out, and the label's name.

    The model is fitted when it is first asked for, or beside the fold models: a fit alone leaves most cores idle. ``context`` is the stage that made the features of the flow's raw rows, if there is one; ``key`` tells rows apart.
    """

    def __init__(
        self, train: DataFrame, test: DataFrame, label: str, pipeline: Pipeline, key: str | Column,
        context: lookup.StoredContext | None = None,
    ):
        self.train, self.test, self.label = train, test, label
        self.pipeline, self.key, self.context = pipeline, key, context
        self._fitting = RLock()
        self._model: PipelineModel | None = None
        self._out_of_fold: DataFrame | None = None
        self._cut: float | None = None

    @property
    def model(self) -> PipelineModel:
        with self._fitting:
            if self._model is None:
                self._model = models.fit(self.pipeline, self.train)
            return self._model

    def scored(self, split: str = "test") -> DataFrame:
        return models.score(self.model, self.train if split == "train" else self.test, self.label)

    def whole(self) -> PipelineModel:
        """The model with its context, for rows that are not part of the flow (another edition, after loading)."""
        return PipelineModel([*([self.context] if self.context else []), *self.model.stages])

    def out_of_fold(self, folds: int = CV_FOLDS) -> DataFrame:
        """The train rows with scores of models that haven't seen them, and their ``fold``. Stored on the first call."""
        if self._out_of_fold is None:
            with ThreadPool(1) as pool:
                whole = pool.apply_async(lambda: self.model)
                folded = splits.stratified_folds(self.train, self.label, self.key, folds)
                found = models.cross_fit(self.pipeline, folded, self.label, folds=folds)
                whole.get()
            self._out_of_fold = found
        return self._out_of_fold

    def cross_validation(self) -> DataFrame:
        """Area under the ROC curve of each fold."""
        return evaluate.roc_auc(self.out_of_fold(), ["fold"])

    def cut(self) -> float:
        """The cut of the best accuracy on the out-of-fold scores: no row that is reported takes part in choosing it."""
        if self._cut is None:
            self._cut = evaluate.best_threshold(self.out_of_fold()).first()["threshold"]
        return self._cut

    def at_cut(self, split: str = "test") -> DataFrame:
        """The scored rows with predictions at the tuned cut."""
        return evaluate.apply_cut(self.scored(split), self.cut())


def side_by_side(steps: list) -> list:
    """The results of functions without arguments, which run at the same time."""
    with ThreadPool(len(steps)) as pool:
        return pool.map(lambda step: step(), steps, chunksize=1)


def _fit(
    frame: DataFrame, label: str, train: int, test: int, preset: str, not_features: list[str],
    fraction: float | None = None, key: str | Column = "id_registro", context: lookup.StoredContext | None = None, **overrides,
) -> Fitted:
    """Store the frame by edition, to be fitted on the train edition, on a sample by class of it if a fraction is given."""
    # Fitting reads the frame many times, so it is built once and stored by edition.
    table = stored(frame.where(F.col("ano").isin(train, test)), ["ano"])
    train_rows, test_rows = splits.temporal_split(table, "ano", train, test)
    if fraction is not None:  # of the rows to fit only: all test rows stay
        train_rows = stored(stratified_sample(train_rows, label, {0: fraction, 1: fraction}, "id_registro"))
    features = [c for c in train_rows.columns if c != label and c not in not_features]
    pipeline = models.build_pipeline(train_rows, preset, label, features, **overrides)
    return Fitted(train_rows, test_rows, label, pipeline, key, context)


def aggregate_flow(features: DataFrame, train: int, test: int, label: str = "meta_atingida", past: bool = False, **overrides) -> Fitted:
    """Will a municipality's network reach the target rate? Preset ``agregado``.

    The features are results of the same edition as the label. With ``past`` they are those of the edition before, so
    that nothing is used that is known only with the label.
    """
    labelled = features.withColumn(label, threshold_label("taxa_alfabetizacao", TARGET_RATE))
    keys = ["id_municipio"]
    frame = columns.select_existing(labelled, [*keys, *AGGREGATE_FEATURES, label])
    if past:
        same = ["id_municipio", "rede", "codigo_uf", "ano"]
        before = frame.drop(label).withColumn("ano", F.col("ano") + 1)
        before = before.withColumnsRenamed({c: f"{c}_anterior" for c in before.columns if c not in same})
        frame = frame.select(*same, label).join(before, same, "inner")
    return _fit(frame, label, train, test, "agregado", keys, fill="desconhecido", key=F.concat_ws("|", "id_municipio", "rede"), **overrides)


def pupil_frame(pupils: DataFrame, single_period: bool = True, label: str = "alfabetizado") -> DataFrame:
    """Leak-free pupil columns with ids, of pupils seen in one of the given editions only."""
    wanted = [label, "id_registro", "id_aluno", "id_escola", "id_municipio", "rede", *PUPIL_FEATURES]
    frame = columns.select_existing(pupils, wanted)
    return splits.single_period_entities(frame, "id_aluno", "ano") if single_period else frame


def pupil_flow(pupils: DataFrame, train: int, test: int, label: str = "alfabetizado", single_period: bool = True, **overrides) -> Fitted:
    """Will this pupil be literate? Preset ``individual`` on the leak-free columns."""
    return _fit(pupil_frame(pupils, single_period), label, train, test, "individual", ID_COLUMNS, **overrides)


def history_flow(
    pupils: DataFrame, indicators: DataFrame, train: int, test: int, mode: str = "lag", label: str = "alfabetizado",
    **overrides,
) -> Fitted:
    """The pupil model with past results of the municipality's network and of the state."""
    past = lookup.fit_history(indicators, mode, train if mode == "fixed" else None)
    return _fit(past.transform(pupil_frame(pupils)), label, train, test, "individual", ID_COLUMNS, context=past, **overrides)


def engineered_frame(pupils: DataFrame) -> tuple[DataFrame, lookup.StoredContext]:
    """Pupil columns with school and network context, powers, deviations and bins, and the stage that adds them.

    The pupils are stored and read twice: once for all group statistics, once to be joined with them. The school's
    literacy rate leaves out the pupil's own label. It still needs the labels of the others in the same edition; where
    these are not known yet, the stage takes the last known edition.
    """
    base = stored(pupil_frame(pupils))
    groups = lookup.fit_groups(base)
    return groups.transform(base), groups


def engineered_flow(pupils: DataFrame, train: int, test: int, label: str = "alfabetizado", **overrides) -> Fitted:
    """The pupil model with engineered features. Preset ``melhorado``."""
    frame, groups = engineered_frame(pupils)
    return _fit(frame, label, train, test, "melhorado", ID_COLUMNS, context=groups, **overrides)
