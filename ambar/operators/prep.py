"""Preprocessing fitted on train rows: exact median and constant imputation, scaling, one-hot, vectors.

Categories are encoded by a stored dictionary, a table of (column, value, index) that is ranked and kept distributed, so a
column may have any number of them. Their values never come to the driver: rows meet their indices in a join that is a
broadcast where the dictionary is small and spreads hot values where it isn't.
"""

from __future__ import annotations

import json
import uuid

from pyspark.ml import Estimator, Model
from pyspark.ml.feature import OneHotEncoder, OneHotEncoderModel, VectorAssembler
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ambar.operators.joins import BROADCAST_BYTES, measured_bytes, salted_join
from ambar.operators.running import exact_quantiles, running_totals
from ambar.session import checkpoint_dir, small_frame, stored


def medians(train: DataFrame, columns: list[str]) -> dict[str, float]:
    """Exact interpolated median per column; 0 for a column without values."""
    found = {r["column"]: r["q0"] for r in exact_quantiles(train, columns, [0.5]).collect()} if columns else {}
    return {c: found.get(c, 0.0) for c in columns}


def impute_median(train: DataFrame, df: DataFrame, columns: list[str]) -> DataFrame:
    """Fill missing numbers with the train median."""
    fill = medians(train, columns)
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(fill[c])) for c in columns})


def impute_constant(df: DataFrame, columns: list[str], value: str = "missing") -> DataFrame:
    """Fill missing categories with a constant."""
    return df.fillna(value, subset=columns)


def scale_stats(train: DataFrame, columns: dict[str, Column]) -> dict[str, tuple[float, float]]:
    """(mean, population deviation) per column; the deviation of a constant column is taken as 1."""
    if not columns:
        return {}
    aggregates = []
    for i, c in enumerate(columns.values()):
        aggregates += [F.avg(c).alias(f"m{i}"), F.stddev_pop(c).alias(f"s{i}")]
    row = train.agg(*aggregates).first()
    return {name: (row[f"m{i}"] or 0.0, row[f"s{i}"] or 1.0) for i, name in enumerate(columns)}


def standard_scale(train: DataFrame, df: DataFrame, columns: list[str], suffix: str = "_scaled") -> DataFrame:
    """Centre and scale with train statistics."""
    stats = scale_stats(train, {c: F.col(c).cast("double") for c in columns})
    return df.withColumns({f"{c}{suffix}": (F.col(c) - F.lit(stats[c][0])) / F.lit(stats[c][1]) for c in columns})


def category_dictionary(train: DataFrame, columns: list[str], fill: str | None = None) -> DataFrame:
    """(column, value, index, n): each column's distinct values as text, numbered from 0 in their order, and their rows.

    Missing values count as ``fill``, or not at all. Values are counted with map-side combination and numbered in even
    range slices; the table is stored by column.
    """
    text = [F.col(f"`{c}`").cast("string") for c in columns]
    filled = [t if fill is None else F.coalesce(t, F.lit(fill)) for t in text]
    entries = F.array(*[F.struct(F.lit(c).alias("column"), v.alias("value")) for c, v in zip(columns, filled)])
    counted = train.select(F.inline(entries)).where("value IS NOT NULL").groupBy("column", "value").agg(F.count("*").alias("n"))
    ranked = running_totals(counted.withColumn("one", F.lit(1)), ["value"], ["one"], ["column"])
    return stored(ranked.select("column", "value", (F.col("one_run") - 1).cast("long").alias("index"), "n"), ["column"])


def dictionary_sizes(dictionary: DataFrame) -> dict[str, int]:
    """Number of values of each column."""
    return {r["column"]: r["count"] for r in dictionary.groupBy("column").count().collect()}


def index_categories(df: DataFrame, dictionary: DataFrame, column: str, size: int, out: str, broadcast: bool, fill: str | None = None) -> DataFrame:
    """Add the index of ``column``'s value; ``size``, one more than the last index, for a value that isn't known."""
    key = f"__{out}_value"
    side = dictionary.where(F.col("column") == column).select(F.col("value").alias(key), F.col("index").alias(f"__{out}"), "n")
    value = F.col(f"`{column}`").cast("string")
    keyed = df.withColumn(key, value if fill is None else F.coalesce(value, F.lit(fill)))
    if broadcast:
        met = keyed.join(F.broadcast(side.drop("n")), key, "left")
    else:
        met = salted_join(keyed, side.withColumnRenamed("n", f"__{out}_n"), [key], "left", rows_col=f"__{out}_n").drop(f"__{out}_n")
    return met.withColumn(out, F.coalesce(f"__{out}", F.lit(size)).cast("double")).drop(key, f"__{out}")


def one_hot(train: DataFrame, df: DataFrame, column: str) -> DataFrame:
    """One 0/1 column per train category, named ``<column>_<value>``; unseen categories are all zeros.

    Column names are part of a plan, so this form is for columns of few categories. :func:`one_hot_vector` takes any number.
    """
    values = [r["value"] for r in category_dictionary(train, [column]).orderBy("value").select("value").collect()]
    return df.withColumns({f"{column}_{v}": F.coalesce((F.col(column) == v).cast("int"), F.lit(0)) for v in values})


def one_hot_vector(train: DataFrame, df: DataFrame, column: str, out: str | None = None) -> tuple[DataFrame, DataFrame]:
    """A sparse 0/1 vector per row, and the dictionary (value, index) that names its entries."""
    out = out or f"{column}_hot"
    model = TabularPreprocessor([], [column], output=out).fit(train)
    return model.transform(df), model.names().select(F.col("position").alias("index"), F.col("feature"))


class TabularPreprocessor(Estimator):
    """Numeric branch (median, scaling) and categorical branch (constant, one-hot) into one vector.

    Other columns stay out of the vector. Statistics come from the rows it is fitted on, hence inside cross-validation
    from the training folds alone. Categories have no limit.
    """

    def __init__(self, numeric: list[str], categorical: list[str], fill: str = "missing", output: str = "features", limit_bytes: int | None = None):
        super().__init__()
        self.numeric, self.categorical = list(numeric), list(categorical)
        self.fill, self.output = fill, output
        self.limit_bytes = BROADCAST_BYTES if limit_bytes is None else limit_bytes

    def _fit(self, dataset: DataFrame) -> TabularModel:
        clean = {c: F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")) for c in self.numeric}
        fill = medians(dataset, self.numeric)
        scales = scale_stats(dataset, {c: F.coalesce(v, F.lit(fill[c])) for c, v in clean.items()})
        model = TabularModel(self.numeric, self.categorical, self.fill, self.output)
        model.numbers = {c: [fill[c], *scales[c]] for c in self.numeric}
        if self.categorical:
            model.dictionary = category_dictionary(dataset, self.categorical, self.fill)
            found = dictionary_sizes(model.dictionary)
            model.sizes = {c: found.get(c, 0) for c in self.categorical}
            model.broadcast = measured_bytes(model.dictionary) <= self.limit_bytes
            model.encoder = fixed_encoder(dataset.sparkSession, model.sizes)
        return model


def fixed_encoder(spark, sizes: dict[str, int]) -> OneHotEncoderModel:
    """An encoder of as many entries as each column has categories. The index of unknown ones, behind the last, gives zeros."""
    schema = T.StructType([T.StructField(f"{c}__idx", T.DoubleType()) for c in sizes])
    last = small_frame(spark, [tuple(float(n) for n in sizes.values())], schema)
    return OneHotEncoder(inputCols=schema.names, outputCols=[f"{c}__hot" for c in sizes], dropLast=True).fit(last)


class TabularModel(Model, MLWritable, MLReadable):
    """The fitted preprocessor: statistics of numbers, and the dictionary of categories with its encoder."""

    def __init__(self, numeric=(), categorical=(), fill: str = "missing", output: str = "features"):
        super().__init__()
        self.numeric, self.categorical, self.fill, self.output = list(numeric), list(categorical), fill, output
        self.numbers: dict[str, list[float]] = {}
        self.sizes: dict[str, int] = {}
        self.broadcast = True
        self.dictionary: DataFrame | None = None
        self.encoder: OneHotEncoderModel | None = None

    def _transform(self, dataset: DataFrame) -> DataFrame:
        added = {}
        for c, (fill, mean, deviation) in self.numbers.items():
            value = F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double"))
            added[f"{c}__num"] = (F.coalesce(value, F.lit(fill)) - F.lit(mean)) / F.lit(deviation)
        out = dataset.withColumns(added) if added else dataset
        for c in self.categorical:
            out = index_categories(out, self.dictionary, c, self.sizes[c], f"{c}__idx", self.broadcast, self.fill)
        if self.categorical:
            out = self.encoder.transform(out)
        inputs = [f"{c}__num" for c in self.numeric] + [f"{c}__hot" for c in self.categorical]
        return VectorAssembler(inputCols=inputs, outputCol=self.output, handleInvalid="error").transform(out)

    def names(self) -> DataFrame:
        """(position, feature): the names of the vector's entries, ``column`` or ``column_value``."""
        from pyspark.sql import SparkSession

        spark = SparkSession.getActiveSession() if self.dictionary is None else self.dictionary.sparkSession
        schema = T.StructType([T.StructField("position", T.LongType()), T.StructField("feature", T.StringType())])
        out = small_frame(spark, [(i, c) for i, c in enumerate(self.numeric)], schema)
        start = len(self.numeric)
        for c in self.categorical:
            own = self.dictionary.where(F.col("column") == c)
            out = out.unionByName(own.select((F.col("index") + start).alias("position"), F.concat_ws("_", F.lit(c), "value").alias("feature")))
            start += self.sizes[c]
        return out

    def width(self) -> int:
        return len(self.numeric) + sum(self.sizes.values())

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, model: TabularModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        m = self.model
        own = {"numeric": m.numeric, "categorical": m.categorical, "fill": m.fill, "output": m.output, "numbers": m.numbers, "sizes": m.sizes, "broadcast": m.broadcast}
        DefaultParamsWriter.saveMetadata(m, path, self.sparkSession, extraMetadata={"tabular": json.dumps(own)})
        if m.categorical:
            m.dictionary.write.partitionBy("column").parquet(f"{path}/dictionary")
            m.encoder.save(f"{path}/encoder")


class _Reader(MLReader):
    def load(self, path: str) -> TabularModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        own = json.loads(metadata["tabular"])
        model = TabularModel(own["numeric"], own["categorical"], own["fill"], own["output"])
        model._resetUid(metadata["uid"])
        model.numbers, model.sizes, model.broadcast = own["numbers"], own["sizes"], own["broadcast"]
        if model.categorical:
            schema = "value string, index long, n long, column string"
            model.dictionary = self.sparkSession.read.schema(schema).parquet(f"{path}/dictionary")
            model.encoder = OneHotEncoderModel.load(f"{path}/encoder")
        return model


# As many bins as the booster makes of a number, but for one that is left for the value put in where it is missing.
BINS = 31


def fit_bins(train: DataFrame, numeric: list[str], bins: int = BINS) -> BinModel:
    """Upper ends of each number's bins, of about as many train rows each; a column of no more values than bins keeps all."""
    model, ends = BinModel(numeric), [i / bins for i in range(1, bins + 1)]
    clean = {c: F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")) for c in numeric}
    for c, value in clean.items():
        found = [r[0] for r in train.select(value.alias("value")).where("value IS NOT NULL").distinct().limit(bins + 1).collect()]
        if len(found) > bins:
            found = train.agg(F.percentile_approx(value, ends, 10_000)).first()[0]
        model.ends[c] = sorted(set(found))
    return model


class BinModel(Model, MLWritable, MLReadable):
    """Numbers as the upper end of their bin; beyond the last bin, as its end. Missing ones stay missing."""

    def __init__(self, numeric=()):
        super().__init__()
        self.ends: dict[str, list[float]] = {c: [] for c in numeric}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        added = {}
        for c, ends in self.ends.items():
            value = F.col(f"`{c}`").cast("double")
            out = F.when(value.isNull() | F.isnan(value), F.lit(None).cast("double"))
            for end in ends:
                out = out.when(value <= end, F.lit(end))
            added[c] = out.otherwise(F.lit(ends[-1] if ends else None).cast("double"))
        return dataset.withColumns(added) if added else dataset

    def write(self) -> MLWriter:
        return _BinWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _BinReader()


class _BinWriter(MLWriter):
    def __init__(self, model: BinModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession, extraMetadata={"bins": json.dumps(self.model.ends)})


class _BinReader(MLReader):
    def load(self, path: str) -> BinModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = BinModel()
        model._resetUid(metadata["uid"])
        model.ends = json.loads(metadata["bins"])
        return model


def new_path(spark, name: str) -> str:
    """A new folder for something that is saved, below the checkpoint folder."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
