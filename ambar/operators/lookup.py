"""Fitted context: aggregate tables that are stored with a model and joined to any rows it scores.

A flow's features come from statistics of groups. To score rows that were not part of the flow (a new edition), these
statistics must travel with the model. ``StoredContext`` is a pipeline stage that holds them as Parquet tables: it can be
put before the preprocessor, saved and loaded with it, and its joins are broadcasts or spread shuffles by stored size.

A row of an edition that the tables don't hold uses the latest edition before its own. If there is none, group statistics
are those of the first edition, and lagged history is missing.
"""

from __future__ import annotations

import json

from pyspark.ml import Model
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ambar.functions.scalars import state_code
from ambar.operators.context import NETWORK_KEYS, SCHOOL_KEYS, interaction_features, state_means
from ambar.operators.joins import BROADCAST_BYTES, measured_bytes, salted_join
from ambar.session import materialise, stored

EDITION = "_edition"


class StoredContext(Model, MLWritable, MLReadable):
    """Tables by name, the keys each is joined on, and what makes features of them.

    ``kind`` is "groups" (:func:`fit_groups`) or "history" (:func:`fit_history`).
    """

    def __init__(self, kind: str = "groups", label: str = "alfabetizado", period: str = "ano"):
        super().__init__()
        self.kind, self.label, self.period = kind, label, period
        self.tables: dict[str, DataFrame] = {}
        self.keys: dict[str, list[str]] = {}
        self.broadcast: dict[str, bool] = {}
        self.editions: list[int] = []
        self.first_for_earlier = True

    def add(self, name: str, table: DataFrame, keys: list[str], limit_bytes: int = BROADCAST_BYTES) -> None:
        self.tables[name], self.keys[name] = table, keys
        self.broadcast[name] = measured_bytes(table) <= limit_bytes

    def joined(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` with the columns of a table; ``rows`` of a table counts the rows of its groups."""
        table, keys = self.tables[name], self.keys[name]
        if self.broadcast[name]:
            return df.join(F.broadcast(table.drop("rows")), keys, "left")
        counted = table.withColumnRenamed("rows", "_rows_of_group") if "rows" in table.columns else table
        rows_col = "_rows_of_group" if "rows" in table.columns else None
        return salted_join(df, counted, keys, "left", rows_col).drop("_rows_of_group")

    def edition_of(self) -> Column:
        """The known edition that serves a row's own."""
        period = F.col(self.period)
        out = F.when(period.isNull(), F.lit(None).cast("int"))
        for known in sorted(self.editions, reverse=True):
            out = out.when(period >= known, F.lit(known))
        return out.otherwise(F.lit(min(self.editions)) if self.editions and self.first_for_earlier else F.lit(None).cast("int"))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return _transform_groups(self, dataset) if self.kind == "groups" else _transform_history(self, dataset)

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


def fit_groups(base: DataFrame, label: str = "alfabetizado", limit_bytes: int = BROADCAST_BYTES) -> StoredContext:
    """Statistics of schools and of municipal networks per edition, both from one scan of ``base`` (grouping sets)."""
    period = SCHOOL_KEYS[-1]
    columns = list(dict.fromkeys([*SCHOOL_KEYS, *NETWORK_KEYS]))
    grouped = materialise(
        base.groupingSets([SCHOOL_KEYS, NETWORK_KEYS], *columns).agg(
            F.grouping(SCHOOL_KEYS[0]).alias("_by_network"),
            F.avg("presenca").alias("mean"), F.coalesce(F.stddev_samp("presenca"), F.lit(0.0)).alias("deviation"),
            F.count("*").alias("rows"), F.sum(label).alias("sum"), F.count(label).alias("known"),
        )
    )
    model = StoredContext("groups", label, period)
    school = grouped.where("_by_network = 0").select(
        SCHOOL_KEYS[0], F.col(period).alias(EDITION), "rows", F.col("mean").alias("escola_presenca_media"), F.col("deviation").alias("escola_presenca_std"),
        F.col("rows").alias("escola_num_alunos"), F.col("sum").alias("_label_sum"), F.col("known").alias("_label_known"),
    )
    network = grouped.where("_by_network = 1").select(
        *NETWORK_KEYS[:-1], F.col(period).alias(EDITION), "rows", F.col("mean").alias("mun_rede_presenca_media"), F.col("rows").alias("mun_rede_num_alunos"),
    )
    model.add("school", stored(school), [SCHOOL_KEYS[0], EDITION], limit_bytes)
    model.add("network", stored(network), [*NETWORK_KEYS[:-1], EDITION], limit_bytes)
    model.editions = [r[0] for r in grouped.where(F.col(period).isNotNull()).select(period).distinct().collect()]
    return model


def _transform_groups(model: StoredContext, df: DataFrame) -> DataFrame:
    """School and network statistics, the label rate of the row's school without the row, powers, deviations and bins.

    A row's own label is taken out only if its own edition is in the tables; a row without a label takes nothing out.
    """
    out = model.joined(model.joined(df.withColumn(EDITION, model.edition_of()), "school"), "network")
    if model.label in df.columns:
        inside = (F.col(EDITION) == F.col(model.period)) & F.col(model.label).isNotNull()
        own, counted = F.when(inside, F.col(model.label)).otherwise(0), F.when(inside, 1).otherwise(0)
    else:
        own = counted = F.lit(0)
    rate = F.try_divide((F.col("_label_sum") - own).cast("double"), F.col("_label_known") - counted)
    return interaction_features(out.withColumn("escola_taxa_loo", rate).drop(EDITION, "_label_sum", "_label_known"))


def fit_history(indicators: DataFrame, mode: str = "lag", year: int | None = None, lag: int = 1, limit_bytes: int = BROADCAST_BYTES) -> StoredContext:
    """Past results of municipal networks and of states, by the edition that they serve."""
    if mode == "fixed":
        past = indicators.where(F.col("ano") == year).withColumn(EDITION, F.lit(year))
    elif mode == "lag":
        past = indicators.withColumn(EDITION, F.col("ano") + lag)
    else:
        raise ValueError(f"unknown mode {mode!r}")
    past = materialise(past.select("id_municipio", "rede", EDITION, "taxa_alfabetizacao", "media_portugues").distinct())
    model = StoredContext("history")
    model.first_for_earlier = mode == "fixed"  # what is lagged must not come from later
    local = past.withColumnsRenamed({"taxa_alfabetizacao": "taxa_hist", "media_portugues": "media_hist"})
    model.add("municipality", stored(local), ["id_municipio", "rede", EDITION], limit_bytes)
    model.add("state", stored(state_means(past, ["sigla_uf", "rede", EDITION])), ["sigla_uf", "rede", EDITION], limit_bytes)
    model.editions = [r[0] for r in past.where(f"{EDITION} IS NOT NULL").select(EDITION).distinct().collect()]
    return model


def _transform_history(model: StoredContext, df: DataFrame) -> DataFrame:
    out = df.withColumn("sigla_uf", state_code("id_municipio")).withColumn(EDITION, model.edition_of())
    return model.joined(model.joined(out, "municipality"), "state").drop(EDITION)


class _Writer(MLWriter):
    def __init__(self, model: StoredContext):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        m = self.model
        schemas = {name: table.schema.json() for name, table in m.tables.items()}
        own = {"kind": m.kind, "label": m.label, "period": m.period, "keys": m.keys, "broadcast": m.broadcast, "editions": m.editions, "first_for_earlier": m.first_for_earlier, "schemas": schemas}
        DefaultParamsWriter.saveMetadata(m, path, self.sparkSession, extraMetadata={"context": json.dumps(own)})
        for name, table in m.tables.items():
            table.write.parquet(f"{path}/tables/{name}")


class _Reader(MLReader):
    def load(self, path: str) -> StoredContext:
        from pyspark.sql.types import StructType

        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        own = json.loads(metadata["context"])
        model = StoredContext(own["kind"], own["label"], own["period"])
        model._resetUid(metadata["uid"])
        model.keys, model.broadcast, model.editions, model.first_for_earlier = own["keys"], own["broadcast"], own["editions"], own["first_for_earlier"]
        for name, schema in own["schemas"].items():
            model.tables[name] = self.sparkSession.read.schema(StructType.fromJson(json.loads(schema))).parquet(f"{path}/tables/{name}")
        return model
