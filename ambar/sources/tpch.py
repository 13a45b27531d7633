"""The domain tables as views over the given star-schema tables.

``orders`` plays the pupil file: an order is a pupil's record of one edition (year), the customer is
the pupil, the nation the municipality and the market segment the network. See FIXTURES.md.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ambar.fixed import LEVELS
from ambar.functions.scalars import state_code
from ambar.sources.tables import read_table

TRAIN_YEAR, TEST_YEAR = 1999, 2000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def alunos(spark: SparkSession, sf_dir: str, years: tuple[int, int] | None = None) -> DataFrame:
    """Pupil records. ``years`` (first, last) becomes a date range that reaches the Parquet scan."""
    orders = table(spark, sf_dir, "orders")
    if years:
        first, last = years
        orders = orders.where(
            (F.col("o_orderdate") >= F.lit(f"{first}-01-01 00:00:00").cast("timestamp_ntz"))
            & (F.col("o_orderdate") < F.lit(f"{last + 1}-01-01 00:00:00").cast("timestamp_ntz"))
        )
    pupils = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", "c_mktsegment", "n_nationkey", "n_regionkey")
    )
    key = F.col("o_orderkey")
    presence = (
        F.when(key % 97 == 0, F.lit(None).cast("double"))
        .when(key % 89 == 0, F.lit(0.0))
        .otherwise(F.col("o_totalprice") / 5e5)
    )
    municipality = F.concat(
        (F.col("n_regionkey") + 11).cast("string"), F.lpad(F.col("n_nationkey").cast("string"), 5, "0")
    )
    return (
        orders.join(pupils, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            key.alias("id_registro"),
            F.col("o_custkey").alias("id_aluno"),
            F.year("o_orderdate").cast("int").alias("ano"),
            municipality.alias("id_municipio"),
            (F.col("n_nationkey") * 10 + F.col("o_custkey") % 10).cast("bigint").alias("id_escola"),
            F.col("c_mktsegment").alias("rede"),
            F.lit(2).alias("serie"),
            F.substring("o_orderpriority", 1, 1).cast("int").alias("caderno"),
            presence.alias("presenca"),
        )
        .withColumn(
            "proficiencia",
            F.lit(640) + ((F.col("id_registro") * 7919) % 1000) * F.lit(0.2) + 86 * F.coalesce("presenca", F.lit(0.0)),
        )
        .withColumn("alfabetizado", F.when(F.col("proficiencia") >= 743, 1).otherwise(0))
    )


def indicadores(pupils: DataFrame) -> DataFrame:
    """Municipality × network × year: literacy rate, mean score and the share of each score level."""
    level = F.least(F.lit(8), F.greatest(F.lit(0), F.floor((F.col("proficiencia") - 640) / 32)))
    return pupils.groupBy("id_municipio", "rede", "ano").agg(
        (100 * F.avg("alfabetizado")).alias("taxa_alfabetizacao"),
        F.avg("proficiencia").alias("media_portugues"),
        *[(100 * F.avg(F.when(level == i, 1).otherwise(0))).alias(name) for i, name in enumerate(LEVELS)],
    )


def features_ml(indicators: DataFrame) -> DataFrame:
    """The indicator table with state code and the sums of the low and the high levels."""
    return indicators.select(
        "*",
        state_code("id_municipio").alias("codigo_uf"),
        sum((F.col(c) for c in LEVELS[1:4]), F.col(LEVELS[0])).alias("soma_niveis_basicos"),
        sum((F.col(c) for c in LEVELS[5:]), F.col(LEVELS[4])).alias("soma_niveis_avancados"),
    )


def metas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State targets in long form: a 2024 and a 2030 target, each missing for one state."""
    region = table(spark, sf_dir, "region")
    code = (F.col("r_regionkey") + 11).cast("string").alias("sigla_uf")
    near = region.where("r_regionkey <> 0").select(
        code, F.lit(2024).alias("ano_meta"), (F.col("r_regionkey") * 2 + 60).cast("double").alias("meta")
    )
    far = region.where("r_regionkey <> 4").select(code, F.lit(2030).alias("ano_meta"), F.lit(80.0).alias("meta"))
    return near.unionByName(far)


def scored(pupils: DataFrame, cut: float = 0.5) -> DataFrame:
    """A frame ready for evaluation, with attendance as the score of literacy."""
    return (
        pupils.where(F.col("presenca").isNotNull())
        .withColumn("score", F.col("presenca"))
        .withColumn("label", F.col("alfabetizado"))
        .withColumn("prediction", F.when(F.col("presenca") >= cut, 1).otherwise(0))
    )
