"""Session settings and the one way the library cuts lineage."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Runtime settings the operators rely on. Splitting a hot join key is worth one more exchange.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the adaptive settings and make sure a reliable checkpoint folder is known."""
    for key, value in ADAPTIVE.items():
        spark.conf.set(key, value)
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for materialised intermediates.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session may fall back to a
    temporary folder, because there driver and executors are one process.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
            shared = tempfile.mkdtemp(prefix="ambar-checkpoint-")
        context.setCheckpointDir(shared)
    return context.getCheckpointDir()


def materialise(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and keep it in the checkpoint folder.

    Used where a result is read more than once and must be the same each time (range partition
    numbers), or where its size decides the next plan. Survives the loss of any executor.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once as a Parquet table in the checkpoint folder and read it back.

    For wide frames that many passes read (a feature table before training): later passes get column
    pruning, filter pushdown and, with ``partition_by``, partition pruning.
    """
    path = f"{checkpoint_dir(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.partitionBy(*(partition_by or [])).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def written(spark: SparkSession, path: str) -> bool:
    """Whether a Spark job has written ``path`` to its end."""
    files, where = _file_system(spark, f"{path}/_SUCCESS")
    return files.exists(where)


def remove(spark: SparkSession, path: str) -> None:
    """Delete an intermediate that nothing reads any more, wherever the checkpoint folder is."""
    files, where = _file_system(spark, path)
    files.delete(where, True)


def small_frame(spark: SparkSession, rows: list[tuple], schema: StructType) -> DataFrame:
    """A few driver-side rows (fitted statistics) as a local relation, without Python workers."""
    columns = {name: [row[i] for row in rows] for i, name in enumerate(schema.names)}
    return spark.createDataFrame(pa.table(columns), schema)


def local_session(cores: int | str = 8, partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A small session for tests and the benchmark."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("ambar")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
