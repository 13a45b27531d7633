"""What several of the operators share: reading tables, folds, words, Arrow batches and stored intermediates."""

from __future__ import annotations

import re
import string
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ambar.session import checkpoint_dir, prepare

# What counts as a word of a text, for Python and for Spark's and DuckDB's patterns alike.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"

find_words = re.compile(WORD).findall
LOWER_ASCII = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)

# Bytes of one Arrow batch on the way to a Python worker: bounds its memory whatever the texts' lengths
# (a single longer text still travels in one batch).
ARROW_BYTES = "8m"


def setup(spark: SparkSession) -> SparkSession:
    """The library's settings, and Arrow batches bounded in bytes."""
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    return prepare(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return setup(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: str | Column, n: int) -> Column:
    """crc32 of the key as text, modulo n. A missing key counts as the empty text."""
    column = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")), F.lit(n)).cast("int")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """A text column of a batch; a missing text is empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


def map_batches(df: DataFrame, make, schema: str) -> DataFrame:
    """``make(batches)`` over the Arrow batches of each partition, which yields record batches of ``schema``."""
    return df.mapInArrow(make, schema)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)


def bounded_sample(df: DataFrame, rows: int, seed: int = 42) -> DataFrame:
    """Up to about ``rows`` rows of ``df``, drawn evenly; all of them where there are no more than that."""
    total = df.count()
    return df if total <= rows else df.sample(fraction=rows / total, seed=seed)


class Memo(dict):
    """Remembered results of ``make(key)``, forgotten all at once when there are too many."""

    def __init__(self, make, limit: int = 400_000):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.make(key)
        return value


def kept_once(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: later readers don't compute it again."""
    path = f"{checkpoint_dir(df.sparkSession)}/llm-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def apart(df: DataFrame):
    """``df`` with its columns under numbered names, those names by the columns' own, and what puts the columns back.

    A stage that returns its input rows as they are works on these, so that no column of the input can clash with its own.
    """
    names = {c: f"_in{i}" for i, c in enumerate(df.columns)}

    def restored(out: DataFrame) -> DataFrame:
        return out.select(*[F.col(n).alias(c) for c, n in names.items()])

    return df.toDF(*names.values()), names, restored


def flat(arrays: list[np.ndarray], dtype) -> np.ndarray:
    return np.concatenate(arrays).astype(dtype, copy=False) if arrays else np.empty(0, dtype)


def batches_by_bytes(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of ``column`` at most, one row at least."""
    for batch in batches:
        size = max(1, batch.column(column).nbytes)
        step = max(1, int(batch.num_rows * limit / size))
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)
