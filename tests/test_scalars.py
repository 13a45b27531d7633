import pytest
from pyspark.sql import functions as F

from ambar.fixed import ATTENDANCE_EDGES, ATTENDANCE_LABELS, RISK_EDGES, RISK_LABELS
from ambar.functions import scalars


def values(spark, column, kind, *items):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(column).collect()]


def test_attendance_bins_are_right_closed_and_open_at_zero(spark):
    got = values(
        spark, scalars.cut("v", ATTENDANCE_EDGES, ATTENDANCE_LABELS), "double",
        None, 0.0, 0.5, 0.50001, 0.7, 0.85, 0.95, 1.0, 1.01,
    )
    assert got == ["nan", "nan", "muito_baixa", "baixa", "baixa", "media", "boa", "excelente", "nan"]


def test_left_closed_bins_and_own_missing_label(spark):
    got = values(spark, scalars.cut("v", [0, 1, 2], ["a", "b"], right=False, missing=None), "double", 0.0, 1.0, 2.0)
    assert got == ["a", "b", None]


def test_bins_need_one_label_per_interval():
    with pytest.raises(ValueError):
        scalars.cut("v", [0, 1, 2], ["a"])


def test_risk_bands_are_left_closed(spark):
    got = values(
        spark, scalars.bands("v", RISK_EDGES, RISK_LABELS), "double", 0.0, 0.29, 0.3, 0.5, 0.7, 0.9, 1.0, None
    )
    assert got == ["critico", "critico", "alto", "medio", "baixo", "minimo", "minimo", None]


def test_missing_rate_is_not_reached(spark):
    assert values(spark, scalars.threshold_label("v", 80), "double", None, 79.99, 80.0) == [0, 0, 1]


def test_undefined_ratios(spark):
    assert values(spark, scalars.ratio(F.col("v"), F.lit(0)), "double", 1.0) == [0.0]
    assert values(spark, scalars.share(F.col("v"), F.lit(0)), "double", 1.0) == [None]


def test_state_code_of_text_and_number(spark):
    assert values(spark, scalars.state_code("v"), "long", 1100015) == ["11"]
    assert values(spark, scalars.state_code("v"), "string", "2304400") == ["23"]


def test_hash_has_the_published_value(spark):
    assert values(spark, scalars.hash32("v", 42), "long", 7) == [1409445407]


def test_nan_becomes_missing(spark):
    assert values(spark, scalars.no_nan("v"), "double", float("nan"), 1.0) == [None, 1.0]
