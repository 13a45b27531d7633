import pytest
from pyspark.sql import functions as F

from ambar.operators import context

PUPILS = [
    (1, "1100001", "m", 10, 2023, 0.5, 1), (2, "1100001", "m", 10, 2023, 0.7, 0), (3, "1100001", "m", 10, 2023, None, 1),
    (4, "1100001", "e", 11, 2024, 0.9, 1), (5, "1200002", "m", 12, 2024, 1.0, 0),
]
INDICATORS = [
    ("1100001", "m", 2023, 50.0, 700.0), ("1100001", "e", 2023, 80.0, 750.0), ("1100001", "e", 2024, 85.0, 760.0),
    ("1200002", "m", 2023, None, 690.0), ("1100002", "m", 2023, 70.0, 720.0),
]


@pytest.fixture(scope="module")
def pupils(spark):
    return spark.createDataFrame(
        PUPILS, "id int, id_municipio string, rede string, id_escola int, ano int, presenca double, alfabetizado int"
    )


@pytest.fixture(scope="module")
def indicators(spark):
    return spark.createDataFrame(
        INDICATORS, "id_municipio string, rede string, ano int, taxa_alfabetizacao double, media_portugues double"
    )


@pytest.mark.parametrize("limit", [0, 10**9])
def test_school_statistics(pupils, limit):
    out = context.attach_group_stats(pupils, context.SCHOOL_KEYS, context.school_stats(), limit)
    rows = {r["id"]: r for r in out.collect()}
    assert len(rows) == 5
    assert rows[3]["escola_presenca_media"] == pytest.approx(0.6)
    assert rows[1]["escola_presenca_std"] == pytest.approx(0.1414213562)
    assert rows[4]["escola_presenca_std"] == 0.0 and rows[1]["escola_num_alunos"] == 3


@pytest.mark.parametrize("limit", [0, 10**9])
def test_leave_one_out_rate_has_no_own_label(pupils, limit):
    rows = {r["id"]: r["escola_taxa_loo"] for r in context.leave_one_out_rate(pupils, limit_bytes=limit).collect()}
    assert rows == {1: 0.5, 2: 1.0, 3: 0.5, 4: None, 5: None}


def test_deviation_only_with_context(pupils):
    assert "presenca_vs_escola" not in context.interaction_features(pupils).columns
    out = context.interaction_features(context.network_features(context.school_features(pupils)))
    row = {r["id"]: r for r in out.collect()}[1]
    assert row["presenca_vs_escola"] == pytest.approx(-0.1) and row["presenca_vs_mun"] == pytest.approx(-0.1)
    assert (row["presenca_categoria"], row["escola_tamanho"]) == ("muito_baixa", "pequena")


def test_unique_enrichment_keeps_rows_and_coarse_keys_need_consent(pupils, indicators):
    columns = ["taxa_alfabetizacao", "media_portugues"]
    out = context.enrich_indicators(pupils, indicators, ["id_municipio", "rede", "ano"], columns)
    assert out.count() == 5 and "mun_taxa_alfabetizacao" in out.columns
    with pytest.raises(ValueError):
        context.enrich_indicators(pupils, indicators, ["id_municipio", "ano"], columns)
    repeated = context.enrich_indicators(pupils, indicators, ["id_municipio", "ano"], columns, unique=False)
    assert repeated.count() == 8


@pytest.mark.parametrize("limit", [0, 10**9])
def test_history_modes(pupils, indicators, limit):
    fixed = {r["id"]: r for r in context.add_history(pupils, indicators, "fixed", year=2023, limit_bytes=limit).collect()}
    assert fixed[1]["taxa_hist"] == 50.0 and fixed[4]["taxa_hist"] == 80.0 and fixed[1]["taxa_uf_hist"] == 60.0
    lag = {r["id"]: r for r in context.add_history(pupils, indicators, limit_bytes=limit).collect()}
    assert lag[1]["taxa_hist"] is None and lag[4]["taxa_hist"] == 80.0 and lag[5]["media_hist"] == 690.0
    with pytest.raises(ValueError):
        context.add_history(pupils, indicators, "future")


def test_targets_long_to_wide_and_joined(spark, pupils):
    targets = spark.createDataFrame([("11", 2024, 62.0), ("12", 2030, 80.0)], "sigla_uf string, ano_meta int, meta double")
    wide = {r["sigla_uf"]: (r["meta_uf_2024"], r["meta_uf_2030"]) for r in context.widen_targets(targets, [2024, 2030]).collect()}
    assert wide == {"11": (62.0, None), "12": (None, 80.0)}
    out = context.enrich_targets(pupils.withColumn("sigla_uf", F.substring("id_municipio", 1, 2)), targets, [2024, 2030])
    assert out.count() == 5


def test_gap_to_target(spark):
    features = spark.createDataFrame([("a", "11", 70.0), ("b", "99", 70.0)], "id_municipio string, codigo_uf string, taxa_alfabetizacao double")
    targets = spark.createDataFrame([("11", 2024, 62.0)], "sigla_uf string, ano_meta int, meta double")
    got = {r["id_municipio"]: r["gap_meta"] for r in context.gap_to_target(features, targets, 2024).collect()}
    assert got == {"a": 8.0, "b": None}
