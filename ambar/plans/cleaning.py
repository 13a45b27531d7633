"""Queries over column choice, cleaning and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ambar.fixed import AGGREGATE_FEATURES, ID_COLUMNS, INDICATOR_FEATURES, LEAKY_COLUMNS, PUPIL_FEATURES, TARGET_RATE
from ambar.functions.scalars import state_code, threshold_label
from ambar.operators import columns, profile, splits
from ambar.operators.joins import sized
from ambar.plans.oracle import hash_sql, near, near_columns, sql
from ambar.session import materialise
from ambar.sources import tpch

TRAIN, TEST = tpch.TRAIN_YEAR, tpch.TEST_YEAR
EDITIONS = (TRAIN, TEST)
# The projection of the pupil model asks for one column twice and for one that is not in the table.
PUPIL_PROJECTION = ["alfabetizado", "id_aluno", "id_municipio", "rede", *PUPIL_FEATURES, "rede_codigo"]
EXPECTED_COLUMNS = [
    "proficiencia", "presenca", "serie", "caderno", "preenchimento_caderno",
    "id_municipio", "id_escola", "rede", "rede_codigo", "ano",
]


def features(spark, sf_dir):
    return tpch.features_ml(tpch.indicadores(tpch.alunos(spark, sf_dir)))


def labelled_features(spark, sf_dir):
    return features(spark, sf_dir).withColumn("meta_atingida", threshold_label("taxa_alfabetizacao", TARGET_RATE))


def target_meta(spark, sf_dir):
    return labelled_features(spark, sf_dir).select("id_municipio", "rede", "ano", "taxa_alfabetizacao", "meta_atingida")


def features_agregado(spark, sf_dir):
    out = labelled_features(spark, sf_dir).select(*AGGREGATE_FEATURES, "meta_atingida")
    return near_columns(out, "media_portugues", "soma_niveis_basicos", "soma_niveis_avancados")


def features_individual(spark, sf_dir):
    return tpch.alunos(spark, sf_dir).select(*PUPIL_FEATURES)


def select_existing(spark, sf_dir):
    return columns.select_existing(tpch.alunos(spark, sf_dir), PUPIL_PROJECTION)


def missing_columns(spark, sf_dir):
    return columns.missing_columns(tpch.alunos(spark, sf_dir), EXPECTED_COLUMNS)


def drop_leaky(spark, sf_dir):
    return columns.drop_columns(tpch.alunos(spark, sf_dir), LEAKY_COLUMNS)


def drop_ids(spark, sf_dir):
    return columns.drop_columns(tpch.alunos(spark, sf_dir), ID_COLUMNS)


def dedup_columns(spark, sf_dir):
    pupils = tpch.alunos(spark, sf_dir)
    municipal = materialise(tpch.indicadores(pupils))
    same = (
        (pupils["id_municipio"] == municipal["id_municipio"])
        & (pupils["rede"] == municipal["rede"])
        & (pupils["ano"] == municipal["ano"])
    )
    out = columns.dedup_columns(pupils.join(sized(municipal), same, "left"))
    return near_columns(out, "media_portugues")


def feature_roles(spark, sf_dir):
    return columns.feature_roles(tpch.alunos(spark, sf_dir), categorical=["caderno"])


def uf_prefix(spark, sf_dir):
    pupils = tpch.alunos(spark, sf_dir)
    return pupils.select("id_registro", "id_municipio", state_code("id_municipio").alias("sigla_uf"))


def distinct_indicadores(spark, sf_dir):
    municipal = tpch.indicadores(tpch.alunos(spark, sf_dir))
    return near_columns(municipal.select("id_municipio", "ano", *INDICATOR_FEATURES).distinct(), "media_portugues")


def alunos_unicos(spark, sf_dir):
    return splits.single_period_entities(tpch.alunos(spark, sf_dir), "id_aluno", "ano")


def temporal_split(spark, sf_dir):
    return splits.with_split(tpch.alunos(spark, sf_dir, EDITIONS), "ano", TRAIN, TEST).drop("ano")


def split_audit(spark, sf_dir):
    split = splits.with_split(tpch.alunos(spark, sf_dir, EDITIONS), "ano", TRAIN, TEST)
    return splits.split_audit(split, "id_aluno", "alfabetizado")


def stratified_folds(spark, sf_dir):
    pupils = tpch.alunos(spark, sf_dir).select("id_registro", "alfabetizado")
    return splits.stratified_folds(pupils, "alfabetizado", "id_registro")


def step_counts(spark, sf_dir):
    pupils = tpch.alunos(spark, sf_dir)
    clean = columns.select_existing(pupils, PUPIL_PROJECTION)
    return profile.step_counts(
        [
            ("read", pupils),
            ("projected", clean),
            ("single_period", splits.single_period_entities(clean, "id_aluno", "ano")),
            ("with_attendance", clean.where(F.col("presenca").isNotNull())),
        ]
    )


QUERIES = {
    "target_meta": target_meta,
    "features_agregado": features_agregado,
    "features_individual": features_individual,
    "select_existing": select_existing,
    "missing_columns": missing_columns,
    "drop_leaky": drop_leaky,
    "drop_ids": drop_ids,
    "dedup_columns": dedup_columns,
    "feature_roles": feature_roles,
    "uf_prefix": uf_prefix,
    "distinct_indicadores": distinct_indicadores,
    "alunos_unicos": alunos_unicos,
    "split_temporal": temporal_split,
    "split_audit": split_audit,
    "stratified_folds": stratified_folds,
    "step_counts": step_counts,
}

LABEL_SQL = f"CASE WHEN taxa_alfabetizacao >= {TARGET_RATE} THEN 1 ELSE 0 END AS meta_atingida"
ONCE_SQL = "SELECT id_aluno FROM alunos GROUP BY id_aluno HAVING count(DISTINCT ano) = 1"


def _column_lines(names: list[str], line) -> str:
    return " UNION ALL ".join(line(c) for c in names)


ROLES = {
    "id_registro": "numeric", "id_aluno": "numeric", "ano": "numeric", "id_municipio": "categorical",
    "id_escola": "numeric", "rede": "categorical", "serie": "numeric", "caderno": "categorical",
    "presenca": "numeric", "proficiencia": "numeric", "alfabetizado": "numeric",
}

ORACLES = {
    "target_meta": sql(
        "indicadores", body=f"SELECT id_municipio, rede, ano, taxa_alfabetizacao, {LABEL_SQL} FROM indicadores"
    ),
    "features_agregado": sql(
        "features_ml",
        body=f"""SELECT {near('media_portugues')} AS media_portugues, {near('soma_niveis_basicos')} AS soma_niveis_basicos,
        {near('soma_niveis_avancados')} AS soma_niveis_avancados, {', '.join(AGGREGATE_FEATURES[3:])}, {LABEL_SQL}
        FROM features_ml""",
    ),
    "features_individual": sql("alunos", body="SELECT presenca, serie, caderno, rede, ano FROM alunos"),
    "select_existing": sql(
        "alunos", body="SELECT alfabetizado, id_aluno, id_municipio, rede, presenca, serie, caderno, ano FROM alunos"
    ),
    "missing_columns": sql(
        "alunos",
        body=_column_lines(
            EXPECTED_COLUMNS,
            lambda c: f"SELECT '{c}' AS \"column\", {'true' if c in ROLES else 'false'} AS present, "
            f"{f'count({c})' if c in ROLES else 'CAST(0 * count(*) AS BIGINT)'} AS n_values FROM alunos",
        ),
    ),
    "drop_leaky": sql("alunos", body="SELECT * EXCLUDE (proficiencia) FROM alunos"),
    "drop_ids": sql(
        "alunos", body="SELECT ano, rede, serie, caderno, presenca, proficiencia, alfabetizado FROM alunos"
    ),
    "dedup_columns": sql(
        "indicadores",
        body=f"""SELECT a.*, i.* EXCLUDE (id_municipio, rede, ano) REPLACE ({near('i.media_portugues')} AS media_portugues)
        FROM alunos a LEFT JOIN indicadores i
        ON a.id_municipio = i.id_municipio AND a.rede = i.rede AND a.ano = i.ano""",
    ),
    "feature_roles": sql(
        "alunos",
        body=_column_lines(
            list(ROLES),
            lambda c: f"SELECT '{c}' AS \"column\", '{ROLES[c]}' AS role, count({c}) AS n_values, "
            f"coalesce(min({c}) = max({c}), true) AS constant FROM alunos",
        ),
    ),
    "uf_prefix": sql(
        "alunos", body="SELECT id_registro, id_municipio, substring(id_municipio, 1, 2) AS sigla_uf FROM alunos"
    ),
    "distinct_indicadores": sql(
        "indicadores",
        body=f"""SELECT id_municipio, ano, taxa_alfabetizacao, {near('media_portugues')} AS media_portugues,
        {', '.join(INDICATOR_FEATURES[2:])}
        FROM (SELECT DISTINCT id_municipio, ano, {', '.join(INDICATOR_FEATURES)} FROM indicadores)""",
    ),
    "alunos_unicos": sql(
        "alunos",
        body="SELECT * FROM alunos WHERE id_aluno IN (SELECT id_aluno FROM once)",
        once=ONCE_SQL,
    ),
    "split_temporal": sql(
        "alunos",
        body=f"""SELECT * EXCLUDE (ano), CASE ano WHEN {TRAIN} THEN 'train' ELSE 'test' END AS split
        FROM alunos WHERE ano IN ({TRAIN}, {TEST})""",
    ),
    "split_audit": sql(
        "alunos",
        split=f"SELECT *, CASE ano WHEN {TRAIN} THEN 'train' ELSE 'test' END AS split FROM alunos WHERE ano IN ({TRAIN}, {TEST})",
        shared="SELECT id_aluno FROM split GROUP BY id_aluno HAVING count(DISTINCT split) = 2",
        body="""SELECT split, count(*) AS n_rows, avg(alfabetizado) AS positive_share,
        count(DISTINCT id_aluno) AS n_entities,
        count(DISTINCT CASE WHEN id_aluno IN (SELECT id_aluno FROM shared) THEN id_aluno END) AS n_shared
        FROM split GROUP BY split""",
    ),
    "stratified_folds": sql(
        "alunos",
        body=f"""SELECT id_registro, alfabetizado, CAST((row_number() OVER (PARTITION BY alfabetizado
        ORDER BY {hash_sql('id_registro')}, id_registro) - 1) % 5 AS INTEGER) AS fold FROM alunos""",
    ),
    "step_counts": sql(
        "alunos",
        once=ONCE_SQL,
        body="""SELECT 0 AS step, 'read' AS name, count(*) AS n_rows FROM alunos
        UNION ALL SELECT 1, 'projected', count(*) FROM alunos
        UNION ALL SELECT 2, 'single_period', count(*) FROM alunos WHERE id_aluno IN (SELECT id_aluno FROM once)
        UNION ALL SELECT 3, 'with_attendance', count(*) FROM alunos WHERE presenca IS NOT NULL""",
    ),
}
