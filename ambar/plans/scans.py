"""Queries over sources and samples."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ambar.fixed import EXPORT_FRACTIONS, LEVELS
from ambar.plans.oracle import hash_sql, near, near_columns, sql
from ambar.session import checkpoint_dir, materialise
from ambar.sources import samples, tpch
from ambar.sources.tables import table_profile

INDICATOR_KEY_SQL = "concat_ws('|', id_municipio, rede, ano)"


def indicators(spark, sf_dir):
    return tpch.indicadores(tpch.alunos(spark, sf_dir))


def scan_features(spark, sf_dir):
    return near_columns(
        tpch.features_ml(indicators(spark, sf_dir)), "media_portugues", "soma_niveis_basicos", "soma_niveis_avancados"
    )


def scan_alunos(spark, sf_dir):
    return tpch.alunos(spark, sf_dir)


def scan_indicadores(spark, sf_dir):
    return near_columns(indicators(spark, sf_dir), "media_portugues")


def scan_metas(spark, sf_dir):
    return tpch.metas(spark, sf_dir)


def profile(spark, sf_dir):
    return table_profile(tpch.table(spark, sf_dir, "orders"))


def hash_sample(spark, sf_dir):
    return samples.hash_sample(tpch.alunos(spark, sf_dir), "id_registro", 0.10)


def stratified_sample(spark, sf_dir):
    return samples.stratified_sample(tpch.alunos(spark, sf_dir), "alfabetizado", {0: 0.15, 1: 0.10}, "id_registro")


def sample_by(spark, sf_dir):
    return samples.stratified_sample_native(tpch.alunos(spark, sf_dir), "alfabetizado", {0: 0.10, 1: 0.10})


def export_manifest(spark, sf_dir):
    pupils = tpch.alunos(spark, sf_dir)
    municipal = materialise(tpch.indicadores(pupils))
    part, municipal_key = EXPORT_FRACTIONS, F.concat_ws("|", "id_municipio", "rede", "ano")
    pupil_part = {0: part["microdados_alunos"], 1: part["microdados_alunos"]}
    frames = {
        "features_ml": samples.hash_sample(tpch.features_ml(municipal), municipal_key, part["features_ml"]),
        "microdados_alunos": samples.stratified_sample(pupils, "alfabetizado", pupil_part, "id_registro"),
        "indicadores_municipio": samples.hash_sample(municipal, municipal_key, part["indicadores_municipio"]),
        "metas_uf": tpch.metas(spark, sf_dir),
    }
    return samples.export_samples(frames, f"{checkpoint_dir(spark)}/export-{uuid.uuid4().hex}")


QUERIES = {
    "scan_features": scan_features,
    "scan_alunos": scan_alunos,
    "scan_indicadores": scan_indicadores,
    "scan_metas": scan_metas,
    "table_profile": profile,
    "hash_sample": hash_sample,
    "stratified_sample": stratified_sample,
    "sample_by": sample_by,
    "export_manifest": export_manifest,
}

ORACLES = {
    "scan_features": sql(
        "features_ml",
        body=f"""SELECT * REPLACE ({near('media_portugues')} AS media_portugues,
        {near('soma_niveis_basicos')} AS soma_niveis_basicos, {near('soma_niveis_avancados')} AS soma_niveis_avancados)
        FROM features_ml""",
    ),
    "scan_alunos": sql("alunos", body="SELECT * FROM alunos"),
    "scan_indicadores": sql(
        "indicadores",
        body=f"SELECT id_municipio, rede, ano, taxa_alfabetizacao, {near('media_portugues')} AS media_portugues, "
        f"{', '.join(LEVELS)} FROM indicadores",
    ),
    "scan_metas": sql("metas", body="SELECT * FROM metas"),
    "table_profile": """
        SELECT position, "column", "type", (SELECT count(*) FROM orders) AS n_rows, 6 AS n_columns
        FROM (VALUES (0, 'o_orderkey', 'bigint'), (1, 'o_custkey', 'bigint'), (2, 'o_orderstatus', 'string'),
              (3, 'o_totalprice', 'double'), (4, 'o_orderdate', 'timestamp_ntz'), (5, 'o_orderpriority', 'string'))
             t(position, "column", "type")""",
    "hash_sample": sql("alunos", body=f"SELECT * FROM alunos WHERE {hash_sql('id_registro')} < 0.10e0 * 4294967296"),
    "stratified_sample": sql(
        "alunos",
        body=f"""SELECT * FROM alunos
        WHERE {hash_sql('id_registro')} < CASE alfabetizado WHEN 0 THEN 0.15e0 ELSE 0.10e0 END * 4294967296""",
    ),
    "export_manifest": sql(
        "features_ml", "metas",
        body=f"""
        SELECT 'features_ml' AS "table", count(*) AS n_rows FROM features_ml WHERE {hash_sql(INDICATOR_KEY_SQL)} < 0.10e0 * 4294967296
        UNION ALL SELECT 'microdados_alunos', count(*) FROM alunos WHERE {hash_sql('id_registro')} < 0.01e0 * 4294967296
        UNION ALL SELECT 'indicadores_municipio', count(*) FROM indicadores WHERE {hash_sql(INDICATOR_KEY_SQL)} < 0.20e0 * 4294967296
        UNION ALL SELECT 'metas_uf', count(*) FROM metas""",
    ),
}
