"""Queries over feature building: group statistics, enrichment, history, bins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ambar.fixed import INDICATOR_FEATURES, LEVELS
from ambar.operators import context
from ambar.operators.running import with_rank
from ambar.plans.oracle import near, near_columns, sql
from ambar.session import materialise
from ambar.sources import tpch

TARGET_YEARS = [2024, 2030]
HISTORY_YEAR = tpch.TRAIN_YEAR
PUPIL_KEYS = ["id_registro", "id_aluno", "id_escola", "id_municipio", "rede", "ano"]


def pupils_and_indicators(spark, sf_dir):
    """Pupils, and the small indicator table computed once."""
    pupils = tpch.alunos(spark, sf_dir)
    return pupils, materialise(tpch.indicadores(pupils))


def slim(spark, sf_dir):
    """The columns the feature queries read and show."""
    return tpch.alunos(spark, sf_dir).select(*PUPIL_KEYS, "presenca", "alfabetizado")


def poly_terms(spark, sf_dir):
    out = context.interaction_features(slim(spark, sf_dir))
    return out.select("id_registro", "presenca", "presenca_quadratica", "presenca_cubica")


def context_deviation(spark, sf_dir):
    out = context.interaction_features(context.network_features(context.school_features(slim(spark, sf_dir))))
    return near_columns(
        out.select("id_registro", "presenca_vs_escola", "presenca_vs_mun"), "presenca_vs_escola", "presenca_vs_mun"
    )


def presenca_categoria(spark, sf_dir):
    out = context.interaction_features(slim(spark, sf_dir))
    return out.select("id_registro", "presenca", "presenca_categoria")


def escola_tamanho(spark, sf_dir):
    # Size over all years, so that more than the smallest bin occurs.
    stats = [F.count("*").alias("escola_num_alunos")]
    out = context.interaction_features(context.attach_group_stats(slim(spark, sf_dir), ["id_escola"], stats))
    return out.select("id_registro", "id_escola", "escola_num_alunos", "escola_tamanho")


def escola_stats(spark, sf_dir):
    out = slim(spark, sf_dir).groupBy(*context.SCHOOL_KEYS).agg(*context.school_stats())
    return near_columns(out, "escola_presenca_media", "escola_presenca_std")


def mun_rede_stats(spark, sf_dir):
    out = slim(spark, sf_dir).groupBy(*context.NETWORK_KEYS).agg(*context.network_stats())
    return near_columns(out, "mun_rede_presenca_media")


def escola_features(spark, sf_dir):
    return near_columns(context.school_features(slim(spark, sf_dir)), "escola_presenca_media", "escola_presenca_std")


def mun_rede_features(spark, sf_dir):
    return near_columns(context.network_features(slim(spark, sf_dir)), "mun_rede_presenca_media")


def escola_taxa_loo(spark, sf_dir):
    return context.leave_one_out_rate(slim(spark, sf_dir))


def enrich_indicadores(spark, sf_dir):
    pupils, municipal = pupils_and_indicators(spark, sf_dir)
    out = context.enrich_indicators(pupils.select(*PUPIL_KEYS, "presenca"), municipal, ["id_municipio", "rede", "ano"])
    return near_columns(out, "mun_media_portugues")


def enrich_indicadores_as_is(spark, sf_dir):
    pupils, municipal = pupils_and_indicators(spark, sf_dir)
    out = context.enrich_indicators(
        pupils.select(*PUPIL_KEYS, "presenca"), municipal, ["id_municipio", "ano"], prefix="", unique=False
    )
    return near_columns(out, "media_portugues")


def metas_wide(spark, sf_dir):
    return context.widen_targets(tpch.metas(spark, sf_dir), TARGET_YEARS)


def enrich_metas(spark, sf_dir):
    pupils = slim(spark, sf_dir).withColumn("sigla_uf", F.substring("id_municipio", 1, 2))
    return context.enrich_targets(pupils, tpch.metas(spark, sf_dir), TARGET_YEARS)


def uf_hist_stats(spark, sf_dir):
    _, municipal = pupils_and_indicators(spark, sf_dir)
    return near_columns(context.state_means(municipal, ["sigla_uf", "rede", "ano"]), "taxa_uf_hist", "media_uf_hist")


def _history(spark, sf_dir, mode, wanted):
    pupils, municipal = pupils_and_indicators(spark, sf_dir)
    base = pupils.select(*PUPIL_KEYS)
    out = context.add_history(base, municipal, mode=mode, year=HISTORY_YEAR if mode == "fixed" else None)
    return near_columns(out.select("id_registro", "id_municipio", "rede", "ano", *wanted), *wanted)


def historico_municipio(spark, sf_dir):
    return _history(spark, sf_dir, "fixed", ["taxa_hist", "media_hist"])


def historico_uf(spark, sf_dir):
    return _history(spark, sf_dir, "fixed", ["taxa_uf_hist", "media_uf_hist"])


def historico_defasado(spark, sf_dir):
    return _history(spark, sf_dir, "lag", ["taxa_hist", "media_hist", "taxa_uf_hist", "media_uf_hist"])


def features_ml(spark, sf_dir):
    _, municipal = pupils_and_indicators(spark, sf_dir)
    out = tpch.features_ml(municipal)
    return near_columns(out, "media_portugues", "soma_niveis_basicos", "soma_niveis_avancados")


def gap_meta(spark, sf_dir):
    _, municipal = pupils_and_indicators(spark, sf_dir)
    out = context.gap_to_target(tpch.features_ml(municipal), tpch.metas(spark, sf_dir), 2024)
    return out.select("id_municipio", "rede", "ano", "taxa_alfabetizacao", "meta_2024", "gap_meta")


def municipio_ranking(spark, sf_dir):
    return with_rank(gap_meta(spark, sf_dir), "gap_meta").select("id_municipio", "rede", "ano", "gap_meta", "rank")


QUERIES = {
    "poly_terms": poly_terms,
    "context_deviation": context_deviation,
    "presenca_categoria": presenca_categoria,
    "escola_tamanho": escola_tamanho,
    "escola_stats": escola_stats,
    "mun_rede_stats": mun_rede_stats,
    "escola_features": escola_features,
    "mun_rede_features": mun_rede_features,
    "escola_taxa_loo": escola_taxa_loo,
    "enrich_indicadores": enrich_indicadores,
    "enrich_indicadores_as_is": enrich_indicadores_as_is,
    "metas_wide": metas_wide,
    "enrich_metas": enrich_metas,
    "uf_hist_stats": uf_hist_stats,
    "historico_municipio": historico_municipio,
    "historico_uf": historico_uf,
    "historico_defasado": historico_defasado,
    "features_ml": features_ml,
    "gap_meta": gap_meta,
    "municipio_ranking": municipio_ranking,
}

KEYS_SQL = ", ".join(PUPIL_KEYS)
SCHOOL_SQL = """SELECT id_escola, ano, avg(presenca) AS media, coalesce(stddev_samp(presenca), CAST(0 AS DOUBLE)) AS desvio,
    count(*) AS n, avg(alfabetizado) AS taxa FROM alunos GROUP BY id_escola, ano"""
NETWORK_SQL = "SELECT id_municipio, rede, ano, avg(presenca) AS media, count(*) AS n FROM alunos GROUP BY id_municipio, rede, ano"
STATE_SQL = """SELECT substring(id_municipio, 1, 2) AS sigla_uf, rede, ano, avg(taxa_alfabetizacao) AS taxa_uf_hist,
    avg(media_portugues) AS media_uf_hist FROM indicadores GROUP BY ALL"""
GAP_SQL = """SELECT f.id_municipio, f.rede, f.ano, f.taxa_alfabetizacao, m.meta AS meta_2024,
    f.taxa_alfabetizacao - m.meta AS gap_meta
    FROM features_ml f LEFT JOIN (SELECT DISTINCT sigla_uf, meta FROM metas WHERE ano_meta = 2024) m ON f.codigo_uf = m.sigla_uf"""
SCHOOL_OUT = f"{near('s.media')} AS escola_presenca_media, {near('s.desvio')} AS escola_presenca_std, " \
    "s.n AS escola_num_alunos, s.taxa AS escola_taxa_alfabetizacao"
LEVELS_OUT = ", ".join(f"i.{c} AS mun_{c}" for c in LEVELS)

ORACLES = {
    "poly_terms": sql(
        "alunos",
        body="""SELECT id_registro, presenca, presenca * presenca AS presenca_quadratica,
        presenca * presenca * presenca AS presenca_cubica FROM alunos""",
    ),
    "context_deviation": sql(
        "alunos", s=SCHOOL_SQL, m=NETWORK_SQL,
        body=f"""SELECT id_registro, {near('presenca - s.media')} AS presenca_vs_escola, {near('presenca - m.media')} AS presenca_vs_mun
        FROM alunos a JOIN s ON a.id_escola = s.id_escola AND a.ano = s.ano
        JOIN m ON a.id_municipio = m.id_municipio AND a.rede = m.rede AND a.ano = m.ano""",
    ),
    "presenca_categoria": sql(
        "alunos",
        body="""SELECT id_registro, presenca, CASE WHEN presenca > 0 AND presenca <= 0.5e0 THEN 'muito_baixa'
        WHEN presenca > 0.5e0 AND presenca <= 0.7e0 THEN 'baixa' WHEN presenca > 0.7e0 AND presenca <= 0.85e0 THEN 'media'
        WHEN presenca > 0.85e0 AND presenca <= 0.95e0 THEN 'boa' WHEN presenca > 0.95e0 AND presenca <= 1 THEN 'excelente'
        ELSE 'nan' END AS presenca_categoria FROM alunos""",
    ),
    "escola_tamanho": sql(
        "alunos", s="SELECT id_escola, count(*) AS n FROM alunos GROUP BY id_escola",
        body="""SELECT id_registro, id_escola, n AS escola_num_alunos, CASE WHEN n > 0 AND n <= 50 THEN 'pequena'
        WHEN n > 50 AND n <= 200 THEN 'media' WHEN n > 200 AND n <= 500 THEN 'grande'
        WHEN n > 500 AND n <= 10000 THEN 'muito_grande' ELSE 'nan' END AS escola_tamanho FROM alunos JOIN s USING (id_escola)""",
    ),
    "escola_stats": sql("alunos", s=SCHOOL_SQL, body=f"SELECT id_escola, ano, {SCHOOL_OUT} FROM s"),
    "mun_rede_stats": sql(
        "alunos", s=NETWORK_SQL,
        body=f"SELECT id_municipio, rede, ano, {near('media')} AS mun_rede_presenca_media, n AS mun_rede_num_alunos FROM s",
    ),
    "escola_features": sql(
        "alunos", s=SCHOOL_SQL,
        body=f"SELECT {KEYS_SQL}, presenca, alfabetizado, {SCHOOL_OUT} FROM alunos LEFT JOIN s USING (id_escola, ano)",
    ),
    "mun_rede_features": sql(
        "alunos", s=NETWORK_SQL,
        body=f"""SELECT {KEYS_SQL}, presenca, alfabetizado, {near('s.media')} AS mun_rede_presenca_media,
        s.n AS mun_rede_num_alunos FROM alunos LEFT JOIN s USING (id_municipio, rede, ano)""",
    ),
    "escola_taxa_loo": sql(
        "alunos",
        body=f"""SELECT {KEYS_SQL}, presenca, alfabetizado,
        CAST(sum(alfabetizado) OVER w - alfabetizado AS DOUBLE) / nullif(count(*) OVER w - 1, 0) AS escola_taxa_loo
        FROM alunos WINDOW w AS (PARTITION BY id_escola, ano)""",
    ),
    "enrich_indicadores": sql(
        "indicadores",
        body=f"""SELECT {KEYS_SQL}, presenca, i.taxa_alfabetizacao AS mun_taxa_alfabetizacao,
        {near('i.media_portugues')} AS mun_media_portugues, {LEVELS_OUT}, substring(id_municipio, 1, 2) AS sigla_uf
        FROM alunos LEFT JOIN indicadores i USING (id_municipio, rede, ano)""",
    ),
    "enrich_indicadores_as_is": sql(
        "indicadores",
        i=f"SELECT DISTINCT id_municipio, ano, {', '.join(INDICATOR_FEATURES)} FROM indicadores",
        body=f"""SELECT {KEYS_SQL}, presenca, i.taxa_alfabetizacao, {near('i.media_portugues')} AS media_portugues,
        {', '.join('i.' + c for c in LEVELS)}, substring(id_municipio, 1, 2) AS sigla_uf
        FROM alunos LEFT JOIN i USING (id_municipio, ano)""",
    ),
    "metas_wide": sql("metas_wide", body="SELECT * FROM metas_wide"),
    "enrich_metas": sql(
        "alunos", "metas_wide",
        a="SELECT *, substring(id_municipio, 1, 2) AS sigla_uf FROM alunos",
        body=f"""SELECT {KEYS_SQL}, presenca, alfabetizado, sigla_uf, meta_uf_2024, meta_uf_2030
        FROM a LEFT JOIN metas_wide USING (sigla_uf)""",
    ),
    "uf_hist_stats": sql(
        "indicadores", s=STATE_SQL,
        body=f"SELECT sigla_uf, rede, ano, {near('taxa_uf_hist')} AS taxa_uf_hist, {near('media_uf_hist')} AS media_uf_hist FROM s",
    ),
    "historico_municipio": sql(
        "indicadores",
        i=f"SELECT * FROM indicadores WHERE ano = {HISTORY_YEAR}",
        body=f"""SELECT id_registro, a.id_municipio, a.rede, a.ano, {near('i.taxa_alfabetizacao')} AS taxa_hist,
        {near('i.media_portugues')} AS media_hist
        FROM alunos a LEFT JOIN i ON a.id_municipio = i.id_municipio AND a.rede = i.rede""",
    ),
    "historico_uf": sql(
        "indicadores", s=STATE_SQL,
        body=f"""SELECT id_registro, a.id_municipio, a.rede, a.ano, {near('s.taxa_uf_hist')} AS taxa_uf_hist,
        {near('s.media_uf_hist')} AS media_uf_hist
        FROM alunos a LEFT JOIN s ON substring(a.id_municipio, 1, 2) = s.sigla_uf AND a.rede = s.rede AND s.ano = {HISTORY_YEAR}""",
    ),
    "historico_defasado": sql(
        "indicadores", s=STATE_SQL,
        body=f"""SELECT id_registro, a.id_municipio, a.rede, a.ano, {near('i.taxa_alfabetizacao')} AS taxa_hist,
        {near('i.media_portugues')} AS media_hist, {near('s.taxa_uf_hist')} AS taxa_uf_hist, {near('s.media_uf_hist')} AS media_uf_hist
        FROM alunos a LEFT JOIN indicadores i ON a.id_municipio = i.id_municipio AND a.rede = i.rede AND a.ano = i.ano + 1
        LEFT JOIN s ON substring(a.id_municipio, 1, 2) = s.sigla_uf AND a.rede = s.rede AND a.ano = s.ano + 1""",
    ),
    "features_ml": sql(
        "features_ml",
        body=f"""SELECT * REPLACE ({near('media_portugues')} AS media_portugues,
        {near('soma_niveis_basicos')} AS soma_niveis_basicos, {near('soma_niveis_avancados')} AS soma_niveis_avancados)
        FROM features_ml""",
    ),
    "gap_meta": sql("features_ml", "metas", body=GAP_SQL),
    "municipio_ranking": sql(
        "features_ml", "metas", g=GAP_SQL,
        body="SELECT id_municipio, rede, ano, gap_meta, rank() OVER (ORDER BY gap_meta ASC NULLS LAST) AS rank FROM g",
    ),
}
