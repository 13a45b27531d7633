"""Queries over leakage screens, compact curves, totals per level, join match rates and one-scan features."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ambar.functions.scalars import state_code
from ambar.operators import context, evaluate, lookup, prep
from ambar.plans.evaluation import BASIC_SQL, COUNTS, CURVE, METRICS, scored
from ambar.plans.features import NETWORK_SQL, SCHOOL_OUT, SCHOOL_SQL, TARGET_YEARS, pupils_and_indicators
from ambar.plans.oracle import near, near_columns, sql
from ambar.session import small_frame, stored
from ambar.sources import bucketed, tpch

SCREENED = ["presenca", "caderno", "proficiencia", "ano", "rede", "id_municipio", "mun_taxa_alfabetizacao"]


def _enriched(spark, sf_dir):
    pupils, municipal = pupils_and_indicators(spark, sf_dir)
    return context.enrich_indicators(pupils, municipal, ["id_municipio", "rede", "ano"], ["taxa_alfabetizacao"])


def leakage_screen(spark, sf_dir):
    """The area of every column alone against the label."""
    out = evaluate.leakage_screen(_enriched(spark, sf_dir), "alfabetizado", SCREENED)
    return near_columns(out, "roc_auc", "separation")


def roc_curve_compact(spark, sf_dir):
    return evaluate.roc_curve_compact(scored(spark, sf_dir))


def roc_area_by_corners(spark, sf_dir):
    """The area under the compact curve, and how many corners it takes."""
    return near_columns(evaluate.curve_area(evaluate.roc_curve_compact(scored(spark, sf_dir))), "area")


def metrics_rollup(spark, sf_dir):
    """Metrics by state and network, by state, and in total."""
    frame = scored(spark, sf_dir).withColumn("sigla_uf", state_code("id_municipio"))
    return near_columns(evaluate.metrics_rollup(frame, ["sigla_uf", "rede"]), *METRICS)


def join_match_rates(spark, sf_dir):
    """Rows and matches of the target join with codes on both sides, and with letters on the targets' side."""
    pupils = tpch.alunos(spark, sf_dir).select("id_registro", "id_municipio", state_code("id_municipio").alias("sigla_uf"))
    targets, rows = tpch.metas(spark, sf_dir), []
    letters = targets.withColumn("sigla_uf", context.state_key(F.col("sigla_uf"), "letters"))
    for name, side, use in (("codes", targets, "codes"), ("letters", letters, "letters"), ("letters_as_codes", letters, "codes")):
        joined = context.enrich_targets_observed(pupils, side, TARGET_YEARS, use)
        joined.frame.write.format("noop").mode("overwrite").save()
        rows.append((name, *joined.counts()))
    schema = T.StructType([T.StructField("join", T.StringType()), T.StructField("n_rows", T.LongType()), T.StructField("n_matched", T.LongType())])
    return small_frame(spark, rows, schema)


def context_in_one_scan(spark, sf_dir):
    """School and network statistics by grouping sets, joined back to the pupils."""
    pupils = stored(tpch.alunos(spark, sf_dir).select("id_registro", "id_escola", "id_municipio", "rede", "ano", "presenca", "alfabetizado"))
    out = lookup.fit_groups(pupils).transform(pupils)
    columns = ["escola_presenca_media", "escola_presenca_std", "escola_num_alunos", "mun_rede_presenca_media", "mun_rede_num_alunos", "escola_taxa_loo"]
    return near_columns(out.select("id_registro", *columns), "escola_presenca_media", "escola_presenca_std", "mun_rede_presenca_media", "escola_taxa_loo")


def escola_features_bucketed(spark, sf_dir):
    """School statistics joined back inside the buckets of a table that is bucketed by school and edition."""
    pupils = tpch.alunos(spark, sf_dir).select("id_registro", "id_escola", "ano", "presenca", "alfabetizado")
    out = bucketed.with_group_stats(bucketed.bucketed(pupils, context.SCHOOL_KEYS), context.SCHOOL_KEYS, context.school_stats())
    return near_columns(out, "escola_presenca_media", "escola_presenca_std")


def category_dictionary(spark, sf_dir):
    """Every pupil id and network as a category, with its place in the order and its rows."""
    pupils = tpch.alunos(spark, sf_dir).select("id_aluno", "rede")
    return prep.category_dictionary(pupils, ["id_aluno", "rede"])


QUERIES = {
    "leakage_screen": leakage_screen,
    "roc_curve_compact": roc_curve_compact,
    "roc_area_by_corners": roc_area_by_corners,
    "metrics_rollup": metrics_rollup,
    "join_match_rates": join_match_rates,
    "context_in_one_scan": context_in_one_scan,
    "category_dictionary": category_dictionary,
    "escola_features_bucketed": escola_features_bucketed,
}

_NUMBERS = [c for c in SCREENED if c not in ("rede", "id_municipio")]
SCREEN_SQL = {
    "e": "SELECT a.*, i.taxa_alfabetizacao AS mun_taxa_alfabetizacao FROM alunos a LEFT JOIN indicadores i USING (id_municipio, rede, ano)",
    "l": " UNION ALL ".join(f"SELECT '{c}' AS c, {c}::DOUBLE AS score, alfabetizado AS label FROM e" for c in _NUMBERS)
    + " UNION ALL "
    + " UNION ALL ".join(f"SELECT '{c}', avg(alfabetizado) OVER (PARTITION BY {c}), alfabetizado FROM e WHERE {c} IS NOT NULL" for c in ("rede", "id_municipio")),
    "k": "SELECT c, score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg FROM l WHERE score IS NOT NULL GROUP BY c, score",
    "r": "SELECT *, sum(neg) OVER (PARTITION BY c ORDER BY score) - neg / 2.0e0 AS won FROM k",
    "s": "SELECT c, sum(pos + neg)::BIGINT AS n_known, sum(pos * won) / nullif(sum(pos)::DOUBLE * sum(neg), 0) AS a FROM r GROUP BY c",
}
CORNERS = CURVE | {
    "ahead": "SELECT score, pos, neg, lead(pos) OVER w AS np, lead(neg) OVER w AS nn FROM by_score WINDOW w AS (ORDER BY score DESC)",
    "corner": "SELECT fp / n AS fpr, tp / p AS tpr, threshold FROM run JOIN ahead ON score = threshold WHERE np IS NULL OR pos * nn <> np * neg "
    "UNION ALL SELECT 0e0, 0e0, 'infinity'::DOUBLE",
}

ORACLES = {
    "leakage_screen": sql(
        "indicadores", **SCREEN_SQL,
        body=f"""SELECT c AS "column", n_known, {near('a')} AS roc_auc, {near('greatest(a, 1 - a)')} AS separation, greatest(a, 1 - a) >= 0.95 AS suspicious FROM s""",
    ),
    "roc_curve_compact": sql("scored", **CORNERS, body="SELECT * FROM corner"),
    "roc_area_by_corners": sql(
        "scored", **CORNERS,
        b="SELECT *, sum(neg) OVER (ORDER BY score) - neg / 2.0e0 AS won FROM by_score",
        body=f"SELECT {near('(SELECT sum(pos * won) / (sum(pos)::DOUBLE * sum(neg)) FROM b)')} AS area, count(*) AS n_points FROM corner",
    ),
    "metrics_rollup": sql(
        "scored", s="SELECT *, substring(id_municipio, 1, 2) AS sigla_uf FROM scored",
        c=f"SELECT sigla_uf, rede, (2 - grouping(sigla_uf) - grouping(rede))::INTEGER AS level, count(*) AS n_rows, {COUNTS} FROM s GROUP BY ROLLUP (sigla_uf, rede)",
        body=f"SELECT sigla_uf, rede, level, n_rows, {BASIC_SQL} FROM c",
    ),
    "join_match_rates": sql(
        "alunos", "metas_wide",
        m="SELECT count(*) AS n, count(*) FILTER (WHERE substring(id_municipio, 1, 2) IN (SELECT sigla_uf FROM metas_wide)) AS k FROM alunos",
        body="""SELECT 'codes' AS "join", n AS n_rows, k AS n_matched FROM m UNION ALL SELECT 'letters', n, k FROM m UNION ALL SELECT 'letters_as_codes', n, 0 FROM m""",
    ),
    "context_in_one_scan": sql(
        "alunos", s=SCHOOL_SQL, m=NETWORK_SQL,
        body=f"""SELECT id_registro, {near('s.media')} AS escola_presenca_media, {near('s.desvio')} AS escola_presenca_std, s.n AS escola_num_alunos,
        {near('m.media')} AS mun_rede_presenca_media, m.n AS mun_rede_num_alunos,
        {near('(CAST(sum(alfabetizado) OVER w - alfabetizado AS DOUBLE) / nullif(count(*) OVER w - 1, 0))')} AS escola_taxa_loo
        FROM alunos a JOIN s ON a.id_escola = s.id_escola AND a.ano = s.ano
        JOIN m ON a.id_municipio = m.id_municipio AND a.rede = m.rede AND a.ano = m.ano WINDOW w AS (PARTITION BY a.id_escola, a.ano)""",
    ),
    "escola_features_bucketed": sql(
        "alunos", s=SCHOOL_SQL,
        body=f"SELECT id_registro, id_escola, ano, presenca, alfabetizado, {SCHOOL_OUT} FROM alunos LEFT JOIN s USING (id_escola, ano)",
    ),
    "category_dictionary": sql(
        "alunos",
        v="SELECT 'id_aluno' AS c, id_aluno::VARCHAR AS value FROM alunos UNION ALL SELECT 'rede', rede FROM alunos",
        g="SELECT c, value, count(*) AS n FROM v WHERE value IS NOT NULL GROUP BY c, value",
        body="""SELECT c AS "column", value, row_number() OVER (PARTITION BY c ORDER BY value) - 1 AS "index", n FROM g""",
    ),
}
