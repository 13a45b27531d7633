"""Queries over table profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ambar.fixed import TARGET_RATE
from ambar.operators import profile
from ambar.operators.running import cumulative_share
from ambar.plans.oracle import near, near_columns, sql
from ambar.session import materialise
from ambar.sources import tpch

TRAIN, TEST = tpch.TRAIN_YEAR, tpch.TEST_YEAR
CONTEXT_COLUMNS = ["id_municipio", "id_escola", "rede", "ano", "presenca"]


def anos_por_aluno(spark, sf_dir):
    out = profile.periods_per_entity(tpch.alunos(spark, sf_dir), "id_aluno", "ano")
    return out.select("id_aluno", F.col("n_periods").alias("n_anos"), F.array_join("periods", ",").alias("anos"))


def class_distribution(spark, sf_dir):
    return near_columns(profile.class_distribution(tpch.alunos(spark, sf_dir), "alfabetizado"), "pct")


def overlap_distribution(spark, sf_dir):
    return near_columns(profile.overlap_distribution(tpch.alunos(spark, sf_dir), "id_aluno", "ano"), "pct")


def overlap_summary(spark, sf_dir):
    return near_columns(
        profile.overlap_summary(tpch.alunos(spark, sf_dir), "id_aluno", "ano", TRAIN, TEST), "pct_both"
    )


def five_number(spark, sf_dir):
    municipal = materialise(tpch.indicadores(tpch.alunos(spark, sf_dir)))
    return near_columns(profile.five_number(municipal, "taxa_alfabetizacao"), "minimum", "p25", "p50", "p75", "maximum")


def describe_col(spark, sf_dir):
    out = profile.describe_columns(tpch.alunos(spark, sf_dir), ["proficiencia", "presenca", "caderno"])
    return near_columns(out, "mean", "std", "minimum", "p25", "p50", "p75", "maximum")


def null_audit(spark, sf_dir):
    return profile.null_audit(tpch.alunos(spark, sf_dir))


def cardinality(spark, sf_dir):
    return profile.cardinality(tpch.alunos(spark, sf_dir), CONTEXT_COLUMNS)


def histogram30(spark, sf_dir):
    municipal = materialise(tpch.indicadores(tpch.alunos(spark, sf_dir)))
    return near_columns(profile.histogram(municipal, "taxa_alfabetizacao", 30, TARGET_RATE), "lower", "upper")


def cumulative_cover(spark, sf_dir):
    sizes = tpch.alunos(spark, sf_dir).groupBy("id_municipio").agg(F.count("*").alias("n"))
    shares, needed = cumulative_share(sizes, "id_municipio", "n", [0.8, 0.9])
    out = shares.select("*", needed.select("n_80").scalar().alias("n_80"), needed.select("n_90").scalar().alias("n_90"))
    return near_columns(out, "cumulative_share")


QUERIES = {
    "anos_por_aluno": anos_por_aluno,
    "class_distribution": class_distribution,
    "overlap_distribution": overlap_distribution,
    "overlap_summary": overlap_summary,
    "five_number": five_number,
    "describe_col": describe_col,
    "null_audit": null_audit,
    "cardinality": cardinality,
    "histogram30": histogram30,
    "cumulative_cover": cumulative_cover,
}


def _describe(c: str) -> str:
    quartiles = ", ".join(near(f"quantile_cont({c}::DOUBLE, {q})") + f" AS {n}" for q, n in [("0.25", "p25"), ("0.5", "p50"), ("0.75", "p75")])
    return (
        f"SELECT '{c}' AS \"column\", count({c}) AS n, {near(f'avg({c})')} AS mean, {near(f'stddev_samp({c})')} AS std, "
        f"{near(f'min({c})')} AS minimum, {quartiles}, {near(f'max({c})')} AS maximum FROM alunos"
    )


QUANTILES = [("0", "minimum"), ("0.25", "p25"), ("0.5", "p50"), ("0.75", "p75"), ("1", "maximum")]
ALL_COLUMNS = [
    "id_registro", "id_aluno", "ano", "id_municipio", "id_escola", "rede", "serie", "caderno", "presenca",
    "proficiencia", "alfabetizado",
]

ORACLES = {
    "anos_por_aluno": sql(
        "alunos",
        body="""SELECT id_aluno, count(DISTINCT ano) AS n_anos, string_agg(DISTINCT CAST(ano AS VARCHAR), ',' ORDER BY CAST(ano AS VARCHAR)) AS anos
        FROM alunos GROUP BY id_aluno""",
    ),
    "class_distribution": sql(
        "alunos",
        body=f"""SELECT alfabetizado, count(*) AS n, {near('100 * (count(*) / (SELECT count(*) FROM alunos)::DOUBLE)')} AS pct
        FROM alunos GROUP BY alfabetizado""",
    ),
    "overlap_distribution": sql(
        "alunos", p="SELECT id_aluno, count(DISTINCT ano) AS n_periods FROM alunos GROUP BY id_aluno",
        body=f"""SELECT n_periods, count(*) AS n, {near('100 * (count(*) / (SELECT count(*) FROM p)::DOUBLE)')} AS pct
        FROM p GROUP BY n_periods""",
    ),
    "overlap_summary": sql(
        "alunos",
        p=f"SELECT max((ano = {TRAIN})::INT) AS a, max((ano = {TEST})::INT) AS b FROM alunos GROUP BY id_aluno",
        body=f"""SELECT count(*) AS n_entities, sum(a)::BIGINT AS n_train, sum(b)::BIGINT AS n_test, sum(a * b)::BIGINT AS n_both,
        {near('100 * (sum(a * b)::DOUBLE / count(*))')} AS pct_both FROM p""",
    ),
    "five_number": sql(
        "indicadores",
        body="SELECT 'taxa_alfabetizacao' AS \"column\", "
        + ", ".join(near(f"quantile_cont(taxa_alfabetizacao, {q})") + f" AS {n}" for q, n in QUANTILES)
        + " FROM indicadores",
    ),
    "describe_col": sql("alunos", body=" UNION ALL ".join(_describe(c) for c in ["proficiencia", "presenca", "caderno"])),
    "null_audit": sql(
        "alunos",
        counts=" UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS n_missing FROM alunos" for c in ALL_COLUMNS),
        body="SELECT * FROM counts WHERE n_missing > 0",
    ),
    "cardinality": sql(
        "alunos",
        body=" UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count(*) AS n_distinct FROM (SELECT DISTINCT {c} FROM alunos)" for c in CONTEXT_COLUMNS
        ),
    ),
    "histogram30": sql(
        "indicadores",
        r="SELECT min(taxa_alfabetizacao) AS lo, (max(taxa_alfabetizacao) - min(taxa_alfabetizacao)) / 30 AS w FROM indicadores",
        b="""SELECT CAST(least(floor((taxa_alfabetizacao - lo) / w), 29) AS INTEGER) AS bin, count(*) AS n,
            count(*) FILTER (WHERE taxa_alfabetizacao >= 80) AS n_at_or_above FROM indicadores, r GROUP BY 1""",
        body=f"""SELECT CAST(g.i AS INTEGER) AS bin, {near('lo + g.i * w')} AS lower, {near('lo + (g.i + 1) * w')} AS upper,
        coalesce(n, 0) AS n, coalesce(n_at_or_above, 0) AS n_at_or_above
        FROM range(30) g(i) CROSS JOIN r LEFT JOIN b ON b.bin = g.i""",
    ),
    "cumulative_cover": sql(
        "alunos",
        s="SELECT id_municipio, count(*) AS n FROM alunos GROUP BY id_municipio",
        c="""SELECT *, sum(n) OVER (ORDER BY n DESC, id_municipio)::DOUBLE / sum(n) OVER () AS cumulative_share FROM s""",
        body=f"""SELECT id_municipio, n, {near('cumulative_share')} AS cumulative_share,
        (SELECT count(*) + 1 FROM c WHERE cumulative_share <= 0.8e0) AS n_80,
        (SELECT count(*) + 1 FROM c WHERE cumulative_share <= 0.9e0) AS n_90 FROM c""",
    ),
}
