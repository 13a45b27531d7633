"""SQL text shared by the check queries: the domain views as common table expressions.

``near(x)`` rounds to single precision. Both engines add doubles in their own order, so averages differ
in the last bits; rounding both sides in binary hides that, where decimal rounding would meet ties.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ambar.fixed import LEVELS


def near(sql: str) -> str:
    return f"CAST(CAST({sql} AS FLOAT) AS DOUBLE)"


def near_col(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("float").cast("double")


def near_columns(df, *names: str):
    """The Spark side of :func:`near` for named columns."""
    return df.withColumns({n: near_col(n) for n in names})


LEVEL_SQL = "least(8, greatest(0, floor((proficiencia - 640) / 32)))"

VIEWS = {
    "alunos": """
  SELECT *, CASE WHEN proficiencia >= 743 THEN 1 ELSE 0 END AS alfabetizado FROM (
    SELECT *, 640 + ((id_registro * 7919) % 1000) * 0.2e0 + 86 * coalesce(presenca, CAST(0 AS DOUBLE)) AS proficiencia FROM (
      SELECT o_orderkey AS id_registro, o_custkey AS id_aluno, CAST(year(o_orderdate) AS INTEGER) AS ano,
             concat(CAST(11 + n_regionkey AS VARCHAR), lpad(CAST(n_nationkey AS VARCHAR), 5, '0')) AS id_municipio,
             CAST(n_nationkey * 10 + o_custkey % 10 AS BIGINT) AS id_escola, c_mktsegment AS rede, 2 AS serie,
             CAST(substring(o_orderpriority, 1, 1) AS INTEGER) AS caderno,
             CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_orderkey % 89 = 0 THEN CAST(0 AS DOUBLE)
                  ELSE o_totalprice / 5e5 END AS presenca
      FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey))""",
    "indicadores": """
  SELECT id_municipio, rede, ano, 100 * avg(alfabetizado) AS taxa_alfabetizacao, avg(proficiencia) AS media_portugues, """
    + ", ".join(f"100 * avg(CASE WHEN {LEVEL_SQL} = {i} THEN 1 ELSE 0 END) AS {c}" for i, c in enumerate(LEVELS))
    + """
  FROM alunos GROUP BY id_municipio, rede, ano""",
    "features_ml": f"""
  SELECT *, substring(id_municipio, 1, 2) AS codigo_uf, {" + ".join(LEVELS[:4])} AS soma_niveis_basicos,
         {" + ".join(LEVELS[4:])} AS soma_niveis_avancados
  FROM indicadores""",
    "metas": """
  SELECT CAST(11 + r_regionkey AS VARCHAR) AS sigla_uf, 2024 AS ano_meta, CAST(60 + 2 * r_regionkey AS DOUBLE) AS meta
  FROM region WHERE r_regionkey <> 0
  UNION ALL
  SELECT CAST(11 + r_regionkey AS VARCHAR), 2030, CAST(80 AS DOUBLE) FROM region WHERE r_regionkey <> 4""",
    "metas_wide": """
  SELECT sigla_uf, meta_uf_2024, meta_uf_2030
  FROM (SELECT DISTINCT sigla_uf, meta AS meta_uf_2024 FROM metas WHERE ano_meta = 2024) a
  FULL OUTER JOIN (SELECT DISTINCT sigla_uf, meta AS meta_uf_2030 FROM metas WHERE ano_meta = 2030) b USING (sigla_uf)""",
    "scored": """
  SELECT *, presenca AS score, alfabetizado AS label, CASE WHEN presenca >= 0.5e0 THEN 1 ELSE 0 END AS prediction
  FROM alunos WHERE presenca IS NOT NULL""",
}


def sql(*views: str, body: str, **extra: str) -> str:
    """One statement: the named views (with those they need), extra views, then the body."""
    needs = {
        "indicadores": ["alunos"], "features_ml": ["alunos", "indicadores"], "metas_wide": ["metas"], "scored": ["alunos"],
    }
    wanted = {need for v in views for need in [v, *needs.get(v, [])]}
    parts = [f"{name} AS ({text})" for name, text in VIEWS.items() if name in wanted]
    parts += [f"{name} AS ({text})" for name, text in extra.items()]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body


def hash_sql(key: str, seed: int = 42) -> str:
    """The seeded 32-bit key hash of the sampling operators."""
    return f"('0x' || substr(md5('{seed}:' || CAST({key} AS VARCHAR)), 1, 8))::BIGINT"
