"""Features from the surroundings of a row: group statistics, indicators, history and targets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ambar.fixed import ATTENDANCE_EDGES, ATTENDANCE_LABELS, INDICATOR_FEATURES, SCHOOL_SIZE_EDGES, SCHOOL_SIZE_LABELS
from ambar.functions.scalars import cut, state_code
from ambar.operators.joins import BROADCAST_BYTES, sized_join
from ambar.session import materialise


def attach_group_stats(
    df: DataFrame, keys: list[str], stats: list[Column], limit_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Aggregate per group and give every row the statistics of its group.

    The aggregate combines before its shuffle, so a hot group costs nothing; the small result is
    then joined back, which leaves the rows where they are as long as it fits a broadcast.
    """
    grouped = materialise(df.groupBy(*keys).agg(*stats, F.count("*").alias("_group_rows")))
    return sized_join(df, grouped, keys, "left", limit_bytes, rows_col="_group_rows").drop("_group_rows")


def school_stats() -> list[Column]:
    """Attendance mean and sample deviation (0 for a single pupil), pupils and literacy rate of a school."""
    return [
        F.avg("presenca").alias("escola_presenca_media"),
        F.coalesce(F.stddev_samp("presenca"), F.lit(0.0)).alias("escola_presenca_std"),
        F.count("*").alias("escola_num_alunos"),
        F.avg("alfabetizado").alias("escola_taxa_alfabetizacao"),
    ]


def network_stats() -> list[Column]:
    """Attendance mean and pupils of a municipality's network."""
    return [F.avg("presenca").alias("mun_rede_presenca_media"), F.count("*").alias("mun_rede_num_alunos")]


SCHOOL_KEYS = ["id_escola", "ano"]
NETWORK_KEYS = ["id_municipio", "rede", "ano"]


def school_features(df: DataFrame, keys: list[str] = SCHOOL_KEYS) -> DataFrame:
    return attach_group_stats(df, keys, school_stats())


def network_features(df: DataFrame, keys: list[str] = NETWORK_KEYS) -> DataFrame:
    return attach_group_stats(df, keys, network_stats())


def leave_one_out_rate(
    df: DataFrame, keys: list[str] = SCHOOL_KEYS, label: str = "alfabetizado", out: str = "escola_taxa_loo",
    limit_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Label rate of the group without the row itself, so a row's feature never holds its own label.

    NULL where the row is alone. A row without a label counts neither way.
    """
    stats = [F.sum(label).alias("_sum"), F.count(label).alias("_n")]
    own = F.coalesce(F.col(label), F.lit(0))
    counted = F.when(F.col(label).isNull(), 0).otherwise(1)
    rate = F.try_divide((F.col("_sum") - own).cast("double"), F.col("_n") - counted)
    return attach_group_stats(df, keys, stats, limit_bytes).withColumn(out, rate).drop("_sum", "_n")


def interaction_features(df: DataFrame, missing: str = "nan") -> DataFrame:
    """Powers of attendance, deviations from the context where it was attached, and the two bin columns."""
    presence = F.col("presenca")
    added = {
        "presenca_quadratica": presence * presence,
        "presenca_cubica": presence * presence * presence,
        "presenca_categoria": cut(presence, ATTENDANCE_EDGES, ATTENDANCE_LABELS, missing=missing),
    }
    if "escola_presenca_media" in df.columns:
        added["presenca_vs_escola"] = presence - F.col("escola_presenca_media")
    if "mun_rede_presenca_media" in df.columns:
        added["presenca_vs_mun"] = presence - F.col("mun_rede_presenca_media")
    if "escola_num_alunos" in df.columns:
        added["escola_tamanho"] = cut("escola_num_alunos", SCHOOL_SIZE_EDGES, SCHOOL_SIZE_LABELS, missing=missing)
    return df.withColumns(added)


def enrich_indicators(
    df: DataFrame,
    indicators: DataFrame,
    keys: list[str],
    columns: list[str] = INDICATOR_FEATURES,
    prefix: str = "mun_",
    unique: bool = True,
    limit_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Left join municipal indicators and add the state code.

    ``unique`` asserts one indicator row per key, so the row count cannot change. Without it a key
    coarser than the indicator table repeats rows once per match, as plain joins do.
    """
    side = materialise(indicators.select(*keys, *[F.col(c).alias(f"{prefix}{c}") for c in columns]).distinct())
    if unique:
        repeated = side.groupBy(*keys).count().where("count > 1").limit(1).count()
        if repeated:
            raise ValueError(f"indicators are not unique on {keys}")
    return sized_join(df, side, keys, "left", limit_bytes).withColumn("sigla_uf", state_code("id_municipio"))


def widen_targets(targets: DataFrame, years: list[int], prefix: str = "meta_uf_") -> DataFrame:
    """Long targets to one column per target year: full outer joins of the yearly projections."""
    yearly = [
        targets.where(F.col("ano_meta") == year).select("sigla_uf", F.col("meta").alias(f"{prefix}{year}")).distinct()
        for year in years
    ]
    return reduce(lambda a, b: a.join(b, "sigla_uf", "outer"), yearly)


def enrich_targets(df: DataFrame, targets: DataFrame, years: list[int], limit_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Left join the widened state targets on the state code."""
    return sized_join(df, materialise(widen_targets(targets, years)), ["sigla_uf"], "left", limit_bytes)


def state_means(indicators: DataFrame, keys: list[str]) -> DataFrame:
    """Unweighted mean over municipalities of rate and score, per state, network (and year)."""
    return (
        indicators.withColumn("sigla_uf", state_code("id_municipio"))
        .groupBy(*keys)
        .agg(F.avg("taxa_alfabetizacao").alias("taxa_uf_hist"), F.avg("media_portugues").alias("media_uf_hist"))
    )


def add_history(
    df: DataFrame,
    indicators: DataFrame,
    mode: str = "lag",
    year: int | None = None,
    lag: int = 1,
    limit_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Past rate and score of the row's municipality/network (``taxa_hist, media_hist``) and of its
    state/network (``taxa_uf_hist, media_uf_hist``).

    ``lag`` joins the indicators of ``ano - lag``, so train and test rows see the same distance.
    ``fixed`` joins one year's indicators to every row, whatever the row's own year.
    """
    if mode == "fixed":
        period, past = [], indicators.where(F.col("ano") == year)
    elif mode == "lag":
        period, past = ["ano"], indicators.withColumn("ano", F.col("ano") + lag)
    else:
        raise ValueError(f"unknown mode {mode!r}")
    past = materialise(past.select("id_municipio", "rede", *period, "taxa_alfabetizacao", "media_portugues").distinct())
    local = past.withColumnsRenamed({"taxa_alfabetizacao": "taxa_hist", "media_portugues": "media_hist"})
    state = materialise(state_means(past, ["sigla_uf", "rede", *period]))
    out = df.withColumn("sigla_uf", state_code("id_municipio"))
    out = sized_join(out, local, ["id_municipio", "rede", *period], "left", limit_bytes)
    return sized_join(out, state, ["sigla_uf", "rede", *period], "left", limit_bytes)


# --- Fixed values: two-digit codes of the states and their letters ---------------------------
STATE_LETTERS = {
    "11": "RO", "12": "AC", "13": "AM", "14": "RR", "15": "PA", "16": "AP", "17": "TO", "21": "MA", "22": "PI", "23": "CE", "24": "RN", "25": "PB",
    "26": "PE", "27": "AL", "28": "SE", "29": "BA", "31": "MG", "32": "ES", "33": "RJ", "35": "SP", "41": "PR", "42": "SC", "43": "RS", "50": "MS",
    "51": "MT", "52": "GO", "53": "DF",
}


def state_key(code: Column, targets_use: str = "codes") -> Column:
    """The state as the targets name it: its code, or its letters (NULL for an unknown code)."""
    if targets_use == "codes":
        return code
    if targets_use != "letters":
        raise ValueError(f"unknown kind of state name {targets_use!r}")
    return F.element_at(F.create_map(*[F.lit(x) for pair in STATE_LETTERS.items() for x in pair]), code)


class MatchRate:
    """How many rows of a join found their match, counted while the join's rows pass by (no scan of its own).

    ``frame`` is the observed join. After an action on it, :meth:`rate` gives the share, and :meth:`require` raises where
    too few rows matched: a join on keys of another kind would otherwise only show as empty columns.
    """

    def __init__(self, joined: DataFrame, found: Column, name: str):
        self.name, self.seen = name, Observation(name)
        self.frame = joined.observe(self.seen, F.count("*").alias("n_rows"), F.count(F.when(found, 1)).alias("n_matched"))

    def counts(self) -> tuple[int, int]:
        got = self.seen.get
        return got["n_rows"], got["n_matched"]

    def rate(self) -> float:
        rows, matched = self.counts()
        return matched / rows if rows else 1.0

    def require(self, least: float = 0.0) -> float:
        """The rate; raises if rows went through the join and no more than ``least`` of them matched."""
        rate = self.rate()
        if self.counts()[0] and rate <= least:
            raise ValueError(f"{self.name}: {rate:.1%} of the rows found a match; are the keys of one kind?")
        return rate


def enrich_indicators_observed(df: DataFrame, indicators: DataFrame, keys: list[str], **options) -> MatchRate:
    """:func:`enrich_indicators` with the share of rows that found indicators."""
    joined = enrich_indicators(df, indicators.withColumn("_found", F.lit(True)), keys, [*options.pop("columns", INDICATOR_FEATURES), "_found"], **options)
    mark = f"{options.get('prefix', 'mun_')}_found"
    rate = MatchRate(joined, F.col(mark), "indicators")
    rate.frame = rate.frame.drop(mark)
    return rate


def enrich_targets_observed(df: DataFrame, targets: DataFrame, years: list[int], targets_use: str = "codes", limit_bytes: int = BROADCAST_BYTES) -> MatchRate:
    """:func:`enrich_targets` with the share of rows that found targets, for targets keyed by codes or by letters."""
    wide = materialise(widen_targets(targets, years).withColumn("_found", F.lit(True)).withColumnRenamed("sigla_uf", "_state"))
    joined = sized_join(df.withColumn("_state", state_key(F.col("sigla_uf"), targets_use)), wide, ["_state"], "left", limit_bytes)
    rate = MatchRate(joined.drop("_state"), F.col("_found"), "targets")
    rate.frame = rate.frame.drop("_found")
    return rate


def gap_to_target(features: DataFrame, targets: DataFrame, target_year: int) -> DataFrame:
    """Observed rate minus the state's target of one year, per municipality row."""
    wide = materialise(widen_targets(targets, [target_year], prefix="meta_"))
    joined = sized_join(features.withColumn("sigla_uf", F.col("codigo_uf")), wide, ["sigla_uf"], "left")
    return joined.withColumn("gap_meta", F.col("taxa_alfabetizacao") - F.col(f"meta_{target_year}"))
