"""Document quality by hierarchical empirical Bayes over sites.

1. A document classifier (logistic regression on shape statistics of the whole text) is fitted on labelled
   training rows and gives every document its evidence p.
2. Grouped aggregation adds up the evidence per path and per host. Hosts are shrunk toward the global share and
   paths toward their host, by strengths estimated from how much hosts, and paths within hosts, differ beyond
   what their sizes explain. Sparse sites thus keep to the prior above them.
3. A document's posterior replaces the global prior odds in its evidence by those of its path.

A document's host is its ``source`` and its path is ``source/lang`` unless other columns are named. Aggregates hold
one row per site and are joined back by measured size, with hot sites spread.

Defined results: missing and empty texts get the evidence of a text without words; a missing host or path is a
site of its own; without labelled rows of both classes the evidence is the smoothed share and everything at or
above ``CUT`` is kept; repeated rows count as often as they occur; an empty table gives an empty result; input
columns stay, except those with a result's name.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ambar.llm.common import apart, bounded_sample, find_words, fold, kept_once, map_batches, table, texts
from ambar.llm.toxicity import FOLDS, HELD_OUT, labelled_rows
from ambar.operators.joins import sized_join

FIT_ROWS = 20_000
CUT = 0.5
LOGIT = 12.0  # evidence is kept within +-LOGIT, so that one document can't outweigh any prior
MAX_STRENGTH = 1e6

STATISTICS = ["log_words", "symbols", "bars", "shouts", "digits", "capitals", "word_length", "distinct", "one_word", "repeated_lines", "repeated_pairs", "long_words"]


def statistics(text: str) -> list[float]:
    """Shape of a whole text; shares lie between 0 and 1."""
    words = find_words(text)
    n = max(1, len(words))
    chars = max(1, sum(map(len, words)))
    seen = Counter(words)
    lines = [line for line in text.split("\n") if line.strip()]
    pairs = Counter(zip(words, words[1:]))
    return [
        float(np.log1p(len(words))),
        sum(map(text.count, "#*$%&<>")) / chars,
        seen["|"] / n,
        min(1.0, text.count("!") / n),
        sum(map(text.count, "0123456789")) / chars,
        sum(c.isupper() for c in text) / chars,
        min(1.0, chars / n / 20),
        # Of equally many words: longer texts repeat more.
        min(1.0, len(seen) / n**0.8) if words else 0.0,
        max(seen.values(), default=0) / n,
        1 - len(set(lines)) / max(1, len(lines)),
        sum(k for k in pairs.values() if k > 2) / n,
        sum(len(w) > 25 for w in words) / n,
    ]


@dataclass
class Evidence:
    """A standardised logistic regression on the statistics and their squares."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def design(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.hstack([np.ones((len(z), 1)), z, z * z])

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.design(x) @ self.weights, -LOGIT, LOGIT)


def fit_evidence(docs: DataFrame, labels: DataFrame, column: str = "quality", fit_rows: int = FIT_ROWS) -> Evidence:
    """On a bounded sample of the labelled rows of the training folds, by Newton steps with a small ridge."""
    rows = bounded_sample(labelled_rows(docs, labels, column).select("text", "_label"), fit_rows)

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([statistics(t) for t in texts(batch)], pa.list_(pa.float64())), batch.column("_label")], ["x", "label"])

    sample = map_batches(rows, run, "x array<double>, label int").toPandas()
    d = len(STATISTICS)
    x = np.array(sample["x"].tolist(), float).reshape(-1, d)
    y = sample["label"].to_numpy().astype(float)
    model = Evidence(np.zeros(d), np.ones(d), np.zeros(2 * d + 1))
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        model.weights[0] = np.log(share / (1 - share))
        return model
    model.mean, model.scale = x.mean(0), np.maximum(x.std(0), 1e-3)
    a, w = model.design(x), model.weights
    penalty = np.full(len(w), 0.5)
    penalty[0] = 1e-6
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + np.diag(penalty), a.T @ (y - p) - penalty * w)
        w = w + step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    model.weights = w
    return model


def with_evidence(df: DataFrame, model: Evidence, with_text: bool = False, text: str = "text") -> DataFrame:
    """The columns of ``df``, without its text unless that is asked for, and ``_logit``."""
    names = [c for c in df.columns if c != text or with_text]

    def run(batches):
        for batch in batches:
            x = np.array([statistics(t) for t in texts(batch, text)], float).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(model.logit(x), pa.float64())], [*names, "_logit"])

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in df.schema.fields if f.name in names)
    return map_batches(df, run, f"{fields}_logit double")


def shrunk(good: Column, n: Column, prior: Column, strength: Column) -> Column:
    return (good + strength * prior) / (n + strength)


def strength(groups: DataFrame, prior: Column) -> float:
    """How many documents the prior is worth, by the method of moments.

    Groups whose shares differ from their prior no more than their sizes explain make it large.
    """
    n, d = F.col("n").cast("double"), F.col("good") / F.col("n") - prior
    row = groups.agg(
        F.sum(n).alias("n"), F.count("*").alias("k"), F.sum(n * d * d).alias("between"), F.sum(n * prior * (1 - prior)).alias("spread")
    ).first()
    if not row["n"] or row["k"] < 2 or not row["spread"]:
        return MAX_STRENGTH
    v = row["spread"] / row["n"]  # mean of p (1 - p)
    # E[sum n d^2] = sum (v + n tau^2) - ..., so tau^2 is what is left over, per document.
    tau2 = max(0.0, (row["between"] - row["k"] * v) / max(1.0, row["n"] - row["k"]))
    return float(min(MAX_STRENGTH, max(1.0, v / tau2 - 1 if tau2 > 0 else MAX_STRENGTH)))


def site_posteriors(evidence: DataFrame) -> tuple[DataFrame, float]:
    """One row per ``_host`` and ``_path`` with the sums, sizes and strengths that its posterior share follows from, and
    the global share."""
    p = 1 / (1 + F.exp(-F.col("_logit")))
    # Rounded sums come out the same whatever the order of the rows.
    paths = kept_once(evidence.groupBy("_host", "_path").agg(F.sum(F.round(p, 9).cast("decimal(28,9)")).cast("double").alias("good"), F.count("*").alias("n")))
    total = paths.agg(F.sum("good"), F.sum("n")).first()
    share = ((total[0] or 0) + 1) / ((total[1] or 0) + 2)
    hosts = paths.groupBy("_host").agg(F.sum("good").alias("good"), F.sum("n").alias("n"))
    own = strength(hosts, F.lit(share))
    hosts = hosts.select("_host", F.col("good").alias("_host_good"), F.col("n").alias("_host_n"))
    joined = kept_once(sized_join(paths, kept_once(hosts), ["_host"], "inner"))
    host_share = shrunk(F.col("_host_good"), F.col("_host_n"), F.lit(share), F.lit(own))
    within = strength(joined, host_share)
    return joined.select("_host", "_path", "_host_good", "_host_n", "good", "n", F.lit(own).alias("_own"), F.lit(within).alias("_within")), share


def posterior_without(p: Column | None, share: float) -> Column:
    """A path's posterior share, from the other documents only if a document's own evidence ``p`` is given.

    A document's evidence enters its score once; counted again in its site it would weigh double at sparse sites.
    """
    good, n = (F.col("good"), F.col("n")) if p is None else (F.greatest(F.col("good") - p, F.lit(0.0)), F.col("n") - 1)
    host_good, host_n = (F.col("_host_good"), F.col("_host_n")) if p is None else (F.greatest(F.col("_host_good") - p, F.lit(0.0)), F.col("_host_n") - 1)
    return shrunk(good, n, shrunk(host_good, host_n, F.lit(share), F.col("_own")), F.col("_within"))


def _at_sites(df: DataFrame, host: str, path: str, columns: list[str]) -> DataFrame:
    site = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) if c in df.columns else F.lit("")
    return df.select(*columns, site(host).alias("_host"), F.concat_ws("/", site(host), site(path)).alias("_path"))


def _scored(evidence: DataFrame, sites: DataFrame, share: float) -> DataFrame:
    """``evidence`` with ``site_share`` and ``score``: the prior odds in the evidence give way to those of the path."""
    joined = sized_join(evidence, sites, ["_host", "_path"], "left", rows_col="n")
    others = posterior_without(1 / (1 + F.exp(-F.col("_logit"))), share)
    prior = F.greatest(F.least(others, F.lit(1 - 1e-6)), F.lit(1e-6))
    score = 1 / (1 + F.exp(-(F.col("_logit") + F.log(prior / (1 - prior)) - float(np.log(share / (1 - share))))))
    return joined.withColumns({"site_share": others, "score": score})


def quality(df: DataFrame, model: Evidence, host: str = "source", path: str = "lang", cut: float = CUT) -> DataFrame:
    """``doc_id``, ``evidence``, ``site_share``, ``score`` and ``kept`` of each row.

    The text is read once; what is stored and joined is a few numbers per document.
    """
    evidence = kept_once(with_evidence(_at_sites(df, host, path, ["doc_id", "text"]), model))
    sites, share = site_posteriors(evidence)
    scored = _scored(evidence, kept_once(sites), share)
    return scored.select("doc_id", (1 / (1 + F.exp(-F.col("_logit")))).alias("evidence"), "site_share", "score", (F.col("score") >= cut).alias("kept"))


def good_rows(df: DataFrame, model: Evidence, host: str = "source", path: str = "lang", cut: float = CUT) -> DataFrame:
    """The rows of ``df`` that :func:`quality` keeps, as they are. Texts are read twice and never shuffled with small site tables."""
    rows, names, restored = apart(df)
    host, path, text = names.get(host, host), names.get(path, path), names["text"]
    sites, share = site_posteriors(kept_once(with_evidence(_at_sites(rows, host, path, [text]), model, text=text)))
    evidence = with_evidence(_at_sites(rows, host, path, rows.columns), model, with_text=True, text=text)
    return restored(_scored(evidence, kept_once(sites), share).where(F.col("score") >= cut))


def op7_site_quality(spark, sf_dir):
    """Evidence, site posterior, score and verdict for every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    model = fit_evidence(docs, table(spark, sf_dir, "labels"))
    out = quality(docs, model)
    return out.withColumn("held_out", fold("doc_id", FOLDS) == HELD_OUT).select("doc_id", "held_out", "evidence", "site_share", "score", "kept")
