"""Language by sparse multinomial logistic regression on TF-IDF character n-grams.

Character 1- to 3-grams of the letters of the whole text are hashed into ``BUCKETS``; document frequencies are
counted over all training documents. The weights are trained by follow-the-regularised-leader with an L1 and an
L2 penalty on a bounded sample of ``FIT_ROWS`` training rows, so that most of them are exactly 0, and a
temperature fitted on rows kept back from it calibrates the probabilities.

Defined results: a missing text, or one without letters, is ``und`` with score 0; so is every text if there is
nothing to learn from; ties go to the language that sorts first; rows without a language are not learned from;
repeated rows get equal results; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ambar.llm.common import code_points, fold, map_batches, table, texts

FIT_ROWS = 6_000
BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
SLICE = 1 << 20  # characters counted at a time
FOLDS, HELD_OUT = 4, 2
LEAST_ROWS = 60  # of each language in the fit sample, where there are as many


# ASCII characters that are not letters count as space.
SPACE_OUT = np.arange(128, dtype=np.uint32)
SPACE_OUT[[c for c in range(128) if not chr(c).isalpha()]] = 32


def has_letter(text: str) -> bool:
    """Whether some character is of a Unicode letter category; numerals such as ½ or Ⅷ are not."""
    return any(map(str.isalpha, text))


def ngram_counts(text: str) -> np.ndarray:
    """How often each bucket's n-grams occur in the text, lower-cased, with runs of spaces as one."""
    total = np.zeros(BUCKETS, np.int64)
    for start in range(0, len(text), SLICE):
        c = code_points(" " + text[start : start + SLICE + max(ORDERS)].lower() + " ")
        c = np.where(c < 128, SPACE_OUT[np.minimum(c, 127)], c)
        c = c[np.append(True, (c[1:] != 32) | (c[:-1] != 32))].astype(np.uint32)
        h = np.zeros(len(c), np.uint32)
        for n in range(1, max(ORDERS) + 1):
            h = h[: len(c) - n + 1] * np.uint32(0x9E3779B1) + c[n - 1 :] + np.uint32(n)
            if n in ORDERS and len(h):
                mixed = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B)
                total += np.bincount(mixed >> np.uint32(32 - 15), minlength=BUCKETS)
    return total


def tfidf(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and their weights, scaled to length 1."""
    at = np.flatnonzero(counts)
    value = (1 + np.log(counts[at])) * idf[at]
    return at, value / max(1e-12, float(np.sqrt(value @ value)))


def _document_frequencies(batches):
    total, n = np.zeros(BUCKETS, np.int64), 0
    for batch in batches:
        for text in texts(batch):
            total += ngram_counts(text) > 0
            n += 1
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array([-1, *at], pa.int32()), pa.array([n, *total[at]], pa.int64())], ["bucket", "n"])


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # languages x (BUCKETS + 1), the last column for the intercept
    idf: np.ndarray
    temperature: float = 1.0

    def predict(self, text: str) -> tuple[str, float]:
        if not self.languages or not has_letter(text):
            return "und", 0.0
        at, value = tfidf(ngram_counts(text), self.idf)
        p = softmax((self.weights[:, at] @ value + self.weights[:, -1]) / self.temperature)
        k = int(np.argmax(p))
        return self.languages[k], float(p[k])


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train_ftrl(
    rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, classes: int,
    alpha: float = 2.0, beta: float = 1.0, l1: float = 0.002, l2: float = 0.01, epochs: int = 2, seed: int = 42,
) -> np.ndarray:
    """Per-coordinate follow-the-regularised-leader with elastic-net penalties."""
    z, n = np.zeros((classes, BUCKETS + 1)), np.zeros((classes, BUCKETS + 1))

    def weights(z, n):
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))

    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            at, value = np.append(rows[i][0], BUCKETS), np.append(rows[i][1], 1.0)
            zi, ni = z[:, at], n[:, at]
            w = weights(zi, ni)
            error = softmax(w @ value)
            error[target[i]] -= 1
            g = error[:, None] * value
            grown = ni + g * g
            z[:, at] = zi + g - (np.sqrt(grown) - np.sqrt(ni)) / alpha * w
            n[:, at] = grown
    return weights(z, n)


def fit_temperature(logits: np.ndarray, target: np.ndarray) -> float:
    """The temperature with the least log loss, by search on a fine scale."""
    if not len(target):
        return 1.0
    loss = lambda t: -np.log(np.maximum(softmax(logits / t)[np.arange(len(target)), target], 1e-12)).mean()
    return float(min(np.exp(np.linspace(np.log(0.02), np.log(5), 120)), key=loss))


def sample_by_language(train: DataFrame, rows: int, least: int = LEAST_ROWS, seed: int = 42) -> DataFrame:
    """About ``rows`` rows in the languages' own proportions, but some ``least`` of each language, or all that it has."""
    sizes = {r["lang"]: r["count"] for r in train.groupBy("lang").count().collect()}
    total = sum(sizes.values())
    if total <= rows:
        return train
    return train.sampleBy("lang", {lang: min(1.0, max(rows / total, least / n)) for lang, n in sizes.items()}, seed)


def fit(train: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """From the ``text`` and ``lang`` of the rows given."""
    train = train.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang")
    counted = map_batches(train.select("text"), _document_frequencies, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    frequency = {r["bucket"]: r["n"] for r in counted}
    idf = np.full(BUCKETS, np.log(1 + frequency.get(-1, 0)) + 1)
    for bucket, n in frequency.items():
        if bucket >= 0:
            idf[bucket] = np.log((1 + frequency[-1]) / (1 + n)) + 1

    def vectors(batches):
        for batch in batches:
            pairs = [tfidf(ngram_counts(t), idf) if has_letter(t) else None for t in texts(batch)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("lang"),
                    pa.array([p and p[0].astype("<u2").tobytes() for p in pairs], pa.binary()),
                    pa.array([p and p[1].astype("<f4").tobytes() for p in pairs], pa.binary()),
                ],
                ["lang", "at", "value"],
            )

    sample = map_batches(sample_by_language(train, fit_rows), vectors, "lang string, at binary, value binary").where("at is not null").toPandas()
    languages = sorted(set(sample["lang"]))
    if not languages:
        return Model([], np.zeros((0, BUCKETS + 1)), idf)
    rows = [(np.frombuffer(a, "<u2").astype(np.int64), np.frombuffer(v, "<f4").astype(float)) for a, v in zip(sample["at"], sample["value"])]
    target = np.array([languages.index(x) for x in sample["lang"]])
    back = np.arange(len(rows)) % 5 == 4  # for the temperature
    weights = train_ftrl([r for r, b in zip(rows, back) if not b], target[~back], len(languages))
    logits = np.array([weights[:, at] @ value + weights[:, -1] for (at, value), b in zip(rows, back) if b]).reshape(-1, len(languages))
    return Model(languages, weights, idf, fit_temperature(logits, target[back]))


def identify(df: DataFrame, model: Model) -> DataFrame:
    """The columns of ``df`` but its text, with ``lang_pred`` and ``score``."""
    names = [c for c in df.columns if c not in ("text", "lang_pred", "score")]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name in names)

    def run(batches):
        for batch in batches:
            found = [model.predict(t) for t in texts(batch)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names], pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                [*names, "lang_pred", "score"],
            )

    return map_batches(df.select(*names, "text"), run, ", ".join(x for x in (fields, "lang_pred string, score double") if x))


def op3_language_id(spark, sf_dir):
    """Predicted language of every document, learned from the training folds."""
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(fold("doc_id", FOLDS) != HELD_OUT))
    held_out = (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out")
    return identify(docs.select("doc_id", held_out, "text"), model)
