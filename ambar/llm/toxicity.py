"""Toxicity by weak supervision.

1. Features of words (whole words and their prefixes, found once, twice or more often in a text) are
   counted over all labelled training documents; those that are far commoner in toxic ones form the lexicons.
2. Voters look at a text: one per root of lexicon entries (it votes or abstains), one that says "nothing found", and fixed
   patterns. The given label is one more, fallible voter.
3. A generative model of the votes given the unknown true class is fitted by EM. It estimates each voter's
   accuracy and, as a tree over the voters that agree most within a class, their correlations, so that voters
   that see the same thing are not counted twice.
4. A linear classifier on the lexicon's features is fitted to the posterior classes, of the sampled texts and, for texts with
   one entry only, of those that have the entry.

Lexicon counts cover all labelled training rows. The label model and the classifier are fitted on a bounded
sample of ``FIT_ROWS`` of them. Scoring is one pass over the texts with a lexicon of bounded size.

Defined results: missing and empty texts get the score of a text without findings; without labelled rows no
document is predicted toxic; with rows of one class only every score is the class's smoothed share; labels that are missing count as none, and a document that
is labelled several times is toxic if any label says so; repeated rows get equal scores; an empty table gives an
empty result. Input columns stay, except those with a result's name.
"""

from __future__ import annotations

import itertools
import operator
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ambar.llm.common import apart, bounded_sample, fold, map_batches, table, texts
from ambar.operators.joins import sized_join

FIT_ROWS = 20_000
LEXICON = 4_000
MIN_SUPPORT = 5  # toxic documents that must have a feature,
MIN_SHARE = 0.005  # and at least this share of them: more than one passage and its copies bring
MIN_BOUND = 0.55
LEVELS = (1, 2, 3, 4, 6)
PREFIXES = (3, 4, 5, 6, 7)
DEPENDENT = 0.05  # mutual information, in nats a row, from which two voters count as correlated within a class
CUT = 0.3
NOTHING_KNOWN = -4.0  # log odds without any labelled row: nothing is taken for toxic
FOLDS, HELD_OUT = 4, 2

# Patterns that often go with abuse in any text.
PATTERNS = [
    re.compile(r"\w[*@#$]{2,}\w*"),
    re.compile(r"(?:!{2,}.*){5}", re.S),
    re.compile(r"\b(?:you are|you're|du bist|tu es|eres) (?:a|an|un|une|ein|eine)\b"),
]
core_of = re.compile(r"^[\W_]+|[\W_]+$").sub


def core_word(word: str) -> str:
    """A lower-case word without punctuation around it."""
    lower = word.lower()
    return lower if lower.isalnum() else core_of("", lower)


def core_features(core: str) -> tuple[str, ...]:
    """A core and its prefixes, as ``kind:text``."""
    return (f"w:{core}", *[f"{n}:{core[:n]}" for n in PREFIXES if len(core) >= n])


def coded_words(column: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct words of a column of texts, and of every word in the column the number of its text and its place among
    the distinct ones. Arrow cuts at the characters between words, and may give empty words. A missing text is empty."""
    words = pc.ascii_split_whitespace(column.fill_null(""))
    coded = words.values.dictionary_encode()
    return coded.dictionary.to_pylist(), np.repeat(np.arange(len(column)), np.diff(words.offsets.to_numpy())), coded.indices.to_numpy()


def tallied(row: np.ndarray, item: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, item, count) of the distinct pairs, in order; items are less than ``size``."""
    pair, n = np.unique(row * max(size, 1) + item, return_counts=True)
    return *np.divmod(pair, max(size, 1)), n


def expanded(which: np.ndarray, lists: list) -> tuple[np.ndarray, np.ndarray]:
    """Every member of ``lists[w]`` for each ``w`` in ``which``, and the position of that ``w``."""
    sizes = np.array([len(x) for x in lists], np.int64)
    members = np.fromiter(itertools.chain.from_iterable(lists), np.int64, int(sizes.sum()))
    n = sizes[which]
    at = np.repeat(np.arange(len(which)), n)
    within = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
    return members[(np.cumsum(sizes) - sizes)[which[at]] + within], at


def _feature_counts(column: pa.Array, label: np.ndarray):
    """(features, level, clean texts, toxic texts that have them as often) of a column of texts, a kind and level at a time.

    Words are looked at once for the whole column. Their cores are numbered in order, so that the cores of one prefix follow
    each other within a text's sorted words: their counts are added up as runs.
    """
    words, row, code = coded_words(column)
    cores = [core_word(w) for w in words]
    ordered = sorted({*cores} - {""})
    rank = {core: i for i, core in enumerate(ordered)}
    ranks = np.array([rank.get(core, -1) for core in cores], np.int64)[code]
    row, ranks, n = tallied(row[ranks >= 0], ranks[ranks >= 0], len(ordered))
    sizes = np.array([len(core) for core in ordered], np.int64)
    for kind in (None, *PREFIXES):
        names = ordered if kind is None else [core[:kind] for core in ordered if len(core) >= kind]
        if not names:
            continue
        first = np.array([True, *map(operator.ne, names, names[1:])])
        names = pa.array([f"{kind or 'w'}:{name}" for name in itertools.compress(names, first)], pa.string())
        group = np.full(len(ordered), -1)
        group[sizes >= (kind or 0)] = np.cumsum(first) - 1
        group = group[ranks]
        has = np.flatnonzero(group >= 0)
        of, group = row[has], group[has]
        starts = np.flatnonzero(np.append(True, (of[1:] != of[:-1]) | (group[1:] != group[:-1])))
        found, item = np.add.reduceat(n[has], starts), 2 * group[starts] + label[of[starts]]
        for level in LEVELS:
            often = found >= level
            found, item = found[often], item[often]
            counts = np.bincount(item, minlength=2 * len(names)).reshape(-1, 2)
            some = np.flatnonzero(counts.any(1))
            if len(some):
                yield names.take(pa.array(some)), level, counts[some, 0], counts[some, 1]


def _count_features(batches):
    for batch in batches:
        for names, level, clean, toxic in _feature_counts(batch.column("text"), batch.column("_label").to_numpy().astype(np.int64)):
            columns = [names, pa.repeat(pa.scalar(level, pa.int32()), len(names)), pa.array(clean, pa.int64()), pa.array(toxic, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["stem", "level", "clean", "toxic"])


class Finder:
    """Which of some features, ``kind:text@level``, the texts of a column have. A word is looked up once a column."""

    def __init__(self, names: list[str]):
        split = [name.rpartition("@") for name in names]
        self.size = len(names)
        self.stems = {stem: i for i, stem in enumerate(dict.fromkeys(stem for stem, _, _ in split))}
        self.entries = [[] for _ in self.stems]
        for i, (stem, _, _) in enumerate(split):
            self.entries[self.stems[stem]].append(i)
        self.level = np.array([int(level) for _, _, level in split], np.int64)
        # Every feature of a core begins as the core does.
        self.heads = {stem.partition(":")[2][: min(PREFIXES)] for stem in self.stems}

    def find(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the found features, text by text and in order, and where each text's begin, with their end."""
        words, row, code = coded_words(column)
        cores, shortest = map(core_word, words), min(PREFIXES)
        known = [tuple(self.stems[f] for f in core_features(c) if f in self.stems) if c[:shortest] in self.heads else () for c in cores]
        some = np.array([bool(k) for k in known], bool)[code]
        row, code = row[some], code[some]
        stem, at = expanded(code, known)
        row, stem, n = tallied(row[at], stem, len(self.stems))
        entry, at = expanded(stem, self.entries)
        enough = n[at] >= self.level[entry]
        row, entry, _ = tallied(row[at][enough], entry[enough], self.size)
        return entry, np.searchsorted(row, np.arange(len(column) + 1))


@dataclass
class Model:
    """Weights of the lexicon's features and the intercept."""

    weights: dict[str, float] = field(default_factory=dict)
    intercept: float = 0.0

    def scorer(self):
        """What scores a column of texts."""
        names = sorted(self.weights)
        finder, weights = Finder(names), np.array([self.weights[f] for f in names], float)

        def score(column: pa.Array) -> np.ndarray:
            found, at = finder.find(column)
            worth, at = weights[found].tolist(), at.tolist()
            total = np.array([sum(worth[a:b]) for a, b in zip(at, at[1:])], float)
            return 1 / (1 + np.exp(-np.clip(self.intercept + total, -30, 30)))

        return score


def lexicon(labelled: DataFrame, size: int = LEXICON) -> list[str]:
    """The features that tell toxic documents best, by the lower bound of their share of toxic documents."""
    counts = map_batches(labelled.select("text", "_label"), _count_features, "stem string, level int, clean long, toxic long")
    n, p = F.col("toxic") + F.col("clean"), F.col("toxic") / (F.col("toxic") + F.col("clean"))
    z2 = 1.96**2
    wilson = (p + z2 / (2 * n) - 1.96 * F.sqrt((p * (1 - p) + z2 / (4 * n)) / n)) / (1 + z2 / n)
    totals = labelled.groupBy("_label").count().collect()
    toxic = {r["_label"]: r["count"] for r in totals}
    least = max(MIN_SUPPORT, MIN_SHARE * toxic.get(1, 0))
    rows = (
        counts.groupBy("stem", "level").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .where(F.col("toxic") >= least)
        .withColumn("bound", wilson)
        .where(F.col("bound") > MIN_BOUND)
        .withColumn("feature", F.concat("stem", F.lit("@"), F.col("level").cast("string")))
        .orderBy(F.desc("bound"), F.desc(F.length("feature")), "feature")
        .limit(size)
        .collect()
    )
    return [r["feature"] for r in rows]


def select(found: list[np.ndarray], label: np.ndarray, size: int) -> list[int]:
    """Entries, best first, that still tell toxic documents among those without any better entry.

    A short prefix that is common in toxic documents only because of one word in them goes.
    """
    holders = [[] for _ in range(size)]
    for row, entries in enumerate(found):
        for f in entries:
            holders[f].append(row)
    covered, chosen, least = np.zeros(len(found), bool), [], max(4, 0.03 * label.sum())
    for f in range(size):
        rows = np.array([r for r in holders[f] if not covered[r]], np.int64)
        toxic = int(label[rows].sum())
        # What adds nothing here may be all that another text has, if it is common enough not to come from one text's copies.
        spare = len(rows) == 0 and len(holders[f]) >= least
        if spare or toxic >= 2 and toxic > 0.6 * len(rows):
            chosen.append(f)
            covered[rows] = True
    return chosen


def voters_of(features: list[str], chosen: list[int]) -> dict[int, str]:
    """The voter that each chosen entry belongs to: its root, the shortest chosen text that it starts with, and whether the
    entry asks for one occurrence or for several. Forms of one root see the same thing, so they have one vote."""
    texts = sorted({features[f].partition(":")[2].rpartition("@")[0] for f in chosen})
    root, last = {}, None
    for text in texts:  # what starts with a text follows it in this order
        last = last if last is not None and text.startswith(last) else text
        root[text] = last
    out = {}
    for f in chosen:
        text, _, level = features[f].partition(":")[2].rpartition("@")
        out[f] = f"{root[text]}:{'once' if level == '1' else 'often'}"
    return out


def _examples(features: list[str]):
    """Entries and patterns found in each sampled row, and its label."""

    def run(batches):
        finder = Finder(features)
        for batch in batches:
            entries, at = finder.find(batch.column("text"))
            found = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(entries, pa.int32()))
            hits = [[bool(p.search(t)) for p in PATTERNS] for t in texts(batch)]
            yield pa.RecordBatch.from_arrays([found, pa.array(hits, pa.list_(pa.bool_())), batch.column("_label")], ["found", "hits", "label"])

    return run


def lone_examples(found: list[np.ndarray], posterior: np.ndarray, features: list[str], chosen: list[int]) -> tuple[list[list[int]], list[float]]:
    """For each chosen entry a text that has it alone, with what the label model believes of the texts that have it.

    Few sampled texts have one entry only, so the classifier would learn what several weigh together but not what
    each is worth. Shorter forms of an entry go with it, and have no example of their own if most of what has them
    has the longer form.
    """
    kept, count, toxic = set(chosen), Counter(), Counter()
    for entries, q in zip(found, posterior):
        for f in kept.intersection(entries):
            count[f] += 1
            toxic[f] += float(q)
    split = {f: (features[f].partition(":")[2].rpartition("@")) for f in chosen}
    examples, targets = [], []
    for f in chosen:
        text, _, level = split[f]
        shorter = [g for g in chosen if text.startswith(split[g][0]) and int(split[g][2]) <= int(level)]
        longer = any(split[g][0].startswith(text) and g not in shorter and split[g][2] == level and count[g] > 0.8 * count[f] for g in chosen)
        if not longer:
            examples.append(shorter)
            targets.append((toxic[f] + 0.5) / (count[f] + 1))
    return examples, targets


def vote_table(found: list[np.ndarray], hits: np.ndarray, label: np.ndarray, features: list[str], chosen: list[int]) -> np.ndarray:
    """A column per voter: the given label, "nothing found", the patterns, the roots of entries. 0 of a root is an
    abstention, whose chance within each class is learned like that of a vote."""
    voters = voters_of(features, chosen)
    place = {name: i for i, name in enumerate(sorted(set(voters.values())))}
    groups = np.zeros((len(found), len(place)), np.int64)
    for row, entries in enumerate(found):
        for f in entries:
            if f in voters:
                groups[row, place[voters[f]]] = 1
    nothing = (groups.sum(1) == 0).astype(np.int64)
    return np.column_stack([label, nothing, hits.astype(np.int64), groups])


def fit_label_model(votes: np.ndarray, rounds: int = 25) -> np.ndarray:
    """Posterior of the class 1 for each row of 0/1 ``votes``, whose first column is the given label."""
    patterns, inverse, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    v = patterns.astype(np.int64)
    n = v.shape[1]
    q = np.where(v[:, 0] == 1, 0.9, 0.1)
    for step in range(rounds):
        if step in (0, 5):  # from the start, or copies of one voter would set the course
            parent = _tree(v, counts, q)
        weight = np.stack([counts * (1 - q), counts * q])
        log = np.log(weight.sum(1) + 1.0)
        log = np.tile(log - np.logaddexp(*log), (len(v), 1)).T
        for i in range(n):
            up = v[:, parent[i]] if parent[i] >= 0 else np.zeros(len(v), np.int64)
            for y in (0, 1):
                tally = np.bincount(2 * up + v[:, i], weights=weight[y], minlength=4).reshape(2, 2) + 0.5
                log[y] += np.log(tally / tally.sum(1, keepdims=True))[up, v[:, i]]
        new = 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50)))
        done, q = np.abs(new - q).max() < 1e-5, new
        if done and step > 5:
            break
    return q[inverse.reshape(-1)]


def _tree(v: np.ndarray, counts: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Each voter's parent in the tree of the strongest dependences given the class."""
    n = v.shape[1]
    strength = np.zeros((n, n))
    for w in (counts * (1 - q), counts * q):
        total = w.sum() + 2.0
        one = v.T @ (w[:, None] * v)
        single = np.diag(one)
        for a in (0, 1):
            for b in (0, 1):
                pa_ = single if a else w.sum() - single
                pb = single if b else w.sum() - single
                both = one if a and b else single[:, None] - one if a else single[None, :] - one if b else w.sum() - single[:, None] - single[None, :] + one
                p = (np.maximum(both, 0) + 0.5) / total
                strength += total * p * np.log(p / (((pa_ + 1.0) / total)[:, None] * ((pb + 1.0) / total)[None, :]))
    # The strongest spanning tree, from the given label on; weak edges are left out of it.
    parent, outside = np.full(n, -1), np.ones(n, bool)
    gain, source = strength[0].copy(), np.zeros(n, np.int64)
    outside[0] = False
    while outside.any():
        child = int(np.argmax(np.where(outside, gain, -np.inf)))
        parent[child] = source[child] if gain[child] > DEPENDENT * counts.sum() else -1
        outside[child] = False
        closer = strength[child] > gain
        gain, source = np.where(closer, strength[child], gain), np.where(closer, child, source)
    return parent


def fit_linear(found: list[np.ndarray], target: np.ndarray, size: int, ridge: float = 2e-6, steps: int = 1500) -> tuple[np.ndarray, float]:
    """Logistic regression on 0/1 features and soft targets, by Adam on the whole sample."""
    rows = np.repeat(np.arange(len(found)), [len(f) for f in found])
    columns = np.concatenate(found).astype(np.int64) if len(rows) else np.empty(0, np.int64)
    w, m, s = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    mean = np.clip(target.mean(), 1e-3, 1 - 1e-3)
    w[size] = np.log(mean / (1 - mean))
    for t in range(1, steps + 1):
        margin = w[size] + np.bincount(rows, weights=w[columns], minlength=len(found))
        error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - target) / len(found)
        grad = np.append(np.bincount(columns, weights=error[rows], minlength=size), error.sum())
        grad[:size] += ridge * w[:size]
        m, s = 0.9 * m + 0.1 * grad, 0.999 * s + 0.001 * grad**2
        w -= 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.999**t)) + 1e-9)
    return w[:size], float(w[size])


def labelled_rows(docs: DataFrame, labels: DataFrame, column: str) -> DataFrame:
    """``text`` and ``_label`` of the documents of the training folds that have a label."""
    own = labels.where(F.col(column).isNotNull() & (fold("doc_id", FOLDS) != HELD_OUT)).groupBy("doc_id").agg((F.max(column) > 0).cast("int").alias("_label"))
    return sized_join(docs.select("doc_id", "text"), own, ["doc_id"], "inner")


def fit(docs: DataFrame, labels: DataFrame, column: str = "toxic", fit_rows: int = FIT_ROWS) -> Model:
    """Steps 1 to 4. Only rows of the training folds are looked at."""
    rows = labelled_rows(docs, labels, column)
    features = lexicon(rows)
    sample = map_batches(bounded_sample(rows, fit_rows), _examples(features), "found array<int>, hits array<boolean>, label int").toPandas()
    label = sample["label"].to_numpy().astype(np.int64)
    if not len(label):
        return Model({}, NOTHING_KNOWN)
    if label.min() == label.max():
        share = (label.sum() + 1) / (len(label) + 2)
        return Model({}, float(np.log(share / (1 - share))))
    found = list(sample["found"])
    chosen = select(found, label, len(features))
    votes = vote_table(found, np.array(sample["hits"].tolist(), bool).reshape(len(label), -1), label, features, chosen)
    number = {f: i for i, f in enumerate(chosen)}
    posterior = fit_label_model(votes)
    alone, targets = lone_examples(found, posterior, features, chosen)
    columns = [np.array([number[f] for f in entries if f in number], np.int64) for entries in [*found, *alone, *alone]]
    weights, intercept = fit_linear(columns, np.concatenate([posterior, targets, targets]), len(chosen))
    return Model({features[f]: float(w) for f, w in zip(chosen, weights) if w}, intercept)


def clean_rows(df: DataFrame, model: Model, cut: float = CUT) -> DataFrame:
    """The rows of ``df`` that score below ``cut``, as they are."""
    rows, names, restored = apart(df)
    return restored(score(rows, model, "_score", names["text"]).where(F.col("_score") < cut))


def score(df: DataFrame, model: Model, name: str = "score", text: str = "text") -> DataFrame:
    """``df`` with the score of its ``text`` in a column ``name``. Texts stay where they are read."""
    df = df.drop(name)
    names = df.columns

    def run(batches):
        of = model.scorer()
        for batch in batches:
            scores = pa.array(of(batch.column(text)), pa.float64())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], scores], [*names, name])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return map_batches(df, run, f"{fields}, `{name}` double")


def op2_toxicity(spark, sf_dir):
    """Score and prediction for every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    # Texts are not part of the result: score them where they are read.
    held_out = (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out")
    out = score(docs.select("doc_id", held_out, "text"), model)
    return out.select("doc_id", "held_out", "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
