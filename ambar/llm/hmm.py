"""A hidden Markov language model of word sequences, trained by Baum-Welch over the whole training part.

Words are read as symbols: each of the ``hot`` commonest training words is one, and all others fall into
``classes`` symbols by their ending. A state emits a symbol, and a symbol of a class stands for one of its words
with a probability that depends on the training counts of words (add-half smoothing, one unseen word reserved), so

    P(text) = P(symbols | model) * product of P(word | its symbol).

The first factor is computed exactly by the scaled forward recursion over the whole text; the second needs
each word's training count. The ``known`` commonest words carry theirs to where the text is read; the others get it
from a join with the table of counts that spreads frequent keys, so no task meets more than a share of any word.

Training: every partition runs forward and backward over its documents and adds up expected counts of starts,
transitions and emissions; these are summed over partitions and give the next parameters. Symbol sequences are
stored once and read by each round. Documents lie side by side in lanes, so one numpy step advances many. A text that
is longer than ``TOGETHER`` symbols goes backward in blocks, whose forward values are computed again from the value at
the block's start, so that memory doesn't grow with it.

Defined results: a missing text is empty: its one token is the end; a doc_id that is missing counts as the empty
text for the fold; repeated rows are learned from and scored each; without training rows every count is 0; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ambar.llm.common import fold, kept_once, map_batches, table
from ambar.operators.joins import salted_join

HOT = 8_000
CLASSES = 1_024
KNOWN = 200_000
STATES = 8
ROUNDS = 4
END = b"\n"  # no word holds a line break
FOLDS, HELD_OUT = 5, 1
LANES = 4_096
TOGETHER = 1_000_000  # symbols of documents that are advanced together
FLUSH = 400_000
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def raw_texts(batch: pa.RecordBatch) -> list[bytes]:
    """Texts as UTF-8; a missing one is empty."""
    return [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]


def tokens_of(text: bytes) -> list[bytes]:
    """Words in lower case, then the end. Splitting bytes cuts at just the six white-space characters of the contract."""
    words = text.translate(LOWER).split()
    words.append(END)
    return words


def class_of(word: bytes, classes: int) -> int:
    """Words with equal last two characters share a class."""
    return xxhash.xxh32_intdigest(word.decode("utf-8", "replace")[-2:].encode()) % classes


def _count_words(batches):
    """Words and counts, flushed when there are many."""
    counts = Counter()

    def rows():
        out = pa.RecordBatch.from_arrays([pa.array(list(counts.keys()), pa.binary()).cast(pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])
        counts.clear()
        return out

    for batch in batches:
        for text in raw_texts(batch):
            counts.update(tokens_of(text))
        if len(counts) > FLUSH:
            yield rows()
    yield rows()


def word_counts(train: DataFrame) -> DataFrame:
    """The full table of training words and their counts, stored."""
    return kept_once(map_batches(train.select("text"), _count_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")))


@dataclass
class Vocabulary:
    """The commonest words with their counts, the first ``hot`` of which are symbols of their own, and what the classes hold.
    Words of one count are known together or not at all."""

    words: list[bytes]  # by falling count
    counts: np.ndarray
    hot: int  # words that are symbols
    classes: int
    total: int  # N
    distinct: int  # V
    class_total: np.ndarray  # counts of the class's words
    class_distinct: np.ndarray

    @property
    def symbols(self) -> int:
        return self.hot + self.classes

    def first_counts(self) -> np.ndarray:
        """Training counts of the symbols."""
        out = np.zeros(self.symbols, np.int64)
        own = self.counts[: self.hot]
        out[: len(own)], out[self.hot :] = own, self.class_total
        return out

    def below(self) -> np.ndarray:
        """log10 of what a word's count + 1/2 is divided by within its symbol: half for each word and for an unseen one."""
        out = np.zeros(self.symbols)
        out[self.hot :] = np.log10(self.class_total + 0.5 * (self.class_distinct + 1))
        return out


class Reader(dict):
    """Numbers of words: the known ones by rank, others behind them as they come."""

    def __init__(self, vocab: Vocabulary, limit: int = 500_000):
        super().__init__()
        self.vocab, self.limit = vocab, limit
        self.reset()

    def reset(self) -> None:
        vocab = self.vocab
        self.clear()
        self.update(zip(vocab.words, range(len(vocab.words))))
        self.symbol = [k if k < vocab.hot else vocab.hot + class_of(w, vocab.classes) for k, w in enumerate(vocab.words)]
        self.array = np.array(self.symbol, np.int32)

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self.symbol)
        self.symbol.append(self.vocab.hot + class_of(word, self.vocab.classes))
        return number

    def read(self, tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and symbols of the tokens."""
        numbers = np.fromiter(map(self.__getitem__, tokens), np.int64, len(tokens))
        if len(self.symbol) > len(self.array):
            self.array = np.concatenate([self.array, np.array(self.symbol[len(self.array) :], np.int32)])
        symbols = self.array[numbers]
        if len(self.symbol) > len(self.vocab.words) + self.limit:
            self.reset()
        return numbers, symbols


def _class_rows(classes: int):
    def run(batches):
        total, distinct = np.zeros(classes, np.int64), np.zeros(classes, np.int64)
        for batch in batches:
            own = np.array([class_of(w, classes) for w in batch.column("word").cast(pa.binary()).to_pylist()], np.int64)
            if len(own):
                total += np.bincount(own, weights=batch.column("n").to_numpy(), minlength=classes).astype(np.int64)
                distinct += np.bincount(own, minlength=classes)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(classes)), pa.array(total), pa.array(distinct)], ["k", "n", "v"])

    return run


def behind(counts: DataFrame, words: list[bytes], ns: np.ndarray, rank: int) -> DataFrame:
    """The words behind the first ``rank`` of ``words`` in the order of falling count."""
    last = min(rank, len(words)) - 1
    if last < 0:
        return counts
    n, word = int(ns[last]), words[last].decode()
    return counts.where((F.col("n") < n) | ((F.col("n") == n) & (F.col("word") > word)))


def least_known_size(counts: DataFrame, known: int) -> int:
    """The least size class that, with all larger ones, has no more than ``known`` words.

    Counts up to 1,024 are classes of their own and larger ones go by sixteenths of their logarithm, so that the driver
    gets some thousand rows, and later ``known`` words at most, however many words there are and tasks that hold them.
    """
    sizes = {r["size"]: r["count"] for r in counts.groupBy(size_class().alias("size")).count().collect()}
    total, least = 0, 1 << 20
    for size in sorted(sizes, reverse=True):
        total += sizes[size]
        if total > known:
            break
        least = size
    return least


def size_class():
    n = F.col("n")
    return F.when(n <= 1024, n).otherwise((F.log2(n.cast("double")) * 16).cast("long") + 1024)


def vocabulary(counts: DataFrame, hot: int = HOT, classes: int = CLASSES, known: int = KNOWN) -> Vocabulary:
    """Bounded: ``known`` words with counts and ``classes`` sums reach the driver."""
    if hot + classes > 65_536 or known < hot:
        raise ValueError("more symbols than 16 bits hold, or fewer known words than symbols")
    sums = counts.agg(F.sum("n"), F.count("*")).first()
    top = sorted(counts.where(size_class() >= least_known_size(counts, known)).collect(), key=lambda r: (-r["n"], r["word"].encode()))
    words, ns = [r["word"].encode() for r in top], np.array([r["n"] for r in top], np.int64)
    cold = behind(counts, words, ns, hot)
    rows = map_batches(cold, _class_rows(classes), "k long, n long, v long").groupBy("k").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect()
    total, distinct = np.zeros(classes, np.int64), np.zeros(classes, np.int64)
    for r in rows:
        total[r["k"]], distinct[r["k"]] = r["n"], r["v"]
    return Vocabulary(words, ns, hot, classes, sums[0] or 0, sums[1], total, distinct)


@dataclass
class Parameters:
    start: np.ndarray  # states
    move: np.ndarray  # states x states, rows sum to 1
    emit: np.ndarray  # symbols x states, columns sum to 1


def first_parameters(counts: np.ndarray, states: int, seed: int = 42) -> Parameters:
    """Near the training shares of symbols, with the states told apart by chance."""
    random = np.random.default_rng(seed)
    emit = (counts[:, None] + 0.5) * np.exp(random.normal(0, 0.5, (len(counts), states)))
    move = np.full((states, states), 0.1 / max(1, states - 1)) + np.eye(states) * 0.9
    return Parameters(np.full(states, 1 / states), move / move.sum(1, keepdims=True), emit / emit.sum(0))


def lay_lanes(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents put one after the other into lanes of about equal length.

    Gives the symbols (steps x lanes, -1 where a lane has ended), the document that each place belongs to, and
    where documents start.
    """
    longest, total = max(map(len, sequences)), sum(map(len, sequences))
    lanes = max(1, min(LANES, len(sequences), total // longest))
    ends, places = [(0, lane) for lane in range(lanes)], []
    for doc in sorted(range(len(sequences)), key=lambda d: -len(sequences[d])):
        at, lane = ends[0]
        places.append((doc, lane, at))
        heapq.heapreplace(ends, (at + len(sequences[doc]), lane))
    steps = max(ends)[0]
    # A document is contiguous along its lane.
    symbols, owner, first = np.full((lanes, steps), -1, np.int32), np.full((lanes, steps), -1, np.int32), np.zeros((lanes, steps), bool)
    for doc, lane, at in places:
        n = len(sequences[doc])
        symbols[lane, at : at + n], owner[lane, at : at + n], first[lane, at] = sequences[doc], doc, True
    return np.ascontiguousarray(symbols.T), np.ascontiguousarray(owner.T), np.ascontiguousarray(first.T)


def starts_by_step(first: np.ndarray) -> list[np.ndarray | None]:
    """Lanes in which a document starts, for each step."""
    step, lane = np.nonzero(first)
    cuts = np.searchsorted(step, np.arange(len(first) + 1))
    return [lane[a:b] if b > a else None for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]


def forward(p: Parameters, symbols: np.ndarray, first: np.ndarray, keep: bool, dtype=np.float64, alpha: np.ndarray | None = None, emitted: np.ndarray | None = None):
    """The scaled forward recursion from ``alpha``. Gives the scales (steps x lanes; their logs add up to log P), the
    scaled alphas if wanted, and the last alpha. Symbol -1 is a lane that has ended: it emits with certainty."""
    steps, lanes = symbols.shape
    states = len(p.start)
    scales, alphas = np.ones((steps, lanes), dtype), np.empty((steps, lanes, states), dtype) if keep else None
    emit = np.vstack([p.emit, np.ones(states)]).astype(dtype)
    start, move, ones = p.start.astype(dtype), p.move.astype(dtype), np.ones(states, dtype)
    alpha = np.tile(start, (lanes, 1)) if alpha is None else alpha
    new = np.empty_like(alpha)
    begin = starts_by_step(first)
    for t in range(steps):
        out = alphas[t] if keep else new
        np.matmul(alpha, move, out=out)
        if begin[t] is not None:
            out[begin[t]] = start
        out *= emit[symbols[t]] if emitted is None else emitted[t]
        scale = np.matmul(out, ones, out=scales[t])
        out /= scale[:, None]
        if keep:
            alpha = out
        else:
            alpha, new = out, alpha
    return scales, alphas, alpha.copy()


def expected_counts(p: Parameters, sequences: list[np.ndarray], totals: Parameters, dtype=np.float64, together: int | None = None) -> float:
    """Adds the expected starts, moves and emissions of the sequences to ``totals``; returns their log likelihood.

    Steps go in blocks of about ``together`` symbols: a first pass keeps the value at each block's start, and blocks are
    then gone through from the last, forward again and backward.
    """
    symbols, _, first = lay_lanes(sequences)
    steps, lanes = symbols.shape
    states, length = len(p.start), max(1, (together or TOGETHER) // lanes)
    cuts = [*range(0, steps, length), steps]
    blocks = list(zip(cuts[:-1], cuts[1:]))
    # The last block needs no value of its own beforehand.
    at_start, alpha = [None], None
    for a, b in blocks[:-1]:
        _, _, alpha = forward(p, symbols[a:b], first[a:b], keep=False, dtype=dtype, alpha=alpha)
        at_start.append(alpha.copy())
    emit, back, moved, likelihood = np.vstack([p.emit, np.ones(states)]).astype(dtype), np.ascontiguousarray(p.move.T).astype(dtype), np.zeros_like(p.move), 0.0
    beta = np.ones((lanes, states), dtype)
    for (a, b), before in zip(reversed(blocks), reversed(at_start)):
        own, begins = symbols[a:b], first[a:b]
        emitted = emit[own]
        scales, alphas, _ = forward(p, own, begins, keep=True, dtype=dtype, alpha=None if before is None else before.copy(), emitted=emitted)
        begin = starts_by_step(begins)
        emitted /= scales[..., None]
        gammas = np.empty_like(alphas)
        for t in range(b - a - 1, -1, -1):
            gammas[t] = beta
            ahead = np.multiply(emitted[t], beta, out=emitted[t])
            beta = np.matmul(ahead, back)
            if begin[t] is not None:
                beta[begin[t]] = 1
        gammas *= alphas
        gammas /= gammas.sum(2, keepdims=True)
        # emitted now holds what each step passes back; a move leads into a step that goes on with its document.
        real = own >= 0
        emitted[~(real & ~begins)] = 0
        previous = np.concatenate([np.zeros((1, lanes, states), dtype) if before is None else before[None], alphas[:-1]])
        moved += previous.reshape(-1, states).T @ emitted.reshape(-1, states)
        totals.start += gammas[begins].sum(0)
        used, kept = own[real], gammas[real]
        for k in range(states):
            totals.emit[:, k] += np.bincount(used, weights=kept[:, k], minlength=len(p.emit))
        likelihood += float(np.log(scales[real], dtype=np.float64).sum())
    totals.move += p.move * moved
    return likelihood


def similar(data: list[np.ndarray]):
    """Numbers of the sequences in groups of about ``TOGETHER`` symbols and of like lengths, which fill many lanes."""
    group, size = [], 0
    for i in sorted(range(len(data)), key=lambda i: len(data[i])):
        if group and size + len(data[i]) > TOGETHER:
            yield group
            group, size = [], 0
        group.append(i)
        size += len(data[i])
    if group:
        yield group


def stored_symbols(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(s, "<u2").astype(np.int32) for s in batch.column("symbols").to_pylist()]


def _round(p: Parameters):
    """Expected counts of a partition: one row per symbol, and one each for starts, moves and the likelihood."""

    def run(batches):
        states = len(p.start)
        totals, likelihood = Parameters(np.zeros(states), np.zeros((states, states)), np.zeros_like(p.emit)), 0.0
        for batch in batches:
            data = stored_symbols(batch)
            for group in similar(data):
                likelihood += expected_counts(p, [data[i] for i in group], totals, np.float32)
        kinds = [*range(len(p.emit)), -1, *range(-2, -2 - states, -1), -1000]
        rows = [*totals.emit, totals.start, *totals.move, np.append(likelihood, np.zeros(states - 1))]
        some = [i for i, r in enumerate(rows) if r.any()]
        table = np.array([rows[i] for i in some]).reshape(-1, states)
        yield pa.RecordBatch.from_arrays(
            [pa.array([kinds[i] for i in some], pa.int64()), *[pa.array(table[:, k], pa.float64()) for k in range(states)]], ["kind", *[f"c{k}" for k in range(states)]]
        )

    return run


def baum_welch(sequences: DataFrame, p: Parameters, rounds: int = ROUNDS) -> tuple[Parameters, list[float]]:
    """``rounds`` of expected counts over all stored sequences; what is gathered has a row per symbol."""
    states, history = len(p.start), []
    names = [f"c{k}" for k in range(states)]
    for _ in range(rounds):
        partial = map_batches(sequences.select("symbols"), _round(p), "kind long, " + ", ".join(f"{c} double" for c in names))
        rows = partial.groupBy("kind").agg(*[F.sum(c).alias(c) for c in names]).collect()
        emit, move, start = np.full_like(p.emit, 1e-3), np.full((states, states), 0.1), np.full(states, 0.1)
        for r in rows:
            values = [r[c] for c in names]
            if r["kind"] >= 0:
                emit[r["kind"]] += values
            elif r["kind"] == -1:
                start += values
            elif r["kind"] == -1000:
                history.append(values[0])
            else:
                move[-2 - r["kind"]] += values
        p = Parameters(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))
    return p, history


def _read(held):
    """For each document its symbols, the sums over its known words, and the other words with their repeats."""

    def run(batches):
        vocab = held.value
        reader, known = Reader(vocab), len(vocab.words)
        n, v = vocab.total, vocab.distinct
        lower = np.log10(vocab.counts + 0.5)
        base, within = lower - np.log10(n + 0.5 * (v + 1)), np.where(np.arange(known) < vocab.hot, 0.0, lower)
        below = vocab.below()
        for batch in batches:
            out = {name: [] for name in DOCUMENTS.names[2:]}
            for text in raw_texts(batch):
                tokens = tokens_of(text)
                numbers, symbols = reader.read(tokens)
                sure = numbers[numbers < known]
                rare = Counter([tokens[i] for i in np.flatnonzero(numbers >= known).tolist()])
                out["n_tokens"].append(len(tokens))
                out["known_tokens"].append(len(sure))
                out["known_base"].append(float(base[sure].sum()))
                out["known_log"].append(float(within[sure].sum() - below[symbols].sum()))
                out["symbols"].append(symbols.astype("<u2").tobytes())
                out["words"].append(list(rare.keys()))
                out["counts"].append(list(rare.values()))
            columns = [batch.column("_row"), batch.column("held_out")]
            for name in DOCUMENTS.names[2:]:
                kind = DOCUMENTS.field(name).type
                columns.append(pa.array(out[name], pa.list_(pa.binary())).cast(kind) if name == "words" else pa.array(out[name], kind))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", *DOCUMENTS.names])

    return run


DOCUMENTS = pa.schema([
    ("_row", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("known_tokens", pa.int64()), ("known_base", pa.float64()),
    ("known_log", pa.float64()), ("symbols", pa.binary()), ("words", pa.list_(pa.string())), ("counts", pa.list_(pa.int64())),
])
SMALL = "doc_id long, _row long, held_out boolean, n_tokens long, known_tokens long, known_base double, known_log double"


def read_texts(rows: DataFrame, vocab: Vocabulary) -> DataFrame:
    """``rows`` (doc_id, text, held_out) as numbered symbol sequences, stored."""
    held = rows.sparkSession.sparkContext.broadcast(vocab)
    numbered = rows.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "held_out", F.monotonically_increasing_id().alias("_row"))
    return kept_once(map_batches(numbered, _read(held), f"{SMALL}, symbols binary, words array<string>, counts array<long>"), compression="zstd")


def _likelihood(p: Parameters):
    """log10 P(symbols) of each stored sequence, by the forward recursion over all of it."""

    def run(batches):
        for batch in batches:
            data = stored_symbols(batch)
            out = np.zeros(len(data))
            for group in similar(data):
                symbols, owner, first = lay_lanes([data[i] for i in group])
                scales, _, _ = forward(p, symbols, first, keep=False)
                real = owner >= 0
                out[group] = np.bincount(owner[real], weights=np.log10(scales[real]), minlength=len(group))
            names = [c for c in batch.schema.names if c != "symbols"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(out)], [*names, "_forward"])

    return run


def score_texts(
    docs: DataFrame, held_out, states: int = STATES, rounds: int = ROUNDS, hot: int = HOT, classes: int = CLASSES, known: int = KNOWN
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): counts, the base score and the model's log10 probability.

    More ``hot`` words and ``classes`` make a finer model and larger emission tables (states x symbols, on every
    worker); more ``known`` words leave fewer to the join and take some 150 bytes each on every worker.
    """
    rows = docs.select("doc_id", F.col("text"), held_out.alias("held_out"))
    counts = word_counts(rows.where("NOT held_out"))
    vocab = vocabulary(counts, hot, classes, known)
    read = read_texts(rows, vocab)
    p, _ = baum_welch(read.where("NOT held_out"), first_parameters(vocab.first_counts(), states), rounds)

    # Words that are not among the known meet their counts.
    n, v = vocab.total, vocab.distinct
    rare = read.select("_row", F.explode(F.arrays_zip("words", "counts")).alias("w")).select("_row", F.col("w.words").alias("word"), F.col("w.counts").alias("k"))
    met = salted_join(rare, behind(counts, vocab.words, vocab.counts, known), ["word"], "left", rows_col="n").withColumn("c", F.coalesce("n", F.lit(0)))
    sums = met.groupBy("_row").agg(
        F.sum(F.col("k") * F.log10(F.col("c") + 0.5)).alias("rare_log"), F.sum(F.when(F.col("c") > 0, F.col("k")).otherwise(0)).alias("rare_known"), F.sum("k").alias("rare_tokens")
    )
    own = map_batches(read.select(*[c.split()[0] for c in SMALL.split(", ")], "symbols"), _likelihood(p), f"{SMALL}, _forward double")
    out = own.join(sums, "_row", "left").na.fill(0, ["rare_log", "rare_known", "rare_tokens"])
    scale = float(np.log10(n + 0.5 * (v + 1)))
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("known_tokens") + F.col("rare_known")).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (F.col("known_base") + F.col("rare_log") - F.col("rare_tokens") * scale).alias("base_score"),
        (F.col("_forward") + F.col("known_log") + F.col("rare_log")).alias("score"),
    )


def op5_hmm_score(spark, sf_dir):
    """Base score and model score of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_texts(docs, fold("doc_id", FOLDS) == HELD_OUT)
