"""Spelling variants: pairs of words one edit apart by pivotal grams, and the form that each word varies.

1. Words are counted per task and summed by word.
2. Bigrams are ordered by how many words have them, and by place. A word's *prefix* is its first ``PREFIX`` bigrams in
   that order. From it two disjoint bigrams, the *pivots*, are chosen by dynamic programming so that the
   two lists they will meet are short.
3. One edit can't touch both pivots. Of two words one edit apart, take the one whose prefix ends earlier in the order:
   its pivot that the edit spares is in the other word's prefix. If the edit lies behind the first pivot, that pivot
   keeps its distance from the start, and all letters up to it; else the second one keeps its distance from the end,
   and all letters from there. So pivots are joined with the prefixes of words whose length differs by one at most, on
   gram, place and the letters on the untouched side.
4. Every candidate is verified by its edit distance; pairs that were found twice are merged.
5. A word's form is its commonest near word, if that is ``ratio`` times as common; forms are followed to the last by
   pointer doubling (counts at least double with each step, so some six rounds do).

Only the bigram counts come to the driver: no more than the square of the alphabet (90 letters). A frequent key of the
join is split by AQE's skew handling, because both sides are plain shuffles.

Defined results: missing and empty texts have no words; a missing ``doc_id`` counts as the empty text; repeated rows
count as often as they are there; of equally common near words the least in code-point order is the form; an empty
table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import heapq
import re
import zlib
from array import array
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ambar.llm.common import flat, kept_once, map_batches, table
from ambar.operators.joins import sized_join

# The letters of words (all of them one byte in Latin-1).
LETTERS = "A-Za-zÀ-ÿ"
find_runs = re.compile(f"[{LETTERS}]+").findall
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

MIN_LENGTH, MIN_COUNT, RATIO = 5, 3, 2
PREFIX = 4  # bigrams in a prefix; three are the least that always hold two disjoint ones
SPREAD = 0.3  # share of words that also agree in one more letter, for the choice of pivots
KNOWN_WORDS, KNOWN_BYTES = 400_000, 64 << 20


class Vocabulary(dict):
    """Numbers of words as they come, with the checksum and size of each."""

    def __init__(self):
        super().__init__()
        self.crc, self.size, self.bytes = array("I"), array("q"), 0

    def __missing__(self, word: str) -> int:
        raw = word.encode()
        self.crc.append(zlib.crc32(raw))
        self.size.append(len(raw))
        self.bytes += len(raw)
        number = self[word] = len(self)
        return number


def checksum_shift(start: int, sizes: np.ndarray) -> np.ndarray:
    """What to xor to the crc32 of texts of ``sizes`` bytes, so that it is that of the text after what gave ``start``.

    crc32 is affine in its start value, and the change depends on the number of bytes only.
    """
    lengths, place = np.unique(sizes, return_inverse=True)
    return np.array([zlib.crc32(bytes(n), start) ^ zlib.crc32(bytes(n)) for n in lengths.tolist()], np.uint32)[place]


def _count_words(min_length: int, typo_every: int | None):
    def run(batches):
        known, counts, altered = Vocabulary(), np.zeros(0, np.int64), Counter()

        def rows():
            words = list(known)
            kept = [(w, n) for w, n in zip(words, counts.tolist()) if n and len(w) >= min_length]
            kept += [(w, n) for w, n in altered.items() if len(w) >= min_length]
            return pa.RecordBatch.from_arrays([pa.array([w for w, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int64())], ["word", "n"])

        for batch in batches:
            found = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                words = find_runs(text.encode("utf-8", "replace").translate(LOWER).decode()) if text else ()
                if not words:
                    continue
                ids = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
                if typo_every:
                    sizes = np.frombuffer(known.size, np.int64)[ids]
                    key = "" if doc_id is None else doc_id
                    h = np.frombuffer(known.crc, np.uint32)[ids] ^ checksum_shift(zlib.crc32(f"{key}:".encode()), sizes)
                    typo = h % np.uint32(typo_every) == 0
                    for i in np.flatnonzero(typo).tolist():
                        word = words[i]
                        at = int(h[i]) % len(word)
                        altered[word[:at] + word[at + 1 :]] += 1
                    ids = ids[~typo]
                found.append(ids)
            counts = np.concatenate([counts, np.zeros(len(known) - len(counts), np.int64)])
            counts += np.bincount(flat(found, np.int64), minlength=len(known))
            if len(known) + len(altered) > KNOWN_WORDS or known.bytes > KNOWN_BYTES:
                yield rows()
                known, counts, altered = Vocabulary(), np.zeros(0, np.int64), Counter()
        yield rows()

    return run


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, typo_every: int | None = None) -> DataFrame:
    """``word`` and ``n`` of the runs of letters of all texts, A-Z in lower case.

    With ``typo_every`` a run loses one letter where the checksum of ``<doc_id>:<run>`` is a multiple of it: typing
    errors that are known and the same on every run.
    """
    counts = map_batches(docs.select("doc_id", "text"), _count_words(min_length, typo_every), "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _count_grams(batches):
    counts = Counter()
    for batch in batches:
        for word in batch.column("word").to_pylist():
            counts.update({word[i : i + 2] for i in range(len(word) - 1)})
    yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["gram", "n"])


class GramIndex:
    """Prefixes and pivots of words under an order of bigrams, rarest first."""

    def __init__(self, counts: dict[str, int]):
        order = sorted(counts, key=lambda g: (counts[g], g))
        self.rank = {g: i for i, g in enumerate(order)}
        self.count = counts

    def prefix(self, word: str) -> list[int]:
        """Places of the first ``PREFIX`` bigrams by rank and place, in the order of the word."""
        ranks = [(self.rank[word[i : i + 2]], i) for i in range(len(word) - 1)]
        return sorted(i for _, i in heapq.nsmallest(PREFIX, ranks))

    def widened(self, word: str, places: list[int]) -> list[int]:
        """The prefix with the place behind its last bigram's, where that is the same bigram.

        A bigram that comes before the last of this prefix in another word may be one place further on here.
        """
        last = max(places, key=lambda i: (self.rank[word[i : i + 2]], i))
        more = last + 1 < len(word) - 1 and word[last + 1 : last + 3] == word[last : last + 2]
        return sorted({*places, last + 1}) if more else places

    def pivots(self, word: str, places: list[int]) -> tuple[int, int]:
        """Two disjoint places of the prefix: the first keeps what is before it, the second what is behind.

        The cost of a place is the number of words expected to share its bigram and the letters on that side. Going
        through the places in order, the cheapest first pivot that ends before the place is kept, and the cheapest
        pair with the place as the second.
        """
        cost = lambda i, beyond: self.count[word[i : i + 2]] * SPREAD**beyond
        best, first, pair, k = None, None, None, 0
        for j in places:
            while places[k] <= j - 2:
                c = cost(places[k], places[k])
                if first is None or c < first[0]:
                    first = (c, places[k])
                k += 1
            if first is not None:
                c = first[0] + cost(j, len(word) - 2 - j)
                if best is None or c < best:
                    best, pair = c, (first[1], j)
        return pair

    def key(self, kind: int, distance: int, length: int, checksum: int, gram: str) -> tuple[int, int]:
        """Two numbers for the kind of end, the gram's distance from it, the word's length; the letters and the gram."""
        return distance << 33 | length << 1 | kind, checksum << 14 | self.rank[gram]

    def prefix_keys(self, word: str) -> list[tuple[int, int]]:
        places, raw, n, out = self.widened(word, self.prefix(word)), word.encode("latin-1"), len(word), []
        crc, done = 0, 0
        for i in places:
            crc, done = zlib.crc32(raw[done : i + 2], crc), i + 2
            out.append(self.key(0, i, n, crc, word[i : i + 2]))
        crc, done, back = 0, 0, raw[::-1]
        for i in reversed(places):
            crc, done = zlib.crc32(back[done : n - i], crc), n - i
            out.append(self.key(1, n - i, n, crc, word[i : i + 2]))
        return out

    def pivot_keys(self, word: str) -> list[tuple[int, int]]:
        i, j = self.pivots(word, self.prefix(word))
        raw, n = word.encode("latin-1"), len(word)
        before, behind = zlib.crc32(raw[: i + 2]), zlib.crc32(raw[j:][::-1])
        out = []
        for length in (n - 1, n, n + 1):
            out.append(self.key(0, i, length, before, word[i : i + 2]))
            out.append(self.key(1, n - j, length, behind, word[j : j + 2]))
        return out


def _keys(index: GramIndex, which: str):
    def run(batches):
        of = getattr(index, f"{which}_keys")
        for batch in batches:
            words, ns = batch.column("word").to_pylist(), batch.column("n").to_pylist()
            found = [of(w) for w in words]
            lengths = [len(f) for f in found]
            places = pa.array([p for f in found for p, _ in f], pa.int64())
            letters = pa.array([x for f in found for _, x in f], pa.int64())
            rows = pa.array(np.repeat(np.arange(len(words)), lengths))
            yield pa.RecordBatch.from_arrays([places, letters, batch.column("word").take(rows), pa.array(ns, pa.int64()).take(rows)], ["place", "letters", which, f"{which}_n"])

    return run


def near_pairs(words: DataFrame) -> DataFrame:
    """``a``, ``n_a``, ``b``, ``n_b`` (a < b): all pairs of ``words`` (``word``, ``n``) that differ by one inserted,
    deleted or replaced code point. Words are distinct, over ``LETTERS``, and have ``MIN_LENGTH`` letters or more.

    ``words`` is read four times, so give a stored frame.
    """
    counts = map_batches(words, _count_grams, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    index = GramIndex({r["gram"]: r["n"] for r in counts})
    pivots = map_batches(words, _keys(index, "pivot"), "place long, letters long, pivot string, pivot_n long")
    prefixes = map_batches(words, _keys(index, "prefix"), "place long, letters long, prefix string, prefix_n long")
    one, other = F.struct(F.col("pivot").alias("w"), F.col("pivot_n").alias("n")), F.struct(F.col("prefix").alias("w"), F.col("prefix_n").alias("n"))
    candidates = pivots.join(prefixes, ["place", "letters"]).where((F.col("pivot") != F.col("prefix")) & (F.levenshtein("pivot", "prefix", 1) == 1))
    ordered = candidates.select(F.least(one, other).alias("x"), F.greatest(one, other).alias("y"))
    return ordered.select(F.col("x.w").alias("a"), F.col("x.n").alias("n_a"), F.col("y.w").alias("b"), F.col("y.n").alias("n_b")).distinct()


def roots(forms: DataFrame) -> DataFrame:
    """``word``, ``root`` from ``word``, ``form``: forms followed to the last, by pointer doubling."""
    state = kept_once(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("open")))
    while not state.where("open").isEmpty():
        ahead = state.select(F.col("word").alias("root"), F.col("root").alias("_further"), F.col("open").alias("_more"))
        further = sized_join(state.where("open"), ahead, ["root"], "left")
        moved = further.select("word", F.coalesce("_further", "root").alias("root"), F.coalesce("_more", F.lit(False)).alias("open"))
        state = kept_once(state.where(~F.col("open")).unionByName(moved))
    return state.select("word", "root")


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` of every row of ``words`` (``word``, ``n``)."""
    words = kept_once(words.select("word", "n"))
    pairs = near_pairs(words)
    # Both directions of a pair in one pass.
    near = pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("other"), F.col("n_b").alias("other_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("other"), F.col("n_a").alias("other_n")),
    )).alias("e")).select("e.*")
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("minus"), F.col("other").alias("form"))).alias("best"))
    common = -F.col("best.minus") >= ratio * F.col("n")
    found = kept_once(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(common, F.col("best.form")).alias("form"), F.when(common, -F.col("best.minus")).alias("form_n"),
    ))
    last = roots(found.where("form is not null"))
    return found.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling(spark, sf_dir):
    """Every word of the documents with its form, root and number of near words."""
    return variants(word_counts(table(spark, sf_dir, "documents"), typo_every=97))
