"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Each rule is one boolean expression over a row ("this row fails"). Cost and selectivity of every rule are
estimated on a bounded sample (its cost by runs over so many copies that it stands out from the job's own time, its
selectivity among the rows that the rules before it leave), and the rules are tried in the order of rejections per cost,
so that most bad
rows are settled by the rules that are cheap and strict, and the dear ones see only what is left. The order
changes the work, never the verdict: a row is kept if no rule fails it.

Defined results: a missing text has no words (and so fails the rule on few words); a rule that yields NULL does
not fail; repeated rows get equal verdicts; an empty table gives an empty result; columns of the input stay,
except those with a result's name, which are replaced.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ambar.llm.common import SPACES, WORD, bounded_sample, kept_once, table

# Thresholds.
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
SYMBOLS = "#*$%&|<>"

SAMPLE_ROWS = 2000
FIRST_COPIES, MOST_COPIES, LEAST_SECONDS, RUNS = 16, 128, 0.1, 3  # of the timing of a rule
FEATURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class Rule:
    name: str
    fails: Column


@dataclass(frozen=True)
class Estimate:
    rule: Rule
    seconds: float
    rejected: float

    @property
    def rank(self) -> float:
        return self.rejected / self.seconds


def count_of(text: Column, characters: str) -> Column:
    """How many characters of ``text`` are among ``characters``."""
    return F.length(text) - F.length(F.translate(text, characters, ""))


def base_features(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the word, symbol, repeated line and repeated window counts of the whole text.

    A text's windows are compared by 64-bit hash within that text. Nothing leaves the row, so there is no shuffle.
    """
    df = df.drop(*FEATURES)
    whole = F.coalesce(F.col(text), F.lit(""))
    # Columns that later steps read several times; Spark keeps such projections apart.
    df = df.withColumns({
        "_words": F.regexp_extract_all(whole, F.lit(WORD), F.lit(0)),
        "_lines": F.filter(F.split(whole, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]")),
    })
    size = F.size("_words")
    window = lambda i: F.xxhash64(*[F.get(F.col("_words"), i + k) for k in range(WINDOW)])
    df = df.withColumn(
        "_hashes",
        F.when(size >= WINDOW, F.transform(F.sequence(F.lit(0), size - WINDOW), window)).otherwise(F.array().cast("array<bigint>")),
    )
    repeats = F.when(F.size(F.array_distinct("_hashes")) < F.size("_hashes"), covered_words(F.col("_hashes"))).otherwise(F.lit(0))
    return df.withColumns({
        "n_words": size.cast("long"),
        "word_chars": F.length(F.translate(whole, SPACES, "")).cast("long"),
        "n_symbols": count_of(whole, SYMBOLS).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": repeats.cast("long"),
    }).drop("_words", "_lines", "_hashes")


def covered_words(hashes: Column) -> Column:
    """Number of words in windows whose hash occurs twice or more: sort, compare neighbours, add up the gaps."""
    ranked = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def repeated(s: Column) -> Column:
        same = lambda x, k: F.coalesce(F.get(s, k)["h"] == x["h"], F.lit(False))
        found = F.filter(s, lambda x, k: same(x, k - 1) | same(x, k + 1))
        return F.sort_array(F.transform(found, lambda x: x["i"]))

    def total(places: Column) -> Column:
        gaps = F.zip_with(places, F.slice(places, 2, F.greatest(F.size(places), F.lit(1))), lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW)))
        return F.aggregate(gaps, F.lit(0), lambda acc, x: acc + x)

    # An array of one element binds its element, so that it is computed once and not at every use.
    once = lambda value, use: F.get(F.transform(F.array(value), use), F.lit(0))
    return once(once(ranked, repeated), total)


def prose_rules(text: str = "text") -> list[Rule]:
    """The method's own rules: thresholds wide enough for any prose, narrow enough for tables, shouting and noise.

    They need the columns of :func:`base_features`.
    """
    whole, n_words, chars = F.coalesce(F.col(text), F.lit("")), F.col("n_words"), F.col("word_chars")
    lines = F.size(F.filter(F.split(whole, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]")))
    return [
        Rule("symbols", 10 * F.col("n_symbols") > chars),
        Rule("dup_lines", (F.col("n_dup_lines") >= 3) & (2 * F.col("n_dup_lines") > lines)),
        Rule("word_length", (chars > 40 * n_words) | (chars < 2 * n_words)),
        Rule("shouting", 2 * count_of(whole, "!") > n_words),
        Rule("digits", 2 * count_of(whole, "0123456789") > chars),
        Rule("capitals", 2 * count_of(whole, "ABCDEFGHIJKLMNOPQRSTUVWXYZ") > chars),
        Rule("markup", 5 * F.regexp_count(whole, F.lit(r"https?://|</?[a-z]+[ >/]|\{\{|\}\}|\\n")) > n_words),
    ]


def cost(sample: DataFrame, fails: Column, rows: int) -> float:
    """Seconds that a rule takes for one row of ``sample``, beyond what a job and reading the rows take.

    The rule is run over copies of the sample, eight times as many each time, until a run lasts ``LEAST_SECONDS`` beyond an idle
    one over as many copies. The least of ``RUNS`` differences counts, so that other work on the machine adds little.
    """

    def run(column: Column, copies: int) -> float:
        start = time.perf_counter()
        # Spread over the cores, and copied where it is: nothing but the copies' number differs between runs.
        sample.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))).agg(F.count(F.when(column, 1))).first()
        return time.perf_counter() - start

    copies = FIRST_COPIES
    while True:
        idle, busy = run(F.col("_copy") < 0, copies), run(fails & (F.col("_copy") > 0), copies)
        if busy - idle >= LEAST_SECONDS or copies >= MOST_COPIES:
            break
        copies *= 8
    found = [busy - idle] + [run(fails & (F.col("_copy") > 0), copies) - run(F.col("_copy") < 0, copies) for _ in range(RUNS - 1)]
    # The difference of two quick runs may come out below 0: then the rule costs less than can be told.
    return max(min(found), LEAST_SECONDS / 100) / (copies * max(1, rows))


def estimate(df: DataFrame, rules: list[Rule], sample_rows: int = SAMPLE_ROWS, seed: int = 42, features=lambda df: df) -> list[Estimate]:
    """Seconds a row of each rule, and the share it rejects of the rows that the rules before it leave, in the order of
    rejections per cost, on a stored sample of ``sample_rows`` rows.

    ``features`` adds the columns that the rules need; it is applied to the sample only. Which rules fail together comes
    from one count by the set of failing rules, at most as many rows as the sample.
    """
    sample = kept_once(features(kept_once(bounded_sample(df, sample_rows, seed))))
    bits = sum((F.when(F.coalesce(rule.fails, F.lit(False)), F.lit(1 << k)).otherwise(F.lit(0)) for k, rule in enumerate(rules)), F.lit(0))
    left = {r["failing"]: r["count"] for r in sample.groupBy(bits.cast("long").alias("failing")).count().collect()}
    rows = sum(left.values())
    seconds = {rule.name: cost(sample, F.coalesce(rule.fails, F.lit(False)), rows) for rule in rules}
    out, open_rules = [], list(enumerate(rules))
    while open_rules:
        remaining = sum(left.values())
        share = {k: sum(n for failing, n in left.items() if failing >> k & 1) / max(1, remaining) for k, _ in open_rules}
        k, rule = max(open_rules, key=lambda o: share[o[0]] / seconds[o[1].name])  # of equals the first: what rejects nothing more keeps its place
        out.append(Estimate(rule, seconds[rule.name], share[k]))
        left = {failing: n for failing, n in left.items() if not failing >> k & 1}
        open_rules = [o for o in open_rules if o[0] != k]
    return out


def cascade(rules: list[Rule]) -> Column:
    """Name of the first rule that fails, NULL if none does. A CASE stops at its first true branch."""
    out = F.lit(None).cast("string")
    for rule in reversed(rules):
        out = F.when(rule.fails, F.lit(rule.name)).otherwise(out)
    return out


def quality_cascade(df: DataFrame, rules: list[Rule], sample_rows: int = SAMPLE_ROWS, seed: int = 42, features=lambda df: df) -> DataFrame:
    """``features(df)`` with ``rejected_by`` (the first failing rule in the estimated order) and ``kept``."""
    ranked = estimate(df, rules, sample_rows, seed, features)
    df = features(df).drop("rejected_by", "kept").withColumn("rejected_by", cascade([e.rule for e in ranked]))
    return df.withColumn("kept", F.col("rejected_by").isNull())


def op1_quality_rules(spark, sf_dir):
    """Base counts and the verdict for every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    features = lambda df: base_features(df).withColumn("base_failed", failed)
    out = quality_cascade(docs, [Rule("base", F.col("base_failed")), *prose_rules()], features=features)
    return out.select("doc_id", *FEATURES, "base_failed", "kept")


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls
  FROM documents),
win AS (
  SELECT r, i, list_aggregate(w[i : i + 4], 'string_agg', ' ') AS s
  FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS n FROM win) WHERE n > 1),
cov AS (SELECT r, sum(least(5, coalesce(nxt - i, 5))) AS n FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM rep) GROUP BY r),
f AS (
  SELECT d.r, doc_id, t, len(ls) AS n_lines, len(w)::BIGINT AS n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN cov USING (r)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > word_chars OR n_dup_lines >= 3 AND 2 * n_dup_lines > n_lines
    OR word_chars > 40 * n_words OR word_chars < 2 * n_words
    OR 2 * length(regexp_replace(t, '[^!]', '', 'g')) > n_words
    OR 2 * length(regexp_replace(t, '[^0-9]', '', 'g')) > word_chars
    OR 2 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > word_chars
    OR 5 * len(regexp_extract_all(t, 'https?://|</?[a-z]+[ >/]|\{\{|\}\}|\\n')) > n_words) AS kept
FROM b
"""
