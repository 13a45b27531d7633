"""Benchmark decontamination with a distributed positional inverted index, in DataFrame functions only.

The index holds postings (term, document, position) of the corpus, stored as Parquet and clustered by term, for
the terms that the test items need looked up. Of every window of ten consecutive item words these are the
``ANCHORS`` rarest ones, by counts over the whole corpus; frequent words are looked up only if nothing rarer is
in the window, so their long lists are rarely touched.

A posting minus its term's offset in the window is where the window would start in the document. The lists of a
window's anchors are intersected on these starts, from the rarest term on. What is left is held against the
documents' words one by one, so matches are exact. Proximity matches take anchors whose starts differ by at most
a slack, in any order.

Postings are joined to terms by measured size, with the most frequent terms spread over tasks; no posting list is
ever gathered in one place. Words of an item are handled like those of documents.

Defined results: a missing or empty text has no words, hits or windows; an item with fewer words than a window
is one window of all its words; repeated items count once; repeated rows of documents get equal results, and
rows that share a doc_id but not the text are looked at apart; missing ids are kept (a missing item_id is left
out of the lists of ids, but its windows count); empty tables give an empty result or no hits; other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ambar.llm.common import apart, kept_once, lower_ascii, table
from ambar.operators.joins import sized_join

WINDOW = 10
ANCHORS = 2
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
KEY = ["doc_id", "_text"]


def words_of(text: Column) -> Column:
    """Lower-cased words of a whole text."""
    return F.filter(F.split(lower_ascii(F.coalesce(text, F.lit(""))), SEPARATOR), lambda w: w != "")


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``_text`` (a hash that tells texts under one id apart) and ``_words``."""
    return docs.select("doc_id", F.xxhash64("text").alias("_text"), words_of(F.col("text")).alias("_words"))


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``window`` (its number), ``words``, and ``items``: the ids of the items that have it. Equal windows are one."""
    words = items.select("item_id", words_of(F.col("text")).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - window + 1))
    each = words.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("w", i, window))).alias("words"))
    grouped = each.groupBy("words").agg(F.collect_set(F.col("item_id").cast("string")).alias("items"))
    return kept_once(grouped.withColumn("window", F.xxhash64("words")))


def corpus_counts(words: DataFrame, terms: DataFrame) -> DataFrame:
    """How often each term of ``terms`` occurs in the corpus; 0 for those that don't."""
    tokens = words.select(F.explode("_words").alias("term"))
    counted = sized_join(tokens, terms, ["term"], "left_semi").groupBy("term").agg(F.count("*").alias("n"))
    return terms.join(counted, "term", "left").select("term", F.coalesce("n", F.lit(0)).alias("n"))


def anchors(words: DataFrame, windows: DataFrame, keep: int = ANCHORS) -> DataFrame:
    """The ``keep`` rarest words of each window with their offsets, as rows ``window``, ``rank``, ``term``, ``offset``, ``n``.

    A window with a word that the corpus doesn't have can't occur and gets none.
    """
    each = windows.select("window", F.posexplode("words").alias("offset", "term"))
    counts = kept_once(corpus_counts(words, kept_once(each.select("term").distinct())))
    placed = each.join(counts, "term")
    # Windows have ten words at most: sorting them in an array needs no hot groups.
    ranked = placed.groupBy("window").agg(F.sort_array(F.collect_list(F.struct("n", "term", "offset"))).alias("sorted"))
    possible = ranked.where(F.col("sorted")[0]["n"] > 0)
    rarest = possible.select("window", F.posexplode(F.slice("sorted", 1, keep)).alias("rank", "s"))
    return kept_once(rarest.select("window", "rank", F.col("s.term").alias("term"), F.col("s.offset").alias("offset"), F.col("s.n").alias("n")))


def index(words: DataFrame, terms: DataFrame) -> DataFrame:
    """The stored postings ``term``, ``doc_id``, ``_text``, ``pos`` of ``terms`` (term, n), clustered by term.

    Rows of frequent terms are dealt over many tasks by document as well.
    """
    tokens = words.select(*KEY, F.posexplode("_words").alias("pos", "term"))
    found = sized_join(tokens, terms, ["term"], "inner", rows_col="n").select("term", *KEY, "pos").distinct()
    return kept_once(found.sortWithinPartitions("term", "doc_id", "pos"))


def starts_of(postings: DataFrame, chosen: DataFrame) -> DataFrame:
    """Where each window of ``chosen`` would start for each posting of its term."""
    side = kept_once(chosen.select("term", "window", "rank", "offset", "n"))
    return sized_join(postings, side, ["term"], "inner", rows_col="n").select(*KEY, "window", "rank", (F.col("pos") - F.col("offset")).alias("start"))


def phrase_candidates(postings: DataFrame, chosen: DataFrame) -> DataFrame:
    """Starts that all anchors of a window agree on: the intersection of their offset-adjusted lists."""
    need = chosen.groupBy("window").agg(F.count("*").alias("need"))
    met = starts_of(postings, chosen).where("start >= 0").groupBy(*KEY, "window", "start").agg(F.count("*").alias("met"))
    return sized_join(met, kept_once(need), ["window"], "inner").where("met = need").select(*KEY, "window", "start")


def phrase_matches(words: DataFrame, windows: DataFrame, chosen: DataFrame, postings: DataFrame) -> DataFrame:
    """``doc_id``, ``_text``, ``window``, ``start`` and ``length`` of every exact occurrence."""
    candidates = sized_join(phrase_candidates(postings, chosen), windows.select("window", "words"), ["window"], "inner")
    # Candidates of one document together: a document has at most as many as anchor postings.
    by_doc = kept_once(candidates.groupBy(*KEY).agg(F.collect_list(F.struct("start", "window", "words")).alias("_found")))
    met = sized_join(by_key(words), by_key(by_doc).drop("doc_id"), ["_id", "_none", "_text"], "inner")
    exact = F.filter("_found", lambda f: F.slice(F.col("_words"), f["start"] + 1, F.size(f["words"])) == f["words"])
    rows = met.select(*KEY, F.explode(exact).alias("f"))
    return rows.select(*KEY, F.col("f.window").alias("window"), F.col("f.start").alias("start"), F.size("f.words").alias("length")).distinct()


def proximity_matches(postings: DataFrame, chosen: DataFrame, slack: int) -> DataFrame:
    """``doc_id``, ``_text``, ``window``, ``start``, ``spread``: anchors of a window found in any order with starts
    within ``slack`` of that of the rarest, which is the start given.

    Starts are put into bins of ``slack`` + 1, so the join is on equal bins and their neighbours, not on ranges.
    """
    starts = kept_once(starts_of(postings, chosen))
    bins = F.floor(F.col("start") / F.lit(slack + 1))
    first = starts.where("rank = 0").select(*KEY, "window", F.col("start").alias("at"), F.explode(F.array(bins - 1, bins, bins + 1)).alias("bin"))
    other = starts.where("rank > 0").select(F.col("doc_id").alias("_d"), "_text", "window", "rank", "start", bins.alias("bin"))
    near = first.join(other, ["_text", "window", "bin"]).where(F.col("doc_id").eqNullSafe(F.col("_d")) & (F.abs(F.col("start") - F.col("at")) <= slack))
    best = near.groupBy(*KEY, "window", "at", "rank").agg(F.min(F.abs(F.col("start") - F.col("at"))).alias("spread"))
    need = kept_once(chosen.groupBy("window").agg((F.count("*") - 1).alias("need")))
    full = best.groupBy(*KEY, "window", "at").agg(F.count("*").alias("met"), F.max("spread").alias("spread"))
    alone = starts.join(need.where("need = 0"), "window").select(*KEY, "window", F.col("start").alias("at"), F.lit(0).cast("bigint").alias("spread"))
    met = full.join(need, "window").where("met = need").select(*KEY, "window", "at", "spread")
    return met.unionByName(alone).withColumnRenamed("at", "start").distinct()


def all_matches(words: DataFrame, windows: DataFrame) -> DataFrame:
    """Every exact occurrence of every window, by way of the index; stored."""
    chosen = anchors(words, windows)
    terms = kept_once(chosen.groupBy("term").agg(F.max("n").alias("n")))
    return kept_once(phrase_matches(words, windows, chosen, index(words, terms)))


def by_key(df: DataFrame) -> DataFrame:
    """``df`` with its ``doc_id`` as columns that can be joined on where it is missing, too."""
    return df.withColumns({"_id": F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "_none": F.col("doc_id").isNull()})


def clean_rows(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` in which no window of ``items`` occurs, as they are."""
    found = all_matches(keyed(docs), item_windows(items, window)).select(*KEY).distinct()
    found = kept_once(by_key(found).drop("doc_id"))
    rows, names, restored = apart(docs)
    doc = F.col(names["doc_id"])
    keyed_rows = rows.withColumns({"_text": F.xxhash64(names["text"]), "_id": F.coalesce(doc.cast("string"), F.lit("")), "_none": doc.isNull()})
    return restored(sized_join(keyed_rows, found, ["_id", "_none", "_text"], "left_anti"))


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``, ``contaminated``."""
    words, windows = keyed(docs), item_windows(items, window)
    matches = all_matches(words, windows)

    # Words inside any match, each once: matches sorted by start within a document, gaps counted up to their length.
    covered = F.aggregate(
        F.sort_array(F.col("_spans")),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end")),
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(F.lit(0).cast("long"), s["end"] - F.greatest(acc["end"], s["start"]))).alias("n"), F.greatest(acc["end"], s["end"]).alias("end")
        ),
    )["n"]
    span = F.struct(F.col("start").cast("long").alias("start"), (F.col("start") + F.col("length")).cast("long").alias("end"))
    hits = matches.groupBy(*KEY).agg(F.collect_set(span).alias("_spans")).select(*KEY, covered.alias("n_hit"))
    listed = sized_join(matches.select(*KEY, "window").distinct(), windows.select("window", "items"), ["window"], "inner")
    ids = listed.select(*KEY, F.explode("items").alias("item")).groupBy(*KEY).agg(F.sort_array(F.collect_set("item")).alias("_items"))
    found = hits.alias("h").join(ids.alias("i"), F.col("h.doc_id").eqNullSafe(F.col("i.doc_id")) & (F.col("h._text") == F.col("i._text")), "left")
    found = kept_once(
        found.select(
            F.coalesce(F.col("h.doc_id").cast("string"), F.lit("")).alias("_id"), F.col("h.doc_id").isNull().alias("_none"), F.col("h._text").alias("_text"),
            "n_hit", F.coalesce("_items", F.array().cast("array<string>")).alias("_items"),
        )
    )
    sizes = words.select("doc_id", F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id"), F.col("doc_id").isNull().alias("_none"), "_text", F.size("_words").cast("long").alias("n_words"))
    out = sized_join(sizes, found, ["_id", "_none", "_text"], "left")
    listed_ids = F.array_join(F.coalesce("_items", F.array().cast("array<string>")), ",")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return out.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce(F.size("_items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(listed_ids, 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def op10_decontaminate(spark, sf_dir):
    """Hits of all benchmark windows in all documents."""
    docs, items = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("item_id", "text")
    return decontaminate(docs, items)


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, list_aggregate(w[i : i + 9], 'string_agg', ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM win),
grams AS (
  SELECT r, i, n, list_aggregate(w[i : i + n - 1], 'string_agg', ' ') AS s
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n)),
hit AS (SELECT r, i, grams.n, item_id FROM grams JOIN win USING (n, s)),
spots AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT r, i, n FROM hit)) GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM hit WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN spots USING (r) LEFT JOIN its USING (r)
"""
