"""Quality rules, decontamination and archives on hand-made rows, against brute force."""

import hashlib
import random
import re

import zstandard
from pyspark.sql import functions as F

from ambar.llm import decontaminate, quality_rules, warc
from ambar.llm.common import setup
from ambar.llm.queries import ORACLES, QUERIES
from ambar.plans.check import connect, differences

TEXTS = [
    None, "", " \t\n", "one", "a b c d e " * 6, "Same line here\nSame line here\n \n \nother", "x # * $ % & | < > y",
    "É x\x0by\x0cz\r\nw", "only nine words are in this one so fails", "ten words are in this one so it is kept", "w " * 4000, "A\n" * 300, "日本 語 𝔘",
]


def brute_rules(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    hit = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    n = len(words)
    return n, sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit), n < 10 or 100 * len(hit) > 20 * n


def test_base_counts(spark):
    texts = [t for t in TEXTS if len(t or "") < 3000]
    docs = setup(spark).createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "'x' AS n_words", "1 AS _words", "2 AS kept")
    rows = quality_rules.base_features(docs).collect()
    assert {r["doc_id"]: tuple(r[c] for c in quality_rules.FEATURES) for r in rows} == {i: brute_rules(t)[:5] for i, t in enumerate(texts)}


def test_long_and_repeated_texts(spark):
    docs = setup(spark).createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = {r["doc_id"]: r["n_repeat_words"] for r in quality_rules.base_features(docs).collect()}
    assert got[TEXTS.index("w " * 4000)] == 4000


def test_order_of_rules_is_the_same_in_three_runs(spark):
    from pyspark.sql import functions as F

    docs = setup(spark).range(2000).selectExpr("id AS doc_id", "concat(repeat('some words here ', 60), id) AS text")
    dear = F.length(F.regexp_replace(F.lower("text"), "([a-z]+) ([a-z]+) ([a-z]+)", "$3 $1 $2")) % 3 == 0
    rules = [
        quality_rules.Rule("dear", dear & (F.col("doc_id") % 4 == 0)), quality_rules.Rule("cheap", F.col("doc_id") % 5 == 0),
        quality_rules.Rule("same_as_cheap", (F.col("doc_id") % 5 == 0) & (F.crc32(F.col("text").cast("binary")) >= 0)), quality_rules.Rule("never", F.col("doc_id") < 0),
    ]
    orders = [[e.rule.name for e in quality_rules.estimate(docs, rules)] for _ in range(3)]
    assert orders[0] == orders[1] == orders[2] and orders[0][0] == "cheap"
    found = {e.rule.name: e for e in quality_rules.estimate(docs, rules)}
    assert found["dear"].seconds > 3 * found["cheap"].seconds
    # What the rules before it have rejected doesn't count for a rule.
    assert found["same_as_cheap"].rejected == 0 and found["cheap"].rejected == 0.2


def test_cascade_orders_by_rejection_per_cost_and_keeps_the_verdict(spark):
    setup(spark)
    docs = spark.range(500).selectExpr("id AS doc_id", "repeat('word ', cast(id % 40 AS int)) AS text")
    rules = [
        quality_rules.Rule("dear", F.size(F.filter(F.sequence(F.lit(0), F.lit(5000)), lambda i: F.pmod(F.xxhash64(i, F.col("doc_id")), F.lit(977)) == 1)) > 9),
        quality_rules.Rule("strict", F.length("text") < 100),
        quality_rules.Rule("unknown", F.lit(None).cast("boolean")),
    ]
    found = {e.rule.name: e for e in quality_rules.estimate(docs, rules)}
    assert found["strict"].rejected > found["dear"].rejected and found["unknown"].rejected == 0
    out = quality_rules.quality_cascade(docs, rules)
    assert out.where("kept").count() == docs.where(~F.coalesce(rules[0].fails | rules[1].fails, F.lit(False))).count()
    assert quality_rules.quality_cascade(docs.limit(0), rules).count() == 0


def brute_hits(text, items):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    words, hit, found = split(text), set(), set()
    for item, t in items:
        w = split(t)
        for win in {tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9))} if w else ():
            for i in range(len(words) - len(win) + 1):
                if tuple(words[i : i + len(win)]) == win:
                    hit |= set(range(i, i + len(win)))
                    found |= {item}
    ids = ",".join(sorted(str(i) for i in found if i is not None))
    return len(words), len(hit), len(found - {None}), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)


def sample_texts():
    random.seed(4)
    vocab = [f"v{i}" for i in range(12)] + ["the"] * 20
    draw = lambda n: " ".join(random.choice(vocab) for _ in range(n))
    items = [(i, draw(random.choice([1, 3, 9, 10, 11, 25]))) for i in range(12)] + [(50, None), (51, "!!"), (None, "v1 v2 v3"), (3, "v7 the v8"), (60, "the " * 30)]
    docs = [(i, draw(random.choice([0, 2, 30, 200]))) for i in range(25)]
    docs += [(i + 100, draw(5) + "; " + (t or "").upper() + ", " + draw(3)) for i, (_, t) in enumerate(items)]
    return docs + [(7, "v1, V2-v3"), (None, "v1 v2 v3"), (None, None), (9, docs[9][1]), (200, "the " * 3000)], items


def test_hits_equal_brute_force(spark):
    docs, items = sample_texts()
    frame = setup(spark).createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'q' AS window", "1 AS _words", "2 AS start")
    tests = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'q' AS n")
    key = lambda r: tuple((x is None, x) for x in r)
    got = sorted((tuple(r) for r in decontaminate.decontaminate(frame, tests).collect()), key=key)
    want = sorted(((d, *brute_hits(t, items)) for d, t in docs), key=key)
    assert got == want
    kept = sorted(key((r["doc_id"], r["text"])) for r in decontaminate.clean_rows(frame, tests).collect())
    assert kept == sorted(key((d, t)) for d, t in docs if not brute_hits(t, items)[4])
    assert decontaminate.decontaminate(frame.limit(0), tests).count() == 0
    none = decontaminate.decontaminate(frame, tests.limit(0))
    assert none.count() == len(docs) and none.where("contaminated OR n_items > 0").count() == 0


def test_hits_are_the_same_with_shuffled_joins(spark, monkeypatch):
    from ambar.operators import joins

    monkeypatch.setattr(joins, "BROADCAST_BYTES", -1)
    test_hits_equal_brute_force(spark)


def test_archives_are_the_same_with_shuffled_joins(spark, tmp_path, monkeypatch):
    from ambar.operators import joins

    monkeypatch.setattr(joins, "BROADCAST_BYTES", -1)
    test_archives_round_trip(spark, tmp_path)


def test_proximity(spark):
    setup(spark)
    items = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa")], "item_id long, text string")
    filler = " ".join(["alpha"] * 9)  # common, so that others are the anchors
    rows = [(1, "x alpha q q beta r gamma"), (2, "alpha beta gamma delta epsilon zeta eta theta iota kappa"), (3, "beta " + "y " * 30 + "gamma"), (4, filler), (5, "gamma beta alpha delta epsilon zeta eta theta iota kappa")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    words, windows = decontaminate.keyed(docs), decontaminate.item_windows(items)
    chosen = decontaminate.anchors(words, windows, keep=2)
    postings = decontaminate.index(words, chosen.groupBy("term").agg(F.max("n").alias("n")))
    offsets = {r["rank"]: (r["term"], r["offset"]) for r in chosen.collect()}
    for slack in (0, 2, 5):
        want = set()
        for doc, text in rows:
            w = text.split()
            starts = [[i - at for i, x in enumerate(w) if x == term] for term, at in (offsets[0], offsets[1])]
            want |= {(doc, a, min(abs(a - b) for b in starts[1])) for a in starts[0] if any(abs(a - b) <= slack for b in starts[1])}
        got = {(r["doc_id"], r["start"], r["spread"]) for r in decontaminate.proximity_matches(postings, chosen, slack).collect()}
        assert got == want


PAGES = [
    (1, "http://a/ b\r\n", "x"), (2, None, "x"), (3, "http://c", None), (4, "http://d", ""), (5, "http://e", "é" * 70000), (6, "http://f", "é" * 70000),
    (7, "http://g", "only\r\n\r\none"), (None, "http://h", "x"), (None, "http://i", "alone"), (2, None, "x"), (1, "http://j", "other"),
]


def test_archives_round_trip(spark, tmp_path):
    pages = setup(spark).createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", "'k' AS keep", "1 AS n", "'v' AS value").repartition(2)
    path = f"{tmp_path}/warc"
    warc.write_archives(pages, path, frame_bytes=300, bundle_bytes=500)
    rows = warc.read_archives(spark, path).collect()
    keep = {}
    for i, _, t in PAGES:
        keep[t or ""] = max([x for x in (i, keep.get(t or "")) if x is not None], default=None)
    want = sorted((str(i), len((t or "").encode()), warc.digest_of((t or "").encode()), "response" if i == (k := keep[t or ""]) else "revisit", str(None if i == k else k)) for i, _, t in PAGES)
    assert sorted((str(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], str(r["refers_to"])) for r in rows) == want
    assert {r["payload"].decode() for r in rows if r["payload"] is not None} == {t or "" for _, _, t in PAGES}
    # Any Zstandard reader can decompress a bundle as a whole, and its records follow each other there.
    import glob

    seen = 0
    for name in glob.glob(f"{path}/part-*"):
        data = open(name, "rb").read()
        if data:
            frames, entries = warc.read_index(data)
            plain = b"".join(zstandard.ZstdDecompressor().decompressobj().decompress(data[s : s + c]) for s, c, _ in frames)
            base = [sum(f[2] for f in frames[:k]) for k in range(len(frames))]
            assert plain == b"".join(warc.record_at(data, frames[k], at, n) for _, k, at, n in entries)
            assert all(plain[base[k] + at : base[k] + at + n] == warc.record_at(data, frames[k], at, n) for _, k, at, n in entries)
            assert data[-4:] == warc.SEEK_MAGIC.to_bytes(4, "little")
            seen += len(entries)
    assert seen == len(PAGES)
    found = warc.fetch(spark, path, spark.createDataFrame([(5,), (7,), (99,)], "record_id long")).collect()
    assert sorted(r["page_id"] for r in found) == [5, 7]


def test_archives_of_no_pages_and_all_kept(spark, tmp_path):
    pages = setup(spark).createDataFrame(PAGES, "page_id long, url string, html string")
    warc.write_archives(pages.limit(0), f"{tmp_path}/none")
    assert warc.read_archives(spark, f"{tmp_path}/none").count() == 0
    warc.write_archives(pages, f"{tmp_path}/all", min_bytes=10**6)
    assert warc.read_archives(spark, f"{tmp_path}/all").where("record_type = 'revisit'").count() == 0


def test_oracles(spark, sf_dir):
    con = connect(sf_dir)
    for name, sql in ORACLES.items():
        assert differences(QUERIES[name](spark, sf_dir), con, sql) is None, name
