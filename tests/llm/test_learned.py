"""Learned operators: exact parts against brute force, the rest by held-out accuracy."""

import itertools
import math
import random
import re
import sys
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from ambar.llm import hmm, language_id, site_quality, toxicity
from ambar.llm.common import setup
from ambar.llm.queries import QUERIES

LARGER = "/root/testdata/sf0.01"


def crc(doc):
    return zlib.crc32(("" if doc is None else str(doc)).encode())


def labels_of(spark, folder, column):
    return {r["doc_id"]: r[column] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}


# ---- toxicity


def test_label_model_finds_accuracies_and_correlated_copies():
    random = np.random.default_rng(1)
    y = random.random(6000) < 0.3
    say = lambda right: np.where(random.random(len(y)) < right, y, ~y)
    good, fair = say(0.9), say(0.75)
    poor = say(0.6)
    votes = np.column_stack([fair, good, *[poor] * 4, say(0.75)]).astype(int)
    q = toxicity.fit_label_model(votes)
    assert ((q > 0.5) == y).mean() > 0.88  # four copies of a poor voter don't outvote a good one


def test_op2_on_held_out_rows(spark):
    rows = QUERIES["op2_toxicity"](spark, LARGER).collect()
    toxic = labels_of(spark, LARGER, "toxic")
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{LARGER}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        assert r["held_out"] == (crc(r["doc_id"]) % 4 == 2) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    clean = [r for r in rows if toxic.get(r["doc_id"]) == 0]
    assert sum(r["predicted"] for r in clean) <= 0.02 * len(clean)
    # The documents with an English word of abuse that the labels teach.
    abuse = re.compile(r"\b(?:idiot|loser|pathetic|worthless|trash|clown|stupid|moron|scum|disgusting)\b", re.I)
    found = [r["predicted"] for r in rows if abuse.search(texts[r["doc_id"]])]
    assert found and sum(found) >= 0.85 * len(found)


def test_toxicity_edge_rows(spark):
    setup(spark)
    docs = spark.createDataFrame([(i, ("bad rudeword here " if i % 5 == 0 else "fine words here ") + f"x{i}") for i in range(200)] + [(300, None), (301, ""), (None, "rudeword"), (5, "again")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(200)] + [(1, None), (301, 0), (None, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    got = {(r["doc_id"], r["text"]): r["score"] for r in toxicity.score(docs.selectExpr("*", "'s' AS score", "1 AS found"), model).collect()}
    assert len(got) == 204 and got[300, None] == got[301, ""] < 0.3 < got[None, "rudeword"]
    assert toxicity.fit(docs, labels.where("toxic = 0")).intercept < -2
    assert toxicity.fit(docs, labels.limit(0)) == toxicity.Model({}, toxicity.NOTHING_KNOWN)
    assert toxicity.score(docs.limit(0), model).count() == 0


def features_by_hand(text):
    found = Counter()
    for word in re.findall(r"[^\x20\x09-\x0D]+", text or ""):
        if core := re.sub(r"^[\W_]+|[\W_]+$", "", word.lower()):
            found.update([f"w:{core}", *[f"{n}:{core[:n]}" for n in (3, 4, 5, 6, 7) if len(core) >= n]])
    return {f"{f}@{level}" for f, n in found.items() for level in (1, 2, 3, 4, 6) if n >= level}


def test_features_and_scores_of_a_column_are_those_of_its_texts():
    draw = random.Random(3)
    parts = [*"aAb_-#1é", "abc", "abcd", "abcdefgh", "İ", "Σ", "\x1c", "\x85", "\xa0", "½", *" \n\t\x0b\x0c\r" * 2]
    whole = [None, "", " \n", "-- _", *["".join(draw.choices(parts, k=draw.randrange(1, 150))) for _ in range(200)]]
    label = [draw.randrange(2) for _ in whole]
    batch = pa.record_batch([pa.array(whole, pa.string()), pa.array(label, pa.int32())], ["text", "_label"])
    want = [Counter(), Counter()]
    for text, y in zip(whole, label):
        want[y].update(features_by_hand(text))
    got = [Counter(), Counter()]
    for out in toxicity._count_features(iter([batch, batch.slice(0, 0)])):
        for r in out.to_pylist():
            got[0][f"{r['stem']}@{r['level']}"] += r["clean"]
            got[1][f"{r['stem']}@{r['level']}"] += r["toxic"]
    assert [+c for c in got] == want
    weights = {f: draw.uniform(-1, 1) for f in draw.sample(sorted(want[0] | want[1]), 60)}
    names = [*weights]
    found = [r["found"] for r in pa.Table.from_batches(toxicity._examples(names)(iter([batch]))).to_pylist()]
    assert found == [[i for i, f in enumerate(names) if f in features_by_hand(text)] for text in whole]
    scores = toxicity.Model(weights, -0.5).scorer()(batch.column("text").slice(2))
    for text, score in zip(whole[2:], scores):
        assert math.isclose(score, 1 / (1 + math.exp(0.5 - sum(weights[f] for f in features_by_hand(text) if f in weights))), rel_tol=1e-9)


def test_counting_features_takes_no_python_steps_per_text():
    def calls(rows):
        n = 0

        def called(frame, event, what):
            nonlocal n
            n += event in ("call", "c_call")

        whole = [f"some words that every text has {'again ' * (i % 3)}" for i in range(rows)]
        batch = pa.record_batch([pa.array(whole), pa.array([i % 2 for i in range(rows)], pa.int32())], ["text", "_label"])
        sys.setprofile(called)
        try:
            list(toxicity._count_features(iter([batch])))
        finally:
            sys.setprofile(None)
        return n

    calls(20)
    assert calls(2000) < 2 * calls(20)


# ---- language


def test_op3_on_held_out_rows(spark, sf_dir):
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{LARGER}/documents.parquet").collect()}
    rows = QUERIES["op3_language_id"](spark, LARGER).collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == len(lang) and all(r["held_out"] == (crc(r["doc_id"]) % 4 == 2) for r in rows)
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.98 * len(held)


def test_language_edge_rows(spark):
    setup(spark)
    rows = [(i, "der die das und nicht" if i % 2 else "the and of that with", "de" if i % 2 else "en") for i in range(60)]
    docs = spark.createDataFrame([*rows, (70, None, "en"), (71, "123 !!", "en"), (72, "", None), (73, "nicht " * 20000, None), (None, "THE OF", "en")], "doc_id long, text string, lang string")
    model = language_id.fit(docs)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.identify(docs.selectExpr("*", "'a' AS lang_pred").drop("lang"), model).collect()}
    assert got[70] == got[71] == got[72] == ("und", 0.0) and got[73][0] == "de" and got[None][0] == "en" and got[1][0] == "de"
    assert (model.weights == 0).mean() > 0.9  # sparse
    none = language_id.fit(docs.limit(0))
    assert {r["lang_pred"] for r in language_id.identify(docs, none).collect()} == {"und"}


def test_ngrams_of_slices_add_up(monkeypatch):
    text = "Straße und Wörter " * 50
    whole = language_id.ngram_counts(text)
    monkeypatch.setattr(language_id, "SLICE", 10**9)
    assert (language_id.ngram_counts(text) == whole).all()


# ---- quality


def test_op7_on_held_out_rows(spark):
    rows = QUERIES["op7_site_quality"](spark, LARGER).collect()
    quality = labels_of(spark, LARGER, "quality")
    held = [(r["kept"], quality[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in quality]
    assert len(rows) == spark.read.parquet(f"{LARGER}/documents.parquet").count()
    assert sum(k == bool(q) for k, q in held) >= 0.95 * len(held)


def test_sparse_sites_keep_to_the_prior(spark):
    setup(spark)
    rows = [("big", "a", 2.0)] * 400 + [("bad", "a", -2.0)] * 400 + [("bad", "b", 2.0)] + [("new", "x", 2.0)] + [(f"h{i}", "p", 2.0 if i % 2 else -2.0) for i in range(40) for _ in range(30)]
    evidence = spark.createDataFrame(rows, "_host string, _path string, _logit double").selectExpr("_host", "_host || '/' || _path AS _path", "_logit")
    sites, share = site_quality.site_posteriors(evidence)
    found = {r["_path"]: r["_prior"] for r in sites.withColumn("_prior", site_quality.posterior_without(None, share)).collect()}
    assert found["bad/a"] < 0.2 < 0.8 < found["big/a"]
    assert found["bad/a"] < found["bad/b"] < share  # one good document in a bad host
    assert abs(found["new/x"] - share) < abs(found["big/a"] - share)


def test_quality_edge_rows(spark):
    setup(spark)
    docs = spark.createDataFrame([(i, "good prose with words " + str(i), "s", None) if i % 2 else (i, "!! ## " * 30, None, "en") for i in range(80)] + [(None, None, None, None), (90, "", "t", "de")], "doc_id long, text string, source string, lang string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)], "doc_id long, quality int")
    model = site_quality.fit_evidence(docs, labels)
    kept = {r["doc_id"]: r["kept"] for r in site_quality.quality(docs.selectExpr("*", "1 AS _host", "2 AS n", "'z' AS kept"), model).collect()}
    assert len(kept) == 82 and all(kept[i] == bool(i % 2) for i in range(80))
    assert {r["doc_id"] for r in site_quality.good_rows(docs, model).collect()} == {d for d, k in kept.items() if k}
    assert site_quality.quality(docs.limit(0), model).count() == 0
    assert site_quality.quality(docs, site_quality.fit_evidence(docs, labels.limit(0))).where("kept").count() == 82


# ---- language model


def test_forward_and_expected_counts_equal_enumeration():
    random_ = np.random.default_rng(3)
    draw = lambda *shape: (lambda x: x / x.sum(-1, keepdims=True))(random_.random(shape))
    p = hmm.Parameters(draw(3), draw(3, 3), draw(3, 5).T)
    sequences = [random_.integers(0, 5, n).astype(np.int32) for n in (1, 4, 6, 2, 5)]
    totals = hmm.Parameters(np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3)))
    got = hmm.expected_counts(p, sequences, totals)
    start, move, emit, log = np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3)), 0.0
    for s in sequences:
        paths = list(itertools.product(range(3), repeat=len(s)))
        weight = [p.start[z[0]] * math.prod(p.move[a, b] for a, b in zip(z, z[1:])) * math.prod(p.emit[x, k] for x, k in zip(s, z)) for z in paths]
        log += math.log(sum(weight))
        for z, w in zip(paths, np.array(weight) / sum(weight)):
            start[z[0]] += w
            for a, b in zip(z, z[1:]):
                move[a, b] += w
            for x, k in zip(s, z):
                emit[x, k] += w
    assert math.isclose(got, log, rel_tol=1e-9)
    for a, b in ((totals.start, start), (totals.move, move), (totals.emit, emit)):
        assert np.allclose(a, b)


@pytest.fixture(scope="module")
def scored(spark, sf_dir):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    return docs, {r["doc_id"]: r for r in QUERIES["op5_hmm_score"](spark, sf_dir).collect()}


def test_op5_base_is_exact_and_the_model_is_better(scored):
    docs, rows = scored
    tokens = {i: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t)) + ["\n"] for i, t in docs.items()}
    counts = Counter(w for i, ws in tokens.items() if crc(i) % 5 != 1 for w in ws)
    n, v = sum(counts.values()), len(counts)
    assert set(rows) == set(docs)
    for i, ws in tokens.items():
        r = rows[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (crc(i) % 5 == 1, len(ws), sum(counts[w] > 0 for w in ws), n)
        assert math.isclose(r["base_score"], sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), rel_tol=1e-9)
    held = [r for r in rows.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > 0.95 * sum(r["base_score"] for r in held)


def test_language_model_edge_rows(spark):
    from ambar.llm.common import fold

    docs = setup(spark).createDataFrame([(1, None), (2, ""), (None, "A b"), (3, "a B c"), (3, "a B c"), (4, "word " * 30000)], "doc_id long, text string").selectExpr("*", "1 AS n", "'w' AS word", "2 AS c")
    rows = hmm.score_texts(docs, fold("doc_id", 5) == 1, states=2, rounds=2).collect()
    assert len(rows) == 6 and sorted(r["n_tokens"] for r in rows) == [1, 1, 3, 4, 4, 30001]
    assert all(math.isfinite(r["score"]) and math.isfinite(r["base_score"]) for r in rows)
    assert hmm.score_texts(docs.limit(0), fold("doc_id", 5) == 1).count() == 0


def trained(spark, rows, **sizes):
    vocab = hmm.vocabulary(hmm.word_counts(rows.where("NOT held_out")), **sizes)
    return vocab, hmm.read_texts(rows, vocab)


def test_each_round_raises_the_likelihood(spark, sf_dir):
    docs = setup(spark).read.parquet(f"{sf_dir}/documents.parquet").selectExpr("doc_id", "text", "false AS held_out")
    vocab, read = trained(spark, docs)
    _, history = hmm.baum_welch(read, hmm.first_parameters(vocab.first_counts(), 4), rounds=4)
    assert all(a < b for a, b in zip(history, history[1:]))


def test_blocks_give_the_same_counts():
    random_ = np.random.default_rng(6)
    draw = lambda *shape: (lambda x: x / x.sum(-1, keepdims=True))(random_.random(shape))
    p = hmm.Parameters(draw(3), draw(3, 3), draw(3, 7).T)
    sequences = [random_.integers(0, 7, n).astype(np.int32) for n in (50, 3, 1, 17, 49, 20)]
    found = []
    for together, dtype in ((10**6, np.float64), (1, np.float64), (13, np.float64), (9, np.float32)):
        totals = hmm.Parameters(np.zeros(3), np.zeros((3, 3)), np.zeros((7, 3)))
        found.append((hmm.expected_counts(p, sequences, totals, dtype, together), totals))
    for log, totals in found[1:]:
        assert math.isclose(log, found[0][0], rel_tol=1e-5)
        for name in ("start", "move", "emit"):
            assert np.allclose(getattr(totals, name), getattr(found[0][1], name), rtol=1e-4, atol=1e-4)


def test_a_very_long_text_is_trained_on_in_blocks():
    import tracemalloc

    p = hmm.first_parameters(np.ones(50, np.int64), 4)
    text = np.tile(np.arange(50, dtype=np.int32), 3000)  # 150,000 symbols
    totals = hmm.Parameters(np.zeros(4), np.zeros((4, 4)), np.zeros((50, 4)))
    tracemalloc.start()
    hmm.expected_counts(p, [text], totals, np.float32, together=2000)
    assert tracemalloc.get_traced_memory()[1] < 20e6
    tracemalloc.stop()
    assert math.isclose(totals.emit.sum(), len(text), rel_tol=1e-3)


@pytest.mark.parametrize("known", [3, 50])
def test_scores_equal_enumeration_over_all_state_paths(spark, known):
    from pyspark.sql import functions as F

    texts = ["a b a", "B c", "", None, "a ax bx zx", "b b c a", "unseen ax"]
    rows = setup(spark).createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    held = F.col("doc_id") == 6
    sizes = {"hot": 3, "classes": 2, "known": known}
    got = {r["doc_id"]: r for r in hmm.score_texts(rows, held, states=2, rounds=3, **sizes).collect()}
    vocab, read = trained(spark, rows.select("*", held.alias("held_out")), **sizes)
    p, _ = hmm.baum_welch(read.where("NOT held_out"), hmm.first_parameters(vocab.first_counts(), 2), 3)
    words = [(t or "").lower().split() + ["\n"] for t in texts]
    counts = Counter(w for ws in words[:6] for w in ws)
    order = sorted(counts, key=lambda w: (-counts[w], w))
    hot = [w.decode() for w in vocab.words[:3]]
    assert hot == order[: len(hot)] and len(vocab.words) <= known
    symbol = lambda w: hot.index(w) if w in hot else 3 + hmm.class_of(w.encode(), 2)
    for i, ws in enumerate(words):
        path = 0.0
        for z in itertools.product(range(2), repeat=len(ws)):
            path += p.start[z[0]] * math.prod(p.move[a, b] for a, b in zip(z, z[1:])) * math.prod(p.emit[symbol(w), k] for w, k in zip(ws, z))
        want = math.log10(path)
        for w in ws:
            if w not in hot:
                own = [x for x in order if x not in hot and symbol(x) == symbol(w)]
                want += math.log10((counts[w] + 0.5) / (sum(counts[x] for x in own) + 0.5 * (len(own) + 1)))
        assert math.isclose(got[i]["score"], want, rel_tol=1e-4)
        assert got[i]["n_known"] == sum(counts[w] > 0 for w in ws)


# ---- rows as they are, odd letters, no labels


CLASHING = "1 AS score, 2 AS n, 3 AS _score, 4 AS _text, 5 AS _id, 6 AS _none, 7 AS _prior, 8 AS _host, 9 AS _path, 10 AS _logit, 11 AS site_share, 12 AS good, 13 AS _in0, 14 AS word, 15 AS _row"


def test_stages_keep_rows_with_clashing_columns(spark, sf_dir):
    from ambar.llm import decontaminate, near_dup

    docs = setup(spark).read.parquet(f"{sf_dir}/documents.parquet")
    labels, items = spark.read.parquet(f"{sf_dir}/labels.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    more = docs.selectExpr("*", *CLASHING.split(", "))
    toxic, good = toxicity.fit(docs, labels), site_quality.fit_evidence(docs, labels)
    for stage in (lambda d: toxicity.clean_rows(d, toxic), lambda d: site_quality.good_rows(d, good), near_dup.first_rows, lambda d: decontaminate.clean_rows(d, items)):
        out, plain = stage(more), stage(docs)
        assert out.columns == more.columns and plain.columns == docs.columns
        kept = out.collect()
        assert {r["doc_id"] for r in kept} == {r["doc_id"] for r in plain.collect()}
        assert all((r["score"], r["n"], r["_score"], r["_text"], r["_row"]) == (1, 2, 3, 4, 15) for r in kept)


def test_without_labels_nothing_is_toxic(spark, sf_dir):
    docs = setup(spark).read.parquet(f"{sf_dir}/documents.parquet")
    model = toxicity.fit(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert toxicity.clean_rows(docs, model).count() == docs.count()


def test_numerals_are_no_letters(spark):
    model = language_id.Model(["en", "fr"], np.zeros((2, language_id.BUCKETS + 1)), np.ones(language_id.BUCKETS))
    assert [model.predict(t)[0] for t in ("½ ² Ⅷ ① 12 _", "", "½ a", "日本", "é")] == ["und", "und", "en", "en", "en"]


def test_a_rare_language_is_in_the_sample(spark):
    rows = spark.range(4000).selectExpr("'x' AS text", "CASE WHEN id % 100 = 0 THEN 'eo' ELSE 'en' END AS lang")
    sizes = {r["lang"]: r["count"] for r in language_id.sample_by_language(rows, 200).groupBy("lang").count().collect()}
    assert sizes["eo"] == 40 and 120 < sizes["en"] < 300


def test_own_evidence_counts_once(spark):
    """The posterior by hand: each document's site is that of the others."""
    evidence = [("a", "a/x", 2.0), ("a", "a/x", -1.0), ("a", "a/y", 0.5), ("b", "b/", 1.5)]
    frame = spark.createDataFrame(evidence, "_host string, _path string, _logit double")
    sites, share = site_quality.site_posteriors(frame)
    strengths = sites.select("_own", "_within").first()
    p = [1 / (1 + math.exp(-x)) for _, _, x in evidence]
    assert math.isclose(share, (sum(p) + 1) / 6, rel_tol=1e-6)
    got = {round(r["_logit"], 3): r for r in site_quality._scored(frame, sites, share).collect()}
    for i, (host, path, logit) in enumerate(evidence):
        others = [(h, q, p[k]) for k, (h, q, _) in enumerate(evidence) if k != i]
        mean = lambda found, prior, s: (sum(found) + s * prior) / (len(found) + s)
        at_host = mean([x for h, _, x in others if h == host], share, strengths["_own"])
        prior = mean([x for h, q, x in others if (h, q) == (host, path)], at_host, strengths["_within"])
        assert math.isclose(got[logit]["site_share"], prior, rel_tol=1e-6)
        want = logit + math.log(prior / (1 - prior)) - math.log(share / (1 - share))
        assert math.isclose(got[logit]["score"], 1 / (1 + math.exp(-want)), rel_tol=1e-6)


# ---- brute force of the learned parts


def test_label_model_equals_em_by_hand():
    """Independent voters: each round by the definitions, row by row."""
    random = np.random.default_rng(12)
    y = random.random(300) < 0.4
    votes = np.column_stack([np.where(random.random(300) < right, y, random.random(300) < 0.5) for right in (0.9, 0.6, 0.5)]).astype(int)
    q = [0.9 if v[0] else 0.1 for v in votes]
    for _ in range(25):
        prior = [sum(1 - x for x in q) + 1, sum(q) + 1]
        prior = [p / sum(prior) for p in prior]
        share = {}
        for k in range(3):
            for c in (0, 1):
                weight = [x if c else 1 - x for x in q]
                tally = [sum(w for w, v in zip(weight, votes) if v[k] == a) + 0.5 for a in (0, 1)]
                share[k, c] = [t / sum(tally) for t in tally]
        new = []
        for v in votes:
            like = [prior[c] * math.prod(share[k, c][v[k]] for k in range(3)) for c in (0, 1)]
            new.append(like[1] / sum(like))
        done, q = max(abs(a - b) for a, b in zip(q, new)) < 1e-5, new
        if done:
            break
    monkey = toxicity._tree
    toxicity._tree = lambda v, counts, q: np.full(v.shape[1], -1)
    try:
        got = toxicity.fit_label_model(votes)
    finally:
        toxicity._tree = monkey
    assert np.allclose(got, q, atol=1e-3)


def test_tree_joins_the_strongest_pairs():
    random = np.random.default_rng(2)
    base = random.random((4000, 3)) < 0.5
    v = np.column_stack([base[:, 0], base[:, 1], base[:, 1], base[:, 2]]).astype(np.int64)
    parent = toxicity._tree(v, np.ones(len(v)), np.full(len(v), 0.5))
    assert parent[0] == -1 and {1, 2} == {k for k in (1, 2) if parent[k] in (1, 2)} | {next(k for k in (1, 2) if parent[k] == -1)} and parent[3] == -1


def test_linear_classifier_is_at_its_optimum():
    random = np.random.default_rng(5)
    found = [np.flatnonzero(random.random(6) < 0.4) for _ in range(400)]
    target = np.array([1 / (1 + math.exp(-(2.0 * (0 in f) - 1.5 * (3 in f) - 0.3))) for f in found])
    w, b = toxicity.fit_linear(found, target, 6)
    p = np.array([1 / (1 + math.exp(-(b + sum(w[k] for k in f)))) for f in found])
    for k in range(6):
        assert abs(sum((p[i] - target[i]) for i, f in enumerate(found) if k in f)) / len(found) < 1e-3
    assert abs(w[0] - 2.0) < 0.05 and abs(w[3] + 1.5) < 0.05 and abs(b + 0.3) < 0.05


def test_entries_of_one_root_share_a_voter():
    features = ["w:idiot@1", "4:idio@1", "w:idiots@2", "w:fool@1", "3:foo@1", "w:bar@1"]
    voters = toxicity.voters_of(features, list(range(6)))
    assert voters == {0: "idio:once", 1: "idio:once", 2: "idio:often", 3: "foo:once", 4: "foo:once", 5: "bar:once"}


def test_ftrl_equals_single_steps():
    random = np.random.default_rng(9)
    rows = [(np.sort(random.choice(50, 4, replace=False)), random.random(4)) for _ in range(30)]
    target = random.integers(0, 3, 30)
    got = language_id.train_ftrl(rows, target, 3, alpha=0.7, beta=1.0, l1=0.02, l2=0.1, epochs=2, seed=1)
    z, n = {}, {}

    def weight(c, k):
        v = z.get((c, k), 0.0)
        return 0.0 if abs(v) <= 0.02 else -(v - math.copysign(0.02, v)) / ((1.0 + math.sqrt(n.get((c, k), 0.0))) / 0.7 + 0.1)

    order = np.random.default_rng(1)
    for _ in range(2):
        for i in order.permutation(30):
            x = [*zip(rows[i][0].tolist(), rows[i][1].tolist()), (language_id.BUCKETS, 1.0)]
            old = {(c, k): weight(c, k) for c in range(3) for k, _ in x}
            scores = [sum(old[c, k] * v for k, v in x) for c in range(3)]
            top = [math.exp(s - max(scores)) for s in scores]
            for c in range(3):
                error = top[c] / sum(top) - (target[i] == c)
                for k, v in x:
                    g, before = error * v, n.get((c, k), 0.0)
                    z[c, k] = z.get((c, k), 0.0) + g - (math.sqrt(before + g * g) - math.sqrt(before)) / 0.7 * old[c, k]
                    n[c, k] = before + g * g
    for c in range(3):
        for k in [*range(50), language_id.BUCKETS]:
            assert math.isclose(got[c, k], weight(c, k), rel_tol=1e-9, abs_tol=1e-12)
