"""Near-duplicates against all pairs by brute force."""

import random
import re

import numpy as np

from ambar.llm import near_dup
from ambar.llm.common import setup
from ambar.llm.queries import QUERIES


def brute(rows):
    sets = {}
    for doc, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.setdefault(doc, []).append(frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset())
    up = {doc: doc for doc in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    holders = {}
    for doc, own in sets.items():
        for k, s in enumerate(own):
            for shingle in s:
                holders.setdefault(shingle, []).append((doc, k))
    pairs = {(a, b) for found in holders.values() for a in found for b in found if a[0] < b[0]}
    for (a, i), (b, j) in pairs:
        s, t = sets[a][i], sets[b][j]
        if 100 * len(s & t) >= 85 * len(s | t):
            a, b = root(a), root(b)
            up[max(a, b)] = min(a, b)
    return {doc: root(doc) for doc in sets}, sets


def test_keys_cover_the_distance():
    random.seed(5)
    import pyarrow as pa

    def keys(symbols):
        lanes = np.array(symbols, "<u2").reshape(1, -1).view("<i8")
        batch = pa.RecordBatch.from_arrays([pa.array([1])] + [pa.array(lanes[:, i]) for i in range(near_dup.LANES)], ["node", *near_dup.SIGNATURE])
        return set(next(near_dup._keys([batch])).column("key").to_pylist())

    for _ in range(300):
        a = [random.randrange(65536) for _ in range(64)]
        b = list(a)
        for i in random.sample(range(64), near_dup.MAX_ERRORS):
            b[i] ^= random.randrange(1, 65536)
        assert keys(a) & keys(b)


def test_op9_equals_brute_force(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    want, sets = brute(rows)
    got = QUERIES["op9_near_dup"](spark, sf_dir).collect()
    assert {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in got} == {(d, len(sets[d][0]), c, c == d) for d, c in want.items()}


def test_drifting_family_and_edge_rows(spark):
    random.seed(11)
    words = [f"w{random.randrange(10**6)}" for _ in range(160)]
    rows, now = [(1000, None), (1001, " \t\n"), (1002, "One TWO"), (1003, "one two"), (1004, "one"), (1005, "a b c d e"), (1006, "A b c d e"), (1006, "A b c d e"), (1007, "É b c d e"), (1008, "é b c d e")], list(words)
    for i in range(150):  # each copy differs a little from the one before, or starts again from the first
        now = list(words) if random.random() < 0.1 else list(now)
        for _ in range(random.randrange(3)):
            now[random.randrange(len(now))] = f"x{random.randrange(10**6)}"
        rows.append((random.randrange(10**5) * 10 + 2000, " ".join(now)))
    docs = setup(spark).createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'c' AS component_id", "1 AS node")
    want, sets = brute(rows)
    got = near_dup.near_duplicates(docs).collect()
    assert {(r["doc_id"], r["component_id"]) for r in got} == set(want.items())
    assert len(got) == len(rows) and all(r["kept"] == (want[r["doc_id"]] == r["doc_id"]) for r in got)


def test_large_families_in_small_blocks(spark, monkeypatch):
    """Everything through the blocks, several a family."""
    monkeypatch.setattr(near_dup, "LARGE", 3)
    monkeypatch.setattr(near_dup, "BLOCK_NODES", 20)
    test_drifting_family_and_edge_rows(spark)


def test_missing_ids_and_empty_tables(spark):
    docs = setup(spark).createDataFrame([(None, "a b c d e f"), (None, "a b c d e f"), (5, "a b c d e f"), (7, "a b c d e f"), (7, "q r s t u v"), (9, "q r s t u v")], "doc_id long, text string")
    got = sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in near_dup.near_duplicates(docs).collect()), key=str)
    assert got == [(5, 5, True), (7, 5, False), (7, 5, False), (9, 5, False), (None, None, True), (None, None, True)]
    assert near_dup.near_duplicates(docs.limit(0)).count() == 0
