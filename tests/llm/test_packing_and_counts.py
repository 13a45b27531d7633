"""Token counts and packing against the library itself."""

import json
import random
import re
import zlib

import numpy as np
import pytest

from ambar.llm import packing
from ambar.llm.common import setup, table
from ambar.llm.queries import QUERIES
from ambar.llm.token_counts import count_spliced, count_tokens, splice
from ambar.llm.tokens import Encoder, Ranked, byte_values, public_path

PATH = public_path("word_bpe_49k.json")


def library(path=PATH):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


ODD = ["", " ", "a", "It's <|endoftext|>ok<|startoftext|>", "x y z\x85w\x1c!", "é ́ ö", "ΑΣ ΟΔΟΣ. İ", "12 345 ４", "日本語のテキスト", "a\tb\r\nc\x0bd", "!!??...", "don't we'LL I'd", "퟿𝔘𝔫", "ﬁ ﬀ ſ", "THE,!! Ünö. İ: ½| ²; Σ, x.y ٣% e\u0301. a_b. It's,"]


def test_word_by_word_is_what_the_library_gives():
    enc, ids = Encoder(PATH), library()
    assert enc.by_word
    random.seed(3)
    for text in [*ODD, *["".join(random.choice(ODD) for _ in range(6)) for _ in range(300)]]:
        assert np.frombuffer(enc.ids_of([text])[0], "<u2").tolist() == ids(text), repr(text)


def test_plain_words_are_encoded_by_ranks():
    enc, ids = Encoder(PATH), library()
    random.seed(5)
    plain = [c for c in map(chr, range(0x21, 0x450)) if re.match(enc.ranked.plain, c)]
    assert set("aZ0é'|>_Žя") <= set(plain) and not set("<²µİ×\u0301") & set(plain)
    words = [w for c in plain for w in (c, f"a{c}", f"{c}s", f"'{c}l", f"1{c}{c}")]
    words += ["".join(random.choices(plain[:90] if k % 2 else plain, k=random.randint(1, 30))) for k in range(3000)]
    words += ["".join(random.choices("etaonrisdlu'", k=random.randint(1, 200))) for _ in range(300)]
    asked = []

    class Counted:
        def encode(self, text, **kwargs):
            asked.append(text)
            return tokenizer.encode(text, **kwargs)

    tokenizer, enc.tokenizer = enc.tokenizer, Counted()
    found = [np.frombuffer(x, "<u2").tolist() for x in enc.ids_of(words)]
    assert not asked  # the library encoded each new word before
    assert found == [ids(w) for w in words]
    mixed = [" ".join(random.choices([*words, *ODD, "q" * 300, "e\u0301", "J\u030c", "a<|endoftext|>b", "<|startoftext|>"], k=40)) for _ in range(60)]
    assert [np.frombuffer(x, "<u2").tolist() for x in enc.ids_of(mixed)] == [ids(t) for t in mixed]
    assert asked and enc.ids_of([]) == [] and enc.counts(["", "  ", " a "]) == [0, 0, 1]


def test_ranks_only_where_they_are_proven():
    with open(PATH, encoding="utf-8") as file:
        spec = json.load(file)

    def changed(merges, **other):
        names = [*byte_values(), *(c + "</w>" for c in byte_values()), *dict.fromkeys(a + b for a, b in merges)]
        return Ranked.of(spec | {"model": spec["model"] | {"vocab": {n: k for k, n in enumerate(names)}, "merges": merges}} | other)

    assert changed([["a", "b"], ["ab", "c"]]) is not None
    # The library gives a + bc for abc, ranks would give abc.
    assert changed([["b", "c"], ["a", "b"], ["ab", "c"]]) is None
    assert changed([["a", "b"], ["b", "c"], ["ab", "c"], ["a", "bc"]]) is None
    assert changed([["a", "b"]], normalizer=None) is None
    assert changed([["a", "b"]], added_tokens=[{"content": "end", "lstrip": False, "rstrip": False}]) is None


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_splices_do_not_change_the_count(spark, sf_dir, name):
    enc, ids = Encoder(public_path(name)), library(public_path(name))
    long = " ".join(r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(40).collect())
    for text in (long, " ".join(ODD * 40), "word " * 3000, "a" * 5000 + " b" * 3000):
        assert count_spliced(enc, text, chunk=1000, overlap=60, margin=480) == len(ids(text))
    assert splice(enc, "x" * 5000, 2500, 50, 400) is None


def test_counts_over_rows(spark):
    docs = setup(spark).createDataFrame([(1, None, "x"), (2, "", "y"), (None, "a b", "z"), (3, "one two " * 900, "z"), (3, "one two " * 900, "z"), (4, "q" * 7000, "z")], "doc_id long, text string, n_tokens string")
    ids = library()
    rows = count_tokens(docs, PATH, ["doc_id"], chunk_chars=1000, overlap_chars=60, margin_chars=480).collect()
    want = [(d, len(ids(t))) for d, t in docs.select("doc_id", "text").collect()]
    key = lambda x: (x[0] is None, x)
    assert sorted(map(tuple, rows), key=key) == sorted(want, key=key)
    assert count_tokens(docs.limit(0), PATH, ["doc_id"]).count() == 0


def test_op4_equals_library(spark, sf_dir):
    ids = library()
    want = {(r["doc_id"], len(r["text"].encode()), n := len(ids(r["text"])), n > 2048) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert {tuple(r) for r in QUERIES["op4_token_counts"](spark, sf_dir).collect()} == want


def test_allotment_is_monotone_and_exact():
    random.seed(1)
    for _ in range(60):
        totals = tuple(random.choice([0, 1, 2, 5, 50, 700]) for _ in range(random.randint(1, 7)))
        last = [0] * len(totals)
        for seats in range(sum(totals) + 2):
            now = packing.served(totals, seats)
            assert sum(now) == min(seats, sum(totals)) and all(a <= b for a, b in zip(last, now))
            last = now
        assert last == list(totals)


def test_plan_fills_windows_to_proportion():
    random.seed(2)
    for totals in ([1], [10, 0, 3], [1000, 10, 1, 500], [4096 * 3], [random.randint(0, 3000) for _ in range(15)]):
        plan, used = packing.Plan(totals, window=64, block=3), {}
        for queue, total in enumerate(totals):
            first = 0
            while first < total:
                n = min(random.randint(1, 90), total - first)
                end = 0
                for start, length, sequence, offset in plan.pieces(queue, first, n):
                    assert start == end and length > 0
                    end += length
                    for k in range(length):
                        assert (sequence, offset + k) not in used
                        used[sequence, offset + k] = queue
                assert end == n
                first += n
        sizes = {}
        for sequence, offset in used:
            sizes[sequence] = max(sizes.get(sequence, 0), offset + 1)
        assert sum(sizes.values()) == len(used) == sum(totals)
        assert all(n == 64 or n & (n - 1) == 0 for n in sizes.values())
        for sequence in range(sum(totals) // 64):
            for queue, total in enumerate(totals):
                got = sum(used[sequence, k] == queue for k in range(64))
                assert abs(got - 64 * total / sum(totals)) <= 3


def check_packing(rows, docs, ids):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert set(by_doc) == set(docs)
    for doc, text in docs.items():
        want, end = [*ids(text), 2], 0
        for r in sorted(by_doc[doc], key=lambda r: r["start"]):
            part = np.array(want[end : end + r["length"]], "<u4")
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (end, len(want), zlib.crc32(part.tobytes()))
            end += r["length"]
        assert end == len(want)
    for pieces in by_sequence.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end == 4096 or end < 4096 and end & (end - 1) == 0


def test_op8_round_trip(spark, sf_dir):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    check_packing(QUERIES["op8_packing"](spark, sf_dir).collect(), docs, library())


def test_packing_edge_rows(spark):
    rows = [(1, None, None), (2, "", "a"), (3, "b c", None), (4, "many words " * 4000, "a")]
    docs = setup(spark).createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "'x' AS queue", "'y' AS ids", "1 AS n")
    check_packing(packing.pack(docs, PATH).collect(), {r[0]: r[1] for r in rows}, library())
    assert packing.pack(docs.limit(0), PATH).count() == 0
    twice = packing.pack(docs.where("doc_id = 4").unionAll(docs.where("doc_id = 4")), PATH).collect()
    assert sum(r["length"] for r in twice) == 2 * twice[0]["doc_tokens"]
