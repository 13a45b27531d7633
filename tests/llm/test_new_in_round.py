"""Spelling variants, page text and token alignment against brute force, and their odd cases."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ambar.llm import alignment, html_text, spelling
from ambar.llm.common import setup
from ambar.llm.queries import QUERIES
from ambar.llm.tokens import public_path

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BYTES, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"


def corpus(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, n long, word string")


# Spelling variants


def counted(rows):
    c = Counter()
    for doc, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = w.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{w}".encode())
            if h % 97 == 0:
                i = h % len(w)
                w = w[:i] + w[i + 1 :]
            c[w] += 1
    return {w: n for w, n in c.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def all_variants(c):
    near = {w: [x for x in c if x != w and abs(len(x) - len(w)) < 2 and one_edit(w, x)] for w in c}
    form = {}
    for w, found in near.items():
        if found:
            best = min(found, key=lambda x: (-c[x], x))
            if c[best] >= 2 * c[w]:
                form[w] = best

    def last(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), last(w), c[w], len(near[w]), c[form[w]] if w in form else None) for w in c}


def test_variants_equal_brute_force(spark, sf_dir):
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = [tuple(r) for r in QUERIES["op11_spelling"](spark, sf_dir).select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(got) == len(set(got))
    assert set(got) == all_variants(counted(rows))


def test_pairs_of_few_letters_equal_brute_force(spark):
    draw = random.Random(3)
    words = {"".join(draw.choices("abÀ", k=draw.randint(5, 8))) for _ in range(500)} | {"a" * k for k in range(5, 40)} | {"ab" * 2000, "ab" * 2000 + "c"}
    frame = spark.createDataFrame([(w, 3) for w in words], "word string, n long").repartition(5)
    got = [(r["a"], r["b"]) for r in spelling.near_pairs(frame).collect()]
    assert len(got) == len(set(got))
    assert set(got) == {(a, b) for a, b in itertools.combinations(sorted(words), 2) if one_edit(a, b)}


def test_spare_pivot_is_in_a_prefix():
    draw = random.Random(8)
    words = ["".join(draw.choices("abcd", k=draw.randint(5, 9))) for _ in range(400)]
    index = spelling.GramIndex(Counter(g for w in words for g in {w[i : i + 2] for i in range(len(w) - 1)}))
    for w in words:
        i, j = index.pivots(w, index.prefix(w))
        assert j >= i + 2
    for a, b in itertools.combinations(words[:200], 2):
        if a != b and one_edit(a, b):
            assert set(index.pivot_keys(a)) & set(index.prefix_keys(b)) or set(index.pivot_keys(b)) & set(index.prefix_keys(a))


def test_roots_follow_long_chains(spark):
    chain = [(f"w{i:03d}", f"w{i + 1:03d}") for i in range(37)] + [("x", "w005"), ("y", "z")]
    got = dict(spelling.roots(spark.createDataFrame(chain, "word string, form string")).collect())
    assert got == {**{f"w{i:03d}": "w037" for i in range(37)}, "x": "w037", "y": "z"}


def test_odd_texts_have_defined_words(spark):
    rows = [(1, None, None, 1, "a"), (2, "", "x", 2, None), (None, "Straße straße STRASSE", None, None, None), (3, "12 .. ¿?", None, 1, "b")]
    rows += [(4, "colour color colour Colour color color colour", None, 1, "c")] * 2 + [(5, "q" * 300_000, None, None, None)] * 3
    setup(spark)
    docs = corpus(spark, rows).repartition(3)
    got = {tuple(r) for r in spelling.variants(spelling.word_counts(docs, typo_every=97)).collect()}
    assert got == all_variants(counted([(r[0], r[1]) for r in rows]))
    assert spelling.variants(spelling.word_counts(docs.where("false"))).count() == 0


def test_checksums_of_joined_texts():
    start, sizes = zlib.crc32(b"17:"), np.array([1, 5, 5, 300])
    words = [b"a", b"hello", b"world", b"x" * 300]
    want = [zlib.crc32(b"17:" + w) for w in words]
    assert (np.array([zlib.crc32(w) for w in words], np.uint32) ^ spelling.checksum_shift(start, sizes)).tolist() == want


# Page text


def brute_marginals(tree, w):
    """By enumeration of all labellings."""
    forest = html_text.Forest([tree])
    n = len(tree.parent)
    total, one, own = 0.0, np.zeros(n), forest.x @ w.own
    for y in itertools.product((0, 1), repeat=n):
        score = sum(own[i] for i in range(n) if y[i]) + sum(w.edge[forest.edge[i], y[tree.parent[i]], y[i]] for i in range(1, n))
        p = np.exp(score)
        total += p
        one += p * np.array(y)
    return one / total, np.log(total)


def test_messages_give_exact_marginals():
    draw = np.random.default_rng(4)
    w = html_text.Weights(draw.normal(0, 1, len(html_text.FEATURES)), draw.normal(0, 1, (4, 2, 2)))
    trees = [html_text.Tree(p) for p in ("<div><p>a<p>b</div><nav>c</nav>", "<ul><li>x<li>y</ul>", "", "t<div class=ad>u<div>v</div></div>")]
    node, edges, partition = html_text.pass_messages(html_text.Forest(trees), w)
    at, logs = 0, 0.0
    for tree in trees:
        want, log = brute_marginals(tree, w)
        assert np.allclose(node[at : at + len(want), 1], want)
        at, logs = at + len(want), logs + log
    assert np.isclose(partition, logs)
    forest = html_text.Forest(trees)
    inner = forest.parent >= 0
    assert np.allclose(edges[inner].sum(1), node[inner]) and np.allclose(edges[inner].sum(2), node[forest.parent[inner]])


def test_practice_pages_of_other_numbers_are_read_right():
    w = html_text.learn([])
    wrong = right = 0
    for k in range(20_000, 20_150):
        tree, y = html_text.practice_page(k)
        forest = html_text.Forest([tree])
        got = html_text.pass_messages(forest, w)[0][:, 1] >= 0.5
        wrong += int((got != (y == 1))[forest.leaf].sum())
        right += int((got == (y == 1))[forest.leaf].sum())
    assert wrong < 0.02 * right


def test_articles_of_the_table_are_whole(spark, sf_dir):
    import html

    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    got = QUERIES["op12_html_text"](spark, sf_dir).collect()
    assert len(got) == len(pages)
    for r in got:
        article = re.search(r"<article>(.*)</article>", pages[r["page_id"]], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"<(?:/?p|/?h1)>", article)]
        assert r["text"] == "\n".join(b for b in blocks if b)
        assert r["n_chars"] == len(r["text"])


PAGE = (
    "<!doctype html><title>T</title><nav><a href=/>Home</a> <a href=/b>News</a></nav><div class='sidebar'><p>Read this also today.</p></div>"
    "<div id=cookie-consent>We use cookies &amp; more.</div><article><h1>A&nbsp;title &eacute;</h1><p>First <b>bold</b>\n\n word.<p>Second&#x20;one <a href=x>link</a>.<script>var a='<p>no</p>'</script>"
    "<!-- <p>hidden</p> --><form><p>Your mail here.</p></form><ul><li>one<li>two</ul></article>"
    "<section id=comments><h3>Comments</h3><p>I liked this very much.</p></section><div class=ad>Buy now.</div><footer>&copy; us"
)


def test_blocks_and_references():
    w = html_text.learn([])
    assert html_text.content_of([html_text.Tree(PAGE)], w) == ["A title é\nFirst bold word.\nSecond one link.\none\ntwo"]


def test_odd_pages_have_defined_texts(spark):
    setup(spark)
    deep = "<div>" * 20_000 + "deep" + "</div>" * 20_000
    pages = [None, "", "<", "<!-- open", "<script>open", "</p></div>", "plain words only", deep, "<article><p>" + "word " * 300_000 + "</article>", "<p a=\"1>2\" b='x'>q", "<a href=\"open>lost", PAGE, PAGE]
    rows = [(i, "u", p, "c", 1, p) for i, p in enumerate(pages)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars long, name string").repartition(3)
    got = {r["page_id"]: r for r in html_text.main_text(frame).collect()}
    assert got.keys() == set(range(len(pages)))
    assert [got[i]["text"] for i in range(6)] == [""] * 2 + [got[2]["text"], "", "", ""]
    assert got[8]["n_chars"] == 300_000 * 5 - 1
    assert got[11]["text"] == got[12]["text"] != ""
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())
    assert html_text.main_text(frame.where("false")).count() == 0


# Alignment


def aligned(rows):
    """Straight from the definitions, with whole texts."""
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(public_path(BYTES)), sentencepiece.SentencePieceProcessor(model_file=public_path(PIECES))
    a.encode_special_tokens = True
    value, docs, count = alignment.byte_values(), [], Counter()
    for doc, text in rows:
        docs.append((doc, None))
        if not text:
            continue
        whole = (" " + text).encode()
        one = [(i, bytes(value[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
        two = [(i, bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)]
        if b"".join(t for _, t in one) != whole or b"".join(t for _, t in two) != whole:
            continue
        spans = [[(i, e - len(t), e) for (i, t), e in zip(tokens, itertools.accumulate(len(t) for _, t in tokens))] for tokens in (one, two)]
        links, start = [], 0
        for i, s, e in spans[0]:
            while spans[1][start][2] <= s:
                start += 1
            links += [(i, j) for j, t, u in itertools.takewhile(lambda x: x[1] < e, spans[1][start:])]
        cuts = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        groups, lo = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(i) for i, s, e in own if lo < e <= cut) for own in spans))
            lo = cut
        count.update(links)
        docs[-1] = (doc, (len(one), len(two), groups, links))
    best = {}
    for (_, j), n in count.items():
        best[j] = max(best.get(j, 0), n)
    out = []
    for doc, found in docs:
        if not found:
            out.append((doc, 0, 0, 0, 0, 0, 0, ""))
        else:
            n_a, n_b, groups, links = found
            out.append((doc, n_a, n_b, len(groups), len(links), sum(count[x] == best[x[1]] for x in links), sum(count[x] for x in links), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return sorted(out)


ODD = [None, "", " ", "  ", "a  b\n  c\t d ", "x▁y", "<|endoftext|> <s> </s> <unk>", "日本語テキスト" * 200, "   a b", "é 🎉👩‍👩‍👧", "trail   ", "a\n b\r\n  c", "a　 b  c", "x" * 5000, "same words", "same words"]


@pytest.mark.parametrize("table_bytes", [1 << 30, 0])
def test_alignment_equals_brute_force(spark, sf_dir, table_bytes):
    setup(spark)
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").orderBy("doc_id").limit(60).collect()]
    rows += [(10_000 + i, t) for i, t in enumerate(ODD)]
    docs = corpus(spark, [(*r, None, 1, "w") for r in rows]).repartition(5)
    got = alignment.alignments(docs, public_path(BYTES), public_path(PIECES), table_bytes=table_bytes)
    assert sorted(tuple(r) for r in got.collect()) == aligned(rows)


def test_alignment_of_the_whole_table(spark, sf_dir):
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(tuple(r) for r in QUERIES["op13_alignment"](spark, sf_dir).collect()) == aligned(rows)


def test_alignment_of_nothing(spark):
    docs = corpus(spark, [(1, "a", None, 1, None)])
    assert alignment.alignments(docs.where("false"), public_path(BYTES), public_path(PIECES)).count() == 0


def test_perfect_hash_is_minimal_and_knows_its_keys():
    keys = np.unique(np.random.default_rng(1).integers(0, 2**31, 20_000))
    made = alignment.PerfectHash.build(keys)
    assert sorted(made(keys).tolist()) == list(range(len(keys)))
    again = alignment.PerfectHash.load(*made.dump())
    assert np.array_equal(again(keys), made(keys))
    placed = np.empty_like(keys)
    placed[made(keys)] = keys
    table = alignment.CountTable([{"shard": s, "packed": made.dump()[0], "sizes": made.dump()[1], "placed": placed.tobytes(), "vector": (placed + 1).tobytes()} for s in range(alignment.SHARDS)], np.zeros(10, np.int64))
    strange = np.setdiff1d(np.arange(50_000), keys)
    assert np.array_equal(table.counts(keys), keys + 1) and not table.counts(strange).any()


def test_groups_are_counted_over_all_parts(spark):
    docs = corpus(spark, [(i, "alpha beta " * 30, None, 1, None) for i in range(40)]).repartition(8)
    got = alignment.alignments(docs, public_path(BYTES), public_path(PIECES)).agg(F.min("count_sum"), F.max("count_sum"), F.count("*")).first()
    assert got[0] == got[1] > 0 and got[2] == 40
