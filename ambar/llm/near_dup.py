"""Near-duplicate documents by a multi-index Hamming join of b-bit MinHash signatures.

A document's set holds its distinct five-word shingles. Its signature has ``SYMBOLS`` MinHash values of 16 bits.
Two documents at similarity 0.85 differ in 15 of 100 symbols on average; pairs that differ in more than
``MAX_ERRORS`` = 23 of 64 are no candidates (at 0.85 a pair differs in more with probability 1e-5, and less above).
The signature is split into 12 chunks. Of at most 23 errors, some chunk has one at most (pigeonhole), so two
documents within the distance agree in one chunk but for one symbol at most. Each document lists, for every
chunk, the chunk without each one of its symbols: 64 keys, and every pair within the distance shares one.

Exact copies (equal sets) are one node of the graph, whatever their number. Nodes that share a key are joined to
the smallest node of that key, not to each other; what passes the exact check on the full sets gives first
components. Only keys whose nodes then still lie in several components are looked at again, and there only pairs
between components: listed where at most ``LARGE`` nodes share a key; beyond that, nodes tied by such keys form a
family, which is compared in blocks that give back links but no pairs. Nothing that could be a link between
different components is left out, and no pairs inside a component are listed.

Defined results: a text that is missing or without words has an empty set, is linked with nothing and kept;
repeated rows of one doc_id are one document, linked through any of its texts; a missing doc_id is linked with
nothing, has no component and is kept; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ambar.llm.common import LOWER_ASCII, Memo, apart, find_words, kept_once, map_batches, mix64, table, texts
from ambar.operators.joins import sized_join

SHINGLE = 5
SIMILARITY = 85  # in hundredths
SYMBOLS, BITS = 64, 16
MAX_ERRORS, CHUNKS = 23, 12
ERRORS_IN_CHUNK = MAX_ERRORS // CHUNKS
assert ERRORS_IN_CHUNK == 1  # what the keys below enumerate
LANES = SYMBOLS * BITS // 64
LARGE = 64  # nodes of a key up to which its pairs are listed
BLOCK_NODES, BLOCK_SHINGLES = 512, 1_000_000  # about what one block of a large family holds on each side
SIGNATURE = [f"s{i}" for i in range(LANES)]

_random = np.random.default_rng(20240607)
_PLACES = _random.integers(0, 2**63, SHINGLE, dtype=np.uint64) | np.uint64(1)
_XOR = _random.integers(0, 2**63, SYMBOLS, dtype=np.uint64)
_TIMES = _random.integers(0, 2**63, SYMBOLS, dtype=np.uint64) | np.uint64(1)
_SYMBOL = _random.integers(0, 2**63, SYMBOLS, dtype=np.uint64) | np.uint64(1)


def word_hashes() -> Memo:
    return Memo(lambda word: xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass")))


def shingle_set(text: str, memo: Memo) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; of the whole word sequence if it is shorter than one."""
    words = find_words(text.translate(LOWER_ASCII))
    if not words:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
    n, size = max(1, len(w) - SHINGLE + 1), min(SHINGLE, len(w))
    h = np.full(n, size, np.uint64)
    for k in range(size):
        h += w[k : k + n] * _PLACES[k]
    return np.unique(mix64(h))


def signature(shingles: np.ndarray) -> np.ndarray:
    """``SYMBOLS`` values of 16 bits: of each hash function, the low bits of the least value over the set."""
    least = np.full(SYMBOLS, 2**32 - 1, np.uint64)
    for start in range(0, len(shingles), 2048):
        block = shingles[start : start + 2048, None] ^ _XOR
        block *= _TIMES
        block >>= np.uint64(32)
        np.minimum(least, block.min(axis=0), out=least)
    return (least & np.uint64(0xFFFF)).astype("<u2")


def _sketch(batches):
    memo = word_hashes()
    for batch in batches:
        sets = [shingle_set(t, memo) for t in texts(batch)]
        signs = np.array([signature(s) for s in sets], "<u2").reshape(-1, SYMBOLS).view("<i8")
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                *[pa.array(signs[:, i], pa.int64()) for i in range(LANES)],
            ],
            ["doc_id", "n_shingles", "digest", *SIGNATURE],
        )


def _keys(batches):
    """The 64 keys of each node; a key's low 6 bits say which chunk and which symbol is left out."""
    for batch in batches:
        lanes = np.column_stack([batch.column(s).to_numpy() for s in SIGNATURE]) if batch.num_rows else np.empty((0, LANES), np.int64)
        symbols = np.ascontiguousarray(lanes).view("<u2").reshape(-1, SYMBOLS).astype(np.uint64) * _SYMBOL
        keys = np.empty(symbols.shape, np.uint64)
        for chunk in np.array_split(np.arange(SYMBOLS), CHUNKS):
            keys[:, chunk] = symbols[:, chunk].sum(axis=1, keepdims=True, dtype=np.uint64) - symbols[:, chunk]
        keys = (mix64(keys) & ~np.uint64(63)) | np.arange(SYMBOLS, dtype=np.uint64)
        node = np.repeat(batch.column("node").to_numpy(), SYMBOLS)
        yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1).view(np.int64)), pa.array(node)], ["key", "node"])


def _shingle_rows(batches):
    memo = word_hashes()
    for batch in batches:
        sets = [shingle_set(t, memo).view(np.int64) for t in texts(batch)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sets, pa.list_(pa.int64()))], ["doc_id", "shingles"])


def distance(a: str, b: str) -> Column:
    """Number of symbols in which the signatures of the aliases ``a`` and ``b`` differ, four symbols at a time."""
    total = F.lit(0)
    for s in SIGNATURE:
        x = F.col(f"{a}.{s}").bitwiseXOR(F.col(f"{b}.{s}"))
        for shift in (8, 4, 2, 1):  # gathers a symbol's bits in its lowest one
            x = x.bitwiseOR(F.shiftrightunsigned(x, shift))
        total = total + F.bit_count(x.bitwiseAND(F.lit(0x0001000100010001)))
    return total


def may_link(a: str, b: str) -> Column:
    """Close enough in size and signature."""
    n, m = F.col(f"{a}.n_shingles"), F.col(f"{b}.n_shingles")
    return (100 * F.least(n, m) >= SIMILARITY * F.greatest(n, m)) & (distance(a, b) <= MAX_ERRORS)


def sets_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``doc_id`` and ``shingles`` of the documents in ``ids``."""
    return map_batches(sized_join(docs, ids, ["doc_id"], "left_semi"), _shingle_rows, "doc_id long, shingles array<long>")


def verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The ``pairs`` (a, b) whose full sets reach the similarity. Sets are made for the documents of pairs only."""
    sets = kept_once(sets_of(docs, kept_once(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct())))
    left, right = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("_sa")), sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("_sb"))
    both = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("_sa", "_sb"))
    return both.where(100 * common >= SIMILARITY * (F.size("_sa") + F.size("_sb") - common)).select("a", "b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (the least node reachable) of every node of the links (a, b).

    Least labels spread along the links and then jump along the labels, so chains shorten quickly. Every round is
    written, so lineage stays short.
    """
    both = kept_once(edges.select("a", "b").unionAll(edges.select("b", "a")).distinct())
    labels = kept_once(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component")))
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("_near"))
        spread = kept_once(labels.join(near, "node").select("node", F.col("component").alias("_old"), F.least("component", "_near").alias("component")))
        up = spread.select(F.col("node").alias("component"), F.col("component").alias("_up"))
        new = kept_once(spread.join(up, "component", "left").select("node", "_old", F.least("component", F.coalesce("_up", "component")).alias("component")))
        if not new.where(F.col("_old") != F.col("component")).take(1):
            return new.select("node", "component")
        labels = new.select("node", "component")


def links(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """Verified links (a, b) between nodes that connect the same components as all links."""
    sign = nodes.select("node", "n_shingles", *SIGNATURE)
    keys = map_batches(sign, _keys, "key long, node long")
    shared = keys.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high").select("key", "low")
    buckets = kept_once(keys.join(shared, "key"))

    near = lambda pairs: (
        pairs.join(sign.withColumnRenamed("node", "a").alias("x"), "a").join(sign.withColumnRenamed("node", "b").alias("y"), "b").where(may_link("x", "y")).select("a", "b")
    )
    stars = kept_once(near(buckets.where("node != low").select(F.col("low").alias("a"), F.col("node").alias("b")).distinct()))
    first = kept_once(verified(stars, docs))

    # Keys whose nodes then still lie in several components.
    placed = buckets.join(components(first), "node", "left").select("key", "low", "node", F.coalesce("component", "node").alias("component"))
    several = placed.groupBy("key").agg(F.min("component").alias("_least"), F.max("component").alias("_most"), F.count("*").alias("n")).where("_least < _most")
    opened = kept_once(placed.join(several.select("key", "n"), "key").join(sign, "node"))
    large = opened.where(F.col("n") > LARGE)
    family = kept_once(components(large.where("node != low").select(F.col("low").alias("a"), F.col("node").alias("b"))).withColumnRenamed("component", "family"))

    # Few nodes share a key: its pairs are listed, at most LARGE a node and key.
    few = opened.where(F.col("n") <= LARGE).join(family, "node", "left")
    x, y = few.alias("x"), few.alias("y")
    apart = (F.col("x.component") != F.col("y.component")) & F.coalesce(F.col("x.family") != F.col("y.family"), F.lit(True))
    rest = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.node") < F.col("y.node")) & apart & may_link("x", "y"))
    rest = rest.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()
    rest = kept_once(rest.join(stars, ["a", "b"], "left_anti"))

    members = kept_once(family.join(opened.select("node", "component", "n_shingles").distinct(), "node"))
    return first.unionByName(verified(rest, docs)).unionByName(family_links(members, docs))


def family_links(members: DataFrame, docs: DataFrame) -> DataFrame:
    """Links (a, b) that connect the components of each family as all its links do.

    ``members`` has ``node``, ``family``, ``component``, ``n_shingles``. The nodes outside a family's largest
    component are held against all of its nodes, in blocks of bounded size that are dealt out over the cluster. A
    block counts the common shingles of all its pairs as a matrix product and gives back no more links than it
    has components.
    """
    parts = members.groupBy("family", "component").agg(F.count("*").alias("n"))
    main = parts.groupBy("family").agg(F.max_by("component", F.struct("n", "component")).alias("main"), F.count("*").alias("parts")).where("parts > 1")
    rows = members.join(main.select("family", "main"), "family").withColumn("minor", F.col("component") != F.col("main"))
    blocks = lambda n, size: F.greatest(F.ceil(n / BLOCK_NODES), F.ceil(size / BLOCK_SHINGLES), F.lit(1)).cast("int")
    size = F.col("n_shingles")
    plan = rows.groupBy("family").agg(
        blocks(F.count("*"), F.sum(size)).alias("n_all"), blocks(F.count(F.when(F.col("minor"), 1)), F.sum(F.when(F.col("minor"), size))).alias("n_minor")
    )
    dealt = kept_once(rows.join(plan, "family"))
    own = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = dealt.where("minor").select("family", "node", "component", own("n_minor").alias("i"), upto("n_all").alias("j"), F.lit(True).alias("left"))
    right = dealt.select("family", "node", "component", upto("n_minor").alias("i"), own("n_all").alias("j"), F.lit(False).alias("left"))
    sets = sets_of(docs, kept_once(dealt.select(F.col("node").alias("doc_id")).distinct()))
    filled = left.unionByName(right).join(sets.withColumnRenamed("doc_id", "node"), "node")
    return filled.groupBy("family", "i", "j").applyInArrow(_block_links, "a long, b long")


def _block_links(block: pa.Table) -> pa.Table:
    node, component = block.column("node").to_numpy(), block.column("component").to_numpy()
    sets = [np.asarray(s, np.int64) for s in block.column("shingles").to_numpy()]
    is_left = np.array(block.column("left").to_pylist(), bool)
    left, right = np.flatnonzero(is_left), np.flatnonzero(~is_left)
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, place = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(place, kind="stable")
    place, owner = place[order], owner[order]
    row = np.empty(len(sets), np.int64)
    row[left], row[right] = np.arange(len(left)), np.arange(len(right))
    common = np.zeros((len(left), len(right)), np.float32)
    for start in range(0, int(place[-1]) + 1 if len(place) else 0, 4096):
        a, b = np.searchsorted(place, [start, start + 4096])
        at, who = place[a:b] - start, owner[a:b]
        one, other = np.zeros((len(left), 4096), np.float32), np.zeros((len(right), 4096), np.float32)
        mine = is_left[who]
        one[row[who[mine]], at[mine]] = 1
        other[row[who[~mine]], at[~mine]] = 1
        common += one @ other.T
    common = common.astype(np.int64)
    linked = 100 * common >= SIMILARITY * (sizes[left][:, None] + sizes[right][None, :] - common)
    linked &= component[left][:, None] != component[right][None, :]
    up = {c: c for c in component.tolist()}

    def root(c):
        while up[c] != c:
            up[c] = up[up[c]]
            c = up[c]
        return c

    found = []
    for i, j in zip(*np.nonzero(linked)):
        a, b = left[i], right[j]
        ra, rb = root(int(component[a])), root(int(component[b]))
        if ra != rb:
            up[max(ra, rb)] = min(ra, rb)
            found.append((min(node[a], node[b]), max(node[a], node[b])))
    return pa.table({"a": pa.array([f[0] for f in found], pa.int64()), "b": pa.array([f[1] for f in found], pa.int64())})


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` of every row of ``docs`` (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    schema = "doc_id long, n_shingles long, digest binary, " + ", ".join(f"{s} long" for s in SIGNATURE)
    base = kept_once(map_batches(docs, _sketch, schema))
    whole = base.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = kept_once(
        whole.groupBy("digest").agg(F.min("doc_id").alias("node"), F.max("n_shingles").alias("n_shingles"), F.count("*").alias("n"), *[F.max(s).alias(s) for s in SIGNATURE])
    )
    # Texts of one document under one id are tied to each other by that id: the class's node and every member of
    # the class that also stands for another class.
    again = whole.groupBy("doc_id").agg(F.min("digest").alias("_d"), F.max("digest").alias("_e")).where("_d != _e").select("doc_id")
    ties = whole.join(again, "doc_id", "left_semi").join(classes.select("digest", "node"), "digest").select(F.col("node").alias("a"), F.col("doc_id").alias("b")).where("a != b").distinct()
    found = components(links(classes, docs.where("doc_id IS NOT NULL")).unionByName(ties))
    label = kept_once(
        classes.select("digest", "node", "n").join(found, "node", "left").select("digest", F.coalesce("component", "node").alias("component_id"), "n")
    )
    out = sized_join(base.select("doc_id", "n_shingles", "digest"), label, ["digest"], "left", rows_col="n")
    linked = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    component = F.when(linked, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.col("doc_id").isNull() | (F.col("doc_id") == F.col("component_id")))


def first_rows(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component its least doc_id, in one row, as it is."""
    verdict = kept_once(near_duplicates(docs).where("doc_id IS NOT NULL"))
    ids = verdict.groupBy("doc_id").agg(F.bool_or("kept").alias("kept"), F.count("*").alias("n"))
    gone = kept_once(ids.where("NOT kept OR n > 1").select("doc_id"))
    again = kept_once(ids.where("kept AND n > 1").select("doc_id"))
    # What goes is less than what stays, and rows without an id stay by themselves.
    rows, names, restored = apart(docs)
    key = names["doc_id"]
    once = sized_join(rows, gone.withColumnRenamed("doc_id", key), [key], "left_anti")
    one = sized_join(rows, again.withColumnRenamed("doc_id", key), [key], "left_semi").dropDuplicates([key]).select(*rows.columns)
    return restored(once.select(*rows.columns).unionByName(one))


def op9_near_dup(spark, sf_dir):
    """Components of near-duplicates over all documents."""
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
