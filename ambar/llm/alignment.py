"""Alignment of two tokenizers: which tokens of one cover the same bytes as which of the other, counted corpus-wide.

1. Every text is encoded by both, cut where both cut, and tokens whose byte ranges overlap are linked. A space behind
   a visible character begins a token in either encoding, so a text is aligned piece by piece between such spaces, and
   what a piece gives is remembered. Each task keeps its counts of linked id pairs, parted by a hash of the pair.
2. Each part's distinct pairs get a minimal perfect hash (a cascade of bit arrays: a key takes a bit that no other key
   of its level wants, the others go on to the next level). Key numbers are ranks of bits, 0 to n - 1 without gaps.
3. The tasks' counts become dense vectors indexed by hash, which are summed up a tree: by groups of tasks, then groups.
   The keys stand beside the counts, so that a lookup of a pair that isn't there is noticed.
4. A second pass aligns the texts again and looks the counts up.

The table of all parts goes to the executors if it measures no more than ``TABLE_BYTES``; otherwise a text's pairs are
joined with their parts' tables, by part. Either way the results are the same.

Defined results: missing and empty texts, and texts whose token bytes don't give back the text with a space before it
(those with U+2581), have no tokens: zeros and an empty string. Repeated rows count as often as they are there. Long
texts are aligned in pieces; one without spaces is one piece. An empty table gives an empty result. Other columns are
not looked at.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
import math
import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ambar.llm.common import flat, kept_once, map_batches, mix64, table
from ambar.llm.tokens import byte_values, public_path
from ambar.operators.joins import measured_bytes, salted_join

SHARDS = 256
TABLE_BYTES = 96 << 20
KNOWN_PIECES, KNOWN_LINKS = 500_000, 8_000_000  # that a worker remembers
LONG_PIECE = 500  # characters
TOGETHER = 1024  # new pieces that are encoded as one text
FLUSH_PAIRS = 4_000_000
TEXTS = 256

# A space begins a new piece where the character before it is not white space.
# Fixed value: the pattern of byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
find_pieces = re.compile(r" [^ ]*(?:(?<=\s) [^ ]*)*").findall


class Bytewise:
    """Ids of texts and the bytes of each id, by the library of a tokenizer's file."""

    def __init__(self, path: str):
        if path.endswith(".json"):
            from tokenizers import Tokenizer

            own = Tokenizer.from_file(path)
            own.encode_special_tokens = True
            own.no_truncation()
            own.no_padding()
            value = byte_values()
            self.tokens = [b""] * own.get_vocab_size()
            for token, i in own.get_vocab().items():
                self.tokens[i] = bytes(value[c] for c in token) if all(c in value for c in token) else token.encode()
            self.encode_long = lambda texts: [e.ids for e in own.encode_batch(texts, add_special_tokens=False)]
            ranks = self.ranks(path)
            if ranks is None:
                self.encode = self.encode_long
            else:
                import tiktoken

                quick = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
                self.encode = lambda texts: [quick.encode_ordinary(t) for t in texts]
        else:
            from sentencepiece import SentencePieceProcessor

            own = SentencePieceProcessor(model_file=path)
            self.tokens = [
                bytes([int(own.id_to_piece(i)[3:-1], 16)]) if own.is_byte(i) else own.id_to_piece(i).replace("▁", " ").encode()
                for i in range(own.get_piece_size())
            ]
            # The model adds the space before a text itself, but not before an empty one.
            space = [own.piece_to_id("▁")]
            self.encode = self.encode_long = lambda texts: [ids or space for ids in own.encode([t[1:] for t in texts], num_threads=1)]
        self.sizes = np.array([len(t) for t in self.tokens], np.int64)

    def ranks(self, path: str) -> dict[bytes, int] | None:
        """Bytes of the tokens by rank, where the file is the plain byte-level BPE that ranks describe: bytes first, then
        one token per merge in the merges' order, and the usual pattern. Encoding by ranks gives the same ids, quicker."""
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        plain = spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
        same = model["type"] == "BPE" and not model.get("ignore_merges") and all(model["vocab"].get(a + b) == 256 + k for k, (a, b) in enumerate(merges))
        if not (plain and same and sorted(model["vocab"][c] for c in byte_values()) == list(range(256))):
            return None
        return {self.tokens[i]: i for i in range(256 + len(merges))}


def align(a: np.ndarray, b: np.ndarray, end_a: np.ndarray, end_b: np.ndarray):
    """Linked places of two sequences of tokens over the same bytes, the ends of the stretches that each link covers, and
    the ends of the groups."""
    # Each stretch between neighbouring ends of either is covered by one token of each.
    ends = np.union1d(end_a, end_b)
    return np.searchsorted(end_a, ends), np.searchsorted(end_b, ends), ends, np.intersect1d(end_a, end_b, assume_unique=True)


VALUES = ("right", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


class Pieces:
    """What each piece of a text gives, remembered: sizes, linked pairs, and with ``table`` their counts and the groups' text.

    New pieces are encoded many in one text and told apart by their ends, at which both encodings must cut; where they
    don't, or the bytes differ, each piece is encoded alone. When too much is remembered, pieces met once go first.
    """

    def __init__(self, path_a: str, path_b: str, table: CountTable | None = None):
        self.a, self.b, self.table = Bytewise(path_a), Bytewise(path_b), table
        self.width, self.waiting = len(self.b.tokens), []
        self.keep(np.empty(0, np.int64))

    def keep(self, kept: np.ndarray) -> None:
        """Forget all pieces but the numbered ones."""
        some = kept.tolist()
        self.names = [self.names[i] for i in some] if some else []
        self.known = dict(zip(self.names, range(len(some))))
        self.pairs = [self.pairs[i].copy() for i in some] if some else []
        self.text = [self.text[i] for i in some] if some else []
        values = np.zeros((len(some) + 1024, len(VALUES)), np.int64)
        if some:
            values[: len(some)] = self.values[kept]
        self.values, self.met = values, np.zeros(len(values), np.int64)

    def full(self) -> bool:
        return len(self.names) > KNOWN_PIECES or int(self.values[: len(self.names), 4].sum()) > KNOWN_LINKS

    def forget(self) -> None:
        """Keep the pieces met most often, half of what fits at most."""
        met, links = self.met[: len(self.names)], self.values[: len(self.names), 4]
        order = np.argsort(-met, kind="stable")
        order = order[(met[order] > 1) & (np.cumsum(links[order]) < KNOWN_LINKS // 2)]
        self.keep(np.sort(order[: KNOWN_PIECES // 2]))

    def add(self, names: list[str], values: np.ndarray, pairs: list[np.ndarray], texts: list[str | None]) -> None:
        n = len(self.names)
        if n + len(names) > len(self.values):
            grown = np.zeros((2 * (n + len(names)), len(VALUES)), np.int64)
            grown[:n] = self.values[:n]
            self.values, self.met = grown, np.concatenate([self.met[:n], np.zeros(len(grown) - n, np.int64)])
        self.values[n : n + len(names)] = values
        self.known.update(zip(names, range(n, n + len(names))))
        self.names += names
        self.pairs += pairs
        self.text += texts

    def learn(self, new: list[str]) -> None:
        # Behind a piece that ends in white space, the next one's space would not begin a token. Very long pieces go to the
        # encoder whose time grows with their length only.
        alone = [p for p in new if p[-1].isspace() or len(p) > LONG_PIECE]
        others = [p for p in new if not (p[-1].isspace() or len(p) > LONG_PIECE)]
        groups = [others[k : k + TOGETHER] for k in range(0, len(others), TOGETHER)]
        joined = ["".join(g) for g in groups]
        for group, text, a, b in zip(groups, joined, self.a.encode(joined), self.b.encode(joined)):
            if not self.measure(group, text, a, b):
                alone += group
        for piece, a, b in zip(alone, self.a.encode_long(alone), self.b.encode_long(alone)):
            if not self.measure([piece], piece, a, b):
                self.add([piece], np.zeros((1, len(VALUES)), np.int64), [np.empty(0, np.int64)], [None])
        self.look_up()

    def look_up(self) -> None:
        """The counts of the links of the pieces that were just added, all at once."""
        waiting, self.waiting = self.waiting, []
        if waiting:
            pairs, place = np.unique(np.concatenate([p for _, _, p in waiting]), return_inverse=True)
            counts = self.table.counts(pairs)
            best, start = (counts == self.table.peaks[pairs % self.width]).astype(np.int64), 0
            for first, stops, own in waiting:
                at = place[start : start + len(own)]
                start += len(own)
                for k, amount in ((5, best[at]), (6, counts[at])):
                    self.values[first : first + len(stops), k] = np.diff(np.cumsum(amount)[stops - 1], prepend=0)

    def measure(self, group: list[str], text: str, a: list[int], b: list[int]) -> bool:
        """Align a text of many pieces and part the result; False if the tokens don't give back its bytes piece by piece."""
        raw = text.encode("utf-8", "replace")
        if b"".join(map(self.b.tokens.__getitem__, b)) != raw or b"".join(map(self.a.tokens.__getitem__, a)) != raw:
            return False
        one, other = np.array(a, np.int64), np.array(b, np.int64)
        end_a, end_b = np.cumsum(self.a.sizes[one]), np.cumsum(self.b.sizes[other])
        in_a, in_b, ends, common = align(one, other, end_a, end_b)
        stops = np.cumsum([len(p.encode("utf-8", "replace")) for p in group])
        if not np.isin(stops, common).all():
            return False
        pairs = one[in_a] * self.width + other[in_b]
        values = np.zeros((len(group), len(VALUES)), np.int64)
        values[:, 0] = 1
        at = [np.searchsorted(e, stops, "right") for e in (end_a, end_b, common, ends)]
        for k, stop in enumerate(at, 1):
            values[:, k] = np.diff(stop, prepend=0)
        cuts = at[3].tolist()
        texts = [None] * len(group)
        if self.table is not None:
            self.waiting.append((len(self.names), at[3], pairs))
            s, t, parts, i, j = list(map(str, a)), list(map(str, b)), [], 0, 0
            for k, m in zip(np.searchsorted(end_a, common, "right").tolist(), np.searchsorted(end_b, common, "right").tolist()):
                parts.append(f"{s[i]}|{t[j]}" if k == i + 1 and m == j + 1 else ",".join(s[i:k]) + "|" + ",".join(t[j:m]))
                i, j = k, m
            ahead = at[2].tolist()
            texts = [";".join(parts[x:y]) for x, y in zip([0, *ahead], ahead)]
            pairs = pairs[:0]
        own = [pairs[x:y] for x, y in zip([0, *cuts], cuts)] if len(pairs) else [pairs] * len(group)
        self.add(group, values, own, texts)
        return True

    def of(self, texts: list[str | None]) -> tuple[list[np.ndarray], np.ndarray]:
        """The numbers of each text's pieces, and whether it has tokens."""
        pieces = [find_pieces(" " + t) if t else [] for t in texts]
        whole = [p for own in pieces for p in own]
        numbers = np.fromiter(map(self.known.get, whole, itertools.repeat(-1)), np.int64, len(whole))
        missing = np.flatnonzero(numbers < 0).tolist()
        if missing:
            self.learn(list(dict.fromkeys([whole[i] for i in missing])))
            numbers[missing] = [self.known[whole[i]] for i in missing]
        own = np.split(numbers, np.cumsum([len(p) for p in pieces])[:-1])
        return own, np.array([len(p) > 0 and bool(self.values[p, 0].all()) for p in own], bool)


@functools.lru_cache(maxsize=1)
def counting_pieces(path_a: str, path_b: str) -> Pieces:
    """One per worker process, so that its memory of pieces serves all partitions."""
    return Pieces(path_a, path_b)


def shard_of(pairs: np.ndarray) -> np.ndarray:
    return (mix64(pairs.astype(np.uint64)) >> np.uint64(40)).astype(np.int64) % SHARDS


def text_runs(batch: pa.RecordBatch):
    """Texts of a batch, some at a time."""
    column = batch.column("text")
    for k in range(0, batch.num_rows, TEXTS):
        yield k, column.slice(k, TEXTS).to_pylist()


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys, place = np.unique(keys, return_inverse=True)
    total = np.zeros(len(keys), np.int64)
    np.add.at(total, place, counts)
    return keys, total


def _count(path_a: str, path_b: str):
    def run(batches):
        pieces, held = counting_pieces(path_a, path_b), (np.empty(0, np.int64), np.empty(0, np.int64))
        uses = np.zeros(0, np.int64)  # of each piece, in texts that have tokens

        def with_pairs(held):
            used = np.flatnonzero(uses)
            own = [pieces.pairs[i] for i in used.tolist()]
            repeats = np.repeat(uses[used], [len(p) for p in own]) if own else np.empty(0, np.int64)
            return summed(np.concatenate([held[0], flat(own, np.int64)]), np.concatenate([held[1], repeats]))

        def rows(keys, counts):
            shard = shard_of(keys)
            order = np.argsort(shard, kind="stable")
            keys, counts, cuts = keys[order], counts[order], np.searchsorted(shard[order], np.arange(SHARDS + 1))
            used = np.flatnonzero(np.diff(cuts))
            return pa.RecordBatch.from_arrays([
                pa.array(used.astype(np.int32)),
                pa.array([keys[cuts[s] : cuts[s + 1]].tobytes() for s in used], pa.binary()),
                pa.array([counts[cuts[s] : cuts[s + 1]].tobytes() for s in used], pa.binary()),
            ], ["shard", "keys", "counts"])

        for batch in batches:
            for _, texts in text_runs(batch):
                numbers, right = pieces.of(texts)
                met = np.bincount(flat([p for p, ok in zip(numbers, right) if ok], np.int64), minlength=len(pieces.names))
                uses = np.concatenate([uses, np.zeros(len(met) - len(uses), np.int64)]) + met
                pieces.met[: len(met)] += met
                if pieces.full():
                    held, uses = with_pairs(held), np.zeros(0, np.int64)
                    pieces.forget()
                    if len(held[0]) > FLUSH_PAIRS:
                        yield rows(*held)
                        held = (np.empty(0, np.int64), np.empty(0, np.int64))
        held = with_pairs(held)
        if len(held[0]):
            yield rows(*held)

    return run


class PerfectHash:
    """A minimal perfect hash of distinct numbers: bit arrays, one a level, twice as long as the keys that are left."""

    def __init__(self, bits: list[np.ndarray]):
        self.bits = bits
        self.ranks, n = [], 0
        for level in bits:
            self.ranks.append(n + np.cumsum(level, dtype=np.int64) - level)
            n += int(level.sum())
        self.n = n

    @staticmethod
    def place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        seed = np.uint64(0x9E3779B97F4A7C15 * (level + 1) % 2**64)
        return (mix64(keys.astype(np.uint64) + seed) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        bits, left = [], keys
        while len(left):
            size = 2 * len(left) + 1
            at = cls.place(left, len(bits), size)
            alone = np.bincount(at, minlength=size) == 1
            bits.append(alone)
            left = left[~alone[at]]
        return cls(bits)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """A number from 0 to n - 1 for each key; for one that isn't in the set any of them, or -1."""
        out, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, (bits, ranks) in enumerate(zip(self.bits, self.ranks)):
            at = self.place(keys[left], level, len(bits))
            hit = bits[at]
            out[left[hit]] = ranks[at[hit]]
            left = left[~hit]
            if not len(left):
                break
        return out

    def dump(self) -> tuple[bytes, list[int]]:
        return b"".join(np.packbits(b).tobytes() for b in self.bits), [len(b) for b in self.bits]

    @classmethod
    def load(cls, packed: bytes, sizes: list[int]) -> PerfectHash:
        raw, start, bits = np.frombuffer(packed, np.uint8), 0, []
        for size in sizes:
            stop = start + (size + 7) // 8
            bits.append(np.unpackbits(raw[start:stop], count=size).astype(bool))
            start = stop
        return cls(bits)


def numbers(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.int64)


def _union(final: bool):
    """Distinct keys of the rows of a group; with ``final`` their minimal perfect hash too."""

    def run(group: pa.Table) -> pa.Table:
        keys = np.unique(flat([numbers(k) for k in group.column("keys").to_pylist()], np.int64))
        head = {"shard": pa.array([group.column("shard")[0].as_py()], pa.int32())}
        if not final:
            return pa.table(head | {"keys": pa.array([keys.tobytes()], pa.binary())})
        made = PerfectHash.build(keys)
        packed, sizes = made.dump()
        placed = np.empty_like(keys)
        placed[made(keys)] = keys
        return pa.table(head | {
            "packed": pa.array([packed], pa.binary()), "sizes": pa.array([sizes], pa.list_(pa.int64())), "placed": pa.array([placed.tobytes()], pa.binary()),
        })

    return run


def _vectors(group: pa.Table) -> pa.Table:
    """The dense count vector of a part over some tasks."""
    first = group.slice(0, 1).to_pylist()[0]
    index, placed = PerfectHash.load(first["packed"], first["sizes"]), numbers(first["placed"])
    total = np.zeros(len(placed), np.int64)
    for keys, counts in zip(group.column("keys").to_pylist(), group.column("counts").to_pylist()):
        at = index(numbers(keys))
        if not np.array_equal(placed[at], numbers(keys)):
            raise RuntimeError("a counted pair is missing from the hash")
        total[at] += numbers(counts)
    return pa.table({"shard": pa.array([first["shard"]], pa.int32()), "vector": pa.array([total.tobytes()], pa.binary())})


def _sum(group: pa.Table) -> pa.Table:
    total = functools.reduce(np.add, map(numbers, group.column("vector").to_pylist()))
    return pa.table({"shard": group.column("shard").slice(0, 1), "vector": pa.array([total.tobytes()], pa.binary())})


def _peaks(width: int):
    """The highest count of each id of B within each part."""

    def run(batches):
        for batch in batches:
            for placed, vector in zip(batch.column("placed").to_pylist(), batch.column("vector").to_pylist()):
                best = np.zeros(width, np.int64)
                np.maximum.at(best, numbers(placed) % width, numbers(vector))
                used = np.flatnonzero(best)
                yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(best[used])], ["b", "peak"])

    return run


class CountTable:
    """The parts' hashes, keys and counts, and the highest count of each id of B."""

    def __init__(self, rows: list[dict], peaks: np.ndarray):
        self.parts = {r["shard"]: (PerfectHash.load(r["packed"], r["sizes"]), numbers(r["placed"]), numbers(r["vector"])) for r in rows}
        self.peaks, self.name = peaks, uuid.uuid4().hex

    def counts(self, pairs: np.ndarray) -> np.ndarray:
        out, shard = np.zeros(len(pairs), np.int64), shard_of(pairs)
        order = np.argsort(shard, kind="stable")
        cuts = np.searchsorted(shard[order], np.arange(SHARDS + 1))
        for s in np.flatnonzero(np.diff(cuts)).tolist():
            if s in self.parts:
                index, placed, vector = self.parts[s]
                mine = order[cuts[s] : cuts[s + 1]]
                at = index(pairs[mine])
                there = (at >= 0) & (placed[at] == pairs[mine])
                out[mine[there]] = vector[at[there]]
        return out


RESULT = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def digest(texts: list[str]) -> str:
    return hashlib.sha256(";".join(texts).encode()).hexdigest()


def numbers_of(pieces: Pieces, texts: list[str | None]) -> list[tuple]:
    """The values of ``RESULT`` for each text."""
    own, right = pieces.of(texts)
    pieces.met[: len(pieces.names)] += np.bincount(flat(own, np.int64), minlength=len(pieces.names))
    return [
        (*pieces.values[p, 1:].sum(0).tolist(), digest(list(map(pieces.text.__getitem__, p.tolist())))) if ok else (0, 0, 0, 0, 0, 0, "")
        for p, ok in zip(own, right)
    ]


def _look_up(path_a: str, path_b: str, held, key: str):
    """The second pass with the whole table at hand."""

    def run(batches):
        pieces = looking_pieces(path_a, path_b, held.value)
        for batch in batches:
            rows = []
            for _, texts in text_runs(batch):
                rows += numbers_of(pieces, texts)
                if pieces.full():
                    pieces.forget()
            columns = list(zip(*rows)) if rows else [[]] * 7
            arrays = [pa.array(c, pa.string() if i == 6 else pa.int64()) for i, c in enumerate(columns)]
            yield pa.RecordBatch.from_arrays([batch.column(key), *arrays], [key, *VALUES[1:], "groups_sha256"])

    return run


_LOOKING: dict[str, Pieces] = {}


def looking_pieces(path_a: str, path_b: str, table: CountTable) -> Pieces:
    """The pieces of the worker process for one table of counts; those of another table are dropped."""
    if table.name not in _LOOKING:
        _LOOKING.clear()
        _LOOKING[table.name] = Pieces(path_a, path_b, table)
    return _LOOKING[table.name]


def _links_by_shard(path_a: str, path_b: str, key: str):
    """The second pass without the table: a text's own numbers once, and its pairs with their repeats by part."""

    def run(batches):
        counted = Pieces(path_a, path_b)
        named = Pieces(path_a, path_b, CountTable([], np.ones(counted.width, np.int64)))
        for batch in batches:
            ids, places, out = batch.column(key).to_pylist(), batch.column("_row").to_pylist(), []
            for k, texts in text_runs(batch):
                own, right = counted.of(texts)
                for i, (p, ok, values) in enumerate(zip(own, right, numbers_of(named, texts)), k):
                    out.append((ids[i], places[i], -1, None, None, *values[:4], values[6]))
                    if ok:
                        pairs, n = np.unique(flat([counted.pairs[x] for x in p.tolist()], np.int64), return_counts=True)
                        shard = shard_of(pairs)
                        for s in np.unique(shard).tolist():
                            mine = shard == s
                            out.append((ids[i], places[i], s, pairs[mine].tobytes(), n[mine].astype(np.int64).tobytes(), 0, 0, 0, 0, None))
                for pieces in (counted, named):
                    if pieces.full():
                        pieces.forget()
            kinds = [batch.column(key).type, pa.int64(), pa.int32(), pa.binary(), pa.binary(), *[pa.int64()] * 4, pa.string()]
            names = [key, "_row", "shard", "keys", "repeats", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), kinds)] if out else [pa.array([], t) for t in kinds], names)

    return run


def _summarise(peaks: np.ndarray, key: str):
    """Sums over the pairs of a text that are in one part."""

    def run(batches):
        last, own = None, None
        for batch in batches:
            best, total = [], []
            for r in batch.select(["shard", "keys", "repeats", "packed", "sizes", "placed", "vector"]).to_pylist():
                if r["shard"] != last:
                    last, own = r["shard"], CountTable([r], peaks)
                pairs, n = numbers(r["keys"]), numbers(r["repeats"])
                counts = own.counts(pairs)
                best.append(int(n[counts == peaks[pairs % len(peaks)]].sum()))
                total.append(int((n * counts).sum()))
            yield pa.RecordBatch.from_arrays([batch.column(key), batch.column("_row"), pa.array(best, pa.int64()), pa.array(total, pa.int64())], [key, "_row", "n_best", "count_sum"])

    return run


def pair_table(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Steps 1 to 3: a row a part, with its hash (``packed``, ``sizes``), keys and counts in the hash's order."""
    counted = kept_once(map_batches(docs.select("text"), _count(path_a, path_b), "shard int, keys binary, counts binary"))
    tasks = counted.groupBy("shard").count().agg(F.coalesce(F.max("count"), F.lit(1))).first()[0]
    # Groups of about the square root of the number of tasks, so that no task of either level reads more than that.
    branches = max(1, math.isqrt(tasks))
    branch = F.pmod(F.xxhash64("keys"), F.lit(branches)).cast("int").alias("branch")
    unions = counted.select("shard", branch, "keys").groupBy("shard", "branch").applyInArrow(_union(False), "shard int, keys binary")
    hashes = kept_once(unions.groupBy("shard").applyInArrow(_union(True), "shard int, packed binary, sizes array<bigint>, placed binary"))
    own = counted.select("shard", branch, "keys", "counts").join(hashes, "shard")
    vectors = own.groupBy("shard", "branch").applyInArrow(_vectors, "shard int, vector binary").groupBy("shard").applyInArrow(_sum, "shard int, vector binary")
    return kept_once(hashes.join(vectors, "shard"))


def id_peaks(parts: DataFrame, width: int) -> np.ndarray:
    """The highest count of each id of B: a number for each entry of its vocabulary."""
    out = np.zeros(width, np.int64)
    for r in map_batches(parts.select("placed", "vector"), _peaks(width), "b long, peak long").groupBy("b").agg(F.max("peak").alias("peak")).collect():
        out[r["b"]] = r["peak"]
    return out


def alignments(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", table_bytes: int = TABLE_BYTES) -> DataFrame:
    """``key`` and the alignment's numbers (``RESULT``) of every row of ``docs``."""
    spark = docs.sparkSession
    parts = pair_table(docs, path_a, path_b)
    peaks = id_peaks(parts, len(Bytewise(path_b).tokens))
    kind = docs.schema[key].dataType.simpleString()
    if measured_bytes(parts) <= table_bytes:
        held = spark.sparkContext.broadcast(CountTable([r.asDict() for r in parts.collect()], peaks))
        return map_batches(docs.select(key, "text"), _look_up(path_a, path_b, held, key), f"`{key}` {kind}, {RESULT}")
    numbered = kept_once(docs.select(key, "text", F.monotonically_increasing_id().alias("_row")))
    schema = f"`{key}` {kind}, _row long, shard int, keys binary, repeats binary, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
    rows = kept_once(map_batches(numbered, _links_by_shard(path_a, path_b, key), schema))
    own = salted_join(rows.where("shard >= 0").select(key, "_row", "shard", "keys", "repeats"), parts, ["shard"], "inner")
    summed = map_batches(own, _summarise(peaks, key), f"`{key}` {kind}, _row long, n_best long, count_sum long")
    totals = summed.groupBy("_row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    out = rows.where("shard < 0").join(totals, "_row", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return out.select(key, "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")


def op13_alignment(spark, sf_dir):
    """Alignment of the byte-level and the piece vocabulary over every document."""
    return alignments(table(spark, sf_dir, "documents"), public_path("byte_bpe_50k.json"), public_path("piece_bpe_32k.model"))
