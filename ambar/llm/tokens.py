"""Public tokenizers in Python workers: ids word by word where that is proven equal, and offsets."""

from __future__ import annotations

import functools
import itertools
import json
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Words that a worker remembers, about 0.2 KB each.
KNOWN_WORDS = 1_000_000
TOGETHER = 64
RANKED = 65536  # words that are encoded by ranks at once

# The normaliser and the pattern of the vocabularies whose words are encoded by ranks.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Letters that normalisation doesn't join and whose lower case is one letter.
LETTERS = "A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u012F\u0131-\u017F\u0410-\u044F"
CUTS = rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^\s0-9{LETTERS}]+"  # PATTERN over plain words

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def drops_spaces(spec: dict) -> bool:
    """Whether the tokenizer cuts at every white space and keeps none of it.

    Then no token, merge or normalisation reaches over a space of a text, and the ids of a text are those of
    its words one after the other. True for a pre-tokenizer that first removes what its pattern, which has no
    white space, leaves out.
    """
    pre = spec.get("pre_tokenizer") or {}
    first = (pre.get("pretokenizers") or [pre])[0]
    pattern = (first.get("pattern") or {}).get("Regex", "")
    added = all(not any(c.isspace() for c in t["content"]) and not (t["lstrip"] or t["rstrip"]) for t in spec.get("added_tokens", []))
    plain = pattern.replace(r"[^\s", "")  # the one place where the pattern may name white space: to leave it out
    return first.get("type") == "Split" and first.get("behavior") == "Removed" and bool(first.get("invert")) and r"\s" not in plain and " " not in plain and added


def byte_values() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones are themselves, all others
    follow from U+0100 on, in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


class Ranked:
    """Ids of plain words of a vocabulary of lower-case words, encoded by the ranks of their tokens' bytes.

    The mark of a token that ends a word is a space, which no word has. Its merges with single bytes rank first, so they
    come first. Ranks merge two neighbours whatever pair the file names for the result. That gives the same ids where
    each token's own characters merge to that token: then no other pair with the same characters ever stands there.
    """

    def __init__(self, names: list[str], vocab: dict[str, int], mark: str, first: str):
        import tiktoken

        value = byte_values()
        ranks = {bytes(value[c] for c in n.removesuffix(mark)) + b" " * n.endswith(mark): k for k, n in enumerate(names)}
        self.apart = ranks[b"\n"]
        self.ids = np.array([vocab[n] for n in names], np.int64)
        self.ranks = tiktoken.Encoding("words", pat_str=r"[^ \n]+ |\n", mergeable_ranks=ranks, special_tokens={})
        # Words with the first character of an added token may hold one; long ones are the library's.
        signs = "".join(re.escape(chr(c)) for c in range(0x21, 0x7F) if not chr(c).isalpha() and chr(c) not in first)
        self.plain = f"^[{signs}{LETTERS}]{{1,200}}$"

    @staticmethod
    def of(spec: dict) -> Ranked | None:
        """None unless the file is such a vocabulary, and ranks are proven to give its ids."""
        from tokenizers import models

        pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
        pres, mark = pre.get("pretokenizers") or [], model.get("end_of_word_suffix")
        form = (
            (spec.get("normalizer") or {}).get("normalizers") == NORMALIZERS
            and [x["type"] for x in pres] == ["Split", "ByteLevel"]
            and pres[0]["pattern"] == {"Regex": PATTERN} and pres[0]["behavior"] == "Removed" and pres[0]["invert"]
            and not pres[1]["add_prefix_space"] and not pres[1]["use_regex"]
            and model["type"] == "BPE" and mark and not any(model.get(x) for x in ("dropout", "continuing_subword_prefix", "ignore_merges"))
        )
        first = "".join(t["content"][0] for t in spec.get("added_tokens", []))
        if not form or any(c.isalpha() or c.isdigit() for c in first):
            return None
        value, merges = byte_values(), [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        names = [c + mark for c in value] + [*value] + [a + b for a, b in merges]
        known, spaced = set(names), any("\u0120" in n for n in names[512:])  # a space's character
        if len(known) < len(names) or not known <= set(model["vocab"]) or not known.issuperset(itertools.chain(*merges)) or spaced:
            return None
        # The same merges by the library, each last character with its mark as one character.
        one = lambda n: n.removesuffix(mark)[:-1] + chr(ord(n.removesuffix(mark)[-1]) + 0x1000) if n.endswith(mark) else n
        whole = models.BPE({one(n): k for k, n in enumerate(names)}, [(one(a), one(b)) for a, b in merges])
        return Ranked(names, model["vocab"], mark, first) if all(len(whole.tokenize(one(n))) == 1 for n in names) else None

    def encode(self, words: pa.Array, kind: np.dtype) -> pa.Array:
        """The ids of each plain word, as bytes."""
        ids, sizes = [np.zeros(0, kind)], [np.zeros(1, np.int64)]
        for k in range(0, len(words), RANKED):
            lower = pc.utf8_lower(words.slice(k, RANKED).cast(pa.string()))
            joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(lower)], pa.int32()), lower), "\n")
            cut = pc.replace_substring_regex(joined, CUTS, r"\0 ")[0].as_py()
            found = np.array(self.ranks.encode_ordinary(cut + "\n"), np.int64)
            ends = np.flatnonzero(found == self.apart)
            ids.append(self.ids[found[found != self.apart]].astype(kind))
            sizes.append(np.diff(ends, prepend=-1) - 1)
        at = np.cumsum(np.concatenate(sizes)) * kind.itemsize
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(words), [None, pa.py_buffer(at), pa.py_buffer(np.concatenate(ids))])


class Encoder:
    """``ids`` and ``boundaries`` of texts by the library of the tokenizer's file."""

    def __init__(self, path: str):
        self.path = path
        if path.endswith(".json"):
            from tokenizers import Tokenizer

            self.tokenizer = Tokenizer.from_file(path)
            self.tokenizer.no_truncation()
            self.tokenizer.no_padding()
            with open(path, encoding="utf-8") as file:
                spec = json.load(file)
            self.by_word = drops_spaces(spec)
        elif path.endswith(".model"):
            from sentencepiece import SentencePieceProcessor

            self.tokenizer = SentencePieceProcessor(model_file=path)
            self.by_word = False
        else:
            raise ValueError(f"no library for {path}")
        self.known: dict[str, bytes] = {}
        self.wide = self.size() > 65536
        self.ranked = Ranked.of(spec) if self.by_word else None

    def size(self) -> int:
        return self.tokenizer.get_vocab_size() if self.path.endswith(".json") else self.tokenizer.get_piece_size()

    def _learn(self, new: list[str]) -> None:
        """Remember the ids of new words. They are encoded many in one text, which costs far less than one by one,
        and told apart by the tokens' offsets."""
        for k in range(0, len(new), TOGETHER):
            group = new[k : k + TOGETHER]
            found = self.tokenizer.encode(" ".join(group), add_special_tokens=False)
            starts = np.cumsum([0, *[len(w) + 1 for w in group]])
            at = np.searchsorted(np.array([a for a, _ in found.offsets], np.int64), starts) * (4 if self.wide else 2)
            at = at.tolist()
            self.known.update(zip(group, map(self.pack(found.ids).__getitem__, map(slice, at, at[1:]))))

    def pack(self, ids) -> bytes:
        return np.asarray(ids, dtype="<u4" if self.wide else "<u2").tobytes()

    def _of_words(self, words: pa.Array, kind: np.dtype) -> pa.Array:
        """The ids of each of some distinct words, as bytes: of plain ones by ranks where that is proven, else remembered."""
        plain = pc.match_substring_regex(words, self.ranked.plain) if self.ranked else pa.repeat(False, len(words))
        other = words.filter(pc.invert(plain)).to_pylist()
        new = [w for w in other if w not in self.known]
        if len(self.known) + len(new) > KNOWN_WORDS:
            self.known.clear()
            new = other
        self._learn(new)
        found = pa.array(map(self.known.__getitem__, other), pa.large_binary(), size=len(other))
        if len(other) == len(words):
            return found
        ranked = self.ranked.encode(words.filter(plain), kind)
        if not other:
            return ranked
        plain = plain.to_numpy(zero_copy_only=False)
        return pa.concat_arrays([ranked, found]).take(pa.array(np.where(plain, np.cumsum(plain) - 1, len(ranked) + np.cumsum(~plain) - 1)))

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts of a column without nulls, one after the other, and where each text's begin, with their end."""
        kind = np.dtype("<u4" if self.wide else "<u2")
        if not self.by_word:
            if self.path.endswith(".json"):
                each = [self.pack(self.tokenizer.encode(text, add_special_tokens=False).ids) for text in column.to_pylist()]
            else:
                each = [self.pack(self.tokenizer.encode(text, num_threads=1)) for text in column.to_pylist()]
            return np.frombuffer(b"".join(each), kind), np.cumsum([0, *map(len, each)]) // kind.itemsize
        # Arrow cuts at the characters between words, and tells which words are equal: each is encoded once a batch.
        words = pc.ascii_split_whitespace(column)
        coded = words.values.dictionary_encode()
        found = self._of_words(coded.dictionary, kind).take(coded.indices)
        _, ends, ids = found.buffers()
        at = np.frombuffer(ends, np.int64)[words.offsets.to_numpy()] if len(found) else np.zeros(len(column) + 1, np.int64)
        return np.frombuffer(ids or b"", kind, at[-1] // kind.itemsize), at // kind.itemsize

    def ids_of(self, whole: list[str]) -> list[bytes]:
        """The ids of each whole text, as little-endian numbers of 2 bytes (4 for a vocabulary over 65,536)."""
        ids, at = self.encode(pa.array(whole, pa.large_string()))
        return [ids[a:b].tobytes() for a, b in zip(at.tolist(), at[1:].tolist())]

    def counts(self, whole: list[str]) -> list[int]:
        return np.diff(self.encode(pa.array(whole, pa.large_string()))[1]).tolist()

    def count(self, text: str) -> int:
        return self.counts([text])[0]

    def tokens(self, text: str) -> list[tuple[int, int, int]]:
        """(start, end, id) of each token, in characters of ``text``."""
        if self.path.endswith(".json"):
            found = self.tokenizer.encode(text, add_special_tokens=False)
            return [(a, b, i) for (a, b), i in zip(found.offsets, found.ids)]
        found = self.tokenizer.encode(text, out_type="immutable_proto")
        return [(p.begin, p.end, p.id) for p in found.pieces]


@functools.lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One per worker process, so that its memory of words serves all batches."""
    return Encoder(path)
