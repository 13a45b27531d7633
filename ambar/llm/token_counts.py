"""Token counts of whole texts, with huge texts cut into overlapping chunks and spliced where the cuts can't matter.

Texts up to ``chunk_chars`` are encoded as they are. A longer one is cut at nominal places; its chunks, each
with a margin of text on both sides, are dealt out over the cluster. Around a nominal cut two overlapping
stretches are encoded with offsets: one that starts well before the cut and one that starts inside the overlap.
Their tokens are compared, and the splice is put at a boundary that both have in common, with the same tokens
before and after it, and at which encoding the two sides apart gives the tokens of the whole stretch. If there
is none, the overlap is doubled, up to the margin. Both neighbours of a cut see the same stretch and so choose
the same splice. A text with a cut that even the margin can't align is encoded whole.

Defined results: a missing text is empty and has 0 tokens; repeated rows are counted apart; a missing doc_id is
kept; an empty table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ambar.llm.common import map_batches, table, texts
from ambar.llm.tokens import Encoder, encoder, public_path

CHUNK_CHARS = 65_536
MARGIN_CHARS = 8_192
OVERLAP_CHARS = 512
AGREE = 4  # tokens that must agree on each side of a splice
TOKEN_LIMIT = 2048


def splice(enc: Encoder, text: str, cut: int, overlap: int = OVERLAP_CHARS, margin: int = MARGIN_CHARS) -> int | None:
    """A place near ``cut`` at which ``text`` can be encoded in two parts, or None.

    Only ``text[cut - margin : cut + margin]`` is looked at.
    """
    low, high = max(0, cut - margin), min(len(text), cut + margin)
    while True:
        at = _common_boundary(enc, text[low:high], cut - low, overlap)
        if at is not None:
            return low + at
        if overlap >= margin:
            return None
        overlap = min(2 * overlap, margin)


def _common_boundary(enc: Encoder, stretch: str, cut: int, overlap: int) -> int | None:
    start, end = max(0, cut - overlap), min(len(stretch), cut + overlap)
    before_from, after_to = max(0, start - overlap), min(len(stretch), end + overlap)
    left = [t for t in enc.tokens(stretch[before_from:end])]
    left = [(a + before_from, b + before_from, i) for a, b, i in left]
    right = [(a + start, b + start, i) for a, b, i in enc.tokens(stretch[start:after_to])]
    place = {t: k for k, t in enumerate(right)}
    found = []
    for k in range(AGREE, len(left) - AGREE):
        r = place.get(left[k])
        if r is None or r < AGREE or right[r - AGREE : r + AGREE] != left[k - AGREE : k + AGREE]:
            continue
        # A token that starts after white space: no merge reaches over it.
        at, last = left[k][0], left[k - 1][1]
        if stretch[at : at + 1].isspace() or (last < at and stretch[last:at].isspace()):
            found.append((abs(at - cut), at))
    whole = None
    for _, at in sorted(found):
        if whole is None:
            whole = [i for _, _, i in enc.tokens(stretch[before_from:after_to])]
        apart = [i for part in (stretch[before_from:at], stretch[at:after_to]) for _, _, i in enc.tokens(part)]
        if apart == whole:
            return at
    return None


def count_spliced(enc: Encoder, text: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS, margin: int = MARGIN_CHARS) -> int:
    """Tokens of one text by the same splices that the distributed count uses."""
    if len(text) <= chunk:
        return enc.count(text)
    places = [splice(enc, text, cut, overlap, margin) for cut in range(chunk, len(text), chunk)]
    if None in places:
        return enc.count(text)
    edges = [0, *places, len(text)]
    return sum(enc.count(text[a:b]) for a, b in zip(edges[:-1], edges[1:]))


def _count_whole(path: str):
    def run(batches):
        enc = encoder(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), pa.array(enc.counts(texts(batch)), pa.int64())], ["_row", "n_tokens"]
            )

    return run


def _cut(chunk: int, margin: int):
    """One row per chunk: its text with margins, where in it the chunk starts and ends, and whether it is an edge of the text."""

    def run(batches):
        for batch in batches:
            for row, text in zip(batch.column("_row").to_pylist(), texts(batch)):
                for start in range(0, len(text), chunk):
                    low, end = max(0, start - margin), min(len(text), start + chunk)
                    yield pa.RecordBatch.from_pylist(
                        [{"_row": row, "_chunk": start // chunk, "text": text[low : end + margin], "_from": start - low, "_to": end - low, "_last": end == len(text)}],
                        schema=CHUNKS,
                    )

    return run


CHUNKS = pa.schema([("_row", pa.int64()), ("_chunk", pa.int64()), ("text", pa.string()), ("_from", pa.int64()), ("_to", pa.int64()), ("_last", pa.bool_())])


def _count_chunks(path: str, overlap: int, margin: int):
    def run(batches):
        enc = encoder(path)
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                text, a, b = row["text"], row["_from"], row["_to"]
                # A later chunk starts at the splice near its nominal start, which the chunk before ends at.
                first = 0 if row["_chunk"] == 0 else splice(enc, text, a, overlap, margin)
                last = len(text) if row["_last"] else splice(enc, text, b, overlap, margin)
                known = first is not None and last is not None
                out.append((row["_row"], enc.count(text[first:last]) if known else None))
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], pa.int64()) for i in (0, 1)], ["_row", "n_tokens"])

    return run


def count_tokens(
    df: DataFrame, path: str, keep: list[str], text: str = "text",
    chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS, margin_chars: int = MARGIN_CHARS,
) -> DataFrame:
    """``keep`` and ``n_tokens`` of every row. ``margin_chars`` is at most half of ``chunk_chars``.

    Short texts stay where they are; only chunks of huge ones are shuffled.
    """
    if 2 * margin_chars > chunk_chars:
        raise ValueError("the margins of a chunk must not meet")
    # The row's number stays the same wherever the scan of these files is repeated.
    rows = df.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("_row", F.monotonically_increasing_id())
    short, huge = F.char_length("text") <= chunk_chars, F.char_length("text") > chunk_chars
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema.fields)

    def with_columns(batches):
        enc = encoder(path)
        for batch in batches:
            counts = pa.array(enc.counts(texts(batch)), pa.int64())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], counts], [*keep, "n_tokens"])

    near = map_batches(rows.where(short).select(*keep, "text"), with_columns, f"{fields}, n_tokens long")

    long_rows = rows.where(huge)
    chunks = map_batches(long_rows.select("_row", "text"), _cut(chunk_chars, margin_chars), "_row long, _chunk long, text string, _from long, _to long, _last boolean")
    dealt = chunks.repartition("_row", "_chunk")
    counted = map_batches(dealt, _count_chunks(path, overlap_chars, margin_chars), "_row long, n_tokens long")
    spliced = counted.groupBy("_row").agg(F.sum("n_tokens").alias("n_tokens"), F.bool_and(F.col("n_tokens").isNotNull()).alias("_known"))
    far = long_rows.drop("text").join(spliced.where("_known"), "_row").select(*keep, "n_tokens")
    # Texts with a cut that could not be aligned, such as one endless word.
    unknown = long_rows.join(spliced.where("not _known").select("_row"), "_row", "left_semi")
    rest = map_batches(unknown.select("_row", "text"), _count_whole(path), "_row long, n_tokens long")
    rest = long_rows.drop("text").join(rest, "_row").select(*keep, "n_tokens")
    return near.unionByName(far).unionByName(rest)


def op4_token_counts(spark, sf_dir):
    """Tokens of every document by the 49k word tokenizer."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    out = count_tokens(docs, public_path("word_bpe_49k.json"), ["doc_id", "n_bytes"])
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))
