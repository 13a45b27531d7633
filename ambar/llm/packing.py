"""Mixture-controlled packing: deficit round-robin over source queues into windows of a fixed number of tokens.

Every source is a queue of tokens, its documents one after the other. A window of ``window`` tokens gives each
queue a quantum in proportion to its target share (its share of all tokens, so that the queues empty together)
on top of the deficit that it carries from the windows before; whole tokens are served, the fraction is carried
on, and tokens still free go to the queues with the largest deficits. Documents are cut where a window ends for
their queue, so every window is full and keeps to the target within a token or two per source.

Windows are planned in blocks. What the queues have received, and so the deficits, at the start of a block
follows from the totals alone (the allotment of so many seats by the Sainte-Lague rule, which never takes a seat
back), so each task runs the round-robin only for the blocks that its documents fall in, and deficits carry
over from block to block and partition to partition without any task waiting for another. The last, partial window is
cut at powers of two, which need no padding.

Texts are encoded once and stored; documents are numbered within their queue by running sums per task and
totals per task and queue, so no queue is ever gathered in one place.

Defined results: a missing text has only the end token; a missing source is a queue of its own; repeated rows
are packed each; an empty table gives an empty result; other columns are ignored. Queues beyond
``MAX_QUEUES`` share the last one, so that the plan stays small; all their documents are packed.
"""

from __future__ import annotations

import functools
import zlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ambar.llm.common import kept_once, map_batches, table
from ambar.llm.tokens import encoder, public_path
from ambar.operators.joins import sized_join
from ambar.session import small_frame

WINDOW = 4096
END_ID = 2
BLOCK = 64  # windows planned together
MAX_QUEUES = 1024


def served(totals: tuple[int, ...], seats: int) -> list[int]:
    """Tokens that each queue has received when ``seats`` are given out, by the Sainte-Lague rule.

    Token j of a queue with t tokens is due at (2j + 1) / 2t; the ``seats`` earliest are served, ties by queue.
    """
    total = sum(totals)
    seats = min(seats, total)
    if not seats:
        return [0] * len(totals)
    out = [min(t, (2 * seats * t + total - 1) // (2 * total)) for t in totals]
    gap = seats - sum(out)
    while gap > 0:  # at most one step per queue
        q = min((q for q, t in enumerate(totals) if out[q] < t), key=lambda q: _Due(2 * out[q] + 1, totals[q], q))
        out[q] += 1
        gap -= 1
    while gap < 0:
        q = max((q for q in range(len(out)) if out[q] > 0), key=lambda q: _Due(2 * out[q] - 1, totals[q], q))
        out[q] -= 1
        gap += 1
    return out


@functools.total_ordering
class _Due:
    """A due time as an exact fraction."""

    def __init__(self, top: int, bottom: int, queue: int):
        self.top, self.bottom, self.queue = top, bottom, queue

    def __lt__(self, other: _Due) -> bool:
        a, b = self.top * other.bottom, other.top * self.bottom
        return a < b or a == b and self.queue < other.queue

    def __eq__(self, other) -> bool:
        return self.top * other.bottom == other.top * self.bottom and self.queue == other.queue


class Plan:
    """Which tokens of each queue go to which window."""

    def __init__(self, totals: list[int], window: int = WINDOW, block: int = BLOCK):
        self.totals, self.window, self.block = tuple(totals), window, block
        self.total = sum(totals)
        self.full = self.total // window
        self.tail = [0]  # where the sequences of the last, partial window start
        for bit in reversed(range(window.bit_length())):
            if (self.total % window) >> bit & 1:
                self.tail.append(self.tail[-1] + (1 << bit))
        self.blocks = functools.lru_cache(maxsize=512)(self._block)
        self.starts = functools.lru_cache(maxsize=2048)(lambda b: served(self.totals, b * block * window))

    def _block(self, b: int) -> tuple[list[list[int]], list[list[int]]]:
        """For each queue: its tokens served before each window of the block, and its offset within each window."""
        start, end = self.starts(b), self.starts(b + 1)
        got, room = list(start), [e - s for s, e in zip(start, end)]
        # Deficits in units of 1/total tokens, so that they are whole numbers.
        before = min(self.total, b * self.block * self.window)
        deficit = [before * t - s * self.total for t, s in zip(self.totals, start)]
        at, offset = [[s] for s in start], [[] for _ in start]
        for w in range(b * self.block, (b + 1) * self.block):
            size = min(self.window, self.total - w * self.window)
            if size <= 0:
                break
            left = min(size, sum(room))
            give = [0] * len(got)
            for q, share in enumerate(self.totals):
                deficit[q] += size * share
                give[q] = min(max(0, deficit[q] // self.total), room[q], left)
                left -= give[q]
            while left:
                for q in sorted((q for q in range(len(got)) if room[q] > give[q]), key=lambda q: (give[q] * self.total - deficit[q], q))[:left]:
                    give[q] += 1
                    left -= 1
            place = 0
            for q, n in enumerate(give):
                deficit[q] -= n * self.total
                room[q] -= n
                got[q] += n
                offset[q].append(place)
                at[q].append(got[q])
                place += n
        return at, offset

    def pieces(self, queue: int, first: int, length: int):
        """(start, length, sequence, offset) of the pieces of the tokens ``first`` to ``first + length`` of a queue."""
        done, size = 0, self.block * self.window
        b = first * self.total // max(1, self.totals[queue]) // size
        while b and self.starts(b)[queue] > first:
            b -= 1
        while done < length:
            while self.starts(b + 1)[queue] <= first + done:
                b += 1
            at, offset = self.blocks(b)
            at, offset = at[queue], offset[queue]
            w = bisect_right(at, first + done) - 1
            while w < len(offset) and done < length:
                n = min(at[w + 1], first + length) - (first + done)
                if n > 0:
                    place = offset[w] + first + done - at[w]
                    if b * self.block + w < self.full:
                        yield done, n, b * self.block + w, place
                    else:
                        yield from self._in_tail(done, n, place)
                    done += n
                w += 1

    def _in_tail(self, done: int, n: int, place: int):
        while n:
            k = bisect_right(self.tail, place) - 1
            take = min(n, self.tail[k + 1] - place)
            yield done, take, self.full + k, place - self.tail[k]
            done, n, place = done + take, n - take, place + take


def _encode(path: str, end_id: int):
    """Ids of each document with the end token, and its place among those of its source in this task."""

    def run(batches):
        enc, seen, part = encoder(path), {}, TaskContext.get().partitionId()
        for batch in batches:
            ids, at = enc.encode(pc.fill_null(batch.column("text"), ""))
            n, places = np.diff(at) + 1, []
            last = np.cumsum(n)  # behind each document's end token
            whole = np.full(last[-1] if len(last) else 0, end_id, ids.dtype)
            own = np.ones(len(whole), bool)
            own[last - 1] = False
            whole[own] = ids
            for source, size in zip(batch.column("queue").to_pylist(), n.tolist()):
                places.append(seen.get(source, 0))
                seen[source] = places[-1] + size
            starts = np.concatenate([[0], last]) * ids.itemsize
            stored = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(starts), pa.py_buffer(whole)])
            columns = [batch.column("doc_id"), batch.column("queue"), pa.repeat(part, len(n)), places, n, stored]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) if isinstance(c, (list, np.ndarray)) else c.cast(f.type) for c, f in zip(columns, ENCODED)], schema=ENCODED)

    return run


ENCODED = pa.schema([("doc_id", pa.int64()), ("queue", pa.string()), ("part", pa.int64()), ("place", pa.int64()), ("n", pa.int64()), ("ids", pa.binary())])
PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])


def _lay_out(totals: list[int], window: int, block: int, wide: bool, with_ids: bool):
    def run(batches):
        plan, kind = Plan(totals, window, block), np.dtype("<u4" if wide else "<u2")
        schema = PIECES.append(pa.field("ids", pa.list_(pa.int64()))) if with_ids else PIECES
        for batch in batches:
            out = {name: [] for name in schema.names}
            columns = [batch.column(c).to_pylist() for c in ("doc_id", "_queue", "_first", "n")]
            for doc, queue, first, n, ids in zip(*columns, batch.column("ids").to_pylist()):
                ids = np.frombuffer(ids, kind).astype("<u4")
                for start, length, sequence, offset in plan.pieces(queue, first, n):
                    part = ids[start : start + length]
                    row = [doc, start, length, zlib.crc32(part), n, sequence, offset]
                    for name, value in zip(schema.names, [*row, part.tolist()] if with_ids else row):
                        out[name].append(value)
            yield pa.RecordBatch.from_pydict(out, schema=schema)

    return run


def pack(
    df: DataFrame, path: str, source: str = "source", window: int = WINDOW, end_id: int = END_ID, block: int = BLOCK, with_ids: bool = False
) -> DataFrame:
    """One row per piece of a document: where it starts in the document, its length, and its sequence and offset there."""
    rows = df.select(F.col("doc_id").cast("long"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("queue"), "text")
    encoded = kept_once(map_batches(rows, _encode(path, end_id), "doc_id long, queue string, part long, place long, n long, ids binary"), compression="zstd")

    # Tokens per task and queue: a few rows per task, whatever the number of documents.
    per_task = encoded.groupBy("queue", "part").agg(F.sum("n").alias("n"))
    largest = per_task.groupBy("queue").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "queue").limit(MAX_QUEUES - 1).collect()
    names = sorted(r["queue"] for r in largest)
    number = small_frame(df.sparkSession, [(q, i) for i, q in enumerate(names)], T.StructType([T.StructField("queue", T.StringType()), T.StructField("_queue", T.IntegerType())]))
    before = Window.partitionBy("_queue").orderBy("part", "queue").rowsBetween(Window.unboundedPreceding, -1)
    starts = kept_once(
        per_task.join(F.broadcast(number), "queue", "left")
        .withColumn("_queue", F.coalesce("_queue", F.lit(len(names))))
        .withColumn("_before", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .select("queue", "part", "_queue", "_before", "n")
    )
    totals = dict(starts.groupBy("_queue").agg(F.sum("n")).collect())
    totals = [totals.get(q, 0) for q in range(len(names) + 1)]

    placed = sized_join(encoded, starts.drop("n"), ["queue", "part"], "inner")
    placed = placed.select("doc_id", "_queue", (F.col("_before") + F.col("place")).alias("_first"), "n", "ids")
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return map_batches(placed, _lay_out(totals, window, block, encoder(path).wide, with_ids), schema + (", ids array<long>" if with_ids else ""))


def op8_packing(spark, sf_dir):
    """All documents in sequences of 4,096 tokens."""
    return pack(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), public_path("word_bpe_49k.json"))
