"""Packing token ids into windows by Karmarkar-Karp multiway differencing.

A document is its token ids and an end id.  Every full ``capacity`` of a long
document is a window of its own; what remains is cut into pieces and the
pieces of a block (``windows`` windows' worth) are shared out by multiway
differencing: each piece starts as a partial partition of one filled and k-1
empty slots; the two partitions with the largest imbalance are merged, the
fullest slot of one with the emptiest of the other, until one is left.  The
slots are then near-equal windows.  If one exceeds the capacity the window
count of the block rises by one and the block is shared out again.  A block
aims at ``slack`` tokens below capacity a window, so that this is rare.

Each task packs what its partition holds, block by block, in bounded memory;
nothing is shuffled.  ``sequence_id`` is the partition's number and a counter.

Null text counts as empty (its end id alone is packed); null and repeated
doc_ids are kept as they are, every row is a document; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import release_memory, slices, take
from .tokens import CACHE_CHUNKS, encoder, tokenizer_path

CAPACITY = 2048
END_ID = 1
WINDOWS = 128     # windows in a block
MAX_PIECE = 256   # a remainder is cut into pieces of at most this many ids
SLICE = 1 << 18   # bytes of text encoded at once
SLACK = 8         # ids a window that a block leaves free, for uneven slots

SCHEMA = ("doc_id long, start long, length long, ids binary, doc_tokens long, "
          "sequence_id long, offset long")
_ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                    ("ids", pa.binary()), ("doc_tokens", pa.int64()),
                    ("sequence_id", pa.int64()), ("offset", pa.int64())])


def difference(sizes: list[int], k: int) -> list[list[int]]:
    """Multiway differencing: the members (indexes of ``sizes``) of k slots."""
    if k == 1:
        return [list(range(len(sizes)))]
    # A partition lists its filled slots, fullest first, as (sum, members);
    # members are nested pairs, so a merge never copies them.
    heap = [(-s, i, [(s, i)]) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    n = len(sizes)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        free = k - len(a)  # empty slots of a take the fullest of b
        merged = a + b[:free]
        if len(b) > free:
            rest = b[free:]
            at = len(a) - len(rest)
            merged[at:len(a)] = [(x[0] + y[0], (x[1], y[1]))
                                 for x, y in zip(a[at:], reversed(rest))]
        merged.sort(key=itemgetter(0), reverse=True)
        low = merged[-1][0] if len(merged) == k else 0
        heapq.heappush(heap, (low - merged[0][0], n, merged))
        n += 1
    return [_members(tree) for _, tree in heap[0][2]] if heap else []


def _members(tree) -> list[int]:
    out, stack = [], [tree]
    while stack:
        x = stack.pop()
        if isinstance(x, tuple):
            stack += x
        else:
            out.append(x)
    return sorted(out)


def share_out(sizes: list[int], capacity: int) -> list[list[int]]:
    """Windows of at most ``capacity``; the count rises until all hold."""
    k = max(1, -(-sum(sizes) // capacity))
    while True:
        slots = difference(sizes, k)
        if all(sum(sizes[i] for i in s) <= capacity for s in slots):
            return slots
        k += 1


class Packer:
    """Collects pieces and gives back packed rows whenever a block is full."""

    def __init__(self, partition: int, capacity: int, windows: int, max_piece: int, slack: int):
        self.capacity, self.max_piece = capacity, max_piece
        self.room = windows * (capacity - slack)
        self.sequence = partition << 40
        self.block: list[tuple] = []  # (doc_id, start, ids, doc_tokens)
        self.held = 0
        self.rows: list[tuple] = []

    def _emit(self, window: list[tuple]) -> None:
        at = 0
        for doc, start, ids, total in window:
            self.rows.append((doc, start, len(ids), ids.tobytes(), total, self.sequence, at))
            at += len(ids)
        self.sequence += 1

    def add(self, doc, ids: np.ndarray) -> None:
        total = len(ids)
        whole = total - total % self.capacity
        for start in range(0, whole, self.capacity):
            self._emit([(doc, start, ids[start:start + self.capacity], total)])
        start = whole
        while start < total:
            size = min(self.max_piece, total - start, self.room - self.held)
            self.block.append((doc, start, ids[start:start + size], total))
            self.held += size
            start += size
            if self.held == self.room:
                self.close()

    def close(self) -> None:
        if self.block:
            for slot in share_out([len(p[2]) for p in self.block], self.capacity):
                self._emit([self.block[i] for i in slot])
        self.block, self.held = [], 0

    def drain(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY,
         end_id: int = END_ID, windows: int = WINDOWS, max_piece: int = MAX_PIECE,
         slack: int = SLACK, chunks: int = CACHE_CHUNKS) -> DataFrame:
    """One row per packed piece: doc_id, start and length in the document's
    ids, the ids (little-endian unsigned 32-bit), the document's id count,
    sequence_id and the offset in that sequence.  ``chunks`` is how many distinct
    chunks a worker remembers: memory against CPU seconds, the same rows."""
    if not 0 <= slack < capacity or max_piece < 1 or windows < 1:
        raise ValueError("slack must be below capacity; max_piece and windows at least 1")
    path = tokenizer or tokenizer_path()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        packer = Packer(TaskContext.get().partitionId(), capacity, windows, max_piece, slack)
        end = np.array([end_id], np.uint32)
        for batch in batches:
            for part in slices(batch, limit=SLICE):
                texts = part.column("text").to_pylist()
                flat, at = encoder(path, chunks).encode(texts)
                for i, doc in enumerate(part.column("doc_id").to_pylist()):
                    packer.add(doc, np.concatenate([flat[at[i]:at[i + 1]], end]))
                if packer.rows:
                    yield packer.drain()
        packer.close()
        if packer.rows:
            yield packer.drain()
        release_memory()

    return take(docs, "doc_id", "text").mapInArrow(task, SCHEMA)
