"""Benchmark decontamination: a broadcast set of test n-grams, scanned for.

Words are runs of ASCII letters and digits and of characters above \\x7F, A-Z
lower-cased.  Every run of ``n`` consecutive words of a benchmark item is a
window; an item of fewer words, but not none, is one window.  A document word
inside any occurrence of a window is hit.

The windows of the items, as hashes, are broadcast; the documents' windows
are hashed a slice at a time and looked up, and every hash that is found is
verified word by word against the item.  What is broadcast is measured first:
items with more than ``max_words`` words in all are taken in blocks of at most
about that many, one scan of the documents per block over a written table
that carries the hits so far; the result is the same.

``scan`` returns the input's columns and a struct ``hits``: n_words, n_hit,
items (ids as strings, sorted), spans (start and end of each run of hit words
in code points).  ``clean_documents`` keeps documents without a hit;
``remove_spans`` cuts the hit runs out of the texts instead.

Null text has no words.  Items without text or words have no windows; items
without an id hit words but are not listed; items with equal ids are listed
once.  An empty benchmark leaves all documents clean; an empty table gives no
rows.  A column already named ``hits`` keeps its name, and the new one gets an
underscore more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import (
    ALNUM, flat, free_name, gram_hashes, named_again, plain_names, slices, take, word_hashes,
    word_spans, written,
)

N = 10
MAX_WORDS = 1 << 20  # words of items in one broadcast (about 50 MB as windows)

_HITS = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())),
                   ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])
HITS = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("spans", T.ArrayType(T.StructType([
        T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])))])
_FILTER_BITS = 20


def _words(data: np.ndarray, start, end) -> list[bytes]:
    raw = data.tobytes().lower()  # bytes: A-Z only
    return [raw[a:b] for a, b in zip(start.tolist(), end.tolist())]


class Windows:
    """The windows of some items: for each length the sorted hashes and, for
    each hash, the (item, place) pairs behind it."""

    def __init__(self, items: list[tuple[str | None, str]], n: int):
        self.ids = [i for i, _ in items]
        self.words: list[list[bytes]] = []
        found: dict[int, list[tuple[np.ndarray, int]]] = {}
        for at, (_, text) in enumerate(items):
            data, off = flat(pa.array([text], pa.string()))
            start, end, _ = word_spans(data, off, ALNUM)
            self.words.append(_words(data, start, end))
            size = min(n, len(start))
            if size:
                found.setdefault(size, []).append(
                    (gram_hashes(word_hashes(data, start, end), size), at))
        self.tables = {}
        for size, grams in found.items():
            h = np.concatenate([g for g, _ in grams])
            item = np.concatenate([np.full(len(g), at) for g, at in grams])
            place = np.concatenate([np.arange(len(g)) for g, _ in grams])
            order = np.argsort(h, kind="stable")
            h, item, place = h[order], item[order], place[order]
            present = np.zeros(1 << _FILTER_BITS, bool)
            present[(h >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
            self.tables[size] = (h, item, place, present)

    def occurrences(self, words: np.ndarray, row: np.ndarray, text: list[bytes] | None, make
                    ) -> Iterator[tuple[int, int, set[int]]]:
        """(first word, size, items) of each verified occurrence."""
        for size, (h, item, place, present) in self.tables.items():
            grams = gram_hashes(words, size)
            maybe = np.flatnonzero(present[(grams >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
            maybe = maybe[row[maybe] == row[maybe + size - 1]]
            low = np.searchsorted(h, grams[maybe], "left")
            high = np.searchsorted(h, grams[maybe], "right")
            sure = high > low
            for w, a, b in zip(maybe[sure].tolist(), low[sure].tolist(), high[sure].tolist()):
                if text is None:
                    text = make()
                here = text[w:w + size]
                items = {int(item[k]) for k in range(a, b)
                         if self.words[item[k]][place[k]:place[k] + size] == here}
                if items:
                    yield w, size, items


def _runs(hit: np.ndarray) -> list[tuple[int, int]]:
    """[first, last] of each run of True."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), (edge[1::2] - 1).tolist()))


def _scan_slice(part: pa.RecordBatch, at: int, windows: Windows, before: pa.Array | None) -> list:
    data, off = flat(part.column(at))
    start, end, row = word_spans(data, off, ALNUM)
    hashes = word_hashes(data, start, end)
    hit = np.zeros(len(start), bool)
    items: dict[int, set[str]] = {}
    for w, size, which in windows.occurrences(hashes, row, None, lambda: _words(data, start, end)):
        hit[w:w + size] = True
        items.setdefault(int(row[w]), set()).update(
            windows.ids[i] for i in which if windows.ids[i] is not None)
    edge = np.searchsorted(row, np.arange(part.num_rows + 1))
    counts = np.add.reduceat(np.append(hit, False).astype(np.int64), edge[:-1]) if len(start) \
        else np.zeros(part.num_rows, np.int64)
    out = []
    for r in range(part.num_rows):
        a, b = int(edge[r]), int(edge[r + 1])
        own = hit[a:b]
        known = before[r].as_py() if before is not None else None
        any_hit = b > a and counts[r] > 0
        if not any_hit and not (known and known["n_hit"]):
            out.append((b - a, 0, [], []))
            continue
        raw = data[off[r]:off[r + 1]]
        chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])  # code points before a byte
        first, last = chars[start[a:b] - off[r]], chars[end[a:b] - off[r]]
        own = own.copy()
        names = items.get(r, set())
        if known:
            names = names | set(known["items"])
            for s in known["spans"]:
                own |= (first >= s["start"]) & (last <= s["end"])
        spans = [{"start": int(first[x]), "end": int(last[y])} for x, y in _runs(own)]
        out.append((b - a, int(own.sum()), sorted(names), spans))
    return out


def _scan_once(docs: DataFrame, items: list[tuple], n: int, column: str, seen: bool) -> DataFrame:
    names = [c for c in docs.columns if not (seen and c == column)]
    at = names.index("text")
    shared = docs.sparkSession.sparkContext.broadcast(Windows(items, n))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Columns by place: two may have equal names but for the case.
            plain = batch.rename_columns([f"c{i}" for i in range(batch.num_columns)])
            for part in slices(plain, f"c{at}"):
                before = part.column(len(names)) if seen else None
                rows = _scan_slice(part, at, shared.value, before)
                found = pa.array([dict(zip(("n_words", "n_hit", "items", "spans"), r))
                                  for r in rows], _HITS)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i in range(len(names))), found],
                    names=[*names, column])

    schema = docs.schema if seen else T.StructType([*docs.schema, T.StructField(column, HITS)])
    return docs.mapInArrow(task, schema)


def scan(docs: DataFrame, benchmark: DataFrame, n: int = N, max_words: int = MAX_WORDS
         ) -> DataFrame:
    """``docs`` with the struct ``hits`` (see the module's text)."""
    docs, old = plain_names(docs, "text")
    column = free_name(docs, "hits", old)
    items = take(benchmark, "item_id", "text").select(
        F.col("item_id").cast("string").alias("item_id"), "text").where(F.col("text").isNotNull())
    # A word and what ends it take two bytes at least.
    total = items.agg(F.sum(F.octet_length("text") / 2 + 1)).first()[0] or 0
    blocks = max(1, int(-(-total // max_words)))
    if blocks == 1:
        return named_again(
            _scan_once(docs, [tuple(r) for r in items.collect()], n, column, False), old)
    items = written(items.withColumn(
        "block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))), "items")
    for b in range(blocks):
        own = items.where(F.col("block") == b).select("item_id", "text")
        docs = written(_scan_once(docs, [tuple(r) for r in own.collect()], n, column, b > 0),
                       "hits")
    return named_again(docs, old)


def clean_documents(docs: DataFrame, benchmark: DataFrame, n: int = N) -> DataFrame:
    """The documents without a hit, unchanged."""
    docs, old = plain_names(docs, "text")
    found = scan(docs, benchmark, n)
    column = found.columns[-1]
    return named_again(found.where(F.col(column)["n_hit"] == 0).drop(column), old)


def remove_spans(docs: DataFrame, benchmark: DataFrame, n: int = N) -> DataFrame:
    """All documents, with every run of hit words cut out of the text."""
    docs, old = plain_names(docs, "text")
    found = scan(docs, benchmark, n)
    column = found.columns[-1]
    spans = F.col(column)["spans"]
    ends = F.concat(F.array(F.lit(0).cast("long")), F.transform(spans, lambda s: s["end"]))
    starts = F.concat(F.transform(spans, lambda s: s["start"]),
                      F.array(F.char_length("text").cast("long")))
    kept = F.array_join(F.transform(F.arrays_zip(ends.alias("a"), starts.alias("b")), lambda g:
                                    F.substring("text", g["a"].cast("int") + 1,
                                                (g["b"] - g["a"]).cast("int"))), "")
    text = F.when(F.size(spans) > 0, kept).otherwise(F.col("text"))
    return named_again(found.withColumn("text", text).drop(column), old)
