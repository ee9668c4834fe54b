"""Helpers shared by the operators: columns, shared files, text buffers.

Text in Python tasks is handled as one flat byte buffer for many documents
(an Arrow string column is exactly that), so words, shingles and windows are
found by numpy over whole slices of a batch instead of row by row.
"""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import delete_path, scratch_folder

# The white space of the contracts: \x20 and \x09-\x0D.
SPACE = " \t\n\x0b\x0c\r"
# Bytes of text handled at once in a Python task (a longer document goes alone).
SLICE_BYTES = 1 << 20

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_az(col):
    """Lower-case A-Z only."""
    return F.translate(col, _UPPER, _UPPER.lower())


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def take(df: DataFrame, *names: str) -> DataFrame:
    """The named columns, also where another column has the same name in
    other letters' case (an exact match wins; of equal names the first)."""
    lowered = [c.lower() for c in df.columns]
    if all(lowered.count(n.lower()) == 1 for n in names):
        return df.select(*names)
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return plain.select(*[F.col(f"c{df.columns.index(n)}").alias(n) for n in names])


def plain_names(df: DataFrame, *names: str) -> tuple[DataFrame, list[str]]:
    """``df`` with columns that differ in letters' case only renamed, so that
    the named ones can be referred to, and the old names to put back with
    ``named_again``."""
    old = df.columns
    lowered = [c.lower() for c in old]
    if len(set(lowered)) == len(old):
        return df, old
    kept = {old.index(n) for n in names}
    new = [c if i in kept else f"column_{i}_" + "x" * max(map(len, old))
           for i, c in enumerate(old)]
    return df.toDF(*new), old


def named_again(df: DataFrame, old: list[str]) -> DataFrame:
    """The first columns with their old names; later ones stay."""
    return df.toDF(*old, *df.columns[len(old):]) if df.columns[:len(old)] != old else df


def free_name(df: DataFrame, base: str, others: list[str] = ()) -> str:
    """``base``, lengthened until no column of ``df`` or of ``others`` has that name."""
    taken = {c.lower() for c in (*df.columns, *others)}
    while base.lower() in taken:
        base += "_"
    return base


def shared_path(spark: SparkSession, kind: str) -> str:
    """A new path under the folder that driver and executors share (inside
    ``session.owned_scratch``: in the folder that goes at its end)."""
    return f"{scratch_folder(spark)}/llm/{kind}-{uuid.uuid4().hex}"


def written(df: DataFrame, kind: str = "cut") -> DataFrame:
    """``df`` as a committed table in the shared folder: a lineage cut that
    outlives executors, and a fixed copy of anything that depends on order."""
    path = shared_path(df.sparkSession, kind)
    schema = df.schema
    df.write.parquet(path)
    out = df.sparkSession.read.schema(schema).parquet(path)
    out.written_to = path
    return out


def forget(*tables: DataFrame | None) -> None:
    """Delete tables that ``written`` made: nothing may read them any more.
    (Frames made another way, and None, are left alone.)"""
    for df in tables:
        path = getattr(df, "written_to", None)
        if path:
            delete_path(df.sparkSession, path)


def release_memory() -> None:
    """Give back what a reused Python worker holds on to between tasks."""
    _POWERS[:] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
    gc.collect()
    pa.default_memory_pool().release_unused()


HOT_KEYS = 100_000  # at most so many keys are broadcast as hot ones
HOT_ROWS = 1_000    # a key with fewer rows is never hot


def by_key(rows: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """``rows`` with the columns of ``found``, which has one row for every
    ``key`` in ``rows`` and, in a column ``rows``, how many rows have it.  Keys with
    over a ``HOT_KEYS``-th of all rows (so fewer than ``HOT_KEYS``, whatever the
    size) are broadcast; the others meet by a shuffle without hot keys."""
    total = found.agg(F.sum("rows")).first()[0] or 0
    hot = F.col("rows") > max(HOT_ROWS, total // HOT_KEYS)
    names = [c for c in found.columns if c not in (key, "rows")]
    first = rows.join(F.broadcast(found.where(hot).select(key, F.struct(*names).alias("_hot"))),
                      key, "left")
    rest = first.where(F.col("_hot").isNull()).drop("_hot").join(
        found.where(~hot).drop("rows"), key)
    return first.where(F.col("_hot").isNotNull()).select(*rows.columns, "_hot.*").unionByName(
        rest.select(*rows.columns, *names))


# ---------------------------------------------------------------------------
# Flat text buffers
# ---------------------------------------------------------------------------

def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the row offsets into them (null: empty)."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def slices(batch: pa.RecordBatch, text: str = "text", limit: int = SLICE_BYTES
           ) -> Iterator[pa.RecordBatch]:
    """Row ranges of a batch holding about ``limit`` bytes of text each."""
    _, off = flat(batch.column(text))
    at, n = 0, batch.num_rows
    while at < n:
        to = max(at + 1, int(np.searchsorted(off, off[at] + limit, "right")) - 1)
        yield batch.slice(at, min(to, n) - at)
        at = to


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All characters as numbers, and the row of each."""
    flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return flat, np.repeat(np.arange(len(texts)), [len(t) for t in texts])


def byte_class(chars: bytes) -> np.ndarray:
    """A 256-entry table that is True for the given bytes."""
    t = np.zeros(256, bool)
    t[np.frombuffer(chars, np.uint8)] = True
    return t


# Words [^\x20\x09-\x0D]+ ; words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z.
SOLID = ~byte_class(SPACE.encode())
ALNUM = byte_class(bytes([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B),
                          *range(0x80, 0x100)]))


def word_spans(data: np.ndarray, off: np.ndarray, is_word: np.ndarray
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end (bytes) and row of every word; words never cross rows."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = is_word[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    edge = off[1:-1]
    edge = edge[(edge > 0) & (edge < len(data))]
    first[edge] |= inside[edge]
    last[edge - 1] |= inside[edge - 1]
    start = np.flatnonzero(first)
    end = np.flatnonzero(last) + 1
    return start, end, np.searchsorted(off, start, "right") - 1


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, on a uint64 array."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeds64(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random uint64 numbers."""
    step = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mix64(step + np.uint64(seed))


def _letters() -> np.ndarray:
    t = seeds64(256, 1) | np.uint64(1)
    t[65:91] = t[97:123]  # A-Z count as a-z
    return t


_LETTER = _letters()
_BASE = 0x9E6C63D0676A9A99  # odd, so it has an inverse modulo 2^64
_UNBASE = pow(_BASE, -1, 1 << 64)
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    while len(_POWERS[0]) < n:
        k = len(_POWERS[0])
        for i, b in enumerate((_BASE, _UNBASE)):
            _POWERS[i] = np.concatenate([_POWERS[i], _POWERS[i] * np.uint64(pow(b, k, 1 << 64))])
    return _POWERS[0][:n], _POWERS[1][:n]


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word with A-Z lower-cased: a polynomial over
    random byte values taken from one running sum, then mixed."""
    if not len(start):
        return np.zeros(0, np.uint64)
    up, down = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_LETTER[data] * up[:-1], out=total[1:])
    return mix64((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


_STEP = np.uint64(0xD6E8FEB86659FD93)


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` words: entry i covers words[i:i + k]."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(n, np.uint64(k))
    for j in range(k):
        h = mix64(h * _STEP + words[j:j + n])
    return h
