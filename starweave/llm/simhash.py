"""Near-duplicates by SimHash fingerprints and multi-index hashing.

A document's fingerprint has a bit set where over half of its word shingles'
XXH64 hashes (seed 42, repeats included) have it.  Fingerprints that differ
in at most ``max_bits`` bits are linked.

The fingerprint is cut into ``SEGMENTS`` segments and each gets a radius so
that radii and segments add up to ``max_bits`` + 1: two linked fingerprints
then lie within the radius of each other in at least one segment (with 4 bits:
1, 1 and 0).  Each distinct fingerprint is stored in one table per segment,
under the segment's value, and visits the values in the Hamming ball around
its own.  Of two values that differ, only the one with a zero in the highest
differing bit visits, so half a ball is enough.  A bucket compares complete
fingerprints and gives links that join its parts, never all pairs.

Equal fingerprints are one vertex, however many documents have them.  A
segment's value with more than ``cell`` fingerprints is dealt to several
cells: each stores its share, and the other shares visit it.

Output, one row per input row: doc_id, fingerprint (16 hex digits),
component_id (smallest doc_id reachable, itself included).

Null text or no words: fingerprint zero, linked like any other.  Fewer words
than a shingle: the whole sequence is the one shingle.  Repeated doc_ids: a
row each, by its own text; equal ids alone link nothing.  A null doc_id takes
the component of the documents it reaches, else null.  An empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_key, take, written
from .components import components

SHINGLE = 4
MAX_BITS = 4
SEGMENTS = 3
SEED = 42
CELL = 4096       # fingerprints stored in one cell of a bucket
FEW = 8           # stored in a bucket whose comparisons are done together with others'
HASHES = 1 << 16  # hashes of a document counted at once


def fingerprint(text: str | None, k: int = SHINGLE) -> int:
    """The fingerprint of a text, as an unsigned integer."""
    import xxhash

    words = (text or "").encode().lower().split()  # bytes: A-Z, and \x20 \x09-\x0D only
    if not words:
        return 0
    plain = b" ".join(words)
    k = min(k, len(words))
    size = np.fromiter(map(len, words), np.int64, len(words))
    start = np.cumsum(size + 1) - size - 1
    to = (start + size)[k - 1:].tolist()
    start = start[:len(to)].tolist()
    votes = np.zeros(64, np.int64)
    digest = xxhash.xxh64_digest
    for at in range(0, len(to), HASHES):
        raw = b"".join([digest(plain[a:b], SEED)
                        for a, b in zip(start[at:at + HASHES], to[at:at + HASHES])])
        bits = np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1)
        votes += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > len(to)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, f) with the fingerprint as a signed long."""

    def task(batches):
        for batch in batches:
            f = np.array([fingerprint(t.as_py(), shingle) for t in batch.column("text")], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(f.view(np.int64))],
                names=["doc_id", "f"])

    return take(docs, "doc_id", "text").mapInArrow(task, "doc_id long, f long")


def segments(max_bits: int, n: int = SEGMENTS) -> list[tuple[int, int, int]]:
    """(lowest bit, width, radius) of each segment; radius -1: not needed."""
    spare = max_bits + 1
    edges = [round(64 * i / n) for i in range(n + 1)]
    return [(a, b - a, spare // n + (i < spare % n) - 1)
            for i, (a, b) in enumerate(zip(edges, edges[1:]))]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _table_rows(found: DataFrame, max_bits: int, n_segments: int) -> DataFrame:
    """(seg, value, kind, f): kind 0 where f is stored, kind 1 where it visits."""
    rows = []
    for i, (low, width, radius) in enumerate(segments(max_bits, n_segments)):
        if radius < 0:
            continue
        value = F.shiftrightunsigned("f", low).bitwiseAND(F.lit((1 << width) - 1))
        row = lambda v, kind: F.struct(F.lit(i).alias("seg"), v.alias("value"),
                                       F.lit(kind).alias("kind"))
        rows.append(F.array(row(value, 0)))
        masks = [(sum(1 << b for b in bits), 1 << bits[-1]) for r in range(1, radius + 1)
                 for bits in combinations(range(width), r)]
        if masks:
            ball = F.array(*[F.struct(F.lit(m).cast("long").alias("m"),
                                      F.lit(top).cast("long").alias("top")) for m, top in masks])
            half = F.filter(ball, lambda x: value.bitwiseAND(x["top"]) == 0)
            rows.append(F.transform(half, lambda x: row(value.bitwiseXOR(x["m"]), 1)))
    return found.select("f", F.explode(F.concat(*rows)).alias("t")).select("t.*", "f")


def _cells(rows: DataFrame, cell: int) -> DataFrame:
    """``rows`` with a cell; those of full buckets are dealt to several."""
    full = written(rows.where("kind = 0").groupBy("seg", "value").agg(
        F.ceil(F.count(F.lit(1)) / cell).cast("int").alias("cells")).where("cells > 1"), "full")
    one = rows.join(full, ["seg", "value"], "left")
    own = F.pmod(F.xxhash64("f"), F.col("cells")).cast("int")
    dealt = F.when(F.col("cells").isNull(), F.array(F.struct(
        F.lit(0).alias("cell"), F.col("kind").alias("kind")))).otherwise(F.transform(
            F.sequence(F.when(F.col("kind") == 0, own).otherwise(0), F.col("cells") - 1),
            # A stored fingerprint visits the cells after its own.
            lambda c: F.struct(c.alias("cell"), F.when((F.col("kind") == 0) & (c == own), 0)
                               .otherwise(1).alias("kind"))))
    return one.select("seg", "value", "f", F.explode(dealt).alias("d")).select(
        "seg", "value", "d.cell", "d.kind", "f")


class Bucket:
    """The fingerprints stored in a cell, and which of them are joined."""

    def __init__(self, max_bits: int):
        self.max_bits = max_bits
        self.f, self.part = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.links: list[tuple[int, int]] = []

    def _meet(self, f: int, near: np.ndarray, at: int) -> None:
        """Link ``f`` (stored at ``at``, or a visitor) to a member of each part near it."""
        parts, first = np.unique(self.part[near], return_index=True)
        self.links += [(f, int(self.f[near[i]])) for i in first]
        if at >= 0:
            parts = np.append(parts, self.part[at])
        if len(parts) > 1:
            self.part[np.isin(self.part, parts)] = parts[0]

    def add(self, stored: np.ndarray, visitors: np.ndarray) -> None:
        n = len(self.f)
        self.f = np.concatenate([self.f, stored])
        self.part = np.concatenate([self.part, np.arange(n, n + len(stored))])
        if not len(self.f):
            return
        step = max(1, (1 << 20) // len(self.f))
        for who, base in ((stored, n), (visitors, -1)):
            for at in range(0, len(who), step):
                block = who[at:at + step]
                near = np.bitwise_count(block[:, None] ^ self.f[None, :]) <= self.max_bits
                if base >= 0:  # each with those before it
                    near &= np.arange(len(self.f))[None, :] < base + at + np.arange(len(block))[:, None]
                for i in np.flatnonzero(near.any(axis=1)):
                    self._meet(int(block[i]), np.flatnonzero(near[i]),
                               base + at + i if base >= 0 else -1)


def _links(rows: DataFrame, max_bits: int) -> DataFrame:
    """Links (a, b) that join what is near inside each cell."""
    keys = ["seg", "value", "cell"]

    def task(batches):
        last, bucket = None, None
        for batch in batches:
            columns = [batch.column(c).to_numpy() for c in keys]
            stored = batch.column("kind").to_numpy() == 0
            f = batch.column("f").to_numpy().view(np.uint64)
            if not len(f):
                continue
            new = np.ones(len(f), bool)
            new[1:] = False
            for c in columns:
                new[1:] |= c[1:] != c[:-1]
            start = np.flatnonzero(new)
            end = np.append(start[1:], len(f))
            t = np.add.reduceat(stored.astype(np.int64), start)
            ident = tuple(int(c[0]) for c in columns)
            # One by one: what a batch's edge may cut, and full buckets.
            alone = t > FEW
            alone[-1] = True
            if ident == last:
                alone[0] = True
            a, b = [], []
            # All others together: each row with every stored one before it.
            few = ~alone & (t > 0) & (end - start > 1)
            size = (end - start)[few]
            row = np.arange(size.sum()) + np.repeat(start[few] - (np.cumsum(size) - size), size)
            head, many = np.repeat(start[few], size), np.repeat(t[few], size)
            for j in range(FEW):
                at = head + j
                on = (j < many) & (at < row)
                x, y = f[row[on]], f[at[on]]
                near = np.bitwise_count(x ^ y) <= max_bits
                a.append(x[near])
                b.append(y[near])
            for g in np.flatnonzero(alone):
                part = slice(start[g], end[g])
                if not (g == 0 and ident == last):
                    bucket = Bucket(max_bits)
                bucket.add(f[part][stored[part]], f[part][~stored[part]])
                if bucket.links:
                    x, y = np.array(bucket.links, np.uint64).T
                    a.append(x)
                    b.append(y)
                    bucket.links = []
            last = tuple(int(c[-1]) for c in columns)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x).view(np.int64)) for x in (a, b)], names=["a", "b"])

    return rows.repartition(*keys).sortWithinPartitions(*keys, "kind").mapInArrow(
        task, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                    n_segments: int = SEGMENTS, cell: int = CELL) -> DataFrame:
    """One row per document with its fingerprint and component; see the module's text."""
    if not 0 <= max_bits < 64:
        raise ValueError("max_bits must be from 0 to 63")
    found = written(fingerprints(docs, shingle), "fingerprints")
    classes = written(found.groupBy("f").agg(F.min("doc_id").alias("doc"),
                                             F.count(F.lit(1)).alias("rows")), "classes")
    rows = _table_rows(classes.select("f"), max_bits, n_segments)
    joined = written(components(written(_links(_cells(rows, cell), max_bits), "links"))
                     .toDF("f", "c"), "joined")
    named = classes.join(joined, "f", "left").withColumn("c", F.coalesce("c", "f"))
    least = named.groupBy("c").agg(F.min("doc").alias("component_id"))
    of_class = written(named.join(least, "c").select("f", "rows", "component_id"), "of-class")
    return by_key(found, of_class, "f").select(
        "doc_id", F.lpad(F.lower(F.hex("f")), 16, "0").alias("fingerprint"), "component_id")
