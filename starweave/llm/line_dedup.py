"""Line dedup over levelled sorted runs of line hashes.

A line's key is the line without white space at its ends, A-Z lower-cased.
``LineRuns`` keeps, for every key of at least ``min_chars`` code points, in
how many documents it was found and the largest doc_id among them, in runs
sorted by the key's hash (MD5, 16 bytes).  A batch of documents is summed by
key; a merge anti-join against the runs gives the keys no earlier batch had,
which are written as a run of their own at level 0, so all runs together hold each
key once.  What the batch adds to keys that are there goes to a second kind of
run.  When a level holds ``fanout`` runs they are merged into one run of the
next level, so a key is rewritten a logarithmic number of times; additions are
summed likewise.  A key's total is its one entry and what was added to it.

``dedup`` adds all documents to the runs, batch by batch, and then drops the
lines of frequent keys from all documents but the one with the largest doc_id.

Output: the input's columns with ``text`` replaced, and ``n_lines`` (before
dropping) and ``n_dropped``.

Null or empty text is one empty line (and comes back as empty text).  Several
rows with one doc_id are one document.  Rows without a doc_id are one
document too, before all others.  Documents that share the largest doc_id all
keep the line.  An empty table gives no rows.  Columns named like the two new
ones keep their name; the new ones get an underscore more.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import delete_path
from .common import (
    SPACE, by_key, forget, free_name, lower_az, named_again, plain_names, shared_path, take,
    written,
)

MIN_CHARS = 40
MIN_DOCS = 5
BATCHES = 3
FANOUT = 2
BROADCAST_BYTES = 32 << 20  # drop lists broadcast up to this measured size


def line_keys(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(key hash, doc_id), once per document, of all long lines."""
    line = F.explode(F.split("text", "\n")).alias("line")
    key = lower_az(F.btrim(F.col("line"), F.lit(SPACE)))
    return take(docs, "doc_id", "text").select("doc_id", line) \
        .select("doc_id", key.alias("key")).where(F.char_length("key") >= min_chars) \
        .select(F.unhex(F.md5("key")).alias("h"), "doc_id").distinct()


class LineRuns:
    """Runs of (h, docs, last), sorted by h, in the shared folder.

    ``levels`` hold every key once, as its first batch left it; ``later`` holds
    what further batches added to keys that were there."""

    def __init__(self, spark: SparkSession, path: str | None = None, fanout: int = FANOUT):
        self.spark, self.fanout = spark, fanout
        self.path = path or shared_path(spark, "line-runs")
        self.levels: list[list[str]] = []
        self.later: list[str] = []
        self.made = 0

    def _write(self, rows: DataFrame, kind: str) -> str:
        path = f"{self.path}/{kind}/run-{self.made:05d}"
        self.made += 1
        rows.repartition("h").sortWithinPartitions("h").write.parquet(path)
        return path

    def _rows(self, paths: list[str]) -> DataFrame:
        return self.spark.read.schema("h binary, docs long, last long").parquet(*paths)

    def paths(self) -> list[str]:
        return [p for level in self.levels for p in level]

    def add(self, keys: DataFrame) -> None:
        """Add a batch of distinct (h, doc_id); its documents must be in no other batch."""
        batch = keys.groupBy("h").agg(F.count(F.lit(1)).alias("docs"), F.max("doc_id").alias("last"))
        if not self.levels:
            self.levels.append([])
        if self.paths():
            batch = written(batch, "batch")
            known = self._rows(self.paths()).select("h").hint("merge")
            self.later.append(self._write(batch.join(known, "h", "left_semi"), "later"))
            new = self._write(batch.join(known, "h", "left_anti"), "level-0")
            forget(batch)
        else:
            new = self._write(batch, "level-0")
        self.levels[0].append(new)
        level = 0
        while level < len(self.levels) and len(self.levels[level]) >= self.fanout:
            if level + 1 == len(self.levels):
                self.levels.append([])
            # No key is in two runs, so merging them adds nothing up.
            merged = self._write(self._rows(self.levels[level]), f"level-{level + 1}")
            old, self.levels[level] = self.levels[level], []
            self.levels[level + 1].append(merged)
            self._delete(old)
            level += 1
        if len(self.later) >= self.fanout:
            merged = self._write(self._added(), "later")
            old, self.later = self.later, [merged]
            self._delete(old)

    def _delete(self, paths: list[str]) -> None:
        for p in paths:
            delete_path(self.spark, p)

    def _added(self) -> DataFrame:
        return self._rows(self.later).groupBy("h").agg(
            F.sum("docs").alias("docs"), F.max("last").alias("last"))

    def totals(self) -> DataFrame | None:
        """(h, docs, last) over all batches; None before the first."""
        if not self.paths():
            return None
        first = self._rows(self.paths())
        if not self.later:
            return first
        return first.join(self._added().toDF("h", "more", "after"), "h", "left").select(
            "h", (F.col("docs") + F.coalesce("more", F.lit(0))).alias("docs"),
            F.greatest("last", "after").alias("last"))

    def delete(self) -> None:
        """All runs go."""
        delete_path(self.spark, self.path)


def _drop_lists(docs: DataFrame, min_chars: int, min_docs: int, batches: int,
                fanout: int) -> DataFrame:
    """(doc_id, drop): the hashes of the keys that the document loses, joined."""
    keys = line_keys(docs, min_chars).withColumn(
        "batch", F.pmod(F.xxhash64("doc_id"), F.lit(batches)))
    keys = written(keys, "line-keys")
    runs = LineRuns(docs.sparkSession, fanout=fanout)
    for b in range(batches):
        runs.add(keys.where(F.col("batch") == b).drop("batch"))
    frequent = written(runs.totals().where(F.col("docs") >= min_docs).select(
        "h", F.col("docs").alias("rows"), "last"), "frequent")
    runs.delete()
    lost = by_key(keys.drop("batch"), frequent, "h").where(F.col("last").isNotNull() & (
        F.col("doc_id").isNull() | (F.col("doc_id") < F.col("last"))))
    lists = written(lost.groupBy("doc_id").agg(
        F.array_join(F.collect_list(F.hex("h")), "").alias("drop")), "drop-lists")
    forget(keys, frequent)
    return lists


def dedup(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
          batches: int = BATCHES, fanout: int = FANOUT,
          broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``docs`` without frequent lines, with n_lines and n_dropped.  The lists
    of what documents lose are broadcast if they are measured to fit
    ``broadcast_bytes``, else joined by a shuffle."""
    docs, old = plain_names(docs, "doc_id", "text")
    lists = _drop_lists(docs, min_chars, min_docs, batches, fanout)
    # A row of the built relation takes some 100 bytes beside its list.
    size = lists.agg(F.sum(F.octet_length("drop") + 100)).first()[0] or 0
    drop = free_name(docs, "drop")
    lines, dropped = free_name(docs, "n_lines", old), free_name(docs, "n_dropped", old)
    row_id = free_name(docs, "drop_id")
    lists = lists.toDF(row_id, drop)
    marked = docs.join(F.broadcast(lists) if size <= broadcast_bytes else lists.hint("merge"),
                       docs["doc_id"].eqNullSafe(lists[row_id]), "left").drop(row_id)
    text_at = docs.columns.index("text")
    names = docs.columns

    def task(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_:
            texts, n, gone = [], [], []
            for text, lost in zip(batch.column(text_at).to_pylist(),
                                  batch.column(len(names)).to_pylist()):
                n.append((text or "").count("\n") + 1)
                text, out = clean(text or "", lost)
                texts.append(text)
                gone.append(out)
            columns = [batch.column(i) for i in range(len(names))]
            columns[text_at] = pa.array(texts, columns[text_at].type)
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(n, pa.int64()), pa.array(gone, pa.int64())],
                names=[*names, lines, dropped])

    schema = T.StructType([*docs.schema, T.StructField(lines, T.LongType()),
                           T.StructField(dropped, T.LongType())])
    return named_again(marked.mapInArrow(task, schema), old)


def clean(text: str, lost: str | None) -> tuple[str, int]:
    """The text without the lines whose key's hash is in ``lost`` (upper-case
    hex digests, joined), and how many lines those are."""
    if not lost:
        return text, 0
    digests = {lost[i:i + 32].lower() for i in range(0, len(lost), 32)}
    lines = text.split("\n")
    kept = [x for x in lines
            if hashlib.md5(x.strip(SPACE).encode().lower()).hexdigest() not in digests]
    return "\n".join(kept), len(lines) - len(kept)
