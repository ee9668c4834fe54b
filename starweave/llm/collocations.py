"""Collocations: phrases of 2 to 5 words that are frequent in their language.

Texts are cut into pieces at punctuation and line breaks and pieces into
words, A-Z lower-cased; phrases lie inside pieces, and everything is counted
per language (null: ``und``).

Finding the frequent phrases takes one pass over the texts per entry of
``LEVELS``, each with Misra-Gries summaries:

* a phrase's key is a 64-bit hash of language and words; keys are dealt to
  hash partitions, after every task has summed its own occurrences;
* each partition folds what it gets into one summary.  Beyond its capacity
  (``ROOM`` times the expected mass over the threshold) the count of the first
  counter too many is subtracted from all.  The sum of what was subtracted may
  never reach the threshold: rather than that, the capacity doubles, so it
  exceeds the partition's mass divided by the threshold wherever that is
  needed, and no frequent phrase can be lost;
* a counter survives if its count and what was subtracted reach the threshold.

A phrase can only be frequent if the shorter phrases in it are, so later
passes count only phrases whose parts survived.  Survivors are handed to the
tasks as a bitmap (two hash functions, at most ``MAX_BITS`` bits): a false hit
costs a needless count, nothing else, at any size of the corpus.

The last pass counts exactly: occurrences whose key and parts survived are
summed as strings per language, and what is below the threshold goes.  A task
sends its sums dealt to the same hash partitions, many to a row, and each
partition adds up what it gets.  Scores
and containment are joins over the frequent phrases.

Output: lang, rank, phrase, a, l, r, n, score; see the query's contract.
Null text counts as empty; doc_ids are not read, every row counts; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import byte_class, flat, mix64, slices, take, word_hashes, word_spans, written

THRESHOLD = 100
LONGEST = 5
TOP = 2000
LEVELS = ((1,), (2,), (3,), (4, 5))  # phrase lengths counted in each pass
ROOM = 4                   # capacity in units of expected mass / threshold
PARTITION_BYTES = 1 << 28  # of text whose phrases one summary may have to hold
MIN_CAPACITY = 1 << 12
FLUSH = 1 << 22            # occurrences summed by a task before they are sent
FLUSH_PHRASES = 200_000
MAX_BITS = 1 << 28         # of the bitmap of survivors (32 MB)
SALTS = 64                 # first round of the top list

_BREAKS = byte_class(b".,;:!?\x0a\x0b\x0c\x0d")
_WORD = ~(_BREAKS | byte_class(b" \t"))
_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[65:91] += 32
_PLAIN[9] = 32
_STEP, _OTHER = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)


class Summary:
    """A mergeable Misra-Gries summary of weighted 64-bit keys.

    A key's true count lies between its counter and counter + ``lost``, and
    ``lost`` stays below the threshold."""

    def __init__(self, threshold: int, capacity: int, buffer: int = 1 << 20):
        self.threshold, self.capacity, self.buffer = threshold, capacity, buffer
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.lost = 0
        self._new: list[tuple[np.ndarray, np.ndarray]] = []
        self._held = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self._new.append((keys, counts))
        self._held += len(keys)
        if self._held >= max(self.capacity, self.buffer):
            self.fold()

    def merge(self, other: Summary) -> None:
        other.fold()
        if self.lost + other.lost >= self.threshold:
            raise ValueError("the summaries have lost too much to be merged")
        self.lost += other.lost
        self.add(other.keys, other.counts)
        self.fold()

    def fold(self) -> None:
        if not self._new:
            return
        keys = np.concatenate([self.keys, *(k for k, _ in self._new)])
        counts = np.concatenate([self.counts, *(c for _, c in self._new)])
        self._new, self._held = [], 0
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) \
            if len(keys) else np.zeros(0, np.int64)
        keys, counts = keys[first], np.add.reduceat(counts, first) if len(first) else counts
        while len(keys) > self.capacity:
            cut = int(np.partition(counts, len(keys) - self.capacity - 1)
                      [len(keys) - self.capacity - 1])
            if self.lost + cut >= self.threshold:
                self.capacity *= 2
                continue
            left = counts > cut
            keys, counts = keys[left], counts[left] - cut
            self.lost += cut
        self.keys, self.counts = keys, counts

    def survivors(self) -> np.ndarray:
        self.fold()
        return self.keys[self.counts + self.lost >= self.threshold]


def _lang_seed(lang: str | None) -> int:
    return int.from_bytes(hashlib.blake2b(("und" if lang is None else lang).encode(),
                                          digest_size=8).digest(), "little")


def _places(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Both places of each key in a bitmap of ``bits`` (a power of two)."""
    mask = np.uint64(bits - 1)
    return keys & mask, mix64(keys ^ _OTHER) & mask


def _in_bitmap(keys: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    out = np.ones(len(keys), bool)
    for place in _places(keys, len(bitmap) * 64):
        word = bitmap[(place >> np.uint64(6)).astype(np.int64)]
        out &= (word >> (place & np.uint64(63))) & np.uint64(1) == 1
    return out


class _Slice:
    """The words of a slice of a batch, and the phrases that may be frequent."""

    def __init__(self, part: pa.RecordBatch, seeds: dict):
        data, off = flat(part.column("text"))
        self.data = data
        self.start, self.end, self.row = word_spans(data, off, _WORD)
        self.words = word_hashes(data, self.start, self.end)
        # Grows by one at least between words of different pieces or rows.
        self.piece = np.cumsum(_BREAKS[data])[self.start] + self.row if len(data) else self.start
        langs = part.column("lang").to_pylist()
        for x in set(langs):
            seeds.setdefault(x, _lang_seed(x))
        self.langs = langs
        self.seed = np.array([seeds[x] for x in langs], np.uint64)[self.row]

    def phrases(self, bitmap: np.ndarray | None, sifted: int, longest: int
                ) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(length, places of first words, keys, is it in the bitmap) of the
        phrases whose parts of up to ``sifted`` words are in the bitmap."""
        n = len(self.words)
        at = np.arange(n)
        h = mix64(self.words + _STEP)
        for m in range(1, longest + 1):
            keys = mix64(h ^ self.seed[at])
            alive = _in_bitmap(keys, bitmap) if m <= sifted else np.ones(len(at), bool)
            yield m, at, keys, alive
            good = np.zeros(n + 1, bool)
            good[at[alive]] = True
            on = alive & good[at + 1]
            on[on] = self.piece[at[on]] == self.piece[np.minimum(at[on] + m, n - 1)]
            at, h = at[on], h[on]
            h = mix64(h * _STEP + self.words[at + m])


def _partitions(docs: DataFrame) -> tuple[int, int]:
    """Number of hash partitions, and bytes of text to each."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")),
            -(-size // PARTITION_BYTES))
    return n, -(-size // n)


def _sent(docs: DataFrame, partitions: int, level: tuple[int, ...], bitmap, flush: int
          ) -> DataFrame:
    """(p, keys, counts): what each task counted, by hash partition."""

    def task(batches):
        held, size, seeds = [], 0, {}

        def send():
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            counts = counts.astype(np.int32)
            # Partitions are ranges of the key's upper half, so they lie in sorted order.
            p = ((keys >> np.uint64(32)) * np.uint64(partitions) >> np.uint64(32)).astype(np.int64)
            first = np.flatnonzero(np.concatenate([[True], p[1:] != p[:-1]]))
            to = np.append(first[1:], len(p))
            return pa.RecordBatch.from_arrays(
                [pa.array(p[first].astype(np.int32)),
                 pa.array([keys[a:b].tobytes() for a, b in zip(first, to)], pa.binary()),
                 pa.array([counts[a:b].tobytes() for a, b in zip(first, to)], pa.binary())],
                names=["p", "keys", "counts"])

        table = bitmap.value if bitmap is not None else None
        for batch in batches:
            for part in slices(batch):
                for m, _, keys, _ in _Slice(part, seeds).phrases(table, level[0] - 1, level[-1]):
                    if m in level and len(keys):
                        held.append(keys)
                        size += len(keys)
                if size >= flush:
                    yield send()
                    held, size = [], 0
        if held:
            yield send()

    return docs.mapInArrow(task, "p int, keys binary, counts binary")


def _survivors(docs: DataFrame, partitions: int, capacity: int, level: tuple[int, ...], bitmap,
               threshold: int, flush: int) -> DataFrame:
    """The keys of phrases of these lengths that may be frequent: all that are, few others."""

    def task(batches):
        summary = Summary(threshold, capacity)
        for batch in batches:
            for keys, counts in zip(batch.column("keys"), batch.column("counts")):
                summary.add(np.frombuffer(keys.as_buffer(), np.uint64),
                            np.frombuffer(counts.as_buffer(), np.int32).astype(np.int64))
        yield pa.RecordBatch.from_arrays(
            [pa.array(summary.survivors().view(np.int64))], names=["key"])

    sent = _sent(docs, partitions, level, bitmap, flush).repartitionById(partitions, "p")
    return written(sent.mapInArrow(task, "key long"), "survivors")


def _bitmap(survivors: DataFrame):
    """A broadcast bitmap of the keys, and the number of keys."""
    n = survivors.count()
    bits = 1 << 16
    while bits < 16 * n and bits < MAX_BITS:
        bits *= 2

    def task(batches):
        for batch in batches:
            keys = batch.column("key").to_numpy().view(np.uint64)
            place = np.concatenate(_places(keys, bits))
            yield pa.RecordBatch.from_arrays(
                [pa.array((place >> np.uint64(6)).astype(np.int64)),
                 pa.array((np.uint64(1) << (place & np.uint64(63))).view(np.int64))],
                names=["word", "bits"])

    words = survivors.mapInArrow(task, "word long, bits long").groupBy("word").agg(
        F.bit_or("bits").alias("bits")).toArrow()
    table = np.zeros(bits // 64, np.uint64)
    table[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return survivors.sparkSession.sparkContext.broadcast(table)


def _partial_sums(docs: DataFrame, bitmap, longest: int, flush: int, partitions: int
                  ) -> DataFrame:
    """(p, lang, phrases, counts): what each task counted, by hash partition and
    language; with a null phrase: all words."""

    def task(batches):
        # By partition and language; a phrase always has the same key, so the same partition.
        counts, words, seeds, held = defaultdict(lambda: defaultdict(int)), defaultdict(int), {}, 0

        def send():
            p, langs = zip(*counts)
            return pa.RecordBatch.from_arrays(
                [pa.array(p, pa.int32()),
                 pa.array(["und" if x is None else x for x in langs], pa.string()),
                 pa.array([[None if x is None else x.decode() for x in found]
                           for found in counts.values()], pa.list_(pa.string())),
                 pa.array([list(found.values()) for found in counts.values()],
                          pa.list_(pa.int64()))], names=["p", "lang", "phrases", "counts"])

        for batch in batches:
            for part in slices(batch):
                s = _Slice(part, seeds)
                if not len(s.words):
                    continue
                per_row = np.bincount(s.row, minlength=part.num_rows)
                for lang, c in zip(s.langs, per_row.tolist()):
                    words[lang] += c
                raw = _PLAIN[s.data].tobytes()
                size = np.concatenate([[0], np.cumsum(s.end - s.start)])
                for m, at, keys, alive in s.phrases(bitmap.value, longest, longest):
                    at, keys = at[alive], keys[alive]
                    if not len(at):
                        continue
                    # A second hash tells apart phrases with one key.
                    again = np.zeros(len(at), np.uint64)
                    for j in range(m):
                        again = again * _OTHER + s.words[at + j]
                    order = np.argsort(keys, kind="stable")
                    k, g = keys[order], again[order]
                    first = np.flatnonzero(np.concatenate(
                        [[True], (k[1:] != k[:-1]) | (g[1:] != g[:-1])]))
                    c = np.diff(np.append(first, len(k))).tolist()
                    one = at[order[first]]
                    to = ((k[first] >> np.uint64(32)) * np.uint64(partitions)
                          >> np.uint64(32)).tolist()
                    a, b = s.start[one], s.end[one + m - 1]
                    plain = (b - a == size[one + m] - size[one] + m - 1).tolist()
                    for x, y, ok, row, z, p in zip(a.tolist(), b.tolist(), plain,
                                                   s.row[one].tolist(), c, to):
                        phrase = raw[x:y] if ok else b" ".join(raw[x:y].split())
                        found = counts[p, s.langs[row]]
                        held += phrase not in found
                        found[phrase] += z
                if held >= flush:
                    yield send()
                    counts.clear()
                    held = 0
        for lang, c in words.items():
            if c:
                counts[0, lang][None] += c
        if counts:
            yield send()

    return docs.mapInArrow(task, "p int, lang string, phrases array<string>, counts array<bigint>")


def _counted(docs: DataFrame, bitmap, longest: int, threshold: int, flush: int, partitions: int
             ) -> DataFrame:
    """(lang, phrase, a): the sums of at least ``threshold``; with a null phrase, all words."""

    def task(batches):
        new, held = [], 0

        def folded():
            total = pa.concat_tables(new).group_by(["lang", "phrase"], use_threads=False) \
                .aggregate([("a", "sum")])
            return total.select(["lang", "phrase", "a_sum"]).rename_columns(["lang", "phrase", "a"])

        for batch in batches:
            lists = batch.column("phrases")
            new.append(pa.table({
                "lang": batch.column("lang").take(pc.list_parent_indices(lists)),
                "phrase": lists.flatten(), "a": batch.column("counts").flatten()}))
            held += new[-1].num_rows
            if held >= 4 * flush + new[0].num_rows:
                new, held = [folded()], 0
        if new:
            total = folded()
            kept = pc.or_(pc.is_null(total["phrase"]), pc.greater_equal(total["a"], threshold))
            yield from total.filter(kept).combine_chunks().to_batches()

    sent = _partial_sums(docs, bitmap, longest, flush, partitions)
    return sent.repartitionById(partitions, "p").mapInArrow(
        task, "lang string, phrase string, a long")


def frequent_phrases(docs: DataFrame, threshold: int = THRESHOLD, longest: int = LONGEST,
                     flush: int = FLUSH) -> DataFrame:
    """(lang, phrase, a): the exact count of every phrase of 1 to ``longest``
    words with at least ``threshold`` occurrences; with a null phrase, all
    word occurrences of the language."""
    docs = take(docs, "lang", "text")
    partitions, size = _partitions(docs)
    levels = [tuple(m for m in x if m <= longest) for x in LEVELS]
    levels = [x for x in levels if x]
    found: DataFrame | None = None
    bitmap = None
    for level in levels:
        # A word takes five bytes or more with what follows it, on average.
        capacity = max(MIN_CAPACITY, ROOM * len(level) * size // (5 * threshold))
        new = _survivors(docs, partitions, capacity, level, bitmap, threshold, flush)
        found = new if found is None else found.unionByName(new)
        if bitmap is not None:
            bitmap.unpersist()
        bitmap = _bitmap(found)
    return written(_counted(docs, bitmap, longest, threshold, FLUSH_PHRASES, partitions), "phrases")


def collocations(docs: DataFrame, threshold: int = THRESHOLD, longest: int = LONGEST,
                 top: int = TOP, flush: int = FLUSH) -> DataFrame:
    """Each language's ``top`` phrases by the score of their weakest cut."""
    counted = frequent_phrases(docs, threshold, longest, flush)
    totals = counted.where(F.col("phrase").isNull()).select("lang", F.col("a").alias("n"))
    single = counted.where(F.col("phrase").isNotNull())
    long = single.withColumn("w", F.split("phrase", " ", -1)).where(F.size("w") > 1)

    def part(start, length):
        return F.array_join(F.slice("w", start, length), " ")

    cuts = long.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("w") - 1))).select(
        "lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("left"),
        part(F.col("k") + 1, F.size("w") - F.col("k")).alias("right"))
    scored = cuts.join(single.toDF("lang", "left", "l"), ["lang", "left"]).join(
        single.toDF("lang", "right", "r"), ["lang", "right"]).join(totals, "lang").withColumn(
        "score", F.expr("(1000BD * cast(a as decimal(16,0)) * cast(n as decimal(17,0)))"
                        " div (cast(l as decimal(19,0)) * cast(r as decimal(18,0)))"))
    weakest = scored.groupBy("lang", "phrase", "a", "n").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    # What lies inside a longer phrase that is as frequent says nothing more.
    inner = long.where(F.size("w") > 2).select("lang", "a", F.explode(F.expr(
        "flatten(transform(sequence(2, size(w) - 1), m -> transform(sequence(1, size(w) - m + 1),"
        " i -> array_join(slice(w, i, m), ' '))))")).alias("phrase"))
    outer = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = weakest.join(outer, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.col("longer") < F.col("a")))

    rows = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # Two rounds, so that no task sorts a whole language.
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    first = salted.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
