"""Spelling variants: words one edit apart, and the form each belongs to.

Words are maximal runs of letters (A-Z, a-z and \\u00C0-\\u00FF) with A-Z
lower-cased; ``slips`` deletes a code point of some, by a hash of doc_id and
run.  Of the words with at least ``min_chars`` code points and ``min_count``
occurrences, two are near if they differ by exactly one inserted, deleted or
replaced code point.

An edit leaves the first half or the second half of the shorter word as it
is, so near words meet in a block named by the shorter length and one of
those halves.  Blocks hold words of that length and of one more, and are
compared as dense tiles: the words' code points are the rows of a padded
matrix, once aligned left and once right; for all pairs of a tile the first
unequal column gives the common prefix and the common suffix, and a pair is
one edit apart if both together reach the longer length minus one.  A pair is
counted in its prefix block, in its suffix block only if the prefixes differ.

Blocks with more than ``tile`` words are dealt out in tiles, each pair of them
to a task of its own.  Tiles send no pairs: for each word the number of near
words and the best of them, which add up.

A word's form is its near word of largest n (ties: smallest in code-point
order) if that n is at least ``ratio`` times the word's; its root is where the
forms lead, found by doubling the distance followed each round.

Output: word, n, n_near, form, form_n, root.  Null text: no words.  A null
doc_id counts as empty text in the hash.  Every row counts, also repeated ones;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import take, written

MIN_CHARS = 5
MIN_COUNT = 3
RATIO = 2
SLIP = 97       # a run is cut short where this divides its hash
TILE = 1024     # words on one side of a tile
CELLS = 1 << 19  # code points (or rows of up to 8) compared at once
FLUSH = 200_000  # distinct words held by a task

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def slips(doc_id, run: str, slip: int = SLIP) -> str:
    """The run, or the run without one code point (none if ``slip`` is 0)."""
    if slip:
        h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
        if h % slip == 0:
            at = h % len(run)
            return run[:at] + run[at + 1:]
    return run


def word_counts(docs: DataFrame, slip: int = SLIP, flush: int = FLUSH) -> DataFrame:
    """(word, n) of all runs of all texts."""

    def task(batches):
        counts = Counter()

        def send():
            out = pa.RecordBatch.from_arrays(
                [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())],
                names=["word", "n"])
            counts.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                text = text.as_py()
                if not text:
                    continue
                runs = RUN.findall(text.encode().lower().decode())  # bytes: A-Z only
                counts.update(runs)
                if slip:
                    seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                    own = list(set(runs))
                    hashes = map(zlib.crc32, map(str.encode, own), repeat(seed))
                    for run in [r for r, h in zip(own, hashes) if not h % slip]:
                        n = runs.count(run)
                        counts[run] -= n
                        counts[slips(doc_id, run, slip)] += n
                if len(counts) >= flush:
                    yield send()
        if counts:
            yield send()

    return take(docs, "doc_id", "text").mapInArrow(task, "word string, n long") \
        .where("word <> ''").groupBy("word").agg(F.sum("n").alias("n")).where("n > 0")


def _blocks(words: DataFrame, min_chars: int, tile: int) -> DataFrame:
    """(kind, short, half, x, y, side, word, n): the tiles that a word is in, as row
    (side 0), column (1) or both (2, a tile on the diagonal)."""
    size = F.char_length("word")

    def block(kind: str, short, half):
        return F.struct(F.lit(kind).alias("kind"), short.alias("short"), half.alias("half"))

    named = []
    for short in (size, size - 1):
        named += [block("p", short, F.substring("word", F.lit(1), F.floor(short / 2).cast("int"))),
                  block("s", short, F.right("word", (short - F.floor(short / 2)).cast("int")))]
    blocks = words.select("word", "n", F.explode(F.array(*named)).alias("b")).where(
        F.col("b.short") >= min_chars).select("b.*", "word", "n")
    keys = ["kind", "short", "half"]
    counted = blocks.groupBy(*keys).agg(F.count(F.lit(1)).alias("words")).where("words > 1").select(
        *keys, F.ceil(F.col("words") / tile).cast("int").alias("tiles"))
    dealt = blocks.join(counted, keys).withColumn(
        "own", F.pmod(F.xxhash64("word"), F.col("tiles")).cast("int"))
    return dealt.select(*keys, "word", "n", "own", F.explode(
        F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other")).select(
        *keys, F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"),
        F.when(F.col("own") == F.col("other"), 2).otherwise(
            (F.col("own") > F.col("other")).cast("int")).alias("side"), "word", "n")


def _matrix(words: list[bytes], width: int, pad: bytes) -> np.ndarray:
    """The code points (all below 256; the paddings 0 and 1 are no letters) as rows."""
    return np.frombuffer(b"".join([w.ljust(width, pad) for w in words]), np.uint8) \
        .reshape(len(words), width)


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common start of each row of ``a`` with each of ``b``."""
    if a.shape[1] == 8:  # a row is one number, its first code point the lowest byte
        x = a.view("<u8")[:, 0][:, None] ^ b.view("<u8")[:, 0][None, :]
        return np.bitwise_count((x & -x) - np.uint64(1)) >> 3
    same = a[:, None] == b[None]
    return np.where(same.all(axis=2), a.shape[1], same.argmin(axis=2))


def one_edit(a: list[str], b: list[str], skip: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Indexes (i, j) of the pairs one edit apart.  Pairs that share their
    first ``skip`` code points are left out."""
    la, lb = (np.array([len(w) for w in x]) for x in (a, b))
    longest = int(max(la.max(), lb.max()))
    width = 8 if longest <= 8 else longest
    plain = [[w.encode("latin-1") for w in x] for x in (a, b)]
    left, left_b = (_matrix(x, width, p) for x, p in zip(plain, (b"\0", b"\1")))
    right, right_b = (_matrix([w[::-1] for w in x], width, p) for x, p in zip(plain, (b"\0", b"\1")))
    each = 1 if width == 8 else width
    cols = max(1, min(len(b), CELLS // each))
    rows = max(1, CELLS // (each * cols))
    found = []
    for i in range(0, len(a), rows):
        for j in range(0, len(b), cols):
            x, y = np.s_[i:i + rows], np.s_[j:j + cols]
            prefix = _common(left[x], left_b[y])
            longer = np.maximum(la[x, None], lb[None, y])
            # The common prefix of equal words is all of them.
            near = (prefix + _common(right[x], right_b[y]) >= longer - 1) & (prefix < longer)
            if skip:
                near &= prefix < skip
            p, q = np.nonzero(near)
            found.append((p + i, q + j))
    return tuple(np.concatenate(x) for x in zip(*found))


def _tile(kind: str, short: int, words: list[str], n: np.ndarray, side: np.ndarray
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place of a word, number of near words, place of the best), for the words with any."""
    order = sorted(range(len(words)), key=lambda i: (-n[i], words[i]))  # the best come first
    same = side[0] == 2
    a = [i for i in order if side[i] != 1]
    b = a if same else [i for i in order if side[i] == 1]
    if not a or not b:
        return (np.zeros(0, np.int64),) * 3
    # What the block has in common is left out.
    half = short // 2
    rest = [w[half:] if kind == "p" else w[:len(w) - (short - half)] for w in words]
    i, j = one_edit([rest[x] for x in a], [rest[x] for x in b], half if kind == "s" else 0)
    # Pairs of two longer words belong to another block.
    size = np.array([len(w) for w in words])
    a, b = np.array(a), np.array(b)
    ok = np.minimum(size[a[i]], size[b[j]]) == short
    i, j = a[i[ok]], b[j[ok]]
    if not same:
        i, j = np.concatenate([i, j]), np.concatenate([j, i])
    rank = np.empty(len(words), np.int64)
    rank[order] = np.arange(len(words))
    by = np.lexsort((rank[j], i))
    i, j = i[by], j[by]
    first = np.flatnonzero(np.concatenate([[True], i[1:] != i[:-1]])) if len(i) else i
    return i[first], np.diff(np.append(first, len(i))), j[first]


def near_words(words: DataFrame, min_chars: int = MIN_CHARS, tile: int = TILE) -> DataFrame:
    """(word, n_near, best_n, best) of the words (word, n) that have near ones."""
    keys = ["kind", "short", "half", "x", "y"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, ([], [], [])
        out = ([], [], [], [])

        def close():
            words, n, side = held
            if len(words) > 1:
                who, near, best = _tile(at[0], at[1], words, np.array(n), np.array(side))
                out[0].extend(words[i] for i in who)
                out[1].extend(near.tolist())
                out[2].extend(n[i] for i in best)
                out[3].extend(words[i] for i in best)
            for x in held:
                x.clear()

        def send():
            batch = pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(out, (pa.string(), pa.int64(), pa.int64(),
                                                      pa.string()))],
                names=["word", "n_near", "best_n", "best"])
            for x in out:
                x.clear()
            return batch

        for batch in batches:
            for *key, word, n, side in zip(*(batch.column(c).to_pylist()
                                             for c in (*keys, "word", "n", "side"))):
                if key != at:
                    close()
                    at = key
                held[0].append(word)
                held[1].append(n)
                held[2].append(side)
            if out[0]:
                yield send()
        close()
        if out[0]:
            yield send()

    found = _blocks(words, min_chars, tile).repartition(*keys).sortWithinPartitions(*keys) \
        .mapInArrow(task, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("m"), "best"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select(
        "word", "n_near", (-F.col("b.m")).alias("best_n"), "b.best")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form (word, form)."""
    at = forms.toDF("word", "root")
    while True:
        at = written(at, "roots")
        step = at.toDF("root", "next")
        on = at.join(step, "root", "left")
        if on.where("next is not null").isEmpty():
            return at
        at = on.select("word", F.coalesce("next", "root").alias("root"))


def variants(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT,
             ratio: int = RATIO, slip: int = SLIP, tile: int = TILE) -> DataFrame:
    """Every word with its near words, form and root; see the module's text."""
    words = written(word_counts(docs, slip).where(
        (F.char_length("word") >= min_chars) & (F.col("n") >= min_count)), "words")
    near = near_words(words, min_chars, tile)
    has_form = F.col("best_n") >= F.col("n") * ratio
    joined = written(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(has_form, F.col("best")).alias("form"),
        F.when(has_form, F.col("best_n")).alias("form_n")), "near")
    roots = _roots(joined.where("form is not null").select("word", "form"))
    return joined.join(roots, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
