"""Language of texts by cross-parsing entropy.

For each language a suffix automaton is built from a sample of labelled text.
A text is parsed against it from left to right into phrases, each the longest
match that starts there (a character that the sample lacks is a phrase of its
own).  c phrases for N characters against a sample of n characters estimate
the cross-entropy c * log2(n) / N; the language with the least wins (ties: the
smaller name).

Letters are lower-cased, everything else counts as one space.  Whole texts
are parsed, in segments of ``SEGMENT`` characters, with all segments of a
batch stepping through the automata of all languages at once (numpy).

The sample is the model's documented bound: ``model_chars`` characters in all,
shared evenly between the languages, in windows of ``WINDOW_CHARS`` from the
documents whose ids hash lowest; letters beyond the ``ALPHABET`` most frequent
ones of the sample count as unknown.  So the model's size does not depend on
the input, and neither does the share of it that the driver sees.

Output, one row per input row: doc_id, lang_pred, score (1 minus the winner's
entropy over the runner-up's, 0 to 1; 1 if only one language was learned).

Null text and text without a letter: ``und`` with score 0; so is everything
if nothing was learned.  Languages are learned from rows with text and lang;
null doc_ids are parsed, but not learned from.  Repeated rows count as often
as they occur.  An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import code_points, slices, take

MODEL_CHARS = 1 << 17
WINDOW_CHARS = 256
ALPHABET = 126
SEGMENT = 512
SLICE = 2 << 20
UNDETERMINED = "und"

_POINTS = 1 << 16  # characters above count as unknown letters


def _fold(point: int) -> int:
    """0: no letter; else the lower-case character's number."""
    c = chr(point)
    if not c.isalpha():
        return 0
    low = c.lower()
    return ord(low) if len(low) == 1 and ord(low) < _POINTS else point


_FOLDED: list[np.ndarray] = []


def folded(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Folded characters (0: no letter) and the row of each; a run of
    non-letters is one."""
    if not _FOLDED:
        _FOLDED.append(np.array([_fold(p) for p in range(_POINTS)], np.uint32))
    flat, row = code_points(texts)
    low = _FOLDED[0][np.minimum(flat, _POINTS - 1)]
    for p in np.flatnonzero(flat >= _POINTS):
        low[p] = flat[p] if chr(flat[p]).isalpha() else 0
    keep = np.ones(len(low), bool)
    keep[1:] = (low[1:] != 0) | (low[:-1] != 0) | (row[1:] != row[:-1])
    return low[keep], row[keep]


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the states of the automaton of all substrings; state 0 is the root."""
    to: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in symbols:
        new = len(to)
        to.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in to[p]:
            to[p][c] = new
            p = link[p]
        if p >= 0:
            q = to[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(to)
                to.append(dict(to[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and to[p].get(c) == q:
                    to[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return to


_NEW = np.uint32(1 << 31)


class Model:
    """One table for all languages: from (state, symbol) to the next state,
    marked if a new phrase starts there.  Symbol 0 is an unknown letter, 1 no
    letter; states are stored as places of their rows."""

    def __init__(self, samples: dict[str, list[str]]):
        self.langs = sorted(samples)
        letters: Counter = Counter()
        texts = {}
        for lang in self.langs:
            low, _ = folded(samples[lang])
            texts[lang] = low
            points, n = np.unique(low[low > 0], return_counts=True)
            letters.update(dict(zip(points.tolist(), n.tolist())))
        top = sorted(letters, key=lambda p: (-letters[p], p))[:ALPHABET]
        self.width = len(top) + 2
        self.symbol = np.zeros(_POINTS, np.uint32)
        self.symbol[0] = 1
        for i, p in enumerate(sorted(p for p in top if p < _POINTS)):
            self.symbol[p] = i + 2
        rows, self.roots, self.bits = [], [], []
        base = 0
        for lang in self.langs:
            symbols = self._symbols(texts[lang])
            to = suffix_automaton(symbols[symbols > 0].tolist())
            table = np.zeros((len(to), self.width), np.uint32)
            alive = np.zeros((len(to), self.width), bool)
            for state, edges in enumerate(to):
                for c, target in edges.items():
                    table[state, c] = (base + target) * self.width
                    alive[state, c] = True
            # No match: a new phrase starts with this character, or after it.
            root = np.uint32(base * self.width)
            restart = np.where(alive[0], table[0], root) | _NEW
            table = np.where(alive, table, restart[None, :])
            table[0] = restart
            rows.append(table)
            self.roots.append(int(root))
            self.bits.append(float(np.log2(max(2, len(symbols)))))
            base += len(to)
        self.table = np.concatenate(rows).ravel() if rows else np.zeros(0, np.uint32)

    def _symbols(self, low: np.ndarray) -> np.ndarray:
        return np.where(low < _POINTS, self.symbol[np.minimum(low, _POINTS - 1)], 0)

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(languages x rows) cross-entropies, and which rows have a letter."""
        low, row = folded(texts)
        n = np.bincount(row, minlength=len(texts))
        lettered = np.bincount(row, low > 0, len(texts)) > 0
        symbols = self._symbols(low).astype(np.uint32)
        # Segments: start, size and row, longest first.
        start_of = np.concatenate([[0], np.cumsum(n)[:-1]]).astype(np.int64)
        parts = -(-n // SEGMENT)
        owner = np.repeat(np.arange(len(texts)), parts)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
        start = start_of[owner] + nth * SEGMENT
        size = np.minimum(SEGMENT, n[owner] - nth * SEGMENT)
        order = np.argsort(-size, kind="stable")
        owner, start, size = owner[order], start[order], size[order]
        grid = np.zeros((SEGMENT, len(size)), np.uint32)
        for t in range(SEGMENT):
            k = int(np.searchsorted(-size, -t, "left"))  # segments longer than t
            grid[t, :k] = symbols[start[:k] + t]
        phrases = np.zeros((len(self.langs), len(size)), np.int64)
        for i, root in enumerate(self.roots):
            state = np.full(len(size), root, np.uint32)
            for t in range(SEGMENT):
                k = int(np.searchsorted(-size, -t, "left"))
                if not k:
                    break
                step = self.table[state[:k] + grid[t, :k]]
                phrases[i, :k] += step >> np.uint32(31)
                state = step & ~_NEW
        out = np.zeros((len(self.langs), len(texts)))
        for i in range(len(self.langs)):
            out[i] = np.bincount(owner, phrases[i], len(texts)) * self.bits[i] / np.maximum(n, 1)
        return out, lettered

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        if not self.langs:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        entropy, lettered = self.entropies(texts)
        best = entropy.argmin(axis=0)
        ranked = np.sort(entropy, axis=0)
        second = ranked[1] if len(self.langs) > 1 else np.full(len(texts), np.inf)
        sure = 1 - np.divide(ranked[0], second, out=np.ones(len(texts)), where=second > 0)
        return ([self.langs[b] if ok else UNDETERMINED for b, ok in zip(best, lettered)],
                np.where(lettered, sure, 0.0))


def learn(docs: DataFrame, model_chars: int = MODEL_CHARS) -> Model:
    """A model from the rows with text, lang and doc_id."""
    docs = take(docs, "doc_id", "text", "lang").where("lang is not null and doc_id is not null") \
        .where(F.col("text").rlike(r"\p{L}"))
    n = docs.select("lang").distinct().count()
    if not n:
        return Model({})
    each = max(1, model_chars // (n * WINDOW_CHARS))
    h = F.xxhash64("doc_id", F.lit(7))
    room = F.greatest(F.char_length("text") - WINDOW_CHARS, F.lit(0)) + 1
    sampled = docs.select("lang", "doc_id", h.alias("h"), F.substring(
        F.col("text"), (F.pmod(h, room) + 1).cast("int"), F.lit(WINDOW_CHARS)).alias("text"))
    # A rank filter: Spark keeps only the first rows of each task before it shuffles.
    lowest = Window.partitionBy("lang").orderBy("h", "doc_id", "text")
    sampled = sampled.withColumn("place", F.row_number().over(lowest)).where(F.col("place") <= each)
    samples: dict[str, list[str]] = {}
    for r in sampled.orderBy("lang", "place").collect():
        samples.setdefault(r["lang"], []).append(r["text"])
    return Model(samples)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred and score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, limit=SLICE):
                texts = [t or "" for t in part.column("text").to_pylist()]
                langs, sure = shared.value.predict(texts)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(langs, pa.string()), pa.array(sure)],
                    names=["doc_id", "lang_pred", "score"])

    return take(docs, "doc_id", "text").mapInArrow(
        task, "doc_id long, lang_pred string, score double")
