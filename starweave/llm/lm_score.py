"""Document scores by masked pseudo-likelihood of a bidirectional window network.

Tokens are the bytes of the text's UTF-8, so every character of every script has
a probability of its own.  Every byte is predicted from the ``WINDOW``
bytes on either side of it: their embeddings (one table per place) are
added, go through tanh and give a softmax over the byte values.

* Counting: all distinct windows of all documents with their counts, summed
  in each task and then by window.
* Training: the counted windows, in numpy.  They are dealt by hash to a fixed
  number of shards with a fixed order inside, so what is learned does not depend on
  partitions or executors.  In each round every shard
  starts from the current weights and takes Adam steps over its windows,
  weighted by count (``STEPS`` at least); the weights are averaged, weighted by the windows behind
  them.  Only the weights travel, 170 kB a shard.  Rounds go on until the loss
  falls by less than ``GAIN`` of itself.
* Scoring: the network's log-probability of every byte given both
  sides, summed by document.  A window is evaluated once and remembered in a
  table of fixed size.

Output, one row per input row: doc_id, n_tokens, log_prob (the sum),
mean_log_prob (by token; null without tokens).  n_tokens counts bytes.

Null or empty text: no tokens, log_prob 0.  Repeated and null doc_ids are
scored like any row.  An empty table gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, mix64, slices, take, written

WINDOW = 2         # bytes seen on each side
EDGE = 256         # the symbol beyond a text's ends
SIZE = 257
HIDDEN = 32
SHARDS = 8         # trainers
ROUNDS = 12        # at most
GAIN = 0.02        # share of the loss that a round must take away
BATCH = 256
STEPS = 100        # at least, of a trainer in a round: a small shard is gone over again
RATE = 0.01
SEED = 20
SLICE = 2 << 20    # bytes of text at once
TABLE_BITS = 20    # windows remembered by a task

_PLACES = [k for k in range(-WINDOW, WINDOW + 1)]


def token_bytes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """All bytes, the row of each, and the number in each row."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    sizes = [len(r) for r in raw]
    return np.frombuffer(b"".join(raw), np.uint8), np.repeat(np.arange(len(raw)), sizes), sizes


def window_codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """A code for the window around each byte, the byte's row, and bytes by row."""
    flat, row, sizes = token_bytes(texts)
    x = np.full(len(flat) + WINDOW * (len(texts) + 1), EDGE, np.int64)
    at = np.arange(len(flat)) + WINDOW * (row + 1)
    x[at] = flat
    code = np.zeros(len(flat), np.int64)
    for k in _PLACES:
        code = code * SIZE + x[at + k]
    return code, row, sizes


def unpack(codes: np.ndarray) -> np.ndarray:
    """The symbols of each window, a column per place."""
    out = np.empty((len(codes), len(_PLACES)), np.int64)
    for k in reversed(range(len(_PLACES))):
        out[:, k] = codes % SIZE
        codes = codes // SIZE
    return out


class Network:
    """Embeddings E (a table per seen place), bias b, output W and c."""

    def __init__(self, size: int, hidden: int = HIDDEN, seed: int = SEED):
        r = np.random.default_rng(seed)
        self.size = size
        self.weights = [
            r.normal(0, 0.3, (2 * WINDOW, size, hidden)).astype(np.float32),
            np.zeros(hidden, np.float32),
            r.normal(0, 0.1, (hidden, size)).astype(np.float32),
            np.zeros(size, np.float32)]

    def _forward(self, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        e, b, w, c = self.weights
        hidden = np.tanh(sum(e[k][seen[:, k]] for k in range(2 * WINDOW)) + b)
        logits = hidden @ w + c
        logits -= logits.max(axis=1, keepdims=True)
        return hidden, logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))

    def log_probs(self, windows: np.ndarray) -> np.ndarray:
        """Log-probability of the middle symbol of each window."""
        out = np.empty(len(windows), np.float64)
        for at in range(0, len(windows), 8192):
            part = windows[at:at + 8192]
            _, logs = self._forward(np.delete(part, WINDOW, axis=1))
            out[at:at + 8192] = logs[np.arange(len(part)), part[:, WINDOW]]
        return out

    def gradients(self, windows: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        """Of the weighted mean cross-entropy, which is left in ``loss``."""
        e, _, w, _ = self.weights
        seen, middle = np.delete(windows, WINDOW, axis=1), windows[:, WINDOW]
        hidden, logs = self._forward(seen)
        self.loss = -float(np.average(logs[np.arange(len(logs)), middle], weights=weight))
        d = np.exp(logs)
        d[np.arange(len(d)), middle] -= 1
        d *= (weight / weight.sum()).astype(np.float32)[:, None]
        back = (d @ w.T) * (1 - hidden ** 2)
        de = np.zeros_like(e)
        for k in range(2 * WINDOW):
            np.add.at(de[k], seen[:, k], back)
        return [de, back.sum(axis=0), hidden.T @ d, d.sum(axis=0)]


class Adam:
    def __init__(self, net: Network, rate: float):
        self.net, self.rate, self.t = net, rate, 0
        self.m = [np.zeros_like(w) for w in net.weights]
        self.v = [np.zeros_like(w) for w in net.weights]

    def step(self, windows: np.ndarray, weight: np.ndarray) -> None:
        self.t += 1
        rate = self.rate * np.sqrt(1 - 0.999 ** self.t) / (1 - 0.9 ** self.t)
        for w, g, m, v in zip(self.net.weights, self.net.gradients(windows, weight), self.m, self.v):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            w -= (rate * m / (np.sqrt(v) + 1e-8)).astype(np.float32)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    for batch in batches:
        for part in slices(batch, limit=SLICE):
            yield part, [t or "" for t in part.column("text").to_pylist()]


def count_windows(docs: DataFrame) -> DataFrame:
    """(code, n): every window of all documents with its count."""
    def task(batches):
        codes, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for _, texts in _texts(batches):
            new = np.sort(window_codes(texts)[0])
            edge = np.flatnonzero(np.concatenate([[True], new[1:] != new[:-1], [True]])) \
                if len(new) else np.zeros(1, np.int64)
            both = np.concatenate([codes, new[edge[:-1]]])
            n = np.concatenate([counts, np.diff(edge)])
            codes, place = np.unique(both, return_inverse=True)
            counts = np.bincount(place, n, len(codes)).astype(np.int64)
            if len(codes) > 1 << 21:
                yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(counts)], ["code", "n"])
                codes, counts = codes[:0], counts[:0]
        for at in range(0, len(codes), 1 << 16):
            yield pa.RecordBatch.from_arrays(
                [pa.array(codes[at:at + (1 << 16)]), pa.array(counts[at:at + (1 << 16)])],
                ["code", "n"])

    counted = take(docs, "text").mapInArrow(task, "code long, n long").groupBy("code") \
        .agg(F.sum("n").alias("n"))
    return written(counted, "windows")


_WEIGHTS = "shard int, n long, loss double, weights binary"


def train(windows: DataFrame, hidden: int = HIDDEN, rounds: int = ROUNDS, rate: float = RATE,
          seed: int = SEED, shards: int = SHARDS, gain: float = GAIN) -> Network:
    """The network after rounds of local steps and averaging."""
    net = Network(SIZE, hidden, seed)
    h = F.xxhash64("code")
    # One shard to a task, in an order that mixes its windows.
    dealt = windows.select("code", "n", F.pmod(h, F.lit(shards)).cast("int").alias("shard"),
                           h.alias("h")).repartitionById(shards, "shard") \
        .sortWithinPartitions("shard", "h", "code").drop("h")
    last = None
    for turn in range(rounds):
        start = net.weights
        speed = rate / (1 + turn)

        def task(batches):
            own = Network(SIZE, hidden, seed)
            own.weights = [w.copy() for w in start]
            steps, total, lost, shard = Adam(own, speed), 0, 0.0, None
            codes, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
            held, rows = [], 0

            def learn(final: bool):
                nonlocal codes, counts, total, lost, rows
                to = len(codes) if final else len(codes) - len(codes) % BATCH
                unpacked = unpack(codes[:to])
                for at in range(0, to, BATCH):
                    n = counts[at:min(at + BATCH, to)]
                    steps.step(unpacked[at:at + BATCH], n)
                    total += int(n.sum())
                    lost += own.loss * int(n.sum())
                if rows < STEPS * BATCH:
                    held.append((unpacked, counts[:to]))
                rows += to
                codes, counts = codes[to:], counts[to:]

            for batch in batches:
                shard = batch.column("shard")[0].as_py() if batch.num_rows else shard
                codes = np.concatenate([codes, batch.column("code").to_numpy()])
                counts = np.concatenate([counts, batch.column("n").to_numpy()])
                learn(False)
            learn(True)
            if 0 < rows < STEPS * BATCH:
                unpacked, counts = (np.concatenate(x) for x in zip(*held))
                while steps.t < STEPS:
                    for at in range(0, rows, BATCH):
                        steps.step(unpacked[at:at + BATCH], counts[at:at + BATCH])
            if total:
                flat = np.concatenate([w.ravel() for w in own.weights])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard], pa.int32()), pa.array([total], pa.int64()),
                     pa.array([lost]), pa.array([flat.tobytes()], pa.binary())],
                    ["shard", "n", "loss", "weights"])

        # A fixed number of rows, added up in a fixed order.
        parts = sorted(dealt.mapInArrow(task, _WEIGHTS).collect(), key=lambda r: r["shard"])
        total = sum(r["n"] for r in parts)
        if not total:
            break
        mean = (sum(np.frombuffer(r["weights"], np.float32).astype(np.float64) * r["n"]
                    for r in parts) / total).astype(np.float32)
        net.weights, at = [], 0
        for w in start:
            net.weights.append(mean[at:at + w.size].reshape(w.shape).copy())
            at += w.size
        loss = sum(r["loss"] for r in parts) / total
        if last is not None and loss > last * (1 - gain):
            break
        last = loss
    return net


class _Memory:
    """Log-probabilities by window: a table with one place per hash value."""

    def __init__(self, net: Network):
        self.net = net
        self.code = np.full(1 << TABLE_BITS, -1, np.int64)
        self.log = np.zeros(1 << TABLE_BITS, np.float64)

    def log_probs(self, codes: np.ndarray) -> np.ndarray:
        place = (mix64(codes.view(np.uint64)) >> np.uint64(64 - TABLE_BITS)).view(np.int64)
        out = self.log[place]
        missed = np.flatnonzero(self.code[place] != codes)
        if len(missed):
            new, which = np.unique(codes[missed], return_inverse=True)
            logs = self.net.log_probs(unpack(new))
            out[missed] = logs[which]
            place = (mix64(new.view(np.uint64)) >> np.uint64(64 - TABLE_BITS)).view(np.int64)
            self.code[place], self.log[place] = new, logs
            # Of windows with one place the last stays; its value is set by the same order.
        return out


def score(docs: DataFrame, net: Network) -> DataFrame:
    """doc_id, n_tokens, log_prob, mean_log_prob of every row."""
    def task(batches):
        memory = _Memory(net)
        for part, texts in _texts(batches):
            codes, row, sizes = window_codes(texts)
            sums = np.bincount(row, memory.log_probs(codes), len(texts))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(sizes, pa.int64()),
                 pa.array(sums, pa.float64())], ["doc_id", "n_tokens", "log_prob"])

    scored = take(docs, "doc_id", "text").mapInArrow(
        task, "doc_id long, n_tokens long, log_prob double")
    return scored.withColumn("mean_log_prob", F.when(
        F.col("n_tokens") > 0, F.col("log_prob") / F.col("n_tokens")))


def pseudo_likelihood(docs: DataFrame, hidden: int = HIDDEN, rounds: int = ROUNDS,
                      rate: float = RATE, seed: int = SEED, shards: int = SHARDS) -> DataFrame:
    """Train on all documents and score all documents."""
    windows = count_windows(docs)
    net = train(windows, hidden, rounds, rate, seed, shards)
    forget(windows)
    return score(docs, net)
