"""Near-duplicate documents by a chosen-path set similarity join.

A document's set is its distinct word shingles (A-Z lower-cased).  Documents
with equal sets form a class, so exact copies
never meet as pairs.  Each class has minwise tokens, which agree in two sets
with probability equal to their Jaccard similarity.

The join is a recursion over nodes, one level at a time for all trees:

* every class starts at the root of each tree; a node draws one or two minwise
  hash functions (1.25 on average) from its own name, so no two nodes of any
  trees share one, and its members go to the child node named by function and
  token;
* at a level, every node's members are first compared with the node's
  leader, which takes one pair a member however large the node is.  Links are
  confirmed on the full sets and joined into components;
* pairs inside a component add nothing, so a node whose members are all in
  one component ends there;
* of the others, a node with at most ``limit`` members outside its leader's
  component is small: those are compared with all members of other
  components, by a join that emits close pairs only, and confirmed;
* a node with more, but at most ``node_shingles`` shingles in all and ``node_work``
  comparisons of them, is compared exhaustively by one task on the full sets,
  which returns only links that join components, fewer than it has members;
* a larger node branches again.  At the last level it counts as small, so no
  node is given up.

A pair of members first meets 128 one-bit tokens in two longs (a native
expression; a pair at the threshold fails it with a chance of 2.7e-6, sets of
few shingles too), then the full sets.  The trees are independent: one tree loses a pair at the
threshold with the chance ``lost(depth)`` (0.16 at depth 1, 0.27 at 2, 0.48 at
5, 0.73 at 16), so ``trees`` trees are enough for a chance of ``MISS`` at depth 2.
Where nodes branched more often, their members go through further trees, until
there are as many as the depth reached needs (``trees_for``: 12 at depth 3, 36
at 16).

The first tree's leaders go before all others, so most copies are in one component
before further trees are looked at.  A node's rows are dealt out where they are many, and
every intermediate table is deleted once the next one is committed.

Output, one row per input row: doc_id, n_shingles, component_id (smallest
doc_id reachable, itself included), kept (doc_id = component_id), text_key
(xxhash64 of the text) and group_id (a number for the component; null where the
set is empty), which tell apart texts that share a doc_id.

Null text, no words: an empty set, linked with nothing, kept.  Fewer words
than a shingle: the whole sequence is the one shingle.  Repeated doc_ids: a row
each, by its own text; equal ids alone link nothing.  A null doc_id takes the component of an
equal text that has an id, else null; it is kept if that is null too.  An
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (SOLID, by_key, flat, forget, gram_hashes, mix64, release_memory, seeds64,
                     slices, take, word_hashes, word_spans, written)
from .components import extended

SHINGLE = 5
THRESHOLD = 80      # percent
TREES = 10          # at least; see trees_for()
MISS = 1e-5         # chance that a pair at the threshold meets in no tree
LIMIT = 64          # members outside the leader's component, compared by a join
NODE_SHINGLES = 2_000_000  # of a node compared in one task (16 MB)
NODE_WORK = 1 << 30  # members outside the leader's component times shingles, likewise
SALT_ROWS = 4096     # members of a node in one share of a join
LEVELS = 16
TOKENS = 128        # minwise tokens of a set, of which one bit is kept
POSITIONS = 32      # columns of a table of tokens for children()
MAX_DIFFERENT = 30  # one-bit tokens that may differ: 12.8 expected at 80 percent, sd 3.4
BROADCAST_IDS = 1 << 20  # doc_ids (8 MB) broadcast to pick texts; beyond, a shuffled join

_TOKEN_SEEDS = (seeds64(TOKENS, 11) >> np.uint64(32)).astype(np.uint32)
_TOKEN_FACTORS = (seeds64(TOKENS, 12) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def shingle_sets(batch: pa.RecordBatch, k: int) -> Iterator[np.ndarray]:
    """The distinct shingle hashes of every row, ascending."""
    for part in slices(batch):
        data, off = flat(part.column("text"))
        start, end, row = word_spans(data, off, SOLID)
        words = word_hashes(data, start, end)
        grams = gram_hashes(words, k)
        edge = np.searchsorted(row, np.arange(part.num_rows + 1))
        for a, b in zip(edge[:-1], edge[1:]):
            if b - a >= k:
                yield np.unique(grams[a:b - k + 1])
            elif b > a:
                yield gram_hashes(words[a:b], b - a)
            else:
                yield grams[:0]


def minwise(shingles: np.ndarray) -> np.ndarray:
    """``TOKENS`` minwise tokens of a non-empty set.  They are mixed to the
    last bit, so that two different shingles differ there at every second
    position, whatever they are."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(TOKENS, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 512):
        v = (x[None, at:at + 512] ^ _TOKEN_SEEDS[:, None]) * _TOKEN_FACTORS[:, None]
        v ^= v >> np.uint32(16)
        v *= np.uint32(0x7FEB352D)
        v ^= v >> np.uint32(15)
        v *= np.uint32(0x846CA68B)
        v ^= v >> np.uint32(16)
        np.minimum(out, v.min(axis=1), out=out)
    return out


def node_tokens(shingles: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """The minwise token of a non-empty set by the hash function of each seed."""
    out = np.full(len(seeds), 0xFFFFFFFFFFFFFFFF, np.uint64)
    for at in range(0, len(shingles), 4096):
        v = mix64(shingles[None, at:at + 4096] ^ seeds[:, None])
        np.minimum(out, v.min(axis=1), out=out)
    return out


def children(nodes: np.ndarray, tokens: np.ndarray | Callable[[np.ndarray], np.ndarray]
             ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row indexes, child nodes) of members of ``nodes``: every node draws
    one hash function (a seed), every fourth a second.  ``tokens`` gives the
    tokens by seeds, or is a table with a row per member, whose columns stand
    for the seeds."""
    rows = np.arange(len(nodes))
    for turn in range(2):
        if turn:
            rows = np.flatnonzero(mix64(nodes ^ np.uint64(0x5EED)) & np.uint64(3) == 0)
        seed = mix64(nodes[rows] * np.uint64(2) + np.uint64(turn + 1))
        token = tokens(seed) if callable(tokens) else tokens[
            rows, (seed % np.uint64(tokens.shape[1])).astype(np.int64)].astype(np.uint64)
        yield rows, mix64(nodes[rows] ^ mix64(seed ^ token))


def grown(nodes: np.ndarray, shingles: np.ndarray) -> np.ndarray:
    """The children that a member of ``nodes`` with this non-empty set goes to."""
    return np.concatenate([child for _, child in children(
        nodes, lambda seeds: node_tokens(shingles, seeds))])


def lost(depth: int, threshold: int = THRESHOLD) -> float:
    """Chance that a pair at the threshold sits together in none of one
    tree's nodes of this depth (1: children of the root)."""
    chance, j = 0.0, threshold / 100
    for _ in range(depth):
        apart = 1 - j + j * chance  # in one child, or in all nodes below it
        chance = 0.75 * apart + 0.25 * apart ** 2
    return chance


def trees_for(depth: int, threshold: int = THRESHOLD, miss: float = MISS) -> int:
    """Independent trees that together lose such a pair with at most ``miss``."""
    chance = lost(depth, threshold)
    return math.ceil(math.log(miss) / math.log(chance)) if chance > 0 else 1


_SIGNED = ("doc_id long, text_key long, n_shingles long, digest binary, nodes array<long>, "
           "s1 long, s2 long")


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _signatures(docs: DataFrame, k: int, trees: int) -> DataFrame:
    """Per document: set size, digest of the set, nodes of the first level, bits."""
    roots = seeds64(trees, 21)

    def task(batches):
        for batch in batches:
            n, digest, nodes, bits = [], [], [], [[], []]
            for s in shingle_sets(batch, k):
                n.append(len(s))
                if len(s):
                    digest.append(_digest(s))
                    nodes.append(grown(roots, s).view(np.int64))
                    least = minwise(s)
                    halves = np.packbits((least & 1).astype(bool)).view(np.int64).tolist()
                else:
                    digest.append(None)
                    nodes.append(None)
                    halves = (None, None)
                for b, h in zip(bits, halves):
                    b.append(h)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(n, pa.int64()), pa.array(digest, pa.binary()),
                 pa.array(nodes, pa.list_(pa.int64())), *(pa.array(b, pa.int64()) for b in bits)],
                names=["doc_id", "text_key", "n_shingles", "digest", "nodes", "s1", "s2"])
        release_memory()

    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_key")).mapInArrow(
        task, _SIGNED)


_MEMBER = ("n", "s1", "s2")


def _texts_of(docs: DataFrame, classes: DataFrame, broadcast_ids: int) -> DataFrame:
    """The texts of some classes: rows of ``docs`` with the doc_id that stands for
    a class, and the class's columns.  Other texts with that doc_id come along; the
    digest tells them apart."""
    few = classes.count() <= broadcast_ids
    return docs.join(F.broadcast(classes) if few else classes.hint("merge"), "doc_id")


def _own_sets(batch: pa.RecordBatch, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, set) of the rows whose text is the class's."""
    digests = batch.column("digest").to_pylist()
    for i, (s, digest) in enumerate(zip(shingle_sets(batch, k), digests)):
        if len(s) and _digest(s) == digest:
            yield i, s


def _branch(lists: DataFrame, classes: DataFrame, texts: DataFrame, k: int, broadcast_ids: int
            ) -> DataFrame:
    """The next frontier (node, doc), from the nodes (an array) of each class."""
    own = classes.select("doc", "doc_id", "digest").join(lists, "doc")
    own = written(own, "lists")

    def task(batches):
        for batch in batches:
            rows, nodes = [], []
            for i, s in _own_sets(batch, k):
                rows.append(i)
                nodes.append(grown(batch.column("nodes")[i].values.to_numpy().view(np.uint64), s)
                             .view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.list_(pa.int64())),
                 batch.column("doc").take(pa.array(rows, pa.int64()))], names=["nodes", "doc"])

    found = _texts_of(texts, own, broadcast_ids).mapInArrow(task, "nodes array<long>, doc long")
    frontier = written(found.select(F.explode("nodes").alias("node"), "doc"), "frontier")
    forget(own)
    return frontier


def _close(a1, a2, b1, b2):
    return F.bit_count(a1.bitwiseXOR(b1)) + F.bit_count(a2.bitwiseXOR(b2)) <= MAX_DIFFERENT


def _sets(ids: DataFrame, classes: DataFrame, docs: DataFrame, k: int, broadcast_ids: int
          ) -> DataFrame:
    """(doc, shingles) of the classes with these ids (distinct doc)."""
    own = written(ids.join(classes.select("doc", "doc_id", "digest"), "doc"), "ids")

    def task(batches):
        for batch in batches:
            found = list(_own_sets(batch, k))
            rows, sets = zip(*found) if found else ((), ())
            at = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
            values = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc").take(pa.array(rows, pa.int64())),
                 pa.ListArray.from_arrays(pa.array(at), pa.array(values))],
                names=["doc", "shingles"])
        release_memory()

    sets = written(_texts_of(docs, own, broadcast_ids).mapInArrow(
        task, "doc long, shingles array<long>"), "sets")
    forget(own)
    return sets


def _confirmed(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    both = pairs.join(sets.toDF("b", "sb"), "b").join(sets.toDF("a", "sa"), "a") \
        .select("a", "b", (F.size("sa") + F.size("sb")).alias("sizes"),
                F.size(F.array_intersect("sa", "sb")).alias("same"))
    return both.where(F.col("same") * 100 >= (F.col("sizes") - F.col("same")) * threshold) \
        .select("a", "b").distinct()


def node_links(docs: list[int], states: list[int], sets: list[np.ndarray], threshold: int
               ) -> list[tuple[int, int]]:
    """Links that join the components ``states`` of a node's members, found
    by comparing every member outside the largest component with all others
    (one that has joined it meanwhile needs no turn: the others have theirs)."""
    names, comp = np.unique(np.array(states), return_inverse=True)
    sizes = np.array([len(s) for s in sets])
    values, place = np.unique(np.concatenate(sets), return_inverse=True)
    place = place.astype(np.int32)
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    mark = np.zeros(len(values), np.int32)
    top = list(range(len(names)))  # a forest over the components

    def find(i: int) -> int:
        while top[i] != i:
            top[i] = top[top[i]]
            i = top[i]
        return i

    links = []
    largest = np.bincount(comp).argmax()
    for x in np.flatnonzero(comp != largest):
        if find(comp[x]) == find(largest):
            continue
        own = place[first[x]:first[x] + sizes[x]]
        mark[own] = 1
        same = np.add.reduceat(mark[place], first)
        mark[own] = 0
        for y in np.flatnonzero(100 * same >= threshold * (sizes + sizes[x] - same)):
            i, j = find(comp[x]), find(comp[y])
            if i != j:
                top[i] = j
                links.append((min(docs[x], docs[y]), max(docs[x], docs[y])))
    return links


def _node_links(rows: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Links inside whole nodes (node, doc, c), each compared by one task."""
    grouped = rows.join(sets, "doc") \
        .select("node", "doc", "c", "shingles").repartition("node") \
        .sortWithinPartitions("node", "doc")

    def task(batches):
        node, held = None, ([], [], [])
        for batch in batches:
            at, values = batch.column("shingles").offsets.to_numpy(), \
                batch.column("shingles").values.to_numpy()
            for i, (n, doc, c) in enumerate(zip(*(batch.column(x).to_pylist()
                                                  for x in ("node", "doc", "c")))):
                if n != node:
                    if held[0]:
                        yield from found(held)
                    node, held = n, ([], [], [])
                held[0].append(doc)
                held[1].append(c)
                held[2].append(values[at[i]:at[i + 1]])
        if held[0]:
            yield from found(held)

    def found(held):
        links = node_links(*held, threshold)
        if links:
            a, b = zip(*links)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                                             names=["a", "b"])

    return grouped.mapInArrow(task, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, threshold: int = THRESHOLD,
                    trees: int = TREES, limit: int = LIMIT, node_shingles: int = NODE_SHINGLES,
                    levels: int = LEVELS, broadcast_ids: int = BROADCAST_IDS,
                    node_work: int = NODE_WORK, salt_rows: int = SALT_ROWS) -> DataFrame:
    """One row per document with its component; see the module's text."""
    docs = take(docs, "doc_id", "text")
    trees = max(trees, trees_for(1, threshold))
    signed = written(_signatures(docs, shingle, trees), "signatures")
    # A class's own number (doc) stands for it: several texts may have one doc_id.
    named = written(signed.where(F.col("digest").isNotNull()).groupBy("digest").agg(
        F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("rows"),
        F.first("n_shingles").alias("n"), F.first("nodes").alias("nodes"),
        F.first("s1").alias("s1"), F.first("s2").alias("s2")).withColumn(
        "doc", F.monotonically_increasing_id()), "classes")
    classes = named.where(F.col("doc_id").isNotNull())
    texts = docs.where(F.col("doc_id").isNotNull())

    joined: DataFrame | None = None  # doc, component
    checked: DataFrame | None = None

    def link(found: DataFrame) -> None:
        nonlocal joined
        found = written(found, "links")
        if not found.isEmpty():
            before, joined = joined, written(extended(joined, found), "joined")
            forget(before)
        forget(found)

    def sets_of(ids: DataFrame) -> DataFrame:
        return _sets(ids.distinct(), classes, texts, shingle, broadcast_ids)

    def examine(pairs: DataFrame) -> None:
        """Confirm pairs that no level has looked at, and join their components."""
        nonlocal checked
        pairs = pairs.distinct()
        if checked is not None:
            pairs = pairs.join(checked, ["a", "b"], "left_anti")
        pairs = written(pairs, "pairs")
        if not pairs.isEmpty():
            checked = pairs if checked is None else checked.unionByName(pairs)
            sets = sets_of(pairs.select(F.explode(F.array("a", "b")).alias("doc")))
            link(_confirmed(pairs, sets, threshold))
            forget(sets)

    def with_component(rows: DataFrame) -> DataFrame:
        if joined is None:
            return rows.withColumn("c", F.col("doc"))
        return rows.join(joined, "doc", "left").withColumn(
            "c", F.coalesce("component", "doc")).drop("component")

    def members_of(frontier: DataFrame, pick) -> DataFrame:
        """The members of nodes that hold several components, each with its
        node's size, shingles and leader."""
        rows = written(with_component(frontier), "rows")
        nodes = written(rows.groupBy("node").agg(
            F.count(F.lit(1)).alias("rows"), F.min("c").alias("low"), F.max("c").alias("high"))
            .where("low < high").select("node", "rows", F.col("rows").alias("size")), "nodes")
        inside = written(by_key(rows, nodes, "node").join(
            classes.select("doc", *_MEMBER), "doc"), "inside")
        leads = written(inside.groupBy("node").agg(
            F.count(F.lit(1)).alias("rows"), F.sum("n").alias("shingles"),
            pick(F.struct("doc", "s1", "s2", "c")).alias("lead")), "leads")
        members = written(by_key(inside.drop("n"), leads, "node"), "members")
        forget(rows, nodes, inside, leads)
        return members

    def meet_leaders(members: DataFrame) -> None:
        examine(members.where(F.col("c") != F.col("lead.c")).where(
            _close(F.col("s1"), F.col("s2"), F.col("lead.s1"), F.col("lead.s2"))).select(
            F.least("doc", "lead.doc").alias("a"), F.greatest("doc", "lead.doc").alias("b")))

    # The first tree's leaders alone join most copies, which then meet no other tree's.
    first = members_of(classes.select(F.col("nodes")[0].alias("node"), "doc"), F.min)
    meet_leaders(first)
    forget(first)

    frontier = classes.select(F.explode("nodes").alias("node"), "doc")
    deep: DataFrame | None = None  # classes whose nodes branched
    reached = 1  # depth of the deepest nodes
    while True:
        for level in range(levels):
            last = level == levels - 1
            pick = F.max if level % 2 == 0 else F.min  # another leader than a level before
            members = members_of(frontier, pick)
            forget(frontier)
            meet_leaders(members)

            rows = with_component(members.drop("c").withColumn(
                "leads", F.col("doc") == F.col("lead.doc")).drop("lead"))
            states = rows.groupBy("node").agg(
                F.count(F.lit(1)).alias("rows"), F.min("c").alias("low"), F.max("c").alias("high"),
                F.max(F.when(F.col("leads"), F.col("c"))).alias("lead_c"))
            states = written(states.where("low < high").select("node", "rows", "lead_c"), "states")
            open_rows = written(by_key(rows, states, "node").select(
                "node", "doc", "size", "shingles", "s1", "s2", "c",
                (F.col("c") != F.col("lead_c")).alias("far")), "open")
            counts = written(open_rows.where("far").groupBy("node", "size", "shingles").agg(
                F.count(F.lit(1)).alias("outside")), "counts")
            is_small = F.col("outside") <= limit
            whole = ~is_small & (F.col("shingles") <= node_shingles) & (
                F.col("outside") * F.col("shingles") <= node_work)
            if last:
                is_small = is_small | ~whole

            # A large node's members are dealt out; those outside go to every share.
            shares = F.ceil(F.col("size") / salt_rows).cast("int")
            salt = F.pmod(F.xxhash64("doc"), shares).cast("int").alias("salt")
            far = open_rows.where("far").join(counts.where(is_small).select("node"), "node",
                                              "left_semi").select(
                "node", F.col("doc").alias("x"), F.col("c").alias("xc"),
                F.col("s1").alias("x1"), F.col("s2").alias("x2"),
                F.explode(F.sequence(F.lit(0), shares - 1)).alias("salt"))
            met = far.join(open_rows.select("*", salt), ["node", "salt"]).where(
                (F.col("c") != F.col("xc")) & (~F.col("far") | (F.col("doc") < F.col("x")))
                & _close(F.col("s1"), F.col("s2"), F.col("x1"), F.col("x2")))
            examine(met.select(F.least("doc", "x").alias("a"), F.greatest("doc", "x").alias("b")))

            rest = written(open_rows.select("node", "doc", "c").join(
                counts.where(~is_small).select("node", whole.alias("whole")), "node"), "rest")
            forget(members, states, open_rows, counts)
            if rest.isEmpty():
                forget(rest)
                break
            in_task = rest.where("whole").drop("whole")
            if not in_task.isEmpty():
                sets = sets_of(in_task.select("doc"))
                link(_node_links(in_task, sets, threshold))
                forget(sets)
            large = rest.where("not whole")
            if last or large.isEmpty():
                forget(rest)
                break
            branched = large.select("doc").distinct()
            deep = written(branched if deep is None else deep.unionByName(branched).distinct(), "deep")
            reached = max(reached, level + 2)
            lists = large.groupBy("doc").agg(F.collect_list("node").alias("nodes"))
            frontier = _branch(lists, classes, texts, shingle, broadcast_ids)
            forget(rest)
        # A pair's nodes can only have branched where both of its documents were.
        more = trees_for(reached, threshold) - trees
        if deep is None or more <= 0:
            break
        roots = F.array(*[F.lit(int(r)) for r in seeds64(trees + more, 21)[trees:].view(np.int64)])
        frontier = _branch(deep.withColumn("nodes", roots), classes, texts, shingle, broadcast_ids)
        trees += more

    of_class = with_component(named.select("doc", "doc_id", "digest", "rows"))
    least = of_class.groupBy("c").agg(F.min("doc_id").alias("component_id"))
    of_class = written(of_class.join(least, "c").select(
        "digest", "rows", "component_id", F.col("c").alias("group_id")), "of-class")
    plain = signed.select("doc_id", "n_shingles", "digest", "text_key")
    empty = plain.where(F.col("digest").isNull()).withColumn(
        "component_id", F.col("doc_id")).withColumn("group_id", F.lit(None).cast("long"))
    out = by_key(plain.where(F.col("digest").isNotNull()), of_class, "digest").unionByName(empty)
    forget(named, joined)
    return out.select("doc_id", "n_shingles", "component_id",
                      F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
                      "text_key", "group_id")
