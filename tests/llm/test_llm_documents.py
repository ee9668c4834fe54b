"""Near-duplicates, line dedup, quality rules and decontamination against
brute force on hard rows, and all queries with SQL against DuckDB."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from llm_hard import SF_SMALL, edited, hard, nothing, prose  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st
from oracle import compare, duck

from starweave.llm import components, decontaminate, line_dedup, near_dup, quality, queries

SOLID = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    got = compare(queries.queries()[name](spark, SF_SMALL), duck(SF_SMALL),
                  queries.oracle_sql()[name])
    assert got["ok"], got


# -- near-duplicates ---------------------------------------------------------

def shingles(text, k) -> frozenset:
    words = SOLID.findall(lower(text or ""))
    if len(words) < k:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i:i + k]) for i in range(len(words) - k + 1))


def groups(docs: dict, k: int, threshold: int) -> dict:
    sets = {d: shingles(t, k) for d, t in docs.items()}
    top = {d: d for d in docs}

    def find(d):
        while top[d] != d:
            d = top[d]
        return d

    for a, b in combinations(sorted(docs), 2):
        same = len(sets[a] & sets[b])
        if same and 100 * same >= threshold * (len(sets[a]) + len(sets[b]) - same):
            a, b = find(a), find(b)
            top[max(a, b)] = min(a, b)
    return {d: (len(sets[d]), find(d)) for d in docs}


@pytest.mark.parametrize("shingle", [4, 5])
def test_near_duplicates_hard_rows(hard, nothing, shingle):
    rows = near_dup.near_duplicates(hard, shingle=shingle).collect()
    want = groups({r["doc_id"]: r["text"] for r in hard.collect() if r["doc_id"] is not None},
                  shingle, 80)
    assert len(rows) == hard.count()
    for r in rows:
        if r["doc_id"] is not None:
            assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]]
            assert r["kept"] == (r["component_id"] == r["doc_id"])
    unnamed = sorted((r["n_shingles"], r["component_id"], r["kept"]) for r in rows
                     if r["doc_id"] is None)
    assert unnamed[0] == (0, None, True) and unnamed[1][1:] == (want[7][1], False)
    assert near_dup.near_duplicates(nothing).count() == 0


def test_texts_that_share_a_doc_id_keep_their_links(spark):
    from corpus_pipeline import drop_near_duplicates
    a, b = prose(1, 120), prose(2, 120)
    rows = [(1, a), (1, b), (2, edited(b, 3, 0.01)), (3, edited(a, 4, 0.01)), (4, prose(5, 60)),
            (5, a + " one more"), (5, prose(6, 80)), (6, ""), (6, ""), (6, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {(r["doc_id"], r["text_key"]): r["component_id"]
           for r in near_dup.near_duplicates(df, shingle=4).collect()}
    key = {r["text"]: r["k"] for r in df.selectExpr("text", "xxhash64(text) AS k").collect()}
    want = [1, 1, 1, 1, 4, 1, 5, 6, 6, 6]
    assert got == {(d, key[t]): c for (d, t), c in zip(rows, want)}
    kept = sorted((r["doc_id"], r["text"] or "") for r in drop_near_duplicates(spark, df, "").collect())
    # Both texts of 1 and the unlinked one of 5 stay; equal rows are one.
    assert kept == sorted([(1, a), (1, b), (4, prose(5, 60)), (5, prose(6, 80)), (6, ""), (6, "")])


def _copies(n: int, share: float):
    from random import Random
    rnd = Random(5)
    base = [f"w{rnd.randint(0, 400)}" for _ in range(80)]
    docs = {}
    for i in range(n):
        words = [f"e{i}_{j}" if rnd.random() < share else w for j, w in enumerate(base)]
        docs[i] = " ".join(words)
    return docs


@pytest.mark.parametrize("way", [{"limit": 1000}, {"limit": 2}, {"limit": 2, "node_shingles": 10},
                                 {"limit": 2, "node_shingles": 10, "levels": 2},
                                 {"limit": 2, "broadcast_ids": 0}])
def test_a_large_group_by_every_way(spark, way):
    # Copies at about the threshold to each other: links, non-links and chains.
    docs = _copies(60, 0.022)
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    want = groups(docs, 4, 80)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"])
           for r in near_dup.near_duplicates(df, shingle=4, **way).collect()}
    assert 1 < len({c for _, c in want.values()}) < 60
    assert got == want


def test_recall_of_one_level():
    """Pairs at the threshold meet in a node of the first level."""
    rng = np.random.default_rng(3)
    missed = 0
    for _ in range(200):
        values = rng.integers(0, 1 << 63, 110, dtype=np.uint64)
        a, b = np.unique(values[:100]), np.unique(values[10:])  # 90 of 110
        nodes = []
        for s in (a, b):
            tokens = near_dup.minwise(s)[None, :near_dup.POSITIONS]
            nodes.append({int(c[0]) for root in near_dup.seeds64(near_dup.TREES, 21)
                          for r, c in near_dup.children(np.array([root]), tokens) if len(r)})
        missed += not nodes[0] & nodes[1]
    assert missed == 0


@pytest.mark.parametrize("depth", [1, 3, 6])
def test_recall_of_nodes_that_branch(depth):
    """Pairs at the threshold share nodes of any depth as often as the trees
    are counted to, and a set's trees are independent of each other."""
    rng = np.random.default_rng(depth)
    trees = near_dup.trees_for(depth, miss=0.01)
    roots = near_dup.seeds64(trees, 21)
    apart, single, pairs = 0, 0, 300
    for _ in range(pairs):
        values = rng.integers(0, 1 << 63, 100, dtype=np.uint64)
        a, b = values[:90], values[10:]  # 80 of 100
        met = 0
        for root in roots:
            nodes = [np.array([root]), np.array([root])]
            for _ in range(depth):
                nodes = [near_dup.grown(n, s) if len(n) else n for n, s in zip(nodes, (a, b))]
                nodes = [np.intersect1d(*nodes)] * 2
            met += len(nodes[0]) > 0
        apart += not met
        single += trees - met
    assert apart <= 10  # 3 expected at most
    assert abs(single / (pairs * trees) - near_dup.lost(depth)) < 0.06


def test_more_trees_for_nodes_that_branched(spark, monkeypatch):
    """The forest grows with the depth that a node really reached."""
    grown, plain = [], near_dup._branch
    monkeypatch.setattr(near_dup, "_branch",
                        lambda lists, *a: grown.append(lists) or plain(lists, *a))
    docs = _copies(60, 0.022)
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    found = near_dup.near_duplicates(df, shingle=4, limit=2, node_shingles=10, levels=3)
    want = groups(docs, 4, 80)
    assert {r["doc_id"]: r["component_id"] for r in found.collect()} == {
        d: c for d, (_, c) in want.items()}
    added = {r["n"] for r in grown[2].selectExpr("size(nodes) AS n").distinct().collect()}
    assert added == {near_dup.trees_for(3) - near_dup.TREES} == {2}


def test_minwise_tokens_agree_like_the_sets():
    rng = np.random.default_rng(4)
    values = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    agree = np.mean([np.mean(near_dup.minwise(values[i:i + 900]) ==
                             near_dup.minwise(values[i + 300:i + 1200]))
                     for i in range(0, 1500, 100)])
    assert abs(agree - 0.5) < 0.05  # 600 of 1200


@pytest.mark.parametrize("same,all_", [(4, 5), (8, 10), (12, 15)])
def test_bits_of_short_sets_pass_the_filter(same, all_):
    """The one-bit tokens of true links differ like independent coins: in a
    tenth of the positions, with the spread of a binomial."""
    rng = np.random.default_rng(all_)
    differ = []
    for _ in range(3000):
        values = rng.integers(0, 1 << 63, all_, dtype=np.uint64)
        bits = [near_dup.minwise(s) & 1 for s in (values, values[:same])]
        differ.append(np.count_nonzero(bits[0] != bits[1]))
    assert max(differ) <= near_dup.MAX_DIFFERENT
    assert abs(np.mean(differ) - 12.8) < 0.5 and np.std(differ) < 3.8


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=40))
def test_components(spark, pairs):
    top = {}
    for a, b in pairs:
        if a != b:
            group = min(top.get(a, a), top.get(b, b))
            old = {top.setdefault(a, a), top.setdefault(b, b)}
            for k, v in top.items():
                if v in old:
                    top[k] = group
    df = spark.createDataFrame(pairs, "a long, b long")
    assert {r["doc"]: r["component"] for r in components.components(df).collect()} == top


def test_components_of_a_long_chain(spark):
    df = spark.range(300).selectExpr("id AS a", "id + 1 AS b")
    rows = components.components(df).collect()
    assert len(rows) == 301 and {r["component"] for r in rows} == {0}


# -- line dedup --------------------------------------------------------------

def line_brute(rows, min_chars, min_docs):
    key = lambda x: lower(x.strip(" \t\n\x0b\x0c\r"))
    holders: dict = {}
    for doc, text in rows:
        for x in (text or "").split("\n"):
            if len(key(x)) >= min_chars:
                holders.setdefault(key(x), set()).add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        lost = [len(h := holders.get(key(x), ())) >= min_docs
                and doc != max((d for d in h if d is not None), default=doc) for x in lines]
        out.append((doc, "\n".join(x for x, y in zip(lines, lost) if not y), len(lines), sum(lost)))
    return Counter(out)


@pytest.mark.parametrize("batches,fanout", [(1, 2), (3, 2), (5, 3)])
def test_line_dedup_hard_rows(hard, nothing, batches, fanout):
    rows = [(r["doc_id"], r["text"]) for r in hard.collect()]
    for min_chars, min_docs in ((40, 5), (10, 2)):
        got = line_dedup.dedup(hard, min_chars, min_docs, batches, fanout)
        assert got.columns == [*hard.columns, "n_lines_", "n_dropped"]
        assert Counter((r["doc_id"], r["text"], r["n_lines_"], r["n_dropped"])
                       for r in got.collect()) == line_brute(rows, min_chars, min_docs)
    assert line_dedup.dedup(nothing).count() == 0


def test_line_dedup_without_room_to_broadcast(hard):
    rows = [(r["doc_id"], r["text"]) for r in hard.collect()]
    got = line_dedup.dedup(hard, 10, 2, broadcast_bytes=0)
    assert "BroadcastHashJoin" not in got._jdf.queryExecution().executedPlan().toString()
    assert Counter((r["doc_id"], r["text"], r["n_lines_"], r["n_dropped"])
                   for r in got.collect()) == line_brute(rows, 10, 2)


def test_runs_are_levelled_sorted_and_hold_a_key_once(spark):
    runs = line_dedup.LineRuns(spark, fanout=2)
    assert runs.totals() is None
    for b in range(5):
        batch = spark.createDataFrame([(bytes([k]), b) for k in range(b, b + 4)],
                                      "h binary, doc_id long")
        runs.add(batch)
    assert [len(x) for x in runs.levels] == [1, 0, 1]
    total = {r["h"][0]: (r["docs"], r["last"]) for r in runs.totals().collect()}
    assert total == {k: (sum(b <= k < b + 4 for b in range(5)), max(b for b in range(5) if b <= k < b + 4))
                     for k in range(8)}
    # The anti-join keeps a key out of all later runs; what it kept out was added.
    rows = runs._rows(runs.paths())
    assert rows.count() == rows.select("h").distinct().count() == 8
    assert len(runs.later) == 1 and runs._rows(runs.later).count() == 6
    for path in runs.paths():
        for part in spark.read.parquet(path).rdd.mapPartitions(lambda it: [[r["h"] for r in it]]).collect():
            assert part == sorted(part)


# -- quality rules -----------------------------------------------------------

def quality_brute(text):
    t = text or ""
    words = SOLID.findall(t)
    lines = [x for x in t.split("\n") if SOLID.search(x)]
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1
               for j in range(3)}
    return (len(words), sum(map(len, words)), sum(t.count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(covered))


def test_quality_hard_rows(hard, nothing):
    got = quality.judge(hard)
    assert got.columns == [*hard.columns, "quality_"]
    for r in got.collect():
        q = r["quality_"]
        counts = tuple(q[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines",
                                      "n_repeat_words"))
        assert counts == quality_brute(r["text"]), r["doc_id"]
        assert q["base_failed"] == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0])
        assert q["kept"] == (not q["failed"]) and not (q["base_failed"] and q["kept"])
    assert quality.judge(nothing).count() == 0


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab \n\t#|é"), max_size=60), min_size=1, max_size=8))
def test_quality_counts(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for r in quality.judge(df).collect():
        q = r["quality"]
        assert tuple(q[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines",
                                    "n_repeat_words")) == quality_brute(r["text"])


def test_quality_is_one_projection(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    plan = quality.judge(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange|Join|Aggregate|Generate", plan)


def test_the_filter_stays_above_the_projection(spark, hard):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    plan = quality.good_documents(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Filter") < plan.index("sort_array") and plan.count("sort_array") == 1
    kept = quality.judge(hard).where("quality_.kept").drop("quality_")
    good = quality.good_documents(hard)
    assert good.columns == hard.columns
    assert Counter(map(tuple, good.collect())) == Counter(map(tuple, kept.collect()))


def test_rules_keep_labelled_good_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    judged = quality.judge(docs).select("doc_id", "quality.kept", "quality.base_failed")
    rows = judged.join(labels, "doc_id").where("not base_failed").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1]
    assert good and all(good)


# -- decontamination ---------------------------------------------------------

def contamination_brute(text, items, n):
    words = ALNUM.findall(lower(text or ""))
    hit, names = set(), set()
    for name, item in items:
        parts = ALNUM.findall(lower(item or ""))
        size = min(n, len(parts))
        if not size:
            continue
        windows = {tuple(parts[i:i + size]) for i in range(len(parts) - size + 1)}
        for i in range(len(words) - size + 1):
            if tuple(words[i:i + size]) in windows:
                hit |= set(range(i, i + size))
                if name is not None:
                    names.add(str(name))
    return len(words), len(hit), sorted(names)


@pytest.fixture(scope="module")
def items(spark, hard):
    texts = {r["doc_id"]: r["text"] for r in hard.collect()}
    long = texts[11].split()
    rows = [(10, " ".join(long[500:530])), (2, "…" + " - ".join(long[515:528]).upper()), (3, "漢字"),
            (4, ""), (5, None), (None, " ".join(long[900:911])), (2, "sure yes 1"), (7, "nowhere at all")]
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.mark.parametrize("max_words", [1 << 20, 40])
def test_decontamination_hard_rows(hard, nothing, items, max_words):
    listed = [tuple(r) for r in items.collect()]
    got = decontaminate.scan(hard, items, 10, max_words)
    assert got.columns == [*hard.columns, "hits_"]
    found = 0
    for r in got.collect():
        h = r["hits_"]
        assert (h["n_words"], h["n_hit"], list(h["items"])) == \
            contamination_brute(r["text"], listed, 10), r["doc_id"]
        cut = [r["text"][s["start"]:s["end"]] for s in h["spans"]]
        assert sum(len(ALNUM.findall(lower(c))) for c in cut) == h["n_hit"]
        found += h["n_hit"] > 0
    assert found >= 3
    assert decontaminate.scan(nothing, items).count() == 0
    assert decontaminate.clean_documents(hard, items.limit(0)).count() == hard.count()


def test_clean_documents_and_removed_spans(hard, items):
    listed = [tuple(r) for r in items.collect()]
    clean = Counter(r["doc_id"] for r in decontaminate.clean_documents(hard, items).collect())
    want = Counter(r["doc_id"] for r in hard.collect()
                   if not contamination_brute(r["text"], listed, 10)[1])
    assert clean == want
    for r in decontaminate.remove_spans(hard, items).collect():
        assert contamination_brute(r["text"], listed, 10)[1] == 0 or r["doc_id"] == 11


# -- columns that clash in letter case ---------------------------------------

def test_columns_that_differ_in_case(spark, items):
    rows = [(i, f"text {i} " * 30, "other", 5) for i in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, TEXT string, Doc_Id long")
    for op in (quality.judge, line_dedup.dedup, lambda d: decontaminate.scan(d, items),
               lambda d: decontaminate.remove_spans(d, items)):
        out = op(df)
        assert out.columns[:4] == df.columns
        assert sorted(r[0] for r in out.collect()) == [0, 1, 2, 3]
    assert near_dup.near_duplicates(df).count() == 4


def test_md5_of_keys_is_the_same_in_tasks_and_in_sql(spark):
    line = "  Ünïcode LINE that is long enough to be a key of its own\t"
    df = spark.createDataFrame([(1, line)], "doc_id long, text string")
    h = line_dedup.line_keys(df).first()["h"]
    assert bytes(h) == hashlib.md5(lower(line.strip(" \t")).encode()).digest()


def test_node_links_join_the_same_components_as_all_pairs():
    rng = np.random.default_rng(8)
    for _ in range(40):
        n = int(rng.integers(2, 30))
        sets = [np.unique(rng.integers(0, 14, rng.integers(1, 14))) for _ in range(n)]
        docs = rng.permutation(1000)[:n].tolist()
        states = [docs[int(i)] for i in rng.integers(0, n, n)]
        links = near_dup.node_links(docs, states, sets, 60)
        every = [(a, b) for a, b in combinations(range(n), 2)
                 if 100 * len(np.intersect1d(sets[a], sets[b])) >=
                 60 * len(np.union1d(sets[a], sets[b]))]

        def classes(edges, places):
            top = {i: i for i in places}
            for a, b in edges:
                old = (top[a], top[b])
                top = {k: min(old) if v in old else v for k, v in top.items()}
            return top

        same = [(i, j) for i, j in combinations(range(n), 2) if states[i] == states[j]]
        place = {d: i for i, d in enumerate(docs)}
        got = classes(same + [(place[a], place[b]) for a, b in links], range(n))
        assert got == classes(same + every, range(n))
        assert len(links) < n
