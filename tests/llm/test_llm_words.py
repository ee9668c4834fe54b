"""Collocations, SimHash and spelling variants against brute force."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from llm_hard import SF_SMALL, edited, hard, nothing, prose  # noqa: F401

from starweave.llm import collocations, queries, simhash, spelling

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# -- collocations ------------------------------------------------------------

def phrases_brute(rows, threshold, longest, top):
    n, f = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(AZ)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i:i + m])) for m in range(1, longest + 1)
                     for i in range(len(w) - m + 1))
    f = {k: c for k, c in f.items() if c >= threshold}
    inner = {(lang, p[i:i + m]) for (lang, p), a in f.items() for m in range(2, len(p))
             for i in range(len(p) - m + 1) if a >= f[lang, p[i:i + m]]}
    ranked = {}
    for (lang, p), a in f.items():
        if len(p) > 1 and (lang, p) not in inner:
            score, _, left, right = min(
                (1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]],
                 f[lang, p[k:]]) for k in range(1, len(p)))
            ranked.setdefault(lang, []).append(
                (-score, -a, " ".join(p).encode(), left, right))
    return {(lang, i, p.decode(), -a, left, right, n[lang], -score)
            for lang, found in ranked.items()
            for i, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1)}


@pytest.mark.parametrize("threshold, longest, top, flush", [(3, 5, 50, 1 << 22), (2, 3, 2000, 500)])
def test_collocations_equal_brute_force(spark, hard, nothing, threshold, longest, top, flush):
    more = [(None, "A\tb  a b; A b.\nb a"), ("xx", "one. two three, two\tTHREE two three")] * 3
    docs = hard.select("lang", "text", "n_lines").unionByName(
        spark.createDataFrame(more, "lang string, text string"), allowMissingColumns=True)
    got = {tuple(r) for r in collocations.collocations(docs, threshold, longest, top, flush).collect()}
    assert got == phrases_brute([(r["lang"], r["text"]) for r in docs.collect()],
                                threshold, longest, top)
    assert len(got) > 20
    assert collocations.collocations(nothing).count() == 0


def test_summary_never_loses_a_frequent_key():
    rnd = np.random.default_rng(1)
    for threshold, capacity in ((100, 50), (100, 400), (10, 20)):
        keys = np.concatenate([rnd.integers(0, 1 << 60, 20_000), rnd.zipf(1.3, 20_000)]).astype(np.uint64)
        rnd.shuffle(keys)
        parts = [collocations.Summary(threshold, capacity, buffer=64) for _ in range(3)]
        for i in range(0, len(keys), 500):
            own, n = np.unique(keys[i:i + 500], return_counts=True)
            parts[i % 3].add(own, n)
        for p in parts:
            p.fold()
        true = Counter(keys.tolist())
        for p in parts:  # a counter is never too high, nor too low by more than was lost
            assert p.lost < threshold and len(p.keys) <= p.capacity
        if sum(p.lost for p in parts) < threshold:
            parts[0].merge(parts[1])
            parts[0].merge(parts[2])
            kept = dict(zip(parts[0].keys.tolist(), parts[0].counts.tolist()))
            assert all(c <= true[k] <= c + parts[0].lost for k, c in kept.items())
            alive = set(parts[0].survivors().tolist())
            assert {k for k, c in true.items() if c >= threshold} <= alive
        else:
            with pytest.raises(ValueError, match="lost too much"):
                for p in parts[1:]:
                    parts[0].merge(p)


def test_a_summary_grows_where_its_mass_needs_it():
    s = collocations.Summary(10, 4, buffer=16)
    keys = np.repeat(np.arange(1000, dtype=np.uint64), 12)
    np.random.default_rng(2).shuffle(keys)
    for k in np.split(keys, 100):
        s.add(*np.unique(k, return_counts=True))
    assert set(s.survivors().tolist()) == set(range(1000)) and s.capacity > 4 and s.lost < 10


# -- SimHash -----------------------------------------------------------------

def fingerprint_brute(text):
    w = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(AZ))
    grams = [" ".join(w[i:i + 4]) for i in range(len(w) - 3)] or [" ".join(w)] * bool(w)
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def near_groups(fs, max_bits):
    top = {f: f for f in fs}

    def find(f):
        while top[f] != f:
            f = top[f]
        return f

    for a in fs:
        for b in fs:
            if a < b and (a ^ b).bit_count() <= max_bits:
                top[find(b)] = find(a)
    return {f: find(f) for f in fs}


def test_simhash_hard_rows(hard, nothing):
    rows = [(r["doc_id"], r["text"]) for r in hard.collect()]
    f = {t: fingerprint_brute(t) for _, t in rows}
    group = near_groups(set(f.values()), 4)
    least = {}
    for d, t in rows:
        if d is not None:
            g = group[f[t]]
            least[g] = min(d, least.get(g, d))
    want = Counter((d, f"{f[t]:016x}", least.get(group[f[t]])) for d, t in rows)
    assert Counter(tuple(r) for r in simhash.near_duplicates(hard).collect()) == want
    assert simhash.near_duplicates(nothing).count() == 0


@pytest.mark.parametrize("max_bits, cell", [(4, 4096), (4, 16), (2, 16), (6, 64), (0, 4096)])
def test_links_of_planted_fingerprints(spark, max_bits, cell):
    """Chains, stars and a crowded value of a segment, by every kind of bucket."""
    rnd = random.Random(max_bits)
    fs = {rnd.getrandbits(64) for _ in range(150)}
    for f in list(fs)[:60]:
        for _ in range(rnd.randint(1, 4)):
            for b in rnd.sample(range(64), rnd.randint(1, max_bits + 2)):
                f ^= 1 << b
            fs.add(f)
    base = rnd.getrandbits(64)
    fs |= {base ^ (rnd.getrandbits(12) << 50) for _ in range(120)}  # two segments alike
    rows = spark.createDataFrame([(simhash._signed(f),) for f in fs], "f long")
    table = simhash._table_rows(rows, max_bits, 3)
    links = simhash._links(simhash._cells(table, cell), max_bits).collect()
    pairs = [(r["a"] & (1 << 64) - 1, r["b"] & (1 << 64) - 1) for r in links]
    assert all(0 < (a ^ b).bit_count() <= max_bits for a, b in pairs)
    top = {f: f for f in fs}

    def find(f):
        while top[f] != f:
            f = top[f]
        return f

    for a, b in pairs:
        top[find(a)] = find(b)
    mine, want = {f: find(f) for f in fs}, near_groups(fs, max_bits)
    assert len(set(zip(mine.values(), (want[f] for f in mine)))) == len(set(want.values())) \
        == len(set(mine.values()))


def test_radii_leave_no_pair_out():
    for bits in range(12):
        parts = simhash.segments(bits)
        assert sum(r + 1 for _, _, r in parts) == bits + 1
        assert sum(w for _, w, _ in parts) == 64


def test_simhash_query_equals_brute_force(spark):
    rows = queries.queries()["op12_simhash"](spark, SF_SMALL).collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    f = {d: fingerprint_brute(t) for d, t in docs.items()}
    group = near_groups(set(f.values()), 4)
    least = {}
    for d in sorted(f, reverse=True):
        least[group[f[d]]] = d
    assert {tuple(r) for r in rows} == {(d, f"{x:016x}", least[group[x]]) for d, x in f.items()}


# -- spelling variants -------------------------------------------------------

def variants_brute(rows, min_chars, min_count, slip):
    n = Counter()
    for doc, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = w.translate(AZ)
            h = zlib.crc32(f"{'' if doc is None else doc}:{w}".encode())
            if h % slip == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    words = {w: c for w, c in n.items() if len(w) >= min_chars and c >= min_count}

    def one(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    near = {w: [v for v in words if one(w, v)] for w in words}
    form = {}
    for w, found in near.items():
        if found:
            best = min(found, key=lambda v: (-words[v], v))
            if words[best] >= 2 * words[w]:
                form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, c, len(near[w]), form.get(w), words.get(form.get(w)), root(w))
            for w, c in words.items()}


@pytest.mark.parametrize("tile, slip", [(1024, 97), (4, 2), (1, 3)])
def test_variants_equal_brute_force(spark, hard, nothing, tile, slip):
    rnd = random.Random(tile)
    letters = "abcÀÿ×"
    more = []
    for i in range(60):  # short and long words that differ by an edit or two, repeated letters
        w = rnd.choice(["aaaaa", "abcabc", "Àbcÿa", "a" * 30, "winterwinterwinter"])
        at = rnd.randint(0, len(w))
        more.append((1000 + i, " ".join([w, w[:at] + rnd.choice(letters) + w[at:], w[:at] + w[at + 1:],
                                         w[:at] + rnd.choice(letters) + w[at + 1:]] * rnd.randint(1, 3))))
    # A chain of forms: the first leads to the second, that to the third.
    more += [(2000 + i, "bbbbbaa" if i < 2 else "bbbbbba" if i < 8 else "bbbbbbb") for i in range(30)]
    docs = hard.select("doc_id", "text", "hits").unionByName(
        spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True)
    got = {tuple(r[c] for c in ("word", "n", "n_near", "form", "form_n", "root"))
           for r in spelling.variants(docs, 4, 2, slip=slip, tile=tile).collect()}
    want = variants_brute([(r["doc_id"], r["text"]) for r in docs.collect()], 4, 2, slip)
    assert got == want and any(r[3] for r in want)
    assert slip < 97 or any(r[5] != (r[3] or r[0]) for r in want)
    assert spelling.variants(nothing).count() == 0


def test_one_edit_of_any_length():
    words = ["abcde", "abcd", "abxde", "abcdef", "a" * 9, "a" * 10, "a" * 8 + "b", "", "b"]
    i, j = spelling.one_edit(words, words)
    found = {(words[a], words[b]) for a, b in zip(i, j)}
    want = {("abcde", "abcd"), ("abcde", "abxde"), ("abcde", "abcdef"), ("a" * 9, "a" * 10),
            ("a" * 9, "a" * 8 + "b"), ("a" * 10, "a" * 8 + "b"), ("", "b")}
    want.discard(("a" * 10, "a" * 8 + "b"))
    assert found == want | {(b, a) for a, b in want}


def test_collocation_sums_are_sent_many_to_a_row(spark):
    rows = [(x, " ".join(f"w{(7 * i + j) % 211}" for j in range(60))) for i in range(40)
            for x in ("en", None)]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(2)
    every = spark.sparkContext.broadcast(np.full(1024, 2 ** 64 - 1, np.uint64))
    sent = collocations._partial_sums(docs, every, 3, 10 ** 6, 4).collect()
    # At most one row for each task, partition and language.
    assert len(sent) <= 2 * 4 * 2
    assert all(len(r["phrases"]) == len(r["counts"]) == len(set(r["phrases"])) for r in sent)
    counted = collocations._counted(docs, every, 3, 1, 10, 4).collect()
    got = {(r["lang"], r["phrase"]): r["a"] for r in counted}
    assert len(got) == len(counted)
    want = Counter()
    for lang, text in rows:
        words, lang = text.split(" "), lang or "und"
        want[lang, None] += len(words)
        for m in (1, 2, 3):
            want.update((lang, " ".join(words[i:i + m])) for i in range(len(words) - m + 1))
    assert got == want
    few = collocations._counted(docs, every, 3, 30, 10, 4).collect()
    assert {(r["lang"], r["phrase"]) for r in few} == {
        k for k, c in want.items() if c >= 30 or k[1] is None}
