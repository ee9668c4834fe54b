"""LM scoring, language ID, preference formatting, URL rules and the pipeline."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_hard import SF_SMALL, hard, nothing, prose  # noqa: F401
from test_llm_documents import contamination_brute, groups, line_brute
from test_llm_tokens import _check_packing

import corpus_pipeline
from starweave.llm import chat, lang_id, lm_score, quality, queries, url_filter


# -- language ID -------------------------------------------------------------

def phrases_brute(text: list[int], sample: list[int], segment: int) -> int:
    joined = ",".join(map(str, sample)) + ","
    count = 0
    for at in range(0, len(text), segment):
        part, i = text[at:at + segment], 0
        while i < len(part):
            n = 0
            while i + n < len(part) and "," + "".join(f"{c}," for c in part[i:i + n + 1]) in "," + joined:
                n += 1
            i += max(1, n)
            count += 1
    return count


def test_parsing_equals_brute_force():
    samples = {"a": ["the river runs under the old bridge"], "b": ["der fluss unter der brücke"]}
    model = lang_id.Model(samples)
    texts = ["the bridge under der Fluss! 漢字 123 the river", "", "?!", "brücke" * 300]
    entropy, lettered = model.entropies(texts)
    assert lettered.tolist() == [True, False, False, True]
    for i, lang in enumerate(model.langs):
        sample = model._symbols(lang_id.folded(samples[lang])[0]).tolist()
        for t, text in enumerate(texts):
            symbols = model._symbols(lang_id.folded([text])[0]).tolist()
            c = phrases_brute(symbols, sample, lang_id.SEGMENT)
            assert np.isclose(entropy[i, t], c * np.log2(len(sample)) / max(1, len(symbols)))


def test_suffix_automaton_accepts_all_substrings_only():
    rnd = random.Random(2)
    s = [rnd.randint(0, 2) for _ in range(60)]
    to = lang_id.suffix_automaton(s)
    inside = {tuple(s[i:j]) for i in range(61) for j in range(i, 61)}
    for _ in range(500):
        t = tuple(rnd.randint(0, 2) for _ in range(rnd.randint(0, 6)))
        state = 0
        for c in t:
            state = to[state].get(c)
            if state is None:
                break
        assert (state is not None) == (t in inside)


def test_language_query_held_out_accuracy(spark):
    rows = queries.op7_language_id(spark, "/root/testdata/sf0.01").collect()
    truth = {r["doc_id"]: r for r in
             spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    assert len(rows) == len(truth)
    right = []
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
        if r["held_out"]:
            right.append(r["lang_pred"] == truth[r["doc_id"]]["lang"])
    assert len(right) > 200 and sum(right) / len(right) > 0.98


def test_language_hard_rows(spark, hard, nothing):
    model = lang_id.learn(hard)
    assert model.langs == ["en"]
    by_text = {(r["doc_id"], r["lang_pred"], r["score"]) for r in lang_id.predict(hard, model).collect()}
    assert (2, "und", 0.0) in by_text and (4, "und", 0.0) in by_text and (1, "en", 1.0) in by_text
    assert lang_id.predict(hard, model).count() == hard.count()
    none = lang_id.learn(nothing)
    assert {r["lang_pred"] for r in lang_id.predict(hard, none).collect()} == {"und"}
    assert lang_id.predict(nothing, model).count() == 0


# -- LM scoring --------------------------------------------------------------

def test_gradients_equal_differences():
    rng = np.random.default_rng(1)
    net = lm_score.Network(5, 3)
    net.weights = [w.astype(np.float64) for w in net.weights]
    windows, weight = rng.integers(0, 5, (7, 5)), rng.integers(1, 9, 7).astype(float)

    def loss():
        return -(net.log_probs(windows) * weight).sum() / weight.sum()

    for w, g in zip(net.weights, net.gradients(windows, weight)):
        for at in [tuple(rng.integers(0, n) for n in w.shape) for _ in range(4)]:
            old, e = w[at], 1e-5
            w[at] = old + e
            high = loss()
            w[at] = old - e
            low = loss()
            w[at] = old
            assert np.isclose((high - low) / (2 * e), g[at], atol=1e-5)


def test_windows_see_both_sides_and_never_other_texts():
    codes, row, sizes = lm_score.window_codes(["ab", "", "cé"])
    e, a = lm_score.EDGE, 97
    assert lm_score.unpack(codes).tolist() == [
        [e, e, a, a + 1, e], [e, a, a + 1, e, e],
        [e, e, a + 2, 0xC3, 0xA9], [e, a + 2, 0xC3, 0xA9, e], [a + 2, 0xC3, 0xA9, e, e]]
    assert row.tolist() == [0, 0, 2, 2, 2] and sizes == [2, 0, 3]


def test_counts_cover_every_byte(spark, hard):
    counted = {r["code"]: r["n"] for r in lm_score.count_windows(hard).collect()}
    want = Counter(lm_score.window_codes([r["text"] or "" for r in hard.collect()])[0].tolist())
    assert counted == want


def test_scores_are_the_networks_sums(spark, hard, nothing):
    net = lm_score.train(lm_score.count_windows(hard))
    texts = [(r["doc_id"], r["text"] or "") for r in hard.collect()]
    want = []
    for doc, t in texts:
        logs = net.log_probs(lm_score.unpack(lm_score.window_codes([t])[0]))
        want.append((doc is not None, doc, len(t.encode()), float(logs.sum())))
    got = [(r["doc_id"] is not None, r["doc_id"], r["n_tokens"], r["log_prob"])
           for r in lm_score.score(hard, net).collect()]
    key = lambda r: (r[0], r[1] or 0, r[2], round(r[3], 3))
    for a, b in zip(sorted(got, key=key), sorted(want, key=key)):
        assert a[:3] == b[:3] and np.isclose(a[3], b[3], rtol=1e-6, atol=1e-6)
    blank = lm_score.pseudo_likelihood(nothing)
    assert blank.columns == ["doc_id", "n_tokens", "log_prob", "mean_log_prob"] and blank.count() == 0


def _means(spark, train, judged):
    df = spark.createDataFrame(train, "doc_id long, text string")
    net = lm_score.train(lm_score.count_windows(df))
    rows = lm_score.score(spark.createDataFrame(judged, "doc_id long, text string"), net).collect()
    return {r["doc_id"]: r["mean_log_prob"] for r in rows}


def test_real_text_scores_above_shuffled_text(spark):
    rnd = random.Random(9)
    held = [(i, prose(1000 + i, 150)) for i in range(20)]
    mixed = [(100 + i, "".join(rnd.sample(t, len(t)))) for i, t in held]
    mean = _means(spark, [(i, prose(i, 150)) for i in range(60)], held + mixed)
    assert max(mean[100 + i] for i in range(20)) < min(mean[i] for i in range(20))
    assert min(mean[i] for i in range(20)) > -np.log(lm_score.SIZE) / 2


def test_noise_in_rare_scripts_scores_below_real_text(spark):
    rnd = random.Random(4)
    real = [(i, prose(i, 150)) for i in range(60)]
    noise = [(100 + i, "".join(chr(rnd.randint(0x4E00, 0x9FFF)) for _ in range(300))) for i in range(10)]
    noise += [(200 + i, "".join(chr(rnd.randint(0x400, 0x4FF)) for _ in range(300))) for i in range(10)]
    mean = _means(spark, real + noise, real + noise)
    assert max(m for d, m in mean.items() if d >= 100) < min(mean[i] for i in range(60))


def test_scores_do_not_depend_on_partitions(spark):
    df = spark.createDataFrame([(i, prose(i, 120)) for i in range(50)], "doc_id long, text string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    found = []
    try:
        for n in (1, 8, 64):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            rows = lm_score.pseudo_likelihood(df.repartition(n)).orderBy("doc_id").collect()
            found.append(np.array([r["mean_log_prob"] for r in rows]))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert np.allclose(found[0], found[1], atol=1e-6) and np.allclose(found[0], found[2], atol=1e-6)


# -- preference formatting ---------------------------------------------------

def chat_brute(a, b):
    k = 0
    while k < min(len(a), len(b)) and a[k] == b[k]:
        k += 1

    def shown(turns):
        return "".join(f"<|{r}|>\n{t}\n" for r, t in turns)

    def mask(turns):
        at, out = 0, []
        for r, t in turns:
            out.append((at, len(shown([(r, t)])), r == "assistant"))
            at += out[-1][1]
        return out

    return k, shown(a[:k]), shown(a[k:]), shown(b[k:]), mask(a[k:]), mask(b[k:])


TURNS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "hello"), (1, 2, "user", "bye"),
    (2, 0, "user", "hi"), (2, 1, "assistant", "hey \U0001f600"),
    (3, 0, "user", "hi"), (3, 1, "assistant", "hello"), (3, 2, "user", "bye"),
    (4, 0, "user", None), (4, 1, None, "x"), (5, 0, "system", "s"), (6, 0, "user", "alone"),
    (6, 0, "user", "alone"), (None, 0, "user", "lost"), (7, None, "user", "z"), (7, 3, "assistant", ""),
]


def _turns(spark):
    return spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string") \
        .selectExpr("*", "1 AS a", "2 AS b", "3 AS place", "'q' AS opening").repartition(3)


def _whole():
    out: dict = {}
    for conv, turn, role, text in sorted(
            (t for t in TURNS if t[0] is not None),
            key=lambda t: (t[0], t[1] is not None, t[1] or 0, t[2] or "", t[3] or "")):
        out.setdefault(conv, []).append((role or "", text or ""))
    return out


def test_pairs_are_formatted_like_brute_force(spark):
    pairs = [(1, 2), (1, 3), (1, 3), (4, 1), (6, 7), (5, 99), (None, 1), (2, None)]
    df = spark.createDataFrame(pairs, "chosen_id long, rejected_id long")
    whole = _whole()
    rows = chat.format_pairs(_turns(spark), df).collect()
    assert Counter((r[0], r[1]) for r in rows) == Counter(pairs)
    for r in rows:
        want = chat_brute(whole.get(r["chosen_id"], []), whole.get(r["rejected_id"], []))
        got = (r["n_common"], r["prompt"], r["chosen"], r["rejected"],
               [tuple(s) for s in r["chosen_mask"]], [tuple(s) for s in r["rejected_mask"]])
        assert got == want
    assert chat.format_pairs(_turns(spark).limit(0), df.limit(0)).count() == 0


def test_contrasts_pair_neighbours(spark):
    rows = chat.contrasts(_turns(spark)).collect()
    whole = _whole()
    assert len(rows) == len(whole) - 1
    assert {(r["chosen_id"], r["rejected_id"]) for r in rows} >= {(1, 2), (2, 3)}  # one opening
    for r in rows:
        a, b = ([tuple(t) for t in r[c]] for c in ("a", "b"))
        own, other = whole[r["chosen_id"]], whole[r["rejected_id"]]
        assert a == own
        answers = [t for t in other if t[0] == "assistant"]
        spot = max((i for i, t in enumerate(own) if t[0] == "assistant"), default=None)
        if own[0] == other[0] or spot is None or not answers:
            assert b == other
        else:
            assert b == [answers[-1] if i == spot else t for i, t in enumerate(own)]


def test_chat_plan_is_native(spark):
    plan = queries.op5_preference_format(spark, SF_SMALL)._jdf.queryExecution() \
        .executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


# -- URL rules ---------------------------------------------------------------

RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("a.example.org", "", "allow"), ("a.example.org", "/es/x", "block"), ("com", "/fr/", "allow"),
         ("com", "/de/", "block"), ("com", "/de/", "allow"), ("", "/", "block"), ("net", None, "block"),
         (None, "/", "block"), ("net", "/n", None), ("xample.org", "/", "block")]
URLS = ["http://example.org/es/1", "https://A.Example.ORG/es/xyz?q=/en/1", "http://a.example.org",
        "http://b.a.example.org/es/", "http://example.org/en/12#x", "http://example.org/en/2",
        "ftp://x.com/fr/", "ftp://x.com/de/deep", "x://com/de/", "http://notexample.org/es/", None, "",
        "no scheme", "://", "http://?q", "http://u@example.org:80/es/", "http://example.org./es/",
        "http://.org/", "http://a..org/", "http://example.org/ES/", "http://é.org/ü",
        "http://" + "a." * 300 + "org/" + "p/" * 3000]


def url_brute(url, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else None
    if rest is None:
        return "", "", None, default
    cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[:min([path.index(c) for c in "?#" if c in path], default=len(path))]
    fits = sorted((len(h) + len(p), h + p, v) for h, p, v in RULES
                  if h and p is not None and v is not None and path.startswith(p)
                  and (host == h or host.endswith("." + h)))
    if not fits:
        return host, path, None, default
    best = [f for f in fits if f[0] == fits[-1][0]]
    return host, path, best[0][1], best[0][2]


def test_url_rules_equal_brute_force(spark):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(0, URLS[0])] * 3 + [(None, URLS[0]), (None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string").selectExpr(
        "*", "'h' AS host", "1 AS key", "2 AS kind", "3 AS n").repartition(4)
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    got = url_filter.judge_urls(pages, rules).collect()
    assert Counter(map(tuple, got)) == Counter((i, *url_brute(u)) for i, u in rows)
    assert url_filter.judge_urls(pages.limit(0), rules).count() == 0
    none = url_filter.judge_urls(pages, rules.limit(0), default="block").collect()
    assert len(none) == len(rows) and {(r["rule"], r["verdict"]) for r in none} == {(None, "block")}


def test_a_hot_host_is_spread_over_the_sweep(spark):
    rows = [(i, f"http://hot.example.org/es/{i % 3}") for i in range(3000)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    got = url_filter.judge_urls(pages, url_filter.rules_frame(spark)).collect()
    assert Counter((r["rule"], r["verdict"]) for r in got) == {("example.org/es/", "block"): 3000}


# -- the pipeline ------------------------------------------------------------

def test_pipeline_equals_brute_force(spark, hard, nothing, tmp_path):
    long = {r["doc_id"]: r["text"] for r in hard.collect()}[11]
    extra = [(200 + i, prose(300 + i, 150)) for i in range(8)]
    extra += [(250, " ".join(long.split()[40:200])), (251, extra[0][1] + " tail"), (252, extra[1][1])]
    docs = hard.unionByName(spark.createDataFrame(
        [(i, t, "en", "s", len(t)) for i, t in extra],
        "doc_id long, text string, lang string, source string, n_chars long"), allowMissingColumns=True)
    items = [(1, " ".join(long.split()[50:75])), (2, "nothing like it here at all")]
    folder = str(tmp_path)
    docs.write.parquet(folder + "/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(folder + "/benchmark.parquet")

    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    kept = {(r["doc_id"], r["text"]) for r in quality.judge(docs).where("quality_.kept").collect()}
    rows = [r for r in rows if r in kept]
    lines = [r[:2] for r in line_brute(rows, 40, 5).elements()]
    named = {d: t for d, t in lines if d is not None}
    component = groups(named, 5, 80)
    single = [(d, t) for d, t in sorted(set((d, t) for d, t in lines if d is not None))
              if component[d][1] == d] + [(d, t) for d, t in lines if d is None]
    clean = [(d, t) for d, t in single if not contamination_brute(t, items, 10)[1]]
    assert 0 < len(clean) < len(single) < len(lines)

    def as_bag(frame):
        return Counter((r["doc_id"], r["text"]) for r in frame.collect())

    step = docs
    for (name, stage), want in zip(corpus_pipeline.STAGES, (rows, lines, single, clean)):
        step = stage(spark, step, folder)
        assert step.columns == docs.columns, name
        assert as_bag(step) == Counter(want), name
        assert all(r["n_chars"] == len(r["text"]) for r in step.collect()), name
    out = corpus_pipeline.run(spark, folder).collect()
    _check_packing(out, clean, 2048)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, folder).count() == 0, name


def test_stage_order_and_registration():
    import __spark_entry__ as entry
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "line_dedup", "near_dedup", "decontamination", "packing"]
    names = set(entry.queries())
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
    assert "pipeline" in names and set(entry.oracle_sql()) <= names


def test_the_rest_works_without_this_subpackage(tmp_path):
    import shutil
    import subprocess
    import sys
    root = corpus_pipeline.__file__.rsplit("/", 1)[0]
    shutil.copytree(root + "/starweave", tmp_path / "starweave",
                    ignore=lambda d, names: [n for n in names if n in ("llm", "__pycache__")])
    shutil.copy(root + "/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; print(sorted(e.queries())[0], len(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True,
                         check=True)
    assert out.stdout.split() == ["business_key_tests", "18"]


@pytest.mark.parametrize("name", ["op2_lm_score", "op7_language_id"])
def test_models_are_the_same_on_a_second_run(spark, name):
    a, b = (queries.queries()[name](spark, SF_SMALL).orderBy("doc_id").collect() for _ in range(2))
    assert a == b
