"""Packing, token files and the encoder below them, against the plain library."""

from __future__ import annotations

import io
import random
import zlib

import numpy as np
import pytest
from llm_hard import SF_SMALL, hard, nothing  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st

from starweave.llm import packing, queries, token_files
from starweave.llm.tokens import ChunkEncoder, tokenizer_path

ENCODER = ChunkEncoder(tokenizer_path(), cache=50)  # small, so that it starts afresh


def plain_ids(text) -> list[int]:
    return ENCODER.tokenizer.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from(" \n\t\r\x0b\x1f\x85\xa0 　aB1.'’sé漢\U0001f600<|>"),
                        max_size=30), max_size=6))
def test_chunks_encode_like_whole_texts(texts):
    flat, at = ENCODER.encode(texts)
    assert [flat[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [plain_ids(t) for t in texts]


LINES = st.text(st.sampled_from("ab ab \n .,'s-_(é×÷\u0280ªΩд漢1\t\x00\xa0\u2009\u3000“”"), max_size=40)


@pytest.mark.parametrize("finer", [True, False])
@settings(max_examples=150, deadline=None)
@given(st.lists(LINES, max_size=6))
def test_marks_and_lines_encode_like_whole_texts(finer, texts):
    encoder = ENCODERS[finer]
    encoder.finer = finer
    flat, at = encoder.encode(texts)
    assert [flat[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [plain_ids(t) for t in texts]


ENCODERS = {True: ChunkEncoder(tokenizer_path(), cache=50), False: ChunkEncoder(tokenizer_path(), cache=50)}


def test_a_word_is_encoded_once_whatever_mark_follows():
    encoder, learnt = ChunkEncoder(tokenizer_path()), []
    learn = encoder._learn
    encoder._learn = lambda chunks: (learnt.extend(chunks), learn(chunks))
    text = "x alpha, alpha. (alpha) alpha; alpha!\nalpha alpha? été: été"
    flat, _ = encoder.encode([text, text])
    assert flat.tolist() == 2 * plain_ids(text)
    assert sum("alpha" in c for c in learnt) <= 3 and sum("été" in c for c in learnt) == 1


def test_many_chunks_outgrow_and_leave_the_memory():
    encoder = ChunkEncoder(tokenizer_path(), cache=600)
    rnd = random.Random(3)
    for _ in range(12):
        texts = [" ".join("w" * rnd.randint(0, 12) + str(int(rnd.expovariate(0.01))) + rnd.choice(["", ".", "é"])
                          for _ in range(rnd.randint(0, 400))) for _ in range(5)]
        flat, at = encoder.encode([*texts, None])
        assert [flat[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [
            plain_ids(t) for t in [*texts, None]]


def test_the_memory_stays_as_large_however_often_it_forgets():
    encoder = ChunkEncoder(tokenizer_path(), cache=2000)
    for i in range(20):  # every second slice or so makes the encoder forget
        texts = [" ".join(f"{w}x{i}" for w in range(1200) for _ in range(2)), None]
        flat, at = encoder.encode(texts)
        assert [flat[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [plain_ids(t) for t in texts]
        assert encoder.known.n <= 2000 + 2400 and len(encoder.known.number) <= 1 << 13


def test_special_token_strings_are_ordinary_text():
    assert 50256 not in plain_ids("a <|endoftext|> b")
    flat, _ = ENCODER.encode(["a <|endoftext|> b"])
    assert flat.tolist() == plain_ids("a <|endoftext|> b")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), min_size=1, max_size=40), st.integers(1, 9))
def test_differencing_places_every_piece_once(sizes, k):
    slots = packing.difference(sizes, k)
    assert sorted(i for s in slots for i in s) == list(range(len(sizes)))
    assert len(slots) <= k


def test_differencing_is_near_equal():
    rnd = random.Random(1)
    sizes = [rnd.randint(1, 256) for _ in range(900)]
    sums = [sum(sizes[i] for i in s) for s in packing.difference(sizes, 50)]
    assert max(sums) - min(sums) <= 8


def test_window_count_rises_past_capacity():
    slots = packing.share_out([6, 6, 6], 9)  # 18 ids fit two windows only if cut
    assert len(slots) == 3


def _check_packing(rows, docs, capacity):
    whole: dict = {}
    for doc, text in docs:
        whole.setdefault(doc, []).append([*plain_ids(text), 1])
    pieces: dict = {}
    windows: dict = {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
        windows.setdefault(r["sequence_id"], []).append(r)
    for w in windows.values():
        at = 0
        for r in sorted(w, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= capacity
    assert set(pieces) == set(whole)
    for doc, texts in whole.items():
        want = sorted(texts)
        if len(want) == 1:
            ids, at = want[0], 0
            for r in sorted(pieces[doc], key=lambda r: r["start"]):
                assert r["start"] == at and r["doc_tokens"] == len(ids)
                got = np.frombuffer(r["ids"], "<u4").tolist()
                assert got == ids[at:at + r["length"]]
                at += r["length"]
            assert at == len(ids)
        else:
            assert sum(r["length"] for r in pieces[doc]) == sum(map(len, want))


def test_packing_hard_rows(hard, nothing):
    docs = [(r["doc_id"], r["text"]) for r in hard.collect()]
    rows = packing.pack(hard, capacity=64, windows=4, max_piece=20, slack=1).collect()
    _check_packing(rows, docs, 64)
    _check_packing(packing.pack(hard).collect(), docs, 2048)
    assert packing.pack(nothing).count() == 0
    with pytest.raises(ValueError, match="slack"):
        packing.pack(hard, capacity=4, slack=4)


def test_packing_query_has_little_padding(spark):
    rows = queries.op1_packing(spark, SF_SMALL).collect()
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    total = sum(len(plain_ids(d["text"])) + 1 for d in docs)
    assert sum(r["length"] for r in rows) == total
    windows = len({r["sequence_id"] for r in rows})
    assert windows <= total / 2048 * 1.02 + 1
    texts = {d["doc_id"]: [*plain_ids(d["text"]), 1] for d in docs}
    for r in rows:
        ids = np.array(texts[r["doc_id"]][r["start"]:r["start"] + r["length"]], "<u4")
        assert r["ids_crc32"] == zlib.crc32(ids.tobytes())


def test_token_file_round_trip_and_single_documents():
    sink = io.BytesIO()
    writer = token_files.TokenFileWriter(sink, frame_ids=7)
    docs = [(None, 3), (-5, 0), (4, 7), (4, 8), (9, 50)]
    for doc, n in docs:
        writer.add(doc, np.arange(n, dtype=np.uint32) + (doc or 0) % 11)
    writer.finish()
    raw = sink.getvalue()
    reader = token_files.TokenFileReader(io.BytesIO(raw))
    rows = list(reader.rows())
    assert [(d, len(ids) // 4) for d, _, ids in rows] == docs
    assert [s for _, s, _ in rows] == [0, 3, 3, 10, 18]
    seen: list = []

    class Counted(io.BytesIO):
        def read(self, n=-1):
            seen.append((self.tell(), n))
            return super().read(n)

    reader = token_files.TokenFileReader(Counted(raw))
    seen.clear()
    got = list(reader.rows([4]))
    assert [len(ids) // 4 for _, _, ids in got] == [7, 8]
    first, last = reader.offsets[1], reader.offsets[4]  # the frames of the two documents
    assert seen and all(first <= at < last for at, _ in seen)
    # Plain zstandard reads the data frames and skips the rest.
    import zstandard
    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True).read()
    assert plain == b"".join(ids for _, _, ids in rows)


def test_damage_is_noticed():
    sink = io.BytesIO()
    writer = token_files.TokenFileWriter(sink)
    writer.add(1, np.arange(100, dtype=np.uint32))
    writer.entries[0] = (*writer.entries[0][:2], writer.entries[0][2] ^ 1)
    writer.finish()
    with pytest.raises(ValueError, match="damaged"):
        list(token_files.TokenFileReader(io.BytesIO(sink.getvalue())).rows())
    with pytest.raises(ValueError, match="seek table"):
        token_files.TokenFileReader(io.BytesIO(b"x" * 40))


def test_token_files_hard_rows(spark, hard, nothing):
    files = token_files.write(hard)
    rows = token_files.read(spark, files).collect()
    assert len(rows) == hard.count()
    rows.sort(key=lambda r: r["start"])
    at = 0
    for r in rows:
        assert r["start"] == at
        at += len(r["ids"]) // 4
    order = [r["doc_id"] for r in rows]
    assert order == sorted(order, key=lambda d: (d is not None, d))
    want = sorted([*plain_ids(r["text"]), 2] for r in hard.collect())
    assert sorted(np.frombuffer(r["ids"], "<u4").tolist() for r in rows) == want
    some = token_files.read(spark, files, [7, 12, 999]).collect()
    assert sorted(r["doc_id"] for r in some) == [7, 7, 12]
    empty = token_files.write(nothing)
    assert empty.count() == 0 and token_files.read(spark, empty).count() == 0


def test_token_file_query(spark):
    rows = {r["doc_id"]: r for r in queries.op8_token_files(spark, SF_SMALL).collect()}
    at = 0
    for d in spark.read.parquet(f"{SF_SMALL}/documents.parquet").orderBy("doc_id").collect():
        ids = np.array([*plain_ids(d["text"]), 2], "<u4")
        r = rows[d["doc_id"]]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
