from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from llm import bpe, pretokens, records
from llm.memo import Remembered
from tests.llm.conftest import SF_DIR, real

MULTI = P.path("byte_bpe_multi_50k.tiktoken")
BPE = bpe.Bpe(bpe.read_ranks(MULTI), P.PATTERN)
TIKTOKEN = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=BPE.ranks, special_tokens={})


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=200) | st.text(alphabet="abeint \n'", max_size=400))
def test_bpe_equals_the_library(text):
    ids = BPE.encode(text)
    assert list(ids) == TIKTOKEN.encode_ordinary(text)
    assert BPE.decode(ids) == text.encode()


@pytest.mark.parametrize("text", ["a" * 5001, "ab" * 3000 + "x", "the" * 3000, " " * 3000 + "x", "é" * 2000, "1" * 4000])
def test_long_matches(text):
    assert list(BPE.encode(text)) == TIKTOKEN.encode_ordinary(text)


def test_join_at_every_cut():
    random.seed(1)
    for _ in range(40):
        data = "".join(random.choices("tion hersg", k=30)).replace(" ", "").encode()
        want = BPE.merge(data)
        for cut in range(len(data) + 1):
            assert BPE.join(BPE.encode_bytes(data[:cut]) if cut else [], BPE.encode_bytes(data[cut:]) if cut < len(data) else []) == want


def test_bpe_query(spark):
    docs = real("documents")
    got = {r.doc_id: r for r in bpe.op10_bpe(spark, SF_DIR).collect()}
    assert len(got) == len(docs)
    for d in docs:
        ids = TIKTOKEN.encode_ordinary(d["text"] or "")
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert (got[d["doc_id"]].n_tokens, got[d["doc_id"]].ids_sha256) == (len(ids), digest)
        assert got[d["doc_id"]].decoded_sha256 == hashlib.sha256((d["text"] or "").encode()).hexdigest()


def test_bpe_operator_round_trip(spark):
    docs = spark.createDataFrame([(1, "one two"), (2, None), (None, "x")], "doc_id long, text string")
    back = bpe.decode(bpe.encode(docs, MULTI, P.PATTERN), MULTI, P.PATTERN)
    assert sorted((r.doc_id or 0, bytes(r.data)) for r in back.collect()) == [(0, b"x"), (1, b"one two"), (2, b"")]


def test_records_query(spark):
    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    got = {r.doc_id: r for r in records.op9_token_records(spark, SF_DIR).collect()}
    at = 0
    for d in sorted(real("documents"), key=lambda d: d["doc_id"]):
        ids = np.array([*tokenizer.encode(d["text"] or "", add_special_tokens=False).ids, 0], "<u4")
        r = got.pop(d["doc_id"])
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert not got


def test_records_edges(spark, tmp_path):
    docs = spark.createDataFrame([(5, "b"), (3, None), (3, ""), (None, "z"), (9, "<|endoftext|>"), (5, "b")], "doc_id long, text string")
    path = f"file://{tmp_path}/r"
    records.write(docs.withColumn("file", docs.text), path, P.path("byte_bpe_50k.json"), P.PATTERN)
    rows = sorted(records.placed(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, 3, 3, 5, 5, 9] and rows[1].n_tokens == 1 and rows[5].n_tokens > 2
    index = {(r.file, r.offset, r.length, r.doc_id, r.start) for r in records.read_index(spark, path).collect()}
    assert index == {(r.file, r.offset, r.length, r.doc_id, r.start) for r in rows}
    for name, offset, length, doc_id, _ in index:  # any record alone, by the index
        data = (tmp_path / "r" / "data" / name).read_bytes()[offset : offset + length]
        assert [d for _, _, d, _ in records.frames(data)] == [doc_id]


def test_records_of_no_rows(spark, tmp_path):
    path = f"file://{tmp_path}/r"
    records.write(spark.createDataFrame([], "doc_id long, text string"), path, P.path("byte_bpe_50k.json"), P.PATTERN)
    assert records.scan(spark, path).count() == 0 and records.read_index(spark, path).count() == 0


def test_damage_is_found():
    data = records.frame(7, np.array([1, 2, 3], "<u2").tobytes(), 2) + b"\n"
    assert [(d, i.tolist()) for _, _, d, i in records.frames(data)] == [(7, [1, 2, 3])]
    for at in range(len(data)):
        broken = bytearray(data)
        broken[at] ^= 1
        with pytest.raises(ValueError):
            list(records.frames(bytes(broken)))


def test_memory_is_bounded_and_right():
    seen = Remembered(lambda new: [x * 2 for x in new], 10)
    for k in range(200):
        keys = [str((k * j) % 37) for j in range(15)]
        assert seen.all(keys) == [x * 2 for x in keys]
        assert len(seen) + len(seen.older) <= 10 + 15 + 25


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=80) | st.text(alphabet="aé1'sdtrevlm  \n\t\x1c\x85\u2028!?😀²", max_size=60))
def test_matches_equal_the_pattern(text):
    assert pretokens.matches(text) == regex.findall(P.PATTERN, text)


def test_every_character_has_its_kind():
    for a in range(0, 0x110000, 0x1000):
        text = "".join(chr(c) for c in range(a, a + 0x1000) if not 0xD800 <= c < 0xE000)
        assert pretokens.matches(text) == regex.findall(P.PATTERN, text)


@given(st.lists(st.text(alphabet=st.sampled_from("aé𝒳1٣ \n\t'.sdtmrevl　"), max_size=12), max_size=8))
@settings(max_examples=300, deadline=None)
def test_texts_cut_together_are_cut_as_each_alone(parts):
    found, bounds = pretokens.batch_matches(parts)
    every = found.cast("large_string").to_pylist() if len(found) else []
    assert [every[a:b] for a, b in zip(bounds, bounds[1:], strict=False)] == [regex.findall(pretokens.PATTERN, t) for t in parts]


def test_one_doc_id_fills_many_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(records, "FILE_CHARS", 4000)
    docs = spark.createDataFrame([(7 if i % 3 else i, f"text number {i % 40} " * 9) for i in range(600)], "doc_id long, text string").repartition(5)
    path = f"file://{tmp_path}/hot"
    records.write(docs, path, P.path("byte_bpe_50k.json"), P.PATTERN)
    rows = sorted(records.placed(spark, path).collect(), key=lambda r: r.start)
    assert len(rows) == 600 and [r.doc_id for r in rows] == sorted(r.doc_id for r in rows)
    assert len({r.file for r in rows if r.doc_id == 7}) > 5
    assert [r.start for r in rows] == [sum(x.n_tokens for x in rows[:i]) for i in range(600)]


def test_short_merges_look_up_each_pair_once():
    """A merge changes two pairs: the others are not looked up anew, so look-ups grow with the length, not with its square."""

    class Counted(dict):
        asked = 0

        def get(self, *args):
            Counted.asked += 1
            return super().get(*args)

    data = ("abcdefgh" * 8).encode()
    counted = bpe.Bpe(Counted(BPE.ranks), P.PATTERN)
    assert counted._merge_short(data) == BPE._merge_long(data)
    assert Counted.asked <= 3 * len(data)
    assert counted._merge_short(b"") == [] and counted._merge_short(b"a") == [BPE.ranks[b"a"]]
