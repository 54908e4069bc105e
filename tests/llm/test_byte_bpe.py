"""Byte-level BPE against the tiktoken library, and back to the bytes."""

import functools
import hashlib
import itertools
import random

import pytest
from pyspark.sql import functions as F

from flotilla.llm import byte_bpe as B
from tests.llm import brute

public = pytest.importorskip("public_tokenizers")
SMALL = "/root/testdata/sf0.001"
MULTI = public.path("byte_bpe_multi_50k.tiktoken")


@functools.cache
def vocabulary(path=MULTI):
    return B.Vocabulary.read(path)


@functools.cache
def library(path=MULTI):
    import tiktoken
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=vocabulary(path).ranks, special_tokens={})


def plain(rows):
    out = []
    for i, text, *_ in rows:
        ids = library().encode_ordinary(text or "")
        out.append((i, len(ids), brute.sha(",".join(map(str, ids))), brute.sha(library().decode_bytes(ids))))
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()), key=str)


def query(spark, tmp_dir, rows):
    brute.frame(spark, rows).write.mode("overwrite").parquet(f"{tmp_dir}/documents.parquet")
    return got(B.op11_byte_bpe(spark, tmp_dir))


@pytest.mark.parametrize("rows", [brute.awkward(), []])
def test_awkward_rows_equal_the_library(spark, tmp_dir, rows):
    assert query(spark, tmp_dir, rows) == plain(rows)


def long_words():
    rng = random.Random(2)
    letters = lambda of, n: "".join(rng.choice(of) for _ in range(n))
    texts = ["a" * 4001, "ab" * 900, letters("ab", 1500), letters("aab", 700), letters("abcdefghijklmnopqrstuvwxyz", 2000),
             "=" * 3000 + "-" * 777, " " * 2500 + "x", "\n" * 1200, "中文字符测试没有空格的长文本" * 60, letters("éèàçabc", 800),
             "<|endoftext|> " * 300, letters("0123456789", 1000), "the" * 500, letters("tion", 1200)]
    return [(i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("many", [4, 256])
def test_long_words_equal_the_library(spark, monkeypatch, many):
    monkeypatch.setattr(B, "MANY", many)
    rows = long_words() + [(100, "".join(t[:40] + " " for _, t in long_words()))]
    ids = B.encode(spark.createDataFrame(rows, "doc_id long, text string"), vocabulary(), public.PATTERN)
    found = {r["doc_id"]: r["ids"] for r in ids.collect()}
    assert found == {i: library().encode_ordinary(t) for i, t in rows}


def test_random_texts_equal_the_library(spark):
    rng = random.Random(4)
    units = list("abzAZ .,'!|<>\n\t\r  09éßİΏ　中😀'") + ["'s", "'LL", "​", "﻿", "the ", "ing", "tion", " un", "ee", "oo"]
    rows = [(i, "".join(rng.choice(units) for _ in range(rng.randrange(60)))) for i in range(400)]
    ids = B.encode(spark.createDataFrame(rows, "doc_id long, text string"), vocabulary(), public.PATTERN, limit=500)
    back = ids.withColumn("raw", B.decode("ids", vocabulary())).collect()
    texts = dict(rows)
    assert all(r["ids"] == library().encode_ordinary(texts[r["doc_id"]]) and bytes(r["raw"]) == texts[r["doc_id"]].encode() for r in back)
    assert len(back) == len(rows)


def test_another_vocabulary(spark):
    path = public.path("byte_bpe_50k.tiktoken")
    rows = [(i, t) for i, (_, t, *_) in enumerate(brute.awkward())]
    ids = B.encode(spark.createDataFrame(rows, "doc_id long, text string"), vocabulary(path), public.PATTERN).collect()
    assert {r["doc_id"]: r["ids"] for r in ids} == {i: library(path).encode_ordinary(t or "") for i, t in rows}


def test_frequent_words_are_folded_once_beforehand(spark, monkeypatch):
    monkeypatch.setattr(B, "MANY_ROWS", 300)
    monkeypatch.setattr(B, "SAMPLE_ROWS", 300)
    texts = ["zqjxvky wpfgb 中文字符测 the", "the zqjxvky éèlqzt", "zqjxvky" * 20, "", None, "once" + "qxz" * 3]
    rows = [(i, t if i % 6 < 5 else f"{t}{i}qzx") for i, t in enumerate(texts * 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    often = {r["word"]: r["ids"] for r in B.frequent_words(docs, vocabulary(), public.PATTERN).to_pylist()}
    assert often and all(ids == library().encode_ordinary(w.decode()) for w, ids in often.items())
    assert b"zqjxvky" in often and b"the" not in often and all(len(w) <= B.LONG for w in often)
    found = {r["doc_id"]: r["ids"] for r in B.encode(docs, vocabulary(), public.PATTERN).collect()}
    assert found == {i: library().encode_ordinary(t or "") for i, t in rows}
    folded = B.sliced_words(docs, vocabulary(), public.PATTERN).select(F.sum(F.size("words"))).first()[0]
    monkeypatch.setattr(B, "MANY_ROWS", 10 ** 9)
    assert B.frequent_words(docs, vocabulary(), public.PATTERN).num_rows == 0
    assert folded < B.sliced_words(docs, vocabulary(), public.PATTERN).select(F.sum(F.size("words"))).first()[0]


def test_unknown_ids_decode_to_null(spark):
    df = spark.createDataFrame([([1, 10 ** 6],), ([],), (None,)], "ids array<int>")
    assert [r[0] for r in df.select(B.decode("ids", vocabulary())).collect()] == [None, b"", None]


def test_ranks_are_one_literal_of_the_plan(spark):
    docs = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    ids = B.encode(docs, vocabulary(), public.PATTERN).select(F.size("ids"))
    plan = ids._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" not in plan


def test_missing_single_bytes_are_an_error(tmp_dir):
    with open(f"{tmp_dir}/small.tiktoken", "wb") as f:
        f.write(b"YQ== 0\n")
    with pytest.raises(ValueError, match="single bytes"):
        B.Vocabulary.read(f"{tmp_dir}/small.tiktoken")


def test_neighbours_allow_every_piece():
    joins = vocabulary().neighbours()
    assert all(joins[256 * a + b] for p in itertools.islice(vocabulary().ranks, 0, None, 50) for a, b in itertools.pairwise(p))


def test_given_table_equals_the_library(spark):
    assert got(B.op11_byte_bpe(spark, SMALL)) == plain(brute.rows_of(SMALL))
    assert hashlib.sha256(b"").hexdigest() == brute.sha("")
