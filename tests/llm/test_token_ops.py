"""Token counts, token store and packing: whole-text encodings, exact round trips, gapless packing."""

import functools
import itertools
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from flotilla.llm import packing, token_counts, token_store, tokens
from tests.llm import brute

public = pytest.importorskip("public_tokenizers")
SMALL = "/root/testdata/sf0.001"
BYTE, WORD = public.path("byte_bpe_50k.json"), public.path("word_bpe_49k.json")


@functools.cache
def tokenizer(path):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


def plain(path, texts):
    return [e.ids for e in tokenizer(path).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


ODD = st.lists(st.sampled_from(list("abzAZ .,'!|<>\n\t\r  09") + ["é", "ß", "İ", "Ω", "́", " ", "　", "中", "😀",
                                                                      "<|endoftext|>", "'s", "'LL", " ", "﻿", "̸", "­"]), max_size=40).map("".join)


@pytest.mark.parametrize("path", [BYTE, WORD])
@settings(max_examples=300, deadline=None)
@given(texts=st.lists(ODD | st.text(max_size=20), max_size=6))
def test_segments_encode_as_whole_texts(path, texts):
    enc = tokens.encoder(tokens.read_tokenizer(path))
    raw = [t.encode("utf-8", "replace") for t in texts]
    texts = [r.decode() for r in raw]
    off = np.concatenate([[0], np.cumsum([len(r) for r in raw], dtype=np.int64)]).astype(np.int64)
    ids, bounds = enc.encode(np.frombuffer(b"".join(raw), np.uint8), off)
    assert [ids[a:b].tolist() for a, b in itertools.pairwise(bounds)] == plain(path, texts)


def test_full_memory_starts_afresh(monkeypatch):
    monkeypatch.setattr(tokens, "MAX_KNOWN", 5)
    enc = tokens.Encoder(tokens.read_tokenizer(BYTE))
    for text in ["one two three", "four five six seven eight nine ten", "one ten two"]:
        ids, _ = enc.encode(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]))
        assert ids.tolist() == plain(BYTE, [text])[0]


@pytest.mark.parametrize("rows", [brute.awkward(), []])
def test_token_counts(spark, tmp_dir, rows):
    cache = f"{tmp_dir}/cache"
    df = brute.frame(spark, rows)
    want = sorted(map(repr, ((r[0], len((r[1] or "").encode()), len(x)) for r, x in zip(rows, plain(BYTE, [r[1] for r in rows])))))
    for _ in range(2):
        assert sorted(map(repr, map(tuple, token_counts.token_counts(df, cache, BYTE).collect()))) == want
    assert spark.read.schema(token_counts.CACHE).parquet(cache).count() == len({r[1] or "" for r in rows})


def test_cache_is_asked_before_encoding(spark, tmp_dir):
    cache = f"{tmp_dir}/cache"
    token_counts.token_counts(brute.frame(spark, [(1, "old text")]), cache, BYTE).collect()
    # a stored count is believed, another tokenizer's is not, and only misses are added
    spark.read.parquet(cache).withColumn("n_tokens", F.lit(77).cast("long")).write.parquet(f"{tmp_dir}/other")
    df = brute.frame(spark, [(1, "old text"), (2, "new text"), (3, "new text")])
    assert {r[0]: r[2] for r in token_counts.token_counts(df, f"{tmp_dir}/other", BYTE).collect()} == {1: 77, 2: 2, 3: 2}
    assert {r[0]: r[2] for r in token_counts.token_counts(df, f"{tmp_dir}/other", WORD).collect()} == {1: 2, 2: 2, 3: 2}
    assert spark.read.parquet(f"{tmp_dir}/other").count() == 4


def test_op7_given(spark):
    rows = brute.rows_of(SMALL)
    got = {r["doc_id"]: tuple(r)[1:] for r in token_counts.op7_token_counts(spark, SMALL).collect()}
    assert got == {r[0]: (len(r[1].encode()), len(x), len(x) > 1024) for r, x in zip(rows, plain(BYTE, [r[1] for r in rows]))}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 255) | st.integers(0, 60_000) | st.integers(0, 2**32 - 1), max_size=1500))
def test_codes_round_trip_and_random_access(ids):
    code = token_store.Dac(token_store.encode_dac(np.array(ids, np.uint32)))
    assert code.decode().tolist() == ids and [code[i] for i in range(len(ids))] == ids


@pytest.mark.parametrize("rows", [brute.awkward(), []])
def test_token_store(spark, tmp_dir, rows):
    path = f"{tmp_dir}/tokens"
    token_store.write_tokens(brute.frame(spark, rows).repartition(5), path, BYTE, shard_tokens=500)
    ordered = sorted(rows, key=lambda r: (brute.LAST if r[0] is None else r[0], (r[1] or "").encode()))
    stream, want = [], []
    for r, ids in zip(ordered, plain(BYTE, [r[1] for r in ordered])):
        want.append((r[0], len(stream), len(ids) + 1, ids + [0]))
        stream += ids + [0]
    got = [(r["doc_id"], r["start"], r["n_tokens"], np.frombuffer(r["ids"], "<u4").tolist())
           for r in token_store.read_documents(spark, path).collect()]
    assert sorted(got, key=lambda r: r[1]) == want
    digests = sorted(map(tuple, token_store.document_digests(spark, path).collect()), key=lambda r: r[1])
    assert digests == [(a, b, c, crc(d)) for a, b, c, d in want]
    for position in ({0, 1, 17, len(stream) // 2, len(stream) - 1} if rows else ()):
        assert token_store.token_at(spark, path, position) == stream[position]
    with pytest.raises(IndexError):
        token_store.token_at(spark, path, len(stream))


def check_packing(rows, capacity):
    """rows: (length, sequence, offset). Sequences are gapless and not too long; returns how many."""
    by = {}
    for length, sequence, offset in rows:
        by.setdefault(sequence, []).append((offset, length))
    for places in by.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by)


@pytest.mark.parametrize("rows", [brute.awkward(), []])
def test_packing_documents(spark, rows):
    got = packing.pack_documents(brute.frame(spark, rows), WORD, capacity=256).collect()
    want = []
    for r, ids in zip(rows, plain(WORD, [r[1] for r in rows])):
        ids = ids + [0]
        want += [(r[0], k, 256 * k, len(p), crc(p)) for k, p in enumerate(ids[i:i + 256] for i in range(0, len(ids), 256))]
    assert sorted(map(repr, (tuple(r)[:5] for r in got))) == sorted(map(repr, want))
    n = check_packing([(r["length"], r["sequence_id"], r["offset"]) for r in got], 256)
    assert n <= 1.1 * sum(w[3] for w in want) / 256 + 1


@pytest.mark.parametrize("seed", range(6))
def test_plan_uses_every_piece_once_and_wastes_little(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 64, 2048])
    counts = {rng.randint(1, capacity): rng.randint(1, 500) for _ in range(rng.choice([3, 40, 300]))}
    plan = packing.Plan(counts, capacity)
    used = {}
    for lengths, times in plan.patterns:
        assert sum(lengths) <= capacity and times > 0
        for x in lengths:
            used[x] = used.get(x, 0) + times
    assert used == counts
    total = sum(k * v for k, v in counts.items())
    whole = sum(v for k, v in counts.items() if 2 * k > capacity)
    n = sum(t for _, t in plan.patterns)
    assert n <= 1.25 * max(whole, total / capacity) + 1
    if len(counts) == 300 and capacity == 2048:
        assert n <= max(1.01 * total / capacity, 1.05 * whole) + 2


def test_exact_complements_come_before_best_fit():
    # 6 + 4, 5 + 3 + 2 and 7 + 1 + 1 + 1 fill ten exactly
    plan = packing.Plan({6: 1, 4: 1, 5: 1, 3: 1, 2: 1, 7: 1, 1: 3}, 10)
    assert sum(t for _, t in plan.patterns) == 3


def test_pack_keeps_columns_and_refuses_other_lengths(spark):
    df = brute.frame(spark, [(i, "x") for i in range(200)]).withColumn("length", (F.col("doc_id") % 7 + 1).cast("long"))
    got = packing.pack(df, capacity=8).collect()
    assert len(got) == 200 and got[0]["digest"] == "x"
    check_packing([(r["length"], r["sequence_id"], r["offset"]) for r in got], 8)
    for bad in (0, 9, None):
        with pytest.raises(ValueError):
            packing.pack(df.withColumn("length", F.lit(bad).cast("long")), capacity=8)
