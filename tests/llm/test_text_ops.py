"""Suffix dedup, decontamination, line dedup and quality rules against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from flotilla.llm import common, decontaminate, line_dedup, quality, suffix_dedup
from tests.llm import brute

SMALL = "/root/testdata/sf0.001"


def tables(name):
    return brute.awkward() if name == "awkward" else brute.rows_of(SMALL) if name == "given" else []


def multiset(rows):
    return sorted(map(repr, rows))


@pytest.mark.parametrize("name", ["awkward", "given", "empty"])
def test_suffix_dedup(spark, name):
    rows = tables(name)
    got = suffix_dedup.remove_repeats(brute.frame(spark, rows)).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans"), F.sha2("kept", 256)).collect()
    assert multiset(map(tuple, got)) == multiset(brute.removed_bytes(rows))


def test_suffix_dedup_beyond_the_broadcast(spark, monkeypatch):
    monkeypatch.setattr(common, "BROADCAST_COPIES", -1)
    rows = brute.awkward()
    got = suffix_dedup.remove_repeats(brute.frame(spark, rows)).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans"), F.sha2("kept", 256)).collect()
    assert multiset(map(tuple, got)) == multiset(brute.removed_bytes(rows))


def crossed(n=60):
    """Documents with one passage, each with other text before and after it, and odd ids."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 7)))
    text = lambda k: " ".join(word() for _ in range(k))
    passage, shorter, rule = text(14), text(3)[:20], "-" * 130
    rows = [(i * 7 % n, f"{text(9)} {passage} {text(6)} {shorter} {text(5)}{rule[:rng.randint(40, 130)]}{text(3)}")
            for i in range(n)]
    return rows + [(None, f"{text(4)} {passage}"), (None, f"{passage} {text(4)}"), (5, f"{passage}!{rule}"), (-3, rule[:90])]


@pytest.mark.parametrize("heavy_from", [1, 20])
@pytest.mark.parametrize("name", ["awkward", "crossed"])
def test_suffix_dedup_of_heavy_signatures(spark, name, heavy_from):
    rows = crossed() if name == "crossed" else brute.awkward()
    got = suffix_dedup.remove_repeats(brute.frame(spark, rows).repartition(5), heavy_from).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans"), F.sha2("kept", 256)).collect()
    assert multiset(map(tuple, got)) == multiset(brute.removed_bytes(rows))


def test_heavy_signatures_are_not_judged_together(spark):
    df = brute.frame(spark, crossed()).select(F.coalesce("doc_id", F.lit(99)).alias("id"), "text", F.lit(True).alias("is_first"),
                                              F.unhex(F.md5("text")).alias("digest"))
    asked = suffix_dedup._answered(suffix_dedup._asked(df, 4), 20)
    found = [x for r in asked.where("id is null").collect() for x in r["sigs"]]
    heavy = np.unique(np.frombuffer(b"".join(map(bytes, found)), np.uint64)[::2])
    sigs = asked.where("id is not null").join(df, "id")
    judged = suffix_dedup._verdicts(sigs, heavy).select("sig").distinct().collect()
    assert len(heavy) and judged and not {r["sig"] for r in judged} & set(heavy.view(np.int64).tolist())


def test_groups_keep_all_rows_of_several_batches():
    part = lambda keys: pa.RecordBatch.from_pydict({"k": keys, "x": [bytes([k]) for k in keys]},
                                                   pa.schema([("k", pa.int64()), ("x", pa.binary())]))
    got = list(suffix_dedup._groups([part([1, 1]), part([1, 2]), part([]), part([2])], "k"))
    assert [g.num_rows for g in got] == [3, 2] and got[0].schema.field("x").type == pa.large_binary()


def test_two_stage_sorting_against_plain_search():
    rng = random.Random(5)
    for _ in range(200):
        letters = rng.choice([b"ab", b"abcdefgh ", bytes(range(256)), b"\x00\xff", b"\x00"])
        base = [bytes(rng.choice(letters) for _ in range(rng.randint(50, 140))) for _ in range(4)]
        found = set()
        for _ in range(12):
            b = rng.choice(base)
            k = rng.randint(0, max(0, len(b) - 50))
            f = b[k:k + rng.randint(50, 120)]
            found.add((f * 3)[:rng.randint(50, 150)] if rng.random() < 0.1 else f)
        parts = [f for f in found if len(f) >= 50]
        ids = np.array([rng.randint(0, 20) for _ in parts])
        off = np.concatenate([[0], np.cumsum([len(f) for f in parts])]).astype(np.int64)
        got, _ = suffix_dedup.least_ids(np.frombuffer(b"".join(parts), np.uint8), off, ids)
        least = {}
        for f, i in zip(parts, ids):
            for p in range(len(f) - 49):
                least[f[p:p + 50]] = min(least.get(f[p:p + 50], 99), i)
        assert got.tolist() == [least[f[p:p + 50]] for f in parts for p in range(len(f) - 49)]


ITEMS = [(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa alpha"), (2, "Straße d'été"), (3, None), (4, ""),
         (5, "?!"), (6, "the the the the the the the the the the the the"), (None, "own 3"), (7, "own 3 line"),
         (8, "zeta"), (8, "zeta"), (10, "LINE x own")]


@pytest.mark.parametrize("block_bytes", [1 << 20, 40])
@pytest.mark.parametrize("name", ["awkward", "empty"])
def test_decontamination(spark, name, block_bytes):
    rows = tables(name)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontaminate.scan(brute.frame(spark, rows), items, block_bytes=block_bytes).select(
        "row.doc_id", "n_words", "n_hit", F.size("items"), F.sha2(F.array_join("items", ","), 256), F.col("n_hit") > 0)
    assert multiset(map(tuple, got.collect())) == multiset(brute.contamination(rows, ITEMS))


def test_one_block_of_items_at_a_time(spark, monkeypatch):
    items, seen = spark.createDataFrame(ITEMS, "item_id long, text string"), []
    kind, collect, stored = type(items), type(items).collect, decontaminate.stored
    monkeypatch.setattr(kind, "collect", lambda self: (seen.append("collect"), collect(self))[1])
    monkeypatch.setattr(decontaminate, "stored", lambda *a: (seen.append("stored"), stored(*a))[1])
    decontaminate.scan(brute.frame(spark, brute.awkward()), items, block_bytes=40)
    steps = "".join(x[0] for x in seen)
    assert steps.count("s") > 1 and "cc" not in steps[steps.index("s"):] and steps.endswith("sc")


def test_decontamination_given(spark):
    items = [(r["item_id"], r["text"]) for r in brute.read(SMALL, "benchmark")]
    got = decontaminate.op2_decontaminate(spark, SMALL).collect()
    assert multiset(map(tuple, got)) == multiset(brute.contamination(brute.rows_of(SMALL), items))


def test_decontamination_without_items(spark):
    items = spark.createDataFrame([], "item_id long, text string")
    got = decontaminate.scan(brute.frame(spark, brute.awkward()), items).collect()
    assert len(got) == len(brute.awkward()) and not any(r["n_hit"] for r in got)


def test_spans_go_and_covered_documents_go(spark):
    items = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven")], "item_id long, text string")
    rows = [(1, "Before. " * 20 + "One two, three four five six seven eight nine ten ELEVEN after é"),
            (2, "one two three four five six seven eight nine ten"), (3, "nothing here"), (4, None)]
    got = {r["row"]["doc_id"]: r["text"] for r in decontaminate.decontaminate(brute.frame(spark, rows), items).collect()}
    assert got == {1: "Before. " * 20 + " after é", 3: "nothing here", 4: None}


@pytest.mark.parametrize("name", ["awkward", "given", "empty"])
@pytest.mark.parametrize("broadcast", [True, False])
def test_line_dedup(spark, name, broadcast, monkeypatch):
    if not broadcast:
        monkeypatch.setattr(line_dedup, "BROADCAST_HASHES", -1)
    rows = tables(name)
    got = line_dedup.line_dedup(brute.frame(spark, rows)).select("row.doc_id", "n_lines", "n_dropped", "kept", "row.h").collect()
    assert multiset((a, b, c, d) for a, b, c, d, _ in got) == multiset(brute.without_common_lines(rows))
    assert all(r["h"] == "x" for r in got)


def test_line_runs_are_merged_in_levels(spark, tmp_dir):
    runs = line_dedup.LineRuns(spark, tmp_dir, min_docs=3, fanout=2)
    for k in range(5):
        runs.add(brute.frame(spark, [(k, f"everywhere\nonly {k}\n{'odd' if k % 2 else 'even'}")]))
    # five runs in twos: one of four batches two levels up, one alone
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    want = spark.createDataFrame([("everywhere",), ("even",)], "line string").select(line_dedup.line_hash(F.col("line")))
    assert sorted(r[0] for r in runs.common().collect()) == sorted(r[0] for r in want.collect())
    # what is common already isn't counted again
    top = runs.runs()[-1]
    assert spark.read.parquet(top).count() > 0


def test_line_dedup_plan_is_native(spark):
    plan = line_dedup.op9_line_dedup(spark, SMALL)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("name", ["awkward", "given", "empty"])
def test_quality_rules(spark, name):
    rows = tables(name)
    got = quality.quality(brute.frame(spark, rows)).select(
        "row.doc_id", "m.n_words", "m.word_chars", "m.n_symbols", "m.n_dup_lines", "m.n_repeat_words", "base_failed").collect()
    assert multiset(map(tuple, got)) == multiset(brute.rules(rows))


def test_host_verdicts_shrink_small_hosts(spark):
    # 40 good hosts, one bad host with many documents, one with a single bad document
    judged = [(f"h{i}", j == 0) for i in range(40) for j in range(50)] + [("bad", True)] * 200 + [("one", True)] + [(None, False)] * 3
    rates = {r["host"]: r["rate"] for r in quality.host_rates(
        spark.createDataFrame(judged, "host string, failed boolean")).collect()}
    assert rates["bad"] > 0.8 > rates["one"] > rates["h0"] and rates[None] < 0.3


def test_bad_host_takes_its_good_documents_along(spark):
    good = " ".join(f"word{i}" for i in range(60))
    rows = [(i, "too short", None, "bad") for i in range(300)] + [(1000, good, None, "bad"), (1001, good, None, None)]
    rows += [(2000 + i, good, None, f"s{i % 5}") for i in range(300)]
    got = {r["doc_id"]: r["kept"] for r in quality.quality(brute.frame(spark, rows)).select("row.doc_id", "kept").collect()}
    assert not got[1000] and got[1001] and all(got[2000 + i] for i in range(300)) and not got[0]
