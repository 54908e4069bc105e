"""Near-duplicates and connected components against all pairs."""

import math
import random

import numpy as np
import pytest

from flotilla.llm import near_dup
from flotilla.llm.components import components
from flotilla.llm.near_dup import Rule
from tests.llm import brute

SMALL = "/root/testdata/sf0.001"


def multiset(rows):
    return sorted(map(repr, rows))


def noisy_groups(seed=11):
    """Groups of copies around the threshold: many links missing within a group, chains, stars."""
    rng = random.Random(seed)
    rows = []
    for g in range(6):
        base = [f"w{rng.randint(0, 400)}" for _ in range(rng.choice([40, 120, 300]))]
        for _ in range(25):
            copy = list(base)
            for _ in range(rng.randint(0, max(2, len(base) // 25))):
                copy[rng.randrange(len(copy))] = f"x{rng.randint(0, 10**6)}"
            rows.append((len(rows), " ".join(copy)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("rule", [Rule(3, 85), Rule(5, 80)])
@pytest.mark.parametrize("name", ["awkward", "noisy", "given", "empty"])
def test_components_of_links(spark, name, rule):
    rows = {"awkward": brute.awkward, "noisy": noisy_groups, "given": lambda: brute.rows_of(SMALL), "empty": list}[name]()
    got = near_dup.near_duplicates(brute.frame(spark, rows), rule).drop("id", "digest").collect()
    assert multiset(map(tuple, got)) == multiset(brute.components(rows, rule.words, rule.percent))


def test_small_blocks_and_no_broadcast(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK", 4)
    monkeypatch.setattr(near_dup, "SENT_BYTES", 300)
    monkeypatch.setattr(near_dup, "SLICE", 2000)
    monkeypatch.setattr(near_dup, "MEMBERS", 3)
    monkeypatch.setattr(near_dup, "BROADCAST_IDS", 0)
    rows = noisy_groups(12)
    got = near_dup.near_duplicates(brute.frame(spark, rows), Rule(3, 85)).drop("id", "digest").collect()
    assert multiset(map(tuple, got)) == multiset(brute.components(rows, 3, 85))


def test_one_of_each_keeps_columns(spark):
    rows = brute.awkward()
    got = near_dup.one_of_each(brute.frame(spark, rows)).collect()
    kept = [(r[0], r[1]) for r, c in zip(rows, brute.components(rows, 5, 80)) if c[3]]
    assert multiset((r["doc_id"], r["text"]) for r in got) == multiset(kept) and all(r["label"] == "x" for r in got)


def test_one_of_each_keeps_a_single_row(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(1, a, "en"), (1, a, "de"), (1, a + " end", "en"), (2, a, "en"), (None, b), (None, b), (None, b + " end"),
            (None, c), (3, None), (3, None), (None, " ")]
    got = near_dup.one_of_each(brute.frame(spark, rows)).collect()
    assert sorted(str((r["doc_id"], (r["text"] or " ")[0])) for r in got) == sorted(
        map(str, [(1, "a"), (None, "b"), (None, "c"), (3, " "), (3, " "), (None, " ")]))


def test_registers_estimate_similarity():
    rng = np.random.default_rng(1)
    for size, share in ((40, 0.9), (400, 0.85), (5000, 0.5), (5000, 0.0)):
        error = []
        for _ in range(30):
            n_shared = int(size * 2 * share / (1 + share))
            pool = rng.integers(0, 2**64, 2 * size, dtype=np.uint64)
            a, b = np.sort(pool[:size]), np.sort(pool[size - n_shared:2 * size - n_shared])
            regs = near_dup.registers(np.concatenate([a, b]), np.array([0, size, 2 * size]))
            value, used = near_dup.estimates(regs[:1], regs[1:])
            error.append(value[0] - n_shared / (2 * size - n_shared))
        assert abs(np.mean(error)) < 0.03 and used[0] <= near_dup.REGISTERS


def test_estimate_loses_no_more_than_the_bands():
    no_band = (1 - 0.85 ** near_dup.ROWS) ** near_dup.BANDS
    assert math.erfc(near_dup.SLACK / math.sqrt(2)) / 2 < no_band < 1e-8


def test_components(spark):
    rng = random.Random(2)
    for edges in ([], [(1, 1)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 50)],
                  [(rng.randint(0, 120), rng.randint(0, 120)) for _ in range(80)]):
        up = {x: x for e in edges for x in e}

        def top(a):
            while up[a] != a:
                a = up[a]
            return a
        for a, b in edges:
            a, b = sorted((top(a), top(b)))
            up[b] = a
        got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
        assert got == {x: top(x) for e in edges if e[0] != e[1] for x in e}
