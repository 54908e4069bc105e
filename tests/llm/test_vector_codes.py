"""Vector codes: the search against trying all entries, whole results against plain Python."""

import hashlib
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from flotilla.llm import vector_codes as V

COLUMNS = "vec_id long, embedding array<float>, label int, code string, error string, p string, e string"


def plain(rows, coding=V.Coding()):
    """(vec_id, vector, label) rows to (vec_id, code, error, label_error, sha)."""
    kept = [(i, [math.floor(coding.scale * float(np.float32(x))) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    d = len(kept[0][1]) // coding.parts
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:coding.entries]
    books = [[r[1][p * d:(p + 1) * d] for r in first] for p in range(coding.parts)]

    def nearest(p, v):
        return min((sum((a - b) ** 2 for a, b in zip(v[p * d:(p + 1) * d], c)), e) for e, c in enumerate(books[p]))

    for _ in range(coding.rounds):
        fresh = [list(b) for b in books]
        for p in range(coding.parts):
            got = {}
            for _, v, _ in kept:
                got.setdefault(nearest(p, v)[1], []).append(v[p * d:(p + 1) * d])
            for e, vs in got.items():
                fresh[p][e] = [sum(col) // len(vs) for col in zip(*vs)]
        books = fresh
    sha = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    coded = []
    for i, v, label in kept:
        near = [nearest(p, v) for p in range(coding.parts)]
        coded.append((i, "".join(f"{e:02x}" for _, e in near), sum(x for x, _ in near), label))
    total = {}
    for _, _, err, label in coded:
        total[label] = total.get(label, 0) + err
    return [(i, code, err, total[label], sha) for i, code, err, label in coded]


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], COLUMNS)


def got(df):
    return sorted(map(tuple, df.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()), key=str)


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 2 ** 32), st.integers(1, 40), st.integers(1, 9), st.sampled_from([1, 3, 2000]))
def test_search_equals_trying_all(seed, k, d, spread):
    rng = np.random.default_rng(seed)
    book, x = rng.integers(-spread, spread + 1, (k, d)), rng.integers(-spread, spread + 1, (50, d))
    index, best = V.Search(book).nearest(x)
    dist = ((x[:, None] - book[None]) ** 2).sum(-1)
    assert index.tolist() == dist.argmin(1).tolist() and best.tolist() == dist.min(1).tolist()


def awkward(n=60, d=8, seed=1):
    rng = random.Random(seed)
    rows = [(rng.randrange(10 ** 6), [rng.uniform(-1, 1) for _ in range(d)], rng.choice([None, 0, 1, 2])) for _ in range(n)]
    rows += rows[:5]                                            # repeated rows
    rows += [(rows[0][0], [0.25] * d, 3), (None, [0.5] * d, None), (None, None, 1), (7, [float("nan")] + [0.0] * (d - 1), 1),
             (8, [None] + [0.0] * (d - 1), 1), (9, [float("inf")] + [0.0] * (d - 1), 1), (10, [0.0] * d, None), (11, [-0.0] * d, 5)]
    return rows


@pytest.mark.parametrize("coding", [V.Coding(), V.Coding(entries=7, rounds=2), V.Coding(parts=2, entries=3)])
def test_awkward_rows_equal_plain(spark, coding):
    rows = awkward()
    assert got(V.compress(table(spark, rows).repartition(3), coding)) == sorted(plain(rows, coding), key=str)


def test_more_rows_than_entries_and_one_hot_vector(spark):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, .1) for _ in range(8)], i % 3) for i in range(400)] + [(1000 + i, [0.5] * 8, 1) for i in range(200)]
    assert got(V.compress(table(spark, rows).repartition(4))) == sorted(plain(rows), key=str)


def test_labels_joined_salted_are_the_same(spark, monkeypatch):
    monkeypatch.setattr(V, "BROADCAST_LABELS", 0)
    rows = awkward()
    assert got(V.compress(table(spark, rows))) == sorted(plain(rows), key=str)


def test_empty_and_all_dropped(spark):
    assert got(V.compress(table(spark, []))) == []
    assert got(V.compress(table(spark, [(1, None, 1)]))) == []
    assert [r[:4] for r in got(V.compress(table(spark, [(1, [], 1)])))] == [(1, "00000000", 0, 0)]


@pytest.mark.parametrize("rows", [[(1, [1.0] * 8, 0), (2, [1.0] * 4, 0)], [(1, [1.0] * 6, 0)], [(1, [1e9] * 4, 0)]])
def test_vectors_that_cannot_be_coded_are_errors(spark, rows):
    with pytest.raises(Exception, match="differ in length|don't cut|out of range"):
        V.compress(table(spark, rows).coalesce(1)).collect()


def test_decoding_gives_the_entries_of_the_code(spark):
    rows = [(i, [math.sin(i * j) / 4 for j in range(8)], 0) for i in range(300)]
    held = table(spark, rows).select("vec_id", F.col("embedding").alias("vector"), "label")
    books = V.codebooks(held)
    back = V.decode(V.encode(held, books), books).collect()
    whole = {i: [math.floor(1024 * float(np.float32(x))) for x in v] for i, v, _ in rows}
    assert all(sum((a - b) ** 2 for a, b in zip(r["approx"], whole[r["vec_id"]])) == r["error"] for r in back)


def test_given_table_equals_plain(spark):
    import pyarrow.parquet as pq
    table_ = pq.read_table("/root/testdata/sf0.001/embeddings.parquet").to_pylist()
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in table_]
    assert got(V.op13_vector_codes(spark, "/root/testdata/sf0.001")) == sorted(plain(rows), key=str)
