"""The pipeline's stages, one by one, against brute force on what each was given."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tests.llm import brute
from tests.llm.test_token_ops import WORD, check_packing, crc, plain

SMALL = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    from flotilla.llm.common import documents, stored
    docs, out = documents(spark, SMALL), []
    for name, stage in corpus_pipeline.STAGES:
        after = stored(stage(spark, docs, SMALL), "test-stage")
        out.append((docs, after))
        docs = after
    return out


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_columns_and_lengths(stages):
    for _, after in stages[:-1]:
        assert after.columns == COLUMNS
        assert all(r["n_chars"] == len(r["text"]) for r in after.collect())


def test_quality(stages):
    before, after = stages[0]
    rows = texts(before)
    assert sorted(texts(after)) == sorted(r for r, m in zip(rows, brute.rules(rows)) if not m[-1])


def test_lines(stages):
    before, after = stages[1]
    rows = texts(before)
    assert sorted(texts(after)) == sorted((m[0], m[3]) for m in brute.without_common_lines(rows))


def test_near_duplicates(stages):
    before, after = stages[2]
    rows = texts(before)
    assert sorted(texts(after)) == sorted(r for r, m in zip(rows, brute.components(rows, 5, 80)) if m[3])


def test_benchmark(stages):
    before, after = stages[3]
    items = [(r["item_id"], r["text"]) for r in brute.read(SMALL, "benchmark")]
    rows, left = texts(before), dict(texts(after))
    found = {m[0]: m for m in brute.contamination(rows, items)}
    assert {i for i, m in found.items() if 2 * m[2] > m[1]} == set(found) - set(left)
    assert all(left[i] == t for i, t in rows if not found[i][5])
    again = {m[0]: m for m in brute.contamination(list(left.items()), items)}
    assert all(len(brute.ITEM_WORD.findall(t.translate(brute.AZ))) == found[i][1] - found[i][2] for i, t in left.items())
    assert sum(m[2] for m in again.values()) == 0


def test_packing(stages):
    before, after = stages[4]
    rows, got = texts(before), after.collect()
    want = []
    for (i, _), ids in zip(rows, plain(WORD, [t for _, t in rows])):
        ids = ids + [0]
        want += [(i, k, 2048 * k, len(p), crc(p)) for k, p in enumerate(ids[a:a + 2048] for a in range(0, len(ids), 2048))]
    assert sorted(tuple(r)[:5] for r in got) == sorted(want)
    check_packing([(r["length"], r["sequence_id"], r["offset"]) for r in got], 2048)


def test_run_is_the_stages(spark, stages):
    got = entry.queries()["pipeline"](spark, SMALL).collect()
    pick = lambda rows: sorted((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in rows)
    assert pick(got) == pick(stages[-1][1].collect())


def test_registered():
    names = entry.queries()
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14))
    assert set(entry.oracle_sql()) <= set(names) and corpus_pipeline.ORACLE_SQL is None


def _long_enough(rows):
    """Awkward rows, and clean documents that no rule rejects: copies, near copies, rows without an
    id, a very long text."""
    import random
    rng = random.Random(6)
    words = lambda n: " ".join("".join(rng.choices("abcdefghijklmnop", k=5)) for _ in range(n))
    base = [words(120) for _ in range(8)]
    good = [(1000 + i, t, "en", f"host{i % 3}") for i, t in enumerate(base)]
    good += [(2000, base[0], "en", "host0"), (2001, base[1] + " more", "en", None), (None, base[2], None, "host1"),
             (None, words(100), "en", "host1"), (None, words(100), "en", "host1"), (2002, words(60_000), "en", "host2")]
    good += [good[3]] * 3
    return [(r[0], r[1], *(list(r[2:4]) + [None, None])[:2]) for r in rows] + good


@pytest.mark.parametrize("rows", [_long_enough(brute.awkward()), []], ids=["awkward", "empty"])
def test_stages_take_awkward_rows_and_clashing_columns(spark, tmp_dir, rows):
    import shutil

    from flotilla.llm.common import stored
    docs = brute.frame(spark, rows)
    docs.write.parquet(f"{tmp_dir}/documents.parquet")
    shutil.copy(f"{SMALL}/benchmark.parquet", f"{tmp_dir}/benchmark.parquet")
    held = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        given, held = held, stored(stage(spark, held, tmp_dir), "test-stage")
        assert held.columns == docs.columns
        assert all(r["kept"] == r["node"] == r["row"] == "x" for r in held.collect())
        # each stage by itself takes the rows as they are, nulls and all
        assert stage(spark, docs, tmp_dir).count() <= len(rows)
        if name == "near-duplicates":
            before = texts(given)
            want = [m for m in brute.components(before, 5, 80) if m[3]]
            ids = [m[0] for m in want if m[0] is not None]
            assert sorted(i for i, _ in texts(held) if i is not None) == sorted(set(ids))
    if rows:
        kept = dict(texts(held))
        assert {1000, 1002, 2002} <= set(kept) and 2000 not in kept and 2001 not in kept
    pieces = corpus_pipeline.run(spark, tmp_dir).collect()
    assert {r["doc_id"] for r in pieces} == {i for i, _ in texts(held)}
