"""Language and toxicity: held-out accuracy, odd inputs, ordered thresholds."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from flotilla.llm import langid, toxicity
from tests.llm import brute

LARGER = "/root/testdata/sf0.01"


def test_given_languages_held_out(spark):
    lang = {r[0]: r[2] for r in brute.rows_of(LARGER)}
    got = langid.op8_language(spark, LARGER).collect()
    assert len(got) == len(lang)
    unseen = [r for r in got if r["held_out"]]
    assert {r["doc_id"] for r in unseen} == {i for i in lang if __import__("zlib").crc32(str(i).encode()) % 4 == 2}
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in unseen]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in got)


SYLLABLES = {"aa": ["ka", "lo", "mi"], "bb": ["xyz", "qu", "wr"], "cc": ["ñé", "öß", "ça"]}


def made(n, seed):
    rng = random.Random(seed)
    return [(i, " ".join("".join(rng.choices(SYLLABLES[lang], k=3)) for _ in range(30)), lang)
            for i, lang in enumerate(rng.choices(list(SYLLABLES), k=n))]


@pytest.fixture(scope="module")
def model():
    rows = made(400, 1)
    return langid.train([r[1].encode() for r in rows], [r[2] for r in rows])


def test_odd_texts(spark, model):
    rows = [(1, None), (2, ""), (3, "12 34 !?"), (4, "\U0001F600"), (None, "kalomi kamika"), (5, "kalomi kamika " * 60_000),
            (6, "öñéßça"), (6, "öñéßça"), (7, "kalomi")]
    got = langid.identify(brute.frame(spark, rows), model).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == len(rows)
    assert all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0 and by[i]["rejected"] for i in (1, 2, 3, 4))
    assert by[None]["lang_pred"] == by[5]["lang_pred"] == "aa" and by[6]["lang_pred"] == "cc"
    assert langid.identify(brute.frame(spark, []), model).count() == 0


def test_scores_are_calibrated_and_strangers_rejected(model):
    rows = made(300, 2)
    raw = [r[1].encode() for r in rows]
    off = np.concatenate([[0], np.cumsum([len(x) for x in raw])])
    best, score = model.predict(np.frombuffer(b"".join(raw), np.uint8), off)
    right = np.array([model.languages[i] for i in best]) == [r[2] for r in rows]
    assert right.mean() > 0.98 and abs(score.mean() - right.mean()) < 0.05


def test_text_and_its_neighbours_do_not_mix(model):
    raw = [r[1].encode() for r in made(40, 3)] + [b"", b"a", b"ab"]
    off = np.concatenate([[0], np.cumsum([len(x) for x in raw])])
    together = model.logits(np.frombuffer(b"".join(raw), np.uint8), off)
    alone = np.concatenate([model.logits(np.frombuffer(x, np.uint8), np.array([0, len(x)])) for x in raw])
    assert np.allclose(together, alone, atol=1e-4)


def test_held_out_rows_and_null_languages_are_not_learnt(spark):
    rows = [(i, "text here", None if i % 2 else "en") for i in range(200)]
    counts, labels = langid.training_sample(brute.frame(spark, rows))
    allowed = [i for i in range(0, 200, 2) if __import__("zlib").crc32(str(i).encode()) % 4 != 2]
    assert set(labels) == {"en"} and 0 < len(counts) == len(labels) <= len(allowed)


@pytest.mark.parametrize("rows", [[], [(1, "text", None), (None, None, "en"), (2, "", "en")]])
def test_nothing_to_learn_from_leaves_texts_undetermined(spark, tmp_dir, rows):
    brute.frame(spark, rows).write.parquet(f"{tmp_dir}/documents.parquet")
    got = langid.op8_language(spark, tmp_dir).collect()
    assert len(got) == len(rows) and all((r["lang_pred"], r["score"], r["rejected"]) == ("und", 0.0, True) for r in got)


def test_sample_is_bounded_whole_and_counts_equal_rows_once(spark):
    rows = [(i, f"ka lo mi {i} " * (30_000 if i % 3 else 1), "aa" if i % 2 else "bb") for i in range(60)] + [(None, "xyz", "bb")] * 500
    df = brute.frame(spark, rows).repartition(4)
    counts, labels = langid.training_sample(df)
    again, _ = langid.training_sample(df.repartition(7))
    assert np.array_equal(counts, again) and labels.count("bb") <= 31 and counts.sum(1).max() > 400_000
    few, labels = langid.training_sample(df, rows=10)
    assert len(few) == len(labels) <= 10
    # the counts are those of the whole texts
    want = {tuple(langid.bucket_counts(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t)]))[0]) for _, t, _ in set(rows)}
    assert {tuple(x) for x in counts} <= want


def test_strangers_are_rejected(spark, model):
    rng = random.Random(9)
    words = lambda of, n: " ".join("".join(rng.choices(of, k=6)) for _ in range(n))
    strangers = [(i, words("αβγδεζηθικλμνξο", 30)) for i in range(60)] + [(100 + i, words("ежзийклмнп", 30)) for i in range(60)] \
        + [(200 + i, words(["hub", "ded", "gop", "vaf", "jes"], 20)) for i in range(60)]
    own = [(1000 + r[0], r[1]) for r in made(300, 4)]
    got = {r["doc_id"]: r["rejected"] for r in langid.identify(brute.frame(spark, strangers + own), model).collect()}
    assert np.mean([got[i] for i, _ in strangers]) > 0.9
    assert np.mean([got[i] for i, _ in own]) < 0.05


def bad_words(n, seed):
    """Grade = number of different bad words, two at most."""
    rng = random.Random(seed)
    plain, bad = [f"w{i}" for i in range(300)], ["vile", "awful", "nasty"]
    out = []
    for i in range(n):
        k = rng.choice([0, 0, 1, 2])
        words = rng.choices(plain, k=40) + rng.sample(bad, k)
        rng.shuffle(words)
        out.append((i, " ".join(words), k))
    return out


def test_ordinal_grades(spark):
    rows = bad_words(1500, 1)
    m = toxicity.train([r[1].encode() for r in rows], [r[2] for r in rows])
    assert len(m.thresholds) == 2 and m.thresholds[0] < m.thresholds[1]
    unseen = bad_words(400, 2)
    got = {r["doc_id"]: r for r in toxicity.severity(brute.frame(spark, unseen), m).collect()}
    assert np.mean([got[r[0]]["grade"] == r[2] for r in unseen]) > 0.95
    assert np.mean([got[r[0]]["toxic"] == (r[2] > 0) for r in unseen]) > 0.98
    mean = [np.mean([got[r[0]]["expected_severity"] for r in unseen if r[2] == k]) for k in range(3)]
    assert mean[0] < 0.3 < mean[1] < mean[2] <= 2


def test_gradient_matches_the_likelihood():
    """At the end of training no small change of a weight or threshold makes the fit much better."""
    rows = bad_words(600, 4)
    m = toxicity.train([r[1].encode() for r in rows], [r[2] for r in rows])
    raw = [r[1].encode() for r in rows]
    data, off = np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in raw])])
    y = np.array([r[2] for r in rows])

    def loss(w, theta):
        p = toxicity.Model(m.vocabulary, w, theta).exceed(toxicity.Model(m.vocabulary, w, theta).scores(data, off))
        above = np.concatenate([np.ones((len(y), 1)), p, np.zeros((len(y), 1))], 1)
        return -np.log(above[np.arange(len(y)), y] - above[np.arange(len(y)), y + 1] + 1e-12).mean()
    best = loss(m.weights, m.thresholds)
    for k in range(2):
        for step in (-0.3, 0.3):
            theta = m.thresholds.copy()
            theta[k] += step
            assert loss(m.weights, theta) > best - 1e-3
    for j in np.argsort(-np.abs(m.weights))[:3]:
        for step in (-0.3, 0.3):
            w = m.weights.copy()
            w[j] += step
            assert loss(w, m.thresholds) > best - 1e-3


def test_odd_texts_and_no_labels(spark):
    rows = [(1, None), (2, ""), (None, "vile awful"), (3, "VILE, awful! " * 50_000), (4, "x"), (4, "x")]
    train = bad_words(500, 5)
    m = toxicity.train([r[1].encode() for r in train], [r[2] for r in train])
    got = toxicity.severity(brute.frame(spark, rows), m).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == 6 and by[None]["grade"] == 2 and by[3]["grade"] == 2 and by[1]["grade"] == by[2]["grade"] == 0
    assert toxicity.severity(brute.frame(spark, []), m).count() == 0
    none = toxicity.train([], [])
    assert not any(r["toxic"] for r in toxicity.severity(brute.frame(spark, rows), none).collect())


def test_given_toxic_documents(spark):
    marks = {r["doc_id"]: r["toxic"] for r in brute.read(LARGER, "labels")}
    got = {r["doc_id"]: r for r in toxicity.op10_toxicity(spark, LARGER).collect()}
    assert len(got) == len(brute.rows_of(LARGER))
    assert not any(got[i]["toxic"] for i, t in marks.items() if t == 0)


def test_sample_takes_labels_with_documents_only(spark):
    docs = brute.frame(spark, [(i, f"text {i}") for i in range(30)] + [(40, None)])
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(20)] + [(40, 1, 1), (99, 1, 1), (None, 1, 1), (5, None, None)],
                                   "doc_id long, quality int, toxic int")
    texts, toxic = toxicity.training_sample(docs, labels)
    assert len(texts) == 20 and sum(toxic) == 7
    assert docs.where(F.col("doc_id") == 0).count() == 1


def test_classes_of_long_texts_only_are_learnt(spark):
    long = "mot long " * 3000
    rows = [(i, "text here", "en") for i in range(40)] + [(i, long + "x" * i, "fr") for i in range(40, 80)]
    counts, labels = langid.training_sample(brute.frame(spark, rows))
    assert set(labels) == {"en", "fr"} and min(c.sum() for c, x in zip(counts, labels) if x == "fr") > 20_000
    marks = spark.createDataFrame([(i, 1, int(i >= 40)) for i in range(80)], "doc_id long, quality int, toxic int")
    texts, toxic = toxicity.training_sample(brute.frame(spark, rows), marks)
    assert sum(toxic) == 40 and len(texts) == 80
