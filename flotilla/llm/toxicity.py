"""Operator 10: toxicity by cumulative-link ordinal regression.

P(grade > k) = sigmoid(w . x - threshold_k): one weight vector for all ordered thresholds. x
are logarithms of word counts, for the words that tell toxic from other rows of a bounded
sample. The output is the expected grade, the sum of those probabilities.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F, Window

from flotilla.llm.common import Words, column_of, documents, flat, ship, slices
from flotilla.llm.decontaminate import WORD

TRAIN_ROWS = 10_000         # most labelled rows of the training sample
TRAIN_BYTES = 20_000        # longer texts are sampled only for want of others; this times the rows bounds the bytes
FEW = 50                    # short texts of a label from which longer ones aren't needed
MAX_WORDS = 4096            # most features
MIN_DOCS = 4                # sample rows a feature must be in
MIN_CHI2 = 10.83            # chi-squared of a word's presence and a grade above 0: one in 1000 by chance
STEPS, RATE, PENALTY = 1000, 0.5, 1e-5


@dataclass
class Model:
    vocabulary: list[bytes]
    weights: np.ndarray
    thresholds: np.ndarray      # ascending, one less than there are grades

    def exceed(self, x: np.ndarray) -> np.ndarray:
        """P(grade > k) of rows of scores w . x, one column for each k."""
        return 1 / (1 + np.exp(-np.clip(x[:, None] - self.thresholds[None, :], -40, 40)))

    def scores(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        text, word, count = counted(Words(data, off, WORD), pa.array(self.vocabulary, pa.large_binary()))
        return np.bincount(text, self.weights[word] * np.log1p(count), minlength=len(off) - 1)


def counted(words: Words, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, word, count) of the words of a vocabulary."""
    if not len(vocabulary) or not len(words.starts):
        return (np.zeros(0, np.int64),) * 3
    at = pc.index_in(words.array, value_set=vocabulary).fill_null(-1).to_numpy().astype(np.int64)
    here = np.flatnonzero(at >= 0)
    text = np.searchsorted(words.off, here, "right") - 1
    pair, count = np.unique(text * len(vocabulary) + at[here], return_counts=True)
    return pair // len(vocabulary), pair % len(vocabulary), count


def _chunks(texts: list[bytes], n: int = 500):
    """(number of the first one, words) of ``n`` texts after another."""
    for lo in range(0, len(texts), n):
        part = texts[lo:lo + n]
        off = np.zeros(len(part) + 1, np.int64)
        np.cumsum([len(t) for t in part], out=off[1:])
        yield lo, Words(np.frombuffer(b"".join(part), np.uint8), off, WORD)


def train(texts: list[bytes], grades: list[int]) -> Model:
    """Fit by full-batch gradient steps with momentum; the thresholds stay ordered because their
    differences are learnt as logarithms."""
    y = np.asarray(grades, np.int64)
    if len(y) == 0 or y.max() < 1:
        return Model([], np.zeros(0), np.array([40.0]))     # nothing to learn: nobody exceeds 0
    top = int(y.max())
    # the distinct words of each text, a few texts at a time
    words, bad = [], []
    for lo, part in _chunks(texts):
        coded = part.array.dictionary_encode()
        size = max(1, len(coded.dictionary))
        text = np.repeat(np.arange(len(part.off) - 1), np.diff(part.off))
        seen = np.unique(text * size + coded.indices.to_numpy())
        words.append(coded.dictionary.take(pa.array(seen % size)))
        bad.append(pa.array((y[lo + seen // size] > 0).astype(np.int64)))
    table = pa.table({"word": pa.chunked_array(words, pa.large_binary()), "bad": pa.chunked_array(bad, pa.int64())}) \
        .group_by("word").aggregate([("bad", "count"), ("bad", "sum")]).sort_by("word")
    both, in_bad = table["bad_count"].to_numpy().astype(float), table["bad_sum"].to_numpy()
    n, n_bad = len(y), int((y > 0).sum())
    expected = both * n_bad / n
    spread = expected * (1 - n_bad / n) * (1 - both / n)
    chi2 = np.where((both >= MIN_DOCS) & (spread > 0), (in_bad - expected) ** 2 / np.maximum(spread, 1e-9), 0)
    pick = np.argsort(-chi2, kind="stable")[:MAX_WORDS]
    pick = pick[chi2[pick] >= MIN_CHI2]
    vocabulary = pa.array(table["word"].take(pa.array(pick)).to_pylist(), pa.large_binary())
    found = [(lo + t, w, c) for lo, part in _chunks(texts) for t, w, c in [counted(part, vocabulary)]]
    text, word, count = (np.concatenate(x) for x in zip(*found, strict=True))
    value = np.log1p(count)

    w = np.zeros(len(vocabulary))
    steps = np.concatenate([[1.0], np.zeros(top - 1)])      # first threshold, then log differences
    speed_w, speed_s = np.zeros_like(w), np.zeros_like(steps)
    for _ in range(STEPS):
        theta = steps[0] + np.concatenate([[0.0], np.cumsum(np.exp(steps[1:]))])
        score = np.bincount(text, w[word] * value, minlength=n)
        p = 1 / (1 + np.exp(-np.clip(score[:, None] - theta[None, :], -40, 40)))
        above = np.concatenate([np.ones((n, 1)), p, np.zeros((n, 1))], axis=1)
        chance = np.maximum(above[np.arange(n), y] - above[np.arange(n), y + 1], 1e-9)
        slope = np.concatenate([np.zeros((n, 1)), p * (1 - p), np.zeros((n, 1))], axis=1)
        low, high = slope[np.arange(n), y] / chance, slope[np.arange(n), y + 1] / chance
        d_score = (high - low) / n                          # gradient of the mean negative log likelihood
        d_theta = np.array([(low[y == k + 1].sum() - high[y == k].sum()) / n for k in range(top)])
        d_w = np.bincount(word, d_score[text] * value, minlength=len(w)) + PENALTY * w
        d_s = np.array([d_theta.sum(), *(d_theta[k:].sum() * np.exp(steps[k]) for k in range(1, top))])
        speed_w, speed_s = 0.9 * speed_w - RATE * d_w, 0.9 * speed_s - RATE * d_s
        w, steps = w + speed_w, steps + speed_s
    theta = steps[0] + np.concatenate([[0.0], np.cumsum(np.exp(steps[1:]))])
    return Model(vocabulary.to_pylist(), w, theta)


def training_sample(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> tuple[list[bytes], list[int]]:
    """Texts and 0/1 labels of at most ``rows`` labelled documents, as many toxic as others if there
    are as many. Which ones of TRAIN_BYTES at most, the hash of the id decides. Where a label has
    fewer than FEW so short, the shortest of the others make up for it, as far as TRAIN_BYTES for
    each row of the label's half allow. A label of which no text is taken is an error."""
    marks = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()) \
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    texts = docs.where(F.col("text").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text") \
        .withColumn("size", F.octet_length("text"))
    sized = texts.select("doc_id", "size").join(marks, "doc_id")
    short = F.col("size") <= TRAIN_BYTES
    found = sized.groupBy("toxic").agg(F.count_if(short).alias("n"), F.count("*").alias("all")).collect()
    n = {r["toxic"]: r["n"] for r in found}
    place = F.pmod(F.xxhash64("doc_id", F.lit(10)), F.lit(1 << 30))
    limit = F.when(F.col("toxic") == 1, _share(rows, n.get(1, 0))).otherwise(_share(rows, n.get(0, 0)))
    chosen = sized.where(short & (place < limit)).select("doc_id", "toxic").distinct().limit(rows)
    got = texts.where(short).join(F.broadcast(chosen), "doc_id").select("text", "toxic", place.alias("place")).limit(rows).collect()
    few = min(FEW, rows // 2)
    for r in found:
        if r["n"] < min(few, r["all"]):
            by_size = Window.partitionBy("toxic").orderBy("size", "place", "doc_id")
            longer = sized.where(~short & (F.col("toxic") == r["toxic"])).withColumn("place", place) \
                .withColumn("rank", F.row_number().over(by_size)).where(F.col("rank") <= few - r["n"]) \
                .withColumn("bytes", F.sum("size").over(by_size.rowsBetween(Window.unboundedPreceding, 0))) \
                .where(F.col("bytes") <= (rows // 2 - r["n"]) * TRAIN_BYTES).select("doc_id", "size", "toxic", "place").distinct()
            got += texts.join(F.broadcast(longer), ["doc_id", "size"]).select("text", "toxic", "place").limit(few - r["n"]).collect()
    missing = sorted(set(n) - {r["toxic"] for r in got})
    if missing:
        raise ValueError(f"no text short enough to learn from with label {missing}")
    got.sort(key=lambda r: (r["place"], r["text"]))
    return [r["text"].encode() for r in got], [r["toxic"] for r in got]


def _share(rows: int, n: int) -> int:
    return int(min(1.0, 0.95 * rows / 2 / max(n, 1)) * (1 << 30))


def graded(texts: list[bytes], toxic: list[int], severe: int = 3) -> list[int]:
    """Grades 0, 1, 2 from 0/1 labels: a toxic text is severe when it has ``severe`` words or more
    that sample rows use almost only when they are toxic."""
    first = train(texts, toxic)
    marks = pa.array([w for w, x in zip(first.vocabulary, first.weights, strict=True) if x > 1], pa.large_binary())
    marked = np.zeros(len(texts), np.int64)
    for lo, part in _chunks(texts):
        text, _, count = counted(part, marks)
        np.add.at(marked, lo + text, count)
    return [0 if not t else 2 if n >= severe else 1 for t, n in zip(toxic, marked.tolist(), strict=True)]


def severity(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, expected_severity, grade, toxic`` of each row of ``docs`` (``doc_id``, ``text``).

    ``grade`` is the largest one that is exceeded or met with probability one half or more;
    ``toxic`` means a grade above 0. Null and empty texts have no features: their severity is
    that of a text without any. Whole texts count; null ids stay null; repeated rows get equal
    results; other columns are ignored.
    """
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(model)      # MAX_WORDS words at most

    def rate(batches):
        for part in slices(batches):
            p = sent.value.exceed(sent.value.scores(*flat(column_of(part, "text"))))
            grade = (p >= 0.5).sum(1)
            yield pa.RecordBatch.from_arrays([
                column_of(part, "doc_id"), pa.array(p.sum(1)), pa.array(grade.astype(np.int32)),
                pa.array(grade > 0)], ["doc_id", "expected_severity", "grade", "toxic"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(rate, "doc_id long, expected_severity double, grade int, toxic boolean")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    texts, toxic = training_sample(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return severity(docs, train(texts, graded(texts, toxic)))
