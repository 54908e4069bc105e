"""Operator 8: language of a text by averaged hashed subword embeddings.

A text's byte n-grams are hashed to rows of an embedding table; their mean goes through a
linear softmax. Table and softmax are trained together by stochastic gradient descent on a
bounded, stratified sample of rows: tasks count the n-grams of their whole texts, so the driver
gets bucket counts, not texts. On a part of the sample that training doesn't see, a temperature
makes the scores probabilities, and a threshold is set below which a prediction is rejected.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from flotilla.llm.common import column_of, documents, flat, ship, slices, trimmed

TRAIN_ROWS = 4000           # most rows of the training sample, over all languages (8 bytes a bucket in use, each)
BUCKETS, WIDTH = 4096, 16   # rows and columns of the embedding table
GRAMS = (2, 3)
EPOCHS, BATCH, RATE = 6, 32, 20.0
SLICE = 2 << 20
STRIDE = 1 << 20            # n-grams looked up at a time
WANTED = 0.99               # accuracy that accepted predictions should have on unseen rows
SPARED = 0.005              # share of the right predictions on unseen rows that rejection may cost
UNDETERMINED = "und"
_SEEN = np.arange(256, dtype=np.uint8)      # bytes as n-grams see them: lower case, no ASCII signs
_SEEN[65:91] += 32
_SEEN[[c for c in range(128) if not chr(c).isalpha()]] = 32
_ASCII_LETTER = np.array([c < 128 and chr(c).isalpha() for c in range(256)])


def gram_codes(data: np.ndarray, off: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of each n-gram inside a text, in order, and n + 1 offsets of the texts."""
    seen = _SEEN[data].astype(np.uint32)
    count = max(0, len(data) - n + 1)
    code = np.full(count, n, np.uint32)
    blank = np.ones(count, bool)
    for j in range(n):
        code = code * np.uint32(257) + seen[j:j + count]
        blank &= seen[j:j + count] == 32
    code = (code * np.uint32(2654435761)) >> np.uint32(32 - int(BUCKETS).bit_length() + 1)
    inside = ~blank
    for k in range(1, n):                       # no n-gram spans two texts
        at = off[1:-1] - k
        inside[at[(at >= 0) & (at < count)]] = False
    where = np.flatnonzero(inside)
    return code[where].astype(np.int64), np.searchsorted(where, off)


def has_letter(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    running = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_ASCII_LETTER[data], out=running[1:])
    out = running[off[1:]] > running[off[:-1]]
    for i in np.flatnonzero(~out & (np.diff(off) > 0)):
        out[i] = any(c.isalpha() for c in data[off[i]:off[i + 1]].tobytes().decode())
    return out


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray           # BUCKETS x languages: embeddings times softmax weights
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def logits(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        total, count = np.zeros((len(off) - 1, len(self.languages))), np.zeros(len(off) - 1)
        for n in GRAMS:
            code, bounds = gram_codes(data, off, n)
            count += np.diff(bounds)
            for lo in range(0, len(code), STRIDE):
                part = np.clip(bounds, lo, min(lo + STRIDE, len(code))) - lo
                full = np.flatnonzero(np.diff(part))
                total[full] += np.add.reduceat(self.table[code[lo:lo + STRIDE]], part[full], axis=0)
        return total / np.maximum(count, 1)[:, None] + self.bias

    def predict(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The index of the likeliest language of each text and its probability."""
        if not self.languages:
            return np.zeros(len(off) - 1, np.int64), np.zeros(len(off) - 1)
        p = softmax(self.logits(data, off) / self.temperature)
        return p.argmax(1), p.max(1)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def bucket_counts(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """texts x BUCKETS: how often n-grams of each text fall into each bucket."""
    out = np.zeros((len(off) - 1, BUCKETS), np.float32)
    for i, (a, b) in enumerate(zip(off[:-1], off[1:], strict=True)):
        for n in GRAMS:
            out[i] += np.bincount(gram_codes(data[a:b], np.array([0, b - a]), n)[0], minlength=BUCKETS)
    return out


def train(texts: list[bytes], labels: list[str], seed: int = 7) -> Model:
    """``fit`` on the n-grams of texts."""
    off = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)]).astype(np.int64)
    return fit(bucket_counts(np.frombuffer(b"".join(texts), np.uint8), off), labels, seed)


def fit(counts: np.ndarray, labels: list[str], seed: int = 7) -> Model:
    """Fit on four fifths of the rows, calibrate on the rest. Row order is part of the input. No
    rows give a model of no languages, which leaves every text undetermined."""
    languages = sorted(set(labels))
    if not languages:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0, np.float32))
    y = np.array([languages.index(x) for x in labels])
    features = counts / np.maximum(counts.sum(1, keepdims=True), 1)
    rng = np.random.default_rng(seed)
    unseen = np.arange(len(y)) % 5 == 4
    own = np.flatnonzero(~unseen)
    embed = rng.normal(0, 0.1, (BUCKETS, WIDTH)).astype(np.float32)
    weight = rng.normal(0, 0.3, (WIDTH, len(languages))).astype(np.float32)
    bias = np.zeros(len(languages), np.float32)
    steps, done = EPOCHS * max(1, len(own) // BATCH), 0
    for _ in range(EPOCHS):
        rng.shuffle(own)
        for lo in range(0, len(own), BATCH):
            rate = RATE * max(0.05, 1 - done / steps)
            done += 1
            pick = own[lo:lo + BATCH]
            x = features[pick]
            mean = x @ embed
            error = softmax(mean @ weight + bias)
            error[np.arange(len(pick)), y[pick]] -= 1
            error /= len(pick)
            back = error @ weight.T
            weight -= rate / 10 * (mean.T @ error)
            bias -= rate / 100 * error.sum(0)
            embed -= rate * (x.T @ back)
    model = Model(languages, (embed @ weight).astype(np.float32), bias)
    if unseen.any():
        logits, truth = features[unseen] @ model.table + bias, y[unseen]
        rows = np.arange(len(truth))
        model.temperature = float(min(np.geomspace(0.05, 20, 60), key=lambda t: -np.log(
            softmax(logits / t)[rows, truth] + 1e-9).mean()))
        p = softmax(logits / model.temperature)
        sure, right = p.max(1), p.argmax(1) == truth
        order = np.argsort(-sure)
        good = np.flatnonzero(np.cumsum(right[order]) >= WANTED * np.arange(1, len(order) + 1))
        model.threshold = float(sure[order[good[-1]]]) if len(good) else 1.0
        if right.any():
            model.threshold = max(model.threshold, float(np.quantile(sure[right], SPARED)))
    return model


def held_out(doc_id: Column) -> Column:
    """Rows that training never sees; a null id counts as an empty one."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def training_sample(docs: DataFrame, rows: int = TRAIN_ROWS) -> tuple[np.ndarray, list[str]]:
    """Bucket counts and languages of about equally many rows of each language, ``rows`` at most,
    in a fixed order. A hash of id and text alone decides which (a language whose share is only a
    few rows may be missed); equal rows count once. Texts are whole, however long. A table without
    labelled text gives none."""
    ship(docs.sparkSession)
    text = F.col("text").cast("string")
    able = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")) & (F.octet_length(text) > 0)) \
        .select(F.col("lang").cast("string").alias("lang"), text.alias("text"), F.xxhash64("doc_id", text, F.lit(8)).alias("place"))
    counts = {r["lang"]: r["n"] for r in able.groupBy("lang").agg(F.count("*").alias("n")).orderBy("lang").limit(rows + 1).collect()}
    if not counts:
        return np.zeros((0, BUCKETS), np.float32), []
    if len(counts) > rows:
        raise ValueError(f"more than {rows} languages")
    share = rows // len(counts)
    part = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, int(min(1.0, 0.95 * share / n) * (1 << 30)))])
    chosen = able.where(F.pmod("place", F.lit(1 << 30)) < part[F.col("lang")]).groupBy("lang", "place").agg(F.min("text").alias("text"))

    def count(batches):
        for b in slices(batches, limit=SLICE):
            own = bucket_counts(*flat(column_of(b, "text")))
            text_, bucket = np.nonzero(own)
            ends = pa.array(np.searchsorted(text_, np.arange(b.num_rows + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays([
                column_of(b, "lang"), column_of(b, "place"), pa.ListArray.from_arrays(ends, pa.array(bucket.astype(np.int32))),
                pa.ListArray.from_arrays(ends, pa.array(own[text_, bucket]))], ["lang", "place", "bucket", "n"])

    got = chosen.mapInArrow(trimmed(count), "lang string, place long, bucket array<int>, n array<float>").toArrow().combine_chunks()
    order = np.lexsort((got["lang"].to_numpy(), got["place"].to_numpy()))[:rows]
    got = got.take(pa.array(order))
    out = np.zeros((got.num_rows, BUCKETS), np.float32)
    bucket, n = got["bucket"].combine_chunks(), got["n"].combine_chunks()
    where = np.repeat(np.arange(got.num_rows), bucket.value_lengths().to_numpy())
    out[where, bucket.flatten().to_numpy()] = n.flatten().to_numpy()
    return out, got["lang"].to_pylist()


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, lang_pred, score, rejected`` of each row of ``docs`` (``doc_id``, ``text``).

    A text that is null or has no letter is ``und`` with score 0 and rejected; so is every text if
    the model knows no language. ``rejected`` also marks scores below the model's threshold. Whole texts count, however long; null ids stay
    null; repeated rows get equal results; other columns are ignored.
    """
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(model)      # BUCKETS x languages numbers

    def predict(batches):
        own = sent.value
        names = np.array([*own.languages, UNDETERMINED], object)
        for part in slices(batches, limit=SLICE):
            data, off = flat(column_of(part, "text"))
            best, score = own.predict(data, off)
            letters = has_letter(data, off)
            unknown = ~letters | (not own.languages)
            best[unknown], score[unknown] = len(own.languages), 0.0
            yield pa.RecordBatch.from_arrays([
                column_of(part, "doc_id"), pa.array(names[best], pa.string()), pa.array(score, pa.float64()),
                pa.array(unknown | (score < own.threshold))], ["doc_id", "lang_pred", "score", "rejected"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(predict, "doc_id long, lang_pred string, score double, rejected boolean")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = fit(*training_sample(docs))
    return identify(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")
