"""Operator 5: near-duplicates by HyperMinHash registers, exact links on full shingle sets.

A document's shingle hashes fall into REGISTERS buckets. Of the least hash in a bucket the
register keeps the number of leading zeros and four bits after them, one byte in all, zero if
the bucket is empty. Documents whose least hashes agree in a band, a fixed group of buckets,
are candidates. Equal texts are one node from the start.

In each band's bucket the node that shares most with others is the hub: all nodes of the bucket
are compared with it first. Then only pairs that are not yet in one component are left: the
outsiders of a bucket against all its members, in blocks of bounded size. Either way the
registers' Jaccard estimate, corrected for registers that agree by chance, has to come near the
threshold, and the link is confirmed on full sets.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from flotilla.llm.common import (NOT_WHITE, Words, binary_array, column_of, digest, documents, flat, id_back, id_or_last,
                                 later_copies, mix, ship, slices, stored, trimmed)
from flotilla.llm.components import components

ROWS, BANDS = 5, 32         # a pair at 0.85 shares no band once in 10**8, one at 0.8 once in 3 * 10**5
COARSE = ROWS * BANDS       # buckets that bands are made of
REGISTERS = 4 * COARSE
ZEROS_MOST, MANTISSA_BITS = 14, 4
# Different least hashes give the same register with a probability between 1 / 88 (many shingles
# in a bucket) and 1 / 48 (one): about this.
CHANCE = 1 / 64
# A pair is dropped unverified when its estimate is this many standard errors below the threshold:
# of pairs at the threshold, 6 in 10**9, no more than share no band at 0.85.
SLACK = 5.7
BLOCK = 256                 # nodes on either side of a block of comparisons
MEMBERS = 2000              # nodes compared with one copy of a hub's set in a task
SLICE = 2 << 20             # bytes of text that a task sketches at a time (some 20 times as much memory)
SENT_BYTES = 4 << 20        # bytes of sets in a batch
# Ids of the documents whose sets are needed go to all executors up to this many.
BROADCAST_IDS = 300_000


@dataclass(frozen=True)
class Rule:
    """Shingles of ``words`` words; links from ``percent`` hundredths of Jaccard similarity."""
    words: int = 5
    percent: int = 80


# --- shingle sets and registers ---------------------------------------------------------

def shingle_sets(data: np.ndarray, off: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of texts, ascending in each text, and n + 1 offsets."""
    import xxhash

    words = Words(data, off, NOT_WHITE)
    coded = words.array.dictionary_encode()
    known = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()), np.uint64,
                        len(coded.dictionary))
    h = known[coded.indices.to_numpy()]
    n_texts, n = len(off) - 1, len(h)
    per_text = np.diff(words.off)
    found, owner = [], []
    text_of = np.repeat(np.arange(n_texts), per_text)
    # texts of k words and more: every window; shorter ones: all words as one
    for size in range(1, k + 1):
        if size == k:
            at = np.flatnonzero(np.arange(n) + k <= words.off[1:][text_of]) if n else np.zeros(0, np.int64)
        else:
            at = words.off[:-1][per_text == size]
        s = np.full(len(at), size, np.uint64)
        for j in range(size):
            s = mix(s ^ h[at + j])
        found.append(s)
        owner.append(text_of[at])
    s, t = np.concatenate(found), np.concatenate(owner)
    order = np.argsort(s)
    t = t[order].astype(np.uint16 if n_texts < 65536 else np.int64)
    by_text = np.argsort(t, kind="stable")
    s, t = s[order][by_text], t[by_text]
    fresh = np.ones(len(s), bool)
    fresh[1:] = (s[1:] != s[:-1]) | (t[1:] != t[:-1])
    s, t = s[fresh], t[fresh]
    return s, np.searchsorted(t, np.arange(n_texts + 1))


def _places(sets: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of each hash and its place in the bucket; both ascend with the hash."""
    scaled = (sets >> np.uint64(32)) * np.uint64(buckets)
    place = (scaled << np.uint64(32)) | (sets & np.uint64(0xFFFFFFFF))
    return (scaled >> np.uint64(32)).astype(np.int64), place


def _least(text: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """Where a text's hashes enter a bucket: there the least one of it stands."""
    first = np.ones(len(text), bool)
    first[1:] = (bucket[1:] != bucket[:-1]) | (text[1:] != text[:-1])
    return np.flatnonzero(first)


def registers(sets: np.ndarray, off: np.ndarray) -> np.ndarray:
    """One row of REGISTERS bytes for each set."""
    n = len(off) - 1
    out = np.zeros((n, REGISTERS), np.uint8)
    text = np.repeat(np.arange(n), np.diff(off))
    bucket, place = _places(sets, REGISTERS)
    at = _least(text, bucket)
    place = place[at]
    top = (place >> np.uint64(11)).astype(np.float64)       # 53 bits: exact
    zeros = np.where(top > 0, 53 - np.frexp(top)[1], 53).astype(np.uint64)
    after = (place << np.minimum(zeros + np.uint64(1), np.uint64(63))) >> np.uint64(64 - MANTISSA_BITS)
    zeros = np.minimum(zeros, np.uint64(ZEROS_MOST))
    out[text[at], bucket[at]] = (zeros << np.uint64(MANTISSA_BITS)) + after + np.uint64(1)
    return out


def band_keys(sets: np.ndarray, off: np.ndarray) -> np.ndarray:
    """One row of BANDS hashes of the bands' least hashes for each set; 0 where a band is empty."""
    n = len(off) - 1
    text = np.repeat(np.arange(n), np.diff(off))
    bucket, _ = _places(sets, COARSE)
    at = _least(text, bucket)
    least = np.zeros((n, COARSE), np.uint64)
    least[text[at], bucket[at]] = mix(sets[at] + np.uint64(1)) | np.uint64(1)
    least = least.reshape(n, BANDS, ROWS)
    out = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (n, BANDS)).copy()
    for j in range(ROWS):
        out = mix(out ^ least[:, :, j])
    out[~least.any(-1)] = 0
    return out


def estimates(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Jaccard estimates of register rows, corrected for agreement by chance, and the number of
    registers they rest on."""
    used = ((a != 0) | (b != 0)).sum(-1)
    both = ((a != 0) & (b != 0)).sum(-1)
    same = ((a == b) & (a != 0)).sum(-1)
    return (same - CHANCE * both) / (1 - CHANCE) / np.maximum(used, 1), used


def near_enough(a, b, size_a, size_b, percent: int) -> np.ndarray:
    """Whether estimates come within SLACK standard errors of the threshold. The registers in use
    are a sample, without replacement, of the union; chance agreement adds its own noise."""
    value, used = estimates(a, b)
    t, used = percent / 100, np.maximum(used, 1)
    union = np.maximum((size_a + size_b) / (1 + t), 2)
    unseen = np.clip((union - used) / (union - 1), 0, 1)
    return value >= t - SLACK * np.sqrt((t * (1 - t) * unseen + 0.004) / used)


def _offsets(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])


def _rows(table: np.ndarray, full: np.ndarray) -> pa.Array:
    """The rows of a table of bytes as binary; null where not ``full``."""
    off = _offsets(np.where(full, table.shape[1], 0))
    return pa.Array.from_buffers(pa.binary(), len(full), [
        pa.array(full).buffers()[1], pa.py_buffer(off.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(table[full]))])


# --- the steps --------------------------------------------------------------------------

def sketches(firsts: DataFrame, rule: Rule) -> DataFrame:
    """``id, digest, n, bands, regs`` of each row with ``id, digest, text``."""
    ship(firsts.sparkSession)

    def sketch(batches):
        for part in slices(batches, limit=SLICE):
            sets, off = shingle_sets(*flat(column_of(part, "text")), rule.words)
            full = np.diff(off) > 0
            regs = _rows(registers(sets, off), full)
            keys = band_keys(sets, off)
            used = keys != 0
            keys = pa.ListArray.from_arrays(pa.array(_offsets(used.sum(1)), pa.int32()), pa.array(keys[used].view(np.int64)))
            yield pa.RecordBatch.from_arrays([column_of(part, "id"), column_of(part, "digest"), pa.array(np.diff(off)),
                                              keys, regs], ["id", "digest", "n", "bands", "regs"])

    return firsts.select("id", "digest", "text") \
        .mapInArrow(trimmed(sketch), "id long, digest binary, n long, bands array<long>, regs binary")


def _hubs(bands: DataFrame) -> DataFrame:
    """``key, node, hub`` of the buckets with two nodes or more. A node's weight is how many others
    it meets in all its buckets; the hub is the heaviest node, and of those the least."""
    sizes = bands.groupBy("key").agg(F.count("*").alias("size")).where(F.col("size") > 1)
    shared = stored(bands.join(sizes, "key"), "shared-bands")
    weights = shared.groupBy("node").agg(F.sum("size").alias("weight"))
    heaviest = shared.select("key", "node").join(weights, "node").groupBy("key") \
        .agg(F.min(F.struct((-F.col("weight")).alias("w"), "node")).alias("first")).select("key", F.col("first.node").alias("hub"))
    return stored(shared.select("key", "node").join(heaviest, "key"), "members")


def verified(pairs: DataFrame, nodes: DataFrame, base: DataFrame, rule: Rule) -> DataFrame:
    """Of ``pairs`` (``hub``, ``node``), those linked by their full sets.

    Sets are made from whole texts of the nodes' documents and sent to the hub's tasks: a hub
    with many members has several, each with its own copy of the hub's set.
    """
    pairs = stored(pairs, "pairs")
    splits = pairs.groupBy("hub").agg(F.ceil(F.count("*") / F.lit(MEMBERS)).cast("int").alias("parts"))
    members = pairs.join(splits, "hub").select(
        "node", F.struct("hub", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part"),
                         F.lit(1).alias("role")).alias("role"))
    hubs = splits.select(F.col("hub").alias("node"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")) \
        .select("node", F.struct(F.col("node").alias("hub"), "part", F.lit(0).alias("role")).alias("role"))
    roles = stored(members.unionByName(hubs).groupBy("node").agg(F.collect_list("role").alias("roles"))
                   .join(nodes.select("node", "id", "digest"), "node"), "roles")
    if roles.count() <= BROADCAST_IDS and pairs.count() <= BROADCAST_IDS:
        roles = F.broadcast(roles)
    texts = base.join(roles, ["id", "digest"])      # a row that repeats sends its set twice: no harm

    def build(batches):
        for part in slices(batches, limit=SLICE):
            sets, off = shingle_sets(*flat(column_of(part, "text")), rule.words)
            own = column_of(part, "roles")
            times = own.value_lengths().to_numpy()
            roles, text = own.flatten(), np.repeat(np.arange(part.num_rows), times)
            whole, size = binary_array(sets.view(np.uint8), 8 * off), np.cumsum(8 * np.diff(off)[text])
            lo = 0
            while lo < len(text):
                hi = max(lo + 1, int(np.searchsorted(size, SENT_BYTES + (size[lo - 1] if lo else 0), "right")))
                at = pa.array(text[lo:hi])
                here = roles.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*(here.field(c) for c in ("hub", "part", "role")), column_of(part, "node").take(at),
                                                  whole.take(at).cast(pa.binary())], ["hub", "part", "role", "node", "set"])
                lo = hi

    def compare(batches):
        hub, own = None, None
        for batch in batches:
            data, off = flat(column_of(batch, "set"))
            kept = []
            for i, (hub_id, node, role) in enumerate(zip(*(column_of(batch, c).to_pylist() for c in ("hub", "node", "role")),
                                                         strict=True)):
                values = np.frombuffer(data[off[i]:off[i + 1]].tobytes(), np.uint64)
                if role == 0:
                    hub, own = hub_id, values
                    continue
                if hub != hub_id:
                    raise ValueError("a hub's set is missing")
                shared = len(np.intersect1d(own, values, assume_unique=True))
                if 100 * shared >= rule.percent * (len(own) + len(values) - shared):
                    kept.append((hub_id, node))
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in kept], pa.int64()),
                                              pa.array([x for _, x in kept], pa.int64())], ["a", "b"])

    sent = texts.mapInArrow(trimmed(build), "hub long, part int, role int, node long, set binary")
    return sent.repartition("hub", "part").sortWithinPartitions("hub", "part", "role", "node") \
        .mapInArrow(trimmed(compare), "a long, b long").distinct()


def _estimated(pairs: DataFrame, nodes: DataFrame, rule: Rule) -> DataFrame:
    """The ``hub, node`` pairs whose registers come near the threshold."""
    def look(batches):
        for b in batches:
            a, c = (flat(column_of(b, x))[0].reshape(-1, REGISTERS) for x in ("regs_a", "regs_b"))
            ok = near_enough(a, c, column_of(b, "n_a").to_numpy(), column_of(b, "n_b").to_numpy(), rule.percent)
            yield b.select(["hub", "node"]).filter(pa.array(ok))

    side = lambda name, tag: nodes.select(
        F.col("node").alias(name), F.col("regs").alias(f"regs_{tag}"), F.col("n").alias(f"n_{tag}"))
    return pairs.join(side("hub", "a"), "hub").join(side("node", "b"), "node") \
        .mapInArrow(trimmed(look), "hub long, node long")


def _across(open_members: DataFrame, nodes: DataFrame, rule: Rule) -> DataFrame:
    """Pairs of different labels in the same bucket whose registers come near the threshold.
    ``open_members``: ``key, node, label, outside, n_out, n_all``. Outsiders meet all members
    of their bucket, block by block; a block has about BLOCK nodes on either side. Of the buckets
    that a pair has in common, each of which holds it, only the one with the least key tells."""
    def blocks(count):
        return F.ceil(F.col(count) / F.lit(BLOCK)).cast("int")

    rows = open_members.join(nodes.select("node", "regs", "n", "bands"), "node") \
        .withColumn("nb_out", blocks("n_out")).withColumn("nb_all", blocks("n_all"))
    own = F.xxhash64("node")
    left = rows.where("outside").select(
        "key", F.pmod(own, F.col("nb_out")).cast("int").alias("i"),
        F.explode(F.sequence(F.lit(0), F.col("nb_all") - 1)).alias("j"), F.lit(0).alias("side"), "node", "label", "outside", "n", "regs", "bands")
    right = rows.select(
        "key", F.explode(F.sequence(F.lit(0), F.col("nb_out") - 1)).alias("i"),
        F.pmod(own, F.col("nb_all")).cast("int").alias("j"), F.lit(1).alias("side"), "node", "label", "outside", "n", "regs", "bands")
    dealt = left.unionByName(right).repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "side")

    def groups(batches):
        """Runs of rows with equal (key, i, j), over batch borders."""
        held = None
        for b in batches:
            held = b if held is None else pa.concat_batches([held, b])
            codes = [column_of(held, c).to_numpy() for c in ("key", "i", "j")]
            change = np.zeros(held.num_rows, bool)
            for c in codes:
                change[1:] |= c[1:] != c[:-1]
            at = [0, *np.flatnonzero(change).tolist()]
            for lo, hi in zip(at[:-1], at[1:], strict=True):
                yield held.slice(lo, hi - lo)
            held = held.slice(at[-1])
        if held is not None and held.num_rows:
            yield held

    def meet(batches):
        found_a, found_b = [], []

        def rows():
            return pa.RecordBatch.from_arrays([pa.array(found_a, pa.int64()), pa.array(found_b, pa.int64())], ["x", "y"])

        for g in groups(batches):
            regs = flat(column_of(g, "regs"))[0].reshape(-1, REGISTERS)
            node, label, n = (column_of(g, c).to_numpy() for c in ("node", "label", "n"))
            side = column_of(g, "side").to_numpy()
            out = np.asarray(column_of(g, "outside").to_pylist(), bool)
            a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            key, bands, keys = column_of(g, "key")[0].as_py(), column_of(g, "bands"), {}

            def keys_of(row):
                if row not in keys:
                    keys[row] = frozenset(bands[int(row)].as_py())
                return keys[row]

            for x in a:
                # two outsiders meet twice: once is enough
                y = b[(label[b] != label[x]) & (~out[b] | (node[b] > node[x]))]
                ok = y[near_enough(regs[x][None, :], regs[y], n[x], n[y], rule.percent)] if len(y) else y
                here = [z for z in ok if min(keys_of(x) & keys_of(z)) == key]
                found_a += [int(node[x])] * len(here)
                found_b += node[here].tolist()
            if len(found_a) > 10_000:
                yield rows()
                found_a, found_b = [], []
        yield rows()

    return dealt.mapInArrow(trimmed(meet), "x long, y long") \
        .select(F.least("x", "y").alias("hub"), F.greatest("x", "y").alias("node")).distinct()


def near_duplicates(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """``id, digest, doc_id, n_shingles, component_id, kept`` for each row of ``docs`` (``doc_id``,
    ``text``).

    ``component_id`` is the smallest id that links reach; ``kept`` says that the row has it. Rows
    without words (null, empty, white space) link with nothing and are kept. Rows without an id
    come after all ids; in a component of such rows only, the component is null and they are
    kept. Rows that repeat an id and a text are kept or not alike. Empty tables give no rows;
    other columns are ignored.
    """
    return _grouped(docs, rule).drop("group")


def _grouped(docs: DataFrame, rule: Rule) -> DataFrame:
    """``near_duplicates`` with ``group``, a number for each component; null for rows without words."""
    base = _base(docs)
    firsts = base.join(later_copies(base), ["id", "digest"], "left").where(F.col("copy").isNull()).drop("copy")
    found = stored(sketches(firsts, rule).withColumn("node", F.monotonically_increasing_id()), "sketches")
    # a row that repeats an id and a text is one node
    one = found.groupBy("id", "digest").agg(F.min("node").alias("node"), F.max("n").alias("n"))
    bands = found.where(F.size("bands") > 0).select("node", F.explode("bands").alias("key"))
    members = _hubs(bands)
    nodes = stored(found.join(members.select("node").distinct(), "node", "left_semi"), "nodes")
    stars = members.where(F.col("hub") != F.col("node")).select("hub", "node").distinct()
    links = stored(verified(_estimated(stars, nodes, rule), nodes, base, rule), "links")
    first = components(links)

    labelled = members.join(first, "node", "left").withColumn("label", F.coalesce("label", "node"))
    per_key = labelled.groupBy("key").agg(
        F.min("label").alias("l0"), F.max("label").alias("l1"),
        F.max(F.when(F.col("node") == F.col("hub"), F.col("label"))).alias("main"),
        F.count("*").alias("n_all")).where(F.col("l0") != F.col("l1")).drop("l0", "l1")
    marked = labelled.select("key", "node", "label").join(per_key, "key") \
        .withColumn("outside", F.col("label") != F.col("main"))
    n_out = marked.where("outside").groupBy("key").agg(F.count("*").alias("n_out"))
    across = _across(marked.join(n_out, "key").select("key", "node", "label", "outside", "n_out", "n_all"), nodes, rule)
    more = verified(across, nodes, base, rule)
    labels = stored(components(links.unionByName(more)), "labels")

    named = one.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = named.groupBy("label").agg(F.min("id").alias("component"))
    by_text = named.join(least, "label").groupBy("digest").agg(F.min("component").alias("component"), F.max("n").alias("n"),
                                                             F.min("label").alias("group"))
    return base.select("id", "digest").join(by_text, "digest") \
        .withColumn("component", F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id"))) \
        .select("id", "digest", id_back(F.col("id")).alias("doc_id"), F.col("n").alias("n_shingles"),
                id_back(F.col("component")).alias("component_id"), (F.col("id") == F.col("component")).alias("kept"),
                F.when(F.col("n") > 0, F.col("group")).alias("group"))


def _base(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(id_or_last().alias("id"), text.alias("text"), digest(text).alias("digest"))


def one_of_each(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """The rows of ``docs``, all columns, that ``near_duplicates`` keeps, but a single one of each
    component: if its least id has several rows, or all lack an id, the first by text digest and
    the other columns. Rows without words all stay."""
    marks = stored(_grouped(docs, rule).select("id", "digest", "kept", "group"), "verdicts")
    gone = _small(stored(marks.where(~F.col("kept")).select("id", "digest").distinct(), "gone"))
    kept = marks.where(F.col("kept") & F.col("group").isNotNull())
    several = kept.groupBy("group").agg(F.count("*").alias("rows")).where(F.col("rows") > 1).select("group")
    tied = stored(kept.join(several, "group").select("id", "digest", "group").distinct(), "tied")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), id_or_last().alias("id"),
                       digest(text).alias("digest")).join(gone, ["id", "digest"], "left_anti")
    if tied.isEmpty():
        return rows.select("row.*")
    order = Window.partitionBy("group").orderBy("id", "digest", F.xxhash64(F.to_json("row")), F.to_json("row"))
    first = rows.join(_small(tied), ["id", "digest"]).withColumn("place", F.row_number().over(order)).where(F.col("place") == 1)
    alone = rows.join(_small(tied.select("id", "digest")), ["id", "digest"], "left_anti")
    return alone.select("row").unionByName(first.select("row")).select("row.*")


def _small(keys: DataFrame) -> DataFrame:
    return F.broadcast(keys) if keys.count() <= BROADCAST_IDS else keys


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), Rule(words=3, percent=85)).drop("id", "digest")
