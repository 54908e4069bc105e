"""Operator 1: removal of repeated 50-byte strings by two-stage suffix sorting.

A byte goes when a string of LENGTH bytes that covers it also starts in a document with a
smaller id. Equal texts are settled first: all but those with the least id go whole. In the
other texts each LENGTH-byte window has a signature, the least hash of its GRAM-byte pieces;
equal windows have equal signatures, and neighbouring windows mostly share one, so a text is
a sequence of fragments, each the windows of one signature.

1. Signatures are sent, with ids, to buckets that answer which of them two ids have.
2. Fragments of those are brought together by signature. Their suffixes are sorted in two
   stages: those whose first byte isn't above the next one are sorted directly, the others
   are induced by one scan over the buckets of first bytes. Adjacent common prefixes of
   LENGTH bytes and more join equal windows, and the least id of each is known.
3. Every occurrence of a fragment takes that verdict, and the covered bytes go.

A signature with so many occurrences that sorting its fragments could take too much memory is
heavy. Its windows are dealt out by their own hashes instead: blocks of text settle what they can
and ask, for each window once, whether a smaller id than their least has it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from flotilla.llm.common import (binary_array, column_of, digest, documents, flat, id_back, id_or_last, later_copies,
                                 merged, mix, ranges, ship, slices, stored)

LENGTH, GRAM = 50, 16
BLOCK = 1 << 20             # windows whose signatures are computed at a time
BUCKET_BYTES = 32 << 20     # text whose signatures go to one bucket, or windows of heavy ones
WINDOW_BYTES = 28           # of a heavy signature's window in a bucket
SORT_BYTES = 4 << 20        # fragments sorted together; those of one signature are, unless it's heavy
# A fragment has this many windows at most, unless its text repeats itself: then it counts as several.
USUAL = LENGTH - GRAM + 1
HEAVY = SORT_BYTES // (USUAL + LENGTH - 1)      # occurrences of a signature from which it's heavy


def _words64(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position on as a number; zeros follow the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((len(data),), "<u8", padded.data, 0, (1,)).copy()


def fragments(data: np.ndarray, off: np.ndarray):
    """Runs of windows with one signature, block by block: (text, first byte, windows, signature)."""
    for lo in range(0, max(0, len(data) - LENGTH + 1), BLOCK):
        hi = min(lo + BLOCK, len(data) - LENGTH + 1)
        word = _words64(data[lo:hi + LENGTH - 1])
        n = len(word) - GRAM + 1
        least = mix(mix(word[:n]) + word[8:8 + n])
        width, wanted = 1, LENGTH - GRAM + 1
        while width * 2 <= wanted:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        least = np.minimum(least[:len(least) - (wanted - width)], least[wanted - width:])
        at = np.arange(lo, hi)
        text = np.searchsorted(off, at, "right") - 1
        inside = at + LENGTH <= off[text + 1]
        first = np.ones(hi - lo, bool)
        first[1:] = (least[1:] != least[:-1]) | (text[1:] != text[:-1]) | ~inside[:-1]
        start = np.flatnonzero(first & inside)
        last = inside.copy()
        last[:-1] &= first[1:] | ~inside[1:]
        count = np.flatnonzero(last) - start + 1
        yield text[start], at[start], count, least[start]


# --- suffix sorting ---------------------------------------------------------------------

def two_stage_order(text: np.ndarray, at: np.ndarray, first: np.ndarray, last: np.ndarray,
                    room: np.ndarray) -> np.ndarray:
    """The positions ``at`` (ascending) in the order of the LENGTH bytes that start there.

    ``first``: no position precedes it in its fragment. ``last``: it's the last one taken of its
    fragment, to whose end ``room`` bytes are left; what its predecessors need of it, they have.
    For all others the next position is in ``at`` too.
    """
    byte = text[at]
    direct = last | (byte <= np.append(byte[1:], 0))
    # stage one: sort directly, by the bytes themselves
    own = np.flatnonzero(direct)
    word = _words64(text)
    key = np.zeros((len(own), 56), np.uint8)
    wide = key.view(">u8")
    for k in range(0, LENGTH, 8):
        wide[:, k // 8] = word[np.minimum(at[own] + k, len(word) - 1)].byteswap()
    key[:, LENGTH:] = 0
    short = np.flatnonzero(room[own] < LENGTH)
    key[short] *= np.arange(56) < room[own[short], None]
    own = own[np.argsort(key.view("S56").ravel(), kind="stable")]
    own_byte = byte[own]
    split = np.searchsorted(own_byte, np.arange(257))
    # stage two: scan the buckets of first bytes; each suffix places the larger one before it
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    out = []
    for c in range(256):
        bucket = np.concatenate([*induced[c], own[split[c]:split[c + 1]]]) if induced[c] else own[split[c]:split[c + 1]]
        if not len(bucket):
            continue
        out.append(bucket)
        before = bucket[~first[bucket]] - 1
        before = before[~direct[before]]
        if len(before):
            chars = byte[before]
            order = np.argsort(chars, kind="stable")
            before, chars = before[order], chars[order]
            edge = np.flatnonzero(np.diff(chars)) + 1
            for part in np.split(before, edge):
                induced[byte[part[0]]].append(part)
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def common_prefixes(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Common prefix, LENGTH at most, of each position and the one before it in ``at``."""
    word = _words64(text)
    out = np.full(len(at), LENGTH, np.int64)
    if len(out):
        out[0] = 0
    steps = [*range(0, LENGTH - 8, 8), LENGTH - 8]
    for k in reversed(steps):
        here = word[at + k]
        x = here[1:] ^ here[:-1]
        low = x & (~x + np.uint64(1))
        differ = np.flatnonzero(x)
        out[1:][differ] = k + np.log2(low[differ].astype(np.float64)).astype(np.int64) // 8
    return out


def least_ids(data: np.ndarray, off: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fragments as bytes and offsets, distinct, each with the least id that has it: for every
    window the least id whose fragments have it, and n + 1 offsets of the fragments' windows."""
    windows = np.diff(off) - LENGTH + 1
    bounds = np.zeros(len(windows) + 1, np.int64)
    np.cumsum(windows, out=bounds[1:])
    # the windows of a fragment and the positions after them up to one that is sorted directly:
    # a byte not above the next, or the fragment's last, of which one byte is all that matters
    stop = np.append(data[:-1] <= data[1:], True)
    stop[off[1:] - 1] = True
    stop = np.flatnonzero(stop)
    taken = stop[np.searchsorted(stop, off[:-1] + windows)] - off[:-1] + 1
    at = ranges(off[:-1], taken)
    owner = np.repeat(np.arange(len(windows)), taken)
    ends = np.cumsum(taken)
    first, last = np.zeros(len(at), bool), np.zeros(len(at), bool)
    first[ends - taken] = True
    last[ends - 1] = True
    room = off[owner + 1] - at
    padded = np.concatenate([data, np.zeros(LENGTH, np.uint8)])
    order = two_stage_order(padded, at, first, last, room)
    window = room >= LENGTH
    order = order[window[order]]
    starts = np.flatnonzero(common_prefixes(padded, at[order]) < LENGTH)
    least = np.minimum.reduceat(ids[owner[order]], starts) if len(starts) else np.zeros(0, np.int64)
    group = np.zeros(len(order), np.int64)
    group[starts] = 1
    out = np.empty(len(at), np.int64)
    out[order] = least[np.cumsum(group) - 1] if len(order) else 0
    return out[window], bounds


# --- the steps --------------------------------------------------------------------------

def _groups(batches, key: str, weight: str | None = None, limit: int = 0):
    """Whole runs of rows with one value of ``key``; with ``weight``, several runs together while
    they have at most ``limit`` bytes in that column."""
    held, size = [], 0
    for b in batches:
        codes = column_of(b, key).to_numpy()
        at = [0, *(np.flatnonzero(codes[1:] != codes[:-1]) + 1).tolist(), b.num_rows]
        if weight:
            _, bytes_at = flat(column_of(b, weight))
        for lo, hi in zip(at[:-1], at[1:], strict=True):
            if hi == lo:
                continue
            if held and column_of(held[-1], key)[-1].as_py() != codes[lo] and (not weight or size >= limit):
                yield _one_batch(held)
                held, size = [], 0
            held.append(b.slice(lo, hi - lo))
            size += int(bytes_at[hi] - bytes_at[lo]) if weight else 0
    if held:
        yield _one_batch(held)


def _one_batch(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    """All rows in one batch; binary columns become large ones, which 2 GB don't split."""
    table = pa.Table.from_batches(held)
    large = pa.schema([f.with_type(pa.large_binary()) if pa.types.is_binary(f.type) else f for f in table.schema])
    batch, = table.cast(large).combine_chunks().to_batches()
    return batch


def _asked(texts: DataFrame, n_buckets: int) -> DataFrame:
    """Signatures by bucket: those that one id of a slice has, with the id; those that two have,
    without. The latter need no answer: as rows with an ``id`` they are passed on. ``weight`` has a
    byte for each single and double: eight times the binary logarithm of its occurrences."""
    def ask(batches):
        for part in slices(batches):
            data, off = flat(column_of(part, "text"))
            ids = column_of(part, "id").to_numpy()
            found = [(t, c, v) for t, _, c, v in fragments(data, off)]
            own = ids[np.concatenate([t for t, _, _ in found])] if found else ids[:0]
            if not len(own):
                continue
            sig = np.concatenate([v for _, _, v in found])
            order = np.lexsort((own, sig))
            own, sig = own[order], sig[order]
            times = -(-np.concatenate([c for _, c, _ in found])[order] // USUAL)
            weight = np.add.reduceat(times, np.flatnonzero(np.append(True, sig[1:] != sig[:-1])))
            weight = np.ceil(8 * np.log2(weight)).astype(np.uint8)
            fresh = np.ones(len(sig), bool)
            fresh[1:] = (sig[1:] != sig[:-1]) | (own[1:] != own[:-1])
            own, sig = own[fresh], sig[fresh]
            start = np.flatnonzero(np.append(True, sig[1:] != sig[:-1]))
            many = np.diff(np.append(start, len(sig))) > 1
            one, two = start[~many], sig[start[many]]
            w1, w2 = weight[~many], weight[many]
            rows = {"bucket": [], "single": [], "ids": [], "double": [], "weight": [], "id": []}
            bucket_of = lambda s: (mix(s) % np.uint64(n_buckets)).astype(np.int64)
            b1, b2 = bucket_of(sig[one]), bucket_of(two)
            o1, o2 = np.argsort(b1, kind="stable"), np.argsort(b2, kind="stable")
            e1, e2 = (np.searchsorted(b[o], np.arange(n_buckets + 1)) for b, o in ((b1, o1), (b2, o2)))
            for b in np.unique(np.concatenate([b1, b2])).tolist():
                p1, p2 = o1[e1[b]:e1[b + 1]], o2[e2[b]:e2[b + 1]]
                pick = one[p1]
                rows["bucket"].append(b)
                rows["single"].append(sig[pick].tobytes())
                rows["ids"].append(own[pick].tobytes())
                rows["double"].append(two[p2].tobytes())
                rows["weight"].append(w1[p1].tobytes() + w2[p2].tobytes())
                rows["id"].append(None)
            shared = np.repeat(many, np.diff(np.append(start, len(sig))))
            for name, raw in _by_id(own[shared], sig[shared]):
                rows["bucket"].append(name % n_buckets)
                rows["single"].append(raw)
                rows["ids"].append(b"")
                rows["double"].append(b"")
                rows["weight"].append(b"")
                rows["id"].append(name)
            yield pa.RecordBatch.from_pydict(rows, schema=ASKED)

    return texts.mapInArrow(ask, "bucket long, single binary, ids binary, double binary, weight binary, id long")


ASKED = pa.schema([("bucket", pa.int64()), ("single", pa.binary()), ("ids", pa.binary()), ("double", pa.binary()),
                   ("weight", pa.binary()), ("id", pa.int64())])


def _by_id(ids: np.ndarray, sig: np.ndarray):
    """(id, its signatures as bytes)."""
    order = np.argsort(ids, kind="stable")
    ids, sig = ids[order], sig[order]
    edge = np.flatnonzero(np.append(True, ids[1:] != ids[:-1])) if len(ids) else np.zeros(0, np.int64)
    for lo, hi in zip(edge.tolist(), [*edge[1:].tolist(), len(ids)], strict=True) if len(edge) else ():
        yield int(ids[lo]), sig[lo:hi].tobytes()


def _answered(asked: DataFrame, heavy_from: int = HEAVY) -> DataFrame:
    """``id, sigs``: the signatures that another id has too, once for each id. A row without an id
    has the heavy signatures, each with the number of its occurrences."""
    def answer(batches):
        passed = []

        def questions():
            for b in batches:
                name = column_of(b, "id")
                known = b.filter(name.is_valid())
                if known.num_rows:
                    passed.append(pa.RecordBatch.from_arrays([column_of(known, "id"), column_of(known, "single")],
                                                             ["id", "sigs"]))
                yield b.filter(name.is_null())

        for g in _groups(questions(), "bucket"):
            yield from passed
            passed.clear()
            read = lambda c, kind: np.frombuffer(b"".join(column_of(g, c).to_pylist()), kind)
            sig, ids, double = read("single", np.uint64), read("ids", np.int64), read("double", np.uint64)
            n_single = [len(x) // 8 for x in column_of(g, "single").to_pylist()]
            heavy = _heavy(sig, double, column_of(g, "weight").to_pylist(), n_single, heavy_from)
            if len(heavy):
                yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([heavy.tobytes()], pa.binary())],
                                                 ["id", "sigs"])
            double = np.unique(double)
            order = np.lexsort((ids, sig))
            sig, ids = sig[order], ids[order]
            if not len(sig):
                continue
            start = np.flatnonzero(np.append(True, sig[1:] != sig[:-1]))
            end = np.append(start[1:], len(sig))
            shared = (ids[start] != ids[end - 1]) | np.isin(sig[start], double)
            shared = np.repeat(shared, end - start)
            got = list(_by_id(ids[shared], sig[shared]))
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in got], pa.int64()),
                                              pa.array([x for _, x in got], pa.binary())], ["id", "sigs"])
        yield from passed

    return asked.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(answer, "id long, sigs binary") \
        .groupBy("id").agg(F.collect_list("sigs").alias("sigs"))


def _heavy(single: np.ndarray, double: np.ndarray, weights: list[bytes], n_single: list[int], heavy_from: int) -> np.ndarray:
    """Signatures with ``heavy_from`` occurrences or more and, in a second column, how many."""
    codes = b"".join([w[:n] for w, n in zip(weights, n_single, strict=True)]
                     + [w[n:] for w, n in zip(weights, n_single, strict=True)])
    sig, times = np.concatenate([single, double]), np.exp2(np.frombuffer(codes, np.uint8) / 8)
    # few cells of signatures have so many: only those are looked at
    cell = (sig >> np.uint64(48)).astype(np.int64)
    full = (np.bincount(cell, times, 1 << 16) >= heavy_from)[cell]
    sig, which = np.unique(sig[full], return_inverse=True)
    times = np.bincount(which, times[full], len(sig))
    much = times >= heavy_from
    return np.column_stack([sig[much], np.ceil(times[much]).astype(np.uint64)])


# --- windows of heavy signatures --------------------------------------------------------

def _heavy_windows(data: np.ndarray, off: np.ndarray, heavy: np.ndarray):
    """Windows with a heavy signature, block by block: (text, first byte, 128 bits of hash)."""
    for text, start, count, sig in fragments(data, off):
        keep = np.isin(sig, heavy)
        if not keep.any():
            continue
        at = ranges(start[keep], count[keep])
        lo = at[0]
        word = _words64(data[lo:at[-1] + LENGTH])
        h1, h2 = np.zeros(len(at), np.uint64), np.ones(len(at), np.uint64)
        for k in [*range(0, LENGTH - 8, 8), LENGTH - 8]:
            w = word[at - lo + k]
            h1, h2 = mix(h1 ^ w), mix(h2 + mix(~w))
        yield np.repeat(text[keep], count[keep]), at, h1, h2


def _heavy_spans(matched: DataFrame, heavy: np.ndarray, n_buckets: int) -> DataFrame:
    """``id, head`` (of the digest) with ``settled``, (digest, spans) of what a block of text has
    settled, and ``windows``, the hashes of windows that a smaller id has elsewhere."""
    sent = matched.sparkSession.sparkContext.broadcast(heavy)

    def ask(batches):
        for part in slices(batches):
            data, off = flat(column_of(part, "text"))
            ids, digests = column_of(part, "id").to_numpy(), column_of(part, "digest").to_pylist()
            heads = np.frombuffer(b"".join(x[:4] for x in digests), np.int32)
            for text, at, h1, h2 in _heavy_windows(data, off, sent.value):
                order = np.lexsort((heads[text], ids[text], h2, h1))
                text, at, h1, h2 = text[order], at[order], h1[order], h2[order]
                own, head = ids[text], heads[text]
                fresh = np.append(True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1]))
                later = own > own[np.flatnonzero(fresh)][np.cumsum(fresh) - 1]
                rows = []
                # a gap between texts keeps their spans apart
                s, e = merged(at[later] + text[later], at[later] + text[later] + LENGTH)
                of = np.searchsorted(off + np.arange(len(off)), s, "right") - 1
                s, e = s - of - off[of], e - of - off[of]
                edge = np.flatnonzero(np.append(True, of[1:] != of[:-1])) if len(of) else of
                for lo, hi in zip(edge.tolist(), [*edge[1:].tolist(), len(of)], strict=True) if len(of) else ():
                    t = int(of[lo])
                    rows.append({"bucket": int.from_bytes(digests[t][:4], "big") % n_buckets, "id": int(ids[t]),
                                 "digest": digests[t], "spans": np.column_stack([s, e])[lo:hi].tobytes()})
                fresh[1:] |= (own[1:] != own[:-1]) | (head[1:] != head[:-1])
                pick = np.flatnonzero(fresh & ~later)
                bucket = (h1[pick] % np.uint64(n_buckets)).astype(np.int64)
                by_bucket = np.argsort(bucket, kind="stable")
                pick, bucket = pick[by_bucket], bucket[by_bucket]
                edge = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
                for lo, hi in zip(edge.tolist(), [*edge[1:].tolist(), len(pick)], strict=True):
                    p = pick[lo:hi]
                    rows.append({"bucket": int(bucket[lo]), "windows": np.column_stack([h1[p], h2[p]]).tobytes(),
                                 "ids": own[p].tobytes(), "heads": head[p].tobytes()})
                yield pa.RecordBatch.from_pylist(rows, schema=WINDOWS)

    def answer(batches):
        passed = []

        def questions():
            for b in batches:
                settled = column_of(b, "id").is_valid()
                passed.extend({"id": r["id"], "head": r["digest"][:4], "settled": {"digest": r["digest"], "spans": r["spans"]}}
                              for r in b.filter(settled).select(["id", "digest", "spans"]).to_pylist())
                yield b.filter(column_of(b, "id").is_null())

        for g in _groups(questions(), "bucket"):
            read = lambda c, kind: np.frombuffer(b"".join(column_of(g, c).to_pylist()), kind)
            hashes, own, head = read("windows", np.uint64).reshape(-1, 2), read("ids", np.int64), read("heads", np.int32)
            order = np.lexsort((own, hashes[:, 1], hashes[:, 0]))
            hashes, own, head = hashes[order], own[order], head[order]
            fresh = np.append(True, (hashes[1:] != hashes[:-1]).any(1))
            later = np.flatnonzero(own > own[np.flatnonzero(fresh)][np.cumsum(fresh) - 1])
            later = later[np.lexsort((head[later], own[later]))]
            hashes, own, head = hashes[later], own[later], head[later]
            edge = np.flatnonzero(np.append(True, (own[1:] != own[:-1]) | (head[1:] != head[:-1]))) if len(own) else own
            out = [{"id": int(own[lo]), "head": head[lo:lo + 1].tobytes(), "windows": hashes[lo:hi].tobytes()}
                   for lo, hi in (zip(edge.tolist(), [*edge[1:].tolist(), len(own)], strict=True) if len(own) else ())]
            yield pa.RecordBatch.from_pylist([*passed, *out], schema=TOLD)
            passed.clear()
        yield pa.RecordBatch.from_pylist(passed, schema=TOLD)

    return matched.where("is_first").select("id", "digest", "text") \
        .mapInArrow(ask, "bucket long, windows binary, ids binary, heads binary, id long, digest binary, spans binary") \
        .repartition("bucket").sortWithinPartitions("bucket") \
        .mapInArrow(answer, "id long, head binary, settled struct<digest: binary, spans: binary>, windows binary") \
        .groupBy("id", "head").agg(F.collect_list("settled").alias("settled"), F.collect_list("windows").alias("windows"))


WINDOWS = pa.schema([("bucket", pa.int64()), ("windows", pa.binary()), ("ids", pa.binary()), ("heads", pa.binary()),
                     ("id", pa.int64()), ("digest", pa.binary()), ("spans", pa.binary())])
TOLD = pa.schema([("id", pa.int64()), ("head", pa.binary()),
                  ("settled", pa.struct([("digest", pa.binary()), ("spans", pa.binary())])), ("windows", pa.binary())])


def _heavy_pairs(raw: bytes, digest: bytes, settled: list[dict], windows: list[bytes], heavy: np.ndarray):
    """The (first, end) bytes that go from a text by ``_heavy_spans``."""
    for x in settled:
        if x["digest"] == digest:
            yield from np.frombuffer(x["spans"], np.int64).reshape(-1, 2).tolist()
    if windows:
        pair = [("h1", np.uint64), ("h2", np.uint64)]
        told = np.frombuffer(b"".join(windows), pair)
        for _, at, h1, h2 in _heavy_windows(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), heavy):
            at, own = (x[np.isin(h1, told["h1"])] for x in (at, np.column_stack([h1, h2]).view(pair).ravel()))
            gone = np.isin(own, told)
            s, e = merged(at[gone], at[gone] + LENGTH)
            yield from zip(s.tolist(), e.tolist(), strict=True)


# --- fragments of the other signatures --------------------------------------------------

def _shared_fragments(part: pa.RecordBatch, heavy: np.ndarray):
    """Of a slice's first texts, the fragments with a shared signature that isn't heavy, block by
    block: (row, first byte in its text, first byte in the slice, size, signature, the slice's bytes)."""
    data, off = flat(column_of(part, "text"))
    sigs = [np.frombuffer(b"".join(x if own else ()), np.uint64) for x, own in
            zip(column_of(part, "sigs").to_pylist(), column_of(part, "is_first").to_pylist(), strict=True)]
    for text, start, count, sig in fragments(data, off):
        edge = np.searchsorted(text, np.arange(len(sigs) + 1))
        keep = np.zeros(len(text), bool)
        for i in range(len(sigs)):
            lo, hi = edge[i], edge[i + 1]
            if hi > lo:
                keep[lo:hi] = np.isin(sig[lo:hi], sigs[i])
        if len(heavy):
            keep &= ~np.isin(sig, heavy)
        yield text[keep], start[keep] - off[text[keep]], start[keep], count[keep] + LENGTH - 1, sig[keep], data


def _distinct(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The distinct ones of fragments, and which of them each is."""
    bounds = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=bounds[1:])
    coded = binary_array(data[ranges(start, size)], bounds).dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy()


def _names(distinct: pa.Array) -> np.ndarray:
    """64-bit hashes of fragments; with the signature they stand for them."""
    import xxhash
    return np.fromiter((xxhash.xxh3_64_intdigest(x) for x in distinct.to_pylist()), np.uint64, len(distinct))


def _extremes(which: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each number 0, 1, ... in ``which``: where one stands, its least and its greatest value."""
    order = np.lexsort((values, which))
    first = np.flatnonzero(np.append(True, np.diff(which[order]) != 0))
    last = np.append(first[1:], len(order)) - 1
    return order[first], values[order[first]], values[order[last]]


def _as_long(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64))


def _verdicts(matched: DataFrame, heavy: np.ndarray) -> DataFrame:
    """For each fragment that several ids have or some window of which a smaller id has:
    ``sig, name, least, size`` and ``spans``, the (first, end) bytes to go where its id is least."""
    sent = matched.sparkSession.sparkContext.broadcast(heavy)

    def bring(batches):
        for part in slices(batches):
            ids = column_of(part, "id").to_numpy()
            for text, _, start, size, sig, data in _shared_fragments(part, sent.value):
                if not len(text):
                    continue
                distinct, which = _distinct(data, start, size)
                one, low, high = _extremes(which, ids[text])
                yield pa.RecordBatch.from_arrays([_as_long(sig[one]), distinct.cast(pa.binary()), pa.array(low),
                                                  pa.array(high - low)], ["sig", "fragment", "least", "more"])

    def judge(batches):
        for g in _groups(batches, "sig", "fragment", SORT_BYTES):
            coded = column_of(g, "fragment").dictionary_encode()
            which, distinct = coded.indices.to_numpy(), coded.dictionary
            least = column_of(g, "least").to_numpy()
            one, low, _ = _extremes(which, least)
            high = _extremes(which, least + column_of(g, "more").to_numpy())[2]
            sig, name = column_of(g, "sig").to_numpy()[one], _names(distinct).view(np.int64)
            data, off = flat(distinct)
            found, bounds = least_ids(data, off, low)
            earlier = found < np.repeat(low, np.diff(bounds))
            earlier_in = np.add.reduceat(earlier, bounds[:-1])
            out = []
            for i in np.flatnonzero((earlier_in > 0) | (high > low)).tolist():
                spans = []
                if earlier_in[i]:
                    at = np.flatnonzero(earlier[bounds[i]:bounds[i + 1]])
                    s, e = merged(at, at + LENGTH)
                    spans = [{"first": int(x), "end": int(y)} for x, y in zip(s, e, strict=True)]
                out.append({"sig": int(sig[i]), "name": int(name[i]), "least": int(low[i]),
                            "size": int(off[i + 1] - off[i]), "spans": spans})
            yield pa.RecordBatch.from_pylist(out, schema=VERDICT)

    return matched.mapInArrow(bring, "sig long, fragment binary, least long, more long") \
        .repartition("sig").sortWithinPartitions("sig") \
        .mapInArrow(judge, "sig long, name long, least long, size long, spans array<struct<first: long, end: long>>")


VERDICT = pa.schema([("sig", pa.int64()), ("name", pa.int64()), ("least", pa.int64()), ("size", pa.int64()),
                     ("spans", pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())])))])


def _occurrences(matched: DataFrame, heavy: np.ndarray) -> DataFrame:
    """``sig, name, id, text_hash, start`` of each fragment with a shared signature that isn't heavy."""
    sent = matched.sparkSession.sparkContext.broadcast(heavy)

    def tell(batches):
        for part in slices(batches):
            ids = column_of(part, "id").to_numpy()
            key = _text_key(column_of(part, "digest"))
            for text, inside, start, size, sig, data in _shared_fragments(part, sent.value):
                distinct, which = _distinct(data, start, size)
                yield pa.RecordBatch.from_arrays([_as_long(sig), _as_long(_names(distinct)[which]), pa.array(ids[text]),
                                                  pa.array(key[text]), pa.array(inside)],
                                                 ["sig", "name", "id", "text_hash", "start"])

    return matched.mapInArrow(tell, "sig long, name long, id long, text_hash int, start long")


def _text_key(digests: pa.Array) -> np.ndarray:
    """Tells the texts of one id apart: four bytes of each digest."""
    return np.frombuffer(b"".join(x[:4] for x in digests.to_pylist()), np.int32)


def remove_repeats(docs: DataFrame, heavy_from: int = HEAVY) -> DataFrame:
    """``doc_id, n_bytes, n_removed, spans, kept`` of each row of ``docs`` (``doc_id``, ``text``):
    ``spans`` are the maximal (first, end) runs of removed bytes, ``kept`` the bytes that stay.

    Null text is empty. Rows without an id come after all others and, as one id, don't remove
    each other's bytes; neither do rows that repeat an id. Texts shorter than LENGTH stay whole.
    Texts of any length are searched whole. Empty tables give no rows; other columns are ignored.
    Signatures count as heavy from ``heavy_from`` occurrences; the result doesn't depend on it.
    """
    spark = docs.sparkSession
    ship(spark)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = docs.select(id_or_last().alias("id"), text.alias("text")).withColumn("digest", digest(F.col("text")))
    sizes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # one exchange of these rows by id serves all that follows
    rows = base.join(later_copies(base), ["id", "digest"], "left").select(
        "id", "text", "digest", F.col("copy").isNull().alias("is_first"))
    asked = _asked(rows.where("is_first").select("id", "text"), max(64, -(-sizes // BUCKET_BYTES)))
    shared = stored(_answered(asked, heavy_from), "shared")
    matched = rows.join(shared.where(F.col("id").isNotNull()), "id")
    # 16 bytes for each heavy signature
    told = [bytes(x) for r in shared.where(F.col("id").isNull()).collect() for x in r["sigs"]]
    told = np.frombuffer(b"".join(told), np.uint64).reshape(-1, 2)
    heavy = np.unique(told[:, 0])
    hits = _occurrences(matched, heavy).join(_verdicts(matched, heavy), ["sig", "name"])
    shifted = F.transform("spans", lambda s: F.struct((s["first"] + F.col("start")).alias("first"),
                                                      (s["end"] + F.col("start")).alias("end")))
    whole = F.array(F.struct(F.col("start").alias("first"), (F.col("start") + F.col("size")).alias("end")))
    spans = hits.select("id", "text_hash", F.when(F.col("id") > F.col("least"), whole).otherwise(shifted).alias("spans")) \
        .where(F.size("spans") > 0).groupBy("id").agg(F.collect_list(F.struct("text_hash", "spans")).alias("found"))

    sent = spark.sparkContext.broadcast(heavy)

    def cut(batches):
        for part in slices(batches):
            texts = column_of(part, "text").to_pylist()
            out = []
            for row, raw in zip(part.drop_columns(["text"]).to_pylist(), texts, strict=True):
                raw = raw.encode()
                key = int.from_bytes(row["digest"][:4], "little", signed=True)
                if not row["is_first"]:
                    whole = np.array([0, len(raw)][:2 * (len(raw) >= LENGTH)], np.int64)
                    s, e = whole[:1], whole[1:]
                else:
                    pairs = [(x["first"], x["end"]) for f in row["found"] or () if f["text_hash"] == key for x in f["spans"]]
                    if row.get("settled") or row.get("windows"):
                        pairs.extend(_heavy_pairs(raw, row["digest"], row["settled"], row["windows"], sent.value))
                    s, e = merged(np.array([a for a, _ in pairs], np.int64), np.array([b for _, b in pairs], np.int64))
                edge = [0, *np.column_stack([s, e]).ravel().tolist(), len(raw)]
                out.append({"id": row["id"], "n_bytes": len(raw), "n_removed": int((e - s).sum()),
                            "spans": [{"first": int(a), "end": int(b)} for a, b in zip(s, e, strict=True)],
                            "kept": b"".join(raw[a:b] for a, b in zip(edge[::2], edge[1::2], strict=True))})
            yield pa.RecordBatch.from_pylist(out, schema=CUT)

    joined = rows.join(spans, "id", "left")
    if len(heavy):
        n_buckets = max(64, -(-int(told[:, 1].sum()) * USUAL * WINDOW_BYTES // BUCKET_BYTES))
        joined = joined.withColumn("head", F.substring("digest", 1, 4)) \
            .join(_heavy_spans(matched, heavy, n_buckets), ["id", "head"], "left")
    return joined \
        .mapInArrow(cut, "id long, n_bytes long, n_removed long, spans array<struct<first: long, end: long>>, kept binary") \
        .select(id_back(F.col("id")).alias("doc_id"), "n_bytes", "n_removed", "spans", "kept")


CUT = pa.schema([("id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                 ("spans", pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary())])


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir)).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))
