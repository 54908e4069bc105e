"""Operator 11: byte-level BPE encoding and decoding with Spark's higher-order functions.

Texts are split into words by the tokenizer's pattern; a task lists the distinct words of a slice
of texts and each text as indexes into them. Words that a sample of a large table has repeatedly
are folded beforehand, once, and sent to the tasks. A word is an array of its bytes, each with its id and
its rank with the next one (or one entry, if it is a piece). ``aggregate`` folds over it: in each step the neighbours whose joint
piece has the least rank (the first of several) become that piece, and the ranks on either side
are looked up anew, until no neighbours have one. Ranks come from a literal: a hash table in an
array, because Spark looks through a map from its beginning. Decoding joins the pieces' bytes.
"""

from __future__ import annotations

import base64
import json
from array import array
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from flotilla.llm.common import WHITE, binary_array, column_of, documents, flat, ranges, ship, slices, trimmed

# The pattern for which texts may be cut as ``_cuts`` does. A fixed value.
KNOWN_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# A pair of ids is one number, ``a * SPREAD + b``, and has two places in the table of ranks: its
# low bits, and some of its product's with SCRAMBLE.
SPREAD, SCRAMBLE, SHIFT = 1_000_003, 13_466_917, 22
PLACES = 1 << 18            # a power of two, over twice the pairs


def _places(pair: int) -> tuple[int, int]:
    return pair & (PLACES - 1), (pair * SCRAMBLE >> SHIFT) & (PLACES - 1)


# From so many rows on, words found repeatedly in a sample of the rows (so much of each) are folded
# once for all tasks: the most frequent ones, so many at most. Which they are changes no result.
MANY_ROWS = 96_000
SAMPLE_ROWS, SAMPLE_CHARS = 24_000, 8_192
FREQUENT = 300_000
# Text bytes whose distinct words are listed together (or one longer text).
SLICE = 12 << 20
PART = 2 << 20              # of them, bytes that are split into words at a time
# A word of more pieces than this merges all its least neighbours in a step, a shorter one the first.
MANY = 256
# Words of more bytes are cut where no piece of the vocabulary could reach across.
LONG = 64
# A piece in the fold is one long: the rank of joining it with the next one (NONE if there is
# none), where it starts in the word, its id. The least long is then the place to merge, the first
# of several. One more entry, of an id that no piece has, stands at either end of a word.
ID_BITS, START_BITS = 18, 26
NONE, END_ID = 1 << ID_BITS, (1 << ID_BITS) - 1
BELOW = ID_BITS + START_BITS


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once: a fold over nothing, with an end. (The first
    of a transformed array would do as well, but works out its type for each row anew.)"""
    return F.aggregate(F.array().cast("array<int>"), value, lambda acc, _: acc, body)


def joined(*arrays: Column) -> Column:
    """One array of several: what ``concat`` gives, in half the time."""
    return F.flatten(F.array(*arrays))


@dataclass(frozen=True)
class Vocabulary:
    """Pieces (bytes) and their ranks, which are the token ids."""
    ranks: dict[bytes, int]

    @staticmethod
    def read(path: str) -> "Vocabulary":
        """A file of lines ``base64 rank``, as tiktoken has them."""
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError(f"{path}: some single bytes have no rank")
        if max(ranks.values()) >= END_ID:
            raise ValueError(f"{path}: ranks of {END_ID} and more are out of range")
        return Vocabulary(ranks)

    def rank_table(self) -> Column:
        """``array<bigint>``: for two ids whose pieces joined are a piece, ``pair << ID_BITS | rank`` in
        one of the pair's two places, -1 in places of none. One literal, folded by Catalyst; a flat one,
        because every task gets a copy."""
        found = {}
        for piece, rank in self.ranks.items():
            for i in range(1, len(piece)):
                a, b = self.ranks.get(piece[:i]), self.ranks.get(piece[i:])
                if a is not None and b is not None:
                    found[a * SPREAD + b] = rank
        table = [-1] * PLACES
        for pair, rank in found.items():
            entry = pair << ID_BITS | rank
            at = pair & (PLACES - 1)
            for _ in range(500):        # whoever is put out goes to its other place
                entry, table[at] = table[at], entry
                if entry < 0:
                    break
                one, other = _places(entry >> ID_BITS)
                at = other if at == one else one
            else:
                raise ValueError(f"{len(found)} pairs don't fit into {PLACES} places")
        return F.from_json(F.lit(json.dumps(table, separators=(",", ":"))), "array<bigint>")

    def pieces(self) -> Column:
        """``array<hex>`` by rank; ranks that no piece has are null."""
        by_rank: list[str | None] = [None] * (1 + max(self.ranks.values()))
        for piece, rank in self.ranks.items():
            by_rank[rank] = piece.hex().upper()
        return F.from_json(F.lit(json.dumps(by_rank, separators=(",", ":"))), "array<string>")

    def neighbours(self) -> np.ndarray:
        """Which two bytes follow each other inside a piece (flat 256 x 256)."""
        out = np.zeros(65536, bool)
        for piece in self.ranks:
            b = np.frombuffer(piece, np.uint8).astype(np.int64)
            out[256 * b[:-1] + b[1:]] = True
        return out


# --- words ----------------------------------------------------------------------------------

_WHITE, _LETTER, _SIGN = (np.array([test(c) for c in range(256)]) for test in (
    lambda c: c in WHITE, lambda c: c < 128 and chr(c).isalpha(), lambda c: 32 < c < 127 and not chr(c).isalnum()))
_SEEN = np.array([32 < c < 127 for c in range(256)])


def _cuts(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Where texts start or end, or KNOWN_PATTERN always ends a match and looks no further back: at
    white space after a visible ASCII character, at an ASCII sign after an ASCII letter. What
    stands between two such places comes again and again."""
    cut = np.zeros(len(data) + 1, bool)
    cut[1:-1] = (_WHITE[data[1:]] & _SEEN[data[:-1]]) | (_SIGN[data[1:]] & _LETTER[data[:-1]])
    cut[off] = True
    return np.flatnonzero(cut)


class _Start:
    """Words as the fold starts with them."""

    def __init__(self, ranks: dict[bytes, int]):
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.double = np.array([ranks.get(bytes([a, b]), NONE) for a in range(256) for b in range(256)], np.int64)

    def entries(self, words: list[bytes]) -> pa.Array:
        b = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        length = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(length)
        rank = np.full(len(b), NONE, np.int64)
        rank[:-1] = self.double[256 * b[:-1] + b[1:]]
        rank[ends - 1] = NONE
        place = np.arange(len(b)) - np.repeat(ends - length, length) + 1
        off = np.concatenate([[0], np.cumsum(length + 2)])
        out = np.empty(int(off[-1]), np.int64)
        inside = np.ones(len(out), bool)
        inside[off[:-1]] = inside[off[1:] - 1] = False
        out[inside] = rank << BELOW | place << ID_BITS | self.single[b]
        out[off[:-1]] = NONE << BELOW | END_ID
        out[off[1:] - 1] = NONE << BELOW | (length + 1) << ID_BITS | END_ID
        return pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(out))


def frequent_words(docs: DataFrame, vocabulary: Vocabulary, pattern: str) -> pa.Table:
    """``word, ids``: words of no more than LONG bytes, and no pieces, that a sample of ``docs``
    has repeatedly. Of less than MANY_ROWS rows none."""
    rows = docs.count()
    if rows < MANY_ROWS:
        return pa.table({"word": pa.array([], pa.binary()), "ids": pa.array([], pa.list_(pa.int32()))})
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary.ranks)

    def count(batches):
        import regex

        find, found = regex.compile(pattern).findall, Counter()
        for batch in batches:
            for text in column_of(batch, "text").to_pylist():
                found.update(find(text or ""))
        counts = {raw: n for raw, n in ((w.encode(), n) for w, n in found.items()) if len(raw) <= LONG and raw not in sent.value}
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    def start(batches):
        begin = _Start(sent.value)
        for batch in batches:
            words = column_of(batch, "word")
            yield pa.RecordBatch.from_arrays([words, column_of(batch, "n"), begin.entries(words.to_pylist())], ["word", "n", "start"])

    counted = docs.sample(SAMPLE_ROWS / rows, seed=11).select(F.substring(F.col("text").cast("string"), 1, SAMPLE_CHARS).alias("text")) \
        .mapInArrow(trimmed(count), "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n")).where("n > 1") \
        .mapInArrow(trimmed(start), "word binary, n bigint, start array<bigint>")
    ids = let(vocabulary.rank_table(), lambda table: encoded_word(F.col("start"), table))
    return counted.select("word", "n", ids.alias("ids")).orderBy(F.desc("n"), "word").limit(FREQUENT).select("word", "ids").toArrow()


def sliced_words(docs: DataFrame, vocabulary: Vocabulary, pattern: str, limit: int = SLICE) -> DataFrame:
    """Rows ``docs`` (array of ``doc_id, codes``), ``known`` and ``words`` (arrays): slices of texts as
    indexes into their distinct words: first the known ones, pieces and frequent words, as ids, then
    others as the fold starts with them. Words of
    more than LONG bytes that are no piece are cut between bytes that are neighbours in no piece:
    no merge can reach across."""
    sent = docs.sparkSession.sparkContext.broadcast(
        (vocabulary.ranks, vocabulary.neighbours(), frequent_words(docs, vocabulary, pattern)))

    def split(batches):
        import regex

        find, (ranks, joins, often) = regex.compile(pattern).findall, sent.value
        known = pattern == KNOWN_PATTERN
        begin = _Start(ranks)
        often_words, often_ids = often["word"].combine_chunks(), often["ids"].combine_chunks()
        often_ids, often_size = often_ids.flatten().to_numpy(), often_ids.value_lengths().to_numpy()
        often_first = np.cumsum(often_size) - often_size

        def cut(word: bytes) -> list[bytes]:
            b = np.frombuffer(word, np.uint8).astype(np.int64)
            at = [0, *(np.flatnonzero(~joins[256 * b[:-1] + b[1:]]) + 1).tolist(), len(word)]
            return [word[i:j] for i, j in zip(at[:-1], at[1:], strict=True)]

        def looked_up(words: list[bytes]) -> tuple[np.ndarray, pa.Array, pa.Array]:
            """The index of each word among the known and the other ones, the known ones' ids, the others."""
            own = np.fromiter((ranks.get(w, -1) for w in words), np.int32, len(words))
            at = pc.index_in(pa.array(words, pa.binary()), value_set=often_words).fill_null(-1).to_numpy().astype(np.int64)
            done = (own >= 0) | (at >= 0)
            index = np.where(done, np.cumsum(done), done.sum() + np.cumsum(~done)) - 1
            own, at = own[done], at[done]
            piece = own >= 0
            size, first = np.ones(len(own), np.int64), len(often_ids) + np.arange(len(own))
            size[~piece], first[~piece] = often_size[at[~piece]], often_first[at[~piece]]
            off = np.concatenate([[0], np.cumsum(size)])
            ids = np.concatenate([often_ids, own])[ranges(first, size)]
            return index.astype(np.int32), pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(ids, pa.int32())), \
                begin.entries([w for w, ready in zip(words, done.tolist(), strict=True) if not ready])

        for part in slices(batches, limit=limit):
            index: dict[str | bytes, int] = {}
            own = []
            for some in slices([part], limit=PART):
                data, off = flat(column_of(some, "text"))
                cuts = _cuts(data, off) if known else off
                coded = binary_array(data, cuts).dictionary_encode()
                codes, ends = array("i"), array("q", [0])
                for segment in coded.dictionary.to_pylist():
                    for w in find(segment.decode()):
                        if len(w) > LONG // 4 and len(raw := w.encode()) > LONG and raw not in ranks:
                            codes.extend([index.setdefault(x, len(index)) for x in cut(raw)])
                        else:
                            codes.append(index.setdefault(w, len(index)))
                    ends.append(len(codes))
                first, length = np.array(ends[:-1], np.int64), np.diff(np.frombuffer(ends, np.int64))
                which = coded.indices.to_numpy()
                bounds = np.concatenate([[0], np.cumsum(length[which])])[np.searchsorted(cuts, off)]
                own.append((bounds, np.array(codes, np.int32)[ranges(first[which], length[which])]))
            to, ready, words = looked_up([w if isinstance(w, bytes) else w.encode() for w in index])
            own = [pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(to[codes])) for bounds, codes in own]
            rows = pa.StructArray.from_arrays([column_of(part, "doc_id"), pa.concat_arrays(own)], ["doc_id", "codes"])
            yield pa.RecordBatch.from_arrays([
                pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (rows, ready, words)], ["docs", "known", "words"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(trimmed(split), "docs array<struct<doc_id: bigint, codes: array<int>>>, known array<array<int>>, words array<array<bigint>>")


# --- the fold -------------------------------------------------------------------------------

class _Fold:
    """A step of the fold over an array ``t`` of longs (see above), given the table of ranks."""

    def __init__(self, table: Column):
        self.table = table

    def rank(self, a: Column, b: Column) -> Column:
        """The rank of two neighbours' ids; null if their pieces joined are no piece."""
        def at(pair: Column, place: Column):
            entry = F.get(self.table, place.bitwiseAND(PLACES - 1))
            return F.shiftright(entry, ID_BITS) == pair, entry.bitwiseAND((1 << ID_BITS) - 1)

        def look(pair: Column) -> Column:
            here, there = at(pair, pair), at(pair, F.shiftright(pair * SCRAMBLE, SHIFT))
            return F.when(*here).when(*there)
        return let(a * SPREAD + b, look)

    def id(self, x: Column) -> Column:
        return x.bitwiseAND(END_ID)

    def ranked(self, rank: Column, x: Column) -> Column:
        """``x`` (start and id, any rank) with this rank."""
        return F.shiftleft(F.coalesce(rank, F.lit(NONE).cast("long")), BELOW).bitwiseOR(x.bitwiseAND((1 << BELOW) - 1))

    def left(self, t: Column, i: Column, m: Column) -> Column:
        """Piece ``i`` when ``m`` comes to stand behind it."""
        return self.ranked(self.rank(self.id(F.get(t, i)), m), F.get(t, i))

    def merged(self, t: Column, i: Column, m: Column, behind: Column) -> Column:
        """Piece ``m``, which starts where piece ``i`` did, before the id ``behind``."""
        return self.ranked(self.rank(m, behind), F.get(t, i).bitwiseAND(-1 << ID_BITS).bitwiseOR(m))

    def merge_first(self, t: Column, least: Column) -> Column:
        """The first neighbours of least rank become one piece."""
        # starts ascend, so the place is the number of lesser ones (array_position leaves its loop by an
        # exception: nine tenths of the time of the whole fold)
        low = (1 << BELOW) - (1 << ID_BITS)
        place = let(least.bitwiseAND(low), lambda own: F.size(F.filter(t, lambda x: x.bitwiseAND(low) < own)))

        def build(i: Column, m: Column) -> Column:
            # no two entries are equal; slices joined take a third longer
            return let(F.get(t, i - 1), lambda before: F.transform(F.array_remove(t, F.get(t, i + 1)), lambda x: F.when(
                x == least, self.merged(t, i, m, self.id(F.get(t, i + 2)))).when(x == before, self.left(t, i - 1, m)).otherwise(x)))
        return let(F.shiftright(least, BELOW), lambda m: let(place, lambda i: build(i, m)))

    def merge_all(self, t: Column, least: Column) -> Column:
        """All neighbours of least rank become pieces, from the left, as long as no neighbours that
        this makes on the way have a lesser rank; else only the first."""
        end = F.size(t) - 1

        def chosen(pos: Column) -> Column:
            # of places in a row, every other one
            starts = F.filter(pos, lambda x, j: (j == 0) | (F.get(pos, j - 1) < x - 1))
            ends = F.filter(pos, lambda x, j: F.coalesce(F.get(pos, j + 1) > x + 1, F.lit(True)))
            return F.flatten(F.zip_with(starts, ends, lambda a, b: F.sequence(a, b, F.lit(2))))

        def safe(c: Column, m: Column) -> Column:
            def lower(a, b):
                return F.coalesce(self.rank(a, b) < m, F.lit(False))
            clash = lower(m, m) | F.exists(c, lambda i: lower(self.id(F.get(t, i - 1)), m) | lower(m, self.id(F.get(t, i + 2))))
            return F.when(clash, F.slice(c, 1, 1)).otherwise(c)

        def build(c: Column, m: Column) -> Column:
            def from_one(i, j):
                """The merged piece and what stands before the next merged one."""
                return let(F.coalesce(F.get(c, j + 1), F.size(t)), lambda nxt: F.when(
                    nxt == i + 2, F.array(self.merged(t, i, m, m))).otherwise(joined(
                        F.array(self.merged(t, i, m, self.id(F.get(t, i + 2)))), F.slice(t, i + 3, F.least(nxt - 1, end) - i - 2),
                        F.when(nxt <= end, F.array(self.left(t, nxt - 1, m))).otherwise(F.array().cast("array<bigint>")))))

            return let(F.get(c, F.lit(0)), lambda head: joined(
                F.slice(t, F.lit(1), head - 1), F.array(self.left(t, head - 1, m)),
                F.flatten(F.transform(c, from_one)), F.slice(t, end + 1, F.lit(1))))

        return let(F.shiftright(least, BELOW), lambda m: let(
            F.filter(F.transform(t, lambda x, i: F.when(F.shiftright(x, BELOW) == m, i)), lambda x: x.isNotNull()),
            lambda pos: let(safe(chosen(pos), m), lambda c: build(c, m))))


def encoded_word(word: Column, table: Column) -> Column:
    """The ids of one word, given as ``sliced_words`` has it."""
    fold, n = _Fold(table), F.size(word) - 2

    def state(t: Column) -> Column:
        return let(t, lambda own: F.struct(own.alias("t"), F.array_min(own).alias("least")))

    def folded(merge) -> Column:
        return F.aggregate(F.sequence(F.lit(2), n), state(word), lambda s, _: F.when(s["least"] >= NONE << BELOW, s).otherwise(
            state(merge(s["t"], s["least"]))), lambda s: ids(s["t"]))

    def either(t: Column, least: Column) -> Column:
        return F.when(F.size(t) > MANY, fold.merge_all(t, least)).otherwise(fold.merge_first(t, least))

    def ids(t: Column) -> Column:
        return F.transform(F.slice(t, F.lit(2), F.size(t) - 2), lambda x: fold.id(x).cast("int"))

    return F.when(n < 2, ids(word)).when(n > MANY, folded(either)).otherwise(folded(fold.merge_first))


def encode(docs: DataFrame, vocabulary: Vocabulary, pattern: str, limit: int = SLICE) -> DataFrame:
    """``doc_id, ids`` (array of int) for each row of ``docs`` (``doc_id``, ``text``).

    Null and empty texts have no ids. Repeated rows are encoded each time, null ids stay null,
    empty tables give no rows, other columns are ignored. ``docs`` is counted and, if large, sampled
    at once; the rest is lazy. A text is whole, however long; the
    time of a single word that can't be cut grows with the square of its length at worst.
    """
    ship(docs.sparkSession)
    sliced = sliced_words(docs, vocabulary, pattern, limit)
    ids = let(vocabulary.rank_table(), lambda table: joined(F.col("known"), F.transform("words", lambda w: encoded_word(w, table))))
    put = let(ids, lambda own: F.transform("docs", lambda d: F.struct(
        d["doc_id"].alias("doc_id"), F.flatten(F.transform(d["codes"], lambda c: F.get(own, c))).alias("ids"))))
    return sliced.select(F.inline(put))


def decode(ids: Column | str, vocabulary: Vocabulary) -> Column:
    """The bytes that an array of ids stands for (binary); null for an id that no piece has."""
    ids = F.col(ids) if isinstance(ids, str) else ids
    # unhex of a sign that is no digit is null
    hexed = let(vocabulary.pieces(), lambda pieces: F.transform(ids, lambda i: F.get(pieces, i)))
    return F.unhex(F.array_join(hexed, "", "?"))


def op11_byte_bpe(spark: SparkSession, sf_dir: str, ranks_path: str | None = None) -> DataFrame:
    import public_tokenizers
    vocabulary = Vocabulary.read(ranks_path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    ids = encode(documents(spark, sf_dir), vocabulary, public_tokenizers.PATTERN)
    return ids.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
                      F.sha2(decode("ids", vocabulary), 256).alias("decoded_sha256"))
