"""Operator 2: benchmark decontamination with a generalised suffix automaton.

The automaton accepts every run of words of every test item. A document's words are streamed
through it while the length of the longest match that ends at each word is tracked; once it
reaches the window length (or a shorter item is complete) those words are hit. Only stretches
whose neighbouring words are neighbours in some item go through the automaton: anywhere else
the match is shorter than two words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from flotilla.llm.common import Words, byte_table, column_of, documents, flat, merged, ship, slices, stored, trimmed

WINDOW = 10
WORD = byte_table(keep=b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
# Items go into one automaton up to this many bytes of text; more of them are scanned in
# blocks of about this size, one after the other.
BLOCK_BYTES = 16 << 20


class Automaton:
    """Suffix automaton of all items' word sequences. ``items``: (id, text) pairs."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        self.window = window
        raw = [(text or "").encode() for _, text in items]
        off = np.zeros(len(raw) + 1, np.int64)
        np.cumsum([len(r) for r in raw], out=off[1:])
        words = Words(np.frombuffer(b"".join(raw), np.uint8), off, WORD)
        coded = words.array.dictionary_encode()
        self.vocabulary, ids = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        sequences = [(items[i][0], ids[words.off[i]:words.off[i + 1]].tolist()) for i in range(len(items))]
        sequences = [(name, seq) for name, seq in sequences if seq]
        #: the shortest run of words that can be hit
        self.least = min((min(window, len(s)) for _, s in sequences), default=0)
        size = max(1, len(self.vocabulary))
        self.pairs = np.unique(np.array([a * size + b for _, s in sequences for a, b in zip(s, s[1:])], np.int64))

        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for _, seq in sequences:
            last = 0
            for word in seq:
                last = self._extend(last, word)
        # which items have the window (or are the short item) that a state stands for
        self.items: dict[int, set[str]] = {}
        self.short: dict[int, dict[int, set[str]]] = {}
        for name, seq in sequences:
            state = 0
            for i, word in enumerate(seq, 1):
                state = self.next[state][word]
                if i >= window:
                    self.items.setdefault(self._shortest(state, window), set()).add(name)
            if len(seq) < window:
                at = self._shortest(state, len(seq))
                self.short.setdefault(at, {}).setdefault(len(seq), set()).add(name)
        # all short items that end where a state's runs end: own ones by length, all of its links'
        self.ending: list[list[tuple[int, set[str]]]] = [[] for _ in self.link]
        if self.short:
            for state in sorted(range(1, len(self.link)), key=self.length.__getitem__):
                self.ending[state] = self.ending[self.link[state]] + sorted(
                    self.short.get(state, {}).items(), key=lambda x: x[0])

    def _state(self, length: int, link: int, follow: dict[int, int]) -> int:
        self.next.append(follow)
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1

    def _split(self, at: int, word: int, q: int) -> int:
        """The part of state ``q`` whose runs are one word longer than ``at``'s."""
        if self.length[at] + 1 == self.length[q]:
            return q
        copy = self._state(self.length[at] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = copy
        while at >= 0 and self.next[at].get(word) == q:
            self.next[at][word] = copy
            at = self.link[at]
        return copy

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:             # another item's run
            return self._split(last, word, self.next[last][word])
        new = self._state(self.length[last] + 1, 0, {})
        while last >= 0 and word not in self.next[last]:
            self.next[last][word] = new
            last = self.link[last]
        if last >= 0:
            self.link[new] = self._split(last, word, self.next[last][word])
        return new

    def _shortest(self, state: int, n: int) -> int:
        """The state of the last ``n`` words of a state's runs."""
        while self.length[self.link[state]] >= n:
            state = self.link[state]
        return state

    def stream(self, words: list[int]):
        """For each word at which a hit ends: (position, words hit, items, longest match)."""
        state = matched = 0
        step, link, length, window = self.next, self.link, self.length, self.window
        for i, word in enumerate(words):
            while state and word not in step[state]:
                state = link[state]
                matched = length[state]
            state = step[state].get(word, 0)
            matched = matched + 1 if state else 0
            covered, names = 0, ()
            if matched >= window:
                covered, names = window, self.items[self._shortest(state, window)]
            if self.short:
                for n, more in self.ending[state]:
                    if n <= matched:
                        covered, names = max(covered, n), {*names, *more}
            if covered:
                yield i, covered, names, matched

    def scan(self, data: np.ndarray, off: np.ndarray) -> dict[str, list | np.ndarray]:
        """Texts as bytes and offsets: words, hit runs (as words and as bytes of the slice), items."""
        words = Words(data, off, WORD)
        n_texts = len(off) - 1
        out = {"n_words": np.diff(words.off), "n_hit": np.zeros(n_texts, np.int64),
               "longest": np.zeros(n_texts, np.int64), "spans": [[] for _ in range(n_texts)],
               "items": [set() for _ in range(n_texts)]}
        n = len(words.starts)
        if not n or not self.least:
            return out
        ids = pc.index_in(words.array, value_set=self.vocabulary).fill_null(-1).to_numpy().astype(np.int64)
        known = ids >= 0
        joined = np.zeros(n + 1, bool)          # joined[i]: words i - 1 and i are neighbours in an item
        both = np.flatnonzero(known[:-1] & known[1:])
        joined[both + 1] = np.isin(ids[both] * max(1, len(self.vocabulary)) + ids[both + 1], self.pairs)
        joined[words.off] = False
        first = np.flatnonzero(known & ~joined[:n])
        end = np.flatnonzero(known & ~joined[1:]) + 1
        long = end - first >= self.least
        first, end = first[long], end[long]
        text = np.searchsorted(words.off, first, "right") - 1
        hits: dict[int, tuple[list[int], list[int]]] = {}
        for t, a, b in zip(text.tolist(), first.tolist(), end.tolist(), strict=True):
            for i, covered, names, matched in self.stream(ids[a:b].tolist()):
                starts, ends = hits.setdefault(t, ([], []))
                starts.append(a + i + 1 - covered)
                ends.append(a + i + 1)
                out["items"][t].update(names)
                out["longest"][t] = max(out["longest"][t], matched)
        for t, (starts, ends) in hits.items():
            s, e = merged(np.array(starts), np.array(ends))
            out["n_hit"][t] = (e - s).sum()
            out["spans"][t] = [(int(x), int(y)) for x, y in zip(words.starts[s] - off[t], words.ends[e - 1] - off[t])]
        return out


def blocks(benchmark: DataFrame, limit: int = BLOCK_BYTES) -> Iterator[tuple[bool, list[tuple[str, str]]]]:
    """The items as lists of at most about ``limit`` bytes, collected one at a time, each with
    whether it's the last: one list for any usual benchmark."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                             F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // limit))
    for b in range(n):
        own = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == b).collect()
        yield b == n - 1, [(r["item"], r["text"]) for r in own]


FOUND = ("text string, n_words long, n_hit long, longest long, "
         "spans array<struct<start: long, end: long>>, items array<string>")
SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """For each row of ``docs``: ``row``, a struct of its columns but ``text`` (so no name can
    clash); ``text``; ``n_words``; ``n_hit`` words inside
    occurrences of windows; ``longest`` match in words where a window was hit; ``spans`` of hit
    bytes in the UTF-8 text, ascending and apart; ``items`` found, sorted.

    A null text has no words and stays null; repeated rows each get their result. Null or
    wordless items match nothing, items that share an id count as one, a null item id is an
    empty one. Empty tables give no rows or no hits.
    """
    spark = docs.sparkSession
    ship(spark)
    frame = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row"),
                        F.col("text").cast("string").alias("text"))
    schema = T.StructType([frame.schema["row"], *T._parse_datatype_string(FOUND).fields])
    for k, (is_last, items) in enumerate(blocks(benchmark, block_bytes)):
        sent = spark.sparkContext.broadcast(items)      # at most about block_bytes

        def look(batches, sent=sent, again=k > 0):
            automaton = Automaton(sent.value, window)
            for part in slices(batches):
                data, off = flat(column_of(part, "text"))
                got = automaton.scan(data, off)
                if again:
                    _add_earlier(got, part, data, off)
                yield pa.RecordBatch.from_arrays([
                    column_of(part, "row"), column_of(part, "text"),
                    *(pa.array(got[c], pa.int64()) for c in ("n_words", "n_hit", "longest")),
                    pa.array([[{"start": a, "end": b} for a, b in x] for x in got["spans"]], SPANS),
                    pa.array([sorted(x) for x in got["items"]], pa.list_(pa.string()))],
                    ["row", "text", "n_words", "n_hit", "longest", "spans", "items"])

        frame = frame.mapInArrow(trimmed(look), schema)
        if not is_last:
            frame = stored(frame, "decontaminate")
            sent.unpersist()
    return frame


def _add_earlier(got: dict, part: pa.RecordBatch, data: np.ndarray, off: np.ndarray) -> None:
    """Join the hits of earlier blocks of items to this block's."""
    for t, (spans, items, longest) in enumerate(zip(*(column_of(part, c).to_pylist() for c in ("spans", "items", "longest")), strict=True)):
        if not items:
            continue
        got["items"][t].update(items)
        got["longest"][t] = max(got["longest"][t], longest)
        both = [(s["start"], s["end"]) for s in spans] + got["spans"][t]
        words = Words(data[off[t]:off[t + 1]], np.array([0, off[t + 1] - off[t]]), WORD)
        # as runs of words, so that runs that touch become one
        a, b = merged(np.searchsorted(words.starts, [s for s, _ in both]),
                      np.searchsorted(words.starts, [e for _, e in both]))
        got["n_hit"][t] = (b - a).sum()
        got["spans"][t] = [(int(x), int(y)) for x, y in zip(words.starts[a], words.ends[b - 1], strict=True)]


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  max_coverage: float = 0.5, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``row, text`` (as ``scan``) of the documents that stay: hit spans (``window`` words or more, or a whole
    shorter item) are taken out of the text; a document of whose words more than the share
    ``max_coverage`` are hit goes altogether. Edge cases as for ``scan``; a null text stays null.
    """
    ship(docs.sparkSession)
    found = scan(docs, benchmark, window, block_bytes)
    schema = T.StructType([found.schema["row"], found.schema["text"]])

    def cut(batches):
        for part in slices(batches):
            texts = column_of(part, "text").to_pylist()
            for t, spans in enumerate(column_of(part, "spans").to_pylist()):
                if spans:
                    raw, kept, at = texts[t].encode(), [], 0
                    for s in spans:
                        kept.append(raw[at:s["start"]])
                        at = s["end"]
                    texts[t] = b"".join([*kept, raw[at:]]).decode()
            yield pa.RecordBatch.from_arrays([column_of(part, "row"), pa.array(texts, pa.string())], ["row", "text"])

    return found.where(F.col("n_hit") <= F.lit(max_coverage) * F.col("n_words")) \
        .select("row", "text", "spans").mapInArrow(trimmed(cut), schema)


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(documents(spark, sf_dir).select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("row.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))
