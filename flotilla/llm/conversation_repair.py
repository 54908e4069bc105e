"""Operator 12: conversation structure repair by a run-length dynamic programme.

A repaired conversation's roles read ``(s?(ua)+)?``: an automaton of four states. A row is one
symbol, its role's initial and whether it is truncated, or "must go" (blank, duplicate); a
symbol's edits (inserts before it, then keep, rerole or delete) are a 4 x 4 min-plus matrix.
Equal consecutive symbols are one run. Costs go backwards over whole runs by cached binary powers
of the matrix; then the choices are unrolled forwards, the least edit that is still cheapest at
each place, for the audit.

Conversations are dealt out by ranges of (conversation, turn, role, text), so one that has a
third of all rows is spread over many tasks. What lies inside one range is finished there. What
may go on in a neighbour is kept in chunks of bounded size: their matrices are chained
(min-plus products are associative), then each chunk is unrolled on its own.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from flotilla.llm.common import WHITE, column_of, ship, stored

# A chunk ends at so many rows or bytes of text (or with one longer row).
CHUNK_ROWS, CHUNK_BYTES = 65_536, 4 << 20
# Characters of a text that may decide where a range ends.
BORDER = 64

# --- the automaton and its matrices -------------------------------------------------------

NEVER = 1 << 60
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
NAMES = ("system", "user", "assistant")
# Start, after system, after user, after assistant. From each, one role may be put in.
START, SYSTEM, USER, ASSISTANT = range(4)
FOLLOWS = (USER, USER, ASSISTANT, USER)
ACCEPTS = (START, ASSISTANT)
KEEPS = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
ROLES = ("s", "u", "a", "")             # any other role can't be kept
MUST_GO = 8                             # symbols: 2 * role + truncated, or this
Vector = tuple[int, int, int, int]


def symbol(initial: str, truncated: bool) -> int:
    return 2 * (ROLES.index(initial) if initial in KEEPS else 3) + truncated


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum((a[:, :, None] + b[None]).min(1), NEVER)


def _inserts() -> np.ndarray:
    out = np.full((4, 4), NEVER, np.int64)
    for i in range(4):
        at, cost = i, 0
        while cost < out[i, at]:
            out[i, at] = cost
            at, cost = FOLLOWS[at], cost + INSERT
    return out


INSERTS = _inserts()
END: Vector = tuple(int(min(INSERTS[i, j] for j in ACCEPTS)) for i in range(4))


@functools.cache
def power(sym: int, k: int) -> np.ndarray:
    """The min-plus matrix of 2 ** k rows of a symbol."""
    if k:
        half = power(sym, k - 1)
        return _times(half, half)
    own = np.full((4, 4), NEVER, np.int64)
    for i in range(4):
        own[i, i] = DELETE
        if sym != MUST_GO:
            more = TRUNCATED * (sym & 1)
            own[i, FOLLOWS[i]] = min(own[i, FOLLOWS[i]], REROLE + more)
            kept = KEEPS.get(ROLES[sym >> 1], {}).get(i)
            if kept is not None:
                own[i, kept] = min(own[i, kept], KEEP + more)
    return _times(INSERTS, own)


@functools.lru_cache(100_000)
def _advanced(sym: int, length: int, after: Vector) -> Vector:
    v, k = np.array(after, np.int64), 0
    while length:
        if length & 1:
            v = np.minimum((power(sym, k) + v[None]).min(1), NEVER)
        length, k = length >> 1, k + 1
    return tuple(v.tolist())


def before(sym: int, length: int, after: Vector) -> Vector:
    """The cheapest costs to go before a run, by state, from those after it."""
    least = min(after)
    return tuple(min(x + least, NEVER) for x in _advanced(sym, length, tuple(x - least for x in after)))


def matrix(runs: list[tuple[int, int]]) -> np.ndarray:
    """The min-plus matrix of runs (symbol, length)."""
    out = np.full((4, 4), NEVER, np.int64)
    np.fill_diagonal(out, 0)
    for sym, length in runs:
        k = 0
        while length:
            if length & 1:
                out = _times(out, power(sym, k))
            length, k = length >> 1, k + 1
    return out


def _inside(sym: int, length: int, after: Vector) -> list[Vector]:
    """The costs to go after each row of a run; blocks of 2 ** k rows make the next 2 ** k."""
    if length == 1:
        return [after]
    out = np.empty((length, 4), np.int64)
    out[length - 1], done, k = after, 1, 0
    while done < length:
        more = min(done, length - done)
        block = out[length - more:]
        out[length - done - more: length - done] = np.minimum((power(sym, k)[None] + block[:, None, :]).min(2), NEVER)
        done, k = done + more, k + 1
    return [tuple(v) for v in out.tolist()]


@functools.lru_cache(100_000)
def _choices(sym: int, state: int, after: Vector) -> tuple[str, int]:
    """The least cheapest edits of one row (its inserts, then K, R or D) and the state they lead to."""
    here = before(sym, 1, after)
    more = TRUNCATED * (sym & 1)
    edits = ""
    while True:
        kept = KEEPS.get(ROLES[sym >> 1], {}).get(state) if sym != MUST_GO else None
        if DELETE + after[state] == here[state]:
            return edits + "D", state
        if INSERT + here[FOLLOWS[state]] == here[state]:
            edits, state = edits + "I", FOLLOWS[state]
            continue
        if kept is not None and KEEP + more + after[kept] == here[state]:
            return edits + "K", kept
        return edits + "R", FOLLOWS[state]


def unroll(runs: list[tuple[int, int]], after: Vector, state: int, last: bool) -> tuple[list[str], int]:
    """Edits of each row of the runs in order (with the final inserts as one more entry if
    ``last``), and the state they end in. ``after``: costs to go behind the last run."""
    ends = [after]
    for sym, length in reversed(runs):
        ends.append(before(sym, length, ends[-1]))
    ends.reverse()
    out = []
    for (sym, length), v in zip(runs, ends[1:], strict=True):
        if sym == MUST_GO:              # going first is never dearer than an insert first
            out += ["D"] * length
            continue
        for w in _inside(sym, length, v):
            least = min(w)
            edits, state = _choices(sym, state, tuple(x - least for x in w))
            out.append(edits)
    if last:
        edits = ""
        while state not in ACCEPTS:
            edits, state = edits + "I", FOLLOWS[state]
        out.append(edits)
    return out, state


# --- rows, their faults, their repair -----------------------------------------------------

_WHITE = WHITE.decode()


@dataclass
class Chunk:
    """Consecutive rows of a conversation; ``n`` says how often a row stands there (0: it only
    tells that the conversation exists)."""
    turn: list = field(default_factory=list)
    role: list = field(default_factory=list)
    text: list = field(default_factory=list)
    n: list = field(default_factory=list)
    size: int = 0

    def add(self, turn, role, text, n) -> None:
        self.turn.append(turn)
        self.role.append(role)
        self.text.append(text)
        self.n.append(n)
        self.size += len(text)

    def full(self) -> bool:
        return len(self.n) >= CHUNK_ROWS or self.size >= CHUNK_BYTES

    def rows(self) -> list[dict]:
        return [{"turn": a, "role": b, "text": c, "n": d} for a, b, c, d in zip(self.turn, self.role, self.text, self.n, strict=True)]

    @staticmethod
    def of(rows: list[dict]) -> "Chunk":
        out = Chunk()
        for r in rows:
            out.add(r["turn"], r["role"], r["text"], r["n"])
        return out


def _name(role: str, text: str) -> bytes:
    """16 bytes that stand for a role and a text."""
    return hashlib.md5(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass")).digest()


def symbols(chunk: Chunk, new: set[bytes] | None = None) -> tuple[list[tuple[int, int]], dict[str, int]]:
    """Runs of symbols and counts of faults. ``new`` names the rows not seen in earlier chunks
    (None: there are none). Of equal rows in the chunk the first is no duplicate."""
    runs, seen, count = [], set(), {"blank": 0, "duplicate": 0, "truncated": 0}

    def put(sym, length):
        if length and runs and runs[-1][0] == sym:
            runs[-1] = (sym, runs[-1][1] + length)
        elif length:
            runs.append((sym, length))

    for role, text, n in zip(chunk.role, chunk.text, chunk.n, strict=True):
        if not n:
            continue
        body = text.strip(_WHITE)
        name = _name(role, text)
        if not body:
            count["blank"] += n
            put(MUST_GO, n)
        elif name in seen or (new is not None and name not in new):
            count["duplicate"] += n
            put(MUST_GO, n)
        else:
            cut = body[-1] not in ".!?"
            count["truncated"] += cut
            count["duplicate"] += n - 1
            put(symbol(role[:1], cut), 1)
            put(MUST_GO, n - 1)
        seen.add(name)
    return runs, count


LEGAL = {"su", "ua", "au"}


def shape(chunk: Chunk) -> dict:
    """Illegal neighbours inside the chunk, its first and last initials and its turns."""
    at = [i for i, n in enumerate(chunk.n) if n]
    initials = [chunk.role[i][:1] for i in at]
    illegal = sum(chunk.n[i] - 1 for i in at) + sum(a + b not in LEGAL for a, b in zip(initials[:-1], initials[1:], strict=True))
    turns = [chunk.turn[i] for i in at if chunk.turn[i] is not None]       # ascending
    return {"illegal": illegal, "first": initials[0] if at else None, "last": initials[-1] if at else None,
            "low": turns[0] if turns else None, "high": turns[-1] if turns else None,
            "turns": len(turns) and 1 + sum(a != b for a, b in zip(turns[:-1], turns[1:], strict=True))}


def written(chunk: Chunk, edits: list[str], state: int) -> str | None:
    """The repaired rows, ``role:text`` each, joined by newlines; None if there are none."""
    lines, edit = [], iter(edits)

    def inserted(marks, state):
        for _ in range(marks.count("I")):
            state = FOLLOWS[state]
            lines.append(f"{NAMES[state - 1]}:")
        return state

    for role, text, n in zip(chunk.role, chunk.text, chunk.n, strict=True):
        for _ in range(n):
            marks = next(edit)
            state = inserted(marks, state)
            if marks[-1] == "K":
                state = KEEPS[role[:1]][state]
                lines.append(f"{role}:{text}")
            elif marks[-1] == "R":
                state = FOLLOWS[state]
                lines.append(f"{NAMES[state - 1]}:{text}")
    for marks in edit:
        state = inserted(marks, state)
    return "\n".join(lines) if lines else None


# --- the steps ----------------------------------------------------------------------------

_ROWS = "array<struct<turn: bigint, role: string, text: string, n: bigint>>"
_RESULT = ("gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
           "audit string, repaired string")


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def _arrow(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(T.StructType.fromDDL(ddl))


def _equal_rows_once(rows: DataFrame) -> DataFrame:
    """Equal rows of a batch as one with their number: many copies of a row don't all travel."""
    def merge(batches):
        for b in batches:
            t = pa.Table.from_batches([b]).group_by(["conv_id", "turn", "role", "text"]).aggregate([("n", "sum")])
            yield from t.select(["conv_id", "turn", "role", "text", "n_sum"]) \
                .rename_columns(["conv_id", "turn", "role", "text", "n"]).to_batches()

    return rows.mapInArrow(merge, rows.schema)


def _folded(rows: DataFrame) -> DataFrame:
    """From rows in order: finished conversations (``whole``), and chunks (``rows``) of those
    that begin or end with a partition or are larger than a chunk. ``chunk`` ascends with the order."""
    out_ddl = f"conv_id bigint, chunk bigint, whole boolean, {_RESULT}, rows {_ROWS}"
    schema = _arrow(out_ddl)

    def fold(batches: Iterator[pa.RecordBatch]):
        number = TaskContext.get().partitionId() << 32
        held, conv, touches, out, size = Chunk(), None, True, [], 0

        def close(open_end: bool) -> None:
            nonlocal held, number, touches, size
            row = {"conv_id": conv, "chunk": number, "whole": not (open_end or touches)}
            row |= _finished(held) if row["whole"] else {"rows": held.rows()}
            out.append(row)
            size += held.size + 100 * len(held.n)
            number, held = number + 1, Chunk()

        for b in batches:
            for c, turn, role, text, n in zip(*(column_of(b, x).to_pylist() for x in ("conv_id", "turn", "role", "text", "n")),
                                              strict=True):
                if held.n and c != conv:
                    close(False)
                    touches = False
                elif held.full():
                    close(True)
                    touches = True      # the rest is a chunk, not a whole conversation
                conv = c
                held.add(turn, role, text, n)
                if size > CHUNK_BYTES:
                    yield _batch(out, schema)
                    out.clear()
                    size = 0
        if held.n:
            close(True)
        yield _batch(out, schema)

    return rows.mapInArrow(fold, out_ddl)


def _finished(chunk: Chunk) -> dict:
    runs, count = symbols(chunk)
    edits, _ = unroll(runs, END, START, True)
    s, costs = shape(chunk), END
    for sym, length in reversed(runs):
        costs = before(sym, length, costs)
    return count | {"illegal": s["illegal"], "cost": costs[START], "audit": "".join(edits),
                    "gaps": s["high"] - s["low"] + 1 - s["turns"] if s["turns"] else 0,
                    "repaired": written(chunk, edits, START)}


def _resolved(open_: DataFrame) -> DataFrame:
    """Open chunks with their runs of symbols, counts, shape and min-plus matrix. A row is new in
    the first chunk of its conversation that has it."""
    def names(batches):
        for b in batches:
            for conv, number, rows in zip(*(column_of(b, x).to_pylist() for x in ("conv_id", "chunk", "rows")), strict=True):
                own = list({_name(r["role"], r["text"]) for r in rows if r["n"]})
                yield pa.RecordBatch.from_arrays([pa.array([conv] * len(own), pa.int64()), pa.array([number] * len(own), pa.int64()),
                                                  pa.array(own, pa.binary())], ["conv_id", "chunk", "name"])

    new = open_.select("conv_id", "chunk", "rows").mapInArrow(names, "conv_id bigint, chunk bigint, name binary") \
        .groupBy("conv_id", "name").agg(F.min("chunk").alias("chunk")) \
        .groupBy("chunk").agg(F.collect_list("name").alias("new"))      # no more than a chunk's rows
    ddl = (f"conv_id bigint, chunk bigint, rows {_ROWS}, syms array<bigint>, lengths array<bigint>, matrix array<bigint>, "
           "blank bigint, duplicate bigint, truncated bigint, illegal bigint, first string, last string, low bigint, high bigint, "
           "turns bigint")
    schema = _arrow(ddl)

    def resolve(batches):
        for b in batches:
            for row in b.to_pylist():
                chunk = Chunk.of(row["rows"])
                runs, count = symbols(chunk, set(row.pop("new") or []))
                yield _batch([row | count | shape(chunk) | {
                    "syms": [s for s, _ in runs], "lengths": [n for _, n in runs], "matrix": matrix(runs).ravel().tolist()}], schema)

    joined = open_.select("conv_id", "chunk", "rows").join(new, "chunk", "left").select("conv_id", "chunk", "rows", "new")
    return joined.mapInArrow(resolve, ddl)


def _in_order(small: DataFrame, ascending: bool) -> DataFrame:
    """A few numbers for each chunk, each conversation's in one task and in order."""
    order = F.col("chunk").asc() if ascending else F.col("chunk").desc()
    return small.repartition("conv_id").sortWithinPartitions("conv_id", order)


def _costs_behind(chunks: DataFrame) -> DataFrame:
    """From last to first: the costs to go behind each chunk and before it, and what the border to
    the next chunk adds to illegal neighbours and takes from the distinct turns."""
    ddl = "conv_id bigint, chunk bigint, behind array<bigint>, cost bigint, border bigint, shared bigint, is_last boolean"

    def back(batches):
        conv, costs, first, low, begun = None, END, None, None, False
        for b in batches:
            out = []
            for r in b.to_pylist():
                is_last = not begun or r["conv_id"] != conv
                if is_last:
                    conv, costs, first, low, begun = r["conv_id"], END, None, None, True
                m = np.array(r["matrix"], np.int64).reshape(4, 4)
                now = tuple(np.minimum((m + np.array(costs)[None]).min(1), NEVER).tolist())
                both = r["last"] is not None and first is not None
                out.append({"conv_id": conv, "chunk": r["chunk"], "behind": costs, "cost": now[START], "is_last": is_last,
                            "border": int(both and r["last"] + first not in LEGAL),
                            "shared": int(r["high"] is not None and r["high"] == low)})
                costs = now
                first = first if r["first"] is None else r["first"]
                low = low if r["low"] is None else r["low"]
            yield _batch(out, schema)

    schema = _arrow(ddl)
    return _in_order(chunks.select("conv_id", "chunk", "matrix", "first", "last", "low", "high"), False).mapInArrow(back, ddl)


def _entries(chunks: DataFrame, costs: DataFrame) -> DataFrame:
    """The state in which the cheapest edits enter each chunk."""
    ddl = "conv_id bigint, chunk bigint, exits array<bigint>"

    def through(batches):
        for b in batches:
            out = []
            for r in b.to_pylist():
                runs = list(zip(r["syms"], r["lengths"], strict=True))
                out.append({"conv_id": r["conv_id"], "chunk": r["chunk"],
                            "exits": [unroll(runs, tuple(r["behind"]), s, False)[1] for s in range(4)]})
            yield _batch(out, schema)

    def enter(batches):
        conv, state, begun = None, START, False
        for b in batches:
            rows, states = b.to_pylist(), []
            for r in rows:
                if not begun or r["conv_id"] != conv:
                    conv, state, begun = r["conv_id"], START, True
                states.append(state)
                state = r["exits"][state]
            yield pa.RecordBatch.from_arrays([column_of(b, "chunk"), pa.array(states, pa.int64())], ["chunk", "entry"])

    schema = _arrow(ddl)
    exits = chunks.select("conv_id", "chunk", "syms", "lengths").join(costs.select("chunk", "behind"), "chunk") \
        .mapInArrow(through, ddl)
    return _in_order(exits, True).mapInArrow(enter, "chunk bigint, entry bigint")


def _pieces(chunks: DataFrame, costs: DataFrame, entries: DataFrame) -> DataFrame:
    ddl = "conv_id bigint, chunk bigint, audit string, repaired string"

    def write(batches):
        for b in batches:
            for r in b.to_pylist():
                runs = list(zip(r["syms"], r["lengths"], strict=True))
                edits, _ = unroll(runs, tuple(r["behind"]), r["entry"], r["is_last"])
                yield _batch([{"conv_id": r["conv_id"], "chunk": r["chunk"], "audit": "".join(edits),
                               "repaired": written(Chunk.of(r["rows"]), edits, r["entry"])}], schema)

    schema = _arrow(ddl)
    return chunks.select("conv_id", "chunk", "rows", "syms", "lengths") \
        .join(costs.select("chunk", "behind", "is_last"), "chunk").join(entries, "chunk").mapInArrow(write, ddl)


@dataclass
class Repaired:
    """``conversations``: one row each with its counts and cost. ``pieces``: ``conv_id, chunk,
    audit, repaired`` of each conversation, one row or (large ones) several in order of ``chunk``."""
    conversations: DataFrame
    pieces: DataFrame
    whole: DataFrame
    split: DataFrame


_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def repair(rows: DataFrame) -> Repaired:
    """Repairs ``rows`` (``conv_id``, ``turn``, ``role``, ``text``, and ``copies`` if there is such
    a column: how often a row stands, 0 for a row that only names its conversation).

    Rows go by turn, null turns first, then by role and text. Null roles and texts are one space;
    null conversation ids are one conversation. Blank and duplicate rows (same role and text
    earlier) are deleted. A conversation without rows has zeros, an empty audit and no text.
    Equal rows are duplicates of the first; empty tables give no rows; other columns are ignored.
    """
    spark = rows.sparkSession
    ship(spark)
    n = F.col("copies").cast("long") if "copies" in rows.columns else F.lit(1).cast("long")
    plain = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
                        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"), n.alias("n"))
    ordered = _equal_rows_once(plain).repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, BORDER)) \
        .sortWithinPartitions("conv_id", "turn", "role", "text")
    folded = stored(_folded(ordered), "conversations")
    whole = folded.where("whole").drop("rows", "whole")
    chunks = stored(_resolved(folded.where(~F.col("whole"))), "open-chunks")
    costs = stored(_costs_behind(chunks), "costs-behind")
    split = stored(_pieces(chunks, costs, _entries(chunks, costs)), "open-pieces")
    joined = chunks.select("conv_id", "chunk", "blank", "duplicate", "truncated", "illegal", "low", "high", "turns") \
        .join(costs.select("chunk", "cost", "border", "shared"), "chunk")
    open_counts = joined.groupBy("conv_id").agg(
        F.coalesce(F.max("high") - F.min("low") + 1 - (F.sum("turns") - F.sum("shared")), F.lit(0)).alias("gaps"),
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")],
        F.sum(F.col("illegal") + F.col("border")).alias("illegal"), F.min_by("cost", "chunk").alias("cost"))
    pieces = ["conv_id", "chunk", "audit", "repaired"]
    return Repaired(whole.select("conv_id", *_COUNTS).unionByName(open_counts.select("conv_id", *_COUNTS)),
                    whole.select(*pieces).unionByName(split), whole, split.join(open_counts, split["conv_id"].eqNullSafe(
                        open_counts["conv_id"])).select(split["*"], *_COUNTS))


def joined_up(split: DataFrame) -> DataFrame:
    """``conv_id``, counts, ``audit`` and ``repaired_sha256`` of conversations in several pieces: a
    task reads a conversation's pieces in order and holds its digest and audit, not its text."""
    ddl = "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, " \
          "audit string, repaired_sha256 string"
    schema = _arrow(ddl)

    def join(batches):
        now, digest, audit, begun = None, None, [], False

        def done():
            return _batch([now | {"audit": "".join(audit), "repaired_sha256": digest.hexdigest()}], schema)

        for b in batches:
            for r in b.to_pylist():
                if now is None or r["conv_id"] != now["conv_id"]:
                    if now is not None:
                        yield done()
                    now = {c: r[c] for c in ("conv_id", *_COUNTS)}
                    digest, audit, begun = hashlib.sha256(), [], False
                audit.append(r["audit"])
                if r["repaired"] is not None:
                    digest.update((b"\n" if begun else b"") + r["repaired"].encode())
                    begun = True
        if now is not None:
            yield done()

    return _in_order(split, True).mapInArrow(join, ddl)


def damage(conversations: DataFrame) -> DataFrame:
    """The contract's faults, by ``crc32(conv_id:turn) % 20``, as rows with ``copies``."""
    spoken = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    kind = F.crc32(F.concat(spoken["conv_id"], F.lit(":"), spoken["turn"]).cast("binary")) % 20
    text = F.when(kind <= 1, F.lit("")).when(kind == 2, F.translate(spoken["text"], ".!?", "")).otherwise(spoken["text"])
    return conversations.select(
        "conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(spoken["role"]).alias("role"), text.alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = repair(damage(spark.read.parquet(f"{sf_dir}/conversations.parquet")))
    columns = ["conv_id", *_COUNTS, "audit", "repaired_sha256"]
    whole = done.whole.withColumn("repaired_sha256", F.sha2(F.coalesce("repaired", F.lit("")).cast("binary"), 256))
    return whole.select(*columns).unionByName(joined_up(done.split).select(*columns))
