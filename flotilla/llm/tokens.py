"""Token ids of whole texts by the tokenizers library, each distinct segment encoded once.

A text is cut only where the tokenizer's own pre-tokenization always cuts: before white
space that follows a visible character, and between an ASCII letter and ASCII punctuation.
No pre-token spans such a place, and what follows it doesn't depend on what came before, so
the ids of a text are those of its segments in order. Segments recur, so a worker encodes
each distinct one once and copies its ids; the memory for that is bounded by MAX_KNOWN.
Tokenizers of any other build encode whole texts.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import os
import re
import struct

import numpy as np

from flotilla.llm.common import WHITE, binary_array, ranges

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")    # a task has one core

# Distinct segments whose ids a worker remembers (about 200 bytes each); when full it starts afresh.
MAX_KNOWN = 200_000
# A task encodes this many text bytes at a time (or one longer text).
SLICE = 4 << 20

# What the two supported pre-tokenizers look like in their files. Fixed values.
BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

_WORKER: dict[str, "Encoder"] = {}


def read_tokenizer(path: str) -> str:
    """The tokenizer file's text; the driver reads it once and sends it with the tasks."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def version_of(spec: str) -> str:
    return hashlib.sha256(spec.encode()).hexdigest()


def encoder(spec: str) -> "Encoder":
    """This worker's encoder for a tokenizer file's text."""
    key = version_of(spec)
    if key not in _WORKER:
        _WORKER[key] = Encoder(spec)
    return _WORKER[key]


def byte_letters() -> dict[int, str]:
    """Byte-level BPE writes each byte as one printable character: itself, or 256 and up."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


def pack(ids: list[int]) -> bytes:
    return struct.pack(f"={len(ids)}I", *ids)


class Encoder:
    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        parsed = json.loads(spec)
        specials = "".join(t["content"] for t in parsed.get("added_tokens") or [])
        pre, norm = parsed.get("pre_tokenizer") or {}, parsed.get("normalizer")
        plain = parsed["model"]["type"] == "BPE" and not parsed["model"].get("dropout")
        self.drops_white = False
        if norm is None and all(pre.get(k) == v for k, v in BYTE_LEVEL.items()):
            self.by_segment = plain
        else:
            steps = [n.get("type") for n in (norm or {}).get("normalizers", [])]
            split = (pre.get("pretokenizers") or [{}])[0]
            self.drops_white = steps == ["NFC", "Replace", "Lowercase"] \
                and split.get("pattern") == {"Regex": WORD_PATTERN}
            self.by_segment = plain and self.drops_white
        if any(c in specials for c in " \t\r\n"):
            self.by_segment = False
        # classes of bytes: 1 white space, 2 letter, 4 punctuation that no special token has
        self.kind = np.zeros(256, np.uint8)
        self.kind[list(WHITE)] = 1
        letters = [c for c in range(128) if chr(c).isalpha()]
        self.kind[letters] = 2
        self.kind[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in specials]] = 4
        # segments that are one pre-token: letters after at most one space
        self.single = re.compile(" ?[A-Za-zÀ-ÖØ-öø-ÿ]+").fullmatch
        self.letters = byte_letters()
        self.known: dict[bytes, bytes] = {}     # segment to ids, 32 bit each

    def _cuts(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        kind = self.kind[data]
        cut = np.zeros(len(data) + 1, bool)
        before, here = kind[:-1], kind[1:]
        cut[1:-1] = ((here == 1) & (before != 1)) | ((before == 2) & (here == 4))
        # other scripts' white space: no cut after the characters that may be some
        at = np.flatnonzero(cut[1:-1] & (data[:-1] >= 0x80)) + 1
        if len(at):
            last, second, third = data[at - 1], data[np.maximum(at - 2, 0)], data[np.maximum(at - 3, 0)]
            odd = (second == 0xC2) & ((last == 0x85) | (last == 0xA0))
            for a, b in ((0xE1, 0x9A), (0xE1, 0xA0), (0xE2, 0x80), (0xE2, 0x81), (0xE3, 0x80), (0xEF, 0xBB)):
                odd |= (third == a) & (second == b)
            cut[at[odd]] = False
        cut[off] = True
        return np.flatnonzero(cut)

    def _learn(self, fresh: list[bytes]) -> None:
        if len(self.known) + len(fresh) > MAX_KNOWN:
            self.known.clear()
        model, rest = self.tokenizer.model, []
        for raw in fresh:
            text = raw.decode("utf-8")
            if self.drops_white:
                text = text.strip(" \t\n\x0b\x0c\r")
            if self.single(text):
                if self.drops_white:
                    text = text.lower()
                shown = text.replace(" ", "Ġ") if text.isascii() else text.encode().decode("latin-1").translate(self.letters)
                self.known[raw] = pack([t.id for t in model.tokenize(shown)])
            else:
                rest.append(raw)
        for raw, e in zip(rest, self.tokenizer.encode_batch_fast([r.decode("utf-8") for r in rest],
                                                                 add_special_tokens=False), strict=True):
            self.known[raw] = pack(e.ids)

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts given as bytes and offsets: (ids, n + 1 offsets into them)."""
        if not self.by_segment:
            raw = data.tobytes()
            texts = [raw[a:b].decode("utf-8") for a, b in zip(off[:-1], off[1:], strict=True)]
            got = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            bounds = np.zeros(len(got) + 1, np.int64)
            np.cumsum([len(x) for x in got], out=bounds[1:])
            return np.fromiter(itertools.chain.from_iterable(got), np.uint32, int(bounds[-1])), bounds
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(off), np.int64)
        cuts = self._cuts(data, off)
        coded = binary_array(data, cuts).dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        fresh = [s for s in distinct if s not in self.known]
        if len(self.known) + len(fresh) > MAX_KNOWN:
            fresh = distinct                    # _learn starts afresh
        self._learn(fresh)
        got = [self.known[s] for s in distinct]
        size = np.fromiter(map(len, got), np.int64, len(got)) // 4
        ids = np.frombuffer(b"".join(got), np.uint32)
        first = np.cumsum(size) - size
        which = coded.indices.to_numpy()
        lengths = size[which]
        bounds = np.zeros(len(which) + 1, np.int64)
        np.cumsum(lengths, out=bounds[1:])
        return ids[ranges(first[which], lengths)], bounds[np.searchsorted(cuts, off)]
