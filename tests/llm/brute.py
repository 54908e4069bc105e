"""Plain versions of the operators for a few hundred rows, and awkward tables."""

import collections
import hashlib
import re

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
WHITE = " \t\n\x0b\x0c\r"
LAST = 1 << 63

# columns that operators use as names of their own
CLASHES = ["id", "row", "digest", "h", "n", "node", "label", "spans", "kept", "n_words", "length", "part", "m"]


def sha(raw):
    return hashlib.sha256(raw.encode() if isinstance(raw, str) else raw).hexdigest()


def frame(spark, rows, clashes=True):
    """(doc_id, text[, lang, source]) rows as a documents table with clashing extra columns."""
    from pyspark.sql import functions as F
    full = [(r[0], r[1], r[2] if len(r) > 2 else None, r[3] if len(r) > 3 else None,
             None if r[1] is None else len(r[1])) for r in rows]
    df = spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({c: F.lit("x") for c in CLASHES}) if clashes else df


def read(sf_dir, name):
    import pyarrow.parquet as pq
    return pq.read_table(f"{sf_dir}/{name}.parquet").to_pylist()


def rows_of(sf_dir):
    return [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in read(sf_dir, "documents")]


def removed_bytes(rows, length=50):
    """Of each row: (n_bytes, n_removed, n_spans, sha of what is left)."""
    first = {}
    for i, text, *_ in rows:
        b = (text or "").encode()
        for p in range(len(b) - length + 1):
            w = b[p:p + length]
            first[w] = min(first.get(w, LAST + 1), LAST if i is None else i)
    out = []
    for i, text, *_ in rows:
        b = (text or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if first[b[p:p + length]] < (LAST if i is None else i):
                gone[p:p + length] = b"\x01" * length
        out.append((i, len(b), sum(gone), len(re.findall(b"\x01+", bytes(gone))),
                    sha(bytes(c for c, g in zip(b, gone) if not g))))
    return out


def contamination(rows, items, window=10):
    wins = collections.defaultdict(set)
    for name, text in items:
        w = ITEM_WORD.findall((text or "").translate(AZ))
        for k in range(max(1, len(w) - window + 1) if w else 0):
            wins[tuple(w[k:k + window])].add(str(name) if name is not None else "")
    out = []
    for i, text, *_ in rows:
        w = ITEM_WORD.findall((text or "").translate(AZ))
        hit, names = set(), set()
        for size in {len(k) for k in wins}:
            for k in range(len(w) - size + 1):
                if tuple(w[k:k + size]) in wins:
                    hit.update(range(k, k + size))
                    names |= wins[tuple(w[k:k + size])]
        out.append((i, len(w), len(hit), len(names), sha(",".join(sorted(names))), bool(hit)))
    return out


def shingles(text, k):
    w = WORD.findall((text or "").translate(AZ))
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def components(rows, k, percent):
    """(doc_id, set size, component, kept) of each row; links between all rows."""
    sets = [shingles(r[1], k) for r in rows]
    keys = [LAST if r[0] is None else r[0] for r in rows]
    up = list(range(len(rows)))

    def top(a):
        while up[a] != a:
            a = up[a]
        return a

    at = collections.defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            at[g].append(i)
    shared = collections.Counter()
    for members in at.values():
        for y in range(len(members)):
            for x in range(y):
                shared[members[x], members[y]] += 1
    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            up[top(a)] = top(b)
    least = {}
    for i in range(len(rows)):
        least[top(i)] = min(least.get(top(i), LAST + 1), keys[i])
    return [(r[0], len(sets[i]), None if least[top(i)] == LAST else least[top(i)], keys[i] == least[top(i)])
            for i, r in enumerate(rows)]


def rules(rows):
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    out = []
    for i, text, *_ in rows:
        t = text or ""
        w = WORD.findall(t)
        count = collections.Counter(tuple(w[k:k + 3]) for k in range(len(w) - 2))
        again = {p for k in range(len(w) - 2) if count[tuple(w[k:k + 3])] > 1 for p in (k, k + 1, k + 2)}
        seen, dup = set(), 0
        for line in t.split("\n"):
            if WORD.search(line):
                dup += line in seen
                seen.add(line)
        out.append((i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(again),
                    len(w) < 50 or 100 * len(again) > 50 * len(w)))
    return out


def without_common_lines(rows, min_docs=10):
    """(doc_id, n_lines, n_dropped, text left)."""
    def key(line):
        return line.strip(WHITE).translate(AZ)
    count = collections.Counter(k for r in rows for k in {key(x) for x in (r[1] or "").split("\n")})
    out = []
    for i, text, *_ in rows:
        lines = (text or "").split("\n")
        left = [x for x in lines if not key(x) or count[key(x)] < min_docs]
        out.append((i, len(lines), len(lines) - len(left), "\n".join(left)))
    return out


def awkward(words=("alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta", "theta", "iota", "kappa"), seed=3):
    """Nulls, empty and very long texts, ties, repeated rows, near copies, odd characters."""
    import random
    rng = random.Random(seed)

    def prose(n, lines=7):
        return " ".join(rng.choice(words) + rng.choice(["", "", ",", "s", "é"]) + ("\n" if rng.random() < 1 / lines else "")
                        for _ in range(n))
    base = [prose(n) for n in (80, 120, 60, 3, 1, 2000)]
    rows = [(i, t, "en", "src0") for i, t in enumerate(base)]
    rows += [(20, base[0], "en", "src0"), (21, base[0], None, "src1"), (21, base[0], None, "src1"),     # copies, repeated row
             (22, base[1].replace("alpha", "ALPHA", 1) + " tail end", "de", None),
             (22, base[2] + " x y", "de", "src1"),                                                      # one id, two texts
             (23, None, None, None), (24, "", "en", "src1"), (25, " \t\n\r ", "en", "src1"), (26, "\n\n\n", "fr", ""),
             (None, base[1], "en", "src0"), (None, base[1], "en", "src0"), (None, None, None, None),
             (27, "   　 !!?? ## $$ \U0001F600 <|endoftext|> it's we'll\x00x " * 5, "en", "src2"),
             (28, (base[0] + "\n") * 60, "en", "src0"), (29, "the " * 3000, "en", "src2"),
             (30, "ÀÉ Straße d'été, l'île " * 20, "fr", "src2")]
    rows += [(100 + i, f"Shared  Line {i % 2}\n\tshared line X \r\nown {i} line\n{prose(30)}", "en", "src3") for i in range(12)]
    rows += [(200 + i, " ".join(w if rng.random() > 0.01 * (i % 4) else "zz" for w in base[5].split(" ")), "en", "src0")
             for i in range(12)]
    return rows
