"""Operator 6: quality rules with host verdicts.

Each document is measured by rules on its own text. Failures are added up by host, a beta
prior is fitted to the hosts' failure rates by their mean and variance, and each host's rate
is shrunk towards it: hosts with few documents stay near the mean. Documents of hosts whose
shrunk rate is too high go too. Everything here is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from flotilla.llm.common import documents, stored

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
# A host goes when its shrunk failure rate is above this.
MAX_HOST_RATE = 0.8
# Rows of one host are joined to its verdict in this many groups.
HOST_SALTS = 32
_WHITE = r"[\x20\x09-\x0D]+"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def repeat_words(words: Column) -> Column:
    """Words in 3-word windows that occur twice or more. Windows are compared by 64-bit hashes."""
    def windows(h):
        return F.transform(F.sequence(F.lit(0), F.size(h) - 3), lambda i: F.xxhash64(h[i], h[i + 1], h[i + 2]))

    def repeated(tri):
        # One sort finds the candidates: 44 bits of the hash, then the position. The few of
        # them are compared by the whole hash.
        def same(s, i, j):
            return F.shiftrightunsigned(F.get(s, i), 20) == F.shiftrightunsigned(F.get(s, j), 20)

        def candidates(s):
            return F.filter(s, lambda x, i: F.coalesce(same(s, i, i - 1), F.lit(False))
                            | F.coalesce(same(s, i, i + 1), F.lit(False)))

        packed = F.sort_array(F.transform(tri, lambda x, i: x.bitwiseAND(F.lit(~((1 << 20) - 1)))
                                          .bitwiseOR(i.cast("long"))))
        return _let(packed, candidates)

    def exact(tri):
        def by_hash(found):
            return F.sort_array(F.transform(found, lambda x: _let(
                x.bitwiseAND(F.lit((1 << 20) - 1)).cast("int"), lambda p: F.struct(tri[p].alias("h"), p.alias("p")))))

        def twice(s):
            return F.filter(s, lambda x, i: F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False))
                            | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)))
        return F.sort_array(F.transform(_let(_let(repeated(tri), by_hash), twice), lambda x: x["p"]))

    def long_exact(tri):
        """Of texts with so many words that their positions don't fit beside the hash."""
        def twice(s):
            return F.filter(s, lambda x, i: F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False))
                            | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)))
        return F.sort_array(F.transform(_let(F.sort_array(F.transform(
            tri, lambda x, i: F.struct(x.alias("h"), i.alias("p")))), twice), lambda x: x["p"]))

    def covered(positions):
        start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n"))
        return F.aggregate(positions, start, lambda a, p: F.struct(
            p.alias("last"), (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n")), lambda a: a["n"])

    def count(tri):
        return F.when(F.size(F.array_distinct(tri)) == F.size(tri), F.lit(0).cast("long")) \
            .when(F.size(tri) < (1 << 20), covered(exact(tri))).otherwise(covered(long_exact(tri)))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) < 3, F.lit(0).cast("long")) \
        .otherwise(_let(_let(hashes, windows), count))


def measures(text: Column) -> Column:
    """A struct of a text's rule values; null is a text without words."""
    whole = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    words = F.filter(F.split(whole, _WHITE), lambda w: w != "")
    by_words = _let(words, lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
        repeat_words(w).alias("n_repeat_words")))
    by_lines = _let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))
    symbols = F.char_length(F.regexp_replace(whole, r"[^#*$%&|<>]+", "")).cast("long")
    return _let(by_words, lambda m: F.struct(m["n_words"].alias("n_words"), m["word_chars"].alias("word_chars"),
                                             symbols.alias("n_symbols"), by_lines.alias("n_dup_lines"),
                                             m["n_repeat_words"].alias("n_repeat_words")))


def base_failed(m: str) -> Column:
    return (F.col(f"{m}.n_words") < MIN_WORDS) | \
        (100 * F.col(f"{m}.n_repeat_words") > MAX_REPEAT_PERCENT * F.col(f"{m}.n_words"))


def host_rates(judged: DataFrame) -> DataFrame:
    """``host, n, failed, rate``: the shrunk rate of each host (columns ``host``, ``failed``).

    The prior's mean is the rate over all rows; its weight comes from the variance between
    hosts beyond what rows alone would give. Without such variance the weight is at its most.
    """
    hosts = stored(judged.groupBy("host").agg(F.count("*").alias("n"), F.count_if("failed").alias("failed")), "hosts")
    one = hosts.agg(F.sum("n").alias("n"), F.sum("failed").alias("f"), F.count("*").alias("k"),
                    F.sum(F.col("failed") * F.col("failed") / F.col("n")).alias("s")).first()
    if not one["n"]:
        return hosts.withColumn("rate", F.lit(0.0))
    mean = one["f"] / one["n"]
    spread = mean * (1 - mean)
    # variance of the hosts' rates, weighted by rows, less the share that rows alone explain
    between = max(0.0, one["s"] / one["n"] - mean * mean - spread * one["k"] / one["n"])
    weight = min(1e6, max(1.0, spread / between - 1)) if between > 0 else 1e6
    return hosts.withColumn("rate", (F.col("failed") + F.lit(mean * weight)) / (F.col("n") + F.lit(weight)))


def quality(docs: DataFrame, max_host_rate: float = MAX_HOST_RATE, host: str = "source") -> DataFrame:
    """Every row of ``docs`` as ``row`` (a struct of all its columns, so no name can clash) with
    ``m``, its rule values, ``base_failed`` and ``kept``.

    Null texts are empty and fail. Rows with a null host are a host of their own. Repeated rows
    each get their result; an empty table gives no rows.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    judged = rows.withColumn("m", measures(F.col("row.text"))).withColumn("base_failed", base_failed("m"))
    return _verdicts(judged, F.col(f"row.`{host}`"), max_host_rate)


def _verdicts(judged: DataFrame, host: Column, max_host_rate: float) -> DataFrame:
    judged = stored(judged, "quality").withColumn("_host", host)
    rates = host_rates(judged.select(F.col("_host").alias("host"), F.col("base_failed").alias("failed")))
    # a host may have a third of all rows: its verdict stands once for each salt
    verdicts = rates.select("host", (F.col("rate") <= max_host_rate).alias("_host_ok"),
                            F.explode(F.sequence(F.lit(0), F.lit(HOST_SALTS - 1))).alias("_s"))
    salted = judged.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(HOST_SALTS)).cast("int"))
    return salted.join(verdicts, F.col("_host").eqNullSafe(F.col("host")) & (F.col("_salt") == F.col("_s")), "left") \
        .withColumn("kept", ~F.col("base_failed") & F.coalesce("_host_ok", F.lit(True))) \
        .drop("_host", "_salt", "_s", "_host_ok", "host")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over whole ``documents``; the texts stay behind once they are measured."""
    measured = documents(spark, sf_dir).select(
        F.struct("doc_id", "source").alias("row"), measures(F.col("text")).alias("m"))
    judged = measured.withColumn("base_failed", base_failed("m"))
    return _verdicts(judged, F.col("row.source"), MAX_HOST_RATE) \
        .select("row.doc_id", "m.n_words", "m.word_chars", "m.n_symbols", "m.n_dup_lines", "m.n_repeat_words",
                "base_failed", "kept")
