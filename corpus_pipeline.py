"""From raw documents to packed training sequences, in five stages.

Each stage takes the documents that its predecessor kept and decides on all of them; all but
the last return the columns of ``documents``. ``run`` writes each stage's result as Parquet in
the shared folder and reads it for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from flotilla.llm.common import documents, stored
from flotilla.llm.decontaminate import decontaminate
from flotilla.llm.line_dedup import line_dedup
from flotilla.llm.near_dup import Rule, one_of_each
from flotilla.llm.packing import pack_documents
from flotilla.llm.quality import quality


def _with_text(changed: DataFrame, columns: list[str], text: str) -> DataFrame:
    """The columns of ``row`` with another text and its length."""
    new = {"text": F.col(text), "n_chars": F.char_length(text).cast("long")}
    return changed.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the rules, or whose host does, go."""
    return quality(docs).where("kept").select("row.*")


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that at least ten documents have go from all of them."""
    return _with_text(line_dedup(docs), docs.columns, "kept")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five-word shingles, similarity 0.8."""
    return one_of_each(docs, Rule(words=5, percent=80))


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of the benchmark go; a document that is mostly such passages goes altogether."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _with_text(decontaminate(docs, benchmark), docs.columns, "text")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document's pieces stand in sequences of 2048 tokens."""
    import public_tokenizers
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", repeated_lines),
    ("near-duplicates", near_duplicates),
    ("decontamination", benchmark_passages),
    ("packing", packed),
]

# Near-duplicates, suffix automata and packing have no SQL; tests/llm holds the stages against
# brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
