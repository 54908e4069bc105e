"""Pretty-printed JSON arrays, read by many tasks.

Such a file has an element's braces on lines of their own, as far in as the first one's:

    [
      {
        "id": 1
      },
      {

A string can't hold a raw line break, and what is inside an element stands further in, so a
closing brace at that depth with a comma is a border between elements and nothing else. Spark's
text reader splits files at any separator; each piece then is one element without its last line.
A broken element spoils only itself.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# Bytes at a file's start that show how it is laid out.
HEAD = 256
# So many files are parallel enough by themselves; their heads aren't looked at one by one.
MANY_FILES = 1000


def _heads(spark: SparkSession, path: str) -> list[bytes] | None:
    """The first bytes of each file of a path (a file, a folder or a pattern); None if there are many."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    files = []
    for found in fs.globStatus(hadoop) or []:
        inside = fs.listStatus(found.getPath()) if found.isDirectory() else [found]
        files += [f.getPath() for f in inside if not f.isDirectory() and f.getLen() and f.getPath().getName()[0] not in "._"]
        if len(files) > MANY_FILES:
            return None
    heads = []
    for f in files:
        stream = fs.open(f)
        try:
            heads.append(bytes(stream.readNBytes(HEAD)))
        finally:
            stream.close()
    return heads


def element_border(spark: SparkSession, path: str) -> str | None:
    """What ends an element in all files of ``path``; None if a file isn't laid out like that."""
    borders = set()
    for head in _heads(spark, path) or [b""]:
        opening = re.match(rb"(?:\xef\xbb\xbf)?\[(\r?\n)([ \t]+)\{\r?\n", head)
        borders.add(opening and (opening[1] + opening[2]).decode() + "},")
    return borders.pop() if len(borders) == 1 else None


def read_elements(spark: SparkSession, path: str, schema: StructType, border: str, bad_column: str | None) -> DataFrame:
    """One row for each element of the arrays at ``path``; ``bad_column`` has the text of those that
    don't fit the schema, as Spark's own reader does."""
    piece = spark.read.option("lineSep", border).text(path).select("value")
    body = F.regexp_replace("value", r"^\uFEFF?\[", "")
    # the last piece has its brace and the array's end, at the very left
    is_last = F.col("value").rlike(r"\n\]\s*$")
    element = F.trim(F.when(is_last, F.regexp_replace(body, r"\r?\n\]\s*$", "")).otherwise(F.concat(body, F.lit(border[:-1]))), F.lit(" \t\r\n"))
    # elements of one line have no border of their own: they stand before the next one that has
    simple = r"(\{\s*\}|\[\s*\]|null|true|false|-?[0-9][0-9.eE+-]*)\s*,\s*"
    before = F.regexp_extract_all(F.regexp_extract("element", rf"^((?:{simple})*)", 1), F.lit(simple), 1)
    rest = F.regexp_replace("element", rf"^(?:{simple})*", "")
    elements = piece.select(element.alias("element")).where(F.length("element") > 0) \
        .select(F.explode(F.concat(before, F.array(rest))).alias("element"))
    if bad_column:
        schema = StructType([*schema.fields, StructField(bad_column, StringType(), True)])
    parsed = F.from_json("element", schema, {"columnNameOfCorruptRecord": bad_column} if bad_column else {})
    # a generator's output is computed once, whatever filters come later
    rows = elements.select("element", F.explode(F.array(parsed)).alias("row"))
    bad = [F.coalesce(F.col(f"row.`{bad_column}`"), F.when(F.col("row").isNull(), F.col("element"))).alias(bad_column)] if bad_column else []
    return rows.select(*[F.col(f"row.`{f.name}`").alias(f.name) for f in schema.fields if f.name != bad_column], *bad)
