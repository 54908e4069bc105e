"""Batch readers with explicit schemas (no inference pass over the data).

CSV columns are found by the header's names, whatever their order. JSON inputs come either as
JSON Lines or as one array (``multi_line=True``). An array that is pretty-printed, an element's
braces on lines of their own, is split between elements (``sources.arrays``); any other one is
read by one task for each file, so land it once as Parquet (``flotilla.sinks.publish``) and read
the Parquet copy afterwards.

With ``bad_column`` a reader adds a text column of that name: null where the whole record fits
the schema, else what didn't (the JSON record, a CSV record of too few or too many fields, or the
names of the CSV fields). The record itself is kept, with nulls for what doesn't fit.
"""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from flotilla import schemas as S
from flotilla.notes import committed_path
from flotilla.sources.arrays import element_border, read_elements

log = logging.getLogger(__name__)

BAD = "_malformado"


class UnreadableInputError(ValueError):
    pass


MISSHAPEN = "_registro_deforme"


def _csv(spark: SparkSession, schema: StructType, path: str, bad_column: str | None) -> DataFrame:
    # all files must have the header of the first one; the fields are text until they're chosen
    reader = spark.read.option("header", True).option("enforceSchema", False)
    header = reader.csv(path).columns
    missing = [f.name for f in schema.fields if f.name not in header]
    if missing:
        raise UnreadableInputError(f"{path}: no column {', '.join(missing)} in the header {', '.join(header)}")
    text = reader.csv(path)
    if bad_column:
        # a record with another number of fields than the header is kept as text in one more column;
        # the parser can only tell if it reads all fields
        shape = StructType([StructField(c, StringType()) for c in [*header, MISSHAPEN]])
        text = reader.schema(shape).option("columnNameOfCorruptRecord", MISSHAPEN).option("columnPruning", False).csv(path)
    value = {f.name: F.col(f"`{f.name}`").try_cast(f.dataType) for f in schema.fields}
    out = {f.name: value[f.name] for f in schema.fields}
    if bad_column:
        misfits = F.concat_ws(",", *[F.when(F.col(f"`{n}`").isNotNull() & v.isNull(), F.lit(n)) for n, v in value.items()])
        out[bad_column] = F.coalesce(F.col(MISSHAPEN), F.nullif(misfits, F.lit("")))
    return text.select(*[c.alias(n) for n, c in out.items()])


def read_vehicles(spark: SparkSession, path: str, bad_column: str | None = None) -> DataFrame:
    """Vehicle master CSV with a header row."""
    return _csv(spark, S.VEHICLES, path, bad_column)


def read_deliveries(spark: SparkSession, path: str, bad_column: str | None = None) -> DataFrame:
    """Deliveries CSV; ``duracion_min`` read as text, an empty field is null."""
    return _csv(spark, S.DELIVERIES_RAW, path, bad_column)


def _json(spark: SparkSession, schema: StructType, path: str, multi_line: bool, bad_column: str | None) -> DataFrame:
    border = element_border(spark, path) if multi_line else None
    if border:
        return read_elements(spark, path, schema, border, bad_column)
    reader = spark.read.option("multiLine", multi_line)
    if bad_column:
        schema = StructType([*schema.fields, StructField(bad_column, StringType(), True)])
        reader = reader.option("columnNameOfCorruptRecord", bad_column)
    return reader.schema(schema).json(path)


def read_gps(spark: SparkSession, path: str, multi_line: bool = False, bad_column: str | None = None) -> DataFrame:
    """S3: GPS pings, one JSON object each."""
    return _json(spark, S.GPS_RAW, path, multi_line, bad_column)


def read_incidents(spark: SparkSession, path: str, multi_line: bool = False,
                   bad_column: str | None = None) -> DataFrame:
    """Incidents, one JSON object each."""
    return _json(spark, S.INCIDENTS_RAW, path, multi_line, bad_column)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """A text log, one ``value`` row per line (splittable; no RDD)."""
    return spark.read.text(path)


def refuse_if_nothing_fits(name: str, rows: int, bad: int, most_bad: float = 1.0) -> None:
    """Every record is malformed: the file isn't what it was taken for (a JSON array read line by
    line, say), and an empty result would hide it. ``most_bad``: the share of malformed records
    beyond which an input is refused as well."""
    if rows and rows == bad:
        raise UnreadableInputError(f"{name}: none of {rows} records fits the schema (a JSON array needs multi-line reading)")
    if bad > most_bad * rows:
        raise UnreadableInputError(f"{name}: {bad} of {rows} records don't fit the schema, more than {most_bad:.2%}")


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """A published table, whole: that of the run that ``sinks.Publication`` committed last, or
    a plain folder. Several tables of one run: ``sinks.Snapshot``."""
    return spark.read.format(fmt).options(**options).load(committed_path(spark, path))


def read_optional(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet") -> DataFrame | None:
    """A table that may not exist yet; absent means None, and a warning in the log."""
    try:
        return spark.read.schema(schema).format(fmt).load(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        log.warning("no table at %s", path)
        return None
