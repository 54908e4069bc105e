"""Readers (S1-S8): batch files with explicit schemas, published tables, event streams."""

from flotilla.sources.files import (  # noqa: F401
    BAD, UnreadableInputError, read_deliveries, read_gps, read_incidents, read_log, read_optional, read_table,
    read_vehicles, refuse_if_nothing_fits,
)
from flotilla.sources.stream import file_records, kafka_options, kafka_records, table_stream  # noqa: F401
from flotilla.sources.landing import land, read_landed  # noqa: F401
