"""Writers: batch tables (O1-O3, O7), stream feeds and replaceable summaries."""

from flotilla.sinks.publication import Publication, Snapshot  # noqa: F401
from flotilla.sinks.tables import publish, publish_counted, publish_observed, write_csv, write_json, write_topic  # noqa: F401
from flotilla.sinks.stream import (  # noqa: F401
    append_feed, console_feed, read_latest, replace_table, topic_feed,
)
