"""Stream job: topic records → event feed, alert feed, window summaries.

    spark-submit --packages org.apache.spark:spark-sql-kafka-0-10_2.13:<spark version> \
        jobs/stream_job.py --kafka host:9092 --topic <topic> --output <folder> --shuffle-partitions N
    spark-submit jobs/stream_job.py --records <folder of key/value/timestamp files> --output <folder> \
        --shuffle-partitions N

Each sink is a named query with its own checkpoint under ``--checkpoint`` (default:
``_checkpoints`` in the output folder, the same after a restart), so a restart resumes offsets
and window state. An output folder goes on with the checkpoint that wrote it and refuses others.
``--shuffle-partitions`` is fixed for a checkpoint's life by the first start, so it has to be
named: about the number of cores, times what the state should grow. ``calidad_streaming`` in the
output folder has the records read, malformed and too late, by query (``streaming.quality``). The job waits until any
query stops (``awaitAnyTermination``).
"""

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from flotilla.session import build_session  # noqa: E402
from flotilla.sources import file_records, kafka_records  # noqa: E402
from flotilla.streaming import build_plan, start_plan  # noqa: E402
from flotilla.streaming.quality import StreamQuality  # noqa: E402


def wait(spark) -> None:
    """Until a query stops; if it failed, its error is raised."""
    spark.streams.awaitAnyTermination()


def main(argv=None):
    ap = argparse.ArgumentParser()
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--kafka")
    src.add_argument("--records")
    src.add_argument("--driver-events", help="a folder of driver tables: its events as the stream")
    ap.add_argument("--topic", required=False, default=None, help="topic to subscribe to (with --kafka)")
    ap.add_argument("--output", required=True)
    ap.add_argument("--checkpoint", default=None)
    ap.add_argument("--starting-offsets", default="earliest")
    ap.add_argument("--max-offsets", type=int, default=None, help="records per micro-batch (Kafka)")
    ap.add_argument("--max-files", type=int, default=None, help="files per micro-batch (file sources)")
    ap.add_argument("--available-now", action="store_true", help="drain what exists, then stop")
    ap.add_argument("--processing-time-alerts", action="store_true",
                    help="window alerts on processing time instead of event time")
    ap.add_argument("--console", action="store_true")
    ap.add_argument("--shared-feeds", action="store_true",
                    help="write the event and alert feeds from one scan (foreachBatch)")
    ap.add_argument("--latest", action="store_true",
                    help="also keep a summary of open windows, brought up to date per batch")
    ap.add_argument("--no-daily-counts", action="store_true",
                    help="don't keep events per day and kind (the dashboard then reads the whole feed)")
    ap.add_argument("--allow-data-loss", action="store_true",
                    help="go on when offsets have expired unread (Kafka's failOnDataLoss=false)")
    ap.add_argument("--shuffle-partitions", type=int, required=True)
    ap.add_argument("--master", default=None)
    a = ap.parse_args(argv)
    if a.kafka and not a.topic:
        ap.error("--topic is required with --kafka")
    spark = build_session(a.master, app_name="flotilla-stream", shuffle_partitions=a.shuffle_partitions)
    spark.conf.set("spark.sql.shuffle.partitions", str(a.shuffle_partitions))   # of a session that was there
    ck = a.checkpoint or f"{a.output.rstrip('/')}/_checkpoints"
    if a.kafka:
        records = kafka_records(spark, a.kafka, a.topic, starting_offsets=a.starting_offsets,
                                max_offsets=a.max_offsets, fail_on_data_loss=not a.allow_data_loss)
    elif a.driver_events:
        from flotilla.plans.queries import driver_records
        records = driver_records(spark, a.driver_events, max_files=a.max_files)
    else:
        records = file_records(spark, a.records, max_files=a.max_files)
    plan = build_plan(records, alert_time="procesado_en" if a.processing_time_alerts else "kafka_timestamp")
    trig = "availableNow" if a.available_now else None
    queries = start_plan(plan, a.output, ck,
                         feed_trigger=trig or "10 seconds", summary_trigger=trig or "30 seconds",
                         latest=a.latest, console=a.console, shared_feeds=a.shared_feeds,
                         daily=not a.no_daily_counts)
    quality = StreamQuality(spark, f"{a.output.rstrip('/')}/calidad_streaming", queries)
    spark.streams.addListener(quality)
    try:
        if a.available_now:
            for q in queries:
                q.awaitTermination()
        else:
            wait(spark)
    finally:
        quality.catch_up(queries)       # also what came before the listener was there
        spark.streams.removeListener(quality)


if __name__ == "__main__":
    main()
    from pyspark.sql import SparkSession
    session = SparkSession.getActiveSession()
    if session is not None:   # stop cleanly once the queries are done (or one has failed)
        session.stop()
