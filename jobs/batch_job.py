"""Batch ETL job: read the five inputs, clean, roll up, report, publish.

    spark-submit jobs/batch_job.py --input <folder> --output <folder> [--multiline-json]
        [--report-time "2025-01-31 00:00:00"] [--shuffle-partitions N]

Inputs in ``--input``: vehiculos.csv, entregas.csv, gps_registros.json, incidencias.json,
eventos_sistema.log. Outputs: one Parquet folder per published table plus the report CSV, the
KPI summary JSON and a stage-count table (``calidad``), all in a folder ``run=<id>`` that the
note ``_publicado`` names once the run is complete and checked; a failed run changes nothing.
"""

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from flotilla.plans.batch import read_driver_inputs, read_inputs, run_batch  # noqa: E402
from flotilla.session import build_session, input_bytes, scratch_path, shuffle_width  # noqa: E402


def main(argv=None):
    ap = argparse.ArgumentParser()
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--input", help="folder with the five fleet input files")
    src.add_argument("--driver-tables", help="a folder of driver tables standing in for them")
    ap.add_argument("--output", required=True)
    ap.add_argument("--multiline-json", action="store_true",
                    help="GPS/incident files are pretty-printed JSON arrays")
    ap.add_argument("--report-time", default=None, help="fixed report stamp (default: now)")
    ap.add_argument("--partition-by-day", action="store_true",
                    help="partition the cleaned fact tables by event day")
    ap.add_argument("--most-malformed", type=float, default=1.0,
                    help="share of malformed records beyond which an input stops the run")
    ap.add_argument("--shuffle-partitions", type=int, default=None,
                    help="default: one for each 128 MB of input")
    ap.add_argument("--master", default=None)
    a = ap.parse_args(argv)
    spark = build_session(a.master, app_name="flotilla-batch", shuffle_partitions=a.shuffle_partitions)
    if not a.shuffle_partitions:
        width = shuffle_width(input_bytes(spark, a.driver_tables or a.input))
        spark.conf.set("spark.sql.shuffle.partitions", str(width))
    if a.driver_tables:
        raw = read_driver_inputs(spark, a.driver_tables)
    else:
        landing = scratch_path(spark, "landing") if a.multiline_json else None
        raw = read_inputs(spark, a.input, multi_line_json=a.multiline_json, landing=landing)
    counts = run_batch(spark, raw, a.output, report_time=a.report_time,
                       partition_by_day=a.partition_by_day, most_bad=a.most_malformed)
    counts.show(truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
