"""Dashboard data job: headline KPIs and chart series from the published tables.

    spark-submit jobs/dashboard_job.py --published <batch output folder> --output <folder>
"""

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from flotilla.plans.batch import run_dashboard  # noqa: E402
from flotilla.session import build_session  # noqa: E402


def main(argv=None):
    ap = argparse.ArgumentParser()
    ap.add_argument("--published", required=True)
    ap.add_argument("--output", required=True)
    ap.add_argument("--master", default=None)
    a = ap.parse_args(argv)
    spark = build_session(a.master, app_name="flotilla-dashboard")
    run_dashboard(spark, a.published, a.output)
    spark.stop()


if __name__ == "__main__":
    main()
