import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from flotilla.session import SESSION_DEFAULTS
    b = SparkSession.builder.master("local[4]").appName("flotilla-tests")
    for k, v in SESSION_DEFAULTS.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", "4")
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    # Tests set their own checkpoint folder only where the session names none.
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="flotilla-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="flotilla-test-")
