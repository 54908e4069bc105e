"""A set of tables that is published as one (O1): staged, checked, then named by one note.

A run writes its tables to a folder of its own, ``run=<id>``. Only when all are written and
checked does the note ``_publicado`` name that folder, by an atomic rename. A run that fails
before takes its folder away and leaves what was published as it was. Readers go by the note
(``sources.read_table``, ``Snapshot``), so they see the tables of one run, never of two. The run
before stays until the next commit, for readers that began with it.
"""

from __future__ import annotations

import datetime as dt
import logging
import uuid

from pyspark.sql import DataFrame, SparkSession

from flotilla.notes import committed_run, read_note, remove, write_note
from flotilla.notes import COMMITTED as NOTE

log = logging.getLogger(__name__)


class Publication:
    """``with Publication(spark, root) as run: ... run.path(name) ...``: commits at the end of the
    block, or takes back what it wrote if the block fails. Two at once don't disturb each other:
    the one that ends last is what is published."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.run = f"run={dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"

    def path(self, name: str) -> str:
        return f"{self.root}/{self.run}/{name}"

    def commit(self) -> None:
        before = read_note(self.spark, f"{self.root}/{NOTE}") or {}
        write_note(self.spark, f"{self.root}/{NOTE}", {"run": self.run, "previous": before.get("run")})
        if before.get("previous"):
            remove(self.spark, f"{self.root}/{before['previous']}")

    def __enter__(self) -> "Publication":
        return self

    def __exit__(self, failure, *_) -> None:
        if failure is None:
            self.commit()
            return
        try:
            remove(self.spark, f"{self.root}/{self.run}")
        except Exception:               # the first failure is the one to report
            log.exception("%s/%s could not be removed", self.root, self.run)


class Snapshot:
    """The tables of the run that is published now, also when another one is committed meanwhile.
    A root without a note is taken as plain folders."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.run = committed_run(spark, self.root)

    def path(self, name: str) -> str:
        return f"{self.root}/{self.run}/{name}" if self.run else f"{self.root}/{name}"

    def table(self, name: str, fmt: str = "parquet", **options) -> DataFrame:
        return self.spark.read.format(fmt).options(**options).load(self.path(name))
