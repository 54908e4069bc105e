"""Scratch space comes from the session's spark.checkpoint.dir."""

import pytest

from flotilla.session import (
    PARTITION_BYTES, apply_runtime_defaults, checkpoint_root, input_bytes, scratch_path, shuffle_width,
)


def test_checkpoint_root_is_read_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert checkpoint_root(spark) == configured.rstrip("/")


def test_without_a_shared_folder_it_fails():
    from types import SimpleNamespace
    none = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: default))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(none)


def test_no_machine_local_folder_in_the_library():
    import pathlib
    root = pathlib.Path(__file__).resolve().parent.parent
    found = [p for d in ("flotilla", "jobs") for p in (root / d).rglob("*.py")
             if "llm" not in p.parts and ("/tmp" in p.read_text() or "tempfile" in p.read_text())]
    assert not found


def test_defaults_reach_a_session_someone_else_built(spark):
    apply_runtime_defaults(spark)
    assert "RocksDB" in spark.conf.get("spark.sql.streaming.stateStore.providerClass")


def test_shuffle_width_follows_the_input(spark, tmp_dir):
    spark.range(1000).write.parquet(f"{tmp_dir}/x")
    assert input_bytes(spark, f"{tmp_dir}/x", f"{tmp_dir}/none") > 1000
    assert shuffle_width(0) == 8 and shuffle_width(10 * PARTITION_BYTES + 1) == 11
    assert shuffle_width(100 * 10**12) > 700_000


def test_scratch_paths_live_under_it_and_are_fresh(spark):
    root = checkpoint_root(spark)
    a, b = scratch_path(spark, "queries", "x"), scratch_path(spark, "queries", "x")
    assert a.startswith(root + "/flotilla/queries/x-") and b.startswith(root + "/flotilla/queries/x-")
    assert a != b
    assert scratch_path(spark, "fixed", unique=False) == root + "/flotilla/fixed"
