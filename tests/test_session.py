"""Shared-folder and parallelism helpers."""

import os

from gridspark.session import scratch_path, shared_dir, size_in_bytes


def test_shared_dir_from_session(spark):
    d = shared_dir(spark)
    assert d and spark.sparkContext.getCheckpointDir() is not None
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(d)


def test_workers_import_the_package_from_any_folder(tmp_path):
    """A driver started elsewhere, without PYTHONPATH: tasks still import the package."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys
sys.path.insert(0, {root!r})
from gridspark.session import local_session
spark = local_session(1)

def where(batches):
    import gridspark.sources.netcdf as m
    for b in batches:
        yield b

print("ROWS", spark.range(3).mapInArrow(where, "id long").count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240)
    assert "ROWS 3" in out.stdout, out.stderr[-2000:]


def test_size_settings():
    assert size_in_bytes("10485760b") == 10485760 and size_in_bytes("128m") == 128 << 20
    assert size_in_bytes("-1") == -1


def test_scratch_folders_of_a_run_are_dropped(spark):
    from gridspark.session import drop_scratch, scratch_mark, scratch_path

    before = scratch_path(spark, "other")
    mark = scratch_mark(spark)
    paths = [scratch_path(spark, "run") for _ in range(3)]
    for p in [before, *paths]:
        spark.range(1).write.parquet(p)
    assert drop_scratch(spark, mark, keep=1) == 2
    assert [spark.read.parquet(p).count() for p in (before, paths[2])] == [1, 1]
    for p in paths[:2]:
        assert not os.path.exists(p.removeprefix("file:"))
    assert drop_scratch(spark, mark, keep=1) == 0


def test_shuffles_are_sized_from_the_input(spark, monkeypatch):
    from gridspark import session

    path = session.scratch_path(spark, "sized")
    spark.range(100_000).write.parquet(path)
    was = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        session.size_shuffles(spark, path)
        assert spark.conf.get("spark.sql.shuffle.partitions") == was
        monkeypatch.setattr(session, "PARTITION_BYTES", 10_000)
        session.size_shuffles(spark, path, path)
        assert int(spark.conf.get("spark.sql.shuffle.partitions")) > int(was)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
