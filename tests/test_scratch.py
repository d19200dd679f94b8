"""Scratch folders and their scopes."""

import os

from tickerloom.session import scratch_dir, scratch_scope, written_once


def test_scope_deletes_what_was_handed_out_inside(spark):
    outside = written_once(spark.range(3))
    with scratch_scope(spark):
        inside = written_once(spark.range(5))
        kept = scratch_dir(spark)
        with scratch_scope(spark):
            written_once(inside.selectExpr("id + 1 AS id")).write.parquet(kept)
            scratch_dir(spark)  # handed out but never written
        assert spark.read.parquet(kept).count() == inside.count() == 5
        folders = inside.inputFiles()
    assert not os.path.exists(kept) and not any(os.path.exists(f.removeprefix("file://")) for f in folders)
    assert outside.count() == 3


def test_scope_deletes_after_a_failure(spark):
    folders = []
    try:
        with scratch_scope(spark):
            folders.append(scratch_dir(spark))
            spark.range(2).write.parquet(folders[0])
            raise RuntimeError("stage failed")
    except RuntimeError:
        pass
    assert not os.path.exists(folders[0])
