"""Intermediate tables of a run lie in one folder that goes with it."""

from __future__ import annotations

import pytest

from clickmart.session import drop_tables, intermediate_tables, materialise, shared_dir
from clickmart.sources.commits import Folder


def test_folder_of_a_run(spark):
    shared = Folder(spark, shared_dir(spark))
    with intermediate_tables(spark) as path:
        df = materialise(spark.range(5), "numbers")
        name = path.rpartition("/")[2]
        assert df.count() == 5 and len(shared.names(name)) == 1
    assert not shared.exists(name)
    with pytest.raises(ZeroDivisionError), intermediate_tables(spark, "failed"):
        materialise(spark.range(5), "numbers")
        raise ZeroDivisionError
    assert not shared.exists("run-failed")


def test_folder_that_is_kept(spark):
    with intermediate_tables(spark, "kept", keep=True) as path:
        df = materialise(spark.range(5), "numbers")
    assert df.count() == 5  # read after the block
    drop_tables(spark, path)
    assert not Folder(spark, shared_dir(spark)).exists("run-kept")
    with pytest.raises(ValueError):
        drop_tables(spark, shared_dir(spark) + "/other")
    # outside of a block, tables lie in the shared folder itself
    assert shared_dir(spark) in materialise(spark.range(1), "alone").inputFiles()[0]
