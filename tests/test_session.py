from __future__ import annotations

import os

import pytest

from subscore.session import folders_made, remove_folders, shared_folder, ship_package


def test_folders_are_known_and_removable(spark):
    folder = shared_folder(spark, "test")
    assert folders_made(spark)[-1] == folder
    spark.range(3).write.parquet(f"{folder}/rows")
    unused = shared_folder(spark, "unused")
    remove_folders(spark, [folder, unused])
    assert folder not in folders_made(spark) and unused not in folders_made(spark)
    assert not os.path.exists(folder.removeprefix("file:"))
    with pytest.raises(ValueError):
        remove_folders(spark, [folder])
    ship_package(spark)
    ship_package(spark)
    assert not any("subscore-package-" in f for f in folders_made(spark))
