"""Written intermediate tables."""

import os
from types import SimpleNamespace

import pytest

from tickloom.plans.scratch import forget, shared_folder, stored


def test_stored_tables_are_read_again_and_deleted(spark):
    table = stored(spark.range(5))
    assert table.count() == 5
    forget(table)
    assert not os.path.exists(table._stored_at.removeprefix("file:"))


def test_cluster_needs_a_shared_folder():
    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    session = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda name, other: None))
    with pytest.raises(ValueError, match="checkpoint"):
        shared_folder(session)
