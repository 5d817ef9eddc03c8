from __future__ import annotations

import huntlake
from huntlake.settings import GIB, cluster_settings


def test_partitions_follow_the_shuffle_size():
    assert cluster_settings(1 * GIB)["spark.sql.shuffle.partitions"] == "200"
    assert cluster_settings(10_000 * GIB)["spark.sql.shuffle.partitions"] == "40000"


def test_settings_are_accepted(spark, settings):
    settings(**{key.replace(".", "__"): value for key, value in cluster_settings(GIB).items()})


def test_public_names_exist():
    assert all(hasattr(huntlake, name) for name in huntlake.__all__)
