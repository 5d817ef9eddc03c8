from __future__ import annotations

import pytest
from compare import rows

from huntlake.operators.enrich import (
    broadcast_if_small,
    clean_blacklist,
    clean_top_hosts,
    enrich_blacklist,
    enrich_top_hosts,
    exclude_top_hosts,
)
from huntlake.plans.certificates import certificates_silver

SHUFFLE_JOIN = {"spark__sql__autoBroadcastJoinThreshold": "-1"}


@pytest.fixture
def certs(spark):
    data = [("f1", "a.org"), ("f2", "b.org"), ("f1", None), (None, "c.org")]
    return spark.createDataFrame(data, "sha1_fingerprint string, common_name string")


@pytest.fixture
def blacklist(spark):
    return clean_blacklist(
        spark.createDataFrame([("f1", "r1"), ("f1", "r2"), (None, "r3")], "SHA1 string, Listingreason string")
    )


@pytest.fixture
def hosts(spark):
    return clean_top_hosts(
        spark.createDataFrame(
            [(1, "b.org"), (2, "b.org"), (3, "localhost"), (4, "my.localhost.net"), (5, None)],
            "RecordNumber int, alexa_top_host string",
        )
    )


def test_clean_hosts_drops_local_and_null(hosts):
    assert rows(hosts) == [("b.org",), ("b.org",)]


def test_blacklist_repeats_certificates_listed_twice(certs, blacklist):
    found = enrich_blacklist(certs, blacklist)
    assert found.columns == ["sha1_fingerprint", "common_name", "sslbl_SHA1", "sslbl_Listingreason"]
    assert rows(found) == [
        (None, "c.org", None, None),
        ("f1", None, "f1", "r1"),
        ("f1", None, "f1", "r2"),
        ("f1", "a.org", "f1", "r1"),
        ("f1", "a.org", "f1", "r2"),
        ("f2", "b.org", None, None),
    ]


def test_top_hosts_join(certs, hosts):
    assert [r[2] for r in rows(enrich_top_hosts(certs, hosts))] == [None, None, None, "b.org", "b.org"]


def test_exclusion_equals_left_join_and_null_test(certs, hosts):
    joined = enrich_top_hosts(certs, hosts).filter("alexa_top_host is null").drop("alexa_top_host")
    assert rows(exclude_top_hosts(certs, hosts)) == rows(joined)
    assert rows(joined) == [(None, "c.org"), ("f1", None), ("f1", "a.org")]


def test_silver_plan_uses_an_anti_join(certs, blacklist, hosts, plan):
    assert "LeftAnti" in plan(certificates_silver(certs, blacklist, hosts))


def test_broadcast_only_up_to_the_measured_limit(certs, hosts, settings, plan):
    settings(**SHUFFLE_JOIN)
    assert "BroadcastHashJoin" in plan(exclude_top_hosts(certs, broadcast_if_small(hosts, 1000)))
    assert "SortMergeJoin" in plan(exclude_top_hosts(certs, broadcast_if_small(hosts, 50)))
    assert "SortMergeJoin" in plan(exclude_top_hosts(certs, hosts))


def test_nested_or_empty_lookup(spark):
    nested = spark.sql("select array(1) as a")
    assert broadcast_if_small(nested, 1 << 30) is nested
    assert broadcast_if_small(spark.range(0), 0).count() == 0


@pytest.mark.parametrize("key", ["'hot'", "cast(null as string)"])
def test_hot_keys_are_split_without_broadcast(spark, settings, plan, key):
    """A third of the certificates share one key; the shuffled join splits that partition."""
    settings(
        **SHUFFLE_JOIN,
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="64KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )
    certs = spark.range(0, 60_000, 1, 8).selectExpr(
        f"case when id % 3 = 0 then {key} else concat('n', id) end as common_name",
        f"case when id % 3 = 0 then {key} else concat('f', id) end as sha1_fingerprint",
        "sha2(cast(id as string), 512) as subject",
    )
    hosts = spark.range(0, 100).selectExpr("concat('n', id) as alexa_top_host")
    listed = spark.sql("select 'hot' as sslbl_SHA1, 'r' as sslbl_Listingreason")
    expected = 60_000 - sum(1 for i in range(100) if i % 3)

    kept = exclude_top_hosts(certs, hosts)
    assert len(kept.collect()) == expected
    assert "skew=true" in plan(kept)

    silver = certificates_silver(certs, listed, hosts)
    assert len(silver.collect()) == expected
    assert "SortMergeJoin(skew=true)" in plan(silver)
