from __future__ import annotations

import pytest
from compare import rows

from huntlake.plans.certificates import certificates_silver
from huntlake.plans.refresh import Lookups, changed_keys, refresh_silver_table, refreshed_silver, touched
from huntlake.sinks.tables import append_table

CERT = "id int, sha1_fingerprint string, common_name string, day string"
LISTED = "sslbl_SHA1 string, sslbl_Listingreason string"


def lookups(spark, listed, hosts):
    return Lookups(spark.createDataFrame(listed, LISTED), spark.createDataFrame([(h,) for h in hosts], "alexa_top_host string"))


def certificates(spark, ids):
    """Fingerprints and hosts that repeat, NULLs in both, and days of which one is NULL and one empty."""
    made = [
        (i, None if i % 11 == 0 else f"f{i % 7}", None if i % 13 == 0 else f"h{i % 5}", (None, "", "d 1", "d/2", "d%3")[i % 9 % 5])
        for i in ids
    ]
    return spark.createDataFrame(made, CERT)


@pytest.fixture
def states(spark):
    return [
        lookups(spark, [("f1", "a"), ("f1", "a"), ("f2", "b"), (None, "n")], ["h1", "h1", None]),
        lookups(spark, [("f1", "a"), ("f2", "b"), ("f3", "c"), ("f3", "c"), (None, "m")], ["h1", None]),
        lookups(spark, [("f3", "c"), ("f3", "c"), ("f2", "b2"), ("f9", "x")], ["h2", "h3", "h99", None, None]),
        lookups(spark, [], []),
    ]


def test_three_changes_equal_a_full_rebuild(spark, states):
    certs, start = certificates(spark, range(60)), states[0]
    silver = certificates_silver(certs, *start)
    for at, state in enumerate(states[1:]):
        arrived = certificates(spark, range(60 + 20 * at, 60 + 20 * (at + 1) if at < 2 else 60 + 20 * at))
        silver = refreshed_silver(silver, certs, arrived, start, state)
        certs, start = certs.union(arrived), state
        assert rows(silver) == rows(certificates_silver(certs, *state))
    assert silver.count() == certs.count() == 100


def test_only_what_a_change_touches_is_made_anew(spark, states):
    changes = changed_keys(states[0], states[1])
    assert rows(changes.hosts) == [] and rows(changes.fingerprints) == [("f1",), ("f3",)]
    found = touched(certificates(spark, range(60)), changes)
    assert {row["sha1_fingerprint"] for row in found.collect()} == {"f1", "f3"}
    same = changed_keys(states[2], states[2])
    assert same.hosts.count() == same.fingerprints.count() == 0


@pytest.mark.parametrize("managed", [True, False])
def test_partitions_that_a_change_touches_are_switched(spark, states, tmp_path, managed):
    name = f"unit.refreshed_{managed}"
    spark.sql(f"drop table if exists {name}")
    certs, start = certificates(spark, range(60)), states[0]
    path = None if managed else str(tmp_path / "silver")
    append_table(certificates_silver(certs, *start), name, "silver", ["day"], path=path)
    columns = spark.table(name).columns

    def holds(expected):
        as_read = expected.selectExpr(*(f"nullif(day, '') as {c}" if c == "day" else c for c in columns))
        return rows(spark.table(name)) == rows(as_read)

    for at, state in enumerate(states[1:]):
        arrived = certificates(spark, [100 + at] if at < 2 else [])
        for _ in range(2):  # a call may be repeated
            assert refresh_silver_table(spark, name, certs, arrived, start, state) > 0
            assert holds(certificates_silver(certs.union(arrived), *state))
        certs, start = certs.union(arrived), state
    assert refresh_silver_table(spark, name, certs, certificates(spark, []), start, start) == 0
    one = certificates(spark, [3]).selectExpr("id", "'new' as sha1_fingerprint", "'h50' as common_name", "'d new' as day")
    assert refresh_silver_table(spark, name, certs, one, start, start) == 1
    assert holds(certificates_silver(certs.union(one), *start))
    gone = lookups(spark, [], ["h50"])
    assert refresh_silver_table(spark, name, certs.union(one), certificates(spark, []), start, gone) == 1
    assert holds(certificates_silver(certs, *start))
    append_table(certificates_silver(one, *start), name, "silver", ["day"], path=path)
    assert holds(certificates_silver(certs.union(one), *start))


def test_a_table_without_partitions_is_refused(spark, states, tmp_path):
    spark.sql("drop table if exists unit.refreshed_whole")
    certs = certificates(spark, range(9))
    append_table(certificates_silver(certs, *states[0]), "unit.refreshed_whole", "silver", path=str(tmp_path / "w"))
    with pytest.raises(ValueError, match="no partitions"):
        refresh_silver_table(spark, "unit.refreshed_whole", certs, certs.limit(0), *states[:2])
