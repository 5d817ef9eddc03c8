from __future__ import annotations

from collections import defaultdict

import pytest
from compare import rows
from pyspark.sql import functions as F

from huntlake.operators import hunts

COLUMNS = (
    "common_name subject issuer subject_alternative_names sha1_fingerprint rdns src_ip dest_ip country "
    "not_valid_before not_valid_after sslbl_SHA1 sslbl_Listingreason"
).split()


def certificates(spark, *certs):
    return spark.createDataFrame(
        [tuple(cert.get(name) for name in COLUMNS) for cert in certs], ", ".join(f"`{c}` string" for c in COLUMNS)
    )


@pytest.fixture
def skewed(spark):
    """3,000 certificates, a third of them of one issuer, each of those with its own fingerprint and subject."""
    return spark.range(0, 3000, 1, 4).selectExpr(
        "case when id % 3 = 0 then 'hot' when id % 3 = 1 then concat('i', id % 50) end as issuer",
        "concat('s', id) as subject",
        "case when id % 2 = 0 then concat('cn', id % 5) end as common_name",
        "cast(null as string) as rdns",
        "sha1(cast(id as string)) as sha1_fingerprint",
        "concat('10.0.0.', id % 7) as src_ip",
        "concat('10.0.1.', id % 300) as dest_ip",
    )


def expected_sets(certs):
    sets = defaultdict(lambda: {name: set() for name in hunts.ISSUER_SETS})
    for cert in certs.collect():
        if cert["issuer"] is not None:
            for name in hunts.ISSUER_SETS:
                sets[cert["issuer"]][name] |= {cert[name]} - {None}
    return dict(sets)


def test_unique_issuers_hold_every_value_once(skewed):
    found = hunts.unique_issuers(skewed).collect()
    gathered = defaultdict(lambda: {name: [] for name in hunts.ISSUER_SETS})
    for row in found:
        assert row["count"] == 1
        if row["value"] is not None:
            gathered[row["issuer"]][row["field"]].append(row["value"])
    expected = expected_sets(skewed)
    assert set(gathered) == set(expected)
    for issuer, sets in expected.items():
        assert {name: sorted(values) for name, values in gathered[issuer].items()} == {n: sorted(v) for n, v in sets.items()}


@pytest.mark.parametrize("values", [3, 30_000])
def test_one_shape_at_every_size(spark, values):
    certs = spark.range(values).selectExpr(
        "'one' as issuer", "concat('s', id) as subject", *(f"'x' as {name}" for name in hunts.ISSUER_SETS[1:])
    )
    found = hunts.unique_issuers(certs)
    assert found.columns == ["issuer", "field", "value", "count"]
    assert found.count() == values + len(hunts.ISSUER_SETS) - 1
    assert found.groupBy("issuer", "field", "value").count().filter("count > 1").isEmpty()
    (row,) = hunts.issuer_counts(certs).collect()
    assert row.asDict() == {"issuer": "one", "subject": values, "count": 1} | {name: 1 for name in hunts.ISSUER_SETS[1:]}


def test_unique_issuers_take_one_shuffle_and_one_scan(skewed, tmp_path, plan):
    skewed.write.parquet(str(tmp_path / "certs"))
    text = plan(hunts.unique_issuers(skewed.sparkSession.read.parquet(str(tmp_path / "certs"))))
    assert text.count("Exchange") == 1 and text.count("FileScan") == 1 and "Join" not in text


def test_issuer_counts(skewed):
    expected = {issuer: {name: len(v) for name, v in sets.items()} for issuer, sets in expected_sets(skewed).items()}
    found = {r["issuer"]: {name: r[name] for name in hunts.ISSUER_SETS} for r in hunts.issuer_counts(skewed).collect()}
    assert found == expected


def test_issuer_without_any_value_is_kept(spark):
    certs = certificates(spark, {"issuer": "bare"}, {"subject": "no issuer"})
    assert {(r["issuer"], r["value"]) for r in hunts.unique_issuers(certs).collect()} == {("bare", None)}
    (row,) = hunts.issuer_counts(certs).collect()
    assert row["issuer"] == "bare" and all(row[name] == 0 for name in hunts.ISSUER_SETS)


def test_single_subject_issuers(spark):
    certs = certificates(
        spark,
        {"issuer": "one", "subject": "s"},
        {"issuer": "one", "subject": "s"},
        {"issuer": "one", "subject": None},
        {"issuer": "two", "subject": "s"},
        {"issuer": "two", "subject": "t"},
        {"issuer": "none", "subject": None},
        {"issuer": None, "subject": "s"},
    )
    assert rows(hunts.single_subject_issuers(certs)) == [("one", "s", 2)]


def test_short_issuers_in_order(spark):
    certs = certificates(
        spark,
        {"issuer": "x" * 14, "common_name": "a", "sha1_fingerprint": "2"},
        {"issuer": "x" * 15, "common_name": "a"},
        {"issuer": "<Name()>", "common_name": "a"},
        {"issuer": "short", "common_name": "apiserver"},
        {"issuer": "short", "common_name": None},
        {"issuer": None, "common_name": "a"},
        {"issuer": "", "common_name": "b", "sha1_fingerprint": "1"},
        {"issuer": "日本", "common_name": "c", "sha1_fingerprint": "3"},
    )
    found = hunts.short_issuers(certs)
    assert found.columns == [*hunts.NAME_COLUMNS, "length"]
    assert [r["length"] for r in found.collect()] == [0, 2, 14]


def test_blacklisted(spark):
    certs = certificates(
        spark,
        {"sslbl_SHA1": "f", "sslbl_Listingreason": "C&C", "country": "ZZ"},
        {"sslbl_SHA1": "null"},
        {"sslbl_SHA1": None},
    )
    found = hunts.blacklisted(certs)
    assert found.columns == list(hunts.LISTED_COLUMNS)
    assert [r["sslbl_Listingreason"] for r in found.collect()] == ["C&C"]


def test_high_entropy_names_in_order(spark, plan):
    certs = certificates(
        spark,
        {"subject": "short", "common_name": "abcdefgh"},
        {"subject": "short", "common_name": "abc"},
        {"subject": "short", "common_name": "ab"},
        {"subject": "short", "common_name": ""},
        {"subject": "short", "common_name": None},
        {"subject": "x" * 15, "common_name": "abcdefgh"},
        {"subject": None, "common_name": "abcdefgh"},
        {"subject": "short", "common_name": "abcd"},
    )
    found = hunts.high_entropy_names(certs)
    assert "Python" not in plan(found)
    assert plan(found).count("regexp_extract_all") == 1, "the score is computed once per row"
    assert found.columns == [*hunts.NAME_COLUMNS, "entropy_score"]
    assert [(r["common_name"], round(r["entropy_score"], 3)) for r in found.collect()] == [
        ("abcdefgh", 3.0),
        ("abcd", 2.0),
        ("abc", 1.585),
    ]


@pytest.mark.parametrize("hunt", [hunts.short_issuers, hunts.high_entropy_names])
def test_equal_leading_values_are_split_in_the_sort(spark, hunt, settings):
    """One certificate seen from many addresses still fills several sort partitions."""
    settings(spark__sql__adaptive__coalescePartitions__enabled="false")
    seen = spark.range(0, 8000, 1, 4).select(
        *(
            F.concat(F.lit("10.0.0."), "id").alias(name) if name == "src_ip" else F.lit("abcd").alias(name)
            for name in COLUMNS
        )
    )
    sizes = hunt(seen).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 8 and sum(r["count"] for r in sizes) == 8000
    assert max(r["count"] for r in sizes) < 4000
