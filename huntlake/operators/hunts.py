"""Hunts over the enriched certificate table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from huntlake.functions.entropy import shannon_entropy
from huntlake.functions.names import field
from huntlake.functions.once import once

# Projections, markers and thresholds of the hunts.
ISSUER_SETS = ("subject", "common_name", "rdns", "sha1_fingerprint", "src_ip", "dest_ip")
NAME_COLUMNS = ("common_name", "subject", "issuer", "subject_alternative_names", "sha1_fingerprint")
LISTED_COLUMNS = (
    "sslbl_Listingreason",
    "common_name",
    "country",
    "dest_ip",
    "rdns",
    "issuer",
    "sha1_fingerprint",
    "not_valid_before",
    "not_valid_after",
)
EMPTY_NAME = "<Name()>"
CLUSTER_NAME = "apiserver"
NULL_TEXT = "null"
SHORT_NAME = 15
HIGH_ENTROPY = 1.5

# One certificate is seen between many address pairs; these split its equal rows in a sort.
OBSERVATION = ("src_ip", "dest_ip")


def issuer_values(certs: DataFrame) -> DataFrame:
    """Distinct ``(issuer, field, value)`` over the six fields of interest.

    It is grouped by all three columns,
    so an issuer with a large share of all certificates is spread over many
    tasks, and copies are removed before the shuffle. A NULL value stands for
    "some certificate lacks the field".
    """
    pairs = [part for name in ISSUER_SETS for part in (F.lit(name), F.col(name))]
    return (
        certs.filter(F.col("issuer").isNotNull())
        .select("issuer", F.stack(F.lit(len(ISSUER_SETS)), *pairs).alias("field", "value"))
        .distinct()
    )


def unique_issuers(certs: DataFrame) -> DataFrame:
    """Every distinct ``(issuer, field, value)`` of the six fields, with ``count`` = 1.

    The sets of an issuer are rows and not arrays, so the answer has one shape
    at every size, and an issuer of any size is in no single task or row.
    ``count`` is the number of distinct issuers in an issuer's group, so only
    the NULL issuer is left out, and any row order is sorted by it.
    """
    return issuer_values(certs).withColumn("count", F.lit(1).cast("bigint"))


def issuer_counts(certs: DataFrame) -> DataFrame:
    """One row per issuer: how many distinct values each of the six fields has, and ``count`` = 1.

    NULL is no value. The values of a large issuer are made distinct and counted
    in many tasks before its few partial counts meet.
    """
    return issuer_values(certs).groupBy("issuer").agg(
        *(F.count(F.when(F.col("field") == name, F.col("value"))).alias(name) for name in ISSUER_SETS),
        F.lit(1).cast("bigint").alias("count"),
    )


def single_subject_issuers(certs: DataFrame) -> DataFrame:
    """Issuers all of whose certificates carry one and the same subject, with their number.

    Certificates without a subject are ignored. The first grouping is by issuer
    and subject, so a large issuer is reduced before its rows meet.
    """
    pairs = (
        certs.filter(F.col("issuer").isNotNull() & F.col("subject").isNotNull())
        .groupBy("issuer", "subject")
        .agg(F.count("*").alias("certificates"))
    )
    return (
        pairs.groupBy("issuer")
        .agg(
            F.count("*").alias("subjects"),
            F.min("subject").alias("subject"),
            F.sum("certificates").alias("certificates"),
        )
        .filter(F.col("subjects") == 1)
        .select("issuer", "subject", "certificates")
    )


def short_issuers(certs: DataFrame, below: int = SHORT_NAME) -> DataFrame:
    """Certificates with a short issuer name, shortest first."""
    length = F.length("issuer")
    found = certs.filter(
        (length < below) & (F.col("issuer") != EMPTY_NAME) & (F.col("common_name") != CLUSTER_NAME)
    ).select(*NAME_COLUMNS, length.alias("length"), *_observation(certs))
    return _ordered(found, F.col("length").asc())


def blacklisted(certs: DataFrame) -> DataFrame:
    """Certificates whose fingerprint is on the blacklist."""
    listed = F.col("sslbl_SHA1")
    return certs.filter(listed.isNotNull() & (listed != NULL_TEXT)).select(*LISTED_COLUMNS)


def high_entropy_names(certs: DataFrame, below: int = SHORT_NAME, above: float = HIGH_ENTROPY) -> DataFrame:
    """Certificates with a short subject and a random-looking common name, most random first."""
    short = certs.filter((F.length("subject") < below) & F.col("common_name").isNotNull())
    scored = short.select(
        *NAME_COLUMNS,
        *_observation(certs),
        once(shannon_entropy(F.col("common_name"))).alias("entropy_score"),
    ).filter(F.col("entropy_score") > above)
    return _ordered(scored, F.col("entropy_score").desc())


def _observation(certs: DataFrame) -> list[Column]:
    return [field(name).alias(f"_tie_{name}") for name in OBSERVATION if name in certs.columns]


def _ordered(df: DataFrame, lead: Column) -> DataFrame:
    """Sort by ``lead``; further keys let a range shuffle split rows with equal lead values."""
    ties = [name for name in df.columns if name.startswith("_tie_")]
    return df.orderBy(lead, "sha1_fingerprint", "common_name", *ties).drop(*ties)
