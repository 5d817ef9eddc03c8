"""Lookups and the joins that apply them to certificates.

No join carries a hint of its own: Spark broadcasts a lookup when its size, as
known at plan time or measured by adaptive execution, is under the session's
threshold, and otherwise sorts and merges, splitting skewed partitions.
``broadcast_if_small`` raises that threshold for one lookup after measuring it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from huntlake.functions.names import field
from huntlake.operators.shape import prefix_columns

BLACKLIST_PREFIX = "sslbl_"
FIXED_WIDTH_BYTES = 16
ROW_OVERHEAD_BYTES = 32


def broadcast_if_small(lookup: DataFrame, limit_bytes: int) -> DataFrame:
    """Mark ``lookup`` for broadcast if its measured size is at most ``limit_bytes``.

    The size is an upper estimate from one aggregate over the lookup: the bytes
    of its texts plus a flat amount per value and row. A larger lookup, or one
    with nested columns, is returned unmarked.
    """
    size = F.lit(ROW_OVERHEAD_BYTES)
    for item in lookup.schema.fields:
        if isinstance(item.dataType, (StringType, BinaryType)):
            size = size + F.coalesce(F.octet_length(field(item.name)), F.lit(0)) + FIXED_WIDTH_BYTES
        elif hasattr(item.dataType, "elementType") or hasattr(item.dataType, "fields"):
            return lookup
        else:
            size = size + FIXED_WIDTH_BYTES
    measured = lookup.agg(F.sum(size.cast("bigint")).alias("bytes")).first()["bytes"] or 0
    return F.broadcast(lookup) if measured <= limit_bytes else lookup


def clean_top_hosts(top_hosts: DataFrame) -> DataFrame:
    """Drop local and NULL hosts and the record number."""
    return top_hosts.filter(~F.col("alexa_top_host").rlike("localhost")).drop("RecordNumber")


def clean_blacklist(blacklist: DataFrame) -> DataFrame:
    """Mark all blacklist columns with the ``sslbl_`` prefix."""
    return prefix_columns(blacklist, BLACKLIST_PREFIX)


def enrich_blacklist(certs: DataFrame, blacklist: DataFrame) -> DataFrame:
    """Add the blacklist columns; NULL when the fingerprint is not listed.

    A fingerprint listed several times repeats the certificate.
    """
    return certs.join(blacklist, F.col("sha1_fingerprint") == F.col("sslbl_SHA1"), "left")


def enrich_top_hosts(certs: DataFrame, top_hosts: DataFrame) -> DataFrame:
    """Add the popular host equal to the common name; NULL when there is none."""
    return certs.alias("cert").join(
        top_hosts.alias("host"), F.col("cert.common_name") == F.col("host.alexa_top_host"), "left"
    )


def exclude_top_hosts(certs: DataFrame, top_hosts: DataFrame) -> DataFrame:
    """Keep certificates whose common name is no popular host, or is NULL."""
    hosts = top_hosts.select("alexa_top_host")
    return certs.join(hosts, F.col("common_name") == F.col("alexa_top_host"), "left_anti")
