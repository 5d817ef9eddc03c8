"""Silver certificates brought up to date when certificates arrive or a lookup changes, without joining all of them anew.

A certificate's silver rows depend on its own row, on whether its common name is
a popular host, and on the blacklist rows of its fingerprint. So a change of the
lookups touches only certificates with a host that came or went, or a
fingerprint whose blacklist rows are others than before.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from huntlake.functions.names import field, quoted, text_literal
from huntlake.plans.certificates import certificates_silver
from huntlake.sinks.growth import partition_values


class Lookups(NamedTuple):
    """The cleaned lookups as they are at one time."""

    blacklist: DataFrame
    top_hosts: DataFrame


class Changes(NamedTuple):
    """Common names and fingerprints whose certificates are touched, each once; never NULL, which matches no lookup."""

    hosts: DataFrame
    fingerprints: DataFrame


def changed_keys(before: Lookups, after: Lookups) -> Changes:
    """What differs between two states of the lookups.

    A host counts as there or not, however often it is listed. Of a fingerprint
    all columns of its blacklist rows count, and how often each row is there.
    The work is a shuffle of the lookups, whatever the number of certificates.
    """
    old, new = (state.top_hosts.select(F.col("alexa_top_host").alias("_host")).where("_host is not null") for state in (before, after))
    hosts = old.subtract(new).union(new.subtract(old))
    was, now = before.blacklist, after.blacklist.select(before.blacklist.columns)
    other = was.exceptAll(now).union(now.exceptAll(was))
    prints = other.select(F.col("sslbl_SHA1").alias("_print")).where("_print is not null").distinct()
    return Changes(hosts, prints)


def touched(certs: DataFrame, changes: Changes) -> DataFrame:
    """The certificates (bronze or silver rows) that changed lookups touch."""
    return _marked(certs, changes).where("_host is not null or _print is not null").drop("_host", "_print")


def untouched(certs: DataFrame, changes: Changes) -> DataFrame:
    """All other certificates."""
    return _marked(certs, changes).where("_host is null and _print is null").drop("_host", "_print")


def _marked(certs: DataFrame, changes: Changes) -> DataFrame:
    # the keys are distinct, so no row is repeated; adaptive execution broadcasts them while they are few
    by_host = certs.join(changes.hosts, field("common_name") == F.col("_host"), "left")
    return by_host.join(changes.fingerprints, field("sha1_fingerprint") == F.col("_print"), "left")


def refreshed_silver(silver: DataFrame, certs: DataFrame, arrived: DataFrame, before: Lookups, after: Lookups) -> DataFrame:
    """The silver rows after a change, from those before it.

    ``silver`` was made of ``certs`` and ``before``; ``arrived`` are further
    certificates. Rows of touched certificates are retracted and made anew from
    ``certs``; the others stay as they are and meet no lookup. The result equals
    ``certificates_silver`` of all certificates and ``after``, repeats included.
    """
    changes = changed_keys(before, after)
    anew = touched(certs, changes).unionByName(arrived.select(certs.columns))
    return untouched(silver, changes).unionByName(certificates_silver(anew, after.blacklist, after.top_hosts).select(silver.columns))


def refresh_silver_table(
    spark: SparkSession, name: str, certs: DataFrame, arrived: DataFrame, before: Lookups, after: Lookups
) -> int:
    """Make the partitions of a silver table anew that a change touches; returns how many these are.

    The Parquet table ``name`` is partitioned by columns of the certificates, was made of
    ``certs`` and ``before``, and takes in ``arrived`` too. Each touched partition is
    written beside the table from its certificates, all of them, and the catalog is then
    pointed to it; the old files stay for running readers until they are cleaned up.
    Partitions are switched one after the other. A call that failed can be repeated with
    the same arguments: what it makes does not depend on the table's rows. A table without partitions raises.
    """
    partition_by = [column.name for column in spark.catalog.listColumns(name) if column.isPartition]
    if not partition_by:
        raise ValueError(f"{name} has no partitions; replace it by refreshed_silver")
    every = certs.unionByName(arrived.select(certs.columns))
    keys = [_key(column).alias(f"_part_{at}") for at, column in enumerate(partition_by)]
    parts = touched(certs, changed_keys(before, after)).select(*keys).union(arrived.select(*keys)).distinct()
    found = parts.collect()  # partitions, which the catalog lists too
    if not found:
        return 0
    chosen = spark.createDataFrame(found, parts.schema)
    same = [_key(column).eqNullSafe(F.col(f"_part_{at}")) for at, column in enumerate(partition_by)]
    silver = certificates_silver(every.join(chosen, same, "left_semi"), after.blacklist, after.top_hosts)

    location = {row["col_name"]: row["data_type"] for row in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}["Location"]
    target = f"{location.rstrip('/')}_{uuid.uuid4().hex}"
    table = spark.table(name)
    silver.select(*map(field, table.columns)).write.partitionBy(*partition_by).parquet(target)
    written = spark.read.schema(table.schema).parquet(target).select("_metadata.file_path").distinct().collect()
    folders = {unquote(row["file_path"]).split(f"/{target.rsplit('/', 1)[1]}/", 1)[1].rpartition("/")[0] for row in written}
    places = {tuple(partition_values(folder)): f"{target}/{folder}" for folder in folders}
    texts = chosen.select(*(F.col(column).cast("string") for column in chosen.columns)).collect()
    for at, values in enumerate(map(tuple, texts)):
        spec = ", ".join(
            f"{quoted(column)} = " + ("null" if value is None else text_literal(value)) for column, value in zip(partition_by, values)
        )
        place = text_literal(places.get(values, f"{target}/_empty_{at}"))  # no row is left: a folder that holds nothing
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({spec}) LOCATION {place}")
        spark.sql(f"ALTER TABLE {name} PARTITION ({spec}) SET LOCATION {place}")
    spark.catalog.refreshTable(name)
    return len(found)


def _key(column: str) -> Column:
    """The value that a row's partition has: NULL for an empty text, which has no folder of its own."""
    return F.when(field(column).cast("string") != "", field(column))
