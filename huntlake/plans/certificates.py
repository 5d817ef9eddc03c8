"""Certificate pipeline: bronze and silver tables of the lookups and the certificates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from huntlake.operators.enrich import (
    broadcast_if_small,
    clean_blacklist,
    clean_top_hosts,
    enrich_blacklist,
    exclude_top_hosts,
)
from huntlake.operators.ingest import add_batch_metadata
from huntlake.sinks.tables import batch_writer, create_namespace
from huntlake.sources.files import read_batch, read_table

# Data source label, lookup schema and column names.
DATASOURCE = "x509_certs"
TOP_HOSTS_SCHEMA = StructType(
    [StructField("RecordNumber", IntegerType()), StructField("alexa_top_host", StringType())]
)
LISTING_DATE_RAW = "# Listingdate"
LISTING_DATE = "listingDate"


def top_hosts_bronze(spark: SparkSession, path: str) -> DataFrame:
    return read_batch(spark, path, "csv", TOP_HOSTS_SCHEMA)


def blacklist_bronze(spark: SparkSession, path: str) -> DataFrame:
    return read_batch(spark, path, "csv").withColumnRenamed(LISTING_DATE_RAW, LISTING_DATE)


def certificates_bronze(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    return add_batch_metadata(read_batch(spark, path, "json", schema), DATASOURCE)


def certificates_silver(
    certs: DataFrame, blacklist: DataFrame, top_hosts: DataFrame, broadcast_limit: int | None = None
) -> DataFrame:
    """Certificates of hosts that are not popular, with the blacklist columns.

    ``blacklist`` and ``top_hosts`` are the cleaned lookups. The exclusion comes
    first because it only removes rows. ``broadcast_limit`` (bytes) lets lookups
    up to that measured size be broadcast even above the session's threshold.
    """
    if broadcast_limit is not None:
        top_hosts = broadcast_if_small(top_hosts.select("alexa_top_host"), broadcast_limit)
        blacklist = broadcast_if_small(blacklist, broadcast_limit)
    return enrich_blacklist(exclude_top_hosts(certs, top_hosts), blacklist)


def build_tables(
    spark: SparkSession,
    namespace: str,
    certificates_path: str,
    blacklist_path: str,
    top_hosts_path: str,
    certificates_schema: StructType | None = None,
    fmt: str = "parquet",
    path: str | None = None,
    broadcast_limit: int | None = None,
) -> DataFrame:
    """Write all bronze and silver tables of the pipeline and return the silver certificates."""
    create_namespace(spark, namespace)

    def save(df: DataFrame, name: str) -> DataFrame:
        writer = batch_writer(df, mode="overwrite", fmt=fmt)
        if path:
            writer = writer.option("path", f"{path}/{name}")
        writer.saveAsTable(f"{namespace}.{name}")
        return read_table(spark, f"{namespace}.{name}")

    hosts = save(top_hosts_bronze(spark, top_hosts_path), "top_hosts_bronze")
    hosts = save(clean_top_hosts(hosts), "top_hosts_silver")
    listed = save(blacklist_bronze(spark, blacklist_path), "blacklist_bronze")
    listed = save(clean_blacklist(listed), "blacklist_silver")
    certs = save(certificates_bronze(spark, certificates_path, certificates_schema), "x509_bronze")
    return save(certificates_silver(certs, listed, hosts, broadcast_limit), "x509_silver")
