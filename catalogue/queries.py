"""The registered queries: every operator of the library over the stand-in inputs.

Arrays are compared as joined text. Columns that hold the time of the run are
reduced to a flag. Queries that write use a fresh folder under the shared one.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from catalogue import inputs
from huntlake.functions.entropy import shannon_entropy
from huntlake.functions.names import field
from huntlake.operators import cim, enrich, file_index, hunts, ingest, layout, shape, sketches
from huntlake.plans import certificates, events, refresh, rules
from huntlake.sinks import cleanup, replace, tables
from huntlake.sinks.shared import fresh_folder, in_parallel
from huntlake.sources import drift, files, payload, seen
from huntlake.streaming.append import stream_tables, stream_to_table
from huntlake.streaming.fanout import BATCH, fan_out
from huntlake.streaming.ledger import compact_ledger_table, ledger_fan_out, read_ledger_table

NAMESPACE = "huntlake_checks"
# Files of a stream's input follow its size, so that a batch is read by many tasks.
MESSAGES_PER_FILE = 100_000
MESSAGE_SCHEMA = "value binary, topic string, partition int, offset bigint"
SILVER_TABLES = (*(route.table for route in rules.ROUTES), events.WIDE_TABLE)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def joined_lines(flat: DataFrame) -> DataFrame:
    return flat.withColumn("message", F.concat_ws("|", "message"))


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return certificates.certificates_silver(
        inputs.certs(spark, sf_dir),
        enrich.clean_blacklist(inputs.blacklist(spark, sf_dir)),
        enrich.clean_top_hosts(inputs.top_hosts(spark, sf_dir)),
    )


def fresh_table(spark: SparkSession, name: str) -> tuple[str, str]:
    """A table name that is free, and a folder for its files."""
    tables.create_namespace(spark, NAMESPACE)
    full = f"{NAMESPACE}.{name}"
    spark.sql(f"DROP TABLE IF EXISTS {full}")
    return full, fresh_folder(spark, name)


# --- sources -----------------------------------------------------------------


@register
def src_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_folder(spark, "src_json")
    inputs.certs(spark, sf_dir).write.json(path, compression="gzip")
    return files.read_batch(spark, path, "json", inputs.CERT_SCHEMA)


@register
def src_json_infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_folder(spark, "src_json_infer")
    inputs.certs(spark, sf_dir).write.json(path, compression="gzip")
    return files.read_batch(spark, path, "json")


@register
def src_csv_infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_folder(spark, "src_csv_infer")
    raw = inputs.blacklist(spark, sf_dir).withColumnRenamed(
        certificates.LISTING_DATE, certificates.LISTING_DATE_RAW
    )
    raw.write.csv(path, header=True, compression="gzip")
    return certificates.blacklist_bronze(spark, path)


@register
def src_csv_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_folder(spark, "src_csv_schema")
    inputs.top_hosts(spark, sf_dir).write.csv(path, compression="gzip")
    return certificates.top_hosts_bronze(spark, path)


@register
def src_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, path = fresh_table(spark, "src_table")
    certs = inputs.certs(spark, sf_dir)
    tables.batch_writer(certs, ["country"], "overwrite").option("path", path).saveAsTable(name)
    return files.read_table(spark, name)


@register
def src_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_folder(spark, "src_default")
    inputs.certs(spark, sf_dir).write.parquet(path)
    return files.read_batch(spark, path)


@register
def payload_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = inputs.messages(spark, sf_dir)
    bronze = events.bronze_events(messages, inputs.payload_schema(spark, sf_dir), keep_raw=False, corrupt="drop")
    return joined_lines(shape.flatten_events(bronze).drop("_ingest_time"))


@register
def corrupt_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.quarantine(inputs.messages(spark, sf_dir), inputs.payload_schema(spark, sf_dir))


@register
def payload_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages some of whose fields have another type than the schema, or are not in it."""
    bronze = events.bronze_events(inputs.drifted_messages(spark, sf_dir), inputs.DRIFT_SCHEMA)
    return bronze.select(
        F.col("id"),
        F.col("user"),
        F.col("winlog.channel").alias("channel"),
        F.get_json_object("_raw", "$.user").alias("raw_user"),
        F.get_json_object("_raw", "$.later").alias("raw_later"),
        F.col("_corrupt_record").isNotNull().alias("marked"),
    )


@register
def payload_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that hold several events each."""
    bronze = events.bronze_events(inputs.array_messages(spark, sf_dir), inputs.DRIFT_SCHEMA, corrupt="drop")
    return bronze.select("id", "user", F.col("winlog.channel").alias("channel"))


@register
def bronze_with_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze and quarantine of one decode, both written; every message is in one of them."""
    good, bad = (fresh_folder(spark, f"bronze_with_quarantine_{kind}") for kind in ("good", "bad"))
    messages = inputs.drifted_messages(spark, sf_dir)
    with events.ingested(messages, inputs.DRIFT_SCHEMA) as (bronze, quarantined):
        bronze.select("_offset", "id").write.parquet(good)
        quarantined.select("_offset", "_raw").write.parquet(bad)
    kept = spark.read.parquet(good).select("_offset", "id", F.lit(None).cast("string").alias("garbage"))
    return kept.unionByName(
        spark.read.parquet(bad).select("_offset", F.lit(None).cast("bigint").alias("id"), F.col("_raw").alias("garbage"))
    )


@register
def topic_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = payload.capture_schema(inputs.messages(spark, sf_dir))
    schema = payload.schema_from_text(payload.schema_to_text(schema))
    leaves = spark.createDataFrame([], schema)
    flat = shape.flatten(leaves)
    return spark.createDataFrame(
        [(item.name, item.dataType.simpleString()) for item in flat.schema.fields], "field string, type string"
    )


# --- ingest metadata and shaping ---------------------------------------------


def drift_profiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile of the drifted messages over 28 days, in which later days hold smaller numbers; made in two turns."""
    arrived = F.date_add(F.lit("2024-01-01").cast("date"), (27 - F.col("offset") % 28).cast("int"))
    source, path = fresh_folder(spark, "messages_by_day"), fresh_folder(spark, "profile")
    messages = inputs.drifted_messages(spark, sf_dir).withColumn("day", arrived)
    tables.balance(messages, ["day"]).write.partitionBy("day").parquet(source)
    messages = files.read_batch(spark, source)
    drift.update_profile(messages.where("day < date'2024-01-05'"), path, "day")
    drift.update_profile(messages, path, "day")
    return drift.read_profile(spark, path, "day")


@register
def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In how many messages of each day each path holds each type."""
    return drift_profiled(spark, sf_dir)


@register
def schema_drift_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The paths and types that each version of the schema brought, and what a table of the first schema should do."""
    profile = drift_profiled(spark, sf_dir)
    report = drift.drift_report(profile, inputs.DRIFT_SCHEMA).select("path", "types", "action")
    return drift.schema_versions(profile, "day").join(report, "path", "left")


@register
def meta_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    certs = ingest.add_batch_metadata(inputs.certs(spark, sf_dir), certificates.DATASOURCE)
    return certs.withColumn("ingest_time", F.col("ingest_time").isNotNull()).withColumn(
        "p_ingest_date", F.col("p_ingest_date") == F.current_date()
    )


@register
def meta_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    timed = ingest.add_ingest_time(inputs.events(spark, sf_dir))
    return timed.select(F.col("_ingest_time").isNotNull().alias("_ingest_time"), "rid", field("@timestamp"))


@register
def promote_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.bronze(spark, sf_dir).select(
        "_sourcetype", "_event_time", "_event_date", "dvc_hostname", "rid"
    )


@register
def flatten_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joined_lines(inputs.flat(spark, sf_dir))


@register
def prefix_blacklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.clean_blacklist(inputs.blacklist(spark, sf_dir))


@register
def top_hosts_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.clean_top_hosts(inputs.top_hosts(spark, sf_dir))


# --- joins and the certificate pipeline --------------------------------------


@register
def enrich_blacklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = enrich.clean_blacklist(inputs.blacklist(spark, sf_dir))
    return enrich.enrich_blacklist(inputs.certs(spark, sf_dir), listed)


@register
def enrich_top_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    hosts = enrich.clean_top_hosts(inputs.top_hosts(spark, sf_dir))
    return enrich.enrich_top_hosts(inputs.certs(spark, sf_dir), hosts)


@register
def exclude_top_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    hosts = enrich.clean_top_hosts(inputs.top_hosts(spark, sf_dir))
    return enrich.exclude_top_hosts(inputs.certs(spark, sf_dir), hosts)


@register
def certs_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(spark, sf_dir)


def stored(df: DataFrame, label: str) -> DataFrame:
    """A table that is made once, as the bronze tables and lookups of the pipeline are."""
    path = f"{fresh_folder(df.sparkSession, label)}/table"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def lookups(blacklist: DataFrame, top_hosts: DataFrame, listed: str = "true", hosts: str = "true") -> refresh.Lookups:
    """A part of the lookups, cleaned, as they may have been at another time."""
    return refresh.Lookups(enrich.clean_blacklist(blacklist.where(listed)), enrich.clean_top_hosts(top_hosts.where(hosts)))


def refresh_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return (
        stored(inputs.certs(spark, sf_dir), "certs"),
        stored(inputs.blacklist(spark, sf_dir), "blacklist"),
        stored(inputs.top_hosts(spark, sf_dir), "hosts"),
    )


@register
def certs_refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver certificates after a change of the blacklist, one of the hosts, and the arrival of a third of the certificates."""
    certs, *whole = refresh_inputs(spark, sf_dir)
    old, none, late = certs.where("cert_id % 3 > 0"), certs.where("false"), certs.where("cert_id % 3 = 0")
    first = lookups(*whole, "Listingreason <> 'reason1'", "length(alexa_top_host) % 2 = 0")
    second = lookups(*whole, "Listingreason <> 'reason2'", "length(alexa_top_host) % 2 = 0")
    third, last = lookups(*whole, "Listingreason <> 'reason2'"), lookups(*whole)
    rows = stored(certificates.certificates_silver(old, *first), "silver")
    rows = stored(refresh.refreshed_silver(rows, old, none, first, second), "silver")
    rows = stored(refresh.refreshed_silver(rows, old, none, second, third), "silver")
    return refresh.refreshed_silver(rows, old, late, third, last)


@register
def certs_table_refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A silver table by country, brought up to date where lookups and new certificates touch it."""
    name, path = fresh_table(spark, "certs_table_refreshed")
    certs, *whole = refresh_inputs(spark, sf_dir)
    old, late = certs.where("cert_id % 3 > 0"), certs.where("cert_id % 3 = 0")
    first, last = lookups(*whole, "Listingreason <> 'reason1'", "length(alexa_top_host) % 2 = 0"), lookups(*whole)
    tables.append_table(certificates.certificates_silver(old, *first), name, "silver", ["country"], path=path)
    refresh.refresh_silver_table(spark, name, old, late.where("false"), first, last)
    refresh.refresh_silver_table(spark, name, old, late, last, last)
    return files.read_table(spark, name)


@register
def certs_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From files to the silver table, through every bronze and silver table."""
    root = fresh_folder(spark, "certs_pipeline")
    inputs.certs(spark, sf_dir).write.json(f"{root}/in/certs", compression="gzip")
    inputs.top_hosts(spark, sf_dir).write.csv(f"{root}/in/hosts", compression="gzip")
    inputs.blacklist(spark, sf_dir).withColumnRenamed(
        certificates.LISTING_DATE, certificates.LISTING_DATE_RAW
    ).write.csv(f"{root}/in/blacklist", header=True, compression="gzip")
    for name in ("top_hosts_bronze", "top_hosts_silver", "blacklist_bronze", "blacklist_silver"):
        fresh_table(spark, name)
    for name in ("x509_bronze", "x509_silver"):
        fresh_table(spark, name)
    built = certificates.build_tables(
        spark,
        NAMESPACE,
        f"{root}/in/certs",
        f"{root}/in/blacklist",
        f"{root}/in/hosts",
        certificates_schema=inputs.CERT_SCHEMA,
        path=f"{root}/tables",
        broadcast_limit=64 << 20,
    )
    return built.drop("ingest_time", "p_ingest_date")


# --- hunts -------------------------------------------------------------------


@register
def hunt_unique_issuer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hunts.unique_issuers(silver(spark, sf_dir))


@register
def hunt_issuer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hunts.issuer_counts(silver(spark, sf_dir))


@register
def issuer_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of 28 days, made in two turns, against the exact counts: whether each estimate is within four standard errors."""
    seen_on = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("cert_id") % 28).cast("int"))
    source, path = fresh_folder(spark, "certs_by_day"), fresh_folder(spark, "issuer_states")
    tables.balance(silver(spark, sf_dir).withColumn("day", seen_on), ["day"]).write.partitionBy("day").parquet(source)
    certs = files.read_batch(spark, source)
    sketches.update_issuer_states(certs.where("day < date'2024-01-20'"), path, "day")
    sketches.update_issuer_states(certs, path, "day")
    near = sketches.estimated_counts(sketches.read_issuer_states(spark, path, "day"))
    exact = hunts.issuer_counts(certs).select("issuer", *[F.col(name).alias(f"{name}_exact") for name in hunts.ISSUER_SETS])
    within = [
        (F.abs(F.col(name) - F.col(f"{name}_exact")) <= 1 + 4 * sketches.relative_error() * F.col(f"{name}_exact")).alias(name)
        for name in hunts.ISSUER_SETS
    ]
    return near.join(exact, "issuer").select("issuer", *within, "certificates")


@register
def hunt_issuer_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hunts.issuer_values(silver(spark, sf_dir))


@register
def hunt_single_subject_issuer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hunts.single_subject_issuers(silver(spark, sf_dir))


@register
def hunt_short_issuer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hunts.short_issuers(silver(spark, sf_dir))


@register
def hunt_blacklisted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hunts.blacklisted(silver(spark, sf_dir))


@register
def hunt_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = hunts.high_entropy_names(silver(spark, sf_dir))
    return found.withColumn("entropy_score", F.round("entropy_score", 6))


@register
def entropy_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = inputs.table(spark, sf_dir, "documents")
    return documents.select("doc_id", F.round(shannon_entropy(F.col("text")), 6).alias("entropy"))


# --- common information model ------------------------------------------------

CIM_SOURCES = ("winlog:event_data:Image", "winlog:event_data:Company", "winlog:event_data:CommandLine")


@register
def cim_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = cim.fill_missing(inputs.flat(spark, sf_dir), CIM_SOURCES)
    return filled.select("rid", *(field(name) for name in CIM_SOURCES))


@register
def cim_literals(spark: SparkSession, sf_dir: str) -> DataFrame:
    literals = [cim.Literal(name, text) for name, text in rules.SHARED_LITERALS.items()]
    return cim.apply_rules(inputs.flat(spark, sf_dir), [cim.Rename("rid", "rid"), *literals])


@register
def cim_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    renames = [cim.Rename(target, source) for source, target in rules.SHARED_RENAMES.items()]
    return cim.apply_rules(inputs.flat(spark, sf_dir), [cim.Rename("rid", "rid"), *renames])


@register
def cim_expr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cim.apply_rules(
        inputs.flat(spark, sf_dir),
        [
            cim.Rename("rid", "rid"),
            cim.Rename("event_id", rules.EVENT_ID),
            rules.message_by_event(rules.PROCESS_MESSAGES),
            cim.Expression("where_and_what", "concat(dvc_hostname, ' ', event_id)"),
        ],
    )


@register
def cim_rule_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = cim.parse_rules(
        [
            {"rename": ["rid", "rid"]},
            {"rename": ["winlog:event_id", "event_id"]},
            {"rename": ["winlog:event_data:Company", "file_company"]},
            {"new": ["source_kind", "LITERAL =sysmon"]},
            {"new": ["is_dns", "EXPR =event_id = '22'"]},
            {"new": ["ignored", "no marker"]},
        ]
    )
    return cim.apply_rules(inputs.flat(spark, sf_dir), parsed)


# --- routes and silver tables ------------------------------------------------


def _register_route(route: rules.Route) -> None:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return events.route_table(inputs.flat(spark, sf_dir), route)

    QUERIES[f"route_{route.table}"] = query


for _route in rules.ROUTES:
    _register_route(_route)


@register
def silver_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joined_lines(events.wide_table(inputs.flat(spark, sf_dir)))


def write_bronze(spark: SparkSession, sf_dir: str, table: str) -> str:
    name, path = fresh_table(spark, table)
    bronze = events.bronze_events(inputs.messages(spark, sf_dir), inputs.payload_schema(spark, sf_dir), keep_raw=False, corrupt="drop")
    tables.append_table(bronze, name, "bronze", events.BRONZE_PARTITIONS, path=path, balanced=True)
    return name


@register
def bronze_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = files.read_table(spark, write_bronze(spark, sf_dir, "bronze_partitioned"))
    return bronze.groupBy("_event_date", "_sourcetype").agg(F.count("*").alias("events"))


@register
def bronze_partition_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.list_partitions(spark, write_bronze(spark, sf_dir, "bronze_partition_list"))


@register
def silver_from_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze table to all silver tables, in digests per table, day and column."""
    bronze = files.read_table(spark, write_bronze(spark, sf_dir, "silver_from_bronze"))
    for table in SILVER_TABLES:
        fresh_table(spark, table)
    events.append_silver(bronze, NAMESPACE, path=fresh_folder(spark, "silver_from_bronze"), bloom=True)
    return silver_content(spark)


def silver_digest(frames: dict[str, DataFrame]) -> DataFrame:
    """Per table, day and column the number of rows and the sum of the values' hashes, whatever their order."""

    def digest(frame: DataFrame, name: str) -> Column:
        listed = isinstance(frame.schema[name].dataType, ArrayType)
        text = F.concat_ws("|", field(name)) if listed else field(name).cast("string")
        hashed = F.md5(F.coalesce(text, F.lit("<null>")).cast("binary"))
        return F.sum(F.conv(F.substring(hashed, 1, 8), 16, 10).cast("long")).alias(name)

    def cells(table: str, frame: DataFrame) -> DataFrame:
        names = [name for name in frame.columns if name not in ("_event_date", "_ingest_time", BATCH)]
        summed = frame.groupBy("_event_date").agg(F.count(F.lit(1)).alias("events"), *(digest(frame, name) for name in names))
        head = [F.lit(table).alias("silver_table"), F.col("_event_date"), F.col("events")]
        pairs = F.array(*(F.struct(F.lit(name).alias("column_name"), field(name).alias("digest")) for name in names))
        return summed.select(*head, F.inline(pairs))

    return reduce(DataFrame.unionByName, (cells(*item) for item in frames.items()))


def silver_content(spark: SparkSession) -> DataFrame:
    return silver_digest({table: files.read_table(spark, f"{NAMESPACE}.{table}") for table in SILVER_TABLES})


@register
def silver_optimized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As above, with every silver table compacted and Z-ordered after the append."""
    bronze = files.read_table(spark, write_bronze(spark, sf_dir, "silver_optimized"))
    for table in SILVER_TABLES:
        fresh_table(spark, table)
    events.append_silver(bronze, NAMESPACE, path=fresh_folder(spark, "silver_optimized"))
    events.optimize_silver(spark, NAMESPACE)
    return silver_content(spark)


@register
def append_evolving(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, path = fresh_table(spark, "append_evolving")
    flat = inputs.flat(spark, sf_dir)
    first = flat.select("rid", "_event_date", field("log:level"))
    second = flat.select(
        "_event_date", field("event:action").alias("event:action"), "rid", F.col("dvc_hostname").alias("host")
    )
    tables.append_table(first, name, "silver", ["_event_date"], path=path)
    tables.append_table(second, name, "silver", ["_event_date"])
    return files.read_table(spark, name)


@register
def append_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_folder(spark, "append_nested")
    nested = inputs.events(spark, sf_dir)
    tables.append_files(nested.select("rid", F.struct("winlog.channel").alias("winlog")), path)
    tables.append_files(nested.select("rid", F.struct("winlog.event_id", "winlog.task").alias("winlog")), path)
    return shape.flatten(tables.read_files(spark, path))


@register
def append_nested_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appends to one partitioned table whose struct grows, before and after an optimise."""
    name, path = fresh_table(spark, "append_nested_table")
    nested = inputs.events(spark, sf_dir)
    kinds = [("winlog.channel",), ("winlog.event_id",), ("winlog.event_id", "winlog.task")]
    for at, fields in enumerate(kinds):
        frame = nested.select("rid", F.struct(*fields).alias("winlog"), F.lit(at % 2).alias("part"))
        tables.append_table(frame, name, "bronze", ["part"], path=path)
        if at == 1:
            layout.optimize_table(spark, name, ["rid"], where="part = 0")
    return shape.flatten(files.read_table(spark, name))


# --- streams -----------------------------------------------------------------


def message_stream(spark: SparkSession, sf_dir: str, label: str) -> tuple[DataFrame, str]:
    """The messages as a file stream, and the folder of this run."""
    root = fresh_folder(spark, label)
    inputs.messages(spark, sf_dir).write.parquet(f"{root}/in")
    return spark.readStream.schema(MESSAGE_SCHEMA).option("maxFilesPerTrigger", 1000).parquet(f"{root}/in"), root


@register
def stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages, root = message_stream(spark, sf_dir, "stream_bronze")
    name, _ = fresh_table(spark, "stream_bronze")
    bronze = events.bronze_events(messages, inputs.payload_schema(spark, sf_dir), keep_raw=False, corrupt="drop")
    stream_to_table(
        bronze, name, "bronze", events.BRONZE_PARTITIONS, checkpoint_root=root, path=f"{root}/table"
    ).awaitTermination()
    flat = shape.flatten_events(files.read_table(spark, name))
    return joined_lines(flat.drop("_ingest_time"))


@register
def stream_evolving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream into a table, and its restart with a larger struct and a new column."""
    name, path = fresh_table(spark, "stream_evolving")
    nested = inputs.events(spark, sf_dir)
    for fields, more in ((("winlog.channel",), ()), (("winlog.channel", "winlog.event_id"), ("winlog.task",))):
        nested.write.mode("append").parquet(f"{path}/in")
        stream = spark.readStream.schema(nested.schema).parquet(f"{path}/in")
        frame = stream.select("rid", F.struct(*fields).alias("winlog"), *more)
        stream_to_table(frame, name, "bronze", checkpoint_root=path, path=f"{path}/table").awaitTermination()
    return shape.flatten(files.read_table(spark, name))


@register
def stream_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages, root = message_stream(spark, sf_dir, "stream_fanout")
    for table in SILVER_TABLES:
        fresh_table(spark, table)
    fan_out(
        events.bronze_events(messages, inputs.payload_schema(spark, sf_dir), keep_raw=False, corrupt="drop"),
        events.silver_tables,
        NAMESPACE,
        "stream_fanout",
        checkpoint_root=root,
        path=f"{root}/tables",
    ).awaitTermination()
    return silver_content(spark)


@register
def stream_fanout_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fan-out behind a ledger, in several batches, with every table compacted and Z-ordered in between and at the end."""
    root = fresh_folder(spark, "stream_fanout_compacted")
    # each half is three shares of files, of which a batch takes two
    share = -(-inputs.table(spark, sf_dir, "events").count() // (6 * MESSAGES_PER_FILE)) or 1
    messages = inputs.messages(spark, sf_dir, 3 * share)
    schema = inputs.payload_schema(spark, sf_dir)
    for half in (0, 1):
        messages.where(F.col("offset") % 2 == half).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(MESSAGE_SCHEMA).option("maxFilesPerTrigger", 2 * share).parquet(f"{root}/in")
        bronze = events.bronze_events(stream, schema, keep_raw=False, corrupt="drop")
        ledger_fan_out(bronze, events.silver_tables, f"{root}/tables", "compacted", checkpoint_root=root).awaitTermination()
        compactions = (
            partial(compact_ledger_table, spark, f"{root}/tables", table, columns=events.CLUSTER_COLUMNS[table])
            for table in SILVER_TABLES
        )
        in_parallel(spark, compactions)
    return silver_digest({table: read_ledger_table(spark, f"{root}/tables", table) for table in SILVER_TABLES})


@register
def ingest_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounded ingest of some messages, of all of them, and of all of them again: each is there once."""
    name, path = fresh_table(spark, "ingest_twice")
    messages, schema = inputs.messages(spark, sf_dir), inputs.payload_schema(spark, sf_dir)
    for delivered in (messages.where("offset % 3 = 0"), messages, messages):
        if spark.catalog.tableExists(name):
            delivered = seen.unseen(delivered, files.read_table(spark, name))
        bronze = events.bronze_events(delivered, schema, keep_raw=False, keep_coordinates=True, corrupt="drop")
        tables.append_table(bronze, name, "bronze", events.BRONZE_PARTITIONS, path=path)
    flat = shape.flatten_events(files.read_table(spark, name))
    return joined_lines(flat.drop("_ingest_time", "_topic", "_partition", "_offset"))


@register
def stream_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages to a bronze table by one stream, bronze to the silver tables by one stream each."""
    messages, root = message_stream(spark, sf_dir, "stream_silver")
    name, _ = fresh_table(spark, "stream_silver_bronze")
    for table in SILVER_TABLES:
        fresh_table(spark, table)
    bronze = events.bronze_events(messages, inputs.payload_schema(spark, sf_dir), keep_raw=False, corrupt="drop")
    stream_to_table(
        bronze, name, "bronze", events.BRONZE_PARTITIONS, checkpoint_root=root, path=f"{root}/bronze"
    ).awaitTermination()
    running = stream_tables(
        events.silver_tables(spark.readStream.table(name)),
        NAMESPACE,
        "silver",
        events.SILVER_PARTITIONS,
        checkpoint_root=root,
        path=f"{root}/tables",
    )
    for query in running:
        query.awaitTermination()
    return silver_content(spark)


# --- layout ------------------------------------------------------------------


@register
def zorder_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, path = fresh_table(spark, "zorder_rewrite")
    wide = events.wide_table(inputs.flat(spark, sf_dir)).drop("message")
    tables.append_table(wide, name, "silver", path=path)
    layout.optimize_table(spark, name, ["winlog:event_data:User", "event_id"])
    return files.read_table(spark, name)


@register
def bloom_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, path = fresh_table(spark, "bloom_write")
    table = events.route_table(inputs.flat(spark, sf_dir), rules.PROCESS)
    options = layout.bloom_options(rules.PROCESS.bloom_columns)
    tables.append_table(
        table, name, "silver", events.SILVER_PARTITIONS, path=path, balanced=True, options=options
    )
    return files.read_table(spark, name)


@register
def zone_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of a range of ids, from the files whose smallest and largest ids reach into it."""
    name, path = fresh_table(spark, "zone_lookup")
    tables.append_table(events.wide_table(inputs.flat(spark, sf_dir)).drop("message"), name, "silver", path=path)
    layout.optimize_table(spark, name, ["event_id", "rid"], files=16)
    stored = files.read_table(spark, name)
    zones = f"{fresh_folder(spark, 'zones')}/zones"
    file_index.zone_map(stored, ["event_id", "rid"]).write.parquet(zones)
    return file_index.in_range(stored, spark.read.parquet(zones), {"event_id": ("11", "14")})


@register
def bloom_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of a list of users, from the files whose bloom bits allow for one of them."""
    name, path = fresh_table(spark, "bloom_lookup")
    user = field("winlog:event_data:User").alias("user")
    rows = inputs.flat(spark, sf_dir).select("rid", user, F.col("winlog:event_id").alias("event_id"))
    tables.append_table(rows, name, "silver", path=path)
    layout.optimize_table(spark, name, ["user"], files=16)
    stored = files.read_table(spark, name)
    index = f"{fresh_folder(spark, 'bloom')}/index"
    file_index.bloom_index(stored, ["user"]).sort("column", "words", "word").write.parquet(index)
    return file_index.holding(stored, spark.read.parquet(index), "user", rows.where("rid % 101 = 0").select("user"))


@register
def optimize_overlapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Optimise all days, append to some of them, and optimise again: only days with new rows are rewritten."""
    name, path = fresh_table(spark, "optimize_overlapping")
    rows = inputs.flat(spark, sf_dir).select("rid", "_event_date")
    later = rows.where("day(_event_date) % 4 = 0")
    for label, part in (("first", rows), ("second", later)):
        tables.append_table(part.withColumn("silver_table", F.lit(label)), name, "silver", ["_event_date"], path=path)
        last = layout.optimize_table(spark, name, ["rid"], depth=0 if label == "first" else 1)
    spark.catalog.refreshTable(name)
    moved = F.col("_metadata.file_path").contains(f"/{last.rsplit('/', 1)[1]}/").alias("moved")
    return files.read_table(spark, name).select("silver_table", "_event_date", "rid", moved)


@register
def unused_files_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append, optimise, append, optimise some days, and remove what no table uses: the rows stay, each in one file."""
    name, path = fresh_table(spark, "unused_files_removed")
    rows = inputs.flat(spark, sf_dir).select("rid", "_event_date")
    for label in ("first", "second"):
        tables.append_table(rows.withColumn("silver_table", F.lit(label)), name, "silver", ["_event_date"], path=path)
        layout.optimize_table(spark, name, ["rid"], where="_event_date is not null")
    cleanup.remove_unreferenced(spark, cleanup.unreferenced_of_table(spark, name, hours=0.0), dry_run=False)
    spark.catalog.refreshTable(name)
    beside = spark.read.option("recursiveFileLookup", "true").parquet(f"{path}*").groupBy("rid", "silver_table").count()
    table = files.read_table(spark, name)
    return table.join(beside, ["rid", "silver_table"]).select("silver_table", "_event_date", "rid", F.col("count").cast("int").alias("copies"))


@register
def replace_grown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table without a path, overwritten at once and then appended to with a larger struct."""
    name, _ = fresh_table(spark, "replace_grown")
    nested = inputs.events(spark, sf_dir).select("rid", F.col("@timestamp").cast("date").alias("_event_date"), "winlog")
    few = nested.select("rid", "_event_date", F.struct("winlog.channel").alias("winlog"))
    tables.append_table(few.where("rid % 2 = 0"), name, "silver", ["_event_date"])
    replace.replace_table(few.where("rid % 5 = 0"), name, ["_event_date"])
    more = nested.select("rid", "_event_date", F.struct("winlog.channel", "winlog.event_id").alias("winlog"))
    tables.append_table(more.where("rid % 5 <> 0"), name, "silver", ["_event_date"])
    replace.replace_table(
        files.read_table(spark, name).drop("winlog").join(more.select("rid", "winlog"), "rid"), name, ["_event_date"]
    )
    return shape.flatten(files.read_table(spark, name))
