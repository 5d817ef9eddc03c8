"""Stand-ins for the library's inputs, derived by Spark from the given tables.

Certificates come from ``documents`` and ``pages``, the blacklist from
``documents`` and ``labels``, the popular hosts from ``pages`` and the Windows
events from ``events``. ``catalogue/oracles.py`` states the same in SQL, and
``FIXTURES.md`` describes both. Every stand-in covers its whole source table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from huntlake.functions import once
from huntlake.operators.ingest import promote_event_fields
from huntlake.operators.shape import flatten_events

HOST = r"^https?://([^/]+)"
EVENT_KINDS = 26
# Events of a value below / above these carry a malformed / an empty message.
MALFORMED_BELOW = 1.0
EMPTY_ABOVE = 200.0
MALFORMED_TEXT = "not json"

CERT_SCHEMA = """
cert_id bigint, sha1_fingerprint string, issuer string, subject string, common_name string,
subject_alternative_names string, src_ip string, dest_ip string, rdns string, country string,
not_valid_before string, not_valid_after string
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(column: Column) -> Column:
    return column.cast("string")


def certs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One certificate per document. Equal texts give equal fingerprints."""
    pages = table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("url", HOST, 1).alias("host"))
    hosts = pages.agg(F.count("*")).scalar()
    # the fingerprint is taken before the join, so no text is shuffled
    kept = ("doc_id", "lang", "source", "n_chars")
    docs = table(spark, sf_dir, "documents").select(*kept, F.sha1("text").alias("print"), (F.col("doc_id") % hosts).alias("page"))
    number = F.col("doc_id")
    fingerprint = F.col("print")

    def every(k: int) -> Column:
        return number % k == 0

    return docs.join(pages, F.col("page_id") == F.col("page"), "left").select(
        number.alias("cert_id"),
        fingerprint.alias("sha1_fingerprint"),
        F.when(every(7), "<Name()>")
        .when(every(5), None)
        .when(every(3), F.concat("lang", F.lit("/"), "source"))
        .when(every(4), F.concat(F.lit("CN=self-"), fingerprint))
        .otherwise(F.concat(F.lit("CN="), "source", F.lit(",O="), "lang", F.lit(",C=ZZ")))
        .alias("issuer"),
        F.when(every(4), F.concat(F.lit("CN="), "source"))
        .when(every(9), None)
        .otherwise(F.concat(F.lit("CN="), "source", F.lit(",serial="), fingerprint))
        .alias("subject"),
        F.when(every(11), "apiserver").when(every(13), None).otherwise(F.col("host")).alias("common_name"),
        F.concat(F.lit("san"), _text(number % 17)).alias("subject_alternative_names"),
        F.concat(F.lit("10.0.0."), _text(number % 250)).alias("src_ip"),
        F.concat(F.lit("192.0.2."), _text(number % 200)).alias("dest_ip"),
        F.when(every(6), None)
        .otherwise(F.concat(F.lit("r"), _text(number % 60), F.lit(".example")))
        .alias("rdns"),
        F.col("lang").alias("country"),
        _text(F.col("n_chars") % 365).alias("not_valid_before"),
        _text(365 + F.col("n_chars") % 365).alias("not_valid_after"),
    )


def blacklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fingerprints of documents labelled toxic."""
    toxic = table(spark, sf_dir, "labels").filter(F.col("toxic") == 1).select("doc_id")
    return (
        table(spark, sf_dir, "documents")
        .select("doc_id", F.sha1("text").alias("SHA1"))
        .join(toxic, "doc_id")
        .select(
            _text(F.col("doc_id")).alias("listingDate"),
            F.col("SHA1"),
            F.concat(F.lit("reason"), _text(F.col("doc_id") % 5)).alias("Listingreason"),
        )
    )


def top_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hosts with more pages than the average host, a local host and a NULL host."""
    hosts = table(spark, sf_dir, "pages").select(F.regexp_extract("url", HOST, 1).alias("host"))
    average = hosts.agg(F.count("*") / F.count_distinct("host")).scalar()
    popular = (
        hosts.groupBy("host")
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") > average)
        .select(F.col("n").cast("int").alias("RecordNumber"), F.col("host").alias("alexa_top_host"))
    )
    odd = spark.range(2).select(
        (-F.col("id") - 1).cast("int"), F.when(F.col("id") == 0, "localhost").cast("string")
    )
    return popular.union(odd)


def _event_fields() -> dict[tuple[str, ...], Column]:
    """Leaf path in the payload -> value, for one row of ``events``."""
    user = _text(F.col("user_id"))
    kind = F.col("event_id") % EVENT_KINDS
    name = F.col("event_type")
    stamp = _text(F.col("ts"))

    def when(kinds: tuple[int, ...], value: Column) -> Column:
        return F.when(kind.isin(*kinds), value)

    def joined(*parts: str | Column) -> Column:
        return F.concat(*(F.lit(part) if isinstance(part, str) else part for part in parts))

    data = {
        "Image": joined("C:/bin/", name, ".exe"),
        "ProcessGuid": joined("{guid-", user, "}"),
        "ProcessId": _text(2000 + F.col("user_id")),
        "User": joined("user-", user),
        "CommandLine": when((1,), joined("run ", name)),
        "PipeName": when((18,), joined("/pipe", user)),
        "TargetObject": when((12, 13, 14), joined("HKLM/k", user)),
        "Details": when((13,), F.col("props")),
        "State": when((4,), F.lit("Started")),
        "TargetFilename": when((11, 23), joined("f", user, ".exe")),
        "Hashes": when((1, 11, 23), joined("SHA1=", F.sha1("props"))),
        "Protocol": when((3,), F.lit("tcp")),
        "SourceIp": when((3,), joined("10.0.0.", _text(F.col("user_id") % 250))),
        "DestinationIp": when((3,), joined("192.0.2.", _text(F.col("user_id") % 200))),
        "DestinationPort": when((3,), F.lit("443")),
        "QueryName": when((22,), joined("h", user, ".example")),
        "QueryStatus": when((22,), F.lit("0")),
        "Operation": when((19, 20, 21), F.lit("Created")),
        "Name": when((19,), joined("flt", user)),
    }
    return {
        ("rid",): F.col("event_id"),
        ("@timestamp",): joined(F.substring(stamp, 1, 10), "T", F.substring(stamp, 12, 8), "Z"),
        ("message",): joined("line1 ", name, "\n", "line2 ", F.col("props")),
        ("agent", "hostname"): joined("host-", _text(F.col("user_id") % 20)),
        ("event", "action"): joined("act-", _text(kind)),
        ("log", "level"): F.when(name == "error", "error").otherwise("information"),
        ("winlog", "channel"): F.when(name == "signup", "Security").otherwise(
            "Microsoft-Windows-Sysmon/Operational"
        ),
        ("winlog", "event_id"): _text(kind),
        ("winlog", "task"): joined("task-", _text(kind)),
        ("winlog", "process", "pid"): _text(1000 + F.col("user_id")),
    } | {("winlog", "event_data", key): value for key, value in data.items()}


def _nested(fields: dict[tuple[str, ...], Column], depth: int = 0) -> list[Column]:
    groups: dict[str, dict[tuple[str, ...], Column]] = {}
    for path, value in fields.items():
        groups.setdefault(path[depth], {})[path] = value
    return [
        next(iter(members.values())).alias(name)
        if all(len(path) == depth + 1 for path in members)
        else F.struct(*_nested(members, depth + 1)).alias(name)
        for name, members in groups.items()
    ]


def payload_schema(spark: SparkSession, sf_dir: str) -> StructType:
    """Schema of the event payload."""
    return events(spark, sf_dir).schema


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One Windows event per row of ``events``, nested as in its JSON payload."""
    return table(spark, sf_dir, "events").select(*_nested(_event_fields()))


def messages(spark: SparkSession, sf_dir: str, parts: int | None = None) -> DataFrame:
    """Kafka-like messages: the payload as JSON bytes, some malformed, some empty.

    With ``parts``, events are dealt into so many parts before their JSON is made.
    """
    source = table(spark, sf_dir, "events")
    source = source.repartition(parts) if parts else source
    value = (
        F.when(F.col("value") > EMPTY_ABOVE, None)
        .when(F.col("value") < MALFORMED_BELOW, F.lit(MALFORMED_TEXT))
        .otherwise(F.to_json(F.struct(*_nested(_event_fields()))))
    )
    return source.select(
        once(value.cast("binary")).alias("value"),
        F.lit("winlogbeat").alias("topic"),
        (F.col("event_id") % 8).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
    )


DRIFT_SCHEMA = (
    StructType()
    .add("id", "long")
    .add("user", "long")
    .add("agent", StructType().add("hostname", "string"))
    .add("winlog", StructType().add("channel", "string"))
    .add("@timestamp", "string")
)


def _drift_fields() -> list[Column]:
    return [F.col("event_id").alias("id"), F.struct(F.col("event_type").alias("channel")).alias("winlog")]


def drifted_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose ``user`` is text in every fifth, with a new field in every seventh and garbage in every eleventh."""
    number, key = F.col("user_id").alias("user"), F.col("event_id")
    value = (
        F.when(key % 11 == 0, F.concat(F.lit("{not json "), key.cast("string")))
        .when(key % 5 == 0, F.to_json(F.struct(*_drift_fields(), F.concat(F.lit("u"), "user_id").alias("user"))))
        .when(key % 7 == 0, F.to_json(F.struct(*_drift_fields(), number, F.col("event_type").alias("later"))))
        .otherwise(F.to_json(F.struct(*_drift_fields(), number)))
    )
    return _as_messages(table(spark, sf_dir, "events"), value)


def array_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third event comes in an array with a copy that has the opposite id."""
    number = F.col("user_id").alias("user")
    copy = F.struct((-F.col("event_id")).alias("id"), *_drift_fields()[1:], number)
    one = F.struct(*_drift_fields(), number)
    value = F.when(F.col("event_id") % 3 == 0, F.to_json(F.array(one, copy))).otherwise(F.to_json(one))
    return _as_messages(table(spark, sf_dir, "events"), value)


def _as_messages(source: DataFrame, value: Column) -> DataFrame:
    return source.select(
        once(value.cast("binary")).alias("value"),
        F.lit("drift").alias("topic"),
        (F.col("event_id") % 8).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
    )


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The well-formed events as bronze rows, without passing through JSON text."""
    return promote_event_fields(events(spark, sf_dir))


def flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_events(bronze(spark, sf_dir))
