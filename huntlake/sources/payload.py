"""JSON message payloads: decode, schema capture, corrupt records."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from huntlake.functions.names import field
from huntlake.functions.once import once

CORRUPT = "_corrupt_record"
RAW = "_raw"
COORDINATES = ("topic", "partition", "offset")


def message_text(messages: DataFrame, value: str = "value") -> DataFrame:
    """Turn the message value (bytes or text) into text and drop empty messages."""
    return messages.withColumn(value, field(value).cast("string")).filter(field(value).isNotNull())


def decode_json(
    messages: DataFrame,
    schema: StructType,
    value: str = "value",
    keep_raw: bool = False,
    keep_coordinates: bool = False,
) -> DataFrame:
    """Decode JSON text into the columns of ``schema`` plus ``_corrupt_record``.

    ``_corrupt_record`` holds the text of a message that is malformed or has a
    field of another type than ``schema``; in the second case only that field is
    NULL and the others are decoded. It is NULL for a good message. ``keep_raw`` also keeps the text of every message as ``_raw``, so
    that fields outside ``schema`` can be read again later. ``keep_coordinates``
    keeps topic, partition and offset as ``_topic``, ``_partition``, ``_offset``.
    """
    if CORRUPT not in schema.fieldNames():
        schema = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    parsed = F.from_json(field(value), schema, {"columnNameOfCorruptRecord": CORRUPT})
    kept = []
    if keep_coordinates:
        kept += [field(c).alias("_" + c) for c in COORDINATES]
    if keep_raw:
        kept.append(field(value).alias(RAW))
    return messages.select(once(parsed).alias("payload"), *kept).select(
        "payload.*", *(["_" + c for c in COORDINATES] if keep_coordinates else []), *([RAW] if keep_raw else [])
    )


def message_elements(messages: DataFrame, value: str = "value") -> DataFrame:
    """One row per element for messages that are a JSON array; other messages stay as they are.

    An array that is not well-formed, or empty, stays one message.
    """
    text = field(value)
    elements = F.transform(
        F.try_variant_get(F.try_parse_json(text), "$", "array<variant>"), lambda element: F.to_json(element)
    )
    parts = F.when(text.rlike(r"^\s*\["), elements)
    whole = F.when(F.size(parts) > 0, parts).otherwise(F.array(text))
    others = [field(name).alias(name) for name in messages.columns if name != value]
    return messages.select(*others, F.explode_outer(whole).alias(value)).select(*map(field, messages.columns))


def is_garbage() -> Column:
    """Whether a decoded message is no JSON at all; one with a field of another type is not garbage."""
    text = F.col(CORRUPT)
    return text.isNotNull() & F.try_parse_json(text).isNull()


def drop_corrupt(decoded: DataFrame) -> DataFrame:
    """Keep the well-formed messages. A frame without the marker column is returned as it is."""
    if CORRUPT not in decoded.columns:
        return decoded
    return decoded.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def corrupt_records(decoded: DataFrame) -> DataFrame:
    """The malformed messages, for a quarantine table."""
    return decoded.filter(F.col(CORRUPT).isNotNull())


def capture_schema(messages: DataFrame, value: str = "value") -> StructType:
    """Schema of the JSON messages, by one aggregate over them.

    The aggregate merges the schemas of the messages on the executors, so only
    one line of text reaches the driver. Malformed messages are skipped. Fields
    that are always null or empty, or that mix types, become strings; other numbers than
    integers become doubles.
    """
    merged = messages.select(
        F.schema_of_variant_agg(F.try_parse_json(field(value).cast("string"))).alias("merged")
    ).first()["merged"]
    return StructType.fromDDL(_variant_schema_to_ddl(merged))


# A quoted name is matched first and copied, so that a field called like a type is left alone.
_VARIANT_TOKEN = re.compile(
    r"`(?:[^`]|``)*`|\w+(?=:)|(?P<type>OBJECT(?:<>)?|VOID|VARIANT|DECIMAL\(\d+,\s*\d+\))"
)


def _variant_schema_to_ddl(text: str) -> str:
    def convert(match: re.Match) -> str:
        kind = match.group("type")
        if kind is None:
            return match.group(0)
        if kind == "OBJECT":
            return "STRUCT"
        return "DOUBLE" if kind.startswith("DECIMAL") else "STRING"

    body = _VARIANT_TOKEN.sub(convert, text)
    if not body.startswith("STRUCT<"):
        raise ValueError(f"messages are not JSON objects: {text}")
    return body[len("STRUCT<") : -1]


def schema_to_text(schema: StructType) -> str:
    """Schema as one line of JSON, to be stored beside the table it describes."""
    return schema.json()


def schema_from_text(text: str) -> StructType:
    return StructType.fromJson(json.loads(text))
