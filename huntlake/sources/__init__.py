from huntlake.sources.files import read_batch, read_table
from huntlake.sources.kafka import read_topic, stream_topic, topic_options
from huntlake.sources.payload import (
    capture_schema,
    corrupt_records,
    decode_json,
    drop_corrupt,
    message_text,
    schema_from_text,
    schema_to_text,
)

__all__ = [
    "capture_schema",
    "corrupt_records",
    "decode_json",
    "drop_corrupt",
    "message_text",
    "read_batch",
    "read_table",
    "read_topic",
    "schema_from_text",
    "schema_to_text",
    "stream_topic",
    "topic_options",
]
