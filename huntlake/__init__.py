"""Security analytics on Spark: certificate hunting and Windows event normalisation."""

from huntlake.functions import shannon_entropy
from huntlake.operators.cim import Expression, Literal, Rename, apply_rules, fill_missing, parse_rules
from huntlake.operators.enrich import (
    broadcast_if_small,
    clean_blacklist,
    clean_top_hosts,
    enrich_blacklist,
    enrich_top_hosts,
    exclude_top_hosts,
)
from huntlake.operators.file_index import bloom_index, holding, in_range, overlap_depth, zone_map
from huntlake.operators.hunts import (
    blacklisted,
    high_entropy_names,
    issuer_counts,
    issuer_values,
    short_issuers,
    single_subject_issuers,
    unique_issuers,
)
from huntlake.operators.ingest import add_batch_metadata, add_ingest_time, promote_event_fields
from huntlake.operators.layout import bloom_options, optimize_table, zorder
from huntlake.operators.shape import flatten, flatten_events, prefix_columns, split_lines
from huntlake.operators.sketches import (
    estimated_counts,
    issuer_states,
    merged_states,
    read_issuer_states,
    update_issuer_states,
)
from huntlake.plans.certificates import build_tables, certificates_silver
from huntlake.plans.events import (
    append_silver,
    bronze_events,
    ingested,
    optimize_silver,
    quarantine,
    route_events,
    route_table,
    silver_tables,
    wide_table,
)
from huntlake.plans.refresh import Lookups, refresh_silver_table, refreshed_silver
from huntlake.plans.rules import ROUTES, Route
from huntlake.settings import cluster_settings
from huntlake.sinks.cleanup import remove_unreferenced, unreferenced_files, unreferenced_of_table
from huntlake.sinks.replace import recover_table, replace_table
from huntlake.sinks.shared import shared
from huntlake.sinks.tables import (
    append_files,
    append_table,
    batch_writer,
    create_namespace,
    list_partitions,
    read_files,
)
from huntlake.sources import (
    capture_schema,
    corrupt_records,
    decode_json,
    drop_corrupt,
    message_text,
    read_batch,
    read_table,
    read_topic,
    stream_topic,
)
from huntlake.sources.drift import (
    drift_profile,
    drift_report,
    proposed_schema,
    read_profile,
    schema_versions,
    update_profile,
)
from huntlake.sources.seen import next_offsets, unseen
from huntlake.streaming.append import stream_tables, stream_to_table
from huntlake.streaming.fanout import fan_out
from huntlake.streaming.ledger import compact_ledger_table, ledger_fan_out, read_ledger_table

__all__ = [
    "Expression",
    "Literal",
    "Lookups",
    "ROUTES",
    "Rename",
    "Route",
    "add_batch_metadata",
    "add_ingest_time",
    "append_files",
    "append_silver",
    "append_table",
    "apply_rules",
    "batch_writer",
    "blacklisted",
    "bloom_index",
    "bloom_options",
    "broadcast_if_small",
    "bronze_events",
    "build_tables",
    "capture_schema",
    "certificates_silver",
    "clean_blacklist",
    "clean_top_hosts",
    "cluster_settings",
    "compact_ledger_table",
    "corrupt_records",
    "create_namespace",
    "decode_json",
    "drift_profile",
    "drift_report",
    "drop_corrupt",
    "enrich_blacklist",
    "enrich_top_hosts",
    "estimated_counts",
    "exclude_top_hosts",
    "fan_out",
    "fill_missing",
    "flatten",
    "flatten_events",
    "high_entropy_names",
    "holding",
    "in_range",
    "ingested",
    "issuer_counts",
    "issuer_states",
    "issuer_values",
    "ledger_fan_out",
    "list_partitions",
    "merged_states",
    "message_text",
    "next_offsets",
    "optimize_silver",
    "optimize_table",
    "overlap_depth",
    "parse_rules",
    "prefix_columns",
    "promote_event_fields",
    "proposed_schema",
    "quarantine",
    "read_batch",
    "read_files",
    "read_issuer_states",
    "read_ledger_table",
    "read_profile",
    "read_table",
    "read_topic",
    "recover_table",
    "refresh_silver_table",
    "refreshed_silver",
    "remove_unreferenced",
    "replace_table",
    "route_events",
    "route_table",
    "schema_versions",
    "shannon_entropy",
    "shared",
    "short_issuers",
    "silver_tables",
    "single_subject_issuers",
    "split_lines",
    "stream_tables",
    "stream_to_table",
    "stream_topic",
    "unique_issuers",
    "unreferenced_files",
    "unreferenced_of_table",
    "unseen",
    "update_issuer_states",
    "update_profile",
    "wide_table",
    "zone_map",
    "zorder",
]
