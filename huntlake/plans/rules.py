"""Normalisation rules and table layout of the seven Sysmon event routes."""

from __future__ import annotations

from dataclasses import dataclass

from huntlake.operators.cim import Expression, Literal, Rename, Rule

# ---------------------------------------------------------------------------
# Channel, event ids, column names and texts of the routes.
# ---------------------------------------------------------------------------

SYSMON_CHANNEL = "Microsoft-Windows-Sysmon/Operational"
EVENT_ID = "winlog:event_id"

SHARED_LITERALS = {
    "event_schema_version": "1.0",
    "event_schema_file": "winlogbeat-sysmon",
    "event_result": "success",
}

SHARED_RENAMES = {
    "_sourcetype": "_sourcetype",
    "_event_time": "_event_time",
    "_event_date": "_event_date",
    "dvc_hostname": "dvc_hostname",
    "winlog:event_id": "event_id",
    "winlog:task": "event_category_type",
    "log:level": "event_severity",
    "event:action": "event_status",
}

PROCESS_MESSAGES = {"1": "Process Started", "5": "Process Terminated", "18": "Pipe Connected"}
PROCESS_FIELDS = {
    "CommandLine": "process_command_line",
    "Company": "file_company",
    "CurrentDirectory": "process_file_directory",
    "Description": "file_description",
    "Image": "process_file_path",
    "IntegrityLevel": "process_integrity_level",
    "LogonGuid": "user_logon_guid",
    "LogonId": "user_logon_id",
    "OriginalFileName": "file_name_original",
    "ParentCommandLine": "process_parent_command_line",
    "ParentImage": "process_parent_file_path",
    "ParentProcessGuid": "process_parent_guid",
    "ParentProcessId": "process_parent_id",
    "ParentUser": "acting_user_name",
    "ProcessId": "process_id",
    "ProcessName": "process_name",
    "Product": "file_product",
    "TerminalSessionId": "user_session_id",
    "User": "user_name",
    "FileVersion": "file_version",
    "ProcessGuid": "process_guid",
    "Hashes": "file_hashes",
    "PipeName": "pipe_name",
}

REGISTRY_MESSAGES = {
    "12": "RegistryKey Create/Delete",
    "13": "Registry Value Set",
    "14": "Registry Key and Value Rename",
}
REGISTRY_FIELDS = {
    "EventType": "event_type",
    "ProcessGuid": "process_guid",
    "ProcessId": "process_id",
    "Image": "process_file_path",
    "TargetObject": "registry_path",
    "Details": "registry_value",
    "NewName": "registry_key_new_name",
}

SERVICE_MESSAGE = "Service State Changed"
SERVICE_FIELDS = {"State": "service_state", "Version": "file_version"}
SERVICE_OTHER_FIELDS = {"winlog:process:pid": "process_pid"}

FILE_MESSAGE = ""
FILE_FIELDS = {
    "ProcessGuid": "process_guid",
    "ProcessId": "process_id",
    "Image": "process_file_path",
    "TargetFilename": "file_name",
    "CreationUtcTime": "file_creation_time",
    "User": "user_name",
    "Hashes": "file_hashes",
    "IsExecutable": "file_is_exe",
    "Archived": "file_archived",
}

NETWORK_FIELDS = {
    "ProcessGuid": "process_guid",
    "ProcessId": "process_id",
    "Image": "process_file_path",
    "User": "user_name",
    "Protocol": "network_protocol",
    "Initiated": "network_initiated",
    "SourceIsIpv6": "src_ip_is_ipv6",
    "SourceIp": "src_ip_addr",
    "SourceHostname": "src_dvc_hostname",
    "SourcePort": "src_port_number",
    "DestinationIsIpv6": "dst_ip_is_ipv6",
    "DestinationIp": "dst_ip_addr",
    "DestinationHostname": "dst_dvc_hostname",
    "DestinationPort": "dst_port_number",
    "DestinationPortName": "dst_port_name",
}

DNS_MESSAGE = "DNS"
DNS_FIELDS = {
    "ProcessGuid": "process_guid",
    "ProcessId": "process_id",
    "QueryName": "dst_host_name",
    "QueryStatus": "dns_response_code",
    "QueryResults": "dns_response_name",
    "Image": "process_file_path",
}

WMI_MESSAGES = {
    "19": "WmiEventFilter activity detected",
    "20": "WmiEventConsumer activity detected",
    "21": "WmiEventConsumerToFilter activity detected",
}
WMI_FIELDS = {
    "Operation": "wmi_operation",
    "User": "user_name",
    "EventNamespace": "wmi_namespace",
    "Name": "wmi_filter_name",
    "Query": "wmi_query",
    "ConsumerName": "wmi_consumer_name",
    "Type": "wmi_consumer_type",
    "Destination": "wmi_consumer_destination",
    "Consumer": "wmi_consumer_path",
    "Filter": "wmi_filter_path",
}

# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Route:
    """Events of one kind and the silver table they become."""

    table: str
    event_ids: tuple[str, ...]
    rules: tuple[Rule, ...]
    bloom_columns: tuple[str, ...]
    cluster_columns: tuple[str, ...] = ("dvc_hostname", "event_id")


def message_by_event(messages: dict[str, str]) -> Expression:
    """``event_message`` chosen by event id, NULL for any other id.

    Ids are compared as text, so a malformed id is no cast error.
    """
    cases = " ".join(f"when '{event_id}' then '{text}'" for event_id, text in messages.items())
    return Expression("event_message", f"case cast(event_id as string) {cases} end")


def _rules(
    event_data: dict[str, str], *own: Rule, other_fields: dict[str, str] | None = None
) -> tuple[Rule, ...]:
    sources = SHARED_RENAMES | {f"winlog:event_data:{name}": target for name, target in event_data.items()}
    sources |= other_fields or {}
    return (
        *own,
        *(Literal(target, text) for target, text in SHARED_LITERALS.items()),
        *(Rename(target, source) for source, target in sources.items()),
    )


PROCESS = Route(
    table="process",
    event_ids=tuple(PROCESS_MESSAGES),
    rules=_rules(
        PROCESS_FIELDS, message_by_event(PROCESS_MESSAGES), Literal("event_message_result", "success")
    ),
    bloom_columns=("user_name",),
    cluster_columns=("process_name", "event_id"),
)
REGISTRY = Route(
    table="registry",
    event_ids=tuple(REGISTRY_MESSAGES),
    rules=_rules(REGISTRY_FIELDS, message_by_event(REGISTRY_MESSAGES)),
    bloom_columns=("registry_path",),
)
SERVICE = Route(
    table="service",
    event_ids=("4",),
    rules=_rules(SERVICE_FIELDS, Literal("event_message", SERVICE_MESSAGE), other_fields=SERVICE_OTHER_FIELDS),
    bloom_columns=("_sourcetype", "service_state"),
)
FILE = Route(
    table="file",
    event_ids=("11", "23"),
    rules=_rules(FILE_FIELDS, Literal("event_message", FILE_MESSAGE)),
    bloom_columns=("_sourcetype", "file_name"),
)
# This table has no event_message column.
NETWORK = Route(
    table="network",
    event_ids=("3",),
    rules=_rules(NETWORK_FIELDS),
    bloom_columns=("_sourcetype", "dst_ip_addr", "src_ip_addr"),
)
DNS = Route(
    table="dns",
    event_ids=("22",),
    rules=_rules(DNS_FIELDS, Literal("event_message", DNS_MESSAGE)),
    bloom_columns=("_sourcetype", "dst_host_name", "dns_response_name"),
)
WMI = Route(
    table="wmi",
    event_ids=tuple(WMI_MESSAGES),
    rules=_rules(WMI_FIELDS, message_by_event(WMI_MESSAGES)),
    bloom_columns=("_sourcetype", "wmi_operation"),
)

ROUTES = (PROCESS, REGISTRY, SERVICE, FILE, NETWORK, DNS, WMI)
