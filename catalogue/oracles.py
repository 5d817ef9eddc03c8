"""For each registered query, the same result in SQL over the given tables.

The SQL states the stand-in inputs and the expected columns on its own; it takes
no rule or text from the library.
"""

from __future__ import annotations

HOST = "regexp_extract(url, '^https?://([^/]+)', 1)"

CTES = {
    "certs": f"""
select d.doc_id as cert_id, sha1(d.text) as sha1_fingerprint,
  case when d.doc_id % 7 = 0 then '<Name()>' when d.doc_id % 5 = 0 then null
       when d.doc_id % 3 = 0 then d.lang || '/' || d.source
       when d.doc_id % 4 = 0 then 'CN=self-' || sha1(d.text)
       else 'CN=' || d.source || ',O=' || d.lang || ',C=ZZ' end as issuer,
  case when d.doc_id % 4 = 0 then 'CN=' || d.source when d.doc_id % 9 = 0 then null
       else 'CN=' || d.source || ',serial=' || sha1(d.text) end as subject,
  case when d.doc_id % 11 = 0 then 'apiserver' when d.doc_id % 13 = 0 then null else p.host end as common_name,
  'san' || cast(d.doc_id % 17 as varchar) as subject_alternative_names,
  '10.0.0.' || cast(d.doc_id % 250 as varchar) as src_ip,
  '192.0.2.' || cast(d.doc_id % 200 as varchar) as dest_ip,
  case when d.doc_id % 6 = 0 then null else 'r' || cast(d.doc_id % 60 as varchar) || '.example' end as rdns,
  d.lang as country,
  cast(d.n_chars % 365 as varchar) as not_valid_before,
  cast(365 + d.n_chars % 365 as varchar) as not_valid_after
from documents d
left join (select page_id, {HOST} as host from pages) p on p.page_id = d.doc_id % (select count(*) from pages)""",
    "sslbl": """
select cast(d.doc_id as varchar) as "listingDate", sha1(d.text) as "SHA1",
  'reason' || cast(d.doc_id % 5 as varchar) as "Listingreason"
from documents d join labels l on l.doc_id = d.doc_id where l.toxic = 1""",
    "listed": """
select "listingDate" as "sslbl_listingDate", "SHA1" as "sslbl_SHA1", "Listingreason" as "sslbl_Listingreason"
from sslbl""",
    "hosts": f"""
select {HOST} as host from pages""",
    "top1m": """
select cast(count(*) as integer) as "RecordNumber", host as alexa_top_host from hosts group by host
having count(*) > (select count(*) / count(distinct host) from hosts)
union all select -1, 'localhost' union all select -2, cast(null as varchar)""",
    "top_silver": """
select alexa_top_host from top1m where alexa_top_host not like '%localhost%'""",
    "silver": """
select c.*, l.* from certs c left join listed l on c.sha1_fingerprint = l."sslbl_SHA1"
where not exists (select 1 from top_silver t where t.alexa_top_host = c.common_name)""",
    "wl": """
select event_id as rid, value as event_value,
  substr(cast(ts as varchar), 1, 10) || 'T' || substr(cast(ts as varchar), 12, 8) || 'Z' as event_time,
  cast(ts as date) as event_date,
  'line1 ' || event_type || '|' || 'line2 ' || props as message,
  'host-' || cast(user_id % 20 as varchar) as hostname,
  case when event_type = 'error' then 'error' else 'information' end as log_level,
  'act-' || cast(event_id % 26 as varchar) as event_action,
  case when event_type = 'signup' then 'Security' else 'Microsoft-Windows-Sysmon/Operational' end as channel,
  cast(event_id % 26 as varchar) as winlog_event_id,
  'task-' || cast(event_id % 26 as varchar) as task,
  cast(1000 + user_id as varchar) as process_pid,
  'C:/bin/' || event_type || '.exe' as ed_Image,
  '{guid-' || cast(user_id as varchar) || '}' as ed_ProcessGuid,
  cast(2000 + user_id as varchar) as ed_ProcessId,
  'user-' || cast(user_id as varchar) as ed_User,
  case when event_id % 26 = 1 then 'run ' || event_type end as ed_CommandLine,
  case when event_id % 26 = 18 then '/pipe' || cast(user_id as varchar) end as ed_PipeName,
  case when event_id % 26 in (12, 13, 14) then 'HKLM/k' || cast(user_id as varchar) end as ed_TargetObject,
  case when event_id % 26 = 13 then props end as ed_Details,
  case when event_id % 26 = 4 then 'Started' end as ed_State,
  case when event_id % 26 in (11, 23) then 'f' || cast(user_id as varchar) || '.exe' end as ed_TargetFilename,
  case when event_id % 26 in (1, 11, 23) then 'SHA1=' || sha1(props) end as ed_Hashes,
  case when event_id % 26 = 3 then 'tcp' end as ed_Protocol,
  case when event_id % 26 = 3 then '10.0.0.' || cast(user_id % 250 as varchar) end as ed_SourceIp,
  case when event_id % 26 = 3 then '192.0.2.' || cast(user_id % 200 as varchar) end as ed_DestinationIp,
  case when event_id % 26 = 3 then '443' end as ed_DestinationPort,
  case when event_id % 26 = 22 then 'h' || cast(user_id as varchar) || '.example' end as ed_QueryName,
  case when event_id % 26 = 22 then '0' end as ed_QueryStatus,
  case when event_id % 26 in (19, 20, 21) then 'Created' end as ed_Operation,
  case when event_id % 26 = 19 then 'flt' || cast(user_id as varchar) end as ed_Name
from events""",
    "delivered": """
select * from wl where not (event_value > 200 or event_value < 1)""",
}

NEEDS = {
    "listed": ("sslbl",),
    "top1m": ("hosts",),
    "top_silver": ("hosts", "top1m"),
    "silver": ("certs", "sslbl", "listed", "hosts", "top1m", "top_silver"),
    "delivered": ("wl",),
}


def with_inputs(body: str, *names: str, **own: str) -> str:
    """``body`` after the stand-ins ``names``, what they need, and ``own`` further views."""
    ordered = dict.fromkeys(need for name in names for need in (*NEEDS.get(name, ()), name))
    views = {name: CTES[name] for name in ordered} | own
    head = ",\n".join(f"{name} as ({sql.strip()})" for name, sql in views.items())
    return f"with {head}\n{body.strip()}"


CERTS = """cert_id, sha1_fingerprint, issuer, subject, common_name, subject_alternative_names, src_ip, dest_ip,
  rdns, country, not_valid_before, not_valid_after"""
LISTED = '"sslbl_listingDate", "sslbl_SHA1", "sslbl_Listingreason"'

EVENT_DATA = (
    "Image ProcessGuid ProcessId User CommandLine PipeName TargetObject Details State TargetFilename Hashes "
    "Protocol SourceIp DestinationIp DestinationPort QueryName QueryStatus Operation Name"
).split()
FLAT = (
    """channel as "_sourcetype", event_time as "_event_time", event_date as "_event_date", hostname as dvc_hostname,
  rid, event_time as "@timestamp", message, hostname as "agent:hostname", event_action as "event:action",
  log_level as "log:level", channel as "winlog:channel", winlog_event_id as "winlog:event_id",
  task as "winlog:task", process_pid as "winlog:process:pid", """
    + ", ".join(f'ed_{name} as "winlog:event_data:{name}"' for name in EVENT_DATA)
)
WIDE = FLAT.replace('"winlog:event_id"', "event_id")

ORACLES: dict[str, str] = {}

for _name in ("src_json", "src_json_infer", "src_table", "src_default"):
    ORACLES[_name] = with_inputs(f"select {CERTS} from certs", "certs")
ORACLES["src_csv_infer"] = with_inputs(
    'select cast("listingDate" as integer) as "listingDate", "SHA1", "Listingreason" from sslbl', "sslbl"
)
ORACLES["src_csv_schema"] = with_inputs('select "RecordNumber", alexa_top_host from top1m', "top1m")
ORACLES["payload_decode"] = with_inputs(f"select {FLAT} from delivered", "delivered")
ORACLES["stream_bronze"] = ORACLES["payload_decode"]
ORACLES["corrupt_quarantine"] = """
select 'winlogbeat' as "_topic", cast(event_id % 8 as integer) as "_partition", event_id as "_offset",
  'not json' as "_raw"
from events where value < 1"""
ORACLES["payload_drift"] = """
select case when event_id % 11 <> 0 then event_id end as id,
  case when event_id % 11 <> 0 and event_id % 5 <> 0 then user_id end as "user",
  case when event_id % 11 <> 0 then event_type end as channel,
  case when event_id % 11 = 0 then null when event_id % 5 = 0 then 'u' || user_id else cast(user_id as varchar) end as raw_user,
  case when event_id % 11 <> 0 and event_id % 5 <> 0 and event_id % 7 = 0 then event_type end as raw_later,
  event_id % 11 = 0 or event_id % 5 = 0 as marked
from events"""
ORACLES["payload_array"] = """
select event_id as id, user_id as "user", event_type as channel from events
union all select -event_id, user_id, event_type from events where event_id % 3 = 0"""
ORACLES["bronze_with_quarantine"] = """
select event_id as "_offset", case when event_id % 11 <> 0 then event_id end as id,
  case when event_id % 11 = 0 then '{not json ' || event_id end as garbage
from events"""
ORACLES["topic_schema"] = (
    """
with fields as (select unnest(['@timestamp', 'message', 'agent:hostname', 'event:action', 'log:level',
  'winlog:channel', 'winlog:event_id', 'winlog:task', 'winlog:process:pid', """
    + ", ".join(f"'winlog:event_data:{name}'" for name in EVENT_DATA)
    + """]) as field)
select field, 'string' as type from fields
union all select 'rid', 'bigint'"""
)
DRIFT = """
with sent as (
  select cast(date '2024-01-01' + cast(27 - event_id % 28 as integer) as date) as day, event_id, user_id, event_type, event_id % 11 = 0 as garbage
  from events
), held as (
  select day, '' as path, if(garbage, 'CORRUPT', 'OBJECT') as type from sent
  union all select day, 'id', 'BIGINT' from sent where not garbage
  union all select day, 'winlog', 'OBJECT' from sent where not garbage
  union all select day, 'winlog.channel', 'STRING' from sent where not garbage and event_type is not null
  union all select day, 'user', if(event_id % 5 = 0, 'STRING', 'BIGINT') from sent where not garbage and user_id is not null
  union all select day, 'later', 'STRING' from sent
    where not garbage and event_id % 5 <> 0 and event_id % 7 = 0 and event_type is not null
), profile as (select day, path, type, count(*) as messages from held group by all)"""
ORACLES["schema_drift"] = f"{DRIFT}\nselect day, path, type, messages from profile"
ORACLES["schema_drift_versions"] = f"""{DRIFT},
seen as (
  select path, type, min(day) as since, max(day) as last, cast(sum(messages) as bigint) as messages
  from profile where type <> 'CORRUPT' group by path, type
), kinds as (select path, string_agg(type, ',' order by type) as types from seen where path <> '' group by path)
select cast(dense_rank() over (order by since) as integer) as version, since, last, seen.path, type, messages, types,
  case when path = '' then null when contains(types, ',') then 'mixed' when path = 'later' then 'add' else 'keep' end as action
from seen left join kinds using (path)"""
ORACLES["meta_batch"] = with_inputs(
    f"select 'x509_certs' as datasource, true as ingest_time, {CERTS}, true as p_ingest_date from certs", "certs"
)
ORACLES["meta_stream"] = with_inputs(
    'select true as "_ingest_time", rid, event_time as "@timestamp" from wl', "wl"
)
ORACLES["promote_raw"] = with_inputs(
    """select channel as "_sourcetype", event_time as "_event_time", event_date as "_event_date",
  hostname as dvc_hostname, rid from wl""",
    "wl",
)
ORACLES["flatten_events"] = with_inputs(f"select {FLAT} from wl", "wl")
ORACLES["silver_wide"] = with_inputs(f"select {WIDE} from wl", "wl")
ORACLES["prefix_blacklist"] = with_inputs(f"select {LISTED} from listed", "listed")
ORACLES["top_hosts_silver"] = with_inputs("select alexa_top_host from top_silver", "top_silver")
ORACLES["enrich_blacklist"] = with_inputs(
    f'select {CERTS}, {LISTED} from certs left join listed on sha1_fingerprint = "sslbl_SHA1"', "certs", "listed"
)
ORACLES["enrich_top_hosts"] = with_inputs(
    f"select {CERTS}, alexa_top_host from certs left join top_silver on common_name = alexa_top_host",
    "certs",
    "top_silver",
)
ORACLES["exclude_top_hosts"] = with_inputs(
    f"""select {CERTS} from certs c
where not exists (select 1 from top_silver t where t.alexa_top_host = c.common_name)""",
    "certs",
    "top_silver",
)
ORACLES["certs_silver"] = with_inputs(f"select {CERTS}, {LISTED} from silver", "silver")
ORACLES["certs_pipeline"] = with_inputs(
    f"""select 'x509_certs' as datasource, {CERTS},
  cast("sslbl_listingDate" as integer) as "sslbl_listingDate", "sslbl_SHA1", "sslbl_Listingreason" from silver""",
    "silver",
)

SETS = ("subject", "common_name", "rdns", "sha1_fingerprint", "src_ip", "dest_ip")
ISSUER_VALUES = " union ".join(
    f"select issuer, '{name}' as field, {name} as value from silver where issuer is not null" for name in SETS
)


ORACLES["hunt_unique_issuer"] = with_inputs(
    """select v.issuer, v.field, v.value, n."count" from issuer_values v
join (select issuer, count(distinct issuer) as "count" from silver group by issuer) n on n.issuer = v.issuer""",
    "silver",
    issuer_values=ISSUER_VALUES,
)
ORACLES["hunt_issuer_counts"] = with_inputs(
    "select issuer, "
    + ", ".join(f"count(distinct {name}) as {name}" for name in SETS)
    + """, count(distinct issuer) as "count" from silver where issuer is not null group by issuer""",
    "silver",
)
ORACLES["issuer_sketch"] = with_inputs(
    "select issuer, "
    + ", ".join(f"true as {name}" for name in SETS)
    + ", count(*) as certificates from silver where issuer is not null group by issuer",
    "silver",
)
ORACLES["hunt_issuer_values"] = with_inputs(ISSUER_VALUES, "silver")
ORACLES["hunt_single_subject_issuer"] = with_inputs(
    """select issuer, min(subject) as subject, count(subject) as certificates from silver
where issuer is not null group by issuer having count(distinct subject) = 1""",
    "silver",
)
ORACLES["hunt_short_issuer"] = with_inputs(
    """select common_name, subject, issuer, subject_alternative_names, sha1_fingerprint,
  cast(length(issuer) as integer) as length
from silver where length(issuer) < 15 and issuer <> '<Name()>' and common_name <> 'apiserver'
order by length""",
    "silver",
)
ORACLES["hunt_blacklisted"] = with_inputs(
    """select "sslbl_Listingreason", common_name, country, dest_ip, rdns, issuer, sha1_fingerprint,
  not_valid_before, not_valid_after
from silver where "sslbl_SHA1" is not null and "sslbl_SHA1" <> 'null'""",
    "silver",
)


def entropy_views(source: str, key: str, text: str) -> dict[str, str]:
    return {
        "chars": f"select {key} as k, unnest(string_split({text}, '')) as ch from {source}",
        "counts": "select k, count(*) as c from chars where ch <> '' group by k, ch",
        "scores": """select k, round(abs(-sum(p * log2(p))), 6) as score
from (select k, c / sum(c) over (partition by k) as p from counts) s group by k""",
    }


ORACLES["hunt_entropy"] = with_inputs(
    """select common_name, subject, issuer, subject_alternative_names, sha1_fingerprint, score as entropy_score
from silver join scores on k = common_name where length(subject) < 15 and score > 1.5
order by score desc""",
    "silver",
    names="select distinct common_name from silver where common_name is not null",
    **entropy_views("names", "common_name", "common_name"),
)
ORACLES["entropy_documents"] = with_inputs(
    """select doc_id, case when text is null then null else coalesce(score, 0.0) end as entropy
from documents left join scores on k = doc_id""",
    **entropy_views("documents", "doc_id", "text"),
)

ORACLES["cim_missing"] = with_inputs(
    """select rid, ed_Image as "winlog:event_data:Image", 'null' as "winlog:event_data:Company",
  ed_CommandLine as "winlog:event_data:CommandLine" from wl""",
    "wl",
)
ORACLES["cim_literals"] = with_inputs(
    """select rid, '1.0' as event_schema_version, 'winlogbeat-sysmon' as event_schema_file,
  'success' as event_result from wl""",
    "wl",
)
KEPT = """channel as "_sourcetype", event_time as "_event_time", event_date as "_event_date",
  hostname as dvc_hostname, winlog_event_id as event_id, task as event_category_type,
  log_level as event_severity, event_action as event_status"""
ORACLES["cim_rename"] = with_inputs(f"select rid, {KEPT} from wl", "wl")
ORACLES["cim_expr"] = with_inputs(
    """select rid, winlog_event_id as event_id,
  case winlog_event_id when '1' then 'Process Started' when '5' then 'Process Terminated'
    when '18' then 'Pipe Connected' end as event_message,
  hostname || ' ' || winlog_event_id as where_and_what from wl""",
    "wl",
)
ORACLES["cim_rule_text"] = with_inputs(
    """select rid, winlog_event_id as event_id, 'null' as file_company, 'sysmon' as source_kind,
  winlog_event_id = '22' as is_dns from wl""",
    "wl",
)


#: The body of each silver table's SQL, over the view ``{source}``.
SILVER_BODIES = {"all_silver": f"select {WIDE} from {{source}}"}


def route(table: str, event_ids: str, columns: str) -> str:
    SILVER_BODIES[table] = f"""select {KEPT}, '1.0' as event_schema_version, 'winlogbeat-sysmon' as event_schema_file,
  'success' as event_result, {columns.strip()}
from {{source}} where channel = 'Microsoft-Windows-Sysmon/Operational' and winlog_event_id in ({event_ids})"""
    return with_inputs(SILVER_BODIES[table].format(source="wl"), "wl")


ORACLES["route_process"] = route(
    "process",
    "'1', '5', '18'",
    """
  case winlog_event_id when '1' then 'Process Started' when '5' then 'Process Terminated'
    when '18' then 'Pipe Connected' end as event_message,
  'success' as event_message_result, ed_CommandLine as process_command_line, 'null' as file_company,
  'null' as process_file_directory, 'null' as file_description, ed_Image as process_file_path,
  'null' as process_integrity_level, 'null' as user_logon_guid, 'null' as user_logon_id,
  'null' as file_name_original, 'null' as process_parent_command_line, 'null' as process_parent_file_path,
  'null' as process_parent_guid, 'null' as process_parent_id, 'null' as acting_user_name,
  ed_ProcessId as process_id, 'null' as process_name, 'null' as file_product, 'null' as user_session_id,
  ed_User as user_name, 'null' as file_version, ed_ProcessGuid as process_guid, ed_Hashes as file_hashes,
  ed_PipeName as pipe_name""",
)
ORACLES["bloom_write"] = ORACLES["route_process"]
ORACLES["route_registry"] = route(
    "registry",
    "'12', '13', '14'",
    """
  case winlog_event_id when '12' then 'RegistryKey Create/Delete' when '13' then 'Registry Value Set'
    when '14' then 'Registry Key and Value Rename' end as event_message,
  'null' as event_type, ed_ProcessGuid as process_guid, ed_ProcessId as process_id,
  ed_Image as process_file_path, ed_TargetObject as registry_path, ed_Details as registry_value,
  'null' as registry_key_new_name""",
)
ORACLES["route_service"] = route(
    "service",
    "'4'",
    """
  'Service State Changed' as event_message, ed_State as service_state, 'null' as file_version,
  process_pid""",
)
ORACLES["route_file"] = route(
    "file",
    "'11', '23'",
    """
  '' as event_message, ed_ProcessGuid as process_guid, ed_ProcessId as process_id,
  ed_Image as process_file_path, ed_TargetFilename as file_name, 'null' as file_creation_time,
  ed_User as user_name, ed_Hashes as file_hashes, 'null' as file_is_exe, 'null' as file_archived""",
)
ORACLES["route_network"] = route(
    "network",
    "'3'",
    """
  ed_ProcessGuid as process_guid, ed_ProcessId as process_id, ed_Image as process_file_path,
  ed_User as user_name, ed_Protocol as network_protocol, 'null' as network_initiated,
  'null' as src_ip_is_ipv6, ed_SourceIp as src_ip_addr, 'null' as src_dvc_hostname,
  'null' as src_port_number, 'null' as dst_ip_is_ipv6, ed_DestinationIp as dst_ip_addr,
  'null' as dst_dvc_hostname, ed_DestinationPort as dst_port_number, 'null' as dst_port_name""",
)
ORACLES["route_dns"] = route(
    "dns",
    "'22'",
    """
  'DNS' as event_message, ed_ProcessGuid as process_guid, ed_ProcessId as process_id,
  ed_QueryName as dst_host_name, ed_QueryStatus as dns_response_code, 'null' as dns_response_name,
  ed_Image as process_file_path""",
)
ORACLES["route_wmi"] = route(
    "wmi",
    "'19', '20', '21'",
    """
  case winlog_event_id when '19' then 'WmiEventFilter activity detected'
    when '20' then 'WmiEventConsumer activity detected'
    when '21' then 'WmiEventConsumerToFilter activity detected' end as event_message,
  ed_Operation as wmi_operation, ed_User as user_name, 'null' as wmi_namespace, ed_Name as wmi_filter_name,
  'null' as wmi_query, 'null' as wmi_consumer_name, 'null' as wmi_consumer_type,
  'null' as wmi_consumer_destination, 'null' as wmi_consumer_path, 'null' as wmi_filter_path""",
)

ORACLES["bronze_partitioned"] = with_inputs(
    """select event_date as "_event_date", channel as "_sourcetype", count(*) as events
from delivered group by event_date, channel""",
    "delivered",
)
ORACLES["bronze_partition_list"] = with_inputs(
    """select distinct '_event_date=' || cast(event_date as varchar) || '/_sourcetype='
  || replace(channel, '/', '%2F') as partition from delivered""",
    "delivered",
)


def silver_digest(tables: dict[str, str]) -> str:
    """Per table, day and column the number of rows and the sum of the values' hashes."""
    rows = " union all ".join(
        f"""select '{table}' as silver_table, "_event_date", to_json(t) as row from ({body.format(source="delivered")}) t"""
        for table, body in tables.items()
    )
    return with_inputs(
        """select silver_table, "_event_date", column_name, count(*) as events,
  sum(('0x' || substr(md5(coalesce(row ->> ('$."' || column_name || '"'), '<null>')), 1, 8))::bigint)::bigint as digest
from cells where column_name <> '_event_date' group by silver_table, "_event_date", column_name""",
        "delivered",
        silver_rows=rows,
        cells='select silver_table, "_event_date", unnest(json_keys(row)) as column_name, row from silver_rows',
    )


ORACLES["silver_from_bronze"] = silver_digest(SILVER_BODIES)
ORACLES["stream_silver"] = ORACLES["silver_from_bronze"]
ORACLES["silver_optimized"] = ORACLES["silver_from_bronze"]
ORACLES["stream_fanout"] = ORACLES["silver_from_bronze"]
ORACLES["stream_fanout_compacted"] = ORACLES["silver_from_bronze"]
ORACLES["ingest_twice"] = ORACLES["payload_decode"]
ORACLES["append_evolving"] = with_inputs(
    """select rid, event_date as "_event_date", log_level as "log:level", cast(null as varchar) as "event:action",
  cast(null as varchar) as host from wl
union all
select rid, event_date, null, event_action, hostname from wl""",
    "wl",
)
ORACLES["append_nested"] = with_inputs(
    """select rid, channel as "winlog:channel", cast(null as varchar) as "winlog:event_id",
  cast(null as varchar) as "winlog:task" from wl
union all
select rid, null, winlog_event_id, task from wl""",
    "wl",
)
ORACLES["append_nested_table"] = with_inputs(
    """select rid, channel as "winlog:channel", cast(null as varchar) as "winlog:event_id",
  cast(null as varchar) as "winlog:task", 0 as part from wl
union all
select rid, null, winlog_event_id, null, 1 from wl
union all
select rid, null, winlog_event_id, task, 0 from wl""",
    "wl",
)
ORACLES["stream_evolving"] = with_inputs(
    """select rid, channel as "winlog:channel", cast(null as varchar) as "winlog:event_id",
  cast(null as varchar) as task from wl
union all
select rid, channel, winlog_event_id, task from wl""",
    "wl",
)
ORACLES["zorder_rewrite"] = with_inputs(f"select {WIDE.replace(' message,', '')} from wl", "wl")
ORACLES["unused_files_removed"] = with_inputs(
    """select silver_table, event_date as "_event_date", rid, 1 as copies from wl, (select unnest(['first', 'second']) as silver_table) t""",
    "wl",
)
ORACLES["replace_grown"] = with_inputs(
    """select rid, event_date as "_event_date", channel as "winlog:channel", winlog_event_id as "winlog:event_id" from wl""", "wl"
)
ORACLES["zone_lookup"] = with_inputs(
    f"select {WIDE.replace(' message,', '')} from wl where winlog_event_id between '11' and '14'", "wl"
)
ORACLES["bloom_lookup"] = with_inputs(
    """select rid, ed_User as "user", winlog_event_id as event_id from wl
where ed_User in (select ed_User from wl where rid % 101 = 0)""",
    "wl",
)
ORACLES["optimize_overlapping"] = with_inputs(
    """select 'first' as silver_table, event_date as "_event_date", rid, day(event_date) % 4 = 0 as moved from wl
union all select 'second', event_date, rid, true from wl where day(event_date) % 4 = 0""",
    "wl",
)
for _name in ("certs_refreshed", "certs_table_refreshed"):
    ORACLES[_name] = ORACLES["certs_silver"]
