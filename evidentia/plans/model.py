"""The thirteen event objects: actions, fields and stored schemas.

Fixed values: names as the event model has them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HEADER = [
    "timestamp", "car_action", "guid", "owning_guid", "volume_guid", "mac_address", "device_serial", "link_confidence", "source_artefact",
    "source_host", "native",
]

ACTIONS = {
    "authentication": ["success", "failure", "error"],
    "driver": ["load", "metadata", "unload"],
    "email": ["deliver", "block", "redirect", "quarantine", "delete"],
    "file": ["access", "acl_modify", "content", "create", "delete", "metadata", "modify", "read", "timestomp", "write"],
    "flow": ["content", "create", "end", "flow", "message", "start"],
    "http": ["get", "post", "put", "tunnel"],
    "module": ["content", "load", "metadata", "unload"],
    "process": ["access", "create", "execute", "metadata", "modify", "terminate"],
    "registry": ["access", "add", "create", "delete", "key_edit", "modify", "remove", "value_edit"],
    "service": ["access", "create", "delete", "enumerate", "metadata", "modify", "pause", "start", "stop"],
    "socket": ["bind", "listen", "close"],
    "thread": ["create", "suspend", "terminate", "remote_create"],
    "user_session": ["create", "lock", "login", "logout", "metadata", "reconnect", "terminate", "unlock"],
}
FIELDS = {
    "authentication": [
        "app_name", "method", "auth_service", "auth_target", "target_ad_domain", "decision_reason", "response_time", "fqdn", "hostname", "ad_domain",
        "uid", "user_role", "user_type", "user", "user_agent", "target_uid", "target_user_role", "target_user_type", "target_user",
    ],
    "driver": ["fqdn", "hostname", "base_address", "image_path", "md5_hash", "sha1_hash", "sha256_hash", "module_name", "signer", "pid", "signature_valid"],
    "email": [
        "action_reason", "attachment_name", "attachment_size", "attachment_mime_type", "dest_ip", "dest_port", "dest_address", "date", "server_relay",
        "from", "smtp_uid", "message_links", "src_address", "src_domain", "return_address", "message_body", "subject", "src_ip", "src_port",
        "message_type", "to",
    ],
    "file": [
        "creation_time", "file_name", "fqdn", "hostname", "image_path", "md5_hash", "sha1_hash", "sha256_hash", "pid", "ppid",
        "previous_creation_time", "signer", "user", "company", "file_path", "owner_uid", "owner", "content", "extension", "gid", "group",
        "link_target", "mime_type", "mode", "signature_valid", "uid",
    ],
    "flow": [
        "fqdn", "hostname", "content", "dest_ip", "dest_port", "src_ip", "src_port", "start_time", "end_time", "exe", "image_path", "packet_count",
        "pid", "ppid", "proto_info", "user", "src_fqdn", "src_hostname", "dest_fqdn", "dest_hostname", "application_protocol", "in_bytes",
        "out_bytes", "network_direction", "tcp_flags", "transport_protocol", "uid",
    ],
    "http": [
        "hostname", "request_body_bytes", "http_version", "request_body_content", "request_referrer", "requester_ip_address", "response_body_bytes",
        "response_body_content", "response_status_code", "url_full", "url_domain", "url_remainder", "url_scheme", "user_agent_full",
        "user_agent_name", "user_agent_device", "user_agent_version",
    ],
    "module": [
        "fqdn", "hostname", "base_address", "image_path", "md5_hash", "sha1_hash", "sha256_hash", "module_path", "module_name", "pid", "signer",
        "tid", "signature_valid",
    ],
    "process": [
        "fqdn", "hostname", "command_line", "exe", "image_path", "md5_hash", "sha1_hash", "sha256_hash", "parent_exe", "parent_image_path", "pid",
        "ppid", "sid", "signer", "user", "integrity_level", "parent_command_line", "current_working_directory", "env_vars", "access_level",
        "call_trace", "parent_guid", "signature_valid", "target_guid", "target_pid", "target_address", "target_name", "uid",
    ],
    "registry": ["fqdn", "hostname", "key", "value", "data", "type", "hive", "image_path", "pid", "user", "new_content"],
    "service": ["fqdn", "hostname", "user", "command_line", "exe", "image_path", "name", "pid", "ppid", "uid"],
    "socket": ["pid", "image_path", "success", "family", "protocol", "local_address", "local_port", "remote_port", "remote_address", "local_path"],
    "thread": [
        "hostname", "src_pid", "src_tid", "tgt_pid", "tgt_tid", "stack_base", "stack_limit", "start_address", "user", "user_stack_base",
        "user_stack_limit", "start_function", "start_module", "start_module_name", "uid",
    ],
    "user_session": ["dest_ip", "dest_port", "hostname", "login_id", "src_ip", "src_port", "user", "login_type", "uid", "login_successful"],
}
#: Verb of an owner's edge to what it did, by object and action; `accessed` otherwise.
VERBS = {
    "file": {"access": "accessed", "create": "created", "read": "accessed", "write": "modified", "modify": "modified", "delete": "deleted", "acl_modify": "modified", "timestomp": "modified", "content": "retrieved information about", "metadata": "retrieved information about"},
    "registry": {"add": "created", "remove": "deleted", "value_edit": "modified", "key_edit": "modified", "access": "accessed", "create": "created", "delete": "deleted", "modify": "modified"},
    "module": {"load": "loaded", "unload": "unloaded", "content": "retrieved information about", "metadata": "retrieved information about"},
    "driver": {"load": "loaded", "unload": "unloaded", "metadata": "retrieved information about"},
    "flow": {"start": "connected to", "message": "connected to", "end": "connected to", "create": "connected to", "content": "connected to", "flow": "connected to"},
    "service": {"create": "created", "stop": "stopped", "start": "started", "delete": "deleted", "modify": "modified", "enumerate": "listed", "metadata": "retrieved information about", "access": "accessed", "pause": "modified"},
    "thread": {"remote_create": "created", "create": "created", "terminate": "terminated", "suspend": "accessed"},
    "http": {"get": "created", "post": "created", "put": "created", "tunnel": "connected to"},
    "socket": {"bind": "bound to", "listen": "listened on", "close": "terminated"},
    "user_session": {"login": "created", "reconnect": "created", "logout": "terminated", "unlock": "unlocked", "lock": "locked", "create": "created", "terminate": "terminated", "metadata": "retrieved information about"},
    "authentication": {"success": "requested", "failure": "requested", "error": "requested"},
    "email": {"deliver": "created", "block": "stopped", "redirect": "modified", "quarantine": "locked", "delete": "deleted"},
}
#: Facts of a relation by the object and action of its row, or by its kind; where a row has them, strongest first.
ASSOCIATIONS = {
    "file/access": {"access_level": ["native.GrantedAccess"], "handle_value": ["native.HandleValue"]},
    "file/timestomp": {"previous_creation_time": ["previous_creation_time"]},
    "file/acl_modify": {"previous_acl": ["native.OldSd"], "new_acl": ["native.NewSd"]},
    "registry/value_edit": {"new_content": ["new_content"]},
    "registry/key_edit": {"new_content": ["new_content"]},
    "module/load": {"base_address": ["base_address"], "tid": ["tid"]},
    "driver/load": {"base_address": ["base_address"]},
    "edge:process_access": {"access_level": ["access_level", "native.GrantedAccess"], "call_trace": ["call_trace", "native.CallTrace"], "target_address": ["target_address"]},
    "edge:thread_injection": {"start_address": ["start_address", "native.StartAddress"], "start_function": ["start_function", "native.StartFunction"], "start_module": ["start_module", "native.StartModule"], "new_thread_id": ["tgt_tid", "native.NewThreadId"]},
}
EDGE = [
    "timestamp", "source_host", "relationship", "source_object", "source_guid", "target_object", "target_guid", "confidence", "method", "class",
    "identity_key", "inferred_end", "corroborated_by", "properties",
]
#: What a spoke, a process and a flow's spoke take over from what they are linked to.
OWNER_INHERITS = ["exe", "image_path", "command_line", "user", "sid", "fqdn", "hostname", "ppid"]
PARENT_INHERITS = {"exe": "parent_exe", "image_path": "parent_image_path", "command_line": "parent_command_line"}
FLOW_INHERITS = {"src_ip": "requester_ip_address", "src_hostname": "hostname"}


def columns(kind: str) -> list[str]:
    return HEADER + [f for f in FIELDS[kind] if f not in HEADER]


def schema(kind: str) -> T.StructType:
    """Stored schema: texts, but for the native bag."""
    return T.StructType([T.StructField(c, T.MapType(T.StringType(), T.StringType()) if c == "native" else T.StringType()) for c in columns(kind)] + [T.StructField("car_object", T.StringType())])


def conform(events: DataFrame, kind: str) -> DataFrame:
    """Rows of one object with exactly its columns: absent ones null, unknown ones left out."""
    have = set(events.columns)
    out = [(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema(kind) if f.name != "car_object"]
    return events.where(F.col("car_object") == kind).select(*out, "car_object")
