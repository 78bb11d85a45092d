"""Schemas of messages, changes and output records."""

from __future__ import annotations

#: One value of a tuple as logged: kind n (null), u (unchanged, not sent) or t (text).
CELL = "struct<kind:string,text:string>"
COLUMN = "struct<name:string,type_oid:bigint,is_key:boolean>"
RELATION = f"struct<schema:string,table:string,columns:array<{COLUMN}>>"
#: A decoded message of a replication slot. msg: B begin, C commit, R relation, I, U, D changes, T truncate, Y type,
#: O origin. B has the final LSN and commit time in lsn and commit_ts, C its own; changes have wal_start alone.
MESSAGE = f"slot string, seq bigint, wal_start bigint, msg string, xid bigint, lsn bigint, commit_ts timestamp, rel_id bigint, rel {RELATION}, before array<{CELL}>, after array<{CELL}>"
#: A decoded cell with its column.
VALUE = "struct<name:string,type_oid:bigint,kind:string,text:string,is_key:boolean>"
#: Output records, in the order of their fields.
ENVELOPE = ("source", "database", "schema", "table", "op", "txid", "lsn", "commit_ts", "snapshot", "key", "before", "after")
MARKER = ("source", "database", "op", "txid", "lsn", "commit_ts", "event_count")
HEARTBEAT = ("source", "database", "timestamp", "lsn")
RECORD = "topic string, key string, value string"
PROGRESS = "lsn bigint, timestamp timestamp"
#: Operations: create, update, delete, snapshot read.
OPS = ("c", "u", "d", "r")
CHANGE_MESSAGES = {"I": "c", "U": "u", "D": "d"}
#: What stands for a value that the log did not send, where such values aren't left out.
UNCHANGED = "__toast_unchanged"
#: Type numbers of the database.
UUID_OID, UUID_ARRAY_OID = 2950, 2951
BOOLEAN_OID, INTEGER_OIDS, NUMBER_OIDS, JSON_OIDS = 16, (20, 21, 23, 26), (700, 701, 1700), (114, 3802)
MULTIRANGE_OIDS = (4451, 4532, 4533, 4534, 4535, 4536)
