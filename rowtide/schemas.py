"""Column layouts shared by the operators, as Spark DDL."""

from __future__ import annotations

# Operations carried by a message.
SNAPSHOT, INSERT, UPDATE, DELETE = "r", "c", "u", "d"

# Kinds of source object.
TABLE, PART_ROOT, VIEW, MATVIEW = "table", "part_root", "view", "matview"
CDC_KINDS = (TABLE, PART_ROOT)

# Kinds of change-log message.
RELATION_MSG, INSERT_MSG, UPDATE_MSG, DELETE_MSG = "R", "I", "U", "D"
TRUNCATE_MSG, COMMIT_MSG, KEEPALIVE_MSG = "T", "C", "K"
ROW_MSGS = (INSERT_MSG, UPDATE_MSG, DELETE_MSG)

COLUMN = "struct<name:string,type_oid:bigint,flags:int>"
RELATION = f"struct<namespace:string,name:string,columns:array<{COLUMN}>>"
TUPLE = "array<struct<status:string,data:string>>"

# A landed log message. Positions are the server's text form; `commit_lsn` is
# set on every row of a transaction and NULL on keepalives. `ord` counts row
# changes inside the transaction; a relation message takes the `ord` of the
# change that follows it and sorts before that change.
CHANGE_LOG = (
    "arrival bigint, kind string, xid bigint, commit_lsn string, ord bigint, "
    "wal_start string, wal_end string, relation_id bigint, "
    f"relation_ids array<bigint>, relation {RELATION}, "
    f"old_tuple {TUPLE}, new_tuple {TUPLE}, reply_requested boolean"
)

# The same message with numeric positions, which is how the log is stored:
# position filters then reach the parquet scan.
POSITIONED_FIELDS = {
    "arrival": "bigint",
    "kind": "string",
    "xid": "bigint",
    "commit_pos": "bigint",
    "ord": "bigint",
    "wal_pos": "bigint",
    "end_pos": "bigint",
    "relation_id": "bigint",
    "relation_ids": "array<bigint>",
    "relation": RELATION,
    "old_tuple": TUPLE,
    "new_tuple": TUPLE,
    "reply_requested": "boolean",
}
POSITIONED_LOG = ", ".join(f"{name} {ddl}" for name, ddl in POSITIONED_FIELDS.items())

# Published message. `value` is NULL for a tombstone. Snapshot rows carry the
# snapshot's position and `ord` -1, so any later change sorts after them.
MESSAGE = (
    "table string, op string, key string, value string, "
    "commit_pos bigint, ord bigint, ts bigint, lsn string"
)

OBJECT = "schema string, name string, kind string, pk_columns array<string>"

STATE_LOG = "unit string, done boolean, last_pk string, saved_at timestamp"
# As stored, with the order in which states were saved.
STORED_STATE = f"{STATE_LOG}, seq bigint"

# One record of the compacted checkpoint topic, in the layout of a Kafka source.
TOPIC_RECORD = "partition int, offset bigint, key string, value string"

SLOT_STATUS = (
    "sampled_at timestamp, slot_name string, active boolean, "
    "restart_lsn string, confirmed_flush_lsn string, current_wal_lsn string"
)

CATALOG = {
    "pg_namespace": "oid bigint, nspname string",
    "pg_class": "oid bigint, relnamespace bigint, relname string, relkind string",
    "pg_index": (
        "indrelid bigint, indkey array<int>, indnkeyatts int, indisprimary boolean"
    ),
    "pg_attribute": "attrelid bigint, attnum int, attname string",
    "pg_inherits": "inhrelid bigint, inhparent bigint",
    "pg_publication": "oid bigint, pubname string",
    "pg_publication_rel": "prpubid bigint, prrelid bigint",
    "pg_replication_slots": "slot_name string, confirmed_flush_lsn string",
}
