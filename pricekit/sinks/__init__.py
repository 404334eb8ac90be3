"""Sinks: table writes with mode, schema guard, staging and recovery, key buckets, audit log."""

from pricekit.sinks.tables import (
    SchemaMismatchError,
    append_audit,
    append_once,
    drop_table,
    publish,
    recover_publish,
    write_table,
)

__all__ = ["SchemaMismatchError", "append_audit", "append_once", "drop_table", "publish", "recover_publish", "write_table"]
