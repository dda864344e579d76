from oreflow.sinks.evolution import append_evolved, merged_schema, overwrite_evolved, read_evolved
from oreflow.sinks.landing import land_snapshot, snapshot_of
from oreflow.sinks.publish import ExpectationFailed, VersionClaimed, publish, read_published, rule_history
from oreflow.sinks.tables import (
    append_merged, describe_table, document_columns, ensure_table, read_merged, replace_table_as, save_table, table_comments,
    write_partitioned,
)

__all__ = [
    "append_evolved", "merged_schema", "overwrite_evolved", "read_evolved",
    "land_snapshot", "snapshot_of",
    "ExpectationFailed", "VersionClaimed", "publish", "read_published", "rule_history",
    "append_merged", "describe_table", "document_columns", "ensure_table", "read_merged",
    "replace_table_as", "save_table", "table_comments", "write_partitioned",
]
