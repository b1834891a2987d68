from skyledger.sinks.publish import publish, published_root
from skyledger.sinks.tables import (
    Store,
    batch_writer,
    carry_forward,
    compact_changes,
    has_results,
    prune_results,
    read_changes,
    read_latest,
    read_table,
    write_table,
    write_to_store,
)

__all__ = [
    "Store", "batch_writer", "carry_forward", "compact_changes", "has_results", "prune_results", "publish", "published_root", "read_changes", "read_latest", "read_table",
    "write_table", "write_to_store",
]
