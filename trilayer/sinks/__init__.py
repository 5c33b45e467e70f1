from trilayer.sinks.scratch import scratch_dir
from trilayer.sinks.tables import (
    SplitTotals,
    replace_partition,
    split_write,
    write_landing,
    write_run_metadata,
    write_table,
)

__all__ = [
    "SplitTotals",
    "replace_partition",
    "scratch_dir",
    "split_write",
    "write_landing",
    "write_run_metadata",
    "write_table",
]
