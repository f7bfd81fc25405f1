"""Item tables, labelled-vector files and result sinks."""

from pairgrade.sources.items import (
    CORRUPT_COL, encode_items, malformed_counts, read_items_csv, split_malformed, tpch_items,
)
from pairgrade.sources.libsvm import checked_lines, read_libsvm, read_libsvm_checked, write_libsvm
from pairgrade.sources.sinks import (
    commit_table, committed_versions, drop_uncommitted, materialize, metric_table, preview, read_committed,
    write_metrics, write_predictions,
)

__all__ = [
    "CORRUPT_COL", "checked_lines", "commit_table", "committed_versions", "drop_uncommitted", "encode_items",
    "malformed_counts", "materialize", "metric_table", "preview", "read_committed", "read_items_csv", "read_libsvm",
    "read_libsvm_checked", "split_malformed", "tpch_items", "write_libsvm", "write_metrics", "write_predictions",
]
