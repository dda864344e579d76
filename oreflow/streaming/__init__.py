from oreflow.streaming.changes import apply_changes, compact_changes, read_current
from oreflow.streaming.dedup import dedup_within_watermark
from oreflow.streaming.ingest import await_all, read_rule_counts, run_available_now, start_available_now, start_checked
from oreflow.streaming.late import dedup_with_late, read_kept, read_late, read_progress

__all__ = ["apply_changes", "compact_changes", "read_current", "dedup_within_watermark",
           "dedup_with_late", "read_kept", "read_late", "read_progress",
           "await_all", "read_rule_counts", "run_available_now", "start_available_now", "start_checked"]
