"""DataFrame -> DataFrame operators."""

from cyclemart.operators.aggregates import commission_by_agent_policy, observe_rows, row_count
from cyclemart.operators.audit import (
    audit_entries, batch_summary, cycle_completeness, expire, parse_arrivals, update_status,
    upsert_audit,
)
from cyclemart.operators.dedup import (
    distinct_key_count, duplicate_keys, has_duplicate_keys, keep_first, latest_per_key,
)
from cyclemart.operators.filters import (
    apply_filters, policy_filter, transaction_filter, with_audit_columns, with_commission,
)
from cyclemart.operators.joins import (
    COMMISSION_STAR, JoinStep, StarJoin, broadcast_join, join, sort_merge_join,
)
from cyclemart.operators.merge import (
    VersionedTable, initial_load, integrity_ok, merge_counts, merge_or_init, scd1_merge,
)
from cyclemart.operators.quality import (
    QualityError, assert_no_failures, evaluate, evaluate_tables, report_frame, run_gate,
)

__all__ = [n for n in dir() if not n.startswith("_")]
