"""DataFrame → DataFrame operators."""

from pricekit.operators.audit import drop_audit_columns, with_audit_columns
from pricekit.operators.conform import (
    FeedSpec,
    canonical_clusters,
    conform_all,
    conform_feed,
    spec_for,
    union_feeds,
)
from pricekit.operators.expand import enrich, expand_by_rule
from pricekit.operators.latest import (
    dedupe_keys,
    latest_per_key,
    latest_period,
    latest_row,
    merge_latest,
    rows_of_latest_period,
)
from pricekit.operators.quality import (
    QualityGateError,
    gate,
    qc_check,
    qc_metrics,
    qc_status,
    rules_frame,
    run_qc,
)

__all__ = [
    "FeedSpec", "QualityGateError", "canonical_clusters", "conform_all", "conform_feed",
    "dedupe_keys", "drop_audit_columns", "enrich", "expand_by_rule", "gate", "latest_per_key",
    "latest_period", "latest_row", "merge_latest", "qc_check", "qc_metrics", "qc_status",
    "rows_of_latest_period", "rules_frame", "run_qc", "spec_for", "union_feeds",
    "with_audit_columns",
]
