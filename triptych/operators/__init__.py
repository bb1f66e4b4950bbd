"""DataFrame operators that work on any table."""

from triptych.operators.distinct import count_with_distinct
from triptych.operators.medians import exact_medians
from triptych.operators.metrics import measure_metrics
from triptych.operators.ranking import ordered, top_rows
from triptych.operators.reports import as_metric_rows, known_counts, quality_stats, table_counts
from triptych.operators.share import share_of_total

__all__ = [
    "as_metric_rows",
    "count_with_distinct",
    "exact_medians",
    "known_counts",
    "measure_metrics",
    "ordered",
    "quality_stats",
    "share_of_total",
    "table_counts",
    "top_rows",
]
