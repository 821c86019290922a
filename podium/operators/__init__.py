from podium.operators.clean import drop_duplicate_rows, drop_missing, normalize_text
from podium.operators.enrich import avg_stats
from podium.operators.ledger import (
    append_count,
    count_pairs,
    count_pairs_jdbc,
    count_where,
    is_fresh,
    recent_entry,
)

__all__ = [
    "append_count",
    "avg_stats",
    "count_pairs",
    "count_pairs_jdbc",
    "count_where",
    "drop_duplicate_rows",
    "drop_missing",
    "is_fresh",
    "normalize_text",
    "recent_entry",
]
