from eventide.operators.distinct import (bitmap_counts, merge_bitmaps, uv_bitmap, uv_bloom,
                                         uv_exact, uv_hll, window_bitmaps)
from eventide.operators.gate import click_gate, gate_passed, gate_warnings
from eventide.operators.orders import decide_at_deadline, order_outcomes
from eventide.operators.pattern import Stage, match_pattern
from eventide.operators.reconciliation import reconcile, reconcile_once, with_tx
from eventide.operators.sequence import burst_warnings, followed_by, match_sequence, strict_next
from eventide.operators.topn import hot_items, ranked_report, top_n_per_window, url_ranking
from eventide.operators.windows import (count_by_key_per_window, marketing_by_channel,
                                        marketing_total, page_views, running_count,
                                        windowed_count, words)

__all__ = [
    "bitmap_counts", "merge_bitmaps", "uv_bitmap", "uv_bloom", "uv_exact", "uv_hll",
    "window_bitmaps", "click_gate", "gate_passed", "gate_warnings", "decide_at_deadline",
    "order_outcomes", "reconcile", "reconcile_once", "with_tx", "burst_warnings", "followed_by", "match_sequence", "match_pattern", "Stage",
    "strict_next",
    "hot_items", "ranked_report", "top_n_per_window", "url_ranking",
    "count_by_key_per_window", "marketing_by_channel", "marketing_total", "page_views",
    "running_count", "windowed_count", "words",
]
