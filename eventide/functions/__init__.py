from eventide.functions.hashing import (bloom_estimate, bloom_positions, bloom_size,
                                       poly_hash)
from eventide.functions.report import report_text
from eventide.functions.time import (day_of, duration_seconds, epoch_micros,
                                    epoch_millis_text, event_window, format_java_ts,
                                    from_epoch_millis, from_epoch_seconds, hop,
                                    interval, next_day_start, time_bucket)

__all__ = [
    "bloom_estimate", "bloom_positions", "bloom_size", "poly_hash", "report_text",
    "day_of", "duration_seconds", "epoch_micros", "epoch_millis_text", "event_window",
    "format_java_ts", "from_epoch_millis", "from_epoch_seconds", "hop", "interval",
    "next_day_start", "time_bucket",
]
