"""Record schemas (snake_case) for the delimited inputs.

Event time is stored as ``ts timestamp``; the raw files carry epoch seconds
(or milliseconds for the marketing events) and the readers convert.
"""

from pyspark.sql import types as T

L, I, S, TS = T.LongType(), T.IntegerType(), T.StringType(), T.TimestampType()


def _struct(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Raw positional layouts of the headerless files (what the reader parses).
USER_BEHAVIOR_RAW = _struct(("user_id", L), ("item_id", L), ("category_id", I),
                            ("behavior", S), ("ts_s", L))
AD_CLICK_RAW = _struct(("user_id", L), ("ad_id", L), ("province", S), ("city", S),
                       ("ts_s", L))
LOGIN_RAW = _struct(("user_id", L), ("ip", S), ("event_type", S), ("ts_s", L))
ORDER_RAW = _struct(("order_id", L), ("event_type", S), ("tx_id", S), ("ts_s", L))
RECEIPT_RAW = _struct(("tx_id", S), ("pay_channel", S), ("ts_s", L))
MARKETING_RAW = _struct(("user_id", S), ("behavior", S), ("channel", S), ("ts_ms", L))

# Typed records after the reader (epoch -> timestamp).
USER_BEHAVIOR = _struct(("user_id", L), ("item_id", L), ("category_id", I),
                        ("behavior", S), ("ts", TS))
AD_CLICK = _struct(("user_id", L), ("ad_id", L), ("province", S), ("city", S), ("ts", TS))
LOGIN = _struct(("user_id", L), ("ip", S), ("event_type", S), ("ts", TS))
ORDER = _struct(("order_id", L), ("event_type", S), ("tx_id", S), ("ts", TS))
RECEIPT = _struct(("tx_id", S), ("pay_channel", S), ("ts", TS))
MARKETING = _struct(("user_id", S), ("behavior", S), ("channel", S), ("ts", TS))
ACCESS_LOG = _struct(("ip", S), ("user_id", S), ("ts", TS), ("method", S), ("url", S))

# Outputs.
WARNING = _struct(("user_id", L), ("first_fail_ts", TS), ("last_fail_ts", TS), ("msg", S))
BLACKLIST_WARNING = _struct(("user_id", L), ("ad_id", L), ("msg", S))
ORDER_RESULT = _struct(("order_id", L), ("result_msg", S))

# Name -> (raw layout, epoch column, epoch unit)
RAW_LAYOUTS = {
    "user_behavior": (USER_BEHAVIOR_RAW, "ts_s", "s"),
    "ad_click": (AD_CLICK_RAW, "ts_s", "s"),
    "login": (LOGIN_RAW, "ts_s", "s"),
    "order": (ORDER_RAW, "ts_s", "s"),
    "receipt": (RECEIPT_RAW, "ts_s", "s"),
    "marketing": (MARKETING_RAW, "ts_ms", "ms"),
}
