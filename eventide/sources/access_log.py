"""Space-separated web access log (SRC-6, SC-1, SC-5).

Positional fields: 0 ip, 1 user, 3 time ``dd/MM/yyyy:HH:mm:ss``, 5 method,
6 url.  Field 2 and 4 are unused.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: time layout of field 3 (the reference's pattern with a 4-digit year).
ACCESS_LOG_TIME_FORMAT = "dd/MM/yyyy:HH:mm:ss"


def parse_access_log(lines: DataFrame, value_col: str = "value",
                     time_format: str = ACCESS_LOG_TIME_FORMAT) -> DataFrame:
    parts = F.split(F.col(value_col), " ")
    return lines.select(
        F.trim(parts[0]).alias("ip"),
        F.trim(parts[1]).alias("user_id"),
        F.to_timestamp(F.trim(parts[3]), time_format).alias("ts"),
        F.trim(parts[5]).alias("method"),
        F.trim(parts[6]).alias("url"),
    )


def read_access_log(spark: SparkSession, path, time_format: str = ACCESS_LOG_TIME_FORMAT
                    ) -> DataFrame:
    return parse_access_log(spark.read.text(path), time_format=time_format)


def read_access_log_stream(spark: SparkSession, path: str,
                           time_format: str = ACCESS_LOG_TIME_FORMAT) -> DataFrame:
    return parse_access_log(spark.readStream.text(path), time_format=time_format)


def format_access_log(df: DataFrame, ip="ip", user="user_id", ts="ts", method="method",
                      url="url", time_format: str = ACCESS_LOG_TIME_FORMAT) -> DataFrame:
    """Records -> access-log lines (fields 2 and 4 written as '-' and '+0000')."""
    return df.select(F.concat_ws(
        " ", F.col(ip), F.col(user), F.lit("-"), F.date_format(F.col(ts), time_format),
        F.lit("+0000"), F.col(method), F.col(url)).alias("value"))
