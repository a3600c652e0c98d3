from eventide.sources.access_log import (format_access_log, parse_access_log,
                                        read_access_log, read_access_log_stream)
from eventide.sources.delimited import (format_lines, parse_lines, read_delimited,
                                        read_delimited_stream, to_typed)
from eventide.sources.kafka import (kafka_sink_options, kafka_source_options, kafka_values,
                                    read_kafka_records, to_kafka_value)
from eventide.sources.lines import lines_as, read_line_stream

__all__ = [
    "format_access_log", "parse_access_log", "read_access_log", "read_access_log_stream",
    "format_lines", "parse_lines", "read_delimited", "read_delimited_stream", "to_typed",
    "kafka_sink_options", "kafka_source_options", "kafka_values", "read_kafka_records",
    "to_kafka_value", "lines_as", "read_line_stream",
]
