from keyflow.sources.tables import (SCHEMAS, TABLES, behavior_lines, load, page_log_lines,
                                   table_path)
from keyflow.sources.streams import (kafka_options, kafka_values, micro_batch_rate, rate_stream,
                                    socket_options, stream_table, text_stream)

__all__ = ["SCHEMAS", "TABLES", "behavior_lines", "load", "page_log_lines", "table_path",
           "kafka_options", "kafka_values", "micro_batch_rate", "rate_stream", "socket_options", "stream_table",
           "text_stream"]
