from keyflow.operators.changelog import fold_changelog, retract_changelog
from keyflow.operators.cooccur import cooccurrence, related_items, rolling_cooccurrence
from keyflow.operators.patterns import adjacent_pairs, fraud_pairs
from keyflow.operators.running import parity_counter, running_average, running_count
from keyflow.operators.scan import add_chunks, next_in_key, running_sums
from keyflow.operators.sql import declare_sales_view, register_sales_view, sales_per_product
from keyflow.operators.windows import (arrival_time, event_time, page_alerts, page_views,
                                       threshold_alerts, window_aggregate, window_count,
                                       window_sum)
from keyflow.operators.wordcount import rolling_word_count, word_count

__all__ = ["fold_changelog", "retract_changelog", "cooccurrence", "related_items",
           "rolling_cooccurrence", "adjacent_pairs", "fraud_pairs", "parity_counter",
           "running_average", "running_count", "add_chunks", "next_in_key", "running_sums",
           "declare_sales_view", "register_sales_view", "sales_per_product", "arrival_time", "event_time",
           "page_alerts", "page_views", "threshold_alerts", "window_aggregate", "window_count",
           "window_sum", "rolling_word_count", "word_count"]
