from keyflow.functions.text import (lower_text, text_length, tokenize, upper_text, utf16_length,
                                    word_array)
from keyflow.functions.parse import (accepted, parse_behavior, parse_behavior_json, parse_page_log,
                                     rejected, split_fields)
from keyflow.functions.formats import alert_text, counter_text, event_label, fraud_text
from keyflow.functions.numeric import (doubled, exact_decimal, failure_point, guarded_double,
                                       guarded_double_strict, is_even, parity)

__all__ = ["lower_text", "text_length", "tokenize", "upper_text", "utf16_length", "word_array",
           "accepted", "parse_behavior", "parse_behavior_json", "parse_page_log", "rejected",
           "split_fields", "alert_text", "counter_text", "event_label", "fraud_text", "doubled", "exact_decimal",
           "failure_point", "guarded_double", "guarded_double_strict", "is_even", "parity"]
