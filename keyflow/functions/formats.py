"""Message texts built with ``concat`` (JVM-side, no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Output texts of the reference programs, kept verbatim.
ALERT_PREFIX = "[告警] 页面 "
ALERT_MIDDLE = " 访问量异常: "
FRAUD_HEAD = "Potential Fraud Detected for Card: "
FRAUD_FIRST = " - Transaction 1: "
FRAUD_SECOND = " - Transaction 2: "
FRAUD_AT = " at "
FRAUD_TIME_OPEN = " (Time: "
FRAUD_TIME_CLOSE = ")"
COUNTER_KEY = "Key: "
COUNTER_VALUE = ", Value: "
COUNTER_COUNT = ", CountForThisKey: "
EVENT_LABEL = "Event-"


def _s(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def alert_text(page: str | Column, count: str | Column) -> Column:
    return F.concat(F.lit(ALERT_PREFIX), _s(page), F.lit(ALERT_MIDDLE), _s(count))


def fraud_text(card, amount1, location1, millis1, amount2, location2, millis2) -> Column:
    return F.concat(F.lit(FRAUD_HEAD), _s(card),
                    F.lit(FRAUD_FIRST), _s(amount1), F.lit(FRAUD_AT), _s(location1),
                    F.lit(FRAUD_TIME_OPEN), _s(millis1), F.lit(FRAUD_TIME_CLOSE),
                    F.lit(FRAUD_SECOND), _s(amount2), F.lit(FRAUD_AT), _s(location2),
                    F.lit(FRAUD_TIME_OPEN), _s(millis2), F.lit(FRAUD_TIME_CLOSE))


def counter_text(key, value, count) -> Column:
    return F.concat(F.lit(COUNTER_KEY), _s(key), F.lit(COUNTER_VALUE), _s(value),
                    F.lit(COUNTER_COUNT), _s(count))


def event_label(n: str | Column) -> Column:
    return F.concat(F.lit(EVENT_LABEL), _s(n))
