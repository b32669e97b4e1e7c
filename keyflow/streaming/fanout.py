"""One parsed input, two labelled outputs (O-12): page views and traffic alerts.

Each line is read and parsed once.  Every page view is put into its windows of both
kinds, tagged with the output they belong to, and one streaming aggregate (partial
counts before the shuffle) keeps all window counts; one ``foreachBatch`` writes the
tagged rows to a folder per output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from keyflow.functions.formats import alert_text
from keyflow.functions.parse import parse_page_log
from keyflow.streaming.resume import latest_of

#: Seconds of the units that a window size may be given in.
UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def seconds(size: str) -> int:
    """``"5 seconds"``, ``"1 hour"`` ... as seconds."""
    number, unit = size.split()
    return int(number) * UNITS[unit.rstrip("s")]


def tagged_windows(ts: str, output: str, size: str, slide: str | None = None) -> Column:
    """All windows of a row's time, as an array of (output, window_start, window_end)."""
    length, step = seconds(size) * 1_000_000, seconds(slide or size) * 1_000_000
    us = F.unix_micros(ts)
    last = us - F.pmod(us, F.lit(step))
    starts = [last - i * step for i in range(-(-length // step))]
    windows = F.array(*[F.struct(F.lit(output).alias("output"), F.timestamp_micros(s).alias("window_start"),
                                 F.timestamp_micros(s + length).alias("window_end")) for s in starts])
    return F.filter(windows, lambda w: F.unix_micros(w["window_end"]) > us)


def start_page_analysis(lines: DataFrame, base: str, arrival: str = "arrival",
                        delay: str = "0 seconds", view_size: str = "10 seconds",
                        view_slide: str = "5 seconds", alert_size: str = "5 seconds",
                        threshold: int = 100, available_now: bool = True) -> StreamingQuery:
    """Start the query; its outputs ``views`` and ``alerts`` (see :func:`read_output`) and checkpoint are under ``base``.

    ``lines`` holds a ``line`` text column and an ``arrival`` timestamp (e.g.
    ``current_timestamp()`` for processing time, as the reference uses).  The
    watermark follows the window ends, ``delay`` and the longest window behind, so
    no row within ``delay`` is dropped, and counts are kept that much longer.
    """
    longest = max(view_size, alert_size, key=seconds)
    windows = F.concat(tagged_windows(arrival, "views", view_size, view_slide), tagged_windows(arrival, "alerts", alert_size))
    pages = parse_page_log(lines, "line", keep=(arrival,))
    placed = (pages.select("page", F.explode(windows).alias("w")).select("page", "w.*")
                   .withWatermark("window_end", f"{seconds(delay) + seconds(longest)} seconds"))
    counts = placed.groupBy("output", "window_start", "window_end", "page").agg(F.count(F.lit(1)).alias("cnt"))

    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.filter((F.col("output") == "views") | (F.col("cnt") > threshold))
              .withColumn("alert", F.when(F.col("output") == "alerts", alert_text("page", "cnt")))
              .write.mode("overwrite").partitionBy("output").parquet(f"{base}/outputs/batch_id={batch_id}"))

    writer = (counts.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", f"{base}/checkpoint"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


OUTPUT = "window_start timestamp, window_end timestamp, page string, cnt long, alert string, batch_id long, output string"


def read_output(spark: SparkSession, base: str, output: str) -> DataFrame:
    """The last count of every window and page of one output; alerts have their text."""
    rows = spark.read.schema(OUTPUT).parquet(f"{base}/outputs").filter(F.col("output") == output).drop("output")
    latest = latest_of(rows, ["window_start", "page"])
    return latest if output == "alerts" else latest.drop("alert")
