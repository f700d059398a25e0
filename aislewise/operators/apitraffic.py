"""API requests per machine and minute."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aislewise.functions import logline as L


def api_line_fields(lines: DataFrame, domain: str, year: int, keep: list[str] | None = None) -> DataFrame:
    """(ts, machine, is_product, keep...); the log's time has no year, so it is a parameter."""
    keep = keep or []
    line = F.col("line")
    fields = lines.select(
        L.api_time_text(line).alias("time_text"),
        L.api_machine(line).alias("machine"),
        L.is_product_request(line, domain).alias("is_product"), *keep,
    )
    # "Sep  4 00:00:05" -> "2014 Sep 4 00:00:05"
    text = F.concat(F.lit(f"{year} "), F.regexp_replace("time_text", " +", " "))
    ts = F.try_to_timestamp(text, F.lit("yyyy MMM d HH:mm:ss"))
    return fields.select(ts.alias("ts"), "machine", "is_product", *keep).where(
        F.col("ts").isNotNull() & (F.col("machine") != "")
    )


def api_traffic_per_minute(fields: DataFrame) -> DataFrame:
    """(minute, machine, product, non_product), on a batch or a stream."""
    counts = fields.groupBy(F.window("ts", "1 minute").alias("w"), "machine").agg(
        F.count_if(F.col("is_product")).alias("product"),
        F.count_if(~F.col("is_product")).alias("non_product"),
    )
    return counts.select(F.col("w.start").alias("minute"), "machine", "product", "non_product")


def minute_range(minute: Column) -> Column:
    """Printed key of a minute, such as ``Sep  4 00:00:00_Sep  4 00:00:59``."""
    head = F.concat(
        F.date_format(minute, "MMM "), F.lpad(F.dayofmonth(minute).cast("string"), 2, " "),
        F.date_format(minute, " HH:mm:"),
    )
    return F.concat(head, F.lit("00_"), head, F.lit("59"))


def api_traffic_lines(traffic: DataFrame, hosts: str) -> DataFrame:
    """(minute_range, machines): one line per minute with TAB-joined ``machine:product,other``.

    Lists the machines whose whole name matches the pattern ``hosts``, so that stray words of
    broken lines do not grow a line; ``traffic`` itself is the report of all machines.
    """
    cell = F.concat_ws(
        "", "machine", F.lit(":"), F.col("product").cast("string"), F.lit(","),
        F.col("non_product").cast("string"),
    )
    listed = traffic.where(F.col("machine").rlike(f"^(?:{hosts})$"))
    return listed.groupBy("minute").agg(
        F.array_join(F.array_sort(F.collect_list(cell)), "\t").alias("machines")
    ).select(minute_range(F.col("minute")).alias("minute_range"), "machines")
