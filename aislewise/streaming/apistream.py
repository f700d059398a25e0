"""API traffic on a stream: the batch operator, with a watermark before it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from aislewise.operators.apitraffic import api_line_fields, api_traffic_per_minute


def api_traffic_stream(lines: DataFrame, domain: str, year: int, late: str = "2 minutes") -> DataFrame:
    fields = api_line_fields(lines, domain, year)
    return api_traffic_per_minute(fields.withWatermark("ts", late))


def start_api_traffic(
    spark: SparkSession, log_dir: str, out: str, domain: str, year: int, checkpoint: str,
    late: str = "2 minutes", available_now: bool = True,
) -> StreamingQuery:
    """Follows text files in ``log_dir`` and appends closed minutes to a parquet table.

    ``checkpoint`` is the folder of the stream's state, the same one at each start for one
    table: the table takes a batch number it has seen as written.
    """
    lines = spark.readStream.text(log_dir).withColumnRenamed("value", "line")
    writer = (
        api_traffic_stream(lines, domain, year, late)
        .writeStream.format("parquet").outputMode("append")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
