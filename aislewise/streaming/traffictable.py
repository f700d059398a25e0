"""API traffic as a table that late lines correct.

The stream issues a minute again whenever lines for it arrive, as long as the watermark allows, and drops
lines that are repeated within that time. Every batch is written beside the table and published as one run
(``sources.versions``) under its batch number, so a batch that is tried again after a crash changes nothing, and readers
see a batch wholly or not at all. A minute's last issue counts. Runs are merged into one when
``MERGE_RUNS`` have gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from aislewise.operators.apitraffic import api_line_fields, api_traffic_per_minute
from aislewise.sources import versions as V

MERGE_RUNS = 8
ISSUES = "minute timestamp, machine string, product bigint, non_product bigint, batch bigint"


def api_traffic_updates(lines: DataFrame, domain: str, year: int, late: str) -> DataFrame:
    """Minutes of a stream of lines as they change, for ``outputMode("update")``; repeated lines count once."""
    fields = api_line_fields(lines.withColumn("seen", F.sha2("line", 256)), domain, year, keep=["seen"])
    once = fields.withWatermark("ts", late).dropDuplicates(["seen", "ts"])
    return api_traffic_per_minute(once)


def _runs(spark: SparkSession, root: str, runs: list[dict]) -> DataFrame:
    return spark.read.schema(ISSUES).parquet(*[f"{root}/{r['folder']}" for r in runs])


def _latest(issues: DataFrame) -> DataFrame:
    """The last issue of every minute and machine."""
    last = F.max_by(F.struct("product", "non_product", "batch"), "batch").alias("last")
    return issues.groupBy("minute", "machine").agg(last).select("minute", "machine", "last.*")


def merge_batch(spark: SparkSession, root: str, updates: DataFrame, batch: int) -> None:
    """Publishes a batch of the stream, unless it is in the table already."""
    base, content = V.manifest(spark, root)
    if batch <= content.get("batch", -1):
        return
    runs, written = list(content.get("runs", [])), []

    def save(df: DataFrame) -> str:
        written.append(V.new_folder())
        df.write.parquet(f"{root}/{written[-1]}")
        return written[-1]

    try:
        runs.append({"folder": save(updates.select("minute", "machine", "product", "non_product", F.lit(batch).cast("bigint").alias("batch")))})
        if len(runs) >= MERGE_RUNS:
            runs = [{"folder": save(_latest(_runs(spark, root, runs)))}]
        V.commit(spark, root, base, {"batch": batch, "runs": runs})
    except (Exception, KeyboardInterrupt):
        for folder in written:
            V.delete_folder(spark, root, folder)
        raise


def read_traffic(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """(minute, machine, product, non_product) as last issued."""
    runs = V.manifest(spark, root, version)[1].get("runs", [])
    issues = _runs(spark, root, runs) if runs else spark.createDataFrame([], ISSUES)
    return _latest(issues).drop("batch")


def start_traffic_table(
    spark: SparkSession, log_dir: str, root: str, domain: str, year: int, checkpoint: str, late: str = "1 day",
    available_now: bool = True,
) -> StreamingQuery:
    """Follows text files in ``log_dir`` and keeps the table ``root`` up to date.

    Lines later than ``late`` behind the newest are lost to the table. ``checkpoint`` is the folder of the stream's state,
    the same one at each start for one table.
    """
    lines = spark.readStream.text(log_dir).withColumnRenamed("value", "line")
    writer = (
        api_traffic_updates(lines, domain, year, late).writeStream.outputMode("update")
        .foreachBatch(lambda df, batch: merge_batch(spark, root, df, batch))
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
