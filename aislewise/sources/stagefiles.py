"""Text files of the recommendation stages, as earlier runs left them: readers and writers.

Daily counters: ``user, item, buy:n,view:n,cart:n,(yyyyMMdd or noTime)``. User vectors:
``user, item, score, avg_day, last_buy``. Item vectors: ``item, other:count,...``. Columns are
TAB-separated. Lines of another form are skipped.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aislewise.functions import vectors as V
from aislewise.sources.readers import split_paths
from aislewise.sources.writers import write_lines

# Fixed value: stands for the day of purchase where there was none.
NO_DAY = "noTime"
DAY = "yyyyMMdd"


def _fields(spark: SparkSession, paths: str | list[str], count: int) -> DataFrame:
    """Lines of ``count`` TAB-separated fields as ``f``, with ``dt`` of day folders."""
    lines = spark.read.text(split_paths(paths))
    kept = [F.col("dt").cast("date").alias("dt")] if "dt" in lines.columns else []
    return lines.select(*kept, F.split("value", "\t").alias("f")).where(F.size("f") == count)


def _days(df: DataFrame) -> list[str]:
    return ["dt"] if "dt" in df.columns else []


def read_daily_counters(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """([dt,] user, item, buy, view, cart, buy_date)."""
    rows = _fields(spark, paths, 3)
    info = F.col("f")[2]
    counts = [F.regexp_extract(info, rf"(?:^|,){n}:(\d+)", 1).try_cast("bigint").alias(n) for n in ("buy", "view", "cart")]
    day = F.try_to_timestamp(F.regexp_extract(info, r"(?:^|,)(\d{8})(?:,|$)", 1), F.lit(DAY)).cast("date")
    return rows.select(*_days(rows), F.col("f")[0].alias("user"), F.col("f")[1].alias("item"), *counts,
                       day.alias("buy_date")).na.drop(subset=["buy", "view", "cart"])


def write_daily_counters(daily: DataFrame, path: str) -> None:
    info = F.format_string("buy:%d,view:%d,cart:%d,%s", "buy", "view", "cart",
                           F.coalesce(F.date_format("buy_date", DAY), F.lit(NO_DAY)))
    lines = daily.select("dt", F.concat_ws("\t", "user", "item", info).alias("line"))
    lines.write.mode("overwrite").partitionBy("dt").text(path)


def read_user_vectors(spark: SparkSession, paths: str | list[str], first_day: date) -> DataFrame:
    """(user, item, milli, avg_day, last_buy, buy) as ``userrec.user_vector`` gives them.

    The files do not tell how often an item was bought: ``buy`` is 1 where the last purchase
    is not ``first_day``, which stands for none.
    """
    f = F.col("f")
    last = F.try_to_timestamp(f[4], F.lit(DAY)).cast("date")
    rows = _fields(spark, paths, 5).select(
        f[0].alias("user"), f[1].alias("item"), F.rint(f[2].try_cast("double") * 1000).cast("bigint").alias("milli"),
        f[3].try_cast("double").cast("bigint").alias("avg_day"), last.alias("last_buy"),
        (last != F.lit(first_day)).cast("bigint").alias("buy"))
    return rows.na.drop()


def write_user_vectors(users: DataFrame, path: str) -> None:
    line = F.concat_ws("\t", "user", "item", (F.col("milli") / 1000).cast("string"),
                       F.col("avg_day").cast("double").cast("string"), F.date_format("last_buy", DAY))
    users.select(line.alias("line")).write.mode("overwrite").text(path)


def read_item_vectors(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """([dt,] item, other, cnt)."""
    rows = _fields(spark, paths, 2)
    entries = rows.select(*_days(rows), F.col("f")[0].alias("item"), F.inline(V.unpack_vector(F.col("f")[1])))
    return entries.select(*_days(rows), "item", F.col("key").alias("other"), F.col("value").alias("cnt")).na.drop(subset=["cnt"])


def write_item_vectors(ranked: DataFrame, path: str) -> None:
    """Takes ranked vectors (item, rank, other, cnt), whose limit bounds a line."""
    packed = ranked.groupBy("item").agg(
        V.packed(F.collect_list(V.entry(F.col("rank"), F.col("other"), F.col("cnt")))).alias("vector"))
    write_lines(packed.select(F.concat_ws("\t", "item", "vector").alias("line")), path)
