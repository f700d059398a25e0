"""Tables below the shared checkpoint folder: they cut lineage and outlive lost executors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from aislewise.session import scratch_path


class Scratch:
    """Stage tables of one run. ``save`` writes and rereads, ``drop`` deletes those not needed
    any more; what a returned, still lazy result reads stays for the folder's owner."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.folder = scratch_path(spark, name)
        self.paths: dict[int, str] = {}
        self.n = 0

    def save(self, df: DataFrame, partition_by: str | None = None) -> DataFrame:
        self.n += 1
        path = f"{self.folder}/{self.n}"
        writer = df.write.partitionBy(partition_by) if partition_by else df.write
        writer.parquet(path)
        read = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(read)] = path
        return read

    def drop(self, *tables: DataFrame) -> None:
        jvm = self.spark._jvm
        for table in tables:
            path = jvm.org.apache.hadoop.fs.Path(self.paths.pop(id(table)))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
