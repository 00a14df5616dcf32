"""Shared parts of the streaming jobs: sources, per-batch tables, key state.

Every micro-batch writes its results and its state under its own batch number
and reads the state of the number before. A batch that is run again after a
failure overwrites what it wrote, so results count once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfmark.sources.sinks import exists, folders, remove


def parquet_stream(spark: SparkSession, folder: str, pattern: str, files_per_batch: int = 1000) -> DataFrame:
    """Stream over a folder's Parquet files whose names match the pattern.

    `files_per_batch` bounds the work of a micro-batch; all files are read in the end.
    """
    schema = spark.read.option("pathGlobFilter", pattern).parquet(folder).schema
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
    )


class BatchTables:
    """Tables `<path>/<name>/batch=<n>` written by micro-batch n."""

    def __init__(self, path: str) -> None:
        self.path = path.rstrip("/")

    def write(self, df: DataFrame, name: str, batch: int, by: Sequence[str] = ()) -> None:
        df.write.mode("overwrite").partitionBy(*by).parquet(f"{self.path}/{name}/batch={batch}")

    def read_one(self, spark: SparkSession, name: str, batch: int) -> DataFrame | None:
        folder = f"{self.path}/{name}/batch={batch}"
        return spark.read.parquet(folder) if exists(spark, folder) else None

    def read_before(self, spark: SparkSession, name: str, batch: int) -> DataFrame | None:
        if batch == 0 or not exists(spark, f"{self.path}/{name}"):
            return None
        rows = spark.read.parquet(f"{self.path}/{name}")
        return rows.where(F.col("batch") < batch).drop("batch")

    def read_all(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.option("mergeSchema", True).parquet(f"{self.path}/{name}").drop("batch")

    def hold(self, df: DataFrame, name: str, by: str, batch: int) -> None:
        """Append rows that later batches read, to `<path>/<name>/<by>=<value>/batch=<n>`; a repeated batch
        overwrites what it appended."""
        rows = df.withColumn("batch", F.lit(batch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        rows.partitionBy(by, "batch").parquet(f"{self.path}/{name}")

    def held(
        self, spark: SparkSession, name: str, by: str, after: int | None, until: int | None, batch: int
    ) -> DataFrame | None:
        """Rows that batches before `batch` hold for values beyond `after` and up to `until`, and those without one.

        Only the folders of these values are listed and read.
        """
        folder = f"{self.path}/{name}"
        chosen = [
            f"{folder}/{by}={text}"
            for value, text in self.values(spark, name, by)
            if value is None or ((after is None or value > after) and (until is None or value <= until))
        ]
        if not chosen:
            return None
        return spark.read.option("basePath", folder).parquet(*chosen).where(F.col("batch") < batch)

    def release(self, spark: SparkSession, name: str, by: str, until: int) -> None:
        """Drop the folders of values up to `until`."""
        for value, text in self.values(spark, name, by):
            if value is not None and value <= until:
                remove(spark, f"{self.path}/{name}/{by}={text}")

    def values(self, spark: SparkSession, name: str, by: str) -> list[tuple[int | None, str]]:
        """Values that there are folders for, null as None, beside their text."""
        texts = [f.partition("=")[2] for f in folders(spark, f"{self.path}/{name}") if f.startswith(f"{by}=")]
        return [(int(t) if t.lstrip("-").isdigit() else None, t) for t in sorted(texts)]

    def forget(self, spark: SparkSession, name: str, batch: int) -> None:
        """Drop a state that no retry can need any more."""
        if batch >= 0:
            remove(spark, f"{self.path}/{name}/batch={batch}")


def last_batch(spark: SparkSession, path: str, name: str) -> int:
    """Number of the newest micro-batch that wrote a table."""
    return spark.read.parquet(f"{path.rstrip('/')}/{name}").agg(F.max("batch")).first()[0]


def run_available(
    stream: DataFrame, each: Callable[[DataFrame, int], None], path: str
) -> StreamingQuery:
    """Process all available input in micro-batches, continuing at the checkpoint."""
    return (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", f"{path.rstrip('/')}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
