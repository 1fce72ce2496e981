"""An extension: the updates feed as a stream, merged into a table by the newest version of each key."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.operators.relational import upsert


def newest_version(spark: SparkSession, path: str, before: int) -> DataFrame | None:
    """The table as the newest batch ahead of number ``before`` that was written to its end has left it."""
    try:
        done = spark.read.text(f"{path}/_done").agg(F.max(F.when(F.col("value").cast("long") < before, F.col("value").cast("long")))).first()[0]
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        done = None
    return None if done is None else spark.read.parquet(f"{path}/v={done}")


def merge_stream(updates: DataFrame, path: str, key: str, order: str, checkpoint: str):
    """Each micro-batch is merged with the table at ``path`` into a new version of it; returns the streaming query.

    A version counts once ``_done`` names it, so a batch that is repeated after a failure starts from the last whole version,
    and batches may skip numbers.
    """
    spark = updates.sparkSession

    def merge(batch: DataFrame, epoch: int) -> None:
        before = newest_version(spark, path, epoch)
        table = batch.limit(0) if before is None else before.select(*batch.columns)
        upsert(table, batch, key, order).write.mode("overwrite").parquet(f"{path}/v={epoch}")
        spark.createDataFrame([(str(epoch),)], "value string").coalesce(1).write.mode("append").text(f"{path}/_done")

    return updates.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
