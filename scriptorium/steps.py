"""The folder that driver and executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own_dir: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Without it, a local session (and no other) gets a folder of its own, which goes when the process ends."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        if not _own_dir:
            _own_dir.append(tempfile.mkdtemp(prefix="scriptorium-"))
            atexit.register(shutil.rmtree, _own_dir[0], ignore_errors=True)
        root = _own_dir[0]
    return root.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/scriptorium/{name}-{uuid.uuid4().hex}"


def slices(batches, rows: int = 256, size: int = 1 << 20):
    """Arrow batches in slices of so many rows and about so many bytes at most: what a worker makes of a slice, and not of a whole
    batch of ten thousand texts, is all that it holds."""
    for batch in batches:
        most = max(1, min(rows, size * batch.num_rows // max(1, batch.nbytes)))
        for start in range(0, batch.num_rows, most):
            yield batch.slice(start, most)


def spread(df: DataFrame, times: int = 1) -> DataFrame:
    """At least so many partitions a core, for steps that take long for a row: a small file of one row group is one partition.

    What has them already, as any large table, is left as it is.
    """
    wanted = times * df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= wanted else df.repartition(wanted)
