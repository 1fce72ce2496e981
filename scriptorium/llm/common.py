"""What the corpus operators share: the shared folder, materialised steps, link components, row keys."""

from __future__ import annotations

import ctypes
import functools
import gc
import logging
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.steps import shared_dir, spread

#: The words of every contract: runs of anything but ASCII white space. ``bytes.split()`` cuts at the same six bytes.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

log = logging.getLogger(__name__)
_made: ContextVar[list | None] = ContextVar("made", default=None)


@contextmanager
def steps_of():
    """Steps that are made inside go at the end, but for those that were taken out of the list that this gives."""
    made: list[DataFrame] = []
    token = _made.set(made)
    try:
        yield made
    finally:
        _made.reset(token)
        for step in made:
            discard(step)


#: Bytes of an Arrow batch, about, and the setting's own default, which alone is replaced.
BATCH_BYTES, BATCH_SETTING, BATCH_DEFAULT = 4 << 20, "spark.sql.execution.arrow.maxBytesPerBatch", 64 << 20


def bound_batches(spark: SparkSession) -> None:
    """Long texts go to workers a few megabytes at a time: what executor and worker hold of them doesn't depend on their lengths."""
    if spark.conf.get(BATCH_SETTING).lower().removesuffix("b") == str(BATCH_DEFAULT):
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def materialise(df: DataFrame, name: str, instead_of: tuple[DataFrame, ...] = ()) -> DataFrame:
    """Write a step to the shared folder and read it again: later steps survive lost executors and don't redo it.

    instead_of: earlier steps that nothing reads once this one is written; their tables go. The step's shuffle files aren't
    needed any more either. Spark deletes them once the driver has collected its garbage, which a driver with little to do may
    not for hours, so it is asked to.
    """
    spark = df.sparkSession
    bound_batches(spark)
    path = f"{shared_dir(spark)}/scriptorium/{name}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.option("compression", "zstd").parquet(path)
    for step in instead_of:
        discard(step)
    del df
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    out = spark.read.schema(schema).parquet(path)
    out.step_path = path
    if (made := _made.get()) is not None:
        made.append(out)
    return out


def discard(step: DataFrame) -> None:
    """Delete the table of a step that was materialised. A store that only Spark reaches keeps it, as it keeps checkpoints."""
    from pyarrow import fs

    if path := getattr(step, "step_path", None):
        step.step_path = None
        try:
            store, inner = fs.FileSystem.from_uri(path if ":/" in path else f"file://{path}")
            store.delete_dir(inner)
        except (OSError, pa.ArrowException) as e:
            log.warning("%s stays: %s", path, e)


def release() -> None:
    """Give back what this process has freed: a Python worker is used again by later steps, which need its memory."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def tidy(run):
    """A task's generator function that releases memory when it ends."""

    @functools.wraps(run)
    def tidied(*args):
        try:
            yield from run(*args)
        finally:
            release()

    return tidied


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table, on all cores even if it is one row group; a larger one is read as it is."""
    bound_batches(spark)
    return spread(spark.read.parquet(f"{sf_dir}/{table}.parquet"))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def row_key(doc_id: str = "doc_id", text: str = "text") -> tuple:
    """Two longs that name a row by its content. Rows alike in id and text share them, and get the same answers."""
    return F.xxhash64(F.col(text), F.col(doc_id)).alias("k1"), F.coalesce(F.col(doc_id).cast("long"), F.lit(-1)).alias("k2")


def pieces(batches, rows: int = 512):
    """Batches a few hundred rows at a time, without a copy, so that a worker never holds ten thousand texts as objects."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def word_blocks(text: bytes | None, most: int = 4_000_000):
    """The words of a text, some million bytes of it at a time, so that a very long one isn't held as one list of words."""
    start, end = 0, len(text or b"")
    while start < end:
        stop = min(start + most, end)
        while stop < end and text[stop] not in b" \t\n\x0b\x0c\r":
            stop += 1
        yield (text if stop - start == end else text[start:stop]).split()
        start = stop


class Forest:
    """Union-find over hashable, ordered nodes; the smallest node of a set is its root."""

    def __init__(self):
        self.up: dict = {}

    def root(self, x):
        up = self.up
        top = x
        while (y := up.get(top, top)) != top:
            top = y
        while x != top:
            up[x], x = top, up.get(x, x)
        return top

    def join(self, a, b) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        if b < a:
            a, b = b, a
        self.up[b] = a
        return True


@tidy
def thin_links(batches, limit: int = 200_000):
    """Replace the links of a task by a spanning forest of them, a bounded number at a time."""
    schema = None
    forest, out = Forest(), []
    for batch in batches:
        schema = batch.schema
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if forest.join(a, b):
                out.append((a, b))
        if len(out) >= limit:
            yield pa.RecordBatch.from_arrays([pa.array(x, schema.types[0]) for x in zip(*out, strict=True)], schema=schema)
            forest, out = Forest(), []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(x, schema.types[0]) for x in zip(*out, strict=True)], schema=schema)


def components(links: DataFrame, name: str = "links", rounds: int = 60) -> DataFrame:
    """Connected components of ``links`` (a, b: any ordered type): rows (node, component), the smallest node of each.

    Alternates large-star and small-star rounds (Kiveris et al., 2014). Each is an aggregation and a join, so a hub
    with very many links is summed up before the shuffle and split by the adaptive join; no neighbourhood is ever
    gathered. Only nodes that have a link come back.
    """
    kind = links.schema[0].dataType.simpleString()
    schema = f"a {kind}, b {kind}"
    edges = links.select("a", "b").where("a is not null and b is not null and a <> b").mapInArrow(thin_links, schema)
    edges = held = materialise(edges.selectExpr("greatest(a, b) as a", "least(a, b) as b").distinct(), name)
    before = None
    for _ in range(rounds):
        # Large star: every larger neighbour of a node, and the node, link to the smallest in the neighbourhood.
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        edges = both.where("b > a").join(least, "a").selectExpr("b as a", "m as b").where("a <> b").distinct()
        # Small star: the smaller neighbours of a node, and the node, link to the smallest of them.
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        edges = edges.join(least, "a").selectExpr("inline(array(struct(b as a, m as b), struct(a as a, m as b)))")
        edges = held = materialise(edges.where("a <> b").distinct(), name, instead_of=(held,))
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    tops = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(tops)
