"""Index tables: lines of enriched splits, loaded under an id or appended, in versions that an alias publishes.

An index is a folder with a version for each load. Loading by id is an upsert: the new lines and those of the version before
meet by id, and the newest line of an id stays. Concepts have no id of their own and are appended. A version is written whole
before anything refers to it, so a load that fails leaves the one before in place.
"""

from __future__ import annotations

import json
import logging
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.operators.relational import latest_by
from scriptorium.sources import records

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Index:
    """split: how the folders or files end whose lines it takes; keyed: whether lines are kept by id."""

    split: str
    keyed: bool = True


#: The indices there are, by name.
INDICES = {"publication": Index("_small"), "bioentity": Index("_bioentities"), "taggedtext": Index("_taggedtext"), "concept": Index("_concepts", keyed=False)}


def line_id(line):
    """The id in a line of JSON; null where it is missing or empty."""
    found = F.get_json_object(line, "$.pub_id")
    return F.when(found != "", found)


def id_by_search(line):
    """The same by text search, for lines that aren't parsed: what stands between the quotes behind the first such key."""
    found = F.regexp_extract(line, r'"pub_id": ?"([^"]*)"', 1)
    return F.when(found != "", found)


def documents_of(lines: DataFrame) -> DataFrame:
    """value to id, source; lines without an id are left out (``load`` counts them)."""
    return lines.select(line_id(F.col("value")).alias("id"), F.col("value").alias("source"))


def merged(target: DataFrame | None, documents: DataFrame, keyed: bool) -> DataFrame:
    """documents (id, source) into target (id, source, load): by id the newest load stays, and of one load the greatest source."""
    loads = target.agg(F.coalesce(F.max("load"), F.lit(0))).first()[0] if target is not None else 0
    new = documents.where("id is not null").withColumn("load", F.lit(loads + 1))
    every = new if target is None else target.unionByName(new)
    return latest_by(every, "id", "load", "source") if keyed else every


def read_index(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """The published version of an index: id, source, load."""
    found = _aliases(spark, root)[1].get(name)
    return None if found is None else spark.read.parquet(found)


def _aliases(spark: SparkSession, root: str) -> tuple[int, dict[str, str]]:
    """The number of the newest line of aliases, and its index names with the folders that are published under them."""
    try:
        newest = spark.read.text(f"{root}/_aliases").orderBy(F.desc(F.get_json_object("value", "$.number").cast("long"))).first()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        newest = None
    found = json.loads(newest[0]) if newest else {"number": 0, "of": {}}
    return found["number"], found["of"]


def publish(spark: SparkSession, root: str, name: str, path: str) -> None:
    """From now on the alias of an index is this folder, and so is the temporary view of its name."""
    number, before = _aliases(spark, root)
    line = json.dumps({"number": number + 1, "of": before | {name: path}}, sort_keys=True)
    spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("append").text(f"{root}/_aliases")
    spark.read.parquet(path).createOrReplaceTempView(name)


def load(spark: SparkSession, source: str, root: str, names: list[str], replace: bool = False) -> dict[str, tuple[int, int]]:
    """Load the lines of ``source``'s splits into the indices of these names (those there are); returns how many were loaded and
    how many had no id. replace: whether an index begins anew."""
    counts = {}
    for name in sorted(set(names) & set(INDICES)):
        index = INDICES[name]
        documents = documents_of(records.read_lines(spark, f"{source}{index.split}*"))
        seen = documents.agg(F.count("id"), F.count(F.when(F.col("id").isNull(), 1))).first()
        counts[name] = (seen[0], seen[1])
        if seen[1]:
            log.error("%s: %d lines without an id left out", name, seen[1])
        path = f"{root}/{name}/{uuid.uuid4().hex}"
        merged(None if replace else read_index(spark, root, name), documents, index.keyed).write.parquet(path)
        publish(spark, root, name, path)
        log.info("%s: %d lines loaded", name, seen[0])
    return counts
