"""Mixing sources to target weights by cube-method balanced sampling.

A source's target over its size is how often each of its documents is to be taken, on average. The whole part of that rate is
taken for all; the fraction is the inclusion probability of one copy more. The flight phase moves these probabilities along
the null space of the balancing constraints (tokens and documents) until each is 0 or 1 but for a few; a landing phase drops
the document count first and settles those. Flights run in chunks of a bounded size, biggest documents first, so that the
small ones are left; what the chunks leave is gathered and flown again until a source's rest fits one chunk, and lands.

Defined results: a null text has size 0 and is taken 0 words; sources are ordered by code point, null last, an empty name is a
source like any other; rows alike in all columns are separate units, rows that differ in
any are never taken for each other; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from scriptorium.llm.common import WORD, materialise

#: Units that one flight task holds, about.
CHUNK = 4096
UNITS = "doc_id long, skey string, size long, tag long, base long, p double"


def tag_of(docs: DataFrame):
    """A hash of all columns of a row; rows that share it are alike, so any of them may stand for another."""
    plain = lambda f: F.to_json(F.col(f"`{f.name}`")) if isinstance(f.dataType, (ArrayType, MapType, StructType)) else F.col(f"`{f.name}`")
    fields = docs.schema.fields
    return F.xxhash64(*[plain(f) for f in fields], *[F.col(f"`{f.name}`").isNull() for f in fields])


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, skey (never null), size, tag."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    skey = F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col("source")))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", skey.alias("skey"), size.alias("size"), tag_of(docs).alias("tag"))


def targets(rows: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0), most: float = 3.0) -> DataFrame:
    """source, skey, source_size, docs, target: shares of 100 % of all sizes by weight, none above ``most`` times its source.

    What a capped source can't take is shared by weight among the others until none is above. Sources may be many, so their
    places in the order come from a distributed sort, and each round of sharing is a sum over them.
    """
    totals = rows.groupBy("source", "skey").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    ordered = materialise(totals.orderBy(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id()), "sources")
    # A row for each partition of the sort: how many sources lie before it.
    before = F.sum("many").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    parts = ordered.groupBy("part").agg(F.count("*").alias("many")).select("part", F.coalesce(before, F.lit(0)).alias("before"))
    rank = F.row_number().over(W.partitionBy("part").orderBy(F.col("source").asc_nulls_last())) - 1 + F.col("before")
    weighed = ordered.join(F.broadcast(parts), "part").withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int")))
    weighed = weighed.withColumn("cap", most * F.col("source_size")).select("source", "skey", "source_size", "docs", "weight", "cap")
    weighed = materialise(weighed, "weights", instead_of=(ordered,))
    level, capped = 0.0, -1
    while True:
        over = F.col("weight") * level > F.col("cap")
        sums = weighed.agg(F.sum("source_size"), F.sum(F.when(over, F.col("cap"))), F.sum(F.when(~over, F.col("weight"))), F.count(F.when(over, 1))).first()
        if not sums[2] or sums[3] == capped:
            break
        level, capped = (sums[0] - (sums[1] or 0.0)) / sums[2], sums[3]
    return weighed.select("source", "skey", "source_size", "docs", F.least(F.col("cap"), F.col("weight") * level).alias("target"))


def _draws(seed: int, *names):
    return np.random.Generator(np.random.Philox(key=[seed, zlib.crc32("|".join(map(str, names)).encode())])).random


def fly(size: np.ndarray, p: np.ndarray, draw, least: int = 2) -> np.ndarray:
    """The flight phase over (size, 1): returns p with all but ``least`` entries, at most, at 0 or 1.

    The undecided unit of the largest size leads: its direction, projected on the null space of the constraints, changes
    neither the expected tokens nor the expected documents, as all others give way a little. The walk goes along it, up or
    down with the odds that keep every p, until a unit is decided. Where only the document count stands in the way, it yields.
    """
    p, tiny = p.astype(float).copy(), 1e-9
    open_ = [int(i) for i in np.argsort(-size, kind="stable") if tiny < p[i] < 1 - tiny]
    x = np.asarray(size, float)
    while len(open_) > least:
        i = np.array(open_)
        u = direction(x[i], p[i])
        up, down = reach(p[i], u), reach(p[i], -u)
        q = np.clip(p[i] + (up if draw() * (up + down) < down else -down) * u, 0.0, 1.0)
        p[i] = np.where(q <= tiny, 0.0, np.where(q >= 1 - tiny, 1.0, q))
        open_ = i[(p[i] > 0) & (p[i] < 1)].tolist()
    return np.where(p <= tiny, 0.0, np.where(p >= 1 - tiny, 1.0, p))


def direction(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    """The first unit's direction, projected on the null space of (x, 1), or of x alone; the units with room give way most."""
    w = p * (1 - p)
    lead = np.zeros(len(x))
    lead[0] = 1
    for rows in ((x / max(1.0, x[0]), np.ones(len(x))), (x / max(1.0, x[0]),)):
        a = np.stack(rows)
        u = lead - w * (np.linalg.lstsq((a * w) @ a.T, a @ lead, rcond=1e-12)[0] @ a)
        if np.abs(u[0]) > 1e-6 and np.abs(a @ u).max() < 1e-9 * max(1.0, np.abs(u).max()):
            return u
    # Nothing gives way to the leader (it alone has words): the other units move on their own.
    u = np.zeros(len(x))
    u[-2:] = (x[-1], -x[-2]) if x[-1] or x[-2] else (1, -1)
    return u


def reach(p: np.ndarray, u: np.ndarray) -> float:
    """How far p can go along u."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return float(np.min(np.where(u > 0, (1 - p) / u, np.where(u < 0, -p / u, np.inf))))


def land(size: np.ndarray, p: np.ndarray, draw) -> np.ndarray:
    """Decide what flights have left: fly on, then balance the last two by tokens alone, then the last unit by its own odds."""
    p, tiny, x = fly(size, p, draw), 1e-9, np.asarray(size, float)
    held = [int(i) for i in np.flatnonzero((p > tiny) & (p < 1 - tiny))]
    if len(held) == 2:
        i = np.array(held)
        u = np.array((x[i[1]], -x[i[0]]) if x[i].any() else (1.0, -1.0))
        up, down = reach(p[i], u), reach(p[i], -u)
        p[i] = np.clip(p[i] + (up if draw() * (up + down) < down else -down) * u, 0.0, 1.0)
        held = [j for j in held if tiny < p[j] < 1 - tiny]
    for j in held:
        p[j] = float(draw() < p[j])
    return np.round(p)


def _phase(move, level: int, seed: int):
    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("size", "descending"), ("doc_id", "ascending"), ("tag", "ascending")])
        draw = _draws(seed, group["skey"][0].as_py(), group["chunk"][0].as_py(), level)
        p = move(group["size"].to_numpy(), group["p"].to_numpy(), draw)
        names = [x.split()[0] for x in UNITS.split(", ")]
        return group.select(names).set_column(names.index("p"), "p", pa.array(p, pa.float64()))

    return run


def sample(rows: DataFrame, plan: DataFrame, seed: int = 7) -> DataFrame:
    """doc_id, skey, size, tag, copies: how often each row is taken. The same rows give the same answer."""
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    near = F.when(F.abs(rate - F.round(rate)) < 1e-9, F.round(rate)).otherwise(rate)
    units = rows.join(plan.select("skey", "source_size", "docs", "target"), "skey").select("doc_id", "skey", "size", "tag", F.floor(near).cast("long").alias("base"), (near - F.floor(near)).alias("p"), "docs")
    chunk = F.pmod(F.xxhash64("tag", "doc_id"), F.ceil(F.col("docs") / CHUNK))
    flown = materialise(units.withColumn("chunk", chunk).drop("docs").groupBy("skey", "chunk").applyInArrow(_phase(fly, 0, seed), UNITS), "flown")
    done, level = [flown.where("p = 0 or p = 1")], 0
    rest = flown.where("p > 0 and p < 1")
    while (largest := rest.groupBy("skey").count().agg(F.max("count")).first()[0] or 0) > CHUNK:
        level += 1
        parts = -(-largest // CHUNK)
        flown = materialise(rest.withColumn("chunk", F.pmod(F.xxhash64("tag", F.lit(level)), F.lit(parts))).groupBy("skey", "chunk").applyInArrow(_phase(fly, level, seed), UNITS), "flown")
        done.append(flown.where("p = 0 or p = 1"))
        rest = flown.where("p > 0 and p < 1")
    landed = rest.withColumn("chunk", F.lit(0)).groupBy("skey").applyInArrow(_phase(land, -1, seed), UNITS)
    for part in done:
        landed = landed.unionByName(part)
    return landed.select("doc_id", "skey", "size", "tag", (F.col("base") + F.round("p").cast("long")).alias("copies"))


def mix(docs: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0), most: float = 3.0, seed: int = 7) -> DataFrame:
    """A row per document: doc_id, source, size, source_size, target, copies, taken."""
    rows = materialise(sizes(docs), "sizes")
    plan = materialise(targets(rows, weights, most), "targets")
    taken = sample(rows, plan, seed).join(plan.select("skey", "source", "source_size", "target"), "skey")
    return taken.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def mixture(docs: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0), most: float = 3.0, seed: int = 7) -> DataFrame:
    """The mixture itself: each document as often as it is taken, with the columns of docs."""
    rows = materialise(sizes(docs), "sizes")
    plan = materialise(targets(rows, weights, most), "targets")
    name = lambda i, tag: F.struct(F.coalesce(i, F.lit(-1)), tag)
    copies = sample(rows, plan, seed).groupBy(name(F.col("doc_id"), F.col("tag")).alias("row_name")).agg(F.sum("copies").alias("row_copies")).where("row_copies > 0")
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), name(F.col("doc_id").cast("long"), tag_of(docs)).alias("row_name")).dropDuplicates(["row_name"])
    return held.join(copies, "row_name").select("doc", F.explode(F.sequence(F.lit(1), F.col("row_copies").cast("int")))).select("doc.*")
