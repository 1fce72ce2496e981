"""Near-duplicate vectors through hierarchical navigable small-world graphs, one per shard.

Vectors of one label (and one length) compare with each other only. Equal vectors become one class that knows how many it
stands for, so a vector that comes very often is one node. A label's classes are dealt to shards of a bounded size; each shard
gets a graph. Every class queries every shard of its label: a greedy descent, then a beam on the lowest layer, which widens
for a query as long as all it holds is above the threshold, and for the shard until an audit (a sample of its queries against
brute force over the shard) finds its recall high enough, up to the whole shard. A query whose beam would hold an eighth of
the shard is answered from the whole shard, which then costs less. A task has two shards, which query each other's graphs: a
pair is linked if either side finds it. Cosines in double precision verify. A task emits sums of links and a spanning forest
of them, never the pairs of a group; forests are united into components.

Defined results: vectors that are null, zero, or hold a null or non-finite component, and those with a null label, have no
links and are their own component; a repeated vec_id is a row and a vector of its own; a null vec_id counts after all others; an
empty table gives an empty result; other columns don't matter.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.llm.common import Forest, components, materialise

#: Classes to a shard, about; links a node keeps on upper layers (twice as many on the lowest); beams at building and querying.
SHARD, M, BUILD_BEAM, BEAM = 8192, 12, 48, 32
#: Queries of an audit, and the recall it asks for; the part of a shard that a beam may hold; queries that meet a whole shard together.
AUDIT, RECALL, PART, BLOCK = 48, 0.99, 8, 512

GRAPH = "label long, dim int, shards int, shard int, cid long, many long, vec array<double>, node int, links array<array<int>>"
FOUND = "cid long, found long, a long, b long"


class Graph:
    """Nodes are rows of unit vectors; links[node][layer] are its neighbours."""

    def __init__(self, vectors: np.ndarray, links: list[list[list[int]]] | None = None):
        self.vectors = vectors
        self.links = links if links is not None else []
        self.entry = max(range(len(self.links)), key=lambda i: (len(self.links[i]), -i)) if self.links else -1

    @classmethod
    def build(cls, vectors: np.ndarray, seed: int = 3) -> Graph:
        graph, rng = cls(vectors), np.random.default_rng(seed)
        heights = np.minimum(12, (-np.log(1 - rng.random(len(vectors))) / np.log(M)).astype(int))
        for i, height in enumerate(heights.tolist()):
            graph._add(i, height)
        return graph

    def _near(self, q: np.ndarray, ids) -> list[float]:
        return (self.vectors[ids] @ q).tolist()

    def beam(self, q: np.ndarray, starts: list[int], width: int, layer: int) -> list[tuple[float, int]]:
        """The best ``width`` nodes found from starts, as (similarity, node), best first."""
        seen = set(starts)
        found = list(zip(self._near(q, starts), starts, strict=True))
        todo = [(-s, i) for s, i in found]
        heapq.heapify(todo)
        heapq.heapify(found)
        while len(found) > width:
            heapq.heappop(found)
        while todo:
            s, i = heapq.heappop(todo)
            if -s < found[0][0] and len(found) >= width:
                break
            new = [j for j in self.links[i][layer] if j not in seen]
            if not new:
                continue
            seen.update(new)
            for s, j in zip(self._near(q, new), new, strict=True):
                if len(found) < width:
                    heapq.heappush(found, (s, j))
                    heapq.heappush(todo, (-s, j))
                elif s > found[0][0]:
                    heapq.heapreplace(found, (s, j))
                    heapq.heappush(todo, (-s, j))
        return sorted(found, reverse=True)

    def _spread(self, near: list[tuple[float, int]], most: int) -> list[int]:
        """Neighbours, nearest first, but none that is nearer to one already chosen; filled up with the nearest of the rest."""
        chosen, rest = [], []
        for s, j in near:
            if len(chosen) == most:
                break
            if chosen and float((self.vectors[chosen] @ self.vectors[j]).max()) > s:
                rest.append(j)
            else:
                chosen.append(j)
        return chosen + rest[: most - len(chosen)]

    def _add(self, i: int, height: int) -> None:
        self.links.append([[] for _ in range(height + 1)])
        if self.entry < 0:
            self.entry = i
            return
        q, at, top = self.vectors[i], [self.entry], len(self.links[self.entry]) - 1
        for layer in range(top, height, -1):
            at = [self.beam(q, at, 1, layer)[0][1]]
        for layer in range(min(top, height), -1, -1):
            near = self.beam(q, at, BUILD_BEAM, layer)
            most = M if layer else 2 * M
            mine = self._spread(near, M)
            self.links[i][layer] = mine
            for j in mine:
                theirs = self.links[j][layer]
                theirs.append(i)
                if len(theirs) > most:
                    ranked = sorted(zip(self._near(self.vectors[j], theirs), theirs, strict=True), reverse=True)
                    self.links[j][layer] = self._spread(ranked, most)
            at = [j for _, j in near]
        if height > top:
            self.entry = i

    def reach(self, q: np.ndarray, least: float, width: int) -> list[int] | None:
        """The nodes at ``least`` similarity or more that a beam of this width, or wider as long as it is full of them, finds.

        None if the beam would hold a ``PART`` of the shard: it is to be compared with all of it, links or not.
        """
        at = [self.entry]
        for layer in range(len(self.links[self.entry]) - 1, 0, -1):
            at = [self.beam(q, at, 1, layer)[0][1]]
        while width * PART < len(self.links):
            found = self.beam(q, at, width, 0)
            if len(found) < width or found[-1][0] < least:
                return [j for s, j in found if s >= least]
            width, at = 2 * width, [j for _, j in found]
        return None


def unit(vectors: np.ndarray) -> np.ndarray:
    big = np.abs(vectors).max(axis=1, keepdims=True)  # so that squares neither vanish nor overflow
    scaled = vectors / big
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def vectors_of(rows: pa.Table) -> np.ndarray:
    return unit(rows["vec"].combine_chunks().flatten().to_numpy().reshape(rows.num_rows, -1))


def _build(rows: pa.Table) -> pa.Table:
    rows = rows.sort_by("cid")
    graph = Graph.build(vectors_of(rows).astype(np.float32))
    names = [x.split()[0] for x in GRAPH.split(", ")]
    rows = rows.append_column("node", pa.array(np.arange(rows.num_rows, dtype=np.int32)))
    return rows.append_column("links", pa.array(graph.links, pa.list_(pa.list_(pa.int32())))).select(names)


class Shard:
    """What a task has of a shard: unit vectors, the graph over them, ids, and how many rows each class stands for."""

    def __init__(self, rows: pa.Table):
        rows = rows.sort_by("node")
        self.exact = vectors_of(rows)
        self.coarse = self.exact.astype(np.float32)
        self.cids, self.many = rows["cid"].to_numpy(), rows["many"].to_numpy()
        self.graph = Graph(self.coarse, rows["links"].to_pylist())


def find(asked: Shard, held: Shard, cosine: float, slack: float = 1e-5) -> np.ndarray:
    """Which classes of ``asked`` (rows) are linked with which of ``held`` (columns), as the graph of ``held`` finds them."""
    n, same = len(asked.cids), asked is held
    # The audit: widen the beam for all until a sample's links to others are found. The sample grows until it has AUDIT
    # links, or is all that are asked.
    order, sample, truth, seen, width = np.random.default_rng(n).permutation(n), [], [], 0, BEAM
    for s in range(0, n, AUDIT):
        some = order[s : s + AUDIT]
        near = asked.exact[some] @ held.exact.T >= cosine
        if same:
            near[np.arange(len(some)), some] = False
        for i, row in zip(some[near.any(axis=1)].tolist(), near[near.any(axis=1)], strict=True):
            sample.append(i)
            truth.append(set(np.flatnonzero(row).tolist()))
            seen += len(truth[-1])
        if seen >= AUDIT:
            break
    while True:
        got = [held.graph.reach(asked.coarse[i], cosine - slack, width) for i in sample]
        if sum(len(t) if g is None else len(t & set(g)) for g, t in zip(got, truth, strict=True)) >= RECALL * sum(map(len, truth)):
            break
        width *= 2
    out, whole = np.zeros((n, len(held.cids)), bool), []
    for i in range(n):
        near = held.graph.reach(asked.coarse[i], cosine - slack, width)
        if near is None:
            whole.append(i)
        elif near:
            near = np.array(near)
            out[i, near[held.exact[near] @ asked.exact[i] >= cosine]] = True
    for s in range(0, len(whole), BLOCK):
        some = whole[s : s + BLOCK]
        out[some] = asked.exact[some] @ held.exact.T >= cosine
    return out


def _query(cosine: float):
    """The rows of two shards, or of one, to sums of links (cid, found) and a forest of them (a, b)."""
    schema = pa.schema([(x.split()[0], pa.int64()) for x in FOUND.split(", ")])

    def run(rows: pa.Table) -> pa.Table:
        low, high = rows["low"][0].as_py(), rows["high"][0].as_py()
        of = rows["shard"].to_numpy()
        left = Shard(rows.filter(pa.array(of == low)))
        right = left if low == high else Shard(rows.filter(pa.array(of == high)))
        linked = find(left, right, cosine)
        if left is right:
            linked |= linked.T
            np.fill_diagonal(linked, False)
        else:
            linked |= find(right, left, cosine).T
        forest, out, found = Forest(), [], np.zeros(len(right.cids), np.int64)
        for i, cid in enumerate(left.cids.tolist()):
            near = np.flatnonzero(linked[i])
            if len(near):
                out.append((cid, int(right.many[near].sum()), None, None))
                found[near] += left.many[i]
                out += [(None, None, cid, other) for other in right.cids[near].tolist() if forest.join(cid, other)]
        if left is not right:
            out += [(cid, n, None, None) for cid, n in zip(right.cids.tolist(), found.tolist(), strict=True) if n]
        return pa.table(list(zip(*out, strict=True)) if out else [[]] * 4, schema=schema)

    return run


def search(classes: DataFrame, cosine: float) -> DataFrame:
    """classes (label, dim, cid, vec, many) to rows with a class's links in a shard (cid, found) or a link (a, b)."""
    counts = classes.groupBy("label", "dim").agg(F.ceil(F.count("*") / SHARD).cast("int").alias("shards"))
    dealt = classes.join(counts, ["label", "dim"]).withColumn("shard", F.pmod(F.xxhash64("cid"), F.col("shards")).cast("int"))
    graph = materialise(dealt.groupBy("label", "dim", "shard").applyInArrow(_build, GRAPH), "graph")
    paired = graph.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
    paired = paired.withColumn("low", F.least("shard", "other")).withColumn("high", F.greatest("shard", "other"))
    return paired.groupBy("label", "dim", "low", "high").applyInArrow(_query(cosine), FOUND)


def group_vectors(vectors: DataFrame, cosine: float = 0.93) -> DataFrame:
    """A row per vector: vec_id, n_links, component_id, kept."""
    vec = F.col("embedding").cast("array<double>")
    ok = F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(vec, lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), vec.alias("vec"), F.coalesce(ok, F.lit(False)).alias("ok"))
    rows = rows.withColumn("h1", F.xxhash64("label", "vec")).withColumn("h2", F.xxhash64("vec", "label", F.lit(1)))
    first = F.min(F.struct(F.col("vec_id").isNull().alias("none"), "vec_id")).alias("first")
    classes = rows.where("ok").groupBy("h1", "h2").agg(F.first("label").alias("label"), F.first("vec").alias("vec"), first, F.count("*").alias("many"))
    classes = materialise(classes.select(F.monotonically_increasing_id().alias("cid"), "h1", "h2", "label", F.size("vec").alias("dim"), "vec", F.col("first.vec_id").alias("least"), "many"), "vectors")
    found = materialise(search(classes.select("cid", "label", "dim", "vec", "many"), cosine), "found")
    comps = components(found.where("a is not null").select("a", "b"), "vectors").withColumnRenamed("node", "cid")
    links = found.where("cid is not null").groupBy("cid").agg(F.sum("found").alias("found"))
    named = classes.select("cid", "h1", "h2", "least", "many").join(comps, "cid", "left").join(links, "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    tops = named.groupBy("component").agg(F.min("least").alias("top"))
    named = named.join(tops, "component").select("h1", "h2", (F.coalesce("found", F.lit(0)) + F.col("many") - 1).alias("links"), "top")
    out = rows.select("vec_id", "h1", "h2", "ok").join(named, ["h1", "h2"], "left")
    component = F.when(F.col("ok"), F.coalesce("top", "vec_id")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.when(F.col("ok"), F.col("links")).otherwise(0).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
