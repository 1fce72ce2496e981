"""Near-duplicate detection with bottom-k sketches from one hash function.

1. Each document becomes its set of word shingles (64-bit hashes); documents with the same set are one class from here on.
2. A class keeps the ``SKETCH`` smallest hashes of its set, its sketch. Counting each retained value over all classes tells
   which are shared at all. The smallest values of a union are retained by both sides wherever both hold them, so classes
   of similarity t share a known number of sketch values at least: all of t times a small set, and of a full sketch ``FLOOR``
   (five standard deviations below the mean, a miss in some millions of links). Classes with fewer shared values go no further.
3. Inverted lists of retained values: from the ``PROBE`` smallest values, those that are shared by fewest classes, as
   many as it takes for two linked classes to meet in one. Lists with equal members are one list.
4. A long list is cut into tiles of a bounded size. All tiles meet the first; then the classes that this hasn't connected with
   the largest set of connected classes of the first tile meet each other and the rest, which is few for a family of near
   copies, however large. So no list is gathered, no list's pairs are emitted, and no pair that could connect two components
   is left out.
5. In a task, overlaps of sketches are products of their incidence matrices; pairs with enough overlap are estimated on the
   sketch of the union, and exact Jaccard on the full sets verifies. Pairs already connected are skipped, biggest overlap
   first, and only a spanning forest of verified links leaves the task.
6. Forests are united into components.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z. Defined results: without words or text a document has the empty set and
is linked with nothing; with fewer words than a shingle the whole sequence is its only shingle; a null id is carried, and
counts after all others in choosing the smallest; an empty table gives an empty result; other columns don't matter.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.llm.common import Forest, components, materialise, pieces, row_key, tidy
from scriptorium.llm.substring_dedup import run_hashes, word_hasher

#: Values to a sketch; of these, the smallest that serve as keys of inverted lists; classes and shingles to a tile, about.
SKETCH, PROBE, TILE, TILE_SHINGLES = 64, 16, 1024, 2_000_000
#: Columns of an incidence matrix that are held at a time.
COLUMNS = 4096


def floor_of(size: int, similarity: float) -> int:
    """The least number of retained values, of ``size``, that classes of this similarity share."""
    return max(1, math.floor(size * similarity - 5 * math.sqrt(size * similarity * (1 - similarity))))


def shingles(text: bytes | None, hashes, n: int) -> np.ndarray:
    """The set of a document's word n-grams, sorted; one for the whole sequence if it is shorter, none without words."""
    h = hashes(text and text.lower())
    if not len(h):
        return np.zeros(0, np.uint64)
    if len(h) < n:
        return run_hashes(h, len(h)) ^ np.uint64(len(h))
    return np.unique(run_hashes(h, n))


def _sketch(n: int):
    @tidy
    def run(batches):
        hashes = word_hasher()
        for batch in pieces(batches):
            sizes, digests, sketches = [], [], []
            for text in batch.column(1).to_pylist():
                s = shingles(text, hashes, n)
                sizes.append(len(s))
                digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).hexdigest() if len(s) else None)
                sketches.append(s[:SKETCH].view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3), pa.array(sizes, pa.int64()), pa.array(digests, pa.string()), pa.array(sketches, pa.list_(pa.int64()))], ["doc_id", "k1", "k2", "n_shingles", "cls", "sketch"])

    return run


def _sets(n: int):
    """Rows (cls, text) to (cls, the whole set), for sets that the sketch doesn't hold whole."""

    @tidy
    def run(batches):
        hashes = word_hasher()
        for batch in pieces(batches):
            sets = [shingles(x, hashes, n).view(np.int64) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], ["cls", "members"])

    return run


def similar(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    """Exact: intersection >= similarity * union, in integers, for sorted arrays without repeats."""
    if len(a) > len(b):
        a, b = b, a
    if 10_000 * len(a) < round(10_000 * similarity) * len(b):
        return False
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    both = int(np.count_nonzero(b[at] == a))
    return 10_000 * both >= round(10_000 * similarity) * (len(a) + len(b) - both)


def estimate(a: np.ndarray, b: np.ndarray) -> float:
    """Similarity from the sketch of the union: the share of its values that both sides retain."""
    union, times = np.unique(np.concatenate([a, b]), return_counts=True)
    return float(np.count_nonzero(times[:SKETCH] == 2) / min(SKETCH, len(union)))


def products(owner: np.ndarray, column: np.ndarray, n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many columns the rows ``a`` and ``b`` of an incidence matrix of n rows, given by (owner, column), share."""
    out, order = np.zeros((len(a), len(b)), np.float32), np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for s in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        x, y = np.searchsorted(column, [s, s + COLUMNS])
        hold = np.zeros((n, COLUMNS), np.float32)
        hold[owner[x:y], column[x:y] - s] = 1
        out += hold[a] @ hold[b].T
    return out


def link_tile(sizes, sketches, members, lists, mine, similarity: float, left: np.ndarray, right: np.ndarray, known=None) -> list[tuple[int, int]]:
    """A spanning forest of the links between the classes of two tiles of list ``mine`` (the same tile: within it).

    A pair is this list's if no earlier list has both. known: a mark of each class; those with the same one are connected
    already, and what connects them isn't told again.
    """
    every = np.unique(np.concatenate([left, right]))
    values, at = np.unique(np.concatenate([sketches[i] for i in every]), return_inverse=True)
    owner = np.repeat(np.arange(len(every)), [len(sketches[i]) for i in every])
    often = np.bincount(at) > 1
    keep = often[at]
    a, b = np.searchsorted(every, left), np.searchsorted(every, right)
    shared = products(owner[keep], (np.cumsum(often) - 1)[at[keep]], len(every), a, b)
    before = [[x for x in lists[i] if x < mine] for i in every]
    if any(before):
        earlier, of = np.unique(np.concatenate(before), return_inverse=True)
        shared[products(np.repeat(np.arange(len(every)), list(map(len, before))), of, len(every), a, b) > 0] = 0
    length = np.array([sizes[i] for i in every])
    small, large = np.minimum.outer(length[a], length[b]), np.maximum.outer(length[a], length[b])
    need = np.where(large <= SKETCH, np.ceil(similarity * large - 1e-9), floor_of(SKETCH, similarity))
    close = (shared >= np.maximum(need, 1)) & (small >= similarity * large - 1e-9)
    x, y = np.nonzero(close)
    if len(left) == len(right) and (left == right).all():
        x, y = x[x < y], y[x < y]
    order = np.argsort(-shared[x, y], kind="stable")
    forest, links = Forest(), []
    if known is not None:
        first: dict = {}
        for i in every.tolist():
            forest.join(first.setdefault(known[i], i), i)
    least = floor_of(SKETCH, similarity) / SKETCH
    for i, j in zip(every[a[x[order]]].tolist(), every[b[y[order]]].tolist(), strict=True):
        if i == j or forest.root(i) == forest.root(j):
            continue
        if sizes[i] > SKETCH or sizes[j] > SKETCH:
            if estimate(sketches[i], sketches[j]) < least:
                continue
        if similar(members[i], members[j], similarity):
            forest.join(i, j)
            links.append((i, j))
    return links


def _verify(similarity: float):
    """Rows (cid, members, lists, list, tile, low, high, comp) of two tiles of a list to links (list, high, a of the lower tile, b)."""
    schema = pa.schema([("list", pa.int64()), ("high", pa.int32()), ("a", pa.int64()), ("b", pa.int64())])

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("cid").combine_chunks()
        low, high, tile = rows["low"][0].as_py(), rows["high"][0].as_py(), rows["tile"].to_numpy()
        left, right = np.flatnonzero(tile == low), np.flatnonzero(tile == high)
        links: list = []
        if len(left) and len(right):
            cids, held = rows["cid"].to_pylist(), rows["members"].combine_chunks()
            flat, ends = held.flatten().to_numpy().view(np.uint64), held.offsets.to_numpy() - held.offsets[0].as_py()
            members = [np.sort(flat[x:y]) for x, y in zip(ends[:-1], ends[1:], strict=True)]
            known = rows["comp"].to_pylist()
            found = link_tile(np.diff(ends).tolist(), [m[:SKETCH] for m in members], members, rows["lists"].to_pylist(), rows["list"][0].as_py(), similarity, left, right, known)
            links = [(cids[i], cids[j]) for i, j in found]
        return pa.table([[rows["list"][0].as_py()] * len(links), [high] * len(links), [a for a, _ in links], [b for _, b in links]], schema=schema)

    return run


def _first_tile(links: pa.Table) -> pa.Table:
    """Links (list, a, b) within the first tile of a list to (list, leader, comp): the smallest class that each is connected with."""
    forest, found = Forest(), set()
    for a, b in zip(links["a"].to_pylist(), links["b"].to_pylist(), strict=True):
        forest.join(a, b)
        found |= {a, b}
    leaders = sorted(found)
    return pa.table([[links["list"][0].as_py()] * len(leaders), leaders, [forest.root(x) for x in leaders]], schema=pa.schema([("list", pa.int64()), ("leader", pa.int64()), ("comp", pa.int64())]))


def find_links(classes: DataFrame, texts: DataFrame, similarity: float, n: int) -> DataFrame:
    """classes (cid, n_shingles, sketch, k1, k2 of a row that has the text) to links (a, b) of cids: the forests of all tasks."""
    # Retained values that at least two classes hold, and how many do.
    values = classes.select("cid", F.explode("sketch").alias("value"))
    often = values.groupBy("value").agg(F.count("*").alias("holders")).where("holders > 1")
    held = values.join(often, "value").groupBy("cid").agg(F.collect_list(F.struct("holders", "value")).alias("held"))
    # A set that can only meet sets whose sketches are whole too shares an exact number of values at least, others FLOOR.
    size, alone = F.col("n_shingles"), F.col("n_shingles") <= math.floor(SKETCH * similarity)
    exact = F.ceil(similarity * size - 1e-9).cast("int")
    need = F.when(alone, exact).otherwise(floor_of(SKETCH, similarity))
    strong = materialise(held.where(F.size("held") > 0).join(classes.select("cid", "n_shingles", "sketch", "k1", "k2"), "cid").where(F.size("held") >= need), "strong")

    # Keys: of a whole set the rarest values, of a full sketch the rarest of its PROBE smallest; unshared ones are the rarest.
    def rarest(among, many, must):
        near = F.array_sort(F.filter("held", lambda h: F.array_contains(among, h["value"])))
        return F.slice(near, 1, F.greatest(F.lit(0), (F.size(near) - must + 1).cast("int")))

    none = F.slice("held", 1, 0)
    whole = F.when(size <= SKETCH, rarest(F.col("sketch"), size, exact)).otherwise(none)
    probe = F.when(~alone, rarest(F.slice("sketch", 1, PROBE), F.lit(PROBE), F.lit(floor_of(PROBE, similarity)))).otherwise(none)
    posts = strong.select("cid", "n_shingles", F.explode(F.array_distinct(F.concat(whole, probe))).alias("key")).select("cid", "n_shingles", F.col("key.value").alias("value"))
    # Lists with the same members are one list, named by the smallest of their values.
    marks = posts.groupBy("value").agg(F.count("*").alias("many"), F.sum("n_shingles").alias("heavy"), F.sum(F.xxhash64("cid").cast("decimal(38,0)")).alias("s1"), F.sum(F.xxhash64("cid", F.lit(1)).cast("decimal(38,0)")).alias("s2")).where("many > 1")
    lists = marks.groupBy("many", "heavy", "s1", "s2").agg(F.min("value").alias("value")).select("value", F.greatest(F.ceil(F.col("many") / TILE), F.ceil(F.col("heavy") / TILE_SHINGLES)).cast("int").alias("tiles"))
    mine = posts.join(lists, "value").groupBy("cid").agg(F.collect_list(F.struct(F.col("value").alias("list"), "tiles")).alias("found"))
    # The whole sets of the classes that are left: the sketch, or made again from one text of each.
    met = materialise(strong.select("cid", "n_shingles", "sketch", "k1", "k2").join(mine, "cid"), "met", instead_of=(strong,))
    large = met.where(size > SKETCH).select("cid", "k1", "k2")
    one = texts.join(large, ["k1", "k2"]).groupBy("k1", "k2").agg(F.first("cid").alias("cid"), F.first("text").alias("text"))
    sets = one.select("cid", "text").mapInArrow(_sets(n), "cid long, members array<long>")
    full = materialise(met.select("cid", "sketch", "found").join(sets, "cid", "left").select("cid", F.coalesce("members", "sketch").alias("members"), "found"), "sets", instead_of=(met,))
    listed = full.select("cid", "members", F.col("found.list").alias("lists"), F.explode("found").alias("f")).select("cid", "members", "lists", "f.list", "f.tiles")
    listed = listed.withColumn("tile", F.pmod(F.xxhash64("cid", F.lit(2)), F.col("tiles")).cast("int"))

    def compare(rows):  # dealt by all three keys: rows that a join has dealt by list would else meet in one task
        return rows.select("cid", "members", "lists", "list", "tile", "low", "high", "comp").repartition("list", "low", "high").groupBy("list", "low", "high").applyInArrow(_verify(similarity), "list long, high int, a long, b long")

    # The first tile meets itself and each other tile.
    others = F.when(F.col("tile") == 0, F.sequence(F.lit(0), F.col("tiles") - 1)).otherwise(F.array("tile"))
    links = materialise(compare(listed.withColumn("high", F.explode(others)).withColumn("low", F.lit(0)).withColumn("comp", F.col("cid"))), "links")
    long = listed.where("tiles > 1")
    if long.isEmpty():
        return links.select("a", "b")
    # Of the other tiles, what isn't connected with the largest part of the first meets itself and the rest of the list, tile by tile.
    inner = links.where("high = 0").join(long.select("list").distinct(), "list", "left_semi").select("list", "a", "b")
    leaders = inner.groupBy("list").applyInArrow(_first_tile, "list long, leader long, comp long")
    met_leaders = links.where("high > 0").select("list", F.col("a").alias("leader"), F.col("b").alias("cid"))
    comps = met_leaders.join(leaders, ["list", "leader"], "left").groupBy("list", "cid").agg(F.min(F.coalesce("comp", "leader")).alias("comp"))
    named = long.where("tile > 0").join(comps, ["list", "cid"], "left").withColumn("comp", F.coalesce("comp", "cid"))
    sums = named.groupBy("list", "comp").agg(F.count("*").alias("n"), F.sum(F.size("members")).alias("heavy"))
    tiles = lambda n, heavy: F.greatest(F.ceil(n / TILE), F.ceil(heavy / TILE_SHINGLES)).cast("int")
    most = sums.groupBy("list").agg(F.max_by("comp", F.struct("n", "comp")).alias("top"), F.max("n").alias("n"), F.max_by("heavy", F.struct("n", "comp")).alias("heavy"), F.sum("n").alias("all"), F.sum("heavy").alias("all_heavy"))
    most = most.where("all > n").select("list", "top", tiles(F.col("n"), F.col("heavy")).alias("top_tiles"), tiles(F.col("all") - F.col("n"), F.col("all_heavy") - F.col("heavy")).alias("rest_tiles"))
    rest = named.drop("tiles", "tile").join(most, "list").withColumn("in_top", F.col("comp") == F.col("top"))
    own = F.pmod(F.xxhash64("cid", F.lit(3)), F.when(F.col("in_top"), F.col("top_tiles")).otherwise(F.col("rest_tiles"))).cast("int")
    rest = rest.withColumn("tile", F.when(F.col("in_top"), F.col("rest_tiles") + own).otherwise(own))
    # Tiles of the rest come first; each meets all others, those of the largest component only them.
    rest = rest.withColumn("other", F.explode(F.sequence(F.lit(0), F.when(F.col("in_top"), F.col("rest_tiles")).otherwise(F.col("rest_tiles") + F.col("top_tiles")) - 1)))
    rest = rest.withColumn("low", F.least("tile", "other")).withColumn("high", F.greatest("tile", "other"))
    return links.unionByName(compare(rest)).select("a", "b")


def group_near(docs: DataFrame, similarity: float = 0.8, n: int = 5) -> DataFrame:
    """A row per document: doc_id, k1, k2 (its row_key), n_shingles, component_id, kept."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"), *row_key())
    rows = materialise(texts.mapInArrow(_sketch(n), "doc_id long, k1 long, k2 long, n_shingles long, cls string, sketch array<long>"), "sketches")
    one = F.min(F.struct("k1", "k2")).alias("one")
    classes = rows.where("cls is not null").groupBy("cls").agg(F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch"), F.min("doc_id").alias("least"), one)
    classes = materialise(classes.select(F.monotonically_increasing_id().alias("cid"), "cls", "n_shingles", "sketch", "least", "one.*"), "classes")
    comps = components(find_links(classes, texts.select("k1", "k2", "text"), similarity, n), "near")
    named = classes.select("cid", "cls", "least").join(comps.withColumnRenamed("node", "cid"), "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    tops = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(tops, "component").select("cls", "component_id")
    out = rows.select("doc_id", "k1", "k2", "n_shingles", "cls").join(named, "cls", "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "k1", "k2", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))


def keep_one(docs: DataFrame, similarity: float = 0.8, n: int = 5) -> DataFrame:
    """The rows of docs whose doc_id is the smallest of their group; rows without an id stay only if alone with it, once."""
    lost = group_near(docs, similarity, n).where((~F.col("kept")) & F.col("component_id").isNotNull()).select("k1", "k2").distinct()
    k1, k2 = row_key()
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), k1, k2)
    return held.join(lost, ["k1", "k2"], "left_anti").select("doc.*")
