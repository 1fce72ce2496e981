"""Exact deduplication through a minimal perfect hash over the distinct digests already seen.

Texts are equal when identical after each run of ASCII white space is one space. History (an earlier batch) is reduced to
its distinct digests; these are dealt to shards of a bounded size, and each shard gets a minimal perfect hash whose slots
hold the full digest, the winner's locator and the number of rows. A new batch is reduced to distinct digests too, and each
is looked up in its shard's slots: a full comparison of the digest's bytes tells repeats from nonmembers, which form groups
of their own. No text and no group of copies is ever gathered: both sides are pre-aggregated before the shuffle.

Defined results: a null text is the empty text; of equal texts the smallest doc_id stays, a null id after all others, and of
rows alike in both exactly one; ids are 64-bit integers throughout; an empty table gives an empty result; other columns are carried by ``deduplicate`` only.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.llm.common import SPACE, materialise

#: Distinct digests that a shard of the index holds, about.
SHARD_KEYS = 2_048

INDEX = "shard int, digests binary, levels array<binary>, spare array<int>, winners array<long>, locators array<long>, members array<long>"
CLASSES = "digest string, keep_id long, keep_row long, group_size long, in_history boolean"


def normalised(text):
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


class PerfectHash:
    """A minimal perfect hash: cascaded bit arrays in which a key owns the first bit that no other key of its level hits.

    A key's slot is the rank of its bit. Keys are rows of 32 digest bytes; a stranger may get a slot too, so callers compare.
    """

    GAMMA, LEVELS = 2, 40

    def __init__(self, levels: list[np.ndarray], spare: list[int], keys: np.ndarray | None = None):
        self.levels, self.spare = levels, spare
        bits = [np.unpackbits(x) for x in levels]
        self.before = np.cumsum([0, *(int(b.sum()) for b in bits)])
        self.ranks = [np.cumsum(b, dtype=np.int64) - b for b in bits]
        self.bits = bits

    @staticmethod
    def _at(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        a, b = keys[:, 0], keys[:, 1]
        x = a + b * np.uint64(2 * level + 1) + np.uint64(level)
        x ^= x >> np.uint64(31)
        x *= np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
        return (x % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, digests: np.ndarray) -> PerfectHash:
        """digests: distinct rows of 32 bytes."""
        keys, left, levels = digests.view("<u8").reshape(len(digests), 4), np.arange(len(digests)), []
        while len(left) and len(levels) < cls.LEVELS:
            size = -(-len(left) * cls.GAMMA // 8) * 8
            at = cls._at(keys[left], len(levels), size)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(np.packbits(alone))
            left = left[~alone[at]]
        return cls(levels, [int(x) for x in left])

    def slots(self, digests: np.ndarray) -> np.ndarray:
        """The slot of each digest, or -1 where no level has a bit for it."""
        keys, out = digests.view("<u8").reshape(len(digests), 4), np.full(len(digests), -1, np.int64)
        left = np.arange(len(digests))
        for level, bits in enumerate(self.bits):
            if not len(left):
                break
            at = self._at(keys[left], level, len(bits))
            hit = bits[at] == 1
            out[left[hit]] = self.before[level] + self.ranks[level][at[hit]]
            left = left[~hit]
        return out


INDEX_TYPE = pa.schema([("shard", pa.int32()), ("digests", pa.binary()), ("levels", pa.list_(pa.binary())), ("spare", pa.list_(pa.int32())), ("winners", pa.list_(pa.int64())), ("locators", pa.list_(pa.int64())), ("members", pa.list_(pa.int64()))])
CLASSES_TYPE = pa.schema([("digest", pa.string()), ("keep_id", pa.int64()), ("keep_row", pa.int64()), ("group_size", pa.int64()), ("in_history", pa.bool_())])


def _bytes_of(hexes: list[str]) -> np.ndarray:
    return np.frombuffer(bytes.fromhex("".join(hexes)), np.uint8).reshape(-1, 32)


def _build(rows: pa.Table) -> pa.Table:
    """Ids stay 64-bit integers beside nulls: nothing here goes through floats."""
    digests = _bytes_of(rows["digest"].to_pylist())
    table = PerfectHash.build(digests)
    slot = table.slots(digests)
    free = len(digests) - len(table.spare)  # keys that no level parts go to the end, found by comparison
    slot[table.spare] = np.arange(free, len(digests))
    order = np.argsort(slot)
    sorted_ = rows.take(pa.array(order))
    lists = [[sorted_[c].to_pylist()] for c in ("keep_id", "keep_row", "group_size")]
    return pa.table([[rows["shard"][0].as_py()], [digests[order].tobytes()], [[x.tobytes() for x in table.levels]], [list(range(free, len(digests)))], *lists], schema=INDEX_TYPE)


def distinct_digests(rows: DataFrame) -> DataFrame:
    """rows (doc_id, row, digest) to a row per digest: the winner, its locator, the number of rows."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first")
    return rows.groupBy("digest").agg(first, F.count("*").alias("group_size")).select("digest", F.col("first.doc_id").alias("keep_id"), F.col("first.row").alias("keep_row"), "group_size")


def build_index(history: DataFrame, shards: int) -> DataFrame:
    """The index over ``history`` (rows of doc_id, row, digest): a row per shard, of a bounded size."""
    keyed = distinct_digests(history).withColumn("shard", F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("int"))
    return keyed.groupBy("shard").applyInArrow(_build, INDEX)


def _look_up(index: pa.Table, new: pa.Table) -> pa.Table:
    fresh = new["digest"].to_pylist()
    rows = list(zip(new["keep_id"].to_pylist(), new["keep_row"].to_pylist(), new["group_size"].to_pylist(), strict=True))
    found: dict[int, int] = {}
    rest = range(len(fresh))
    out: list[tuple] = []
    if index.num_rows:
        one = index.slice(0, 1).to_pylist()[0]
        held = np.frombuffer(one["digests"], np.uint8).reshape(-1, 32)
        table = PerfectHash([np.frombuffer(x, np.uint8) for x in one["levels"]], one["spare"])
        if fresh:
            mine = _bytes_of(fresh)
            slot = table.slots(mine)
            same = slot >= 0
            same[same] = (held[slot[same]] == mine[same]).all(axis=1)
            for i in np.flatnonzero(~same) if len(one["spare"]) else ():
                for s in one["spare"]:
                    if (held[s] == mine[i]).all():
                        slot[i], same[i] = s, True
            found = {int(s): int(i) for i, s in zip(np.flatnonzero(same), slot[same], strict=True)}
            rest = np.flatnonzero(~same).tolist()
        for s, best in enumerate(zip(one["winners"], one["locators"], one["members"], strict=True)):
            if s in found:
                other = rows[found[s]]
                least = min(best[:2], other[:2], key=lambda x: (x[0] is None, x[0] or 0, x[1]))
                best = (*least, best[2] + other[2])
            out.append((held[s].tobytes().hex(), *best, True))
    out += [(fresh[i], *rows[i], False) for i in rest]
    return pa.table(list(zip(*out, strict=True)) if out else [[]] * 5, schema=CLASSES_TYPE)


def look_up(index: DataFrame, batch: DataFrame, shards: int) -> DataFrame:
    """Classes of history and batch together: a member's class is merged with its slot, nonmembers are classes of their own."""
    keyed = distinct_digests(batch).withColumn("shard", F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("int"))
    return index.groupBy("shard").cogroup(keyed.groupBy("shard")).applyInArrow(_look_up, CLASSES)


def digest_rows(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, row, digest), materialised, so that ``row`` names the same row from here on."""
    digest = F.sha2(normalised(F.col("text")), 256)
    return materialise(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), digest.alias("digest")), "digests")


def classify(rows: DataFrame, in_history=None) -> DataFrame:
    """A row per input row: doc_id, row, digest, keep_id, group_size, kept.

    in_history: a condition on rows that tells the batch that came first. By default it is every other row by a hash of the
    id, so that both the index and the lookups carry half of the table.
    """
    in_history = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0 if in_history is None else in_history
    shards = max(1, -(-rows.count() // SHARD_KEYS))
    index = materialise(build_index(rows.where(in_history), shards), "perfect-hash")
    classes = look_up(index, rows.where(~in_history), shards)
    return rows.join(classes, "digest").select("doc_id", "row", "digest", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"))


def deduplicate(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, with all their columns.

    The table is written once with its row numbers, so that the choice applies to those rows, repeated ones included.
    """
    inner = [c for c in docs.columns]
    held = materialise(docs.select(F.struct(*[F.col(f"`{c}`") for c in inner]).alias("doc"), F.monotonically_increasing_id().alias("row"), F.sha2(normalised(F.col("text")), 256).alias("digest")), "documents")
    rows = held.select(F.col("doc.doc_id").cast("long").alias("doc_id"), "row", "digest")
    lost = classify(rows).where("not kept").select("row")
    return held.join(lost, "row", "left_anti").select("doc.*")
