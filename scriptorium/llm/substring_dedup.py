"""Substring deduplication with super-k-mer partitioning over words.

A window is ``k`` consecutive words of one document, its minimiser the smallest hash among its runs of ``m`` words (the first
of equals). Consecutive windows with the same minimiser form a super-k-mer. Two equal windows have equal minimisers at the
same place in them, so

1. a first pass gives the minimiser and the place of every super-k-mer, without its words; minimisers that occur once can't
   belong to a repeated window, and their super-k-mers go no further (those that a task sees twice needn't meet the others,
   so a very common one doesn't meet in one task);
2. the others travel as one packed string (their words) to the bucket of their minimiser, equal strings counted before the
   shuffle, so a passage that very many documents share is one row there with a count, while its places stay behind;
3. a bucket, sorted by minimiser, compares windows minimiser by minimiser and offset by offset: sorting whole windows counts
   them exactly, and a string learns which of its words are covered by a repeated window; the windows of a minimiser that very
   many different strings share (found from a sample of strings, which decides nothing but this) are dealt out one by one by
   their digests (128 bits) instead, and counted there, so that no minimiser makes a task large;
4. places and covered words meet by the string's digest (an adaptive join splits hot strings), and documents drop the words.

Words are ``[^\\x20\\x09-\\x0D]+``, compared as they are. Defined results: a null or empty text has no words and keeps the empty
text; documents of fewer than ``k`` words keep all; rows alike in id and text are separate documents that repeat each other;
null ids are carried; a text
of any length is cut into stretches of ``STRETCH`` windows, whose results are the same; an empty table gives an empty result; other columns don't matter.
"""

from __future__ import annotations

from hashlib import blake2b
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.llm.common import materialise, pieces, row_key, tidy, word_blocks

#: Words whose hash a task remembers.
MEMORY = 300_000
#: Bits of a word's place in the hashes that are compared, and of a super-k-mer's pivot and windows in its code.
PLACES, BITS = 26, 10
OPEN, KNOWN, MARKER = 0, 1, 2
#: Windows of a document that are looked at together: their places fit ``PLACES`` bits.
STRETCH = 1 << 24
#: One string in so many is looked at for minimisers that many strings share; as many of one minimiser make it heavy.
SAMPLED, HEAVY = 16, 64
#: Heavy minimisers up to this number are sent to all tasks (some MB); more are joined.
SENT = 200_000


class WordHashes(dict):
    """Remembers the hashes of words."""

    def __missing__(self, word: bytes) -> int:
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


def word_hasher():
    """A function from a text to the hashes of its words."""
    known = WordHashes()

    def hashes(text: bytes | None) -> np.ndarray:
        parts = []
        for words in word_blocks(text):
            if len(known) > MEMORY:
                known.clear()
            parts.append(np.fromiter(map(known.__getitem__, words), np.uint64, len(words)))
        return parts[0] if len(parts) == 1 else np.concatenate([np.zeros(0, np.uint64), *parts])

    return hashes


def run_hashes(hashes: np.ndarray, m: int) -> np.ndarray:
    """A hash of each run of m hashes."""
    n = len(hashes) - m + 1
    out = np.zeros(n, np.uint64)
    for i in range(m):
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + n]
        out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values, by doubling."""
    have = 1
    while 2 * have <= width:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    return np.minimum(values[: len(values) - (width - have)], values[width - have :]) if width > have else values


def super_kmers(hashes: np.ndarray, k: int, m: int):
    """start, pivot, number of windows and minimiser of each super-k-mer of a document of at least k words.

    The pivot is the minimiser's place from the start. Places break ties of hashes, so the first of equals is the minimiser.
    """
    runs, places = run_hashes(hashes, m), np.uint64((1 << PLACES) - 1)
    at = (sliding_min(runs & ~places | np.arange(len(runs), dtype=np.uint64), k - m + 1) & places).astype(np.int64)
    starts = np.flatnonzero(np.diff(at, prepend=-1))
    return starts, at[starts] - starts, np.diff(starts, append=len(at)), runs[at[starts]].view(np.int64)


def _first_pass(k: int, m: int):
    """Rows (k1, k2, text) to a row per super-k-mer: key, k1, k2, mini, code (its start, pivot and windows), known, marker.

    A minimiser that comes twice among some 100,000 super-k-mers of a task is known to repeat: its rows needn't meet any
    other and are dealt by their own place, and one marker stands for them where all rows of the minimiser meet.
    """
    names = ["key", "k1", "k2", "mini", "code", "state"]

    def batch_of(parts):
        k1, k2, mini, code = (np.concatenate(x) for x in zip(*parts, strict=True))
        _, first, at, times = np.unique(mini, return_index=True, return_inverse=True, return_counts=True)
        known = times[at] > 1
        key = np.where(known, k1 ^ (code * 0x9E3779B1), mini)
        marked = first[times > 1]
        state = np.where(known, KNOWN, OPEN)
        columns = [np.concatenate([x, y]) for x, y in ((key, mini[marked]), (k1, k1[marked]), (k2, k2[marked]), (mini, mini[marked]), (code, code[marked]), (state, np.full(len(marked), MARKER)))]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns[:5]] + [pa.array(columns[5], pa.int8())], names)

    @tidy
    def run(batches):
        hashes = word_hasher()
        parts, size = [], 0
        for batch in pieces(batches):
            ids = [batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)]
            for i, text in enumerate(batch.column(2).to_pylist()):
                h = hashes(text)
                for base in range(0, len(h) - k + 1, STRETCH):
                    start, pivot, many, mini = super_kmers(h[base : base + STRETCH + k - 1], k, m)
                    parts.append((np.full(len(start), ids[0][i]), np.full(len(start), ids[1][i]), mini, start + base << 2 * BITS | pivot << BITS | many))
                    size += len(start)
                    if size > 100_000:
                        yield batch_of(parts)
                        parts, size = [], 0
        if parts:
            yield batch_of(parts)

    return run


def _repeating(batches):
    """Rows sorted by key: those known to repeat, and those whose minimiser is the key of other rows too."""
    schema = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("mini", pa.int64()), ("code", pa.int64())])

    def out(rows):
        return pa.RecordBatch.from_arrays([pa.array(c) for c in rows], schema=schema)

    before, pending = None, None
    for batch in batches:
        key, k1, k2, mini, code, state = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(6))
        if not len(key):
            continue
        same = np.diff(key, prepend=key[0]) == 0
        same[0] = before is not None and key[0] == before
        follow = np.append(same[1:], False)
        twice = same | follow
        keep = (state == KNOWN) | ((state == OPEN) & twice)
        keep[-1] &= bool(same[-1]) or state[-1] == KNOWN  # the last row waits for the next batch, unless it is decided
        rows = [c[keep] for c in (k1, k2, mini, code)]
        if pending is not None and same[0]:
            rows = [np.insert(c, 0, x) for c, x in zip(rows, pending, strict=True)]
        pending = (k1[-1], k2[-1], mini[-1], code[-1]) if state[-1] == OPEN and not same[-1] else None
        before = key[-1]
        if len(rows[0]):
            yield out(rows)


def slicer(text: bytes, long: int = 4_000_000):
    """A function that gives the words from one place up to another, one space between. A long text isn't split as a whole."""
    if len(text) <= long:
        words = text.split()
        return lambda a, b: b" ".join(words[a:b])
    data = np.frombuffer(text, np.uint8)
    inner = np.concatenate([[False], (data != 32) & ((data < 9) | (data > 13)), [False]])
    edges = np.flatnonzero(inner[1:] != inner[:-1])
    begins, ends = edges[::2], edges[1::2]
    return lambda a, b: b" ".join(text[begins[a] : ends[min(b, len(ends)) - 1]].split())


def _pack(k: int):
    """Rows (k1, k2, text, codes, minis: the super-k-mers to send) to places and packed strings.

    A place is (digest, k1, k2, start). A string (mini, digest, packed, pivot, windows, many) stands for all equal ones among
    some 20,000 super-k-mers of the task; places have no string, strings no document.
    """
    low = (1 << BITS) - 1
    schema = pa.schema([("digest", pa.binary()), ("k1", pa.int64()), ("k2", pa.int64()), ("start", pa.int64()), ("mini", pa.int64()), ("packed", pa.binary()), ("pivot", pa.int32()), ("windows", pa.int32()), ("many", pa.int64())])

    @tidy
    def run(batches):
        for batch in batches:
            codes, minis = batch.column(3), batch.column(4).flatten().to_numpy()
            each, code = np.diff(codes.offsets.to_numpy()), codes.flatten().to_numpy()
            ends = np.cumsum(each)
            starts, pivots, windows = code >> 2 * BITS, code >> BITS & low, code & low
            begins, stops, owner = starts.tolist(), (starts + windows + (k - 1)).tolist(), np.repeat(np.arange(len(each)), each)
            digests, strings, done = [], {}, 0

            def part(a, b):
                at, n = pa.array(owner[a:b]), b - a
                yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), batch.column(0).take(at), batch.column(1).take(at), pa.array(starts[a:b]), *(pa.nulls(n, t) for t in schema.types[4:])], schema=schema)
                i, n = np.array([x[0] for x in strings.values()]), len(strings)
                yield pa.RecordBatch.from_arrays([pa.array(strings.keys(), pa.binary()), *(pa.nulls(n, pa.int64()) for _ in range(3)), pa.array(minis[i]), pa.array([x[1] for x in strings.values()], pa.binary()), pa.array(pivots[i].astype(np.int32)), pa.array(windows[i].astype(np.int32)), pa.array([x[2] for x in strings.values()])], schema=schema)

            for text, a, b in zip(batch.column(2).to_pylist(), (ends - each).tolist(), ends.tolist(), strict=True):
                words = slicer(text)
                for i in range(a, b):
                    packed = words(begins[i], stops[i])
                    digest = blake2b(packed, digest_size=16).digest()
                    digests.append(digest)
                    if digest in strings:
                        strings[digest][2] += 1
                    else:
                        strings[digest] = [i, packed, 1]
                if len(digests) >= 20_000:
                    yield from part(done, b)
                    digests, strings, done = [], {}, b
            if digests:
                yield from part(done, int(ends[-1]))

    return run


def repeated_words(strings: list[tuple[bytes, int, int, int]], k: int) -> list[list[int]]:
    """For the strings of one minimiser (words, pivot, windows, how often): first words of their repeated windows.

    Equal windows hold the minimiser at the same offset, and a string has one window for an offset at most, so offset by
    offset the whole windows are sorted and runs of equals counted.
    """
    words = [s[0].split(b" ") for s in strings]
    found: list[list[int]] = [[] for _ in strings]
    for offset in range(max(s[1] for s in strings) + 1):
        here = []
        for i, (_, pivot, windows, many) in enumerate(strings):
            first = pivot - offset
            if 0 <= first < windows:
                here.append((words[i][first : first + k], i, first, many))
        here.sort(key=lambda x: x[0])
        for _, same in groupby(here, key=lambda x: x[0]):
            same = list(same)
            if len(same) > 1 or same[0][3] > 1:
                for _, i, first, _ in same:
                    found[i].append(first)
    return found


def _count(k: int):
    """Rows sorted by minimiser and digest (mini, digest, packed, pivot, windows, many) to (digest, first words of repeated windows)."""
    schema = pa.schema([("digest", pa.binary()), ("firsts", pa.list_(pa.int32()))])

    def rows(batches):
        for batch in batches:
            yield from zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True)

    @tidy
    def run(batches):
        digests, firsts = [], []
        for _, group in groupby(rows(batches), key=lambda r: r[0]):
            strings = [(digest, *some[0][2:5], sum(r[5] for r in some)) for digest, some in ((d, list(g)) for d, g in groupby(group, key=lambda r: r[1]))]
            if len(strings) == 1 and strings[0][4] == 1:
                continue
            for string, found in zip(strings, repeated_words([s[1:] for s in strings], k), strict=True):
                if found:
                    digests.append(string[0])
                    firsts.append(sorted(found))
            if len(digests) >= 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(digests, schema.types[0]), pa.array(firsts, schema.types[1])], schema=schema)
                digests, firsts = [], []
        if digests:
            yield pa.RecordBatch.from_arrays([pa.array(digests, schema.types[0]), pa.array(firsts, schema.types[1])], schema=schema)

    return run


def _windows(k: int):
    """Rows (digest, packed, windows, many) to a row for each window: the string's digest, the window's place and digest, how often."""
    schema = pa.schema([("digest", pa.binary()), ("first", pa.int32()), ("window", pa.binary()), ("many", pa.int64())])

    @tidy
    def run(batches):
        for batch in pieces(batches):
            out = []
            for digest, packed, windows, many in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                words = packed.split(b" ")
                out += [(digest, i, blake2b(b" ".join(words[i : i + k]), digest_size=16).digest(), many) for i in range(windows)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 4, schema.types, strict=True)], schema=schema)

    return run


def repeated_in(strings: DataFrame, k: int) -> DataFrame:
    """strings (mini, digest, packed, pivot, windows, many) to (digest, firsts: first words of repeated windows)."""
    some = strings.where(F.pmod(F.xxhash64("digest"), F.lit(SAMPLED)) == 0)
    heavy = materialise(some.groupBy("mini").agg(F.count("*").alias("n")).where(F.col("n") >= HEAVY).select("mini"), "heavy")
    n = heavy.count()
    sent = F.broadcast(heavy) if n <= SENT else heavy
    light = strings.join(sent, "mini", "left_anti") if n else strings
    light = light.select("mini", "digest", "packed", "pivot", "windows", "many").repartition("mini").sortWithinPartitions("mini", "digest")
    found = light.mapInArrow(_count(k), "digest binary, firsts array<int>")
    if not n:
        return found
    # Equal strings of several tasks become one first: the rows made are the windows of different strings, however many tasks hold them.
    different = strings.join(sent, "mini", "left_semi").groupBy("digest").agg(F.first("packed").alias("packed"), F.first("windows").alias("windows"), F.sum("many").alias("many"))
    windows = different.mapInArrow(_windows(k), "digest binary, first int, window binary, many long")
    windows = materialise(windows, "windows")
    repeated = windows.groupBy("window").agg(F.sum("many").alias("n")).where("n > 1").select("window")
    return found.unionByName(windows.join(repeated, "window").groupBy("digest").agg(F.sort_array(F.collect_set("first")).alias("firsts")))


def _apply(k: int):
    """Rows (doc_id, text, found) to what is left of each document."""

    @tidy
    def run(batches):
        for batch in pieces(batches):
            counts, removed, texts = [], [], []
            for text, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                blocks = word_blocks(text) if text and len(text) > 4_000_000 else [text.split() if text else []]
                # Where a covered stretch begins and ends, in order of place.
                firsts = np.unique(np.concatenate([np.array(one["firsts"], np.int64) + one["start"] for one in found])) if found else np.zeros(0, np.int64)
                n = gone = 0
                left = []
                for words in blocks:
                    steps = np.zeros(len(words) + 1, np.int64)
                    mine = firsts[np.searchsorted(firsts, n - k, "right") : np.searchsorted(firsts, n + len(words))] - n
                    np.add.at(steps, np.maximum(mine, 0), 1)
                    np.add.at(steps, np.minimum(mine + k, len(words)), -1)
                    cover = np.cumsum(steps[:-1]) > 0
                    n, gone = n + len(words), gone + int(cover.sum())
                    left.append(b" ".join(w for w, c in zip(words, cover.tolist(), strict=True) if not c) if len(mine) else b" ".join(words))
                counts.append(n)
                removed.append(gone)
                texts.append(b" ".join(x for x in left if x))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(texts, pa.binary())], ["doc_id", "n_words", "n_removed", "kept"])

    return run


def remove_repeats(docs: DataFrame, k: int = 35, m: int = 8) -> DataFrame:
    """A row per document: doc_id, n_words, n_removed, kept_text (the words that stay, joined by one space)."""
    k1, k2 = row_key()
    texts = docs.select(k1, k2, F.col("text").cast("binary").alias("text"), F.col("doc_id").cast("long").alias("doc_id"))
    places = texts.select("k1", "k2", "text").mapInArrow(_first_pass(k, m), "key long, k1 long, k2 long, mini long, code long, state byte")
    found = places.repartition("key").sortWithinPartitions("key").mapInArrow(_repeating, "k1 long, k2 long, mini long, code long")
    found = found.groupBy("k1", "k2").agg(F.collect_set(F.struct("code", "mini")).alias("found"))
    packed = texts.select("k1", "k2", "text").join(found, ["k1", "k2"]).select("k1", "k2", "text", F.col("found.code").alias("codes"), F.col("found.mini").alias("minis"))
    packed = materialise(packed.mapInArrow(_pack(k), "digest binary, k1 long, k2 long, start long, mini long, packed binary, pivot int, windows int, many long"), "super-k-mers")
    strings = packed.where("packed is not null").select("mini", "digest", "packed", "pivot", "windows", "many")
    covered = repeated_in(strings, k)
    marks = packed.where("packed is null").select("digest", "k1", "k2", "start").join(covered, "digest").groupBy("k1", "k2").agg(F.collect_set(F.struct("start", "firsts")).alias("found"))
    marks = materialise(marks, "marks", instead_of=(packed,))
    left = texts.join(marks, ["k1", "k2"], "left").select("doc_id", "text", "found").mapInArrow(_apply(k), "doc_id long, n_words long, n_removed long, kept binary")
    return left.select("doc_id", "n_words", "n_removed", F.col("kept").cast("string").alias("kept_text"))
