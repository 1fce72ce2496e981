"""Packing documents into sequences by minimum bin slack.

A document is its token ids and an end id. Its whole windows of ``capacity`` tokens are sequences of their own; what is left
of it is one piece, which is never cut again. The pieces are dealt to groups of a bounded size. In a group, each sequence
starts with the longest piece that is left; a subset-sum dynamic program over the multiset of the other lengths (sums are
the bits of one integer) picks those that fill the window closest to its capacity, and backtracking gives how many of each
length are taken.

A sequence is padded to ``capacity``, unless its tokens are a power of two, when it stays as it is (``padded_length``). Full
sequences need no padding; of what the last window of a group can't fill, only a sequence of another length is padded.

Defined results: a null text is empty (the end id alone); a repeated row is packed as often as it comes; an empty table gives
no piece; ids are carried as they are, nulls included. The string of a special token in a text, such as '<|endoftext|>', is
text: it gets ordinary word pieces (``encode_special_tokens``), where the tokenizer's default setting gives the token's own id.
"""

from __future__ import annotations

import json
import os
import re
import string
import zlib
from bisect import bisect_left, bisect_right
from collections import defaultdict, deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.llm.common import materialise, pieces, release, tidy

#: Pieces to a group, about: enough that nearly every window is filled to the last token.
GROUP_PIECES = 2048
#: Distinct runs whose ids a task remembers.
MEMORY = 400_000

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, salt long"
PLACED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, padded_length long"


def kinds() -> np.ndarray:
    """What each byte of UTF-8 is: 0 white space, 1 a letter, 2 a mark, 3 a digit, 4 anything that only the tokenizer can tell."""
    kind = np.full(256, 4, np.uint8)
    for k, members in enumerate([string.whitespace, string.ascii_letters, string.punctuation.replace("'", ""), string.digits]):
        kind[list(members.encode())] = k
    return kind


KIND = kinds()
#: By 5 * (kind before) + kind: whether a run begins. Digits stand alone; next to kind 4 only white space is a border.
BEGINS = np.array([k > 0 and (b == 0 or b < 4 and k < 4 and (b != k or k == 3)) for b in range(5) for k in range(5)])
LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)


def runs_of(data: np.ndarray, starts: np.ndarray) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The runs in UTF-8 ``data``, in lower case where they are plain, and how many lie before each text of ``starts``."""
    kind = KIND[data]
    lead = np.flatnonzero(data[:-1] == 0xC3)  # of U+00C0 to U+00FF: letters but for two signs
    tail = data[lead + 1]
    lead = lead[(tail >= 0x80) & (tail <= 0xBF) & (tail != 0x97) & (tail != 0xB7)]
    kind[lead] = kind[lead + 1] = 1
    before = np.zeros_like(kind)
    before[1:] = kind[:-1]
    begins = BEGINS[before * 5 + kind]
    inside = starts[starts < len(data)]
    begins[inside] = kind[inside] > 0
    first = np.searchsorted(np.flatnonzero(begins), starts)

    full = kind > 0
    data, begins, kind = data[full], np.flatnonzero(begins[full]), kind[full]
    ends = np.append(begins, len(data)).astype(np.int32)
    if len(begins):
        small = LOWER[data]
        tail = np.flatnonzero(data[:-1] == 0xC3) + 1
        small[tail[(data[tail] >= 0x80) & (data[tail] <= 0x9E) & (data[tail] != 0x97)]] += 0x20
        odd = np.logical_or.reduceat(kind == 4, begins)
        data = np.where(np.repeat(odd, np.diff(ends)), data, small)
    runs = pa.Array.from_buffers(pa.binary(), len(begins), [None, pa.py_buffer(ends), pa.py_buffer(data)])
    return runs.dictionary_encode(), first


class Encoder:
    """Texts to 32-bit ids.

    The tokenizer drops white space and codes each run of letters, run of marks and digit by itself, so a text's ids are
    those of its runs in a row. Runs are found in the bytes, told apart by a dictionary and remembered (a bounded number);
    unknown ones go to the tokenizer many at a time, and the ids that end a run tell where each one's ids stop. What lies
    between white space and holds an apostrophe or anything but ASCII and Latin letters goes to it as it is, and so do whole
    texts if the vocabulary has no ends of runs. vocabulary: a file's path, or the name of a public tokenizer.
    """

    PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+|[!-&(-/:-@\[-`{-~]+|[0-9]")

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        if not os.path.exists(vocabulary):
            import public_tokenizers

            vocabulary = public_tokenizers.path(vocabulary)
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism
        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.encode_special_tokens = True
        # For runs, which are in lower case and stand apart already: the same model, without looking for either.
        whole = json.loads(self.tokenizer.to_str())
        self.by_runs = whole["model"].get("end_of_word_suffix") == "</w>"
        whole |= {"normalizer": None, "pre_tokenizer": {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}}
        self.bare = Tokenizer.from_str(json.dumps(whole))
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.ends[i] = token.endswith("</w>")
        self.forget()
        del whole
        release()  # what reading the vocabulary has left behind

    def forget(self) -> None:
        #: Each run's place in ``stops``; its ids end there and begin at the stop before.
        self.runs: dict[bytes, int] = {}
        self.stops, self.flat = np.zeros(1, np.int64), np.zeros(0, np.uint32)

    def ids(self, texts: list[str], bare: bool = False) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in (self.bare if bare else self.tokenizer).encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, new: list[bytes]) -> None:
        plain, odd = [], []
        for r in new:
            (plain if self.PLAIN.fullmatch(r) else odd).append(r)
        flat, stops, at = [self.flat], [self.stops], len(self.flat)
        for s in range(0, len(plain), 1000):
            ids = self.ids([b" ".join(plain[s : s + 1000]).decode()], bare=True)[0]
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) != len(plain[s : s + 1000]):
                raise ValueError("a run of letters or marks has more ends than one")
            flat.append(ids)
            stops.append(ends + at)
            at += len(ids)
        coded = self.ids([r.decode(errors="replace") for r in odd])
        flat += coded
        stops.append(at + np.cumsum([len(x) for x in coded], dtype=np.int64))
        for r in plain + odd:
            self.runs[r] = len(self.runs) + 1
        self.flat, self.stops = np.concatenate(flat), np.concatenate(stops)

    def encode_bytes(self, data: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
        """The ids of each of the texts that begin at ``starts`` and fill ``data``."""
        runs, first = runs_of(data, starts)
        every = runs.dictionary.to_pylist()
        new = [r for r in every if r not in self.runs]
        if len(self.runs) + len(new) > MEMORY:
            self.forget()
            new = every
        if new:
            self.learn(new)
        place = np.fromiter(map(self.runs.__getitem__, every), np.int64, len(every))[runs.indices.to_numpy()]
        begin = self.stops[place - 1]
        length = self.stops[place] - begin
        end = np.concatenate([[0], np.cumsum(length)])
        ids = self.flat[np.repeat(begin - end[:-1], length) + np.arange(end[-1])]
        return np.split(ids, end[first[1:]])

    def encode(self, texts: pa.Array):
        """Yields the ids of each text; a null is empty."""
        texts = texts.cast(pa.string()).fill_null("") if len(texts) else texts
        if not self.by_runs:
            yield from self.ids(texts.to_pylist())
            return
        _, offsets, data = texts.buffers()
        offsets = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1].tolist() if len(texts) else [0]
        data = np.frombuffer(data if data is not None else b"", np.uint8)
        parts = []
        for some in some_at_a_time(data, offsets):
            coded = self.encode_bytes(data[some[0][1] : some[-1][2]], np.array([start - some[0][1] for _, start, _ in some]))
            for (last, _, _), ids in zip(some, coded, strict=True):
                parts.append(ids)
                if last:
                    yield np.concatenate(parts) if len(parts) > 1 else ids
                    parts = []


def some_at_a_time(data: np.ndarray, offsets: list[int], most: int = 2_000_000):
    """Lists of (whether a text ends here, start, end), of about ``most`` bytes unless one text is longer.

    A long text is cut at white space, so that what is made of it byte by byte stays small.
    """
    some = []
    for start, end in zip(offsets, offsets[1:], strict=False):
        while start is not None:
            stop = min(start + most, end)
            while stop < end and KIND[data[stop]]:
                stop += 1
            some.append((stop == end, start, stop))
            if stop - some[0][1] >= most:
                yield some
                some = []
            start = stop if stop < end else None
    if some:
        yield some


def cut(docs: DataFrame, vocabulary: str, end_id: int, capacity: int) -> DataFrame:
    """docs (doc_id, text) to pieces of at most ``capacity`` tokens."""

    @tidy
    def run(batches):
        encoder, end, n = Encoder(vocabulary), np.array([end_id], "<u4").tobytes(), 0
        for batch in pieces(batches):
            out = []
            for doc, ids in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1)), strict=True):
                total = len(ids) + 1
                for s in range(0, total, capacity):
                    length, crc = min(capacity, total - s), zlib.crc32(ids[s : s + capacity].astype("<u4", copy=False))
                    out.append((doc, s, length, zlib.crc32(end, crc) if s + length == total else crc, total, n))
                    n += 1
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "salt"]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (zip(*out, strict=True) if out else [[]] * 6)], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECES)


def fill(lengths: dict[int, int], room: int, order: list[int] | None = None) -> list[tuple[int, int]]:
    """Which lengths, and how many of each, come closest to ``room`` without going beyond it.

    lengths: how many there are of each; order: the lengths, ascending, if they are at hand.
    """
    order = sorted(lengths) if order is None else order
    mask, reach, trail = (1 << (room + 1)) - 1, 1, []
    for k in range(bisect_right(order, room) - 1, -1, -1):
        length = order[k]
        trail.append((length, reach))
        for _ in range(min(lengths[length], room // length)):
            wider = reach | reach << length & mask
            if wider == reach:
                break
            reach = wider
        if reach >> room & 1:
            break
    left, taken = reach.bit_length() - 1, []
    for length, before in reversed(trail):
        n = 0
        while not before >> left & 1:
            left -= length
            n += 1
        if n:
            taken.append((length, n))
    return taken


def pack_lengths(lengths: dict[int, int], capacity: int):
    """Yields, for each sequence, the lengths in it."""
    lengths, order = dict(lengths), sorted(lengths)

    def take(length, n):
        lengths[length] -= n
        if not lengths[length]:
            del lengths[length]
            del order[bisect_left(order, length)]

    while order:
        first = order[-1]
        take(first, 1)
        rest = fill(lengths, capacity - first, order) if capacity > first else []
        for length, n in rest:
            take(length, n)
        yield [first, *(length for length, n in rest for _ in range(n))]


def padded(tokens: int, capacity: int) -> int:
    """The length of a sequence with its padding."""
    return tokens if tokens & (tokens - 1) == 0 else capacity


def _place(capacity: int):
    def place(group: pa.Table) -> pa.Table:
        group = group.sort_by([(c, "ascending") for c in ("length", "doc_id", "start", "salt")])
        at = defaultdict(deque)
        for i, length in enumerate(group["length"].to_pylist()):
            at[length].append(i)
        sequence, offset, lengths = (np.zeros(group.num_rows, np.int64) for _ in range(3))
        base = group["part"][0].as_py() << 32
        for k, chosen in enumerate(pack_lengths({x: len(i) for x, i in at.items()}, capacity)):
            used, whole = 0, padded(sum(chosen), capacity)
            for length in chosen:
                i = at[length].popleft()
                sequence[i], offset[i], lengths[i] = base + k, used, whole
                used += length
        names = [x.split()[0] for x in PLACED.split(", ")]
        return group.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset)).append_column("padded_length", pa.array(lengths)).select(names)

    return place


def pack(docs: DataFrame, vocabulary: str = "word_bpe_49k.json", end_id: int = 2, capacity: int = 4096) -> DataFrame:
    """Where each piece of each document lies: sequence_id, offset, the piece's checksum and the sequence's length with its padding."""
    pieces = materialise(cut(docs, vocabulary, end_id, capacity), "pieces")
    groups = max(1, -(-pieces.count() // GROUP_PIECES))
    dealt = pieces.withColumn("part", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", "salt"), F.lit(groups)))
    return dealt.groupBy("part").applyInArrow(_place(capacity), PLACED)
