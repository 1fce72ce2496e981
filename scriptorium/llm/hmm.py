"""A hidden Markov language model over words, trained by Baum-Welch.

Words are counted over all training documents. The ``HEAD`` most frequent words are symbols of their own; every other word
belongs to one of ``CLASSES`` classes (by a hash of its last letters, which the words of a language share), and its
probability within the class is (count + 1) / (words of the class + distinct words of the class + 1), an unseen word's
1 / the same, so each class keeps a share for what it hasn't seen. The latent states emit symbols; transitions, emissions and
initial states are re-estimated from expected counts that all partitions compute on all training documents and that are
summed by blocks of symbols before they reach the driver, whose model has a fixed size whatever the corpus. The first rounds
are over every ``SHARE``-th training document (by a hash of its symbols; a share, so it grows with the corpus) until its likelihood
settles (``SETTLED``); they only shorten the way. From there each round is over all training documents, again until the likelihood
settles. Documents are turned into symbols once, and the rounds and the scoring read those. The rounds compute in single
precision, sums and scores in double; sums have one order, so reruns agree. A document's score is the exact likelihood of its symbols by the scaled forward recursion, plus
its words' probabilities within their classes, in log10.

Word counts beyond the head never reach the driver or a broadcast: the rare words of documents meet their counts in a join.

Tokens: words ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z, then one end. Defined results: a null or empty text is one end token;
rows alike in id and text are separate rows; a null id counts as the text 'null' in the split; without any training
document all counts are 0, V is 0 and the base score is log10 1 = 0 per token; an empty table gives an empty result; other
columns don't matter.
"""

from __future__ import annotations

import gc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.llm.common import discard, materialise, pieces, tidy, word_blocks

#: Words that are symbols; classes of the others; latent states.
HEAD, CLASSES, STATES = 16_384, 512, 8
#: Training ends with the round that raises the log likelihood of all training documents by less than this share of it.
SETTLED = 1e-4
#: One in so many training documents takes part in the first rounds.
SHARE = 8
#: Frequent words whose counts are sent to all tasks (a few MB); the others' are joined.
KNOWN = 131_072
#: Distinct words that a task counts before it sends them on.
MEMORY = 400_000
END = b"\n"
#: Documents to a step of the recursion, steps to a scaling of it, symbols to a block of counts.
TOGETHER, SCALED, BLOCK = 512, 4, 1024
#: Symbols of a document beyond which its expected counts are found piece by piece, and those of a piece.
LONG, PIECE = 1_000_000, 65_536


def held_out(doc_id: str = "doc_id"):
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("null")).cast("binary")) % 7 == 2


def word_class(word: bytes) -> int:
    """The class of a word that is no symbol."""
    return zlib.crc32(word[-3:]) % CLASSES


@tidy
def _count(batches):
    """Words of training documents to (word, n), summed within a task as far as memory allows."""

    def rows(counts):
        words = list(counts)
        for s in range(0, len(words), 50_000):
            some = words[s : s + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.binary()), pa.array([counts[w] for w in some], pa.int64())], ["word", "n"])

    counts: Counter = Counter()
    for batch in pieces(batches):
        for text in batch.column(0).to_pylist():
            for words in word_blocks(text and text.lower()):
                counts.update(words)
            counts[END] += 1
        if len(counts) > MEMORY:
            yield from rows(counts)
            counts = Counter()
    yield from rows(counts)


def encoder(head: list[bytes]):
    """A function from words to symbols."""
    known, n, classes = {w: i for i, w in enumerate(head)}, len(head), {}

    def symbol(w: bytes) -> int:
        tail = w[-3:]
        if (c := classes.get(tail)) is None:
            c = classes[tail] = n + word_class(w)
        return c

    def encode(words: list[bytes]) -> np.ndarray:
        at = np.fromiter([known.get(w, -1) for w in words], np.int64, len(words))
        for i in np.flatnonzero(at < 0).tolist():
            at[i] = symbol(words[i])
        return at

    return encode


class Model:
    """pi (K), trans (K x K) and emit (K x symbols); symbols are head words, then classes, the end being a head word."""

    def __init__(self, head: list[bytes], pi: np.ndarray, trans: np.ndarray, emit: np.ndarray):
        self.head, self.pi, self.trans, self.emit = head, pi, trans, emit

    @property
    def symbols(self) -> int:
        return len(self.head) + CLASSES

    @classmethod
    def random(cls, head: list[bytes], weights: np.ndarray, seed: int = 11) -> Model:
        """States that stay with themselves, and emissions around the corpus's own frequencies."""
        rng = np.random.default_rng(seed)
        k, n = STATES, len(head) + CLASSES
        emit = (weights + 0.5) * rng.gamma(1.0, 1.0, (k, n))
        trans = np.full((k, k), 0.1 / max(1, k - 1)) + np.eye(k) * (0.9 - 0.1 / max(1, k - 1))
        return cls(head, np.full(k, 1 / k), trans, emit / emit.sum(1, keepdims=True))

    def forward(self, docs: list[np.ndarray], counts: bool = False):
        """Log10 likelihood of each symbol sequence; with counts, expected (pi, trans, emit) counts too.

        Documents of like length go through the recursion together, a row each; every few steps are scaled to sum to 1, and
        emissions by the likeliest state's, so that single precision suffices for counts. Arrays hold a row for each
        symbol, ordered by its place in its document, then by document, the longest first.
        """
        kind = np.float32 if counts else np.float64
        out = np.zeros(len(docs))
        k = len(self.pi)
        totals = (np.zeros(k), np.zeros((k, k)), np.zeros((k, self.symbols))) if counts else None
        order = sorted(range(len(docs)), key=lambda i: -len(docs[i]))
        while order and not len(docs[order[-1]]):
            order.pop()
        s = 0
        while counts and s < len(order) and len(docs[order[s]]) > LONG:
            out[order[s]] = self._long(docs[order[s]], totals)
            s += 1
        top = self.emit.max(0)
        emitted, first_pi = np.ascontiguousarray((self.emit / top).T, kind), self.pi.astype(kind)
        trans_, back = self.trans.astype(kind), np.ascontiguousarray(self.trans.T, kind)
        log_top = np.log10(top)
        while s < len(order):
            longest = len(docs[order[s]])
            some = order[s : s + max(1, min(TOGETHER, 600_000 // longest))]
            s += len(some)
            lengths = np.array([len(docs[i]) for i in some])
            live = np.searchsorted(-lengths, -np.arange(longest), side="left")  # how many rows are longer than t
            starts = np.concatenate([[0], np.cumsum(live)])
            n, first = int(starts[-1]), int(live[0])
            place = np.arange(n) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            symbols = np.concatenate([docs[i] for i in some])
            at = np.empty(n, np.int64)
            at[starts[place] + np.repeat(np.arange(len(some)), lengths)] = symbols
            alphas, ahead = np.empty((n, k), kind), emitted.take(at, 0)
            scales, last = {}, np.empty(first, kind)
            edges = starts.tolist()
            logs = np.add.reduceat(log_top[symbols], np.cumsum(lengths) - lengths)
            np.multiply(ahead[:first], first_pi, out=alphas[:first])
            for t in range(longest):
                a, b = edges[t], edges[t + 1]
                alpha = alphas[a:b]
                if t:
                    np.matmul(alphas[edges[t - 1] : edges[t - 1] + b - a], trans_, out=alpha)
                    alpha *= ahead[a:b]
                if t % SCALED == SCALED - 1:
                    c = scales[t] = alpha.sum(1)
                    alpha /= c[:, None]
                    logs[: b - a] += np.log10(c)
                ended = edges[t + 2] - b if t + 1 < longest else 0
                if ended < b - a:
                    last[ended : b - a] = alpha[ended:].sum(1)
            out[some] = logs + np.log10(last)
            if counts:
                pi, trans, emit = totals
                betas = np.empty((n, k), kind)
                for t in range(longest - 1, -1, -1):
                    a, b = edges[t], edges[t + 1]
                    ended = edges[t + 2] - b if t + 1 < longest else 0
                    beta = betas[a:b]
                    if ended:
                        np.matmul(ahead[b : b + ended], back, out=beta[:ended])
                    beta[ended:] = 1 / last[ended : b - a, None]
                    if t:
                        ahead[a:b] *= beta
                        if t in scales:
                            ahead[a:b] /= scales[t][:, None]
                if n > first:
                    before = np.arange(first, n) - np.repeat(live[:-1], live[1:])
                    trans += self.trans * (alphas.take(before, 0).T @ ahead[first:])
                alphas *= betas
                pi += alphas[:first].sum(0)
                for j in range(k):
                    emit[j] += np.bincount(at, alphas[:, j], self.symbols)
        return out, totals

    def _long(self, x: np.ndarray, totals) -> float:
        """The same for one very long sequence: states are kept at the beginnings of pieces only, and found again a piece at a time."""
        pi, trans, emit = totals
        emitted, log = np.ascontiguousarray(self.emit.T), 0.0

        def step(alpha, symbol):
            alpha = (self.pi if alpha is None else alpha @ self.trans) * emitted[symbol]
            c = alpha.sum()
            return alpha / c, c

        alpha, held = None, []
        for i, symbol in enumerate(x.tolist()):
            if i % PIECE == 0:
                held.append(alpha)
            alpha, c = step(alpha, symbol)
            log += np.log10(c)
        beta = np.ones(len(self.pi))
        for p in range(len(held) - 1, -1, -1):
            some, alpha = x[p * PIECE : (p + 1) * PIECE].tolist(), held[p]
            alphas, scales = [], []
            for symbol in some:
                alpha, c = step(alpha, symbol)
                alphas.append(alpha)
                scales.append(c)
            for i in range(len(some) - 1, -1, -1):
                emit[:, some[i]] += alphas[i] * beta
                before = alphas[i - 1] if i else held[p]
                ahead = emitted[some[i]] * beta / scales[i]
                if before is None:
                    pi += alphas[i] * beta
                else:
                    trans += self.trans * np.outer(before, ahead)
                    beta = self.trans @ ahead
        return log

    def improved(self, pi: np.ndarray, trans: np.ndarray, emit: np.ndarray, weights: np.ndarray) -> Model:
        """From expected counts, smoothed by a small share of the corpus's own frequencies so that no symbol is impossible."""
        emit = emit + 5 * STATES * (weights + 0.5) / (weights + 0.5).sum()
        pi, trans = pi + 0.1, trans + 0.1
        return Model(self.head, pi / pi.sum(), trans / trans.sum(1, keepdims=True), emit / emit.sum(1, keepdims=True))


    @property
    def arrays(self) -> tuple:
        """What travels to tasks: plain lists and arrays, which a worker can read without this package."""
        return self.head, self.pi, self.trans, self.emit


@tidy
def _expected(model: Model, batches):
    """Symbols of training documents to expected counts: rows (block, part, counts, log), one for each block of symbols, from each task."""
    from pyspark import TaskContext

    k = len(model.pi)
    pi, trans, emit, log = np.zeros(k), np.zeros((k, k)), np.zeros((k, model.symbols)), 0.0
    for docs in in_batches(batches):
        logs, more = model.forward(docs, counts=True)
        log += logs.sum()
        for total, x in zip((pi, trans, emit), more, strict=True):
            total += x
    blocks, values = [-1], [np.concatenate([pi, trans.ravel()])]
    for s in range(0, model.symbols, BLOCK):
        blocks.append(s)
        values.append(emit[:, s : s + BLOCK].ravel())
    logs, parts = [log] + [0.0] * (len(blocks) - 1), [TaskContext.get().partitionId()] * len(blocks)
    yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), pa.array(parts, pa.int32()), pa.array([v.astype("<f4").tobytes() for v in values], pa.binary()), pa.array(logs, pa.float64())], ["block", "part", "counts", "log"])


def _expect(sent):
    return lambda batches: _expected(Model(*sent.value), batches)


def in_batches(batches, most: int = 4_000_000):
    """Symbols of documents, some million at a time, so that many are of like length."""
    some, size = [], 0
    for batch in batches:
        for x in batch.column(0).to_pylist():
            some.append(np.frombuffer(x, "<u2"))
            size += len(some[-1])
            if size >= most:
                yield some
                some, size = [], 0
    if some:
        yield some


def _add(batches):
    """Rows (block, part, counts, log), sorted, to the sums of their block, in that order."""
    sums: dict = {}
    for batch in batches:
        for b, _, v, log in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            v = np.frombuffer(v, "<f4").astype(float)
            sums[b] = (sums[b][0] + v, sums[b][1] + log) if b in sums else (v, log)
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array([v.astype("<f8").tobytes() for v, _ in sums.values()], pa.binary()), pa.array([x for _, x in sums.values()], pa.float64())], ["block", "counts", "log"])


def train(symbols: DataFrame, model: Model, weights: np.ndarray) -> Model:
    """Baum-Welch over all of symbols (binary, two bytes each) from a first model until the likelihood settles; weights: how often each symbol comes."""
    spark = symbols.sparkSession
    k, before = len(model.pi), None
    while True:
        sent = spark.sparkContext.broadcast(model.arrays)
        counts = symbols.mapInArrow(_expect(sent), "block long, part int, counts binary, log double")
        rows = counts.repartition("block").sortWithinPartitions("block", "part").mapInArrow(_add, "block long, counts binary, log double").collect()
        sums = {r["block"]: np.frombuffer(r["counts"], "<f8") for r in rows}
        sent.destroy()
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        if not sums or not sums[-1][:k].any():
            return model
        emit = np.concatenate([sums[s].reshape(k, -1) for s in range(0, model.symbols, BLOCK)], axis=1)
        model = model.improved(sums[-1][:k], sums[-1][k:].reshape(k, k), emit, weights)
        log = sum(r["log"] for r in sorted(rows, key=lambda r: r["block"]))
        if before is not None and log - before < SETTLED * abs(log):
            return model
        before = log


def _encode(sent):
    """Rows (doc_id, held_out, text) with their symbols, what the frequent words give, and the rare words with how often each comes."""
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("within", pa.float64()), ("rare", pa.list_(pa.binary())), ("times", pa.list_(pa.int32())), ("symbols", pa.binary())])

    @tidy
    def run(batches):
        head, known, floor, room = sent.value
        encode, heads = encoder(head), len(head)
        # Of each frequent word: log10 of its count and one, which the base and, for a word of a class, the score add.
        logs = {w: float(np.log10(c + 1)) for w, c in known.items()}
        for batch in pieces(batches):
            out = []
            for text in batch.column(2).to_pylist():
                n, base, within, rare, symbols = 0, 0.0, 0.0, Counter(), []
                for words in (*word_blocks(text and text.lower()), [END]):
                    x = encode(words)
                    found = list(map(logs.get, words))
                    base += sum(y for y in found if y is not None) - floor * len(words)
                    rare.update(w for w, y in zip(words, found, strict=True) if y is None)
                    inner = np.flatnonzero(x >= heads).tolist()
                    within += sum(found[i] or 0.0 for i in inner) - float(room[x[inner] - heads].sum())
                    symbols.append(x.astype("<u2").tobytes())
                    n += len(words)
                out.append((n, n - sum(rare.values()), base, within, list(rare), list(rare.values()), b"".join(symbols)))
            if out:
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, t) for c, t in zip(zip(*out, strict=True), schema.types[2:], strict=True))], schema=schema)

    return run


def _score(sent):
    """Rows whose first column is the symbols: the likelihood takes its place."""

    @tidy
    def run(batches):
        model = Model(*sent.value)
        for batch in pieces(batches, 4096):
            logs = [x for docs in in_batches([batch]) for x in model.forward(docs)[0].tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(logs, pa.float64()), *batch.columns[1:]], ["likelihood", *batch.schema.names[1:]])

    return run


def _classes(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([word_class(w) for w in batch.column(0).to_pylist()], pa.int32())], ["word", "n", "class"])


def frequent(words: DataFrame, most: int) -> dict[bytes, tuple[int, int]]:
    """The most frequent words, ``most`` at most and all down to some count: word to (count, class).

    A histogram over finely graded counts tells the count to go down to, so no more rows than that are sorted or sent.
    """
    grade = F.floor(64 * F.log2(F.col("n"))).cast("int")
    many, least = 0, None
    for r in sorted(words.groupBy(grade.alias("grade")).count().collect(), key=lambda r: -r["grade"]):
        many += r["count"]
        if many > most:
            break
        least = r["grade"]
    return {} if least is None else {bytes(r["word"]): (r["n"], r["class"]) for r in words.where(grade >= least).collect()}


def score_documents(docs: DataFrame) -> DataFrame:
    """A row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("binary").alias("text"))
    training = texts.where("not held_out")
    words = training.select("text").mapInArrow(_count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    words = materialise(words.mapInArrow(_classes, "word binary, n long, class int"), "words")
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    known = frequent(words, KNOWN)
    head = sorted(known, key=lambda w: (-known[w][0], w))[:HEAD]
    # What each class holds: all its words but those that are symbols.
    held = np.zeros((CLASSES, 2), np.int64)
    for r in words.groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect():
        held[r["class"]] = r["n"], r["v"]
    for w in head:
        held[known[w][1]] -= known[w][0], 1
    weights = np.array([known[w][0] for w in head] + list(held[:, 0]), float)
    if END not in head:
        head, weights = [*head, END], np.insert(weights, len(head), 0.0)
    model = Model.random(head, weights)
    floor, room = float(np.log10(total + distinct + 1)), np.log10(held.sum(1) + 1)
    sent = spark.sparkContext.broadcast((head, {w: c for w, (c, _) in known.items()}, floor, room))
    first = texts.mapInArrow(_encode(sent), "doc_id long, held_out boolean, n_tokens long, n_known long, base double, within double, rare array<binary>, times array<int>, symbols binary")
    first = materialise(first.withColumn("row", F.monotonically_increasing_id()), "encoded")
    symbols = first.where("not held_out").select("symbols")
    share = materialise(symbols.where(F.crc32("symbols") % SHARE == 0), "share")
    model = train(share, model, weights)
    discard(share)
    trained = spark.sparkContext.broadcast(train(symbols, model, weights).arrays)
    # The rare words meet their counts; one that training hasn't seen counts 0 in the class that its letters give.
    rare = first.select("row", F.explode(F.arrays_zip("rare", "times")).alias("r")).select("row", F.col("r.rare").alias("word"), F.col("r.times").alias("times"))
    tail = rare.join(words.select("word", "n"), "word", "left").groupBy("row").agg(F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("more"), F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 1)).alias("log"))
    scored = first.select("symbols", "row", "doc_id", "held_out", "n_tokens", "n_known", "base", "within").mapInArrow(_score(trained), "likelihood double, row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, within double")
    out = scored.join(tail, "row", "left")
    log, more = F.coalesce("log", F.lit(0.0)), F.coalesce("more", F.lit(0))
    return out.select("doc_id", "held_out", "n_tokens", (F.col("n_known") + more).cast("long").alias("n_known"), F.lit(total).cast("long").alias("train_tokens"), (F.col("base") + log).alias("base_score"), (F.col("likelihood") + F.col("within") + log).alias("score"))
