"""Toxicity by a weighted finite-state pattern grammar over clauses.

A lexical acceptor maps words to symbols: insults with a weight (words and word beginnings, learned from labelled documents:
how much likelier a toxic document holds them), threats, targets, negation, reported speech and the ends of clauses from short
lists. Five weighted transducers read these symbols, each what the one before it writes:

- negation: until a comma or the end of its clause, what a negation stands before comes out denied;
- reported speech: until the sentence ends (a colon or a comma doesn't), what a report stands before comes out reported;
- target: an insult or a threat of a clause with a target comes out aimed, or is followed by an aim if the target comes later;
- insult: weighs insults, less if denied or reported and more if aimed; a clause of one word is no statement and isn't accepted;
- threat: weighs threats that are aimed; one without a target has no weight.

Their composition is one deterministic weighted automaton. A clause's score is the weight of its path, nothing else: the
same words weigh differently in another pattern, and a clause that isn't accepted weighs nothing. A document's score is
logistic in the sum of its clauses' scores against its length; its three numbers are fitted on the labelled documents.

The lexicon and the fit come from ``SAMPLE`` labelled documents at most (in expectation; chosen by a hash of id and text), with
near copies counted once, so what the driver holds has a fixed size. Scoring covers every whole text.

Defined results: a null or empty text scores like a text without any match; a doc_id with several labels is toxic if one is;
rows with a repeated id are scored each; a null id is never a training row; without labelled rows of both kinds every score
is 0; an empty table gives an empty result; other columns are never read.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.llm.common import materialise, pieces, tidy

#: Labelled documents to learn from; entries of the lexicon; the shortest and longest word beginnings that are entries.
SAMPLE, ENTRIES, SHORTEST, LONGEST = 20_000, 20_000, 4, 9
#: Words whose symbol a task remembers; words of a text that are looked at together.
MEMORY, SLICE = 150_000, 50_000

THREATS = "kill hurt destroy shoot stab punch beat burn hang murder strangle bomb töten schlagen umbringen vernichten tuer frapper détruire matar golpear destruir".split()
TARGETS = "you your yours yourself he she they them him her his their people everyone du dich dir dein euch ihr sie tu toi vous ton votre ils elles tú usted ustedes ellos ellas".split()
NEGATIONS = "not no never none neither nor cannot don't isn't aren't wasn't won't can't nicht kein keine nie niemals pas jamais aucun nunca jamás ningún".split()
REPORTS = "said says wrote writes claimed claims called quoted reported according alleged sagte schrieb behauptete dit écrit selon dijo escribió según".split()

#: What the lexical acceptor writes. A neutral word moves no transducer but for being there.
NEUTRAL, INSULT, THREAT, TARGET, NEGATION, REPORT, COMMA, COLON, STOP = "neutral insult threat target negation report comma colon stop".split()
SYMBOLS = (NEUTRAL, INSULT, THREAT, TARGET, NEGATION, REPORT, COMMA, COLON, STOP)
#: What weighs: the share of its word's weight that an insult has by how it stands, and the weight of a threat, of which a share counts too.
SHARE = {"": 1.0, "aimed ": 1.5, "reported ": 0.25, "denied ": 0.1}
THREAT_WEIGHT = 4.0
#: What an aim that follows an insult or a threat adds, as a share of it.
LATE = SHARE["aimed "] - SHARE[""]

FEATURES = 2
EDGES = re.compile(r"^[\W_]+|[\W_]+$")
BORDER = re.compile(r"([,.!?;:|])[\"')\]]*$")
BORDERS = {",": COMMA, ":": COLON} | dict.fromkeys(".!?;|", STOP)


class Transducer:
    """Deterministic and weighted. arcs[state, symbol] is (next state, what is written, share, constant): the weight of the arc is
    share * the word's own weight + constant. Without an arc a symbol is written as it is and the state stays. final: the
    states in which a clause may end."""

    def __init__(self, arcs: dict, final: set[int] | None = None):
        self.arcs, self.final = arcs, final

    def read(self, state: int, symbol: str):
        return self.arcs.get((state, symbol), (state, (symbol,), 0.0, 0.0))

    def accepts(self, state: int) -> bool:
        return self.final is None or state in self.final


def _marks(state: int, mark: str, reset: tuple[str, ...], by: str) -> dict:
    """Arcs of a transducer that after ``by`` writes insults and threats with a mark, until one of ``reset``."""
    arcs = {(0, by): (state, (NEUTRAL,), 0.0, 0.0)} | {(state, x): (0, (x,), 0.0, 0.0) for x in reset}
    return arcs | {(state, x): (state, (mark + x,), 0.0, 0.0) for x in (INSULT, THREAT)} | {(state, by): (state, (NEUTRAL,), 0.0, 0.0)}


def negation() -> Transducer:
    return Transducer(_marks(1, "denied ", (COMMA, COLON, STOP), NEGATION))


def report() -> Transducer:
    return Transducer(_marks(1, "reported ", (STOP,), REPORT))


def target() -> Transducer:
    """State: 1 with a target; else 2, 3 or 4 with a plain insult, a plain threat or both that wait for one."""
    arcs: dict = {}
    wait = {0: (2, 3), 2: (2, 4), 3: (4, 3), 4: (4, 4)}
    for s, (after_insult, after_threat) in wait.items():
        arcs[s, INSULT] = (after_insult, (INSULT,), 0.0, 0.0)
        arcs[s, THREAT] = (after_threat, (THREAT,), 0.0, 0.0)
        aims = (("aim insult",) if s in (2, 4) else ()) + (("aim threat",) if s in (3, 4) else ())
        arcs[s, TARGET] = (1, (*aims, NEUTRAL), 0.0, 0.0)
    arcs |= {(1, x): (1, ("aimed " + x,), 0.0, 0.0) for x in (INSULT, THREAT)} | {(1, TARGET): (1, (NEUTRAL,), 0.0, 0.0)}
    return Transducer(arcs | {(s, x): (0, (x,), 0.0, 0.0) for s in range(5) for x in (COLON, STOP)})


def insult() -> Transducer:
    """State: how many words the clause has, none, one, or more; it may end with none or more. A comma doesn't end it."""
    weights = {mark + INSULT: (share, 0.0) for mark, share in SHARE.items()} | {"aim insult": (LATE, 0.0)}
    words = (NEUTRAL, *(mark + x for mark in SHARE for x in (INSULT, THREAT)))
    arcs = {(s, x): (min(s + 1, 2), (x,) if x not in weights else (NEUTRAL,), *weights.get(x, (0.0, 0.0))) for s in range(3) for x in words}
    arcs |= {(s, "aim insult"): (s, (), *weights["aim insult"]) for s in range(3)}
    return Transducer(arcs | {(s, x): (0, (x,), 0.0, 0.0) for s in range(3) for x in (COLON, STOP)}, {0, 2})


def threat() -> Transducer:
    """One state: only aimed threats weigh, those that are denied or reported a little, whoever they are for."""
    weights = {"aimed " + THREAT: SHARE["aimed "], "aim threat": SHARE["aimed "], "denied " + THREAT: SHARE["denied "], "reported " + THREAT: SHARE["reported "]}
    return Transducer({(0, x): (0, (), 0.0, share * THREAT_WEIGHT) for x, share in weights.items()})


def compose(*parts: Transducer):
    """The composition: each part reads what the part before it writes. Returns, by state and symbol, (next state, share,
    constant), and whether a clause may end in each state. State 0 is the start."""

    def step(states, symbol):
        states, share, constant, line = list(states), 0.0, 0.0, [symbol]
        for i, part in enumerate(parts):
            written = []
            for x in line:
                states[i], out, more, fixed = part.read(states[i], x)
                written += out
                share, constant = share + more, constant + fixed
            line = written
        return tuple(states), share, constant

    start = (0,) * len(parts)
    known, todo, table = {start: 0}, [start], []
    while len(table) < len(todo):
        row = {}
        for x in SYMBOLS:
            to, share, constant = step(todo[len(table)], x)
            if to not in known:
                known[to] = len(todo)
                todo.append(to)
            row[x] = (known[to], share, constant)
        table.append(row)
    return table, [all(p.accepts(s) for p, s in zip(parts, states, strict=True)) for states in todo]


def grammar():
    return compose(negation(), report(), target(), insult(), threat())


def plain(word: str) -> str:
    return EDGES.sub("", word).lower()


class Reader:
    """Composes the word acceptor with the grammar and reads documents."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon, (self.table, self.final) = lexicon, grammar()
        self.fixed = {w: s for words, s in ((THREATS, THREAT), (TARGETS, TARGET), (NEGATIONS, NEGATION), (REPORTS, REPORT)) for w in words}
        self.known: dict[str, tuple[str, float, str | None] | None] = {}

    def symbol(self, raw: str) -> tuple[str, float, str | None] | None:
        """symbol, weight, the border behind the word; None for a neutral word without one."""
        word, border = plain(raw), BORDER.search(raw)
        border = BORDERS[border[1]] if border else None
        weight = max((w for e in entries_of(word) if (w := self.lexicon.get(e)) is not None), default=None)
        if weight is not None:
            return INSULT, weight, border
        kind = self.fixed.get(word, NEUTRAL)
        return (kind, 0.0, border) if kind != NEUTRAL or border else None

    def clauses(self, words: list[str]):
        """The weight of each clause that is accepted with one."""
        known, table, final = self.known, self.table, self.final
        state, score, last, weight = 0, 0.0, -1, 0.0
        for s in range(0, len(words), SLICE):
            some = words[s : s + SLICE]
            if len(known) > MEMORY:
                known.clear()
            for w in some:
                if w not in known:
                    known[w] = self.symbol(w)
            for i, found in enumerate(map(known.__getitem__, some), s):
                if found is None:
                    continue
                kind, own, border = found
                if i - last > 1:  # neutral words between: the second moves no transducer that the first hasn't
                    for _ in range(min(2, i - last - 1)):
                        state = table[state][NEUTRAL][0]
                last = i
                state, share, constant = table[state][kind]
                weight = own if kind == INSULT else weight  # an aim that follows is for the insult before it
                score += share * weight + constant
                if border:
                    if border != COMMA:
                        if score and final[state]:
                            yield score
                        score = 0.0
                    state = table[state][border][0]
        if len(words) - 1 > last:
            for _ in range(min(2, len(words) - 1 - last)):
                state = table[state][NEUTRAL][0]
        if score and final[state]:
            yield score

    def features(self, text: str | None) -> list[float]:
        words = text.split() if text else []
        total = sum(self.clauses(words))
        return [math.log1p(total), math.log1p(len(words))] if total else [0.0, 0.0]


def entries_of(word: str) -> list[str]:
    """What a word may match in the lexicon: itself (with a mark at its end) and its beginnings."""
    return [f"{word}$", *(word[:n] for n in range(SHORTEST, min(LONGEST, len(word)) + 1))] if len(word) >= 3 else []


def is_held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def sample_of(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """Labelled documents (text, toxic) that aren't held out, about ``most`` of them, however often an id comes."""
    known = labels.where("doc_id is not null and toxic is not null").where(~is_held_out()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text is not null")
    share = min(1.0, most / max(1, own.select("doc_id").join(known, "doc_id").count()))
    some = own.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) < int(share * 1_000_000))
    return some.join(known, "doc_id").select("text", "toxic")


@tidy
def _signature(batches):
    """(text, toxic) to (signature, toxic, text): near copies mostly share the smallest hash of their word triples."""
    for batch in pieces(batches):
        marks = []
        for text in batch.column(0).to_pylist():
            words = text.lower().split()
            marks.append(min((xxhash.xxh3_64_intdigest(" ".join(words[i : i + 3])) for i in range(max(1, len(words) - 2))), default=0) >> 1)
        yield pa.RecordBatch.from_arrays([pa.array(marks, pa.int64()), batch.column(1), batch.column(0)], ["signature", "toxic", "text"])


@tidy
def _vocabulary(batches):
    """(toxic, text) to (entry, documents with it that are toxic, that aren't), summed within a task."""
    counts: dict[int, Counter] = {0: Counter(), 1: Counter()}

    def rows():
        every = list(counts[0].keys() | counts[1].keys())
        return pa.RecordBatch.from_arrays([pa.array(every, pa.string()), *(pa.array([counts[t][e] for e in every], pa.int64()) for t in (1, 0))], ["entry", "n1", "n0"])

    for batch in pieces(batches):
        for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            counts[toxic].update({e for w in {plain(w) for w in text.split()} for e in entries_of(w)})
        if len(counts[0]) + len(counts[1]) > 500_000:
            yield rows()
            counts = {0: Counter(), 1: Counter()}
    yield rows()


def learn_lexicon(some: DataFrame) -> dict[str, float]:
    """Words and beginnings that toxic documents hold more often, by a lower bound of the log ratio."""
    n = {r["toxic"]: r["count"] for r in some.groupBy("toxic").count().collect()}
    if not n.get(0) or not n.get(1):
        return {}
    counts = some.select("toxic", "text").mapInArrow(_vocabulary, "entry string, n1 long, n0 long").groupBy("entry").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
    ratio = F.log((F.col("n1") + 0.5) / (n[1] + 1)) - F.log((F.col("n0") + 0.5) / (n[0] + 1))
    bound = ratio - 1.5 * F.sqrt(1 / (F.col("n1") + 0.5) + 1 / (F.col("n0") + 0.5))
    best = counts.where("n1 >= 4").select("entry", ratio.alias("ratio"), bound.alias("bound")).where("bound > 1").orderBy(F.desc("bound"), "entry").limit(ENTRIES)
    return {r["entry"]: float(r["ratio"]) for r in best.collect()}


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 0.5, rounds: int = 60) -> np.ndarray:
    """Logistic weights, the constant last, by damped Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, keep = np.zeros(x.shape[1]), ridge * np.eye(x.shape[1])
    keep[-1, -1] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + keep, x.T @ (y - p) - keep @ w)
        w += step / max(1.0, float(np.abs(step).max()) / 4)
        if np.abs(step).max() < 1e-6:
            break
    return w


def learn(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> tuple[dict[str, float], list[float]]:
    """The lexicon and the weights; empty without rows of both labels."""
    signed = sample_of(docs, labels, most).mapInArrow(_signature, "signature long, toxic int, text string")
    some = materialise(signed.groupBy("signature", "toxic").agg(F.min("text").alias("text")).select("toxic", "text"), "labelled")
    lexicon = learn_lexicon(some)
    if not lexicon:
        return {}, []
    rows = some.select("toxic", "text").mapInArrow(_features(lexicon), "toxic int, features array<double>").collect()
    rows.sort(key=lambda r: (r["features"], r["toxic"]))  # sums in one order, so that reruns agree to the last bit
    x, y = np.array([r["features"] for r in rows]), np.array([r["toxic"] for r in rows], float)
    return lexicon, fit(x, y).tolist()


def _features(lexicon):
    @tidy
    def run(batches):
        reader = Reader(lexicon)
        for batch in pieces(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([reader.features(t) for t in batch.column(1).to_pylist()], pa.list_(pa.float64()))], ["toxic", "features"])

    return run


def _score(lexicon, weights):
    @tidy
    def run(batches):
        reader, w = Reader(lexicon), np.array(weights)
        for batch in pieces(batches):
            if len(w):
                x = np.array([reader.features(t) for t in batch.column(2).to_pylist()]).reshape(-1, FEATURES)
                score = 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))
            else:
                score = np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score, pa.float64())], ["k1", "k2", "score"])

    return run


def score_documents(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> DataFrame:
    """A row per document: doc_id, held_out, score, predicted."""
    lexicon, weights = learn(docs, labels, most)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), is_held_out().alias("held_out"), "text")
    scored = own.mapInArrow(_score(lexicon, weights), "k1 long, k2 boolean, score double")
    return scored.select(F.col("k1").alias("doc_id"), F.col("k2").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def reject(docs: DataFrame, labels: DataFrame, at: float = 0.5, most: int = SAMPLE) -> DataFrame:
    """The rows of docs that score below ``at``, with all their columns; the scoring runs beside the columns, without a join."""
    lexicon, weights = learn(docs, labels, most)
    names, schema = docs.columns, docs.schema
    text_at = next(i for i, c in enumerate(names) if c.lower() == "text")

    @tidy
    def run(batches):
        reader, w = Reader(lexicon), np.array(weights)
        for batch in pieces(batches):
            if len(w):
                x = np.array([reader.features(t) for t in batch.column(text_at).to_pylist()]).reshape(-1, FEATURES)
                clean = 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30))) < at
                yield batch.filter(pa.array(clean))
            else:
                yield batch

    return docs.mapInArrow(run, schema)
