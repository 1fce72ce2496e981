"""Subject-verb-object concepts and the texts that are emitted from tokens. The parser is a rule backend; one with a model has the same method."""

from __future__ import annotations

from bisect import bisect_right
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DataType, StructType

from scriptorium.functions.phrases import VERBS, pos
from scriptorium.functions.syntax import NEGATIONS, Sentence, Token, tokens_in_range
from scriptorium.functions.tagging import TAG
from scriptorium.functions.text import PUNCTUATION, RUN, STOPWORDS, parted, remembered, sentences
from scriptorium.steps import slices

AUXILIARIES = frozenset("is are was were be been being has have had do does did can could may might must should will would".split())
STOPS = frozenset(STOPWORDS)
CONCEPT = "struct<subject:string,subject_range:struct<start:int,end:int>,object:string,object_range:struct<start:int,end:int>,verb:string,verb_path:array<string>,negated:boolean,sentence_text:string,verb_subtree:string,sentence:int"
#: With the tags of subject and object by category, as the whole analysis has them.
TAGGED_CONCEPT = f"{CONCEPT},subject_tags:map<string,array<{TAG}>>,object_tags:map<string,array<{TAG}>>>"
CONCEPT += ">"
#: Bytes of concepts, about, that a worker gathers before it sends them on.
CONCEPT_BYTES = 2 << 20
KINDS = {"VB": "VERB", "NNP": "PROPN", "NN": "NOUN", "NNS": "NOUN", "JJ": "ADJ", "IN": "ADP", ".": "PUNCT"}


@remembered()
def guessed(word: str, first: bool) -> tuple[str, str, str]:
    """Lemma, part of speech and finer part of speech."""
    low, tag = word.lower(), pos(word, first)
    kind = "NEG" if low in NEGATIONS else "VERB" if low in AUXILIARIES or low in VERBS else KINDS.get(tag, "DET")
    lemma = "be" if low in ("is", "are", "was", "were", "been", "being") else low.removesuffix("s") if kind == "VERB" and len(low) > 3 else low
    return lemma, kind, tag


@remembered()
def guessed_run(run: str) -> tuple[tuple[int, str, str, str, str], ...]:
    """(offset, token, lemma, part of speech, finer one) of a run without white space, if it doesn't begin a sentence."""
    return tuple((at, w, *guessed(w, False)) for at, w in parted(run))


class Backend(Protocol):
    """Anything that turns a sentence into tokens with part of speech, dependency and head."""

    def parse(self, sentence: str) -> list[Token]: ...


class RuleBackend:
    """Guessed parts of speech, and a tree by a few rules.

    The last verb of a run is its head, the others help it. The first such verb is the root, later ones are conjuncts of it.
    The last noun of a run is its head. Behind a preposition it is that one's object; with a verb and no other noun behind
    it, or no verb before it, a subject; otherwise an object of the verb before it, or a conjunct of that verb's first object.
    """

    def parse(self, sentence: str) -> list[Token]:
        out, n = [], 0
        for m in RUN.finditer(sentence):
            start = m.start()
            for at, word, lemma, kind, tag in guessed_run(m[0]):
                out.append(Token(n, word, start + at, lemma, kind, tag, "", -1, False))
                n += 1
            out[-1].space = m.end() < len(sentence)
        if out:
            out[0].lemma, out[0].pos, out[0].tag = guessed(out[0].text, True)
        attach(out)
        return out


def attach(parsed: list[Token]) -> None:
    """Give each token its head and dependency, by the rules of ``RuleBackend``."""
    main, noun_head = [], {}
    for run in runs(parsed, ("VERB", "NEG")):
        verbs = [t for t in run if t.pos == "VERB"]
        if verbs:
            main.append(verbs[-1])
            for t in run:
                t.head, t.dep = verbs[-1].i, "neg" if t.pos == "NEG" else "aux"
    for run in runs(parsed, ("NOUN", "PROPN", "ADJ")):
        nouns = [t for t in run if t.pos != "ADJ"]
        if nouns:
            noun_head[nouns[-1].i] = run[0].i
            for t in run:
                t.head, t.dep = nouns[-1].i, "amod" if t.pos == "ADJ" else "compound"
    heads = sorted(noun_head)
    root = main[0].i if main else heads[0] if heads else 0
    verb = last = first_object = None
    ahead = [m.i for m in main][::-1]  # the next one last
    mains = set(ahead)
    for t in parsed:
        if t.i in mains:
            t.head, t.dep = (t.i, "ROOT") if t.i == root else (root, "conj")
            verb, first_object = t, None
            ahead.pop()
        elif t.i in noun_head:
            before = noun_head[t.i] - 1
            while before >= 0 and parsed[before].pos == "DET":
                before -= 1
            at = bisect_right(heads, t.i)
            behind = heads[at : at + 1]
            if before >= 0 and parsed[before].pos == "ADP":
                t.head, t.dep = before, "pobj"
            elif ahead and (not behind or behind[0] > ahead[-1]):
                t.head, t.dep = ahead[-1], "nsubj"
            elif verb is None:
                t.head, t.dep = (ahead[-1], "nsubj") if ahead else (root, "conj")
            elif first_object is None:
                t.head, t.dep = verb.i, "attr" if verb.lemma == "be" else "dobj"
                first_object = t
            else:
                t.head, t.dep = first_object.i, "conj"
            if t.i == root:
                t.head, t.dep = t.i, "ROOT"
        elif t.pos == "ADP":
            t.head, t.dep = (last if last is not None else root), "prep"
        elif t.head < 0:
            at = bisect_right(heads, t.i) if t.pos in ("DET", "NEG") else len(heads)
            follows = heads[at] if at < len(heads) else None
            t.head, t.dep = (root if follows is None else follows), {"PUNCT": "punct", "NEG": "neg", "ADJ": "acomp"}.get(t.pos, "det")
        if t.i in noun_head or t.i in mains:
            last = t.i


def runs(parsed: list[Token], kinds) -> list[list[Token]]:
    out: list[list[Token]] = []
    for t in parsed:
        if t.pos in kinds and out and out[-1][-1].i == t.i - 1:
            out[-1].append(t)
        elif t.pos in kinds:
            out.append([t])
    return out


RULES = RuleBackend()


def parse(sentence: str, backend: Backend | None = None) -> Sentence:
    return Sentence(sentence, (backend or RULES).parse(sentence))


def concepts(sentence: str, number: int = 0, backend: Backend | None = None) -> list[dict]:
    """The concepts of a sentence, over its collapsed tree."""
    return [c | {"sentence": number} for c in parse(sentence, backend).collapsed().concepts()]


def document_concepts(text: str | None) -> list[dict]:
    return list(each_concept(text))


def each_concept(text: str | None):
    """The concepts of a text, one at a time."""
    for k, (a, b) in enumerate(sentences(text or "")):
        for c in parse(text[a:b]).collapsed().each_concept():
            yield c | {"sentence": k}


def tags_by_category(tags: list[dict], span: dict) -> dict[str, list[dict]]:
    """The tags inside a span, ends included, by category; both count from the start of the sentence."""
    out: dict[str, list[dict]] = {}
    for t in tags:
        if span["start"] <= t["start"] and t["end"] <= span["end"]:
            out.setdefault(t["category"], []).append(t)
    return out


def on_content(tags: list[dict], parsed: list[Token]) -> list[dict]:
    """Tags over a noun or an adjective; both count from the start of the sentence."""
    if not tags:
        return []
    held = [(t.idx + len(t.text), t.idx) for t in parsed if t.pos in ("NOUN", "PROPN", "ADJ")]
    first = lambda g: bisect_right(held, (g["start"], float("inf")))  # noqa: E731  the first that ends behind the tag's start
    return [g for g in tags if (at := first(g)) < len(held) and held[at][1] < g["end"]]


def concept_table(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each concept of each text: the key and what a concept has. A worker sends them a few megabytes at a time, so it
    holds neither those of a batch of texts nor all of one text."""
    schema = StructType([docs.schema[key], *DataType.fromDDL(CONCEPT).fields])
    kind = pa.struct(to_arrow_schema(schema))

    def run(batches):
        held, size = [], 0
        for part in slices(batches):
            for k, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                for c in each_concept(t):
                    held.append({key: k} | c)
                    size += 500 + len(c["sentence_text"])
                    if size > CONCEPT_BYTES:
                        yield pa.RecordBatch.from_struct_array(pa.array(held, kind))
                        held, size = [], 0
        if held:
            yield pa.RecordBatch.from_struct_array(pa.array(held, kind))

    return docs.select(key, text).mapInArrow(run, schema)


def plain_text(words):
    """What the plain emitter keeps of a column of words: no stop words, no punctuation, blanks as underscores."""
    return F.array_join(F.transform(F.filter(words, lambda w: w.rlike("[A-Za-z0-9]") & ~F.lower(w).isin(*STOPWORDS)), lambda w: F.replace(w, F.lit(" "), F.lit("_"))), " ")


def kept(parsed: list[Token]) -> list[Token]:
    """Tokens but punctuation and stop words."""
    return [t for t in parsed if t.text and t.pos != "PUNCT" and t.text.lower() not in STOPS]


def written(word: str, lower: bool) -> str:
    word = word.strip().replace(" ", "_")
    return word.lower() if lower else word


def plain_tagged(parsed: list[Token], lower: bool = True) -> str:
    return " ".join(written(t.text, lower) for t in kept(parsed))


def pos_tagged(parsed: list[Token], lower: bool = True) -> str:
    """text|POS of each kept token."""
    return " ".join(f"{written(t.text, lower)}|{t.pos}" for t in kept(parsed))


def label_of(text: str | None) -> str:
    """A label without punctuation, as ``text.sanitise_label`` makes it in columns."""
    return PUNCTUATION.sub("", text or "")


def entity_tagged(parsed: list[Token], tags: list[dict], lower: bool = True, with_pos: bool = False, skipped=("TARGET&DISEASE",)) -> str:
    """Kept tokens; one inside tags as the first tag's reference, the categories of all, and the first one's label. ASCII only."""
    held: dict[int, list[dict]] = {}
    for g in tags:
        if g["category"] not in skipped:
            for t in tokens_in_range(parsed, g["start"], g["end"]):
                held.setdefault(t.i, []).append(g)
    out = []
    for t in kept(parsed):
        mine = held.get(t.i, ())
        reference = (mine[0]["reference"] or "").rpartition("/")[2] if mine else t.text
        parts = [written(reference, lower), *([t.pos] if with_pos else [])]
        if mine:
            parts += ["_".join(g["category"] for g in mine), label_of(mine[0]["label"])]
        out.append("|".join(parts))
    return " ".join(out).encode("ascii", "ignore").decode()
