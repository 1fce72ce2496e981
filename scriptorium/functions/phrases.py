"""Noun phrases: a rule tagger and chunker, and the statistics over phrase counts."""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StringType, StructField, StructType

from scriptorium.functions import abbreviations
from scriptorium.functions.text import STOPWORDS, parted, remembered, sentences, to_ascii
from scriptorium.steps import slices

#: Which neighbouring tags merge, and into what.
MERGES = {
    ("NNP", "NNP"): "NNP", ("NNP", "NN"): "NNP", ("NN", "NNS"): "NNP", ("NNP", "PO"): "NNP", ("NN", "IN"): "NN", ("IN", "JJ"): "NN",
    ("NN", "NN"): "NNI", ("NNI", "NN"): "NNI", ("JJ", "JJ"): "JJ", ("JJ", "NN"): "NNI", ("NN", "JJ"): "NNI",
}
STOPS = frozenset(STOPWORDS)
NOUNS = ("NNP", "NNI", "NN")
ADJECTIVES = ("al", "ic", "ive", "ous", "ful", "less", "able", "ible", "ary", "ant", "ent")
PREPOSITIONS = frozenset("of in for to with on at by from into".split())
VERBS = frozenset("is are was were be been being has have had do does did suggest suggests reduce reduces prevent prevents regulate regulates inhibit inhibits show shows cause causes increase increases".split())


@remembered()
def pos(word: str, first: bool) -> str:
    """A deterministic guess; a backend with a model may take its place."""
    low = word.lower()
    if not word[0].isalnum():
        return "."
    if low in VERBS or low.endswith("ing") and len(low) > 5:
        return "VB"
    if low in PREPOSITIONS:
        return "IN"
    if low in STOPS:
        return "DT"
    if word[0].isupper() and not first:
        return "NNP"
    if low.endswith(ADJECTIVES) and len(low) > 4:
        return "JJ"
    return "NNS" if low.endswith("s") and not low.endswith("ss") and len(low) > 3 else "NN"


@remembered()
def guesses(run: str) -> tuple[tuple[str, str], ...]:
    """The tokens of a run without white space and their tags, if it doesn't begin a sentence."""
    return tuple((w, pos(w, False)) for _, w in parted(run))


def guess_sentence(sentence: str) -> list[tuple[str, str]]:
    out = [x for run in sentence.split() for x in guesses(run)]
    if out:
        out[0] = (out[0][0], pos(out[0][0], True))
    return out


def noun_phrases(text: str | None) -> list[str]:
    return phrases_of(guess_sentence(text[a:b]) for a, b in sentences(text or ""))


def phrases_of(tagged_sentences) -> list[str]:
    """Of sentences of (word, tag): tags merge pairwise, leftmost first, until none can; phrases are joined by spaces but before punctuation."""
    out, merges = [], MERGES.get
    for words in tagged_sentences:
        tags, parts = [], []  # of what stands so far and can't merge: a token's tag, and what it is written of
        for word, tag in words:
            part = [word]
            while tags and (merged := merges((tags[-1], tag))):
                tags.pop()
                before = parts.pop()
                before.append(" " if part[0][0].isalnum() else "")
                before += part
                tag, part = merged, before
            tags.append(tag)
            parts.append(part)
        out += ["".join(p) for p, t in zip(parts, tags, strict=True) if t in NOUNS]
    return out


def merge_counts(counts: Counter, forms: dict[str, str]) -> Counter:
    """Plurals into singulars (ascending, so chains have one result), then short forms into long ones."""
    for phrase in sorted(counts):
        if phrase in counts and phrase + "s" in counts:
            counts[phrase] += counts.pop(phrase + "s")
    for short, long in sorted(forms.items()):
        s, lo = short.lower(), long.lower()
        if s in counts and s != lo:
            counts[lo] += counts.pop(s)
    return counts


def automaton(found):
    import ahocorasick

    machine = ahocorasick.Automaton()
    for p in found:
        if p:
            machine.add_word(p, p)
    if len(machine):
        machine.make_automaton()
    return machine


def held_in(found) -> Counter:
    """How many of the other phrases hold each phrase: one pass over them with an automaton of all."""
    machine, out = automaton(found), Counter()
    for s in found if len(machine) else ():
        out.update({p for _, p in machine.iter(s)} - {s})
    return out


def standing(found, text: str) -> Counter:
    """How often each phrase stands in a text, without overlaps, in one pass."""
    machine, out, free = automaton(found), Counter(dict.fromkeys(found, 0)), {}
    for last, p in machine.iter(text) if len(machine) else ():
        if last - len(p) + 1 >= free.get(p, 0):
            out[p] += 1
            free[p] = last + 1
    return out


def chunk(text: str | None, forms: dict[str, str] | None = None, found: list[str] | None = None) -> dict:
    """chunks, recurring_chunks and top_chunks of a text; phrases inside others count once more for each. found: its noun phrases, if known."""
    counts = Counter(p.lower() for p in (noun_phrases(text) if found is None else found))
    for long in (forms or {}).values():
        counts.setdefault(long.lower(), 1)
    chunks = sorted(counts)
    counts = merge_counts(counts, forms or {})
    inside = held_in(counts)
    boosted = Counter({k: n + inside[k] for k, n in counts.items()})
    ranked = sorted(boosted.items(), key=lambda x: (-x[1], x[0]))
    return {"chunks": chunks, "recurring_chunks": sorted(k for k, n in ranked if n > 1), "top_chunks": [k for k, n in ranked[:5] if n > 1]}


def occurrences(text: str, forms: dict[str, str] | None = None, found: list[str] | None = None) -> dict:
    """chunks, recurring_chunks and top_chunks of a document: its noun phrases but stop words, each counted wherever its letters stand in the text.

    A short form whose long form doesn't stand in the text is written out first. found: the noun phrases of the text, if known.
    """
    whole = text
    for short, long in (forms or {}).items():
        if short in whole and long not in whole:
            whole = whole.replace(short, long)
    found = noun_phrases(whole) if found is None or whole != text else found
    chunks = sorted({p for p in found if p.lower() not in STOPS})
    low = whole.lower()
    counts = merge_counts(standing({p.lower() for p in chunks}, low), forms or {})
    ranked = sorted(counts.items(), key=lambda x: (-x[1], x[0]))
    return {"chunks": chunks, "recurring_chunks": sorted(k for k, n in ranked if n > 1), "top_chunks": [k for k, n in ranked[:5] if n > 1]}


CHUNKED = "struct<chunks:array<string>,recurring_chunks:array<string>,top_chunks:array<string>>"


def chunk_texts():
    """Of normalised texts; their letters become ASCII here."""

    def run(t):
        t = to_ascii(t or "")
        return chunk(t, abbreviations.as_map(abbreviations.abbreviations(t)))

    return F.udf(run, CHUNKED, useArrow=True)


def counted(docs, words, change=None, key: str = "doc_id", phrase: str = "phrase", n: str = "n"):
    """key, phrase, n: how often each word of ``words``, a column of arrays over docs, comes in all rows of a key.

    Rows of a key meet in one task, before their words are told apart, and are in order there: what is shuffled is docs, once,
    and a worker holds the words of one key. change: what becomes of a key's counts, as ``with_plurals`` and the like.
    """
    told = docs.repartition(key).sortWithinPartitions(key).select(key, words.alias("words"))
    schema = StructType([docs.schema[key], StructField(phrase, StringType()), StructField(n, LongType())])
    kinds = to_arrow_schema(schema)

    def run(batches):
        keys, found, numbers = [], [], []
        mine, of = Counter(), None

        def tell():
            told = change(mine) if change else mine
            keys.extend([of] * len(told))
            found.extend(told.keys())
            numbers.extend(told.values())

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((keys, found, numbers), kinds, strict=True)], schema=kinds)

        for part in slices(batches):
            for k, some in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                if k != of:
                    tell()
                    mine, of = Counter(), k
                    if len(keys) > 20_000:
                        yield batch()
                        keys, found, numbers = [], [], []
                mine.update(some or ())
        tell()
        yield batch()

    return told.mapInArrow(run, schema)


def with_plurals(counts: dict[str, int]) -> dict[str, int]:
    """A plural's count goes to its singular where there is one; what went on to a plural of the plural stays out."""
    return {p: n + counts.get(p + "s", 0) for p, n in counts.items() if not (p.endswith("s") and p[:-1] in counts)}


def with_forms(counts: dict[str, int], forms: dict[str, str]) -> dict[str, int]:
    """A short form's count goes to its long form."""
    out = Counter()
    for p, n in counts.items():
        out[forms.get(p, p)] += n
    return out


def recurring(counts: dict[str, int], most: int | None = None) -> dict[str, int]:
    """What comes more than once: the most frequent first, then by letters."""
    return dict(sorted(((p, n) for p, n in counts.items() if n > 1), key=lambda x: (-x[1], x[0]))[:most])


def clusters(found):
    """Of an array of phrases, those that are no word of another, JVM-side: longest first, then by letters."""
    words = F.flatten(F.transform(found, lambda p: F.filter(F.split(p, " "), lambda w: w != p)))
    return F.array_sort(F.array_except(found, words), lambda a, b: F.when(F.length(a) != F.length(b), F.length(b) - F.length(a)).when(a < b, -1).when(a > b, 1).otherwise(0))
