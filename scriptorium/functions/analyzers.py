"""Analyzers: what turns a text into one entry of a publication's analysis, by name. All see one document, parsed once."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from functools import cached_property
from typing import Protocol

from scriptorium.functions import abbreviations, concepts, phrases, tagging
from scriptorium.functions.text import plain_analysis_schema, sentences


class Document:
    """A text in ASCII, and what analyzers share of it."""

    def __init__(self, text: str, backend: concepts.Backend | None = None):
        if not text.strip():
            raise ValueError("a document can't be blank")
        self.text, self.backend = text, backend

    @cached_property
    def spans(self) -> list[tuple[int, int]]:
        return sentences(self.text)

    @cached_property
    def abbreviations(self) -> list[tuple[str, str]]:
        return abbreviations.abbreviations(self.text)

    @cached_property
    def forms(self) -> dict[str, str]:
        return abbreviations.as_map(self.abbreviations)

    @cached_property
    def trees(self) -> list:
        return [concepts.parse(self.text[a:b], self.backend) for a, b in self.spans]

    @cached_property
    def phrases(self) -> list[str]:
        return phrases.phrases_of([(t.text, t.tag) for t in s.tokens] for s in self.trees)

    @property
    def defined(self) -> dict:
        return {"abbreviations": [{"short": s, "long": x} for s, x in self.abbreviations]}


class Analyzer(Protocol):
    """name: the entry's; schema: its type; digest: its value."""

    name: str
    schema: str

    def digest(self, document: Document) -> dict: ...


class NounChunker:
    """Noun phrases, counted as the chunker finds them."""

    name = "noun_phrases"
    schema = "struct<chunks:array<string>,recurring_chunks:array<string>,top_chunks:array<string>,abbreviations:array<struct<short:string,long:string>>>"

    def digest(self, document: Document) -> dict:
        return phrases.chunk(document.text, document.forms, document.phrases) | document.defined


def by_sentence(tags: list[dict], spans: list[tuple[int, int]]) -> list[list[dict]]:
    """Of tags in order of start, those inside each of the spans, which are in order too."""
    starts = [t["start"] for t in tags]
    return [[t for t in tags[bisect_left(starts, a) : bisect_right(starts, b)] if t["end"] <= b] for a, b in spans]


def shift(tags: list[dict], by: int) -> list[dict]:
    return [t | {"start": t["start"] + by, "end": t["end"] + by} for t in tags]


class DocumentAnalyzer:
    """Tags, concepts, noun phrases counted over the whole text, marked and emitted texts."""

    name = "nlp"
    schema = plain_analysis_schema(tagging.TAG, concepts.TAGGED_CONCEPT)

    def __init__(self, tagger: tagging.Tagger, common=tagging.COMMON, noisy=frozenset()):
        """common: words in lower case that tags of case-sensitive categories must not match by chance, those of ``noisy`` ones not at all."""
        self.tagger, self.common, self.noisy = tagger, common, noisy

    def tags(self, document: Document) -> list[dict]:
        """Tags over nouns and adjectives that agree with the text's abbreviations and in case, in order; a sentence with a gene and a disease is one more."""
        found, spans = self.tagger.tag(document.text), document.spans
        on_nouns = [t for (a, _), tree, mine in zip(spans, document.trees, by_sentence(found, spans), strict=True) for t in shift(concepts.on_content(shift(mine, -a), tree.tokens), a)]
        extended = {short.lower() for short, long in document.forms.items() if any(t["match"].lower() == long.lower() for t in on_nouns)}
        tags = [t for t in tagging.drop_known_acronyms(on_nouns, document.forms, document.text) if tagging.agrees_in_case(t, self.common, self.noisy, extended)]
        both = []
        for k, ((a, b), mine) in enumerate(zip(spans, by_sentence(tags, spans), strict=True)):
            for t in mine:
                t["sentence"] = k
            if {"GENE", "DISEASE"} <= {t["category"] for t in mine}:
                both.append({"match": "target-disease", "start": a, "end": b, "category": "TARGET&DISEASE", "reference_db": "TARGET&DISEASE", "reference": "", "original_value": "", "label": "", "sentence": k})
        return tags + both

    def digest(self, document: Document) -> dict:
        text, tags = document.text, self.tags(document)
        single = [t for t in tags if t["category"] != "TARGET&DISEASE"]
        said, emitted = [], {"plain": [], "pos_tag": [], "ent_tag": []}
        for k, ((a, _), tree, mine) in enumerate(zip(document.spans, document.trees, by_sentence(single, document.spans), strict=True)):
            tree, local = tree.collapsed(), shift(mine, -a)
            for c in tree.concepts():
                said.append(c | {"sentence": k} | {f"{x}_tags": list(concepts.tags_by_category(local, c[f"{x}_range"]).items()) for x in ("subject", "object")})
            emitted["plain"].append(concepts.plain_tagged(tree.tokens))
            emitted["pos_tag"].append(concepts.pos_tagged(tree.tokens))
            emitted["ent_tag"].append(concepts.entity_tagged(tree.tokens, local))
        grouped: dict[str, list[dict]] = {}
        for t in tags:
            grouped.setdefault(f"{t['category']}|{t['reference_db']}", []).append(t)
        emitted = {name: "\n".join(lines) for name, lines in emitted.items()}
        own = {"concepts": said, "tagged_entities": tags, "tagged_entities_grouped": list(grouped.items()), "tagged_text": tagging.mark(text, tags), "embedding_text": emitted}
        return phrases.occurrences(text, document.forms, document.phrases) | document.defined | own
