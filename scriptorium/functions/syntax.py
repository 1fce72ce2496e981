"""Sentences as dependency trees: what is read from a tree, and the collapse of noun phrases into one token each.

A tree comes from a backend (``concepts.Backend``): tokens with part of speech, dependency and the place of their head.
Everything here is over such tokens and nothing else, so a parser with a trained model may take the rule backend's place.
"""

from __future__ import annotations

from dataclasses import dataclass

#: Dependencies of subjects, of objects, and of what extends a noun to its left and right.
SUBJECTS = frozenset("nsubj nsubjpass csubj csubjpass agent expl meta".split())
OBJECTS = frozenset("dobj dative attr oprd pobj conj compound".split())
EXTENDS = frozenset("nsubj nsubjpass csubj csubjpass agent expl dobj attr oprd pobj compound amod meta npadvmod nmod".split())
#: Words that deny, auxiliary dependencies, what is added to a verb, brackets.
NEGATIONS = frozenset(("no", "not", "n't", "never", "none", "false"))
HELPERS = frozenset(("aux", "auxpass"))
PARTICLES = frozenset(("prep", "agent"))
OPENED, CLOSED = "([{<", ")]}>"
NAMES = frozenset(("NOUN", "PROPN"))


@dataclass(slots=True)
class Token:
    """head: the place of the head, a root's own; tag: the finer part of speech; space: whether white space follows."""

    i: int
    text: str
    idx: int
    lemma: str
    pos: str
    tag: str = ""
    dep: str = ""
    head: int = -1
    space: bool = True

    @property
    def end(self) -> int:
        return self.idx + len(self.text)


class Sentence:
    """A text and its tree."""

    def __init__(self, text: str, tokens: list[Token]):
        self.text, self.tokens = text, tokens
        self.children: list[list[Token]] = [[] for _ in tokens]
        for t in tokens:
            if 0 <= t.head < len(tokens) and t.head != t.i:
                self.children[t.head].append(t)

    def ancestors(self, t: Token) -> list[Token]:
        """From the head up to the root."""
        out, seen = [], {t.i}
        while 0 <= t.head < len(self.tokens) and t.head not in seen:
            t = self.tokens[t.head]
            seen.add(t.i)
            out.append(t)
        return out

    def subtree(self, t: Token) -> list[Token]:
        """The token and all below it, in order of place."""
        if not self.children[t.i]:
            return [t]
        out, todo = {t.i}, [t.i]
        while todo:
            new = [c.i for c in self.children[todo.pop()] if c.i not in out]
            out.update(new)
            todo += new
        return [self.tokens[i] for i in sorted(out)]

    def negated(self, t: Token) -> bool:
        """Whether a direct dependent denies it."""
        return any(c.text.lower() in NEGATIONS for c in self.children[t.i])

    def verbs(self) -> list[Token]:
        return [t for t in self.tokens if t.pos == "VERB" and t.dep not in HELPERS]

    def verb_ancestors(self, t: Token) -> list[Token]:
        """The verbs above a token that aren't auxiliaries, the nearest first."""
        return [a for a in self.ancestors(t) if a.pos == "VERB" and a.dep != "aux"]

    def extended_verb(self, v: Token) -> tuple[str, list[Token], list[Token]]:
        """What the verb reads as, its path (itself and the verbs above it), and the subjects that it and they have."""
        above = [a for a in self.ancestors(v) if a.pos == "VERB" and a.dep not in HELPERS]
        outermost = f"{above[-1].lemma.lower()} {v.text.lower()}" if above else v.lemma.lower()
        words = [outermost, *(c.text.lower() for c in self.children[v.i] if c.dep in PARTICLES)]
        path = [v, *above]
        subjects = [c for p in path for c in self.children[p.i] if c.i < p.i and c.pos in NAMES and c.dep in SUBJECTS]
        return " ".join(words), path, subjects

    def extended_token(self, t: Token) -> tuple[int, int]:
        """First and last place of the unbroken run around a token of itself and the dependents that extend it."""
        first = last = t.i
        mine = {c.i for c in self.children[t.i] if c.dep in EXTENDS}
        if not mine:
            return first, last
        while first - 1 in mine:
            first -= 1
        while last + 1 in mine:
            last += 1
        return first, last

    def dependent_objects(self, t: Token, path: list[Token]) -> list[Token]:
        """The objects at or below a token that the verbs of ``path``, and no others, lie above."""
        at = [v.i for v in path]
        return [d for d in self.subtree(t) if d.dep in OBJECTS and [a.i for a in self.verb_ancestors(d)] == at]

    def bracket_spans(self) -> list[tuple[int, int]]:
        """Pairs of neighbours of which the first opens a bracket, and is nothing else, or holds one, and the second closes it."""
        out = []
        if not any(c in self.text for c in OPENED):  # tokens are pieces of the text
            return out
        for t, after in zip(self.tokens, self.tokens[1:], strict=False):
            alone = len(t.text) == 1 and t.text in OPENED and not t.space
            closes = any(c in after.text for c in CLOSED) if alone else len(after.text) == 1 and after.text in CLOSED
            if closes and any(c in t.text for c in OPENED):
                out.append((t.i, after.i))
        return out

    def phrase_spans(self) -> list[tuple[int, int]]:
        """The extended tokens of nouns that are more than the noun."""
        spans = (self.extended_token(t) for t in self.tokens if t.pos in NAMES and self.children[t.i])
        return [s for s in spans if s[0] < s[1]]

    def merged(self, spans: list[tuple[int, int]]) -> Sentence:
        """Each span one token, which has the place in the tree of the span's topmost; of overlapping spans the first counts."""
        chosen: list[tuple[int, int]] = []
        for first, last in sorted(spans):
            if not chosen or first > chosen[-1][1]:
                chosen.append((first, last))
        if not chosen:
            return self
        place, groups, opens = [], [], dict(chosen)
        at = 0
        while at < len(self.tokens):
            last = opens.get(at, at)
            place += [len(groups)] * (last + 1 - at)
            groups.append((at, last))
            at = last + 1
        out = []
        for n, (first, last) in enumerate(groups):
            top = self.tokens[first]
            if first == last:
                out.append(Token(n, top.text, top.idx, top.lemma, top.pos, top.tag, top.dep, place[top.head] if 0 <= top.head < len(place) else n, top.space))
                continue
            for t in self.tokens[first : last + 1]:
                if t.head == t.i or not first <= t.head <= last:
                    top = t
                    break
            head = place[top.head] if 0 <= top.head < len(place) else n
            whole = self.text[self.tokens[first].idx : self.tokens[last].end]
            out.append(Token(n, whole, self.tokens[first].idx, whole, top.pos, top.tag, top.dep, head, self.tokens[last].space))
        return Sentence(self.text, out)

    def collapsed(self) -> Sentence:
        """Brackets first, then noun phrases of what is left."""
        once = self.merged(self.bracket_spans())
        return once.merged(once.phrase_spans())

    def concepts(self) -> list[dict]:
        return list(self.each_concept())

    def each_concept(self):
        """Each verb's subjects by the objects on its right, one at a time: a long sentence has as many as subjects times objects."""
        for v in self.verbs():
            verb, path, subjects = self.extended_verb(v)
            objects = [o for r in self.children[v.i] if r.i > v.i and r.pos != "VERB" for o in self.dependent_objects(r, path)] if subjects else []
            if not objects:
                continue
            below = self.subtree(v)
            said = self.text[below[0].idx : below[-1].end]
            for s in subjects:
                for o in objects:
                    yield {"subject": s.text, "subject_range": {"start": s.idx, "end": s.end}, "object": o.text, "object_range": {"start": o.idx, "end": o.end}, "verb": verb, "verb_path": [t.text for t in path], "negated": any(map(self.negated, (v, s, o))), "sentence_text": self.text, "verb_subtree": said if said != self.text else None}


def tokens_in_range(tokens: list[Token], start: int, end: int) -> list[Token]:
    """Tokens that begin within a range and end within it or one behind."""
    return [t for t in tokens if start <= t.idx <= end and start <= t.end <= end + 1]


def clustered(found: list[str]) -> list[str]:
    """Phrases but those that are a word of another; of each such family the longest stands for it."""
    words = {w for p in found for w in p.split(" ") if w != p}
    return sorted({p for p in found if p not in words}, key=lambda p: (-len(p), p))
