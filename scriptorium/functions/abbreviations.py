"""Abbreviations and their definitions: bracketed short forms aligned with the words before them."""

from __future__ import annotations

import re

from pyspark.sql import functions as F
from pyspark.sql import types as T

from scriptorium.functions.text import sentences

BRACKETS = (("(", ")"), ("[", "]"), ("{", "}"), ("<", ">"))
BRACKET = re.compile(r"[()\[\]{}<>]")
FOUND = T.ArrayType(T.StructType([T.StructField("short", T.StringType()), T.StructField("long", T.StringType())]))


class Unbalanced(ValueError):
    """The rest of a sentence can't be read."""


def plausible(short: str) -> bool:
    """2 to 10 characters, two words at most, a letter somewhere and a letter or digit first."""
    return 2 <= len(short) <= 10 and len(short.split()) <= 2 and re.search("[A-Za-z]", short) is not None and short[0].isalnum()


def candidates(sentence: str):
    """(start, text) of what stands in outermost brackets. A bracket right behind a closed one isn't looked at."""
    for opened, closed in BRACKETS:
        if sentence.count(opened) != sentence.count(closed):
            raise Unbalanced(sentence)
        if sentence.find(closed) < sentence.find(opened):
            raise Unbalanced(sentence)
        at = sentence.find(opened)
        while at >= 0:
            depth, end = 1, at + 1
            while depth:
                if end == len(sentence):
                    raise Unbalanced(sentence)
                depth += (sentence[end] == opened) - (sentence[end] == closed)
                end += 1
            inner = sentence[at + 1 : end - 1]
            short = inner.strip()
            if short and plausible(short):
                yield at + 1 + len(inner) - len(inner.lstrip()), short
            at = sentence.find(opened, end + 1)


def window(sentence: str, start: int, short: str) -> str | None:
    """The words before the bracket that hold as many beginnings with the short form's first letter as it has of them."""
    stop = start - 2
    if stop < 0:
        return None
    words = sentence[:stop].lower().split()
    key = short[0].lower()
    need = short.lower().count(key)
    at = [i for i, w in enumerate(words) if w.startswith(key)]
    if need > len(at):
        return None
    first = at[len(at) - need]
    lead = len(" ".join(words[:first]))
    return sentence[lead:stop].strip()


def align(long: str, short: str) -> str | None:
    """Right to left, every character of the short form; for its first, the longest suffix from a word's beginning."""
    if len(long) < len(short) or short in long.split():
        return None
    s, l = len(short) - 1, len(long) - 1
    while s > 0:
        c = short[s].lower()
        if c.isalnum():
            while l >= 0 and long[l].lower() != c:
                l -= 1
            if l < 0:
                return None
        s, l = s - 1, l - 1
    found = None
    while l >= 0:
        if long[l].lower() == short[0].lower():
            if l == 0 or not long[l - 1].isalnum():
                found = l
            if l == 1:
                break
        l -= 1
    if found is None:
        return None
    best = long[found:]
    return best if len(best.split()) <= min(len(short) + 5, 2 * len(short)) else None


def abbreviations(text: str | None) -> list[tuple[str, str]]:
    """(short, long) in order of the text; what can't be aligned is left out, an unbalanced sentence from there on."""
    out = []
    if not text or not BRACKET.search(text):
        return out
    for a, b in sentences(text):
        sentence = text[a:b]
        if not BRACKET.search(sentence):
            continue
        try:
            for start, short in candidates(sentence):
                long = window(sentence, start, short)
                best = align(long, short) if long else None
                if best:
                    out.append((short, best))
        except Unbalanced:
            continue
    return out


def as_map(found: list[tuple[str, str]]) -> dict[str, str]:
    """The first long form of each short form."""
    out: dict[str, str] = {}
    for short, long in found:
        out.setdefault(short, long)
    return out


def find_abbreviations():
    @F.pandas_udf(FOUND)
    def run(texts):
        return texts.map(lambda t: [{"short": s, "long": x} for s, x in abbreviations(t)])

    return run


def bracketed(text):
    """The simple bracketed candidates, as a column: what round brackets without inner ones hold, if plausible."""
    inner = F.regexp_extract_all(text, F.lit(r"\(([^()]{2,10})\)"), 1)
    return F.filter(F.transform(inner, F.trim), lambda s: F.length(s).between(2, 10) & (F.size(F.split(s, r"[ \t\n\r]+")) <= 2) & s.rlike("[A-Za-z]") & s.rlike("^[A-Za-z0-9]"))
