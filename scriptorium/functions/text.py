"""Text functions: normalisation, sentences, tokens, analyzers and stop words. Columns in, columns out, but for the tokenizers."""

from __future__ import annotations

import functools
import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space of the byte-oriented expressions.
BLANK = r"[ \t\n\x0B\f\r]"
#: English function words that are never terms.
STOPWORDS = tuple(
    "a about above after again all also am an and any are as at be because been before being below between both but by can could did do does doing down during each few for from further had has have having he her here hers him his how i if in into is it its itself just me more most my no nor not now of off on once only or other our ours out over own same she should so some such than that the their theirs them then there these they this those through to too under until up very was we were what when where which while who whom why will with would you your yours".split()
)


def remembered(most: int = 100_000, longest: int = 64):
    """A function of words that remembers its results but those of long words. Unlike the standard library's it travels to workers
    by value, with the package."""

    def wrap(f):
        known: dict = {}

        @functools.wraps(f)
        def look_up(*args):
            out = known.get(args)
            if out is None:
                out = f(*args)
                if len(args[0]) <= longest:
                    if len(known) >= most:
                        known.clear()
                    known[args] = out
            return out

        return look_up

    return wrap


def greek_names() -> dict[str, str]:
    """Greek letters to English names, from their Unicode names; capitals are capitalised, the final sigma isn't mapped."""
    out = {}
    for code in (*range(0x391, 0x3AA), *range(0x3B1, 0x3CA)):
        name = unicodedata.name(chr(code), "")
        if code not in (0x3A2, 0x3C2) and name:
            word = name.rpartition(" ")[2].lower()
            out[chr(code)] = word.capitalize() if code < 0x3B1 else word
    return out


def name_greek(text: Column) -> Column:
    for letter, name in greek_names().items():
        text = F.replace(text, F.lit(letter), F.lit(name))
    return text


def collapse_blanks(text: Column) -> Column:
    """Runs of two blanks or more become one space; a single newline stays."""
    return F.regexp_replace(text, BLANK + "{2,}", " ")


def normalise(text: Column) -> Column:
    return collapse_blanks(name_greek(text))


#: What Unicode doesn't take apart, in ASCII.
SPELLED = str.maketrans(
    {"ß": "ss", "ẞ": "SS", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ð": "d", "Ð": "D", "þ": "th", "Þ": "Th", "ł": "l", "Ł": "L", "ħ": "h", "Ħ": "H", "ı": "i"}
    | dict.fromkeys("‐‑‒–−", "-") | {"—": "--", "×": "x", "÷": "/", "«": "<<", "»": ">>"} | dict.fromkeys("‘’‚‛′", "'") | dict.fromkeys("“”„‟″", '"')
)


SPELT = re.compile("[%s]" % "".join(map(chr, SPELLED)))


def to_ascii(text: str) -> str:
    """The letters under their accents, ligatures and typographic marks spelled; what has no ASCII form goes."""
    return text if text.isascii() else unicodedata.normalize("NFKD", SPELT.sub(lambda m: SPELLED[ord(m[0])], text)).encode("ascii", "ignore").decode()


def text_to_analyze(title: Column, abstract: Column) -> Column:
    """Both, the title alone, or nothing: an abstract without a title isn't analysed."""
    has = lambda c: F.coalesce(c, F.lit("")) != ""
    return F.when(has(title) & has(abstract), F.concat_ws(" ", title, abstract)).when(has(title), title).otherwise("")


def split_tagged(text: Column) -> tuple[Column, Column]:
    """Title and abstract of a tagged text, parted at the first '. '."""
    at = F.instr(text, ". ")
    return F.when(at > 0, F.substring(text, F.lit(1), at - 1)).otherwise(text), F.when(at > 0, F.substring(text, at + 2, F.length(text))).otherwise("")


#: ASCII and other punctuation of Unicode's class P.
PUNCTUATION = re.compile("[%s]" % re.escape("".join(c for c in map(chr, range(0x3100)) if unicodedata.category(c)[0] == "P")))


def sanitise_label(text: Column) -> Column:
    return F.regexp_replace(text, r"\p{P}", "")


def count_of(text: Column, phrase: Column) -> Column:
    """How often a phrase comes in a text, without overlaps."""
    return F.when(F.length(phrase) > 0, ((F.length(text) - F.length(F.replace(text, phrase, F.lit("")))) / F.length(phrase)).cast("long")).otherwise(F.lit(0).cast("long"))


def analyze(text: Column) -> Column:
    """The index analyzer: words of letters of any script and digits, in lower case, no possessive, no stop words, plurals to singulars (the s-stemmer)."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{M}\p{N}']+"), lambda w: w != "")
    words = F.transform(words, lambda w: F.regexp_replace(w, "'s$|'$", ""))
    words = F.filter(words, lambda w: (w != "") & ~w.isin(*STOPWORDS))
    return F.transform(words, singular)


def whitespace_tokens(text: Column) -> Column:
    """The analyzer of relations: what stands between white space."""
    return F.filter(F.split(text, BLANK + "+"), lambda w: w != "")


def sentence_values(text: Column) -> Column:
    """The nested sentences of an abstract, as an index holds them: array<struct<value>>."""
    parted = F.split(F.regexp_replace(text, r"([.!?])" + BLANK + "+", "$1\u0001"), "\u0001")
    return F.transform(F.filter(parted, lambda s: s != ""), lambda s: F.struct(s.alias("value")))


#: Labels of named entities in the groups that the analyzer tells apart.
ENTITY_GROUPS = {x: "ENT" for x in "ENT PERSON NORP FAC ORG GPE LOC LAW PRODUCT EVENT WORK_OF_ART LANGUAGE".split()} | {x: x for x in "DATE TIME PERCENT MONEY QUANTITY ORDINAL CARDINAL".split()}


def entity_group(label: Column) -> Column:
    """The group of a label; null for one that isn't known."""
    return F.create_map(*[F.lit(x) for pair in ENTITY_GROUPS.items() for x in pair])[label]


def represented(word: Column, kind: Column) -> Column:
    """A word as text|KIND: white space as underscores, addresses hidden, '?' for no kind."""
    plain = F.concat_ws("|", F.regexp_replace(word, BLANK, "_"), F.when(F.coalesce(kind, F.lit("")) != "", kind).otherwise("?"))
    return F.when(word.rlike(r"^(?:[a-zA-Z]+://|www\.)[^ ]+\.[^ ]+"), "%%URL|X").otherwise(plain)


def singular(w: Column) -> Column:
    """Minimal English stemming: -ies to -y, otherwise -s goes; -us, -ss and other vowels before -es stay."""
    return F.when(w.rlike("[^ae]ies$"), F.regexp_replace(w, "ies$", "y")).when(w.rlike("[us]s$|[aeio]es$"), w).when(w.rlike("..s$"), F.regexp_replace(w, "s$", "")).otherwise(w)


SENTENCE = re.compile(r"[.!?](?=\s+[\"'(\[]?[A-Z0-9])")


def sentences(text: str) -> list[tuple[int, int]]:
    """Spans of the sentences of a text, without the blanks between them."""
    out, start = [], 0
    for end in [m.end() for m in SENTENCE.finditer(text)] + [len(text)]:
        piece = text[start:end]
        if piece.strip():
            lead = len(piece) - len(piece.lstrip())
            out.append((start + lead, start + len(piece.rstrip())))
        start = end
    return out


#: What stands between white space.
RUN = re.compile(r"\S+")


def tokens(text: str) -> list[tuple[int, str]]:
    """(offset, token): names with inner hyphens, slashes, colons and brackets stay whole; edge punctuation is parted."""
    return [(m.start() + at, word) for m in RUN.finditer(text) for at, word in parted(m[0])]


def parted(word: str) -> list[tuple[int, str]]:
    """The tokens of a run without white space, which depend on nothing else."""
    lead, trail, at = [], [], 0
    while word and (word[0] in "\"'`" or (word[0] in "([{" and not balanced(word))):
        lead.append((at, word[0]))
        word, at = word[1:], at + 1
    while word and (word[-1] in ",.;:!?\"'`" or (word[-1] in ")]}" and not balanced(word))) and len(word) > 1:
        trail.append((at + len(word) - 1, word[-1]))
        word = word[:-1]
    while len(word) > 2 and word[0] in "([{" and balanced(word) and closes_at(word) == len(word) - 1:
        lead.append((at, word[0]))
        trail.append((at + len(word) - 1, word[-1]))
        word, at = word[1:-1], at + 1
    return lead + ([(at, word)] if word else []) + trail[::-1]


PAIRS = {")": "(", "]": "[", "}": "{"}


def balanced(word: str) -> bool:
    return closes_at(word, None) is not None


def closes_at(word: str, first: int | None = 0) -> int | None:
    """Where the bracket at ``first`` closes; with None, -1 if all brackets of the word are paired, else None."""
    stack = []
    for i, c in enumerate(word):
        if c in "([{":
            stack.append((c, i))
        elif c in PAIRS:
            if not stack or stack[-1][0] != PAIRS[c]:
                return None
            opened = stack.pop()[1]
            if first is not None and opened == first:
                return i
    return -1 if first is None and not stack else None


def plain_analysis_schema(tag: str, concept: str) -> str:
    return f"struct<chunks:array<string>,recurring_chunks:array<string>,top_chunks:array<string>,abbreviations:array<struct<short:string,long:string>>,concepts:array<{concept}>,tagged_entities:array<{tag}>,tagged_entities_grouped:map<string,array<{tag}>>,tagged_text:string,embedding_text:struct<plain:string,pos_tag:string,ent_tag:string>>"
