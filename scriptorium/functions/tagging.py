"""Dictionary entity tagging: the dictionary, the automaton over texts, nested matches, groups, markup, post-filters."""

from __future__ import annotations

import html
import re
from collections import Counter, defaultdict
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, DataType, StructField, StructType

from scriptorium.functions.text import STOPWORDS
from scriptorium.steps import slices

#: The characters that part words.
SEPARATORS = ".,;:)]([{}/\\\"'?!<>+- "
TAG = "struct<match:string,start:int,end:int,category:string,reference_db:string,reference:string,original_value:string,label:string,sentence:int>"


def admit(surface, stopwords=STOPWORDS):
    """Longer than 2; below 5 bytes not a stop word as written, from 5 on not in lower case."""
    short = F.octet_length(surface) < 5
    return (F.length(surface) > 2) & F.when(short, ~surface.isin(*stopwords)).otherwise(~F.lower(surface).isin(*stopwords))


def build_dictionary(entries: DataFrame, ignore_case: bool = True, partial: bool = False) -> DataFrame:
    """entries (surface, label, category, reference_db, ids, idx) to admitted surfaces, with copies without dashes.

    The same surface of the same category and database comes once, the first entry (by idx) wins; and all of a surface share
    the label and element of the first. partial: words of more than five letters in a longer surface match too, under
    the category with -TOKEN at its end; the text around must then be like the surface (see ``Tagger``).
    """
    kept = entries.where(admit(F.col("surface"))).withColumn("element", F.col("surface"))
    fold = F.lower if ignore_case else (lambda c: c)
    key = fold(F.col("surface"))
    forms = kept.withColumn("surface", F.explode(F.array_distinct(F.array(key, F.replace(key, F.lit("-"), F.lit("")))))).where(F.length("surface") > 2)
    if partial:
        words = F.filter(F.split("element", r"[ \t\n\x0B\f\r]+"), lambda w: (F.length(w) > 5) & (w != F.col("element")) & ~F.lower(w).isin(*STOPWORDS))
        tokens = kept.withColumn("surface", F.explode(F.array_distinct(F.transform(words, fold)))).withColumn("category", F.concat("category", F.lit("-TOKEN")))
        forms = forms.unionByName(tokens)
    by = W.partitionBy("surface").orderBy("idx", "element", "category", "reference_db")
    forms = forms.withColumn("label", F.first("label").over(by)).withColumn("first_element", F.first("element").over(by))
    first = F.row_number().over(W.partitionBy("surface", "category", "reference_db").orderBy("idx", "element"))
    return forms.withColumn("rank", first).where("rank = 1").drop("rank", "element").withColumnRenamed("first_element", "element")


def token_sort_ratio(a: str, b: str) -> int:
    """How like two texts are, 0 to 100, whatever the order of their words, their case and their marks."""
    sort = lambda s: " ".join(sorted(re.sub(r"[\W_]+", " ", s.lower()).split()))
    return round(100 * SequenceMatcher(None, sort(a), sort(b)).ratio())


def token_sort_similarity(a, b):
    """The like of columns, JVM-side, by the edit distance of the sorted words: 100 for the same words."""
    sort = lambda c: F.array_join(F.array_sort(F.filter(F.split(F.lower(c), "[^a-z0-9]+"), lambda w: w != "")), " ")
    x, y = sort(a), sort(b)
    longest = F.greatest(F.length(x), F.length(y))
    return F.when(longest > 0, F.round(100 * (1 - F.levenshtein(x, y) / longest), 3)).otherwise(100.0)


class Tagger:
    """An automaton over the surfaces of a dictionary of bounded size, held by each worker."""

    def __init__(self, entries: list[tuple], ignore_case: bool = True, least: int = 90):
        """entries: (surface, label, category, reference_db, ids[, element]), in order of preference. least: an entry whose
        category ends in -TOKEN counts if what stands in the text from its word on is more like its element than that."""
        import ahocorasick

        by: dict[str, list] = defaultdict(list)
        for surface, label, category, db, ids, *element in entries:
            if all((category, db) != (c, d) for _, c, d, *_ in by[surface]):
                by[surface].append((label, category, db, (ids or [""])[0], element[0] if element else None))
        self.machine = ahocorasick.Automaton()
        for surface, found in by.items():
            self.machine.add_word(surface, (surface, found))
        if by:
            self.machine.make_automaton()
        self.empty, self.ignore_case, self.least = not by, ignore_case, least

    def like_element(self, text: str, start: int, end: int, element: str) -> bool:
        """Whether the text from a word on is like the element from that word on, as far as the element goes."""
        at = element.lower().find(text[start:end].lower())
        rest = len(element) - at - (end - start) if at >= 0 else 0
        return token_sort_ratio(element, text[max(0, start - max(at, 0)) : end + rest]) > self.least

    def hits(self, text: str):
        """(start, end, surface, entries) of every surface between separators; lower-casing keeps the length of the text."""
        if self.empty:
            return
        low = text if not self.ignore_case else text.lower() if text.isascii() else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
        for last, (surface, found) in self.machine.iter(low):
            start, end = last - len(surface) + 1, last + 1
            if (start == 0 or low[start - 1] in SEPARATORS) and (end == len(low) or low[end] in SEPARATORS):
                yield start, end, surface, found

    def tag(self, text: str | None) -> list[dict]:
        """One tag for each category and database, nested ones of the same removed, in order of start, longest first."""
        groups: dict[tuple, list[dict]] = defaultdict(list)
        for start, end, _, found in self.hits(text or ""):
            for label, category, db, reference, element in found:
                if category.endswith("-TOKEN"):
                    if not self.like_element(text, start, end, element or ""):
                        continue
                    category = category.removesuffix("-TOKEN")
                groups[category, db].append({"match": text[start:end], "start": start, "end": end, "category": category, "reference_db": db, "reference": reference, "original_value": text[start:end] if element is None else element, "label": label, "sentence": None})
        return sorted((t for g in groups.values() for t in without_nested(g)), key=order)


def order(tag: dict) -> tuple:
    return tag["start"], -tag["end"], tag["category"], tag["reference_db"]


def without_nested(tags: list[dict]) -> list[dict]:
    """Tags that no other tag of the list holds. Of equal spans, which hold each other, none stays; overlaps do.

    In order of start, longest first, a tag is held by an earlier one if any of them ends where it ends or later.
    """
    spans = Counter((t["start"], -t["end"]) for t in tags)
    furthest, free = -1, set()
    for span in sorted(spans):
        if -span[1] > furthest and spans[span] == 1:
            free.add(span)
        furthest = max(furthest, -span[1])
    return [t for t in tags if (t["start"], -t["end"]) in free]


def remove_nested(ranges):
    """The same over a column array<struct<start,end,...>>, JVM-side."""
    inside = lambda x, y: (y["start"] <= x["start"]) & (x["end"] <= y["end"])
    return F.filter(ranges, lambda x: F.size(F.filter(ranges, lambda y: inside(x, y))) == 1)


def tag_texts(docs: DataFrame, entries: list[tuple], key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per document with its tags. entries: a dictionary that fits a worker's memory; it travels once to each. Of texts
    and tags a worker holds a slice."""
    sent = docs.sparkSession.sparkContext.broadcast(entries)

    schema = StructType([*docs.select(key, text).schema.fields, StructField("tags", ArrayType(DataType.fromDDL(TAG)))])
    names, kind = schema.names, to_arrow_type(schema["tags"].dataType)

    def run(batches):
        tagger = Tagger(sent.value)
        for part in slices(batches):
            tags = pa.array([tagger.tag(t) for t in part.column(1).to_pylist()], kind)
            yield pa.RecordBatch.from_arrays([*part.columns, tags], names)

    return docs.select(key, text).mapInArrow(run, schema)


def tags_in_range(tags, start, end):
    return F.filter(tags, lambda t: (t["start"] >= start) & (t["end"] <= end))


def group_tags(tags):
    """Tags by 'category|reference_db'."""
    key = lambda t: F.concat_ws("|", t["category"], t["reference_db"])
    return F.map_from_entries(F.transform(F.array_sort(F.array_distinct(F.transform(tags, key))), lambda k: F.struct(k.alias("key"), F.filter(tags, lambda t: key(t) == k).alias("value"))))


def cooccurring(tags, first: str = "GENE", second: str = "DISEASE"):
    """Whether a sentence's tags hold both categories."""
    return F.exists(tags, lambda t: t["category"] == first) & F.exists(tags, lambda t: t["category"] == second)


def mark(text: str, tags: list[dict]) -> str:
    """The text with an element around each tag, outer before inner, inside one division."""
    opens, closes = defaultdict(list), Counter(t["end"] for t in tags)
    for t in sorted(tags, key=order):
        opens[t["start"]].append(t)
    out, before = [], 0
    for at in sorted(opens.keys() | closes.keys()):
        out += [text[before:at], "</mark-i>" * closes[at]]
        for t in opens[at]:
            reference = "|".join(t["reference"]) if isinstance(t["reference"], (list, tuple)) else t["reference"]
            out.append(f'<mark-i data-entity="{html.escape(t["category"])}" reference-db="{html.escape(t["reference_db"])}"  reference="{html.escape(reference or "")}">')
        before = at
    return f'<div  class="entities">{"".join(out)}{text[before:]}</div></br>'


def drop_known_acronyms(tags: list[dict], forms: dict[str, str], text: str) -> list[dict]:
    """Tags on a known short form go; a tagged long form comes back on every place of its short form."""
    short_of = {long.lower(): short for short, long in forms.items()}
    known = {s.lower() for s in forms}
    kept, extend = [], {}
    for t in tags:
        low = t["match"].lower()
        if low in known:
            continue
        kept.append(t)
        if low in short_of:
            extend[short_of[low]] = t
    if extend:
        tagger = Tagger([(s.lower(), t["label"], t["category"], t["reference_db"], [t["reference"]]) for s, t in extend.items()])
        kept += tagger.tag(text)
    return sorted(kept, key=order)


#: Categories whose short matches must agree in case.
CASE_SENSITIVE = ("TARGET", "GENE", "PROTEINCOMPLEX", "DRUGCHEMICAL")
#: Common English words of four to six letters, a small default.
COMMON = frozenset(
    "able across action active actual after again against almost along also among amount answer area around away back base basic become been before began behind being best better between beyond body book born both bring called came care case cause center change child city class clear close cold come common could course cost dark data date days death deep does done door down each early east easy effect eight else end enough even ever every eyes face fact fall family far fast felt field figure final fine fire first five floor follow food foot force form found four free friend from full gave general girl give given going gone good great green group grow growth half hand hard have head hear heard heart heat held help here high hold home hope hour house human idea into just keep kept kind knew know known lack land large last late later lead least leave left length less level life light like line list little live local long look lost love made main make many mark mass matter mean means member method might mind model moment month more most mother move much must name near need never next night none normal north note number object often once only open order other over page paper part party past path period person place plan plant play point poor power press public rate rather reach read ready real reason record red rest result rich right rise road role room rule same save school second seem seen sense series set seven shall shape share short should show side sign simple since single size small social some soon sort sound source space stage stand start state step still stop story street strong such summer sure system table take taken task term test than that their them then there these they thing think third this those though three time today told took toward town tree trial true turn twice type under unit until upon used using value very view voice wait walk wall want water week well went were west what when where which while white whole wide wife will window wish with within without woman word work world would write year young".split()
)


def agreeing_in_case(tags, common=COMMON):
    """The rule of ``agrees_in_case`` over a column of tags, JVM-side."""
    match = lambda t: t["match"]
    short = lambda t: (F.length(match(t)) < 4) | ((F.length(match(t)) < 7) & F.lower(match(t)).isin(*sorted(common)))
    same = lambda t: (t["label"] == match(t)) | (t["label"] == F.replace(match(t), F.lit("-"), F.lit(""))) | (t["label"] == F.replace(match(t), F.lit("-"), F.lit(" ")))
    return F.filter(tags, lambda t: ~(t["category"].isin(*CASE_SENSITIVE) & short(t)) | F.coalesce(same(t), F.lit(False)))


def agrees_in_case(tag: dict, common=frozenset(), noisy=frozenset(), extended=frozenset()) -> bool:
    """Short matches of sensitive categories stay only if the text, without dashes or with blanks for them, is the label.

    noisy: categories in which a common word is no tag, unless it is one of the short forms that were ``extended``.
    """
    m = tag["match"]
    if tag["category"] in noisy and tag["category"] not in CASE_SENSITIVE:
        return m.lower() not in common or m.lower() in extended
    if tag["category"] not in CASE_SENSITIVE or not (len(m) < 4 or (len(m) < 7 and m.lower() in common)):
        return True
    return tag["label"] in (m, m.replace("-", ""), m.replace("-", " "))
