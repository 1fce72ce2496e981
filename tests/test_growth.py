"""What queries do at size: workers hold little, little is shuffled, and results stay those of the plain way."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F
from tests.conftest import SMALL

from scriptorium.functions import concepts, phrases, text
from scriptorium.plans import queries_more  # noqa: F401
from scriptorium.plans.queries import QUERIES
from scriptorium.sources import records
from scriptorium.steps import slices


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_slices_are_small():
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"t": ["x" * 1000] * 5000 + ["y" * 3_000_000, None]})
    parts = list(slices([batch]))
    assert sum(p.num_rows for p in parts) == 5002 and max(p.num_rows for p in parts) <= 256
    assert sorted(p.nbytes for p in parts)[-2] < 2 << 20
    assert list(slices([batch.slice(0, 0)])) == []


def test_concepts_leave_a_worker_in_parts(spark, monkeypatch):
    """The same rows, but no array of a text's concepts: a text has more than a part here."""
    monkeypatch.setattr(concepts, "CONCEPT_BYTES", 2000)
    df = QUERIES["svo_concepts"](spark, SMALL)
    assert "MapInArrow" in plan(df) and "Generate" not in plan(df) and "ArrowEvalPython" not in plan(df)
    texts = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = Counter((r["doc_id"], c["sentence"], c["subject"], c["verb"], c["object"], c["negated"], tuple(c["verb_path"])) for r in texts for c in concepts.document_concepts(r["text"]))
    got = Counter((r["doc_id"], r["sentence"], r["subject"], r["verb"], r["object"], r["negated"], tuple(r["verb_path"])) for r in df.collect())
    assert got == want


@pytest.mark.parametrize("name", ["entity_tags", "tag_group_counts", "case_agreeing_tags"])
def test_tags_in_slices(spark, name):
    df = QUERIES[name](spark, SMALL)
    assert "MapInPandas" not in plan(df) and "MapInArrow" in plan(df)
    assert df.count() > 0


def test_words_of_a_key_are_counted_in_one_task(spark):
    """Repeated keys, keys and texts that are null, plurals of plurals."""
    rows = [(1, "as a a ass x"), (2, "cats cat cat"), (1, "a as"), (None, "dogs"), (2, None), (None, "dog dogs"), (3, None), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    words = F.regexp_extract_all("text", F.lit("([a-z]+)"), 1)
    got = lambda change: Counter(map(tuple, phrases.counted(docs, words, change).collect()))
    assert got(None) == Counter([(1, "a", 3), (1, "as", 2), (1, "ass", 1), (1, "x", 1), (2, "cats", 1), (2, "cat", 2), (None, "dogs", 2), (None, "dog", 1)])
    assert got(phrases.with_plurals) == Counter([(1, "a", 5), (1, "x", 1), (2, "cat", 3), (None, "dog", 3)])
    assert got(lambda c: phrases.recurring(c, 1)) == Counter([(1, "a", 3), (2, "cat", 2), (None, "dogs", 2)])
    assert got(lambda c: phrases.with_forms(c, {"as": "x", "cat": "cats"})) == Counter([(1, "a", 3), (1, "x", 3), (1, "ass", 1), (2, "cats", 3), (None, "dogs", 2), (None, "dog", 1)])


def shuffles(spark, name) -> list[str]:
    return re.findall(r"Exchange (\w+)\(", plan(QUERIES[name](spark, SMALL)))


def test_plural_merge_shuffles_texts_once(spark):
    assert shuffles(spark, "plural_merge") == ["hashpartitioning"] and "Generate" not in plan(QUERIES["plural_merge"](spark, SMALL))


def test_top5_phrases_shuffle_texts_once(spark):
    assert shuffles(spark, "top5_phrases") == ["hashpartitioning"] and "Window" not in plan(QUERIES["top5_phrases"](spark, SMALL))


def test_recurring_phrases_shuffle_no_words(spark):
    assert shuffles(spark, "recurring_phrases") == ["hashpartitioning"] * 2 and "Generate" not in plan(QUERIES["recurring_phrases"](spark, SMALL))


def test_abbreviation_merge_shuffles_texts_once(spark):
    assert shuffles(spark, "abbreviation_merge") == ["hashpartitioning"] and "Join" not in plan(QUERIES["abbreviation_merge"](spark, SMALL))


@pytest.mark.parametrize("name", ["whitespace_analyzer", "analyzer_tokens", "phrase_counts"])
def test_tokens_are_not_shuffled(spark, name):
    assert shuffles(spark, name) == ["hashpartitioning"] and "Generate" not in plan(QUERIES[name](spark, SMALL))


def test_articles_are_written_to_several_files(spark, monkeypatch):
    """A packed file is read by one task: a small table of one row group must not become one file."""
    seen, read = [], records.read_records
    monkeypatch.setattr(records, "read_records", lambda s, path: seen.append(path) or read(s, path))
    assert QUERIES["xml_articles"](spark, SMALL).count() > 0
    assert spark.read.text(seen[0]).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_runs_are_parted_once(monkeypatch):
    """What stands between white space is parted and guessed once, not at each of its places; the rules are those of tokens and pos."""
    seen = Counter()
    monkeypatch.setattr(phrases, "parted", lambda run: seen.update([run]) or text.parted(run))
    said = "Chronic (qzx) wheezes, qzx-like; of qzx. Chronic (qzx) wheezes, qzx-like; of qzx. " * 20
    got = phrases.noun_phrases(said)
    assert seen and max(seen.values()) == 1
    plain = [[(w, phrases.pos(w, i == 0)) for i, (_, w) in enumerate(text.tokens(said[a:b]))] for a, b in text.sentences(said)]
    assert got == phrases.phrases_of(plain) and [phrases.guess_sentence(said[a:b]) for a, b in text.sentences(said)] == plain


def test_parser_parts_runs_once(monkeypatch):
    seen = Counter()
    monkeypatch.setattr(concepts, "parted", lambda run: seen.update([run]) or text.parted(run))
    said = "Qzy (zzq) reduces the zzq-load, not zzq. "
    trees = [concepts.parse(said) for _ in range(20)]
    assert seen and max(seen.values()) == 1
    want = [(at, w, *concepts.guessed(w, i == 0), at + len(w) < len(said) and said[at + len(w)].isspace()) for i, (at, w) in enumerate(text.tokens(said))]
    assert all([(t.idx, t.text, t.lemma, t.pos, t.tag, t.space) for t in tree.tokens] == want for tree in trees)
