"""The whole run: records in, newest versions, analysis, enriched records and their four splits out."""

from __future__ import annotations

import argparse
import logging

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from scriptorium.functions import tagging
from scriptorium.functions.analyzers import Analyzer, Document, DocumentAnalyzer, NounChunker
from scriptorium.functions.text import normalise, text_to_analyze, to_ascii
from scriptorium.operators import relational
from scriptorium.sources import records
from scriptorium.steps import spread

log = logging.getLogger(__name__)

NLP, NOUN_PHRASES = DocumentAnalyzer.schema, NounChunker.schema
#: Enriched records, as they are written and read again.
ENRICHED = f"{records.PUBLICATION}, text_mined_entities struct<nlp:{NLP},noun_phrases:{NOUN_PHRASES}>"


def enrich(publications: DataFrame, dictionary: list[tuple] = (), common=tagging.COMMON, backend=None, analyzers: list[Analyzer] | None = None, noisy=frozenset()) -> DataFrame:
    """text_mined_entities for each publication: an entry for each analyzer, by its name. One without a text keeps empty ones,
    and so does an analyzer that fails on a text.

    The analysis is a column beside those of the publication: nothing is joined, and rows without an id or with the id of
    another keep their own. dictionary: entries that fit a worker's memory, see ``load_dictionary``. common, noisy: see
    ``DocumentAnalyzer``. backend: the parser, by default a rule parser. analyzers: by default those two of this package.
    """
    sent = publications.sparkSession.sparkContext.broadcast((list(dictionary), frozenset(common), frozenset(noisy)))
    names = [a.name for a in analyzers] if analyzers is not None else [DocumentAnalyzer.name, NounChunker.name]
    shapes = [a.schema for a in analyzers] if analyzers is not None else [NLP, NOUN_PHRASES]
    kinds = StructType.fromDDL(", ".join(f"a{i} {shape}" for i, shape in enumerate(shapes)))
    schema = StructType([*publications.schema.fields, *kinds.fields])

    def run(batches):
        entries, words, noise = sent.value
        mine = analyzers if analyzers is not None else [DocumentAnalyzer(tagging.Tagger(entries), words, noise), NounChunker()]
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                mined = [digests(t and to_ascii(t), mine, backend) for t in part.column(part.num_columns - 1).to_pylist()]
                found = [pa.array([m[i] for m in mined], to_arrow_type(f.dataType)) for i, f in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *found], [*part.schema.names[:-1], *kinds.names])

    text = spread(publications, 4).withColumn("a0", normalise(text_to_analyze(F.col("title"), F.col("abstract"))))
    mined = text.mapInArrow(run, schema)
    return mined.withColumn("text_mined_entities", F.struct(*[F.col(k).alias(name) for k, name in zip(kinds.names, names, strict=True)])).drop(*kinds.names)


def digests(text: str | None, analyzers: list[Analyzer], backend=None) -> list[dict | None]:
    """What each analyzer finds; one that fails on a text is logged and finds nothing."""
    if not text or not text.strip():
        return [None] * len(analyzers)
    document, out = Document(text, backend), []
    for a in analyzers:
        try:
            out.append(a.digest(document))
        except Exception:
            log.exception("%s failed", a.name)
            out.append(None)
    return out


def load_dictionary(spark: SparkSession, *paths: str, most: int = 5_000_000, most_bytes: int = 1 << 30, partial: bool = False) -> list[tuple]:
    """The admitted entries of dictionary files. Every worker holds them all, so more than ``most``, or than ``most_bytes`` of text, are refused."""
    entries = tagging.build_dictionary(records.read_dictionary(spark, *paths), partial=partial)
    n, size = entries.agg(F.count("*"), F.coalesce(F.sum(F.length("surface") + F.length("element") + F.coalesce(F.length("label"), F.lit(0)) + F.length(F.array_join("ids", ""))), F.lit(0))).first()
    if n > most or size > most_bytes:
        raise ValueError(f"{n} dictionary entries of {size} letters; workers are sent at most {most} of {most_bytes}")
    rows = entries.select("surface", "label", "category", "reference_db", "ids", "element").orderBy("idx", "surface").collect()
    return [tuple(r) for r in rows]


def newest(*frames: DataFrame) -> DataFrame:
    return relational.latest_by(relational.union_all(*frames), "pub_id", "filename")


def run(spark: SparkSession, baseline=None, updates=None, enriched=None, output_enriched=None, output_splitted=None, dictionary=(), common=tagging.COMMON) -> DataFrame:
    if not (baseline or updates or enriched):
        raise ValueError("one of baseline, updates and enriched is needed")
    if enriched:
        done = records.read_enriched(spark, enriched, ENRICHED)
    else:
        done = enrich(newest(*[records.read_records(spark, p) for p in (baseline, updates) if p]), dictionary, common)
    if output_enriched:
        records.write_json(done, output_enriched)
        done = records.read_enriched(spark, output_enriched, ENRICHED)
    if output_splitted:
        for name, split in (("concepts", relational.concept_rows), ("bioentities", relational.bioentity_rows), ("taggedtext", relational.tagged_text_rows), ("small", relational.small_rows)):
            records.write_json(split(done), f"{output_splitted}_{name}")
    return done


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser()
    for name in ("input_baseline", "input_updates", "input_enriched", "output_enriched", "output_splitted"):
        parser.add_argument(f"--{name}")
    parser.add_argument("--dictionary", nargs="*", default=[], help="files CATEGORY-DB.json")
    parser.add_argument("--common_words", nargs="*", default=[], help="files of common words, one a line, in place of the small list")
    a = parser.parse_args(args)
    spark = SparkSession.builder.getOrCreate()
    entries = load_dictionary(spark, *a.dictionary) if a.dictionary else ()
    common = frozenset(r["value"].strip().lower() for r in spark.read.text(a.common_words).collect()) if a.common_words else tagging.COMMON
    run(spark, a.input_baseline, a.input_updates, a.input_enriched, a.output_enriched, a.output_splitted, entries, common)


if __name__ == "__main__":
    main()
