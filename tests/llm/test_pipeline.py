"""The whole pipeline against its stages by brute force, chained, on the smallest tables and on odd ones."""

import os
import re
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
from tests.conftest import TINY
from tests.llm.test_documents import near_truth, shares, words

from scriptorium.llm import toxicity
from scriptorium.llm.common import shared_dir

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, row long, digest string"


def kept_by_brute_force(docs, labels):
    """The rows that the first three stages keep."""
    lexicon, weights = toxicity.learn(docs, labels)
    reader = toxicity.Reader(lexicon)
    rows = [r for r in docs.collect() if not lexicon or np.dot(reader.features(r["text"]), weights[:-1]) + weights[-1] < 0]
    groups = defaultdict(list)
    for r in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", r["text"] or "")].append(r)
    rows = [min(g, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0)) for g in groups.values()]
    component = {doc: c for doc, _, c in near_truth([(r["doc_id"], r["text"]) for r in rows], 80)}
    return [r for r in rows if r["doc_id"] is None or component[r["doc_id"]] == r["doc_id"]]


def check(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{x}.parquet") for x in ("documents", "labels"))
    kept = kept_by_brute_force(docs, labels)
    stages = {}
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, sf_dir)
        assert now.columns == docs.columns
        stages[name] = now.collect()
    got = [r for r in stages["near_dedup"] if r["doc_id"] is not None]
    assert Counter(map(tuple, got)) == Counter(tuple(r) for r in kept if r["doc_id"] is not None)
    # Mixing: whole copies of what is left, near each source's target.
    size, taken, biggest = Counter(), Counter(), Counter()
    for r in stages["near_dedup"]:
        size[r["source"]] += len(words(r["text"]))
        biggest[r["source"]] = max(biggest[r["source"]], len(words(r["text"])))
    copies = Counter(map(tuple, stages["mixing"]))
    left = Counter(map(tuple, stages["near_dedup"]))
    assert set(copies) <= set(left) and all(n <= 3 * left[r] for r, n in copies.items())
    for r in stages["mixing"]:
        taken[r["source"]] += len(words(r["text"]))
    want = shares(size) if sum(size.values()) else {}
    assert all(abs(taken[s] - want[s]) <= biggest[s] for s in want)
    # Packing: each copy once, cut into pieces that lie without gaps.
    from tokenizers import Tokenizer

    import public_tokenizers

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokenizer.encode_special_tokens = True
    pieces = Counter()
    for r in stages["mixing"]:
        ids = np.array(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [2], "<u4")
        pieces.update((r["doc_id"], s, len(ids[s : s + 4096]), zlib.crc32(ids[s : s + 4096].tobytes()), len(ids)) for s in range(0, len(ids), 4096))
    packed = corpus_pipeline.run(spark, sf_dir).collect()
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in packed) == pieces
    places = defaultdict(list)
    for r in packed:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096


def test_like_chained_brute_force(spark):
    check(spark, TINY)


def test_odd_tables(spark, tmp_path):
    line = " ".join(f"w{i}" for i in range(60))
    rows = [(1, line, "en", "a"), (1, line, "en", "a"), (1 << 60, line + " end", "en", None), ((1 << 60) + 1, "  ", "en", "b"), (7, None, "de", "b"), (8, "", None, ""), (None, "no id", "en", "a"), (None, line, "en", "a"), (9, "x " * 5000, "en", "b"), (10, "you fool.", "en", "b")]
    docs = spark.createDataFrame([(*r, 0, "k", 1, "d") for r in rows], SCHEMA)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 0, 0), (10, 0, 1), (None, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    check(spark, str(tmp_path))


def test_empty_tables_and_no_traces(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    top = f"{shared_dir(spark)}/scriptorium"
    before = set(os.listdir(top)) if os.path.isdir(top) else set()
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    assert {x.rsplit("-", 1)[0] for x in set(os.listdir(top)) - before} == {"stage-toxicity", "stage-exact_dedup", "stage-near_dedup", "stage-mixing", "pieces"}
