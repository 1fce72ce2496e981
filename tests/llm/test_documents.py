"""Operators over documents against brute force, on the small tables and on fixtures with odd rows."""

import hashlib
import json
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tests.conftest import SMALL

from scriptorium.llm import common, exact_dedup, hmm, mixing, near_dedup, packing, substring_dedup, toxicity
from scriptorium.llm import queries as q

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, row long, digest string"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and blank texts, ties, repeated rows, a very long text, columns whose names the operators use too."""
    rng = random.Random(5)
    line = " ".join(f"w{i}" for i in range(60))
    long = " ".join(f"v{rng.randrange(3000)}" for _ in range(30_000))
    near = [f"x{i}" for i in range(100)]
    texts = [None, "", " \t\n", line, "intro " + line + " outro", line, long, "a b", "A  B", "a b c d", " ".join(near), " ".join(near[:60] + ["edit"] + near[61:]), "same words " * 40, "ünï cödé   nbsp", "one\x0btwo\x0cthree\rfour"]
    rows = [(i, t, "en", f"s{i % 3}" if i % 5 else None, 0, "k", 1, "d") for i, t in enumerate(texts)]
    rows += [(3, line, "en", "s0", 0, "k", 1, "d"), (3, line, "en", "s0", 0, "k", 1, "d"), (None, "no id at all", None, None, None, None, None, None), (None, line, None, "", None, None, None, None)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def removed(rows, k=35):
    seen, split = Counter(), [words(t) for _, t in rows]
    for w in split:
        seen.update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    for (doc, _), w in zip(rows, split):
        gone = set()
        for i in range(len(w) - k + 1):
            if seen[tuple(w[i : i + k])] > 1:
                gone.update(range(i, i + k))
        yield doc, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)


def pairs_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_substrings_like_brute_force(documents, odd, none):
    for docs in (documents, odd):
        got = Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in substring_dedup.remove_repeats(docs).collect())
        assert got == Counter(removed(pairs_of(docs)))
    assert substring_dedup.remove_repeats(none).count() == 0


def test_substrings_of_repetitive_words(spark):
    texts = ["a " * 50, "a b " * 30, "a b a c " * 20, " ".join("abc"[i % 3] for i in range(35)), " ".join(map(str, range(35))), " ".join(map(str, range(34)))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for m in (2, 8, 35):
        got = Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in substring_dedup.remove_repeats(docs, m=m).collect())
        assert got == Counter(removed(list(enumerate(texts))))


def test_substrings_of_heavy_minimisers_and_long_texts(spark, monkeypatch):
    """One run of eight words in 300 contexts, a third of them twice; windows counted one by one, and in short stretches."""
    rng = random.Random(8)
    common_run = [f"c{i}" for i in range(8)]
    texts = [" ".join([f"a{rng.randrange(9)}.{i}" for i in range(40)] + common_run + [f"b{i % 200}.{j}" for j in range(40)]) for i in range(300)]
    texts += texts[:100] + [" ".join(texts[:30])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    want = Counter(removed(list(enumerate(texts))))
    monkeypatch.setattr(substring_dedup, "HEAVY", 2)
    for sampled, stretch in ((1, 1 << 24), (2, 50)):
        monkeypatch.setattr(substring_dedup, "SAMPLED", sampled)
        monkeypatch.setattr(substring_dedup, "STRETCH", stretch)
        assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in substring_dedup.remove_repeats(docs).collect()) == want
    text = b"  one two\tthree\x0bfour  five "
    for long in (0, 1000):
        assert [substring_dedup.slicer(text, long)(a, b) for a, b in ((0, 1), (1, 4), (0, 9))] == [b"one", b"two three four", b"one two three four five"]


def test_windows_dealt_out_grow_with_the_different_strings(spark, monkeypatch):
    """A run of eight words in n contexts, each of them in three tasks: a row for each window of a context, twice as many for twice the contexts."""
    made = {}

    def noted(df, name):
        out = common.materialise(df, name)
        made[name] = out.count()
        return out

    monkeypatch.setattr(substring_dedup, "materialise", noted)
    monkeypatch.setattr(substring_dedup, "HEAVY", 2)
    monkeypatch.setattr(substring_dedup, "SAMPLED", 1)
    for n in (20, 40):
        texts = [" ".join([f"a{i}.{j}" for j in range(27)] + [f"c{j}" for j in range(8)] + [f"b{i}.{j}" for j in range(27)]).encode() for i in range(n)]
        strings = [(7, hashlib.blake2b(t, digest_size=16).digest(), t, 27, 28, 1) for t in texts]
        some = [spark.createDataFrame(strings, "mini long, digest binary, packed binary, pivot int, windows int, many long").coalesce(1) for _ in range(3)]
        got = substring_dedup.repeated_in(some[0].union(some[1]).union(some[2]), 35).collect()
        assert sorted((bytes(r["digest"]), r["firsts"]) for r in got) == sorted((s[1], list(range(28))) for s in strings)
        assert made["windows"] == 28 * n


def near_truth(rows, percent, n=5):
    sets, forest = [], common.Forest()
    for _, t in rows:
        w = words(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set())
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    both = Counter()
    for h in holders.values():
        for a in range(len(h)):
            for b in h[:a]:
                both[b, h[a]] += 1
    for (a, b), c in both.items():
        if 100 * c >= percent * (len(sets[a]) + len(sets[b]) - c):
            forest.join(a, b)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[forest.root(i)] = min(doc, least.get(forest.root(i), doc))
    return Counter((doc, len(sets[i]), least.get(forest.root(i), doc)) for i, (doc, _) in enumerate(rows))


def test_near_copies_like_brute_force(documents, odd, none):
    for docs in (documents, odd):
        for similarity in (0.85, 0.8):
            rows = near_dedup.group_near(docs, similarity).collect()
            assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows) == near_truth(pairs_of(docs), round(100 * similarity))
            assert all(r["kept"] == (r["doc_id"] is not None and r["doc_id"] == r["component_id"]) for r in rows)
    assert near_dedup.group_near(none).count() == 0


def test_near_copies_of_a_large_group_over_many_tiles(spark, monkeypatch):
    rng = random.Random(1)
    base = [f"b{i}" for i in range(150)]
    texts = []
    for i in range(160):
        w = list(base)
        for _ in range(rng.randrange(7)):
            w[rng.randrange(150)] = f"e{i}.{rng.random()}"
        texts.append(" ".join(w))
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(near_dedup, "TILE", 32)
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in near_dedup.group_near(docs, 0.85).collect())
    assert got == near_truth(rows, 85)


def test_keep_one(odd):
    kept = Counter(r["doc_id"] for r in near_dedup.keep_one(odd).collect())
    assert kept[3] == 3 and not {4, 5, 8} & set(kept) and kept[None] == 1


def test_exact_copies_like_brute_force(documents, odd, none):
    for docs in (documents, odd):
        rows = exact_dedup.classify(exact_dedup.digest_rows(docs)).collect()
        groups = defaultdict(list)
        for doc, text in pairs_of(docs):
            groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(doc)
        want = Counter()
        for text, ids in groups.items():
            keep = min((i for i in ids if i is not None), default=None)
            want.update((i, keep, len(ids), hashlib.sha256(text.encode()).hexdigest()) for i in ids)
        assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["digest"]) for r in rows) == want
        assert sum(r["kept"] for r in rows) == len(groups) == exact_dedup.deduplicate(docs).count()
        assert exact_dedup.deduplicate(docs).columns == docs.columns
    assert exact_dedup.classify(exact_dedup.digest_rows(none)).count() == 0


def test_perfect_hash():
    digests = np.frombuffer(b"".join(hashlib.sha256(b"%d" % i).digest() for i in range(5000)), np.uint8).reshape(-1, 32)
    table = exact_dedup.PerfectHash.build(digests)
    assert not table.spare and sorted(table.slots(digests)) == list(range(5000))


def test_history_index_is_looked_up(spark):
    rows = exact_dedup.digest_rows(spark.createDataFrame([(5, "a b"), (9, "c"), (2, "a  b"), (3, "d"), (4, "d")], "doc_id long, text string"))
    index = exact_dedup.build_index(rows.where("doc_id in (5, 9)"), 2)
    got = {(r["keep_id"], r["group_size"], r["in_history"]) for r in exact_dedup.look_up(index, rows.where("doc_id not in (5, 9)"), 2).collect()}
    assert got == {(2, 2, True), (9, 1, True), (3, 2, False)}


def shares(size, weights=(1, 2, 3), most=3.0):
    """Targets by resharing until none is above."""
    names = sorted(size, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    fixed, total = {}, sum(size.values())
    while True:
        left = total - sum(fixed.values())
        open_ = [s for s in names if s not in fixed]
        now = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = [s for s in open_ if now[s] > most * size[s]]
        if not above:
            return fixed | now
        fixed |= {s: most * size[s] for s in above}


def test_mixture(documents, odd, none):
    for docs in (documents, odd):
        rows = mixing.mix(docs).collect()
        again = Counter((r["doc_id"], r["source"], r["taken"]) for r in mixing.mix(docs.repartition(5)).collect())
        assert again == Counter((r["doc_id"], r["source"], r["taken"]) for r in rows)
        size, taken, biggest = Counter(), Counter(), Counter()
        for r in docs.select("source", "text").collect():
            size[r["source"]] += len(words(r["text"]))
        for r in rows:
            taken[r["source"]] += r["taken"]
            biggest[r["source"]] = max(biggest[r["source"]], r["size"])
            assert r["taken"] <= 3 * r["size"] and r["source_size"] == size[r["source"]]
        want = shares(size)
        for r in rows:
            assert r["target"] == pytest.approx(want[r["source"]])
        for s in size:
            assert abs(taken[s] - want[s]) <= biggest[s]
        copies = mixing.mixture(docs)
        assert copies.columns == docs.columns
        assert sum(len(words(r["text"])) for r in copies.select("text").collect()) == sum(taken.values())
    assert mixing.mix(none).count() == 0 and mixing.mixture(none).count() == 0


def test_mixture_comes_near_its_targets(documents):
    rows = mixing.mix(documents).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max("size").alias("big")).collect()
    assert max(abs(r["taken"] - r["target"]) / r["target"] for r in rows) < 0.05  # of 50 documents a source, one is up to some percent


def test_flight_balances():
    size, p = np.arange(400, 0, -1), np.full(400, 0.3)
    draw = np.random.default_rng(0).random
    s = mixing.fly(size, p, draw)
    assert ((s == 0) | (s == 1)).sum() >= 398
    assert s.sum() == pytest.approx(120) and (s * size).sum() == pytest.approx(0.3 * size.sum())
    assert set(mixing.land(size, s, draw)) == {0.0, 1.0}


def test_chunks_of_the_flight(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK", 16)
    docs = spark.range(1500).selectExpr("id as doc_id", "repeat('w ', cast(1 + id % 40 as int)) as text", "cast(id % 2 as string) as source")
    rows = mixing.mix(docs).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
    assert all(abs(r["taken"] - r["target"]) <= 40 for r in rows)


BIG = 1 << 60


def test_large_ids_beside_nulls(spark):
    """Ids beyond what a double holds come back as they are from every operator, beside null ids too."""
    texts = ["a b c", "a  b c", "toxic fool here", "one two three four five six seven", None, "a b\tc"]
    rows = [(BIG + 2 * i + 1, texts[i % 6], "s") for i in range(40)] + [(None, "a b c", "s"), (None, None, "s"), (None, "alone", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    ids = Counter(r[0] for r in rows)
    of = lambda df: Counter(r["doc_id"] for r in df.select("doc_id").collect())
    assert of(mixing.mix(docs)) == ids
    assert of(packing.pack(docs)) == ids
    assert of(hmm.score_documents(docs)) == ids
    assert of(substring_dedup.remove_repeats(docs)) == ids
    assert of(toxicity.score_documents(docs, spark.createDataFrame([(BIG + 1, 0), (BIG + 5, 1)], "doc_id long, toxic int"))) == ids
    classes = defaultdict(list)
    for i, t, _ in rows:
        classes[re.sub(r"\s+", " ", t or "")].append(i)
    keep = {i: min(x for x in group if x is not None) for group in classes.values() for i in group if i is not None}
    assert {r["doc_id"]: r["keep_id"] for r in exact_dedup.classify(exact_dedup.digest_rows(docs)).collect() if r["doc_id"] is not None} == keep
    assert {r["doc_id"]: r["component_id"] for r in near_dedup.group_near(docs).collect() if r["doc_id"] is not None} == {i: (k if rows[(i - BIG) // 2][1] else i) for i, k in keep.items()}


def test_mixture_keeps_rows_apart_that_differ_in_other_columns(spark):
    rows = [(1, "w " * 10, "A", "x"), (1, "w " * 10, "B", "x"), (1, "w " * 10, "B", None), (2, "v " * 10, None, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, row string")
    taken = Counter((r["doc_id"], r["source"], r["copies"]) for r in mixing.mix(docs).collect())
    copies = Counter((r["doc_id"], r["source"]) for r in mixing.mixture(docs).collect())
    for i, s in {(r[0], r[2]) for r in rows}:
        assert copies[i, s] == sum(n * k for (a, b, n), k in taken.items() if (a, b) == (i, s))


def test_packing(documents, odd, none):
    from tokenizers import Tokenizer

    import public_tokenizers

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokenizer.encode_special_tokens = True
    for docs in (documents, odd):
        pieces = packing.pack(docs).collect()
        want = Counter()
        for doc, text in pairs_of(docs):
            ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
            for s in range(0, len(ids), 4096):
                part = np.array(ids[s : s + 4096], "<u4")
                want[doc, s, len(part), zlib.crc32(part.tobytes()), len(ids)] += 1
        assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in pieces) == want
        sequences = defaultdict(list)
        for r in pieces:
            sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        for parts in sequences.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= 4096
        full = sum(n for parts in sequences.values() for _, n in parts)
        assert full > 0.98 * 4096 * (len(sequences) - 1)
        used = {s: sum(n for _, n in parts) for s, parts in sequences.items()}
        powers = {2**k for k in range(13)}
        assert all(r["padded_length"] == (used[r["sequence_id"]] if used[r["sequence_id"]] in powers else 4096) for r in pieces)
        padding = {r["sequence_id"]: r["padded_length"] - used[r["sequence_id"]] for r in pieces}
        assert sum(padding.values()) < 4096 + 0.02 * full and all(p >= 0 for p in padding.values())
    assert packing.pack(none).count() == 0


def test_a_power_of_two_is_not_padded(spark):
    """An end id alone is one token, a power of two; three of them are padded."""
    for n, length in ((1, 1), (2, 2), (3, 4096), (4, 4)):
        docs = spark.createDataFrame([(i, None) for i in range(n)], "doc_id long, text string")
        assert {r["padded_length"] for r in packing.pack(docs).collect()} == {length}


def test_encoder_is_the_tokenizer():
    rng = random.Random(1)
    signs = [*"abcXYZ0189!.,<>'`~[]{}@# \n\t\r\x0b\x0c\x1c\x00", *"\u00e9\u00c9\u00d6\u00df\u00d7\u00f7\u00ff\u00c0\u00aa\u00ba\u00b5\u00bd\u00b2\u0301\u0338\u00a0\u0085\u3000\u2014\u2019\u0130\u03a3\u6f22\ud55c\u200d\u20e3\u212a\ufb01\u017f\U0001f600", "'s", "'LL", "<|endoftext|>"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(40))) for _ in range(3000)] + [None, ""]
    encoder = packing.Encoder("word_bpe_49k.json")
    want = [x.tolist() for x in encoder.ids([t or "" for t in texts])]
    assert [x.tolist() for x in encoder.encode(pa.array(texts))] == want
    assert [x.tolist() for x in encoder.encode(pa.array(texts).slice(100, 50))] == want[100:150]
    assert not list(encoder.encode(pa.array([], pa.string())))
    whole = np.frombuffer(" ".join(["word"] * 50).encode(), np.uint8)
    cuts = [u for some in packing.some_at_a_time(whole, [0, 120, 120, len(whole)], most=15) for u in some]
    assert [u[1] for u in cuts[1:]] == [u[2] for u in cuts[:-1]] and sum(u[0] for u in cuts) == 3 and max(u[2] - u[1] for u in cuts) < 20


def test_fill_is_the_best_subset():
    rng = random.Random(2)
    for _ in range(60):
        lengths = Counter(rng.randrange(1, 40) for _ in range(rng.randrange(1, 12)))
        room, sums = rng.randrange(1, 120), {0}
        for x, n in lengths.items():
            sums = {s + k * x for s in sums for k in range(n + 1)}
        taken = packing.fill(lengths, room)
        assert sum(x * n for x, n in taken) == max(s for s in sums if s <= room)
        assert all(n <= lengths[x] for x, n in taken)


def test_toxicity_on_held_out_documents(spark, documents):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    rows = {r["doc_id"]: r for r in toxicity.score_documents(documents, labels).collect()}
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    held = [(rows[d]["predicted"], t) for d, t in truth.items() if d in rows and rows[d]["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for d, r in rows.items())
    assert sum(p == t for p, t in held) / len(held) > 0.93
    kept = {r["doc_id"] for r in toxicity.reject(documents, labels).collect()}
    assert kept == {d for d, r in rows.items() if not r["predicted"]}


def test_toxicity_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r["score"] for r in toxicity.score_documents(odd, labels).collect()} == {0.0}
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(["calm", "plain", "words", "here"]) + str(rng.randrange(50)) for _ in range(30)) + (" you fool." if i % 3 == 0 else ".")) for i in range(300)]
    docs = spark.createDataFrame([*rows, (1000, None), (1001, ""), (None, "you fool"), (1000, "again")], "doc_id long, text string")
    labels = spark.createDataFrame([*((i, int(i % 3 == 0)) for i, _ in rows), (0, 0), (None, 1), (5, None), (1000, 0)], "doc_id long, toxic int")
    score = toxicity.score_documents(docs, labels).collect()
    assert len(score) == 304 and all(r["predicted"] == int(r["doc_id"] % 3 == 0) for r in score if r["doc_id"] is not None and r["doc_id"] < 300)
    assert [r["predicted"] for r in score if r["doc_id"] is None] == [1]
    assert toxicity.score_documents(none, labels).count() == 0


LEXICON = {"fool$": 3.0, "trash$": 5.0, "mor": 2.0, "moro": 2.5}


def clause_weights(text):
    """The grammar's rules by hand, clause by clause."""
    out, reported = [], False
    for clause in re.findall(r"[^.!?;|:]+[.!?;|:]?", text):
        words = re.findall(r"[^\s]+", clause.rstrip(".!?;|:"))
        score, denied, aimed, waiting, last = 0.0, False, False, [], 0.0
        for raw in words:
            w = raw.strip(",").lower()
            own = max((v for e, v in LEXICON.items() if (e.endswith("$") and e[:-1] == w) or (not e.endswith("$") and w.startswith(e) and len(e) >= 4)), default=None)
            threat = own is None and w in toxicity.THREATS
            if own is not None or threat:
                last = own if own is not None else last
                base = own if own is not None else 4.0
                if denied:
                    score += 0.1 * base
                elif reported:
                    score += 0.25 * base
                elif aimed:
                    score += 1.5 * base
                else:
                    score += 0 if threat else base
                    waiting.append(threat)
            elif w in toxicity.TARGETS:
                if not aimed:
                    score += (0.5 * last if False in waiting else 0) + (1.5 * 4.0 if True in waiting else 0)
                aimed = True
            elif w in toxicity.NEGATIONS:
                denied = True
            elif w in toxicity.REPORTS:
                reported = True
            if raw.endswith(","):
                denied = False
        if score and len(words) != 1:
            out.append(score)
        if not clause.endswith(":"):
            reported = False
    return out


def test_grammar_scores_clauses_like_brute_force():
    rng, reader = random.Random(5), toxicity.Reader(LEXICON)
    stock = ["fool", "trash", "moron", "kill", "you", "them", "not", "never", "said", "called", "house", "tree", "is", "a"]
    for _ in range(2000):
        text = " ".join(rng.choice(stock) + rng.choice(["", "", "", "", ",", ".", ":", "!"]) for _ in range(rng.randrange(14)))
        assert list(reader.clauses(text.split())) == pytest.approx(clause_weights(text)), text


def test_patterns_move_the_score(documents, spark):
    """The same words weigh by the pattern of their clause; a lone word is no clause."""
    lexicon, weights = toxicity.learn(documents, spark.read.parquet(f"{SMALL}/labels.parquet"))
    word = max((e for e in lexicon if e.endswith("$") and e[:-1].isascii()), key=lexicon.get)[:-1]
    reader = toxicity.Reader(lexicon)
    at = lambda text: 1 / (1 + np.exp(-(np.dot(reader.features(text), weights[:-1]) + weights[-1])))
    assert at(f"you are {word}.") > at(f"this was {word}.") > at(f"she said you are {word}.") > at(f"you are not {word}.") > at("")
    assert at(f"you are {word}.") > 0.5 and at("i will kill you.") > 0.5
    assert at(word) == at("") == at(None) < 0.5 and at(f"you are not {word}.") < 0.5 and at("i will never kill you.") < 0.5
    assert at("they did kill time.") > at("this did kill time.") == at("")


def test_clauses_go_on_over_slices(monkeypatch):
    text = "we think that you are a fool and more, of all. the fool said: you trash. " * 5
    whole = list(toxicity.Reader(LEXICON).clauses(text.split()))
    for n in (1, 2, 3, 7):
        monkeypatch.setattr(toxicity, "SLICE", n)
        monkeypatch.setattr(toxicity, "MEMORY", 3)
        reader = toxicity.Reader(LEXICON)
        assert list(reader.clauses(text.split())) == whole and len(reader.known) <= 3 + n


def test_language_model_base(documents, odd, none):
    for docs in (documents, odd):
        rows = hmm.score_documents(docs).collect()
        pairs = [(d, (t or "").encode().lower().split() + [b"\n"]) for d, t in pairs_of(docs)]
        held = lambda d: zlib.crc32(str("null" if d is None else d).encode()) % 7 == 2
        counts = Counter(w for d, ws in pairs if not held(d) for w in ws)
        n, v = sum(counts.values()), len(counts)
        want = Counter((d, held(d), len(ws), sum(counts[w] > 0 for w in ws), n, round(float(sum(np.log10((counts[w] + 1) / (n + v + 1)) for w in ws)), 5)) for d, ws in pairs)
        assert Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5)) for r in rows) == want
    assert hmm.score_documents(none).count() == 0


def test_language_model_beats_its_base(documents):
    rows = [r for r in hmm.score_documents(documents).collect() if r["held_out"]]
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_forward_is_exact():
    """Against the sum over all paths of states, and expected counts against finite differences of the likelihood."""
    rng = np.random.default_rng(0)
    model = hmm.Model.random([b"a", b"b", b"\n"], np.ones(3 + hmm.CLASSES))
    docs = [np.array([0, 1, 2]), np.array([2]), np.array([1, 0, 5, 0, 2])]
    logs, (pi, trans, emit) = model.forward(docs, counts=True)
    for x, got in zip(docs, logs):
        alpha = model.pi * model.emit[:, x[0]]
        for s in x[1:]:
            alpha = (alpha @ model.trans) * model.emit[:, s]
        assert got == pytest.approx(np.log10(alpha.sum()))
    assert pi.sum() == pytest.approx(3) and trans.sum() == pytest.approx(6) and emit.sum() == pytest.approx(9)
    j, s = 2, 0
    h, before = 1e-6, model.forward(docs)[0].sum()
    model.emit[j, s] *= 1 + h
    assert (model.forward(docs)[0].sum() - before) * np.log(10) / h == pytest.approx(emit[j, s], rel=1e-3)
    assert rng is not None


def test_very_long_documents_are_counted_in_pieces(monkeypatch):
    rng = np.random.default_rng(3)
    model = hmm.Model.random([b"a", b"b", b"\n"], rng.random(3 + hmm.CLASSES))
    docs = [rng.integers(0, 20, 300), rng.integers(0, 3, 101), np.array([2])]
    logs, counts = model.forward(docs, counts=True)
    monkeypatch.setattr(hmm, "LONG", 50)
    monkeypatch.setattr(hmm, "PIECE", 25)
    others, more = model.forward(docs, counts=True)
    assert others == pytest.approx(logs, rel=1e-5) and logs == pytest.approx(model.forward(docs)[0], rel=1e-5)
    for x, y in zip(counts, more):
        assert x == pytest.approx(y, rel=1e-3, abs=1e-4)


def test_words_of_a_long_text_come_in_blocks():
    for text in (None, b"", b"  ", b"a b", b"one two  three\x0bfour\n", b"x" * 50 + b" y"):
        for most in (1, 3, 1000):
            assert [w for block in common.word_blocks(text, most) for w in block] == (text or b"").split()


def test_baum_welch_raises_the_likelihood():
    rng = np.random.default_rng(1)
    docs = [np.concatenate([rng.integers(0, 20, 30) + 20 * (i % 2), [40]]) for i in range(60)]
    weights = np.bincount(np.concatenate(docs), minlength=41 + hmm.CLASSES).astype(float)
    model = hmm.Model.random([str(i).encode() for i in range(40)] + [b"\n"], weights)
    before = None
    for _ in range(6):
        logs, counts = model.forward(docs, counts=True)
        assert before is None or logs.sum() > before - 1
        before = logs.sum()
        model = model.improved(*counts, weights)


def test_training_covers_all_rows_until_the_likelihood_settles(spark):
    """Scores are those of Baum-Welch over all training rows in one process, among them a kind of text with few rows."""
    rng = random.Random(3)
    texts = [" ".join(f"{'abz'[2 if i % 300 == 7 else i % 2]}{rng.randrange(30)}" for _ in range(rng.randrange(1, 25))) for i in range(1500)]
    rows = hmm.score_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)).collect()
    split = [t.encode().split() + [hmm.END] for t in texts]
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i in range(len(texts))]
    counts = Counter(w for ws, h in zip(split, held) if not h for w in ws)
    head = sorted(counts, key=lambda w: (-counts[w], w))
    weights = np.array([counts[w] for w in head] + [0] * hmm.CLASSES, float)
    model, known = hmm.Model.random(head, weights), {w: i for i, w in enumerate(head)}
    docs = [np.array([known[w] for w in ws]) for ws, h in zip(split, held) if not h]
    for some in ([x for x in docs if zlib.crc32(x.astype("<u2").tobytes()) % 8 == 0], docs):
        before = None
        while True:
            logs, more = model.forward(some, counts=True)
            model = model.improved(*more, weights)
            if before is not None and logs.sum() - before < 1e-4 * abs(logs.sum()):
                break
            before = logs.sum()
    want = dict(zip([i for i, h in enumerate(held) if not h], model.forward(docs)[0]))
    assert {r["doc_id"]: r["score"] for r in rows if not r["held_out"]} == pytest.approx(want, rel=1e-4)


def test_a_rare_words_class_is_a_distribution(spark):
    """Over all words that training holds and one unseen of each class, the words' shares of their classes sum to 1."""
    docs = spark.createDataFrame([(i, f"w{i % 7} rare{i}") for i in range(40)], "doc_id long, text string")
    rows = hmm.score_documents(docs).collect()
    assert all(np.isfinite(r["score"]) and r["score"] < 0 for r in rows)


def test_every_query_is_registered():
    assert sorted(int(re.match(r"op(\d+)_", k)[1]) for k in q.QUERIES) == list(range(1, 11))
    assert set(q.ORACLES) <= set(q.QUERIES)
    json.dumps(q.ORACLES)
