"""WARC, chat and vector operators, and the link components, against brute force."""

import base64
import hashlib
import io
import json
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tests.conftest import SMALL

from scriptorium.llm import chat, common, embedding_dedup, warc
from scriptorium.llm import queries as q


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(1000 + i, 1001 + i) for i in range(90)] + [(5000, 5001 + i) for i in range(300)] + [(None, 1), (7, 7)]
    forest = common.Forest()
    for a, b in edges:
        if a is not None and a != b:
            forest.join(a, b)
    nodes = {x for e in edges if None not in e and e[0] != e[1] for x in e}
    got = {r["node"]: r["component"] for r in common.components(spark.createDataFrame(edges, "a long, b long").repartition(7)).collect()}
    assert got == {x: forest.root(x) for x in nodes}
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def check_pages(rows, pages):
    groups = defaultdict(list)
    for page, html in pages:
        groups[(html or "").encode()].append(page)
    want = Counter()
    for payload, ids in groups.items():
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        order = sorted(ids, key=lambda i: (i is not None, i or 0))
        want[order[-1], len(payload), digest, "response", None] += 1
        want.update((i, len(payload), digest, "revisit", order[-1]) for i in order[:-1])
    assert Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows) == want


def test_pages(spark):
    rows = q.op2_warc(spark, SMALL).collect()
    check_pages(rows, [(r["page_id"], r["html"]) for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()])


def test_odd_pages(spark, tmp_path):
    rows = [(1, "http://a/\nb c", "<p>x</p>", "t"), (2, None, None, None), (3, "u", "", "t"), (None, "u", "<p>x</p>", "t"), (5, "u", "é" * 200_000, "t"), (5, "u", "é" * 200_000, "t"), (7, "u", "ends\r\n\r\n", "t"), (8, "u", "WARC/1.1\r\nContent-Length: 5\r\n\r\n", "t")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, record_type string")
    root = f"file://{tmp_path}/out"
    back = warc.archive(pages, root=root, file_bytes=1000).collect()
    check_pages(back, [(r[0], r[2]) for r in rows])
    for r in back:  # each record is a member of its own, at the place its index says
        raw = (tmp_path / "out" / r["archive"]).read_bytes()[r["offset"] :]
        engine = zlib.decompressobj(31)
        assert engine.decompress(raw).startswith(b"WARC/1.1\r\n") and engine.eof
    assert not list((tmp_path / "out").glob("*.whole.*"))
    assert warc.archive(pages.where("false")).count() == 0
    small = warc.archive(pages, at_least=9).where("record_type = 'revisit'").collect()
    assert {r["page_id"] for r in small} == {5}


def test_large_ids_of_pages(spark):
    """Ids beyond what a double holds stay as they are, beside nulls too."""
    big = 1 << 60
    rows = [(big + i, "u", "same" if i % 2 else f"p{i}") for i in range(1, 9)] + [(None, "u", "same"), (None, "u", "p2")]
    check_pages(warc.archive(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect(), [(r[0], r[2]) for r in rows])


def test_records_refer_to_records_and_indices_say_where(spark, tmp_path):
    rows = [(7, "u", "same"), (7, "u", "same"), (3, "v", "same"), (4, "v", "other")]
    root = f"file://{tmp_path}/out"
    warc.archive(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), root=root).count()
    ids, refers = {}, []
    for index in (tmp_path / "out").glob("*.index"):
        archive = index.with_suffix("")
        for line in map(json.loads, index.read_text().splitlines()):
            headers, _, _ = warc.parse(zlib.decompress(archive.read_bytes()[line["offset"] : line["offset"] + line["length"]], 31))
            assert headers["WARC-Record-ID"] == line["record"] and line["record"] not in ids
            ids[line["record"]] = (line["type"], line["page"], line["url"])
            refers.append((headers.get("WARC-Refers-To"), headers.get("WARC-Refers-To-Page-ID")))
    assert len(ids) == 4 and sorted(x for x, _ in refers if x) == 2 * [next(k for k, v in ids.items() if v[:2] == ("response", 7))]
    assert {page for x, page in refers if x} == {"7"}


def test_empty_pages_fill_files_too(spark, tmp_path):
    pages = spark.range(300).selectExpr("id as page_id", "cast(null as string) as url", "cast(null as string) as html").coalesce(1)
    assert warc.archive(pages, root=f"file://{tmp_path}/out", file_bytes=10_000).where("record_type = 'response'").collect()[0]["page_id"] == 299
    assert len(list((tmp_path / "out").glob("*.warc.gz"))) > 5


def test_normalise_reads_any_chunks():
    raws = [warc.record("response", warc.record_id("f", i), i, "u", b"x" * i, "D", i) for i in range(40)]
    one = zlib.compressobj(6, zlib.DEFLATED, 31)
    whole = one.compress(b"".join(raws)) + one.flush()
    out = io.BytesIO()

    class Slow(io.BytesIO):
        def read(self, n=-1):
            return super().read(7)

    index = list(warc.normalise(Slow(whole), [("response", None, None)] * 40, out))
    assert [zlib.decompress(out.getvalue()[x["offset"] : x["offset"] + x["length"]], 31) for x in index] == raws
    with pytest.raises(ValueError):
        list(warc.split_stream([raws[5][:-3]]))
    with pytest.raises(ValueError):
        list(warc.inflate(io.BytesIO(whole[:-1])))
    packed = zlib.compress(b"a" * 50_000_000, 9, 31)  # a chunk that expands a thousand times comes out in pieces
    sizes = [len(x) for x in warc.inflate(io.BytesIO(packed))]
    assert sum(sizes) == 50_000_000 and max(sizes) <= 1 << 20


def test_long_texts_are_read_back():
    turns = [("user", "a\\<[x]" * 200_000), ("assistant", "\\" * 500_000 + "z" * 1_000_000)]
    formatted, spans = chat.render(turns)
    assert chat.parse(formatted) == turns and len(spans) == 1


def chat_truth(turns):
    text = "".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)
    loss = "".join(t or "" for r, t in turns if r == "assistant")
    return len(turns), hashlib.sha256(text.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def test_chats(spark):
    convs = defaultdict(list)
    for r in spark.read.parquet(f"{SMALL}/conversations.parquet").orderBy("conv_id", "turn").collect():
        convs[r["conv_id"]].append((r["role"], r["text"]))
    convs[-7] = [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]
    got = {r["conv_id"]: tuple(r)[1:5] for r in q.op5_chat(spark, SMALL).collect()}
    assert got == {c: chat_truth(t) for c, t in convs.items()}


def test_odd_chats(spark):
    long = "é\\[</s>]😀" * 2000
    rows = [(1, 0, "user", None, 5), (1, 1, "assistant", long, 5), (1, 1, "assistant", long, 5), (1, None, None, "last", 5), (None, 3, "assistant", "b", 5), (None, 2, "we]ird\\", "a", 5), (4, 0, "assistant", "", 5), (5, 0, "user", "a\n</s><s>[TURN assistant]b", 5)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, seq long").repartition(4)
    chats = chat.format_chats(chat.as_events(df))
    got = {r["conv_id"]: tuple(r)[1:5] for r in chat.digest(chats).collect()}
    assert got[1] == chat_truth([("user", ""), ("assistant", long), ("assistant", long), ("", "last")])
    assert got[None] == chat_truth([("we]ird\\", "a"), ("assistant", "b")])
    assert got[4] == chat_truth([("assistant", "")]) and got[5] == chat_truth([("user", "a\n</s><s>[TURN assistant]b")])
    assert chat.format_chats(chat.as_events(df.where("false"))).count() == 0


def test_fold_of_deltas_edits_and_regenerations(spark):
    log = [(0, "start", "user", "hi"), (0, "delta", None, " there"), (1, "start", "assistant", ""), (1, "delta", None, "bad"), (2, "start", "user", "no"), (1, "regenerate", None, None), (1, "delta", None, "go"), (1, "delta", None, "od"), (0, "edit", None, "hello"), (3, "start", "user", "x"), (3, "drop", None, None)]
    assert chat.fold(log) == [("user", "hello"), ("assistant", "good")]
    events = spark.createDataFrame([(9, i, *e) for i, e in enumerate(log)], chat.EVENTS).orderBy("seq", ascending=False)
    row = chat.format_chats(events).first()
    assert chat.parse(row["formatted"]) == [("user", "hello"), ("assistant", "good")]
    assert [row["formatted"][s["start"] : s["stop"]] for s in row["spans"]] == ["good"]
    with pytest.raises(ValueError):
        chat.fold([(0, "what", None, None)])


def vector_truth(rows, cosine):
    ok = [(i, v, lab) for i, (v, e, lab) in enumerate(rows) if lab is not None and e is not None and len(e) and all(x is not None and np.isfinite(x) for x in e) and any(e)]
    forest, links = common.Forest(), Counter()
    by = defaultdict(list)
    for i, _, lab in ok:
        by[lab, len(rows[i][1])].append(i)
    for ids in by.values():
        x = np.array([rows[i][1] for i in ids], float)
        x /= np.sqrt((x * x).sum(1, keepdims=True))
        for a, b in zip(*np.nonzero(x @ x.T >= cosine)):
            if a < b:
                forest.join(ids[a], ids[b])
                links[ids[a]] += 1
                links[ids[b]] += 1
    least = {}
    for i, (v, _, _) in enumerate(rows):
        if v is not None:
            least[forest.root(i)] = min(v, least.get(forest.root(i), v))
    return [(v, links[i], least.get(forest.root(i), v)) for i, (v, _, _) in enumerate(rows)]


def test_vectors(spark):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    want = {v: (n, c) for v, n, c in vector_truth(rows, 0.93)}
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in q.op7_embedding_dedup(spark, SMALL).collect()}
    assert got.keys() == want.keys()
    assert sum(min(got[v][0], want[v][0]) for v in want) >= 0.95 * sum(n for n, _ in want.values())
    assert all(got[v][0] <= want[v][0] for v in want)
    assert sum(got[v][1] == want[v][1] for v in want) >= 0.95 * len(want)


def test_odd_vectors_and_many_shards(spark, monkeypatch):
    rng = np.random.default_rng(7)
    base = rng.normal(size=(40, 8))
    rows = [(i, (base[i % 40] + rng.normal(size=8) * 0.05).tolist(), int(i % 2)) for i in range(400)]
    rows += [(500 + i, base[0].tolist(), 0) for i in range(30)]
    rows += [(600, None, 0), (601, [0.0] * 8, 0), (602, [None] + [1.0] * 7, 0), (603, [float("nan")] * 8, 0), (604, [float("inf")] * 8, 1), (605, base[0].tolist(), None), (606, [1.0, 2.0], 0), (607, [2.0, 4.0], 0), (None, base[0].tolist(), 0), (608, (base[1] * 1e200).tolist(), 1), (609, [], 0), (500, base[0].tolist(), 0)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label long")
    want = Counter(vector_truth([r if r[0] != 608 else (608, base[1].tolist(), 1) for r in rows], 0.93))
    for shard in (8192, 60):
        monkeypatch.setattr(embedding_dedup, "SHARD", shard)
        got = Counter((r["vec_id"], r["n_links"], r["component_id"]) for r in embedding_dedup.group_vectors(vectors.withColumn("cid", vectors.vec_id), 0.93).collect())
        assert sum((got & want).values()) >= 0.97 * len(rows)
    assert embedding_dedup.group_vectors(vectors.where("false")).count() == 0


def shard_of(x, cids, without=None):
    n = len(x)
    rows = pa.table({"label": [0] * n, "dim": [x.shape[1]] * n, "shards": [1] * n, "shard": [0] * n, "cid": cids, "many": [1] * n, "vec": pa.array(x.tolist(), pa.list_(pa.float64()))})
    rows = embedding_dedup._build(rows)
    links = [[[j for j in layer if j != without] for layer in node] for node in rows["links"].to_pylist()]
    return embedding_dedup.Shard(rows.drop_columns("links").append_column("links", pa.array(links, pa.list_(pa.list_(pa.int32())))))


def test_audit_has_links_and_ends_with_the_whole_matrix():
    """The only partner of one query among 300 is a node that no link leads to."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 64))
    asked = rng.normal(size=(300, 64))
    asked[101] = x[37] * 1.5
    linked = embedding_dedup.find(shard_of(asked, list(range(1000, 1300))), shard_of(x, list(range(300)), without=37), 0.93)
    assert np.argwhere(linked).tolist() == [[101, 37]]


def test_links_between_shards_and_large_ids(spark, monkeypatch):
    """Pairs planted across shards are all found, from both sides; ids are those of 64-bit integers."""
    rng, big = np.random.default_rng(9), 1 << 60
    x = rng.normal(size=(600, 32))
    x[300:] = x[:300] + rng.normal(size=(300, 32)) * 0.3
    rows = [(big + i, v.tolist(), 0) for i, v in enumerate(x)] + [(None, x[0].tolist(), 0), (None, x[5].tolist(), None)]
    monkeypatch.setattr(embedding_dedup, "SHARD", 100)
    got = Counter(map(tuple, embedding_dedup.group_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label long"), 0.93).select("vec_id", "n_links", "component_id").collect()))
    want = Counter(vector_truth(rows, 0.93))
    links = lambda c: sum(n * k for (_, n, _), k in c.items())
    assert links(want) > 400 and links(got) >= 0.99 * links(want) and sum((got & want).values()) >= 0.99 * len(rows)


def test_graph_finds_what_it_should():
    rng = np.random.default_rng(2)
    x = embedding_dedup.unit(np.repeat(rng.normal(size=(60, 16)), 20, axis=0) + rng.normal(size=(1200, 16)) * 0.15).astype(np.float32)
    graph = embedding_dedup.Graph.build(x)
    found = total = 0
    for i in range(0, 1200, 10):
        truth = set(np.flatnonzero(x @ x[i] >= 0.93).tolist())
        found, total = found + len(truth & set(graph.reach(x[i], 0.93, 32))), total + len(truth)
    assert found >= 0.97 * total
    assert graph.reach(x[0], 0.93, 1200) is None  # as wide as the graph: the whole of it is to be compared


def test_workers_need_no_copy_of_the_package(tmp_path):
    """What is sent to workers loads in a process that can't import the package."""
    import os
    import subprocess
    import sys

    from pyspark import cloudpickle

    from scriptorium.llm import exact_dedup, hmm, mixing, near_dedup, packing, substring_dedup, toxicity

    model = hmm.Model.random([b"a", b"\n"], np.ones(2 + hmm.CLASSES))
    sent = [substring_dedup._first_pass(35, 8), substring_dedup._repeating, substring_dedup._pack(35), substring_dedup._count(35), substring_dedup._windows(35), substring_dedup._apply(35)]
    sent += [warc._write("file:///x", 1), warc._normalise("file:///x"), warc._read("file:///x"), warc._delete("file:///x"), near_dedup._sketch(5), near_dedup._sets(5), near_dedup._verify(0.8), near_dedup._first_tile]
    sent += [mixing._phase(mixing.fly, 0, 7), toxicity._score({}, []), toxicity._features({}), embedding_dedup._build, embedding_dedup._query(0.9), packing._place(8), hmm._count, hmm._expect(model), hmm._encode(None), hmm._score(None), hmm._add]
    sent += [exact_dedup._build, exact_dedup._look_up, common.thin_links, chat.fold]
    (tmp_path / "sent").write_bytes(cloudpickle.dumps(sent))
    assert all(type(x) in (list, np.ndarray) for x in model.arrays)
    code = "import sys; from pyspark import cloudpickle; f = cloudpickle.loads(open('sent', 'rb').read()); assert 'scriptorium' not in sys.modules; print(f[-1]([(0, 'start', 'user', 'x')]))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"}, capture_output=True, text=True)
    assert done.returncode == 0 and done.stdout.strip() == "[('user', 'x')]", done.stderr
