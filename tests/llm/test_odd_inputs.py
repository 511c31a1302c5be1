"""Small tables over many partitions, repeated ids, null ids, columns with the operators' own names; stages and queries."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import corpus_pipeline as cp
from strandloom.llm import bpe, common, jaccard, mixing, ogg, places, registry, toxicity, warc
from test_corpus import SF, brute_components, brute_targets

DOC = T.StructType().add("doc_id", "long").add("text", "string").add("lang", "string").add("source", "string").add("n_chars", "integer")


def written_docs(spark, rows, tmp_path, parts=3, schema=DOC):
    path = f"{tmp_path}/docs.parquet"
    spark.createDataFrame(rows, schema).repartition(parts).write.parquet(path)
    return spark.read.parquet(path)


def some_rows(n, seed=1):
    r = random.Random(seed)
    rows = [(i, " ".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=r.choice([1, 8, 30]))), "en", r.choice("xyz"), 1) for i in range(n)]
    return [(*x[:4], len(x[1])) for x in rows]


@pytest.mark.parametrize("n, parts", [(0, 1), (1, 1), (3, 2), (50, 7), (200, 211)])
def test_join_of_few_rows_in_many_partitions(spark, n, parts):
    rows = [x[:2] for x in some_rows(n)]
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        got = jaccard.join(spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(rows)


@pytest.mark.parametrize("from_files", [True, False])
def test_values_reach_their_rows(spark, tmp_path, monkeypatch, from_files):
    monkeypatch.setattr(places, "FILE_IDS", 7)
    rows = [*some_rows(60), (5, "again", "en", "x", 5), (None, "no id", "en", "x", 5), (None, None, None, None, None)]
    docs = written_docs(spark, rows, tmp_path, 5)
    if not from_files:
        docs = docs.repartition("doc_id")
    values = docs.select("doc_id").distinct().select(F.col("doc_id").alias("id"), (F.coalesce("doc_id", F.lit(500)) * 3).alias("value"))
    out = places.with_value(docs, values, name="v")
    both = out.where("v < 90").unionByName(out.where("v >= 90"))
    key = lambda r: tuple(str(x) for x in r)
    want = sorted([(*x, 1500 if x[0] is None else x[0] * 3) for x in rows], key=key)
    assert sorted(map(tuple, both.collect()), key=key) == want
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")  # other splits of the same files
    try:
        assert sorted(map(tuple, out.collect()), key=key) == want
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    with pytest.raises(Exception, match="an id has no value"):
        places.with_value(docs, values.where("id != 5 OR id IS NULL")).collect()


@pytest.mark.parametrize("shuffled", [False, True])
def test_near_duplicates_with_repeated_ids(spark, tmp_path, shuffled):
    text = "one two three four five six seven"
    rows = [(1, text, "en", "x", 1), (1, text, "en", "x", 1), (2, text.upper(), "en", "x", 1), (3, "zebra", "en", "x", 1), (3, "apple", "en", "y", 1), (3, "apple", "en", None, 1), (3, None, "en", "x", 1), (None, text, "en", "x", 1), (None, text, "en", "x", 1), (9, "alone", "de", "x", 1)]
    docs = written_docs(spark, rows, tmp_path)
    got = cp.drop_near_duplicates(spark, docs.repartition(4, "lang") if shuffled else docs, SF)
    key = lambda r: tuple(str(x) for x in r)
    want = [(None, text, "en", "x", 1)] * 2 + [(1, text, "en", "x", 1), (3, None, "en", "x", 1), (9, "alone", "de", "x", 1)]
    assert got.columns == docs.columns and sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)


STRANGE = T.StructType([*DOC.fields, *(T.StructField(n, T.StringType()) for n in ("_value", "_copy", "_toxicity", "_place", "_key", "component_id", "score", "_VALUE_"))])


@pytest.mark.parametrize("kind", ["empty", "one row", "clashing columns", "no n_chars", "long and repeated"])
def test_stages_of_odd_tables(spark, tmp_path, kind):
    rows = {"empty": [], "one row": [(1, "a b c", "en", "x", 5)]}.get(kind, some_rows(40) + [(100, None, None, None, None), (101, "", "en", "x", 0)])
    if kind == "long and repeated":
        long = " ".join(f"w{k % 4999}" for k in range(150_000))
        rows = [(i, long + f" {i}", "en", "x", 1) for i in range(4)] + [(9, "password=abcdefgh " + long[::-1], "en", "y", 1)] * 3 + [(None, "same words here now and then", "en", "y", 1)] * 2
    schema, docs = DOC, None
    if kind == "clashing columns":
        schema, rows = STRANGE, [(*r, *"abcdefgh") for r in rows]
    now = written_docs(spark, rows, tmp_path, schema=schema)
    if kind == "no n_chars":
        now = now.drop("n_chars")
    for k, (name, stage) in enumerate(cp.STAGES):
        out = stage(spark, now, SF)
        if k < 4:
            assert out.columns == now.columns
            if kind == "clashing columns":
                assert all(tuple(r)[5:] == tuple("abcdefgh") for r in out.collect())
            now = common.written(out, "odd")
            if name == "n-gram Jaccard join" and kind == "long and repeated":
                assert sorted(str(r.doc_id) for r in now.collect()) == ["0", "9", "None", "None"]
        else:
            assert {"doc_id", "n_tokens", "ids", "decoded_sha256"} <= set(out.columns)
            assert (out.count() == 0) == (now.count() == 0)


def test_mix_of_equal_rows(spark):
    rows = [(7, "a b c", "x")] * 300 + [(None, "a b", "x")] * 5 + [(k, "a", "y") for k in range(50)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert len(got) == 355
    taken = {s: sum(r.copies * r.size for r in got if r.source == s) for s in "xy"}
    target = {r.source: r.target for r in got}
    assert all(abs(taken[s] - target[s]) <= 3 for s in "xy")


def test_packet_times_are_those_of_their_stream(spark):
    media = ogg.mux(b"\x80" * 9216, b"12345678")
    df = spark.createDataFrame([(1, bytearray(media)), (2, None), (3, bytearray(b"junk"))], "id int, media binary")
    got = {(r.serial, r.packet): (r.start_s, r.end_s) for r in ogg.packets(df, "id", "media").collect()}
    assert got[1, 1] == (0.0, 0.576) and got[1, 2] == (0.576, 1.152) and got[2, 1] == (None, None) and got[1, 0] == (None, None)


def test_folder_must_be_shared_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "spark://there:7077"
        getConf = lambda self: {}
        getCheckpointDir = lambda self: None

    class Session:
        sparkContext = Context()

    with pytest.raises(ValueError, match="checkpoint"):
        common.shared_dir(Session())


def brute_records(pages):
    """id, payload -> (record type, refers to) of every row, with repeats."""
    last = {}
    for i, _, h in pages:
        last[h or ""] = max((x for x in (last.get(h or ""), i) if x is not None), default=None)
    return sorted(str((i, len((h or "").encode()), *(("response", None) if last[h or ""] == i else ("revisit", last[h or ""])))) for i, _, h in pages)


@pytest.mark.parametrize("from_files", [True, False])
def test_warc_with_thousands_of_equal_payloads(spark, tmp_path, from_files):
    r = random.Random(4)
    pages = [(k, f"http://h{k % 7}.org/{k}", r.choice(["error page", "error page", None, "", f"own {k}", f"pair {k // 2}", "é" * 3000])) for k in range(6000)]
    pages += [(7, "http://other.org", "seven"), (None, "u", "error page")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(6)
    if from_files:
        df.write.parquet(f"{tmp_path}/pages.parquet")
        df = spark.read.parquet(f"{tmp_path}/pages.parquet")
    folder = f"file://{tmp_path}/w"
    captures = warc.write_archives(df, folder)
    shards = warc.build_index(captures, folder, 3)
    got = warc.look_up(df.select(warc.url_key(F.col("url")).alias("key"), F.col("page_id").alias("id")), folder, shards, 3).collect()
    assert sorted(str((x.id, x.payload_bytes, x.record_type, x.refers_to)) for x in got) == brute_records(pages)


def test_warc_least(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", "xy"), (2, "b", "xy"), (3, "c", "xyz"), (4, "d", "xyz")], "page_id long, url string, html string")
    folder = f"file://{tmp_path}/w"
    shards = warc.build_index(warc.write_archives(df, folder, least=3), folder, 2)
    got = warc.look_up(df.select(warc.url_key(F.col("url")).alias("key"), F.col("page_id").alias("id")), folder, shards, 2).collect()
    assert {x.id: x.refers_to for x in got} == {1: None, 2: None, 3: 4, 4: None}


def by_the_book(examples, epochs, alpha, beta, l1, l2):
    """FTRL-proximal as published (McMahan and others 2013, algorithm 1), a coordinate at a time; the intercept isn't regularised."""
    z, n = {}, {}

    def weight(i):
        cut = 0.0 if i == toxicity.BIAS else l1
        if abs(z.get(i, 0.0)) <= cut:
            return 0.0
        return -(z[i] - math.copysign(cut, z[i])) / ((beta + math.sqrt(n[i])) / alpha + l2)

    for _ in range(epochs):
        for at, y in examples:
            w = {i: weight(i) for i in [toxicity.BIAS, *at]}
            g = 1 / (1 + math.exp(-sum(w.values()))) - y
            for i in w:
                sigma = (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / alpha
                z[i] = z.get(i, 0.0) + g - sigma * w[i]
                n[i] = n.get(i, 0.0) + g * g
    return {i: weight(i) for i in z if weight(i)}


def test_ftrl_equals_brute_force():
    r = random.Random(8)
    examples = []
    for _ in range(300):
        y = int(r.random() < 0.3)
        at = sorted({r.randrange(1, 40) for _ in range(r.randrange(12))} | ({50 + r.randrange(3)} if y and r.random() < 0.9 else set()))
        examples.append((np.array(at, np.int32), y))
    at, w = toxicity.fit_examples(examples, 3)
    want = by_the_book([(a.tolist(), y) for a, y in examples], 3, toxicity.ALPHA, toxicity.BETA, toxicity.L1, toxicity.L2)
    assert set(at.tolist()) == set(want) and max(abs(want[i] - x) for i, x in zip(at.tolist(), w.tolist(), strict=True)) < 1e-9
    assert 0 < len(want) < 40
    score = toxicity.scorer((at, w))
    assert score("") == pytest.approx(1 / (1 + math.exp(-want.get(toxicity.BIAS, 0.0))))


def words(t):
    return [w for w in re.split(r"[ \t-\r]+", t or "") if w]


def test_queries_of_whole_tables(spark, tmp_path):
    """The registered queries over a small folder of tables, against plain Python."""
    rows = [(*x[:4], x[4]) for x in some_rows(80, 3)] + [(200, None, "en", None, None), (201, "", "en", "x", 0), (202, "pass" + "word=abcdefgh1", "en", "x", 1), (203, "é", "en", "y", 1)]
    spark.createDataFrame(rows, DOC).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(x[0], 1, x[0] % 2) for x in rows], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    pages = [(k, f"http://a{k}.org/x", ["same", None, f"p{k}"][k % 3]) for k in range(30)]
    spark.createDataFrame(pages, "page_id long, url string, html string").repartition(2).write.parquet(f"{tmp_path}/pages.parquet")
    run = {name: query(spark, str(tmp_path)).collect() for name, query in registry.queries().items() if name.split("_")[0] in ("op1", "op3", "op4", "op5", "op6", "op7", "op10")}
    texts = {x[0]: x[1] or "" for x in rows}
    assert all(sorted(r.doc_id for r in run[name]) == sorted(texts) for name in run if name != "op4_warc")

    for r in run["op1_ogg_media"]:
        data = texts[r.doc_id].encode()
        full = data + b"\xff" * (max(1, -(-len(data) // 576)) * 576 - len(data))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(data), len(full), hashlib.sha256(full).hexdigest(), zlib.crc32(full[-32:]))
        assert r.media_bytes > len(full) and len(r.media_sha256) == 64
    for r in run["op3_secrets"]:
        assert (r.n_assign, r.n_access, r.n_hex) == (int(r.doc_id == 202), 0, 0) and r.spans == ("assign:0:18" if r.doc_id == 202 else "")
        assert r.base_sha256 == hashlib.sha256(r.spans.encode()).hexdigest()
    want = brute_records(pages)
    assert sorted(str((r.page_id, r.payload_bytes, r.record_type, r.refers_to)) for r in run["op4_warc"]) == want
    assert {r.page_id: r.payload_digest for r in run["op4_warc"]} == {i: base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode() for i, _, h in pages}
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(bpe.vocabulary())
    for r in run["op5_bpe"]:
        ids = tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in run["op6_jaccard"]} == brute_components([x[:2] for x in rows])
    size = Counter()
    for x in rows:
        size[x[3]] += len(words(x[1]))
    source, target = {x[0]: x[3] for x in rows}, brute_targets(size)
    taken = Counter()
    for r in run["op7_mixing"]:
        assert (r.size, r.source_size) == (len(words(texts[r.doc_id])), size[source[r.doc_id]]) and abs(r.target - target[source[r.doc_id]]) < 1e-6
        assert r.taken <= 3 * r.size and (not r.size or r.taken % r.size == 0)
        taken[source[r.doc_id]] += r.taken
    assert all(abs(taken[s] - target[s]) <= 30 for s in size)
    for r in run["op10_toxicity"]:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
