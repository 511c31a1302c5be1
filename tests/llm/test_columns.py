"""Columns of any names and types, repeated ids, very long urls and texts, hosts that most pages have."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import corpus_pipeline as cp
from strandloom.llm import bpe, common, leaks, licenses, search, secrets, toxicity, urls
from test_corpus import SF

NAMES = ["a.b", "a`b", "with space", "ids.x", "Ünder"]


def odd_docs(spark, tmp_path):
    r = random.Random(2)
    rows = [(i % 30, " ".join(r.choices("abcdefghijklmn", k=12)), "en", r.choice("xy"), 1, *"pqrst", [({"k": i},)]) for i in range(40)]
    schema = T.StructType().add("doc_id", "long").add("text", "string").add("lang", "string").add("source", "string").add("n_chars", "integer")
    for n in NAMES:
        schema = schema.add(n, "string")
    schema = schema.add("deep", T.ArrayType(T.StructType().add("m", T.MapType(T.StringType(), T.LongType()))))
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{tmp_path}/odd")
    return spark.read.parquet(f"{tmp_path}/odd")


def test_stages_keep_columns_of_any_names(spark, tmp_path):
    now = odd_docs(spark, tmp_path)
    for k, (_, stage) in enumerate(cp.STAGES):
        out = stage(spark, now, SF)
        if k < 4:
            assert out.columns == now.columns
            now = common.written(out, "odd")
            got = now.select(*[F.col(common.quoted(n)).alias(f"c{i}") for i, n in enumerate(NAMES)]).distinct().collect()
            assert [tuple(x) for x in got] == [tuple("pqrst")]
            assert k != 1 or sorted(x.doc_id for x in now.collect()) == list(range(30))  # one row an id
        else:
            assert set(NAMES) <= set(out.columns) and out.count() == now.count()


def test_operators_keep_columns_of_any_names(spark, tmp_path):
    docs = odd_docs(spark, tmp_path)
    assert secrets.redact(docs).collect() and bpe.encode(docs.withColumn("ids", F.lit(1)), bpe.VOCABULARY).columns.count("ids") == 1
    assert leaks.scan(docs, []).count() == 40 and toxicity.score(docs, toxicity.fit(docs, common.table(spark, SF, "labels"))).count() == 40
    assert licenses.scan(docs).count() == 0


def test_one_example_an_id(spark):
    texts = [(k, f"good words {k}") for k in range(40)] + [(k, f"bad worse {k}") for k in range(40, 60)]
    labels = spark.createDataFrame([(k, int(k >= 40)) for k in range(60)], "doc_id long, toxic int")
    plain = toxicity.fit(spark.createDataFrame(texts, "doc_id long, text string"), labels)
    many = texts + [(k, t) for k, t in texts if k == 41] * 500 + [(None, "no id")] * 5
    again = toxicity.fit(spark.createDataFrame(many, "doc_id long, text string").repartition(5), labels)
    assert all((a == b).all() for a, b in zip(plain, again, strict=True))
    drawn = toxicity.labelled(labels, most=7)
    assert drawn.count() == 7


def test_urls_of_frequent_hosts(spark):
    pages = [(k, f"http://hot.net/{'es' if k % 3 else 'xx'}/{k}") for k in range(3000)] + [(k, None if k % 2 else "no scheme") for k in range(3000, 3600)]
    pages += [(9000, "http://" + "a" * 200_000 + ".org/" + "p" * 200_000 + "?q"), (9001, "http://A.org#x"), (9001, "http://A.org#x"), (None, "http://b.org/x")]
    got = urls.judge(spark.createDataFrame(pages, "page_id long, url string").withColumn("host", F.lit("h")).repartition(4)).collect()
    assert len(got) == len(pages)
    seen = Counter((r.host, r.verdict, r.rule) for r in got)
    assert seen["hot.net", "block", "net/es/"] == 2000 and seen["hot.net", "block", None] == 1000 and sum(n for (h, _, _), n in seen.items() if h == "") == 600
    assert Counter(r.page_id for r in got)[9001] == 2
    long = next(r for r in got if r.page_id == 9000)
    assert len(long.host) == 200_004 and len(long.path) == 200_001
    assert urls.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_licences_in_a_text_of_many_sentences(spark):
    text = "Licensed under the MIT License. " * 3000 + "x " * 50_000
    got = licenses.scan(spark.createDataFrame([(1, text), (1, text), (2, None)], "doc_id long, text string")).collect()
    assert {(r.doc_id, r.license, r.dice) for r in got} == {(1, "MIT", 1.0)}


def test_search_of_repeated_ids_and_long_texts(spark):
    """Rows that repeat an id are documents of their own; texts are whole, as documents and as queries."""
    r = random.Random(6)
    long = " ".join(r.choices([f"v{k}" for k in range(50)], k=60_000)) + " rare"
    texts = [(0, "v1 v2 rare"), (0, "v1 v1 v3"), (5, "v2 other"), (5, "v2 other"), (20, long), (21, "rare"), (None, "rare"), (40, None), (41, "")]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(2)
    kept = [(i, (t or "").split()) for i, t in texts if i is not None]
    n, mean = len(kept), sum(len(t) for _, t in kept) / len(kept)
    df = Counter(w for _, t in kept for w in set(t))
    point = lambda w, t: round(math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * (t.count(w) * 2.2 / (t.count(w) + 1.2 * (0.25 + 0.75 * len(t) / mean))) * search.SCALE)
    points = [(i, {w: point(w, t) for w in set(t)}) for i, t in kept]
    want = []
    for q, t in kept:
        if q % 20 == 0:
            scores = ((sum(x * p.get(w, 0) for w, x in Counter(t).items()), i) for i, p in points)
            want += [(q, s, i) for s, i in scores if s > 0]
    got = [(x.query_id, round(x.score * search.SCALE), x.doc_id) for x in search.search(docs, docs.where("doc_id % 20 = 0"), k=50).collect()]
    assert Counter(got) == Counter(want)
