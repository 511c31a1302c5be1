"""Benchmark decontamination and the filter interaction audit against plain Python."""

import hashlib
import random
import re
from collections import Counter
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from strandloom.llm import audit, common, leaks
from test_corpus import SF

WORD = re.compile(leaks.WORD)


def lowered(text):
    return (text or "").translate(str.maketrans(leaks.UPPER, leaks.LOWER))


def brute_leaks(docs, items, window=10):
    patterns = {}
    for item, text in items:
        w = WORD.findall(lowered(text))
        for i in range(max(1, len(w) - window + 1) if w else 0):
            patterns.setdefault(tuple(w[i : i + window]), set()).add(item)
    lengths = {len(p) for p in patterns}
    out = []
    for doc, text in docs:
        found = list(WORD.finditer(lowered(text)))
        w = [m.group() for m in found]
        hit, of = set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                items_here = patterns.get(tuple(w[i : i + n]))
                if items_here is not None:
                    hit.update(range(i, i + n))
                    of |= items_here
        spans = []
        for i in sorted(hit):
            if i - 1 in hit:
                spans[-1] = (spans[-1][0], found[i].end())
            else:
                spans.append((found[i].start(), found[i].end()))
        out.append((doc, len(w), len(hit), tuple(sorted(str(x) for x in of if x is not None)), tuple(spans)))
    return sorted(out, key=str)


def scanned(docs, automata):
    return sorted(((r.doc_id, r.found.n_words, r.found.n_hit, tuple(r.found["items"]), tuple((s.start, s.end) for s in r.found.spans)) for r in leaks.scan(docs, automata).collect()), key=str)


@pytest.mark.parametrize("shard", [80_000, 7])
def test_leaks_equal_brute_force(spark, shard):
    r = random.Random(3)
    word = lambda: r.choice(["a", "B", "é", "É", "c1", "日本", "x" * 40])
    prose = lambda n: "".join(word() + r.choice([" ", "\n", ", ", "--", "\x00", "\x7f", " ¿ "]) for _ in range(n))
    items = [(k, prose(r.choice([1, 3, 9, 10, 11, 30]))) for k in range(12)]
    items += [(3, "again, another row of item three, a B c1"), (None, prose(12)), (50, None), (51, "..!"), (52, ""), (53, items[5][1]), (10, items[5][1])]
    docs = [(k, prose(r.choice([0, 2, 15, 60]))) for k in range(60)]
    docs += [(100 + k, prose(20) + t.upper() + prose(5)) for k, (_, t) in enumerate(items) if t] + [(1, "a repeated id"), (None, items[8][1]), (200, None), (201, ""), (202, prose(5000) + items[9][1])]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(7).withColumn("item", F.lit("x")).withColumn("a.b", F.lit(1)).withColumn("words", F.lit(2))
    automata = leaks.build(leaks.patterns(spark.createDataFrame(items, "item_id long, text string")), shard)
    assert len(automata) > 1 if shard == 7 else len(automata) == 1
    got = scanned(frame, automata)
    assert got == brute_leaks(docs, items)
    assert leaks.scan(frame, automata).columns == [*frame.columns, "found"]


def test_leaks_of_empty_tables_and_cleaned_texts(spark):
    docs = spark.createDataFrame([(1, "Ünder one two THREE four five, end"), (2, None), (3, "nothing here")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    automata = leaks.build(leaks.patterns(none))
    assert automata == [] and [x[1:4] for x in scanned(docs, automata)] == [(7, 0, ()), (0, 0, ()), (2, 0, ())]
    items = spark.createDataFrame([("q", "Two three four?", None), ("q", None, "FIVE"), ("z", "three", "ünder")], "id string, question string, answer string")
    automata = leaks.build(leaks.patterns(items, "id", ("question", "answer")))
    rows = leaks.scan(docs, automata).withColumn("rest", leaks.cleaned()).orderBy("doc_id").collect()
    assert [r.rest for r in rows] == ["Ünder one , end", None, "nothing here"]
    assert [(s.start, s.end) for s in rows[0].found.spans] == [(10, 29)] and list(rows[0].found["items"]) == ["q", "z"]
    assert leaks.scan(docs.limit(0), automata).count() == 0


def brute_audit(docs, labels):
    first, good, bad = {}, set(), set()
    for doc, text, _ in docs:
        if doc is not None:
            first[text or ""] = min(first.get(text or "", doc), doc)
    for doc, q, t in labels:
        if doc is not None:
            good |= {doc} if q == 1 else set()
            bad |= {doc} if t == 1 else set()
    rows = []
    for doc, text, source in docs:
        t = text or ""
        w = re.findall("[^\x20\x09-\x0d]+", t)
        fails = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t), "D": bool(set(t) & set("#$%&*|")), "E": doc is not None and doc > first[t]}
        rows.append((source or "", {x for x in fails if fails[x]}, doc in good, doc in bad))
    out, share = {}, Counter()
    for order in permutations("ABCDE"):
        for step, f in enumerate(order, 1):
            before = set(order[: step - 1])
            for part in {r[0] for r in rows}:
                here = [r for r in rows if r[0] == part]
                removed = [r for r in here if f in r[1] and not r[1] & before]
                share[part, f] += len(removed)
                out[part, "".join(order), step] = (
                    sum(not r[1] & (before | {f}) for r in here), len(removed), sum(f in r[1] for r in here) - len(removed), sum(r[1] == {f} for r in here), sum(r[2] for r in removed), sum(r[3] for r in removed),
                )
    return {k: (*v, share[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def audited(docs, labels):
    rows = audit.with_labels(audit.with_first(common.written(audit.text_facts(docs), "facts")), labels)
    marks = {"quality": "good_lost", "toxic": "toxic_lost"}
    bitmaps = audit.index(rows, F.col("part"), audit.filters(), {m: F.col(m) for m in marks})
    got = audit.steps(audit.subset_counts(bitmaps, list(audit.filters()), list(marks)), list(audit.filters()), marks).collect()
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in got}


@pytest.mark.parametrize("block", [1 << 20, 5])
def test_audit_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(audit, "BLOCK", block)
    r = random.Random(5)
    texts = [" ".join(r.choices(["a", "Bee", "é", "c#", "dd\x0b", "E\x1c", "x y"], weights=[5, 1, 2, r.choice([0, 1]), 1, 1, 1], k=r.choice([3, 49, 50, 51, 80]))) for _ in range(40)]
    texts += [" ".join(f"w{i}" for i in range(n)) for n in (50, 60, 70)] + ["A" * 5 + "a" * 95, "A" * 6 + "b" * 94, "", None, "long word " * 20_000]
    docs = [(k, r.choice(texts), r.choice(["s", "t", "", None, "ü"])) for k in range(400)]
    docs += [(k, texts[0], "hot") for k in range(1000, 1300)] + [(5, texts[1], "s"), (5, texts[1], "s"), (None, texts[0], "s"), (None, None, None)]
    labels = [(k, r.choice([0, 1, None]), r.choice([0, 1])) for k in range(0, 1100, 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(9).withColumn("part", F.lit("other")).withColumn("digest", F.lit(1)).withColumn("a.b", F.lit(1))
    got = audited(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert got == brute_audit(docs, labels)


def test_audit_of_empty_tables(spark):
    docs, labels = spark.createDataFrame([], "doc_id long, text string, source string"), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audited(docs, labels) == {}
    one = spark.createDataFrame([(1, None, None)], docs.schema)
    assert audited(one, labels)["", "ABCDE", 1] == (0, 1, 0, 1, 0, 0, 120)


def test_whole_tables_hold_what_brute_force_finds(spark):
    docs = [tuple(r) for r in common.table(spark, SF, "documents").select("doc_id", "text").collect()]
    items = [tuple(r) for r in common.table(spark, SF, "benchmark").select("item_id", "text").collect()]
    want = {d: (n, h, len(i), hashlib.sha256(",".join(i).encode()).hexdigest(), h > 0) for d, n, h, i, _ in brute_leaks(docs, items)}
    assert {r.doc_id: tuple(r)[1:] for r in leaks.op11(spark, SF).collect()} == want
    assert any(x[4] for x in want.values())
