"""The jobs over copies of tables: growing input, repeated and broken runs, odd rows, their command lines."""

import glob
import json
import os
import random
import shutil
import subprocess
import sys
from collections import Counter

import duckdb
import pytest

from jobs import common, expression_tables, kmer_catalogue, queries
from strandloom.operators import packed

SF = "/root/testdata/sf0.001"
REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def brute_kmers(rows, k=25, least=2):
    seen = Counter()
    for text, source in rows:
        seq = "".join("ACGT"[(ord(c) | 32) - 97 & 3] for c in text or "" if c.isascii() and c.isalpha())
        seen.update((source or "unknown", seq[i : i + k]) for i in range(len(seq) - k + 1))
    return {x: n for x, n in seen.items() if n >= least}


def catalogue(spark, out):
    return {(r.sample, r.kmer): r.cnt for r in kmer_catalogue.read_kmers(spark, out).collect()}


def reads(seed, n):
    r = random.Random(seed)
    words = ["".join(r.choices("acgtABCXYZ", k=30)) for _ in range(12)]
    return [(" ".join(r.choices(words, k=r.choice([0, 1, 5]))), r.choice(["s1", "s2", "7", None, ""])) for _ in range(n)] + [(None, "s1"), ("short", "s9")]


def test_catalogue_grows_with_its_input(spark, tmp_path):
    drop, out, mark = f"{tmp_path}/drop", f"{tmp_path}/out", f"{tmp_path}/mark"
    add = lambda rows: spark.createDataFrame(rows, "text string, source string").coalesce(1).write.mode("append").parquet(drop)
    settings = common.config("kmer_catalogue.json", files_per_batch=1)
    first, second = reads(1, 80), [(t, "s2") for t, _ in reads(2, 40)]
    add(first)
    done = kmer_catalogue.run(spark, drop, out, mark, settings)
    assert (done["batches"], done["reads"]) == (1, len(first)) and catalogue(spark, out) == brute_kmers(first)
    before = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{out}/**/*.parquet", recursive=True)}
    assert kmer_catalogue.run(spark, drop, out, mark, settings)["reads"] == 0
    assert {f: t for f, t in before.items() if "sample=s9" not in f} == {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{out}/**/*.parquet", recursive=True) if "sample=s9" not in f}

    add(second)
    add(second[:7])
    done = kmer_catalogue.run(spark, drop, out, mark, settings)
    assert (done["batches"], done["reads"], done["samples"]) == (2, len(second) + 7, 1)
    want = brute_kmers(first + second + second[:7])
    assert catalogue(spark, out) == want
    kept = [f for f in before if "/kmers/" in f and "sample=s2" not in f]
    assert kept and all(os.stat(f).st_mtime_ns == before[f] for f in kept)

    for lost in ("kmers/sample=s1", "counts/sample=s2"):  # as if a run had ended while partitions were replaced
        shutil.rmtree(f"{out}/{lost}")
        kmer_catalogue.run(spark, drop, out, mark, settings)
        assert catalogue(spark, out) == want
    kmer_catalogue.add_batches(spark, out)  # as if one had ended between counts and k-mers
    add(second[:5])
    kmer_catalogue.count_new(spark, drop, out, mark, settings)
    kmer_catalogue.add_batches(spark, out)
    assert kmer_catalogue.run(spark, drop, out, mark, settings)["reads"] == 0
    assert catalogue(spark, out) == brute_kmers(first + second + second[:7] + second[:5])


def test_a_batch_that_failed_is_counted_once(spark, tmp_path, monkeypatch):
    drop, out, mark = f"{tmp_path}/drop", f"{tmp_path}/out", f"{tmp_path}/mark"
    rows = reads(3, 50)
    spark.createDataFrame(rows, "text string, source string").repartition(3).write.parquet(drop)

    class Log:
        def info(self, text, *args):
            if text.startswith("batch"):  # the counts are written by then
                raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(kmer_catalogue, "log", Log())
        with pytest.raises(Exception, match="lost"):
            kmer_catalogue.run(spark, drop, out, mark)
    assert glob.glob(f"{out}/deltas/batch=0/**/*.parquet", recursive=True)
    kmer_catalogue.run(spark, drop, out, mark)
    assert catalogue(spark, out) == brute_kmers(rows)


def test_catalogue_of_nothing(spark, tmp_path):
    spark.createDataFrame([], "text string, source string").write.parquet(f"{tmp_path}/drop")
    done = kmer_catalogue.run(spark, f"{tmp_path}/drop", f"{tmp_path}/out", f"{tmp_path}/mark")
    assert done["kmers"] == 0 and catalogue(spark, f"{tmp_path}/out") == {}


def test_tables_are_replaced_as_a_whole(spark, tmp_path):
    lines = [(f, "A", "F") for f in (1, 1, 2, 3, 4) * 5] + [(f, "N", "O") for f in (1, 2, 2, 3, 9) * 4] + [(None, "A", "F"), (1, None, "F")]
    spark.createDataFrame(lines, "l_partkey long, l_returnflag string, l_linestatus string").write.parquet(f"{tmp_path}/lines")
    spark.createDataFrame([(k, k) for k in range(1, 6)] + [(9, None)], "p_partkey long, p_size int").write.parquet(f"{tmp_path}/parts")
    found = []
    for _ in range(2):
        done = expression_tables.run(spark, f"{tmp_path}/lines", f"{tmp_path}/parts", f"{tmp_path}/out")
        found.append(sorted(map(tuple, expression_tables.read_expression(spark, f"{tmp_path}/out").collect())))
    assert found[0] == found[1] and done == {"fragments": 45, "counts": 8, "factors": 2, "expression": 7}
    rows = {r[:2]: r[2:] for r in found[0]}
    assert rows["AF", 1][:2] == (10, round(10 / 0.24 / (25 / 1e6), 6)) and ("NO", 9) not in rows
    spark.createDataFrame(lines[:25], "l_partkey long, l_returnflag string, l_linestatus string").write.mode("overwrite").parquet(f"{tmp_path}/lines")
    expression_tables.run(spark, f"{tmp_path}/lines", f"{tmp_path}/parts", f"{tmp_path}/out")
    assert {r.sample for r in expression_tables.read_expression(spark, f"{tmp_path}/out").collect()} == {"AF"}


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_job_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "lineitem", "part"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got, want = queries.QUERIES[name](spark, SF).toPandas(), con.sql(queries.SQL[name]).df()
    rows = lambda f: sorted(tuple(str(x) for x in r) for r in f[sorted(want.columns)].itertuples(index=False))
    assert len(want) and sorted(got.columns) == sorted(want.columns) and rows(got) == rows(want)


def test_command_line(tmp_path):
    settings = f"{tmp_path}/own.json"
    with open(settings, "w") as f:
        json.dump(common.config("kmer_catalogue.json", k=21), f)
    paths = ["--input", f"{SF}/documents[.]parquet", "--output", f"{tmp_path}/out", "--checkpoint", f"{tmp_path}/mark", "--config", settings, "--set", "min_count=3"]
    env = os.environ | {"PYTHONPATH": REPO, "PYSPARK_SUBMIT_ARGS": "--master local[2] --conf spark.ui.enabled=false --conf spark.sql.shuffle.partitions=4 pyspark-shell"}
    done = subprocess.run([sys.executable, "-m", "jobs.kmer_catalogue", *paths], cwd=REPO, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0 and "reads of" in done.stderr and "/kmers" in done.stderr
    assert duckdb.sql(f"SELECT min(cnt) >= 3 AND min(length(kmer)) = 21 FROM '{tmp_path}/out/kmers/*/*.parquet'").fetchall() == [(True,)]
    with pytest.raises(ValueError, match="no such setting"):
        common.config("kmer_catalogue.json", kk=1)


def test_long_sequences_are_counted_in_pieces(spark, monkeypatch):
    r = random.Random(4)
    rows = [("".join(r.choices("ACGTNé", weights=[9, 9, 9, 9, 1, 1], k=n)), n % 3) for n in (0, 3, 70, 500, 999, 2000, 12)] + [(None, 1)]
    df = spark.createDataFrame(rows, "seq string, w int").coalesce(1)
    plain = [sorted(map(tuple, packed.count(df, 7, canonical=c, weight="w", by=("w",), frames=3).collect())) for c in (False, True)]
    monkeypatch.setattr(packed, "PIECE", 100)
    assert plain == [sorted(map(tuple, packed.count(df, 7, canonical=c, weight="w", by=("w",), frames=3).collect())) for c in (False, True)]
