"""Queries against their SQL on the smallest tables, a few of each kind; the driver runs them all."""

import duckdb
import pytest

import __spark_entry__ as entry
from strandloom.plans import catalog
from strandloom.plans.views import TABLES

SF = "/root/testdata/sf0.001"
CHOSEN = [
    "k02_kmer_count", "k03_canonical_kmer_count", "k08_kmer_histogram", "k18_set_sub", "k23_within_one_mismatch", "k29_path_exists", "f05_error_pruning", "f16_transcribed_strand", "j09_mate_pairing",
    "j13_overlap_join", "j15_split_at_points", "a12_depth_runs", "w08_sliding_jaccard", "w10_clip_contigs", "a15_fractional_counts", "a18_transcript_fpkm", "a21_em_fixed_rounds", "a04_assign_reads",
    "p01_de_bruijn", "p08_prune_once", "p12_bubbles", "p15_layers", "n05_six_frames", "n12_cigar_blocks", "a36_hexamer_scores", "p05_components",
]


def rows(frame):
    names = sorted(frame.columns)
    return sorted(tuple(None if v is None or v != v else float(v) if isinstance(v, float) else v for v in r) for r in frame[names].itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", CHOSEN)
def test_query_equals_its_sql(spark, duck, name):
    ours = catalog.queries()[name](spark, SF).toPandas()
    theirs = duck.sql(catalog.oracle_sql()[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert [tuple(map(str, r)) for r in rows(ours)] == [tuple(map(str, r)) for r in rows(theirs)]


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(catalog.oracle_sql()) <= set(catalog.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
