"""Queries over dense fixtures: five scaffolds whatever the tables, so that pairs grow as fragments times features."""

import duckdb
import pandas as pd
import pytest

from strandloom.plans import catalog
from strandloom.plans.views import VIEWS

SF = "/root/testdata/sf0.001"
NAMES = [
    "j13_overlap_join", "j14_point_join", "j15_split_at_points", "j21_to_transcript", "a15_fractional_counts", "a16_refine_mappings", "a09_split_support", "a21_em_fixed_rounds",
]


@pytest.mark.parametrize("name", NAMES)
def test_whole_job(spark, name):
    sql = catalog.oracle_sql()[name]
    assert all(f" AS ({VIEWS[v]})" in sql for v in ("dense_frags", "dense_features"))
    con = duckdb.connect()
    for t in ("events", "part"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    theirs = con.sql(sql).df()
    ours = catalog.queries()[name](spark, SF).toPandas()[list(theirs.columns)]
    order = list(theirs.columns)
    pd.testing.assert_frame_equal(ours.sort_values(order, ignore_index=True), theirs.sort_values(order, ignore_index=True), check_dtype=False, rtol=1e-7)


def test_every_pair_of_a_scaffold(spark):
    f, g = (pd.read_parquet(f"{SF}/{t}.parquet") for t in ("events", "part"))
    f = pd.DataFrame({"scaff": f.user_id % 5, "lend": f.event_id * 37 % 20000 + 1, "rend": f.event_id * 37 % 20000 + 100 + f.value.floordiv(1).astype("int64") % 300})
    g = pd.DataFrame({"scaff": g.p_partkey % 5, "l": g.p_partkey * 173 % 20000 + 1, "r": g.p_partkey * 173 % 20000 + 50 + g.p_size * 20})
    pairs = f.merge(g, on="scaff")
    assert catalog.queries()["j13_overlap_join"](spark, SF).count() == ((pairs.lend <= pairs.r) & (pairs.rend >= pairs.l)).sum() > 0
