"""The jobs as queries: each runs its job twice over the whole tables into a folder of its own, leaves the files there, and gives the output as it then stands."""

from __future__ import annotations

import os
import uuid

from jobs import expression_tables, kmer_catalogue
from strandloom.operators.lineage import shared_dir
from strandloom.plans.expr_queries import TMM
from strandloom.plans.views import with_views


def _folder(spark, tag: str) -> str:
    return os.path.join(shared_dir(spark), f"{tag}-{uuid.uuid4().hex}")


def job1(spark, sf_dir: str):
    """Solid 25-mers of every text, by source."""
    at = _folder(spark, "job1-kmer-catalogue")
    for _ in range(2):  # the pattern is of the table's own name: a stream's path may not be a single file
        kmer_catalogue.run(spark, f"{sf_dir}/documents[.]parquet", f"{at}/output", f"{at}/checkpoint")
    return kmer_catalogue.read_kmers(spark, f"{at}/output").select("sample", "kmer", "cnt")


def job2(spark, sf_dir: str):
    """Counts and FPKM of every part and sample."""
    at = _folder(spark, "job2-expression-tables")
    for _ in range(2):
        expression_tables.run(spark, f"{sf_dir}/lineitem.parquet", f"{sf_dir}/part.parquet", at)
    return expression_tables.read_expression(spark, at)


QUERIES = {"job1_kmer_catalogue": job1, "job2_expression_tables": job2}

SQL = {
    "job1_kmer_catalogue": """
WITH r AS (SELECT coalesce(nullif(source, ''), 'unknown') AS sample, translate(regexp_replace(text, '[^A-Za-z]', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTACACGTACGTACGTACGTACGTACGTAC') AS seq FROM documents),
p AS (SELECT sample, substr(seq, p0 + 1, 224) AS piece FROM (SELECT sample, seq, unnest(range(0, length(seq) - 24, 200)) AS p0 FROM r WHERE length(seq) >= 25) x),
w AS (SELECT sample, substr(piece, unnest(range(1, length(piece) - 23)), 25) AS kmer FROM p)
SELECT sample, kmer, count(*) AS cnt FROM w GROUP BY sample, kmer HAVING count(*) >= 2
""",
    "job2_expression_tables": with_views(
        f"WITH {TMM} SELECT sample, feature, cnt, round(cnt / (len / 1e3) / (sum(cnt) OVER (PARTITION BY sample) / 1e6), 6) AS fpkm, round(cnt / (len / 1e3) / (eff_size / 1e6), 6) AS tmm_fpkm FROM counts JOIN tmm USING (sample) JOIN lengths USING (feature)",
        "counts", "lengths",
    ),
}
