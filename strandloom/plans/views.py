"""Sequence-shaped inputs derived from the driver's tables, in SQL that Spark and DuckDB both read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

HEX = "'0123456789abcdef', 'ACGTACGTACGTACGT'"


def block(key: str) -> str:
    """32 bases that follow from a number."""
    return f"translate(md5(CAST({key} AS STRING)), {HEX})"


def gene_seq(key: str) -> str:
    """96 bases of a transcript; the four of a gene share most of theirs."""
    base = f"CAST(floor(({key}) / 4) * 10 + ({key}) % 4 AS BIGINT)"
    return f"({block(base)} || {block(base + ' + 1')} || {block(base + ' + 2')})"


def rc(seq: str) -> str:
    return f"reverse(translate({seq}, 'ACGT', 'TGCA'))"


#: Scaffolds are of one length, and there are more of them in larger tables: 500 fragments and 100 features each, 500 orders' reads over five. The dense ones are five
#: whatever the tables, so their pairs grow as fragments times features.
VIEWS = {
    "transcripts": f"SELECT p_partkey AS tid, CAST(floor(p_partkey / 4) AS BIGINT) AS gene, {gene_seq('p_partkey')} AS seq FROM part",
    "targets": f"SELECT s_suppkey AS tid, {gene_seq('s_suppkey')} AS seq FROM supplier",
    "reads": f"""SELECT read_id, tid, mate, db, CASE WHEN minus THEN {rc('s')} ELSE s END AS seq, q FROM (
        SELECT l_orderkey * 10 + l_linenumber AS read_id, l_partkey AS tid, 1 + l_linenumber % 2 AS mate, l_returnflag AS db, l_linestatus = 'F' AND l_linenumber = 3 AS minus, l_quantity AS q,
        substr({gene_seq('l_partkey')}, CAST((l_orderkey * 7 + l_linenumber * 13) % 61 AS INT) + 1, 36) AS s FROM lineitem) r""",
    "text_reads": "SELECT doc_id, translate(text, 'abcdefghijklmopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTA') AS seq FROM documents",
    "frags": "SELECT 's' || CAST(CAST(floor(event_id / 500) AS BIGINT) AS STRING) AS scaff, event_id AS frag, (event_id * 37) % 20000 + 1 AS lend, (event_id * 37) % 20000 + 100 + CAST(floor(value) AS BIGINT) % 300 AS rend FROM events",
    "features": "SELECT 's' || CAST(CAST(floor(p_partkey / 100) AS BIGINT) AS STRING) AS scaff, p_partkey AS feature, (p_partkey * 173) % 20000 + 1 AS lend, (p_partkey * 173) % 20000 + 50 + p_size * 20 AS rend FROM part",
    "dense_frags": "SELECT 's' || CAST(user_id % 5 AS STRING) AS scaff, event_id AS frag, (event_id * 37) % 20000 + 1 AS lend, (event_id * 37) % 20000 + 100 + CAST(floor(value) AS BIGINT) % 300 AS rend FROM events",
    "dense_features": "SELECT 's' || CAST(p_partkey % 5 AS STRING) AS scaff, p_partkey AS feature, (p_partkey * 173) % 20000 + 1 AS lend, (p_partkey * 173) % 20000 + 50 + p_size * 20 AS rend FROM part",
    "aligns": """SELECT 'r' || CAST(l_orderkey AS STRING) AS qname,
        CASE WHEN l_linenumber % 2 = 0 THEN 65 ELSE 129 END + CASE WHEN l_returnflag = 'A' THEN 2 ELSE 0 END + CASE WHEN l_linestatus = 'F' THEN 16 ELSE 32 END + CASE WHEN l_quantity < 3 THEN 4 ELSE 0 END + CASE WHEN l_quantity > 48 THEN 8 ELSE 0 END AS flag,
        'c' || CAST(CAST(floor(l_orderkey / 500) AS BIGINT) * 5 + l_suppkey % 5 AS STRING) AS rname, (l_partkey * 31 + l_linenumber * 17) % 10000 + 1 AS pos, CAST(l_quantity AS INT) AS mapq,
        CASE l_linenumber % 5 WHEN 0 THEN '36M' WHEN 1 THEN '10M100N26M' WHEN 2 THEN '5S31M' WHEN 3 THEN '20M2I14M' ELSE '12M3D24M' END AS cigar,
        (l_partkey * 31 + l_linenumber * 17) % 10000 + 1 + (l_suppkey % 7) * 60 AS mpos, l_orderkey AS ord, l_linenumber AS num FROM lineitem""",
    "counts": "SELECT l_partkey AS feature, l_returnflag || l_linestatus AS sample, count(*) AS cnt FROM lineitem GROUP BY l_partkey, l_returnflag || l_linestatus",
    "lengths": "SELECT p_partkey AS feature, 200 + p_size * 40 AS len, CAST(floor(p_partkey / 4) AS BIGINT) AS comp FROM part",
}

#: Rows of a view that one task takes where windows or places are made of them, which are some hundred a row; files of such narrow tables come in few parts, and a part is one task.
EACH = {"transcripts": 10_000, "targets": 10_000, "frags": 25_000, "dense_frags": 25_000}

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def view(spark: SparkSession, sf_dir: str, name: str, spread: bool = True) -> DataFrame:
    """A derived input. The driver's tables that it reads are registered on the way. spread False leaves their parts as they are, for what makes no more rows of each."""
    sql = VIEWS[name]
    for t in TABLES:
        if f" {t}" in sql:
            rows = spark.read.parquet(f"{sf_dir}/{t}.parquet")
            spread_out(rows, EACH.get(name) if spread else None).createOrReplaceTempView(t)
    return spark.sql(sql)


def spread_out(rows: DataFrame, each: int | None) -> DataFrame:
    """rows in parts of about ``each``, where there are more than that; None leaves them."""
    n = -(-rows.count() // each) if each else 1
    return rows.repartition(n) if n > 1 else rows


def with_views(sql: str, *names: str) -> str:
    """SQL for DuckDB over derived inputs; a dense one goes by its plain name."""
    ctes = ", ".join(f"{n.removeprefix('dense_')} AS ({VIEWS[n]})" for n in names)
    body = sql.strip()
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {ctes}, {body[15:]}"
    return f"WITH {ctes}, {body[5:]}" if body.upper().startswith("WITH ") else f"WITH {ctes} {body}"
