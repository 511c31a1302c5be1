from pyspark.sql import functions as F

from strandloom.operators import contigs, kmers
from strandloom.sources import formats, generate, sinks
from strandloom.streaming import incremental


def test_fasta_round_trip(spark, tmp_path):
    rows = generate.sequences(spark, 20, 130).select(F.concat(F.lit("s"), "id", F.lit(" some text")).alias("header"), "seq")
    sinks.write_lines(rows, sinks.fasta_record(F.col("header"), F.col("seq")), str(tmp_path / "fa"))
    back = formats.fasta(spark, str(tmp_path / "fa"))
    assert sorted(map(tuple, back.select("header", "seq").collect())) == sorted(map(tuple, rows.collect()))
    assert back.where("acc LIKE '% %' OR acc = ''").count() == 0


def test_fastq(spark, tmp_path):
    (tmp_path / "a.fq").write_text("@r1/1\nACGT\n+\n@III\n@r2 2:N:0\nAC\n+\nII\n")
    got = formats.fastq(spark, str(tmp_path / "a.fq")).orderBy("name").collect()
    assert [tuple(r) for r in got] == [("r1", 1, "ACGT", "@III"), ("r2", 2, "AC", "II")]


def test_sam_wig_gff_psl_vcf(spark, tmp_path):
    (tmp_path / "a.sam").write_text("@HD\tVN:1.0\nr1\t65\tc1\t7\t60\t4M\t=\t90\t87\tACGT\tIIII\tNM:i:1\tXS:A:+\n")
    row = formats.sam(spark, str(tmp_path / "a.sam")).select("qname", "pos", formats.tag("XS").alias("xs"), F.size("tags").alias("n")).first()
    assert tuple(row) == ("r1", 7, "+", 2)
    (tmp_path / "a.wig").write_text("track x\nvariableStep chrom=c1\n5 2\n6 3\nvariableStep chrom=c2\n1 9\n")
    assert sorted(map(tuple, formats.wig(spark, str(tmp_path / "a.wig")).collect())) == [("c1", 5, 2.0), ("c1", 6, 3.0), ("c2", 1, 9.0)]
    (tmp_path / "a.gff").write_text('c1\tx\texon\t1\t9\t.\t+\t.\tParent=t1;ID=e1\nc1\tx\texon\t20\t30\t.\t+\t.\tParent=t1\n')
    models = formats.gene_models(formats.gff(spark, str(tmp_path / "a.gff")))
    assert tuple(formats.introns(models).first()) == ("t1", 10, 19)
    (tmp_path / "a.psl").write_text("20\t0\t0\t0\t0\t0\t0\t0\t-\tq\t30\t2\t22\tt\t100\t10\t40\t2\t10,10,\t5,18,\t10,30,\n")
    blocks = formats.psl_blocks(formats.psl(spark, str(tmp_path / "a.psl"))).orderBy("t_lend").collect()
    assert [(b.q_lend, b.q_rend, b.t_lend, b.t_rend) for b in blocks] == [(16, 25, 11, 20), (3, 12, 31, 40)]
    (tmp_path / "a.vcf").write_text("##x\nc1\t5\t.\tA\tG\t9\tPASS\tDP=3;AF=0.5\n")
    assert formats.vcf(spark, str(tmp_path / "a.vcf")).select(F.element_at("tags", "DP")).first()[0] == "3"
    (tmp_path / "g.txt").write_text("Component 4\n1 -1 5 ACGT 1\n2 1 6 CGTA 1\n")
    assert formats.edge_list(spark, str(tmp_path / "g.txt")).where("component = 4").count() == 2


def test_keyed_store(spark, tmp_path):
    rows = spark.range(100).select("id", (F.col("id") * 2).alias("v"))
    sinks.store(rows, str(tmp_path / "kv"), "id", 8)
    assert [tuple(r) for r in sinks.fetch(spark, str(tmp_path / "kv"), "id", 42, 8).collect()] == [(42, 84)]


def test_greedy_contigs_are_substrings(spark):
    genome = generate.sequences(spark, 1, 400, seed=5)
    reads = generate.paired_reads(genome, 200, 60, 150)
    counts = kmers.count(kmers.explode_kmers(reads, 21), canonical=False)
    found = contigs.assemble(counts, 21, least_length=50).collect()
    truth = genome.first().seq
    comp = truth.translate(str.maketrans("ACGT", "TGCA"))[::-1]
    assert found and all(c.seq in truth or c.seq in comp for c in found)


def test_counts_do_not_depend_on_partitions(spark):
    seqs = generate.sequences(spark, 30, 80)
    one, many = (kmers.count(kmers.explode_kmers(seqs.repartition(n), 9), canonical=True) for n in (1, 7))
    assert one.exceptAll(many).count() == 0 and many.exceptAll(one).count() == 0


def test_streams_equal_batches(spark, tmp_path):
    src = str(tmp_path / "in")
    generate.sequences(spark, 20, 50).repartition(3).write.parquet(src)
    stream = spark.readStream.schema("id long, seq string").option("maxFilesPerTrigger", 1).parquet(src)
    cat = str(tmp_path / "cat")
    q = incremental_query(stream, cat, str(tmp_path / "ck"))
    q.awaitTermination()
    want = kmers.count(kmers.explode_kmers(spark.read.parquet(src), 7))
    got = incremental.catalogue(spark, cat)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def incremental_query(stream, cat, ck):
    merge = incremental.merge_into(cat)
    return stream.writeStream.foreachBatch(lambda b, n: merge(kmers.count(kmers.explode_kmers(b, 7)), n)).option("checkpointLocation", ck).trigger(availableNow=True).start()


def test_windowed_and_session_streams(spark, tmp_path):
    events = spark.createDataFrame([(i, 60.0 * i) for i in range(20)], "user_id long, s double").select((F.col("user_id") % 2).alias("user_id"), F.timestamp_seconds("s").alias("ts"), F.lit("x").alias("event_type"), F.lit(1.0).alias("value"))
    events.write.parquet(str(tmp_path / "ev"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "ev"))
    for name, df in (("w", incremental.windowed_coverage(stream, "5 minutes", late="0 seconds")), ("s", incremental.sessions(stream, "10 minutes", late="0 seconds"))):
        q = df.writeStream.outputMode("complete").format("memory").queryName(name).trigger(availableNow=True).start()
        q.awaitTermination()
    assert spark.sql("SELECT sum(n) FROM w").first()[0] == 20
    assert spark.sql("SELECT count(*), sum(n) FROM s").first() == (2, 20)


def test_a_large_group_is_several_tasks(spark, tmp_path):
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "64k")
    try:
        rows = spark.range(40_000).repartition(8).select(F.when(F.col("id") < 10, "a").otherwise("b").alias("db"), F.md5(F.col("id").cast("string")).alias("seq"))
        sinks.write_lines(rows, F.col("seq"), str(tmp_path / "groups"), ["db"])
    finally:
        spark.conf.set(size, before)
    assert len(list((tmp_path / "groups" / "db=b").glob("part-*"))) > 3
    assert spark.read.text(str(tmp_path / "groups")).groupBy("db").count().orderBy("db").collect() == [("a", 10), ("b", 39_990)]
