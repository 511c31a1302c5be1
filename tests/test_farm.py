from strandloom.operators import farm, kmers


def test_tasks_resume_and_list_failures(spark, tmp_path):
    path, flag = str(tmp_path / "out"), tmp_path / "fixed"
    tasks = spark.createDataFrame([(str(i), str(i)) for i in range(20)], "id string, payload string")
    ran = tmp_path / "ran"
    ran.mkdir()

    def work(payload):
        (ran / f"{payload}-{len(list(ran.glob(payload + '-*')))}").touch()
        if int(payload) % 7 == 3 and not flag.exists():
            raise ValueError(f"bad {payload}")
        return payload * 2

    first = {r.id: r for r in farm.run_tasks(tasks, work, path, 3).collect()}
    assert sum(r.ok for r in first.values()) == 17 and first["5"].result == "55"
    assert {(r.id, r.error) for r in farm.failed(spark, path).collect()} == {(x, f"ValueError: bad {x}") for x in ("3", "10", "17")}
    flag.touch()
    assert all(r.ok for r in farm.run_tasks(tasks, work, path, 3).collect()) and farm.failed(spark, path).count() == 0
    assert len(list(ran.iterdir())) == 23  # what had succeeded wasn't run again
    assert farm.run_tasks(tasks, work, path).count() == 20 and len(list(ran.iterdir())) == 23


def test_comparators_and_methods(spark):
    counts = spark.createDataFrame([("AACG", 3), ("CGTT", 2), ("AACC", 1)], "kmer string, cnt long")
    wanted = spark.createDataFrame([("AACG",)], "kmer string")
    hits = lambda how: {(r.hit, r.cnt) for r in kmers.matching(counts, wanted, 4, how).collect()}
    assert hits("exact") == {("AACG", 3)} and hits("either_strand") == {("AACG", 3), ("CGTT", 2)} and hits("one_mismatch") == {("AACG", 3), ("AACC", 1)}
    assert hits(lambda w, k: kmers.COMPARATORS["exact"](w, k).limit(0)) == set()
    seqs = spark.createDataFrame([("ACGTNACGTT",)], "seq string")
    a, b = ({(r.kmer, r.cnt) for r in kmers.count_in(seqs, 4, True, method=m).collect()} for m in ("packed", "words"))
    assert a == b
