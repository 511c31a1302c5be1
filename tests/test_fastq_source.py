"""The FASTQ data source against the text reader: ranges of every size, block-compressed and plain gzip files."""

import gzip
import random
import struct
import zlib

import pytest

from strandloom.plans import catalog
from strandloom.sources import formats
from strandloom.sources.fastq import FastqReader, fastq

SF = "/root/testdata/sf0.001"


def text_of(n, newline="\n"):
    r = random.Random(4)
    out = []
    for i in range(n):
        size = r.randrange(1, 60)
        seq, qual = "".join(r.choices("ACGTN", k=size)), "".join(r.choices("@+I#", k=size))  # qualities that look like other lines
        out += [f"@r{i}" + ("/1", "/2", " 1:N:0", "", " 2:Y:9")[i % 5], seq, "+", qual]
    return newline.join(out)


def blocks(data, size):
    """data as gzip members that tell their size, with the empty one at the end."""
    out = b""
    for part in [*(data[i : i + size] for i in range(0, len(data), size)), b""]:
        z = zlib.compressobj(6, zlib.DEFLATED, -15)
        body = z.compress(part) + z.flush()
        out += b"\x1f\x8b\x08\x04" + bytes(6) + b"\x06\x00BC\x02\x00" + struct.pack("<H", len(body) + 25) + body + struct.pack("<II", zlib.crc32(part), len(part))
    return out


def rows_of(path, split):
    reader = FastqReader({"path": str(path), "split": str(split)})
    return [tuple(r.values()) for p in reader.partitions() for batch in reader.read(p) for r in batch.to_pylist()]


def test_equals_the_text_reader(spark, tmp_path):
    (tmp_path / "a.fq").write_text(text_of(300) + "\n")
    want = sorted(map(tuple, formats.fastq(spark, str(tmp_path / "a.fq")).collect()), key=str)
    got = fastq(spark, str(tmp_path / "a.fq"), split=700)
    assert got.rdd.getNumPartitions() > 20 and sorted(map(tuple, got.collect()), key=str) == want and len(want) == 300


def test_no_range_loses_or_repeats_records(tmp_path):
    for end, newline in (("", "\n"), ("\n", "\n"), ("\r\n", "\r\n")):
        data = (text_of(40, newline) + end).encode()
        (tmp_path / "a.fq").write_bytes(data)
        want = rows_of(tmp_path / "a.fq", 1 << 30)
        assert len(want) == 40
        assert all(rows_of(tmp_path / "a.fq", split) == want for split in range(1, 200))


def test_compressed(tmp_path):
    data = (text_of(200) + "\n").encode()
    (tmp_path / "a.fq").write_bytes(data)
    want = rows_of(tmp_path / "a.fq", 1 << 30)
    for size in (50, 333, 5000):
        (tmp_path / "b.fq.gz").write_bytes(blocks(data, size))
        assert all(rows_of(tmp_path / "b.fq.gz", split) == want for split in (1, 37, 100, 1000, 1 << 30))
    whole = bytearray(blocks(data, 5000))
    whole[18 + struct.unpack("<H", whole[16:18])[0] - 25] ^= 1  # the first member's checksum
    (tmp_path / "e.fq.gz").write_bytes(whole)
    with pytest.raises(ValueError, match="checksum"):
        rows_of(tmp_path / "e.fq.gz", 1 << 30)
    (tmp_path / "c.fq.gz").write_bytes(gzip.compress(data[:3000]) + gzip.compress(data[3000:]))
    assert rows_of(tmp_path / "c.fq.gz", 100) == want
    (tmp_path / "d.fq.gz").write_bytes(gzip.compress(data)[:-20])
    with pytest.raises(ValueError, match="ends within"):
        rows_of(tmp_path / "d.fq.gz", 100)


def test_odd_files(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    assert fastq(spark, str(folder)).count() == 0
    (folder / "empty.fq").write_text("")
    (folder / "_skipped").write_text("@x\nA\n+\nI\n")
    (folder / "a.fq").write_text("@a\nACG\n+\nIII\n@b\nAC\n+\nI\n@c\nA\n+\nI\n@d\nA")
    assert [r.name for r in fastq(spark, str(folder)).orderBy("name").collect()] == ["a", "c"]
    with pytest.raises(Exception, match="dirty record: @b"):
        fastq(spark, str(folder), ignore_dirty=False).collect()


def test_query(spark):
    found = catalog.queries()["s02_fastq_source"](spark, SF)
    want = catalog.queries()["s02_fastq_reader"](spark, SF)
    assert found.exceptAll(want).isEmpty() and want.exceptAll(found).isEmpty()
