"""FASTQ files cut anywhere: plain, gzip and block gzip give the same records whatever the parts."""

import gzip

import numpy as np
import pytest

from lanefold.sources.fastq import block_gzip, inflated, read_fastq

RNG = np.random.default_rng(17)


def records(n, at="@"):
    out = []
    for k in range(n):
        m = int(RNG.integers(1, 80))
        seq = "".join(RNG.choice(list("ACGTN"), m))
        # qualities that begin like headers and third lines
        qual = str(RNG.choice(["@", "+", "I"])) + "".join(RNG.choice(list("@+I5#"), m - 1))
        out.append((f"r{k}", seq, qual))
    return out


def fastq(rows, newline="\n"):
    return newline.join(f"@{r}/1 x{newline}{s}{newline}+{'' if k % 3 else r}{newline}{q}" for k, (r, s, q) in enumerate(rows)) + newline


def read(spark, path):
    return sorted((r["read_id"], r["seq"], r["qual"]) for r in read_fastq(spark, str(path)).collect())


@pytest.mark.parametrize("size", [97, 1000, 5000, 1 << 20])
def test_any_split(spark, tmp_path, size):
    rows = records(300)
    raw = fastq(rows).encode()
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "OG1_L001_R1_001.fastq").write_bytes(raw)
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "OG1_L001_R1_001.fastq.bgz").write_bytes(block_gzip(raw, 700))
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "OG1_L001_R1_001.fastq.gz").write_bytes(gzip.compress(raw))
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        if size < 5000:
            assert spark.read.option("lineSep", "\x06\x00BC\x02\x00").text(f"{tmp_path}/b").rdd.getNumPartitions() > 2
        for d in "abc":
            assert read(spark, tmp_path / d) == sorted(rows), d
        assert {tuple(r) for r in read_fastq(spark, [f"{tmp_path}/a", f"{tmp_path}/b", f"{tmp_path}/c"]).select("sample", "lane", "mate").collect()} == {("OG1", "001", 1)}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_line_ends_last_lines_and_empty_files(spark, tmp_path):
    rows = records(40)
    (tmp_path / "x_R1.fq").write_bytes(fastq(rows, "\r\n").encode())
    (tmp_path / "y_R1.fq.bgz").write_bytes(block_gzip(fastq([(f"y{r}", s, q) for r, s, q in rows], "\r\n").encode(), 61))
    (tmp_path / "z_R1.fq.bgzf").write_bytes(block_gzip(b"@last\nACG\n+\n@@@"))
    (tmp_path / "e_R1.fq").write_bytes(b"")
    (tmp_path / "f_R1.fq.bgz").write_bytes(block_gzip(b""))
    (tmp_path / "g_R1.fq.bgz").write_bytes(b"")
    assert read(spark, tmp_path) == sorted([*rows, *((f"y{r}", s, q) for r, s, q in rows), ("last", "ACG", "@@@")])


@pytest.mark.parametrize("text", ["@a\nAC\n+\n", "@a\nAC\n+\nII\n@b\nAC\n", "@a\nAC\n+\nI\n", "a\nAC\n+\nII\n", "@a\nAC\n-\nII\n", "@a\nAC\n+\nII\n\n"])
@pytest.mark.parametrize("kind", ["fq", "fq.bgz"])
def test_bad_records(spark, tmp_path, text, kind):
    (tmp_path / f"x_R1.{kind}").write_bytes(text.encode() if kind == "fq" else block_gzip(text.encode()))
    with pytest.raises(Exception, match="FASTQ record|whole records"):
        read_fastq(spark, str(tmp_path)).collect()


def test_damaged_members(spark, tmp_path):
    raw = block_gzip(fastq(records(30)).encode(), 500)
    assert gzip.decompress(raw).startswith(b"@r0")
    (tmp_path / "x_R1.fq.bgz").write_bytes(raw[:300] + bytes([raw[300] ^ 255]) + raw[301:])
    with pytest.raises(Exception):  # noqa: B017  zlib's own error or that of the checksum
        read_fastq(spark, str(tmp_path)).collect()
    with pytest.raises(ValueError, match="whole"):
        inflated(raw[16:200], "f")


def test_only_cut_files_are_read_again(spark, tmp_path):
    from lanefold.sources import fastq as Q

    rows = records(300)
    raw = fastq(rows).encode()
    (tmp_path / "x_R1.fq.gz").write_bytes(gzip.compress(raw))
    (tmp_path / "y_R2.fq").write_bytes(raw)
    (tmp_path / "z_R2.fq.bgz").write_bytes(block_gzip(raw[:-1], 700))
    torn = lambda: {r["file"].rsplit("/", 1)[1] for r in Q._fragments(*Q._lines(spark, str(tmp_path), Q.BLOCKS)).collect()}
    assert torn() == set() and read(spark, tmp_path) == sorted(rows * 3)
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for k, v in zip(old, ("997", "1"), strict=True):
        spark.conf.set(k, v)
    try:
        assert torn() == {"y_R2.fq", "z_R2.fq.bgz"} and read(spark, tmp_path) == sorted(rows * 3)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("kind", ["gz", "bgz"])
@pytest.mark.parametrize("text", ["@a\nAC\n+\n", "@a\nAC\n+\nII\n@b\nAC\n", "@a\nAC\n+\nI\n", "a\nAC\n+\nII\n", "x\n@a\nAC\n+\nII\n", "@a\nAC\n+\nII\n\n"])
def test_bad_records_of_gzip_files(spark, tmp_path, text, kind):
    (tmp_path / f"x_R1.fq.{kind}").write_bytes(gzip.compress(text.encode()) if kind == "gz" else block_gzip(text.encode(), 3))
    with pytest.raises(Exception, match="FASTQ record|whole records"):
        read_fastq(spark, str(tmp_path)).collect()
