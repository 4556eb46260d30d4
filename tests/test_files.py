import random

import pytest
from pyspark.sql import Row

from probewell.operators import tracks
from probewell.plans import scratch
from probewell.sources import readers


@pytest.fixture
def tiny_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_records_keep_their_order_over_splits_and_files(spark, tmp_path, tiny_splits):
    rng = random.Random(5)
    want = []
    for name in "abc":  # c is the longest file, so a scan plans its splits first
        records = [(f"@{name}{i}", "ACGT" * rng.randint(0, 9), "+", "I" * 3) for i in range(4 + 40 * (name == "c"))]
        (tmp_path / f"{name}.fq").write_text("".join("\n".join(r) + "\n" for r in records))
        want += records
    rows = readers.read_fastq(spark, str(tmp_path))
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 3
    assert [tuple(r)[1:] for r in rows.orderBy("id").collect()] == want
    assert [r.id for r in rows.orderBy("id").collect()] == list(range(len(want)))


def test_matrix_rows_skip_blank_lines(spark, tmp_path, tiny_splits):
    lines = [" ".join(str((i * j) % 5) for j in range(30)) for i in range(40)]
    (tmp_path / "m.txt").write_text("\n\n".join(lines) + "\n  \n")
    found = {(r.x, r.y): r.value for r in readers.read_matrix(spark, str(tmp_path / "m.txt")).collect()}
    assert found == {(i, j): float((i * j) % 5) for i in range(40) for j in range(30) if (i * j) % 5}


def test_empty_files(spark, tmp_path):
    (tmp_path / "e.fq").write_text("")
    assert readers.read_fastq(spark, str(tmp_path / "e.fq")).count() == 0
    assert readers.read_matrix(spark, str(tmp_path / "e.fq")).count() == 0


def test_scaling_factors_are_listed_as_foreground_stops_then_background(spark):
    side = lambda f, rpkm: spark.createDataFrame([Row(transcript_id="t", length=2, type=k, rpkm=rpkm, scaling=s, values=[s, s + 1]) for k, s in (("baseDensity", f), ("RTstop", f + 10))])
    row = tracks.enrich_fg_bg_join(side(1.0, "5,6"), side(2.0, "7")).first()
    assert (row.rpkms, row.scalings) == ("5,6,7", "11.0,2.0,12.0")
    assert (row.fg_rt, row.fg_bd, row.bg_rt, row.bg_bd) == ([11.0, 12.0], [1.0, 2.0], [12.0, 13.0], [2.0, 3.0])


def test_files_of_queries_go_to_the_shared_folder(spark):
    class Cluster:
        conf = {}

        class sparkContext:  # noqa: N801
            master = "spark://host:7077"

    with pytest.raises(RuntimeError, match="shared folder"):
        scratch.scratch(Cluster, "x")
    one, two = scratch.scratch(spark, "x"), scratch.scratch(spark, "x")
    assert one != two
    Cluster.conf = {"spark.checkpoint.dir": "hdfs://n/shared/"}
    assert scratch.scratch(Cluster, "x").startswith("hdfs://n/shared/x-")


@pytest.mark.parametrize("size", [1, 7, 1000])
def test_fasta_tiles_while_reading(spark, tmp_path, size):
    rng = random.Random(size)
    letters = lambda n: "".join(rng.choices("ACGTN", k=n))
    records = [("one", letters(900)), ("two", letters(3)), ("empty", ""), ("one", letters(611)), ("three", letters(250))]
    for name, part in (("a", records[:4]), ("b", records[4:])):
        text = "".join(f">{i} note {k}\n" + "".join(s[j : j + 60] + "\n" for j in range(0, len(s), 60)) for k, (i, s) in enumerate(part))
        (tmp_path / f"{name}.fa").write_text("ACGT\n" + text if name == "a" else text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")  # records over many splits
    try:
        got = {(r.contig, r.tile): r.seq for r in readers.read_fasta_tiles(spark, str(tmp_path), size).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    last = dict(records)
    assert got == {(i, t): last[i][t * size : (t + 1) * size] for i in last for t in range(-(-len(last[i]) // size))}
