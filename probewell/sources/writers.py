"""Sinks. Text sinks write one directory of part files in sorted order; Parquet is the format between jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.reads import sort_gtab, sort_tab
from .readers import GTAB_NAMES, HANG


def _text(df: DataFrame, line: Column, path: str, mode: str = "error") -> None:
    df.select(line.alias("value")).write.mode(mode).text(path)


def write_tab(reads: DataFrame, path: str) -> None:
    """contig, strand and the flat list of block ends, sorted."""
    flat = F.array_join(F.flatten(F.transform("regions", lambda r: F.array(r["first"].cast("string"), r["second"].cast("string")))), "\t")
    rows = sort_tab(reads)
    _text(rows, F.concat_ws("\t", "contig", "strand", flat), path)


def write_gtab(gtab: DataFrame, path: str, mode: str = "error") -> None:
    """``@Name index`` lines in a part of their own that sorts first, then rows by contig, strand and position."""
    back = {v: k for k, v in GTAB_NAMES.items()}
    spark = gtab.sparkSession
    head = [(f"@{back.get(c, c)} {i}",) for i, c in enumerate(gtab.columns, 1)]

    def cell(c: str, kind: str) -> Column:
        if kind.startswith("array"):
            return F.array_join(F.transform(c, lambda v: F.coalesce(v, F.lit(-1.0)).cast("string")), ",")
        return F.coalesce(F.col(c), F.lit(-1.0)).cast("string") if kind == "double" else F.col(c).cast("string")

    first = spark.createDataFrame(head, "value string").coalesce(1)
    body = sort_gtab(gtab).select(F.concat_ws("\t", *[cell(c, k) for c, k in gtab.dtypes]).alias("value"))
    first.union(body).write.mode(mode).text(path)


def write_bedgraph(tracks: DataFrame, path: str) -> None:
    """(track, strand, contig, pos, value) → contig, pos - 1, pos, value with three decimals; a directory for each track and strand."""
    line = F.concat_ws("\t", "contig", (F.col("pos") - 1).cast("string"), F.col("pos").cast("string"), F.format_string("%.3f", "value"))
    sign = F.when(F.col("strand") == "+", "plus").otherwise("minus")
    rows = tracks.withColumn("sign", sign).repartitionByRange("track", "sign", "contig", "pos").sortWithinPartitions("track", "sign", "contig", "pos")
    rows.select("track", "sign", line.alias("value")).write.partitionBy("track", "sign").text(path)


def write_shape(shapes: DataFrame, path: str, append: bool = False) -> None:
    scores = F.array_join(F.transform("scores", lambda x: F.when(x.isNotNull(), F.format_string("%.3f", x))), "\t", "NULL")
    fpkm = F.coalesce(F.col("fpkm").cast("string"), F.lit("*")) if "fpkm" in shapes.columns else F.lit("*")
    _text(shapes, F.concat_ws("\t", "transcript_id", F.col("length").cast("string"), fpkm, scores), path, "append" if append else "error")


def write_fastq(reads: DataFrame, path: str) -> None:
    _text(reads, F.concat_ws("\n", "key", "seq", "tag", "qual"), path)


def write_fasta(seqs: DataFrame, path: str, width: int = 60) -> None:
    note = F.when(F.coalesce("annotation", F.lit("")) != "", F.concat(F.lit(" "), "annotation")).otherwise("") if "annotation" in seqs.columns else F.lit("")
    folded = F.regexp_replace(F.regexp_replace("seq", f"(.{{{width}}})", "$1\n"), "\n$", "")
    _text(seqs, F.concat(F.lit(">"), "id", note, F.lit("\n"), folded), path)


def write_dh(hangs: DataFrame, path: str) -> None:
    parts = [F.lit("||") if n == "sep" else F.coalesce(F.col(n).cast("string"), F.lit("*")) if n in hangs.columns else F.lit("*") for n, _ in HANG]
    _text(hangs, F.concat_ws("\t", *parts), path)


def write_dg_tab(groups: DataFrame, members: DataFrame, path: str, min_support: int = 2) -> None:
    """Groups with enough reads: arms, support, coverages, score and the read list."""
    reads = members.groupBy("group_id").agg(F.array_join(F.array_sort(F.collect_set("read_id")), ",").alias("reads"))
    rows = groups.where(F.col("support") >= min_support).join(reads, "group_id").orderBy("chr_1", "strand_1", "start_1", "group_id")
    _text(rows, F.concat_ws("\t", *[F.col(c).cast("string") for c in rows.columns]), path)


def write_by_barcode(reads: DataFrame, path: str) -> None:
    """FASTQ text, one directory for each ``library``."""
    reads.select("library", F.concat_ws("\n", "key", "seq", "tag", "qual").alias("value")).write.partitionBy("library").text(path)
