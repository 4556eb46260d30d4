"""Text formats as DataFrames. Nothing is read on the driver but header lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.sequence import is_scaffold, parse_gff3_attributes, parse_gtf_attributes, strip_version


def _fields(spark: SparkSession, path, skip: str | None = None) -> DataFrame:
    rows = spark.read.text(path).where("value <> ''")
    if skip:
        rows = rows.where(~F.startswith("value", F.lit(skip)))
    return rows.select(F.split("value", "\t").alias("f"))


def _f(i: int, kind: str = "string") -> Column:
    x = F.get("f", F.lit(i))
    return x if kind == "string" else x.try_cast(kind)


def _spans(text: Column) -> Column:
    """``s-e,s-e`` → array of (first, second)."""
    return F.transform(F.filter(F.split(text, ","), lambda x: x != ""), lambda x: F.struct(F.split(x, "-")[0].cast("long").alias("first"), F.split(x, "-")[1].cast("long").alias("second")))


def _numbered(spark: SparkSession, path, keep: str | None = None) -> DataFrame:
    """value, n: the lines (those that meet ``keep``), numbered 0, 1, ... in order of files and places.

    A split's lines have consecutive ids; a pass of its own counts the lines of the splits before it. Only one row for each split
    is ordered in one place. With ``keep`` the lines of a split are ranked, else its smallest id is taken off.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("at"))
    lines = lines.withColumn("kept", F.lit(True) if keep is None else F.expr(keep))
    counts = lines.groupBy("file", "split").agg(F.count_if("kept").alias("lines"), F.min("at").alias("first"))
    before = Window.orderBy("file", "split").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("file", "split", "first", F.coalesce(F.sum("lines").over(before), F.lit(0)).alias("before"))
    if keep is None:
        return lines.join(offsets, ["file", "split"]).select("value", (F.col("before") + F.col("at") - F.col("first")).alias("n"))
    within = Window.partitionBy("file", "split").orderBy("at")
    kept = lines.where("kept").withColumn("k", F.row_number().over(within) - 1)
    return kept.join(offsets, ["file", "split"]).select("value", (F.col("before") + F.col("k")).alias("n"))


def read_sam(spark: SparkSession, path: str) -> DataFrame:
    """Eleven columns and the tag map (name → value, with the type letter left out but for B). Header lines are skipped."""
    names = (("read_id", "string"), ("flag", "int"), ("chr_id", "string"), ("pos", "long"), ("mapq", "int"), ("cigar", "string"), ("rnext", "string"), ("pnext", "long"), ("tlen", "long"), ("seq", "string"), ("qual", "string"))
    rows = _fields(spark, path, "@")
    entries = F.transform(F.slice("f", F.lit(12), F.greatest(F.size("f") - 11, F.lit(0))), lambda t: F.struct(F.substring(t, 1, 2).alias("k"), F.regexp_replace(t, r"^..:(?:[^B]:|(?=B:))", "").alias("v")))
    return rows.select(*[_f(i, k).alias(n) for i, (n, k) in enumerate(names)], F.map_from_entries(F.array_distinct(entries)).alias("tags"))


def read_sam_header(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.text(path).where(F.startswith("value", F.lit("@SQ")))
    return rows.select(F.regexp_extract("value", r"\tSN:([^\t]+)", 1).alias("contig"), F.regexp_extract("value", r"\tLN:(\d+)", 1).cast("long").alias("length"))


def read_fastq(spark: SparkSession, path: str) -> DataFrame:
    """id (0, 1, ... in file order), key, seq, tag, qual, plain or gz.

    Lines are numbered by ``_numbered``; the four lines of a record are then gathered by one grouped aggregate.
    """
    rows = _numbered(spark, path)
    pick = lambda k: F.max(F.when(F.col("n") % 4 == k, F.col("value")))
    return rows.groupBy(F.floor(F.col("n") / 4).alias("id")).agg(pick(0).alias("key"), pick(1).alias("seq"), pick(2).alias("tag"), pick(3).alias("qual")).where("seq is not null")


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """id, annotation, seq. Of records with one id in a file the last one counts."""
    rows = spark.read.option("lineSep", "\n>").text(path).select(F.regexp_replace("value", "^>", "").alias("value"), F.monotonically_increasing_id().alias("n")).where("trim(value) <> ''")
    head = F.substring_index("value", "\n", 1)
    body = F.when(F.contains("value", F.lit("\n")), F.regexp_replace(F.regexp_replace("value", "^[^\n]*\n", ""), r"\s", "")).otherwise("")
    named = rows.select(F.regexp_extract(head, r"^(\S*)", 1).alias("id"), F.trim(F.regexp_replace(head, r"^\S*", "")).alias("annotation"), body.alias("seq"), "n")
    return named.groupBy("id").agg(F.max_by(F.struct("annotation", "seq"), "n").alias("r")).select("id", "r.annotation", "r.seq")


def tile_fasta(fasta: DataFrame, size: int = 1_000_000) -> DataFrame:
    """(contig, tile, seq): a genome in tiles, for equi-joins on (contig, tile)."""
    tiles = F.sequence(F.lit(0).cast("long"), F.floor((F.length("seq") - 1) / size))
    return fasta.where("seq <> ''").select(F.col("id").alias("contig"), F.explode(tiles).alias("tile"), "seq").select("contig", "tile", F.substring("seq", (F.col("tile") * size + 1).cast("int"), F.lit(size)).alias("seq"))


def read_fasta_tiles(spark: SparkSession, path: str, size: int = 1_000_000) -> DataFrame:
    """(contig, tile, seq): ``tile_fasta`` of a FASTA file, made while its lines are read; no row holds a sequence.

    Running sums of the line lengths over the splits of each file give every line its place in its record; its letters go to
    one or two tiles. Of records with one id the last one of a file counts. Lines in front of the first record are left out.
    """
    from ..operators import scan

    start = F.col("_metadata.file_block_start").alias(scan.PART)
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), start, F.monotonically_increasing_id().alias(scan.AT), "value")
    head = F.startswith("value", F.lit(">"))
    bases = F.when(head, "").otherwise(F.regexp_replace("value", r"\s", ""))
    table = scan.save(lines.select("file", scan.PART, scan.AT, bases.alias("bases"), F.when(head, F.regexp_extract("value", r"^>\s*(\S*)", 1)).alias("name")), "fasta_lines")
    known = scan.before(table, ["file"], n_bases=F.length("bases"))
    known = known.withColumn("n_bases", F.coalesce("n_bases", F.lit(0)).cast("long"))
    # the record of a line is the last head before it: the latest place, and the letters that stand before that
    latest = F.when(F.col("name").isNotNull(), F.struct(scan.PART, scan.AT, "n_bases", "name"))
    placed = scan.before(known, ["file"], max_head=latest).where("name is null and max_head is not null and bases <> ''")
    heads = table.where("name is not null").groupBy("file", "name").agg(F.max(F.struct(scan.PART, scan.AT)).alias("last"))
    rows = placed.select("file", F.col("max_head.name").alias("name"), F.struct(f"max_head.{scan.PART}", f"max_head.{scan.AT}").alias("last"), (F.col("n_bases") - F.col("max_head.n_bases")).alias("place"), "bases")
    rows = rows.join(heads, ["file", "name", "last"], "left_semi")
    cut = rows.withColumn("tile", F.explode(F.expr(f"sequence(place div {size}, (place + length(bases) - 1) div {size})")))
    lo = F.greatest(F.col("tile") * size - F.col("place"), F.lit(0))
    piece = F.substring("bases", (lo + 1).cast("int"), F.least(F.length("bases") - lo, (F.col("tile") + 1) * size - F.col("place") - lo).cast("int"))
    pieces = cut.select(F.col("name").alias("contig"), "tile", F.struct("place", piece.alias("seq")).alias("p"))
    return pieces.groupBy("contig", "tile").agg(F.array_join(F.transform(F.array_sort(F.collect_list("p")), lambda x: x["seq"]), "").alias("seq"))


def read_tab(spark: SparkSession, path: str, sample: str | None = None) -> DataFrame:
    """contig, strand, regions (from pairs of columns), and the sample's name if given."""
    rows = _fields(spark, path)
    pairs = F.transform(F.sequence(F.lit(2), F.size("f") - 2, F.lit(2)), lambda i: F.struct(F.get("f", i).cast("long").alias("first"), F.get("f", i + 1).cast("long").alias("second")))
    out = rows.where(F.size("f") >= 4).select(_f(0).alias("contig"), _f(1).alias("strand"), pairs.alias("regions"))
    return out if sample is None else out.withColumn("sample", F.lit(sample))


GTAB_NAMES = {"ChrID": "contig", "Strand": "strand", "ChrPos": "pos", "Base": "base", "N_RT": "n_rt", "N_BD": "n_bd", "D_RT": "d_rt", "D_BD": "d_bd", "Shape": "shape", "ShapeNum": "shape_num", "WindowShape": "window_shape"}


def read_gtab(spark: SparkSession, path: str) -> DataFrame:
    """The columns that the ``@Name index`` lines name; -1 is null in scores; WindowShape becomes an array."""
    head = [r[0][1:].split() for r in spark.read.text(path).where(F.startswith("value", F.lit("@"))).collect()]  # a dozen lines
    rows = _fields(spark, path, "@")
    null = lambda x: F.when(x != -1, x)
    out = []
    for name, index in sorted(((h[0], int(h[1])) for h in head if len(h) == 2 and h[1].isdigit()), key=lambda x: x[1]):
        x, to = _f(index - 1), GTAB_NAMES.get(name, name)
        if name == "WindowShape":
            x = F.transform(F.split(x, ","), lambda v: null(v.try_cast("double")))
        elif name == "Shape":
            x = null(x.try_cast("double"))
        elif to in ("pos", "n_rt", "n_bd", "d_rt", "d_bd", "shape_num") or name.startswith(("RT_", "BD_")):
            x = x.try_cast("long")
        out.append(x.alias(to))
    return rows.select(*out)


def read_chr_size(spark: SparkSession, path: str) -> DataFrame:
    return _fields(spark, path).select(_f(0).alias("contig"), _f(1, "long").alias("length"))


def read_junctions(spark: SparkSession, path: str, sizes: DataFrame) -> DataFrame:
    """contig, first, second, strand; those on unknown contigs or ending at or beyond the size are dropped."""
    rows = _fields(spark, path).select(_f(0).alias("contig"), _f(1, "long").alias("first"), _f(2, "long").alias("second"), _f(3).alias("strand"))
    return rows.join(sizes, "contig").where("length > second").drop("length")


def _annotation(spark: SparkSession, path: str, rem_scaffold: bool) -> DataFrame:
    names = ("contig", "source", "feature")
    rows = _fields(spark, path, "#").where(F.size("f") >= 9).select(*[_f(i).alias(n) for i, n in enumerate(names)], _f(3, "long").alias("first"), _f(4, "long").alias("second"), _f(6).alias("strand"), _f(8).alias("text"))
    return rows.where(~is_scaffold("contig")) if rem_scaffold else rows


def read_gtf(spark: SparkSession, path: str, rem_scaffold: bool = False) -> DataFrame:
    rows = _annotation(spark, path, rem_scaffold)
    return rows.withColumn("attributes", parse_gtf_attributes("text")).drop("text")


def read_gff3(spark: SparkSession, path: str, rem_scaffold: bool = False) -> DataFrame:
    rows = _annotation(spark, path, rem_scaffold)
    return rows.withColumn("attributes", parse_gff3_attributes("text")).drop("text")


def read_genome_coor(spark: SparkSession, path: str, rem_tver: bool = False, rem_gver: bool = False) -> DataFrame:
    """contig, first, second, strand, gene_name, gene_id, transcript_id, type, exons, utr (arrays)."""
    rows = _fields(spark, path)
    gene = F.split(_f(4), "=")
    tid, gid = _f(5), F.get(gene, F.lit(1))
    return rows.select(
        _f(0).alias("contig"), _f(1, "long").alias("first"), _f(2, "long").alias("second"), _f(3).alias("strand"), gene[0].alias("gene_name"), (strip_version(gid) if rem_gver else gid).alias("gene_id"),
        (strip_version(tid) if rem_tver else tid).alias("transcript_id"), _f(6).alias("type"), _spans(_f(7)).alias("exons"), F.coalesce(_spans(_f(8)), F.array().cast("array<struct<first:bigint,second:bigint>>")).alias("utr"),
    )


def read_shape(spark: SparkSession, path: str, min_rpkm: float | None = None) -> DataFrame:
    """transcript_id, length, fpkm (null for *), scores; rows whose score count is not the length are dropped."""
    rows = _fields(spark, path, "#").select(_f(0).alias("transcript_id"), _f(1, "long").alias("length"), _f(2, "double").alias("fpkm"), F.transform(F.slice("f", F.lit(4), F.greatest(F.size("f") - 3, F.lit(0))), lambda x: x.try_cast("double")).alias("scores"))
    rows = rows.where(F.size("scores") == F.col("length"))
    return rows if min_rpkm is None else rows.where(F.col("fpkm") >= min_rpkm)


def read_fpkm(spark: SparkSession, paths: list[str]) -> DataFrame:
    """transcript_id, fpkm: mean over files of the rows with status OK."""
    rows = _fields(spark, paths).where(_f(12) == "OK").select(_f(0).alias("transcript_id"), _f(9, "double").alias("fpkm"))
    return rows.groupBy("transcript_id").agg(F.avg("fpkm").alias("fpkm"))


def read_rt_file(spark: SparkSession, path: str, fmt: str = "raw") -> DataFrame:
    """raw: transcript_id, length, rpkm, bd, rt (arrays; the first line of a transcript is BD). normalized: with type, scaling and values."""
    if fmt == "normalized":
        values = F.transform(F.slice("f", F.lit(6), F.greatest(F.size("f") - 5, F.lit(0))), lambda x: x.try_cast("double"))
        return _fields(spark, path, "#").select(_f(0).alias("transcript_id"), _f(1, "long").alias("length"), _f(2).alias("type"), _f(3).alias("rpkm"), _f(4, "double").alias("scaling"), values.alias("values"))
    if fmt != "raw":
        raise ValueError("fmt must be raw or normalized")
    rows = spark.read.text(path).withColumn("n", F.monotonically_increasing_id()).where("value <> '' and value not like '#%'").select("n", F.split("value", "\t").alias("f"))
    values = F.transform(F.slice("f", F.lit(4), F.greatest(F.size("f") - 3, F.lit(0))), lambda x: x.try_cast("double"))
    pair = rows.select(_f(0).alias("transcript_id"), _f(1, "long").alias("length"), _f(2).alias("rpkm"), values.alias("v"), "n")
    return pair.groupBy("transcript_id", "length", "rpkm").agg(F.min_by("v", "n").alias("bd"), F.max_by("v", "n").alias("rt"))


def read_dot(spark: SparkSession, path: str) -> DataFrame:
    """id, seq, dot from three-line records."""
    rows = spark.read.option("lineSep", "\n>").text(path).select(F.split(F.regexp_replace("value", "^>", ""), "\n").alias("f")).where(F.size("f") >= 3)
    return rows.select(F.split(F.trim(_f(0)), r"\s+")[0].alias("id"), F.trim(_f(1)).alias("seq"), F.trim(_f(2)).alias("dot"))


def read_stockholm(spark: SparkSession, path: str) -> DataFrame:
    """id, note, aligned; the row SS_cons has the consensus structure. Blocks are joined in file order."""
    rows = spark.read.text(path).withColumn("n", F.monotonically_increasing_id()).where("value <> '' and value <> '//' and value not like '# STOCKHOLM%'")
    notes = rows.where(F.startswith("value", F.lit("#=GS"))).select(F.regexp_extract("value", r"^#=GS\s+(\S+)\s+DE\s+(.*)$", 1).alias("id"), F.regexp_extract("value", r"^#=GS\s+(\S+)\s+DE\s+(.*)$", 2).alias("note")).where("id <> ''").dropDuplicates(["id"])
    body = rows.where(~F.startswith("value", F.lit("#")) | F.startswith("value", F.lit("#=GC SS_cons")))
    part = body.select(F.regexp_extract("value", r"^(?:#=GC\s+)?(\S+)\s+(\S+)\s*$", 1).alias("id"), F.struct("n", F.regexp_extract("value", r"^(?:#=GC\s+)?(\S+)\s+(\S+)\s*$", 2).alias("s")).alias("p"))
    joined = part.groupBy("id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("p")), lambda p: p["s"]), "").alias("aligned"))
    return joined.join(notes, "id", "left").select("id", "note", "aligned")


def read_matrix(spark: SparkSession, path: str) -> DataFrame:
    """x, y, value (0-based) of a square table; zeros are left out."""
    rows = _numbered(spark, path, "trim(value) <> ''").withColumnRenamed("n", "x")
    cells = rows.select("x", F.posexplode(F.split(F.trim("value"), r"\s+")).alias("y", "v"))
    return cells.select("x", F.col("y").cast("long").alias("y"), F.col("v").cast("double").alias("value")).where("value <> 0")


HANG = (("read_id", "string"), ("chr_1", "string"), ("strand_1", "string"), ("flag_1", "int"), ("cigar_1", "string"), ("start_1", "long"), ("end_1", "long"), ("sep", "string"), ("chr_2", "string"), ("strand_2", "string"), ("flag_2", "int"), ("cigar_2", "string"), ("start_2", "long"), ("end_2", "long"))


def read_dh(spark: SparkSession, path: str) -> DataFrame:
    return _fields(spark, path).select(*[_f(i, k).alias(n) for i, (n, k) in enumerate(HANG) if n != "sep"])


def read_accessibility(spark: SparkSession, path: str) -> DataFrame:
    return _fields(spark, path, "#").select(_f(0).alias("id"), _f(1, "int").alias("pos"), _f(2).alias("base"), _f(3, "double").alias("value"))
