"""Registered queries that write a file format and read it again, with SQL over the source tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import sequence
from ..operators import annotation, tracks
from ..sources import readers, writers
from . import adapters as a
from .queries import _GTAB, _SHAPES, _gtab, _shapes
from .registry import query
from .scratch import scratch


def _written(df: DataFrame, name: str, *lines: Column) -> str:
    """The path of a new text folder; a row of ``df`` becomes the given lines."""
    path = scratch(df.sparkSession, name)
    df.select(F.concat_ws("\n", *lines).alias("value")).write.text(path)
    return path


def _line(*cells) -> Column:
    return F.concat_ws("\t", *[F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in cells])


def _spans(column: str) -> Column:
    return F.array_join(F.transform(column, lambda r: F.concat(r["first"].cast("string"), F.lit("-"), r["second"].cast("string"))), ",")


# ---- reads, counts and scores ----------------------------------------------------------------------------------------


@query("tab_file", f"WITH {a.READS} SELECT contig, strand, 'all' AS sample, CAST(CASE WHEN split THEN 2 ELSE 1 END AS BIGINT) AS blocks, s1 AS first, CAST(e1 + CASE WHEN split THEN 200 ELSE 0 END AS BIGINT) AS second FROM reads")
def _tab(spark, d):
    path = scratch(spark, "tab")
    writers.write_tab(a.reads(spark, d), path)
    last = F.element_at("regions", -1)["second"]
    return readers.read_tab(spark, path, "all").select("contig", "strand", "sample", F.size("regions").cast("long").alias("blocks"), F.element_at("regions", 1)["first"].alias("first"), last.alias("second"))


# the format writes null as -1, so a score of -1 is read as null
@query("gtab_file", f"WITH {_GTAB} SELECT contig, strand, pos, rt AS n_rt, bd AS n_bd, nullif(round(shape, 6), -1) AS shape FROM gtab")
def _gtab_file(spark, d):
    path = scratch(spark, "gtab")
    writers.write_gtab(_gtab(spark, d).withColumnsRenamed({"rt": "n_rt", "bd": "n_bd"}), path)
    return readers.read_gtab(spark, path).withColumn("shape", F.round("shape", 6))


@query("bedgraph_file", f"WITH {_SHAPES} SELECT 'score' AS track, 'plus' AS sign, transcript_id || chr(9) || (i - 1) || chr(9) || i || chr(9) || printf('%.3f', x) AS line FROM sv WHERE x IS NOT NULL")
def _bedgraph_file(spark, d):
    path = scratch(spark, "bedgraph")
    rows = tracks.shape_text_bedgraph(_shapes(spark, d)).withColumn("track", F.lit("score")).withColumn("strand", F.lit("+"))
    writers.write_bedgraph(rows, path)
    return spark.read.text(path).select("track", "sign", F.col("value").alias("line"))


@query("shape_file", f"WITH {_SHAPES} SELECT transcript_id, CAST(70 AS BIGINT) AS length, CAST(i AS BIGINT) AS pos, round(x, 6) AS score FROM sv")
def _shape_file(spark, d):
    path = scratch(spark, "shape")
    writers.write_shape(_shapes(spark, d), path)
    rows = readers.read_shape(spark, path).select("transcript_id", "length", F.posexplode("scores").alias("i", "score"))
    return rows.select("transcript_id", "length", (F.col("i") + 1).cast("long").alias("pos"), F.round("score", 6).alias("score"))


_QUAL = "array_to_string(list_transform(range(1, length(seq) + 1), lambda i: chr(CAST(73 - i // 3 - (i * 7 + id) % 11 AS INTEGER))), '')"


@query("fastq_file", f"WITH {a.FASTQ} SELECT key, seq, '+x' AS tag, {_QUAL} AS qual FROM fq")
def _fastq_file(spark, d):
    path = scratch(spark, "fastq")
    writers.write_fastq(a.fastq(spark, d).select("key", "seq", "tag", "qual"), path)
    return readers.read_fastq(spark, path).select("key", "seq", "tag", "qual")


@query("barcode_files", f"WITH {a.FASTQ} SELECT 'lib' || substr(seq || 'NN', 1, 2) AS library, unnest([key, seq, '+x', {_QUAL}]) AS line FROM fq")
def _barcode_files(spark, d):
    path = scratch(spark, "barcode")
    library = F.concat(F.lit("lib"), F.substring(F.concat("seq", F.lit("NN")), 1, 2))
    writers.write_by_barcode(a.fastq(spark, d).withColumn("library", library), path)
    return spark.read.text(path).select("library", F.col("value").alias("line"))


@query("fasta_file", f"WITH {a.FASTQ} SELECT 's' || doc_id AS id, 'words of ' || doc_id AS annotation, s AS seq FROM letters")
def _fasta_file(spark, d):
    path = scratch(spark, "fasta")
    rows = a.letters(spark, d).select(F.concat(F.lit("s"), "doc_id").alias("id"), F.concat(F.lit("words of "), "doc_id").alias("annotation"), "seq")
    writers.write_fasta(rows, path)
    return readers.read_fasta(spark, path)


@query(
    "sam_file",
    f"""WITH {a.SAM}, {a.READ_SAM} SELECT read_id, CAST(flag AS INTEGER) AS flag, chr_id, pos, CAST(255 AS INTEGER) AS mapq, cigar, '=' AS rnext, pos AS pnext, CAST(0 AS BIGINT) AS tlen, seq, qual, md, 'B:c,' || jm AS jm FROM rs""",
)
def _sam_file(spark, d):
    tag = lambda k: F.element_at("tags", k)
    path = _written(
        a.read_sam(spark, d), "sam",
        _line("read_id", "flag", "chr_id", "pos", "mapq", "cigar", "rnext", "pos", F.lit(0), "seq", "qual", F.concat(F.lit("MD:Z:"), tag("MD")), F.concat(F.lit("jM:"), tag("jM"))),
    )
    return readers.read_sam(spark, path).withColumn("md", tag("MD")).withColumn("jm", tag("jM")).drop("tags")


@query("sam_header_file", f"WITH {a.SAM} SELECT chr_id AS contig, max(pos) AS length FROM cig GROUP BY 1")
def _sam_header_file(spark, d):
    sizes = a.sam(spark, d).groupBy("chr_id").agg(F.max("pos").alias("length"))
    return readers.read_sam_header(spark, _written(sizes, "header", _line(F.lit("@SQ"), F.concat(F.lit("SN:"), "chr_id"), F.concat(F.lit("LN:"), "length")), F.lit("@CO\tSN:none\tLN:1")))


@query("junction_file", f"WITH {a.JUNCTIONS}, sizes AS (SELECT contig, max(second) - 5 AS length FROM blocks GROUP BY contig) SELECT contig, j.first, j.second, strand FROM junctions j JOIN sizes USING (contig) WHERE length > j.second")
def _junction_file(spark, d):
    lengths = a.reads(spark, d).select("contig", F.inline("regions")).groupBy("contig").agg((F.max("second") - 5).alias("length"))
    known = readers.read_chr_size(spark, _written(lengths, "sizes", _line("contig", "length")))
    return readers.read_junctions(spark, _written(a.junctions(spark, d), "junctions", _line("contig", "first", "second", "strand")), known).select("contig", "first", "second", "strand")


@query("dh_file", f"WITH {a.HANGS} SELECT read_id, chr_1, strand_1, CAST(NULL AS INTEGER) AS flag_1, '*' AS cigar_1, start_1, end_1, chr_2, strand_2, CAST(NULL AS INTEGER) AS flag_2, '*' AS cigar_2, start_2, end_2 FROM hangs")
def _dh_file(spark, d):
    path = scratch(spark, "dh")
    writers.write_dh(a.hangs(spark, d), path)
    return readers.read_dh(spark, path)


@query("matrix_file", "WITH c AS (SELECT row_number() OVER (ORDER BY p_partkey) - 1 AS x, p_partkey, p_size FROM part), v AS (SELECT x, unnest(range(0, 20)) AS y, p_partkey, p_size FROM c) SELECT CAST(x AS BIGINT) AS x, CAST(y AS BIGINT) AS y, CAST((p_partkey * y + p_size) % 7 AS DOUBLE) AS value FROM v WHERE (p_partkey * y + p_size) % 7 <> 0")
def _matrix_file(spark, d):
    cells = F.transform(F.sequence(F.lit(0), F.lit(19)), lambda y: ((F.col("p_partkey") * y + F.col("p_size")) % 7).cast("string"))
    return readers.read_matrix(spark, _written(a.table(spark, d, "part").orderBy("p_partkey"), "matrix", F.array_join(cells, " ")))


@query("accessibility_file", "SELECT 't' || p_partkey AS id, CAST(p_size AS INTEGER) AS pos, substr('ACGU', CAST(p_size % 4 AS INTEGER) + 1, 1) AS base, CASE WHEN p_size % 5 <> 0 THEN p_size / CAST(4 AS DOUBLE) END AS value FROM part")
def _accessibility(spark, d):
    base = F.substring(F.lit("ACGU"), (F.col("p_size") % 4 + 1).cast("int"), F.lit(1))
    value = F.when(F.col("p_size") % 5 != 0, (F.col("p_size") / 4.0).cast("string")).otherwise("NULL")
    return readers.read_accessibility(spark, _written(a.table(spark, d, "part"), "access", F.lit("#id"), _line(F.concat(F.lit("t"), "p_partkey"), "p_size", base, value)))


@query("fpkm_file", "SELECT 't' || l_partkey AS transcript_id, round(avg(CAST(l_quantity AS DOUBLE)), 6) AS fpkm FROM lineitem WHERE l_linenumber <> 2 GROUP BY 1")
def _fpkm(spark, d):
    state = F.when(F.col("l_linenumber") == 2, "LOWDATA").otherwise("OK")
    blank = [F.lit("-")] * 8
    path = _written(a.table(spark, d, "lineitem"), "fpkm", _line(F.concat(F.lit("t"), "l_partkey"), *blank, F.col("l_quantity").cast("double"), F.lit(0), F.lit(0), state))
    return readers.read_fpkm(spark, [path]).withColumn("fpkm", F.round("fpkm", 6))


# ---- annotation ------------------------------------------------------------------------------------------------------


_UTR = """s AS (SELECT contig, min(first) AS first, max(second) AS second, strand, gene_id, transcript_id, type, CAST(count(*) AS BIGINT) AS n FROM ex GROUP BY ALL),
u AS (SELECT *, CASE WHEN type <> 'mRNA' THEN '' WHEN strand = '+' THEN first || '-' || (first + 4) || ',' || (second - 4) || '-' || second ELSE (second - 4) || '-' || second || ',' || first || '-' || (first + 4) END AS utr FROM s)"""


def _features(spark, d) -> DataFrame:
    """Exons, and for an mRNA two pieces of a CDS that leaves five bases at both ends: feature, first, second, with the transcript's columns."""
    exons = F.transform("exons", lambda e: F.struct(F.lit("exon").alias("feature"), e["first"].alias("first"), e["second"].alias("second")))
    lo, hi = F.element_at("exons", 1)["first"] + 5, F.element_at("exons", -1)["second"] - 5
    cds = F.array(*[F.struct(F.lit("CDS").alias("feature"), x.alias("first"), y.alias("second")) for x, y in ((lo, lo + 2), (hi - 2, hi))])
    return a.transcripts(spark, d).select("contig", "strand", "gene_id", "transcript_id", "type", F.inline(F.when(F.col("type") == "mRNA", F.concat(exons, cds)).otherwise(exons)))


def _shown(rows: DataFrame) -> DataFrame:
    return rows.withColumn("exons", F.size("exons").cast("long")).withColumn("utr", _spans("utr"))


@query("gtf_to_genome_coor", f"WITH {a.TRANSCRIPTS}, {_UTR} SELECT contig, first, second, strand, gene_id, 'NULL' AS gene_name, transcript_id, type, n AS exons, utr FROM u")
def _gtf(spark, d):
    text = F.concat(F.lit('gene_id "'), "gene_id", F.lit('"; transcript_id "none"; transcript_id "'), "transcript_id", F.lit('"; transcript_biotype "'), "type", F.lit('";'))
    dot = F.lit(".")
    path = _written(_features(spark, d), "gtf", F.lit("#!build"), _line("contig", F.lit("x"), "feature", "first", "second", dot, "strand", dot, text))
    return _shown(annotation.gtf_to_genome_coor(readers.read_gtf(spark, path)))


@query("gff3_to_genome_coor", f"WITH {a.TRANSCRIPTS}, {_UTR} SELECT 'chr' || substr(contig, 2) AS contig, first, second, strand, substr(transcript_id, 2) AS gene_id, transcript_id AS gene_name, transcript_id, CASE WHEN type = 'mRNA' THEN 'mRNA' ELSE 'ncRNA' END AS type, n AS exons, utr FROM u")
def _gff3(spark, d):
    t = a.transcripts(spark, d)
    here = F.concat(F.lit("NC_"), F.substring("contig", 2, 9))
    dot, rna, gene = F.lit("."), F.concat(F.lit("ID=rna-"), "transcript_id"), F.concat(F.lit("gene-"), "gene_id")
    row = lambda kind, first, second, *text: _line(here, F.lit("x"), kind, first, second, dot, "strand", dot, F.concat(*text))
    top = t.groupBy("contig", "strand", "gene_id").agg(F.min(F.element_at("exons", 1)["first"]).alias("first"), F.max(F.element_at("exons", -1)["second"]).alias("second"))
    lines = [
        top.select(row(F.lit("gene"), "first", "second", F.lit("ID="), gene, F.lit(";gene_biotype=ncRNA;gene="), "gene_id").alias("value")),
        t.select(row(F.lit("transcript"), F.element_at("exons", 1)["first"], F.element_at("exons", -1)["second"], rna, F.lit(";Parent="), gene, F.lit(";Name="), "transcript_id", F.lit(";Dbxref=GeneID:"), F.substring("transcript_id", 2, 20), F.lit(",Other:1")).alias("value")),
        _features(spark, d).select(row("feature", "first", "second", F.lit("Parent=rna-"), "transcript_id").alias("value")),
        t.select("contig", F.lit("+").alias("strand")).distinct().select(row(F.lit("region"), F.lit(1), F.lit(9), F.lit("ID=region-"), "contig", F.lit(";chromosome="), F.substring("contig", 2, 9)).alias("value")),
    ]
    path = scratch(spark, "gff3")
    for part in lines:
        part.write.mode("append").text(path)
    return _shown(annotation.gff3_to_genome_coor(readers.read_gff3(spark, path)))


def _bed(spark, d) -> DataFrame:
    """The annotation of ``_UTR`` written in the tool's own format and read again."""
    first, second = F.element_at("exons", 1)["first"], F.element_at("exons", -1)["second"]
    span = lambda x, y: F.concat(x.cast("string"), F.lit("-"), y.cast("string"))
    low, high = span(first, first + 4), span(second - 4, second)
    utr = F.when(F.col("type") != "mRNA", "").when(F.col("strand") == "+", F.concat_ws(",", low, high)).otherwise(F.concat_ws(",", high, low))
    path = _written(a.transcripts(spark, d), "bed", _line("contig", first, second, "strand", F.concat(F.lit("n="), "gene_id", F.lit(".2")), F.concat("transcript_id", F.lit(".1")), "type", _spans("exons"), utr))
    return readers.read_genome_coor(spark, path, rem_tver=True, rem_gver=True)


@query("transcript_features", f"""WITH {a.TRANSCRIPTS}, {_UTR}, l AS (SELECT transcript_id, CAST(sum(second - first + 1) AS BIGINT) AS length FROM ex GROUP BY 1)
    SELECT contig, first, second, strand, 'n' AS gene_name, gene_id, u.transcript_id, type, length, {', '.join(f"CASE WHEN type = 'mRNA' THEN CAST({x} AS BIGINT) END AS {n}" for n, x in (('utr_5_start', '1'), ('utr_5_end', '5'), ('cds_start', '6'), ('cds_end', 'length - 5'), ('utr_3_start', 'length - 4'), ('utr_3_end', 'length')))}
    FROM u JOIN l ON u.transcript_id = l.transcript_id""")
def _transcript_features(spark, d):
    return annotation.transcript_features(_bed(spark, d)).drop("exons", "utr")


@query("genome_coor_to_trans_coor", f"""WITH {a.TRANSCRIPTS}, l AS (SELECT transcript_id, gene_id, type, max(t_second) AS length, string_agg(t_first || '-' || t_second, ',' ORDER BY t_first) AS exons FROM exons GROUP BY ALL)
    SELECT transcript_id, gene_id, type, length, exons, CASE WHEN type = 'mRNA' THEN '1-5,' || (length - 4) || '-' || length ELSE '' END AS utr FROM l""")
def _trans_coor(spark, d):
    return annotation.genome_coor_to_trans_coor(_bed(spark, d))


# ---- transcript-wise files and structures ----------------------------------------------------------------------------


_RT_FILE = """rf AS (SELECT 't' || p_partkey AS transcript_id, CAST(p_size AS VARCHAR) AS rpkm, i, CAST((p_partkey + i) % 5 AS DOUBLE) AS bd, CAST((p_partkey * i + p_size) % 3 AS DOUBLE) AS rt FROM (SELECT *, unnest(range(0, 13)) AS i FROM part))"""


def _rt_values(spark, d) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")
    values = lambda f: F.transform(F.sequence(F.lit(0), F.lit(12)), f)
    return a.table(spark, d, "part").select(F.concat(F.lit("t"), "p_partkey").alias("transcript_id"), F.lit(12).alias("length"), size.alias("rpkm"), values(lambda i: (key + i) % 5).alias("bd"), values(lambda i: (key * i + size) % 3).alias("rt"))


def _rt_rows(spark, d) -> DataFrame:
    tail = lambda c: F.array_join(c, "\t")
    return readers.read_rt_file(spark, _written(_rt_values(spark, d), "rt", *[F.concat_ws("\t", "transcript_id", F.col("length").cast("string"), F.col("rpkm").cast("string"), tail(c)) for c in ("bd", "rt")]))


@query("rt_file", f"WITH {_RT_FILE} SELECT transcript_id, CAST(12 AS BIGINT) AS length, rpkm, CAST(i AS BIGINT) AS pos, bd, rt FROM rf")
def _rt_file(spark, d):
    rows = _rt_rows(spark, d).select("transcript_id", "length", "rpkm", F.posexplode(F.arrays_zip("bd", "rt")).alias("pos", "x"))
    return rows.select("transcript_id", "length", "rpkm", F.col("pos").cast("long").alias("pos"), "x.bd", "x.rt")


@query("combine_replicates", f"WITH {_RT_FILE} SELECT transcript_id, CAST(12 AS BIGINT) AS length, rpkm || ',' || rpkm AS rpkm, CAST(i AS BIGINT) AS pos, bd + rt AS bd, 2 * rt AS rt FROM rf")
def _combine_replicates(spark, d):
    one = _rt_rows(spark, d)
    two = one.withColumn("bd", F.col("rt"))
    rows = tracks.combine_replicates(one.withColumn("replicate", F.lit(1)).unionByName(two.withColumn("replicate", F.lit(2))))
    rows = rows.select("transcript_id", "length", "rpkm", F.posexplode(F.arrays_zip("bd", "rt")).alias("pos", "x"))
    return rows.select("transcript_id", "length", "rpkm", F.col("pos").cast("long").alias("pos"), "x.bd", "x.rt")


@query("rt_bedgraph", f"""WITH {_RT_FILE}, n AS (SELECT transcript_id, i, unnest(['baseDensity', 'RTstop']) AS track, unnest([floor(bd * CAST(rpkm AS DOUBLE) / 20 + 0.5), rt]) AS value, unnest([bd, rt]) AS raw FROM rf WHERE i > 0)
    SELECT track, transcript_id AS contig, CAST(i AS BIGINT) AS pos, value FROM n WHERE raw <> 0""")
def _rt_bedgraph(spark, d):
    scaling = (F.col("rpkm") * 5).cast("double")
    row = lambda kind, c: F.concat_ws("\t", "transcript_id", F.lit("12"), F.lit(kind), F.col("rpkm").cast("string"), scaling.cast("string"), F.array_join(F.transform(F.slice(c, 2, 12), lambda x: x.cast("double").cast("string")), "\t"))
    return tracks.rt_bedgraph(readers.read_rt_file(spark, _written(_rt_values(spark, d), "normalized", row("baseDensity", "bd"), row("RTstop", "rt")), "normalized"))


_DOTS = """ds AS (SELECT 't' || p_partkey AS id, CAST(p_size % 10 + 3 AS BIGINT) AS k, CAST(p_partkey % 5 AS BIGINT) AS tail, p_partkey FROM part),
dp AS (SELECT id, i AS a, 2 * k + 4 - i AS b FROM (SELECT *, unnest(range(1, k + 1)) AS i FROM ds)),
db AS (SELECT id, i, 2 * k + 3 + tail AS n, k, substr('ACGTU', CAST((i * 7 + p_partkey) % 5 AS INTEGER) + 1, 1) AS base FROM (SELECT *, unnest(range(1, 2 * k + 4 + tail)) AS i FROM ds))"""


def _dots(spark, d) -> DataFrame:
    k, tail = (F.col("p_size") % 10 + 3).cast("int"), (F.col("p_partkey") % 5).cast("int")
    dot = F.concat(F.repeat(F.lit("("), k), F.lit("..."), F.repeat(F.lit(")"), k), F.repeat(F.lit("."), tail))
    bases = F.array_join(F.transform(F.sequence(F.lit(1), 2 * k + 3 + tail), lambda i: F.substring(F.lit("ACGTU"), ((i * 7 + F.col("p_partkey")) % 5 + 1).cast("int"), F.lit(1))), "")
    return readers.read_dot(spark, _written(a.table(spark, d, "part"), "dot", F.concat(F.lit(">t"), "p_partkey", F.lit(" fold")), bases, dot))


def _paired(spark, d) -> DataFrame:
    return _dots(spark, d).withColumn("pairs", sequence.dotbracket_pairs("dot"))


@query("dotbracket_pairs", f"WITH {_DOTS} SELECT id, a, b, TRUE AS same FROM dp")
def _dot_pairs(spark, d):
    again = sequence.pairs_to_dotbracket(F.col("pairs"), F.length("seq")) == F.col("dot")
    return _paired(spark, d).select("id", F.inline("pairs"), again.alias("same")).select("id", F.col("left").cast("long").alias("a"), F.col("right").cast("long").alias("b"), "same")


@query("pairs_to_ct", f"WITH {_DOTS} SELECT id, i AS pos, base, i - 1 AS before, CASE WHEN i = n THEN 0 ELSE i + 1 END AS after, CASE WHEN i <= k OR i BETWEEN k + 4 AND 2 * k + 3 THEN 2 * k + 4 - i ELSE 0 END AS mate, i AS pos_again FROM db")
def _ct(spark, d):
    rows = sequence.pairs_to_ct(_paired(spark, d))
    return rows.select("id", "base", *[F.col(c).cast("long").alias(c) for c in ("pos", "before", "after", "mate", "pos_again")])


@query("tt_crosslinks", f"""WITH {_DOTS}, o AS (SELECT id, a + unnest([0, 0, 1, -1]) AS x, b + unnest([1, -1, 0, 0]) AS y FROM dp)
    SELECT DISTINCT o.id, x, y FROM o JOIN db p ON o.id = p.id AND x = p.i AND p.base IN ('T', 'U') JOIN db q ON o.id = q.id AND y = q.i AND q.base IN ('T', 'U') WHERE x < y""")
def _crosslinks(spark, d):
    return sequence.tt_crosslinks(_paired(spark, d)).select("id", F.col("x").cast("long").alias("x"), F.col("y").cast("long").alias("y"))


@query("stockholm_file", "SELECT 't' || p_partkey AS id, 'part ' || p_size AS note, repeat('AC-G', CAST(p_size % 6 + 1 AS INTEGER)) || repeat('U.', CAST(p_partkey % 4 + 1 AS INTEGER)) AS aligned FROM part UNION ALL SELECT 'SS_cons', NULL, '<<..>>'")
def _stockholm(spark, d):
    """A family of all parts in two blocks, with notes and a consensus line."""
    rows = a.table(spark, d, "part").select(F.concat(F.lit("t"), "p_partkey").alias("id"), "p_partkey", "p_size")
    lines = [
        F.concat(F.lit("#=GS "), "id", F.lit(" DE part "), F.col("p_size").cast("string")),
        F.concat("id", F.lit("   "), F.repeat(F.lit("AC-G"), (F.col("p_size") % 6 + 1).cast("int"))),
        F.concat("id", F.lit("   "), F.repeat(F.lit("U."), (F.col("p_partkey") % 4 + 1).cast("int"))),
    ]
    path = _written(rows, "stockholm", *lines)
    spark.range(1).select(F.lit("# STOCKHOLM 1.0\n#=GC SS_cons  <<..>>\n//").alias("value")).write.mode("append").text(path)
    return readers.read_stockholm(spark, path)
