"""More registered queries: CIGAR strings, sequences, transcripts and matrices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import cigar, sequence
from ..operators import annotation, coords, matrix, qc, reads, tracks
from . import adapters as a
from .queries import _COMPRESSED, _GENES, _GTAB, _MATRIX, _SHAPES, _compress, _coo, _exons, _gtab, _packed, _shapes
from .registry import query

# ---- CIGAR strings ---------------------------------------------------------------------------------------------------


@query(
    "cigar_local_regions",
    f"""WITH {a.SAM}, b AS (SELECT read_id, line, unnest(CASE line WHEN 2 THEN [6] WHEN 4 THEN [1, q + 3] ELSE [1] END) AS first, unnest(CASE line WHEN 1 THEN [q] WHEN 2 THEN [q + 5] WHEN 4 THEN [q, 2 * q + 2] ELSE [2 * q] END) AS second FROM cig)
    SELECT read_id, line, CAST(first AS BIGINT) AS first, CAST(second AS BIGINT) AS second FROM b""",
)
def _local_regions(spark, d):
    return a.sam(spark, d).select("read_id", "line", F.inline(cigar.cigar_local_regions("cigar")))


@query("cigar_split", f"WITH {a.SAM}, s AS (SELECT read_id, line, unnest(regexp_extract_all(cigar, '[0-9]+[A-Z]')) AS x FROM cig) SELECT read_id, line, CAST(x[:-2] AS BIGINT) AS len, x[-1] AS op FROM s")
def _cigar_split(spark, d):
    return a.sam(spark, d).select("read_id", "line", F.inline(cigar.cigar_split("cigar")))


def _over(op: str, first: str, second: str) -> str:
    """The part of a block of read places that lies in 3..40, as CIGAR text in SQL."""
    return f"CASE WHEN least(40, {second}) >= greatest(3, {first}) THEN (least(40, {second}) - greatest(3, {first}) + 1) || '{op}' ELSE '' END"


@query(
    "cigar_region",
    f"""WITH {a.SAM} SELECT read_id, line, CASE line WHEN 1 THEN {_over('M', '1', 'q')} WHEN 2 THEN {_over('S', '1', '5')} || {_over('M', '6', 'q + 5')} WHEN 3 THEN {_over('M', '1', 'q')} || {_over('M', 'q + 1', '2 * q')}
      WHEN 4 THEN {_over('M', '1', 'q')} || {_over('I', 'q + 1', 'q + 2')} || {_over('M', 'q + 3', '2 * q + 2')}
      ELSE {_over('M', '1', 'q')} || CASE WHEN q + 1 BETWEEN 3 AND 40 THEN '1D' ELSE '' END || {_over('M', 'q + 1', '2 * q')} || {_over('S', '2 * q + 1', '2 * q + 3')} END AS part,
      CASE line WHEN 2 THEN q || 'M' WHEN 1 THEN cigar WHEN 3 THEN cigar WHEN 4 THEN cigar ELSE q || 'M1D' || q || 'M' END AS match, '2I' || cigar AS trimmed, CAST(line AS BIGINT) AS removed FROM cig""",
)
def _cigar_region(spark, d):
    trimmed = cigar.cigar_trim_deletions(F.concat(F.col("line").cast("string"), F.lit("D2I"), "cigar"), "left")
    return a.sam(spark, d).select("read_id", "line", cigar.cigar_region("cigar", 3, 40).alias("part"), cigar.cigar_match("cigar").alias("match"), trimmed["cigar"].alias("trimmed"), trimmed["removed"].alias("removed"))


_LONG_READS = """lr AS (SELECT row_number() OVER () AS k, * FROM cig), bl AS (
  SELECT k, chr_id, pos AS g, CASE line WHEN 2 THEN 6 ELSE 1 END AS r, q AS n, pos AS start FROM lr
  UNION ALL SELECT k, chr_id, pos + q + CASE line WHEN 3 THEN 100 WHEN 4 THEN 0 ELSE 1 END, q + CASE line WHEN 4 THEN 3 ELSE 1 END, q, pos FROM lr WHERE line > 2),
ba AS (SELECT k, substr('ACGTTGCAAC', CAST((g + i - 1) % 10 AS INTEGER) + 1, 1) AS theirs, substr('ACGTTGCANC', CAST((start % 7 + r + i - 1) % 10 AS INTEGER) + 1, 1) AS mine FROM (SELECT *, unnest(range(0, n)) AS i FROM bl))"""


@query("mismatch_count", f"WITH {a.SAM}, {_LONG_READS}, m AS (SELECT k, count(*) FILTER (mine <> theirs) AS n FROM ba GROUP BY k) SELECT read_id, line, pos, CAST(coalesce(n, 0) AS VARCHAR) AS mm FROM lr LEFT JOIN m ON lr.k = m.k")
def _mismatch(spark, d):
    n = F.aggregate(F.transform(F.regexp_extract_all("cigar", F.lit(r"(\d+)[MIS]"), F.lit(1)), lambda x: x.cast("int")), F.lit(0), lambda s, x: s + x)
    rows = a.sam(spark, d).withColumn("seq", F.substring(F.repeat(F.lit("ACGTTGCANC"), 20), F.pmod("pos", F.lit(7)).cast("int") + 1, n))
    marked = reads.mismatch_count(rows, _genome(rows.select(F.col("chr_id").alias("contig"), (F.col("pos") + 300).alias("p"))), tile=1000)
    return marked.select("read_id", "line", "pos", F.element_at("tags", "MM").alias("mm"))


def _genome(places: DataFrame, tile: int = 1000) -> DataFrame:
    """Tiles of a genome of repeated letters that reaches to the last place (contig, p) of each contig."""
    ends = places.groupBy("contig").agg(F.max("p").alias("p"))
    return ends.select("contig", F.explode(F.expr(f"sequence(0L, cast(floor((p - 1) / {tile}) as bigint))")).alias("tile"), F.repeat(F.lit("ACGTTGCAAC"), tile // 10).alias("seq"))


# ---- transcripts -----------------------------------------------------------------------------------------------------


_MRNA = """mrna AS (SELECT e.transcript_id, type, max(t_second) AS length, CAST(7 AS BIGINT) AS cds_start, max(t_second) - 9 AS cds_end FROM exons e GROUP BY ALL)"""
_SEQS = """sq AS (SELECT transcript_id, t_first + CASE WHEN strand = '+' THEN p - first ELSE second - p END AS t, CASE WHEN strand = '+' THEN substr('ACGTTGCAAC', CAST((p - 1) % 10 AS INTEGER) + 1, 1) ELSE substr('TGCAACGTTG', CAST((p - 1) % 10 AS INTEGER) + 1, 1) END AS base FROM (SELECT *, unnest(range(first, second + 1)) AS p FROM exons)),
seqs AS (SELECT transcript_id, string_agg(base, '' ORDER BY t) AS seq FROM sq GROUP BY 1)"""


def _transcriptome(spark, d) -> DataFrame:
    t = a.transcripts(spark, d)
    return annotation.build_transcriptome(t, _genome(t.select("contig", F.element_at("exons", -1)["second"].alias("p"))), 1000)


@query("build_transcriptome", f"WITH {a.TRANSCRIPTS}, {_SEQS} SELECT transcript_id, seq FROM seqs")
def _build(spark, d):
    return _transcriptome(spark, d)


@query(
    "codon_check",
    f"""WITH {a.TRANSCRIPTS}, {_MRNA}, {_SEQS}, o AS (SELECT off, seq, length, cds_start + off AS s, cds_end - 2 + off AS e FROM mrna JOIN seqs USING (transcript_id), (SELECT unnest([-3, 0, 3]) AS off))
    SELECT CAST(off AS INTEGER) AS "offset", count(*) FILTER (s >= 1 AND s + 2 <= length AND substr(seq, s, 3) = 'ATG') AS starts, count(*) FILTER (e >= 1 AND e + 2 <= length AND substr(seq, e, 3) IN ('TAA', 'TAG', 'TGA')) AS stops FROM o GROUP BY off""",
)
def _codons(spark, d):
    lengths = _exons(spark, d).groupBy("transcript_id").agg(F.max("t_second").alias("n"))
    return annotation.codon_check(lengths.select("transcript_id", F.lit(7).cast("long").alias("cds_start"), (F.col("n") - 9).alias("cds_end")), _transcriptome(spark, d))


@query("gene_trans_lists", f"WITH {a.TRANSCRIPTS} SELECT gene_id AS key, string_agg(transcript_id, ',' ORDER BY transcript_id) AS transcripts FROM tx WHERE type = 'mRNA' GROUP BY 1")
def _lists(spark, d):
    return annotation.gene_trans_lists(a.transcripts(spark, d), mrna_only=True).withColumn("transcripts", F.array_join("transcripts", ","))


@query("common_transcripts", f"WITH {a.TRANSCRIPTS} SELECT transcript_id, gene_id FROM tx WHERE transcript_id IN (SELECT 't' || l_partkey FROM lineitem WHERE l_quantity > 48)")
def _common(spark, d):
    seen = a.table(spark, d, "lineitem").where("l_quantity > 48").select(F.concat(F.lit("t"), "l_partkey").alias("transcript_id"))
    return qc.common_transcripts(a.transcripts(spark, d), seen).select("transcript_id", "gene_id")


@query(
    "rna_region_class",
    """WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey % 90 AS s, l_partkey % 90 + CAST(l_quantity AS BIGINT) - 2 AS e, CASE WHEN l_suppkey % 7 <> 0 THEN 30 END AS c0, 70 AS c1, 110 AS n, CASE l_suppkey % 5 WHEN 0 THEN 'tRNA' WHEN 1 THEN 'mRNA' ELSE 'protein_coding' END AS t FROM lineitem)
    SELECT l_orderkey, l_linenumber, CASE WHEN t = 'tRNA' THEN 'not_mRNA' WHEN s < 1 OR e > n OR s > e OR c0 IS NULL THEN 'INVALID' WHEN e < c0 THEN '5UTR' WHEN s < c0 AND e <= c1 THEN 'span_5UTR_CDS' WHEN s < c0 THEN 'span_5UTR_CDS_3UTR' WHEN e <= c1 THEN 'CDS' WHEN s <= c1 THEN 'span_CDS_3UTR' ELSE '3UTR' END AS class FROM r""",
)
def _region_class(spark, d):
    s = F.col("l_partkey") % 90
    kind = F.when(F.col("l_suppkey") % 5 == 0, "tRNA").when(F.col("l_suppkey") % 5 == 1, "mRNA").otherwise("protein_coding")
    found = sequence.rna_region_class(s, s + F.col("l_quantity").cast("long") - 2, F.when(F.col("l_suppkey") % 7 != 0, 30), F.lit(70), F.lit(110), kind)
    return a.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", found.alias("class"))


@query(
    "gene_to_transcript",
    f"""WITH {a.TRANSCRIPTS}, {_GENES}, p AS (SELECT gene_id, contig, strand, first AS a, second AS b FROM genes)
    SELECT p.gene_id, e.transcript_id, greatest(a, first) AS p_first, least(b, second) AS p_second, CASE WHEN e.strand = '+' THEN t_first + greatest(a, first) - first ELSE t_first + second - least(b, second) END AS t_first,
      CASE WHEN e.strand = '+' THEN t_first + greatest(a, first) - first ELSE t_first + second - least(b, second) END + least(b, second) - greatest(a, first) AS t_second FROM p JOIN exons e ON p.contig = e.contig AND p.strand = e.strand AND a <= second AND first <= b""",
)
def _gene_to_transcript(spark, d):
    genes = annotation.gene_table(a.transcripts(spark, d))
    spans = genes.select("gene_id", F.lit(1).cast("long").alias("g_first"), F.col("length").alias("g_second"))
    return coords.gene_to_transcript(spans, genes, _exons(spark, d)).select("gene_id", "transcript_id", "p_first", "p_second", "t_first", "t_second")


@query(
    "shape_contig_mode",
    f"""WITH {_GTAB}, p AS (SELECT contig, pos, rt, CASE WHEN bd >= 10 THEN shape END AS shape FROM gtab WHERE strand = '+' AND (rt >= 1 OR (bd >= 10 AND shape IS NOT NULL)))
    SELECT contig AS transcript_id, max(length) AS length, CAST(count(shape) AS BIGINT) AS n, floor(sum(shape) * 1e3 + 0.3137) / 1e3 AS total, round(sum(rt) / CAST(max(length) AS DOUBLE), 6) AS rt FROM p JOIN sizes USING (contig) GROUP BY contig HAVING count(shape) >= 3""",
)
def _contig_mode(spark, d):
    rows = coords.shape_contig_mode(_gtab(spark, d), a.sizes(a.reads(spark, d)), min_bd=10)
    good = F.filter("scores", lambda x: x.isNotNull())
    return rows.select("transcript_id", "length", F.size(good).cast("long").alias("n"), (F.floor(F.aggregate(good, F.lit(0.0), lambda s, x: s + x) * 1e3 + 0.3137) / 1e3).alias("total"), F.round("rt", 6).alias("rt"))


@query(
    "window_variability",
    """WITH v AS (SELECT l_orderkey, list(CAST(l_quantity AS DOUBLE) ORDER BY l_quantity) FILTER (l_suppkey % 3 <> 0) AS v FROM lineitem GROUP BY 1)
    SELECT l_orderkey, CASE WHEN len(v) < 5 THEN v[-1] - v[1] WHEN v IS NOT NULL THEN (v[-1] + v[-2]) / 2 - (v[1] + v[2]) / 2 END AS value FROM v""",
)
def _variability(spark, d):
    rows = a.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_suppkey") % 3 != 0, F.col("l_quantity").cast("double")).alias("x"))
    lists = rows.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "x"))).alias("v"))
    return lists.select("l_orderkey", tracks.window_variability(F.transform("v", lambda s: s["x"])).alias("value"))


# ---- scores against structures, the older pipeline -------------------------------------------------------------------


@query(
    "evaluate_structure",
    f"""WITH {_SHAPES}, s AS (SELECT 't' || p_partkey AS transcript_id, p_size % 20 + 5 AS k FROM part), q AS (SELECT transcript_id, i <= k OR i > 70 - k AS paired, least(greatest(ceil(round(x / 0.01, 9)), -1), 102) AS c FROM sv JOIN s USING (transcript_id) WHERE x IS NOT NULL),
    b AS (SELECT * FROM q UNION ALL SELECT NULL, paired, c FROM q), h AS (SELECT transcript_id, c, count(*) FILTER (paired) AS t, count(*) FILTER (NOT paired) AS f FROM b GROUP BY ALL),
    w AS (SELECT transcript_id, c, sum(t) OVER u AS tp, sum(f) OVER u AS fp, sum(t) OVER e AS p, sum(f) OVER e AS n FROM h WINDOW u AS (PARTITION BY transcript_id ORDER BY c), e AS (PARTITION BY transcript_id)),
    r AS (SELECT transcript_id, c, p, n, tp / CAST(p AS DOUBLE) AS tpr, fp / CAST(n AS DOUBLE) AS fpr FROM w WHERE p > 0 AND n > 0),
    z AS (SELECT transcript_id, p, n, (fpr - coalesce(lag(fpr) OVER o, 0)) * (tpr + coalesce(lag(tpr) OVER o, 0)) / 2 AS a FROM r WINDOW o AS (PARTITION BY transcript_id ORDER BY c))
    SELECT transcript_id, floor(sum(a) * 1e6 + 0.3137) / 1e6 AS auc, CAST(max(p) AS BIGINT) AS positives, CAST(max(n) AS BIGINT) AS negatives FROM z GROUP BY 1""",
)
def _evaluate(spark, d):
    k = (F.col("p_size") % 20 + 5).cast("int")
    dot = F.concat(F.repeat(F.lit("("), k), F.repeat(F.lit("."), 70 - 2 * k), F.repeat(F.lit(")"), k))
    dots = a.table(spark, d, "part").select(F.concat(F.lit("t"), "p_partkey").alias("id"), F.repeat(F.lit("ACGUA"), 14).alias("seq"), dot.alias("dot"))
    return qc.evaluate_structure(_shapes(spark, d), dots).select("transcript_id", (F.floor(F.col("auc") * 1e6 + 0.3137) / 1e6).alias("auc"), "positives", "negatives")


def _enriched_values(spark, d) -> DataFrame:
    """Joined foreground and background of each part, four values a place."""
    at = F.sequence(F.lit(1), F.lit(50))
    key, size = F.col("p_partkey"), F.col("p_size")
    value = F.transform(at, lambda i: F.struct(((key + i) % 11 / 10).alias("score"), ((key * i) % 7).cast("double").alias("fg_rt"), ((size * i) % 5).cast("double").alias("bg_rt"), ((key + size * i) % 500).cast("double").alias("bg_bd")))
    return a.table(spark, d, "part").select(F.concat(F.lit("t"), "p_partkey").alias("transcript_id"), F.lit(50).cast("long").alias("length"), F.concat(size.cast("string"), F.lit(","), (size + 1).cast("string"), F.lit(";9")).alias("rpkms"), value.alias("values"))


_VALUES = """ev AS (SELECT 't' || p_partkey AS transcript_id, p_size, i, (p_partkey + i) % 11 / CAST(10 AS DOUBLE) AS score, CAST((p_partkey * i) % 7 AS DOUBLE) AS fg_rt, CAST((p_size * i) % 5 AS DOUBLE) AS bg_rt, CAST((p_partkey + p_size * i) % 500 AS DOUBLE) AS bg_bd FROM (SELECT *, unnest(range(1, 51)) AS i FROM part))"""


@query("filter_enrich", f"WITH {_VALUES}, k AS (SELECT transcript_id FROM ev GROUP BY 1 HAVING avg(fg_rt) > 2) SELECT transcript_id, CAST(50 AS BIGINT) AS length, round((2 * p_size + 10) / CAST(3 AS DOUBLE), 6) AS fpkm, CAST(i AS BIGINT) AS pos, score FROM ev JOIN k USING (transcript_id) WHERE i > 5 AND i <= 20 AND bg_bd >= 200")
def _filter_enrich(spark, d):
    rows = tracks.filter_enrich(_enriched_values(spark, d)).select("transcript_id", "length", F.round("fpkm", 6).alias("fpkm"), F.posexplode("scores").alias("i", "score"))
    return rows.where("score is not null").select("transcript_id", "length", "fpkm", (F.col("i") + 1).cast("long").alias("pos"), "score")


@query("enrich_fg_bg_join", f"""WITH {_VALUES} SELECT transcript_id, CAST(50 AS BIGINT) AS length, (p_size || ',' || (p_size * 2)) AS rpkms, '4.0,6.0,8.0' AS scalings, CAST(i AS BIGINT) AS pos, score AS fg_bd, fg_rt, bg_bd, bg_rt FROM ev WHERE p_size % 3 <> 0""")
def _fg_bg(spark, d):
    rows = _enriched_values(spark, d).join(a.table(spark, d, "part").select(F.concat(F.lit("t"), "p_partkey").alias("transcript_id"), "p_size"), "transcript_id")

    def side(bd: str, rt: str, times: int) -> DataFrame:
        one = lambda kind, c, s: F.struct(F.lit(kind).alias("type"), F.lit(s * 1.0).alias("scaling"), F.transform("values", lambda v: v[c]).alias("values"))
        return rows.select("transcript_id", "length", (F.col("p_size") * times).cast("string").alias("rpkm"), "p_size", F.inline(F.array(one("baseDensity", bd, 3 * times), one("RTstop", rt, 4 * times))))

    joined = tracks.enrich_fg_bg_join(side("score", "fg_rt", 1), side("bg_bd", "bg_rt", 2).where("p_size % 3 <> 0"))
    flat = joined.select("transcript_id", "length", "rpkms", "scalings", F.posexplode(F.arrays_zip("fg_bd", "fg_rt", "bg_bd", "bg_rt")).alias("i", "x"))
    return flat.select("transcript_id", "length", "rpkms", "scalings", (F.col("i") + 1).cast("long").alias("pos"), "x.fg_bd", "x.fg_rt", "x.bg_bd", "x.bg_rt")


# ---- records and matrices --------------------------------------------------------------------------------------------


@query(
    "fasta_select",
    f"WITH {a.FASTQ} SELECT 's' || doc_id AS id, s AS seq FROM letters WHERE doc_id IN (SELECT doc_id FROM labels) AND doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1) AND regexp_matches('s' || doc_id, '[0-6]$') AND NOT regexp_matches('words of ' || doc_id, '2$')",
)
def _fasta_select(spark, d):
    rows = a.letters(spark, d).select(F.concat(F.lit("s"), "doc_id").alias("id"), F.concat(F.lit("words of "), "doc_id").alias("annotation"), "seq")
    labels = a.table(spark, d, "labels").withColumn("id", F.concat(F.lit("s"), "doc_id"))
    return reads.sort_fasta(reads.fasta_select(rows, labels, labels.where("toxic = 1"), keep_id_re="[0-6]$", drop_note_re="2$")).select("id", "seq")


@query("column_select", "SELECT l_orderkey, l_linenumber, l_orderkey || ',' || l_partkey || ',' || l_suppkey || ',' || l_linenumber AS selected FROM lineitem")
def _columns(spark, d):
    rows = a.table(spark, d, "lineitem").select("l_orderkey", "l_returnflag", "l_partkey", "l_suppkey", "l_linenumber")
    return reads.column_select(rows, "1,3-5").select("l_orderkey", "l_linenumber", "selected")


@query(
    "matrix_normalize",
    f"""WITH {_MATRIX}, r AS (SELECT value, row_number() OVER (ORDER BY value) - 1 AS place, count(*) OVER () AS n FROM coo WHERE value > 0),
    b AS (SELECT max(CASE WHEN place = least(CAST(floor(n * CAST(0.01 AS DOUBLE)) AS BIGINT), n - 1) THEN value END) AS lo, max(CASE WHEN place = least(CAST(floor(n * CAST(0.999 AS DOUBLE)) AS BIGINT), n - 1) THEN value END) AS hi FROM r)
    SELECT contig, strand, x, y, CASE WHEN value > hi THEN CAST(1 AS DOUBLE) WHEN value > lo THEN round((value - lo) / (hi - lo), 6) END AS value FROM coo, b""",
)
def _normalize(spark, d):
    return matrix.matrix_normalize(_coo(spark, d), upper=0.999).withColumn("value", F.round("value", 6))


@query(
    "matrix_mask_noncanonical",
    f"""WITH {_MATRIX}, t AS (SELECT *, substr('ACGUUGCAAC', CAST((x - 1) % 10 AS INTEGER) + 1, 1) || substr('ACGUUGCAAC', CAST((y - 1) % 10 AS INTEGER) + 1, 1) AS two FROM coo)
    SELECT contig, strand, x, y, CASE WHEN two IN ('AU', 'UA', 'GC', 'CG', 'GU', 'UG') THEN value END AS value FROM t""",
)
def _noncanonical(spark, d):
    coo = _packed(spark, d)
    seqs = matrix.cells(coo).groupBy("contig").agg(F.expr("repeat('ACGTTGCAAC', cast(floor(max(x) / 10) + 1 as int))").alias("seq"))
    return matrix.matrix_mask_noncanonical(coo, seqs).select("contig", "strand", "x", "y", "value")


@query("matrix_expand", f"WITH {_MATRIX} SELECT contig, strand, CAST(x + (x - 1) // 9 AS BIGINT) AS x, CAST(y + (y - 1) // 9 AS BIGINT) AS y, value FROM coo")
def _expand(spark, d):
    coo = _packed(spark, d)
    aligned = matrix.cells(coo).groupBy(F.col("contig").alias("id")).agg(F.expr("repeat('ACGTACGTA-', cast(floor(max(x) / 9) + 1 as int))").alias("aligned"))
    return matrix.matrix_expand(coo, matrix.alignment_coords(aligned))


@query("alignment_coords", "WITH c AS (SELECT p_partkey, unnest(range(1, p_size + 21)) AS i FROM part) SELECT 't' || p_partkey AS id, row_number() OVER (PARTITION BY p_partkey ORDER BY i) AS raw_pos, CAST(i AS BIGINT) AS aln_pos FROM c WHERE (i + p_partkey) % 4 NOT IN (0, 1)")
def _alignment(spark, d):
    sign = lambda i: F.when((i + F.col("p_partkey")) % 4 == 0, "-").when((i + F.col("p_partkey")) % 4 == 1, ".").otherwise("C")
    return matrix.alignment_coords(a.table(spark, d, "part").select(F.concat(F.lit("t"), "p_partkey").alias("id"), F.array_join(F.transform(F.sequence(F.lit(1), (F.col("p_size") + 20).cast("int")), sign), "").alias("aligned")))


@query(
    "matrix_mask_gaps",
    f"""WITH {_COMPRESSED}, p AS (SELECT contig, n, unnest(range(1, CAST(n AS BIGINT) + 1)) AS i FROM s), f AS (SELECT contig, CAST(floor((i - 1) * 40 / n) AS BIGINT) + 1 AS b FROM p WHERE (i - 1) // 900 % 3 <> 1 GROUP BY contig, 2, n HAVING count(*) * 40 / n >= 0.25)
    SELECT m.contig, strand, x, y, CASE WHEN u.b IS NOT NULL AND v.b IS NOT NULL THEN value END AS value FROM (SELECT contig, strand, x, y, sum(value) AS value FROM b GROUP BY ALL) m LEFT JOIN f u ON m.contig = u.contig AND x = u.b LEFT JOIN f v ON m.contig = v.contig AND y = v.b""",
)
def _mask_gaps(spark, d):
    lengths = _coo(spark, d).groupBy(F.col("contig").alias("id")).agg(F.max("x").alias("n"))
    places = lengths.select("id", F.explode(F.expr("sequence(1L, n)")).alias("aln_pos")).where("(aln_pos - 1) div 900 % 3 <> 1")
    return matrix.matrix_mask_gaps(_compress(spark, d), places, lengths.select(F.col("id").alias("contig"), F.col("n").alias("length")), 40)
