"""Domain frames derived from the star-schema tables, each as DataFrame code and as SQL text of the same meaning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.intervals import region
from ..operators.scan import save


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """read_id, contig, strand, condition (N treated, D control), regions: one block, or two from line 5 on."""
    rows = table(spark, sf_dir, "lineitem")
    first = (F.col("l_partkey") * 3 + 101).cast("long")
    last = first + F.col("l_quantity").cast("long") - 1
    one = region(first, last)
    return rows.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("long").alias("read_id"),
        F.concat(F.lit("c"), (F.col("l_suppkey") % 5).cast("string")).alias("contig"),
        F.when(F.col("l_linestatus") == "F", "+").otherwise("-").alias("strand"),
        F.when(F.col("l_returnflag") == "N", "D").otherwise("N").alias("condition"),
        F.when(F.col("l_linenumber") >= 5, F.array(one, region(first + 200, last + 200))).otherwise(F.array(one)).alias("regions"),
    )


READS = """reads AS (
  SELECT CAST(l_orderkey * 10 + l_linenumber AS BIGINT) AS read_id, 'c' || CAST(l_suppkey % 5 AS VARCHAR) AS contig,
    CASE WHEN l_linestatus = 'F' THEN '+' ELSE '-' END AS strand, CASE WHEN l_returnflag = 'N' THEN 'D' ELSE 'N' END AS condition,
    CAST(l_partkey * 3 + 101 AS BIGINT) AS s1, CAST(l_partkey * 3 + 100 + l_quantity AS BIGINT) AS e1, l_linenumber >= 5 AS split FROM lineitem),
blocks AS (SELECT read_id, contig, strand, condition, s1 AS first, e1 AS second FROM reads
  UNION ALL SELECT read_id, contig, strand, condition, s1 + 200, e1 + 200 FROM reads WHERE split),
ends AS (SELECT *, CASE WHEN strand = '+' THEN s1 ELSE e1 + CASE WHEN split THEN 200 ELSE 0 END END AS end5 FROM reads),
base_bd AS (SELECT contig, strand, condition, pos, CAST(count(*) AS BIGINT) AS bd FROM
  (SELECT contig, strand, condition, unnest(range(first, second + 1)) AS pos FROM blocks) GROUP BY ALL),
base_rt AS (SELECT contig, strand, condition, CASE WHEN strand = '+' THEN end5 - 1 ELSE end5 + 1 END AS pos, CAST(count(*) AS BIGINT) AS rt FROM ends GROUP BY ALL)"""

COUNTS = READS + """,
sizes AS (SELECT contig, max(second) + 40 AS length FROM blocks GROUP BY contig),
counts AS (SELECT contig, strand, pos, CAST(sum(n_rt) AS BIGINT) AS n_rt, CAST(sum(n_bd) AS BIGINT) AS n_bd, CAST(sum(d_rt) AS BIGINT) AS d_rt, CAST(sum(d_bd) AS BIGINT) AS d_bd FROM (
  SELECT contig, strand, pos, 0 AS n_rt, CASE WHEN condition = 'N' THEN bd ELSE 0 END AS n_bd, 0 AS d_rt, CASE WHEN condition = 'D' THEN bd ELSE 0 END AS d_bd FROM base_bd
  UNION ALL SELECT contig, strand, pos, CASE WHEN condition = 'N' THEN rt ELSE 0 END, 0, CASE WHEN condition = 'D' THEN rt ELSE 0 END, 0 FROM base_rt) GROUP BY ALL)"""


def sizes(read_rows: DataFrame) -> DataFrame:
    """contig, length: 40 bases behind the last read; saved, as a row for each contig is asked for again and again."""
    return save(read_rows.groupBy("contig").agg((F.max(F.element_at("regions", -1)["second"]) + 40).alias("length")), "sizes")


def junctions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct gaps of all reads, and decoys shifted by one."""
    rows = reads(spark, sf_dir).where(F.size("regions") > 1)
    gap = rows.select("contig", "strand", (F.element_at("regions", 1)["second"] + 1).alias("first"), (F.element_at("regions", 2)["first"] - 1).alias("second")).distinct()
    return gap.unionByName(gap.select("contig", "strand", F.col("first") + 1, F.col("second") + 1).toDF("contig", "strand", "first", "second")).distinct()


JUNCTIONS = READS + """,
gap AS (SELECT DISTINCT contig, strand, e1 + 1 AS first, s1 + 199 AS second FROM reads WHERE split),
junctions AS (SELECT * FROM gap UNION SELECT contig, strand, first + 1, second + 1 FROM gap)"""


def sam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignments: read_id, flag, chr_id, pos, mapq, cigar, seq length as qlen, tags. The CIGAR goes by line number."""
    rows = table(spark, sf_dir, "lineitem")
    q = F.col("l_quantity").cast("long").cast("string")
    n = F.col("l_linenumber")
    cigar = F.when(n == 1, F.concat(q, F.lit("M"))).when(n == 2, F.concat(F.lit("5S"), q, F.lit("M"))).when(n == 3, F.concat(q, F.lit("M100N"), q, F.lit("M"))).when(n == 4, F.concat(q, F.lit("M2I"), q, F.lit("M"))).otherwise(F.concat(q, F.lit("M1D"), q, F.lit("M3S")))
    flag = F.when(F.col("l_suppkey") % 11 == 0, 4).when(F.col("l_suppkey") % 7 == 0, 256).when(F.col("l_linestatus") == "F", 0).otherwise(16)
    md = F.concat((F.col("l_suppkey") % 4).cast("string"), F.lit("A"), q, F.when(F.col("l_partkey") % 3 == 0, F.lit("G0")).otherwise(F.lit("")))
    jm = F.concat(F.lit("B:c,"), (F.col("l_suppkey") % 9).cast("string"))
    return rows.select(
        F.concat(F.lit("r"), F.col("l_orderkey").cast("string")).alias("read_id"), flag.cast("int").alias("flag"), F.concat(F.lit("c"), (F.col("l_suppkey") % 5).cast("string")).alias("chr_id"),
        (F.col("l_partkey") * 3 + 101).cast("long").alias("pos"), F.lit(255).alias("mapq"), cigar.alias("cigar"), F.lit("=").alias("rnext"),
        F.map_from_arrays(F.array(F.lit("MD"), F.lit("jM")), F.array(md, jm)).alias("tags"), n.cast("int").alias("line"),
    )


def read_sam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``sam`` with seq and qual, as long as the first match and 5 letters more."""
    n = F.regexp_extract("cigar", r"(\d+)M", 1).cast("int") + 5
    shift = F.pmod(F.col("pos"), F.lit(7)).cast("int")
    rows = sam(spark, sf_dir)
    return rows.withColumn("seq", F.substring(F.repeat(F.lit("ACGTTGCANC"), 8), shift + 1, n)).withColumn("qual", F.substring(F.repeat(F.lit("IHGFEDCBA"), 9), shift + 1, n))


READ_SAM = """rs AS (SELECT *, substr(repeat('ACGTTGCANC', 8), CAST(pos % 7 AS INTEGER) + 1, CAST(q AS INTEGER) + 5) AS seq, substr(repeat('IHGFEDCBA', 9), CAST(pos % 7 AS INTEGER) + 1, CAST(q AS INTEGER) + 5) AS qual FROM cig)"""


SAM = """sam AS (SELECT 'r' || CAST(l_orderkey AS VARCHAR) AS read_id,
  CASE WHEN l_suppkey % 11 = 0 THEN 4 WHEN l_suppkey % 7 = 0 THEN 256 WHEN l_linestatus = 'F' THEN 0 ELSE 16 END AS flag,
  'c' || CAST(l_suppkey % 5 AS VARCHAR) AS chr_id, CAST(l_partkey * 3 + 101 AS BIGINT) AS pos, CAST(l_quantity AS BIGINT) AS q, CAST(l_linenumber AS INTEGER) AS line,
  CAST(l_suppkey % 4 AS VARCHAR) || 'A' || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || CASE WHEN l_partkey % 3 = 0 THEN 'G0' ELSE '' END AS md,
  CAST(l_suppkey % 9 AS BIGINT) AS jm FROM lineitem),
cig AS (SELECT *, CASE line WHEN 1 THEN q || 'M' WHEN 2 THEN '5S' || q || 'M' WHEN 3 THEN q || 'M100N' || q || 'M' WHEN 4 THEN q || 'M2I' || q || 'M' ELSE q || 'M1D' || q || 'M3S' END AS cigar FROM sam)"""


def transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One transcript for each part: contig, strand, gene_id, transcript_id, type, exons (array, in genome order)."""
    rows = table(spark, sf_dir, "part")
    start = (F.col("p_partkey") * 3 + 50).cast("long")
    n = (F.col("p_size") % 4 + 1).cast("int")
    exons = F.transform(F.sequence(F.lit(0), n - 1), lambda i: region(start + i * 100, start + i * 100 + 39 + F.col("p_size")))
    return rows.select(
        F.concat(F.lit("c"), (F.col("p_partkey") % 5).cast("string")).alias("contig"), F.when(F.col("p_size") % 2 == 0, "+").otherwise("-").alias("strand"),
        F.concat(F.col("p_brand"), F.lit("/"), (F.col("p_partkey") % 5).cast("string"), F.lit("/"), (F.col("p_size") % 2).cast("string")).alias("gene_id"),
        F.concat(F.lit("t"), F.col("p_partkey").cast("string")).alias("transcript_id"), F.when(F.col("p_size") > 20, "mRNA").otherwise("lncRNA").alias("type"), exons.alias("exons"),
    )


TRANSCRIPTS = """tx AS (SELECT 'c' || CAST(p_partkey % 5 AS VARCHAR) AS contig, CASE WHEN p_size % 2 = 0 THEN '+' ELSE '-' END AS strand,
  p_brand || '/' || CAST(p_partkey % 5 AS VARCHAR) || '/' || CAST(p_size % 2 AS VARCHAR) AS gene_id, 't' || CAST(p_partkey AS VARCHAR) AS transcript_id,
  CASE WHEN p_size > 20 THEN 'mRNA' ELSE 'lncRNA' END AS type, CAST(p_partkey * 3 + 50 AS BIGINT) AS start, p_size % 4 + 1 AS n, CAST(p_size AS BIGINT) AS p_size FROM part),
ex AS (SELECT contig, strand, gene_id, transcript_id, type, start + i * 100 AS first, start + i * 100 + 39 + p_size AS second FROM (SELECT *, unnest(range(0, n)) AS i FROM tx)),
exo AS (SELECT *, second - first + 1 AS len, sum(second - first + 1) OVER (PARTITION BY transcript_id ORDER BY CASE WHEN strand = '+' THEN first ELSE -first END) AS t_end,
  row_number() OVER (PARTITION BY transcript_id ORDER BY CASE WHEN strand = '+' THEN first ELSE -first END) AS exon FROM ex),
exons AS (SELECT contig, strand, gene_id, transcript_id, type, CAST(exon AS INTEGER) AS exon, first, second, CAST(t_end - len + 1 AS BIGINT) AS t_first, CAST(t_end AS BIGINT) AS t_second FROM exo)"""


def letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, seq: all letters of a text as bases."""
    base = F.regexp_replace(F.lower(F.coalesce("text", F.lit(""))), "[^a-z]", "")
    return table(spark, sf_dir, "documents").select("doc_id", F.translate(base, "abcdefghijklmnopqrstuvwxyz", "ACGTACGTACGTACGTACGTACGTAC").alias("seq"))


def fastq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads from texts: id, key, seq (all letters of a text as bases, 60 in a read), tag, qual (Phred+33). An empty text is one empty read."""
    reads = letters(spark, sf_dir).select("doc_id", F.posexplode_outer(F.regexp_extract_all("seq", F.lit(".{1,60}"), F.lit(0))).alias("k", "seq"))
    reads = reads.select((F.col("doc_id") * 1_000_000 + F.coalesce("k", F.lit(0))).cast("long").alias("id"), F.coalesce("seq", F.lit("")).alias("seq"))
    # the letter at i is chr(73 - i // 3 - (7 * i + id) % 11): eleven texts, of which a read has the beginning of one
    texts = F.array(*[F.lit("".join(chr(73 - i // 3 - (7 * i + k) % 11) for i in range(1, 61))) for k in range(11)])
    qual = F.substring(F.get(texts, F.pmod("id", F.lit(11)).cast("int")), F.lit(1), F.length("seq"))
    return reads.select("id", F.concat(F.lit("@read"), F.col("id").cast("string"), F.lit(" lane1")).alias("key"), "seq", F.lit("+x").alias("tag"), qual.alias("qual"))


FASTQ = """letters AS (SELECT doc_id, translate(regexp_replace(lower(coalesce(text, '')), '[^a-z]', '', 'g'), 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAC') AS s FROM documents),
fq AS (SELECT CAST(doc_id * 1000000 + k AS BIGINT) AS id, '@read' || CAST(doc_id * 1000000 + k AS VARCHAR) || ' lane1' AS key, substr(s, k * 60 + 1, 60) AS seq
  FROM (SELECT *, unnest(range(0, greatest((length(s) + 59) // 60, 1))) AS k FROM letters))"""


def hangs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Duplex hangs: arm 1 from line n of an order, arm 2 from line n + 1."""
    rows = table(spark, sf_dir, "lineitem")
    short = lambda i: [(F.col("l_suppkey") % 5).cast("int").alias(f"c{i}"), (F.col("l_linestatus") == "F").alias(f"f{i}"), F.col("l_partkey").alias(f"p{i}"), (F.col("l_quantity") % 7).alias(f"q{i}")]
    one = rows.select("l_orderkey", "l_linenumber", *short(1))
    two = rows.select("l_orderkey", (F.col("l_linenumber") - 1).alias("l_linenumber"), *short(2))
    start = lambda i: F.col(f"p{i}") * 3
    # numbers are shuffled, and become names behind the join
    arm = lambda i: [F.concat(F.lit("c"), F.col(f"c{i}").cast("string")).alias(f"chr_{i}"), F.when(F.col(f"f{i}"), "+").otherwise("-").alias(f"strand_{i}"), (start(i) + 101).cast("long").alias(f"start_{i}"), (start(i) + 110 + F.col(f"q{i}")).cast("long").alias(f"end_{i}")]
    return one.join(two, ["l_orderkey", "l_linenumber"]).select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string").alias("read_id"), *arm(1), *arm(2))


HANGS = """arms AS (SELECT l_orderkey, l_linenumber, 'c' || CAST(l_suppkey % 5 AS VARCHAR) AS chr, CASE WHEN l_linestatus = 'F' THEN '+' ELSE '-' END AS strand,
  CAST(l_partkey * 3 + 101 AS BIGINT) AS s, CAST(l_partkey * 3 + 110 + CAST(l_quantity AS BIGINT) % 7 AS BIGINT) AS e FROM lineitem),
hangs AS (SELECT CAST(a.l_orderkey * 10 + a.l_linenumber AS VARCHAR) AS read_id, a.chr AS chr_1, a.strand AS strand_1, a.s AS start_1, a.e AS end_1, b.chr AS chr_2, b.strand AS strand_2, b.s AS start_2, b.e AS end_2
  FROM arms a JOIN arms b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber + 1 = b.l_linenumber)"""
