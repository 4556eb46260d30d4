"""The remaining operators, sources and sinks on small inputs."""

from pyspark.sql import functions as F

from probewell.functions import sequence
from probewell.operators import annotation, coords, matrix, pileup, qc, reads, score, tracks
from probewell.sources import readers, writers

SAM = "read_id string, flag int, chr_id string, pos long, cigar string, rnext string, seq string, qual string, tags map<string,string>"
EXONS = "contig string, strand string, gene_id string, transcript_id string, type string, exons array<struct<first:bigint,second:bigint>>"


def test_older_pipeline(spark):
    rows = [(f"r{i}", 0, "t", 1 + i % 60, "30M", "*", "A" * 30, "I" * 30, {}) for i in range(200)] + [("m", 0, "t", 5, "10M", "*", "A" * 10, "I" * 10, {}), ("m", 256, "u", 5, "10M", "*", "A" * 10, "I" * 10, {})]
    rpkm = spark.createDataFrame([("t", 100, 9.0), ("u", 50, 1.0)], "contig string, length long, rpkm double")
    rt = tracks.transcript_rt(spark.createDataFrame(rows, SAM), rpkm)
    one = rt.first()
    assert rt.count() == 1 and len(one.bd) == len(one.rt) == 101 and abs(sum(one.rt) - 200.5) < 1e-9 and abs(sum(one.bd) - (200 * 30 + 5)) < 1e-6
    both = rt.withColumn("replicate", F.lit(1)).unionByName(rt.withColumn("replicate", F.lit(2)))
    summed = tracks.combine_replicates(both).first()
    assert summed.rpkm == "9.0,9.0" and abs(sum(summed.rt) - 401) < 1e-9
    normal = tracks.normalize_rt(rt, head=5, tail=5, method="mean:upper")
    assert {r.type for r in normal.collect()} == {"baseDensity", "RTstop"} and all(len(r["values"]) == 100 for r in normal.collect())
    assert tracks.rt_bedgraph(normal).count() > 50
    joined = tracks.enrich_fg_bg_join(normal, normal)
    scored = tracks.enrich_transcripts(joined)
    assert joined.count() == 1 and len(scored.first()["values"]) == 100
    kept = tracks.filter_enrich(scored, bd_cutoff=0, rt_cutoff=0.0).first()
    assert len(kept.scores) == 100 and kept.scores[0] is None and any(x is not None for x in kept.scores)


def test_junction_windows_and_replicates(spark):
    counts = spark.createDataFrame([("c", "+", p, 1 + p % 5, 90 + p % 7, p % 3, 120 + p % 11) for p in range(1, 900)], "contig string, strand string, pos long, n_rt long, n_bd long, d_rt long, d_bd long")
    j = spark.createDataFrame([("c", "+", 101, 700), ("c", "+", 800, 820)], "contig string, strand string, first long, second long")
    inside = score.sliding_junction(counts, j, wsize=100, wstep=5, grid="fixed")
    got = inside.agg(F.min("pos").alias("a"), F.max("pos").alias("b"), F.count("score").alias("n")).first()
    assert got.a == 101 and got.b == 700 and 580 < got.n
    sizes = spark.createDataFrame([("c", 899)], "contig string, length long")
    axis = score.sliding_score(counts, sizes, j, wsize=50, wstep=5, grid="fixed")
    assert axis.where("pos between 101 and 700 or pos between 800 and 820").count() == 0 and axis.count() == 899 - 621
    masked = score.sliding_score(counts.withColumn("base", F.when(F.col("pos") % 2 == 0, "A").otherwise("C")), sizes, wsize=100, wstep=20, grid="fixed", bases="A")
    assert masked.where("pos % 2 = 1 and score is not null").count() == 0 and masked.where("score is not null").count() > 300
    pair = counts.select("contig", "strand", "pos", F.col("n_rt").cast("double").alias("shape_1"), (F.col("n_rt") * 2.0 + F.col("d_rt")).alias("shape_2"))
    kinds = {r.kind: r.r for r in qc.shape_replicate_corr(pair).collect()}
    assert kinds["true"] > 0.9
    dots = spark.createDataFrame([("c", "A" * 899, ("(" * 2 + "." * 3 + ")" * 2 + "..") * 99 + "." * 8)], "id string, seq string, dot string")
    trained = qc.train_parameters(counts, sizes, dots, windows=(100,), sub_factors=(0.0, 0.25), wstep=20).collect()
    assert len(trained) == 2 and all(0 <= r.auc <= 1 for r in trained)
    shapes = spark.createDataFrame([("c", 899, [(i % 9) / 9 for i in range(899)])], "transcript_id string, length long, scores array<double>")
    assert {r.transcript_id for r in qc.evaluate_structure(shapes, dots).collect()} == {"c", None}
    assert qc.common_transcripts(shapes, shapes).count() == 1 and tracks.shape_text_bedgraph(shapes, -1.0).count() == 899


def test_records(spark):
    rows = [("a", 16, "c", 3, "4M", "*", "AACG", "IIII", {"NH": "1"}), ("b", 4, "*", 0, "*", "*", "GG", "II", {}), ("c", 0, "c", 1, "2M1D2M", "*", "ACTT", "IIII", {})]
    sam = spark.createDataFrame(rows, SAM)
    assert {(r.key, r.seq) for r in reads.sam2fq(sam).collect()} == {("@a", "CGTT"), ("@b", "GG"), ("@c", "ACTT")}
    aligned, fastq = reads.route_alignments(sam)
    assert aligned.count() == 1 and fastq.first().seq == "GG"
    genome = readers.tile_fasta(spark.createDataFrame([("c", "ACGTACGT")], "id string, seq string"), 3)
    # c: AC against AC, then TT against TA; a: AACG against GTAC
    assert {r.read_id: r.tags["MM"] for r in reads.mismatch_count(sam, genome).collect()} == {"a": "4", "b": "0", "c": "1"}
    seqs = spark.createDataFrame([("x", "one", "AC"), ("y", "two", "ACG"), ("z", None, "")], "id string, annotation string, seq string")
    ids = spark.createDataFrame([("x",), ("nobody",)], "id string")
    assert [r.id for r in reads.fasta_select(seqs, fetch=ids).collect()] == ["x"] and reads.fasta_select(seqs, remove=ids).count() == 2
    assert reads.fasta_select(seqs, keep_note_re="o", sample=1).count() == 1 and [r.id for r in reads.sort_fasta(seqs, reverse=True).collect()] == ["y", "x", "z"]
    assert reads.column_select(seqs, "1,2-3").first().selected == "x,one,AC" and reads.read_length_hist(sam).count() == 2 and reads.sample_reads(sam).count() == 3
    counts = spark.createDataFrame([("c", "-", 1, 5)], "contig string, strand string, pos long, rt long")
    assert pileup.with_base(counts, genome).first().base == "T" and pileup.union_replicates(counts.withColumn("bd", F.lit(1)), counts.withColumn("bd", F.lit(2))).first().bd == 3


def test_matrices(spark):
    cells = [("c", "+", x, y, float(x * y % 17 + 1)) for x in range(1, 13) for y in range(1, 13)]
    coo = spark.createDataFrame(cells, "contig string, strand string, x long, y long, value double")
    normal = [r.value for r in matrix.matrix_normalize(coo).collect()]
    assert all(v is None or 0 <= v <= 1 for v in normal) and 1.0 in normal and None in normal
    seqs = spark.createDataFrame([("c", "AUGCAUGCAUGC")], "contig string, seq string")
    kept = {(r.x, r.y) for r in matrix.matrix_mask_noncanonical(coo, seqs).where("value is not null").collect()}
    assert (1, 2) in kept and (2, 3) in kept and (1, 1) not in kept
    aln = spark.createDataFrame([("c", "AC--GUACGUACGU")], "id string, aligned string")
    at = matrix.alignment_coords(aln)
    assert {(r.x, r.y) for r in matrix.matrix_expand(coo.where("x = 3 and y = 1"), at).collect()} == {(5, 1)}
    assert matrix.matrix_mask_gaps(coo, at, 14, 14).where("x in (3, 4) and value is not null").count() == 0
    size = spark.createDataFrame([("c", 12)], "contig string, length long")
    assert matrix.matrix_compress(coo, size, 3, "max").count() == 9 and matrix.matrix_compress(coo, size, 3, "mean").first().value <= 17
    domains = spark.createDataFrame([("c", "a", 1, 50), ("c", "b", 51, 100)], "contig string, name string, first long, second long")
    assert [(r["first"], r.second) for r in matrix.compress_regions(domains, spark.createDataFrame([("c", 100)], "contig string, length long"), 10).orderBy("first").collect()] == [(1, 5), (6, 10)]


def test_annotation(spark):
    t = spark.createDataFrame([("c", "-", "g", "t", "mRNA", [(1, 4), (7, 10)])], EXONS)
    genome = readers.tile_fasta(spark.createDataFrame([("c", "AACCGGTTAC")], "id string, seq string"), 3)
    assert annotation.build_transcriptome(t, genome).first().seq == "GTAAGGTT"
    bed = t.withColumn("utr", F.expr("array(named_struct('first', 9L, 'second', 10L), named_struct('first', 1L, 'second', 2L))"))
    row = annotation.genome_coor_to_trans_coor(bed).first()
    assert (row.length, row.exons, row.utr) == (8, "1-4,5-8", "1-2,7-8")
    seqs = spark.createDataFrame([("t", "CCATGTAA")], "transcript_id string, seq string")
    features = spark.createDataFrame([("t", 3, 8)], "transcript_id string, cds_start long, cds_end long")
    assert {r.offset: (r.starts, r.stops) for r in annotation.codon_check(features, seqs).collect()} == {-3: (0, 0), 0: (1, 1), 3: (0, 0)}
    genes = annotation.gene_table(t)
    span = spark.createDataFrame([("g", 2, 9)], "gene_id string, g_first long, g_second long")
    assert {(r.t_first, r.t_second) for r in coords.gene_to_transcript(span, genes, annotation.exon_offsets(t)).collect()} == {(2, 4), (5, 7)}
    assert annotation.gene_trans_lists(t).first().transcripts == ["t"] and annotation.introns(t).first()["first"] == 5
    region = spark.createDataFrame([("NC_1", {"chromosome": "7"}), ("NC_2", {"genome": "mitochondrion"}), ("x", {})], "contig string, attributes map<string,string>")
    assert {r.contig for r in annotation.rename_contigs(region, region).collect()} == {"chr7", "chrM", "x"}
    gtab = spark.createDataFrame([("tr", "+", p, 5, 500, p / 100) for p in range(1, 51)], "contig string, strand string, pos long, rt long, bd long, shape double")
    sizes = spark.createDataFrame([("tr", 60)], "contig string, length long")
    one = coords.shape_contig_mode(gtab, sizes).first()
    assert len(one.scores) == 60 and one.scores[9] == 0.1 and one.scores[59] is None
    fold = spark.createDataFrame([("f", "GUAC", "(..)")], "id string, seq string, dot string").withColumn("pairs", sequence.dotbracket_pairs("dot")).persist()
    assert [r.mate for r in sequence.pairs_to_ct(fold).orderBy("pos").collect()] == [4, 0, 0, 1]
    assert fold.select(sequence.pairs_to_dotbracket("pairs", F.lit(4))).first()[0] == "(..)"
    assert sequence.tt_crosslinks(spark.createDataFrame([("f", "GUUC", [(1, 3)])], "id string, seq string, pairs array<struct<left:int,right:int>>")).collect() != []
    assert sequence.barcode_lib(spark, 2).count() == 16


def test_more_files(spark, tmp_path):
    def put(name, text):
        (tmp_path / name).write_text(text)
        return str(tmp_path / name)

    aln = readers.read_stockholm(spark, put("a.sto", "# STOCKHOLM 1.0\n#=GS s1 DE note one\ns1 AC-\n#=GC SS_cons (.)\n\ns1 GU\n//\n"))
    assert {(r.id, r.note, r.aligned) for r in aln.collect()} == {("s1", "note one", "AC-GU"), ("SS_cons", None, "(.)")}
    coor = readers.read_genome_coor(spark, put("a.bed", "c\t1\t9\t+\tN=g.1\tt.2\tmRNA\t1-4,7-9\t1-2\n"), True, True).first()
    assert (coor.gene_name, coor.gene_id, coor.transcript_id, len(coor.exons), len(coor.utr)) == ("N", "g", "t", 2, 1)
    rt = readers.read_rt_file(spark, put("a.rt", "t\t2\t5.0\t1\t2\t3\nt\t2\t5.0\t0\t1\t0\n")).first()
    assert list(rt.bd) == [1, 2, 3] and list(rt.rt) == [0, 1, 0]
    line = lambda t, v, s: "\t".join([t, *["x"] * 8, v, "a", "b", s])
    fpkm = readers.read_fpkm(spark, [put("f1", line("t", "2", "OK") + "\n"), put("f2", line("t", "4", "OK") + "\n" + line("u", "1", "FAIL") + "\n")])
    assert [tuple(r) for r in fpkm.collect()] == [("t", 3.0)]
    sizes = readers.read_chr_size(spark, put("s", "c\t100\n"))
    assert readers.read_junctions(spark, put("j", "c\t5\t9\t+\nc\t5\t100\t+\nd\t1\t2\t-\n"), sizes).count() == 1
    assert readers.read_accessibility(spark, put("acc", "t\t1\tA\t3.5\nt\t2\tC\tNULL\n")).where("value is null").count() == 1
    hangs = readers.read_dh(spark, put("dh", "r\tc\t+\t0\t9M\t1\t9\t||\td\t-\t16\t9M\t5\t13\n"))
    writers.write_dh(hangs, f"{tmp_path}/dh2")
    assert readers.read_dh(spark, f"{tmp_path}/dh2").collect() == hangs.collect()
    bars = spark.createDataFrame([(1, "@a", "ACGT", "+", "IIII"), (2, "@b", "GGGG", "+", "IIII")], "id long, key string, seq string, tag string, qual string")
    writers.write_by_barcode(reads.with_barcode(bars, 1, 2, sequence.barcode_lib(spark, "AC:one")), f"{tmp_path}/bar")
    assert {p.name for p in (tmp_path / "bar").iterdir() if p.is_dir()} == {"library=one", "library=unmatched"}
    writers.write_fastq(bars, f"{tmp_path}/fq")
    assert spark.read.text(f"{tmp_path}/fq").count() == 8
    track = spark.createDataFrame([("score", "c", "+", 7, 0.25)], "track string, contig string, strand string, pos long, value double")
    writers.write_bedgraph(track, f"{tmp_path}/bg")
    assert spark.read.text(f"{tmp_path}/bg").first().value == "c\t6\t7\t0.250"
    groups = spark.createDataFrame([("g", "c", "+", 1, 5, 3), ("h", "c", "+", 9, 12, 1)], "group_id string, chr_1 string, strand_1 string, start_1 long, end_1 long, support long")
    members = spark.createDataFrame([("g", "r1"), ("g", "r2"), ("h", "r3")], "group_id string, read_id string")
    writers.write_dg_tab(groups, members, f"{tmp_path}/dg")
    assert spark.read.text(f"{tmp_path}/dg").count() == 1
