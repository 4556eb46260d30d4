"""Hand-worked examples and properties of the domain operators."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from probewell.functions import cigar, intervals, sequence
from probewell.operators import annotation, coords, duplex, matrix, pileup, qc, reads, score, tracks
from probewell.sources import readers, writers

TAB = [("E1", "+", [(495, 504), (605, 614)])] * 3 + [("E1", "+", [(526, 571)]), ("E1", "+", [(756, 786)]), ("E2", "+", [(180, 266)]), ("E3", "+", [(1356, 1391)])] + [("E3", "+", [(1356, 1403)])] * 2 + [("E3", "+", [(1416, 1450)])] * 3
READS = "contig string, strand string, regions array<struct<first:bigint,second:bigint>>"


def test_pile_up_of_the_example(spark):
    r = spark.createDataFrame(TAB, READS)
    rt = {(x.contig, x.pos): x.rt for x in pileup.rt_stops(r).collect()}
    assert rt == {("E1", 494): 3, ("E1", 525): 1, ("E1", 755): 1, ("E2", 179): 1, ("E3", 1355): 3, ("E3", 1415): 3}
    for tile in (7, 250, 1_000_000):
        bd = {(x.contig, x.pos): x.bd for x in pileup.base_density(r, tile=tile).collect()}
        want = Counter((c, p) for c, _, rs in TAB for a, b in rs for p in range(a, b + 1))
        assert bd == dict(want)


def test_junctions(spark):
    r = spark.createDataFrame(TAB, READS)
    j = spark.createDataFrame([("E1", "+", 505, 604), ("E1", "+", 1, 2)], "contig string, strand string, first long, second long")
    assert {(x.first, x.support) for x in pileup.junction_support(r, j).select(F.col("first"), "support").toPandas().itertuples(index=False)} == {(505, 3), (1, 0)}
    one = spark.createDataFrame([("c", "+", 51, 80), ("c", "-", 51, 80)], "contig string, strand string, first long, second long")
    ends = spark.createDataFrame([("c", "+", 81), ("c", "+", 82), ("c", "-", 50), ("c", "-", 49)], "contig string, strand string, end5 long")
    assert {(x.strand, x.end5, x.pos) for x in pileup.rt_junction_shift(ends, one).collect()} == {("+", 81, 50), ("+", 82, 81), ("-", 50, 81), ("-", 49, 50)}
    sizes = spark.createDataFrame([("c", 100)], "contig string, length long")
    many = spark.createDataFrame([("c", "+", 1, 10, 2), ("c", "+", 5, 12, 5), ("c", "+", 13, 20, 1), ("c", "+", 90, 120, 9)], "contig string, strand string, first long, second long, support long")
    assert [tuple(x)[2:] for x in pileup.combine_junctions(many, sizes).collect()] == [(5, 20, 5)]


def test_extension_jumps_over_a_junction_and_stops_inside_one(spark):
    cases = [("a", "+", 91, 120, [(41, 50), (81, 90)]), ("a", "+", 60, 120, [(51, 59)]), ("a", "-", 10, 45, [(46, 50), (81, 95)]), ("b", "+", 5, 9, [(1, 4)]), ("a", "+", 81, 90, [(31, 50)]), ("a", "+", 1, 4, []), ("a", "-", 70, 80, []), ("a", "-", 60, 79, [(80, 80)])]
    cases += [("c", "+", 101, 110, [(58, 59), (65, 69), (80, 84), (90, 94), (98, 100)])]
    j = [("a", "+", 51, 80), ("a", "-", 51, 80), ("c", "+", 60, 64), ("c", "+", 70, 79), ("c", "+", 85, 89), ("c", "+", 95, 97)]
    r = spark.createDataFrame([(c, s, [(x, y)], i) for i, (c, s, x, y, _) in enumerate(cases)], READS + ", i int")
    got = {x.i: [(g["first"], g["second"]) for g in x.regions] for x in pileup.bd_extension(r, spark.createDataFrame(j, "contig string, strand string, first long, second long"), None, 20).collect()}
    assert got == {i: sorted([*want, (x, y)]) for i, (_, _, x, y, want) in enumerate(cases)}


def test_extension_without_junctions(spark):
    r = spark.createDataFrame([("c", "+", [(91, 120)]), ("c", "-", [(10, 45)])], READS)
    none = spark.createDataFrame([], "contig string, strand string, first long, second long")
    assert sorted((x.strand, len(x.regions)) for x in pileup.bd_extension(r, none, None, 20).collect()) == [("+", 2), ("-", 2)]
    assert pileup.bd_extension(r, none, None, 0).collect() == r.collect()


@pytest.mark.parametrize(
    ("text", "want"),
    [("1M2N2M", [(1, 1), (4, 5)]), ("1M2N2N2M", [(1, 1), (6, 7)]), ("10S1M2N2N2M2M10S", [(1, 1), (6, 9)]), ("10S1M2N1X1=2N2M2M10S", [(1, 1), (4, 5), (8, 11)]), ("5M1D5M", [(1, 11)]), ("10M2I10M", [(1, 10), (11, 20)])],
)
def test_cigar_blocks(spark, text, want):
    got = spark.range(1).select(cigar.cigar_global_regions(F.lit(text), F.lit(1)).alias("r")).first().r
    assert [(x["first"], x["second"]) for x in got] == want


def test_cigar_strings(spark):
    rows = spark.createDataFrame([("60M", "TOTAL"), ("10S50M", "RIGHT"), ("50M10S", "LEFT"), ("6S34M20S", "LEFT"), ("10S30M10S", "CENTER")], "c string, p string")
    assert all(r.p == r.q for r in rows.select("p", cigar.cigar_match_pattern("c").alias("q")).collect())
    one = spark.range(1).select(cigar.cigar_reverse(F.lit("10M1D20M5S")), cigar.cigar_max_softclip(F.lit("6S34M20S")), cigar.cigar_match(F.lit("30S10M1D20M10S")), cigar.cigar_region(F.lit("30S10M1D20M10S"), 11, 40), cigar.cigar_trim_deletions(F.lit("5D10M"), "left")["removed"]).first()
    assert tuple(one) == ("5S20M1D10M", 20, "10M1D20M", "20S10M", 5)
    md = spark.createDataFrame([("0A24",), ("10A5G8",), ("25",), ("3^AC2T1",)], "m string").select(sequence.md_mutations("m").alias("o")).collect()
    assert [list(r.o) for r in md] == [[0], [10, 16], [], [5]]


def test_sequences(spark):
    one = spark.range(1).select(sequence.reverse_complement(F.lit("ACGTNX")), sequence.translate_codons(F.lit("ATGGCCTAAN")), sequence.motif_sites(F.lit("AAAA"), "AA"), sequence.subsequence(F.lit("ACGTT"), 1, 3, "-"), sequence.gene_type_class(F.lit("processed_pseudogene"))).first()
    assert tuple(one)[:2] == ("NNACGT", "MA*") and list(one[2]) == [1, 2, 3] and one[3] == "ACG" and one[4] == "pseudogene"
    dots = spark.createDataFrame([("((..))",), ("((.)",), (None,)], "d string").select(sequence.dotbracket_pairs("d").alias("p")).collect()
    assert [None if r.p is None else [(x["left"], x["right"]) for x in r.p] for r in dots] == [[(1, 6), (2, 5)], None, None]
    a = spark.range(1).select(sequence.parse_gtf_attributes(F.lit('gene_id "g"; tag "a"; tag "b";')), sequence.parse_gff3_attributes(F.lit("ID=x;Dbxref=GeneID:1,Genbank:a,GeneID:2"))).first()
    assert a[0] == {"gene_id": "g", "tag": "b"} and a[1] == {"ID": "x", "GeneID": "1", "Genbank": "a", "GeneID_2": "2"}


def test_interval_algebra(spark):
    r = lambda a, b: F.struct(F.lit(a).cast("long").alias("first"), F.lit(b).cast("long").alias("second"))
    one = spark.range(1).select(intervals.region_union(r(1, 5), r(4, 9)), intervals.region_union(r(7, 9), r(1, 5)), intervals.region_minus(r(1, 9), r(4, 6)), intervals.region_minus(r(1, 2), r(5, 6)), intervals.region_overlap(r(1, 5), r(4, 9))).first()
    flat = [[(x["first"], x["second"]) for x in c] for c in one[:4]]
    assert flat == [[(1, 9)], [(1, 5), (7, 9)], [(1, 3), (7, 9)], []] and one[4] == 2


# ---- scores


def test_scaling_winsor_and_mean(spark):
    v = spark.createDataFrame([("g", float(x)) for x in range(1, 21)], "k string, v double")
    get = lambda s, i, c: score.scaling_factor(v, "v", ["k"], s, i, c).first().factor
    assert (get("decile", 2, "median"), get("decile", 2, "mean"), get("decile", 2, "peak"), get("quartile", 2, "median"), get("upper", 1, "median")) == (17.5, 17.5, 18, 13, 15.5)
    smart = spark.createDataFrame([("g", x) for x in (3.0, 0.0, 2.0, 0.0, 1.0)], "k string, v double")
    assert score.scaling_factor(smart, "v", ["k"], "smart").first().factor == 2
    w = sorted(r.v for r in score.winsorize(v, "v", ["k"]).collect())
    assert w[0] == w[1] == 0 and w[-1] == w[-2] == 1 and any(abs(x - 8 / 17) < 1e-12 for x in w)
    assert all(r.v is None for r in score.winsorize(v.where("v < 20"), "v", ["k"]).collect())
    m = spark.createDataFrame([("a", 0.5), ("b", 0.2), ("b", 0.4), ("b", None), ("c", 0.2), ("c", None)], "k string, score double")
    got = {r.k: (r.score, r.valid_count) for r in score.mean_score(m, ["k"]).collect()}
    assert got["a"] == (None, 0) and got["c"] == (None, 1) and abs(got["b"][0] - 0.3) < 1e-12 and got["b"][1] == 2


def test_enrichment(spark):
    row = spark.createDataFrame([(8, 50, 4, 10)], "n_rt long, n_bd long, d_rt long, d_bd long")
    assert [score.enrich_ctrl(row, m).first().score for m in ("sub", "div", "complex")] == [7, 50, 7]
    assert abs(score.enrich_ctrl(row, "log").first().score - math.log2(9 / 5)) < 1e-12
    zero = row.withColumn("d_bd", F.lit(0))
    assert [score.enrich_ctrl(zero, m).first().score for m in ("sub", "div", "complex", "log")] == [7, None, None, None]


def random_counts(seed=0, size=900):
    rng = np.random.default_rng(seed)
    d_bd = rng.integers(0, 200, size)
    d_bd[300:560] = rng.integers(0, 3, 260)  # a stretch of low expression
    return {p + 1: (int(rng.poisson(2)), int(rng.integers(0, 200)), int(rng.poisson(1)), int(d_bd[p])) for p in range(size)}


def model_sliding(counts, size, wsize, wstep, min_cov, exact):
    first = min(p for p, c in counts.items() if c[0] > 0)
    at = lambda p: counts.get(p, (0, 0, 0, 0))
    starts, s, step = [first], first, wstep
    while s < size - wsize + 1:
        s = min(s + step, size - wsize + 1)
        starts.append(s)
        low = sum(at(p)[3] >= 10 for p in range(s, s + wsize)) < wsize // 5
        step = wsize - 1 if low and exact else wstep
    values = {}
    for s in starts:
        rows = np.array([[at(p) for p in range(s, s + wsize)]]).transpose(2, 0, 1)
        got = score.score_windows(*rows)[0]
        for k in range(wsize):
            values.setdefault(s + k, []).append(got[k])
    out = {}
    for p, v in values.items():
        good = [x for x in v if not math.isnan(x)]
        out[p] = sum(good) / len(good) if len(v) >= 2 and len(good) > len(v) // 2 and at(p)[3] >= min_cov else None
    return out


def model_junction(counts, first, second, wsize, wstep, min_cov, cover, window):
    """The exact grid inside one junction, place by place; ``cover`` is the column of the coverage that counts."""
    width = len(next(iter(counts.values())))
    at = lambda p: counts.get(p, (0,) * width)
    s = lo = max(first - wsize + 1, 1) if first > wsize else 1
    values, step = {}, wstep
    while True:
        rows = np.array([[at(p) for p in range(s, s + wsize)]]).transpose(2, 0, 1)
        for p, x in zip(range(s, s + wsize), window(*rows)[0], strict=True):
            values.setdefault(p, []).append(x)
        if s + wsize - 1 >= second:
            break
        if s > lo:
            step = wsize // 2 if sum(at(p)[cover] >= 10 for p in range(s, s + wsize)) < wsize // 5 else wstep
        s = min(s + step, second - wsize + 1)
    out = {}
    for p in range(first, second + 1):
        good = [x for x in values[p] if not math.isnan(x)]
        out[p] = sum(good) / len(good) if len(values[p]) >= 2 and len(good) > len(values[p]) // 2 and at(p)[cover] >= min_cov else None
    return out


@pytest.mark.parametrize(("first", "second", "control"), [(250, 399, True), (150, 700, True), (40, 800, False), (350, 449, False)])
def test_junction_scores_match_a_literal_model(spark, first, second, control):
    """Junctions of 1.5 and of 1 window length, and ones over the stretch of low expression."""
    counts = random_counts(3) if control else {p: (c[0], c[3]) for p, c in random_counts(3).items()}
    names = ("n_rt", "n_bd", "d_rt", "d_bd") if control else ("rt", "bd")
    rows = spark.createDataFrame([("c:x", "+", p, *v) for p, v in counts.items()], "contig string, strand string, pos long, " + ", ".join(f"{c} long" for c in names))
    spans = spark.createDataFrame([("c:x", "+", first, second), ("c:x", "+", 10, 60), ("c:x", "-", first, second)], "contig string, strand string, first long, second long")
    options = {} if control else {"sink": 0.2}
    got = {r.pos: r.score for r in score.sliding_junction(rows, spans, wsize=100, wstep=5, tile=70, out_min_cov=0, control=control, **options).collect() if r.contig == "c:x"}
    window = score.score_windows if control else (lambda *x: score.score_windows_noctrl(*x, sink=0.2))
    want = model_junction(counts, first, second, 100, 5, 100, len(names) - 1, window)
    assert set(got) == set(want)
    assert all((got[p] is None) == (want[p] is None) and (want[p] is None or abs(got[p] - want[p]) < 1e-9) for p in want)


def test_bases_apart_are_ranked_apart(spark):
    counts = random_counts(4)
    rows = spark.createDataFrame([("c", "+", p, *v, "ACGU"[p % 4]) for p, v in counts.items()], "contig string, strand string, pos long, n_rt long, n_bd long, d_rt long, d_bd long, base string")
    sizes = spark.createDataFrame([("c", 900)], "contig string, length long")
    run = lambda b: score.sliding_score(rows, sizes, grid="fixed", wsize=200, wstep=20, out_min_cov=0, min_cov=60, bases=b)
    apart = {r.pos: r.score for r in score.separate_bases(run, "AT").collect()}
    assert set(apart) <= {p for p in counts if p % 4 in (0, 3)} and {p % 4 for p in apart} == {0, 3}
    one = {r.pos: r.score for r in run("U").collect()}
    assert {p: apart[p] for p in one} == one and any(x is not None for x in one.values())


@pytest.mark.parametrize(("grid", "tile"), [("exact", 250), ("exact", 10_000), ("fixed", 97), ("fixed", 10_000)])
def test_sliding_scores_match_a_literal_model(spark, grid, tile):
    counts = random_counts()
    rows = spark.createDataFrame([("c", "+", p, *v) for p, v in counts.items()], "contig string, strand string, pos long, n_rt long, n_bd long, d_rt long, d_bd long")
    sizes = spark.createDataFrame([("c", 900)], "contig string, length long")
    got = {r.pos: r.score for r in score.sliding_score(rows, sizes, grid=grid, wsize=200, wstep=5, tile=tile, out_min_cov=0).collect()}
    want = model_sliding(counts, 900, 200, 5, 100, grid == "exact")
    assert set(got) == set(want)
    for p in want:
        assert (got[p] is None) == (want[p] is None) and (want[p] is None or abs(got[p] - want[p]) < 1e-9)
        assert got[p] is None or 0 <= got[p] <= 1


def test_window_variability_and_gini(spark):
    rows = spark.createDataFrame([([0.1, 0.4, 0.2],), ([0.1, 0.2, 0.3, 0.4, 0.5],)], "v array<double>")
    assert [round(r[0], 9) for r in rows.select(tracks.window_variability("v")).collect()] == [0.3, 0.3]
    g = spark.createDataFrame([("a", [1.0] * 5), ("b", [0.0, 0.0, 0.0, 1.0, 9.0]), ("c", [0.0] * 5)], "transcript_id string, scores array<double>")
    assert {r.transcript_id: r.gini for r in qc.gini(g, win=4).collect()} == {"a": 0.0, "b": 0.75}
    assert abs(qc.least_correlation(100) - 0.19655) < 1e-4


# ---- coordinates


@pytest.fixture(scope="module")
def two(spark):
    rows = [("c", "+", "g", "plus", "mRNA", [(101, 110), (201, 220)]), ("c", "-", "h", "minus", "mRNA", [(101, 110), (201, 220)])]
    return spark.createDataFrame(rows, "contig string, strand string, gene_id string, transcript_id string, type string, exons array<struct<first:bigint,second:bigint>>")


def test_coordinates_there_and_back(spark, two):
    exons = annotation.exon_offsets(two)
    points = spark.createDataFrame([(t, p) for t in ("plus", "minus") for p in range(1, 32)], "transcript_id string, t_pos long")
    genome = coords.transcript_to_genome(points, exons)
    got = {(r.transcript_id, r.t_pos): r.pos for r in genome.collect()}
    assert got["plus", 11] == 201 and got["minus", 21] == 110 and got["minus", 1] == 220 and ("plus", 31) not in got and len(got) == 60
    back = coords.genome_to_transcript(genome.select("contig", "strand", F.col("pos").alias("first"), F.col("pos").alias("second"), F.col("t_pos").alias("was"), F.col("transcript_id").alias("of")), exons, bin=7)
    assert all(r.t_first == r.was and r.transcript_id == r.of for r in back.collect()) and back.count() == 60
    wide = spark.createDataFrame([("c", "+", 105, 205)], "contig string, strand string, first long, second long")
    assert {(r.p_first, r.p_second, r.t_first, r.t_second) for r in coords.genome_to_transcript(wide, exons, bin=50).collect()} == {(105, 110, 5, 10), (201, 205, 11, 15)}


def test_features_and_region_classes(spark, two):
    bed = two.where("transcript_id = 'plus'").withColumn("utr", F.expr("array(named_struct('first', 101L, 'second', 104L), named_struct('first', 211L, 'second', 220L))"))
    f = annotation.transcript_features(bed).first()
    assert (f.length, f.utr_5_start, f.utr_5_end, f.cds_start, f.cds_end, f.utr_3_start, f.utr_3_end) == (30, 1, 4, 5, 20, 21, 30)
    spans = [(1, 3, "5UTR"), (3, 6, "span_5UTR_CDS"), (5, 20, "CDS"), (18, 25, "span_CDS_3UTR"), (22, 30, "3UTR"), (1, 30, "span_5UTR_CDS_3UTR")]
    rows = spark.createDataFrame([(*s, 5, 20, 30, "mRNA") for s in spans], "s long, e long, want string, c0 long, c1 long, n long, t string")
    assert all(r.want == r.got for r in rows.select("want", sequence.rna_region_class("s", "e", "c0", "c1", "n", "t").alias("got")).collect())


def test_annotation_files(spark, tmp_path):
    gtf = "\n".join(f"chr1\tx\t{k}\t{a}\t{b}\t.\t+\t.\tgene_id \"g\"; transcript_id \"t\"; gene_name \"n\"; transcript_biotype \"protein_coding\";" for k, a, b in (("exon", 101, 110), ("exon", 201, 220), ("CDS", 105, 110), ("CDS", 201, 210)))
    (tmp_path / "a.gtf").write_text(gtf + "\n")
    row = annotation.gtf_to_genome_coor(readers.read_gtf(spark, str(tmp_path / "a.gtf"))).first()
    assert (row["first"], row.second, row.gene_name, row.type) == (101, 220, "n", "protein_coding") and [(u["first"], u["second"]) for u in row.utr] == [(101, 104), (211, 220)]
    gff = ["chr1\tx\tgene\t101\t220\t.\t-\t.\tID=gene1;gene=N;gene_biotype=lncRNA", "chr1\tx\tlnc_RNA\t101\t220\t.\t-\t.\tID=rna1;Parent=gene1;transcript_id=T.1"] + [f"chr1\tx\texon\t{a}\t{b}\t.\t-\t.\tID=e{a};Parent=rna1" for a, b in ((101, 110), (201, 220))]
    (tmp_path / "a.gff").write_text("\n".join(gff) + "\n")
    row = annotation.gff3_to_genome_coor(readers.read_gff3(spark, str(tmp_path / "a.gff"))).first()
    assert (row.transcript_id, row.gene_name, row.type, len(row.exons)) == ("T.1", "N", "lncRNA", 2)


# ---- files


def test_files_round_trip(spark, tmp_path):
    r = spark.createDataFrame(TAB, READS)
    writers.write_tab(r, f"{tmp_path}/tab")
    back = readers.read_tab(spark, f"{tmp_path}/tab")
    key = lambda df: sorted((x.contig, x.strand, tuple((g["first"], g["second"]) for g in x.regions)) for x in df.collect())
    assert key(back) == key(r)
    g = spark.createDataFrame([("chr2", "+", 1, 5, 0.5), ("chr1", "-", 1, 5, None), ("chr1", "+", 10, 5, 0.25), ("chr1", "+", 2, 5, 0.1)], "contig string, strand string, pos long, n_bd long, shape double")
    writers.write_gtab(g, f"{tmp_path}/gtab")
    assert sorted(map(tuple, readers.read_gtab(spark, f"{tmp_path}/gtab").collect()), key=str) == sorted(map(tuple, g.collect()), key=str)
    (tmp_path / "a.fq").write_text("".join(f"@r{i} x\nACGT{'A' * i}\n+\n{'I' * (4 + i)}\n" for i in range(5)))
    assert [(x.id, x.key, len(x.seq)) for x in readers.read_fastq(spark, str(tmp_path / "a.fq")).orderBy("id").collect()] == [(i, f"@r{i} x", 4 + i) for i in range(5)]
    (tmp_path / "a.fa").write_text(">a one two\nACG\nTT\n>b\nGG\n>a again\nCC\n")
    assert {(x.id, x.annotation, x.seq) for x in readers.read_fasta(spark, str(tmp_path / "a.fa")).collect()} == {("a", "again", "CC"), ("b", "", "GG")}
    writers.write_fasta(spark.createDataFrame([("z", "ACGTACG")], "id string, seq string"), f"{tmp_path}/fa", width=3)
    assert [x.seq for x in readers.read_fasta(spark, f"{tmp_path}/fa").collect()] == ["ACGTACG"]
    (tmp_path / "a.sam").write_text("@SQ\tSN:c\tLN:99\nr\t16\tc\t5\t255\t3M\t*\t0\t0\tACG\tIII\tNH:i:2\tMD:Z:0A2\n")
    s = readers.read_sam(spark, str(tmp_path / "a.sam")).first()
    assert (s.flag, s.pos, s.tags["NH"], s.tags["MD"]) == (16, 5, "2", "0A2") and readers.read_sam_header(spark, str(tmp_path / "a.sam")).first().length == 99
    (tmp_path / "a.dot").write_text(">x\nGGAACC\n((..))\n>y\nA\n.\n")
    assert {(x.id, x.seq, x.dot) for x in readers.read_dot(spark, str(tmp_path / "a.dot")).collect()} == {("x", "GGAACC", "((..))"), ("y", "A", ".")}
    shapes = spark.createDataFrame([("t", 3, [0.5, None, 1.0])], "transcript_id string, length long, scores array<double>")
    writers.write_shape(shapes, f"{tmp_path}/shape")
    assert list(readers.read_shape(spark, f"{tmp_path}/shape").first().scores) == [0.5, None, 1.0]
    (tmp_path / "m.tsv").write_text("0\t2\n2\t0\n")
    assert {(x.x, x.y, x.value) for x in readers.read_matrix(spark, str(tmp_path / "m.tsv")).collect()} == {(0, 1, 2.0), (1, 0, 2.0)}


def test_collapse(spark):
    fq = spark.createDataFrame([(i, f"@r{i}", s, "+", "II") for i, s in enumerate(["AC", "GT", "AC", "AC"], 1)], "id long, key string, seq string, tag string, qual string")
    unique, freq = reads.collapse_reads(fq)
    assert {(r.id, r.seq) for r in unique.collect()} == {(1, "AC"), (2, "GT")} and [tuple(r) for r in freq.collect()] == [("AC", 3), ("GT", 1)]


def test_quality_trim(spark):
    q = "I" * 13 + "I" * 30 + "#" * 10
    fq = spark.createDataFrame([(1, "@a", "A" * 53, "+", q), (2, "@b", "A" * 30, "+", "I" * 30)], "id long, key string, seq string, tag string, qual string")
    assert [(r.id, len(r.seq), len(r.qual)) for r in reads.quality_trim(fq).collect()] == [(1, 30, 30)]


# ---- duplexes and matrices


def test_islands_do_not_change_greedy_groups(spark):
    rng = random.Random(1)
    rows = [(f"r{i}", "c", "+", s, s + 19, "c", "+", t, t + 19) for i in range(120) for s, t in [(rng.randrange(1, 900), rng.randrange(2000, 2060))]]
    hangs = spark.createDataFrame(rows, "read_id string, " + ", ".join(f"{c} {'string' if c[0] == 'c' or c.startswith('strand') else 'long'}" for c in duplex.ARMS))
    groups, members = duplex.cluster_hangs(hangs)
    want: list = []
    for r in sorted(rows, key=lambda r: (r[3], r[4], r[7], r[8], r[0])):
        for g in want:
            if min(g[1], r[4]) - max(g[0], r[3]) + 1 >= 5 and min(g[3], r[8]) - max(g[2], r[7]) + 1 >= 5:
                g[:4] = [max(g[0], r[3]), min(g[1], r[4]), max(g[2], r[7]), min(g[3], r[8])]
                g[4] += 1
                break
        else:
            want.append([r[3], r[4], r[7], r[8], 1])
    assert sorted([x.start_1, x.end_1, x.start_2, x.end_2, x.support] for x in groups.collect()) == sorted(want)
    assert members.count() == 120
    scored = duplex.group_score(groups, hangs).first()
    assert abs(scored.score - scored.support / 2 * (1 / (scored.left_cov + 1) + 1 / (scored.right_cov + 1))) < 1e-12


def test_contact_matrix_is_symmetric(spark):
    rows = [("a", "c", "+", 1, 3, "c", "+", 10, 11), ("b", "c", "+", 1, 3, "c", "+", 10, 11)]
    hangs = spark.createDataFrame(rows, "read_id string, " + ", ".join(f"{c} {'string' if c[0] == 'c' or c.startswith('strand') else 'long'}" for c in duplex.ARMS))
    cells = {(r.x, r.y): r.value for r in matrix.contact_matrix(hangs).collect()}
    assert len(cells) == 12 and set(cells.values()) == {2.0} and all((y, x) in cells for x, y in cells)
    aln = spark.createDataFrame([("s", "A-CG.U")], "id string, aligned string")
    assert [(r.raw_pos, r.aln_pos) for r in matrix.alignment_coords(aln).orderBy("raw_pos").collect()] == [(1, 1), (2, 3), (3, 4), (4, 6)]
