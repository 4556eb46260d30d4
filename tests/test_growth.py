"""What has to stay bounded when tables grow: plans that broadcast nothing unproven, candidates of joins, lists of open groups."""

from __future__ import annotations

import random
import time
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from probewell.functions import sequence
from probewell.operators import chimera, coords, duplex, matrix, pileup, qc, reads, scan, score, tracks
from probewell.plans import adapters, queries, registry  # noqa: F401 - queries are registered

from .test_large_groups import literal_calls


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_structures_are_never_broadcast(spark):
    shapes = spark.range(3).select(F.concat(F.lit("t"), "id").alias("transcript_id"), F.lit(4).cast("long").alias("length"), F.expr("array(0.1D, null, 0.9D, 0.2D)").alias("scores"))
    dots = spark.range(3).select(F.concat(F.lit("t"), "id").alias("id"), F.lit("ACGU").alias("seq"), F.lit("(..)").alias("dot"))
    access = dots.select("id", F.explode(F.sequence(F.lit(1), F.lit(4))).alias("pos")).withColumn("value", F.lit(9.0))
    for given in (None, access):
        found = qc.evaluate_structure(shapes, dots, given)
        assert "BroadcastHashJoin" not in _plan(found)
        assert [(r.positives, r.negatives) for r in found.orderBy("transcript_id").collect()] == [(6, 3)] + [(2, 1)] * 3


def _intervals(spark, rng, n, longest, prefix):
    rows = []
    for i in range(n):
        first = rng.randint(1, 40_000)
        rows.append(("c1", rng.choice("+-"), first, first + rng.randint(0, rng.choice(longest)), f"{prefix}{i}"))
    return spark.createDataFrame(rows, f"contig string, strand string, first long, second long, {prefix} string"), rows


def test_interval_join_of_short_and_long_intervals_equals_brute_force(spark):
    rng = random.Random(3)
    left, a = _intervals(spark, rng, 300, [0, 40, 3000, 30_000], "x")
    right, b = _intervals(spark, rng, 300, [0, 90, 900, 39_000], "y")
    want = sorted((p[4], q[4]) for p in a for q in b if p[1] == q[1] and p[2] <= q[3] and q[2] <= p[3])
    for bin in (16, 128, 100_000):
        assert sorted((r.x, r.y) for r in coords.interval_join(left, right, bin).select("x", "y").collect()) == want
    narrow = left.withColumn("second", F.col("first"))
    want = sorted((p[4], q[4]) for p in a for q in b if p[1] == q[1] and q[2] <= p[2] <= q[3])
    assert sorted((r.x, r.y) for r in coords.interval_join(narrow, right, widest=1).select("x", "y").collect()) == want


def test_interval_join_compares_few_pairs_that_do_not_overlap(spark):
    """A bin of 100,000 bases compared every place with every exon in it: here 20,000 x 6,000 pairs."""
    key = ["contig", "strand"]
    points = spark.range(20_000).select(F.lit("c").alias("contig"), F.lit("+").alias("strand"), F.col("id").alias("first"), F.col("id").alias("second"))
    exons = spark.range(6_000).select(F.lit("c").alias("contig"), F.lit("+").alias("strand"), (F.col("id") * 3).alias("first"), (F.col("id") * 3 + 60).alias("second"))
    met = []
    joined = coords.interval_join(points, exons)
    for side in (points, exons):
        bins = coords._spread(side, coords.BIN, [(0, 0, F.lit(True))])
        met.append(bins.groupBy(*key, "bin").agg(F.count("*").alias(f"n{len(met)}")))
    compared = met[0].join(met[1], [*key, "bin"]).agg(F.sum(F.col("n0") * F.col("n1"))).first()[0]
    assert compared < 5 * joined.count()


def test_long_contig_is_laid_out_in_time_that_grows_with_it(spark):
    n = 60_000
    gtab = spark.range(1, n + 1).where("id % 3 <> 0").select(F.lit("c").alias("contig"), F.lit("+").alias("strand"), F.col("id").alias("pos"), F.lit(2).cast("long").alias("rt"), F.lit(300).cast("long").alias("bd"), (F.col("id") / n).alias("shape"))
    sizes = spark.createDataFrame([("c", n + 5)], "contig string, length long")
    began = time.time()
    row = coords.shape_contig_mode(gtab, sizes).first()
    assert time.time() - began < 60
    assert row.scores == [None if i % 3 == 0 or i > n else i / n for i in range(1, n + 6)]
    assert abs(row.rt - 80_000 / (n + 5)) < 1e-9


def test_conversion_counts_each_base_once_under_many_genes(spark):
    gtab = spark.range(1, 101).select(F.lit("c").alias("contig"), F.lit("+").alias("strand"), F.col("id").alias("pos"))
    span = "gene_id string, contig string, strand string, first long, second long"
    genes = spark.createDataFrame([(f"g{i}", "c", "+", 11 + i % 3, 60) for i in range(30)], span)
    exons = spark.createDataFrame([(f"g{i}", "c", "+", 21, 30 + i % 2) for i in range(30)], span)
    found = {(r.contig, r.exon, r.intron, r.intergenic) for r in coords.conversion_summary(gtab, genes, exons).collect()}
    assert found == {("c", 11, 39, 50), (None, 11, 39, 50)}


def _hangs(spark, rng, n, span):
    rows = []
    for i in range(n):
        a, b = rng.randint(1, span), rng.randint(1, span)
        rows.append((f"r{i}", "c1", "+", a, a + rng.randint(0, 40), "c1", rng.choice("++-"), b, b + rng.randint(0, 40)))
    return spark.createDataFrame(rows, "read_id string, " + ", ".join(f"chr_{i} string, strand_{i} string, start_{i} long, end_{i} long" for i in (1, 2))), rows


def test_packed_cells_equal_cells_one_by_one(spark):
    hangs, rows = _hangs(spark, random.Random(5), 60, 90)
    want = Counter((p, q) for r in rows if r[2] == r[6] for x in range(r[3], r[4] + 1) for y in range(r[7], r[8] + 1) for p, q in ((x, y), (y, x)))
    coo = matrix.contact_matrix(hangs)
    assert {(r.x, r.y): r.value for r in coo.collect()} == want
    assert {(r.x, r.y): r.value for r in matrix.cells(matrix.blocks(coo)).collect()} == want


def test_cells_are_not_shuffled(spark):
    hangs, _ = _hangs(spark, random.Random(6), 40, 5_000)
    size = spark.createDataFrame([("c1", 5_100)], "contig string, length long")
    coo = matrix.contact_blocks(hangs)
    seqs = spark.createDataFrame([("c1", "ACGTU" * 1_020)], "contig string, seq string")
    places = matrix.alignment_coords(spark.createDataFrame([("c1", "ACG-" * 1_800)], "id string, aligned string"), tile=1 << 10)
    packed = {"quantile": matrix.background_quantile(coo, size, 0.99), "masked": matrix.matrix_mask_noncanonical(coo, seqs), "expanded": matrix.matrix_expand(coo, places)}
    plain = matrix.cells(coo)
    one = {"quantile": matrix.background_quantile(plain, size, 0.99), "masked": matrix.matrix_mask_noncanonical(plain, seqs), "expanded": matrix.matrix_expand(plain, places)}
    for name, found in packed.items():
        joins = [line for line in _plan(found).splitlines() if "Join" in line]
        assert len(joins) == 2 and not any("BroadcastHashJoin" in j or "BroadcastNestedLoopJoin" in j for j in joins), name
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, one[name].collect())), name
    assert [(r.raw_pos, r.aln_pos) for r in places.orderBy("raw_pos").collect()] == [(k + 1, k + k // 3 + 1) for k in range(5_400)]


def test_clusters_of_one_long_island_equal_the_plain_search(spark):
    rng = random.Random(8)
    rows = [(f"r{i:05}", "c1", "+", 3 * i, 3 * i + rng.randint(9, 30), "c2", "+", b := rng.randint(1, 120), b + rng.randint(9, 30)) for i in range(400)]
    hangs = spark.createDataFrame(rows, "read_id string, " + ", ".join(f"chr_{i} string, strand_{i} string, start_{i} long, end_{i} long" for i in (1, 2)))
    for multi in (False, True):
        groups = []
        for read, _, _, a, b, _, _, c, d in sorted(rows, key=lambda r: (r[3], r[4], r[7], r[8], r[0])):
            hit = [g for g in groups if min(g[1], b) - max(g[0], a) + 1 >= 5 and min(g[3], d) - max(g[2], c) + 1 >= 5]
            for g in hit if multi else hit[:1]:
                g[:4] = [max(g[0], a), min(g[1], b), max(g[2], c), min(g[3], d)]
                g[4].append(read)
            if not hit:
                groups.append([a, b, c, d, [read]])
        members = {}
        for r in duplex.cluster_hangs(hangs, multi=multi)[1].collect():
            members.setdefault(r.group_id, []).append(r.read_id)
        assert sorted(map(sorted, members.values())) == sorted(sorted(g[4]) for g in groups)


def test_clustering_leaves_groups_behind(spark):
    """30,000 hangs of one island: each was held against all groups before it, 450 million pairs."""
    hangs = spark.range(30_000).select(F.col("id").cast("string").alias("read_id"), *[c for i, at in ((1, F.col("id") * 3), (2, F.col("id") * 6007 % 100_003)) for c in (F.lit("c").alias(f"chr_{i}"), F.lit("+").alias(f"strand_{i}"), at.alias(f"start_{i}"), (at + 12).alias(f"end_{i}"))])
    began = time.time()
    assert duplex.cluster_hangs(hangs)[0].count() > 29_000
    assert time.time() - began < 60


def test_overlapping_junctions_of_a_whole_contig(spark):
    n = 30_000
    junctions = spark.range(n).select(F.lit("c").alias("contig"), F.lit("+").alias("strand"), (F.col("id") * 3 + 1).alias("first"), (F.col("id") * 3 + 100).alias("second"), (F.col("id") % 50).alias("support"))
    sizes = spark.createDataFrame([("c", 4 * n)], "contig string, length long")
    kept = []
    for i in range(n):
        row = (i * 3 + 1, i * 3 + 100, i % 50)
        if not kept or row[0] > kept[-1][1]:
            kept.append(row)
        elif row[2] > kept[-1][2]:
            kept[-1] = row
    assert all(b[0] > a[1] + 1 for a, b in zip(kept, kept[1:]))
    found = pileup.combine_junctions(junctions, sizes)
    assert sorted((r.first, r.second, r.support) for r in found.collect()) == kept


def test_a_table_not_proven_small_is_joined_by_shuffle(spark):
    rows = spark.range(20).select("id", F.lit("a").alias("type"))
    assert "BroadcastHashJoin" in _plan(rows.join(pileup.small(rows), "id"))
    assert "BroadcastHashJoin" not in _plan(rows.join(pileup.small(rows, limit=5), "id"))


def _reads(spark, rng, n, span):
    rows = []
    for i in range(n):
        first = rng.randint(1, span)
        second = first + rng.randint(0, 40)
        rows.append((f"c{i % 2}", rng.choice("+-"), rng.choice("ND"), [(first, second)] if i % 3 else [(first, second), (second + 90, second + 120)]))
    return spark.createDataFrame(rows, "contig string, strand string, condition string, regions array<struct<first:bigint,second:bigint>>"), rows


def test_counts_of_both_conditions_equal_brute_force_across_tiles(spark):
    reads, rows = _reads(spark, random.Random(11), 300, 900)
    sizes = spark.createDataFrame([("c0", 700), ("c1", 2_000)], "contig string, length long")
    want = {}
    for contig, strand, condition, regions in rows:
        length = 700 if contig == "c0" else 2_000
        stop = regions[0][0] - 1 if strand == "+" else regions[-1][1] + 1
        places = [(p, "bd") for a, b in regions for p in range(a, min(b, length) + 1)] + [(stop, "rt")] * (stop <= length)
        for p, c in places:
            want.setdefault((contig, strand, p), Counter())[f"{condition.lower()}_{c}"] += 1
    for tile in (64, 1 << 14):
        kinds = {k: F.col("condition") == k.upper() for k in "nd"}
        found = pileup._piled(reads, sizes, None, "condition", (), kinds, tile).collect()
        assert {(r.contig, r.strand, r.pos): +Counter({c: r[c] for c in ("n_rt", "n_bd", "d_rt", "d_bd")}) for r in found} == want and len(found) == len(want)
    long = pileup.count_rt(reads.withColumnRenamed("condition", "sample"), sizes).collect()
    assert {(r.contig, r.strand, r.pos, r.sample): (r.rt, r.bd) for r in long} == {(*k, s): (v[f"{s.lower()}_rt"], v[f"{s.lower()}_bd"]) for k, v in want.items() for s in "ND" if v[f"{s.lower()}_rt"] or v[f"{s.lower()}_bd"]}


def test_places_are_spread_last_and_counted_once(spark):
    """A task spread a million places, summed them by place, and all of it ran again for every use."""
    reads, _ = _reads(spark, random.Random(12), 30, 300)
    sizes = spark.createDataFrame([("c0", 700), ("c1", 700)], "contig string, length long")
    counts = pileup.condition_counts(reads, sizes)
    assert pileup.TILE <= 1 << 16
    plan = _plan(counts)
    assert plan.index("explode(sequence(pos") < plan.index("Exchange") and plan.count("explode(sequence(pos") == 1
    scored = score.enrich_ctrl(counts)
    for done in (score.winsorize(scored, "score", ["contig", "strand"]), score.sink_score(scored, "score", ["contig", "strand"], 0.3)):
        assert "explode" not in _plan(done) and "SortMergeJoin" not in _plan(done)
    long = pileup.count_rt(reads.withColumnRenamed("condition", "sample"), sizes)
    assert "explode" not in _plan(qc.rt_replicate_corr(long, min_bd=1, win=5))


def test_normalising_transcripts_shuffles_no_place(spark):
    """All places of all transcripts were exploded and counted in one task."""
    rng = random.Random(13)
    rows = [(f"t{i}", n := rng.randint(20, 90), "1", [rng.choice([None, 0.0, 3.0, 7.5, 40.0]) for _ in range(n + 1)], [float(rng.randint(0, 12)) for _ in range(n + 1)]) for i in range(40)]
    rt = spark.createDataFrame(rows, "transcript_id string, length long, rpkm string, bd array<double>, rt array<double>")
    assert "Exchange" not in _plan(tracks.normalize_rt(rt))
    long = rt.select("transcript_id", F.explode("bd").alias("x"))
    for sample, calc in (("smart", "median"), ("upper", "mean"), ("quartile", "peak"), ("decile", "median"), ("vigintile", "mean")):
        want = {r.transcript_id: round(r.factor, 9) for r in score.scaling_factor(long, "x", ["transcript_id"], sample, 2, calc).collect()}
        assert {r.transcript_id: round(r.f, 9) for r in rt.select("transcript_id", score.array_factor(F.col("bd"), sample, 2, calc).alias("f")).collect()} == want, (sample, calc)


def test_overlapping_junctions_share_their_windows(spark, monkeypatch):
    """Each junction had its own copy of the counts and of the windows: 200 junctions of 300 places are 60,000 rows of 500 places."""
    rng = random.Random(14)
    rows = [("c", "+", p, rng.randint(0, 4), rng.randint(20, 90), rng.randint(0, 3), rng.choice([0, 5, 60, 90]) if p > 400 else 80, rng.choice("ACGT")) for p in range(1, 501)]
    counts = spark.createDataFrame(rows, "contig string, strand string, pos long, n_rt long, n_bd long, d_rt long, d_bd long, base string")
    junctions = spark.createDataFrame([("c", "+", a, a + rng.randint(90, 140)) for a in range(2, 300, 7)], "contig string, strand string, first long, second long")
    for options in ({"grid": "fixed"}, {"grid": "exact"}, {"grid": "fixed", "sub": (0.0, 0.5)}, {"grid": "exact", "bases": "AU", "min_cov": 20}):
        run = lambda n: sorted(tuple(r) for r in score.sliding_junction(counts, junctions, wsize=60, wstep=7, stretch=n, min_rt=0.1, **options).fillna(-1.0, ["score"]).selectExpr("contig", "strand", "pos", "n_rt", "d_bd", "round(score, 9)", "n_windows", "valid_count").collect())  # noqa: B023, E731
        assert run(256) == run(1), options
    monkeypatch.setattr(score, "interval_join", None)  # no place is joined with the junctions around it
    assert score.sliding_junction(counts, junctions, wsize=60, wstep=7).count() > 1_000


def test_contig_sizes_are_found_once(spark):
    reads, _ = _reads(spark, random.Random(15), 30, 300)
    assert "Aggregate" not in _plan(adapters.sizes(reads))


def test_alignments_are_parsed_once_for_each_record(spark):
    """Every pair parsed both of its CIGARs again, and records were numbered anew for each side."""
    rows = [(f"r{i % 20}", 16 * (i % 3 == 0), f"c{i % 2}", 100 * i, f"{20 + i % 9}M{35 - i % 9}S" if i % 4 else f"{30 - i % 9}S{25 + i % 9}M", "ACGTA" * 11, "I" * 55) for i in range(120)]
    sam = spark.createDataFrame(rows, "read_id string, flag int, chr_id string, pos long, cigar string, seq string, qual string")
    gapped, plain = chimera.sam_group_trim(sam)
    for found in (chimera.group_read_pair(chimera.read_pairs(sam)), chimera.sam_trim(sam), gapped):
        assert r"([MIDNSHP=X])" not in _plan(found) and "BroadcastHashJoin" not in _plan(found)
    plain_pairs = chimera.read_pairs(sam).drop("_x_a", "_x_b")
    assert sorted(map(tuple, chimera.group_read_pair(plain_pairs).fillna("").collect()), key=str) == sorted(map(tuple, chimera.group_read_pair(chimera.read_pairs(sam)).fillna("").collect()), key=str)


def test_scattered_cells_do_not_join_what_is_called(spark):
    """Weak cells all over a matrix made one piece of it, however far the cells of ``perceive`` lay apart."""
    rng = random.Random(12)
    n, dist, win, most, perceive, extend = 900, 20, 10, 40, 9.0, 1.0
    value = np.zeros((n, n))
    for _ in range(9_000):
        x, y = rng.randint(0, n - 1), rng.randint(0, n - 1)
        value[y, x] = rng.choice([1.0, 2.5, 4.0])
    for x, y in ((60, 300), (75, 330), (95, 360), (300, 800), (310, 801), (2, 500), (500, 650)):
        value[y : y + 6, x : x + 4] += rng.choice([9.0, 11.0])
    cells = [("c", "+", int(x) + 1, int(y) + 1, float(value[y, x])) for y, x in zip(*np.nonzero(value), strict=True)]
    coo = spark.createDataFrame(cells, "contig string, strand string, x long, y long, value double")
    size = spark.createDataFrame([("c", n)], "contig string, length long")
    want = literal_calls(value, dist, win, most, perceive, extend)
    assert len(want) > 4
    for given in (coo, matrix.blocks(coo)):
        got = matrix.call_interactions(given, size, dist, win, most, perceive, extend).collect()
        assert sorted(tuple(r)[2:] for r in got) == want
        pieces = Counter(r.piece for r in matrix._pieces(given, win + dist, most, perceive, extend).collect())
        assert len(pieces) >= 4 and max(pieces.values()) < len(cells) / 10


def test_components_of_a_chain_and_of_single_nodes(spark):
    chain = [("a", i, i + 1) for i in range(40)] + [("a", i, i) for i in range(41)] + [("b", 7, 7), ("b", 3, 9), ("b", 9, 3), ("b", 9, 77)]
    found = scan.components(spark.createDataFrame(chain, "k string, u long, v long"), ["k"])
    assert {tuple(r) for r in found.collect()} == {("a", i, 0) for i in range(41)} | {("b", 7, 7), ("b", 3, 3), ("b", 9, 3)}


def test_bases_apart_in_one_pass(spark):
    """Each base was a run of its own, and its windows were scored one by one."""
    rows = spark.range(1, 901).select(F.lit("c").alias("contig"), F.lit("+").alias("strand"), F.col("id").alias("pos"), *[(F.col("id") * p % 37 + least).alias(c) for c, p, least in (("n_rt", 5, 1), ("n_bd", 11, 200), ("d_rt", 17, 0), ("d_bd", 23, 90))], F.expr("substr('ACGU', cast((id * 7 + id div 5) % 4 as int) + 1, 1)").alias("base"))
    sizes = spark.createDataFrame([("c", 900)], "contig string, length long")
    for grid, tile in (("fixed", 300), ("exact", 20_000)):
        run = lambda b: score.sliding_score(rows, sizes, grid=grid, wsize=100, wstep=20, out_min_cov=0, min_cov=60, bases=b, tile=tile)  # noqa: B023, E731
        want = score.separate_bases(lambda b: run(b).withColumn("base", F.lit(b)), "ACGU").collect()  # noqa: B023
        got = run(tuple("ACGT")).collect()
        assert sorted(got, key=lambda r: r.pos) == sorted(want, key=lambda r: r.pos) and len(got) == len({r.pos for r in got}) > 700
        assert sum(r.score is not None for r in got) > 500


def test_masked_windows_are_scored_together():
    rng = np.random.default_rng(5)
    n, w = 20_000, 100
    counts = [rng.integers(least, 60, (n, w)) for least in (1, 20, 0, 20)]
    mask = rng.random((n, w)) < 0.25
    mask[7] = False
    began = time.time()
    got = score.score_windows(*counts, mask=mask, mask_bd=25)
    control = score.score_windows_noctrl(*counts[::3], mask=mask, mask_bd=25, sink=0.1)
    assert time.time() - began < 4
    for i in (0, 7, 11, 19_999):
        want, m = np.full(w, np.nan), mask[i]
        if m.any():
            want[m] = score.score_windows(*(c[i : i + 1, m] for c in counts), min_bd=25, min_rt=0.0, low_bd=-1)[0]
        np.testing.assert_array_equal(got[i], want)
        if m.any():
            want[m] = score.score_windows_noctrl(*(c[i : i + 1, m] for c in counts[::3]), min_bd=25, min_rt=0.0, low_bd=-1, sink=0.1)[0]
        np.testing.assert_array_equal(control[i], want)


def test_quality_trim_equals_a_plain_loop(spark):
    """Each window of each read was a chain of array lookups; 400,000 windows took longer than a second."""
    rng = random.Random(7)
    quals = ["", None, "5", "#", "I" * 47, "#" * 47, "é€" * 20] + ["".join(chr(33 + min(40, max(0, int(rng.gauss(24, 9))))) for _ in range(rng.randint(0, 60))) for _ in range(9_000)]

    def plain(q, trailing, window, window_q):
        codes = [ord(c) - 33 for c in q or ""]
        while codes and codes[-1] < trailing:
            codes.pop()
        for i in range(len(codes) - window + 1):
            if sum(codes[i : i + window]) < window * window_q:
                return next(k for k in range(i, i + window) if codes[k] < window_q)
        return len(codes)

    for options in ((20, 4, 15), (10, 1, 22), (25, 7, 24)):
        began = time.time()
        got = reads.kept_letters(pd.Series(quals), *options).tolist()
        assert time.time() - began < 1
        assert got == [plain(q, *options) for q in quals]
    fq = spark.createDataFrame([(i, "A" * (len(q or "") + 2), q and "~~" + q) for i, q in enumerate(quals[:300])], "id long, seq string, qual string")
    found = {r.id: (len(r.seq), r.qual) for r in reads.quality_trim(fq, leading=2, min_len=20).collect()}
    assert found == {i: (n, q[:n]) for i, q in enumerate(quals[:300]) if (n := plain(q, 20, 4, 15)) >= 20}


def test_qualities_of_texts(spark, tmp_path):
    spark.createDataFrame([(i, "abcXYZ " * (i * 9)) for i in range(14)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = adapters.fastq(spark, str(tmp_path)).collect()
    assert {len(r.seq) for r in rows} >= {0, 60, 54}
    assert all(r.qual == "".join(chr(73 - i // 3 - (i * 7 + r.id) % 11) for i in range(1, len(r.seq) + 1)) for r in rows)


def test_counts_are_summed_in_batches_and_shuffled_once(spark):
    """The sums of a whole input split were held by one task, and their sums again by another."""
    reads_ = spark.range(30_000).select(F.lit("c").alias("contig"), F.lit("+").alias("strand"), F.when(F.col("id") % 3 == 0, "D").otherwise("N").alias("condition"), F.expr("array(struct(10L + id % 2 * 40000 as first, 90L + id % 2 * 40000 as second))").alias("regions"))
    sizes = spark.createDataFrame([("c", 50_000)], "contig string, length long")
    batched = pileup.summed_in_batches(reads_.coalesce(1).select("contig", "condition", F.col("regions")[0]["first"].alias("pos"), F.lit(1).cast("long").alias("n")), ["n"], batch=8_000)
    found = batched.collect()
    assert len(found) <= 4 * 5 and sum(r.n for r in found) == 30_000
    counts = pileup.condition_counts(reads_, sizes)
    assert _plan(counts).count("Exchange hashpartitioning") == 1
    assert {(r.pos, r.n_rt, r.n_bd, r.d_rt, r.d_bd) for r in counts.collect()} == {(p + at, *((10_000, 0, 5_000, 0) if at == 9 else (0, 10_000, 0, 5_000))) for p in (0, 40_000) for at in range(9, 91)}
    assert pileup._tasks(spark.createDataFrame([("c", 1 << 30), ("d", 5)], "contig string, length long"), 1 << 14) == 4096


def test_places_of_long_genes_are_dealt_over_tasks(spark, tmp_path):
    """Stretches are a few bytes for many places: a shuffle without a number was coalesced to one task."""
    spark.createDataFrame([(k, 2 * (k % 9) + k // 9 % 2, f"B{k % 3}") for k in range(900)], "p_partkey long, p_size int, p_brand string").write.parquet(str(tmp_path / "part.parquet"))
    found = registry.QUERIES["gene_to_genome"](spark, str(tmp_path))
    assert sum(n > 0 for n in found.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()) > 1
    genes = {}
    for t in adapters.transcripts(spark, str(tmp_path)).collect():
        a, b = genes.get(t.gene_id, (t.contig, t.strand, 10**9, 0))[2:]
        genes[t.gene_id] = (t.contig, t.strand, min(a, *[e["first"] for e in t.exons]), max(b, *[e["second"] for e in t.exons]))
    want = sorted((g, i + 1, c, s, a + i if s == "+" else b - i) for g, (c, s, a, b) in genes.items() for i in range(b - a + 1))
    assert sorted(tuple(r) for r in found.collect()) == want


def test_stretches_of_genes_equal_their_points(spark):
    genes = spark.createDataFrame([("g", "c", "+", 101, 350), ("h", "c", "-", 7, 7), ("i", "d", "-", 1, 200)], "gene_id string, contig string, strand string, first long, second long")
    points = genes.select("gene_id", F.explode(F.sequence(F.lit(1).cast("long"), F.col("second") - F.col("first") + 1)).alias("g_pos"))
    want = sorted(tuple(r) for r in coords.gene_to_genome(points, genes).collect())
    assert len(want) == 451 and ("i", 1, "d", "-", 200) in want and ("g", 250, "c", "+", 350) in want
    for width in (1, 7, 100, 1000):
        assert sorted(tuple(r) for r in coords.gene_to_genome(coords.gene_stretches(genes, width), genes).collect()) == want
    beyond = spark.createDataFrame([("g", -3, 2, "x"), ("g", 249, 900, "y"), ("h", 2, 5, "z"), ("none", 1, 2, "z")], "gene_id string, g_first long, g_second long, tag string")
    assert sorted((r.g_pos, r.tag, r.pos) for r in coords.gene_to_genome(beyond, genes).collect()) == [(1, "x", 101), (2, "x", 102), (249, "y", 349), (250, "y", 350)]


def test_group_scores_equal_a_plain_count_and_spread_no_place(spark, monkeypatch):
    """Each place of each arm was a row with its group's id, joined with the coverage of each place."""
    rng = random.Random(12)
    arm = lambda: (rng.choice(["c", "d"]), rng.choice("+-"), *(lambda a: (a, a + rng.choice([0, 3, 20, 70])))(rng.randint(1, 900)))
    rows = [(f"r{i}", *arm(), *arm()) for i in range(1500)] + [("none", None, "+", 5, 9, "c", None, 5, 9)] + [(f"p{i}", "c", "+", 60, 70, "d", "-", 128, 200) for i in range(300)]
    schema = "read_id string, " + ", ".join(f"{c} {'string' if c[0] == 'c' or c.startswith('strand') else 'long'}" for c in duplex.ARMS)
    hangs = spark.createDataFrame(rows, schema)
    asked = [(f"g{i}", *arm(), *arm(), rng.randint(1, 9)) for i in range(700)] + [("long", "c", "+", 1, 640, "d", "-", 300, 1500, 4), ("far", "c", "+", 5000, 5010, "x", "+", 1, 9, 2), ("null", None, "+", 60, 70, "d", "-", None, 200, 2)]
    groups = spark.createDataFrame(asked, schema.replace("read_id", "group_id") + ", support long")
    depth = Counter((r[k], r[k + 1], p) for r in rows for k in (1, 5) for p in range(r[k + 2], r[k + 3] + 1))
    cover = lambda c, s, a, b: 0 if None in (c, s, a, b) else max(depth[c, s, p] for p in range(a, b + 1))
    monkeypatch.setattr(duplex, "COVERED", 16)
    monkeypatch.setattr(duplex, "BLOCK", 64)
    monkeypatch.setattr(duplex, "PACKED", 256)
    for part in (groups, groups.where("group_id <> 'long'")):
        scored = duplex.group_score(part, hangs)
        assert "sequence(" not in _plan(scored) and scored.columns == ["group_id", *duplex.ARMS, "support", "left_cov", "right_cov", "score"]
        got = {r.group_id: r for r in scored.collect()}
        assert len(got) == part.count()
        for g in asked:
            if g[0] in got:
                left, right = cover(*g[1:5]), cover(*g[5:9])
                assert tuple(got[g[0]])[:12] == (*g, left, right)
                assert abs(got[g[0]].score - g[9] / 2 * (1 / (left + 1) + 1 / (right + 1))) < 1e-12


def test_groups_are_counted_where_they_are_made(spark):
    """The rows of all members were shuffled again to count them."""
    groups, members = duplex.cluster_hangs(_hangs(spark, random.Random(5), 200, 400)[0])
    assert _plan(groups).count("Exchange hashpartitioning") == _plan(members).count("Exchange hashpartitioning")
    counted = Counter(r.group_id for r in members.collect())
    assert {r.group_id: r.support for r in groups.collect()} == counted and groups.count() == len(counted)


def _protein(text):
    text = (text or "").upper().replace("U", "T")
    codons = [text[i : i + 3] for i in range(0, len(text) - 2, 3)]
    return "".join(sequence._AMINO[16 * "TCAG".index(c[0]) + 4 * "TCAG".index(c[1]) + "TCAG".index(c[2])] if set(c) <= set("TCAG") else "X" for c in codons)


def test_codons_equal_a_plain_loop(spark):
    rng = random.Random(13)
    texts = [None, "", "A", "AC", "ACG", "acguuN", "T T", "\u00e9TG\u00dfCA", "AT\U0001f600GGG", "TCAG" * 900]
    texts += ["".join(rng.choices("TCAGUtcagu" + rng.choice(["", "N", "-*", "\u00e9\u0130"]), k=rng.randint(0, 90))) for _ in range(800)]
    for n in (1, 4):
        rows = spark.createDataFrame(list(enumerate(texts)), "id long, seq string").repartition(n)
        assert [r.p for r in rows.select("id", sequence.translate_codons("seq").alias("p")).orderBy("id").collect()] == [_protein(t) for t in texts]
    kept = rows.where(F.length("seq") > 3000).select(sequence.translate_codons("seq").alias("p"), F.length("seq").alias("n")).collect()
    assert [tuple(r) for r in kept] == [(_protein("TCAG" * 900), 3600)]


def test_codons_of_a_long_sequence_take_time_that_grows_with_it(spark):
    """The whole sequence was put in capitals again for each letter of each codon."""
    rows = spark.createDataFrame([("ACGTTGCAAC" * 3000,)], "seq string")
    rows.select(sequence.translate_codons("seq")).collect()  # without the start of a worker
    start = time.time()
    assert rows.select(sequence.translate_codons("seq").alias("p")).first().p == _protein("ACGTTGCAAC" * 3000)
    assert time.time() - start < 5
