"""Work on groups that no task holds: scans over range partitions, tile maps, islands; each against a literal model."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from probewell.operators import duplex, matrix, pileup, scan, score

PAIRS = [("c", "+", "d", "-"), ("c", "+", "c", "+")]
HANG = "read_id string, " + ", ".join(f"{c} {'string' if c[0] == 'c' or c.startswith('strand') else 'long'}" for c in duplex.ARMS)


@pytest.fixture(autouse=True)
def small_partitions(spark):
    """Keep the range partitions of small tables apart."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


# ---- scans


def test_before_carries_over_partitions(spark):
    rng = random.Random(4)
    rows = [(rng.choice([None, "a", "b"]), i, rng.choice([None, 1, 5, -3])) for i in range(300)]
    table = scan.ranged(spark.createDataFrame(rows, "g string, o int, v int"), ["g"], ["o"])
    assert table.select(scan.PART).distinct().count() > 1
    got = {(r.g, r.o): (r.n_v, r.max_v) for r in scan.before(table, ["g"], n_v=F.col("v"), max_v=F.col("v")).collect()}
    for g, o, _ in rows:
        prior = [v for h, p, v in rows if h == g and p < o and v is not None]
        assert got[g, o] == ((sum(prior), max(prior)) if prior else (None, None))


@pytest.mark.parametrize("by", [[], ["g"]])
def test_ranks_of_groups_that_lie_in_many_partitions(spark, by):
    rng = random.Random(5)
    rows = [("big" if i % 5 else "small", rng.choice([None, *[rng.gauss(0, 1) for _ in range(40)]])) for i in range(400)]
    frame = spark.createDataFrame(rows, "g string, v double")
    ranked = scan.ranks(frame.groupBy(*by, "v").agg(F.count("*").alias("c")), by, F.col("v").desc_nulls_last(), valued=F.when(F.col("v").isNotNull(), F.col("c")))
    key = lambda v: (v is None, -(v or 0))
    for r in ranked.collect():
        own = [v for g, v in rows if not by or g == r.g]
        assert (r.r, r.c, r.n, r.valued) == (sum(key(v) < key(r.v) for v in own), own.count(r.v), len(own), sum(v is not None for v in own))


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(("span", "longest", "groups", "gap"), [(3000, 60, ["x", None, "y"], 0), (3000, 9, ["x"], 3), (300, 400, ["x", "y"], 0), (100_000, 5, [str(k) for k in range(90)], 10), (20_000, 30, ["x", "y"], -1)])
def test_runs_are_counted_while_they_are_dealt(spark, span, longest, groups, gap):
    """The rows were shuffled four times more, to count what lies before each."""
    rng = random.Random(span)
    rows = [(rng.choice(groups), a, a + (rng.randrange(longest) if rng.random() < 0.97 else rng.randrange(span)), i) for i in range(400) for a in [rng.randrange(span)]]
    found = scan.runs(spark.createDataFrame(rows, "g string, a long, b long, i long"), ["g"], "a", "b", gap, ("i",))
    assert "hashpartitioning" not in plan_of(found) and found.columns == ["g", "a", "b", "i", "island"]
    want, last = {}, {}
    for g, a, b, i in sorted(rows, key=lambda r: r[1:]):
        reach, n = last.get(g, (None, 0))
        n += reach is None or a > reach + gap
        last[g] = b if reach is None else max(reach, b), n
        want[i] = n
    assert {r.i: r.island for r in found.collect()} == want


def test_runs_of_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        test_runs_are_counted_while_they_are_dealt(spark, 3000, 60, ["x", None, "y"], 0)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize(("sample", "index", "calc"), [("decile", 2, "median"), ("smart", 1, "mean"), ("upper", 1, "peak"), ("vigintile", 3, "mean"), ("quartile", 4, "median")])
def test_scaling_factor_of_continuous_values(spark, sample, index, calc):
    rng = random.Random(6)
    rows = [(g, rng.choice([None, 0.0, 0.0, rng.expovariate(0.1), rng.gauss(0, 1)])) for g in "ab" for _ in range(rng.randrange(150, 250))]
    got = {r.g: r.factor for r in score.scaling_factor(spark.createDataFrame(rows, "g string, v double"), "v", ["g"], sample, index, calc).collect()}
    parts = {"quartile": 4, "decile": 10, "vigintile": 20}
    for g in "ab":
        down = sorted((v for h, v in rows if h == g), key=lambda v: (v is None, -(v or 0)))
        n = len(down)
        lo, hi = {"smart": (0, n), "upper": (0, n // 2)}.get(sample) or ((index - 1) * n // parts[sample], index * n // parts[sample])
        taken = [v for v in down[lo:hi] if v is not None and (sample != "smart" or v > 0)]
        want = {"median": np.median, "mean": np.mean, "peak": np.max}[calc](taken) if taken else 1.0
        assert got[g] == pytest.approx(want)


def test_no_window_by_contig_alone(spark):
    rows = spark.createDataFrame([("c", "+", i, float(i)) for i in range(50)], "contig string, strand string, pos long, score double")
    plan = plan_of(score.winsorize(rows, "score", ["contig", "strand"]))
    over = [line for line in plan.splitlines() if "windowspecdefinition" in line]
    assert over and all("_part" in line for line in over)


# ---- whole contigs


@pytest.mark.parametrize("enrich", ["sub", "complex", "log"])
def test_whole_contigs_match_a_literal_model(spark, enrich):
    rng = np.random.default_rng(8)
    n = 300
    counts = {name: np.where(rng.random(n) < 0.8, rng.integers(0, 40, n), 0) for name in ("n_rt", "n_bd", "d_rt", "d_bd")}
    for name in counts:
        counts[name][[5, 6, 7, 100, 290]] = 0
    rows = [("c", "+", p, *(int(counts[k][p]) for k in counts)) for p in range(n) if any(counts[k][p] for k in counts)] + [("c", "+", n + 3, 1, 1, 1, 1), ("d", "-", 9, 1, 1, 1, 1)]
    frame = spark.createDataFrame(rows, "contig string, strand string, pos long, n_rt long, n_bd long, d_rt long, d_bd long")
    sizes = spark.createDataFrame([("c", n), ("d", 60), ("tiny", 10)], "contig string, length long")
    got = {(r.contig, r.pos): r for r in score.whole_contig_score(frame, sizes, enrich=enrich, min_bd=5, min_rt=0.5).collect()}
    assert len(got) == n - 1 + 59 and all(got["d", p].score is None for p in range(1, 60))
    w = {k: counts[k][: n - 30].astype(float) for k in counts}
    f = {}
    for k in w:
        down = -np.sort(-w[k])
        f[k] = np.median(down[len(down) // 10 : 2 * len(down) // 10]) or 1.0
    with np.errstate(all="ignore"):
        s = {"sub": w["n_rt"] / f["n_rt"] - 0.25 * w["d_rt"] / f["d_rt"], "complex": np.where(w["d_bd"] > 0, 10 * (w["n_rt"] / f["n_rt"] - 0.25 * w["d_rt"] / f["d_rt"]) / (w["d_bd"] / f["d_bd"]), np.nan), "log": np.where(w["d_bd"] > 0, np.log2((w["n_rt"] + 1) / (w["d_rt"] + 1)), np.nan)}[enrich]
    up = np.sort(s[~np.isnan(s)])
    cut = int(0.05 * len(up))
    lo, hi = max(up[cut], 0.0), up[len(up) - 1 - cut]
    for p in range(1, n):
        want = None if p <= 5 or p >= n - 30 or np.isnan(s[p]) else min(max((s[p] - lo) / (hi - lo), 0.0), 1.0)
        assert got["c", p].score == (None if want is None else pytest.approx(want)), p
        assert got["c", p].n_rt == counts["n_rt"][p]


def test_dense_axis_crosses_tiles(spark):
    rows = spark.createDataFrame([("c", "+", 20, 0, 3), ("c", "+", 20, 8, 4), ("c", "+", 20, 19, 5)], "contig string, strand string, length long, pos long, rt long")
    sizes = spark.createDataFrame([("c", 20), ("d", 20)], "contig string, length long")
    got = sorted((r.pos, r.rt) for r in score._dense(rows, sizes, ["rt"], 1, tile=8).collect())
    assert got == [(p, {0: 3, 8: 4, 19: 5}.get(p, 0)) for p in range(20)]


# ---- the data-dependent grid


def walked(low, size, wsize, wstep, jump):
    at, out, step = 0, [0], wstep
    while at < size - wsize:
        at = min(at + step, size - wsize)
        out.append(at)
        step = jump if low[at] else wstep
    return out


@pytest.mark.parametrize("seed", range(6))
def test_tile_maps_give_the_grid(spark, monkeypatch, seed):
    monkeypatch.setattr(score, "BLOCK", 3)
    rng = np.random.default_rng(seed)
    wsize, wstep, tile, size = 20, int(rng.integers(1, 8)), 40, int(rng.integers(400, 1500))
    jump = wsize - 1
    low = np.ones(size + tile, dtype=bool)
    for a in rng.integers(0, size, 4):  # stretches with coverage, and tiles without any
        low[a : a + 60] = rng.random(60) < 0.4
    border = lambda t: max(t * tile - wsize, 0)
    tiles = [t for t in range(size // tile + 1) if not low[border(t) : border(t + 1)].all()]
    maps = [("c", "+", t, score.tile_map(low[border(t) : border(t + 1)], wstep, jump, t == 0).astype(np.int32).tobytes()) for t in tiles]
    frame = spark.createDataFrame(maps, "contig string, strand string, tile long, map binary")
    entry = {r.tile: r.entry for r in score._grid_entries(frame, tile, wsize, wstep, jump).collect()}
    want = walked(low, size, wsize, wstep, jump)
    for t in tiles:
        got = border(t) + score.starts_from(entry[t], low[border(t) : (t + 1) * tile], size - wsize - border(t), wstep, jump, t == 0)
        assert got.tolist() == [s for s in want if border(t) <= s < (t + 1) * tile]


def test_exact_grid_with_low_stretches_over_tile_borders(spark):
    rng = np.random.default_rng(3)
    n, wsize = 1800, 50
    depth = rng.integers(60, 200, n)
    for a in (70, 195, 380, 610, 990, 1400):
        depth[a : a + int(rng.integers(20, 130))] = 0
    d_bd, n_rt, d_rt = depth, rng.integers(0, 20, n), rng.integers(0, 20, n)
    n_rt[0] = 1
    rows = spark.createDataFrame([("c", "+", i + 1, int(n_rt[i]), int(depth[i]), int(d_rt[i]), int(d_bd[i])) for i in range(n)], "contig string, strand string, pos long, n_rt long, n_bd long, d_rt long, d_bd long")
    sizes = spark.createDataFrame([("c", n)], "contig string, length long")
    got = {r.pos: (r.score, r.n_windows) for r in score.sliding_score(rows, sizes, wsize=wsize, wstep=5, tile=100, out_min_cov=0).collect()}
    low = np.array([(d_bd[i : i + wsize] >= 10).sum() < wsize // 5 for i in range(n)])
    starts = walked(low, n, wsize, 5, wsize - 1)
    total, good, seen = np.zeros(n), np.zeros(n), np.zeros(n)
    for s in starts:
        w = slice(s, s + wsize)
        one = score.score_windows(*(x[None, w] for x in (n_rt, depth, d_rt, d_bd)))[0]
        ok = ~np.isnan(one)
        total[w] += np.where(ok, one, 0)
        good[w] += ok
        seen[w] += 1
    for i in range(n):
        enough = seen[i] >= 2 and good[i] > seen[i] // 2 and d_bd[i] >= 100
        assert got[i + 1] == (pytest.approx(total[i] / good[i]) if enough else None, seen[i])


def test_junctions_are_cut_out_of_the_axis(spark):
    rng = np.random.default_rng(9)
    n, junctions = 900, [(30, 59), (60, 80), (300, 420), (700, 705)]
    rows = [("c", "+", p, *map(int, rng.integers(1, 150, 4))) for p in range(1, n + 1)]
    schema = "contig string, strand string, pos long, n_rt long, n_bd long, d_rt long, d_bd long"
    sizes = spark.createDataFrame([("c", n)], "contig string, length long")
    js = spark.createDataFrame([("c", "+", a, b) for a, b in junctions], "contig string, strand string, first long, second long")
    with_cut = score.sliding_score(spark.createDataFrame(rows, schema), sizes, js, wsize=50, grid="fixed", out_min_cov=0)
    left = [r for r in rows if not any(a <= r[2] <= b for a, b in junctions)]
    moved = [(*r[:2], i + 1, *r[3:]) for i, r in enumerate(left)]
    short = spark.createDataFrame([("c", len(moved))], "contig string, length long")
    plain = {r.pos: (r.score, r.n_windows) for r in score.sliding_score(spark.createDataFrame(moved, schema), short, wsize=50, grid="fixed", out_min_cov=0).collect()}
    got = {r.pos: (r.score, r.n_windows) for r in with_cut.collect()}
    assert got == {r[2]: plain[i + 1] for i, r in enumerate(left)}


# ---- islands


def test_one_island_over_many_partitions(spark):
    rng = random.Random(1)
    rows = [(f"r{i:03}", "c", "+", 5 * i, 5 * i + 9, "c", "+", s, s + 19) for i in range(150) for s in [rng.randrange(2000, 2040)]]
    rows += [(f"s{i:03}", "c", "+", 5000 + 40 * i, 5010 + 40 * i, "c", "+", 9000, 9019) for i in range(40)] + [("z", "c", "+", 0, 4990, "c", "+", 7000, 7010)]
    got = {r.read_id: r.island for r in duplex.islands(spark.createDataFrame(rows, HANG).repartition(7)).collect()}
    assert len({got[f"r{i:03}"] for i in range(150)} | {got["z"], got["s000"]}) == 1
    assert [got[f"s{i:03}"] - got["s000"] for i in range(40)] == list(range(40))


def test_junctions_are_combined_like_a_fold(spark):
    rng = random.Random(2)
    rows = sorted({(s, a, a + rng.randrange(0, 12)): rng.randrange(1, 9) for s in "+-" for a in (rng.randrange(1, 400) for _ in range(120))}.items())
    frame = spark.createDataFrame([("c", s, a, b, n) for (s, a, b), n in rows], "contig string, strand string, first long, second long, support long")
    got = sorted((r.strand, r["first"], r.second, r.support) for r in pileup.combine_junctions(frame, spark.createDataFrame([("c", 380)], "contig string, length long")).collect())
    want = []
    for strand in "+-":
        best: list = []
        for (s, a, b), n in rows:
            if s != strand:
                continue
            if best and a <= best[-1][1]:
                if n > best[-1][2]:
                    best[-1] = (a, b, n)
            else:
                best.append((a, b, n))
        best, i = [x for x in best if x[1] <= 381], 0
        while i < len(best):
            if i + 1 < len(best) and best[i + 1][0] == best[i][1] + 1:
                want.append((strand, best[i][0], best[i + 1][1], max(best[i][2], best[i + 1][2])))
                i += 2
            else:
                want.append((strand, *best[i]))
                i += 1
    assert got == sorted(want)


def literal_collapse(groups, reads, gap, total, check):
    """All pairs of every pass, in order."""
    now = [[g[0], *g[1:], [g[0]]] for g in sorted(groups, key=lambda g: (*g[1:], g[0]))]
    while True:
        kept: list = []
        for g in now:
            for k in kept:
                near = k[2] + gap >= g[1] and max(k[3], g[3]) - min(k[4], g[4]) - 1 <= gap
                short = max(k[2], g[2]) - k[1] < total and max(k[4], g[4]) - min(k[3], g[3]) < total
                pairs = sum(a[0] < b[1] and b[0] < a[1] and a[2] < b[3] and b[2] < a[3] for i in k[5] for a in reads[i] for j in g[5] for b in reads[j])
                if near and short and (not check or pairs >= 2):
                    k[2:5], k[5] = [max(k[2], g[2]), min(k[3], g[3]), max(k[4], g[4])], k[5] + g[5]
                    break
            else:
                kept.append(g)
        if len(kept) == len(now):
            return sorted((k[0], *k[1:5], sum(len(reads[i]) for i in k[5])) for k in kept)
        now = kept


@pytest.mark.parametrize("check", [False, True])
def test_groups_collapse_like_a_literal_model(spark, check):
    rng = random.Random(12)
    groups, members, hangs, reads = [], [], [], {}
    for i in range(160):
        a, c = rng.randrange(1, 260), rng.randrange(1000, 1060)
        g = (f"g{i:03}", a, a + rng.randrange(4, 26), c, c + rng.randrange(4, 34))
        groups.append(g)
        reads[g[0]] = []
        for j in range(rng.randrange(1, 4)):
            arms = (a - rng.randrange(3), g[2] + rng.randrange(5), c - rng.randrange(3), g[4] + rng.randrange(5))
            reads[g[0]].append(arms)
            members.append((g[0], f"r{i}.{j}"))
            hangs.append((f"r{i}.{j}", "c", "+", *arms[:2], "c", "+", *arms[2:]))
    frame = spark.createDataFrame([(g[0], "c", "+", *g[1:3], "c", "+", *g[3:], 1) for g in groups], HANG.replace("read_id", "group_id") + ", support long")
    new, own = duplex.collapse_groups(frame, spark.createDataFrame(members, "group_id string, read_id string"), check_reads=check, hangs=spark.createDataFrame(hangs, HANG))
    got = sorted((r.group_id, r.start_1, r.end_1, r.start_2, r.end_2, r.support) for r in new.collect())
    assert got == literal_collapse(groups, reads, 10, 30, check)
    assert own.count() == len(members) and len(got) < len(groups)
    with pytest.raises(ValueError):
        duplex.collapse_groups(frame, own, check_reads=True)


def test_collapse_of_a_large_island_is_fast():
    rng = random.Random(3)
    start = sorted([f"g{i}", a, a + rng.randrange(15, 40), c, c + rng.randrange(15, 40)] for i in range(10_000) for a, c in [(rng.randrange(1, 3000), rng.randrange(1, 3000))])
    none = np.zeros((0, 5), dtype=np.int64)
    rows = sorted(([*g, [g[0]], none] for g in start), key=lambda g: g[1:5])
    left = duplex._settled(rows, 10, 30, False)
    assert 1000 < len(left) < 10_000 and sum(len(g[5]) for g in left) == 10_000


# ---- interactions


def literal_calls(value, dist, win, most, perceive, extend):
    """The scan over the whole matrix; ``value[y, x]`` with y behind x, both from 0."""
    n = len(value)
    m = np.where(np.arange(n)[:, None] >= np.arange(n)[None, :] + win + dist, value, 0.0)

    def top(y0, y1, x0, x1):
        part = m[y0:y1, x0:x1]
        k = int(part.argmax())
        return part.flat[k], (y0 + k // part.shape[1], x0 + k % part.shape[1])

    out = []
    y = 0
    while y < n:
        again = False
        for x in range(0, y - win - dist + 1, win):
            v, at = top(y, min(y + win, n), x, min(x + win, n))
            if v < perceive:
                continue
            while True:
                b, a = max(at[0] - win // 2, 0), max(at[1] - win // 2, 0)
                _, better = top(b, min(b + win, n), a, min(a + win, n))
                if better == at:
                    break
                at = better
            tall, wide, open_ = win, win, [1, 1, 1, 1]
            while any(open_):
                for k in range(4):
                    if not open_[k]:
                        continue
                    rows, cols = slice(b, min(b + tall, n)), slice(a, min(a + wide, n))
                    line = [m[b, cols], m[rows, a], m[min(b + tall - 1, n - 1), cols], m[rows, min(a + wide - 1, n - 1)]][k]
                    room = [b > 0 and tall < most, a > 0 and wide < most, b + tall <= n and tall < most, wide < most][k]
                    if int(line.max()) >= extend and a + wide + dist < b and room:
                        b, a, tall, wide = b - (k == 0), a - (k == 1), tall + (k in (0, 2)), wide + (k in (1, 3))
                    else:
                        open_[k] = 0
            b1, a1 = min(b + tall, n), min(a + wide, n)
            v, at = top(b, b1, a, a1)
            out.append((a + 1, a1, b + 1, b1, float(v), at[1] + 1, at[0] + 1))
            m[b:b1, a:a1] = 0
            again = True
            break
        y = win if again else y + win
    return sorted(out)


@pytest.mark.parametrize(("seed", "dist", "win", "most", "perceive", "extend"), [(1, 20, 10, 40, 30.0, 8.0), (2, 5, 7, 21, 12.0, 3.0), (3, 0, 5, 30, 20.0, 2.5), (4, 30, 10, 10, 9.0, 9.0)])
def test_interactions_match_a_literal_scan(spark, seed, dist, win, most, perceive, extend):
    rng = np.random.default_rng(seed)
    n = 240
    value = np.zeros((n, n))
    for _ in range(14):  # ridges, blocks and single cells, with ties
        y, x = int(rng.integers(40, n)), int(rng.integers(0, n - 40))
        h, w = int(rng.integers(1, 25)), int(rng.integers(1, 25))
        value[y : y + h, x : x + w] += rng.integers(0, 20, value[y : y + h, x : x + w].shape) * (rng.random() < 0.7) + rng.integers(1, 25)
    value += np.where(rng.random((n, n)) < 0.01, rng.random((n, n)) * 45, 0)
    cells = [("c", "+", int(x) + 1, int(y) + 1, float(value[y, x])) for y, x in zip(*np.nonzero(value), strict=True)]
    cells += [("d", "-", 1, 90, 50.0), ("d", "-", 90, 1, 50.0)]
    coo = spark.createDataFrame(cells, "contig string, strand string, x long, y long, value double")
    found = matrix.call_interactions(coo, spark.createDataFrame([("c", n), ("d", 100)], "contig string, length long"), dist, win, most, perceive, extend).collect()
    got = sorted(tuple(r)[2:] for r in found if r.contig == "c")
    assert got == literal_calls(value, dist, win, most, perceive, extend) and len(got) > 3
    assert [r.score for r in found if r.contig == "d"] == [50.0]


def test_interactions_without_cells(spark):
    coo = spark.createDataFrame([("c", "+", 1, 500, 3.0)], "contig string, strand string, x long, y long, value double")
    size = spark.createDataFrame([("c", 500)], "contig string, length long")
    assert matrix.call_interactions(coo, size).collect() == []
    with pytest.raises(ValueError):
        matrix.call_interactions(coo, size, extend=0)


# ---- matrices


def test_background_of_four_places(spark):
    m = np.array([[0, 8, 0, 1], [8, 0, 0, 0], [0, 0, 0, 40], [1, 0, 40, 0]], dtype=float)
    cells = [(int(x), int(y)) for x, y in zip(*np.nonzero(m), strict=True)]
    coo = spark.createDataFrame([("c", "+", x + 1, y + 1, float(m[x, y])) for x, y in cells], "contig string, strand string, x long, y long, value double")
    got = {(r.x - 1, r.y - 1): r.value for r in matrix.background_estimate(coo, spark.createDataFrame([("c", 4)], "contig string, length long"), around=1).collect()}
    # rows add up to 9, 8, 40, 41; with their neighbours 17, 57, 89, 81; means are 2.25, 2, 10, 10.25
    bg, avg = [17 / 9, 57 / 8, 89 / 40, 81 / 41], [2.25, 2.0, 10.0, 10.25]
    assert got == {(x, y): pytest.approx(m[x, y] / np.sqrt(bg[x] * bg[y] * avg[x] * avg[y])) for x, y in cells}


def test_quantiles_from_the_least_to_the_largest(spark):
    coo = spark.createDataFrame([("c", "+", 1, i, float(v)) for i, v in enumerate([-5, 0, *range(1, 41)])], "contig string, strand string, x long, y long, value double")
    got = {r.quantile: r.value for r in matrix.matrix_quantiles(coo).collect()}
    assert got == {k: float(2 * k + 1) for k in range(20)} | {20: 40.0}
    with pytest.raises(ValueError):
        matrix.matrix_quantiles(coo.where("value > 20"))


def test_regions_are_rounded_and_erased(spark):
    size = spark.createDataFrame([("c", 100), ("d", 100), ("e", 100)], "contig string, length long")
    rows = [("c", "a", 1, 54), ("c", "b", 55, 100), ("d", "a", 1, 52), ("d", "b", 53, 54), ("d", "c", 55, 99), ("e", "a", 3, 4), ("e", "b", 5, 26)]
    frame = spark.createDataFrame(rows, "contig string, name string, first long, second long")
    got = {(r.contig, r.name): (r["first"], r.second) for r in matrix.compress_regions(frame, size, 10).collect()}
    assert got == {("c", "a"): (1, 5), ("c", "b"): (6, 10), ("d", "a"): (1, 5), ("d", "c"): (6, 10), ("e", "a"): (1, 0), ("e", "b"): (1, 3)}
    bad = spark.createDataFrame([("c", "a", 1, 54), ("c", "b", 54, 60)], frame.schema)
    with pytest.raises(Exception, match="overlap"):
        matrix.compress_regions(bad, size, 10).collect()


# ---- several factors in one pass


@pytest.mark.parametrize("bases", [None, "A"])
def test_factors_of_one_pass_equal_single_ones(spark, bases):
    rng = np.random.default_rng(5)
    rows = spark.createDataFrame([("c", "+", p, *map(int, rng.integers(1, 150, 4)), "AC"[p % 2]) for p in range(1, 400)], "contig string, strand string, pos long, n_rt long, n_bd long, d_rt long, d_bd long, base string")
    sizes = spark.createDataFrame([("c", 400)], "contig string, length long")
    run = lambda sub, grid: score.sliding_score(rows, sizes, wsize=60, wstep=7, grid=grid, bases=bases, sub=sub, out_min_cov=0, min_cov=20)
    for grid in ("fixed", "exact"):
        together = {(r.sub, r.pos): (r.score, r.n_windows, r.valid_count) for r in run((0.0, 0.5), grid).collect()}
        assert together == {(s, r.pos): (r.score, r.n_windows, r.valid_count) for s in (0.0, 0.5) for r in run(s, grid).collect()}
        assert len(together) > 300
