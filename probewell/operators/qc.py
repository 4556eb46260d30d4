"""Quality reports: composition, replicate correlation, Gini, profiles, structure agreement."""

from __future__ import annotations

import math
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.sequence import dotbracket_pairs
from .pileup import shuffled, small


def base_composition(counts_long: DataFrame) -> DataFrame:
    """sample, base, rt, ratio = rt / (all + 1); U counts as T, other letters are left out."""
    base = F.translate(F.upper("base"), "U", "T")
    rows = counts_long.select("sample", base.alias("base"), "rt").where("base in ('A', 'C', 'G', 'T')").groupBy("sample", "base").agg(F.sum("rt").alias("rt"))
    return rows.withColumn("ratio", F.col("rt") / (F.sum("rt").over(Window.partitionBy("sample")) + 1))


def base_shape_dist(gtab: DataFrame) -> DataFrame:
    """base, n_rt, d_rt, q1, median, q3, and the adjacent values (1.5 * IQR, within the data)."""
    p = lambda q: F.percentile("shape", q)
    rows = gtab.groupBy("base").agg(F.sum("n_rt").alias("n_rt"), F.sum("d_rt").alias("d_rt"), p(0.25).alias("q1"), p(0.5).alias("median"), p(0.75).alias("q3"), F.min("shape").alias("lo"), F.max("shape").alias("hi"))
    step = 1.5 * (F.col("q3") - F.col("q1"))
    return rows.select("base", "n_rt", "d_rt", "q1", "median", "q3", F.greatest("lo", F.col("q1") - step).alias("low_adjacent"), F.least("hi", F.col("q3") + step).alias("high_adjacent"))


@lru_cache
def least_correlation(n: int, alpha: float = 0.05) -> float:
    """The |r| from which n pairs are correlated at ``alpha``, two-sided: from Student's t by bisection."""

    def tail(t: float, df: int) -> float:  # P(|T| > t), Simpson's rule on the angle atan(t / sqrt(df))
        a, b, m = math.atan(t / math.sqrt(df)), math.pi / 2, 2000
        h = (b - a) / m
        f = lambda x: math.cos(x) ** (df - 1)
        part = f(a) + f(b) + sum((4 if i % 2 else 2) * f(a + i * h) for i in range(1, m))
        whole = math.exp(math.lgamma(df / 2) - math.lgamma((df + 1) / 2)) * math.sqrt(math.pi) / 2
        return part * h / 3 / whole

    lo, hi = 0.0, 1e4
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if tail(mid, n - 2) > alpha else (lo, mid)
    return math.sqrt(lo * lo / (n - 2 + lo * lo))


def global_index(rows: DataFrame, *order: str) -> DataFrame:
    """rows with ``at``, the 0-based place in the order of ``order``, without a window over everything: places inside each
    sorted partition plus the sizes of the partitions before (one number for each partition comes to the driver)."""
    from .scan import save

    ranked = save(rows.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id()), "sorted")
    part = F.shiftright("_mid", 33)
    before, total = [], 0
    for r in sorted(ranked.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect()):
        before += [F.lit(r["p"]), F.lit(total)]
        total += r["n"]
    start = F.element_at(F.create_map(*before), part) if before else F.lit(0)
    return ranked.withColumn("at", (start + F.col("_mid").bitwiseAND((1 << 33) - 1)).cast("long")).drop("_mid")


def _window_corr(rows: DataFrame, keys: list[str], x: str, y: str, win: int, alpha: float) -> DataFrame:
    """keys, n, r: the mean of the significant correlations of all complete windows of ``win`` rows (column win)."""
    spread = F.stddev_pop(x) * F.stddev_pop(y)
    r = F.when(spread > 0, F.covar_pop(x, y) / spread)  # a window without any variation has none
    per = rows.groupBy(*keys, "win").agg(F.count("*").alias("n"), r.alias("r")).where(F.col("n") == win)
    return per.where(F.abs("r") > least_correlation(win, alpha)).groupBy(*keys).agg(F.count("*").alias("n"), F.avg("r").alias("r"))


def rt_replicate_corr(counts_long: DataFrame, min_bd: int = 100, win: int = 100, bases: str | None = None, alpha: float = 0.05) -> DataFrame:
    """sample_1, sample_2, n, r: mean correlation of stops over windows of consecutive positions that both samples cover."""
    rows = counts_long.where(F.col("bd") >= min_bd)
    if bases:
        rows = rows.where(F.col("base").isin(list(bases)))
    from .scan import save

    key = ["contig", "strand", "pos"]
    rows = save(rows.select(*key, "sample", "rt"), "covered")  # read for the samples and for each pair of them
    samples = sorted(r[0] for r in rows.select("sample").distinct().collect())
    out = None
    for i, s in enumerate(samples):
        for t in samples[i + 1 :]:
            both = rows.where(F.col("sample") == s).select(*key, F.col("rt").alias("x")).join(shuffled(rows.where(F.col("sample") == t).select(*key, F.col("rt").alias("y"))), key)
            one = _window_corr(global_index(both, *key).withColumn("win", F.floor(F.col("at") / win)), [], "x", "y", win, alpha)
            one = one.select(F.lit(s).alias("sample_1"), F.lit(t).alias("sample_2"), "n", "r")
            out = one if out is None else out.unionByName(one)
    return out if out is not None else counts_long.sparkSession.createDataFrame([], "sample_1 string, sample_2 string, n long, r double")


def shape_replicate_corr(combined: DataFrame, win: int = 100, alpha: float = 0.05, seed: int = 0) -> DataFrame:
    """kind, n, r of two score columns: as they are, with the second one rotated by a place, and shuffled."""
    rows = global_index(combined.select("contig", "strand", "pos", "shape_1", "shape_2"), "contig", "strand", "pos")
    n = rows.count()
    second = rows.select(F.pmod(F.col("at") + 1, F.lit(max(n, 1))).alias("at"), F.col("shape_2").alias("y"))
    mixed = global_index(rows.select(F.col("shape_2").alias("y"), F.xxhash64("at", F.lit(seed)).alias("k"), F.col("at").alias("a")), "k", "a").select("at", "y")
    kinds = [("true", rows.withColumn("y", F.col("shape_2"))), ("rotated", rows.join(second, "at")), ("shuffled", rows.join(mixed, "at"))]
    out = None
    for kind, df in kinds:
        one = _window_corr(df.withColumn("win", F.floor(F.col("at") / win)), [], "shape_1", "y", win, alpha).select(F.lit(kind).alias("kind"), "n", "r")
        out = one if out is None else out.unionByName(one)
    return out


def gini(shapes: DataFrame, win: int = 30, transcripts: DataFrame | None = None) -> DataFrame:
    """transcript_id (and region, if features are given), gini: mean over tiles of ``win`` valid scores, rounded to 3 places.

    A tile counts if its start + win < n. A tile without any signal has no value.
    """
    rows = shapes.select("transcript_id", F.posexplode("scores").alias("i", "x")).where("x is not null")
    keys = ["transcript_id"]
    if transcripts is not None:
        features = transcripts.where("cds_start is not null").select("transcript_id", "cds_start", "cds_end")
        place = F.col("i") + 1
        rows = rows.join(small(features), "transcript_id").withColumn("region", F.when(place < F.col("cds_start"), "5UTR").when(place > F.col("cds_end"), "3UTR").otherwise("CDS"))
        keys = ["transcript_id", "region"]
    order = Window.partitionBy(*keys).orderBy("i")
    numbered = rows.withColumn("rn", F.row_number().over(order) - 1).withColumn("n", F.count("*").over(Window.partitionBy(*keys)))
    tiles = numbered.withColumn("tile", F.floor(F.col("rn") / win)).where(F.col("tile") * win + win < F.col("n"))
    ranked = tiles.withColumn("k", F.row_number().over(Window.partitionBy(*keys, "tile").orderBy("x")))
    # prefix sums over sorted values add up to sum(x * (win - k + 1))
    area = F.sum(F.col("x") * (win - F.col("k") + 1) - F.col("x") / 2)
    fair = F.sum("x") * win / 2
    per = ranked.groupBy(*keys, "tile").agg(F.when(F.sum("x") != 0, (fair - area) / fair).alias("g"))
    return per.groupBy(*keys).agg(F.round(F.avg("g"), 3).alias("gini")).where("gini is not null")


def coverage_ratio(shapes: DataFrame) -> DataFrame:
    """transcript_id, ratio of valid scores, and its place in the distribution: i / (n - 1) in order of (ratio, id)."""
    rows = shapes.select("transcript_id", (F.size(F.filter("scores", lambda x: x.isNotNull())) / F.col("length")).alias("ratio"))
    placed = global_index(rows, "ratio", "transcript_id")
    n = placed.count()
    return placed.select("transcript_id", "ratio", (F.col("at") / F.lit(max(n - 1, 1))).alias("p"))


def genetype_counts(shapes: DataFrame, transcripts: DataFrame) -> DataFrame:
    """type, transcripts and valid bases, most transcripts first."""
    rows = shapes.join(small(transcripts.select("transcript_id", "type")), "transcript_id")
    return rows.groupBy("type").agg(F.count("*").alias("transcripts"), F.sum(F.size(F.filter("scores", lambda x: x.isNotNull()))).alias("bases")).orderBy(F.desc("transcripts"), "type")


def codon_profile(shapes: DataFrame, transcripts: DataFrame, flank: int = 25, min_n: int = 100) -> DataFrame:
    """codon (start, stop), offset, score: means at places around the first base of the CDS and around its last."""
    rows = shapes.join(small(transcripts.where("cds_start is not null").select("transcript_id", "cds_start", "cds_end")), "transcript_id").select("cds_start", "cds_end", F.posexplode("scores").alias("i", "x")).where("x is not null")
    both = rows.select("x", F.inline(F.array(F.struct(F.lit("start").alias("codon"), (F.col("i") + 1 - F.col("cds_start")).alias("offset")), F.struct(F.lit("stop").alias("codon"), (F.col("i") + 1 - F.col("cds_end")).alias("offset")))))
    return both.where(F.abs("offset") <= flank).groupBy("codon", "offset").agg(F.count("*").alias("n"), F.avg("x").alias("score")).where(F.col("n") > min_n)


def roc_auc(pairs: DataFrame, step: float = 0.01, by: tuple = ()) -> DataFrame:
    """(by..., score, paired) → by..., auc, positives, negatives.

    Cutoffs run from -step to 1 + step; a base is called paired if its score is at most the cutoff. Scores are counted in
    bins of a cutoff first, so the curve is a running sum over a hundred rows, not over the bases.
    """
    last = round((1 + step) / step)
    bin_ = F.greatest(F.least(F.ceil(F.round(F.col("score") / step, 9)), F.lit(last + 1)), F.lit(-1)).cast("int")
    counted = pairs.where("score is not null and paired is not null").groupBy(*by, bin_.alias("c")).agg(F.count_if("paired").alias("t"), F.count_if(~F.col("paired")).alias("f"))
    w = Window.partitionBy(*by).orderBy("c") if by else Window.partitionBy(F.lit(1)).orderBy("c")
    everything = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(1))
    curve = counted.select(*by, "c", F.sum("t").over(w).alias("tp"), F.sum("f").over(w).alias("fp"), F.sum("t").over(everything).alias("p"), F.sum("f").over(everything).alias("n"))
    tpr, fpr = F.col("tp") / F.col("p"), F.col("fp") / F.col("n")
    points = curve.where((F.col("p") > 0) & (F.col("n") > 0)).withColumn("tpr", tpr).withColumn("fpr", fpr)
    area = (F.col("fpr") - F.coalesce(F.lag("fpr").over(w), F.lit(0.0))) * (F.col("tpr") + F.coalesce(F.lag("tpr").over(w), F.lit(0.0))) / 2
    return points.withColumn("a", area).groupBy(*by).agg(F.sum("a").alias("auc"), F.max("p").alias("positives"), F.max("n").alias("negatives"))


def common_transcripts(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.join(b.select("transcript_id").distinct(), "transcript_id", "left_semi")


def paired_bases(dots: DataFrame, tile: int = 1 << 14) -> DataFrame:
    """(id, seq, dot) → transcript_id, pos, base, paired. Long sequences are cut into tiles first, and these into letters."""
    last = F.floor((F.length("seq") - 1) / tile)
    part = lambda c: F.substring(c, (F.col("_t") * tile + 1).cast("int"), F.lit(tile))
    cut = dots.where("seq <> ''").select(F.col("id").alias("transcript_id"), "seq", "dot", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("_t"))
    tiles = cut.select("transcript_id", "_t", part("seq").alias("seq"), part("dot").alias("dot")).repartition("transcript_id", "_t")
    rows = tiles.select("transcript_id", "_t", F.posexplode(_letters("seq", "dot")).alias("i", "x"))
    return rows.where("x.seq <> ''").select("transcript_id", (F.col("_t") * tile + F.col("i") + 1).cast("long").alias("pos"), F.col("x.seq").alias("base"), F.col("x.paired").alias("paired"))


def _letters(seq: str, dot: str) -> Column:
    """Array of struct (seq, paired), a letter of ``seq`` each; a sign that is missing is none of an unpaired base."""
    two = F.arrays_zip(F.split(seq, "").alias("seq"), F.split(dot, "").alias("dot"))
    paired = lambda x: F.when(F.col(dot).isNotNull(), F.coalesce(x["dot"], F.lit("")) != ".")
    return F.transform(two, lambda x: F.struct(x["seq"].alias("seq"), paired(x).alias("paired")))


def evaluate_structure(shapes: DataFrame, dots: DataFrame, access: DataFrame | None = None, min_area: float = 5.0, ignore_double_strand: bool = False) -> DataFrame:
    """auc of each transcript and of all (transcript_id null). Lengths must agree.

    With ``access`` only bases of at least ``min_area`` count, and those whose value is null or missing; with
    ``ignore_double_strand`` paired bases count whatever their value.
    """
    # a transcript meets its structure as a whole; only then are both spread over its places
    known = dots.where("seq <> ''").select(F.col("id").alias("transcript_id"), F.length("seq").cast("long").alias("length"), "seq", "dot")
    both = shapes.select("transcript_id", F.col("length").cast("long").alias("length"), "scores").join(shuffled(known), ["transcript_id", "length"])
    zipped = both.select("transcript_id", F.posexplode(F.arrays_zip("scores", _letters("seq", "dot").alias("b"))).alias("i", "x"))
    rows = zipped.where("x.b.seq <> ''").select("transcript_id", (F.col("i") + 1).cast("long").alias("pos"), F.col("x.scores").alias("score"), F.col("x.b.paired").alias("paired"))
    if access is not None:
        known = access.select(F.col("id").alias("transcript_id"), F.col("pos").cast("long").alias("pos"), "value")
        rows = rows.join(shuffled(known), ["transcript_id", "pos"], "left").where(F.col("value").isNull() | (F.col("value") >= min_area) | (F.col("paired") & F.lit(ignore_double_strand)))
    each = roc_auc(rows, by=("transcript_id",))
    return each.unionByName(roc_auc(rows).select(F.lit(None).cast("string").alias("transcript_id"), "auc", "positives", "negatives"))


def train_parameters(rtbd: DataFrame, sizes: DataFrame, dots: DataFrame, windows: tuple = (100, 200), sub_factors: tuple = (0.0, 0.25, 0.5), **scoring) -> DataFrame:
    """wsize, sub, auc: sliding scores for each grid point over one saved table of counts.

    All factors of a window size are scored in one pass, as they share the ranks of the counts.
    """
    from .scan import save
    from .score import sliding_score

    counts = save(rtbd, "counts")
    truth = save(paired_bases(dots).withColumnRenamed("transcript_id", "contig").select("contig", "pos", "paired"), "pairs")
    out = None
    for wsize in windows:
        scored = sliding_score(counts, sizes, wsize=wsize, sub=tuple(map(float, sub_factors)), **{"grid": "fixed", **scoring}).where("strand = '+'")
        auc = roc_auc(scored.join(shuffled(truth), ["contig", "pos"]), by=("sub",)).select(F.lit(wsize).alias("wsize"), "sub", "auc")
        out = auc if out is None else out.unionByName(auc)
    return out


def structure_compare(pairs_test: DataFrame, pairs_known: DataFrame) -> DataFrame:
    """id, common, sensitivity, ppv and their geometric mean, from base pairs (id, left, right)."""
    t, k = (p.select("id", "left", "right").distinct() for p in (pairs_test, pairs_known))
    n_t, n_k = (p.groupBy("id").agg(F.count("*").alias(c)) for p, c in ((t, "n_test"), (k, "n_known")))
    both = t.join(k, ["id", "left", "right"]).groupBy("id").agg(F.count("*").alias("common"))
    rows = n_t.join(n_k, "id").join(both, "id", "left").fillna({"common": 0})
    s, p = F.col("common") / F.col("n_known"), F.col("common") / F.col("n_test")
    return rows.select("id", "common", s.alias("sensitivity"), p.alias("ppv"), F.sqrt(s * p).alias("geometric_mean"))


def with_pairs(dots: DataFrame) -> DataFrame:
    return dots.withColumn("pairs", dotbracket_pairs("dot"))
