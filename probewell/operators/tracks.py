"""Transcript score filters, browser tracks and the older transcript-wise pipeline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .pileup import small
from .score import array_factor, enrich_ctrl, winsorize


def filter_trans_shape(shapes: DataFrame, min_ratio: float = 0.1, min_num: int = 10, min_rt: float = 2.0, fpkm: DataFrame | None = None, min_fpkm: float = 5.0, head: int = 5, tail: int = 30) -> DataFrame:
    """Transcripts (transcript_id, length, scores, rt) with enough valid scores, stops and expression; the ends are nulled afterwards."""
    valid = F.size(F.filter("scores", lambda x: x.isNotNull()))
    rows = shapes.where((valid >= min_num) & (valid / F.col("length") >= min_ratio) & (F.col("rt") >= min_rt))
    if fpkm is not None:
        rows = rows.join(small(fpkm.where(F.col("fpkm") >= min_fpkm)), "transcript_id")
    return rows.withColumn("scores", F.transform("scores", lambda x, i: F.when((i >= head) & (i < F.col("length") - tail), x)))


def window_variability(values: Column | str) -> Column:
    """max - min of fewer than five values; else the mean of the two largest less that of the two smallest. Nulls are left out."""
    v = F.array_sort(F.filter(values, lambda x: x.isNotNull()))
    n = F.size(v)
    two = (F.element_at(v, -1) + F.element_at(v, -2)) / 2 - (F.element_at(v, 1) + F.element_at(v, 2)) / 2
    return F.when(n == 0, None).when(n < 5, F.array_max(v) - F.array_min(v)).otherwise(two)


def shape_bedgraph(gtab: DataFrame, min_cov: int = 20) -> DataFrame:
    """track, contig, strand, pos, value: score, variability (if there are window scores), N_RT, D_RT and BD above ``min_cov``."""
    has = set(gtab.columns)
    double = lambda c: F.col(c).cast("double")
    tracks = [("score", double("shape"), F.col("shape").isNotNull())]
    if "window_shape" in has:
        tracks.append(("variability", window_variability("window_shape"), F.col("shape").isNotNull()))
    tracks += [(c.upper(), double(c), F.col(c) > 0) for c in ("n_rt", "d_rt") if c in has]
    bd = "d_bd" if "d_bd" in has else "n_bd"
    tracks.append(("BD", double(bd), F.col(bd) > min_cov))
    stack = F.array(*[F.struct(F.lit(t).alias("track"), F.when(keep, v).alias("value")) for t, v, keep in tracks])
    return gtab.select("contig", "strand", "pos", F.inline(stack)).where("value is not null").select("track", "contig", "strand", "pos", "value")


def rt_bedgraph(rt_normalized: DataFrame) -> DataFrame:
    """Normalised arrays (transcript_id, type, scaling, values) → track, contig, pos, value; coverage is scaled back and rounded."""
    rows = rt_normalized.select("transcript_id", "type", "scaling", F.posexplode("values").alias("i", "v")).where("v is not null and v <> 0")
    value = F.when(F.col("type") == "baseDensity", F.round(F.col("v") * F.col("scaling") / 100)).otherwise(F.col("v"))
    return rows.select(F.col("type").alias("track"), F.col("transcript_id").alias("contig"), (F.col("i") + 1).cast("long").alias("pos"), value.alias("value"))


def shape_text_bedgraph(shapes: DataFrame, null_value: float | None = None) -> DataFrame:
    """Score arrays → contig, pos, value; nulls go, or get ``null_value``."""
    rows = shapes.select(F.col("transcript_id").alias("contig"), F.posexplode("scores").alias("i", "value"))
    rows = rows.select("contig", (F.col("i") + 1).cast("long").alias("pos"), "value")
    return rows.where("value is not null") if null_value is None else rows.fillna({"value": null_value})


def annotate_gene_type(shapes: DataFrame, transcripts: DataFrame) -> DataFrame:
    return shapes.join(small(transcripts.select("transcript_id", "gene_id", "type").dropDuplicates(["transcript_id"])), "transcript_id")


# ---- the older pipeline, transcript by transcript --------------------------------------------------------------------


def transcript_rt(sam: DataFrame, rpkm: DataFrame, cutoff: float = 5.0, legacy_mate_rule: bool = False) -> DataFrame:
    """transcript_id, length, rpkm, bd, rt (arrays of length + 1; place 0 holds stops before the first base).

    Reads that map to several transcripts weigh 1 / hits. ``rpkm`` (contig, length, rpkm) names the transcripts to keep.
    """
    good = [0, 99, 355, 256]
    rows = sam.where(F.col("flag").isin(*good))
    if legacy_mate_rule:
        rows = rows.where(~F.col("flag").isin(99, 355) | (F.col("rnext") != "="))
    aligned = F.aggregate(F.transform(F.regexp_extract_all("cigar", F.lit("(\\d+)[MDN=X]"), F.lit(1)), lambda x: x.cast("long")), F.lit(0).cast("long"), lambda s, x: s + x)
    keep = rpkm.where(F.col("rpkm") >= cutoff).select(F.col("contig").alias("transcript_id"), F.col("length").cast("long").alias("length"), "rpkm")
    weighted = rows.select(F.col("chr_id").alias("transcript_id"), F.col("pos").cast("long").alias("first"), (F.col("pos") + aligned - 1).alias("second"), (F.lit(1.0) / F.count("*").over(Window.partitionBy("read_id"))).alias("w"))
    placed = weighted.join(small(keep), "transcript_id").withColumn("second", F.least("second", "length")).where("first <= second")
    stops = placed.groupBy("transcript_id", (F.col("first") - 1).alias("pos")).agg(F.sum("w").alias("rt"))
    edges = placed.select("transcript_id", F.inline(F.array(F.struct(F.col("first").alias("pos"), F.col("w").alias("d")), F.struct((F.col("second") + 1).alias("pos"), (-F.col("w")).alias("d")))))
    summed = edges.groupBy("transcript_id", "pos").agg(F.sum("d").alias("d"))
    zero = F.lit(0.0)
    both = summed.select("transcript_id", "pos", "d", zero.alias("rt")).unionByName(stops.select("transcript_id", "pos", zero.alias("d"), "rt"))
    # every place of a transcript that has a read, so that a window over the place gives the running sum
    seen = both.select("transcript_id").distinct().join(small(keep), "transcript_id").select("transcript_id", F.explode(F.expr("sequence(0L, length)")).alias("pos"), zero.alias("d"), zero.alias("rt"))
    dense = both.unionByName(seen).groupBy("transcript_id", "pos").agg(F.sum("d").alias("d"), F.sum("rt").alias("rt"))
    upto = Window.partitionBy("transcript_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = dense.select("transcript_id", "pos", F.round(F.sum("d").over(upto), 9).alias("bd"), "rt").join(small(keep), "transcript_id").where(F.col("pos") <= F.col("length"))
    lists = rows.groupBy("transcript_id", "length", "rpkm").agg(F.array_sort(F.collect_list(F.struct("pos", "bd", "rt"))).alias("a"))
    return lists.select("transcript_id", "length", "rpkm", F.transform("a", lambda x: x["bd"]).alias("bd"), F.transform("a", lambda x: x["rt"]).alias("rt"))


def combine_replicates(rt_files: DataFrame) -> DataFrame:
    """(transcript_id, length, rpkm, replicate, bd, rt) → sums by place; rpkm joined by commas in order of the replicates."""
    rows = rt_files.select("transcript_id", "length", "replicate", F.posexplode(F.arrays_zip("bd", "rt")).alias("pos", "x"))
    summed = rows.groupBy("transcript_id", "length", "pos").agg(F.sum("x.bd").alias("bd"), F.sum("x.rt").alias("rt"))
    arrays = summed.groupBy("transcript_id", "length").agg(F.array_sort(F.collect_list(F.struct("pos", "bd", "rt"))).alias("a"))
    names = rt_files.groupBy("transcript_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("replicate", "rpkm"))), lambda x: x["rpkm"].cast("string")), ",").alias("rpkm"))
    return arrays.join(names, "transcript_id").select("transcript_id", "length", "rpkm", F.transform("a", lambda x: x["bd"]).alias("bd"), F.transform("a", lambda x: x["rt"]).alias("rt"))


def normalize_rt(rt: DataFrame, head: int = 32, tail: int = 32, form: float = 100.0, method: str = "mean:vigintile2", log: bool = False) -> DataFrame:
    """transcript_id, length, type (baseDensity, RTstop), rpkm, scaling, values[1..length].

    Values are divided by scaling / form. The factor comes from the places without head and tail, which are halved
    while the transcript is too short for them; a transcript with a factor of 1 or less is dropped. A transcript is one row.
    """
    calc, _, sample = method.partition(":")
    name = sample.rstrip("0123456789")
    index = int(sample[len(name) :] or 1)
    steps = F.sequence(F.lit(0), F.lit(10))
    trim = lambda n: F.aggregate(steps, F.struct(F.lit(head).alias("h"), F.lit(tail).alias("t")), lambda s, _: F.when(s["h"] + s["t"] >= n, F.struct(F.floor(s["h"] / 2).cast("int").alias("h"), F.floor(s["t"] / 2).cast("int").alias("t"))).otherwise(s))
    n = F.col("length").cast("int")
    kinds = {"baseDensity": "bd", "RTstop": "rt"}
    # a transcript's values stand in its row, so each row tells its own factors: no place is exploded or shuffled
    cut = rt.select("transcript_id", "length", "rpkm", *[F.slice(c, F.lit(2), n).alias(f"_v_{c}") for c in kinds.values()], trim(F.col("length")).alias("_cut"))
    inner = lambda c: F.slice(f"_v_{c}", F.col("_cut.h") + 1, n - F.col("_cut.h") - F.col("_cut.t"))
    found = cut.withColumns({f"_f_{c}": array_factor(inner(c), name, index, calc) for c in kinds.values()}).where(" and ".join(f"_f_{c} > 1" for c in kinds.values()))
    rows = found.select("transcript_id", "length", "rpkm", F.inline(F.array(*[F.struct(F.lit(k).alias("type"), F.col(f"_f_{c}").alias("factor"), F.col(f"_v_{c}").alias("v")) for k, c in kinds.items()])))
    scale = F.col("factor") / form
    value = (lambda x: F.log2(x / scale + 1)) if log else (lambda x: x / scale)
    return rows.select("transcript_id", "length", "type", "rpkm", F.col("factor").alias("scaling"), F.transform("v", value).alias("values"))


def enrich_fg_bg_join(fg: DataFrame, bg: DataFrame) -> DataFrame:
    """Normalised foreground and background of transcripts of equal length: transcript_id, length, rpkms, scalings and four arrays.

    ``rpkms`` lists foreground and background, ``scalings`` the factors of fg_rt, bg_bd and bg_rt, both with commas.
    """

    def wide(df: DataFrame, p: str) -> DataFrame:
        pick = lambda t, c: F.max(F.when(F.col("type") == t, F.col(c)))
        kinds = (("rt", "RTstop"), ("bd", "baseDensity"))
        return df.groupBy("transcript_id", "length").agg(F.max("rpkm").alias(f"{p}_rpkm"), *[pick(t, "values").alias(f"{p}_{k}") for k, t in kinds], *[pick(t, "scaling").alias(f"{p}_factor_{k}") for k, t in kinds])

    joined = wide(fg, "fg").join(wide(bg, "bg"), ["transcript_id", "length"])
    factors = F.concat_ws(",", *[F.col(c).cast("string") for c in ("fg_factor_rt", "bg_factor_bd", "bg_factor_rt")])
    return joined.select("transcript_id", "length", F.concat_ws(",", "fg_rpkm", "bg_rpkm").alias("rpkms"), factors.alias("scalings"), "fg_rt", "fg_bd", "bg_rt", "bg_bd")


def enrich_transcripts(joined: DataFrame, method: str = "complex", sub: float = 0.25, div: float = 10.0, add: float = 1.0, winsor: float = 0.05, head: int = 6, tail: int = 33) -> DataFrame:
    """Rows of ``enrich_fg_bg_join`` → values: array of (score, fg_rt, bg_rt, bg_bd); scores are winsorised without head and tail."""
    long = joined.select("transcript_id", "length", "rpkms", "scalings", F.posexplode(F.arrays_zip("fg_rt", "fg_bd", "bg_rt", "bg_bd")).alias("i", "x")).select("transcript_id", "length", "rpkms", "scalings", "i", F.col("x.fg_rt").alias("n_rt"), F.col("x.fg_bd").alias("n_bd"), F.col("x.bg_rt").alias("d_rt"), F.col("x.bg_bd").alias("d_bd"))
    scored = enrich_ctrl(long, method, sub, div, add)
    inner = scored.withColumn("score", F.when((F.col("i") >= head) & (F.col("i") < F.col("length") - tail), F.col("score")))
    scaled = winsorize(inner, "score", ["transcript_id"], winsor, min_n=1)
    value = F.struct("i", "score", F.col("n_rt").alias("fg_rt"), F.col("d_rt").alias("bg_rt"), F.col("d_bd").alias("bg_bd"))
    return scaled.groupBy("transcript_id", "length", "rpkms", "scalings").agg(F.transform(F.array_sort(F.collect_list(value)), lambda v: F.struct(v["score"].alias("score"), v["fg_rt"].alias("fg_rt"), v["bg_rt"].alias("bg_rt"), v["bg_bd"].alias("bg_bd"))).alias("values"))


def filter_enrich(enriched: DataFrame, bd_cutoff: float = 200, rt_cutoff: float = 2.0, head: int = 5, tail: int = 30) -> DataFrame:
    """Transcripts whose mean fg_rt is above the cutoff: transcript_id, length, fpkm (mean of the comma list), scores; ends and thin bases are null."""
    mean_rt = F.aggregate("values", F.lit(0.0), lambda s, v: s + v["fg_rt"]) / F.size("values")
    numbers = F.transform(F.split(F.regexp_replace("rpkms", ";", ","), ","), lambda x: x.try_cast("double"))
    fpkm = F.aggregate(numbers, F.lit(0.0), lambda s, x: s + F.coalesce(x, F.lit(0.0))) / F.size(numbers)
    score = F.transform("values", lambda v, i: F.when((i >= head) & (i < F.col("length") - tail) & (v["bg_bd"] >= bd_cutoff), v["score"]))
    return enriched.where(mean_rt > rt_cutoff).select("transcript_id", "length", fpkm.alias("fpkm"), score.alias("scores"))
