"""Reactivity scores from stop and coverage counts of treated and control reads."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import scan
from .coords import interval_join
from .pileup import small

SAMPLES = {"smart": None, "upper": 2, "quartile": 4, "decile": 10, "vigintile": 20}
METHODS = ("sub", "div", "complex", "log")


def _rank_range(sample: str, index: int, n):
    """0-based descending ranks [lo, hi) that ``sample`` takes of n values (numbers or columns)."""
    if sample not in SAMPLES:
        raise ValueError(f"sample must be one of {sorted(SAMPLES)}")
    parts = SAMPLES[sample]
    whole = (lambda x: F.floor(x)) if isinstance(n, Column) else (lambda x: np.floor(x))
    if sample == "upper":
        return n * 0, whole(n / 2)
    return whole((index - 1) * n / parts), whole(index * n / parts)


def scaling_factor(df: DataFrame, value: str, by: list[str], sample: str = "decile", index: int = 2, calc: str = "median") -> DataFrame:
    """by + factor: median, mean or peak of a rank range of the values, sorted downwards; 1 where the range is empty."""
    return _factor_of(_counted(df.select(*by, F.col(value).cast("double").alias("v")), by), by, sample, index, calc)


def _counted(values: DataFrame, by: list[str]) -> DataFrame:
    """by, v, c: equal values are counted before anything is sorted."""
    return values.groupBy(*by, "v").agg(F.count("*").alias("c"))


def _factor_of(counted: DataFrame, by: list[str], sample: str, index: int, calc: str) -> DataFrame:
    if calc not in ("median", "mean", "peak"):
        raise ValueError("calc must be median, mean or peak")
    valued, positive = F.when(F.col("v").isNotNull(), F.col("c")).otherwise(0), F.when(F.col("v") > 0, F.col("c")).otherwise(0)
    rows = scan.ranks(counted, by, F.col("v").desc_nulls_last(), valued=valued, positive=positive)
    # values stand in falling order, nulls last: the range taken is [lo, hi) of the ranks, as far as there are values
    if sample == "smart":
        lo, hi = F.lit(0), F.col("positive")
    else:
        lo, hi = _rank_range(sample, index, F.col("n"))
        hi = F.least(hi, F.col("valued"))
    rows = rows.withColumns({"lo": lo.cast("long"), "hi": hi.cast("long")}).withColumn("m", F.greatest(F.col("hi") - F.col("lo"), F.lit(0)))
    taken = F.greatest(F.least(F.col("r") + F.col("c"), "hi") - F.greatest("r", "lo"), F.lit(0))
    at = lambda k: F.max(F.when((F.col("m") > 0) & (F.col("r") <= F.col("lo") + k) & (F.col("lo") + k < F.col("r") + F.col("c")), F.col("v")))
    half, below = F.floor(F.col("m") / 2), F.floor((F.col("m") - 1) / 2)
    found = {"median": (at(half) + at(below)) / 2, "mean": F.sum(F.col("v") * taken) / F.nullif(F.sum(taken), F.lit(0)), "peak": F.max(F.when(taken > 0, F.col("v")))}[calc]
    return rows.groupBy(*by).agg(F.coalesce(found, F.lit(1.0)).alias("factor"))


def array_factor(values: Column, sample: str = "decile", index: int = 2, calc: str = "median") -> Column:
    """``scaling_factor`` of the values in an array; null for a null array."""
    if calc not in ("median", "mean", "peak"):
        raise ValueError("calc must be median, mean or peak")

    def of(down: Column) -> Column:
        """Of values in falling order, nulls last."""
        n = F.size(down)
        lo, hi = (F.lit(0), n) if sample == "smart" else _rank_range(sample, index, n)
        part = F.filter(F.slice(down, lo.cast("int") + 1, F.greatest(hi - lo, F.lit(0)).cast("int")), lambda x: x.isNotNull() & (x > 0) if sample == "smart" else x.isNotNull())
        m, total = (lambda p: F.size(p)), lambda p: F.aggregate(p, F.lit(0.0), lambda s, x: s + x)
        at = lambda p, k: F.get(p, F.floor(k).cast("int"))
        known = {"median": lambda p: (at(p, m(p) / 2) + at(p, (m(p) - 1) / 2)) / 2, "mean": lambda p: total(p) / m(p), "peak": lambda p: F.get(p, F.lit(0))}[calc]
        return F.transform(F.array(part), lambda p: F.when(m(p) > 0, known(p)).otherwise(1.0))[0]

    doubles = F.transform(values, lambda x: x.cast("double"))
    return F.transform(F.array(F.sort_array(doubles, asc=False)), of)[0]


def enrich_ctrl(df: DataFrame, method: str = "complex", sub: float = 0.25, div: float = 10.0, add: float = 1.0, factors: tuple = ("n_rt_f", "n_bd_f", "d_rt_f", "d_bd_f")) -> DataFrame:
    """df with ``score`` from n_rt, n_bd, d_rt, d_bd, each divided by its factor column where there is one."""
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}")
    part = lambda c, f: F.col(c) / (F.col(f) if f in df.columns else F.lit(1.0))
    n_rt, n_bd, d_rt, d_bd = (part(c, f) for c, f in zip(("n_rt", "n_bd", "d_rt", "d_bd"), factors, strict=True))
    covered = F.col("d_bd") > 0
    score = {
        "sub": n_rt - sub * d_rt,
        "div": F.when(covered, div * n_bd / d_bd),
        "complex": F.when(covered, div * (n_rt - sub * d_rt) / d_bd),
        "log": F.when(covered, F.log2((F.col("n_rt") + add) / (F.col("d_rt") + add))),
    }[method]
    return df.withColumn("score", score.cast("double"))


def enrich_noctrl(df: DataFrame, method: str = "rt", add: float = 1.0) -> DataFrame:
    """df with ``score`` from rt and bd; null without coverage."""
    score = {"rt": F.col("rt").cast("double"), "div": F.col("rt") / F.col("bd"), "log": F.log2(F.col("rt") + add)}
    if method not in score:
        raise ValueError(f"method must be one of {sorted(score)}")
    return df.withColumn("score", F.when(F.col("bd") > 0, score[method]))


def sink_score(df: DataFrame, value: str, by: list[str], index: float = 0.0) -> DataFrame:
    """Subtract the value at ascending rank floor(index * n); nulls count as the lowest values and stay null."""
    if index == 0:
        return df
    df = scan.save(df, "sunk")  # read for the ranks and for the result
    base = _sink_base(_counted(df.select(*by, F.col(value).alias("v")), by), by, index)
    return df.join(small(scan.save(base, "sinks")), by).withColumn(value, F.col(value) - F.coalesce("_base", F.lit(0.0))).drop("_base")


def _sink_base(counted: DataFrame, by: list[str], index: float) -> DataFrame:
    """by + _base, the value at that rank; null if a null stands there."""
    ranked = scan.ranks(counted, by, F.col("v").asc_nulls_first())
    at = F.least(F.floor(F.col("n") * index), F.col("n") - 1)
    return ranked.groupBy(*by).agg(F.max(F.when((F.col("r") <= at) & (at < F.col("r") + F.col("c")), F.col("v"))).alias("_base"))


def winsorize(df: DataFrame, value: str, by: list[str], factor: float = 0.05, min_n: int = 20) -> DataFrame:
    """``value`` scaled to 0..1 between its ranks floor(f*n) and n-1-floor(f*n); null in groups of under ``min_n`` values."""
    df = scan.save(df, "winsorized")  # read for the ranks and for the result
    bounds = _winsor_bounds(_counted(df.where(F.col(value).isNotNull()).select(*by, F.col(value).alias("v")), by), by, factor)
    return df.join(small(scan.save(bounds, "bounds")), by, "left").withColumn(value, _winsorized(F.col(value), min_n)).drop("_lo", "_hi", "_n")


def _winsor_bounds(counted: DataFrame, by: list[str], factor: float) -> DataFrame:
    """by + _lo, _hi, _n of values without nulls."""
    ranked = scan.ranks(counted, by, F.col("v").asc())
    cut = F.floor(F.lit(factor) * F.col("n"))
    at = lambda k: F.max(F.when((F.col("r") <= k) & (k < F.col("r") + F.col("c")), F.col("v")))
    return ranked.groupBy(*by).agg(F.greatest(at(cut), F.lit(0.0)).alias("_lo"), at(F.col("n") - 1 - cut).alias("_hi"), F.max("n").alias("_n"))


def _winsorized(value: Column, min_n: int = 20) -> Column:
    x = (value - F.col("_lo")) / (F.col("_hi") - F.col("_lo"))
    return F.when(value.isNotNull() & (F.col("_n") >= min_n) & (F.col("_lo") < F.col("_hi")), F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0)))


def valid_cov(df: DataFrame, by: list[str], bd: str, rt: str, min_bd: float = 50, min_rt: float = 1.0) -> DataFrame:
    """by + valid: more than half of the rows have ``bd`` and the mean of ``rt`` is high enough."""
    enough = F.sum(F.when(F.col(bd) >= min_bd, 1).otherwise(0)) > F.floor(F.count("*") / 2)
    return df.groupBy(*by).agg((enough & (F.avg(rt) >= min_rt)).alias("valid"))


def low_exp_region(df: DataFrame, by: list[str], bd: str, min_bd: float = 10) -> DataFrame:
    """by + low: fewer than floor(n / 5) rows have ``bd`` >= min_bd."""
    return df.groupBy(*by).agg((F.sum(F.when(F.col(bd) >= min_bd, 1).otherwise(0)) < F.floor(F.count("*") / 5)).alias("low"))


def mean_score(values: DataFrame, by: list[str], value: str = "score") -> DataFrame:
    """by + score, valid_count: mean of the non-null values if there are two rows and more than half are not null."""
    n, good = F.count("*"), F.count(value)
    return values.groupBy(*by).agg(F.when((n >= 2) & (good > F.floor(n / 2)), F.avg(value)).alias("score"), F.when(n >= 2, good).otherwise(0).cast("long").alias("valid_count"))


_KEY = ["contig", "strand"]


def whole_contig_score(counts: DataFrame, sizes: DataFrame, enrich: str = "complex", sample: str = "decile", index: int = 2, calc: str = "median", winsor: float = 0.05, head: int = 5, tail: int = 30, min_size: int = 50, min_bd: float = 50, min_rt: float = 1.0) -> DataFrame:
    """One window for each contig and strand: array places 0..size-31. Scores stand at 6..size-31, rows at 1..size-1.

    Contigs under 50 bases are left out. All statistics come from the places with counts and the number of the others, which
    are zeros; the dense axis is only spread for the result.
    """
    names = ["n_rt", "n_bd", "d_rt", "d_bd"]
    rows, window, valid = _whole(counts, sizes, names, min_size, tail, "d_bd", "n_rt", min_bd, min_rt)
    inside = window.join(small(valid.select(*_KEY)), _KEY)
    values = inside.select(*_KEY, F.inline(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("v")) for c in names])))
    counted = values.groupBy(*_KEY, "name", "v").agg(F.count("*").alias("c"))
    zeros = valid.select(*_KEY, F.explode(F.array(*map(F.lit, names))).alias("name"), F.lit(0.0).alias("v"), F.col("absent").alias("c")).where("c > 0")
    counted = counted.unionByName(zeros).groupBy(*_KEY, "name", "v").agg(F.sum("c").alias("c"))
    factors = _factor_of(counted, [*_KEY, "name"], sample, index, calc).withColumn("factor", F.when(F.col("factor") == 0, 1.0).otherwise(F.col("factor")))
    groups = scan.save(valid.join(factors.groupBy(*_KEY).agg(*[F.max(F.when(F.col("name") == c, F.col("factor"))).alias(f"{c}_f") for c in names]), _KEY), "factors")
    scored = enrich_ctrl(_weighted(inside.select(*_KEY, *names), groups, names), enrich)
    return _spread(rows, sizes, names, groups, scored, lambda df: enrich_ctrl(df, enrich), winsor, head, tail, min_size)


def whole_contig_noctrl(counts: DataFrame, sizes: DataFrame, enrich: str = "rt", sink: float = 0.0, winsor: float = 0.05, min_cov: float = 100, head: int = 5, tail: int = 30, min_size: int = 50, min_bd: float = 50, min_rt: float = 1.0) -> DataFrame:
    """``whole_contig_score`` of one sample (rt, bd) without control: enrichment, sink and winsorisation, no scaling.

    A score needs a coverage of ``min_cov``. Contigs under 50 bases are left out.
    """
    names = ["rt", "bd"]
    rows, window, valid = _whole(counts, sizes, names, min_size, tail, "bd", "rt", min_bd, min_rt)
    inside = window.join(small(valid.select(*_KEY)), _KEY)
    groups, base = valid, F.lit(0.0)
    if sink:
        weighted = enrich_noctrl(_weighted(inside.select(*_KEY, *names), valid, names), enrich)
        found = _sink_base(weighted.groupBy(*_KEY, F.col("score").alias("v")).agg(F.sum("c").alias("c")), _KEY, sink)
        groups, base = scan.save(valid.join(found, _KEY), "sinks"), F.coalesce("_base", F.lit(0.0))
    score = lambda df: enrich_noctrl(df, enrich).withColumn("score", F.col("score") - base)
    scored = score(_weighted(inside.select(*_KEY, *names), groups, names))
    return _spread(rows, sizes, names, groups, scored, score, winsor, head, tail, min_size, F.col("bd") >= min_cov)


def _whole(counts: DataFrame, sizes: DataFrame, names: list[str], min_size: int, tail: int, bd: str, rt: str, min_bd: float, min_rt: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The counts on contigs that are long enough, those inside the window, and the contigs and strands with enough of them.

    The counts are saved, as all statistics read them. ``absent``: places of the window without counts.
    """
    lengths = sizes.where(F.col("length") >= min_size).select("contig", F.col("length").cast("long").alias("length"))
    rows = scan.save(counts.select(*_KEY, "pos", *names).join(small(lengths), "contig").where("pos between 0 and length - 1"), "counts")
    window = rows.where(F.col("pos") <= F.col("length") - tail - 1)
    places = F.greatest(F.col("length") - tail, F.lit(0))
    enough = F.sum(F.when(F.col(bd) >= min_bd, 1).otherwise(0)) > F.floor(places / 2)
    mean = F.sum(rt) / F.nullif(places, F.lit(0))
    valid = window.groupBy(*_KEY, "length").agg((enough & (mean >= min_rt)).alias("valid"), (places - F.count("*")).alias("absent")).where("valid")
    return rows, window, scan.save(valid.select(*_KEY, "absent"), "valid")


def _weighted(rows: DataFrame, groups: DataFrame, names: list[str]) -> DataFrame:
    """The rows with weight c = 1 and the columns of their group, and a row of zeros with the group's absent places as its weight."""
    zero = groups.select(*_KEY, *[F.lit(0).cast("long").alias(n) for n in names], F.col("absent").alias("c")).where("c > 0")
    return rows.withColumn("c", F.lit(1).cast("long")).unionByName(zero).join(small(groups.drop("absent")), _KEY)


def _spread(rows: DataFrame, sizes: DataFrame, names: list[str], groups: DataFrame, scored: DataFrame, score, winsor: float, head: int, tail: int, min_size: int, also: Column | None = None) -> DataFrame:
    """All places 1..length-1 of contigs and strands with counts, with the winsorised ``score``."""
    values = scored.where("score is not null").groupBy(*_KEY, F.col("score").alias("v")).agg(F.sum("c").alias("c"))
    bounds = scan.save(groups.join(_winsor_bounds(values, _KEY, winsor), _KEY, "left").withColumn("_go", F.lit(True)), "bounds")
    dense = score(_dense(rows, sizes, names, min_size).where("pos >= 1").join(small(bounds), _KEY, "left"))
    shown = F.col("_go") & (F.col("pos") > head) & (F.col("pos") <= F.col("length") - tail - 1)
    shown = shown if also is None else shown & also
    return dense.select(*_KEY, "pos", *names, F.when(shown, _winsorized(F.col("score"))).alias("score"))


def _dense(counts: DataFrame, sizes: DataFrame, names: list[str], min_size: int, tile: int = 1 << 16) -> DataFrame:
    """A row for each place 0..length-1 of a contig and strand with counts; 0 where there is none.

    Only the counts and one mark for each tile are shuffled: in its tile a row also stands for the empty places up to the next one.
    """
    key = [*_KEY, "tile"]
    lengths = sizes.where(F.col("length") >= min_size).select("contig", F.col("length").cast("long").alias("length"))
    marks = counts.select(*_KEY).distinct().join(small(lengths), "contig").select(*_KEY, "length", F.explode(F.expr(f"sequence(0L, (length - 1) div {tile})")).alias("tile"))
    marks = marks.select(*key, "length", (F.col("tile") * tile).alias("pos"), *[F.lit(0).cast("long").alias(n) for n in names], F.lit(0).alias("real"))
    real = counts.select(*_KEY, F.expr(f"pos div {tile}").alias("tile"), "length", "pos", *[F.col(n).cast("long").alias(n) for n in names], F.lit(1).alias("real"))
    after = F.lead("pos").over(Window.partitionBy(*key).orderBy("pos", "real"))
    rows = marks.unionByName(real).withColumn("_next", F.coalesce(after, F.least(F.lit(tile) * (F.col("tile") + 1), "length"))).where("_next > pos")
    every = rows.withColumn("_at", F.explode(F.expr("sequence(pos, _next - 1)")))
    return every.select(*_KEY, "length", F.col("_at").alias("pos"), *[F.when(F.col("_at") == F.col("pos"), F.col(n)).otherwise(0).alias(n) for n in names])


# ---- sliding windows -------------------------------------------------------------------------------------------------


def _factors(values: np.ndarray, sample: str, index: int, calc: str) -> np.ndarray:
    """Scaling factor of each row of a matrix; 0 and empty ranges count as 1."""
    down = -np.sort(-values, axis=1)
    n = values.shape[1]
    if sample == "smart":
        down = np.where(down > 0, down, np.nan)
        with np.errstate(all="ignore"):
            got = {"median": np.nanmedian, "mean": np.nanmean, "peak": np.nanmax}[calc](down, axis=1) if n else np.ones(len(values))
        got = np.where(np.isnan(got), 1.0, got)
    else:
        lo, hi = (int(x) for x in _rank_range(sample, index, n))
        part = down[:, lo:hi]
        got = np.ones(len(values)) if hi <= lo else {"median": np.median, "mean": np.mean, "peak": np.max}[calc](part, axis=1)
    return np.where(got == 0, 1.0, got)


def _winsor(x: np.ndarray, factor: float, min_n: int = 20) -> np.ndarray:
    good = ~np.isnan(x)
    n = good.sum(axis=1)
    up = np.sort(x, axis=1)  # nan last
    cut = np.floor(factor * n).astype(int)
    line = np.arange(len(x))
    safe = n > 0
    lo = np.where(safe, up[line, np.where(safe, cut, 0)], 0.0)
    hi = np.where(safe, up[line, np.where(safe, n - cut - 1, 0)], 0.0)
    lo = np.maximum(lo, 0.0)
    ok = (n >= min_n) & (lo < hi)
    with np.errstate(all="ignore"):
        out = np.clip((x - lo[:, None]) / (hi - lo)[:, None], 0.0, 1.0)
    return np.where(ok[:, None], out, np.nan)


def score_windows(n_rt, n_bd, d_rt, d_bd, mask=None, enrich="complex", sub=0.25, div=10.0, add=1.0, sample="decile", index=2, calc="median", winsor=0.05, min_bd=50, min_rt=1.0, low_bd=10, mask_bd=100) -> np.ndarray:
    """Scores of windows, one a row; nan where there is none. A tuple of ``sub`` gives scores for each of them, from one ranking.

    With a mask, windows are scored on what it lets in, together with all that it lets in as many places of; half of these must have
    the coverage ``mask_bd``.
    """
    n, w = n_rt.shape
    subs = sub if isinstance(sub, tuple) else (sub,)
    out = np.full((len(subs), n, w), np.nan)
    answer = out if isinstance(sub, tuple) else out[0]
    low = (d_bd >= low_bd).sum(axis=1) < w // 5
    if mask is not None:
        for at in _let_in(mask, ~low):
            out[:, *at] = score_windows(n_rt[at], n_bd[at], d_rt[at], d_bd[at], None, enrich, subs, div, add, sample, index, calc, winsor, mask_bd, 0.0, -1)
        return answer
    go = ~low & ((d_bd >= min_bd).sum(axis=1) > w // 2) & (n_rt.mean(axis=1) >= min_rt)
    if not go.any():
        return answer
    a, b, c, d = (x[go].astype(float) for x in (n_rt, n_bd, d_rt, d_bd))
    fa, fb, fc, fd = (_factors(x, sample, index, calc)[:, None] for x in (a, b, c, d))
    for k, less in enumerate(subs):
        with np.errstate(all="ignore"):
            s = {
                "sub": lambda: a / fa - less * (c / fc),  # noqa: B023 - called at once
                "div": lambda: np.where(d > 0, div * (b / fb) / (d / fd), np.nan),
                "complex": lambda: np.where(d > 0, div * (a / fa - less * (c / fc)) / (d / fd), np.nan),  # noqa: B023
                "log": lambda: np.where(d > 0, np.log2((a + add) / (c + add)), np.nan),
            }[enrich]()
        out[k][go] = _winsor(s, winsor)
    return answer


def _let_in(mask: np.ndarray, rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, column) of the places that a mask lets in, a matrix of them for all of ``rows`` with equally many."""
    some = np.flatnonzero(rows)
    n, at = mask[some].sum(axis=1), np.argsort(~mask[some], axis=1, kind="stable")
    for k in np.unique(n[n > 0]):
        yield some[n == k][:, None], at[n == k][:, :k]


def score_windows_noctrl(rt, bd, mask=None, enrich="rt", add=1.0, sink=0.0, winsor=0.05, min_bd=50, min_rt=1.0, low_bd=10, mask_bd=100) -> np.ndarray:
    """Scores of windows of one sample, one a row: enrichment, sink (the value at rank floor(sink * n), missing ones lowest), winsorisation."""
    n, w = rt.shape
    out = np.full((n, w), np.nan)
    low = (bd >= low_bd).sum(axis=1) < w // 5
    if mask is not None:
        for at in _let_in(mask, ~low):
            out[at] = score_windows_noctrl(rt[at], bd[at], None, enrich, add, sink, winsor, mask_bd, 0.0, -1)
        return out
    go = ~low & ((bd >= min_bd).sum(axis=1) > w // 2) & (rt.mean(axis=1) >= min_rt)
    if not go.any():
        return out
    a, b = rt[go].astype(float), bd[go].astype(float)
    with np.errstate(all="ignore"):
        s = np.where(b > 0, {"rt": lambda: a, "div": lambda: a / b, "log": lambda: np.log2(a + add)}[enrich](), np.nan)
    if sink:
        base = np.sort(np.where(np.isnan(s), -np.inf, s), axis=1)[:, min(int(sink * w), w - 1)]
        s = s - np.where(np.isinf(base), 0.0, base)[:, None]
    out[go] = _winsor(s, winsor)
    return out


def tile_map(low: np.ndarray, wstep: int, jump: int, first: bool = False) -> np.ndarray:
    """Where the data-dependent grid leaves a tile, for each place where it can enter: both counted from a border, below ``jump``.

    A start of low expression is followed after ``jump`` places, any other after ``wstep``. The grid begins at place 0 of the
    ``first`` tile with a step of ``wstep``, wherever it is said to enter.
    """
    n = len(low)
    step = np.where(low, jump, wstep)
    if first and n:
        step[0] = wstep
    to = np.arange(n + jump)
    for hi in range(n, 0, -wstep):  # no step is shorter, so the starts of a stretch all lead behind it
        at = np.arange(max(hi - wstep, 0), hi)
        to[at] = to[at + step[at]]
    return np.full(jump, to[0] - n) if first else to[:jump] - n


def empty_map(length: int, jump: int) -> np.ndarray:
    """``tile_map`` of a tile, or of a stretch of tiles, without any coverage."""
    return (np.arange(jump) - length) % jump


def starts_from(entry: int, low: np.ndarray, last: int, wstep: int, jump: int, first: bool = False) -> np.ndarray:
    """The window starts from place ``entry`` on to the end of ``low``, all counted from the same place; at ``last`` stands the last one."""
    end, out, at = min(len(low), last), [], entry
    while at < end:
        out.append(at)
        at += wstep if first and at == 0 else jump if low[at] else wstep
    return np.array([*out, last] if 0 <= last < len(low) else out, dtype=np.int64)


#: Tiles whose maps are joined into one in a task.
BLOCK = 1024


def _grid_entries(maps: DataFrame, tile: int, wsize: int, wstep: int, jump: int) -> DataFrame:
    """``maps`` (contig, strand, tile, map) → contig, strand, tile, entry: where the grid enters each tile.

    Maps of ``BLOCK`` tiles are joined into one, the few blocks of a contig are passed through one after another, and then the
    tiles of each block.
    """
    key, maps = ["contig", "strand"], scan.save(maps.withColumn("block", F.floor(F.col("tile") / BLOCK)), "tile_maps")

    def gap(t: int, k: int) -> np.ndarray:
        """The map of tiles t to k - 1, none of which has any coverage; the first tile is shorter, and so is its first step."""
        return empty_map((k - t) * tile, jump) if t else np.full(jump, (wstep - (k * tile - wsize)) % jump)

    def steps(pdf: pd.DataFrame, t: int) -> Iterator[tuple[int, np.ndarray]]:
        """The tiles' maps in order from tile t on, and in front of each the stretch without any."""
        for k, raw in sorted(zip(pdf["tile"], pdf["map"], strict=True)):
            if k > t:
                yield -1, gap(t, int(k))
            yield int(k), np.frombuffer(raw, dtype=np.int32)
            t = int(k) + 1

    def joined(name: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        whole, at = np.arange(jump), int(name[2]) * BLOCK
        for k, step in steps(pdf, at):
            whole, at = step[whole], max(at, k + 1)
        end = (int(name[2]) + 1) * BLOCK
        whole = gap(at, end)[whole] if end > at else whole
        return pd.DataFrame({"contig": [name[0]], "strand": [name[1]], "block": [name[2]], "map": [whole.astype(np.int32).tobytes()]})

    def entered(name: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        at, found, b = 0, [], 0
        for block, raw in sorted(zip(pdf["block"], pdf["map"], strict=True)):
            if block > b:
                at = int(gap(b * BLOCK, int(block) * BLOCK)[at])
            found.append(at)
            at, b = int(np.frombuffer(raw, dtype=np.int32)[at]), int(block) + 1
        return pd.DataFrame({"contig": name[0], "strand": name[1], "block": sorted(pdf["block"]), "at": found})

    def spread(name: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        at, found = int(right["at"].iloc[0]), []
        for k, step in steps(left, int(name[2]) * BLOCK):
            if k >= 0:
                found.append((name[0], name[1], k, at))
            at = int(step[at])
        return pd.DataFrame(found, columns=[*key, "tile", "entry"])

    blocks = maps.groupBy(*key, "block").applyInPandas(joined, "contig string, strand string, block long, map binary")
    entries = blocks.groupBy(*key).applyInPandas(entered, "contig string, strand string, block long, at long")  # a row for each 1,024 tiles
    return maps.groupBy(*key, "block").cogroup(entries.groupBy(*key, "block")).applyInPandas(spread, "contig string, strand string, tile long, entry long")


def sliding_score(
    counts: DataFrame, sizes: DataFrame, junctions: DataFrame | None = None, wsize: int = 200, wstep: int = 5, grid: str = "exact", bases: str | tuple[str, ...] | None = None,
    min_cov: int = 100, out_min_cov: int = 50, tile: int = 20_000, control: bool = True, **scoring,
) -> DataFrame:
    """Sliding-window scores: contig, strand, pos, n_rt, n_bd, d_rt, d_bd, score, n_windows, valid_count.

    The axis of a contig and strand starts at the first treated stop and leaves out the kept ``junctions`` (non-overlapping,
    sorted). ``grid='fixed'`` starts windows at all multiples of ``wstep`` from there, and once more at the end;
    ``'exact'`` follows the data-dependent step (wsize - 1 after a low-expression window). The axis is cut into tiles; each
    tile is scored alone with a halo of ``wsize`` places on both sides, so no contig is held in one task. For the exact grid each
    tile tells where it is left for every place where it can be entered, and these maps are joined. With ``bases`` (and a column base in counts) only
    these bases are ranked against each other; a tuple of them ranks each of its strings apart, in one pass, and its rows have the
    column base (a base in several strings has several rows). A tuple of ``sub`` gives a row, with the column sub, for each of them. Contigs under 2 * wsize bases are skipped. Rows need a stop or out_min_cov.
    Without ``control`` the counts are rt and bd of one sample, and so are the columns of the result.
    """
    key, names, extra = _columns(grid, bases, control)
    big = sizes.where(F.col("length") >= 2 * wsize).select("contig", F.col("length").cast("long").alias("length"))
    counts = scan.save(counts.select(*key, "pos", *names, *extra), "counts")  # read for the origins, the grid and the tiles
    rows = counts.join(small(big), "contig").where("pos between 1 and length")
    origin = scan.save(rows.groupBy(*key, "length").agg(F.min(F.when(F.col(names[0]) > 0, F.col("pos"))).alias("origin")).where("origin is not null"), "origins")
    rows = rows.drop("length").join(small(origin), key).where("pos >= origin")
    ends = origin.withColumn("size", F.col("length") - F.col("origin") + 1)
    if junctions is None:
        rows = rows.withColumn("at", F.col("pos") - F.col("origin"))
    else:
        cut = junctions.join(small(origin.select(*key, "origin")), key).where("first >= origin").select(*key, F.col("first").cast("long").alias("pos"), F.col("second").cast("long").alias("second"))
        # in the order of places each count meets what the junctions before it have taken, and the end of the last one
        both = rows.withColumn("_row", F.lit(1)).unionByName(cut.withColumn("_row", F.lit(0)), allowMissingColumns=True)
        known = scan.before(scan.ranged(both, key, ["pos", "_row"]), key, n_cut=F.col("second") - F.col("pos") + 1, max_second=F.col("second"))
        rows = known.where("_row = 1 and (max_second is null or max_second < pos)").withColumn("at", F.col("pos") - F.col("origin") - F.coalesce("n_cut", F.lit(0))).drop("_row", "second", "n_cut", "max_second", scan.PART, scan.AT)
        taken = cut.groupBy(*key).agg(F.sum(F.col("second") - F.col("pos") + 1).alias("_taken"))
        ends = ends.join(taken, key, "left").withColumn("size", F.col("size") - F.coalesce("_taken", F.lit(0)))
    ends = ends.where(F.col("size") >= wsize).select(*key, "size")
    return _score_axes(rows.join(small(ends), key), names, wsize, wstep, wsize - 1, grid, bases, min_cov, out_min_cov, tile, scoring)


def sliding_junction(
    counts: DataFrame, junctions: DataFrame, wsize: int = 200, wstep: int = 5, grid: str = "exact", bases: str | None = None,
    min_cov: int = 100, out_min_cov: int = 50, tile: int = 20_000, stretch: int = 4096, control: bool = True, **scoring,
) -> DataFrame:
    """The scores of the places inside each junction of at least ``wsize`` bases; the columns are those of ``sliding_score``.

    The axis of a junction is the genome from wsize - 1 bases before its first one to its last one, whatever stops it holds.
    After a low-expression window the exact grid steps wsize / 2. A place in several junctions has a row for each of them.
    Axes of up to ``stretch`` places are scored with all others that begin near them, longer ones one by one and cut into tiles.
    """
    key, names, extra = _columns(grid, bases, control)
    counts = scan.save(counts.select(*key, "pos", *names, *extra), "counts")  # read for short and for long junctions
    long = junctions.where(F.col("second") - F.col("first") + 1 >= wsize)
    axis = F.when(F.col("first") > wsize, F.col("first") - wsize + 1).otherwise(F.lit(1).cast("long"))
    spans = scan.save(long.select("contig", "strand", axis.cast("long").alias("first"), F.col("second").cast("long").alias("second"), F.col("first").cast("long").alias("start")), "spans")
    reach = F.col("second") - F.col("first") < stretch
    near = _score_spans(counts, spans.where(reach), names, wsize, wstep, grid, bases, min_cov, out_min_cov, stretch, scoring)
    spans = spans.where(~reach)
    if spans.isEmpty():
        return near
    points = counts.select(*key, F.col("pos").alias("first"), F.col("pos").alias("second"), *names, *extra)
    inside = interval_join(points, spans, widest=1)
    name = F.concat_ws(":", "contig", "strand", "start", "r_second")
    rows = inside.select(name.alias("contig"), "strand", F.col("first").alias("pos"), (F.col("first") - F.col("r_first")).alias("at"), (F.col("r_second") - F.col("r_first") + 1).alias("size"), *names, *extra)
    scored = _score_axes(rows, names, wsize, wstep, wsize // 2, grid, bases, min_cov, out_min_cov, tile, scoring)
    parts = F.split("contig", ":")
    at = lambda k: F.element_at(parts, k).cast("long")
    named = F.array_join(F.slice(parts, F.lit(1), F.size(parts) - 3), ":")
    return near.unionByName(scored.where(F.col("pos") >= at(-2)).withColumn("contig", named))


def _score_spans(counts: DataFrame, spans: DataFrame, names: list[str], wsize: int, wstep: int, walk: str, bases: str | None, min_cov: int, out_min_cov: int, stretch: int, scoring: dict) -> DataFrame:
    """Scores of the places from ``start`` on in spans (first, second, start) of up to ``stretch`` places.

    A task takes the spans that begin in a stretch of the genome, and the counts of that and the next one once for all of them. What a
    window holds depends on its place only, so spans that overlap share it: it is scored once.
    """
    key, cover, window = _KEY, names[-1], score_windows if len(names) == 4 else score_windows_noctrl
    low_bd, jump = scoring.get("low_bd", 10), wsize // 2
    letters = set(bases.replace("U", "T")) if bases else set()
    several = isinstance(scoring.get("sub"), tuple)
    grid = scoring["sub"] if several else (None,)
    columns = [*key, "pos", *names, "score", "n_windows", "valid_count", *(["sub"] if several else [])]

    def score_stretch(name: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame(columns=columns)
        lo = int(name[2]) * stretch
        place = left["pos"].to_numpy() - lo
        dense = np.zeros((len(names), 2 * stretch))
        dense[:, place] = left[names].to_numpy().T
        row = np.full(2 * stretch, -1)
        row[place] = np.arange(len(place))
        mask = None
        if bases:
            mask = np.zeros(2 * stretch, dtype=bool)
            mask[place] = left["base"].str.replace("U", "T").isin(letters).to_numpy()
        seen = np.concatenate([[0], np.cumsum(dense[-1] >= low_bd)])
        axes = []
        for first, second, start in right[["first", "second", "start"]].to_numpy() - lo:
            size = int(second - first + 1)
            if walk == "fixed":
                s = np.arange(0, size - wsize + 1, wstep)
                s = np.append(s, size - wsize) if (size - wsize) % wstep else s
            else:
                at = np.arange(first, second + 1)
                low = seen[np.minimum(at + wsize, second + 1)] - seen[at] < wsize // 5
                s = starts_from(0, low, size - wsize, wstep, jump, True)
            axes.append((int(start), int(second), s + int(first)))
        starts = np.unique(np.concatenate([s for *_, s in axes]))
        scored = np.concatenate([np.asarray(window(*(x[index] for x in dense), mask=None if mask is None else mask[index], **{"mask_bd": min_cov, **scoring})).reshape(len(grid), len(index), wsize) for index in (part[:, None] + np.arange(wsize) for part in np.array_split(starts, max(1, len(starts) // 2000)))], axis=1)
        ok = ~np.isnan(scored)
        scored[~ok] = 0.0
        shown = (left[names[::2]] >= 1).any(axis=1).to_numpy() | (left[cover] >= out_min_cov).to_numpy()
        if mask is not None:
            shown = shown & mask[place]
        out = []
        for start, second, s in axes:
            begin, which = int(s[0]), np.searchsorted(starts, s)
            size = second - begin + 1
            total_sum, good, n = np.zeros((len(grid), size)), np.zeros((len(grid), size)), np.zeros(size)
            for k, at in zip(which, s - begin, strict=True):
                total_sum[:, at : at + wsize] += scored[:, k]
                good[:, at : at + wsize] += ok[:, k]
                n[at : at + wsize] += 1
            mine = row[start : second + 1]
            mine = mine[mine >= 0]
            mine = mine[shown[mine]]
            at = place[mine] - begin
            enough = (n[at] >= 2) & (good[:, at] > n[at] // 2) & (dense[-1][place[mine]] >= min_cov)
            with np.errstate(all="ignore"):
                out.append((mine, np.where(enough, total_sum[:, at] / good[:, at], np.nan), n[at], np.where(n[at] < 2, 0, good[:, at])))
        mine, n = np.concatenate([x[0] for x in out]), np.concatenate([x[2] for x in out])
        parts = []
        for k, less in enumerate(grid):
            part = left.iloc[mine][[*key, "pos", *names]].reset_index(drop=True)
            score = np.concatenate([x[1][k] for x in out])
            part["score"] = pd.array(score, dtype="Float64")
            part.loc[np.isnan(score), "score"] = None
            part["n_windows"], part["valid_count"] = n.astype(np.int64), np.concatenate([x[3][k] for x in out]).astype(np.int64)
            parts.append(part.assign(sub=less) if several else part)
        return pd.concat(parts)[columns]

    schema = "contig string, strand string, pos long, " + ", ".join(f"{c} long" for c in names) + ", score double, n_windows long, valid_count long" + ", sub double" * several
    b = F.floor(F.col("pos") / stretch)
    dealt = counts.where("pos >= 1").withColumn("_b", F.explode(F.array(b, b - 1)))
    begun = spans.withColumn("_b", F.floor(F.col("first") / stretch))
    return dealt.groupBy(*key, "_b").cogroup(begun.groupBy(*key, "_b")).applyInPandas(score_stretch, schema)


def _columns(grid: str, bases: str | None, control: bool) -> tuple[list[str], list[str], list[str]]:
    if grid not in ("exact", "fixed"):
        raise ValueError("grid must be exact or fixed")
    return ["contig", "strand"], ["n_rt", "n_bd", "d_rt", "d_bd"] if control else ["rt", "bd"], ["base"] if bases else []


def separate_bases(score_of, bases: str) -> DataFrame:
    """``score_of(base)`` for each letter of ``bases`` (T and U are one), so that a base is ranked against its own kind only; rows of all."""
    letters = list(dict.fromkeys(bases.replace("U", "T")))
    parts = [score_of(b) for b in letters]
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def _score_axes(rows: DataFrame, names: list[str], wsize: int, wstep: int, jump: int, walk: str, bases: str | tuple[str, ...] | None, min_cov: int, out_min_cov: int, tile: int, scoring: dict) -> DataFrame:
    """Rows (contig, strand, pos, at, size, counts) on axes of ``size`` places → scores, tile by tile."""
    tile = max(tile, 2 * wsize)  # a window lies in two tiles at most, and a step ends in the next one
    key, cover, window = ["contig", "strand"], names[-1], score_windows if len(names) == 4 else score_windows_noctrl
    last = F.floor((F.col("size") - 1) / tile)
    # a tile also sees the halo: places up to wsize before its first and after its last
    tiles = F.sequence(F.greatest(F.floor((F.col("at") - 2 * wsize) / tile), F.lit(0)), F.least(F.floor((F.col("at") + 2 * wsize) / tile), last))
    extra = ["base"] if bases else []
    keep = ["pos", "at", "size", *names, *extra]
    spread = rows.select(*key, *keep, F.explode(tiles).alias("tile"))
    grouped = spread.groupBy(*key, "tile")
    low_bd = scoring.get("low_bd", 10)
    apart = isinstance(bases, tuple)
    kinds = bases if apart else (bases,)
    several = isinstance(scoring.get("sub"), tuple)
    grid = scoring["sub"] if several else (None,)

    def axis(t: int, size: int, pdf: pd.DataFrame) -> tuple[int, int, np.ndarray]:
        """First place and end of a tile with its halo, and the places of its rows from there."""
        lo, hi = max(t * tile - 2 * wsize, 0), min((t + 1) * tile + 2 * wsize, size)
        return lo, hi, pdf["at"].to_numpy() - lo

    def is_low(cover_at: np.ndarray, lo: int, first: int, end: int) -> np.ndarray:
        """Whether the window at each place from first to end - 1 is of low expression; there is no coverage behind the axis."""
        seen = np.concatenate([[0], np.cumsum(cover_at >= low_bd)])
        at = np.arange(first, end) - lo
        return seen[np.minimum(at + wsize, len(seen) - 1)] - seen[np.minimum(at, len(seen) - 1)] < wsize // 5

    def border(t: int) -> int:
        """Where the stretch of a tile begins on the grid: early enough for every window that touches the tile."""
        return max(t * tile - wsize, 0)

    def mapped(name: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        t, size = int(name[2]), int(pdf["size"].iloc[0])
        lo, hi, place = axis(t, size, pdf)
        depth = np.zeros(hi - lo)
        depth[place] = pdf[cover].to_numpy()
        got = tile_map(is_low(depth, lo, border(t), border(t + 1)), wstep, jump, t == 0)
        return pd.DataFrame({"contig": [name[0]], "strand": [name[1]], "tile": [t], "map": [got.astype(np.int32).tobytes()]})

    def score_tile(name: tuple, pdf: pd.DataFrame, given) -> pd.DataFrame:
        t, size = int(name[2]), int(pdf["size"].iloc[0])
        lo, hi, place = axis(t, size, pdf)
        dense = np.zeros((len(names), hi - lo))
        dense[:, place] = pdf[names].to_numpy().T
        masks = []
        for kind in kinds if bases else ():
            masks.append(np.zeros(hi - lo, dtype=bool))
            masks[-1][place] = pdf["base"].str.replace("U", "T").isin(set(kind.replace("U", "T"))).to_numpy()
        end = min((t + 1) * tile, size)
        if given is None:
            first = max(-(-(t * tile - wsize + 1) // wstep) * wstep, 0)
            s = np.arange(first, min(end, size - wsize + 1), wstep)
            if size - wsize > t * tile - wsize and size - wsize < end and (size - wsize) % wstep:
                s = np.append(s, size - wsize)
        else:
            from_ = border(t)
            s = from_ + starts_from(given, is_low(dense[-1], lo, from_, (t + 1) * tile), size - wsize - from_, wstep, jump, t == 0)
        mine = (pdf["at"] // tile == t).to_numpy()
        out = []
        for kind, mask in zip(kinds, masks or [None], strict=True):
            rows = scored_rows(pdf, mine, place, dense, s - lo, mask)
            out += [one.assign(base=kind) if apart else one for one in rows]
        return pd.concat(out)

    def scored_rows(pdf: pd.DataFrame, mine: np.ndarray, place: np.ndarray, dense: np.ndarray, s: np.ndarray, mask: np.ndarray | None) -> list[pd.DataFrame]:
        """The rows ``mine`` with their scores from the windows that start at ``s``, for each of ``grid``."""
        size = dense.shape[1]
        total_sum, good, n = np.zeros((len(grid), size)), np.zeros((len(grid), size)), np.zeros(size)
        for part in np.array_split(s, max(1, len(s) // 2000)):
            if not len(part):
                continue
            index = part[:, None] + np.arange(wsize)
            got = window(*(x[index] for x in dense), mask=None if mask is None else mask[index], **{"mask_bd": min_cov, **scoring})
            for k, one in enumerate(got if several else got[None]):
                ok = ~np.isnan(one)
                np.add.at(total_sum[k], index, np.where(ok, one, 0.0))
                np.add.at(good[k], index, ok)
            np.add.at(n, index, 1)
        at = place[mine]
        out = []
        for k, less in enumerate(grid):
            enough = (n[at] >= 2) & (good[k][at] > n[at] // 2) & (dense[-1][at] >= min_cov)
            with np.errstate(all="ignore"):
                score = np.where(enough, total_sum[k][at] / good[k][at], np.nan)
            part = pdf.loc[mine, ["contig", "strand", "pos", *names]].copy()
            part["score"] = pd.array(score, dtype="Float64")
            part.loc[np.isnan(score), "score"] = None
            part["n_windows"], part["valid_count"] = n[at].astype(np.int64), np.where(n[at] < 2, 0, good[k][at]).astype(np.int64)
            shown = (part[names[::2]] >= 1).any(axis=1) | (part[cover] >= out_min_cov)
            part = part[shown & mask[at]] if mask is not None else part[shown]
            out.append(part.assign(sub=less) if several else part)
        return out

    schema = "contig string, strand string, pos long, " + ", ".join(f"{c} long" for c in names) + ", score double, n_windows long, valid_count long" + ", sub double" * several + ", base string" * apart
    if walk == "fixed":
        return grouped.applyInPandas(lambda name, pdf: score_tile(name, pdf, None), schema)
    entries = _grid_entries(grouped.applyInPandas(mapped, "contig string, strand string, tile long, map binary"), tile, wsize, wstep, jump)

    def both(name: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return score_tile(name, left, int(right["entry"].iloc[0]))

    return grouped.cogroup(entries.groupBy(*key, "tile")).applyInPandas(both, schema)


def output_filter_gtab(scored: DataFrame, out_min_cov: int = 50) -> DataFrame:
    """Rows with a stop in either condition or enough control coverage."""
    return scored.where(f"n_rt >= 1 or d_rt >= 1 or d_bd >= {int(out_min_cov)}")


def gtab_valid_shape(gtab: DataFrame, min_bd: int = 200) -> DataFrame:
    """shape is null where bd < min_bd; rows without a stop and without a shape go."""
    return gtab.withColumn("shape", F.when(F.col("bd") >= min_bd, F.col("shape"))).where("rt >= 1 or shape is not null")


def combine_gtab(gtab1: DataFrame, gtab2: DataFrame) -> DataFrame:
    """Positions with a shape in both: contig, strand, pos, shape_1, shape_2."""
    key = ["contig", "strand", "pos"]
    one, two = (g.where("shape is not null").select(*key, F.col("shape").alias(f"shape_{i}")) for i, g in ((1, gtab1), (2, gtab2)))
    return one.join(two, key)


def mask_by_base(counts: DataFrame, bases: str) -> DataFrame:
    """Rows whose ``base`` is one of ``bases`` (T and U are one letter)."""
    return counts.where(F.translate("base", "U", "T").isin(list(bases.replace("U", "T"))))
