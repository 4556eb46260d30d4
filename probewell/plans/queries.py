"""Registered queries over the star-schema tables (by way of the adapters), with the SQL of the same meaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import cigar, sequence
from ..operators import annotation, coords, duplex, matrix, pileup, qc, reads, scan, score, tracks
from . import adapters as a
from .registry import ORACLES, QUERIES, query

# ---- pile-up ---------------------------------------------------------------------------------------------------------


@query("base_density", f"WITH {a.COUNTS} SELECT contig, strand, condition, pos, bd FROM base_bd")
def _base_density(spark, d):
    r = a.reads(spark, d)
    return pileup.base_density(r, by=("condition",))


@query("rt_stops", f"WITH {a.COUNTS} SELECT contig, strand, condition, pos, rt FROM base_rt")
def _rt_stops(spark, d):
    return pileup.rt_stops(a.reads(spark, d), by=("condition",))


@query(
    "rt_junction_shift",
    f"""WITH {a.JUNCTIONS}, moved AS (SELECT contig, strand, CASE WHEN strand = '+' THEN second + 1 ELSE first - 1 END AS end5, min(CASE WHEN strand = '+' THEN first - 1 ELSE second + 1 END) AS m FROM junctions GROUP BY ALL)
    SELECT e.contig, e.strand, coalesce(m, CASE WHEN e.strand = '+' THEN e.end5 - 1 ELSE e.end5 + 1 END) AS pos, CAST(count(*) AS BIGINT) AS rt
    FROM ends e LEFT JOIN moved j ON e.contig = j.contig AND e.strand = j.strand AND e.end5 = j.end5 GROUP BY ALL""",
)
def _rt_junction_shift(spark, d):
    return pileup.rt_stops(a.reads(spark, d), a.junctions(spark, d))


@query(
    "junction_support",
    f"""WITH {a.JUNCTIONS} SELECT j.contig, j.strand, j.first, j.second, CAST(count(r.read_id) AS BIGINT) AS support FROM junctions j
    LEFT JOIN reads r ON r.split AND j.contig = r.contig AND j.strand = r.strand AND j.first = r.e1 + 1 AND j.second = r.s1 + 199 GROUP BY ALL""",
)
def _junction_support(spark, d):
    return pileup.junction_support(a.reads(spark, d), a.junctions(spark, d))


@query("combine_junctions")
def _combine_junctions(spark, d):
    r = a.reads(spark, d)
    return pileup.combine_junctions(pileup.junction_support(r, a.junctions(spark, d)), a.sizes(r))


@query("condition_counts", f"WITH {a.COUNTS} SELECT contig, strand, pos, n_rt, n_bd, d_rt, d_bd FROM counts JOIN sizes USING (contig) WHERE pos <= length")
def _condition_counts(spark, d):
    r = a.reads(spark, d)
    return pileup.condition_counts(r, a.sizes(r))


@query(
    "replicate_outer_join",
    f"WITH {a.COUNTS} SELECT contig, strand, pos, d_bd AS \"bd_D\", n_bd AS \"bd_N\", d_rt AS \"rt_D\", n_rt AS \"rt_N\" FROM counts JOIN sizes USING (contig) WHERE pos <= length AND (n_rt >= 1 OR d_rt >= 1 OR n_bd >= 50 OR d_bd >= 50)",
)
def _replicate_outer_join(spark, d):
    r = a.reads(spark, d)
    long = pileup.count_rt(r.withColumnRenamed("condition", "sample"), a.sizes(r))
    return pileup.replicate_outer_join(long, ["N", "D"])


# ---- scores ----------------------------------------------------------------------------------------------------------

_ENRICHED = a.COUNTS + """,
enriched AS (SELECT *, CASE WHEN d_bd > 0 THEN 10.0 * (n_rt - 0.25 * d_rt) / d_bd END AS score FROM counts JOIN sizes USING (contig) WHERE pos <= length)"""


def _counts(spark, d):
    r = a.reads(spark, d)
    return pileup.condition_counts(r, a.sizes(r))


def _enrich_sql(expression: str) -> str:
    return f"WITH {a.COUNTS} SELECT contig, strand, pos, round({expression}, 6) AS score FROM counts JOIN sizes USING (contig) WHERE pos <= length"


for _method, _sql in {
    "sub": "n_rt - 0.25 * d_rt",
    "div": "CASE WHEN d_bd > 0 THEN 10.0 * n_bd / d_bd END",
    "complex": "CASE WHEN d_bd > 0 THEN 10.0 * (n_rt - 0.25 * d_rt) / d_bd END",
    "log": "CASE WHEN d_bd > 0 THEN log2((n_rt + 1.0) / (d_rt + 1.0)) END",
}.items():
    query(f"enrich_ctrl_{_method}", _enrich_sql(_sql))(lambda spark, d, m=_method: score.enrich_ctrl(_counts(spark, d), m).select("contig", "strand", "pos", F.round("score", 6).alias("score")))

for _method, _sql in {"rt": "n_rt * 1.0", "div": "n_rt * 1.0 / n_bd", "log": "log2(n_rt + 1.0)"}.items():
    query(f"enrich_noctrl_{_method}", _enrich_sql(f"CASE WHEN n_bd > 0 THEN {_sql} END"))(
        lambda spark, d, m=_method: score.enrich_noctrl(_counts(spark, d).withColumnsRenamed({"n_rt": "rt", "n_bd": "bd"}), m).select("contig", "strand", "pos", F.round("score", 6).alias("score"))
    )

_RANKED = a.COUNTS + """,
ranked AS (SELECT contig, strand, CAST(n_bd AS DOUBLE) AS v, row_number() OVER (PARTITION BY contig, strand ORDER BY n_bd DESC) - 1 AS r, count(*) OVER (PARTITION BY contig, strand) AS n
  FROM counts JOIN sizes USING (contig) WHERE pos <= length)"""
for _sample, _range in {"smart": "v > 0", "upper": "r < floor(n / 2.0)", "quartile": "r >= floor(1 * n / 4.0) AND r < floor(2 * n / 4.0)", "decile": "r >= floor(1 * n / 10.0) AND r < floor(2 * n / 10.0)", "vigintile": "r >= floor(1 * n / 20.0) AND r < floor(2 * n / 20.0)"}.items():
    for _calc, _agg in {"median": "median", "mean": "avg", "peak": "max"}.items():
        query(f"scaling_factor_{_sample}_{_calc}", f"WITH {_RANKED} SELECT contig, strand, round(coalesce({_agg}(CASE WHEN {_range} THEN v END), 1.0), 6) AS factor FROM ranked GROUP BY ALL")(
            lambda spark, d, s=_sample, c=_calc: score.scaling_factor(_counts(spark, d), "n_bd", ["contig", "strand"], s, 2, c).withColumn("factor", F.round("factor", 6))
        )

_WINSOR = """,
{name}r AS (SELECT contig, strand, score AS v, row_number() OVER (PARTITION BY contig, strand ORDER BY score) - 1 AS r, count(*) OVER (PARTITION BY contig, strand) AS n FROM {source} WHERE score IS NOT NULL),
{name}b AS (SELECT contig, strand, greatest(max(CASE WHEN r = floor(0.05 * n) THEN v END), 0.0) AS lo, max(CASE WHEN r = n - 1 - floor(0.05 * n) THEN v END) AS hi, max(n) AS n FROM {name}r GROUP BY ALL)"""
_SCALED = "CASE WHEN score IS NOT NULL AND n >= 20 AND lo < hi THEN least(greatest((score - lo) / (hi - lo), 0.0), 1.0) END"


@query("winsorize", f"WITH {_ENRICHED}{_WINSOR.format(name='w', source='enriched')} SELECT e.contig, e.strand, e.pos, round({_SCALED}, 6) AS score FROM enriched e LEFT JOIN wb USING (contig, strand)")
def _winsorize(spark, d):
    return score.winsorize(score.enrich_ctrl(_counts(spark, d)), "score", ["contig", "strand"]).select("contig", "strand", "pos", F.round("score", 6).alias("score"))


@query(
    "sink_score",
    f"""WITH {_ENRICHED}, r AS (SELECT *, row_number() OVER (PARTITION BY contig, strand ORDER BY score NULLS FIRST) - 1 AS r, count(*) OVER (PARTITION BY contig, strand) AS n FROM enriched),
    b AS (SELECT contig, strand, max(CASE WHEN r = least(floor(0.3 * n), n - 1) THEN score END) AS b FROM r GROUP BY ALL)
    SELECT contig, strand, pos, round(score - coalesce(b, 0.0), 6) AS score FROM enriched JOIN b USING (contig, strand)""",
)
def _sink_score(spark, d):
    return score.sink_score(score.enrich_ctrl(_counts(spark, d)), "score", ["contig", "strand"], 0.3).select("contig", "strand", "pos", F.round("score", 6).alias("score"))


_TENS = "CAST(floor(pos / 100) AS BIGINT) AS win"


@query("valid_cov", f"WITH {_ENRICHED} SELECT contig, strand, {_TENS}, sum(CASE WHEN d_bd >= 5 THEN 1 ELSE 0 END) > floor(count(*) / 2.0) AND avg(n_rt) >= 0.5 AS valid FROM enriched GROUP BY ALL")
def _valid_cov(spark, d):
    return score.valid_cov(_counts(spark, d).withColumn("win", F.floor(F.col("pos") / 100)), ["contig", "strand", "win"], "d_bd", "n_rt", 5, 0.5)


@query("low_exp_region", f"WITH {_ENRICHED} SELECT contig, strand, {_TENS}, sum(CASE WHEN d_bd >= 10 THEN 1 ELSE 0 END) < floor(count(*) / 5.0) AS low FROM enriched GROUP BY ALL")
def _low_exp_region(spark, d):
    return score.low_exp_region(_counts(spark, d).withColumn("win", F.floor(F.col("pos") / 100)), ["contig", "strand", "win"], "d_bd")


@query("mean_score", f"WITH {_ENRICHED} SELECT contig, strand, {_TENS}, round(CASE WHEN count(*) >= 2 AND count(score) > floor(count(*) / 2.0) THEN avg(score) END, 6) AS score, CAST(CASE WHEN count(*) >= 2 THEN count(score) ELSE 0 END AS BIGINT) AS valid_count FROM enriched GROUP BY ALL")
def _mean_score(spark, d):
    return score.mean_score(score.enrich_ctrl(_counts(spark, d)).withColumn("win", F.floor(F.col("pos") / 100)), ["contig", "strand", "win"]).withColumn("score", F.round("score", 6))


def _factor_sql(c: str, source: str) -> str:
    return f"""f_{c} AS (SELECT contig, strand, CASE WHEN f = 0 THEN 1.0 ELSE f END AS {c}_f FROM (SELECT contig, strand, coalesce(median(CASE WHEN r >= floor(n / 10.0) AND r < floor(2 * n / 10.0) THEN v END), 1.0) AS f
      FROM (SELECT contig, strand, CAST({c} AS DOUBLE) AS v, row_number() OVER (PARTITION BY contig, strand ORDER BY {c} DESC) - 1 AS r, count(*) OVER (PARTITION BY contig, strand) AS n FROM {source}) GROUP BY ALL))"""


_WHOLE = a.COUNTS + f""",
axis AS (SELECT contig, strand, length, unnest(range(0, length)) AS pos FROM (SELECT DISTINCT contig, strand, length FROM counts JOIN sizes USING (contig) WHERE length >= 50)),
fullt AS (SELECT x.contig, x.strand, x.length, x.pos, coalesce(n_rt, 0) AS n_rt, coalesce(n_bd, 0) AS n_bd, coalesce(d_rt, 0) AS d_rt, coalesce(d_bd, 0) AS d_bd FROM axis x LEFT JOIN counts c ON x.contig = c.contig AND x.strand = c.strand AND x.pos = c.pos),
okay AS (SELECT contig, strand FROM fullt WHERE pos <= length - 31 GROUP BY ALL HAVING sum(CASE WHEN d_bd >= 5 THEN 1 ELSE 0 END) > floor(count(*) / 2.0) AND avg(n_rt) >= 0.5),
win AS (SELECT fullt.* FROM fullt JOIN okay USING (contig, strand) WHERE pos <= length - 31),
{", ".join(_factor_sql(c, "win") for c in ("n_rt", "n_bd", "d_rt", "d_bd"))},
wscore AS (SELECT win.*, CASE WHEN d_bd > 0 THEN 10.0 * (n_rt / n_rt_f - 0.25 * (d_rt / d_rt_f)) / (d_bd / d_bd_f) END AS score FROM win JOIN f_n_rt USING (contig, strand) JOIN f_n_bd USING (contig, strand) JOIN f_d_rt USING (contig, strand) JOIN f_d_bd USING (contig, strand))"""


def whole_contig(spark, d):
    r = a.reads(spark, d)
    sizes = a.sizes(r)
    # thin coverage: the thresholds go with it, here and in the SQL
    return score.whole_contig_score(pileup.condition_counts(r, sizes), sizes, min_bd=5, min_rt=0.5).withColumn("score", _off_halves("score"))


def _off_halves(c):
    """Six decimals. Scores are simple fractions, many just between two decimals, where the order of a sum decides; so the cut lies off such values."""
    return F.floor(F.col(c) * 1e6 + 0.3137) / 1e6


query(
    "whole_contig_score",
    f"""WITH {_WHOLE}{_WINSOR.format(name='w', source='wscore')}
    SELECT f.contig, f.strand, f.pos, CAST(f.n_rt AS BIGINT) AS n_rt, CAST(f.n_bd AS BIGINT) AS n_bd, CAST(f.d_rt AS BIGINT) AS d_rt, CAST(f.d_bd AS BIGINT) AS d_bd, floor((CASE WHEN f.pos > 5 THEN {_SCALED} END) * 1e6 + 0.3137) / 1e6 AS score
    FROM fullt f LEFT JOIN wscore s ON f.contig = s.contig AND f.strand = s.strand AND f.pos = s.pos LEFT JOIN wb ON f.contig = wb.contig AND f.strand = wb.strand WHERE f.pos >= 1""",
)(whole_contig)


def _sliding(spark, d, grid):
    r = a.reads(spark, d)
    sizes = a.sizes(r)
    # thin coverage: thresholds go with it, here and in the SQL. The scores are simple fractions, many of which lie just
    # between two decimals, where the order of a sum decides; so the cut is placed off such values.
    return score.sliding_score(pileup.condition_counts(r, sizes), sizes, grid=grid, wsize=50, wstep=10, min_cov=5, out_min_cov=5, min_bd=5, min_rt=0.5, low_bd=2).withColumn("score", F.floor(F.col("score") * 1e6 + 0.3137) / 1e6)


def _win_factor(c: str) -> str:
    return f"""g_{c} AS (SELECT contig, strand, start, CASE WHEN f = 0 THEN 1.0 ELSE f END AS {c}_f FROM (SELECT contig, strand, start, coalesce(median(CASE WHEN r >= 5 AND r < 10 THEN v END), 1.0) AS f
      FROM (SELECT contig, strand, start, CAST({c} AS DOUBLE) AS v, row_number() OVER (PARTITION BY contig, strand, start ORDER BY {c} DESC) - 1 AS r FROM wrows) GROUP BY ALL))"""


query(
    "sliding_score_fixed",
    f"""WITH {a.COUNTS},
    org AS (SELECT contig, strand, length, min(CASE WHEN n_rt > 0 THEN pos END) AS origin FROM counts JOIN sizes USING (contig) WHERE length >= 100 AND pos BETWEEN 1 AND length GROUP BY ALL HAVING min(CASE WHEN n_rt > 0 THEN pos END) IS NOT NULL),
    org2 AS (SELECT *, length - origin + 1 AS size FROM org WHERE length - origin + 1 >= 50),
    st AS (SELECT contig, strand, origin, size, unnest(range(0, size - 49, 10)) AS start FROM org2 UNION SELECT contig, strand, origin, size, size - 50 FROM org2),
    wcells AS (SELECT contig, strand, origin, start, start + unnest(range(0, 50)) AS at FROM st),
    wrows AS (SELECT w.contig, w.strand, w.start, w.at, w.origin + w.at AS pos, coalesce(n_rt, 0) AS n_rt, coalesce(n_bd, 0) AS n_bd, coalesce(d_rt, 0) AS d_rt, coalesce(d_bd, 0) AS d_bd FROM wcells w LEFT JOIN counts c ON w.contig = c.contig AND w.strand = c.strand AND c.pos = w.origin + w.at),
    good AS (SELECT contig, strand, start FROM wrows GROUP BY ALL HAVING sum(CASE WHEN d_bd >= 2 THEN 1 ELSE 0 END) >= 10 AND sum(CASE WHEN d_bd >= 5 THEN 1 ELSE 0 END) > 25 AND avg(n_rt) >= 0.5),
    {", ".join(_win_factor(c) for c in ("n_rt", "n_bd", "d_rt", "d_bd"))},
    sc AS (SELECT w.contig, w.strand, w.start, w.pos, CASE WHEN d_bd > 0 THEN 10.0 * (n_rt / n_rt_f - 0.25 * (d_rt / d_rt_f)) / (d_bd / d_bd_f) END AS score FROM wrows w JOIN good USING (contig, strand, start) JOIN g_n_rt USING (contig, strand, start) JOIN g_n_bd USING (contig, strand, start) JOIN g_d_rt USING (contig, strand, start) JOIN g_d_bd USING (contig, strand, start)),
    sr AS (SELECT contig, strand, start, score AS v, row_number() OVER (PARTITION BY contig, strand, start ORDER BY score) - 1 AS r, count(*) OVER (PARTITION BY contig, strand, start) AS n FROM sc WHERE score IS NOT NULL),
    sb AS (SELECT contig, strand, start, greatest(max(CASE WHEN r = floor(0.05 * n) THEN v END), 0.0) AS lo, max(CASE WHEN r = n - 1 - floor(0.05 * n) THEN v END) AS hi, max(n) AS n FROM sr GROUP BY ALL),
    sw AS (SELECT contig, strand, pos, {_SCALED} AS score FROM sc JOIN sb USING (contig, strand, start)),
    per AS (SELECT w.contig, w.strand, w.pos, CAST(count(*) AS BIGINT) AS n_windows FROM wrows w GROUP BY ALL),
    val AS (SELECT contig, strand, pos, avg(score) AS score, CAST(count(score) AS BIGINT) AS good FROM sw GROUP BY ALL)
    SELECT c.contig, c.strand, c.pos, c.n_rt, c.n_bd, c.d_rt, c.d_bd, floor((CASE WHEN n_windows >= 2 AND coalesce(good, 0) > floor(n_windows / 2.0) AND d_bd >= 5 THEN val.score END) * 1e6 + 0.3137) / 1e6 AS score, n_windows, CASE WHEN n_windows < 2 THEN 0 ELSE coalesce(good, 0) END AS valid_count
    FROM counts c JOIN per USING (contig, strand, pos) LEFT JOIN val USING (contig, strand, pos) WHERE c.n_rt >= 1 OR c.d_rt >= 1 OR c.d_bd >= 5""",
)(lambda spark, d: _sliding(spark, d, "fixed"))

_ONE = """, one AS (SELECT contig, strand, pos, n_rt AS rt, n_bd AS bd FROM counts JOIN sizes USING (contig) WHERE pos <= length)"""


def _one_sample(spark, d):
    r = a.reads(spark, d)
    sizes = a.sizes(r)
    return pileup.condition_counts(r, sizes).select("contig", "strand", "pos", F.col("n_rt").alias("rt"), F.col("n_bd").alias("bd")), sizes


@query(
    "whole_contig_noctrl",
    f"""WITH {a.COUNTS}{_ONE},
    axis AS (SELECT contig, strand, length, unnest(range(0, length)) AS pos FROM (SELECT DISTINCT contig, strand, length FROM counts JOIN sizes USING (contig) WHERE length >= 50)),
    fullt AS (SELECT x.contig, x.strand, x.length, x.pos, coalesce(rt, 0) AS rt, coalesce(bd, 0) AS bd FROM axis x LEFT JOIN one c ON x.contig = c.contig AND x.strand = c.strand AND x.pos = c.pos),
    okay AS (SELECT contig, strand FROM fullt WHERE pos <= length - 31 GROUP BY ALL HAVING sum(CASE WHEN bd >= 5 THEN 1 ELSE 0 END) > floor(count(*) / 2.0) AND avg(rt) >= 0.5),
    raw AS (SELECT fullt.*, CASE WHEN bd > 0 THEN log2(rt + 1.0) END AS score FROM fullt JOIN okay USING (contig, strand) WHERE pos <= length - 31),
    rk AS (SELECT *, row_number() OVER (PARTITION BY contig, strand ORDER BY score NULLS FIRST) - 1 AS r, count(*) OVER (PARTITION BY contig, strand) AS n FROM raw),
    sunk AS (SELECT contig, strand, pos, bd, score - coalesce(b, 0.0) AS score FROM raw JOIN (SELECT contig, strand, max(CASE WHEN r = least(floor(0.2 * n), n - 1) THEN score END) AS b FROM rk GROUP BY ALL) USING (contig, strand))
    {_WINSOR.format(name='w', source='sunk')}
    SELECT f.contig, f.strand, f.pos, CAST(f.rt AS BIGINT) AS rt, CAST(f.bd AS BIGINT) AS bd, floor((CASE WHEN f.pos > 5 AND f.bd >= 8 THEN {_SCALED} END) * 1e6 + 0.3137) / 1e6 AS score
    FROM fullt f LEFT JOIN sunk s ON f.contig = s.contig AND f.strand = s.strand AND f.pos = s.pos LEFT JOIN wb ON f.contig = wb.contig AND f.strand = wb.strand WHERE f.pos >= 1""",
)
def _whole_noctrl(spark, d):
    counts, sizes = _one_sample(spark, d)
    return score.whole_contig_noctrl(counts, sizes, enrich="log", sink=0.2, min_cov=8, min_bd=5, min_rt=0.5).withColumn("score", _off_halves("score"))


_AVERAGED = """sr AS (SELECT {key}, start, score AS v, row_number() OVER (PARTITION BY {key}, start ORDER BY score) - 1 AS r, count(*) OVER (PARTITION BY {key}, start) AS n FROM sc WHERE score IS NOT NULL),
    sb AS (SELECT {key}, start, greatest(max(CASE WHEN r = floor(0.05 * n) THEN v END), 0.0) AS lo, max(CASE WHEN r = n - 1 - floor(0.05 * n) THEN v END) AS hi, max(n) AS n FROM sr GROUP BY ALL),
    sw AS (SELECT {key}, pos, {scaled} AS score FROM sc JOIN sb USING ({key}, start)),
    per AS (SELECT {key}, pos, CAST(count(*) AS BIGINT) AS n_windows FROM wrows GROUP BY ALL),
    val AS (SELECT {key}, pos, avg(score) AS score, CAST(count(score) AS BIGINT) AS good FROM sw GROUP BY ALL)"""

query(
    "sliding_noctrl_fixed",
    f"""WITH {a.COUNTS}{_ONE},
    org AS (SELECT contig, strand, length, min(CASE WHEN rt > 0 THEN pos END) AS origin FROM one JOIN sizes USING (contig) WHERE length >= 100 AND pos BETWEEN 1 AND length GROUP BY ALL HAVING min(CASE WHEN rt > 0 THEN pos END) IS NOT NULL),
    org2 AS (SELECT *, length - origin + 1 AS size FROM org WHERE length - origin + 1 >= 50),
    st AS (SELECT contig, strand, origin, size, unnest(range(0, size - 49, 10)) AS start FROM org2 UNION SELECT contig, strand, origin, size, size - 50 FROM org2),
    wcells AS (SELECT contig, strand, origin, start, start + unnest(range(0, 50)) AS at FROM st),
    wrows AS (SELECT w.contig, w.strand, w.start, w.at, w.origin + w.at AS pos, coalesce(rt, 0) AS rt, coalesce(bd, 0) AS bd FROM wcells w LEFT JOIN one c ON w.contig = c.contig AND w.strand = c.strand AND c.pos = w.origin + w.at),
    good AS (SELECT contig, strand, start FROM wrows GROUP BY ALL HAVING sum(CASE WHEN bd >= 2 THEN 1 ELSE 0 END) >= 10 AND sum(CASE WHEN bd >= 5 THEN 1 ELSE 0 END) > 25 AND avg(rt) >= 0.5),
    en AS (SELECT w.*, CASE WHEN bd > 0 THEN rt * CAST(1 AS DOUBLE) / bd END AS e FROM wrows w JOIN good USING (contig, strand, start)),
    sk AS (SELECT contig, strand, start, max(CASE WHEN r = 10 THEN e END) AS b FROM (SELECT *, row_number() OVER (PARTITION BY contig, strand, start ORDER BY e NULLS FIRST) - 1 AS r FROM en) GROUP BY ALL),
    sc AS (SELECT contig, strand, start, pos, e - coalesce(b, 0.0) AS score FROM en JOIN sk USING (contig, strand, start)),
    {_AVERAGED.format(key="contig, strand", scaled=_SCALED)}
    SELECT c.contig, c.strand, c.pos, c.rt, c.bd, floor((CASE WHEN n_windows >= 2 AND coalesce(good, 0) > floor(n_windows / 2.0) AND bd >= 5 THEN val.score END) * 1e6 + 0.3137) / 1e6 AS score, n_windows, CASE WHEN n_windows < 2 THEN 0 ELSE coalesce(good, 0) END AS valid_count
    FROM one c JOIN per USING (contig, strand, pos) LEFT JOIN val USING (contig, strand, pos) WHERE c.rt >= 1 OR c.bd >= 5""",
)(lambda spark, d: score.sliding_score(*_one_sample(spark, d), grid="fixed", control=False, enrich="div", sink=0.2, wsize=50, wstep=10, min_cov=5, out_min_cov=5, min_bd=5, min_rt=0.5, low_bd=2).withColumn("score", _off_halves("score")))


def _span_factor(c: str) -> str:
    return f"""g_{c} AS (SELECT id, start, CASE WHEN f = 0 THEN 1.0 ELSE f END AS {c}_f FROM (SELECT id, start, coalesce(median(CASE WHEN r >= 19 AND r < 39 THEN v END), 1.0) AS f
      FROM (SELECT id, start, CAST({c} AS DOUBLE) AS v, row_number() OVER (PARTITION BY id, start ORDER BY {c} DESC) - 1 AS r FROM wrows) GROUP BY ALL))"""


query(
    "sliding_junction_fixed",
    f"""WITH {a.COUNTS}, {a.JUNCTIONS.removeprefix(a.READS).lstrip(",")},
    js AS (SELECT row_number() OVER () AS id, contig, strand, first, second, CASE WHEN first > 195 THEN first - 194 ELSE 1 END AS lo FROM junctions WHERE second - first + 1 >= 195),
    st AS (SELECT *, unnest(range(0, second - lo - 193, 60)) AS start FROM js UNION SELECT *, second - lo - 194 FROM js),
    wcells AS (SELECT *, lo + start + unnest(range(0, 195)) AS pos FROM st),
    wrows AS (SELECT w.id, w.first, w.contig, w.strand, w.start, w.pos, coalesce(n_rt, 0) AS n_rt, coalesce(n_bd, 0) AS n_bd, coalesce(d_rt, 0) AS d_rt, coalesce(d_bd, 0) AS d_bd FROM wcells w LEFT JOIN counts c ON w.contig = c.contig AND w.strand = c.strand AND c.pos = w.pos),
    good AS (SELECT id, start FROM wrows GROUP BY ALL HAVING sum(CASE WHEN d_bd >= 2 THEN 1 ELSE 0 END) >= 39 AND sum(CASE WHEN d_bd >= 5 THEN 1 ELSE 0 END) > 97 AND avg(n_rt) >= 0.5),
    {", ".join(_span_factor(c) for c in ("n_rt", "n_bd", "d_rt", "d_bd"))},
    sc AS (SELECT w.id, w.start, w.pos, CASE WHEN d_bd > 0 THEN 10.0 * (n_rt / n_rt_f - 0.25 * (d_rt / d_rt_f)) / (d_bd / d_bd_f) END AS score FROM wrows w JOIN good USING (id, start) JOIN g_n_rt USING (id, start) JOIN g_n_bd USING (id, start) JOIN g_d_rt USING (id, start) JOIN g_d_bd USING (id, start)),
    {_AVERAGED.format(key="id", scaled=_SCALED)}
    SELECT c.contig, c.strand, c.pos, c.n_rt, c.n_bd, c.d_rt, c.d_bd, floor((CASE WHEN n_windows >= 2 AND coalesce(good, 0) > floor(n_windows / 2.0) AND d_bd >= 5 THEN val.score END) * 1e6 + 0.3137) / 1e6 AS score, n_windows, CASE WHEN n_windows < 2 THEN 0 ELSE coalesce(good, 0) END AS valid_count
    FROM js JOIN counts c ON c.contig = js.contig AND c.strand = js.strand AND c.pos BETWEEN js.first AND js.second JOIN per ON per.id = js.id AND per.pos = c.pos LEFT JOIN val ON val.id = js.id AND val.pos = c.pos WHERE c.n_rt >= 1 OR c.d_rt >= 1 OR c.d_bd >= 5""",
)(lambda spark, d: score.sliding_junction(_counts(spark, d), a.junctions(spark, d), grid="fixed", wsize=195, wstep=60, min_cov=5, out_min_cov=5, min_bd=5, min_rt=0.5, low_bd=2).withColumn("score", _off_halves("score")))
query("sliding_score_exact")(lambda spark, d: _sliding(spark, d, "exact"))


@query("output_filter_gtab", f"WITH {_ENRICHED} SELECT contig, strand, pos FROM enriched WHERE n_rt >= 1 OR d_rt >= 1 OR d_bd >= 50")
def _output_filter(spark, d):
    return score.output_filter_gtab(_counts(spark, d)).select("contig", "strand", "pos")


def _gtab(spark, d):
    return score.enrich_ctrl(_counts(spark, d)).select("contig", "strand", "pos", F.col("n_rt").alias("rt"), F.col("n_bd").alias("bd"), F.round("score", 6).alias("shape"))


_GTAB = _ENRICHED + ", gtab AS (SELECT contig, strand, pos, n_rt AS rt, n_bd AS bd, round(score, 6) AS shape FROM enriched)"


@query("gtab_valid_shape", f"WITH {_GTAB} SELECT contig, strand, pos, rt, bd, CASE WHEN bd >= 10 THEN shape END AS shape FROM gtab WHERE rt >= 1 OR (bd >= 10 AND shape IS NOT NULL)")
def _gtab_valid(spark, d):
    return score.gtab_valid_shape(_gtab(spark, d), 10)


@query("combine_gtab", f"WITH {_GTAB} SELECT contig, strand, pos, shape AS shape_1, round(shape + bd, 6) AS shape_2 FROM gtab WHERE shape IS NOT NULL AND bd >= 10")
def _combine_gtab(spark, d):
    g = _gtab(spark, d)
    return score.combine_gtab(g, g.where("bd >= 10").withColumn("shape", F.round(F.col("shape") + F.col("bd"), 6)))


# ---- alignments ------------------------------------------------------------------------------------------------------


@query(
    "cigar_global_regions",
    f"""WITH {a.SAM} SELECT read_id, line, first, second FROM (
    SELECT read_id, line, pos AS first, CASE line WHEN 5 THEN pos + 2 * q WHEN 6 THEN pos + 2 * q WHEN 7 THEN pos + 2 * q ELSE pos + q - 1 END AS second FROM cig
    UNION ALL SELECT read_id, line, CASE line WHEN 3 THEN pos + q + 100 ELSE pos + q END, CASE line WHEN 3 THEN pos + 2 * q + 99 ELSE pos + 2 * q - 1 END FROM cig WHERE line IN (3, 4))""",
)
def _cigar_global(spark, d):
    return a.sam(spark, d).select("read_id", "line", F.inline(cigar.cigar_global_regions("cigar", "pos")))


@query("cigar_max_softclip", f"WITH {a.SAM} SELECT read_id, line, CAST(CASE WHEN line = 2 THEN 5 WHEN line >= 5 THEN 3 ELSE 0 END AS BIGINT) AS clip, CASE WHEN line = 2 THEN 'RIGHT' WHEN line >= 5 THEN 'LEFT' ELSE 'TOTAL' END AS pattern FROM cig")
def _cigar_clip(spark, d):
    return a.sam(spark, d).select("read_id", "line", cigar.cigar_max_softclip("cigar").alias("clip"), cigar.cigar_match_pattern("cigar").alias("pattern"))


@query("cigar_reverse", f"WITH {a.SAM} SELECT read_id, line, CASE line WHEN 1 THEN q || 'M' WHEN 2 THEN q || 'M5S' WHEN 3 THEN q || 'M100N' || q || 'M' WHEN 4 THEN q || 'M2I' || q || 'M' ELSE '3S' || q || 'M1D' || q || 'M' END AS reversed FROM cig")
def _cigar_reverse(spark, d):
    return a.sam(spark, d).select("read_id", "line", cigar.cigar_reverse("cigar").alias("reversed"))


@query("md_mutations", f"WITH {a.SAM} SELECT read_id, line, unnest(CASE WHEN md LIKE '%G0' THEN [CAST(substr(md, 1, 1) AS INTEGER), CAST(substr(md, 1, 1) AS INTEGER) + 1 + CAST(q AS INTEGER)] ELSE [CAST(substr(md, 1, 1) AS INTEGER)] END) AS off FROM cig")
def _md(spark, d):
    return a.sam(spark, d).select("read_id", "line", F.explode(sequence.md_mutations(cigar.sam_tag("tags", "MD"))).alias("off"))


# ---- annotation and coordinates --------------------------------------------------------------------------------------


@query("exon_offsets", f"WITH {a.TRANSCRIPTS} SELECT transcript_id, exon, first, second, t_first, t_second FROM exons")
def _exon_offsets(spark, d):
    return annotation.exon_offsets(a.transcripts(spark, d)).select("transcript_id", "exon", "first", "second", "t_first", "t_second")


@query("gene_table", f"WITH {a.TRANSCRIPTS} SELECT gene_id, any_value(contig) AS contig, any_value(strand) AS strand, min(first) AS first, max(second) AS second, max(second) - min(first) + 1 AS length, CAST(count(DISTINCT transcript_id) AS BIGINT) AS n FROM ex GROUP BY gene_id")
def _gene_table(spark, d):
    return annotation.gene_table(a.transcripts(spark, d)).select("gene_id", "contig", "strand", "first", "second", "length", F.size("transcripts").cast("long").alias("n"))


@query(
    "introns",
    f"""WITH {a.TRANSCRIPTS}, g AS (SELECT transcript_id, contig, strand, row_number() OVER w AS intron, second + 1 AS first, lead(first) OVER w - 1 AS second FROM ex WINDOW w AS (PARTITION BY transcript_id ORDER BY first))
    SELECT transcript_id, contig, strand, CAST(intron AS INTEGER) AS intron, first, second FROM g WHERE second IS NOT NULL AND first <= second""",
)
def _introns(spark, d):
    return annotation.introns(a.transcripts(spark, d))


@query(
    "merged_exons",
    f"""WITH {a.TRANSCRIPTS}, m AS (SELECT gene_id, first, second, max(second) OVER (PARTITION BY gene_id ORDER BY first, second ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM (SELECT DISTINCT gene_id, first, second FROM ex)),
    i AS (SELECT *, sum(CASE WHEN before IS NULL OR first > before + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY gene_id ORDER BY first, second ROWS UNBOUNDED PRECEDING) AS island FROM m)
    SELECT gene_id, min(first) AS first, max(second) AS second FROM i GROUP BY gene_id, island""",
)
def _merged(spark, d):
    return annotation.merged_exons_introns(annotation.exon_offsets(a.transcripts(spark, d)))[0]


@query(
    "longest_transcripts",
    f"WITH {a.TRANSCRIPTS}, l AS (SELECT gene_id, transcript_id, CAST(sum(second - first + 1) AS BIGINT) AS length FROM ex GROUP BY ALL) SELECT gene_id, transcript_id, length, CAST(r AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY gene_id ORDER BY length DESC, transcript_id) AS r FROM l) WHERE r <= 3",
)
def _longest(spark, d):
    return annotation.longest_transcripts(a.transcripts(spark, d), k=3)


def _exons(spark, d):
    return annotation.exon_offsets(a.transcripts(spark, d))


def _read_blocks(spark, d):
    return a.reads(spark, d).select("read_id", "contig", "strand", F.inline("regions"))


_PIECE = """SELECT b.read_id, b.first, b.second, x.{id}, greatest(b.first, x.first) AS p_first, least(b.second, x.second) AS p_second, {start} AS {p}_first, {start} + least(b.second, x.second) - greatest(b.first, x.first) AS {p}_second
FROM blocks b JOIN {table} x ON b.contig = x.contig AND b.strand = x.strand AND b.first <= x.second AND x.first <= b.second"""


@query(
    "genome_to_transcript",
    f"WITH {a.READS}, {a.TRANSCRIPTS} " + _PIECE.format(id="transcript_id", p="t", table="exons", start="CASE WHEN b.strand = '+' THEN x.t_first + greatest(b.first, x.first) - x.first ELSE x.t_first + x.second - least(b.second, x.second) END"),
)
def _g2t(spark, d):
    return coords.genome_to_transcript(_read_blocks(spark, d), _exons(spark, d)).drop("contig", "strand")


_GENES = "genes AS (SELECT gene_id, contig, strand, min(first) AS first, max(second) AS second FROM ex GROUP BY ALL)"


@query(
    "genome_to_gene",
    f"WITH {a.READS}, {a.TRANSCRIPTS}, {_GENES} "
    + _PIECE.format(id="gene_id", p="g", table="genes", start="CASE WHEN b.strand = '+' THEN greatest(b.first, x.first) - x.first + 1 ELSE x.second - least(b.second, x.second) + 1 END"),
)
def _g2g(spark, d):
    return coords.genome_to_gene(_read_blocks(spark, d), annotation.gene_table(a.transcripts(spark, d))).drop("contig", "strand")


@query(
    "transcript_to_genome",
    f"WITH {a.TRANSCRIPTS}, p AS (SELECT transcript_id, unnest(range(1, n + 1)) AS t_pos FROM (SELECT transcript_id, max(t_second) AS n FROM exons GROUP BY transcript_id)) SELECT p.transcript_id, p.t_pos, contig, strand, CASE WHEN strand = '+' THEN first + p.t_pos - t_first ELSE second - (p.t_pos - t_first) END AS pos FROM p JOIN exons e ON p.transcript_id = e.transcript_id AND p.t_pos BETWEEN t_first AND t_second",
)
def _t2g(spark, d):
    exons = _exons(spark, d)
    points = exons.groupBy("transcript_id").agg(F.max("t_second").alias("n")).select("transcript_id", F.explode(F.expr("sequence(1L, n)")).alias("t_pos"))
    return coords.transcript_to_genome(points, exons)


@query(
    "conversion_summary",
    f"""WITH {a.READS}, {a.TRANSCRIPTS}, {_GENES}, pts AS (SELECT DISTINCT contig, strand, pos FROM base_bd),
    k AS (SELECT contig, strand, CASE WHEN EXISTS (SELECT 1 FROM exons e WHERE e.contig = p.contig AND e.strand = p.strand AND p.pos BETWEEN e.first AND e.second) THEN 'exon'
      WHEN EXISTS (SELECT 1 FROM genes g WHERE g.contig = p.contig AND g.strand = p.strand AND p.pos BETWEEN g.first AND g.second) THEN 'intron' ELSE 'intergenic' END AS kind FROM pts p),
    s AS (SELECT contig, strand, count(*) FILTER (kind = 'exon') AS exon, count(*) FILTER (kind = 'intron') AS intron, count(*) FILTER (kind = 'intergenic') AS intergenic FROM k GROUP BY ALL)
    SELECT contig, strand, CAST(exon AS BIGINT) AS exon, CAST(intron AS BIGINT) AS intron, CAST(intergenic AS BIGINT) AS intergenic FROM s
    UNION ALL SELECT NULL, NULL, CAST(sum(exon) AS BIGINT), CAST(sum(intron) AS BIGINT), CAST(sum(intergenic) AS BIGINT) FROM s""",
)
def _conversion(spark, d):
    t = a.transcripts(spark, d)
    return coords.conversion_summary(pileup.base_density(a.reads(spark, d)), annotation.gene_table(t), annotation.exon_offsets(t))


# ---- reads and quality control ---------------------------------------------------------------------------------------

@query("filter_records", f"WITH {a.SAM} SELECT read_id, line, flag FROM cig WHERE flag <> 4 AND flag <> 256 AND line <> 3")
def _filter_records(spark, d):
    return reads.filter_records(a.sam(spark, d), ("unmapped", "secondary", "gapped")).select("read_id", "line", "flag")


@query("sam_flags", f"WITH {a.SAM} SELECT read_id, line, flag <> 4 AS is_mapped, flag = 16 AS is_reverse, flag <> 256 AS is_primary, line = 3 AS is_gapped FROM cig")
def _sam_flags(spark, d):
    return reads.sam_flags(a.sam(spark, d)).select("read_id", "line", "is_mapped", "is_reverse", "is_primary", "is_gapped")


@query("drop_mut5", f"WITH {a.SAM} SELECT read_id, line FROM cig WHERE CASE WHEN flag <> 16 THEN md NOT LIKE '0%' ELSE md NOT LIKE '%G0' END")
def _drop_mut5(spark, d):
    return reads.drop_mut5(a.sam(spark, d)).select("read_id", "line")


@query("drop_unannotated_junctions", f"WITH {a.SAM} SELECT read_id, line FROM cig WHERE jm NOT BETWEEN 0 AND 6")
def _drop_unannotated(spark, d):
    return reads.drop_unannotated_junctions(a.sam(spark, d)).select("read_id", "line")


@query(
    "mapped_abundance",
    f"""WITH {a.SAM}, m AS (SELECT read_id, chr_id AS contig, count(*) OVER (PARTITION BY read_id) AS h FROM cig WHERE flag IN (0, 256))
    SELECT contig, round(sum(CASE WHEN h = 1 THEN 1.0 ELSE 0.0 END), 6) AS uniq, round(sum(CASE WHEN h > 1 THEN 1.0 / h ELSE 0.0 END), 6) AS multi FROM m GROUP BY contig""",
)
def _mapped(spark, d):
    return reads.mapped_abundance(a.sam(spark, d)).select("contig", F.round("uniq", 6).alias("uniq"), F.round("multi", 6).alias("multi"))


@query("collapse_reads", f"WITH {a.FASTQ} SELECT min(id) AS id, seq, CAST(count(*) AS BIGINT) AS n FROM fq GROUP BY seq")
def _collapse(spark, d):
    unique, freq = reads.collapse_reads(a.fastq(spark, d))
    return unique.select("id", "seq").join(freq, "seq")


@query("collapse_pairs", f"WITH {a.FASTQ} SELECT min(id) AS id, substr(seq, 1, 30) AS seq_1, substr(seq, 31, 30) AS seq_2 FROM fq GROUP BY 2, 3")
def _collapse_pairs(spark, d):
    f = a.fastq(spark, d)
    part = lambda p: f.withColumn("seq", F.substring("seq", p, 30)).withColumn("qual", F.substring("qual", p, 30))
    one, two = reads.collapse_pairs(part(1), part(31))
    return one.select("id", F.col("seq").alias("seq_1")).join(two.select("id", F.col("seq").alias("seq_2")), "id")


@query(
    "barcode_counts",
    f"""WITH {a.FASTQ}, b AS (SELECT substr(seq, 5, 3) AS barcode FROM fq) SELECT barcode, CASE barcode WHEN 'ACG' THEN 'lib1' WHEN 'GTA' THEN 'lib2' WHEN 'CGT' THEN 'lib3' ELSE 'unmatched' END AS library,
    CAST(count(*) AS BIGINT) AS n, round(count(*) / CAST((SELECT count(*) FROM b) AS DOUBLE), 6) AS share FROM b GROUP BY barcode""",
)
def _barcodes(spark, d):
    lib = sequence.barcode_lib(spark, "ACG:lib1::GTA:lib2::CGT:lib3")
    return reads.barcode_counts(a.fastq(spark, d), 5, 3, lib).withColumn("share", F.round("share", 6))


@query("simplify_read_name", f"WITH {a.FASTQ} SELECT id, '@read' || CAST(id AS VARCHAR) AS key, '+' AS tag FROM fq")
def _simplify(spark, d):
    return reads.simplify_read_name(a.fastq(spark, d)).select("id", "key", "tag")


@query("fasta_lengths", f"WITH {a.FASTQ} SELECT CAST(id AS VARCHAR) AS id, length(seq) AS length FROM fq WHERE length(seq) <= 40")
def _fasta_lengths(spark, d):
    return reads.fasta_lengths(reads.small_rna_filter(a.fastq(spark, d).select(F.col("id").cast("string").alias("id"), "seq"), 40))


@query("reverse_complement", f"WITH {a.FASTQ} SELECT id, reverse(translate(seq, 'ACGT', 'TGCA')) AS rc FROM fq")
def _rc(spark, d):
    return a.fastq(spark, d).select("id", sequence.reverse_complement("seq").alias("rc"))


@query("motif_sites", f"WITH {a.FASTQ}, p AS (SELECT id, seq, CAST(unnest(range(1, length(seq) - 2)) AS INTEGER) AS site FROM fq WHERE length(seq) >= 4) SELECT id, site FROM p WHERE substr(seq, site, 4) = 'ACGT'")
def _motif(spark, d):
    return a.fastq(spark, d).select("id", F.explode(sequence.motif_sites("seq", "ACGT")).alias("site"))


@query("read_distribution", f"""WITH {a.READS}, c AS (SELECT contig AS sample, count(*) AS raw, count(*) FILTER (split) AS two, count(*) FILTER (split AND condition = 'D') AS ctl FROM reads GROUP BY contig)
    SELECT sample, step, CAST(n AS BIGINT) AS n, CAST(loss AS BIGINT) AS loss, round(n / CAST(raw AS DOUBLE), 6) AS share FROM (SELECT sample, raw, 'raw' AS step, raw AS n, NULL AS loss FROM c UNION ALL SELECT sample, raw, 'split', two, raw - two FROM c UNION ALL SELECT sample, raw, 'control', ctl, two - ctl FROM c)""")
def _distribution(spark, d):
    r = a.reads(spark, d).withColumn("split", F.size("regions") > 1)
    counts = r.groupBy(F.col("contig").alias("sample")).agg(F.count("*").alias("raw"), F.count_if("split").alias("split"), F.count_if(F.col("split") & (F.col("condition") == "D")).alias("control"))
    long = counts.unpivot("sample", ["raw", "split", "control"], "step", "n")
    return reads.read_distribution(long, ["raw", "split", "control"]).select("sample", "step", "n", "loss", F.round("share", 6).alias("share"))


@query("quality_trim")
def _quality_trim(spark, d):
    return reads.quality_trim(a.fastq(spark, d)).select("id", "seq", "qual")


@query(
    "mutation_profile",
    f"""WITH {a.SAM}, {a.READ_SAM}, m AS (SELECT flag, length(seq) AS len, CAST(substr(md, 1, 1) AS INTEGER) AS p FROM rs WHERE flag <> 4 UNION ALL SELECT flag, length(seq), CAST(substr(md, 1, 1) AS INTEGER) + 1 + CAST(q AS INTEGER) FROM rs WHERE flag <> 4 AND md LIKE '%G0'),
    e AS (SELECT len, CASE WHEN flag = 16 THEN len - 1 - p ELSE p END AS place FROM m), s AS (SELECT 5 AS side, place AS off FROM e UNION ALL SELECT 3, len - 1 - place FROM e)
    SELECT CAST(side AS INTEGER) AS side, CAST(off AS INTEGER) AS off, CAST(count(*) AS BIGINT) AS mutations, round(count(*) / CAST((SELECT count(*) FROM rs WHERE flag <> 4) AS DOUBLE), 9) AS rate FROM s WHERE off BETWEEN 0 AND 14 GROUP BY ALL""",
)
def _mutations(spark, d):
    return reads.mutation_profile(a.read_sam(spark, d)).select("side", F.col("offset").cast("int").alias("off"), "mutations", F.round("rate", 9).alias("rate"))


@query(
    "sam_read_classes",
    f"""WITH {a.SAM}, {a.TRANSCRIPTS}, {_GENES}, m AS (SELECT row_number() OVER () AS row, chr_id AS contig, CASE WHEN flag = 16 THEN '-' ELSE '+' END AS strand, pos AS first, pos - 1 + CASE line WHEN 1 THEN q WHEN 2 THEN q WHEN 3 THEN 2 * q + 100 WHEN 4 THEN 2 * q ELSE 2 * q + 1 END AS second FROM cig WHERE flag <> 4),
    h AS (SELECT DISTINCT m.row, e.transcript_id, e.type FROM m JOIN exons e ON m.contig = e.contig AND m.strand = e.strand AND m.first <= e.second AND e.first <= m.second),
    w AS (SELECT type, CAST(1 AS DOUBLE) / count(*) OVER (PARTITION BY row) AS w FROM h),
    rest AS (SELECT m.*, EXISTS (SELECT 1 FROM genes g WHERE g.contig = m.contig AND g.strand = m.strand AND m.first <= g.second AND g.first <= m.second) AS g, EXISTS (SELECT 1 FROM genes g WHERE g.contig = m.contig) AS k FROM m ANTI JOIN h USING (row))
    SELECT 'exon' AS class, type, round(sum(w), 6) AS reads FROM w GROUP BY type UNION ALL SELECT CASE WHEN g THEN 'intron' WHEN k THEN 'intergenic' ELSE 'un-annotated' END, NULL, CAST(count(*) AS DOUBLE) FROM rest GROUP BY 1
    UNION ALL SELECT 'un-mapped', NULL, CAST(count(*) AS DOUBLE) FROM cig WHERE flag = 4 HAVING count(*) > 0""",
)
def _classes(spark, d):
    t = a.transcripts(spark, d)
    return reads.sam_read_classes(a.sam(spark, d), annotation.gene_table(t), annotation.exon_offsets(t)).withColumn("reads", F.round("reads", 6))


@query("base_composition", f"""WITH {a.COUNTS}, b AS (SELECT condition AS sample, substr('ACGT', CAST(pos % 4 AS INTEGER) + 1, 1) AS base, CAST(sum(rt) AS BIGINT) AS rt FROM base_rt GROUP BY ALL)
    SELECT sample, base, rt, round(rt / CAST(sum(rt) OVER (PARTITION BY sample) + 1 AS DOUBLE), 6) AS ratio FROM b""")
def _composition(spark, d):
    rt = pileup.rt_stops(a.reads(spark, d).withColumnRenamed("condition", "sample"), by=("sample",)).withColumn("base", F.substring(F.lit("ACGT"), (F.col("pos") % 4 + 1).cast("int"), F.lit(1)))
    return qc.base_composition(rt).withColumn("ratio", F.round("ratio", 6))


def _shapes(spark, d):
    """Score rows by part: 60 values from the size and the key, a few null."""
    rows = a.table(spark, d, "part")
    value = lambda i: F.when((i + F.col("p_partkey")) % 9 != 0, ((i * 37 + F.col("p_partkey") * 11 + F.col("p_size")) % 101) / 100)
    return rows.select(F.concat(F.lit("t"), F.col("p_partkey").cast("string")).alias("transcript_id"), F.lit(70).cast("long").alias("length"), F.transform(F.sequence(F.lit(1), F.lit(70)), value).alias("scores"))


_SHAPES = """sv AS (SELECT 't' || CAST(p_partkey AS VARCHAR) AS transcript_id, i, CASE WHEN (i + p_partkey) % 9 <> 0 THEN ((i * 37 + p_partkey * 11 + p_size) % 101) / CAST(100 AS DOUBLE) END AS x FROM (SELECT *, unnest(range(1, 71)) AS i FROM part)),
val AS (SELECT *, row_number() OVER (PARTITION BY transcript_id ORDER BY i) - 1 AS rn, count(*) OVER (PARTITION BY transcript_id) AS n FROM sv WHERE x IS NOT NULL)"""


@query(
    "gini",
    f"""WITH {_SHAPES}, t AS (SELECT transcript_id, floor(rn / 30) AS tile, x, row_number() OVER (PARTITION BY transcript_id, floor(rn / 30) ORDER BY x) AS k FROM val WHERE floor(rn / 30) * 30 + 30 < n),
    g AS (SELECT transcript_id, tile, CASE WHEN sum(x) <> 0 THEN (sum(x) * 30 / 2 - sum(x * (30 - k + 1) - x / 2)) / (sum(x) * 30 / 2) END AS g FROM t GROUP BY ALL)
    SELECT transcript_id, round(avg(g), 3) AS gini FROM g GROUP BY 1 HAVING avg(g) IS NOT NULL""",
)
def _gini(spark, d):
    return qc.gini(_shapes(spark, d))


@query("coverage_ratio", f"WITH {_SHAPES}, r AS (SELECT transcript_id, count(x) / CAST(70 AS DOUBLE) AS ratio FROM sv GROUP BY 1) SELECT transcript_id, round(ratio, 6) AS ratio, round((row_number() OVER (ORDER BY ratio, transcript_id) - 1) / CAST((SELECT count(*) - 1 FROM r) AS DOUBLE), 6) AS p FROM r")
def _coverage(spark, d):
    return qc.coverage_ratio(_shapes(spark, d)).select("transcript_id", F.round("ratio", 6).alias("ratio"), F.round("p", 6).alias("p"))


@query(
    "roc_auc",
    f"""WITH {_SHAPES}, q AS (SELECT x, (i * 7 + length(transcript_id)) % 3 = 0 AS paired, least(greatest(ceil(round(x / 0.01, 9)), -1), 102) AS c FROM sv WHERE x IS NOT NULL),
    h AS (SELECT c, count(*) FILTER (paired) AS t, count(*) FILTER (NOT paired) AS f FROM q GROUP BY c),
    s AS (SELECT c, sum(t) OVER (ORDER BY c) / CAST(sum(t) OVER () AS DOUBLE) AS tpr, sum(f) OVER (ORDER BY c) / CAST(sum(f) OVER () AS DOUBLE) AS fpr FROM h),
    z AS (SELECT (fpr - coalesce(lag(fpr) OVER (ORDER BY c), 0)) * (tpr + coalesce(lag(tpr) OVER (ORDER BY c), 0)) / 2 AS a FROM s)
    SELECT round(sum(a), 6) AS auc, (SELECT count(*) FROM q WHERE paired) AS positives, (SELECT count(*) FROM q WHERE NOT paired) AS negatives FROM z""",
)
def _roc(spark, d):
    rows = _shapes(spark, d).select("transcript_id", F.posexplode("scores").alias("i", "score")).select("score", (((F.col("i") + 1) * 7 + F.length("transcript_id")) % 3 == 0).alias("paired"))
    return qc.roc_auc(rows).withColumn("auc", F.round("auc", 6))


@query("shape_text_bedgraph", f"WITH {_SHAPES} SELECT transcript_id AS contig, i AS pos, round(x, 6) AS value FROM sv WHERE x IS NOT NULL")
def _text_bedgraph(spark, d):
    return tracks.shape_text_bedgraph(_shapes(spark, d)).withColumn("value", F.round("value", 6))


@query("filter_trans_shape", f"WITH {_SHAPES} SELECT transcript_id, CAST(count(CASE WHEN i > 5 AND i <= 40 THEN x END) AS BIGINT) AS n FROM sv GROUP BY 1 HAVING count(x) >= 62")
def _filter_trans(spark, d):
    kept = tracks.filter_trans_shape(_shapes(spark, d).withColumn("rt", F.lit(3.0)), min_num=62)
    return kept.select("transcript_id", F.size(F.filter("scores", lambda x: x.isNotNull())).cast("long").alias("n"))


@query("annotate_gene_type", f"WITH {a.TRANSCRIPTS} SELECT transcript_id, gene_id, type FROM tx")
def _annotate(spark, d):
    return tracks.annotate_gene_type(_shapes(spark, d), a.transcripts(spark, d)).select("transcript_id", "gene_id", "type")


@query("genetype_counts", f"WITH {_SHAPES}, {a.TRANSCRIPTS} SELECT type, CAST(count(DISTINCT transcript_id) AS BIGINT) AS transcripts, CAST(count(x) AS BIGINT) AS bases FROM sv JOIN tx USING (transcript_id) GROUP BY type")
def _genetypes(spark, d):
    return qc.genetype_counts(_shapes(spark, d), a.transcripts(spark, d))


@query("shape_bedgraph", f"""WITH {_GTAB}, c AS (SELECT g.contig, g.strand, g.pos, g.shape, n_rt, d_rt, d_bd FROM gtab g JOIN counts USING (contig, strand, pos))
    SELECT 'score' AS track, contig, strand, pos, shape AS value FROM c WHERE shape IS NOT NULL UNION ALL SELECT 'N_RT', contig, strand, pos, n_rt FROM c WHERE n_rt > 0
    UNION ALL SELECT 'D_RT', contig, strand, pos, d_rt FROM c WHERE d_rt > 0 UNION ALL SELECT 'BD', contig, strand, pos, d_bd FROM c WHERE d_bd > 20""")
def _bedgraph(spark, d):
    return tracks.shape_bedgraph(score.enrich_ctrl(_counts(spark, d)).withColumn("shape", F.round("score", 6)))


@query(
    "rt_replicate_corr",
    f"""WITH {a.COUNTS}, b AS (SELECT contig, strand, pos, n_rt, d_rt, floor((row_number() OVER (ORDER BY contig, strand, pos) - 1) / 100) AS win FROM counts JOIN sizes USING (contig) WHERE pos <= length AND n_bd >= 3 AND d_bd >= 3),
    v AS (SELECT win, covar_pop(d_rt, n_rt) / nullif(stddev_pop(d_rt) * stddev_pop(n_rt), 0) AS r FROM b GROUP BY win HAVING count(*) = 100)
    SELECT 'D' AS sample_1, 'N' AS sample_2, CAST(count(*) AS BIGINT) AS n, round(avg(r), 6) AS r FROM v WHERE abs(r) > {qc.least_correlation(100)!r}""",
)
def _rt_corr(spark, d):
    r = a.reads(spark, d)
    return qc.rt_replicate_corr(pileup.count_rt(r.withColumnRenamed("condition", "sample"), a.sizes(r)), min_bd=3).withColumn("r", F.round("r", 6))


# ---- duplex ----------------------------------------------------------------------------------------------------------


@query("dedup_hangs", f"WITH {a.HANGS} SELECT min(read_id) AS read_id, chr_1, strand_1, start_1, end_1, chr_2, strand_2, start_2, end_2 FROM hangs GROUP BY ALL")
def _dedup_hangs(spark, d):
    return duplex.dedup_hangs(a.hangs(spark, d))


_MATRIX = a.HANGS + """,
m1 AS (SELECT chr_1 AS contig, strand_1 AS strand, start_2, end_2, unnest(range(start_1, end_1 + 1)) AS x FROM hangs WHERE chr_1 = chr_2 AND strand_1 = strand_2),
m2 AS (SELECT contig, strand, x, unnest(range(start_2, end_2 + 1)) AS y FROM m1),
coo AS (SELECT contig, strand, x, y, CAST(count(*) AS DOUBLE) AS value FROM (SELECT contig, strand, x, y FROM m2 UNION ALL SELECT contig, strand, y, x FROM m2) GROUP BY ALL)"""


def _coo(spark, d):
    return matrix.contact_matrix(a.hangs(spark, d))


def _packed(spark, d):
    """The cells in squares, saved: read more than once."""
    return scan.save(matrix.contact_blocks(a.hangs(spark, d)), "matrix")


@query("contact_matrix", f"WITH {_MATRIX} SELECT * FROM coo")
def _contact(spark, d):
    return _coo(spark, d)


_COMPRESSED = f"""{_MATRIX}, s AS (SELECT contig, CAST(max(x) AS DOUBLE) AS n FROM coo GROUP BY contig),
    b AS (SELECT contig, strand, CAST(floor((x - 1) * 40 / n) AS BIGINT) + 1 AS x, CAST(floor((y - 1) * 40 / n) AS BIGINT) + 1 AS y, value FROM coo JOIN s USING (contig))"""


@query("matrix_compress", f"WITH {_COMPRESSED} SELECT contig, strand, x, y, sum(value) AS value FROM b GROUP BY ALL")
def _compress(spark, d):
    coo = matrix.cells(_packed(spark, d))
    return matrix.matrix_compress(coo, _lengths(coo), 40, "sum")


def _lengths(coo):
    if "at" in coo.columns:  # packed
        coo = coo.select("contig", (F.col("bx") * matrix.SIDE + F.floor(F.array_max("at") / matrix.SIDE) + 1).alias("x"))
    return coo.groupBy("contig").agg(F.max("x").alias("length"))


@query(
    "background_estimate",
    f"""WITH {_MATRIX}, l AS (SELECT contig, max(x) AS n FROM coo GROUP BY contig), o AS (SELECT contig, strand, x, sum(value) AS s FROM coo GROUP BY ALL),
    r AS (SELECT contig, strand, x, greatest(s / n, 1.0) AS av, greatest(sum(s) OVER (PARTITION BY contig, strand ORDER BY x RANGE BETWEEN 5 PRECEDING AND 5 FOLLOWING) / greatest(s, 1.0), 1.0) AS bg FROM o JOIN l USING (contig))
    SELECT c.contig, c.strand, c.x, c.y, round(value / (sqrt(p.bg * q.bg) * sqrt(p.av * q.av)), 6) AS value FROM coo c JOIN r p ON c.contig = p.contig AND c.strand = p.strand AND c.x = p.x JOIN r q ON c.contig = q.contig AND c.strand = q.strand AND c.y = q.x""",
)
def _background(spark, d):
    coo = _packed(spark, d)
    return matrix.background_estimate(coo, _lengths(matrix.cells(coo))).withColumn("value", F.round("value", 6))


@query("cluster_hangs")
def _cluster(spark, d):
    return duplex.min_support(duplex.cluster_hangs(a.hangs(spark, d))[0], 1)


@query("collapse_groups")
def _collapse_groups(spark, d):
    return duplex.collapse_groups(*duplex.cluster_hangs(a.hangs(spark, d)))[0]


@query("group_score")
def _group_score(spark, d):
    h = scan.save(a.hangs(spark, d), "hangs")
    return duplex.group_score(duplex.cluster_hangs(h)[0], h)


@query(
    "sam_to_dh",
    f"""WITH {a.SAM} SELECT read_id, chr_id AS chr_1, CASE WHEN flag = 16 THEN '-' ELSE '+' END AS strand_1, CAST(flag AS INTEGER) AS flag_1, cigar AS cigar_1, pos AS start_1, pos + q - 1 AS end_1,
    chr_id AS chr_2, CASE WHEN flag = 16 THEN '-' ELSE '+' END AS strand_2, CAST(flag AS INTEGER) AS flag_2, cigar AS cigar_2, pos + q + 100 AS start_2, pos + 2 * q + 99 AS end_2 FROM cig WHERE flag <> 4 AND line = 3 AND q >= 10""",
)
def _sam_to_dh(spark, d):
    return duplex.sam_to_dh(a.sam(spark, d), mode="single")


@query("call_interactions")
def _interactions(spark, d):
    coo = _packed(spark, d)
    return matrix.call_interactions(coo, scan.save(_lengths(coo), "lengths"), perceive=2.0, extend=1.0)


# ---- more of coordinates, transcripts and matrices -------------------------------------------------------------------


@query("exons_in_gene", f"""WITH {a.TRANSCRIPTS}, {_GENES} SELECT e.gene_id, e.transcript_id, e.exon, CASE WHEN e.strand = '+' THEN e.first - g.first + 1 ELSE g.second - e.second + 1 END AS g_first,
    CASE WHEN e.strand = '+' THEN e.second - g.first + 1 ELSE g.second - e.first + 1 END AS g_second FROM exons e JOIN genes g ON e.gene_id = g.gene_id""")
def _exons_in_gene(spark, d):
    t = a.transcripts(spark, d)
    return annotation.exons_in_gene(t, annotation.gene_table(t))


@query("gene_to_genome", f"""WITH {a.TRANSCRIPTS}, {_GENES}, p AS (SELECT gene_id, unnest(range(1, second - first + 2)) AS g_pos FROM genes)
    SELECT p.gene_id, p.g_pos, contig, strand, CASE WHEN strand = '+' THEN first + g_pos - 1 ELSE second - g_pos + 1 END AS pos FROM p JOIN genes g ON p.gene_id = g.gene_id AND g_pos <= second - first + 1""")
def _gene_to_genome(spark, d):
    genes = scan.save(annotation.gene_table(a.transcripts(spark, d)).select("gene_id", "contig", "strand", "first", "second"), "genes")
    # a gene may be as long as a contig, so its places are dealt over the tasks in stretches
    return coords.gene_to_genome(coords.gene_stretches(genes), genes)


@query("transcript_to_gene", f"""WITH {a.TRANSCRIPTS}, {_GENES}, h AS (SELECT e.transcript_id, e.gene_id, e.strand, first AS p_first, second - first AS w FROM exons e)
    SELECT transcript_id, h.gene_id, CASE WHEN h.strand = '+' THEN p_first - g.first + 1 ELSE g.second - (p_first + w) + 1 END AS g_first, CASE WHEN h.strand = '+' THEN p_first - g.first + 1 ELSE g.second - (p_first + w) + 1 END + w AS g_second FROM h JOIN genes g ON h.gene_id = g.gene_id""")
def _transcript_to_gene(spark, d):
    t = a.transcripts(spark, d)
    total = F.aggregate("exons", F.lit(0).cast("long"), lambda s, x: s + x["second"] - x["first"] + 1)
    spans = t.select("transcript_id", F.lit(1).cast("long").alias("t_from"), total.alias("t_to"))
    return coords.transcript_to_gene(spans, annotation.exon_offsets(t), annotation.gene_table(t)).select("transcript_id", "gene_id", "g_first", "g_second")


@query("merged_introns", ORACLES["merged_exons"].rsplit("SELECT gene_id, min(first)", 1)[0] + """, mm AS (SELECT gene_id, min(first) AS first, max(second) AS second FROM i GROUP BY gene_id, island),
    n AS (SELECT gene_id, second + 1 AS first, lead(first) OVER (PARTITION BY gene_id ORDER BY first) - 1 AS second FROM mm) SELECT * FROM n WHERE second IS NOT NULL""")
def _merged_introns(spark, d):
    return annotation.merged_exons_introns(annotation.exon_offsets(a.transcripts(spark, d)))[1]


@query("shape_to_transcript", f"""WITH {_GTAB}, {a.TRANSCRIPTS}, p AS (SELECT contig, strand, pos, rt, CASE WHEN bd >= 10 THEN shape END AS shape FROM gtab WHERE rt >= 1 OR (bd >= 10 AND shape IS NOT NULL)),
    h AS (SELECT e.transcript_id, CASE WHEN e.strand = '+' THEN t_first + pos - first ELSE t_first + second - pos END AS t, rt, shape FROM p JOIN exons e ON p.contig = e.contig AND p.strand = e.strand AND pos BETWEEN first AND second),
    l AS (SELECT transcript_id, max(t_second) AS length FROM exons GROUP BY 1 HAVING max(t_second) >= 40)
    SELECT h.transcript_id, max(length) AS length, CAST(count(shape) AS BIGINT) AS n, floor(sum(shape) * 1e4 + 0.3137) / 1e4 AS total, round(sum(rt) / CAST(max(length) AS DOUBLE), 6) AS rt FROM h JOIN l ON h.transcript_id = l.transcript_id GROUP BY 1 HAVING count(shape) >= 3""")
def _shape_to_transcript(spark, d):
    rows = coords.shape_to_transcript(_gtab(spark, d), _exons(spark, d), min_bd=10)
    good = F.filter("scores", lambda x: x.isNotNull())
    return rows.select("transcript_id", "length", F.size(good).cast("long").alias("n"), (F.floor(F.aggregate(good, F.lit(0.0), lambda s, x: s + x) * 1e4 + 0.3137) / 1e4).alias("total"), F.round("rt", 6).alias("rt"))


@query("rtbd_to_transcript", f"""WITH {a.COUNTS}, {a.TRANSCRIPTS}, h AS (SELECT e.transcript_id, n_rt, n_bd FROM counts p JOIN sizes USING (contig) JOIN exons e ON p.contig = e.contig AND p.strand = e.strand AND pos BETWEEN first AND second WHERE pos <= length),
    l AS (SELECT transcript_id, max(t_second) AS length FROM exons GROUP BY 1 HAVING max(t_second) >= 40)
    SELECT h.transcript_id, max(length) AS length, CAST(sum(n_rt) AS BIGINT) AS rt, CAST(sum(n_bd) AS BIGINT) AS bd FROM h JOIN l ON h.transcript_id = l.transcript_id GROUP BY 1 HAVING count(*) >= 10""")
def _rtbd(spark, d):
    rows = coords.rtbd_to_transcript(_counts(spark, d), ["n_rt", "n_bd"], _exons(spark, d))
    total = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda s, x: s + F.coalesce(x, F.lit(0)))
    return rows.select("transcript_id", "length", total("n_rt").alias("rt"), total("n_bd").alias("bd"))


@query("codon_profile", f"""WITH {_SHAPES}, o AS (SELECT x, unnest([i - 21, i - 50]) AS off, unnest(['start', 'stop']) AS codon FROM sv WHERE x IS NOT NULL)
    SELECT codon, CAST(off AS BIGINT) AS off, CAST(count(*) AS BIGINT) AS n, round(avg(x), 6) AS score FROM o WHERE abs(off) <= 25 GROUP BY ALL HAVING count(*) > 100""")
def _codon_profile(spark, d):
    shapes = _shapes(spark, d)
    t = shapes.select("transcript_id", F.lit(21).cast("long").alias("cds_start"), F.lit(50).cast("long").alias("cds_end"))
    return qc.codon_profile(shapes, t).select("codon", F.col("offset").cast("long").alias("off"), "n", F.round("score", 6).alias("score"))


@query("base_shape_dist", f"""WITH {_ENRICHED}, b AS (SELECT substr('ACGT', CAST(pos % 4 AS INTEGER) + 1, 1) AS base, n_rt, d_rt, score FROM enriched),
    q AS (SELECT base, CAST(sum(n_rt) AS BIGINT) AS n_rt, CAST(sum(d_rt) AS BIGINT) AS d_rt, quantile_cont(score, 0.25) AS q1, quantile_cont(score, 0.5) AS q2, quantile_cont(score, 0.75) AS q3, min(score) AS lo, max(score) AS hi FROM b GROUP BY base)
    SELECT base, n_rt, d_rt, round(q1, 6) AS q1, round(q2, 6) AS median, round(q3, 6) AS q3, round(greatest(lo, q1 - 1.5 * (q3 - q1)), 6) AS low_adjacent, round(least(hi, q3 + 1.5 * (q3 - q1)), 6) AS high_adjacent FROM q""")
def _base_shape(spark, d):
    rows = score.enrich_ctrl(_counts(spark, d)).withColumn("shape", F.col("score")).withColumn("base", F.substring(F.lit("ACGT"), (F.col("pos") % 4 + 1).cast("int"), F.lit(1)))
    return qc.base_shape_dist(rows).select("base", "n_rt", "d_rt", *[F.round(c, 6).alias(c) for c in ("q1", "median", "q3", "low_adjacent", "high_adjacent")])


@query("rpkm", f"""WITH {a.SAM}, m AS (SELECT chr_id AS contig, count(*) OVER (PARTITION BY read_id) AS h FROM cig WHERE flag IN (0, 256)), t AS (SELECT contig, sum(1.0 / h) AS n FROM m GROUP BY contig)
    SELECT contig, CAST(70000 AS BIGINT) AS length, round(n * 1e9 / (70000 * (SELECT sum(n) FROM t)), 4) AS rpkm FROM t""")
def _rpkm(spark, d):
    s = a.sam(spark, d)
    header = s.select(F.col("chr_id").alias("contig")).distinct().withColumn("length", F.lit(70000).cast("long"))
    return reads.rpkm(s, header).select("contig", "length", F.round("rpkm", 4).alias("rpkm"))


@query("structure_compare", f"""WITH {a.HANGS}, t AS (SELECT DISTINCT chr_1 AS id, start_1 AS l, start_2 AS r FROM hangs WHERE strand_1 = '+'), k AS (SELECT DISTINCT chr_1 AS id, start_1 AS l, start_2 AS r FROM hangs WHERE strand_2 = '+'),
    nt AS (SELECT id, count(*) AS n FROM t GROUP BY 1), nk AS (SELECT id, count(*) AS n FROM k GROUP BY 1), c AS (SELECT id, count(*) AS n FROM t JOIN k USING (id, l, r) GROUP BY 1)
    SELECT nt.id, CAST(coalesce(c.n, 0) AS BIGINT) AS common, round(coalesce(c.n, 0) / CAST(nk.n AS DOUBLE), 6) AS sensitivity, round(coalesce(c.n, 0) / CAST(nt.n AS DOUBLE), 6) AS ppv FROM nt JOIN nk ON nt.id = nk.id LEFT JOIN c ON nt.id = c.id""")
def _structure_compare(spark, d):
    h = a.hangs(spark, d)
    pick = lambda s: h.where(f"{s} = '+'").select(F.col("chr_1").alias("id"), F.col("start_1").alias("left"), F.col("start_2").alias("right"))
    return qc.structure_compare(pick("strand_1"), pick("strand_2")).select("id", "common", F.round("sensitivity", 6).alias("sensitivity"), F.round("ppv", 6).alias("ppv"))


@query("matrix_submatrix", f"WITH {_MATRIX} SELECT contig, strand, x - 199 AS x, y - 299 AS y, value FROM coo WHERE x BETWEEN 200 AND 500 AND y BETWEEN 300 AND 700")
def _submatrix(spark, d):
    return matrix.matrix_submatrix(_coo(spark, d), 200, 500, 300, 700)


@query("background_quantile", f"""WITH {_MATRIX}, l AS (SELECT contig, max(x) AS n FROM coo GROUP BY contig),
    r AS (SELECT *, row_number() OVER (PARTITION BY contig, strand, x ORDER BY value DESC) AS r FROM coo JOIN l USING (contig)),
    q AS (SELECT contig, strand, x, coalesce(max(CASE WHEN r = n - floor(CAST(0.99 AS DOUBLE) * n) THEN value END), 0.0) AS q FROM r GROUP BY ALL)
    SELECT c.contig, c.strand, c.x, c.y, c.value - p.q - s.q AS value FROM coo c JOIN q p ON c.contig = p.contig AND c.strand = p.strand AND c.x = p.x JOIN q s ON c.contig = s.contig AND c.strand = s.strand AND c.y = s.x WHERE c.value - p.q - s.q > 0""")
def _background_quantile(spark, d):
    coo = _packed(spark, d)
    return matrix.background_quantile(coo, _lengths(matrix.cells(coo)), 0.99)


@query("matrix_quantiles", f"""WITH {_MATRIX}, r AS (SELECT value, row_number() OVER (ORDER BY value) - 1 AS place FROM coo WHERE value > 0), n AS (SELECT count(*) AS n FROM r)
    SELECT CAST(k AS INTEGER) AS quantile, value FROM range(0, 21) t(k), n, r WHERE place = CASE WHEN k = 20 THEN n - 1 ELSE CAST(floor(k / CAST(20 AS DOUBLE) * n) AS BIGINT) END""")
def _matrix_quantiles(spark, d):
    return matrix.matrix_quantiles(matrix.cells(_packed(spark, d)))


@query("region_algebra", f"""WITH {a.HANGS}, o AS (SELECT *, least(end_1, end_2) - greatest(start_1, start_2) + 1 AS overlap FROM hangs)
    SELECT read_id, overlap, least(start_1, start_2) AS first,
      CASE WHEN overlap >= 1 THEN greatest(end_1, end_2) ELSE least(end_1, end_2) END AS second, CASE WHEN overlap < 1 THEN greatest(start_1, start_2) END AS more_first, CASE WHEN overlap < 1 THEN greatest(end_1, end_2) END AS more_second,
      overlap >= 1 AND (start_1 < start_2 OR end_1 > end_2) AS rest FROM o""")
def _regions(spark, d):
    from ..functions.intervals import region, region_minus, region_overlap, region_union

    one, two = region(F.col("start_1"), F.col("end_1")), region(F.col("start_2"), F.col("end_2"))
    rows = a.hangs(spark, d).select("read_id", region_overlap(one, two).alias("overlap"), F.array_sort(region_union(one, two)).alias("u"), F.size(region_minus(one, two)).alias("m"))
    part = lambda k, c: F.get("u", F.lit(k))[c]
    return rows.select("read_id", "overlap", part(0, "first").alias("first"), part(0, "second").alias("second"), part(1, "first").alias("more_first"), part(1, "second").alias("more_second"), (F.col("m") > 0).alias("rest"))


@query("translate_codons", f"""WITH {a.FASTQ}, c AS (SELECT id, k, substr(seq, k * 3 + 1, 1) AS x, substr(seq, k * 3 + 2, 1) AS y, substr(seq, k * 3 + 3, 1) AS z FROM (SELECT *, unnest(range(0, length(seq) // 3)) AS k FROM fq)),
    p AS (SELECT id, string_agg(substr('{sequence._AMINO}', 16 * (strpos('TCAG', x) - 1) + 4 * (strpos('TCAG', y) - 1) + strpos('TCAG', z), 1), '' ORDER BY k) AS protein FROM c GROUP BY id)
    SELECT fq.id, coalesce(protein, '') AS protein FROM fq LEFT JOIN p ON fq.id = p.id""")
def _translate(spark, d):
    return a.fastq(spark, d).select("id", sequence.translate_codons("seq").alias("protein"))


@query("duplex_sort_and_tag")
def _tagged(spark, d):
    h = a.hangs(spark, d)
    _, members = duplex.cluster_hangs(h)
    tagged = duplex.sort_dh(duplex.tag_reads_with_group(h, members)).select("read_id", "group_id", *duplex.ARMS)
    keys = ["chr_1", "chr_2", "strand_1", "strand_2", "start_1", "start_2", "read_id", "group_id"]
    return qc.global_index(tagged, *keys).withColumnRenamed("at", "place")


# ---- alignments as reads, names, transcripts -------------------------------------------------------------------------


@query("sam2fq", f"""WITH {a.SAM}, {a.READ_SAM}, t AS (SELECT read_id, flag, CASE WHEN flag = 16 THEN reverse(translate(seq, 'ACGT', 'TGCA')) ELSE seq END AS seq, CASE WHEN flag = 16 THEN reverse(qual) ELSE qual END AS qual FROM rs),
    o AS (SELECT *, row_number() OVER (PARTITION BY read_id ORDER BY flag, seq, qual) AS r FROM t) SELECT '@' || read_id AS key, seq, '+' AS tag, qual FROM o WHERE r = 1""")
def _sam2fq(spark, d):
    return reads.sam2fq(a.read_sam(spark, d))


@query("route_alignments", f"WITH {a.SAM}, {a.READ_SAM} SELECT 'aligned' AS kind, read_id AS name, seq FROM rs WHERE flag = 0 UNION ALL SELECT 'reads', '@' || read_id, seq FROM rs WHERE flag = 4")
def _route(spark, d):
    aligned, left = reads.route_alignments(a.read_sam(spark, d))
    return aligned.select(F.lit("aligned").alias("kind"), F.col("read_id").alias("name"), "seq").unionByName(left.select(F.lit("reads").alias("kind"), F.col("key").alias("name"), "seq"))


@query("read_length_hist", f"WITH {a.SAM}, {a.READ_SAM} SELECT CAST(length(seq) AS INTEGER) AS length, CAST(count(*) AS BIGINT) AS n FROM rs GROUP BY 1")
def _length_hist(spark, d):
    return reads.read_length_hist(a.read_sam(spark, d))


@query("subsequence", f"WITH {a.FASTQ} SELECT id, substr(seq, 6, 12) AS plus, reverse(translate(substr(seq, 6, 12), 'ACGT', 'TGCA')) AS minus FROM fq")
def _subsequence(spark, d):
    return a.fastq(spark, d).select("id", sequence.subsequence("seq", 5, 12).alias("plus"), sequence.subsequence("seq", 5, 12, "-").alias("minus"))


@query(
    "name_rules",
    """SELECT p_partkey, NOT (n LIKE 'chr%') AND NOT (n LIKE 'NC_%') AND length(n) > 6 AS scaffold, regexp_replace(n, '\\.[^.]*$', '') AS plain,
    CASE k WHEN 'protein_coding' THEN 'mRNA' WHEN 'lincRNA' THEN 'lncRNA' WHEN 'snoRNA' THEN 'snoRNA' WHEN 'processed_pseudogene' THEN 'pseudogene' ELSE 'other' END AS class FROM (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'chr' WHEN 1 THEN 'NC_' ELSE 'x' END || CAST(p_partkey * 101 AS VARCHAR) || '.' || CAST(p_size AS VARCHAR) AS n,
      CASE p_partkey % 5 WHEN 0 THEN 'protein_coding' WHEN 1 THEN 'lincRNA' WHEN 2 THEN 'snoRNA' WHEN 3 THEN 'processed_pseudogene' ELSE 'tRNA' END AS k FROM part)""",
)
def _names(spark, d):
    rows = a.table(spark, d, "part")
    key = F.col("p_partkey")
    name = F.concat(F.element_at(F.array(F.lit("chr"), F.lit("NC_"), F.lit("x")), (key % 3 + 1).cast("int")), (key * 101).cast("string"), F.lit("."), F.col("p_size").cast("string"))
    kind = F.element_at(F.array(*map(F.lit, ("protein_coding", "lincRNA", "snoRNA", "processed_pseudogene", "tRNA"))), (key % 5 + 1).cast("int"))
    return rows.select("p_partkey", sequence.is_scaffold(name).alias("scaffold"), sequence.strip_version(name).alias("plain"), sequence.gene_type_class(kind).alias("class"))


@query(
    "transcript_rt",
    f"""WITH {a.SAM}, r AS (SELECT chr_id, pos AS first, least(pos - 1 + CASE line WHEN 1 THEN q WHEN 2 THEN q WHEN 3 THEN 2 * q + 100 WHEN 4 THEN 2 * q ELSE 2 * q + 1 END, 70000) AS second, CAST(1 AS DOUBLE) / count(*) OVER (PARTITION BY read_id) AS w FROM cig WHERE flag IN (0, 256)),
    d AS (SELECT chr_id, first - 1 AS pos, 0.0 AS bd, w AS rt FROM r WHERE first <= second UNION ALL SELECT chr_id, unnest(range(first, second + 1)), w, 0.0 FROM r WHERE first <= second)
    SELECT chr_id AS transcript_id, CAST(pos AS INTEGER) AS pos, round(sum(bd), 6) AS bd, round(sum(rt), 6) AS rt FROM d GROUP BY ALL""",
)
def _transcript_rt(spark, d):
    s = a.sam(spark, d)
    known = s.select(F.col("chr_id").alias("contig")).distinct().select("contig", F.lit(70000).cast("long").alias("length"), F.lit(9.0).alias("rpkm"))
    rows = tracks.transcript_rt(s, known).select("transcript_id", F.posexplode(F.arrays_zip("bd", "rt")).alias("pos", "x"))
    return rows.select("transcript_id", "pos", F.round("x.bd", 6).alias("bd"), F.round("x.rt", 6).alias("rt")).where("bd <> 0 or rt <> 0")


@query("union_replicates", f"WITH {a.COUNTS} SELECT contig, strand, pos, CAST(sum(n_rt + d_rt) AS BIGINT) AS rt, CAST(sum(n_bd + d_bd) AS BIGINT) AS bd FROM counts JOIN sizes USING (contig) WHERE pos <= length GROUP BY ALL")
def _union(spark, d):
    c = _counts(spark, d)
    return pileup.union_replicates(*[c.select("contig", "strand", "pos", F.col(f"{s}_rt").alias("rt"), F.col(f"{s}_bd").alias("bd")) for s in "nd"])
