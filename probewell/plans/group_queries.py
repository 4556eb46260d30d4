"""Registered queries over groups that no task holds: cut axes, parameter grids, tiled sequences, sorted and sampled reads."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import chimera, duplex, matrix, pileup, qc, reads, scan, score, tracks
from ..sources import readers, writers
from . import adapters as a
from . import more_queries  # noqa: F401 - evaluate_structure
from .queries import _GTAB, _coo, _counts, _gtab, _MATRIX, _off_halves
from .registry import ORACLES, query
from .scratch import scratch

# ---- sliding windows with junctions, and over a grid of parameters

#: Of the gaps of all reads the first one in each thousand bases, if it ends there: they do not overlap.
_CUT = """cut AS (SELECT contig, strand, min(first) AS first, arg_min(second, (first, second)) AS second FROM junctions WHERE first // 1000 = second // 1000 GROUP BY contig, strand, first // 1000)"""
_ORG = """org AS (SELECT contig, strand, length, min(CASE WHEN n_rt > 0 THEN pos END) AS origin FROM counts JOIN sizes USING (contig) WHERE length >= 2 * {w} AND pos BETWEEN 1 AND length GROUP BY ALL HAVING min(CASE WHEN n_rt > 0 THEN pos END) IS NOT NULL)"""
_CELLS = """st AS (SELECT contig, strand, unnest(range(0, size - {w} + 1, 10)) AS start FROM tips WHERE size >= {w} UNION SELECT contig, strand, size - {w} FROM tips WHERE size >= {w}),
    wcells AS (SELECT contig, strand, start, start + unnest(range(0, {w})) AS at FROM st),
    wrows AS (SELECT w.contig, w.strand, w.start, w.at, x.pos, coalesce(n_rt, 0) AS n_rt, coalesce(n_bd, 0) AS n_bd, coalesce(d_rt, 0) AS d_rt, coalesce(d_bd, 0) AS d_bd FROM wcells w JOIN ax x ON w.contig = x.contig AND w.strand = x.strand AND w.at = x.at LEFT JOIN counts c ON w.contig = c.contig AND w.strand = c.strand AND c.pos = x.pos)"""


def _cut(spark, d):
    tile = F.expr("first div 1000")
    rows = a.junctions(spark, d).where("first div 1000 = second div 1000")
    return rows.groupBy("contig", "strand", tile.alias("t")).agg(F.min(F.struct("first", "second")).alias("j")).select("contig", "strand", "j.*")


_PLAIN = ORACLES["sliding_score_fixed"]
_FROM_GOOD = _PLAIN[_PLAIN.index("good AS (") :]


@query(
    "sliding_score_junctions",
    f"""WITH {a.COUNTS}, {a.JUNCTIONS.removeprefix(a.READS).lstrip(",")}, {_CUT}, {_ORG.format(w=50)},
    places AS (SELECT contig, strand, origin, unnest(range(origin, length + 1)) AS pos FROM org),
    ax AS (SELECT contig, strand, pos, row_number() OVER (PARTITION BY contig, strand ORDER BY pos) - 1 AS at FROM places p WHERE NOT EXISTS (SELECT 1 FROM cut c WHERE c.contig = p.contig AND c.strand = p.strand AND c.first >= p.origin AND p.pos BETWEEN c.first AND c.second)),
    tips AS (SELECT contig, strand, count(*) AS size FROM ax GROUP BY ALL),
    {_CELLS.format(w=50)},
    {_FROM_GOOD}""",
)
def _sliding_cut(spark, d):
    counts = _counts(spark, d)
    sizes = a.sizes(a.reads(spark, d))
    return score.sliding_score(counts, sizes, _cut(spark, d), grid="fixed", wsize=50, wstep=10, min_cov=5, out_min_cov=5, min_bd=5, min_rt=0.5, low_bd=2).withColumn("score", _off_halves("score"))


def _window_factor(c: str, w: int) -> str:
    return f"""g_{c}_{w} AS (SELECT contig, strand, start, CASE WHEN f = 0 THEN 1.0 ELSE f END AS {c}_f FROM (SELECT contig, strand, start, coalesce(median(CASE WHEN r >= {w // 10} AND r < {2 * w // 10} THEN v END), 1.0) AS f
      FROM (SELECT contig, strand, start, CAST({c} AS DOUBLE) AS v, row_number() OVER (PARTITION BY contig, strand, start ORDER BY {c} DESC) - 1 AS r FROM wrows_{w}) GROUP BY ALL))"""


def _grid_sql(w: int, subs: tuple) -> str:
    """CTEs of the areas under the curve of one window size: auc_<w>."""
    names = ("n_rt", "n_bd", "d_rt", "d_bd")
    cells = _CELLS.format(w=w)
    for name in ("st", "wcells", "wrows"):
        cells = cells.replace(f"{name} AS", f"{name}_{w} AS").replace(f"FROM {name}", f"FROM {name}_{w}")
    joins = " ".join(f"JOIN g_{c}_{w} USING (contig, strand, start)" for c in names)
    scaled = "CASE WHEN n >= 20 AND lo < hi THEN least(greatest((v - lo) / (hi - lo), 0.0), 1.0) END"
    return f"""{cells.replace("FROM tips", f"FROM tips_{w}").replace("JOIN ax", f"JOIN ax_{w}")},
    good_{w} AS (SELECT contig, strand, start FROM wrows_{w} GROUP BY ALL HAVING sum(CASE WHEN d_bd >= 2 THEN 1 ELSE 0 END) >= {w // 5} AND sum(CASE WHEN d_bd >= 5 THEN 1 ELSE 0 END) > {w // 2} AND avg(n_rt) >= 0.5),
    {", ".join(_window_factor(c, w) for c in names)},
    sc_{w} AS (SELECT sub, w.contig, w.strand, w.start, w.pos, CASE WHEN d_bd > 0 THEN 10.0 * (n_rt / n_rt_f - sub * (d_rt / d_rt_f)) / (d_bd / d_bd_f) END AS v FROM wrows_{w} w JOIN good_{w} USING (contig, strand, start) {joins}, (SELECT unnest([{", ".join(f"CAST({s} AS DOUBLE)" for s in subs)}]) AS sub)),
    sr_{w} AS (SELECT *, row_number() OVER (PARTITION BY sub, contig, strand, start ORDER BY v) - 1 AS r, count(*) OVER (PARTITION BY sub, contig, strand, start) AS n FROM sc_{w} WHERE v IS NOT NULL),
    sb_{w} AS (SELECT sub, contig, strand, start, greatest(max(CASE WHEN r = floor(0.05 * n) THEN v END), 0.0) AS lo, max(CASE WHEN r = n - 1 - floor(0.05 * n) THEN v END) AS hi, max(n) AS n FROM sr_{w} GROUP BY ALL),
    per_{w} AS (SELECT contig, strand, pos, count(*) AS n_windows FROM wrows_{w} GROUP BY ALL),
    val_{w} AS (SELECT sub, contig, strand, pos, avg({scaled}) AS score, count({scaled}) AS good FROM sc_{w} JOIN sb_{w} USING (sub, contig, strand, start) GROUP BY ALL),
    kept_{w} AS (SELECT v.sub, v.contig, v.pos, v.score FROM val_{w} v JOIN per_{w} p USING (contig, strand, pos) JOIN counts c USING (contig, strand, pos) WHERE strand = '+' AND n_windows >= 2 AND good > floor(n_windows / 2.0) AND c.d_bd >= 5),
    q_{w} AS (SELECT sub, substr('((..).', CAST((pos - 1) % 6 + 1 AS INTEGER), 1) <> '.' AS paired, least(greatest(ceil(round(score / 0.01, 9)), -1), 102) AS c FROM kept_{w}),
    h_{w} AS (SELECT sub, c, count(*) FILTER (paired) AS t, count(*) FILTER (NOT paired) AS f FROM q_{w} GROUP BY ALL),
    s_{w} AS (SELECT sub, c, sum(t) OVER u / CAST(sum(t) OVER e AS DOUBLE) AS tpr, sum(f) OVER u / CAST(sum(f) OVER e AS DOUBLE) AS fpr FROM h_{w} WINDOW u AS (PARTITION BY sub ORDER BY c), e AS (PARTITION BY sub)),
    z_{w} AS (SELECT sub, (fpr - coalesce(lag(fpr) OVER o, 0)) * (tpr + coalesce(lag(tpr) OVER o, 0)) / 2 AS a FROM s_{w} WINDOW o AS (PARTITION BY sub ORDER BY c)),
    auc_{w} AS (SELECT CAST({w} AS INTEGER) AS wsize, sub, floor(sum(a) * 1e5 + 0.3137) / 1e5 AS auc FROM z_{w} GROUP BY sub)"""


def _axis(w: int) -> str:
    return f"""tips_{w} AS (SELECT contig, strand, length - origin + 1 AS size FROM org_{w}), ax_{w} AS (SELECT contig, strand, pos, pos - origin AS at FROM (SELECT contig, strand, origin, unnest(range(origin, length + 1)) AS pos FROM org_{w}))"""


_WINDOWS, _SUBS = (40, 60), (0.0, 0.25, 0.5)


@query("train_parameters", f"""WITH {a.COUNTS}, {", ".join(_ORG.format(w=w).replace("org AS", f"org_{w} AS") + ", " + _axis(w) + ", " + _grid_sql(w, _SUBS) for w in _WINDOWS)}
    {" UNION ALL ".join(f"SELECT * FROM auc_{w}" for w in _WINDOWS)}""")
def _train(spark, d):
    sizes = a.sizes(a.reads(spark, d))
    n = F.col("length").cast("int")
    dots = sizes.select(F.col("contig").alias("id"), F.repeat(F.lit("A"), n).alias("seq"), F.substring(F.repeat(F.lit("((..)."), F.floor(n / 6).cast("int") + 1), F.lit(1), n).alias("dot"))
    found = qc.train_parameters(_counts(spark, d), sizes, dots, _WINDOWS, _SUBS, wstep=10, min_cov=5, out_min_cov=5, min_bd=5, min_rt=0.5, low_bd=2)
    return found.withColumn("auc", F.floor(F.col("auc") * 1e5 + 0.3137) / 1e5)


_BASE = "substr('ACGU', CAST((pos * 7 + pos // 5) % 4 AS INTEGER) + 1, 1)"


@query("mask_by_base", f"""WITH {a.COUNTS} SELECT contig, strand, pos, {_BASE} AS base, n_rt FROM counts WHERE {_BASE} IN ('A', 'U')""")
def _masked(spark, d):
    base = F.expr("substr('ACGU', cast((pos * 7 + pos div 5) % 4 as int) + 1, 1)")
    return score.mask_by_base(_counts(spark, d).withColumn("base", base), "AT").select("contig", "strand", "pos", "base", "n_rt")


@query("separate_bases")
def _separate(spark, d):
    """Each base ranked against its own kind, all bases in one result."""
    base = F.expr("substr('ACGU', cast((pos * 7 + pos div 5) % 4 as int) + 1, 1)")
    counts, sizes = _counts(spark, d).withColumn("base", base), a.sizes(a.reads(spark, d))
    return score.sliding_score(counts, sizes, grid="fixed", wsize=100, wstep=20, bases=tuple("ACGT"), min_cov=5, out_min_cov=5, min_bd=5, min_rt=0.5, low_bd=2)


@query(
    "bd_extension",
    f"""WITH {a.READS}, {a.JUNCTIONS.removeprefix(a.READS).lstrip(",")}, {_CUT}, m AS (SELECT contig, strand, CASE WHEN strand = '-' THEN -second ELSE first END AS a, CASE WHEN strand = '-' THEN -first ELSE second END AS b FROM cut),
    e AS (SELECT DISTINCT contig, strand, CASE WHEN strand = '-' THEN -end5 ELSE end5 END AS s FROM ends),
    span AS (SELECT contig, strand, min(s) - 400 AS lo, max(s) AS hi FROM e GROUP BY ALL), line AS (SELECT contig, strand, unnest(range(lo, hi + 1)) AS p FROM span),
    ax AS (SELECT contig, strand, p, row_number() OVER (PARTITION BY contig, strand ORDER BY p) AS k FROM line WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.contig = line.contig AND m.strand = line.strand AND p BETWEEN a AND b)),
    cover AS (SELECT e.contig, e.strand, e.s, x.p FROM e JOIN ax y ON y.contig = e.contig AND y.strand = e.strand AND y.p = e.s JOIN ax x ON x.contig = e.contig AND x.strand = e.strand AND x.k BETWEEN y.k - 60 AND y.k - 1
      UNION ALL SELECT e.contig, e.strand, e.s, unnest(range(greatest(e.s - 60, a), e.s)) FROM e JOIN m ON m.contig = e.contig AND m.strand = e.strand AND e.s BETWEEN a AND b),
    real AS (SELECT contig, strand, s, CASE WHEN strand = '-' THEN -p ELSE p END AS p FROM cover WHERE strand = '-' OR p >= 1),
    runs AS (SELECT contig, strand, s, min(p) AS first, max(p) AS second FROM (SELECT *, p - row_number() OVER (PARTITION BY contig, strand, s ORDER BY p) AS g FROM real) GROUP BY contig, strand, s, g)
    SELECT x.read_id, r.first, r.second FROM ends x JOIN runs r ON r.contig = x.contig AND r.strand = x.strand AND r.s = CASE WHEN x.strand = '-' THEN -x.end5 ELSE x.end5 END
    UNION ALL SELECT read_id, first, second FROM blocks""",
)
def _bd_extension(spark, d):
    r = a.reads(spark, d)
    return pileup.bd_extension(r, _cut(spark, d), a.sizes(r), ext=60).select("read_id", F.inline("regions"))


# ---- transcripts of the older pipeline


@query(
    "normalize_rt",
    """WITH v AS (SELECT 't' || p_partkey AS transcript_id, p_partkey, p_size, p_size + 30 AS length, unnest(['baseDensity', 'RTstop']) AS type FROM part),
    x AS (SELECT *, unnest(range(0, length)) AS i FROM v), y AS (SELECT *, CAST(CASE WHEN type = 'RTstop' THEN (i * 7 + p_partkey) % 13 ELSE (i * 5 + p_size) % 90 END AS DOUBLE) AS value FROM x),
    c AS (SELECT transcript_id, type, value, row_number() OVER w - 1 AS r, count(*) OVER (PARTITION BY transcript_id, type) AS n FROM y WHERE i >= CASE WHEN 64 < length THEN 32 WHEN 32 < length THEN 16 ELSE 8 END AND i < length - CASE WHEN 64 < length THEN 32 WHEN 32 < length THEN 16 ELSE 8 END WINDOW w AS (PARTITION BY transcript_id, type ORDER BY value DESC)),
    f AS (SELECT transcript_id, type, avg(value) AS factor FROM c WHERE r >= floor(n / 20.0) AND r < floor(2 * n / 20.0) GROUP BY ALL HAVING avg(value) > 1),
    ok AS (SELECT transcript_id FROM f GROUP BY ALL HAVING count(*) = 2)
    SELECT y.transcript_id, CAST(length AS BIGINT) AS length, y.type, factor AS scaling, CAST(i + 1 AS BIGINT) AS pos, round(value / (factor / 100), 6) AS value FROM y JOIN f USING (transcript_id, type) JOIN ok USING (transcript_id)""",
)
def _normalized(spark, d):
    key, size, n = F.col("p_partkey"), F.col("p_size"), (F.col("p_size") + 30).cast("long")
    at = F.sequence(F.lit(-1).cast("long"), n - 1)
    rt = a.table(spark, d, "part").select("p_partkey", "p_size").repartition("p_partkey").select(F.concat(F.lit("t"), key).alias("transcript_id"), n.alias("length"), F.lit("1").alias("rpkm"), F.transform(at, lambda i: ((i * 5 + size) % 90).cast("double")).alias("bd"), F.transform(at, lambda i: ((i * 7 + key) % 13).cast("double")).alias("rt"))
    rows = tracks.normalize_rt(rt).select("transcript_id", "length", "type", "scaling", F.posexplode("values").alias("pos", "value"))
    return rows.select("transcript_id", "length", "type", "scaling", (F.col("pos") + 1).cast("long").alias("pos"), F.round("value", 6).alias("value"))


@query("shape_replicate_corr", f"""WITH {_GTAB}, p AS (SELECT contig, strand, pos, shape AS x, round(sin(pos) * 3 + shape, 6) AS y, row_number() OVER (ORDER BY contig, strand, pos) - 1 AS place FROM gtab WHERE shape IS NOT NULL AND bd >= 10),
    n AS (SELECT count(*) AS n FROM p), r AS (SELECT p.place, p.x, q.y FROM p, n, p q WHERE q.place = (p.place - 1 + n.n) % n.n), k AS (SELECT 'true' AS kind, place, x, y FROM p UNION ALL SELECT 'rotated', place, x, y FROM r),
    w AS (SELECT kind, place // 100 AS win, CASE WHEN stddev_pop(x) * stddev_pop(y) > 0 THEN corr(x, y) END AS r FROM k GROUP BY ALL HAVING count(*) = 100)
    SELECT kind, count(*) AS n, round(avg(r), 5) AS r FROM w WHERE abs(r) > {qc.least_correlation(100, 0.05)!r} GROUP BY kind""")
def _shape_corr(spark, d):
    rows = _gtab(spark, d).where("shape is not null and bd >= 10")
    both = rows.select("contig", "strand", "pos", F.col("shape").alias("shape_1"), F.round(F.sin(F.col("pos").cast("double")) * 3 + F.col("shape"), 6).alias("shape_2"))
    return qc.shape_replicate_corr(both).where("kind <> 'shuffled'").withColumn("r", F.round("r", 5))  # the shuffle has its own seed


# ---- matrices, files, sorted and sampled reads


@query("compress_regions", f"""WITH {_MATRIX}, l AS (SELECT contig, max(x) AS n FROM coo GROUP BY contig), g AS (SELECT contig, n, unnest(range(1, n // 97 + 1)) AS k FROM l),
    r AS (SELECT contig, n, k, k * 97 - 90 AS first, k * 97 - 90 + (k * 31) % 93 AS second FROM g),
    b AS (SELECT *, row_number() OVER o AS i, lead(k) OVER o IS NULL AS last, CAST(floor(first / (n / 60.0) + 0.5) AS BIGINT) AS a, CAST(floor(second / (n / 60.0) + 0.5) AS BIGINT) AS b FROM r WINDOW o AS (PARTITION BY contig ORDER BY first)),
    e AS (SELECT contig, k, first, CASE WHEN i = 1 THEN greatest(a, 1) ELSE a END AS a, CASE WHEN last THEN least(b, 60) ELSE b END AS b FROM b),
    t AS (SELECT *, coalesce(lag(b) OVER (PARTITION BY contig ORDER BY first) = a, false) AS touch FROM e)
    SELECT contig, 'd' || k AS name, CASE WHEN touch THEN a + 1 ELSE a END AS first, b AS second FROM t WHERE NOT touch OR a <> b""")
def _regions(spark, d):
    lengths = scan.save(_coo(spark, d).groupBy("contig").agg(F.max("x").alias("length")), "lengths")
    k = lengths.select("contig", F.explode(F.expr("sequence(1L, length div 97)")).alias("k"))
    rows = k.select("contig", F.concat(F.lit("d"), "k").alias("name"), (F.col("k") * 97 - 90).alias("first"), (F.col("k") * 97 - 90 + (F.col("k") * 31) % 93).alias("second"))
    return matrix.compress_regions(rows, lengths, 60)


@query("fasta_tiles", f"WITH {a.FASTQ}, t AS (SELECT doc_id, s, unnest(range(0, (length(s) + 249) // 250)) AS t FROM letters WHERE s <> '') SELECT 's' || doc_id AS contig, CAST(t AS BIGINT) AS tile, substr(s, t * 250 + 1, 250) AS seq FROM t")
def _fasta_tiles(spark, d):
    path = scratch(spark, "fasta")
    writers.write_fasta(a.letters(spark, d).select(F.concat(F.lit("s"), "doc_id").alias("id"), F.lit(None).cast("string").alias("annotation"), "seq"), path)
    return readers.read_fasta_tiles(spark, path, 250)


@query("sort_coordinate", f"WITH {a.SAM} SELECT read_id, chr_id, pos, row_number() OVER (ORDER BY chr_id, pos, read_id, line) - 1 AS place FROM sam")
def _sorted(spark, d):
    rows = reads.sort_coordinate(a.sam(spark, d)).select("read_id", "chr_id", "pos", "line")
    return qc.global_index(rows, "chr_id", "pos", "read_id", "line").select("read_id", "chr_id", "pos", F.col("at").alias("place"))


@query("sample_reads", f"WITH {a.SAM} SELECT read_id, line FROM sam WHERE CAST('0x' || substr(md5('5|' || read_id || '|' || flag || '|' || pos), 1, 13) AS BIGINT) < floor(1000.0 / (SELECT count(*) FROM sam) * {1 << 52})")
def _sampled(spark, d):
    return reads.sample_reads(a.sam(spark, d), 1000, seed=5).select("read_id", "line")


@query("dg_tab_file", f"""WITH {a.HANGS}, g AS (SELECT chr_1, strand_1, start_1 // 150 AS a, chr_2, strand_2, start_2 // 150 AS b, min(start_1) AS start_1, max(end_1) AS end_1, min(start_2) AS start_2, max(end_2) AS end_2, count(*) AS support, string_agg(DISTINCT read_id, ',' ORDER BY read_id) AS reads FROM hangs GROUP BY ALL)
    SELECT chr_1 || ':' || strand_1 || ':' || a || ':' || chr_2 || ':' || strand_2 || ':' || b AS group_id, chr_1, start_1, end_1, chr_2, start_2, end_2, support, reads FROM g WHERE support >= 2""")
def _dg_tab(spark, d):
    key = F.concat_ws(":", "chr_1", "strand_1", F.expr("start_1 div 150"), "chr_2", "strand_2", F.expr("start_2 div 150"))
    named = a.hangs(spark, d).withColumn("group_id", key)
    ends = [f(f"{c}_{i}").alias(f"{c}_{i}") for i in (1, 2) for c, f in (("start", F.min), ("end", F.max))]
    groups = named.groupBy("group_id", "chr_1", "strand_1", "chr_2", "strand_2").agg(*ends, F.count("*").alias("support"))
    path = scratch(spark, "groups")
    writers.write_dg_tab(groups.select("group_id", *duplex.ARMS, "support"), named.select("group_id", "read_id"), path)
    f = F.split("value", "\t")
    names = ["group_id", *duplex.ARMS, "support", "reads"]
    kinds = {"start_1": "long", "end_1": "long", "start_2": "long", "end_2": "long", "support": "long"}
    rows = spark.read.text(path).select(*[f[i].cast(kinds.get(n, "string")).alias(n) for i, n in enumerate(names)])
    return rows.drop("strand_1", "strand_2")


@query(
    "evaluate_accessible",
    ORACLES["evaluate_structure"].replace("FROM sv JOIN s USING (transcript_id) WHERE x IS NOT NULL)", "FROM sv JOIN s USING (transcript_id) WHERE x IS NOT NULL AND (i % 11 = 0 OR (i * 3 + length(transcript_id)) % 10 >= 4 OR i <= k OR i > 70 - k))"),
)
def _accessible(spark, d):
    from .queries import _shapes

    k = (F.col("p_size") % 20 + 5).cast("int")
    dot = F.concat(F.repeat(F.lit("("), k), F.repeat(F.lit("."), 70 - 2 * k), F.repeat(F.lit(")"), k))
    dots = a.table(spark, d, "part").select(F.concat(F.lit("t"), "p_partkey").alias("id"), F.repeat(F.lit("ACGUA"), 14).alias("seq"), dot.alias("dot"))
    places = dots.select("id", F.explode(F.sequence(F.lit(1), F.lit(70))).alias("pos"))
    access = places.select("id", "pos", F.when(F.col("pos") % 11 != 0, ((F.col("pos") * 3 + F.length("id")) % 10).cast("double")).alias("value"))
    found = qc.evaluate_structure(_shapes(spark, d), dots, access, 4.0, ignore_double_strand=True)
    return found.select("transcript_id", (F.floor(F.col("auc") * 1e6 + 0.3137) / 1e6).alias("auc"), "positives", "negatives")


# ---- split alignments

_SPLIT = """sp AS (SELECT 'r' || l_orderkey AS read_id, CAST((CASE WHEN l_suppkey % 7 = 0 THEN 16 ELSE 0 END) + (CASE WHEN l_linenumber > 1 THEN 256 ELSE 0 END) AS INTEGER) AS flag, 'c' || (l_suppkey % 3) AS chr_id,
      CAST(l_partkey * 3 + 101 AS BIGINT) AS pos, CAST(l_quantity AS BIGINT) AS q, CASE WHEN l_suppkey % 13 = 0 THEN 4 ELSE l_linenumber % 4 END AS kind, CAST(l_orderkey % 7 AS INTEGER) AS shift FROM lineitem),
    rec AS (SELECT *, CASE kind WHEN 1 THEN 55 - q WHEN 3 THEN 51 - q ELSE 0 END AS lft, CASE kind WHEN 3 THEN 4 ELSE q END AS m1, CASE WHEN kind IN (2, 3) THEN 2 ELSE 0 END AS d, CASE kind WHEN 2 THEN 4 WHEN 3 THEN q ELSE 0 END AS m2,
      CASE kind WHEN 0 THEN 55 - q WHEN 2 THEN 51 - q ELSE 0 END AS rgt, substr(repeat('ACGTTGCANC', 8), shift + 1, 55) AS seq, substr(repeat('IHGFEDCBA', 9), shift + 1, 55) AS qual,
      CASE kind WHEN 0 THEN q || 'M' || (55 - q) || 'S' WHEN 1 THEN (55 - q) || 'S' || q || 'M' WHEN 2 THEN q || 'M2D4M' || (51 - q) || 'S' WHEN 3 THEN (51 - q) || 'S4M2D' || q || 'M' ELSE q || 'M50N' || (55 - q) || 'M' END AS cigar FROM sp)"""
_PAIRED = """num AS (SELECT *, row_number() OVER (PARTITION BY read_id ORDER BY flag, chr_id, pos, cigar) AS n, flag & 16 <> 0 AS rev FROM {rec}),
    sd AS (SELECT *, CASE WHEN (lft > rgt) <> rev THEN 'RIGHT' ELSE 'LEFT' END AS side, CASE WHEN rev THEN rgt + 1 ELSE lft + 1 END AS f, CASE WHEN rev THEN 55 - lft ELSE 55 - rgt END AS t FROM num WHERE kind <> 4),
    pr AS (SELECT a.read_id, a.n AS i, b.n AS j, greatest(0, CASE WHEN a.side = 'LEFT' THEN a.t - b.f ELSE b.t - a.f END + 1) AS ab, a, b FROM sd a JOIN sd b ON a.read_id = b.read_id AND a.n < b.n AND a.side <> b.side),
    ends AS (SELECT *, unnest([{{'k': 1, 'x': a}}, {{'k': 2, 'x': b}}]) AS e FROM pr),
    onr AS (SELECT read_id, i, j, ab, e.k AS k, e.x AS x, e.x.f + CASE WHEN e.x.side = 'RIGHT' THEN ab ELSE 0 END AS lo, e.x.t - CASE WHEN e.x.side = 'LEFT' THEN ab ELSE 0 END AS hi FROM ends),
    dir AS (SELECT *, CASE WHEN x.rev THEN 56 - hi ELSE lo END AS p, CASE WHEN x.rev THEN 56 - lo ELSE hi END AS q, min(hi - lo) OVER (PARTITION BY read_id, i, j) AS least FROM onr),
    part AS (SELECT *, greatest(0, least(x.lft + x.m1, q) - greatest(x.lft + 1, p) + 1) AS n1, greatest(0, least(x.lft + x.m1 + x.m2, q) - greatest(x.lft + x.m1 + 1, p) + 1) AS n2 FROM dir WHERE least >= 0),
    arm AS (SELECT *, CASE WHEN n1 > 0 THEN n1 || 'M' ELSE '' END || CASE WHEN n1 > 0 AND n2 > 0 THEN x.d || 'D' ELSE '' END || CASE WHEN n2 > 0 THEN n2 || 'M' ELSE '' END AS cg,
      CASE WHEN n1 > 0 THEN x.pos + greatest(0, p - x.lft - 1) ELSE x.pos + x.m1 + x.d + p - x.lft - x.m1 - 1 END AS first, CASE WHEN n2 > 0 THEN x.pos + x.m1 + x.d + least(x.lft + x.m1 + x.m2, q) - x.lft - x.m1 - 1 ELSE x.pos + least(x.lft + x.m1, q) - x.lft - 1 END AS last,
      substr(x.seq, p, q - p + 1) AS sq, substr(x.qual, p, q - p + 1) AS ql FROM part),
    two AS (SELECT o.read_id, o.i, o.j, CAST(o.ab AS INTEGER) AS ab, o, t FROM arm o JOIN arm t ON o.read_id = t.read_id AND o.i = t.i AND o.j = t.j AND o.k = 1 AND t.k = 2 WHERE o.ab <= 10),
    g1 AS (SELECT *, CASE WHEN o.first <= t.first THEN o ELSE t END AS u, CASE WHEN o.first <= t.first THEN t ELSE o END AS v, CASE WHEN o.x.pos <= t.x.pos THEN o.x.side = 'LEFT' ELSE t.x.side = 'LEFT' END <> o.x.rev AS facing FROM two
      WHERE o.x.chr_id = t.x.chr_id AND o.x.rev = t.x.rev AND least(o.x.pos + o.x.m1 + o.x.d + o.x.m2 - 1, t.x.pos + t.x.m1 + t.x.d + t.x.m2 - 1) < greatest(o.x.pos, t.x.pos)),
    g2 AS (SELECT *, v.first - u.last - 1 AS gap FROM g1 WHERE v.first - u.last - 1 >= 5 AND least(u.last - u.first, v.last - v.first) + 1 >= {arm}),
    grouped AS (SELECT read_id || '_' || row_number() OVER w AS read_id, CAST(CASE WHEN o.x.rev THEN 16 ELSE 0 END AS INTEGER) AS flag, o.x.chr_id AS chr_id, u.first AS pos, u.cg || gap || 'N' || v.cg AS cigar, u.sq || v.sq AS seq, u.ql || v.ql AS qual, ab,
      CASE WHEN facing THEN 'CENTER' ELSE 'FLANKING' END AS at_, count(*) OVER (PARTITION BY read_id) AS nh FROM g2 WINDOW w AS (PARTITION BY read_id ORDER BY i, j)),
    t2 AS (SELECT * FROM two WHERE least(o.last - o.first, t.last - t.first) + 1 >= {arm} AND ({other} OR o.x.chr_id <> t.x.chr_id OR o.x.rev <> t.x.rev)),
    t3 AS (SELECT read_id || '_' || row_number() OVER (PARTITION BY read_id ORDER BY i, j) AS read_id, ab, count(*) OVER (PARTITION BY read_id) AS nh, unnest([o, t]) AS z FROM t2),
    trimmed AS (SELECT read_id, CAST((z.x.flag & ~256) | CASE WHEN z.k = 1 THEN 0 ELSE 256 END AS INTEGER) AS flag, z.x.chr_id AS chr_id, z.first AS pos, z.cg AS cigar, z.sq AS seq, z.ql AS qual, ab, nh FROM t3 WHERE nh <= 1000)"""


def _split(spark, d):
    """Alignments of parts of reads of 55 bases: clipped on one side, some with a deletion, some with a gap."""
    q, n, c = F.col("l_quantity").cast("long"), F.col("l_linenumber"), lambda *x: F.concat(*[F.lit(v) if isinstance(v, str) else v.cast("string") for v in x])
    kind = F.when(F.col("l_suppkey") % 13 == 0, 4).otherwise(n % 4)
    cigar = F.when(kind == 0, c(q, "M", 55 - q, "S")).when(kind == 1, c(55 - q, "S", q, "M")).when(kind == 2, c(q, "M2D4M", 51 - q, "S")).when(kind == 3, c(51 - q, "S4M2D", q, "M")).otherwise(c(q, "M50N", 55 - q, "M"))
    shift = (F.col("l_orderkey") % 7).cast("int")
    flag = F.when(F.col("l_suppkey") % 7 == 0, 16).otherwise(0) + F.when(n > 1, 256).otherwise(0)
    letters = lambda text, k: F.substring(F.repeat(F.lit(text), k), shift + 1, F.lit(55))
    return a.table(spark, d, "lineitem").select(
        c("r", F.col("l_orderkey")).alias("read_id"), flag.cast("int").alias("flag"), c("c", F.col("l_suppkey") % 3).alias("chr_id"), (F.col("l_partkey") * 3 + 101).cast("long").alias("pos"),
        cigar.alias("cigar"), letters("ACGTTGCANC", 8).alias("seq"), letters("IHGFEDCBA", 9).alias("qual"),
    )


@query("sam_group", f"WITH {_SPLIT}, {_PAIRED.format(rec='rec', arm=10, other='true')} SELECT read_id, flag, chr_id, pos, cigar, seq, qual, ab, at_ AS \"at\", nh FROM grouped")
def _sam_group(spark, d):
    return chimera.sam_group(_split(spark, d))


@query("sam_trim", f"WITH {_SPLIT}, {_PAIRED.format(rec='rec', arm=10, other='true')} SELECT * FROM trimmed")
def _sam_trim(spark, d):
    return chimera.sam_trim(_split(spark, d))


@query("sam_group_trim", f"""WITH {_SPLIT}, whole AS (SELECT * FROM rec WHERE read_id NOT IN (SELECT read_id FROM rec WHERE kind = 4)), {_PAIRED.format(rec='whole', arm=15, other='false')}
    SELECT 'gapped' AS kind, read_id, flag, chr_id, pos, cigar, seq, qual, 0 AS ab FROM rec WHERE kind = 4 UNION ALL SELECT 'gapped', read_id, flag, chr_id, pos, cigar, seq, qual, ab FROM grouped UNION ALL SELECT 'gapped', read_id, flag, chr_id, pos, cigar, seq, qual, ab FROM trimmed
    UNION ALL SELECT 'ungapped', read_id, flag, chr_id, pos, cigar, seq, qual, NULL FROM whole WHERE greatest(lft, rgt) <= 5""")
def _sam_group_trim(spark, d):
    gapped, plain = chimera.sam_group_trim(_split(spark, d))
    return gapped.select(F.lit("gapped").alias("kind"), "*").unionByName(plain.select(F.lit("ungapped").alias("kind"), "*", F.lit(None).cast("int").alias("ab")))


@query("group_read_pair", f"""WITH {_SPLIT}, num AS (SELECT *, row_number() OVER (PARTITION BY read_id ORDER BY flag, chr_id, pos, cigar) AS n, flag & 16 <> 0 AS rev FROM rec),
    p AS (SELECT a, b FROM num a JOIN num b ON a.read_id = b.read_id AND a.n < b.n),
    s AS (SELECT *, (a.lft > a.rgt) <> a.rev AS ra, (b.lft > b.rgt) <> b.rev AS rb, CASE WHEN a.rev THEN a.rgt + 1 ELSE a.lft + 1 END AS af, CASE WHEN a.rev THEN 55 - a.lft ELSE 55 - a.rgt END AS at_, CASE WHEN b.rev THEN b.rgt + 1 ELSE b.lft + 1 END AS bf, CASE WHEN b.rev THEN 55 - b.lft ELSE 55 - b.rgt END AS bt FROM p),
    w AS (SELECT *, greatest(0, CASE WHEN ra THEN bt - af ELSE at_ - bf END + 1) AS ab FROM s),
    st AS (SELECT CASE WHEN a.rev <> b.rev THEN 'DIFF_STRAND' WHEN a.chr_id <> b.chr_id THEN 'DIFF_CHR' WHEN a.kind = 4 OR b.kind = 4 THEN 'MULTI_MATCH' WHEN least(a.pos + a.m1 + a.d + a.m2 - 1, b.pos + b.m1 + b.d + b.m2 - 1) >= greatest(a.pos, b.pos) THEN 'OVERLAP'
      WHEN ra = rb THEN 'ABNORMAL_PATTERN' WHEN at_ - af + 1 <= ab OR bt - bf + 1 <= ab THEN 'INVALID_BORDER' ELSE 'SUCCESS' END AS status FROM w)
    SELECT status, count(*) AS n FROM st GROUP BY 1""")
def _statuses(spark, d):
    return chimera.group_read_pair(chimera.read_pairs(_split(spark, d))).groupBy("status").agg(F.count("*").alias("n"))
