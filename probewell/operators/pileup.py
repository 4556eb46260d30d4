"""Coverage, reverse-transcription stops and junctions of aligned reads.

``reads`` have contig, strand and regions (array of first, second: one closed block each, in genome order), and any
columns named in ``by``. Counts are sparse: a position with no read has no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Rows and bytes up to which a junction or size table is sent to every task.
SMALL_TABLE, SMALL_BYTES = 1_000_000, 32 << 20
TILE = 1 << 14


def small(table: DataFrame, limit: int = SMALL_TABLE, most: int = SMALL_BYTES) -> DataFrame:
    """The table, to be broadcast if it is proven to have at most ``limit`` rows and ``most`` bytes, and to be shuffled otherwise,
    whatever size is estimated: rows that are made from others (exploded ones) count as their source there."""
    width = F.lit(0)
    for name, kind in table.dtypes:
        column = F.col(f"`{name}`")
        size = F.octet_length(column) if kind in ("string", "binary") else F.octet_length(F.to_json(F.struct(column))) if kind.startswith(("array", "map", "struct")) else F.lit(8)
        width = width + F.coalesce(size, F.lit(0))
    rows, size = table.limit(limit + 1).agg(F.count("*"), F.sum(width)).first()
    return F.broadcast(table) if rows <= limit and (size or 0) <= most else shuffled(table)


def shuffled(table: DataFrame) -> DataFrame:
    """The table, to be joined by shuffle: it is never sent to the driver on an estimate."""
    return table.hint("merge")


def blocks(reads: DataFrame, by: tuple = ()) -> DataFrame:
    return reads.select("contig", "strand", *by, F.inline("regions"))


def base_density(reads: DataFrame, sizes: DataFrame | None = None, tile: int = TILE, by: tuple = ()) -> DataFrame:
    """bd: reads that cover each base, clipped to the contig size.

    Blocks are cut at tile borders and become +1/-1 events, which are summed before the shuffle (a pile of equal reads is
    two rows); a running sum inside each tile gives runs of equal depth, and only these are spread over positions.
    """
    key = ["contig", "strand", *by, "tile"]
    summed = _borders(reads, None if sizes is None else small(sizes.select("contig", "length")), tile, by).groupBy(*key, "pos").agg(F.sum("d").alias("d"))
    order = Window.partitionBy(*key).orderBy("pos")
    runs = summed.select(*key, "pos", F.sum("d").over(order).alias("bd"), F.lead("pos").over(order).alias("next")).where("bd > 0")
    return runs.select("contig", "strand", *by, F.explode(F.expr("sequence(pos, next - 1)")).alias("pos"), "bd")


def _borders(reads: DataFrame, lengths: DataFrame | None, tile: int, by: tuple = ()) -> DataFrame:
    """contig, strand, by, tile, pos, d: +1 where a block begins in a tile, -1 behind its end there."""
    one = F.lit(1).cast("long")
    cut = _cut(reads, lengths, tile, by)
    return cut.select("contig", "strand", *by, "tile", F.inline(F.array(F.struct("pos", one.alias("d")), F.struct(F.col("end").alias("pos"), (-one).alias("d")))))


def _cut(reads: DataFrame, lengths: DataFrame | None, tile: int, by: tuple = ()) -> DataFrame:
    """contig, strand, by, tile, pos, end: the pieces of blocks in tiles, ``end`` behind the last place."""
    rows = blocks(reads, by)
    if lengths is not None:
        rows = rows.join(lengths, "contig").withColumn("second", F.least("second", "length")).where("first <= second")
    first, last = F.floor(F.col("first") / tile), F.floor(F.col("second") / tile)
    cut = rows.withColumn("tile", F.explode(F.sequence(first, last)))
    start = F.greatest(F.col("first"), F.col("tile") * tile)
    stop = F.least(F.col("second") + 1, (F.col("tile") + 1) * tile)
    return cut.select("contig", "strand", *by, "tile", start.cast("long").alias("pos"), stop.cast("long").alias("end"))


def read_ends(reads: DataFrame, by: tuple = ()) -> DataFrame:
    """Each read's 5' end: its first base on +, its last on -."""
    end = F.when(F.col("strand") == "+", F.element_at("regions", 1)["first"]).otherwise(F.element_at("regions", -1)["second"])
    return reads.select("contig", "strand", *by, end.alias("end5"))


def rt_junction_shift(ends: DataFrame, junctions: DataFrame) -> DataFrame:
    """pos: the stop of each read, one base before its 5' end; before the junction if the read starts right behind one."""
    lines = junctions.select("contig", "strand", F.when(F.col("strand") == "+", F.col("second") + 1).otherwise(F.col("first") - 1).alias("end5"), F.when(F.col("strand") == "+", F.col("first") - 1).otherwise(F.col("second") + 1).alias("moved"))
    lines = lines.groupBy("contig", "strand", "end5").agg(F.min("moved").alias("moved"))
    plain = F.when(F.col("strand") == "+", F.col("end5") - 1).otherwise(F.col("end5") + 1)
    return ends.join(small(lines), ["contig", "strand", "end5"], "left").withColumn("pos", F.coalesce("moved", plain)).drop("moved")


def rt_stops(reads: DataFrame, junctions: DataFrame | None = None, sizes: DataFrame | None = None, by: tuple = ()) -> DataFrame:
    """rt: reads that stop at each base, one base upstream of their 5' end. Position 0 is kept; beyond the size is not."""
    counts = _stops(reads, junctions, by).groupBy("contig", "strand", *by, "pos").agg(F.count("*").alias("rt"))
    if sizes is not None:
        counts = counts.join(small(sizes.select("contig", "length")), "contig").where("pos <= length").drop("length")
    return counts


def _stops(reads: DataFrame, junctions: DataFrame | None, by: tuple = ()) -> DataFrame:
    ends = read_ends(reads, by)
    if junctions is not None:
        return rt_junction_shift(ends, junctions)
    return ends.withColumn("pos", F.when(F.col("strand") == "+", F.col("end5") - 1).otherwise(F.col("end5") + 1))


def _piled(reads: DataFrame, sizes: DataFrame, junctions: DataFrame | None, kind: str, by: tuple, kinds: dict[str, Column], tile: int = TILE) -> DataFrame:
    """contig, strand, by, pos and <k>_rt, <k>_bd for each of ``kinds``, the reads for which its condition on the column ``kind`` holds.

    Stops and borders of blocks meet where they are summed, so that both are known of a run of equal depth; its places are spread
    last, and are neither shuffled nor summed. A pile of reads is summed in batches first, and what a task sums and sorts is a few
    tiles, however many there are.
    """
    lengths, columns = small(sizes.select("contig", "length")), tuple(dict.fromkeys((*by, kind)))
    stops = _stops(reads, junctions, columns).join(lengths, "contig").where("pos <= length")
    stops = stops.select("contig", "strand", *columns, F.floor(F.col("pos") / tile).alias("tile"), F.col("pos").cast("long").alias("pos"), F.lit(None).cast("long").alias("end"))
    key = ["contig", "strand", *by, "tile"]
    pieces = summed_in_batches(_cut(reads, lengths, tile, columns).unionByName(stops).withColumn("n", F.lit(1).cast("long")), ["n"])
    mark = lambda at, d, rt: F.struct(F.col(at).alias("pos"), d.alias("d"), rt.alias("rt"))
    n, none = F.col("n"), F.lit(0).cast("long")
    marks = pieces.repartition(_tasks(sizes, tile), *key).select(*dict.fromkeys((*key, kind)), F.inline(F.when(F.col("end").isNull(), F.array(mark("pos", none, n))).otherwise(F.array(mark("pos", n, none), mark("end", -n, none)))))
    summed = marks.groupBy(*key, "pos").agg(*[F.sum(F.when(when, F.col(c)).otherwise(0)).alias(f"_{k}_{c}") for k, when in kinds.items() for c in ("d", "rt")])
    order = Window.partitionBy(*key).orderBy("pos")
    runs = summed.select("*", *[F.sum(f"_{k}_d").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias(f"_{k}_bd") for k in kinds], F.lead("pos").over(order).alias("_next"))
    any_of = lambda c: F.greatest(*[F.col(f"_{k}_{c}") for k in kinds], F.lit(0)) > 0
    spread = runs.where(any_of("bd") | any_of("rt")).withColumn("_at", F.explode(F.sequence("pos", F.when(any_of("bd"), F.col("_next") - 1).otherwise(F.col("pos")))))
    own = F.col("_at") == F.col("pos")
    return spread.select("contig", "strand", *by, F.col("_at").alias("pos"), *[c for k in kinds for c in (F.when(own, F.col(f"_{k}_rt")).otherwise(0).alias(f"{k}_rt"), F.col(f"_{k}_bd").alias(f"{k}_bd"))])


def _tasks(sizes: DataFrame, tile: int, tiles: int = 8, most: int = 4096) -> int:
    """Partitions of some ``tiles`` tiles, both strands counted; not fewer than Spark's own number, and up to ``most`` of them, which then have more."""
    count = sizes.agg(F.sum(F.ceil(F.col("length") / tile))).first()[0] or 0
    return max(int(sizes.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(-(-2 * int(count) // tiles), most))


def summed_in_batches(rows: DataFrame, sums: list[str], batch: int = 1 << 17) -> DataFrame:
    """``rows`` with the columns ``sums`` (long) summed over those of a batch that are equal in all others.

    Like the map side of an aggregation, but what it holds does not grow with the input split; equal rows can be left in several batches.
    """
    columns = rows.columns
    keys = [c for c in columns if c not in sums]

    def summed(parts: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
        table = pa.Table.from_batches(parts).group_by(keys, use_threads=False).aggregate([(c, "sum") for c in sums])
        return pa.table([table[c] if c in keys else table[f"{c}_sum"] for c in columns], names=columns).to_batches()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for part in batches:
            held.append(part)
            n += part.num_rows
            if n >= batch:
                yield from summed(held)
                held, n = [], 0
        if n:
            yield from summed(held)

    return rows.mapInArrow(add, rows.schema)


def gaps(reads: DataFrame) -> DataFrame:
    """The introns of reads: from one block's end + 1 to the next block's start - 1."""
    pairs = F.zip_with(F.slice("regions", F.lit(1), F.size("regions") - 1), F.slice("regions", F.lit(2), F.size("regions") - 1), lambda a, b: F.struct((a["second"] + 1).alias("first"), (b["first"] - 1).alias("second")))
    return reads.where(F.size("regions") > 1).select("contig", "strand", F.inline(pairs))


def junction_support(reads: DataFrame, junctions: DataFrame) -> DataFrame:
    """junctions with support: the gaps of reads that equal each. Counted first, so that only sums are joined."""
    key = ["contig", "strand", "first", "second"]
    counts = gaps(reads).groupBy(*key).agg(F.count("*").alias("support"))
    return junctions.select(*key).distinct().join(counts, key, "left").fillna({"support": 0})


def combine_junctions(junctions: DataFrame, sizes: DataFrame) -> DataFrame:
    """Junctions of each contig and strand without overlaps.

    In order of (first, second): of overlapping ones the best supported stays; then one beyond the contig goes and two
    that touch become one (each is merged with its successor once, as a chain of three merges in pairs). Overlaps are settled
    inside a run of overlapping introns, which a task passes once and in order, holding one junction of it.
    """
    from . import scan

    key = ["contig", "strand"]
    rows = junctions.join(small(sizes.select("contig", "length")), "contig").select(*key, "length", "first", "second", F.col("support").cast("long").alias("support"))
    marked = scan.runs(rows, key, "first", "second", 0, ("support",))
    names = [*key, "island", "length", "first", "second", "support"]

    def best_of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = None  # a junction is settled by the next one that does not overlap it
        for pdf in frames:
            out = []
            for row in zip(*(pdf[c] for c in names), strict=True):
                if last is None or (row[:3] == last[:3] and row[4] <= last[5]):
                    last = row if last is None or row[6] > last[6] else last
                else:
                    out.append(last)
                    last = row
            yield pd.DataFrame(out, columns=names)
        if last is not None:
            yield pd.DataFrame([last], columns=names)

    ordered = marked.select(*names).repartition(*key, "island").sortWithinPartitions(*key, "island", "first", "second", "support")
    best = ordered.mapInPandas(best_of, ", ".join(f"{n} {t}" for n, t in ordered.dtypes)).drop("island")
    touching = scan.runs(best.where("second <= length + 1").drop("length"), key, "first", "second", 1)
    pair = F.floor((F.row_number().over(Window.partitionBy(*key, "island").orderBy("first")) - 1) / 2)
    return touching.withColumn("_pair", pair).groupBy(*key, "island", "_pair").agg(F.min("first").alias("first"), F.max("second").alias("second"), F.max("support").alias("support")).drop("island", "_pair")


def bd_extension(reads: DataFrame, junctions: DataFrame, sizes: DataFrame | None = None, ext: int = 0) -> DataFrame:
    """Reads with extra blocks: coverage lengthened by ``ext`` bases upstream of the 5' end.

    From inside a junction the extension stops at its edge; otherwise it jumps over the junctions on its way (disjoint ones, as
    ``combine_junctions`` gives). On an axis without junctions an extension is one interval, so its far end is found by
    two passes over the sorted ends and junctions: one takes the 5' ends to that axis, one comes back. Each distinct end
    is worked off once, and no task holds a contig's junctions.
    """
    from . import scan
    from .coords import interval_join

    if ext <= 0:
        return reads
    key, up = ["contig", "strand"], F.when(F.col("strand") == "-", -1).otherwise(1)
    # upstream is always downwards: the - strand is mirrored
    with_end = read_ends(reads, tuple(c for c in reads.columns if c not in key)).withColumn("_end", F.col("end5") * up).drop("end5")
    ends = with_end.select(*key, F.col("_end").alias("at")).distinct()
    mirrored = F.array_sort(F.array(F.col("first") * up, F.col("second") * up))
    cut = junctions.select(*key, "first", "second").distinct().select(*key, mirrored[0].alias("first"), mirrored[1].alias("second"))
    both = ends.withColumn("_row", F.lit(1)).unionByName(cut.select(*key, F.col("first").alias("at"), "second", F.lit(0).alias("_row")), allowMissingColumns=True)
    known = scan.before(scan.ranged(both, key, ["at", "_row"]), key, n_cut=F.col("second") - F.col("at") + 1, max_second=F.col("second"), max_first=F.when(F.col("_row") == 0, F.col("at")))
    flat = F.col("at") - F.coalesce("n_cut", F.lit(0)) - F.when(F.col("_row") == 1, F.lit(ext)).otherwise(0)
    known = scan.save(known.withColumn("flat", flat).drop(scan.PART, scan.AT, "n_cut"), "ends")
    inside = (F.col("_row") == 1) & (F.col("max_second") >= F.col("at"))
    free = scan.ranged(known.where(~F.coalesce(inside, F.lit(False))), key, ["flat", "_row"])
    back = scan.before(free, key, n_cut=F.col("second") - F.col("at") + 1).where("_row = 1")
    spans = back.select(*key, "at", (F.col("flat") + F.coalesce("n_cut", F.lit(0))).alias("first"), (F.col("at") - 1).alias("second"))
    passed = interval_join(spans, cut).groupBy(*key, "at").agg(F.array_sort(F.collect_list(F.struct("r_first", "r_second"))).alias("js"))
    spans = spans.join(passed, [*key, "at"], "left").withColumn("js", F.coalesce("js", F.expr("array()").cast("array<struct<r_first:bigint,r_second:bigint>>")))
    pieces = F.zip_with(
        F.concat(F.array("first"), F.transform("js", lambda j: j["r_second"] + 1)), F.concat(F.transform("js", lambda j: j["r_first"] - 1), F.array("second")), lambda x, y: F.struct(x.alias("first"), y.alias("second"))
    )
    stopped = known.where(inside).select(*key, "at", F.array(F.struct(F.greatest(F.col("at") - ext, "max_first").alias("first"), (F.col("at") - 1).alias("second"))).alias("p"))
    found = spans.select(*key, "at", pieces.alias("p")).unionByName(stopped).withColumn("up", up)
    real = F.transform(F.filter("p", lambda x: x["first"] <= x["second"]), lambda x: F.struct(F.when(F.col("up") < 0, -x["second"]).otherwise(F.greatest(x["first"], F.lit(1))).alias("first"), F.when(F.col("up") < 0, -x["first"]).otherwise(x["second"]).alias("second")))
    extra = found.select(*key, F.col("at").alias("_end"), F.filter(real, lambda x: x["first"] <= x["second"]).alias("_extra"))
    joined = with_end.join(extra, [*key, "_end"], "left")
    kind = dict(reads.dtypes)["regions"]
    regions = F.array_sort(F.concat("regions", F.coalesce("_extra", F.expr("array()").cast("array<struct<first:bigint,second:bigint>>")).cast(kind)))
    return joined.withColumn("regions", regions).select(*reads.columns)


def count_rt(reads: DataFrame, sizes: DataFrame, junctions: DataFrame | None = None, genome: DataFrame | None = None, min_bd: int = 50) -> DataFrame:
    """RT and BD of each position and ``sample`` (a column of reads): long form, with the base if a tiled genome is given."""
    both = _piled(reads, sizes, junctions, "sample", ("sample",), {"x": F.lit(True)}).select("contig", "strand", "pos", "sample", F.col("x_rt").alias("rt"), F.col("x_bd").alias("bd"))
    if genome is not None:
        both = with_base(both, genome)
    return both


def replicate_outer_join(counts_long: DataFrame, samples: list[str], min_bd: int = 50) -> DataFrame:
    """One row for each position with rt_<sample> and bd_<sample>; rows with a stop or enough coverage in any sample."""
    keys = [c for c in ("contig", "strand", "pos", "base") if c in counts_long.columns]
    pick = lambda c, s: F.sum(F.when(F.col("sample") == s, F.col(c)).otherwise(0))
    wide = counts_long.groupBy(*keys).agg(*[pick(c, s).alias(f"{c}_{s}") for s in samples for c in ("rt", "bd")])
    some = F.lit(False)
    for s in samples:
        some = some | (F.col(f"rt_{s}") >= 1) | (F.col(f"bd_{s}") >= min_bd)
    return wide.where(some)


def union_replicates(*frames: DataFrame) -> DataFrame:
    """Replicates' counts (contig, strand, pos, rt, bd) summed."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.groupBy("contig", "strand", "pos").agg(F.sum("rt").alias("rt"), F.sum("bd").alias("bd"))


def with_base(counts: DataFrame, genome: DataFrame, tile: int | None = None) -> DataFrame:
    """counts with ``base``, the transcribed base of a tiled genome (contig, tile, seq; tile t starts at t * size + 1)."""
    size = tile or genome.select(F.max(F.length("seq"))).first()[0] or 1
    at = F.floor((F.col("pos") - 1) / size)
    joined = counts.withColumn("tile", at).join(genome.select("contig", "tile", "seq"), ["contig", "tile"], "left")
    base = F.upper(F.expr(f"substring(seq, cast(pos - tile * {size} as int), 1)"))
    return joined.withColumn("base", F.when(F.col("strand") == "-", F.translate(base, "ACGT", "TGCA")).otherwise(base)).drop("tile", "seq")


def condition_counts(reads: DataFrame, sizes: DataFrame, junctions: DataFrame | None = None) -> DataFrame:
    """reads with ``condition`` N (treated) or D (control) → contig, strand, pos, n_rt, n_bd, d_rt, d_bd. Other conditions are left out."""
    kinds = {k: F.col("condition") == k.upper() for k in "nd"}
    return _piled(reads.where("condition in ('N', 'D')"), sizes, junctions, "condition", (), kinds).select("contig", "strand", "pos", "n_rt", "n_bd", "d_rt", "d_bd")
