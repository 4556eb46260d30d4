"""Ordered work on groups of any size: range partitions, what each of them comes to, and a prefix over these few rows.

A window by group would sort a whole group in one task. Here the rows are sorted by group and order over all tasks, and each window
sees what one range partition has of a group; what stands before a partition comes from a table with one row for
each partition and group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..plans.scratch import scratch

#: Columns that ``ranged`` adds: the range partition of a row, and its place in the order of all rows.
PART, AT = "_part", "_at"


def save(df: DataFrame, name: str) -> DataFrame:
    """Write the rows once as Parquet in the shared folder and read them back; this cuts the lineage."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ranged(rows: DataFrame, by: list[str], order: list[Column | str], name: str = "ranged") -> DataFrame:
    """``rows`` with _part and _at, in the order of ``by`` and ``order``, written once, so that every later step sees one and the same order."""
    keys = [*by, *order]
    dealt = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(AT, F.monotonically_increasing_id())
    return save(dealt.withColumn(PART, F.shiftright(AT, 33).cast("int")), name)


def before(table: DataFrame, by: list[str], **values: Column) -> DataFrame:
    """``table`` (of ``ranged``) with a column for each value: its sum (or, if the name begins with max_, its maximum) over the rows of
    the group that come before; null before the first.

    ``by`` may be empty. Windows hold one partition's rows of a group, or one row for each partition that a group lies in.
    """
    keyed = table.withColumns({f"_v_{n}": v for n, v in values.items()})
    fold = {n: F.max if n.startswith("max_") else F.sum for n in values}
    parts = keyed.groupBy(*by, PART).agg(*[f(f"_v_{n}").alias(f"_v_{n}") for n, f in fold.items()])
    upto = Window.partitionBy(*by).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.select(*by, PART, *[f(f"_v_{n}").over(upto).alias(f"_c_{n}") for n, f in fold.items()])
    here = Window.partitionBy(*by, PART).orderBy(AT).rowsBetween(Window.unboundedPreceding, -1)
    own = keyed.withColumns({f"_h_{n}": f(f"_v_{n}").over(here) for n, f in fold.items()})
    joined = own.alias("a").join(carried.alias("b"), [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in [*by, PART]])
    both = {n: F.greatest(f"_h_{n}", f"_c_{n}") if n.startswith("max_") else F.when(F.col(f"_h_{n}").isNull(), F.col(f"_c_{n}")).otherwise(F.col(f"_h_{n}") + F.coalesce(f"_c_{n}", F.lit(0))) for n in values}
    return joined.select("a.*", *[c.alias(n) for n, c in both.items()]).drop(*[f"_v_{n}" for n in values], *[f"_h_{n}" for n in values])


def ranks(counted: DataFrame, by: list[str], order: Column, **totals: Column) -> DataFrame:
    """``counted`` (by, v, c: distinct values and how often each occurs) with r, the values of the group before it in ``order``, n, those
    of the group, and a sum over the group for each of ``totals``.

    No task holds a group: only a range partition's share of it.
    """
    table = ranged(counted, by, [order])
    sums = table.groupBy(*by, PART).agg(F.sum("c").alias("_n"), *[F.sum(v).alias(f"_t_{t}") for t, v in totals.items()])
    parts = Window.partitionBy(*by).orderBy(PART)
    upto, group = parts.rowsBetween(Window.unboundedPreceding, -1), parts.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carried = sums.select(*by, PART, F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_before"), F.sum("_n").over(group).alias("n"), *[F.sum(f"_t_{t}").over(group).alias(t) for t in totals])
    here = Window.partitionBy(*by, PART).orderBy(AT).rowsBetween(Window.unboundedPreceding, 0)
    own = table.withColumn("_upto", F.sum("c").over(here))
    joined = own.alias("a").join(carried.alias("b"), [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in [*by, PART]])
    return joined.select(*[F.col(f"a.{c}").alias(c) for c in by], "a.v", "a.c", (F.col("_upto") - F.col("a.c") + F.col("_before")).alias("r"), "n", *totals)


def runs(rows: DataFrame, by: list[str], first: str, last: str, gap: int = 0, tie: tuple[str, ...] = (), name: str = "island") -> DataFrame:
    """``rows`` with ``name``, the number of their run (from 1 in each group): a run ends where the next ``first`` lies more than ``gap``
    behind every ``last`` before it.

    Runs are counted while the range partitions are written, each as if nothing came before it. What reaches over from the partitions
    before only undoes the beginnings up to its end, which are the first ones; at most one group of a partition comes from another, so
    these few numbers are sent to every task, and the rows are shuffled once.
    """
    from .pileup import small

    keys = [*by, first, last, *tie]
    dealt = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(PART, F.shiftright(F.monotonically_increasing_id(), 33).cast("int"))
    kind = T.StructType([*dealt.schema.fields, T.StructField("_run", T.LongType())])
    table = save(dealt.mapInArrow(_count_runs(by, first, last, gap), kind), "runs")
    parts = save(table.groupBy(*by, PART).agg(F.max(last).alias("_last"), F.max("_run").alias("_n")), "parts")
    upto = Window.partitionBy(*by).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    same = lambda: [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in [*by, PART]]
    reach = small(parts.select(*by, PART, F.max("_last").over(upto).alias("_reach")).where("_reach is not null"))
    undone = table.select(*by, PART, F.col(first).alias("_first"), "_run").alias("a").join(reach.alias("b"), same()).where(F.col("_first") <= F.col("_reach") + gap)
    undone = undone.groupBy(*[F.col(f"a.{c}").alias(c) for c in [*by, PART]]).agg(F.max("_run").alias("_undone"))
    known = parts.alias("a").join(small(undone).alias("b"), same(), "left").select("a.*", F.coalesce("_undone", F.lit(0)).alias("_undone"))
    known = known.select(*by, PART, "_undone", F.sum(F.coalesce("_n", F.lit(0)) - F.col("_undone")).over(upto).alias("_before")).where("_before is not null")
    joined = table.alias("a").join(small(save(known, "parts")).alias("b"), same(), "left")
    number = F.coalesce("_before", F.lit(0)) + F.greatest(F.col("_run") - F.coalesce("_undone", F.lit(0)), F.lit(0))
    return joined.select(*[F.col(f"a.{c}") for c in rows.columns], F.when(F.col("_run").isNotNull(), number).cast("long").alias(name))


def _count_runs(by: list[str], first: str, last: str, gap: int):
    """Adds _run to sorted batches: how many runs of the row's group have begun in the partition; null for a row without ``first`` behind others."""
    low = np.iinfo(np.int64).min // 2

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, reach, begun = None, low, 0  # of the last row: its group, the largest last and the runs of it
        for part in batches:
            n = part.num_rows
            if not n:
                continue
            new = np.zeros(n, bool)
            for c in by:
                codes = part[c].dictionary_encode("encode").indices.to_numpy(zero_copy_only=False)
                new[1:] |= codes[1:] != codes[:-1]
            here = [tuple(part[c][i].as_py() for c in by) for i in (0, n - 1)]
            if here[0] != key:
                reach, begun = low, 0
            group = np.concatenate([[0], np.cumsum(new)])  # a row for what came before stands first
            begin, end = (part[c].cast(pa.int64()).fill_null(low).to_numpy() for c in (first, last))
            far = pd.Series(np.concatenate([[reach], end])).groupby(group).cummax().to_numpy()
            before = np.where(new, low, far[:-1])
            opened = np.where(before == low, True, (begin != low) & (begin > before + gap))
            total = pd.Series(np.concatenate([[begun], opened.astype(np.int64)])).groupby(group).cumsum().to_numpy()
            key, reach, begun = here[1], far[-1], total[-1]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(total[1:], mask=(begin == low) & (before != low))], names=[*part.schema.names, "_run"])

    return count


def components(edges: DataFrame, by: list[str]) -> DataFrame:
    """``edges`` (by, u, v: numbers) → by, node, component: the smallest node that is reachable in the group; only nodes that are a ``u`` count.

    In turn the larger and the smaller neighbours of a node are turned to its smallest one, until every component is a star. Nodes are
    joined and summed only, no component is gathered.
    """
    nodes = save(edges.select(*by, "u", "v"), "edges")
    own = nodes.select(*by, F.col("u").alias("v")).distinct()
    now, mark = nodes.where("u <> v").join(own.hint("merge"), [*by, "v"], "left_semi").select(*by, "u", "v"), None
    while True:
        both = now.unionByName(now.select(*by, F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(*by, "u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least.hint("merge"), [*by, "u"]).where("v > u").select(*by, F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy(*by, "u").agg(F.min("v").alias("m"))
        turned = large.join(least.hint("merge"), [*by, "u"]).where("v <> m").select(*by, F.col("v").alias("u"), F.col("m").alias("v"))
        now = save(turned.unionByName(least.select(*by, "u", F.col("m").alias("v"))).where("u <> v").distinct(), "stars")
        seen = tuple(now.agg(F.count("*"), F.sum(F.xxhash64(*by, "u", "v").cast("decimal(38,0)"))).first())
        if seen == mark:
            break
        mark = seen
    stars = now.select(*by, F.col("u").alias("node"), F.col("v").alias("component"))
    return own.withColumnRenamed("v", "node").join(stars.hint("merge"), [*by, "node"], "left").withColumn("component", F.coalesce("component", "node"))
