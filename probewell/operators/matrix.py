"""Contact matrices as coordinate tables (contig, strand, x, y, value). Absent cells are 0; places are 1-based."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import scan
from .pileup import shuffled, small

KEY = ["contig", "strand"]


#: Side of the squares in which cells are packed.
SIDE = 16


def contact_blocks(hangs: DataFrame, lengths: DataFrame | None = None) -> DataFrame:
    """``contact_matrix`` in squares of ``SIDE`` places: contig, strand, bx, by (from 0), at (array of short: row * SIDE + column in the square),
    value (array of the cells' values).

    Equal hangs are counted first; the rectangle of a hang is cut at the borders of squares, and these pieces are shuffled, not
    cells. A square of one piece is laid out as it is; in another one each cell sums the pieces over it.
    """
    arms = ["start_1", "end_1", "start_2", "end_2"]
    same = hangs.where("chr_1 = chr_2 and strand_1 = strand_2").groupBy(F.col("chr_1").alias("contig"), F.col("strand_1").alias("strand"), *arms).agg(F.count("*").alias("n"))
    if lengths is not None:
        same = same.join(small(lengths.select("contig", "length")), "contig").where("end_1 <= length and end_2 <= length")
    box = lambda i, j: F.struct(*[(F.col(f"{e}_{k}") - 1).alias(f"{n}{m}") for k, n in ((i, "x"), (j, "y")) for e, m in (("start", 0), ("end", 1))])
    both = same.select(*KEY, F.inline(F.array(box(1, 2), box(2, 1))), "n")
    squares = lambda c: F.explode(F.sequence(F.floor(F.col(f"{c}0") / SIDE), F.floor(F.col(f"{c}1") / SIDE)))
    cut = both.withColumn("bx", squares("x")).withColumn("by", squares("y"))
    inside = [e.cast("short").alias(f"{c}{k}") for c in "xy" for k, e in ((0, F.greatest(F.col(f"{c}0") - F.col(f"b{c}") * SIDE, F.lit(0))), (1, F.least(F.col(f"{c}1") - F.col(f"b{c}") * SIDE, F.lit(SIDE - 1))))]
    square, piece = [*KEY, "bx", "by"], ["x0", "x1", "y0", "y1"]
    pieces = cut.select(*square, *inside, "n").repartition(*square).groupBy(*square, *piece).agg(F.sum("n").alias("n"))
    packed = pieces.groupBy(*square).agg(F.collect_list(F.struct(*piece, "n")).alias("p"))
    one = F.col("p")[0]
    single = F.flatten(F.transform(F.sequence(one["x0"], one["x1"]), lambda x: F.transform(F.sequence(one["y0"], one["y1"]), lambda y: (x * SIDE + y).cast("short"))))
    over = lambda i, q: (q["x0"] <= F.floor(i / SIDE)) & (F.floor(i / SIDE) <= q["x1"]) & (q["y0"] <= i % SIDE) & (i % SIDE <= q["y1"])
    every = F.filter(F.transform(F.sequence(F.lit(0), F.lit(SIDE * SIDE - 1)), lambda i: i.cast("short")), lambda i: F.exists("p", lambda q: over(i, q)))
    laid = packed.select(*square, "p", F.when(F.size("p") == 1, single).otherwise(every).alias("at"))
    summed = F.transform("at", lambda i: F.aggregate("p", F.lit(0.0), lambda s, q: s + F.when(over(i, q), q["n"]).otherwise(0)))
    value = F.when(F.size("p") == 1, F.transform("at", lambda i: one["n"].cast("double"))).otherwise(summed)
    return laid.select(*square, "at", value.alias("value"))


def contact_matrix(hangs: DataFrame, lengths: DataFrame | None = None) -> DataFrame:
    """Cells (x, y) of arm 1 times arm 2 of every hang on one contig and strand, both triangles."""
    return cells(contact_blocks(hangs, lengths))


def cells(packed: DataFrame) -> DataFrame:
    """The cells of packed squares."""
    rows = packed.select(*KEY, "bx", "by", F.inline(F.arrays_zip("at", "value")))
    return rows.select(*KEY, _place("bx", F.floor(F.col("at") / SIDE)).alias("x"), _place("by", F.col("at") % SIDE).alias("y"), "value")


def _place(square: str, inside: Column) -> Column:
    return (F.col(square) * SIDE + inside + 1).cast("long")


def blocks(coo: DataFrame) -> DataFrame:
    """Cells in packed squares, as ``contact_blocks`` gives them; packed ones stay."""
    if "at" in coo.columns:
        return coo
    square = [F.floor((F.col(c) - 1) / SIDE) for c in "xy"]
    at = ((F.col("x") - 1 - square[0] * SIDE) * SIDE + F.col("y") - 1 - square[1] * SIDE).cast("short")
    packed = coo.groupBy(*KEY, square[0].alias("bx"), square[1].alias("by")).agg(F.collect_list(F.struct(at.alias("at"), "value")).alias("c"))
    return packed.select(*KEY, "bx", "by", F.col("c.at").alias("at"), F.col("c.value").alias("value"))


def _looked_up(coo: DataFrame, table: DataFrame, by: list[str], kind: str = "inner") -> DataFrame:
    """Cells (KEY, x, y, value) with structs vx and vy: the other columns of ``table`` (by, x; a place once) at their row and column.

    Squares meet stretches of the table, so that no cell is shuffled.
    """
    values = F.struct(*[c for c in table.columns if c not in (*by, "x")])
    keyed = table.select(*by, F.floor((F.col("x") - 1) / SIDE).alias("b"), ((F.col("x") - 1) % SIDE).cast("int").alias("i"), values.alias("v"))
    runs = keyed.groupBy(*by, "b").agg(F.map_from_entries(F.collect_list(F.struct("i", "v"))).alias("m"))
    runs = scan.save(runs.select(*by, "b", F.transform(F.sequence(F.lit(0), F.lit(SIDE - 1)), lambda i: F.try_element_at("m", i)).alias("s")), "stretches")
    rows = blocks(coo)
    for c in "xy":
        rows = rows.join(shuffled(runs.withColumnsRenamed({"b": f"b{c}", "s": f"s{c}"})), [*by, f"b{c}"], kind)
    spread = rows.select(*KEY, "bx", "by", "sx", "sy", F.inline(F.arrays_zip("at", "value")))
    row, column = F.floor(F.col("at") / SIDE), F.col("at") % SIDE
    return spread.select(*KEY, _place("bx", row).alias("x"), _place("by", column).alias("y"), "value", F.get("sx", row.cast("int")).alias("vx"), F.get("sy", column.cast("int")).alias("vy"))


def _unpacked(coo: DataFrame) -> DataFrame:
    return cells(coo) if "at" in coo.columns else coo


def matrix_compress(coo: DataFrame, size: DataFrame, bins: int = 40, feature: str = "max") -> DataFrame:
    """n bins a side by max, min, mean or sum of the cells of each; absent cells count as 0. ``size``: (contig, length)."""
    rows = coo.join(small(size.select("contig", "length")), "contig")
    at = lambda c: F.floor((F.col(c) - 1) * bins / F.col("length")) + 1
    grouped = rows.withColumn("bx", at("x")).withColumn("by", at("y")).groupBy(*KEY, "length", "bx", "by").agg(F.max("value").alias("mx"), F.min("value").alias("mn"), F.sum("value").alias("s"), F.count("*").alias("n"))
    width = lambda b: F.ceil(F.col(b) * F.col("length") / bins) - F.ceil((F.col(b) - 1) * F.col("length") / bins)
    area = width("bx") * width("by")
    full = F.col("n") >= area
    value = {"max": F.when(full, F.col("mx")).otherwise(F.greatest("mx", F.lit(0.0))), "min": F.when(full, F.col("mn")).otherwise(F.least("mn", F.lit(0.0))), "mean": F.col("s") / area, "sum": F.col("s")}[feature]
    return grouped.select(*KEY, F.col("bx").alias("x"), F.col("by").alias("y"), value.alias("value"))


def background_estimate(coo: DataFrame, size: DataFrame, around: int = 5) -> DataFrame:
    """value / (sqrt(bg_x * bg_y) * sqrt(avg_x * avg_y)): bg is the sum of the rows around over the row's own, avg the row's mean over all
    places of the contig (``size``: contig, length); row, bg and avg are at least 1 each.

    The rows around come from each row's sum, sent to the places it is around of, so that no task holds a contig. ``coo`` may be packed.
    """
    own = _unpacked(coo).groupBy(*KEY, "x").agg(F.sum("value").alias("s"))
    sent = own.select(*KEY, "x", F.col("s").alias("own"), F.explode(F.sequence(F.col("x") - around, F.col("x") + around)).alias("at"))
    # absent rows are 0: they add nothing, and nothing is asked of them
    sums = sent.groupBy(*KEY, F.col("at").alias("x")).agg(F.sum("own").alias("around"), F.max(F.when(F.col("x") == F.col("at"), F.col("own"))).alias("s")).where("s is not null")
    rows = sums.join(small(size.select("contig", "length")), "contig").select(*KEY, "x", F.greatest(F.col("s") / F.col("length"), F.lit(1.0)).alias("avg"), F.greatest(F.col("around") / F.greatest("s", F.lit(1.0)), F.lit(1.0)).alias("bg"))
    x, y = F.col("vx"), F.col("vy")
    joined = _looked_up(coo, rows, KEY).where("vx is not null and vy is not null")
    return joined.select(*KEY, "x", "y", (F.col("value") / (F.sqrt(x["bg"] * y["bg"]) * F.sqrt(x["avg"] * y["avg"]))).alias("value"))


def background_quantile(coo: DataFrame, size: DataFrame, ratio: float = 0.6) -> DataFrame:
    """value less the row quantiles of x and y (zeros counted), at least 0; cells that come to 0 go.

    Equal values of a row are counted first, so a window holds the distinct values of a row. ``coo`` may be packed.
    """
    counted = _unpacked(coo).groupBy(*KEY, "x", "value").agg(F.count("*").alias("c")).join(small(size.select("contig", "length")), "contig")
    upto = F.sum("c").over(Window.partitionBy(*KEY, "x").orderBy(F.desc("value")).rowsBetween(Window.unboundedPreceding, 0))
    # ascending rank floor(ratio * n) of n cells, the present ones at the top
    wanted = F.col("length") - F.floor(F.lit(ratio) * F.col("length"))
    ranked = counted.withColumn("r", upto)
    q = ranked.groupBy(*KEY, "x").agg(F.coalesce(F.max(F.when((F.col("r") - F.col("c") < wanted) & (wanted <= F.col("r")), F.col("value"))), F.lit(0.0)).alias("q"))
    joined = _looked_up(coo, q, KEY).where("vx is not null and vy is not null")
    return joined.select(*KEY, "x", "y", (F.col("value") - F.col("vx.q") - F.col("vy.q")).alias("value")).where("value > 0")


def _picked(coo: DataFrame, places, least: int, what: str) -> tuple[list[int], list[float]]:
    """The 0-based ascending ranks ``places(n)`` of the n values, and the values there. Equal values are counted before they are sorted."""
    counted = scan.save(coo.groupBy(F.col("value").alias("v")).agg(F.count("*").alias("c")), "values")
    n = counted.agg(F.sum("c")).first()[0] or 0
    if n < least:
        raise ValueError(f"a matrix of fewer than {least} {what}")
    at = places(n)
    rows = scan.ranks(counted, [], F.col("v").asc())
    hit = F.explode(F.array(*[F.lit(k).cast("long") for k in sorted(set(at))]))
    found = rows.select("v", "c", "r", hit.alias("k")).where("r <= k and k < r + c").select("k", "v").collect()  # one row for each rank
    known = {r.k: float(r.v) for r in found}
    return at, [known[k] for k in at]


def matrix_quantiles(coo: DataFrame, parts: int = 20) -> DataFrame:
    """quantile (0..parts), value: of the values over 0 the one at rank floor(n * k / parts), and the largest for the last; under 30 is an error."""
    _, values = _picked(coo.where("value > 0"), lambda n: [min(int(k / parts * n), n - 1) for k in range(parts)] + [n - 1], 30, "cells over 0 has no quantiles")
    return coo.sparkSession.createDataFrame(list(enumerate(values)), "quantile int, value double")


def matrix_normalize(coo: DataFrame, lower: float = 0.01, upper: float = 0.5, min_value: float = 0.0) -> DataFrame:
    """0..1 between the values at two ratios of the ranks above ``min_value``: 1 above, null below; under 40 values is an error."""
    coo = scan.save(coo, "matrix")  # read for the ranks and for the result
    _, (lo, hi) = _picked(coo.where(F.col("value") > min_value), lambda n: [min(int(n * r), n - 1) for r in (lower, upper)], 40, "cells is not normalised")
    v = F.col("value")
    return coo.withColumn("value", F.when(v > hi, 1.0).when(v <= lo, None).otherwise((v - lo) / (hi - lo)))


def matrix_submatrix(coo: DataFrame, x0: int, x1: int, y0: int, y1: int) -> DataFrame:
    return coo.where(F.col("x").between(x0, x1) & F.col("y").between(y0, y1)).withColumn("x", F.col("x") - x0 + 1).withColumn("y", F.col("y") - y0 + 1)


def matrix_mask_noncanonical(coo: DataFrame, seqs: DataFrame, tile: int = 1 << 14) -> DataFrame:
    """Cells whose bases are not AU, GC or GU get null. ``seqs``: (contig, seq), cut into tiles and these into letters; ``coo`` may be packed."""
    base = F.translate(F.upper("c"), "T", "U")
    table = _tiles(seqs.where("seq <> ''"), "seq", tile).select("contig", "_t", F.posexplode(F.split("_s", "")).alias("i", "c")).where("c <> ''")
    places = table.select("contig", (F.col("_t") * tile + F.col("i") + 1).alias("x"), base.alias("base"))
    rows = _looked_up(coo, places, ["contig"], "left")
    two = F.concat("vx.base", "vy.base")
    return rows.select(*KEY, "x", "y", F.when(two.isin("AU", "UA", "GC", "CG", "GU", "UG"), F.col("value")).alias("value"))


def _tiles(rows: DataFrame, text: str, tile: int) -> DataFrame:
    """rows with _t and _s, the tiles of a text in place of it, dealt over the tasks."""
    rest = [c for c in rows.columns if c != text]
    cut = rows.select(*rest, text, F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.length(text) - 1) / tile))).alias("_t"))
    return cut.select(*rest, "_t", F.substring(text, (F.col("_t") * tile + 1).cast("int"), F.lit(tile)).alias("_s")).repartition(*rest, "_t")


def call_interactions(coo: DataFrame, size: DataFrame, min_dist: int = 100, min_win: int = 50, max_win: int = 200, perceive: float = 100.0, extend: float = 20.0) -> DataFrame:
    """contig, strand, x0, x1, y0, y1, score, x_max, y_max: boxes around peaks of the matrix, x0..x1 before y0..y1, and their largest cell.

    Only cells with y - x of at least ``min_win`` + ``min_dist`` count. Windows on a grid of ``min_win`` (its corners that far apart, too) are looked
    through by rising y, then x. One with a cell of at least ``perceive`` is a call: a window is centred on its largest cell (of equals
    the one with the smallest y, then x), and again on the largest cell there, until that stays. Its sides then grow one
    after another, a base at a time, while the outermost line holds a cell whose whole part is at least ``extend``, the side is
    under ``max_win`` and the box ends ``min_dist`` before it begins in y. The cells of the box are used up, and the scan goes on.

    Each call begins and ends in cells of ``perceive``, and takes or looks at others under a side away from these only. So only what lies near
    such cells is laid out, and calls that may have to do with each other are worked off together (``_pieces``). ``coo`` may be packed.
    """
    if min(perceive, extend) <= 0:
        raise ValueError("thresholds must be positive")
    rows = _pieces(coo, min_win + min_dist, max(min_win, max_win), perceive, min(perceive, extend)).join(small(size.select("contig", "length")), "contig")

    def calls(pdf: pd.DataFrame) -> pd.DataFrame:
        cells = dict(zip(zip(pdf["y"].astype(int) - 1, pdf["x"].astype(int) - 1, strict=True), pdf["value"].astype(float), strict=True))
        found = Peaks(cells, int(pdf["length"].iloc[0]), min_dist, min_win, max_win, perceive, extend).scan()
        frame = pd.DataFrame(found, columns=["x0", "x1", "y0", "y1", "score", "x_max", "y_max"])
        frame.insert(0, "contig", pdf["contig"].iloc[0])
        frame.insert(1, "strand", pdf["strand"].iloc[0])
        return frame

    schema = "contig string, strand string, x0 long, x1 long, y0 long, y1 long, score double, x_max long, y_max long"
    return rows.groupBy(*KEY, "piece").applyInPandas(calls, schema)


def _pieces(coo: DataFrame, apart: int, reach: int, perceive: float, floor: float) -> DataFrame:
    """contig, strand, piece, x, y, value: the cells of at least ``floor`` with y - x >= ``apart`` that a call may look at.

    A call holds or looks at cells less than ``reach`` away from one of ``perceive`` in both coordinates, so two calls whose cells of
    ``perceive`` are twice that apart have nothing to do with each other. Bins of that side (whole squares) with such a cell are joined to pieces
    where at most one bin lies between them; a piece has its bins and those around them.
    """
    across = -(-reach // SIDE)  # squares in a side of a bin
    packed = "at" in coo.columns
    wanted = (F.col("y") - F.col("x") >= apart) & (F.col("value") >= floor)
    if packed:
        coo = coo.where((F.col("by") - F.col("bx") + 1) * SIDE > apart).where(F.array_max("value") >= floor)
        coo = coo.withColumns({g: F.floor(F.col(b) / across) for g, b in (("gx", "bx"), ("gy", "by"))})
        high = cells(coo.where(F.array_max("value") >= perceive))
    else:
        coo = high = coo.where(wanted)
    at = {g: F.floor((F.col(c) - 1) / (SIDE * across)) for g, c in (("gx", "x"), ("gy", "y"))}
    bins = scan.save(high.where(wanted & (F.col("value") >= perceive)).select(*KEY, *[c.alias(g) for g, c in at.items()]).distinct(), "bins")
    named = scan.components(_near(bins, 2).select(*KEY, _bin("gx", "gy").alias("u"), _bin("nx", "ny").alias("v")), KEY)
    around = _near(bins, 1).select(*KEY, _bin("gx", "gy").alias("node"), "nx", "ny").join(shuffled(named), [*KEY, "node"])
    zone = scan.save(around.select(*KEY, F.col("nx").alias("gx"), F.col("ny").alias("gy"), F.col("component").alias("piece")).distinct(), "zone")
    if packed:
        rows = coo.join(small(zone), [*KEY, "gx", "gy"]).select(*KEY, "piece", "bx", "by", F.inline(F.arrays_zip("at", "value")))
        rows = rows.select(*KEY, "piece", _place("bx", F.floor(F.col("at") / SIDE)).alias("x"), _place("by", F.col("at") % SIDE).alias("y"), "value").where(wanted)
    else:
        rows = coo.withColumns(at).join(small(zone), [*KEY, "gx", "gy"])
    return rows.select(*KEY, "piece", "x", "y", "value")


def _near(bins: DataFrame, k: int) -> DataFrame:
    """Each bin (gx, gy) with the places (nx, ny) up to ``k`` bins away, its own among them."""
    steps = F.array(*[F.lit(i).cast("long") for i in range(-k, k + 1)])
    return bins.withColumn("nx", F.explode(F.transform(steps, lambda i: F.col("gx") + i))).withColumn("ny", F.explode(F.transform(steps, lambda i: F.col("gy") + i)))


def _bin(x: str, y: str) -> Column:
    """One number for a bin; those before the first are negative, so they are counted from 1,024."""
    return F.shiftleft(F.col(x) + 1024, 31) + F.col(y) + 1024


class Peaks:
    """The cells of one island, 0-based and keyed by (y, x), in bins of the window size; and in the bins' rows and columns, for lines."""

    def __init__(self, cells: dict[tuple[int, int], float], n: int, min_dist: int, min_win: int, max_win: int, perceive: float, extend: float):
        self.cells, self.n, self.dist, self.win, self.most, self.perceive, self.extend = cells, n, min_dist, min_win, max_win, perceive, extend
        self.bins, self.rows, self.columns = ({} for _ in range(3))
        for y, x in cells:
            self.bins.setdefault((y // min_win, x // min_win), set()).add((y, x))
            self.rows.setdefault((y, x // min_win), []).append(x)
            self.columns.setdefault((x, y // min_win), []).append(y)

    def inside(self, y0: int, y1: int, x0: int, x1: int) -> list[tuple[int, int]]:
        """The cells left with y0 <= y < y1 and x0 <= x < x1."""
        w = self.win
        found = (at for b in range(y0 // w, (y1 - 1) // w + 1) for c in range(x0 // w, (x1 - 1) // w + 1) for at in self.bins.get((b, c), ()))
        return [at for at in found if y0 <= at[0] < y1 and x0 <= at[1] < x1]

    def top(self, *box: int) -> tuple[float, tuple[int, int] | None]:
        best = min(((-self.cells[at], at) for at in self.inside(*box)), default=None)
        return (-best[0], best[1]) if best else (0.0, None)

    def line(self, y0: int, y1: int, x0: int, x1: int) -> bool:
        """Whether a line of the box, one row or one column, holds enough for another one."""
        w, left = self.win, self.cells
        if y1 - y0 == 1:
            found = ((y0, x) for b in range(x0 // w, (x1 - 1) // w + 1) for x in self.rows.get((y0, b), ()) if x0 <= x < x1)
        else:
            found = ((y, x0) for b in range(y0 // w, (y1 - 1) // w + 1) for y in self.columns.get((x0, b), ()) if y0 <= y < y1)
        return any(int(left.get(at, 0.0)) >= self.extend for at in found)

    def window(self, at: tuple[int, int]) -> tuple[int, int]:
        return max(at[0] - self.win // 2, 0), max(at[1] - self.win // 2, 0)

    def scan(self) -> list[tuple]:
        out, w = [], self.win
        for b, c in sorted(self.bins):
            if c * w + w + self.dist > b * w:
                continue
            while True:
                value, at = self.top(b * w, (b + 1) * w, c * w, (c + 1) * w)
                if value < self.perceive:
                    break
                out.append(self.call(at))
        return out

    def call(self, at: tuple[int, int]) -> tuple:
        while True:
            y, x = self.window(at)
            _, again = self.top(y, min(y + self.win, self.n), x, min(x + self.win, self.n))
            if again == at:
                break
            at = again
        y, x, tall, wide = self.grown(y, x)
        box = (y, min(y + tall, self.n), x, min(x + wide, self.n))
        value, (my, mx) = self.top(*box)
        for cell in self.inside(*box):
            self.bins[cell[0] // self.win, cell[1] // self.win].discard(cell)
            del self.cells[cell]
        return box[2] + 1, box[3], box[0] + 1, box[1], value, mx + 1, my + 1

    def grown(self, y: int, x: int) -> tuple[int, int, int, int]:
        """Corner and sides of the box once no side can grow: lower y, lower x, upper y and upper x take turns."""
        n, tall, wide = self.n, self.win, self.win
        sides = [True] * 4
        while any(sides):
            for k in range(4):
                if not sides[k]:
                    continue
                far_x, far_y = min(x + wide, n), min(y + tall, n)
                free = x + wide + self.dist < y
                if k == 0 and free and y > 0 and tall < self.most and self.line(y, y + 1, x, far_x):
                    y, tall = y - 1, tall + 1
                elif k == 1 and free and x > 0 and wide < self.most and self.line(y, far_y, x, x + 1):
                    x, wide = x - 1, wide + 1
                elif k == 2 and free and y + tall <= n and tall < self.most and self.line(far_y - 1, far_y, x, far_x):
                    tall += 1
                elif k == 3 and free and wide < self.most and self.line(y, far_y, far_x - 1, far_x):
                    wide += 1
                else:
                    sides[k] = False
        return y, x, tall, wide


def alignment_coords(aln: DataFrame, tile: int = 1 << 14) -> DataFrame:
    """(id, aligned) → id, raw_pos, aln_pos of every base (1-based). Tiles of an alignment tell how many bases stand before the next."""
    tiles = _tiles(aln.select("id", "aligned").where("aligned <> ''"), "aligned", tile)
    letters = F.transform(F.split("_s", ""), lambda c, i: F.when((c != "") & ~c.isin("-", ".", "~"), i))
    places = tiles.select("id", "_t", F.filter(letters, lambda i: i.isNotNull()).alias("at"))
    upto = Window.partitionBy("id").orderBy("_t").rowsBetween(Window.unboundedPreceding, -1)  # a row for each tile
    counted = places.withColumn("_n", F.coalesce(F.sum(F.size("at")).over(upto), F.lit(0)))
    return counted.select("id", "_t", "_n", F.posexplode("at").alias("k", "i")).select("id", (F.col("_n") + F.col("k") + 1).cast("long").alias("raw_pos"), (F.col("_t") * tile + F.col("i") + 1).cast("long").alias("aln_pos"))


def matrix_expand(coo: DataFrame, coords: DataFrame) -> DataFrame:
    """Cells on aligned coordinates; ``contig`` is the id of the sequence. ``coo`` may be packed."""
    places = coords.select(F.col("id").alias("contig"), F.col("raw_pos").alias("x"), "aln_pos")
    rows = _looked_up(coo, places, ["contig"]).where("vx is not null and vy is not null")
    return rows.select(*KEY, F.col("vx.aln_pos").alias("x"), F.col("vy.aln_pos").alias("y"), "value")


def matrix_mask_gaps(coo: DataFrame, coords: DataFrame, width: int | DataFrame, bins: int, ratio: float = 0.25) -> DataFrame:
    """Binned cells get null where a bin has less than ``ratio`` of its places in the sequence. ``width``: the aligned length, one for
    all or a table (contig, length) with that of each contig, by which the cells were binned."""
    named = coords.select(F.col("id").alias("contig"), "aln_pos")
    placed = named.withColumn("length", F.lit(float(width))) if isinstance(width, int) else named.join(small(width.select("contig", F.col("length").cast("double").alias("length"))), "contig")
    at = F.floor((F.col("aln_pos") - 1) * bins / F.col("length")) + 1
    filled = placed.groupBy("contig", at.alias("b")).agg((F.count("*") * bins / F.max("length")).alias("share")).where(F.col("share") >= ratio)
    x, y = (filled.select("contig", F.col("b").alias(c), F.lit(1).alias(f"ok_{c}")) for c in "xy")
    rows = coo.join(x, ["contig", "x"], "left").join(y, ["contig", "y"], "left")
    return rows.select(*KEY, "x", "y", F.when(F.col("ok_x").isNotNull() & F.col("ok_y").isNotNull(), F.col("value")).alias("value"))


def compress_regions(regions: DataFrame, size: DataFrame, bins: int) -> DataFrame:
    """(contig, name, first, second), sorted and disjoint in a contig, scaled to bins of the contig's ``size`` (contig, length).

    Both ends are divided by length / bins and rounded, halves upwards; the first start is at least 1 and the last end at most
    ``bins``. A region that starts in the last bin of the one before starts one later, or goes if it lies in that bin only.
    Overlapping regions are an error.
    """
    order = Window.partitionBy("contig").orderBy("first", "second")  # the domains of one RNA
    rows = regions.join(small(size.select("contig", "length")), "contig")
    step = F.col("length") / F.lit(float(bins))
    at = lambda c: F.floor(F.col(c) / step + 0.5).cast("long")
    disjoint = F.coalesce(F.lag("second").over(order) < F.col("first"), F.lit(True)) & (F.col("first") <= F.col("second"))
    checked = rows.select("contig", "name", "first", "second", F.when(disjoint, at("first")).otherwise(F.raise_error(F.lit("regions overlap")).cast("long")).alias("a"), at("second").alias("b"), F.row_number().over(order).alias("i"), F.lead("first").over(order).isNull().alias("last"))
    ends = checked.withColumn("a", F.when(F.col("i") == 1, F.greatest("a", F.lit(1))).otherwise(F.col("a"))).withColumn("b", F.when(F.col("last"), F.least("b", F.lit(bins))).otherwise(F.col("b")))
    # an erased region ends where the one before it ends, so the one before in the input tells the same as the one that is left
    touch = (F.lag("b").over(order) == F.col("a")).alias("touch")
    kept = ends.select("contig", "name", "a", "b", "i", touch).where("not coalesce(touch, false) or a <> b")
    return kept.select("contig", "name", F.when(F.col("touch"), F.col("a") + 1).otherwise(F.col("a")).alias("first"), F.col("b").alias("second"))
