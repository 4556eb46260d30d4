"""CIGAR strings as column expressions. Positions are 1-based, ranges are closed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_RANGES = "array<struct<first:bigint,second:bigint>>"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def cigar_split(cigar: Column | str) -> Column:
    """Array of (len, op); null for a null string, empty for ``*``."""
    c = _c(cigar)
    part = lambda i: F.regexp_extract_all(c, F.lit("([0-9]+)([MIDNSHP=X])"), F.lit(i))
    return F.zip_with(part(1), part(2), lambda n, op: F.struct(n.cast("long").alias("len"), op.alias("op")))


def _blocks(cigar: Column | str, start: Column, extend: tuple, close: tuple, skip: tuple) -> Column:
    """Fold over the operations: ``extend`` lengthens the block, ``close`` ends it, ``skip`` ends it and moves on."""
    zero = F.struct(start.cast("long").alias("first"), start.cast("long").alias("at"), F.array().cast(_RANGES).alias("out"))

    def step(s: Column, x: Column) -> Column:
        ended = F.when(s["first"] != s["at"], F.concat(s["out"], F.array(F.struct(s["first"].alias("first"), (s["at"] - 1).alias("second"))))).otherwise(s["out"])
        grown = F.struct(s["first"].alias("first"), (s["at"] + x["len"]).alias("at"), s["out"].alias("out"))
        closed = F.struct(s["at"].alias("first"), s["at"].alias("at"), ended.alias("out"))
        moved = F.struct((s["at"] + x["len"]).alias("first"), (s["at"] + x["len"]).alias("at"), ended.alias("out"))
        return F.when(x["op"].isin(*extend), grown).when(x["op"].isin(*close), closed).when(x["op"].isin(*skip), moved).otherwise(s)

    return F.aggregate(cigar_split(cigar), zero, step, lambda s: F.when(s["first"] != s["at"], F.concat(s["out"], F.array(F.struct(s["first"].alias("first"), (s["at"] - 1).alias("second"))))).otherwise(s["out"]))


def cigar_global_regions(cigar: Column | str, pos: Column | str) -> Column:
    """Blocks on the reference: M, D, = and X extend; I, S and H end a block; N ends it and skips; P does nothing."""
    return _blocks(cigar, _c(pos), ("M", "D", "=", "X"), ("I", "S", "H"), ("N",))


def cigar_local_regions(cigar: Column | str) -> Column:
    """Blocks on the read: M, = and X extend; I, S and H end a block and skip; D, N and P do nothing."""
    return _blocks(cigar, F.lit(1), ("M", "=", "X"), ("-",), ("I", "S", "H"))


def cigar_join(parts: Column) -> Column:
    return F.array_join(F.transform(parts, lambda x: F.concat(x["len"].cast("string"), x["op"])), "")


def cigar_reverse(cigar: Column | str) -> Column:
    return cigar_join(F.reverse(cigar_split(cigar)))


def _clip(parts: Column, at: int) -> Column:
    end = F.try_element_at(parts, F.lit(at))
    return F.when(end["op"] == "S", end["len"]).otherwise(F.lit(0).cast("long"))


def cigar_max_softclip(cigar: Column | str) -> Column:
    """Length of the longer soft clip at an end."""
    parts = cigar_split(cigar)
    return F.greatest(_clip(parts, 1), _clip(parts, -1))


def cigar_match_pattern(cigar: Column | str) -> Column:
    """TOTAL without end clips, RIGHT or LEFT for the side that matches, CENTER for two equal clips."""
    parts = cigar_split(cigar)
    left, right = _clip(parts, 1), _clip(parts, -1)
    return F.when((left == 0) & (right == 0), "TOTAL").when(left == right, "CENTER").when(left > right, "RIGHT").otherwise("LEFT")


def cigar_match(cigar: Column | str) -> Column:
    """The string without its soft clips at both ends."""
    return F.regexp_replace(F.regexp_replace(_c(cigar), r"^\d+S", ""), r"\d+S$", "")


def cigar_region(cigar: Column | str, first: Column | int, second: Column | int) -> Column:
    """The part of the string that covers read places first..second. D and P stay where the cursor is inside; N goes."""
    lo, hi = (F.lit(x).cast("long") if isinstance(x, int) else x.cast("long") for x in (first, second))
    zero = F.struct(F.lit(1).cast("long").alias("at"), F.lit("").alias("out"))

    def step(s: Column, x: Column) -> Column:
        inside = (s["at"] >= lo) & (s["at"] <= hi)
        past = s["at"] + x["len"]
        over = F.least(hi, past - 1) - F.greatest(lo, s["at"]) + 1
        gap = F.struct(s["at"].alias("at"), F.when(inside & (x["op"] != "N"), F.concat(s["out"], x["len"].cast("string"), x["op"])).otherwise(s["out"]).alias("out"))
        real = F.struct(past.alias("at"), F.when(over > 0, F.concat(s["out"], over.cast("string"), x["op"])).otherwise(s["out"]).alias("out"))
        return F.when(x["op"].isin("D", "N", "P"), gap).otherwise(real)

    return F.aggregate(cigar_split(cigar), zero, step, lambda s: s["out"])


def cigar_trim_deletions(cigar: Column | str, side: str) -> Column:
    """Struct (cigar, removed): a deletion at the ``left`` or ``right`` end taken off, and its length."""
    pattern = {"left": r"^(\d+)D", "right": r"(\d+)D$"}[side]
    c = _c(cigar)
    return F.struct(F.regexp_replace(c, pattern, "").alias("cigar"), F.coalesce(F.when(F.rlike(c, F.lit(pattern)), F.regexp_extract(c, pattern, 1).cast("long")), F.lit(0).cast("long")).alias("removed"))


def sam_tag(tags: Column | str, name: str) -> Column:
    """Value of a tag of the tag map, null where it is absent."""
    return F.try_element_at(_c(tags), F.lit(name))
