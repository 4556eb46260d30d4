"""Split alignments of one read: joined to a gapped record, or trimmed to two records that share no base of the read.

All of it is column expressions: a CIGAR becomes an array of operations with the read and reference base where each begins, and a
cut keeps of each operation what lies in a range of the read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.cigar import cigar_max_softclip
from . import scan
from .pileup import shuffled

RECORD = ("flag", "chr_id", "pos", "cigar", "seq", "qual")
_KIND = "array<struct<n:bigint,op:string,at:bigint,ref:bigint>>"


def _alignment(cigar: Column, pos: Column) -> Column:
    """ops (n, op, first read base, first reference base), left and right clip, read bases in all, last reference base, side.

    The side is where the match lies in the direction of the reference: TOTAL without clips, CENTER between equal ones, RIGHT behind
    the longer clip, else LEFT. No operations: null.
    """
    text = F.coalesce(cigar, F.lit(""))
    n, op = (F.regexp_extract_all(text, F.lit(r"(\d+)([MIDNSHP=X])"), F.lit(k)) for k in (1, 2))
    pairs = F.zip_with(n, op, lambda x, y: F.struct(x.cast("long").alias("n"), y.alias("op")))

    def step(s: Column, x: Column) -> Column:
        one = F.struct(x["n"].alias("n"), x["op"].alias("op"), s["at"].alias("at"), s["ref"].alias("ref"))
        return F.struct(F.concat(s["ops"], F.array(one)).alias("ops"), (s["at"] + F.when(x["op"].isin(*"MIS=X"), x["n"]).otherwise(0)).alias("at"), (s["ref"] + F.when(x["op"].isin(*"MDN=X"), x["n"]).otherwise(0)).alias("ref"))

    start = F.struct(F.expr(f"cast(array() as {_KIND})").alias("ops"), F.lit(1).cast("long").alias("at"), pos.cast("long").alias("ref"))

    def finish(s: Column) -> Column:
        head, tail = F.get(s["ops"], F.lit(0)), F.element_at(s["ops"], -1)
        left = F.when(head["op"] == "S", head["n"]).otherwise(0)
        right = F.when((F.size(s["ops"]) > 1) & (tail["op"] == "S"), tail["n"]).otherwise(0)
        side = F.when((left == 0) & (right == 0), "TOTAL").when(left == right, "CENTER").when(left > right, "RIGHT").otherwise("LEFT")
        return F.when(F.size(s["ops"]) > 0, F.struct(s["ops"].alias("ops"), left.alias("left"), right.alias("right"), (s["at"] - 1).alias("total"), (s["ref"] - 1).alias("last"), side.alias("side")))

    return F.aggregate(pairs, start, step, finish)


def _side(x: Column, flag: Column) -> Column:
    """The side on the read itself: a reversed record is mirrored."""
    rev = flag.bitwiseAND(16) != 0
    return F.when(rev & (x["side"] == "LEFT"), "RIGHT").when(rev & (x["side"] == "RIGHT"), "LEFT").otherwise(x["side"])


def _cut(ops: Column, pos: Column, first: Column, second: Column) -> Column:
    """The operations on read bases first..second as text, with their first and last reference base."""

    def part(o: Column) -> Column:
        on_read = o["op"].isin("M", "I", "=", "X")
        lo, hi = F.greatest(o["at"], first), F.least(o["at"] + o["n"] - 1, second)
        # a gap stays if the bases before and behind it do
        n = F.when(on_read, F.greatest(hi - lo + 1, F.lit(0))).when(o["op"].isin("D", "N") & (first < o["at"]) & (o["at"] <= second), o["n"]).otherwise(0)
        on_both = on_read & (o["op"] != "I") & (lo <= hi)
        return F.struct(n.alias("n"), o["op"].alias("op"), F.when(on_both, o["ref"] + lo - o["at"]).alias("first"), F.when(on_both, o["ref"] + hi - o["at"]).alias("last"))

    kept = F.filter(F.transform(ops, part), lambda o: o["n"] > 0)
    text = F.array_join(F.transform(kept, lambda o: F.concat(o["n"].cast("string"), o["op"])), "")
    return F.struct(text.alias("cigar"), F.coalesce(F.array_min(F.transform(kept, lambda o: o["first"])), pos).alias("first"), F.coalesce(F.array_max(F.transform(kept, lambda o: o["last"])), pos - 1).alias("last"))


def _bound(value: Column, then) -> Column:
    """``then(value)`` with the value bound once: what is built on it names it instead of repeating it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _fields(**columns: Column) -> Column:
    return F.struct(*[c.alias(n) for n, c in columns.items()])


def _facts(s: str = "") -> Column:
    """What a pair needs to know of the alignment of record ``s``: its operations, side and span on the read."""
    flag, pos = F.col(f"flag{s}"), F.col(f"pos{s}").cast("long")

    def known(x: Column) -> Column:
        rev = flag.bitwiseAND(16) != 0
        left, right, total = x["left"], x["right"], x["total"]
        return _fields(
            rev=rev, ops=x["ops"], total=total, last=x["last"], side=_side(x, flag), many=x.isNull() | F.exists(x["ops"], lambda o: o["op"] == "N"), mapped=flag.bitwiseAND(4) == 0,
            start=F.when(rev, right + 1).otherwise(left + 1), end=F.when(rev, total - left).otherwise(total - right),
        )

    return _bound(_alignment(F.col(f"cigar{s}"), pos), known)


_KNOWN = ("rev", "ops", "total", "last", "side", "many", "mapped", "start", "end")


def _record(s: str, known: bool) -> Column:
    """The facts of record ``s`` (worked out before, if ``known``), its place and texts."""
    texts = {c: F.coalesce(F.col(f"{c}_{s}"), F.lit("")) for c in ("seq", "qual")}
    whole = lambda x: _fields(**{c: x[c] for c in _KNOWN}, chr=F.col(f"chr_id_{s}"), pos=F.col(f"pos_{s}").cast("long"), **texts)
    return _bound(F.col(f"_x_{s}") if known else _facts(f"_{s}"), whole)


def _paired(pairs: DataFrame, need_group: bool) -> DataFrame:
    """pairs with _p: status, and for a good pair ab, at and the arms a and b (cigar, first, last, seq, qual), in the direction of the reference."""

    def shared(p: Column) -> Column:
        a, b = p["a"], p["b"]
        a_first = a["side"] == "LEFT"
        end, start = F.when(a_first, a["end"]).otherwise(b["end"]), F.when(a_first, b["start"]).otherwise(a["start"])
        return _fields(a=a, b=b, a_first=a_first, ab=F.greatest(end - start + 1, F.lit(0)))

    def span(x: Column, first: Column, ab: Column) -> Column:
        """What only this record uses of the read, in the direction of the reference."""
        lo, hi = x["start"] + F.when(first, 0).otherwise(ab), x["end"] - F.when(first, ab).otherwise(0)
        return _fields(lo=F.when(x["rev"], x["total"] - hi + 1).otherwise(lo), hi=F.when(x["rev"], x["total"] - lo + 1).otherwise(hi))

    def judged(p: Column) -> Column:
        a, b = p["a"], p["b"]
        sided = a["side"].isin("LEFT", "RIGHT") & b["side"].isin("LEFT", "RIGHT") & (a["side"] != b["side"])
        status = F.when(~(a["mapped"] & b["mapped"]), "UNMAPPED")
        if need_group:
            status = status.when(a["rev"] != b["rev"], "DIFF_STRAND").when(a["chr"] != b["chr"], "DIFF_CHR")
        status = status.when(a["many"] | b["many"], "MULTI_MATCH")
        if need_group:
            status = status.when(F.least(a["last"], b["last"]) >= F.greatest(a["pos"], b["pos"]), "OVERLAP")
        status = status.when(~sided, "ABNORMAL_PATTERN").when((a["end"] - a["start"] < p["ab"]) | (b["end"] - b["start"] < p["ab"]), "INVALID_BORDER").otherwise("SUCCESS")
        # the record that lies first on the reference: whether its match is on the left of what was read from the reference's side
        first_left = F.when(a["pos"] <= b["pos"], p["a_first"]).otherwise(~p["a_first"])
        facing = F.when(first_left != (a["rev"] if need_group else F.lit(False)), "CENTER").otherwise("FLANKING")
        return _fields(status=status, at=facing, ab=p["ab"].cast("int"), a=a, b=b, sa=span(a, p["a_first"], p["ab"]), sb=span(b, ~p["a_first"], p["ab"]))

    def arm(x: Column, s: Column) -> Column:
        text = lambda c: F.substring(c, s["lo"].cast("int"), (s["hi"] - s["lo"] + 1).cast("int"))
        return _bound(_cut(x["ops"], x["pos"], s["lo"], s["hi"]), lambda c: _fields(cigar=c["cigar"], first=c["first"], last=c["last"], seq=text(x["seq"]), qual=text(x["qual"])))

    def finished(p: Column) -> Column:
        good = p["status"] == "SUCCESS"
        return _fields(status=p["status"], ab=F.when(good, p["ab"]), at=F.when(good, p["at"]), a=F.when(good, arm(p["a"], p["sa"])), b=F.when(good, arm(p["b"], p["sb"])))

    known = "_x_a" in pairs.columns
    return pairs.withColumn("_p", _bound(_bound(_bound(_fields(a=_record("a", known), b=_record("b", known)), shared), judged), finished))


def _numbers(sam: DataFrame) -> DataFrame:
    """The records with their number n in the read and the facts of their alignment, worked out once and saved: every pair reads them."""
    if "_x" in sam.columns:
        return sam
    numbered = sam.select("read_id", *RECORD, F.row_number().over(Window.partitionBy("read_id").orderBy("flag", "chr_id", "pos", "cigar")).alias("n"))
    return scan.save(numbered.withColumn("_x", _facts()), "alignments")


def read_pairs(sam: DataFrame) -> DataFrame:
    """All pairs of records of each read: read_id, i < j, and the record columns with _a and _b; in _x_a and _x_b the facts of the alignments.

    The self-join is on read_id; a read has as many rows as it has alignments, so pairs grow with its square only.
    """
    numbered, columns = _numbers(sam), (*RECORD, "_x")
    a = numbered.select("read_id", F.col("n").alias("i"), *[F.col(c).alias(f"{c}_a") for c in columns])
    b = numbered.select("read_id", F.col("n").alias("j"), *[F.col(c).alias(f"{c}_b") for c in columns])
    return a.join(shuffled(b), "read_id").where("i < j").select("read_id", "i", "j", *[f"{c}_{s}" for s in "ab" for c in columns])


def _likely_pairs(sam: DataFrame, max_ambiguous: int, same: bool | None) -> DataFrame:
    """``read_pairs`` without those that cannot be good: a mapped record without a gap that matches on the left of the read meets the ones on
    its right, with at most ``max_ambiguous`` common bases.

    ``same``: only pairs on one chromosome and strand (True), or only others (False). Good pairs all have these properties, so a
    read's number of alignments is no bound for its pairs any more, but their sides and places are.
    """
    c, columns = F.col, (*RECORD, "_x")
    known = _numbers(sam).where("not _x.many and _x.mapped")
    side = lambda name, s: known.where(c("_x.side") == name).select("read_id", *[c(x).alias(f"{x}_{s}") for x in ("n", *columns)])
    heads, tails = side("LEFT", "h"), side("RIGHT", "t")
    on = ["read_id"]
    if same:
        heads, tails = (x.withColumn("_chr", c(f"chr_id_{s}")).withColumn("_strand", c(f"_x_{s}.rev")) for x, s in ((heads, "h"), (tails, "t")))
        on = ["read_id", "_chr", "_strand"]
    both = heads.join(shuffled(tails), on).where(c("_x_h.end") - c("_x_t.start") + 1 <= max_ambiguous)
    if same is False:
        both = both.where((c("chr_id_h") != c("chr_id_t")) | (c("_x_h.rev") != c("_x_t.rev")))
    first = c("n_h") < c("n_t")
    pick = lambda x, s: F.when(first, c(f"{x}_{'h' if s == 'a' else 't'}")).otherwise(c(f"{x}_{'t' if s == 'a' else 'h'}"))
    return both.select("read_id", F.least("n_h", "n_t").alias("i"), F.greatest("n_h", "n_t").alias("j"), *[pick(x, s).alias(f"{x}_{s}") for s in "ab" for x in columns])


def _own(pairs: DataFrame) -> list[str]:
    return [c for c in pairs.columns if c not in ("_x_a", "_x_b")]


def group_read_pair(pairs: DataFrame) -> DataFrame:
    """pairs with status (SUCCESS, UNMAPPED, DIFF_STRAND, DIFF_CHR, MULTI_MATCH, OVERLAP, ABNORMAL_PATTERN, INVALID_BORDER)
    and the joined record: pos, cigar with an N, ab (bases that both alignments used; cut from both), at (CENTER, FLANKING),
    gap and arm lengths on the reference."""

    def ordered(p: Column) -> Column:
        turned = p["a"]["first"] > p["b"]["first"]
        return _fields(p=p, x=F.when(turned, p["b"]).otherwise(p["a"]), y=F.when(turned, p["a"]).otherwise(p["b"]))

    def joined(q: Column) -> Column:
        p, x, y = q["p"], q["x"], q["y"]
        good, gap = p["status"] == "SUCCESS", y["first"] - x["last"] - 1
        return _fields(
            status=p["status"], flag=F.when(good, F.when(F.col("flag_a").bitwiseAND(16) != 0, 16).otherwise(0)), chr_id=F.when(good, F.col("chr_id_a")), pos=x["first"], cigar=F.concat(x["cigar"], gap.cast("string"), F.lit("N"), y["cigar"]),
            seq=F.concat(x["seq"], y["seq"]), qual=F.concat(x["qual"], y["qual"]), ab=p["ab"], at=p["at"], gap=gap, arm_1=x["last"] - x["first"] + 1, arm_2=y["last"] - y["first"] + 1,
        )

    return _paired(pairs, True).select(*_own(pairs), F.inline(F.array(_bound(_bound(F.col("_p"), ordered), joined))))


def trim_read_pair(pairs: DataFrame) -> DataFrame:
    """pairs with status and both records cut to the read bases that only they use: t_pos, t_cigar, t_seq, t_qual, arm with _1 and _2."""

    def trimmed(p: Column) -> Column:
        arms = {}
        for k, s in ((1, "a"), (2, "b")):
            x = p[s]
            arms |= {f"t_pos_{k}": x["first"], f"t_cigar_{k}": x["cigar"], f"t_seq_{k}": x["seq"], f"t_qual_{k}": x["qual"], f"arm_{k}": x["last"] - x["first"] + 1}
        return _fields(status=p["status"], ab=p["ab"], **arms)

    return _paired(pairs, False).select(*_own(pairs), F.inline(F.array(_bound(F.col("_p"), trimmed))))


def _numbered(rows: DataFrame) -> DataFrame:
    """read_id with _k, and the number of results of the read as nh."""
    w = Window.partitionBy("read_id")
    return rows.withColumn("nh", F.count("*").over(w)).withColumn("k", F.row_number().over(w.orderBy("i", "j")))


def sam_group(sam: DataFrame, min_overhang: int = 5, min_armlen: int = 10, max_ambiguous: int = 10) -> DataFrame:
    """Gapped records of all pairs that group well: read_id (_k), record columns, ab, at, nh."""
    good = group_read_pair(_likely_pairs(sam, max_ambiguous, True)).where((F.col("status") == "SUCCESS") & (F.col("gap") >= min_overhang) & (F.least("arm_1", "arm_2") >= min_armlen) & (F.col("ab") <= max_ambiguous))
    return _numbered(good).select(F.concat_ws("_", "read_id", "k").alias("read_id"), *RECORD, "ab", "at", "nh")


def sam_trim(sam: DataFrame, min_armlen: int = 10, max_ambiguous: int = 10, max_duplex: int = 1000, remove_antisense: bool = False, remove_groupable: bool = False) -> DataFrame:
    """Two trimmed records for each good pair; reads with more than ``max_duplex`` good pairs are dropped, as their place is unknown."""
    rows = sam.where(F.col("flag").bitwiseAND(16) == 0) if remove_antisense else sam
    pairs = _likely_pairs(rows, max_ambiguous, False if remove_groupable else None)
    good = trim_read_pair(pairs).where((F.col("status") == "SUCCESS") & (F.least("arm_1", "arm_2") >= min_armlen) & (F.col("ab") <= max_ambiguous))
    kept = _numbered(good).where(F.col("nh") <= max_duplex)
    arm = lambda k, s: F.struct(F.col(f"flag_{s}").bitwiseAND(~256).bitwiseOR(0 if k == 1 else 256).alias("flag"), F.col(f"chr_id_{s}").alias("chr_id"), F.col(f"t_pos_{k}").alias("pos"), F.col(f"t_cigar_{k}").alias("cigar"), F.col(f"t_seq_{k}").alias("seq"), F.col(f"t_qual_{k}").alias("qual"))
    return kept.select(F.concat_ws("_", "read_id", "k").alias("read_id"), F.inline(F.array(arm(1, "a"), arm(2, "b"))), "ab", "nh")


def sam_group_trim(sam: DataFrame, max_ungapped_sc: int = 5, min_overhang: int = 5, min_armlen: int = 15, max_ambiguous: int = 10, remove_antisense: bool = False, only_primary: bool = False) -> tuple[DataFrame, DataFrame]:
    """(gapped, ungapped): gapped records as they are, pairs on one chromosome and strand joined, others trimmed; and the
    records of reads without a gap whose longer soft clip is short."""
    rows = sam.where(F.col("flag").bitwiseAND(4) == 0)
    if remove_antisense:
        rows = rows.where(F.col("flag").bitwiseAND(16) == 0)
    if only_primary:
        rows = rows.where(F.col("flag").bitwiseAND(256) == 0)
    has_gap = F.contains("cigar", F.lit("N"))
    as_is = rows.where(has_gap)
    split = rows.join(as_is.select("read_id").distinct(), "read_id", "left_anti")
    none = lambda df: df.select("read_id", *RECORD, F.coalesce("ab", F.lit(0)).alias("ab"))
    known = _numbers(split)  # for both ways
    joined = sam_group(known, min_overhang, min_armlen, max_ambiguous)
    trimmed = sam_trim(known, min_armlen, max_ambiguous, remove_groupable=True)
    gapped = as_is.select("read_id", *RECORD, F.lit(0).alias("ab")).unionByName(none(joined)).unionByName(none(trimmed))
    return gapped, known.where(cigar_max_softclip("cigar") <= max_ungapped_sc).select("read_id", *RECORD)
