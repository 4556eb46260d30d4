"""Filters and counts over alignments (SAM columns) and raw reads (FASTQ columns)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.cigar import sam_tag
from ..functions.sequence import md_mutations, reverse_complement
from .pileup import shuffled, small


def sam_flags(sam: DataFrame) -> DataFrame:
    """sam with is_mapped, is_reverse, is_primary, is_paired, mate_reverse, is_first and is_gapped."""
    bit = lambda n: F.col("flag").bitwiseAND(n) != 0
    return sam.withColumns({"is_mapped": ~bit(4), "is_reverse": bit(16), "is_primary": ~bit(256) & ~bit(2048), "is_paired": bit(1), "mate_reverse": bit(32), "is_first": bit(64), "is_gapped": F.contains("cigar", F.lit("N"))})


def filter_records(sam: DataFrame, drop: tuple = ("unmapped", "secondary")) -> DataFrame:
    """Without records of the named kinds: unmapped, ungapped, gapped, reversed, secondary."""
    bit = lambda n: F.col("flag").bitwiseAND(n) != 0
    gapped = F.contains("cigar", F.lit("N"))
    kinds = {"unmapped": bit(4), "ungapped": ~gapped, "gapped": gapped, "reversed": bit(16), "secondary": bit(256) | bit(2048)}
    if set(drop) - set(kinds):
        raise ValueError(f"drop takes {sorted(kinds)}")
    for k in drop:
        sam = sam.where(~kinds[k])
    return sam


def drop_unannotated_junctions(sam: DataFrame) -> DataFrame:
    """Without reads whose first jM code is 0..6. Reads without the tag stay."""
    code = F.regexp_extract(F.coalesce(sam_tag("tags", "jM"), F.lit("")), r"^(?:B:)?c,(-?\d+)", 1).try_cast("int")
    return sam.where(~F.coalesce(code.between(0, 6), F.lit(False)))


def drop_mut5(sam: DataFrame) -> DataFrame:
    """Without reads whose first sequenced base is a mismatch: MD begins (+) or ends (-) with 0. Reads without MD stay."""
    md = F.coalesce(sam_tag("tags", "MD"), F.lit(""))
    plus = F.col("flag").bitwiseAND(16) == 0
    return sam.where(F.when(plus, ~F.startswith(md, F.lit("0"))).otherwise(~F.rlike(md, F.lit("(^|[^0-9])0$"))))


def sam2fq(sam: DataFrame, quick: bool = False) -> DataFrame:
    """Records as FASTQ (key, seq, tag, qual), turned back to the read's own strand; one for each read id unless quick."""
    rev = F.col("flag").bitwiseAND(16) != 0
    rows = sam.select("read_id", "flag", F.when(rev, reverse_complement("seq")).otherwise(F.col("seq")).alias("seq"), F.when(rev, F.reverse("qual")).otherwise(F.col("qual")).alias("qual"))
    if not quick:
        rows = rows.groupBy("read_id").agg(F.min_by(F.struct("seq", "qual"), F.struct("flag", "seq", "qual")).alias("r")).select("read_id", "r.seq", "r.qual")
    return rows.select(F.concat(F.lit("@"), "read_id").alias("key"), "seq", F.lit("+").alias("tag"), "qual")


def route_alignments(sam: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records with flag 0, reads with flag 4 as FASTQ)."""
    return sam.where("flag = 0"), sam2fq(sam.where("flag = 4"), quick=True)


def simplify_read_name(fastq: DataFrame) -> DataFrame:
    return fastq.withColumn("key", F.split("key", r"\s+")[0]).withColumn("tag", F.lit("+"))


def quality_codes(qual: Column | str) -> Column:
    """Phred scores of a +33 quality string."""
    return F.transform(F.filter(F.split(qual, ""), lambda c: c != ""), lambda c: F.ascii(c) - 33)


def quality_trim(fastq: DataFrame, leading: int = 13, trailing: int = 20, window: int = 4, window_q: int = 15, min_len: int = 25) -> DataFrame:
    """Cut ``leading`` letters, then bad letters at the end, then from the first window whose mean is too low; drop short reads."""

    @F.pandas_udf("int")
    def kept(qual: pd.Series) -> pd.Series:
        return kept_letters(qual, trailing, window, window_q)

    rows = fastq.withColumn("_n", kept(F.substring("qual", leading + 1, 1 << 30)))
    cut = rows.withColumn("seq", F.substring("seq", F.lit(leading + 1), F.col("_n"))).withColumn("qual", F.substring("qual", F.lit(leading + 1), F.col("_n")))
    return cut.where(F.length("seq") >= min_len).drop("_n")


def kept_letters(qual: pd.Series, trailing: int, window: int, window_q: int) -> pd.Series:
    """How many letters of each quality string stay: those to the last good one, and of them those before the first bad window.

    The read ends in the first bad window; letters at its start that are good themselves stay. The codes of all strings lie one after
    another in one array, so a window is a difference of running sums. A null string has no letters.
    """
    texts = [t or "" for t in qual]
    size = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), dtype="<u4").astype(np.int64) - 33
    start = np.cumsum(size) - size
    row, total = np.repeat(np.arange(len(texts)), size), len(codes)
    at = np.arange(total) - start[row]

    def first(hit: np.ndarray) -> np.ndarray:
        """The first place of each string that is hit; its size if there is none."""
        found = size.copy()
        where = np.flatnonzero(hit)[::-1]  # of several, the last one written stands
        found[row[where]] = at[where]
        return found

    n = np.zeros(len(texts), dtype=np.int64)
    good = np.flatnonzero(codes >= trailing)
    n[row[good]] = at[good] + 1
    sums = np.concatenate([[0], np.cumsum(codes)])
    whole = at + window <= n[row]
    bad = first(whole & (sums[np.minimum(np.arange(total) + window, total)] - sums[:-1] < window * window_q))
    low = first((codes < window_q) & (at >= bad[row]))  # a bad window holds a letter that is not good itself
    return pd.Series(np.where(bad < size, low, n), dtype="int32")


def collapse_reads(fastq: DataFrame, simplify: bool = False) -> tuple[DataFrame, DataFrame]:
    """(the first read of each sequence, each sequence's count downwards). ``id`` gives the input order."""
    rows = simplify_read_name(fastq) if simplify else fastq
    grouped = rows.groupBy("seq").agg(F.min_by(F.struct("id", "key", "tag", "qual"), "id").alias("r"), F.count("*").alias("n"))
    return grouped.select("r.id", "r.key", "seq", "r.tag", "r.qual"), grouped.select("seq", "n").orderBy(F.desc("n"), "seq")


def collapse_pairs(fastq1: DataFrame, fastq2: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both mates of the first pair of each pair of sequences; mates are joined by ``id``."""
    two = fastq2.select("id", *[F.col(c).alias(f"{c}_2") for c in ("key", "seq", "tag", "qual")])
    pairs = fastq1.join(two, "id")
    first = pairs.groupBy("seq", "seq_2").agg(F.min_by(F.struct("id", "key", "tag", "qual", "key_2", "tag_2", "qual_2"), "id").alias("r"))
    return first.select("r.id", "r.key", "seq", "r.tag", "r.qual"), first.select("r.id", F.col("r.key_2").alias("key"), F.col("seq_2").alias("seq"), F.col("r.tag_2").alias("tag"), F.col("r.qual_2").alias("qual"))


def with_barcode(fastq: DataFrame, pos: int, length: int, library: DataFrame | None = None) -> DataFrame:
    """fastq with barcode (from the 1-based place) and library ('unmatched' for others)."""
    rows = fastq.withColumn("barcode", F.substring("seq", pos, length))
    if library is None:
        return rows.withColumn("library", F.col("barcode"))
    return rows.join(small(library), "barcode", "left").withColumn("library", F.coalesce("library", F.lit("unmatched")))


def barcode_counts(fastq: DataFrame, pos: int, length: int, library: DataFrame | None = None) -> DataFrame:
    """barcode, library, n and its share of all reads."""
    counts = with_barcode(fastq, pos, length, library).groupBy("barcode", "library").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 1
    return counts.withColumn("share", F.col("n") / F.lit(total))


def read_distribution(counts: DataFrame, steps: list[str]) -> DataFrame:
    """(sample, step, n) → n, loss against the step before, share of the first step, in the order of ``steps``."""
    order = F.array_position(F.array(*map(F.lit, steps)), F.col("step")).cast("int")
    rows = counts.withColumn("order", order).where("order > 0")
    w = Window.partitionBy("sample").orderBy("order")
    return rows.select("sample", "step", "order", "n", (F.lag("n").over(w) - F.col("n")).alias("loss"), (F.col("n") / F.first("n").over(w)).alias("share"))


def mapped_abundance(sam: DataFrame, multimap: bool = True, reverse: bool = False) -> DataFrame:
    """contig, uniq, multi, total: reads with one hit, and the rest weighted by 1/hits (0.5/hits for mates)."""
    rows = sam.where(F.col("flag").bitwiseAND(4) == 0)
    if not reverse:
        rows = rows.where(F.col("flag").bitwiseAND(16) == 0)
    paired = F.col("flag").bitwiseAND(1) != 0
    hits = F.count("*").over(Window.partitionBy("read_id"))
    weighted = rows.select("chr_id", hits.alias("hits"), F.when(paired, F.lit(0.5)).otherwise(1.0).alias("one"), F.when(paired, F.ceil(hits / 2)).otherwise(hits).alias("places"))
    uniq = F.sum(F.when(F.col("places") == 1, F.col("one")).otherwise(0.0))
    multi = F.sum(F.when(F.col("places") > 1, F.col("one") / F.col("places")).otherwise(0.0)) if multimap else F.lit(0.0)
    out = weighted.groupBy(F.col("chr_id").alias("contig")).agg(uniq.alias("uniq"), multi.alias("multi"))
    return out.withColumn("total", F.col("uniq") + F.col("multi"))


def rpkm(sam: DataFrame, header: DataFrame, multimap: bool = True, reverse: bool = False) -> DataFrame:
    """contig, length, uniq, multi, rpkm = reads * 1e9 / (length * all reads)."""
    table = mapped_abundance(sam, multimap, reverse)
    total = float(table.agg(F.sum("total")).first()[0] or 1)
    joined = table.join(small(header), "contig")
    return joined.select("contig", "length", "uniq", "multi", (F.col("total") * 1e9 / (F.col("length") * F.lit(total))).alias("rpkm"))


def read_length_hist(sam: DataFrame) -> DataFrame:
    return sam.groupBy(F.length("seq").alias("length")).agg(F.count("*").alias("n"))


def mutation_profile(sam: DataFrame, n: int = 15) -> DataFrame:
    """side (5 or 3), offset (0..n-1 from that end), mutations, reads, rate."""
    rows = sam.where(F.col("flag").bitwiseAND(4) == 0).select(F.length("seq").alias("len"), (F.col("flag").bitwiseAND(16) != 0).alias("rev"), md_mutations(F.coalesce(sam_tag("tags", "MD"), F.lit(""))).alias("m"))
    total = rows.count()
    at = F.when(F.col("rev"), F.col("len") - 1 - F.col("p")).otherwise(F.col("p"))
    points = rows.select("len", "rev", F.explode("m").alias("p")).select("len", at.alias("at"))
    ends = points.select(F.inline(F.array(F.struct(F.lit(5).alias("side"), F.col("at").alias("offset")), F.struct(F.lit(3).alias("side"), (F.col("len") - 1 - F.col("at")).alias("offset"))))).where(F.col("offset").between(0, n - 1))
    return ends.groupBy("side", "offset").agg(F.count("*").alias("mutations")).withColumn("reads", F.lit(total)).withColumn("rate", F.col("mutations") / F.lit(max(total, 1)))


def sam_read_classes(sam: DataFrame, genes: DataFrame, exons: DataFrame) -> DataFrame:
    """class, type, reads: each mapped read is exon (split evenly over the transcripts it touches, by type), intron or
    intergenic; a contig without any gene gives un-annotated, an unmapped read un-mapped."""
    from . import scan
    from .coords import interval_join, merged

    ids = sam.withColumn("_row", F.monotonically_increasing_id())
    strand = F.when(F.col("flag").bitwiseAND(16) != 0, "-").otherwise("+")
    aligned = F.aggregate(F.transform(F.regexp_extract_all("cigar", F.lit("(\\d+)[MDN=X]"), F.lit(1)), lambda x: x.cast("long")), F.lit(0).cast("long"), lambda s, x: s + x)
    mapped = ids.where(F.col("flag").bitwiseAND(4) == 0).select("_row", F.col("chr_id").alias("contig"), strand.alias("strand"), F.col("pos").alias("first"), (F.col("pos") + aligned - 1).alias("second"))
    hit = interval_join(mapped, exons.select("contig", "strand", "transcript_id", "type", "first", "second"))
    touched = scan.save(hit.groupBy("_row").agg(F.collect_set(F.struct("transcript_id", "type")).alias("hits")).select("_row", F.transform("hits", lambda h: h["type"]).alias("types")), "read_hits")
    in_exon = touched.select("_row", F.explode("types").alias("type"), (F.lit(1.0) / F.size("types")).alias("w"))
    exon = in_exon.groupBy("type").agg(F.sum("w").alias("reads")).select(F.lit("exon").alias("class"), "type", "reads")
    rest = mapped.join(shuffled(touched.select("_row")), "_row", "left_anti")
    # in the union of all genes a read is met once or, across a gap, a few times
    in_gene = interval_join(rest, merged(genes)).select("_row").distinct().withColumn("g", F.lit(1))
    known = small(genes.select("contig").distinct().withColumn("k", F.lit(1)))
    kind = F.when(F.col("g") == 1, "intron").when(F.col("k") == 1, "intergenic").otherwise("un-annotated")
    others = rest.join(shuffled(in_gene), "_row", "left").join(known, "contig", "left").groupBy(kind.alias("class")).agg(F.count("*").cast("double").alias("reads"))
    unmapped = sam.where(F.col("flag").bitwiseAND(4) != 0).groupBy(F.lit("un-mapped").alias("class")).agg(F.count("*").cast("double").alias("reads"))
    more = others.unionByName(unmapped).select("class", F.lit(None).cast("string").alias("type"), "reads")
    return exon.unionByName(more)


def sample_reads(sam: DataFrame, target: int = 1_000_000, seed: int = 0) -> DataFrame:
    """About ``target`` rows if there are that many: those whose hash of seed, read_id, flag and pos is small enough; the same in every run."""
    n = sam.count()
    if n < target:
        return sam
    key = F.concat_ws("|", F.lit(str(seed)), "read_id", F.col("flag").cast("string"), F.col("pos").cast("string"))
    number = F.conv(F.substring(F.md5(key.cast("binary")), 1, 13), 16, 10).cast("long")
    return sam.where(number < int(target / n * (1 << 52)))


def fasta_select(seqs: DataFrame, fetch: DataFrame | None = None, remove: DataFrame | None = None, keep_id_re=None, drop_id_re=None, keep_note_re=None, drop_note_re=None, sample=None, seed: int = 0) -> DataFrame:
    """Sequences by id tables (column id; unknown ids are ignored), patterns on id or annotation, and a random sample of n."""
    if fetch is not None:
        seqs = seqs.join(fetch.select("id"), "id", "left_semi")
    if remove is not None:
        seqs = seqs.join(remove.select("id"), "id", "left_anti")
    for column, pattern, keep in (("id", keep_id_re, True), ("id", drop_id_re, False), ("annotation", keep_note_re, True), ("annotation", drop_note_re, False)):
        if pattern is not None:
            hit = F.rlike(F.coalesce(column, F.lit("")), F.lit(pattern))
            seqs = seqs.where(hit if keep else ~hit)
    return seqs if sample is None else seqs.orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(sample)


def small_rna_filter(seqs: DataFrame, max_len: int = 200) -> DataFrame:
    return seqs.where(F.length("seq") <= max_len)


def fasta_lengths(seqs: DataFrame) -> DataFrame:
    return seqs.select("id", F.length("seq").alias("length"))


def sort_fasta(seqs: DataFrame, by: str = "len", reverse: bool = False) -> DataFrame:
    key = {"len": F.length("seq"), "id": F.col("id")}[by]
    return seqs.orderBy(key.desc() if reverse else key.asc(), "id")


def column_select(df: DataFrame, spec: str) -> DataFrame:
    """Columns by a 1-based spec such as 4-7,9, joined by commas: df with ``selected``."""
    places: list[int] = []
    for part in spec.split(","):
        a, _, b = part.partition("-")
        places += range(int(a), int(b or a) + 1)
    return df.withColumn("selected", F.concat_ws(",", *[F.col(df.columns[i - 1]).cast("string") for i in places]))


def sort_tab(reads: DataFrame) -> DataFrame:
    """By contig and strand; + upwards by (start, end), - downwards by (end, start)."""
    plus = F.col("strand") == "+"
    first, second = F.element_at("regions", 1)["first"], F.element_at("regions", -1)["second"]
    return reads.orderBy("contig", "strand", F.when(plus, first).otherwise(-second), F.when(plus, second).otherwise(-first))


def sort_coordinate(sam: DataFrame) -> DataFrame:
    return sam.orderBy("chr_id", "pos", "read_id")


def sort_gtab(gtab: DataFrame) -> DataFrame:
    return gtab.orderBy("contig", "strand", "pos")


def mismatch_count(sam: DataFrame, genome_tiles: DataFrame, tag: str = "MM", tile: int | None = None) -> DataFrame:
    """sam with tag → the number of M, = and X bases that differ from a tiled genome. Blocks are cut at tile borders and joined."""
    from ..functions.cigar import cigar_split

    size = tile or genome_tiles.select(F.max(F.length("seq"))).first()[0] or 1
    zero = F.struct(F.col("pos").cast("long").alias("g"), F.lit(1).cast("long").alias("r"), F.array().cast("array<struct<g:bigint,r:bigint,n:bigint>>").alias("out"))

    def step(s: Column, x: Column) -> Column:
        match = x["op"].isin("M", "=", "X")
        g = s["g"] + F.when(x["op"].isin("M", "=", "X", "D", "N"), x["len"]).otherwise(0)
        r = s["r"] + F.when(x["op"].isin("M", "=", "X", "I", "S"), x["len"]).otherwise(0)
        out = F.when(match, F.concat(s["out"], F.array(F.struct(s["g"].alias("g"), s["r"].alias("r"), x["len"].alias("n"))))).otherwise(s["out"])
        return F.struct(g.alias("g"), r.alias("r"), out.alias("out"))

    marked = sam.withColumn("_row", F.monotonically_increasing_id())
    blocks = marked.select("_row", "chr_id", "seq", F.inline(F.aggregate(cigar_split("cigar"), zero, step, lambda s: s["out"])))
    cut = blocks.withColumn("tile", F.explode(F.expr(f"sequence(floor((g - 1) / {size}), floor((g + n - 2) / {size}))")))
    lo = F.greatest(F.col("g"), F.col("tile") * size + 1)
    hi = F.least(F.col("g") + F.col("n") - 1, (F.col("tile") + 1) * size)
    part = cut.select("_row", F.col("chr_id").alias("contig"), "tile", F.expr("seq").alias("read"), lo.alias("lo"), hi.alias("hi"), (F.col("r") + lo - F.col("g")).alias("at"))
    joined = part.join(genome_tiles.select("contig", "tile", "seq"), ["contig", "tile"])
    mine = F.upper(F.substring("read", F.col("at").cast("int"), (F.col("hi") - F.col("lo") + 1).cast("int")))
    theirs = F.upper(F.substring("seq", (F.col("lo") - F.col("tile") * size).cast("int"), (F.col("hi") - F.col("lo") + 1).cast("int")))
    bad = F.size(F.filter(F.zip_with(F.split(mine, ""), F.split(theirs, ""), lambda x, y: x != y), lambda b: b))
    counts = joined.select("_row", bad.alias("b")).groupBy("_row").agg(F.sum("b").alias("b"))
    text = F.coalesce(F.col("b"), F.lit(0)).cast("string")
    return marked.join(counts, "_row", "left").withColumn("tags", F.map_concat(F.map_filter("tags", lambda k, _: k != tag), F.create_map(F.lit(tag), text))).drop("_row", "b")
