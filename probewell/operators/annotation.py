"""Transcript and gene tables: exons, introns, features, and annotation files to tables.

Transcripts have contig, strand, gene_id, transcript_id, type and exons (array of first, second in genome order).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.intervals import region
from ..functions.sequence import is_scaffold, reverse_complement


def exon_offsets(transcripts: DataFrame) -> DataFrame:
    """One row for each exon with its place in the transcript: exon (1 = 5'), first, second, t_first, t_second."""
    ordered = F.when(F.col("strand") == "-", F.reverse(F.array_sort("exons"))).otherwise(F.array_sort("exons"))
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.array().cast("array<struct<first:bigint,second:bigint,t_first:bigint,t_second:bigint>>").alias("out"))

    def step(s: Column, e: Column) -> Column:
        n = s["n"] + e["second"] - e["first"] + 1
        return F.struct(n.alias("n"), F.concat(s["out"], F.array(F.struct(e["first"].alias("first"), e["second"].alias("second"), (s["n"] + 1).alias("t_first"), n.alias("t_second")))).alias("out"))

    placed = F.aggregate(ordered, zero, step, lambda s: s["out"])
    rows = transcripts.select("contig", "strand", "gene_id", "transcript_id", "type", F.posexplode(placed).alias("exon", "e"))
    return rows.select("contig", "strand", "gene_id", "transcript_id", "type", (F.col("exon") + 1).cast("int").alias("exon"), "e.first", "e.second", "e.t_first", "e.t_second")


def gene_table(transcripts: DataFrame) -> DataFrame:
    """gene_id, contig, strand, first, second, length, transcripts, types (sorted arrays)."""
    rows = transcripts.select("gene_id", "contig", "strand", "transcript_id", "type", F.array_min(F.transform("exons", lambda e: e["first"])).alias("a"), F.array_max(F.transform("exons", lambda e: e["second"])).alias("b"))
    out = rows.groupBy("gene_id").agg(F.first("contig").alias("contig"), F.first("strand").alias("strand"), F.min("a").alias("first"), F.max("b").alias("second"), F.array_sort(F.collect_set("transcript_id")).alias("transcripts"), F.array_sort(F.collect_set("type")).alias("types"))
    return out.withColumn("length", F.col("second") - F.col("first") + 1)


def gene_trans_lists(transcripts: DataFrame, by: str = "gene", mrna_only: bool = False) -> DataFrame:
    """Transcripts listed by gene, (gene) name or type: key, transcripts."""
    column = {"gene": "gene_id", "name": "gene_name", "type": "type"}[by]
    rows = transcripts.where(F.col("type").isin("mRNA", "protein_coding")) if mrna_only else transcripts
    return rows.groupBy(F.col(column).alias("key")).agg(F.array_sort(F.collect_set("transcript_id")).alias("transcripts"))


def introns(transcripts: DataFrame) -> DataFrame:
    """Gaps between consecutive exons in genome order: transcript_id, contig, strand, intron (from 1), first, second."""
    sorted_exons = F.array_sort("exons")
    n = F.size("exons")
    gap = F.zip_with(F.slice(sorted_exons, F.lit(1), n - 1), F.slice(sorted_exons, F.lit(2), n - 1), lambda a, b: region(a["second"] + 1, b["first"] - 1))
    rows = transcripts.where(n > 1).select("transcript_id", "contig", "strand", F.posexplode(gap).alias("intron", "g"))
    return rows.select("transcript_id", "contig", "strand", (F.col("intron") + 1).cast("int").alias("intron"), "g.first", "g.second").where("first <= second")


def exons_in_gene(transcripts: DataFrame, genes: DataFrame) -> DataFrame:
    """Exons in gene coordinates; place 1 is the gene's 5' end."""
    rows = exon_offsets(transcripts).select("gene_id", "transcript_id", "exon", "strand", F.col("first").alias("a"), F.col("second").alias("b")).join(genes.select("gene_id", "first", "second"), "gene_id")
    plus = F.col("strand") == "+"
    return rows.select("gene_id", "transcript_id", "exon", F.when(plus, F.col("a") - F.col("first") + 1).otherwise(F.col("second") - F.col("b") + 1).alias("g_first"), F.when(plus, F.col("b") - F.col("first") + 1).otherwise(F.col("second") - F.col("a") + 1).alias("g_second"))


def merged_exons_introns(exons: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Union of the exons of all transcripts of a gene (touching ones join), and the gaps between: gene_id, first, second."""
    order = Window.partitionBy("gene_id").orderBy("first", "second")
    before = F.max("second").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = exons.select("gene_id", "first", "second").distinct().withColumn("new", (before.isNull() | (F.col("first") > before + 1)).cast("int"))
    island = marked.withColumn("island", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    merged = island.groupBy("gene_id", "island").agg(F.min("first").alias("first"), F.max("second").alias("second")).drop("island")
    ahead = F.lead("first").over(Window.partitionBy("gene_id").orderBy("first"))
    gaps = merged.select("gene_id", (F.col("second") + 1).alias("first"), (ahead - 1).alias("second")).where("second is not null")
    return merged, gaps


def longest_transcripts(transcripts: DataFrame, k: int | None = None, only: str | None = None) -> DataFrame:
    """Transcripts of each gene by length downwards (then by id): gene_id, transcript_id, length, rank; the first k if given."""
    length = F.aggregate("exons", F.lit(0).cast("long"), lambda s, e: s + e["second"] - e["first"] + 1)
    rows = transcripts if only is None else transcripts.where(F.col("type") == only)
    ranked = rows.select("gene_id", "transcript_id", length.alias("length")).withColumn("rank", F.row_number().over(Window.partitionBy("gene_id").orderBy(F.desc("length"), "transcript_id")))
    return ranked if k is None else ranked.where(F.col("rank") <= k)


def derive_utr(exons: Column, cds: Column, strand: Column) -> Column:
    """Struct (utr5, utr3) of arrays: exons before and behind the span of ``cds``; null if the CDS is not inside the exons."""
    lo, hi = F.array_min(F.transform(cds, lambda c: c["first"])), F.array_max(F.transform(cds, lambda c: c["second"]))
    exons = F.array_sort(exons)
    left = F.filter(F.transform(exons, lambda e: region(e["first"], F.least(e["second"], lo - 1))), lambda r: r["first"] <= r["second"])
    right = F.filter(F.transform(exons, lambda e: region(F.greatest(e["first"], hi + 1), e["second"])), lambda r: r["first"] <= r["second"])
    inside = lambda p: F.exists(exons, lambda e: (e["first"] <= p) & (p <= e["second"]))
    out = F.when(strand == "+", F.struct(left.alias("utr5"), right.alias("utr3"))).otherwise(F.struct(right.alias("utr5"), left.alias("utr3")))
    return F.when(F.size(cds).isNotNull() & (F.size(cds) > 0) & inside(lo) & inside(hi), out)


def _spans(regions: Column) -> Column:
    return F.array_join(F.transform(regions, lambda r: F.concat_ws("-", r["first"].cast("string"), r["second"].cast("string"))), ",")


def _stranded(regions: Column, strand: Column) -> Column:
    return F.when(strand == "-", F.reverse(F.array_sort(regions))).otherwise(F.array_sort(regions))


def gtf_to_genome_coor(gtf: DataFrame) -> DataFrame:
    """GTF rows → contig, first, second, strand, gene_id, gene_name, transcript_id, type, exons, utr (arrays; 5' first).

    The type is transcript_biotype, else transcript_type, else the word NULL; a missing gene name is NULL. A transcript
    whose CDS does not lie in its exons is left out.
    """
    a = lambda k: F.try_element_at("attributes", F.lit(k))
    rows = gtf.where(F.col("feature").isin("exon", "CDS") & a("transcript_id").isNotNull())
    part = F.struct("first", "second")
    grouped = rows.groupBy("contig", "strand", a("transcript_id").alias("transcript_id")).agg(
        F.max(a("gene_id")).alias("gene_id"), F.max(a("gene_name")).alias("gene_name"), F.max(F.coalesce(a("transcript_biotype"), a("transcript_type"))).alias("type"),
        F.array_sort(F.collect_set(F.when(F.col("feature") == "exon", part))).alias("exons"), F.array_sort(F.collect_set(F.when(F.col("feature") == "CDS", part))).alias("cds"),
    )
    return _with_utr(grouped.where(F.size("exons") > 0).fillna({"type": "NULL", "gene_name": "NULL"}))


def _with_utr(grouped: DataFrame) -> DataFrame:
    coding = F.size("cds") > 0
    utr = F.when(coding, derive_utr(F.col("exons"), F.col("cds"), F.col("strand")))
    rows = grouped.withColumn("u", utr).where(~coding | F.col("u").isNotNull())
    none = F.array().cast("array<struct<first:bigint,second:bigint>>")
    both = F.when(coding, F.concat("u.utr5", "u.utr3")).otherwise(none)
    return rows.select(
        "contig", F.array_min(F.transform("exons", lambda e: e["first"])).alias("first"), F.array_max(F.transform("exons", lambda e: e["second"])).alias("second"), "strand", "gene_id", "gene_name", "transcript_id", "type",
        "exons", _stranded(both, F.col("strand")).alias("utr"),
    )


def gff3_to_genome_coor(gff3: DataFrame, raw_contig: bool = False) -> DataFrame:
    """GFF3 rows → the columns of ``gtf_to_genome_coor``, by Parent links. Type: mRNA with a CDS, else the first known of
    Type, gene_biotype, ncrna_class, gbkey and the parent's gene_biotype. Contigs are renamed unless ``raw_contig``."""
    a = lambda k: F.try_element_at("attributes", F.lit(k))
    if not raw_contig:
        gff3 = rename_contigs(gff3, gff3.where(F.col("feature") == "region"))
    nodes = gff3.where(a("ID").isNotNull()).select(a("ID").alias("id"), a("Parent").alias("up"), F.coalesce(a("Type"), a("gene_biotype"), a("ncrna_class"), a("gbkey")).alias("kind"), a("gene_biotype").alias("biotype"), F.coalesce(a("transcript_id"), a("Name"), a("ID")).alias("name"), F.coalesce(a("gene"), a("Name")).alias("gene_name"), a("GeneID").alias("number")).dropDuplicates(["id"])
    part = F.struct("first", "second")
    rows = gff3.where(F.col("feature").isin("exon", "CDS") & a("Parent").isNotNull()).groupBy("contig", "strand", a("Parent").alias("id")).agg(
        F.array_sort(F.collect_set(F.when(F.col("feature") == "exon", part))).alias("exons"), F.array_sort(F.collect_set(F.when(F.col("feature") == "CDS", part))).alias("cds")
    )
    up = nodes.select(F.col("id").alias("up"), F.col("biotype").alias("up_type"), F.col("gene_name").alias("up_name"), F.col("number").alias("up_number"))
    named = rows.where(F.size("exons") > 0).join(nodes, "id").join(up, "up", "left")
    kind = F.when(F.size("cds") > 0, "mRNA").otherwise(F.coalesce("kind", "up_type", F.lit("NULL")))
    return _with_utr(named.select("contig", "strand", F.col("name").alias("transcript_id"), F.coalesce("number", "up_number", "up").alias("gene_id"), F.coalesce("gene_name", "up_name", F.lit("NULL")).alias("gene_name"), kind.alias("type"), "exons", "cds"))


def rename_contigs(df: DataFrame, region_rows: DataFrame, raw: bool = False) -> DataFrame:
    """NC_ contigs named by the region rows of a GFF3 (chromosome=N → chrN, genome=mitochondrion → chrM)."""
    if raw:
        return df
    a = lambda k: F.try_element_at("attributes", F.lit(k))
    name = F.when(a("genome") == "mitochondrion", "chrM").when(a("chromosome").isNotNull(), F.concat(F.lit("chr"), a("chromosome")))
    names = region_rows.where(F.startswith("contig", F.lit("NC_"))).select("contig", name.alias("_new")).where("_new is not null").dropDuplicates(["contig"])
    return df.join(names, "contig", "left").withColumn("contig", F.coalesce("_new", "contig")).drop("_new")


def transcript_features(bed: DataFrame) -> DataFrame:
    """Annotation with exons and utr arrays → length, utr_5/cds/utr_3 starts and ends in the transcript.

    Without a 5' UTR its places are 0, 0; without a 3' UTR they are length + 1. Transcripts that are no mRNA have nulls.
    """
    size = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda s, e: s + e["second"] - e["first"] + 1)
    n = size(F.col("exons"))
    exons = _stranded(F.col("exons"), F.col("strand"))
    end5 = F.element_at(exons, 1)
    first = F.when(F.col("strand") == "+", end5["first"]).otherwise(end5["second"])
    # 5' UTR pieces come first; they hold the transcript's end while they fill exons without a gap
    before = lambda r, s: F.when(F.col("strand") == "+", r["first"] <= s).otherwise(r["second"] >= s)
    utr = F.col("utr")
    has5 = F.exists(utr, lambda r: F.when(F.col("strand") == "+", r["first"] == first).otherwise(r["second"] == first))
    filled = F.aggregate(
        F.zip_with(F.slice(utr, F.lit(1), F.size(utr)), exons, lambda u, e: F.struct(u.alias("u"), e.alias("e"))),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(True).alias("go")),
        lambda s, x: F.when(s["go"] & x["u"].isNotNull() & x["e"].isNotNull() & F.when(F.col("strand") == "+", x["u"]["first"] == x["e"]["first"]).otherwise(x["u"]["second"] == x["e"]["second"]), F.struct((s["n"] + x["u"]["second"] - x["u"]["first"] + 1).alias("n"), (x["u"] == x["e"]).alias("go"))).otherwise(F.struct(s["n"].alias("n"), F.lit(False).alias("go"))),
        lambda s: s["n"],
    )
    n5 = F.when(has5, filled).otherwise(0)
    n3 = size(utr) - n5
    coding = F.col("type").isin("mRNA", "protein_coding")
    rows = bed.withColumn("length", n).withColumn("_5", n5).withColumn("_3", n3)
    c = lambda x: F.when(coding, x.cast("long"))
    del before
    return rows.select(
        *[x for x in bed.columns], "length",
        c(F.when(F.col("_5") > 0, 1).otherwise(0)).alias("utr_5_start"), c(F.col("_5")).alias("utr_5_end"), c(F.col("_5") + 1).alias("cds_start"), c(F.col("length") - F.col("_3")).alias("cds_end"),
        c(F.col("length") - F.col("_3") + 1).alias("utr_3_start"), c(F.when(F.col("_3") > 0, F.col("length")).otherwise(F.col("length") + 1)).alias("utr_3_end"),
    )


def genome_coor_to_trans_coor(bed: DataFrame) -> DataFrame:
    """transcript_id, gene_id, type, length, exon and UTR lists in transcript coordinates, as text ``s-e,s-e``."""
    features = transcript_features(bed)
    placed = exon_offsets(bed).groupBy("transcript_id").agg(F.array_sort(F.collect_list(F.struct(F.col("t_first").alias("first"), F.col("t_second").alias("second")))).alias("t"))
    joined = features.join(placed, "transcript_id")
    cut = lambda lo, hi: F.filter(F.transform("t", lambda e: region(F.greatest(e["first"], lo), F.least(e["second"], hi))), lambda r: r["first"] <= r["second"])
    utr = F.when(F.col("cds_start").isNotNull(), F.concat(cut(F.lit(1), F.col("utr_5_end")), cut(F.col("utr_3_start"), F.col("length"))))
    return joined.select("transcript_id", "gene_id", "type", "length", _spans(F.col("t")).alias("exons"), F.coalesce(_spans(utr), F.lit("")).alias("utr"))


def build_transcriptome(transcripts: DataFrame, genome_tiles: DataFrame, tile: int | None = None) -> DataFrame:
    """transcript_id, seq: exon sequences in transcript order, reverse-complemented on -. Tiles are joined, not sent around."""
    size = tile or genome_tiles.select(F.max(F.length("seq"))).first()[0] or 1
    pieces = exon_offsets(transcripts).withColumn("tile", F.explode(F.expr(f"sequence(floor((first - 1) / {size}), floor((second - 1) / {size}))")))
    joined = pieces.join(genome_tiles.select("contig", "tile", "seq"), ["contig", "tile"])
    a, b = F.greatest(F.col("first") - 1 - F.col("tile") * size, F.lit(0)), F.least(F.col("second") - F.col("tile") * size, F.lit(size))
    part = F.substring("seq", (a + 1).cast("int"), (b - a).cast("int"))
    stranded = F.when(F.col("strand") == "-", reverse_complement(part)).otherwise(part)
    order = F.when(F.col("strand") == "-", -F.col("tile")).otherwise(F.col("tile"))
    rows = joined.select("transcript_id", F.struct("exon", order.alias("k"), stranded.alias("s")).alias("p"))
    return rows.groupBy("transcript_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("p")), lambda p: p["s"]), "").alias("seq"))


def drop_scaffolds(df: DataFrame) -> DataFrame:
    return df.where(~is_scaffold("contig"))


def codon_check(transcripts: DataFrame, seqs: DataFrame) -> DataFrame:
    """offset (-3, 0, 3), starts and stops: how many CDS have ATG at cds_start + offset, and a stop codon that ends at cds_end + offset."""
    rows = transcripts.where("cds_start is not null").select("transcript_id", "cds_start", "cds_end").join(seqs, "transcript_id").withColumn("s", F.translate(F.upper("seq"), "U", "T"))
    shifted = rows.withColumn("offset", F.explode(F.array(*map(F.lit, (-3, 0, 3)))))
    at = lambda p: F.substring("s", p.cast("int"), F.lit(3))
    start = at(F.col("cds_start") + F.col("offset")) == "ATG"
    stop = at(F.col("cds_end") - 2 + F.col("offset")).isin("TAA", "TAG", "TGA")
    inside = lambda p: (p >= 1) & (p + 2 <= F.length("s"))
    return shifted.groupBy("offset").agg(F.count_if(start & inside(F.col("cds_start") + F.col("offset"))).alias("starts"), F.count_if(stop & inside(F.col("cds_end") - 2 + F.col("offset"))).alias("stops"))
