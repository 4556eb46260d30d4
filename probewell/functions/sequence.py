"""Nucleotide sequences, MD strings, structures and annotation text as column expressions."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def reverse_complement(seq: Column | str, rna: bool = False) -> Column:
    """The other strand, read backwards; letters that are no base become N. Case is kept."""
    known = F.translate(_c(seq), "ACGTUacgtuNn", "UGCAAugcaaNn" if rna else "TGCAAtgcaaNn")
    return F.reverse(F.regexp_replace(known, "[^ACGTUNacgtun]", "N"))


def subsequence(seq: Column | str, start: Column | int, length: Column | int, strand: Column | str = "+") -> Column:
    """``length`` letters from the 0-based ``start``; reverse-complemented on the minus strand."""
    lit = lambda x: F.lit(x) if isinstance(x, int) else x
    part = F.substring(_c(seq), (lit(start) + 1).cast("int"), lit(length).cast("int"))
    minus = F.lit(strand) == "-" if strand in ("+", "-") else _c(strand) == "-"
    return F.when(minus, reverse_complement(part)).otherwise(part)


def motif_sites(seq: Column | str, motif: str) -> Column:
    """1-based places of a motif, overlapping ones too."""
    s, n = _c(seq), len(motif)
    places = F.when(F.length(s) >= n, F.sequence(F.lit(1), F.length(s) - n + 1)).otherwise(F.array().cast("array<int>"))
    return F.filter(places, lambda i: F.substring(s, i, F.lit(n)) == motif)


# The standard genetic code; codons in the order of T, C, A, G, the last letter fastest.
_AMINO = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"


def _translated(seq: pa.Array) -> pa.Array:
    """The proteins of a batch of sequences in capitals, codon by codon over the bytes of all of them."""
    seq = seq.fill_null("").cast(pa.large_string())
    text = _bytes_of(seq)
    if len(text[0]) and text[0].max() > 127:
        text = _bytes_of(pc.replace_substring_regex(seq, r"[^\x00-\x7f]", "-"))  # one byte for each letter
    letters, ends = text
    digit, amino = np.full(256, 4, np.uint8), np.full(125, ord("X"), np.uint8)
    digit[list(b"TUCAG")] = 0, 0, 1, 2, 3
    for k, x in enumerate(_AMINO.encode()):
        amino[k // 16 * 25 + k // 4 % 4 * 5 + k % 4] = x
    count = (ends[1:] - ends[:-1]) // 3
    upto = np.concatenate([[0], np.cumsum(count)])
    if upto[-1] > 256 * len(seq):  # long sequences: no place of each codon is held
        codons = lambda i: (digit[letters[ends[i] + k : ends[i] + 3 * count[i] : 3]] for k in range(3))
        out = np.concatenate([amino[x * 25 + y * 5 + z] for x, y, z in map(codons, range(len(seq)))])
    else:
        at = np.repeat(ends[:-1] - 3 * upto[:-1], count) + 3 * np.arange(upto[-1])
        out = amino[digit[letters[at]] * 25 + digit[letters[at + 1]] * 5 + digit[letters[at + 2]]]
    whole = pa.Array.from_buffers(pa.large_string(), len(seq), [None, pa.py_buffer(upto.astype(np.int64)), pa.py_buffer(out)])
    return whole.cast(pa.string())


def _bytes_of(seq: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts, and where each begins and ends among them."""
    _, ends, data = seq.buffers()
    ends = np.frombuffer(ends, np.int64)[seq.offset : seq.offset + len(seq) + 1] if len(seq) else np.zeros(1, np.int64)
    letters = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.zeros(0, np.uint8)
    return letters, ends - ends[0]


def translate_codons(seq: Column | str) -> Column:
    """Amino acids of the codons from the first letter on, * for a stop, X for a codon with another letter. A null gives an empty text."""
    return F.arrow_udf(_translated, "string")(F.upper(_c(seq)))


def md_mutations(md: Column | str) -> Column:
    """0-based offsets in the read of the mismatches of an MD string. Deleted letters (after ^) take no place."""
    parts = F.regexp_extract_all(_c(md), F.lit(r"([0-9]+|\^[A-Za-z]+|[A-Za-z])"), F.lit(1))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))

    def step(s: Column, x: Column) -> Column:
        number = s["at"] + x.try_cast("int")
        return (
            F.when(F.rlike(x, F.lit("^[0-9]")), F.struct(number.alias("at"), s["out"].alias("out")))
            .when(F.startswith(x, F.lit("^")), s)
            .otherwise(F.struct((s["at"] + 1).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")))
        )

    return F.aggregate(parts, zero, step, lambda s: s["out"])


def is_scaffold(contig: Column | str) -> Column:
    """Names that are neither chr... nor NC_... and longer than 6 letters."""
    c = _c(contig)
    return ~F.startswith(c, F.lit("chr")) & ~F.startswith(c, F.lit("NC_")) & (F.length(c) > 6)


def strip_version(name: Column | str) -> Column:
    return F.regexp_replace(_c(name), r"\.[^.]*$", "")


def gene_type_class(raw: Column | str) -> Column:
    """A raw biotype's class: mRNA, pseudogene, lncRNA, a small RNA's own name, or other (tRNA, ribozymes and the rest)."""
    r = _c(raw)
    return (
        F.when(r.isin("protein_coding", "mRNA"), "mRNA")
        .when(F.rlike(r, F.lit("pseudo")), "pseudogene")
        .when(r.isin("lincRNA", "lncRNA", "lnc_RNA", "antisense", "sense_intronic", "sense_overlapping", "processed_transcript", "3prime_overlapping_ncRNA", "3prime_overlapping_ncrna", "bidirectional_promoter_lncRNA", "macro_lncRNA", "non_coding"), "lncRNA")
        .when(r.isin("miRNA", "misc_RNA", "rRNA", "snRNA", "snoRNA"), r)
        .otherwise("other")
    )


def parse_gtf_attributes(text: Column | str) -> Column:
    """``key "value"; key "value"`` as a map; of a repeated key the last value counts."""
    t = _c(text)
    keys = F.regexp_extract_all(t, F.lit(r'(\w+)\s+"([^"]*)"'), F.lit(1))
    values = F.regexp_extract_all(t, F.lit(r'(\w+)\s+"([^"]*)"'), F.lit(2))
    return _last_map(F.arrays_zip(keys.alias("k"), values.alias("v")), "k", "v")


def _last_map(entries: Column, k: str, v: str) -> Column:
    zero = F.create_map().cast("map<string,string>")
    return F.aggregate(entries, zero, lambda m, e: F.map_concat(F.map_filter(m, lambda a, _: a != e[k]), F.create_map(e[k], e[v])))


def parse_gff3_attributes(text: Column | str) -> Column:
    """``k=v;k=v`` as a map. The parts of Dbxref get keys of their own; a repeated one gets the suffix _2."""
    entries = F.transform(F.filter(F.split(_c(text), ";"), lambda x: F.contains(x, F.lit("="))), lambda x: F.struct(F.trim(F.substring_index(x, "=", 1)).alias("k"), F.regexp_replace(x, "^[^=]*=", "").alias("v")))
    plain = F.filter(entries, lambda e: e["k"] != "Dbxref")
    refs = F.flatten(F.transform(F.filter(entries, lambda e: e["k"] == "Dbxref"), lambda e: F.split(e["v"], ",")))
    named = F.transform(F.filter(refs, lambda x: F.contains(x, F.lit(":"))), lambda x: F.struct(F.substring_index(x, ":", 1).alias("k"), F.regexp_replace(x, "^[^:]*:", "").alias("v")))
    zero = F.create_map().cast("map<string,string>")
    second = F.aggregate(named, zero, lambda m, e: F.map_concat(m, F.create_map(F.when(F.map_contains_key(m, e["k"]), F.concat(e["k"], F.lit("_2"))).otherwise(e["k"]), e["v"])))
    return F.map_concat(_last_map(plain, "k", "v"), F.map_filter(second, lambda k, _: ~F.exists(plain, lambda e: e["k"] == k)))


def rna_region_class(start, end, cds_start, cds_end, length, kind) -> Column:
    """Where a transcript interval lies: 5UTR, CDS, 3UTR or a span of them; not_mRNA for other types; INVALID."""
    s, e, c0, c1, n, t = (_c(x) for x in (start, end, cds_start, cds_end, length, kind))
    return (
        F.when(~t.isin("mRNA", "protein_coding"), "not_mRNA")
        .when((s < 1) | (e > n) | (s > e) | c0.isNull() | c1.isNull(), "INVALID")
        .when(e < c0, "5UTR")
        .when((s < c0) & (e <= c1), "span_5UTR_CDS")
        .when((s < c0) & (e > c1), "span_5UTR_CDS_3UTR")
        .when(e <= c1, "CDS")
        .when(s <= c1, "span_CDS_3UTR")
        .otherwise("3UTR")
    )


_PAIRS = T.ArrayType(T.StructType([T.StructField("left", T.IntegerType()), T.StructField("right", T.IntegerType())]))


@F.pandas_udf(_PAIRS)
def _pairs(dots: pd.Series) -> pd.Series:
    def one(dot: str | None):
        stack, out = [], []
        for i, c in enumerate(dot or "", 1):
            if c in "([{<":
                stack.append((c, i))
            elif c in ")]}>":
                if not stack or "([{<".index(stack[-1][0]) != ")]}>".index(c):
                    return None
                out.append({"left": stack.pop()[1], "right": i})
        return None if stack or dot is None else sorted(out, key=lambda p: p["left"])

    return dots.map(one)


def dotbracket_pairs(dot: Column | str) -> Column:
    """Base pairs (left, right) of a dot-bracket string, by left; null if the brackets do not match."""
    return _pairs(_c(dot))


def pairs_to_dotbracket(pairs: Column | str, length: Column | str) -> Column:
    p = _c(pairs)
    sign = lambda i: F.when(F.exists(p, lambda x: x["left"] == i), "(").when(F.exists(p, lambda x: x["right"] == i), ")").otherwise(".")
    return F.array_join(F.transform(F.sequence(F.lit(1), _c(length).cast("int")), sign), "")


def pairs_to_ct(df: DataFrame) -> DataFrame:
    """(id, seq, pairs) → one row for each base: id, pos, base, before, after, mate (0 if unpaired), pos_again."""
    n = F.length("seq")
    rows = df.select("id", "pairs", n.alias("n"), F.posexplode(F.split("seq", "")).alias("i", "base")).where("base <> ''").withColumn("pos", F.col("i") + 1)
    mate = F.filter("pairs", lambda p: (p["left"] == F.col("pos")) | (p["right"] == F.col("pos")))
    other = F.transform(mate, lambda p: F.when(p["left"] == F.col("pos"), p["right"]).otherwise(p["left"]))
    return rows.select("id", "pos", "base", F.col("i").alias("before"), F.when(F.col("pos") == F.col("n"), 0).otherwise(F.col("pos") + 1).alias("after"), F.coalesce(F.try_element_at(other, F.lit(1)), F.lit(0)).alias("mate"), F.col("pos").alias("pos_again"))


def tt_crosslinks(df: DataFrame) -> DataFrame:
    """(id, seq, pairs) → points (id, x, y) where a U next to one base of a pair faces a U next to the other."""
    pairs = df.select("id", F.translate(F.upper("seq"), "T", "U").alias("seq"), F.inline("pairs"))
    options = F.array(*[F.struct((F.col("left") + a).alias("x"), (F.col("right") + b).alias("y")) for a, b in ((0, 1), (0, -1), (1, 0), (-1, 0))])
    points = pairs.select("id", "seq", F.inline(options)).where("x between 1 and length(seq) and y between 1 and length(seq) and x < y")
    return points.where("substring(seq, x, 1) = 'U' and substring(seq, y, 1) = 'U'").select("id", "x", "y").distinct()


def barcode_lib(spark, spec: int | str) -> DataFrame:
    """All DNA words of ``spec`` letters (named by themselves), or ``code:name::code:name``: (barcode, library)."""
    if isinstance(spec, int):
        words = spark.range(1).select(F.lit("").alias("barcode"))
        for _ in range(spec):
            words = words.select(F.explode(F.array(*[F.concat("barcode", F.lit(c)) for c in "ACGT"])).alias("barcode"))
        return words.withColumn("library", F.col("barcode"))
    pairs = [tuple(p.split(":", 1)) for p in spec.split("::") if p]
    return spark.createDataFrame(pairs, "barcode string, library string")

