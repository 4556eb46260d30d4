"""Mixing sources to target weights by Poisson replication. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._store import save

SEED = 29
#: Target share of a source: its characters to this power (1 keeps the mix, 0 makes all sources equal).
ALPHA = 0.7
#: Largest mean of one inversion; a larger rate is the sum of several draws.
MOST = 500.0
#: Sources up to which the table of rates goes to every task (at most some 10 MB); beyond, it is joined by shuffle.
BROADCAST_SOURCES = 1000


def uniform(seed: int, key: Column, draw: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of an MD5 hash of seed, key and draw."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), key, draw.cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def poisson_cdf(mean: Column) -> Column:
    """Cumulative probabilities of 0, 1, 2, ... up to where double precision ends."""
    places = F.sequence(F.lit(1), F.ceil(mean + 12 * F.sqrt(mean) + 20).cast("int"))
    start = F.struct(F.exp(-mean).alias("p"), F.array(F.exp(-mean)).alias("c"))

    def step(state: Column, k: Column) -> Column:
        p = state["p"] * mean / k
        return F.struct(p.alias("p"), F.concat(state["c"], F.array(F.element_at(state["c"], -1) + p)).alias("c"))

    return F.aggregate(places, start, step, lambda state: state["c"])


def rates(docs: DataFrame, weights: dict[str, float] | None = None, alpha: float = ALPHA) -> DataFrame:
    """source → rate, the mean number of copies that brings each source to its target share of all characters.

    ``weights`` names the target weight of sources; one that it does not name gets 0, so its documents have no copy.
    Without ``weights`` the target is size ** alpha. The total size stays. A document counts one character at least.
    """
    size = save(docs.groupBy("source").agg(F.sum(F.greatest(F.coalesce(F.length("text"), F.lit(0)), F.lit(1))).alias("size")), "source_sizes")
    if weights is None:
        target = F.pow(F.col("size").cast("double"), F.lit(alpha))
    else:
        named = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair]) if weights else None
        target = F.coalesce(F.element_at(named, F.col("source")), F.lit(0.0)) if weights else F.lit(0.0)
    size = size.withColumn("target", target.cast("double"))
    total, wanted = size.agg(F.sum("size"), F.sum("target")).first()
    share = F.col("target") / F.lit(float(wanted or 1) or 1.0)
    rate = share * F.lit(float(total or 0)) / F.col("size")
    draws = F.greatest(F.ceil(rate / MOST), F.lit(1)).cast("int")
    return size.select("source", rate.alias("rate"), draws.alias("draws")).withColumn("cdf", poisson_cdf(F.col("rate") / F.col("draws")))


def mix(docs: DataFrame, weights: dict[str, float] | None = None, alpha: float = ALPHA, seed: int = SEED) -> DataFrame:
    """Copies of ``docs`` in a random order: all columns, and copy_no (1, 2, ...), rate and shuffle_key.

    A document's number of copies is the Poisson quantile of a uniform number hashed from seed and doc_id: 0 or more, the
    same in every run. Null sources form one source of their own; a null doc_id hashes as the word null. Repeated rows
    are replicated alike. Null and empty texts count as one character. An empty table gives an empty result. Columns
    copy_no, rate and shuffle_key of the input are replaced; all others stay, whatever their names. Rows lie in partitions chosen by a hash of document and copy
    and are sorted by it there, so any prefix of the written files is a fair sample.
    """
    docs = docs.drop("copy_no", "rate", "shuffle_key")
    table = save(rates(docs, weights, alpha), "rates")
    few = table.select(F.col("source").alias("_source"), "rate", F.struct("draws", "cdf").alias("_draw"))
    if table.count() <= BROADCAST_SOURCES:
        few = F.broadcast(few)
    key = F.coalesce(F.col("row.doc_id").cast("string"), F.lit("null"))
    one = lambda j: F.size(F.filter("_draw.cdf", lambda c: c <= uniform(seed, key, j)))
    times = F.aggregate(F.sequence(F.lit(1), F.col("_draw.draws")), F.lit(0), lambda s, j: s + one(j))
    # the row is one struct here, so that no column of it can clash with one of the rates
    rows = docs.select(F.struct("*").alias("row"))
    joined = rows.join(few, F.col("row.source").eqNullSafe(F.col("_source"))).withColumn("_times", times).where("_times > 0")
    copies = joined.select("row.*", "rate", F.explode(F.sequence(F.lit(1), F.col("_times"))).alias("copy_no"))
    copies = copies.withColumn("shuffle_key", F.xxhash64(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "copy_no"))
    return copies.repartition("shuffle_key").sortWithinPartitions("shuffle_key")


def op4_query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix(docs.select("doc_id", "source", "text")).select("doc_id", "source", "text", F.col("copy_no").cast("long").alias("copy_no"), F.round("rate", 6).alias("rate"))


ORACLE = f"""
WITH sizes AS (SELECT source, CAST(sum(greatest(coalesce(length(text), 0), 1)) AS DOUBLE) AS size FROM documents GROUP BY source),
rates AS (SELECT source, power(size, {ALPHA}) / (SELECT sum(power(size, {ALPHA})) FROM sizes) * (SELECT sum(size) FROM sizes) / size AS rate FROM sizes),
terms AS (SELECT source, rate, k, exp(-rate + k * ln(rate) - lgamma(k + 1)) AS p FROM rates, range(0, 80) t(k)),
cdf AS (SELECT source, rate, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM terms),
draws AS (SELECT doc_id, source, text, CAST('0x' || substr(md5('{SEED}|' || coalesce(CAST(doc_id AS VARCHAR), 'null') || '|1'), 1, 13) AS BIGINT) / {float(1 << 52)} AS u FROM documents)
SELECT d.doc_id, d.source, d.text, CAST(c.k + 1 AS BIGINT) AS copy_no, round(c.rate, 6) AS rate
FROM draws d JOIN cdf c ON d.source IS NOT DISTINCT FROM c.source AND c.c <= d.u
"""
