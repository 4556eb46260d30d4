"""Token counts, and rollups that signed deltas keep up to date.

A ledger is a folder with one table for each committed batch. A batch holds sums of signed counts by source, language and
tokenizer version: inserts add, deletes subtract, a revision subtracts the old count and adds the new one. A batch is
written aside and then renamed to its id in one step, so a lost executor or driver leaves either the whole batch or
nothing, and a batch that comes again changes nothing.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _text
from ._store import _fs, exists, new_path, save

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the split pattern that belongs to the rank file.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
VERSIONS = ("byte_bpe_50k/1", "words/1")
KEY = ("source", "lang", "version")
SUMS = ("documents", "tokens", "chars", "bytes")
_SUM_TYPE = "decimal(38,0)"


@lru_cache(2)
def encoding(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def count_tokens(texts: DataFrame, column: str = "text", path: str = RANKS) -> DataFrame:
    """``texts`` without ``column``, with n_bpe and n_words: its tokens by each of ``VERSIONS``. Null texts count 0.

    Columns n_bpe and n_words of the input are replaced; others stay. An empty table gives an empty result.
    """
    texts = texts.drop(*[c for c in ("n_bpe", "n_words") if c != column])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding(path).encode_ordinary
        for batch in batches:
            for part in _text.slices(batch, column):
                texts = part.column(column)
                bpe = pa.array([len(encode(t)) if t else 0 for t in texts.to_pylist()], pa.int64())
                words = pa.array(_text.Words(*_text.buffers(texts), hashed=False).count.astype(np.int64))
                keep = [i for i, name in enumerate(part.schema.names) if name != column]
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in keep), bpe, words], [*(part.schema.names[i] for i in keep), "n_bpe", "n_words"])

    rest = [f for f in texts.schema.fields if f.name != column]
    return texts.mapInArrow(rows, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rest), "n_bpe long, n_words long"]))


def deltas(counted: DataFrame, sign: int) -> DataFrame:
    """Counted documents (source, lang, n_chars, n_bytes, n_bpe, n_words) → signed rows, one for each version."""
    versions = F.array(*[F.struct(F.lit(v).alias("version"), F.col(c).alias("tokens")) for v, c in zip(VERSIONS, ("n_bpe", "n_words"), strict=True)])
    rows = counted.select("source", "lang", F.col("n_chars").alias("chars"), F.col("n_bytes").alias("bytes"), F.inline(versions))
    return rows.select(*KEY, F.lit(sign).alias("documents"), *[(F.col(c) * sign).alias(c) for c in SUMS[1:]])


class Ledger:
    """Additive totals by source, language and tokenizer version, in a shared folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _place(self, batch_id: str) -> str:
        if not batch_id or set(batch_id) - set("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789-_"):
            raise ValueError("a batch id has letters, digits, - and _ only")
        return f"{self.path}/batches/batch={batch_id}"

    def commit(self, batch_id: str, *signed: DataFrame) -> bool:
        """Add the sums of signed rows as one batch. False, and nothing happens, if the id has been committed before."""
        place = self._place(batch_id)
        if exists(self.spark, place):
            return False
        rows = signed[0]
        for more in signed[1:]:
            rows = rows.unionByName(more)
        sums = rows.groupBy(*KEY).agg(*[F.sum(F.col(c).cast(_SUM_TYPE)).cast(_SUM_TYPE).alias(c) for c in SUMS])
        aside = new_path(self.spark, "ledger-aside")
        sums.coalesce(1).write.parquet(aside)  # one row for each source, language and version
        fs, target = _fs(self.spark, place)
        fs.mkdirs(target.getParent())
        if exists(self.spark, place) or not fs.rename(_fs(self.spark, aside)[1], target):
            fs.delete(_fs(self.spark, aside)[1], True)
            return False
        return True

    def batches(self) -> list[str]:
        fs, place = _fs(self.spark, f"{self.path}/batches")
        return sorted(s.getPath().getName().removeprefix("batch=") for s in fs.listStatus(place)) if fs.exists(place) else []

    def totals(self) -> DataFrame:
        """The sums of all committed batches, without cells that are back at zero documents and tokens."""
        schema = "source string, lang string, version string, " + ", ".join(f"{c} {_SUM_TYPE}" for c in SUMS)
        if not self.batches():
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).parquet(*[self._place(b) for b in self.batches()])
        sums = rows.groupBy(*KEY).agg(*[F.sum(c).cast("long").alias(c) for c in SUMS])
        return sums.where(" or ".join(f"{c} <> 0" for c in SUMS))

    def rollup(self) -> DataFrame:
        """Totals, and their sums over languages and over all sources; ``level`` 0 is a cell, 1 a source, 3 a version."""
        rolled = self.totals().rollup("version", "source", "lang").agg(F.grouping_id().alias("level"), *[F.sum(c).alias(c) for c in SUMS])
        return rolled.where("level < 7").select("version", "source", "lang", F.col("level").cast("int").alias("level"), *SUMS)


def _measured(docs: DataFrame, path: str, revise: bool = False) -> DataFrame:
    """The counts of each text (or of what ``REVISED`` leaves of it), with a hash and the size of the text as it came, and whether it is to be revised."""
    text = F.coalesce(F.col("text"), F.lit(""))
    left = F.regexp_replace(text, REVISED, "") if revise else text
    key = [F.xxhash64(text, F.reverse(text)).alias("same"), F.octet_length(text).alias("size"), F.rlike(text, F.lit(REVISED)).alias("revised")]
    rows = docs.select("doc_id", "source", "lang", *key, F.length(left).cast("long").alias("n_chars"), F.octet_length(left).cast("long").alias("n_bytes"), left.alias("text"))
    return count_tokens(rows.where("revised") if revise else rows, path=path)


#: What a revision takes out of a text: runs of three or more symbols.
REVISED = r"[#*$%&|<>]{3,}"


def op8_query(spark: SparkSession, sf_dir: str, path: str = RANKS) -> DataFrame:
    """The ledger of all documents: inserted, freed of exact copies, revised, and each batch delivered twice.

    Batch ``insert`` has every row. Batch ``delete`` takes back every row whose text also has a smaller doc_id (a null
    doc_id counts as the largest; null texts are empty ones). Batch ``revise`` replaces the counts of the remaining rows
    from whose text runs of three or more symbols are taken out. Rows are judged one by one: repeated rows all stay or all
    go, as do rows with a null doc_id, and a doc_id may stand at different texts. Null sources and languages are groups of
    their own. An empty table gives an empty rollup. Returns the rollup.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    ledger = Ledger(spark, new_path(spark, "ledger"))
    before, after = save(_measured(docs, path), "counts"), save(_measured(docs, path, revise=True), "revised")
    number = F.coalesce("doc_id", F.lit(2**63 - 1))
    first = before.groupBy("same", "size").agg(F.min(number).alias("first"))
    # written first: the join then shuffles a plain table and can split a very frequent text over tasks
    first = save(first, "firsts")
    judged = [rows.join(first, ["same", "size"]).withColumn("extra", number > F.col("first")) for rows in (before, after)]
    old, new = (rows.where("revised and not extra") for rows in judged)
    for _ in range(2):
        ledger.commit("insert", deltas(before, 1))
        ledger.commit("delete", deltas(judged[0].where("extra"), -1))
        ledger.commit("revise", deltas(old, -1), deltas(new, 1))
    return ledger.rollup()
