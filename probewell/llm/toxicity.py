"""A toxicity classifier that is regularised with counterfactuals.

Features are the words of a text and their first letters (a learned stem also finds inflected forms), present or not.
The best few thousand are chosen by how unevenly the two classes use them. Labelled sentences that name a group are also
read with the group's name swapped, and the fit pays for each change that the swap makes to the score, so a name
that toxic sentences happen to use does not count against a neutral mention.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _text
from ._linear import Sparse, fit, sigmoid
from ._store import save

#: Bound of the labelled rows that are fitted, taken in the order of a hash of doc_id.
TRAIN_ROWS = 20_000
#: Features that are kept.
FEATURES = 8192
#: Labelled documents in which a feature stands at least.
MIN_DOCS = 3
#: Letters (bytes) of a word's beginning that are features.
STEMS = (3, 4, 5, 6, 7)
L2 = 3e-4
#: Weight of a toxic row: (clean rows / toxic rows) to this power.
BALANCE = 1.0
PAIR_WEIGHT = 1.0

# Names of groups that can stand for one another.
IDENTITY = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("gay", "straight"), ("lesbian", "heterosexual"), ("transgender", "cisgender"),
    ("muslim", "christian", "jewish", "hindu", "buddhist"), ("muslims", "christians", "jews", "hindus", "atheists"),
    ("black", "white", "asian", "latino"), ("africans", "europeans", "americans", "arabs"), ("immigrants", "citizens"), ("refugees", "residents"),
    ("femmes", "hommes"), ("musulmans", "chrétiens", "juifs"), ("frauen", "männer"), ("juden", "christen", "muslime"),
    ("mujeres", "hombres"), ("musulmanes", "cristianos", "judíos"), ("deaf", "hearing"), ("disabled", "abled"),
)
_NEXT = {t: group[(i + 1) % len(group)] for group in IDENTITY for i, t in enumerate(group)}
_NAMES = re.compile(r"(?<!\w)(" + "|".join(sorted(_NEXT, key=len, reverse=True)) + r")(?!\w)", re.I)


def swap(text: str) -> str:
    """The text with each group's name replaced by the next of its row in ``IDENTITY`` (in lower case)."""
    return _NAMES.sub(lambda m: _NEXT[m[1].lower()], text)


def _features(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, hash) of words, then of each length of stem."""
    words = _text.Words(data, offsets)
    row, size = words.rows(), words.end - words.start
    yield row, words.hash
    for k in STEMS:
        long = size > k
        start = words.start[long]
        yield row[long], _text.mix(words.rolling.ranges(start, start + k) + np.uint64(k))


def _distinct(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Distinct feature hashes of each row."""
    parts = list(_features(data, offsets))
    row, value = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    order = np.argsort(row, kind="stable")
    at = np.searchsorted(row[order], np.arange(len(offsets)))
    value = value[order]
    return [np.unique(value[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Labelled texts → feature, documents of class 1 and of class 0 (summed for each slice)."""
    for batch in batches:
        for part in _text.slices(batch, "text"):
            label = part.column("label").to_numpy(zero_copy_only=False)
            sets = _distinct(*_text.buffers(part.column("text")))
            value = np.concatenate([*sets, np.zeros(0, np.uint64)])
            one = np.repeat(label == 1, [len(s) for s in sets])
            distinct, which = np.unique(value, return_inverse=True)
            pos = np.bincount(which, weights=one, minlength=len(distinct)).astype(np.int64)
            total = np.bincount(which, minlength=len(distinct))
            yield pa.RecordBatch.from_arrays([pa.array(distinct.view(np.int64)), pa.array(pos), pa.array(total - pos)], ["feature", "pos", "neg"])


class Matcher:
    """Finds the features of a vocabulary in texts; a bit table passes over nearly all others."""

    def __init__(self, vocabulary: np.ndarray):
        self.known = np.sort(vocabulary.astype(np.int64).view(np.uint64))
        self.table = np.zeros(1 << 20, dtype=bool)
        self.table[self.known >> np.uint64(44)] = True

    def find(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, column) of the features present, once each, in order of rows."""
        n = len(self.known)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        out = []
        for row, value in _features(data, offsets):
            hit = self.table[value >> np.uint64(44)]
            row, value = row[hit], value[hit]
            at = np.minimum(np.searchsorted(self.known, value), n - 1)
            ok = self.known[at] == value
            out.append(row[ok] * n + at[ok])
        found = np.unique(np.concatenate(out))
        return found // n, found % n


def train(rows: DataFrame) -> tuple[Matcher, np.ndarray, float]:
    """Fit on ``rows`` (text, label): at most ``TRAIN_ROWS`` of them come here."""
    totals = rows.agg(F.count_if(F.col("label") == 1).alias("p"), F.count_if(F.col("label") == 0).alias("n")).first()
    if not totals["p"] or not totals["n"]:
        return Matcher(np.zeros(0, np.int64)), np.zeros(0), (40.0 if totals["p"] else -40.0)
    counts = rows.mapInArrow(count_rows, "feature long, pos long, neg long").groupBy("feature").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    p, n = float(totals["p"]), float(totals["n"])
    share = (F.col("pos") + F.col("neg")) / (p + n)
    uneven = F.abs(F.col("pos") / p - F.col("neg") / n) / F.sqrt(share * (1 - share) * (1 / p + 1 / n))
    best = counts.where(F.col("pos") + F.col("neg") >= MIN_DOCS).where(share < 1).select("feature", uneven.alias("z")).orderBy(F.desc("z"), "feature").limit(FEATURES)
    matcher = Matcher(np.array([r["feature"] for r in best.collect()], dtype=np.int64))

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _text.slices(batch, "text"):
                texts = part.column("text")
                row, column = matcher.find(*_text.buffers(texts))
                other = pa.array([swap(t) if t and _NAMES.search(t) else t for t in texts.to_pylist()], pa.string())
                row2, column2 = matcher.find(*_text.buffers(other))
                lists = [pa.ListArray.from_arrays(pa.array(np.searchsorted(r, np.arange(part.num_rows + 1)).astype(np.int32)), pa.array(c.astype(np.int32))) for r, c in ((row, column), (row2, column2))]
                yield pa.RecordBatch.from_arrays([part.column("label"), *lists], ["label", "x", "swapped"])

    table = rows.mapInArrow(match, "label int, x array<int>, swapped array<int>").toArrow()
    width = len(matcher.known)
    keys, sizes = [], []
    for name in ("x", "swapped"):
        parts = table.column(name).chunks
        size = np.concatenate([np.zeros(0, np.int64), *(c.value_lengths().to_numpy(zero_copy_only=False) for c in parts)]).astype(np.int64)
        column = np.concatenate([np.zeros(0, np.int32), *(c.flatten().to_numpy(zero_copy_only=False) for c in parts)])
        sizes.append(size)
        keys.append(np.repeat(np.arange(len(size)), size) * width + column)
    more, less = np.setdiff1d(keys[1], keys[0]), np.setdiff1d(keys[0], keys[1])
    both, sign = np.concatenate([more, less]), np.concatenate([np.ones(len(more)), -np.ones(len(less))])
    row, length = np.unique(both // max(width, 1), return_counts=True)
    turn = np.argsort(both, kind="stable")
    delta = Sparse(length, both[turn] % max(width, 1), sign[turn])
    w, b = fit(Sparse(sizes[0], keys[0] % max(width, 1)), table.column("label").to_numpy(), width, L2, pairs=delta, pair_weight=PAIR_WEIGHT, balance=BALANCE)
    return matcher, w, b


def remainder(doc_id: str = "doc_id"):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5


def settled_labels(labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, label) of the documents that all their labels call 0, or all 1; those with labels of both kinds are left out."""
    marks = labels.select("doc_id", F.col(label).cast("int").alias("label")).where("doc_id is not null and label in (0, 1)")
    return marks.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("most")).where("label = most").select("doc_id", "label")


def training_rows(docs: DataFrame, labels: DataFrame, label: str, limit: int) -> DataFrame:
    """Labelled rows outside the held-out fifth, at most ``limit``, chosen by a hash of doc_id; of several texts of a doc_id the least one."""
    marks = settled_labels(labels, label).where(remainder() != 0).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # at most ``limit`` ids: small enough to send to every task, so that no text is shuffled
    return save(texts.join(F.broadcast(marks), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text")).select("text", "label"), "labelled")


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with ``score`` (0 to 1, higher: label 1 likelier) and ``predicted`` (score >= 0.5).

    Every whole text is scored; null and empty texts get the score of a text without any feature. Only ``text`` enters
    a score. Rows of ``labels`` (doc_id, toxic) whose crc32(doc_id as text) mod 5 is 0, null labels and null doc_ids are
    not learned from; without labels of both classes all scores are 0 (or 1, if every label is 1). Repeated rows get equal
    scores; a doc_id labelled twice counts once, or not at all if its labels differ. An empty table gives an empty result. Other columns of ``docs`` stay,
    but for columns named score and predicted, which are replaced.
    """
    docs = docs.drop("score", "predicted")
    matcher, w, b = train(training_rows(docs, labels, "toxic", TRAIN_ROWS))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _text.slices(batch, "text"):
                row, column = matcher.find(*_text.buffers(part.column("text")))
                z = np.bincount(row, weights=w[column], minlength=part.num_rows) + b
                s = np.where(np.abs(z) >= 40, (z > 0).astype(float), sigmoid(z))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(s), pa.array((s >= 0.5).astype(np.int32))], [*part.schema.names, "score", "predicted"])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields] + ["score double", "predicted int"])
    return docs.mapInArrow(rows, schema)


def op3_query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    scored = score(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored.select("doc_id", F.coalesce(remainder() == 0, F.lit(False)).alias("held_out"), "score", "predicted")
