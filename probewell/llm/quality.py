"""Quality rules: text statistics, and a logistic regression on hashed word and character n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _text
from ._linear import Sparse, fit, sigmoid
from ._store import save
from .toxicity import remainder, settled_labels

#: Bounds of the labelled rows that are fitted and that calibrate, taken in the order of a hash of doc_id.
TRAIN_ROWS, CALIBRATION_ROWS = 4000, 4000
#: Buckets of word n-grams, and as many of character n-grams.
BITS = 16
#: A text's mean weight counts so many times.
SCALE = 20.0
L2, STEPS = 1e-5, 150
WINDOW = 8
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30
#: Calibrated probability of quality 1 from which a text is kept.
THRESHOLD = 0.5

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


def statistics(data: np.ndarray, offsets: np.ndarray, words: _text.Words) -> dict[str, np.ndarray]:
    """The five counts of each row. ``words`` keeps the case."""
    n = len(offsets) - 1
    runs = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])[offsets])
    points = runs(((data & 0xC0) != 0x80) & _text._IS_WORD[data])
    symbols = runs(_SYMBOL[data])

    first = np.concatenate([offsets[:-1], np.flatnonzero(data == 10) + 1])
    first = np.unique(first[first < len(data)])
    row = np.searchsorted(offsets, first, side="right") - 1
    past = np.minimum(np.concatenate([first[1:], [len(data)]]), offsets[row + 1]) if len(first) else first
    end = past - ((past > first) & (data[np.maximum(past - 1, 0)] == 10))
    has_word = np.searchsorted(words.start, end) > np.searchsorted(words.start, first)
    first, end, row = first[has_word], end[has_word], row[has_word]
    lines = np.unique(np.column_stack([row.astype(np.uint64), words.rolling.ranges(first, end)]), axis=0) if len(row) else np.zeros((0, 2), np.uint64)
    dup_lines = np.bincount(row, minlength=n) - np.bincount(lines[:, 0].astype(np.int64), minlength=n)

    windows, at = _text.shingles(words, WINDOW)
    owner = np.repeat(np.arange(n), np.diff(at))
    _, which, count = np.unique(_text.mix(windows + _text.mix(owner.astype(np.uint64))), return_inverse=True, return_counts=True)
    twice = np.flatnonzero(count[which] > 1) if len(which) else np.zeros(0, np.int64)
    begin = words.row_first[:-1][owner[twice]] + (twice - at[:-1][owner[twice]])
    edge = np.zeros(len(words.start) + WINDOW + 1, dtype=np.int64)
    np.add.at(edge, begin, 1)
    np.add.at(edge, begin + WINDOW, -1)
    covered = np.concatenate([[0], np.cumsum(np.cumsum(edge)[: len(words.start)] > 0)])
    return {"n_words": words.count, "word_chars": points, "n_symbols": symbols, "n_dup_lines": dup_lines, "n_repeat_words": np.diff(covered[words.row_first])}


def buckets(data: np.ndarray, offsets: np.ndarray, words: _text.Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, bucket) of every word and word pair, then of every run of three bytes."""
    row, size = words.rows(), 1 << BITS
    pair = words.hash[:-1] + (words.hash[1:] >> np.uint64(7)) if len(row) > 1 else words.hash[:0]
    inside = row[1:] == row[:-1]
    yield np.concatenate([row, row[1:][inside]]), np.concatenate([words.hash, _text.mix(pair[inside])]).view(np.int64) & (size - 1)
    if len(data) < 3:
        yield np.zeros(0, np.int64), np.zeros(0, np.int64)
        return
    code = (data[:-2].astype(np.uint32) << 16) | (data[1:-1].astype(np.uint32) << 8) | data[2:]
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    whole = owner[:-2] == owner[2:]
    yield owner[:-2][whole], size + ((code * np.uint32(2654435761)) >> np.uint32(32 - BITS))[whole].astype(np.int64)


def train_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Labelled texts → label, fold, and the share of each bucket among the text's n-grams of its kind."""
    width = 2 << BITS
    for batch in batches:
        for part in _text.slices(batch, "text"):
            data, offsets = _text.buffers(part.column("text"))
            words = _text.Words(data, offsets, lower=False)
            keys, values = [], []
            for row, bucket in buckets(data, offsets, words):
                key, count = np.unique(row * width + bucket, return_counts=True)
                total = np.bincount(row, minlength=part.num_rows)
                keys.append(key)
                values.append(SCALE * count / np.maximum(total[key // width], 1))
            key = np.concatenate(keys)
            turn = np.argsort(key, kind="stable")
            at = pa.array(np.searchsorted(key[turn], np.arange(part.num_rows + 1) * width).astype(np.int32))
            column, value = (key[turn] % width).astype(np.int32), np.concatenate(values)[turn].astype(np.float32)
            yield pa.RecordBatch.from_arrays([part.column("label"), part.column("fold"), pa.ListArray.from_arrays(at, pa.array(column)), pa.ListArray.from_arrays(at, pa.array(value))], ["label", "fold", "columns", "shares"])


def raw_scores(data: np.ndarray, offsets: np.ndarray, words: _text.Words, w: np.ndarray) -> np.ndarray:
    z = np.zeros(len(offsets) - 1)
    for row, bucket in buckets(data, offsets, words):
        total = np.bincount(row, minlength=len(z))
        z += SCALE * np.bincount(row, weights=w[bucket], minlength=len(z)) / np.maximum(total, 1)
    return z


def train(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float, float]:
    """Weights, slope and intercept: the fit uses four of five folds less one, that one calibrates; fold 0 is never read."""
    marks = settled_labels(labels, "quality").withColumn("fold", remainder())
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    marks = marks.where("fold > 1").orderBy(*order).limit(TRAIN_ROWS).unionByName(marks.where("fold = 1").orderBy(*order).limit(CALIBRATION_ROWS))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # at most 8000 ids: small enough to send to every task, so that no text is shuffled
    rows = save(texts.join(F.broadcast(marks), "doc_id").groupBy("doc_id", "label", "fold").agg(F.min("text").alias("text")).select("text", "label", F.col("fold").cast("int").alias("fold")), "labelled")
    table = rows.mapInArrow(train_rows, "label int, fold int, columns array<int>, shares array<float>")

    def read(where: str) -> tuple[Sparse, np.ndarray]:
        found = table.where(where).drop("fold").toArrow().combine_chunks()
        columns, shares = (found.column(c).combine_chunks() if found.num_rows else pa.array([], pa.list_(pa.float32())) for c in ("columns", "shares"))
        if isinstance(columns, pa.ChunkedArray):
            columns, shares = columns.chunk(0), shares.chunk(0)
        return Sparse(columns.value_lengths().to_numpy(zero_copy_only=False), columns.flatten().to_numpy(zero_copy_only=False), shares.flatten().to_numpy(zero_copy_only=False)), found.column("label").to_numpy()

    x, y = read("fold > 1")
    w, b = fit(x, y, 2 << BITS, L2, steps=STEPS, rate=0.5)
    if not len(y):
        return w, 1.0, 40.0
    del x
    held, truth = read("fold = 1")
    if len(set(truth.tolist())) < 2 or not w.any():
        return w, 1.0, b
    z = held.dot(w) + b
    one = Sparse(np.ones(len(z), dtype=int), np.zeros(len(z), dtype=int), z / 10)
    slope, shift = fit(one, truth, 1, 1e-4, steps=400, rate=0.1)
    return w, float(max(slope[0], 0.1) / 10), float(shift + max(slope[0], 0.1) / 10 * b)


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, the counts of each whole text, base_failed, probability (calibrated, of quality 1) and kept.

    ``docs`` needs doc_id and text, ``labels`` doc_id and quality; other columns are ignored. A text fails the base rules
    with under 20 words or more than 30 % of its words in repeated 8-word windows; else it is kept if the probability is
    0.5 or more. Null and empty texts have no words and fail. Null labels, null doc_ids and documents with labels of both kinds are not learned from; without
    labels every probability is 1, with labels of one class that class. Repeated rows get equal results; an empty table
    gives an empty result.
    """
    w, slope, shift = train(docs, labels)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _text.slices(batch, "text"):
                data, offsets = _text.buffers(part.column("text"))
                words = _text.Words(data, offsets, lower=False)
                found = statistics(data, offsets, words)
                p = sigmoid(slope * raw_scores(data, offsets, words, w) + shift)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(v.astype(np.int64)) for v in found.values()), pa.array(p)], ["doc_id", *found, "probability"])

    schema = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, probability double"
    out = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(rows, schema)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return out.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("probability") >= THRESHOLD))


def op10_query(spark, sf_dir: str) -> DataFrame:
    return quality(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
