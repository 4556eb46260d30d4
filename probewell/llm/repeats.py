"""Removal of byte strings that repeat across or within documents, with a sampled suffix order.

Every window of ``LENGTH`` bytes has one anchor: the place of its smallest ``GRAM``-byte hash. It depends on the
window's bytes alone, so equal windows have equal anchors, and the windows of a document fall into short runs
(segments) with one anchor each. Windows of an anchor whose gram stands nowhere else are unique, and segments that are
equal as a whole repeat as a whole: both are settled by counting hashes. What is left, one of each differing
segment, is a suffix from its anchor (and, read backwards, a prefix). Sampled splitters range-partition the suffixes by
their leading bytes; each bucket sorts them with a multikey quicksort whose characters are 8 bytes wide, takes the
common lengths of neighbours, and finds the windows that two suffixes share. The suffixes of a very frequent gram are dealt
over several buckets; these compare what is left of their windows across the boundaries.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _text
from ._store import save

LENGTH = 400
GRAM = 100
#: Leading bytes by which the splitters are sampled.
LEAD = 16
#: Places of one gram up to which its suffixes stay in one bucket (of some 15 MB at most); more are spread over buckets.
SPLIT = 20_000

_HIGH = np.uint64(0xFFFFFFFF00000000)
_LOW = np.uint64(0xFFFFFFFF)
_SECOND = 0xD6E8FEB86659FD93
_SECOND_INVERSE = pow(_SECOND, -1, 1 << 64)


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` values in a row, from running minima of blocks in both directions."""
    n = len(x) - width + 1
    blocks = -(-len(x) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(x)] = x
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def segments(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """row, first window, last window, anchor (places in ``data``), gram hash and segment hash of all segments."""
    if len(data) < LENGTH:
        return tuple(np.zeros(0, dtype=d) for d in (np.int64,) * 6)
    rolling = _text.Rolling(data)
    grams = rolling.windows(GRAM)
    anchor = (_sliding_min((grams & _HIGH) | np.arange(len(grams), dtype=np.uint64), LENGTH - GRAM + 1) & _LOW).astype(np.int64)
    windows = np.maximum(np.diff(offsets) - LENGTH + 1, 0)
    row = np.repeat(np.arange(len(windows)), windows)
    at = _text.concat_ranges(offsets[:-1], windows)
    anchor = anchor[at]
    new = np.ones(len(at), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(at)]]) - 1 if len(first) else first
    lo, hi, a = at[first], at[last], anchor[first]
    return row[first], lo, hi, a, grams[a].view(np.int64), rolling.ranges(lo, hi + LENGTH).view(np.int64)


def segment_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, th, text) → one row for each segment."""
    for batch in batches:
        for part in _text.slices(batch, "text"):
            data, offsets = _text.buffers(part.column("text"))
            row, lo, hi, a, gram, seg = segments(data, offsets)
            base = offsets[:-1][row]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").take(pa.array(row)), part.column("th").take(pa.array(row)), *(pa.array(x) for x in (lo - base, hi - base, a - base, gram, seg))],
                ["doc_id", "th", "lo", "hi", "a", "gram", "seg"],
            )


def suffix_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with their segments → the suffixes to be sorted: bytes from the anchor on, and before it."""
    for batch in batches:
        text, offsets = _text.buffers(batch.column("text"))
        raw = text.tobytes()
        rows: list[tuple] = []
        for i, (doc, th, segs) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("th").to_pylist(), batch.column("segs").to_pylist(), strict=True)):
            at = int(offsets[i])
            for s in segs:
                if s["compare"]:
                    lo, hi, a = at + s["lo"], at + s["hi"], at + s["a"]
                    rows.append((raw[a : a + LEAD], s["gram"], ((doc or 0) ^ th ^ s["lo"]) if s["split"] else 0, s["split"], doc, th, s["lo"], s["hi"], s["a"], raw[a : hi + LENGTH], raw[lo:a][::-1], not s["settled"]))
            if len(rows) > 4000:
                yield _suffixes(rows)
                rows = []
        yield _suffixes(rows)


_SUFFIX = "lead binary, gram long, tie long, split boolean, doc_id long, th long, lo long, hi long, a long, after binary, before binary, wanted boolean"
_SUFFIX_TYPES = {"lead": pa.binary(), "after": pa.binary(), "before": pa.binary(), "wanted": pa.bool_(), "split": pa.bool_()}


def _suffixes(rows: list[tuple]) -> pa.RecordBatch:
    names = [x.split()[0] for x in _SUFFIX.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, type=_SUFFIX_TYPES.get(n, pa.int64())) for n, c in zip(names, columns, strict=True)], names)


def multikey_sort(column: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of byte strings and the common length of each with the one before it (0 for the first).

    A multikey quicksort: rows that are equal so far form groups, and the next 8 bytes part every group; only groups of
    two or more go on. Strings count as if padded with zero bytes up to ``length``.
    """
    n, width = len(column), -(-length // 8)
    data, offsets = _text.buffers(column)
    grid = np.zeros((n, width * 8), dtype=np.uint8)
    sizes = np.minimum(np.diff(offsets), width * 8)
    grid[np.repeat(np.arange(n), sizes), _text.concat_ranges(np.zeros(n, dtype=np.int64), sizes)] = data[_text.concat_ranges(offsets[:-1], sizes)]
    keys = grid.view(">u8").astype(np.uint64)
    order, common = np.arange(n), np.zeros(n, dtype=np.int64)
    open_at, group = np.arange(n), np.zeros(n, dtype=np.int64)
    for k in range(width):
        if not len(open_at):
            break
        here = keys[order[open_at], k]
        turn = np.lexsort((here, group))
        order[open_at] = order[open_at][turn]
        here = here[turn]
        together = np.zeros(len(open_at), dtype=bool)
        together[1:] = group[1:] == group[:-1]
        equal = together.copy()
        equal[1:] &= here[1:] == here[:-1]
        parted = np.flatnonzero(together & ~equal)
        common[open_at[parted]] = 8 * k + _equal_bytes(here[parted] ^ here[parted - 1])
        common[open_at[equal]] = 8 * k + 8
        alive = equal.copy()
        alive[:-1] |= equal[1:]
        open_at, group = open_at[alive], np.cumsum(~equal)[alive]
    return order, common


def _equal_bytes(x: np.ndarray) -> np.ndarray:
    """Leading zero bytes of 64-bit values that are not 0."""
    out = np.zeros(len(x), dtype=np.int64)
    for byte in range(1, 8):
        out += x < np.uint64(1) << np.uint64(64 - 8 * byte)
    return out


def bucket_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One bucket of the suffix order → settled spans (lo, hi) and windows to compare across boundaries (w1, w2)."""
    parts = [b for b in batches if b.num_rows]
    if not parts:
        return
    table = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
    del parts
    order, common = multikey_sort(table.column("after"), LENGTH)
    table, n = table.take(pa.array(order)), table.num_rows
    left_order, left_common = multikey_sort(table.column("before"), LENGTH - GRAM)
    lo, hi, a = (table.column(c).to_numpy() for c in ("lo", "hi", "a"))
    wanted = table.column("wanted").to_numpy(zero_copy_only=False)
    left_class = np.zeros(n, dtype=np.int64)
    shared = np.zeros((n, LENGTH - GRAM + 1), dtype=bool)
    for d in range(LENGTH - GRAM + 1):
        at = np.flatnonzero((d <= a - lo) & (d >= a - hi))
        if len(at) < 2:
            continue
        left_class[left_order] = np.cumsum(left_common < d) if d else 0
        code = np.cumsum(common < LENGTH - d)[at] * np.int64(n + 1) + left_class[at]
        _, which, count = np.unique(code, return_inverse=True, return_counts=True)
        shared[at, d] = count[which] > 1
    yield _spans(table, np.where(wanted[:, None], shared, False), a)
    split = np.flatnonzero(table.column("split").to_numpy(zero_copy_only=False))
    seen: set[tuple[int, int]] = set()
    for i in split.tolist():
        yield _window_rows(table.slice(i, 1), shared[i], lo[i], hi[i], a[i], wanted[i], seen)


_BUCKET = "doc_id long, th long, lo long, hi long, w1 long, w2 long"
_BUCKET_NAMES = [x.split()[0] for x in _BUCKET.split(", ")]


def _bucket_batch(doc_id, th, lo, hi, w1=None, w2=None) -> pa.RecordBatch:
    none = pa.nulls(len(lo), pa.int64())
    return pa.RecordBatch.from_arrays([doc_id, th, pa.array(lo, type=pa.int64()), pa.array(hi, type=pa.int64()), none if w1 is None else pa.array(w1), none if w2 is None else pa.array(w2)], _BUCKET_NAMES)


def _spans(table: pa.RecordBatch, shared: np.ndarray, a: np.ndarray) -> pa.RecordBatch:
    """Runs of shared windows as byte ranges; column d of ``shared`` is the window that starts d before the anchor."""
    edge = np.zeros((len(shared), shared.shape[1] + 2), dtype=np.int8)
    edge[:, 1:-1] = shared
    step = np.diff(edge, axis=1)
    row, first = np.nonzero(step == 1)
    _, past = np.nonzero(step == -1)
    take = pa.array(row)
    return _bucket_batch(table.column("doc_id").take(take), table.column("th").take(take), a[row] - past + 1, a[row] - first + LENGTH)


def _window_rows(one: pa.RecordBatch, shared: np.ndarray, lo: int, hi: int, a: int, wanted: bool, seen: set) -> pa.RecordBatch:
    """Hashes of a suffix's windows. Those that the bucket has settled stand for their text only, once in a bucket."""
    text = one.column("before")[0].as_py()[::-1] + one.column("after")[0].as_py()
    data = np.frombuffer(text, dtype=np.uint8)
    w1 = _text.Rolling(data).windows(LENGTH).view(np.int64)
    w2 = _text.Rolling(data, _SECOND, _SECOND_INVERSE).windows(LENGTH).view(np.int64)
    start = np.arange(lo, hi + 1)
    settled = shared[a - start] | (not wanted)
    keep = ~settled
    for i in np.flatnonzero(settled).tolist():
        key = (int(w1[i]), int(w2[i]))
        if key not in seen:
            seen.add(key)
            keep[i] = True
    doc, th, n = one.column("doc_id")[0].as_py(), one.column("th")[0].as_py(), int(keep.sum())
    at = np.where(settled, -1, start)[keep]
    return _bucket_batch(pa.array([doc] * n, type=pa.int64()), pa.array([th] * n, type=pa.int64()), at, np.where(at < 0, -1, at + LENGTH), w1[keep], w2[keep])


def removal_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with all their spans → what is left of them."""
    for batch in batches:
        data, offsets = _text.buffers(batch.column("text"))
        out: list[tuple] = []
        for i, (segs, more) in enumerate(zip(batch.column("segs").to_pylist(), batch.column("spans").to_pylist(), strict=True)):
            text = data[offsets[i] : offsets[i + 1]]
            edge = np.zeros(len(text) + 1, dtype=np.int64)
            spans = [(s["lo"], s["hi"] + LENGTH) for s in segs if s["settled"]] + [(s["lo"], s["hi"]) for s in more or ()]
            if spans:
                at = np.array(spans)
                np.add.at(edge, at[:, 0], 1)
                np.add.at(edge, at[:, 1], -1)
            gone = np.cumsum(edge)[:-1] > 0
            first = gone.copy()
            first[1:] &= ~gone[:-1]
            kept = text[~gone].tobytes()
            out.append((int(gone.sum()), int(first.sum()), kept, hashlib.sha256(kept).hexdigest()))
        columns = list(zip(*out, strict=True)) if out else [[], [], [], []]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("th"), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.binary()), pa.array(columns[3], pa.string())],
            ["doc_id", "th", "n_removed", "n_spans", "kept", "kept_sha256"],
        )


def _same(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join on the document key, of which doc_id can be null."""
    right = right.withColumnsRenamed({"doc_id": "_d", "th": "_h"})
    out = left.join(right, left.doc_id.eqNullSafe(right._d) & (left.th == right._h), how)
    return out.drop("_d", "_h")


def repeated_spans(docs: DataFrame) -> DataFrame:
    """Documents that hold a repeated string: doc_id, th, text, segs (settled ones) and spans."""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("th", F.xxhash64("text"))
    rows = save(texts.select("doc_id", "th", "text").mapInArrow(segment_rows, "doc_id long, th long, lo long, hi long, a long, gram long, seg long"), "segments")
    grams = rows.groupBy("gram").agg(F.count("*").alias("n"), F.min("seg").alias("s0"), F.max("seg").alias("s1")).where("n > 1").select("gram", (F.col("s0") != F.col("s1")).alias("mixed"), (F.col("n") > SPLIT).alias("split"))
    # written first: a join that shuffles a plain table by itself can split a very frequent gram over tasks
    grams = save(grams, "grams")
    found = save(rows.join(grams, "gram"), "shared")
    key = F.struct("doc_id", "th", "lo")
    sets = save(found.where("mixed").groupBy("gram", "seg").agg(F.count("*").alias("c"), F.min(key).alias("one")), "sets")
    judged = found.join(sets, ["gram", "seg"], "left").select(
        "doc_id", "th",
        F.struct("lo", "hi", "a", "gram", "split", (~F.col("mixed") | (F.col("c") > 1)).alias("settled"), (F.col("mixed") & ((F.col("c") == 1) | F.col("one").eqNullSafe(key))).alias("compare")).alias("s"),
    )
    work = save(_same(texts, judged.groupBy("doc_id", "th").agg(F.collect_list("s").alias("segs")), "inner"), "work")
    suffixes = work.mapInArrow(suffix_rows, _SUFFIX)
    buckets = save(suffixes.repartitionByRange("lead", "gram", "tie").mapInArrow(bucket_rows, _BUCKET), "buckets")
    windows = buckets.where("w1 is not null")
    twice = windows.groupBy("w1", "w2").agg(F.count("*").alias("n")).where("n > 1").select("w1", "w2")
    across = windows.where("lo >= 0").join(twice, ["w1", "w2"], "left_semi")
    spans = buckets.where("w1 is null").unionByName(across).groupBy("doc_id", "th").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    return _same(work.select("doc_id", "th", "text", "segs"), spans, "left")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Remove each byte under a 400-byte string that starts at two or more places of all documents.

    ``docs`` needs doc_id and text; other columns are ignored. Returns for each row doc_id, n_bytes, n_removed, n_spans
    (maximal removed runs), kept_sha256 and kept (the remaining bytes; null where nothing was removed). Strings are
    judged on the input; occurrences may overlap and may lie in one document. A null text is an empty one; texts under
    400 bytes lose nothing. A repeated row is an occurrence of its own, so both rows lose what they share. A null
    doc_id stays null. An empty table gives an empty result. Cuts may fall inside a multi-byte character, so ``kept``
    is binary.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    whole = texts.select("doc_id", F.xxhash64("text").alias("th"), F.octet_length("text").cast("long").alias("n_bytes"), F.sha2(F.col("text").cast("binary"), 256).alias("whole"))
    cut = repeated_spans(docs).mapInArrow(removal_rows, "doc_id long, th long, n_removed long, n_spans long, kept binary, kept_sha256 string")
    cut = cut.dropDuplicates(["doc_id", "th"])
    zero = F.lit(0).cast("long")
    return _same(whole, cut, "left").select("doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"), F.coalesce("kept_sha256", "whole").alias("kept_sha256"), "kept")


def op5_query(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("kept")
