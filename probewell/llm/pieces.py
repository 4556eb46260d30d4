"""SentencePiece (merge type) encoding with a seeded merge dropout, and its decoding.

Encoding starts from single characters and keeps an agenda of adjacent pairs whose union is a piece; the pair with the
best score merges next, the leftmost of equals. With dropout, a pair is skipped when a hash of the seed, the document and
the pair's three boundaries falls under the dropout rate: the same input always gives the same pieces, another seed gives
others. No piece reaches over the start of a word, so each word (with the spaces before it) has an agenda of its
own, and words of equal length are worked off side by side as the rows of a matrix.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _text

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SEED, DROPOUT = 17, 0.1
#: Characters up to which words are worked off in matrices; a longer one has an agenda in a heap.
MATRIX = 64
#: Text bytes encoded at once.
SLICE = 1 << 19
_NEVER = np.int32(2**31 - 1)
_MARK = "▁"
_BITS = 20


class Model:
    """Pieces, ranks and the table of pairs that merge. Id -1 stands for a character without a piece."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (sp.is_unknown(i) or sp.is_control(i) or sp.is_byte(i) or sp.is_unused(i))]
        if any(_MARK in names[i].lstrip(_MARK) for i in plain):
            raise ValueError("a piece of this model reaches over the start of a word")
        by_name = {names[i]: i for i in plain}
        self.byte_ids = np.full(256, -1, dtype=np.int32)
        for i in range(n):
            if sp.is_byte(i):
                self.byte_ids[int(names[i][3:5], 16)] = i
        if (self.byte_ids < 0).any():
            raise ValueError("the model lacks byte pieces, so some texts could not be decoded")
        self.chars = np.full(0x110000, -1, dtype=np.int32)
        for i in plain:
            if len(names[i]) == 1:
                self.chars[ord(names[i])] = i
        self.chars[32] = by_name[_MARK]
        self.chars[ord(_MARK)] = -1  # as bytes: decoding must tell it from a space
        # equal scores share a rank, so that the leftmost of them merges first
        levels = {s: r for r, s in enumerate(sorted({sp.get_score(i) for i in plain}, reverse=True))}
        pairs = [(by_name[p[:k]], by_name[p[k:]], i) for p, i in by_name.items() for k in range(1, len(p)) if p[:k] in by_name and p[k:] in by_name]
        self.slots = np.full(1 << _BITS, -1, dtype=np.int64)
        self.merged = np.zeros(1 << _BITS, dtype=np.int32)
        self.rank = np.full(1 << _BITS, _NEVER, dtype=np.int32)
        for a, b, i in pairs:
            key = a << 20 | b
            at = self._slot(key)
            while self.slots[at] >= 0:
                at = (at + 1) & ((1 << _BITS) - 1)
            self.slots[at], self.merged[at], self.rank[at] = key, i, levels[sp.get_score(i)]
        spoken = set(plain)
        data = [bytes([int(names[i][3:5], 16)]) if sp.is_byte(i) else names[i].replace(_MARK, " ").encode() if i in spoken else b"" for i in range(n)]
        self.piece_offsets = np.concatenate([[0], np.cumsum([len(d) for d in data])]).astype(np.int64)
        self.piece_bytes = np.frombuffer(b"".join(data), dtype=np.uint8)

    @staticmethod
    def _slot(key):
        if isinstance(key, np.ndarray):
            return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _BITS)).astype(np.int64)
        return (key * 0x9E3779B97F4A7C15 & (2**64 - 1)) >> (64 - _BITS)

    def lookup(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and piece of the unions; rank ``_NEVER`` where there is none."""
        key = (a.astype(np.int64) << 20) | b
        key[(a < 0) | (b < 0)] = -2
        at = self._slot(key)
        found = self.slots[at]
        rank, merged = self.rank[at], self.merged[at]
        wrong = np.flatnonzero((found != key) & (found >= 0))
        rank[found != key] = _NEVER
        while len(wrong):
            at = (at[wrong] if len(at) != len(wrong) else at) + 1 & ((1 << _BITS) - 1)
            found = self.slots[at]
            hit = found == key[wrong]
            rank[wrong[hit]], merged[wrong[hit]] = self.rank[at[hit]], self.merged[at[hit]]
            more = ~hit & (found >= 0)
            wrong, at = wrong[more], at[more]
        return rank, merged


@lru_cache(4)
def model(path: str) -> Model:
    return Model(path)


def _skipped(key, start, middle, end, limit: int):
    """Whether the keyed hash drops the pair of [start, middle) and [middle, end)."""
    with np.errstate(over="ignore"):
        h = key + start.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + middle.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) + end.astype(np.uint64) * np.uint64(0x165667B19E3779F9)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0x94D049BB133111EB)
    return h < np.uint64(limit)


def _merge_matrix(m: Model, ids: np.ndarray, key: np.ndarray, base: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of equal length → the rows' pieces (flat, row by row) and their number. ``base``: place of a row in its text."""
    n, length = ids.shape
    out, count = np.empty((n, length), dtype=np.int32), np.full(n, length)
    alive = np.arange(n)
    ids = ids.copy()
    edge = np.broadcast_to(np.arange(length + 1), (n, length + 1)).astype(np.int32)

    def ranks(a, b, rows, s, mid, e):
        r, piece = m.lookup(a, b)
        if limit:
            live = np.flatnonzero(r != _NEVER)
            drop = _skipped(key[rows[live]], base[rows[live]] + s[live], base[rows[live]] + mid[live], base[rows[live]] + e[live], limit)
            r[live[drop]] = _NEVER
        return r, piece

    width = length
    if width > 1:
        rows = np.repeat(alive, width - 1)
        r, piece = ranks(ids[:, :-1].ravel(), ids[:, 1:].ravel(), rows, edge[:, :-2].ravel(), edge[:, 1:-1].ravel(), edge[:, 2:].ravel())
        r, piece = r.reshape(n, -1), piece.reshape(n, -1)
    while width > 1 and len(alive):
        best = r.argmin(axis=1)
        line = np.arange(len(alive))
        done = r[line, best] == _NEVER
        if done.any():
            out[alive[done], :width], count[alive[done]] = ids[done], width
            go = ~done
            alive, ids, edge, r, piece, best = alive[go], ids[go], edge[go], r[go], piece[go], best[go]
            if not len(alive):
                break
            line = np.arange(len(alive))
        ids[line, best] = piece[line, best]
        shift = np.arange(width - 1)[None, :] > best[:, None]
        ids = np.where(shift, ids[:, 1:], ids[:, :-1])
        edge = np.where(np.arange(width)[None, :] > best[:, None], edge[:, 1:], edge[:, :-1])
        width -= 1
        if width == 1:
            break
        # of the pairs, the one at ``best`` goes; its neighbours are looked up anew
        keep = np.arange(width - 1)[None, :] >= best[:, None]
        r, piece = np.where(keep, r[:, 1:], r[:, :-1]), np.where(keep, piece[:, 1:], piece[:, :-1])
        for side in (-1, 0):
            at = best + side
            ok = np.flatnonzero((at >= 0) & (at < width - 1))
            p = at[ok]
            r[ok, p], piece[ok, p] = ranks(ids[ok, p], ids[ok, p + 1], alive[ok], edge[ok, p], edge[ok, p + 1], edge[ok, p + 2])
    out[alive, :width], count[alive] = ids, width
    return out[np.arange(length)[None, :] < count[:, None]], count


def merge_heap(m: Model, ids: np.ndarray, key: int, base: int, limit: int) -> list[int]:
    """The agenda of one long word: a heap of pairs over a linked list of symbols."""
    n = len(ids)
    symbol, before, after, end = ids.tolist(), list(range(-1, n - 1)), list(range(1, n + 1)), list(range(1, n + 1))
    heap: list[tuple[int, int, int, int, int]] = []
    word = np.array([key], dtype=np.uint64)

    def push(starts: list[int]) -> None:
        starts = [s for s in starts if s >= 0 and after[s] < n]
        if not starts:
            return
        mid = [after[s] for s in starts]
        r, piece = m.lookup(np.array([symbol[s] for s in starts], dtype=np.int32), np.array([symbol[t] for t in mid], dtype=np.int32))
        drop = _skipped(word, base + np.array(starts), base + np.array(mid), base + np.array([end[t] for t in mid]), limit) if limit else np.zeros(len(starts), dtype=bool)
        for s, t, rank, p, skip in zip(starts, mid, r.tolist(), piece.tolist(), drop.tolist(), strict=True):
            if rank != _NEVER and not skip:
                heapq.heappush(heap, (rank, s, t, end[t], p))

    push(list(range(n - 1)))
    gone = [False] * n
    while heap:
        _, s, t, e, p = heapq.heappop(heap)
        if gone[s] or gone[t] or after[s] != t or end[t] != e:
            continue
        symbol[s], gone[t], end[s], after[s] = p, True, end[t], after[t]
        if after[t] < n:
            before[after[t]] = s
        push([before[s], s])
    return [symbol[i] for i in range(n) if not gone[i]]


def encode_slice(m: Model, data: np.ndarray, offsets: np.ndarray, keys: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 rows → piece ids of all rows and each row's offsets. ``keys``: the hash key of each row."""
    text = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
    starts = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    size = np.diff(starts)
    full = np.flatnonzero(size > 0)
    n = len(offsets) - 1
    if not len(full):
        return np.zeros(0, np.int32), np.zeros(n + 1, np.int64)
    text = np.insert(text, starts[:-1][full], 32)  # the space that stands before every text
    first = starts[:-1][full] + np.arange(len(full))
    space = text == 32
    opens = space.copy()
    opens[1:] &= ~space[:-1]
    opens[first] = True
    word = np.flatnonzero(opens)
    length = np.diff(np.concatenate([word, [len(text)]]))
    owner = np.searchsorted(first, word, side="right") - 1
    place = word - first[owner]
    symbols = m.chars[text]
    out: list[np.ndarray] = []
    which: list[np.ndarray] = []
    counts: list[np.ndarray] = []
    order = np.argsort(length, kind="stable")
    bounds = np.searchsorted(length[order], np.arange(1, MATRIX + 2))
    word_key = keys[full][owner]
    for k in range(1, MATRIX + 1):
        at = order[bounds[k - 1] : bounds[k]]
        if len(at):
            pieces, count = _merge_matrix(m, symbols[word[at][:, None] + np.arange(k)], word_key[at], place[at], limit)
            out.append(pieces)
            which.append(at)
            counts.append(count)
    for i in order[bounds[MATRIX] :].tolist():
        pieces = merge_heap(m, symbols[word[i] : word[i] + length[i]], int(word_key[i]), int(place[i]), limit)
        out.append(np.array(pieces, dtype=np.int32))
        which.append(np.array([i]))
        counts.append(np.array([len(pieces)]))
    which, counts, flat = np.concatenate(which), np.concatenate(counts), np.concatenate(out)
    begin = np.cumsum(counts) - counts
    back = np.argsort(which, kind="stable")
    ids = flat[_text.concat_ranges(begin[back], counts[back])]
    per_word = counts[back]
    row = np.repeat(full[owner], per_word)
    # characters without a piece become the pieces of their bytes
    bare = np.flatnonzero(ids < 0)
    if len(bare):
        raw = "".join(map(chr, text[symbols < 0].tolist())).encode("utf-8")
        wide = np.ones(len(ids), dtype=np.int64)
        code = text[symbols < 0]
        wide[bare] = 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF)
        grown = np.repeat(ids, wide)
        grown[grown < 0] = m.byte_ids[np.frombuffer(raw, dtype=np.uint8)]
        ids, row = grown, np.repeat(row, wide)
    return ids, np.searchsorted(row, np.arange(n + 1))


def decode_slice(m: Model, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of rows → UTF-8 bytes and their offsets, without the space before each text."""
    size = m.piece_offsets[ids + 1] - m.piece_offsets[ids]
    data = m.piece_bytes[_text.concat_ranges(m.piece_offsets[ids], size)]
    at = np.concatenate([[0], np.cumsum(size)])[offsets]
    full = at[1:] > at[:-1]
    lead = at[:-1][full]
    keep = np.ones(len(data), dtype=bool)
    keep[lead[data[lead] == 32]] = False
    return data[keep], np.concatenate([[0], np.cumsum(keep)])[at]


def row_keys(doc_ids: pa.Array, seed: int, copies: pa.Array | None = None) -> np.ndarray:
    """The hash key of each row; copy 1 (or null) of a document has the key of the document alone."""
    ids = doc_ids.cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)
    key = _text.mix(ids.view(np.uint64) + np.uint64(_text.mix_int(seed)))
    if copies is None:
        return key
    more = copies.cast(pa.int64()).fill_null(1).to_numpy(zero_copy_only=False) - 1
    return np.where(more == 0, key, _text.mix(key ^ (more.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))))


def encode(docs: DataFrame, seed: int = SEED, dropout: float = DROPOUT, path: str = MODEL) -> DataFrame:
    """``docs`` (doc_id, text) with ``pieces``, the array of piece ids; a column pieces is replaced, others stay.

    ``dropout`` 0 gives the library's own segmentation. The choice depends on seed, doc_id and place only, so repeated
    rows get equal pieces; null doc_ids share one key. Null and empty texts have no pieces. Characters without a piece,
    and the mark that stands for a space, become byte pieces, so that decoding gives every text back. Texts are
    encoded whole; an empty table gives an empty result. ``path`` must be readable on all executors.
    """
    docs = docs.drop("pieces")
    limit = min(int(dropout * 2**64), 2**64 - 1)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for batch in batches:
            for part in _text.slices(batch, "text", SLICE):
                data, offsets = _text.buffers(part.column("text"))
                ids, at = encode_slice(m, data, offsets, row_keys(part.column("doc_id"), seed), limit)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids))], [*part.schema.names, "pieces"])

    return docs.mapInArrow(rows, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields), "pieces array<int>"]))


def decode(encoded: DataFrame, path: str = MODEL) -> DataFrame:
    """``encoded`` with ``decoded``, the text of ``pieces`` (null or no pieces: empty); a column decoded is replaced."""
    encoded = encoded.drop("decoded")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for batch in batches:
            pieces = batch.column("pieces")
            sizes = pieces.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            data, at = decode_slice(m, pieces.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(sizes)]))
            text = pa.Array.from_buffers(pa.large_utf8(), batch.num_rows, [None, pa.py_buffer(at.astype(np.int64).tobytes()), pa.py_buffer(data.tobytes())]).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, text], [*batch.schema.names, "decoded"])

    return encoded.mapInArrow(rows, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields), "decoded string"]))


def encoded_rows(docs: DataFrame, seed: int = SEED, dropout: float = DROPOUT, path: str = MODEL) -> DataFrame:
    """doc_id, n_chars, n_pieces, pieces, decoded_sha256 and lossless (the pieces decode to the text), as ``encode`` defines them.

    A column copy_no of ``docs``, if there is one, enters the key, so that the copies of a document get different pieces;
    copy 1 and a null one have those of the document. Null texts are empty ones; an empty table gives an empty result. Encoding and decoding of a slice follow each other in one task, so that a row goes to Python once.
    """
    limit = min(int(dropout * 2**64), 2**64 - 1)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for batch in batches:
            for part in _text.slices(batch, "text", SLICE):
                data, offsets = _text.buffers(part.column("text"))
                ids, at = encode_slice(m, data, offsets, row_keys(part.column("doc_id"), seed, part.column("copy_no")), limit)
                back, ends = decode_slice(m, ids, at)
                raw, decoded = data.tobytes(), back.tobytes()
                spans = list(zip(offsets[:-1].tolist(), offsets[1:].tolist(), ends[:-1].tolist(), ends[1:].tolist(), strict=True))
                points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), pa.array(np.diff(points)), pa.array(np.diff(at)), pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids)),
                        pa.array([hashlib.sha256(decoded[c:d]).hexdigest() for _, _, c, d in spans], pa.string()), pa.array([raw[a:b] == decoded[c:d] for a, b, c, d in spans], pa.bool_()),
                    ],
                    ["doc_id", "n_chars", "n_pieces", "pieces", "decoded_sha256", "lossless"],
                )

    copy = F.col("copy_no").cast("long") if "copy_no" in docs.columns else F.lit(1).cast("long")
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), copy.alias("copy_no"))
    return texts.mapInArrow(rows, "doc_id long, n_chars long, n_pieces long, pieces array<int>, decoded_sha256 string, lossless boolean")


def op9_query(spark, sf_dir: str) -> DataFrame:
    return encoded_rows(spark.read.parquet(f"{sf_dir}/documents.parquet"))
