"""Packing tokenised documents into sequences of a fixed capacity, by harmonic classes.

A document is cut into pieces whose lengths are the capacity divided by 1, 2, 4, 8, ...: whole capacities first, then one piece
for each binary digit of what is left. Pieces of one length form a class, and a sequence of that class takes a fixed number of
pieces, so it is always full. Every worker numbers the pieces of each class by itself; the counts of all workers (a few numbers each)
tell where its numbers begin, and from its number a piece knows its sequence and offset. What a class has left for its last
sequence is dealt over shorter ones whose totals are powers of two, so no sequence needs padding.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import _text
from ._store import save

CAPACITY, END = 2048, 1
TOKENIZER = "word_bpe_49k.json"
#: Text bytes that are encoded at once, and words whose ids a worker remembers (some 100 MB).
SLICE, MEMORY = 1 << 22, 400_000

_WORD = np.ones(256, dtype=bool)
_WORD[[9, 10, 13, 32]] = False
_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[[ord(c) for c in ".,;:!?)#$%&*"]] = True
# words of Latin letters only, which no normal form changes; the tokenizer spells bytes that do not print as the code points from 256 on
_LATIN = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
_SPELLED = {b: 256 + i for i, b in enumerate([*range(33), *range(127, 161), 173])}


class Encoder:
    """Ids of a tokenizer whose words end at white space; each distinct word is encoded by the library once and remembered.

    A word is also cut between an ASCII letter and one of ``.,;:!?)#$%&*``, where this tokenizer always separates.
    """

    def __init__(self, path: str):
        import tokenizers

        self.library = tokenizers.Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}

    def _learn(self, words: list[bytes]) -> None:
        other, tokenize = [], self.library.model.tokenize
        for w in words:
            if _LATIN.fullmatch(w):
                low = w.lower().decode() if w.isascii() else w.decode().lower().encode().decode("latin-1").translate(_SPELLED)
                self.known[w] = array("I", [t.id for t in tokenize(low)]).tobytes()
            else:
                other.append(w)
        for w, found in zip(other, self.library.encode_batch_fast([w.decode() for w in other], add_special_tokens=False), strict=True):
            self.known[w] = array("I", found.ids).tobytes()

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """UTF-8 texts (bytes and row offsets) → ids and their row offsets."""
        word = _WORD[data]
        first = word.copy()
        first[1:] &= ~word[:-1] | (_STOP[data[1:]] & _LETTER[data[:-1]])
        inside = offsets[:-1][(offsets[:-1] < len(data)) & (offsets[:-1] < offsets[1:])]
        first[inside] = word[inside]
        start = np.flatnonzero(first)
        at = np.concatenate([np.cumsum(word) - word, [word.sum()]])[np.append(start, len(data))]  # places once white space is gone
        ends = pa.py_buffer(at.astype(np.int64).tobytes())
        coded = pa.Array.from_buffers(pa.large_binary(), len(start), [None, ends, pa.py_buffer(data[word].tobytes())]).dictionary_encode()
        words = coded.dictionary.to_pylist()
        if len(self.known) > MEMORY:
            self.known.clear()
        self._learn([w for w in words if w not in self.known])
        found = [self.known[w] for w in words]
        flat = np.frombuffer(b"".join(found), dtype=np.uint32)
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) >> 2
        begins = np.cumsum(sizes) - sizes
        index = coded.indices.to_numpy(zero_copy_only=False)
        ids = flat[_text.concat_ranges(begins[index], sizes[index])] if len(index) else flat[:0]
        upto = np.concatenate([[0], np.cumsum(sizes[index])])
        return ids, upto[np.searchsorted(start, offsets)]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _ended(ids: np.ndarray, at: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows' ids, each row followed by ``end``."""
    out = np.full(len(ids) + len(at) - 1, end, dtype=np.uint32)
    out[np.arange(len(ids)) + np.repeat(np.arange(len(at) - 1), np.diff(at))] = ids
    return out, at + np.arange(len(at))


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """``docs`` (doc_id, text) → doc_id, start, length, ids (little-endian unsigned 32-bit numbers), doc_tokens, worker and place.

    A document's tokens are those of the library for the whole text, followed by ``end``. ``length`` is a power of two, at most
    ``capacity``; ``place`` numbers the pieces of one length within a task, from 0. A null text is an empty one and
    has the end token only; every row is a document of its own, whatever its doc_id; an empty table gives no pieces.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("the capacity has to be a power of two")
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(TOKENIZER)
    top = capacity.bit_length() - 1
    levels = np.arange(top, -1, -1)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, worker, seen = encoder(path).encode, TaskContext.get().partitionId(), np.zeros(top + 1, dtype=np.int64)
        for batch in batches:
            for part in _text.slices(batch, "text", SLICE):
                ids, at = _ended(*encode(*_text.buffers(part.column("text"))), end)
                n = np.diff(at)
                count = (n[:, None] >> levels) & 1
                count[:, 0] = n >> top
                level = np.repeat(np.tile(levels, len(n)), count.ravel())
                row = np.repeat(np.arange(len(n)), count.sum(axis=1))
                length = 1 << level
                stop = np.cumsum(length)  # the pieces lie behind each other in ids
                place = np.zeros(len(level), dtype=np.int64)
                for k in np.unique(level):
                    own = np.flatnonzero(level == k)
                    place[own] = seen[k] + np.arange(len(own))
                    seen[k] += len(own)
                ends = pa.py_buffer((np.concatenate([[0], stop]) * 4).astype(np.int32).tobytes())
                raw = pa.Array.from_buffers(pa.binary(), len(level), [None, ends, pa.py_buffer(ids.tobytes())])
                out = [part.column("doc_id").take(pa.array(row)), pa.array(stop - length - at[row]), pa.array(length), raw, pa.array(n[row]), pa.array(np.full(len(row), worker, dtype=np.int32)), pa.array(place)]
                yield pa.RecordBatch.from_arrays(out, ["doc_id", "start", "length", "ids", "doc_tokens", "worker", "place"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(rows, "doc_id long, start long, length long, ids binary, doc_tokens long, worker int, place long")


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """doc_id, start, length, ids, doc_tokens, sequence_id and offset of every piece of ``pieces``.

    Sequences are numbered from 0 without gaps; offsets within one have no gaps either. All sequences but the last few of each
    class (one for each binary digit of what is left there, and their totals are powers of two) hold exactly ``capacity`` tokens.
    The pieces are written once to the shared folder, so that the numbers of a lost task stay as they were counted. An empty
    table gives an empty one.
    """
    cut = save(pieces(docs, path, capacity, end), "token_pieces")
    counts = cut.groupBy("length", "worker").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("worker").rowsBetween(Window.unboundedPreceding, -1)  # a row for each worker
    base = save(counts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))), "piece_counts")
    totals = {r.length: r.n for r in base.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # a row for each class
    first, at = {}, 0
    for length in sorted(totals, reverse=True):
        first[length] = at
        whole, rest = divmod(totals[length], capacity // length)
        at += whole + rest.bit_count()

    def known(table: dict[int, int]):
        return F.create_map(*[F.lit(x) for k, v in table.items() for x in (k, v)])[F.col("length").cast("int")] if table else F.lit(0)

    fill = F.expr(f"{capacity} div length")
    number = cut.join(base.select("length", "worker", "base"), ["length", "worker"]).withColumn("_at", F.col("base") + F.col("place"))
    number = number.withColumn("_total", known(totals).cast("long")).withColumn("_first", known(first).cast("long")).withColumn("_fill", fill)
    number = number.withColumns({"_bin": F.expr("_at div _fill"), "_slot": F.expr("_at % _fill"), "_whole": F.expr("_total div _fill"), "_rest": F.expr("_total % _fill")})
    # the last pieces of a class: the highest digit in which slot and rest differ names the shorter sequence
    digit = F.length(F.bin(F.expr("_slot ^ _rest"))) - 1
    number = number.withColumn("_digit", F.when(F.col("_bin") < F.col("_whole"), F.lit(0)).otherwise(digit))
    above = F.expr("shiftright(_rest, _digit + 1)")
    sequence = F.when(F.col("_bin") < F.col("_whole"), F.col("_bin")).otherwise(F.col("_whole") + F.bit_count(above))
    slot = F.when(F.col("_bin") < F.col("_whole"), F.col("_slot")).otherwise(F.col("_slot") - F.expr("shiftleft(shiftright(_rest, _digit + 1), _digit + 1)"))
    return number.select("doc_id", "start", "length", "ids", "doc_tokens", (F.col("_first") + sequence).alias("sequence_id"), (slot * F.col("length")).alias("offset"))


def sequences(packed: DataFrame, capacity: int = CAPACITY, pad: int = 0) -> DataFrame:
    """sequence_id, n_tokens, ids (the pieces' ids one after another, little-endian) and doc_ids (one for each piece).

    A total that is not a power of two would be padded with ``pad`` up to ``capacity``; ``pack`` makes none. A sequence has
    at most ``capacity`` pieces.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids", "doc_id")))
    joined = packed.groupBy("sequence_id").agg(parts.alias("p"), F.sum("length").alias("n_tokens"))
    ids = F.aggregate("p.ids", F.lit(b""), lambda s, x: F.concat(s, x))
    odd = F.bit_count("n_tokens") > 1
    padding = F.when(odd, F.unhex(F.repeat(F.lit(pad.to_bytes(4, "little").hex()), (F.lit(capacity) - F.col("n_tokens")).cast("int")))).otherwise(F.lit(b""))
    return joined.select("sequence_id", "n_tokens", F.concat(ids, padding).alias("ids"), F.col("p.doc_id").alias("doc_ids"))


def op12_query(spark, sf_dir: str) -> DataFrame:
    """Every row of ``documents``, packed by ``pack``; the digest is that of a piece's ids."""
    packed = pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
