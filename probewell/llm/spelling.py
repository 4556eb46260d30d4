"""Grouping of spelling variants: words of a corpus that differ by one edit, and the frequent form of each.

The vocabulary is counted over all texts. Near words are the pairs that the composition acceptor . one edit . acceptor accepts,
where the acceptor is the minimised automaton of the vocabulary. Two words one edit apart, the shorter of s letters, share their
first or their last s // 2 letters; so the composed machine is cut by the state that it reaches over such a shared half (read
forwards, or backwards for the last letters), and each of these initial states is one partition with an acceptor of its
own. A partition with too many words, or with very long ones, is cut again by the halves of what its words do not share.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _text
from ._store import drop, save

#: Of the hashes of document and word, those that this number divides lose one code point.
DIVISOR = 97
SHORTEST, LEAST = 5, 3
#: How many times as frequent the form of a word has to be.
RATIO = 2
#: Words of a partition (90 letters and all pairs of them, 8,190 words, are the most that a last cut can leave), and letters that
#: they may differ in.
PARTITION, MIDDLE = 10_000, 64
#: Bytes from which a word's checksum is taken alone, and counted words that a task holds.
LONG, HELD = 48, 300_000
_GROUP = ["shorter", "prefix", "suffix", "bound", "shared"]

_LOW = np.arange(256, dtype=np.uint8)
_LOW[65:91] += 32
_ASCII = np.zeros(256, dtype=bool)
_ASCII[65:91] = _ASCII[97:123] = True


def _crc_table() -> np.ndarray:
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = np.where(out & 1, (out >> 1) ^ np.uint32(0xEDB88320), out >> 1)
    return out


_CRC = _crc_table()


def _checksums(data: np.ndarray, start: np.ndarray, end: np.ndarray, begun: np.ndarray) -> np.ndarray:
    """CRC-32 of the ranges, each continued from ``begun``; all words of a length advance together, byte by byte."""
    size = end - start
    order = np.argsort(size, kind="stable")
    size, at = size[order], start[order]
    state = begun[order] ^ np.uint32(0xFFFFFFFF)
    short = int(np.searchsorted(size, LONG, side="right"))
    for j in range(int(size[short - 1]) if short else 0):
        live = slice(int(np.searchsorted(size[:short], j, side="right")), short)
        state[live] = _CRC[(state[live] ^ data[at[live] + j]) & 0xFF] ^ (state[live] >> np.uint32(8))
    out = np.empty(len(size), dtype=np.uint32)
    out[order] = state ^ np.uint32(0xFFFFFFFF)
    for i in order[short:]:
        out[i] = zlib.crc32(data[start[i] : end[i]].tobytes(), int(begun[i]))
    return out


def _words(ids: list, data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """The words of the rows after the deletions, as binary values, in no order."""
    two = data == 0xC3  # in UTF-8 the letters from U+00C0 to U+00FF are this byte and another one
    letter = _ASCII[data] | two
    letter[1:] |= two[:-1]
    first, last = letter.copy(), letter.copy()
    first[1:] &= ~letter[:-1]
    last[:-1] &= ~letter[1:]
    full = offsets[:-1] < offsets[1:]
    first[offsets[:-1][full]] = letter[offsets[:-1][full]]
    last[offsets[1:][full] - 1] = letter[offsets[1:][full] - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    low = _LOW[data]
    row = np.searchsorted(offsets, start, side="right") - 1
    begun = np.array([zlib.crc32(f"{i}:".encode()) if i is not None else 0 for i in ids], dtype=np.uint32)
    hashed = np.array([i is not None for i in ids], dtype=bool)
    sums_of = _checksums(low, start, end, begun[row])
    cut = (sums_of % DIVISOR == 0) & hashed[row]
    sums = np.concatenate([[0], np.cumsum(letter)])
    points = end - start - np.diff(np.concatenate([[0], np.cumsum(two)])[np.stack([start, end])], axis=0)[0]
    ends = np.append(sums[start], sums[-1])
    every = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(ends.astype(np.int64).tobytes()), pa.py_buffer(low[letter].tobytes())])
    changed = []
    for i in np.flatnonzero(cut):
        raw = low[start[i] : end[i]].tobytes()
        at = int(sums_of[i]) % int(points[i])
        run = raw.decode()
        if len(run) > SHORTEST:
            changed.append((run[:at] + run[at + 1 :]).encode())
    kept = every.filter(pa.array(~cut & (points >= SHORTEST)))
    return pa.concat_arrays([kept, pa.array(changed, pa.large_binary())])


def counted(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) → word and n, the words of all texts and how often each occurs.

    A word is a maximal run of letters (A-Z, a-z and U+00C0 to U+00FF), A-Z lower-cased; where the CRC-32 of doc_id, a colon and
    the run is divisible by 97, the run loses the code point at that hash modulo its length. Words of less than five code
    points do not count. Null texts are empty ones, rows with a null doc_id have no hash and lose nothing, repeated rows count
    again. Words are counted in each task before they are shuffled.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def together() -> pa.Table:
            return pa.concat_tables(held).group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"])

        for batch in batches:
            for part in _text.slices(batch, "text", 4 * _text.SLICE_BYTES):
                found = _words(part.column("doc_id").to_pylist(), *_text.buffers(part.column("text"))).value_counts()
                held.append(pa.table({"word": found.field(0), "n": found.field(1)}))
                if sum(t.num_rows for t in held) > 2 * HELD:
                    held = [together()]
                    if held[0].num_rows > HELD:
                        yield from _as_text(held.pop())
        if held:
            yield from _as_text(together())

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(rows, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _as_text(table: pa.Table) -> Iterator[pa.RecordBatch]:
    for batch in pa.table({"word": table["word"].cast(pa.large_string()), "n": table["n"]}).to_batches(50_000):
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.string()), batch.column(1)], ["word", "n"])


class Acceptor:
    """The minimised automaton of sorted, distinct words: equal right languages are one state."""

    def __init__(self, words: list[str]):
        self.final: list[bool] = []
        self.arcs: list[tuple] = []
        self._known: dict[tuple, int] = {}
        self._common: dict[tuple, list[str]] = {}
        self._near: dict[int, list[tuple[str, str]]] = {}
        self.start = self._state(words, 0, len(words), 0)

    def _state(self, words: list[str], lo: int, hi: int, depth: int) -> int:
        final, arcs = len(words[lo]) == depth, []
        i = lo + final
        while i < hi:
            c, j = words[i][depth], i + 1
            while j < hi and words[j][depth] == c:
                j += 1
            arcs.append((c, self._state(words, i, j, depth + 1)))
            i = j
        key = (final, tuple(arcs))
        at = self._known.get(key)
        if at is None:
            at = self._known[key] = len(self.final)
            self.final.append(final)
            self.arcs.append(key[1])
        return at

    def common(self, p: int, q: int, but: str = "") -> list[str]:
        """What both states accept; ``but``: nothing that begins with this letter."""
        key = (p, q, but) if but or p <= q else (q, p, but)
        found = self._common.get(key)
        if found is None:
            found = [""] if self.final[p] and self.final[q] else []
            other = dict(self.arcs[q])
            for c, to in self.arcs[p]:
                if c in other and c != but:
                    found += [c + w for w in self.common(to, other[c])]
            self._common[key] = found
        return found

    def near(self, p: int | None = None) -> list[tuple[str, str]]:
        """Each unordered pair of accepted words that differ by one replaced, or one inserted, letter, the longer second.

        Before the edit both acceptors of the composition are in one state, as they have read the same; the edit is made
        where the words first differ, so a pair is accepted over one path.
        """
        p = self.start if p is None else p
        found = self._near.get(p)
        if found is None:
            found, arcs = [], self.arcs[p]
            for i, (c, to) in enumerate(arcs):
                for d, other in arcs[i + 1 :]:
                    found += [(c + w, d + w) for w in self.common(to, other)]
                found += [(w, c + w) for w in self.common(p, to, c)]
                found += [(c + a, c + b) for a, b in self.near(to)]
            self._near[p] = found
        return found


def _enumerate(shorter: int, prefix: int, suffix: int, bound: int, words: dict[str, int]) -> Iterator[tuple[str, int, int, str]]:
    """(word, near words found here, n of the most frequent one, that one) of a partition's words and their counts.

    Of the pairs whose shorter word has ``shorter`` letters and that first differ before ``bound``: all others are
    another partition's.
    """
    middles = {w[prefix : len(w) - suffix]: w for w in words}
    best: dict[str, list] = {}
    for a, b in Acceptor(sorted(middles)).near():
        x, y = middles[a], middles[b]
        if min(len(x), len(y)) != shorter:
            continue
        if bound - prefix <= min(len(a), len(b)) and a[: bound - prefix] == b[: bound - prefix]:
            continue
        for w, v in ((x, y), (y, x)):
            now, key = best.get(w), (-words[v], v)
            if now is None:
                best[w] = [1, key]
            else:
                now[0] += 1
                if key < now[1]:
                    now[1] = key
    return ((w, count, -key[0], key[1]) for w, (count, key) in best.items())


def _near_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by partition → a row for each word that has near words there."""

    def every() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in [*_GROUP, "word", "n"]), strict=True)

    out: list[tuple] = []
    for (shorter, prefix, suffix, bound, _), own in groupby(every(), key=lambda r: r[:5]):
        words = {r[5]: r[6] for r in own}
        if len(words) > 1:
            out.extend(_enumerate(shorter, prefix, suffix, bound, words))
        if len(out) > 20_000:
            yield _found(out)
            out = []
    if out:
        yield _found(out)


def _found(rows: list[tuple]) -> pa.RecordBatch:
    word, near, n, best = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(word, pa.string()), pa.array(near, pa.int64()), pa.array(n, pa.int64()), pa.array(best, pa.string())], ["word", "near", "best_n", "best"])


def _halved(rows: DataFrame) -> DataFrame:
    """Each row in the two partitions of its own: the first half of what its words need not share, and the last half."""
    half = "cast((shorter - prefix - suffix) div 2 as int)"
    first = f"struct(prefix + {half} as prefix, suffix, bound)"
    last = f"struct(prefix, suffix + {half} as suffix, least(bound, prefix + {half}) as bound)"
    # words of the first half agree on prefix + half letters, so they cannot differ before a bound that is not beyond it
    both = rows.select("word", "n", "shorter", F.explode(F.expr(f"filter(array({first}, {last}), x -> x.bound > x.prefix)")).alias("p")).select("word", "n", "shorter", "p.*")
    return both.withColumn("shared", F.expr("concat(substr(word, 1, prefix), '|', substr(word, length(word) - suffix + 1, suffix))"))


def near_words(words: DataFrame) -> DataFrame:
    """``words`` (word, n; each word once) → word, n_near, best_n and best: its near words' number, and the most frequent of them.

    Words without a near word have no row. Equal counts: the smallest in code-point order.
    """
    start = words.select("word", "n", F.expr(f"explode(filter(array(length(word), length(word) - 1), x -> x >= {SHORTEST}))").alias("shorter"))
    rows = _halved(start.selectExpr("word", "n", "shorter", "0 as prefix", "0 as suffix", f"{2**31 - 1} as bound"))
    done: DataFrame | None = None
    while True:
        # a last cut leaves a middle of one letter (two in the longer words), and so at most 90 + 90 * 90 words
        open_middle = F.col("shorter") - F.col("prefix") - F.col("suffix")
        large = save(rows.groupBy(*_GROUP).count().where((F.col("count") > 1) & (open_middle > 1) & ((F.col("count") > PARTITION) | (open_middle > MIDDLE))).select(*_GROUP), "partitions")
        if large.isEmpty():
            drop(large)
            break
        small = rows.join(large, _GROUP, "left_anti").select("word", "n", *_GROUP)
        done = small if done is None else done.unionByName(small)
        rows = _halved(rows.join(large, _GROUP, "left_semi"))
    rows = rows.select("word", "n", *_GROUP) if done is None else done.unionByName(rows.select("word", "n", *_GROUP))
    dealt = rows.repartition(*_GROUP).sortWithinPartitions(*_GROUP)
    found = dealt.mapInArrow(_near_rows, "word string, near long, best_n long, best string")
    least = F.min(F.struct((-F.col("best_n")).alias("k"), "best"))
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), least.alias("_least")).select("word", "n_near", (-F.col("_least.k")).alias("best_n"), F.col("_least.best").alias("best"))


def rooted(forms: DataFrame, max_rounds: int = 40) -> DataFrame:
    """``forms`` (word, form; no form null, no cycles) → word, root: the word at the end of its forms. Paths double in length each round."""
    now = save(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(max_rounds):
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        joined = save(now.join(ahead, "root", "left"), "roots")
        drop(now)
        moved = not joined.where("_next is not null").isEmpty()
        now = joined.select("word", F.coalesce("_next", "root").alias("root"))
        now._saved_at = joined._saved_at
        if not moved:
            return now
    raise RuntimeError(f"roots did not settle in {max_rounds} rounds")


def variants(docs: DataFrame, least: int = LEAST, ratio: int = RATIO) -> DataFrame:
    """``docs`` (doc_id, text) → word, form, root, n, n_near, form_n for each word of ``counted`` that occurs ``least`` times.

    Words are near if they differ by exactly one inserted, deleted or replaced code point. A word's form is its most frequent
    near word (ties: the smallest in code-point order) if that occurs ``ratio`` times as often at least, else null; its root is
    reached over forms, and is the word itself if it has none. Null, empty and repeated rows: see ``counted``. An empty table
    gives an empty one; other columns are not read.
    """
    words = save(counted(docs).where(F.col("n") >= least), "vocabulary")
    near = words.join(near_words(words), "word", "left")
    formed = F.col("best_n") >= ratio * F.col("n")
    table = save(near.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(formed, F.col("best")).alias("form"), F.when(formed, F.col("best_n")).alias("form_n")), "variants")
    roots = rooted(table.where("form is not null"))
    return table.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_query(spark, sf_dir: str) -> DataFrame:
    """Every word of all texts of ``documents``, as ``variants`` groups them."""
    return variants(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = f"""
WITH t0 AS (SELECT i, CAST(i AS BIGINT) AS c FROM range(256) r(i)),
{"".join(f"t{k + 1} AS (SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END AS c FROM t{k})," for k in range(8))}
crc AS (SELECT list(c ORDER BY i) AS t FROM t8),
runs AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents),
distinct_runs AS (SELECT doc_id, run, count(*) AS times FROM (SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM runs) GROUP BY ALL),
bytes AS (SELECT doc_id, run, times, flatten([CASE WHEN unicode(c) < 128 THEN [unicode(c)] ELSE [192 + (unicode(c) >> 6), 128 + (unicode(c) & 63)] END FOR c IN string_split(doc_id || ':' || run, '')]) AS b FROM distinct_runs),
hashed AS (SELECT run, times, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), [CAST(x AS BIGINT) FOR x IN b]), lambda s, x: xor(t[(xor(s, x) & 255) + 1], s >> 8)), 4294967295) AS h FROM bytes, crc),
cut AS (SELECT CASE WHEN h % {DIVISOR} = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word, times FROM hashed),
words AS (SELECT word, CAST(sum(times) AS BIGINT) AS n FROM cut WHERE length(word) >= {SHORTEST} GROUP BY word HAVING sum(times) >= {LEAST}),
less AS (SELECT word, i, substr(word, 1, i) || substr(word, i + 2) AS k FROM words, range(0, 200000) r(i) WHERE i < length(word)),
near AS (SELECT a.word, b.word AS v FROM less a JOIN less b ON a.i = b.i AND a.k = b.k AND a.word <> b.word
  UNION SELECT a.word, b.word FROM less a JOIN words b ON a.k = b.word UNION SELECT b.word, a.word FROM less a JOIN words b ON a.k = b.word),
best AS (SELECT near.word, count(*) AS n_near, min(struct_pack(k := -w.n, v := near.v)) AS best FROM near JOIN words w ON w.word = near.v GROUP BY near.word),
formed AS (SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN -b.best.k >= {RATIO} * w.n THEN b.best.v END AS form, CASE WHEN -b.best.k >= {RATIO} * w.n THEN -b.best.k END AS form_n FROM words w LEFT JOIN best b ON b.word = w.word)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n FROM formed f JOIN (
  WITH RECURSIVE up AS (SELECT word, word AS root FROM formed UNION ALL SELECT up.word, g.form FROM up JOIN formed g ON g.word = up.root WHERE g.form IS NOT NULL)
  SELECT up.word, up.root FROM up JOIN formed g ON g.word = up.root WHERE g.form IS NULL) r ON r.word = f.word
"""
