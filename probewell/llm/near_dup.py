"""MinHash near-duplicate groups with an LSH forest.

Each document's word shingles become a signature of ``ORDERS * STEP`` minima. The forest is a set of
sorted orders: order t reads the signature from place ``t * STEP`` on (cyclically). Spark range-partitions
and sorts all orders together; in a sorted order the documents that share the longest prefixes stand side by
side. A region is a run with one common prefix. A small region gives all its pairs. In a larger one each row is first
paired with its neighbour in the order and with the region's first row. Candidates are confirmed on the full
shingle sets, best candidates first, so that a large group costs about one comparison for each member. Then every
larger region that still holds more than one component gives all pairs across components: its rows are dealt
over blocks, each pair of blocks meets in one task, and only pairs whose long signatures are alike enough leave it. So every
pair with a common prefix in some order is compared or already linked, however dense its region is. Equal sets
are merged before all this: copies never meet in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _text
from ._store import save
from .components import components

WORDS = 5
ORDERS = 32
STEP = 4
#: Prefix values that a region shares at least.
MIN_DEPTH = 3
#: Prefix values by which an order is sorted, hence the largest depth.
MAX_DEPTH = 8
#: Rows of a region that is paired in full.
SMALL_REGION = 12
#: Next rows in a sorted order with which a row of a larger region is paired.
NEIGHBOURS = 1
#: Of 128 equal minima, those that a true pair at 0.75 misses about once in two million (96 - 5 * 4.9).
LEAST_EQUAL = 72
#: Rows of a block of a large region.
BLOCK = 2000
#: Minima, of 8 bits, by which the rows of large regions are compared; the first ones are those of the signature.
LONG = 640
#: Of LONG equal minima, those that a true pair at 0.75 misses about once in three million (480 - 5 * 10.95).
LEAST_LONG = 425
#: Hash values by which pairs are dealt over cells, at least, and bytes of text for each of them beyond.
LEAST_CELLS, CELL_BYTES = 6, 4 << 20
NUMERATOR, DENOMINATOR = 75, 100


def _sets(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row, sorted, and their offsets."""
    values, at = _text.shingles(_text.Words(data, offsets), width)
    parts = [np.unique(values[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
    return np.concatenate([*parts, np.zeros(0, np.uint64)]), np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)


def _reduce(f: np.ufunc, values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """``f`` over each row; rows without values get 0."""
    out = np.zeros(len(offsets) - 1, dtype=values.dtype)
    full = offsets[1:] > offsets[:-1]
    if full.any():
        out[full] = f.reduceat(values, offsets[:-1][full])
    return out


def signature_rows(batches: Iterator[pa.RecordBatch], width: int = WORDS, size: int = ORDERS * STEP) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) → doc_id, n_shingles, two 64-bit keys of the set, ``size`` minima of 32 bits."""
    keys = [np.uint64(_text.mix_int(i + 1) | 1) for i in range(size)]
    for batch in batches:
        for part in _text.slices(batch, "text"):
            values, at = _sets(*_text.buffers(part.column("text")), width)
            minima = np.empty((part.num_rows, size), dtype=np.int32)
            work = np.empty_like(values)
            for i, key in enumerate(keys):
                np.multiply(values ^ key, key, out=work)
                minima[:, i] = (_reduce(np.minimum, work, at) >> np.uint64(32)).astype(np.uint32).view(np.int32)
            sums = [_reduce(np.add, _text.mix(values + np.uint64(k)), at).view(np.int64) for k in (11, 77)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(np.diff(at)), *map(pa.array, sums), pa.ListArray.from_arrays(pa.array(np.arange(0, minima.size + 1, size, dtype=np.int32)), pa.array(minima.ravel()))],
                ["doc_id", "n_shingles", "k1", "k2", "sig"],
            )


def long_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) → rep, set size and the low bytes of ``LONG`` minima."""
    for part in signature_rows(batches, size=LONG):
        low = part.column("sig").flatten().to_numpy().astype(np.uint8)
        at = pa.py_buffer(np.arange(0, len(low) + 1, LONG, dtype=np.int32))
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("n_shingles"), pa.Array.from_buffers(pa.binary(), part.num_rows, [None, at, pa.py_buffer(low)])], ["rep", "n", "low"])


def neighbour_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (t, v0.., id) of sorted orders → candidate pairs (a, b) of their regions, and the members (region, a) of large ones.

    The end of a batch is carried over, so a region that spans batches is seen whole; of a region longer than
    ``CARRY`` rows the first row and the last ones are carried. The regions at both ends of a partition may go on in
    another one; their rows count as members of a large region.
    """
    carried, opening = None, True
    for batch in batches:
        table = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(batch.num_columns)])
        if carried is not None:
            table = np.concatenate([carried, table])
        same = (table[1:, : MIN_DEPTH + 1] == table[:-1, : MIN_DEPTH + 1]).all(axis=1)
        starts = np.concatenate([[0], np.flatnonzero(~same) + 1])
        last = int(starts[-1])
        if last:
            yield _pairs(_region_pairs(table[:last]), _members(table[:last], opening))
            opening = False
        carried = table[last:]
        if len(carried) > CARRY:
            yield _pairs(_region_pairs(carried), _members(carried, True))
            carried = np.concatenate([carried[:1], carried[-SMALL_REGION:]])
    if carried is not None:
        yield _pairs(_region_pairs(carried), _members(carried, True))


CARRY = 20_000


def _pairs(found: np.ndarray, members: np.ndarray) -> pa.RecordBatch:
    a, b = (np.concatenate([found[:, i], members[:, 0]]) for i in (0, 1))
    region = np.concatenate([np.zeros(len(found), np.int64), members[:, 1]])
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(region, mask=np.arange(len(a)) < len(found))], ["a", "b", "region"])


def _members(table: np.ndarray, opening: bool) -> np.ndarray:
    """(id, region) of the rows of regions over ``SMALL_REGION`` rows, and of the first region if ``opening``."""
    if not len(table):
        return np.zeros((0, 2), dtype=np.int64)
    same = (table[1:, : MIN_DEPTH + 1] == table[:-1, : MIN_DEPTH + 1]).all(axis=1)
    starts = np.concatenate([[0], np.flatnonzero(~same) + 1])
    sizes = np.diff(np.concatenate([starts, [len(table)]]))
    large = sizes > SMALL_REGION
    large[0] |= opening
    rows = table[np.repeat(large, sizes)]
    key = np.zeros(len(rows), dtype=np.uint64)
    for i in range(MIN_DEPTH + 1):
        key = _text.mix(key ^ rows[:, i].astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    return np.column_stack([rows[:, -1], key.view(np.int64)])


def _region_pairs(table: np.ndarray) -> np.ndarray:
    """Pairs of all regions in a sorted table."""
    none = np.zeros((0, 2), dtype=np.int64)
    if len(table) < 2:
        return none
    ids = table[:, -1]
    same = (table[1:, : MIN_DEPTH + 1] == table[:-1, : MIN_DEPTH + 1]).all(axis=1)
    starts = np.concatenate([[0], np.flatnonzero(~same) + 1])
    sizes = np.diff(np.concatenate([starts, [len(table)]]))
    small, out = sizes <= SMALL_REGION, []
    inside = np.repeat(small, sizes)
    region = np.repeat(np.arange(len(starts)), sizes)
    for gap in range(1, SMALL_REGION):
        hit = (region[gap:] == region[:-gap]) & (inside[gap:] if gap > NEIGHBOURS else True)
        if not hit.any():
            break
        out.append(np.column_stack([ids[:-gap][hit], ids[gap:][hit]]))
    for at, size in zip(starts[~small].tolist(), sizes[~small].tolist(), strict=True):
        out.append(np.column_stack([np.full(size - 1, ids[at]), ids[at + 1 : at + size]]))
    if not out:
        return none
    found = np.concatenate(out)
    found = np.column_stack([found.min(axis=1), found.max(axis=1)])
    return np.unique(found[found[:, 0] != found[:, 1]], axis=0)


def block_pairs(table: pa.Table, cells: int) -> pa.Table:
    """Rows (i, j, block, rep, component, n, low) of two blocks i and j of a region → pairs across components and blocks that may reach the threshold.

    The pairs come packed, as a row of lists for each cell (x, y) of the documents' hashes modulo ``cells``.
    """
    rep, component, n, block, i, j = (table.column(c).to_numpy() for c in ("rep", "component", "n", "block", "i", "j"))
    low = np.frombuffer(b"".join(table.column("low").to_pylist()), dtype=np.uint8).reshape(-1, LONG)
    within = i[0] == j[0]
    one, two = (np.arange(len(rep)),) * 2 if within else (np.flatnonzero(block == i[0]), np.flatnonzero(block == j[0]))
    turned = np.ascontiguousarray(low[two, : ORDERS * STEP].T)
    found = [np.zeros((0, 3), dtype=np.int64)]
    for at in range(0, len(one), 128):
        rows = one[at : at + 128]
        equal = np.zeros((len(rows), len(two)), dtype=np.uint8)
        for k in range(ORDERS * STEP):
            equal += low[rows, k][:, None] == turned[k]
        x, y = np.nonzero((equal >= LEAST_EQUAL) & (component[rows][:, None] != component[two]))
        x, y = rows[x], two[y]
        keep = np.minimum(n[x], n[y]) * DENOMINATOR >= np.maximum(n[x], n[y]) * NUMERATOR
        if within:
            keep &= x < y
        x, y = x[keep], y[keep]
        for k in range(0, len(x), 4096):
            p, q = x[k : k + 4096], y[k : k + 4096]
            total = (low[p] == low[q]).sum(axis=1)
            p, q, total = (v[total >= LEAST_LONG] for v in (p, q, total))
            found.append(np.column_stack([np.minimum(rep[p], rep[q]), np.maximum(rep[p], rep[q]), total]))
    return _packed(np.concatenate(found), cells)


_CELL = pa.schema([("x", pa.int64()), ("y", pa.int64()), ("a", pa.list_(pa.int64())), ("b", pa.list_(pa.int64())), ("equal", pa.list_(pa.int64()))])


def _packed(found: np.ndarray, cells: int) -> pa.Table:
    """Pairs (a, b, equal) → a row for each cell."""
    a, b = ((_text.mix(found[:, k].astype(np.uint64)) % np.uint64(cells)).astype(np.int64) for k in (0, 1))
    turn = np.lexsort((b, a))
    found, a, b = found[turn], a[turn], b[turn]
    new = np.ones(len(a), dtype=bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    first = np.flatnonzero(new)
    at = pa.array(np.concatenate([first, [len(a)]]).astype(np.int32))
    return pa.Table.from_arrays([pa.array(a[first]), pa.array(b[first]), *(pa.ListArray.from_arrays(at, pa.array(found[:, k])) for k in range(3))], schema=_CELL)


def _unpacked(table: pa.Table) -> np.ndarray:
    """The distinct pairs (a, b, equal) of the rows of a cell."""
    return np.unique(np.column_stack([pa.chunked_array(table.column(c).chunks).combine_chunks().flatten().to_numpy() for c in ("a", "b", "equal")]), axis=0)


def distinct_pairs(table: pa.Table) -> pa.Table:
    """The rows of a cell → one row."""
    x, y = (int(table.column(c)[0].as_py()) for c in ("x", "y"))
    found = _unpacked(table)
    return pa.Table.from_arrays([pa.array([x]), pa.array([y]), *(pa.array([found[:, k]], pa.list_(pa.int64())) for k in range(3))], schema=_CELL)


def confirm_cell(pairs: pa.Table, held: pa.Table) -> pa.Table:
    """The pairs of a cell and its documents (rep, component, text) → links between different components.

    The best pairs come first; a pair whose ends the cell has already linked is not compared.
    """
    rep, group = (held.column(c).to_numpy() for c in ("rep", "component"))
    sets, at = _sets(*_text.buffers(pa.chunked_array(held.column("text").chunks, pa.string()).combine_chunks()), WORDS)
    place = {r: k for k, r in enumerate(rep.tolist())}
    found = _unpacked(pairs)
    up = {g: g for g in group.tolist()}

    def root(g: int) -> int:
        while up[g] != g:
            up[g] = g = up[up[g]]
        return g

    out = []
    for a, b, _ in found[np.lexsort((found[:, 1], found[:, 0], -found[:, 2]))].tolist():
        i, j = place[a], place[b]
        c, d = root(int(group[i])), root(int(group[j]))
        if c != d:
            one, two = sets[at[i] : at[i + 1]], sets[at[j] : at[j + 1]]
            both = len(np.intersect1d(one, two, assume_unique=True))
            if DENOMINATOR * both >= NUMERATOR * (len(one) + len(two) - both):
                up[max(c, d)] = min(c, d)
                out.append((a, b))
    links = np.array(out, dtype=np.int64).reshape(-1, 2)
    return pa.table({"a": links[:, 0], "b": links[:, 1]})


def confirm_rows(batches: Iterator[pa.RecordBatch], width: int = WORDS) -> Iterator[pa.RecordBatch]:
    """Pairs with both texts → the pairs whose sets reach the threshold."""
    for batch in batches:
        for part in _text.slices(batch, "text_b"):
            one, at = _sets(*_text.buffers(part.column("text_a")), width)
            two, bt = _sets(*_text.buffers(part.column("text_b")), width)
            keep = np.zeros(part.num_rows, dtype=bool)
            for i in range(part.num_rows):
                x, y = one[at[i] : at[i + 1]], two[bt[i] : bt[i + 1]]
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep[i] = both > 0 and DENOMINATOR * both >= NUMERATOR * (len(x) + len(y) - both)
            yield part.select(["a", "b"]).filter(pa.array(keep))


def signatures(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text").mapInArrow(signature_rows, "doc_id long, n_shingles long, k1 long, k2 long, sig array<int>")


def candidates(reps: DataFrame) -> DataFrame:
    """(rep, sig) → (a, b, region): candidate pairs, with a null region; and for members of large regions the rep twice and its region."""
    size = ORDERS * STEP
    values = [F.element_at("sig", (F.col("t") * STEP + j) % size + 1).alias(f"v{j}") for j in range(MAX_DEPTH)]
    names = ["t", *(f"v{j}" for j in range(MAX_DEPTH)), "rep"]
    orders = reps.select("rep", "sig", F.explode(F.sequence(F.lit(0), F.lit(ORDERS - 1))).alias("t")).select("t", *values, "rep")
    ranged = orders.repartitionByRange(*names).sortWithinPartitions(*names)
    return ranged.mapInArrow(neighbour_rows, "a long, b long, region long").distinct()


def crowded(members: DataFrame, groups: DataFrame, docs: DataFrame) -> DataFrame:
    """(rep, region) of large regions → links (a, b) between components: all pairs of a region are compared, those that may reach the threshold on full sets.

    Pairs lie packed in cells of two hash values, and each cell gets a document's text once, not once for each pair.
    """
    known = groups.withColumnRenamed("node", "rep")
    rows = save(members.join(known, "rep", "left").select("region", "rep", F.coalesce("component", "rep").alias("component")), "members")
    mixed = rows.groupBy("region").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("size")).where("low < high")
    rows = save(rows.join(mixed.select("region", "size"), "region"), "mixed")
    ends = rows.select(F.col("rep").alias("doc_id"), "component").distinct()
    texts = save(docs.select("doc_id", "text").join(ends, "doc_id").dropDuplicates(["doc_id"]).withColumnRenamed("doc_id", "rep"), "texts")
    long = save(texts.select(F.col("rep").alias("doc_id"), "text").mapInArrow(long_rows, "rep long, n long, low binary"), "long")
    cells = max(LEAST_CELLS, -(-(texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // CELL_BYTES))
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("rep"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    dealt = dealt.select("region", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "rep", "component").join(long, "rep")
    schema = "x long, y long, a array<long>, b array<long>, equal array<long>"
    found = dealt.groupBy("region", "i", "j").applyInArrow(lambda table: block_pairs(table, cells), schema)
    found = save(found.groupBy("x", "y").applyInArrow(distinct_pairs, schema), "cells")
    held = found.select(F.col("x").alias("hx"), F.col("y").alias("hy"), F.explode(F.array_distinct(F.concat("a", "b"))).alias("rep")).join(texts, "rep")
    return found.groupBy("x", "y").cogroup(held.groupBy("hx", "hy")).applyInArrow(confirm_cell, "a long, b long")


def _confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    a = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    b = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    return pairs.select("a", "b").join(a.hint("merge"), "a").join(b.hint("merge"), "b").select("a", "b", "text_a", "text_b").mapInArrow(confirm_rows, "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Groups of documents whose 5-word shingle sets have a Jaccard similarity of 0.75 or more.

    ``docs`` needs doc_id and text; other columns are ignored. Returns for each row doc_id, n_shingles (set
    size), component_id (smallest doc_id reachable over links, itself included), kept (doc_id =
    component_id) and copy_of (smallest doc_id with the same set).

    Null and empty texts and texts of white space have an empty set and are linked with nothing. A doc_id is
    taken to name one text; a repeated row gets the same group as its twin. Rows with a null doc_id keep a null
    component and are kept. An empty table gives an empty result. Texts are read whole.
    """
    rows = save(signatures(docs), "signatures")
    full = rows.where("n_shingles > 0 and doc_id is not null")
    reps = save(
        full.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"), F.first("sig").alias("sig"), F.first("n_shingles").alias("n_shingles")),
        "sets",
    )
    # each set counts its members' smallest id; two sets can share one where an id is repeated with other texts
    found = save(candidates(reps.select("rep", "sig")), "candidates")
    signed = reps.dropDuplicates(["rep"])
    sizes = [signed.select(F.col("rep").alias(x), F.col("sig").alias(f"sig_{x}"), F.col("n_shingles").alias(f"n_{x}")) for x in "ab"]
    equal = F.aggregate(F.zip_with("sig_a", "sig_b", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    least, most = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    pairs = found.where("region is null")
    likely = pairs.join(sizes[0], "a").join(sizes[1], "b").where((least * DENOMINATOR >= most * NUMERATOR)).select("a", "b", equal.alias("equal")).where(F.col("equal") >= LEAST_EQUAL)
    likely = save(likely, "likely")
    links = _linked(likely, docs)
    groups = components(links)
    members = found.where("region is not null").select("region", F.col("a").alias("rep"))
    groups = components(save(links.unionByName(crowded(members, groups, docs)), "links"))

    member = rows.join(reps.select("k1", "k2", "rep"), ["k1", "k2"], "left").select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("rep")).alias("rep"))
    out = member.join(groups.withColumnRenamed("node", "rep"), "rep", "left")
    out = out.select("doc_id", "n_shingles", F.coalesce("component", "rep", "doc_id").alias("component_id"), F.coalesce("rep", "doc_id").alias("copy_of"))
    out = out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"), "copy_of")
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"), "copy_of")


def _linked(likely: DataFrame, docs: DataFrame) -> DataFrame:
    """The links among the pairs (a, b, equal) that reach the threshold: first the best of each b, then what still joins two components."""
    ends = likely.select(F.col("a").alias("doc_id")).unionByName(likely.select(F.col("b").alias("doc_id"))).distinct()
    texts = save(docs.select("doc_id", "text").join(ends.hint("merge"), "doc_id", "left_semi").dropDuplicates(["doc_id"]), "texts")
    best = F.max_by(F.struct("a", "b"), F.struct("equal", -F.col("a"))).alias("best")
    first = likely.groupBy("b").agg(best).select("best.a", "best.b")
    links = save(_confirmed(first, texts), "links")
    rest = _across(likely.join(first, ["a", "b"], "left_anti"), components(links))
    return save(links.unionByName(_confirmed(rest, texts)), "links")


def _across(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """The pairs whose ends are not yet in one group."""
    a, b = (groups.select(F.col("node").alias(x), F.col("component").alias(f"c_{x}")) for x in "ab")
    return pairs.join(a, "a", "left").join(b, "b", "left").where(F.coalesce("c_a", "a") != F.coalesce("c_b", "b")).select("a", "b")


def op1_query(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
