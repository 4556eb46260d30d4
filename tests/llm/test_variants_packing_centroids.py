"""Spelling variants, packing and centroids against brute force, and on odd inputs."""

import hashlib
import random
import re
import zlib
from collections import Counter
from itertools import accumulate

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from probewell.llm import centroids, packing, spelling

DOCS = "doc_id long, text string, word string, n int, length int, ids string, worker int, shorter int, form string, source string"


def docs(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "w", 1, 2, "x", 3, 4, "f", "s") for i, t in zip(ids, texts, strict=True)], DOCS)


ODD = ["", None, " \t\n", "one", "a b c", "a b c", "x" * 70_000, "é ü 日本 😀 " * 40, "a\x00b " * 300, "Same " * 900, "×÷ßÿ Àb", "<|endoftext|> a.<|startoftext|>b, don't it's 'tis 12a3 x)y"]


# ---- spelling variants


def brute_words(texts, ids):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    count = Counter()
    for i, t in zip(ids, texts, strict=True):
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(low)
            h = zlib.crc32(f"{i}:{run}".encode())
            if i is not None and h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 5:
                count[run] += 1
    return count


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(count):
    words = {w: n for w, n in count.items() if n >= 3}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {(w, form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items()}


def small_words(seed, n, letters="abé"):
    rng = random.Random(seed)
    weights = {"".join(rng.choice(letters) for _ in range(rng.randrange(4, 9))): rng.randrange(1, 40) for _ in range(n)}
    return [" ".join(rng.choices(list(weights), list(weights.values()), k=200)) for _ in range(40)]


def test_variants_match_brute_force(spark):
    texts = ODD + small_words(1, 120) + ["Wörter wörter; WÖRTER wörterr"] * 9
    ids = list(range(len(texts)))
    ids[5] = None
    found = {tuple(r) for r in spelling.variants(docs(spark, texts, ids)).collect()}
    assert found == brute_variants(brute_words(texts, ids))
    assert any(r[2] != (r[1] or r[0]) for r in found)  # a root over two forms


@pytest.mark.parametrize(("most", "middle"), [(2, 64), (10_000, 4)])
def test_partitions_are_cut_again(spark, monkeypatch, most, middle):
    monkeypatch.setattr(spelling, "PARTITION", most)
    monkeypatch.setattr(spelling, "MIDDLE", middle)
    texts = small_words(7, 90, "ab")
    long = "ab" * 20
    texts += [" ".join([long, long[:25] + "c" + long[26:], long[:-1], "b" + long[1:], long + "b"] * 3)]
    ids = range(1000, 1000 + len(texts))
    found = [tuple(r) for r in spelling.variants(docs(spark, texts, ids)).collect()]
    assert len(found) == len(set(found))
    assert set(found) == brute_variants(brute_words(texts, ids))


def test_variants_of_nothing_and_of_repeated_rows(spark):
    assert spelling.variants(docs(spark, [])).collect() == []
    assert spelling.variants(docs(spark, ["", None, "ab cd"])).collect() == []
    found = {r.word: r for r in spelling.variants(docs(spark, ["apples"] * 6 + ["apple"] * 3, [2] * 9)).collect()}
    assert (found["apples"].n, found["apple"].n, found["apple"].form, found["apples"].form, found["apple"].n_near) == (6, 3, "apples", None, 1)


def test_equal_counts_take_the_smallest_form(spark):
    text = " ".join(["beast"] * 3 + ["feast"] * 6 + ["least"] * 6 + ["yeast"] * 6)
    found = {r.word: r for r in spelling.variants(docs(spark, [text], [None])).collect()}
    assert (found["beast"].form, found["beast"].n_near, found["feast"].form) == ("feast", 3, None)


@settings(max_examples=150, deadline=None)
@given(st.sets(st.text("abc", max_size=6), min_size=1, max_size=40))
def test_acceptor_pairs_are_all_pairs_one_edit_apart(words):
    found = spelling.Acceptor(sorted(words)).near()
    assert len(found) == len(set(map(frozenset, found)))
    assert set(map(frozenset, found)) == {frozenset((a, b)) for a in words for b in words if one_edit(a, b)}


def test_acceptor_is_minimal():
    a = spelling.Acceptor(sorted(x + y for x in "abcdef" for y in ("ing", "ed", "er")))
    assert len(a.final) == 6  # start, after x, after i, n, e, end


def test_checksums_are_those_of_zlib():
    rng = random.Random(2)
    data = np.frombuffer(rng.randbytes(5000), dtype=np.uint8)
    cuts = sorted(rng.sample(range(5001), 300)) + [5000]
    start, end = np.array([0, *cuts[:-1], 0]), np.array([*cuts, 900])
    begun = np.array([rng.randrange(2**32) for _ in start], dtype=np.uint32)
    assert spelling._checksums(data, start, end, begun).tolist() == [zlib.crc32(data[a:b].tobytes(), int(c)) for a, b, c in zip(start, end, begun, strict=True)]


# ---- packing


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def packed_right(rows, texts, ids, library, capacity):
    """Every id of every row in exactly one piece; sequences without gaps; totals; padding."""
    wanted = Counter()
    for i, t in zip(ids, texts, strict=True):
        wanted[i, np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4").tobytes()] += 1
    whole = {}
    for r in sorted(rows, key=lambda r: r.start):
        whole.setdefault(r.doc_id, []).append(r)
    for i in set(ids):
        texts_of_i = [w for (j, w), n in wanted.items() if j == i for _ in range(n)]
        if len(texts_of_i) == 1:
            assert b"".join(bytes(r.ids) for r in whole[i]) == texts_of_i[0]
            assert [r.start for r in whole[i]] == [0, *accumulate(q.length for q in whole[i][:-1])]
            assert {r.doc_tokens for r in whole[i]} == {len(texts_of_i[0]) // 4}
        assert sum(r.length for r in whole[i]) == sum(len(w) // 4 for w in texts_of_i)
    assert all(len(r.ids) == 4 * r.length for r in rows)
    bins = {}
    for r in sorted(rows, key=lambda r: r.offset):
        at = bins.get(r.sequence_id, 0)
        assert r.offset == at
        bins[r.sequence_id] = at + r.length
    assert sorted(bins) == list(range(len(bins)))
    assert all(n <= capacity and n.bit_count() == 1 for n in bins.values())
    return bins


@pytest.mark.parametrize("capacity", [2048, 16])
def test_packing_keeps_every_token_once(spark, library, capacity):
    rng = random.Random(capacity)
    texts = ODD + [" ".join(rng.choice(["the", "Hello,", "naïve", "world.", "(x)", "a.b.c", "#tag", "日本語", "don't"]) for _ in range(rng.randrange(0, 900))) for _ in range(60)]
    ids = list(range(len(texts)))
    ids[3] = ids[4] = None
    ids[8] = 7
    frame = docs(spark, texts, ids).repartition(5)
    rows = packing.pack(frame, capacity=capacity).collect()
    bins = packed_right(rows, texts, ids, library, capacity)
    classes = len({r.length for r in rows})
    assert sum(n < capacity for n in bins.values()) <= classes * capacity.bit_length()


def test_sequences_join_their_pieces(spark, library):
    texts = ["the quick brown fox " * 40, "jumps", None, "over, the lazy dog." * 9]
    packed = packing.pack(docs(spark, texts), capacity=64)
    made = packing.sequences(packed, 64).collect()
    assert all(len(r.ids) == 4 * r.n_tokens <= 256 for r in made)
    assert sum(r.n_tokens for r in made) == sum(r.length for r in packed.collect())
    odd = spark.createDataFrame([(0, 0, b"\x05\x00\x00\x00" * 2, 2, 9), (0, 2, b"\x06\x00\x00\x00", 1, 8)], "sequence_id long, offset long, ids binary, length long, doc_id long")
    only = packing.sequences(odd, 8, pad=7).first()
    assert np.frombuffer(bytes(only.ids), "<u4").tolist() == [5, 5, 6, 7, 7, 7, 7, 7] and only.doc_ids == [9, 8]


def test_packing_of_nothing_and_wrong_capacity(spark):
    assert packing.pack(docs(spark, [])).collect() == []
    assert packing.sequences(packing.pack(docs(spark, []))).collect() == []
    with pytest.raises(ValueError):
        packing.pieces(docs(spark, []), capacity=100)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from("aB.,;:!?)('̸́ \n\t\x0b\x0c\x1c\x85  <|>")), max_size=40), max_size=5))
def test_encoder_equals_the_library(library, texts):
    import public_tokenizers

    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    ids, at = packing.encoder(public_tokenizers.path(packing.TOKENIZER)).encode(np.frombuffer(b"".join(raw), dtype=np.uint8), offsets)
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_encoder_forgets_and_learns_again(library, monkeypatch):
    import public_tokenizers

    monkeypatch.setattr(packing, "MEMORY", 3)
    own = packing.Encoder(public_tokenizers.path(packing.TOKENIZER))
    for text in ("one two three four five", "two six", "seven eight two", "one"):
        raw = np.frombuffer(text.encode(), dtype=np.uint8)
        assert own.encode(raw, np.array([0, len(raw)]))[0].tolist() == library.encode(text, add_special_tokens=False).ids


# ---- centroids


def brute_clusters(rows, k, rounds, width):
    kept = [(i, [int(np.floor(64 * float(np.float32(x)))) for x in v]) for i, v in rows if v is not None and len(v) == width and all(x is not None and np.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    places = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(places))

    for _ in range(rounds):
        own = [[] for _ in places]
        for _, v in kept:
            own[nearest(v)[1]].append(v)
        places = [[sum(x) // len(g) for x in zip(*g, strict=True)] if g else c for g, c in zip(own, places, strict=True)]
    found = [(i, *reversed(nearest(v))) for i, v in kept]
    inertia = Counter()
    for _, j, d in found:
        inertia[j] += d
    return Counter((i, j, d, inertia[j], sum(inertia.values()), tuple(places[j])) for i, j, d in found)


VECTORS = "vec_id long, embedding array<float>, v int, dots string, cluster int"


@pytest.mark.parametrize(("n", "k", "rounds"), [(150, 16, 3), (150, 5, 6), (7, 16, 3), (40, 16, 0)])
def test_clusters_match_brute_force(spark, n, k, rounds):
    rng = random.Random(n + k)
    rows = [(i, [rng.choice([-1.0, 0.0, 0.25, 0.3, rng.gauss(0, 1)]) for _ in range(4)]) for i in range(n)]
    rows += rows[:5] + [(None, rows[0][1]), (None, rows[1][1]), (901, None), (902, []), (903, [1.0] * 3), (904, [1.0] * 5), (905, [1.0, None, 0.0, 0.0]), (906, [float("nan"), 0.0, 0.0, 0.0]), (907, [float("-inf"), 0.0, 0.0, 0.0])]
    frame = spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], VECTORS).repartition(3)
    found = Counter((*r[:5], tuple(r.centroid)) for r in centroids.cluster(frame, k=k, rounds=rounds, components=4).collect())
    assert found == brute_clusters(rows, k, rounds, 4)


def test_clusters_of_equal_vectors_and_of_nothing(spark):
    frame = spark.createDataFrame([(i, [0.5] * 64, 0, "", 0) for i in range(40)], VECTORS)
    assert {tuple(r[1:5]) for r in centroids.cluster(frame).collect()} == {(0, 0, 0, 0)}
    empty = centroids.cluster(spark.createDataFrame([], VECTORS))
    assert empty.collect() == [] and empty.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"]


def test_too_large_components_are_an_error(spark):
    frame = spark.createDataFrame([(1, [3e7] + [0.0] * 63, 0, "", 0)], VECTORS)
    with pytest.raises(Exception, match="larger than"):
        centroids.cluster(frame).collect()
