"""Split reads: a read that was built from two places is put together again."""

import random
import re
from types import SimpleNamespace

import pytest

from probewell.operators import chimera

# ---- a literal model: operation by operation

_OPS = re.compile(r"(\d+)([MIDNSHP=X])")
_ON_READ, _ON_REF = frozenset("MIS=X"), frozenset("MDN=X")


def _ops(cigar: str) -> list[tuple[int, str]]:
    return [(int(n), op) for n, op in _OPS.findall(cigar)]


def _matched(ops: list[tuple[int, str]]) -> tuple[int, int]:
    """First and last read base between the clips (1-based, in the direction of the reference)."""
    left = ops[0][0] if ops and ops[0][1] == "S" else 0
    total = sum(n for n, op in ops if op in _ON_READ)
    return left + 1, total - (ops[-1][0] if len(ops) > 1 and ops[-1][1] == "S" else 0)


def _cut(ops: list[tuple[int, str]], pos: int, first: int, second: int) -> tuple[list[tuple[int, str]], int, int]:
    """The operations on read bases first..second, their first and last reference base."""
    at, ref, out, start = 1, pos, [], None
    end = pos - 1
    for n, op in ops:
        if op in _ON_READ:
            lo, hi = max(at, first), min(at + n - 1, second)
            if lo <= hi and op != "S":
                if op in _ON_REF:
                    start = ref + lo - at if start is None else start
                    end = ref + hi - at
                out.append((hi - lo + 1, op))
            at += n
        elif op in "DN" and out and at <= second:
            out.append((n, op))
        if op in _ON_REF:
            ref += n
    while out and out[-1][1] in "DN":
        out.pop()
    return out, start if start is not None else pos, end


def _text(ops: list[tuple[int, str]]) -> str:
    return "".join(f"{n}{op}" for n, op in ops)


def _side(ops: list[tuple[int, str]]) -> str:
    left = ops[0][0] if ops[0][1] == "S" else 0
    right = ops[-1][0] if len(ops) > 1 and ops[-1][1] == "S" else 0
    return "TOTAL" if not left and not right else "CENTER" if left == right else "RIGHT" if left > right else "LEFT"


def _pair(r, need_group: bool):
    """(status, ambiguous, kind, arm 1, arm 2) of a pair; arms are (ops, first, last, seq, qual) in the direction of the reference."""
    if r.flag_a & 4 or r.flag_b & 4:
        return ("UNMAPPED",)
    rev_a, rev_b = bool(r.flag_a & 16), bool(r.flag_b & 16)
    if need_group and rev_a != rev_b:
        return ("DIFF_STRAND",)
    if need_group and r.chr_id_a != r.chr_id_b:
        return ("DIFF_CHR",)
    one, two = _ops(r.cigar_a), _ops(r.cigar_b)
    if not one or not two or any(op in "N" for _, op in one + two):
        return ("MULTI_MATCH",)
    spans = [(_matched(o)) for o in (one, two)]
    refs = [(p, p + sum(n for n, op in o if op in _ON_REF) - 1) for o, p in ((one, r.pos_a), (two, r.pos_b))]
    if need_group and min(refs[0][1], refs[1][1]) >= max(refs[0][0], refs[1][0]):
        return ("OVERLAP",)
    # the sides on the read itself: a reversed record is mirrored
    flip = {"LEFT": "RIGHT", "RIGHT": "LEFT"}
    sides = [flip.get(s, s) if rev else s for s, rev in ((_side(one), rev_a), (_side(two), rev_b))]
    if sorted(sides) != ["LEFT", "RIGHT"]:
        return ("ABNORMAL_PATTERN",)
    total = [sum(n for n, op in o if op in _ON_READ) for o in (one, two)]
    on_read = [(t - b + 1, t - a + 1) if rev else (a, b) for (a, b), t, rev in zip(spans, total, (rev_a, rev_b), strict=True)]
    head = sides.index("LEFT")
    shared = max(0, on_read[head][1] - on_read[1 - head][0] + 1)
    cut = [list(x) for x in on_read]
    cut[head][1] -= shared
    cut[1 - head][0] += shared
    if any(a > b for a, b in cut):
        return ("INVALID_BORDER",)
    arms = []
    for ops, pos, (a, b), t, rev, seq, qual in ((one, r.pos_a, cut[0], total[0], rev_a, r.seq_a, r.qual_a), (two, r.pos_b, cut[1], total[1], rev_b, r.seq_b, r.qual_b)):
        a, b = (t - b + 1, t - a + 1) if rev else (a, b)
        part, first, last = _cut(ops, pos, a, b)
        arms.append((part, first, last, (seq or "")[a - 1 : b], (qual or "")[a - 1 : b]))
    left_first = refs[0][0] <= refs[1][0]
    facing = (sides[0 if left_first else 1] == "LEFT") != (rev_a if need_group else False)
    return "SUCCESS", shared, "CENTER" if facing else "FLANKING", arms[0], arms[1]


def random_cigar(rng, total):
    """A match of some operations with clips on one side or both, of ``total`` read bases."""
    left, right = rng.choice([(0, 1), (1, 0), (1, 0), (0, 1), (1, 1), (0, 0)])
    left, right = left * rng.randrange(1, total // 2), right * rng.randrange(1, total // 2)
    rest, ops = total - left - right, []
    while rest > 0:
        n = min(rng.randrange(1, 12), rest)
        ops.append(f"{n}{rng.choice('MMM=X')}")
        rest -= n
        if rest > 1 and rng.random() < 0.5:
            kind = rng.choice("DDIN" if rng.random() < 0.1 else "DDI")
            ops.append(f"{rng.randrange(1, 4) if kind != 'I' else 1}{kind}")
            rest -= kind == "I"
    return (f"{left}S" if left else "") + "".join(ops) + (f"{right}S" if right else "")


@pytest.mark.parametrize("group", [True, False])
def test_pairs_match_the_literal_model(spark, group):
    rng = random.Random(group)
    rows = []
    for k in range(700):
        rev = rng.choice([0, 0, 16])
        side = lambda: (rng.choice([rev, rev, 16 - rev]) | rng.choice([0, 256, 256, 4 if rng.random() < 0.05 else 0]), rng.choice(["c", "c", "c", "d"]), rng.randrange(1, 200), rng.choice([None, "*"]) if rng.random() < 0.03 else random_cigar(rng, 40), "".join(rng.choices("ACGT", k=40)), "".join(rng.choices("IHGF", k=40)))
        rows.append((f"r{k}", 1, 2, *side(), *side()))
    schema = "read_id string, i int, j int, " + ", ".join(f"{c}_{s} {'int' if c == 'flag' else 'long' if c == 'pos' else 'string'}" for s in "ab" for c in chimera.RECORD)
    names = [c.split()[0] for c in schema.split(", ")]
    done = chimera.group_read_pair if group else chimera.trim_read_pair
    got = {r.read_id: r for r in done(spark.createDataFrame(rows, schema)).collect()}
    seen = set()
    for row in rows:
        r = SimpleNamespace(**dict(zip(names, row, strict=True)))
        r.cigar_a, r.cigar_b = r.cigar_a or "", r.cigar_b or ""
        want, g = _pair(r, group), got[r.read_id]
        seen.add(want[0])
        assert g.status == want[0], row
        if want[0] != "SUCCESS":
            assert g.ab is None
            continue
        _, shared, kind, x, y = want
        assert g.ab == shared
        if group:
            x, y = (y, x) if x[1] > y[1] else (x, y)
            assert (g["at"], g.pos, g.cigar, g.gap) == (kind, x[1], f"{_text(x[0])}{y[1] - x[2] - 1}N{_text(y[0])}", y[1] - x[2] - 1)
            assert (g.seq, g.qual, g.arm_1, g.arm_2) == (x[3] + y[3], x[4] + y[4], x[2] - x[1] + 1, y[2] - y[1] + 1)
        else:
            assert [(g[f"t_pos_{k}"], g[f"t_cigar_{k}"], g[f"t_seq_{k}"], g[f"t_qual_{k}"], g[f"arm_{k}"]) for k in (1, 2)] == [(v[1], _text(v[0]), v[3], v[4], v[2] - v[1] + 1) for v in (x, y)]
    assert {"SUCCESS", "UNMAPPED", "MULTI_MATCH", "ABNORMAL_PATTERN"} <= seen


def test_few_pairs_are_the_good_ones_of_all(spark):
    rng = random.Random(9)
    rows = [(f"r{rng.randrange(40)}", rng.choice([0, 16, 256, 272, 4]), rng.choice("cd"), rng.randrange(1, 900), random_cigar(rng, 40)) for _ in range(300)]
    s = sam(spark, rows)
    good = chimera.group_read_pair(chimera.read_pairs(s)).where("status = 'SUCCESS' and gap >= 5 and least(arm_1, arm_2) >= 10 and ab <= 10").count()
    assert chimera.sam_group(s).count() == good > 3
    trimmed = chimera.trim_read_pair(chimera.read_pairs(s)).where("status = 'SUCCESS' and least(arm_1, arm_2) >= 10 and ab <= 10")
    assert chimera.sam_trim(s).count() == 2 * trimmed.count() > 10
    others = trimmed.where("chr_id_a <> chr_id_b or (flag_a & 16) <> (flag_b & 16)").count()
    assert chimera.sam_trim(s, remove_groupable=True).count() == 2 * others


# ---- cases by hand

SAM = "read_id string, flag int, chr_id string, pos long, cigar string, seq string, qual string"


def sam(spark, rows):
    return spark.createDataFrame([(i, f, c, p, g, "A" * 20 + "C" * 20, "I" * 40) for i, f, c, p, g in rows], SAM)


def test_group_and_trim(spark):
    rows = [
        ("center", 0, "c", 100, "20M20S"), ("center", 256, "c", 300, "20S20M"),
        ("shared", 0, "c", 100, "22M18S"), ("shared", 256, "c", 300, "18S22M"),
        ("flank", 0, "c", 300, "20M20S"), ("flank", 256, "c", 100, "20S20M"),
        ("strands", 0, "c", 100, "20M20S"), ("strands", 272, "c", 300, "20M20S"),
        ("whole", 0, "c", 100, "40M"), ("whole", 256, "c", 300, "20S20M"),
        ("near", 0, "c", 100, "20M20S"), ("near", 256, "c", 110, "20S20M"),
        ("other", 0, "c", 100, "20M20S"), ("other", 256, "d", 300, "20S20M"),
    ]
    s = sam(spark, rows)
    got = {r.read_id: r for r in chimera.group_read_pair(chimera.read_pairs(s)).collect()}
    assert (got["center"].status, got["center"].pos, got["center"].cigar, got["center"].ab, got["center"]["at"]) == ("SUCCESS", 100, "20M180N20M", 0, "CENTER")
    assert got["center"].seq == "A" * 20 + "C" * 20
    # four bases that both use are cut from both: 18 and 18 are left
    assert (got["shared"].cigar, got["shared"].ab, got["shared"].gap) == ("18M186N18M", 4, 186)
    assert (got["flank"].pos, got["flank"].cigar, got["flank"]["at"]) == (100, "20M180N20M", "FLANKING")
    assert [got[k].status for k in ("strands", "whole", "near", "other")] == ["DIFF_STRAND", "ABNORMAL_PATTERN", "OVERLAP", "DIFF_CHR"]
    trimmed = {r.read_id: r for r in chimera.trim_read_pair(chimera.read_pairs(s)).collect()}
    assert (trimmed["other"].t_pos_1, trimmed["other"].t_cigar_1, trimmed["other"].t_cigar_2) == (100, "20M", "20M")
    assert trimmed["strands"].status == "SUCCESS"


def test_sam_group_trim(spark):
    s = sam(spark, [("a", 0, "c", 100, "20M20S"), ("a", 256, "c", 300, "20S20M"), ("b", 0, "c", 100, "20M50N20M"), ("d", 0, "c", 5, "38M2S"), ("e", 0, "c", 100, "20M20S"), ("e", 256, "d", 9, "20S20M")])
    assert {r.read_id for r in chimera.sam_group(s).collect()} == {"a_1"}
    assert chimera.sam_trim(s, remove_groupable=True).count() == 2
    gapped, plain = chimera.sam_group_trim(s)
    assert sorted(r.read_id for r in gapped.collect()) == ["a_1", "b", "e_1", "e_1"] and [r.read_id for r in plain.collect()] == ["d"]
