"""Vector codes and their bounds against plain searches."""

import math
import random

import numpy as np
import pytest

from claimlens.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<double>, label int, x int, code string, error long, of int"


def test_bounds_give_the_nearest_entry_in_every_round():
    rng = np.random.default_rng(2)
    x = rng.integers(-60, 60, (4000, 4)).astype(float)
    x[1000:1400] = x[0]
    history = [x[rng.choice(4000, 64, replace=False)]]
    history[0][5] = history[0][3]
    state, measured = None, []
    for turn in range(6):
        bounds = vc.PartBounds(np.stack(history), 8)
        if state is None:
            code, own, low, stamp = bounds.first(x)
        else:
            code, own, low, stamp, n = bounds.again(x, *state)
            measured.append(n)
        distance = ((x[:, None, :] - history[-1][None]) ** 2).sum(axis=2)
        assert (code == distance.argmin(axis=1)).all()
        assert (own == distance.min(axis=1)).all()
        # a bound and its net displacement never pass the nearest other entry of the group
        distance[np.arange(len(x)), code] = np.inf
        for g, members in enumerate(bounds.members):
            if len(members):
                held = low[:, g] - bounds.moved[g, stamp[:, g]]
                assert (held <= np.sqrt(distance[:, members].min(axis=1)) + 1e-9).all()
        state = code, low, stamp
        moved = history[-1].copy()
        for e in range(64):
            if (code == e).any():
                moved[e] = np.floor(x[code == e].mean(axis=0))
        history.append(moved)
    # the later the round, the less the entries move and the fewer distances are measured
    assert measured[-1] < 0.6 * len(x) * 64 and measured[-1] < measured[0]


def test_displacement_is_net():
    """An entry that comes back has not moved, whatever way it went."""
    a, b = np.zeros((1, 2)), np.full((1, 2), 50.0)
    bounds = vc.PartBounds(np.stack([a, b, a]), 1)
    assert bounds.moved[0].tolist() == pytest.approx([0.0, math.sqrt(5000), 0.0])


def plainly(rows, rule):
    kept = []
    for i, v, label in rows:
        if v is not None and all(c is not None and math.isfinite(c) for c in v):
            kept.append((i, [math.floor(rule.scale * c) for c in v], label))
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // rule.parts
    cut = [[v[p * width : (p + 1) * width] for p in range(rule.parts)] for _, v, _ in kept]
    books = [[c[p] for c in cut[: rule.entries]] for p in range(rule.parts)]
    far = lambda a, b: sum((s - t) ** 2 for s, t in zip(a, b))

    def assign():
        return [[min((far(c[p], e), k) for k, e in enumerate(books[p])) for p in range(rule.parts)] for c in cut]

    for _ in range(rule.rounds):
        found = assign()
        for p in range(rule.parts):
            for k in range(len(books[p])):
                mine = [c[p] for c, f in zip(cut, found) if f[p][1] == k]
                if mine:
                    books[p][k] = [sum(col) // len(mine) for col in zip(*mine)]
    return books, [(i, label, [k for _, k in f], sum(d for d, _ in f)) for (i, _, label), f in zip(kept, assign())]


def rows_of(n, seed=1):
    rng = random.Random(seed)
    rows = [(i, [round(rng.uniform(-1, 1), 2) for _ in range(8)], rng.choice([None, 0, 1])) for i in range(n)]
    rows += [(3, rows[3][1], 1), (None, rows[4][1], 1), (5, None, 0), (6, [1.0] * 7 + [None], 0)]
    rows += [(7, [float("nan")] + [0.0] * 7, 0), (8, [float("-inf")] + [0.0] * 7, 0)]
    rows += [(1000 + i, rows[9][1], 2) for i in range(40)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("rule", [vc.Codes(entries=16, groups=4, scale=16), vc.Codes(parts=2, rounds=1), vc.Codes(rounds=0, entries=9)])
def test_codes_equal_a_plain_search(work, rule):
    rows = rows_of(120)
    frame = work.createDataFrame([(*r, 1, "a", 2, 3) for r in rows], SCHEMA).repartition(5)
    found, books = vc.encode(frame, rule)
    wanted_books, wanted = plainly(rows, rule)
    assert books.tolist() == wanted_books
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[1] is None, r[1] or 0)
    assert sorted([(r.vec_id, r.label, list(r.code), r.error) for r in found.collect()], key=key) == sorted(wanted, key=key)
    report = vc.code_report(frame, rule).collect()
    totals = {}
    for _, label, _, error in wanted:
        totals[label] = totals.get(label, 0) + error
    assert {r.label_error for r in report} == set(totals.values())
    assert {r.codebooks_sha256 for r in report} == {vc.codebook_digest(books)}
    assert all(len(r.code) == 2 * rule.parts for r in report)


def test_wide_components_are_exact(work):
    big = float(1 << 24)
    rows = [(i, [big + 3 * i, -big + i, big - i * i, float(i)], 0) for i in range(40)]
    rule = vc.Codes(parts=2, entries=6, rounds=2, scale=8)
    frame = work.createDataFrame([(*r, 1, "a", 2, 3) for r in rows], SCHEMA)
    found, books = vc.encode(frame, rule)
    wanted_books, wanted = plainly(rows, rule)
    assert books.tolist() == wanted_books
    assert sorted((r.vec_id, list(r.code), r.error) for r in found.collect()) == sorted((i, c, e) for i, _, c, e in wanted)


def test_empty_uneven_and_too_large(work):
    make = lambda rows: work.createDataFrame([(*r, 1, "a", 2, 3) for r in rows], SCHEMA)
    assert vc.code_report(make([])).collect() == []
    assert vc.code_report(make([(1, None, 0)])).collect() == []
    (only,) = vc.code_report(make([(1, [0.5] * 8, None)])).collect()
    assert (only.code, only.error, only.label_error) == ("00000000", 0, 0)
    with pytest.raises(ValueError, match="equal parts"):
        vc.encode(make([(1, [0.5] * 8, 0), (2, [0.5] * 4, 0)]))
    with pytest.raises(ValueError, match="too large"):
        vc.encode(make([(1, [1e9] * 8, 0), (2, [0.5] * 8, 0)]))
