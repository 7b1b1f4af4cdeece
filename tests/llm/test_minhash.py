"""MinHash components against all pairs."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from llm_rows import ODD
from pyspark.sql import functions as F

from claimlens.llm import minhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def shingles(text, length=2):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + length]) for i in range(len(w) - length + 1)) if len(w) >= length else frozenset([tuple(w)] if w else [])


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            r = find(i)
            least[r] = min(least.get(r, d), d)
    return sorted(
        [(d, len(sets[i]), least.get(find(i)), d == least.get(find(i))) for i, (d, _) in enumerate(rows)],
        key=lambda r: tuple((x is None, x or 0) for x in r),
    )


def found(frame, rule=minhash.MinHash()):
    rows = [tuple(r) for r in minhash.near_components(frame, rule).select("doc_id", "n_shingles", "component_id", "kept").collect()]
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))


def corpus(seed, n):
    """Groups of edited copies around the threshold, chains of edits and boilerplate with unlike rests."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    shared = [rng.choice(words) for _ in range(30)]
    rows = []
    for g in range(n):
        base = [rng.choice(words) for _ in range(rng.randrange(3, 60))]
        for _ in range(rng.choice([1, 1, 2, 5])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3, 6])):
                copy[rng.randrange(len(copy))] = rng.choice(words).upper()
            if rng.random() < 0.3:
                # every copy is an edit of the one before
                base = copy
            rows.append((len(rows), " ".join(copy)))
        rows.append((len(rows), " ".join(shared + [rng.choice(words) for _ in range(rng.randrange(8, 40))])))
    rng.shuffle(rows)
    return rows


def test_components_equal_all_pairs(docs):
    rows = corpus(1, 60) + ODD + [(None, "q r s t u v"), (None, "q r s t u v"), (9, "A b C"), (9, "other text here"), (8, "a B c")]
    frame = docs(rows)
    # other columns do not matter, whatever their names
    for c in ("name", "k1", "size", "root", "kept", "bucket", "unit"):
        frame = frame.withColumn(c, F.lit("z"))
    assert found(frame) == brute(rows)


# blocks of a few rows take every path that large groups take
SMALL = minhash.MinHash(small=2, block=4, block_sets=3, block_words=200)


def test_large_buckets_and_groups_lose_no_link(docs):
    rng = random.Random(8)
    base = [f"b{i}" for i in range(80)]
    rows = corpus(2, 25)
    for i in range(60):
        copy = list(base)
        for _ in range(rng.randrange(1, 9)):
            copy[rng.randrange(80)] = f"x{rng.randrange(500)}"
        rows.append((1000 + i, " ".join(copy)))
    rows += [(2000 + i, " ".join(base)) for i in range(30)]
    # each text is near the next only, so most members of the group are apart from any leader
    words = [f"c{i}" for i in range(160)]
    rows += [(3000 + i, " ".join(words[i : i + 60])) for i in range(90)]
    got = found(docs(rows).repartition(4), SMALL)
    assert got == brute(rows) and {r[2] for r in got if r[0] is not None and r[0] >= 3000} == {3000}


def test_empty_table(docs):
    assert minhash.near_components(docs([])).collect() == []


def test_minima_agree_as_often_as_sets_overlap():
    rng = random.Random(4)
    a = [f"t{i}" for i in range(400)]
    b = a[:320] + [f"u{rng.random()}" for _ in range(80)]
    rule = minhash.MinHash(bands=128)
    owner, token, size, _ = minhash.sets_of(pa.array([" ".join(a), " ".join(b)]), 1)
    least = minhash.signatures(owner, token, 2, rule)
    true = 320 / 480
    assert np.mean(least[0] == least[1]) == pytest.approx(true, abs=0.07)
    assert size.tolist() == [400, 400]


def test_connected_labels():
    rng = np.random.default_rng(1)
    for _ in range(30):
        n = int(rng.integers(1, 60))
        a, b = rng.integers(0, n, (2, int(rng.integers(0, 70))))
        label = minhash.connected(n, a, b)
        wanted = list(range(n))
        for _ in range(n):
            for x, y in zip(a, b):
                wanted[x] = wanted[y] = min(wanted[x], wanted[y])
        assert label.tolist() == wanted
