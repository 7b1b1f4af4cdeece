"""Jaccard join, line dedup and components against plain Python."""

import random
import re
from collections import Counter, defaultdict

import pytest
from llm_rows import ODD
from pyspark.sql import functions as F

from claimlens.llm import jaccard, lines
from claimlens.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def roots(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(work):
    rng = random.Random(4)
    pairs = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(90), rng.randrange(90)) for _ in range(60)] + [(500, i) for i in range(600, 700)]
    nodes = {x for p in pairs if p[0] != p[1] for x in p}
    got = components(work.createDataFrame(pairs, "a long, b long")).collect()
    assert {r.node: r.root for r in got} == roots(pairs, nodes)
    assert len(got) == len(nodes)
    assert components(work.createDataFrame([], "a long, b long")).collect() == []


def shingle_set(text):
    w = WORD.findall(text or "")
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_classes(rows):
    sets = [shingle_set(t) for _, t in rows]
    index = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s or {()}:
            index[g].append(i)
    links, pairs = Counter(), []
    for i, s in enumerate(sets):
        common = Counter(j for g in s or {()} for j in index[g] if j != i)
        for j, n in common.items():
            if not s or n >= 0.8 * (len(s) + len(sets[j]) - n) - 1e-9:
                links[i] += 1
                pairs.append((i, j))
    root = roots(pairs, range(len(rows)))
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root[i]] = min(least.get(root[i], d), d)
    return sorted((str(d), str(least.get(root[i])), links[i]) for i, (d, _) in enumerate(rows))


def near_copies(n, seed=0):
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(120)]
    out = []
    for i in range(n):
        w = list(base)
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = f"x{rng.random()}"
        out.append((1000 + i, " ".join(w)))
    return out


@pytest.mark.parametrize("rule", [jaccard.Join(), jaccard.Join(small=3, block_sets=40), jaccard.Join(block_sets=2, block_words=50)])
def test_classes_and_links_equal_all_pairs(docs, rule):
    rng = random.Random(7)
    shared = " ".join(f"hot{i}" for i in range(12))
    rows = ODD + near_copies(150) + [(3000 + i, shared + " " + " ".join(f"u{rng.random()}" for _ in range(rng.randint(5, 60)))) for i in range(60)]
    rows += [(4000 + i, "exact copy of a text with some words") for i in range(40)]
    got = jaccard.classes(docs(rows), rule).collect()
    assert sorted((str(r.doc_id), str(r.class_id), r.n_links) for r in got) == brute_classes(rows)


def test_one_row_of_each_class_stays(docs):
    rows = [(5, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (9, None), (8, " "), (None, "z z y x w v u"), (7, "other words")]
    kept = jaccard.one_per_class(docs(rows))
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["3", "7", "8", "None"]
    assert kept.columns == docs(rows).columns
    assert jaccard.one_per_class(docs([])).count() == 0


def test_unlike_texts_of_one_id_or_none_all_stay(docs):
    rows = [(None, f"n{i} a b c d e f") for i in range(5)] + [(None, "n0 a b c d e f"), (4, "one text of five words"), (4, "and quite another text here"), (4, None), (None, " ")]
    kept = sorted((str(r.doc_id), str(r.text)) for r in jaccard.one_per_class(docs(rows)).collect())
    assert kept == sorted({(str(d), str(t)) for d, t in rows} - {("None", " ")})
    got = jaccard.classes(docs(rows)).collect()
    assert len({r.root for r in got}) == 8 and None not in {r.root for r in got}


def test_lines_near_and_far_from_the_threshold(docs):
    rule = lines.Spread(sites=8)
    rows = [(i, f"own {i}\nfooter\n  {'edge' if i % 40 < 7 else 'wide'} \n\nshort", f"s{i % 40}") for i in range(200)] + [(900, None, None), (901, "", None)]
    rows += [(902, "footer\nfooter", None)]
    out = {r.doc_id: r for r in lines.remove_boilerplate(docs(rows), rule).collect()}
    # "edge" stands on seven sites, one below the threshold; the rest on more
    assert out[0].text == rows[0][1]
    assert out[1].text == "own 1\n  edge \n"
    assert out[7].text == "own 7\n  wide \n"
    assert out[47].text == "own 47\n"
    assert out[900].text is None and out[901].text == ""
    assert out[902].text == "" and out[902].removed_lines == 2
    every = lines.remove_boilerplate(docs(rows), lines.Spread(sites=8, keep_first=False)).where("doc_id = 0").first()
    assert every.text == "own 0\n  edge \n"
    assert lines.remove_boilerplate(docs([]), rule).count() == 0


def test_line_sketch_agrees_with_distinct_counts(work):
    shown = work.range(20000).select(
        (F.col("id") % 50).alias("a"), F.lit(1).cast("long").alias("b"), F.concat(F.lit("x"), (F.col("id") % (50 * (1 + F.col("id") % 50)))).alias("site")
    )
    got = {r.a for r in lines.site_spread(shown, lines.Spread(sites=30)).collect()}
    want = {r[0] for r in shown.groupBy("a").agg(F.countDistinct("site").alias("n")).where("n >= 30").collect()}
    assert got == want
