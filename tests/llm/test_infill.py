"""Fill-in-middle and its skip list against plain Python."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from llm_rows import ODD

from claimlens.llm import infill

WORD = re.compile(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*")


def units_of(text, unit):
    if unit == "code_point" or not text:
        return list(text)
    lead = len(text) - len(text.lstrip("\x20\t\n\v\f\r"))
    if lead == len(text):
        return [text]
    parts = WORD.findall(text[lead:])
    return [text[:lead] + parts[0], *parts[1:]]


@pytest.mark.parametrize("unit", ["code_point", "word"])
def test_every_rank_is_reached_exactly(unit):
    rng = random.Random(3)
    texts = ["", "a", " \n", " \t lead", "é ß 中文 😀  end\n"] + [
        "".join(rng.choice("ab é中😀 \n") for _ in range(rng.randrange(400))) for _ in range(30)
    ]
    lists, _, _ = infill.skip_list(pa.array(texts), unit)
    assert len(lists.lanes) > 1
    cut = [units_of(t, unit) for t in texts]
    assert np.diff(lists.first).tolist() == [len(c) for c in cut]
    for share in (0.0, 0.13, 0.5, 0.98, 1.0):
        rank = np.array([round(share * len(c)) for c in cut])
        points, bytes_ = lists.locate(rank)
        before = ["".join(c[:r]) for c, r in zip(cut, rank)]
        assert points.tolist() == [len(b) for b in before]
        assert bytes_.tolist() == [len(b.encode()) for b in before]


def test_a_rank_takes_few_steps():
    text = "x" * 100_000
    lists, _, _ = infill.skip_list(pa.array([text]), "code_point")
    steps = 0
    left = 73_211
    at = 0
    for lane in reversed(lists.lanes):
        while lane.units[at] <= left:
            left -= lane.units[at]
            at += 1
            steps += 1
        at = lane.down[at] if lane.down is not None else at
    assert left == 0 and steps < 400


def plainly(doc_id, text, rule):
    text = text or ""
    h = hashlib.sha256(f"{rule.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    units = units_of(text, rule.unit)
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    p, s, m = rule.marks
    if not text or any(x in text for x in rule.marks) or h3 % 100 >= rule.changed:
        return len(units), "plain", None, None, text
    if h4 % 100 < rule.spm:
        return len(units), "spm", len(prefix), len(middle), s + suffix + p + prefix + m + middle
    return len(units), "psm", len(prefix), len(middle), p + prefix + s + suffix + m + middle


@pytest.mark.parametrize("rule", [infill.Infill(), infill.Infill(unit="word", seed="x", changed=70, spm=50, marks=("<pre>", "<|", "[m]"))])
def test_texts_are_rearranged_and_rebuilt(docs, rule):
    rng = random.Random(5)
    rows = ODD + [(100 + i, "".join(rng.choice("ab é中😀<P>S \n") for _ in range(rng.randrange(60)))) for i in range(300)]
    rows += [(400, "a<P>b"), (401, "<S"), (402, "x<|y"), (400, "a<P>b")]
    frame = docs(rows)
    out = infill.fill_in_middle(frame, rule, keep=("doc_id", "n_words"))
    got = out.withColumn("back", infill.restored(rule)).collect()
    assert out.columns == ["doc_id", "n_words", *infill.RESULT]
    wanted = [(i, *plainly(i, t, rule), t or "") for i, t in rows]
    key = lambda r: tuple((x is None, x if x is not None else 0) for x in r)
    assert sorted([tuple(r[c] for c in ("doc_id", *infill.RESULT, "back")) for r in got], key=key) == sorted(wanted, key=key)
    assert {r.form for r in got} == {"plain", "spm", "psm"} and all(r.n_words == 7 for r in got)


def test_empty_table_and_bad_arguments(docs):
    assert infill.fill_in_middle(docs([])).collect() == []
    with pytest.raises(ValueError, match="names of kept"):
        infill.fill_in_middle(docs([]).withColumnRenamed("n_words", "form"), keep=("form",))
    with pytest.raises(ValueError, match="marks"):
        infill.Infill(marks=("<P>", "<P><S>", "<M>"))
    with pytest.raises(ValueError, match="unit"):
        infill.Infill(unit="line")
