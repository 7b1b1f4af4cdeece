"""Fill-in-middle transformation over an indexable skip list.

A text is a run of units (code points, or words with the space after them). Express
lanes link every some-teenth unit; each link carries how many units, code points and
bytes it passes over. A cut rank is reached from the top lane by adding up widths and
stepping down, so the byte place and the code points before it are exact, and a text
of n units costs a few steps per lane instead of n.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import Batches, text_of
from .words import U64, Texts, flat, mix, pieces

RESULT = ("n", "form", "prefix_chars", "middle_chars", "output")


@dataclass(frozen=True)
class Infill:
    """``unit`` is "code_point" or "word"; of 100 texts ``changed`` are rearranged, of 100 of those ``spm`` put the suffix first.

    ``marks`` open the prefix, the suffix and the middle. The first character of a
    mark stands nowhere else in any mark, so no mark can arise across a cut.
    """

    unit: str = "code_point"
    seed: str = "1"
    changed: int = 90
    spm: int = 20
    marks: tuple[str, str, str] = ("<P>", "<S>", "<M>")

    def __post_init__(self):
        if self.unit not in ("code_point", "word"):
            raise ValueError(f"unknown unit {self.unit!r}")
        opening = {m[:1] for m in self.marks}
        if len(set(self.marks)) < 3 or "" in opening or any(c in m[1:] for m in self.marks for c in opening):
            raise ValueError("marks must differ, and none may begin inside another")


class Lane:
    """Links between some units, in order: the ``node`` each starts at and what it passes over."""

    def __init__(self, node: np.ndarray, points: np.ndarray, start: np.ndarray, below: Lane | None):
        self.node = node
        # the last node is the end of all units: no link leaves it
        self.units = np.append(np.diff(node), np.iinfo(np.int64).max)
        self.points = np.append(np.diff(points[node]), 0)
        self.bytes = np.append(np.diff(start[node]), 0)
        self.down = None if below is None else np.searchsorted(below.node, node)


class SkipList:
    """The units of several texts; ``start`` is the first byte of each, ``first`` the first unit of each text."""

    FAN_BITS = 4

    def __init__(self, start: np.ndarray, points: np.ndarray, first: np.ndarray):
        """``start`` and ``points`` (code points before a unit) have one entry more, for the end."""
        total = len(start) - 1
        self.first = first
        draw = mix(np.arange(total, dtype=U64))
        head = np.zeros(total + 1, bool)
        head[first] = True
        head[total] = True
        self.lanes = [Lane(np.arange(total + 1), points, start, None)]
        longest = int(np.diff(first).max(initial=1))
        # the first unit of a text is on every lane, any other by its draw
        for k in range(1, max(1, (longest.bit_length() + self.FAN_BITS - 1) // self.FAN_BITS)):
            on = head.copy()
            on[:-1] |= (draw & U64((1 << (self.FAN_BITS * k)) - 1)) == 0
            self.lanes.append(Lane(np.flatnonzero(on), points, start, self.lanes[-1]))

    def locate(self, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(code points, bytes) before the unit of each text that has the given rank; the unit count is the end."""
        left = rank.astype(np.int64).copy()
        points, bytes_ = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
        at = np.searchsorted(self.lanes[-1].node, self.first[:-1])
        for lane in reversed(self.lanes):
            live = np.arange(len(rank))
            while len(live):
                live = live[lane.units[at[live]] <= left[live]]
                here = at[live]
                left[live] -= lane.units[here]
                points[live] += lane.points[here]
                bytes_[live] += lane.bytes[here]
                at[live] += 1
            if lane.down is not None:
                at = lane.down[at]
        return points, bytes_


def skip_list(texts: pa.Array, unit: str) -> tuple[SkipList, np.ndarray, np.ndarray]:
    """The skip list of some texts, and their bytes and offsets."""
    data, offsets = flat(texts)
    opens = (data & 0xC0) != 0x80
    if unit == "word":
        words = Texts(texts)
        opens = np.zeros(len(data), bool)
        opens[words.start] = True
        # space before the first word belongs to its unit
        lead = words.first[:-1][words.n_words > 0]
        opens[words.start[lead]] = False
        opens[offsets[:-1][np.diff(offsets) > 0]] = True
    start = np.flatnonzero(opens)
    points = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=points[1:])
    first = np.searchsorted(start, offsets)
    start = np.append(start, len(data))
    return SkipList(start, points[start], first), data, offsets


def _arranged(batches: Batches, rule: Infill, keep: Sequence[str]) -> Batches:
    p, s, m = (mark.encode() for mark in rule.marks)
    for batch in batches:
        for piece in pieces(batch, "__text"):
            units, data, offsets = skip_list(piece.column("__text"), rule.unit)
            n = np.diff(units.first)
            ranks = [piece.column(c).to_numpy() % (n + 1) for c in ("__h1", "__h2")]
            before, low = units.locate(np.minimum(*ranks))
            upto, high = units.locate(np.maximum(*ranks))
            forms = piece.column("__form").to_pylist()
            raw = data.tobytes()
            out = []
            for form, at, end, a, b in zip(forms, offsets.tolist(), offsets[1:].tolist(), low.tolist(), high.tolist()):
                prefix, middle, suffix = raw[at : at + a], raw[at + a : at + b], raw[at + b : end]
                if form == "plain":
                    out.append(raw[at:end])
                elif form == "spm":
                    out.append(b"".join((s, suffix, p, prefix, m, middle)))
                else:
                    out.append(b"".join((p, prefix, s, suffix, m, middle)))
            plain = np.array([f == "plain" for f in forms], bool)
            yield pa.RecordBatch.from_arrays(
                [
                    *(piece.column(c) for c in keep),
                    pa.array(n.astype(np.int64)),
                    pa.array(forms, pa.string()),
                    pa.array(before, mask=plain),
                    pa.array(upto - before, mask=plain),
                    pa.array(out, pa.binary()).cast(pa.string()),
                ],
                names=[*keep, *RESULT],
            )


def fill_in_middle(docs: DataFrame, rule: Infill = Infill(), keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` columns of every row with n, form, prefix_chars, middle_chars and output.

    The draws come from a digest of the seed and the doc_id alone, so reruns agree. A
    text that is empty (null included) or holds a mark stays plain; prefix and middle
    are null there. Rows of one id (or none) get the same draws; repeated rows stay
    repeated; an empty table gives none. No shuffle; a text is held once per task.
    Kept columns must not have the name of a result.
    """
    clash = set(keep) & set(RESULT)
    if clash:
        raise ValueError(f"results have the names of kept columns: {sorted(clash)}")
    text = text_of()
    digest = F.sha2(F.concat(F.lit(f"{rule.seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]
    plain = (text == "") | (h[2] % 100 >= rule.changed)
    for mark in rule.marks:
        plain |= text.contains(mark)
    form = F.when(plain, "plain").when(h[3] % 100 < rule.spm, "spm").otherwise("psm")
    rows = docs.select(*keep, text.alias("__text"), h[0].alias("__h1"), h[1].alias("__h2"), form.alias("__form"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    schema = f"{kinds + ', ' if kinds else ''}n long, form string, prefix_chars long, middle_chars long, output string"
    return rows.mapInArrow(lambda b: _arranged(b, rule, list(keep)), schema)


def restored(rule: Infill = Infill(), output: str = "output", form: str = "form") -> Column:
    """The exact text, from an output and its form."""
    marks = "|".join(r"\Q" + mark + r"\E" for mark in rule.marks)
    part = F.split(F.col(output), marks)
    spm = F.concat(part[2], part[3], part[1])
    psm = F.concat(part[1], part[3], part[2])
    return F.when(F.col(form) == "plain", F.col(output)).when(F.col(form) == "spm", spm).otherwise(psm)
