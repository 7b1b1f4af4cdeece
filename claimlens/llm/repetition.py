"""Quality rules by repetition coverage.

Rolling hashes of several n-gram lengths give, per text, the share of word
characters that lies inside repeated n-grams and repeated lines.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .frames import arrow_map, text_of
from .words import Texts, per_text, pieces, repeats

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True


@dataclass(frozen=True)
class Limits:
    """Largest allowed shares; a text above one of them is rejected.

    ``top``: characters of the most frequent n-gram, by n. ``covered``: characters
    inside n-grams that occurred before, by n. ``lines``: characters of lines that
    occurred before. ``symbols``: symbols per word. ``min_words`` and
    ``repeat_words`` (per cent) are the base rules.
    """

    top: tuple[tuple[int, float], ...] = ((2, 0.30), (3, 0.28), (4, 0.26))
    covered: tuple[tuple[int, float], ...] = ((5, 0.25), (6, 0.24), (7, 0.23), (8, 0.22), (9, 0.21), (10, 0.20))
    lines: float = 0.25
    symbols: float = 0.3
    min_words: int = 20
    repeat_window: int = 8
    repeat_words: int = 30


def coverage(start: np.ndarray, marked: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of n words lie in a marked window of ``length`` words."""
    step = np.zeros(n + 1, np.int32)
    hit = start[marked]
    np.add.at(step, hit, 1)
    np.add.at(step, hit + length, -1)
    return np.cumsum(step[:-1]) > 0


def measure(texts: pa.Array, limits: Limits = Limits()) -> dict[str, np.ndarray]:
    """All counts and shares of some texts, one entry per text."""
    t = Texts(texts)
    n_words, total = t.n_words, len(t.hash)
    word_chars = t.code_points() - t.spaces()
    # characters of each word: bytes that do not continue a character
    lead = np.zeros(len(t.data) + 1, np.int64)
    np.cumsum((t.data & 0xC0) != 0x80, out=lead[1:])
    chars = lead[t.end] - lead[t.start]
    running = np.zeros(total + 1, np.int64)
    np.cumsum(chars, out=running[1:])

    def covered_chars(words: np.ndarray) -> np.ndarray:
        inside = np.zeros(total + 1, np.int64)
        np.cumsum(np.where(words, chars, 0), out=inside[1:])
        return np.diff(inside[t.first])

    owner = t.owner()
    share = {}
    top, covered = dict(limits.top), dict(limits.covered)
    repeat = np.zeros(total, bool)
    # an n-gram can only repeat where its first n - 1 words do, so every length
    # looks at the places that the length before has left
    place = None
    for length in range(min([*top, *covered, limits.repeat_window]), max([*top, *covered, limits.repeat_window]) + 1):
        start, value = t.grams(length)
        if place is not None:
            inner = place[start]
            start, value = start[inner], value[inner]
        twice, again, group, count = repeats(owner[start], value)
        if length in top:
            best = np.zeros(t.n, np.int64)
            size = count * (running[start[group] + length] - running[start[group]])
            np.maximum.at(best, owner[start[group]], size)
            share[f"top_{length}gram"] = best
        if length in covered:
            share[f"dup_{length}gram"] = covered_chars(coverage(start, again, length, total))
        if length == limits.repeat_window:
            repeat = coverage(start, twice, length, total)
        place = np.zeros(total, bool)
        place[start[twice]] = True
    inside = np.zeros(total + 1, np.int64)
    np.cumsum(repeat, out=inside[1:])
    n_repeat = np.diff(inside[t.first])

    # lines end at \n or with the text; only lines with a word count
    newline = np.flatnonzero(t.data == 10)
    line_start = np.union1d(t.offsets[:-1], newline + 1)
    line_start = line_start[line_start < len(t.data)]
    next_break = np.append(newline, len(t.data))[np.searchsorted(newline, line_start)]
    line_end = np.minimum(next_break, t.offsets[np.minimum(np.searchsorted(t.offsets, line_start, "right"), t.n)])
    first_word, last_word = np.searchsorted(t.start, line_start), np.searchsorted(t.start, line_end)
    worded = last_word > first_word
    line_start, line_end, first_word, last_word = (x[worded] for x in (line_start, line_end, first_word, last_word))
    line_owner = np.searchsorted(t.offsets, line_start, "right") - 1
    _, again, _, _ = repeats(line_owner, t.span(line_start, line_end))
    n_dup_lines = np.bincount(line_owner[again], minlength=t.n)
    line_chars = running[last_word] - running[first_word]
    dup_line_chars = np.bincount(line_owner[again], weights=line_chars[again], minlength=t.n)

    n_symbols = per_text(SYMBOLS[t.data], t.offsets)
    base = (n_words < limits.min_words) | (100 * n_repeat > limits.repeat_words * n_words)
    some = np.maximum(word_chars, 1)
    share = {k: v / some for k, v in share.items()}
    share["dup_line_chars"] = dup_line_chars / some
    bad = n_symbols > limits.symbols * n_words
    bad |= share["dup_line_chars"] > limits.lines
    for length, most in limits.top:
        bad |= share[f"top_{length}gram"] > most
    for length, most in limits.covered:
        bad |= share[f"dup_{length}gram"] > most
    return {
        "n_words": n_words,
        "word_chars": word_chars,
        "n_symbols": n_symbols,
        "n_dup_lines": n_dup_lines,
        "n_repeat_words": n_repeat,
        "base_failed": base,
        "kept": ~base & ~bad,
        **share,
    }


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _schema(limits: Limits) -> str:
    shares = [f"top_{n}gram" for n, _ in limits.top] + [f"dup_{n}gram" for n, _ in limits.covered] + ["dup_line_chars"]
    return ", ".join(
        [f"{c} bigint" for c in COUNTS] + ["base_failed boolean", "kept boolean"] + [f"{c} double" for c in shares]
    )


def repetition_report(docs: DataFrame, limits: Limits = Limits(), text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns of every row plus counts, shares and the verdict ``kept``.

    One pass without a shuffle. Null and empty texts have no words and fail the
    base rule; repeated rows are judged alike; an empty table gives no rows.
    ``keep`` columns whose name clashes with a measure are renamed by the caller.
    """
    rows = docs.select(*keep, text_of(text).alias("__text"))
    schema = rows.drop("__text").schema
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    names = list(keep)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for piece in pieces(batch, "__text"):
            m = measure(piece.column("__text"), limits)
            columns = [piece.column(c) for c in names] + [pa.array(v) for v in m.values()]
            out.append(pa.RecordBatch.from_arrays(columns, names=[*names, *m]))
        return pa.Table.from_batches(out).combine_chunks().to_batches()[0] if out else None

    return arrow_map(rows, work, f"{fields}, {_schema(limits)}")


def filter_by_quality(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The rows of ``docs`` whose text passes all rules, columns unchanged."""
    columns = docs.columns
    schema = docs.schema

    def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        kept = [measure(p.column("text"), limits)["kept"] for p in pieces(batch, "text")]
        return batch.filter(pa.array(np.concatenate(kept))) if kept else None

    return arrow_map(docs.select(*columns), work, schema)
