"""Substring dedup by hashes of word windows under minimiser anchors.

An anchor is the 8-word gram with the least hash among the grams of some 35-word
window, so equal windows hold equal anchors. Anchors are counted first; windows under
one that occurs once cannot repeat and drop out. The others are grouped by the anchor,
or, where it is too frequent for one task, by the whole window. Inside a group a
window hash met twice is a repeat. No suffix tree is built: what is removed depends
only on which windows occur twice.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import Batches, shuffle_width, text_of
from .words import U64, Texts, mix, pieces, run_hash

LOW = -(1 << 63)


@dataclass(frozen=True)
class Repeats:
    """Window and anchor length in words; an anchor with more than ``group`` occurrences is split by window."""

    window: int = 35
    anchor: int = 8
    group: int = 2000


def slide(pick: np.ufunc, x: np.ndarray, width: int) -> np.ndarray:
    """Minimum or maximum of every ``width`` neighbours."""
    if len(x) < width:
        return x[:0]
    done = 1
    while done * 2 <= width:
        x = pick(x[: len(x) - done], x[done:])
        done *= 2
    rest = width - done
    return pick(x[: len(x) - rest], x[rest:]) if rest else x


class Windows:
    """Windows of some texts: start word, hash, and the hash of the anchor of each."""

    def __init__(self, texts: pa.Array, rule: Repeats):
        self.texts = t = Texts(texts)
        total = len(t.hash)
        self.start, self.hash = t.grams(rule.window)
        span = rule.window - rule.anchor + 1
        at, value = t.grams(rule.anchor)
        gram = np.zeros(total, U64)
        gram[at] = value
        self.anchor = slide(np.minimum, gram, span)[self.start] if len(self.start) else np.zeros(0, U64)
        self.owner = t.owner()[self.start]
        # places of the anchors: grams equal to the least of a window around them
        least = np.zeros(total + span - 1, U64)
        least[self.start + span - 1] = self.anchor
        around = slide(np.maximum, least, span)[:total]
        self.place = np.flatnonzero((gram == around) & (around > 0))
        self.place_hash = gram[self.place]
        self.place_owner = t.owner()[self.place]


def keyed(docs: DataFrame) -> DataFrame:
    """(k1, k2, doc_id, text): two non-null keys that name a row by id and text."""
    text = text_of()
    return docs.select(
        F.xxhash64("doc_id", text).alias("k1"), F.coalesce(F.col("doc_id").cast("long"), F.lit(LOW)).alias("k2"), F.col("doc_id"), text.alias("text")
    )


def repeated_words(docs: DataFrame, rule: Repeats = Repeats()) -> DataFrame:
    """doc_id, n_words, n_removed, spans (start and length of the maximal repeats, in words), kept_text.

    A window of ``rule.window`` words is repeated if its words also start anywhere
    else, in the same text included; all judged on the input. ``kept_text`` joins the
    other words by single spaces. Null counts as empty; shorter texts keep all words;
    equal rows repeat each other; an empty table gives no rows.

    Texts are shuffled once, by row key. Copies inside a batch are combined before the
    shuffle, so a passage held by very many documents sends one row per batch.
    """
    width = shuffle_width(docs.sparkSession)
    rows = keyed(docs)

    def census(batches: Batches) -> Batches:
        for batch in batches:
            for piece in pieces(batch, "text"):
                w = Windows(piece.column("text"), rule)
                value, count = np.unique(w.place_hash, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(count)], names=["anchor", "n"])

    def places(batches: Batches) -> Batches:
        for batch in batches:
            for piece in pieces(batch, "text"):
                w = Windows(piece.column("text"), rule)
                pair = np.unique(np.stack([w.place_owner.astype(U64), w.place_hash], axis=1), axis=0) if len(w.place) else np.zeros((0, 2), U64)
                of = pa.array(pair[:, 0].astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pair[:, 1].copy().view(np.int64)), piece.column("k1").take(of), piece.column("k2").take(of)], names=["anchor", "k1", "k2"]
                )

    frequent = (
        rows.select("text").mapInArrow(census, "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n"))
        .where("n > 1").select("anchor", (F.col("n") > rule.group).alias("big"))
    )
    marked = (
        rows.select("k1", "k2", "text").mapInArrow(places, "anchor long, k1 long, k2 long").join(frequent, "anchor")
        .groupBy("k1", "k2")
        .agg(F.collect_set(F.when(~F.col("big"), F.col("anchor"))).alias("small"), F.collect_set(F.when(F.col("big"), F.col("anchor"))).alias("big"))
    )
    laid_out = rows.repartition(width, "k1", "k2")
    suffixes = laid_out.join(marked, ["k1", "k2"]).select("k1", "k2", "text", "small", "big")
    cells = suffixes.mapInArrow(lambda b: _cells(b, rule), "route long, k1 long, k2 long, start int, known boolean, path binary, n int")
    grouped = cells.repartition(width, "route").sortWithinPartitions("route")
    found = grouped.mapInArrow(_nodes, "k1 long, k2 long, start int, hit binary")
    by_row = found.groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "hit")).alias("hits"))
    out = laid_out.join(by_row, ["k1", "k2"], "left").select("doc_id", "text", "hits")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return out.mapInArrow(
        lambda b: _remove(b, rule),
        f"doc_id {id_type}, n_words long, n_removed long, spans array<struct<start:int,length:int>>, kept_text string",
    )


def _cells(batches: Batches, rule: Repeats) -> Batches:
    """The windows under frequent anchors, as runs that share text and anchor.

    Runs of equal content inside the batch are repeats at once: the first goes on,
    marked as known, the others carry their length only.
    """
    for batch in batches:
        for piece in pieces(batch, "text"):
            w = Windows(piece.column("text"), rule)
            if not len(w.start):
                continue

            def listed(name: str) -> np.ndarray:
                lists = piece.column(name)
                value = lists.flatten().to_numpy(zero_copy_only=False).view(U64)
                of = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
                known = np.sort(value ^ mix(of.astype(U64)))
                key = w.anchor ^ mix(w.owner.astype(U64))
                at = np.minimum(np.searchsorted(known, key), max(len(known) - 1, 0))
                return known[at] == key if len(known) else np.zeros(len(key), bool)

            big = listed("big")
            use = np.flatnonzero(listed("small") | big)
            if not len(use):
                continue
            start, path, anchor, owner, big = w.start[use], w.hash[use], w.anchor[use], w.owner[use], big[use]
            opens = np.ones(len(use), bool)
            opens[1:] = (start[1:] != start[:-1] + 1) | (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1]) | big[1:]
            head = np.flatnonzero(opens)
            size = np.diff(np.append(head, len(use)))
            # content of a run: all its windows
            content = run_hash(path, head, head + size)
            _, first, back, count = np.unique(content, return_index=True, return_inverse=True, return_counts=True)
            known = count[back] > 1
            goes = np.zeros(len(head), bool)
            goes[first] = True
            of = owner[head]
            route = np.where(big[head], path[head], anchor[head]).view(np.int64)
            k1 = piece.column("k1").take(pa.array(of))
            # runs that stay behind are spread by their row
            route = np.where(goes, route, k1.to_numpy())
            raw, edges = path.tobytes(), 8 * np.append(head, len(use))
            blobs = [raw[a:b] if g else b"" for a, b, g in zip(edges[:-1].tolist(), edges[1:].tolist(), goes.tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(route),
                    k1,
                    piece.column("k2").take(pa.array(of)),
                    pa.array((start[head] - w.texts.first[of]).astype(np.int32)),
                    pa.array(known),
                    pa.array(blobs, pa.binary()),
                    pa.array(size.astype(np.int32)),
                ],
                names=["route", "k1", "k2", "start", "known", "path", "n"],
            )


def _nodes(batches: Batches) -> Batches:
    """Windows met twice inside a group; rows of a group stand together."""
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        route = table.column("route").to_numpy()
        cut = int(np.searchsorted(route, route[-1]))
        held = table.slice(cut)
        if cut:
            yield from _twice(table.slice(0, cut))
    if held is not None:
        yield from _twice(held)


def _twice(table: pa.Table) -> Batches:
    table = table.combine_chunks()
    route, known, n = (table.column(c).to_numpy() for c in ("route", "known", "n"))
    sent = np.array([len(x) for x in table.column("path").to_pylist()], np.int64) // 8 if table.num_rows else np.zeros(0, np.int64)
    path = np.frombuffer(b"".join(table.column("path").to_pylist()), U64)
    of = np.repeat(np.arange(len(n)), sent)
    key = path ^ mix(route.view(U64))[of]
    _, back, count = np.unique(key, return_inverse=True, return_counts=True)
    hit = (count[back] > 1) | known[of]
    edges = np.zeros(len(n) + 1, np.int64)
    np.cumsum(sent, out=edges[1:])
    out = []
    raw = hit.astype(np.uint8).tobytes()
    for a, b, size in zip(edges[:-1].tolist(), edges[1:].tolist(), n.tolist()):
        out.append(raw[a:b] if b > a else b"\x01" * size)
    keep = np.flatnonzero([b"\x01" in x for x in out])
    take = pa.array(keep)
    for batch in pa.table(
        {"k1": table.column("k1").take(take), "k2": table.column("k2").take(take), "start": table.column("start").take(take), "hit": pa.array([out[i] for i in keep], pa.binary())}
    ).to_batches():
        yield batch


def _remove(batches: Batches, rule: Repeats) -> Batches:
    for batch in batches:
        for piece in pieces(batch, "text"):
            t = Texts(piece.column("text"))
            step = np.zeros(len(t.hash) + 1, np.int64)
            for i, hits in enumerate(piece.column("hits").to_pylist()):
                base = int(t.first[i])
                for h in hits or ():
                    at = np.flatnonzero(np.frombuffer(h["hit"], np.uint8)) + (base + h["start"])
                    np.add.at(step, at, 1)
                    np.add.at(step, at + rule.window, -1)
            gone = np.cumsum(step[:-1]) > 0
            running = np.zeros(len(gone) + 1, np.int64)
            np.cumsum(gone, out=running[1:])
            removed = np.diff(running[t.first])
            raw, texts, spans = t.data.tobytes(), [], []
            for i in range(t.n):
                a, b = int(t.first[i]), int(t.first[i + 1])
                keep = np.flatnonzero(~gone[a:b]) + a
                texts.append(b" ".join([raw[x:y] for x, y in zip(t.start[keep].tolist(), t.end[keep].tolist())]))
                edge = np.flatnonzero(np.diff(np.concatenate([[0], gone[a:b].astype(np.int8), [0]])))
                spans.append([{"start": int(x), "length": int(y - x)} for x, y in zip(edge[::2], edge[1::2])])
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("doc_id"),
                    pa.array(t.n_words),
                    pa.array(removed),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())]))),
                    pa.array(texts, pa.binary()).cast(pa.string()),
                ],
                names=["doc_id", "n_words", "n_removed", "spans", "kept_text"],
            )
