"""Vector code compression: codebooks of vector parts, learnt in rounds with norm-of-sum bounds.

Every vector is cut into equal parts; a part's code is its nearest codebook entry.
Between rounds a row keeps, per part and group of entries, a lower bound of its
distance to the group and the round that bound is from. The codebooks of all rounds
are kept, so a later round lowers the bound by the true displacement of the entries
since that round (the norm of the summed moves), not by the sum of the moves' norms.
Where the distance to the own entry stays below the bound, the group is not looked at;
any other group is measured again, exactly. Components are integers, so are distances.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.functions.checkpoints import lookup_side

from .frames import Batches, discard, stored

# distances are exact in doubles below this, and sums of squares in long integers below the next
EXACT, LONGEST = float(1 << 53), float(1 << 63)
# relative slack for square roots; bounds are moved outwards by it
SLACK = 1e-12


@dataclass(frozen=True)
class Codes:
    """``parts`` per vector, ``entries`` per codebook, ``rounds`` of learning; components become floor(scale * x).

    ``groups``: how many bounds a row keeps per part.
    """

    parts: int = 4
    entries: int = 256
    rounds: int = 4
    scale: int = 1024
    groups: int = 8


def squared(x: np.ndarray, entry: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to entries; integers held as doubles, or as longs beyond their range."""
    if x.dtype == np.int64:
        return np.stack([np.square(x - e).sum(axis=1) for e in entry], axis=1)
    return np.square(x).sum(axis=1)[:, None] - 2 * (x @ entry.T) + np.square(entry).sum(axis=1)


def grouped(entry: np.ndarray, groups: int) -> np.ndarray:
    """Group of each entry: the nearest of some entries that lie far apart."""
    least = squared(entry, entry[:1])[:, 0]
    owner = np.zeros(len(entry), np.int64)
    for g in range(1, min(groups, len(entry))):
        at = squared(entry, entry[[int(np.argmax(least))]])[:, 0]
        owner[at < least] = g
        least = np.minimum(least, at)
    return owner


def below(value: np.ndarray) -> np.ndarray:
    """Single-precision numbers not above ``value``."""
    return np.nextafter((value * (1 - SLACK)).astype(np.float32), np.float32(-np.inf))


class PartBounds:
    """One part's entries in the latest round, and how far each group has moved since each earlier round."""

    def __init__(self, history: np.ndarray, groups: int):
        """``history`` has (round, entry, component)."""
        self.entry = history[-1]
        self.round = len(history) - 1
        self.owner = grouped(history[0], groups)
        self.members = [np.flatnonzero(self.owner == g) for g in range(groups)]
        net = np.sqrt(np.square(history[-1] - history).sum(axis=2).astype(np.float64)) * (1 + SLACK)
        self.moved = np.stack([net[:, m].max(axis=1, initial=0) for m in self.members])

    def first(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Code, squared distance, bounds and their rounds, from all entries."""
        distance = squared(x, self.entry)
        code = distance.argmin(axis=1)
        own = distance[np.arange(len(x)), code]
        others = distance.astype(np.float64)
        others[np.arange(len(x)), code] = np.inf
        low = np.stack([others[:, m].min(axis=1, initial=np.inf) for m in self.members], axis=1)
        return code, own, below(np.sqrt(low)), np.full(low.shape, self.round, np.int8)

    def again(self, x: np.ndarray, code: np.ndarray, low: np.ndarray, stamp: np.ndarray):
        """The same as ``first`` from the bounds of earlier rounds; also how many distances were measured."""
        n = np.arange(len(x))
        own = np.square(x - self.entry[code]).sum(axis=1)
        held = low.astype(np.float64) - self.moved[np.arange(len(self.members)), stamp]
        open_ = np.sqrt(own.astype(np.float64))[:, None] * (1 + SLACK) >= held
        best, where = own.copy(), code.copy()
        nearest = np.full(low.shape, -1, np.int64)
        least, second = np.full(low.shape, np.inf), np.full(low.shape, np.inf)
        measured = len(x)
        for g, members in enumerate(self.members):
            rows = np.flatnonzero(open_[:, g])
            if not len(rows) or not len(members):
                continue
            distance = squared(x[rows], self.entry[members])
            measured += distance.size
            at = distance.argmin(axis=1)
            value = distance[np.arange(len(rows)), at]
            nearest[rows, g] = members[at]
            least[rows, g] = value
            distance = distance.astype(np.float64)
            distance[np.arange(len(rows)), at] = np.inf
            second[rows, g] = distance.min(axis=1)
            closer = (value < best[rows]) | ((value == best[rows]) & (members[at] < where[rows]))
            best[rows[closer]], where[rows[closer]] = value[closer], members[at][closer]
        # a measured group is bounded anew, without the entry that the row belongs to
        fresh = np.sqrt(np.where(nearest == where[:, None], second, least))
        low, stamp = np.where(open_, below(fresh), low), np.where(open_, np.int8(self.round), stamp)
        # the entry that a row left counts for its group from now on
        left = self.owner[code]
        away = (where != code) & ~open_[n, left]
        bound = np.minimum(held[n, left], np.sqrt(own.astype(np.float64)))
        low[n[away], left[away]] = below(bound[away])
        stamp[n[away], left[away]] = self.round
        return where, best, low, stamp, measured


def _matrix(column: pa.Array, kind) -> np.ndarray:
    return np.asarray(column.flatten()).astype(kind).reshape(len(column), -1)


def _list(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = pa.array(np.arange(len(values) + 1, dtype=np.int32) * values.shape[1])
    return pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(values).ravel()).cast(kind))


STATE = "vec_id {id}, label {label}, x array<long>, code array<int>, error long, low array<float>, stamp array<tinyint>"


def _assigned(batches: Batches, history: np.ndarray, rule: Codes) -> Batches:
    """Codes and bounds of every row under the latest codebooks; ``history`` has (round, part, entry, component)."""
    parts = [PartBounds(history[:, p], rule.groups) for p in range(rule.parts)]
    width = history.shape[-1]
    for batch in batches:
        if not batch.num_rows:
            continue
        x = _matrix(batch.column("x"), history.dtype)
        first = len(history) == 1
        if not first:
            codes = _matrix(batch.column("code"), np.int64)
            lows = _matrix(batch.column("low"), np.float32)
            stamps = _matrix(batch.column("stamp"), np.int8)
        found = []
        for p, bounds in enumerate(parts):
            part, span = x[:, p * width : (p + 1) * width], slice(p * rule.groups, (p + 1) * rule.groups)
            found.append(bounds.first(part) if first else bounds.again(part, codes[:, p], lows[:, span], stamps[:, span])[:4])
        error = sum(f[1].astype(np.int64) for f in found)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("vec_id"),
                batch.column("label"),
                batch.column("x"),
                _list(np.stack([f[0] for f in found], axis=1), pa.int32()),
                pa.array(error),
                _list(np.concatenate([f[2] for f in found], axis=1), pa.float32()),
                _list(np.concatenate([f[3] for f in found], axis=1), pa.int8()),
            ],
            names=["vec_id", "label", "x", "code", "error", "low", "stamp"],
        )


def _sums(batches: Batches, shape: tuple[int, int, int]) -> Batches:
    """Counts and component sums of each entry's parts in one partition."""
    parts, entries, width = shape
    total, count = np.zeros(shape, np.int64), np.zeros((parts, entries), np.int64)
    for batch in batches:
        if not batch.num_rows:
            continue
        x, code = _matrix(batch.column("x"), np.int64), _matrix(batch.column("code"), np.int64)
        for p in range(parts):
            np.add.at(total[p], code[:, p], x[:, p * width : (p + 1) * width])
            count[p] += np.bincount(code[:, p], minlength=entries)
    part, entry = np.nonzero(count)
    if len(part):
        yield pa.RecordBatch.from_arrays(
            [pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(count[part, entry]), _list(total[part, entry], pa.int64())],
            names=["part", "entry", "n", "total"],
        )


def moved_entries(state: DataFrame, entry: np.ndarray) -> np.ndarray:
    """The floor of the mean of each entry's parts; an entry without parts stays."""
    sums = state.select("x", "code").mapInArrow(
        lambda b: _sums(b, entry.shape), "part int, entry int, n long, total array<long>"
    )
    means = sums.groupBy("part", "entry").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.col("total")[i]) for i in range(entry.shape[2])]).alias("total")
    )
    out = entry.copy()
    # one row per codebook entry, whatever the number of vectors
    for row in means.collect():
        out[row.part, row.entry] = [t // row.n for t in row.total]
    return out


def usable(vectors: DataFrame, rule: Codes) -> DataFrame:
    """vec_id, label and integer components of the rows whose vector is whole and finite."""
    finite = F.forall("embedding", lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))), F.lit(False)))
    x = F.transform("embedding", lambda v: F.floor(v.cast("double") * rule.scale).cast("long"))
    return vectors.where(F.col("embedding").isNotNull() & finite).select("vec_id", "label", x.alias("x"))


def encode(vectors: DataFrame, rule: Codes = Codes()) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error) of every usable row, and the codebooks (part, entry, component).

    Rows whose vector is null, or holds a null or a value that is not finite, are
    dropped. The others need one length, a multiple of ``parts``, and components whose
    squared distances fit a long; else a ValueError tells. The codebooks start from the
    rows of the least vec_id (nulls last, ties by vector); fewer rows give fewer
    entries, an empty table no rows. Repeated rows count each. Two tables of one row
    per vector exist at a time; the driver holds the codebooks only.
    """
    spark = vectors.sparkSession
    rows = stored(usable(vectors, rule))
    top = F.max(F.greatest(F.coalesce(F.array_max("x"), F.lit(0)), -F.coalesce(F.array_min("x"), F.lit(0))))
    shape = rows.agg(F.min(F.size("x")).alias("least"), F.max(F.size("x")).alias("most"), top.alias("top")).first()
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    if shape.least is None:
        empty = spark.createDataFrame([], f"vec_id {kinds['vec_id']}, label {kinds['label']}, code array<int>, error long")
        return empty, np.zeros((rule.parts, 0, 0), np.int64)
    if shape.least != shape.most or shape.least % rule.parts:
        raise ValueError(f"vectors of {shape.least} to {shape.most} components cannot be cut into {rule.parts} equal parts")
    reach = 4.0 * shape.top**2 * max(1, shape.least)
    if reach >= LONGEST:
        raise ValueError("components are too large for exact distances")
    width = shape.least // rule.parts
    start = rows.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(rule.entries).select("x").collect()
    entry = np.array([r.x for r in start], np.int64).reshape(len(start), rule.parts, width).transpose(1, 0, 2)
    history, state = [entry], rows
    for turn in range(rule.rounds + 1):
        known = np.stack(history).astype(np.float64 if reach < EXACT else np.int64)
        schema = STATE.format(id=kinds["vec_id"], label=kinds["label"])
        found = state.mapInArrow(lambda b, known=known: _assigned(b, known, rule), schema)
        if turn == rule.rounds:
            found = found.select("vec_id", "label", "code", "error")
        before, state = state, stored(found)
        discard(before)
        if turn < rule.rounds:
            history.append(moved_entries(state, history[-1]))
    return state, history[-1]


def codebook_digest(entry: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(v) for v in entry.ravel().tolist()).encode()).hexdigest()


def code_report(vectors: DataFrame, rule: Codes = Codes()) -> DataFrame:
    """vec_id, code (two hex digits per part), error, label_error and codebooks_sha256 of every usable row.

    ``label_error`` sums the errors of the rows of a label (null is one label); the sums
    are combined before they are dealt and broadcast only if measured small.
    """
    found, entry = encode(vectors, rule)
    digits = F.transform("code", lambda c: F.lower(F.lpad(F.hex(c.cast("long")), 2, "0")))
    rows = found.select("vec_id", "label", F.array_join(digits, "").alias("code"), "error")
    labels = lookup_side(rows.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")))
    return rows.join(labels, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label_error", F.lit(codebook_digest(entry)).alias("codebooks_sha256")
    )
