"""Document fingerprints by consistent weighted sampling.

Terms are word n-grams, padded at the front so that short texts have terms too,
weighted by how often they occur. For every sample each term draws r and c from
Gamma(2, 1) and b from U(0, 1); with weight S it takes t = floor(ln S / r + b) and
the value ln c - r (t - b + 1). The term with the least value and its t are the
sample. Two texts agree on a sample with probability sum(min)/sum(max) of their
weights, the generalised Jaccard similarity.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from .frames import Batches, shuffle_width, text_of
from .words import U64, Texts, grams, mix, pieces

DRAWS = 1 << 16
START = mix(np.arange(7, 8, dtype=U64))[0]


@dataclass(frozen=True)
class Sampling:
    """``samples`` per fingerprint, ``length`` words per term, seed of the draws."""

    samples: int = 64
    length: int = 5
    seed: int = 20


class Sampler:
    """The draws of a ``Sampling``.

    A term's draws are entries of one table of 2**16 triples; a multiplicative
    hash of the term, another for each sample, picks the entry.
    """

    def __init__(self, sampling: Sampling):
        self.sampling = sampling
        rng = np.random.default_rng(sampling.seed)
        self.r = rng.gamma(2.0, 1.0, DRAWS)
        self.log_c = np.log(rng.gamma(2.0, 1.0, DRAWS))
        self.b = rng.random(DRAWS)
        self.keys = mix(np.arange(sampling.samples, dtype=U64) + U64(sampling.seed << 20)) | U64(1)
        self.tables: dict[float, tuple[np.ndarray, np.ndarray]] = {}

    def table(self, weight: float) -> tuple[np.ndarray, np.ndarray]:
        """For terms of this weight: values in the upper 32 bits (as ordered integers), and t."""
        if weight not in self.tables:
            if len(self.tables) > 64:
                self.tables.clear()
            t = np.floor(np.log(weight) / self.r + self.b)
            value = (self.log_c - self.r * (t - self.b + 1)).astype(np.float32)
            bits = value.view(np.uint32)
            ordered = np.where(bits >> 31, ~bits, bits | np.uint32(1 << 31))
            self.tables[weight] = ordered.astype(U64) << U64(32), t.astype(np.int64).astype(U64)
        return self.tables[weight]

    def signatures(self, owner: np.ndarray, term: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
        """(n, samples) 16-bit samples of n sets of distinct weighted terms, entries by ascending owner.

        A set without terms gets zeros.
        """
        out = np.zeros((n, self.sampling.samples), np.uint16)
        if not len(owner):
            return out
        head = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        kinds = [(w, np.flatnonzero(weight == w)) for w in np.unique(weight) if w != 1]
        tables = [(where, *self.table(float(w))) for w, where in kinds]
        ones, _ = self.table(1.0)
        low = term & U64(0xFFFFFFFF)
        for k, key in enumerate(self.keys):
            entry = (term * key) >> U64(48)
            value = ones[entry]
            for where, other, _ in tables:
                value[where] = other[entry[where]]
            value |= low
            best = np.minimum.reduceat(value, head)
            # t of the chosen term; it is 0 for weight 1, as most weights are
            t = np.zeros(len(head), U64)
            if tables:
                chosen = np.flatnonzero(value == np.repeat(best, np.diff(np.r_[head, len(value)])))
                at = chosen[np.searchsorted(chosen, head)]
                for where, _, other_t in tables:
                    mine = np.isin(at, where)
                    t[mine] = other_t[entry[at[mine]]]
            best = mix(best & U64(0xFFFFFFFF)) ^ mix(t)
            out[owner[head], k] = (mix(best) >> U64(48)).astype(np.uint16)
        return out

    def of_texts(self, texts: pa.Array) -> np.ndarray:
        """Samples of whole texts."""
        t = Texts(texts)
        pad = self.sampling.length - 1
        # start marks before the words of each text
        n_words = t.n_words
        first = np.zeros(t.n + 1, np.int64)
        np.cumsum(n_words + pad, out=first[1:])
        padded = np.full(first[-1], START, U64)
        padded[np.arange(len(t.hash)) + pad * (t.owner() + 1)] = t.hash
        start, term = grams(padded, first, self.sampling.length)
        owner = np.searchsorted(first, start, "right") - 1
        key = term ^ mix(owner.astype(U64))
        order = np.argsort(key, kind="stable")
        key = key[order]
        new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        weight = np.diff(np.r_[new, len(key)])
        first_of = order[new]
        by_owner = np.argsort(first_of)
        at = first_of[by_owner]
        return self.signatures(owner[at], term[at], weight[by_owner], t.n)


_samplers: dict[Sampling, Sampler] = {}


def sampler(sampling: Sampling) -> Sampler:
    if sampling not in _samplers:
        _samplers[sampling] = Sampler(sampling)
    return _samplers[sampling]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal samples, row by row."""
    return (a == b).mean(axis=1)


def fingerprints(docs: DataFrame, sampling: Sampling = Sampling(), keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns and ``fingerprint`` (4 hex digits per sample) of every row; no shuffle.

    Null counts as the empty text; texts without a word share one fingerprint.
    """
    rows = docs.select(*keep, text_of().alias("__text"))
    names = list(keep)

    def run(batches: Batches) -> Batches:
        engine = sampler(sampling)
        for batch in batches:
            for piece in pieces(batch, "__text"):
                marks = [x.tobytes().hex() for x in engine.of_texts(piece.column("__text")).astype(">u2")]
                yield pa.RecordBatch.from_arrays([*[piece.column(c) for c in names], pa.array(marks, pa.string())], names=[*names, "fingerprint"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.drop("__text").schema)
    return rows.mapInArrow(run, f"{schema}, fingerprint string")


PAIR_SCHEMA = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def compare_with_edits(docs: DataFrame, sampling: Sampling = Sampling()) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    The edited text replaces the last floor(n/2) code points by the first as many
    (or all) of the next document by ascending id; after the last comes the first.
    Rows of equal id follow each other by text, null ids come first. One row per
    row of ``docs``; an only row is its own successor; an empty table gives none.

    The texts move once, into ranges of ids; each range also gets the first row
    of the range after it, so no task needs another's rows.
    """
    spark = docs.sparkSession
    width = shuffle_width(spark)
    low = -(1 << 63)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    order_id = F.coalesce("doc_id", F.lit(low))
    # range limits, one number per partition
    probs = [i / width for i in range(1, width)] or [0.5]
    limits = rows.select(F.percentile_approx(order_id, probs, 100 * width)).first()[0]
    if limits is None:
        return spark.createDataFrame([], PAIR_SCHEMA)
    limits = np.unique(np.array(limits, np.int64))

    @F.pandas_udf(LongType())
    def bucket_of(ids):
        import pandas as pd

        return pd.Series(np.searchsorted(limits, ids.to_numpy(np.int64), "right"))

    ranges = rows.select(order_id.alias("id")).withColumn("bucket", bucket_of("id"))
    firsts = sorted((r.bucket, r.id) for r in ranges.groupBy("bucket").agg(F.min("id").alias("id")).collect())
    before = {firsts[(i + 1) % len(firsts)][1]: b for i, (b, _) in enumerate(firsts)}
    heads = (
        rows.where(order_id.isin(list(before)))
        .groupBy("doc_id")
        .agg(F.min("text").alias("text"))
        .withColumn("tail", F.lit(True))
    )
    target = spark.createDataFrame([(i, b) for i, b in before.items()], "id long, bucket long")
    heads = heads.join(F.broadcast(target), F.coalesce("doc_id", F.lit(low)) == F.col("id")).drop("id")
    placed = rows.withColumns({"tail": F.lit(False), "bucket": bucket_of(order_id)}).unionByName(heads)
    ordered = placed.repartitionByRange(width, "bucket").sortWithinPartitions("bucket", "tail", F.col("doc_id").asc_nulls_first(), "text")
    return ordered.mapInArrow(lambda batches: _edited_rows(batches, sampling), PAIR_SCHEMA)


def _edited_rows(batches: Batches, sampling: Sampling) -> Batches:
    """Walk ordered rows; each row is finished when its successor is known."""
    engine = sampler(sampling)
    held: tuple | None = None  # (bucket, tail, doc_id, text, samples) of the last row seen
    for batch in batches:
        for piece in pieces(batch.select(["doc_id", "text", "tail", "bucket"]), "text"):
            own = engine.of_texts(piece.column("text"))
            ids, texts, tails, buckets = (piece.column(i).to_pylist() for i in range(4))
            if held is not None:
                buckets, tails, ids, texts = [held[0], *buckets], [held[1], *tails], [held[2], *ids], [held[3], *texts]
                own = np.vstack([held[4][None], own])
            held = buckets[-1], tails[-1], ids[-1], texts[-1], own[-1]
            here = [i for i in range(len(ids) - 1) if not tails[i]]
            if not here:
                continue
            if any(buckets[i] != buckets[i + 1] for i in here):
                raise ValueError("a row has no successor in its range")
            edited = []
            for i in here:
                half = len(texts[i]) // 2
                edited.append(texts[i][: len(texts[i]) - half] + texts[i + 1][:half])
            changed = engine.of_texts(pa.array(edited, pa.large_string()))
            at = np.array(here)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([ids[i] for i in here], pa.int64()),
                    pa.array([len(texts[i]) for i in here], pa.int64()),
                    pa.array([hashlib.sha256(x.encode()).hexdigest() for x in edited]),
                    pa.array([x.tobytes().hex() for x in own[at].astype(">u2")]),
                    pa.array([x.tobytes().hex() for x in changed.astype(">u2")]),
                    pa.array(likeness(own[at], changed)),
                    pa.array(likeness(own[at], own[at + 1])),
                ],
                names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )
    if held is not None and not held[1]:
        raise ValueError("the last row of a range has no successor")
