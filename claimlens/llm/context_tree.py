"""Language-model scores by context-tree weighting over bytes.

A byte is eight binary decisions; a node of the tree is a context of the last d
bytes, d = 0..depth, together with the bits of the byte decided so far. Every node
counts its zeros and ones in the training texts, which fix its Krichevsky-Trofimov
probability. From the leaves up, a node weighs its own estimate and the product of
its children, half each; the posterior weights mix the estimates of all depths into
one probability per decision. Counts are sums, so the tree comes from one
aggregation over the corpus.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .frames import Batches, shuffle_width, small_batches, stored, text_of
from .words import U64, Texts, lowered, mix, pieces, release

# no UTF-8 text holds this byte: it stands before the first and after the last one
EDGE = 0xFF
DEPTH = 5
END_TOKEN = int(mix(np.arange(11, 12, dtype=U64))[0].view(np.int64))
WORD, GRAM = 0, 1
# contexts with their byte that one task of the tree works on
GROUP_GRAMS = 200_000
# texts of a block are worked through in pieces of about this many bytes
PART_BYTES = 1 << 19
# distinct contexts that a task holds before it sends them on
HELD_GRAMS = 1_000_000


@dataclass(frozen=True)
class Scoring:
    """Texts are scored in blocks of about ``block_bytes``; each block fetches the numbers of its own words and contexts."""

    block_bytes: int = 24 << 20


def log_gamma(x: np.ndarray) -> np.ndarray:
    """log Gamma for x > 0 by Stirling's series, shifted up by eight."""
    shift = np.zeros_like(x)
    for i in range(8):
        shift += np.log(x + i)
    z = x + 8
    return (z - 0.5) * np.log(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5) - shift


def estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of a sequence with these counts."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - math.log(math.pi)


def weigh(own: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(log weighted probability, posterior weight of the own estimate)."""
    weighted = np.logaddexp(own, below) - math.log(2)
    return weighted, np.exp(own - math.log(2) - weighted)


def symbols(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(context and byte as one number, first symbol of each text): every byte of every text, then the edge."""
    n = len(offsets) - 1
    first = offsets + np.arange(n + 1)
    # each text stands behind DEPTH edges and before one more
    stream = np.full(len(data) + n * (DEPTH + 1), EDGE, np.uint8)
    place = np.ones(len(stream), bool)
    begin = offsets[:-1] + np.arange(n) * (DEPTH + 1)
    for k in range(DEPTH):
        place[begin + k] = False
    symbol = np.flatnonzero(place)
    place[offsets[1:] + np.arange(1, n + 1) * (DEPTH + 1) - 1] = False
    stream[place] = data
    wide = np.zeros(len(stream), U64)
    for back in range(DEPTH, -1, -1):
        wide <<= U64(8)
        wide[back:] |= stream[: len(stream) - back]
    return wide[symbol], first


class Branch:
    """The parts of the tree under some two-byte contexts, from depth 2 down.

    Nodes that differ in the bits decided never meet, so the eight decisions of a
    byte are worked on one after another and hold an eighth of the memory.
    """

    def __init__(self, key: np.ndarray, count: np.ndarray):
        self.byte = (key & U64(0xFF)).astype(np.int64)
        self.context = (key >> U64(8)).astype(np.int64)
        self.weight = count.astype(np.float64)

    def decision(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(bits decided before decision ``k`` behind a one, flag for a one as the bit) of each gram."""
        return (1 << k) | (self.byte >> (8 - k)), (self.byte >> (7 - k) & 1).astype(bool)

    def levels(self, node: np.ndarray, one: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """From ``DEPTH`` to depth 2: place of each gram, then by place the node, its zeros, ones, log weighted probability and posterior weight."""
        below = None
        for depth in range(DEPTH, 1, -1):
            mask = (1 << (8 * depth)) - 1
            nodes, at = np.unique((self.context & mask) << 8 | node, return_inverse=True)
            zeros = np.bincount(at, np.where(one, 0, self.weight), len(nodes))
            ones = np.bincount(at, np.where(one, self.weight, 0), len(nodes))
            total, stop = estimate(zeros, ones), np.ones(len(nodes))
            if below is not None:
                kids, value = below
                parent = np.searchsorted(nodes, (kids & 0xFF) | ((kids >> 8) & mask) << 8)
                total, stop = weigh(total, np.bincount(parent, value, len(nodes)))
            below = nodes, total
            yield at, nodes, zeros, ones, total, stop

    def top(self) -> pd.DataFrame:
        """Sums over the nodes of depth 2, by last byte and node."""
        out = []
        for k in range(8):
            for level in self.levels(*self.decision(k)):
                pass
            _, nodes, zeros, ones, total, _ = level
            sums = pd.DataFrame({"last": nodes >> 8 & 0xFF, "node": nodes & 0xFF, "zeros": zeros, "ones": ones, "below": total})
            out.append(sums.groupby(["last", "node"], as_index=False).sum())
        return pd.concat(out)

    def log10(self, upper: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """log10 of the probability of each gram's byte; ``upper``: (weight, probability of zero) by last byte and node, of depths 1 and 0."""
        out = np.empty((len(self.byte), 8))
        for k in range(8):
            node, one = self.decision(k)
            p = 0.0
            for at, _, zeros, ones, _, stop in self.levels(node, one):
                zero = (zeros + 0.5) / (zeros + ones + 1)
                p = stop[at] * zero[at] + (1 - stop[at]) * p
            at = self.context & 0xFF, node
            for stop, zero in upper:
                p = stop[at] * zero[at] + (1 - stop[at]) * p
            out[:, k] = np.log10(np.where(one, 1 - p, p))
        return out.sum(axis=1)


def model(grams: DataFrame) -> DataFrame:
    """(key, log10 probability of the byte in its context) for all ``grams`` (key, n).

    The tree is worked on in branches by the last two context bytes, whose size is
    bounded by the alphabet. Only depths 1 and 0, at most 256 * 255 nodes, meet on
    the driver.
    """
    groups = max(1, grams.count() // GROUP_GRAMS)
    branch = F.pmod(F.xxhash64(F.shiftright("key", 8).bitwiseAND(0xFFFF)), F.lit(groups)).alias("branch")
    parts = grams.select("key", "n", branch)

    def summary(pdf: pd.DataFrame) -> pd.DataFrame:
        out = Branch(pdf["key"].to_numpy().view(U64), pdf["n"].to_numpy()).top()
        release()
        return out

    sums = (
        parts.groupBy("branch").applyInPandas(summary, "last long, node long, zeros double, ones double, below double")
        .groupBy("last", "node").agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "below")])
        .toPandas()
    )
    zeros, ones, below = (np.zeros((256, 256)) for _ in range(3))
    at = sums["last"].to_numpy(np.int64), sums["node"].to_numpy(np.int64)
    for table, name in ((zeros, "zeros"), (ones, "ones"), (below, "below")):
        table[at] = sums[name]
    total, stop1 = weigh(estimate(zeros, ones), below)
    zero1 = (zeros + 0.5) / (zeros + ones + 1)
    seen = np.zeros((256, 256), bool)
    seen[at] = True
    z0, o0 = zeros.sum(axis=0), ones.sum(axis=0)
    _, stop0 = weigh(estimate(z0, o0), np.where(seen, total, 0).sum(axis=0))
    zero0 = (z0 + 0.5) / (z0 + o0 + 1)

    def score(pdf: pd.DataFrame) -> pd.DataFrame:
        b = Branch(pdf["key"].to_numpy().view(U64), pdf["n"].to_numpy())
        every = [np.broadcast_to(x, (256, 256)) for x in (stop0, zero0)]
        value = b.log10([(stop1, zero1), (every[0], every[1])])
        release()
        return pd.DataFrame({"key": pdf["key"], "value": value})

    return parts.groupBy("branch").applyInPandas(score, "key long, value double")


def _gram_counts(batches: Batches) -> Batches:
    """Training counts of contexts with their byte, combined over many small pieces."""
    tally = _Tally()

    def flush() -> Batches:
        value, n = tally.merged()
        tally.parts.clear()
        release()
        yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(n)], names=["key", "n"])

    for batch in batches:
        for piece in pieces(batch, "text", PART_BYTES):
            key, first = symbols(*lowered(piece.column("text")))
            tally.add(key, np.repeat(piece.column("train").to_numpy(zero_copy_only=False), np.diff(first)))
            if sum(len(value) for value, _ in tally.parts) > HELD_GRAMS:
                yield from flush()
    if tally.parts:
        yield from flush()


def _distinct(keys: np.ndarray) -> np.ndarray:
    """The distinct keys in order; by sorting, as ``np.unique`` without counts hashes and takes ten times as long."""
    keys = np.sort(keys)
    new = np.ones(len(keys), bool)
    np.not_equal(keys[1:], keys[:-1], out=new[1:])
    return keys[new]


class _Tally:
    """Distinct keys with training counts, merged piece by piece."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, key: np.ndarray, train: np.ndarray) -> None:
        value, n = np.unique(key[train], return_counts=True)
        other = _distinct(key[~train])
        self.parts += [(value, n), (other, np.zeros(len(other), np.int64))]
        if len(self.parts) > 8:
            self.parts = [self.merged()]

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        keys = np.concatenate([v for v, _ in self.parts])
        if not any(n.any() for _, n in self.parts):
            value = _distinct(keys)
            return value, np.zeros(len(value), np.int64)
        value, at = np.unique(keys, return_inverse=True)
        return value, np.bincount(at, np.concatenate([n for _, n in self.parts]), len(value)).astype(np.int64)


class Lookup:
    """Places of keys in a list of distinct keys, by a few hash tables; every key asked for must be listed."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.tables: list[np.ndarray] = []
        left = np.arange(len(keys))
        while len(left) > 64 and len(self.tables) < 12:
            # later tables hold what is left, so they get smaller
            table = np.zeros(1 << max(8, int(2 * len(left)).bit_length()), np.int32)
            slot = self._slot(keys[left], len(self.tables), len(table))
            table[slot] = left
            self.tables.append(table)
            left = left[table[slot] != left]
        self.rest = left

    @staticmethod
    def _slot(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        mixed = keys.view(U64) * U64((0x9E3779B97F4A7C15 + (level << 33)) | 1)
        return (mixed >> U64(65 - size.bit_length())).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys), np.int64)
        open_ = np.arange(len(keys))
        for level, table in enumerate(self.tables):
            asked = keys[open_]
            place = table[self._slot(asked, level, len(table))]
            out[open_] = place
            open_ = open_[self.keys[place] != asked]
            if not len(open_):
                return out
        if len(open_):
            order = self.rest[np.argsort(self.keys[self.rest])]
            out[open_] = order[np.searchsorted(self.keys[order], keys[open_])]
        return out


def _tokens(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes with one end per text, first token of each text)."""
    first = t.first + np.arange(t.n + 1)
    out = np.full(first[-1], END_TOKEN, np.int64)
    out[np.arange(len(t.hash)) + t.owner()] = t.hash.view(np.int64)
    return out, first


def _wanted(batches: Batches, kind: int) -> Batches:
    """The distinct words, or contexts, of each block (rows of a block stand together)."""
    block, tally = None, _Tally()

    def flush() -> Batches:
        value, n = tally.merged()
        tally.parts.clear()
        release()
        for at in range(0, len(value), 1 << 17):
            v, c = value[at : at + (1 << 17)], n[at : at + (1 << 17)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(v), block, np.int32)), pa.array(np.full(len(v), kind, np.int8)), pa.array(v.view(np.int64)), pa.array(c)],
                names=["block", "kind", "key", "n"],
            )

    for batch in batches:
        for piece in pieces(batch, "text", PART_BYTES):
            numbers = piece.column("block").to_numpy()
            for b in np.unique(numbers):
                if block is not None and b != block:
                    yield from flush()
                    tally = _Tally()
                block = b
                part = piece.slice(int(np.searchsorted(numbers, b)), int((numbers == b).sum()))
                if kind == WORD:
                    token, first = _tokens(Texts(part.column("text"), lower=True))
                    tally.add(token, np.repeat(part.column("train").to_numpy(zero_copy_only=False), np.diff(first)))
                else:
                    key, _ = symbols(*lowered(part.column("text")))
                    tally.add(key, np.zeros(len(key), bool))
    if block is not None:
        yield from flush()


RESULT = (
    "doc_id {id}, held_out boolean, n_tokens long, n_known long, n_bytes long, known_logs double, "
    "score double, train_tokens long, first_words long"
)


def _score_block(docs: pa.Table, numbers: pa.Table) -> pa.Table:
    # the caller keeps its rows: only what is looked up is copied
    words = numbers.select(["key", "value", "first"]).filter(pc.equal(numbers.column("kind"), WORD))
    grams = numbers.select(["key", "value"]).filter(pc.equal(numbers.column("kind"), GRAM))
    word_count, gram_log = words.column("value").to_numpy(), grams.column("value").to_numpy()
    word_at, gram_at = Lookup(words.column("key").to_numpy()), Lookup(grams.column("key").to_numpy())
    # each word is counted as known by the first block that asks for it
    first_words = int(np.count_nonzero(words.column("first").to_numpy() & (word_count > 0)))
    del numbers, words, grams
    release()
    out = []
    for batch in docs.to_batches():
        for piece in pieces(batch, "text", PART_BYTES >> 1):
            t = Texts(piece.column("text"), lower=True)
            token, first = _tokens(t)
            count = word_count[word_at(token)]
            sums = [np.zeros(len(token) + 1) for _ in range(2)]
            np.cumsum(count > 0, out=sums[0][1:])
            np.cumsum(np.log10(count + 1), out=sums[1][1:])
            symbol, edge = symbols(t.data, t.offsets)
            logs = np.zeros(len(symbol) + 1)
            np.cumsum(gram_log[gram_at(symbol.view(np.int64))], out=logs[1:])
            train = piece.column("train").to_numpy(zero_copy_only=False)
            n_tokens = np.diff(first)
            out.append(
                pa.table(
                    [
                        piece.column("doc_id"),
                        pa.array(~train),
                        pa.array(n_tokens),
                        pa.array(np.diff(sums[0][first]).astype(np.int64)),
                        pa.array(np.diff(t.offsets)),
                        pa.array(np.diff(sums[1][first])),
                        pa.array(np.diff(logs[edge])),
                        pa.array(np.where(train, n_tokens, 0)),
                        pa.array(np.r_[first_words, np.zeros(t.n - 1, np.int64)] if not out else np.zeros(t.n, np.int64)),
                    ],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "n_bytes", "known_logs", "score", "train_tokens", "first_words"],
                )
            )
    result = pa.concat_tables(out)
    del word_at, gram_at, word_count, gram_log, out, docs
    release()
    return result


def score_documents(docs: DataFrame, held_out: Column, scoring: Scoring = Scoring()) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, n_bytes, train_tokens, base_score, score, bits_per_byte of every row.

    Rows with ``held_out`` (null: false) are scored but not learned from. Texts are
    lower-cased (A-Z); null is the empty text, whose only symbol is its end.
    ``score`` is the model's log10 probability of all bytes and the end;
    ``base_score`` the one of words under counts plus one. Equal rows score alike;
    an empty table gives no rows.

    Nothing that grows with the corpus is broadcast: each block of texts asks for
    the counts of its own words and the probabilities of its own contexts.
    """
    spark = docs.sparkSession
    width = shuffle_width(spark)
    rows = docs.select(
        "doc_id", text_of().alias("text"), (~F.coalesce(held_out, F.lit(False))).alias("train"), F.xxhash64("doc_id", text_of()).alias("h")
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // scoring.block_bytes))
    with small_batches(spark):
        counts = stored(
            rows.select("text", "train").mapInArrow(_gram_counts, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
        )
        logs = stored(model(counts))
    placed = rows.withColumn("block", F.pmod("h", F.lit(blocks)).cast("int")).select("block", "doc_id", "text", "train").repartition(width, "block")
    together = placed.sortWithinPartitions("block")

    def wanted(kind: int) -> DataFrame:
        return together.mapInArrow(lambda batches: _wanted(batches, kind), "block int, kind byte, key long, n long")

    all_blocks = W.partitionBy("key")
    known = wanted(WORD).select(
        "block",
        "kind",
        "key",
        F.sum("n").over(all_blocks).cast("double").alias("value"),
        (F.row_number().over(all_blocks.orderBy("block")) == 1).alias("first"),
    )
    likely = wanted(GRAM).join(logs.hint("merge"), "key").select("block", "kind", "key", "value", F.lit(False).alias("first"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    numbers = known.unionByName(likely)
    with small_batches(spark):
        scored = stored(
            placed.groupBy("block").cogroup(numbers.groupBy("block")).applyInArrow(_score_block, RESULT.format(id=id_type))
        )
    totals = scored.agg(F.sum("train_tokens"), F.sum("first_words")).first()
    n, v = totals[0] or 0, totals[1] or 0
    return scored.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        "n_bytes",
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("known_logs") - F.col("n_tokens") * math.log10(n + (v + 1))).alias("base_score"),
        "score",
        (-F.col("score") / math.log10(2) / F.greatest("n_bytes", F.lit(1))).alias("bits_per_byte"),
    )
