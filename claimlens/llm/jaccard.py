"""N-gram Jaccard join by chosen paths.

Texts are sets of word n-grams. A run splits all sets by the token that a random
order makes the least of each set: two sets of similarity s meet with probability s.
Buckets that are still large are split again by further orders, the path; small ones
are compared directly. Runs repeat until a pair at the threshold has met with the
target probability. What met and looks similar forms groups, and inside the groups
every pair is compared exactly, block by block, so no pair is ever written out.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .frames import Batches, shuffle_width, stored, text_of
from .words import U64, Texts, mix, pieces, release

ORDERS = 64


@dataclass(frozen=True)
class Join:
    """``depth`` splits at most; buckets of up to ``small`` sets are compared directly, ``loose`` is their threshold on 64 samples.

    ``recall``: probability that a pair at the threshold meets. Groups are compared
    in blocks of ``block_sets`` sets and about ``block_words`` words.
    """

    length: int = 5
    threshold: float = 0.8
    recall: float = 0.9999
    depth: int = 3
    small: int = 16
    loose: float = 0.55
    block_sets: int = 1500
    block_words: int = 500_000

    @property
    def runs(self) -> int:
        return math.ceil(math.log(1 - self.recall) / math.log(1 - self.threshold**self.depth))


KEYS = mix(np.arange(1, ORDERS + 1, dtype=U64) << U64(8)) | U64(1)


def sets_of(texts: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(set number, token) of the distinct tokens in order of sets, number of tokens and name of each set."""
    t = Texts(texts)
    owner, token = t.shingles(length)
    key = token ^ mix(owner.astype(U64))
    _, first = np.unique(key, return_index=True)
    order = first[np.lexsort((token[first], owner[first]))]
    owner, token = owner[order], token[order]
    size = np.bincount(owner, minlength=t.n)
    # the name of a set: 64 bits of all its tokens
    total = np.zeros(t.n, U64)
    head = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else np.zeros(0, np.int64)
    if len(head):
        total[owner[head]] = np.add.reduceat(mix(token), head)
    return owner, token, size, mix(total ^ size.astype(U64))


def _sketches(batches: Batches, length: int) -> Batches:
    for batch in batches:
        for piece in pieces(batch, "text"):
            owner, token, size, name = sets_of(piece.column("text"), length)
            least = np.full((len(size), ORDERS), 0xFFFFFFFF, np.uint32)
            if len(owner):
                head = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
                for c, key in enumerate(KEYS):
                    least[owner[head], c] = np.minimum.reduceat((token * key) >> U64(32), head)
            raw = least.astype("<u4").tobytes()
            step = 4 * ORDERS
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("doc_id"),
                    piece.column("k1"),
                    pa.array(name.view(np.int64)),
                    pa.array(size.astype(np.int64)),
                    pa.array([raw[i * step : (i + 1) * step] for i in range(len(size))], pa.binary()),
                ],
                names=["doc_id", "k1", "name", "size", "least"],
            )
    release()


def _split(rows: DataFrame) -> DataFrame:
    """Drop rows alone in their bucket; (name, run, path, n) of the others."""
    counts = rows.groupBy("path").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return stored(rows.join(counts.hint("merge"), "path").select("name", "run", "path", "n"))


def meetings(base: DataFrame, rule: Join) -> DataFrame:
    """Edges (a, b) between sets that met on a path and look similar, or met on the longest path."""

    def order_of(run: Column, level: int) -> Column:
        return F.pmod(run + F.lit(level * 24 + (level // 3) * 7), F.lit(ORDERS))

    def part(order: Column) -> Column:
        return F.substring(F.col("least"), order * 4 + 1, F.lit(4))

    runs = F.transform(
        F.sequence(F.lit(0), F.lit(rule.runs - 1)),
        lambda r: F.struct(r.alias("run"), F.xxhash64(r, part(order_of(r, 0))).alias("path")),
    )
    live = base.select("name", F.explode(runs).alias("r")).select("name", "r.run", "r.path")
    edges = None
    for level in range(rule.depth):
        found = _split(live)
        leaves = found.where(F.col("n") <= rule.small).join(base.select("name", "least").hint("merge"), "name").select("path", "name", "least")
        near = (
            leaves.select("path", "name", F.col("least").alias("sample"))
            .repartition(shuffle_width(base.sparkSession), "path")
            .sortWithinPartitions("path", "name")
            .mapInArrow(lambda b: _similar(b, rule.loose), "a long, b long")
        )
        edges = near if edges is None else edges.unionByName(near)
        large = found.where(F.col("n") > rule.small)
        if level + 1 < rule.depth:
            deeper = F.xxhash64("path", part(order_of(F.col("run"), level + 1)))
            live = large.join(base.select("name", "least").hint("merge"), "name").select("name", "run", deeper.alias("path"))
        else:
            leader = large.groupBy("path").agg(F.min("name").alias("b"))
            edges = edges.unionByName(large.join(leader.hint("merge"), "path").select(F.col("name").alias("a"), "b").where("a <> b"))
    return edges.distinct()


def _similar(batches: Batches, loose: float) -> Batches:
    """Pairs inside small buckets whose samples agree often enough; buckets stand together."""
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        path = table.column("path").to_numpy()
        cut = int(np.searchsorted(path, path[-1]))
        held = table.slice(cut)
        if cut:
            yield from _bucket_pairs(table.slice(0, cut), loose)
    if held is not None:
        yield from _bucket_pairs(held, loose)


def _bucket_pairs(table: pa.Table, loose: float) -> Batches:
    table = table.combine_chunks()
    path, name = table.column("path").to_numpy(), table.column("name").to_numpy()
    sample = np.frombuffer(b"".join(table.column("sample").to_pylist()), "<u4").reshape(-1, ORDERS)
    end = np.searchsorted(path, path, "right")
    widest = int((end - np.arange(len(path))).max(initial=1))
    for step in range(1, widest):
        a = np.flatnonzero(np.arange(len(path)) + step < end)
        b = a + step
        for at in range(0, len(a), 1 << 16):
            x, y = a[at : at + (1 << 16)], b[at : at + (1 << 16)]
            good = (sample[x] == sample[y]).mean(axis=1) >= loose
            good &= name[x] != name[y]
            if good.any():
                yield pa.RecordBatch.from_arrays([pa.array(name[x[good]]), pa.array(name[y[good]])], names=["a", "b"])


def shared_counts(row: np.ndarray, token: np.ndarray, n: int) -> np.ndarray:
    """(n, n) numbers of common tokens of n sets given as (row, token) entries without repeats."""
    _, column, count = np.unique(token, return_inverse=True, return_counts=True)
    common = np.zeros((n, n), np.float32)
    order = np.argsort(column, kind="stable")
    row, often = row[order], count[column[order]]
    column = column[order]
    # rare tokens: every pair of their sets; tokens of many sets: matrix products
    for size in range(2, 9):
        some = row[often == size].reshape(-1, size)
        for i in range(size if len(some) else 0):
            for j in range(size):
                if i != j:
                    np.add.at(common, (some[:, i], some[:, j]), 1)
    dense = often > 8
    row, column = row[dense], column[dense]
    if len(row):
        _, column = np.unique(column, return_inverse=True)
        width = max(1, min(int(column[-1]) + 1, (4 << 20) // n))
        for start in range(0, int(column[-1]) + 1, width):
            a, b = np.searchsorted(column, [start, start + width])
            block = np.zeros((n, width), np.float32)
            block[row[a:b], column[a:b] - start] = 1
            common += block @ block.T
    return common


def _linked(batches: Batches, rule: Join) -> Batches:
    """Exact links inside units; rows of a unit stand together.

    Yields (a, null, weight of the linked sets) and, as (a, b, 0), a forest of links.
    """
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        unit = table.column("unit").to_numpy()
        cut = int(np.searchsorted(unit, unit[-1]))
        held = table.slice(cut)
        if cut:
            yield from _units(table.slice(0, cut), rule)
    if held is not None:
        yield from _units(held, rule)


def _units(table: pa.Table, rule: Join) -> Batches:
    unit = table.column("unit").to_numpy()
    edges = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1], True])
    # whole units, a few megabytes of text at a time
    sizes = np.concatenate([[0], np.cumsum(np.asarray(table.column("bytes").to_numpy()))])
    i = 0
    while i < len(edges) - 1:
        j = i + 1
        while j < len(edges) - 1 and sizes[edges[j + 1]] - sizes[edges[i]] <= (2 << 20):
            j += 1
        part = table.slice(edges[i], edges[j] - edges[i]).combine_chunks()
        yield from _exact(part, edges[i : j + 1] - edges[i], rule)
        i = j
    release()


def _exact(part: pa.Table, edges: np.ndarray, rule: Join) -> Batches:
    text = part.column("text")
    owner, token, size, name = sets_of(text.combine_chunks() if isinstance(text, pa.ChunkedArray) else text, rule.length)
    name = name.view(np.int64)
    wanted = part.column("name").to_numpy()
    block, copies = part.column("block").to_numpy(), part.column("copies").to_numpy()
    cross = part.column("cross").to_numpy(zero_copy_only=False)
    first = np.searchsorted(owner, np.arange(len(size) + 1))
    left, right, weight = [], [], []
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        # one row per set; a row key shared by another text brings rows of other sets
        _, pick = np.unique(np.where(name[a:b] == wanted[a:b], wanted[a:b], wanted[a:b] ^ 1), return_index=True)
        rows = np.sort(pick) + a
        rows = rows[name[rows] == wanted[rows]]
        n = len(rows)
        if n < 2:
            continue
        entries = np.concatenate([token[first[r] : first[r + 1]] for r in rows])
        of = np.repeat(np.arange(n), size[rows])
        common = shared_counts(of, entries, n)
        total, weigh = size[rows].astype(np.float64), copies[rows].astype(np.float64)
        parts = block[rows]
        link, counted = np.zeros((n, n), bool), np.zeros(n)
        # a few hundred rows at a time, so that only counts and links are held whole
        for at in range(0, n, 256):
            here = slice(at, at + 256)
            union = total[here, None] + total[None, :] - common[here]
            strip = common[here] >= rule.threshold * union - 1e-9
            if cross[a]:
                strip &= parts[here, None] != parts[None, :]
            np.fill_diagonal(strip[:, at:], False)
            link[here] = strip
            counted[here] = strip @ weigh
        some = np.flatnonzero(counted > 0)
        left.append(wanted[rows[some]])
        right.append(np.zeros(len(some), np.int64))
        weight.append(counted[some].astype(np.int64))
        tree = spanning(link)
        left.append(wanted[rows[tree[:, 0]]])
        right.append(wanted[rows[tree[:, 1]]])
        weight.append(np.zeros(len(tree), np.int64))
    if left:
        w = np.concatenate(weight)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(left)), pa.array(np.concatenate(right), mask=w > 0), pa.array(w)], names=["a", "b", "n"]
        )


def spanning(link: np.ndarray) -> np.ndarray:
    """(node, parent) pairs of a forest over a symmetric link matrix."""
    n = len(link)
    seen = np.zeros(n, bool)
    out = []
    for root in range(n):
        if seen[root] or not link[root].any():
            continue
        seen[root] = True
        front = [root]
        while front:
            node = front.pop()
            fresh = np.flatnonzero(link[node] & ~seen)
            seen[fresh] = True
            out.append(np.stack([fresh, np.full(len(fresh), node)], axis=1))
            front.extend(fresh.tolist())
    return np.concatenate(out) if out else np.zeros((0, 2), np.int64)


def classes(docs: DataFrame, rule: Join = Join()) -> DataFrame:
    """doc_id, k1, root, class_id, n_links of every row.

    Rows are linked when the Jaccard similarity of their sets of ``rule.length``-word
    n-grams is at least ``rule.threshold``; a shorter text is one n-gram of its own,
    and texts without words (null included) are equal to each other. ``n_links``
    counts linked rows, copies included; ``class_id`` is the least doc_id of all rows
    that are connected by links (null if none has one). ``root`` names a class, never
    null: unlike texts without an id, or with one repeated id, share their class_id
    but not their root. ``k1`` names a row by id and text. An empty table gives no
    rows.

    Equal sets are folded first, so copies cost nothing later. Buckets are counted,
    never gathered; a set travels to as many tasks as its group has blocks.
    """
    spark = docs.sparkSession
    width = shuffle_width(spark)
    text = text_of()
    rows = docs.select("doc_id", F.xxhash64("doc_id", text).alias("k1"), text.alias("text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    sketch = stored(
        rows.mapInArrow(lambda b: _sketches(b, rule.length), f"doc_id {id_type}, k1 long, name long, size long, least binary")
    )
    base = stored(
        sketch.groupBy("name").agg(
            F.min("doc_id").alias("least_id"), F.min("k1").alias("k1"), F.count(F.lit(1)).alias("copies"), F.max("size").alias("size")
        )
    )
    samples = stored(
        sketch.where("size > 0").join(base.select("name", "k1"), ["name", "k1"]).select("name", "least").dropDuplicates(["name"])
    )
    groups = stored(components(meetings(samples, rule)).join(base.select("name", "k1", "copies", "size"), F.col("node") == F.col("name")).drop("node"))
    blocks = groups.groupBy("root").agg(
        F.greatest(F.ceil(F.sum("size") / rule.block_words), F.ceil(F.count(F.lit(1)) / rule.block_sets), F.lit(1).cast("long")).cast("int").alias("blocks")
    )
    members = groups.join(blocks, "root").withColumn("block", F.pmod(F.xxhash64("name"), F.col("blocks")).cast("int"))
    # members grow with the corpus: they join by a merge at every size, never by a broadcast
    texts = rows.select("k1", "text").join(members.select("k1", "name", "root", "copies", "block", "blocks").hint("merge"), "k1")
    units = texts.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        F.xxhash64("root", F.least("block", "other"), F.greatest("block", "other")).alias("unit"),
        "name",
        "copies",
        "block",
        (F.col("block") != F.col("other")).alias("cross"),
        F.octet_length("text").cast("long").alias("bytes"),
        "text",
    )
    links = stored(
        units.repartition(width, "unit").sortWithinPartitions("unit").mapInArrow(lambda b: _linked(b, rule), "a long, b long, n long")
    )
    counts = links.where("n > 0").groupBy(F.col("a").alias("name")).agg(F.sum("n").alias("linked"))
    roots = components(links.where("n = 0").select("a", "b"))
    named = base.join(counts, "name", "left").join(roots.withColumnRenamed("node", "name"), "name", "left")
    named = named.withColumn("root", F.coalesce("root", "name"))
    ids = named.groupBy("root").agg(F.min("least_id").alias("class_id"))
    info = stored(
        named.join(ids, "root").select("name", "root", "class_id", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"))
    )
    return sketch.select("doc_id", "k1", "name").join(info, "name").select("doc_id", "k1", "root", "class_id", "n_links")


def one_per_class(docs: DataFrame, rule: Join = Join()) -> DataFrame:
    """``docs`` with one row of each class, the one of the least id (then of the least row key)."""
    marked = classes(docs, rule)
    keys = marked.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "k1")).alias("best"))
    kept = keys.select(F.col("best.k1").alias("__k1"))
    here = docs.withColumn("__here", F.xxhash64("doc_id", text_of()))
    return here.join(kept.hint("merge"), F.col("__here") == F.col("__k1")).dropDuplicates(["__here"]).select(*docs.columns)
