"""MinHash near-duplicate components.

A text is the set of its word shingles. Each of many universal hash functions keeps
its minimum over the set; bands of minima bring similar sets into one bucket, the
whole signatures verify what met there, and full sets confirm the links. Components of
the links come from alternating large and small stars.

Only connectivity is asked for, so no group is expanded into its pairs. In a large
bucket (and in a large group) every member is first compared with a few others and one
leader; only members that this leaves apart from the leader are compared with all.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .frames import Batches, discard, shuffle_width, stored, text_of
from .jaccard import shared_counts
from .words import U64, Texts, mix, pieces, release


@dataclass(frozen=True)
class MinHash:
    """``bands`` of ``rows`` minima; ``loose`` is the share of a signature that must agree before full sets are read.

    Sets are linked when 100 * intersection >= ``percent`` * union. A pair at 0.8 misses
    all 32 bands with probability (1 - 0.8**4)**32 < 5e-8, and agrees in under 0.55 of
    128 minima with one far smaller. Buckets of up to ``small`` sets are compared whole;
    blocks of larger ones hold ``block`` signatures, of groups ``block_sets`` sets and
    about ``block_words`` shingles.
    """

    length: int = 2
    percent: int = 80
    bands: int = 32
    rows: int = 4
    loose: float = 0.55
    small: int = 32
    block: int = 512
    block_sets: int = 1000
    block_words: int = 400_000

    @property
    def minima(self) -> int:
        return self.bands * self.rows

    def hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """Factors and offsets of the functions (a * x + b) mod 2**64 >> 32 of 32-bit x."""
        n = np.arange(self.minima, dtype=U64)
        return mix(n << U64(1)) | U64(1), mix((n << U64(1)) | U64(1))


def sets_of(texts: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(set number, shingle) without repeats, in order of sets; the size and the name of each set."""
    words = Texts(texts, lower=True)
    owner, token = words.shingles(length)
    _, first = np.unique(token ^ mix(owner.astype(U64)), return_index=True)
    order = first[np.lexsort((token[first], owner[first]))]
    owner, token = owner[order], token[order]
    size = np.bincount(owner, minlength=words.n)
    total = np.zeros(words.n, U64)
    if len(owner):
        head = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        total[owner[head]] = np.add.reduceat(mix(token), head)
    return owner, token, size, mix(total ^ size.astype(U64))


def signatures(owner: np.ndarray, token: np.ndarray, n: int, rule: MinHash) -> np.ndarray:
    """(n, minima) least values of every function over each set; all bits set for an empty set."""
    least = np.full((n, rule.minima), 0xFFFFFFFF, np.uint32)
    if not len(owner):
        return least
    head = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    x = token >> U64(32)
    value = np.empty_like(x)
    for c, (a, b) in enumerate(zip(*rule.hashes())):
        np.multiply(x, a, out=value)
        np.add(value, b, out=value)
        # the shift keeps the order, so it may follow the minimum
        least[owner[head], c] = np.minimum.reduceat(value, head) >> U64(32)
    return least


def _binary(rows: np.ndarray) -> pa.Array:
    raw, step = rows.tobytes(), rows.shape[1] * rows.itemsize
    return pa.array([raw[i * step : (i + 1) * step] for i in range(len(rows))], pa.binary())


def _sketches(batches: Batches, rule: MinHash) -> Batches:
    for batch in batches:
        for piece in pieces(batch, "text"):
            owner, token, size, name = sets_of(piece.column("text"), rule.length)
            least = signatures(owner, token, len(size), rule)
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("doc_id"),
                    piece.column("k1"),
                    pa.array(name.view(np.int64)),
                    pa.array(size.astype(np.int64)),
                    _binary(least.astype("<u4")),
                    # a byte of every minimum is enough to verify with
                    _binary((least & 0xFF).astype(np.uint8)),
                ],
                names=["doc_id", "k1", "name", "size", "least", "check"],
            )
    release()


def connected(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least node that each of ``n`` nodes is connected with."""
    label = np.arange(n)
    while len(a):
        # labels point straight to roots here; every root takes the least root it has an edge to
        one, two = label[a], label[b]
        low = np.minimum(one, two)
        np.minimum.at(label, one, low)
        np.minimum.at(label, two, low)
        further = label[label]
        while (further != label).any():
            label, further = further, further[further]
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]
    return label


def _stars(name: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch | None:
    """(a, b) from each connected name to the first of those it is connected with."""
    label = connected(len(name), a, b)
    some = np.flatnonzero(name[label] != name)
    if not len(some):
        return None
    return pa.RecordBatch.from_arrays([pa.array(name[some]), pa.array(name[label[some]])], names=["a", "b"])


def whole_units(batches: Batches, column: str = "unit") -> Batches:
    """Tables of whole units from sorted batches."""
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        unit = table.column(column).to_numpy()
        cut = int(np.searchsorted(unit, unit[-1]))
        held = table.slice(cut)
        if cut:
            yield table.slice(0, cut).combine_chunks()
    if held is not None:
        yield held.combine_chunks()


def _agreeing(batches: Batches, rule: MinHash) -> Batches:
    """Connections inside units whose signatures agree; a unit pairs its ``open`` rows with all its rows."""
    for table in whole_units(batches):
        unit, name = table.column("unit").to_numpy(), table.column("name").to_numpy()
        open_ = table.column("open").to_numpy(zero_copy_only=False)
        check = np.frombuffer(b"".join(table.column("check").to_pylist()), np.uint8).reshape(-1, rule.minima)
        here = np.arange(len(unit))
        end = np.searchsorted(unit, unit, "right")
        size = end - np.searchsorted(unit, unit)
        left, right = [], []
        few = size <= rule.small
        for step in range(1, int(size[few].max(initial=1))):
            a = np.flatnonzero(few & (here + step < end))
            a = a[open_[a] | open_[a + step]]
            for at in range(0, len(a), 1 << 16):
                x = a[at : at + (1 << 16)]
                x = x[(check[x] == check[x + step]).mean(axis=1) >= rule.loose]
                left.append(x)
                right.append(x + step)
        for start in np.flatnonzero(~few & np.r_[True, unit[1:] != unit[:-1]]):
            rows = here[start : end[start]]
            for at in rows[open_[rows]]:
                near = rows[(check[rows] == check[at]).mean(axis=1) >= rule.loose]
                left.append(np.full(len(near), at))
                right.append(near)
        if left:
            out = _stars(name, np.concatenate(left), np.concatenate(right))
            if out is not None:
                yield out


def _blocks(n: Column, size: int) -> Column:
    return F.ceil(n / F.lit(size)).cast("int")


def _in_units(units: DataFrame, work, schema: str = "a long, b long") -> DataFrame:
    width = shuffle_width(units.sparkSession)
    return units.repartition(width, "unit").sortWithinPartitions("unit").mapInArrow(work, schema)


def crossed(rows: DataFrame, sizes: DataFrame, key: str) -> DataFrame:
    """Units that pair the ``open`` rows of a key with all its rows.

    ``sizes`` has, per key with open rows, the number of blocks of all rows and of the
    open ones. A row travels to as many units as there are blocks of the other side.
    """
    placed = rows.join(sizes.hint("merge"), key).withColumns(
        {"i": F.pmod(F.xxhash64("name"), F.col("blocks")).cast("int"), "j": F.pmod(F.xxhash64("name", F.lit(1)), F.col("open_blocks")).cast("int")}
    )
    everyone = placed.withColumns({"j": F.explode(F.sequence(F.lit(0), F.col("open_blocks") - 1)), "open": F.lit(False)})
    opened = placed.where("open").withColumn("i", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return everyone.unionByName(opened).withColumn("unit", F.xxhash64(key, "i", "j"))


def candidates(base: DataFrame, rule: MinHash) -> DataFrame:
    """Edges (a, b) that connect all sets whose signatures met in a band and agree."""
    step = 4 * rule.rows
    bands = F.array(*[F.xxhash64(F.lit(i), F.substring("least", i * step + 1, step)) for i in range(rule.bands)])
    live = base.select("name", F.explode(bands).alias("bucket"))
    counts = live.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("name").alias("leader")).where("n > 1")
    found = stored(live.join(counts.hint("merge"), "bucket"))
    checks = base.select("name", "check")
    small = found.where(F.col("n") <= rule.small).join(checks.hint("merge"), "name")
    near = stored(
        _in_units(small.select(F.col("bucket").alias("unit"), "name", "check", F.lit(True).alias("open")), lambda b: _agreeing(b, rule)).distinct()
    )
    # large buckets: first the leader, one comparison per member
    large = stored(found.where(F.col("n") > rule.small).join(checks.hint("merge"), "name"))
    heads = large.where("name = leader").select("bucket", F.col("check").alias("head"))
    met = stored(
        large.join(heads.hint("merge"), "bucket").mapInArrow(lambda b: _beside_leader(b, rule), "bucket long, name long, leader long, n long, open boolean")
    )
    star = met.where("NOT open AND name <> leader").select(F.col("name").alias("a"), F.col("leader").alias("b"))
    sizes = met.groupBy("bucket").agg(
        _blocks(F.max("n"), rule.block).alias("blocks"), _blocks(F.count_if("open"), rule.block).alias("open_blocks")
    ).where("open_blocks > 0")
    units = crossed(met.select("bucket", "name", "open"), sizes, "bucket").select("unit", "name", "open")
    rest = _in_units(units.join(checks.hint("merge"), "name"), lambda b: _agreeing(b, rule))
    edges = stored(near.unionByName(star).unionByName(rest).distinct())
    discard(found, near, large, met)
    return edges


def _beside_leader(batches: Batches, rule: MinHash) -> Batches:
    """Marks members whose signature does not agree with their leader's as open."""
    for batch in batches:
        if batch.num_rows:
            one, two = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, rule.minima) for c in ("check", "head"))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("bucket", "name", "leader", "n")), pa.array((one == two).mean(axis=1) < rule.loose)],
                names=["bucket", "name", "leader", "n", "open"],
            )


def _confirmed(batches: Batches, rule: MinHash) -> Batches:
    """Connections by exact links inside units; a unit pairs its ``open`` rows with all its rows."""
    for table in whole_units(batches):
        unit = table.column("unit").to_numpy()
        edges = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1], True])
        grown = np.concatenate([[0], np.cumsum(table.column("bytes").to_numpy())])
        i = 0
        while i < len(edges) - 1:
            # whole units, a few megabytes of text at a time
            j = i + 1
            while j < len(edges) - 1 and grown[edges[j + 1]] - grown[edges[i]] <= (2 << 20):
                j += 1
            out = _linked(table.slice(edges[i], edges[j] - edges[i]).combine_chunks(), edges[i : j + 1] - edges[i], rule)
            if out is not None:
                yield out
            i = j
    release()


def _linked(part: pa.Table, edges: np.ndarray, rule: MinHash) -> pa.RecordBatch | None:
    owner, token, size, name = sets_of(part.column("text"), rule.length)
    name = name.view(np.int64)
    wanted = part.column("name").to_numpy()
    open_ = part.column("open").to_numpy(zero_copy_only=False)
    first = np.searchsorted(owner, np.arange(len(size) + 1))
    left, right = [], []
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        # rows repeat a set where a row is both open and one of all; a row key shared by another text brings other sets
        rows = np.arange(a, b)[name[a:b] == wanted[a:b]]
        rows = rows[np.lexsort((~open_[rows], wanted[rows]))]
        rows = rows[np.r_[True, wanted[rows[1:]] != wanted[rows[:-1]]]] if len(rows) else rows
        n = len(rows)
        if n < 2:
            continue
        common = shared_counts(np.repeat(np.arange(n), size[rows]), np.concatenate([token[first[r] : first[r + 1]] for r in rows]), n)
        total = size[rows]
        for at in np.flatnonzero(open_[rows]):
            shared = common[at].astype(np.int64)
            hit = np.flatnonzero(100 * shared >= rule.percent * (total + total[at] - shared))
            left.append(np.full(len(hit), rows[at]))
            right.append(rows[hit])
    if not left:
        return None
    return _stars(wanted, np.concatenate(left), np.concatenate(right))


def _hot(base: DataFrame) -> DataFrame:
    """At most a thousand sets that hold a thousandth of all rows each."""
    total = base.agg(F.sum("copies")).first()[0] or 0
    return base.where(F.col("copies") > max(1000, total / 1000))


def links(rows: DataFrame, base: DataFrame, rule: MinHash) -> DataFrame:
    """Edges (a, b) that connect exactly the sets connected by links."""
    spark = rows.sparkSession
    edges = candidates(base, rule)
    members = stored(components(edges).join(base.select("name", "k1", "copies", "size"), F.col("node") == F.col("name")).drop("node"))
    blocks = members.groupBy("root").agg(
        F.greatest(F.ceil(F.sum("size") / rule.block_words), F.ceil(F.count(F.lit(1)) / rule.block_sets), F.lit(1)).cast("int").alias("blocks")
    )
    placed = members.join(blocks.hint("merge"), "root").withColumn("block", F.pmod(F.xxhash64("name"), F.col("blocks")).cast("int"))
    # one text per set; rows that repeat very often are folded before they meet their set
    hot = [r.k1 for r in _hot(base).select("k1").collect()]
    known = members.select("k1", "name", "root").hint("merge")
    often = F.col("k1").isin(hot) if hot else F.lit(False)
    texts = rows.where(~often).join(known, "k1").unionByName(rows.where(often).dropDuplicates(["k1"]).join(known, "k1"))
    texts = stored(texts.select("name", "root", F.octet_length("text").cast("long").alias("bytes"), "text"))
    # blocks of a group, each with the group's leader
    there = F.when(F.col("name") == F.col("root"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array("block"))
    within = placed.select("name", F.explode(there).alias("i"), "root").select("name", F.xxhash64("root", "i").alias("unit"), F.lit(True).alias("open"))
    held = stored(_in_units(within.join(texts.drop("root").hint("merge"), "name"), lambda b: _confirmed(b, rule)).distinct())
    out = held
    # larger groups: members that are still apart from the leader, against all
    large = placed.where("blocks > 1").select("name", "root", "size", "blocks")
    if not large.isEmpty():
        part = components(held).withColumnRenamed("root", "mine")
        mine = large.join(part, F.col("name") == F.col("node"), "left").withColumn("mine", F.coalesce("mine", "name"))
        lead = mine.where("name = root").select("root", F.col("mine").alias("lead"))
        marked = stored(mine.join(lead.hint("merge"), "root").withColumn("open", F.col("mine") != F.col("lead")).drop("node"))
        words, sets = F.sum(F.when(F.col("open"), F.col("size"))) / rule.block_words, F.count_if("open") / rule.block_sets
        sizes = marked.groupBy("root").agg(F.max("blocks").alias("blocks"), F.ceil(F.greatest(words, sets)).cast("int").alias("open_blocks"))
        across = crossed(marked.select("root", "name", "open"), sizes.where("open_blocks > 0"), "root").select("unit", "name", "open")
        rest = _in_units(across.join(texts.drop("root").hint("merge"), "name"), lambda b: _confirmed(b, rule))
        out = stored(held.unionByName(rest).distinct())
        discard(held, marked)
    discard(edges, members, texts)
    return out


def near_components(docs: DataFrame, rule: MinHash = MinHash()) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row.

    A set holds the distinct shingles of the lower-cased words (A-Z only), or the whole
    sequence of a shorter text. A text without words (null included) is linked with
    nothing, not even another of its kind. ``component_id`` is the least doc_id that is
    reachable over links, null if no row there has one; ``kept`` marks the rows of that
    id, so repeated rows of it are all kept. An empty table gives no rows. Equal sets
    are folded first; copies cost nothing later. Other columns are not read.
    """
    text = text_of()
    rows = docs.select("doc_id", F.xxhash64("doc_id", text).alias("k1"), text.alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, k1 long, name long, size long, least binary, check binary"
    sketch = stored(rows.mapInArrow(lambda b: _sketches(b, rule), schema))
    some = sketch.where("size > 0")
    base = stored(
        some.groupBy("name").agg(
            F.min("doc_id").alias("least_id"),
            F.min("k1").alias("k1"),
            F.count(F.lit(1)).alias("copies"),
            F.max("size").alias("size"),
            F.first("least").alias("least"),
            F.first("check").alias("check"),
        )
    )
    joined = links(rows.select("k1", "text"), base, rule)
    named = base.select("name", "least_id", "copies").join(components(joined), F.col("name") == F.col("node"), "left")
    named = named.select("name", "least_id", "copies", F.coalesce("root", "name").alias("root"))
    ids = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    info = stored(named.join(ids.hint("merge"), "root").select("name", "copies", "component_id"))
    # a set with many copies joins as one of a bounded number of rows, the others by a merge
    often = _hot(info).select("name", "component_id")
    hot = [r.name for r in often.collect()]
    among = F.col("name").isin(hot) if hot else F.lit(False)
    short = some.select("doc_id", "name", "size")
    told = short.where(~among).join(info.select("name", "component_id").hint("merge"), "name")
    told = told.unionByName(short.where(among).join(F.broadcast(often), "name"))
    bare = sketch.where("size = 0").select("doc_id", F.col("size").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return (
        told.select("doc_id", F.col("size").alias("n_shingles"), "component_id")
        .unionByName(bare)
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )
