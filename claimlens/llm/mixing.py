"""Mixing sources to target weights by fitting word budgets exactly.

Documents are counted by source and exact length. A source's target is met by
whole passes over it and a remainder; the remainder takes a proportional share of
every length, and a bounded-knapsack dynamic programme closes the gap with what is
left, and with documents that the share had taken. Which documents of a length are
taken follows from a seeded hash.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .frames import arrow_map, materialize, shuffle_width, stored, text_of
from .words import Texts, pieces

# words that the dynamic programme is given to fill at first; more while it does not fill them
PROGRAMME_WORDS = 1 << 14
# up to this many choices are listed one by one instead
FEW_CHOICES = 1 << 16
# bits of the hash ranges per (source, length); only the range on the boundary is ordered
RANGE_BITS = 12


@dataclass(frozen=True)
class Mix:
    """``weights`` repeat over the sources in order; ``share`` of all words is dealt; no row is taken more than ``most`` times."""

    weights: tuple[int, ...] = (3, 1, 2)
    share: float = 1.5
    most: int = 2
    seed: int = 9


def word_counts(docs: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """The ``keep`` columns and ``size``, the number of words; null has none. No shuffle."""
    rows = docs.select(*keep, text_of().alias("__text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.drop("__text").schema)
    names = list(keep)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        sizes = [Texts(p.column("__text")).n_words for p in pieces(batch, "__text")]
        if not sizes:
            return None
        return pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(np.concatenate(sizes))], names=[*names, "size"])

    return arrow_map(rows, work, f"{fields}, size bigint")


def source_targets(sizes: DataFrame, mix: Mix) -> DataFrame:
    """(source, source_size, target) per source of ``sizes`` (source, size).

    Sources are ordered by code point, null last. Every source gets its weight's
    part of the budget; one above ``most`` times its size stops there and the excess
    goes to the others by weight, until none is above: target = min(most * size,
    level * weight) with one common level.
    """
    spark = sizes.sparkSession
    table = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # the rank of a source: ranges of names, counted, then numbered inside each range
    ranged = table.repartitionByRange(max(1, min(64, shuffle_width(spark))), F.col("source").asc_nulls_last())
    ranged = materialize(ranged.withColumn("part", F.spark_partition_id()))
    counts = {r.part: r.n for r in ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    offset, offsets = 0, []
    for part in sorted(counts):
        offsets.append((part, offset))
        offset += counts[part]
    if not offsets:
        return table.withColumn("target", F.lit(None).cast("double"))
    base = spark.createDataFrame(offsets, "part int, offset long")
    inner = F.row_number().over(W.partitionBy("part").orderBy(F.col("source").asc_nulls_last()))
    cycle = F.array(*[F.lit(float(w)) for w in mix.weights])
    ranked = ranged.join(F.broadcast(base), "part").withColumn("n", inner + F.col("offset") - 1)
    weighed = materialize(
        ranked.select("source", "source_size", F.get(cycle, (F.col("n") % len(mix.weights)).cast("int")).alias("weight"))
    )
    cap = F.lit(mix.most) * F.col("source_size")
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    budget, level = mix.share * total, 0.0
    # the level only rises, and each round stops at least one more source or ends
    while True:
        stopped = cap <= F.lit(level) * F.col("weight")
        row = weighed.agg(
            F.coalesce(F.sum(F.when(stopped, cap)), F.lit(0)).alias("held"),
            F.coalesce(F.sum(F.when(~stopped, F.col("weight"))), F.lit(0.0)).alias("open"),
        ).first()
        if not row.open:
            break
        new = (budget - row.held) / row.open
        if new <= level:
            break
        level = new
    return weighed.select("source", "source_size", F.least(cap.cast("double"), F.lit(level) * F.col("weight")).alias("target"))


def fill(length: np.ndarray, count: np.ndarray, gap: int) -> tuple[np.ndarray, int]:
    """How many of each length to take for the largest sum up to ``gap``, and that sum."""
    used = np.zeros(len(length), np.int64)
    some = np.flatnonzero((count > 0) & (length <= gap))
    most = np.minimum(count[some], gap // length[some])
    if np.log2(most + 1.0).sum() <= np.log2(FEW_CHOICES):
        sums = np.zeros(1, np.int64)
        for size, n in zip(length[some], most):
            sums = (sums[:, None] + size * np.arange(n + 1)).ravel()
        at = int(np.argmax(np.where(sums <= gap, sums, -1)))
        best = int(sums[at])
        for i, n in zip(some[::-1], most[::-1]):
            at, used[i] = divmod(at, int(n) + 1)
        return used, best
    # first[s]: the length that first made the sum s; how_many[s]: how often it stands in it
    first, how_many = np.zeros(gap + 1, np.int32), np.zeros(gap + 1, np.int32)
    reached = np.zeros(gap + 1, bool)
    reached[0] = True
    for i, n in zip(some, most):
        size = int(length[i])
        # along each chain s, s + size, ... the distance to the last sum reached without this length
        rows = -(-(gap + 1) // size)
        grid = np.full(rows * size, -1, np.int64)
        grid[: gap + 1][reached] = np.flatnonzero(reached)
        latest = np.maximum.accumulate(grid.reshape(rows, size), axis=0).reshape(-1)[: gap + 1]
        steps = (np.arange(gap + 1) - latest) // size
        new = np.flatnonzero(~reached & (latest >= 0) & (steps <= n))
        first[new], how_many[new] = i, steps[new]
        reached[new] = True
        if reached[gap]:
            break
    best = at = int(np.flatnonzero(reached)[-1])
    while at:
        i, n = int(first[at]), int(how_many[at])
        used[i] += n
        at -= n * int(length[i])
    return used, best


def fit_budget(length: np.ndarray, count: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length to take so that their words come nearest to ``budget`` from below.

    Every length first gives floor(count * budget / total); whole documents, longest
    first, narrow what that leaves. The shortest documents taken so far are then given
    back until a window is free, which the programme fills from all that is left. A
    window that it fills to the last word (of the lengths' common divisor) is the best
    there is; otherwise the window grows, at last to the whole budget, where the
    programme has every choice. Its memory is 9 bytes a word of the window.
    """
    total = int((length * count).sum())
    if budget >= total:
        return count.copy()
    unit = int(np.gcd.reduce(length))
    length, budget, total = length // unit, budget // unit, total // unit
    window = PROGRAMME_WORDS
    while True:
        take = np.array([c * budget // total for c in count.tolist()], np.int64)
        gap = budget - int((length * take).sum())
        for i in np.argsort(-length, kind="stable"):
            n = min(int(count[i] - take[i]), max(0, gap - window // 2) // int(length[i]))
            take[i] += n
            gap -= n * int(length[i])
        for i in np.argsort(length, kind="stable"):
            n = min(int(take[i]), max(0, -(-(window - gap) // int(length[i]))))
            take[i] -= n
            gap += n * int(length[i])
        used, reached = fill(length, count - take, gap)
        if reached == gap or not take.any():
            return take + used
        window *= 4


def mix_documents(docs: DataFrame, mix: Mix = Mix(), keep: tuple[str, ...] = ("doc_id",), source: str = "source") -> DataFrame:
    """Every row with ``size``, ``source_size``, ``target``, ``copies`` and ``taken`` words.

    A source's words come as near to its target, from below, as any choice of its
    documents can. Rows without words count 0 and are never taken. Rows of equal hash, size
    and source are ordered by the ``keep`` columns; equal rows are interchangeable.
    Reruns agree. Null is a source of its own. An empty table gives no rows. ``keep``
    must not name a result; other columns may have any name.

    Only ids, sources and sizes are shuffled. The table of lengths is bounded by the
    longest text; which rows of a length are taken needs an order only inside the one
    hash range that holds the boundary.
    """
    clash = {*keep, source} & {"size", "source_size", "target", "copies", "taken"}
    if clash:
        raise ValueError(f"results have the names of kept columns: {sorted(clash)}")
    columns = tuple(dict.fromkeys([*keep, source]))
    sized = stored(word_counts(docs, columns).withColumnRenamed(source, "source") if source != "source" else word_counts(docs, columns))
    ids = [c for c in keep if c != source]
    targets = stored(source_targets(sized, mix))
    lengths = sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    most = mix.most

    def plan(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("size")
        size, count = rows["size"].to_numpy(np.int64), rows["n"].to_numpy(np.int64)
        whole, target = int((size * count).sum()), float(rows["target"].iloc[0])
        passes = min(most, int(target // whole)) if whole else 0
        extra = np.zeros(len(size), np.int64)
        some = size > 0
        rest = round(target - passes * whole)
        if whole and passes < most and rest > 0:
            extra[some] = fit_budget(size[some], count[some], rest)
        return pd.DataFrame({"skey": rows["skey"], "source": rows["source"], "size": size, "passes": np.where(some, passes, 0), "extra": extra})

    # a null source is a group of its own, which pandas would drop as a key
    skey = skey_of(F.col("source"))
    joined = lengths.join(targets, lengths["source"].eqNullSafe(targets["source"])).select(
        skey_of(lengths["source"]).alias("skey"), lengths["source"], "size", "n", "target"
    )
    plans = stored(
        joined.groupBy("skey").applyInPandas(plan, "skey string, source string, size long, passes long, extra long")
    ).drop("source")

    h = F.xxhash64(F.lit(mix.seed), *ids) if ids else F.xxhash64(F.lit(mix.seed), "size")
    rows = sized.withColumns({"skey": skey, "h": h}).withColumn("range", F.shiftrightunsigned("h", 64 - RANGE_BITS))
    # hash ranges wholly below the boundary are taken, those above are not
    partly = plans.where("extra > 0")
    ranges = rows.groupBy("skey", "size", "range").agg(F.count(F.lit(1)).alias("n"))
    per_range = ranges.join(partly, ["skey", "size"]).select("skey", "size", "extra", "range", "n")
    running = F.sum("n").over(W.partitionBy("skey", "size").orderBy("range").rowsBetween(W.unboundedPreceding, 0))
    edges = (
        per_range.withColumn("upto", running)
        .where("upto >= extra")
        .groupBy("skey", "size")
        .agg(F.min_by(F.struct("range", (F.col("extra") - F.col("upto") + F.col("n")).alias("need")), "range").alias("edge"))
        .select("skey", "size", F.col("edge.range").alias("edge_range"), F.col("edge.need").alias("need"))
    )
    cuts = stored(plans.join(edges, ["skey", "size"], "left"))
    # only rows of boundary ranges are ordered, so their join is on the range as well
    edge = cuts.where("edge_range is not null").withColumnRenamed("edge_range", "range")
    order = [F.col("h"), *[F.col(c).asc_nulls_first() for c in ids]]
    edge_rows = rows.join(edge, ["skey", "size", "range"]).withColumn(
        "extra_copy", (F.row_number().over(W.partitionBy("skey", "size", "range").orderBy(*order)) <= F.col("need")).cast("long")
    )
    below = F.coalesce((F.col("range") < F.col("edge_range")).cast("long"), F.lit(0).cast("long"))
    other = rows.join(cuts, ["skey", "size"]).where("edge_range is null or range <> edge_range").withColumn("extra_copy", below)
    copies = F.col("passes") + F.col("extra_copy")
    chosen = edge_rows.select(*ids, "source", "size", copies.alias("copies")).unionByName(other.select(*ids, "source", "size", copies.alias("copies")))
    return chosen.join(targets.withColumnRenamed("source", "__s"), F.col("source").eqNullSafe(F.col("__s"))).select(
        *ids, "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken")
    )


def skey_of(source: Column) -> Column:
    """A source as a key that keeps null apart from every name."""
    return F.concat(F.when(source.isNull(), F.lit("n")).otherwise(F.lit("s")), F.coalesce(source, F.lit("")))


def repeat_by_mix(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them; rows not taken go.

    A row is named by id, source and text. The copies of rows equal in these are dealt
    evenly among them, so the words are those of the plan whatever the ids.
    """
    named = [c for name in ("doc_id", "source", "text") for c in (F.col(name).isNull(), F.col(name))]
    keyed = docs.withColumn("__key", F.xxhash64(*named))
    chosen = mix_documents(keyed, mix, keep=("doc_id", "__key"))
    dealt = stored(
        chosen.groupBy("__key").agg(F.sum("copies").alias("__total"), F.count(F.lit(1)).alias("__rows")).where("__total > 0")
        .select("__key", F.floor(F.col("__total") / F.col("__rows")).cast("int").alias("__each"), (F.col("__total") % F.col("__rows")).alias("__more"))
    )
    out = keyed.join(dealt.where("__more = 0").hint("merge"), "__key").withColumn("__copies", F.col("__each"))
    uneven = dealt.where("__more > 0")
    # equal rows on the boundary of the plan only: some of them get one copy more
    if not uneven.isEmpty():
        rest = [F.col(c).asc_nulls_first() for c in docs.columns if c not in ("doc_id", "source", "text")]
        number = F.row_number().over(W.partitionBy("__key").orderBy(*rest or [F.lit(1)]))
        some = keyed.join(uneven.hint("merge"), "__key").withColumn("__copies", F.col("__each") + (number <= F.col("__more")).cast("int"))
        out = out.unionByName(some.where("__copies > 0"))
    return out.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*docs.columns)
