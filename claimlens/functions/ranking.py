"""Order statistics and running totals that never sort a group in one task.

``exact_quantiles`` brackets each requested position with a mergeable sketch,
then ranks only the rows inside the bracket. ``running_totals`` cuts the order
column into quantile buckets, sums the buckets and adds the offsets back.
Both give exact results; equal values are collapsed before any window runs.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .checkpoints import lookup_side, materialize

SKETCH_ACCURACY = 500
# one edge row holds 255 doubles: 20,000 rows are about 40 MB
MAX_EDGE_ROWS = 20_000


@dataclass(frozen=True)
class Quantile:
    """A linear-interpolated quantile of ``column``.

    ``position`` maps the group's row count to a zero-based position and
    defaults to ``probability * (n - 1)``; it must stay within a row or two of
    ``probability * n``.
    """

    column: str
    probability: float
    position: Callable[[Column], Column] | None = None

    def at(self, n: Column) -> Column:
        if self.position is not None:
            return self.position(n).cast("double")
        return (n - F.lit(1)) * F.lit(float(self.probability))


def exact_quantiles(
    df: DataFrame,
    keys: list[str],
    specs: dict[str, Quantile],
    accuracy: int = SKETCH_ACCURACY,
) -> DataFrame:
    """One row per key with the exact quantiles named in ``specs``.

    Pass 1 keeps one sketch per group and column. A sketch answer is off by at
    most n/accuracy ranks, so the answers at p -/+ 3/accuracy enclose the wanted
    position; groups of up to ``accuracy`` rows keep every value. Pass 2 folds
    all values below the bracket into one counter and ranks the few inside.
    """
    columns = list(dict.fromkeys(s.column for s in specs.values()))
    probs = sorted({s.probability for s in specs.values()})
    slack = 3.0 / accuracy
    ends = [min(1.0, max(0.0, p + d)) for p in probs for d in (-slack, slack)]

    cells = [F.struct(F.lit(i).alias("c"), F.col(c).cast("double").alias("v")) for i, c in enumerate(columns)]
    values = (
        df.select(*keys, F.explode(F.array(*cells)).alias("__s"))
        .select(*keys, F.col("__s.c").alias("__c"), F.col("__s.v").alias("__v"))
        .where(F.col("__v").isNotNull())
    )
    bounds = lookup_side(
        values.groupBy(*keys, "__c").agg(
            F.count(F.lit(1)).alias("__n"), F.percentile_approx("__v", ends, accuracy).alias("__ends")
        )
    )
    wanted = {}
    for s in specs.values():
        wanted.setdefault(columns.index(s.column), set()).add(probs.index(s.probability))
    big = F.col("__n") > accuracy
    marks = []
    for j in range(len(probs)):
        used = [c for c, js in wanted.items() if j in js]
        low, high = F.get("__ends", F.lit(2 * j)), F.get("__ends", F.lit(2 * j + 1))
        inside = F.col("__c").isin(used) & ~(big & (F.col("__v") > high))
        kept = F.when(~(big & (F.col("__v") < low)), F.col("__v"))
        marks.append(F.when(inside, F.struct(F.lit(j).alias("q"), kept.alias("v"))))
    counts = (
        values.join(bounds, [*keys, "__c"])
        .select(*keys, "__c", "__n", F.explode(F.array_compact(F.array(*marks))).alias("__m"))
        .groupBy(*keys, "__c", F.col("__m.q").alias("__q"), F.col("__m.v").alias("__v"))
        .agg(F.count(F.lit(1)).alias("__rows"), F.max("__n").alias("__n"))
    )
    group = [*keys, "__c", "__q"]
    order = W.partitionBy(*group).orderBy(F.col("__v").asc_nulls_first())
    running = F.sum("__rows").over(order.rowsBetween(W.unboundedPreceding, 0))

    def each(of: Callable[[str, Quantile], Column]) -> Column:
        """Pick the expression of the spec a row belongs to."""
        out = None
        for name, s in specs.items():
            mine = (F.col("__c") == columns.index(s.column)) & (F.col("__q") == probs.index(s.probability))
            out = F.when(mine, of(name, s)) if out is None else out.when(mine, of(name, s))
        return out

    ranked = counts.withColumns({"__cum": running, "__pos": each(lambda name, s: s.at(F.col("__n")))})
    missed = F.col("__v").isNull() & (F.col("__cum") > F.floor("__pos"))
    guarded = F.when(
        missed, F.raise_error(F.lit("quantile outside its bracket")).cast("double")
    ).otherwise(F.col("__v"))
    found = ranked.groupBy(*group).agg(
        F.min(F.when(F.col("__cum") > F.floor("__pos"), guarded)).alias("__lo"),
        F.min(F.when(F.col("__cum") > F.ceil("__pos"), F.col("__v"))).alias("__hi"),
        F.max(F.col("__pos") - F.floor("__pos")).alias("__f"),
        F.max("__cum").alias("__last"),
        F.max(F.ceil("__pos")).alias("__top"),
    )
    # the wanted rows lie above the bracket: never answer NULL for them
    found = found.withColumn(
        "__lo",
        F.when(F.col("__last") <= F.col("__top"), F.raise_error(F.lit("quantile outside its bracket")).cast("double")).otherwise(F.col("__lo")),
    )
    step = F.when(F.col("__f") > 0, (F.col("__hi") - F.col("__lo")) * F.col("__f")).otherwise(0.0)
    picked = found.withColumns(
        {"__value": F.col("__lo") + step, "__name": each(lambda name, s: F.lit(name))}
    )
    return picked.groupBy(*keys).agg(
        *[F.max(F.when(F.col("__name") == name, F.col("__value"))).alias(name) for name in specs]
    )


def running_totals(
    df: DataFrame,
    keys: list[str],
    order_by: str,
    sums: dict[str, Column],
    descending: bool = True,
    buckets: int = 256,
) -> DataFrame:
    """Per key and distinct ``order_by`` value: the sums of the value's rows
    (``name``) and the inclusive running sums (``cum_name``).

    ``df`` is read more than once, so pass a stored table or a materialised
    DataFrame when its values could differ between two evaluations.
    """
    names = list(sums)
    flat = df.where(F.col(order_by).isNotNull()).groupBy(*keys, order_by).agg(
        *[F.sum(c).alias(n) for n, c in sums.items()]
    )
    probs = [i / buckets for i in range(1, buckets)]
    edges = flat.groupBy(*keys).agg(F.percentile_approx(order_by, probs, 4 * buckets).alias("__edges"))
    if keys:
        tagged = flat.join(lookup_side(edges, MAX_EDGE_ROWS), keys)
    else:
        tagged = flat.withColumn("__edges", materialize(edges).scalar())
    tagged = tagged.withColumn(
        "__bucket",
        F.size(F.filter("__edges", lambda e: e < F.col(order_by))),
    ).drop("__edges")

    def way(c):
        return F.col(c).desc() if descending else F.col(c).asc()

    before = W.partitionBy(*keys).orderBy(way("__bucket")).rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        tagged.groupBy(*keys, "__bucket")
        .agg(*[F.sum(n).alias(f"__t_{n}") for n in names])
        .select(
            *keys,
            "__bucket",
            *[F.coalesce(F.sum(f"__t_{n}").over(before), F.lit(0)).alias(f"__o_{n}") for n in names],
        )
    )
    inside = (
        W.partitionBy(*keys, "__bucket")
        .orderBy(way(order_by))
        .rowsBetween(W.unboundedPreceding, 0)
    )
    return (
        tagged.join(offsets, [*keys, "__bucket"])
        .select(
            *keys,
            order_by,
            *names,
            *[(F.col(f"__o_{n}") + F.sum(n).over(inside)).alias(f"cum_{n}") for n in names],
        )
    )


def positives_in_top_k(
    df: DataFrame,
    keys: list[str],
    score: str,
    label: str,
    tie_break: str,
    cutoffs: dict[str, Column],
) -> DataFrame:
    """Exact counts for ranked prefixes: (keys, cutoff, k, n, positives, hits).

    ``cutoffs`` maps a name to k as a Column of ``n`` (rows in the group). Rows
    rank by score descending, then by the numeric ``tie_break`` ascending. Whole
    score groups above the cut are added up; only the tied group that straddles
    the cut is ordered by the tie-break, again through running totals.
    """
    rows = materialize(
        df.select(
            *keys,
            F.col(score).cast("double").alias("__s"),
            F.col(label).cast("int").alias("__y"),
            F.col(tie_break).cast("long").alias("__id"),
        )
    )
    curve = running_totals(rows, keys, "__s", {"n": F.lit(1), "pos": F.col("__y")})
    curve = materialize(curve)
    totals = curve.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("pos").alias("positives"))
    wanted = totals.select(
        *keys,
        "n",
        "positives",
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(name).alias("cutoff"), k.cast("long").alias("k"))
                    for name, k in cutoffs.items()
                ]
            )
        ).alias("w"),
    ).select(*keys, "n", "positives", "w.*")
    if keys:
        lined = curve.drop("n", "pos").join(lookup_side(wanted, MAX_EDGE_ROWS), keys)
    else:
        holder = wanted.select(F.collect_list(F.struct("*")).alias("w"))
        lined = (
            curve.drop("n", "pos")
            .withColumn("__w", F.explode(holder.scalar()))
            .select("*", "__w.*")
            .drop("__w")
        )
    edge = lined.groupBy(*keys, "cutoff").agg(
        F.max("k").alias("k"),
        F.max("n").alias("n"),
        F.max("positives").alias("positives"),
        F.coalesce(
            F.max_by("cum_pos", F.when(F.col("cum_n") <= F.col("k"), F.col("cum_n"))), F.lit(0)
        ).alias("__full_pos"),
        F.coalesce(F.max(F.when(F.col("cum_n") <= F.col("k"), F.col("cum_n"))), F.lit(0)).alias(
            "__full_n"
        ),
        F.max(F.when(F.col("cum_n") > F.col("k"), F.col("__s"))).alias("__edge"),
    )
    edge = materialize(edge)
    open_cuts = edge.where((F.col("__full_n") < F.col("k")) & F.col("__edge").isNotNull()).select(
        *keys, "cutoff", F.col("__edge").alias("__s"), (F.col("k") - F.col("__full_n")).alias("__need")
    )
    open_cuts = lookup_side(open_cuts)
    straddling = rows.join(open_cuts, [*keys, "__s"])
    partial = (
        running_totals(
            straddling,
            [*keys, "cutoff"],
            "__id",
            {"m": F.lit(1), "pos": F.col("__y")},
            descending=False,
        )
        .join(open_cuts.drop("__s"), [*keys, "cutoff"])
        .where(F.col("cum_m") <= F.col("__need"))
        .groupBy(*keys, "cutoff")
        .agg(F.sum("pos").alias("__extra"))
    )
    return edge.join(partial, [*keys, "cutoff"], "left").select(
        *keys,
        "cutoff",
        "k",
        "n",
        "positives",
        (F.col("__full_pos") + F.coalesce("__extra", F.lit(0))).alias("hits"),
    )
