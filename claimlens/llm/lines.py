"""Line dedup by distinct-site spread.

Every line hash carries a HyperLogLog sketch of the sites that show it; sketches
merge by aggregation. Lines whose estimate is near the threshold get an exact
distinct count. Lines on enough sites are boilerplate: only their first occurrence
stays.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import free_name, stored, text_of


@dataclass(frozen=True)
class Spread:
    """Boilerplate stands on ``sites`` sites or more. ``log_k``: size of a sketch; its error is about 1.04 / sqrt(2**log_k).

    Estimates within ``band`` errors of the threshold are counted exactly.
    """

    sites: int = 8
    log_k: int = 10
    band: float = 5.0
    keep_first: bool = True


def line_key(line: Column) -> Column:
    """128 bits of the trimmed line; blank lines have none."""
    body = F.trim(F.regexp_replace(line, r"[\t\r\f\x0B]", " "))
    return F.when(body != "", F.struct(F.xxhash64(body).alias("a"), F.xxhash64(F.lit(1), body).alias("b")))


def site_spread(lines: DataFrame, rule: Spread) -> DataFrame:
    """(a, b, spread) of the boilerplate lines of ``lines`` (a, b, site).

    Spread is exact near the threshold and an estimate far above it. A null site is
    a site of its own.
    """
    site = F.coalesce(F.concat(F.lit("s"), F.col("site")), F.lit("n"))
    seen = lines.select("a", "b", site.alias("site"))
    # a line that one site shows, however often, needs no sketch
    shown = seen.groupBy("a", "b", "site").agg(F.count(F.lit(1)).alias("n"))
    merged = shown.groupBy("a", "b").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(rule.log_k))).alias("estimate"))
    error = rule.band * 1.04 / 2 ** (rule.log_k / 2)
    low, high = rule.sites * (1 - error), rule.sites * (1 + error)
    near = stored(merged.where(F.col("estimate") >= F.floor(F.lit(low))))
    exact = (
        seen.join(near.where(F.col("estimate") <= F.ceil(F.lit(high))).select("a", "b"), ["a", "b"], "left_semi")
        .groupBy("a", "b", "site").agg(F.lit(1).alias("one")).groupBy("a", "b").agg(F.count(F.lit(1)).alias("spread"))
        .where(F.col("spread") >= rule.sites)
    )
    far = near.where(F.col("estimate") > F.ceil(F.lit(high))).select("a", "b", F.col("estimate").alias("spread"))
    return exact.unionByName(far)


def exploded(docs: DataFrame) -> DataFrame:
    """(row, doc_id, site, at, a, b) of every line that is not blank."""
    row = F.xxhash64("doc_id", text_of())
    lines = docs.select(row.alias("row"), "doc_id", F.col("source").alias("site"), F.posexplode(F.split(text_of(), "\n", -1)).alias("at", "line"))
    return lines.select("row", "doc_id", "site", "at", line_key(F.col("line")).alias("key")).where("key is not null").select(
        "row", "doc_id", "site", "at", "key.a", "key.b"
    )


def remove_boilerplate(docs: DataFrame, rule: Spread = Spread(), removed: str = "removed_lines") -> DataFrame:
    """``docs`` with boilerplate lines taken out of ``text``; plus their number as ``removed``.

    A column of ``docs`` that has this name is replaced, any other passes through.
    ``source`` is the site. The first occurrence of a boilerplate line, by doc_id
    (null first) and position, stays if ``rule.keep_first``; equal rows of equal id
    keep it alike. Blank lines stay and do not count. Texts without such lines are
    returned unchanged, null texts stay null; an empty table gives no rows.

    Texts are not exploded into the result: only the positions to remove are joined
    back, so lines that stay never leave their row.
    """
    # the lines are cut and hashed once and read three times
    lines = stored(exploded(docs))
    spread = stored(site_spread(lines, rule))
    hits = lines.join(spread.select("a", "b"), ["a", "b"])
    if rule.keep_first:
        hits = stored(hits.drop("site"))
        order = F.struct(F.col("doc_id").isNotNull().alias("n"), "doc_id", "row", "at")
        first = hits.groupBy("a", "b").agg(F.min(order).alias("first")).select("a", "b", F.col("first.row").alias("row"), F.col("first.at").alias("at"))
        hits = hits.join(first, ["a", "b", "row", "at"], "left_anti")
    here, there, at = (free_name(docs, c) for c in ("__here", "__row", "__gone"))
    gone = hits.groupBy("row").agg(F.collect_set("at").alias(at)).withColumnRenamed("row", there)
    # rows with boilerplate grow with the corpus: a merge join at every size
    marked = docs.withColumn(here, F.xxhash64("doc_id", text_of())).join(gone.hint("merge"), F.col(here) == F.col(there), "left")
    # the places that stay are a set difference, so a text of very many lines takes one sweep
    cut = F.split("text", "\n", -1)
    kept = F.transform(F.array(cut), lambda ls: F.transform(F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), at), lambda i: F.get(ls, i)))
    left = F.when(F.col(at).isNull(), F.col("text")).otherwise(F.array_join(F.get(kept, F.lit(0)), "\n")).alias("text")
    return marked.select(
        *[left if c == "text" else F.col(f"`{c}`") for c in docs.columns if c.lower() != removed.lower()],
        F.coalesce(F.size(at), F.lit(0)).cast("long").alias(removed),
    )
