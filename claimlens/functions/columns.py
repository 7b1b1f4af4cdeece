"""Column helpers: every function maps Columns to a Column, JVM-side only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import NAME_SUFFIXES


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_zscore(value, mean, sd) -> Column:
    """(value - mean) / sd, NULL when the spread is zero."""
    return F.try_divide(col(value) - col(mean), col(sd))


def ratio_vs_benchmark(value, benchmark) -> Column:
    """value / benchmark, NULL when the benchmark is zero."""
    return F.try_divide(col(value), col(benchmark))


def xlog2x(x) -> Column:
    """x * log2(x) with 0 -> 0."""
    c = col(x)
    return F.when(c > 0, c * F.log2(c)).otherwise(F.lit(0.0))


def finite(x, default=0.0) -> Column:
    """Replace NULL, NaN and infinities by ``default``."""
    c = col(x).cast("double")
    bad = c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf")))
    return F.when(bad, F.lit(default)).otherwise(c)


def clip(x, lower=None, upper=None) -> Column:
    c = col(x)
    if lower is not None:
        c = F.when(c < lower, F.lit(lower)).otherwise(c)
    if upper is not None:
        c = F.when(c > upper, F.lit(upper)).otherwise(c)
    return c


def normalize_name(name) -> Column:
    """Upper-case, blank out punctuation other than ' and -, drop trailing
    suffix tokens, collapse blanks; NULL becomes the empty string."""
    tokens = "|".join(NAME_SUFFIXES)
    cleaned = F.regexp_replace(F.upper(col(name)), r"(?U)[^\w'\- ]", " ")
    single = F.trim(F.regexp_replace(cleaned, r"(?U)\s+", " "))
    bare = F.regexp_replace(single, rf"(^| )({tokens})( ({tokens}))*$", "")
    return F.coalesce(bare, F.lit(""))


def normalize_state(state) -> Column:
    return F.coalesce(F.substring(F.upper(F.trim(col(state))), 1, 2), F.lit(""))


def unordered_pair_in(a, b, pairs) -> Column:
    """True when {a, b} is one of ``pairs`` regardless of order."""
    key = F.array_join(F.array_sort(F.array(col(a), col(b))), "|")
    return key.isin(["|".join(sorted(p)) for p in pairs])


def compact_date(c) -> Column:
    """Parse yyyyMMdd, falling back to ISO; anything else becomes NULL."""
    text = F.trim(col(c))
    return F.coalesce(
        F.try_to_date(text, "yyyyMMdd"), text.try_cast("date")
    )


def chi2_upper_tail(x, df: int) -> Column:
    """P(X > x) for a chi-square variable with ``df`` degrees of freedom."""
    half = F.greatest(col(x), F.lit(0.0)) / 2.0
    return F.reflect(
        F.lit("org.apache.commons.math3.special.Gamma"),
        F.lit("regularizedGammaQ"),
        F.lit(df / 2.0),
        half,
    ).cast("double")


def dense_quadratic_form(diffs: list[Column], flat_inverse: Column) -> Column:
    """d' M d for a symmetric matrix stored row by row in an array column."""
    n = len(diffs)
    terms = []
    for i in range(n):
        for j in range(i, n):
            term = diffs[i] * diffs[j] * F.get(flat_inverse, F.lit(i * n + j))
            terms.append(term if i == j else term * 2.0)
    return reduce(lambda a, b: a + b, terms)


def min_max(x, lo, hi) -> Column:
    """Scale to [0, 1]; a zero range gives 0."""
    c = col(x)
    return F.when(hi == lo, F.lit(0.0)).otherwise(F.try_divide(c - lo, hi - lo))


def seeded(seed: int, *columns: str) -> Column:
    """A draw of 52 bits from a seed and some columns, equal in every engine that has MD5."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in columns]))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")
