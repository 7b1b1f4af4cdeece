"""Name similarity on a 0-100 scale, and join keys that find similar names.

``ratio`` is the normalised insert/delete similarity, ``token_set_ratio`` its
token-set form. ``similarity_keys`` turns "score at or above a threshold" into
key equality: any two names that reach the threshold share at least one key, so
candidates come from a hash join instead of comparing every pair of a block.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass, field
from math import floor

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# names of more tokens than this send classes instead of all pairs of tokens
PAIR_TOKENS, CLASSES = 7, 4
# lowest threshold at which a shared gram is certain
LEAST_THRESHOLD = 75.0
# how many of the most frequent parts are told apart by frequency; all others count as rare
RANKED_PARTS = 65_536


def lcs_length(a: str, b: str) -> int:
    """Longest common subsequence, one machine-word style row per character."""
    where: dict[str, int] = {}
    for i, ch in enumerate(a):
        where[ch] = where.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for ch in b:
        hit = row & where.get(ch, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def ratio(a: str, b: str) -> float:
    total = len(a) + len(b)
    return 100.0 if total == 0 else 200.0 * lcs_length(a, b) / total


def token_set_ratio(a: str, b: str) -> float:
    """Best of: shared tokens against either name, and both names with their
    shared tokens put first. Names that contain one another score 100."""
    ta, tb = set(a.split()), set(b.split())
    if not ta or not tb:
        return 0.0
    shared = " ".join(sorted(ta & tb))
    only_a, only_b = " ".join(sorted(ta - tb)), " ".join(sorted(tb - ta))
    if shared and (not only_a or not only_b):
        return 100.0
    gap = 1 if shared else 0
    len_a, len_b = len(shared) + gap + len(only_a), len(shared) + gap + len(only_b)
    edits = len(only_a) + len(only_b) - 2 * lcs_length(only_a, only_b)
    best = 100.0 * (1 - edits / (len_a + len_b))
    if shared:
        for n in (len_a, len_b):
            best = max(best, 100.0 * (1 - (n - len(shared)) / (n + len(shared))))
    return best


@dataclass(frozen=True)
class PartOrder:
    """A total order of tokens and grams, the rarest first; ``counts`` has the frequent ones."""

    counts: dict[str, int] = field(default_factory=dict)

    def key(self, part: str) -> tuple[int, str]:
        return self.counts.get(part, 0), part


def grams(tokens: list[str], q: int) -> list[str]:
    """Runs of q characters of every token with a space around it, the n-th equal one tagged n.

    They do not depend on the order of the tokens. Taking a character out destroys at
    most q of them, putting one in at most q - 1.
    """
    seen: Counter[str] = Counter()
    out = []
    for token in tokens:
        padded = f" {token} "
        for i in range(len(padded) - q + 1):
            gram = padded[i : i + q]
            seen[gram] += 1
            out.append(f"g{q}|{gram}|{seen[gram]}")
    return out


def lost_grams(length: int, slack: float, q: int) -> int:
    """Most grams that a name of ``length`` can lose on the way to a similar one.

    ``d`` deletions and ``i`` insertions keep the score when
    d + i <= slack * (2 * length - d + i).
    """
    most = 0
    for d in range(length + 1):
        room = slack * (2 * length - d) - d
        if room < 0:
            break
        most = max(most, q * d + (q - 1) * floor(room / (1 - slack)))
    return most


def name_keys(name: str, threshold: float, listed: bool, order: PartOrder = PartOrder()) -> dict[str, tuple[int, int, int, int]]:
    """Join keys of one name; ``listed`` tells the two sides apart.

    With shared tokens S and remainders A, B of the two names, the threshold is met in
    one of two ways. (1) The whole names are a few insertions and deletions apart:
    then they share one of the rarest grams of either, so both send that many grams.
    (2) S is all, or nearly all, of one name: that name sends the two rarest tokens of
    every such S (the token itself where S has one only), the other name its pairs of
    tokens; past some tokens, it sends each token with the classes of the rarer-ranked
    rest instead of all pairs.

    A gram key comes with (q, length of the name, rank and number of its grams), other
    keys with zeros.
    """
    if threshold < LEAST_THRESHOLD:
        raise ValueError(f"names can be joined from a similarity of {LEAST_THRESHOLD} on")
    tokens = sorted(set(name.split()), key=order.key)
    if not tokens:
        return {}
    slack = 1 - threshold / 100.0 + 1e-9
    mine, theirs = ("l", "p") if listed else ("p", "l")
    length = sum(map(len, tokens)) + len(tokens) - 1
    keys: dict[str, tuple[int, int, int, int]] = {}
    for q in (3, 2):
        ranked = sorted(grams(tokens, q), key=order.key)
        lost = lost_grams(length, slack, q)
        for i, gram in enumerate(ranked[: lost + 1]):
            keys[gram] = q, length, i, len(ranked)
        # all grams may be lost only in names of many short tokens, which then meet on shorter grams
        if len(ranked) > lost:
            break
    none = (0, 0, 0, 0)

    def light(left_out: list[str]) -> bool:
        if not left_out:
            return True
        a = sum(map(len, left_out)) + len(left_out)
        return a <= slack * (2 * (length - a) + a)

    for i, x in enumerate(tokens):
        if light(tokens[:i] + tokens[i + 1 :]):
            keys[f"o{mine}|{x}"] = none
        if not light(tokens[:i]):
            break
        for j in range(i + 1, len(tokens)):
            if not light(tokens[:i] + tokens[i + 1 : j]):
                break
            keys[f"p{mine}|{x}|{tokens[j]}"] = none
            keys[f"c{mine}|{x}|{class_of(tokens[j])}"] = none
    for i, x in enumerate(tokens):
        keys[f"o{theirs}|{x}"] = none
        for y in tokens[i + 1 :]:
            if len(tokens) <= PAIR_TOKENS:
                keys[f"p{theirs}|{x}|{y}"] = none
            else:
                keys[f"c{theirs}|{x}|{class_of(y)}"] = none
    return keys


def class_of(token: str) -> int:
    return zlib.crc32(token.encode()) % CLASSES


def part_order(names: Column, *frames: DataFrame) -> PartOrder:
    """The order by frequency over the names of all frames; a bounded number of parts is looked at on the driver."""

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def parts(column: pd.Series) -> pd.Series:
        def of(name: str) -> list[str]:
            tokens = sorted(set(name.split()))
            return tokens + grams(tokens, 3) + grams(tokens, 2)

        return column.map(of)

    every = None
    for frame in frames:
        here = frame.select(F.explode(parts(names)).alias("part"))
        every = here if every is None else every.unionByName(here)
    top = every.groupBy("part").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "part").limit(RANKED_PARTS)
    return PartOrder({r.part: r.n for r in top.collect()})


KEY = T.StructType(
    [T.StructField("k", T.StringType())] + [T.StructField(c, T.IntegerType()) for c in ("q", "length", "rank", "grams")]
)


def similarity_keys(name: Column, threshold: float, listed: bool, order: PartOrder = PartOrder()) -> Column:
    """Array of join keys per name, computed in Arrow batches."""

    @F.pandas_udf(T.ArrayType(KEY))
    def keys(names: pd.Series) -> pd.Series:
        return names.map(lambda s: [(k, *place) for k, place in name_keys(s, threshold, listed, order).items()])

    return keys(name)


def may_reach(left: str, right: str, threshold: float) -> Column:
    """Whether the lengths and ranks of a shared gram still allow the threshold.

    Equal keys are not the first shared gram of two names by necessity, so as many
    grams as precede the lower rank may be shared as well.
    """
    a, b = (lambda c, side=side: F.col(f"{side}.{c}") for side in (left, right))
    q = a("q")
    apart = a("length") - b("length")
    edits = F.floor((1 - threshold / 100.0 + 1e-9) * (a("length") + b("length")))
    gone = F.floor((edits + apart) / 2)
    lost_left = (q - 1) * edits + gone
    lost_right = (q - 1) * edits + (edits - gone)
    needed = F.greatest(a("grams") - lost_left, b("grams") - lost_right)
    shared = F.least(a("rank"), b("rank")) + 1 + F.least(a("grams") - a("rank"), b("grams") - b("rank")) - 1
    return (q == 0) | ((F.abs(apart) <= edits) & (shared >= needed))


@F.pandas_udf(T.DoubleType())
def ratio_score(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([ratio(x, y) for x, y in zip(a, b)], dtype=float)


@F.pandas_udf(T.DoubleType())
def token_set_score(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([token_set_ratio(x, y) for x, y in zip(a, b)], dtype=float)
