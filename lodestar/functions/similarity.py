"""Jaro-Winkler similarity (T9) as one native Column built from higher-order
functions, and the three-level similarity category (T10).

Spark has no Jaro-Winkler built-in. Writing it with ``aggregate`` /
``filter`` / ``zip_with`` keeps it inside the JVM: no Python worker, no
Arrow round trip, and Catalyst can still prune and push around it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Winkler boost parameters (boost only above this Jaro score,
# common prefix capped at this length, prefix weight).
BOOST_THRESHOLD = 0.7
PREFIX_CAP = 4
PREFIX_WEIGHT = 0.1

# Similarity level cut points and names.
LEVEL_CUTS = (0.8, 1.0)
LEVELS = ("low", "medium", "high")


def _match_positions(a: Column, b: Column) -> Column:
    """Per position of ``a`` (arrays of characters): the 1-based index of its
    matched character in ``b`` (0 = none). Each character of ``a`` takes the
    first unused equal character of ``b`` inside the window
    ``max(0, max(la, lb) div 2 - 1)``."""
    la, lb = F.size(a), F.size(b)
    w = F.greatest(F.lit(0), F.floor(F.greatest(la, lb) / 2).cast("int") - 1).cast("int")
    empty = F.array().cast("array<int>")

    def match_step(taken, i):
        lo = F.greatest(F.lit(1), i - w)
        hi = F.least(i + w, lb)
        cands = F.filter(F.sequence(lo, F.greatest(lo, hi)),
                         lambda j: (j <= hi) & (F.get(b, j - 1) == F.get(a, i - 1)) & ~F.array_contains(taken, j))
        return F.concat(taken, F.array(F.coalesce(F.get(cands, 0), F.lit(0))))

    return F.aggregate(F.sequence(F.lit(1), F.greatest(la, F.lit(1))), empty, match_step)


def _jaro_from(a: Column, b: Column, m: Column, mismatches: Column) -> Column:
    la, lb = F.size(a), F.size(b)
    t = F.floor(mismatches / 2).cast("double")
    return (m / la + m / lb + (m - t) / m) / 3.0


def _prefix_len(a: Column, b: Column) -> Column:
    cap = F.least(F.lit(PREFIX_CAP), F.size(a), F.size(b))
    return F.aggregate(F.sequence(F.lit(1), F.greatest(cap, F.lit(1))), F.lit(0),
                       lambda acc, k: F.when((acc == k - 1) & (k <= cap) & (F.get(a, k - 1) == F.get(b, k - 1)), k)
                       .otherwise(acc))


def with_jaro_winkler(df: DataFrame, a: str, b: str, out: str) -> DataFrame:
    """Add ``out`` = Jaro-Winkler(a, b) by characters, computed in stages
    (characters, match positions, matched counts, Jaro, boost) so every
    intermediate is evaluated once per row; equal, empty and null values skip
    the matching.

    Transpositions are the mismatches between the matched characters of
    ``a`` (in ``a`` order) and of ``b`` (in ``b`` order), halved and
    floored. 0 when a side is empty, 1 for equal strings, null for a null."""
    A, B = F.col(a), F.col(b)
    tmp = f"__jw_{out}"
    ca, cb, idx = F.col(f"{tmp}_ca"), F.col(f"{tmp}_cb"), F.col(f"{tmp}_idx")
    open_ = (A != B) & (F.length(A) > 0) & (F.length(B) > 0)
    st = (df.withColumns({f"{tmp}_ca": F.split(F.when(open_, A), ""), f"{tmp}_cb": F.split(F.when(open_, B), "")})
          .withColumn(f"{tmp}_idx", F.when(ca.isNotNull(), _match_positions(ca, cb)))
          .withColumn(f"{tmp}_bpos", F.array_sort(F.filter(idx, lambda j: j > 0)))
          .withColumn(f"{tmp}_apos", F.filter(F.transform(idx, lambda j, k: F.when(j > 0, k + 1).otherwise(0)),
                                              lambda k: k > 0)))
    st = (st.withColumn(f"{tmp}_m", F.size(f"{tmp}_bpos").cast("double"))
          .withColumn(f"{tmp}_mis", F.size(F.filter(
              F.zip_with(f"{tmp}_apos", f"{tmp}_bpos", lambda x, y: F.get(ca, x - 1) != F.get(cb, y - 1)), lambda d: d))))
    st = st.withColumn(f"{tmp}_jaro", F.when(F.col(f"{tmp}_m") > 0,
                                             _jaro_from(ca, cb, F.col(f"{tmp}_m"), F.col(f"{tmp}_mis"))))
    jaro = F.col(f"{tmp}_jaro")
    boosted = F.when(jaro > BOOST_THRESHOLD,
                     jaro + F.lit(PREFIX_WEIGHT) * _prefix_len(ca, cb) * (1.0 - jaro)).otherwise(jaro)
    value = (F.when(A.isNull() | B.isNull(), F.lit(None).cast("double"))
             .when((F.length(A) == 0) | (F.length(B) == 0), F.lit(0.0))
             .when(A == B, F.lit(1.0))
             .otherwise(F.coalesce(boosted, F.lit(0.0))))
    return st.withColumn(out, value).drop(*[c for c in st.columns if c.startswith(tmp)])


def signature(value: Column) -> Column:
    """What bounds the score of a value from above without its text: its
    length, and per character class (code point mod 32) whether it holds one
    (bits 0 to 31) and two (bits 32 to 63) characters of it."""
    def seen(mask, char):
        place = F.ascii(char) % 32
        again = F.call_function("shiftright", mask, place).bitwiseAND(F.lit(1)).cast("int")
        return mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), place + 32 * again))

    mask = F.aggregate(F.split(value, ""), F.lit(0).cast("bigint"), seen)
    return F.struct(F.length(value).alias("n"), mask.alias("mask"), F.substring(value, 1, PREFIX_CAP).alias("head"))


def highest_score(a: Column, b: Column) -> Column:
    """An upper bound of the Jaro-Winkler score of two values, from their
    signatures: matched characters are at most the common ones, of which a class
    holds at most the two that both masks show and those beyond the masks."""
    both = F.bit_count(a["mask"].bitwiseAND(b["mask"]))
    beyond = F.least(a["n"] - F.bit_count(a["mask"]), b["n"] - F.bit_count(b["mask"]))
    m = F.greatest(F.lit(0), F.least(a["n"], b["n"], both + beyond)).cast("double")
    jaro = (m / F.greatest(a["n"], F.lit(1)) + m / F.greatest(b["n"], F.lit(1)) + 1.0) / 3.0
    same = F.lit(0)
    for k in range(1, PREFIX_CAP + 1):
        equal = (a["n"] >= k) & (b["n"] >= k) & (F.substring(a["head"], 1, k) == F.substring(b["head"], 1, k))
        same = F.when(equal, k).otherwise(same)
    return F.when(jaro > BOOST_THRESHOLD, jaro + PREFIX_WEIGHT * same * (1.0 - jaro)).otherwise(jaro)


def similarity_level(score: Column) -> Column:
    """< 0.8 low, < 1.0 medium, else high. A missing score (a null on
    either side) is low: an absent value speaks for no match."""
    return (F.when(score.isNull() | (score < LEVEL_CUTS[0]), F.lit(LEVELS[0]))
            .when(score < LEVEL_CUTS[1], F.lit(LEVELS[1]))
            .otherwise(F.lit(LEVELS[2])))
