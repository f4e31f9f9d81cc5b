"""Table comparison (X1, X2, X7): order-insensitive difference, keyed
reconciliation and header comparison. Used by the tests and offered as
operators (they are what the reference's test harnesses compute)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def header_problems(actual: DataFrame, expected_columns) -> list[str]:
    """Ordered header comparison."""
    got, want = list(actual.columns), list(expected_columns)
    if got == want:
        return []
    if len(got) != len(want):
        return [f"{len(got)} columns, expected {len(want)}"]
    return [f"column {i}: {g!r} != {w!r}" for i, (g, w) in enumerate(zip(got, want)) if g != w]


def table_diff(actual: DataFrame, expected: DataFrame, multiset: bool = True) -> DataFrame:
    """Rows only in ``actual`` (side 'extra') and only in ``expected``
    (side 'missing'), one output row per distinct row with ``n`` = how many
    more copies that side has (``multiset``), or ``n`` = 1 with set
    semantics.

    Both sides are tagged, unioned and counted per distinct row; the counts
    are partial-aggregated map-side, and copies are never re-expanded, so a
    row repeated a billion times costs one output row, not a billion rows
    emitted by one task. Nulls compare equal (as in EXCEPT)."""
    cols = expected.columns
    tagged = (actual.select(*cols, F.lit(1).alias("_a"), F.lit(0).alias("_e"))
              .unionByName(expected.select(*cols, F.lit(0).alias("_a"), F.lit(1).alias("_e"))))
    counted = tagged.groupBy(*cols).agg(F.sum("_a").alias("_na"), F.sum("_e").alias("_ne"))
    if multiset:
        diff = counted.where(F.col("_na") != F.col("_ne"))
        n = F.abs(F.col("_na") - F.col("_ne"))
    else:
        diff = counted.where((F.col("_na") == 0) != (F.col("_ne") == 0))
        n = F.lit(1).cast("long")
    side = F.when(F.col("_na") > F.col("_ne"), F.lit("extra")).otherwise(F.lit("missing"))
    return diff.select(*cols, side.alias("side"), n.alias("n"))


def range_checksums(df: DataFrame, columns, ranges: int) -> DataFrame:
    """Per hash range of the rows: their number and the sums of two hashes, by
    halves. Sums count copies and do not depend on the order."""
    # nulls leave a hash as it was, so their places are hashed too
    marked = [x for c in columns for x in (F.col(c), F.col(c).isNull())]
    hashed = df.select(F.xxhash64(*marked).alias("_h"), F.xxhash64(F.lit("second"), *marked).alias("_g"))
    def half(c, k):
        return F.sum(F.shiftrightunsigned(c, 32) if k else F.col(c).bitwiseAND(F.lit(0xFFFFFFFF)))
    return hashed.groupBy(F.pmod("_h", F.lit(ranges)).alias("_range")).agg(
        F.count(F.lit(1)).alias("_n"), *[half(c, k).alias(f"{c}{k}") for c in ("_h", "_g") for k in (0, 1)])


def table_diff_by_checksums(actual: DataFrame, expected: DataFrame, multiset: bool = True, ranges: int = 1 << 16) -> DataFrame:
    """``table_diff`` for tables that are mostly equal: only the rows of hash
    ranges whose checksums differ are shuffled.

    Both sides are read twice. The first pass shuffles at most ``ranges`` small
    rows per task, the second only rows of unequal ranges, so their number follows the
    edits. The list of unequal ranges has at most ``ranges`` rows and is
    broadcast on that bound. Two ranges count as equal if row number and all
    sums of two 64-bit hashes agree."""
    cols = expected.columns
    a, e = (range_checksums(df, cols, ranges) for df in (actual, expected))
    sums = [c for c in a.columns if c != "_range"]
    j = a.alias("a").join(e.alias("e"), "_range", "full_outer")
    same = F.lit(True)
    for c in sums:
        same = same & F.col(f"a.{c}").eqNullSafe(F.col(f"e.{c}"))
    unequal = F.broadcast(j.where(~same).select("_range"))  # at most ``ranges`` rows

    def rows(df):
        marked = [x for c in cols for x in (F.col(c), F.col(c).isNull())]
        return (df.select(*cols, F.pmod(F.xxhash64(*marked), F.lit(ranges)).alias("_range"))
                .join(unequal, "_range", "left_semi").select(*cols))

    return table_diff(rows(actual), rows(expected), multiset)


def reconcile(actual: DataFrame, expected: DataFrame, keys, value: str) -> DataFrame:
    """Full outer join on the keys; status 'missing' (expected only),
    'unexpected' (actual only), 'changed' (value differs), 'same', or
    'duplicate key' when a side has several rows for one key.

    Each side is first reduced to one row per key (with its row count), so
    the outer join is one-to-one and a repeated key cannot multiply rows."""
    def one_per_key(df, name):
        return (df.groupBy(*keys)
                .agg(F.count(F.lit(1)).alias(f"_{name}_n"), F.min(value).alias(f"{name}_value")))
    a = one_per_key(actual, "actual")
    e = one_per_key(expected, "expected")
    j = a.join(e, list(keys), "full_outer")
    status = (F.when((F.col("_actual_n") > 1) | (F.col("_expected_n") > 1), F.lit("duplicate key"))
              .when(F.col("_actual_n").isNull(), F.lit("missing"))
              .when(F.col("_expected_n").isNull(), F.lit("unexpected"))
              .when(~F.col("actual_value").eqNullSafe(F.col("expected_value")), F.lit("changed"))
              .otherwise(F.lit("same")))
    return j.withColumn("status", status).drop("_actual_n", "_expected_n")
