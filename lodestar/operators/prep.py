"""Feature preparation (F16, T14, split): drop records with impossible zero
measurements, bin numeric columns into labelled ranges, assign a
deterministic train/test split. All are column expressions on one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bin_column(value: Column, bounds) -> Column:
    """``bounds`` is an ordered list of (operator, cut, label) followed
    by a final label; the first rule that holds wins.
    Example: [("<", 2, "low"), ("<", 6, "medium"), "high"]."""
    *rules, last = bounds
    out = F.lit(last)
    for op, cut, label in reversed(rules):
        cond = value < F.lit(cut) if op == "<" else value <= F.lit(cut)
        out = F.when(cond, F.lit(label)).otherwise(out)
    return F.when(value.isNull(), F.lit(None).cast("string")).otherwise(out)


def drop_zero_records(df: DataFrame, columns) -> DataFrame:
    """F16: keep rows where none of ``columns`` is 0."""
    cond = F.lit(True)
    for c in columns:
        cond = cond & (F.col(f"`{c}`").cast("double") != 0)
    return df.where(cond)


def hash_split(key: Column, test_tenths: int = 1, buckets: int = 10) -> Column:
    """Deterministic split from a hash of the key: 'test' for the first
    ``test_tenths`` of ``buckets`` buckets, else 'train'."""
    return F.when(F.pmod(F.xxhash64(key), F.lit(buckets)) < test_tenths, F.lit("test")).otherwise(F.lit("train"))


def key_split(key: Column, test_tenths: int = 1, buckets: int = 10) -> Column:
    """Deterministic split on an integral key (portable to any SQL engine)."""
    return F.when(F.pmod(key, F.lit(buckets)) < test_tenths, F.lit("test")).otherwise(F.lit("train"))


# The cleaning and binning that turns the raw diabetes table
# into the shipped training/testing files (derived from those data files).
PIMA_RAW_COLUMNS = ("Number of pregnancies", "Plasma glucose level", "Diastolic Blood Pressure",
                    "Triceps skin fold thickness", "2-Hour serum insulin", "Body Mass Index",
                    "Diabetes Pedigree Function", "Age (in years)", "Has Diabetes (1 is yes and 0 is no)")
PIMA_ZERO_IS_MISSING = ("Plasma glucose level", "Diastolic Blood Pressure", "Body Mass Index")
PIMA_DROPPED = ("Triceps skin fold thickness", "2-Hour serum insulin")
PIMA_BINS = {
    "Number of pregnancies": [("<", 2, "low"), ("<", 6, "medium"), "high"],
    "Plasma glucose level": [("<", 95, "low"), ("<", 141, "medium"), "high"],
    "Diastolic Blood Pressure": [("<", 80, "normal"), ("<", 90, "pre-hypertension"), "high"],
    "Body Mass Index": [("<", 18.5, "low"), ("<=", 25.0, "healthy"), ("<=", 30.0, "obese"), "severely-obese"],
    "Diabetes Pedigree Function": [("<", 0.42, "low"), ("<", 0.82, "medium"), "high"],
    "Age (in years)": [("<", 41, "r1"), ("<", 60, "r2"), "r3"],
}


def pima_prepare(raw: DataFrame) -> DataFrame:
    """Raw numeric diabetes rows -> cleaned, projected, binned string rows.

    Header names are trimmed first (the raw file has leading blanks)."""
    df = raw.toDF(*[c.strip() for c in raw.columns])
    df = drop_zero_records(df, PIMA_ZERO_IS_MISSING)
    target = PIMA_RAW_COLUMNS[-1]
    out = [bin_column(F.col(f"`{c}`").cast("double"), PIMA_BINS[c]).alias(c)
           for c in df.columns if c in PIMA_BINS]
    return df.select(*out, F.col(f"`{target}`").cast("int").cast("string").alias(target))
