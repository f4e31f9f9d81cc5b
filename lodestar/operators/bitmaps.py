"""Posting bitmaps (G1, G2, J5): per word and range of 32,768 ids one bitmap of
4,096 bytes, boolean terms by bitmap arithmetic; ids become rows only in the
answer.

A bitmap costs its 4,096 bytes even for one id, so they are made for the words
that requests ask for, not for every rare word of a vocabulary. Per term the
table has a row per range with an occurrence: a common word's posting list
shrinks by up to 32,768 rows to one, and no group is larger than the number of
terms. Ids are integers of any sign; null ids have no posting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RANGE = 32_768  # fixed value: ids of one bitmap of the built-in functions


def word_bitmaps(postings: DataFrame, key: str) -> DataFrame:
    """(word, bucket, bits) of (key, word) rows; repeated rows count once."""
    known = postings.where(F.col(key).isNotNull() & F.col("word").isNotNull())
    return (known.groupBy("word", F.bitmap_bucket_number(key).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias("bits")))


def all_terms_bitmap(bitmaps: DataFrame, terms) -> DataFrame:
    """(bucket, bits) of the ids that have every term."""
    terms = sorted(set(terms))
    both = bitmaps.where(F.col("word").isin(terms)).groupBy("bucket").agg(
        F.bitmap_and_agg("bits").alias("bits"), F.count(F.lit(1)).alias("n"))
    return both.where((F.col("n") == len(terms)) & (F.bitmap_count("bits") > 0)).select("bucket", "bits")


def any_term_bitmap(bitmaps: DataFrame, terms) -> DataFrame:
    """(bucket, bits) of the ids that have at least one term."""
    return bitmaps.where(F.col("word").isin(sorted(set(terms)))).groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def bitmap_ids(found: DataFrame, key: str) -> DataFrame:
    """The ids that (bucket, bits) rows stand for, one row each."""
    octets = F.transform(F.sequence(F.lit(0), F.octet_length("bits") - 1), lambda i: F.struct(
        i.alias("i"), F.conv(F.hex(F.substr(F.col("bits"), i + 1, F.lit(1))), 16, 10).cast("int").alias("octet")))
    places = F.flatten(F.transform(F.filter(octets, lambda x: x["octet"] > 0), lambda x: F.transform(
        F.filter(F.sequence(F.lit(0), F.lit(7)), lambda k: F.call_function("shiftright", x["octet"], k).bitwiseAND(F.lit(1)) == 1),
        lambda k: x["i"] * 8 + k)))
    rows = found.select("bucket", F.explode(places).alias("place"))
    above = (F.col("bucket") - 1) * RANGE + F.col("place") + 1
    return rows.select(F.when(F.col("bucket") > 0, above).otherwise(F.col("bucket") * RANGE - F.col("place")).alias(key))
