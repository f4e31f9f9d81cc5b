"""Probabilistic record linkage (job D): similarity tuples (T9, T10) of
labelled pairs (J8), class-conditional tuple frequencies (G8), their merge
(J9), likelihood-ratio ranking (W1), match / unmatch ranges (W2, W3, W9)
over the full tuple domain (X3), blocked candidate pairs (J7) and their
labels (J10).

Scale notes
* Records are first collapsed to distinct *profiles* ``(block, fields...)``.
  The linkage result that does not grow with the square of the records is
  factorised: classes of profile pairs with a label, and the records of each
  profile (``label_classes``, ``members``, both in ``label_groups``). Record
  pairs are made by ``label_pairs`` only.
* Jaro-Winkler is evaluated only for distinct value pairs of a field whose
  signatures (length and character counts) let them reach the first cut;
  all others are low without being scored. Counting labels (``tuple_counts``)
  forms no pair that is low in every field.
* Joins of whole record tables are merge joins: the size of a compressed file
  says little about its rows, and a table broadcast on that ground passes
  through the driver. Other join strategies are left to the optimizer's
  run-time sizes.
* Everything is one lazy plan. The classifier has at most 3^k rows (k fields):
  its broadcast is bounded by construction. Its windows are un-partitioned
  over those few rows only.
* Blocks are an equi join, so AQE's skew-join split applies to a hot block; a
  null block key has no candidates.
* Null field values stay: they pair up with anything at level low.
* All-pairs comparison without blocking (a cross product) is not offered.
"""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.functions.similarity import LEVEL_CUTS, LEVELS, highest_score, signature, similarity_level, with_jaro_winkler

DEFAULT_FIELDS = ("name", "city", "address")
LABEL_MATCH, LABEL_POSSIBLE, LABEL_UNMATCH = "match", "possible match", "unmatch"
LABEL_MEMBER = "member"
EPS = 1e-9


def level_cols(fields) -> list[str]:
    return [f"s_{f}" for f in fields]


# --- T9 / T10 ------------------------------------------------------------------

def score_value_pairs(pairs: DataFrame, fields, left_prefix: str = "l_", right_prefix: str = "r_") -> DataFrame:
    """Add ``s_<field>`` levels to a pair table that has ``l_<field>`` and
    ``r_<field>`` columns; Jaro-Winkler runs on the distinct value pairs of
    each field only. Value pairs are joined back null-safe, so no pair is lost."""
    out = pairs
    for f in fields:
        l, r = f"{left_prefix}{f}", f"{right_prefix}{f}"
        values = pairs.select(F.col(l).cast("string").alias("_l"), F.col(r).cast("string").alias("_r")).distinct()
        levels = with_jaro_winkler(values, "_l", "_r", "_jw").select("_l", "_r", similarity_level(F.col("_jw")).alias(f"s_{f}"))
        out = out.join(levels, F.col(l).cast("string").eqNullSafe(F.col("_l"))
                       & F.col(r).cast("string").eqNullSafe(F.col("_r"))).drop("_l", "_r")
    return out


def pair_scores(pairs: DataFrame, fields) -> DataFrame:
    """Jaro-Winkler scores (not levels) per field, for inspection."""
    for f in fields:
        pairs = with_jaro_winkler(pairs, f"l_{f}", f"r_{f}", f"jw_{f}")
    return pairs


# --- J8 ------------------------------------------------------------------------------

def _side(df: DataFrame, prefix: str, key: str, fields) -> DataFrame:
    return df.select(F.col(key).alias(f"{prefix}{key}"), *[F.col(f).alias(f"{prefix}{f}") for f in fields])


# --- G8 / J9 ------------------------------------------------------------------------------

def _with_probabilities(merged: DataFrame) -> DataFrame:
    everything = Window.partitionBy()       # the merged table has at most 3^k rows
    return (merged.withColumn("n_m", F.sum("m_cnt").over(everything))
            .withColumn("n_u", F.sum("u_cnt").over(everything))
            .withColumn("m", F.try_divide(F.col("m_cnt").cast("double"), F.col("n_m")))
            .withColumn("u", F.try_divide(F.col("u_cnt").cast("double"), F.col("n_u"))))


def training_distribution(left: DataFrame, right: DataFrame, known: DataFrame, unmatched: DataFrame,
                          fields=DEFAULT_FIELDS, key: str = "index", left_key: str = "zindex",
                          right_key: str = "findex") -> DataFrame:
    """J8 + G8 + J9 in one pass: both labelled pair files are tagged with
    their class, scored together and counted per tuple; a tuple seen in one
    class only has the count 0 in the other. Duplicate pairs each count. The
    class totals come along, so m = m_cnt / n_m and u = u_cnt / n_u stay exact."""
    tagged = (known.select(left_key, right_key, F.lit(True).alias("is_match"))
              .unionByName(unmatched.select(left_key, right_key, F.lit(False).alias("is_match"))))
    l = _side(left, "l_", key, fields).withColumnRenamed(f"l_{key}", left_key)
    r = _side(right, "r_", key, fields).withColumnRenamed(f"r_{key}", right_key)
    scored = score_value_pairs(tagged.join(l.hint("merge"), left_key).join(r.hint("merge"), right_key), fields)
    merged = (scored.groupBy(*level_cols(fields))
              .agg(F.count_if(F.col("is_match")).alias("m_cnt"), F.count_if(~F.col("is_match")).alias("u_cnt")))
    return _with_probabilities(merged)


# --- W1 ----------------------------------------------------------------------------------

def rank_tuples(probs: DataFrame, fields) -> DataFrame:
    """Tuples with u = 0 first (by m descending), then by m/u
    descending; ties by the tuple as text ascending. Adds ``rank`` (1..)."""
    s = level_cols(fields)
    ratio = F.when(F.col("u_cnt") == 0, F.col("m")).otherwise(F.col("m") / F.col("u"))
    w = Window.orderBy(F.when(F.col("u_cnt") == 0, 0).otherwise(1), ratio.desc(), *[F.col(c).asc() for c in s])
    return probs.withColumn("rank", F.row_number().over(w))


# --- X3 / W2 / W3 / W9 ------------------------------------------------------------------------

def tuple_domain(spark, fields, levels=LEVELS) -> DataFrame:
    """Every tuple of levels (3^k rows), made by exploding literal
    arrays (no join)."""
    df = spark.range(1).select()
    for c in level_cols(fields):
        df = df.select("*", F.explode(F.array(*[F.lit(v) for v in levels])).alias(c))
    return df


def classifier(probs: DataFrame, fields, mu: float, lambda_: float) -> DataFrame:
    """W2 + W3 + W9 over the full domain: walking the ranking from the top,
    tuples stay 'match' while the running unmatch mass is <= mu; walking from
    the bottom, tuples are 'unmatch' while the running match mass is
    <= lambda (a tuple in both ranges is 'match'); everything else, including
    tuples never seen in training, is 'possible match'.

    Running masses are kept as integer counts compared with mu * n
    (an exact form of the floating-point running sum)."""
    s = level_cols(fields)
    ranked = rank_tuples(probs.where((F.col("m_cnt") > 0) | (F.col("u_cnt") > 0)), fields)
    top = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bottom = Window.orderBy("rank").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    ranked = (ranked
              .withColumn("cum_u", F.sum("u_cnt").over(top))
              .withColumn("cum_m", F.sum("m_cnt").over(bottom)))
    is_match = F.col("cum_u") <= F.lit(mu) * F.col("n_u") + F.lit(EPS)
    is_unmatch = F.col("cum_m") <= F.lit(lambda_) * F.col("n_m") + F.lit(EPS)
    ranked = ranked.withColumn(
        "label", F.when(is_match, F.lit(LABEL_MATCH)).when(is_unmatch, F.lit(LABEL_UNMATCH)))
    domain = tuple_domain(probs.sparkSession, fields)
    return (domain.join(ranked.select(*s, "label"), s, "left")
            .withColumn("label", F.coalesce(F.col("label"), F.lit(LABEL_POSSIBLE))))


def train_classifier(left: DataFrame, right: DataFrame, known: DataFrame, unmatched: DataFrame,
                     mu: float, lambda_: float, fields=DEFAULT_FIELDS, key: str = "index") -> DataFrame:
    """I6 first half: labelled pairs -> tuple distributions -> classifier."""
    return classifier(training_distribution(left, right, known, unmatched, fields, key), fields, mu, lambda_)


# --- T9 / T10 with a bound ------------------------------------------------------------------------

#: how far the bound may fall short of the first cut by rounding
SLACK = 1e-9


def near_values(left: DataFrame, right: DataFrame) -> DataFrame:
    """(l, r, level) of the distinct value pairs of a common block whose level
    isn't low; ``left`` and ``right``: (block, value). Only pairs whose
    signatures let them reach the first cut are scored; all others are low."""
    sign = signature(F.col("value"))        # of distinct values, not of all records
    l = left.select("block", "value").distinct().select("block", F.col("value").alias("l"), sign.alias("ls"))
    r = right.select("block", "value").distinct().select(F.col("block").alias("_block"), F.col("value").alias("r"), sign.alias("rs"))
    reach = highest_score(F.col("ls"), F.col("rs")) >= LEVEL_CUTS[0] - SLACK
    pairs = l.join(r, (F.col("block") == F.col("_block")) & reach).select("l", "r").distinct()
    scored = with_jaro_winkler(pairs, "l", "r", "_jw").select("l", "r", similarity_level(F.col("_jw")).alias("level"))
    # the aggregate (one row each) keeps the filter from being pushed into the score, and every use reads the same exchange
    return scored.groupBy("l", "r").agg(F.max("level").alias("level")).where(F.col("level") != LEVELS[0]).repartition("l", "r")


def signature_share(left: DataFrame, right: DataFrame, block_left: Column, block_right: Column, fields=DEFAULT_FIELDS) -> DataFrame:
    """field, n_pairs, n_scored: the distinct value pairs of common blocks, and
    those that ``near_values`` scores."""
    out = []
    for f in fields:
        l = _values(left, block_left, f).withColumn("ls", signature(F.col("value"))).distinct()
        r = _values(right, block_right, f).withColumn("rs", signature(F.col("value"))).distinct().withColumnRenamed("value", "r")
        pairs = l.join(r, "block").groupBy("value", "r").agg(
            F.max(highest_score(F.col("ls"), F.col("rs")) >= LEVEL_CUTS[0] - SLACK).alias("reach"))
        out.append(pairs.agg(F.count(F.lit(1)).alias("n_pairs"), F.count_if("reach").alias("n_scored"))
                   .select(F.lit(f).alias("field"), "n_pairs", "n_scored"))
    return _union(out)


def _values(df: DataFrame, block: Column, field: str) -> DataFrame:
    return (df.select(block.alias("block"), F.col(field).cast("string").alias("value"))
            .where(F.col("block").isNotNull() & (F.length("value") > 0)))


def _near(left, right, block_left, block_right, fields) -> dict[str, DataFrame]:
    return {f: near_values(_values(left, block_left, f), _values(right, block_right, f)) for f in fields}


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for one in parts[1:]:
        out = out.unionByName(one)
    return out


# --- J7 / J10: candidates -------------------------------------------------------------------------

def _profiles(df: DataFrame, prefix: str, block: Column, fields) -> DataFrame:
    return (df.select(block.alias("block"), *[F.col(f).cast("string").alias(f"{prefix}{f}") for f in fields]).where("block IS NOT NULL")
            .groupBy("block", *[f"{prefix}{f}" for f in fields])
            .agg(F.count(F.lit(1)).alias(f"{prefix}n")))


def tuple_counts(left: DataFrame, right: DataFrame, block_left: Column, block_right: Column, fields=DEFAULT_FIELDS,
                 self_pairs: bool = False) -> DataFrame:
    """J7 counted: s_<field>.. and n, the record pairs of all blocks per tuple.

    Pairs are counted by their near fields only: for each set of fields, the
    pairs that are near in all of them come from joins of the near value pairs
    with the counts of just these fields, the most selective (first) field
    first; pairs that are low elsewhere are what is left of them once those near in
    more fields are taken off. Pairs low in every field are never
    formed, nor is a pair of whole profiles.

    ``self_pairs``: left and right are the same table; the pairs of a
    record with itself are taken off."""
    near = _near(left, right, block_left, block_right, fields)
    counted = []
    for chosen in product((False, True), repeat=len(fields)):
        some = [f for f, own in zip(fields, chosen, strict=True) if own]
        l, r = _profiles(left, "l_", block_left, some), _profiles(right, "r_", block_right, some)
        pairs = l
        for i, f in enumerate(some):
            own = near[f].select(F.col("l").alias(f"l_{f}"), F.col("r").alias(f"r_{f}"), F.col("level").alias(f"s_{f}"))
            if i == 0:
                pairs = pairs.join(own, f"l_{f}").join(r, ["block", f"r_{f}"])
            else:
                pairs = pairs.join(own, [f"l_{f}", f"r_{f}"])
        if not some:
            pairs = pairs.join(r, "block")
        counted.append(pairs.select(*[F.col(f"s_{f}") if f in some else F.lit(None).cast("string").alias(f"s_{f}") for f in fields],
                                    (F.col("l_n") * F.col("r_n")).alias("n")))
    out = _union(counted).groupBy(*level_cols(fields)).agg(F.sum("n").alias("n"))
    for s in level_cols(fields):
        # a near field counts for its level, and against the pairs that are low there
        both = F.array(F.struct(F.col(s).alias("level"), F.lit(1).alias("sign")), F.struct(F.lit(LEVELS[0]).alias("level"), F.lit(-1).alias("sign")))
        low = F.array(F.struct(F.lit(LEVELS[0]).alias("level"), F.lit(1).alias("sign")))
        out = (out.withColumn("_e", F.explode(F.when(F.col(s).isNull(), low).otherwise(both)))
               .withColumns({s: F.col("_e.level"), "n": F.col("n") * F.col("_e.sign")}).drop("_e"))
    if self_pairs:
        same = [F.when(F.length(F.col(f).cast("string")) > 0, LEVELS[2]).otherwise(LEVELS[0]).alias(f"s_{f}") for f in fields]
        out = out.unionByName(left.where(block_left.isNotNull()).select(*same).groupBy(*level_cols(fields))
                              .agg((-F.count(F.lit(1))).alias("n")))
    return out.groupBy(*level_cols(fields)).agg(F.sum("n").alias("n")).where("n > 0")


def label_counts(left: DataFrame, right: DataFrame, block_left: Column, block_right: Column,
                 classifier_df: DataFrame, fields=DEFAULT_FIELDS, self_pairs_key: str | None = None) -> DataFrame:
    """J7 + J10 aggregated: number of record pairs per label.

    ``self_pairs_key``: when left and right are the same table, the pairs
    of a record with itself are not counted."""
    s = level_cols(fields)
    counts = tuple_counts(left, right, block_left, block_right, fields, self_pairs_key is not None)
    return counts.join(F.broadcast(classifier_df.select(*s, "label")), s).groupBy("label").agg(F.sum("n").alias("n_pairs"))


def profile_name(fields) -> Column:
    """The name of a profile: a 128-bit digest of its fields; a null field is
    told from an empty one."""
    return F.md5(F.concat_ws("\x1f", *[F.coalesce(F.col(f).cast("string"), F.lit("\x00")) for f in fields]))


def members(df: DataFrame, block: Column, fields=DEFAULT_FIELDS, key: str = "index") -> DataFrame:
    """(key, block, profile): the profile that each record with a block belongs
    to. With ``label_classes`` this is the whole linkage result."""
    return df.select(F.col(key), block.alias("block"), profile_name(fields).alias("profile")).where("block IS NOT NULL")


def label_classes(left: DataFrame, right: DataFrame, block_left: Column, block_right: Column,
                  classifier_df: DataFrame, fields=DEFAULT_FIELDS, self_pairs: bool = False) -> DataFrame:
    """J7 + J10 factorised: (block, left_profile, right_profile, label,
    n_pairs) for the profile pairs of a block that stand for any record pair.
    The rows follow the distinct field values of a block, not its records: all
    record pairs of a class have its label, and ``members`` names them.

    ``self_pairs``: left and right are the same table; pairs of a record with
    itself are not counted, and a class of nothing else is left out."""
    near = _near(left, right, block_left, block_right, fields)
    lp, rp = _profiles(left, "l_", block_left, fields), _profiles(right, "r_", block_right, fields)
    name = {x: profile_name([f"{x}{f}" for f in fields]).alias(f"{x}profile") for x in ("l_", "r_")}
    pairs = lp.select("*", name["l_"]).join(rp.select("*", name["r_"]), "block")
    for f in fields:
        own = near[f].select(F.col("l").alias(f"l_{f}"), F.col("r").alias(f"r_{f}"), F.col("level").alias(f"s_{f}"))
        pairs = pairs.join(own, [f"l_{f}", f"r_{f}"], "left").withColumn(f"s_{f}", F.coalesce(f"s_{f}", F.lit(LEVELS[0])))
    s = level_cols(fields)
    own = F.when(F.col("l_profile") == F.col("r_profile"), F.col("l_n")).otherwise(0) if self_pairs else F.lit(0)
    return (pairs.join(F.broadcast(classifier_df.select(*s, "label")), s)        # at most 3^k rows
            .select("block", F.col("l_profile").alias("left_profile"), F.col("r_profile").alias("right_profile"), "label",
                    (F.col("l_n") * F.col("r_n") - own).alias("n_pairs")).where("n_pairs > 0"))


def label_groups(df: DataFrame, block: Column, classifier_df: DataFrame, fields=DEFAULT_FIELDS, key: str = "index",
                 left_key: str = "zindex", right_key: str = "findex") -> DataFrame:
    """J7 + J10 + S8 rows of a table linked with itself, without expanding
    copies: (left key, right key, label, block, left_profile, right_profile, n_pairs).

    A pair of profiles of a block is one row between their representatives (the
    smallest key of each), with the number of pairs of different keys that have
    its label. Every record that has a key and a block is one row with the
    label ``member``, its key on the left and its representative on the right.
    Expanding both sides of the pairs by the members of their block and profile, less
    pairs of equal keys, gives the rows of ``label_pairs``."""
    keyed = df.where(F.col(key).isNotNull())
    own = members(keyed, block, fields, key)
    classes = label_classes(keyed, keyed, block, block, classifier_df, fields)
    # a key may come again, with the same profile or another one
    n = own.groupBy(key, "block", "profile").agg(F.count(F.lit(1)).alias("n"))
    equal = (n.withColumnsRenamed({"profile": "left_profile", "n": "l"})
             .join(n.withColumnsRenamed({"profile": "right_profile", "n": "r"}).hint("merge"), [key, "block"])
             .groupBy("block", "left_profile", "right_profile").agg(F.sum(F.col("l") * F.col("r")).alias("equal")))
    first = own.groupBy("block", "profile").agg(F.min(key).alias("first"))
    side = {x: first.withColumnsRenamed({"profile": f"{x}_profile", "first": k}) for x, k in (("left", left_key), ("right", right_key))}
    columns = [left_key, right_key, "label", "block", "left_profile", "right_profile", "n_pairs"]
    pairs = (classes.join(equal, ["block", "left_profile", "right_profile"], "left")
             .withColumn("n_pairs", F.col("n_pairs") - F.coalesce("equal", F.lit(0))).where("n_pairs > 0")
             .join(side["left"], ["block", "left_profile"]).join(side["right"], ["block", "right_profile"]).select(*columns))
    belongs = (own.join(first.hint("merge"), ["block", "profile"]).withColumnsRenamed({key: left_key, "first": right_key, "profile": "left_profile"})
               .withColumns({"label": F.lit(LABEL_MEMBER), "right_profile": F.col("left_profile"), "n_pairs": F.lit(None).cast("long")}))
    return pairs.unionByName(belongs.select(*columns))


def label_pairs(left: DataFrame, right: DataFrame, block_left: Column, block_right: Column,
                classifier_df: DataFrame, fields=DEFAULT_FIELDS, key: str = "index",
                left_key: str = "zindex", right_key: str = "findex") -> DataFrame:
    """J7 + J10 + S8 rows: (left key, right key, label) for every record pair
    of every block, the classes joined with the members of both sides. Its
    rows grow with the square of a block's records."""
    classes = label_classes(left, right, block_left, block_right, classifier_df, fields)
    l = members(left, block_left, fields, key).select(F.col(key).alias(left_key), "block", F.col("profile").alias("left_profile"))
    r = members(right, block_right, fields, key).select(F.col(key).alias(right_key), "block", F.col("profile").alias("right_profile"))
    return (classes.join(l.hint("merge"), ["block", "left_profile"]).join(r.hint("merge"), ["block", "right_profile"])
            .select(left_key, right_key, "label"))
