"""Parquet table source (S5) with explicit schemas, plus the file sources of
the four jobs: page table (S1), code map JSON (S2), record CSV (S3),
all-string training CSV (S4) and single-column list CSV (S6).

Schemas are always declared, never inferred: inference costs a pass over the
data and can change types between files."""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

L, I, D, S, TS = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType(), T.TimestampType()


def _schema(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


TABLE_SCHEMAS: dict[str, T.StructType] = {
    "region": _schema(("r_regionkey", I), ("r_name", S)),
    "nation": _schema(("n_nationkey", I), ("n_name", S), ("n_regionkey", I)),
    "customer": _schema(("c_custkey", L), ("c_name", S), ("c_nationkey", I),
                        ("c_acctbal", D), ("c_mktsegment", S)),
    "supplier": _schema(("s_suppkey", L), ("s_name", S), ("s_nationkey", I), ("s_acctbal", D)),
    "part": _schema(("p_partkey", L), ("p_name", S), ("p_brand", S), ("p_type", S),
                    ("p_size", I), ("p_retailprice", D)),
    "orders": _schema(("o_orderkey", L), ("o_custkey", L), ("o_orderstatus", S),
                      ("o_totalprice", D), ("o_orderdate", TS), ("o_orderpriority", S)),
    "lineitem": _schema(("l_orderkey", L), ("l_partkey", L), ("l_suppkey", L),
                        ("l_linenumber", I), ("l_quantity", D), ("l_extendedprice", D),
                        ("l_discount", D), ("l_tax", D), ("l_returnflag", S),
                        ("l_linestatus", S), ("l_shipdate", TS)),
    "events": _schema(("event_id", L), ("ts", TS), ("user_id", L), ("event_type", S),
                      ("value", D), ("props", S)),
    "documents": _schema(("doc_id", L), ("text", S), ("lang", S), ("source", S), ("n_chars", L)),
    "embeddings": _schema(("vec_id", L), ("embedding", T.ArrayType(T.FloatType())), ("label", I)),
    "pages": _schema(("page_id", L), ("url", S), ("html", S)),
    "benchmark": _schema(("item_id", L), ("text", S)),
    "labels": _schema(("doc_id", L), ("quality", I), ("toxic", I)),
    "conversations": _schema(("conv_id", L), ("turn", L), ("role", S), ("text", S)),
}


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one driver table. Column pruning and filter pushdown reach this
    scan because it is a plain parquet relation."""
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(table_path(sf_dir, name))


# --- S1: page source -------------------------------------------------------

def fetchable_pages(pages: DataFrame) -> DataFrame:
    """A page whose body is missing or empty counts as a failed fetch and is
    dropped, like a 404 in a live crawl."""
    return pages.where(F.col("html").isNotNull() & (F.length("html") > 0))


# --- S2: JSON code map -----------------------------------------------------

def read_code_map(spark: SparkSession, path: str) -> DataFrame:
    """A JSON object {code: id, ...} as rows (code string, id int).

    Read as text and parsed by ``from_json`` into a map, then exploded: the
    map never passes through the driver. One file is one task; for very
    large maps use ``read_code_map_split`` or JSON lines (``read_code_map_lines``)."""
    text = spark.read.text(path, wholetext=True)
    parsed = text.select(F.from_json("value", T.MapType(S, I)).alias("m"))
    return parsed.select(F.explode("m").alias("code", "id"))


def read_code_map_split(spark: SparkSession, path: str) -> DataFrame:
    """``read_code_map`` by many tasks a file: same rows for JSON objects of any
    size.

    The file is read as records that end at a comma, which the text source
    splits anywhere. A comma inside a code is repaired: an odd number of quotes
    before a record means that it starts inside a string and belongs to the
    member before it. Quotes and members are counted per split of the file, and
    a running sum over the splits (one row each) carries both counts on; only
    then are members put together, by their number in the file."""
    cut = spark.read.option("lineSep", ",").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"))
    # an escaped quote is no quote; a pair of backslash and character never holds a comma
    bare = F.regexp_replace("value", r"(?s)\\.", "")
    cut = cut.withColumn("quotes", F.length(bare) - F.length(F.replace(bare, F.lit('"'), F.lit(""))))
    split = ["file", "start"]
    inside = Window.partitionBy(*split).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    records = cut.withColumn("odd", F.coalesce(F.sum("quotes").over(inside), F.lit(0)) % 2)
    # members that begin in a split, if it starts outside (0) or inside (1) a string
    per_split = records.groupBy(*split).agg(F.sum("quotes").alias("q"), *[
        F.count_if(F.col("odd") == k).alias(f"begun{k}") for k in (0, 1)])
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    per_split = per_split.withColumn("carry", F.coalesce(F.sum("q").over(before), F.lit(0)) % 2)
    begun = F.when(F.col("carry") == 0, F.col("begun0")).otherwise(F.col("begun1"))
    per_split = per_split.withColumn("first", F.coalesce(F.sum(begun).over(before), F.lit(0)))
    joined = records.join(per_split.select(*split, "carry", "first"), split)
    upto = Window.partitionBy(*split).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    number = F.col("first") + F.count_if(F.col("odd") == F.col("carry")).over(upto)
    members = (joined.withColumn("member", number).groupBy("file", "member")
               .agg(F.array_sort(F.collect_list(F.struct("start", "at", "value"))).alias("parts"))
               .select(F.array_join("parts.value", ",").alias("text")))
    # outside strings a brace only opens or closes the object
    text = F.regexp_replace(F.regexp_replace("text", r"^\s*\{", ""), r"\}\s*$", "")
    parsed = members.select(F.from_json(F.concat(F.lit("{"), text, F.lit("}")), T.MapType(S, I)).alias("m"))
    return parsed.select(F.explode("m").alias("code", "id"))


def read_code_map_lines(spark: SparkSession, path: str) -> DataFrame:
    """The same map as JSON lines ``{"code": ..., "id": ...}``: splittable,
    so a very large map is parsed by many tasks (a single JSON object file
    is necessarily parsed by one task per file)."""
    return spark.read.schema(_schema(("code", S), ("id", I))).json(path)


def code_map_from_dict(spark: SparkSession, mapping: dict) -> DataFrame:
    rows = [(str(k), int(v)) for k, v in mapping.items()]
    return spark.createDataFrame(rows, "code string, id int")


def invert_code_map(code_map: DataFrame) -> DataFrame:
    """Code -> id becomes id -> code."""
    return code_map.select(F.col("id"), F.col("code"))


# --- S3: record CSV --------------------------------------------------------

RECORD_SCHEMA = _schema(("index", I), ("restaurant name", S), ("city", S), ("street address", S))
RECORD_RENAMES = {"restaurant name": "name", "street address": "address"}


def read_records_csv(spark: SparkSession, path: str) -> DataFrame:
    """Record list with header; columns renamed to (index, name, city, address)."""
    df = spark.read.schema(RECORD_SCHEMA).option("header", "true").option("escape", '"').csv(path)
    return df.withColumnsRenamed(RECORD_RENAMES)


def read_pairs_csv(spark: SparkSession, path: str) -> DataFrame:
    """Labelled pair file (zindex, findex)."""
    return (spark.read.schema(_schema(("zindex", I), ("findex", I)))
            .option("header", "true").csv(path))


# --- S4: all-string table, target = last column ----------------------------

def read_string_table(spark: SparkSession, path: str) -> DataFrame:
    """Every column as a string (no inference). The header is read first so
    the schema can be declared; the row order is kept in ``row_id``."""
    header = spark.read.option("header", "false").csv(path).first()
    names = [str(h) for h in header]
    schema = _schema(*[(n, S) for n in names])
    df = spark.read.schema(schema).option("header", "true").csv(path)
    return with_row_id(df)


def target_column(df: DataFrame) -> str:
    cols = [c for c in df.columns if c != "row_id"]
    return cols[-1]


def with_row_id(df: DataFrame) -> DataFrame:
    """Row ids that increase in file order (partition index in the high bits,
    position in the partition in the low bits). Increasing, not contiguous;
    only the order is used."""
    return df.withColumn("row_id", F.monotonically_increasing_id())


# --- S6: single-column list ------------------------------------------------

def read_single_column(spark: SparkSession, path: str, name: str = "value") -> DataFrame:
    """First column of a header-less CSV (the reference always reads column 0)."""
    return spark.read.option("header", "false").csv(path).select(F.col("_c0").alias(name))
