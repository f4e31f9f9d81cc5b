"""Sinks: pipe-delimited index (S7), pair labels (S8), distinct lists.

All write through the DataFrame writer, so each task writes its own part
file; nothing is gathered on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_index(index: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Rows ``id|word``, no header."""
    (index.select("id", "word").write.mode(mode)
     .option("sep", "|").option("header", "false").csv(path))


def write_pair_labels(pairs: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Rows ``left index,right index,label``, then any further columns, no header."""
    first = ["zindex", "findex", "label"]
    (pairs.select(*first, *[c for c in pairs.columns if c not in first]).write.mode(mode)
     .option("header", "false").csv(path))


def write_distinct_list(df: DataFrame, column: str, path: str, mode: str = "overwrite") -> None:
    """The distinct values of one column, one per line."""
    (df.select(column).distinct().write.mode(mode)
     .option("sep", "|").option("header", "false").csv(path))
