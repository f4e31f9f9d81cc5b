"""lodestar: Spark DataFrame jobs for link crawling and word indexing,
multi-criteria star-schema search, probabilistic record linkage and
categorical decision trees.

Every operator is a function from DataFrame(s) to a DataFrame; the work
is expressed with built-in Spark SQL expressions so Catalyst can push
filters and prune columns, and nothing on the row path runs in Python.
"""

__version__ = "0.1.0"
