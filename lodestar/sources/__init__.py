from lodestar.sources.tables import TABLE_SCHEMAS, load  # noqa: F401
