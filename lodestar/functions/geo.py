"""Great-circle distance (T11) and walking minutes (T12) as Columns, so the
computation stays in generated code instead of a per-row Python callback."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Earth radius in km used by the distance, and walking speed
# in metres per second used for minutes.
EARTH_RADIUS_KM = 6367.0
WALK_SPEED_M_PER_S = 1.1


def haversine_m(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Distance in metres between two (lon, lat) points in degrees."""
    rlon1, rlat1, rlon2, rlat2 = (F.radians(c) for c in (lon1, lat1, lon2, lat2))
    a = (F.pow(F.sin((rlat2 - rlat1) / 2), 2)
         + F.cos(rlat1) * F.cos(rlat2) * F.pow(F.sin((rlon2 - rlon1) / 2), 2))
    return F.lit(2.0) * F.asin(F.sqrt(a)) * F.lit(EARTH_RADIUS_KM * 1000.0)


def walking_minutes(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """ceil(metres / (speed * 60)) as int."""
    return F.ceil(haversine_m(lon1, lat1, lon2, lat2) / F.lit(WALK_SPEED_M_PER_S * 60.0)).cast("int")


def register_sql_functions(spark) -> None:
    """The same formula as SQL functions (``time_between``)."""
    r = EARTH_RADIUS_KM * 1000.0
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION haversine_m(lon1 DOUBLE, lat1 DOUBLE, lon2 DOUBLE, lat2 DOUBLE) "
        f"RETURNS DOUBLE RETURN 2.0 * asin(sqrt(pow(sin((radians(lat2) - radians(lat1)) / 2), 2) "
        f"+ cos(radians(lat1)) * cos(radians(lat2)) * pow(sin((radians(lon2) - radians(lon1)) / 2), 2))) * {r}")
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION time_between(lon1 DOUBLE, lat1 DOUBLE, lon2 DOUBLE, lat2 DOUBLE) "
        f"RETURNS INT RETURN CAST(ceil(haversine_m(lon1, lat1, lon2, lat2) / {WALK_SPEED_M_PER_S * 60.0}) AS INT)")
