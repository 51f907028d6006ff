"""Web-Mercator (EPSG:3857) to and from longitude/latitude (EPSG:4326)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EARTH_RADIUS = 6378137.0
WEB_MERCATOR, LON_LAT = "EPSG:3857", "EPSG:4326"


def longitude(x: Column) -> Column:
    return F.degrees(x / EARTH_RADIUS)


def latitude(y: Column) -> Column:
    return F.degrees(2 * F.atan(F.exp(y / EARTH_RADIUS)) - F.pi() / 2)


def project_points(points: DataFrame, x: str = "x", y: str = "y", crs: str = "crs") -> DataFrame:
    """Project the rows labelled Web-Mercator; others are already lon/lat and stay as they are."""
    planar = F.coalesce(F.col(crs), F.lit(WEB_MERCATOR)) == WEB_MERCATOR
    return points.withColumns(
        {
            x: F.when(planar, longitude(F.col(x))).otherwise(F.col(x)),
            y: F.when(planar, latitude(F.col(y))).otherwise(F.col(y)),
            crs: F.when(planar, F.lit(LON_LAT)).otherwise(F.col(crs)),
        }
    )


def set_crs(points: DataFrame, label: str, crs: str = "crs") -> DataFrame:
    return points.withColumn(crs, F.lit(label))
