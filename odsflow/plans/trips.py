"""Vehicle trips and positions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odsflow.functions.measures import mean
from odsflow.functions.times import Moment, in_range, local_hour
from odsflow.plans.dashboards import top_groups

ZONE = "Asia/Ho_Chi_Minh"


def trip_columns(trips: DataFrame) -> DataFrame:
    """Trips with the derived columns of the report."""
    minutes = F.col("trip_duration_minutes")
    km = F.col("total_distance_km").cast("double")
    return trips.withColumns(
        {
            "is_completed": F.lit(True),
            "duration_minutes": minutes,
            "avg_speed": F.when(minutes > 0, F.lit(60.0) * km / minutes).otherwise(F.lit(0.0)),
            "hour_vn": local_hour("start_time", ZONE),
        }
    )


def point_columns(points: DataFrame) -> DataFrame:
    """Positions with the hour under the name the report uses."""
    return points.withColumn("hour_vn", F.col("hour"))


def choose(
    df: DataFrame, routes: Sequence[str] = (), start: Moment | None = None, end: Moment | None = None
) -> DataFrame:
    """Report filters: any of the routes (all when none is chosen) and a date range."""
    if routes:
        df = df.where(F.col("route_no").isin(*routes))
    return in_range(df, "date", start, end)


def trip_figures(trips: DataFrame) -> DataFrame:
    return trips.agg(
        F.count("trip_id").alias("trips"),
        F.countDistinct("route_no").alias("active_routes"),
        F.countDistinct("vehicle").alias("active_vehicles"),
        F.sum("total_distance_km").alias("total_km"),
        mean("trip_duration_minutes").alias("avg_minutes"),
    )


def trips_by(trips: DataFrame, key: str) -> DataFrame:
    """Trips by route, direction or local hour."""
    return trips.groupBy(key).agg(F.count("trip_id").alias("trips")).orderBy(F.desc("trips"), key)


def _moving(points: DataFrame) -> DataFrame:
    return points.where(F.col("speed") > 0)


def average_speed(points: DataFrame) -> DataFrame:
    return _moving(points).agg(mean("speed").alias("avg_speed"))


def speed_by(points: DataFrame, *keys: str) -> DataFrame:
    """Average speed of moving vehicles by route, or by hour and day type."""
    return _moving(points).groupBy(*keys).agg(mean("speed").alias("avg_speed")).orderBy(*keys)


def points_by_speed_level(points: DataFrame, rows: int = 100) -> DataFrame:
    counted = points.groupBy("speed_level").agg(F.count(F.lit(1)).alias("points"))
    return top_groups(counted, ["speed_level"], "points", rows)


def map_points(points: DataFrame, rows: int = 15000) -> DataFrame:
    """Places on the map with the highest speed seen there."""
    keys = ["y", "x", "speed_level"]
    placed = points.where(F.col("x").isNotNull() & F.col("y").isNotNull() & F.col("speed").isNotNull())
    return top_groups(placed.groupBy(*keys).agg(F.max("speed").alias("max_speed")), keys, "max_speed", rows)


TRIP_DETAIL = (
    "date",
    "vehicle",
    "route_no",
    "direction",
    "start_time",
    "end_time",
    "trip_duration_minutes",
    "total_distance_km",
    "confidence_score",
)


def trip_details(trips: DataFrame, rows: int = 5000) -> DataFrame:
    """Distinct trips in column order."""
    return trips.select(*TRIP_DETAIL).distinct().orderBy(*TRIP_DETAIL).limit(rows)
