"""Attributes, names and evidence as small tables: differences, merges, look-ups, totals of checks, history."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def difference(current: DataFrame, wanted: DataFrame) -> DataFrame:
    """(key, before, after, change) of attribute tables (key, value): add, replace, same, or keep where only current has it."""
    a = current.select("key", F.col("value").alias("before"), F.lit(True).alias("_a"))
    b = wanted.select("key", F.col("value").alias("after"), F.lit(True).alias("_b"))
    change = (
        F.when(F.col("_a").isNull(), "add").when(F.col("_b").isNull(), "keep")
        .when(F.col("before").eqNullSafe(F.col("after")), "same").otherwise("replace")
    )
    return a.join(b, "key", "full_outer").select("key", "before", "after", change.alias("change"))


def disagreements(left: DataFrame, right: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """(key, left_value, right_value) where two stores' attributes differ, but for those that belong to a layout."""
    both = left.select("key", F.col("value").alias("left_value")).join(right.select("key", F.col("value").alias("right_value")), "key", "full_outer")
    return both.where(~F.col("key").isin(*exclude) & ~F.col("left_value").eqNullSafe(F.col("right_value")))


def look_up(names: DataFrame, key: DataFrame) -> DataFrame:
    """(original, canonical, known) of names by a key table."""
    return names.join(key, "original", "left").select("original", "canonical", F.col("canonical").isNotNull().alias("known"))


def coverage(cube: DataFrame) -> DataFrame:
    """One row of coverage attributes, read off the data."""
    span = F.concat(F.lit("P"), (F.datediff(F.max("t"), F.min("t")) + 1).cast("string"), F.lit("D"))
    return cube.agg(
        F.min("t").cast("string").alias("time_coverage_start"), F.max("t").cast("string").alias("time_coverage_end"),
        F.lit("P1D").alias("time_coverage_resolution"), span.alias("time_coverage_duration"),
        F.min("y").alias("y_min"), F.max("y").alias("y_max"), F.min("x").alias("x_min"), F.max("x").alias("x_max"),
    )


def placed(first_day, n_days: int, ny: int, nx: int, lat: tuple[float, float], lon: tuple[float, float]) -> dict[str, object]:
    """Coverage attributes of an axis and a grid, by their numbers: days, and cell centres rounded to 4 places."""
    last = first_day + dt.timedelta(n_days - 1)
    ends = lambda first, step, n: sorted((round(first, 4), round(first + step * (n - 1), 4)))
    (south, north), (west, east) = ends(*lat, ny), ends(*lon, nx)
    return {
        "time_coverage_start": str(first_day), "time_coverage_end": str(last), "time_coverage_resolution": "P1D", "time_coverage_duration": f"P{n_days}D",
        "geospatial_lat_min": south, "geospatial_lat_max": north, "geospatial_lat_resolution": round(abs(lat[1]), 4),
        "geospatial_lon_min": west, "geospatial_lon_max": east, "geospatial_lon_resolution": round(abs(lon[1]), 4),
    }


def totals(checks: DataFrame, by: Sequence[str]) -> DataFrame:
    return checks.groupBy(*by).agg(F.count("*").alias("n_checks"), F.count_if(~F.col("ok")).alias("n_failures"))


def latest_evidence(checks: DataFrame, phases: int) -> DataFrame:
    """(log, run, n_checks): of each log the last run without a failure that has so many phases."""
    runs = checks.groupBy("log", "run").agg(F.count("*").alias("n_checks"), F.count_if(~F.col("ok")).alias("n_failures"), F.count_distinct("phase").alias("n_phases"))
    good = runs.where((F.col("n_failures") == 0) & (F.col("n_phases") >= phases))
    last = F.row_number().over(Window.partitionBy("log").orderBy(F.desc("run")))
    return good.withColumn("_r", last).where("_r = 1").select("log", "run", "n_checks")


def builds(commits: DataFrame, by: Sequence[str], admin: Sequence[str]) -> DataFrame:
    """First and last build commit and their number, administrative commits left out."""
    return commits.where(~F.col("kind").isin(*admin)).groupBy(*by).agg(
        F.min("written_at").alias("first_build"), F.max("written_at").alias("last_build"), F.count("*").alias("n_builds")
    )
