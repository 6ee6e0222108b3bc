"""Archives that registered queries build of the given tables, in the folder that driver and executors share."""

from __future__ import annotations

import datetime as dt
import tempfile
import uuid
from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ArchiveConfig
from ..operators import archive
from ..sources import raw
from . import cubes

CHANGED_ROW = 7
DAYS_A_COMMIT, BLOCK_ROWS = 12, 20


def shared_dir(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return "file://" + tempfile.mkdtemp(prefix="gridloom-")


def event_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(t, y, x, v): a record of daily grids made of all events."""
    events = cubes.read(spark, sf_dir, "events")
    return events.groupBy(
        F.to_date("ts").alias("t"), (F.col("user_id") % cubes.NY).cast("int").alias("y"), (F.col("event_id") % cubes.NX).cast("int").alias("x")
    ).agg(cubes.exact_sum("value").cast("float").alias("v"))


EVENT_CUBE = f"""event_cube AS (
  SELECT CAST(ts AS DATE) AS t, CAST(user_id % {cubes.NY} AS INTEGER) AS y, CAST(event_id % {cubes.NX} AS INTEGER) AS x,
         CAST(CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS FLOAT) AS v FROM events GROUP BY 1, 2, 3),
first_day AS (SELECT min(t) AS d0, max(t) AS d1 FROM event_cube)"""


@dataclass
class Stores:
    """One record in both layouts, each build interrupted after its first commit and gone on with, and, for who asks for it,
    a third archive whose last day differs in one row."""

    maps: archive.Archive
    series: archive.Archive
    config: ArchiveConfig
    series_config: ArchiveConfig
    last: dt.date

    @cached_property
    def changed(self) -> archive.Archive:
        """Built of the raw files of the other two, so the events are not read again."""
        spark, other = self.maps.spark, replace(self.series_config, download=f"{self.config.download}/changed")
        differs = (F.col("t") == F.lit(self.last)) & (F.col("y") == CHANGED_ROW)
        raw.write_days(spark, other, raw.raw_cells(spark, self.config).withColumn("v", F.when(differs, F.col("v") + 1).otherwise(F.col("v")).cast("float")))
        return archive.build(spark, other)


_BUILT: dict[tuple[str, str], Stores] = {}


def stores(spark: SparkSession, sf_dir: str) -> Stores:
    """The archives of a session's tables, built when first asked for."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _BUILT:
        _BUILT[key] = build(spark, sf_dir)
    return _BUILT[key]


def build(spark: SparkSession, sf_dir: str) -> Stores:
    cube = event_cube(spark, sf_dir)
    root = f"{shared_dir(spark)}/archives-{uuid.uuid4().hex}"
    maps = ArchiveConfig(download=root, version="V1.0", product="Past/Daily", variable="value", ny=cubes.NY, nx=cubes.NX, timesteps_per_commit=DAYS_A_COMMIT)
    days = raw.write_days(spark, maps, cube)
    maps = replace(maps, expected_missing_times=tuple(gaps(days)))
    series = replace(maps, suffix="temporal", chunks={"time": -1, "y": cubes.EDGE, "x": cubes.EDGE}, write_strategy="region", block_shape={"y": BLOCK_ROWS, "x": -1})
    built = []
    for config in (maps, series):
        archive.build(spark, config, stop_after=1)
        built.append(archive.build(spark, config))
    return Stores(*built, maps, series, days[-1])


def gaps(days: list[dt.date]) -> list[str]:
    """Days between the first and the last that are not among ``days``; a date a day."""
    there = set(days)
    whole = [days[0] + dt.timedelta(i) for i in range((days[-1] - days[0]).days + 1)] if days else []
    return [str(d) for d in whole if d not in there]
