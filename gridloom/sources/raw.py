"""Raw files, one a day: their listing, their cells, and cells read apart from the build for the audit."""

from __future__ import annotations

import datetime as dt
import json
from multiprocessing.pool import ThreadPool

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..config import FORMATS, ArchiveConfig
from ..functions.cells import NAN
from ..functions.naming import day_of_checked_stamp, day_of_stamp, stamp_of
from ..functions.tables import small_table
from ..operators.axis import complete_axis

#: For a folder that is read only once its job has ended: tasks move their own files, not the driver one by one.
BY_TASKS = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}


def listing(spark: SparkSession, config: ArchiveConfig) -> list[Row]:
    """(t, path, n_bytes, modified), by time, a name a day, of one listing. If there are year folders, only their files count;
    a name that is no stamp is passed over, one whose stamp is no date is refused."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", FORMATS[config.raw_format]).load(config.raw_dir)
    listed = found.select("path", F.col("length").alias("n_bytes"), F.unix_millis("modificationTime").alias("modified"))
    name = F.element_at(F.split("path", "/"), -1)
    folder = F.element_at(F.split("path", "/"), -2)
    named = listed.select("*", F.regexp_extract(name, config.file_pattern, 1).alias("stamp"), folder.rlike(r"^\d{4}$").alias("in_year")).where("stamp <> ''")
    dated = named.select(day_of_stamp(F.col("stamp")).alias("t"), "path", "n_bytes", "modified", "in_year")
    rows = dated.coalesce(2 * spark.sparkContext.defaultParallelism).collect()
    any_year = any(r["in_year"] for r in rows)
    files = [r for r in rows if r["in_year"] or not any_year]
    wrong = [r["path"] for r in files if r["t"] is None]
    if wrong:
        raise ValueError(f"names that are no date: {wrong[:3]}")
    return sorted(files, key=lambda r: (r["t"], r["path"]))


def raw_files(spark: SparkSession, config: ArchiveConfig) -> DataFrame:
    """(t, path) of `listing`."""
    return small_table(spark, [(r["t"], r["path"]) for r in listing(spark, config)], "t date, path string")


def raw_index(files: DataFrame) -> DataFrame:
    """(t, path) of the complete axis; a day without a file has a null path."""
    return complete_axis(files).join(files, "t", "left")


def raw_cells(spark: SparkSession, config: ArchiveConfig, paths: list[str] | None = None, y: tuple[int, int] | None = None, x: tuple[int, int] | None = None) -> DataFrame:
    """(t, y, x, v float) of ``paths``, or of all files that `raw_files` lists, undecoded: fill values stand as
    published. Only the files named are opened; their names must be such as `raw_files` lists. Of a half-open box only
    its slabs or row groups are read."""
    if paths is None:
        paths = [r["path"] for r in listing(spark, config)]
    if config.raw_format == "netcdf":
        from .netcdf import NetcdfSource

        spark.dataSource.register(NetcdfSource)
        files = spark.read.format(NetcdfSource.name()).option("paths", ",".join(paths)).option("variable", config.variable).option("rows", config.ny)
        for name, box in (("y", y), ("x", x)):
            files = files.option(f"{name}0", box[0]).option(f"{name}1", box[1]) if box else files
        files = files.load()
        name, value = F.element_at(F.split("path", "/"), -1), F.col("v")
    else:
        files = spark.read.parquet(*paths)
        if config.variable not in files.columns:
            raise ValueError(f"the raw files have {files.columns}, not {config.variable!r}")
        name, value = F.col("_metadata.file_name"), F.col(config.variable)
    for column, box in (("y", y), ("x", x)):
        files = files.where((F.col(column) >= box[0]) & (F.col(column) < box[1])) if box else files
    return files.select(day_of_checked_stamp(name).alias("t"), "y", "x", value.cast("float").alias("v"))


def source_attributes(spark: SparkSession, config: ArchiveConfig, path: str) -> tuple[dict, dict]:
    """(attributes of a raw netCDF file, attributes and encoding of its variable), read off the file."""
    from .netcdf import NetcdfAttributes

    spark.dataSource.register(NetcdfAttributes)
    rows = spark.read.format(NetcdfAttributes.name()).option("paths", path).option("variable", config.variable).load().collect()  # of one file
    of = lambda *owners: {r["key"]: json.loads(r["value"]) for r in rows if r["owner"] in owners}
    return of(""), of(f"{config.variable}:encoding", config.variable)


def raw_contents(spark: SparkSession, config: ArchiveConfig, paths: list[str]) -> DataFrame:
    """(stamp, content) of raw Parquet files, a file a row: what reads them decodes them to arrays. A day is a file, so
    a row is as large as a day's plane. Their folders are listed, not each file looked up; a day has one file, so its name
    alone tells it."""
    folders, names = zip(*(p.rsplit("/", 1) for p in paths), strict=True)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "{" + ",".join(sorted(names)) + "}").load(sorted(set(folders)))
    return files.select(F.regexp_extract("path", r"([0-9]{7})\.parquet$", 1).alias("stamp"), "content")


def write_days(spark: SparkSession, config: ArchiveConfig, cells: DataFrame) -> list[dt.date]:
    """Write cells (t, y, x, v) as raw files, one a day, named as `raw_files` lists them; returns the days. A day's cells
    are sorted by place, so that row groups have ranges of rows."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(f"{config.raw_dir}/_new")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    again = files.exists(hadoop.Path(config.raw_dir))
    named = cells.select(stamp_of(F.col("t")).alias("stamp"), "y", "x", F.col("v").cast("float").alias(config.variable))
    named.repartition("stamp").sortWithinPartitions("stamp", "y", "x").write.mode("overwrite").options(**BY_TASKS).partitionBy("stamp").parquet(folder.toString())

    def move(stamp: str) -> dt.date:
        own = hadoop.Path(f"{config.raw_dir}/{stamp}.parquet")
        for one in files.listStatus(hadoop.Path(f"{folder.toString()}/stamp={stamp}")):
            if one.getPath().getName().endswith(".parquet"):
                if again:
                    files.delete(own, False)
                if not files.rename(one.getPath(), own):
                    raise OSError(f"could not move {own.toString()}")
        return dt.datetime.strptime(stamp, "%Y%j").date()

    names = [part.getPath().getName() for part in files.listStatus(folder)]
    with ThreadPool(8) as pool:
        days = pool.map(move, [name.split("=")[1] for name in names if name.startswith("stamp=")])
    files.delete(folder, True)
    return sorted(days)


def raw_box(cells: DataFrame, axis: DataFrame, t0, t1, y: tuple[int, int], x: tuple[int, int]) -> DataFrame:
    """Cells of a half-open box on the axis: a day without a file is a plane of NaN. Nothing is masked."""
    days = axis.where((F.col("t") >= t0) & (F.col("t") < t1))
    plane = days.select("t", F.explode(F.sequence(F.lit(y[0]), F.lit(y[1] - 1))).alias("y")).select("t", "y", F.explode(F.sequence(F.lit(x[0]), F.lit(x[1] - 1))).alias("x"))
    own = cells.where((F.col("t") >= t0) & (F.col("t") < t1) & F.col("y").between(y[0], y[1] - 1) & F.col("x").between(x[0], x[1] - 1))
    return plane.join(own, ["t", "y", "x"], "left").withColumn("v", F.coalesce("v", F.lit(NAN).cast("float")))
