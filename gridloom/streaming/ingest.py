"""Raw files as a stream: each new day file becomes a micro-batch of a daily table, exactly once."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ArchiveConfig
from ..functions.cells import fill_values, mask_fill
from ..functions.naming import day_of_stamp
from ..functions.tables import small_table
from ..operators import archive
from ..operators.axis import Bounds, CoverageError
from ..operators.encoding import Shape, scattered


def ingest_days(spark: SparkSession, raw_dir: str, variable: str, target: str, checkpoint: str, files_per_batch: int = 100):
    """Read what is new under ``raw_dir``, write it by batch to ``target``/batch=N, and end when all is read.

    A batch that is tried again overwrites its own folder, so a restart neither loses nor doubles a day.
    """
    schema = f"y int, x int, {variable} float"
    stream = (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).option("recursiveFileLookup", "true").parquet(raw_dir)
        .select(day_of_stamp(F.regexp_extract("_metadata.file_name", r"^(\d{7})\.parquet$", 1)).alias("t"), "y", "x", F.col(variable).alias("v"))
        .where("t is not null")
    )

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")

    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.parquet(target).drop("batch")


def ingest_archive(spark: SparkSession, config: ArchiveConfig, checkpoint: str, files_per_batch: int = 100, first_day: dt.date | None = None) -> archive.Archive:
    """Read what raw files are new, as micro-batches, into an archive that is written by days; end when all is read.

    Each micro-batch completes what whole commits of days it can, in the order of days, and holds back the rest: days
    that a later one must come before, and those that fill no commit yet. Data and what is held are written first, the
    commit row last; it carries the batch's number. So a batch that is tried again after a crash adds nothing twice: its
    row is there, or it starts from what the batch before held. A day that comes when its place in the archive is passed,
    or a second time, is refused by name. `close_stream` commits what is held at the end of a record.
    """
    if config.write_strategy != "append":
        raise ValueError("a stream is written by days")
    schema = f"y int, x int, {config.variable} float"
    stream = (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).option("recursiveFileLookup", "true").parquet(config.raw_dir)
        .select(day_of_stamp(F.regexp_extract("_metadata.file_name", config.file_pattern, 1)).alias("t"), "y", "x", F.col(config.variable).alias("v")).where("t is not null")
    )
    query = stream.writeStream.foreachBatch(lambda batch, number: add_batch(spark, config, batch, number, first_day)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return archive.Archive(spark, config.store_path)


CELLS = "t date, y int, x int, v float"


def held_cells(store: archive.Archive) -> tuple[DataFrame, int | None]:
    """What the last batch held back, undecoded, and that batch's number."""
    last = store.history().where("batch is not null").first()
    if last is None:
        return small_table(store.spark, [], CELLS), None
    return store.spark.read.schema(CELLS).parquet(f"{store.path}/held/{last['id']}"), last["batch"]


def add_batch(spark: SparkSession, config: ArchiveConfig, batch: DataFrame, number: int, first_day: dt.date | None) -> None:
    store = archive.Archive(spark, config.store_path, must_exist=False)
    held, last = held_cells(store)
    if last is not None and last >= number:
        return  # a replay of what is committed
    days_of = lambda df: sorted(r["t"] for r in df.select("t").distinct().collect())  # noqa: E731  days of one batch
    new, waiting = days_of(batch), days_of(held)
    end = store.axis().agg(F.max("t")).first()[0]
    start = end + dt.timedelta(1) if end else first_day or min([*new, *waiting], default=None)
    late = [str(d) for d in new if start and d < start or d in set(waiting)]
    if late:
        raise CoverageError(f"days that came late or twice: {late[:10]}")
    commit_held(store, config, held.unionByName(batch), {*new, *waiting}, start, number, whole_commits=True)


def close_stream(spark: SparkSession, config: ArchiveConfig) -> archive.Archive:
    """Commit the days that are held at the end of a record, though they fill no commit; days behind a gap that is not
    declared are refused by name."""
    store = archive.Archive(spark, config.store_path)
    held, last = held_cells(store)
    days = {r["t"] for r in held.select("t").distinct().collect()}
    end = store.axis().agg(F.max("t")).first()[0]
    if days:
        left = commit_held(store, config, held, days, end + dt.timedelta(1) if end else min(days), last, whole_commits=False)
        if left:
            raise CoverageError(f"days behind a gap that is not declared: {[str(d) for d in left[:10]]}")
    return store


def commit_held(store: archive.Archive, config: ArchiveConfig, cells: DataFrame, days: set, start: dt.date | None, number: int, whole_commits: bool) -> list[dt.date]:
    """Write the run of days from ``start`` on that are there or declared missing, as far as whole commits go; returns the
    days that are held."""
    declared = {dt.date.fromisoformat(x[:10]) for x in config.expected_missing_times}
    run, day = [], start
    while day is not None and (day in days or day in declared and day <= max(days)):
        run.append(day)
        day += dt.timedelta(1)
    n = len(run) // config.commit_days() * config.commit_days() if whole_commits else len(run)
    cut = run[n - 1] if n else None
    rest = cells.where(F.col("t") > F.lit(cut)) if cut else cells
    own = uuid.uuid4().hex  # the commit's id names what is held after it
    rest.write.parquet(f"{store.path}/held/{own}")
    if n:
        begin = store.spec() or archive.spec_of(config, Bounds(start, cut, n))
        shape, folder = Shape.of(begin), f"data/{own}"
        masked = cells.where(F.col("t") <= F.lit(cut)).withColumn("v", mask_fill(F.col("v"), fill_values(config.source_fill_values)))
        store.write(scattered(masked, shape), shape, folder)
        store.commit(f"write days {run[0]} to {cut}", "build", folder, (run[0], cut), (0, config.ny, 0, config.nx), None if store.spec() else begin, own, n, number)
    else:
        store.commit(f"hold {len(days)} days", "held", own=own, batch=number)
    for other in store.files.listStatus(store.hadoop("held")):  # of batches before, and of crashes
        if other.getPath().getName() != own:
            store.files.delete(other.getPath(), True)
    return sorted(d for d in days if cut is None or d > cut)
