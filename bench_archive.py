"""Times an archive of $BENCH_DAYS days on the full 1800 x 3600 grid in both layouts, on local[$BENCH_CPUS]: builds in
two commits or blocks, then a day map and a point series. The fields are made up; prints one JSON line."""

import datetime as dt
import json
import os
import tempfile
import time
from dataclasses import replace
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import SparkSession

from gridloom.config import ArchiveConfig
from gridloom.operators import archive

NY, NX, FIRST = 1800, 3600, dt.date(1979, 1, 1)


def write_raw(folder: Path, days: int) -> None:
    """Day files in order of rows and columns, a third of the cells fill."""
    folder.mkdir(parents=True)
    y, x = np.divmod(np.arange(NY * NX, dtype=np.int32), np.int32(NX))
    for k in range(days):
        rain = np.random.default_rng(k).gamma(0.5, 4, NY * NX).astype(np.float32).round(2)
        rain[y % 3 == 0] = -9999.0
        name = f"{FIRST + dt.timedelta(k):%Y%j}.parquet"
        pq.write_table(pa.table({"y": y, "x": x, "rain": rain}), folder / name, row_group_size=36 * NX)


def main() -> None:
    cpus, days = os.environ.get("BENCH_CPUS", "8"), int(os.environ.get("BENCH_DAYS", "16"))
    root = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench of archives")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "12g").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").config("spark.local.dir", root).getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    maps = ArchiveConfig(download=root, version="V1.0", product="Past/Daily", variable="rain", timesteps_per_commit=max(1, days // 2))
    series = replace(maps, suffix="temporal", chunks={"time": -1, "y": 100, "x": 100}, write_strategy="region", block_shape={"y": NY // 2, "x": -1})
    write_raw(Path(maps.raw_dir), days)
    took: dict[str, float] = {}

    def timed(name: str, work):
        began = time.perf_counter()
        result = work()
        took[name] = round(time.perf_counter() - began, 3)
        return result

    noop = lambda df: df.write.format("noop").mode("overwrite").save()
    for config in (maps, series):
        kind = config.write_strategy
        store = timed(f"{kind}_build", lambda: archive.build(spark, config))  # noqa: B023
        day = FIRST + dt.timedelta(days - 1)
        timed(f"{kind}_day_map", lambda: noop(store.read(t0=day, t1=day + dt.timedelta(1))))  # noqa: B023
        timed(f"{kind}_point_series", lambda: noop(store.read(y=(901, 902), x=(1801, 1802))))  # noqa: B023
    cells = days * NY * NX
    rate = {f"{k}_cells_a_second": round(cells / took[f"{k}_build"]) for k in ("append", "region")}
    print(json.dumps({"metric": "seconds for two builds and four reads", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "cells": cells} | rate))
    spark.stop()


if __name__ == "__main__":
    main()
