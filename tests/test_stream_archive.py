"""A stream of raw files into an archive: crashes, replays, late days."""

import datetime as dt
import shutil

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from gridloom.config import ArchiveConfig
from gridloom.operators import archive, audit
from gridloom.sources import raw
from gridloom.streaming import ingest

FIRST, NY, NX = dt.date(1999, 12, 28), 3, 2
MISSING = FIRST + dt.timedelta(4)


def config_of(root):
    return ArchiveConfig(
        download=str(root), version="V1.0", product="NRT/Daily", variable="rain", ny=NY, nx=NX, chunks={"time": 2, "y": -1, "x": -1}, timesteps_per_commit=2, expected_missing_times=(str(MISSING),))


def put(config, *numbers):
    import os

    os.makedirs(config.raw_dir, exist_ok=True)
    for k in numbers:
        y, x = [i // NX for i in range(NY * NX)], [i % NX for i in range(NY * NX)]
        v = [-9999.0 if i == 0 else float(k * 10 + i) for i in range(NY * NX)]
        pq.write_table(pa.table({"y": pa.array(y, pa.int32()), "x": pa.array(x, pa.int32()), "rain": pa.array(v, pa.float32())}), f"{config.raw_dir}/{FIRST + dt.timedelta(k):%Y%j}.parquet")


def stored(store):
    return sorted((r["t"], r["y"], r["x"], r["v"]) for r in store.read().collect())


def wanted(*numbers):
    return sorted((FIRST + dt.timedelta(k), i // NX, i % NX, float(k * 10 + i)) for k in numbers for i in range(1, NY * NX))


def test_days_wait_for_those_before_them_and_a_crash_adds_nothing(spark, tmp_path, monkeypatch):
    config, state = config_of(tmp_path), str(tmp_path / "state")
    put(config, 0, 1, 3)
    store = ingest.ingest_archive(spark, config, state)
    assert stored(store) == wanted(0, 1)  # day 3 waits for day 2
    put(config, 2, 5)
    whole, calls = archive.Archive.commit, []

    def lost(self, *args, **named):
        calls.append(1)
        raise RuntimeError("lost between data and commit")

    monkeypatch.setattr(archive.Archive, "commit", lost)
    with pytest.raises(Exception, match="lost"):
        ingest.ingest_archive(spark, config, state)
    monkeypatch.setattr(archive.Archive, "commit", whole)
    assert calls and stored(archive.Archive(spark, config.store_path)) == wanted(0, 1)
    store = ingest.ingest_archive(spark, config, state)
    assert stored(store) == wanted(0, 1, 2, 3, 5) and store.axis().count() == 6  # day 4 is declared missing
    batches = [r["batch"] for r in store.history().where("batch is not null").collect()]
    ingest.add_batch(spark, config, spark.createDataFrame([(FIRST, 0, 0, 1.0)], ingest.CELLS), max(batches), None)  # a replay
    assert stored(store) == wanted(0, 1, 2, 3, 5)
    archive.write_attributes(store, archive.derived_attributes(store, config) | {"layout": config.suffix})
    found = audit.audit(store, config, raw.raw_cells(spark, config), ["index", "samples", "sweep", "sentinel"], n=3, days=4).collect()
    assert all(r["ok"] for r in found), [r for r in found if not r["ok"]]


def test_late_days_and_gaps_are_refused_by_name(spark, tmp_path):
    config, state = config_of(tmp_path), str(tmp_path / "state")
    put(config, 1, 2, 3)
    store = ingest.ingest_archive(spark, config, state)
    assert stored(store) == wanted(1, 2)
    closed = ingest.close_stream(spark, config)
    assert stored(closed) == wanted(1, 2, 3)
    put(config, 0)
    with pytest.raises(Exception, match=str(FIRST)):
        ingest.ingest_archive(spark, config, state)
    gap = config_of(tmp_path / "gap")
    put(gap, 0, 1, 7)
    ingest.ingest_archive(spark, gap, str(tmp_path / "gapstate"))
    with pytest.raises(ValueError, match=str(FIRST + dt.timedelta(7))):
        ingest.close_stream(spark, gap)
    shutil.rmtree(tmp_path / "gap")
