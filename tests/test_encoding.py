"""Encoded chunks, manifests, digests in levels and the one pass of a region build."""

import datetime as dt
import os
import random
import struct
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.config import ArchiveConfig
from gridloom.operators import archive, audit, encoding, levels
from gridloom.sources import raw

from .test_archive import files_and_rows_read

FIRST, DAYS, NY, NX = dt.date(1980, 2, 20), 40, 7, 9
CELLS = "t date, y int, x int, v float"


def bits(v):
    return struct.pack("<f", v)


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(9)
    odd = [0.0, -0.0, 1e-45, 3.4e38, float("inf"), 1.5, 0.1]
    return [(FIRST + dt.timedelta(k), y, x, draw.choice(odd)) for k in range(DAYS) for y in range(NY) for x in range(NX) if (k, y) != (3, 2) and draw.random() < 0.7]


@pytest.fixture(scope="module")
def config(spark, rows, tmp_path_factory):
    own = ArchiveConfig(download=str(tmp_path_factory.mktemp("enc")), version="V1.0", product="Past/Daily", variable="rain", ny=NY, nx=NX, chunks={"time": 4, "y": -1, "x": -1}, timesteps_per_commit=16)
    raw.write_days(spark, own, spark.createDataFrame(rows, CELLS))
    return own


@pytest.fixture(scope="module")
def series(config):
    return replace(config, suffix="temporal", chunks={"time": -1, "y": 2, "x": 4}, write_strategy="region", block_shape={"y": 4, "x": 8})


@pytest.fixture(scope="module")
def built(spark, config):
    return archive.build(spark, config)


@pytest.fixture(scope="module")
def sibling(spark, series):
    return archive.build(spark, series)


def held(df):
    return sorted((r["t"], r["y"], r["x"], bits(r["v"])) for r in df.collect())


def test_cells_return_bit_for_bit(rows, built, sibling):
    wanted = sorted((t, y, x, bits(v)) for t, y, x, v in rows)
    assert held(built.read()) == wanted and held(sibling.read()) == wanted


def test_boxes_of_both_layouts(rows, built, sibling):
    t0, t1 = FIRST + dt.timedelta(3), FIRST + dt.timedelta(21)
    wanted = sorted((t, y, x, bits(v)) for t, y, x, v in rows if t0 <= t < t1 and 1 <= y < 6 and 3 <= x < 5)
    for store in (built, sibling):
        assert held(store.read(t0=t0, t1=t1, y=(1, 6), x=(3, 5))) == wanted


@pytest.mark.parametrize("share", [0.0, 0.01, 0.5, 1.0])
def test_a_piece_of_any_fill_is_decoded(share):
    draw = np.random.default_rng(1)
    values = draw.gamma(0.5, 4, 1003).astype("<f4")
    values[draw.random(1003) >= share] = np.nan
    valid, payload = encoding.encoded(values)
    places, own = encoding.decoded(valid, payload, int((~np.isnan(values)).sum()), 1003)
    back = np.full(1003, np.nan, "<f4")
    back[places] = own
    assert back.tobytes() == values.tobytes() or (np.isnan(back) == np.isnan(values)).all() and (back[places] == values[places]).all()


def test_places_are_packed_whole_or_by_steps():
    for places in (np.arange(5, 90), np.array([0]), np.array([7]), np.array([0, 3, 4, 1000])):
        assert encoding.unpack_places(encoding.pack_places(places.astype("<i4")), len(places)).tolist() == places.tolist()


def test_sizes_are_those_stored(built, sibling):
    """The manifest's bytes are the lengths of what lies in the files."""
    for store in (built, sibling):
        stored = store.pieces().groupBy("tc", "ty", "tx").agg(F.sum(F.length("valid") + F.length("payload")).alias("n_bytes"), F.sum("n_cells").alias("n_cells"))
        assert stored.select("tc", "ty", "tx", "n_cells", "n_bytes").exceptAll(store.manifest()).isEmpty()
        assert stored.count() == store.manifest().count()


def test_the_manifest_opens_no_data(built, sibling, rows):
    for store in (built, sibling):
        n_data = len([f for _, _, fs in os.walk(f"{store.path}/data") for f in fs if f.endswith(".parquet")])
        n_manifest = len([f for _, _, fs in os.walk(f"{store.path}/manifest") for f in fs if f.endswith(".parquet")])
        assert n_data and files_and_rows_read(store.manifest_rows())["numFiles"] == n_manifest
        assert not any("/data/" in f for f in store.manifest_rows().inputFiles())
        assert store.manifest().agg(F.sum("n_cells")).first()[0] == len(rows)
        assert audit.unlike_manifest(store).isEmpty()


def test_a_manifest_that_lies_is_found(spark, config, tmp_path):
    store = archive.build(spark, replace(config, filename="{suffix}/lie"))
    where = next(r["folder"] for r in store.history().collect() if r["folder"])
    path = f"{store.path}/manifest/{where.split('/')[-1]}"
    wrong = spark.read.parquet(path).withColumn("v_max", F.lit(7.0).cast("float"))
    wrong.write.parquet(str(tmp_path / "m"))
    spark.read.parquet(str(tmp_path / "m")).write.mode("overwrite").parquet(path)
    assert not audit.unlike_manifest(store).isEmpty()
    assert "the manifest is what the chunks hold" in {r["label"] for r in audit.audit(store, config, raw.raw_cells(spark, config), ["sweep"]).collect() if not r["ok"]}


def test_one_cell_is_found_by_levels(spark, rows, series, built, sibling):
    """One changed cell of the sibling is named, and only pieces of its span and row are opened."""
    assert levels.different_cells(built, sibling).isEmpty()
    t, y, x, v = next(r for r in rows if r[3] == 1.5)
    own = replace(series, download=series.download + "-other")
    raw.write_days(spark, own, spark.createDataFrame([(*r[:3], 2.5) if r == (t, y, x, v) else r for r in rows], CELLS))
    other = archive.build(spark, own)
    assert [tuple(r) for r in levels.different_cells(built, other).collect()] == [(t, y, x, 1.5, 2.5)]
    assert levels.differing(built, other, "rows") == [y] and len(levels.differing(built, other, "spans")) == 1
    opened = other.pieces(y=(y, y + 1)).count()
    assert opened < other.pieces().count()


def test_days_by_the_manifest(built, sibling, rows):
    counts = {}
    for t, *_ in rows:
        counts[t] = counts.get(t, 0) + 1
    for store in (built, sibling):
        assert {r["t"]: r["n"] for r in levels.by_day(store).collect()} == counts
    a, b = ({(r["t"], r["footprint"]) for r in levels.by_day(s).collect()} for s in (built, sibling))
    assert a == b


def test_a_region_build_reads_the_raw_once(spark, series, rows, monkeypatch):
    """Four blocks, one pass; after a crash behind any block the rest is built though the raw can no longer be read."""
    own = replace(series, filename="{suffix}/once")
    asked, whole = [], raw.raw_contents
    monkeypatch.setattr(raw, "raw_contents", lambda s, c, paths: (asked.append(len(paths)), whole(s, c, paths))[1])
    for _ in range(4):
        archive.build(spark, own, stop_after=1)
    store = archive.build(spark, own)
    assert asked == [DAYS]
    assert store.history().where("kind = 'build'").count() == 4 and not store.has("staging")
    assert held(store.read()) == sorted((t, y, x, bits(v)) for t, y, x, v in rows)


def test_what_was_staged_of_other_files_is_not_used(spark, series, rows):
    own = replace(series, download=series.download + "-more", filename="{suffix}/again")
    raw.write_days(spark, own, spark.createDataFrame(rows, CELLS))
    archive.build(spark, own, stop_after=1)
    changed = [(t, y, x, 9.0 if y >= 4 else v) for t, y, x, v in rows]
    raw.write_days(spark, own, spark.createDataFrame(changed, CELLS))  # the first block has rows 0 to 3 and columns 0 to 7
    store = archive.build(spark, own)
    assert held(store.read(y=(4, NY))) == sorted((t, y, x, bits(v)) for t, y, x, v in changed if y >= 4)


def test_cells_out_of_the_grid_and_cells_twice_are_refused(spark, built):
    shape = built.shape()
    for bad, said in (([(FIRST, NY, 0, 1.0)], "outside"), ([(FIRST, 0, 0, 1.0), (FIRST, 0, 0, 2.0)], "twice")):
        with pytest.raises(Exception, match=said):
            encoding.gathered(encoding.scattered(spark.createDataFrame(bad, CELLS), shape), shape).collect()
    nothing = spark.createDataFrame([(FIRST, 0, 0, float("nan"))], CELLS)
    assert encoding.gathered(encoding.scattered(nothing, shape), shape).count() == 0
