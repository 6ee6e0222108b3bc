"""The netCDF sources against a stand-in for the netCDF4 module, which this box does not have."""

import datetime as dt
import os

import numpy as np
import pytest

from gridloom.config import ArchiveConfig
from gridloom.operators import archive
from gridloom.sources import raw
from gridloom.sources.netcdf import NetcdfReader

STAND_IN = '''
import numpy as np

class Variable:
    def __init__(self, path, values):
        self.path, self.values, self.shape, self.dtype = path, values, values.shape, values.dtype
    def __getitem__(self, key):
        found = self.values[key]
        with open(self.path + ".log", "a") as f:
            f.write(f"{found.size}\\n")
        return found
    def ncattrs(self): return ["units", "least_significant_digit"]
    def getncattr(self, k): return {"units": "mm/d", "least_significant_digit": np.int32(2)}[k]
    def chunking(self): return [1, 2, 3]
    def filters(self): return {"zlib": True}

class Dataset:
    def __init__(self, path): self.path = path.removeprefix("file:")
    def __enter__(self): return self
    def __exit__(self, *a): pass
    def set_auto_maskandscale(self, on): pass
    def __getitem__(self, name):
        with open(self.path, "rb") as f:
            return Variable(self.path, np.load(f))
    def ncattrs(self): return ["history"]
    def getncattr(self, k): return "made upstream"
'''
FIRST, DAYS, NY, NX = dt.date(2001, 3, 1), 3, 6, 5


@pytest.fixture(scope="module")
def config(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("nc")
    (root / "module").mkdir()
    (root / "module/netCDF4.py").write_text(STAND_IN)
    spark.sparkContext.addPyFile(str(root / "module/netCDF4.py"))
    own = ArchiveConfig(download=str(root), version="V1.0", product="Past/Daily", variable="rain", raw_format="netcdf", ny=NY, nx=NX, timesteps_per_commit=2)
    os.makedirs(own.raw_dir)
    for k in range(DAYS):
        with open(f"{own.raw_dir}/{FIRST + dt.timedelta(k):%Y%j}.nc", "wb") as f:
            np.save(f, (np.arange(NY * NX, dtype=np.float32) + 100 * k).reshape(1, NY, NX))
    return own


def test_a_box_reads_only_its_slabs(spark, config):
    path = f"{config.raw_dir}/{FIRST:%Y%j}.nc"
    box = raw.raw_cells(spark, config, [path], y=(1, 3), x=(4, 5))
    assert {(r["t"], r["y"], r["x"], r["v"]) for r in box.collect()} == {(FIRST, 1, 4, 9.0), (FIRST, 2, 4, 14.0)}
    with open(path + ".log") as f:
        assert [int(n) for n in f] == [2]  # two cells were read
    assert box.where("y > 17").count() == 0 and box.count() == 2 and box.where("y = 2").count() == 1
    assert raw.raw_cells(spark, config, [path], y=(6, 6)).count() == 0


def test_slabs_of_a_reader():
    reader = NetcdfReader(["a", "b"], "v", 5, 2, (1, 5), (0, None))
    assert [(s.path, s.y, s.x) for s in reader.partitions()][:3] == [("a", (1, 2), (0, None)), ("b", (1, 2), (0, None)), ("a", (2, 4), (0, None))]


def test_an_archive_of_netcdf_files_carries_what_they_say(spark, config):
    store = archive.build(spark, config)
    assert {(r["t"], r["y"], r["x"], r["v"]) for r in store.read().collect()} == {(FIRST + dt.timedelta(k), i // NX, i % NX, float(i + 100 * k)) for k in range(DAYS) for i in range(NY * NX)}
    got = {r["key"]: r["value"] for r in store.attributes().collect()}
    assert got["history"] == '"made upstream"' and got["rain:least_significant_digit"] == "2" and "rain:zlib" not in got
    assert raw.source_attributes(spark, config, f"{config.raw_dir}/{FIRST:%Y%j}.nc")[1]["units"] == "mm/d"
