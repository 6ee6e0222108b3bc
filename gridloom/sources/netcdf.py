"""Gridded netCDF files as Python data sources: hyperslabs of a variable, and attributes; need the netCDF4 module on the
executors."""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

BAND_ROWS = 200


class Slab(InputPartition):
    """Rows y0 to y1 and columns x0 to x1 of one file; x1 is None for all columns."""

    def __init__(self, path: str, y: tuple[int, int], x: tuple[int, int | None]):
        super().__init__((path, y, x))
        self.path, self.y, self.x = path, y, x


class NetcdfSource(DataSource):
    """``spark.read.format("gridloom_netcdf").option("paths", "a.nc,b.nc").option("variable", "v").option("rows", ny).load()``:
    a task for each file and band of ``band`` rows. The options y0, y1, x0, x1 are a half-open box: bands outside are no
    tasks, of others only the box is read. (Filters are not pushed: in Spark 4.1 what one query pushes to a Python source
    stays for the next query of the same DataFrame, which then loses rows.)"""

    @classmethod
    def name(cls) -> str:
        return "gridloom_netcdf"

    def schema(self) -> str:
        return "path string, k int, y int, x int, v float"

    def reader(self, schema):
        of, rows = self.options, int(self.options["rows"])
        box = [int(of[k]) if k in of else default for k, default in (("y0", 0), ("y1", rows), ("x0", 0), ("x1", None))]
        return NetcdfReader(of["paths"].split(","), of["variable"], rows, int(of.get("band", BAND_ROWS)), tuple(box[:2]), tuple(box[2:]))


class NetcdfReader(DataSourceReader):
    def __init__(self, paths: list[str], variable: str, rows: int, band: int, y: tuple[int, int], x: tuple[int, int | None]):
        self.paths, self.variable, self.rows, self.band, self.y, self.x = paths, variable, rows, band, y, x

    def partitions(self):
        slabs = []
        for y0 in range(0, self.rows, self.band):
            y = (max(y0, self.y[0]), min(y0 + self.band, self.rows, self.y[1]))
            if y[0] < y[1] and (self.x[1] is None or self.x[0] < self.x[1]):
                slabs += [Slab(p, y, self.x) for p in self.paths]
        return slabs

    def read(self, partition) -> Iterator:
        import netCDF4
        import numpy as np
        import pyarrow as pa

        if partition is None:  # there are no slabs
            return
        with netCDF4.Dataset(partition.path) as f:
            f.set_auto_maskandscale(False)
            variable = f[self.variable]
            (y0, y1), (x0, x1) = partition.y, partition.x
            for k in range(variable.shape[0]):
                values = np.asarray(variable[k, y0:y1, x0:x1], np.float32)
                y, x = (a.ravel().astype(np.int32) for a in np.indices(values.shape))
                n = values.size
                yield pa.RecordBatch.from_arrays(
                    [pa.array([partition.path] * n), pa.array(np.full(n, k, np.int32)), pa.array(y + np.int32(y0)), pa.array(x + np.int32(x0)), pa.array(values.ravel())], ["path", "k", "y", "x", "v"]
                )


class NetcdfAttributes(DataSource):
    """(path, owner, key, value): of each file its own attributes (owner "") and the variable's, and how the variable is
    encoded (owner ``variable:encoding``); values as JSON. No cell is read."""

    @classmethod
    def name(cls) -> str:
        return "gridloom_netcdf_attributes"

    def schema(self) -> str:
        return "path string, owner string, key string, value string"

    def reader(self, schema):
        return AttributeReader(self.options["paths"].split(","), self.options["variable"])


class AttributeReader(DataSourceReader):
    def __init__(self, paths: list[str], variable: str):
        self.paths, self.variable = paths, variable

    def partitions(self):
        return [InputPartition(p) for p in self.paths]

    def read(self, partition):
        import netCDF4

        plain = lambda v: json.dumps(v.tolist() if hasattr(v, "tolist") else v)
        with netCDF4.Dataset(partition.value) as f:
            variable = f[self.variable]
            encoding = {"dtype": str(variable.dtype), "chunks": variable.chunking(), **(variable.filters() or {})}
            for owner, found in (("", {k: f.getncattr(k) for k in f.ncattrs()}), (self.variable, {k: variable.getncattr(k) for k in variable.ncattrs()}), (f"{self.variable}:encoding", encoding)):
                for key, value in found.items():
                    yield partition.value, owner, key, plain(value)
