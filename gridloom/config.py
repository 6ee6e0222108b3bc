"""What one archive is: its source, its axis, its layout, its attributes."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from .functions import naming

STRATEGIES = ("append", "region")
#: Of a source's encoding what says how its numbers were rounded.
CARRIED = ("least_significant_digit", "significant_digits", "quantization")
#: Spelling of what a file name's stamp stands for. Others are refused until someone has such files.
RESOLUTIONS = {"daily": r"^(\d{7})\.(?:parquet|nc)$"}
FORMATS = {"parquet": "*.parquet", "netcdf": "*.nc"}


@dataclass(frozen=True)
class ArchiveConfig:
    download: str
    version: str
    product: str
    variable: str
    filename: str = "{suffix}/archive.{version}.{period}.{frequency}.{grid_name}.{variable}"
    suffix: str = "spatial"
    grid_name: str = "native"
    raw: str | None = None
    raw_format: str = "parquet"
    ny: int = 1800
    nx: int = 3600
    #: Centres of the first row and column and the steps to the next, in degrees; rows go from north to south.
    lat: tuple[float, float] = (89.95, -0.1)
    lon: tuple[float, float] = (-179.95, 0.1)
    expected_missing_times: tuple[str, ...] = ()
    source_fill_values: tuple[float, ...] = ()
    chunks: Mapping[str, int] = field(default_factory=lambda: {"time": 1, "y": -1, "x": -1})
    write_strategy: str = "append"
    timesteps_per_commit: int = 100
    block_shape: Mapping[str, int] = field(default_factory=lambda: {"y": -1, "x": -1})
    attrs: Mapping[str, Any] = field(default_factory=dict)
    #: Attributes by variable; what the source's own files carry, as a whole and as the variable's encoding.
    variable_attrs: Mapping[str, Mapping[str, Any]] = field(default_factory=dict)
    source_attrs: Mapping[str, Any] = field(default_factory=dict)
    source_encoding: Mapping[str, Any] = field(default_factory=dict)
    key: str | None = None
    original_units: str = ""
    frequencies: Mapping[str, str] = field(default_factory=lambda: {"daily": "day"})

    @property
    def period(self) -> str:
        return naming.format_product(self.product)[0]

    @property
    def resolution(self) -> str:
        return naming.format_product(self.product)[1]

    @property
    def file_pattern(self) -> str:
        if self.resolution not in RESOLUTIONS:
            raise NotImplementedError(f"file names of {self.resolution!r} data are not known")
        return RESOLUTIONS[self.resolution]

    @property
    def version_root(self) -> str:
        return f"{self.download.rstrip('/')}/{naming.format_version(self.version)}"

    @property
    def raw_dir(self) -> str:
        return f"{(self.raw or self.version_root + '/raw').rstrip('/')}/{self.period}/{self.resolution}"

    @property
    def fields(self) -> dict[str, Any]:
        """What templates may name; derived fields stand over given ones."""
        if self.resolution not in self.frequencies:
            raise ValueError(f"no canonical frequency for {self.resolution!r}")
        return {
            "suffix": self.suffix, "grid_name": self.grid_name, "variable": self.variable, "product": self.product, "version_label": self.version,
            "version": naming.format_version(self.version), "period": self.period, "temporal_resolution": self.resolution,
            "frequency": self.frequencies[self.resolution],
        }

    @property
    def store_path(self) -> str:
        return f"{self.version_root}/store/{naming.format_text(self.filename, self.fields)}"

    @property
    def attributes(self) -> dict[str, Any]:
        return naming.format_attributes(self.attrs, self.fields)

    @property
    def attributes_of_variable(self) -> dict[str, Any]:
        """The variable's attributes, each under ``variable:attribute``; of the source's encoding what CARRIED names and
        the config does not. Attributes of a variable that the archive does not have are refused."""
        unknown = sorted(set(self.variable_attrs) - {self.variable})
        if unknown:
            raise ValueError(f"attributes of variables that are not archived: {unknown}")
        carried = {k: v for k, v in self.source_encoding.items() if k in CARRIED}
        return {f"{self.variable}:{k}": v for k, v in (carried | naming.format_attributes(self.variable_attrs.get(self.variable, {}), self.fields)).items()}

    def chunk_shape(self, n_times: int) -> tuple[int, int, int]:
        """-1 is a whole dimension; each dimension must be named and no other may be."""
        if set(self.chunks) != {"time", "y", "x"}:
            raise ValueError(f"chunks must name time, y and x, not {sorted(self.chunks)}")
        return tuple(n if self.chunks[k] == -1 else self.chunks[k] for k, n in (("time", n_times), ("y", self.ny), ("x", self.nx)))

    def check_strategy(self, n_times: int) -> None:
        """Appending needs chunks shorter than the record, writing by region chunks as long as it."""
        time = self.chunk_shape(n_times)[0]
        if self.write_strategy not in STRATEGIES:
            raise ValueError(f"write_strategy is one of {STRATEGIES}, not {self.write_strategy!r}")
        if self.write_strategy == "append" and time >= n_times:
            raise ValueError("append with chunks over the whole record would rewrite every chunk")
        if self.write_strategy == "region" and time < n_times:
            raise ValueError("region needs chunks over the whole record")

    def block(self, n_times: int) -> tuple[int, int]:
        """Rows and columns of a block; refuses, all at once, those that cut through a chunk. The grid's edge may clip a
        block, but its shape must be whole chunks before that."""
        chunk = dict(zip(("y", "x"), self.chunk_shape(n_times)[1:], strict=True))
        whole = {"y": self.ny, "x": self.nx}
        wanted = {k: whole[k] if self.block_shape.get(k, -1) < 0 else self.block_shape[k] for k in whole}
        cut = {k: (n, chunk[k]) for k, n in wanted.items() if n % chunk[k] or not n}
        if cut:
            raise ValueError("blocks must be made of whole chunks: " + "; ".join(f"{k} {n} with chunks of {c}" for k, (n, c) in cut.items()))
        return min(wanted["y"], whole["y"]), min(wanted["x"], whole["x"])

    def commit_days(self) -> int:
        """Whole chunks nearest to timesteps_per_commit; halves go to the even number, as `round` does."""
        chunk = max(1, self.chunks["time"])
        return max(1, round(self.timesteps_per_commit / chunk)) * chunk


def load_config(path: str) -> ArchiveConfig:
    """A config from a YAML or JSON file; keys that are no field are refused."""
    with open(path) as f:
        if path.endswith(".json"):
            data = json.load(f)
        else:
            import yaml

            data = yaml.safe_load(f)
    lists = {k: tuple(map(str if k == "expected_missing_times" else float, data[k])) for k in ("expected_missing_times", "source_fill_values") if k in data}
    return ArchiveConfig(**(data | lists))
