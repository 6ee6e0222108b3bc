"""The audit's verdicts on footprint, chunk shape and names, and the tag that needs a clean one."""

import datetime as dt
import json
import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from gridloom import __main__ as command
from gridloom.operators import archive, audit, encoding, provenance
from gridloom.config import ArchiveConfig
from gridloom.sources import raw

FIRST = dt.date(1979, 6, 27)


KEY = """
| original_variable_name | canonical_name | canonical_units | canonical_long_name | unit_conversion |
|---|---|---|---|---|
| `rain` | `precipitation` | `mm d-1` | `total precipitation` | none |

| original_frequency_name | canonical_name | canonical_long_name |
|---|---|---|
| `daily` | `day` | `daily` |
"""


def record(root, fill=lambda k, y, x: y == 0, **changes):
    """Six days of a 4 x 4 grid as files, and the config of their archive."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    config = ArchiveConfig(**({
        "download": str(root), "version": "V3.16", "product": "Past/Daily", "variable": "rain", "suffix": "spatial", "ny": 4, "nx": 4,
        "source_fill_values": (-5.0,), "chunks": {"time": 1, "y": -1, "x": -1}, "timesteps_per_commit": 4, "attrs": {"title": "t"},
    } | changes))
    os.makedirs(config.raw_dir)
    for k in range(6):
        cells = [(y, x, -5.0 if fill(k, y, x) else float(k + y + x)) for y in range(4) for x in range(4)]
        y, x, v = zip(*cells, strict=True)
        pq.write_table(pa.table({"y": pa.array(y, pa.int32()), "x": pa.array(x, pa.int32()), "rain": pa.array(v, pa.float32())}), f"{config.raw_dir}/{FIRST + dt.timedelta(k):%Y%j}.parquet")
    return config


@pytest.fixture
def config(tmp_path):
    return record(tmp_path)


def failed(found):
    return {r["label"] for r in found.collect() if not r["ok"]}


def test_a_moving_mask_fails(spark, config, tmp_path):
    cells = raw.raw_cells(spark, config)
    assert not failed(audit.audit(archive.build(spark, config), config, cells, n=3, days=4))
    moving = record(tmp_path / "moving", lambda k, y, x: (y, x) == (0, k % 4))  # as many cells every day, but others
    assert any("footprint" in x for x in failed(audit.audit(archive.build(spark, moving), moving, raw.raw_cells(spark, moving), ["sentinel"])))


def test_a_moving_mask_of_the_declared_value_fails(spark, tmp_path):
    """Days that store 11, 11, 11, 7, 7, 7 cells, for the rest is -9999."""
    own = record(tmp_path, source_fill_values=())
    rows = [(FIRST + dt.timedelta(k), i // 4, i % 4, -9999.0 if i < (5 if k < 3 else 9) else 1.0 + i) for k in range(6) for i in range(16)]
    raw.write_days(spark, own, spark.createDataFrame(rows, "t date, y int, x int, v float"))
    store = archive.build(spark, own)
    assert failed(audit.audit(store, own, raw.raw_cells(spark, own), ["sentinel"])) == {"the masked footprint is the same on all days with a file"}


def test_another_kind_of_archive_fails(spark, config):
    store, cells = archive.build(spark, config), raw.raw_cells(spark, config)
    for change, word in (
        ({"chunks": {"time": 1, "y": 2, "x": -1}}, "shape"), ({"variable": "snow"}, "one variable"), ({"ny": 8}, "grid"), ({"timesteps_per_commit": 1}, "commits of the strategy"),
        ({"source_fill_values": ()}, "masked values"), ({"variable_attrs": {"rain": {"units": "m"}}}, "required attributes"),
    ):
        assert any(word in x for x in failed(audit.audit(store, replace(config, **change), cells, ["structure"]))), change
    assert any("lat and lon" in x for x in failed(audit.audit(store, replace(config, lat=(0.0, 1.0)), cells, ["index"])))


def test_wrong_attributes_fail(spark, config):
    store, cells = archive.build(spark, config), raw.raw_cells(spark, config)
    for key, value, word in (("time_coverage_duration", "P7D", "duration"), ("geospatial_lat_max", 1.5, "attributes say")):
        archive.write_attributes(store, {key: value})
        assert any(word in x for x in failed(audit.audit(store, config, cells, ["index"])))


def test_names_are_held_against_the_key(spark, tmp_path):
    (tmp_path / "key.md").write_text(KEY)
    own = record(tmp_path, key=f"{tmp_path}/key.md", original_units="mm/d", variable_attrs={"rain": {"standard_name": "lwe_precipitation_rate"}})
    store, cells = archive.build(spark, own), raw.raw_cells(spark, own)
    assert not failed(audit.audit(store, own, cells, ["structure"]))
    archive.write_attributes(store, {"units": "m", "rain:standard_name": "", "unit_conversion": "times 3"})
    assert failed(audit.audit(store, own, cells, ["structure"])) == {"units is the key's", "unit_conversion is the key's", "a standard name is there"}


def test_the_smallest_chunks_are_read_again(spark, tmp_path):
    own = record(tmp_path, lambda k, y, x: y == 0)
    store, cells = archive.build(spark, own), raw.raw_cells(spark, own)
    least = store.manifest().orderBy("n_bytes", "tc").first()["tc"]  # a chunk a day, the one of the fewest stored bytes
    wrong = cells.withColumn("v", F.when((F.col("t") == F.lit(FIRST + dt.timedelta(least))) & (F.col("y") == 3), F.col("v") + 1).otherwise(F.col("v")))
    assert failed(audit.audit(store, own, wrong, ["sweep"], smallest=1)) == {"the smallest chunks agree"}


def test_siblings_are_compared_by_day(spark, config):
    temporal = replace(config, suffix="temporal", chunks={"time": -1, "y": 2, "x": 2}, write_strategy="region", block_shape={"y": 2, "x": -1})
    store, sibling, cells = archive.build(spark, config), archive.build(spark, temporal), raw.raw_cells(spark, config)
    assert not failed(audit.audit(store, config, cells, ["metadata"], sibling))
    folder = f"data/{'x' * 8}"
    sibling.write(encoding.scattered(cells.where("y = 3").limit(1).withColumn("v", F.lit(99.0)), sibling.shape()), sibling.shape(), folder)
    sibling.commit("write more", "build", folder, (FIRST, FIRST), (0, 4, 0, 4))
    archive.write_attributes(sibling, {"rain:units": "m", "note": "x"})
    assert failed(audit.audit(store, config, cells, ["metadata"], sibling)) == {"attributes agree", "attributes of the variable agree", "cells agree on every day"}


def test_clean_audit_is_needed(spark):
    checks = lambda ok: spark.createDataFrame([(1, p, ok) for p in audit.PHASES], "run int, phase string, ok boolean")
    assert archive.clean_audit(checks(True), audit.PHASES)["n_failures"] == 0
    for bad in (checks(False), checks(True).limit(0), checks(True).where(F.col("phase") != "sweep")):
        with pytest.raises(PermissionError):
            archive.clean_audit(bad, audit.PHASES)


def test_tag_command_needs_a_clean_audit(spark, config, monkeypatch):
    own = config
    store = archive.build(spark, own)
    monkeypatch.setattr(command, "load_config", lambda path: own)
    with pytest.raises(PermissionError):
        command.main(["tag", "--config", "x", "--name", "v1", "--apply"])
    assert store.tags().isEmpty()
    assert command.main(["gc", "--config", "x"]) == 0
    store.add("checks", "run long, phase string, label string, ok boolean, detail string", [(1, p, "l", True, "") for p in audit.PHASES])
    assert command.main(["tag", "--config", "x", "--name", "v1", "--apply"]) == 0
    assert [r["name"] for r in store.tags().collect()] == ["v1"]


def test_commands_from_build_to_tag_with_a_log(spark, config, monkeypatch, tmp_path, capsys):
    monkeypatch.setattr(command, "load_config", lambda path: config)
    log = str(tmp_path / "run.log")
    run = lambda *a: command.main([*a, "--config", "x", "--log", log])
    assert run("build") == 0 and run("verify", "--samples", "3", "--box-timesteps", "3") == 0
    assert provenance.log_evidence(spark, log, audit.PHASES)["n_failures"] == 0
    assert run("attrs", "--apply") == 0 and run("tag", "--name", "v1", "--apply") == 0 and run("status") == 0
    assert json.loads(capsys.readouterr().out)["remaining"] == []
