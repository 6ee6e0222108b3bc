import datetime as dt
import math
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from gridloom.config import ArchiveConfig, load_config
from gridloom.operators import archive, audit, axis, blocks, grid
from gridloom.sources import key, raw
from gridloom.streaming.ingest import ingest_days

NY, NX, DAYS = 6, 4, 10
HOLE = dt.date(1979, 7, 1)
FIRST = dt.date(1979, 6, 27)
FILL = -239976.0


def value(k, y, x):
    if y < 3 and x < 3:
        return FILL
    return -9999.0 if (y, x) == (5, 3) else float(k * 100 + y * 10 + x)


@pytest.fixture(scope="module")
def tree(spark, tmp_path_factory):
    """Ten days without one, in year folders; beside them a file that must be passed over."""
    root = tmp_path_factory.mktemp("record")
    folder = root / "v_3_16/raw/past/daily/1979"
    folder.mkdir(parents=True)
    import pyarrow as pa
    import pyarrow.parquet as pq

    for k in range(DAYS):
        day = FIRST + dt.timedelta(k)
        if day == HOLE:
            continue
        cells = [(y, x, value(k, y, x)) for y in range(NY) for x in range(NX)]
        y, x, v = zip(*cells, strict=True)
        pq.write_table(pa.table({"y": pa.array(y, pa.int32()), "x": pa.array(x, pa.int32()), "rain": pa.array(v, pa.float32())}), folder / f"{day:%Y%j}.parquet")
    pq.write_table(pa.table({"y": pa.array([0], pa.int32()), "x": pa.array([0], pa.int32()), "rain": pa.array([1.0], pa.float32())}), folder / "notes.parquet")
    return root


@pytest.fixture(scope="module")
def spatial(tree):
    return ArchiveConfig(
        download=str(tree), version="V3.16", product="Past/Daily", variable="rain", suffix="spatial", ny=NY, nx=NX, expected_missing_times=("1979-07-01",),
        source_fill_values=(FILL,), chunks={"time": 1, "y": -1, "x": -1}, timesteps_per_commit=4, attrs={"title": "{version_label} {period}", "rows": NY},
        source_attrs={"history": "made upstream"}, source_encoding={"least_significant_digit": 2, "zlib": True}, variable_attrs={"rain": {"units": "mm d-1"}},
    )


@pytest.fixture(scope="module")
def temporal(spatial):
    return replace(spatial, suffix="temporal", chunks={"time": -1, "y": 2, "x": 2}, write_strategy="region", block_shape={"y": 2, "x": -1})


@pytest.fixture(scope="module")
def cells(spark, spatial):
    return raw.raw_cells(spark, spatial)


@pytest.fixture(scope="module")
def built(spark, spatial):
    return archive.build(spark, spatial)


@pytest.fixture(scope="module")
def sibling(spark, temporal):
    archive.build(spark, temporal, stop_after=1)
    return archive.build(spark, temporal)


def expected():
    return {(FIRST + dt.timedelta(k), y, x, value(k, y, x)) for k in range(DAYS) for y in range(NY) for x in range(NX) if FIRST + dt.timedelta(k) != HOLE and value(k, y, x) > -1}


def test_listing_skips_other_names(spark, spatial):
    files = raw.raw_files(spark, spatial)
    assert [r["t"] for r in files.collect()] == [FIRST + dt.timedelta(k) for k in range(DAYS) if FIRST + dt.timedelta(k) != HOLE]
    index = raw.raw_index(files)
    assert index.count() == DAYS and index.where("path is null").first()["t"] == HOLE


def test_append_store_holds_the_valid_cells(built):
    assert {(r["t"], r["y"], r["x"], r["v"]) for r in built.read().collect()} == expected()
    messages = [r["message"] for r in built.history().collect()]
    assert messages[1:] == ["write timesteps 8-10", "write timesteps 4-8", "write timesteps 0-4"]
    assert built.axis().count() == DAYS


def test_interrupted_region_build_goes_on(sibling):
    assert {(r["t"], r["y"], r["x"], r["v"]) for r in sibling.read().collect()} == expected()
    history = [r["message"] for r in sibling.history().where("kind <> 'attributes'").orderBy("seq").collect()]
    assert history == ["create skeleton", *[f"write block rain y[{a}:{a + 2}] x[0:4]" for a in (0, 2, 4)]]
    # Of six 2x2 tiles one lies wholly in the corner of fill.
    assert sibling.manifest().count() == 5


def test_interrupted_append_goes_on_and_reruns_do_nothing(spark, spatial, cells):
    config = replace(spatial, filename="{suffix}/again.{version}")
    archive.build(spark, config, stop_after=2)
    store = archive.build(spark, config)
    n = store.history().count()
    assert {(r["t"], r["y"], r["x"], r["v"]) for r in store.read().collect()} == expected()
    assert archive.build(spark, config).history().count() == n


def test_audit_passes_and_finds_a_changed_cell(spark, spatial, temporal, built, sibling, cells):
    found = audit.audit(built, spatial, cells, n=3, days=5).collect()
    assert found and all(r["ok"] for r in found), [r for r in found if not r["ok"]]
    assert all(r["ok"] for r in audit.audit(sibling, temporal, cells, ["samples", "sweep", "metadata"], built, n=2, days=5).collect())
    assert [r["label"] for r in found if r["phase"] == "samples"][0].startswith("box 1979-06-27")
    wrong = cells.withColumn("v", F.when((F.col("y") == 5) & (F.col("x") == 0), F.lit(7.5).cast("float")).otherwise(F.col("v")))
    assert not all(r["ok"] for r in audit.audit(built, spatial, wrong, ["samples"], n=6, days=10).collect())
    with pytest.raises(ValueError):
        audit.audit(built, spatial, cells, ["metadata"])


def test_dense_box_restores_nan(built):
    box = built.dense((2, 4), (2, 4), F.lit(HOLE), F.date_add(F.lit(HOLE), 2)).collect()
    assert len(box) == 8
    assert all(math.isnan(r["v"]) for r in box if r["t"] == HOLE or (r["y"], r["x"]) == (2, 2))


def test_finalize_needs_evidence(spark, spatial, built, cells):
    phases = audit.PHASES
    checks = lambda ok: spark.createDataFrame([(1, p, ok) for p in phases], "run int, phase string, ok boolean")
    with pytest.raises(PermissionError):
        archive.finalize_attributes(built, spatial, checks(False), phases)
    with pytest.raises(PermissionError):
        archive.finalize_attributes(built, spatial, checks(True), [*phases, "metadata"])
    assert archive.finalize_attributes(built, spatial, checks(True), phases) == 4
    left = checks(True).select("run", "phase", "ok")
    assert built.status(spatial, left, phases)["remaining"] == ["attrs", "tag"] and built.status(spatial)["remaining"] == ["verify"]
    assert archive.finalize_attributes(built, spatial, checks(True), phases, apply=True) == 4
    assert archive.finalize_attributes(built, spatial, checks(True), phases, apply=True) == 0
    got = {r["key"]: r["value"] for r in built.attributes().collect()}
    assert got["source_history"] == '"made upstream"' and "built by gridloom at" in got["history"] and "3 commits of batches" in got["history"]
    assert got["rain:units"] == '"mm d-1"' and got["rain:least_significant_digit"] == "2" and "rain:zlib" not in got
    assert (got["geospatial_lat_max"], got["geospatial_lat_min"], got["geospatial_lon_min"]) == ("89.95", "89.45", "-179.95")
    later = replace(spatial, attrs={**spatial.attrs, "title": "another"})  # history stays, what changed is written
    assert archive.finalize_attributes(built, later, checks(True), phases) == 1


def test_tags_do_not_move_and_pin_a_state(spark, spatial, cells):
    config = replace(spatial, filename="{suffix}/tagged.{version}")
    store = archive.build(spark, config, stop_after=1)
    store.tag("first")
    with pytest.raises(ValueError):
        store.tag("first")
    n = store.read().count()
    store = archive.build(spark, config)
    assert store.read("first").count() == n < store.read().count()
    assert store.status(config)["tags"] == ["first"] and store.status(config)["pending"] == 0


def test_collection_takes_only_what_no_commit_names(spark, spatial, cells):
    config = replace(spatial, filename="{suffix}/swept.{version}")
    store = archive.build(spark, config)
    cells.limit(1).write.parquet(f"{store.path}/data/left-over")
    cells.limit(1).write.parquet(f"{store.path}/manifest/left-over")
    assert store.collect_garbage(apply=True) == []  # a build at work may have written it just now
    assert store.collect_garbage(older_than_hours=0) == ["data/left-over"]
    store.collect_garbage(apply=True, older_than_hours=0)
    assert not store.has("manifest/left-over")
    assert store.unreachable() == [] and store.read().count() == len(expected())


def test_guards(spark, spatial, temporal, cells):
    with pytest.raises(axis.CoverageError, match="undeclared"):
        archive.build(spark, replace(spatial, expected_missing_times=(), filename="{suffix}/a"))
    with pytest.raises(axis.CoverageError, match="recovered"):
        archive.build(spark, replace(spatial, expected_missing_times=("1979-07-01", "1979-07-02"), filename="{suffix}/a"))
    with pytest.raises(ValueError, match="do not occur"):
        archive.build(spark, replace(spatial, source_fill_values=(-1.0,), filename="{suffix}/a"))
    with pytest.raises(ValueError):
        replace(spatial, chunks={"time": 1, "y": -1}).chunk_shape(10)
    with pytest.raises(ValueError):
        replace(spatial, chunks={"time": -1, "y": -1, "x": -1}).check_strategy(10)
    with pytest.raises(ValueError):
        replace(temporal, chunks={"time": 5, "y": 2, "x": 2}).check_strategy(10)
    with pytest.raises(ValueError):
        replace(temporal, block_shape={"y": 3, "x": -1}).block(10)
    with pytest.raises(ValueError, match="not archived"):
        archive.build(spark, replace(spatial, variable_attrs={"snow": {"units": "m"}}, filename="{suffix}/a"))
    for other in ({"ny": NY + 1}, {"lat": (10.0, -0.5)}, {"chunks": {"time": 2, "y": -1, "x": -1}}):
        with pytest.raises(ValueError, match="another kind"):
            archive.build(spark, replace(spatial, **other))
    with pytest.raises(NotImplementedError):
        replace(spatial, product="Past/Monthly").file_pattern
    with pytest.raises(FileNotFoundError):
        archive.Archive(spark, f"{spatial.download}/nowhere")
    assert not archive.Archive(spark, f"{spatial.version_root}/store/spatial/a", must_exist=False).has("commits")
    with pytest.raises(ValueError):
        archive.build(spark, replace(temporal, block_shape={"y": 4, "x": -1}))


def files_and_rows_read(df):
    """What the scan read, by Spark's own metrics."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    found = {"numFiles": 0, "numOutputRows": 0}

    def walk(node):
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if node.getClass().getSimpleName() == "FileSourceScanExec":
            for name in found:
                found[name] += node.metrics().apply(name).value()
        for i in range(node.children().size()):
            walk(node.children().apply(i))
        return None

    walk(df._jdf.queryExecution().executedPlan())
    return found


def test_reads_open_only_what_they_need(spark, built, sibling):
    whole = files_and_rows_read(sibling.read())
    point = sibling.read(y=(5, 6), x=(1, 2))
    assert {(r["t"], r["v"]) for r in point.collect()} == {(t, v) for t, y, x, v in expected() if (y, x) == (5, 1)}
    own = files_and_rows_read(point)
    assert own["numFiles"] < whole["numFiles"] and own["numOutputRows"] < whole["numOutputRows"]
    day = built.read(t0=FIRST, t1=F.date_add(F.lit(FIRST), 1))
    assert {(r["y"], r["x"], r["v"]) for r in day.collect()} == {(y, x, v) for t, y, x, v in expected() if t == FIRST}
    assert files_and_rows_read(day)["numFiles"] < files_and_rows_read(built.read())["numFiles"]
    assert built.read(t0=dt.date(2020, 1, 1)).count() == 0


@pytest.mark.parametrize("layout", ["spatial", "temporal"])
@pytest.mark.parametrize("crash", ["write", "commit", "add"])
def test_a_crash_at_any_step_of_a_commit_leaves_no_trace(spark, spatial, temporal, cells, monkeypatch, layout, crash):
    config = replace(spatial if layout == "spatial" else temporal, filename="{suffix}/crash" + crash + ".{version}")
    whole, calls = getattr(archive.Archive, crash), []

    def fails(self, *args, **named):
        calls.append(1)
        if crash == "write":
            whole(self, *args, **named)  # data is there, the commit is not
        if len(calls) == 2:
            raise RuntimeError("lost")
        if crash != "write":
            return whole(self, *args, **named)
        return None

    monkeypatch.setattr(archive.Archive, crash, fails)
    with pytest.raises(RuntimeError, match="lost"):
        archive.build(spark, config)
    monkeypatch.undo()
    store = archive.build(spark, config)
    assert {(r["t"], r["y"], r["x"], r["v"]) for r in store.read().collect()} == expected() and store.axis().count() == DAYS
    found = audit.audit(store, config, cells, ["structure", "index", "sweep"]).collect()
    assert all(r["ok"] for r in found), [r for r in found if not r["ok"]]


def test_attributes_without_their_commit_do_not_count(spark, spatial):
    store = archive.build(spark, replace(spatial, filename="{suffix}/attr.{version}"))
    before = {(r["key"], r["value"]) for r in store.attributes().collect()}
    store.add("attributes", "commit string, key string, value string", [("lost", "title", '"lost"')])
    assert {(r["key"], r["value"]) for r in store.attributes().collect()} == before


def test_two_files_of_a_day_and_bad_names_are_refused(spark, spatial, tmp_path):
    import shutil

    own = replace(spatial, download=str(tmp_path))
    shutil.copytree(f"{spatial.raw_dir}/1979", f"{own.raw_dir}/1979")
    shutil.copytree(f"{spatial.raw_dir}/1979", f"{own.raw_dir}/1980")  # year folders are not held against the stamps
    with pytest.raises(axis.CoverageError, match="more than one"):
        archive.build(spark, own)
    shutil.rmtree(f"{own.raw_dir}/1980")
    shutil.copy(f"{own.raw_dir}/1979/1979178.parquet", f"{own.raw_dir}/1979/1979366.parquet")
    with pytest.raises(ValueError, match="no date"):
        archive.build(spark, own)


def test_coordinates(built):
    lat = {r["y"]: r["lat"] for r in built.coordinates("lat").collect()}
    assert len(lat) == NY and abs(lat[0] - 89.95) < 1e-5 and abs(lat[5] - 89.45) < 1e-5
    assert built.variables() == {"rain"} and built.coordinates("lon").count() == NX


def test_duplicate_day_is_refused(spark):
    days = spark.createDataFrame([(FIRST,), (FIRST,)], "t date")
    with pytest.raises(axis.CoverageError, match="more than one"):
        axis.check_coverage(days, spark.createDataFrame([], "t date"))


def test_names(tmp_path, spatial):
    assert spatial.store_path.endswith("/v_3_16/store/spatial/archive.v_3_16.past.day.native.rain")
    assert spatial.attributes == {"title": "V3.16 past", "rows": NY}
    assert replace(spatial, timesteps_per_commit=5, chunks={"time": 2, "y": -1, "x": -1}).commit_days() == 4  # 2.5 chunks: half to even
    with pytest.raises(ValueError):
        replace(spatial, attrs={"a": "{nothing}"}).attributes
    path = tmp_path / "c.yaml"
    path.write_text("download: /d\nversion: V2.8\nproduct: NRT/Daily\nvariable: rain\nexpected_missing_times: [1979-07-01]\nsource_fill_values: [-239976.0]\n")
    config = load_config(str(path))
    assert config.expected_missing_times == ("1979-07-01",) and config.period == "nrt"


def test_key_tables(spark, tmp_path):
    path = tmp_path / "key.md"
    path.write_text("# k\n\n| original_name | canonical_name |\n| --- | --- |\n| `rain` | `precipitation` |\n\n| a | b |\n|-|-|\n| 1 | 2 |\n")
    table = key.key_table(spark, str(path), ["original_name", "canonical_name"])
    assert [tuple(r) for r in table.collect()] == [("rain", "precipitation")]
    names = spark.createDataFrame([("rain",)], "original string")
    assert key.canonical(names, table, "original_name").first()["canonical"] == "precipitation"
    with pytest.raises(ValueError):
        key.canonical(names.union(spark.createDataFrame([("snow",)], "original string")), table, "original_name")
    with pytest.raises(ValueError):
        key.key_table(spark, str(path), ["nothing"])
    back = spark.createDataFrame([("precipitation",)], "canonical string")
    assert [tuple(r) for r in key.original(back, table, "original_name").collect()] == [("precipitation", "rain")]
    for names, said in ((back.union(spark.createDataFrame([("snowfall",)], "canonical string")), "snowfall"), (back, "precipitation")):
        with pytest.raises(ValueError, match=said):
            key.original(names, table.union(spark.createDataFrame([("drizzle", "precipitation")], "a string, b string")), "original_name")


def test_sizes_as_text_and_grids_that_divide(spark):
    from gridloom.functions.naming import size_text

    assert spark.range(1).select(size_text(F.lit(3 << 29))).first()[0] == "1.50 GiB"
    assert grid.divides(1800, 3600, 20, 20) == (True, "") and grid.divides(1800, 3600, 20, 700) == (False, "x 3600 in 700 leaves 100")


def test_golden_tile_counts(spark):
    tiles = grid.tile_grid(1800, 3600, 20, spark)
    assert tiles.count() == 16_200
    assert tiles.where("ty * 20 + 20 <= 150 and tx * 20 + 20 <= 150").count() == 49
    planned = blocks.plan(spark.createDataFrame([(1799, 3599)], "y int, x int"), ["v"], 200, 3600)
    assert planned.count() == 9


def test_stream_ingests_each_day_once(spark, tree, spatial, tmp_path):
    args = (spark, spatial.raw_dir, "rain", str(tmp_path / "out"), str(tmp_path / "state"), 3)
    assert ingest_days(*args).count() == 9 * NY * NX
    assert ingest_days(*args).count() == 9 * NY * NX


def test_day_of_checked_stamp_is_that_of_the_parsed_one(spark):
    from gridloom.functions.naming import day_of_checked_stamp, day_of_stamp

    stamps = [(f"{y}{d:03d}",) for y in (1979, 1980, 2000, 2100) for d in (1, 59, 60, 61, 365)] + [("1980366",), ("2000366",)]
    rows = spark.createDataFrame(stamps, "stamp string").select(day_of_stamp(F.col("stamp")).alias("a"), day_of_checked_stamp(F.concat("stamp", F.lit(".parquet"))).alias("b"))
    assert all(r["a"] is not None and r["a"] == r["b"] for r in rows.collect())


def test_chunks_larger_than_a_piece_are_dealt_in_strips(spark, spatial, tmp_path, monkeypatch):
    """The same cells whatever the strips; one chunk lies in several files, a strip of rows in one."""
    whole = archive.build(spark, replace(spatial, filename="whole"))
    monkeypatch.setattr(archive, "PIECE_CELLS", NX)
    parts = archive.build(spark, replace(spatial, filename="parts"))
    assert whole.chunked().exceptAll(parts.chunked()).isEmpty() and parts.chunked().exceptAll(whole.chunked()).isEmpty()
    rows = parts.manifest_rows()
    assert rows.where("y1 - y0 > 1").isEmpty() and rows.count() == parts.read().select("t", "y").distinct().count()
    assert parts.manifest().drop("n_bytes").exceptAll(whole.manifest().drop("n_bytes")).isEmpty()


@pytest.mark.parametrize("crash", [None, "write_wave", "commit_all"])
def test_small_commits_are_written_in_waves(spark, spatial, cells, monkeypatch, crash):
    """Ten commits of a day, one without a file: two written alone, then waves of two, four and two. A crash in a wave costs
    that wave, and every commit is a state of its own."""
    config = replace(spatial, filename="{suffix}/waves" + str(crash) + ".{version}", timesteps_per_commit=1)
    if crash:
        whole, calls = getattr(archive.Archive, crash), []

        def fails(self, *args):
            calls.append(args)
            if crash == "write_wave":
                whole(self, *args)  # data is there, the commits are not
            if len(args[0]) > 1 if crash == "commit_all" else len(calls) == 2:
                raise RuntimeError("lost")
            return whole(self, *args)

        monkeypatch.setattr(archive.Archive, crash, fails)
        with pytest.raises(RuntimeError, match="lost"):
            archive.build(spark, config)
        monkeypatch.undo()
    add, added = archive.Archive.add, []
    monkeypatch.setattr(archive.Archive, "add", lambda self, name, schema, rows: (added.append((name, len(rows))), add(self, name, schema, rows))[1])
    store = archive.build(spark, config)
    assert [n for name, n in added if name == "commits"] == {None: [1, 1, 2, 4, 2, 1], "write_wave": [4, 2, 1], "commit_all": [2, 4, 2, 1]}[crash]
    history = store.history().where("kind = 'build'").orderBy("seq").collect()
    assert [(r["message"], r["first_day"], r["n_days"]) for r in history] == [(f"write timesteps {k}-{k + 1}", FIRST + dt.timedelta(k), 1) for k in range(DAYS)]
    parents = [r["parent"] for r in history]
    assert parents == [None, *[r["id"] for r in history[:-1]]] and len({r["folder"] for r in history}) == DAYS
    assert {(r["t"], r["y"], r["x"], r["v"]) for r in store.read().collect()} == expected()
    for k in (3, 6):  # within a wave
        assert {r["t"] for r in store.read(history[k]["id"]).select("t").collect()} == {FIRST + dt.timedelta(i) for i in range(k + 1)} - {HOLE}
    found = audit.audit(store, config, cells, ["structure", "index", "sweep"]).collect()
    assert all(r["ok"] for r in found), [r for r in found if not r["ok"]]
    assert store.collect_garbage(apply=True, older_than_hours=0) is not None and store.unreachable() == []
    assert store.read().count() == len(expected())


def test_a_wave_is_bounded_by_bytes_and_by_what_is_there(monkeypatch):
    monkeypatch.setattr(archive, "WAVE_BYTES", 10)
    assert [archive.wave_end([3, 3, 3, 3, 3], i, there) for i, there in ((0, 0), (1, 1), (0, 2), (0, 9), (4, 9))] == [1, 2, 2, 3, 5]
    assert archive.wave_end([11, 1], 0, 9) == 1


def test_raw_files_are_listed_by_one_job(spark, spatial):
    spark.sparkContext.setJobGroup("listed", "")
    files = raw.raw_files(spark, spatial).collect()
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("listed")
    spark.sparkContext.setJobGroup("", "")
    assert len(files) == DAYS - 1 and len(jobs) <= 2


def test_contents_are_those_of_the_files_named(spark, spatial):
    files = [r["path"] for r in raw.raw_files(spark, spatial).collect()]
    assert sorted(r["stamp"] for r in raw.raw_contents(spark, spatial, files[2:5]).select("stamp").collect()) == sorted(p[-15:-8] for p in files[2:5])
