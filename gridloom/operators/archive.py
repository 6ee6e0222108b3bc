"""A versioned archive: encoded chunks, a manifest of them, an append-only table of commits, tags, attributes.

A commit is one row, written last: it names its folder of data, the days and cells that lie there, and, the first one,
what the archive is. Axis, extents and attributes are read off commits alone, so whatever an interruption leaves behind
is no part of any state.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import os
import time
import uuid
from bisect import bisect_left, bisect_right
from dataclasses import replace
from multiprocessing.pool import ThreadPool

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ArchiveConfig
from ..functions.cells import fill_values, mask_fill
from ..functions.naming import block_message, size_text
from ..functions.tables import small_table
from ..sources import raw
from . import attributes, axis, blocks, encoding, grid
from .provenance import code_revision, nomenclature, object_counts

COMMITS = (
    "seq long, id string, parent string, message string, kind string, written_at timestamp, folder string, n_days long, first_day date, last_day date, "
    "y0 int, y1 int, x0 int, x1 int, spec string, batch long"
)
MANIFEST = ", ".join(x for x in encoding.PIECES.split(", ") if x.split()[0] not in ("valid", "payload")) + ", file string"
SMALL = [x.split()[0] for x in MANIFEST.split(", ")[:-1]]
ADMIN = ("attributes", "tag", "gc", "held")
BY_LAYOUT = ("chunking", "title", "history", "date_created", "related_store", "layout", "summary", "verification")
OWN_HISTORY = "built by gridloom"
#: Cells that a strip of a large chunk has at most, as long as a single row of it has no more.
PIECE_CELLS = 1 << 20
#: Raw bytes up to which an appending build writes several commits at a time, and that a task reads of whole raw files.
WAVE_BYTES, TASK_BYTES = 1 << 28, 1 << 26
#: Pieces of a box up to which the files that hold them are opened by name.
NAMED_FILES = 4096


def as_day(spark: SparkSession, day) -> dt.date:
    """A date, or a column that is a constant one."""
    return day if isinstance(day, dt.date) else spark.range(1).select(day.cast("date")).first()[0]


class Archive:
    """One writer at a time, as its callers see to. Readers see only folders that a commit names."""

    def __init__(self, spark: SparkSession, path: str, must_exist: bool = True):
        self.spark, self.path, self.said = spark, path.rstrip("/"), {}
        at = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        self.files = at.getFileSystem(spark._jsc.hadoopConfiguration())
        if must_exist and not self.has("commits"):
            raise FileNotFoundError(f"no archive at {path}")

    # Small tables

    def hadoop(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def has(self, name: str) -> bool:
        return self.files.exists(self.hadoop(name))

    def small(self, name: str, schema: str) -> DataFrame:
        """A small table, empty while nothing was written; what cannot be read raises."""
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}") if self.has(name) else small_table(self.spark, [], schema)

    def add(self, name: str, schema: str, rows: list[tuple]) -> None:
        small_table(self.spark, rows, schema).coalesce(1).write.mode("append").parquet(f"{self.path}/{name}")

    def history(self) -> DataFrame:
        """Commits, newest first."""
        return self.small("commits", COMMITS).orderBy(F.desc("seq"))

    def tip(self):
        return self.history().first()

    def commit(self, message: str, kind: str, folder: str | None = None, days: tuple | None = None, box: tuple | None = None, spec: dict | None = None, own: str | None = None, n_days: int = 0, batch: int | None = None) -> str:
        """Add the row that makes what was written part of the archive. ``days`` and ``box`` (y0, y1, x0, x1) are the
        extent of the folder; ``n_days`` counts those by which the axis grows; ``batch`` is the micro-batch of a stream
        whose days are in it."""
        own = own or uuid.uuid4().hex
        self.commit_all([(own, message, kind, folder, days, box, spec, n_days, batch)])
        return own

    def commit_all(self, wanted: list[tuple]) -> None:
        """Add the rows of several commits at once, in their order, each (id, message, kind, folder, days, box, spec, n_days,
        batch) as `commit` has them."""
        tip = self.tip()
        seq, parent = (tip["seq"] + 1, tip["id"]) if tip else (0, None)
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        rows = []
        for own, message, kind, folder, days, box, spec, n_days, batch in wanted:
            rows.append((seq, own, parent, message, kind, now, folder, n_days, *(days or (None, None)), *(box or (None,) * 4), json.dumps(spec) if spec else None, batch))
            seq, parent = seq + 1, own
        self.add("commits", COMMITS, rows)

    def tags(self) -> DataFrame:
        return self.small("tags", "name string, id string")

    def attributes(self) -> DataFrame:
        """(key, value): of each key what the last commit of attributes wrote."""
        written = self.small("attributes", "commit string, key string, value string")
        order = self.history().select(F.col("id").alias("commit"), "seq")
        return written.join(order, "commit").groupBy("key").agg(F.max_by("value", "seq").alias("value"))

    def axis(self) -> DataFrame:
        """(t): the days of all commits that the axis grew by."""
        grown = self.history().where("n_days > 0")
        return grown.select(F.explode(F.sequence("first_day", "last_day")).alias("t"))

    def spec(self) -> dict:
        """What the archive is: variable, grid, coordinates, chunk shape, first day, strategy."""
        if not self.said:  # the first commit says it, once for all
            first = self.history().where("spec is not null").orderBy("seq").first()
            self.said = json.loads(first["spec"]) if first else {}
        return self.said

    def variables(self) -> set[str]:
        return {self.spec()["variable"]} if self.spec() else set()

    def coordinates(self, name: str) -> DataFrame:
        """(y, lat) or (x, lon) of the grid, as floats."""
        spec = self.spec()
        index, n = {"lat": ("y", spec["ny"]), "lon": ("x", spec["nx"])}[name]
        first, step = spec[name]
        place = F.round(F.lit(float(first)) + F.lit(float(step)) * F.col("id"), 4).cast("float")
        return self.spark.range(n).select(F.col("id").cast("int").alias(index), place.alias(name))

    # Cells

    def seen(self, at: str | None = None) -> DataFrame:
        """The commits up to a tag, a commit id, or the tip."""
        found = self.history()
        if at is None:
            return found
        tagged = self.tags().where(F.col("name") == at).first()
        known = found.where(F.col("id") == (tagged["id"] if tagged else at)).first()
        if known is None:
            raise ValueError(f"neither tag nor commit: {at}")
        return found.where(F.col("seq") <= known["seq"])

    def shape(self) -> encoding.Shape:
        return encoding.Shape.of(self.spec())

    def named(self, kind: str, at: str | None = None, t: tuple = (None, None), y: tuple | None = None, x: tuple | None = None) -> list[str]:
        """Folders of data or manifest of the commits that a box (days as dates) meets; one a commit."""
        outside = F.lit(False)
        if t[0] is not None:
            outside |= F.col("last_day") < t[0]
        if t[1] is not None:
            outside |= F.col("first_day") >= t[1]
        for name, box in (("y", y), ("x", x)):
            if box is not None:
                outside |= (F.col(f"{name}1") <= box[0]) | (F.col(f"{name}0") >= box[1])
        folders = self.seen(at).where("folder is not null").where(~F.coalesce(outside, F.lit(False)))
        return [f"{self.path}/{kind}/{r['folder'].split('/')[-1]}" for r in folders.select("folder").collect()]

    def pieces_of(self, t: tuple, y: tuple | None, x: tuple | None) -> list:
        """Conditions on a piece's numbers: it can have cells of the box."""
        shape, where = self.shape(), []
        if t[0] is not None:
            where.append(F.col("tc") >= (t[0] - shape.first_day).days // shape.days)
        if t[1] is not None:
            where.append(F.col("tc") <= ((t[1] - shape.first_day).days - 1) // shape.days)
        for name, box, size in (("y", y, shape.ny), ("x", x, shape.nx)):
            if box is not None:
                where += [F.col(f"t{name}") >= box[0] // size, F.col(f"t{name}") <= (box[1] - 1) // size]
        if y is not None:
            strip = F.col("ty") * shape.ny + F.col("part") * shape.strip
            where += [strip < y[1], strip + shape.strip > y[0]]
        return where

    def manifest_rows(self, at: str | None = None, t: tuple = (None, None), y: tuple | None = None, x: tuple | None = None) -> DataFrame:
        """A row a piece (`encoding.PIECES` without the bytes, and its file) as it was written with the piece's commit; no
        data is opened."""
        named = self.named("manifest", at, t, y, x)
        found = self.spark.read.schema(MANIFEST).parquet(*named) if named else small_table(self.spark, [], MANIFEST)
        for condition in self.pieces_of(t, y, x) if named else []:
            found = found.where(condition)
        return found

    def pieces(self, at: str | None = None, t: tuple = (None, None), y: tuple | None = None, x: tuple | None = None) -> DataFrame:
        """The encoded pieces that a box meets. Of a box only the files that the manifest names are opened, and the pieces'
        numbers go to the scan."""
        boxed = t != (None, None) or y is not None or x is not None
        named = self.named("data", at, t, y, x)
        if named and boxed:
            files = [r["file"] for r in self.manifest_rows(at, t, y, x).select("file").distinct().limit(NAMED_FILES + 1).collect()]
            named = named if len(files) > NAMED_FILES else [f"{self.path}/{f}" for f in files]
        found = self.spark.read.schema(encoding.PIECES).parquet(*named) if named else small_table(self.spark, [], encoding.PIECES)
        for condition in self.pieces_of(t, y, x) if named and boxed else []:
            found = found.where(condition)
        return found

    def chunked(self, at: str | None = None, t0=None, t1=None, y: tuple[int, int] | None = None, x: tuple[int, int] | None = None) -> DataFrame:
        """(tc, ty, tx, t, y, x, v) of the cells written, of a half-open box if one is given."""
        if not self.spec():
            return small_table(self.spark, [], encoding.CELLS)
        t = tuple(None if d is None else as_day(self.spark, d) for d in (t0, t1))
        since = tuple(None if d is None else (d - encoding.EPOCH).days for d in t)
        return encoding.cells_of_pieces(self.pieces(at, t, y, x), self.shape(), since, y, x)

    def read(self, at: str | None = None, t0=None, t1=None, y: tuple[int, int] | None = None, x: tuple[int, int] | None = None) -> DataFrame:
        """(t, y, x, v) of `chunked`; cells of fill have no row."""
        return self.chunked(at, t0, t1, y, x).select("t", "y", "x", "v")

    def manifest(self) -> DataFrame:
        """(tc, ty, tx, n_cells, n_bytes) of the chunks there are, by the rows that their commits wrote: ``n_bytes`` is what
        is stored of a chunk."""
        return self.manifest_rows().groupBy("tc", "ty", "tx").agg(F.sum("n_cells").alias("n_cells"), F.sum("n_bytes").alias("n_bytes"))

    def dense(self, y: tuple[int, int], x: tuple[int, int], t0, t1) -> DataFrame:
        """A box of the whole grid, with NaN where no cell is stored."""
        return raw.raw_box(self.read(t0=t0, t1=t1, y=y, x=x), self.axis(), t0, t1, y, x)

    def write(self, fragments: DataFrame, shape: encoding.Shape, folder: str) -> None:
        """The encoded pieces of ``fragments``, and beside them the manifest: a row a piece, read off what was written."""
        where = f"{self.path}/{folder}"
        encoding.gathered(fragments, shape).write.mode("overwrite").option("compression", "none").parquet(where)
        rows = self.spark.read.schema(encoding.PIECES).parquet(where).select(*SMALL, F.concat(F.lit(f"{folder}/"), F.col("_metadata.file_name")).alias("file"))
        rows.write.mode("overwrite").parquet(f"{self.path}/manifest/{folder.split('/')[-1]}")

    def write_wave(self, fragments: DataFrame, shape: encoding.Shape, numbers: list[int], size: int) -> list[str]:
        """`write` for several small commits of ``size`` days in two jobs, whatever their count; a commit is gathered in one
        task. ``numbers`` counts commits from the first day on. Returns the folders, one a commit, in that order."""
        wave = uuid.uuid4().hex
        number = lambda tc: F.floor(tc * shape.days / size)
        own = F.concat(F.lit(f"{wave}-"), number(F.col("tc")).cast("string")).alias("own")
        tc = F.floor(F.col("key") / (shape.tall * shape.wide * shape.parts))
        encoding.gathered(fragments, shape, by=number(tc)).select("*", own).write.option("compression", "none").options(**raw.BY_TASKS).partitionBy("own").parquet(f"{self.path}/data/{wave}")
        there = self.spark.read.schema(f"{encoding.PIECES}, own string").parquet(f"{self.path}/data/{wave}")
        rows = there.select(*SMALL, F.concat(F.lit("data/"), "own", F.lit("/"), F.col("_metadata.file_name")).alias("file"), "own")
        rows.repartition("own").write.options(**raw.BY_TASKS).partitionBy("own").parquet(f"{self.path}/manifest/{wave}")

        def move(name: str) -> None:
            for kind in ("data", "manifest"):
                written, final = self.hadoop(f"{kind}/{wave}/own={name}"), self.hadoop(f"{kind}/{name}")
                if not (self.files.rename(written, final) if self.files.exists(written) else self.files.mkdirs(final)):  # none: all fill
                    raise OSError(f"could not move {written.toString()}")

        names = [f"{wave}-{i}" for i in numbers]
        with ThreadPool(8) as pool:
            pool.map(move, names)
        for kind in ("data", "manifest"):
            self.files.delete(self.hadoop(f"{kind}/{wave}"), True)
        return [f"data/{name}" for name in names]

    # Tags, clean-up, state

    def tag(self, name: str) -> None:
        if not self.tags().where(F.col("name") == name).isEmpty():
            raise ValueError(f"the tag {name!r} exists and tags do not move")
        self.add("tags", "name string, id string", [(name, self.tip()["id"])])

    def unreachable(self, older_than_hours: float = 0) -> list[str]:
        """Data folders that no commit names and that nothing has written to for so long: what interruptions left."""
        if not self.has("data"):
            return []
        latest = (time.time() - older_than_hours * 3600) * 1000
        there = {f"data/{s.getPath().getName()}": s.getModificationTime() for s in self.files.listStatus(self.hadoop("data"))}
        named = {r["folder"] for r in self.history().where("folder is not null").select("folder").collect()}
        return sorted(folder for folder, written in there.items() if folder not in named and written <= latest)

    def reachable_bytes(self) -> int:
        folders = self.history().where("folder is not null").select("folder").collect()
        return sum(self.files.getContentSummary(self.hadoop(r["folder"])).getLength() for r in folders)

    def collect_garbage(self, apply: bool = False, older_than_hours: float = 24) -> list[str]:
        """Delete what no commit names and what is older than the cutoff, so that a build at work keeps what it has
        written for its next commit; what commits name must be the same before and after."""
        before, gone = (self.reachable_bytes(), self.history().count()), self.unreachable(older_than_hours)
        if apply:
            for folder in gone:
                self.files.delete(self.hadoop(folder), True)
                self.files.delete(self.hadoop(folder.replace("data/", "manifest/", 1)), True)
            if before != (self.reachable_bytes(), self.history().count()):
                raise RuntimeError("collection changed what is reachable")
        return gone

    def status(self, config: ArchiveConfig, checks: DataFrame | None = None, phases: list[str] | None = None) -> dict:
        """Where the archive stands on its way to being finished, and what remains to do."""
        try:
            verified = clean_audit(checks, phases)["n_checks"] if checks is not None else 0
        except PermissionError:
            verified = 0
        pending = pending_attributes(self, wanted_attributes(self, config, checks if verified else None)).count()
        tags, gone = sorted(r["name"] for r in self.tags().collect()), self.unreachable()
        steps = ["verify"] if not verified else [*["attrs"] * bool(pending), *["tag"] * (not tags), *["gc"] * bool(gone)]
        on_disk = {r["folder"].rsplit("/", 1)[-1]: r["n_files"] for r in object_counts(self.spark, self.path).where(~F.col("folder").contains("/data/")).collect()}
        shown = self.manifest_rows().agg(size_text(F.coalesce(F.sum("n_bytes"), F.lit(0))).alias("s")).first()["s"] if self.spec() else ""
        return {
            "chunks": shown, "commits": self.history().count(), "tags": tags, "pending": pending, "verified_checks": verified, "reachable_bytes": self.reachable_bytes(),
            "unreachable": gone, "days": self.axis().count(), "files_on_disk": on_disk, "remaining": steps,
        }


# Building


def spec_of(config: ArchiveConfig, whole: axis.Bounds) -> dict:
    return {
        "variable": config.variable, "strategy": config.write_strategy, "ny": config.ny, "nx": config.nx, "lat": list(config.lat), "lon": list(config.lon),
        "chunk": list(config.chunk_shape(whole.days)), "first_day": str(whole.first), "strip": strip_of(config.chunk_shape(whole.days)),
    }


def strip_of(chunk: tuple[int, int, int]) -> int:
    """Rows of a chunk's strips."""
    days, ny, nx = chunk
    return max(1, min(ny, PIECE_CELLS // (days * nx)))


def begin(spark: SparkSession, config: ArchiveConfig) -> tuple[Archive, DataFrame, axis.Bounds, dict]:
    """Gate the axis by the files' names, then open or create the archive; a stored one must be of the same kind and its
    axis that of the build so far. Returns the files as listed, by day."""
    listed = raw.listing(spark, config)
    files = small_table(spark, [(r["t"], r["path"]) for r in listed], "t date, path string")
    declared = small_table(spark, [(dt.date.fromisoformat(x[:10]),) for x in config.expected_missing_times], "t date")
    axis.check_coverage(files, declared)
    days = axis.complete_axis(files)
    axis.check_regular(days)
    whole = axis.bounds(days)
    config.check_strategy(whole.days)
    config.attributes_of_variable  # refuses unknown variables before anything is written
    first = raw.raw_cells(spark, config, [r["path"] for r in listed if r["t"] == whole.first])
    grid.check_fill(first, list(config.source_fill_values))
    store = Archive(spark, config.store_path, must_exist=False)
    there, wanted = store.spec(), spec_of(config, whole)
    other = {k: (there[k], wanted[k]) for k in there if there[k] != wanted.get(k) and k != "strip"}  # that of a stored one stays
    if other:
        raise ValueError("the archive is of another kind: " + "; ".join(f"{k} {a}, not {b}" for k, (a, b) in other.items()))
    return store, days, whole, {r["t"]: r for r in listed}


def cells_of(spark: SparkSession, config: ArchiveConfig, paths: list[str]) -> DataFrame:
    """The cells of some files as they are stored: declared and undeclared fill as NaN."""
    if not paths:
        return small_table(spark, [], "t date, y int, x int, v float")
    return raw.raw_cells(spark, config, paths).withColumn("v", mask_fill(F.col("v"), fill_values(config.source_fill_values)))


def fragments(spark: SparkSession, config: ArchiveConfig, files: list, shape: encoding.Shape) -> DataFrame:
    """The cells of some files as they are stored, dealt to pieces. Small files share a task."""
    paths = [r["path"] for r in files]
    if not paths or config.raw_format != "parquet":
        return encoding.scattered(cells_of(spark, config, paths), shape)
    tasks = max(2 * spark.sparkContext.defaultParallelism, -(-sum(r["n_bytes"] for r in files) // TASK_BYTES))
    return encoding.scattered_files(raw.raw_contents(spark, config, paths).coalesce(tasks), config.variable, fill_values(config.source_fill_values), shape)


def pending_attributes(store: Archive, values: dict) -> DataFrame:
    """(key, value) of ``values`` that the archive does not have so."""
    wanted = small_table(store.spark, [(k, json.dumps(v)) for k, v in values.items()], "key string, value string")
    return attributes.difference(store.attributes(), wanted).where(F.col("change").isin("add", "replace")).select("key", F.col("after").alias("value"))


def write_attributes(store: Archive, values: dict) -> int:
    """Write the attributes that differ, then the commit by which they count; 0 and no commit if none does."""
    changed = pending_attributes(store, values).collect() if values else []
    if changed:
        own = uuid.uuid4().hex
        store.add("attributes", "commit string, key string, value string", [(own, r["key"], r["value"]) for r in changed])
        store.commit(f"write {len(changed)} attributes", "attributes", own=own)
    return len(changed)


def derived_attributes(store: Archive, config: ArchiveConfig) -> dict:
    """What axis, grid and key say, whether they were there when the archive was built or not."""
    whole = axis.bounds(store.axis())
    derived = attributes.placed(whole.first, whole.days, config.ny, config.nx, config.lat, config.lon) if whole.days else {}
    return derived | (nomenclature(store.spark, config, config.original_units) if config.key else {})


def build(spark: SparkSession, config: ArchiveConfig, stop_after: int | None = None) -> Archive:
    """Build or go on building an archive from its raw files. ``stop_after`` ends after so many commits, as an
    interruption would."""
    store, days, whole, files = begin(spark, config)
    if config.raw_format == "netcdf":  # what the source says of itself is read off it; the config's words win
        own, encoded = raw.source_attributes(spark, config, files[whole.first]["path"])
        config = replace(config, source_attrs=own | dict(config.source_attrs), source_encoding=encoded | dict(config.source_encoding), original_units=config.original_units or str(encoded.get("units", "")))
    write = build_append if config.write_strategy == "append" else build_region
    write(store, config, files, days, whole, encoding.Shape.of(store.spec() or spec_of(config, whole)), stop_after)
    masked = {"source_fill_values_masked": list(config.source_fill_values)} if config.source_fill_values else {}
    # Later ones win: the source, what axis, grid and key say, the masks, the config.
    write_attributes(store, dict(config.source_attrs) | derived_attributes(store, config) | masked | {"layout": config.suffix} | config.attributes | config.attributes_of_variable)
    return store


def build_append(store: Archive, config: ArchiveConfig, files: dict, days: DataFrame, whole: axis.Bounds, shape: encoding.Shape, stop_after: int | None) -> None:
    """One commit a batch of whole chunks of days, from the batch's files alone. Small batches are written in waves of as many
    as were committed before, so jobs grow with the logarithm of the commits and an interruption costs no more than
    what is there. A store that ends within a batch cannot go on."""
    axis.check_prefix(store.axis(), days)
    size, done = config.commit_days(), store.axis().count()
    if done and done < whole.days and done % size:
        raise ValueError(f"the store holds {done} days, which is no whole number of commits of {size}")
    planned = blocks.batches(days, config.timesteps_per_commit, max(1, config.chunks["time"])).where(F.col("start") >= done).orderBy("start")
    left = planned.collect()[:stop_after]  # one row a commit
    by_time = sorted(files)
    own = [[files[t] for t in by_time[bisect_left(by_time, b["first_day"]):bisect_right(by_time, b["last_day"])]] for b in left]
    i = 0
    while i < len(left):
        j = wave_end([sum(r["n_bytes"] for r in x) for x in own], i, i + done // size)
        cells = fragments(store.spark, config, [r for x in own[i:j] for r in x], shape)
        told = [
            (f"write timesteps {b['start']}-{b['stop']}", (b["first_day"], b["last_day"]), (0, config.ny, 0, config.nx), None if done or i + k else spec_of(config, whole), b["n_days"])
            for k, b in enumerate(left[i:j])
        ]
        if j == i + 1:
            folder = f"data/{uuid.uuid4().hex}"
            store.write(cells, shape, folder)
            [(message, extent, box, spec, n)] = told
            store.commit(message, "build", folder, extent, box, spec, n_days=n)
        else:
            folders = store.write_wave(cells, shape, [b["batch"] for b in left[i:j]], size)
            store.commit_all([(uuid.uuid4().hex, message, "build", folder, extent, box, spec, n, None) for folder, (message, extent, box, spec, n) in zip(folders, told, strict=True)])
        i = j


def wave_end(sizes: list[int], i: int, there: int) -> int:
    """The end of the wave from batch ``i`` on with ``there`` commits made: one batch at least, at most as many as those and
    WAVE_BYTES of raw bytes."""
    j, held = i + 1, sizes[i]
    while j < len(sizes) and j - i < there and held + sizes[j] <= WAVE_BYTES:
        held += sizes[j]
        j += 1
    return j


def build_region(store: Archive, config: ArchiveConfig, files: dict, days: DataFrame, whole: axis.Bounds, shape: encoding.Shape, stop_after: int | None) -> None:
    """A skeleton commit with axis and kind, then one commit a block of the grid over the whole record.

    The raw files are read once, however many blocks there are: `staged` deals their cells to all blocks that remain as
    bounded fragments of pieces; each block then gathers its own. A build that goes on after an interruption uses what
    was staged if it is whole and of the same files.
    """
    span = (whole.first, whole.last)
    if store.tip() is None:
        store.commit("create skeleton", "skeleton", None, span, spec=spec_of(config, whole), n_days=whole.days)
    elif not axis.axis_differences(store.axis(), days).isEmpty():
        raise ValueError("the stored axis is not that of this build")
    by, bx = config.block(whole.days)
    extent = small_table(store.spark, [(config.ny - 1, config.nx - 1)], "y int, x int")
    planned = blocks.plan(extent, [config.variable], by, bx)
    messages = store.history().select("message")
    stray = blocks.stray(planned, messages).count()
    if stray:
        raise ValueError(f"{stray} committed blocks are not of this block shape")
    message = block_message(*[F.col(c) for c in blocks.KEY]).alias("message")
    left = blocks.remaining(planned, messages).select("*", message).orderBy("y0", "x0").collect()
    if not left or stop_after == 0:
        return
    folder = staged(store, config, files, shape, (by, bx))
    for i, b in enumerate(left):
        if i == stop_after:
            return
        own = store.spark.read.schema(f"{encoding.FRAGMENTS}, block int").parquet(folder).where(F.col("block") == block_number(config, (by, bx), b["y0"], b["x0"]))
        data = f"data/{uuid.uuid4().hex}"
        store.write(own.drop("block"), shape, data)
        store.commit(b["message"], "build", data, span, (b["y0"], b["y1"], b["x0"], b["x1"]))
    store.files.delete(store.hadoop("staging"), True)


def block_number(config: ArchiveConfig, block: tuple[int, int], y0, x0):
    return y0 // block[0] * -(-config.nx // block[1]) + x0 // block[1]


def staged(store: Archive, config: ArchiveConfig, files: dict, shape: encoding.Shape, block: tuple[int, int]) -> str:
    """The folder of fragments of all raw cells by block. Its name says which files, of which size and time, and which
    shape they are of; one that was written whole is used again, others are replaced."""
    seen = sorted((r["path"], r["n_bytes"], r["modified"]) for r in files.values())
    said = json.dumps([seen, str(shape), block, config.variable, config.source_fill_values])
    name = f"staging/{hashlib.sha256(said.encode()).hexdigest()}"
    if not store.has(f"{name}/_SUCCESS"):
        store.files.delete(store.hadoop("staging"), True)
        dealt = fragments(store.spark, config, list(files.values()), shape)
        piece = F.floor(F.col("key") / shape.parts)
        ty, tx = F.floor(piece / shape.wide) % shape.tall, piece % shape.wide
        number = F.floor(ty * shape.ny / block[0]) * -(-config.nx // block[1]) + F.floor(tx * shape.nx / block[1])
        dealt.withColumn("block", number.cast("int")).write.mode("overwrite").partitionBy("block").parquet(f"{store.path}/{name}")
    return f"{store.path}/{name}"


# Finishing


def clean_audit(checks: DataFrame, phases: list[str]):
    """The totals of the last audit; refused unless it had all phases and no failure."""
    latest = attributes.totals(checks, ["run"]).orderBy(F.desc("run")).first()
    if latest is None or latest["n_failures"]:
        raise PermissionError("no audit without failures")
    there = {r["phase"] for r in checks.where(F.col("run") == latest["run"]).select("phase").distinct().collect()}
    if set(phases) - there:
        raise PermissionError(f"the audit left out {sorted(set(phases) - there)}")
    return latest


def provenance(store: Archive, config: ArchiveConfig, checks: DataFrame, current: dict) -> dict:
    """How the archive was built and verified, read off its commits and its audit. A history that is there and this
    package's own stays as it is; the source's own is moved to source_history, once."""
    latest = attributes.totals(checks, ["run"]).orderBy(F.desc("run")).first()
    built = attributes.builds(store.history().withColumn("one", F.lit(1)), ["one"], ADMIN).first()
    stamp = lambda x: x.strftime("%Y-%m-%dT%H:%M:%SZ")
    history = current.get("history", "")
    moved = {}
    if OWN_HISTORY not in history:
        moved = {"source_history": history} if history and "source_history" not in current else {}
        unit = "blocks" if config.write_strategy == "region" else "batches"
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        history = f"{stamp(built['first_build'])}/{stamp(built['last_build'])}: {OWN_HISTORY} at {code_revision(root)} from {config.version} {config.product} in {built['n_builds']} commits of {unit}"
    return moved | {"history": history, "date_created": stamp(built["last_build"]), "verification": f"{latest['n_checks']} checks, 0 failures"}


def wanted_attributes(store: Archive, config: ArchiveConfig, checks: DataFrame | None) -> dict:
    """What the archive should carry, each later part over those before: what it has, axis, grid and key, the config,
    and, on the evidence of ``checks``, its provenance."""
    current = {r["key"]: json.loads(r["value"]) for r in store.attributes().collect()}
    merged = current | derived_attributes(store, config) | config.attributes | config.attributes_of_variable
    return merged | (provenance(store, config, checks, current) if checks is not None else {})


def finalize_attributes(store: Archive, config: ArchiveConfig, checks: DataFrame, phases: list[str], apply: bool = False) -> int:
    """Attributes and provenance, written only if the last audit had all phases and no failure; returns how many differ."""
    clean_audit(checks, phases)
    values = wanted_attributes(store, config, checks)
    return write_attributes(store, values) if apply else pending_attributes(store, values).count()
