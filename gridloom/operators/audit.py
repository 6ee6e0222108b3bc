"""The audit: phases of checks of an archive against raw cells that are read apart from the build."""

from __future__ import annotations

import datetime as dt
import json
import random
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import ArchiveConfig
from ..functions.cells import fill_values, is_fill
from ..functions.tables import small_table
from . import attributes, axis, encoding, grid, levels
from .archive import BY_LAYOUT, Archive
from .provenance import nomenclature

PHASES = ["structure", "index", "samples", "sweep", "sentinel"]
REQUIRED = (
    "time_coverage_start", "time_coverage_end", "time_coverage_resolution", "time_coverage_duration", "geospatial_lat_min", "geospatial_lat_max",
    "geospatial_lat_resolution", "geospatial_lon_min", "geospatial_lon_max", "geospatial_lon_resolution", "layout",
)


def check(df: DataFrame, phase: str, label: str, ok: Column, detail: Column) -> DataFrame:
    """One verdict from a one-row table."""
    return df.select(F.lit(phase).alias("phase"), F.lit(label).alias("label"), F.coalesce(ok, F.lit(False)).alias("ok"), detail.cast("string").alias("detail"))


def none(df: DataFrame, phase: str, label: str) -> DataFrame:
    """A verdict that holds if ``df`` has no row."""
    return check(df.agg(F.count("*").alias("n")), phase, label, F.col("n") == 0, F.col("n"))


def said(spark, phase: str, label: str, ok: bool, detail) -> DataFrame:
    """A verdict from what the driver knows."""
    return small_table(spark, [(phase, label, bool(ok), str(detail))], "phase string, label string, ok boolean, detail string")


def structure(store: Archive, config: ArchiveConfig, raw: DataFrame) -> list[DataFrame]:
    spark, spec = store.spark, store.spec()
    whole = axis.bounds(store.axis())
    chunk = config.chunk_shape(whole.days)
    kinds = dict(store.read().dtypes)
    one = store.history().agg(F.count_if(F.col("kind") == "build").alias("builds"), F.count_if(F.col("kind") == "skeleton").alias("skeletons"))
    region = config.write_strategy == "region"
    if region:
        by, bx = config.block(whole.days)
        wanted = -(-config.ny // by) * -(-config.nx // bx)
    else:
        wanted = -(-whole.days // config.commit_days())
    attrs = store.attributes().agg(F.array_sort(F.collect_set("key")).alias("keys"))
    missing = F.array_except(F.array(*map(F.lit, [*REQUIRED, *config.attributes, *config.attributes_of_variable])), F.col("keys"))
    masked = F.array_contains("keys", "source_fill_values_masked") == F.lit(bool(config.source_fill_values))
    cells = store.manifest_rows().agg(
        F.min("y0").alias("y0"), F.max("y1").alias("y1"), F.min("x0").alias("x0"), F.max("x1").alias("x1"), F.count_if(F.isnan("v_min") | F.isnan("v_max")).alias("nan"))
    layout = "temporal" if config.chunks["time"] == -1 else "spatial"
    return [
        said(spark, "structure", "one variable, the config's", store.variables() == {config.variable}, store.variables()),
        check(one, "structure", "cells are (date, int, int, float)", F.lit(kinds == {"t": "date", "y": "int", "x": "int", "v": "float"}), F.lit(str(kinds))),
        said(spark, "structure", "the grid is the config's", (spec.get("ny"), spec.get("nx")) == (config.ny, config.nx), spec.get("ny")),
        check(cells, "structure", "cells lie in the grid", (F.col("y0") >= 0) & (F.col("x0") >= 0) & (F.col("y1") <= config.ny) & (F.col("x1") <= config.nx), F.col("y1")),
        check(cells, "structure", "fill is not stored", F.col("nan") == 0, F.col("nan")),
        said(spark, "structure", f"chunks have the shape {chunk}", tuple(spec.get("chunk", ())) == chunk, spec.get("chunk")),
        none(misplaced(store, chunk), "structure", f"cells lie in their chunk of the shape {chunk}"),
        check(attrs, "structure", "required attributes", F.size(missing) == 0, F.concat_ws(",", missing)),
        check(attrs, "structure", "masked values are named if there are any", masked, F.lit(str(config.source_fill_values))),
        check(one, "structure", "commits of the strategy", (F.col("builds") >= wanted) & (F.col("skeletons") == int(region)), F.col("builds")),
        said(spark, "structure", "directory is the layout", f"/{config.suffix}/" in store.path, store.path),
        said(spark, "structure", "directory names the layout of the chunks", layout in config.suffix, config.suffix),
        *names(store, config),
    ]


def misplaced(store: Archive, chunk: tuple[int, int, int]) -> DataFrame:
    """Pieces whose cells, by the manifest, do not lie in the chunk of shape ``chunk`` (days, rows, columns) that holds
    them."""
    days, ny, nx = chunk
    first = F.lit(axis.bounds(store.axis()).first)
    last = F.array_max(F.zip_with("mask_from", "mask_days", lambda a, n: F.date_add(a, n - 1)))
    outside = [F.floor(F.datediff(F.array_min("mask_from"), first) / days) != F.col("tc"), F.floor(F.datediff(last, first) / days) != F.col("tc")]
    for low, high, size, tile in (("y0", "y1", ny, "ty"), ("x0", "x1", nx, "tx")):
        outside += [F.floor(F.col(low) / size) != F.col(tile), F.floor((F.col(high) - 1) / size) != F.col(tile)]
    return store.manifest_rows().where(reduce(Column.__or__, outside))


def names(store: Archive, config: ArchiveConfig) -> list[DataFrame]:
    """A verdict for each attribute that the nomenclature key gives, for the standard name and for what the store's own
    name says; none without a key."""
    if not config.key:
        return []
    spark = store.spark
    there = {r["key"]: json.loads(r["value"]) for r in store.attributes().collect()}
    out = []
    for key, value in nomenclature(spark, config, config.original_units).items():
        ok = there.get(key) == value
        if key == "original_units":
            ok = ok and bool(value)
        out.append(said(spark, "structure", f"{key} is the key's", ok, there.get(key)))
    out.append(said(spark, "structure", "a standard name is there", there.get(f"{config.variable}:standard_name") or there.get("standard_name"), sorted(there)))
    own = store.path.rsplit("/", 1)[-1]
    tokens = [config.fields[x] for x in ("version", "period", "frequency", "variable") if "{" + x + "}" in config.filename]
    out.append(said(spark, "structure", "the store's name carries its tokens", tokens and all(x in own for x in tokens), own))
    return out


def index(store: Archive, config: ArchiveConfig, raw: DataFrame) -> list[DataFrame]:
    spark, spec = store.spark, store.spec()
    expected = axis.complete_axis(raw.select("t"))
    steps = axis.steps(store.axis()).where("step is not null").agg(F.count_distinct("step").alias("n"), F.max("step").alias("step"))
    gaps = axis.missing_days(raw.select("t"))
    lasts = store.axis().agg(F.concat(F.lit("P"), F.count_distinct("t").cast("string"), F.lit("D")).alias("span"))
    duration = store.attributes().where("key = 'time_coverage_duration'").agg(F.max("value").alias("value")).join(lasts)  # a row each
    grown = store.coordinates("lat").agg(F.min("lat").alias("a"), F.max("lat").alias("b")).join(store.coordinates("lon").agg(F.min("lon").alias("c"), F.max("lon").alias("d")))
    ends = {r["key"]: float(json.loads(r["value"])) for r in store.attributes().where(F.col("key").rlike("^geospatial_l(at|on)_(min|max)$")).collect()}
    names = ("geospatial_lat_min", "geospatial_lat_max", "geospatial_lon_min", "geospatial_lon_max")
    close = F.lit(len(ends) == 4)
    for column, name in zip("abcd", names, strict=True):
        close &= F.col(column) == F.lit(ends.get(name, float("nan"))).cast("float")
    return [
        none(axis.axis_differences(store.axis(), expected), "index", "axis is the complete one of the raw files"),
        check(steps, "index", "one step", F.col("n") <= 1, F.col("n")),
        check(duration, "index", "the duration is the axis's", F.col("value") == F.concat(F.lit('"'), "span", F.lit('"')), F.col("value")),
        said(spark, "index", "lat and lon are the source's", (spec.get("lat"), spec.get("lon")) == (list(config.lat), list(config.lon)), spec.get("lat")),
        check(grown, "index", "lat and lon end where the attributes say", close, F.concat_ws("/", *[F.col(c).cast("string") for c in "abcd"])),
        none(levels.by_day(store).join(gaps, "t", "left_semi"), "index", "days without a file are fill"),
        none(store.axis().groupBy("t").count().where("count > 1"), "index", "no day twice"),
    ]


def boxes(config: ArchiveConfig, whole: axis.Bounds, n: int, days: int, seed: int) -> list[tuple]:
    """Half-open boxes: the two corners of the grid and random tiles, over the record's ends and random spans."""
    draw = random.Random(seed)
    _, cy, cx = config.chunk_shape(whole.days)
    cy, cx = min(cy, 40), min(cx, 40)
    days = min(days, whole.days)
    out = []
    for i in range(n):
        k = {0: 0, 1: whole.days - days}.get(i, draw.randrange(whole.days - days + 1))
        y = {0: 0, 1: config.ny - cy}.get(i, draw.randrange(config.ny - cy + 1))
        x = {0: 0, 1: config.nx - cx}.get(i, draw.randrange(config.nx - cx + 1))
        out.append((k, days, (y, y + cy), (x, x + cx)))
    return out


def in_boxes(cells: DataFrame, listed: list[tuple]) -> DataFrame:
    """(box, t, y, x, v) of the cells of every box (first day, last day, y, x), a cell once for each box that holds it.
    One scan for all of them."""
    inside = [
        F.col("t").between(a, b) & (F.col("y") >= y[0]) & (F.col("y") < y[1]) & (F.col("x") >= x[0]) & (F.col("x") < x[1]) for a, b, y, x in listed
    ]
    held = F.array_compact(F.array(*[F.when(one, F.lit(i)) for i, one in enumerate(inside)]))
    return cells.where(reduce(Column.__or__, inside)).select(F.explode(held).alias("box"), "t", "y", "x", "v")


def samples(store: Archive, config: ArchiveConfig, raw: DataFrame, n: int = 24, days: int = 400, seed: int = 20) -> list[DataFrame]:
    """All boxes of both sides by one scan each, compared in one join; a box without any cell on either side agrees."""
    whole = axis.bounds(store.axis())
    listed = [(whole.first + dt.timedelta(k), whole.first + dt.timedelta(k + span - 1), y, x) for k, span, y, x in boxes(config, whole, n, days, seed)]
    found = grid.compare(in_boxes(store.read(), listed), in_boxes(raw, listed), fill_values(config.source_fill_values), by=["box"])
    labels = small_table(store.spark, [(i, f"box {a} to {b} y {y[0]} x {x[0]}") for i, (a, b, y, x) in enumerate(listed)], "box int, name string")
    both = labels.join(found, "box", "left")
    ok = F.coalesce(F.col("mask_ok") & F.col("values_ok"), F.lit(True))
    detail = F.concat_ws("/", F.coalesce("n_different", F.lit(0)).cast("string"), F.coalesce("n_valid", F.lit(0)).cast("string"))
    return [both.select(F.lit("samples").alias("phase"), F.col("name").alias("label"), ok.alias("ok"), detail.alias("detail"))]


def reread(store: Archive, config: ArchiveConfig, raw: DataFrame, place: list[Column], k: int) -> DataFrame:
    """The chunks of the fewest stored bytes (``k`` of them) against the raw, cell by cell. Only their files are opened."""
    least = store.manifest().orderBy("n_bytes", "tc", "ty", "tx").limit(k).select("tc", "ty", "tx")
    few = F.broadcast(least)  # k rows
    files = [f"{store.path}/{r['file']}" for r in store.manifest_rows().join(few, ["tc", "ty", "tx"], "left_semi").select("file").distinct().collect()]  # of k chunks
    read = store.spark.read.schema(encoding.PIECES).parquet(*files) if files else small_table(store.spark, [], encoding.PIECES)
    own = encoding.cells_of_pieces(read.join(few, ["tc", "ty", "tx"], "left_semi"), store.shape()).select("t", "y", "x", "v")
    there = raw.select(*place, "t", "y", "x", "v").join(few, ["tc", "ty", "tx"], "left_semi").select("t", "y", "x", "v")
    return grid.compare(own, there, fill_values(config.source_fill_values))


def unlike_manifest(store: Archive) -> DataFrame:
    """Manifest rows that the pieces do not bear out, and what the pieces give instead: every piece is read and its
    numbers, bounds and digests worked out anew."""
    said, there = store.manifest_rows().drop("file"), encoding.recounted(store.pieces(), store.shape())
    return said.exceptAll(there).unionByName(there.exceptAll(said))


def sweep(store: Archive, config: ArchiveConfig, raw: DataFrame, smallest: int = 3) -> list[DataFrame]:
    whole = axis.bounds(store.axis())
    days, ny, nx = config.chunk_shape(whole.days)
    tall, wide, deep = -(-config.ny // ny), -(-config.nx // nx), -(-whole.days // days)
    manifest = store.manifest()
    place = [F.floor(F.datediff("t", F.lit(whole.first)) / days).alias("tc"), F.floor(F.col("y") / ny).cast("int").alias("ty"), F.floor(F.col("x") / nx).cast("int").alias("tx")]
    valid = raw.where(~F.isnan("v") & ~is_fill(F.col("v"), fill_values(config.source_fill_values)))
    with_data = valid.groupBy(*place).agg(F.count("*").alias("n_raw"))
    outside = manifest.where(~(F.col("tc").between(0, deep - 1) & F.col("ty").between(0, tall - 1) & F.col("tx").between(0, wide - 1)))
    sizes = manifest.agg(F.count("*").alias("n"), F.min("n_bytes").alias("least"), F.median("n_bytes").alias("middle"), F.max("n_bytes").alias("most"))
    return [
        check(sizes, "sweep", "chunks there are", F.col("n") > 0, F.concat_ws("/", *[F.col(c).cast("string") for c in ("n", "least", "middle", "most")])),
        none(outside, "sweep", "chunks lie in the grid"),
        none(store.manifest_rows().groupBy("tc", "ty", "tx", "part").count().where("count > 1"), "sweep", "no chunk twice"),
        none(unlike_manifest(store), "sweep", "the manifest is what the chunks hold"),
        none(with_data.join(manifest, ["tc", "ty", "tx"], "left_anti"), "sweep", "chunks with raw data are written"),
        said(store.spark, "sweep", "note: chunks divide the grid", True, grid.divides(config.ny, config.nx, ny, nx)[1] or "without a rest"),
        check(reread(store, config, raw, place, smallest), "sweep", "the smallest chunks agree", F.col("mask_ok") & F.col("values_ok"), F.col("n_different")),
        none(manifest.join(with_data, ["tc", "ty", "tx"], "left").where(~F.col("n_cells").eqNullSafe(F.col("n_raw"))), "sweep", "chunks hold as many cells as the raw has"),
    ]


def footprints(store: Archive, raw: DataFrame) -> DataFrame:
    """(t, n, footprint) of every day with a file: how many cells are stored, and which, by the manifest. What the raw
    declares missing is masked in the archive as other fill is, so it counts as mask too."""
    return raw.select("t").distinct().join(levels.by_day(store), "t", "left").select("t", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("footprint", F.lit(0)).alias("footprint"))


def undeclared(cells: DataFrame, fills: list[float]) -> DataFrame:
    """A verdict that names each undeclared negative value, its days by number, the first and the last."""
    found = grid.value_days(cells, fills)
    days = grid.days_of_bitmap(found).groupBy("v").agg(F.count("*").alias("days"), F.min("t").alias("a"), F.max("t").alias("b"))
    named = F.concat_ws(", ", F.slice(F.array_sort(F.collect_list(F.concat_ws(" ", F.col("v").cast("string"), F.lit("on"), F.col("days").cast("string"), F.lit("days from"), F.col("a").cast("string"), F.lit("to"), F.col("b").cast("string")))), 1, 10))
    return check(days.agg(F.count("*").alias("n"), named.alias("named")), "sentinel", "negative raw values are declared", F.col("n") == 0, F.concat_ws(": ", F.col("n").cast("string"), "named"))


def sentinel(store: Archive, config: ArchiveConfig, raw: DataFrame, planes: int = 40) -> list[DataFrame]:
    fills = fill_values(config.source_fill_values)
    days = grid.spaced_days(raw.select("t").distinct(), planes)
    return [
        undeclared(raw.join(days, "t", "left_semi"), fills),
        none(store.manifest_rows().where("n_negative > 0"), "sentinel", "no stored value is negative"),
        check(footprints(store, raw).agg(F.count_distinct("n", "footprint").alias("n")), "sentinel", "the masked footprint is the same on all days with a file", F.col("n") <= 1, F.col("n")),
        check(store.manifest_rows().agg(F.count_if(F.col("v_max") > grid.CEILING).alias("above")), "sentinel", "note: pieces with cells above the ceiling", F.lit(True), F.col("above")),
    ]


def metadata(store: Archive, config: ArchiveConfig, sibling: Archive) -> list[DataFrame]:
    """Against the other layout of the same record."""
    place = lambda x: {k: x.spec().get(k) for k in ("variable", "ny", "nx", "lat", "lon")}
    cells = levels.different_cells(store, sibling) if place(store) == place(sibling) and store.shape().first_day == sibling.shape().first_day else store.read()
    first = F.min(F.concat_ws(" ", F.col("t").cast("string"), F.col("y").cast("string"), F.col("x").cast("string")))
    own = F.col("key").contains(":")
    return [
        none(axis.axis_differences(store.axis(), sibling.axis()), "metadata", "axes agree"),
        said(store.spark, "metadata", "variable, grid and coordinates agree", place(store) == place(sibling), place(sibling)),
        none(attributes.disagreements(store.attributes().where(~own), sibling.attributes().where(~own), BY_LAYOUT), "metadata", "attributes agree"),
        none(attributes.disagreements(store.attributes().where(own), sibling.attributes().where(own)), "metadata", "attributes of the variable agree"),
        check(cells.agg(F.count("*").alias("n"), first.alias("first")), "metadata", "cells agree on every day", F.col("n") == 0, F.concat_ws(": ", F.col("n").cast("string"), "first")),
    ]


def audit(store: Archive, config: ArchiveConfig, raw: DataFrame, phases: list[str] | None = None, sibling: Archive | None = None, **options) -> DataFrame:
    """(phase, label, ok, detail) of all checks of ``phases``."""
    wanted = phases or PHASES
    known = {"structure": structure, "index": index, "samples": samples, "sweep": sweep, "sentinel": sentinel}
    unknown = set(wanted) - {*known, "metadata"}
    if unknown or ("metadata" in wanted and sibling is None):
        raise ValueError(f"unknown phases: {sorted(unknown)}" if unknown else "metadata needs a sibling")
    smallest = {"smallest": options.pop("smallest", 3)}
    parts = [x for p in wanted if p in known for x in known[p](store, config, raw, **(options if p == "samples" else smallest if p == "sweep" else {}))]
    parts += metadata(store, config, sibling) if "metadata" in wanted else []
    return reduce(DataFrame.unionByName, parts)
