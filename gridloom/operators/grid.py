"""Cells, tiles and boxes of a cube (t, y, x, v)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.cells import NAN, is_fill, is_finite, is_valid, mask_fill, same_cell
from ..functions.naming import EPOCH, days_since_epoch

FLOOR, CEILING = 0.0, 2000.0


def tile(edge: int) -> tuple[Column, Column]:
    return F.floor(F.col("y") / edge).cast("int").alias("ty"), F.floor(F.col("x") / edge).cast("int").alias("tx")


def box(cube: DataFrame, t0=None, t1=None, y=None, x=None) -> DataFrame:
    """A half-open box; the comparisons are plain, so that they reach the scan."""
    for name, low, high in (("t", t0, t1), ("y", *(y or (None, None))), ("x", *(x or (None, None)))):
        if low is not None:
            cube = cube.where(F.col(name) >= low)
        if high is not None:
            cube = cube.where(F.col(name) < high)
    return cube


def masked(cube: DataFrame, fills: Sequence[float], kind: str = "float") -> DataFrame:
    return cube.withColumn("v", mask_fill(F.col("v"), fills, kind))


def fill_occurrence(cube: DataFrame, fills: Sequence[float], kind: str = "float") -> DataFrame:
    """(fill, n, percent) of each declared fill value on the cube's first day."""
    first = cube.join(cube.agg(F.min("t").alias("t")), "t")
    return first.agg(
        *[F.count_if(is_fill(F.col("v"), [f], kind)).alias(f"n{i}") for i, f in enumerate(fills)], F.count("*").alias("cells")
    ).select(F.explode(F.array(*[
        F.struct(F.lit(float(f)).alias("fill"), F.col(f"n{i}").alias("n"), (100 * F.col(f"n{i}") / F.col("cells")).alias("percent"))
        for i, f in enumerate(fills)
    ])).alias("r")).select("r.*")


def check_fill(cube: DataFrame, fills: Sequence[float], kind: str = "float") -> None:
    """Every value that a config calls undeclared fill must occur on the first day."""
    absent = [r["fill"] for r in fill_occurrence(cube, fills, kind).where("n = 0").collect()] if fills else []
    if absent:
        raise ValueError(f"fill values that do not occur: {absent}")


def undeclared_negatives(cube: DataFrame, fills: Sequence[float], kind: str = "float") -> DataFrame:
    """(v, n, first_t, last_t) of negative values that are no fill."""
    bad = cube.where((F.col("v") < 0) & ~is_fill(F.col("v"), fills, kind))
    return bad.groupBy("v").agg(F.count("*").alias("n"), F.min("t").alias("first_t"), F.max("t").alias("last_t"))


def physical_range(cube: DataFrame, floor: float = FLOOR, ceiling: float = CEILING) -> DataFrame:
    """One row: finite cells, least and largest value, cells below the floor and above the ceiling."""
    v = F.when(is_finite(F.col("v")), F.col("v"))
    return cube.select(v.alias("v")).agg(
        F.count("v").alias("n_finite"), F.min("v").alias("v_min"), F.max("v").alias("v_max"),
        F.count_if(F.col("v") < floor).alias("below"), F.count_if(F.col("v") > ceiling).alias("above"),
    )


def tiles_with_data(cube: DataFrame, edge: int, fills: Sequence[float] = (), kind: str = "float") -> DataFrame:
    """(ty, tx, any_valid, n_valid)."""
    valid = is_valid(F.col("v"), fills, kind)
    return cube.groupBy(*tile(edge)).agg(F.bool_or(valid).alias("any_valid"), F.count_if(valid).alias("n_valid"))


def tile_grid(ny: int, nx: int, edge: int, spark) -> DataFrame:
    """(ty, tx) of the whole grid, counted up from its numbers."""
    wide = -(-nx // edge)
    return spark.range(-(-ny // edge) * wide).select(F.floor(F.col("id") / wide).cast("int").alias("ty"), (F.col("id") % wide).cast("int").alias("tx"))


def divides(ny: int, nx: int, edge_y: int, edge_x: int) -> tuple[bool, str]:
    """Whether tiles cut the grid without a rest, and which dimension does not."""
    rest = {"y": (ny, edge_y, ny % edge_y), "x": (nx, edge_x, nx % edge_x)}
    said = [f"{name} {n} in {edge} leaves {r}" for name, (n, edge, r) in rest.items() if r]
    return not said, "; ".join(said)


def lattice(tiles: DataFrame, parts: int = 6) -> DataFrame:
    """Tiles on a lattice of about ``parts`` steps a side."""
    top = tiles.agg((F.max("ty") + 1).alias("ny"), (F.max("tx") + 1).alias("nx"))
    step = lambda n: F.greatest(F.lit(1), F.floor(F.col(n) / parts))
    return tiles.join(F.broadcast(top)).where((F.col("ty") % step("ny") == 0) & (F.col("tx") % step("nx") == 0)).select("ty", "tx")  # top is one row


def spaced_days(axis: DataFrame, k: int) -> DataFrame:
    """(t): ``k`` evenly spaced days of an axis, ends included; places round half to even and repeats fall away."""
    placed = axis.select("t").distinct().select("t", (F.row_number().over(Window.orderBy("t")) - 1).alias("place"))
    n = placed.agg(F.count("*").alias("n"))
    wanted = n.where("n > 0").select(
        F.explode(F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.bround(i * (F.col("n") - 1) / max(k - 1, 1)).cast("int")))).alias("place")
    )
    return placed.join(wanted, "place").select("t")


def sampled_days(axis: DataFrame, n: int, seed: int) -> DataFrame:
    """(t): a seeded draw of ``n`` days in which the first and last always stand."""
    ends = axis.agg(F.min("t").alias("a"), F.max("t").alias("b"))
    drawn = axis.select("t").distinct().orderBy(F.xxhash64(F.lit(seed), "t"), "t").limit(max(n - 2, 0))
    return drawn.union(ends.select("a")).union(ends.select("b")).where("t is not null").distinct()


def mask_footprints(cube: DataFrame, fills: Sequence[float] = (), kind: str = "float") -> DataFrame:
    """(t, n_masked, footprint): how many cells of a day are masked, and which, as an order-free hash of their places.

    The hash is a sum over cells, so it is aggregated before the shuffle and no day's cells come together in a list.
    """
    gone = ~is_valid(F.col("v"), fills, kind)
    place = F.xxhash64("y", "x").cast("decimal(38,0)")
    return cube.groupBy("t").agg(F.count_if(gone).alias("n_masked"), F.coalesce(F.sum(F.when(gone, place)), F.lit(0)).cast("string").alias("footprint"))


def compare(stored: DataFrame, raw: DataFrame, fills: Sequence[float] = (), kind: str = "float", by: Sequence[str] = ()) -> DataFrame:
    """One row, or one for each ``by``: cells, masks that agree, values that agree, valid cells. A cell that one side
    lacks is NaN there, and a fill value in the raw is what the store must have masked."""
    a = stored.select(*by, "t", "y", "x", F.col("v").alias("a"))
    b = raw.select(*by, "t", "y", "x", mask_fill(F.col("v"), fills, kind).alias("b"))
    nan = F.lit(NAN).cast(kind)
    both = a.join(b, [*by, "t", "y", "x"], "full_outer").select(*by, F.coalesce("a", nan).alias("a"), F.coalesce("b", nan).alias("b"))
    return both.groupBy(*by).agg(
        F.count("*").alias("n_cells"), F.coalesce(F.bool_and(F.isnan("a") == F.isnan("b")), F.lit(True)).alias("mask_ok"),
        F.coalesce(F.bool_and(F.isnan("a") | F.isnan("b") | (F.col("a") == F.col("b"))), F.lit(True)).alias("values_ok"),
        F.count_if(~same_cell(F.col("a"), F.col("b"))).alias("n_different"), F.count_if(~F.isnan("b")).alias("n_valid"),
    )


def contents(cube: DataFrame) -> DataFrame:
    """(t, n, digest): how many cells a day has, and an order-free hash of their places and values. Aggregated before
    the shuffle, so whole cubes are compared by a row a day."""
    cell = F.xxhash64("y", "x", "v").cast("decimal(38,0)")
    return cube.groupBy("t").agg(F.count("*").alias("n"), F.sum(cell).cast("string").alias("digest"))


def overlap_statistics(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row about the cells that two products share: correlation, root mean square difference, bias, share identical."""
    both = a.select("t", "y", "x", F.col("v").cast("double").alias("a")).join(b.select("t", "y", "x", F.col("v").cast("double").alias("b")), ["t", "y", "x"])
    d = F.col("a") - F.col("b")
    return both.where(~F.isnan("a") & ~F.isnan("b")).agg(
        F.count("*").alias("n"), F.corr("a", "b").alias("correlation"), F.sqrt(F.avg(d * d)).alias("rmse"), F.avg(d).alias("bias"),
        F.avg((d == 0).cast("double")).alias("identical"),
    )


def value_days(cube: DataFrame, fills: Sequence[float], kind: str = "float") -> DataFrame:
    """(v, bucket, n, n_days, days) of negative values that are no fill: ``days`` is a bitmap of the days since 1900 on which
    the value stands, 32,768 days a bucket. A value that stands on every day of a record is a row of 4 KB, whatever the
    number of its cells: bitmaps are made in each task and merged."""
    bad = cube.where((F.col("v") < 0) & ~is_fill(F.col("v"), fills, kind))
    day = days_since_epoch(F.col("t")) + 1
    days = bad.groupBy("v", F.bitmap_bucket_number(day).alias("bucket")).agg(F.count("*").alias("n"), F.bitmap_construct_agg(F.bitmap_bit_position(day)).alias("days"))
    return days.select("v", "bucket", "n", F.bitmap_count("days").alias("n_days"), "days")


def days_of_bitmap(found: DataFrame) -> DataFrame:
    """(v, t): the days that the bitmaps of `value_days` hold."""
    octet = lambda i: F.conv(F.hex(F.substring("days", i, 1)), 16, 10).cast("int")
    bytes_there = found.select("v", "bucket", F.explode(F.sequence(F.lit(1), F.length("days"))).alias("i"), "days").select("v", "bucket", "i", octet(F.col("i")).alias("byte")).where("byte > 0")
    bits = bytes_there.select("v", "bucket", "i", "byte", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("b")).where(F.expr("byte & shiftleft(1, b)") > 0)
    day = (F.col("bucket") - 1) * 32768 + (F.col("i") - 1) * 8 + F.col("b")
    return bits.select("v", F.date_add(F.lit(EPOCH).cast("date"), day.cast("int")).alias("t"))


MOMENTS = ["n", "mean_a", "mean_b", "m_aa", "m_bb", "m_ab", "m_dd", "identical"]


def overlap_moments(a: DataFrame, b: DataFrame, by: Sequence[Column | str]) -> DataFrame:
    """For each ``by`` (columns of t, y, x) the moments of the cells that two products share: n, means, centred squares and
    products, squared differences, identical cells. Stored, they stand for the cells: `merged_moments` combines them."""
    both = a.select("t", "y", "x", F.col("v").cast("double").alias("a")).join(b.select("t", "y", "x", F.col("v").cast("double").alias("b")), ["t", "y", "x"])
    d = F.col("a") - F.col("b")
    n = F.count("*")
    return both.where(~F.isnan("a") & ~F.isnan("b")).groupBy(*by).agg(
        n.alias("n"), F.avg("a").alias("mean_a"), F.avg("b").alias("mean_b"), (F.var_pop("a") * n).alias("m_aa"), (F.var_pop("b") * n).alias("m_bb"),
        (F.covar_pop("a", "b") * n).alias("m_ab"), F.sum(d * d).alias("m_dd"), F.count_if(d == 0).alias("identical"),
    )


def merged_moments(parts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The moments of several parts as of one, for each ``by``: parts of days added later join those stored before, and no
    cell is read again. A part's means are centred on the whole's, so nothing is lost to large sums."""
    n = F.sum("n")
    means = parts.groupBy(*by).agg(n.alias("n_all"), (F.sum(F.col("n") * F.col("mean_a")) / n).alias("a_all"), (F.sum(F.col("n") * F.col("mean_b")) / n).alias("b_all"))
    centred = parts.join(means, list(by)) if by else parts.join(F.broadcast(means))  # one row
    da, db = F.col("mean_a") - F.col("a_all"), F.col("mean_b") - F.col("b_all")
    return centred.groupBy(*by, "n_all", "a_all", "b_all").agg(
        F.sum(F.col("m_aa") + F.col("n") * da * da).alias("m_aa"), F.sum(F.col("m_bb") + F.col("n") * db * db).alias("m_bb"), F.sum(F.col("m_ab") + F.col("n") * da * db).alias("m_ab"),
        F.sum("m_dd").alias("m_dd"), F.sum("identical").alias("identical"),
    ).select(*by, F.col("n_all").alias("n"), F.col("a_all").alias("mean_a"), F.col("b_all").alias("mean_b"), "m_aa", "m_bb", "m_ab", "m_dd", "identical")


def statistics_of_moments(moments: DataFrame) -> DataFrame:
    """`overlap_statistics` from moments, beside the columns they are for."""
    keys = [c for c in moments.columns if c not in MOMENTS]
    return moments.select(
        *keys, "n", F.try_divide(F.col("m_ab"), F.sqrt(F.col("m_aa") * F.col("m_bb"))).alias("correlation"), F.sqrt(F.col("m_dd") / F.col("n")).alias("rmse"),
        (F.col("mean_a") - F.col("mean_b")).alias("bias"), (F.col("identical") / F.col("n")).alias("identical"),
    )
