"""Chunks, blocks and batches: what is stored together, what is written together, what is still to write."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.naming import batch_size, block_of_message


def chunks(cube: DataFrame, by: list[str]) -> DataFrame:
    """One row a chunk: its cells as arrays in (t, y, x) order. A chunk whose cells are all NaN has no row.

    ``by`` must bound a chunk's size, as days and tiles do.
    """
    inner = [c for c in ("t", "y", "x") if c not in by]
    listed = F.array_sort(F.collect_list(F.struct(*inner, "v")))
    packed = cube.groupBy(*by).agg(listed.alias("cells"), F.bool_and(F.isnan("v")).alias("is_fill"))
    return packed.where(~F.col("is_fill")).drop("is_fill").withColumn("n_cells", F.size("cells"))


def cells(chunked: DataFrame) -> DataFrame:
    """The cells of chunks, one row each."""
    keys = [c for c in chunked.columns if c not in ("cells", "n_cells")]
    return chunked.select(*keys, F.inline("cells"))


def plan(cube: DataFrame, variables: list[str], ny: int, nx: int) -> DataFrame:
    """(variable, y0, y1, x0, x1): the blocks of the cube's extent, the last ones clipped."""
    ends = cube.agg((F.max("y") + 1).alias("ny"), (F.max("x") + 1).alias("nx")).where("ny is not null")
    rows = ends.select("*", F.explode(F.sequence(F.lit(0), F.col("ny") - 1, F.lit(ny))).alias("y0"))
    both = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("nx") - 1, F.lit(nx))).alias("x0"))
    named = both.select("*", F.explode(F.array(*map(F.lit, variables))).alias("variable"))
    return named.select(
        "variable", F.col("y0").cast("int").alias("y0"), F.least(F.col("y0") + ny, "ny").cast("int").alias("y1"),
        F.col("x0").cast("int").alias("x0"), F.least(F.col("x0") + nx, "nx").cast("int").alias("x1"),
    )


KEY = ["variable", "y0", "y1", "x0", "x1"]


def committed(messages: DataFrame) -> DataFrame:
    """The blocks that commit messages name; other messages fall away."""
    parts = block_of_message(F.col("message"))
    return messages.select(*[parts[c].alias(c) for c in KEY]).where("variable is not null").distinct()


def remaining(planned: DataFrame, messages: DataFrame) -> DataFrame:
    return planned.join(committed(messages), KEY, "left_anti")


def stray(planned: DataFrame, messages: DataFrame) -> DataFrame:
    """Committed blocks that the plan does not have: written under another block shape."""
    return committed(messages).join(planned, KEY, "left_anti")


def batches(days: DataFrame, target: int, chunk: int) -> DataFrame:
    """(batch, start, stop, first_day, last_day, n_days): the axis in commits of whole chunks; the last may be short."""
    size = batch_size(F.lit(target), F.lit(chunk))
    placed = days.select("t").distinct().select("t", (F.row_number().over(Window.orderBy("t")) - 1).cast("long").alias("place"))
    return placed.groupBy(F.floor(F.col("place") / size).alias("batch")).agg(
        F.min("place").alias("start"), (F.max("place") + 1).alias("stop"), F.min("t").alias("first_day"), F.max("t").alias("last_day"), F.count("*").alias("n_days")
    )
