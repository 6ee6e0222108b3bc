"""Digests in levels: what manifests say of spans of days and of rows of the grid, combined over any layout, so that two
archives of one record are compared from the top and only what differs is opened."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.tables import small_table
from .archive import Archive
from .encoding import SPAN

CELLS = "t date, y int, x int, left_v float, right_v float"


def by_day(store: Archive) -> DataFrame:
    """(t, n, footprint): of each day with a cell how many there are, and a digest of their places. No data is opened."""
    runs = store.manifest_rows().select(F.explode(F.arrays_zip("mask_from", "mask_days", "mask_cells", "mask_places")).alias("r"))
    each = runs.select(F.explode(F.sequence("r.mask_from", F.date_add("r.mask_from", F.col("r.mask_days") - 1))).alias("t"), "r.mask_cells", "r.mask_places")
    return each.groupBy("t").agg(F.sum("mask_cells").alias("n"), F.bit_xor("mask_places").alias("footprint"))


def level(store: Archive, name: str) -> DataFrame:
    """(place, digest) of the values of each span of days (``spans``) or row of the grid (``rows``)."""
    values = {"spans": "span_values", "rows": "row_values"}[name]
    each = store.manifest_rows().select(F.explode(F.arrays_zip(name, values)).alias("r"))
    return each.groupBy(F.col(f"r.{name}").alias("place")).agg(F.bit_xor(F.col(f"r.{values}")).alias("digest"))


def differing(left: Archive, right: Archive, name: str) -> list[int]:
    """Spans or rows whose values are not the same; a number each, at most as many as a record has spans or a grid rows."""
    both = level(left, name).join(level(right, name).withColumnRenamed("digest", "other"), "place", "full_outer")
    return sorted(r["place"] for r in both.where(~F.col("digest").eqNullSafe(F.col("other"))).select("place").collect())


def different_cells(left: Archive, right: Archive) -> DataFrame:
    """(t, y, x, left_v, right_v) of the cells that two archives of one grid and first day do not have alike, repeats of a
    cell included. Of each side only pieces are opened that meet a span and a row that differ."""
    spans = differing(left, right, "spans")
    rows = differing(left, right, "rows") if spans else []
    if not spans:
        return small_table(left.spark, [], CELLS)
    first = left.shape().first_day
    day = F.floor(F.datediff("t", F.lit(first)) / SPAN).cast("int")

    def cells(store: Archive, value: str) -> DataFrame:
        start = F.date_add(F.lit(first), spans[0] * SPAN)
        end = F.date_add(F.lit(first), (spans[-1] + 1) * SPAN)
        box = store.read(t0=start, t1=end, y=(rows[0], rows[-1] + 1) if rows else None)
        inside = box.where(day.isin(spans))
        inside = inside.where(F.col("y").isin(rows)) if rows else inside
        return inside.groupBy("t", "y", "x", "v").agg(F.count("*").alias("n")).select("t", "y", "x", F.col("v").alias(value), "n")

    a, b = cells(left, "left_v"), cells(right, "right_v")
    both = a.join(b, (F.col("left_v") == F.col("right_v")) & (a["n"] == b["n"]) & (a["t"] == b["t"]) & (a["y"] == b["y"]) & (a["x"] == b["x"]), "full_outer")
    odd = both.where(a["t"].isNull() | b["t"].isNull())
    one = odd.select(F.coalesce(a["t"], b["t"]).alias("t"), F.coalesce(a["y"], b["y"]).alias("y"), F.coalesce(a["x"], b["x"]).alias("x"), "left_v", "right_v")
    return one.groupBy("t", "y", "x").agg(F.max("left_v").alias("left_v"), F.max("right_v").alias("right_v"))
