"""The time axis: the complete one, what is missing, the gate that declared gaps must pass, densification."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


class CoverageError(ValueError):
    """The days that are missing are not those declared missing."""


def days(df: DataFrame, column: str) -> DataFrame:
    """(t) of every row as a date."""
    return df.select(F.to_date(column).alias("t"))


def complete_axis(present: DataFrame) -> DataFrame:
    """(t): every day from the first to the last present one. Empty input gives no day."""
    ends = present.agg(F.min("t").alias("a"), F.max("t").alias("b")).where("a is not null")
    return ends.select(F.explode(F.sequence("a", "b")).alias("t"))


def missing_days(present: DataFrame) -> DataFrame:
    return complete_axis(present).join(present.select("t").distinct(), "t", "left_anti")


def duplicate_days(present: DataFrame) -> DataFrame:
    return present.groupBy("t").agg(F.count("*").alias("n")).where("n > 1")


def coverage(present: DataFrame, declared: DataFrame) -> DataFrame:
    """(t, finding): days missing but not declared, and days declared missing that are there."""
    missing = missing_days(present)
    undeclared = missing.join(declared, "t", "left_anti").withColumn("finding", F.lit("undeclared"))
    recovered = declared.join(missing, "t", "left_anti").withColumn("finding", F.lit("recovered"))
    return undeclared.unionByName(recovered)


def check_coverage(present: DataFrame, declared: DataFrame) -> None:
    """Refuse unless no day is doubled and what is missing equals what is declared; names up to ten of each."""
    doubled = [str(r["t"]) for r in duplicate_days(present).orderBy("t").limit(10).collect()]
    if doubled:
        raise CoverageError(f"days with more than one file: {doubled}")
    named = coverage(present, declared).groupBy("finding").agg(F.slice(F.array_sort(F.collect_list("t")), 1, 10).alias("days"))  # of a row a day
    found = {r["finding"]: r["days"] for r in named.collect()}
    said = [f"{kind}: {[str(t) for t in found[kind]]}" for kind in ("undeclared", "recovered") if kind in found]
    if said:
        raise CoverageError("; ".join(said))


def densify(series: DataFrame, axis: DataFrame) -> DataFrame:
    """``series`` on ``axis``, with is_gap where it has no row."""
    marked = series.withColumn("_there", F.lit(True))
    return axis.join(marked, "t", "left").withColumn("is_gap", F.col("_there").isNull()).drop("_there")


def steps(axis: DataFrame) -> DataFrame:
    """(t, step): days since the one before. One row a day of the record, whatever the grid's size."""
    by_day = Window.orderBy("t")
    return axis.select("t").distinct().select("t", F.datediff("t", F.lag("t").over(by_day)).alias("step"))


def check_regular(axis: DataFrame) -> int | None:
    """The one step of a regular axis, None of an axis of one day; refuses an irregular one."""
    found = [r["step"] for r in steps(axis).where("step is not null").select("step").distinct().limit(2).collect()]
    if len(found) > 1:
        raise ValueError(f"the axis has steps of {sorted(found)} days")
    return found[0] if found else None


def gap_islands(missing: DataFrame) -> DataFrame:
    """(first_day, last_day, n_days) of each run of missing days."""
    island = F.date_sub("t", F.row_number().over(Window.orderBy("t")))
    return (
        missing.select("t", island.alias("island")).groupBy("island")
        .agg(F.min("t").alias("first_day"), F.max("t").alias("last_day"), F.count("*").alias("n_days")).drop("island")
    )


def axis_differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """(t, side): days that only one axis has; empty if they are equal, repeats counted."""
    only = lambda x, y, side: x.select("t").exceptAll(y.select("t")).withColumn("side", F.lit(side))
    return only(a, b, "left").unionByName(only(b, a, "right"))


def check_prefix(stored: DataFrame, wanted: DataFrame) -> None:
    """A resumed build must hold the first days of the axis it goes on with."""
    n = stored.count()
    head = wanted.orderBy("t").limit(n)
    if n and not axis_differences(stored, head).isEmpty():
        raise ValueError("the stored axis is not the beginning of the new one")


@dataclass(frozen=True)
class Bounds:
    first: object
    last: object
    days: int


def bounds(axis: DataFrame) -> Bounds:
    r = axis.agg(F.min("t").alias("a"), F.max("t").alias("b"), F.count_distinct("t").alias("n")).first()
    return Bounds(r["a"], r["b"], r["n"])
