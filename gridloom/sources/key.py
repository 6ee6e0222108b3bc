"""The nomenclature key: pipe tables in a markdown text, read as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.attributes import look_up


def pipe_rows(spark: SparkSession, path: str) -> DataFrame:
    """(table, at, header, cells) of every row of every pipe table of a text: a table is lines in a row that begin with a
    bar, its first line the header. Backticks are off, separator lines left out. A key is a page of text."""
    by_line = Window.orderBy("at")
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", r"\r?\n")).alias("at", "line")).withColumn("line", F.trim("line"))
    numbered = lines.withColumn("table", F.count_if(~F.col("line").startswith("|")).over(by_line)).where(F.col("line").startswith("|"))
    inner = F.regexp_replace("line", r"^\|+|\|+$", "")
    cells = F.transform(F.split(inner, r"\|"), lambda c: F.regexp_replace(c, r"^[\s`]+|[\s`]+$", ""))
    rows = numbered.select("table", "at", cells.alias("cells")).where(~F.forall("cells", lambda c: c.rlike("^[-: ]*$")))
    of_table = Window.partitionBy("table").orderBy("at")
    return rows.select("table", "at", F.first("cells").over(of_table).alias("header"), "cells", F.row_number().over(of_table).alias("n")).where("n > 1").drop("n")


def key_table(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """The one table that has ``columns``. Refuses none or several, an incomplete row, and a canonical name twice."""
    wanted = F.array(*map(F.lit, columns))
    rows = pipe_rows(spark, path).where(F.size(F.array_except(wanted, "header")) == 0)
    n = rows.select("table").distinct().count()
    if n != 1:
        raise ValueError(f"{n} tables have the columns {columns}")
    cell = lambda c: F.get("cells", F.array_position("header", c).cast("int") - 1)
    empty = F.exists(F.array(*[F.coalesce(cell(c), F.lit("")) for c in columns]), lambda v: v == "")
    short = [r["cells"] for r in rows.where((F.size("cells") != F.size("header")) | empty).orderBy("at").limit(3).collect()]
    if short:
        raise ValueError(f"incomplete rows: {short}")
    table = rows.orderBy("at").select(*[cell(c).alias(c) for c in columns])
    if not table.groupBy("canonical_name").count().where("count > 1").isEmpty():
        raise ValueError("a canonical name stands twice")
    return table


def canonical(names: DataFrame, key: DataFrame, original: str) -> DataFrame:
    """(original, canonical) of names; an unknown one is refused."""
    found = look_up(names, key.select(F.col(original).alias("original"), F.col("canonical_name").alias("canonical")))
    unknown = [r["original"] for r in found.where(~F.col("known")).limit(5).collect()]
    if unknown:
        raise ValueError(f"names that the key does not have: {unknown}")
    return found.select("original", "canonical")


def original(names: DataFrame, table: DataFrame, column: str) -> DataFrame:
    """(canonical, original) of canonical names by a key table, the way back of `canonical`; refused, by name, where the
    table has none or several originals for one."""
    key = table.select(F.col("canonical_name").alias("canonical"), F.col(column).alias("original"))
    found = names.select("canonical").distinct().join(key, "canonical", "left").groupBy("canonical").agg(F.collect_set("original").alias("all"))
    wrong = [f"{r['canonical']}: {sorted(r['all'])}" for r in found.where(F.size("all") != 1).orderBy("canonical").limit(10).collect()]
    if wrong:
        raise ValueError(f"names without one original: {wrong}")
    return found.select("canonical", F.col("all")[0].alias("original"))
