"""The cubes that the registered queries run on, made of the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NY, NX, EDGE = 60, 40, 20
CORNER, CORNER_FILL = 15, -239976.0


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def exact_sum(column: str) -> Column:
    """A sum in decimals, so that its value does not hang on the order of the rows."""
    return F.sum(F.col(column).cast("decimal(18,2)")).cast("double")


def order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("t"))


def order_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders")
    return orders.groupBy(
        F.to_date("o_orderdate").alias("t"), (F.col("o_custkey") % NY).cast("int").alias("y"), (F.col("o_orderkey") % NX).cast("int").alias("x")
    ).agg(exact_sum("o_totalprice").alias("v"))


def line_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "lineitem")
    return lines.groupBy(
        F.to_date("l_shipdate").alias("t"), (F.col("l_partkey") % NY).cast("int").alias("y"), (F.col("l_suppkey") % NX).cast("int").alias("x")
    ).agg(exact_sum("l_quantity").cast("float").alias("v"))


def corner_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """line_cube with a corner that holds an undeclared fill value on every day."""
    corner = (F.col("y") < CORNER) & (F.col("x") < CORNER)
    return line_cube(spark, sf_dir).withColumn("v", F.when(corner, F.lit(CORNER_FILL).cast("float")).otherwise(F.col("v")))


ORDER_CUBE = f"""order_cube AS (
  SELECT CAST(o_orderdate AS DATE) AS t, CAST(o_custkey % {NY} AS INTEGER) AS y, CAST(o_orderkey % {NX} AS INTEGER) AS x,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS v FROM orders GROUP BY 1, 2, 3)"""
LINE_CUBE = f"""line_cube AS (
  SELECT CAST(l_shipdate AS DATE) AS t, CAST(l_partkey % {NY} AS INTEGER) AS y, CAST(l_suppkey % {NX} AS INTEGER) AS x,
         CAST(CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS FLOAT) AS v FROM lineitem GROUP BY 1, 2, 3)"""
CORNER_CUBE = LINE_CUBE + f""", corner_cube AS (
  SELECT t, y, x, CASE WHEN y < {CORNER} AND x < {CORNER} THEN CAST({CORNER_FILL} AS FLOAT) ELSE v END AS v FROM line_cube)"""
AXIS = """axis AS (
  SELECT CAST(unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)), INTERVAL 1 DAY)) AS DATE) AS t FROM orders),
present AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS t FROM orders),
missing AS (SELECT t FROM axis WHERE t NOT IN (SELECT t FROM present))"""
