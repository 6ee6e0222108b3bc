"""Small tables of what the driver knows."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def small_table(spark: SparkSession, rows: Sequence[Sequence], schema: str) -> DataFrame:
    """A few rows as a local relation: no task and no Python worker is needed to read it."""
    kinds = to_arrow_schema(StructType.fromDDL(schema))
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
    table = pa.Table.from_arrays([pa.array(list(c), k.type) for c, k in zip(columns, kinds, strict=True)], schema=kinds)
    return spark.createDataFrame(table, StructType.fromDDL(schema))
