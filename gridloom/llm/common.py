"""What the operators of this subpackage share: the shared folder, written tables, tiles of a query set."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: What a Python worker turns into objects at a time.
SLICE_BYTES, SLICE_ROWS = 1 << 20, 1000


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``. Where that is unset, a local folder
    serves a local session; on a cluster there is none that all machines see, so it is refused."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="gridloom-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The lineage ends there, so a lost executor never costs more than the stage at work, and Catalyst plans what
    follows from the files' real size.
    """
    path = f"{shared_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back.stored_at = path
    return back


def discard(*tables: DataFrame) -> None:
    """Delete tables that `stored` wrote and that nothing later will read."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def spread_join(rows: DataFrame, facts: DataFrame, key: str, by: str) -> DataFrame:
    """``rows`` with the columns of ``facts``, which has a row for each ``key`` at most; rows without one fall away.

    However many rows have the same key, no task gets them all: they are dealt over as many parts as there are shuffle
    partitions, by a hash of the column ``by``, and the key's facts go to each part that has a row of it.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.withColumn("_part", F.pmod(F.xxhash64(by), F.lit(parts)).cast("int"))
    needed = dealt.select(key, "_part").distinct().join(facts, key)
    return dealt.join(needed, [key, "_part"]).drop("_part")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def sliced(batch: pa.RecordBatch, names: list[str], size: int = SLICE_BYTES, rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose columns ``names`` have about ``size`` bytes, of at most ``rows`` rows."""
    sizes = sum(np.asarray(pc.fill_null(pc.binary_length(batch.column(x)), 0)).astype(np.int64) for x in names)
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // size)) + 1
    for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
        for at in range(start, end, rows):
            yield batch.slice(at, min(rows, end - at))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(doc_id: str | Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``: the split into folds."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % divisor


def usable_vectors(df: DataFrame, dim: int) -> DataFrame:
    """(vec_id, variant, embedding, n) of the rows that take part: an id, and ``dim`` finite components.

    Rows of the same id and vector are one row with their number n; rows of the same id and different vectors stay
    apart by ``variant``, a hash of the vector.
    """
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = df.select("vec_id", "embedding").where(F.col("vec_id").isNotNull() & (F.size("embedding") == dim) & finite)
    return usable.groupBy("vec_id", "embedding").agg(F.count("*").alias("n")).select("vec_id", F.xxhash64("embedding").alias("variant"), "embedding", "n")


@dataclass(frozen=True)
class Tiles:
    """How a query set and the rows it is held against are dealt into tiles of bounded size: each query block meets each
    row block once. What is copied is (number of row blocks) x queries plus (number of query blocks) x rows, so blocks
    are as large as a task can hold."""

    q_blocks: int
    r_blocks: int

    @staticmethod
    def of(queries: DataFrame, rows: DataFrame, query_rows: int, tile_rows: int) -> Tiles:
        return Tiles(max(1, -(-queries.count() // query_rows)), max(1, -(-rows.count() // tile_rows)))

    def deal(self, queries: DataFrame, rows: DataFrame, home: bool | None = None):
        """The cogroup of all tiles; with ``home`` only those of each query block's own row block, or all but those."""
        block = lambda n: F.pmod(F.xxhash64("vec_id", "variant"), F.lit(n)).cast("int")
        others = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        # Queries are of the same table as the rows: aliases tell the sides' columns apart.
        queries = queries.select(*[F.col(c).alias(c) for c in queries.columns])
        left = queries.withColumn("q_block", block(self.q_blocks)).withColumn("r_block", others(self.r_blocks))
        right = rows.withColumn("r_block", block(self.r_blocks)).withColumn("q_block", others(self.q_blocks))
        if home is not None:
            at_home = F.pmod("q_block", F.lit(self.r_blocks)) == F.col("r_block")
            left, right = (x.where(at_home if home else ~at_home) for x in (left, right))
        return left.groupBy("q_block", "r_block").cogroup(right.groupBy("q_block", "r_block"))


#: What a tile finds: a query row (and how often it stands), a row near it (and how often), their score.
FOUND = "query_id long, query_variant long, query_n long, vec_id long, variant long, n long, score "


def of_tile(q: pd.DataFrame, c: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray]:
    """(candidates by id and variant, for each query the place of its own row, -1 if it is not there or stands there
    more than once: a query is no candidate of itself, but its other copies are)."""
    c = c.sort_values(["vec_id", "variant"], ignore_index=True)
    at = {key: i for i, key in enumerate(zip(c["vec_id"].tolist(), c["variant"].tolist(), strict=True))}
    once = (c["n"] == 1).tolist()
    own = [at.get(key, -1) for key in zip(q["vec_id"].tolist(), q["variant"].tolist(), strict=True)]
    return c, np.array([i if i >= 0 and once[i] else -1 for i in own], np.int64)


def found_of_tile(q: pd.DataFrame, c: pd.DataFrame, i: np.ndarray, j: np.ndarray, scores: np.ndarray) -> pd.DataFrame:
    """The table FOUND of query rows ``i`` and candidate rows ``j``."""
    ids = lambda df, name, at: df[name].to_numpy(np.int64)[at]
    same = (ids(q, "vec_id", i) == ids(c, "vec_id", j)) & (ids(q, "variant", i) == ids(c, "variant", j))
    return pd.DataFrame({
        "query_id": ids(q, "vec_id", i), "query_variant": ids(q, "variant", i), "query_n": ids(q, "n", i), "vec_id": ids(c, "vec_id", j),
        "variant": ids(c, "variant", j), "n": ids(c, "n", j) - same, "score": scores,
    })


def nearest_first(found: DataFrame, k: int) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k highest scores of each query row over what all tiles found, ties to
    the smaller vec_id; rows that stand several times count as often.

    Ranks above k go before the shuffle, in every task and again after it, so no query's finds come together whole.
    """
    by = ["query_id", "query_variant"]
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id", "variant")
    rank = F.row_number().over(order)
    first = found.withColumn("rank", rank).where(F.col("rank") <= k)
    each = first.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least("n", F.lit(k)).cast("int"))))
    ranked = each.withColumn("rank", rank).where(F.col("rank") <= k)
    per_row = ranked.withColumn("query_copy", F.explode(F.sequence(F.lit(1), F.col("query_n").cast("int"))))
    return per_row.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
