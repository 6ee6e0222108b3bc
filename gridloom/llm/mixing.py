"""Mixing sources to target weights by hash-threshold histograms; DataFrame functions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored, table

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
WORD = r"[^\x20\x09-\x0D]+"
#: Hex digits of md5(doc_id) that one histogram resolves, and histograms after another: 36 bits in all.
DIGITS, LEVELS = 3, 3


def source_targets(sizes: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """Per source (rank, source, source_size, target, base, rest): weights dealt by code point order, null last.

    Sharing the total by weight, stopping each at ``most`` times its size and resharing the excess until none is above
    comes to min(most * size, level * weight) with one common level. Sorted by (most * size / weight), the stopped
    sources are a prefix, so one running sum finds the level. ``sizes`` has a row per source only.
    """
    by_point = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    weighed = sizes.withColumn("at", F.row_number().over(by_point) - 1).withColumn(
        "weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("at") % len(weights) + 1).cast("int"))
    )
    by_ratio = Window.orderBy(F.col("source_size") / F.col("weight"), "at")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum("source_size").over(everything)
    stopped = F.coalesce(F.sum(F.lit(most) * F.col("source_size")).over(before), F.lit(0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    level = (total - stopped).cast("double") / open_weight  # if this source and all after it are open
    cap = (F.lit(most) * F.col("source_size")).cast("double")
    levelled = weighed.select("*", level.alias("level"), cap.alias("cap"))
    is_open = F.col("level") * F.col("weight") <= F.col("cap")
    first_open = F.first(F.when(is_open, F.col("level")), ignorenulls=True).over(everything)
    target = F.when(is_open, first_open * F.col("weight")).otherwise(F.col("cap"))
    shared = levelled.select("at", "source", "source_size", F.least(target, "cap").alias("target"))
    base = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    return shared.withColumn("base", base).withColumn("rest", F.col("target") - F.col("base") * F.col("source_size"))


def mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS, *, keep_text: bool = False
) -> DataFrame:
    """doc_id, source, size, source_size, target, copies and taken (= size * copies) of every document, with
    ``keep_text`` also ``doc``, a struct of all its columns.

    Every document of a source is taken ``base`` times; the rest of the target goes once more to the documents whose
    hash lies below the source's threshold. Histograms of words by source and hash bucket find it: the first level's
    running sum names the bucket in which the rest runs out, the next level splits that bucket alone. Nothing is
    sorted, each level's table has 4,096 rows a source at most. The last bucket is taken if that comes nearer the
    target, so a source misses it by half of one document at most.

    A null text has size 0; null is a source of its own, the last; documents with equal ids share a hash and are taken
    together; an empty table gives an empty one. The hash is md5 of the id, so reruns agree.
    """
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    parts = [F.substring("digest", 1 + DIGITS * i, DIGITS).alias(f"b{i}") for i in range(LEVELS)]
    sized = docs.select("doc_id", "source", size.alias("size"), digest.alias("digest"))
    slim = stored(sized.select("doc_id", "source", "size", *parts), "mix-sizes")
    sizes = slim.groupBy("source").agg(F.sum("size").alias("source_size"))
    edges = stored(source_targets(sizes, weights, most).withColumn("taken_before", F.lit(0).cast("long")), "mix-edges")

    for level in range(LEVELS):
        known = [f"b{i}" for i in range(level)]
        of_edge = reduce(lambda on, b: on & (F.col(f"r.{b}") == F.col(f"e.{b}")), known, F.col("r.source").eqNullSafe(F.col("e.source")))
        histogram = (
            slim.alias("r").join(edges.alias("e"), of_edge)
            .groupBy("e.at", f"r.b{level}").agg(F.sum("r.size").alias("words"))
        )
        over = Window.partitionBy("at").orderBy(f"b{level}").rowsBetween(Window.unboundedPreceding, 0)
        running = histogram.withColumn("through", F.sum("words").over(over))
        reached = running.join(edges.select("at", "rest", "taken_before"), "at").where(
            F.col("taken_before") + F.col("through") > F.col("rest")
        )
        edge = reached.groupBy("at").agg(
            F.min(F.struct(f"b{level}", (F.col("taken_before") + F.col("through") - F.col("words")).alias("taken_before"), "words")).alias("edge")
        )
        # A source whose rest is nothing beyond its documents has no edge: its threshold is above every hash.
        edges = stored(
            edges.drop("taken_before").join(edge, "at", "left")
            .select(*[c for c in edges.columns if c not in ("taken_before", "edge_words")], f"edge.b{level}", "edge.taken_before", F.col("edge.words").alias("edge_words")),
            f"mix-edges-{level}",
        )

    threshold = F.concat(*[f"b{i}" for i in range(LEVELS)])
    with_edge = (F.col("taken_before") + F.col("edge_words") - F.col("rest")) < (F.col("rest") - F.col("taken_before"))
    cuts = edges.select(
        F.col("source").alias("of"), "source_size", "target", "base", "rest",
        threshold.alias("threshold"), F.coalesce(with_edge, F.lit(False)).alias("with_edge"),
    )
    sized = docs.select(F.struct("*").alias("doc"), "doc_id", "source", size.alias("size"), digest.alias("digest"))
    rows = sized if keep_text else slim.withColumn("digest", threshold)
    own = F.substring("digest", 1, DIGITS * LEVELS)
    once_more = (F.col("rest") > 0) & (
        F.col("threshold").isNull() | (own < F.col("threshold")) | ((own == F.col("threshold")) & F.col("with_edge"))
    )
    copies = F.least(F.col("base") + once_more.cast("long"), F.lit(most))
    mixed = rows.join(cuts, F.col("source").eqNullSafe(F.col("of"))).withColumn("copies", copies)
    return mixed.select(*["doc"] * keep_text, "doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix itself: each document as often as it is taken; documents without words add nothing and stay once."""
    times = F.when(F.col("size") == 0, F.lit(1)).otherwise(F.col("copies")).cast("int")
    each = F.when(times > 0, F.sequence(F.lit(1), times)).otherwise(F.array().cast("array<int>"))
    return mix(docs, keep_text=True).withColumn("copy", F.explode(each)).select("doc.*")


OP7_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 9) AS h
  FROM documents),
sizes AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1 AS place
  FROM sized GROUP BY source),
weighed AS (SELECT *, CASE place % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM sizes),
levelled AS (
  SELECT *, CAST((sum(source_size) OVER ()
      - coalesce(sum(3 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS DOUBLE)
    / (sum(weight) OVER () - coalesce(sum(weight) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level,
    CAST(3 * source_size AS DOUBLE) AS cap
  FROM weighed WINDOW o AS (ORDER BY CAST(source_size AS DOUBLE) / weight, place)),
opened AS (
  SELECT *, level * weight <= cap AS is_open,
    (SELECT arg_min(level, CAST(source_size AS DOUBLE) / weight) FROM levelled WHERE level * weight <= cap) AS common
  FROM levelled),
shared AS (
  SELECT source, source_size, least(CASE WHEN is_open THEN common * weight ELSE cap END, cap) AS target FROM opened),
based AS (
  SELECT *, CAST(CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS BIGINT) AS base FROM shared),
rests AS (SELECT *, target - base * source_size AS rest FROM based),
atoms AS (SELECT source, h, sum(size) AS words FROM sized GROUP BY ALL),
running AS (
  SELECT a.*, sum(words) OVER (PARTITION BY source ORDER BY h ROWS UNBOUNDED PRECEDING) AS through FROM atoms a),
chosen AS (
  SELECT r.source, r.h, t.rest > 0 AND (r.through <= t.rest
      OR (r.through - words <= t.rest AND r.through - t.rest < t.rest - (r.through - words))) AS more
  FROM running r JOIN rests t ON r.source IS NOT DISTINCT FROM t.source)
SELECT s.doc_id, s.size, t.source_size, t.target,
       CAST(s.size * least(t.base + CAST(c.more AS BIGINT), 3) AS BIGINT) AS taken
FROM sized s JOIN rests t ON s.source IS NOT DISTINCT FROM t.source
JOIN chosen c ON s.source IS NOT DISTINCT FROM c.source AND s.h = c.h
"""
