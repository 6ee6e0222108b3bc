"""Registered queries: each applies operators of this package to the given tables; SQL says the same in DuckDB."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import naming
from ..functions.tables import small_table
from ..functions.cells import NAN
from ..sources import raw
from ..operators import attributes, audit, axis, blocks, grid, levels
from . import cubes, stores
from .cubes import CORNER_FILL, EDGE, NX, NY

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

FILLS = [-9999.0, CORNER_FILL]
DECLARED = ("1997-10-25", "1998-05-23", "2001-01-01")
DECLARED_SQL = "declared AS (SELECT unnest([DATE '1997-10-25', DATE '1998-05-23', DATE '2001-01-01']) AS t)"


def query(sql: str):
    """Register the function under its name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return add


def text(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


# The axis


@query(f"WITH {cubes.AXIS} SELECT CAST(t AS VARCHAR) AS t FROM axis")
def axis_complete(spark, sf_dir):
    return axis.complete_axis(cubes.order_days(spark, sf_dir)).select(text("t").alias("t"))


@query(f"WITH {cubes.AXIS} SELECT CAST(t AS VARCHAR) AS t FROM missing")
def axis_missing_days(spark, sf_dir):
    return axis.missing_days(cubes.order_days(spark, sf_dir)).select(text("t").alias("t"))


def declared_days(days: DataFrame) -> DataFrame:
    """The gaps that a config declares, whatever days there are."""
    return small_table(days.sparkSession, [(dt.date.fromisoformat(d),) for d in DECLARED], "t date")


@query(f"""WITH {cubes.AXIS}, {DECLARED_SQL}
SELECT CAST(t AS VARCHAR) AS t, 'undeclared' AS finding FROM missing WHERE t NOT IN (SELECT t FROM declared)
UNION ALL SELECT CAST(t AS VARCHAR), 'recovered' FROM declared WHERE t NOT IN (SELECT t FROM missing)""")
def coverage_gate(spark, sf_dir):
    days = cubes.order_days(spark, sf_dir)
    return axis.coverage(days, declared_days(days)).select(text("t").alias("t"), "finding")


@query("SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS t, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 1")
def coverage_duplicates(spark, sf_dir):
    return axis.duplicate_days(cubes.order_days(spark, sf_dir)).select(text("t").alias("t"), "n")


@query(f"""WITH {cubes.AXIS}, daily AS (
  SELECT CAST(o_orderdate AS DATE) AS t, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders GROUP BY 1)
SELECT CAST(a.t AS VARCHAR) AS t, total, d.t IS NULL AS is_gap FROM axis a LEFT JOIN daily d ON a.t = d.t""")
def daily_densified(spark, sf_dir):
    daily = cubes.read(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("t")).agg(cubes.exact_sum("o_totalprice").alias("total"))
    return axis.densify(daily, axis.complete_axis(daily)).select(text("t").alias("t"), "total", "is_gap")


@query("""WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS t FROM orders),
s AS (SELECT t - lag(t) OVER (ORDER BY t) AS step FROM d)
SELECT CAST(step AS INTEGER) AS step, count(*) AS n FROM s WHERE step IS NOT NULL GROUP BY 1""")
def axis_step_regularity(spark, sf_dir):
    return axis.steps(cubes.order_days(spark, sf_dir)).where("step is not null").groupBy("step").agg(F.count("*").alias("n"))


@query(f"""WITH {cubes.AXIS}, i AS (SELECT t, t - CAST(row_number() OVER (ORDER BY t) AS INTEGER) AS island FROM missing)
SELECT CAST(min(t) AS VARCHAR) AS first_day, CAST(max(t) AS VARCHAR) AS last_day, count(*) AS n_days FROM i GROUP BY island""")
def gap_islands(spark, sf_dir):
    found = axis.gap_islands(axis.missing_days(cubes.order_days(spark, sf_dir)))
    return found.select(text("first_day").alias("first_day"), text("last_day").alias("last_day"), "n_days")


@query("""WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS t FROM orders),
s AS (SELECT t, strftime(t, '%Y%j') AS stamp FROM d),
b AS (SELECT t, stamp, make_date(CAST(substr(stamp, 1, 4) AS INTEGER), 1, 1) + CAST(substr(stamp, 5) AS INTEGER) - 1 AS day FROM s)
SELECT stamp, CAST(day AS VARCHAR) AS day, day = t AS same FROM b""")
def doy_stamp_roundtrip(spark, sf_dir):
    stamped = cubes.order_days(spark, sf_dir).distinct().select("t", naming.stamp_of(F.col("t")).alias("stamp"))
    back = naming.day_of_stamp(F.col("stamp"))
    return stamped.select("stamp", text(back).alias("day"), (back == F.col("t")).alias("same"))


@query("SELECT DISTINCT CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS t, CAST(CAST(l_shipdate AS DATE) - DATE '1900-01-01' AS BIGINT) AS days FROM lineitem")
def days_since_1900(spark, sf_dir):
    t = axis.days(cubes.read(spark, sf_dir, "lineitem"), "l_shipdate").distinct()
    return t.select(text("t").alias("t"), naming.days_since_epoch(F.col("t")).alias("days"))


@query(f"""WITH {cubes.AXIS}, a AS (SELECT * FROM present), b AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS t FROM lineitem)
SELECT CAST(t AS VARCHAR) AS t, 'left' AS side FROM a WHERE t NOT IN (SELECT t FROM b)
UNION ALL SELECT CAST(t AS VARCHAR), 'right' FROM b WHERE t NOT IN (SELECT t FROM a)""")
def axis_equality(spark, sf_dir):
    lines = axis.days(cubes.read(spark, sf_dir, "lineitem"), "l_shipdate").distinct()
    return axis.axis_differences(cubes.order_days(spark, sf_dir).distinct(), lines).select(text("t").alias("t"), "side")


# Masks and guards


@query(f"""WITH {cubes.CORNER_CUBE} SELECT CAST(t AS VARCHAR) AS t, count(*) FILTER (v = {CORNER_FILL}) AS n_masked,
count(*) FILTER (v <> {CORNER_FILL}) AS n_kept FROM corner_cube GROUP BY t""")
def mask_sentinel(spark, sf_dir):
    cube = grid.masked(cubes.corner_cube(spark, sf_dir), FILLS)
    return cube.groupBy("t").agg(F.count_if(F.isnan("v")).alias("n_masked"), F.count_if(~F.isnan("v")).alias("n_kept")).select(text("t").alias("t"), "n_masked", "n_kept")


@query(f"""WITH {cubes.CORNER_CUBE}, f AS (SELECT * FROM corner_cube WHERE t = (SELECT min(t) FROM corner_cube)), k AS (SELECT unnest([-9999.0, {CORNER_FILL}]) AS fill)
SELECT CAST(fill AS DOUBLE) AS fill, count(*) FILTER (v = CAST(fill AS FLOAT)) AS n, 100 * CAST(count(*) FILTER (v = CAST(fill AS FLOAT)) AS DOUBLE) / count(*) AS percent
FROM f, k GROUP BY fill""")
def sentinel_occurrence(spark, sf_dir):
    return grid.fill_occurrence(cubes.corner_cube(spark, sf_dir), FILLS)


@query("""SELECT c_acctbal AS v, count(*) AS n, min(c_custkey) AS first_t, max(c_custkey) AS last_t FROM customer
WHERE c_acctbal < 0 AND c_acctbal NOT IN (-9999.0, -239976.0) GROUP BY 1""")
def undeclared_negatives(spark, sf_dir):
    cells = cubes.read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("t"), F.col("c_acctbal").alias("v"))
    return grid.undeclared_negatives(cells, FILLS, "double")


@query(f"""WITH {cubes.ORDER_CUBE} SELECT count(v) AS n_finite, min(v) AS v_min, max(v) AS v_max,
count(*) FILTER (v < 0) AS below, count(*) FILTER (v > 200000) AS above FROM order_cube""")
def range_bounds(spark, sf_dir):
    return grid.physical_range(cubes.order_cube(spark, sf_dir), ceiling=200_000.0)


@query(f"""WITH {cubes.CORNER_CUBE} SELECT CAST(y // {EDGE} AS INTEGER) AS ty, CAST(x // {EDGE} AS INTEGER) AS tx,
bool_or(v <> {CORNER_FILL}) AS any_valid, count(*) FILTER (v <> {CORNER_FILL}) AS n_valid FROM corner_cube GROUP BY 1, 2""")
def tile_any_valid(spark, sf_dir):
    return grid.tiles_with_data(cubes.corner_cube(spark, sf_dir), EDGE, FILLS)


@query(f"""WITH {cubes.LINE_CUBE}, {cubes.ORDER_CUBE},
d AS (SELECT DISTINCT t, CAST(y // {EDGE} AS INTEGER) AS ty, CAST(x // {EDGE} AS INTEGER) AS tx FROM line_cube),
w AS (SELECT DISTINCT t, CAST(y // {EDGE} AS INTEGER) AS ty, CAST(x // {EDGE} AS INTEGER) AS tx FROM order_cube)
SELECT CAST(t AS VARCHAR) AS t, ty, tx FROM d ANTI JOIN w USING (t, ty, tx)""")
def tile_unwritten_with_data(spark, sf_dir):
    tiles = lambda cube: cube.select("t", *grid.tile(EDGE)).distinct()
    gone = tiles(cubes.line_cube(spark, sf_dir)).join(tiles(cubes.order_cube(spark, sf_dir)), ["t", "ty", "tx"], "left_anti")
    return gone.select(text("t").alias("t"), "ty", "tx")


@query(f"""WITH {cubes.AXIS}, {cubes.ORDER_CUBE}, n AS (SELECT t, count(*) AS n FROM order_cube GROUP BY 1)
SELECT CAST(a.t AS VARCHAR) AS t, n IS NULL AS is_gap, {NY * NX} - coalesce(n, 0) AS n_fill, coalesce(n, 0) = 0 AS all_fill FROM axis a LEFT JOIN n USING (t)""")
def gap_day_all_fill(spark, sf_dir):
    cube = cubes.order_cube(spark, sf_dir)
    whole = axis.densify(cube, axis.complete_axis(cube)).withColumn("v", F.coalesce("v", F.lit(NAN)))
    per_day = whole.groupBy("t", "is_gap").agg(F.bool_and(F.isnan("v")).alias("all_fill"), (NY * NX - F.count_if(~F.isnan("v"))).alias("n_fill"))
    return per_day.select(text("t").alias("t"), "is_gap", "n_fill", "all_fill")


@query(f"""WITH {cubes.CORNER_CUBE}, d AS (
  SELECT t, count(*) FILTER (v = {CORNER_FILL}) AS n_masked, string_agg(y || ',' || x, ';' ORDER BY y, x) FILTER (v = {CORNER_FILL}) AS f FROM corner_cube GROUP BY t)
SELECT n_masked, count(*) AS n_days, count(DISTINCT coalesce(f, '')) AS n_footprints FROM d GROUP BY 1""")
def mask_footprint_static(spark, sf_dir):
    prints = grid.mask_footprints(cubes.corner_cube(spark, sf_dir), FILLS)
    return prints.groupBy("n_masked").agg(F.count("*").alias("n_days"), F.count_distinct("footprint").alias("n_footprints"))


# Comparison


@query(f"""WITH {cubes.CORNER_CUBE}, r AS (SELECT t, y, x, CASE WHEN v = {CORNER_FILL} THEN NULL ELSE v END AS v FROM corner_cube WHERE y < 30),
a AS (SELECT t, y, x, CASE WHEN x = 20 THEN v + 1 ELSE v END AS a FROM r WHERE x <> 30), b AS (SELECT t, y, x, v AS b FROM r)
SELECT y // 15 AS part, count(*) AS n_cells, bool_and((a IS NULL) = (b IS NULL)) AS mask_ok, bool_and(a IS NULL OR b IS NULL OR a = b) AS values_ok,
count(*) FILTER (a IS DISTINCT FROM b) AS n_different, count(b) AS n_valid FROM a FULL JOIN b USING (t, y, x) GROUP BY 1""")
def box_compare_exact(spark, sf_dir):
    """Against a copy without one column of cells and with another one changed: the findings are known by count."""
    part = F.floor(F.col("y") / 15).alias("part")
    raw = grid.box(cubes.corner_cube(spark, sf_dir), y=(0, 30)).select(part, "t", "y", "x", "v")
    stored = grid.masked(raw, FILLS).where("x <> 30").withColumn("v", F.when(F.col("x") == 20, F.col("v") + 1).otherwise(F.col("v")).cast("float"))
    return grid.compare(stored, raw, FILLS, by=["part"])


@query(f"""WITH {cubes.LINE_CUBE}, {cubes.ORDER_CUBE}, o AS (SELECT t, y, x, CAST(v AS FLOAT) AS v FROM order_cube)
SELECT count(*) AS n_cells, bool_and((l.v IS NULL) = (o.v IS NULL)) AS mask_ok, bool_and(l.v IS NULL OR o.v IS NULL OR l.v = o.v) AS values_ok,
count(*) FILTER (l.v IS DISTINCT FROM o.v) AS n_different, count(o.v) AS n_valid FROM line_cube l FULL JOIN o USING (t, y, x)""")
def box_compare_findings(spark, sf_dir):
    return grid.compare(cubes.line_cube(spark, sf_dir), cubes.order_cube(spark, sf_dir).withColumn("v", F.col("v").cast("float")))


@query(f"""WITH {cubes.LINE_CUBE}, n AS (SELECT *, CAST(round(CAST(v AS DOUBLE) * 100) AS BIGINT) * (y * {NX} + x + 1) AS weighed, t - DATE '1900-01-01' AS day FROM line_cube)
SELECT 'by day' AS layout, count(*) AS n_cells, count(DISTINCT t) AS n_chunks, CAST(sum(weighed) AS BIGINT) AS checksum, CAST(sum(weighed % 1009 * day) AS BIGINT) AS checksum_of_days FROM n
UNION ALL SELECT 'by tile', count(*), count(DISTINCT (day // 100) * 1000000 + (y // {EDGE}) * 1000 + x // {EDGE}), CAST(sum(weighed) AS BIGINT), CAST(sum(weighed % 1009 * day) AS BIGINT) FROM n""")
def layout_equivalence(spark, sf_dir):
    """One pass over each layout: its chunks, and sums over its cells in which each cell's place and day have a weight."""
    cube = cubes.line_cube(spark, sf_dir)
    span = F.floor(naming.days_since_epoch(F.col("t")) / 100).cast("int")
    layouts = {"by day": (cube, ["t"]), "by tile": (cube.select("*", *grid.tile(EDGE), span.alias("tc")), ["tc", "ty", "tx"])}
    weighed = F.round(F.col("v").cast("double") * 100).cast("long") * (F.col("y") * NX + F.col("x") + 1)
    out = []
    for name, (own, chunk) in layouts.items():
        found = blocks.chunks(own, chunk).transform(blocks.cells)
        out.append(found.agg(
            F.count("*").alias("n_cells"), F.count_distinct(*chunk).alias("n_chunks"), F.sum(weighed).alias("checksum"),
            F.sum(weighed % 1009 * naming.days_since_epoch(F.col("t"))).alias("checksum_of_days"),
        ).select(F.lit(name).alias("layout"), "n_cells", "n_chunks", "checksum", "checksum_of_days"))
    return out[0].unionByName(out[1])


@query(f"WITH {cubes.LINE_CUBE} SELECT CAST(t AS VARCHAR) AS t, CAST(v AS DOUBLE) AS v FROM line_cube WHERE y = 7 AND x = 11")
def point_series(spark, sf_dir):
    return grid.box(cubes.line_cube(spark, sf_dir), y=(7, 8), x=(11, 12)).select(text("t").alias("t"), F.col("v").cast("double").alias("v"))


@query(f"WITH {cubes.LINE_CUBE} SELECT y, x, CAST(v AS DOUBLE) AS v FROM line_cube WHERE t >= DATE '1998-03-01' AND t < DATE '1998-03-02'")
def daily_map(spark, sf_dir):
    day = grid.box(cubes.line_cube(spark, sf_dir), t0=F.lit("1998-03-01").cast("date"), t1=F.lit("1998-03-02").cast("date"))
    return day.select("y", "x", F.col("v").cast("double").alias("v"))


@query(f"""WITH {cubes.LINE_CUBE}, {cubes.ORDER_CUBE}
SELECT count(*) AS n, round(corr(CAST(l.v AS DOUBLE), o.v), 6) AS correlation, round(sqrt(avg((CAST(l.v AS DOUBLE) - o.v) * (CAST(l.v AS DOUBLE) - o.v))), 4) AS rmse,
round(avg(CAST(l.v AS DOUBLE) - o.v), 4) AS bias, avg(CASE WHEN CAST(l.v AS DOUBLE) = o.v THEN 1.0 ELSE 0.0 END) AS identical FROM line_cube l JOIN order_cube o USING (t, y, x)""")
def product_overlap_stats(spark, sf_dir):
    found = grid.overlap_statistics(cubes.line_cube(spark, sf_dir), cubes.order_cube(spark, sf_dir))
    return found.select("n", F.round("correlation", 6).alias("correlation"), F.round("rmse", 4).alias("rmse"), F.round("bias", 4).alias("bias"), "identical")


@query(f"""WITH {cubes.LINE_CUBE}, {cubes.ORDER_CUBE}
SELECT y // {EDGE} AS ty, count(*) AS n, round(corr(CAST(l.v AS DOUBLE), o.v), 6) AS correlation, round(sqrt(avg((CAST(l.v AS DOUBLE) - o.v) * (CAST(l.v AS DOUBLE) - o.v))), 4) AS rmse,
round(avg(CAST(l.v AS DOUBLE) - o.v), 4) AS bias FROM line_cube l JOIN order_cube o USING (t, y, x) GROUP BY 1""")
def product_overlap_merged(spark, sf_dir):
    """By bands of tiles, merged from moments of each band's months, as a record that grows would store them."""
    band = F.floor(F.col("y") / EDGE).cast("int").alias("ty")
    months = grid.overlap_moments(cubes.line_cube(spark, sf_dir), cubes.order_cube(spark, sf_dir), [band, F.trunc("t", "month").alias("month")])
    found = grid.statistics_of_moments(grid.merged_moments(months, ["ty"]))
    return found.select("ty", "n", F.round("correlation", 6).alias("correlation"), F.round("rmse", 4).alias("rmse"), F.round("bias", 4).alias("bias"))


@query(f"""WITH {cubes.LINE_CUBE} SELECT DISTINCT CAST(-v AS DOUBLE) AS v, CAST(t AS VARCHAR) AS t FROM line_cube WHERE v > 0""")
def undeclared_value_days(spark, sf_dir):
    """Every day of each negative value that nobody declared, out of bitmaps: all values of a cube turned negative."""
    cube = cubes.line_cube(spark, sf_dir).withColumn("v", -F.col("v"))
    found = grid.days_of_bitmap(grid.value_days(cube, FILLS))
    return found.select(F.col("v").cast("double").alias("v"), text("t").alias("t"))


# Chunks, samples, plans of work


@query(f"""WITH {cubes.ORDER_CUBE}, {cubes.AXIS}, g AS (SELECT t, ty, tx FROM axis, range(3) a(ty), range(2) b(tx)),
w AS (SELECT t, CAST(y // {EDGE} AS BIGINT) AS ty, CAST(x // {EDGE} AS BIGINT) AS tx, count(*) AS n_cells FROM order_cube GROUP BY ALL)
SELECT CAST(t AS VARCHAR) AS t, CAST(ty AS INTEGER) AS ty, CAST(tx AS INTEGER) AS tx, coalesce(n_cells, 0) AS n_cells, n_cells IS NOT NULL AS written FROM g LEFT JOIN w USING (t, ty, tx)""")
def chunk_manifest(spark, sf_dir):
    cube = cubes.order_cube(spark, sf_dir)
    written = cube.groupBy("t", *grid.tile(EDGE)).agg(F.count("*").alias("n_cells"))
    whole = axis.complete_axis(cube).crossJoin(F.broadcast(grid.tile_grid(NY, NX, EDGE, spark)))  # six tiles
    return whole.join(written, ["t", "ty", "tx"], "left").select(
        text("t").alias("t"), "ty", "tx", F.coalesce("n_cells", F.lit(0)).alias("n_cells"), F.col("n_cells").isNotNull().alias("written")
    )


@query(f"""WITH {cubes.ORDER_CUBE}, c AS (SELECT count(*) AS n FROM order_cube GROUP BY t, y // {EDGE}, x // {EDGE})
SELECT count(*) AS n_chunks, min(n) AS least, median(n) AS middle, max(n) AS most, CAST(sum(n) AS BIGINT) AS total FROM c""")
def chunk_size_stats(spark, sf_dir):
    n = cubes.order_cube(spark, sf_dir).groupBy("t", *grid.tile(EDGE)).agg(F.count("*").alias("n"))
    return n.agg(F.count("*").alias("n_chunks"), F.min("n").alias("least"), F.median("n").alias("middle"), F.max("n").alias("most"), F.sum("n").alias("total"))


@query(f"""WITH {cubes.ORDER_CUBE} SELECT CAST(t AS VARCHAR) AS t, CAST(y // {EDGE} AS INTEGER) AS ty, CAST(x // {EDGE} AS INTEGER) AS tx, count(*) AS n
FROM order_cube GROUP BY ALL ORDER BY n, t, ty, tx LIMIT 12""")
def smallest_chunks_topk(spark, sf_dir):
    n = cubes.order_cube(spark, sf_dir).groupBy("t", *grid.tile(EDGE)).agg(F.count("*").alias("n"))
    return n.orderBy("n", "t", "ty", "tx").limit(12).select(text("t").alias("t"), "ty", "tx", "n")


@query("""WITH d AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS t FROM lineitem), p AS (SELECT t, row_number() OVER (ORDER BY t) - 1 AS place FROM d),
n AS (SELECT count(*) AS n FROM d), w AS (SELECT DISTINCT CAST(round_even(CAST(i AS DOUBLE) * (n - 1) / 39, 0) AS BIGINT) AS place FROM n, range(40) r(i))
SELECT CAST(t AS VARCHAR) AS t FROM p JOIN w USING (place)""")
def spaced_planes(spark, sf_dir):
    return grid.spaced_days(axis.days(cubes.read(spark, sf_dir, "lineitem"), "l_shipdate"), 40).select(text("t").alias("t"))


@query("""WITH u AS (SELECT DISTINCT CAST(l_partkey % 60 AS INTEGER) AS ty, CAST(l_suppkey % 40 AS INTEGER) AS tx FROM lineitem),
m AS (SELECT max(ty) + 1 AS ny, max(tx) + 1 AS nx FROM u)
SELECT ty, tx FROM u, m WHERE ty % greatest(1, ny // 6) = 0 AND tx % greatest(1, nx // 6) = 0""")
def tile_lattice(spark, sf_dir):
    tiles = cubes.read(spark, sf_dir, "lineitem").select((F.col("l_partkey") % NY).cast("int").alias("ty"), (F.col("l_suppkey") % NX).cast("int").alias("tx")).distinct()
    return grid.lattice(tiles, 6)


BLOCKS_SQL = f"""{cubes.LINE_CUBE}, e AS (SELECT max(y) + 1 AS ny, max(x) + 1 AS nx FROM line_cube),
plan AS (SELECT 'quantity' AS variable, CAST(a AS INTEGER) AS y0, CAST(least(a + 25, ny) AS INTEGER) AS y1, CAST(b AS INTEGER) AS x0, CAST(least(b + 20, nx) AS INTEGER) AS x1
  FROM e, range(0, 60, 25) r(a), range(0, 40, 20) s(b) WHERE a < ny AND b < nx)"""


@query(f"WITH {BLOCKS_SQL} SELECT * FROM plan")
def block_plan(spark, sf_dir):
    return blocks.plan(cubes.line_cube(spark, sf_dir), ["quantity"], 25, 20)


@query(f"""WITH {BLOCKS_SQL}, done AS (SELECT DISTINCT CAST(o_custkey % 60 AS INTEGER) // 25 * 25 AS y0 FROM orders WHERE o_custkey % 60 >= 30)
SELECT p.*, 'write block ' || variable || ' y[' || y0 || ':' || y1 || '] x[' || x0 || ':' || x1 || ']' AS message FROM plan p WHERE y0 NOT IN (SELECT y0 FROM done)""")
def blocks_remaining(spark, sf_dir):
    plan = blocks.plan(cubes.line_cube(spark, sf_dir), ["quantity"], 25, 20)
    message = naming.block_message(*[F.col(c) for c in ("variable", "y0", "y1", "x0", "x1")])
    row = F.floor(F.col("o_custkey") % NY / 25).cast("int") * 25
    started = cubes.read(spark, sf_dir, "orders").where(F.col("o_custkey") % NY >= 30).select(row.alias("y0")).distinct()
    done = plan.join(started, "y0", "left_semi").select(message.alias("message"))
    return blocks.remaining(plan, done).withColumn("message", message)


@query(f"""WITH {BLOCKS_SQL}, said AS (SELECT *, 'write block ' || variable || ' y[' || y0 || ':' || y1 || '] x[' || x0 || ':' || x1 || ']' AS message FROM plan),
back AS (SELECT *, string_split(regexp_replace(message, '[^0-9]+', ' ', 'g'), ' ') AS n, string_split(message, ' ')[3] AS v FROM said)
SELECT v AS variable, CAST(n[2] AS INTEGER) AS y0, CAST(n[3] AS INTEGER) AS y1, CAST(n[4] AS INTEGER) AS x0, CAST(n[5] AS INTEGER) AS x1,
v = variable AND n[2:5] = [CAST(y0 AS VARCHAR), CAST(y1 AS VARCHAR), CAST(x0 AS VARCHAR), CAST(x1 AS VARCHAR)] AS same FROM back""")
def commit_message_parse(spark, sf_dir):
    plan = blocks.plan(cubes.line_cube(spark, sf_dir), ["quantity"], 25, 20)
    names = ["variable", "y0", "y1", "x0", "x1"]
    said = plan.select(*names, naming.block_message(*[F.col(c) for c in names]).alias("message"))
    back = naming.block_of_message(F.col("message"))
    same = F.lit(True)
    for c in names:
        same = same & back[c].eqNullSafe(F.col(c))
    return said.select(*[back[c].alias(c) for c in names], same.alias("same"))


@query(f"""WITH {cubes.AXIS}, p AS (SELECT t, row_number() OVER (ORDER BY t) - 1 AS place FROM axis)
SELECT CAST(place // 96 AS BIGINT) AS batch, CAST(min(place) AS BIGINT) AS start, CAST(max(place) + 1 AS BIGINT) AS stop, CAST(min(t) AS VARCHAR) AS first_day,
CAST(max(t) AS VARCHAR) AS last_day, count(*) AS n_days FROM p GROUP BY 1""")
def batch_plan(spark, sf_dir):
    days = axis.complete_axis(cubes.order_days(spark, sf_dir))
    return blocks.batches(days, target=100, chunk=12).select(
        "batch", "start", "stop", text("first_day").alias("first_day"), text("last_day").alias("last_day"), "n_days"
    )


# Attributes, names, history


@query("""WITH s AS (SELECT l_returnflag || l_linestatus AS key, CAST(count(*) FILTER (l_shipdate < DATE '1998-01-01') AS VARCHAR) AS a,
  CAST(count(*) FILTER (l_shipdate >= DATE '1998-01-01') AS VARCHAR) AS b FROM lineitem GROUP BY 1),
o AS (SELECT key, a FROM s WHERE a <> '0'), n AS (SELECT key, b FROM s WHERE b <> '0')
SELECT key, o.a AS before, n.b AS after, CASE WHEN o.key IS NULL THEN 'add' WHEN n.key IS NULL THEN 'keep' WHEN o.a = n.b THEN 'same' ELSE 'replace' END AS change
FROM o FULL JOIN n USING (key)""")
def attr_diff(spark, sf_dir):
    lines = cubes.read(spark, sf_dir, "lineitem").select(F.concat("l_returnflag", "l_linestatus").alias("key"), "l_shipdate")
    side = lambda rows: rows.groupBy("key").agg(F.count("*").cast("string").alias("value"))
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    return attributes.difference(side(lines.where(F.col("l_shipdate") < cut)), side(lines.where(F.col("l_shipdate") >= cut)))


@query("""WITH p AS (SELECT 'n_' || event_type AS key, CAST(count(*) FILTER (user_id % 2 = 0) AS VARCHAR) AS a, CAST(count(*) FILTER (user_id % 2 = 1) AS VARCHAR) AS b FROM events GROUP BY 1)
SELECT key, nullif(a, '0') AS left_value, nullif(b, '0') AS right_value FROM p WHERE key <> 'n_click' AND nullif(a, '0') IS DISTINCT FROM nullif(b, '0')""")
def sibling_attrs(spark, sf_dir):
    events = cubes.read(spark, sf_dir, "events").select(F.concat(F.lit("n_"), "event_type").alias("key"), (F.col("user_id") % 2).alias("side"))
    side = lambda n: events.where(F.col("side") == n).groupBy("key").agg(F.count("*").cast("string").alias("value"))
    return attributes.disagreements(side(0), side(1), exclude=["n_click"])


@query(f"""WITH {cubes.LINE_CUBE} SELECT CAST(min(t) AS VARCHAR) AS time_coverage_start, CAST(max(t) AS VARCHAR) AS time_coverage_end,
'P1D' AS time_coverage_resolution, 'P' || (max(t) - min(t) + 1) || 'D' AS time_coverage_duration, min(y) AS y_min, max(y) AS y_max, min(x) AS x_min, max(x) AS x_max FROM line_cube""")
def coverage_attrs(spark, sf_dir):
    return attributes.coverage(cubes.line_cube(spark, sf_dir))


@query("""WITH o AS (SELECT DISTINCT p_type AS original FROM part), k AS (
  SELECT DISTINCT p_type AS original, lower(replace(p_type, ' ', '_')) AS canonical FROM part WHERE p_size > 5)
SELECT o.original, canonical, canonical IS NOT NULL AS known FROM o LEFT JOIN k USING (original)""")
def nomenclature_lookup(spark, sf_dir):
    parts = cubes.read(spark, sf_dir, "part")
    key = parts.where("p_size > 5").select(F.col("p_type").alias("original"), F.lower(F.translate("p_type", " ", "_")).alias("canonical")).distinct()
    return attributes.look_up(parts.select(F.col("p_type").alias("original")).distinct(), key)


RUNS_SQL = """runs AS (SELECT user_id AS log, CAST(ts AS DATE) AS run, count(*) AS n_checks, count(*) FILTER (value > 200) AS n_failures, count(DISTINCT event_type) AS n_phases FROM events GROUP BY 1, 2)"""


@query(f"""WITH {RUNS_SQL}, q AS (SELECT *, row_number() OVER (PARTITION BY log ORDER BY run DESC) AS r FROM runs WHERE n_failures = 0 AND n_phases >= 2)
SELECT log, CAST(run AS VARCHAR) AS run, n_checks FROM q WHERE r = 1""")
def verification_latest(spark, sf_dir):
    events = cubes.read(spark, sf_dir, "events")
    checks = events.select(F.col("user_id").alias("log"), F.to_date("ts").alias("run"), F.col("event_type").alias("phase"), (~(F.col("value") > 200)).alias("ok"))
    return attributes.latest_evidence(checks, phases=2).select("log", text("run").alias("run"), "n_checks")


@query("""SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS run, o_orderpriority AS phase, count(*) AS n_checks, count(*) FILTER (o_orderstatus = 'F') AS n_failures
FROM orders GROUP BY 1, 2""")
def check_totals(spark, sf_dir):
    checks = cubes.read(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("run"), F.col("o_orderpriority").alias("phase"), (F.col("o_orderstatus") != "F").alias("ok"))
    return attributes.totals(checks, ["run", "phase"]).withColumn("run", text("run"))


@query("""WITH c AS (SELECT o_custkey AS id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS seq, o_orderstatus AS kind, CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT id, CAST(min(d) AS VARCHAR) AS first_build, CAST(max(d) AS VARCHAR) AS last_build, count(*) AS n_builds FROM c WHERE kind <> 'P' GROUP BY 1""")
def build_history(spark, sf_dir):
    commits = cubes.read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"), F.col("o_orderstatus").alias("kind"), F.to_date("o_orderdate").alias("written_at"))
    found = attributes.builds(commits, ["id"], admin=["P"])
    return found.select("id", text("first_build").alias("first_build"), text("last_build").alias("last_build"), "n_builds")


@query("""SELECT p_brand AS version, CASE WHEN regexp_full_match('V' || p_size || '.' || (p_partkey % 7), '[Vv][0-9]+(\\.[0-9]+)*') THEN 'v_' || p_size || '_' || (p_partkey % 7) END AS token,
lower(p_type) AS period, lower(p_brand) AS resolution FROM part""")
def name_tokens(spark, sf_dir):
    part = cubes.read(spark, sf_dir, "part")
    token = naming.version_token(F.concat(F.lit("V"), F.col("p_size").cast("string"), F.lit("."), (F.col("p_partkey") % 7).cast("string")))
    two = naming.product_parts(F.concat_ws("/", "p_type", "p_brand"))
    return part.select(F.col("p_brand").alias("version"), token.alias("token"), two[0].alias("period"), two[1].alias("resolution"))


@query("""WITH s AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS t FROM lineitem)
SELECT CAST(min(t) AS VARCHAR) AS first_day, CAST(max(t) AS VARCHAR) AS last_day, count(*) >= 22 AS enough FROM s""")
def sample_ends(spark, sf_dir):
    """Both ends of the axis are in the draw, and about as many days as asked for."""
    drawn = grid.sampled_days(axis.days(cubes.read(spark, sf_dir, "lineitem"), "l_shipdate").distinct(), 24, 20)
    ends = drawn.agg(F.min("t").alias("a"), F.max("t").alias("b"), F.count("*").alias("n"))
    return ends.select(text("a").alias("first_day"), text("b").alias("last_day"), F.col("n").between(22, 24).alias("enough"))


# Archives: built of the events, interrupted, gone on with, read and audited


@query(f"WITH {stores.EVENT_CUBE} SELECT CAST(t AS VARCHAR) AS t, y, x, CAST(v AS DOUBLE) AS v FROM event_cube")
def archive_append_cells(spark, sf_dir):
    """All cells of the archive by days."""
    return stores.stores(spark, sf_dir).maps.read().select(text("t").alias("t"), "y", "x", F.col("v").cast("double").alias("v"))


@query(f"WITH {stores.EVENT_CUBE} SELECT CAST(t AS VARCHAR) AS t, y, x, CAST(v AS DOUBLE) AS v FROM event_cube")
def archive_region_cells(spark, sf_dir):
    """All cells of the archive by tiles, which was built from one pass over the raw files."""
    return stores.stores(spark, sf_dir).series.read().select(text("t").alias("t"), "y", "x", F.col("v").cast("double").alias("v"))


@query(f"""WITH {stores.EVENT_CUBE}
SELECT 'days' AS layout, CAST(t AS VARCHAR) AS t, y, x, CAST(v AS DOUBLE) AS v FROM event_cube, first_day WHERE t >= d0 + 5 AND t < d0 + 15 AND y >= 13 AND y < 37 AND x >= 19 AND x < 22
UNION ALL SELECT 'tiles', CAST(t AS VARCHAR), y, x, CAST(v AS DOUBLE) FROM event_cube, first_day WHERE t >= d0 + 5 AND t < d0 + 15 AND y >= 13 AND y < 37 AND x >= 19 AND x < 22""")
def archive_boxes(spark, sf_dir):
    """A box that cuts through commits, blocks and chunks, out of both layouts."""
    built = stores.stores(spark, sf_dir)
    first = built.maps.shape().first_day
    out = []
    for name, store in (("days", built.maps), ("tiles", built.series)):
        box = store.read(t0=first + dt.timedelta(5), t1=first + dt.timedelta(15), y=(13, 37), x=(19, 22))
        out.append(box.select(F.lit(name).alias("layout"), text("t").alias("t"), "y", "x", F.col("v").cast("double").alias("v")))
    return out[0].unionByName(out[1])


@query(f"""WITH {stores.EVENT_CUBE}
SELECT 'days' AS layout, CAST(t - d0 AS BIGINT) AS tc, 0 AS ty, 0 AS tx, count(*) AS n_cells, CAST(min(v) AS DOUBLE) AS v_min, CAST(max(v) AS DOUBLE) AS v_max, min(y) AS y0, max(x) + 1 AS x1
FROM event_cube, first_day GROUP BY t, d0
UNION ALL SELECT 'tiles', CAST(0 AS BIGINT), CAST(y // {EDGE} AS INTEGER), CAST(x // {EDGE} AS INTEGER), count(*), CAST(min(v) AS DOUBLE), CAST(max(v) AS DOUBLE), min(y), max(x) + 1 FROM event_cube GROUP BY 3, 4""")
def archive_manifest(spark, sf_dir):
    """The chunks of both layouts by what their commits wrote of them; no data is opened."""
    built = stores.stores(spark, sf_dir)
    out = []
    for name, store in (("days", built.maps), ("tiles", built.series)):
        found = store.manifest_rows().groupBy("tc", "ty", "tx").agg(
            F.sum("n_cells").alias("n_cells"), F.min("v_min").cast("double").alias("v_min"), F.max("v_max").cast("double").alias("v_max"), F.min("y0").alias("y0"), F.max("x1").alias("x1"))
        out.append(found.select(F.lit(name).alias("layout"), "*"))
    return out[0].unionByName(out[1])


@query(f"""WITH {stores.EVENT_CUBE}, batches AS (SELECT unnest(range(0, CAST(d1 - d0 + 1 AS BIGINT), {stores.DAYS_A_COMMIT})) AS a, d1 - d0 + 1 AS n, d0 FROM first_day)
SELECT 'days' AS layout, CAST(a // {stores.DAYS_A_COMMIT} AS BIGINT) AS seq, 'build' AS kind, 'write timesteps ' || a || '-' || least(a + {stores.DAYS_A_COMMIT}, n) AS message,
CAST(d0 + CAST(a AS INTEGER) AS VARCHAR) AS first_day, CAST(least(a + {stores.DAYS_A_COMMIT}, n) - a AS BIGINT) AS n_days FROM batches
UNION ALL SELECT 'tiles', CAST(0 AS BIGINT), 'skeleton', 'create skeleton', CAST(d0 AS VARCHAR), CAST(d1 - d0 + 1 AS BIGINT) FROM first_day
UNION ALL SELECT 'tiles', CAST(b // {stores.BLOCK_ROWS} + 1 AS BIGINT), 'build', 'write block value y[' || b || ':' || (b + {stores.BLOCK_ROWS}) || '] x[0:{NX}]', CAST(d0 AS VARCHAR), CAST(0 AS BIGINT)
FROM first_day, range(0, {NY}, {stores.BLOCK_ROWS}) r(b)""")
def archive_commits(spark, sf_dir):
    """The commits of both builds, each once though both were interrupted."""
    built = stores.stores(spark, sf_dir)
    out = []
    for name, store in (("days", built.maps), ("tiles", built.series)):
        own = store.history().where("kind <> 'attributes'").withColumn("place", F.row_number().over(Window.orderBy("seq")) - 1)  # a row a commit
        out.append(own.select(F.lit(name).alias("layout"), F.col("place").cast("long").alias("seq"), "kind", "message", text("first_day").alias("first_day"), "n_days"))
    return out[0].unionByName(out[1])


@query(f"""WITH {stores.EVENT_CUBE}, m AS (SELECT t, string_agg(y || ',' || x, ';' ORDER BY y, x) AS f FROM event_cube GROUP BY t)
SELECT 'days' AS layout, p AS phase, CASE WHEN p = 'sentinel' AND (SELECT count(DISTINCT f) FROM m) > 1 THEN 1 ELSE 0 END AS n_failures
FROM (SELECT unnest(['structure', 'index', 'samples', 'sweep', 'sentinel', 'metadata']) AS p)
UNION ALL SELECT 'tiles', p, CASE WHEN p = 'sentinel' AND (SELECT count(DISTINCT f) FROM m) > 1 THEN 1 ELSE 0 END
FROM (SELECT unnest(['structure', 'index', 'samples', 'sweep', 'sentinel', 'metadata']) AS p)""")
def archive_audit(spark, sf_dir):
    """Failures by phase of the audits of both layouts, each against the raw files and the other layout. The events' cells
    come and go, so the masked footprint moves, and that check must fail."""
    built = stores.stores(spark, sf_dir)
    cells = raw.raw_cells(spark, built.config)
    out = []
    for name, store, config, other in (("days", built.maps, built.config, built.series), ("tiles", built.series, built.series_config, built.maps)):
        found = audit.audit(store, config, cells, [*audit.PHASES, "metadata"], other, n=4, days=10)
        out.append(attributes.totals(found, ["phase"]).select(F.lit(name).alias("layout"), "phase", F.col("n_failures").cast("int").alias("n_failures")))
    return out[0].unionByName(out[1])


@query(f"""WITH {stores.EVENT_CUBE} SELECT CAST(t AS VARCHAR) AS t, y, x, CAST(v AS DOUBLE) AS left_v, CAST(CAST(v + 1 AS FLOAT) AS DOUBLE) AS right_v
FROM event_cube, first_day WHERE t = d1 AND y = {stores.CHANGED_ROW}""")
def archive_different_cells(spark, sf_dir):
    """Where an archive by tiles differs from one by days: found by digests of spans and rows, then read."""
    built = stores.stores(spark, sf_dir)
    found = levels.different_cells(built.maps, built.changed)
    return found.select(text("t").alias("t"), "y", "x", F.col("left_v").cast("double").alias("left_v"), F.col("right_v").cast("double").alias("right_v"))


@query(f"""WITH {stores.EVENT_CUBE} SELECT CAST(t AS VARCHAR) AS t, count(*) AS n, count(DISTINCT y * {NX} + x) = count(*) AS once FROM event_cube GROUP BY t""")
def archive_footprints(spark, sf_dir):
    """Cells a day by the manifest of the archive by tiles; its digests of places are those of the archive by days."""
    built = stores.stores(spark, sf_dir)
    days = levels.by_day(built.maps).select("t", F.col("footprint").alias("other"))
    found = levels.by_day(built.series).join(days, "t")
    return found.select(text("t").alias("t"), "n", (F.col("footprint") == F.col("other")).alias("once"))
