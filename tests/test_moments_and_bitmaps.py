import datetime as dt
import random

from pyspark.sql import functions as F

from gridloom.operators import audit, grid

FIRST = dt.date(1985, 1, 1)
CELLS = "t date, y int, x int, v float"


def cube(seed, days, offset=0.0):
    draw = random.Random(seed)
    return [(FIRST + dt.timedelta(k), y, x, offset + draw.gauss(0, 1)) for k in range(days) for y in range(5) for x in range(4) if draw.random() < 0.9]


def test_moments_of_days_added_later_merge_to_those_of_all(spark):
    """Far from zero, where plain sums of squares would lose the digits."""
    a, b = (spark.createDataFrame(cube(s, 60, 1e4), CELLS) for s in (1, 2))
    early, late = F.col("t") < F.lit(FIRST + dt.timedelta(40)), F.col("t") >= F.lit(FIRST + dt.timedelta(40))
    part = lambda when: grid.overlap_moments(a.where(when), b.where(when), ["t", F.floor(F.col("y") / 2).alias("ty")])
    merged = grid.statistics_of_moments(grid.merged_moments(part(early).unionByName(part(late)))).first()
    whole = grid.overlap_statistics(a, b).first()
    assert merged["n"] == whole["n"] and merged["identical"] == whole["identical"]
    for name in ("correlation", "rmse", "bias"):
        assert abs(merged[name] - whole[name]) < 1e-9


def test_bitmaps_hold_the_days_of_each_value(spark):
    draw = random.Random(3)
    rows = [(FIRST + dt.timedelta(draw.randrange(40_000)), 0, 0, draw.choice([-1.0, -2.5, -9999.0, 3.0])) for _ in range(3000)]
    rows += [(FIRST + dt.timedelta(k), 1, x, -7.0) for k in range(2000) for x in range(3)]
    cells = spark.createDataFrame(rows, CELLS)
    found = grid.value_days(cells, [-9999.0])
    assert {(r["v"], r["t"]) for r in grid.days_of_bitmap(found).collect()} == {(v, t) for t, _, _, v in rows if v < 0 and v != -9999.0}
    assert {r["v"]: r["n"] for r in found.groupBy("v").agg(F.sum("n").alias("n")).collect()}[-7.0] == 6000
    assert found.where("v = -7").count() == 1 or found.where("v = -7").agg(F.sum("n_days")).first()[0] == 2000
    verdict = audit.undeclared(cells.where("v = -7 or v > 0"), [-9999.0]).first()
    assert not verdict["ok"] and verdict["detail"] == f"1: -7.0 on 2000 days from {FIRST} to {FIRST + dt.timedelta(1999)}"
    assert audit.undeclared(cells.where("v > 0"), [-9999.0]).first()["ok"]
