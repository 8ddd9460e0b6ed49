"""Findings F4 to F13: the steps of the delay job in proportion to the rows, whatever their keys."""

import pytest
from pyspark.sql import functions as F


def test_auto_grid_offers_few_candidates_a_ping(spark):
    """the block around a ping holds about fourteen of evenly spread stops, not 36."""
    from tramflow.functions.geo import grid_cell
    from tramflow.operators import nearest

    stops = spark.range(1600).select(
        F.lit("1").alias("line"), (20 + (F.col("id") % 40) / 100).alias("lon"), (52 + F.floor(F.col("id") / 40) / 100).alias("lat")
    )
    cell = nearest._auto_cells(stops, ["line"], "lon", "lat").first()["_cell"]
    at = [grid_cell("lon", F.lit(cell)).alias("cx"), grid_cell("lat", F.lit(cell)).alias("cy")]
    cells = stops.select(*at).groupBy("cx", "cy").count()
    near = cells.alias("a").join(cells.alias("b"), (F.abs(F.col("a.cx") - F.col("b.cx")) <= 1) & (F.abs(F.col("a.cy") - F.col("b.cy")) <= 1))
    pairs = near.agg(F.sum(F.col("a.count") * F.col("b.count"))).first()[0]
    assert pairs / 1600 < 20


def test_band_join_orders_by_a_hash_of_the_key(spark):
    """a hash leads the sort keys; keys of two types join without it, null keys nowhere."""
    from tramflow.operators.bandjoin import band_join

    left = spark.createDataFrame([("a", 1, 100), ("a", 2, 779), (None, 1, 100), ("b", 1, 5)], "k string, n int, t int")
    right = spark.createDataFrame([("a", 1, 0), ("a", 1, 700), ("a", 2, 780), (None, 1, 100), ("b", 2, 5)], "rk string, rn int, rt int")
    joined = band_join(left, right, on=[("k", "rk"), ("n", "rn")], left_t="t", right_t="rt")
    assert joined.columns == ["k", "n", "t", "rk", "rn", "rt"]
    assert "xxhash64" in joined._jdf.queryExecution().optimizedPlan().toString()
    expected = [("a", 1, 100, 0), ("a", 2, 779, 780)]
    assert sorted(tuple(r) for r in joined.select("k", "n", "t", "rt").collect()) == expected
    mixed = band_join(left.withColumn("n", F.col("n").cast("long")), right, on=[("k", "rk"), ("n", "rn")], left_t="t", right_t="rt")
    assert sorted(tuple(r) for r in mixed.select("k", "n", "t", "rt").collect()) == expected


@pytest.mark.parametrize("split_rows", [0, 5, 1000])
def test_previous_distinct_cuts_only_large_groups(spark, split_rows):
    """small groups take one pass, larger ones chunks; the rows are those of the plain window, null keys too."""
    from tramflow.operators.windows import previous_distinct

    rows = [(g, t, "abc"[(t * t // 3) % 3]) for g, n in ((None, 9), ("x", 3), ("y", 30), ("z", 1)) for t in range(n)]
    df = spark.createDataFrame(rows, "g string, t int, v string")
    plain = previous_distinct(df, "v", ["g"], ["t"])
    cut = previous_distinct(df, "v", ["g"], ["t"], split_by=F.floor(F.col("t") / 4), split_rows=split_rows)
    assert cut.columns == plain.columns
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, cut.collect()), key=key) == sorted(map(tuple, plain.collect()), key=key)
    assert ("Union" in cut._jdf.queryExecution().optimizedPlan().toString()) == (split_rows < 30)
