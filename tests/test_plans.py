"""Physical-plan properties that matter at scale."""

from conftest import SF001
from tramflow.plans import catalog


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_udf_in_pipelines(spark):
    for name in ("j9_nearest_stop", "j4_band_join", "c1_delay_fact", "c5_route_variants_load"):
        plan = _plan(catalog.REGISTRY[name].build(spark, SF001))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_windows_are_partitioned(spark):
    for name in ("w6_previous_stops", "w6_routes_order", "w2_change_detection", "x_text_blocks"):
        plan = _plan(catalog.REGISTRY[name].build(spark, SF001))
        assert "SinglePartition" not in plan, name


def test_band_join_uses_time_buckets(spark):
    from pyspark.sql import functions as F

    from tramflow.plans import delays
    from tramflow.plans import driver_views as dv

    trams = delays.trams_stops(dv.pings(spark, SF001), dv.route_stops(spark, SF001))
    res = delays.delay_matches(trams, dv.timetable(spark, SF001), delays.calendar(dv.calendar_raw(spark, SF001)))
    text = res._jdf.queryExecution().optimizedPlan().toString()
    assert "_rbk" in text and "_bk" in text  # bucket keys are join keys
    assert "CartesianProduct" not in _plan(res) and "BroadcastNestedLoopJoin" not in _plan(res)


def test_scan_prunes_columns_and_pushes_filters(spark):
    from pyspark.sql import functions as F

    from tramflow.plans import driver_views as dv

    df = dv.table(spark, SF001, "lineitem").filter(F.col("l_suppkey") == 3).select("l_orderkey")
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(l_suppkey), EqualTo(l_suppkey,3)]" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_suppkey:bigint>" in plan
