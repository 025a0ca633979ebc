"""Plan-shape guards for scale properties (built, not executed)."""

import pytest

from dovetail.plans.rollups import DAILY
from dovetail.registry import load_all
from tests.conftest import SF

Q = load_all()
# streaming and I/O keys run their jobs while building; their plans are covered elsewhere
BATCH = sorted(k for k, q in Q.items() if q.family not in ("streams", "io_jobs")
               and k not in ("sink_day_bucket", "sink_upsert_latest", "sink_partial_update"))


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", BATCH)
def test_no_cartesian_or_nested_loop_join(spark, key):
    p = plan(Q[key].build(spark, SF))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, key


STORED = ["rollup_order_cargo_nd", "rollup_receive_nd", "rollup_deliver_nd", "rollup_dispatch_nd", "rollup_sort_nd", "rollup_shift_nd",
          "report_orders", "report_cargo_type", "report_order_stats", "report_trans_stats", "report_truck_stats", "report_shift_stats",
          "report_line_stats", "report_driver_stats", "report_city_stats", "report_org_stats", "report_express_stats",
          "report_express_province", "report_express_city", "report_express_org"]


@pytest.mark.parametrize("key", STORED)
def test_reports_read_stored_days_only(spark, key):
    """No n-day table or report scans the lines or orders again."""
    p = plan(Q[key].build(spark, SF))
    assert "lineitem.parquet" not in p and "orders.parquet" not in p and "/daily/" in p, key


@pytest.mark.parametrize("name", sorted(DAILY))
def test_building_a_day_prunes_the_source_scan(spark, name):
    """Each scan of the fact tables has the day window, or is joined to one that has (order day)."""
    import re
    p = plan(DAILY[name].build(spark, SF, ("1998-07-04", "1998-08-02")))
    scans = dict(re.findall(r"Location:[^\n]*/(lineitem|orders)\.parquet[^\n]*?PushedFilters: (\[[^\n]*)", p))
    dated = "o_orderdate" if name == "order_cargo" else "l_shipdate"
    assert f"GreaterThanOrEqual({dated}" in scans["orders" if name == "order_cargo" else "lineitem"] or f"({dated}" in str(scans), p


def test_one_lineitem_scan(spark):
    assert plan(Q["dim_sku_full"].build(spark, SF)).count("lineitem.parquet") == 1


def test_fixed_dictionary_decodes_broadcast(spark):
    p = plan(Q["fact_order_detail"].build(spark, SF))
    assert p.count("BroadcastHashJoin") >= 4            # the four code decodes
