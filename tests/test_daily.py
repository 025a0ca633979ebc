"""Stored 1-day tables: built once, read by day, late rows rewrite their day."""

import os
import shutil

from pyspark.sql import functions as F

from dovetail.plans.rollups import DAILY
from dovetail.session import scratch_dir
from dovetail.sources import daily
from tests.conftest import SF

FIRST, LAST = "1998-07-04", "1998-08-02"


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


def files(store):
    out = {}
    for folder, _, names in os.walk(os.path.join(store, "rows")):
        for n in names:
            if n.endswith(".parquet"):
                out.setdefault(os.path.basename(folder), set()).add(n)
    return out


def copy_tables(tmp_path):
    sf = tmp_path / "sf"
    sf.mkdir()
    for t in ("lineitem", "orders", "part", "supplier", "nation", "region"):
        (sf / f"{t}.parquet").mkdir()
        shutil.copy(f"{SF}/{t}.parquet", sf / f"{t}.parquet" / "part-0.parquet")
    return str(sf)


def test_days_are_built_once(spark):
    t = DAILY["dispatch"]
    store = scratch_dir(spark, "daily-once")
    a = rows(daily.read_days(spark, SF, t, "1998-07-20", "1998-07-25", store))
    before = files(store)
    b = rows(daily.read_days(spark, SF, t, FIRST, LAST, store))
    assert set(a) <= set(b) and all(files(store)[d] == n for d, n in before.items())
    assert b == rows(t.build(spark, SF, (FIRST, LAST)).where(F.col("dt").between(FIRST, LAST)))
    after = files(store)
    assert rows(daily.read_days(spark, SF, t, FIRST, LAST, store)) == b and files(store) == after


def test_a_late_line_rewrites_its_day_alone(spark, tmp_path):
    sf = copy_tables(tmp_path)
    for name in ("shift", "org_sort", "receive"):
        t = DAILY[name]
        store = scratch_dir(spark, f"daily-late-{name}")
        daily.read_days(spark, sf, t, FIRST, LAST, store)
        before = files(store)
        line = spark.read.parquet(f"{sf}/lineitem.parquet").where("l_linestatus = 'F' and l_returnflag <> 'N'").orderBy("l_orderkey").limit(1)
        late = line.withColumn("l_shipdate", F.lit("1998-07-15 01:00:00").cast("timestamp_ntz")).withColumn("l_quantity", F.lit(3.0))
        late.write.mode("append").parquet(f"{sf}/lineitem.parquet")
        daily.refresh(spark, sf, t, ["1998-07-15"], store)
        after = files(store)
        assert {d for d in after if after[d] != before.get(d)} == {"dt=1998-07-15"}
        assert rows(daily.read_days(spark, sf, t, FIRST, LAST, store)) == rows(
            t.build(spark, sf, (FIRST, LAST)).where(F.col("dt").between(FIRST, LAST)))


def test_other_source_files_begin_another_store(spark, tmp_path):
    sf = copy_tables(tmp_path)
    t = DAILY["dispatch"]
    a = daily.store_of(spark, sf, t)
    assert a == daily.store_of(spark, sf, t)
    shutil.copy(f"{sf}/orders.parquet/part-0.parquet", f"{sf}/orders.parquet/part-1.parquet")
    assert daily.store_of(spark, sf, t) != a


def test_a_stopped_build_is_done_again(spark):
    """Rows without a marker do not count as stored."""
    t = DAILY["dispatch"]
    store = scratch_dir(spark, "daily-stopped")
    t.build(spark, SF, ("1998-07-20", "1998-07-20")).where("dt = '1998-07-20'").limit(0).drop("dt").write.parquet(f"{store}/rows/dt=1998-07-20")
    got = rows(daily.read_days(spark, SF, t, "1998-07-20", "1998-07-21", store))
    assert got == rows(t.build(spark, SF, ("1998-07-20", "1998-07-21")).where(F.col("dt").between("1998-07-20", "1998-07-21")))


def test_days_without_rows(spark):
    store = scratch_dir(spark, "daily-empty")
    got = daily.read_days(spark, SF, DAILY["dispatch"], "2020-01-01", "2020-01-03", store)
    assert got.count() == 0 and daily.stored_days(spark, store) == {"2020-01-01", "2020-01-02", "2020-01-03"}
