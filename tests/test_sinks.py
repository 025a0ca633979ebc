"""Sink tables that follow the config, the Bloom filter and the restart policy."""

import os
import random

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from dovetail.plans import facts, streams
from dovetail.session import scratch_dir
from dovetail.streaming import operators as S
from dovetail.streaming.runner import Restarts, Topic, run_foreach_batch
from dovetail.streaming.sinks import Change, Sink, SinkCatalog, after_changes

from tests.conftest import SF

ROWS = "source string, after map<string,string>, ts_ms bigint"


def _change(op, at, columns="id,name"):
    return Change(op, Sink("dim_a", "a", "id", columns, at))


def test_catalogue_after_changes():
    assert after_changes({}, [_change("c", 5), _change("r", 7)])["dim_a"].since == 5  # there already
    assert after_changes({}, [_change("c", 5), _change("u", 7, "id")])["dim_a"] == _change("u", 7, "id").sink
    assert after_changes({}, [_change("c", 5), _change("d", 7)]) == {}
    assert after_changes({}, [_change("c", 9), _change("d", 7)])["dim_a"].since == 9  # by time, not by place
    assert after_changes({}, [_change("d", 1), _change("u", 2)])["dim_a"].since == 2


def test_a_table_is_made_dropped_and_made_anew(spark):
    catalog = SinkCatalog(scratch_dir(spark, "sinks"), buckets=2)

    def batch(i, changes, *rows):
        catalog.run(spark, i, changes, spark.createDataFrame([("a", dict(r), t) for r, t in rows], ROWS))

    def table():
        return {(r["id"], r["name"]) for r in catalog.read(spark, "dim_a").collect()}

    batch(0, [_change("c", 10)], ({"id": "1", "name": "early"}, 9), ({"id": "1", "name": "x"}, 10), ({"id": "2", "name": "y"}, 11))
    assert table() == {("1", "x"), ("2", "y")}
    batch(1, [], ({"id": "1", "name": "x2"}, 20), ({"id": "2", "name": "older"}, 3))
    assert table() == {("1", "x2"), ("2", "y")}
    first = os.path.join(catalog.path, "tables", "dim_a", "since=10")
    assert os.path.exists(first)
    for _ in range(2):  # a replayed batch gives the same again
        batch(2, [_change("d", 30)], ({"id": "3", "name": "z"}, 31))
        assert catalog.at(spark) == {} and not os.path.exists(first)
        with pytest.raises(KeyError):
            catalog.read(spark, "dim_a")
    for _ in range(2):
        batch(3, [_change("c", 40), _change("u", 42, "id,size")], ({"id": "1", "name": "n", "size": "7"}, 41),
              ({"id": "4", "name": "n", "size": "8"}, 43))
        t = catalog.read(spark, "dim_a")
        assert t.columns == ["row_key", "id", "size", "ts_ms"]
        assert [(r["id"], r["size"]) for r in t.collect()] == [("4", "8")]


def test_slices_make_no_difference_to_the_sinks(spark):
    got = [sorted(map(str, streams.stream_sink_catalog(spark, SF, slices=n).collect())) for n in (1, 4)]
    assert got[0] == got[1] and got[0]


def test_bloom_filter_keeps_new_rows_once(spark):
    rng = random.Random(5)
    shape = S.bloom_shape(20_000, 0.01)
    seen, state, lost = set(), None, 0
    for _ in range(3):
        ids = [rng.randrange(40_000) for _ in range(9_000)] + [7] * 3_000  # one item holds a quarter of the rows
        df = spark.createDataFrame([(i,) for i in ids], "id long").repartition(4)
        out, new = S.bloom_new(df, state, F.col("id").cast("string"), shape)
        kept = [r["id"] for r in out.collect()]
        assert len(kept) == len(set(kept)) and not set(kept) & seen and set(kept) <= set(ids)
        lost += len(set(ids) - seen) - len(kept)
        seen |= set(ids)
        both = new if state is None else state.join(new, "block", "left_anti").unionByName(new.select(*state.columns))
        state = both.checkpoint()
        assert state.count() <= shape[0]
    assert lost <= 0.01 * len(seen)


def test_bloom_filter_rate(spark):
    """Filled to what it was made for, it takes 1 % of new items for seen ones."""
    shape = S.bloom_shape(30_000, 0.01)
    item = F.col("id").cast("string")
    _, state = S.bloom_new(spark.range(30_000), None, item, shape)
    state = state.checkpoint()
    assert S.bloom_new(spark.range(30_000), state, item, shape)[0].count() == 0
    kept = S.bloom_new(spark.range(100_000, 150_000), state, item, shape)[0].count()
    assert 0.002 < 1 - kept / 50_000 < 0.015


def test_a_failed_stream_starts_again(spark):
    topic = Topic("n", spark.range(6).withColumnRenamed("id", "t"), F.col("t"))
    failures = []

    def write(times):
        def fn(batch, bid, out):
            if len(failures) < times:
                failures.append(bid)
                raise RuntimeError("lost")
            batch.write.mode("overwrite").parquet(os.path.join(out, f"batch={bid}"))
        return fn

    quick = Restarts(most=2, seconds=300, pause=0)
    out = run_foreach_batch(spark, [topic], lambda s: s, "restart", write(2), restarts=quick)
    assert sorted(r["t"] for r in spark.read.parquet(out).collect()) == list(range(6)) and len(failures) == 2
    failures.clear()
    with pytest.raises(StreamingQueryException):
        run_foreach_batch(spark, [topic], lambda s: s, "restart", write(3), restarts=quick)
    failures.clear()
    run_foreach_batch(spark, [topic], lambda s: s, "restart", write(3), restarts=Restarts(most=1, seconds=0, pause=0.01))


def test_fact_columns(spark):
    d = facts.fact_order_detail(spark, SF)
    assert {"id", "sender_name", "sender_province_id", "receiver_province_id", "receiver_city_id", "sender_complex_id",
            "receiver_complex_id", "cargo_num", "volume_length", "volume_width", "volume_height"} <= set(d.columns)
    right = (F.col("sender_name") == "S*") & (F.col("id") == F.col("order_id") * 10 + F.col("line_no")) & F.col("cargo_num").between(1, 7)
    assert d.where(~right | right.isNull()).count() == 0 and d.count() == spark.read.parquet(f"{SF}/lineitem.parquet").count()
    assert set(facts.fact_order_process(spark, SF).columns) >= set(facts.FACT_COLS) | {"start_date", "end_date"}
    assert {"id", "sort_emp_id"} <= set(facts.fact_bound_sort(spark, SF).columns)
