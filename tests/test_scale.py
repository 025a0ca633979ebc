"""Joins of the large tables keep their tasks small as the tables grow (rows a task lowered to the test's size)."""

import os
import random

import pytest
from pyspark.sql import functions as F

from dovetail.plans import cdc, facts, rollups, streams
from dovetail.sources import envelopes, tables
from dovetail.session import scratch_dir
from dovetail.streaming import operators, runner
from tests.conftest import SF


def tasks_of_joins(df) -> list[int]:
    import re
    p = df._jdf.queryExecution().executedPlan().toString()
    return [int(n) for n in re.findall(r"hashpartitioning\((?:l_orderkey|o_orderkey|order_id)#\d+L?, (\d+)\), REPARTITION_BY_NUM", p)]


@pytest.mark.parametrize("build", [
    rollups.rollup_order_cargo_1d, rollups.rollup_receive_1d, rollups.rollup_deliver_1d, facts.fact_order_process,
    cdc.cdc_route_table, cdc.cdc_snapshot_only])
def test_large_joins_are_dealt_by_rows(spark, monkeypatch, build):
    lines = spark.read.parquet(f"{SF}/lineitem.parquet").count()
    assert not tasks_of_joins(build(spark, SF))  # small tables stay as they are
    before = {tuple(map(str, r)) for r in build(spark, SF).collect()}
    a_task = lines // (2 * spark.sparkContext.defaultParallelism)
    monkeypatch.setattr(tables, "ROWS_A_TASK", a_task)
    df = build(spark, SF)
    dealt = tasks_of_joins(df)
    assert dealt and set(dealt) == {-(-lines // a_task)}
    assert {tuple(map(str, r)) for r in df.collect()} == before


def test_envelopes_build_only_the_maps_that_are_read(spark):
    """The time bounds and the activity of a table need no row image."""
    env = envelopes.order_envelopes(spark, SF, tables={"order_info"})
    lean = env.select("op", "ts_ms")._jdf.queryExecution().optimizedPlan().toString()
    assert "map(" not in lean
    whole = {tuple(map(str, r)) for r in env.select("op", "ts_ms", "before", "after").collect()}
    assert {r[:2] for r in whole} == {tuple(map(str, r)) for r in env.select("op", "ts_ms").collect()}


def test_bloom_state_follows_from_the_rows_kept(spark):
    shape, item = operators.bloom_shape(2_000, 0.01), F.col("id").cast("string")
    blocks = lambda df: {(r["block"], bytes(r["bits"])) for r in df.collect()}
    kept, state = operators.bloom_new(spark.range(1_000), None, item, shape)
    assert blocks(operators.bloom_marked(kept, None, item, shape)) == blocks(state)
    more, later = operators.bloom_new(spark.range(500, 2_000), state, item, shape)
    assert blocks(operators.bloom_marked(more, state, item, shape)) == blocks(later)


def test_joins_of_streams_take_large_slices_in_parts(spark, monkeypatch, tmp_path):
    """Each part is delivered when the one before is worked off; no topic joins the tables anew."""
    orders = spark.range(60).selectExpr("id AS o_orderkey", "id % 7 AS o_custkey", "'P' AS o_orderstatus", "1.0D AS o_totalprice",
                                        "timestamp'2000-01-01' + make_interval(0, 0, 0, int(id * id / 30)) AS o_orderdate",
                                        "if(id % 3 = 0, '5-LOW', '1-URGENT') AS o_orderpriority")
    lines = spark.range(120).selectExpr("id % 60 AS l_orderkey", "id AS l_partkey", "id % 5 AS l_suppkey", "int(1 + id / 60) AS l_linenumber",
                                        "3.0D AS l_quantity", "9.0D AS l_extendedprice", "0.06D AS l_discount", "0.05D AS l_tax",
                                        "'N' AS l_returnflag", "'O' AS l_linestatus")
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    stored = streams._lines(spark, str(tmp_path), "t")
    topics = [streams._detail_topic(spark, str(tmp_path), stored),
              streams._split_topic(str(tmp_path), stored, "t", "l_discount > 0.05", "l_linenumber >= 5", "l_suppkey")]
    for plan in (t.rows._jdf.queryExecution().optimizedPlan().toString() for t in topics):
        assert "Join" not in plan
    landed, land = [], runner._land
    monkeypatch.setattr(runner, "_land", lambda s, base, topics, what: (landed.append(what), land(s, base, topics, what)))
    monkeypatch.setattr(streams, "rows_a_part", lambda s: 20)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    got = sorted((r.order_id, r.id) for r in streams.stream_cancel_join(spark, str(tmp_path)).collect())
    assert got == sorted((str(i % 60), f"{i % 60}_{1 + i // 60}_{i}") for i in range(120) if i % 60 % 3 == 0)
    assert len(landed) > runner.SLICES and len(set(landed)) == len(landed) and any("__part" in x for x in landed)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_state_of_joined_streams_has_a_task_a_core(spark, tmp_path):
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "10000")
    try:
        with runner._lean_state(spark, str(tmp_path)):
            assert int(spark.conf.get("spark.sql.shuffle.partitions")) == spark.sparkContext.defaultParallelism
        assert spark.conf.get("spark.sql.shuffle.partitions") == "10000"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)


CHAIN = "k string, v long, ts_ms long, arrives long"


def chain(frames, before, now):
    """left joined to an inner side up to 10 s before and an outer one up to 10 s after."""
    d, o, a = (operators.with_event_time(x, F.col("ts_ms"), "5 seconds", out="t").select(
        *[F.col(c).alias(f"{n}_{c}") for c in ("k", "v", "t", "__new")]) for n, x in zip("doa", frames))
    ten = F.expr("INTERVAL 10 seconds")
    j = d.join(o, (F.col("d_k") == F.col("o_k")) & F.col("o_t").between(F.col("d_t") - ten, F.col("d_t")))
    j = j.join(a, (F.col("d_k") == F.col("a_k")) & F.col("a_t").between(F.col("d_t"), F.col("d_t") + ten), "left")
    return operators.newly_known(j, ["d___new", "o___new"], {"a___new": F.col("d_t") + ten}, before, now).select("d_v", "o_v", "a_v")


def chained(spark, rows, **how):
    topics = [runner.Topic(f"chain-{n}", spark.createDataFrame(rows[n], CHAIN).repartition(3), F.col("ts_ms"), arrives=F.col("arrives")) for n in "doa"]
    return sorted((tuple(r) for r in runner.join_to_table(spark, topics, chain, "t-chain", 5_000, 20_000, **how).collect()), key=str)


def test_joins_of_streams_by_batch_are_those_of_the_whole(spark):
    """Matches over batch borders, repeated and unmatched rows, late ones, null keys and times; a run that is stopped and does its
    last batch again, and one in parts."""
    rng, sec, end = random.Random(5), 1000, 10**6
    rows = {n: [(rng.choice(["x", "y", "z", None]), 100 * i + j, t, t) for i in range(60) for j in range(rng.choice([0, 1, 2]))
                for t in [i * 4 * sec + rng.randrange(4 * sec)]] for n in "doa"}
    rows["d"] += [("x", -1, None, 0), *rows["d"][:5], ("late", 7, 2 * sec, 239 * sec)]
    rows["o"] += [("late", 8, 2 * sec, 2 * sec)]
    whole = []
    for k, v, t, at in rows["d"]:
        if t is None or at != t:  # without a time, or behind the watermark when it comes
            continue
        for o in rows["o"]:
            if k is not None and o[0] == k and t - 10 * sec <= o[2] <= t:
                found = [a[1] for a in rows["a"] if a[0] == k and t <= a[2] <= t + 10 * sec]
                whole += [(v, o[1], f) for f in found or [None]]
    whole.sort(key=str)
    assert any(r[2] is None for r in whole) and any(r[2] is not None for r in whole)
    rows = {n: [*((k, v, t, 4 * at) for k, v, t, at in rows[n]), (f"last {n}", 0, end, end)] for n in rows}  # spread over the slices
    assert chained(spark, rows, slices=1, rows_a_part=60) == whole
    name = scratch_dir(spark, "x").rsplit("/", 1)[-1]
    early = chained(spark, rows, slices=4, run=name, until=2)
    assert any(r[2] is not None for r in early) and len(early) < len(whole)  # what is matched comes out at once
    base = runner.job_dir(spark, "stream-t-chain", name)
    for f in (f"{base}/checkpoint/commits/1", f"{base}/checkpoint/commits/.1.crc"):
        if os.path.exists(f):
            os.remove(f)  # stopped after the batch had written, before it was done
    assert chained(spark, rows, slices=4, run=name) == whole
    assert not os.path.exists(f"{base}/out/held/batch=1") and spark.read.parquet(f"{base}/out/held/batch=3").count() == 3  # the last rows alone
