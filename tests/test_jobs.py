"""Job semantics on hand-written rows (one test per reference decision)."""

import os
from collections import Counter
from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from dovetail.plans import cdc, facts, pages, rollups, streams, text
from dovetail.session import scratch_dir
from dovetail.sources import applog, io
from dovetail.sources.envelopes import ENVELOPE
from dovetail.sources.tables import load
from dovetail.streaming import operators as S
from dovetail.streaming.runner import BucketTable, KeyedState
from tests.conftest import SF


def env_rows(spark, rows):
    return spark.createDataFrame(rows, ENVELOPE)


def src(t):
    return {"db": "retail", "table": t}


def test_cart_add_rules(spark):
    rows = [
        ("r", None, {"id": "1", "user_id": "7", "sku_id": "3", "sku_num": "2"}, src("cart_info"), 1),
        ("c", None, {"id": "2", "user_id": "7", "sku_id": "4", "sku_num": "1"}, src("cart_info"), 2),  # insert kept
        ("u", {"sku_num": "2"}, {"id": "1", "user_id": "7", "sku_id": "3", "sku_num": "5"}, src("cart_info"), 3),
        ("u", {"sku_num": "5"}, {"id": "1", "user_id": "7", "sku_id": "3", "sku_num": "4"}, src("cart_info"), 4),
        ("d", {"id": "2", "sku_num": "1"}, None, src("cart_info"), 5),
        ("r", None, {"id": "9", "sku_num": "1"}, src("order_info"), 6),
    ]
    out = sorted((r.id, r.sku_num) for r in cdc.cart_add(env_rows(spark, rows)).collect())
    assert out == [("1", 2), ("1", 3), ("2", 1)]


def test_snapshot_gate_passes_marked_rows_and_tells_when_the_phase_ended(spark):
    snap = lambda t, mark="true": {**src(t), "snapshot": mark}
    rows = [
        ("r", None, {"id": "1"}, src("a"), 14_999), ("c", None, {"id": "2"}, snap("a"), 29_999),  # 15 s apart, over a span's end
        ("u", None, {"id": "1"}, snap("a", "false"), 40_000), (None, None, None, src("a"), 30_000),  # the first live row says nothing
        ("r", None, {"id": "3"}, src("b"), 5), ("r", None, {"id": "4"}, src("b"), 15_006), ("c", None, None, src("b"), 15_007),
        ("r", None, {"id": "5"}, src("c"), 1), ("r", None, {"id": "6"}, src("c"), None), ("r", None, {"id": "7"}, src("c"), 15_001),
        ("c", None, {"id": "8"}, src("live"), 1), ("r", None, {"id": "9"}, src("timeless"), None),
        ("r", None, {"id": "1"}, src("old"), -20_000), ("r", None, {"id": "2"}, src("old"), -5_000), ("d", None, None, src("old"), 10_000),
    ]
    got = {r.tbl: (r.n, r.ended_ms, r.reason) for r in cdc.snapshot_gate(env_rows(spark, rows).repartition(5)).collect()}
    assert got == {"a": (2, 30_000, "live row"), "b": (2, 15_005, "silence"), "c": (3, 30_001, "silence"), "timeless": (1, None, None),
                   "old": (2, 10_000, "live row")}


def test_partial_update_keeps_latest_non_null(spark):
    df = spark.createDataFrame([("a", "d1", 7, 2, "x", 1), ("a", "d1", None, 5, None, 3), ("a", "d1", None, None, "y", 2)],
                               "id string, ds string, user_id int, sku_num int, sku_name string, ts_ms long")
    values = ["user_id", "sku_num", "sku_name"]
    df = df.select("*", *[F.col("ts_ms").alias(f"{c}_at") for c in values])
    r = cdc.partial_update(df, ["id", "ds"], values, "ts_ms").collect()[0]
    assert (r.user_id, r.sku_num, r.sku_name, r.ts_ms) == (7, 5, "y", 3)


def test_partial_update_merges_into_stored_rows(spark):
    """Three micro-batches, the second replayed: as one batch would."""
    table, values = scratch_dir(spark, "t-partial"), ["a", "b"]
    rows = [[("k", 1, None, 10)], [("k", None, 5, 5), ("n", 2, 2, 6)], [("k", None, 7, 20), ("n", 9, None, 1)]]
    for i, r in [(0, rows[0]), (1, rows[1]), (1, rows[1]), (2, rows[2])]:
        b = spark.createDataFrame(r, "id string, a int, b int, ts long").select(
            "id", "a", "b", F.col("ts").alias("a_at"), F.col("ts").alias("b_at"), "ts")
        BucketTable(table, ("id",), 4).merge(b, i, lambda x: cdc.partial_update(x, ["id"], values, "ts"))
    out = BucketTable(table, ("id",), 4).read(spark, b.schema).select("id", "a", "b", "ts")
    assert sorted(tuple(r) for r in out.collect()) == [("k", 1, 7, 20), ("n", 2, 2, 6)]


def test_a_batch_writes_the_buckets_it_touches(spark):
    """One per cent of one bucket's keys: only that bucket has a new version; two versions are kept."""
    t = BucketTable(scratch_dir(spark, "t-buckets"), ("id",), 8)
    last = lambda x: x.groupBy("id").agg(F.max("v").alias("v"))
    whole = spark.range(4000).select("id", F.lit(0).alias("v"))
    t.merge(whole, 0, last)
    assert {b: v for b, v in t._versions(spark).items()} == {b: [0] for b in range(8)}
    of = whole.withColumn("b", F.pmod(F.xxhash64("id"), F.lit(8)))
    few = of.where("b = 3").orderBy("id").limit(5).select("id", F.lit(1).alias("v"))
    for n in (1, 2, 2, 3):
        t.merge(few.withColumn("v", F.lit(n)), n, last)
    assert {b: v for b, v in t._versions(spark).items()} == {**{b: [0] for b in range(8)}, 3: [2, 3]}
    got = {r.id: r.v for r in t.read(spark, whole.schema).collect()}
    assert len(got) == 4000 and sum(v == 3 for v in got.values()) == 5 and set(got.values()) == {0, 3}


def test_state_is_stored_as_changes(spark):
    """A batch stores the keys it saw; changes are merged now and then, old ones removed, forgotten keys dropped."""
    path = scratch_dir(spark, "t-state")
    st = KeyedState(path, "k", compact=3, drop=lambda d: d.where("t >= 100"))
    frame = lambda rows: spark.createDataFrame(rows, "k long, t long")
    st.write(frame([(i, i) for i in range(200)]), 0)
    for n in range(1, 8):
        st.write(frame([(150, 1000 + n)]), n)
        assert spark.read.parquet(f"{path}/batch={n}").count() == 1
        now = {r.k: r.t for r in st.read(spark, n + 1).collect()}
        assert now[150] == 1000 + n and now[199] == 199
    assert 5 not in now and not os.path.exists(f"{path}/batch=1")
    # a replay reads what was before it
    assert {r.k: r.t for r in st.read(spark, 7).collect()}[150] == 1006


def test_normalise_uses_before_for_deletes(spark):
    rows = [("d", {"id": "5", "sku_num": "3"}, None, src("cart_info"), 10),
            ("u", {"id": "6"}, {"id": "6", "sku_num": "4"}, src("cart_info"), 11)]
    out = sorted(tuple(r) for r in cdc.normalise(env_rows(spark, rows)).collect())
    assert out == [("retail", "cart_info", "d", "5_10", 3), ("retail", "cart_info", "u", "6_11", 4)]


def test_merge_report_replaces_by_key(spark):
    old = spark.createDataFrame([("d1", 1, 10), ("d2", 1, 99)], "dt string, recent_days int, n int")
    new = spark.createDataFrame([("d2", 1, 20)], "dt string, recent_days int, n int")
    assert sorted(tuple(r) for r in io.merge_report(old, new, ["dt", "recent_days"]).collect()) == [
        ("d1", 1, 10), ("d2", 1, 20)]


def test_stage_and_swap_and_guarded_load(spark):
    d = scratch_dir(spark, "t-swap")
    io.stage_and_swap(spark, spark.createDataFrame([(1,)], "a int"), d)
    v2 = io.stage_and_swap(spark, spark.createDataFrame([(2,)], "a int"), d)
    cur = io.current_version(spark, d)
    assert cur.endswith(v2.rsplit("/", 1)[-1]) and spark.read.parquet(cur).collect()[0].a == 2
    p = scratch_dir(spark, "t-guard")
    build = lambda: spark.createDataFrame([(1, "2024-01-01")], "x int, dt string")
    assert io.load_if_absent(spark, p, "2024-01-01", build) == "loaded"
    assert io.load_if_absent(spark, p, "2024-01-01", build) == "skipped"
    assert io.read_table(spark, p).count() == 1


def test_guided_payment_window(spark):
    click = datetime(2024, 1, 1, 10, 0, 0)
    clicks = spark.createDataFrame([("home", 1, 7, click), ("home", 1, 7, datetime(2024, 1, 1, 11, 0))],
                                   "page_id string, module_id int, user_id long, click_time timestamp")
    pays = spark.createDataFrame([
        (1, 7, click, Decimal("1.00"), 1),                                 # at the click
        (2, 7, datetime(2024, 1, 2, 0, 30), Decimal("2.00"), 1),           # after next midnight, within 24 h
        (3, 7, datetime(2024, 1, 2, 10, 0), Decimal("3.00"), 1),           # exactly 24 h later
        (4, 7, datetime(2024, 1, 2, 11, 0, 1), Decimal("4.00"), 1),        # beyond 24 h of both clicks
        (5, 8, click, Decimal("5.00"), 1)],                                # other user
        "pay_id long, pay_user long, pay_time timestamp, pay_amount decimal(18,2), product_id int")
    g = pages.guided(clicks, pays)
    # a payment after two clicks is counted once per module
    d = g.select("page_id", "module_id", "pay_id").distinct()
    assert sorted(r.pay_id for r in d.collect()) == [1, 2, 3]


def test_moderation_grades(spark):
    w, t0, t1 = text.BLOCK_WORDS[0], datetime(2024, 1, 1), datetime(2024, 1, 2)
    rows = [(1, 1, 7, f"fine text,{w}", t0), (2, 2, 7, f"has {w} and {text.BLOCK_WORDS[1]} inside", t0), (3, 3, 7, "clean", t0),
            (4, 3, 7, "a second comment on the order", t1), (3, 3, 7, "clean", t0), (5, 9, None, None, None)]
    df = spark.createDataFrame(rows, "id long, order_id long, user_id long, msg string, ts timestamp")
    got = text.moderate(df).collect()
    out = {r.id: (r.is_violation, r.violation_grade, r.violation_msg) for r in got}
    assert len(got) == 5            # the repeated delivery of 3 is dropped, the other comment on its order is not
    assert out[1] == (1, "P0", w)
    assert out[2] == (0, "P1", f"{w}, {text.BLOCK_WORDS[1]}")
    assert out[3] == out[4] == out[5] == (0, "", "")


def test_log_split_outputs(spark):
    rec = ('{"common":{"uid":"1","mid":"m1","is_new":"0","os":"iOS"},"page":{"page_id":"home","item":"5"},'
           '"displays":[{"item":"5","pos_id":1},{"item":"6","pos_id":2}],'
           '"actions":[{"action_id":"cart_add","item":"5","ts":11}],"err":{"error_code":3,"msg":"x"},"ts":10}')
    start = '{"common":{"uid":"2","mid":"m2","is_new":"1","os":"iOS"},"start":{"entry":"icon"},"ts":20}'
    lines = spark.createDataFrame([(1, rec), (2, start), (3, '{"common":{"mid":"m3"')], "event_id long, line string")
    parts = applog.split_log(applog.parse(lines))
    counts = {k: v.count() for k, v in parts.items()}
    assert counts == {"err": 1, "start": 1, "display": 2, "action": 1, "page": 1, "dirty": 1}
    assert parts["action"].collect()[0].ts == 10    # action rows keep ts


def in_batches(spark, rows, schema, step, sizes):
    """Rows through a stateful step, in batches of the given sizes; a step
    returns the state of the keys it saw."""
    out, state, known, at = [], None, {}, 0
    for n in sizes:
        got, new = step(spark.createDataFrame(rows[at:at + n], schema), state)
        out += [tuple(r) for r in got.collect()]
        known |= {r[0]: tuple(r) for r in new.collect()}
        state = spark.createDataFrame(list(known.values()), new.schema)
        at += n
    return sorted(out)


def test_newest_only_whatever_the_batches(spark):
    schema = "event_id long, user_id long, t long"
    rows = [(1, 7, 5), (2, 7, 3), (3, 7, 6), (4, 7, 6), (5, 8, 1), (6, 7, 2), (7, 8, 9), (8, 7, 8)]
    for sizes in ([8], [3, 5], [1] * 8):
        for piece in (2, 4096):
            got = in_batches(spark, rows, schema, lambda b, st: S.newest_only(b, st, "user_id", "event_id", "t", piece=piece), sizes)
            assert [r[0] for r in got] == [1, 3, 5, 7, 8]


def test_newest_only_forgets_idle_keys(spark):
    rows = [(1, 7, 100), (2, 7, 50), (3, 8, 5000), (4, 7, 90), (5, 7, 2000), (6, 7, 1500)]
    step = lambda ttl: lambda b, st: S.newest_only(b, st, "k", "i", "t", ttl_ms=ttl)
    assert [r[0] for r in in_batches(spark, rows, "i long, k long, t long", step(None), [2, 2, 2])] == [1, 3, 5]
    # within a batch nothing is forgotten; between batches, a gap above the limit is
    assert [r[0] for r in in_batches(spark, [(1, 7, 9000), (2, 7, 9100)], "i long, k long, t long", step(50), [1, 1])] == [1, 2]
    assert [r[0] for r in in_batches(spark, [(1, 7, 1000), (2, 7, 990), (3, 7, 1990)], "i long, k long, t long", step(900), [1, 1, 1])] == [1, 3]


def test_newest_only_on_a_key_of_many_rows(spark):
    import random
    rng = random.Random(1)
    rows = [(i, 7, rng.randrange(10 ** 6)) for i in range(15_000)]
    want, best = [], -1
    for i, _, t in rows:
        if t > best:
            want.append(i)
            best = t
    schema = "i long, k long, t long"
    for limit in ("100", "10000"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", limit)
        got, _ = S.newest_only(spark.createDataFrame(rows, schema).repartition(5), None, "k", "i", "t")
        assert sorted(r.i for r in got.collect()) == want
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_is_new_repair(spark):
    day = 86_400_000
    t = 1_704_067_200_000   # 2024-01-01
    rows = [(1, "a", "1", t), (4, "b", "0", t), (2, "a", "1", t + 1000), (5, "b", "1", t + 2000),
            (3, "a", "1", t + day)]     # a: new on day 1, not on day 2; b: old visitor flagged new later
    for sizes in ([5], [2, 3], [1, 1, 1, 1, 1]):
        got = in_batches(spark, rows, "event_id long, mid string, is_new string, ts_ms long", S.repair_is_new, sizes)
        assert [(r[0], r[4]) for r in got] == [(1, "1"), (2, "1"), (3, "0"), (4, "0"), (5, "0")]


def test_streams_do_not_depend_on_slices_or_files(spark, tmp_path):
    """1, 3 and (for the two quickest) 10 micro-batches over shuffled files give the same rows."""
    spark.read.parquet(f"{SF}/events.parquet").repartition(7).write.parquet(str(tmp_path / "events.parquet"))
    for fn in (streams.stream_tumble_last, streams.stream_dedup_exact, streams.interval_join_symmetric, streams.log_fix_is_new,
               streams.stream_monotonic_filter):
        seen = {frozenset(Counter(tuple(r) for r in fn(spark, d, slices=n).collect()).items())
                for d, n in ((SF, 1), (str(tmp_path), 10 if fn in (streams.stream_tumble_last, streams.log_fix_is_new) else 3))}
        assert len(seen) == 1, fn.__name__


def test_a_stopped_stream_is_carried_on(spark):
    name = scratch_dir(spark, "x").rsplit("/", 1)[-1]
    whole = Counter(tuple(r) for r in streams.stream_cancel_join(spark, SF).collect())
    part = streams.stream_cancel_join(spark, SF, run=name, until=2).count()
    again = Counter(tuple(r) for r in streams.stream_cancel_join(spark, SF, run=name).collect())
    assert part < sum(whole.values()) and again == whole
    # a run that has ended finds nothing new
    assert Counter(tuple(r) for r in streams.stream_cancel_join(spark, SF, run=name).collect()) == whole


def test_a_stopped_upsert_is_carried_on(spark):
    name = scratch_dir(spark, "x").rsplit("/", 1)[-1]
    cdc.sink_upsert_latest(spark, SF, run=name, until=2)
    again = Counter(tuple(r) for r in cdc.sink_upsert_latest(spark, SF, run=name).collect())
    assert again == Counter(tuple(r) for r in cdc.sink_upsert_latest(spark, SF).collect())


def test_load_sees_appended_rows(spark, tmp_path):
    df = spark.range(10).toDF("o_orderkey")
    df.write.parquet(str(tmp_path / "orders.parquet"))
    assert load(spark, str(tmp_path), "orders").count() == 10
    df.write.mode("append").parquet(str(tmp_path / "orders.parquet"))
    assert load(spark, str(tmp_path), "orders").count() == 20


def test_copy_reports_a_mismatch(spark):
    base = scratch_dir(spark, "t-copy")
    io.write_partitions(spark.createDataFrame([(1, "d1"), (2, "d2")], "x int, dt string"), f"{base}/src")
    assert io.copy_redate(spark, f"{base}/src", f"{base}/dst", "n").first().status == "success"
    io.write_partitions(spark.createDataFrame([(3, "d3")], "x int, dt string"), f"{base}/src")
    r = io.reconcile(spark, f"{base}/src", f"{base}/dst", "n").first()
    assert (r.source_rows, r.target_rows, r.status) == (3, 2, "mismatch")
    assert [x.dt for x in io.list_partitions(spark, f"{base}/src").collect()] == ["d1", "d2", "d3"]


def test_delivery_counts_at_the_receiver(spark):
    """Sender and receiver of an order in different cities."""
    one = {(r.sender_district_id, r.receiver_district_id) for r in facts.order_detail(spark, SF).select(
        "sender_district_id", "receiver_district_id").distinct().collect()}
    assert any(a != b for a, b in one)
    by = rollups.deliver_1d(spark, SF).groupBy("org_id").agg(F.sum("order_count").alias("n"))
    want = facts.by_milestone(spark, SF, facts.MILESTONES["deliver"]).select("order_id", "receiver_district_id", "dt").distinct() \
        .groupBy((F.col("receiver_district_id") - 10000).alias("org_id")).agg(F.count("*").alias("n"))
    assert sorted(tuple(r) for r in by.collect()) == sorted(tuple(r) for r in want.collect())


def test_scratch_dir_uses_session_checkpoint_dir(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert scratch_dir(spark, "x").startswith(os.path.join(base, "dovetail"))
