import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from shoplens.operators import gates, interest, notify, reports

T0 = dt.datetime(2024, 3, 1, 0, 0)
ATTEMPT = "attempt_id string, user_id long, product_id long, notification_type string, ts timestamp, seq long"


def attempts(spark, items):
    """(user, product, minutes after T0)."""
    return spark.createDataFrame([(f"a{i}", u, p, "PRICE_DROP", T0 + dt.timedelta(minutes=m), i)
                                  for i, (u, p, m) in enumerate(items)], ATTEMPT)


def ids(df):
    return sorted((r["attempt_id"] for r in df.select("attempt_id").collect()), key=lambda a: int(a[1:]))


def brute_force(items, limit=10, ttl=60, cap=True, dup=True):
    """One attempt at a time, as a service would do it."""
    count, last, out = {}, {}, []
    for i, (u, p, m) in sorted(enumerate(items), key=lambda x: (x[1][2], x[0])):
        day = (T0 + dt.timedelta(minutes=m, hours=9)).date()
        count[u, day] = count.get((u, day), 0) + 1
        if cap and count[u, day] > limit:
            continue
        if dup and (u, p) in last and m < last[u, p] + ttl:
            continue
        last[u, p] = m
        out.append(f"a{i}")
    return sorted(out, key=lambda a: int(a[1:]))


def test_eleventh_attempt_of_a_day_is_blocked(spark, rows):
    items = [(1, p, p) for p in range(12)] + [(1, 99, 15 * 60)]  # the last one is on the next Korean day
    got = gates.daily_cap(attempts(spark, items))
    assert [r[0] for r in rows(got.filter(~F.col("allowed")), "attempt_id")] == ["a10", "a11"]
    assert got.filter("attempt_id = 'a12'").first()["attempt_no"] == 1


def test_duplicates_are_measured_from_the_admitted_one(spark):
    items = [(1, 1, m) for m in (0, 30, 59, 60, 90, 120)]
    want = ["a0", "a3", "a5"]
    df = attempts(spark, items)
    assert ids(gates.duplicate_gate(df)) == want
    assert ids(gates.duplicate_gate_capped(df)) == want


def test_duplicates_use_up_the_daily_quota(spark):
    items = [(1, 1, 0)] * 6 + [(1, p, 1) for p in range(2, 7)]
    assert ids(gates.can_send(attempts(spark, items))) == ["a0", "a6", "a7", "a8", "a9"]


def test_a_key_of_many_attempts_is_gathered_by_islands(spark):
    """Ten attempts a day of one user for one product, 40 minutes apart, for ten years."""
    df = spark.range(36_500).select(
        F.concat(F.lit("a"), "id").alias("attempt_id"), F.lit(1).cast("long").alias("user_id"), F.lit(1).cast("long").alias("product_id"),
        F.lit("PRICE_DROP").alias("notification_type"), F.col("id").alias("seq"),
        F.timestamp_seconds(F.lit(1704067200) + F.floor(F.col("id") / 10) * 86400 + F.col("id") % 10 * 2400).alias("ts"))
    got = gates.can_send(df)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" in plan and "_island" in plan and "ArrowEval" not in plan
    assert ids(got) == ids(gates.duplicate_gate(df)) and got.count() == 3650 * 5
    # Longer pauses make islands that bridge days; they are folded in order.
    assert ids(gates.can_send(df.where("seq < 400"), hours=24)) == ids(gates.duplicate_gate(df.where("seq < 400"), hours=24))


@pytest.fixture(scope="module")
def noisy():
    rnd = random.Random(4)
    # user 1 holds a third of all rows
    return [(rnd.choice([1, 1, 2, 3, 4, 5]), rnd.randrange(3), rnd.randrange(3 * 24 * 60)) for _ in range(600)]


def test_gates_equal_brute_force(spark, noisy):
    df = attempts(spark, noisy)
    assert ids(gates.can_send(df)) == brute_force(noisy)
    assert ids(gates.within_daily_cap(df)) == brute_force(noisy, dup=False)
    assert ids(gates.duplicate_gate(df)) == brute_force(noisy, cap=False)


def test_split_hot_keys_equal_brute_force(spark, noisy):
    df = attempts(spark, noisy)
    assert ids(gates.duplicate_gate(df, hot_rows=20, segments=9)) == brute_force(noisy, cap=False)


def inventory(spark, items):
    """(id, product, previous price, current price, previous stock, current stock, minutes)."""
    data = [(i, n, p, "PRICE_CHANGE" if pp is not None else "STOCK_CHANGE", pp, cp, ps, cs, T0 + dt.timedelta(minutes=m))
            for n, (i, p, pp, cp, ps, cs, m) in enumerate(items)]
    return spark.createDataFrame(data, "inventory_event_id string, seq long, product_id long, event_type string, "
                                       "previous_price float, current_price float, previous_stock int, current_stock int, ts timestamp")


def actions(spark, items):
    data = [(i, u, p, t, T0 + dt.timedelta(minutes=m)) for i, (u, p, t, m) in enumerate(items)]
    return spark.createDataFrame(data, "event_id long, user_id long, product_id long, action_type string, ts timestamp")


@pytest.mark.parametrize("depth", [0, 1, 2, 3, None])
@pytest.mark.parametrize("limit", [3, 10_000])
def test_event_targets_equal_brute_force(spark, limit, depth):
    rnd = random.Random(7)
    days = 3
    acts = [(rnd.randrange(12), rnd.choice([1, 1, 2]), rnd.choice(["VIEW", "CLICK"]), rnd.randrange(10 * 1440)) for _ in range(500)]
    events = [(f"e{i}", rnd.choice([1, 1, 2]), 10.0, 5.0, None, None, rnd.randrange(10 * 1440)) for i in range(25)]
    # both ends of the window count
    acts += [(50, 1, "VIEW", 5000), (51, 1, "VIEW", 5000 - days * 1440), (52, 1, "VIEW", 5001), (53, 1, "VIEW", 4999 - days * 1440)]
    events += [("edge", 1, 10.0, 5.0, None, None, 5000)]
    got = interest.event_targets(inventory(spark, events), actions(spark, acts), ["VIEW"], days, limit, depth)
    found = {(r["inventory_event_id"], r["user_id"], r["n"], r["rank"]) for r in got.collect()}
    want = set()
    for e, p, *_x, t in events:
        n = {}
        for u, q, kind, m in acts:
            if q == p and kind == "VIEW" and t - days * 1440 <= m <= t:
                n[u] = n.get(u, 0) + 1
        ranked = sorted(n.items(), key=lambda x: (-x[1], x[0]))[:limit]
        want |= {(e, u, c, i + 1) for i, (u, c) in enumerate(ranked)}
    assert found == want
    if limit > 3:
        assert {u for e, u, *_ in found if e == "edge"} >= {50, 51}
        assert not {u for e, u, *_ in found if e == "edge"} & {52, 53}


def test_bucket_depth_follows_the_load(spark):
    few = inventory(spark, [("e", 1, 10.0, 5.0, None, None, 2000)])
    many = inventory(spark, [(f"e{i}", 1, 10.0, 5.0, None, None, 2000 + i % 500) for i in range(2000)])
    acts = actions(spark, [(i, 1, "VIEW", 1900 + i % 600) for i in range(3000)])
    spread = actions(spark, [(i, 1, "VIEW", 1990 if i < 100 else i) for i in range(100)] + [(i, 1, "VIEW", -9000) for i in range(4000)])
    assert interest._bucket_depth(acts, few, 3) == 0
    assert interest._bucket_depth(acts, many, 3) == 3
    assert interest._bucket_depth(spread, many, 3) == 1


def test_price_drop_message(spark):
    goods = spark.createDataFrame([(1, "Mug")], "product_id long, product_name string")
    events = inventory(spark, [("e1", 1, 100.0, 85.0, None, None, 600), ("e2", 1, 100.0, 95.0, None, None, 601),
                               ("e3", 9, None, None, 0, 4, 602)])
    acts = actions(spark, [(5, 1, "VIEW", 10), (6, 1, "PURCHASE", 10), (7, 9, "ADD_TO_CART", 20), (8, 9, "VIEW", 20)])
    drop = notify.detect_price_drop(events, acts, goods).collect()
    assert [(r["user_id"], r["body"], r["data"]["dropPercentage"], r["channels"], r["priority"]) for r in drop] == [
        (5, "Mug이(가) 15% 할인 중입니다!", "15", ["PUSH", "IN_APP"], "HIGH")]
    back = notify.detect_restock(events, acts, goods).collect()
    assert [(r["user_id"], r["body"], r["data"], r["channels"]) for r in back] == [
        (7, "상품이(가) 다시 입고되었습니다!", {"currentStock": "4"}, ["PUSH", "SMS"])]
    assert notify.detect_price_drop(events, acts, goods).collect()[0]["notification_id"] == drop[0]["notification_id"]


def test_daily_batch_uses_quota_without_results(spark):
    acts = actions(spark, [(1, 1, "VIEW", -5), (2, 1, "VIEW", -6), (3, 1, "VIEW", -7)])
    tries = notify.daily_attempts(acts, F.lit(T0))
    admitted = gates.can_send(tries)
    recs = spark.createDataFrame([(1, "knn", r, 10 + r, f"p{r}") for r in range(1, 6)],
                                 "user_id long, strategy string, rank int, product_id long, product_name string")
    sent = notify.daily_recommendations(admitted, recs)
    row = sent.first()
    assert (row["product_id"], row["body"]) == (11, "p1, p2, p3을(를) 추천드려요!")
    assert row["data"] == {"strategy": "knn", "productCount": "3", "productIds": "11,12,13"}
    report = notify.daily_batch_report(tries, admitted, sent).first()
    assert tuple(report) == (3, 1, 0, 2, 1)


def test_schedule_and_delivery(spark, rows):
    ranked = spark.range(1, 252).select(F.col("id").alias("rank"))
    s = notify.send_schedule(ranked).groupBy("chunk", "delay_ms").count()
    assert rows(s) == [(0, 0, 100), (1, 50, 100), (2, 100, 51)]
    notes = spark.createDataFrame([("n1", ["PUSH", "SMS"]), ("n2", ["FAX"])], "notification_id string, channels array<string>")
    hist = notify.delivery_history(notes, F.lit(T0))
    assert rows(hist, "notification_id", "status") == [("n1", "SENT"), ("n2", "FAILED")]
    assert rows(reports.channel_counts(notify.deliveries(notes))) == [("FAX", 1), ("PUSH", 1), ("SMS", 1)]


def test_request_stats_without_success(spark):
    df = spark.createDataFrame([(False, 5.0)], "ok boolean, latency_ms double")
    assert tuple(reports.request_stats(df).first()) == (1, 1, 0.0)


def test_all_kinds_share_one_daily_cap(spark):
    items = [(1, p, p) for p in range(8)]
    drops = attempts(spark, items)
    back = attempts(spark, items).withColumn("notification_type", F.lit("BACK_IN_STOCK")).withColumn("seq", F.col("seq") + 100)
    assert gates.can_send(drops.unionByName(back)).count() == 10
    assert gates.can_send(drops).count() + gates.can_send(back).count() == 16


def test_attempts_keep_their_order_with_very_many_users(spark):
    targets = spark.createDataFrame([("e1", 7, 1, 200_001), ("e1", 8, 1, 3), ("e2", 9, 1, 1)],
                                    "inventory_event_id string, user_id long, n long, rank int")
    events = spark.createDataFrame([("e1", 5, T0, 1), ("e2", 5, T0, 2)], "inventory_event_id string, product_id long, ts timestamp, seq long")
    got = notify.attempts_of(targets, events, "PRICE_DROP").orderBy("seq").collect()
    assert [r["user_id"] for r in got] == [8, 7, 9]


def test_gates_take_text_ids(spark):
    named = attempts(spark, [(1, 1, m) for m in (0, 30, 61)]).withColumn("user_id", F.lit("USER-000001")).withColumn("product_id", F.lit("P"))
    assert ids(gates.can_send(named)) == ["a0", "a2"]
    assert ids(gates.duplicate_gate(named)) == ["a0", "a2"]
