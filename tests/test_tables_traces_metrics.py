import datetime as dt

import pytest
from pyspark.sql import functions as F

from shoplens.functions import spans
from shoplens.operators import dated, logs, metrics, reports, snapshots, tables, traces
from shoplens.sources import files

T0 = dt.datetime(2024, 3, 1)


def test_upsert_keeps_the_last_and_every_row_without_id(spark, rows):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), (None, 3, "p"), (None, 3, "q")], "k string, o int, v string")
    assert rows(tables.latest_per_key(df, "k", ["o"]), "k", "v") == [("a", "y"), (None, "p"), (None, "q")]


def test_resent_batches_do_not_grow_the_table(spark, rows, tmp_path):
    path, compacted = str(tmp_path / "t"), str(tmp_path / "c")
    one = spark.createDataFrame([("a", 1, "x"), ("b", 9, "old")], "k string, o int, v string")
    two = spark.createDataFrame([("b", 2, "new"), (None, 3, "n")], "k string, o int, v string")
    for _ in range(2):
        tables.write_batch(one, path, 0)
        tables.write_batch(two, path, 1)
    want = [("a", "x"), ("b", "new"), (None, "n")]
    assert rows(tables.read_current(spark, path, "k", ["o"], one.schema), "k", "v") == want
    tables.compact(spark, path, compacted, "k", ["o"], one.schema)
    assert rows(tables.read_current(spark, compacted, "k", ["o"], one.schema), "k", "v") == want


def test_rejects_carry_all_reasons(spark, rows):
    df = spark.createDataFrame([(1, 1, "VIEW", T0), (None, 1, "X", T0), (2, None, "VIEW", None)],
                               "user_id int, product_id int, action_type string, ts timestamp")
    good, bad = tables.split_rejects(df, tables.action_rules(["VIEW"]))
    assert good.count() == 1
    assert rows(bad, "reject_reasons") == [(["no product", "no time"],), (["no user", "unknown action"],)]


def test_changes_apply_in_order(spark, rows):
    stored = spark.createDataFrame([(1, "n1", 10), (2, "n2", 20), (3, "n3", 30)], "id int, note string, v int")
    changes = spark.createDataFrame([
        (1, 1, "note", "first", None), (1, 2, "note", "second", None), (2, 3, "delete", None, None),
        (2, 4, "note", "lost", None), (4, 5, "insert", "n4", 40), (4, 6, "note", "changed", None),
        (3, 7, "delete", None, None), (3, 8, "insert", "back", 31), (9, 9, "note", "nobody", None)],
        "id int, seq long, op string, note string, v int")
    assert rows(tables.apply_changes(stored, changes, "id")) == [(1, "second", 10), (3, "back", 31), (4, "changed", 40)]


def test_snapshot_expires(spark, tmp_path):
    path = str(tmp_path / "s")
    df = spark.createDataFrame([(1, 1)], "product_id int, rank int")
    snapshots.write_snapshot(df, path, F.lit(T0))
    at = lambda m: F.lit(T0 + dt.timedelta(minutes=m))
    assert snapshots.read_snapshot(spark, path, at(9)).count() == 1
    assert snapshots.read_snapshot(spark, path, at(10)).count() == 0
    snapshots.write_snapshot(df.withColumn("product_id", F.lit(2)), path, at(5))
    assert [r["product_id"] for r in snapshots.read_snapshot(spark, path, at(9)).collect()] == [2]


def test_a_list_is_computed_once_in_ten_minutes(spark, tmp_path):
    path, calls = str(tmp_path / "s"), []
    df = spark.createDataFrame([(1, 1)], "product_id int, rank int")

    def ask(minute, rows=df):
        got = snapshots.refresh_snapshot(spark, path, df.schema, lambda: calls.append(minute) or rows, T0 + dt.timedelta(minutes=minute))
        return [r["product_id"] for r in got.collect()]

    empty = df.where("false")
    assert ask(0, empty) == [] and ask(1, empty) == []  # an empty list isn't stored
    assert ask(2) == ask(11) == [1] and calls == [0, 1, 2]
    assert ask(12, df.withColumn("product_id", F.lit(2))) == [2] and calls[-1] == 12
    # While another caller computes, the newest list is shown though it has expired.
    with dated.take_lease(spark, f"{path}-lease", 0) as mine:
        assert mine and ask(40) == [2] and calls[-1] == 12
    assert ask(40) == [1] and calls[-1] == 40
    # A caller that died leaves its lease; it is taken over after its time.
    spark._jvm.java.io.File(f"{path}-lease").createNewFile()
    spark._jvm.java.io.File(f"{path}-lease").setLastModified(1000)
    assert ask(60) == [1] and calls[-1] == 60


def test_unreadable_run_files_are_skipped(spark, tmp_path):
    (tmp_path / "a.json").write_text('{\n "id": "r1", "durationSec": 5,\n "finalMetrics": {"totalErrors": 2}}')
    (tmp_path / "b.json").write_text('{ "id": "r2", ')
    (tmp_path / "c.json").write_text("not json")
    got = files.read_run_results(spark, str(tmp_path))
    assert [(r["id"], r["finalMetrics"]["totalErrors"]) for r in got.collect()] == [("r1", 2)]


def test_bulk_catalogue_takes_the_newest_document(spark, tmp_path):
    (tmp_path / "x.ndjson").write_text(
        '{"index": {"_index": "product_index", "_id": "P1"}}\n{"productId": "P1", "productName": "old", "updatedAt": 1}\n'
        '{"index": {"_index": "product_index", "_id": "P1"}}\n{"productId": "P1", "productName": "new", "updatedAt": 2}\n')
    assert [(r["productId"], r["productName"]) for r in files.load_catalog_ndjson(spark, str(tmp_path)).collect()] == [("P1", "new")]


SPAN = ("trace_id string, span_id long, parent_id long, operation_name string, process_id string, "
        "processes map<string,struct<serviceName:string>>, start_us long, duration_us long, "
        "tags array<struct<key:string,type:string,value:string>>")


def span(trace, i, parent, start, dur, op="op", tags=(), process="p1"):
    return (trace, i, parent, op, process, {"p1": ("svc",)}, start, dur, [(k, "bool" if k == "error" else "string", v) for k, v in tags])


def test_tree_is_in_preorder(spark):
    df = spark.createDataFrame([
        span("t", 1, None, 100, 50), span("t", 2, 1, 130, 5), span("t", 3, 1, 110, 5), span("t", 4, 3, 112, 1),
        span("t", 5, 99, 50, 10), span("t", 6, None, 40, 1),
        span("t", 7, 8, 10, 1), span("t", 8, 7, 10, 1), span("t", 9, 8, 10, 1)], SPAN)  # 7 and 8 form a cycle
    got = traces.span_tree(df).orderBy("sort_key").collect()
    assert [(r["span_id"], r["depth"]) for r in got] == [(6, 0), (5, 0), (1, 0), (3, 1), (4, 2), (2, 1)]


def test_deep_chain(spark):
    df = spark.createDataFrame([span("t", i, i - 1 if i else None, i, 1) for i in range(40)], SPAN)
    assert [r["depth"] for r in traces.span_tree(df).orderBy("sort_key").collect()] == list(range(40))


def test_anomalies_one_per_trace_and_type(spark, rows):
    df = spark.createDataFrame([
        span("ok", 1, None, 0, 500_999), span("slow", 1, None, 0, 501_000),
        span("err", 1, None, 0, 10, tags=[("error", "true"), ("error.message", "a")]), span("err", 2, 1, 0, 10, tags=[("error", "true")]),
        span("dlq", 1, None, 0, 10, op="X.DLQ", process="nowhere"), span("dlq", 2, 1, 0, 9, tags=[("messaging.destination.name", "a.dlq")])], SPAN)
    found = traces.find_anomalies(df)
    assert rows(found, "trace_id", "type", "service_name", "error_message") == [
        ("dlq", "DLQ_ROUTED", "unknown", None), ("err", "ERROR_SPAN", "svc", "a"), ("slow", "SLOW_TRACE", "svc", None)]
    stored = spark.createDataFrame([("err", "ERROR_SPAN", False), ("slow", "SLOW_TRACE", True)],
                                   "trace_id string, type string, is_bookmark boolean")
    assert rows(traces.new_anomalies_only(found, stored), "trace_id") == [("dlq",), ("slow",)]
    late = spark.createDataFrame([span("in", 1, None, 300_000_000, 600_000), span("out", 1, None, 1, 600_000)], SPAN)
    assert rows(traces.anomaly_scan(late, stored, until_us=310_000_000), "trace_id") == [("in",)]


def test_list_order_decides_between_spans_that_start_together(spark, rows):
    """Ids are text; the first span of the list is the root although its id is the larger one."""
    kind = SPAN.replace("span_id long, parent_id long", "span_id string, parent_id string") + ", position int"
    one = lambda i, at, parent, op, tags=(): (*span("t", i, parent, 5, 600_000, op, tags), at)
    df = spark.createDataFrame([one("0a02", 1, None, "second", [("error", "true")]), one("ff01", 0, None, "first", [("error", "true")]),
                                one("aa03", 2, "ff01", "child"), one("0001", 3, "ff01", "late")], kind)
    assert traces.trace_summary(df).first()["root_operation"] == "first"
    assert set(rows(traces.find_anomalies(df), "type", "operation_name")) == {("ERROR_SPAN", "first"), ("SLOW_TRACE", "first")}
    assert [r["operation_name"] for r in traces.span_tree(df).orderBy("sort_key").collect()] == ["first", "child", "late", "second"]


def test_only_the_boolean_tag_is_an_error(spark):
    tags = spark.createDataFrame([(1, [("error", "bool", "true")]), (2, [("error", "string", "true")]), (3, [("error", "bool", "false")])],
                                 "n int, tags array<struct<key:string,type:string,value:string>>")
    got = {r["n"]: r["e"] for r in tags.select("n", spans.span_has_error(F.col("tags")).alias("e")).collect()}
    assert got == {1: True, 2: False, 3: False}


def test_an_empty_replay_replaces_its_batch(spark, tmp_path):
    path = str(tmp_path / "log")
    df = spark.range(5).withColumn("v", F.lit(1))
    tables.write_batch(df, path, 0)
    tables.write_batch(df, path, 1)
    tables.write_batch(df.where("false"), path, 1)
    assert spark.read.parquet(path).groupBy("batch_id").count().collect() == [(0, 5)]


def test_percentiles_of_batch_sizes_are_exact(spark):
    sizes = spark.range(1, 30_001).select(F.col("id").alias("size"))
    assert tuple(reports.batch_size_percentiles(sizes).first()) == (15_000, 27_000, 29_700)
    assert tuple(reports.batch_size_percentiles(sizes.where("false")).first()) == (None, None, None)


def test_unknown_service_counts_once(spark):
    df = spark.createDataFrame([span("t", 1, None, 0, 1), span("t", 2, 1, 0, 1, process="x"), span("t", 3, 1, 0, 1, process="y")], SPAN)
    assert traces.trace_summary(df).first()["service_count"] == 2


def series(spark, values, step=60, metric="m", le=None):
    return spark.createDataFrame([(metric, "a", le, T0 + dt.timedelta(seconds=i * step), float(v)) for i, v in enumerate(values)],
                                 "metric string, label string, le string, ts timestamp, value double")


def test_increase_survives_a_restart(spark):
    got = metrics.counter_increase(series(spark, [5, 8, 2, 4]), 300).orderBy("ts").collect()
    assert [r["increase"] for r in got] == [0, 3, 5, 7]
    assert metrics.counter_rate(series(spark, [0, 60]), 60).orderBy(F.desc("ts")).first()["rate"] == 1


@pytest.mark.parametrize("counts,q,want", [({"1": 0, "10": 100, "+Inf": 100}, 0.5, 5.5), ({"1": 10, "10": 10, "+Inf": 20}, 0.99, 10.0),
                                           ({"1": 0, "10": 0, "+Inf": 0}, 0.5, None), ({"1": 4, "10": 8, "+Inf": 8}, 0.5, 1.0)])
def test_histogram_quantile(spark, counts, q, want):
    df = spark.createDataFrame([("k", le, float(n)) for le, n in counts.items()], "k string, le string, value double")
    got = [r["quantile"] for r in metrics.histogram_quantile(df, ["k"], [q]).collect()]
    assert got == ([] if want is None else [pytest.approx(want)])


def test_alert_fires_only_after_its_time(spark):
    def firing(values, step=60):
        s = series(spark, values, step).select(F.lit("consumer_lag").alias("signal"), "label", "ts", "value")
        return [(r["alert"], (r["fired_at"] - r["active_since"]).total_seconds()) for r in metrics.alerts(s).collect()]

    assert firing([20_000] * 6) == [("HighKafkaConsumerLag", 300)]
    assert firing([20_000] * 5) == []
    assert firing([20_000, 20_000, 1, 20_000, 20_000, 20_000, 1]) == []


def test_ratio_of_nothing_is_null(spark):
    df = spark.createDataFrame([("hit", 0.0), ("miss", 0.0)], "metric string, value double")
    got = metrics.ratio(df.withColumn("k", F.lit(1)), ["k"], F.col("metric") == "hit", F.lit(True)).first()
    assert got["ratio"] is None


def test_compare_runs_knows_the_direction(spark, rows):
    cols = list(metrics.COMPARED)
    df = spark.createDataFrame([("a", *[10.0] * 8), ("b", *[5.0] * 7, None)], ["id", *cols])
    pairs = spark.createDataFrame([("a", "b")], "a_id string, b_id string")
    got = dict(rows(metrics.compare_runs(df, pairs), "metric", "verdict"))
    assert got["recApiP95Ms"] == "improved" and got["totalRequestsSent"] == "worsened" and got["esBulkSuccessRate"] == "unknown"


def test_late_and_long_lines_are_refused(spark):
    df = spark.createDataFrame([(T0, "x"), (T0 - dt.timedelta(hours=168), "x"), (T0 - dt.timedelta(hours=169), "x"),
                                (T0, "x" * (256 * 1024 + 1))], "ts timestamp, line string")
    assert logs.drop_late_logs(df, F.col("ts"), F.lit(T0), F.col("line")).count() == 2


def test_broken_log_line_keeps_its_row(spark):
    df = spark.createDataFrame([(1, '{"level": "WARN", "@timestamp": "2024-01-01T00:00:00Z"}'), (2, "plain text")], "n int, line string")
    got = {r["n"]: r for r in logs.parse_logs(df).collect()}
    assert got[1]["severity"] == "warning" and got[1]["ts"] == dt.datetime(2024, 1, 1)
    assert got[2]["level"] is None
