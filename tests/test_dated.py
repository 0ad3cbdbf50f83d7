import datetime as dt

import pytest
from pyspark.errors import PySparkException

from shoplens.operators import dated, traces
from shoplens.operators.dated import KeyedTable

DAY = dt.datetime(2024, 3, 1)
ROWS = "k string, o int, ts timestamp, v string"


def at(day, hour=1):
    return DAY + dt.timedelta(days=day, hours=hour)


@pytest.fixture
def table(spark, tmp_path):
    return KeyedTable(str(tmp_path / "t"), spark.createDataFrame([], ROWS).schema, "k", "ts", ("o",), buckets=3)


def test_a_key_that_moves_to_another_day_leaves_the_old_one(spark, rows, table):
    table.merge(spark.createDataFrame([("a", 1, at(0), "x"), ("b", 1, at(0), "y"), ("c", 1, at(5), "z"), ("c", 0, at(4), "older")], ROWS), 0)
    table.merge(spark.createDataFrame([("a", 2, at(3), "x2"), ("b", 0, at(0), "y2")], ROWS), 1)
    assert rows(table.read(spark), "k", "v") == [("a", "x2"), ("b", "y2"), ("c", "z")]
    assert rows(table.read(spark, at(2), at(4)), "k") == [("a",)]
    # Day 4 never had a current row; day 0 keeps the bucket of b alone.
    assert dated.partitions(spark, table.path, "day") == ["2024-03-01", "2024-03-04", "2024-03-06"]


@pytest.mark.parametrize("newest_batch_wins,want", [(True, "late"), (False, "first")])
def test_which_row_wins(spark, rows, table, newest_batch_wins, want):
    table = KeyedTable(table.path, table.schema, "k", "ts", ("o",), 3, newest_batch_wins)
    table.merge(spark.createDataFrame([("a", 9, at(0), "first")], ROWS), 0)
    table.merge(spark.createDataFrame([("a", 1, at(1), "late")], ROWS), 1)
    assert rows(table.read(spark), "v") == [(want,)]


def test_replays_leave_one_copy_even_of_rows_without_key(spark, rows, table):
    one = spark.createDataFrame([("a", 1, at(0), "x"), (None, 1, at(0), "n"), (None, 1, at(0), "n"), ("t", 1, None, "no time")], ROWS)
    two = spark.createDataFrame([("a", 2, at(1), "x2"), (None, 1, at(0), "m")], ROWS)
    for batch, number in ((one, 0), (two, 1), (one, 0), (two, 1), (one, 0)):
        table.merge(batch, number)
    assert rows(table.read(spark), "k", "v") == [("a", "x2"), ("t", "no time"), (None, "m"), (None, "n"), (None, "n")]
    table.merge(two.where("false"), 1)  # delivered again, empty: its rows go
    assert rows(table.read(spark).where("k is null"), "v") == [("n",), ("n",)]
    assert table.touched_by(spark, 7) == set()


def test_a_merge_leaves_other_partitions_alone(spark, table):
    files = lambda: set(table.read(spark).inputFiles())
    table.merge(spark.createDataFrame([(f"k{i}", 1, at(i % 6), "x") for i in range(60)], ROWS), 0)
    before = files()
    table.merge(spark.createDataFrame([("k6", 2, at(0), "new")], ROWS), 1)
    assert len(before - files()) == 1 and len(files() - before) == 1
    assert len(table.touched_by(spark, 1)) == 1


def test_days_are_pruned_and_dropped(spark, table, capsys):
    table.merge(spark.createDataFrame([(f"k{i}", 1, at(i), "x") for i in range(10)], ROWS), 0)
    read = table.read(spark, at(3, 0), at(5, 0))
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "Exchange" not in plan
    assert read.count() == 2 and len(read.inputFiles()) >= 2
    assert dated.drop_before(spark, table.path, at(8).date()) == [f"2024-03-0{d}" for d in range(1, 9)]
    assert table.read(spark).count() == 2 and dated.drop_before(spark, table.path, at(8).date()) == []


def test_logs_by_day(spark, tmp_path):
    path = str(tmp_path / "log")
    df = spark.createDataFrame([("a", 1, at(0), "x"), ("b", 1, at(1), "y")], ROWS)
    for _ in range(2):
        dated.append_days(df, path, "ts", 4)
    dated.append_days(df, path, "ts", 5)
    assert dated.read_days(spark, path, df.schema, "ts").count() == 4
    assert dated.read_days(spark, path, df.schema, "ts", since=at(1, 0)).count() == 2
    assert dated.read_days(spark, str(tmp_path / "none"), df.schema, "ts").count() == 0


SPAN = ("trace_id string, span_id long, parent_id long, operation_name string, process_id string, "
        "processes map<string,struct<serviceName:string>>, start_us long, duration_us long, "
        "tags array<struct<key:string,type:string,value:string>>")
HOUR = dated.HOUR_US


def span(trace, i, start, dur):
    return (trace, i, None, "op", "p1", {"p1": ("svc",)}, start, dur, [])


def test_a_window_reads_its_hours_and_whole_traces(spark, rows, tmp_path):
    log = str(tmp_path / "log")
    df = spark.createDataFrame([
        span("in", 1, 10 * HOUR - 5, 10), span("in", 2, 10 * HOUR + 1_000, 700_000), span("early", 1, 9 * HOUR, 10),
        span("early", 2, 10 * HOUR - 20, 10), span("late", 1, 12 * HOUR, 5), span("old", 1, 2 * HOUR, 5)], SPAN)
    dated.append_spans(df.where("span_id = 1"), log, 0)
    dated.append_spans(df.where("span_id = 2"), log, 1)
    found = traces.stored_traces(spark, log, df.schema, 10 * HOUR - 100, 10 * HOUR, HOUR)
    assert rows(found, "trace_id", "span_id") == [("in", 1), ("in", 2)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(hour" in plan
    stored = spark.createDataFrame([], "trace_id string, type string, is_bookmark boolean")
    scan = traces.scan_stored_traces(spark, log, df.schema, stored, 10 * HOUR, longest_us=HOUR)
    assert rows(scan, "trace_id", "type") == rows(traces.anomaly_scan(df, stored, 10 * HOUR), "trace_id", "type") == [("in", "SLOW_TRACE")]


def test_a_trace_beyond_the_read_back_is_an_error(spark, tmp_path):
    log = str(tmp_path / "log")
    df = spark.createDataFrame([span("t", 1, 10 * HOUR, 10), span("t", 2, 10 * HOUR + 50, 10 * HOUR)], SPAN)
    dated.append_spans(df, log)
    with pytest.raises(PySparkException, match="longer than the read-back"):
        traces.stored_traces(spark, log, df.schema, 10 * HOUR, 10 * HOUR, HOUR).count()
    assert traces.stored_traces(spark, log, df.schema, 5 * HOUR, 6 * HOUR, HOUR).count() == 0
