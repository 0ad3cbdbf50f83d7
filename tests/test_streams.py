"""Streams fed in several files give the result of the batch form."""


import numpy as np
import pytest
from pyspark.sql import functions as F

from shoplens.operators.dated import KeyedTable
from shoplens.operators import gates, tables, traces
from shoplens.operators import preferences as P
from shoplens.schemas import ACTION_TYPES
from shoplens.sources import adapters as A
from shoplens.sources import streams
from shoplens.streaming.detect import ATTEMPT, log_attempts, scan_spans
from shoplens.streaming.gate_state import gate_stream
from shoplens.streaming.ingest import ingest, store_rows
from shoplens.streaming.preference_state import preference_stream
from shoplens.streaming.runner import drain

SF = "/root/testdata/sf0.001"
FILES = 3


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The events in time order, in several files that arrive one after the other."""
    path = str(tmp_path_factory.mktemp("events"))
    e = A.table(spark, SF, "events")
    n = e.count()
    for i in range(FILES):
        part = e.filter((F.col("event_id") >= n * i // FILES) & (F.col("event_id") < n * (i + 1) // FILES))
        part.coalesce(1).write.mode("append").parquet(path)
    return path


@pytest.fixture
def stream(spark, folder):
    return streams.read_files(spark, folder, streams.EVENTS_SCHEMA, files_per_trigger=1)


def batches(spark, path):
    return spark.read.parquet(path).select("batch_id").distinct().count()


def test_ingest_is_idempotent(spark, stream, tmp_path):
    actions = A.user_actions_of(stream)
    table, rejects = KeyedTable(str(tmp_path / "t"), actions.schema, "trace_id", "ts", ("ts", "event_id"), buckets=2), str(tmp_path / "r")
    for run in ("one", "two"):  # the second run starts over, as after a lost checkpoint
        drain(ingest(actions, tables.action_rules(ACTION_TYPES), table, rejects, str(tmp_path / run), once=True))
        assert [len(table.touched_by(spark, k)) > 0 for k in range(FILES + 1)] == [True] * FILES + [False]
    good, bad = tables.split_rejects(A.user_actions(spark, SF), tables.action_rules(ACTION_TYPES))
    assert table.read(spark).count() == good.count() and spark.read.parquet(rejects).count() == bad.count()


def test_taste_state_equals_the_fold(spark, stream, tmp_path):
    vectors = A.product_vectors(spark, SF)
    updates = preference_stream(A.user_actions_of(stream), vectors, 64)
    out = str(tmp_path / "out")
    drain(store_rows(updates, out, str(tmp_path / "c"), mode="update", once=True))
    assert batches(spark, out) == FILES
    got = {r["user_id"]: r for r in tables.read_current(spark, out, "user_id", ["updated_at"], updates.schema).collect()}
    want = {r["user_id"]: r for r in P.preference_fold(A.user_actions(spark, SF), vectors, 64).collect()}
    assert got.keys() == want.keys()
    for k, w in want.items():
        assert got[k]["action_count"] == w["action_count"]
        assert np.allclose(got[k]["preference_vector"], w["preference_vector"], atol=1e-9)


def test_gate_state_equals_the_batch_gate(spark, stream, tmp_path):
    out = str(tmp_path / "out")
    slower = lambda df: df.withColumn("ts", F.timestamp_seconds(F.lit(1704067200) + F.col("seq") * 400))  # several days
    drain(store_rows(gate_stream(slower(A.attempts_of(stream))), out, str(tmp_path / "c"), once=True))
    got = {r["attempt_id"] for r in spark.read.parquet(out).collect()}
    assert got == {r["attempt_id"] for r in gates.can_send(slower(A.attempts(spark, SF))).collect()}
    assert batches(spark, out) == FILES and len(got) < A.attempts(spark, SF).count()


def test_detection_chain(spark, stream, tmp_path):
    log, out = str(tmp_path / "log"), str(tmp_path / "out")
    actions = A.user_actions(spark, SF)
    drain(log_attempts(A.inventory_events_of(stream), lambda: actions, log, str(tmp_path / "c1"), cart_actions=["CLICK"], once=True))
    drain(store_rows(gate_stream(streams.read_files(spark, log, ATTEMPT)), out, str(tmp_path / "c2"), once=True))
    logged = spark.read.parquet(log)
    assert {r["attempt_id"] for r in spark.read.parquet(out).collect()} == {
        r["attempt_id"] for r in gates.can_send(logged).collect()}


def test_spans_of_a_trace_may_come_in_two_batches(spark, stream, tmp_path):
    found = str(tmp_path / "found")
    drain(scan_spans(A.spans_of(stream), str(tmp_path / "spans"), found, str(tmp_path / "c"), once=True))
    got = {(r["trace_id"], r["type"]) for r in spark.read.parquet(found).collect()}
    assert got == {(r["trace_id"], r["type"]) for r in traces.find_anomalies(A.spans(spark, SF)).collect()}
    assert spark.read.parquet(found).count() == len(got)
