import datetime as dt

from pyspark.sql import functions as F

from shoplens.functions import vectors as FV
from shoplens.plans import all_queries
from shoplens.plans.stream_queries import event_files


def events(spark, path, n, ts):
    spark.range(n).select(
        F.col("id").alias("event_id"), F.lit(ts).cast("timestamp_ntz").alias("ts"), (F.col("id") % 7).alias("user_id"),
        F.when(F.col("id") % 2 == 0, "view").otherwise("purchase").alias("event_type"), F.lit(1.0).alias("value"),
        F.lit('{"k": 3}').alias("props")).write.parquet(f"{path}/events.parquet")


def test_upsert_behavior_reads_the_whole_table(spark, tmp_path):
    """Rows older than seven days are in the table as well."""
    events(spark, tmp_path, 20, dt.datetime(2023, 5, 1))
    assert all_queries()["upsert_behavior"](spark, str(tmp_path)).count() == 10


def test_the_norm_is_computed_once_a_row(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],), (None,)], "v array<double>").select("v", FV.l2_normalize(F.col("v")).alias("u"))
    assert [r["u"] for r in df.collect()] == [[0.6, 0.8], [0.0, 0.0], None]
    plan = df._jdf.queryExecution().analyzed().toString()
    assert "/ SQRT" not in plan.upper()


def test_a_micro_batch_has_more_files_the_more_events(spark, tmp_path, monkeypatch):
    import shoplens.plans.stream_queries as q

    events(spark, tmp_path, 900, dt.datetime(2024, 1, 1))
    monkeypatch.setattr(q, "ROWS_A_FILE", 100)
    stream = event_files(spark, str(tmp_path))
    assert stream.isStreaming
    seen = []
    stream.writeStream.foreachBatch(lambda b, i: seen.append({(r[0], r[1]) for r in b.select(
        "event_id", F.input_file_name()).collect()})).trigger(availableNow=True).start().awaitTermination()
    assert len(seen) == 3 and all(len({f for _, f in s}) == 3 for s in seen) and len({e for s in seen for e, _ in s}) == 900
