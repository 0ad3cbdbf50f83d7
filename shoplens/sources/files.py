"""File formats: bulk NDJSON catalogues, run results, trace dumps, failed-event lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.schemas import RUN_RESULT, TRACE

CATALOG_DOC = T.StructType([
    T.StructField("productId", T.StringType()), T.StructField("productName", T.StringType()),
    T.StructField("category", T.StringType()), T.StructField("brand", T.StringType()),
    T.StructField("price", T.FloatType()), T.StructField("stock", T.IntegerType()),
    T.StructField("description", T.StringType()), T.StructField("productVector", T.ArrayType(T.FloatType())),
    T.StructField("createdAt", T.LongType()), T.StructField("updatedAt", T.LongType()),
])


def write_catalog_ndjson(goods: DataFrame, path: str) -> None:
    """Bulk form: for each product an action line with its id, then the document line.

    Both lines are written as one text record, so they stay together however the files are split by the writer.
    """
    action = F.to_json(F.struct(F.struct(
        F.lit("product_index").alias("_index"), F.col("productId").alias("_id")).alias("index")))
    doc = F.to_json(F.struct(*[f.name for f in CATALOG_DOC.fields if f.name in goods.columns]))
    goods.select(F.concat_ws("\n", action, doc).alias("value")).write.mode("overwrite").text(path)


def load_catalog_ndjson(spark: SparkSession, path: str) -> DataFrame:
    """Documents of bulk files, one row per product id (the newest `updatedAt`). Action lines are dropped.

    The documents carry their id, so a file may be split anywhere between lines.
    """
    docs = spark.read.schema(CATALOG_DOC).json(path).filter(F.col("productId").isNotNull())
    rest = [f.name for f in CATALOG_DOC.fields[1:]]
    return docs.groupBy("productId").agg(
        F.max_by(F.struct(*rest), F.coalesce("updatedAt", F.lit(0))).alias("d")).select("productId", "d.*")


def read_run_results(spark: SparkSession, path: str) -> DataFrame:
    """One row per run file; files that cannot be read are skipped."""
    schema = T.StructType([*RUN_RESULT.fields, T.StructField("_corrupt", T.StringType())])
    rows = (spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt")
            .option("multiLine", True).json(path))
    return rows.filter(F.col("_corrupt").isNull() & F.col("id").isNotNull()).drop("_corrupt")


def read_traces(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TRACE).json(path)


def write_failed_events(rejects: DataFrame, path: str, max_records_per_file: int = 100_000) -> None:
    """Last-resort text lines `time|trace|user|product|action`, one folder per day, files of limited length."""
    line = F.concat_ws("|", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"),
                       *[F.coalesce(F.col(c).cast("string"), F.lit("null"))
                         for c in ("trace_id", "user_id", "product_id", "action_type")])
    (rejects.select(line.alias("value"), F.to_date("ts").alias("day")).write.mode("overwrite")
     .option("maxRecordsPerFile", max_records_per_file).partitionBy("day").text(path))


def read_failed_events(spark: SparkSession, path: str) -> DataFrame:
    parts = F.split("value", "\\|", 5)
    return spark.read.text(path).select(
        "day", F.to_timestamp(parts[0]).alias("ts"), parts[1].alias("trace_id"), parts[2].alias("user_id"),
        parts[3].alias("product_id"), parts[4].alias("action_type"))
