"""Readers for stored tables (parquet by default) and for raw document dumps."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
                 "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table_path(base: str, name: str) -> str:
    single = os.path.join(base, f"{name}.parquet")
    return single if "://" in base or os.path.exists(single) else os.path.join(base, name)


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Lazy parquet scan; projections and filters applied later reach the scan."""
    return spark.read.parquet(table_path(base, name))


#: Where a row stands in its input: file, start of the block that it was read with, and order within that.
POSITION = "_position"


def with_position(scan: DataFrame) -> DataFrame:
    """A scan of files plus the rows' places in the input (files by path), for operators that keep the first row.

    Must be applied to the scan itself. A block of a file is read by one task from its start to its end, so the ids that Spark counts up
    within a task order the rows of a block; between blocks their starts decide, between files the paths.
    """
    return scan.select("*", F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                                     F.monotonically_increasing_id().alias("row")).alias(POSITION))


# Raw activity-log documents: every variant name of a field is its own column,
# ids and timestamps are read as strings and normalised later (M0).
RAW_ACTIVITY_SCHEMA = T.StructType([
    T.StructField("member_id", T.StringType()),
    T.StructField("userId", T.StringType()),
    T.StructField("userID", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("customerId", T.StringType()),
    T.StructField("customerID", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("feature", T.StringType()),
    T.StructField("session_duration_sec", T.DoubleType()),
])

RAW_ONBOARDING_SCHEMA = T.StructType([
    T.StructField("member_id", T.StringType()),
    T.StructField("memberId", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("customerId", T.StringType()),
    T.StructField("step", T.StringType()),
    T.StructField("step_index", T.IntegerType()),
    T.StructField("completed", T.BooleanType()),
    T.StructField("timestamp", T.StringType()),
])


def read_json_documents(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Schema-on-read of a JSON-lines document dump (no inference pass).

    Variant names that differ only by case (``customerId`` / ``customerID``)
    need ``spark.sql.caseSensitive=true`` on the session that runs the job.
    Numbers arriving in string columns keep their JSON text ("3" or "3.0");
    :func:`lapse.functions.safe_bigint` handles both.
    """
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)
