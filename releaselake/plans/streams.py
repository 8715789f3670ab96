"""The micro-batch sync over the events table as arriving registry rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import shared_path
from ..streaming.sync import compact, read_index, run_available
from .registry import ORACLES, QUERIES

ROWS = "provider_id string, kind string, id string, package string, cksum string, seq long"
DELIVERIES = 3


def registry_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as registry rows: a user's package, the key in the props its version, the kind of event its digest; and the delivery that brings each."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    return e.select(
        F.concat(F.lit("prov-"), F.col("user_id")).alias("provider_id"), F.lit("registry-index").alias("kind"), F.concat(F.get_json_object("props", "$.k"), F.lit(".0.0")).alias("id"),
        F.concat(F.lit("pkg-"), F.col("user_id")).alias("package"), F.md5(F.col("event_type").cast("binary")).alias("cksum"), F.col("event_id").cast("long").alias("seq"), (F.col("event_id") % DELIVERIES).alias("delivery"),
    )


def stream_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index after deliveries that disagree about releases: each is streamed in several batches of a job that starts anew from its checkpoint, and
    the table is compacted in between. Another job then takes in the last delivery again, which changes nothing."""
    rows, arrived, last = registry_rows(spark, sf_dir), shared_path(spark, "arrived"), shared_path(spark, "arrived-again")
    index, checkpoint = shared_path(spark, "stream-index"), shared_path(spark, "stream")
    for n in range(DELIVERIES):
        rows.where(F.col("delivery") == n).drop("delivery").repartition(2, "provider_id").write.mode("append").parquet(arrived)
        run_available(spark.readStream.schema(ROWS).option("maxFilesPerTrigger", 1).parquet(arrived), index, checkpoint).awaitTermination()
        if n == 1:
            compact(spark, index)
    rows.where(F.col("delivery") == DELIVERIES - 1).drop("delivery").write.parquet(last)
    run_available(spark.readStream.schema(ROWS).parquet(last), index, shared_path(spark, "stream-again")).awaitTermination()
    compact(spark, index)
    return read_index(spark, index).select("provider_id", "id", "cksum", "blob", (F.shiftright("batch", 32)).cast("int").alias("stream"))


QUERIES["stream_sync"] = stream_sync
ORACLES["stream_sync"] = f"""
SELECT concat('prov-', user_id) AS provider_id, concat(json_extract_string(props, '$.k'), '.0.0') AS id, md5(max_by(event_type, event_id % {DELIVERIES} * 1000000000000 + event_id)) AS cksum,
       concat('sources/registry-index/pkg-', user_id, '/', json_extract_string(props, '$.k'), '.0.0.tar.gz') AS blob, 1 AS stream
FROM events GROUP BY user_id, json_extract_string(props, '$.k')
"""
