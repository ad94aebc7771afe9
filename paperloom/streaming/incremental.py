"""Incremental ingestion: each micro-batch of files is fingerprinted and added if absent."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.operators import dedup


def ingest(stream: DataFrame, state: str, checkpoint: str):
    """Run an available-now stream of (path, raw_sha256, text) into the append-only table at state.

    A path that is already there is left alone, so a batch that runs again adds nothing.
    """

    def add(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        new = dedup.with_fingerprints(batch.withColumn("size_bytes", F.lit(0))).drop("size_bytes").dropDuplicates(["path"])
        known = spark.read.schema("path string, raw_sha256 string, fingerprint string").option("recursiveFileLookup", "true").parquet(state)
        dedup.insert_if_absent(new, known, "path").write.mode("append").parquet(state)

    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark: SparkSession, state: str) -> DataFrame:
    """The files so far with representative and status, derived from the appended facts."""
    return dedup.assigned(spark.read.schema("path string, raw_sha256 string, fingerprint string").parquet(state))


def drained(spark: SparkSession, files: DataFrame) -> DataFrame:
    """Files streamed in two arrivals; (path, representative_path, status) afterwards."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the cluster shares")
        root = "file:///tmp/checkpoints"
    base = f"{root.rstrip('/')}/paperloom-stream-{uuid.uuid4().hex}"
    spark.createDataFrame([], "path string, raw_sha256 string, fingerprint string").write.parquet(f"{base}/state")
    for arrival in ("b", "a"):  # the smaller paths come last and still become representatives
        files.where(F.startswith("path", F.lit(arrival))).write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(files.schema).parquet(f"{base}/in")
        query = ingest(stream, f"{base}/state", f"{base}/log")
        query.awaitTermination()
    return current(spark, f"{base}/state").select("path", "representative_path", "status")
