"""Helpers of the training-data operators: shared storage, tolerant column selection, components."""

from __future__ import annotations

import uuid
from urllib.parse import urlparse

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Used only where the cluster names no shared folder, as in local tests.
LOCAL_SHARED = "/tmp/checkpoints"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a local default where it is unset."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the cluster shares")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(LOCAL_SHARED)
    return f"file://{LOCAL_SHARED}"


def table_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/paperloom/{tag}-{uuid.uuid4().hex}"


def local_path(path: str) -> str:
    """The mounted folder behind a path of the shared folder, for what Python itself reads and writes there."""
    url = urlparse(path)
    if url.scheme not in ("", "file"):
        raise ValueError(f"spark.checkpoint.dir must be a mounted file system, not {url.scheme}")
    return url.path


def stored(df: DataFrame, tag: str) -> tuple[DataFrame, str]:
    """Write a table to the shared folder and read it again: lineage is cut and survives lost executors."""
    path = table_path(df.sparkSession, tag)
    df.write.parquet(path)
    when_done_forget(df.sparkSession, path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def when_done_forget(spark: SparkSession, path: str) -> None:
    """Let Hadoop delete a table of the shared folder when this application ends."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)


def forget(spark: SparkSession, *paths: str) -> None:
    """Delete tables of the shared folder that nothing reads any more."""
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def whole_text(df: DataFrame, *keep: str) -> DataFrame:
    """The named columns and text, a null text being empty; columns beyond these are left out."""
    return df.select(*keep, F.coalesce(F.col("text"), F.lit("")).alias("text"))


def mapped(rows: DataFrame, run, schema: str) -> DataFrame:
    """mapInPandas whose first column is a long identifier, which travels as text: with a null in a batch, pandas would make it a double."""
    name = schema.split()[0]
    out = rows.withColumn(name, F.col(name).cast("string")).mapInPandas(run, schema.replace(" long", " string", 1))
    return out.withColumn(name, F.col(name).cast("long"))


def components(edges: DataFrame, tag: str = "components") -> DataFrame:
    """(node, component) for every node of the edges (a, b); component is the smallest node reachable.

    Alternating large-star and small-star rounds: each is an aggregate and an
    equi-join, so a node of any degree costs no collected list. Rounds are
    written to the shared folder; the loop ends when the edge set stays the same.
    Empty edges give an empty result; self loops are ignored.
    """
    spark = edges.sparkSession
    now, path = stored(_edge_set(edges.select(F.col("a").cast("long"), F.col("b").cast("long"))), tag)
    before = None
    while (state := _state(now)) != before and state[0]:
        before = state
        after, new = stored(_small_star(_large_star(now)), tag)
        forget(spark, path)
        now, path = after, new
    roots = now.select(F.col("b").alias("node")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )


def _edge_set(pairs: DataFrame) -> DataFrame:
    """Distinct edges, the larger node as a."""
    return (
        pairs.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return _edge_set(both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("a").agg(F.min("b").alias("m"))
    joined = edges.join(low, "a")
    return _edge_set(
        joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
    )


def find_roots(parent: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    at = parent[nodes]
    while True:
        up = parent[at]
        if np.array_equal(up, at):
            return at
        at = up


def unite(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the sets of i[k] and j[k] in a forest whose parents have the smaller index."""
    while i.size:
        ri, rj = find_roots(parent, i), find_roots(parent, j)
        parent[i], parent[j] = ri, rj
        apart = ri != rj
        if not apart.any():
            return
        i, j = i[apart], j[apart]
        ri, rj = ri[apart], rj[apart]
        parent[np.maximum(ri, rj)] = np.minimum(ri, rj)


def with_lengths(docs: DataFrame) -> DataFrame:
    """docs whose column n_chars, where there is one, is the length of text."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
