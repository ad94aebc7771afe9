"""Exact two-stage deduplication: equal bytes, then equal normalised text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.functions import text as T


def scanned(docs: DataFrame, path: Column, content: Column) -> DataFrame:
    """Files as (path, size_bytes, raw_sha256, text)."""
    return docs.select(path.alias("path"), F.octet_length(content).cast("long").alias("size_bytes"), F.sha2(content, 256).alias("raw_sha256"), content.alias("text"))


def raw_groups(files: DataFrame) -> DataFrame:
    """One row per distinct content: its smallest path and how many files have it."""
    return files.groupBy("raw_sha256").agg(F.min("path").alias("first_path"), F.count("*").alias("n_files"))


def with_fingerprints(files: DataFrame) -> DataFrame:
    """(path, size_bytes, raw_sha256, fingerprint), worked out where a file is read: normalising again costs less than a shuffle of texts.

    An unreadable file (null text) takes its raw hash as fingerprint. Generated,
    not projected: a filter, such as a join's for nulls, would fold every text
    once more, in a Python worker of its own.
    """
    return files.select("path", "size_bytes", "raw_sha256", F.explode(F.array(F.coalesce(T.fingerprint(F.col("text")), "raw_sha256"))).alias("fingerprint"))


def assigned(files: DataFrame) -> DataFrame:
    """With the representative (smallest path of the fingerprint) and whether a file is it.

    An aggregate and a join, not a window: a fingerprint that a third of all files share is never one task's sort.
    """
    first = files.groupBy("fingerprint").agg(F.min("path").alias("representative_path"))
    joined = files.join(first, "fingerprint")
    return joined.withColumn("status", F.when(F.col("path") == F.col("representative_path"), "scanned").otherwise("duplicate"))


def insert_if_absent(new: DataFrame, known: DataFrame, key: str = "id") -> DataFrame:
    """The rows of new whose key is not known."""
    return new.join(known.select(key), key, "left_anti")


def upserted(known: DataFrame, scan: DataFrame) -> DataFrame:
    """files after a scan: new facts replace the old of a path, status stays, files once seen are kept."""
    old, new = known.alias("o"), scan.alias("n")
    pick = lambda c: F.coalesce(F.col(f"n.{c}"), F.col(f"o.{c}")).alias(c)
    return old.join(new, F.expr("o.path = n.path"), "full_outer").select(
        pick("path"), pick("size_bytes"), pick("raw_sha256"), F.coalesce(F.col("o.status"), F.lit("scanned")).alias("status")
    )


def latest_by(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The row of the greatest order for each key; ties go to the greatest of the other columns, in turn."""
    rest = [c for c in rows.columns if c not in (key, order)]
    return rows.groupBy(key).agg(F.max(F.struct(order, *rest)).alias("r")).select(key, "r.*")


def pending(documents: DataFrame, limit: int | None = None) -> DataFrame:
    """Documents to process in path order; a negative limit is refused."""
    if limit is not None and limit < 0:
        raise ValueError("limit must not be negative")
    rows = documents.where("status in ('pending', 'extracted')").orderBy("representative_path")
    return rows if limit is None else rows.limit(limit)


#: Pieces of a scope's range of order values, each summed on its own.
PIECES = 64


def admitted(calls: DataFrame, budget: int, order: str, scope: str) -> DataFrame:
    """Which of a scope's calls a token budget admits, in order, as one worker would.

    reserve and actual are the tokens that a call asks for and then uses. The
    first denial stops the scope. order is a number, unique in its scope, and
    neither is null. A scope's range of order values is cut into PIECES that are
    summed first, so that running sums are per piece, however large the scope.
    """
    ranges = calls.groupBy(scope).agg(F.min(order).alias("_low"), F.max(order).alias("_high"))
    piece = F.floor((F.col(order) - F.col("_low")) * PIECES / (F.col("_high") - F.col("_low") + 1)).alias("_piece")
    cut = calls.join(ranges, scope).select(*calls.columns, piece)
    totals = cut.groupBy(scope, "_piece").agg(F.sum("actual").alias("_sum"))
    earlier = Window.partitionBy(scope).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    start = totals.select(scope, "_piece", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"))
    before = Window.partitionBy(scope, "_piece").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    used = cut.join(start, [scope, "_piece"]).withColumn("used_before", F.col("_start") + F.coalesce(F.sum("actual").over(before), F.lit(0)))
    denied = used.where(F.col("used_before") + F.col("reserve") > budget).groupBy(scope).agg(F.min(order).alias("_denied"))
    out = used.join(denied, scope, "left")
    return out.select(*calls.columns, "used_before", F.coalesce(F.col(order) < F.col("_denied"), F.lit(True)).alias("admitted"))
