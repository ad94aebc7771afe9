"""Balanced counters over files, documents and runs, and the evaluation against expected records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions import matchers

MILLION = 1_000_000


def cost(tokens_in: Column, tokens_out: Column, price_in: str, price_out: str) -> Column:
    """decimal(38,6), halves rounded up; prices are per million tokens."""
    part = lambda n, price: n.cast("decimal(20,0)") * F.lit(price).cast("decimal(12,6)")
    return F.round((part(tokens_in, price_in) + part(tokens_out, price_out)) / F.lit(MILLION).cast("decimal(7,0)"), 6).cast("decimal(38,6)")


def document_counts(documents: DataFrame) -> DataFrame:
    """One row: unique_documents, processed_ok, quarantined, not_started, in a single pass."""
    status = lambda *names: F.count_if(F.col("status").isin(*names))
    return documents.agg(
        F.count("*").alias("unique_documents"), status("done").alias("processed_ok"), status("quarantined").alias("quarantined"),
        status("pending", "extracted").alias("not_started"),
    )


def file_counts(files: DataFrame) -> DataFrame:
    return files.agg(F.count("*").alias("input_files"), F.count_if(F.col("status") == "duplicate").alias("duplicate_files"))


def quarantine_reasons(documents: DataFrame) -> DataFrame:
    return documents.where("status = 'quarantined'").groupBy("quarantine_reason").agg(F.count("*").alias("n"))


def latest_run(runs: DataFrame) -> DataFrame:
    """The run of the greatest id, with its wall time in seconds (null while it runs)."""
    last = runs.agg(F.max_by(F.struct(*runs.columns), "id").alias("r")).select("r.*")
    micros = F.unix_micros(F.col("ended_at").cast("timestamp")) - F.unix_micros(F.col("started_at").cast("timestamp"))
    return last.withColumn("wall_time_s", micros / F.lit(1e6))


def report(files: DataFrame, documents: DataFrame, runs: DataFrame) -> DataFrame:
    """The one-row report; the query fails where its counts do not balance."""
    reasons = quarantine_reasons(documents).agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("quarantine_reason", "n")))).alias("quarantine_by_reason")
    )
    one = file_counts(files).crossJoin(document_counts(documents)).crossJoin(reasons)  # single rows
    balanced = F.expr("input_files = duplicate_files + unique_documents and unique_documents = processed_ok + quarantined + not_started")
    one = one.withColumn("input_files", F.when(balanced, F.col("input_files")).otherwise(F.raise_error(F.lit("the report does not balance")).cast("long")))
    # an aggregate is one row also without any run
    digest = F.col("model_digest") if "model_digest" in runs.columns else F.lit(None)
    model = F.concat("model_tag", F.lit("@"), F.coalesce(digest, F.lit("")))
    last = latest_run(runs).select("tokens_in", "tokens_out", "estimated_cost", "wall_time_s", "backend", model.alias("model"), "stop_reason")
    zero, free = F.lit(0).cast("long"), F.lit("0.00")
    return one.crossJoin(last).withColumns(
        {"tokens_in": F.coalesce("tokens_in", zero), "tokens_out": F.coalesce("tokens_out", zero), "estimated_cost": F.coalesce("estimated_cost", free)}
    )


def matched(expected: DataFrame, files: DataFrame) -> DataFrame:
    """(row, document_id, same_files): each expected row's most frequent document, ties to the smaller id.

    expected: row and files (array of paths); files: path and document_id.
    """
    named = expected.select("row", F.explode("files").alias("path")).join(files.select("path", "document_id"), "path")
    votes = named.groupBy("row", "document_id").agg(F.count("*").alias("n"))
    best = votes.groupBy("row").agg(F.min_by("document_id", F.struct(-F.col("n"), "document_id")).alias("document_id"))
    # an expected row names a handful of files
    actual = files.join(best.select("document_id").distinct(), "document_id", "left_semi").groupBy("document_id").agg(F.sort_array(F.collect_set("path")).alias("actual"))
    wanted = expected.select("row", F.sort_array(F.array_distinct("files")).alias("wanted"))
    out = best.join(actual, "document_id").join(wanted, "row")
    return out.select("row", "document_id", F.col("wanted").eqNullSafe(F.col("actual")).alias("same_files"))


def missing(expected: DataFrame, files: DataFrame) -> DataFrame:
    """Expected rows of which no file is known."""
    named = expected.select("row", F.explode("files").alias("path")).join(files.select("path"), "path", "left_semi")
    return expected.join(named.select("row").distinct(), "row", "left_anti")


def extra(documents: DataFrame, found: DataFrame) -> DataFrame:
    """Documents that no expected row matched."""
    return documents.join(found.select(F.col("document_id").alias("id")), "id", "left_anti")


def field_matches(pairs: DataFrame) -> DataFrame:
    """(row, field, ok): pairs has expected and actual structs of the eight fields."""
    checks = [F.struct(F.lit(f).alias("field"), match(F.col(f"expected.{f}"), F.col(f"actual.{f}")).alias("ok")) for f, match in matchers.BY_FIELD.items()]
    return pairs.select("row", F.explode(F.array(*checks)).alias("m")).select("row", "m.field", "m.ok")


def field_accuracy(pairs: DataFrame) -> DataFrame:
    """(field, correct, total, accuracy) of the matched rows."""
    return field_matches(pairs).groupBy("field").agg(
        F.count_if("ok").alias("correct"), F.count("*").alias("total"), F.avg(F.col("ok").cast("double")).alias("accuracy")
    )
