"""Runs over an archive: scan, extract, deduplicate, ask the model, keep typed records.

State is a folder of append-only Parquet tables, from which everything current is
derived: scans (facts of files, each new text committed with them), calls (the
journal of model calls) and runs (start and end events). A run that is killed
leaves whole commits only; the next one goes on from them.
"""

from __future__ import annotations

import random
import time
from collections.abc import Iterator
from datetime import datetime, timezone
from decimal import Decimal

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom import config
from paperloom.functions import fields, prompts
from paperloom.functions import text as T
from paperloom.operators import dedup, report
from paperloom.sources import extractors, files, models

SCHEMAS = {
    "scans": "path string, size_bytes long, raw_sha256 string, fingerprint string, reason string, text string, run_id long",
    "calls": "document_id string, run_id long, batch long, json_attempt int, sub_attempt int, status string, raw string, tokens_in long, tokens_out long, started_at timestamp, finished_at timestamp",
    "runs": "id long, event string, at timestamp, input_path string, config_hash string, backend string, model_tag string, model_digest string, workers int, limit_n int, budget long, stop_reason string, tokens_in long, tokens_out long, estimated_cost string",
}
JSON_ATTEMPTS = 2
#: Calls of a worker in one committed batch.
PER_WORKER = 4


def states(files: DataFrame, calls: DataFrame) -> DataFrame:
    """(id, representative_path, status, quarantine_reason, invalid, raw) of every document.

    The reason is that of its smallest path, else that of answers that stayed invalid; raw is the latest good answer.
    """
    first = files.groupBy(F.col("fingerprint").alias("id")).agg(F.min("path").alias("representative_path"), F.min_by("reason", "path").alias("reason"))
    good = F.col("status") == "ok"
    asked = calls.groupBy(F.col("document_id").alias("id")).agg(
        F.count_if(good).alias("ok"), F.count_if(F.col("status") == "invalid_json").alias("invalid"),
        F.max(F.when(good, F.struct("run_id", "batch", "raw"))).alias("answer"),
    )
    rows = first.join(asked, "id", "left")
    status = F.when(F.col("reason").isNotNull(), "quarantined").when(F.col("ok") > 0, "done").when(F.col("invalid") >= JSON_ATTEMPTS, "quarantined").otherwise("pending")
    reason = F.coalesce("reason", F.when(status == "quarantined", "llm_invalid_output"))
    return rows.select("id", "representative_path", status.alias("status"), reason.alias("quarantine_reason"), F.coalesce("invalid", F.lit(0)).alias("invalid"), F.col("answer.raw").alias("raw"))


def first_texts(scans: DataFrame) -> DataFrame:
    """(id, text): of each fingerprint, the text of the smallest path that has one."""
    return scans.where("text is not null").groupBy(F.col("fingerprint").alias("id")).agg(F.min_by("text", "path").alias("text"))


class Records:
    """The tables under a folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        for name, schema in SCHEMAS.items():
            at = spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
            if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
                spark.createDataFrame([], schema).write.parquet(f"{self.folder}/{name}")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.folder}/{name}")

    def add(self, name: str, rows: DataFrame) -> None:
        want = self.spark.createDataFrame([], SCHEMAS[name])
        rows.select(*[F.col(f.name).cast(f.dataType) for f in want.schema]).write.mode("append").parquet(f"{self.folder}/{name}")

    def files(self) -> DataFrame:
        """The latest facts of each path, with representative and status."""
        latest = dedup.latest_by(self.table("scans").drop("text"), "path", "run_id")
        found = dedup.assigned(latest.select("path", "size_bytes", "raw_sha256", "fingerprint", "reason"))
        return found.withColumn("document_id", F.col("fingerprint"))

    def documents(self, with_text: bool = False) -> DataFrame:
        """Documents with status, derived from the scans and the journal."""
        rows = states(self.files(), self.table("calls"))
        if not with_text:
            return rows
        return rows.join(first_texts(self.table("scans")), "id", "left")

    def results(self) -> DataFrame:
        """The typed fields of finished documents."""
        done = self.documents(with_text=True).where("status = 'done'").withColumn("answer", fields.valid_answer("raw"))
        return done.withColumns(fields.postprocess(F.col("answer"), F.col("text"))).drop("answer", "raw", "text", "invalid")

    def as_tables(self) -> dict[str, DataFrame]:
        """What an export holds: runs, files, every document with its fields, and the journal."""
        documents = self.documents().drop("raw", "invalid")
        documents = documents.join(self.results().drop("representative_path", "status", "quarantine_reason"), "id", "left")
        return {"runs": self.runs(), "files": self.files(), "documents": documents, "llm_calls": self.table("calls")}

    def runs(self) -> DataFrame:
        """One row per run: its start, and its end where there is one."""
        events = self.table("runs")
        start, end = events.where("event = 'start'"), events.where("event = 'end'")
        ends = end.select("id", F.col("at").alias("ended_at"), "stop_reason", "tokens_in", "tokens_out", "estimated_cost")
        return start.drop("stop_reason", "tokens_in", "tokens_out", "estimated_cost", "event").withColumnRenamed("at", "started_at").join(ends, "id", "left")

    def report(self) -> DataFrame:
        return report.report(self.files(), self.documents(), self.runs())


def scan(records: Records, run_id: int, source: str, settings: dict) -> None:
    """Add the facts of new or changed files; a content is extracted once, whoever has it."""
    found = files.read_archive(records.spark, source, int(settings["limits"]["max_zip_uncompressed_mb"]))
    known = records.table("scans")
    new = found.drop("content").join(known.select("path", "raw_sha256").distinct(), ["path", "raw_sha256"], "left_anti")
    seen = known.groupBy("raw_sha256").agg(F.max(F.struct("run_id", "fingerprint", "reason")).alias("s")).select("raw_sha256", "s.fingerprint", "s.reason")
    fresh = new.join(seen.select("raw_sha256"), "raw_sha256", "left_anti").groupBy("raw_sha256").agg(F.min("path").alias("path"))
    content = found.select("path", "content").join(fresh, "path")
    texts = extractors.extracted(content, settings["limits"]["extract_timeout_s"]).join(fresh, "path")
    made = texts.select("raw_sha256", F.coalesce(T.fingerprint(F.col("text")), "raw_sha256").alias("fingerprint"), "reason", "text", F.col("path").alias("reader"))
    old = seen.select("raw_sha256", "fingerprint", "reason", F.lit(None).cast("string").alias("text"), F.lit(None).cast("string").alias("reader"))
    rows = new.join(made.unionByName(old), "raw_sha256").withColumn("text", F.when(F.col("path") == F.col("reader"), F.col("text")))
    records.add("scans", rows.withColumn("run_id", F.lit(run_id)))


def _call_rows(part: pd.DataFrame, model, retry: dict) -> Iterator[tuple]:
    """The journal rows of each prompt: as many tries as are granted, with growing pauses, after a timeout or failure."""
    for document_id, attempt, tries, prompt in zip(part["id"], part["json_attempt"], part["tries"], part["prompt"]):
        for sub in range(tries):
            if sub:
                time.sleep(min(retry["backoff_base_s"] * 2 ** (sub - 1), retry["backoff_max_s"]) * (1 + random.random() / 4))
            began, answer = datetime.now(timezone.utc), models.Answer(None, 0, 0)
            try:
                answer = model.ask(prompt)
                status = "ok" if fields.parse_answer(answer.text) else "invalid_json"
            except models.ModelTimeout:
                status = "timeout"
            except models.ModelUnavailable:
                status = "unavailable"
            except models.ModelError:
                status = "refused"
            yield document_id, attempt, sub, status, answer.text, answer.tokens_in, answer.tokens_out, began, datetime.now(timezone.utc)
            if status not in ("timeout", "unavailable"):
                break


def granted(rows: list, room: int, most: int) -> dict[str, int]:
    """Tries by id: one for each of the first rows whose reserves fit the room together, then further ones, up to most, while they fit."""
    tries: dict[str, int] = {}
    for r in rows:
        if r["reserve"] > room:
            break
        tries[r["id"]], room = 1, room - r["reserve"]
    for r in rows[: len(tries)]:
        extra = min(most - 1, room // r["reserve"])
        tries[r["id"]], room = 1 + extra, room - extra * r["reserve"]
    return tries


def ask_all(records: Records, run_id: int, settings: dict, model, workers: int, limit: int | None, budget: int | None) -> str:
    """Ask the model about pending documents in path order, batch by committed batch; returns why it stopped.

    Every try is reserved for: a batch is admitted as long as one try of each of its
    documents fits the budget, and what is left then grants further tries, so the
    budget can't be exceeded. A document that fails in this run is left for the next one;
    failures in a row, over the breaker's bound, end the run.
    """
    limits, own = settings["limits"], settings["self_entities"]
    most = int(limits["max_prompt_input_tokens"] * limits["bytes_per_token_estimate"])
    taken, used, in_row, batch, retry = 0, 0, 0, 0, settings["retry"]
    every = retry["max_retries"] + 1
    system = len(models.SYSTEM.encode())
    while True:
        tried = records.table("calls").where(F.col("run_id") == run_id).groupBy("document_id").agg(F.max_by("status", F.struct("batch", "sub_attempt")).alias("last"))
        out = tried.where("last in ('timeout', 'unavailable', 'refused')").select(F.col("document_id").alias("id"))
        room = workers * PER_WORKER if limit is None else min(workers * PER_WORKER, limit - taken)
        live = records.documents(with_text=True).where("status = 'pending'").join(out, "id", "left_anti")
        if room <= 0:
            return "limit_reached" if not live.isEmpty() else "completed"
        text = prompts.excerpt(F.coalesce("text", F.lit("")), most)
        prompt = prompts.prompt(text, T.language(text), tuple(own["names"]), tuple(own["tax_ids"]))
        rows = live.orderBy("representative_path").limit(room).select("id", "representative_path", (F.col("invalid") + 1).cast("int").alias("json_attempt"), prompt.alias("prompt"))
        rows = rows.withColumn("reserve", T.input_tokens(F.concat(F.lit("x" * system), F.col("prompt")), limits["bytes_per_token_estimate"]) + model.most_tokens)
        chosen = sorted(rows.collect(), key=lambda r: r["representative_path"])  # workers x PER_WORKER rows
        if not chosen:
            return "completed"
        tries = {r["id"]: every for r in chosen}
        if budget is not None:
            tries = granted(chosen, budget - used, every)
            chosen = [r for r in chosen if r["id"] in tries]
            if not chosen:
                return "budget_exhausted"
        batch += 1

        def ask(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            columns = ["document_id", "json_attempt", "sub_attempt", "status", "raw", "tokens_in", "tokens_out", "started_at", "finished_at"]
            for part in parts:
                yield pd.DataFrame(list(_call_rows(part, model, retry)), columns=columns)

        schema = "document_id string, json_attempt int, sub_attempt int, status string, raw string, tokens_in long, tokens_out long, started_at timestamp, finished_at timestamp"
        sent = records.spark.createDataFrame([(r["id"], r["json_attempt"], tries[r["id"]], r["prompt"]) for r in chosen], "id string, json_attempt int, tries int, prompt string")
        records.add("calls", sent.repartition(workers).mapInPandas(ask, schema).withColumns({"run_id": F.lit(run_id), "batch": F.lit(batch)}))
        reserve = {r["id"]: r["reserve"] for r in chosen}
        made = records.table("calls").where((F.col("run_id") == run_id) & (F.col("batch") == batch)).orderBy("finished_at").collect()
        for call in made:
            used += reserve[call["document_id"]] if call["status"] == "timeout" else call["tokens_in"] + call["tokens_out"]
            in_row = in_row + 1 if call["status"] in ("timeout", "unavailable") else 0
            if in_row >= retry["circuit_breaker_failures"]:
                return "backend_unavailable"
        if any(c["status"] in ("timeout", "unavailable") and c["sub_attempt"] + 1 == tries[c["document_id"]] < every for c in made):
            return "budget_exhausted"
        taken += len({c["document_id"] for c in made if c["status"] != "invalid_json" or c["json_attempt"] >= JSON_ATTEMPTS})


def run(spark: SparkSession, source: str, folder: str, settings: dict, workers: int = 1, limit: int | None = None, budget: int | None = None, model=None) -> str:
    """One run over an archive; returns its stop reason."""
    if workers < 1 or limit is not None and limit < 0:
        raise ValueError("workers must be positive, limit not negative")
    model = model or models.backend(settings)
    model.verify()
    records = Records(spark, folder)
    run_id = (records.table("runs").agg(F.max("id")).first()[0] or 0) + 1
    kind = settings["backend"]["kind"]
    own = settings["backend"][kind]

    def event(name: str, reason: str | None, tokens: tuple[int, int], cost: str) -> None:
        row = (run_id, name, datetime.now(timezone.utc), source, config.config_hash(settings), kind, own["model_tag"], own["model_digest"], workers, limit, budget, reason, *tokens, cost)
        records.add("runs", spark.createDataFrame([row], SCHEMAS["runs"]))

    event("start", None, (0, 0), "0")
    scan(records, run_id, source, settings)
    reason = ask_all(records, run_id, settings, model, workers, limit, budget)
    spent = records.table("calls").where(F.col("run_id") == run_id).agg(F.coalesce(F.sum("tokens_in"), F.lit(0)).alias("i"), F.coalesce(F.sum("tokens_out"), F.lit(0)).alias("o"))
    price = [str(Decimal(str(settings["pricing"][k]))) for k in ("input_per_million", "output_per_million")]
    total = spent.withColumn("c", report.cost(F.col("i"), F.col("o"), *price).cast("string")).first()
    event("end", reason, (total["i"], total["o"]), total["c"])
    return reason


EXPECTED = ", ".join(f"{f} string" for f in fields.ANSWER_LIMITS) + ", files array<string>"


def evaluate(records: Records, expected_path: str) -> dict:
    """Accuracy by field and the missing, extra and regrouped rows, against a JSON-lines file."""
    lines = records.spark.read.schema(EXPECTED).option("mode", "FAILFAST").json(expected_path)
    expected = lines.withColumn("row", F.array_join(F.sort_array("files"), "\n"))
    known = records.files().select("path", "document_id")
    found = report.matched(expected, known)
    results = records.documents().select("id", "representative_path").join(records.results().drop("representative_path", "status", "quarantine_reason"), "id", "left")
    names = list(fields.ANSWER_LIMITS)
    pairs = found.join(expected, "row").join(results.withColumnsRenamed({n: f"got_{n}" for n in names}), F.col("document_id") == F.col("id"), "left").select(
        "row", F.struct(*names).alias("expected"), F.struct(*[F.col(f"got_{n}").cast("string").alias(n) for n in names]).alias("actual")
    )
    by_field = {r["field"]: r for r in report.field_accuracy(pairs).collect()}
    return {
        "expected_documents": expected.count(),
        "matched_documents": found.count(),
        "dedup_correct": found.where("same_files").count(),
        "missing": [r["row"].split("\n") for r in report.missing(expected, known).select("row").orderBy("row").collect()],
        "extra": [r["representative_path"] for r in report.extra(records.documents(), found).orderBy("representative_path").collect()],
        "field_correct": {n: by_field[n]["correct"] if n in by_field else 0 for n in names},
        "field_total": {n: by_field[n]["total"] if n in by_field else 0 for n in names},
        "field_accuracy": {n: by_field[n]["accuracy"] if n in by_field else None for n in names},
    }
