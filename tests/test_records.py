"""Whole runs with the fake backend: counts, retries, budget, breaker, resume, evaluation, command line."""

import json
import sqlite3
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest

from paperloom import config
from paperloom.__main__ import main
from paperloom.operators import records
from paperloom.sources import models


def settings(**retry):
    return config.merged({"backend": {"kind": "fake"}, "retry": {"backoff_base_s": 0.0} | retry, "pricing": {"input_per_million": 1000}})


def archive(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for name, data in {"a.txt": "Faktura 150,00 z dnia 15.03.2024", "b.txt": "faktura  150,00 Z DNIA 15.03.2024", "c.txt": "Faktura 150,00 z dnia 15.03.2024", "d.txt": "other text", "e.pdf": "no pdf", "f.txt": ""}.items():
        (folder / name).write_text(data)
    return str(folder)


ANSWER = json.dumps({"doc_type": "invoice", "summary": "Zażółć", "gross_amount": "150,00", "issue_date": "15.03.2024", "due_date": "1.1.2020", "currency": "zł"})


def test_run_report_and_evaluation(spark, tmp_path, capsys):
    source, db = archive(tmp_path), str(tmp_path / "db")
    assert records.run(spark, source, db, settings(), workers=2, model=models.Fake({}, ANSWER)) == "completed"
    found = records.Records(spark, db).report().first()
    assert (found["input_files"], found["duplicate_files"], found["unique_documents"], found["processed_ok"], found["quarantined"]) == (6, 2, 4, 2, 2)
    assert found["quarantine_by_reason"] == {"corrupt_file": 1, "empty_text": 1} and found["tokens_in"] == 200 and found["estimated_cost"] == "0.200000"
    by = {r["representative_path"]: r for r in records.Records(spark, db).results().collect()}
    assert str(by["a.txt"]["gross_amount"]) == "150.00" and str(by["a.txt"]["issue_date"]) == "2024-03-15" and by["a.txt"]["due_date"] is None
    assert by["d.txt"]["gross_amount"] is None and by["d.txt"]["currency"] == "PLN"
    # again: no new calls, counts as before
    assert records.run(spark, source, db, settings(), model=models.Fake({}, ANSWER)) == "completed"
    assert records.Records(spark, db).table("calls").count() == 2
    want = {"doc_type": "invoice", "gross_amount": "150.00", "issue_date": "2024-03-15", "currency": "PLN", "summary": "ą", "files": ["a.txt", "b.txt", "c.txt"]}
    (tmp_path / "e.jsonl").write_text(json.dumps(want) + "\n" + json.dumps({"files": ["zz.txt"]}) + "\n")
    got = records.evaluate(records.Records(spark, db), str(tmp_path / "e.jsonl"))
    assert got["dedup_correct"] == 1 and got["missing"] == [["zz.txt"]] and got["extra"] == ["d.txt", "e.pdf", "f.txt"] and set(got["field_accuracy"].values()) == {1.0}
    capsys.readouterr()
    assert main(["report", "--db", db, "--json"]) == 0 and json.loads(capsys.readouterr().out)["input_files"] == 6
    assert main(["export", "--db", db, "--sqlite", str(tmp_path / "o.sqlite")]) == 0
    with sqlite3.connect(tmp_path / "o.sqlite") as con:
        assert con.execute("select gross_amount, issue_date, status from documents where representative_path = 'a.txt'").fetchall() == [("150.00", "2024-03-15", "done")]
        assert con.execute("select count(*) from files").fetchone() == (6,) and con.execute("select count(*) from llm_calls").fetchone() == (2,)


def test_invalid_answers_are_tried_twice(spark, tmp_path):
    source, db = archive(tmp_path), str(tmp_path / "db")
    assert records.run(spark, source, db, settings(), model=models.Fake({}, "no json")) == "completed"
    found = records.Records(spark, db)
    assert found.report().first()["quarantine_by_reason"] == {"corrupt_file": 1, "empty_text": 1, "llm_invalid_output": 2}
    assert found.table("calls").count() == 4


def test_limits_budget_breaker_and_resume(spark, tmp_path):
    def _late(_):
        raise models.ModelTimeout("late")

    def _down(_):
        raise models.ModelUnavailable("down")

    source, db = archive(tmp_path), str(tmp_path / "db")
    assert records.run(spark, source, db, settings(), budget=10, model=models.Fake({}, ANSWER)) == "budget_exhausted"
    assert records.run(spark, source, db, settings(circuit_breaker_failures=3), model=models.Fake({}, _down)) == "backend_unavailable"
    assert records.run(spark, source, db, settings(max_retries=0), model=models.Fake({}, _late)) == "completed"
    assert records.Records(spark, db).report().first()["not_started"] == 2
    assert records.run(spark, source, db, settings(), limit=1, model=models.Fake({}, ANSWER)) == "limit_reached"
    assert records.run(spark, source, db, settings(), model=models.Fake({}, ANSWER)) == "completed"
    assert records.Records(spark, db).report().first()["processed_ok"] == 2


def test_budget_holds_with_tries_that_time_out(spark, tmp_path):
    def _late(_):
        raise models.ModelTimeout("late")

    source, db = archive(tmp_path), str(tmp_path / "db")
    rows = [{"id": "a", "reserve": 10}, {"id": "b", "reserve": 20}, {"id": "c", "reserve": 5}]
    assert records.granted(rows, 29, 3) == {"a": 2} and records.granted(rows, 35, 3) == {"a": 1, "b": 1, "c": 1}
    assert records.granted(rows, 65, 3) == {"a": 3, "b": 1, "c": 3} and records.granted(rows, 9, 3) == {}
    # room for more than one try, for fewer than two
    room = int(1.5 * (models.Fake({}).most_tokens + (len(models.SYSTEM.encode()) + 450) / 3))
    assert records.run(spark, source, db, settings(max_retries=2, circuit_breaker_failures=99), budget=room, model=models.Fake({}, _late)) == "budget_exhausted"
    assert records.Records(spark, db).table("calls").count() == 1


def test_http_backends():
    seen = []

    class Server(BaseHTTPRequestHandler):
        def reply(self, body, code=200):
            self.send_response(code)
            self.end_headers()
            self.wfile.write(json.dumps(body).encode())

        def do_GET(self):
            self.reply({"models": [{"name": "m", "digest": "sha256:d"}], "data": [{"id": "m"}]})

        def do_POST(self):
            seen.append(json.loads(self.rfile.read(int(self.headers["Content-Length"]))))
            if (prompt := seen[-1]["messages"][1]["content"]).isdigit():
                return self.reply({}, int(prompt))
            self.reply({"message": {"content": "x"}, "prompt_eval_count": 3, "eval_count": 4, "choices": [{"message": {"content": "y"}}], "usage": {"prompt_tokens": 5, "completion_tokens": 6}})

        def log_message(self, *_):
            pass

    server = HTTPServer(("127.0.0.1", 0), Server)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    at = {"base_url": f"http://127.0.0.1:{server.server_port}", "model_tag": "m", "model_digest": "d"}
    for kind, want in (("ollama", ("x", 3, 4)), ("openai_compat", ("y", 5, 6))):
        model = models.backend(config.merged({"backend": {"kind": kind, kind: at}}))
        model.verify()
        answer = model.ask("prompt")
        assert (answer.text, answer.tokens_in, answer.tokens_out) == want and seen[-1]["messages"][1]["content"] == "prompt"
        with pytest.raises(models.ModelUnavailable):
            model.ask("500")
        with pytest.raises(models.ModelError):
            model.ask("400")
        with pytest.raises(models.ModelError):
            models.backend(config.merged({"backend": {"kind": kind, kind: at | {"model_tag": "other"}}})).verify()
    server.shutdown()
    with pytest.raises(ValueError):
        config.merged({"limits": {"colour": 1}})


def test_command_line_refuses_no_workers(spark, tmp_path):
    assert main(["run", "--input", "x", "--db", str(tmp_path), "--workers", "0"]) == 2
