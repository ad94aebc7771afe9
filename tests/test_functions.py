"""Scalar functions on tables of cases, and operators on small frames."""

import io
import time
import zipfile
from email.message import EmailMessage

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from paperloom.functions import fields, matchers, prompts
from paperloom.functions import text as T
from paperloom.operators import dedup, report
from paperloom.sources import extractors, files


def each(spark, values, f, kind="string"):
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(values)], f"k int, v {kind}")
    return [r[0] for r in rows.select("k", f(F.col("v")).alias("o")).orderBy("k").select("o").collect()]


def check(spark, f, cases):
    assert each(spark, list(cases), lambda c: f(c).cast("string")) == list(cases.values())


def test_tax_id(spark):
    check(spark, fields.tax_id, {
        "123-456-32-18": "1234563218", "PL 1234563218": "1234563218", "pl123.456.32.18": "1234563218", "1234563219": None, "123": None, "DE 123456789": "DE123456789",
        "GB12A": None, "": None, None: None, " 1234563218 ": "1234563218",
    })


def test_amount(spark):
    check(spark, fields.amount, {
        "1 234,56 zł": "1234.56", "1.234,56": "1234.56", "$1,234.56": "1234.56", "1234": "1234.00", "1,234": "1234.00", "1.234": "1.23", "12,5": "12.50", "-5,00": "-5.00",
        "zl. 150": "0.15", "1.005": "1.01", "1 234,50": None, "brak": None, "1-2": None, "9" * 39: None, None: None, "1,234,567.8": "1234567.80",
    })


def test_currency(spark):
    check(spark, fields.currency, {"zł": "PLN", "€": "EUR", " $ ": "USD", "PLN": "PLN", "zloty": "PLN", "złotych": None, "chf": "CHF", "Euro": "EUR", "x": None, None: None})


def test_date(spark):
    check(spark, fields.date, {
        "2024-03-05": "2024-03-05", "5.3.2024": "2024-03-05", "05/03/2024": "2024-03-05", "15 września 2024": "2024-09-15", "March 15, 2024": "2024-03-15", "may 1 2023": "2023-05-01",
        "2024-02-30": None, "15 March 2024": None, "32.13.2024": None, "0000-01-01": None, None: None, "5 PAŹDZIERNIKA 2020": "2020-10-05",
    })


def test_grounding(spark):
    row = spark.createDataFrame([("Faktura 15 września 2024, March 5, 2024, NIP 123-456", )], "t string")
    day = lambda d: fields.date_occurs(F.to_date(F.lit(d)), F.col("t"))
    got = row.select(day("2024-09-15"), day("2024-03-05"), day("2024-03-06"), fields.digits_occur(F.lit("12-34"), F.col("t")), fields.digits_occur(F.lit("x"), F.col("t"))).first()
    assert list(got) == [True, True, False, True, False]


def test_answers():
    ok = '{"doc_type": "other", "summary": "s"}'
    assert fields.parse_answer(ok)["summary"] == "s"
    assert fields.parse_answer('{"doc_type": "bill", "doc_type": "offer", "summary": "s"}')["doc_type"] == "offer"
    bad = [None, "", "[]", "x", '{"doc_type": "other"}', '{"doc_type": "x", "summary": "s"}', '{"doc_type": "other", "summary": 1}', ok[:-1] + ', "a": 1}',
           ok[:-1] + ', "currency": "' + "x" * 21 + '"}', ok[:-1] + ', "due_date": 5}']
    assert not any(fields.parse_answer(b) for b in bad)


def test_text(spark):
    assert each(spark, ["  Ａ B\n\tß ", "", None, "ŁÓDŹ"], T.normalized) == ["a b ss", "", None, "łódź"]
    assert each(spark, ["Faktura i umowa", "invoice", "zażółć", "nip"], T.language) == ["pl", "en", "pl", "en"]
    assert each(spark, ["", "abc", "abcd"], lambda c: T.input_tokens(c)) == [1, 2, 2]


def test_names(spark):
    rows = [("Acme Sp. z o.o.", '"ACME"', True), (None, "", True), ("Acme", None, False), ("Technova", "Technowa", True), ("Alfa", "Omega", False),
            ("Żółw S.A.", "zołw", True), ("GmbH", "Ltd.", True), ("", "Beta", False), ("A\u00a0 B,  C", "a b c", True)]
    frame = spark.createDataFrame(rows, "a string, b string, want boolean")
    assert frame.where(~F.col("want").eqNullSafe(matchers.names(F.col("a"), F.col("b")))).collect() == []


def test_excerpt():
    text = "a" * 5000 + " NIP 123 " + "b" * 5000
    got = prompts.excerpt_of(text, 3000)
    assert got.startswith("a" * 1000) and got.endswith("b" * 1000) and "NIP 123" in got and prompts.excerpt_of("short", 3000) == "short"
    assert got.count(prompts.GAP) == 2


def test_windows():
    at = lambda *places: "".join("total" if k in places else "....." for k in range(200))
    assert [len(w) for w in prompts.windows(at(0, 100), 10_000)] == [155, 305]
    # the second hit is inside the first window, the third window begins in it, the fourth touches nothing
    assert [len(w) for w in prompts.windows(at(31, 40, 60, 130), 10_000)] == [305, 305]
    # the first keyword's window fills the budget
    assert len(prompts.windows("nip" + "." * 1000 + "vat", 100)) == 1 and prompts.windows("nip", 0) == [] and prompts.windows("", 5) == []
    # a clipped window that ends in the first one is turned down
    assert prompts.windows("vat" + "x" * 149 + "nip" + "y" * 149 + "vat", 10_000) == ["t" + "x" * 149 + "nip" + "y" * 149 + "v"]


def test_two_stages(spark):
    rows = [("b.txt", "Hello  World"), ("a.txt", "hello world"), ("c.txt", "Hello  World"), ("d.txt", None), ("e.txt", "other")]
    frame = spark.createDataFrame([(p, len(t or ""), f"h{t}", t) for p, t in rows], "path string, size_bytes long, raw_sha256 string, text string")
    got = {r["path"]: (r["representative_path"], r["status"]) for r in dedup.assigned(dedup.with_fingerprints(frame)).collect()}
    assert got == {"a.txt": ("a.txt", "scanned"), "b.txt": ("a.txt", "duplicate"), "c.txt": ("a.txt", "duplicate"), "d.txt": ("d.txt", "scanned"), "e.txt": ("e.txt", "scanned")}


def test_budget_stops_at_the_first_denial(spark):
    rows = [("r", 1, 50, 40), ("r", 2, 50, 10), ("r", 3, 60, 1), ("r", 4, 1, 1), ("s", 1, 101, 0)]
    got = dedup.admitted(spark.createDataFrame(rows, "run string, k int, reserve int, actual int"), 100, "k", "run").orderBy("run", "k").collect()
    assert [r["admitted"] for r in got] == [True, True, False, False, False]
    with pytest.raises(ValueError):
        dedup.pending(spark.createDataFrame([], "status string, representative_path string"), -1)


def test_cost(spark):
    got = spark.range(1).select(report.cost(F.lit(1_500_000), F.lit(1), "0.15", "0.5").cast("string")).first()[0]
    assert got == "0.225001"


def test_unbalanced_report_fails(spark):
    files_ = spark.createDataFrame([("scanned",), ("duplicate",)], "status string")
    docs = spark.createDataFrame([("done", None), ("quarantined", "corrupt_file")], "status string, quarantine_reason string")
    runs = spark.createDataFrame([], "id long, started_at timestamp, ended_at timestamp, tokens_in long, tokens_out long, estimated_cost string, backend string, model_tag string, stop_reason string")
    with pytest.raises(Exception, match="balance"):
        report.report(files_, docs, runs).collect()
    one = report.report(files_.union(files_.where("status = 'scanned'")), docs, runs).first()
    assert one["quarantine_by_reason"] == {"corrupt_file": 1} and one["unique_documents"] == 2


# ------------------------------------------------------------------ sources


def docx_of(*lines):
    space = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    body = "".join(f"<w:p><w:r><w:t>{x}</w:t></w:r></w:p>" for x in lines)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f"<w:document {space}><w:body>{body}<w:tbl><w:tr><w:tc><w:p><w:r><w:t>cell</w:t></w:r></w:p></w:tc></w:tr></w:tbl></w:body></w:document>")
    return out.getvalue()


def test_extractors():
    read = extractors.read
    assert read("a.TXT", "Zażółć".encode("utf-8")) == ("Zażółć", None)
    polish = "Zażółć gęślą jaźń, proszę o płatność za usługi świadczone w październiku. " * 3
    assert read("a.txt", polish.encode("cp1250")) == (polish, None)
    assert read("a.txt", b"") == (None, "empty_text") and read("a.txt", b" \n") == (None, "empty_text")
    assert read("a.html", b"<html><head><title>T</title></head><body><script>x</script><p>One<p>Two &amp; 3</body>") == ("One\nTwo & 3", None)
    assert read("a.docx", docx_of("One", "Two")) == ("One\nTwo", None) and read("a.docx", b"PK bad") == (None, "corrupt_file")
    assert read("a.pdf", b"nothing") == (None, "corrupt_file") and read("a.pdf", b"%PDF-1.4 /Encrypt 5 0 R") == (None, "encrypted")
    assert read("a.xyz", b"x") == (None, "unsupported_format")


def test_large_text_keeps_both_ends(monkeypatch):
    monkeypatch.setattr(extractors, "LARGE", 500_000)
    text = extractors.read("a.txt", b"h" * 300_000 + b"t" * 300_000)[0]
    assert text == "h" * 200_000 + extractors.CUT + "t" * 200_000


def test_mail_with_attachments():
    mail = EmailMessage()
    mail["From"], mail["To"], mail["Subject"] = "a@b.c", "d@e.f", "Hi"
    mail.set_content("Body text")
    mail.add_attachment(docx_of("Inside"), maintype="application", subtype="octet-stream", filename="x.docx")
    mail.add_attachment(b"zz", maintype="application", subtype="octet-stream", filename="y.bin")
    text = extractors.read("m.eml", mail.as_bytes())[0]
    assert text.startswith("From: a@b.c\nTo: d@e.f\nSubject: Hi\nDate: ") and "Body text" in text and "[Zalacznik: x.docx]\nInside" in text
    assert "[Zalacznik: y.bin - nie udalo sie odczytac]" in text


def _hang(*_):
    time.sleep(60)


def _die(*_):
    import os

    os._exit(9)


def test_isolation():
    assert extractors.isolated(extractors.read, ("a.txt", b"ok"), 20) == ("ok", None)
    assert extractors.isolated(_hang, (), 0.5) == (None, "extract_timeout")
    assert extractors.isolated(_die, (), 20) == (None, "extract_crash")


def test_archives(spark, tmp_path):
    (tmp_path / "in" / ".dir").mkdir(parents=True)
    for name, data in {"b.txt": "bb", "_a.txt": "a", ".hidden": "x", "expected.jsonl": "{}", ".dir/c.txt": "c"}.items():
        (tmp_path / "in" / name).write_text(data)
    got = {r["path"]: (r["size_bytes"], r["raw_sha256"]) for r in files.read_archive(spark, str(tmp_path / "in")).drop("content").collect()}
    assert set(got) == {"b.txt", "_a.txt", ".dir/c.txt"} and got["b.txt"][0] == 2
    with zipfile.ZipFile(tmp_path / "ok.zip", "w") as z:
        z.writestr("x/a.txt", "hello")
    assert [r["path"] for r in files.read_archive(spark, str(tmp_path / "ok.zip")).collect()] == ["x/a.txt"]
    for name in ("../evil.txt", "/etc/evil.txt"):
        with zipfile.ZipFile(tmp_path / "bad.zip", "w") as z:
            z.writestr(name, "x")
        with pytest.raises(files.UnsafeArchive):
            files.read_archive(spark, str(tmp_path / "bad.zip"))
    with zipfile.ZipFile(tmp_path / "bomb.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a.txt", b"0" * (5 << 20))
    with pytest.raises(files.UnsafeArchive):
        files.read_archive(spark, str(tmp_path / "bomb.zip"), most_mb=1)
    with pytest.raises(ValueError):
        files.read_archive(spark, str(tmp_path / "none"))


def python_nodes(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython")


def test_files_are_folded_once(spark):
    """Before, a join's filter for nulls folded every text once more, in a second worker."""
    found = spark.createDataFrame([("a", 3, "r1", "Łódź"), ("b", 3, "r2", "łódź "), ("c", 1, "r3", None)], "path string, size_bytes long, raw_sha256 string, text string")
    done = dedup.assigned(dedup.with_fingerprints(found))
    assert python_nodes(done) <= 2  # the files, and those that the smallest paths are taken from
    assert sorted((r["path"], r["representative_path"], r["status"]) for r in done.collect()) == [("a", "a", "scanned"), ("b", "a", "duplicate"), ("c", "c", "scanned")]


def test_workers_hold_slices_of_texts():
    texts = [None, "Straße", "ﬁ", "ŁÓDŹ é"] * T.SLICE
    for f, want in ((T._folded, [None, "strasse", "fi", "łódź é"]), (T._bare, [None, "Straße", "fi", "ŁODZ e"])):
        pieces = list(f.func(iter([pa.array(texts), pa.array(texts[:3])])))
        assert max(map(len, pieces)) <= T.SLICE and [t for piece in pieces for t in piece.to_pylist()] == want * T.SLICE + want[:3]


def test_names_take_two_workers(spark):
    """One makes both names of a row plain, one compares them; before there were five."""
    cases = [("Żółw Sp. z o.o.", "\"ZOLW\"", False), ("Café S.A.", "CAFE", True), ("Straße GmbH", "strasse", True), (None, "", True), ("", "é", False), ("ﬁrma Ltd", "FIRMA", True)]
    got = spark.createDataFrame([(k, *c[:2]) for k, c in enumerate(cases)], "k int, a string, b string").select("k", "a", "b", matchers.names(F.col("a"), F.col("b")).alias("ok"))
    assert python_nodes(got) == 2 and [r["ok"] for r in got.orderBy("k").collect()] == [c[2] for c in cases]
    both = got.select("a", T.bare_folded(F.col("a")).alias("x"), T.folded(T.without_marks(F.col("a"))).alias("y"))
    assert all(r["x"] == r["y"] for r in both.collect())
