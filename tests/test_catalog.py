"""Every catalogued query against its SQL on the smallest tables."""

import datetime
import os

import duckdb
import pytest

from paperloom.plans import catalog

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for name in os.listdir(DATA):
        con.sql(f"create view {name.split('.')[0]} as select * from '{DATA}/{name}'")
    return con


def plain(value):
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return tuple(map(plain, value)) if isinstance(value, (list, tuple)) else value


def rows(names, data):
    order = sorted(names)
    at = [names.index(c) for c in order]
    return order, sorted((tuple(plain(r[k]) for k in at) for r in data), key=str)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, sql, name):
    frame = catalog.QUERIES[name](spark, DATA)
    got = rows(frame.columns, frame.collect())
    if name in catalog.ORACLES:
        found = sql.sql(catalog.ORACLES[name])
        assert got == rows(found.columns, found.fetchall())
    else:
        assert got[1]


def test_charset_detect(spark):
    """Whole texts in every encoding that holds them, against the library's choice among the three."""
    from charset_normalizer import from_bytes

    polish = "Zażółć gęślą jaźń. Usługi księgowe świadczone są przez spółkę z o.o. w Łodzi, płatność w ciągu trzydziestu dni. "
    texts = {1: polish * 5, 2: "Größere Beträge werden überwiesen, sobald die Prüfung der Bücher abgeschlossen ist. " * 6, 3: "plain " * 200, 4: "Où est l'élève ? à bientôt " * 20, 5: "", 6: "„Łódź” – ąę" * 40}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {(r["doc_id"], r["encoding"]): r["text"] for r in catalog.read_back(docs).collect()}
    want = {}
    for k, t in texts.items():
        for e in ("utf-8", "cp1250", "iso-8859-2"):
            try:
                raw = t.encode(e)
            except UnicodeEncodeError:
                continue
            best = from_bytes(raw, cp_isolation=["utf-8", "cp1250", "iso-8859-2"]).best() if raw else None
            want[k, e] = None if not raw else raw.decode("utf-8", "replace") if best is None else str(best)
    assert got == want and {e for k, e in got if k == 1} == {"utf-8", "cp1250", "iso-8859-2"} and {e for k, e in got if k == 4} == {"utf-8"}
    assert all(got[k, "utf-8"] == t for k, t in texts.items() if t) and got[1, "cp1250"] == texts[1]
    whole = catalog.QUERIES["charset_detect"](spark, DATA).where("encoding = 'utf-8'")
    assert whole.count() == spark.read.parquet(f"{DATA}/documents.parquet").count()


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
