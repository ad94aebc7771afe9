"""Named queries over the driver's tables and the SQL they are held against.

The tables hold no invoices, so field queries render their inputs from orders
and customers in several layouts and must recover what was rendered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.functions import fields, matchers, prompts
from paperloom.functions import text as T
from paperloom.operators import dedup, report

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document twice: as it is, and as a variant that differs in bytes only where doc_id % 3 says so."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    a = dedup.scanned(docs, F.concat(F.lit("a/"), F.lpad(F.col("doc_id").cast("string"), 9, "0"), F.lit(".txt")), F.col("text"))
    loud = F.upper(F.replace(F.col("text"), F.lit("ß"), F.lit("ss")))
    variant = F.when(F.col("doc_id") % 3 == 0, F.col("text")).when(F.col("doc_id") % 3 == 1, F.replace(loud, F.lit(" "), F.lit("  ")))
    variant = variant.otherwise(F.concat(F.lit("\n"), F.col("text"), F.lit("\n")))
    b = dedup.scanned(docs, F.concat(F.lit("b/"), F.lpad(F.col("doc_id").cast("string"), 9, "0"), F.lit(".txt")), variant)
    return a.unionByName(b)


#: The same files in SQL, with the normalised text's hash.
FILES_SQL = r"""
docs as (select doc_id, coalesce(text, '') as text from documents),
files as (
  select 'a/' || lpad(doc_id::varchar, 9, '0') || '.txt' as path, text from docs
  union all
  select 'b/' || lpad(doc_id::varchar, 9, '0') || '.txt',
         case doc_id % 3 when 0 then text when 1 then replace(upper(replace(text, 'ß', 'ss')), ' ', '  ') else chr(10) || text || chr(10) end from docs
),
hashed as (
  select path, strlen(text) as size_bytes, sha256(text) as raw_sha256,
         sha256(trim(regexp_replace(replace(lower(text), 'ß', 'ss'), '\s+', ' ', 'g'))) as fingerprint from files
)
"""


@query(f"with {FILES_SQL} select path, size_bytes, raw_sha256 from hashed")
def scan_manifest(spark, sf_dir):
    return files(spark, sf_dir).select("path", "size_bytes", "raw_sha256")


@query(f"with {FILES_SQL} select raw_sha256, min(path) as first_path, count(*) as n_files from hashed group by 1")
def raw_groups(spark, sf_dir):
    return dedup.raw_groups(files(spark, sf_dir))


@query(f"with {FILES_SQL} select path, fingerprint from hashed")
def text_fingerprint(spark, sf_dir):
    return dedup.with_fingerprints(files(spark, sf_dir)).select("path", "fingerprint")


@query(
    f"""with {FILES_SQL}, firsts as (select fingerprint, min(path) as representative_path from hashed group by 1)
select path, fingerprint, representative_path, case when path = representative_path then 'scanned' else 'duplicate' end as status
from hashed join firsts using (fingerprint)"""
)
def two_stage_dedup(spark, sf_dir):
    found = dedup.assigned(dedup.with_fingerprints(files(spark, sf_dir)))
    return found.select("path", "fingerprint", "representative_path", "status")


@query(
    f"""with {FILES_SQL}, marked as (select path, case when size_bytes % 5 = 0 then raw_sha256 else fingerprint end as fingerprint from hashed)
select path, fingerprint, min(path) over (partition by fingerprint) as representative_path from marked"""
)
def unreadable_files(spark, sf_dir):
    """A fifth of the files without text: their bytes alone say which are equal."""
    found = files(spark, sf_dir).withColumn("text", F.when(F.col("size_bytes") % 5 != 0, F.col("text")))
    return dedup.assigned(dedup.with_fingerprints(found)).select("path", "fingerprint", "representative_path")


@query(f"with {FILES_SQL} select fingerprint as id, raw_sha256 as text_sha256 from hashed qualify row_number() over (partition by fingerprint order by path) = 1")
def first_text(spark, sf_dir):
    from paperloom.operators import records

    found = files(spark, sf_dir).withColumn("fingerprint", T.fingerprint(F.col("text")))
    return records.first_texts(found).select("id", F.sha2("text", 256).alias("text_sha256"))


@query(
    f"""with {FILES_SQL}, first as (
  select fingerprint as id, path as representative_path, case size_bytes % 9 when 0 then 'corrupt_file' when 1 then 'encrypted' end as reason,
         instr('0123456789abcdef', left(fingerprint, 1)) - 1 as k from hashed qualify row_number() over (partition by fingerprint order by path) = 1)
select id, representative_path, case when reason is not null then 'quarantined' when k < 6 or k between 9 and 11 then 'done' when k < 9 then 'quarantined' else 'pending' end as status,
  coalesce(reason, case when k between 6 and 8 then 'llm_invalid_output' end) as quarantine_reason,
  (case when k between 6 and 8 then 2 when k between 9 and 13 then 1 else 0 end)::bigint as invalid,
  case when k < 6 then 'answer 0' when k between 9 and 11 then 'answer 1' end as raw from first"""
)
def document_states(spark, sf_dir):
    """Status and first reason of every document, from files with reasons and a journal of good, invalid and failed answers."""
    from paperloom.operators import records

    found = dedup.with_fingerprints(files(spark, sf_dir))
    found = found.withColumn("reason", F.when(F.col("size_bytes") % 9 == 0, "corrupt_file").when(F.col("size_bytes") % 9 == 1, "encrypted"))
    k = F.instr(F.lit("0123456789abcdef"), F.left("document_id", F.lit(1))) - 1
    several = lambda *names: F.array(*map(F.lit, names))
    made = F.when(k < 6, several("ok")).when(k < 9, several("invalid_json", "invalid_json")).when(k < 12, several("invalid_json", "ok"))
    made = made.when(k < 14, several("invalid_json")).otherwise(several("timeout", "refused"))
    calls = found.select(F.col("fingerprint").alias("document_id")).distinct().select("document_id", F.posexplode(made).alias("batch", "status"))
    calls = calls.withColumns({"run_id": F.lit(1), "raw": F.concat(F.lit("answer "), F.col("batch").cast("string"))})
    return records.states(found, calls)


@query("select doc_id, sha256(strip_accents(coalesce(text, ''))) as bare_sha256 from documents")
def strip_marks(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.sha2(T.without_marks(F.coalesce("text", F.lit(""))), 256).alias("bare_sha256"))


@query(f"with {FILES_SQL} select count(*) as input_files, count(*) - count(distinct fingerprint) as duplicate_files, count(distinct fingerprint) as unique_documents from hashed")
def dedup_report(spark, sf_dir):
    found = dedup.assigned(dedup.with_fingerprints(files(spark, sf_dir)))
    return found.agg(
        F.count("*").alias("input_files"), F.count_if(F.col("status") == "duplicate").alias("duplicate_files"),
        F.count_if(F.col("status") == "scanned").alias("unique_documents"),
    )


@query("select doc_id from documents where doc_id % 4 <> 1")
def insert_if_absent(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return dedup.insert_if_absent(docs, docs.where("doc_id % 4 = 1"), "doc_id")


@query(
    """with old as (select 'f' || doc_id as path, n_chars as size_bytes, md5(text) as raw_sha256, case when doc_id % 5 = 0 then 'duplicate' else 'scanned' end as status
  from documents where doc_id % 3 <> 0),
new as (select 'f' || doc_id as path, n_chars + 1 as size_bytes, sha256(text) as raw_sha256 from documents where doc_id % 3 <> 1)
select coalesce(n.path, o.path) as path, coalesce(n.size_bytes, o.size_bytes) as size_bytes, coalesce(n.raw_sha256, o.raw_sha256) as raw_sha256,
       coalesce(o.status, 'scanned') as status from old o full join new n on o.path = n.path"""
)
def upsert_files(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("path", F.concat(F.lit("f"), "doc_id"))
    status = F.when(F.col("doc_id") % 5 == 0, "duplicate").otherwise("scanned").alias("status")
    old = docs.where("doc_id % 3 <> 0").select("path", F.col("n_chars").alias("size_bytes"), F.md5("text").alias("raw_sha256"), status)
    new = docs.where("doc_id % 3 <> 1").select("path", (F.col("n_chars") + 1).alias("size_bytes"), F.sha2("text", 256).alias("raw_sha256"))
    return dedup.upserted(old, new)


NAMES = ("invoice.PDF", "notes.txt", ".hidden", "expected.jsonl", "page.HTM", "mail.eml", "_draft.docx", "archive.tar.gz", "readme")


@query(
    """with n as (select doc_id, (['invoice.PDF', 'notes.txt', '.hidden', 'expected.jsonl', 'page.HTM', 'mail.eml', '_draft.docx', 'archive.tar.gz', 'readme'])[1 + doc_id % 9] as name from documents)
select doc_id, name, case when regexp_matches(lower(name), '\\.(txt|pdf|docx|html|htm|eml)$') then regexp_extract(lower(name), '\\.([^.]+)$', 1) end as format,
       case when not regexp_matches(lower(name), '\\.(txt|pdf|docx|html|htm|eml)$') then 'unsupported_format' end as reason
from n where name not like '.%' and name <> 'expected.jsonl'""".replace("\\\\", "\\")
)
def ext_dispatch(spark, sf_dir):
    from paperloom.sources import files as source

    name = F.element_at(F.array(*map(F.lit, NAMES)), (F.col("doc_id") % len(NAMES) + 1).cast("int"))
    named = table(spark, sf_dir, "documents").select("doc_id", name.alias("name")).where(source.wanted(F.col("name")))
    kind = source.format_of(F.col("name"))
    return named.select("doc_id", "name", kind.alias("format"), F.when(kind.isNull(), "unsupported_format").alias("reason"))


@query(
    """with m as (select doc_id, case doc_id % 7 when 0 then '../x' || doc_id when 1 then '/etc/' || doc_id when 2 then 'a/../' || doc_id else 'ok/' || doc_id || '..txt' end as name, n_chars from documents)
select doc_id, name, list_contains(string_split(name, '/'), '..') or name like '/%' as unsafe,
       sum(n_chars) over (partition by doc_id % 16 order by doc_id rows unbounded preceding) > 100000 as too_large from m"""
)
def zip_guard(spark, sf_dir):
    from pyspark.sql import Window

    from paperloom.sources import files as source

    k, end = F.col("doc_id") % 7, F.col("doc_id").cast("string")
    name = F.when(k == 0, F.concat(F.lit("../x"), end)).when(k == 1, F.concat(F.lit("/etc/"), end)).when(k == 2, F.concat(F.lit("a/../"), end))
    named = table(spark, sf_dir, "documents").withColumn("name", name.otherwise(F.concat(F.lit("ok/"), end, F.lit("..txt"))))
    size = F.sum("n_chars").over(Window.partitionBy(F.col("doc_id") % 16).orderBy("doc_id").rowsBetween(Window.unboundedPreceding, 0))
    return named.select("doc_id", "name", source.unsafe_member(F.col("name")).alias("unsafe"), (size > 100_000).alias("too_large"))


@query(
    """select doc_id, case when regexp_matches(text, '[ąćęłńóśźżĄĆĘŁŃÓŚŹŻ]') or """
    + " + ".join(f"contains(lower(text), '{w}')::int" for w in T.POLISH_WORDS)
    + """ >= 2 then 'pl' else 'en' end as language from documents"""
)
def language_detect(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.language(F.col("text")).alias("language"))


@query("select doc_id, greatest(1, floor(strlen('Jezyk dokumentu: ' || lang || '. Pole summary napisz w tym samym jezyku.' || chr(10) || '<<<DOCUMENT_TEXT_START>>>' || chr(10) || text || chr(10) || '<<<DOCUMENT_TEXT_END>>>' || chr(10) || chr(10) || '" + prompts.FIELD_LIST + "') / 3.0)::bigint + 1) as tokens from documents")
def prompt_tokens(spark, sf_dir):
    built = prompts.prompt(F.col("text"), F.col("lang"))
    return table(spark, sf_dir, "documents").select("doc_id", T.input_tokens(built).alias("tokens"))


@query(
    """select doc_id, length(text) > 3000 as cut, case when length(text) > 3000 then left(text, 1000) else text end as head,
case when length(text) > 3000 then right(text, 1000) else text end as tail from documents"""
)
def excerpt_ends(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    out = docs.select("doc_id", (F.length("text") > 3000).alias("cut"), prompts.excerpt(F.col("text"), 3000).alias("e"))
    end = lambda side: F.when(F.col("cut"), F.expr(f"{side}(e, 1000)")).otherwise(F.col("e"))
    return out.select("doc_id", "cut", end("left").alias("head"), end("right").alias("tail"))


@query()
def excerpt(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", prompts.excerpt(F.col("text"), 3000).alias("excerpt"))


@query(
    """with b as (select doc_id, encode(coalesce(text, '')) as c, strlen(coalesce(text, '')) as n from documents)
select doc_id, n > 2000 as large, case when n > 2000 then sha256(c[1:1000]) else sha256(c) end as head,
       case when n > 2000 then sha256(c[greatest(n - 1000, 1000) + 1:]) end as tail from b"""
)
def head_tail(spark, sf_dir):
    """Both ends of a large file's bytes, as the text extractor takes them, with small bounds."""
    from paperloom.sources import files as source

    content = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    head, tail = source.ends(content, 2000, 1000)
    rows = table(spark, sf_dir, "documents")
    return rows.select("doc_id", tail.isNotNull().alias("large"), F.sha2(head, 256).alias("head"), F.sha2(tail, 256).alias("tail"))


TAX_BASE = "lpad(cast((c_custkey * 7919) % 1000000000 as string), 9, '0')"


def tax_inputs(spark, sf_dir):
    base = F.expr(TAX_BASE)
    full = F.concat(base, (fields.tax_check_digit(base) % 10).cast("string"))
    part = lambda at, n: F.substring(full, at, n)
    k = F.col("c_custkey") % 6
    raw = F.when(k == 0, full).when(k == 1, F.concat(F.lit("PL "), part(1, 3), F.lit("-"), part(4, 3), F.lit("-"), part(7, 2), F.lit("-"), part(9, 2)))
    raw = raw.when(k == 2, F.concat(F.lit(" pl"), part(1, 5), F.lit("."), part(6, 5), F.lit(" "))).when(k == 3, F.concat(F.lit("de"), base))
    raw = raw.when(k == 4, F.concat(base, ((fields.tax_check_digit(base) + 1) % 10).cast("string"))).otherwise(F.concat(full, F.lit("x")))
    return table(spark, sf_dir, "customer").select("c_custkey", full.alias("full"), raw.alias("raw"))


TAX_SQL = """
t as (select c_custkey, lpad(((c_custkey * 7919) % 1000000000)::varchar, 9, '0') as base from customer),
s as (select *, (6*substr(base,1,1)::int + 5*substr(base,2,1)::int + 7*substr(base,3,1)::int + 2*substr(base,4,1)::int + 3*substr(base,5,1)::int
  + 4*substr(base,6,1)::int + 5*substr(base,7,1)::int + 6*substr(base,8,1)::int + 7*substr(base,9,1)::int) % 11 as check_digit from t)
"""


@query(
    f"""with {TAX_SQL} select c_custkey, case when c_custkey % 6 in (0, 1, 2) and check_digit < 10 then base || check_digit
when c_custkey % 6 = 3 then 'DE' || base end as tax_id from s"""
)
def tax_id_norm(spark, sf_dir):
    return tax_inputs(spark, sf_dir).select("c_custkey", fields.tax_id(F.col("raw")).alias("tax_id"))


def order_inputs(spark, sf_dir):
    """Orders with amounts and dates in six layouts, and an invoice's text."""
    value, k, day = F.col("o_totalprice").cast("decimal(12,2)"), F.col("o_orderkey") % 6, F.to_date("o_orderdate")
    plain = value.cast("string")
    grouped = F.format_number(value, 2)
    amount = F.when(k == 0, plain).when(k == 1, F.replace(plain, F.lit("."), F.lit(","))).when(k == 2, F.concat(F.lit("$"), grouped))
    spaced = F.translate(grouped, ",.", " ,")
    amount = amount.when(k == 3, F.concat(spaced, F.lit(" zł"))).when(k == 4, F.concat(F.lit("-"), F.translate(grouped, ",.", ".,"))).otherwise(F.lit("brak"))
    month = lambda names: F.element_at(F.array(*map(F.lit, names)), F.month(day))
    polish = F.concat_ws(" ", F.dayofmonth(day).cast("string"), month(("stycznia", "lutego", "marca", "kwietnia", "maja", "czerwca", "lipca", "sierpnia", "września", "października", "listopada", "grudnia")), F.year(day).cast("string"))
    english = F.concat(F.initcap(month(fields.ENGLISH_MONTHS)), F.lit(" "), F.dayofmonth(day).cast("string"), F.lit(", "), F.year(day).cast("string"))
    date = F.when(k == 0, F.date_format(day, "yyyy-MM-dd")).when(k == 1, F.date_format(day, "dd.MM.yyyy")).when(k == 2, F.date_format(day, "d/M/yyyy"))
    date = date.when(k == 3, polish).when(k == 4, english).otherwise(F.lit("32.13.2024"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", value.alias("value"), day.alias("day"), amount.alias("amount"), date.alias("date"))
    return rows.withColumn("text", F.concat(F.lit("Faktura z dnia "), F.date_format("day", "dd.MM.yyyy"), F.lit("\nRazem: "), F.col("value").cast("string"), F.lit(" PLN")))


VALUE_SQL = "o_totalprice::decimal(12,2)"


@query(f"select o_orderkey, case when o_orderkey % 6 < 4 then {VALUE_SQL} when o_orderkey % 6 = 4 then -({VALUE_SQL}) end::decimal(38,2)::varchar as amount from orders")
def amount_norm(spark, sf_dir):
    return order_inputs(spark, sf_dir).select("o_orderkey", fields.amount(F.col("amount")).cast("string").alias("amount"))


@query("select o_orderkey, case when o_orderkey % 6 < 5 then strftime(o_orderdate, '%Y-%m-%d') end as date from orders")
def date_norm(spark, sf_dir):
    return order_inputs(spark, sf_dir).select("o_orderkey", fields.date(F.col("date")).cast("string").alias("date"))


CURRENCIES = ("zł", " € ", "$", "£", "PLN", "zloty", "Euro", "dolary", "chf", "złotych", "PL", "U$D")


@query("select o_orderkey, (['PLN', 'EUR', 'USD', 'GBP', 'PLN', 'PLN', 'EUR', 'USD', 'CHF', null, null, null])[1 + o_orderkey % 12] as currency from orders")
def currency_norm(spark, sf_dir):
    raw = F.element_at(F.array(*map(F.lit, CURRENCIES)), (F.col("o_orderkey") % 12 + 1).cast("int"))
    return table(spark, sf_dir, "orders").select("o_orderkey", fields.currency(raw).alias("currency"))


@query(
    f"""with t as (select o_orderkey, o_orderdate::date as day, strftime(o_orderdate, '%d%m%Y') || replace(({VALUE_SQL})::varchar, '.', '') as digits, replace(({VALUE_SQL})::varchar, '.', '') as own from orders)
select o_orderkey, contains(digits, own) as amount_in, contains(digits, '999999999999') as other_in, true as date_in, false as next_in from t"""
)
def grounding(spark, sf_dir):
    rows, text = order_inputs(spark, sf_dir), F.col("text")
    return rows.select(
        "o_orderkey", fields.digits_occur(F.col("value").cast("string"), text).alias("amount_in"), fields.digits_occur(F.lit("999999999999"), text).alias("other_in"),
        fields.date_occurs(F.col("day"), text).alias("date_in"), fields.date_occurs(F.date_add("day", 1), text).alias("next_in"),
    )


def answers(spark, sf_dir):
    """A model answer per order, faulty by o_orderkey % 8."""
    rows = order_inputs(spark, sf_dir).withColumn("k", F.col("o_orderkey") % 8)
    q = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    body = F.concat(
        F.lit('{"doc_type": '), F.when(F.col("k") == 4, F.lit('"bill"')).otherwise(F.lit('"invoice"')), F.lit(', "gross_amount": '),
        F.when(F.col("k") == 2, F.lit("12.5")).otherwise(q(F.col("amount"))), F.lit(', "issue_date": '), q(F.col("date")),
        F.when(F.col("k") == 1, F.lit(', "colour": "red"')).otherwise(F.lit("")),
        F.when(F.col("k") == 3, F.lit("")).otherwise(F.concat(F.lit(', "summary": '), q(F.when(F.col("k") == 6, F.repeat(F.lit("x"), 501)).otherwise(F.lit(" ok "))))),
        F.lit(', "currency": "zł", "counterparty_name": " ACME "}'),
    )
    raw = F.when(F.col("k") == 5, F.lit("no json")).when(F.col("k") == 7, None).otherwise(body)
    return rows.select("o_orderkey", "text", raw.alias("raw"))


@query("select o_orderkey, o_orderkey % 8 = 0 as valid from orders")
def json_validate(spark, sf_dir):
    return answers(spark, sf_dir).select("o_orderkey", fields.valid_answer("raw")["doc_type"].isNotNull().alias("valid"))


@query(
    f"""select o_orderkey, 'invoice' as doc_type, 'ACME' as counterparty_name, case when o_orderkey % 6 < 5 then strftime(o_orderdate, '%Y-%m-%d') end as issue_date,
case when o_orderkey % 6 < 4 then {VALUE_SQL} when o_orderkey % 6 = 4 then -({VALUE_SQL}) end::decimal(38,2)::varchar as gross_amount,
'PLN' as currency, 'ok' as summary from orders where o_orderkey % 8 = 0"""
)
def postprocess_fields(spark, sf_dir):
    rows = answers(spark, sf_dir).withColumn("answer", fields.valid_answer("raw")).where("answer.doc_type is not null")
    done = rows.withColumns(fields.postprocess(F.col("answer"), F.col("text")))
    return done.select("o_orderkey", "doc_type", "counterparty_name", F.col("issue_date").cast("string"), F.col("gross_amount").cast("string"), "currency", "summary")


def journal(spark, sf_dir):
    """Model calls: one per line item, of the document of its order."""
    status = F.when(F.col("l_linenumber") % 3 == 0, "invalid_json").when(F.col("l_quantity") < 10, "timeout").otherwise("ok")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("document_id"), F.col("l_linenumber").cast("long").alias("id"), status.alias("status"), F.col("l_partkey").alias("tokens_in"),
        F.col("l_suppkey").alias("tokens_out"), F.col("l_shipdate").alias("finished_at"),
    )


JOURNAL_SQL = """calls as (select l_orderkey as document_id, l_linenumber::bigint as id, case when l_linenumber % 3 = 0 then 'invalid_json' when l_quantity < 10 then 'timeout' else 'ok' end as status,
  l_partkey as tokens_in, l_suppkey as tokens_out from lineitem)"""


@query(f"with {JOURNAL_SQL} select o_orderkey as document_id from orders o where not exists (select 1 from calls c where c.document_id = o.o_orderkey and c.status = 'ok')")
def resume_antijoin(spark, sf_dir):
    done = journal(spark, sf_dir).where("status = 'ok'").select("document_id")
    return dedup.insert_if_absent(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("document_id")), done, "document_id")


@query(f"with {JOURNAL_SQL} select document_id, id, tokens_in, tokens_out from calls where status = 'ok' qualify row_number() over (partition by document_id order by id desc, tokens_in desc, tokens_out desc) = 1")
def latest_ok_call(spark, sf_dir):
    calls = journal(spark, sf_dir).where("status = 'ok'").select("document_id", "id", "tokens_in", "tokens_out")
    return dedup.latest_by(calls, "document_id", "id")


@query(
    f"""with {JOURNAL_SQL} select status, coalesce(sum(tokens_in), 0)::bigint as tokens_in, coalesce(sum(tokens_out), 0)::bigint as tokens_out,
((round((sum(tokens_in)::decimal(30,0) * 150 + sum(tokens_out)::decimal(30,0) * 600) / 1000000, 6))::decimal(38,6))::varchar as cost from calls group by 1"""
)
def token_totals_cost(spark, sf_dir):
    totals = journal(spark, sf_dir).groupBy("status").agg(
        F.coalesce(F.sum("tokens_in"), F.lit(0)).alias("tokens_in"), F.coalesce(F.sum("tokens_out"), F.lit(0)).alias("tokens_out")
    )
    return totals.withColumn("cost", report.cost(F.col("tokens_in"), F.col("tokens_out"), "150", "600").cast("string"))


@query(
    """with c as (select doc_id, source, 512 + greatest(1, floor(strlen(text) / 3.0)::bigint + 1) as reserve, (120 + n_chars)::bigint as actual from documents),
u as (select *, coalesce(sum(actual) over (partition by source order by doc_id rows between unbounded preceding and 1 preceding), 0)::bigint as used_before from c)
select doc_id, source, reserve, used_before, bool_and(used_before + reserve <= 60000) over (partition by source order by doc_id rows unbounded preceding) as admitted from u"""
)
def budget_admission(spark, sf_dir):
    calls = table(spark, sf_dir, "documents").select(
        "doc_id", "source", (T.input_tokens(F.col("text")) + 512).alias("reserve"), (F.col("n_chars") + 120).alias("actual")
    )
    return dedup.admitted(calls, 60_000, "doc_id", "source").select("doc_id", "source", "reserve", "used_before", "admitted")


def state(spark, sf_dir):
    k = F.col("o_orderkey") % 7
    status = F.when(k == 0, "pending").when(k == 1, "extracted").when(k < 4, "quarantined").otherwise("done")
    reason = F.element_at(F.array(*map(F.lit, ("corrupt_file", "empty_text", "llm_invalid_output"))), (F.col("o_custkey") % 3 + 1).cast("int"))
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"), F.concat(F.lit("d/"), "o_orderkey").alias("representative_path"), status.alias("status"),
        F.when(k.isin(2, 3), reason).alias("quarantine_reason"),
    )


STATE_SQL = """docs as (select o_orderkey::varchar as id, 'd/' || o_orderkey as representative_path, case o_orderkey % 7 when 0 then 'pending' when 1 then 'extracted' when 2 then 'quarantined' when 3 then 'quarantined' else 'done' end as status,
  case when o_orderkey % 7 in (2, 3) then (['corrupt_file', 'empty_text', 'llm_invalid_output'])[1 + o_custkey % 3] end as quarantine_reason from orders)"""


@query(f"with {STATE_SQL} select id, representative_path from docs where status in ('pending', 'extracted') order by representative_path limit 100")
def pending_limit(spark, sf_dir):
    return dedup.pending(state(spark, sf_dir), 100).select("id", "representative_path")


@query(
    f"""with {STATE_SQL} select count(*) as unique_documents, count(*) filter (status = 'done') as processed_ok, count(*) filter (status = 'quarantined') as quarantined,
count(*) filter (status in ('pending', 'extracted')) as not_started from docs"""
)
def report_counts(spark, sf_dir):
    return report.document_counts(state(spark, sf_dir))


@query(f"with {STATE_SQL} select quarantine_reason, count(*) as n from docs where status = 'quarantined' group by 1")
def quarantine_reasons(spark, sf_dir):
    return report.quarantine_reasons(state(spark, sf_dir))


def runs(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), F.col("ts").alias("started_at"), F.when(F.col("event_id") % 2 == 1, F.expr("ts + make_dt_interval(0, 0, 0, 1.5) * (event_id % 100)")).alias("ended_at"),
        F.col("user_id").alias("tokens_in"), (F.col("user_id") * 2).alias("tokens_out"), F.lit("0").alias("estimated_cost"), F.col("event_type").alias("backend"),
        F.lit("m").alias("model_tag"), F.lit("completed").alias("stop_reason"),
    )


@query("select event_id as id, case when event_id % 2 = 1 then (event_id % 100) * 1.5 end::double as wall_time_s, event_type as backend from events order by event_id desc limit 1")
def latest_run(spark, sf_dir):
    return report.latest_run(runs(spark, sf_dir)).select("id", "wall_time_s", "backend")


@query(
    f"""with {FILES_SQL}, firsts as (select fingerprint, instr('0123456789abcdef', left(fingerprint, 1)) - 1 as k from hashed group by 1),
counted as (select (select count(*) from hashed) as input_files, count(*) as unique_documents, count(*) filter (k < 10) as processed_ok,
  count(*) filter (k in (10, 11)) as corrupt, count(*) filter (k = 12) as empty, count(*) filter (k > 12) as not_started from firsts),
last as (select * from events order by event_id desc limit 1)
select input_files, input_files - unique_documents as duplicate_files, unique_documents, processed_ok, corrupt + empty as quarantined, not_started,
'corrupt_file=' || corrupt || ',empty_text=' || empty as quarantine_by_reason, user_id as tokens_in, user_id * 2 as tokens_out, '0.00' as estimated_cost,
case when event_id % 2 = 1 then (event_id % 100) * 1.5 end::double as wall_time_s, event_type as backend, 'm@sha' as model, 'completed' as stop_reason from counted, last"""
)
def full_report(spark, sf_dir):
    """The balanced report over the deduplicated files, all 14 columns; the reasons' map as text."""
    found = dedup.assigned(dedup.with_fingerprints(files(spark, sf_dir)))
    k = F.instr(F.lit("0123456789abcdef"), F.left("fingerprint", F.lit(1))) - 1
    status = F.when(k < 10, "done").when(k < 13, "quarantined").otherwise("pending")
    reason = F.when(k.isin(10, 11), "corrupt_file").when(k == 12, "empty_text")
    docs = found.where("status = 'scanned'").select(status.alias("status"), reason.alias("quarantine_reason"))
    out = report.report(found, docs, runs(spark, sf_dir).withColumns({"model_digest": F.lit("sha"), "estimated_cost": F.lit(None).cast("string")}))
    told = F.transform(F.map_entries("quarantine_by_reason"), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return out.withColumn("quarantine_by_reason", F.array_join(F.array_sort(told), ","))


def expected(spark, sf_dir):
    """An expected row per order: the paths of its line items, some of them unknown to the scan."""
    path = F.concat_ws("/", F.lit("p"), "l_orderkey", "l_linenumber")
    rows = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("row")).agg(F.collect_set(path).alias("files"))
    return rows.where("row % 5 <> 0")


def known_files(spark, sf_dir):
    path = F.concat_ws("/", F.lit("p"), "l_orderkey", "l_linenumber").alias("path")
    document = F.when(F.col("l_linenumber") % 4 == 3, F.col("l_orderkey") + 1).otherwise(F.col("l_orderkey"))
    return table(spark, sf_dir, "lineitem").where("l_orderkey % 11 <> 0").select(path, document.cast("string").alias("document_id")).distinct()


EVAL_SQL = """files as (select distinct 'p/' || l_orderkey || '/' || l_linenumber as path, (case when l_linenumber % 4 = 3 then l_orderkey + 1 else l_orderkey end)::varchar as document_id from lineitem where l_orderkey % 11 <> 0),
wanted as (select l_orderkey as row, list_sort(list(distinct 'p/' || l_orderkey || '/' || l_linenumber)) as w from lineitem where l_orderkey % 5 <> 0 group by 1),
named as (select l_orderkey as row, document_id, count(*) as n from (select distinct l_orderkey, l_linenumber from lineitem where l_orderkey % 5 <> 0) l join files f on f.path = 'p/' || l_orderkey || '/' || l_linenumber group by 1, 2),
best as (select row, document_id from named qualify row_number() over (partition by row order by n desc, document_id) = 1),
actual as (select document_id, list_sort(list(distinct path)) as a from files group by 1)"""


@query(f"with {EVAL_SQL} select b.row, b.document_id, w.w is not distinct from a.a as same_files from best b join wanted w using (row) join actual a using (document_id)")
def eval_dedup_match(spark, sf_dir):
    return report.matched(expected(spark, sf_dir), known_files(spark, sf_dir))


@query(f"with {EVAL_SQL} select w.row from wanted w where not exists (select 1 from named n where n.row = w.row)")
def eval_missing(spark, sf_dir):
    return report.missing(expected(spark, sf_dir), known_files(spark, sf_dir)).select("row")


@query(f"with {EVAL_SQL} select distinct document_id as id from files where document_id not in (select document_id from best)")
def eval_extra(spark, sf_dir):
    seen = known_files(spark, sf_dir)
    documents = seen.select(F.col("document_id").alias("id")).distinct()
    return report.extra(documents, report.matched(expected(spark, sf_dir), seen))


def field_pairs(spark, sf_dir):
    rows = order_inputs(spark, sf_dir)
    k = F.col("o_orderkey") % 10
    none = F.lit(None).cast("string")
    want = F.struct(
        F.lit("invoice").alias("doc_type"), F.concat(F.lit("Firma "), "o_orderkey", F.lit(" Sp. z o.o.")).alias("counterparty_name"), F.lit("DE123").alias("counterparty_tax_id"),
        F.date_format("day", "yyyy-MM-dd").alias("issue_date"), none.alias("due_date"), F.col("value").cast("string").alias("gross_amount"), F.lit("PLN").alias("currency"), F.lit("A summary").alias("summary"),
    )
    got = F.struct(
        F.when(k == 0, "offer").otherwise("invoice").alias("doc_type"), F.when(k == 1, none).otherwise(F.concat(F.lit('"FIRMA '), "o_orderkey", F.lit('"'))).alias("counterparty_name"),
        F.when(k == 2, "DE124").otherwise("de 12-3").alias("counterparty_tax_id"), F.when(k == 3, none).otherwise(F.date_format("day", "yyyy-MM-dd")).alias("issue_date"),
        F.when(k == 4, "2020-01-01").alias("due_date"), (F.col("value") + F.when(k == 5, F.lit(1)).otherwise(F.lit(0))).cast("string").alias("gross_amount"),
        F.when(k == 6, "EUR").otherwise("PLN").alias("currency"), F.when(k == 7, F.lit("zażółć gęślą")).when(k == 8, " ").otherwise("Another text").alias("summary"),
    )
    return rows.select(F.col("o_orderkey").alias("row"), want.alias("expected"), got.alias("actual"))


@query(
    """select field, (count(*) - count(*) filter (list_contains(bad, o_orderkey % 10)))::bigint as correct, count(*) as total,
(count(*) - count(*) filter (list_contains(bad, o_orderkey % 10)))::double / count(*) as accuracy
from orders, (values ('doc_type', [0]), ('counterparty_name', [1]), ('counterparty_tax_id', [2]), ('issue_date', [3]), ('due_date', [4]), ('gross_amount', [5]), ('currency', [6]), ('summary', [7, 8])) f(field, bad) group by field"""
)
def eval_fields(spark, sf_dir):
    return report.field_accuracy(field_pairs(spark, sf_dir))


@query()
def eval_names(spark, sf_dir):
    """Names against a shortened form, where only the similarity decides."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("a"), F.expr("left(c_name, length(c_name) - cast(c_custkey % 9 as int))").alias("b"))
    return rows.select("c_custkey", matchers.names(F.col("a"), F.col("b")).alias("ok"))


@query()
def html_text(spark, sf_dir):
    from paperloom.sources import extractors

    pages = table(spark, sf_dir, "pages").select(F.concat("page_id", F.lit(".html")).alias("path"), F.col("html").cast("binary").alias("content"))
    return extractors.extracted(pages)


@query(r"select doc_id, case when regexp_matches(text, '[^\s]') then text end as text from documents")
def charset_decode(spark, sf_dir):
    """Every document's whole text, written in UTF-8, as it is read back; charset_detect has the other encodings."""
    from paperloom.sources import extractors

    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return docs.select("doc_id", extractors.decoded(F.encode("text", "UTF-8")).alias("text"))


@query()
def charset_detect(spark, sf_dir):
    """Every document's whole text, written in each of the encodings that can hold it, as it is read back; detection is beyond SQL."""
    return read_back(table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text")))


def read_back(docs: DataFrame) -> DataFrame:
    """(doc_id, encoding, text): a row for each encoding that can hold the text; an empty text is read as null."""
    from paperloom.sources import extractors

    each = docs.select("doc_id", "text", F.explode(F.array(*map(F.lit, extractors.ENCODINGS))).alias("encoding"))
    found = each.select("doc_id", "encoding", extractors.written("text", "encoding").alias("content")).where("content is not null")
    return found.select("doc_id", "encoding", extractors.decoded("content").alias("text"))


@query(ORACLES["two_stage_dedup"].replace("select path, fingerprint, representative_path, case", "select path, representative_path, case"))
def incremental_dedup(spark, sf_dir):
    from paperloom.streaming import incremental

    return incremental.drained(spark, files(spark, sf_dir).drop("size_bytes"))
