"""Field normalisers, grounding and the validation of model answers, as column expressions."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from paperloom.functions import text as T

#: Weights of the tax number's check digit, month names, currency words and symbols.
TAX_WEIGHTS = (6, 5, 7, 2, 3, 4, 5, 6, 7)
POLISH_MONTHS = ("stycznia", "lutego", "marca", "kwietnia", "maja", "czerwca", "lipca", "sierpnia", "wrzesnia", "pazdziernika", "listopada", "grudnia")
ENGLISH_MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
CURRENCY_SYMBOLS = {"zł": "PLN", "€": "EUR", "$": "USD", "£": "GBP"}
CURRENCY_WORDS = {
    "zl": "PLN", "zloty": "PLN", "zlotych": "PLN", "pln": "PLN", "eur": "EUR", "euro": "EUR", "usd": "USD", "dolar": "USD", "dolary": "USD",
    "gbp": "GBP", "funt": "GBP",
}
DOC_TYPES = ("invoice", "contract", "offer", "correspondence", "other")
#: Fields of a model answer and their longest values; the first and the last are required.
ANSWER_LIMITS = {
    "doc_type": 40, "counterparty_name": 300, "counterparty_tax_id": 40, "issue_date": 40, "due_date": 40, "gross_amount": 40, "currency": 20,
    "summary": 500,
}
ANSWER_TYPE = StructType([StructField(f, StringType()) for f in ANSWER_LIMITS])


def _map(values: dict[str, str | int]) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def _plain(text: Column) -> Column:
    """Lower case without the marks of Polish letters; ł stays, as it has none."""
    return F.lower(F.translate(text, "ąćęńóśźżĄĆĘŃÓŚŹŻ", "acenoszzACENOSZZ"))


def _space_trimmed(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def tax_check_digit(nine: Column) -> Column:
    """Of the first nine digits: the weighted sum modulo 11 (10: no digit fits)."""
    return sum((F.substring(nine, k + 1, 1).cast("int") * w for k, w in enumerate(TAX_WEIGHTS)), F.lit(0)) % 11


def tax_id(raw: Column) -> Column:
    bare = F.regexp_replace(raw, r"(?U)[\s\-.]", "")
    prefix, digits = F.upper(F.regexp_extract(bare, r"^([A-Za-z]{2})?([0-9]+)$", 1)), F.regexp_extract(bare, r"^([A-Za-z]{2})?([0-9]+)$", 2)
    own = F.when((F.length(digits) == 10) & (tax_check_digit(digits) == F.substring(digits, 10, 1).cast("int")), digits)
    return F.when(digits == "", None).when(prefix.isin("", "PL"), own).otherwise(F.concat(prefix, digits))


def amount(raw: Column) -> Column:
    """decimal(38,2), halves rounded up; null where no number is left."""
    kept = _space_trimmed(F.regexp_replace(_space_trimmed(raw), r"(?U)[^\d,.\s-]", ""))
    bare = F.regexp_replace(kept, "^-+", "")
    # the distance from the end tells which separator comes last
    comma, dot = F.instr(F.reverse(bare), ","), F.instr(F.reverse(bare), ".")
    commas = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit("")))
    no_commas = F.replace(bare, F.lit(","), F.lit(""))
    decimal_comma = F.replace(F.replace(bare, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    number = (
        F.when((comma > 0) & (dot > 0), F.when(comma < dot, decimal_comma).otherwise(no_commas))
        .when(comma > 0, F.when((commas == 1) & (comma <= 3), decimal_comma).otherwise(no_commas))
        .otherwise(bare)
    )
    number = F.replace(number, F.lit(" "), F.lit(""))
    plain = F.rlike(number, F.lit(r"^([0-9]+\.?[0-9]*|\.[0-9]+)$"))
    value = F.when(plain, number.try_cast("decimal(38,2)"))
    return F.when(F.startswith(kept, F.lit("-")), -value).otherwise(value)


def currency(raw: Column) -> Column:
    s = _space_trimmed(raw)
    return F.coalesce(_map(CURRENCY_SYMBOLS)[s], _map(CURRENCY_WORDS)[_plain(s)], F.when(F.rlike(s, F.lit("^[A-Za-z]{3}$")), F.upper(s)))


def _day(year: Column, month: Column, day: Column) -> Column:
    text = F.concat_ws("-", year, F.lpad(month.cast("string"), 2, "0"), F.lpad(day.cast("string"), 2, "0"))
    return F.when(year > "0000", F.try_to_date(text, "yyyy-MM-dd"))


def date(raw: Column) -> Column:
    """A date from ISO, day-first and written forms (Polish genitive or English months); null otherwise."""
    s = _space_trimmed(raw)
    part = lambda pattern, k: F.regexp_extract(s, pattern, k)
    iso, day_first = r"^([0-9]{4})-([0-9]{1,2})-([0-9]{1,2})$", r"^([0-9]{1,2})[.\-/]([0-9]{1,2})[.\-/]([0-9]{4})$"
    polish, english = rf"(?U)^([0-9]{{1,2}})\s+([A-Za-z{T.POLISH_LETTERS}]+)\s+([0-9]{{4}})$", r"(?U)^([A-Za-z]+)\s+([0-9]{1,2}),?\s+([0-9]{4})$"
    month = lambda names, name: _map({n: k for k, n in enumerate(names, 1)})[name]
    return (
        F.when(F.rlike(s, F.lit(iso)), _day(part(iso, 1), part(iso, 2), part(iso, 3)))
        .when(F.rlike(s, F.lit(day_first)), _day(part(day_first, 3), part(day_first, 2), part(day_first, 1)))
        .when(F.rlike(s, F.lit(polish)), _day(part(polish, 3), month(POLISH_MONTHS, _plain(part(polish, 2))), part(polish, 1)))
        .when(F.rlike(s, F.lit(english)), _day(part(english, 3), month(ENGLISH_MONTHS, F.lower(part(english, 1))), part(english, 2)))
    )


def digits(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)\D", "")


def digits_occur(value: Column, text: Column) -> Column:
    found = digits(value)
    return F.coalesce((found != "") & F.contains(digits(text), found), F.lit(False))


def date_occurs(value: Column, text: Column) -> Column:
    """Whether one of the date's usual renderings is in the text."""
    low = T.folded(T.without_marks(text))
    day, year = F.dayofmonth(value).cast("string"), F.date_format(value, "yyyy")
    name = lambda names: _map(dict(enumerate(names, 1)))[F.month(value)]
    forms = [F.date_format(value, f) for f in ("dd.MM.yyyy", "dd-MM-yyyy", "dd/MM/yyyy", "yyyy-MM-dd")]
    forms += [F.concat_ws(" ", day, name(POLISH_MONTHS), year)]
    forms += [F.concat(name(ENGLISH_MONTHS), F.lit(" "), day, F.lit(sep), year) for sep in (", ", " ")]
    found = F.lit(False)
    for form in forms:
        found = found | F.contains(low, form)
    return F.coalesce(found, F.lit(False))


def postprocess(answer: Column, text: Column) -> dict[str, Column]:
    """The typed fields of a valid answer; values that the text does not support become null."""
    supported = lambda value, holds: F.when(holds, value)
    nip, issue, due, gross = tax_id(answer["counterparty_tax_id"]), date(answer["issue_date"]), date(answer["due_date"]), amount(answer["gross_amount"])
    return {
        "doc_type": answer["doc_type"],
        "counterparty_name": F.nullif(_space_trimmed(answer["counterparty_name"]), F.lit("")),
        "counterparty_tax_id": supported(nip, digits_occur(nip, text)),
        "issue_date": supported(issue, date_occurs(issue, text)),
        "due_date": supported(due, date_occurs(due, text)),
        "gross_amount": supported(gross, digits_occur(gross.cast("string"), text)),
        "currency": currency(answer["currency"]),
        "summary": _space_trimmed(answer["summary"]),
    }


def parse_answer(raw: str | None) -> dict | None:
    """The answer's fields if it is a JSON object of exactly the allowed shape, else None."""
    try:
        found = json.loads(raw) if raw is not None else None
    except ValueError:
        return None
    if not isinstance(found, dict) or not found.keys() <= ANSWER_LIMITS.keys():
        return None
    if found.get("doc_type") not in DOC_TYPES or not isinstance(found.get("summary"), str):
        return None
    for name, value in found.items():
        if value is not None and (not isinstance(value, str) or len(value) > ANSWER_LIMITS[name]):
            return None
    return {name: found.get(name) for name in ANSWER_LIMITS}


@F.pandas_udf(ANSWER_TYPE)
def valid_answer(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """Strict JSON, the last of repeated keys counting, as no built-in parser reads it; doc_type is null where it fails."""
    for part in parts:
        yield pd.DataFrame([parse_answer(raw) or {} for raw in part], columns=list(ANSWER_LIMITS), dtype=object)
