"""Text functions: normalisation, fingerprints, language, token estimates, prompts."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Letters and words that mark Polish.
POLISH_LETTERS = "ąćęłńóśźżĄĆĘŁŃÓŚŹŻ"
POLISH_WORDS = (
    "nip", "faktura", "umowa", "oferta", "termin", "dnia", "oraz", "jest", "prosimy", "zaplata", "zapłata", "platnosci", "płatności",
    "sprzedawca", "nabywca", "zawarta", "kwota",
)


#: Texts whose strings a worker holds at once, beside a batch of Arrow.
SLICE = 256


@F.arrow_udf(StringType())
def _folded(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for part in parts:
        for k in range(0, len(part), SLICE):
            texts = part[k : k + SLICE].to_pylist()
            yield pa.array([None if t is None else unicodedata.normalize("NFKC", t).casefold() for t in texts], pa.string())


@F.arrow_udf(StringType())
def _bare(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for part in parts:
        for k in range(0, len(part), SLICE):
            texts = part[k : k + SLICE].to_pylist()
            yield pa.array([None if t is None else "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c)) for t in texts], pa.string())


@F.arrow_udf(StringType())
def _bare_folded(texts: pa.Array) -> pa.Array:
    bare = ("".join(c for c in unicodedata.normalize("NFKD", t.as_py()) if not unicodedata.combining(c)) if t.is_valid else None for t in texts)
    return pa.array([None if t is None else unicodedata.normalize("NFKC", t).casefold() for t in bare], pa.string())


def is_ascii(text: Column) -> Column:
    return F.octet_length(text) == F.length(text)


def folded(text: Column) -> Column:
    """NFKC, then case folding. Pure ASCII text, for which that is lower(), stays in the JVM's branch of the plan."""
    return F.when(is_ascii(text), F.lower(text)).otherwise(_folded(F.when(~is_ascii(text), text)))


def without_marks(text: Column) -> Column:
    """Decomposed and without combining marks; letters such as ł that do not decompose stay."""
    return F.when(is_ascii(text), text).otherwise(_bare(F.when(~is_ascii(text), text)))


def bare_folded(text: Column) -> Column:
    """folded(without_marks(text)) of a short text. A worker does this for all columns of a row, as it takes whole batches."""
    return F.when(is_ascii(text), F.lower(text)).otherwise(_bare_folded(F.when(~is_ascii(text), text)))


def squeezed(text: Column) -> Column:
    """Runs of Unicode white space become one space, none at the ends."""
    return F.trim(F.regexp_replace(text, r"(?U)[\s\x1c-\x1f]+", " "))


def normalized(text: Column) -> Column:
    return squeezed(folded(text))


def fingerprint(text: Column) -> Column:
    return F.sha2(normalized(text), 256)


def language(text: Column) -> Column:
    """pl if a Polish letter occurs or two of the words do, else en."""
    low = F.lower(text)
    words = sum((F.contains(low, F.lit(w)).cast("int") for w in POLISH_WORDS), F.lit(0))
    return F.when(F.rlike(text, F.lit(f"[{POLISH_LETTERS}]")) | (words >= 2), "pl").otherwise("en")


def input_tokens(text: Column, bytes_per_token: float = 3.0) -> Column:
    """An upper estimate of the tokens of a prompt from its UTF-8 length."""
    return F.greatest(F.lit(1).cast("long"), (F.floor(F.octet_length(text) / F.lit(max(bytes_per_token, 0.1))) + 1).cast("long"))
