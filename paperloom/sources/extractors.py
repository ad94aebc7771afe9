"""Text of files by format: binary in, text or a reason out."""

from __future__ import annotations

import io
import multiprocessing
import re
import zipfile
from collections.abc import Callable, Iterator
from email import policy
from email.parser import BytesParser
from html.parser import HTMLParser
from pathlib import PurePosixPath
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

#: Encodings that are tried, how much of a large text is read at each end, reasons, the attachment notes.
ENCODINGS = ("utf-8", "cp1250", "iso-8859-2")
LARGE, END_BYTES = 50 << 20, 200_000
CUT = "\n[... pominieto srodkowa czesc duzego pliku ...]\n"
REASONS = ("unsupported_format", "corrupt_file", "encrypted", "empty_text", "extract_timeout", "extract_crash", "llm_invalid_output", "too_large")
ATTACHMENT, UNREADABLE = "\n[Zalacznik: {}]\n{}", "\n[Zalacznik: {} - nie udalo sie odczytac]"


class Unreadable(Exception):
    def __init__(self, reason: str = "corrupt_file"):
        super().__init__(reason)
        self.reason = reason


def decode(data: bytes) -> str:
    """The likeliest of the encodings; UTF-8 with replacements if none fits."""
    if not data:
        raise Unreadable("empty_text")
    try:
        return data.decode("utf-8-sig")
    except UnicodeDecodeError:
        pass
    from charset_normalizer import from_bytes

    best = from_bytes(data, cp_isolation=list(ENCODINGS)).best()
    return str(best) if best is not None else data.decode("utf-8", "replace")


def _filled(text: str) -> str:
    if not text.strip():
        raise Unreadable("empty_text")
    return text


def txt(data: bytes) -> str:
    if len(data) > LARGE:
        tail = data[max(END_BYTES, len(data) - END_BYTES) :]
        return _filled(decode(data[:END_BYTES]) + CUT + (decode(tail) if tail else ""))
    return _filled(decode(data))


class _Lines(HTMLParser):
    """Text nodes outside the head, scripts and styles."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.hidden, self.found = [], []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in ("script", "style", "head", "template", "noscript"):
            self.hidden.append(tag)
        elif tag == "body":
            self.hidden.clear()

    def handle_endtag(self, tag: str) -> None:
        if tag in self.hidden:
            del self.hidden[self.hidden.index(tag) :]

    def handle_data(self, data: str) -> None:
        if not self.hidden:
            self.found.append(data)


def html(data: bytes) -> str:
    parser = _Lines()
    parser.feed(decode(data))
    parser.close()
    return _filled("\n".join(s for s in (x.strip() for x in parser.found) if s))


_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def docx(data: bytes) -> str:
    """Paragraphs of the body; tables and headers are left out."""
    try:
        with zipfile.ZipFile(io.BytesIO(data)) as archive:
            body = ElementTree.fromstring(archive.read("word/document.xml")).find(f"{_W}body")
        lines = []
        for paragraph in body.findall(f"{_W}p"):
            marks = {f"{_W}tab": "\t", f"{_W}br": "\n", f"{_W}cr": "\n"}
            lines.append("".join(x.text or "" if x.tag == f"{_W}t" else marks.get(x.tag, "") for x in paragraph.iter()))
    except Exception as e:
        raise Unreadable() from e
    return _filled("\n".join(lines))


def pdf(data: bytes) -> str:
    """Page by page with pypdfium2 where it is installed; encrypted and broken files are told apart without it."""
    if not data.startswith(b"%PDF"):
        raise Unreadable()
    if re.search(rb"/Encrypt\s", data):
        raise Unreadable("encrypted")
    try:
        import pypdfium2
    except ImportError as e:
        raise Unreadable("unsupported_format") from e
    try:
        with pypdfium2.PdfDocument(data) as document:
            pages = [page.get_textpage().get_text_bounded() for page in document]
    except Exception as e:
        raise Unreadable() from e
    return _filled("\n".join(pages))


def eml(data: bytes) -> str:
    """Four header lines, the plain body (else the HTML one) and each attachment's text."""
    if not data:
        raise Unreadable("empty_text")
    mail = BytesParser(policy=policy.default).parsebytes(data)
    parts = [f"{name}: {mail.get(name, '')}" for name in ("From", "To", "Subject", "Date")] + [""]
    body = mail.get_body(preferencelist=("plain", "html"))
    if body is not None:
        content = body.get_content()
        parts.append(html(content.encode()) if body.get_content_type() == "text/html" else content)
    for attached in mail.iter_attachments():
        name = attached.get_filename() or "attachment"
        try:
            content = attached.get_content()
            reader = READERS.get(PurePosixPath(name).suffix.lower().lstrip("."))
            if reader is None or reader is eml:
                raise Unreadable("unsupported_format")
            parts.append(ATTACHMENT.format(name, reader(content.encode() if isinstance(content, str) else content)))
        except Unreadable:
            parts.append(UNREADABLE.format(name))
    return _filled("\n".join(parts))


READERS: dict[str, Callable[[bytes], str]] = {"txt": txt, "pdf": pdf, "docx": docx, "html": html, "htm": html, "eml": eml}


def read(name: str, data: bytes) -> tuple[str | None, str | None]:
    """(text, reason); any unforeseen failure counts as a corrupt file."""
    reader = READERS.get(PurePosixPath(name).suffix.lower().lstrip("."))
    if reader is None:
        return None, "unsupported_format"
    try:
        return reader(data), None
    except Unreadable as e:
        return None, e.reason
    except Exception:
        return None, "corrupt_file"


def _child(pipe, task: Callable, args: tuple) -> None:
    pipe.send(task(*args))
    pipe.close()


def isolated(task: Callable, args: tuple, seconds: float) -> tuple[str | None, str | None]:
    """task(*args) in a process of its own: a crash or hang costs that file, not the worker."""
    context = multiprocessing.get_context("fork")
    here, there = context.Pipe(duplex=False)
    process = context.Process(target=_child, args=(there, task, args), daemon=True)
    process.start()
    there.close()
    try:
        if not here.poll(seconds):
            return None, "extract_timeout"
        return here.recv()
    except EOFError:
        return None, "extract_crash"
    finally:
        if process.is_alive():
            process.kill()
        process.join()
        here.close()


def extracted(files: DataFrame, seconds: float | None = None) -> DataFrame:
    """(path, text, reason) of (path, content); with seconds, each file in a process of its own."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            pairs = zip(part["path"], part["content"])
            found = [(n, *(isolated(read, (n, d), seconds) if seconds else read(n, d))) for n, d in pairs]
            yield pd.DataFrame(found, columns=["path", "text", "reason"])

    return files.select("path", "content").mapInPandas(run, "path string, text string, reason string")


@F.pandas_udf(StringType())
def decoded(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for part in parts:
        yield part.map(lambda d: None if not d else decode(d))


@F.pandas_udf(BinaryType())
def written(text: pd.Series, encoding: pd.Series) -> pd.Series:
    """Bytes of the texts in the named encodings; null where an encoding cannot hold the text."""

    def one(t: str | None, e: str) -> bytes | None:
        try:
            return None if t is None else t.encode(e)
        except UnicodeEncodeError:
            return None

    return pd.Series([one(t, e) for t, e in zip(text, encoding)], dtype=object)
