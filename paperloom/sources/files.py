"""Archives as tables of files: directories and zip files, listed on the driver and read by the executors."""

from __future__ import annotations

import zipfile
from collections.abc import Iterator
from pathlib import Path, PurePosixPath

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Names that are no input, and the formats by extension.
SKIPPED = "expected.jsonl"
FORMATS = {"txt": "txt", "pdf": "pdf", "docx": "docx", "html": "html", "htm": "htm", "eml": "eml"}
MEBI = 1 << 20


class UnsafeArchive(ValueError):
    """A member that would leave the archive's folder, or more data than allowed."""


def wanted(name: Column) -> Column:
    """Of base names; a folder that begins with a dot hides nothing."""
    return ~F.startswith(name, F.lit(".")) & (name != SKIPPED)


def format_of(name: Column) -> Column:
    ending = F.lower(F.regexp_extract(name, r"\.([^./]+)$", 1))
    return F.when(ending.isin(*FORMATS), ending)


def unsafe_member(name: Column) -> Column:
    return F.array_contains(F.split(name, "/"), "..") | F.startswith(name, F.lit("/"))


def ends(content: Column, large: int, keep: int) -> tuple[Column, Column]:
    """The first and last keep bytes of contents over a bound; all and null of others. The ends never overlap."""
    size = F.length(content)
    head = F.when(size > large, F.substring(content, F.lit(1), F.lit(keep))).otherwise(content)
    return head, F.when(size > large, F.substring(content, F.greatest(size - keep, F.lit(keep)) + 1, F.lit(keep)))


def members(path: Path, most_mb: int) -> list[str]:
    """The file names of a zip; every entry is checked before any is read."""
    with zipfile.ZipFile(path) as archive:
        infos = archive.infolist()
    for info in infos:
        name = PurePosixPath(info.filename.replace("\\", "/"))
        if name.is_absolute() or ".." in name.parts:
            raise UnsafeArchive(f"unsafe member: {info.filename}")
    if sum(i.file_size for i in infos) > most_mb * MEBI:
        raise UnsafeArchive(f"over {most_mb} MB uncompressed")
    return [i.filename for i in infos if not i.is_dir()]


def read_archive(spark: SparkSession, path: str, most_mb: int = 2048, partitions: int | None = None) -> DataFrame:
    """(path, size_bytes, raw_sha256, content) of a folder or zip that all executors see; names are relative, sorted.

    Only names are listed on the driver; contents are read where they are used,
    and a plan that does not need content still hashes it in one pass.
    """
    root = Path(path)
    if root.is_dir():
        names = sorted(p.relative_to(root).as_posix() for p in root.rglob("*") if p.is_file())
    elif zipfile.is_zipfile(root):
        names = sorted(members(root, most_mb))
    else:
        raise ValueError(f"neither a folder nor a zip: {path}")
    names = [n for n in names if not PurePosixPath(n).name.startswith(".") and PurePosixPath(n).name != SKIPPED]
    listed = spark.createDataFrame([(n,) for n in names], "path string")
    is_dir = root.is_dir()

    def read(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        archive = None if is_dir else zipfile.ZipFile(root)
        for part in parts:
            for name in part["path"]:  # one file at a time: contents may be large
                content = (root / name).read_bytes() if is_dir else archive.read(name)
                yield pd.DataFrame({"path": [name], "content": [content]})

    found = listed.repartition(partitions or max(1, min(len(names), spark.sparkContext.defaultParallelism))).mapInPandas(read, "path string, content binary")
    return found.select("path", F.length("content").cast("long").alias("size_bytes"), F.sha2("content", 256).alias("raw_sha256"), "content")
