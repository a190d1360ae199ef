"""Zipped sources and text decoding.

A zip is not splittable, so each archive is one task: ``binaryFile`` lists the
paths (no content is read), ``mapInPandas`` opens each by its path and streams
the chosen member's lines out in Arrow batches; neither the archive nor the
member is ever held whole.
Decoding follows the fallback utf-8-sig -> utf-8 -> latin-1 (fixed-width
files are latin-1 by definition).
"""

from __future__ import annotations

import re
import zipfile
import zlib

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Member-name rules.
LEGACY_HIST_MEMBER = re.compile(r"COTAHIST[._]A\d{4}", re.IGNORECASE)
YEAR_IN_NAME = re.compile(r"(\d{4})")
BATCH_LINES = 50_000
#: What a broken archive raises (also one too short, an encrypted one and an unknown method).
BROKEN = (zipfile.BadZipFile, zlib.error, EOFError, NotImplementedError, RuntimeError, ValueError)

LINES_SCHEMA = "archive string, member string, file_year int, line_no long, line string"


def pick_csv_member(names: list[str]) -> str | None:
    """The first ``*.csv`` member (case-insensitive)."""
    return next((n for n in names if n.lower().endswith(".csv")), None)


def pick_hist_member(names: list[str]) -> str | None:
    """A ``.TXT`` member, else the legacy name pattern, else the sole member."""
    files = [n for n in names if not n.endswith("/")]
    txt = [n for n in files if n.upper().endswith(".TXT")]
    if txt:
        return txt[0]
    legacy = [n for n in files if LEGACY_HIST_MEMBER.search(n)]
    if legacy:
        return legacy[0]
    return files[0] if len(files) == 1 else None


def _decode_line(raw: bytes, encoding: str | None) -> str:
    if encoding:
        return raw.decode(encoding)
    for enc in ("utf-8-sig", "utf-8"):
        try:
            return raw.decode(enc)
        except UnicodeDecodeError:
            pass
    return raw.decode("latin-1")


def _year_of(archive: str, member: str) -> int | None:
    for name in (archive.rsplit("/", 1)[-1], member):
        m = YEAR_IN_NAME.search(name.rsplit(".", 1)[0])
        if m:
            return int(m.group(1))
    return None


def zip_lines(spark: SparkSession, paths, *, kind: str = "csv", encoding: str | None = None, tolerant: bool = False) -> DataFrame:
    """(archive, member, file_year, line_no, line) for every archive in
    ``paths``; ``kind`` selects the member rule (``csv`` or ``hist``).

    An archive that is broken or has no usable member raises in its task.
    With ``tolerant`` it is one row of an empty line whose column ``problem`` says
    why, after the lines read so far; a storage error still raises, so the
    task is tried again.
    """
    pick = pick_csv_member if kind == "csv" else pick_hist_member
    enc = encoding if encoding is not None else ("latin-1" if kind == "hist" else None)
    schema = LINES_SCHEMA + ", problem string" if tolerant else LINES_SCHEMA
    columns = [f.split()[0] for f in schema.split(", ")]

    def frame(rows):
        return pd.DataFrame([(*r, None) for r in rows] if tolerant else rows, columns=columns)

    def lines_of(path):
        # The member is read through a stream of the archive's path: never whole in memory.
        fs, inner = pafs.FileSystem.from_uri(path)
        with fs.open_input_file(inner) as raw_file, zipfile.ZipFile(raw_file) as zf:
            member = pick(zf.namelist())
            if member is None:
                raise zipfile.BadZipFile(f"{path}: no {kind} member in {zf.namelist()[:20]}")
            year = _year_of(path, member)
            rows, n = [], 0
            with zf.open(member) as fh:
                for raw in fh:
                    n += 1
                    rows.append((path, member, year, n, _decode_line(raw.rstrip(b"\r\n"), enc)))
                    if len(rows) >= BATCH_LINES:
                        yield frame(rows)
                        rows = []
            if rows:
                yield frame(rows)

    def unzip(batches):
        for pdf in batches:
            for path in pdf["path"]:
                try:
                    yield from lines_of(path)
                except BROKEN as e:
                    if not tolerant:
                        raise
                    yield pd.DataFrame([(path, "", 0, 0, "", f"{type(e).__name__}: {e}")], columns=columns)

    files = spark.read.format("binaryFile").load(paths if isinstance(paths, str) else list(paths))
    return files.select(F.regexp_replace("path", "^file:/+", "file:///").alias("path")).mapInPandas(unzip, schema)
