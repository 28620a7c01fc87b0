"""Readers with a declared profile, and sinks addressed by content."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from email import message_from_bytes, policy

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class ProfileError(ValueError):
    """A column that the profile names is missing."""


def read_export(spark: SparkSession, path: str, profile: list[str] | None = None, sep: str = ",") -> DataFrame:
    """A CSV export, every column a string, blanks kept as ''; a missing column of the profile is an error."""
    if not path.lower().rstrip("/").endswith((".csv", ".txt")):
        raise ValueError(f"no reader for {path}")
    df = spark.read.csv(path, header=True, sep=sep, inferSchema=False).na.fill("")
    check_profile(df, profile or [])
    return df


def check_profile(df: DataFrame, profile: list[str]) -> None:
    if missing := sorted(set(profile) - set(df.columns)):
        raise ProfileError(f"missing columns: {', '.join(missing)}")


def read_feed_pages(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Landed pages of a paged JSON feed, {"value": [...]} each; an empty feed is an error."""
    kind = T.StructType([T.StructField("value", T.ArrayType(T._parse_datatype_string(schema)))])
    rows = spark.read.schema(kind).json(path, multiLine=True).select(F.inline("value"))
    if not rows.take(1):
        raise ProfileError("the feed has no rows")
    return rows


def clean_records(df: DataFrame, columns: list[str]) -> DataFrame:
    """Trimmed, with blanks as null."""
    return df.withColumns({c: F.nullif(F.trim(c), F.lit("")) for c in columns})


def read_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """(path, content, content_hash) of a folder's files, at any depth."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder)
    return files.select("path", "content", F.sha2("content", 256).alias("content_hash"))


def expand_archives(files: DataFrame, *, most_members: int = 200, most_bytes: int = 50 << 20, most_ratio: float = 100.0) -> DataFrame:
    """(path, member, content, refusal): a row for each member of a ZIP file, or for why it was refused."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for path, content in f.itertuples(index=False):
                try:
                    infos = zipfile.ZipFile(io.BytesIO(content)).infolist()
                    archive = zipfile.ZipFile(io.BytesIO(content))
                except zipfile.BadZipFile:
                    rows.append((path, None, None, "not an archive"))
                    continue
                if len(infos) > most_members:
                    rows.append((path, None, None, "too many members"))
                    continue
                for i in infos:
                    if i.is_dir():
                        continue
                    if i.file_size > most_bytes:
                        rows.append((path, i.filename, None, "too large"))
                    elif i.file_size > most_ratio * max(1, i.compress_size):
                        rows.append((path, i.filename, None, "suspicious ratio"))
                    else:
                        rows.append((path, i.filename, archive.read(i), None))
            yield pd.DataFrame(rows, columns=["path", "member", "content", "refusal"])

    return files.select("path", "content").mapInPandas(run, "path string, member string, content binary, refusal string")


def parse_messages(files: DataFrame) -> DataFrame:
    """(path, sender, subject, body, attachments) of e-mail files."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for path, content in f.itertuples(index=False):
                m = message_from_bytes(content, policy=policy.default)
                body = m.get_body(("plain", "html"))
                names = [a.get_filename() or "" for a in m.iter_attachments()]
                rows.append((path, str(m.get("from", "")), str(m.get("subject", "")), body.get_content() if body else "", names))
            yield pd.DataFrame(rows, columns=["path", "sender", "subject", "body", "attachments"])

    return files.select("path", "content").mapInPandas(run, "path string, sender string, subject string, body string, attachments array<string>")


def archive_key(maker: str, content_hash: str):
    """Where a file is kept: its maker's folder and its content's hash."""
    return F.concat_ws("/", F.regexp_replace(F.lower(maker), r"[^a-z0-9]+", "-"), F.substring(content_hash, 1, 2), content_hash)
