"""File, table, archive and configuration scans."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework.functions.scalar import suffix


def scan_files(spark: SparkSession, folder: str, suffixes: list[str], glob: str = "*") -> DataFrame:
    """(path, filename, bytes, sha256, content) of the files in a folder with one of the suffixes (lower case, with dot)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
    files = files.where(suffix(F.col("path")).isin(*suffixes))
    return files.select("path", F.regexp_extract("path", r"[^/]*$", 0).alias("filename"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"), "content")


def list_files(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    """(filename, bytes) of files that match a glob; contents aren't read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
    return files.select(F.regexp_extract("path", r"[^/]*$", 0).alias("filename"), F.col("length").alias("bytes"))


def read_csv(spark: SparkSession, path: str, columns: list[str], keep_null: bool = False) -> DataFrame:
    """A CSV table with header (a byte order mark is skipped), all columns as text; absent values are ''."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    rows = spark.read.csv(path, header=True, schema=schema, multiLine=True, escape='"', enforceSchema=False)
    return rows if keep_null else rows.na.fill("")


def read_config(path: str) -> dict:
    import yaml

    with open(path, encoding="utf-8") as f:
        return yaml.safe_load(f)


def list_archives(spark: SparkSession, path: str) -> DataFrame:
    """(path, name, bytes, intact) of the members of ZIP files; intact says whether the checksum holds."""

    def entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for source, content in zip(batch["path"], batch["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    for info in archive.infolist():
                        try:
                            with archive.open(info) as member:
                                while member.read(1 << 20):
                                    pass
                            intact = True
                        except zipfile.BadZipFile:
                            intact = False
                        rows.append((source, info.filename, info.file_size, intact))
            yield pd.DataFrame(rows, columns=["path", "name", "bytes", "intact"])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(entries, "path string, name string, bytes long, intact boolean")
