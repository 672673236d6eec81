"""Zipped landing files."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

LINES_PER_BATCH = 10_000


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Archives as ``(path, content)``, one row each."""
    return spark.read.format("binaryFile").load(path).select("path", "content")


def unpack_archives(archives: DataFrame) -> DataFrame:
    """Every line of every archived file, ``(archive, entry, line)``.

    Archives are unpacked in parallel; inside one, lines are streamed out in
    small batches and never held together.
    """

    def unpack(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for path, content in zip(part["path"], part["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    for entry in archive.namelist():
                        if entry.endswith("/"):
                            continue
                        with archive.open(entry) as raw:
                            lines = io.TextIOWrapper(raw, "utf-8", newline="\n")
                            while chunk := list(islice(lines, LINES_PER_BATCH)):
                                yield pd.DataFrame(
                                    {
                                        "archive": path,
                                        "entry": entry,
                                        "line": [c.rstrip("\r\n") for c in chunk],
                                    }
                                )

    return archives.select("path", "content").mapInPandas(
        unpack, "archive string, entry string, line string"
    )


def land_archives(spark: SparkSession, path: str, landing: str) -> None:
    """Unpack all archives under ``path`` into text files at ``landing``."""
    unpack_archives(read_archives(spark, path)).select("line").write.mode("append").text(landing)
