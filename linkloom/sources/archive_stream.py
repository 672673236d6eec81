"""Zipped landing files as a stream: archives that are new since the last run, entry by entry.

The stream's position is a number of lists in a folder of its own; each list names the archives
that were new when somebody looked. A task opens one entry of one archive at its place in the
file system and streams its lines, so no archive is ever held as a whole.
"""

from __future__ import annotations

import io
import json
import zipfile
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from linkloom.session import shared_file
from linkloom.sources.archives import LINES_PER_BATCH

FORMAT = "zipped_lines"


class _Entry(InputPartition):
    def __init__(self, archive: str, entry: str):
        self.archive, self.entry = archive, entry


class _Reader(DataSourceStreamReader):
    def __init__(self, folder: str, log: str):
        self.folder, self.log = folder, log

    def _lists(self) -> list[str]:
        system, root = shared_file(self.log)
        found = system.get_file_info(fs.FileSelector(root, allow_not_found=True))
        return sorted(f.path for f in found if f.base_name.startswith("list-") and not f.base_name.endswith(".part"))

    def _named(self, first: int, last: int) -> list[str]:
        system, _ = shared_file(self.log)
        return [a for path in self._lists()[first:last] for a in json.loads(system.open_input_file(path).read())]

    def initialOffset(self) -> dict:
        return {"lists": 0}

    def latestOffset(self) -> dict:
        lists = self._lists()
        system, root = shared_file(self.folder)
        found = system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
        there = {f.path for f in found if f.type == fs.FileType.File and f.path.endswith(".zip")}
        if new := sorted(there - set(self._named(0, len(lists)))):
            logs, folder = shared_file(self.log)
            logs.create_dir(folder, recursive=True)
            path = f"{folder}/list-{len(lists):09d}"
            with logs.open_output_stream(f"{path}.part") as out:
                out.write(json.dumps(new).encode())
            logs.move(f"{path}.part", path)
            return {"lists": len(lists) + 1}
        return {"lists": len(lists)}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        system, _ = shared_file(self.folder)
        out = []
        for archive in self._named(start["lists"], end["lists"]):
            with system.open_input_file(archive) as file, zipfile.ZipFile(file) as opened:
                out += [_Entry(archive, e) for e in opened.namelist() if not e.endswith("/")]
        return out

    def read(self, partition: _Entry) -> Iterator[pa.RecordBatch]:
        system, _ = shared_file(self.folder)
        with system.open_input_file(partition.archive) as file, zipfile.ZipFile(file) as opened:
            with opened.open(partition.entry) as raw:
                lines = io.TextIOWrapper(raw, "utf-8", errors="replace", newline="\n")
                while chunk := [line.rstrip("\r\n") for line in islice(lines, LINES_PER_BATCH)]:
                    n = len(chunk)
                    yield pa.record_batch({"archive": [partition.archive] * n, "entry": [partition.entry] * n, "line": chunk})

    def commit(self, end: dict) -> None:
        pass


class ZippedLines(DataSource):
    """Options ``path``, the folder of the archives, and ``log``, a folder of the stream's own."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "archive string, entry string, line string"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Reader(self.options["path"], self.options["log"])


def stream_archives(spark: SparkSession, folder: str, log: str):
    """``(archive, entry, line)`` of the archives under ``folder`` as a stream; each is read once.

    Entries that are folders are passed over, bytes that are not UTF-8 are replaced. An archive
    written again under the same name isn't read again.
    """
    spark.dataSource.register(ZippedLines)
    return spark.readStream.format(FORMAT).option("path", folder).option("log", log).load()
