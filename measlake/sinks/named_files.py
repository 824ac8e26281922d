"""Text files of given names (for S12-S15, S17): ``format("named_files")``.

Spark names its own files. Models with their error file and run directories are
known by name, so this sink writes one file per row, in tasks. A file is
written under a hidden name beside it and then moved, so that a reader sees it whole or
not at all, and a task that runs twice writes the same file. Readers are Spark's
own (``sources.files.read_texts``).

``path`` is relative to the folder given to ``save`` and must be there once;
a null path or one that leads out of the folder is an error. A row with null
content writes no file. The folder is a local or shared path, or a uri that Arrow
knows.
"""

from __future__ import annotations

import posixpath
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

NAME = "named_files"
SCHEMA = "path string, content string"


@dataclass
class Written(WriterCommitMessage):
    files: int


def store_of(folder: str) -> tuple[fs.FileSystem, str]:
    """File system and folder of a path as Spark writes it."""
    uri = re.sub("^file:/+", "file:///", re.sub("^s3a:", "s3:", folder))
    return fs.FileSystem.from_uri(uri)


def inside(path: str | None) -> str:
    """A relative path in its plain form."""
    if not path:
        raise ValueError("a named file needs a path")
    plain = posixpath.normpath(path)
    if plain.startswith(("/", "..")) or plain == "." or path.endswith("/"):
        raise ValueError(f"not a file below the folder: {path}")
    return plain


class Writer(DataSourceArrowWriter):
    def __init__(self, folder: str) -> None:
        self.folder = folder

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, base = store_of(self.folder)
        made: set[str] = set()
        files = 0
        for batch in iterator:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                target = f"{base}/{inside(path)}"
                if content is None:
                    continue
                parent, name = posixpath.split(target)
                if parent not in made:
                    store.create_dir(parent, recursive=True)
                    made.add(parent)
                hidden = f"{parent}/.{name}.{uuid.uuid4().hex}"
                with store.open_output_stream(hidden) as out:
                    out.write(content.encode())
                store.move(hidden, target)
                files += 1
        return Written(files)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        """Files are there when their task ends."""

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        """Files of tasks that ended stay; writing again replaces them by the same ones."""


class NamedFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def writer(self, schema: StructType, overwrite: bool) -> Writer:
        if overwrite:
            raise ValueError("named files are added to a folder; mode must be append")
        if not {"path", "content"} <= set(schema.names):
            raise ValueError("named files need the columns path and content")
        return Writer(self.options["path"])


def write_named(files: DataFrame, folder: str) -> str:
    """Write ``path`` and ``content`` below the folder."""
    files.sparkSession.dataSource.register(NamedFiles)
    files.select("path", "content").write.format(NAME).mode("append").save(folder)
    return folder
