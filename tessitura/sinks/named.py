"""Artifacts as named files, all of a job visible or none: a Python data source with commit and abort."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

from pyspark.sql import DataFrame, Row
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage


def opened(path: str):
    """(file system, path in it) of a URI or an absolute path, as Arrow names them."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def safe(name: str | None) -> str:
    """One path component; slashes, leading dots and the like are escaped, other names stay."""
    out = quote(name or "_", safe=" #@+,;=()[]{}!'~&")
    return out if out.strip(".") else out.replace(".", "%2E")


@dataclass
class Staged(WriterCommitMessage):
    """Where a task left its folders."""

    folder: str


class NamedWriter(DataSourceWriter):
    def __init__(self, path: str):
        self.path, self.stage = path.rstrip("/"), f".staging-{uuid.uuid4().hex}"

    def write(self, rows: Iterator[Row]) -> Staged:
        """A task attempt writes into a folder of its own, which nothing reads before the commit."""
        fs, root = opened(self.path)
        own = f"{root}/{self.stage}/{uuid.uuid4().hex}"
        fs.create_dir(own, recursive=True)
        made = set()
        for row in rows:
            folder = f"{own}/{safe(row.recording_id)}"
            if folder not in made:
                fs.create_dir(folder, recursive=True)
                made.add(folder)
            with fs.open_output_stream(f"{folder}/{safe(row.filename)}") as out:
                out.write((row.content or "").encode("utf-8", "surrogatepass"))
        return Staged(own)

    def commit(self, messages: list[Staged | None]) -> None:
        """Each recording's folder takes its place, over an earlier one; then the staging folder goes."""
        from pyarrow import fs as arrow

        fs, root = opened(self.path)
        for message in messages:
            for found in fs.get_file_info(arrow.FileSelector(message.folder)) if message else ():
                final = f"{root}/{found.base_name}"
                if fs.get_file_info(final).type != arrow.FileType.NotFound:
                    fs.delete_dir(final)
                fs.move(found.path, final)
        self.abort(messages)

    def abort(self, messages: list[Staged | None]) -> None:
        from pyarrow import fs as arrow

        fs, root = opened(self.path)
        if fs.get_file_info(f"{root}/{self.stage}").type != arrow.FileType.NotFound:
            fs.delete_dir(f"{root}/{self.stage}")


class NamedFiles(DataSource):
    """Rows (recording_id, filename, content) as ``path/recording_id/filename``."""

    @classmethod
    def name(cls) -> str:
        return "tessitura_named"

    def writer(self, schema, overwrite: bool) -> NamedWriter:
        return NamedWriter(self.options["path"])


def write_named(artifacts: DataFrame, path: str) -> None:
    """One file for each artifact under ``path``, a URI or an absolute path that Arrow's file systems reach from all machines.

    A recording's files are written by one task; folders of other recordings stay as they are. A job
    that fails leaves nothing visible; a commit that is cut off is made good by writing again.
    """
    artifacts.sparkSession.dataSource.register(NamedFiles)
    rows = artifacts.select("recording_id", "filename", "content").repartition("recording_id")
    rows.write.format(NamedFiles.name()).mode("append").save(path)
