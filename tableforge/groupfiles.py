"""A file sink that writes each group of rows as one JSON array, row by row.

Rows come sorted by group. A task writes one file, a line per group; it holds the rows of one Arrow batch and no group.
Files are written to a staging folder and moved when the whole job has succeeded, those of failed or repeated attempts go
with the folder, so a reader sees every group once or nothing.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow.fs as fs
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage


@dataclass
class Written(WriterCommitMessage):
    staged: str
    rows: int


class GroupArraySink(DataSource):
    """Columns: mark (true at a group's first row) and value (JSON text). Option: path."""

    @classmethod
    def name(cls) -> str:
        return "tableforge_group_arrays"

    def writer(self, schema, overwrite):
        return GroupArrayWriter(self.options["path"], overwrite)


class GroupArrayWriter(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite, self.run = path.rstrip("/"), overwrite, uuid.uuid4().hex

    def place(self) -> tuple[fs.FileSystem, str]:
        """The path's file system and its path there."""
        uri = self.path.replace("file:/", "file:///", 1) if self.path.startswith("file:/") and "://" not in self.path else self.path
        return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)

    def write(self, iterator):
        from pyspark import TaskContext

        files, root = self.place()
        task, rows, out = TaskContext.get(), 0, None
        staged = f"{root}/_staging-{self.run}/part-{task.partitionId():05d}-{task.taskAttemptId()}.json"
        for batch in iterator:
            if not batch.num_rows:
                continue
            if out is None:
                files.create_dir(f"{root}/_staging-{self.run}", recursive=True)
                out = files.open_output_stream(staged)
            begins = batch.column("mark").to_numpy(zero_copy_only=False)
            texts = batch.column("value").to_pylist()
            lead = np.where(begins, "]\n[", ",").tolist()
            if not rows:
                lead[0] = "["
            out.write("".join([x for pair in zip(lead, texts, strict=True) for x in pair]).encode())
            rows += batch.num_rows
        if out is not None:
            out.write(b"]\n")
            out.close()
        return Written(staged if rows else "", rows)

    def commit(self, messages):
        files, root = self.place()
        if self.overwrite:
            self._clear(files, root)
        files.create_dir(root, recursive=True)
        for m in messages:
            if m is not None and m.staged:
                files.move(m.staged, f"{root}/{m.staged.rsplit('/', 1)[1].replace('.json', f'-{self.run[:8]}.json')}")
        self._unstage(files, root)

    def _clear(self, files: fs.FileSystem, root: str) -> None:
        for info in files.get_file_info(fs.FileSelector(root, allow_not_found=True)):
            if info.type == fs.FileType.File:
                files.delete_file(info.path)

    def _unstage(self, files: fs.FileSystem, root: str) -> None:
        if files.get_file_info(f"{root}/_staging-{self.run}").type == fs.FileType.Directory:
            files.delete_dir(f"{root}/_staging-{self.run}")

    def abort(self, messages):
        self._unstage(*self.place())
