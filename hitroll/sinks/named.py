"""Artefacts under their own names (SNK3): one file per row, published together.

A Spark data source writer. Tasks write their files into a staging folder of the job next to the
target; only when all tasks have committed does the job move them to ``<dataset>/<name>``, replacing
files of the same name. A failed or aborted job deletes its staging folder and leaves the target as
it was; a repeated or lost task leaves only staged files that nobody moves. A driver that dies
leaves a ``_staging-`` folder, which readers skip.

The job commit reads the staged names twice, folder by folder, to look for names that repeat and to
move; in between it holds 16 bytes a file, not the names.

Names must be plain file names, and no two rows may have the same dataset and name: the job fails
before it moves anything. Commit messages carry one folder per task, not the files. Files are
reached through Arrow's file systems (local and mounted folders, HDFS, object stores), so no
machine-local folder is involved.
"""

from __future__ import annotations

import hashlib
import os
import posixpath
import re
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from hitroll.schema import DATASET

MOVERS = 16
ABORT_TRIES = 25


def filesystem(path: str):
    """Arrow file system and path within it of a Hadoop-style path."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))


def checked_name(name: str | None) -> str:
    if not name or name in (".", "..") or "/" in name or "\0" in name or name.startswith("_staging-"):
        raise ValueError(f"not a file name: {name!r}")
    return name


def names(fs, folder: str) -> list[str]:
    """Of the files of a folder."""
    from pyarrow.fs import FileSelector
    return (os.listdir(folder) if fs.type_name == "local"
            else [i.base_name for i in fs.get_file_info(FileSelector(folder))])


def repeated(folders, listed) -> str | None:
    """A ``<dataset>/<name>`` that is in more than one of ``folders`` (path, dataset), if there is any."""
    def digests():
        for at, d in folders:
            for n in listed(at):
                yield n, d, hashlib.blake2b(f"{d}/{n}".encode(errors="surrogateescape"), digest_size=16).digest()
    held = bytearray()
    for _, _, x in digests():
        held += x
    halves = np.frombuffer(held, "u8").reshape(-1, 2)
    order = np.lexsort(halves.T)
    same = (halves[order[1:]] == halves[order[:-1]]).all(axis=1)
    if not same.any():
        return None
    one = halves[order[1:][same][0]].tobytes()
    return next(f"{d}/{n}" for n, d, x in digests() if x == one)


def delete_staging(fs, staging: str) -> None:
    from pyarrow.fs import FileType
    for left in range(ABORT_TRIES, -1, -1):              # tasks may still be ending
        if fs.get_file_info(staging).type != FileType.Directory:
            return
        try:
            fs.delete_dir(staging)
        except OSError:
            if not left:
                raise
            time.sleep(0.2)


@dataclass
class Staged(WriterCommitMessage):
    folder: str | None


class NamedFilesWriter(DataSourceWriter):
    def __init__(self, path: str, job: str):
        self.path, self.job = path.rstrip("/"), job
        fs, root = filesystem(self.path)
        fs.create_dir(posixpath.join(root, self._staging()), recursive=True)

    def _staging(self) -> str:
        return f"_staging-{self.job}"

    def write(self, iterator) -> Staged:
        fs, root = filesystem(self.path)
        folder, seen = None, set()
        for row in iterator:
            dataset, name = checked_name(row[0]), checked_name(row[1])
            if (dataset, name) in seen:
                raise ValueError(f"two files named {dataset}/{name}")
            seen.add((dataset, name))
            if folder is None:
                folder = uuid.uuid4().hex                # of this attempt alone
                made = set()
                # Not recursive: a task that outlives its aborted job cannot bring staging back.
                fs.create_dir(posixpath.join(root, self._staging(), folder), recursive=False)
            at = posixpath.join(root, self._staging(), folder, dataset)
            if dataset not in made:
                made.add(dataset)
                fs.create_dir(at, recursive=False)
            with fs.open_output_stream(posixpath.join(at, name)) as out:
                out.write(bytes(row[2] or b""))
        return Staged(folder)

    def commit(self, messages) -> None:
        from pyarrow.fs import FileSelector, FileType
        fs, root = filesystem(self.path)
        staging = posixpath.join(root, self._staging())
        tops = [posixpath.join(staging, m.folder) for m in messages if m is not None and m.folder is not None]
        # Datasets, some of which may have many files in a task's folder.
        folders = [(i.path, i.base_name) for top in tops for i in fs.get_file_info(FileSelector(top))
                   if i.type == FileType.Directory]
        twice = repeated(folders, lambda at: names(fs, at))
        if twice:
            self.abort(messages)
            raise ValueError(f"two files named {twice}")
        for d in sorted({d for _, d in folders}):
            fs.create_dir(posixpath.join(root, d), recursive=True)
        # Renames of a local or mounted folder are short calls; threads pay off where each is a request.
        for at, d in folders:
            if fs.type_name == "local":
                for n in names(fs, at):
                    os.replace(posixpath.join(at, n), posixpath.join(root, d, n))
            else:
                with ThreadPoolExecutor(MOVERS) as pool:
                    list(pool.map(lambda n: fs.move(posixpath.join(at, n), posixpath.join(root, d, n)),
                                  names(fs, at)))
        self.abort(messages)

    def abort(self, messages) -> None:
        fs, root = filesystem(self.path)
        delete_staging(fs, posixpath.join(root, self._staging()))


class NamedFiles(DataSource):
    """``df.write.format("named_files").mode("append").save(path)`` of ``dataset, name, content``."""

    @classmethod
    def name(cls) -> str:
        return "named_files"

    def writer(self, schema, overwrite) -> NamedFilesWriter:
        return NamedFilesWriter(self.options["path"], uuid.uuid4().hex)


def write_named_artefacts(df: DataFrame, path: str, dataset: str = DATASET, name: str = "file_name",
                          content: str = "content") -> None:
    """Publish every row's ``content`` (text or bytes; null is an empty file) as the file
    ``<path>/<dataset>/<name>``."""
    df.sparkSession.dataSource.register(NamedFiles)
    (df.select(F.col(dataset).cast("string"), F.col(name).cast("string"), F.col(content).cast("binary"))
     .write.format("named_files").mode("append").save(path))
