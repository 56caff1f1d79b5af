"""One text file per row: the writer behind ``write_structure_texts`` and ``write_parsed_summaries``.

Spark's text writer takes some 30 ms a file on a local or mounted folder, where Hadoop starts a
``chmod`` process for every file and its checksum, and its job commit renames file by file on the
driver. This data source writer opens files through Arrow's file systems. Tasks write into a staging
folder next to the target; a task's files lie in folders that no other task writes
(``[<by>=<value>/]folder=<n>``), so that the job commit moves folders, not files. Until it does the
target is as it was; a failed job deletes its staging folder, and what a lost or repeated task staged
is never moved. A driver that dies leaves a ``_staging-`` folder, which readers skip.
"""

from __future__ import annotations

import posixpath
import re
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from hitroll.sinks.named import MOVERS, delete_staging, filesystem

#: Codecs by their names in Spark: the file ending, and the name in Arrow.
CODECS = {None: ("", None), "none": ("", None), "uncompressed": ("", None), "gzip": (".gz", "gzip"),
          "bzip2": (".bz2", "bz2"), "zstd": (".zst", "zstd")}
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
# As Spark escapes the values of partition columns in paths.
ESCAPED = re.compile("[\x01-\x1f\"#%'*/:=?\\\\\x7f{\\[\\]^]")


def partition_folder(name: str, value: str | None) -> str:
    value = ESCAPED.sub(lambda m: f"%{ord(m[0]):02X}", value) if value else NO_VALUE
    return f"{name}={value}"


@dataclass
class Staged(WriterCommitMessage):
    task: str | None
    folders: list[str]


class TextFilesWriter(DataSourceArrowWriter):
    """Rows of ``value, *by``."""

    def __init__(self, path: str, by: list[str], compression: str | None, overwrite: bool):
        self.path, self.by, self.overwrite = path.rstrip("/"), by, overwrite
        self.ending, self.codec = CODECS[compression]
        self.job = uuid.uuid4().hex
        fs, root = filesystem(self.path)
        fs.create_dir(posixpath.join(root, self._staging()), recursive=True)
        self.first = 0 if overwrite else self._free(fs, root)

    def _staging(self) -> str:
        return f"_staging-{self.job}"

    def _free(self, fs, root: str) -> int:
        """A folder number above those that earlier jobs used, from the folders alone."""
        from pyarrow.fs import FileSelector, FileType
        tops, used = [root], -1
        for _ in self.by:
            tops = [i.path for t in tops for i in fs.get_file_info(FileSelector(t))
                    if i.type == FileType.Directory and not i.base_name.startswith("_")]
        for t in tops:
            for i in fs.get_file_info(FileSelector(t)):
                m = re.fullmatch(r"folder=(\d+)", i.base_name)
                used = max(used, int(m[1]) if m else -1)
        return used + 1

    def write(self, iterator) -> Staged:
        fs, root = filesystem(self.path)
        number = TaskContext.get().partitionId()
        name = f"part-{number:05d}-{self.job}"
        task, made, n = None, set(), 0
        for batch in iterator:
            for value, *by in zip(*(c.to_pylist() for c in batch.columns)):
                if task is None:
                    task = uuid.uuid4().hex              # of this attempt alone
                    # Not recursive: a task that outlives its aborted job cannot bring staging back.
                    fs.create_dir(posixpath.join(root, self._staging(), task), recursive=False)
                folder = posixpath.join(*(partition_folder(c, v) for c, v in zip(self.by, by)),
                                        f"folder={self.first + number}")
                at = posixpath.join(root, self._staging(), task, folder)
                if folder not in made:
                    made.add(folder)
                    fs.create_dir(at, recursive=True)
                with fs.open_output_stream(posixpath.join(at, f"{name}.c{n:06d}.txt{self.ending}"),
                                           compression=self.codec, buffer_size=0) as out:
                    out.write((value or b"") + b"\n")
                n += 1
        return Staged(task, sorted(made))

    def commit(self, messages) -> None:
        from pyarrow.fs import FileSelector, FileType
        fs, root = filesystem(self.path)
        staging = posixpath.join(root, self._staging())
        if self.overwrite:
            for old in fs.get_file_info(FileSelector(root)):
                if old.base_name == self._staging():
                    continue
                if old.type == FileType.Directory:
                    fs.delete_dir(old.path)
                else:
                    fs.delete_file(old.path)
        moves = {posixpath.join(staging, m.task, f): posixpath.join(root, f)
                 for m in messages if m is not None and m.task for f in m.folders}
        for top in sorted({posixpath.dirname(t) for t in moves.values()}):
            fs.create_dir(top, recursive=True)

        def move(pair):
            if fs.get_file_info(pair[1]).type == FileType.NotFound:
                fs.move(*pair)
            else:                                        # another job took the same number
                for i in fs.get_file_info(FileSelector(pair[0])):
                    fs.move(i.path, posixpath.join(pair[1], i.base_name))
        with ThreadPoolExecutor(MOVERS) as pool:
            list(pool.map(move, sorted(moves.items())))
        with fs.open_output_stream(posixpath.join(root, "_SUCCESS")):
            pass
        self.abort(messages)

    def abort(self, messages) -> None:
        fs, root = filesystem(self.path)
        delete_staging(fs, posixpath.join(root, self._staging()))


class TextFiles(DataSource):
    """``df.write.format("one_text_each").save(path)`` of ``value, *by``."""

    @classmethod
    def name(cls) -> str:
        return "one_text_each"

    def writer(self, schema, overwrite) -> TextFilesWriter:
        return TextFilesWriter(self.options["path"], schema.fieldNames()[1:],
                               self.options.get("compression"), overwrite)


def write_text_files(df: DataFrame, path: str, compression: str | None, mode: str) -> None:
    """One text file per row of ``df`` (value, *by), ended by a line end."""
    df.sparkSession.dataSource.register(TextFiles)
    df = df.withColumn("value", F.col("value").cast("binary"))       # bytes as they are
    w = df.write.format("one_text_each").mode(mode)
    if compression:
        w = w.option("compression", compression.lower())
    w.save(path)
