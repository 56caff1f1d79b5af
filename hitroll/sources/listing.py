"""Folders listed, and their files read, by tasks: what the whole-file sources stand on.

A level of folders is listed by one job, into a table in the scratch folder; the folders found are the
next level. The driver sees folders, never files. As in Spark's sources, hidden files are left out
(names with ``.`` or ``_`` in front), ``<key>=<value>`` folders give partition columns, and without
such columns the files right in the folder count, unless all subfolders are asked for.
"""

from __future__ import annotations

import os
import re
import zlib
from dataclasses import dataclass, field
from itertools import batched
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from hitroll.session import classic_context, scratch_path

NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
LISTED = ("root string, dir string, name string, path string, uri string, uri_name string, length long, "
          "is_folder boolean")
COLUMNS = [c.split()[0] for c in LISTED.split(", ")]
LIST_ROWS = 1 << 13
TASK_FILES, TASK_BYTES = 1 << 12, 32 << 20      # read by one task, about
BATCH_BYTES = 4 << 20                           # of contents returned at a time
# Packed files that only Hadoop's codecs can read.
HADOOP_ONLY = r"\.(snappy|lz4)$"
# What java.net.URI quotes in a path.
QUOTED = re.compile(r"[^A-Za-z0-9_\-!.~'()*,;:$&+=@/\u00a1-\U0010ffff]|[\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def uri(path: str) -> str:
    return QUOTED.sub(lambda m: quote(m[0], safe=""), path)


def hidden(name: str) -> bool:
    return ((name.startswith("_") and "=" not in name or name.startswith(".") or name.endswith("._COPYING_"))
            and not name.startswith(("_metadata", "_common_metadata")))


def _opened(root: str):
    """Arrow file system and path of a Hadoop-style folder; no file system for a local one."""
    if root.startswith("file:"):
        return None, "/" + root[5:].lstrip("/")
    return pa.fs.FileSystem.from_uri(uri(root))


def _entries(root: str, folder: str):
    """``name, length, is_folder`` of what lies in a folder and is not hidden."""
    fs, top = _opened(root)
    at = f"{top}/{folder}" if folder else top
    if fs is not None:
        for i in fs.get_file_info(pa.fs.FileSelector(at)):
            if not hidden(i.base_name):
                yield i.base_name, i.size or 0, i.type == pa.fs.FileType.Directory
        return
    with os.scandir(at) as found:                # one at a time: a folder may hold millions
        for e in found:
            if not hidden(e.name):
                try:
                    yield e.name, e.stat().st_size, e.is_dir()
                except FileNotFoundError:        # gone meanwhile
                    continue


def _list(batches):
    for b in batches:
        for root, folder in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            here = f"{root.rstrip('/')}/{folder}/" if folder else f"{root.rstrip('/')}/"
            there = uri(here)
            for some in batched(_entries(root, folder), LIST_ROWS):
                names, sizes, folders = (list(c) for c in zip(*some))
                quoted = [uri(n) for n in names]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([root] * len(names)), pa.array([folder] * len(names)), pa.array(names),
                     pa.array([here + n for n in names]), pa.array([there + n for n in quoted]),
                     pa.array(quoted), pa.array(sizes, pa.int64()), pa.array(folders)], names=COLUMNS)


def _roots(spark: SparkSession, path: str) -> list[str] | None:
    """Folders that ``path`` names, which may hold wildcards; None if Spark's own sources must list
    them: files, nothing there (they raise), a file system that Arrow cannot open."""
    if classic_context(spark) is None:
        return None
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = []
    for status in at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at) or ():
        if not status.isDirectory():
            return None
        out.append(status.getPath().toString())
    try:
        for root in out[:1]:
            _opened(root)
    except (OSError, ValueError, NotImplementedError):
        return None
    return out or None


@dataclass
class Found:
    """``files``: a row of ``LISTED`` per file, with the partition columns ``parts``."""

    files: DataFrame
    number: int
    length: int
    readable: bool                               # all of them, by ``contents``
    parts: list[str] = field(default_factory=list)

    def tasks(self) -> int:
        least = int(self.files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return max(1, min(self.number, max(least, -(-self.number // TASK_FILES), -(-self.length // TASK_BYTES))))


def _partition_values(folder: str) -> dict[str, str | None]:
    """Of ``a=1/b=2``; folders without ``=`` below the last such folder do not count, as in Spark."""
    out = {}
    for part in reversed(folder.split("/") if folder else []):
        key, eq, value = part.partition("=")
        if eq and key:
            out[unquote(key)] = None if value == NO_VALUE else unquote(value)
        elif out:
            break
    return dict(reversed(out.items()))


def _partition_types(spark, root: str, one_file: dict[str, str], values: dict[str, dict],
                     given: dict[str, DataType]) -> dict[str, str]:
    """Types of the partition columns: as ``given``, whole numbers as such, else as Spark tells from
    a file for every value."""
    kinds, unsure = {}, {}
    inferred = spark.conf.get("spark.sql.sources.partitionColumnTypeInference.enabled") == "true"
    for c in next(iter(values.values())):
        texts = {v[c]: folder for folder, v in values.items()}
        if c in given:
            kinds[c] = given[c].simpleString()
        elif inferred and any(texts) and all(t is None or re.fullmatch(r"\d{1,9}", t) for t in texts):
            kinds[c] = "int"
        else:
            unsure |= {folder: one_file[folder] for folder in texts.values()}
    if unsure:
        df = spark.read.format("text").option("basePath", root).load(sorted(unsure.values()))
        kinds = {f.name: f.dataType.simpleString() for f in df.schema[1:]} | kinds
    return kinds


def find(spark: SparkSession, path: str, glob: str | None = None, recursive: bool = False,
         types: dict[str, DataType] | None = None) -> Found | None:
    """Files under ``path`` whose names match ``glob``; None if Spark's own sources must list them.
    ``types`` of partition columns may be given. The listing is taken now, as Spark's is."""
    roots = _roots(spark, path)
    if roots is None:
        return None
    tables, level = [], [(r, "") for r in roots]
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    while level:
        tables.append(scratch_path(spark, "listing"))
        (spark.createDataFrame(level, "root string, dir string").repartition(min(len(level), tasks))
         .mapInArrow(_list, LISTED).write.parquet(tables[-1]))
        below = spark.read.schema(LISTED).parquet(tables[-1]).where("is_folder")
        level = [(r["root"], r["at"]) for r in below.select(
            "root", F.ltrim(F.concat("dir", F.lit("/"), "name"), F.lit("/")).alias("at")).collect()]
    files = spark.read.schema(LISTED).parquet(*tables).where("NOT is_folder")
    if glob:
        pattern = spark._jvm.org.apache.hadoop.fs.GlobPattern(glob).compiled().toString()
        files = files.where(F.col("name").rlike(f"(?s)^(?:{pattern})$"))
    parts: list[str] = []
    if not recursive:
        per = files.groupBy("root", "dir").agg(F.min("path").alias("path")).collect()    # a row a folder
        values = {r["dir"]: _partition_values(r["dir"]) for r in per}
        if any(values.values()):
            if len(roots) > 1 or len({tuple(v) for v in values.values()}) > 1:
                return None                      # Spark tells whether these go together
            kinds = _partition_types(spark, roots[0], {r["dir"]: r["path"] for r in per}, values, types or {})
            parts = list(next(iter(values.values())))
            known = spark.createDataFrame([(d, *v.values()) for d, v in values.items()],
                                          "dir string, " + ", ".join(f"`{c}` string" for c in parts))
            known = known.select("dir", *[F.col(f"`{c}`").cast(kinds[c]).alias(c) for c in parts])
            files = files.join(F.broadcast(known), "dir")     # a row a folder
        else:
            files = files.where("dir = ''")
    n, length, packed = files.agg(F.count(F.lit(1)), F.sum("length"),
                                  F.coalesce(F.bool_or(F.col("name").rlike(HADOOP_ONLY)), F.lit(False))).first()
    return Found(files, n, length or 0, not packed, [f"`{c}`" for c in parts])


def _unpacked(name: str, data: bytes) -> bytes:
    if name.endswith(".gz"):
        import gzip
        return gzip.decompress(data)
    if name.endswith(".bz2"):
        import bz2
        return bz2.decompress(data)
    if name.endswith(".deflate"):
        return zlib.decompress(data)
    if name.endswith(".zst"):
        return pa.CompressedInputStream(pa.BufferReader(data), "zstd").read()
    return data


def contents(files: DataFrame, tasks: int, unpack: bool) -> DataFrame:
    """``files`` (root, path, name, length, ...) with the bytes of each as ``content``."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in files.schema) + ", content binary"

    def read(batches):
        for b in batches:
            held, size, first = [], 0, 0
            for i, (root, path, name) in enumerate(zip(*(b.column(c).to_pylist() for c in ("root", "path", "name")))):
                fs, top = _opened(root)
                at = top.rstrip("/") + path[len(root.rstrip("/")):]
                with open(at, "rb") if fs is None else fs.open_input_stream(at, compression=None) as f:
                    data = f.read()
                held.append(_unpacked(name, data) if unpack else data)
                size += len(held[-1])
                if size >= BATCH_BYTES or i == b.num_rows - 1:
                    yield pa.RecordBatch.from_arrays(
                        [*b.slice(first, len(held)).columns, pa.array(held, pa.binary())],
                        names=[*b.schema.names, "content"])
                    held, size, first = [], 0, i + 1
    return files.repartition(tasks, "path").mapInArrow(read, schema)
