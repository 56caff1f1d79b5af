"""Container bundle (SNK5): all artefacts of a job in one ``.tar.gz``, written in parallel.

A gzip file may be a chain of independent members, and a tar archive is a chain of entries, so tasks
compress their own entries into members of about ``MEMBER`` bytes of content and stage one part file
each. The prefix sum of the part sizes gives every member its place, and one task streams the parts
together in blocks of ``BLOCK`` bytes; neither it nor the driver ever holds the archive, and a task
holds one member and one record. Standard tools list and unpack the result.

Next to the bundle lies ``<bundle>.index``, a Parquet table that tells in which member, and where in
it, each entry lies. ``read_bundle`` uses it to read a bundle in parallel, which a plain ``.tar.gz``
does not allow.

Parts carry a name of their own attempt, and only those that the committed index names are joined, so
repeated, speculative and lost tasks do no harm; the joined file has a temporary name until it is
whole. The staging folder goes in any case. Entries are ``<dataset>/<name>``; names must be plain file
names and unique, or the job fails before it publishes anything. An existing bundle is replaced; one
whose index is of another run is refused on reading. Null content is an empty entry; an empty table
gives a valid archive without entries.
"""

from __future__ import annotations

import io
import posixpath
import tarfile
import uuid
import zlib

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hitroll.schema import DATASET
from hitroll.sinks.named import checked_name, filesystem

MEMBER = 1 << 20
BLOCK = 4 << 20
GZIP = 31                     # zlib's window bits for a gzip member

STAGED = "part string, task int, name string, member long, at long, size long"


def entry(name: str, data: bytes) -> tuple[bytes, bytes]:
    """Header and padded content of one tar entry; long and non-ASCII names included."""
    info = tarfile.TarInfo(name)
    info.size = len(data)
    return info.tobuf(tarfile.PAX_FORMAT, "utf-8"), data + b"\0" * (-len(data) % tarfile.BLOCKSIZE)


def _gzip(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, GZIP)
    return z.compress(data) + z.flush()


def _stage(path: str, staging: str):
    def run(batches):
        from pyspark import TaskContext
        fs, root = filesystem(path)
        part, out, start = f"{uuid.uuid4().hex}.part", None, 0
        task = TaskContext.get().partitionId()
        raw, held = io.BytesIO(), []

        def flush():
            nonlocal raw, held, start
            data = _gzip(raw.getvalue())
            out.write(data)
            rows = pd.DataFrame([(part, task, n, start, at, size) for n, at, size in held],
                                columns=["part", "task", "name", "member", "at", "size"])
            start, raw, held = start + len(data), io.BytesIO(), []
            return rows

        try:
            for pdf in batches:
                for dataset, name, content in zip(pdf.iloc[:, 0], pdf.iloc[:, 1], pdf.iloc[:, 2]):
                    if out is None:
                        out = fs.open_output_stream(posixpath.join(posixpath.dirname(root), staging, part))
                    full = f"{checked_name(dataset)}/{checked_name(name)}"
                    data = bytes(content) if content is not None else b""
                    head, body = entry(full, data)
                    raw.write(head)
                    held.append((full, raw.tell(), len(data)))
                    raw.write(body)
                    if raw.tell() >= MEMBER:
                        yield flush()
            if held:
                yield flush()
        finally:
            if out is not None:
                out.close()
    return run


def _join(path: str, staging: str, parts: list[str]):
    """One task: the parts in order, then the end of the archive as a member of its own."""
    def run(batches):
        fs, root = filesystem(path)
        folder = posixpath.join(posixpath.dirname(root), staging)
        for _ in batches:
            whole, size = f"{uuid.uuid4().hex}.whole", 0
            with fs.open_output_stream(posixpath.join(folder, whole)) as out:
                for p in parts:
                    with fs.open_input_stream(posixpath.join(folder, p)) as f:
                        while block := f.read(BLOCK):
                            out.write(block)
                            size += len(block)
                end = _gzip(b"\0" * (2 * tarfile.BLOCKSIZE))
                out.write(end)
            yield pd.DataFrame({"whole": [whole], "size": [size + len(end)]})
    return run


def write_bundle(df: DataFrame, path: str, dataset: str = DATASET, name: str = "file_name",
                 content: str = "content") -> None:
    """Write every row's ``content`` (text or bytes) as the entry ``<dataset>/<name>`` of the archive
    at ``path``, and the table of entries at ``<path>.index``."""
    spark = df.sparkSession
    fs, root = filesystem(path)
    parent, base = path.rpartition("/")[0], posixpath.basename(root)
    staging = f"_staging-{uuid.uuid4().hex}"
    folder = posixpath.join(posixpath.dirname(root), staging)
    fs.create_dir(folder, recursive=True)
    try:
        rows = df.select(F.col(dataset).cast("string"), F.col(name).cast("string"), F.col(content).cast("binary"))
        staged_at, index_at = f"{parent}/{staging}/staged", f"{parent}/{staging}/index"
        rows.mapInPandas(_stage(path, staging), STAGED).write.parquet(staged_at)
        staged = spark.read.schema(STAGED).parquet(staged_at)
        twice = staged.groupBy("name").count().where("count > 1").select("name").head()
        if twice:
            raise ValueError(f"two entries named {twice[0]}")
        # One row per task: the parts by task, with their sizes from the files themselves.
        parts = [r["part"] for r in staged.select("task", "part").distinct().orderBy("task", "part").collect()]
        sizes = [fs.get_file_info(posixpath.join(folder, p)).size for p in parts]
        places = spark.createDataFrame(list(zip(parts, range(len(parts)), sizes)), "part string, i long, bytes long")
        before = F.sum("bytes").over(Window.orderBy("i").rowsBetween(Window.unboundedPreceding, -1))
        places = places.select("part", F.coalesce(before, F.lit(0)).cast("long").alias("before"))
        whole, size = (spark.range(0, 1, 1, 1).mapInPandas(_join(path, staging, parts), "whole string, size long")
                       .first())
        (staged.join(places, "part")
         .select("name", (F.col("before") + F.col("member")).alias("member"), "at", "size", F.lit(size).alias("bundle_size"))
         .write.parquet(index_at))
        target = f"{root}.index"
        if fs.get_file_info(target).type.name == "Directory":
            fs.delete_dir(target)
        fs.move(posixpath.join(folder, "index"), target)
        fs.move(posixpath.join(folder, whole), posixpath.join(posixpath.dirname(root), base))
    finally:
        fs.delete_dir(folder)


def read_bundle(spark: SparkSession, path: str) -> DataFrame:
    """``(dataset, file_name, content)`` of a bundle written here, one record per member at a time."""
    index = spark.read.parquet(f"{path}.index")
    members = index.groupBy("member", "bundle_size").agg(F.collect_list(F.struct("name", "at", "size")).alias("entries"))

    def run(batches):
        fs, root = filesystem(path)
        for pdf in batches:
            with fs.open_input_file(root) as f:
                for start, whole, entries in zip(pdf["member"], pdf["bundle_size"], pdf["entries"]):
                    if f.size() != whole:
                        raise ValueError(f"{path}: the index is of another bundle")
                    f.seek(int(start))
                    z, data = zlib.decompressobj(GZIP), bytearray()
                    while not z.eof:
                        data += z.decompress(f.read(1 << 16))
                    yield pd.DataFrame({
                        "dataset": [e["name"].partition("/")[0] for e in entries],
                        "file_name": [e["name"].partition("/")[2] for e in entries],
                        "content": [bytes(data[e["at"]:e["at"] + e["size"]]) for e in entries]})
    return members.mapInPandas(run, "dataset string, file_name string, content binary")
