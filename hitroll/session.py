"""Session construction and the shared scratch folder.

Intermediate files (hit files written for a round trip, per-structure tables that cut lineage)
go under the folder the cluster names in ``spark.checkpoint.dir``. On a cluster that setting is
required; only a ``local`` master without it gets a private folder. Scratch is deleted when the
application ends.
"""

from __future__ import annotations

import math
import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale. AQE re-plans joins from runtime sizes (this is the size check
# behind every non-explicit broadcast), coalesces small shuffle partitions and splits skewed ones.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app: str = "hitroll", shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Session for local runs, tests and the bench. On a cluster, pass ``master=None`` and let
    ``spark-submit`` decide."""
    b = (SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false"))
    if master:
        b = b.master(master)
    for k, v in SCALE_CONF.items():
        b = b.config(k, v)
    cores = _local_cores(master)
    if cores:
        # Listing a folder of many structure folders runs one task per folder by default (up to
        # 10,000); with few cores, batching folders per task is several times faster.
        b = b.config("spark.sql.sources.parallelPartitionDiscovery.parallelism", str(4 * cores))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _local_cores(master: str | None) -> int | None:
    if not master or not master.startswith("local"):
        return None
    inner = master[len("local"):].strip("[]").split(",")[0]
    if inner == "":
        return 1
    if inner == "*":
        return os.cpu_count() or 1
    return int(inner)


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide scratch folder: ``spark.checkpoint.dir`` as the session has it. Where it
    is unset, a ``local`` master gets a private folder; anything else raises, because executors
    could not reach a folder of the driver's machine."""
    sc = classic_context(spark)
    d = spark.conf.get("spark.checkpoint.dir", None) or (sc and sc.getCheckpointDir())
    if not d:
        if sc is None or not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="hitroll-ckpt-")
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def classic_context(spark: SparkSession):
    """The SparkContext of a classic session, or None under Spark Connect."""
    try:
        return spark.sparkContext
    except Exception:  # Connect sessions raise on sparkContext
        return None


_ROOTS: dict[str, str] = {}      # application id -> its folder under the shared one


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the application's scratch folder; never reused, so reruns cannot
    collide. The application's folder is deleted when its JVM ends."""
    sc = classic_context(spark)
    app = sc.applicationId if sc is not None else "connect"
    if app not in _ROOTS:
        root = f"{shared_dir(spark)}/hitroll/{app}-{uuid.uuid4().hex[:12]}"
        if sc is not None:
            path = spark._jvm.org.apache.hadoop.fs.Path(root)
            fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
            fs.mkdirs(path)
            fs.deleteOnExit(path)
        _ROOTS[app] = root
    return f"{_ROOTS[app]}/{name}-{uuid.uuid4().hex[:12]}"


def sizing_conf(input_bytes: int, total_cores: int, split_bytes: int = 512 << 20,
                shuffle_partition_bytes: int = 256 << 20, shuffle_bytes: int | None = None
                ) -> dict[str, str]:
    """Settings sized to the input for a cluster run (pass as ``extra`` to build_session or as
    ``--conf`` to spark-submit).

    Scan splits of ``split_bytes`` of file (a pruned columnar scan reads only part of each). The
    shuffle partition count is sized from the bytes expected to be *shuffled*, not from the
    input: the scans read a few columns and every aggregation combines map-side first, so
    ``shuffle_bytes`` defaults to an eighth of the input (pass the shuffle size measured by an
    earlier run when known). Each shuffle partition then holds about
    ``shuffle_partition_bytes``, with at least two tasks per core. Sizing from the input
    instead would multiply map and reduce tasks into ~10^11 shuffle blocks at 100 TB. AQE
    coalesces small partitions and splits skewed ones at run time. At 100 TB this gives about
    200,000 scan tasks and 50,000 shuffle partitions.
    """
    if shuffle_bytes is None:
        shuffle_bytes = input_bytes // 8
    n = max(2 * total_cores, math.ceil(shuffle_bytes / shuffle_partition_bytes))
    return {
        "spark.sql.sources.parallelPartitionDiscovery.parallelism": str(min(10000, 4 * total_cores)),
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(shuffle_partition_bytes // 2),
    }
