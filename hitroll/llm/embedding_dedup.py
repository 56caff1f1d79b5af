"""Embedding near-duplicates by cross-polytope hashing, with verified pairs.

Equal vectors are one class. A hash is the signed largest coordinate after a fast pseudo-random
rotation (three rounds of random signs and a Hadamard transform); a bucket key joins ``ROTATIONS``
of them. In each of ``TABLES`` tables a vector enters its ``PROBES`` nearest buckets (multiprobe:
the next-largest coordinates, cheapest combinations first), and vectors that meet in any bucket are
compared by cosine in double precision. For two vectors at the threshold of 0.95 in 64 dimensions
the chance to meet is above 0.999 (tests measure it).

Buckets are compared in blocks: a bucket of more than ``BLOCK`` vectors is dealt into chunks, and
every pair of chunks is a task's block, so a bucket of any size is compared whole. A block emits
at most a link count and one edge per vector, never its pairs. A pair is counted in the first
bucket that both vectors share, which each block tells from the vectors' own keys.

Defined results: null vectors, zero vectors and those with null or non-finite components link with
nothing; vectors of different dimensions are not compared; equal vectors link; repeated rows are
vectors of their own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitroll.llm.common import cut
from hitroll.llm.components import components

THRESHOLD = 0.95
TABLES, ROTATIONS, PROBES = 10, 3, 3
CHOICES = 3           # coordinates considered per rotation
BLOCK = 512
SEED = 77


# ----------------------------------------------------------------------------------- hashing

def hadamard(x: np.ndarray) -> np.ndarray:
    """Normalised fast Hadamard transform of the rows; their length is a power of two."""
    n, d = x.shape
    h = 1
    while h < d:
        pair = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([pair[:, :, 0] + pair[:, :, 1], pair[:, :, 0] - pair[:, :, 1]], 2)
        x = x.reshape(n, d)
        h *= 2
    return x / np.sqrt(d)


def bucket_keys(x: np.ndarray) -> np.ndarray:
    """Keys of unit rows, one row each: ``TABLES * PROBES``, table by table, ascending within a
    table; the table is part of the key."""
    n, dim = x.shape
    d = 1 << max(1, (dim - 1).bit_length())
    x = np.pad(x, ((0, 0), (0, d - dim)))
    rng = np.random.default_rng([SEED, dim])
    grid = np.indices((min(CHOICES, d),) * ROTATIONS).reshape(ROTATIONS, -1)
    out = []
    for table in range(TABLES):
        codes, costs = [], []
        for _ in range(ROTATIONS):
            y = x
            for _ in range(3):
                y = hadamard(y * rng.choice([-1.0, 1.0], d))
            top = np.argsort(-np.abs(y), axis=1, kind="stable")[:, :CHOICES]
            v = np.take_along_axis(y, top, 1)
            codes.append(2 * top + (v < 0))
            costs.append((np.abs(v[:, :1]) - np.abs(v)) ** 2)
        cost = sum(c[:, g] for c, g in zip(costs, grid))
        probes = np.argsort(cost, axis=1, kind="stable")[:, :PROBES]
        key = np.full(probes.shape, table, np.int64)
        for c, g in zip(codes, grid):
            key = key * (2 * d) + np.take_along_axis(c, g[probes], 1)
        out.append(np.sort(key, axis=1))
    return np.concatenate(out, axis=1)


def _matrix(column) -> tuple[np.ndarray, np.ndarray]:
    """Rows of an Arrow list column grouped as one float64 matrix; all rows have one length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def usable(v):
    """Whether a vector (array<double>) can link at all."""
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(good & F.exists(v, lambda x: x != 0.0), F.lit(False))


def hashed(classes: DataFrame) -> DataFrame:
    """``node, n, v, dim, keys``; ``v`` has unit length."""

    def run(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            sizes = np.diff(np.asarray(batch.column(2).offsets))
            for dim in np.unique(sizes):
                part = table.take(np.flatnonzero(sizes == dim))
                x = _matrix(part.column(2))
                x = x / np.abs(x).max(axis=1, keepdims=True)     # no overflow in the norm
                x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
                keys = bucket_keys(x)
                ends = np.arange(len(x) + 1, dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).combine_chunks(), part.column(1).combine_chunks(),
                     pa.ListArray.from_arrays(pa.array(ends * dim), pa.array(x.ravel())),
                     pa.array(np.full(len(x), dim), pa.int32()),
                     pa.ListArray.from_arrays(pa.array(ends * keys.shape[1]),
                                              pa.array(keys.ravel()))],
                    names=["node", "n", "v", "dim", "keys"])

    return classes.select("node", "n", "v").mapInArrow(
        run, "node long, n long, v array<double>, dim int, keys array<long>")


def _keys(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


# --------------------------------------------------------------------------------- verifying

BLOCK_KEY = ["dim", "bucket", "i", "j"]


def _edges(table: pa.Table, columns: list[str]) -> np.ndarray:
    """Where a new combination of ``columns`` begins, and the end."""
    marks = np.stack([np.asarray(table.column(c)) for c in columns])
    return np.flatnonzero(np.r_[True, (marks[:, 1:] != marks[:, :-1]).any(axis=0), True])


def _parts(table: pa.Table, columns: list[str]) -> list[pa.Table]:
    edges = _edges(table, columns)
    return [table.slice(lo, hi - lo).combine_chunks() for lo, hi in zip(edges[:-1], edges[1:])]


def _labels(linked: np.ndarray) -> np.ndarray:
    """Smallest row reachable by links, per row of a symmetric matrix."""
    label = np.arange(len(linked))
    while True:
        low = np.minimum(label, np.where(linked, label[None, :], len(label)).min(axis=1))
        low = low[low]
        if (low == label).all():
            return label
        label = low


def _first_shared(keys: np.ndarray, i: np.ndarray, j: np.ndarray, bucket: int) -> np.ndarray:
    """Whether ``bucket`` is the first key that rows i and j share."""
    alive = np.arange(len(i))
    tables = keys.reshape(len(keys), -1, PROBES)
    at = next(t for t in range(tables.shape[1])
              if (tables[:, t] == bucket).any(axis=1).all())
    for t in range(at + 1):
        a, b = tables[i[alive], t], tables[j[alive], t]
        same = a[:, :, None] == b[:, None, :]
        if t == at:                                  # a smaller shared key of the same table
            same &= a[:, :, None] < bucket
        alive = alive[~same.any(axis=(1, 2))]
    out = np.zeros(len(i), bool)
    out[alive] = True
    return out


def compare_block(nodes, weights, x, keys, side, bucket: int, threshold: float):
    """Counts and edges of one block: ``(nodes, links, nodes, their smallest linked node)``.
    ``side`` is 0 or 1 per row; in a block of two chunks only pairs across them count."""
    two = side.min() != side.max()
    cosine = x @ x.T
    linked = cosine >= threshold
    np.fill_diagonal(linked, False)
    if two:
        linked &= side[:, None] != side[None, :]
    i, j = np.nonzero(np.triu(linked))
    if not len(i):
        return None
    count = np.zeros(len(nodes), np.int64)
    first = _first_shared(keys, i, j, bucket)
    np.add.at(count, i[first], weights[j[first]])
    np.add.at(count, j[first], weights[i[first]])
    order = np.argsort(nodes, kind="stable")
    label = _labels(linked[np.ix_(order, order)])
    return count, nodes[order], nodes[order][label]


def _blocks(hashes: DataFrame) -> DataFrame:
    """``bucket, dim, i, j, side`` and the vector, sorted so that a block's rows are together."""
    keyed = hashes.select("node", "dim", F.explode("keys").alias("bucket"))
    sizes = (keyed.groupBy("dim", "bucket").agg(F.count(F.lit(1)).alias("size"))
             .where("size > 1"))
    members = cut(keyed.join(sizes, ["dim", "bucket"]), "buckets")
    chunks = F.ceil(F.col("size") / BLOCK).cast("int")
    members = members.withColumn("chunks", chunks).withColumn(
        "c", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    members = members.select("dim", "bucket", "node", F.least("c", "other").alias("i"),
                             F.greatest("c", "other").alias("j"),
                             (F.col("c") > F.col("other")).cast("int").alias("side"))
    return (members.join(hashes.drop("dim"), "node").repartition(*BLOCK_KEY)
            .sortWithinPartitions(*BLOCK_KEY))


def compared(hashes: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per vector and block: ``node, links, low`` (links to count, smallest node linked there)."""

    def flush(rows):
        """The blocks in ``rows``, which holds whole blocks only."""
        whole = pa.Table.from_batches(rows).combine_chunks()
        got = ([], [], [])
        for part in _parts(whole, ["dim"]):                    # vectors of one length at a time
            nodes, n, side = (np.asarray(part.column(c)) for c in ("node", "n", "side"))
            buckets = np.asarray(part.column("bucket"))
            x, keys = _matrix(part.column("v")), _keys(part.column("keys"))
            edges = _edges(part, BLOCK_KEY)
            for lo, hi in zip(edges[:-1], edges[1:]):
                if hi - lo < 2:
                    continue
                s = slice(lo, hi)
                made = compare_block(nodes[s], n[s], x[s], keys[s], side[s], int(buckets[lo]),
                                     threshold)
                if made is None:
                    continue
                count, ordered, low = made
                keep, far = count > 0, ordered != low
                got[0].extend([nodes[s][keep], ordered[far]])
                got[1].extend([count[keep], np.zeros(far.sum(), np.int64)])
                got[2].extend([nodes[s][keep], low[far]])
        if got[0]:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(g)) for g in got],
                                             names=["node", "links", "low"])

    def run(batches):
        """Everything up to the last change of block is whole; the rest waits for more rows."""
        held = []
        for batch in batches:
            if not batch.num_rows:
                continue
            both = pa.Table.from_batches([*(b.slice(b.num_rows - 1) for b in held[-1:]), batch])
            starts = _edges(both, BLOCK_KEY)[1:-1]
            if not len(starts):
                held.append(batch)
                continue
            last = int(starts[-1]) - (both.num_rows - batch.num_rows)
            done = [*held, batch.slice(0, last)]
            held = [batch.slice(last)]
            yield from flush([b for b in done if b.num_rows])
        if held:
            yield from flush(held)

    return _blocks(hashes).mapInArrow(run, "node long, links long, low long")




def near_duplicate_vectors(embeddings: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` per row of ``embeddings`` (vec_id, embedding)."""
    v = F.col("embedding").cast("array<double>")
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"),
                             F.when(usable(v), v).alias("v"))
    rows = rows.withColumn("digest", F.md5(F.to_json(F.when(F.col("v").isNotNull(),
                                                            F.struct("v")))))
    classes = (rows.where("digest IS NOT NULL").groupBy("digest")
               .agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("n"),
                    F.first("v").alias("v")))
    hashes = cut(hashed(classes), "vector-hashes")
    made = cut(compared(hashes, threshold), "vector-links")
    counts = made.groupBy("node").agg(F.sum("links").alias("links"))
    groups = components(made.where("node <> low").select(F.col("node").alias("a"),
                                                         F.col("low").alias("b")))
    of_class = (classes.select("digest", "node", "n").join(counts, "node", "left")
                .join(groups, "node", "left")
                .select("digest", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("links"),
                        F.coalesce("component", "node").alias("component")))
    component = F.coalesce("component", "vec_id")
    return (rows.select("vec_id", "digest").join(of_class, "digest", "left")
            .select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                    component.alias("component_id"),
                    component.eqNullSafe(F.col("vec_id")).alias("kept")))


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet")
                                  .select("vec_id", "embedding"))


OP9_SQL = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false)))
    AND list_bool_or(list_transform(embedding, lambda x: x <> 0))),
p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
      AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= {THRESHOLD}),
r AS (SELECT vec_id AS node, vec_id AS root FROM embeddings UNION
      SELECT p.b, r.root FROM r JOIN p ON p.a = r.node),
c AS (SELECT node, min(root) AS component_id FROM r GROUP BY node)
SELECT e.vec_id, (SELECT count(*) FROM p WHERE p.a = e.vec_id) AS n_links, c.component_id,
       e.vec_id = c.component_id AS kept
FROM embeddings e JOIN c ON c.node = e.vec_id
"""
