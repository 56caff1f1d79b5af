"""Exact substring dedup: every byte covered by a ``LENGTH``-byte string that starts elsewhere too
is removed.

Comparing all suffixes of a corpus in one array is out of reach, but equal windows of ``LENGTH``
bytes have equal minimizers (the leftmost smallest hash of a ``GRAM``-byte string inside). Each
window thus belongs to one anchor, each anchor to a run of windows, and windows can only be equal
if their anchors' hashes are:

1. One row per anchor: its hash, and the hash of its *stretch* (all bytes of its windows). Anchors
   seen once are done. Stretches seen twice are repeated as a whole, whatever their number.
2. What is left are different stretches round a common anchor: where copies begin and end. They
   are sorted by suffix, in blocks of whole anchor groups. The suffix array is built by linear
   grouping: groups of suffixes with a common Lyndon prefix are refined in descending order by way
   of previous-smaller pointers; then every group's order is emitted in one scan from the smallest
   suffix on, each suffix placing those for which it is the next smaller one. Symbols are eight
   bytes on a grid fixed by the anchor; windows between grid points are told apart by the eight
   bytes at their ends, so the comparison is exact to the byte.
3. A group with very many different stretches is dealt on by the bytes that windows of 64, then 8,
   then 1 neighbouring starts have in common, and stretches are merged again at every level. At
   the last level the windows themselves are counted. So no group grows with the data.

Defined results: null text is empty; texts under ``LENGTH`` bytes keep all; repeated rows are
copies of one another; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitroll.llm.common import cut
from hitroll.llm.shingles import _powers, mix

LENGTH = 400
KEPT_BYTES = 16 << 20       # of remaining text that a task returns at a time
GRAM = 128                                 # longer strings in common by chance are rare
GRID = 8                                   # bytes per symbol
SYMBOLS = (LENGTH - GRID) // GRID          # whole symbols in a window, wherever it starts
CELLS = (64, 8, 1)                         # starts that share a key when a group is dealt on
GROUP = 1000                               # different stretches that a block takes per group
BLOCK_SYMBOLS = 200_000
CHUNK = 1 << 20
BASE = 0xB5026F5AA96619E9
NEVER = np.uint64(0xFFFFFFFFFFFFFFFF)


# ------------------------------------------------------------------------------ suffix array

def suffix_array(s: list[int]) -> list[int]:
    """Suffix array of ``s``, whose last symbol is smaller than all others, by linear grouping."""
    n = len(s)
    if n < 2:
        return list(range(n))
    # Groups are segments of `sa`; `start[i]` is the segment of suffix i, `end[g]` its last place.
    sa = sorted(range(n), key=s.__getitem__)
    place, start, end = [0] * n, [0] * n, [0] * n
    first = 0
    for k, i in enumerate(sa):
        if s[i] != s[sa[first]]:
            first = k
        place[i], start[i], end[first] = k, first, k
    before = [-1] * n                      # nearest suffix to the left in a smaller group

    # Phase 1: the largest group's context is a Lyndon word u. The suffixes it points back to are
    # followed by u as often as members point to them; more of u ranks higher in their group.
    top = n - 1
    while top >= 0:
        low = start[sa[top]]
        pointed: dict[int, int] = {}
        for i in sorted(sa[low:top + 1]):
            j = i - 1
            while j >= 0 and start[j] >= low:
                j = before[j]
            before[i] = j
            if j >= 0:
                pointed[j] = pointed.get(j, 0) + 1
        if pointed:
            by_times: dict[int, list[int]] = {}
            for j, times in pointed.items():
                by_times.setdefault(times, []).append(j)
            for times in sorted(by_times, reverse=True):
                moved: dict[int, list[int]] = {}
                for j in by_times[times]:
                    moved.setdefault(start[j], []).append(j)
                for g, members in moved.items():
                    last = end[g]
                    new = last - len(members) + 1
                    if new == g:
                        continue           # the whole group moves: it stays as it is
                    at = last
                    for j in members:      # to the upper end of the segment
                        k, other = place[j], sa[at]
                        sa[k], sa[at] = other, j
                        place[other], place[j] = k, at
                        at -= 1
                    for j in members:
                        start[j] = new
                    end[g], end[new] = new - 1, last
        top = low - 1

    # Phase 2: from the smallest suffix on; the chain of pointers from the one before it holds
    # those that have it as their next smaller suffix.
    out, placed = [-1] * n, [False] * n
    out[0] = n - 1
    placed[n - 1] = True
    start[n - 1] += 1
    free = list(range(n))                  # next free place of a segment
    for i in range(n):
        j = out[i] - 1
        while j >= 0 and not placed[j]:
            g = start[j]
            out[free[g]] = j
            free[g] += 1
            placed[j] = True
            j = before[j]
    return out


# ---------------------------------------------------------------------------------- anchors

def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours (block prefix and suffix minima)."""
    n = len(x)
    if n < width:
        return x[:0]
    full = np.full(-(-n // width) * width, NEVER)
    full[:n] = x
    blocks = full.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - width + 1], ahead[width - 1:n])


class Hashes:
    """Hashes of substrings of ``data`` from prefix sums of a polynomial."""

    value = mix((np.arange(256).astype(np.uint64) + np.uint64(7)) * np.uint64(0x9E3779B97F4A7C15))
    up = down = np.empty(0, np.uint64)

    def __init__(self, data: np.ndarray):
        n = len(data)
        if len(Hashes.up) <= n:
            Hashes.up = _powers(BASE, n + 1)
            Hashes.down = _powers(pow(BASE, -1, 1 << 64), n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.value[data] * self.up[:n], out=self.sums[1:])

    def of(self, lo, hi) -> np.ndarray:
        return mix((self.sums[hi] - self.sums[lo]) * self.down[lo])

    def grams(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return mix((self.sums[size:] - self.sums[:-size]) * self.down[:n])


def anchors(data: np.ndarray, starts: np.ndarray):
    """For texts that begin at ``starts`` in ``data`` (the last ends with it), each of at least
    ``LENGTH`` bytes: arrays ``text, place, low, high, hash, stretch``, where windows that start
    at ``low .. high`` have their minimizer at ``place`` (all counted in ``data``)."""
    n, span = len(data), LENGTH - GRAM
    hashes = Hashes(data)
    gram = hashes.grams(GRAM)
    ends = np.append(starts[1:], n)
    inner = ends[:-1]
    if len(inner):                                        # no gram crosses two texts
        gram[(inner[:, None] - np.arange(1, GRAM)[None, :]).ravel()] = NEVER
    least = _sliding_min(gram, span + 1)                  # window i: grams i .. i + span
    good = np.ones(len(least), bool)
    if len(inner):                                        # no window crosses two texts
        away = (inner[:, None] - np.arange(1, LENGTH)[None, :]).ravel()
        good[away[(away >= 0) & (away < len(good))]] = False
    # A place is a candidate if it has the minimum of some window that holds it.
    floor = np.where(good, least, np.uint64(0))
    padded = np.concatenate([np.full(span, NEVER), ~floor, np.full(span, NEVER)])
    highest = ~_sliding_min(padded, span + 1)[:len(gram)]
    spot = np.flatnonzero(gram == highest)
    h = gram[spot]
    # Its windows lie behind the last candidate that is as small and before the next smaller one:
    # previous-smaller pointers among the few candidates within reach.
    k = len(spot)
    low, high = np.maximum(spot - span, 0), spot.copy()
    for step in range(1, k):
        near = spot[step:] - spot[:-step] <= span
        if not near.any():
            break
        left = np.flatnonzero(near & (h[:-step] <= h[step:]))
        low[left + step] = np.maximum(low[left + step], spot[left] + 1)
        right = np.flatnonzero(near & (h[step:] < h[:-step]))
        high[right] = np.minimum(high[right], spot[right + step] - span - 1)
    text = np.searchsorted(starts, spot, side="right") - 1
    low = np.maximum(low, starts[text])
    high = np.minimum(high, ends[text] - LENGTH)
    keep = low <= high
    text, spot, low, high, h = text[keep], spot[keep], low[keep], high[keep], h[keep]
    # The stretch's hash also fixes where in it the anchor lies.
    stretch = mix(hashes.of(low, high + LENGTH) ^ (
        (spot - low).astype(np.uint64) * np.uint64(4096) + (high - low).astype(np.uint64)))
    return text, spot, low, high, h, stretch


def _bytes_of(column) -> tuple[np.ndarray, np.ndarray]:
    """Buffer and offsets of a string or binary Arrow column without nulls."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    return (np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8)), offsets


def _anchor_rows(texts: DataFrame) -> DataFrame:
    """``hash, stretch, id, place, low, high`` per anchor of ``texts`` (id binary, text). A task
    emits a text that it meets again only once."""
    names = ["key", "stretch", "id", "place", "low", "high"]

    def emit(held):
        ids, bases, parts = zip(*held)
        starts = np.cumsum([0] + [len(p) for p in parts[:-1]]).astype(np.int64)
        text, place, low, high, h, stretch = anchors(np.concatenate(parts), starts)
        shift = (np.array(bases) - starts)[text]
        return pa.RecordBatch.from_arrays(
            [pa.array(h.view(np.int64)), pa.array(stretch.view(np.int64)),
             pa.array(ids, pa.binary()).take(pa.array(text)),
             *(pa.array(x + shift) for x in (place, low, high))], names=names)

    def run(batches):
        seen, held, size = set(), [], 0
        for batch in batches:
            data, offsets = _bytes_of(batch.column(1))
            for row, key in enumerate(batch.column(0).to_pylist()):
                if key in seen:
                    continue
                seen.add(key)
                lo, hi = int(offsets[row]), int(offsets[row + 1])
                # A long text goes in pieces that overlap, so that each window is in one piece.
                for at in range(lo, hi - LENGTH + 1, CHUNK - LENGTH + 1):
                    part = data[at:min(at + CHUNK, hi)]
                    if size + len(part) > CHUNK and held:
                        yield emit(held)
                        held, size = [], 0
                    held.append((key, at - lo, part))
                    size += len(part)
            if held:                     # the parts are views of this batch
                yield emit(held)
                held, size = [], 0

    return texts.select("id", "text").mapInArrow(
        run, "key long, stretch long, id binary, place long, low long, high long")


# ------------------------------------------------------------------------- different stretches

def repeated_starts(stretches: list[bytes], places: list[int]) -> list[np.ndarray]:
    """Per stretch, whether the window at each of its starts also starts elsewhere among them.
    ``places`` are the anchors' places in them; equal windows lie alike about their anchors."""
    shift = [p % GRID for p in places]
    symbols, marks = [], []
    for b, first in zip(stretches, shift):
        count = (len(b) - first) // GRID
        symbols.append(np.frombuffer(b, ">u8", count, first).astype(np.uint64))
    ranks = np.unique(np.concatenate(symbols), return_inverse=True)[1]
    bars = len(stretches)
    joined, at, begin = [], 0, []
    for k, part in enumerate(symbols):
        begin.append(len(joined))
        joined += (ranks[at:at + len(part)] + bars).tolist()
        joined.append(bars - 1 - k)                         # every bar differs; the last is least
        at += len(part)
    sa = np.array(suffix_array(joined))
    text = np.array(joined)
    # Neighbours in the array that agree in SYMBOLS symbols are of one class.
    same = np.arange(1, len(sa))
    for step in range(SYMBOLS):
        a, b = sa[same - 1] + step, sa[same] + step
        ok = np.maximum(a, b) < len(text)
        same, a, b = same[ok], a[ok], b[ok]
        same = same[text[a] == text[b]]
    classed = np.zeros(len(sa), bool)
    classed[same] = True
    group = np.empty(len(sa), np.int64)
    group[sa] = np.cumsum(~classed)
    shared = np.zeros(len(sa), bool)
    shared[sa[same]] = shared[sa[same - 1]] = True
    # A window that starts `back` bytes before a grid point: its class there, and its two ends.
    owner, start, klass, ends = [], [], [], []
    for k, (b, first) in enumerate(zip(stretches, shift)):
        windows = len(b) - LENGTH + 1
        marks.append(np.zeros(windows, bool))
        points = np.arange(first, len(b) - LENGTH + GRID + 1, GRID)
        points = points[(points + SYMBOLS * GRID <= len(b))]
        points = points[shared[begin[k] + (points - first) // GRID]]
        raw = np.frombuffer(b, np.uint8)
        for back in range(GRID):
            s = points - back
            p = points[(s >= 0) & (s < windows)]
            if not len(p):
                continue
            take = np.concatenate([p[:, None] - back + np.arange(back)[None, :],
                                   p[:, None] + SYMBOLS * GRID + np.arange(GRID - back)[None, :]], 1)
            owner.append(np.full(len(p), k))
            start.append(p - back)
            klass.append(group[begin[k] + (p - first) // GRID] * GRID + back)
            ends.append(np.ascontiguousarray(raw[take]).view(np.uint64).ravel())
    if owner:
        owner, start, klass, ends = map(np.concatenate, (owner, start, klass, ends))
        order = np.lexsort((ends, klass))
        twin = (klass[order][1:] == klass[order][:-1]) & (ends[order][1:] == ends[order][:-1])
        hit = np.zeros(len(order), bool)
        hit[order[1:][twin]] = hit[order[:-1][twin]] = True
        for k, s in zip(owner[hit].tolist(), start[hit].tolist()):
            marks[k][s] = True
    return marks


def _runs(marks: np.ndarray) -> np.ndarray:
    """``[first, last]`` of every run of true values."""
    edges = np.flatnonzero(np.diff(np.r_[False, marks, False].astype(np.int8)))
    return edges.reshape(-1, 2) - [0, 1]


def _sorted_blocks(rows: DataFrame) -> DataFrame:
    """``id, low, high`` runs of repeated window starts, from ``key, id, low, place, bytes``."""

    def flush(held):
        for k, marks in enumerate(repeated_starts([r[4] for r in held],
                                                  [r[3] - r[2] for r in held])):
            for lo, hi in _runs(marks):
                yield held[k][1], held[k][2] + int(lo), held[k][2] + int(hi)

    def run(batches):
        held, group, size = [], [], 0
        out = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if group and row[0] != group[-1][0]:
                    if len(group) > 1:
                        held += group
                        size += sum(len(r[4]) for r in group) // GRID
                    group = []
                    if size > BLOCK_SYMBOLS:
                        out += flush(held)
                        held, size = [], 0
                        if out:
                            yield _run_batch(out)
                            out = []
                group.append(row)
        if len(group) > 1:
            held += group
        if held:
            out += flush(held)
        if out:
            yield _run_batch(out)

    return (rows.select("key", "id", "low", "place", "bytes").repartition("key")
            .sortWithinPartitions("key").mapInArrow(run, RUN_SCHEMA))


RUN_SCHEMA = "id binary, low long, high long"


def _run_batch(rows) -> pa.RecordBatch:
    cols = list(zip(*rows))
    return pa.RecordBatch.from_arrays(
        [pa.array(cols[0], pa.binary()), pa.array(cols[1], pa.int64()),
         pa.array(cols[2], pa.int64())], names=["id", "low", "high"])


def _dealt(rows: DataFrame, cell: int) -> DataFrame:
    """The rows cut into cells of ``cell`` neighbouring starts about the anchor; the key is now
    the hash of the bytes that all windows of the cell share."""

    def run(batches):
        for batch in batches:
            out = []
            for key, text, low, high, place, raw in zip(*(c.to_pylist() for c in batch.columns)):
                data = np.frombuffer(raw, np.uint8)
                hashes = Hashes(data)
                for c in range((low - place) // cell, (high - place) // cell + 1):
                    lo, hi = max(low, place + c * cell), min(high, place + c * cell + cell - 1)
                    core = place + c * cell + cell - 1 - low
                    core_hash = hashes.of(np.array([core]),
                                          np.array([core + LENGTH - cell + 1]))[0]
                    new = mix(np.array([core_hash ^ np.uint64((key + c) & 0xFFFFFFFFFFFFFFFF)]))
                    own = hashes.of(np.array([lo - low]), np.array([hi - low + LENGTH]))
                    own = mix(own ^ np.uint64((place - lo + 4096) * 8192 + hi - lo))
                    out.append((int(new.view(np.int64)[0]), int(own.view(np.int64)[0]), text, lo,
                                hi, place, raw[lo - low:hi - low + LENGTH]))
                if len(out) > 20_000:
                    yield _cell_batch(out)
                    out = []
            if out:
                yield _cell_batch(out)

    return (rows.select("key", "id", "low", "high", "place", "bytes").mapInArrow(
        run, "key long, stretch long, id binary, low long, high long, place long, bytes binary"))


def _cell_batch(rows) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
        names=["key", "stretch", "id", "low", "high", "place", "bytes"])


def _shared_keys(rows: DataFrame) -> DataFrame:
    """``key, stretch, times, kinds``: how often a stretch occurs, and how many different ones
    its key has; those that can hold a repeat only. Counted before anything is gathered."""
    times = rows.groupBy("key", "stretch").agg(F.count(F.lit(1)).alias("times"))
    kinds = times.groupBy(F.col("key").alias("k")).agg(F.count(F.lit(1)).alias("kinds"),
                                                       F.sum("times").alias("all"))
    kinds = kinds.where(F.col("all") > 1).drop("all")
    return times.join(kinds, F.col("key") == F.col("k")).drop("k")


def repeated_runs(docs: DataFrame, owners: DataFrame) -> DataFrame:
    """``id, low, high``: runs of starts of repeated windows, over the different texts of ``docs``
    (doc_id, id, text). ``owners`` (id, owner) names the document to take each text from."""
    found = cut(_anchor_rows(docs), "anchors")
    keys = cut(_shared_keys(found), "anchor-keys")
    shared = cut(found.join(keys, ["key", "stretch"]), "anchors-shared")
    runs = [shared.where("times > 1").select("id", "low", "high")]
    # One of each stretch goes on with its bytes, where its key has different ones.
    one = (shared.where("kinds > 1").groupBy("key", "stretch", "kinds")
           .agg(F.min(F.struct("id", "low", "high", "place")).alias("r"))
           .select("key", "kinds", "r.*"))
    wanted = one.groupBy("id").agg(F.collect_list(F.struct(
        "key", "kinds", "low", "high", "place")).alias("parts")).join(owners, "id")
    wanted = wanted.withColumnRenamed("id", "__id")
    cell = (docs.join(wanted, (docs["id"] == F.col("__id"))
                      & docs["doc_id"].eqNullSafe(F.col("owner")))
            .select("id", "text", F.explode("parts").alias("p"))
            .select("id", "p.*", F.substring(F.col("text").cast("binary"),
                                             (F.col("p.low") + 1).cast("int"),
                                             (F.col("p.high") - F.col("p.low") + LENGTH).cast("int"))
                    .alias("bytes")))
    cell = cut(cell.dropDuplicates(["key", "id", "low"]), "stretches")
    for size in CELLS:
        runs.append(_sorted_blocks(cell.where(F.col("kinds") <= GROUP)))
        large = cell.where(F.col("kinds") > GROUP).drop("kinds")
        if large.isEmpty():
            break
        dealt = cut(_dealt(large, size), "stretches")
        keys = cut(_shared_keys(dealt), "stretch-keys")
        both = cut(dealt.join(keys, ["key", "stretch"]), "stretches-shared")
        runs.append(both.where("times > 1").select("id", "low", "high"))
        cell = cut(both.where("kinds > 1").groupBy("key", "stretch", "kinds").agg(
            F.min(F.struct("id", "low", "high", "place", "bytes")).alias("r"))
            .select("key", "kinds", "r.*"), "stretches")
    out = runs[0]
    for r in runs[1:]:
        out = out.unionByName(r)
    return out


def _kept(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_kept, text`` from ``doc_id, text, copies,
    runs``. The last two are what remains: its bytes, and the text, where U+FFFD stands for a
    character cut apart."""

    def run(batches):
        for batch in batches:
            out, held = [], 0
            ids, copies, runs = (batch.column(k).to_pylist() for k in (0, 2, 3))
            data, offsets = _bytes_of(batch.column(1))
            for k, doc in enumerate(ids):
                raw = data[offsets[k]:offsets[k + 1]]
                n = len(raw)
                spans = [(0, n)] if copies[k] and copies[k] > 1 and n >= LENGTH else _merged(runs[k])
                edges = [0, *(x for span in spans for x in span), n]
                kept = b"".join(bytes(raw[lo:hi]) for lo, hi in zip(edges[::2], edges[1::2]))
                out.append((doc, n, n - len(kept), len(spans), hashlib.sha256(kept).hexdigest(),
                            len(kept), kept.decode("utf-8", "replace")))
                held += len(kept)
                if held > KEPT_BYTES:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
                    out, held = [], 0
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_kept", "text"]
    types = [pa.int64()] * 4 + [pa.string(), pa.int64(), pa.string()]
    return docs.select("doc_id", "text", "copies", "runs").mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
             "n_kept long, text string")


def _merged(runs) -> list[tuple[int, int]]:
    """Byte spans ``[from, to)`` covered by the windows of the runs, touching ones joined."""
    out: list[list[int]] = []
    for r in sorted((r["low"], r["high"]) for r in runs or []):
        lo, hi = r[0], r[1] + LENGTH
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [tuple(x) for x in out]


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text); see :func:`_kept`."""
    text = F.coalesce("text", F.lit(""))
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
                        F.unhex(F.md5(text)).alias("id"))
    long = keyed.where(F.octet_length("text") >= LENGTH)
    copies = cut(long.groupBy("id").agg(F.count(F.lit(1)).alias("copies"),
                                        F.min("doc_id").alias("owner")), "copies")
    runs = (repeated_runs(long, copies.select("id", "owner")).groupBy("id")
            .agg(F.collect_set(F.struct("low", "high")).alias("runs")))
    marks = (copies.where("copies > 1").select("id", "copies").join(runs, "id", "full")
             .select(F.col("id").alias("__id"), "copies",
                     F.when(F.coalesce("copies", F.lit(1)) == 1, F.col("runs")).alias("runs")))
    return _kept(keyed.join(marks, F.col("id") == F.col("__id"), "left"))


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(spark.read.parquet(f"{sf_dir}/documents.parquet")
                            .select("doc_id", "text"))
