"""Best-fit packing of token sequences into bins of fixed capacity.

Documents are tokenized, closed with id 0, and cut only if longer than the capacity (all pieces but
the first are then full). What a bin holds depends on lengths alone, and there are at most
``capacity`` of them: the plan is made from the histogram of lengths, whatever the number of
documents. Lengths above one third of the capacity are matched greedily, longest first, each with
the longest that still fits, so that a bin holds at most two of them; the rest go, longest first,
into the tightest gap that takes them. All bins of one filling are handled at once. Pieces then
find their place by their rank among the pieces of their length: ranks are counted in
(length, hash) groups and shifted by the groups before, so a length shared by a third of all rows
is dealt to many tasks.

Defined results: null text is empty, and an empty document is the closing id alone; repeated rows
are packed one by one; pieces of equal length are ranked by hash group, document and piece; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hitroll.llm.common import cut

CAPACITY = 2048
CLOSING_ID = 0
VOCABULARY, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
RANK_GROUPS = 256
LONG_BLANK = 1 << 14       # white space in a row that goes to the tokenizer itself


# ------------------------------------------------------------------------------ tokenization

SPECIAL = "<|endoftext|>"      # the vocabulary's one special token


def vocabulary_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def encoder(vocabulary: str, ranks: str):
    """A function from text to ids of the tokenizer in ``vocabulary`` (no special tokens added).

    ``ranks`` is the same vocabulary for another library, which gives the same ids several times
    faster (a test compares them over every code point); the tokenizer itself encodes the texts
    that hold the special token's string, and those with a very long run of white space, for which
    the other library's pattern matcher runs out of stack.
    """
    import base64
    import re

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer
    with open(ranks, "rb") as fh:
        table = {base64.b64decode(t): int(n) for t, n in map(bytes.split, fh)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table,
                             special_tokens={})
    exact, blank = [], re.compile(rf"(?<!\s)\s{{{LONG_BLANK}}}")

    def encode(text: str) -> list[int]:
        if SPECIAL not in text and (len(text) < LONG_BLANK or not blank.search(text)):
            return fast.encode_ordinary(text)
        if not exact:
            exact.append(Tokenizer.from_file(vocabulary))
        return exact[0].encode(text, add_special_tokens=False).ids
    return encode


def piece_bounds(n: int, capacity: int) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of a document of ``n`` ids."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def tokenize_pieces(docs: DataFrame, vocabulary: str | None = None, ranks: str | None = None,
                    capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` (and ``ids``) per piece of every document."""
    vocabulary = vocabulary or vocabulary_path(VOCABULARY)
    ranks = ranks or vocabulary_path(RANKS)

    def run(batches):
        import numpy as np
        ids_of = encoder(vocabulary, ranks)
        for batch in batches:
            out = ([], [], [], [], [], [])
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.array([*ids_of(text.as_py() or ""), CLOSING_ID], dtype="<u4")
                for k, (start, length) in enumerate(piece_bounds(len(ids), capacity)):
                    part = ids[start:start + length]
                    row = (doc, k, start, length, zlib.crc32(part.tobytes()),
                           part.tolist() if keep_ids else None)
                    for col, v in zip(out, row):
                        col.append(v)
            arrays = [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()),
                      pa.array(out[2], pa.int64()), pa.array(out[3], pa.int64()),
                      pa.array(out[4], pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if keep_ids:
                arrays.append(pa.array(out[5], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return (docs.select(F.col("doc_id").cast("long"), "text")
            .mapInArrow(run, schema + (", ids array<int>" if keep_ids else "")))


# -------------------------------------------------------------------------------------- plan

class _Gaps:
    """Groups of equal bins, found by the tightest gap that takes a length."""

    def __init__(self):
        self.sorted: list[int] = []
        self.groups: dict[int, list] = {}

    def add(self, bins: int, held: list, gap: int) -> None:
        if bins:
            if gap not in self.groups:
                insort(self.sorted, gap)
                self.groups[gap] = []
            self.groups[gap].append((bins, held))

    def tightest(self, length: int):
        at = bisect_left(self.sorted, length)
        if at == len(self.sorted):
            return None
        gap = self.sorted[at]
        bins, held = self.groups[gap].pop()
        if not self.groups[gap]:
            del self.groups[gap], self.sorted[at]
        return bins, held, gap


def plan_bins(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list]]:
    """``(number of bins, [(length, how many in each bin), ...])`` for every filling."""
    left = {n: c for n, c in counts.items() if c > 0}
    large = sorted(n for n in left if 3 * n > capacity)
    gaps = _Gaps()
    while large:                                    # greedy matching, longest first
        a = large[-1]
        at = bisect_left(large, capacity - a + 1) - 1
        if at >= 0 and large[at] == a and left[a] == 1:
            at -= 1                                 # one of a kind cannot pair with itself
        if at < 0:
            bins, held = left[a], [(a, 1)]
            left[a] = 0
        elif large[at] == a:
            bins, held = left[a] // 2, [(a, 2)]
            left[a] %= 2
        else:
            b = large[at]
            bins, held = min(left[a], left[b]), [(a, 1), (b, 1)]
            left[a] -= bins
            left[b] -= bins
            if not left[b]:
                large.pop(at)
        if not left[a]:
            large.pop()
        gaps.add(bins, held, capacity - sum(n * k for n, k in held))
    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):  # best fit
        todo = left[n]
        while todo:
            found = gaps.tightest(n)
            bins, held, gap = found or (-(-todo // (capacity // n)), [], capacity)
            each = gap // n
            full = min(bins, todo // each)
            rest = min(todo - full * each, each - 1) if full < bins else 0
            gaps.add(full, [*held, (n, each)], gap - each * n)
            if rest:
                gaps.add(1, [*held, (n, rest)], gap - rest * n)
            gaps.add(bins - full - bool(rest), held, gap)
            todo -= full * each + rest
    return [(bins, held) for gap in sorted(gaps.groups) for bins, held in gaps.groups[gap]]


def place_rows(plan: list[tuple[int, list]]) -> list[tuple]:
    """``(length, from rank, to rank, first bin, first offset, how many in each bin)``: the ranks
    of one length that go to the bins of one filling."""
    rows, ranks, first = [], {}, 0
    for bins, held in plan:
        offset = 0
        for n, k in held:
            r = ranks.get(n, 0)
            rows.append((n, r, r + bins * k, first, offset, k))
            ranks[n] = r + bins * k
            offset += n * k
        first += bins
    return rows


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``."""
    spark = pieces.sparkSession
    group = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(RANK_GROUPS))
    counts = cut(pieces.groupBy(F.col("length").alias("__n"), group.alias("__g"))
                 .agg(F.count(F.lit(1)).alias("__c")), "piece-counts")
    # At most `capacity` rows reach the driver, however many pieces there are.
    histogram = {r[0]: r[1] for r in counts.groupBy("__n").agg(F.sum("__c")).collect()}
    rows = place_rows(plan_bins(histogram, capacity))
    # A few rows per length (bounded by the capacity), so it may be broadcast.
    places = F.broadcast(spark.createDataFrame(
        rows, "__l long, __from long, __to long, __first long, __offset long, __each long"))
    before = counts.withColumn("__before", F.sum("__c").over(
        Window.partitionBy("__n").orderBy("__g").rowsBetween(Window.unboundedPreceding, -1)))
    ranked = pieces.withColumn("__group", group).withColumn("__row", F.row_number().over(
        Window.partitionBy("length", "__group").orderBy("doc_id", "piece", "ids_crc32")))
    ranked = ranked.join(before, (F.col("length") == F.col("__n"))
                         & (F.col("__group") == F.col("__g")))
    ranked = ranked.withColumn(
        "__rank", F.coalesce("__before", F.lit(0)) + F.col("__row") - 1)
    index = F.col("__rank") - F.col("__from")
    return (ranked.join(places, (F.col("length") == F.col("__l"))
                        & (F.col("__rank") >= F.col("__from")) & (F.col("__rank") < F.col("__to")))
            .select(*pieces.columns,
                    (F.col("__first") + F.floor(index / F.col("__each"))).alias("sequence_id"),
                    (F.col("__offset") + index % F.col("__each") * F.col("length"))
                    .alias("offset")))


def pack_documents(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    return pack(cut(tokenize_pieces(docs, capacity=capacity), "pieces"), capacity)


def packed_sequences(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The training sequences themselves: ``sequence_id, ids``, at most ``capacity`` ids each."""
    pieces = cut(tokenize_pieces(docs, capacity=capacity, keep_ids=True), "pieces-ids")
    placed = pack(pieces, capacity).groupBy("sequence_id").agg(
        F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return placed.select("sequence_id",
                         F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet")
                          .select("doc_id", "text"))
